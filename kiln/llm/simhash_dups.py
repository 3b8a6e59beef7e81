"""Near-duplicate documents by SimHash and generalised pigeonhole search.

A text's fingerprint has a bit set if over half of the XXH64 hashes of its three-word
shingles (repeats included) have it.  Two fingerprints are linked if they differ in at most
``radius`` bits, and linked documents form components.

Generalised pigeonhole.  The 64 bits are cut into m partitions.  Give partition i a number u_i of
units, with all u_i adding up to ``radius + 1``: two fingerprints within ``radius`` bits then differ in
fewer than u_i bits in at least one partition i.  So a fingerprint finds all its partners by probing
every partition with u_i > 0 for the keys within ``u_i - 1`` bits of its own.

1. *Partitions.*  A grouped sum over all distinct fingerprints gives the 64 by 64 table of common
   bits.  Bits that go together are put into one partition, which makes some partitions poor and
   leaves the others selective.
2. *Units.*  Partitions are cut into sub-blocks of at most eight bits, and a second grouped sum counts their
   values.  From these a task estimates, for each fingerprint of its own, how many candidates every
   partition has within 0, 1, ... bits, and a dynamic program deals out the units at the least
   estimated cost.  A partition that holds a value of very many fingerprints gets none.
   The number of partitions m is that of the lowest cost over all fingerprints.
3. *Probe and verify.*  Every fingerprint is posted under its value in each partition, and probes
   under its keys; both are shuffled by (partition, key) and joined, where the whole distance
   decides inside the join, so only links come out.  A list of more than ``LIST`` postings is cut again: of
   the bits outside of the partition, cut into ``radius + 1`` blocks, a linked pair agrees in
   one block at least, so both sides get that block's value as a further key.

Exact copies, and all documents of one fingerprint, are one class throughout; links are between classes.  No
statistic or list is sampled.  The driver holds the two fixed-size tables of 1 and 2.

Defined cases: a NULL or empty text, or one without words, has fingerprint 0 and is linked like
any other; with fewer than three words the whole sequence is the one shingle; rows with a NULL
id have a fingerprint and link others, and their ``component_id`` is the smallest id reachable (NULL if there is none);
repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import small_side, stored
from kiln.llm.components import components

BITS, WORDS, SEED, RADIUS = 64, 3, 42, 2
#: widest sub-block whose values are counted
SUB = 8
#: cost of one probe, in candidates
PROBE = 2.0
#: postings of one key beyond which its list is cut by a further key
LIST = 4096

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def fingerprint(text: bytes | None, words: int = WORDS) -> int:
    """Unsigned fingerprint of a UTF-8 text (``bytes.split`` cuts at 0x20 and 0x09 to 0x0D only)."""
    found = (text or b"").translate(_LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    width = min(words, len(found))
    ends = list(accumulate(map(len, found)))  # without the blanks
    n = len(found) - width + 1
    counts = np.zeros(BITS, np.int64)
    for at in range(0, n, 8192):
        hashes = [xxhash.xxh64_intdigest(joined[(ends[i - 1] if i else 0) + i:ends[i + width - 1] + i + width - 1], SEED)
                  for i in range(at, min(n, at + 8192))]
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n, bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, bits)``, the fingerprint as a signed long."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.array([fingerprint(t.as_py()) for t in batch.column("text")], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(prints.view(np.int64))],
                                             names=["doc_id", "bits"])

    return rows.mapInArrow(work, "doc_id long, bits long")


def _prints(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("bits").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


# --- 1: partitions ----------------------------------------------------------------
def common_bits(classes: DataFrame) -> tuple[int, np.ndarray]:
    """Number of fingerprints, and in how many of them two bits are both set."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            x = np.unpackbits(_prints(batch).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
            both += np.rint(x.T @ x).astype(np.int64)  # a batch is far below 2**53 rows
            n += len(x)
        if n:
            i, j = np.triu_indices(BITS)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(i, -1)), pa.array(np.append(j, -1)),
                                              pa.array(np.append(both[i, j], n))], names=["i", "j", "n"])

    both, n = np.zeros((BITS, BITS), np.int64), 0
    for r in (classes.select("bits").mapInArrow(work, "i long, j long, n long")
              .groupBy("i", "j").agg(F.sum("n").alias("n")).collect()):  # 2,081 rows
        if r.i < 0:
            n = r.n
        else:
            both[r.i, r.j] = both[r.j, r.i] = r.n
    return n, both


def correlation(n: int, both: np.ndarray) -> np.ndarray:
    share = np.diag(both) / max(n, 1)
    spread = np.sqrt(share * (1 - share))
    scale = np.outer(spread, spread)
    covariance = both / max(n, 1) - np.outer(share, share)
    # a constant bit tells nothing: it goes with any other
    out = np.abs(np.divide(covariance, scale, out=np.ones_like(scale), where=scale > 1e-12))
    np.fill_diagonal(out, 0)
    return np.round(out, 9)


def partitions(related: np.ndarray, m: int) -> list[list[int]]:
    """The bits in ``m`` groups of nearly equal width; each is grown from its most related pair."""
    free, out = list(range(BITS)), []
    for part in range(m):
        width = BITS * (part + 1) // m - BITS * part // m
        table = related[np.ix_(free, free)]
        group = [free[int(table.max(axis=1).argmax())]] if len(free) > 1 else free[:1]
        while len(group) < width:
            rest = [b for b in free if b not in group]
            group.append(rest[int(related[np.ix_(rest, group)].mean(axis=1).argmax())])
        free = [b for b in free if b not in group]
        out.append(group)
    return out


def gather(prints: np.ndarray, bits: list[int]) -> np.ndarray:
    """The given bits of each fingerprint as one number, the first bit lowest."""
    out = np.zeros(len(prints), np.uint64)
    for k, b in enumerate(bits):
        out |= ((prints >> np.uint64(b)) & np.uint64(1)) << np.uint64(k)
    return out


# --- 2: units -----------------------------------------------------------------------
def _sub_blocks(bits: list[int]) -> list[list[int]]:
    n = -(-len(bits) // SUB)
    return [bits[len(bits) * i // n:len(bits) * (i + 1) // n] for i in range(n)]


def block_values(classes: DataFrame, layouts: list[list[list[int]]]) -> dict[tuple[int, int, int], np.ndarray]:
    """Counts of the values of every sub-block, by (layout, partition, sub-block)."""
    blocks = [(la, p, s, sub) for la, layout in enumerate(layouts) for p, bits in enumerate(layout)
              for s, sub in enumerate(_sub_blocks(bits))]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(1 << len(sub), np.int64) for *_, sub in blocks]
        for batch in batches:
            prints = _prints(batch)
            for k, (*_, sub) in enumerate(blocks):
                counts[k] += np.bincount(gather(prints, sub).astype(np.int64), minlength=1 << len(sub))
        for k, c in enumerate(counts):
            seen = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(seen), k)), pa.array(seen), pa.array(c[seen])],
                                             names=["block", "value", "n"])

    out = {(la, p, s): np.zeros(1 << len(sub), np.int64) for la, p, s, sub in blocks}
    for r in (classes.select("bits").mapInArrow(work, "block long, value long, n long")
              .groupBy("block", "value").agg(F.sum("n").alias("n")).collect()):  # at most 256 rows a block
        out[blocks[r.block][:3]][r.value] = r.n
    return out


def _near_shares(counts: np.ndarray, radius: int) -> np.ndarray:
    """For every value of a sub-block the share of fingerprints at distance 0, 1, ... ``radius`` in it."""
    values = np.arange(len(counts))
    apart = np.bitwise_count(values[:, None] ^ values[None, :])
    return np.stack([((apart == d) * counts[None, :]).sum(axis=1) for d in range(radius + 1)], axis=1) / max(counts.sum(), 1)


def masks(width: int, radius: int) -> np.ndarray:
    """All ``width``-bit numbers with at most ``radius`` bits set."""
    return np.array([sum(1 << bit for bit in bits) for k in range(min(radius, width) + 1)
                     for bits in combinations(range(width), k)], np.uint64)


def allocate(prints: np.ndarray, layout: list[list[int]], shares: list[list[np.ndarray]], n: int,
             radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Units of every partition for each fingerprint (rows), and the estimated cost."""
    rows = np.arange(len(prints))
    best = np.full((len(prints), radius + 2), np.inf)  # by units dealt out so far
    best[:, 0] = 0
    took = []
    for bits, tables in zip(layout, shares):
        near = np.zeros((len(prints), radius + 1))
        near[:, 0] = 1
        for sub, table in zip(_sub_blocks(bits), tables):  # sub-blocks are taken as independent
            own = table[gather(prints, sub).astype(np.int64)]
            near = np.stack([sum(near[:, a] * own[:, d - a] for a in range(d + 1)) for d in range(radius + 1)], axis=1)
        found = np.cumsum(near, axis=1) * n
        keys = np.cumsum([math.comb(len(bits), d) for d in range(radius + 1)])
        cost = np.concatenate([np.zeros((len(prints), 1)), found + PROBE * keys[None, :]], axis=1)
        options = np.stack([np.stack([best[:, total - u] + cost[:, u] for u in range(total + 1)]
                                     + [np.full(len(prints), np.inf)] * (radius + 1 - total))
                            for total in range(radius + 2)])  # total, units, row
        took.append(options.argmin(axis=1))
        best = options.min(axis=1).T
    units = np.zeros((len(prints), len(layout)), np.int64)
    left = np.full(len(prints), radius + 1)
    for p in reversed(range(len(layout))):
        units[:, p] = took[p][left, rows]
        left = left - units[:, p]
    return units, best[:, radius + 1]


class Plan:
    """Partitions and value counts; what a task needs for posting and probing."""

    def __init__(self, layout: list[list[int]], shares: list[list[np.ndarray]], n: int, radius: int):
        self.layout, self.shares, self.n, self.radius = layout, shares, n, radius

    def rest(self, part: int) -> list[int]:
        return [b for bits in self.layout[:part] + self.layout[part + 1:] for b in bits]


def make_plan(classes: DataFrame, radius: int) -> Plan:
    n, both = common_bits(classes)
    related = correlation(n, both)
    layouts = [partitions(related, m) for m in range(2, radius + 3)]
    counts = block_values(classes, layouts)
    shares = [[[_near_shares(counts[la, p, s], radius) for s in range(len(_sub_blocks(bits)))]
               for p, bits in enumerate(layout)] for la, layout in enumerate(layouts)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cost = np.zeros(len(layouts))
        for batch in batches:
            for la, layout in enumerate(layouts):
                cost[la] += allocate(_prints(batch), layout, shares[la], n, radius)[1].sum()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(layouts))), pa.array(cost)], names=["layout", "cost"])

    costs = (classes.select("bits").mapInArrow(work, "layout long, cost double")
             .groupBy("layout").agg(F.sum("cost").alias("cost")).collect())
    la = min(costs, key=lambda r: (round(r.cost, 3), r.layout)).layout if costs else 0
    return Plan(layouts[la], shares[la], n, radius)


# --- 3: probe and verify ---------------------------------------------------------------
KEYED = "part int, key long, rest long, bits long"


def _keyed(batch_parts: list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    join = lambda k: np.concatenate([x[k] for x in batch_parts]).view(np.int64)
    part = np.concatenate([np.full(len(x[1]), x[0], np.int32) for x in batch_parts])
    return pa.RecordBatch.from_arrays([pa.array(part), *(pa.array(join(k)) for k in (1, 2, 3))],
                                      names=["part", "key", "rest", "bits"])


def postings(classes: DataFrame, plan: Plan) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _prints(batch)
            yield _keyed([(p, gather(x, bits), gather(x, plan.rest(p)), x) for p, bits in enumerate(plan.layout)])

    return classes.select("bits").mapInArrow(work, KEYED)


def probes(classes: DataFrame, plan: Plan) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                x = _prints(batch.slice(at, 2048))
                units, _ = allocate(x, plan.layout, plan.shares, plan.n, plan.radius)
                out = []
                for p, bits in enumerate(plan.layout):
                    for u in range(1, plan.radius + 2):
                        asked = x[units[:, p] == u]
                        if len(asked):
                            flips = masks(len(bits), u - 1)
                            keys = (gather(asked, bits)[:, None] ^ flips[None, :]).ravel()
                            out.append((p, keys, np.repeat(gather(asked, plan.rest(p)), len(flips)), np.repeat(asked, len(flips))))
                if out:
                    yield _keyed(out)

    return classes.select("bits").mapInArrow(work, KEYED)


def links(classes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs ``a < b`` of the distinct fingerprints ``classes(bits)`` that differ in at most ``radius`` bits."""
    plan = make_plan(classes, radius)
    posted, probing = postings(classes, plan), probes(classes, plan)
    long_lists = stored(posted.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > LIST)
                        .select("part", "key"), "long-lists")
    keys = ["part", "key"]
    if not long_lists.isEmpty():
        keys = ["part", "key", "block", "value"]
        widths = {p: [len(plan.rest(p)) * k // (radius + 1) for k in range(radius + 2)] for p in range(len(plan.layout))}
        side = small_side(long_lists.withColumn("__long", F.lit(True)))

        def cut(df: DataFrame) -> DataFrame:
            blocks = F.lit(None)
            for p, ends in widths.items():
                value = [F.struct(F.lit(k).alias("block"),
                                  F.shiftrightunsigned("rest", a).bitwiseAND(F.lit((1 << (b - a)) - 1).cast("long")).alias("value"))
                         for k, (a, b) in enumerate(zip(ends, ends[1:]))]
                blocks = F.when(F.col("part") == p, F.array(*value)).otherwise(blocks)
            whole = F.array(F.struct(F.lit(-1).alias("block"), F.lit(0).cast("long").alias("value")))
            return (df.join(side, ["part", "key"], "left")
                    .withColumn("__cut", F.explode(F.when(F.col("__long"), blocks).otherwise(whole)))
                    .select("part", "key", "bits", F.col("__cut.block").alias("block"), F.col("__cut.value").alias("value")))

        posted, probing = cut(posted), cut(probing)
    a, b = probing.select(*keys, F.col("bits").alias("a")), posted.select(*keys, F.col("bits").alias("b"))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    on = [a[k] == b[k] for k in keys] + [F.col("a") < F.col("b"), near]
    return a.join(b, on).select("a", "b").distinct()


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS) -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    prints = stored(fingerprints(docs, id_col, text_col), "prints")
    classes = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("low")), "print-classes")
    found = components(links(classes, radius)).withColumnRenamed("node", "bits")
    # only linked classes pass through the join by component
    linked = stored(classes.join(found, "bits"), "linked-classes")
    lows = linked.groupBy("component").agg(F.min("low").alias("__low"))
    lows = linked.join(lows, "component").select("bits", "__low")
    named = stored(classes.join(lows, "bits", "left")
                   .select("bits", F.coalesce("__low", "low").alias("component_id")), "named-classes")
    return prints.join(small_side(named), "bits").select(
        "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")
