"""SimHash document fingerprints and radius search by permuted block tables.

A text's terms are its three-word shingles (A-Z in lower case; all words if there are
fewer).  Each term votes with the 64 signed bits of its hash, with weight
``1 + floor(log2(count))``; the signs of the sums are the fingerprint.  All sums
are whole numbers, so equal texts have equal fingerprints on any machine.

Search: the 64 bits are cut into ``BLOCKS`` blocks.  Two fingerprints within
Hamming distance r differ in at most ``r // BLOCKS`` bits of some block.  There is
one table for every block, keyed by its bits (the fingerprint permuted so that
they lead); a query looks up all keys so near to its own, and the full distance
decides.  Classes of equal fingerprints are searched once.  The queries are
broadcast in blocks of bounded size; every task searches the tables of its own
fingerprints and returns one sum per query, so no pair is shuffled and a large
group of near copies is searched wherever its rows lie.  The work is queries times
classes times the share of keys that are looked up (0.8 % at radius 11).

Defined cases: a NULL text is empty; an empty text has fingerprint 0; rows
without an id come last in descending order; equal rows follow each other;
a single row is its own next document; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import stored
from kiln.llm.near_dups import _LOWER, _STEP, _mix, word_hashes

BITS, BLOCKS, RADIUS, TERM_WORDS = 64, 4, 3, 3
BLOCK_BITS = BITS // BLOCKS
#: holds near copies from five-word similarity 0.8 on (see the README for the recall)
COPY_RADIUS = 11
#: queries that are broadcast at once, fingerprints of one set of tables, candidates compared at once
QUERIES, TABLE_ROWS, CANDIDATES = 1 << 18, 1 << 18, 1 << 20
#: ranges of ids per shuffle partition
RANGES = 4


def fingerprint(text: str | None) -> int:
    words = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not words:
        return 0
    h = word_hashes(words)
    width = min(TERM_WORDS, len(h))
    last = len(h) - width + 1
    s = np.full(last, width, np.uint64)
    for j in range(width):
        s = s * _STEP + h[j:j + last]
    terms, counts = np.unique(_mix(s), return_counts=True)
    weights = (1 + np.floor(np.log2(counts))).astype(np.float32)
    votes = np.zeros(BITS)
    for i in range(0, len(terms), 8192):  # sums stay far below 2**24, so they are exact
        bits = np.unpackbits(terms[i:i + 8192, None].view(np.uint8), axis=1, bitorder="little")
        votes += weights[i:i + 8192] @ (2 * bits.astype(np.float32) - 1)
    return int.from_bytes(np.packbits(votes > 0, bitorder="little").tobytes(), "little")


def likeness(a: int, b: int) -> float:
    return 1.0 - (a ^ b).bit_count() / BITS


def _with_next(rows: DataFrame) -> DataFrame:
    """``rows(doc_id, text)`` dealt out so that every row's next one (descending id) follows it.

    Ids are cut into ranges; a range is sorted by one task, and the first row of
    a range is sent as a guest to the range above it too (that of the highest to the
    lowest), to follow its last row.  Texts are shuffled once.
    """
    spark = rows.sparkSession
    lowest = -(1 << 63)
    rows = rows.withColumn("__key", F.coalesce("doc_id", F.lit(lowest).cast("long")))
    total = rows.count()
    ranges = max(1, min(total // 50, RANGES * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    cuts = np.array(rows.agg(F.percentile_approx(
        "__key", [k / ranges for k in range(1, ranges)] or [0.5], 10 * ranges + 100)).first()[0] or [lowest], np.int64)
    cuts = np.unique(cuts)

    @F.pandas_udf("int")
    def range_of(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(cuts, keys.to_numpy(np.int64), side="right").astype(np.int32))

    order = F.struct(F.col("__key"), (-F.crc32(F.coalesce("text", F.lit("")))).alias("tie"))
    rows = rows.withColumns({"__range": range_of("__key"), "__order": order})
    heads = rows.groupBy("__range").agg(F.max("__order").alias("__head"))
    above = F.lead("__range").over(Window.orderBy("__range"))  # as many rows as ranges
    first = F.first("__range").over(Window.orderBy("__range"))
    heads = stored(heads.select(F.col("__range").alias("__r"), "__head", F.coalesce(above, first).alias("__above")),
                   "range-heads")
    seats = F.when(F.col("__head").isNotNull(), F.array(
        F.struct(F.col("__range").alias("at"), F.lit(False).alias("guest")),
        F.struct(F.col("__above").alias("at"), F.lit(True).alias("guest")))).otherwise(
        F.array(F.struct(F.col("__range").alias("at"), F.lit(False).alias("guest"))))
    dealt = (rows.join(F.broadcast(heads), (F.col("__range") == F.col("__r")) & (F.col("__order") == F.col("__head")),
                       "left")
             .select("doc_id", "text", "__order", F.explode(seats).alias("__seat"))
             .select("doc_id", "text", "__order", "__seat.at", "__seat.guest"))
    return (dealt.repartition("at").sortWithinPartitions("at", "guest", F.col("__order").desc())
            .select("doc_id", "text", "at", "guest"))


OUT = ("doc_id long, n_chars long, edited_sha256 string, bits long, edited_bits long, "
       "near_edited double, near_next double")


def fingerprints_with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: fingerprints (as signed longs) of the text and of its edited text.

    The edited text has the last third of the code points replaced by the first ones of the next document.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))

    def signed(x: int) -> int:
        return x - (1 << 64) if x >> 63 else x

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the row before, with its fingerprint, waiting for the next one
        for batch in batches:
            out = []
            for doc, text, at, guest in zip(batch.column("doc_id").to_pylist(), batch.column("text"),
                                            batch.column("at").to_pylist(), batch.column("guest").to_pylist()):
                text = text.as_py() or ""
                own = held[2] if held and held[1] == text else fingerprint(text)
                if held and held[3] == at:
                    n, k = len(held[1]), len(held[1]) // 3
                    edited = held[1][:n - k] + text[:k]
                    changed = fingerprint(edited)
                    out.append((held[0], n, hashlib.sha256(edited.encode("utf-8", "replace")).hexdigest(),
                                signed(held[2]), signed(changed), likeness(held[2], changed), likeness(held[2], own)))
                held = None if guest else (doc, text, own, at)
            columns = list(zip(*out)) or [()] * 7
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                             names=[x.split()[0] for x in OUT.split(", ")])

    return _with_next(rows).mapInArrow(work, OUT)


def _near_masks(width: int, radius: int) -> np.ndarray:
    """All ``width``-bit numbers with at most ``radius`` bits set."""
    return np.array([sum(1 << bit for bit in bits) for k in range(radius + 1)
                     for bits in combinations(range(width), k)], np.int64)


def _block(values: np.ndarray, block: int) -> np.ndarray:
    return ((values >> np.uint64(block * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)


def near_sums(queries: np.ndarray, prints: np.ndarray, weights: np.ndarray, radius: int) -> np.ndarray:
    """For every query the sum of the weights of the fingerprints within the radius."""
    sums = np.zeros(len(queries), np.int64)
    inner = radius // BLOCKS
    masks = _near_masks(BLOCK_BITS, inner)
    for block in range(BLOCKS):
        keys = _block(prints, block)
        order = np.argsort(keys, kind="stable")
        table, heavy = prints[order], weights[order]
        starts = np.concatenate(([0], np.cumsum(np.bincount(keys, minlength=1 << BLOCK_BITS))))
        wanted = _block(queries, block)
        for mask in masks:
            first = starts[wanted ^ mask]
            sizes = starts[(wanted ^ mask) + 1] - first
            asked = np.flatnonzero(sizes)
            ends = np.cumsum(sizes[asked])
            at = 0
            while at < len(asked):  # a bounded number of candidates at a time, one query at least
                done = ends[at - 1] if at else 0
                to = max(at + 1, int(np.searchsorted(ends, done + CANDIDATES, side="right")))
                part = asked[at:to]
                who = np.repeat(part, sizes[part])
                where = np.arange(len(who)) + np.repeat(first[part] - (ends[at:to] - sizes[part] - done), sizes[part])
                apart = queries[who] ^ table[where]
                near = np.bitwise_count(apart) <= radius
                who, where, apart = who[near], where[near], apart[near]
                new = np.ones(len(who), bool)  # a pair counts in the first block that it meets in
                for before in range(block):
                    new &= np.bitwise_count(_block(apart, before)) > inner
                np.add.at(sums, who[new], heavy[where[new]])
                at = to
    return sums


def within_radius(classes: DataFrame, radius: int) -> DataFrame:
    """``(bits, n_near)``: for the ``asked`` ones of the distinct ``classes(bits, n, asked)`` the sum of ``n``
    over all classes within the radius.

    The queries are read in blocks of about ``QUERIES``, each block one scan over the classes.
    """
    asked = classes.filter("asked").select("bits")
    parts = max(1, -(-asked.count() // QUERIES))
    out = None
    for part in range(parts):
        block = asked if parts == 1 else asked.filter(F.pmod(F.xxhash64("bits"), F.lit(parts)) == part)
        queries = block.toPandas()["bits"].to_numpy(np.int64)
        shared = classes.sparkSession.sparkContext.broadcast(queries)

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = shared.value.view(np.uint64)
            sums = np.zeros(len(own), np.int64)
            held, rows = [], 0

            def searched() -> np.ndarray:
                bits, n = (np.concatenate([h[k] for h in held]) for k in (0, 1))
                return near_sums(own, bits.view(np.uint64), n, radius)

            for batch in batches:
                held.append([batch.column(c).to_numpy().astype(np.int64) for c in ("bits", "n")])
                rows += batch.num_rows
                if rows >= TABLE_ROWS:
                    sums += searched()
                    held, rows = [], 0
            if rows:
                sums += searched()
            hit = np.flatnonzero(sums)
            for i in range(0, len(hit), 10_000):
                some = hit[i:i + 10_000]
                yield pa.RecordBatch.from_arrays([pa.array(shared.value[some]), pa.array(sums[some])],
                                                 names=["bits", "n"])

        found = classes.select("bits", "n").mapInArrow(search, "bits long, n long")
        out = found if out is None else out.unionByName(found)
    return out.groupBy("bits").agg(F.sum("n").alias("n_near"))


def document_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", query_step: int = 20,
                          radius: int = RADIUS) -> DataFrame:
    """Fingerprints with edits, plus ``class_id`` (smallest id with the same fingerprint) and, for every
    ``query_step``-th id, ``n_near``: how many documents (itself included) lie within the radius."""
    prints = stored(fingerprints_with_edits(docs, id_col, text_col), "fingerprints")
    classes = stored(prints.groupBy("bits").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("n"),
                                                F.max(F.col("doc_id") % query_step == 0).alias("asked")), "classes")
    sums = within_radius(classes, radius)
    found = stored(classes.select("bits", "class_id").join(sums, "bits", "left"), "class-search")
    hexed = lambda c: F.lower(F.lpad(F.hex(c), 16, "0"))
    return prints.join(found, "bits").select(
        "doc_id", "n_chars", "edited_sha256", hexed(F.col("bits")).alias("fingerprint"),
        hexed(F.col("edited_bits")).alias("edited_fingerprint"), "near_edited", "near_next", "class_id",
        F.when(F.col("doc_id") % query_step == 0, F.col("n_near")).alias("n_near"))
