"""Near-duplicate documents by a signature-coordinate inverted join.

1. Every text becomes its set of five-word shingles (64-bit hashes) and a
   MinHash signature of ``coordinates`` values.  Documents with equal sets form
   one class, represented by its smallest ``doc_id``.
2. Two sets with similarity s agree on about ``s * coordinates`` values, so a
   linked pair shares at least ``threshold`` of them (the threshold lies
   ``MARGIN`` standard deviations below the mean).  Each class is posted under
   coordinate-value pairs, but only under its ``coordinates - threshold + 1``
   rarest ones (prefix): a pair with ``threshold`` common values must meet in
   one of those lists.  The long lists are *skipped* while candidates are
   sought; their collisions are counted afterwards from the two signatures.
   Rarity comes from a sketch of value counts over all documents; any common
   order is right, a good one keeps the lists short.
3. Merging a list of n documents does not make its n**2 pairs.  First each
   member meets the list's smallest member; pairs that reach the threshold
   are confirmed on their full sets and give components.  What is left are
   lists that still hold several components: their members outside the largest
   component are compared, in blocks of bounded size, with all members
   of similar set size, and only the links found leave a block.
4. Links of both steps give the final components.

Defined cases: a NULL or empty text (or one without words) has an empty set
and is linked with nothing; a text of fewer than five words has one shingle;
rows with the same ``doc_id`` count as one document; a NULL ``doc_id`` is
linked with nothing; an empty table gives an empty result; other columns are
ignored by ``near_duplicate_components`` and kept by ``one_per_group``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import lean_steps, process_wide, small_side, stored
from kiln.llm.components import components

WORDS = 5
COORDINATES = 128
#: standard deviations of the number of agreeing coordinates left as room
MARGIN = 3.5
#: buckets of the value-count sketch (a fixed size: one byte each is broadcast)
SKETCH_BITS = 17
#: members of a list block that are compared at once, and the sum of their set sizes (about)
BLOCK, BLOCK_SHINGLES = 512, 1 << 21
#: rows and bytes (one row at least) that Python gets at once
BATCH_ROWS, BATCH_BYTES = 2_000, 8 << 20

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)


class _WordHashes(dict):
    """Word to 64-bit hash; emptied when it grows too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 200_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def word_hashes(words: list[bytes]) -> np.ndarray:
    known = process_wide("word hashes", _WordHashes)
    return np.fromiter(map(known.__getitem__, words), np.uint64, len(words))


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, words: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the ``words``-word shingles of a UTF-8 text, A-Z in lower case.

    ``bytes.split()`` cuts at blank, tab, line feed, vertical tab, form feed
    and carriage return and nothing else.
    """
    found = (text or b"").translate(_LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    h = word_hashes(found)
    width = min(words, len(h))
    last = len(h) - width + 1
    s = np.full(last, width, np.uint64)
    for j in range(width):
        s = s * _STEP + h[j:j + last]
    return np.unique(_mix(s))


def _signature(shingles: np.ndarray, adds: np.ndarray, factors: np.ndarray) -> np.ndarray:
    """The high 32 bits of the smallest value of each hash function."""
    low = np.full(len(adds), np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[None, i:i + 2048]
        np.minimum(low, ((part ^ adds) * factors).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype("<u4")


def _functions(coordinates: int) -> tuple[np.ndarray, np.ndarray]:
    n = np.arange(1, coordinates + 1, dtype=np.uint64)[:, None]
    return _mix(n * _STEP), _mix(n * _M1) | np.uint64(1)


def match_threshold(similarity: float, coordinates: int) -> int:
    spread = math.sqrt(coordinates * similarity * (1 - similarity))
    return max(1, math.floor(coordinates * similarity - MARGIN * spread))


def _signatures(docs: DataFrame, coordinates: int) -> DataFrame:
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        adds, factors = _functions(coordinates)
        for batch in batches:
            sizes, digests, signatures = [], [], []
            for text in batch.column("text"):
                shingles = shingle_set(text.as_py())
                sizes.append(len(shingles))
                digests.append(xxhash.xxh3_128_digest(shingles.tobytes()) if len(shingles) else None)
                signatures.append(_signature(shingles, adds, factors).tobytes() if len(shingles) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()),
                 pa.array(digests, pa.binary()), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "digest", "signature"])

    return docs.mapInArrow(sign, "doc_id long, n_shingles long, digest binary, signature binary")


def _sketch_bucket(values: np.ndarray) -> np.ndarray:
    """Bucket of every coordinate-value pair; ``values`` has one row per document."""
    coordinate = np.arange(values.shape[1], dtype=np.uint64)[None, :] * _M2
    return (((values.astype(np.uint64) + coordinate) * _STEP) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)


def _values(column: pa.Array, coordinates: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, coordinates)


def _rarity_levels(classes: DataFrame, coordinates: int) -> bytes:
    """One byte per sketch bucket: the logarithm of how far its count is above the mean.

    Each task counts its own values, the counts are summed by bucket; what
    comes to the driver has 2**SKETCH_BITS entries whatever the data's size.
    """
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << SKETCH_BITS, np.int64)
        for batch in batches:
            total += np.bincount(_sketch_bucket(_values(batch.column("signature"), coordinates)).ravel(),
                                 minlength=1 << SKETCH_BITS)
        hit = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(hit, pa.int32()), pa.array(total[hit], pa.int64())],
                                         names=["bucket", "n"])

    sums = (classes.select("signature").mapInArrow(count, "bucket int, n long")
            .groupBy("bucket").agg(F.sum("n").alias("n"))).toPandas()
    levels = np.zeros(1 << SKETCH_BITS, np.uint8)
    if len(sums):
        above = np.maximum(sums["n"].to_numpy() / max(1.0, sums["n"].sum() / (1 << SKETCH_BITS)), 1.0)
        levels[sums["bucket"].to_numpy()] = np.floor(2 * np.log2(above))
    return levels.tobytes()


def _postings(classes: DataFrame, levels: bytes, coordinates: int, prefix: int) -> DataFrame:
    shared = classes.sparkSession.sparkContext.broadcast(levels)

    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = np.frombuffer(shared.value, np.uint8)
        order = np.arange(coordinates)[None, :]
        for batch in batches:
            values = _values(batch.column("signature"), coordinates)
            rank = level[_sketch_bucket(values)].astype(np.int64) * coordinates + order
            first = np.argpartition(rank, prefix - 1, axis=1)[:, :prefix]
            keys = (first.astype(np.int64) << 32) | np.take_along_axis(values, first, 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.ravel()), *[pa.array(np.repeat(batch.column(c).to_numpy(), prefix))
                                           for c in ("node", "n_shingles")]], names=["key", "node", "n_shingles"])

    return classes.select("node", "n_shingles", "signature").mapInArrow(post, "key long, node long, n_shingles long")


def _common(a: np.ndarray, b: np.ndarray) -> int:
    return len(np.intersect1d(a, b, assume_unique=True))


def _linked(common: int | np.ndarray, n_a: int | np.ndarray, n_b: int | np.ndarray, percent: int):
    return 100 * common >= percent * (n_a + n_b - common)


def _matching(pairs: DataFrame, classes: DataFrame, threshold: int, percent: int) -> DataFrame:
    """Pairs ``(a, b)`` that agree on at least ``threshold`` coordinates and are of similar size."""
    side = lambda x: classes.select(F.col("node").alias(x), F.col("n_shingles").alias(f"n_{x}"),
                                    F.col("signature").alias(f"s_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").filter(
        F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u4").reshape(batch.num_rows, -1)
                        for c in ("s_a", "s_b"))
                yield batch.filter(pa.array((a == b).sum(axis=1) >= threshold)).select(["a", "b"])

    return both.mapInArrow(keep, "a long, b long")


def _texts_of(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """``(node, text)`` of the given classes: the representative's text."""
    return docs.join(small_side(nodes), docs["doc_id"] == nodes["node"]).select("node", "text")


def _confirmed(pairs: DataFrame, docs: DataFrame, percent: int) -> DataFrame:
    """Pairs whose full shingle sets reach the similarity."""
    nodes = stored(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "candidate-nodes")
    texts = stored(_texts_of(docs, nodes), "candidate-texts")
    side = lambda x: texts.select(F.col("node").alias(x), F.col("text").alias(f"t_{x}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in batches:
            hit = []
            for a, t_a, t_b in zip(batch.column("a").to_pylist(), batch.column("t_a"), batch.column("t_b")):
                if a != last:
                    last, own = a, shingle_set(t_a.as_py())
                other = shingle_set(t_b.as_py())
                hit.append(_linked(_common(own, other), len(own), len(other), percent))
            yield batch.filter(pa.array(hit, pa.bool_())).select(["a", "b"])

    return both.mapInArrow(confirm, "a long, b long")


def _low_bytes(classes: DataFrame) -> DataFrame:
    """``(node, n_shingles, low)``: the low byte of each signature value.  Equal values have equal bytes,
    so counting equal bytes never misses a collision."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [np.frombuffer(s, "<u4").astype(np.uint8).tobytes() for s in batch.column("signature").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("node"), batch.column("n_shingles"), pa.array(low, pa.binary())],
                                             names=["node", "n_shingles", "low"])

    return classes.mapInArrow(cut, "node long, n_shingles long, low binary")


def _hits(group: dict, threshold: int, percent: int) -> list[tuple[int, np.ndarray]]:
    """``(i, js)``: for the asking members of a block the members of other components that collide often enough.

    A pair meets in many lists.  It is looked at only in the first of its
    common lists, long lists first (``keys`` has every member's lists in that
    order), so a group of near copies is settled in one or two of them.
    """
    low = np.array([np.frombuffer(x, np.uint8) for x in group["low"]])
    sizes, labels = np.array(group["n_shingles"]), np.array(group["label"])
    width = max(map(len, group["keys"]))
    keys = np.array([k + [-1] * (width - len(k)) for k in group["keys"]], np.int64)
    here, out = np.array(group["key"]), []
    asks = np.array(group["asks"])
    for i in np.flatnonzero(asks):
        same = labels != labels[i]
        same &= np.minimum(sizes, sizes[i]) * 100 >= np.maximum(sizes, sizes[i]) * percent
        same[:i] &= ~asks[:i]  # two asking members meet once
        js = np.flatnonzero(same)
        js = js[(low[js] == low[i]).sum(axis=1) >= threshold]
        if len(js):
            common = np.isin(keys[js], keys[i]) & (keys[js] >= 0)
            first = np.take_along_axis(keys[js], common.argmax(axis=1)[:, None], 1)[:, 0]
            js = js[first == here[i]]
        if len(js):
            out.append((int(i), js))
    return out


def _block_links(group: dict, texts: pa.ChunkedArray, threshold: int, percent: int) -> list[tuple[int, int]]:
    """Links that join different components among the members of one block.

    ``texts`` stays in Arrow: one text at a time becomes a Python object.  The candidates are confirmed on full sets, all at once by products of
    document-by-shingle tables over bounded slices of the shingles.
    """
    hits = _hits(group, threshold, percent)
    used = sorted({i for i, _ in hits} | {int(j) for _, js in hits for j in js})
    if not used:
        return []
    place = {i: k for k, i in enumerate(used)}
    sets = [shingle_set(texts[i].as_py()) for i in used]
    sizes = np.array([len(x) for x in sets])
    every, which = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(len(sets)), sizes)
    shared = np.flatnonzero(np.bincount(which, minlength=len(every)) > 1)
    column = np.full(len(every), -1)
    column[shared] = np.arange(len(shared))
    inside = column[which] >= 0
    owner, which = owner[inside], column[which[inside]]
    common = np.zeros((len(sets), len(sets)), np.float64)
    for start in range(0, len(shared), 4096):
        part = (which >= start) & (which < start + 4096)
        table = np.zeros((len(sets), min(4096, len(shared) - start)), np.float32)
        table[owner[part], which[part] - start] = 1
        common += table @ table.T

    root: dict[int, int] = {}

    def find(x: int) -> int:
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    out = []
    for i, js in hits:
        for j in js.tolist():
            a, b = find(group["label"][i]), find(group["label"][j])
            p, q = place[i], place[j]
            if a != b and _linked(int(common[p, q]), int(sizes[p]), int(sizes[q]), percent):
                root[max(a, b)] = min(a, b)
                out.append((group["node"][i], group["node"][j]))
    return out


_SEAT = ("pair", "key", "node", "label", "asks", "n_shingles", "low", "keys")


def _links_in_lists(members: DataFrame, classes: DataFrame, docs: DataFrame,
                    threshold: int, percent: int) -> DataFrame:
    """Links between different components that meet in one list.

    ``members(key, node, n_shingles, label)``.  A list of up to ``BLOCK`` members
    with ``BLOCK_SHINGLES`` shingles together is one block.  A larger one is cut by
    set size (a class spans one similarity step, so linked sets lie in the same or
    the next class) and by a hash into parts that are bounded in both; only members outside the list's largest component need asking, and
    their parts meet all parts of a near size.  First only signature bytes are
    brought together; texts follow for the members that collide.
    """
    labels = members.groupBy("key", "label").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
    lists = labels.groupBy("key").agg(F.max_by("label", F.struct("n", "label")).alias("largest"), F.sum("n").alias("n"),
                                      F.sum("w").alias("w"), F.count(F.lit(1)).alias("kinds"))
    lists = lists.filter("kinds > 1").drop("kinds")
    low = _low_bytes(classes)
    opened = stored(members.join(lists, "key").select(
        "key", "node", "n_shingles", "label", "n", "w", (F.col("label") != F.col("largest")).alias("asks")), "open-lists")
    # a node is in as many lists as its prefix is long at most
    nodes = opened.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(
        F.struct((-F.col("n")).alias("n"), "key"))), lambda x: x["key"]).alias("keys"))
    nodes = stored(nodes.join(low, "node"), "open-nodes")

    in_one = (F.col("n") <= BLOCK) & (F.col("w") <= BLOCK_SHINGLES)
    short = opened.filter(in_one).select(F.xxhash64("key").alias("pair"), "key", "node", "label", "asks")
    long = opened.filter(~in_one).withColumn("step", F.floor(F.log("n_shingles") / math.log(100 / percent)))
    counts = (long.groupBy("key", "step", "asks").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("w"))
              .withColumn("parts", F.least("n", F.ceil(2 * F.greatest(F.col("n") / BLOCK, F.col("w") / BLOCK_SHINGLES)))
                          .cast("int")).drop("n", "w"))
    placed = long.join(counts, ["key", "step", "asks"]).withColumn(
        "part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    part = counts.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    ask = part.filter("asks").select("key", F.col("step").alias("a_step"), F.col("part").alias("a_part"))
    other = part.select("key", F.col("step").alias("b_step"), F.col("asks").alias("b_asks"),
                        F.col("part").alias("b_part"))
    near = ask.join(other, "key").filter(F.abs(F.col("a_step") - F.col("b_step")) <= 1)
    # two asking parts meet once
    near = near.filter("not b_asks or a_step < b_step or (a_step = b_step and a_part <= b_part)")
    near = near.withColumn("pair", F.xxhash64("key", "a_step", "a_part", "b_step", "b_asks", "b_part"))
    seats = near.select(
        "key", "pair",
        F.explode(F.array_distinct(F.array(
            F.struct(F.col("a_step").alias("step"), F.lit(True).alias("asks"), F.col("a_part").alias("part")),
            F.struct(F.col("b_step").alias("step"), F.col("b_asks").alias("asks"), F.col("b_part").alias("part"))
        ))).alias("s")).select("key", "pair", "s.step", "s.asks", "s.part")
    seated = placed.join(seats, ["key", "step", "asks", "part"]).select("pair", "key", "node", "label", "asks")
    seated = seated.unionByName(short).join(nodes, "node").select(*_SEAT)

    def colliding(key: tuple, group: pa.Table) -> pa.Table:
        hits = _hits(group.to_pydict(), threshold, percent)
        return group.take(pa.array(sorted({i for i, _ in hits} | {int(j) for _, js in hits for j in js}), pa.int64()))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in seated.schema.fields)
    rest = stored(seated.groupBy("pair").applyInArrow(colliding, schema), "colliding")
    wanted = stored(rest.select("node").distinct(), "colliding-nodes")

    def links(key: tuple, group: pa.Table) -> pa.Table:
        found = _block_links(group.drop_columns("text").to_pydict(), group.column("text"), threshold, percent)
        return pa.table({"a": pa.array([a for a, _ in found], pa.int64()),
                         "b": pa.array([b for _, b in found], pa.int64())})

    return (rest.join(stored(_texts_of(docs, wanted), "colliding-texts"), "node")
            .groupBy("pair").applyInArrow(links, "a long, b long"))


def _same_id(known: DataFrame, owners: DataFrame) -> DataFrame:
    """Edges between the classes of different texts that carry one ``doc_id``."""
    several = known.groupBy("doc_id").agg(F.min("digest").alias("lo"), F.max("digest").alias("hi"))
    several = stored(several.filter("lo <> hi").select(F.col("doc_id").alias("a")), "several-texts")
    return (known.join(small_side(several), F.col("doc_id") == F.col("a")).select("a", "digest")
            .join(owners, "digest").select("a", F.col("node").alias("b")).filter("a <> b").distinct())


def near_duplicate_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                              percent: int = 85, coordinates: int = COORDINATES) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row of ``docs``."""
    with lean_steps(docs.sparkSession, BATCH_ROWS, BATCH_BYTES):
        return _components_of(docs, id_col, text_col, percent, coordinates)


def _components_of(docs: DataFrame, id_col: str, text_col: str, percent: int, coordinates: int) -> DataFrame:
    """All steps with Python code are stored here; what is returned only joins their tables."""
    threshold = match_threshold(percent / 100, coordinates)
    prefix = coordinates - threshold + 1
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").cast("binary").alias("text"))
    signed = stored(_signatures(docs, coordinates), "signatures")
    known = signed.filter("doc_id is not null and digest is not null")
    owners = stored(known.groupBy("digest").agg(F.min("doc_id").alias("node")), "classes")
    classes = stored(known.join(owners.withColumnRenamed("digest", "d"),
                                (F.col("digest") == F.col("d")) & (F.col("doc_id") == F.col("node")))
                     .dropDuplicates(["node", "digest"]).select("node", "n_shingles", "signature"),
                     "representatives")

    levels = _rarity_levels(classes, coordinates)
    postings = stored(_postings(classes, levels, coordinates, prefix), "postings")
    lists = postings.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("node").alias("hub")).filter("n > 1")
    members = stored(postings.join(lists, "key").filter("node <> hub").select("key", "n", "hub", "node", "n_shingles"),
                     "list-members")
    pairs = stored(members.select(F.col("hub").alias("a"), F.col("node").alias("b")).distinct(), "hub-pairs")
    links = stored(_confirmed(stored(_matching(pairs, classes, threshold, percent), "matching"), docs, percent),
                   "hub-links")
    links = links.unionByName(_same_id(known, owners))
    found = stored(components(links), "components")

    rest = (members.filter("n > 2").select("key", "node", "n_shingles").join(found, "node", "left")
            .select("key", "node", "n_shingles", F.coalesce("component", "node").alias("label")))
    more = stored(_links_in_lists(rest, classes, docs, threshold, percent), "list-links")
    if more.limit(1).count():
        found = stored(components(links.unionByName(more)), "components")

    owners = owners.join(found, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    return (signed.join(owners, "digest", "left")
            .select("doc_id", "n_shingles",
                    F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id"))))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of ``docs`` that stay: of each group of near-duplicates the document with the smallest id.

    Rows without an id and documents without words all stay; of equal rows
    (id and text) one stays.
    """
    cols = docs.columns
    found = stored(near_duplicate_components(docs, id_col, text_col, **options), "near-duplicates")
    gone = stored(found.filter("not kept").select(F.col("doc_id").alias("__gone")).distinct(), "removed")
    twice = stored(found.filter("kept and doc_id is not null").groupBy(F.col("doc_id").alias("__twice"))
                   .agg(F.count(F.lit(1)).alias("__n")).filter("__n > 1").drop("__n"), "repeated")
    own = F.col(f"`{id_col}`").cast("long")
    kept = docs.join(small_side(gone), own == F.col("__gone"), "left_anti")
    if twice.limit(1).count():
        again = kept.join(small_side(twice), own == F.col("__twice"), "left_semi").dropDuplicates([id_col, text_col])
        kept = kept.join(small_side(twice), own == F.col("__twice"), "left_anti").unionByName(again)
    return kept.select(*[F.col(f"`{c}`") for c in cols])
