"""Vector code compression: a product codebook fitted by ball k-means.

Vectors become whole numbers ``floor(SCALE * x)`` and are cut into ``parts`` consecutive
parts.  Each part position has a codebook of ``entries`` entries; a vector's code is the index of
the nearest entry at every position.  All sums and distances are exact integers.

Ball k-means.  The members of an entry form a ball around it whose radius is the largest distance
of a member.  By the triangle inequality an entry can only take a member at distance d if it lies
within 2d of the ball's own entry, so

* the ball's *neighbours* are the entries within twice its radius, in order of distance;
* members within half the distance to the first neighbour are the *stable core*: they stay;
* the others lie in *annular rings* between the half distances to successive neighbours, and a
  member in ring k is compared with the first k neighbours only;
* a ball is left alone if neither its entry nor a neighbour has moved.

A task takes the ball of an entry over the members of its batch, whose radius is never
larger than that of the whole ball, so every test is exact.

Distribution: a round is one pass of map tasks over the stored vectors and codes.  It writes the
new codes and, in a folder beside them, the sums and counts of every task; Spark adds those up to
``parts * entries`` rows, which give the next codebook.  The driver holds the codebooks only.
A round's table lies below ``spark.checkpoint.dir`` and is deleted after the next round.

Defined cases: rows whose vector is NULL or holds NULL, NaN or an infinity are left out.  The seeds
are the distinct non-NULL ids in ascending order (of repeated ids the smallest vector); with
fewer than ``entries`` the codebooks are that much smaller.  Rows with a NULL id are coded but are no seeds.  Vectors of
another length than that of the first seed take no part and have a NULL code and error; they count 0 in
``label_error``.  A length that ``parts`` does not divide is cut as evenly as
possible.  Without any seed no row has a code.  An empty table gives no rows.  Components beyond
``LIMIT`` are refused with an error, since a squared distance would not fit 64 bits.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import delete_stored, small_side, stored
from kiln.session import scratch_path

SCALE, PARTS, ENTRIES, ROUNDS = 4096, 8, 16, 6
#: largest magnitude of an integer component: 2**26 such differences squared still fit a long for 512 components a part
LIMIT = 1 << 26


def bounds(length: int, parts: int) -> list[tuple[int, int]]:
    return [(i * length // parts, (i + 1) * length // parts) for i in range(parts)]


def nearest(points: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (ties to the lower one) and its squared distance."""
    best = np.zeros(len(points), np.int64)
    least = ((points - entries[0]) ** 2).sum(axis=1)
    for j in range(1, len(entries)):
        d = ((points - entries[j]) ** 2).sum(axis=1)
        nearer = d < least
        best[nearer], least[nearer] = j, d[nearer]
    return best, least


def reassign(points: np.ndarray, own: np.ndarray, entries: np.ndarray,
             moved: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``nearest``, given each point's entry of the round before and which entries have moved since.

    ``own`` has to be right for the entries before they moved.
    """
    best = own.copy()
    least = ((points - entries[own]) ** 2).sum(axis=1)
    gaps = ((entries[:, None, :] - entries[None, :, :]) ** 2).sum(axis=2)
    for i in range(len(entries)):
        ball = np.flatnonzero(own == i)
        if not len(ball):
            continue
        reach = 4 * least[ball]
        order = np.argsort(gaps[i], kind="stable")
        order = order[order != i]
        near = order[gaps[i][order] <= reach.max()]
        if not len(near) or not (moved[i] or moved[near].any()):
            continue
        rings = np.searchsorted(gaps[i][near], reach, side="right")  # 0: the stable core
        for k, j in enumerate(near):
            asked = ball[rings > k]
            d = ((points[asked] - entries[j]) ** 2).sum(axis=1)
            better = (d < least[asked]) | ((d == least[asked]) & (j < best[asked]))
            best[asked[better]], least[asked[better]] = j, d[better]
    return best, least


def _whole(vector: Column) -> Column:
    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    far = F.exists(whole, lambda x: (x > LIMIT) | (x < -LIMIT))
    return F.when(far, F.raise_error(F.lit(f"a vector component is beyond {LIMIT // SCALE}"))).otherwise(whole)


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return vector.isNotNull() & ~odd


def _packed(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """Kept rows with the vector as packed integers (``body``) and its length."""
    vector = F.col(f"`{vector_col}`")
    rows = vectors.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{label_col}`").alias("label"),
                          vector.alias("vector")).filter(_usable(F.col("vector")))
    rows = rows.select("id", "label", _whole(F.col("vector")).alias("vector"))
    kind = rows.schema["label"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("vector")
            ends = np.asarray(lists.offsets)
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<i4")
            bodies = [flat[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label"), pa.array(np.diff(ends), pa.int32()),
                 pa.array(bodies, pa.binary())], names=["id", "label", "length", "body"])

    return rows.mapInArrow(pack, f"id long, label {kind}, length int, body binary")


def _seeds(rows: DataFrame, entries: int) -> list[np.ndarray]:
    """The vectors of the smallest distinct ids; a task passes on at most ``entries`` ids."""
    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.empty(0, np.int64)
        for batch in batches:
            ids = batch.column("id").drop_null().to_numpy(zero_copy_only=False)
            kept = np.unique(np.concatenate((kept, ids)))[:entries]
        yield pa.RecordBatch.from_arrays([pa.array(kept, pa.int64())], names=["id"])

    def firsts(df: DataFrame) -> list[int]:
        return [r.id for r in df.select("id").mapInArrow(smallest, "id long").distinct().sort("id").limit(entries).collect()]

    def vector_of(ids: list[int], df: DataFrame) -> dict[int, np.ndarray]:
        # by the integers, not by their bytes
        unpacked = F.udf(lambda b: np.frombuffer(b, "<i4").tolist(), "array<int>")
        found = df.filter(F.col("id").isin(ids)).select("id", unpacked("body").alias("v")).groupBy("id").agg(F.min("v").alias("v"))
        return {r.id: np.array(r.v, np.int64) for r in found.collect()}

    first = firsts(rows)
    if not first:
        return []
    length = len(vector_of(first[:1], rows)[first[0]])
    same = rows.filter(F.col("length") == length)
    ids = firsts(same)
    found = vector_of(ids, same)
    return [found[i] for i in ids]


def _round(rows: DataFrame, name: str, books: list[np.ndarray], moved: list[np.ndarray], length: int,
           final: bool) -> tuple[DataFrame, DataFrame, str]:
    """Write new codes; returns the coded rows, the sums by part and entry, and the folder.

    ``rows`` have ``code`` (one byte a part, NULL before the first round) beside the packed vector.
    """
    cuts = bounds(length, len(books))
    kind = rows.schema["label"].dataType.simpleString()
    widest = max(b - a for a, b in cuts)
    schema = (f"sums boolean, id long, label {kind}, length int, body binary, code binary, error long, "
              "part int, entry int, n long, total array<long>")

    def blank(n: int, *types: pa.DataType) -> list[pa.Array]:
        return [pa.nulls(n, t) for t in types]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(book), np.int64) for book in books]
        totals = [np.zeros(book.shape, np.int64) for book in books]
        names = [x.split()[0] for x in schema.split(", ")]
        label_type = None
        for batch in batches:
            label_type = batch.column("label").type
            fit = np.flatnonzero(batch.column("length").to_numpy(zero_copy_only=False) == length)
            codes: list[bytes | None] = [None] * batch.num_rows
            errors: list[int | None] = [None] * batch.num_rows
            if len(fit):
                bodies, before = batch.column("body"), batch.column("code")
                points = np.frombuffer(b"".join(bodies[int(k)].as_py() for k in fit), "<i4").reshape(len(fit), length).astype(np.int64)
                known = before[int(fit[0])].is_valid
                old = np.frombuffer(b"".join(before[int(k)].as_py() for k in fit), np.uint8).reshape(
                    len(fit), len(books)).astype(np.int64) if known else None
                chosen = np.zeros((len(fit), len(books)), np.uint8)
                error = np.zeros(len(fit), np.int64)
                for p, ((a, b), book) in enumerate(zip(cuts, books)):
                    part = points[:, a:b]
                    best, least = reassign(part, old[:, p], book, moved[p]) if known else nearest(part, book)
                    chosen[:, p] = best
                    error += least
                    counts[p] += np.bincount(best, minlength=len(book))
                    order = np.argsort(best, kind="stable")
                    present, starts = np.unique(best[order], return_index=True)
                    totals[p][present] += np.add.reduceat(part[order], starts, axis=0)
                for row, k in enumerate(fit):
                    codes[k], errors[k] = chosen[row].tobytes(), int(error[row])
            n = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array([False] * n), batch.column("id"), batch.column("label"), batch.column("length"),
                 pa.nulls(n, pa.binary()) if final else batch.column("body"), pa.array(codes, pa.binary()),
                 pa.array(errors, pa.int64()), *blank(n, pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()))], names=names)
        used = [(p, e) for p in range(len(books)) for e in np.flatnonzero(counts[p])]
        if used and not final:
            n = len(used)
            sums = [totals[p][e].tolist() + [0] * (widest - totals[p].shape[1]) for p, e in used]
            yield pa.RecordBatch.from_arrays(
                [pa.array([True] * n), *blank(n, pa.int64(), label_type, pa.int32(), pa.binary(), pa.binary(), pa.int64()),
                 pa.array([p for p, _ in used], pa.int32()), pa.array([int(e) for _, e in used], pa.int32()),
                 pa.array([int(counts[p][e]) for p, e in used], pa.int64()), pa.array(sums, pa.list_(pa.int64()))], names=names)

    spark = rows.sparkSession
    path = scratch_path(spark, name)
    rows.select("id", "label", "length", "body", "code").mapInArrow(work, schema).write.partitionBy("sums").parquet(path)
    out = spark.read.schema(schema).parquet(path)
    coded = out.filter(~F.col("sums")).select("id", "label", "length", "body", "code", "error")
    # sums of many tasks may pass 64 bits
    added = (out.filter("sums").select("part", "entry", "n", F.posexplode("total").alias("at", "x"))
             .groupBy("part", "entry", "at").agg(F.sum(F.col("x").cast("decimal(38,0)")).alias("x"), F.sum("n").alias("n")))
    return coded, added, path


def fit_codebooks(packed: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
                  rounds: int = ROUNDS) -> tuple[list[np.ndarray], DataFrame, str]:
    """The final codebooks, the rows with their final code and error, and the folder of the latter."""
    seeds = _seeds(packed, entries)
    length = len(seeds[0]) if seeds else 0
    table = np.array(seeds, np.int64).reshape(len(seeds), length)
    books = [table[:, a:b].copy() for a, b in bounds(length, parts)]
    moved = [np.ones(len(book), bool) for book in books]
    if not seeds:
        done = packed.select("id", "label", F.lit(None).cast("binary").alias("code"), F.lit(None).cast("long").alias("error"))
        return books, done, ""
    rows, last = packed.withColumn("code", F.lit(None).cast("binary")), ""
    for k in range(rounds):
        rows, added, path = _round(rows, f"codes-{k}", books, moved, length, final=False)
        new = [book.copy() for book in books]
        for r in added.collect():  # parts * entries * width rows
            if r["at"] < new[r["part"]].shape[1]:
                new[r["part"]][r["entry"], r["at"]] = int(r["x"]) // r["n"]
        moved = [(a != b).any(axis=1) for a, b in zip(books, new)]
        books = new
        if last:
            delete_stored(packed.sparkSession, last)
        last = path
    coded, _, path = _round(rows, "codes-final", books, moved, length, final=True)
    if last:
        delete_stored(packed.sparkSession, last)
    return books, coded, path


def codebooks_digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for book in books for x in book.ravel().tolist()).encode()).hexdigest()


def vector_codes(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """``vec_id, code, error, label, label_error, codebooks_sha256`` of every kept row."""
    packed = stored(_packed(vectors, id_col, vector_col, label_col), "vectors")
    books, coded, _ = fit_codebooks(packed, parts, entries, rounds)
    labels = stored(coded.groupBy("label").agg(F.coalesce(F.sum("error"), F.lit(0)).alias("label_error"))
                    .withColumnRenamed("label", "__label"), "label-errors")
    return (coded.join(small_side(labels), F.col("label").eqNullSafe(F.col("__label")), "left")
            .select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label", "label_error",
                    F.lit(codebooks_digest(books)).alias("codebooks_sha256")))
