"""Substring dedup by line hashing.

Lines are cut after sentence ends: a passage is often pasted into the middle of
a line, where a digest of the whole line would miss it.  Every such unit of at
least ``min_words`` words is normalised (lower case, white space runs as one
blank) and hashed to 128 bits.  Digests are grouped over the whole corpus; the
occurrence that ranks first (smallest id, then position) stays and all others
are removed.  Offsets are code points of the original text, so a removal can be
undone or applied to annotations.

Scale: the count and the first rank of a digest are aggregates combined on the
map side; only digests that occur more than once are joined back, a very
common one being a skewed key that AQE splits.  No task sees all occurrences
of a unit.

Defined cases: a NULL or empty text has no units; equal rows are separate
documents, the first keeps its units; rows without an id rank last; other
columns are kept by ``without_repeats``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kiln.llm.common import stored

#: shorter units repeat by chance and are never removed
MIN_WORDS = 7

#: one unit with what separates it from the next; the matches follow each other without gaps
_UNIT = re.compile(r"\n|[^\n]+?(?:[.!?][ \t]+|\n|\Z)")


def units_of(text: str | None, min_words: int) -> list[tuple[int, int, int, int, bytes]]:
    """``(unit, start, end, words, digest)`` of the units with at least ``min_words`` words.

    The span takes the blanks after a sentence with it, but leaves the line feed.
    """
    out = []
    for number, found in enumerate(_UNIT.finditer(text or "")):
        words = found[0].lower().split()
        if len(words) >= min_words:
            out.append((number, found.start(), found.end() - found[0].endswith("\n"), len(words),
                        hashlib.md5(" ".join(words).encode("utf-8", "replace")).digest()))
    return out


def _units(rows: DataFrame, min_words: int) -> DataFrame:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows_, units = [], [], []
            for doc, row, text in zip(batch.column("doc_id").to_pylist(), batch.column("row").to_pylist(),
                                      batch.column("text")):
                found = units_of(text.as_py(), min_words)
                ids += [doc] * len(found)
                rows_ += [row] * len(found)
                units += found
            columns = list(zip(*units)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows_, pa.int64()),
                 *[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.binary())],
                names=["doc_id", "row", "unit", "start", "end", "words", "digest"])

    return rows.select("doc_id", "row", "text").mapInArrow(
        cut, "doc_id long, row long, unit long, start long, end long, words long, digest binary")


def repeated_units(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   min_words: int = MIN_WORDS, row: str | None = None) -> DataFrame:
    """One row per removed unit: ``(doc_id, unit, start, end, words, digest, kept_doc_id, kept_unit)``.

    ``row`` names a column of ``docs`` that tells equal rows apart; it is returned too.
    """
    number = F.col(row) if row else F.monotonically_increasing_id()
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"), number.alias("row"))
    units = stored(_units(rows, min_words), "units")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "unit", "row")
    first = (units.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min(rank).alias("first"))
             .filter("n > 1").select("digest", F.col("first.doc_id").alias("kept_doc_id"),
                                     F.col("first.unit").alias("kept_unit"), F.col("first.row").alias("kept_row")))
    first = stored(first, "repeated-units")
    removed = units.join(first, "digest").filter("row <> kept_row or unit <> kept_unit")
    return removed.select("doc_id", *(["row"] if row else []), "unit", "start", "end", "words",
                          F.lower(F.hex("digest")).alias("digest"), "kept_doc_id", "kept_unit")


def without_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with repeated units cut from the text, and ``removed``: their original spans in order."""
    cols = [c for c in docs.columns if c != "removed"]
    rows = stored(docs.select(*[F.col(f"`{c}`") for c in cols], F.monotonically_increasing_id().alias("__row")),
                  "unit-rows")
    spans = (repeated_units(rows, id_col, text_col, min_words, row="__row")
             .groupBy(F.col("row").alias("__at"))
             .agg(F.sort_array(F.collect_list(F.struct("unit", "start", "end"))).alias("removed")))
    joined = rows.join(spans, F.col("__row") == F.col("__at"), "left")
    # what is kept lies between the removed spans
    old = F.col(f"`{text_col}`")
    starts = F.concat(F.array(F.lit(0).cast("long")), F.transform("removed", lambda x: x["end"]))
    ends = F.concat(F.transform("removed", lambda x: x["start"]), F.array(F.length(old).cast("long")))
    kept = F.zip_with(starts, ends, lambda a, b: F.substring(old, (a + 1).cast("int"), (b - a).cast("int")))
    text = F.when(F.col("removed").isNull(), old).otherwise(F.array_join(kept, ""))
    return joined.withColumn(text_col, text).select(
        *[F.col(f"`{c}`") for c in cols], F.coalesce("removed", F.array().cast(
            "array<struct<unit:bigint,start:bigint,end:bigint>>")).alias("removed"))
