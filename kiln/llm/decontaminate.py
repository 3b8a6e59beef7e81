"""Benchmark decontamination by pigeonhole edit matching.

A document is contaminated by a test item if some stretch of it is within
``errors(item)`` edits (insert, delete, replace a character) of the item.
Both are normalised first: lower case, every run of ASCII punctuation and
white space one blank.

* Pigeonhole: an item is cut into ``errors + 1`` pieces; a stretch within the
  budget contains at least one piece unchanged.
* One Aho-Corasick automaton finds all exact piece hits of a text in one
  scan.  A hit fixes where the item would lie, give or take the budget.
* That window is verified by Myers' bit-parallel edit distance: one
  column of the table is two integers as wide as the item.

Scale: documents are only scanned, never shuffled.  The benchmark is a table of
its own: equal items are one, and its distinct texts are read in blocks of about ``BLOCK_CHARS`` characters (counted
first), each block one scan.  A task holds the automaton of one block, whatever the size of the benchmark; the
driver holds the texts of one block at a time and builds no automaton, but the blocks it has broadcast
stay with Spark until the plan has run.

Defined cases: a NULL or empty text matches nothing, a NULL or empty item is
matched by nothing; an item of under ``CHARS_PER_ERROR`` characters has to occur as
it is, as whole words; equal items and equal documents are all reported.  Short items are found in ordinary
text by chance: an item of fewer than ``REMOVAL_CHARS`` normalised characters is reported, but
``without_leaks`` removes no document for it.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: one edit is allowed for so many characters of the normalised item
CHARS_PER_ERROR = 12
#: characters of benchmark text held by one automaton
BLOCK_CHARS = 4_000_000
#: normalised characters that an item needs for documents to be removed on it (two errors; about four words)
REMOVAL_CHARS = 24

_PLAIN = bytes(32 if c < 48 or 58 <= c < 65 or 91 <= c < 97 or 123 <= c < 128 else c for c in range(256))


def normalised(text: str | None) -> str:
    return b" ".join((text or "").lower().encode("utf-8", "replace").translate(_PLAIN).split()).decode()


def errors(length: int) -> int:
    return length // CHARS_PER_ERROR


def pieces(item: str, parts: int) -> list[tuple[int, str]]:
    """``(offset, piece)``: the item cut into ``parts`` pieces of nearly equal length."""
    edges = [len(item) * k // parts for k in range(parts + 1)]
    return [(a, item[a:b]) for a, b in zip(edges, edges[1:])]


def _masks(pattern: str) -> dict[str, int]:
    masks: dict[str, int] = {}
    for i, c in enumerate(pattern):
        masks[c] = masks.get(c, 0) | 1 << i
    return masks


def best_end(masks: dict[str, int], length: int, text: str) -> tuple[int, int]:
    """``(distance, end)`` of the stretch of ``text`` nearest to the pattern (the first of equals).

    Myers' recurrence: ``plus`` and ``minus`` are the vertical differences of a column as bits.
    """
    full, top = (1 << length) - 1, 1 << (length - 1)
    plus, minus, score = full, 0, length
    best, end = length, 0
    for j, c in enumerate(text, 1):
        eq = masks.get(c, 0)
        vertical = eq | minus
        horizontal = (((eq & plus) + plus) ^ plus) | eq
        up = minus | ~(horizontal | plus) & full
        down = plus & horizontal
        if up & top:
            score += 1
        elif down & top:
            score -= 1
        up = up << 1 & full  # a stretch may begin anywhere: no difference along the first row
        down = down << 1 & full
        plus = down | ~(vertical | up) & full
        minus = up & vertical
        if score < best:
            best, end = score, j
    return best, end


class Matcher:
    """Finds the items of one benchmark block in a text."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items, owners = [], {}
        for item_id, text in items:
            plain = normalised(text)
            if plain:
                k = errors(len(plain))
                plain, cut = (plain, pieces(plain, k + 1)) if k else (f" {plain} ", [(0, f" {plain} ")])
                for offset, piece in cut:
                    owners.setdefault(piece, []).append((len(self.items), offset))
                self.items.append((item_id, plain, k, _masks(plain), _masks(plain[::-1])))
        self.automaton = ahocorasick.Automaton()
        for piece, places in owners.items():
            self.automaton.add_word(piece, (len(piece), places))
        if owners:
            self.automaton.make_automaton()

    def find(self, text: str | None, first_only: bool = False) -> list[tuple[int, int, int, int]]:
        """``(item_id, distance, start, end)``: the nearest stretch per item, in the normalised text."""
        if not self.items or not text:
            return []
        text = f" {normalised(text)} "
        found: dict[int, tuple[int, int, int]] = {}
        tried: set[tuple[int, int]] = set()
        for last, (length, places) in self.automaton.iter(text):
            for which, offset in places:
                at = last + 1 - length - offset
                if (which, at) in tried or found.get(which, (1,))[0] == 0:
                    continue
                tried.add((which, at))
                _, plain, k, masks, back = self.items[which]
                n = len(plain)
                if at >= 0 and text.startswith(plain, at):
                    hit = (0, at, at + n)
                else:
                    lo = max(0, at - k)
                    window = text[lo:at + n + k]
                    distance, end = best_end(masks, n, window)
                    if distance > k:
                        continue
                    _, size = best_end(back, n, window[:end][::-1])
                    hit = (distance, lo + end - size, lo + end)
                if hit < found.get(which, (k + 1,)):
                    found[which] = hit
                if first_only:
                    return [(self.items[which][0], *hit)]
        # one blank stands before the normalised text
        return [(self.items[w][0], d, max(0, a - 1), b - 1) for w, (d, a, b) in sorted(found.items())]


def _items(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return benchmark.select(F.col(f"`{id_col}`").cast("long").alias("item_id"),
                            F.col(f"`{text_col}`").cast("string").alias("item")).filter("item is not null")


def _blocks(items: DataFrame) -> Iterator[list[str]]:
    """The distinct texts of the items in lists of bounded size."""
    texts = items.select("item").distinct()
    chars = texts.agg(F.sum(F.length("item"))).first()[0] or 0
    parts = -(-chars // BLOCK_CHARS) if chars > BLOCK_CHARS else 1
    for part in range(parts):
        block = texts if parts == 1 else texts.filter(F.pmod(F.xxhash64("item"), F.lit(parts)) == part)
        yield [r["item"] for r in block.orderBy("item").collect()]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """``(doc_id, item_id, distance, start, end)`` for every contaminated document and item.

    Offsets are characters of the normalised text.
    """
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").cast("string").alias("text"))
    items = _items(benchmark, item_col, item_text_col)
    out = None
    for block in _blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(block)

        def find(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            own = Matcher(list(enumerate(shared.value)))
            for batch in batches:
                hits = [(doc, shared.value[which], *hit)
                        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"))
                        for which, *hit in own.find(text.as_py())]
                columns = list(zip(*hits)) or [()] * 5
                kinds = (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                                 names=["doc_id", "item", "distance", "start", "end"])

        part = rows.mapInArrow(find, "doc_id long, item string, distance long, start long, end long")
        out = part if out is None else out.unionByName(part)
    # every item with that text is leaked
    return out.join(items, "item").select("doc_id", "item_id", "distance", "start", "end")


def _cleaner(shared: Broadcast):
    """A test for texts in which none of the broadcast items occurs."""
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        own = Matcher(shared.value)
        for texts in batches:
            yield pd.Series([not own.find(t, first_only=True) for t in texts], dtype=bool)

    return clean


def without_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that no item of ``REMOVAL_CHARS`` normalised characters or more contaminates."""
    for block in _blocks(_items(benchmark, item_col, item_text_col)):
        long_items = [(k, item) for k, item in enumerate(block) if len(normalised(item)) >= REMOVAL_CHARS]
        clean = _cleaner(docs.sparkSession.sparkContext.broadcast(long_items))
        docs = docs.filter(clean(F.col(f"`{text_col}`").cast("string")))
    return docs
