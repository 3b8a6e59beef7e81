"""Phrase collocation mining with one FM-index per shard.

Texts become pieces (cut at punctuation and line ends) and words; a phrase is a run of words inside a
piece.  A map task gathers the texts of its input split into shards of about ``SHARD_WORDS`` words
and builds a bidirectional FM-index of each over the shard's own word ids (a word id stands
for a word in a language, so one shard serves all languages): the Burrows-Wheeler
transforms of the words and of the words read backwards, sorted by contexts of ``DEPTH`` words, which is
all that phrases of that length need.  The indexes are a stored table.

Enumeration.  A phrase is an interval in both transforms.  ``BiIndex.extend`` extends all intervals
of a level at once by one word to the left or right and keeps both intervals in step: the words found in
the one interval are the extensions, their numbers the counts.

1. Intervals of single words are extended to the right once: words and word pairs, with counts.  Counts are summed
   across shards; a pair lives on if it reaches the minimum over all shards of its language.
2. Living pairs are extended to the right, and those threes to the left, as long as every pair inside
   lives (a phrase occurs no more often than its parts).  Counts are summed again.
3. The living phrases of all lengths are written out in words and summed for good.

Sums between 1 and 3 are by a hash of language and words (the range and 32 bits inside of it); two phrases that share one can only
make a phrase live on too long, and step 3 counts words.  What is shuffled are a shard's distinct
phrases, as packed arrays by range of hashes, so a very common word, phrase or copied text is one entry per shard
and ranges are even.  A task that sums a range answers each shard which of its own entries live.  Nothing is
broadcast but stored tables of fewer than ``SMALL`` counted rows.

Scoring is grouped SQL: a phrase is joined with the counts of its parts at every cut, the least score counts,
and a phrase is dropped if a longer one contains it and occurs almost as often (its left and
right extensions).  All arithmetic is in whole numbers of 38 digits.

Defined cases: a NULL text is empty; a NULL language is ``und``; a text without words counts
nothing; rows with equal ids or NULL ids are texts of their own (ids are not read); an empty table gives no rows.
A piece without any cut stays in one shard, however long.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import lean_steps, small_side, stored

DEPTH, MIN_COUNT, TOP = 4, 30, 2000
#: a phrase is part of a longer one if that has this share (per cent) of its occurrences
CONTAINED = 80
SCALE = 2_000_000
#: words of a shard (a task holds one shard at a time)
SHARD_WORDS = 1 << 18
#: words of the corpus for each range of hashes that one task sums
RANGE_WORDS = 1 << 21
#: rows of a broadcast side
SMALL = 500_000
#: rows that Python gets at once: texts, and shards or their entries
TEXT_ROWS, SHARD_ROWS = 500, 4

#: A-Z in lower case; the cuts . , ; : ! ? and 0x0A-0x0D become a byte that no UTF-8 text has
_TABLE = bytes(c + 32 if 65 <= c <= 90 else 0xFF if c in b".,;:!?\x0a\x0b\x0c\x0d" else c for c in range(256))
_CUT, _BETWEEN = b"\xff", b" \xff "
_STEP, _M1 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    return x ^ (x >> np.uint64(31))


# --- the index ------------------------------------------------------------------------
def transform(symbols: np.ndarray, depth: int = DEPTH) -> np.ndarray:
    """Burrows-Wheeler transform of cyclic ``symbols``, whose rotations are sorted by ``depth`` symbols at least."""
    rank, known = symbols.astype(np.int64), 1
    while known < depth:
        key = rank * (int(rank.max()) + 1) + np.roll(rank, -known)
        _, rank = np.unique(key, return_inverse=True)
        known *= 2
    return symbols[np.argsort(rank, kind="stable") - 1]


class BiIndex:
    """Forward and backward transform of a sequence in which symbol 0 separates pieces."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.bwt = {"left": forward, "right": backward}
        self.starts = np.concatenate(([0], np.cumsum(np.bincount(forward))))
        self._lf: dict[str, np.ndarray] = {}

    @classmethod
    def build(cls, symbols: np.ndarray) -> BiIndex:
        return cls(transform(symbols), transform(symbols[::-1]))

    def lf(self, side: str) -> np.ndarray:
        """Row of the context that a row's preceding symbol leads to."""
        if side not in self._lf:
            order = np.argsort(self.bwt[side], kind="stable")
            lf = self._lf[side] = np.empty(len(order), np.int64)
            lf[order] = np.arange(len(order))
        return self._lf[side]

    def words(self) -> dict[str, np.ndarray]:
        """Intervals of all single words; ``left`` and ``right`` are their first rows in the two transforms."""
        word = np.arange(1, len(self.starts) - 1)
        first = self.starts[1:-1]
        n = np.diff(self.starts)[1:]
        return {"word": word[n > 0], "left": first[n > 0], "right": first[n > 0], "n": n[n > 0]}

    def extend(self, at: dict[str, np.ndarray], side: str) -> dict[str, np.ndarray]:
        """All extensions by one word: ``parent`` (row of ``at``), ``word``, ``n`` and the new intervals."""
        other = "right" if side == "left" else "left"
        ends = np.cumsum(at["n"])
        owner = np.repeat(np.arange(len(ends)), at["n"])
        rows = np.arange(len(owner)) + np.repeat(at[side] - (ends - at["n"]), at["n"])
        key = owner * len(self.starts) + self.bwt[side][rows]
        # rows of an interval ascend, so the first row of a key is its lowest
        found, first, n = np.unique(key, return_index=True, return_counts=True)
        parent, word = found // len(self.starts), found % len(self.starts)
        before = np.cumsum(n) - n
        before -= before[np.searchsorted(parent, parent)]  # smaller symbols of the same interval
        new = {"parent": parent, "word": word, "n": n, side: self.lf(side)[rows[first]],
               other: at[other][parent] + before}
        keep = word > 0
        return {k: v[keep] for k, v in new.items()}


def _take(at: dict[str, np.ndarray], keep: np.ndarray) -> dict[str, np.ndarray]:
    return {k: v[keep] for k, v in at.items()}


# --- shards ---------------------------------------------------------------------------
class _Words(dict):
    """Ids of the words of one language, numbered in a list that all languages of a shard share."""

    def __init__(self, lang: int, words: list[tuple[int, bytes]]):
        super().__init__({_CUT: 0})
        self.lang, self.words = lang, words

    def __missing__(self, word: bytes) -> int:
        self[word] = len(self.words)
        self.words.append((self.lang, word))
        return self[word]


class _Shard:
    """Word ids of the texts so far; id 0 is a cut."""

    def __init__(self) -> None:
        self.ids, self.words = array("i", [0]), [(0, b"")]
        self.langs: dict[str, _Words] = {}
        self.sizes: dict[str, int] = {}

    def add(self, lang: str, text: bytes) -> None:
        if lang not in self.langs:
            self.langs[lang] = _Words(len(self.langs), self.words)
            self.sizes[lang] = 0
        found = text.translate(_TABLE).replace(_CUT, _BETWEEN).split()
        self.ids.extend(map(self.langs[lang].__getitem__, found))
        self.ids.append(0)
        self.sizes[lang] += len(found) - found.count(_CUT)

    def symbols(self) -> np.ndarray:
        ids = np.frombuffer(self.ids, np.int32)
        return ids[np.concatenate(([True], (ids[1:] > 0) | (ids[:-1] > 0)))]  # one separator between pieces


INDEX = ("shard long, length long, forward binary, backward binary, langs array<string>, sizes array<bigint>, "
         "lang_of binary, words binary")


def _symbol_type(n_words: int) -> str:
    return "<u2" if n_words <= 1 << 16 else "<i4"


def build_shards(docs: DataFrame, text: Column, lang: Column, shard_words: int = SHARD_WORDS) -> DataFrame:
    """One row per shard with its two transforms, its words, and its number of words by language (``INDEX``)."""
    rows = docs.select(F.coalesce(lang.cast("string"), F.lit("und")).alias("lang"),
                       text.cast("string").cast("binary").alias("text")).filter(F.length("text") > 0)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0

        def row(shard: _Shard) -> pa.RecordBatch:
            symbols = shard.symbols()
            kind = _symbol_type(len(shard.words))
            columns = [pa.array([task << 24 | made], pa.int64()), pa.array([len(symbols)], pa.int64()),
                       *(pa.array([pa.compress(transform(s).astype(kind).tobytes(), "zstd", asbytes=True)], pa.binary())
                         for s in (symbols, symbols[::-1])),
                       pa.array([list(shard.langs)], pa.list_(pa.string())),
                       pa.array([list(shard.sizes.values())], pa.list_(pa.int64())),
                       pa.array([np.array([x for x, _ in shard.words], "<i4").tobytes()], pa.binary()),
                       pa.array([b"\n".join(w for _, w in shard.words)], pa.binary())]  # no word holds a line end
            return pa.RecordBatch.from_arrays(columns, names=[x.split()[0] for x in INDEX.split(", ")])

        shard = _Shard()
        for batch in batches:
            for name, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                shard.add(name, text.as_py())
                if len(shard.ids) >= shard_words:
                    yield row(shard)
                    shard, made = _Shard(), made + 1
        if len(shard.words) > 1:
            yield row(shard)

    return rows.mapInArrow(work, INDEX)


ROW = ("shard", "length", "forward", "backward", "langs", "lang_of", "words")


class _Row:
    """A row of the index table."""

    def __init__(self, table: pa.Table):
        value = lambda c: table.column(c)[0].as_py()
        self.shard = value("shard")
        self.langs, self.lang_of = value("langs"), np.frombuffer(value("lang_of"), "<i4")
        self.words = value("words").split(b"\n")
        kind = np.dtype(_symbol_type(len(self.words)))
        self.index = BiIndex(*(np.frombuffer(pa.decompress(value(c), kind.itemsize * value("length"), "zstd"), kind)
                               for c in ("forward", "backward")))

    def word_hashes(self) -> np.ndarray:
        seeds = [xxhash.xxh3_64_intdigest(x.encode("utf-8", "replace")) for x in self.langs]
        return np.fromiter((xxhash.xxh3_64_intdigest(w, seeds[at]) for w, at in zip(self.words, self.lang_of.tolist())),
                           np.uint64, len(self.words))


def phrase_key(hashes: np.ndarray, words: list[np.ndarray]) -> np.ndarray:
    key = np.full(len(words[0]), len(words), np.uint64)
    for w in words:
        key = _mix(key * _STEP + hashes[w])
    return key.view(np.int64)


#: a shard's entries in one range of hashes: the low half of each key, and counts in one byte or in four
PACKED = "part int, shard long, keys binary, counts binary"
_SCHEMA = pa.schema([("part", pa.int32()), ("shard", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])


def _slots(keys: np.ndarray, parts: int) -> np.ndarray:
    """Range (by the high half of the key) and low half: what tells phrases apart before they are counted in words."""
    keys = keys.view(np.uint64)
    return ((keys >> np.uint64(32)) % np.uint64(parts)) << np.uint64(32) | keys & np.uint64(0xFFFFFFFF)


def _packed(shard: int, keys: np.ndarray, n: np.ndarray, parts: int) -> pa.Table:
    slots, out = _slots(keys, parts), []
    for these, kind in ((n < 256, "u1"), (n >= 256, "<u4")):
        own = slots[these]
        order = np.argsort(own)
        own, counts = own[order], n[these][order].astype(kind)
        used, starts = np.unique(own >> np.uint64(32), return_index=True)
        low, ends = own.astype("<u4"), [*starts[1:], len(own)]
        out.append(pa.table([pa.array(used.astype(np.int32)), pa.array(np.full(len(used), shard, np.int64)),
                             *(pa.array([x[a:b].tobytes() for a, b in zip(starts, ends)], pa.binary()) for x in (low, counts))],
                            schema=_SCHEMA))
    return pa.concat_tables(out)


def _living(packed: DataFrame, min_count: int) -> DataFrame:
    """``(part, shard, keys)``: the entries of each shard that reach the minimum over all shards."""
    def work(group: pa.Table) -> pa.Table:
        rows = [np.frombuffer(x, "<u4") for x in group.column("keys").to_pylist()]
        counts = np.concatenate([np.frombuffer(x, "u1" if len(x) == len(r) else "<u4")
                                 for x, r in zip(group.column("counts").to_pylist(), rows)])
        _, which = np.unique(np.concatenate(rows), return_inverse=True)
        lives = (np.bincount(which, weights=counts) >= min_count)[which]  # sums are exact below 2**53
        ends = np.cumsum([len(r) for r in rows])
        kept = [r[m] for r, m in zip(rows, np.split(lives, ends[:-1]))]
        return pa.table([group.column("part").combine_chunks(), group.column("shard").combine_chunks(),
                         pa.array([k.tobytes() for k in kept], pa.binary())],
                        names=["part", "shard", "keys"]).filter(pa.array([len(k) > 0 for k in kept]))

    return packed.groupBy("part").applyInArrow(work, "part int, shard long, keys binary")


class _Levels:
    """Enumeration of a shard's phrases, level by level."""

    def __init__(self, row: _Row):
        self.index, self.hashes, self.size = row.index, row.word_hashes(), len(row.words)

    def keys(self, *words: np.ndarray) -> np.ndarray:
        return phrase_key(self.hashes, list(words))

    def words(self) -> tuple[dict, np.ndarray]:
        at = self.index.words()
        return at, at["word"]

    def pairs(self, at: dict, a: np.ndarray) -> tuple[dict, np.ndarray, np.ndarray]:
        two = self.index.extend(at, "right")
        return two, a[two["parent"]], two["word"]

    def longer(self, two: dict, a: np.ndarray, b: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
        """Counts and words of threes and fours all of whose pairs are among the given ones."""
        alive = np.sort(a.astype(np.int64) * self.size + b)

        def lives(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            return _among(alive, x.astype(np.int64) * self.size + y)

        three = self.index.extend(two, "right")
        a, b, c = a[three["parent"]], b[three["parent"]], three["word"]
        keep = lives(b, c)
        three, a, b, c = _take(three, keep), a[keep], b[keep], c[keep]
        yield three["n"], [a, b, c]
        four = self.index.extend(three, "left")
        four = _take(four, lives(four["word"], a[four["parent"]]))
        at = four["parent"]
        yield four["n"], [four["word"], a[at], b[at], c[at]]


def _among(ordered: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(x), bool)
    return ordered[np.minimum(np.searchsorted(ordered, x), len(ordered) - 1)] == x


def words_and_pairs(index: DataFrame, parts: int) -> DataFrame:
    """All words and word pairs of each shard (``PACKED``)."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = _Row(pa.Table.from_batches([batch.slice(k, 1)]))
                levels = _Levels(row)
                one, a = levels.words()
                two, a2, b2 = levels.pairs(one, a)
                yield from _packed(row.shard, np.concatenate((levels.keys(a), levels.keys(a2, b2))),
                                   np.concatenate((one["n"], two["n"])), parts).to_batches()

    return index.select(*ROW).mapInArrow(work, PACKED)


def _living_slots(table: pa.Table) -> np.ndarray:
    rows = zip(table.column("part").to_pylist(), table.column("keys").to_pylist())
    return np.sort(np.concatenate([np.uint64(part << 32) | np.frombuffer(x, "<u4").astype(np.uint64) for part, x in rows]))


def longer_phrases(index: DataFrame, living: DataFrame, parts: int) -> DataFrame:
    """Phrases of 3 and 4 words of each shard all of whose word pairs live (``PACKED``)."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return _SCHEMA.empty_table()
        row, alive = _Row(left), _living_slots(right)
        levels = _Levels(row)
        two, a, b = levels.pairs(*levels.words())
        keep = _among(alive, _slots(levels.keys(a, b), parts))
        found = [(levels.keys(*words), n) for n, words in levels.longer(_take(two, keep), a[keep], b[keep])]
        return _packed(row.shard, *(np.concatenate(x) for x in zip(*found)), parts)

    return (index.select(*ROW).groupBy("shard").cogroup(living.groupBy("shard")).applyInArrow(work, PACKED))


def _in_words(index: DataFrame, living: DataFrame, parts: int, min_count: int) -> DataFrame:
    """``(lang, phrase, size, f)``: the counts of all shards summed, phrases in words."""
    def work(left: pa.Table, right: pa.Table) -> pa.Table:
        schema = pa.schema([("lang", pa.string()), ("phrase", pa.binary()), ("size", pa.int32()), ("n", pa.int64())])
        if not left.num_rows or not right.num_rows:
            return schema.empty_table()
        row, alive = _Row(left), _living_slots(right)
        levels = _Levels(row)
        one, a1 = levels.words()
        two, a2, b2 = levels.pairs(one, a1)
        keep = _among(alive, _slots(levels.keys(a2, b2), parts))
        two, a2, b2 = _take(two, keep), a2[keep], b2[keep]
        out = []
        for n, words in ((one["n"], [a1]), (two["n"], [a2, b2]), *levels.longer(two, a2, b2)):
            keep = _among(alive, _slots(levels.keys(*words), parts))
            ids = [w[keep].tolist() for w in words]
            out.append(pa.table([pa.array([row.langs[x] for x in row.lang_of[ids[0]]], pa.string()),
                                 pa.array([b" ".join([row.words[i] for i in gram]) for gram in zip(*ids)], pa.binary()),
                                 pa.array(np.full(keep.sum(), len(words), np.int32)), pa.array(n[keep].astype(np.int64))],
                                schema=schema))
        return pa.concat_tables(out)

    spelt = (index.select(*ROW).groupBy("shard").cogroup(living.groupBy("shard"))
             .applyInArrow(work, "lang string, phrase binary, size int, n long"))
    return (spelt.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("f")).filter(F.col("f") >= min_count)
            .withColumn("phrase", F.col("phrase").cast("string")))


def phrase_counts(docs: DataFrame, text: Column, lang: Column, min_count: int = MIN_COUNT,
                  shard_words: int = SHARD_WORDS) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, f)`` of all phrases of up to ``DEPTH`` words that occur ``min_count`` times in
    their language, and ``(lang, total)``: all words of a language."""
    spark = docs.sparkSession
    with lean_steps(spark, TEXT_ROWS):
        index = stored(build_shards(docs, text, lang, shard_words), "phrase-index")
    total = index.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda x, y: x + y))).first()[0] or 0
    parts = max(1, -(-total // RANGE_WORDS))
    with lean_steps(spark, SHARD_ROWS):
        living = stored(_living(words_and_pairs(index, parts), min_count), "living-pairs")
        longer = stored(_living(longer_phrases(index, living, parts), min_count), "living-phrases")
        phrases = stored(_in_words(index, living.unionByName(longer), parts, min_count), "phrases")
    words = (index.select(F.explode(F.arrays_zip("langs", "sizes")).alias("x"))
             .groupBy(F.col("x.langs").alias("lang")).agg(F.sum("x.sizes").alias("total")).filter("total > 0"))
    return phrases, words


# --- scores ------------------------------------------------------------------------------
def _wide(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(38,0)")


def scored(phrases: DataFrame) -> DataFrame:
    """Phrases of two words and more with the least score of their cuts (``lang, phrase, size, a, l, r, score``)."""
    words = F.split("phrase", " ")
    cuts = (phrases.filter("size > 1").withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
            .select("lang", "phrase", "size", F.col("f").alias("a"), "k",
                    F.array_join(F.slice(words, F.lit(1), F.col("k")), " ").alias("__first"),
                    F.array_join(F.slice(words, F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("__rest")))
    known = phrases.select("lang", F.col("phrase").alias("__part"), "f")
    first = small_side(known.withColumnsRenamed({"__part": "__first", "f": "l"}), SMALL)
    rest = small_side(known.withColumnsRenamed({"__part": "__rest", "f": "r"}), SMALL)
    cuts = cuts.join(first, ["lang", "__first"]).join(rest, ["lang", "__rest"])
    score = F.expr(f"cast(a as decimal(20,0)) * {SCALE} div (cast(l as decimal(20,0)) + r)")
    best = F.min(F.struct(score.cast("long").alias("score"), "k", "l", "r")).alias("best")
    return (cuts.groupBy("lang", "phrase", "size", "a").agg(best)
            .select("lang", "phrase", "size", "a", "best.l", "best.r", "best.score"))


def not_contained(scores: DataFrame, phrases: DataFrame) -> DataFrame:
    """Without phrases that lie in a longer one which occurs almost as often."""
    words = F.split("phrase", " ")
    longer = phrases.filter("size > 2")
    sizes = longer.withColumn("part", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    parts = (sizes.withColumn("at", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("part") + 1)))
             .select("lang", F.array_join(F.slice(words, F.col("at"), F.col("part")), " ").alias("phrase"), "f")
             .groupBy("lang", "phrase").agg(F.max("f").alias("__longer")))
    joined = scores.join(parts, ["lang", "phrase"], "left")
    return joined.filter(F.coalesce(_wide("__longer") * 100 < _wide("a") * CONTAINED, F.lit(True))).drop("__longer")


def mine_phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT,
                 top: int = TOP, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` best collocations of every language."""
    phrases, words = phrase_counts(docs, F.col(f"`{text_col}`"), F.col(f"`{lang_col}`"), min_count, shard_words)
    kept = not_contained(scored(phrases), phrases)
    best = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= top)
    return ranked.join(words, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r",
                                             F.col("total").alias("n"), "score")
