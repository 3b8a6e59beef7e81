"""Mixing sources to target weights by a low-discrepancy schedule (native).

* Every source's documents are shuffled (order of a hash) and laid end to end
  as one stream of words, cut into blocks of equal length.
* Slot i of the schedule sits at the golden-ratio point ``frac(i * phi)``.
  The points are mapped through the cumulative weights of the sources, so the
  slots of a source are spread evenly over the mix and their number differs
  from the ideal by a few, whatever prefix of the schedule is used.
* The slots of one source are ranked; the r-th takes the source's block
  ``r mod n_blocks``.  A source with a target above its size is repeated, a
  lap at a time, at most ``cap`` laps.

Targets share the total size by weight.  A source whose share is above
``cap`` times its size gets just that, and the excess is shared by weight
among the others until none is above.

Scale: ranks and stream positions are running totals over consecutive parts of
a source (``running_total``), so a source with a third of all rows spreads
over many tasks.  Sources are ranked by range partitions, never in one window.

Defined cases: a NULL text has size 0; a NULL source is a source of its own,
last in order; documents of size 0 are returned with 0 taken; equal rows are
separate documents; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kiln.llm.common import WORD, hash32, running_total, stored

#: 2**32 / golden ratio, odd: multiples of it modulo 2**32 are the golden-ratio points
GOLDEN = 2654435769
RANGE = 1 << 32
#: the schedule aims at this many slots, with blocks of at most MAX_BLOCK words
SLOTS = 1 << 17
MAX_BLOCK = 2048
#: a source is cut into this many blocks at least (or one per word)
MIN_BLOCKS = 256
#: rows of a source that one task sorts
ROWS_PER_PART = 2_000


@dataclass
class Mix:
    """``docs``: every document with size, source_size, target, taken and its place in the source's
    stream; ``sources``: one row per source; ``slots``: the schedule (slot, source, block, lap)."""

    docs: DataFrame
    sources: DataFrame
    slots: DataFrame


def _source_key(source: Column) -> Column:
    """Never NULL, sorts by code point with the NULL source last."""
    return F.when(source.isNull(), F.lit("t")).otherwise(F.concat(F.lit("s"), source.cast("string")))


def _ordered(df: DataFrame, order: str) -> DataFrame:
    """``df`` stored in ranges of ``order``, with ``__range`` growing along it."""
    return stored(df.repartitionByRange(order).withColumn("__range", F.spark_partition_id()), "ranges")


def _targets(sources: DataFrame, cap: int) -> DataFrame:
    """``sources`` plus ``target``; driver work is three sums per round of resharing."""
    capped = F.lit(False)
    while True:
        total, full, free = sources.agg(
            F.sum("source_size"), F.sum(F.when(capped, F.col("source_size"))),
            F.sum(F.when(~capped, F.col("weight")))).first()
        total, full, free = total or 0, full or 0, free or 0
        rest = total - cap * full
        # in whole numbers: weight * rest / free > cap * source_size
        now = (F.col("weight").cast("decimal(38,0)") * F.lit(rest).cast("decimal(19,0)")
               > F.col("source_size").cast("decimal(19,0)") * F.lit(cap * free).cast("decimal(19,0)"))
        more = sources.filter(~capped & now).limit(1).count()
        if not more:
            break
        capped = capped | now
    share = (F.col("weight") * F.lit(rest).cast("long")).cast("double") / F.lit(max(free, 1)).cast("double")
    return sources.withColumn("target", F.when(capped, (F.col("source_size") * cap).cast("double"))
                              .otherwise(share))


def mix_sources(docs: DataFrame, size: Column, id_col: str = "doc_id", source_col: str = "source",
                weights: Sequence[int] = (5, 2, 1), cap: int = 3, slots: int = SLOTS,
                tie_cols: Sequence[str] = (), carry: Sequence[str] = ()) -> Mix:
    """Mix all rows of ``docs``; ``size`` is a row's length in words.

    The shuffle order is a hash of ``id_col``, the source, the size and
    ``tie_cols``, so reruns agree.  ``carry`` columns stay in ``Mix.docs``.
    """
    spark = docs.sparkSession
    keep = list(dict.fromkeys([id_col, source_col, *tie_cols, *carry]))
    rows = docs.select(*[F.col(f"`{c}`") for c in keep], size.cast("long").alias("__size"))
    rows = rows.withColumn("__source", _source_key(F.col(f"`{source_col}`")))
    rows = rows.withColumn("__order", hash32(id_col, "__source", "__size", *tie_cols))
    rows = stored(rows, "mix-sizes")

    # --- one row per source: weight, target, blocks ------------------------
    sources = rows.groupBy("__source").agg(F.sum("__size").alias("source_size"),
                                           F.count(F.lit(1)).alias("n_rows"))
    sources = _ordered(sources, "__source")
    sources = _ranked(sources)
    pattern = F.array(*[F.lit(w).cast("long") for w in weights])
    sources = stored(sources.withColumn(
        "weight", pattern[(F.col("__rank") % len(weights)).cast("int")]), "mix-weights")
    sources = _targets(sources, cap)
    words = sources.agg(F.sum("source_size")).first()[0] or 0
    block = min(MAX_BLOCK, max(1, words // slots))
    block = max(block, -(-words // (1 << 30)))  # the point of a slot is worked out in 64 bits
    n_blocks = F.greatest(F.ceil(F.col("source_size") / block),
                          F.least(F.col("source_size"), F.lit(MIN_BLOCKS))).cast("long")
    sources = sources.withColumn("n_blocks", n_blocks)
    # slots a source should get: each carries source_size / n_blocks words
    share = F.when(F.col("source_size") > 0,
                   F.col("target") * F.col("n_blocks") / F.col("source_size")).otherwise(F.lit(0.0))
    sources = stored(_ranked(sources.withColumn("__share", share), F.col("__share"), "__share_before"),
                     "mix-sources")
    ideal = sources.agg(F.sum("__share")).first()[0] or 0.0
    n_slots = round(ideal)

    # --- schedule ----------------------------------------------------------
    per_slot = RANGE / ideal if ideal else 0.0
    cell_bits = 20
    lo = F.floor(F.col("__share_before") * per_slot)
    hi = F.floor((F.col("__share_before") + F.col("__share")) * per_slot)
    cells = (sources.filter(F.col("__share") > 0)
             .select("__source", "n_blocks", lo.alias("__lo"),
                     # the last interval ends where the points end, whatever the rounding
                     F.when(F.col("__share_before") + F.col("__share") >= ideal * (1 - 1e-12), F.lit(RANGE))
                     .otherwise(hi).alias("__hi"))
             .filter("__lo < __hi")
             .withColumn("__cell", F.explode(F.sequence(F.shiftright("__lo", cell_bits),
                                                        F.shiftright(F.col("__hi") - 1, cell_bits)))))
    points = (spark.range(n_slots).withColumnRenamed("id", "slot")
              .withColumn("__point", (F.col("slot") * F.lit(GOLDEN)) % RANGE)
              .withColumn("__cell", F.shiftright("__point", cell_bits)))
    owned = (points.join(cells, "__cell").filter("__point >= __lo and __point < __hi")
             .select("slot", "__source", "n_blocks")
             .withColumn("__part", F.floor(F.col("slot") / (4 * ROWS_PER_PART))))
    ranked = running_total(owned, "__source", "__part", ["slot"], F.lit(1).cast("long"), "__rank")
    schedule = (ranked.select("slot", "__source",
                              (F.col("__rank") % F.col("n_blocks")).alias("block"),
                              F.floor(F.col("__rank") / F.col("n_blocks")).alias("lap"))
                .filter(F.col("lap") < cap))

    # --- the source's stream, cut into blocks ------------------------------
    per_source = sources.select("__source", "source_size", "target", "n_blocks",
                                F.ceil(F.col("n_rows") / ROWS_PER_PART).alias("__parts"))
    placed = rows.join(per_source, "__source").withColumn(
        "__part", F.floor(F.col("__order") * F.col("__parts") / RANGE).cast("long"))
    placed = running_total(placed, "__source", "__part", ["__order", id_col, "__size", *tie_cols],
                           F.col("__size"), "__start")
    # block k holds the words [ceil(k S / B), ceil((k + 1) S / B)) of the stream
    end = F.col("__start") + F.col("__size")
    whole = lambda c: c.cast("decimal(19,0)")
    block_of = lambda w: F.floor(whole(w) * whole(F.col("n_blocks")) / whole(F.col("source_size"))).cast("long")
    edge = lambda k: F.ceil(whole(k) * whole(F.col("source_size")) / whole(F.col("n_blocks"))).cast("long")
    placed = placed.withColumn("__first_block", F.when(F.col("__size") > 0, block_of(F.col("__start"))))
    pieces = (placed.filter("__size > 0").select(
        "__source", "__start", "__size", "n_blocks", "source_size",
        F.explode(F.sequence(F.col("__first_block"), block_of(end - 1))).alias("block")))
    pieces = pieces.select("__source", "block", "__start",
                           (F.least(F.col("__start") + F.col("__size"), edge(F.col("block") + 1))
                            - F.greatest(F.col("__start"), edge(F.col("block")))).alias("__words"))
    laps = schedule.groupBy("__source", "block").agg(F.count(F.lit(1)).alias("laps"))
    taken = (pieces.join(laps, ["__source", "block"])
             .groupBy(F.col("__source").alias("__s"), F.col("__start").alias("__at"))
             .agg(F.sum(F.col("__words") * F.col("laps")).alias("__taken")))
    # a document of size 0 shares its start with the next one
    here = (F.col("__source") == F.col("__s")) & (F.col("__start") == F.col("__at")) & (F.col("__size") > 0)
    out = (placed.join(taken, here, "left")
           .select(*[F.col(f"`{c}`") for c in keep], F.col("__source").alias("source_key"),
                   F.col("__size").alias("size"), "source_size", "target",
                   F.coalesce("__taken", F.lit(0)).cast("long").alias("taken"),
                   F.col("__start").alias("start"), F.col("__first_block").alias("first_block")))
    return Mix(out, sources, schedule.withColumnRenamed("__source", "source_key"))


def _ranked(df: DataFrame, weight: Column | None = None, name: str = "__rank") -> DataFrame:
    """Running total of ``weight`` (1 if none) along ``__source`` over a table stored in ranges."""
    w = F.lit(1).cast("long") if weight is None else weight
    df = df.withColumn("__w", w)
    sums = df.groupBy("__range").agg(F.sum("__w").alias("__sum"))
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("__range", F.coalesce(F.sum("__sum").over(before), F.lit(0)).alias("__before"))
    inside = Window.partitionBy("__range").orderBy("__source").rowsBetween(Window.unboundedPreceding, -1)
    return (df.join(sums, "__range")
            .withColumn(name, F.col("__before") + F.coalesce(F.sum("__w").over(inside), F.lit(0)))
            .drop("__w", "__before"))


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text.cast("string"), F.lit(WORD)), F.lit(0)).cast("long")


def mixed_documents(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                    source_col: str = "source", **options) -> DataFrame:
    """The mix as whole documents with the columns of ``docs``.

    A document comes once for each lap in which the schedule takes the block that its first word is in,
    so a source's documents add up to its target within a document's length
    per block run.  Empty documents carry no words and are not taken.
    """
    cols = docs.columns
    key = ["__id", "__source", "__size", "__hash"]  # rows equal in all of these are equal texts
    rows = docs.withColumns({
        "__hash": F.coalesce(F.md5(F.col(f"`{text_col}`").cast("string").cast("binary")), F.lit("")),
        "__id": F.coalesce(F.concat(F.lit("i"), F.col(f"`{id_col}`").cast("string")), F.lit("n")),
        "__source": _source_key(F.col(f"`{source_col}`")), "__size": word_count(F.col(f"`{text_col}`"))})
    narrow = stored(rows.select(F.col("__id").alias("id"), F.col(f"`{source_col}`").alias("source"), "__size",
                                F.col("__hash").alias("text_hash")), "mix-input")
    mix = mix_sources(narrow, F.col("__size"), "id", "source", tie_cols=["text_hash"], **options)
    laps = mix.slots.groupBy("source_key", "block").agg(F.count(F.lit(1)).alias("laps"))
    placed = mix.docs.withColumn("block", F.col("first_block")).join(laps, ["source_key", "block"], "left")
    # equal keys share their laps: every one of the n rows gets laps // n, the first laps % n one more
    chosen = (placed.groupBy(F.col("id").alias("__id"), F.col("source_key").alias("__source"),
                             F.col("size").alias("__size"), F.col("text_hash").alias("__hash"))
              .agg(F.coalesce(F.sum("laps"), F.lit(0)).alias("__laps"), F.count(F.lit(1)).alias("__n"))
              .filter("__laps > 0"))
    rank = F.row_number().over(Window.partitionBy(*key).orderBy(F.lit(0)))
    copies = (F.floor(F.col("__laps") / F.col("__n"))
              + F.when(F.col("__rank") <= F.col("__laps") % F.col("__n"), 1).otherwise(0)).cast("int")
    return (rows.join(chosen, key).withColumn("__rank", rank).withColumn("__copies", copies)
            .filter("__copies > 0")
            .withColumn("__copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
            .select(*[F.col(f"`{c}`") for c in cols]))
