"""Sharding by a consistent-hash ring with virtual nodes and bounded loads (native).

Every shard owns ``virtual_nodes`` points of a ring of 2**32 positions; a key
belongs to the first point clockwise from its own position.  A shard takes
rows up to its capacity; what overflows goes on clockwise to the next shard
that has room.  Capacities are ``n // shards`` rows, one more for the first
``n % shards``, so the row counts of any two shards differ by one at most
(law ``rows``) and no row is left over.

All keys of one arc (the stretch before a point) walk through the same
sequence of shards, so only the *row count of each arc* decides: a table of
``shards * virtual_nodes`` rows whatever the data's size.  The overflow is
worked out on that table by one SQL fold: in round r every arc offers what it
has left to the r-th shard of its walk; owners are served before any
overflow.  A row then needs its rank within its arc (a distributed running
count) to know into which share of the arc's split it falls.

Defined cases: a NULL text counts as empty; a NULL id hashes like a value of
its own; equal rows get slots of their own; an empty table gives an empty
result; other columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from kiln.llm.common import hash32, running_total, stored

#: the ring is cut into this many cells to find a key's arc by an equi-join
CELLS = 4096
#: rows of an arc that are ranked together by one task
ROWS_PER_PART = 20_000


def ring_points(spark: SparkSession, shards: int, virtual_nodes: int) -> DataFrame:
    """``(arc, pos, shard)``: the points in ring order, ``arc`` counting from 0."""
    points = (spark.range(shards * virtual_nodes)
              .select((F.col("id") % shards).cast("int").alias("shard"),
                      F.floor(F.col("id") / shards).alias("node"))
              # a shard's points are the same however many shards there are
              .select("shard", hash32("shard", "node").alias("pos")))
    return points.select((F.row_number().over(Window.orderBy("pos", "shard")) - 1).cast("int").alias("arc"),
                         "pos", "shard")


def _cells(points: DataFrame) -> DataFrame:
    """``(cell, first, inner)``: the number of points before a cell and the points inside it."""
    width = (1 << 32) // CELLS
    inside = (points.groupBy((F.col("pos") / width).cast("int").alias("cell"))
              .agg(F.sort_array(F.collect_list("pos")).alias("inner")))
    cells = (points.sparkSession.range(CELLS).select(F.col("id").cast("int").alias("cell"))
             .join(inside, "cell", "left")
             .withColumn("inner", F.coalesce("inner", F.array().cast("array<bigint>"))))
    before = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    return cells.select("cell", "inner",
                        F.coalesce(F.sum(F.size("inner")).over(before), F.lit(0)).alias("first"))


def _with_arc(df: DataFrame, key: Column, points: DataFrame, n_arcs: int) -> DataFrame:
    """``df`` plus ``__arc``.  The cell table has a fixed 4096 rows, so it is broadcast."""
    width = (1 << 32) // CELLS
    pos = F.col("__pos")
    return (df.withColumn("__pos", key).withColumn("__cell", (pos / width).cast("int"))
            .join(F.broadcast(_cells(points).withColumnsRenamed(
                {"cell": "__cell", "inner": "__inner", "first": "__first"})), "__cell")
            .withColumn("__arc", ((F.col("__first") + F.size(F.filter("__inner", lambda p: p < pos)))
                                  % n_arcs).cast("int"))
            .drop("__pos", "__cell", "__inner", "__first"))


def _split_arcs(counts: DataFrame, points: DataFrame, shards: int, n_arcs: int) -> DataFrame:
    """``(__arc, __split)``: the consecutive shares of an arc's rows, each with its shard and
    the slot that its first row gets there.  Works on one row per arc."""
    arcs = (points.join(counts, points["arc"] == counts["__arc"], "left")
            .select("arc", "shard", F.coalesce("n", F.lit(0)).alias("n")))
    ring = arcs.agg(F.sort_array(F.collect_list(F.struct("arc", "shard", "n"))).alias("ring"))
    ring = ring.withColumn("total", F.aggregate("ring", F.lit(0).cast("long"), lambda s, a: s + a["n"]))
    # the walk of an arc: its shards in clockwise order, each once
    walk = F.transform(F.sequence(F.lit(0), F.lit(n_arcs - 1)), lambda a: F.array_distinct(
        F.transform(F.sequence(F.lit(0), F.lit(n_arcs - 1)),
                    lambda j: F.col("ring")[((a + j) % n_arcs).cast("int")]["shard"])))
    ring = ring.withColumn("walk", walk).select(
        "walk",
        F.transform(F.sequence(F.lit(0), F.lit(shards - 1)),
                    lambda s: F.floor(F.col("total") / shards)
                    + F.when(s < F.col("total") % shards, 1).otherwise(0)).alias("room"),
        F.transform("ring", lambda a: a["n"]).alias("left_over"))
    ring = stored(ring, "ring-walk")  # one row; else the fold below works the walks out at every step

    share = "array<struct<arc:int,turn:int,shard:int,take:bigint>>"
    start = F.struct(F.col("room").alias("room"), F.col("left_over").alias("left_over"),
                     F.array().cast(share).alias("shares"))

    def offer(state: Column, step: Column) -> Column:
        arc, turn = (step % n_arcs).cast("int"), F.floor(step / n_arcs).cast("int")
        shard = F.col("walk")[arc][turn]
        take = F.least(state["left_over"][arc], state["room"][shard])
        return F.when(take <= 0, state).otherwise(F.struct(
            F.transform(state["room"], lambda v, i: F.when(i == shard, v - take).otherwise(v)).alias("room"),
            F.transform(state["left_over"], lambda v, i: F.when(i == arc, v - take).otherwise(v))
            .alias("left_over"),
            F.concat(state["shares"], F.array(F.struct(
                arc.alias("arc"), turn.alias("turn"), shard.alias("shard"), take.alias("take"))))
            .alias("shares")))

    steps = F.sequence(F.lit(0), F.lit(shards * n_arcs - 1))
    shares = ring.select(F.inline(F.aggregate(steps, start, offer)["shares"]))
    in_arc = Window.partitionBy("arc").orderBy("turn").rowsBetween(Window.unboundedPreceding, -1)
    in_shard = Window.partitionBy("shard").orderBy("arc", "turn").rowsBetween(Window.unboundedPreceding, -1)
    shares = shares.select(
        "arc", "shard", "take",
        F.coalesce(F.sum("take").over(in_arc), F.lit(0)).alias("since"),
        F.coalesce(F.sum("take").over(in_shard), F.lit(0)).alias("slot"))
    return shares.groupBy(F.col("arc").alias("__arc")).agg(
        F.collect_list(F.struct("since", "take", "shard", "slot")).alias("__split"))


def assign_shards(df: DataFrame, id_col: str, text_col: str, shards: int = 16,
                  virtual_nodes: int = 32, keep_text: bool = True) -> DataFrame:
    """``df`` plus ``size``, ``text_crc32``, ``shard`` and ``slot`` (a shard's slots count from 0).

    Two passes over the narrow columns (one stored), one shuffle of the rows
    to rank them within parts of an arc; the split table (at most one row per
    ring point) is broadcast.  Columns of ``df`` of those four names are replaced.
    """
    spark, n_arcs = df.sparkSession, shards * virtual_nodes
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = (df.withColumns({"__size": F.octet_length(text) + F.lit(1).cast("long"), "__crc": F.crc32(text)})
            .drop("size", "text_crc32", "shard", "slot"))
    if not keep_text:  # identical narrow rows: the writing partition tells them apart
        rows = stored(rows.drop(text_col).withColumn("__salt", F.spark_partition_id()), "shard-keys")
    else:
        rows = rows.withColumn("__salt", F.lit(0))
    points = stored(ring_points(spark, shards, virtual_nodes), "ring")
    rows = _with_arc(rows, hash32(id_col), points, n_arcs)
    counts = stored(rows.groupBy("__arc").agg(F.count(F.lit(1)).alias("n")), "arc-counts")
    total = counts.agg(F.sum("n")).first()[0] or 0
    parts = max(1, -(-total // (ROWS_PER_PART * n_arcs)))
    rows = (rows.withColumn("__order", hash32(id_col, "__crc", "__size", "__salt"))
            .withColumn("__part", F.floor(F.col("__order") * parts / (1 << 32)).cast("int")))
    ranked = running_total(rows, "__arc", "__part", ["__order", id_col, "__crc", "__size"],
                           F.lit(1).cast("long"), "__rank")
    split = stored(_split_arcs(counts, points, shards, n_arcs), "arc-split")
    own = F.filter("__split", lambda s: (F.col("__rank") >= s["since"])
                   & (F.col("__rank") < s["since"] + s["take"]))[0]
    return (ranked.join(F.broadcast(split), "__arc").withColumn("__own", own)
            .withColumns({"size": F.col("__size"), "text_crc32": F.col("__crc"),
                          "shard": F.col("__own.shard"),
                          "slot": F.col("__own.slot") + F.col("__rank") - F.col("__own.since")})
            .drop("__arc", "__part", "__split", "__own", "__rank", "__order", "__salt", "__size", "__crc"))
