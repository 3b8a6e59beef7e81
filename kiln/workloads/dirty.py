"""Dirty inputs derived from the driver's clean tables (corrupt-then-clean).

Every defect is a deterministic function of a key, so the DuckDB oracle can
state the *clean* value directly without sharing any cleaning logic with the
Spark side.  All derivations are narrow projections over the whole tables
(no sampling, no row caps); the only join is lineitem with orders on the
order key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.operators.sizing import bounded_broadcast
from kiln.sources.parquet import read_parquet


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def dirty_date(d: Column | str, key: Column | str, with_weekday: bool = True) -> Column:
    """The date written in one of the landing files' formats, chosen by ``key``."""
    d = F.col(d) if isinstance(d, str) else d
    k = F.col(key) if isinstance(key, str) else key
    if with_weekday:
        return (F.when(k % 5 == 0, F.date_format(d, "EEEE, MMMM dd, yyyy"))
                .when(k % 5 == 1, F.date_format(d, "yyyy/MM/dd"))
                .when(k % 5 == 2, F.date_format(d, "dd/MM/yyyy"))
                .when(k % 5 == 3, F.date_format(d, "dd-MM-yyyy"))
                .otherwise(F.date_format(d, "yyyy-MM-dd")))
    return (F.when(k % 4 == 0, F.date_format(d, "yyyy/MM/dd"))
            .when(k % 4 == 1, F.date_format(d, "dd/MM/yyyy"))
            .when(k % 4 == 2, F.date_format(d, "dd-MM-yyyy"))
            .otherwise(F.date_format(d, "yyyy-MM-dd")))


def order_lines(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Landing-file shaped order lines (text columns) from lineitem ⋈ orders; with ``partitions``, dealt to so many by
    order before the join, which needs no other shuffle of the lines then.

    Defects: five date formats (one with a weekday); customer ids with
    letters (o_custkey % 23 = 0); placeholder product ids (l_orderkey % 13 =
    0); missing quantities ((l_orderkey + l_linenumber) % 19 = 0); whole
    numbers written with or without ``.0``; exact repeated rows
    (l_linenumber % 7 = 0).
    """
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey",
                                                  "l_quantity")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate", "o_custkey")
    if partitions:
        li = li.repartition(partitions, "l_orderkey")
    lines = li.join(od, li.l_orderkey == od.o_orderkey)
    qty_text = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity").cast("string")) \
        .otherwise(F.col("l_quantity").cast("bigint").cast("string"))
    out = lines.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        dirty_date("o_orderdate", "l_orderkey").alias("order_placement_date"),
        F.when(F.col("o_custkey") % 23 == 0, F.concat(F.lit("C-"), F.col("o_custkey").cast("string")))
         .otherwise(F.col("o_custkey").cast("string")).alias("customer_id"),
        F.when(F.col("l_orderkey") % 13 == 0, F.lit("99999999"))
         .otherwise(F.col("l_partkey").cast("string")).alias("product_id"),
        F.when((F.col("l_orderkey") + F.col("l_linenumber")) % 19 == 0, F.lit(None).cast("string"))
         .otherwise(qty_text).alias("order_qty"),
        F.col("l_linenumber"),
        F.col("o_orderdate"),
        F.col("l_partkey"),
    )
    # one join gives the repeated rows too
    times = F.when(F.col("l_linenumber") % 7 == 0, 2).otherwise(1)
    return out.withColumn("__time", F.explode(F.array_repeat(F.lit(0), times))).drop("__time")


def product_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product export shaped rows from ``part``.

    Defects: the misspelling ``Protien``/``PROTIEN`` (p_partkey % 3 in 0, 1),
    ids with letters (p_partkey % 17 = 0), lower-case categories.  The pack
    size is written in parentheses.
    """
    p = table(spark, sf_dir, "part")
    prefix = (F.when(F.col("p_partkey") % 3 == 0, F.lit("Protien "))
              .when(F.col("p_partkey") % 3 == 1, F.lit("PROTIEN ")).otherwise(F.lit("")))
    return p.select(
        F.concat(prefix, F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"),
                 F.lit("g)")).alias("product_name"),
        F.when(F.col("p_partkey") % 17 == 0, F.concat(F.lit("XYZ"), F.col("p_partkey").cast("string")))
         .otherwise(F.col("p_partkey").cast("string")).alias("product_id"),
        F.lower(F.col("p_type")).alias("category"),
    )


# Division of each part type in the testdata: the category map the product
# plan takes as a parameter (one type, LARGE, deliberately unmapped).
TESTDATA_DIVISIONS = {
    "Economy": "Value",
    "Standard": "Core",
    "Promo": "Core",
    "Small": "Compact",
    "Medium": "Compact",
}


def price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Price export shaped rows (product_id, month, gross_price) from lineitem.

    Defects: placeholder product ids (l_orderkey % 11 = 0), four date
    formats, ``unknown`` prices (l_orderkey % 9 = 0), negative prices
    ((l_orderkey + l_linenumber) % 4 = 1).
    """
    li = table(spark, sf_dir, "lineitem")
    price = F.col("l_extendedprice")
    return li.select(
        F.when(F.col("l_orderkey") % 11 == 0, F.lit("88888888"))
         .otherwise(F.col("l_partkey").cast("string")).alias("product_id"),
        dirty_date("l_shipdate", "l_orderkey", with_weekday=False).alias("month"),
        F.when(F.col("l_orderkey") % 9 == 0, F.lit("unknown"))
         .when((F.col("l_orderkey") + F.col("l_linenumber")) % 4 == 1, (-price).cast("string"))
         .otherwise(price.cast("string")).alias("gross_price"),
    )


def customer_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer export shaped rows (customer_id, customer_name, city) from customer ⋈ nation.

    Defects: padded upper-case names (c_custkey % 3 = 0), upper-case names
    (% 3 = 1), lower-case city (% 5 = 1), unknown city spelling (% 5 = 2),
    exact repeated rows (% 8 = 0).
    """
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    k = F.col("c_custkey")
    rows = c.join(bounded_broadcast(n), c.c_nationkey == n.n_nationkey).select(
        k.cast("string").alias("customer_id"),
        F.when(k % 3 == 0, F.concat(F.lit("  "), F.upper("c_name"), F.lit(" ")))
         .when(k % 3 == 1, F.upper("c_name")).otherwise(F.col("c_name")).alias("customer_name"),
        F.when(k % 5 == 1, F.lower("n_name"))
         .when(k % 5 == 2, F.concat(F.col("n_name"), F.lit("X")))
         .otherwise(F.col("n_name")).alias("city"),
        k.alias("c_custkey"),
    )
    return rows.unionByName(rows.filter(k % 8 == 0)).drop("c_custkey")
