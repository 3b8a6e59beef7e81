"""Dimension plans: date spine, customers, products, gross prices (L1-L4).

The ``*_silver`` / ``*_gold`` / ``*_parent_source`` functions are lazy
``DataFrame -> DataFrame`` steps over the source system's column names; the
``run_*`` functions add the table writes and the parent upsert.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions import clean as C
from kiln.functions import constants as K
from kiln.operators.dedupe import dedupe
from kiln.operators.latest import latest_nonzero
from kiln.operators.lookup import fill_from_lookup, resolve_key
from kiln.operators.materialize import scratch_scope
from kiln.operators.sizing import bounded_broadcast
from kiln.operators.upsert import upsert
from kiln.sources.tables import TableStore

DATE_DIM_COLS = ("month_start", "date_key", "year", "month_name", "month_short",
                 "quarter", "year_quarter")


# --- L4: date dimension ------------------------------------------------------
def date_dim_from_bounds(bounds: DataFrame, start_col: str = "start_date",
                         end_col: str = "end_date") -> DataFrame:
    """Monthly spine, both ends inclusive, from a one-row ``(start, end)`` frame.

    The spine has one row per calendar month, so it is tiny whatever the
    size of the data the bounds came from.
    """
    spine = bounds.select(F.explode(F.sequence(
        F.trunc(F.col(start_col), "month"), F.trunc(F.col(end_col), "month"),
        F.expr("INTERVAL 1 MONTH"))).alias("month_start"))
    q = F.quarter("month_start").cast("string")
    return spine.select(
        F.col("month_start").cast("date").alias("month_start"),
        F.date_format("month_start", "yyyyMM").cast("int").alias("date_key"),
        F.year("month_start").alias("year"),
        F.date_format("month_start", "MMMM").alias("month_name"),
        F.date_format("month_start", "MMM").alias("month_short"),
        F.concat(F.lit("Q"), q).alias("quarter"),
        F.concat(F.year("month_start").cast("string"), F.lit("-Q"), q).alias("year_quarter"),
    )


def date_dim(spark: SparkSession, start: str, end: str) -> DataFrame:
    """Monthly spine between two ``yyyy-MM-dd`` dates (inclusive)."""
    bounds = spark.range(1).select(F.to_date(F.lit(start)).alias("start_date"),
                                   F.to_date(F.lit(end)).alias("end_date"))
    return date_dim_from_bounds(bounds)


def date_dim_for(df: DataFrame, date_col: str) -> DataFrame:
    """Monthly spine covering every date in ``df`` (bounds by one global aggregate)."""
    return date_dim_from_bounds(df.agg(F.min(date_col).alias("start_date"),
                                       F.max(date_col).alias("end_date")))


# --- shared: literal-or-table value fixes -------------------------------------
def replace_values(df: DataFrame, col: str, fixes: Mapping[str, str] | DataFrame,
                   case_insensitive: bool = True) -> DataFrame:
    """Swap known misspellings in ``col``: a literal map, or a two-column
    ``(wrong, right)`` table joined in (broadcast when bounded)."""
    if not isinstance(fixes, DataFrame):
        return df.withColumn(col, C.map_values(col, fixes, case_insensitive))
    wrong, right = fixes.columns[:2]
    side = fixes.select(F.lower(F.col(wrong)) if case_insensitive else F.col(wrong),
                        F.col(right)).toDF("__fix_k", "__fix_v")
    side = dedupe(side, ["__fix_k"])  # one fix per spelling: never multiplies rows
    key = F.lower(F.col(col)) if case_insensitive else F.col(col)
    cols = df.columns
    return (df.join(bounded_broadcast(side), key == F.col("__fix_k"), "left")
            .withColumn(col, F.coalesce(F.col("__fix_v"), F.col(col))).select(*cols))


def keep_allowed(df: DataFrame, col: str, allowed: Sequence[str] | DataFrame) -> DataFrame:
    """NULL out values not in ``allowed`` (a literal list or a one-column table)."""
    if not isinstance(allowed, DataFrame):
        return df.withColumn(col, C.allow_list(col, allowed))
    side = allowed.select(F.col(allowed.columns[0]).alias("__ok")).distinct()
    cols = df.columns
    return (df.join(bounded_broadcast(side), F.col(col) == F.col("__ok"), "left")
            .withColumn(col, F.when(F.col("__ok").isNotNull(), F.col(col))).select(*cols))


# --- L1: customers -------------------------------------------------------------
def customers_silver(bronze: DataFrame,
                     city_fixes: Mapping[str, str] | DataFrame = K.CITY_FIXES,
                     allowed: Sequence[str] | DataFrame = K.ALLOWED_CITIES,
                     corrections: DataFrame | None = None,
                     market: str = K.CUSTOMER_MARKET, platform: str = K.CUSTOMER_PLATFORM,
                     channel: str = K.CUSTOMER_CHANNEL) -> DataFrame:
    """customer_id, customer_name, city (+ lineage) -> cleaned, one row per id as it came.

    Repeated rows are dropped by the raw id; ids that are no number then
    become the sentinel, so all of these customers stay.  ``corrections`` is a ``(customer_id, correct_city)`` table for cities
    that stay missing after the spelling fixes.
    """
    df = dedupe(bronze, ["customer_id"]).withColumns({
        "customer_id": C.sanitize_id("customer_id", K.BAD_CUSTOMER_ID),
        "customer_name": C.normalize_name("customer_name"),
        "city": F.trim(F.col("city")),
    })
    df = keep_allowed(replace_values(df, "city", city_fixes), "city", allowed)
    if corrections is not None:
        df = fill_from_lookup(df, corrections, "customer_id", "city", "correct_city")
    return df.withColumns({
        "customer": F.concat_ws("-", F.col("customer_name"),
                                F.coalesce(F.col("city"), F.lit(K.UNKNOWN_CITY))),
        "market": F.lit(market),
        "platform": F.lit(platform),
        "channel": F.lit(channel),
    })


def customer_corrections(spark: SparkSession,
                         mapping: Mapping[str, str] = K.CITY_CORRECTIONS) -> DataFrame:
    """The per-customer city fixes as a literal relation."""
    rows = [F.struct(F.lit(k).alias("customer_id"), F.lit(v).alias("correct_city")) for k, v in mapping.items()]
    return spark.range(1).select(F.inline(F.array(*rows)))


def customers_gold(silver: DataFrame) -> DataFrame:
    return silver.select("customer_id", "customer_name", "customer", "city",
                         "channel", "market", "platform")


def customers_parent_source(gold: DataFrame) -> DataFrame:
    """One row per customer_code (the merge key); customers without a number share the sentinel,
    of which the first by name stands for all."""
    return dedupe(gold, ["customer_id"], [F.col("customer").asc()]).select(F.col("customer_id").alias("customer_code"), "customer", "market",
                       "platform", "channel")


# --- L2: products ----------------------------------------------------------------
def products_silver(bronze: DataFrame,
                    typo: tuple[str, str] = K.PRODUCT_TYPO,
                    divisions: Mapping[str, str] = K.CATEGORY_TO_DIVISION) -> DataFrame:
    """product_name, product_id, category -> + division, variations, product_code.

    The spelling fix is applied to the name *and* the category, and the
    category map is looked up on the fixed spelling.  ``product_code`` is the
    SHA-256 of the fixed name; ``product_id`` keeps digits only (else the
    sentinel).  Repeated rows are dropped by the raw id, so every product keeps
    its row and code, those without a number too.
    """
    pattern, repl = typo
    fixed_map = {re.sub(pattern, repl, k): v for k, v in divisions.items()}
    df = dedupe(bronze, ["product_id"]).withColumns({
        "product_id": C.sanitize_id("product_id", K.BAD_PRODUCT_ID),
        "product_name": C.fix_typo(F.trim(F.col("product_name")), pattern, repl),
        "category": C.fix_typo(C.title_case(F.trim(F.col("category"))), pattern, repl),
    })
    return df.withColumns({
        "division": C.map_category("category", fixed_map),
        "variations": C.extract_parenthesised("product_name"),
        "product_code": C.hash_key("product_name"),
    })


def products_gold(silver: DataFrame) -> DataFrame:
    return silver.select("product_name", "product_id", "category", "division",
                         "variations", "product_code")


def products_parent_source(gold: DataFrame) -> DataFrame:
    """One row per product_code (the merge key): the lowest product_id wins."""
    src = gold.select("product_code", F.col("variations").alias("variant"), "division",
                      "category", F.col("product_name").alias("product"), "product_id")
    return dedupe(src, ["product_code"], [F.col("product_id").asc()]).drop("product_id")


def product_keys(products: DataFrame) -> DataFrame:
    """``(product_id, product_code)`` with every real id once: the side to resolve ids against.

    The sentinel stands for several products, so it resolves nothing.
    """
    known = products.filter(F.col("product_id") != K.BAD_PRODUCT_ID).select("product_id", "product_code")
    return known.groupBy("product_id").agg(F.min("product_code").alias("product_code"))


PRODUCT_SET = {c: c for c in ("variant", "division", "category", "product")}


# --- L3: gross prices ---------------------------------------------------------------
def prices_silver(bronze: DataFrame, products: DataFrame) -> DataFrame:
    """product_id, month, gross_price -> typed, keyed by product_code; unknown products dropped."""
    df = bronze.withColumns({
        "product_id": F.trim(F.col("product_id").cast("string")),
        "month": C.parse_date("month", strip_prefix=False),
        "gross_price": C.clean_number_abs("gross_price"),
    })
    return resolve_key(df, product_keys(products), "product_id", ["product_code"])


def prices_gold(silver: DataFrame) -> DataFrame:
    return silver.select("product_code", "month", "gross_price")


def prices_parent_source(gold: DataFrame, keep_ties: bool = False) -> DataFrame:
    """Latest non-zero price per (product_code, year) -> (product_code, year, price_inr)."""
    df = gold.withColumn("year", F.year("month"))
    latest = latest_nonzero(df, ["product_code", "year"], "month", "gross_price",
                            keep_ties=keep_ties)
    return latest.select("product_code", F.col("year").cast("string").alias("year"),
                         F.col("gross_price").alias("price_inr"))


PRICE_KEYS = ("product_code", "year")


# --- runners -----------------------------------------------------------------------
def run_dimension(store: TableStore, name: str, bronze: DataFrame, silver_fn, gold_fn,
                  parent_source_fn, parent: str, keys: Sequence[str],
                  set_cols: Mapping[str, Column | str] | None = None,
                  insert_cols: Mapping[str, Column | str] | None = None,
                  gold_prefix: str = "sb_dim_") -> DataFrame:
    """bronze -> silver -> gold -> upsert into the parent table; returns the new parent.

    The child's gold table is ``<gold_prefix><name>``.
    """
    store.finish("gold", parent)
    store.write(bronze, "bronze", name)
    store.write(silver_fn(store.read("bronze", name)), "silver", name)
    store.write(gold_fn(store.read("silver", name)), "gold", f"{gold_prefix}{name}")
    source = parent_source_fn(store.read("gold", f"{gold_prefix}{name}"))
    with scratch_scope(store.spark):
        if store.exists("gold", parent):
            # the parent source is made with one row per key
            store.replace(upsert(store.read("gold", parent), source, keys, set_cols, insert_cols, unique=True), "gold", parent)
        else:
            store.write(source, "gold", parent)
    return store.read("gold", parent)
