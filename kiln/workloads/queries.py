"""Registered queries: every operator of the inventory run over the whole
driver tables.  Each function takes ``(spark, sf_dir)`` and returns a lazy
DataFrame (a few write scratch files first: CSV round trip, file-once
ingest, appends).  Column names match the DuckDB oracles in ``oracles.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kiln.functions import clean as C
from kiln.operators import profile as P
from kiln.operators.dedupe import dedupe
from kiln.operators.diff import snapshot_diff
from kiln.operators.latest import latest_nonzero
from kiln.operators.lookup import fill_from_lookup, resolve_key
from kiln.operators.materialize import materialize
from kiln.operators.rollup import affected_periods, date_range, monthly_rollup
from kiln.operators.union import append_parquet, read_evolving, union_evolving
from kiln.operators.sizing import bounded_broadcast
from kiln.operators.upsert import upsert
from kiln.plans import dims, facts
from kiln.session import scratch_path
from kiln.sources.csv import LINEAGE_COLS, read_csv, write_csv
from kiln.sources.ledger import file_once_ingest
from kiln.sources.tables import TableStore, in_periods
from kiln.streaming.ingest import ingest_available
from kiln.workloads import dirty as D

SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
LINE_COLS = facts.ORDER_COLS
ORDER_TEXT_COLS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                   "o_orderdate", "o_orderpriority")


def _t(spark, sf, name):
    return D.table(spark, sf, name)


# --- sources ------------------------------------------------------------------
def _typed_orders(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").try_cast("bigint").alias("o_custkey"),
        F.col("o_orderstatus"),
        C.to_double("o_totalprice").alias("o_totalprice"),
        C.parse_date("o_orderdate").alias("o_orderdate"),
        F.col("o_orderpriority"),
        *(["from_file"] if "from_file" in df.columns else []))


def csv_roundtrip_scan(spark: SparkSession, sf: str) -> DataFrame:
    """orders -> landing CSV (text, dirty dates) -> text-schema read with lineage -> typed (A1-A3)."""
    path = scratch_path(spark, "landing-orders")
    od = _t(spark, sf, "orders")
    write_csv(od.withColumn("o_orderdate", D.dirty_date("o_orderdate", "o_orderkey")), path)
    back = read_csv(spark, f"{path}/*.csv", ORDER_TEXT_COLS)
    return _typed_orders(back.withColumn(
        "from_file", F.col("file_name").endswith(".csv") & (F.col("file_size") > 0)))


def file_once_ingest_q(spark: SparkSession, sf: str) -> DataFrame:
    """Parent feed in four folders; runs offer {0,1}, then {0,1} again, then all four."""
    root = scratch_path(spark, "feed")
    od = _t(spark, sf, "orders").select(
        *[F.date_format(c, "yyyy-MM-dd").alias(c) if c == "o_orderdate"
          else F.col(c).cast("string").alias(c) for c in ORDER_TEXT_COLS],
        (F.col("o_orderkey") % 4).alias("part"))
    od.write.partitionBy("part").option("header", "true").csv(f"{root}/landing")
    ledger, target = f"{root}/ledger", f"{root}/target"

    def project(df):
        return df.select(
            F.col("o_orderkey").try_cast("bigint").alias("o_orderkey"),
            F.col("o_custkey").try_cast("bigint").alias("o_custkey"),
            "o_orderstatus", F.col("o_totalprice").try_cast("double").alias("o_totalprice"),
            F.col("o_orderdate").try_cast("date").alias("o_orderdate"),
            "o_orderpriority")

    cols = [c for c in ORDER_TEXT_COLS]
    file_once_ingest(spark, f"{root}/landing/part=[01]/*.csv", cols, ledger, target, project)
    file_once_ingest(spark, f"{root}/landing/part=[01]/*.csv", cols, ledger, target, project)
    file_once_ingest(spark, f"{root}/landing/part=*/*.csv", cols, ledger, target, project, max_files_per_load=1)
    return spark.read.parquet(target).drop("load_id")


def dim_date_q(spark: SparkSession, sf: str) -> DataFrame:
    """Monthly date dimension spanning every order date."""
    return dims.date_dim_for(_t(spark, sf, "orders"), "o_orderdate")


# --- filters --------------------------------------------------------------------
def filter_not_null(spark, sf):
    od = _t(spark, sf, "orders")
    price = F.when(F.col("o_orderkey") % 10 == 0, F.lit(None)).otherwise(F.col("o_totalprice"))
    return (od.select("o_orderkey", "o_custkey", price.alias("o_totalprice"))
            .filter(F.col("o_totalprice").isNotNull()))


def filter_in_list(spark, sf):
    return (_t(spark, sf, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY"))
            .select("c_custkey", "c_name", "c_mktsegment"))


def filter_sql_string(spark, sf):
    return _t(spark, sf, "part").filter("p_brand = 'Brand#4'").select("p_partkey", "p_name", "p_brand")


# --- scalar cleaning -------------------------------------------------------------
def _dirty_segment():
    k = F.col("c_custkey")
    return (F.when(k % 4 == 1, F.lower("c_mktsegment"))
            .when(k % 4 == 2, F.concat(F.col("c_mktsegment"), F.lit("S")))
            .when(k % 4 == 3, F.lit("UNKNOWN")).otherwise(F.col("c_mktsegment")))


def map_then_allow_list(spark, sf):
    fixes = {**{s.lower(): s for s in SEGMENTS}, **{s + "S": s for s in SEGMENTS}}
    df = _t(spark, sf, "customer").select("c_custkey", _dirty_segment().alias("segment"))
    return df.withColumn("segment", C.allow_list(C.map_values("segment", fixes), SEGMENTS))


def sanitize_numeric_id(spark, sf):
    k = F.col("c_custkey")
    raw = (F.when(k % 7 == 0, F.concat(F.lit("ABC"), k.cast("string")))
           .when(k % 11 == 0, F.lit(None).cast("string")).otherwise(k.cast("string")))
    return _t(spark, sf, "customer").select("c_custkey", C.sanitize_id(raw).alias("customer_id"))


def clean_numeric_abs(spark, sf):
    k, bal = F.col("c_custkey"), F.col("c_acctbal")
    raw = (F.when(k % 9 == 0, F.lit("unknown")).when(k % 13 == 0, F.lit("not_available"))
           .when(k % 4 == 0, (-F.abs(bal)).cast("string")).otherwise(bal.cast("string")))
    return _t(spark, sf, "customer").select("c_custkey", C.clean_number_abs(raw).alias("acctbal"))


def normalize_names(spark, sf):
    k = F.col("p_partkey")
    raw = (F.when(k % 3 == 0, F.concat(F.lit("  "), F.upper("p_name"), F.lit("  ")))
           .when(k % 3 == 1, F.upper("p_name")).otherwise(F.col("p_name")))
    return _t(spark, sf, "part").select("p_partkey", C.normalize_name(raw).alias("name"))


def fix_typo_regex(spark, sf):
    k = F.col("p_partkey")
    raw = (F.when(k % 3 == 0, F.concat(F.lit("Protien "), F.col("p_name")))
           .when(k % 3 == 1, F.concat(F.lit("PROTIEN "), F.col("p_name"))).otherwise(F.col("p_name")))
    return _t(spark, sf, "part").select("p_partkey", C.fix_typo(raw).alias("name"))


def extract_variant(spark, sf):
    k = F.col("p_partkey")
    raw = F.when(k % 4 != 0, F.concat(F.col("p_name"), F.lit(" ("), F.col("p_size").cast("string"),
                                      F.lit("g)"))).otherwise(F.col("p_name"))
    return _t(spark, sf, "part").select("p_partkey", C.extract_parenthesised(raw).alias("variant"))


def hash_business_key(spark, sf):
    return _t(spark, sf, "part").select("p_partkey", C.hash_key("p_name", "p_brand").alias("product_code"))


def derive_category(spark, sf):
    df = _t(spark, sf, "part").select("p_partkey", C.title_case("p_type").alias("category"))
    return df.withColumn("division", C.map_category("category", D.TESTDATA_DIVISIONS))


def parse_multi_format_date(spark, sf):
    od = _t(spark, sf, "orders")
    raw = D.dirty_date("o_orderdate", "o_orderkey")
    return od.select("o_orderkey", C.parse_date(raw).alias("o_orderdate"))


# --- projection / joins -------------------------------------------------------------
def _lines(spark, sf):
    li = _t(spark, sf, "lineitem")
    od = _t(spark, sf, "orders")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def fact_project_rename(spark, sf):
    return (_lines(spark, sf)
            .select("l_orderkey", "o_orderdate", "o_custkey", "l_partkey", "l_linenumber", "l_quantity")
            .withColumn("o_orderdate", F.col("o_orderdate").cast("date"))
            .withColumnsRenamed({"l_orderkey": "order_id", "o_orderdate": "date",
                                 "o_custkey": "customer_code", "l_partkey": "product_id",
                                 "l_quantity": "sold_quantity"}))


def resolve_surrogate_key(spark, sf):
    li = _t(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_orderkey") % 13 == 0, F.lit("99999999"))
         .otherwise(F.col("l_partkey").cast("string")).alias("product_id"))
    dim = _t(spark, sf, "part").select(F.col("p_partkey").cast("string").alias("product_id"),
                                       C.hash_key("p_name", "p_brand").alias("product_code"))
    return resolve_key(li, dim, "product_id", ["product_code"])


def fill_missing_from_lookup(spark, sf):
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    df = c.select("c_custkey", F.when(k % 10 == 0, F.lit(None)).otherwise(F.col("c_mktsegment"))
                  .alias("c_mktsegment"))
    fixes = c.filter(k % 20 == 0).select("c_custkey", F.col("c_mktsegment").alias("correct_segment"))
    return fill_from_lookup(df, fixes, "c_custkey", "c_mktsegment", "correct_segment")


# --- dedupe / aggregation ---------------------------------------------------------------
def dedupe_single_key(spark, sf):
    od = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    altered = (od.filter(F.col("o_orderkey") % 3 == 0)
               .withColumn("o_totalprice", F.col("o_totalprice") + 1)
               .withColumn("o_orderpriority", F.lit("9-CHANGED")))
    return dedupe(od.unionByName(altered), ["o_orderkey"], [F.col("o_totalprice").asc()])


def dedupe_composite_key(spark, sf):
    li = _t(spark, sf, "lineitem")
    return dedupe(li, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc()])


def _monthly_lines(spark, sf):
    return _lines(spark, sf).select(
        F.col("o_orderdate").cast("date").alias("date"),
        F.col("l_partkey").alias("product_id"), F.col("o_custkey").alias("customer_code"),
        F.col("l_quantity").alias("sold_quantity"), "l_linenumber")


def monthly_rollup_q(spark, sf):
    return monthly_rollup(_monthly_lines(spark, sf), "date", ["product_id", "customer_code"],
                          "sold_quantity")


def date_range_q(spark, sf):
    return date_range(parse_multi_format_date(spark, sf), "o_orderdate")


def count_distinct_q(spark, sf):
    return P.count_distinct(_t(spark, sf, "orders"), ["o_custkey"], "n_customers")


def distinct_values_q(spark, sf):
    return P.distinct_values(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


def row_counts_by_stage(spark, sf):
    """Rows kept by each step of the fact cleaning, in two passes: one over
    the raw lines (all / with quantity), one over the deduplicated lines
    (all / with a known product)."""
    raw = D.order_lines(spark, sf)
    products = dims.products_silver(D.product_rows(spark, sf), divisions=D.TESTDATA_DIVISIONS)
    before = P.stage_counts(raw, [("1_raw", None),
                                  ("2_with_quantity", C.to_double("order_qty").isNotNull())])
    deduped = dedupe(facts.orders_clean(raw),
                     ["order_id", "order_placement_date", "customer_id", "product_id"],
                     [F.col("order_qty").desc()])
    known = dims.product_keys(products).select("product_id", F.lit(True).alias("__known"))
    flagged = deduped.join(bounded_broadcast(known), "product_id", "left")
    after = P.stage_counts(flagged, [("3_deduplicated", None),
                                     ("4_resolved", F.col("__known").isNotNull())])
    return before.unionByName(after)


# --- data quality --------------------------------------------------------------------------
def dq_duplicate_keys(spark, sf):
    return P.duplicate_keys(_t(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def dq_untrimmed(spark, sf):
    return P.untrimmed(D.customer_rows(spark, sf), "customer_name").select(
        "customer_id", "customer_name").distinct()


def dq_missing_values(spark, sf):
    c = _t(spark, sf, "customer")
    df = c.select("c_custkey", F.when(F.col("c_custkey") % 10 == 0, F.lit(None))
                  .otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return P.missing_values(df, ["c_mktsegment"])


def dq_profile(spark, sf):
    return P.profile(D.customer_rows(spark, sf), ["customer_id"], ["customer_name", "city"])


# --- windows / sort ------------------------------------------------------------------------
def latest_nonzero_per_group(spark, sf):
    od = _t(spark, sf, "orders")
    df = od.select("o_custkey", "o_orderkey",
                   F.col("o_orderdate").cast("date").alias("o_orderdate"),
                   F.year("o_orderdate").alias("year"),
                   F.when(F.col("o_orderkey") % 6 == 0, F.lit(0.0))
                    .otherwise(F.col("o_totalprice")).alias("price"))
    return latest_nonzero(df, ["o_custkey", "year"], "o_orderdate", "price", keep_ties=True)


def preview_top_n(spark, sf):
    return (_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
            .orderBy("o_orderkey").limit(20))


# --- appends and schema evolution ----------------------------------------------------------
def append_batches(spark, sf):
    od = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    path = scratch_path(spark, "append")
    append_parquet(od.filter(F.col("o_orderkey") % 2 == 0), path)
    append_parquet(od.filter(F.col("o_orderkey") % 2 == 1), path)
    return read_evolving(spark, path)


def schema_evolving_union(spark, sf):
    od = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    path = scratch_path(spark, "evolve")
    append_parquet(od.filter(F.col("o_orderkey") % 2 == 0).drop("o_orderpriority"), path)
    append_parquet(od.filter(F.col("o_orderkey") % 2 == 1), path)
    stored = read_evolving(spark, path)
    # the same union in memory, for a third batch that lacks o_totalprice
    return union_evolving(stored.filter(F.col("o_orderkey") % 3 != 0),
                          stored.filter(F.col("o_orderkey") % 3 == 0).drop("o_totalprice"))


def schema_widening(spark, sf):
    """Four batches whose columns get wider: int, bigint, double and text keys and amounts, one column more."""
    od = _t(spark, sf, "orders")
    k = F.col("o_orderkey")
    path = scratch_path(spark, "widen")

    def batch(part: int, key: str, amount: str, *more):
        append_parquet(od.filter(k % 4 == part).select(k.alias("o_orderkey"), F.col("o_custkey").cast(key).alias("customer"),
                                                       F.floor("o_totalprice").cast(amount).alias("amount"), *more), path)

    batch(0, "int", "int")
    batch(1, "bigint", "bigint", "o_orderpriority")
    batch(2, "int", "double", "o_orderpriority")
    batch(3, "string", "bigint")
    return read_evolving(spark, path)


# --- upserts / change feed ------------------------------------------------------------------
_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


def _upsert_inputs(spark, sf):
    c = _t(spark, sf, "customer").select(*_CUST)
    target = c.filter(F.col("c_custkey") % 3 != 0)
    source = (c.filter(F.col("c_custkey") % 5 == 0)
              .withColumn("c_acctbal", F.col("c_acctbal") + 100)
              .withColumn("c_mktsegment", F.lower("c_mktsegment"))
              .withColumn("c_name", F.upper("c_name")))
    return target, source


def upsert_all_columns(spark, sf):
    target, source = _upsert_inputs(spark, sf)
    return upsert(target, source, ["c_custkey"])


def upsert_set_columns(spark, sf):
    target, source = _upsert_inputs(spark, sf)
    return upsert(target, source, ["c_custkey"], set_cols={"c_acctbal": "c_acctbal"},
                  insert_cols={"c_custkey": "c_custkey", "c_name": "c_name",
                               "c_acctbal": "c_acctbal"})


def _stored(spark, df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in scratch and read it back — the
    parent tables of the upsert queries live on storage, not in a plan."""
    return TableStore(spark, scratch_path(spark, "tables")).write(df, "gold", name)


def upsert_monthly_fact(spark, sf):
    lines = _monthly_lines(spark, sf)
    stale = _stored(spark, monthly_rollup(lines.filter(F.col("l_linenumber") != 1), "date",
                                          ["product_id", "customer_code"], "sold_quantity"),
                    "fact_orders")
    fresh = monthly_rollup(lines, "date", ["product_id", "customer_code"], "sold_quantity")
    return upsert(stale, fresh, ["date", "product_id", "customer_code"], unique=True)


def snapshot_diff_q(spark, sf):
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_acctbal")
    k = F.col("c_custkey")
    before = c.filter(k % 7 != 0)
    after = c.filter(k % 11 != 0).withColumn(
        "c_acctbal", F.when(k % 5 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    return snapshot_diff(before, after, ["c_custkey"])


BATCH_CUTOFF = "2001-06-15"  # inside a month: the parent already holds a part of it


def affected_month_recompute(spark, sf):
    """The daily fact is a month-partitioned table; the batch's months prune the scan at run time."""
    store = TableStore(spark, scratch_path(spark, "tables"))
    lines = _monthly_lines(spark, sf).drop("l_linenumber").withColumn("month", C.month_start("date"))
    daily = store.write(lines, "gold", "daily", partition_by=["month"])
    in_batch = F.col("date") >= F.lit(BATCH_CUTOFF).cast("date")
    keys = ["product_id", "customer_code"]
    parent_before = store.write(monthly_rollup(daily.filter(~in_batch), "date", keys, "sold_quantity"), "gold", "fact_orders")
    months = affected_periods(daily.filter(in_batch), "date")
    sums = monthly_rollup(in_periods(daily, "month", months), "date", keys, "sold_quantity")
    return upsert(parent_before, sums, ["date", *keys], unique=True)


# --- dimension and fact plans ------------------------------------------------------------------
def _nation_fixes(spark, sf):
    n = _t(spark, sf, "nation")
    return n.select(F.col("n_name").alias("wrong"), F.col("n_name").alias("right"))


def dim_customers_conform(spark, sf):
    rows = D.customer_rows(spark, sf)
    n = _t(spark, sf, "nation").select("n_name")
    c = _t(spark, sf, "customer").join(_t(spark, sf, "nation"),
                                       F.col("c_nationkey") == F.col("n_nationkey"))
    corrections = c.filter(F.col("c_custkey") % 10 == 2).select(
        F.col("c_custkey").cast("string").alias("customer_id"), F.col("n_name").alias("correct_city"))
    silver = dims.customers_silver(rows, city_fixes=_nation_fixes(spark, sf), allowed=n,
                                   corrections=corrections)
    return dims.customers_parent_source(dims.customers_gold(silver))


def _products(spark, sf):
    return dims.products_silver(D.product_rows(spark, sf), divisions=D.TESTDATA_DIVISIONS)


def dim_products_conform(spark, sf):
    return dims.products_parent_source(dims.products_gold(_products(spark, sf)))


def dim_price_conform(spark, sf):
    silver = dims.prices_silver(D.price_rows(spark, sf), _products(spark, sf))
    return dims.prices_parent_source(dims.prices_gold(silver))


def _landed(spark, df: DataFrame, name: str) -> DataFrame:
    """``df`` written as landing CSV files and read back as text with lineage."""
    path = scratch_path(spark, f"landing-{name}")
    write_csv(df, path)
    return read_csv(spark, f"{path}/*.csv", df.columns)


def dim_customers_load(spark, sf):
    """Customer CSV -> bronze -> silver -> gold -> upsert (all columns) into a
    parent that already holds its own customers, one per nation (L1, K1, B1, B3)."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    parent = _t(spark, sf, "nation").select(
        F.concat(F.lit("P"), F.col("n_nationkey").cast("string")).alias("customer_code"),
        F.concat(F.lit("Parent-"), F.col("n_name")).alias("customer"),
        F.lit("India").alias("market"), F.lit("Retail").alias("platform"),
        F.lit("Direct").alias("channel"))
    store.write(parent, "gold", "dim_customers")
    n = _t(spark, sf, "nation")
    corrections = (_t(spark, sf, "customer").join(n, F.col("c_nationkey") == F.col("n_nationkey"))
                   .filter(F.col("c_custkey") % 10 == 2)
                   .select(F.col("c_custkey").cast("string").alias("customer_id"),
                           F.col("n_name").alias("correct_city")))
    bronze = _landed(spark, D.customer_rows(spark, sf), "customers")
    return dims.run_dimension(
        store, "customers", bronze,
        lambda b: dims.customers_silver(b, city_fixes=_nation_fixes(spark, sf),
                                        allowed=n.select("n_name"), corrections=corrections),
        dims.customers_gold, dims.customers_parent_source, "dim_customers", ["customer_code"])


def dim_products_load(spark, sf):
    """Product CSV -> ... -> upsert with explicit column maps into a parent whose
    extra column ``source_system`` is kept on update and NULL on insert (L2, K2)."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    conformed = dims.products_parent_source(dims.products_gold(_products(spark, sf)))
    parent = (conformed.filter(F.substring("product_code", 1, 1) < "8")
              .withColumns({"variant": F.lit("old"), "division": F.lit("old"),
                            "source_system": F.lit("parent")}))
    store.write(parent, "gold", "dim_products")
    bronze = _landed(spark, D.product_rows(spark, sf), "products")
    return dims.run_dimension(
        store, "products", bronze,
        lambda b: dims.products_silver(b, divisions=D.TESTDATA_DIVISIONS),
        dims.products_gold, dims.products_parent_source, "dim_products", ["product_code"],
        set_cols=dims.PRODUCT_SET, insert_cols={"product_code": "product_code", **dims.PRODUCT_SET})


def dim_price_load(spark, sf):
    """Price CSV -> ... -> latest non-zero price per (product_code, year) upserted
    (price only) into a parent holding a stale 2000 price for part of the
    products (updated where the child has that year, kept where not) and
    brand-level rows of its own (L3, K2)."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    products = store.write(_products(spark, sf), "silver", "products")
    bronze = _landed(spark, D.price_rows(spark, sf), "gross_price")
    stale = (products.select("product_code").distinct()
             .filter(F.substring("product_code", 1, 1) < "8")
             .select("product_code", F.lit("2000").alias("year"), F.lit(1.0).alias("price_inr")))
    own = (_t(spark, sf, "part").groupBy("p_brand")
           .agg(F.min("p_retailprice").alias("price_inr"))
           .select(F.concat(F.lit("PB-"), F.col("p_brand")).alias("product_code"),
                   F.lit("2024").alias("year"), "price_inr"))
    store.write(stale.unionByName(own), "gold", "dim_gross_price")
    return dims.run_dimension(
        store, "gross_price", bronze, lambda b: dims.prices_silver(b, products),
        dims.prices_gold, dims.prices_parent_source, "dim_gross_price", list(dims.PRICE_KEYS),
        set_cols={"price_inr": "price_inr"},
        insert_cols={"product_code": "product_code", "year": "year", "price_inr": "price_inr"})


def fact_full_load(spark, sf):
    lines = D.order_lines(spark, sf).select(*LINE_COLS)
    return facts.full_load(lines, _products(spark, sf)).parent


FACT_CUTOFF = "2000-06-15"


def _landing_lines(spark, sf, *more: str) -> DataFrame:
    """The order lines, with ``more`` columns, stored once for queries whose batches read them several times."""
    return materialize(D.order_lines(spark, sf).select(*LINE_COLS, *more), "order-lines")


def _two_batches(spark, sf) -> tuple[DataFrame, DataFrame]:
    """Order lines in two batches that meet in many months and orders.

    The first has the orders before a date inside a month, without the lines
    of products whose id divides by 5, and with a quantity too large by one in
    every 7th order.  The second has everything left, and every 7th order again
    as it should be.  All lines of an order with one product are in one batch.
    """
    lines = _landing_lines(spark, sf, "o_orderdate", "l_partkey")
    order = F.col("order_id").cast("bigint")
    late = ((F.col("o_orderdate") >= F.lit(FACT_CUTOFF).cast("timestamp_ntz"))
            | (F.col("l_partkey") % 5 == 0))
    wrong = (C.to_double("order_qty") + 1).cast("string")
    first = lines.filter(~late).withColumn(
        "order_qty", F.when(order % 7 == 0, wrong).otherwise(F.col("order_qty")))
    return first.select(*LINE_COLS), lines.filter(late | (order % 7 == 0)).select(*LINE_COLS)


def _fact_store(spark, sf) -> tuple[TableStore, DataFrame]:
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    return store, store.write(_products(spark, sf), "silver", "products")


def _incremental(spark, sf) -> facts.FactState:
    store, products = _fact_store(spark, sf)
    first, second = _two_batches(spark, sf)
    facts.run_fact_load(store, first, products)
    return facts.run_fact_load(store, second, products)


def fact_incremental_load(spark, sf):
    """A full load of the first batch, an incremental load of the second, which corrects and
    completes months and orders of the first (L6, K4)."""
    return _incremental(spark, sf).parent


def fact_daily_gold(spark, sf):
    """The child's daily fact after both batches, one row per order, day, customer and product id."""
    return _incremental(spark, sf).gold.drop("month")


def _streamed(spark, root: str, store: TableStore, products: DataFrame, files_per_batch: int) -> DataFrame:
    def batch(df, batch_id):
        facts.run_fact_load(store, df.drop(*LINEAGE_COLS), products, load_id=f"{batch_id:012d}")

    ingest_available(spark, f"{root}/landing/*.csv", list(LINE_COLS), f"{root}/checkpoint", batch,
                     max_files_per_trigger=files_per_batch)
    return store.read("gold", "fact_orders").select(*facts.PARENT_KEYS, "sold_quantity")


def fact_stream_load(spark, sf):
    """Order lines landed as CSV files that each hold orders of all months, drained by a file
    stream (``availableNow``, half of the files per micro-batch); every micro-batch
    runs the incremental fact load with its batch id as load id (M1 + L6)."""
    root = scratch_path(spark, "stream")
    files = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    (D.order_lines(spark, sf, partitions=files).select(*LINE_COLS)
     .write.option("header", "true").csv(f"{root}/landing"))
    store, products = _fact_store(spark, sf)
    return _streamed(spark, root, store, products, -(-files // 2))


def fact_stream_mixed_headers(spark, sf):
    """Files of one landing folder, taken in one micro-batch, with three forms of header: the usual one, columns in another
    order with one more, and no customer column; then broken rows in a fourth form (M1, A1, B4)."""
    root = scratch_path(spark, "stream")
    order = F.col("order_id").cast("bigint")
    lines = _landing_lines(spark, sf)
    forms = [lines.filter(order % 4 == 0),
             lines.filter(order % 4 == 1).withColumn("channel", F.lit("web")).select("channel", *reversed(LINE_COLS)),
             lines.filter(order % 4 == 2).drop("customer_id")]
    for df in forms:
        df.write.mode("append").option("header", "true").csv(f"{root}/landing")
    # rows of two values under a header of one
    two = F.concat_ws(",", F.lit("broken"), F.col("order_id"))
    (lines.filter(order % 4 == 3).select(two.alias("order_id")).write.mode("append").option("header", "true")
     .option("sep", "\t").csv(f"{root}/landing"))  # so that the comma is not quoted
    store, products = _fact_store(spark, sf)
    _streamed(spark, root, store, products, 1_000_000)
    loaded = store.read("silver", "orders").select(
        F.coalesce("channel", F.lit("shop")).alias("what"), F.lit(1).alias("n"))
    rejected = store.read("silver", "rejects_orders").select(F.col("reject_reason").alias("what"), F.lit(1).alias("n"))
    return loaded.unionByName(rejected).groupBy("what").agg(F.count("n").alias("rows"))


def _with_bad_dates(lines: DataFrame) -> DataFrame:
    """Order lines with a date in no known format in every 29th order."""
    order = F.col("order_id").cast("bigint")
    return lines.select(*LINE_COLS).withColumn(
        "order_placement_date", F.when(order % 29 == 0, F.lit("soon")).otherwise(F.col("order_placement_date")))


def fact_replay(spark, sf):
    """One batch, with bad dates in it, loaded twice under one load id."""
    store, products = _fact_store(spark, sf)
    lines = _with_bad_dates(_landing_lines(spark, sf))
    for _ in range(2):
        state = facts.run_fact_load(store, lines, products, load_id="replayed")
    return state.parent


def fact_rejects(spark, sf):
    """Rejected order lines of a landed batch by reason and product id."""
    store, products = _fact_store(spark, sf)
    facts.land_lines(store, _with_bad_dates(D.order_lines(spark, sf)), products)
    return (store.read("silver", "rejects_orders").groupBy("reject_reason", "product_id")
            .agg(F.count(F.lit(1)).alias("rows")))


def _sequenced_batches(spark, sf) -> dict[str, DataFrame]:
    """Three loads that give every line of some orders a different quantity: the latest load that has it is right."""
    lines = _landing_lines(spark, sf)
    order = F.col("order_id").cast("bigint")
    plus = lambda n: lines.withColumn("order_qty", (C.to_double("order_qty") + n).cast("string"))
    return {"2024-01": plus(2), "2024-02": plus(7).filter(order % 2 == 0), "2024-03": lines.filter(order % 3 == 0)}


def _sequenced(spark, sf, arrival: list[str]) -> DataFrame:
    store, products = _fact_store(spark, sf)
    batches = _sequenced_batches(spark, sf)
    for load in arrival:
        state = facts.run_fact_load(store, batches[load], products, load_id=load)
    return state.gold.drop("month")


def fact_sequenced_in_order(spark, sf):
    """Conflicting quantities of one line in three loads that arrive in order (K1, K3)."""
    return _sequenced(spark, sf, ["2024-01", "2024-02", "2024-03"])


def fact_sequenced_late(spark, sf):
    """The same loads, the newest first and the oldest last and twice: no older value overwrites a newer one (K1, K3)."""
    return _sequenced(spark, sf, ["2024-03", "2024-02", "2024-01", "2024-01"])


def _restated(spark, sf, replace: bool) -> DataFrame:
    """A second load restates the months from a cutoff on, without the lines of products whose id divides by 7.

    The parent holds a row of its own in every month.
    """
    store, products = _fact_store(spark, sf)
    lines = _landing_lines(spark, sf, "o_orderdate", "l_partkey")
    own = (_t(spark, sf, "orders").select(C.month_start("o_orderdate").alias("date")).distinct()
           .select("date", F.lit("own").alias("product_code"), F.lit("0").alias("customer_code"),
                   F.lit(1).cast("bigint").alias("sold_quantity")))
    store.write(own, "gold", "fact_orders", partition_by=["date"])
    facts.run_fact_load(store, lines.select(*LINE_COLS), products, load_id="1")
    again = lines.filter((F.col("o_orderdate") >= F.lit("2000-06-01").cast("timestamp_ntz")) & (F.col("l_partkey") % 7 != 0))
    return facts.run_fact_load(store, again.select(*LINE_COLS), products, load_id="2", replace_periods=replace).parent


def fact_month_replace(spark, sf):
    """Keys that vanish from a restated month leave the parent; the parent's own rows stay (K4)."""
    return _restated(spark, sf, replace=True)


def fact_month_keep(spark, sf):
    """By default a key that a later load of its month does not have stays (K4)."""
    return _restated(spark, sf, replace=False)


def fact_late_products(spark, sf):
    """Lines of products that arrive after the lines: rejected first, loaded once the products are there, though
    the reload runs twice (E1)."""
    store = TableStore(spark, scratch_path(spark, "warehouse"))
    everything = _products(spark, sf)
    few = store.write(everything.filter(F.crc32("product_id") % 5 != 0), "silver", "products_before")
    facts.run_fact_load(store, D.order_lines(spark, sf).select(*LINE_COLS), few)
    products = store.write(everything, "silver", "products")
    for _ in range(2):
        state = facts.reload_rejects(store, products)
    left = (store.read("silver", "rejects_orders").groupBy("reject_reason").agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(None).cast("date").alias("date"), F.col("reject_reason").alias("product_code"),
                    F.lit("rejects").alias("customer_code"), F.col("rows").alias("sold_quantity")))
    return state.parent.unionByName(left)


def fact_change_feed(spark, sf):
    """What the merge of the second of two batches changed in silver, from the merge itself."""
    store, products = _fact_store(spark, sf)
    first, second = _two_batches(spark, sf)
    facts.run_fact_load(store, first, products, load_id="1")
    facts.run_fact_load(store, second, products, load_id="2", change_feed=True)
    return store.read("silver", "changes_orders").drop("load_id")


def fact_schema_drift(spark, sf):
    """Two landing batches by CSV; the later has another column order and one more column.

    Returns silver: the column is there, NULL for lines of the first batch only.
    """
    store, products = _fact_store(spark, sf)
    lines = _landing_lines(spark, sf)
    odd = F.col("order_id").cast("bigint") % 2 == 1
    later = lines.filter(odd).withColumn("channel", F.lit("web")).select("channel", *reversed(LINE_COLS))
    for batch, name in ((lines.filter(~odd), "orders-1"), (later, "orders-2")):
        landed = _landed(spark, batch, name).drop(*LINEAGE_COLS)
        facts.run_fact_load(store, landed, products)
    return store.read("silver", "orders").drop("month", "load_seq")


def dedupe_five_columns(spark, sf):
    """Order lines repeated in all five columns dropped; another quantity is another line (F8)."""
    return dedupe(facts.orders_clean(D.order_lines(spark, sf).select(*LINE_COLS)), list(LINE_COLS))


CUSTOMER_CORRECTIONS = {"10": "BUILDING", "20": "MACHINERY", "30": "HOUSEHOLD", "7": "FURNITURE"}


def fill_from_literal_table(spark, sf):
    """Missing segments filled from a literal relation of corrections."""
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    df = c.select(k.cast("string").alias("customer_id"),
                  F.when(k % 10 != 0, F.col("c_mktsegment")).alias("segment"))
    fixes = dims.customer_corrections(spark, CUSTOMER_CORRECTIONS)
    return fill_from_lookup(df, fixes, "customer_id", "segment", "correct_city")


def hash_key_with_nulls(spark, sf):
    """Business key of three parts of which some are NULL or empty."""
    c = _t(spark, sf, "customer")
    k = F.col("c_custkey")
    parts = [F.when(k % 3 != 0, F.col("c_mktsegment")),
             F.when(k % 5 != 0, F.when(k % 4 == 0, F.lit("")).otherwise(F.concat(F.lit("a|b"), k.cast("string")))),
             F.when(k % 2 != 0, F.lit("x"))]
    return c.select("c_custkey", C.hash_key(*parts).alias("key"))


QUERIES = {
    "csv_roundtrip_scan": csv_roundtrip_scan,
    "file_once_ingest": file_once_ingest_q,
    "dim_date": dim_date_q,
    "filter_not_null": filter_not_null,
    "filter_in_list": filter_in_list,
    "filter_sql_string": filter_sql_string,
    "map_then_allow_list": map_then_allow_list,
    "sanitize_numeric_id": sanitize_numeric_id,
    "clean_numeric_abs": clean_numeric_abs,
    "normalize_names": normalize_names,
    "fix_typo_regex": fix_typo_regex,
    "extract_variant": extract_variant,
    "hash_business_key": hash_business_key,
    "derive_category": derive_category,
    "parse_multi_format_date": parse_multi_format_date,
    "fact_project_rename": fact_project_rename,
    "resolve_surrogate_key": resolve_surrogate_key,
    "fill_missing_from_lookup": fill_missing_from_lookup,
    "dedupe_single_key": dedupe_single_key,
    "dedupe_composite_key": dedupe_composite_key,
    "monthly_rollup": monthly_rollup_q,
    "date_range": date_range_q,
    "count_distinct": count_distinct_q,
    "distinct_values": distinct_values_q,
    "row_counts_by_stage": row_counts_by_stage,
    "dq_duplicate_keys": dq_duplicate_keys,
    "dq_untrimmed": dq_untrimmed,
    "dq_missing_values": dq_missing_values,
    "dq_profile": dq_profile,
    "latest_nonzero_per_group": latest_nonzero_per_group,
    "preview_top_n": preview_top_n,
    "append_batches": append_batches,
    "schema_evolving_union": schema_evolving_union,
    "upsert_all_columns": upsert_all_columns,
    "upsert_set_columns": upsert_set_columns,
    "upsert_monthly_fact": upsert_monthly_fact,
    "snapshot_diff": snapshot_diff_q,
    "affected_month_recompute": affected_month_recompute,
    "dim_customers_conform": dim_customers_conform,
    "dim_products_conform": dim_products_conform,
    "dim_price_conform": dim_price_conform,
    "dim_customers_load": dim_customers_load,
    "dim_products_load": dim_products_load,
    "dim_price_load": dim_price_load,
    "fact_full_load": fact_full_load,
    "fact_incremental_load": fact_incremental_load,
    "fact_stream_load": fact_stream_load,
    "fact_rejects": fact_rejects,
    "fact_replay": fact_replay,
    "fact_daily_gold": fact_daily_gold,
    "fact_schema_drift": fact_schema_drift,
    "fact_sequenced_in_order": fact_sequenced_in_order,
    "fact_sequenced_late": fact_sequenced_late,
    "fact_month_replace": fact_month_replace,
    "fact_month_keep": fact_month_keep,
    "fact_late_products": fact_late_products,
    "fact_change_feed": fact_change_feed,
    "fact_stream_mixed_headers": fact_stream_mixed_headers,
    "schema_widening": schema_widening,
    "dedupe_five_columns": dedupe_five_columns,
    "fill_from_literal_table": fill_from_literal_table,
    "hash_key_with_nulls": hash_key_with_nulls,
}
