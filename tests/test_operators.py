import datetime as dt

import pytest
from pyspark.sql import functions as F

from kiln.operators import profile as P
from kiln.operators.dedupe import dedupe
from kiln.operators.diff import snapshot_diff
from kiln.operators.latest import latest_nonzero, top_per_group
from kiln.operators.lookup import fill_from_lookup, rejects, resolve_key
from kiln.operators.rollup import affected_periods, monthly_rollup, recompute_periods
from kiln.operators.union import union_evolving
from kiln.operators.upsert import AmbiguousMergeError, upsert, upsert_changes


def _key(t):
    return tuple((x is None, str(x)) for x in t)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=_key)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- dedupe ----------------------------------------------------------------------
def test_dedupe_keeps_first_under_total_order(spark):
    df = spark.createDataFrame([(1, 5.0, "b"), (1, 5.0, "a"), (1, 3.0, "z"), (2, 1.0, "x")],
                               "k int, q double, s string")
    out = dedupe(df, ["k"], [F.col("q").desc()])
    assert rows(out) == [(1, 5.0, "a"), (2, 1.0, "x")]
    # same answer whatever the input order
    assert rows(dedupe(df.orderBy(F.rand(7)), ["k"], [F.col("q").desc()])) == rows(out)


def test_dedupe_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    p = plan(dedupe(df, ["k"], ["v"]))
    assert "WindowGroupLimit" in p


def test_hot_key_dedupe(spark):
    # a third of the rows share one key
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                                  F.col("id").alias("v"))
    out = dedupe(df, ["k"], [F.col("v").desc()])
    assert out.filter("k = 0").first().v == 2997
    assert out.count() == 2001


# --- latest per group -----------------------------------------------------------------
def test_latest_nonzero_keeps_ties_and_prefers_nonzero(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("a", d(2025, 12, 1), 0.0), ("a", d(2025, 11, 1), 5.0), ("a", d(2025, 10, 1), 6.0),
        ("b", d(2025, 12, 1), 0.0), ("b", d(2025, 11, 1), 0.0),
        ("c", d(2025, 12, 1), 1.0), ("c", d(2025, 12, 1), 2.0)], "p string, m date, v double")
    out = latest_nonzero(df, ["p"], "m", "v", keep_ties=True)
    assert rows(out) == [("a", d(2025, 11, 1), 5.0), ("b", d(2025, 12, 1), 0.0),
                         ("c", d(2025, 12, 1), 1.0), ("c", d(2025, 12, 1), 2.0)]
    one = latest_nonzero(df, ["p"], "m", "v", keep_ties=False)
    assert one.filter("p = 'c'").count() == 1
    assert "WindowGroupLimit" in plan(out)


def test_top_per_group_nulls_last(spark):
    df = spark.createDataFrame([("a", None), ("a", 3)], "g string, v int")
    assert rows(top_per_group(df, ["g"], [F.col("v").desc_nulls_last()])) == [("a", 3)]


# --- lookups -----------------------------------------------------------------------------
def test_resolve_key_drops_unknown_and_rejects(spark):
    fact = spark.createDataFrame([("1", 10.0), ("2", 5.0), ("99999999", 1.0)], "product_id string, q double")
    dim = spark.createDataFrame([("1", "h1"), ("2", "h2")], "product_id string, product_code string")
    assert rows(resolve_key(fact, dim, "product_id", ["product_code"])) == [("1", 10.0, "h1"), ("2", 5.0, "h2")]
    assert rows(rejects(fact, dim, "product_id")) == [("99999999", 1.0)]
    known = spark.range(9).select(F.col("id").cast("string").alias("product_id"), F.lit("h").alias("product_code"))
    assert "BroadcastHashJoin" in plan(resolve_key(fact, known, "product_id", ["product_code"]))


def test_resolve_key_beyond_bound_shuffles(spark):
    fact = spark.range(100).select(F.col("id").cast("string").alias("k"))
    dim = spark.range(100).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("c"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(resolve_key(fact, dim, "k", ["c"], max_broadcast_bytes=10))
        assert "SortMergeJoin" in p or "ShuffledHashJoin" in p
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_fill_from_lookup(spark):
    df = spark.createDataFrame([("789101", None), ("1", "Pune"), ("2", None)], "customer_id string, city string")
    fixes = spark.createDataFrame([("789101", "Bengaluru"), ("1", "X")], "customer_id string, correct_city string")
    out = fill_from_lookup(df, fixes, "customer_id", "city", "correct_city")
    assert out.columns == ["customer_id", "city"]
    assert rows(out) == [("1", "Pune"), ("2", None), ("789101", "Bengaluru")]


# --- rollup ----------------------------------------------------------------------------------
def test_monthly_rollup_sums_then_casts(spark):
    d = dt.date
    df = spark.createDataFrame([(d(2025, 7, 3), "p", "c", 1.5), (d(2025, 7, 9), "p", "c", 1.5),
                                (d(2025, 8, 1), "p", "c", 2.0)], "date date, p string, c string, q double")
    out = monthly_rollup(df, "date", ["p", "c"], "q", out_measure="sold_quantity")
    assert rows(out) == [(d(2025, 7, 1), "p", "c", 3), (d(2025, 8, 1), "p", "c", 2)]


def test_recompute_only_affected_months(spark):
    d = dt.date
    fact = spark.createDataFrame([(d(2025, 7, 3), "p", 1.0), (d(2025, 8, 3), "p", 2.0),
                                  (d(2025, 8, 20), "p", 3.0)], "date date, p string, q double")
    batch = spark.createDataFrame([(d(2025, 8, 20), "p", 3.0), (None, "p", 9.0)], "date date, p string, q double")
    months = affected_periods(batch, "date")
    assert rows(months) == [(d(2025, 8, 1),)]
    out = recompute_periods(fact, "date", months, ["p"], "q")
    assert rows(out) == [(d(2025, 8, 1), "p", 5)]
    target = spark.createDataFrame([(d(2025, 7, 1), "p", 100), (d(2025, 8, 1), "p", 2)],
                                   "date date, p string, q bigint")
    merged = upsert(target, out, ["date", "p"])
    # July untouched, August replaced (idempotent: re-running gives the same)
    assert rows(merged) == [(d(2025, 7, 1), "p", 100), (d(2025, 8, 1), "p", 5)]
    assert rows(upsert(merged, out, ["date", "p"])) == rows(merged)


# --- upsert -------------------------------------------------------------------------------------
@pytest.fixture
def tgt(spark):
    return spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0), (2, "b2", 2.5), (None, "n", 0.0)],
                                 "k int, name string, v double")


def test_upsert_all_columns(spark, tgt):
    src = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0), (None, "m", 9.0)], "k int, name string, v double")
    out = upsert(tgt, src, ["k"])
    # both target rows with k=2 updated; NULL key never matches -> inserted
    want = [(1, "a", 1.0), (2, "B", 20.0), (2, "B", 20.0), (None, "n", 0.0),
            (3, "c", 3.0), (None, "m", 9.0)]
    assert rows(out) == sorted(want, key=_key)


def test_upsert_is_idempotent(spark, tgt):
    src = spark.createDataFrame([(1, "A", 10.0), (4, "d", 4.0)], "k int, name string, v double")
    once = upsert(tgt, src, ["k"])
    assert rows(upsert(once, src, ["k"])) == rows(once)


def test_upsert_set_and_insert_columns(spark, tgt):
    src = spark.createDataFrame([(1, "A", 10.0), (4, "d", 4.0)], "k int, name string, v double")
    out = upsert(tgt, src, ["k"], set_cols={"v": "v"}, insert_cols={"k": "k", "v": "v"})
    got = {r.k: (r.name, r.v) for r in out.collect() if r.k in (1, 4)}
    assert got == {1: ("a", 10.0), 4: (None, 4.0)}


def test_upsert_strict_rejects_ambiguous_source(spark, tgt):
    src = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], "k int, name string, v double")
    with pytest.raises(AmbiguousMergeError):
        upsert(tgt, src, ["k"], strict=True)
    # ambiguity on a key absent from the target is fine (pure inserts)
    src2 = spark.createDataFrame([(7, "x", 1.0), (7, "y", 2.0)], "k int, name string, v double")
    assert upsert(tgt, src2, ["k"], strict=True).count() == 6


def test_upsert_small_source_never_shuffles_target(spark):
    target = spark.range(10000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    source = spark.range(5).select(F.col("id").alias("k"), F.lit(2).alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(upsert(target, source, ["k"], materialize=False))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in p and "BroadcastHashJoin" in p


@pytest.mark.parametrize("bound", [1 << 28, 0])
def test_upsert_with_a_sequence_keeps_newer_rows(spark, bound):
    kind = "k int, v string, seq string"
    target = spark.createDataFrame([(i, "old", "5") for i in range(100, 400)] + [
        (1, "newer", "9"), (2, "same", "5"), (3, "older", "1"), (4, "none", None)], kind)
    source = spark.createDataFrame([(i, "src", "5") for i in (1, 2, 3, 4, 5)] + [(6, "src", None), (100, "src", None)], kind)
    out = upsert(target, source, ["k"], unique=True, sequence="seq", max_broadcast_bytes=bound)
    got = {r.k: r.v for r in out.collect()}
    assert {k: got[k] for k in (1, 2, 3, 4, 5, 6, 100)} == {1: "newer", 2: "src", 3: "src", 4: "src", 5: "src", 6: "src", 100: "old"}
    assert len(got) == 306


def test_change_feed_of_the_merge_equals_the_snapshot_diff(spark, tgt):
    src = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0), (None, "m", 9.0), (1, "a", 1.0)], "k int, name string, v double")
    for more in ({}, dict(set_cols={"v": "v"}, insert_cols={"k": "k", "v": "v"}), dict(sequence="v")):
        feed = upsert_changes(tgt, src, ["k"], unique=True, **more)
        want = snapshot_diff(tgt, upsert(tgt, src, ["k"], unique=True, **more), ["k"])
        assert rows(feed, *want.columns) == rows(want) and feed.count()
        assert plan(feed).count("Scan ExistingRDD") <= 2  # each side once
    with pytest.raises(AmbiguousMergeError):
        upsert_changes(tgt, src.unionByName(src), ["k"])


# --- change feed / union / profile ---------------------------------------------------------------------
def test_snapshot_diff(spark):
    before = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    after = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k int, v string")
    out = rows(snapshot_diff(before, after, ["k"]), "k", "v", "change_type")
    assert out == [(2, "B", "update_postimage"), (2, "b", "update_preimage"),
                   (3, "c", "delete"), (4, "d", "insert")]


def test_union_evolving(spark):
    a = spark.createDataFrame([(1,)], "k int")
    b = spark.createDataFrame([(2, "x")], "k int, extra string")
    assert rows(union_evolving(a, b)) == [(1, None), (2, "x")]


def test_profile_and_dq(spark):
    df = spark.createDataFrame([("1", " a"), ("1", "b"), ("2", None)], "id string, name string")
    assert rows(P.duplicate_keys(df, ["id"])) == [("1", 2)]
    assert rows(P.untrimmed(df, "name")) == [("1", " a")]
    assert rows(P.missing_values(df, ["name"])) == [("2", None)]
    prof = P.profile(df, ["id"], ["name"]).first()
    assert (prof.rows, prof.distinct_keys, prof.nulls_name, prof.untrimmed_name) == (3, 2, 1, 1)
    assert rows(P.stage_counts(df, [("all", None), ("named", F.col("name").isNotNull())])) == \
        [("all", 3), ("named", 2)]


def test_upsert_composite_key_with_null_component(spark):
    target = spark.createDataFrame([("2025-07-01", "p", 1), ("2025-07-01", None, 2)],
                                   "d string, p string, v int")
    source = spark.createDataFrame([("2025-07-01", "p", 10), ("2025-07-01", None, 20)],
                                   "d string, p string, v int")
    out = rows(upsert(target, source, ["d", "p"]))
    # (d, p) matches and is updated; a NULL in the key never matches -> kept + inserted
    assert out == [("2025-07-01", "p", 10), ("2025-07-01", None, 2), ("2025-07-01", None, 20)]


def test_snapshot_diff_null_key_and_repeats(spark):
    before = spark.createDataFrame([(None, "a"), (1, "x"), (1, "x")], "k int, v string")
    after = spark.createDataFrame([(None, "b"), (1, "x")], "k int, v string")
    out = rows(snapshot_diff(before, after, ["k"]), "k", "v", "change_type")
    # NULL keys pair with each other (NULL-safe); one of two identical rows removed
    assert out == [(1, "x", "delete"), (None, "a", "update_preimage"), (None, "b", "update_postimage")]


def test_dedupe_null_keys_form_one_group(spark):
    df = spark.createDataFrame([(None, 2), (None, 1), (1, 5)], "k int, v int")
    assert rows(dedupe(df, ["k"], ["v"])) == [(1, 5), (None, 1)]


def test_row_counts_of_stages(spark):
    a = spark.range(10)
    assert rows(P.row_counts([("all", a), ("even", a.filter("id % 2 = 0"))])) == [("all", 10), ("even", 5)]


def test_fits_reads_the_planners_size_without_a_job(spark, tmp):
    from kiln.operators.sizing import EXPANSION, estimated_bytes, fits
    spark.range(10_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("s")).write.parquet(f"{tmp}/t")
    stored = spark.read.parquet(f"{tmp}/t")
    size = estimated_bytes(stored)
    bound = EXPANSION * size  # files are compressed, the hashed relation is not
    assert size > 100_000 and fits(stored, bound) and not fits(stored, bound - 1)
    other = stored.withColumnRenamed("s", "t")
    assert not fits(stored.join(other, "id"), 10 * bound)  # a join might be as large as the product


def test_upsert_beyond_the_bound_is_one_full_outer_join(spark, tgt):
    src = spark.createDataFrame([(2, "B", 20.0), (3, "c", 3.0), (None, "m", 9.0)], "k int, name string, v double")
    small = rows(upsert(tgt, src, ["k"]))
    large = upsert(tgt, src, ["k"], max_broadcast_bytes=0)
    assert rows(large) == small and "FullOuter" in plan(large)
    some = dict(set_cols={"v": "v"}, insert_cols={"k": "k", "v": "v"})
    assert rows(upsert(tgt, src, ["k"], max_broadcast_bytes=0, **some)) == rows(upsert(tgt, src, ["k"], **some))


def test_upsert_raises_on_ambiguity_by_default(spark, tgt):
    src = spark.createDataFrame([(1, "x", 1.0), (1, "y", 2.0)], "k int, name string, v double")
    with pytest.raises(AmbiguousMergeError):
        upsert(tgt, src, ["k"])
    assert upsert(tgt, src, ["k"], strict=False).count() == 5


def test_scratch_scope_removes_its_copies(spark):
    import os

    from kiln.operators.materialize import materialize, scratch_scope
    with scratch_scope(spark):
        path = materialize(spark.range(3)).inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path)
    assert not os.path.exists(path)


def test_dedupe_ties_are_broken_by_nested_columns(spark):
    df = spark.createDataFrame([(1, [3, 1], ("b", 1)), (1, [2, 9], ("c", 1)), (1, [2, 9], ("a", 2))],
                               "k int, a array<int>, s struct<x:string,y:int>")
    assert rows(dedupe(df, ["k"]).select("k", "s.x")) == [(1, "a")]


def test_hash_key_tells_null_and_separator_apart(spark):
    from kiln.functions.clean import hash_key
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None), ("a|b", "", None), ("a", "b|", None),
                                ("a", "\\N", "b"), ("a", "", "b"), ("a\\", "b", "c"), ("a", "\\b", "c")],
                               "x string, y string, z string")
    assert df.select(hash_key("x", "y", "z").alias("h")).distinct().count() == df.count()


def test_scratch_root_is_refused_on_a_cluster_without_a_shared_folder():
    from types import SimpleNamespace

    from kiln.session import scratch_root
    nothing = SimpleNamespace(get=lambda *a: None)
    with pytest.raises(RuntimeError):
        scratch_root(SimpleNamespace(conf=nothing, sparkContext=SimpleNamespace(getConf=lambda: nothing, master="yarn")))
