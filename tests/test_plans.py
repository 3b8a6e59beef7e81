import datetime as dt
import glob
import os

import pytest
from pyspark.sql import functions as F

from kiln.functions import constants as K
from kiln.plans import dims, facts
from kiln.sources.tables import TableStore
from kiln.workloads import dirty as D

from paths import SF_SMALL


def srt(rows):
    return sorted(rows, key=lambda t: tuple((x is None, str(x)) for x in t))


def test_date_dim_24_months(spark):
    df = dims.date_dim(spark, "2024-01-01", "2025-12-01")
    r = df.orderBy("month_start").collect()
    assert len(r) == 24
    assert (r[0].month_start, r[0].date_key, r[0].year, r[0].month_name, r[0].month_short,
            r[0].quarter, r[0].year_quarter) == (dt.date(2024, 1, 1), 202401, 2024, "January",
                                                 "Jan", "Q1", "2024-Q1")
    assert r[-1].month_start == dt.date(2025, 12, 1)


def test_customer_dimension(spark, tmp):
    bronze = spark.createDataFrame([
        ("789101", " sprintx nutrition ", "bengalore"),
        ("789101", " sprintx nutrition ", "bengalore"),
        ("789201", "ZENATHLETE FOODS", "Hyderabadd"),
        ("789301", "recovery lane", None),
        ("789420", "primefuel nutrition", "Pune"),
    ], "customer_id string, customer_name string, city string")
    silver = dims.customers_silver(bronze, corrections=dims.customer_corrections(spark))
    got = {r.customer_id: (r.customer_name, r.city, r.customer) for r in silver.collect()}
    assert got == {
        "789101": ("Sprintx Nutrition", "Bengaluru", "Sprintx Nutrition-Bengaluru"),
        "789201": ("Zenathlete Foods", "Hyderabad", "Zenathlete Foods-Hyderabad"),
        "789301": ("Recovery Lane", None, "Recovery Lane-unknown"),
        "789420": ("Primefuel Nutrition", "Bengaluru", "Primefuel Nutrition-Bengaluru"),
    }
    src = dims.customers_parent_source(dims.customers_gold(silver))
    assert {(r.market, r.platform, r.channel) for r in src.collect()} == {
        (K.CUSTOMER_MARKET, K.CUSTOMER_PLATFORM, K.CUSTOMER_CHANNEL)}
    # parent upsert through the table store: an existing parent row is kept
    store = TableStore(spark, tmp)
    store.write(spark.createDataFrame([("1", "Old-Delhi", "India", "Shop", "Retail")],
                                      "customer_code string, customer string, market string, "
                                      "platform string, channel string"), "gold", "dim_customers")
    parent = dims.run_dimension(store, "customers", bronze,
                                lambda b: dims.customers_silver(b, corrections=dims.customer_corrections(spark)),
                                dims.customers_gold, dims.customers_parent_source,
                                "dim_customers", ["customer_code"])
    once = srt(tuple(r) for r in parent.collect())
    assert len(once) == 5
    again = dims.run_dimension(store, "customers", bronze,
                               lambda b: dims.customers_silver(b, corrections=dims.customer_corrections(spark)),
                               dims.customers_gold, dims.customers_parent_source,
                               "dim_customers", ["customer_code"])
    assert srt(tuple(r) for r in again.collect()) == once


def test_product_dimension(spark):
    bronze = spark.createDataFrame([
        ("SportsBar Protien Bar Peanut (60g)", "25891501", "protien bars"),
        ("SportsBar Energy Bar Choco Fudge (60g)", "25891502", "energy bars"),
        ("SportsBar Energy Bar Choco Fudge (60g)", "25891502", "energy bars"),
        ("SportsBar Oats Cookie Bites (500g)", "XYZ123", "granola & cereals"),
    ], "product_name string, product_id string, category string")
    silver = dims.products_silver(bronze)
    got = {r.product_id: (r.product_name, r.category, r.division, r.variations) for r in silver.collect()}
    assert got == {
        "25891501": ("SportsBar Protein Bar Peanut (60g)", "Protein Bars", "Nutrition Bars", "60g"),
        "25891502": ("SportsBar Energy Bar Choco Fudge (60g)", "Energy Bars", "Nutrition Bars", "60g"),
        "9999999": ("SportsBar Oats Cookie Bites (500g)", "Granola & Cereals", "Breakfast Foods", "500g"),
    }
    import hashlib
    code = {r.product_id: r.product_code for r in silver.collect()}["25891501"]
    assert code == hashlib.sha256(b"SportsBar Protein Bar Peanut (60g)").hexdigest()


def test_price_dimension(spark):
    products = dims.products_silver(spark.createDataFrame(
        [("A (1g)", "1", "energy bars"), ("B (1g)", "2", "energy bars")],
        "product_name string, product_id string, category string"))
    bronze = spark.createDataFrame([
        ("1", "2025/11/01", "-120"), ("1", "01/12/2025", "0"), ("1", "2024-05-01", "unknown"),
        ("2", "01-12-2025", "not_available"), ("2", "2025-10-01", "0"),
        ("88888888", "2025-12-01", "5")], "product_id string, month string, gross_price string")
    silver = dims.prices_silver(bronze, products)
    assert silver.count() == 5
    parent = dims.prices_parent_source(dims.prices_gold(silver))
    codes = {r.product_id: r.product_code for r in products.collect()}
    got = {(r.product_code, r.year): r.price_inr for r in parent.collect()}
    assert got == {(codes["1"], "2025"): 120.0, (codes["1"], "2024"): 0.0,
                   (codes["2"], "2025"): 0.0}


def _lines(spark):
    return D.order_lines(spark, SF_SMALL)


def _products(spark):
    return dims.products_silver(D.product_rows(spark, SF_SMALL), divisions=D.TESTDATA_DIVISIONS)


def test_incremental_equals_full(spark, tmp):
    lines = _lines(spark)
    products = _products(spark)
    full = facts.full_load(lines.select(*facts.ORDER_COLS), products).parent
    first = (F.col("o_orderdate") < F.lit("1998-01-15").cast("timestamp_ntz")) & (F.col("l_partkey") % 3 > 0)
    b1 = lines.filter(first).select(*facts.ORDER_COLS)
    b2 = lines.filter(~first).select(*facts.ORDER_COLS)
    meet = facts.affected_periods(facts.orders_clean(b1), "order_placement_date").join(
        facts.affected_periods(facts.orders_clean(b2), "order_placement_date"), "month")
    assert meet.count() > 5  # months that both batches touch
    lazy = facts.incremental_load(b2, products, facts.full_load(b1, products)).parent
    want = srt(tuple(r) for r in full.collect())
    assert srt(tuple(r) for r in lazy.select(*full.columns).collect()) == want
    store = TableStore(spark, tmp)
    p = store.write(products, "silver", "products")
    facts.run_fact_load(store, b1, p)
    st = facts.run_fact_load(store, b2, p)
    assert srt(tuple(r) for r in st.parent.select(*full.columns).collect()) == want
    n_gold = st.gold.count()
    # re-running a batch replaces the same months with the same sums
    st2 = facts.run_fact_load(store, b2, p)
    assert srt(tuple(r) for r in st2.parent.select(*full.columns).collect()) == want
    assert st2.gold.count() == n_gold


def test_batch_order_does_not_matter(spark, tmp):
    lines = _lines(spark)
    products = _products(spark)
    odd = F.col("l_partkey") % 2 == 1  # the products of one order land in both batches
    a, b = lines.filter(odd).select(*facts.ORDER_COLS), lines.filter(~odd).select(*facts.ORDER_COLS)
    s1 = facts.incremental_load(b, products, facts.full_load(a, products)).parent
    s2 = facts.incremental_load(a, products, facts.full_load(b, products)).parent
    assert srt(tuple(r) for r in s1.collect()) == srt(tuple(r) for r in s2.select(*s1.columns).collect())


def test_fact_rejects_are_placeholders(spark):
    lines = _lines(spark).select(*facts.ORDER_COLS)
    ids = {r.product_id for r in facts.order_rejects(lines, _products(spark)).select("product_id").distinct().collect()}
    assert "99999999" in ids


def test_full_load_dedupe_variant_with_quantity_in_key(spark):
    """Full-load style dedupe: five raw columns incl. quantity (before the id clean-up)."""
    bronze = spark.createDataFrame([
        ("1", "2025-07-01", "ABC987", "1", "5"), ("1", "2025-07-01", "ABC987", "1", "5"),
        ("1", "2025-07-01", "ABC987", "1", "7"), ("2", "2025-07-01", "789101", "1", "1")],
        "order_id string, order_placement_date string, customer_id string, product_id string, "
        "order_qty string")
    products = spark.createDataFrame([("1", "h")], "product_id string, product_code string")
    five = facts.orders_silver(bronze, products, dedupe_keys=facts.ORDER_COLS)
    four = facts.orders_silver(bronze, products)
    assert sorted((r.order_id, r.order_qty) for r in five.collect()) == [("1", 5.0), ("1", 7.0), ("2", 1.0)]
    assert sorted((r.order_id, r.order_qty) for r in four.collect()) == [("1", 7.0), ("2", 1.0)]


def test_rows_with_bad_ids_all_stay(spark, tmp):
    products = spark.createDataFrame([("A (1g)", "XYZ1", "energy bars"), ("B (2g)", "XYZ2", "energy bars"),
                                      ("B (2g)", "XYZ2", "energy bars"), ("C (3g)", "3", "energy bars")],
                                     "product_name string, product_id string, category string")
    silver = dims.products_silver(products)
    assert sorted((r.product_id, r.variations) for r in silver.collect()) == [("3", "3g"), ("9999999", "1g"), ("9999999", "2g")]
    assert dims.products_parent_source(dims.products_gold(silver)).count() == 3
    assert [r.product_id for r in dims.product_keys(silver).collect()] == ["3"]
    customers = spark.createDataFrame([("AB1", "x", "Pune"), ("AB2", "y", "Pune"), ("AB2", "y", "Pune"), ("5", "z", "Pune")],
                                      "customer_id string, customer_name string, city string")
    silver = dims.customers_silver(customers)
    assert sorted((r.customer_id, r.customer_name) for r in silver.collect()) == [("5", "Z"), ("999999", "X"), ("999999", "Y")]
    src = dims.customers_parent_source(dims.customers_gold(silver))
    assert [r.customer_code for r in src.orderBy("customer_code").collect()] == ["5", "999999"]


def test_replay_with_bad_dates_changes_nothing(spark, tmp):
    cols = "order_id string, order_placement_date string, customer_id string, product_id string, order_qty string"
    batch = spark.createDataFrame([("1", "2025-07-01", "789101", "1", "5"), ("2", "soon", "789101", "1", "3"),
                                   ("3", "2025-07-02", "789101", "1", "many"), (None, "2025-07-02", "789101", "1", "1"),
                                   ("4", "2025-07-02", "789101", "77", "1")], cols)
    products = spark.createDataFrame([("1", "h")], "product_id string, product_code string")
    store = TableStore(spark, tmp)
    for _ in range(3):
        state = facts.run_fact_load(store, batch, products, load_id="a")
        assert [tuple(r) for r in state.parent.select(*facts.PARENT_KEYS, "sold_quantity").collect()] == [
            (dt.date(2025, 7, 1), "h", "789101", 5)]
        assert state.silver.count() == state.gold.count() == 1
    rejects = store.read("silver", "rejects_orders")
    assert sorted((r.order_id or "", r.order_qty, r.reject_reason) for r in rejects.collect()) == [
        ("", "1", "no_order_id"), ("2", "3", "bad_date"), ("3", "many", "no_quantity"), ("4", "1", "unknown_product")]


def test_two_ids_of_one_product_in_two_batches(spark, tmp):
    cols = "order_id string, order_placement_date string, customer_id string, product_id string, order_qty string"
    line = lambda pid, q: ("1", "2025-07-01", "789101", pid, q)
    products = spark.createDataFrame([("1", "h"), ("2", "h")], "product_id string, product_code string")
    want = [(dt.date(2025, 7, 1), "h", "789101", 5)]  # the second batch corrects a line of the first
    for batches in ([[line("1", "2"), line("2", "3")]], [[line("1", "9")], [line("2", "3"), line("1", "2")]]):
        store = TableStore(spark, f"{tmp}/{len(batches)}")
        for rows in batches:
            state = facts.run_fact_load(store, spark.createDataFrame(rows, cols), products)
        assert [tuple(r) for r in state.parent.select(*facts.PARENT_KEYS, "sold_quantity").collect()] == want


COLS = "order_id string, order_placement_date string, customer_id string, product_id string, order_qty string"


def _load(spark, store, rows, load_id, **kw):
    products = spark.createDataFrame([("1", "h"), ("2", "g")], "product_id string, product_code string")
    return facts.run_fact_load(store, spark.createDataFrame(rows, COLS), products, load_id=load_id, **kw)


def _rows(df, *cols):
    return srt(tuple(r) for r in df.select(*cols).collect())


def test_result_depends_on_the_sequence_not_on_arrival(spark, tmp):
    from itertools import permutations
    line = lambda q: [("1", "2025-07-01", "789101", "1", q)]
    loads = {"a": line("5"), "b": line("3"), "c": line("4") + line("1")}
    for k, arrival in enumerate(permutations(loads)):
        store = TableStore(spark, f"{tmp}/{k}")
        for load in (*arrival, arrival[0]):
            state = _load(spark, store, loads[load], load)
        assert [r.order_qty for r in state.silver.collect()] == [4.0]  # the largest of the last load
    files = spark.createDataFrame([("1", "2025-07-01", "789101", "1", "9", "f1.csv"), ("1", "2025-07-01", "789101", "1", "2", "f2.csv")],
                                  COLS + ", file_name string")
    products = spark.createDataFrame([("1", "h")], "product_id string, product_code string")
    state = facts.run_fact_load(TableStore(spark, f"{tmp}/f"), files, products, sequence=F.col("file_name"))
    assert [r.order_qty for r in state.silver.collect()] == [2.0]


def test_load_that_dies_between_staging_and_publishing(spark, tmp, monkeypatch):
    first = [("1", "2025-07-01", "789101", "1", "5"), ("2", "2025-08-01", "789101", "1", "1")]
    second = [("1", "2025-07-01", "789101", "1", "7"), ("3", "2025-07-02", "789101", "2", "1")]
    want = None
    for kills in (0, 1, 2, 3):  # not at all, before the first, second and third table is published
        store = TableStore(spark, f"{tmp}/{kills}")
        _load(spark, store, first, "1")
        before = _rows(store.read("gold", "fact_orders"), *facts.PARENT_KEYS, "sold_quantity")
        published = []
        real = TableStore.publish

        def publish(self, staged, layer, name, by=()):
            published.append(name)
            if kills and len(published) >= kills:
                raise RuntimeError("killed")
            real(self, staged, layer, name, by)

        monkeypatch.setattr(TableStore, "publish", publish)
        if kills:
            with pytest.raises(RuntimeError, match="killed"):
                _load(spark, store, second, "2")
            if kills == 1:
                assert _rows(store.read("gold", "fact_orders"), *facts.PARENT_KEYS, "sold_quantity") == before
            with pytest.raises(RuntimeError, match="did not finish"):
                _load(spark, store, first, "3")
        monkeypatch.undo()
        state = _load(spark, store, second, "2")
        got = [_rows(state.silver, *facts.SILVER_KEYS, "order_qty"), _rows(state.gold, *facts.GOLD_KEYS, "sold_quantity"),
               _rows(state.parent, *facts.PARENT_KEYS, "sold_quantity")]
        want = want or got
        assert got == want and len(got[0]) == 3
        assert _load(spark, store, [], "3").parent.count() == len(got[2])


def test_loads_read_their_months_only(spark, tmp):
    from kiln.sources.tables import in_periods
    store = TableStore(spark, tmp)
    _load(spark, store, [("1", "2025-07-01", "789101", "1", "5"), ("2", "2025-08-01", "789101", "1", "1")], "1")
    judged = facts.judge_lines(spark.createDataFrame([("3", "2025-08-05", "789101", "1", "5")], COLS),
                               spark.createDataFrame([("1", "h")], "product_id string, product_code string"))
    pruned = in_periods(store.read("silver", "orders"), facts.MONTH, facts._touched(judged))
    assert "dynamicpruningexpression" in pruned._jdf.queryExecution().executedPlan().toString()
    assert [r.order_id for r in pruned.collect()] == ["2"]
    files = {f: os.path.getmtime(f) for f in glob.glob(f"{tmp}/*/*/month=2025-07-01/*.parquet")}
    _load(spark, store, [("3", "2025-08-05", "789101", "1", "5")], "2")
    assert files and all(os.path.getmtime(f) == t for f, t in files.items())


def test_restated_months(spark, tmp):
    own = spark.createDataFrame([(dt.date(2025, 7, 1), "own", "0", 9)], "date date, product_code string, customer_code string, sold_quantity bigint")
    first = [("1", "2025-07-01", "789101", "1", "5"), ("2", "2025-07-01", "789101", "2", "1"), ("3", "2025-08-01", "789101", "2", "1")]
    again = [("1", "2025-07-01", "789101", "1", "6")]
    july = dt.date(2025, 7, 1)
    for replace, kept in ((True, []), (False, [(july, "g", "789101", 1)])):
        store = TableStore(spark, f"{tmp}/{replace}")
        store.write(own, "gold", "fact_orders", partition_by=["date"])
        _load(spark, store, first, "1")
        state = _load(spark, store, again, "3", replace_periods=replace, change_feed=True)
        want = srt([(july, "own", "0", 9), (july, "h", "789101", 6), (dt.date(2025, 8, 1), "g", "789101", 1), *kept])
        assert _rows(state.parent, *facts.PARENT_KEYS, "sold_quantity") == want
        feed = _rows(store.read("silver", "changes_orders"), "order_id", "order_qty", "change_type")
        assert feed == srt([("1", 5.0, "update_preimage"), ("1", 6.0, "update_postimage"), *([("2", 1.0, "delete")] if replace else [])])
        # an older restatement deletes nothing that a later load has brought
        state = _load(spark, store, [("9", "2025-07-09", "789101", "2", "2")], "2", replace_periods=replace)
        assert {r.order_id for r in state.silver.collect()} == {"1", "3", "9"} | ({"2"} if not replace else set())


def test_late_products_leave_the_rejects_once(spark, tmp):
    store = TableStore(spark, tmp)
    products = lambda *ids: spark.createDataFrame([(i, "c" + i) for i in ids], "product_id string, product_code string")
    rows = [("1", "2025-07-01", "789101", "1", "5"), ("2", "2025-07-01", "789101", " 2 ", "3"), ("3", "2025-07-01", "789101", "3", "x")]
    facts.run_fact_load(store, spark.createDataFrame(rows, COLS), products("1"), load_id="1")
    facts.run_fact_load(store, spark.createDataFrame([("4", "2025-07-01", "789101", "2", "1")], COLS), products("1"), load_id="2")
    reasons = lambda: srt((r.load_id, r.order_id, r.reject_reason) for r in store.read("silver", "rejects_orders").collect())
    assert reasons() == [("1", "2", "unknown_product"), ("1", "3", "no_quantity"), ("2", "4", "unknown_product")]
    for _ in range(2):
        state = facts.reload_rejects(store, products("1", "2"))
        assert _rows(state.gold, "order_id", "sold_quantity") == [("1", 5.0), ("2", 3.0), ("4", 1.0)]
        assert reasons() == [("1", "3", "no_quantity")]


def test_broken_rows_are_rejects(spark, tmp):
    os.makedirs(f"{tmp}/l")
    with open(f"{tmp}/l/a.csv", "w") as f:
        f.write("order_id,order_placement_date,customer_id,product_id,order_qty\n1,2025-07-01,5,1,2\n2,2025-07-01,5,1,2,surplus\n3,2025\n")
    from kiln.sources.csv import read_csv
    batch = read_csv(spark, f"{tmp}/l/*.csv", corrupt=True, lineage=False)
    store = TableStore(spark, f"{tmp}/w")
    products = spark.createDataFrame([("1", "h")], "product_id string, product_code string")
    state = facts.run_fact_load(store, batch, products)
    assert [r.order_id for r in state.silver.collect()] == ["1"] and "_corrupt_record" not in state.silver.columns
    rejects = store.read("silver", "rejects_orders").collect()
    assert sorted((r.order_id, r.reject_reason, r._corrupt_record) for r in rejects) == [
        ("2", "broken_row", "2,2025-07-01,5,1,2,surplus"), ("3", "broken_row", "3,2025")]


def test_dates_are_parsed_once(spark):
    lines = spark.createDataFrame([("1", "2025-07-01", "789101", "1", "5"), ("2", "soon", "789101", "1", "3")], COLS)
    clean = facts.orders_clean(lines)
    plan = clean._jdf.queryExecution().optimizedPlan()
    parses = [line for line in plan.toString().split("\n") if "gettimestamp" in line.lower()]
    assert len(parses) == 1 and "Filter" not in parses[0]
    assert [(r.order_id, r.order_placement_date) for r in clean.collect()] == [("1", dt.date(2025, 7, 1))]


def test_order_lines_join_once(spark):
    lines = _lines(spark)
    assert lines._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 1
    n = spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").groupBy((F.col("l_linenumber") % 7 == 0).alias("twice")).count()
    assert lines.count() == sum(r["count"] * (2 if r.twice else 1) for r in n.collect())


def test_lines_move_without_their_codes(spark, tmp, monkeypatch):
    """A merge moves each line once and no text of a code; stored codes that have changed since stay."""
    long = "f" * 64
    products = lambda *codes: spark.createDataFrame([(str(i), c) for i, c in enumerate(codes, 1)], "product_id string, product_code string")
    own = spark.createDataFrame([(dt.date(2025, 7, 1), c, "0", 9) for c in ("own", "#1", "=1", None, None)],
                                "date date, product_code string, customer_code string, sold_quantity bigint")
    first = [("1", "2025-07-01", "789101", "1", "5", "web"), ("2", "2025-07-01", "789101", "2", "1", "web"), ("2", "2025-07-01", "789101", "3", "1", "web")]
    again = [("1", "2025-07-02", "789101", "1", "4"), ("2", "2025-07-01", "789101", "2", "6")]
    got = []
    for late in (True, False):
        monkeypatch.setattr(facts, "fits", lambda df, late=late: late)
        store = TableStore(spark, f"{tmp}/{late}")
        store.write(own, "gold", "fact_orders", partition_by=["date"])
        facts.run_fact_load(store, spark.createDataFrame(first, COLS + ", channel string"), products(long, long, "c"), load_id="1")
        state = facts.run_fact_load(store, spark.createDataFrame(again, COLS), products("new", "b", "c"), load_id="2", change_feed=True)
        got.append([_rows(state.silver, *facts.SILVER_KEYS, "product_code", "channel", "order_qty", "load_seq"),
                    _rows(state.gold, *facts.GOLD_KEYS, "product_code", "sold_quantity"), _rows(state.parent, *facts.PARENT_KEYS, "sold_quantity"),
                    _rows(store.read("silver", "changes_orders"), "order_id", "product_code", "channel", "order_qty", "change_type")])
    assert got[0] == got[1]
    july, day = dt.date(2025, 7, 1), dt.date(2025, 7, 2)
    assert got[0][0] == srt([("1", july, "789101", "1", long, "web", 5.0, "1"), ("1", day, "789101", "1", "new", None, 4.0, "2"),
                             ("2", july, "789101", "2", "b", "web", 6.0, "2"), ("2", july, "789101", "3", "c", "web", 1.0, "1")])
    assert got[0][2] == srt([*[(july, c, "0", 9) for c in ("own", "#1", "=1", None, None)], (july, long, "789101", 5), (july, "new", "789101", 4),
                             (july, "b", "789101", 6), (july, "c", "789101", 1)])
    monkeypatch.undo()
    codes = facts._Codes(products(long, "b"))
    lines = facts._accepted(facts._judged(spark.createDataFrame(again, COLS), codes, F.lit("2"), "t"))
    plan = codes.restore(facts._latest_lines(lines, None, 1 << 30))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("- Exchange rangepartitioning") == plan.count("- Exchange ") == 1


def test_a_merge_moves_lines_sums_and_parent_once(spark, tmp, monkeypatch):
    """The parent's new rows come out of the shuffle of the lines, whatever fits a broadcast, and equal the plain rollup."""
    products = spark.createDataFrame([(str(i), "f" * 60 + str(i % 3)) for i in range(1, 8)], "product_id string, product_code string")
    line = lambda o, m, c, p, q: (str(o), f"2025-{m:02d}-{1 + o % 9:02d}", str(c), str(p), str(q))
    first = [line(o, 7 + o % 2, 100 + o % 4, 1 + o % 7, 1 + o) for o in range(40)]
    again = [line(o, 7, 100 + o % 4, 1 + o % 5, 2 + o) for o in range(0, 60, 2)] + [("90", "2025-07-02", None, "1", "3")]
    own = spark.createDataFrame([(dt.date(2025, 7, 1), c, k, 9, "p") for c, k in (("own", "0"), ("f" * 60 + "1", "100"), (None, "100"), ("own", "0"))],
                                "date date, product_code string, customer_code string, sold_quantity int, source string")
    batches = [spark.createDataFrame(rows, COLS) for rows in (first, again)]
    want = facts.full_load(batches[0], products)
    parent = facts.upsert(own, want.parent, facts.PARENT_KEYS)
    want = facts.incremental_load(batches[1], products, facts.FactState(want.silver, want.gold, parent))
    for fitting in ((True, True), (True, False), (False, False)):  # codes, codes by product id
        for replace in (False, True):
            store = TableStore(spark, f"{tmp}/{fitting[0]}{fitting[1]}{replace}")
            store.write(own, "gold", "fact_orders", partition_by=["date"])
            for k, batch in enumerate(batches):
                answers = iter(fitting)
                monkeypatch.setattr(facts, "fits", lambda df, answers=answers: next(answers))
                state = facts.run_fact_load(store, batch, products, load_id=str(k), replace_periods=replace and k == 1, change_feed=True)
            got = _rows(state.parent, *own.columns)
            if not replace:
                assert got == _rows(want.parent, *own.columns)
                assert _rows(state.gold, *facts.GOLD_KEYS, "product_code", "sold_quantity") == _rows(want.gold, *facts.GOLD_KEYS, "product_code", "sold_quantity")
            else:
                july = facts.parent_rollup(facts.orders_gold(facts.orders_silver(batches[1], products)))
                keys = {tuple(r) for r in july.select(*facts.PARENT_KEYS).collect()}
                mine = [r for r in got if r[0] == dt.date(2025, 7, 1) and r[1] not in ("own", None)]
                assert {r[:3] for r in mine} == keys and sum(r[3] for r in mine) == sum(r.sold_quantity for r in july.collect())
                assert [r[:4] for r in got if r[1] in ("own", None)] == srt([(dt.date(2025, 7, 1), c, k, 9) for c, k in (("own", "0"), (None, "100"), ("own", "0"))])
    monkeypatch.undo()
    codes = facts._Codes(products)
    lines = facts._accepted(facts._judged(batches[1], codes, F.lit("2"), "t"))
    moved = facts._latest_lines(lines, None, 1 << 30, held=facts._held_rows(own, codes))
    plan = facts._with_sums(codes.refs(moved), False)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("- Exchange rangepartitioning") == plan.count("- Exchange ") == 1


def test_splits_of_a_load_are_bounded(spark, tmp):
    from kiln.operators.sizing import smaller_splits
    key = "spark.sql.files.maxPartitionBytes"
    size = lambda: spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    before, seen = size(), []

    class Store(TableStore):
        def publish(self, *args):
            seen.append(size())
            super().publish(*args)

    _load(spark, Store(spark, tmp), [("1", "2025-07-01", "789101", "1", "5")], "1")
    assert seen == [facts.SPLIT_BYTES] * 3 and size() == before
    with smaller_splits(spark, 1 << 40):
        assert size() == before


def test_a_load_writes_the_months_it_changes_only(spark, tmp):
    store = TableStore(spark, tmp)
    rows = [("1", "2025-07-01", "789101", "1", "5"), ("2", "2025-07-02", "789101", "1", "6"), ("3", "2025-08-01", "789102", "1", "7")]
    tables = ("silver/orders", "gold/fact_orders_daily", "gold/fact_orders")

    def files():
        return {t: set(glob.glob(f"{tmp}/{t}/*/*.parquet")) for t in tables}

    _load(spark, store, rows, "1")
    first = files()
    assert all(len(first[t]) >= 2 for t in tables)
    _load(spark, store, rows, "1")
    assert files() == first
    state = _load(spark, store, [("3", "2025-08-01", "789102", "1", "8"), rows[0]], "1")  # 8 is more than 7
    now = files()
    for t in tables:
        assert {f for f in now[t] if "=2025-07" in f} == {f for f in first[t] if "=2025-07" in f}
        assert not {f for f in now[t] if "=2025-08" in f} & first[t]
    assert sorted(r.sold_quantity for r in state.parent.collect()) == [8, 11]
    # a sum that another has written over comes back, and a row of another stays
    parent = store.read("gold", "fact_orders").withColumn("sold_quantity", F.lit(1).cast("bigint"))
    own = parent.limit(1).withColumn("product_code", F.lit("own"))
    store.replace(parent.unionByName(own), "gold", "fact_orders", ["date"])
    state = _load(spark, store, rows[:2], "1")
    assert sorted(r.sold_quantity for r in state.parent.collect() if r.date == dt.date(2025, 7, 1) and r.product_code != "own") == [11]
    assert state.parent.filter("product_code = 'own'").count() == 1


def test_change_feed_moves_no_line(spark, tmp):
    """The feed is a projection of the staged merge and equals the difference of the snapshots."""
    from kiln.operators.diff import snapshot_diff

    products = lambda *codes: spark.createDataFrame([(str(i), c * 64) for i, c in enumerate(codes, 1)], "product_id string, product_code string")
    line = lambda o, p, q: (str(o), f"2025-0{7 + o % 2}-{1 + o % 9:02d}", str(100 + o % 4), str(p), str(q))
    feeds = []

    class Store(TableStore):
        def write_load(self, df, layer, name, load_id):
            if name.startswith("changes"):
                feeds.append(df._jdf.queryExecution().executedPlan().toString())
            return super().write_load(df, layer, name, load_id)

    store = Store(spark, tmp)
    first = [line(o, 1 + o % 3, o) for o in range(30)]
    facts.run_fact_load(store, spark.createDataFrame(first, COLS), products("a", "b", "c"), load_id="1")
    before = store.read("silver", "orders").drop("load_seq", "month")
    before = spark.createDataFrame(before.collect(), before.schema)
    again = [line(o, 1 + o % 3, o + (o % 5 == 0)) for o in range(10, 40)]
    facts.run_fact_load(store, spark.createDataFrame(again, COLS), products("a", "d", "c"), load_id="2", change_feed=True)
    after = store.read("silver", "orders").drop("load_seq", "month")
    cols = [*before.columns, "change_type"]
    want = _rows(snapshot_diff(before, after, list(facts.SILVER_KEYS)), *cols)
    got = _rows(store.read("silver", "changes_orders"), *cols)
    assert got == want and len({r[-1] for r in got}) == 3
    assert len(feeds) == 1 and "Exchange hashpartitioning" not in feeds[0] and "rangepartitioning" not in feeds[0]


def test_order_lines_are_dealt_before_the_join(spark):
    lines = D.order_lines(spark, SF_SMALL, partitions=9)
    plan = lines._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Join") < plan.index("RepartitionByExpression") and plan.count("RepartitionByExpression") == 1
    at = lines.withColumn("at", F.spark_partition_id())
    assert lines.rdd.getNumPartitions() == 9
    assert at.groupBy("order_id").agg(F.count_distinct("at").alias("n")).filter("n > 1").isEmpty()
    assert srt(map(tuple, lines.collect())) == srt(map(tuple, D.order_lines(spark, SF_SMALL).collect()))


def test_a_merge_task_sorts_few_megabytes(spark):
    """Two sorts of a merge are in memory at once, 45 to 80 times as large as the stored lines."""
    products = spark.createDataFrame([("1", "a")], "product_id string, product_code string")
    lines = facts._accepted(facts._judged(spark.createDataFrame([("1", "2025-07-01", "789101", "1", "5")], COLS), facts._Codes(products), F.lit("1"), "t"))
    for stored in (1, 24 << 20, 600 << 20):
        tasks = facts._latest_lines(lines, None, stored)._jdf.queryExecution().optimizedPlan().toString().split("RepartitionByExpression ")[1]
        assert int(tasks.split("], ")[1].split("\n")[0].split(",")[0]) >= stored / (4 << 20)


def test_lines_are_typed_after_their_product_is_found(spark):
    """Beyond the broadcast bound the join moves every line: as it came, not as text and typed as well."""
    bronze = spark.createDataFrame([("1", "2025-07-01", "789101", " 1", "5", "web"), ("2", "soon", "x", "9", "3", None)], COLS + ", channel string")
    products = spark.createDataFrame([("1", "a")], "product_id string, product_code string")
    judged = facts.judge_lines(bronze, products)
    assert judged.columns == ["product_id", "order_id", "order_placement_date", "customer_id", "order_qty", "channel", "__raw",
                              "reject_reason", "product_code"]
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join "):]
    assert "__raw" not in below and "gettimestamp" not in below.lower() and "gettimestamp" in plan.lower()
    assert srt(tuple(r) for r in judged.drop("__raw").collect()) == srt([
        ("1", "1", dt.date(2025, 7, 1), "789101", 5.0, "web", "", "a"), ("9", "2", None, "999999", 3.0, None, "bad_date", None)])
    assert srt(r.product_id for r in judged.select("__raw.*").collect()) == [" 1", "9"]


def test_judging_stays_small_enough_to_be_compiled(spark, monkeypatch):
    """The JVM compiles no method of more than 8,000 bytes of code; lines judged by one took three times as long."""
    import re

    lines = spark.createDataFrame([("1", "2025-07-01", "789101", "1", "5")], COLS)
    products = spark.createDataFrame([("1", "a")], "product_id string, product_code string")
    judged = {}
    for late in (True, False):
        codes = facts._Codes(products)
        codes.late = late
        with monkeypatch.context() as m:
            m.setattr(facts, "materialize", lambda df, name: judged.setdefault(late, df))
            facts._judged(lines, codes, F.lit("1"), "t")
    debug = spark._jvm.org.apache.spark.sql.execution.debug.package
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = [int(n) for df in judged.values() for n in re.findall(r"maxMethodCodeSize:(\d+)", debug.codegenString(df.repartition(2)._jdf.queryExecution().executedPlan()))]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(sizes) >= 2 and max(sizes) < 7000


def test_a_merge_sorts_by_numbers_and_writes_without_a_sort(spark, tmp):
    """Sorts of a merge begin with a hash, a join of lines hashes its small side, a write by month needs no sort."""
    import re

    products = spark.createDataFrame([("1", "a")], "product_id string, product_code string")
    codes = facts._Codes(products)
    lines = facts._accepted(facts._judged(spark.createDataFrame([("1", "2025-07-01", "789101", "1", "5")], COLS), codes, F.lit("1"), "t"))
    current = lines.withColumn(facts.MONTH, F.lit(None).cast("date"))
    plan = facts._with_sums(facts._latest_lines(lines, current, 1 << 20), False)._jdf.queryExecution().executedPlan().toString()
    sorts = re.findall(r"- \*?(?:\(\d+\) )?Sort \[(\w+)#", plan)
    assert sorts == ["__group", "__line"] and plan.count("Window ") == 2
    first = facts._latest_lines(lines, None, 1 << 20)._jdf.queryExecution().optimizedPlan().toString()
    assert "first(" not in first  # no older value is looked for where there is none
    keys = ("spark.sql.maxConcurrentOutputFileWriters", "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold")
    before, seen = [spark.conf.get(k) for k in keys], set()

    class Store(TableStore):
        def stage(self, *args):
            seen.add(tuple(spark.conf.get(k) for k in keys))
            return super().stage(*args)

    # more months than files that are open at once
    rows = [(str(k), f"20{10 + k // 12}-{1 + k % 12:02d}-01", "789101", "1", "5") for k in range(3 * facts.OPEN_MONTHS)]
    state = _load(spark, Store(spark, tmp), rows, "1")
    assert seen == {(str(facts.OPEN_MONTHS), str(64 << 20))} and [spark.conf.get(k) for k in keys] == before
    assert state.silver.count() == state.gold.count() == state.parent.count() == len(rows)
    assert state.silver.select("month").distinct().count() == len(rows)


def test_codes_of_a_small_file_are_no_large_broadcast(spark, tmp, monkeypatch):
    """A file holds a repeated code once, a hashed relation once a row; the driver would hold that."""
    from kiln.operators.materialize import materialize
    from kiln.operators.sizing import fits, hashed_fits

    ids = spark.range(30_000).select(F.col("id").cast("string").alias("product_id"), F.repeat(F.lit("f"), 64).alias("product_code"))
    stored, bound = materialize(ids, "codes"), 4 << 20
    assert fits(stored, bound) and not hashed_fits(stored, bound) and hashed_fits(stored, 16 << 20)
    lines = [("1", "2025-07-01", "789101", " 7 ", "5"), ("2", "2025-07-01", "789101", "8", "2"), ("3", "2025-07-01", "789101", "x", "2")]
    got = []
    for most in (256 << 20, 1 << 20, 0):  # all, the codes only, nothing
        monkeypatch.setattr(facts, "hashed_fits", lambda df, most=most: hashed_fits(df, most))
        codes = facts._Codes(ids)
        assert (codes._short, codes.late) == (most > 0, most > 1 << 20)
        state = facts.run_fact_load(TableStore(spark, f"{tmp}/{most}"), spark.createDataFrame(lines, COLS), ids, load_id="1")
        got.append([_rows(state.gold, *facts.GOLD_KEYS, "product_code", "sold_quantity"), _rows(state.parent, *facts.PARENT_KEYS, "sold_quantity")])
    assert got[0] == got[1] == got[2] and got[0][1] == [(dt.date(2025, 7, 1), "f" * 64, "789101", 7)]
