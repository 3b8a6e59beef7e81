import os

import pytest
from pyspark.sql import functions as F

from kiln.sources.csv import read_csv, write_csv
from kiln.sources.ledger import file_once_ingest
from kiln.sources.parquet import read_parquet
from kiln.sources.tables import TableStore, in_periods

COLS = ["order_id", "order_placement_date", "customer_id", "product_id", "order_qty"]


def land(spark, folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write(",".join(COLS) + "\n")
        for r in rows:
            f.write(",".join('"%s"' % v if "," in v else v for v in r) + "\n")


def test_csv_text_schema_and_lineage(spark, tmp):
    land(spark, f"{tmp}/landing", "orders_2025_07_03.csv",
         [("1", "Thursday, July 03, 2025", "789101", "25891501", "38.0"),
          ("2", "2025/07/03", "ABC987", "25891501", "")])
    df = read_csv(spark, f"{tmp}/landing/*.csv", COLS)
    assert [f.dataType.simpleString() for f in df.schema.fields[:5]] == ["string"] * 5
    r = df.orderBy("order_id").collect()
    assert r[0].file_name == "orders_2025_07_03.csv" and r[0].file_size > 0
    assert r[0].read_timestamp is not None
    assert r[1].order_qty is None  # empty field reads as NULL


def test_csv_roundtrip(spark, tmp):
    df = spark.createDataFrame([(1, "a", 2.5)], "k int, s string, v double")
    write_csv(df, f"{tmp}/out")
    back = read_csv(spark, f"{tmp}/out/*.csv", ["k", "s", "v"], lineage=False)
    assert [tuple(r) for r in back.collect()] == [("1", "a", "2.5")]


def test_file_once_ingest_loads_each_file_once(spark, tmp):
    landing, ledger, target = f"{tmp}/landing", f"{tmp}/ledger", f"{tmp}/target"
    land(spark, landing, "a.csv", [("1", "2025-07-01", "1", "1", "1")])
    land(spark, landing, "b.csv", [("2", "2025-07-02", "1", "1", "2"), ("3", "2025-07-02", "1", "1", "3")])

    def project(df):
        return df.select(F.col("order_id").cast("bigint").alias("order_id"),
                         F.to_date("order_placement_date").alias("date"),
                         F.col("order_qty").cast("double").cast("bigint").alias("qty"))

    assert file_once_ingest(spark, f"{landing}/*.csv", COLS, ledger, target, project, max_files_per_load=1) == 2
    assert file_once_ingest(spark, f"{landing}/*.csv", COLS, ledger, target, project) == 0
    land(spark, landing, "c.csv", [("4", "2025-07-03", "1", "1", "4")])
    assert file_once_ingest(spark, f"{landing}/*.csv", COLS, ledger, target, project) == 1
    got = sorted(r.order_id for r in spark.read.parquet(target).collect())
    assert got == [1, 2, 3, 4]


def test_load_that_died_is_taken_again_and_overwrites(spark, tmp):
    landing, ledger, target = f"{tmp}/landing", f"{tmp}/ledger", f"{tmp}/target"
    land(spark, landing, "a.csv", [("1", "2025-07-01", "1", "1", "1")])

    def dies(df):
        # the data is written, then the load fails before it is recorded
        df.select("order_id", "file_name").withColumn("load_id", F.lit("000000000000")).write.mode("append") \
            .partitionBy("load_id").parquet(target)
        raise RuntimeError("lost")

    with pytest.raises(Exception):
        file_once_ingest(spark, f"{landing}/*.csv", COLS, ledger, target, dies)
    land(spark, landing, "b.csv", [("2", "2025-07-01", "1", "1", "1")])
    keep = lambda df: df.select("order_id", "file_name")
    # the dead load is made again with its file, the new file in a load of its own
    assert file_once_ingest(spark, f"{landing}/*.csv", COLS, ledger, target, keep) == 2
    got = sorted((r.order_id, r.file_name) for r in spark.read.parquet(target).collect())
    assert got == [("1", "a.csv"), ("2", "b.csv")]


def test_csv_columns_are_taken_by_name(spark, tmp):
    os.makedirs(f"{tmp}/l")
    with open(f"{tmp}/l/a.csv", "w") as f:
        f.write("customer_id,order_id,channel\n7,1,web\n8,2\n")
    df = read_csv(spark, f"{tmp}/l/*.csv", ["order_id", "customer_id"], lineage=False, corrupt=True)
    assert df.columns == ["order_id", "customer_id", "channel", "_corrupt_record"]
    assert [tuple(r) for r in df.orderBy("order_id").collect()] == [("1", "7", "web", None), ("2", "8", None, "8,2")]
    with pytest.raises(ValueError):
        read_csv(spark, f"{tmp}/l/*.csv", ["order_qty"])
    with open(f"{tmp}/l/b.csv", "w") as f:
        f.write("order_id,customer_id,channel\n1,7,web\n")
    with pytest.raises(Exception, match="(?i)header"):  # two headers in one read
        read_csv(spark, f"{tmp}/l/*.csv", lineage=False).collect()


def test_table_store_partitions_and_columns(spark, tmp):
    store = TableStore(spark, tmp)
    assert not store.exists("gold", "t")
    store.write(spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "v int, m string"), "gold", "t", partition_by=["m"])
    # read and replace some partitions of one table: the others stay as they are
    old = store.read("gold", "t")
    change = old.filter("m is null or m = 'a'").withColumn("v", F.col("v") * 10).withColumn("w", F.lit("x"))
    store.replace(change, "gold", "t", ["m"])
    got = sorted(((r.v, r.w, r.m) for r in store.read("gold", "t").collect()), key=str)
    assert got == [(10, "x", "a"), (2, None, "b"), (30, "x", None)]
    store.replace(change.limit(0), "gold", "t", ["m"])
    assert store.read("gold", "t").count() == 3
    # a whole table that reads itself
    store.write(spark.range(3), "gold", "u")
    store.replace(store.read("gold", "u").select(F.col("id") + 1), "gold", "u")
    assert sorted(r[0] for r in store.read("gold", "u").collect()) == [1, 2, 3]
    assert os.listdir(f"{tmp}/_staged/gold-u") == []


def test_loads_replace_their_own_partition(spark, tmp):
    store = TableStore(spark, tmp)
    for load, rows in (("007", [(1,)]), ("2024-01-01", [(2,), (3,)]), ("007", [(4,)])):
        store.write_load(spark.createDataFrame(rows, "v int"), "bronze", "t", load)
    # ids stay text whatever they look like
    assert sorted((r.load_id, r.v) for r in store.read("bronze", "t").collect()) == [
        ("007", 4), ("2024-01-01", 2), ("2024-01-01", 3)]
    with pytest.raises(ValueError):
        store.write_load(spark.range(1), "bronze", "t", "../x")
    empty = spark.createDataFrame([], "v int, load_id string")
    store.write_load(empty.drop("load_id").limit(0), "bronze", "e", "1")
    assert store.read("bronze", "e", empty.schema).count() == store.read("bronze", "missing", empty.schema).count() == 0


def test_a_replacement_that_dies_is_finished(spark, tmp, monkeypatch):
    store = TableStore(spark, tmp)
    store.write(spark.range(3), "gold", "t")

    def dies(self, staged, layer, name, partition_by=()):
        self._delete(self.folder(layer, name))  # as far as an overwrite comes that is killed
        raise RuntimeError("killed")

    monkeypatch.setattr(TableStore, "publish", dies)
    with pytest.raises(RuntimeError):
        store.replace(store.read("gold", "t").select(F.col("id") + 10), "gold", "t")
    monkeypatch.undo()
    assert not store.exists("gold", "t")
    store.finish("gold", "t")
    assert sorted(r[0] for r in store.read("gold", "t").collect()) == [10, 11, 12]
    store.finish("gold", "t")  # nothing is left to finish
    assert store.read("gold", "t").count() == 3


def test_dynamic_partition_pruning(spark, tmp):
    store = TableStore(spark, tmp)
    table = store.write(spark.range(100).withColumn("m", F.col("id") % 4), "gold", "t", partition_by=["m"])
    periods = spark.createDataFrame([(1, "x"), (2, "x"), (2, "x"), (3, "y")], "m long, kind string").filter("kind = 'x'")
    pruned = in_periods(table, "m", periods)
    assert "dynamicpruningexpression" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 50


def test_appended_batches_are_widened(spark, tmp):
    from kiln.operators.union import append_parquet, read_evolving, wider
    from pyspark.sql.types import (DateType, DecimalType, DoubleType, FloatType, IntegerType, LongType, NullType,
                                   StringType, TimestampType)
    frame = lambda rows, kind: append_parquet(spark.createDataFrame(rows, kind), f"{tmp}/t")
    frame([(1, 5)], "k int, v int")
    frame([(2, 1 << 40)], "k int, v bigint")
    frame([(3, 6)], "k int, v int")
    assert dict(read_evolving(spark, f"{tmp}/t").dtypes) == {"k": "int", "v": "bigint"}
    frame([(2.5, 4)], "v double, k int")
    assert {r.k: r.v for r in read_evolving(spark, f"{tmp}/t").collect()} == {1: 5.0, 2: float(1 << 40), 3: 6.0, 4: 2.5}
    frame([("many", 5, True)], "v string, k int, late boolean")
    got = read_evolving(spark, f"{tmp}/t")
    assert {r.k: (r.v, r.late) for r in got.collect()}[5] == ("many", True) and dict(got.dtypes)["v"] == "string"
    for a, b, c in ((IntegerType(), LongType(), LongType()), (LongType(), FloatType(), DoubleType()),
                    (DoubleType(), StringType(), StringType()), (NullType(), DateType(), DateType()),
                    (DateType(), TimestampType(), TimestampType()), (DateType(), LongType(), StringType()),
                    (DecimalType(10, 2), DecimalType(5, 4), DecimalType(12, 4)), (DecimalType(4, 2), IntegerType(), DecimalType(12, 2)),
                    (DecimalType(38, 2), LongType(), DecimalType(38, 2))):
        assert wider(a, b) == wider(b, a) == c


def test_read_parquet_spreads_single_split(spark, tmp):
    spark.range(1000).coalesce(1).write.parquet(f"{tmp}/one")
    df = read_parquet(spark, f"{tmp}/one", min_partitions=4, min_bytes=0)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 1000
    assert read_parquet(spark, f"{tmp}/one", min_partitions=4).rdd.getNumPartitions() == 1
