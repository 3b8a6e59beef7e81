import os

from kiln.streaming.ingest import ingest_available

COLS = ["order_id", "order_placement_date", "customer_id", "product_id", "order_qty"]


def land(folder, name, rows):
    os.makedirs(folder, exist_ok=True)
    tmp = os.path.join(folder, "." + name)
    with open(tmp, "w") as f:
        f.write(",".join(COLS) + "\n")
        for r in rows:
            f.write(",".join(r) + "\n")
    os.rename(tmp, os.path.join(folder, name))  # appear atomically


def test_each_file_taken_exactly_once(spark, tmp):
    landing, ckpt, out = f"{tmp}/landing", f"{tmp}/ckpt", f"{tmp}/bronze"
    land(landing, "orders_2025_12_02.csv", [("1", "2025/12/02", "789101", "25891501", "38.0")])
    land(landing, "orders_2025_12_03.csv", [("2", "03-12-2025", "789101", "25891501", "310")])

    def sink(df, batch_id):
        df.drop("read_timestamp").write.mode("append").parquet(out)

    assert ingest_available(spark, landing, COLS, ckpt, sink, max_files_per_trigger=1) == 2
    assert ingest_available(spark, landing, COLS, ckpt, sink) == 0
    land(landing, "orders_2025_12_04.csv", [("3", "2025-12-04", "789101", "25891501", "")])
    assert ingest_available(spark, landing, COLS, ckpt, sink) == 1
    got = spark.read.parquet(out)
    assert sorted(r.order_id for r in got.collect()) == ["1", "2", "3"]
    assert {r.file_name for r in got.collect()} == {
        "orders_2025_12_02.csv", "orders_2025_12_03.csv", "orders_2025_12_04.csv"}


def test_archive_moves_taken_files(spark, tmp):
    landing, ckpt, archive = f"{tmp}/landing", f"{tmp}/ckpt", f"{tmp}/archive"
    land(landing, "orders_2025_12_02.csv", [("1", "2025/12/02", "789101", "25891501", "38.0")])
    land(landing, "orders_2025_12_03.csv", [("2", "03-12-2025", "789101", "25891501", "310")])
    seen = []
    sink = lambda df, bid: seen.extend(r.order_id for r in df.collect())
    ingest_available(spark, landing, COLS, ckpt, sink, max_files_per_trigger=1, archive_dir=archive)
    land(landing, "orders_2025_12_04.csv", [("3", "2025-12-04", "789101", "25891501", "1")])
    ingest_available(spark, landing, COLS, ckpt, sink, max_files_per_trigger=1, archive_dir=archive)
    assert sorted(seen) == ["1", "2", "3"]
    archived = [f for _, _, fs in os.walk(archive) for f in fs if f.endswith(".csv")]
    # archiving trails the batches; taken files leave the landing folder
    assert "orders_2025_12_02.csv" in archived
    assert "orders_2025_12_02.csv" not in os.listdir(landing)


def test_headers_are_looked_for_in_small_splits(spark, tmp, monkeypatch):
    from kiln.streaming import ingest
    os.makedirs(f"{tmp}/landing")
    rows = 20_000
    with open(f"{tmp}/landing/a.csv", "w") as f:
        f.write("order_id,order_qty\n" + "".join(f"{i},1\n" for i in range(rows)))
    splits, counts, real = [], [], ingest.files_by_header

    def by_header(lines):
        splits.append(lines.filter("start = 0").count())
        return real(lines)

    monkeypatch.setattr(ingest, "HEADER_SPLIT_BYTES", 32 << 10)
    monkeypatch.setattr(ingest, "files_by_header", by_header)
    ingest.ingest_available(spark, f"{tmp}/landing/*.csv", ["order_id", "order_qty"], f"{tmp}/checkpoint",
                            lambda df, _: counts.append(df.count()))
    assert counts == [rows] and splits[0] < rows // 2
