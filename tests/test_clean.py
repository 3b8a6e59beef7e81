import datetime as dt

from pyspark.sql import functions as F

from kiln.functions import clean as C
from kiln.functions import constants as K


def one(spark, value, expr, schema="v string"):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("r")).first().r


def test_trim_and_title_case(spark):
    assert one(spark, "  champion's choice ", C.normalize_name("v")) == "Champion's Choice"
    assert one(spark, "a-b c", C.title_case("v")) == "A-b C"
    assert one(spark, None, C.normalize_name("v")) is None


def test_fix_typo_any_case(spark):
    assert one(spark, "SportsBar PROTIEN Bar", C.fix_typo("v")) == "SportsBar Protein Bar"
    assert one(spark, "protien", C.fix_typo("v")) == "Protein"


def test_extract_parenthesised(spark):
    assert one(spark, "SportsBar Energy Bar Choco Fudge (60g)", C.extract_parenthesised("v")) == "60g"
    assert one(spark, "no size", C.extract_parenthesised("v")) == ""


def test_hash_key_matches_sha256(spark):
    import hashlib
    assert one(spark, "abc", C.hash_key("v")) == hashlib.sha256(b"abc").hexdigest()


def test_parse_date_all_formats(spark):
    want = dt.date(2025, 7, 1)
    for text in ["Tuesday, July 01, 2025", "2025/07/01", "01/07/2025", "01-07-2025",
                 "2025-07-01", "  2025-07-01 "]:
        assert one(spark, text, C.parse_date("v")) == want, text
    for bad in ["July 2025", "2025-13-45", "unknown", None, "1/7/2025"]:
        assert one(spark, bad, C.parse_date("v")) is None, bad


def test_format_guard_is_necessary_for_every_format():
    import re
    samples = {"yyyy-MM-dd": "2025-07-01", "yyyy/MM/dd": "2025/07/01", "dd/MM/yyyy": "01/07/2025",
               "dd-MM-yyyy": "01-07-2025", "MMMM dd, yyyy": "July 01, 2025"}
    for fmt, text in samples.items():
        assert re.match(C.format_guard(fmt), text), fmt
        others = [f for f in samples if f != fmt]
        assert not any(re.match(C.format_guard(o), text) for o in others), fmt


def test_sanitize_id(spark):
    assert one(spark, "789101", C.sanitize_id("v")) == "789101"
    assert one(spark, "ABC987", C.sanitize_id("v")) == K.BAD_CUSTOMER_ID
    assert one(spark, None, C.sanitize_id("v")) == K.BAD_CUSTOMER_ID
    assert one(spark, "XYZ123", C.sanitize_id("v", K.BAD_PRODUCT_ID)) == "9999999"


def test_clean_number_abs(spark):
    assert one(spark, "-12.5", C.clean_number_abs("v")) == 12.5
    assert one(spark, "310", C.clean_number_abs("v")) == 310.0
    assert one(spark, "unknown", C.clean_number_abs("v")) == 0.0
    assert one(spark, "not_available", C.clean_number_abs("v")) == 0.0
    assert one(spark, None, C.clean_number_abs("v")) == 0.0


def test_to_double(spark):
    assert one(spark, "38.0", C.to_double("v")) == 38.0
    assert one(spark, "310", C.to_double("v")) == 310.0
    assert one(spark, "", C.to_double("v")) is None


def test_map_values_exact_and_case_insensitive(spark):
    assert one(spark, "bengalore", C.map_values("v", K.CITY_FIXES)) == "Bengaluru"
    assert one(spark, "Bengalore", C.map_values("v", K.CITY_FIXES)) == "Bengalore"
    assert one(spark, "Bengalore", C.map_values("v", K.CITY_FIXES, True)) == "Bengaluru"
    assert one(spark, "Pune", C.map_values("v", K.CITY_FIXES)) == "Pune"


def test_allow_list_and_category(spark):
    assert one(spark, "Pune", C.allow_list("v", K.ALLOWED_CITIES)) is None
    assert one(spark, "Hyderabad", C.allow_list("v", K.ALLOWED_CITIES)) == "Hyderabad"
    assert one(spark, "Energy Bars", C.map_category("v")) == "Nutrition Bars"
    assert one(spark, "Unknown", C.map_category("v")) is None


def test_zero_flag_and_month_start(spark):
    assert one(spark, 0.0, C.zero_flag("v"), "v double") == 1
    assert one(spark, 2.0, C.zero_flag("v"), "v double") == 0
    assert one(spark, dt.date(2025, 7, 19), C.month_start("v"), "v date") == dt.date(2025, 7, 1)


def test_cleaning_stays_in_codegen(spark):
    df = spark.createDataFrame([("2025-07-01", "ABC")], "d string, i string")
    plan = df.select(C.parse_date("d"), C.sanitize_id("i"))._jdf.queryExecution().executedPlan().toString()
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


def test_scale_conf_sizes_partitions():
    from kiln.session import scale_conf
    c = scale_conf(100 * 1024 ** 4, total_cores=8000)
    assert int(c["spark.sql.shuffle.partitions"]) == 409_600
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 << 20)
    small = scale_conf(1 << 30, total_cores=8)
    assert int(small["spark.sql.shuffle.partitions"]) == 16


def test_dates_by_parts_equal_dates_by_pattern(spark):
    texts = ["2025-07-01", "2025/07/01", "01/07/2025", "01-07-2025", "July 01, 2025", "Tuesday, july 31, 2025", "Monday,2025-07-01", "X, Y, 2025-07-01",
             "2025-02-29", "2024-02-29", "0000-01-01", "01/01/0000", "0001-01-01", "12025-01-01", "+12025-01-01", "-2025-01-01", "31/04/2025", "Foo 01, 2025",
             "July 00, 2025", "July  01, 2025", "2025-07-01\n", "\t2025-07-01", " 2025-07-01 ", "2025-07-01T00:00", "1/7/2025", "20250701", "01.07.2025", "Jul 01, 2025",
             "٢٠٢٥-07-01", "soon", ",", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    for formats in (K.DATE_FORMATS, ("yyyyMMdd", "dd.MM.yyyy", "MMM dd, yyyy", "MM/dd/yyyy", "d/M/yyyy", "MMMM dd, yyyy")):
        plain = F.coalesce(*[F.try_to_date(C.strip_weekday(F.trim("v")), f) for f in formats])
        rows = df.select("v", C.parse_date("v", formats).cast("string").alias("got"), plain.cast("string").alias("want")).collect()
        assert [(r.v, r.got) for r in rows] == [(r.v, r.want) for r in rows]
        assert sum(r.got is not None for r in rows) > 4
