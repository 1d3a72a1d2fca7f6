from datetime import datetime
from decimal import Decimal

from pyspark.sql import functions as F

from shelfledger.functions import numbers, text, times
from shelfledger.operators import ranking


def one(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_numeric_text(spark):
    values = ["5.25", "not-a-number", "", None, "5d", "1_0", " 7", "1e3", "-.5", "NaN", "inf",
              "-Infinity", "1__0", "0x10", "5."]
    parse = lambda c: numbers.safe_double(text.stripped(c))
    assert one(spark, values, parse) == [
        5.25, None, None, None, None, 10.0, 7.0, 1000.0, -0.5, None, float("inf"), float("-inf"),
        None, None, 5.0]


def test_strip_takes_every_blank(spark):
    assert one(spark, ["\t a b\n", "  x ", "\r\n", ""], text.stripped) == ["a b", "x", None, None]


def test_missing_words(spark):
    assert one(spark, ["NA", "nan", "", "x", "na"], text.csv_null) == [None, None, None, "x", "na"]


def test_labels(spark):
    assert one(spark, ["en:plant-based-foods", "unknown", "fr:l'eau"], text.tag_label) == [
        "Plant Based Foods", "Unknown", "L'Eau"]
    assert one(spark, ["in_stock"], text.status_label) == ["In Stock"]


def test_uuid_forms(spark):
    plain = "a0eebc99-9c0b-4ef8-bb6d-6bb9bd380a11"
    values = [plain.upper(), "{" + plain + "}", plain.replace("-", ""), "{" + plain, "x"]
    assert one(spark, values, text.canonical_uuid) == [plain, plain, plain, "{" + plain, "x"]


def test_timestamps(spark):
    values = ["2025-01-02T03:04:05+02:00", "2025-01-02", "20250102T030405Z", "1/2/2025", "bad", "", None]
    as_text = lambda c: times.parse_timestamp(c).cast("string")
    assert one(spark, values, as_text) == [
        "2025-01-02 01:04:05", "2025-01-02 00:00:00", "2025-01-02 03:04:05", "2025-01-02 00:00:00",
        None, None, None]


def test_epoch_seconds(spark):
    as_text = lambda c: times.from_epoch(c).cast("string")
    assert one(spark, ["1700000000", "0", None, "x", "9e30"], as_text) == [
        "2023-11-14 22:13:20", None, None, None, None]


def test_halves_round_away_from_zero(spark):
    df = spark.createDataFrame([(1, 2), (-1, 2), (3, 2), (7, 3), (5, 0)], "a long, b long")
    assert [r[0] for r in df.select(numbers.half_up(F.col("a"), F.col("b"))).collect()] == [1, -1, 2, 2, None]


def test_percent(spark):
    df = spark.createDataFrame([(1, 3), (-1, 8), (54, 450), (1, 0)], "a long, b long")
    got = [r[0] for r in df.select(numbers.percent(F.col("a"), F.col("b"), 1)).collect()]
    assert got == [Decimal("33.3"), Decimal("-12.5"), Decimal("12.0"), None]


def test_mean_of_money_is_exact(spark):
    # 1.00 and 1.01 average to 1.005, which a double cannot hold
    df = spark.createDataFrame([(Decimal("1.00"),), (Decimal("1.01"),)], "price decimal(10,2)")
    c = numbers.cents(F.col("price"))
    assert df.agg(numbers.money(numbers.mean_cents(F.sum(c), F.count("price")))).first()[0] == Decimal("1.01")


def test_date_window(spark):
    days = [datetime(2025, 1, d, 12) for d in range(1, 8)]
    df = spark.createDataFrame([(d,) for d in days], "at timestamp")
    assert times.date_window(df, "at").count() == 7
    assert times.date_window(df, "at", "2025-01-02T00:00:00Z", "2025-01-04T00:00:00Z").count() == 2
    assert times.date_window(df, "at", last_days=3, as_of="2025-01-07T18:00:00Z").count() == 3
    assert times.date_window(df, "at", start="2026-01-01T00:00:00Z").count() == 0


def test_histogram_bounds(spark):
    prices = [("0.00",), ("2.49",), ("2.50",), ("24.99",), ("25.00",), ("99.00",)]
    df = spark.createDataFrame(prices, "p string").select(F.col("p").cast("decimal(10,2)").alias("price"))
    got = {r["price_band"]: r["price_records"] for r in ranking.fixed_bands(df).collect()}
    assert got == {"0.0 - 2.5": 2, "2.5 - 5.0": 1, "22.5 - 25.0": 1, "25.0 - 27.5": 2}


def test_histogram_of_one_price_has_one_band(spark):
    df = spark.sql("SELECT cast(3 as decimal(10,2)) AS price FROM range(4)")
    assert [tuple(r) for r in ranking.data_bands(df).collect()] == [(1, 3.0, 4)]


def test_top_with_other(spark):
    df = spark.createDataFrame([("a", 5), ("b", 3), ("c", 3), ("d", 1)], "label string, n long")
    got = {r["label"]: r["n"] for r in ranking.top_with_other(df, "label", "n", 2).collect()}
    assert got == {"a": 5, "b": 3, "Other": 4}
    assert ranking.top_with_other(df, "label", "n", 9).count() == 4
