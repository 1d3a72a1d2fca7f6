import random

import pytest
from pyspark.sql import functions as F

from frames import keys, price_rows, uid
from shelfledger.operators import prices

AS_OF = "2025-06-01T00:00:00Z"


def decide(spark, rows, partitions=3, **options):
    df = prices.decide_prices(price_rows(spark, rows, partitions), keys(spark, "barcode", "1", "2"),
                              keys(spark, "store_id", "s"), AS_OF, **options)
    return {r["row_pos"]: r for r in df.collect()}


def test_each_rule(spark):
    rows = [
        {"event_id": uid(1)},
        {"event_id": None}, {"event_id": " "},
        {"event_id": uid(2), "barcode": "9"}, {"event_id": uid(3), "store_id": None},
        {"event_id": uid(4), "price": None}, {"event_id": uid(5), "price": "abc"},
        {"event_id": uid(6), "price": "0"}, {"event_id": uid(7), "price": "-1"},
        {"event_id": uid(8), "price": "500"}, {"event_id": uid(9), "price": "500.01"},
        {"event_id": uid(10), "event_timestamp": "bad"},
        {"event_id": uid(11), "event_timestamp": "2025-06-01T00:05:00Z"},
        {"event_id": uid(12), "event_timestamp": "2025-06-01T00:05:01Z"},
        {"event_id": "nope"}, {"event_id": uid(13), "price": "0.004"},
    ]
    got = decide(spark, rows)
    assert [got[i]["failure_reason"] for i in range(len(rows))] == [
        None, "Missing event ID", "Missing event ID", "Unknown product barcode", "Unknown store",
        "Missing or invalid price", "Missing or invalid price", "Price must be greater than zero",
        "Price must be greater than zero", None, "Price exceeds reasonable limit",
        "Invalid event timestamp", None, "Timestamp is in the future", "Event ID is not a UUID",
        "Price rounds to zero"]


def test_all_reasons_in_order(spark):
    rows = [{"event_id": uid(1)},
            {"event_id": uid(1), "barcode": None, "store_id": "x", "price": "", "event_timestamp": ""}]
    assert decide(spark, rows)[1]["failure_reason"] == (
        "Duplicate event ID in source file; Unknown product barcode; Unknown store; "
        "Missing or invalid price; Invalid event timestamp")


def test_limit_may_exclude_its_bound(spark):
    assert decide(spark, [{"price": "500"}], inclusive=False)[0]["failure_reason"] == "Price exceeds reasonable limit"


def test_an_id_is_seen_only_once_accepted(spark):
    rows = [{"event_id": uid(1), "price": "-1"}, {"event_id": uid(1)}, {"event_id": uid(1)},
            {"event_id": uid(1), "price": "-1"}, {"event_id": uid(2)}]
    got = decide(spark, rows)
    assert [got[i]["failure_reason"] for i in range(5)] == [
        "Price must be greater than zero", None, "Duplicate event ID in source file",
        "Duplicate event ID in source file; Price must be greater than zero", None]


def by_hand(rows):
    """The order-dependent rule as a loop."""
    seen, out = set(), []
    for row in rows:
        bad = row.get("price") == "-1"
        repeated = row["event_id"] is not None and row["event_id"] in seen
        out.append(not (bad or repeated or row["event_id"] is None))
        if out[-1]:
            seen.add(row["event_id"])
    return out


@pytest.mark.parametrize("hot_rows", [2, 50, 10**9])
def test_hot_ids_and_partitioning_do_not_change_the_result(spark, hot_rows):
    pick = random.Random(7)
    rows = []
    for _ in range(400):
        event = pick.choice([uid(1), None, uid(pick.randint(2, 90))])  # a third each
        rows.append({"event_id": event, "price": pick.choice(["2", "2", "-1"])})
    for partitions in (1, 7):
        got = decide(spark, rows, partitions, hot_rows=hot_rows)
        assert [got[i]["accepted"] for i in range(400)] == by_hand(rows)


def test_hot_rows_leave_their_partition(spark):
    """With one id on most rows the join on the id still spreads over its tasks."""
    rows = price_rows(spark, [{"event_id": uid(1)} for _ in range(3000)] + [{"event_id": None}] * 3000)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        checked = prices.check_rows(rows, keys(spark, "barcode", "1"), keys(spark, "store_id", "s"), AS_OF)
        flagged = prices.flag_repeats(checked, hot_rows=1000)
        counts = flagged.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.count_if("repeated").alias("later")).collect()
        lookup = checked.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n"), F.max("own_reason")).collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["later"] for r in counts) == 2999
    # the join on the id, and the lookups of one barcode and one store before it
    for sizes in ([r["n"] for r in counts], [r["n"] for r in lookup]):
        assert sum(sizes) == 6000 and len(sizes) == 4 and max(sizes) < 3000


def test_accepted_rows_are_typed(spark):
    rows = [{"event_id": uid(1).upper(), "price": " 2.345", "promotion": "TRUE", "stock_status": None},
            {"event_id": uid(2), "promotion": "no", "stock_status": "low_stock"}]
    df = prices.decide_prices(price_rows(spark, rows), keys(spark, "barcode", "1"),
                              keys(spark, "store_id", "s"), AS_OF)
    got = [tuple(r) for r in prices.accepted_prices(df, AS_OF).orderBy("event_id")
           .select("event_id", F.col("price").cast("string"), "promotion", "stock_status").collect()]
    assert got == [(uid(1), "2.35", True, "unknown"), (uid(2), "2.50", False, "low_stock")]


def test_same_result_when_staged(spark, tmp_path):
    def stage(df):
        df.write.parquet(str(tmp_path / "checked"))
        return spark.read.schema(df.schema).parquet(str(tmp_path / "checked"))
    rows = [{"event_id": uid(i % 4), "price": str(i % 3)} for i in range(20)]
    assert decide(spark, rows) == decide(spark, rows, stage=stage)


@pytest.mark.parametrize("limit, counted, written", [("10MB", 300, ["checked", "several", "repeated"]),
                                                     ("-1", 300, ["checked", "several", "wide"]), ("10MB", 0, ["checked", "wide"])])
def test_few_repeated_ids_leave_the_rows_where_they_are(spark, tmp_path, monkeypatch, limit, counted, written):
    """Ids are counted alone; only where many repeat are the price rows shuffled, and then what comes out is written once."""
    names = []
    monkeypatch.setattr(prices, "COUNTED", counted)

    def stage(df, name="checked"):
        names.append(name)
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))
    pick = random.Random(3)
    rows = [{"event_id": pick.choice([uid(1), None, "x", uid(pick.randint(2, 200))]), "price": pick.choice(["2", "-1"]),
             "event_timestamp": pick.choice(["2025-01-01", "20250101", "bad", None])} for _ in range(300)]
    args = (keys(spark, "barcode", "1"), keys(spark, "store_id", "s"), AS_OF)
    plain = prices.decide_packed(price_rows(spark, rows), *args)
    expected = [r.asDict(True) for r in plain.orderBy("row_pos").collect()]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        got = prices.decide_packed(price_rows(spark, rows), *args, stage=stage, stage_ids=stage, stage_wide=lambda df: stage(df, "wide"))
        shown = got._jdf.queryExecution().executedPlan().toString()
        assert got.columns == plain.columns and [r.asDict(True) for r in got.orderBy("row_pos").collect()] == expected
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert names == written
    assert "hashpartitioning" not in shown
    assert sum("Duplicate" in (r["failure_reason"] or "") for r in expected) > 5


def test_rows_travel_without_what_other_columns_tell(spark):
    """The checked rows, which are written and then shuffled by their id, hold an id as 16 bytes and no parsed value."""
    rows = [{"event_id": uid(1).upper()}, {"event_id": uid(2)}, {"event_id": uid(2)}, {"event_id": " x "}, {"event_id": ""},
            {"event_id": None}, {"event_id": uid(3), "barcode": " 1", "store_id": ""}]
    seen = []
    got = decide(spark, rows, stage=lambda df: seen.append(df) or df)
    packed = {r["row_pos"]: r for r in seen[0].collect()}
    assert not {"price_value", "event_time", "source_file"} & set(seen[0].columns)
    assert [packed[i]["event_uuid"] and bytes(packed[i]["event_uuid"]).hex()[-1] for i in range(7)] == ["1", "2", "2", None, None, None, "3"]
    assert [packed[i]["event_id"] for i in range(7)] == [None, None, None, " x ", "", None, None]
    assert [got[i]["event_id"] for i in range(7)] == [r["event_id"] for r in rows]
    assert [got[i]["event_key"] for i in range(7)] == [uid(1), uid(2), uid(2), "x", None, None, uid(3)]
    assert (got[6]["barcode"], got[6]["barcode_key"], got[6]["store_id"], got[6]["store_key"]) == (" 1", "1", "", None)
    assert [got[i]["failure_reason"] for i in (1, 2, 3, 4)] == [None, "Duplicate event ID in source file", "Event ID is not a UUID", "Missing event ID"]


@pytest.mark.parametrize("hot_rows, marked, written", [(1000, 300, ["absent_barcode_key", "absent_store_key", "checked", "repeated"]),
                                                       (20, 300, ["absent_barcode_key", "absent_store_key", "checked", "repeated"]),
                                                       (1000, 299, ["absent_barcode_key", "absent_store_key", "checked", "wide"])])
def test_only_keys_and_places_travel(spark, tmp_path, monkeypatch, hot_rows, marked, written):
    """Products too many to broadcast meet the file's barcodes, ids and places each other; the rows themselves stay where they are."""
    names = []
    monkeypatch.setattr(prices, "MARKED", marked)

    def stage(df, name="checked"):
        names.append(name)
        df.write.parquet(str(tmp_path / name))
        return spark.read.schema(df.schema).parquet(str(tmp_path / name))
    pick = random.Random(5)
    rows = [{"event_id": pick.choice([uid(1), None, "x", uid(pick.randint(2, 200))]), "price": pick.choice(["2", "-1"]),
             "barcode": pick.choice(["1", " 77 ", "1", None, "nope"]), "store_id": pick.choice(["s", "s", "t", None])} for _ in range(300)]
    args = (spark.range(200_000).selectExpr("string(id) AS barcode"), keys(spark, "store_id", "s"), AS_OF)
    plain = prices.decide_packed(price_rows(spark, rows), *args)
    expected = [r.asDict(True) for r in plain.orderBy("row_pos").collect()]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
    try:
        got = prices.decide_packed(price_rows(spark, rows), *args, hot_rows=hot_rows, stage=stage, stage_keys=stage,
                                   stage_wide=lambda df: stage(df, "wide"))
        shown = got._jdf.queryExecution().executedPlan().toString()
        assert [r.asDict(True) for r in got.select(*plain.columns).orderBy("row_pos").collect()] == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert names == written
    assert "hashpartitioning" not in shown
    assert sum("Duplicate" in (r["failure_reason"] or "") for r in expected) > 5
    assert 0 < sum("Unknown product" in (r["failure_reason"] or "") for r in expected) < 200
