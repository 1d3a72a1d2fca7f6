import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from frames import keys, price_rows, uid
from shelfledger.operators import audit, drift, keyed, quality, skew
from shelfledger.plans import dashboard, gold
from shelfledger.schemas import PIPELINE_RUNS
from shelfledger.sources import files, tables


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# -- keyed tables --------------------------------------------------------------------------------

def test_upsert_keeps_creation_time(spark):
    schema = "k string, v string, created_at int, updated_at int"
    base = spark.createDataFrame([("a", "old", 1, 1), ("b", "old", 1, 1)], schema)
    delta = spark.createDataFrame([("b", None, 2, 2), ("c", "new", 2, 2)], schema)
    assert rows(keyed.upsert(base, delta, ["k"]), "k") == [
        ("a", "old", 1, 1), ("b", None, 1, 2), ("c", "new", 2, 2)]


def test_insert_if_absent_takes_the_first(spark):
    base = spark.createDataFrame([("a", 1, 0)], "k string, v int, pos int")
    new = spark.createDataFrame([("a", 2, 1), ("b", 3, 3), ("b", 4, 2)], "k string, v int, pos int")
    assert rows(keyed.insert_absent(base, new, ["k"], order="pos"), "k") == [("b", 4, 2)]


def test_marks_tell_which_places_occur(spark):
    places = spark.range(100_000).filter("id % 7 = 3 OR id % 32 IN (7, 8, 31) OR id BETWEEN 32000 AND 33000")
    got = skew.join_marks(spark.range(-1, 140_000), skew.place_marks(places, "id"), "id", "there")
    assert got.columns == ["id", "there"] and got.count() == 140_001
    assert {r["id"] for r in got.filter("there").collect()} == {r["id"] for r in places.collect()}
    assert skew.join_marks(places, skew.place_marks(places.filter("false"), "id"), "id", "there").filter("there").isEmpty()


def test_insert_if_absent_moves_keys_and_places(spark):
    """With places no other column of the new rows is shuffled; keys may be missing or repeat."""
    base = spark.range(0, 40_000, 3).selectExpr("nullif(id, 0) AS k", "'old' AS v")
    new = spark.range(40_000).selectExpr("nullif(id DIV 2, 0) AS k", "concat('new', id) AS v", "id AS pos")
    expected = rows(keyed.insert_absent(base, new, ["k"]), "pos")
    assert 20_000 < len(expected) < 40_000
    got = keyed.insert_absent(base, new, ["k"], place="pos", stage=lambda df: spark.createDataFrame(df.collect(), df.schema))
    assert got.columns == new.columns and rows(got, "pos") == expected
    assert "hashpartitioning" not in got._jdf.queryExecution().executedPlan().toString()


def test_values_are_counted_before_they_meet_a_large_table(spark):
    """A reference that is too large to broadcast gives the same counts, and no row is dealt to copies of it."""
    df = price_rows(spark, [{"event_id": uid(k), "barcode": b, "store_id": s} for k, (b, s) in enumerate(
        [("1", "s"), ("1", "t"), (None, "s"), ("9", None), ("9", "s")] * 5)])
    df = df.withColumns({"price": F.col("price").cast("double")})
    tables = {"products": (keys(spark, "barcode", "1", "1", "2"), "barcode"), "stores": (keys(spark, "store_id", "s"), "store_id")}
    asked = lambda: quality.check(df, quality.PRICE_CONSTRAINTS, "prices", tables, ["row_pos"])
    expected = rows(asked(), "expectation")
    assert {r[1]: r[3] for r in expected}["barcode_references_products"] == 10
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert rows(asked(), "expectation") == expected
        assert "explode" not in asked()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_last_per_key(spark):
    df = spark.createDataFrame([("a", 1, 0), ("a", None, 1)], "k string, v int, pos int")
    assert rows(keyed.last_per_key(df, ["k"], "pos"), "k") == [("a", None, 1)]


def test_retract(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, id int")
    assert rows(keyed.retract(base, keys(spark, "k", "b", "z"), "k", ["id"]), "id") == [("a", 1)]


@pytest.mark.parametrize("threshold", ["-1", "10485760"])
@pytest.mark.parametrize("how", ["left", "left_anti"])
def test_lookup_join_equals_plain_join(spark, how, threshold):
    facts = spark.range(2000).select("id", F.when(F.col("id") % 3 == 0, "hot").when(
        F.col("id") % 3 == 1, F.col("id").cast("string")).alias("k"))
    lookup = spark.range(0, 1000).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("x"))
    lookup = lookup.unionByName(spark.sql("SELECT 'hot' AS k, 2 AS x"))
    expected = rows(facts.join(lookup, "k", how).select("id", *(["x"] if how == "left" else [])), "id")
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup(None))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        joined = skew.join_lookup(facts, lookup, "k", how, ["id"])
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup(None)) == jobs
        assert joined.columns == [*facts.columns, *(["x"] if how == "left" else [])]
        assert rows(joined.select("id", *(["x"] if how == "left" else [])), "id") == expected
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_lookup_join_shuffles_each_side_once(spark):
    """A lookup too large to broadcast is copied under numbers, so that a hot key is not left to the adaptive plan; any
    other goes to the planner as it is."""
    facts, lookup = spark.range(100).selectExpr("id", "string(id % 7) AS k"), spark.range(3).selectExpr("string(id) AS k")
    plan = lambda: skew.join_lookup(facts, lookup, "k", "left", ["id"])._jdf.queryExecution().executedPlan().toString()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        copied = plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert copied.count("Exchange hashpartitioning") == 2 and copied.count("Generate explode") == 1
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100m")
    try:
        small = plan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in small and "Generate explode" not in small


# -- audit ---------------------------------------------------------------------------------------

def test_current_state_of_a_run(spark):
    at = datetime(2025, 1, 1)
    events = audit.run_event(spark, pipeline_run_id="r", status="RUNNING", started_at=at).unionByName(
        audit.run_event(spark, pipeline_run_id="r", status="FAILED", started_at=at, completed_at=at,
                        error_message="x" * 3000))
    run = audit.current_runs(events).first()
    assert run["status"] == "FAILED" and len(run["error_message"]) == 2000


def test_latest_run_of_nothing_and_of_zero_rows(spark):
    empty = spark.createDataFrame([], PIPELINE_RUNS)
    assert dashboard.latest_run(empty).count() == 0
    zero = audit.run_event(spark, pipeline_run_id="r", status="SUCCESS", source_records=0,
                           valid_records=0, rejected_records=0)
    assert dashboard.latest_run(zero).first()["rejected_pct"] is None


def test_dashboard_over_an_empty_range(spark):
    none = spark.sql("SELECT '1' AS barcode, 's' AS store_id, cast(1 as decimal(10,2)) AS price, "
                     "true AS promotion WHERE false")
    assert dashboard.average_price(none).first()[0] is None
    assert dashboard.promotion_share(none).first()[0] is None
    assert dashboard.promotion_saving(none).first()[0] is None
    assert dashboard.widest_spread(none).first()[0] is None


def test_drift_states(spark):
    published = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3"), ("x", "9")], "metric string, value string")
    recomputed = spark.createDataFrame([("a", "1"), ("b", None), ("c", "4"), ("y", "9")], "metric string, value string")
    assert rows(drift.drift(published, recomputed), "metric") == [
        ("c", "3", "4", "stale"), ("x", "9", None, "extra"), ("y", None, "9", "missing")]


# -- quality -------------------------------------------------------------------------------------

def test_price_suite(spark):
    df = price_rows(spark, [{"event_id": uid(1)}, {"event_id": uid(1), "price": "500"},
                            {"event_id": None, "price": "0"}, {"event_id": uid(2), "price": None},
                            {"event_id": uid(3), "store_id": "x", "event_timestamp": None},
                            {"event_id": uid(4), "price": "abc"}])
    found = quality.check(df, quality.PRICE_SUITE, "prices",
                          {"stores": (keys(spark, "store_id", "s"), "store_id")}, ["row_pos"])
    got = {r["expectation"]: (r["success"], r["unexpected_count"], r["element_count"]) for r in found.collect()}
    assert got == {
        "event_id_not_null": (False, 1, 6), "event_id_unique": (False, 2, 6),
        "price_in_range": (False, 3, 6), "price_positive": (False, 2, 6),
        "price_below_limit": (False, 2, 6), "store_id_known": (False, 1, 6),
        "event_timestamp_not_null": (False, 1, 6)}


def test_suite_over_no_rows_succeeds(spark):
    found = quality.check(spark.createDataFrame([], "barcode string, product_name string"),
                          quality.PRODUCT_CONSTRAINTS, "products")
    assert [(r["success"], r["element_count"]) for r in found.collect()] == [(True, 0)] * 3


def test_verdict_constraints(spark):
    df = spark.createDataFrame([("pass", 0.5, "v"), ("maybe", 1.5, None)],
                               "status string, confidence double, validator string")
    found = quality.check(df, quality.VERDICT_CONSTRAINTS, "verdicts")
    assert {r["expectation"]: r["unexpected_count"] for r in found.collect()} == {
        "status_enum": 1, "confidence_range": 1, "validator_not_null": 1}


# -- sources -------------------------------------------------------------------------------------

def test_latest_file(spark, tmp_path):
    for name in ("prices_20250101.csv", "prices_20250301.csv", "prices_20250201.csv", "x.csv"):
        (tmp_path / name).write_text("h\n")
    assert files.latest_file(spark, str(tmp_path), "prices_*.csv").endswith("prices_20250301.csv")
    with pytest.raises(FileNotFoundError):
        files.latest_file(spark, str(tmp_path), "none_*.csv")


def test_price_file(spark, tmp_path):
    path = tmp_path / "prices_1.csv"
    path.write_text("event_id,barcode,store_id,price,promotion,stock_status,event_timestamp\n"
                    'e1,007,s,-1,True,in_stock,2025-01-01T00:00:00+00:00\n"e,2",NA,,nan,False,,\n')
    got = files.read_prices(spark, str(path)).orderBy("row_pos").collect()
    assert got[0]["barcode"] == "007" and got[0]["price"] == "-1"
    assert got[1]["event_id"] == "e,2"
    assert [got[1][c] for c in ("barcode", "store_id", "price", "stock_status", "event_timestamp")] == [None] * 5
    assert got[0]["source_file"] == "prices_1.csv"


def test_position_follows_the_file_over_its_splits(spark, tmp_path):
    path = tmp_path / "prices_big.csv"
    header = "event_id,barcode,store_id,price,promotion,stock_status,event_timestamp\n"
    path.write_text(header + "".join(f"{i:07d},b,s,1,,,\n" for i in range(30000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        df = files.read_prices(spark, str(path))
        assert df.rdd.getNumPartitions() > 4
        got = [r[0] for r in df.orderBy("row_pos").select("event_id").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [f"{i:07d}" for i in range(30000)]


PRODUCT = {"code": 123, "product_name": "Tea", "brands": None, "categories_tags": ["en:teas"],
           "nutriments": {"energy-kcal_100g": 45}, "last_modified_t": 1700000000}


def test_product_document(spark, tmp_path):
    path = tmp_path / "products_1.json"
    path.write_text(json.dumps({"record_count": 2, "products": [PRODUCT, {"product_name": "x"}]}))
    got = files.read_products(spark, str(path)).orderBy("row_pos").collect()
    assert (got[0]["code"], got[0]["categories_tags"], got[0]["energy_kcal_100g"]) == ("123", ["en:teas"], "45")
    assert got[1]["code"] is None and json.loads(got[1]["payload"]) == {"product_name": "x"}
    lines = tmp_path / "products_2.json"
    lines.write_text("\n".join(json.dumps(p) for p in (PRODUCT, {"product_name": "x"})))
    same = files.read_products(spark, str(lines), lines=True).orderBy("row_pos").collect()
    assert [r["payload"] for r in same] == [r["payload"] for r in got]


def test_product_document_without_a_list(spark, tmp_path):
    path = tmp_path / "products_1.json"
    path.write_text('{"record_count": 0}')
    assert files.read_products(spark, str(path), required=False).count() == 0
    with pytest.raises(Exception, match="no products list"):
        files.read_products(spark, str(path)).collect()
    with pytest.raises(RuntimeError):
        files.usable_products(files.read_products(spark, str(path), required=False))


def test_seed_stores_and_views(spark):
    existing = spark.createDataFrame([("hamilton_01", "Mine", "H", "W")], "store_id string, store_name string, city string, region string")
    stores = tables.seed_stores(spark, existing)
    assert stores.count() == 5
    tables.register_views(spark, {"silver.stores": stores})
    assert tables.table(spark, "silver.stores").filter("store_name = 'Mine'").count() == 1
    assert tables.preview(stores, 2) == 5


def test_build_gold_counts_while_writing(spark, tmp_path):
    frames = {"a": spark.range(7).toDF("x"), "b": spark.range(0).toDF("x")}
    counts = gold.build_gold(frames, lambda name, df: df.write.parquet(str(tmp_path / name)))
    assert counts == {"a": 7, "b": 0}


def test_streamed_reports_read_no_price_rows(spark, monkeypatch):
    from shelfledger.plans import registry, warehouse
    sf = "/root/testdata/sf0.001"
    monkeypatch.setattr(warehouse, "_built", {})
    monkeypatch.setattr(warehouse.prices, "decide_packed", lambda *a, **k: pytest.fail("price rows are decided"))
    for name in ("streamed_price_by_product", "cross_tier_sql", "missing_nutrition"):
        assert registry.queries()[name](spark, sf).count() > 0


def test_every_core_writes_and_decides_a_share(spark, tmp_path, monkeypatch):
    from shelfledger.sources import mapping
    sf, cores = "/root/testdata/sf0.001", spark.sparkContext.defaultParallelism
    assert mapping.raw_products(spark, sf).rdd.getNumPartitions() == cores
    monkeypatch.setattr(mapping, "EVENT_BYTES", 1024)
    files = mapping.write_event_files(spark, sf, str(tmp_path / "events"))
    assert files > 1
    assert len(list((tmp_path / "events").glob("*.json"))) == 5 * files
