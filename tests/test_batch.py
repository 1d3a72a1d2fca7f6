import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from frames import keys, uid
from shelfledger.plans import batch
from shelfledger.sources import files

HEADER = "event_id,barcode,store_id,price,promotion,stock_status,event_timestamp\n"


def day(n):
    return datetime(2025, 1, n, tzinfo=timezone.utc)


class Site:
    def __init__(self, spark, root):
        self.spark, self.dir, self.root = spark, root, str(root / "lake")
        self.stores = keys(spark, "store_id", "s")

    def products(self, name, *products):
        path = self.dir / name
        path.write_text(json.dumps({"products": list(products)}))
        return str(path)

    def prices(self, name, *rows):
        path = self.dir / name
        path.write_text(HEADER + "".join(
            f"{uid(e)},{b},{s},{p},False,in_stock,2025-01-01T00:00:00Z\n" for e, b, s, p in rows))
        return str(path)

    def run(self, products, prices, at, **options):
        return batch.run_batch(self.spark, self.root, products, prices, self.stores,
                               as_of=day(at), **options)

    def price_ids(self):
        return sorted(int(r["event_id"][-4:]) for r in batch.silver_prices(self.spark, self.root).collect())

    def names(self):
        return {r["barcode"]: r["product_name"] for r in batch.silver_products(self.spark, self.root).collect()}


@pytest.fixture
def site(spark, tmp_path):
    return Site(spark, tmp_path)


def tea(code, name="Tea"):
    return {"code": code, "product_name": name}


def test_runs_over_several_days(site, spark):
    p1 = site.products("products_1.json", tea("1"), tea("2"), tea("3", ""))
    c1 = site.prices("prices_1.csv", (1, "1", "s", 2), (2, "2", "s", 3), (3, "3", "s", 3),
                     (4, "1", "x", -1), (1, "1", "s", 2))
    first = site.run(p1, c1, 5)
    assert (first.source_records, first.valid_records, first.rejected_records, first.already_loaded) == (8, 4, 4, 0)
    assert first.reconciled and site.price_ids() == [1, 2]
    reasons = {r["failure_reason"] for r in batch.quarantine(spark, site.root).collect()}
    assert "Unknown store; Price must be greater than zero" in reasons
    assert "Missing product name" in reasons and "Duplicate event ID in source file" in reasons
    assert batch.verdicts(spark, site.root).count() == 3

    # the same files again: nothing is written twice
    again = site.run(p1, c1, 6)
    assert (again.valid_records, again.rejected_records, again.already_loaded) == (2, 4, 2)
    assert again.reconciled and site.price_ids() == [1, 2]
    assert batch.bronze(spark, site.root, "prices").count() == 5
    assert batch.bronze(spark, site.root, "products").count() == 3

    # a rejected product takes its earlier prices with it
    p2 = site.products("products_2.json", tea("1"), tea("2", "2"), tea("4", "New"))
    third = site.run(p2, site.prices("prices_2.csv", (5, "4", "s", 1), (6, "2", "s", 1)), 7)
    assert third.reconciled and site.price_ids() == [1, 5]
    assert site.names() == {"1": "Tea", "4": "New"}

    # and may come back, with prices of its own
    p3 = site.products("products_3.json", tea("2", "Back"))
    site.run(p3, site.prices("prices_3.csv", (2, "2", "s", 9)), 8)
    assert site.price_ids() == [1, 2, 5]
    assert site.names() == {"1": "Tea", "2": "Back", "4": "New"}
    statuses = [r["status"] for r in batch.runs(spark, site.root).collect()]
    assert statuses == ["SUCCESS"] * 4


def test_a_failed_run_changes_nothing(site, spark, monkeypatch):
    p1 = site.products("products_1.json", tea("1"))
    c1 = site.prices("prices_1.csv", (1, "1", "s", 2))
    site.run(p1, c1, 5)
    monkeypatch.setattr(batch, "price_layout", lambda rows: rows.selectExpr("nope"))
    with pytest.raises(Exception, match="nope"):
        site.run(site.products("products_2.json", tea("1", "")), c1, 6)
    assert site.names() == {"1": "Tea"} and site.price_ids() == [1]
    assert batch.quarantine(spark, site.root).count() == 0
    assert batch.bronze(spark, site.root, "products").count() == 1
    states = {r["status"]: r["error_message"] for r in batch.runs(spark, site.root).collect()}
    assert set(states) == {"SUCCESS", "FAILED"} and "nope" in states["FAILED"]


def test_broken_constraints_are_not_published(site, spark, monkeypatch):
    broken = batch.prices.accepted_prices
    monkeypatch.setattr(batch.prices, "accepted_prices",
                        lambda decided, at: broken(decided, at).selectExpr("*").withColumn("store_id", batch.F.lit("nowhere")))
    with pytest.raises(batch.ConstraintError, match="store_id_references_stores broken by 1 rows"):
        site.run(site.products("products_1.json", tea("1")), site.prices("prices_1.csv", (1, "1", "s", 2)), 5)
    assert site.price_ids() == [] and site.names() == {}


def test_large_documents_must_be_lines(site, spark, monkeypatch):
    path = site.products("products_1.json", tea("1"))
    monkeypatch.setattr(files, "DOCUMENT_BYTES", 10)
    with pytest.raises(ValueError, match="one record per line"):
        files.read_products(spark, path)


def test_retraction_may_be_switched_off(site):
    site.run(site.products("products_1.json", tea("1")), site.prices("prices_1.csv", (1, "1", "s", 2)), 5)
    result = site.run(site.products("products_2.json", tea("1", "")),
                      site.prices("prices_2.csv", (2, "1", "s", 2)), 6, retract=False)
    assert result.reconciled and site.price_ids() == [1, 2] and site.names() == {"1": "Tea"}


def test_order_of_runs_is_their_publication(site):
    """Neither equal nor earlier times of the data change what is newer."""
    p1, p2 = (site.products(f"products_{k}.json", *rows) for k, rows in ((1, [tea("1"), tea("2")]), (2, [tea("1", ""), tea("2", "Second")])))
    site.run(p1, site.prices("prices_1.csv", (1, "1", "s", 2), (2, "2", "s", 2)), 9)
    site.run(p2, site.prices("prices_2.csv", (3, "2", "s", 2)), 9)
    assert site.price_ids() == [2, 3] and site.names() == {"2": "Second"}
    back = site.run(site.products("products_3.json", tea("1", "Back")), site.prices("prices_3.csv", (1, "1", "s", 4), (2, "2", "s", 2)), 2)
    assert back.already_loaded == 1
    assert site.price_ids() == [1, 2, 3] and site.names() == {"1": "Back", "2": "Second"}


def test_a_stale_base_is_refused(site, monkeypatch):
    p1, c1 = site.products("products_1.json", tea("1")), site.prices("prices_1.csv", (1, "1", "s", 2))
    layout = batch.price_layout

    def other_run_first(rows):
        monkeypatch.setattr(batch, "price_layout", layout)
        site.run(site.products("products_2.json", tea("2", "Other")), site.prices("prices_2.csv", (2, "2", "s", 3)), 5)
        return layout(rows)
    monkeypatch.setattr(batch, "price_layout", other_run_first)
    with pytest.raises(batch.StaleBase):
        site.run(p1, c1, 6)
    assert site.names() == {"2": "Other"} and site.price_ids() == [2]
    assert site.run(p1, c1, 6).reconciled and site.price_ids() == [1, 2]


def test_csv_columns_are_found_by_name_and_broken_records_kept(site, spark):
    path = site.dir / "prices_9.csv"
    head = "barcode,event_id,price,store_id,promotion,stock_status,event_timestamp,note\n"
    good = f"1,{uid(1)},2,s,False,in_stock,2025-01-01T00:00:00Z,x\n"
    short = f"1,{uid(2)},2,s\n"
    longer = f"1,{uid(3)},2,s,False,in_stock,2025-01-01T00:00:00Z,x,surplus\n"
    path.write_text(head + good + short + longer)
    result = site.run(site.products("products_1.json", tea("1")), str(path), 5)
    assert result.reconciled and result.rejected_records == 2 and site.price_ids() == [1]
    kept = {r["raw_record"] for r in batch.quarantine(spark, site.root).collect()}
    assert kept == {short.strip(), longer.strip()}
    path.write_text("barcode,price\n1,2\n")
    with pytest.raises(ValueError, match="event_id"):
        site.run(site.products("products_1.json", tea("1")), str(path), 6)


def test_latest_files_and_reviewer(site, spark):
    site.products("products_1.json", tea("9"))
    site.products("products_2.json", tea("1"), tea("2"))
    site.prices("prices_1.csv", (9, "9", "s", 1))
    site.prices("prices_2.csv", (1, "1", "s", 2), (2, "2", "s", 2))
    reviewer = spark.createDataFrame([("2", "reject", 0.95)], "barcode string, status string, confidence double")
    result = batch.run_latest(spark, site.root, str(site.dir), str(site.dir), site.stores,
                              reviewer=reviewer)
    assert (result.source_records, result.valid_records, result.rejected_records) == (4, 2, 2)
    assert site.price_ids() == [1] and site.names() == {"1": "Tea"}
    assert batch.silver_prices(spark, site.root, "2025-01-01", "2025-02-01").count() == 1
    assert batch.silver_prices(spark, site.root, "2025-02-01").count() == 0


def test_reading_before_the_first_run(site, spark):
    assert site.price_ids() == [] and site.names() == {}


def test_two_publications_at_once_get_one_number(spark, tmp_path):
    from threading import Barrier, Thread

    from shelfledger.plans import commits
    root, results = str(tmp_path), {}
    for base in range(50):
        gate = Barrier(2)

        def race(name):
            gate.wait()
            results[base, name] = commits.publish(spark, root, base, {"pipeline_run_id": name, "buckets": []})
        threads = [Thread(target=race, args=(name,)) for name in ("a", "b")]
        for t in threads:
            t.start()
        for t in threads:
            t.join()
    assert all({results[base, "a"], results[base, "b"]} == {base + 1, None} for base in range(50))
    won = {r["commit_seq"]: r["pipeline_run_id"] for r in commits.commits(spark, root).collect()}
    assert won == {base + 1: next(n for n in "ab" if results[base, n]) for base in range(50)}
    assert not [p for p in (tmp_path / "audit/commits").iterdir() if not p.name.endswith((".json", ".crc"))]


def test_an_upsert_leaves_other_buckets_in_place(site, spark):
    site.run(site.products("products_1.json", *[tea(str(k)) for k in range(1, 101)]), site.prices("prices_1.csv", (1, "1", "s", 2)), 5, buckets=8)
    before = set(batch.silver_products(spark, site.root).inputFiles())
    site.run(site.products("products_2.json", tea("7", "Changed")), site.prices("prices_2.csv", (2, "7", "s", 2)), 6)
    after = set(batch.silver_products(spark, site.root).inputFiles())
    held = lambda paths: {p.split("/bucket=")[1].split("/")[0] for p in paths}
    assert len(held(before - after)) == 1 == len(held(after - before)) and len(held(after)) == 8
    assert site.names() == {str(k): "Changed" if k == 7 else "Tea" for k in range(1, 101)}
    # a bucket may lose its last product
    site.run(site.products("products_3.json", *[tea(str(k), "") for k in range(1, 101) if k != 7]), site.prices("prices_3.csv", (3, "7", "s", 2)), 7)
    assert site.names() == {"7": "Changed"} and site.price_ids() == [2, 3]
    assert len(held(batch.silver_products(spark, site.root).inputFiles())) == 1


def test_what_runs_leave_behind(site, spark, monkeypatch):
    """A run that ends leaves no staging, one that fails no part; one that was killed is removed by a vacuum."""
    import os
    p1, c1 = site.products("products_1.json", tea("1")), site.prices("prices_1.csv", (1, "1", "s", 2))
    site.run(p1, c1, 5)
    assert os.listdir(f"{site.root}/staging") == []
    layout = batch.price_layout
    monkeypatch.setattr(batch, "price_layout", lambda rows: rows.selectExpr("nope"))
    with pytest.raises(Exception, match="nope"):
        site.run(p1, c1, 6)
    assert os.listdir(f"{site.root}/staging") == [] and len(os.listdir(f"{site.root}/bronze/prices")) == 1
    monkeypatch.setattr(batch, "remove", lambda *a: None)  # killed: nothing is put in order, no end is recorded
    monkeypatch.setattr(batch.audit, "run_event", lambda s, event=batch.audit.run_event, **f: event(s, **{**f, "status": "RUNNING"}))
    with pytest.raises(Exception, match="nope"):
        site.run(p1, c1, 7)
    monkeypatch.undo()
    assert len(os.listdir(f"{site.root}/bronze/prices")) == 2 and site.price_ids() == [1]
    assert batch.vacuum(spark, site.root, day(7)) == []
    assert len(batch.vacuum(spark, site.root, day(8))) == 1 and len(os.listdir(f"{site.root}/bronze/prices")) == 1
    assert os.listdir(f"{site.root}/staging") == [] and batch.price_layout is layout and site.price_ids() == [1]


def _groups_to_read(paths, column, value):
    """Row groups of Parquet files, and those whose statistics let them hold a value."""
    import pyarrow.parquet as pq
    total = held = 0
    for path in paths:
        meta = pq.ParquetFile(path.removeprefix("file:")).metadata
        at = next(k for k in range(meta.num_columns) if meta.row_group(0).column(k).path_in_schema == column) if meta.num_row_groups else 0
        for group in range(meta.num_row_groups):
            stats = meta.row_group(group).column(at).statistics
            total, held = total + 1, held + (stats.min <= value <= stats.max)
    return total, held


@pytest.mark.parametrize("by, value", [("barcode", "b0042"), ("store_id", "s042")])
def test_a_lookup_reads_few_row_groups(spark, tmp_path, by, value):
    """Either copy of the prices, by its own key: what statistics leave to read is under a tenth."""
    from pyspark.sql import functions as F
    n = F.col("id")
    rows = spark.range(40_000).select(
        F.format_string("e%06d", n).alias("event_id"), F.format_string("b%04d", F.pmod(n * 7919, F.lit(500))).alias("barcode"),
        F.format_string("s%03d", F.pmod(n * 104729, F.lit(90))).alias("store_id"), F.lit(1).cast("decimal(10,2)").alias("price"),
        F.timestamp_seconds(F.lit(1_736_000_000) + F.pmod(n * 31, F.lit(86_400 * 20))).alias("event_timestamp"))
    path = str(tmp_path / by)
    (batch.price_layout(rows, by).write.option("parquet.block.size", 16_384).option("parquet.page.size", 2048)
     .option("parquet.enable.dictionary", "false").partitionBy("event_month").parquet(path))
    written = spark.read.parquet(path)
    total, held = _groups_to_read(written.inputFiles(), by, value)
    assert total >= 40 and held < 0.1 * total
    found = written.filter(F.col(by) == value)
    assert found.count() == rows.filter(F.col(by) == value).count() > 0
    assert f"PushedFilters: [IsNotNull({by}), EqualTo({by},{value})]" in found._jdf.queryExecution().executedPlan().toString()


def test_a_store_is_looked_up_in_its_own_copy(site, spark):
    site.run(site.products("products_1.json", tea("1"), tea("2")), site.prices("prices_1.csv", (1, "1", "s", 2), (2, "2", "s", 3)), 5)
    site.run(site.products("products_2.json", tea("2", "")), site.prices("prices_2.csv", (3, "1", "s", 4)), 6)
    of_store = batch.prices_of(spark, site.root, store_id="s")
    assert sorted(int(r["event_id"][-4:]) for r in of_store.collect()) == [1, 3]  # a retraction counts in either copy
    assert all("prices_by_store" in f for f in of_store.inputFiles() if "/silver/prices" in f)
    assert [int(r["event_id"][-4:]) for r in batch.prices_of(spark, site.root, barcode="1", store_id="s").collect()] == [1, 3]


def test_verdict_report(site, spark, tmp_path):
    site.run(site.products("products_1.json", tea("1"), tea("2", "")), site.prices("prices_1.csv", (1, "1", "s", 2)), 5, report=str(tmp_path / "report"))
    told = {r["barcode"]: (r["status"], bool(r["reasons"]), r["validated_at"] is not None) for r in spark.read.json(str(tmp_path / "report")).collect()}
    assert told["1"][0] == "pass" and told["2"][:2] == ("reject", True) and all(t[2] for t in told.values())


def test_ids_are_dealt_by_their_bytes_in_the_order_of_their_texts(spark):
    rows = spark.range(200).selectExpr(
        "concat('abcdef01-0000-0000-0000-', lpad(hex(id * 7919 % 4096), 12, '0')) AS event_id", "'1' AS barcode", "'s' AS store_id",
        "cast(1 AS decimal(10,2)) AS price", "false AS promotion", "'x' AS stock_status",
        "timestamp'2025-01-01' AS event_timestamp", "timestamp'2025-01-01' AS loaded_at").withColumn("event_id", F.lower("event_id"))
    rows = rows.unionByName(rows.limit(1).withColumn("event_id", F.lit("no uuid")))
    dealt = batch.price_layout(rows)
    plan = dealt._jdf.queryExecution().optimizedPlan().toString()
    exchange = plan[plan.index("RepartitionByExpression"):].splitlines()[0]
    assert "event_uuid" in exchange and "event_month" not in exchange
    assert sorted(r["event_id"] for r in dealt.collect()) == sorted(r["event_id"] for r in rows.collect())
    assert dealt.columns == [*rows.columns, "event_month"]


def test_a_first_load_is_not_compared_with_an_empty_table(site, spark, monkeypatch):
    asked = []
    monkeypatch.setattr(batch.keyed, "insert_absent", lambda *a, f=batch.keyed.insert_absent, **b: asked.append(1) or f(*a, **b))
    products = site.products("products_1.json", tea("1"))
    site.run(products, site.prices("prices_1.csv", (1, "1", "s", 2)), 5)
    assert not asked and site.price_ids() == [1]
    assert site.run(products, site.prices("prices_2.csv", (1, "1", "s", 2), (2, "1", "s", 2)), 6).already_loaded == 1
    assert asked and site.price_ids() == [1, 2]


def test_places_become_numbers_in_the_same_order(spark):
    task = 1 << 33
    places = [("b.csv", 0, 0), ("b.csv", 0, 1), ("a.csv", 0, 2 * task), ("a.csv", 0, 2 * task + 7), ("a.csv", 128, task + 3),
              ("a.csv", 0, 5 * task), ("c.csv", 0, 2 * task + 8)]  # two files named a.csv, one task with two files
    rows = spark.createDataFrame([(p, "x") for p in places], "row_pos struct<file:string,block:long,row:long>, v string")
    both = batch.numbered(rows.withColumn("place", F.col("row_pos")))
    assert dict(both.dtypes)["row_pos"] == "bigint"
    assert [tuple(r["place"]) for r in both.orderBy("row_pos").collect()] == sorted(places)
    assert both.select("row_pos").distinct().count() == len(places)


@pytest.mark.parametrize("threshold", ["2k", "20k"])
def test_loads_whose_tables_are_too_large_to_broadcast(site, spark, threshold):
    """Two loads with more products, ids and retractions than may be broadcast give what is said of them."""
    teas = [tea(str(k)) for k in range(1, 400)]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)
    try:
        first = site.run(site.products("products_1.json", *teas), site.prices(
            "prices_1.csv", *[(k, str(k % 450), "s", 2) for k in range(1, 900)], *[(k, "7", "s", 3) for k in range(1, 100)]), 5)
        # 0 and 400 to 449 are no products; of ids given twice the first accepted row stays
        assert (first.valid_records, first.rejected_records, first.already_loaded) == (399 + 798, 101 + 99, 0) and first.reconciled
        second = site.run(site.products("products_2.json", *[tea(str(k), "") for k in range(1, 400, 2)]), site.prices(
            "prices_2.csv", *[(k, "2", "s", 2) for k in range(2, 300)], (2000, "1", "s", 1)), 6)
        # odd barcodes and their prices are gone, so their ids are new again
        assert second.already_loaded == 149 and second.valid_records == 149 and second.rejected_records == 201 and second.reconciled
        assert site.price_ids() == sorted([k for k in range(1, 900) if k % 450 % 2 == 0 and 0 < k % 450 < 400] + [*range(3, 300, 2)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    stored = batch.silver_prices(spark, site.root)
    other = batch.silver_prices(spark, site.root, copy="silver/prices_by_store")
    assert stored.exceptAll(other).isEmpty() and other.exceptAll(stored).isEmpty()


def test_a_report_is_compressed(site, tmp_path):
    import os
    site.run(site.products("products_1.json", tea("1")), site.prices("prices_1.csv", (1, "1", "s", 2)), 5, report=str(tmp_path / "report"))
    assert all(f.endswith(".json.gz") for f in os.listdir(tmp_path / "report") if f.startswith("part-"))


def test_shuffle_files_go_with_their_action(spark):
    from shelfledger.session import shuffles_removed
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    with pytest.raises(ValueError), shuffles_removed(spark):
        assert spark.conf.get(name) == "true" and spark.range(10).repartition(3).count() == 10
        raise ValueError
    assert spark.conf.get(name) == before
