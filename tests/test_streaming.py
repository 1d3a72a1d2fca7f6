import json

import pytest

from shelfledger.streaming import prices as stream

STORES = ("s1", "s2")


def event(n, minute=0, **changes):
    base = {"event_id": f"e{n}", "barcode": "1", "store_id": "s1", "price": 2.5, "currency": "EUR",
            "promotion": False, "stock_status": "in_stock",
            "event_time": f"2025-01-01T{minute // 60:02d}:{minute % 60:02d}:00.000Z"}
    return {k: v for k, v in {**base, **changes}.items() if v is not None}


class Feed:
    """Drops files into a folder one after the other and drains the stream."""

    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, root, 0
        (root / "in").mkdir()

    def land(self, *events):
        self.files += 1
        path = self.root / "in" / f"events_{self.files:03d}.json"
        path.write_text("\n".join(json.dumps(e) for e in events))
        import os
        os.utime(path, (1_700_000_000 + self.files,) * 2)

    def drain(self, **options):
        queries = stream.start_price_stream(
            self.spark, str(self.root / "in"), self.out, str(self.root / "checkpoint"), STORES,
            once=True, **options)
        stream.supervise(self.spark, queries, once=True)
        return stream.stream_audit(self.spark, self.out)

    @property
    def out(self):
        return str(self.root / "out")

    def balanced(self):
        """Each batch's own account, against what its rows say."""
        own = {r["batch_id"]: r.asDict() for r in stream.stream_audit(self.spark, self.out).collect()}
        rows = {r["batch_id"]: r.asDict() for r in stream.outcome_counts(self.spark, self.out).collect()}
        return own.keys() == rows.keys() and all(
            own[b]["input_rows"] == sum(own[b][k] for k in rows[b] if k != "batch_id")
            and rows[b].items() <= own[b].items() for b in own)

    def valid(self):
        return sorted(r["event_id"] for r in stream.price_events(self.spark, self.out).collect())

    def invalid(self):
        return sorted((r["event_id"] or "", r["validation_error"])
                      for r in stream.invalid_events(self.spark, self.out).collect())

    def latest(self):
        return {(r["barcode"], r["store_id"]): r["latest_price"]
                for r in stream.latest_prices(self.spark, self.out).collect()}


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


def test_first_failure_wins(spark):
    rows = [event(0), event(1, event_id=None, barcode=None), event(2, barcode=None),
            event(3, store_id="x", price=None), event(4, store_id=None), event(5, price=None),
            event(6, price=0.0), event(7, price=500.0), event(8, price=499.99), event(9, event_time=None)]
    df = spark.read.schema(stream.STREAM_EVENT).json(spark.sparkContext.parallelize([json.dumps(r) for r in rows], 1))
    checked = stream.first_failure(df, STORES)
    assert [r["validation_error"] for r in checked.collect()] == [
        None, "missing event_id", "missing barcode", "unknown store", "unknown store",
        "missing price", "invalid price", "invalid price", None, "missing event_time"]
    clean, invalid = stream.split(checked)
    assert clean.count() == 2 and invalid.count() == 8 and "validation_error" not in clean.columns
    assert stream.first_failure(df, STORES, inclusive=True).filter("validation_error is null").count() == 3


def test_duplicates_late_rows_and_restart(feed):
    feed.land(event(1, 0), event(2, 1, price=-1.0), event(1, 0), event(3, 2, store_id="s2", price=9.0))
    feed.land(event(4, 60, price=3.0), event(1, 60))
    feed.land(event(5, 90, price=4.0))
    feed.drain()
    assert feed.valid() == ["e1", "e3", "e4", "e5"]
    feed.land(event(6, 0, price=7.0), event(4, 91), event(7, 91, price=5.0))  # e6 is late
    progress = feed.drain()
    assert feed.valid() == ["e1", "e3", "e4", "e5", "e7"]
    assert feed.invalid() == [("e2", "invalid price")]
    assert feed.latest() == {("1", "s1"): 5.0, ("1", "s2"): 9.0}
    total = progress.selectExpr("sum(input_rows)", "sum(late_rows)", "sum(duplicate_rows)").first()
    assert tuple(total) == (10, 1, 3)
    assert sorted(r["event_id"] for r in stream.late_events(feed.spark, feed.out).collect()) == ["e6"]
    assert feed.balanced()


def test_events_without_id_or_time(feed):
    feed.land(event(1, event_id=None), event(2, event_time=None), event(3), event(1, event_id=None))
    feed.land(event(1, event_id=None))
    feed.drain()
    assert feed.valid() == ["e3"]
    assert feed.invalid() == [("", "missing event_id")] * 3 + [("e2", "missing event_time")]


def test_accounting_of_more_batches_than_spark_remembers(feed):
    feed.spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", 3)
    try:
        for i in range(6):
            feed.land(*[event(4 * i + k, i) for k in range(4)], event(0, i))
        total = feed.drain(fanout=3, buckets=2).selectExpr("count(*)", "sum(input_rows)", "sum(late_rows + duplicate_rows)").first()
    finally:
        feed.spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert tuple(total) == (6, 30, 6) and len(feed.valid()) == 24 and feed.balanced()


def test_bounded_state_forgets_old_ids(feed):
    feed.land(event(1, 0))
    feed.land(event(2, 60))
    feed.land(event(3, 120))
    feed.land(event(1, 180, price=8.0), event(3, 121))
    feed.drain(dedup="watermark")
    assert feed.valid() == ["e1", "e1", "e2", "e3"]


def test_levels_leave_the_latest_price_as_it_is(feed):
    for i in range(7):
        feed.land(event(i, i, price=float(i + 1)), event(100 + i, i, barcode=str(i)))
    feed.drain(fanout=2, buckets=3)
    want = {("1", "s1"): 7.0, **{(str(i), "s1"): 2.5 for i in range(7) if i != 1}}
    assert {(r["barcode"], r["store_id"]): r["latest_price"]
            for r in stream.latest_prices(feed.spark, feed.out, 2, 3).collect()} == want
    one = stream.latest_prices(feed.spark, feed.out, 2, 3, barcode="1", store_id="s1")
    assert [r["latest_price"] for r in one.collect()] == [7.0]
    folders = {path.split("/bucket=")[1].split("/")[0] for path in one.inputFiles()}
    assert one.filter("true").count() == 1 and folders  # pruning itself is read from the plan
    assert "PartitionFilters: [isnotnull(bucket" in one._jdf.queryExecution().executedPlan().toString()


def test_ties_in_time_go_to_the_greater_id(feed):
    feed.land(event(1, 5, price=1.0), event(2, 5, price=2.0))
    feed.drain()
    assert feed.latest() == {("1", "s1"): 2.0}


def test_a_repeated_batch_replaces_itself(feed):
    feed.land(event(1), event(2, price=-1.0), event(1))
    feed.drain()
    write = stream._batch_writer(feed.out, STORES)
    write(feed.spark.read.schema(stream.STREAM_EVENT).json(str(feed.root / "in")), 0)
    assert feed.valid() == ["e1"] and feed.invalid() == [("e2", "invalid price")]
    assert feed.latest() == {("1", "s1"): 2.5} and feed.balanced()


@pytest.mark.parametrize("lost", ["decided", "quarantine", "ids", "progress"])
def test_a_driver_that_dies_within_a_batch_loses_no_row(feed, monkeypatch, lost):
    """Whatever a batch had written when it died, the next start writes it again, and every row is accounted for."""
    feed.land(event(1, 0), event(2, 60, price=-1.0))
    feed.land(event(3, 60), event(1, 61), event(4, 0), event(3, 60))
    where = {"decided": (stream, "_decided"), "quarantine": (stream.IdLog, "append"), "ids": (stream, "latest_of"),
             "progress": (stream, "remove")}[lost]
    real, calls = getattr(*where), []

    def dies(*arguments):
        calls.append(arguments)
        if len(calls) == 2:
            raise RuntimeError("killed")
        return real(*arguments)
    monkeypatch.setattr(*where, dies)
    with pytest.raises(Exception):
        feed.drain()
    monkeypatch.undo()
    total = feed.drain().selectExpr("sum(input_rows)", "sum(valid_rows)", "sum(invalid_rows)", "sum(late_rows)", "sum(duplicate_rows)").first()
    assert tuple(total) == (6, 2, 1, 1, 2) and feed.balanced()
    assert feed.valid() == ["e1", "e3"] and feed.invalid() == [("e2", "invalid price")]
    assert [(r["event_id"], r["validation_error"]) for r in stream.late_events(feed.spark, feed.out).collect()] == [("e4", "late event")]


def test_every_id_is_remembered_without_state(feed):
    """Copies over many batches, levels and merges; the query itself holds no state, and ids that are null are not kept."""
    for i in range(7):
        feed.land(*[event(3 * i + k, i) for k in range(3)], event(i, i, price=9.0), event(0, i, event_id=None))
    queries = stream.start_price_stream(feed.spark, str(feed.root / "in"), feed.out, str(feed.root / "checkpoint"), STORES,
                                        once=True, fanout=2, buckets=2)
    stream.supervise(feed.spark, queries, once=True)
    assert not queries[0].lastProgress["stateOperators"]
    assert feed.valid() == sorted(f"e{i}" for i in range(21)) and len(feed.invalid()) == 7 and feed.balanced()
    log = stream.IdLog(feed.spark, f"{feed.out}/ids", fanout=2, buckets=2)
    assert log.log.rows(7).count() == 21 and len(log.log.live(7)) == 3
    asked = feed.spark.createDataFrame([(f"e{i}",) for i in range(0, 42, 3)], "event_id string")
    assert sorted(r["event_id"] for r in log.known(7, asked).collect()) == sorted(f"e{i}" for i in range(0, 21, 3))
    # the bits leave out most of what is not there
    other = feed.spark.createDataFrame([(f"x{i}",) for i in range(2000)], "event_id string")
    assert log.candidates(7, other).count() < 0.1 * 2000 * 3


def test_a_batch_writes_what_it_brings_and_not_the_table(spark, tmp_path):
    table = stream.latest_table(spark, str(tmp_path), 4, 2)
    row = lambda k, n: (f"b{k}", "s", float(n), None, f"e{n}")
    written, rows = [], 0
    for n in range(20):
        keys = range(400) if n == 0 else [n]  # one large batch, then small ones
        written.append(table.append(n, spark.createDataFrame([row(k, n) for k in keys], stream.LATEST)))
        rows += sum(spark.read.parquet(table.part(*p)).count() for p in written[-1])
    assert [len(w) for w in written] == [1, 1, 1, 2] * 3 + [1, 1, 1, 3] + [1, 1, 1, 2]
    assert table.live(20) == [(2, 0), (1, 16)] and table.live(21) == [(2, 0), (1, 16), (0, 20)] and table.live(0) == []
    assert table.read(20).count() == 400  # the 400 keys were written at their own batch and at two merges, never else
    assert rows <= 3 * (400 + 19)
    import os
    # merged at batch 15, removed four batches later; what batch 19 merged is still there
    assert not os.path.exists(table.part(1, 12)) and os.path.exists(table.part(0, 16)) and os.path.exists(table.part(1, 16))


def test_a_store_is_known_from_the_batch_after_it_was_added(feed, tmp_path):
    path = str(tmp_path / "stores")
    put = lambda *ids: feed.spark.createDataFrame([(i,) for i in ids], "store_id string").write.mode("overwrite").parquet(path)
    put("s1", "s1")
    feed.land(event(1), event(2, store_id="s9"), event(3, store_id=None))
    options = {"stores": lambda spark: spark.read.parquet(path)}

    def drain():
        stream.supervise(feed.spark, stream.start_price_stream(
            feed.spark, str(feed.root / "in"), feed.out, str(feed.root / "checkpoint"), once=True, **options), once=True)
    drain()
    put("s1", "s9")
    feed.land(event(4, 1, store_id="s9"))
    drain()
    assert feed.valid() == ["e1", "e4"] and feed.invalid() == [("e2", "unknown store"), ("e3", "unknown store")]


def test_copies_of_a_hot_id_are_counted_and_not_kept(feed, monkeypatch):
    monkeypatch.setattr(stream, "HOT_ROWS", 2)
    feed.land(*[event(1, 5)] * 300, *[event(1, 5 + k % 3, price=float(1 + k)) for k in range(50)], event(2, 5))
    total = feed.drain().select("input_rows", "valid_rows", "duplicate_rows").first()
    assert tuple(total) == (351, 2, 349) and feed.balanced()
    kept = stream.price_events(feed.spark, feed.out).filter("event_id = 'e1'").first()
    assert (kept["price"], kept["event_time"].minute) == (1.0, 5)  # earliest, then least in its other values


def test_unknown_mode(spark, feed):
    feed.land(event(1))
    with pytest.raises(ValueError):
        feed.drain(dedup="sometimes")


def test_continuous_run(spark, feed):
    feed.land(event(1), event(2, price=-1.0))
    query, = stream.start_price_stream(spark, str(feed.root / "in"), feed.out,
                                       str(feed.root / "checkpoint"), STORES, interval="1 second")
    try:
        query.processAllAvailable()
        feed.land(event(3))
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert feed.valid() == ["e1", "e3"] and feed.invalid() == [("e2", "invalid price")]


def test_quarantine_is_written_compressed(spark, tmp_path):
    lines = [{"event_id": "1", "barcode": "1", "store_id": "x", "price": 1.0, "currency": "EUR", "promotion": False,
              "stock_status": "in_stock", "event_time": "2025-01-01T00:00:00Z"}]
    source = tmp_path / "incoming"
    source.mkdir()
    (source / "a.json").write_text("\n".join(json.dumps(line) for line in lines))
    queries = stream.start_price_stream(spark, str(source), str(tmp_path / "out"), str(tmp_path / "checkpoint"), ["s"], once=True)
    stream.supervise(spark, queries, once=True)
    files = [p.name for p in (tmp_path / "out" / "quarantine").rglob("part-*")]
    assert files and all(name.endswith(".json.gz") for name in files)
    assert [r["validation_error"] for r in stream.invalid_events(spark, str(tmp_path / "out")).collect()] == ["unknown store"]
