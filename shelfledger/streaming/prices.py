"""Price events as a stream: find late rows and copies, validate, split, and keep the latest price.

Every micro-batch is written once under its batch id, in overwrite mode, each row with its outcome, and the smaller tables are
derived from what was written; a batch that is run again after a failure therefore replaces itself. What a batch
knows of the batches before it (the newest event time, the ids, the latest prices) lies in tables next to the output and not
in the query's state, so an id is remembered for good without a state store that grows. The last thing a batch
writes is its row of progress; input = valid + invalid + late + duplicate holds in it and can be counted again from the rows.

Layout below ``out``::

    decided/batch_id=N/outcome=valid|invalid|late|duplicate/   Parquet, every event; ``copies`` tells how many rows it stands for
    quarantine/batch_id=N/      JSON lines, compressed, the invalid and late events with their error
    ids/                        event ids by levels, with a table of bits for each part
    latest/                     latest price per key by levels
    progress/batch_id=N/        what came in, what became of it, and the newest event time so far
    staging/batch_id=N/         the batch as it came; removed when its progress is written
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.query import StreamingQuery

from shelfledger.operators.skew import join_counted, join_lookup
from shelfledger.schemas import JSON_TIME, STREAM_EVENT
from shelfledger.session import remove
from shelfledger.sources.files import stream_events
from shelfledger.streaming.levels import BUCKETS, FANOUT, IdLog, Levels

DELAY = "10 minutes"
LATE = "late event"
#: Rows of a batch with one event id from which on they are spread over the tasks.
HOT_ROWS = 100_000

_KEYS = ("barcode", "store_id")
_EVENT = STREAM_EVENT.fieldNames()
LATEST = T.StructType([
    STREAM_EVENT["barcode"], STREAM_EVENT["store_id"],
    T.StructField("latest_price", T.DoubleType()),
    T.StructField("latest_event_time", T.TimestampType()),
    T.StructField("latest_event_id", T.StringType()),
])
_DECIDED = T.StructType([*STREAM_EVENT.fields, T.StructField("validation_error", T.StringType()), T.StructField("copies", T.LongType())])
_COUNTS = ("input_rows", "valid_rows", "invalid_rows", "late_rows", "duplicate_rows")
PROGRESS = T.StructType([T.StructField("batch_id", T.LongType()), *[T.StructField(n, T.LongType()) for n in _COUNTS],
                         T.StructField("newest_event_time", T.TimestampType())])

#: The known stores: their ids, or a function that reads the store table anew for each batch.
Stores = Sequence[str] | Callable[[SparkSession], DataFrame]


def behind(watermark: Column) -> Column:
    """Whether an event is late: at or before the watermark. An event without time is not late, but invalid."""
    return F.coalesce(F.col("event_time") <= watermark, F.lit(False))


def resolve(events: DataFrame, watermark: Column, known: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The events with ``outcome`` (``late``, ``duplicate`` or null for those that go on) and ``copies``.

    ``known`` gives of distinct ids those that were seen before. Late events come first and make no id seen. Of
    several events under one id the first by time stays, and by its other values if times are equal. Equal rows are
    counted instead of being kept apart, and the choice is a minimum per id: both combine before the shuffle, and the rows
    of a hot id are spread in the join. Events without an id are no copies of each other.
    """
    nameless = events.filter("event_id IS NULL").select(
        *_EVENT, F.when(behind(watermark), "late").alias("outcome"), F.lit(1).cast("long").alias("copies"))
    rows = events.filter("event_id IS NOT NULL").groupBy(*_EVENT).agg(F.count(F.lit(1)).alias("copies")).withColumn("_late", behind(watermark))
    content = F.struct("event_time", *[c for c in _EVENT if c != "event_time"])
    ids = rows.filter(~F.col("_late")).groupBy("event_id").agg(F.min(content).alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = known(ids.select("event_id")).select("event_id").distinct().withColumn("_seen", F.lit(True))
    found = join_counted(rows, ids.join(before, "event_id", "left"), "event_id", "_n", _EVENT, HOT_ROWS)
    stays = ~F.col("_late") & F.col("_seen").isNull() & content.eqNullSafe(F.col("_first"))
    part = lambda outcome, n: F.struct(F.lit(outcome).alias("outcome"), n.cast("long").alias("copies"))
    none, n = F.lit(None).cast("string"), F.col("copies")
    parts = (F.when(F.col("_late"), F.array(part("late", n))).when(~stays, F.array(part("duplicate", n)))
             .when(n > 1, F.array(F.struct(none.alias("outcome"), F.lit(1).cast("long").alias("copies")), part("duplicate", n - 1)))
             .otherwise(F.array(F.struct(none.alias("outcome"), F.lit(1).cast("long").alias("copies")))))
    return found.select(*_EVENT, F.explode(parts).alias("_part")).select(*_EVENT, "_part.outcome", "_part.copies").unionByName(nameless)


def first_failure(events: DataFrame, stores: Sequence[str] | DataFrame, limit: float = 500,
                  inclusive: bool = False) -> DataFrame:
    """Adds ``validation_error``, the first rule that fails, null for a valid event.

    ``stores`` are ids, or a table with a row per ``store_id``. ``inclusive`` accepts a price of exactly ``limit``.
    """
    price = F.col("price")
    too_high = price > limit if inclusive else price >= limit
    columns = events.columns
    if isinstance(stores, DataFrame):
        table = stores.select("store_id").distinct().withColumn("_store", F.lit(True))
        events = join_lookup(events, table, "store_id", "left", ["event_id", "barcode"])
        known = F.col("_store").isNotNull()
    else:
        known = F.coalesce(F.col("store_id").isin(*stores), F.lit(False))
    return events.select(
        *columns,
        F.when(F.col("event_id").isNull(), "missing event_id")
         .when(F.col("barcode").isNull(), "missing barcode")
         .when(~known, "unknown store")
         .when(price.isNull(), "missing price")
         .when((price <= 0) | too_high, "invalid price")
         .when(F.col("event_time").isNull(), "missing event_time").alias("validation_error"))


def split(validated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid events without the helper column, and invalid ones with it."""
    failed = F.col("validation_error").isNotNull()
    return validated.filter(~failed).drop("validation_error"), validated.filter(failed)


def latest_of(events: DataFrame) -> DataFrame:
    """Latest price per barcode and store; the event id settles a tie in time."""
    newest = F.max(F.struct("event_time", "event_id", "price")).alias("newest")
    return events.groupBy(*_KEYS).agg(newest).select(
        *_KEYS, F.col("newest.price").alias("latest_price"),
        F.col("newest.event_time").alias("latest_event_time"),
        F.col("newest.event_id").alias("latest_event_id"))


def _merge_latest(rows: DataFrame) -> DataFrame:
    return latest_of(rows.select(*_KEYS, F.col("latest_event_time").alias("event_time"),
                                 F.col("latest_event_id").alias("event_id"),
                                 F.col("latest_price").alias("price")))


def _batches(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A table written per batch id; empty while nothing has been written."""
    full = T.StructType(schema.fields + [T.StructField("batch_id", T.LongType())])
    try:
        return spark.read.schema(full).option("basePath", path).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], full)


def _decided(spark: SparkSession, path: str) -> DataFrame:
    full = T.StructType([*_DECIDED.fields, T.StructField("batch_id", T.LongType()), T.StructField("outcome", T.StringType())])
    return spark.read.schema(full).parquet(path)


def price_events(spark: SparkSession, out: str) -> DataFrame:
    """The streamed price table: all valid events so far."""
    return (_decided(spark, f"{out}/decided").filter("outcome = 'valid'")
            .select(*STREAM_EVENT.fieldNames()))


def invalid_events(spark: SparkSession, out: str) -> DataFrame:
    """Events as quarantined, in JSON, without the late ones."""
    return _quarantined(spark, out).filter(F.col("validation_error") != LATE)


def late_events(spark: SparkSession, out: str) -> DataFrame:
    """Events as quarantined that came at or behind the watermark."""
    return _quarantined(spark, out).filter(F.col("validation_error") == LATE)


def _quarantined(spark: SparkSession, out: str) -> DataFrame:
    schema = T.StructType(STREAM_EVENT.fields + [T.StructField("validation_error", T.StringType())])
    return spark.read.schema(schema).json(f"{out}/quarantine").select(*schema.fieldNames())


def latest_table(spark: SparkSession, out: str, fanout: int = FANOUT, buckets: int = BUCKETS) -> Levels:
    """The table behind ``latest_prices``."""
    return Levels(spark, f"{out}/latest", LATEST, _KEYS, _merge_latest, fanout, buckets)


def latest_prices(spark: SparkSession, out: str, fanout: int = FANOUT, buckets: int = BUCKETS, **key) -> DataFrame:
    """Latest price per barcode and store after the last finished batch; with ``barcode`` and ``store_id`` of one of them,
    for which only the folders of its hash are read. ``fanout`` and ``buckets`` are those of the stream."""
    newest = _progress(spark, out).agg(F.max("batch_id")).first()[0]
    return latest_table(spark, out, fanout, buckets).read(0 if newest is None else newest + 1, **key)


def _progress(spark: SparkSession, out: str) -> DataFrame:
    return _batches(spark, f"{out}/progress", T.StructType(PROGRESS.fields[1:]))


def _newest_before(spark: SparkSession, out: str, batch_id: int):
    """The newest event time of the batches before this one, which the last of them has written."""
    if batch_id == 0:
        return None
    rows = spark.read.schema(T.StructType(PROGRESS.fields[1:])).parquet(f"{out}/progress/batch_id={batch_id - 1}")
    return rows.first()["newest_event_time"]


def _batch_writer(out: str, stores: Stores, dedup: str = "global", delay: str = DELAY, limit: float = 500,
                  fanout: int = FANOUT, buckets: int = BUCKETS):
    if dedup not in ("global", "watermark"):
        raise ValueError(f"unknown dedup mode {dedup}")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        seen, staged = Observation(), f"{out}/staging/batch_id={batch_id}"
        (batch.select(*_EVENT).observe(seen, F.count(F.lit(1)).alias("n"), F.max("event_time").alias("newest"))
         .write.mode("overwrite").parquet(staged))
        events = spark.read.schema(STREAM_EVENT).parquet(staged)
        newest = _newest_before(spark, out, batch_id)
        watermark = F.lit(newest).cast("timestamp") - F.expr(f"interval {delay}")
        # an id may come again once the watermark has passed it by the delay
        fresh = None if dedup == "global" else F.coalesce(F.col("event_time") + F.expr(f"interval {delay}") > watermark, F.lit(newest is None) | F.col("event_time").isNull())
        ids = IdLog(spark, f"{out}/ids", fresh, fanout=fanout, buckets=buckets)

        def known(asked: DataFrame) -> DataFrame:
            found = ids.known(batch_id, asked)
            return found if fresh is None else found.filter(fresh)
        resolved = resolve(events, watermark, known)
        # only what goes on is asked for its store
        table = stores(spark) if callable(stores) else stores
        checked = first_failure(resolved.filter("outcome IS NULL"), table, limit)
        aside = resolved.filter("outcome IS NOT NULL").withColumn("validation_error", F.when(F.col("outcome") == "late", LATE))
        verdict = F.coalesce("outcome", F.when(F.col("validation_error").isNull(), "valid").otherwise("invalid"))
        here = f"{out}/decided/batch_id={batch_id}"
        (checked.unionByName(aside).withColumn("outcome", verdict).write.mode("overwrite").partitionBy("outcome").parquet(here))
        written = _decided(spark, here)
        (written.filter("outcome IN ('invalid', 'late')").select("*", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select(*_EVENT, "validation_error")
         .write.mode("overwrite").option("timestampFormat", JSON_TIME).option("compression", "gzip").json(f"{out}/quarantine/batch_id={batch_id}"))
        ids.append(batch_id, written.filter("outcome IN ('valid', 'invalid') AND event_id IS NOT NULL"))
        latest_table(spark, out, fanout, buckets).append(batch_id, latest_of(written.filter("outcome = 'valid'")))
        counts = {r["outcome"]: r["n"] for r in written.groupBy("outcome").agg(F.sum("copies").alias("n")).collect()}
        times = [t for t in (newest, seen.get["newest"]) if t is not None]
        row = (seen.get["n"], *[counts.get(k, 0) for k in ("valid", "invalid", "late", "duplicate")], max(times, default=None))
        (spark.createDataFrame([row], T.StructType(PROGRESS.fields[1:])).coalesce(1)
         .write.mode("overwrite").parquet(f"{out}/progress/batch_id={batch_id}"))
        remove(spark, staged)
    return write


def start_price_stream(spark: SparkSession, source: str, out: str, checkpoint: str,
                       stores: Stores, once: bool = False, dedup: str = "global",
                       files_per_trigger: int = 1, delay: str = DELAY, limit: float = 500,
                       interval: str | None = None, fanout: int = FANOUT, buckets: int = BUCKETS) -> list[StreamingQuery]:
    """Start the stream; ``once`` drains what is there and stops, else it runs on.

    ``stores`` are ids, or a function of the session that gives the store table; it is called for every batch, so that a store
    is known from the first batch after it was added. ``dedup`` is ``global``, every id for good, or ``watermark``, which forgets
    an id once the watermark has passed it by the delay and lets a very late copy in again. ``interval`` spaces the
    micro-batches of a continuous run, for instance ``"30 seconds"``. ``fanout`` and ``buckets`` shape the tables of ids
    and latest prices and must stay as they are for one ``out``.
    """
    writer = (stream_events(spark, source, files_per_trigger).writeStream.outputMode("append")
              .option("checkpointLocation", checkpoint)
              .foreachBatch(_batch_writer(out, stores, dedup, delay, limit, fanout, buckets)))
    if once:
        writer = writer.trigger(availableNow=True)
    elif interval:
        writer = writer.trigger(processingTime=interval)
    return [writer.start()]


def supervise(spark: SparkSession, queries: Sequence[StreamingQuery], once: bool) -> None:
    """Wait for all queries of a drain, or for the first of a continuous run to end."""
    if once:
        for query in queries:
            query.awaitTermination()
    else:
        spark.streams.awaitAnyTermination()


def stream_audit(spark: SparkSession, out: str) -> DataFrame:
    """Per micro-batch, what came in and what became of it: valid, invalid, late and duplicate rows.

    A batch writes this row itself, last of all, so it is there for every batch that counts as done, over any number of
    restarts. The four are the input rows; ``outcome_counts`` counts them again.
    """
    return _progress(spark, out).select("batch_id", *_COUNTS)


def outcome_counts(spark: SparkSession, out: str) -> DataFrame:
    """Valid, invalid, late and duplicate rows per micro-batch, counted from the decided rows."""
    return _decided(spark, f"{out}/decided").groupBy("batch_id").agg(
        *[F.coalesce(F.sum(F.when(F.col("outcome") == k, F.col("copies"))), F.lit(0)).alias(f"{k}_rows")
          for k in ("valid", "invalid", "late", "duplicate")])
