"""Every query by name, over one folder of driver tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.functions.text import joined
from shelfledger.functions.times import date_window
from shelfledger.operators import audit, drift, keyed, prices, products, quality, ranking
from shelfledger.plans import batch, dashboard, figures, gold
from shelfledger.plans.warehouse import decide, known_products, known_stores, lake, loaded, loaded_runs, quarantine_of, warehouse
from shelfledger.schemas import VERDICTS
from shelfledger.session import configure, scratch_dir
from shelfledger.sources import mapping, tables
from shelfledger.streaming import prices as stream

Query = Callable[[SparkSession, str], DataFrame]
_queries: dict[str, Query] = {}
_RUN = "pipeline_run_id"


def plain(df: DataFrame) -> DataFrame:
    """Money as doubles and timestamps without zone, the types other engines compare with."""
    def cast(name: str, kind: str):
        if kind.startswith("decimal"):
            return F.col(name).cast("double").alias(name)
        if kind == "timestamp":
            return F.col(name).cast("timestamp_ntz").alias(name)
        return F.col(name)
    return df.select(*[cast(n, k) for n, k in df.dtypes])


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(fn(configure(spark), sf_dir))
    run.__doc__ = fn.__doc__
    _queries[fn.__name__] = run
    return fn


def queries() -> dict[str, Query]:
    return dict(_queries)


# -- gold ----------------------------------------------------------------------------------------

@query
def daily_price_summary(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return gold.daily_price_summary(w.prices, w.products)


def _events(spark, sf_dir):
    return stream.price_events(spark, f"{lake(spark, sf_dir)}/lake")


@query
def streamed_price_by_product(spark, sf_dir):
    return gold.streamed_price_by_product(_events(spark, sf_dir), known_products(spark, sf_dir))


@query
def streamed_events_by_store(spark, sf_dir):
    return gold.streamed_events_by_store(_events(spark, sf_dir), mapping.stream_stores(spark, sf_dir))


@query
def stream_versus_batch(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return gold.by_gap(gold.stream_versus_batch(_events(spark, sf_dir), w.prices, w.products))


@query
def reconcile_summary(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return gold.reconcile_summary(
        gold.stream_versus_batch(_events(spark, sf_dir), w.prices, w.products))


@query
def reconcile_widest(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return gold.reconcile_widest(
        gold.stream_versus_batch(_events(spark, sf_dir), w.prices, w.products))


@query
def reconcile_widest_abs(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return gold.reconcile_widest(
        gold.stream_versus_batch(_events(spark, sf_dir), w.prices, w.products), by="abs")


@query
def cross_tier_sql(spark, sf_dir):
    """Both tiers in one SQL text, through views."""
    tables.register_views(spark, {
        "lake.price_events": _events(spark, sf_dir), "silver.products": known_products(spark, sf_dir),
        "lake.latest_price": stream.latest_prices(spark, f"{lake(spark, sf_dir)}/lake")})
    return spark.sql("""
        WITH counted AS (
            SELECT barcode, count(*) AS event_count, max(price) AS highest_price
            FROM lake_price_events GROUP BY barcode),
        newest AS (
            SELECT barcode, min(latest_price) AS lowest_latest_price
            FROM lake_latest_price GROUP BY barcode)
        SELECT counted.barcode, product_name, category, event_count, highest_price,
               lowest_latest_price
        FROM counted JOIN newest USING (barcode) LEFT JOIN silver_products USING (barcode)""")


@query
def gold_row_counts(spark, sf_dir):
    """All models materialised, with the row counts seen while writing."""
    w = warehouse(spark, sf_dir)
    frames = gold.models(w.prices, w.products, mapping.stream_stores(spark, sf_dir),
                         _events(spark, sf_dir))
    root = scratch_dir(spark, "gold")
    counts = gold.build_gold(frames, lambda name, df: df.write.parquet(f"{root}/{name}"))
    return spark.createDataFrame(list(counts.items()), "model string, row_count long")


# -- dashboard -----------------------------------------------------------------------------------

@query
def latest_run_summary(spark, sf_dir):
    return dashboard.latest_run(warehouse(spark, sf_dir).runs)


@query
def latest_successful_run(spark, sf_dir):
    return dashboard.latest_run(warehouse(spark, sf_dir).runs, "SUCCESS")


@query
def run_outcomes(spark, sf_dir):
    return dashboard.run_outcomes(warehouse(spark, sf_dir).runs)


@query
def run_timeline(spark, sf_dir):
    return dashboard.run_outcomes(warehouse(spark, sf_dir).runs, finished_only=False)


def _quarantine_card(card):
    def run(spark, sf_dir):
        w = warehouse(spark, sf_dir)
        return card(w.quarantine, w.runs)
    run.__name__ = card.__name__
    return query(run)


def _price_card(card):
    def run(spark, sf_dir):
        return card(warehouse(spark, sf_dir).prices)
    run.__name__ = card.__name__
    return query(run)


def _product_card(card):
    def run(spark, sf_dir):
        w = warehouse(spark, sf_dir)
        return card(w.prices, w.products)
    run.__name__ = card.__name__
    return query(run)


for _card in (dashboard.top_rejection_reasons, dashboard.rejections_by_dataset):
    _quarantine_card(_card)
for _card in (dashboard.average_price, dashboard.promotion_share, dashboard.promotion_saving,
              dashboard.widest_spread, dashboard.promotion_vs_normal, dashboard.stock_status):
    _price_card(_card)
for _card in (dashboard.shopping_around, dashboard.cheapest_products,
              dashboard.most_expensive_products, dashboard.price_by_category,
              dashboard.price_by_brand):
    _product_card(_card)


@query
def price_by_store(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return dashboard.price_by_store(w.prices, w.stores)


@query
def price_distribution(spark, sf_dir):
    return ranking.fixed_bands(warehouse(spark, sf_dir).prices).drop("bucket")


@query
def price_histogram_auto(spark, sf_dir):
    return ranking.data_bands(warehouse(spark, sf_dir).prices)


@query
def missing_nutrition(spark, sf_dir):
    return dashboard.missing_nutrition(known_products(spark, sf_dir))


@query
def date_filtered_prices(spark, sf_dir):
    return (date_window(warehouse(spark, sf_dir).prices, "event_timestamp",
                        "1999-01-01T00:00:00Z", "2000-01-01T00:00:00Z")
            .select("event_id", "barcode", "store_id", "price", "event_timestamp"))


@query
def average_price_last_days(spark, sf_dir):
    recent = date_window(warehouse(spark, sf_dir).prices, "event_timestamp", last_days=400,
                         as_of="2001-06-15T10:00:00Z")
    return dashboard.average_price(recent)


# -- batch operators -----------------------------------------------------------------------------

@query
def clean_products(spark, sf_dir):
    return products.clean_products(mapping.raw_products(spark, sf_dir))


@query
def semantic_verdicts(spark, sf_dir):
    verdicts = products.semantic_verdicts(mapping.raw_products(spark, sf_dir), keep=["row_pos"])
    return verdicts.withColumn("reasons", joined(F.col("reasons")))


def _gated(spark, sf_dir, raw):
    return products.decide_products(raw, mapping.verdicts(spark, sf_dir))


@query
def gated_products(spark, sf_dir):
    decided = _gated(spark, sf_dir, mapping.raw_products(spark, sf_dir))
    return decided.select("row_pos", F.col("decided_barcode").alias("barcode"), "verdict.status",
                          "verdict.confidence", "verdict.validator", "accepted", "failure_reason")


def _effect(spark, sf_dir):
    later = mapping.second_extract(mapping.raw_products(spark, sf_dir))
    return products.product_effect(_gated(spark, sf_dir, later))


@query
def upsert_products(spark, sf_dir):
    base = mapping.earlier_products(products.clean_products(mapping.raw_products(spark, sf_dir)))
    return products.apply_products(base, _effect(spark, sf_dir), mapping.AS_OF)


@query
def retract_products(spark, sf_dir):
    rejected = products.rejected_barcodes(_effect(spark, sf_dir))
    left = keyed.retract(warehouse(spark, sf_dir).prices, rejected, "barcode", ["event_id"])
    return left.select("event_id", "barcode", "store_id", "price")


@query
def validate_prices(spark, sf_dir):
    _, decided = decide(spark, sf_dir)
    return decided.select(_RUN, *mapping.PRICE_COLUMNS, F.size("failures").alias("failure_count"),
                          "failure_reason", "accepted")


@query
def accepted_prices(spark, sf_dir):
    accepted = warehouse(spark, sf_dir).prices
    loaded_before = date_window(accepted, "event_timestamp", end="1998-01-01T00:00:00Z")
    return keyed.insert_absent(loaded_before, accepted, ["event_id"])


@query
def quarantine_rows(spark, sf_dir):
    return quarantine_of(*decide(spark, sf_dir))


@query
def run_reconciliation(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return audit.reconcile(w.decided_products, w.decided_prices, _RUN)


@query
def batch_run(spark, sf_dir):
    """The audit row of a whole load from landed files."""
    return batch.runs(spark, loaded(spark, sf_dir)).select(
        "status", "source_records", "valid_records", "rejected_records", "already_loaded")


@query
def batch_silver_prices(spark, sf_dir):
    return batch.silver_prices(spark, loaded(spark, sf_dir))


@query
def batch_silver_products(spark, sf_dir):
    return batch.silver_products(spark, loaded(spark, sf_dir))


@query
def batch_quarantine(spark, sf_dir):
    return batch.quarantine(spark, loaded(spark, sf_dir)).groupBy(
        "dataset_name", "failure_reason").agg(F.count(F.lit(1)).alias("rejected_records"))


@query
def verdict_report(spark, sf_dir):
    """The report of a load's verdicts, read back from its JSON."""
    schema = T.StructType([f for f in VERDICTS.fields if f.name != "pipeline_run_id"])
    rows = spark.read.schema(schema).json(f"{loaded(spark, sf_dir)}/report")
    return rows.groupBy("status", "validator").agg(
        F.count(F.lit(1)).alias("verdicts"), F.countDistinct("barcode").alias("barcodes"), F.min("confidence").alias("least_confidence"),
        F.count_if(F.size("reasons") > 0).alias("with_reasons"), F.count_if(F.col("validated_at").isNull()).alias("without_time"))


@query
def batch_runs_totals(spark, sf_dir):
    """Counts of three loads into one root, in the order of their publication."""
    return batch.runs(spark, loaded_runs(spark, sf_dir)).select(
        "commit_seq", "status", "source_records", "valid_records", "rejected_records", "already_loaded")


@query
def batch_runs_silver_prices(spark, sf_dir):
    """Prices after inserts, a retraction and a return of products, and a backfill."""
    return batch.silver_prices(spark, loaded_runs(spark, sf_dir))


@query
def batch_runs_silver_products(spark, sf_dir):
    return batch.silver_products(spark, loaded_runs(spark, sf_dir)).select("barcode", "product_name", "created_at")


@query
def batch_landed_prices(spark, sf_dir):
    """Rows landed per price file, each file by its newest run, and how many have a barcode."""
    return batch.bronze(spark, loaded_runs(spark, sf_dir), "prices").agg(
        F.count(F.lit(1)).alias("landed_rows"), F.count("barcode").alias("with_barcode"),
        F.countDistinct("run_id").alias("runs"))


@query
def batch_verdicts(spark, sf_dir):
    """Verdicts of three loads by status."""
    return batch.verdicts(spark, loaded_runs(spark, sf_dir)).groupBy("status").agg(
        F.count(F.lit(1)).alias("verdicts"), F.countDistinct("barcode").alias("barcodes"))


@query
def prices_of_barcode(spark, sf_dir):
    """One product's prices over some years, newest first; files and row groups of other barcodes are not read."""
    return batch.prices_of(spark, loaded(spark, sf_dir), barcode="5", start="1993-01-01", end="1998-01-01").select(
        "event_id", "barcode", "store_id", "price", "event_timestamp")


@query
def prices_of_store(spark, sf_dir):
    """One store's prices of a year, newest first; the months outside are not read."""
    return batch.prices_of(spark, loaded(spark, sf_dir), store_id="3", start="1995-01-01", end="1996-01-01").select(
        "event_id", "barcode", "store_id", "price", "event_timestamp")


# -- quality -------------------------------------------------------------------------------------

@query
def product_expectations(spark, sf_dir):
    raw = mapping.raw_products(spark, sf_dir).withColumnRenamed("code", "barcode")
    return quality.check(raw, quality.PRODUCT_SUITE, "products")


@query
def price_expectations(spark, sf_dir):
    return quality.check(mapping.raw_prices(spark, sf_dir), quality.PRICE_SUITE, "prices",
                         {"stores": (known_stores(spark, sf_dir), "store_id")}, ["row_pos"])


@query
def gold_not_null_tests(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return quality.check(gold.daily_price_summary(w.prices, w.products), quality.GOLD_SUITE,
                         "daily_price_summary")


@query
def constraint_violations(spark, sf_dir):
    """The tables' constraints over raw prices and over products and verdicts with seeded faults."""
    w = warehouse(spark, sf_dir)
    typed = prices.typed_prices(mapping.raw_prices(spark, sf_dir)).select(
        "row_pos", F.col("event_key").alias("event_id"), F.col("barcode_key").alias("barcode"),
        F.col("store_key").alias("store_id"), F.col("price_value").alias("price"),
        F.col("stock_value").alias("stock_status"), F.col("event_time").alias("event_timestamp"))
    found = quality.check(typed, quality.PRICE_CONSTRAINTS, "prices",
                          {"products": (w.products, "barcode"), "stores": (w.stores, "store_id")},
                          ["row_pos"])
    verdicts = products.verdict_rows(w.decided_products, F.col(_RUN), mapping.AS_OF)
    return (found.unionByName(quality.check(mapping.broken_products(w.products), quality.PRODUCT_CONSTRAINTS, "products"))
            .unionByName(quality.check(mapping.broken_verdicts(verdicts), quality.VERDICT_CONSTRAINTS, "verdicts")))


@query
def source_freshness(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return tables.freshness({"silver.prices": (w.prices, "loaded_at"),
                             "silver.products": (w.products, "updated_at"),
                             "audit.quarantine": (w.quarantine, "quarantined_at"),
                             "lake.price_events": (_events(spark, sf_dir), "event_time")},
                            mapping.AS_OF)


# -- streaming -----------------------------------------------------------------------------------

@query
def stream_valid(spark, sf_dir):
    return _events(spark, sf_dir)


@query
def stream_invalid(spark, sf_dir):
    return stream.invalid_events(spark, f"{lake(spark, sf_dir)}/lake")


@query
def stream_latest_price(spark, sf_dir):
    latest = stream.latest_prices(spark, f"{lake(spark, sf_dir)}/lake")
    return latest.select("barcode", "store_id", "latest_price", "latest_event_time")


@query
def stream_late(spark, sf_dir):
    """Events behind the watermark, kept apart with their reason."""
    return stream.late_events(spark, f"{lake(spark, sf_dir)}/lake")


@query
def stream_accounting(spark, sf_dir):
    """Rows that came in, as the batches took them down, against what the decided rows say became of them."""
    root = lake(spark, sf_dir)
    kinds = ("valid_rows", "invalid_rows", "late_rows", "duplicate_rows")
    came = stream.stream_audit(spark, f"{root}/lake").select("batch_id", "input_rows")
    went = stream.outcome_counts(spark, f"{root}/lake")
    return came.join(went, "batch_id", "full_outer").agg(
        *[F.sum(n).alias(n) for n in ("input_rows", *kinds)],
        F.bool_and(F.coalesce(F.col("input_rows") == sum(F.col(k) for k in kinds), F.lit(False))).alias("reconciled"))


# -- figures -------------------------------------------------------------------------------------

def _layers(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return figures.layer_counts({
        "bronze.raw_products": mapping.raw_products(spark, sf_dir),
        "bronze.raw_prices": mapping.raw_prices(spark, sf_dir),
        "silver.products": w.products, "silver.prices": w.prices, "silver.stores": w.stores,
        "audit.runs": w.runs, "audit.quarantine": w.quarantine})


@query
def layer_counts(spark, sf_dir):
    latest = stream.latest_prices(spark, f"{lake(spark, sf_dir)}/lake")
    return _layers(spark, sf_dir).unionByName(figures.layer_counts({
        "lake.price_events": _events(spark, sf_dir), "lake.latest_price": latest}))


def _figures(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    return figures.warehouse_figures(_layers(spark, sf_dir), dashboard.latest_run(w.runs, "SUCCESS"))


@query
def warehouse_figures(spark, sf_dir):
    return _figures(spark, sf_dir)


@query
def stream_figures(spark, sf_dir):
    w = warehouse(spark, sf_dir)
    events = _events(spark, sf_dir)
    versus = gold.stream_versus_batch(events, w.prices, w.products)
    return figures.stream_figures(
        events, stream.latest_prices(spark, f"{lake(spark, sf_dir)}/lake"),
        gold.streamed_price_by_product(events, w.products),
        gold.streamed_events_by_store(events, mapping.stream_stores(spark, sf_dir)),
        gold.reconcile_summary(versus))


@query
def figure_drift(spark, sf_dir):
    """Published figures with one value out of date, one not published and one gone."""
    recomputed = _figures(spark, sf_dir)
    value = F.when(F.col("metric") == "silver.prices", "0 rows").otherwise(F.col("value"))
    metric = F.when(F.col("metric") == "audit.runs", "retired.figure").otherwise(F.col("metric"))
    published = recomputed.select(metric.alias("metric"), value.alias("value"))
    return drift.drift(published, recomputed)
