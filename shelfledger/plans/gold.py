"""Gold models: the daily summary and the models that span the streamed and the batch tier.

Facts are aggregated by barcode or store before they meet a dimension: the join then sees one row
per key and no shuffle carries raw facts on a key that may be hot.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.numbers import (
    cents, mean_cents, mean_cents_of_micros, micros, money,
)
from shelfledger.operators.ranking import top


def daily_price_summary(prices: DataFrame, products: DataFrame) -> DataFrame:
    """Per day and barcode: reporting stores, average, lowest and highest price."""
    # one row per store first: the distinct count needs it, and it spreads a hot barcode
    per_store = (prices.groupBy(F.date_trunc("day", "event_timestamp").alias("price_date"),
                                "barcode", "store_id")
                 .agg(F.sum(cents(F.col("price"))).alias("total"), F.count(F.lit(1)).alias("n"),
                      F.min("price").alias("low"), F.max("price").alias("high")))
    per_day = (per_store.groupBy("price_date", "barcode")
               .agg(F.count("store_id").alias("stores_reporting"),
                    money(mean_cents(F.sum("total"), F.sum("n"))).alias("average_price"),
                    F.min("low").alias("minimum_price"), F.max("high").alias("maximum_price")))
    return (per_day.join(products.select("barcode", "product_name", "brand", "category"), "barcode")
            .select("price_date", "barcode", "product_name", "brand", "category",
                    "stores_reporting", "average_price", "minimum_price", "maximum_price"))


def _streamed(events: DataFrame, key: str) -> DataFrame:
    return events.groupBy(key).agg(
        F.count(F.lit(1)).alias("event_count"),
        mean_cents_of_micros(F.sum(micros(F.col("price"))), F.count("price")).alias("mean"),
        F.min("price").alias("low"), F.max("price").alias("high"))


def streamed_price_by_product(events: DataFrame, products: DataFrame) -> DataFrame:
    return (_streamed(events, "barcode")
            .join(products.select("barcode", "product_name", "brand"), "barcode", "left")
            .select("barcode", "product_name", "brand", "event_count",
                    money(F.col("mean")).alias("average_streamed_price"),
                    F.col("low").alias("lowest_streamed_price"),
                    F.col("high").alias("highest_streamed_price")))


def streamed_events_by_store(events: DataFrame, stores: DataFrame) -> DataFrame:
    return (_streamed(events, "store_id")
            .join(stores.select("store_id", "store_name", "city"), "store_id", "left")
            .select("store_id", "store_name", "city", "event_count",
                    money(F.col("mean")).alias("average_streamed_price")))


def stream_versus_batch(events: DataFrame, prices: DataFrame, products: DataFrame) -> DataFrame:
    """Products in both tiers, each side averaged and rounded before the difference is taken."""
    batch = prices.groupBy("barcode").agg(
        mean_cents(F.sum(cents(F.col("price"))), F.count(F.lit(1))).alias("batch"))
    stream = events.groupBy("barcode").agg(
        mean_cents_of_micros(F.sum(micros(F.col("price"))), F.count("price")).alias("stream"))
    return (stream.join(batch, "barcode")
            .join(products.select("barcode", "product_name"), "barcode", "left")
            .select("barcode", "product_name", money(F.col("stream")).alias("stream_price"),
                    money(F.col("batch")).alias("batch_price"),
                    money(F.col("stream") - F.col("batch")).alias("difference")))


def reconcile_summary(versus: DataFrame) -> DataFrame:
    """Agreement of the two tiers in one row.

    The exact median keeps one counter per distinct gap; gaps are whole cents below the price
    limit, so there are at most some tens of thousands however many products there are.
    """
    gap = F.abs(cents(F.col("difference")))
    mean = lambda c: money(mean_cents(F.sum(cents(F.col(c))), F.count(c)))
    return versus.agg(
        F.count(F.lit(1)).alias("both_routes"),
        F.count_if(gap <= 100).alias("within_one"),
        F.count_if(F.col("difference") < 0).alias("cheaper"),
        money(F.round(F.median(gap)).cast("bigint")).alias("median_gap"),
        mean("batch_price").alias("avg_batch"),
        mean("stream_price").alias("avg_stream"))


def reconcile_widest(versus: DataFrame, k: int = 5, by: str = "signed") -> DataFrame:
    """``signed`` takes the most negative differences, ``abs`` the widest gaps either way."""
    difference = F.col("difference")
    order = {"signed": difference.asc(), "abs": F.abs(difference).desc()}[by]
    return (top(versus, k, order, F.col("barcode"))
            .select("product_name", "stream_price", "batch_price", "difference"))


def by_gap(versus: DataFrame) -> DataFrame:
    """Display order of the comparison: widest gap first."""
    return versus.orderBy(F.abs("difference").desc(), "barcode")


def models(prices: DataFrame, products: DataFrame, stores: DataFrame,
           events: DataFrame) -> dict[str, DataFrame]:
    return {
        "daily_price_summary": daily_price_summary(prices, products),
        "streamed_price_by_product": streamed_price_by_product(events, products),
        "streamed_events_by_store": streamed_events_by_store(events, stores),
        "stream_versus_batch": stream_versus_batch(events, prices, products),
    }


def build_gold(frames: dict[str, DataFrame], writer: Callable[[str, DataFrame], None]) -> dict[str, int]:
    """Materialise each frame with ``writer`` and return the row counts seen while writing."""
    from pyspark.sql import Observation

    seen = {}
    for name, frame in frames.items():
        seen[name] = Observation(f"rows of {name}")
        writer(name, frame.observe(seen[name], F.count(F.lit(1)).alias("n")))
    return {name: observation.get["n"] for name, observation in seen.items()}
