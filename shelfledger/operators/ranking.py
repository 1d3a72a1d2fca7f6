"""Top-k, top-with-rest and histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.numbers import cents


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    """The first ``k`` rows; the order should be total, otherwise the cut is arbitrary."""
    return df.orderBy(*order).limit(k)


def top_with_other(rows: DataFrame, label: str, n: str, keep: int = 7) -> DataFrame:
    """Keep the ``keep`` largest labels, fold the rest into one ``Other`` row.

    Ties go by label. The head is a top-k and the rest is marked by a join with those ``keep``
    rows, so no window gathers all labels in one task.
    """
    head = top(rows, keep, F.col(n).desc(), F.col(label).asc()).select(
        label, F.lit(True).alias("_kept"))
    shown = F.when(F.col("_kept"), F.col(label)).otherwise(F.lit("Other"))
    return (rows.join(F.broadcast(head), label, "left")
            .groupBy(shown.alias(label)).agg(F.sum(n).alias(n)))


def fixed_bands(prices: DataFrame, low: int = 0, high: int = 25, bins: int = 10) -> DataFrame:
    """Histogram over fixed bounds: bucket, price_band, price_records.

    Buckets are found in whole cents, as numeric arithmetic would; 0 lies below and ``bins`` + 1
    at or above ``high``.
    """
    width = (high - low) * 100
    c = cents(F.col("price")) - low * 100
    inside = F.call_function("div", c * bins, F.lit(width)) + 1
    bucket = F.when(c < 0, 0).when(c >= width, bins + 1).otherwise(inside).cast("bigint")

    def edge(k: Column) -> Column:
        step = (high - low) / bins
        return (F.lit(low) + k * step).cast("decimal(6,1)").cast("string")

    return (prices.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("price_records"))
            .select("bucket", F.concat_ws(" - ", edge(F.col("bucket") - 1), edge(F.col("bucket")))
                    .alias("price_band"), "price_records"))


def data_bands(prices: DataFrame, bins: int = 10) -> DataFrame:
    """Histogram between the least and the greatest price: band, floor, price_records.

    The greatest price falls in band ``bins`` + 1; with equal bounds there is a single band.
    """
    values = prices.select(cents(F.col("price")).alias("c"))
    bounds = values.agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    inside = F.expr(f"(c - lo) * {bins} div nullif(hi - lo, 0)") + 1
    band = (F.when(F.col("hi") == F.col("lo"), 1).when(F.col("c") >= F.col("hi"), bins + 1)
            .otherwise(inside).cast("bigint"))
    counted = (values.crossJoin(F.broadcast(bounds))
               .groupBy(band.alias("band"), "lo", "hi")
               .agg(F.count(F.lit(1)).alias("price_records")))
    floor = (F.col("lo") + (F.col("band") - 1) * (F.col("hi") - F.col("lo")) / bins) / 100
    return counted.select("band", floor.alias("floor"), "price_records")
