"""Figures that are published elsewhere, recomputed as (metric, value) rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def layer_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every table: layer, row_count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
             for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def _rows(n: Column) -> Column:
    return F.concat(F.format_number(n, 0), F.lit(" rows"))


def _metrics(one_row: DataFrame, metrics: dict[str, Column]) -> DataFrame:
    values = F.array(*[F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value"))
                       for m, v in metrics.items()])
    return one_row.select(F.inline(values))


def warehouse_figures(counts: DataFrame, latest: DataFrame) -> DataFrame:
    """Figures of the batch tier.

    ``counts`` is ``layer_counts`` over bronze.raw_products, bronze.raw_prices, silver.products,
    silver.prices, silver.stores, audit.runs and audit.quarantine; ``latest`` one run summary.
    """
    names = ("bronze.raw_products", "bronze.raw_prices", "silver.products", "silver.prices",
             "silver.stores", "audit.runs", "audit.quarantine")
    n = {name: F.col(name.replace(".", "_")) for name in names}
    one = counts.agg(*[F.max(F.when(F.col("layer") == name, F.col("row_count")))
                       .alias(name.replace(".", "_")) for name in names])
    bronze = n["bronze.raw_products"] + n["bronze.raw_prices"]
    silver = n["silver.products"] + n["silver.prices"] + n["silver.stores"]
    fixed = _metrics(one, {
        **{name: _rows(n[name]) for name in names if name != "audit.runs"},
        "bronze.total": _rows(bronze),
        "silver.total": _rows(silver),
        "audit.runs": F.concat(n["audit.runs"].cast("string"), F.lit(" runs")),
        "runs.count": n["audit.runs"],
        "quarantine.total": n["audit.quarantine"],
        "silver.prices.count": F.format_number(n["silver.prices"], 0),
    })
    run = _metrics(latest, {
        "run.source": F.col("source_records"),
        "run.valid": F.col("valid_records"),
        "run.rejected": F.col("rejected_records"),
        "run.reject_pct": F.coalesce(F.col("rejected_pct").cast("string"), F.lit("0.0")),
    })
    return fixed.unionByName(run)


def stream_figures(events: DataFrame, latest: DataFrame, by_product: DataFrame,
                   by_store: DataFrame, summary: DataFrame) -> DataFrame:
    """Figures of the streamed tier and of the comparison between the tiers."""
    counted = layer_counts({"stream.events": events, "stream.latest_rows": latest,
                            "stream.products": by_product, "stream.stores": by_store})
    compared = _metrics(summary, {
        "stream.both_routes": F.col("both_routes"),
        "stream.within_dollar": F.col("within_one"),
        "stream.cheaper": F.col("cheaper"),
        "stream.median_gap": F.col("median_gap"),
        "stream.avg_batch": F.col("avg_batch"),
        "stream.avg_stream": F.col("avg_stream"),
    })
    return counted.select(F.col("layer").alias("metric"),
                          F.col("row_count").cast("string").alias("value")).unionByName(compared)
