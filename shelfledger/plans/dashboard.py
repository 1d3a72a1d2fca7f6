"""The dashboard's queries. Each takes frames, already cut to a date range where one applies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.numbers import WIDE, cents, mean_cents, money, percent
from shelfledger.functions.text import initcap, status_label, tag_label
from shelfledger.operators.ranking import top, top_with_other


def _n() -> Column:
    return F.count(F.lit(1))


def _total() -> Column:
    return F.sum(cents(F.col("price")))


def _mean(total: str = "total", n: str = "n") -> Column:
    return money(mean_cents(F.sum(total), F.sum(n)))


def _per(prices: DataFrame, *keys: str) -> DataFrame:
    """Additive price statistics by key, to be joined and folded further."""
    return prices.groupBy(*keys).agg(_total().alias("total"), _n().alias("n"),
                                     F.min("price").alias("low"), F.max("price").alias("high"))


# -- data quality --------------------------------------------------------------------------------

def latest_run(runs: DataFrame, status: str | None = None) -> DataFrame:
    if status is not None:
        runs = runs.filter(F.col("status") == status)
    return (top(runs, 1, F.col("started_at").desc_nulls_last(), F.col("pipeline_run_id"))
            .select("source_records", "valid_records", "rejected_records",
                    percent(F.col("rejected_records"), F.col("source_records"), 1)
                    .alias("rejected_pct")))


def run_outcomes(runs: DataFrame, finished_only: bool = True) -> DataFrame:
    if finished_only:
        runs = runs.filter(F.col("status") != "RUNNING")
    return (runs.select(F.col("started_at").alias("run_started"),
                        F.col("valid_records").alias("valid"),
                        F.col("rejected_records").alias("rejected"))
            .orderBy(F.col("run_started").asc_nulls_last()))


def _of_runs(quarantine: DataFrame, runs: DataFrame, *keys: str) -> DataFrame:
    """Quarantined rows by key, in runs that exist. Counted per run before the runs are joined."""
    counted = quarantine.groupBy("pipeline_run_id", *keys).agg(_n().alias("n"))
    return (counted.join(runs.select("pipeline_run_id"), "pipeline_run_id")
            .groupBy(*keys).agg(F.sum("n").alias("rejected_records")))


def top_rejection_reasons(quarantine: DataFrame, runs: DataFrame, keep: int = 7) -> DataFrame:
    reasons = _of_runs(quarantine, runs, "failure_reason")
    return (top_with_other(reasons, "failure_reason", "rejected_records", keep)
            .orderBy(F.col("rejected_records").desc(), "failure_reason"))


def rejections_by_dataset(quarantine: DataFrame, runs: DataFrame) -> DataFrame:
    return (_of_runs(quarantine, runs, "dataset_name")
            .select(initcap(F.col("dataset_name")).alias("dataset"), "rejected_records")
            .orderBy(F.col("rejected_records").desc(), "dataset"))


# -- pricing -------------------------------------------------------------------------------------

def average_price(prices: DataFrame) -> DataFrame:
    return prices.agg(money(mean_cents(_total(), _n())).alias("average_price"))


def promotion_share(prices: DataFrame) -> DataFrame:
    return prices.agg(percent(F.count_if("promotion"), _n(), 1).alias("promotion_share"))


def promotion_saving(prices: DataFrame) -> DataFrame:
    """How much lower the promoted average is, in percent of the normal one."""
    def part(condition: Column) -> tuple[Column, Column]:
        amount = F.sum(F.when(condition, cents(F.col("price"))))
        return amount.cast(WIDE), F.count_if(condition).cast(WIDE)

    normal, normal_n = part(~F.col("promotion"))
    promoted, promoted_n = part(F.col("promotion"))
    # (a/m - b/n) / (a/m) over one denominator, which keeps it exact
    whole = normal * F.nullif(promoted_n, F.lit(0).cast(WIDE))
    return prices.agg(percent(whole - promoted * normal_n, whole, 1).alias("promotion_saving"))


def widest_spread(prices: DataFrame) -> DataFrame:
    per_product = (_per(prices, "barcode", "store_id").groupBy("barcode")
                   .agg(F.count("store_id").alias("stores"),
                        (F.max("high") - F.min("low")).alias("spread")))
    return per_product.filter("stores > 1").agg(F.max("spread").alias("widest_spread"))


def price_by_store(prices: DataFrame, stores: DataFrame) -> DataFrame:
    return (_per(prices, "store_id").join(stores, "store_id")
            .groupBy("store_name", "city")
            .agg(_mean().alias("average_price"), F.min("low").alias("minimum_price"),
                 F.max("high").alias("maximum_price"), F.sum("n").alias("price_records"))
            .select(F.concat("store_name", F.lit(" ("), "city", F.lit(")")).alias("store"),
                    "average_price", "minimum_price", "maximum_price", "price_records")
            .orderBy(F.col("average_price").desc_nulls_last(), "store"))


def promotion_vs_normal(prices: DataFrame) -> DataFrame:
    return (prices.groupBy("promotion")
            .agg(money(mean_cents(_total(), _n())).alias("average_price"), _n().alias("price_records"))
            .orderBy("promotion")
            .select(F.when(F.col("promotion"), "Promotion").otherwise("Normal").alias("price_type"),
                    "average_price", "price_records"))


def shopping_around(prices: DataFrame, products: DataFrame, k: int = 15) -> DataFrame:
    """Products sold in more than one store, by the gap between cheapest and dearest."""
    named = (_per(prices, "barcode", "store_id")
             .join(products.select("barcode", "product_name"), "barcode"))
    # two barcodes may share a name: fold to one row per name and store before counting stores
    folded = (named.groupBy("product_name", "store_id")
              .agg(F.min("low").alias("low"), F.max("high").alias("high"))
              .groupBy("product_name")
              .agg(F.count("store_id").alias("stores"), F.min("low").alias("low"),
                   F.max("high").alias("high")).filter("stores > 1"))
    spread = F.col("high") - F.col("low")
    rows = folded.select(
        F.col("product_name").alias("product"), F.col("low").alias("cheapest_price"),
        F.col("high").alias("highest_price"), spread.alias("spread"),
        percent(cents(spread), cents(F.col("high")), 0).alias("saving_pct"))
    return top(rows, k, F.col("spread").desc_nulls_last(), F.col("product"))


def cheapest_products(prices: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    rows = (prices.groupBy("barcode").agg(F.min("price").alias("low"))
            .join(products.select("barcode", "product_name", "brand", "category"), "barcode")
            .groupBy("product_name", "brand", "category").agg(F.min("low").alias("cheapest_price"))
            .select(F.col("product_name").alias("product"), "brand",
                    tag_label(F.col("category")).alias("category"), "cheapest_price"))
    return top(rows, k, F.col("cheapest_price").asc_nulls_last(), F.col("product"), F.col("brand"),
               F.col("category"))


def most_expensive_products(prices: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    rows = (prices.groupBy("barcode").agg(F.max("price").alias("high"))
            .join(products.select("barcode", "product_name", "brand"), "barcode")
            .groupBy("product_name", "brand").agg(F.max("high").alias("highest_price"))
            .withColumnRenamed("product_name", "product"))
    return top(rows, k, F.col("highest_price").desc_nulls_last(), F.col("product"), F.col("brand"))


def stock_status(prices: DataFrame) -> DataFrame:
    return (prices.groupBy("stock_status")
            .agg(_n().alias("price_records"), money(mean_cents(_total(), _n())).alias("average_price"))
            .select(status_label(F.col("stock_status")).alias("stock_status"),
                    "price_records", "average_price")
            .orderBy(F.col("price_records").desc(), "stock_status"))


def price_by_category(prices: DataFrame, products: DataFrame) -> DataFrame:
    return (_per(prices, "barcode").join(products.select("barcode", "category"), "barcode")
            .groupBy("category")
            .agg(_mean().alias("average_price"), F.sum("n").alias("price_records"))
            .select(tag_label(F.col("category")).alias("category"), "average_price", "price_records")
            .orderBy(F.col("average_price").desc_nulls_last(), "category"))


def price_by_brand(prices: DataFrame, products: DataFrame, k: int = 15, at_least: int = 5) -> DataFrame:
    branded = products.filter(F.col("brand").isNotNull()).select("barcode", "brand")
    rows = (_per(prices, "barcode").join(branded, "barcode").groupBy("brand")
            .agg(_mean().alias("average_price"), F.sum("n").alias("price_records"))
            .filter(F.col("price_records") >= at_least))
    return top(rows, k, F.col("average_price").desc_nulls_last(), F.col("brand"))


def missing_nutrition(products: DataFrame) -> DataFrame:
    return (products.filter(F.col("energy_kcal_100g").isNull())
            .select("barcode", F.col("product_name").alias("product"), "brand",
                    tag_label(F.col("category")).alias("category"))
            .orderBy(F.col("product").asc_nulls_last(), "barcode"))
