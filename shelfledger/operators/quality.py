"""Declarative rules over a frame, all but uniqueness in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfledger.functions.numbers import safe_double
from shelfledger.functions.text import UUID_SHAPE, stripped, uuid_bytes, uuid_text
from shelfledger.operators.skew import join_lookup, may_broadcast


@dataclass(frozen=True)
class Rule:
    """``kind`` is not_null, unique, between, in_set, in_table or matches.

    Nulls break not_null only. ``text`` marks a number held as text: unreadable counts as broken.
    """

    name: str
    column: str
    kind: str
    low: float | None = None
    high: float | None = None
    strict: bool = False
    text: bool = False
    values: tuple = ()
    table: str = ""
    pattern: str = ""

    def broken(self) -> Column:
        col = F.col(self.column)
        if self.kind == "not_null":
            return col.isNull()
        if self.kind == "between":
            number = safe_double(stripped(col)) if self.text else col
            low = F.lit(False) if self.low is None else (
                number <= self.low if self.strict else number < self.low)
            high = F.lit(False) if self.high is None else (
                number >= self.high if self.strict else number > self.high)
            return col.isNotNull() & (number.isNull() | low | high)
        if self.kind == "in_set":
            return col.isNotNull() & ~col.isin(*self.values)
        if self.kind == "in_table":
            return col.isNotNull() & F.col(f"_known_{self.name}").isNull()
        if self.kind == "matches":
            return col.isNotNull() & ~col.rlike(self.pattern)
        raise ValueError(f"unknown rule kind {self.kind}")


PRICE_SUITE = (
    Rule("event_id_not_null", "event_id", "not_null"),
    Rule("event_id_unique", "event_id", "unique"),
    Rule("price_in_range", "price", "between", 0, 500, strict=True, text=True),
    Rule("price_positive", "price", "between", low=0, strict=True, text=True),
    Rule("price_below_limit", "price", "between", high=500, strict=True, text=True),
    Rule("store_id_known", "store_id", "in_table", table="stores"),
    Rule("event_timestamp_not_null", "event_timestamp", "not_null"),
)

PRODUCT_SUITE = (
    Rule("barcode_not_null", "barcode", "not_null"),
    Rule("product_name_not_null", "product_name", "not_null"),
    Rule("energy_kcal_100g_in_range", "energy_kcal_100g", "between", 0, 1000, text=True),
)

GOLD_SUITE = tuple(Rule(f"{c}_not_null", c, "not_null")
                   for c in ("price_date", "barcode", "product_name", "minimum_price"))

PRICE_CONSTRAINTS = (
    Rule("event_id_primary_key", "event_id", "unique"),
    Rule("event_id_not_null", "event_id", "not_null"),
    Rule("event_id_uuid", "event_id", "matches", pattern=UUID_SHAPE),
    Rule("barcode_not_null", "barcode", "not_null"),
    Rule("barcode_references_products", "barcode", "in_table", table="products"),
    Rule("store_id_not_null", "store_id", "not_null"),
    Rule("store_id_references_stores", "store_id", "in_table", table="stores"),
    Rule("price_not_null", "price", "not_null"),
    Rule("price_positive", "price", "between", low=0, strict=True),
    Rule("stock_status_not_null", "stock_status", "not_null"),
    Rule("event_timestamp_not_null", "event_timestamp", "not_null"),
)

PRODUCT_CONSTRAINTS = (
    Rule("barcode_primary_key", "barcode", "unique"),
    Rule("barcode_not_null", "barcode", "not_null"),
    Rule("product_name_not_null", "product_name", "not_null"),
)

VERDICT_CONSTRAINTS = (
    Rule("status_enum", "status", "in_set", values=("pass", "reject")),
    Rule("confidence_range", "confidence", "between", 0, 1),
    Rule("validator_not_null", "validator", "not_null"),
)


def check(df: DataFrame, suite: Sequence[Rule], dataset: str,
          tables: dict[str, tuple[DataFrame, str]] | None = None,
          spread: Sequence[str] | None = None) -> DataFrame:
    """One row per rule: dataset, expectation, success, unexpected_count, element_count.

    ``tables`` gives the frame and key behind each in_table rule; ``spread`` names columns that
    identify a row of ``df`` and is needed for those rules only. Where such a table is too large to broadcast, the values of
    ``df`` are counted before they meet it, so that no row is shuffled. Ids of ``event_id`` may come as bytes in ``event_uuid``.
    """
    tables = tables or {}
    row_rules = [r for r in suite if r.kind != "unique"]
    marked = df
    if "event_uuid" in df.columns:
        marked = df.withColumn("event_id", F.coalesce(uuid_text(F.col("event_uuid")), "event_id")).drop("event_uuid")
    results = []
    for rule in [r for r in row_rules if r.kind == "in_table"]:
        frame, key = tables[rule.table]
        keys = frame.select(F.col(key).alias(rule.column)).distinct().withColumn(f"_known_{rule.name}", F.lit(True))
        if may_broadcast(keys):
            marked = join_lookup(marked, keys, rule.column, "left", spread)
        else:
            row_rules.remove(rule)
            values = df.groupBy(rule.column).agg(F.count(F.lit(1)).alias("n")).join(keys, rule.column, "left")
            results.append(values.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("element_count"), F.lit(rule.name).alias("expectation"),
                F.coalesce(F.sum(F.when(rule.broken(), F.col("n"))), F.lit(0)).alias("unexpected_count")))
    if row_rules:
        totals = marked.agg(F.count(F.lit(1)).alias("element_count"),
                            *[F.count_if(r.broken()).alias(r.name) for r in row_rules])
        pairs = ", ".join(f"'{r.name}', `{r.name}`" for r in row_rules)
        results.append(totals.selectExpr(
            "element_count", f"stack({len(row_rules)}, {pairs}) AS (expectation, unexpected_count)"))
    for rule in suite:
        if rule.kind == "unique":
            # ids travel as their bytes
            packed = rule.column == "event_id" and "event_uuid" in df.columns
            uuid = F.col("event_uuid") if packed else uuid_bytes(F.col(rule.column).cast("string"))
            copies = df.groupBy(uuid.alias("uuid"), F.when(uuid.isNull(), F.col(rule.column)).alias("other")).agg(F.count(F.lit(1)).alias("n"))
            repeated = (F.col("uuid").isNotNull() | F.col("other").isNotNull()) & (F.col("n") > 1)
            results.append(copies.agg(
                F.coalesce(F.sum("n"), F.lit(0)).alias("element_count"),
                F.lit(rule.name).alias("expectation"),
                F.coalesce(F.sum(F.when(repeated, F.col("n"))), F.lit(0)).alias("unexpected_count")))
    every = reduce(DataFrame.unionByName, results)
    return every.select(F.lit(dataset).alias("dataset"), "expectation",
                        (F.col("unexpected_count") == 0).alias("success"),
                        "unexpected_count", "element_count")
