"""Quarantine rows, run events and the reconciliation of their counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.functions.times import instant
from shelfledger.schemas import PIPELINE_RUNS

PIPELINE_NAME = "daily_price_pipeline"
ERROR_CHARS = 2000


def to_quarantine(decided: DataFrame, run_id: Column | str, dataset: str, raw_record: Column,
                  at) -> DataFrame:
    """The rejected rows of a decided batch in the audit layout."""
    run = run_id if isinstance(run_id, Column) else F.lit(run_id)
    return decided.filter(~F.col("accepted")).select(
        run.alias("pipeline_run_id"), F.lit(dataset).alias("dataset_name"), "failure_reason",
        raw_record.alias("raw_record"), instant(at).alias("quarantined_at"))


def counts(dataset: str) -> list[Column]:
    accepted = F.count_if(F.col("accepted"))
    return [F.lit(dataset).alias("dataset_name"), F.count(F.lit(1)).alias("source_records"),
            accepted.alias("valid_records"),
            F.count_if(~F.col("accepted")).alias("rejected_records")]


def reconcile(decided_products: DataFrame, decided_prices: DataFrame, run: str) -> DataFrame:
    """Source, valid and rejected counts per run and dataset; ``run`` names the run column."""
    def per_run(decided: DataFrame, dataset: str) -> DataFrame:
        label, *aggregates = counts(dataset)
        return (decided.groupBy(F.col(run).alias("pipeline_run_id")).agg(*aggregates)
                .select("pipeline_run_id", label,
                        "source_records", "valid_records", "rejected_records"))

    both = per_run(decided_products, "products").unionByName(per_run(decided_prices, "prices"))
    return both.withColumn("reconciled", F.col("source_records")
                           == F.col("valid_records") + F.col("rejected_records"))


def run_totals(per_dataset: DataFrame) -> DataFrame:
    return per_dataset.groupBy("pipeline_run_id").agg(
        *[F.sum(c).alias(c) for c in ("source_records", "valid_records", "rejected_records")])


def run_event(spark: SparkSession, **fields) -> DataFrame:
    """One row of the append-only run table; fields that are not given stay null."""
    if fields.get("error_message") is not None:
        fields["error_message"] = str(fields["error_message"])[:ERROR_CHARS]
    row = {"pipeline_name": PIPELINE_NAME, **fields}
    return spark.createDataFrame([tuple(row.get(n) for n in PIPELINE_RUNS.fieldNames())],
                                 PIPELINE_RUNS)


def current_runs(events: DataFrame) -> DataFrame:
    """Latest state of each run: a finished row supersedes the one that opened it."""
    rest = [c for c in PIPELINE_RUNS.fieldNames() if c != "pipeline_run_id"]
    return (events.groupBy("pipeline_run_id")
            .agg(F.max_by(F.struct(*rest), F.struct(F.col("completed_at").isNotNull(),
                                                    "completed_at")).alias("run"))
            .select("pipeline_run_id", "run.*"))
