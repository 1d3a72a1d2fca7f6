"""Silver and audit tables, and the streamed tier, derived from one set of driver tables.

Validation is the expensive step and every report reads its result, so the decided rows are
written once per application to shared storage and all reports scan that, as they would scan the
silver tables of a running platform.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from threading import RLock

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.operators import audit, prices, products
from shelfledger.plans import batch
from shelfledger.session import DENSE, configure, scratch_dir, shuffles_removed, stage
from shelfledger.sources import mapping
from shelfledger.streaming import prices as stream


@dataclass(frozen=True)
class Warehouse:
    decided_products: DataFrame
    decided_prices: DataFrame
    products: DataFrame
    stores: DataFrame
    prices: DataFrame
    quarantine: DataFrame
    runs: DataFrame


_RUN = "pipeline_run_id"
_building = RLock()
_built: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, kind: str, build):
    key = (spark.sparkContext.applicationId, sf_dir, kind)
    with _building:
        if key not in _built:
            _built[key] = build()
        return _built[key]


def known_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "stores", lambda: stage(mapping.stores(spark, sf_dir), "stores"))


def decide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Decided products, written once, and decided prices as one lazy plan over them.

    Left lazy, the products' filter would repeat their whole cleaning at every use.
    """
    decided_products, packed = _packed(spark, sf_dir)
    return decided_products, prices.unpack(packed)


def _packed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    return _once(spark, sf_dir, "packed", lambda: _decide(spark, sf_dir))


def _decided_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _once(spark, sf_dir, "products", lambda: stage(
        products.decide_products(mapping.raw_products(spark, sf_dir)), "products"))


def known_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The product table alone; no price row is read for it."""
    at = mapping.run_started(F.col(_RUN))
    return _decided_products(spark, sf_dir).filter("accepted").select(
        "product.*", at.alias("created_at"), at.alias("updated_at"))


def _decide(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    decided_products = _decided_products(spark, sf_dir)
    silver = decided_products.filter("accepted").select("product.*")

    def once(df: DataFrame, name: str) -> DataFrame:
        return _once(spark, sf_dir, name, lambda: stage(df, name, codec=DENSE))

    packed = prices.decide_packed(mapping.raw_prices(spark, sf_dir), silver,
                                  known_stores(spark, sf_dir), mapping.AS_OF,
                                  stage=lambda df: once(df, "checked"), stage_ids=once)
    return decided_products, packed


def quarantine_of(decided_products: DataFrame, decided_prices: DataFrame) -> DataFrame:
    run = F.col(_RUN)
    at = mapping.run_started(run)
    return audit.to_quarantine(decided_products, run, "products", F.col("payload"), at).unionByName(
        audit.to_quarantine(decided_prices, run, "prices", prices.raw_price_json(), at))


def _build(spark: SparkSession, sf_dir: str) -> Warehouse:
    decided_products, packed = _packed(spark, sf_dir)
    # no report asks for the place in the file
    decided_prices = prices.unpack(stage(packed.drop("row_pos"), "prices", partition_by="accepted", codec=DENSE))
    at = mapping.run_started(F.col(_RUN))
    totals = audit.run_totals(audit.reconcile(decided_products, decided_prices, _RUN))
    return Warehouse(
        decided_products, decided_prices, known_products(spark, sf_dir), known_stores(spark, sf_dir),
        prices.accepted_prices(decided_prices, at),
        quarantine_of(decided_products, decided_prices),
        stage(mapping.runs(totals), "runs"))


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    return _once(spark, sf_dir, "warehouse", lambda: _build(spark, sf_dir))


def _drain(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "lake")
    files = mapping.write_event_files(spark, sf_dir, f"{root}/incoming")
    # the number of state partitions is fixed for the life of a stream: no more than there are cores, and
    # in a session of its own, so that the caller's settings stay as they are
    own = configure(spark.newSession())
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    own.conf.set("spark.sql.shuffle.partitions", min(int(partitions), spark.sparkContext.defaultParallelism))
    queries = stream.start_price_stream(
        own, f"{root}/incoming", f"{root}/lake", f"{root}/checkpoint", mapping.STREAM_STORES,
        once=True, files_per_trigger=files, limit=mapping.STREAM_LIMIT)
    stream.supervise(own, queries, once=True)
    return root


def _load(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "batch")
    product_path, price_path = mapping.write_landed_files(spark, sf_dir, f"{root}/landed")
    batch.run_batch(spark, f"{root}/tables", product_path, price_path,
                    known_stores(spark, sf_dir), product_lines=True,
                    as_of=datetime.fromisoformat(mapping.AS_OF), report=f"{root}/tables/report")
    return f"{root}/tables"


def loaded(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the tables that one audited run made of landed files."""
    with shuffles_removed(spark):
        return _once(spark, sf_dir, "batch", lambda: _load(spark, sf_dir))


def _load_runs(spark: SparkSession, sf_dir: str) -> str:
    root = scratch_dir(spark, "loads")
    for (product_path, price_path), at in zip(mapping.write_load_files(spark, sf_dir, f"{root}/landed"), mapping.LOAD_TIMES):
        batch.run_batch(spark, f"{root}/tables", product_path, price_path, known_stores(spark, sf_dir),
                        product_lines=True, as_of=datetime.fromisoformat(at))
    return f"{root}/tables"


def loaded_runs(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the tables that three audited runs made, one after the other."""
    with shuffles_removed(spark):
        return _once(spark, sf_dir, "loads", lambda: _load_runs(spark, sf_dir))


def lake(spark: SparkSession, sf_dir: str) -> str:
    """Folder of the drained stream; ``lake`` holds its tables and its audit."""
    return _once(spark, sf_dir, "lake", lambda: _drain(spark, sf_dir))
