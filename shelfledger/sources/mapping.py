"""The price domain read from TPC-H style tables.

``lineitem`` plays the price file, ``part`` the product documents, ``supplier`` the stores,
``events`` the stream and ``labels`` the reviewer. A fixed share of rows carries a fault.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfledger.functions.text import uuid_shape
from shelfledger.operators.skew import planner_bytes
from shelfledger.schemas import JSON_TIME, PRICE_COLUMNS, PRODUCT_COLUMNS, STREAM_EVENT

AS_OF = "2026-01-01T00:00:00Z"
STREAM_LIMIT = 200
FILE_BYTES = 128 * 1024 * 1024
FILES_PER_CORE = 8
#: Bytes of events for each file from which on every core writes one of a slice.
EVENT_BYTES = 2 * 1024 * 1024
#: Bytes of a table for each core below which its scan may have fewer tasks than there are cores.
SPREAD_BYTES = 32 * 1024 * 1024
STREAM_STORES = ("view", "click", "signup", "purchase")
PRICE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
               "l_extendedprice")


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame, key: str) -> DataFrame:
    """Give every core a share of a table that is too small to be split that far by itself."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if planner_bytes(df) < cores * SPREAD_BYTES else df


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier, nation, region = (load(spark, sf_dir, n) for n in ("supplier", "nation", "region"))
    return (supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
            .join(region, nation.n_regionkey == region.r_regionkey)
            .select(F.col("s_suppkey").cast("string").alias("store_id"),
                    F.col("s_name").alias("store_name"), F.col("n_name").alias("city"),
                    F.col("r_name").alias("region")))


def stream_stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stores plus one row per sales channel of the stream, ``view`` left unknown."""
    channels = load(spark, sf_dir, "events").select("event_type").distinct().filter(
        ~F.col("event_type").isin("error", "view"))
    return stores(spark, sf_dir).unionByName(channels.select(
        F.col("event_type").alias("store_id"),
        F.concat(F.lit("Channel "), "event_type").alias("store_name"),
        F.lit("Online").alias("city"), F.lit("Online").alias("region")))


def _run_id(year: Column, half: Column) -> Column:
    return F.concat(year.cast("string"), F.lit("-H"), half.cast("string"))


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = spread(load(spark, sf_dir, "part"), "p_partkey")
    key = F.col("p_partkey")
    code = key.cast("string")
    energy = F.when(key % 10 != 3, (F.col("p_size") * 10).cast("string"))
    rows = part.select(
        _run_id(F.lit(1995) + key % 7, F.lit(1)).alias("pipeline_run_id"),
        key.alias("row_pos"),
        code.alias("code"),
        F.when(key % 25 == 0, code).when(key % 25 == 1, "").when(key % 25 == 2, "123-45")
         .otherwise(F.col("p_name")).alias("product_name"),
        F.col("p_brand").alias("brands"),
        F.array(F.concat(F.lit("en:"), F.lower("p_type"))).alias("categories_tags"),
        F.concat(F.lit("  "), F.col("p_type"), F.lit("\t")).alias("ingredients_text"),
        energy.alias("energy_kcal_100g"),
        (F.lit(1700000000) + key).cast("string").alias("last_modified_t"))
    payload = F.to_json(F.struct(*PRODUCT_COLUMNS), {"ignoreNullFields": "false"})
    return rows.withColumn("payload", payload)


def raw_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _price_rows(spread(load(spark, sf_dir, "lineitem"), "l_orderkey"))


def _price_rows(lines: DataFrame) -> DataFrame:
    # cents are whole from the start, so that the text is the same wherever it is computed
    line = lines.withColumns({
        "fault": (F.col("l_orderkey") * 7 + F.col("l_partkey") * 3 + F.col("l_linenumber")) % 50,
        "cents": F.expr("(cast(round(l_extendedprice * 100) as bigint) + 2000) div 4000"),
        "digest": F.md5(F.concat_ws("-", "l_orderkey", "l_linenumber"))})
    fault, cents = F.col("fault"), F.col("cents")
    price = F.concat_ws(".", F.call_function("div", cents, F.lit(100)).cast("string"),
                        F.lpad((cents % 100).cast("string"), 2, "0"))
    shipped = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    event_id = uuid_shape(F.col("digest"))

    def faulty(normal: Column, bands: dict[int, str | None]) -> Column:
        col = normal
        for band, text in bands.items():
            col = F.when(fault == band, F.lit(text)).otherwise(col)
        return col

    fields = {
        "event_id": faulty(event_id, {7: None}),
        "barcode": faulty(F.col("l_partkey").cast("string"), {3: "unknown_barcode"}),
        "store_id": faulty(F.col("l_suppkey").cast("string"), {2: "unknown_store"}),
        "price": faulty(price, {0: "-1", 1: None, 4: "900"}),
        "promotion": F.when(F.col("l_discount") > 0.08, "True").otherwise("False"),
        "stock_status": F.when(F.col("l_linestatus") == "O", "in_stock").otherwise("low_stock"),
        "event_timestamp": faulty(shipped, {5: "bad", 6: "2999-01-01T00:00:00Z"}),
    }
    half = F.when(F.month("l_shipdate") <= 6, 1).otherwise(2)
    return line.select(_run_id(F.year("l_shipdate"), half).alias("pipeline_run_id"),
                       F.struct(*PRICE_ORDER).alias("row_pos"),
                       *[fields[c].alias(c) for c in PRICE_COLUMNS])


def run_started(run_id: Column) -> Column:
    """A half-year's run starts when the half-year is over."""
    year, half = F.substring(run_id, 1, 4).cast("int"), F.substring(run_id, 7, 1)
    return F.when(half == "1", F.make_date(year, F.lit(7), F.lit(1))).otherwise(
        F.make_date(year + 1, F.lit(1), F.lit(1))).cast("timestamp")


def runs(totals: DataFrame) -> DataFrame:
    """Run table over per-run counts; some runs failed, some are still open."""
    year = F.substring("pipeline_run_id", 1, 4).cast("int")
    half = F.substring("pipeline_run_id", 7, 1)
    status = (F.when((year % 4 == 1) & (half == "2"), "RUNNING")
              .when((year % 4 == 2) & (half == "1"), "FAILED").otherwise("SUCCESS"))
    return totals.select("pipeline_run_id", status.alias("status"), "source_records",
                         "valid_records", "rejected_records",
                         run_started(F.col("pipeline_run_id")).alias("started_at"))


_LANDED = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}


def _write_products(raw: DataFrame, path: str) -> None:
    nutriments = F.struct(F.col("energy_kcal_100g").alias("energy-kcal_100g"))
    document = F.struct(F.col("code"), F.col("product_name"), F.col("brands"),
                        F.col("categories_tags"), F.col("ingredients_text"),
                        nutriments.alias("nutriments"), F.col("last_modified_t"))
    raw.sort("row_pos").select(F.to_json(document).alias("value")).write.options(**_LANDED).text(path)


def _write_prices(lines: DataFrame, path: str) -> None:
    """Price rows of order lines in file order; the lines are sorted, which are narrower than the texts made of them."""
    rows = _price_rows(lines.sort(*PRICE_ORDER)).select(*PRICE_COLUMNS)
    rows.write.options(**_LANDED).option("header", True).csv(path)


def write_landed_files(spark: SparkSession, sf_dir: str, directory: str) -> tuple[str, str]:
    """Products as JSON lines and prices as CSV, in file order; returns the two paths."""
    product_path, price_path = f"{directory}/products.json", f"{directory}/prices.csv"
    _write_products(raw_products(spark, sf_dir), product_path)
    _write_prices(load(spark, sf_dir, "lineitem"), price_path)
    return product_path, price_path


#: Times of the data of three loads into one root: two of the same day, then a backfill of an earlier one.
LOAD_TIMES = (AS_OF, AS_OF, "2025-06-01T00:00:00Z")
#: The quarters of all orders (by ``l_orderkey % 4``) in each load's price file; they overlap.
LOAD_QUARTERS = ((0, 1), (1, 2), (2, 3, 0))


def write_load_files(spark: SparkSession, sf_dir: str, directory: str) -> list[tuple[str, str]]:
    """Product and price files of three loads.

    The second product file has the odd products, of which one in seven lost its name and is rejected; the
    third has these again, under a new name.
    """
    raw, key = raw_products(spark, sf_dir), F.col("row_pos")
    name = F.col("product_name")
    product_files = (raw, raw.filter(key % 2 == 1).withColumn("product_name", F.when(key % 14 == 3, "").otherwise(name)),
                     raw.filter(key % 14 == 3).withColumn("product_name", F.lit("Back again")))
    lines = load(spark, sf_dir, "lineitem")
    paths = []
    for k, (rows, quarters) in enumerate(zip(product_files, LOAD_QUARTERS)):
        paths.append((f"{directory}/products_{k}.json", f"{directory}/prices_{k}.csv"))
        _write_products(rows, paths[-1][0])
        _write_prices(lines.filter((F.col("l_orderkey") % 4).isin(*quarters)), paths[-1][1])
    return paths


def second_extract(raw: DataFrame) -> DataFrame:
    """A later product file that lists ten records of eleven, and then each of them once more.

    The second listing brings a new name, an empty one or no change in turn, so that a barcode may
    be accepted and then rejected, or the reverse.
    """
    key = F.col("row_pos")
    raw = raw.filter(key % 11 != 5)
    again = raw.withColumns({
        "row_pos": key + 1_000_000_000_000,
        "product_name": F.when(key % 3 == 0, F.concat(F.lit("Renamed "), "brands"))
                         .when(key % 3 == 1, "").otherwise(F.col("product_name"))})
    return raw.unionByName(again)


def earlier_products(clean: DataFrame) -> DataFrame:
    """The product table that the later file meets: the clean barcodes with older values."""
    old = F.lit("2020-01-01T00:00:00Z").cast("timestamp")
    return clean.select(
        "barcode", F.concat(F.lit("Old "), "brand").alias("product_name"), "brand",
        F.lit("unknown").alias("category"), F.lit(None).cast("string").alias("ingredients_text"),
        F.lit(None).cast("decimal(10,2)").alias("energy_kcal_100g"),
        F.lit(None).cast("timestamp").alias("source_modified_at"),
        old.alias("created_at"), old.alias("updated_at"))


def verdicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("barcode"),
        F.when(F.col("quality") == 0, "reject").otherwise("pass").alias("status"),
        F.when(F.col("toxic") == 1, 0.95).otherwise(0.80).alias("confidence"))


def broken_products(products: DataFrame) -> DataFrame:
    """A product table that breaks its constraints: repeated and missing barcodes, missing names."""
    key = F.col("barcode").cast("long") % 50
    repeated = products.filter(key == 7)
    return products.withColumns({
        "product_name": F.when(key != 9, F.col("product_name")),
        "barcode": F.when(key != 11, F.col("barcode"))}).unionByName(repeated)


def broken_verdicts(verdicts: DataFrame) -> DataFrame:
    """Verdicts that break their constraints: another status, a confidence above 1, no validator."""
    key = F.col("barcode").cast("long") % 40
    return verdicts.withColumns({
        "status": F.when(key == 3, "maybe").otherwise(F.col("status")),
        "confidence": F.when(key == 5, F.lit(1.2)).otherwise(F.col("confidence").cast("double")),
        "validator": F.when(key != 7, F.col("validator"))})


def stream_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "events").select(
        F.col("event_id").alias("_id"),
        F.when(F.col("event_id") % 100 != 37, F.col("event_id").cast("string")).alias("event_id"),
        F.col("user_id").cast("string").alias("barcode"),
        F.col("event_type").alias("store_id"),
        F.col("value").alias("price"),
        F.lit("EUR").alias("currency"),
        F.lit(False).alias("promotion"),
        F.lit("in_stock").alias("stock_status"),
        F.col("ts").cast("timestamp").alias("event_time"))


def write_event_files(spark: SparkSession, sf_dir: str, directory: str, slices: int = 4) -> int:
    """Write the events as JSON lines, a slice of ids at a time; returns the files per slice.

    Slices are complete one after the other, so a stream that takes one slice per trigger sees no late
    first copy. A last slice sends every twentieth event once more. What is sent doesn't depend on the number of slices, which
    grows where one would exceed some files per core; the id bounds prune the scan of each.
    """
    events = stream_source(spark, sf_dir)
    size = planner_bytes(events)
    cores = spark.sparkContext.defaultParallelism
    slices = max(slices, -(-size // (FILES_PER_CORE * cores * FILE_BYTES)))
    files = max(-(-size // (slices * FILE_BYTES)), min(cores, size // (slices * EVENT_BYTES)))
    low, high = events.agg(F.min("_id"), F.max("_id")).first()
    step = (high - low) // slices + 1
    parts = [events.filter(F.col("_id").between(low + i * step, low + (i + 1) * step - 1)) for i in range(slices)]
    for part in [*parts, events.filter("_id % 20 = 0")]:
        (part.select(*STREAM_EVENT.fieldNames()).repartition(files).write.mode("append")
         .option("timestampFormat", JSON_TIME).json(directory))
    return files
