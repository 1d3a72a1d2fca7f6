"""Landed files: product documents and price CSVs, each row with its place in the file."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfledger.functions.text import csv_null
from shelfledger.schemas import PRICE_COLUMNS, PRODUCT_COLUMNS, RAW_LINE, STREAM_EVENT


#: Largest product document that one task may read.
DOCUMENT_BYTES = 256 * 1024 * 1024


def latest_file(spark: SparkSession, directory: str, pattern: str) -> str:
    """Path of the file whose name sorts last; an error when none matches."""
    found = (spark.read.format("binaryFile").option("pathGlobFilter", pattern).load(directory)
             .agg(F.max("path").alias("path")).first()["path"])
    if found is None:
        raise FileNotFoundError(f"{directory} holds nothing named {pattern}")
    return found


def _position(inner: Column | None = None) -> Column:
    """Orders rows as they stand in their files, over all splits of a file."""
    fields = [F.col("_metadata.file_name").alias("file"),
              F.col("_metadata.file_block_start").alias("block"),
              F.monotonically_increasing_id().alias("row")]
    if inner is not None:
        fields.append(inner.alias("item"))
    return F.struct(*fields)


def read_prices(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    """Price rows as text, so that a bad price survives to validation.

    Columns are found by the header's names, in any order; a missing one is an error, and so is a file
    of the folder whose header differs from the first's. A record with too few or too many fields keeps
    its line in ``raw_line``, which is null for the others. ``multi_line`` allows line breaks inside quotes, at the
    price of one task per file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    names = reader.csv(path).columns
    missing = [c for c in PRICE_COLUMNS if c not in names]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, RAW_LINE]])
    rows = (reader.schema(schema).option("enforceSchema", False).option("mode", "PERMISSIVE")
            .option("columnPruning", False)  # else fields of columns that nobody reads are not counted
            .option("columnNameOfCorruptRecord", RAW_LINE).csv(path))
    return rows.select(F.col("_metadata.file_name").alias("source_file"),
                       _position().alias("row_pos"),
                       *[csv_null(F.col(c)).alias(c) for c in PRICE_COLUMNS], RAW_LINE)


def _text(payload: Column, path: str) -> Column:
    return F.try_variant_get(payload, path, "string")


def flatten_products(documents: DataFrame) -> DataFrame:
    """Product fields of a ``payload`` variant column, with the record kept as JSON text."""
    payload = F.col("payload")
    fields = {
        "code": _text(payload, "$.code"),
        "product_name": _text(payload, "$.product_name"),
        "brands": _text(payload, "$.brands"),
        "categories_tags": F.try_variant_get(payload, "$.categories_tags", "array<string>"),
        "ingredients_text": _text(payload, "$.ingredients_text"),
        "energy_kcal_100g": _text(payload, '$.nutriments["energy-kcal_100g"]'),
        "last_modified_t": _text(payload, "$.last_modified_t"),
    }
    others = [c for c in documents.columns if c != "payload"]
    return documents.select(*others, *[fields[c].alias(c) for c in PRODUCT_COLUMNS],
                            F.to_json(payload).alias("payload"))


def read_products(spark: SparkSession, path: str, lines: bool = False, required: bool = True) -> DataFrame:
    """Product records, flattened.

    A file is one document with a ``products`` list or, with ``lines``, one record per line; the
    latter splits over tasks and is the layout for large extracts: a document above DOCUMENT_BYTES is an error. ``required`` makes a document
    without the list an error, otherwise it counts as empty.
    """
    name = F.col("_metadata.file_name").alias("source_file")
    if lines:
        rows = spark.read.option("singleVariantColumn", "payload").json(path)
        documents = rows.select(name, _position(F.lit(0)).alias("row_pos"), "payload")
    else:
        largest = spark.read.format("binaryFile").load(path).agg(F.max("length").alias("n")).first()["n"]
        if (largest or 0) > DOCUMENT_BYTES:
            raise ValueError(f"a document of {largest} bytes is read by one task; write one record per line instead")
        body = spark.read.schema("products array<variant>").option("multiLine", True).json(path)
        products = F.col("products")
        if required:
            products = F.coalesce(products, F.raise_error(F.lit("document has no products list"))
                                  .cast("array<variant>"))
        documents = (body.select(name, _position().alias("at"), products.alias("products"))
                     .select("source_file", "at", F.posexplode("products").alias("item", "payload"))
                     .select("source_file",
                             F.struct("at.file", "at.block", "at.row", "item").alias("row_pos"),
                             "payload"))
    return flatten_products(documents)


def usable_products(raw: DataFrame) -> DataFrame:
    """Landed products that carry a code; an error when there is none."""
    kept = raw.filter(F.coalesce(F.trim("code"), F.lit("")) != "")
    if kept.isEmpty():
        raise RuntimeError("The source holds no usable products.")
    return kept


def stream_events(spark: SparkSession, directory: str, files_per_trigger: int = 1) -> DataFrame:
    """Stream of JSON-line price events with a declared schema."""
    return (spark.readStream.schema(STREAM_EVENT)
            .option("maxFilesPerTrigger", files_per_trigger).json(directory))
