"""Entity contracts."""

from __future__ import annotations

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
JSON_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"  # the default layout of JSON files cuts off microseconds


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


_TEXT, _TIME, _FLAG, _LONG = T.StringType(), T.TimestampType(), T.BooleanType(), T.LongType()

# Column order of the landed price file; typing happens in the cleaning step.
PRICE_RAW = _struct(
    ("event_id", _TEXT),
    ("barcode", _TEXT),
    ("store_id", _TEXT),
    ("price", _TEXT),
    ("promotion", _TEXT),
    ("stock_status", _TEXT),
    ("event_timestamp", _TEXT),
)
PRICE_COLUMNS = PRICE_RAW.fieldNames()

PRODUCT_RAW = _struct(
    ("code", _TEXT),
    ("product_name", _TEXT),
    ("brands", _TEXT),
    ("categories_tags", T.ArrayType(_TEXT)),
    ("ingredients_text", _TEXT),
    ("energy_kcal_100g", _TEXT),
    ("last_modified_t", _TEXT),
)
PRODUCT_COLUMNS = PRODUCT_RAW.fieldNames()

#: The line of a price record whose fields don't fit the header.
RAW_LINE = "raw_line"

PRODUCTS = _struct(
    ("barcode", _TEXT),
    ("product_name", _TEXT),
    ("brand", _TEXT),
    ("category", _TEXT),
    ("ingredients_text", _TEXT),
    ("energy_kcal_100g", MONEY),
    ("source_modified_at", _TIME),
    ("created_at", _TIME),
    ("updated_at", _TIME),
)

STORES = _struct(("store_id", _TEXT), ("store_name", _TEXT), ("city", _TEXT), ("region", _TEXT))

PRICES = _struct(
    ("event_id", _TEXT),
    ("barcode", _TEXT),
    ("store_id", _TEXT),
    ("price", MONEY),
    ("promotion", _FLAG),
    ("stock_status", _TEXT),
    ("event_timestamp", _TIME),
    ("loaded_at", _TIME),
)

QUARANTINE = _struct(
    ("pipeline_run_id", _TEXT),
    ("dataset_name", _TEXT),
    ("failure_reason", _TEXT),
    ("raw_record", _TEXT),
    ("quarantined_at", _TIME),
)

VERDICTS = _struct(
    ("pipeline_run_id", _TEXT),
    ("barcode", _TEXT),
    ("status", _TEXT),
    ("confidence", T.DecimalType(5, 4)),
    ("reasons", T.ArrayType(_TEXT)),
    ("validator", _TEXT),
    ("validated_at", _TIME),
)

PIPELINE_RUNS = _struct(
    ("pipeline_run_id", _TEXT),
    ("pipeline_name", _TEXT),
    ("status", _TEXT),
    ("source_records", _LONG),
    ("valid_records", _LONG),
    ("rejected_records", _LONG),
    ("already_loaded", _LONG),
    ("product_file", _TEXT),
    ("price_file", _TEXT),
    ("started_at", _TIME),
    ("completed_at", _TIME),
    ("error_message", _TEXT),
    ("commit_seq", _LONG),
)

STREAM_EVENT = _struct(
    ("event_id", _TEXT),
    ("barcode", _TEXT),
    ("store_id", _TEXT),
    ("price", T.DoubleType()),
    ("currency", _TEXT),
    ("promotion", _FLAG),
    ("stock_status", _TEXT),
    ("event_time", _TIME),
)
