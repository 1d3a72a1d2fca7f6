"""Small literal frames."""

from shelfledger.schemas import PRICE_RAW, PRODUCT_RAW
from pyspark.sql import types as T

POSITION = T.StructField("row_pos", T.LongType())


def uid(n):
    return f"00000000-0000-0000-0000-{n:012d}"


def price_rows(spark, rows, partitions=3):
    """Rows are dicts over a valid default; position follows the list."""
    default = {"event_id": uid(0), "barcode": "1", "store_id": "s", "price": "2.50",
               "promotion": "False", "stock_status": "in_stock",
               "event_timestamp": "2025-01-01T00:00:00Z"}
    schema = T.StructType([POSITION, *PRICE_RAW.fields])
    data = [(i, *[{**default, **row}[c] for c in PRICE_RAW.fieldNames()]) for i, row in enumerate(rows)]
    return spark.createDataFrame(data, schema).repartition(partitions)


def product_rows(spark, rows):
    default = {"code": "1", "product_name": "Tea", "brands": None, "categories_tags": None,
               "ingredients_text": None, "energy_kcal_100g": None, "last_modified_t": None}
    schema = T.StructType([POSITION, *PRODUCT_RAW.fields, T.StructField("payload", T.StringType())])
    data = [(i, *[{**default, **row}[c] for c in PRODUCT_RAW.fieldNames()], f"{{\"n\":{i}}}")
            for i, row in enumerate(rows)]
    return spark.createDataFrame(data, schema).repartition(2)


def keys(spark, name, *values):
    return spark.createDataFrame([(v,) for v in values], f"{name} string")
