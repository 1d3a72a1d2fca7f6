"""Price validation: every raw row with all the reasons it fails."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfledger.functions.numbers import safe_double
from shelfledger.functions.text import SEPARATOR, canonical_uuid, reason_text, stripped, uuid_bytes, uuid_text
from shelfledger.functions.times import instant, parse_timestamp
from shelfledger.operators.skew import HOT_ROWS, join_counted, join_marks, mark_known, may_broadcast, place_marks
from shelfledger.schemas import MONEY, PRICE_COLUMNS, RAW_LINE

PRICE_LIMIT = 500
TOLERANCE = "5 minutes"
TRUE_WORDS = ("true", "1", "yes")
#: Rows up to which ids are counted whatever the estimate says.
COUNTED = 250_000
#: Rows up to which what is found about them comes back as marks, a bit for each that every task holds.
MARKED = 1 << 31
#: Groups of ids, by hash, whose sizes tell whether an id may be hot.
ID_GROUPS = 1 << 16
REPEATED = "Duplicate event ID in source file"


# Parsed fields are flat columns next to the raw ones. As fields of a struct the optimizer would
# repeat their expressions at every use.
TYPED = ("event_key", "barcode_key", "store_key", "price_value", "is_promotion", "stock_value",
         "event_time")
# Raw texts and the keys stripped from them, which are null together.
_STRIPPED = {"event_id": "event_key", "barcode": "barcode_key", "store_id": "store_key"}
_VALUES = TYPED[3:]


def typed_prices(raw: DataFrame) -> DataFrame:
    """Raw rows plus their stripped and parsed fields."""
    return _with_values(_with_keys(raw))


def _with_keys(raw: DataFrame) -> DataFrame:
    if RAW_LINE not in raw.columns:
        raw = raw.withColumn(RAW_LINE, F.lit(None).cast("string"))
    return (raw.withColumns({key: stripped(F.col(text)) for text, key in _STRIPPED.items()})
            .withColumn("event_key", canonical_uuid(F.col("event_key"))))


def _with_values(rows: DataFrame) -> DataFrame:
    return (rows.withColumn("price_value", stripped(F.col("price")))
            .withColumns({
                "price_value": safe_double(F.col("price_value")),
                "is_promotion": F.coalesce(F.lower("promotion").isin(*TRUE_WORDS), F.lit(False)),
                "stock_value": F.coalesce(F.nullif("stock_status", F.lit("")), F.lit("unknown")),
                "event_time": parse_timestamp(F.col("event_timestamp"))}))


def pack(rows: DataFrame) -> DataFrame:
    """Rows with their keys, without what other columns tell, for shuffles and intermediate tables: an id that is a UUID
    as its 16 bytes in ``event_uuid``, and a raw text only where stripping changed it. ``unpack`` restores them."""
    uuid = uuid_bytes(F.col("event_key"))
    return rows.withColumns({
        **{raw: F.when(~F.col(raw).eqNullSafe(F.col(key)), F.col(raw)) for raw, key in _STRIPPED.items()},
        "event_uuid": uuid, "event_key": F.when(uuid.isNull(), F.col("event_key"))})


def unpack(packed: DataFrame) -> DataFrame:
    key = F.coalesce(uuid_text(F.col("event_uuid")), "event_key")
    rows = packed.withColumns({"event_key": key, "event_id": F.coalesce("event_id", key),
                               "barcode": F.coalesce("barcode", "barcode_key"),
                               "store_id": F.coalesce("store_id", "store_key")}).drop("event_uuid")
    if "failure_reason" in packed.columns:
        rows = rows.withColumn("failures", F.coalesce(F.split("failure_reason", SEPARATOR), F.array().cast("array<string>")))
    return rows


def check_rows(raw: DataFrame, products: DataFrame, stores: DataFrame, as_of,
               limit: float = PRICE_LIMIT, inclusive: bool = True, tolerance: str = TOLERANCE,
               spread: Sequence[str] = ("row_pos",)) -> DataFrame:
    """Typed rows with the reasons that each row earns by itself, as ``own_reason``.

    ``products`` and ``stores`` hold each key once. ``inclusive`` accepts a price of exactly
    ``limit``.
    """
    return unpack(_check_packed(raw, products, stores, as_of, limit, inclusive, tolerance, spread))


def _check_packed(raw: DataFrame, products: DataFrame, stores: DataFrame, as_of, limit: float, inclusive: bool,
                  tolerance: str, spread: Sequence[str], stage_keys=None) -> DataFrame:
    rows = pack(_with_keys(raw))
    for table, name, key, marker in ((products, "barcode", "barcode_key", "_product"), (stores, "store_id", "store_key", "_store")):
        rows = mark_known(rows, table.select(F.col(name).alias(key)), key, marker, spread, stage_keys)
    rows = _with_values(rows)
    uuid, other_id = F.col("event_uuid"), F.col("event_key")
    price, at = F.col("price_value"), F.col("event_time")
    too_high = price > limit if inclusive else price >= limit
    horizon = instant(as_of) + F.expr(f"interval {tolerance}")
    own = reason_text(
        (uuid.isNull() & other_id.isNull(), "Missing event ID"),
        (F.col("_product").isNull(), "Unknown product barcode"),
        (F.col("_store").isNull(), "Unknown store"),
        (price.isNull(), "Missing or invalid price"),
        (price <= 0, "Price must be greater than zero"),
        (too_high, "Price exceeds reasonable limit"),
        (at.isNull(), "Invalid event timestamp"),
        (at > horizon, "Timestamp is in the future"),
        (other_id.isNotNull(), "Event ID is not a UUID"),
        ((price > 0) & (price < 0.005), "Price rounds to zero"),
        (F.col(RAW_LINE).isNotNull(), "Fields do not match the header"),
    )
    return rows.withColumn("own_reason", own).drop("_product", "_store")


def repeated_ids(checked: DataFrame, order: str, key: str = "event_key") -> DataFrame:
    """Ids that occur more than once and were accepted once, with the place of the accepted row.

    An id counts as seen only after a row with it was accepted, and the first row that fails
    nothing else is the one accepted. Its place is a minimum, which combines map-side, so an id
    that holds a third of all rows costs no more than any other.
    """
    own_ok = F.col("own_reason").isNull()
    # rows without an id form one group, which the last filter removes; a filter on the id itself
    # would be pushed below the parsing and repeat it
    nothing = F.lit("").cast(dict(checked.dtypes)[key])
    return (checked.groupBy(F.coalesce(key, nothing).alias(key))
            .agg(F.min(F.when(own_ok, F.col(order))).alias("_first"),
                 F.count(F.lit(1)).alias("_copies"))
            .filter((F.col("_copies") > 1) & F.col("_first").isNotNull()))


def _few_may_repeat(checked: DataFrame, key: str) -> bool:
    """False where many ids are sure to repeat, by an estimate from a scan of the ids (three standard errors)."""
    n, distinct = checked.agg(F.count(key), F.approx_count_distinct(key, 0.02)).first()
    return n <= COUNTED or n - distinct <= 0.06 * n


def several(checked: DataFrame, key: str) -> DataFrame:
    """Ids that occur more than once; only the id of a row is shuffled."""
    return (checked.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_copies"))
            .filter(F.col("_copies") > 1))


def flag_repeats(checked: DataFrame, order: str = "row_pos", hot_rows: int = HOT_ROWS,
                 spread: Sequence[str] = ("row_pos",), key: str = "event_key") -> DataFrame:
    """Adds ``repeated``: an earlier row with this event id was accepted. ``key`` is the column of the id."""
    found = join_counted(checked, repeated_ids(checked, order, key), key, "_copies", spread, hot_rows)
    later = F.coalesce(F.col(order) > F.col("_first"), F.lit(False))
    return found.withColumn("repeated", later).drop("_first", "_copies")


def later_copies(ids: DataFrame, order: str, key: str, hot_rows: int = HOT_ROWS) -> DataFrame | None:
    """The places of rows behind the accepted one of their id, of a table of places, ids and ``own_reason``; an id and a place are
    all that is shuffled of a row, once unless an id may be hot. None where there are too many rows to bring marks back to them.
    """
    sizes = ids.groupBy(F.pmod(F.xxhash64(key), F.lit(ID_GROUPS)).alias("g")).agg(F.count(F.lit(1)).alias("n"), F.count(key).alias("with_id"))
    n, largest = sizes.agg(F.sum("n"), F.max("with_id")).first()
    if (n or 0) > MARKED:
        return None
    ids = ids.filter(F.col(key).isNotNull())
    if (largest or 0) < hot_rows:
        first = F.min(F.when(F.col("own_reason").isNull(), F.col(order))).over(Window.partitionBy(key))
        return ids.withColumn("_first", first).filter(F.col(order) > F.col("_first")).select(order)
    return flag_repeats(ids, order, hot_rows, (order,), key).filter("repeated").select(order)


def decide_prices(raw: DataFrame, products: DataFrame, stores: DataFrame, as_of,
                  limit: float = PRICE_LIMIT, inclusive: bool = True, tolerance: str = TOLERANCE,
                  order: str = "row_pos", hot_rows: int = HOT_ROWS, stage=None, stage_ids=None) -> DataFrame:
    """Every raw price row with ``failures``, ``failure_reason`` and ``accepted``.

    ``stage`` may write a frame to shared storage and read it back: the checked rows feed both
    the search for repeated ids and the final join, and a written table is not computed twice. For ``stage_ids``
    see ``decide_packed``.
    """
    return unpack(decide_packed(raw, products, stores, as_of, limit, inclusive, tolerance, order, hot_rows, stage, stage_ids))


def decide_packed(raw: DataFrame, products: DataFrame, stores: DataFrame, as_of,
                  limit: float = PRICE_LIMIT, inclusive: bool = True, tolerance: str = TOLERANCE,
                  order: str = "row_pos", hot_rows: int = HOT_ROWS, stage=None, stage_ids=None, stage_wide=None,
                  stage_keys=None) -> DataFrame:
    """``decide_prices`` before ``unpack``, to be written by the caller.

    Ids that are no UUIDs are never accepted, so none of them repeats an accepted one: the bytes suffice as the key.
    Where the rows travel, values are parsed once more after the join on the id, which costs less than moving them next to
    their texts.

    ``stage_ids`` writes a frame under a name and reads it back. With it the ids are counted first, alone, unless an estimate
    rules out that few repeat; where those that occur more than once are few enough for the planner to broadcast, no price row
    is shuffled: the result is a scan of the checked rows, which keep their values. ``stage_wide`` writes the result where they
    are not, so that the rows travel once.

    ``stage_keys`` writes a narrow frame under a name and reads it back. With it, and with whole numbers as places, no row is
    shuffled at all unless a lookup lacks too many of the keys: keys meet the lookups, ids and places each other, and which rows
    are repeated comes back as a bit for each. The result is a scan of the checked rows.
    """
    key = "event_uuid"
    checked = _check_packed(raw, products, stores, as_of, limit, inclusive, tolerance, (order,), stage_keys)
    rest = [c for c in checked.columns if c not in _VALUES and c != "own_reason"]
    if stage_ids is None and stage_keys is None:
        checked = checked.drop(*_VALUES)
    checked = checked if stage is None else stage(checked)
    later = None
    if stage_keys is not None and dict(checked.dtypes)[order] == "bigint":
        wrong = F.when(F.col("own_reason").isNotNull(), F.lit(True)).alias("own_reason")  # its text would travel with the id
        later = later_copies(checked.select(order, key, wrong), order, key, hot_rows)
    if later is not None:
        marks = stage_keys(place_marks(later, order), "repeated")
        return _with_reason(join_marks(checked, marks, order, "repeated"), rest)
    few = False
    if stage_ids is not None and _few_may_repeat(checked, key):
        twice = stage_ids(several(checked, key), "several")
        few = may_broadcast(twice)
    if few:
        # of the rows of these ids only the places come together, so no id is hot
        theirs = checked.join(F.broadcast(twice.select(key)), key, "left_semi")
        first = stage_ids(repeated_ids(theirs, order, key).select(key, "_first"), "repeated")
        later = F.coalesce(F.col(order) > F.col("_first"), F.lit(False))
        flagged = checked.join(F.broadcast(first), key, "left").withColumn("repeated", later)
    else:
        flagged = _with_values(flag_repeats(checked.drop(*_VALUES), order, hot_rows, (order,), key))
    decided = _with_reason(flagged, rest)
    return decided if few or stage_wide is None else stage_wide(decided)


def _with_reason(flagged: DataFrame, rest: Sequence[str]) -> DataFrame:
    # a repeated id is named where a missing one would be: in front
    reason = F.nullif(F.concat_ws(SEPARATOR, F.when(F.col("repeated"), REPEATED), "own_reason"),
                      F.lit(""))
    return (flagged.withColumn("failure_reason", reason)
            .withColumn("accepted", F.col("failure_reason").isNull())
            .select(*rest, *_VALUES, "failure_reason", "accepted"))


def accepted_prices(decided: DataFrame, loaded_at) -> DataFrame:
    """The accepted rows in the layout of the price table; of packed rows with their ids as bytes in ``event_uuid``
    and with their places."""
    packed = [c for c in ("event_uuid", "row_pos") if {c, "event_uuid"} <= set(decided.columns)]
    return decided.filter("accepted").select(
        F.col("event_key").alias("event_id"), *packed,
        F.col("barcode_key").alias("barcode"),
        F.col("store_key").alias("store_id"), F.col("price_value").cast(MONEY).alias("price"),
        F.col("is_promotion").alias("promotion"), F.col("stock_value").alias("stock_status"),
        F.col("event_time").alias("event_timestamp"),
        instant(loaded_at).alias("loaded_at"))


def raw_price_json() -> Column:
    """The raw record, absent fields as nulls; of a record that doesn't fit the header, its line."""
    return F.coalesce(RAW_LINE, F.to_json(F.struct(*PRICE_COLUMNS), {"ignoreNullFields": "false"}))
