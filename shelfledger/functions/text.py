"""Text expressions, all built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that Python's str.strip removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007"
    "\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# The texts that a pandas CSV reader takes as missing.
NULL_WORDS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def strip(col: Column) -> Column:
    """Strip blanks at both ends (Spark's own ``trim`` keeps tabs and newlines)."""
    return F.btrim(col, F.lit(BLANKS))


def stripped(col: Column) -> Column:
    """Stripped text, null when nothing is left."""
    return F.nullif(strip(col), F.lit(""))


def csv_null(col: Column) -> Column:
    return F.when(~col.isin(*NULL_WORDS), col)


def initcap(col: Column) -> Column:
    """Capitalise each run of letters and digits (Spark's ``initcap`` splits at blanks only)."""
    runs = F.regexp_extract_all(col, F.lit(r"[\p{L}\p{N}]+|[^\p{L}\p{N}]+"), F.lit(0))
    return F.array_join(F.transform(runs, F.initcap), "")


def tag_label(col: Column) -> Column:
    """Display label of a ``xx:some-tag`` category."""
    return initcap(F.replace(F.regexp_replace(col, "^[a-z]{2}:", ""), F.lit("-"), F.lit(" ")))


def status_label(col: Column) -> Column:
    return initcap(F.replace(col, F.lit("_"), F.lit(" ")))


def reasons(*rules: tuple[Column, str]) -> Column:
    """Array of the texts whose condition holds, in the order given.

    ``array_except`` rather than a lambda filter: it takes the nulls out inside generated code.
    """
    hits = F.array(*[F.when(condition, F.lit(text)) for condition, text in rules])
    return F.array_except(hits, F.array(F.lit(None).cast("string")))


SEPARATOR = "; "


def reason_text(*rules: tuple[Column, str]) -> Column:
    """The same as one text, null when no condition holds."""
    hits = [F.when(condition, F.lit(text)) for condition, text in rules]
    return F.nullif(F.concat_ws(SEPARATOR, *hits), F.lit(""))


def joined(reasons_col: Column) -> Column:
    return F.concat_ws(SEPARATOR, reasons_col)


def uuid_shape(digest: Column) -> Column:
    """32 hexadecimal digits, as of an ``md5`` column, written as a UUID; null for null."""
    first, *others = [F.substring(digest, start, n) for start, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(first, *[part for text in others for part in (F.lit("-"), text)])


def uuid_bytes(col: Column) -> Column:
    """The 16 bytes of a canonical UUID, null for any other text; they sort as their texts do."""
    return F.when(col.rlike(UUID_SHAPE), F.unhex(F.replace(col, F.lit("-"), F.lit(""))))


def uuid_text(col: Column) -> Column:
    """The canonical UUID of 16 bytes."""
    # null for null by itself: inside a condition the digits would be made anew for each of their groups
    return uuid_shape(F.lower(F.hex(col)))


UUID_SHAPE = "^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$"
_FOUR = "([0-9a-f]{4})"
_UUID_INPUT = r"^(?=\{.*\}$|[^{}]*$)\{?" + "-?".join([_FOUR] * 8) + r"\}?$"


def canonical_uuid(col: Column) -> Column:
    """Lower-case hyphenated form of anything a UUID column takes; other text just in lower case."""
    lower = F.lower(col)
    # nearly all are in this form already, and the test costs a fraction of the rewriting
    return F.when(lower.rlike(UUID_SHAPE), lower).otherwise(F.regexp_replace(lower, _UUID_INPUT, "$1$2-$3-$4-$5-$6$7$8"))
