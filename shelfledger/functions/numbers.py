"""Number parsing and exact rounding.

Money is averaged and rounded in whole units of an integer scale, so that a half is exactly a half
and the result does not depend on the order in which partial sums arrive.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
INFINITE = r"(?i)^[+-]?inf(inity)?$"

MICRO = 1_000_000
WIDE = "decimal(38,0)"


def safe_double(text: Column) -> Column:
    """Double of a stripped numeric text, null for anything else, NaN included."""
    infinity = F.when(text.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return (F.when(text.rlike(NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))
            .when(text.rlike(INFINITE), infinity))


def cents(price: Column) -> Column:
    """Whole cents of a decimal(10,2) price."""
    return (price * 100).cast("bigint")


def micros(price: Column) -> Column:
    """Millionths of a double price."""
    return F.round(price * MICRO).cast("bigint")


def money(cents_col: Column) -> Column:
    return cents_col.cast("decimal(18,0)") * F.lit(Decimal("0.01"))


def _div(a: Column, b: Column) -> Column:
    """Integer division."""
    return F.call_function("div", a, b)


def half_up(num: Column, den: Column) -> Column:
    """``round(num / den)`` for integers, halves away from zero; null when ``den`` is zero."""
    den = F.nullif(den, F.lit(0).cast("bigint"))
    size = _div(F.abs(num) * 2 + den, den * 2)
    return F.when(num < 0, -size).otherwise(size)


def mean_cents(sum_cents: Column, n: Column) -> Column:
    """Average of integer cents, rounded to a whole cent."""
    return half_up(sum_cents, n)


def mean_cents_of_micros(sum_micros: Column, n: Column) -> Column:
    """Average of millionths, rounded to a whole cent."""
    return half_up(sum_micros, n * (MICRO // 100))


def percent(num: Column, den: Column, digits: int) -> Column:
    """``round(100 * num / den, digits)`` of integers, null when ``den`` is zero."""
    scale = 10 ** digits
    num, den = num.cast(WIDE), F.nullif(den.cast(WIDE), F.lit(0).cast(WIDE))
    size = _div(F.abs(num) * (200 * scale) + den, den * 2)
    scaled = F.when(num < 0, -size).otherwise(size)
    return scaled.cast("decimal(18,0)") * F.lit(Decimal(1).scaleb(-digits))
