"""Safe arithmetic, time differences and number formatting."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(numerator: Column, denominator: Column, when_undefined: float = 0.0) -> Column:
    """Quotient as double; ``when_undefined`` for a zero or null denominator."""
    return F.coalesce(
        F.try_divide(numerator.cast("double"), denominator.cast("double")), F.lit(when_undefined)
    )


def percent(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def millis_between(start: Column, end: Column) -> Column:
    """Milliseconds from ``start`` to ``end`` with the microsecond fraction kept."""
    return F.timestamp_diff("MICROSECOND", start, end) / F.lit(1000.0)


def whole_millis_between(start: Column, end: Column) -> Column:
    """Whole milliseconds, truncated toward zero."""
    return F.timestamp_diff("MILLISECOND", start, end)


def clamp(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))


def total(value: Column, sum_type: str = "double") -> Column:
    """Sum of ``value``; 0 when nothing contributes.

    A decimal ``sum_type`` makes the result independent of the order in which partial
    sums meet, so it is identical from run to run; ``double`` is the faster default.
    """
    return F.coalesce(F.sum(value.cast(sum_type)).cast("double"), F.lit(0.0))


def mean(value: Column, sum_type: str = "double") -> Column:
    """Average of the non-null values, null when there are none."""
    return F.try_divide(F.sum(value.cast(sum_type)).cast("double"), F.count(value).cast("double"))


def readable_bytes(size: Column) -> Column:
    """``512 B``, ``1.50 KB``, ``2.00 MB``; a tie goes to the even digit."""
    kib, mib = 1024, 1024 * 1024
    return (
        F.when(size < kib, F.concat(size.cast("string"), F.lit(" B")))
        .when(size < mib, F.format_string("%.2f KB", F.bround(size / F.lit(float(kib)), 2)))
        .otherwise(F.format_string("%.2f MB", F.bround(size / F.lit(float(mib)), 2)))
    )


def reduction_pct(before: Column, after: Column) -> Column:
    """Size saved in percent of the size before."""
    return (F.lit(1.0) - ratio(after, before, 1.0)) * F.lit(100.0)


def seconds(millis: Column) -> Column:
    return millis / F.lit(1000.0)


def minutes(millis: Column) -> Column:
    return millis / F.lit(60000.0)
