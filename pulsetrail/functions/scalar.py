"""Column expressions shared by the operators. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOUR_S = 3600
DAY_S = 86400
MICROS = 1_000_000

# Exact, order-independent sums of money: a double sum depends on task order.
MONEY = "decimal(18,6)"
# A sum of those: ten digits more.
MONEY_TOTAL = "decimal(28,6)"

# Times are UTC without a zone. Arithmetic goes by intervals from here, never by way of a
# timestamp with a zone, which would take on the zone of the caller's session.
_EPOCH = "TIMESTAMP_NTZ '1970-01-01 00:00:00'"


def epoch_to_ts(seconds: Column) -> Column:
    """Epoch seconds (fractional allowed) to a UTC timestamp without zone."""
    none = F.lit(0)
    return F.expr(_EPOCH) + F.make_dt_interval(none, none, none, seconds.cast("decimal(18,6)"))


def micros_to_ts(micros: Column) -> Column:
    """Whole microseconds since the epoch to a UTC timestamp without zone."""
    return epoch_to_ts(micros.cast("decimal(20,0)") / F.lit(MICROS).cast("decimal(7,0)"))


def hour_bucket(seconds: Column) -> Column:
    """Start of the UTC hour that holds an epoch-seconds value."""
    return epoch_to_ts(F.floor(seconds / HOUR_S) * HOUR_S)


def epoch_micros(ts: Column) -> Column:
    """Whole microseconds since the epoch for a timestamp column."""
    since = (ts.cast("timestamp_ntz") - F.expr(_EPOCH)).cast("interval second")
    return (since.cast("decimal(18,6)") * MICROS).cast("bigint")


def hour_of_day(seconds: Column) -> Column:
    return F.floor(F.pmod(seconds, F.lit(float(DAY_S))) / HOUR_S).cast("int")


def epoch_weekday(seconds: Column) -> Column:
    """Days since the epoch modulo 7, so 0 is a Thursday."""
    return F.pmod(F.floor(seconds / DAY_S), F.lit(7)).cast("int")


def month_index(ts: Column) -> Column:
    """Months since year 0; differences are whole calendar months."""
    return F.year(ts) * 12 + F.month(ts)


def whole_days(later: Column, earlier: Column) -> Column:
    """Elapsed time in days, rounded down (not calendar days)."""
    return F.floor((epoch_micros(later) - epoch_micros(earlier)) / (DAY_S * MICROS))


def filled(column: str | Column) -> Column:
    """A metric as a double with nulls and NaN read as zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.coalesce(F.nanvl(column.cast("double"), F.lit(0.0)), F.lit(0.0))


def exact_sum(column: str) -> Column:
    """Sum of a money column that does not depend on the order of the rows.

    A value that money cannot hold (1e12 or more) counts as missing; the quality rule
    ``unusable_<column>`` counts those.
    """
    return F.sum(F.col(column).try_cast(MONEY)).cast("double")


def is_event(kind: str) -> Column:
    return F.col("event_type") == kind


def safe_ratio(numerator: Column, denominator: Column, otherwise: float = 0.0) -> Column:
    """Division that yields ``otherwise`` for a zero or null denominator."""
    return F.coalesce(F.try_divide(numerator, denominator), F.lit(otherwise))


def rounded(value: Column | str, places: int) -> Column:
    """Round half to even, for the output edge only.

    Six further digits are dropped first: sums of doubles differ in their last bits
    with the order of the rows, and that noise must not decide a tie.
    """
    value = F.col(value) if isinstance(value, str) else value
    for digits in (places + 6, places):
        value = F.rint(value * 10.0**digits) / 10.0**digits
    return value


def fixed(value: Column, places: int) -> Column:
    """A number as text with ``places`` decimals, rounded on its exact binary value."""
    return F.call_function("format_number", value, F.lit("0." + "0" * places))


def literal_array(values: Iterable) -> Column:
    return F.array(*[F.lit(v) for v in values])


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The given names that the frame has, in the given order."""
    have = set(df.columns)
    return [name for name in names if name in have]
