"""Exact selection of ranks by radix: the rows at given places of a sorted order, unsorted.

Keys are cut into digits that keep the order. A pass counts the leading digits of the
rows that are still in question, in one aggregate that combines on the map side, and
only the buckets in which a wanted rank falls go on to the next digit. Nothing is sorted,
written or moved but the counts: at most ``BUCKETS`` per wanted rank, wherever the rows
lie and however often a value repeats. Once few rows are left in the buckets they are
gathered and put in order.

Digits: of whole numbers their leading bits within the range that is left; of decimals
the same by division; of doubles the sign, the exponent and three bits (a logarithm)
where the range is wide, else equal parts of it, so that four passes reach any double; of
strings two bytes.

Keys must not be null. NaN comes last, as in Spark's order.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from decimal import Context, Decimal
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType,
    DataType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    ShortType,
    StringType,
)

BUCKETS = 1 << 16
# Rows of a bucket that are gathered instead of being divided further.
GATHERED = 1_000
# Beyond the logarithm of any double.
_INFINITE, _NAN = 1_000_000, 1_000_001
_EXACT = Context(prec=100)


@dataclass(frozen=True)
class _Span:
    """Rows with equal earlier keys and a key from ``low`` to ``high``.

    Of a string key ``low`` holds the leading bytes. ``less`` rows come before them.
    """

    earlier: tuple
    low: object
    high: object
    less: int
    rows: int
    ranks: tuple[int, ...] = field(default=())


class _Numbers:
    """Whole numbers."""

    def bounds(self, key: str) -> list[Column]:
        return [F.min(key).alias("_low"), F.max(key).alias("_high")]

    def inside(self, key: str, span: _Span) -> Column:
        return F.col(key).between(self.literal(span.low), self.literal(span.high))

    def literal(self, value) -> Column:
        return F.lit(value)

    def digit(self, key: str, span: _Span) -> Column:
        shift = max((span.high - span.low).bit_length() - 16, 0)
        return F.shiftright(F.col(key).cast("long"), shift)

    def narrowed(self, span: _Span, row) -> tuple:
        return row["_low"], row["_high"]

    def single(self, span: _Span) -> bool:
        return span.low == span.high

    def order(self, value):
        return value


class _Decimals(_Numbers):
    def __init__(self, kind: DecimalType):
        self.scale = kind.scale

    def digit(self, key: str, span: _Span) -> Column:
        steps = int(_EXACT.subtract(span.high, span.low).scaleb(self.scale, _EXACT))
        width = Decimal(steps // (BUCKETS - 1) + 1).scaleb(-self.scale, _EXACT)
        return F.floor((F.col(key) - F.lit(span.low)) / F.lit(width)).cast("long")


class _Doubles(_Numbers):
    def literal(self, value) -> Column:
        return F.lit(value).cast("double")

    def digit(self, key: str, span: _Span) -> Column:
        value, low, high = F.col(key).cast("double"), span.low, span.high
        near, far = sorted((abs(low), abs(high)))
        if (low > 0 or high < 0) and far <= near * BUCKETS:
            return F.floor((value - F.lit(low)) / F.lit(high - low) * float(BUCKETS - 1)).cast("long")
        size = F.abs(value)
        exponent = F.floor((F.log2(size) + 1100.0) * 8.0).cast("int")
        return (
            F.when(F.isnan(value), _NAN)
            .when(value == 0, 0)
            .when(size == F.lit(math.inf), F.signum(value).cast("int") * _INFINITE)
            .otherwise(F.signum(value).cast("int") * exponent)
            .cast("long")
        )

    def single(self, span: _Span) -> bool:
        return span.low == span.high or (math.isnan(span.low) and math.isnan(span.high))

    def order(self, value):
        return (1, 0.0) if math.isnan(value) else (0, value)


class _Strings(_Numbers):
    WIDTH = 2

    def bounds(self, key: str) -> list[Column]:
        return []

    def _bytes(self, key: str, start: int, length: int) -> Column:
        return F.substring(F.col(key).cast("binary"), start, length)

    def inside(self, key: str, span: _Span) -> Column:
        return self._bytes(key, 1, len(span.low)) == F.lit(span.low)

    def digit(self, key: str, span: _Span) -> Column:
        return F.hex(self._bytes(key, len(span.low) + 1, self.WIDTH))

    def narrowed(self, span: _Span, row) -> tuple:
        more = bytearray(span.low) + bytes.fromhex(row["_digit"])
        # A short digit is the end of the string.
        return more, len(row["_digit"]) < 2 * self.WIDTH

    def single(self, span: _Span) -> bool:
        return span.high is True

    def order(self, value):
        return value.encode()


def _kind(data_type: DataType) -> _Numbers:
    if isinstance(data_type, (ByteType, ShortType, IntegerType, LongType)):
        return _Numbers()
    if isinstance(data_type, (FloatType, DoubleType)):
        return _Doubles()
    if isinstance(data_type, DecimalType):
        return _Decimals(data_type)
    if isinstance(data_type, StringType):
        return _Strings()
    raise TypeError(f"no digits for {data_type.simpleString()}")


def _same(keys: Sequence[str], values: tuple, kinds: Sequence[_Numbers]) -> Column:
    """Rows whose first keys have the given values."""
    same = [F.col(k).eqNullSafe(kind.literal(v)) for k, v, kind in zip(keys, values, kinds)]
    return reduce(and_, same, F.lit(True))


def _divide(
    df: DataFrame, keys: Sequence[str], kinds: Sequence[_Numbers], level: int, spans: list[_Span]
) -> list[_Span]:
    """The parts of the spans, by the next digit, that hold their wanted ranks."""
    key, kind = keys[level], kinds[level]
    inside = [_same(keys, s.earlier, kinds) & kind.inside(key, s) for s in spans]
    number = F.coalesce(*[F.when(here, F.lit(i)) for i, here in enumerate(inside)])
    digit = F.coalesce(*[F.when(F.col("_span") == i, kind.digit(key, s)) for i, s in enumerate(spans)])
    counts = (
        df.where(reduce(or_, inside))
        .select(key, number.alias("_span"))
        .withColumn("_digit", digit)
        .groupBy("_span", "_digit")
        .agg(F.count(F.lit(1)).alias("_rows"), *kind.bounds(key))
    )
    # At most BUCKETS rows a span.
    order = Window.partitionBy("_span").orderBy("_digit").rowsBetween(Window.unboundedPreceding, 0)
    wanted = F.coalesce(
        *[
            F.when(F.col("_span") == i, F.array(*[F.lit(r - s.less).cast("long") for r in s.ranks]))
            for i, s in enumerate(spans)
        ]
    )
    upto = F.sum("_rows").over(order)
    picked = (
        counts.withColumn("_upto", upto)
        .withColumn("_wanted", wanted)
        .where(F.exists("_wanted", lambda r: (r <= F.col("_upto")) & (r > F.col("_upto") - F.col("_rows"))))
        .collect()
    )
    parts = []
    for row in picked:
        span = spans[row["_span"]]
        less = span.less + row["_upto"] - row["_rows"]
        here = tuple(r for r in span.ranks if less < r <= less + row["_rows"])
        low, high = kind.narrowed(span, row)
        parts.append(_Span(span.earlier, low, high, less, row["_rows"], here))
    return parts


def _begin(
    df: DataFrame, keys: Sequence[str], kinds: Sequence[_Numbers], level: int, spans: list[_Span]
) -> list[_Span]:
    """Spans over a key, from spans whose earlier keys are settled."""
    key, kind = keys[level], kinds[level]
    bounds = kind.bounds(key)
    if not bounds:
        return [_Span(s.earlier, bytearray(), False, s.less, s.rows, s.ranks) for s in spans]
    inside = [_same(keys, s.earlier, kinds) for s in spans]
    number = F.coalesce(*[F.when(here, F.lit(i)) for i, here in enumerate(inside)])
    rows = df.where(reduce(or_, inside)).groupBy(number.alias("_span")).agg(*bounds)
    found = {row["_span"]: row for row in rows.collect()}
    return [
        _Span(s.earlier, found[i]["_low"], found[i]["_high"], s.less, s.rows, s.ranks)
        for i, s in enumerate(spans)
    ]


def _gather(
    df: DataFrame, keys: Sequence[str], kinds: Sequence[_Numbers], spans: list[_Span], inside: list[Column]
) -> dict[int, tuple]:
    """The rows of small spans, in order on the driver: GATHERED a span at most."""
    if not spans:
        return {}
    number = F.coalesce(*[F.when(here, F.lit(i)) for i, here in enumerate(inside)])
    rows: dict[int, list[tuple]] = {i: [] for i in range(len(spans))}
    for row in df.where(reduce(or_, inside)).select(number, *keys).collect():
        rows[row[0]].append(tuple(row[1:]))
    found = {}
    for i, span in enumerate(spans):
        place = sorted(rows[i], key=lambda r: tuple(k.order(v) for k, v in zip(kinds, r)))
        found |= {r: place[r - span.less - 1] for r in span.ranks}
    return found


def select_ranks(
    df: DataFrame,
    keys: Sequence[str],
    wanted: Callable[[int], Sequence[int]],
    gathered: int = GATHERED,
) -> tuple[int, dict[int, tuple]]:
    """Number of rows n, and the keys of the rows at the ranks ``wanted(n)`` (from 1).

    Rows are in the order of ``keys``; rows with equal keys are interchangeable. ``df`` is
    read once per pass, so it should be a table or cheap to compute.
    """
    kinds = [_kind(df.schema[key].dataType) for key in keys]
    whole = df.agg(F.count(F.lit(1)).alias("_n"), *kinds[0].bounds(keys[0])).first()
    n = whole["_n"]
    ranks = tuple(sorted({r for r in wanted(n) if 1 <= r <= n})) if n else ()
    if not ranks:
        return n, {}
    found: dict[int, tuple] = {}
    if kinds[0].bounds(keys[0]):
        spans = [_Span((), whole["_low"], whole["_high"], 0, n, ranks)]
    else:
        spans = [_Span((), bytearray(), False, 0, n, ranks)]
    for level, (key, kind) in enumerate(zip(keys, kinds)):
        if level:
            spans = _begin(df, keys, kinds, level, spans)
        settled: list[_Span] = []
        while spans:
            settled += [s for s in spans if kind.single(s)]
            spans = [s for s in spans if not kind.single(s)]
            small = [s for s in spans if s.rows <= gathered]
            inside = [_same(keys, s.earlier, kinds) & kind.inside(key, s) for s in small]
            found |= _gather(df, keys, kinds, small, inside)
            spans = [s for s in spans if s.rows > gathered]
            spans = _divide(df, keys, kinds, level, spans) if spans else []
        value = (lambda s: bytes(s.low).decode()) if isinstance(kind, _Strings) else (lambda s: s.low)
        settled = [_Span((*s.earlier, value(s)), None, None, s.less, s.rows, s.ranks) for s in settled]
        if level == len(keys) - 1:
            found |= {r: s.earlier for s in settled for r in s.ranks}
            return n, found
        small = [s for s in settled if s.rows <= gathered]
        found |= _gather(df, keys, kinds, small, [_same(keys, s.earlier, kinds) for s in small])
        spans = [s for s in settled if s.rows > gathered]
        if not spans:
            break
    return n, found
