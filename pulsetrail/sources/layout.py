"""Event files clustered in several columns at once.

Sorted by time, a file's statistics tell nothing about its users; sorted by user, nothing about
time. Here rows are written along a curve that takes a bit of each column in turn: of the
place of its value among equal-frequency cuts of the column. Rows near each other on the curve
are near in every column, so the least and greatest values that Parquet keeps per row group are
narrow in all of them, and a filter on any, or on several, skips most row groups.

The cuts are exact and found without a sort (``select_ranks``); a value that is very frequent
takes up several groups of the column and leaves its place on the curve to the other columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.operators.selection import select_ranks

BITS = 6
CURVE = "_curve"


def column_cuts(df: DataFrame, name: str, bits: int = BITS) -> list:
    """Distinct values that end the equal-frequency groups of a column, at most 2^bits - 1."""
    groups = 1 << bits
    known = df.where(F.col(name).isNotNull())
    _, found = select_ranks(known, [name], lambda n: [j * n // groups for j in range(1, groups) if j * n >= groups])
    return list(dict.fromkeys(found[rank][0] for rank in sorted(found)))


def _place(name: str, cuts: list, bits: int) -> Column:
    """Number of the value's group, spread over the ``bits`` that the curve takes of it."""
    if not cuts:
        return F.lit(0)
    steps = F.array(*[F.lit(cut) for cut in cuts])
    group = F.size(F.filter(steps, lambda cut: cut < F.col(name)))
    # Nulls come first. With few different values the high bits have to tell them apart.
    return F.coalesce(F.floor(group * (1 << bits) / (len(cuts) + 1)).cast("int"), F.lit(0))


def curve(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """Place of a row on the curve: bits of the columns in turn, the highest first."""
    places = [_place(name, column_cuts(df, name, bits), bits) for name in columns]
    total = F.lit(0).cast("long")
    for bit in range(bits - 1, -1, -1):
        for place in places:
            total = F.shiftleft(total, 1).bitwiseOR(F.shiftright(place, bit).bitwiseAND(F.lit(1)).cast("long"))
    return total


def write_clustered(
    df: DataFrame,
    path: str,
    columns: Sequence[str],
    bits: int = BITS,
    group_bytes: int = 16 << 20,
    files: int | None = None,
) -> None:
    """Write ``df`` along the curve of ``columns``, whole numbers, doubles or strings.

    ``df`` is read some passes per column for the cuts: pass a table. Rows with equal places
    are ordered by the columns, so a hot value is spread over files.
    """
    placed = df.withColumn(CURVE, curve(df, columns, bits))
    keys = [CURVE, *columns]
    ordered = placed.repartitionByRange(files, *keys) if files else placed.repartitionByRange(*keys)
    (
        ordered.sortWithinPartitions(*keys)
        .drop(CURVE)
        .write.mode("overwrite")
        .option("parquet.block.size", group_bytes)
        .option("parquet.page.size.row.check.min", 100)
        .parquet(path)
    )
