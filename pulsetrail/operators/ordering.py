"""Total orders without a single-partition window.

``Window.orderBy`` without a partition key moves every row to one task. The helpers
here range-partition instead, so ranks and bounded row frames over one long series run on
all executors. Where only a few ranks are wanted they are selected without a sort.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from pulsetrail.materialize import materialize
from pulsetrail.operators.selection import select_ranks

RANK = "_rank"
CHUNK, COPY = "_chunk", "_copy"
_LOCAL_BITS = 33  # monotonically_increasing_id: partition above, row number below
CHUNK_ROWS = 10_000


def global_rank(df: DataFrame, keys: Sequence[str | Column], rank: str = RANK) -> DataFrame:
    """Number rows 1..n in the order of ``keys``.

    End ``keys`` with a unique column: it makes the ranks reproducible, and it keeps
    the range partitions even when one value of the leading key is very common.
    The ordered rows are stored once, since range bounds are sampled and a second
    evaluation could split the rows differently.
    """
    ordered = materialize(
        df.repartitionByRange(*keys)
        .sortWithinPartitions(*keys)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _LOCAL_BITS).cast("int"))
        .withColumn("_at", F.col("_at").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
    )
    # One row per shuffle partition: small enough for one task and for a broadcast.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ordered.groupBy("_part")
        .count()
        .select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        ordered.join(F.broadcast(offsets), "_part")
        .withColumn(rank, F.col("_offset") + F.col("_at") + 1)
        .drop("_part", "_at", "_offset")
    )


def chunked(
    ranked: DataFrame, before: int, after: int = 0, rank: str = RANK, chunk_rows: int = CHUNK_ROWS
) -> DataFrame:
    """Rows cut into chunks by rank, each with the rows it borrows from its neighbours.

    Adds ``CHUNK``, and ``COPY`` for a borrowed row. A chunk is at least as long as what
    it borrows, so every row is borrowed by one chunk on each side at most.
    """
    size = max(chunk_rows, before, after)
    position = F.col(rank) - 1
    own = F.floor(position / size)
    offset = F.pmod(position, F.lit(size))
    places = F.array(
        own,
        F.when(offset >= size - before, own + 1),
        F.when(offset < after, own - 1),
    )
    return (
        ranked.withColumn("_own", own)
        .withColumn(CHUNK, F.explode(F.array_compact(places)))
        .withColumn(COPY, F.col(CHUNK) != F.col("_own"))
        .drop("_own")
    )


def over_frame(
    ranked: DataFrame,
    compute: Callable[[DataFrame, WindowSpec], DataFrame],
    before: int,
    after: int = 0,
    series: Sequence[str] = (),
    rank: str = RANK,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """Run window expressions that look at most ``before`` / ``after`` rows away.

    Ranks are cut into chunks and each chunk borrows the rows it needs from its
    neighbours, so a window per chunk gives the same answer as one window over
    everything. ``compute`` gets the frame and the window to use; ``ranked`` must be
    ordered by ``series`` first if that is given.
    """
    spread = chunked(ranked, before, after, rank, chunk_rows)
    window = Window.partitionBy(*series, CHUNK).orderBy(rank)
    return compute(spread, window).where(~F.col(COPY)).drop(CHUNK, COPY)


def order_statistics(df: DataFrame, value: str, probabilities: Sequence[float]) -> DataFrame:
    """Exact linearly interpolated quantiles as one row: q0, q1, ... and n.

    Equal to ``percentile`` but without holding every distinct value in one aggregation
    buffer, and without a sort: the ranks next to each quantile are selected by radix.
    Nulls are left out; without any value there is no row.
    """
    rows = df.where(F.col(value).isNotNull()).select(F.col(value).cast("double").alias(value))
    places = lambda n: [(n - 1) * p for p in probabilities]
    ends = lambda n: [f(at) + 1 for at in places(n) for f in (math.floor, math.ceil)]
    n, found = select_ranks(rows, [value], ends)
    schema = ", ".join([*[f"q{i} double" for i in range(len(probabilities))], "n long"])
    if not n:
        return df.sparkSession.createDataFrame([], schema)
    quantiles = []
    for at in places(n):
        low, high = found[math.floor(at) + 1][0], found[math.ceil(at) + 1][0]
        quantiles.append(low if low == high else low + (high - low) * (at - math.floor(at)))
    return df.sparkSession.createDataFrame([(*quantiles, n)], schema)


def equal_frequency_cuts(df: DataFrame, keys: Sequence[str], groups: int = 5) -> DataFrame:
    """Last row of each of the first ``groups - 1`` equal-frequency groups.

    One row: ``cuts`` (array of structs of ``keys``) and ``n``. Rank r of n falls in
    group max(1, ceil((r-1) * groups / (n-1))), so group j ends at rank
    1 + floor(j * (n-1) / groups). Rows are unique by ``keys``, which are not null.
    """
    ends = lambda n: [1 + j * (n - 1) // groups for j in range(1, groups)]
    n, found = select_ranks(df, list(keys), ends)
    cut = StructType([df.schema[key] for key in keys])
    schema = StructType([StructField("cuts", ArrayType(cut)), StructField("n", LongType())])
    rows = [([found[rank] for rank in ends(n)], n)] if n else []
    return df.sparkSession.createDataFrame(rows, schema)


def group_number(cuts: Column, n: Column, keys: Sequence[str], groups: int = 5) -> Column:
    """Equal-frequency group (1..groups) of a row, given the cuts of its column."""
    above = F.size(F.filter(cuts, lambda cut: cut < F.struct(*keys)))
    return F.when(n == 1, (groups + 1) // 2).otherwise(above + 1).cast("int")
