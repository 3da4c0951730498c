"""Exponentially weighted means and deviations as an associative scan.

The state of a run of rows is the sum of its weights, that of their squares, the weighted
mean, and the weighted sum of squared deviations from it, all seen from the run's last row.
Two runs merge: the earlier one loses a factor per row of the later, and means and deviations
combine around their common mean, so large levels lose no digits. A series is cut into
chunks; states of chunks are scanned within blocks of chunks, and blocks within the series,
which gives every chunk the state that all rows before it leave. Each chunk then goes over its
own rows once. No row is borrowed or repeated, and no weight is cut off.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.materialize import materialize
from pulsetrail.operators.ordering import CHUNK, RANK

# Rows of a chunk, and chunks of a block.
CHUNK_ROWS = 1_000
BLOCK_CHUNKS = 1_000
_BLOCK = "_block"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)``, with the value computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _state(weight: Column, squares: Column, mean: Column, spread: Column) -> Column:
    return F.struct(
        weight.alias("weight"), squares.alias("squares"), mean.alias("mean"), spread.alias("spread")
    )


def _nothing() -> Column:
    return _state(*[F.lit(0.0)] * 4)


def merge_states(earlier: Column, later: Column, rows: Column, keep: float) -> Column:
    """State of two runs in a row; the later one is ``rows`` long. A row keeps ``keep`` of a weight."""

    def merged(decay: Column) -> Column:
        old = earlier["weight"] * decay
        total = old + later["weight"]
        apart = later["mean"] - earlier["mean"]
        return F.when(
            total > 0,
            _state(
                total,
                earlier["squares"] * decay * decay + later["squares"],
                earlier["mean"] + apart * (later["weight"] / total),
                earlier["spread"] * decay + later["spread"] + apart * apart * (old * later["weight"] / total),
            ),
        ).otherwise(_nothing())

    return _let(F.pow(F.lit(keep), rows.cast("double")), merged)


def _next(state: Column, value: Column, keep: float) -> Column:
    """State after one more row; a null ages the rows before it."""
    return F.when(
        value.isNotNull(),
        merge_states(state, _state(F.lit(1.0), F.lit(1.0), value, F.lit(0.0)), F.lit(1), keep),
    ).otherwise(
        _state(state["weight"] * keep, state["squares"] * keep * keep, state["mean"], state["spread"] * keep)
    )


def deviation(state: Column) -> Column:
    """Unbiased weighted standard deviation; null where one value holds all the weight."""
    square = state["weight"] * state["weight"]
    free = square - state["squares"]
    return F.when(free > 0, F.sqrt(state["spread"] / state["weight"] * (square / free)))


def _scan(runs: Column, number: str, keep: float) -> Column:
    """Of runs (number, rows, state) in order: ``list`` of (number, before, carry), and the whole.

    ``carry`` is the state that the runs before leave, ``before`` their number of rows.
    """
    entry = lambda acc, run: F.struct(
        run[number].alias(number), acc["rows"].alias("before"), acc["state"].alias("carry")
    )
    blank = F.filter(
        F.transform(
            runs, lambda run: F.struct(run[number].alias(number), F.lit(0).cast("long").alias("before"), _nothing().alias("carry"))
        ),
        lambda _: F.lit(False),
    )
    start = F.struct(blank.alias("list"), F.lit(0).cast("long").alias("rows"), _nothing().alias("state"))
    return F.aggregate(
        runs,
        start,
        lambda acc, run: F.struct(
            F.concat(acc["list"], F.array(entry(acc, run))).alias("list"),
            (acc["rows"] + run["rows"]).alias("rows"),
            merge_states(acc["state"], run["state"], run["rows"], keep).alias("state"),
        ),
    )


def _same(series: Sequence[str], *numbers: str) -> Column:
    same = F.lit(True)
    for name in (*series, *numbers):
        same = same & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    return same


def _carries(chunks: DataFrame, series: Sequence[str], keep: float, block_chunks: int) -> DataFrame:
    """(series, chunk, carry): the state before each chunk."""
    listed = F.sort_array(F.collect_list(F.struct(CHUNK, "rows", "state")))
    blocks = materialize(
        chunks.select(*series, CHUNK, F.size("_rows").cast("long").alias("rows"), F.col("_end").alias("state"))
        .groupBy(*series, F.floor(F.col(CHUNK) / block_chunks).alias(_BLOCK))
        .agg(listed.alias("runs"))
        .select(*series, _BLOCK, _scan(F.col("runs"), CHUNK, keep).alias("scan"))
    )
    tops = F.sort_array(F.collect_list(F.struct(_BLOCK, F.col("scan.rows").alias("rows"), F.col("scan.state").alias("state"))))
    before = (
        blocks.groupBy(*series)
        .agg(tops.alias("runs"))
        .select(*series, F.explode(_scan(F.col("runs"), _BLOCK, keep)["list"]).alias("top"))
        .select(*series, f"top.{_BLOCK}", F.col("top.carry").alias("top"))
    )
    inner = blocks.select(*series, _BLOCK, F.explode("scan.list").alias("own")).select(*series, _BLOCK, "own.*")
    carry = merge_states(F.col("b.top"), F.col("a.carry"), F.col("a.before"), keep)
    return inner.alias("a").join(before.alias("b"), _same(series, _BLOCK)).select(
        *[f"a.{name}" for name in (*series, CHUNK)], carry.alias("carry")
    )


def exponential_hits(
    ranked: DataFrame,
    value: str,
    keep: float,
    threshold: float,
    tiny: float,
    series: Sequence[str] = (),
    rank: str = RANK,
    chunk_rows: int = CHUNK_ROWS,
    block_chunks: int = BLOCK_CHUNKS,
) -> DataFrame:
    """Rows further than ``threshold`` deviations from the weighted mean that includes them.

    ``ranked`` has ranks in the order of the series and the rows within. Adds ``ewma``,
    ``ewm_std`` and ``z`` = (value - ewma) / (ewm_std + tiny).
    """
    others = [name for name in ranked.columns if name not in series]
    row = F.struct(F.col(rank).alias("at"), F.col(value).alias("x"), F.struct(*others).alias("row"))
    step = lambda state, r: _next(state, r["x"], keep)
    chunks = materialize(
        ranked.groupBy(*series, F.floor((F.col(rank) - 1) / chunk_rows).alias(CHUNK))
        .agg(F.sort_array(F.collect_list(row)).alias("_rows"))
        .withColumn("_end", F.aggregate("_rows", _nothing(), step))
    )
    hit = lambda r, mean, sd, z: F.struct(
        r["row"].alias("row"), mean.alias("ewma"), sd.alias("ewm_std"), z.alias("z")
    )
    none = F.lit(0.0)
    blank = F.filter(F.transform("_rows", lambda r: hit(r, none, none, none)), lambda _: F.lit(False))

    def look(acc: Column, r: Column) -> Column:
        def judged(state: Column) -> Column:
            def with_z(found: Column) -> Column:
                far = F.abs(found["z"]) > threshold
                more = F.when(far, F.array(hit(r, state["mean"], found["sd"], found["z"]))).otherwise(F.col("_blank"))
                return F.struct(state.alias("state"), more.alias("hits"))

            sd = deviation(state)
            z = (r["x"] - state["mean"]) / (sd + tiny)
            return _let(F.struct(sd.alias("sd"), z.alias("z")), with_z)

        new = _let(_next(acc["state"], r["x"], keep), judged)
        return _let(
            new,
            lambda n: F.struct(n["state"].alias("state"), F.concat(acc["hits"], n["hits"]).alias("hits")),
        )

    carried = chunks.alias("a").join(_carries(chunks, series, keep, block_chunks).alias("b"), _same(series, CHUNK))
    scanned = carried.select(
        *[f"a.{name}" for name in series], F.col("a._rows").alias("_rows"), F.col("b.carry").alias("carry")
    ).withColumn("_blank", blank)
    found = F.aggregate(
        "_rows", F.struct(F.col("carry").alias("state"), F.col("_blank").alias("hits")), look, lambda acc: acc["hits"]
    )
    return scanned.select(*series, F.explode(found).alias("hit")).select(
        *series, "hit.row.*", "hit.ewma", "hit.ewm_std", "hit.z"
    )
