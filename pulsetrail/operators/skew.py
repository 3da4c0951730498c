"""Left join that stays balanced when single keys hold a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# A key with more rows than this is spread over several tasks: some 100 MB of events.
ROWS_PER_TASK = 1_000_000
# The list of such keys is broadcast, so it is held to this many whatever the data size.
HOT_KEYS = 100_000
# Rows without a key match nothing; they are spread over this many places.
NULL_SALTS = 4_096


def shuffle_partitions(df: DataFrame) -> int:
    return max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def attach_by_key(
    rows: DataFrame,
    features: DataFrame,
    keys: Sequence[str],
    weight: str,
    spread_by: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """Left join ``features`` (one row per key) to ``rows`` without hot tasks.

    ``weight`` is the feature column with the number of rows its key has, so hot keys
    are known before the join. A key with more than ``rows_per_task`` rows is spread over
    enough salts to bring each under that number. The weights add up to the rows, so
    there are at most total / limit such keys; the limit rises where that would be more
    than ``HOT_KEYS``. Rows with a null in a key cannot match and are spread by a hash of
    their own, as equal nulls would meet in one task.

    AQE splits large partitions of a join only between plain shuffles and only above
    its size limits; here the split is part of the plan. ``features`` is read up to
    three times, so pass a written table or a ``materialize``d frame.
    """
    keys = list(keys)
    total, largest = features.agg(F.sum(weight), F.max(weight)).first()
    limit = max(rows_per_task, (total or 0) // HOT_KEYS)
    no_salt = F.lit(0).cast("bigint")
    missing = reduce(or_, [F.col(key).isNull() for key in keys])
    loose = F.pmod(F.xxhash64(*spread_by), F.lit(NULL_SALTS).cast("bigint"))
    if not total or largest <= limit:
        salted_rows = rows.withColumn("_salt", F.when(missing, loose).otherwise(no_salt))
        salted_features = features.withColumn("_salt", no_salt)
    else:
        fan = F.ceil(F.col(weight) / limit)
        hot = features.where(F.col(weight) > limit).select(*keys, fan.alias("_fan"))
        salt = F.coalesce(F.pmod(F.xxhash64(*spread_by), F.col("_fan")), no_salt)
        salted_rows = (
            rows.join(F.broadcast(hot), keys, "left")
            .withColumn("_salt", F.when(missing, loose).otherwise(salt))
            .drop("_fan")
        )
        salted_features = features.withColumn(
            "_salt", F.explode(F.sequence(no_salt, F.greatest(fan, F.lit(1)) - 1))
        )
    return salted_rows.join(salted_features, [*keys, "_salt"], "left").drop("_salt")
