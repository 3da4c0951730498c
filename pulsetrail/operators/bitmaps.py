"""Exact distinct users of any period, from one table of daily bitmaps.

Users are numbered densely, once: new users get the numbers after the known ones. A day
then is a set of bitmaps, one per range of 32,768 numbers in use. Days merge into weeks and
months by a bitwise or, and the count of bits is the exact number of users. The table has
one row per day and range, of 4 KB at most, however many events there were.

Rows without a user or time count for nothing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsetrail.operators.ordering import RANK, global_rank

NUMBER = "number"


def number_users(events: DataFrame, known: DataFrame | None = None, user_col: str = "user_id") -> DataFrame:
    """(user, number): every user once, numbers from 0 without gaps.

    ``known`` is such a table from an earlier run; its numbers stay as they are.
    """
    users = events.where(F.col(user_col).isNotNull()).select(user_col).distinct()
    if known is None:
        return global_rank(users, [user_col]).select(user_col, (F.col(RANK) - 1).alias(NUMBER))
    new = global_rank(users.join(known, user_col, "left_anti"), [user_col])
    first = known.agg(F.coalesce(F.max(NUMBER), F.lit(-1))).scalar()
    return known.select(user_col, NUMBER).unionByName(
        new.select(user_col, (F.col(RANK) + first).alias(NUMBER))
    )


def daily_bitmaps(
    events: DataFrame, numbers: DataFrame, user_col: str = "user_id", time_col: str = "timestamp_dt"
) -> DataFrame:
    """(day, bucket, users): the users of every day as bitmaps.

    Events are reduced to distinct (day, user) before they meet the numbers, so a user
    with a third of all events is one row per day and task.
    """
    seen = (
        events.where(F.col(user_col).isNotNull() & F.col(time_col).isNotNull())
        .select(F.to_date(time_col).alias("day"), user_col)
        .distinct()
    )
    return (
        seen.join(numbers, user_col)
        .groupBy("day", F.bitmap_bucket_number(NUMBER).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("users"))
    )


def users_by_period(bitmaps: DataFrame, period: str) -> DataFrame:
    """(period, start, unique_users) for 'day', 'week' (from Monday), 'month' or longer."""
    start = F.date_trunc(period, F.col("day")).cast("date")
    whole = bitmaps.groupBy(start.alias("start"), "bucket").agg(F.bitmap_or_agg("users").alias("users"))
    return whole.groupBy("start").agg(F.sum(F.bitmap_count("users")).alias("unique_users")).select(
        F.lit(period).alias("period"), "start", "unique_users"
    )
