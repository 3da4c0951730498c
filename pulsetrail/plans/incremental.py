"""User and session features kept up to date by day, without reading old events.

A store is a folder. A run takes new day partitions of the event table, reads these alone,
reduces each to partial states per key (counts, exact sums, first and last time) and merges
them with the totals of the last version by key. It writes

    days/table=<name>/dt=<day>/      partial states of each day
    totals/table=<name>/v=<n>/       totals over all days so far
    ledger/v=<n>/                    the days in version n, with their number of events

The ledger is written last, and readers take the newest version in it: a run that dies leaves
the version before it in place, and can be repeated. A day that is in the ledger is skipped, so
running it again changes nothing. A day whose events have changed is corrected with
``replace=True``: its partial states are written anew and the totals rebuilt from the
partial states of all days, still without reading other days' events.

Defined cases: events without a key are one group, as in the feature tables; no new day, or
only empty ones, leaves the version as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import MONEY, is_event
from pulsetrail.sources.lake import read_table

DAY = "dt"
_LEDGER = "dt date, events long"
KEYS = {"users": "user_id", "sessions": "session_id"}


def _partial(events: DataFrame, key: str) -> DataFrame:
    """States per day and key. They add up, or take the least or greatest."""
    return events.groupBy(DAY, key).agg(
        F.sum(F.col("revenue").try_cast(MONEY)).alias("revenue"),
        F.count(F.lit(1)).alias("events"),
        F.count_if(is_event("purchase")).alias("purchases"),
        F.sum(F.col("response_time_ms").cast("decimal(20,0)")).alias("latency"),
        F.count("response_time_ms").alias("timed"),
        F.min("timestamp").alias("first"),
        F.max("timestamp").alias("last"),
    )


def _merge(states: DataFrame, key: str) -> DataFrame:
    merged = {"revenue": F.sum, "events": F.sum, "purchases": F.sum, "latency": F.sum, "timed": F.sum}
    kinds = {"revenue": "decimal(38,6)", "latency": "decimal(38,0)"}

    def state(name: str, how) -> Column:
        column = how(name)
        return (column.cast(kinds[name]) if name in kinds else column).alias(name)

    return states.groupBy(key).agg(
        *[state(name, how) for name, how in merged.items()],
        F.min("first").alias("first"),
        F.max("last").alias("last"),
    )


class FeatureStore:
    """Totals per user and session under ``root``, one version per run."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _ledgers(self) -> DataFrame | None:
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/ledger")
        files = path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        if not files.exists(path):
            return None
        return self.spark.read.schema(f"{_LEDGER}, v int").parquet(f"{self.root}/ledger")

    def version(self) -> int:
        """The newest version; 0 before the first run."""
        ledgers = self._ledgers()
        return (ledgers.agg(F.max("v")).first()[0] or 0) if ledgers is not None else 0

    def days(self) -> DataFrame:
        """The days in the newest version: dt, events."""
        ledgers, version = self._ledgers(), self.version()
        if not version:
            return self.spark.createDataFrame([], _LEDGER)
        return ledgers.where(F.col("v") == version).select("dt", "events")

    def add(self, events: DataFrame, days: Sequence[str], replace: bool = False) -> list[str]:
        """Merge day partitions of ``events`` (column ``dt``); returns the days that were new.

        Only these partitions are read. With ``replace`` known days are corrected.
        """
        ledger = self.days()
        known = {str(row["dt"]) for row in ledger.where(F.col("dt").isin(*days)).collect()} if days else set()
        wanted = [day for day in days if replace or day not in known]
        if not wanted:
            return []
        new = events.where(F.col(DAY).isin(*[F.lit(day).cast("date") for day in wanted]))
        version = self.version() + 1
        for table, key in KEYS.items():
            path = f"{self.root}/days/table={table}"
            partial = _partial(new, key)
            # Overwrites the days at hand and no other, so a repeated run adds nothing.
            partial.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
                DAY
            ).parquet(path)
        counted = self._partial_days("sessions", wanted).groupBy("dt").agg(F.sum("events").alias("events"))
        after = ledger.where(~F.col("dt").isin(*[F.lit(day).cast("date") for day in wanted])).unionByName(
            counted.select("dt", "events")
        )
        corrected = known & set(wanted)
        for table, key in KEYS.items():
            if corrected:
                # Days may have lost keys, which a merge cannot take back.
                states = self._partial_days(table, [str(row["dt"]) for row in after.select("dt").collect()])
            else:
                states = self._partial_days(table, wanted)
                if version > 1:
                    states = self._states(table, version - 1).unionByName(states, allowMissingColumns=True)
            _merge(states, key).write.mode("overwrite").parquet(self._totals(table, version))
        after.write.mode("overwrite").parquet(f"{self.root}/ledger/v={version}")
        return wanted

    def _totals(self, table: str, version: int) -> str:
        return f"{self.root}/totals/table={table}/v={version}"

    def _states(self, table: str, version: int) -> DataFrame:
        return read_table(self.spark, self._totals(table, version))

    def _partial_days(self, table: str, days: Sequence[str]) -> DataFrame:
        stored = read_table(self.spark, f"{self.root}/days/table={table}")
        return stored.where(F.col(DAY).isin(*[F.lit(day).cast("date") for day in days]))

    def user_features(self) -> DataFrame:
        """As ``features.user_features`` over all days so far."""
        return self._states("users", self.version()).select(
            "user_id",
            F.col("revenue").cast("double").alias("user_total_revenue"),
            F.col("events").alias("user_event_count"),
            F.col("purchases").alias("user_purchase_count"),
            F.try_divide(F.col("latency").cast("double"), F.col("timed")).alias("user_avg_response_ms"),
            F.col("first").alias("user_first_event_ts"),
            F.col("last").alias("user_last_event_ts"),
        )

    def session_features(self) -> DataFrame:
        """As ``features.session_features`` over all days so far."""
        return self._states("sessions", self.version()).select(
            "session_id",
            F.col("events").alias("session_depth"),
            F.col("first").alias("session_start"),
            F.col("last").alias("session_end"),
            F.when(F.col("purchases") > 0, 1).otherwise(0).alias("converted"),
            F.col("revenue").cast("double").alias("session_revenue"),
        )
