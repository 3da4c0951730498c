"""Reading and writing tables by URI. The scheme of the path picks the store."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pulsetrail.functions.scalar import epoch_to_ts, rounded
from pulsetrail.schemas import EVENTS, HOURLY


def as_events(stored: DataFrame, schema: StructType = EVENTS) -> DataFrame:
    """An event table in whatever widths it was stored, as the schema has it.

    Columns are cast, and missing ones are null, except ``timestamp_dt``: writers that
    keep epoch seconds only leave it out, and it follows from them.
    """
    have = set(stored.columns)

    def column(field) -> Column:
        kind = field.dataType.simpleString()
        if field.name in have:
            return F.col(field.name).cast(kind).alias(field.name)
        if field.name == "timestamp_dt" and "timestamp" in have:
            return epoch_to_ts(F.col("timestamp")).alias(field.name)
        return F.lit(None).cast(kind).alias(field.name)

    return stored.select(*[column(field) for field in schema])


def read_events(spark: SparkSession, path: str) -> DataFrame:
    """Scan a partitioned event table, with the columns and types of ``EVENTS``.

    The files' own schema is read, so tables with other widths or without a derived
    column load as well.
    """
    return as_events(spark.read.parquet(path))


def write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], mode: str = "overwrite"
) -> None:
    """Write one directory per value of ``by``.

    The rebalance hint gathers each directory's rows into few files and, because it
    is allowed to split, cuts a directory that holds a third of the data into many
    tasks of the advisory partition size.
    """
    df.hint("rebalance", *by).write.mode(mode).partitionBy(*by).parquet(path)


def write_events_by_region(events: DataFrame, path: str) -> None:
    write_partitioned(events, path, ["region"])


def write_enriched(enriched: DataFrame, path: str) -> None:
    write_partitioned(enriched, path, ["region", "device"])


def replace_partitions(
    df: DataFrame, path: str, date_from: str = "timestamp_dt", by: Sequence[str] = ("region", "dt")
) -> None:
    """Replace only the region/dt partitions present in ``df``; others stay."""
    if "dt" in by and "dt" not in df.columns:
        df = df.withColumn("dt", F.to_date(date_from))
    (
        df.hint("rebalance", *by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


def replace_event_partition(df: DataFrame, path: str, region: str, date: str) -> None:
    """Replace the single partition (region, date) by ``df``."""
    labelled = df.withColumns({"region": F.lit(region), "dt": F.lit(date).cast("date")})
    replace_partitions(labelled, path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).parquet(path)
    return path


def read_table(spark: SparkSession, path: str, schema: StructType | None = None) -> DataFrame:
    return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)


def write_report(report: DataFrame, path: str) -> str:
    """Write a report as JSON lines, nested columns included."""
    report.write.mode("overwrite").json(path)
    return path


def write_hourly_csv(hourly: DataFrame, path: str) -> str:
    """Export the KPI table as CSV with a header, one file per task."""
    hourly.write.mode("overwrite").option("header", True).csv(path)
    return path


def read_hourly_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read the CSV export with its real types instead of guessing them."""
    return spark.read.schema(HOURLY).option("header", True).csv(path)


def _files(spark: SparkSession, path: str) -> DataFrame:
    """Path and length of every file; the contents are never read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(path)
        .select("path", "length")
    )


def list_partitions(spark: SparkSession, prefix: str) -> DataFrame:
    """All object paths below a prefix."""
    return _files(spark, prefix).select("path")


def storage_metrics(spark: SparkSession, path: str) -> DataFrame:
    """Object count and size in megabytes below a path, as one row."""
    return _files(spark, path).agg(
        F.count(F.lit(1)).alias("total_objects"),
        rounded(F.coalesce(F.sum("length"), F.lit(0)) / 1e6, 2).alias("total_size_mb"),
    )


def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table. No column is read."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for other in counts[1:]:
        out = out.unionByName(other)
    return out
