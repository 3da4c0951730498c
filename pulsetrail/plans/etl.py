"""The batch job: raw events in, enriched lake, feature tables and hourly KPIs out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pulsetrail.operators.features import enrich_events, session_features, user_features
from pulsetrail.operators.kpis import KPI_KEYS, hourly_kpis
from pulsetrail.operators.quality import quality_report, validate_schema
from pulsetrail.sources.lake import read_events, read_table, write_enriched, write_report, write_table


REQUIRED = ("event_id", "user_id", "session_id", "event_type", "timestamp")


@dataclass(frozen=True)
class EtlOutput:
    """Scans of what the job wrote."""

    events: DataFrame
    users: DataFrame
    sessions: DataFrame
    hourly: DataFrame
    quality: DataFrame
    schema: DataFrame


def run_etl(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    check_quality: bool = True,
    approximate_distinct: bool = False,
) -> EtlOutput:
    """Schema and quality reports, feature tables, enriched events, hourly KPIs.

    The schema report compares the files as they are with the event schema; a table that
    lacks what the KPIs are made of is refused.

    The feature tables are written before the join reads them: they are results in
    their own right, and their row counts then steer the skew handling. Hourly KPIs
    come from the raw scan, because they need none of the joined columns.
    """
    root = output_path.rstrip("/")
    problems = validate_schema(spark.read.parquet(input_path))
    missing = {r.column_name for r in problems.where("problem = 'missing'").collect()}
    if missing & set(REQUIRED):
        raise ValueError(f"the event table lacks {sorted(missing & set(REQUIRED))}")
    write_report(problems, f"{root}/schema")
    events = read_events(spark, input_path)
    if check_quality:
        write_report(quality_report(events), f"{root}/quality")
    users = read_table(spark, write_table(user_features(events), f"{root}/user_features"))
    sessions = read_table(spark, write_table(session_features(events), f"{root}/session_features"))
    write_enriched(enrich_events(events, users, sessions), f"{root}/events")
    hourly = hourly_kpis(events, approximate_distinct=approximate_distinct).orderBy(*KPI_KEYS)
    write_table(hourly, f"{root}/hourly")
    return EtlOutput(
        events=read_table(spark, f"{root}/events"),
        users=users,
        sessions=sessions,
        hourly=read_table(spark, f"{root}/hourly"),
        quality=spark.read.json(f"{root}/quality") if check_quality else None,
        schema=problems,
    )
