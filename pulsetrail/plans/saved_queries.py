"""Named queries as Spark SQL over the ``hourly`` and ``events`` tables.

Anything else is plain ``spark.sql``. ``unique_users`` of the daily query adds up
hourly distinct counts, so a user active in several hours counts several times;
``error_rate`` of the hourly query is a plain mean over KPI rows, while the raw query
weights by events.
"""

from __future__ import annotations

import time
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from pulsetrail.schemas import FUNNEL_STAGES

def _round(expression: str, places: int) -> str:
    """Half-to-even rounding as in ``functions.scalar.rounded``."""
    fine = f"RINT(({expression}) * 1e{places + 6}D) / 1e{places + 6}D"
    return f"RINT({fine} * 1e{places}D) / 1e{places}D"


_RELATIVE = (
    "COALESCE(TRY_DIVIDE(100.0D * COALESCE(counted.events, 0), (SELECT events FROM top)), 0)"
)

DAILY_REVENUE = f"""
SELECT CAST(hour_bucket AS DATE) AS date, region,
       SUM(event_count) AS total_events, SUM(unique_users) AS unique_users,
       SUM(purchases) AS purchases, {_round('SUM(total_revenue)', 2)} AS total_revenue,
       {_round('AVG(avg_response_ms)', 2)} AS avg_response_ms
FROM {{hourly}}
WHERE hour_bucket IS NOT NULL AND region IS NOT NULL
GROUP BY 1, 2
ORDER BY date, region
"""

ERROR_RATE_BY_HOUR = f"""
SELECT hour_bucket, region, device, SUM(event_count) AS total_events,
       {_round('AVG(error_rate) * 100', 2)} AS error_rate_pct,
       {_round('AVG(avg_response_ms)', 2)} AS avg_response_ms,
       {_round('AVG(p95_response_ms)', 2)} AS p95_response_ms
FROM {{hourly}}
WHERE hour_bucket IS NOT NULL AND region IS NOT NULL AND device IS NOT NULL
GROUP BY hour_bucket, region, device
ORDER BY error_rate_pct DESC, hour_bucket, region, device
"""

FUNNEL_CONVERSION = f"""
WITH counted AS (
  SELECT event_type, COUNT(*) AS events FROM {{events}}
  WHERE event_type IN ({{stage_list}}) GROUP BY event_type
), top AS (SELECT MAX(events) AS events FROM counted WHERE event_type = {{top_stage}})
SELECT stage, {_round(_RELATIVE, 1)}
         AS relative_pct
FROM (SELECT POSEXPLODE(ARRAY({{stage_list}})) AS (at, stage))
LEFT JOIN counted ON counted.event_type = stage
ORDER BY at
"""

TOP_CATEGORIES = f"""
SELECT category, {_round('CAST(SUM(TRY_CAST(revenue AS DECIMAL(18, 6))) AS DOUBLE)', 2)} AS total_revenue,
       COUNT(*) AS total_events
FROM {{events}}
WHERE category IS NOT NULL
GROUP BY category
ORDER BY total_revenue DESC, category
"""

HOURLY_KPIS = f"""
SELECT hour_bucket, SUM(event_count) AS event_count, SUM(unique_users) AS unique_users,
       {_round('SUM(total_revenue)', 4)} AS total_revenue,
       {_round('AVG(avg_response_ms)', 4)} AS avg_response_ms,
       {_round('AVG(error_rate)', 4)} AS error_rate
FROM {{hourly}}
WHERE hour_bucket IS NOT NULL
GROUP BY hour_bucket
ORDER BY hour_bucket
"""

RAW_DAILY_REVENUE = f"""
SELECT CAST(DATE_TRUNC('DAY', timestamp_dt) AS DATE) AS date, region,
       CAST(SUM(TRY_CAST(revenue AS DECIMAL(18, 6))) AS DOUBLE) AS revenue
FROM {{events}} GROUP BY 1, 2 ORDER BY date, region
"""

RAW_ERROR_RATE = f"""
SELECT CAST(DATE_TRUNC('HOUR', timestamp_dt) AS TIMESTAMP_NTZ) AS hour,
       SUM(CASE WHEN event_type = 'error' THEN 1.0D ELSE 0.0D END) / COUNT(*) AS error_rate
FROM {{events}} GROUP BY 1 ORDER BY hour
"""

# name -> (description, tables it reads, SQL)
SAVED_QUERIES: dict[str, tuple[str, tuple[str, ...], str]] = {
    "daily_revenue": ("Revenue, users and events per day and region", ("hourly",), DAILY_REVENUE),
    "error_rate_by_hour": (
        "Error rate and latency per hour, region and device, worst first",
        ("hourly",),
        ERROR_RATE_BY_HOUR,
    ),
    "funnel_conversion": (
        "Events per funnel stage relative to the first stage",
        ("events",),
        FUNNEL_CONVERSION,
    ),
    "top_categories": ("Product categories by revenue", ("events",), TOP_CATEGORIES),
    "hourly_kpis": ("Events, users, revenue, latency and errors per hour", ("hourly",), HOURLY_KPIS),
    "raw_daily_revenue": ("Revenue per day and region from events", ("events",), RAW_DAILY_REVENUE),
    "raw_error_rate": ("Event-weighted error rate per hour", ("events",), RAW_ERROR_RATE),
}


def descriptions() -> dict[str, str]:
    return {name: text for name, (text, _, _) in SAVED_QUERIES.items()}


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def run_saved_query(
    spark: SparkSession,
    name: str,
    tables: Mapping[str, DataFrame],
    stages: tuple[str, ...] = FUNNEL_STAGES,
) -> DataFrame:
    """Run a named query over ``tables`` (``hourly`` and/or ``events``)."""
    if name not in SAVED_QUERIES:
        raise ValueError(f"Unknown query: {name}")
    _, needs, sql = SAVED_QUERIES[name]
    missing = [t for t in needs if t not in tables]
    if missing:
        raise RuntimeError(f"No data loaded for {missing}: run the ETL first")
    sql = sql.replace("{stage_list}", ", ".join(map(_literal, stages)))
    sql = sql.replace("{top_stage}", _literal(stages[0]))
    return spark.sql(sql, **{t: tables[t] for t in needs})


def query_payload(result: DataFrame, rows: int = 50) -> dict:
    """Column names, the first ``rows`` rows and the time it took to get them."""
    started = time.perf_counter()
    page = [row.asDict(recursive=True) for row in result.limit(rows).collect()]
    return {
        "columns": result.columns,
        "rows": page,
        "elapsed_ms": round((time.perf_counter() - started) * 1000, 1),
    }
