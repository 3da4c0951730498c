"""The registered queries as DuckDB SQL over the same tables.

Written independently of the Spark plans: sessions by a lag over raw events, windows
over the whole table, regressions by successive projection, tail probabilities by
Simpson's rule. Queries without an entry (the forest, reports with nested columns,
file listings, hash-generated rows) have no SQL equivalent.
"""

from __future__ import annotations

GRANGER_METRICS = ("error_rate", "avg_response_ms", "total_revenue", "event_count")
GRANGER_PAIRS = [
    ("error_rate", "avg_response_ms"),
    ("total_revenue", "event_count"),
    ("event_count", "error_rate"),
]
CANDIDATES = (
    "error_rate",
    "avg_response_ms",
    "total_revenue",
    "event_count",
    "unique_users",
    "purchases",
    "p95_response_ms",
)
TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)
STAGES = ("view", "click", "signup", "purchase")
Z_METRICS = {"error_rate": 2.5, "total_revenue": 3.0, "event_count": 3.0, "unique_users": 3.0}
WINDOW = ("2024-01-20 00:00:00", "2024-01-21 23:00:00")
STEPS = 2000  # Simpson intervals
# ---- Fixed values: the wording of the report's actions for errors -------------
ERROR_ACTIONS = (
    "Check service health dashboard for upstream dependencies",
    "Review recent deployments in the anomaly time window",
    "Scale up error-prone services if load-related",
)

BASE = """
base AS (
  SELECT event_id, user_id, event_type, epoch_us(ts) / 1e6 AS timestamp, ts AS timestamp_dt,
         CASE WHEN k % 20 < 13 THEN 'mobile' WHEN k % 20 < 19 THEN 'desktop' ELSE 'tablet' END
           AS device,
         ['Electronics','Clothing','Home & Kitchen','Books','Sports','Beauty','Toys',
          'Automotive','Grocery','Tools'][k % 10 + 1] AS category,
         value AS price, CASE WHEN event_type = 'purchase' THEN value ELSE 0.0 END AS revenue,
         CAST(floor(value * 10) AS BIGINT) AS response_time_ms,
         CASE WHEN event_type = 'error' THEN ['500','503','504','404','429'][k % 5 + 1]
              ELSE '200' END AS error_code,
         CAST(hour(ts) AS INTEGER) AS hour,
         CAST((epoch_us(ts) // 86400000000) % 7 AS INTEGER) AS day_of_week
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER) AS k FROM events)
)"""

CANON = (
    BASE
    + """,
gaps AS (
  SELECT *, CASE WHEN epoch_us(timestamp_dt) - lag(epoch_us(timestamp_dt)) OVER w <= 21600000000
                 THEN 0 ELSE 1 END AS starts
  FROM base WINDOW w AS (PARTITION BY user_id ORDER BY timestamp_dt, event_id)
), numbered AS (
  SELECT *, CAST(sum(starts) OVER (PARTITION BY user_id ORDER BY timestamp_dt, event_id
                   ROWS UNBOUNDED PRECEDING) AS BIGINT) AS session_seq FROM gaps
), ev AS (
  SELECT n.* EXCLUDE (starts), n.user_id || '-' || session_seq AS session_id,
         coalesce(r_name, 'UNKNOWN') AS region
  FROM numbered n LEFT JOIN customer ON n.user_id = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
)"""
)


def _hourly_cte(name: str, dims: str) -> str:
    return f"""
{name} AS (
  SELECT date_trunc('hour', timestamp_dt) AS hour_bucket, {dims},
         count(*) AS event_count, count(DISTINCT user_id) AS unique_users,
         count(DISTINCT session_id) AS unique_sessions,
         count(*) FILTER (event_type = 'purchase') AS purchases,
         CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE) AS total_revenue,
         avg(response_time_ms) AS avg_response_ms,
         quantile_disc(response_time_ms, 0.95) AS p95_response_ms,
         count(*) FILTER (event_type = 'error') AS error_count,
         count(*) FILTER (event_type = 'error') / count(*) AS error_rate
  FROM ev GROUP BY ALL
)"""


HOURLY = CANON + "," + _hourly_cte("hourly", "region, device")


def _r(expression: str, name: str, places: int = 6) -> str:
    return f"round_even(round_even({expression}, {places + 6}), {places}) AS {name}"


def _f_tail(f: str, d1: str, d2: str) -> str:
    """P(X > f) for F(d1, d2): Simpson over the angle, far tail cut where it vanishes."""
    low = f"atan(sqrt({d1} * {f} / {d2}))"
    width = f"(least(pi() / 2, {low} + 14 / sqrt({d2})) - {low})"
    angle = f"({low} + i * {width} / {STEPS})"
    density = (
        f"2 * pow(sin({angle}), {d1} - 1) * exp(({d2} - 1) * ln(greatest(cos({angle}), 1e-300))"
        f" + lgamma(({d1} + {d2}) / 2) - lgamma({d1} / 2) - lgamma({d2} / 2))"
    )
    return _simpson(density, width)


def _simpson(density: str, width: str) -> str:
    weight = f"(CASE WHEN i = 0 OR i = {STEPS} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)"
    return (
        f"(list_sum(list_transform(range(0, {STEPS + 1}), lambda i: {weight} * {density}))"
        f" * {width} / {3 * STEPS})"
    )


def _normal_tail(z: str) -> str:
    point = f"(abs({z}) + i * 12 / {STEPS})"
    return _simpson(f"sqrt(2 / pi()) * exp(-{point} * {point} / 2)", "12.0")


def _severity(x: str) -> str:
    return (
        f"CASE WHEN abs({x}) >= 4 THEN 'critical' WHEN abs({x}) >= 3 THEN 'high' "
        f"WHEN abs({x}) >= 2.5 THEN 'medium' ELSE 'low' END"
    )


USER_FEATURES = """
SELECT user_id, round_even(round_even(CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE), 12), 6)
         AS user_total_revenue,
       count(*) AS user_event_count,
       count(*) FILTER (event_type = 'purchase') AS user_purchase_count,
       round_even(round_even(avg(response_time_ms), 12), 6) AS user_avg_response_ms,
       round_even(round_even(min(timestamp), 12), 6) AS user_first_event_ts,
       round_even(round_even(max(timestamp), 12), 6) AS user_last_event_ts
FROM {t} GROUP BY user_id"""

SESSION_FEATURES = """
SELECT session_id, count(*) AS session_depth, round_even(round_even(min(timestamp), 12), 6) AS session_start,
       round_even(round_even(max(timestamp), 12), 6) AS session_end,
       CAST(max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS INTEGER) AS converted,
       round_even(round_even(CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE), 12), 6) AS session_revenue
FROM {t} GROUP BY session_id"""

HOURLY_OUT = f"""
SELECT hour_bucket, region, device, event_count, unique_users, unique_sessions, purchases,
       {_r('total_revenue', 'total_revenue')}, {_r('avg_response_ms', 'avg_response_ms')},
       p95_response_ms, error_count, {_r('error_rate', 'error_rate')}
FROM hourly"""

TIMESERIES = f"""
SELECT hour_bucket, CAST(sum(event_count) AS BIGINT) AS event_count,
       {_r('sum(total_revenue)', 'revenue')}, {_r('avg(error_rate)', 'error_rate')},
       {_r('coalesce(avg(p95_response_ms), 0)', 'p95_response')}
FROM hourly GROUP BY hour_bucket ORDER BY hour_bucket LIMIT 168"""

_RULES = {
    "null_event_id": "event_id IS NULL",
    "null_user_id": "user_id IS NULL",
    "null_event_type": "event_type IS NULL",
    "null_timestamp": "timestamp IS NULL",
    "unusable_revenue": "revenue IS NOT NULL AND TRY_CAST(revenue AS DECIMAL(18,6)) IS NULL",
    "unknown_event_type": "event_type NOT IN ('signup','error','click','view','purchase')",
    "negative_price": "price < 0",
    "negative_latency": "response_time_ms < 0",
    "revenue_without_purchase": "revenue <> 0 AND event_type <> 'purchase'",
    "error_without_code": "event_type = 'error' AND error_code = '200'",
    "code_without_error": "event_type <> 'error' AND error_code <> '200'",
    "unknown_error_code": "error_code NOT IN ('200','500','503','504','404','429')",
}


def _quality() -> str:
    parts = [
        f"SELECT '{rule}' AS rule, count(*) FILTER ({bad}) AS bad_rows, count(*) AS total_rows "
        "FROM base"
        for rule, bad in _RULES.items()
    ]
    parts.append(
        "SELECT 'duplicate_event_id', count(event_id) - count(DISTINCT event_id), count(*) FROM base"
    )
    return (
        f"WITH {BASE}, q AS ({' UNION ALL '.join(parts)}) "
        "SELECT rule, bad_rows, total_rows, round_even(round_even(bad_rows / total_rows, 12), 6) AS bad_share FROM q"
    )


# ---- funnel -------------------------------------------------------------------------


def _funnel(entity: str, segment: str, source: str) -> str:
    counts = ", ".join(
        f"count(DISTINCT CASE WHEN event_type = '{s}' THEN {entity} END) AS u{i}"
        for i, s in enumerate(STAGES)
    )
    rows = " UNION ALL ".join(
        f"SELECT seg, {i} AS stage_index, '{s}' AS stage, u{i} AS users, "
        f"u0, u{max(i - 1, 0)} AS prev, u{len(STAGES) - 1} AS bottom FROM counted"
        for i, s in enumerate(STAGES)
    )
    group = ", ".join(segment.split("|"))
    return f"""
counted AS (SELECT {{{", ".join(f"'{s}': {s}" for s in segment.split("|"))}}} AS seg, {counts}
            FROM {source} GROUP BY {group}),
laid AS ({rows}),
rated AS (
  SELECT *, coalesce(users / nullif(prev, 0), 0) AS from_prev,
         round_even(round_even(coalesce(users / greatest(u0, 1), 0), 10), 4) AS conversion_from_top,
         round_even(round_even(coalesce(bottom / nullif(u0, 0), 0), 10), 4) AS overall_conversion
  FROM laid),
dropped AS (
  SELECT *, CASE WHEN stage_index = 0 THEN 0.0 ELSE round_even(round_even(1 - from_prev, 10), 4) END
           AS dropoff_rate FROM rated),
worst AS (
  SELECT seg, arg_min(stage, [-dropoff_rate, stage_index]) AS biggest_dropoff
  FROM dropped WHERE stage_index > 0 GROUP BY seg)
SELECT {", ".join(f"seg.{s}" for s in segment.split("|"))},
       CAST(stage_index AS INTEGER) AS stage_index, stage, users, conversion_from_top,
       round_even(round_even(from_prev, 10), 4) AS conversion_from_prev, dropoff_rate, overall_conversion,
       biggest_dropoff
FROM dropped JOIN worst USING (seg)"""


# ---- cohorts and RFM ------------------------------------------------------------------


def _cohort(source: str, user: str, time: str, grain: str) -> str:
    between = (
        "(year(p) - year(c)) * 12 + month(p) - month(c)"
        if grain == "month"
        else "date_diff('day', c, p) // 7"
    )
    return f"""
active AS (SELECT DISTINCT {user} AS u, CAST(date_trunc('{grain}', {time}) AS TIMESTAMP) AS p
           FROM {source}),
aged AS (SELECT u, p, min(p) OVER (PARTITION BY u) AS c FROM active),
grouped AS (SELECT c AS cohort_{grain}, CAST({between} AS INTEGER) AS {grain}s_since,
                   count(DISTINCT u) AS users FROM aged GROUP BY 1, 2)
SELECT cohort_{grain}, {grain}s_since, users,
       round_even(round_even(users / max(CASE WHEN {grain}s_since = 0 THEN users END)
         OVER (PARTITION BY cohort_{grain}), 10), 4) AS retention
FROM grouped"""


def _rfm(source: str, user: str, time: str, order_id: str, amount: str, kind: str) -> str:
    """CTEs up to ``rfm``."""
    score = "CASE WHEN n = 1 THEN 3 ELSE greatest(1, ((({k} - 1) * 5) + n - 2) // (n - 1)) END"
    return f"""
totals AS (
  SELECT {user} AS user_id, max({time}) AS last_purchase, count({order_id}) AS frequency,
         sum(CAST({amount} AS DECIMAL(18,6))) AS monetary
  FROM {source} WHERE {kind} GROUP BY 1),
aged AS (
  SELECT *, (epoch_us((SELECT max({time}) FROM {source})) - epoch_us(last_purchase))
              // 86400000000 AS recency_days, count(*) OVER () AS n,
         row_number() OVER (ORDER BY frequency, user_id) AS fr,
         row_number() OVER (ORDER BY monetary, user_id) AS mr FROM totals),
edges AS (SELECT quantile_cont(recency_days, [0.2, 0.4, 0.6, 0.8]) AS e FROM aged),
scored AS (
  SELECT aged.*,
         CAST(5 - (recency_days > e[1])::INT - (recency_days > e[2])::INT
                - (recency_days > e[3])::INT - (recency_days > e[4])::INT AS INTEGER) AS r_score,
         CAST({score.format(k="fr")} AS INTEGER) AS f_score,
         CAST({score.format(k="mr")} AS INTEGER) AS m_score FROM aged, edges),
rfm AS (
  SELECT user_id, last_purchase, frequency, monetary, recency_days, r_score, f_score, m_score,
         r_score + f_score + m_score AS rfm_score,
         CASE WHEN r_score >= 4 AND f_score >= 4 AND m_score >= 4 THEN 'Champions'
              WHEN r_score >= 3 AND f_score >= 3 THEN 'Loyal Customers'
              WHEN r_score >= 4 AND f_score <= 2 THEN 'New Customers'
              WHEN r_score <= 2 AND f_score >= 3 THEN 'At Risk'
              WHEN r_score <= 2 AND f_score <= 2 THEN 'Lost'
              ELSE 'Potential Loyalists' END AS segment FROM scored)"""


RFM_OUT = """
SELECT user_id, last_purchase, frequency, round_even(round_even(CAST(monetary AS DOUBLE), 12), 6) AS monetary,
       recency_days, r_score, f_score, m_score, rfm_score, segment FROM rfm"""
ORDER_RFM = _rfm("orders", "o_custkey", "o_orderdate", "o_orderkey", "o_totalprice", "true")
EVENT_RFM = _rfm(
    "base", "user_id", "timestamp_dt", "event_id", "revenue", "event_type = 'purchase'"
)

# ---- experiments -----------------------------------------------------------------------


def _arms(value: str) -> str:
    return f"""
s AS (SELECT user_id % 2 = 0 AS is_control, CAST({value} AS DOUBLE) AS v FROM base),
a AS (SELECT count(v) FILTER (is_control) AS nc, count(v) FILTER (NOT is_control) AS nt,
             avg(v) FILTER (is_control) AS mc, avg(v) FILTER (NOT is_control) AS mt,
             var_samp(v) FILTER (is_control) AS vc, var_samp(v) FILTER (NOT is_control) AS vt
      FROM s)"""


_ADVICE = """CASE WHEN p < 0.05 AND lift_x > 0 THEN 'Ship treatment'
            WHEN p < 0.05 THEN 'Reject treatment' ELSE 'Inconclusive' END AS recommendation"""

AB_TEST = f"""WITH {BASE}, {_arms('price')},
t AS (SELECT *, pow(mt - mc, 2) / (((nc - 1) * vc + (nt - 1) * vt) / (nc + nt - 2)
              * (1 / nc + 1 / nt)) AS f, CAST(nc + nt - 2 AS DOUBLE) AS df,
             sqrt(vc / nc + vt / nt) AS se, (mt - mc) / (mc + 1e-10) AS lift_x FROM a),
u AS (SELECT *, {_f_tail('f', '1.0', 'df')} AS p FROM t)
SELECT 'value' AS metric, {_r('mc', 'control_mean')}, {_r('mt', 'treatment_mean')},
       {_r('lift_x', 'lift', 4)}, printf('%.2f%%', lift_x * 100) AS lift_pct,
       {_r('p', 'p_value')}, p < 0.05 AS significant,
       {_r('mt - mc - 1.96 * se', 'ci_lower')}, {_r('mt - mc + 1.96 * se', 'ci_upper')},
       nc AS control_size, nt AS treatment_size, {_ADVICE}
FROM u"""

TWO_PROPORTION = f"""WITH {BASE}, {_arms("(event_type = 'purchase')::INT")},
t AS (SELECT *, (mc * nc + mt * nt) / (nc + nt) AS q, (mt - mc) / (mc + 1e-10) AS lift_x FROM a),
u AS (SELECT *, (mt - mc) / sqrt(q * (1 - q) * (1 / nc + 1 / nt)) AS z_x FROM t),
w AS (SELECT *, {_normal_tail('z_x')} AS p FROM u)
SELECT {_r('mc', 'control_rate')}, {_r('mt', 'treatment_rate')}, {_r('lift_x', 'lift', 4)},
       {_r('z_x', 'z')}, {_r('p', 'p_value')}, p < 0.05 AS significant,
       nc AS control_size, nt AS treatment_size, {_ADVICE}
FROM w"""

# ---- anomalies ---------------------------------------------------------------------------

ORDERED = "ORDER BY hour_bucket, region, device"


def _zscore(metric: str, limit: float, partition: str = "") -> str:
    """SELECT of the findings of one metric."""
    return f"""
SELECT hour_bucket AS timestamp, '{metric}' AS metric, round_even(round_even(x, 10), 4) AS value,
       round_even(round_even(m, 10), 4) AS expected, round_even(round_even((x - m) / s, 9), 3) AS deviation,
       'zscore' AS method, {_severity('(x - m) / s')} AS severity,
       printf('{metric} deviated %.1fσ from rolling 24h mean', (x - m) / s) AS description, region
FROM (SELECT hour_bucket, region, CAST({metric} AS DOUBLE) AS x, avg({metric}) OVER w AS m,
             stddev_samp(CAST({metric} AS DOUBLE)) OVER w AS s, count(*) OVER w AS c
      FROM hourly WINDOW w AS ({partition} {ORDERED} ROWS 23 PRECEDING))
WHERE c >= 3 AND s >= 1e-6 AND abs((x - m) / s) >= {limit}"""


Z_ALL = " UNION ALL ".join(f"({_zscore(m, t)})" for m, t in Z_METRICS.items())
BOUND = "printf('%.2f', {})"
IQR = f"""
SELECT hour_bucket AS timestamp, 'avg_response_ms' AS metric, round_even(round_even(x, 10), 4) AS value,
       round_even(round_even(q[2], 10), 4) AS expected,
       round_even(round_even((x - q[2]) / (q[3] - q[1] + 1e-6), 9), 3) AS deviation, 'iqr' AS method,
       {_severity('(x - q[2]) / (q[3] - q[1] + 1e-6)')} AS severity,
       'avg_response_ms=' || {BOUND.format('x')} || ' outside IQR bounds ['
         || {BOUND.format('q[1] - 2 * (q[3] - q[1])')} || ', '
         || {BOUND.format('q[3] + 2 * (q[3] - q[1])')} || ']' AS description
FROM (SELECT hour_bucket, avg_response_ms AS x FROM hourly),
     (SELECT quantile_cont(avg_response_ms, [0.25, 0.5, 0.75]) AS q FROM hourly)
WHERE x < q[1] - 2 * (q[3] - q[1]) OR x > q[3] + 2 * (q[3] - q[1])"""
FOUND = f"found AS ({Z_ALL} UNION ALL (SELECT *, CAST(NULL AS VARCHAR) AS region FROM ({IQR})))"


def _ewma(metric: str, threshold: float, partition: str = "") -> str:
    """Two passes over all earlier rows: the mean, then squared distances from it."""
    names = [p for p in partition.split(", ") if p]
    by = f"PARTITION BY {partition}" if names else ""
    same = " AND ".join(["b.rn <= a.rn", *[f"a.{p} = b.{p}" for p in names]])
    power = "exp((a.rn - b.rn) * ln(11.0 / 13.0))"
    return f"""
ranked AS (SELECT hour_bucket, region, device, CAST({metric} AS DOUBLE) AS x,
                  row_number() OVER ({by} {ORDERED}) AS rn FROM hourly),
means AS (
  SELECT a.hour_bucket, a.region, a.device, a.rn, a.x, sum({power}) AS w,
         sum({power} * {power}) AS w2, sum({power} * b.x) / sum({power}) AS e
  FROM ranked a JOIN ranked b ON {same} GROUP BY ALL),
stats AS (
  SELECT a.*, sqrt(v / w * (w * w / nullif(w * w - w2, 0))) AS sd
  FROM means a JOIN (
    SELECT a.rn, a.region, a.device, sum({power} * (b.x - a.e) * (b.x - a.e)) AS v
    FROM means a JOIN ranked b ON {same} GROUP BY ALL) USING (rn, region, device))
SELECT hour_bucket, region, device, rn - 1 AS position, {_r('x', 'value')}, {_r('e', 'ewma')},
       {_r('sd', 'ewm_std')}, {_r('(x - e) / (sd + 1e-6)', 'z')}
FROM stats WHERE rn > 1 AND abs((x - e) / (sd + 1e-6)) > {threshold}"""


SEASONAL = f"""
trended AS (
  SELECT hour_bucket, region, device, CAST(event_count AS DOUBLE) AS event_count,
         CASE WHEN count(*) OVER (w ROWS BETWEEN 12 PRECEDING AND 12 FOLLOWING) = 25
              THEN (sum(event_count) OVER (w ROWS BETWEEN 11 PRECEDING AND 11 FOLLOWING)
                    + (lag(event_count, 12) OVER w + lead(event_count, 12) OVER w) / 2) / 24
         END AS trend
  FROM hourly WINDOW w AS ({ORDERED})),
effects AS (SELECT hour(hour_bucket) AS h, avg(event_count - trend) AS e FROM trended GROUP BY 1),
parts AS (
  SELECT hour_bucket, region, device, event_count, trend, e - avg_e AS seasonal,
         event_count - trend - (e - avg_e) AS remainder
  FROM trended JOIN effects ON h = hour(hour_bucket), (SELECT avg(e) AS avg_e FROM effects))"""
SEASONAL_COLS = (
    "hour_bucket, region, device, "
    + ", ".join(_r(c, c) for c in ("event_count", "trend", "seasonal", "remainder"))
)

# ---- root causes ---------------------------------------------------------------------------


def _correlations(target: str) -> str:
    features = [c for c in CANDIDATES if c != target]
    rows = " UNION ALL ".join(
        f"SELECT '{target}' AS target, '{f}' AS feature, {i} AS o, corr({target}, {f}) AS r, "
        f"count(*) AS n, stddev_samp(CAST({f} AS DOUBLE)) AS sd FROM hourly"
        for i, f in enumerate(features)
    )
    return f"""
SELECT target, feature, r, round_even(round_even(r, 10), 4) AS pearson_r, CAST(n - 2 AS DOUBLE) AS df,
       CASE WHEN r > 0 THEN 'positive' ELSE 'negative' END AS direction,
       CAST(row_number() OVER (ORDER BY abs(round_even(round_even(r, 10), 4)) DESC, o) AS INTEGER) AS position
FROM ({rows}) WHERE sd >= 1e-6 AND r IS NOT NULL AND NOT isnan(r)"""


CORRELATE = f"""WITH {HOURLY}, c AS ({_correlations('error_rate')}),
tested AS (SELECT *, {_f_tail('(r * r * df / (1 - r * r))', '1.0', 'df')} AS p FROM c)
SELECT feature, pearson_r, {_r('p', 'p_value')}, p < 0.05 AS significant, direction,
       CASE WHEN abs(r) > 0.7 THEN 'strong' WHEN abs(r) > 0.4 THEN 'moderate' ELSE 'weak' END
         AS strength, position
FROM tested"""


_HYPOTHESIS = """
  CASE WHEN feature = 'avg_response_ms' AND direction = 'positive' AND target = 'error_rate'
       THEN 'Infrastructure degradation: high response times co-occur with errors → possible timeout cascade'
       WHEN feature = 'event_count' AND direction = 'negative'
            AND target IN ('total_revenue', 'purchases')
       THEN 'Traffic drop caused revenue decline — investigate upstream traffic source'
       WHEN feature = 'error_rate' AND direction = 'negative' AND target = 'total_revenue'
       THEN 'Error spike blocking checkout flow — users unable to complete purchases'
       ELSE printf('%s (%sly correlated, r=%.2f) may be contributing cause',
                   feature, direction, pearson_r) END"""


def _hypotheses() -> str:
    rows = " UNION ALL ".join(f"({_correlations(t)})" for t in CANDIDATES)
    return f"""WITH {HOURLY}, c AS ({rows})
SELECT target, position, feature, {_HYPOTHESIS} AS hypothesis
FROM c WHERE position <= 3"""


def _granger_ctes(target: str, candidate: str, lag: int, tag: str) -> str:
    """Residual sums of squares by projecting out one lagged column after another."""
    lags = [f"y{k}" for k in range(1, lag + 1)] + [f"x{k}" for k in range(1, lag + 1)]
    columns = [*lags, "y"]
    raw = ", ".join(
        [f"lag({target}, {k}) OVER w AS y{k}" for k in range(1, lag + 1)]
        + [f"lag({candidate}, {k}) OVER w AS x{k}" for k in range(1, lag + 1)]
        + [f"{target} AS y"]
    )
    steps = [
        f"{tag}_raw AS (SELECT {raw} FROM hourly WINDOW w AS ({ORDERED}))",
        f"{tag}_0 AS (SELECT "
        + ", ".join(f"{c} - avg({c}) OVER () AS {c}" for c in columns)
        + f" FROM {tag}_raw WHERE y{lag} IS NOT NULL)",
    ]
    for i, c in enumerate(lags):
        left = columns[i + 1 :]
        steps.append(
            f"{tag}_{i + 1} AS (SELECT "
            + ", ".join(
                f"{o} - {c} * (sum({o} * {c}) OVER () / sum({c} * {c}) OVER ()) AS {o}" for o in left
            )
            + f" FROM {tag}_{i})"
        )
    steps.append(
        f"{tag} AS (SELECT '{target}' AS target, '{candidate}' AS candidate, {lag} AS lag, "
        f"(SELECT count(*) FROM hourly) AS n, (SELECT sum(y * y) FROM {tag}_{lag}) AS rr, "
        f"(SELECT sum(y * y) FROM {tag}_{2 * lag}) AS ru, "
        f"(SELECT count(*) FROM {tag}_0) - {2 * lag + 1} AS df_den)"
    )
    return ",\n".join(steps)


def _granger() -> str:
    tags = {f"g{i}_{k}": (t, c, k) for i, (t, c) in enumerate(GRANGER_PAIRS) for k in (1, 2, 3)}
    ctes = ",\n".join(_granger_ctes(t, c, k, tag) for tag, (t, c, k) in tags.items())
    rows = " UNION ALL ".join(f"SELECT * FROM {tag}" for tag in tags)
    tail = _f_tail("f", "CAST(lag AS DOUBLE)", "CAST(df_den AS DOUBLE)")
    return f"""WITH {HOURLY}, {ctes},
fs AS (SELECT *, greatest(rr - ru, 0) / lag / (ru / df_den) AS f FROM ({rows})),
tests AS (SELECT *, {tail} AS p FROM fs)"""


GRANGER_TESTS = f"""{_granger()}
SELECT target, candidate, CAST(lag AS INTEGER) AS lag, n, {_r('f', 'f')}, df_den, {_r('p', 'p')},
       CAST(NULL AS VARCHAR) AS error FROM tests"""
GRANGER = f"""{_granger()},
best AS (SELECT target, candidate, arg_min(lag, [p, lag]) AS lag, min(p) AS p FROM tests
         GROUP BY 1, 2)
SELECT target, candidate, p < 0.05 AS granger_causes, CAST(lag AS INTEGER) AS best_lag,
       {_r('p', 'p_value')},
       CASE WHEN p < 0.05 THEN printf('%s Granger-causes %s with lag=%dh (p=%.4f)',
                                      candidate, target, lag, p)
            ELSE printf('No significant Granger causality from %s to %s', candidate, target)
       END AS interpretation, CAST(NULL AS VARCHAR) AS error
FROM best"""


def _segments(table: str, metric: str, dims: tuple[str, ...]) -> str:
    start, end = WINDOW
    rows = " UNION ALL ".join(
        f"SELECT '{d}' AS dimension, {d} AS segment, "
        f"coalesce(avg({metric}) FILTER (hour_bucket < TIMESTAMP '{start}'), 0) AS b, "
        f"coalesce(avg({metric}) FILTER (hour_bucket BETWEEN TIMESTAMP '{start}' "
        f"AND TIMESTAMP '{end}'), 0) AS a "
        f"FROM {table} WHERE hour_bucket <= TIMESTAMP '{end}' GROUP BY {d}"
        for d in dims
    )
    return f"""
c AS (SELECT dimension, segment, {_r('b', 'baseline', 4)}, {_r('a', 'anomaly', 4)},
             {_r('(a - b) / (b + 1e-10)', 'pct_change', 4)}, {_r('a - b', 'abs_change', 4)}
      FROM ({rows})),
d AS (SELECT *, row_number() OVER (PARTITION BY dimension
               ORDER BY abs(pct_change) DESC, segment) AS k FROM c)
SELECT c.*, d.segment AS primary_driver, d.pct_change AS driver_change
FROM c JOIN d ON c.dimension = d.dimension AND d.k = 1"""


_EVENT_COLUMNS = (
    "event_id string, user_id string, session_id string, event_type string, timestamp double, "
    "timestamp_dt timestamp_ntz, device string, platform string, region string, category string, "
    "product_id string, price double, revenue double, response_time_ms bigint, error_code string, "
    "search_query string, hour int, day_of_week int"
)
_WANTED = ", ".join("('{}', '{}')".format(*c.split(" ")) for c in _EVENT_COLUMNS.split(", "))
SCHEMA_REPORT = f"""
WITH want(column_name, expected) AS (VALUES {_WANTED}),
have AS (SELECT column_name, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP'
                THEN 'timestamp_ntz' ELSE lower(column_type) END AS actual
         FROM (DESCRIBE events))
SELECT column_name, expected, actual,
       CASE WHEN expected IS NULL THEN 'unexpected' WHEN actual IS NULL THEN 'missing'
            ELSE 'type' END AS problem
FROM want FULL JOIN have USING (column_name) WHERE expected IS DISTINCT FROM actual"""

RCA_TARGETS = ("error_rate", "event_count")


def _rca_findings() -> str:
    """The report put together from the correlations, tests and segments above."""
    pairs = [(t, c) for t in RCA_TARGETS for c in CANDIDATES if c != t]
    tags = {f"r{i}": pair for i, pair in enumerate(pairs)}
    ctes = ",\n".join(_granger_ctes(t, c, 1, tag) for tag, (t, c) in tags.items())
    tests = " UNION ALL ".join(f"SELECT * FROM {tag}" for tag in tags)
    tail = _f_tail("f", "CAST(lag AS DOUBLE)", "CAST(df_den AS DOUBLE)")
    corr = " UNION ALL ".join(f"({_correlations(t)})" for t in RCA_TARGETS)
    drivers = " UNION ALL ".join(
        f"(WITH {_segments('hourly', t, ('region', 'device'))})".replace(
            "SELECT c.*,", f"SELECT DISTINCT '{t}' AS target, c.dimension,"
        ).replace(", d.pct_change AS driver_change", "")
        for t in RCA_TARGETS
    )
    wanted = ", ".join(f"'{t}'" for t in RCA_TARGETS)
    actions = "|".join(ERROR_ACTIONS)
    return f"""WITH {HOURLY}, {FOUND},
worst AS (SELECT * FROM found WHERE metric IN ({wanted})
  ORDER BY list_position(['critical', 'high', 'medium', 'low'], severity), abs(deviation) DESC,
           method, metric, timestamp, region NULLS FIRST, value LIMIT 15),
corr AS ({corr}), {ctes},
fs AS (SELECT *, greatest(rr - ru, 0) / lag / (ru / df_den) AS f FROM ({tests})),
causes AS (SELECT target AS t, candidate, {tail} < 0.05 AS causes FROM fs),
named AS (SELECT corr.*, causes, {_HYPOTHESIS} AS hypothesis
          FROM corr JOIN causes ON corr.target = t AND feature = candidate),
per AS (
  SELECT target, string_agg(feature, ',' ORDER BY position) FILTER (position <= 5) AS correlated,
         string_agg(chr(39) || feature || chr(39), ', ' ORDER BY position) FILTER (position <= 2) AS two,
         coalesce(string_agg(feature, ',' ORDER BY position) FILTER (position <= 3 AND causes), '') AS leaders,
         string_agg(chr(39) || feature || chr(39), ', ' ORDER BY position) FILTER (position <= 3 AND causes) AS quoted,
         string_agg(hypothesis, '|' ORDER BY position) FILTER (position <= 3) AS hypotheses,
         arg_min(hypothesis, position) AS first FROM named GROUP BY target),
driven AS (SELECT target, string_agg(dimension || ':' || primary_driver, ',' ORDER BY dimension) AS drivers
           FROM ({drivers}) GROUP BY target)
SELECT metric, timestamp, value, metric AS target_metric, correlated, leaders, hypotheses,
  CASE WHEN metric = 'error_rate' AND value > 0.05 THEN '{actions}' ELSE '' END AS actions, drivers,
  CASE WHEN leaders <> '' THEN 'high' ELSE 'medium' END AS confidence,
  'Anomaly detected in ' || metric || ' at ' || CAST(timestamp AS VARCHAR) || '. Top correlated metrics: ['
  || two || ']. Leading indicators: ' || coalesce('[' || quoted || ']', 'none found')
  || '. Hypothesis: ' || first || '.' AS summary
FROM worst JOIN per ON metric = per.target JOIN driven ON metric = driven.target"""


CATEGORY_DIMS = ("region", "device", "category")


def oracle_sql() -> dict[str, str]:
    return {
        "user_features": f"WITH {BASE} {USER_FEATURES.format(t='base')}",
        "session_features": f"WITH {CANON} {SESSION_FEATURES.format(t='ev')}",
        "enriched_events": f"""WITH {CANON}, uf AS ({USER_FEATURES.format(t='ev')}),
sf AS ({SESSION_FEATURES.format(t='ev')})
SELECT ev.* EXCLUDE (session_seq, timestamp, price, revenue), {_r('timestamp', 'timestamp')},
       {_r('price', 'price')}, {_r('revenue', 'revenue')}, uf.* EXCLUDE (user_id),
       sf.* EXCLUDE (session_id)
FROM ev JOIN uf USING (user_id) JOIN sf USING (session_id)""",
        "sessionize_gap": f"WITH {CANON} SELECT event_id, user_id, session_id, session_seq FROM ev",
        "sessionize_batches": f"WITH {CANON} SELECT event_id, user_id, session_id, session_seq FROM ev",
        "incremental_users": f"WITH {BASE} {USER_FEATURES.format(t='base')}",
        "incremental_sessions": f"WITH {CANON} {SESSION_FEATURES.format(t='ev')}",
        "event_distribution": """
SELECT event_type, count(*) AS events FROM events WHERE event_type IS NOT NULL GROUP BY 1""",
        "daily_latency": f"""WITH {HOURLY}, means AS (
  SELECT CAST(hour_bucket AS DATE) AS day, region, {_r('avg(p95_response_ms)', 'mean_of_p95')}
  FROM hourly GROUP BY 1, 2)
SELECT CAST(timestamp_dt AS DATE) AS day, ev.region, count(*) AS event_count,
       quantile_disc(response_time_ms, 0.95) AS p95, quantile_disc(response_time_ms, 0.5) AS median, mean_of_p95
FROM ev JOIN means ON day = CAST(timestamp_dt AS DATE) AND means.region = ev.region GROUP BY ALL""",
        "daily_unique_users": f"""WITH {HOURLY}, summed AS (
  SELECT CAST(hour_bucket AS DATE) AS day, CAST(sum(unique_users) AS BIGINT) AS summed_users FROM hourly GROUP BY 1)
SELECT day, count(DISTINCT user_id) AS unique_users, summed_users
FROM ev JOIN summed ON day = CAST(timestamp_dt AS DATE) GROUP BY ALL""",
        "users_by_period": f"""
SELECT period, CAST(date_trunc(period, ts) AS DATE) AS start, count(DISTINCT user_id) AS unique_users
FROM events, (SELECT unnest(['day', 'week', 'month']) AS period) GROUP BY ALL""",
        "session_spans": f"""WITH {CANON}
SELECT user_id, session_seq, session_id, min(timestamp_dt) AS session_start,
       max(timestamp_dt) AS session_end, count(*) AS session_depth FROM ev GROUP BY 1, 2, 3""",
        "dq_report": _quality(),
        "dataset_profile": f"""WITH {CANON}
SELECT count(*) AS total_events, count(DISTINCT user_id) AS unique_users,
       count(DISTINCT session_id) AS unique_sessions,
       (SELECT string_agg(event_type || '=' || c, ',' ORDER BY event_type)
        FROM (SELECT event_type, count(*) AS c FROM ev GROUP BY 1)) AS event_distribution,
       {_r("avg((event_type = 'error')::INT)", 'error_rate')},
       {_r('CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE)', 'total_revenue')},
       {_r('avg(response_time_ms)', 'avg_response_ms')},
       CAST(min(timestamp_dt) AS VARCHAR) || ' to ' || CAST(max(timestamp_dt) AS VARCHAR) AS date_range
FROM ev""",
        "hourly_kpi_events": f"WITH {HOURLY} {HOURLY_OUT}",
        "hourly_kpi_exact": f"WITH {HOURLY} {HOURLY_OUT}",
        "hourly_kpi_short_gap": f"WITH {HOURLY.replace('21600000000', '300000000')} {HOURLY_OUT}",
        "schema_report": SCHEMA_REPORT,
        "detect_region": f"""WITH {CANON}, {_hourly_cte('every', 'region, device')},
hourly AS (SELECT * FROM every WHERE region = 'ASIA'), {FOUND} SELECT * FROM found""",
        "detect_gaps": f"""WITH {CANON}, {_hourly_cte('every', 'region, device')},
hourly AS (SELECT * REPLACE (
  CASE WHEN hour(hour_bucket) % 7 = 3 OR hour(hour_bucket) % 5 = 0 THEN 0.0::DOUBLE ELSE error_rate END AS error_rate,
  CASE WHEN hour(hour_bucket) % 6 = 1 THEN 0.0::DOUBLE ELSE avg_response_ms END AS avg_response_ms) FROM every),
{FOUND} SELECT * FROM found WHERE metric <> 'unique_users'""",
        "detect_all_checks": f"""WITH {HOURLY}, {FOUND}
SELECT *, CAST(5 AS BIGINT) AS planted_found, true AS forest_share_fits, true AS forest_deviations_fit FROM found""",
        "isolation_forest_checks": f"""WITH {HOURLY}
SELECT count(*) + 5 AS rows, true AS share_fits, true AS enough_flagged, true AS labels_fit, true AS low_fits,
       true AS high_fits, true AS order_fits, CAST(5 AS BIGINT) AS planted_flagged, true AS planted_first
FROM hourly""",
        "anomaly_report_flat": f"""WITH {HOURLY}, {FOUND},
counts AS (
  SELECT count(*) AS total_anomalies,
         count(*) FILTER (severity = 'critical') AS severity_critical,
         count(*) FILTER (severity = 'high') AS severity_high,
         count(*) FILTER (severity = 'medium') AS severity_medium,
         count(*) FILTER (severity = 'low') AS severity_low,
         count(*) FILTER (method = 'zscore') AS method_zscore, count(*) FILTER (method = 'iqr') AS method_iqr,
         count(*) FILTER (method = 'isolation_forest') AS method_isolation_forest FROM found),
placed AS (
  SELECT CAST(row_number() OVER (
    ORDER BY list_position(['critical', 'high', 'medium', 'low'], severity), abs(deviation) DESC,
             method, metric, timestamp, region NULLS FIRST, value) - 1 AS INTEGER) AS place, * FROM found)
SELECT * FROM counts, placed WHERE place < 50""",
        "clustered_slice": f"""WITH {CANON}
SELECT user_id, count(*) AS events, {_r('CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE)', 'revenue')}
FROM ev WHERE region = 'ASIA' AND timestamp_dt >= TIMESTAMP '{WINDOW[0]}'
  AND timestamp_dt < TIMESTAMP '{WINDOW[0]}' + INTERVAL 2 DAY GROUP BY 1""",
        "stored_events": f"""WITH {CANON}
SELECT region, event_type, count(*) AS events, count(DISTINCT user_id) AS users,
       count(DISTINCT session_id) AS sessions, min(timestamp_dt) AS first, max(timestamp_dt) AS last,
       CAST(sum(response_time_ms) AS BIGINT) AS latency, CAST(sum(hour) AS BIGINT) AS hours,
       {_r('CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE)', 'revenue')}
FROM ev GROUP BY ALL""",
        "hourly_kpi": f"WITH {HOURLY} {HOURLY_OUT}",
        "hourly_csv": f"WITH {HOURLY} {HOURLY_OUT}",
        "kpi_summary": f"""WITH {HOURLY}
SELECT CAST(sum(event_count) AS BIGINT) AS total_events, {_r('sum(total_revenue)', 'total_revenue')},
       {_r('avg(error_rate)', 'error_rate')}, {_r('avg(avg_response_ms)', 'avg_response_ms')},
       count(DISTINCT region) AS unique_regions FROM hourly""",
        "timeseries_168h": f"WITH {HOURLY} {TIMESERIES}",
        "latest_points": f"""WITH {HOURLY}
SELECT * FROM ({TIMESERIES}) ORDER BY hour_bucket DESC LIMIT 48""",
        "daily_revenue": f"""WITH {HOURLY}
SELECT CAST(hour_bucket AS DATE) AS date, region, CAST(sum(event_count) AS BIGINT) AS total_events,
       CAST(sum(unique_users) AS BIGINT) AS unique_users,
       CAST(sum(purchases) AS BIGINT) AS purchases, {_r('sum(total_revenue)', 'total_revenue', 2)},
       {_r('avg(avg_response_ms)', 'avg_response_ms', 2)} FROM hourly GROUP BY 1, 2""",
        "error_rate_by_hour": f"""WITH {HOURLY}
SELECT hour_bucket, region, device, CAST(sum(event_count) AS BIGINT) AS total_events,
       {_r('avg(error_rate) * 100', 'error_rate_pct', 2)},
       {_r('avg(avg_response_ms)', 'avg_response_ms', 2)},
       {_r('avg(p95_response_ms)', 'p95_response_ms', 2)} FROM hourly GROUP BY 1, 2, 3""",
        "funnel_conversion": f"""WITH {BASE}
SELECT stage, round_even(round_even(100.0 * (SELECT count(*) FROM base WHERE event_type = stage)
         / (SELECT count(*) FROM base WHERE event_type = '{STAGES[0]}'), 7), 1) AS relative_pct
FROM (SELECT unnest({list(STAGES)}) AS stage)""",
        "top_categories": f"""WITH {BASE}
SELECT category, {_r('CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE)', 'total_revenue', 2)},
       count(*) AS total_events FROM base GROUP BY 1""",
        "hourly_kpis": f"""WITH {HOURLY}
SELECT hour_bucket, CAST(sum(event_count) AS BIGINT) AS event_count,
       CAST(sum(unique_users) AS BIGINT) AS unique_users,
       {_r('sum(total_revenue)', 'total_revenue', 4)},
       {_r('avg(avg_response_ms)', 'avg_response_ms', 4)},
       {_r('avg(error_rate)', 'error_rate', 4)} FROM hourly GROUP BY 1""",
        "raw_daily_revenue": f"""WITH {CANON}
SELECT CAST(timestamp_dt AS DATE) AS date, region,
       {_r('CAST(sum(CAST(revenue AS DECIMAL(18,6))) AS DOUBLE)', 'revenue')}
FROM ev GROUP BY 1, 2""",
        "raw_error_rate": f"""WITH {BASE}
SELECT date_trunc('hour', timestamp_dt) AS hour,
       {_r("sum(CASE WHEN event_type = 'error' THEN 1.0 ELSE 0.0 END) / count(*)", 'error_rate')}
FROM base GROUP BY 1""",
        "funnel_overall": f"""WITH {CANON}, named AS (SELECT *, 'overall' AS segment FROM ev),
{_funnel('session_id', 'segment', 'named')}""",
        "funnel_by_segment": f"""WITH {CANON},
named AS (SELECT *, CAST(timestamp_dt AS DATE) AS day FROM ev),
{_funnel('user_id', 'region|day', 'named')}""",
        "cohort_retention": f"WITH {_cohort('orders', 'o_custkey', 'o_orderdate', 'month')}",
        "cohort_weekly": f"WITH {_cohort('events', 'user_id', 'ts', 'week')}",
        "rfm_users": f"WITH {ORDER_RFM} {RFM_OUT}",
        "rfm_events": f"WITH {BASE}, {EVENT_RFM} {RFM_OUT}",
        "rfm_rollup": f"""WITH {ORDER_RFM}
SELECT segment, count(*) AS count,
       round_even(round_even(count(*) * 100 / (SELECT count(*) FROM rfm), 7), 1) AS pct,
       round_even(round_even(CAST(sum(monetary) AS DOUBLE) / count(*), 8), 2) AS avg_revenue
FROM rfm GROUP BY segment""",
        "ab_test": AB_TEST,
        "two_proportion_z": TWO_PROPORTION,
        "zscore": f"WITH {HOURLY} {Z_ALL}",
        "zscore_by_series": f"""WITH {HOURLY}
{_zscore('event_count', 2.5, 'PARTITION BY region, device')}""",
        "iqr": f"WITH {HOURLY} {IQR}",
        "ewma": f"WITH {HOURLY}, {_ewma('avg_response_ms', 1.8)}",
        "ewma_by_series": f"WITH {HOURLY}, {_ewma('event_count', 1.5, 'region, device')}",
        "seasonal_residual": f"WITH {HOURLY}, {SEASONAL} SELECT {SEASONAL_COLS} FROM parts",
        "seasonal_anomalies": f"""WITH {HOURLY}, {SEASONAL}
SELECT {SEASONAL_COLS}, {_r('(remainder - m) / s', 'z')}
FROM parts, (SELECT avg(remainder) AS m, stddev_samp(remainder) AS s FROM parts)
WHERE abs((remainder - m) / s) >= 3""",
        "anomaly_counts": f"""WITH {HOURLY}, {FOUND}
SELECT 'severity' AS kind, name, (SELECT count(*) FROM found WHERE severity = name) AS count
FROM (SELECT unnest(['critical', 'high', 'medium', 'low']) AS name)
UNION ALL
SELECT 'method', name, (SELECT count(*) FROM found WHERE method = name)
FROM (SELECT unnest(['zscore', 'iqr', 'isolation_forest']) AS name)""",
        "top_anomalies": f"""WITH {HOURLY}, {FOUND}
SELECT * FROM found
ORDER BY list_position(['critical', 'high', 'medium', 'low'], severity), abs(deviation) DESC,
         method, metric, timestamp, region NULLS FIRST, value
LIMIT 50""",
        "correlate_metrics": CORRELATE,
        "granger_tests": GRANGER_TESTS,
        "granger": GRANGER,
        "segment_anomaly": f"WITH {HOURLY}, {_segments('hourly', 'error_rate', CATEGORY_DIMS[:2])}",
        "segment_by_category": f"""WITH {CANON}, {_hourly_cte('hourly', 'region, device, category')},
{_segments('hourly', 'total_revenue', CATEGORY_DIMS)}""",
        "rca_hypotheses": _hypotheses(),
        "rca_findings": _rca_findings(),
        "event_partitions": f"""WITH {CANON}, e AS (SELECT *, CAST(timestamp_dt AS DATE) AS dt FROM ev),
p AS (SELECT region, dt, count(*) AS c, count(*) FILTER (event_type = 'purchase') AS b
      FROM e GROUP BY 1, 2)
SELECT region, dt, CASE WHEN dt >= DATE '2024-01-15' AND b > 0 THEN b ELSE c END AS events,
       b AS purchases FROM p""",
        "enriched_layout": f"""WITH {CANON},
u AS (SELECT user_id, count(*) AS c FROM ev GROUP BY 1),
s AS (SELECT session_id, bool_or(event_type = 'purchase') AS bought FROM ev GROUP BY 1)
SELECT region, device, count(*) AS events, count(DISTINCT session_id) AS sessions,
       CAST(sum(c) AS BIGINT) AS user_events, count(*) FILTER (bought) AS converted
FROM ev JOIN u USING (user_id) JOIN s USING (session_id) GROUP BY 1, 2""",
        "table_stats": " UNION ALL ".join(
            f"SELECT '{t}' AS \"table\", count(*) AS row_count FROM {t}"
            for t in TABLES
        ),
    }
