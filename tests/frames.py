"""Input frames for the tests: a daily rhythm, gaps, ties, and a spike of our choice."""

from __future__ import annotations

import numpy as np
import pandas as pd

REGIONS = ("north", "south", "islands")
SPIKE = {"row": 61, "error_rate": 0.6, "avg_response_ms": 5_400.0}


def hourly_frame(n: int = 100, spike: bool = True) -> pd.DataFrame:
    """One KPI row per hour. Load follows the hour of the day, revenue the load."""
    rng = np.random.default_rng(20)
    hour = np.arange(n)
    load = 900 + 500 * np.sin(2 * np.pi * hour / 24) + rng.normal(0, 40, n)
    events = np.maximum(load, 50).round().astype("int64")
    errors = rng.poisson(events * 0.02)
    frame = pd.DataFrame(
        {
            "hour_bucket": pd.Timestamp("2023-06-05") + pd.to_timedelta(hour, unit="h"),
            "region": np.array(REGIONS, dtype=object)[(hour * 5 + hour // 7) % 3],
            "device": np.where(hour % 5 < 3, "phone", "pad"),
            "event_count": events,
            "unique_users": (events * 0.6).astype("int64"),
            "unique_sessions": (events * 0.7).astype("int64"),
            "purchases": rng.binomial(events, 0.05),
            "total_revenue": (events * rng.gamma(20, 0.1, n)).round(2),
            "avg_response_ms": 180 + 0.05 * load + rng.normal(0, 12, n),
            "p95_response_ms": (500 + 0.2 * load).astype("int64"),
            "error_count": errors,
            "error_rate": errors / events,
        }
    )
    if spike and n > SPIKE["row"]:
        frame.loc[SPIKE["row"], ["error_rate", "avg_response_ms"]] = SPIKE["error_rate"], SPIKE["avg_response_ms"]
    return frame


def event_frame(n: int = 5000, users: int = 500) -> pd.DataFrame:
    """Events of users that walk down the funnel, with errors and tied times."""
    rng = np.random.default_rng(21)
    steps = ["page_view", "search", "product_view", "add_to_cart", "checkout_start", "purchase"]
    depth = np.minimum(rng.geometric(0.45, n) - 1, 5)
    kinds = np.where(rng.random(n) < 0.05, "error", np.array(steps, dtype=object)[depth])
    user = rng.integers(0, users, n)
    seconds = np.sort(rng.integers(0, 90 * 1440, n)) * 60.0 + 1_685_923_200  # ties to the minute
    price = rng.gamma(2.0, 15.0, n).round(2)
    return pd.DataFrame(
        {
            "event_id": [f"e-{i:06d}" for i in range(n)],
            "user_id": [f"user{u}" for u in user],
            "session_id": [f"visit{u}-{int(s) // 14_400}" for u, s in zip(user, seconds)],
            "event_type": kinds,
            "timestamp": seconds,
            "timestamp_dt": pd.to_datetime(seconds, unit="s"),
            "region": np.array(REGIONS, dtype=object)[user % 3],
            "device": np.where(user % 4 == 0, "pad", "phone"),
            "category": np.array(["Books", "Toys", "Tools", "Beauty"], dtype=object)[rng.integers(0, 4, n)],
            "price": price,
            "revenue": np.where(kinds == "purchase", price, 0.0),
            "response_time_ms": rng.poisson(240, n).astype("int64"),
            "error_code": np.where(kinds == "error", "503", "200"),
        }
    )


def to_spark(spark, frame: pd.DataFrame, ntz: tuple[str, ...] = ("hour_bucket", "timestamp_dt")):
    if frame.empty:  # a schema cannot be inferred from no rows
        blank = {c: ("x" if t == object else 0) for c, t in frame.dtypes.items()}
        return to_spark(spark, pd.DataFrame([blank]).astype(frame.dtypes), ntz).where("false")
    df = spark.createDataFrame(frame)
    return df.withColumns({c: df[c].cast("timestamp_ntz") for c in ntz if c in frame.columns})
