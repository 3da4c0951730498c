"""A/B tests: pooled t-test and two-proportion z-test, one result row each."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pulsetrail.functions.scalar import fixed, rounded
from pulsetrail.functions.tails import f_sf, normal_two_sided

Z_95 = 1.96
EPSILON = 1e-10


def _arm(label: str, variant_col: str, value_col: str, prefix: str) -> list[Column]:
    value = F.when(F.col(variant_col) == label, F.col(value_col).cast("double"))
    return [
        F.count(value).alias(f"_n_{prefix}"),
        F.avg(value).alias(f"_mean_{prefix}"),
        F.var_samp(value).alias(f"_var_{prefix}"),
    ]


def _recommend(p: Column, lift: Column, alpha: float) -> Column:
    return (
        F.when((p < alpha) & (lift > 0), "Ship treatment")
        .when(p < alpha, "Reject treatment")
        .otherwise("Inconclusive")
    )


def ab_test_analysis(
    samples: DataFrame,
    variant_col: str = "variant",
    value_col: str = "value",
    control: str = "control",
    treatment: str = "treatment",
    metric_name: str = "conversion_rate",
    alpha: float = 0.05,
) -> DataFrame:
    """Compare two variants by a pooled two-sample t-test.

    Null values are left out of the sample sizes. The test pools the variances; the
    interval uses each arm's own and always 1.96. Without any variance the test is
    decided by the means: equal is undefined, different is certain.
    """
    arms = samples.agg(
        *_arm(control, variant_col, value_col, "c"), *_arm(treatment, variant_col, value_col, "t")
    )
    c = {k: F.col(f"_{k}_c") for k in ("n", "mean", "var")}
    t = {k: F.col(f"_{k}_t") for k in ("n", "mean", "var")}
    diff = t["mean"] - c["mean"]
    df = c["n"] + t["n"] - 2
    # An arm of one row has no variance of its own and adds nothing to the pool.
    spread = [F.coalesce(a["var"], F.lit(0.0)) * (a["n"] - 1) for a in (c, t)]
    pooled = F.try_divide(spread[0] + spread[1], df)
    scale = pooled * (F.try_divide(F.lit(1.0), c["n"]) + F.try_divide(F.lit(1.0), t["n"]))
    t_squared = F.when((scale == 0) & (diff != 0), F.lit(math.inf)).otherwise(
        F.try_divide(diff * diff, scale)
    )
    se = F.sqrt(F.try_divide(c["var"], c["n"]) + F.try_divide(t["var"], t["n"]))
    lift, p = F.col("_lift"), F.col("_p")
    return (
        arms.withColumns({"_lift": diff / (c["mean"] + EPSILON), "_diff": diff, "_se": se})
        .withColumn("_p", f_sf(t_squared, F.lit(1), df))
        .select(
            F.lit(metric_name).alias("metric"),
            rounded(c["mean"], 6).alias("control_mean"),
            rounded(t["mean"], 6).alias("treatment_mean"),
            rounded(lift, 4).alias("lift"),
            F.concat(fixed(lift * 100, 2), F.lit("%")).alias("lift_pct"),
            rounded(p, 6).alias("p_value"),
            F.coalesce(p < alpha, F.lit(False)).alias("significant"),
            rounded(F.col("_diff") - Z_95 * F.col("_se"), 6).alias("ci_lower"),
            rounded(F.col("_diff") + Z_95 * F.col("_se"), 6).alias("ci_upper"),
            c["n"].alias("control_size"),
            t["n"].alias("treatment_size"),
            _recommend(p, lift, alpha).alias("recommendation"),
        )
    )


def two_proportion_z(
    samples: DataFrame,
    variant_col: str = "variant",
    success_col: str = "value",
    control: str = "control",
    treatment: str = "treatment",
    alpha: float = 0.05,
) -> DataFrame:
    """Compare two conversion rates with the pooled z-test. Successes are 0 or 1."""
    arms = samples.agg(
        *_arm(control, variant_col, success_col, "c"),
        *_arm(treatment, variant_col, success_col, "t"),
    )
    n_c, n_t = F.col("_n_c"), F.col("_n_t")
    p_c, p_t = F.col("_mean_c"), F.col("_mean_t")
    pooled = F.try_divide(p_c * n_c + p_t * n_t, n_c + n_t)
    se = F.sqrt(
        pooled
        * (1 - pooled)
        * (F.try_divide(F.lit(1.0), n_c) + F.try_divide(F.lit(1.0), n_t))
    )
    z, p, lift = F.col("_z"), F.col("_p"), F.col("_lift")
    return (
        arms.withColumns({"_z": F.try_divide(p_t - p_c, se), "_lift": (p_t - p_c) / (p_c + EPSILON)})
        .withColumn("_p", normal_two_sided(z))
        .select(
            rounded(p_c, 6).alias("control_rate"),
            rounded(p_t, 6).alias("treatment_rate"),
            rounded(lift, 4).alias("lift"),
            rounded(z, 6).alias("z"),
            rounded(p, 6).alias("p_value"),
            F.coalesce(p < alpha, F.lit(False)).alias("significant"),
            n_c.alias("control_size"),
            n_t.alias("treatment_size"),
            _recommend(p, lift, alpha).alias("recommendation"),
        )
    )
