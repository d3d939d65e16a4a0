"""Anomaly scores over daily series (AN-1..AN-7).

Input is long: one row per (series keys, metric, day). A trailing frame gives every day its score, not only the last.
A series holds at most one row per calendar day, so no window partition grows with the event volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds of both tests and the history a score needs.
Z_WARNING, Z_CRITICAL = 2.0, 3.0
IQR_WARNING, IQR_CRITICAL = 1.5, 3.0
MIN_BASELINE = 5
BASELINE_WINDOW = 14

# Standard deviations below this are rounding noise of a constant baseline.
ZERO_STD = 1e-12

# Comparisons happen on values rounded to this many places: the last bits of a mean depend on the order of
# summation, and a flag must not.
PLACES = 9


def _flag(value: Column, warning: float, critical: float) -> Column:
    return F.when(value >= critical, 2).when(value >= warning, 1).otherwise(0)


def _r(c: Column) -> Column:
    return F.round(c, PLACES)


def score_series(
    series: DataFrame,
    keys: list[str],
    day: str = "date_key",
    value: str = "value",
    drops_only: Column | None = None,
    baseline_window: int = BASELINE_WINDOW,
) -> DataFrame:
    """Score every point against up to ``baseline_window`` points before it.

    Two-sided by default: |z| and interquartile fences. Where ``drops_only`` holds, only z of a fall below the mean
    counts, and the reported bounds are the quartiles. Fewer than six points in all: score 0.
    """
    drops_only = F.lit(False) if drops_only is None else drops_only
    ordered = Window.partitionBy(*keys).orderBy(day)
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    # A window too short to be meaningful falls back to all earlier points.
    frame = before if baseline_window < MIN_BASELINE else ordered.rowsBetween(-baseline_window, -1)

    x, mean, std = F.col("current_value"), F.col("_mean"), F.col("_std")
    based = series.select("*", F.col(value).cast("double").alias("current_value")).select(
        "*",
        F.count(F.lit(1)).over(before).alias("_prior"),
        F.count(F.lit(1)).over(frame).alias("_n"),
        F.avg(x).over(frame).alias("_mean"),
        F.stddev_samp(x).over(frame).alias("_std"),
        F.percentile(x, F.array(F.lit(0.25), F.lit(0.75))).over(frame).alias("_q"),
        F.lead(day).over(ordered).isNull().alias("is_latest"),
        drops_only.alias("_drop"),
    )
    enough = F.col("_prior") >= MIN_BASELINE
    std0 = F.when(F.col("_std") < ZERO_STD, 0.0).otherwise(F.col("_std"))
    distance = F.when(F.col("_drop"), F.greatest(mean - x, F.lit(0.0))).otherwise(F.abs(x - mean))
    z = F.when(std > 0, distance / std).otherwise(0.0)
    q1, q3 = F.col("_q")[0], F.col("_q")[1]

    def beyond(width: float) -> Column:
        return (_r(x) < _r(q1 - width * (q3 - q1))) | (_r(x) > _r(q3 + width * (q3 - q1)))

    z_flag = _flag(_r(F.col("_z")), Z_WARNING, Z_CRITICAL)
    iqr_flag = F.when(F.col("_drop"), 0).when(beyond(IQR_CRITICAL), 2).when(beyond(IQR_WARNING), 1).otherwise(0)
    flagged = (
        based.withColumn("_std", std0).withColumn("_z", z)
        .withColumns({"_zf": F.when(enough, z_flag).otherwise(0), "_if": F.when(enough, iqr_flag).otherwise(0)})
    )
    zf, iqf = F.col("_zf"), F.col("_if")
    method = (
        F.when((zf > 0) & F.col("_drop"), "z_score_one_sided")
        .when((zf > 0) & (iqf > 0), "both").when(zf > 0, "z_score").when(iqf > 0, "iqr").otherwise("none")
    )

    def known(c: Column) -> Column:
        return F.when(enough, c).otherwise(0.0)

    fence = F.when(F.col("_drop"), 0.0).otherwise(IQR_WARNING * (q3 - q1))
    results = {
        "data_points": F.col("_prior") + 1,
        "baseline_points": F.when(enough, F.col("_n")).otherwise(0),
        "baseline_mean": known(mean),
        "baseline_std": known(std),
        "z_score": known(F.col("_z")),
        "iqr_lower": known(q1 - fence),
        "iqr_upper": known(q3 + fence),
        "z_flag": zf,
        "iqr_flag": iqf,
        "anomaly_score": F.greatest(zf, iqf),
        "method_triggered": method,
        "reason": F.when(~enough, "insufficient_baseline_data"),
    }
    kept = [c for c in series.columns if c != value]
    return flagged.select(*kept, "current_value", *[c.alias(n) for n, c in results.items()], "is_latest")


def ghost_rate(accepted: Column, replied: Column) -> Column:
    """Share of accepted connections that never replied; 0 on days without acceptances."""
    ghosts = accepted - F.least(replied, accepted)
    return F.coalesce(F.try_divide(ghosts.cast("double"), accepted.cast("double")), F.lit(0.0))


def duration_baseline(runs: DataFrame, by: list[str]) -> DataFrame:
    """Mean and deviation of run durations per pipeline."""
    return runs.groupBy(*by).agg(
        F.avg("duration_seconds").alias("mean_duration"), F.stddev_samp("duration_seconds").alias("std_duration")
    )


def duration_anomalies(runs: DataFrame, baseline: DataFrame, by: list[str], threshold: float = Z_WARNING) -> DataFrame:
    """Runs that took longer than ``threshold`` deviations above the mean."""
    z = F.when(F.col("std_duration") > ZERO_STD,
               (F.col("duration_seconds") - F.col("mean_duration")) / F.col("std_duration")).otherwise(0.0)
    return runs.join(baseline, by).withColumn("z_score", z).filter(_r(F.col("z_score")) > threshold)
