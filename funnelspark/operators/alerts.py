"""Alert rows (AL-1..AL-5): what would be sent, as data. Delivery is left to whoever reads the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.operators import anomaly, quality

# Alert levels and titles.
INFO, WARNING, CRITICAL = "INFO", "WARNING", "CRITICAL"
FAILURE_TITLE = "🚨 Pipeline Failure"
QUALITY_TITLE = "⚠️ Data Quality Breach"
DURATION_TITLE = "⏱️ Anomalous Pipeline Duration"
RISK_TITLE = "🔴 High Risk Agent: "


def _alert(df: DataFrame, title: Column, message: Column, level: Column, details: dict[str, Column]) -> DataFrame:
    pairs = [x for k, v in details.items() for x in (F.lit(k), v.cast("string"))]
    return df.select(
        title.alias("title"), message.alias("message"), level.alias("level"), F.create_map(*pairs).alias("details")
    )


def _places(c: Column, n: int = 1) -> Column:
    return F.format_string(f"%.{n}f", c.cast("double"))


def failed_runs(runs: DataFrame) -> DataFrame:
    run, seconds, error = F.col("run_id"), F.col("duration_seconds"), F.col("error_message")
    message = F.concat(
        F.lit("Pipeline run `"), run, F.lit("` failed after "), _places(seconds), F.lit("s.\n\nError: "),
        F.coalesce(error, F.lit("")),
    )
    return _alert(
        runs.filter(F.col("status") == "FAILED"), F.lit(FAILURE_TITLE), message, F.lit(CRITICAL),
        {"run_id": run, "error": error, "duration_seconds": seconds, "timestamp": F.col("end_time")},
    )


def quality_breaches(history: DataFrame, threshold: float = quality.PASS_THRESHOLD) -> DataFrame:
    """One alert per run whose composite is under the threshold, with its dimension scores.

    A run has a score per dimension, five at most, so the collected map is bounded.
    """
    below = history.filter(F.col("composite_score") < threshold)
    per_dimension = below.groupBy("run_id", "composite_score", "check_dimension").agg(F.avg("score").alias("score"))
    entry = F.struct("check_dimension", F.round("score", 2).alias("score"))
    runs = per_dimension.groupBy("run_id", "composite_score").agg(
        F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry)))).alias("scores")
    )
    run, score = F.col("run_id"), F.col("composite_score")
    message = F.concat(
        F.lit("Pipeline run `"), run, F.lit("` DQ score: **"), _places(score), F.lit(f"%** (threshold: {threshold}%).\n\n"),
        F.lit("Dimension scores: "), F.col("scores"),
    )
    return _alert(
        runs, F.lit(QUALITY_TITLE), message, F.lit(WARNING),
        {"run_id": run, "dq_score": score, "threshold": F.lit(threshold), "dimension_scores": F.col("scores")},
    )


def slow_runs(runs: DataFrame, baseline: DataFrame, by: list[str]) -> DataFrame:
    run, seconds = F.col("run_id"), F.col("duration_seconds")
    mean, std, z = F.col("mean_duration"), F.col("std_duration"), F.col("z_score")
    message = F.concat(
        F.lit("Pipeline run `"), run, F.lit("` took **"), _places(seconds), F.lit("s** (mean: "), _places(mean),
        F.lit("s, σ: "), _places(std), F.lit("s, Z: "), _places(z), F.lit(")."),
    )
    return _alert(
        anomaly.duration_anomalies(runs, baseline, by), F.lit(DURATION_TITLE), message, F.lit(WARNING),
        {"run_id": run, "duration_seconds": seconds, "mean_duration": mean, "std_duration": std, "z_score": z},
    )


def risky_agents(profiles: DataFrame, levels: list[str] = ("Red",)) -> DataFrame:
    agent, score, level = F.col("agent_id"), F.col("risk_score"), F.col("risk_level")
    message = F.concat(
        F.lit("Agent `"), agent, F.lit("` risk score: **"), score.cast("string"), F.lit("** ("), level, F.lit(").\n\n"),
        F.col("justification"),
    )
    return _alert(
        profiles.filter(level.isin(*levels)), F.concat(F.lit(RISK_TITLE), agent), message,
        F.when(level == "Red", CRITICAL).otherwise(WARNING),
        {"agent_id": agent, "risk_score": score, "risk_level": level},
    )


def all_alerts(*parts: DataFrame) -> DataFrame:
    return quality.union_all(list(parts))
