"""Weighted account risk and capacity advice (RK-1..RK-9)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.functions import numbers
from funnelspark.operators import anomaly, dims
from funnelspark.operators.joins import lookup

# Metric, weight in the score; the order is the order of triggers in texts.
METRIC_WEIGHTS = {
    "acceptance_rate": 0.30,
    "reply_rate": 0.25,
    "ghosting_rate": 0.20,
    "utilisation": 0.15,
    "activity_volume": 0.10,
}
# Metrics where only a fall is bad.
DROP_METRICS = ["acceptance_rate", "reply_rate"]
MIN_DAYS = 6
AMBER_ABOVE, RED_ABOVE = 30, 60


def metric_series(activity: DataFrame, agent: str = "agent_key") -> DataFrame:
    """Wide activity → long (agent, metric, day, value); days without a value are left out of their metric."""
    columns = activity.columns
    utilisation = F.col("utilisation_pct") if "utilisation_pct" in columns else F.lit(None)
    metrics = {
        "acceptance_rate": F.col("acceptance_rate"),
        "reply_rate": F.col("reply_rate"),
        "ghosting_rate": anomaly.ghost_rate(F.col("invites_accepted"), F.col("replies_received")),
        "utilisation": utilisation,
        "activity_volume": F.col("invites_sent"),
    }
    pairs = F.array(*[
        F.struct(F.lit(name).alias("metric"), c.cast("double").alias("value")) for name, c in metrics.items()
    ])
    return activity.select(agent, "date_key", F.inline(pairs)).filter("value IS NOT NULL")


def score_metrics(activity: DataFrame, agent: str = "agent_key", baseline_window: int = anomaly.BASELINE_WINDOW) -> DataFrame:
    """Every metric point with its anomaly score.

    One exchange by agent serves the per-metric windows and the per-agent roll-up after them.
    """
    series = metric_series(activity, agent).repartition(agent)
    return anomaly.score_series(
        series, [agent, "metric"], drops_only=F.col("metric").isin(*DROP_METRICS), baseline_window=baseline_window
    )


def risk_level(score: Column) -> Column:
    return F.when(score <= AMBER_ABOVE, "Green").when(score <= RED_ABOVE, "Amber").otherwise("Red")


def agent_risk(scored: DataFrame, agent: str = "agent_key") -> DataFrame:
    """Latest score of every metric → weighted risk per agent. A metric an agent lacks adds nothing."""
    latest = scored.filter("is_latest")
    score, metric = F.col("anomaly_score"), F.col("metric")
    points = {name: F.max(F.when(metric == name, score)) for name in METRIC_WEIGHTS}
    per_agent = latest.groupBy(agent).agg(
        *[c.alias(f"score_{name}") for name, c in points.items()],
        F.max(F.when(metric == "activity_volume", F.col("data_points"))).alias("days"),
    )
    total = sum((F.coalesce(F.col(f"score_{n}"), F.lit(0)) * (50 * w) for n, w in METRIC_WEIGHTS.items()), F.lit(0.0))
    return per_agent.withColumn(
        "risk_score", F.when(F.col("days") < MIN_DAYS, 0.0).otherwise(F.least(F.round(total, 1), F.lit(100.0)))
    )


def _triggers(at_least: int) -> Column:
    named = [F.when(F.col(f"score_{name}") >= at_least, F.lit(name)) for name in METRIC_WEIGHTS]
    return F.concat_ws(", ", *named)


def recommend(profiles: DataFrame) -> DataFrame:
    """Level, recommended caps and the reason in words."""
    enough = F.coalesce(F.col("days"), F.lit(0)) >= MIN_DAYS
    profiles = profiles.withColumn("risk_score", F.coalesce(F.col("risk_score"), F.lit(0.0))).withColumn(
        "risk_level", risk_level(F.col("risk_score"))
    )
    level, invites, messages = F.col("risk_level"), F.col("daily_invite_limit"), F.col("daily_message_limit")
    factor = F.when(level == "Amber", 0.8).when(level == "Red", 0.5)
    keep = ~enough | (level == "Green")

    def scaled(cap: Column) -> Column:
        return F.floor(cap * factor).cast("int")

    advised = profiles.withColumns(
        {
            "recommended_daily_invites": F.when(keep, invites).when(invites.isNotNull(), scaled(invites)),
            "recommended_daily_messages": F.when(~enough, messages).when(
                invites.isNotNull(),
                F.when(level == "Green", messages).otherwise(scaled(F.coalesce(messages, F.lit(0)))),
            ),
        }
    )
    shown = F.col("risk_score").cast("string")
    caps = F.concat(
        F.coalesce(F.col("recommended_daily_invites").cast("string"), F.lit("None")), F.lit(" invites, "),
        F.coalesce(F.col("recommended_daily_messages").cast("string"), F.lit("None")), F.lit(" messages/day."),
    )
    # The wording of each verdict.
    reason = (
        F.when(~enough, "Insufficient historical data for risk assessment (< 6 days).")
        .when(invites.isNull(), "No tier assigned — cannot compute recommendation.")
        .when(level == "Green", F.concat(F.lit("Low risk ("), shown, F.lit("). Maintaining tier ceiling: "), caps))
        .when(level == "Amber", F.concat(
            F.lit("Moderate risk ("), shown, F.lit("). Reducing to 80% capacity: "), caps,
            F.lit(" Triggered by: "), _triggers(1), F.lit(".")))
        .otherwise(F.concat(
            F.lit("HIGH RISK ("), shown, F.lit("). Halving capacity: "), caps,
            F.lit(" Critical triggers: "), _triggers(2), F.lit(". Immediate review recommended.")))
    )
    return advised.withColumn("justification", reason)


def score_agents(
    activity: DataFrame, agents: DataFrame, tiers: DataFrame, baseline_window: int = anomaly.BASELINE_WINDOW
) -> DataFrame:
    """Risk profile of every current agent in one plan; agents without activity get the no-history verdict."""
    return profiles(agent_risk(score_metrics(activity, baseline_window=baseline_window)), agents, tiers)


def profiles(risks: DataFrame, agents: DataFrame, tiers: DataFrame) -> DataFrame:
    caps = tiers.select("tier_key", F.struct("tier_name", "daily_invite_limit", "daily_message_limit").alias("_tier"))
    who = lookup(dims.current(agents).select("agent_key", "agent_id", "display_name", "tier_key"), caps, "tier_key", "_tier")
    joined = who.select("agent_key", "agent_id", "display_name", "_tier.*").join(risks, "agent_key", "left")
    return recommend(joined)


def score_agent_history(
    activity: DataFrame, agents: DataFrame, tiers: DataFrame, baseline_window: int = anomaly.BASELINE_WINDOW
) -> DataFrame:
    """Like ``score_agents``, but an agent keeps its history across versions: days of all its versions are
    put together under the natural id (days in two versions add up) before they are scored."""
    ids_of = agents.select("agent_key", "agent_id")
    named = lookup(activity, ids_of, "agent_key", "agent_id").filter("agent_id IS NOT NULL")
    counts = ["invites_sent", "invites_accepted", "messages_sent", "replies_received", "meetings_booked"]
    days = named.groupBy("agent_id", "date_key").agg(
        *[F.sum(c).alias(c) for c in counts], F.max("utilisation_pct").alias("utilisation_pct")
    )
    days = days.withColumns({
        "acceptance_rate": numbers.rate(F.col("invites_accepted"), F.col("invites_sent")),
        "reply_rate": numbers.rate(F.col("replies_received"), F.col("invites_accepted")),
    })
    risks = agent_risk(score_metrics(days, "agent_id", baseline_window), "agent_id")
    keyed = dims.current(agents).select("agent_id", "agent_key").join(risks, "agent_id", "left").drop("agent_id")
    return profiles(keyed, agents, tiers)


def write_back(activity: DataFrame, risks: DataFrame) -> DataFrame:
    """Put risk / 50 on the newest activity row of each scored agent; other rows stay as they are."""
    newest = F.lead("date_key").over(Window.partitionBy("agent_key").orderBy("date_key")).isNull()
    kept = activity.drop("anomaly_score") if "anomaly_score" in activity.columns else activity
    before = F.col("anomaly_score") if "anomaly_score" in activity.columns else F.lit(None).cast("double")
    joined = activity.select(*kept.columns, before.alias("_before"), newest.alias("_newest")).join(
        risks.select("agent_key", F.col("risk_score").alias("_risk")), "agent_key", "left"
    )
    score = F.when(F.col("_newest") & F.col("_risk").isNotNull(), F.col("_risk") / 50).otherwise(F.col("_before"))
    return joined.select(*kept.columns, score.alias("anomaly_score"))
