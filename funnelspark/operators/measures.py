"""Dashboard measures as grouped queries (KP-1..KP-14).

A dashboard's filter context is a list of grouping columns plus a filter, so most measures are one entry in a table of
aggregate expressions; those that need more than one grain have a function of their own.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import numbers, text, times
from funnelspark.operators import dims
from funnelspark.operators.joins import lookup
from funnelspark.operators.marts import events_of, roi_score
from funnelspark.operators.risk import AMBER_ABOVE, RED_ABOVE


def _sent() -> Column:
    return events_of("INVITE_SENT")


def _accepted() -> Column:
    return events_of("ACCEPTED")


def _replied() -> Column:
    return events_of("REPLY_RECEIVED")


def _meetings() -> Column:
    return events_of("MEETING_BOOKED")


def _active(status: str) -> Column:
    return F.count_distinct(F.when((F.col("status") == status) & F.col("is_current"), F.col("agent_id")))


_LIMIT = "daily_invite_limit"

# Measure → aggregate. Event measures read fact_outreach_event; the others the table their columns name.
MEASURES: dict[str, Callable[[], Column]] = {
    "Total Invites Sent": _sent,
    "Total Accepted": _accepted,
    "Acceptance Rate": lambda: numbers.ratio_or_zero(_accepted(), _sent()),
    "Reply Rate": lambda: numbers.ratio_or_zero(_replied(), _accepted()),
    "Conversion Rate": lambda: numbers.ratio_or_zero(_meetings(), _sent()),
    "Total Meetings Booked": _meetings,
    "Daily Invites Sent": _sent,
    "Daily Invite Limit": lambda: F.max(_LIMIT),
    "Utilisation %": lambda: numbers.ratio_or_zero(_sent(), F.max(_LIMIT)),
    "Funnel - Sent": _sent,
    "Funnel - Accepted": _accepted,
    "Funnel - Replied": _replied,
    "Funnel - Meeting Booked": _meetings,
    "Active Agent Count": lambda: _active("active"),
    "Paused Agent Count": lambda: _active("paused"),
    "Ghost Agent Count": lambda: _active("ghost"),
    "Platform Average Risk Score": lambda: F.avg("anomaly_score") * 50,
    "Risk Level Label": lambda: risk_label(F.avg("anomaly_score") * 50),
    "Risk Threshold Warning": lambda: F.max(F.lit(AMBER_ABOVE)),
    "Risk Threshold Critical": lambda: F.max(F.lit(RED_ABOVE)),
    "Current Tier Limit": lambda: F.max(_LIMIT),
    "Campaign Invites Sent": _sent,
    "Campaign Connected": _accepted,
    "Campaign Replied": _replied,
    "Campaign Meetings": _meetings,
    "Campaign ROI Score": lambda: roi_score(_sent(), _accepted(), _replied(), _meetings()),
    "Segment Acceptance Rate": lambda: numbers.ratio_or_zero(_accepted(), _sent()),
    "Segment Reply Rate": lambda: numbers.ratio_or_zero(_replied(), _accepted()),
    "DQ Trend": lambda: F.avg("composite_score"),
}


def measure(
    df: DataFrame, names: list[str], by: list[str] = (), where: Column | None = None, tiers: DataFrame | None = None,
) -> DataFrame:
    """The named measures in one aggregate; columns are the names in lower snake case.

    Measures of events against the invite cap need ``tiers``: the cap is the highest of all tiers, whatever is grouped by.
    """
    rows = df if where is None else df.filter(where)
    if tiers is not None:
        rows = rows.withColumn(_LIMIT, tiers.agg(F.max(_LIMIT)).scalar())
    return rows.groupBy(*by).agg(*[MEASURES[n]().alias(column_name(n)) for n in names])


def column_name(measure_name: str) -> str:
    words = measure_name.replace("%", "pct").replace("-", " ").split()
    return "_".join(words).lower()


def risk_label(score: Column) -> Column:
    return F.when(score <= AMBER_ABOVE, "Low Risk").when(score <= RED_ABOVE, "Moderate Risk").otherwise("High Risk")


def funnel(fact: DataFrame) -> DataFrame:
    """Stage counts with the share of the previous and of the first stage, from one aggregate row."""
    totals = measure(fact, ["Funnel - Sent", "Funnel - Accepted", "Funnel - Replied", "Funnel - Meeting Booked"])
    counts = [F.col(c) for c in totals.columns]
    stages = ["Sent", "Accepted", "Replied", "Meeting Booked"]
    rows = [
        F.struct(
            F.lit(i + 1).alias("step"), F.lit(stage).alias("stage"), n.alias("n"),
            numbers.ratio_or_zero(n, counts[max(i - 1, 0)]).alias("step_rate"),
            numbers.ratio_or_zero(n, counts[0]).alias("overall_rate"),
        )
        for i, (stage, n) in enumerate(zip(stages, counts))
    ]
    return totals.select(F.inline(F.array(*rows)))


def daily_utilisation(activity: DataFrame, tiers: DataFrame) -> DataFrame:
    """Invites per day against the highest tier cap; the cap is the same for every day.

    Reads the daily mart instead of the events: the same sums over far fewer rows.
    """
    days = activity.groupBy("date_key").agg(F.sum("invites_sent").alias("daily_invites_sent"))
    return days.withColumn(_LIMIT, tiers.agg(F.max(_LIMIT)).scalar()).withColumn(
        "utilisation_pct", numbers.ratio_or_zero(F.col("daily_invites_sent"), F.col(_LIMIT))
    )


def agent_status(agents: DataFrame) -> DataFrame:
    return dims.current(agents).select("agent_id", text.status_label(F.col("status")).alias("agent_status"))


def status_counts(agents: DataFrame) -> DataFrame:
    return dims.current(agents).groupBy("status").agg(F.count_distinct("agent_id").alias("agents"))


def days_since_last_activity(fact: DataFrame, as_of: Column, agent: str = "agent_key") -> DataFrame:
    last = fact.filter(F.col(agent).isNotNull()).groupBy(agent).agg(F.max("event_timestamp").alias("last_activity"))
    return last.withColumn("days_since_last_activity", times.days_since(F.col("last_activity"), as_of))


def agent_utilisation(activity: DataFrame, agents: DataFrame, tiers: DataFrame, where: Column | None = None) -> DataFrame:
    """Invites over a period / (tier cap × active days) per current agent, 0 for one without a row in the period."""
    days = activity if where is None else activity.filter(where)
    # The mart has one row per agent and day, so counting rows counts distinct days.
    sums = days.groupBy("agent_key").agg(F.sum("invites_sent").alias("invites"), F.count("date_key").alias("active_days"))
    caps = lookup(dims.current(agents).select("agent_key", "agent_id", "tier_key"), tiers, "tier_key", _LIMIT)
    counts = {c: F.coalesce(c, F.lit(0)) for c in ("invites", "active_days")}
    return caps.join(sums, "agent_key", "left").withColumns(counts).select(
        "agent_id", *counts, _LIMIT,
        numbers.ratio_or_zero(F.col("invites"), F.col(_LIMIT) * F.col("active_days")).alias("agent_utilisation_pct"),
    )


def platform_risk(activity: DataFrame) -> DataFrame:
    return measure(activity, ["Platform Average Risk Score", "Risk Level Label"])


def agent_risk_on_last_date(activity: DataFrame, agents: DataFrame) -> DataFrame:
    """Highest risk per current agent on the newest day that has rows, NULL for agents idle that day."""
    newest = activity.agg(F.max("date_key")).scalar()
    last = activity.filter(F.col("date_key") == newest).groupBy("agent_key").agg(F.max("anomaly_score").alias("_score"))
    return dims.current(agents).join(last, "agent_key", "left").select(
        "agent_key", "agent_id", "tier_key", newest.alias("date_key"), (F.col("_score") * 50).alias("agent_risk_score")
    )


def recommended_capacity(risks: DataFrame) -> DataFrame:
    """Cap, recommended invites (rounded, where the risk model truncates) and the change in percent.

    ``risks``: agent, ``agent_risk_score`` and the tier's ``daily_invite_limit``.
    """
    score, cap = F.col("agent_risk_score"), F.col(_LIMIT)
    blank_as_zero = F.coalesce(score, F.lit(0.0))
    advised = (
        F.when(blank_as_zero <= AMBER_ABOVE, cap.cast("double"))
        .when(blank_as_zero <= RED_ABOVE, F.round(cap * F.lit(0.8), 0))
        .otherwise(F.round(cap * F.lit(0.5), 0))
    )
    return risks.withColumn("recommended_invites", advised).withColumn(
        "capacity_adjustment_pct", numbers.ratio_or_zero(F.col("recommended_invites"), cap) - 1
    )


def campaign_totals(fact: DataFrame, by: str = "campaign_key") -> DataFrame:
    names = ["Campaign Invites Sent", "Campaign Connected", "Campaign Replied", "Campaign Meetings", "Campaign ROI Score"]
    return measure(fact, names, [by], F.col(by).isNotNull())


def segment_rates(fact: DataFrame, leads: DataFrame, lead: str = "lead_key") -> DataFrame:
    """Acceptance and reply rate per lead segment.

    Events shrink to one row per lead before they meet the lead dimension, so neither a busy lead nor a
    large fact is shuffled whole.
    """
    kinds = {"sent": "INVITE_SENT", "accepted": "ACCEPTED", "replied": "REPLY_RECEIVED"}
    per_lead = fact.filter(F.col(lead).isNotNull() & F.col("event_type").isin(*kinds.values())).groupBy(lead).agg(
        *[events_of(kind).alias(c) for c, kind in kinds.items()]
    )
    per_segment = lookup(per_lead, leads, lead, "segment").groupBy("segment").agg(*[F.sum(c).alias(c) for c in kinds])
    return per_segment.select(
        "segment", *kinds,
        numbers.ratio_or_zero(F.col("accepted"), F.col("sent")).alias("segment_acceptance_rate"),
        numbers.ratio_or_zero(F.col("replied"), F.col("accepted")).alias("segment_reply_rate"),
    )


def calendar_volume(fact: DataFrame, calendar: DataFrame, by: list[str]) -> DataFrame:
    """Core measures by calendar attributes: events shrink to one row per day first."""
    kinds = {"invites_sent": "INVITE_SENT", "accepted": "ACCEPTED"}
    per_day = fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("events"), *[events_of(kind).alias(c) for c, kind in kinds.items()]
    )
    return per_day.join(calendar.select("date_key", *by), "date_key").groupBy(*by).agg(
        *[F.sum(c).alias(c) for c in ("events", *kinds)]
    )
