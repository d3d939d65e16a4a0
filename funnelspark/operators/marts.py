"""Aggregates over the event fact (AG-1..AG-8). All are hash aggregates with map-side combine."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import numbers
from funnelspark.operators import dims
from funnelspark.operators.joins import lookup

ACTIVITY_COUNTS = {
    "invites_sent": "INVITE_SENT",
    "invites_accepted": "ACCEPTED",
    "messages_sent": "MESSAGE_SENT",
    "replies_received": "REPLY_RECEIVED",
    "meetings_booked": "MEETING_BOOKED",
}
CAMPAIGN_COUNTS = {
    "invites_sent": "INVITE_SENT",
    "connected": "ACCEPTED",
    "replied": "REPLY_RECEIVED",
    "meetings_booked": "MEETING_BOOKED",
}


def events_of(kind: str) -> Column:
    return F.count_if(F.col("event_type") == kind)


def daily_agent_activity(
    fact: DataFrame, by: list[str] = ("agent_key", "date_key"), zero_rate: bool = False
) -> DataFrame:
    """Agent × day counts and rates. Rates are NULL without a denominator, or 0.0 with ``zero_rate``."""
    rate = numbers.rate_or_zero if zero_rate else numbers.rate
    present = F.lit(True)
    for c in by:
        present = present & F.col(c).isNotNull()
    counted = fact.filter(present).groupBy(*by).agg(*[events_of(kind).alias(c) for c, kind in ACTIVITY_COUNTS.items()])
    return counted.withColumns(
        {
            "acceptance_rate": rate(F.col("invites_accepted"), F.col("invites_sent")),
            "reply_rate": rate(F.col("replies_received"), F.col("invites_accepted")),
        }
    )


def with_utilisation(activity: DataFrame, agents: DataFrame, tiers: DataFrame, on: str = "agent_key") -> DataFrame:
    """Invites as a share of the daily cap of the tier the agent's version had; NULL without a tier."""
    caps = lookup(agents.select(on, "tier_key"), tiers, "tier_key", "daily_invite_limit")
    joined = lookup(activity, caps, on, "daily_invite_limit")
    return joined.withColumn("utilisation_pct", numbers.rate(F.col("invites_sent"), F.col("daily_invite_limit"))).drop(
        "daily_invite_limit"
    )


def roi_score(sent: Column, connected: Column, replied: Column, meetings: Column) -> Column:
    accept = numbers.ratio_or_zero(connected, sent)
    reply = numbers.ratio_or_zero(replied, connected)
    convert = numbers.ratio_or_zero(meetings, sent)
    return (accept * 0.3 + reply * 0.3 + convert * 0.4) * 100


def campaign_performance(
    fact: DataFrame, by: list[str] = ("campaign_key", "date_key"), lead: str = "lead_key", approximate: bool = False
) -> DataFrame:
    """Campaign × day counts, distinct leads, conversion and return.

    The exact distinct count first groups on (keys, lead), so a campaign holding a third of all events is spread
    over its leads before it is counted; ``approximate`` trades that shuffle for a sketch.
    """
    present = F.lit(True)
    for c in by:
        present = present & F.col(c).isNotNull()
    leads = F.approx_count_distinct(lead) if approximate else F.count_distinct(lead)
    counted = fact.filter(present).groupBy(*by).agg(
        leads.alias("total_leads"), *[events_of(kind).alias(c) for c, kind in CAMPAIGN_COUNTS.items()]
    )
    return counted.withColumns(
        {
            "conversion_rate": numbers.rate(F.col("meetings_booked"), F.col("invites_sent")),
            "roi_score": roi_score(*[F.col(c) for c in CAMPAIGN_COUNTS]),
        }
    )


def touched_groups(events: DataFrame, by: list[str] = ("agent_key", "date_key")) -> DataFrame:
    return events.select(*by).dropna().distinct()


def refresh_activity(
    fact: DataFrame, touched: DataFrame, by: list[str] = ("agent_key", "date_key"), zero_rate: bool = True
) -> DataFrame:
    """Recompute just the groups a batch touched; any lateness is fine, since the fact is what counts.

    ``touched`` holds distinct keys; the fact side is semi-joined before it is aggregated.
    """
    return daily_agent_activity(fact.join(touched, list(by), "left_semi"), by, zero_rate)


def merge_mart(existing: DataFrame, fresh: DataFrame, by: list[str]) -> DataFrame:
    """Upsert by group: recomputed groups replace the old ones, others stay (also those without events now)."""
    measures = [c for c in fresh.columns if c not in by]
    return dims.upsert(existing, fresh, list(by), measures)


def kpi_summary(fact: DataFrame) -> DataFrame:
    """Global totals and percentages from one pass."""
    totals = fact.agg(
        events_of("INVITE_SENT").alias("total_invites_sent"),
        events_of("ACCEPTED").alias("total_accepted"),
        events_of("REPLY_RECEIVED").alias("total_replies_received"),
        events_of("MEETING_BOOKED").alias("total_meetings_booked"),
    )
    sent, accepted = F.col("total_invites_sent"), F.col("total_accepted")
    return totals.withColumns(
        {
            "acceptance_rate_pct": numbers.percent(accepted, sent),
            "reply_rate_pct": numbers.percent(F.col("total_replies_received"), accepted),
            "conversion_rate_pct": numbers.percent(F.col("total_meetings_booked"), sent),
        }
    )


def vitals(fact: DataFrame, agents: DataFrame) -> DataFrame:
    """Events in the warehouse and agents now current, as one row: one count over both, tagged by side."""
    both = fact.select(F.lit(True).alias("is_event")).unionAll(dims.current(agents).select(F.lit(False).alias("is_event")))
    return both.agg(
        F.count_if("is_event").alias("total_events_in_dw"), F.count_if(~F.col("is_event")).alias("active_agents")
    )
