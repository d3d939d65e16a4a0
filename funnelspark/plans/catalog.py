"""Every registered query: name → function of the inputs. Results carry natural keys and rounded doubles."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from funnelspark.functions import numbers, text
from funnelspark.operators import alerts, anomaly, clean, dims, facts, marts, measures, quality, risk
from funnelspark.plans import batch, derived, landing
from funnelspark.plans.inputs import Inputs
from funnelspark.schemas import raw_schema, shape
from funnelspark.session import prepare, write_stage
from funnelspark.sources import files, imports
from funnelspark.sources.warehouse import Warehouse
from funnelspark.streaming import live

QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}


def query(fn: Callable[[Inputs], DataFrame]) -> Callable[[Inputs], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def registered() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, sf_dir: fn(Inputs(prepare(spark), sf_dir))

    return {name: bind(fn) for name, fn in QUERIES.items()}


def stamp(c: str | Column) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Doubles to a few places, times as text."""
    kinds = {"double": lambda c: F.round(c, places), "timestamp": stamp}
    return df.select(*[
        kinds[f.dataType.typeName()](f.name).alias(f.name) if f.dataType.typeName() in kinds else F.col(f.name)
        for f in df.schema.fields
    ])


# ── Clean and route: CL-1..CL-10, FN-1..FN-10 ─────────────────────────────────


@query
def clean_events(i: Inputs) -> DataFrame:
    return rounded(i.events)


@query
def rejected_events(i: Inputs) -> DataFrame:
    letters = clean.dead_letters(i.routed("events", derived.RAW_EVENTS), "run_1", i.as_of)
    return letters.select(
        "source_id", "error_message", "error_type", "source", "run_id", "resolved",
        F.get_json_object("record_payload", "$.timestamp").alias("payload_timestamp"),
    )


@query
def reject_summary(i: Inputs) -> DataFrame:
    return clean.reject_counts(i.routed("events", derived.RAW_EVENTS))


@query
def replayed_events(i: Inputs) -> DataFrame:
    """Dead letters after their times were corrected by hand: those are clean now, the others stay."""
    letters = clean.dead_letters(i.routed("events", derived.RAW_EVENTS), "run_1", i.as_of)
    corrected = letters.withColumn("record_payload", F.regexp_replace("record_payload", "not-a-date", "2024-01-15 08:30:00"))
    fixed, _ = clean.replay(corrected, "events", i.as_of)
    return rounded(fixed)


@query
def replay_resolution(i: Inputs) -> DataFrame:
    letters = clean.dead_letters(i.routed("events", derived.RAW_EVENTS), "run_1", i.as_of)
    corrected = letters.withColumn("record_payload", F.regexp_replace("record_payload", "not-a-date", "2024-01-15 08:30:00"))
    _, updated = clean.replay(corrected, "events", i.as_of)
    return updated.groupBy("error_type", "resolved").agg(F.count(F.lit(1)).alias("n"))


@query
def event_type_normalised(i: Inputs) -> DataFrame:
    kinds = i.raw(derived.RAW_EVENTS).select(
        F.col("event_type").alias("raw_type"), text.event_type_of(F.col("event_type")).alias("event_type")
    )
    return kinds.groupBy("raw_type", "event_type").agg(
        F.count(F.lit(1)).alias("n"), F.first(text.is_unknown_type(F.col("event_type"))).alias("is_unknown")
    )


@query
def clean_agents(i: Inputs) -> DataFrame:
    return i.clean("agents", derived.RAW_AGENTS_2)


@query
def clean_leads(i: Inputs) -> DataFrame:
    return i.clean("leads", derived.RAW_LEADS_MIXED)


@query
def rejected_leads(i: Inputs) -> DataFrame:
    letters = clean.dead_letters(i.routed("leads", derived.RAW_LEADS_MIXED), "run_1", i.as_of)
    return letters.select("source_id", "error_message", F.get_json_object("record_payload", "$.name").alias("payload_name"))


@query
def clean_campaigns(i: Inputs) -> DataFrame:
    return rounded(i.clean("campaigns", derived.RAW_CAMPAIGNS_1))


@query
def clean_templates(i: Inputs) -> DataFrame:
    return rounded(i.clean("templates", derived.RAW_TEMPLATES))


@query
def load_rejects(i: Inputs) -> DataFrame:
    """Documents taken for leads: a joined name longer than the table's column is rejected at load time."""
    raw = i.table("documents").select(
        F.col("doc_id").alias("pos"), F.concat(F.lit("lead_d"), F.col("doc_id")).alias("id"),
        F.col("lang").alias("first_name"), F.col("text").alias("last_name"), F.col("source").alias("segment"),
    )
    checked = clean.check_limits(clean.clean_rows(clean.route(raw, "leads", ["pos"])), "dim_lead")
    return checked.filter("_reject IS NOT NULL").select(
        "lead_id", F.col("_reject.rule").alias("rule"), F.col("_reject.message").alias("message")
    )


# ── Dimensions: DM-1..DM-13 ───────────────────────────────────────────────────


@query
def tier_agents(i: Inputs) -> DataFrame:
    """Current agents per account tier, tiers without agents included."""
    counted = dims.current(i.stored("dim_agent")).groupBy("tier_key").agg(F.count(F.lit(1)).alias("agents"))
    return i.tiers.join(counted, "tier_key", "left").withColumn("agents", F.coalesce("agents", F.lit(0)))


@query
def calendar_event_volume(i: Inputs) -> DataFrame:
    by = ["year", "quarter", "month", "month_name", "week_of_year", "day_of_week", "day_name", "is_weekend"]
    return measures.calendar_volume(i.fact, i.calendar, by)


@query
def scd2_agents(i: Inputs) -> DataFrame:
    tiers = i.tiers.select("tier_key", "tier_name")
    return rounded(i.agents_reloaded.join(tiers, "tier_key", "left").drop("agent_key", "tier_key", "_action"))


@query
def import_defaults(i: Inputs) -> DataFrame:
    """The importer's own agent and campaign beside the stored ones: made once, and not at all where the id is there."""
    agents, campaigns = i.warehouse["dim_agent"], i.warehouse["dim_campaign"]
    for _ in range(2):
        agents = dims.ensure_row(agents, "agent_id", facts.ARCHIVE_AGENT, "agent_key", i.as_of)
        campaigns = dims.ensure_row(campaigns, "campaign_id", facts.ARCHIVE_CAMPAIGN, "campaign_key", i.as_of)
    # As an import that books on the oldest stored campaign.
    oldest = F.col("campaign_id").isin([campaigns.agg(F.min("campaign_id")).head()[0]])
    stored = campaigns.filter(oldest).select("campaign_id").head()
    campaigns = dims.ensure_row(campaigns, "campaign_id", {**facts.ARCHIVE_CAMPAIGN, "campaign_id": stored[0] if stored else "none"}, "campaign_key", i.as_of)
    return agents.select(F.lit("agent").alias("kind"), F.col("agent_id").alias("id"), F.col("status").alias("value")).unionAll(
        campaigns.select(F.lit("campaign"), "campaign_id", "campaign_type"))


@query
def number_texts(i: Inputs) -> DataFrame:
    """Numbers as people write them, and texts that are none."""
    form = F.pmod(F.col("l_orderkey") + F.col("l_linenumber"), F.lit(8))
    part, supp = F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")
    written = F.element_at(F.array(
        F.concat(F.lit(" "), F.col("l_extendedprice").cast("string"), F.lit("\t")), F.concat(part, F.lit("_000")), F.concat(F.lit("+"), supp, F.lit("e2")),
        F.concat(F.lit("-."), F.col("l_linenumber").cast("string")), F.lit("inf"), F.concat(supp, F.lit("%")), F.lit(""), F.concat(supp, F.lit(".")),
    ), form.cast("int") + 1)
    return i.table("lineitem").select("l_orderkey", "l_linenumber", numbers.to_double(written).alias("number"), numbers.to_int(written).alias("whole"))


@query
def scd2_leads(i: Inputs) -> DataFrame:
    return rounded(i.leads_reloaded.drop("lead_key", "_action"))


@query
def scd2_load_counts(i: Inputs) -> DataFrame:
    agents = dims.version_counts(i.agents_reloaded).withColumn("entity", F.lit("agents"))
    return agents.unionByName(dims.version_counts(i.leads_reloaded).withColumn("entity", F.lit("leads")))


@query
def leads_as_of(i: Inputs) -> DataFrame:
    at = i.at("2024-01-15 00:00:00")
    then = dims.versions_at(i.leads_reloaded, at)
    return then.groupBy("segment", "lead_status").agg(F.count(F.lit(1)).alias("leads"))


@query
def scd1_campaign_upsert(i: Inputs) -> DataFrame:
    merged = dims.merge_campaigns(i.campaigns, i.clean("campaigns", derived.RAW_CAMPAIGNS_2))
    return rounded(merged.drop("campaign_key", "updated_at").withColumnRenamed("_action", "action"))


@query
def scd1_template_upsert(i: Inputs) -> DataFrame:
    """Second load: the same templates with their channel in capitals."""
    again = i.templates.withColumn("channel", F.when(F.col("channel") == "email", F.upper("channel")).otherwise(F.col("channel")))
    merged = dims.merge_templates(i.templates, again.drop("template_key"))
    return merged.select("template_id", "template_name", "template_body", "channel", F.col("_action").alias("action"))


@query
def upsert_do_nothing(i: Inputs) -> DataFrame:
    incoming = i.clean("campaigns", derived.RAW_CAMPAIGNS_2)
    merged = dims.upsert(i.campaigns, incoming, "campaign_id", [])
    return merged.groupBy(F.col("_action").alias("action"), "target_segment").agg(F.count(F.lit(1)).alias("n"))


# ── Facts: FA-1, FA-2 ─────────────────────────────────────────────────────────


@query
def event_key_resolution(i: Inputs) -> DataFrame:
    return i.resolved(*facts.DIMENSIONS).select(
        "event_source_id", *[F.col(k).isNotNull().alias(f"has_{k}") for k in ("agent_key", "lead_key", "campaign_key", "template_key")]
    )


@query
def asof_key_resolution(i: Inputs) -> DataFrame:
    """Events with the status their agent had when they happened."""
    versions = i.agents_reloaded.drop("_action")
    resolved = facts.resolve_keys_at(i.events, versions, "dim_agent")
    status = versions.select("agent_key", "status")
    return resolved.join(status, "agent_key", "left").groupBy("agent_id", "status").agg(F.count(F.lit(1)).alias("events"))


@query
def asof_many_versions(i: Inputs) -> DataFrame:
    """Two hot ids with a version per order date of their status: which one each line was shipped under."""
    per_day = i.table("orders").groupBy(F.col("o_orderstatus").alias("lead_id"), F.col("o_orderdate").cast("timestamp").alias("valid_from")).agg(F.min("o_orderkey").alias("lead_key"))
    versions = per_day.withColumn("valid_to", F.lead("valid_from").over(Window.partitionBy("lead_id").orderBy("valid_from")))
    shipped = i.table("lineitem").select(F.col("l_linestatus").alias("lead_id"), F.col("l_shipdate").cast("timestamp").alias("event_timestamp"))
    return facts.resolve_keys_at(shipped, versions, "dim_lead").groupBy("lead_id", "lead_key").agg(F.count(F.lit(1)).alias("events"))


@query
def backfilled_keys(i: Inputs) -> DataFrame:
    """Events loaded before their leads existed, then filled in once the leads are there."""
    events = i.stored("clean_events")
    early = facts.as_fact(
        events.withColumns({k: F.lit(None).cast("bigint") for k in ("agent_key", "lead_key", "campaign_key", "template_key")}),
        i.loaded,
    )
    filled = facts.backfill_keys(early, events.select("event_source_id", "lead_id"), {"dim_lead": i.leads})
    return filled.groupBy("event_type").agg(F.count(F.lit(1)).alias("events"), F.count("lead_key").alias("with_lead"))


def _copies(i: Inputs, redelivered: bool) -> DataFrame:
    """First deliveries and redeliveries as two batches (the raw position tells them apart)."""
    raw = i.raw(derived.RAW_EVENTS)
    late = F.col("pos") >= 1_000_000_000_000
    return clean.clean_rows(clean.route(raw.filter(late if redelivered else ~late), "events", ["pos"]))


@query
def event_upsert(i: Inputs) -> DataFrame:
    """Second batch over a loaded first one: repeats change status and response time only."""
    first = facts.as_fact(_copies(i, False), i.loaded)
    second = facts.as_fact(_copies(i, True), i.reloaded)
    merged = facts.upsert_events(first, second)
    return rounded(merged.select(
        "event_source_id", "event_type", "event_timestamp", "date_key", "event_status", "response_time_minutes",
        "loaded_at", F.col("_action").alias("action"),
    ))


@query
def event_sink_upsert(i: Inputs) -> DataFrame:
    """The same two batches through the stored fact: two loads, read back."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        warehouse.upsert_events(facts.as_fact(_copies(i, False), i.loaded))
        warehouse.upsert_events(write_stage(facts.as_fact(_copies(i, True), i.reloaded), "redelivered"))

    fact = Warehouse(i.spark, i.once("event-sink", run)).read("fact_outreach_event")
    return rounded(fact.select("event_source_id", "event_type", "event_timestamp", "date_key", "event_status", "response_time_minutes", "loaded_at"))


@query
def micro_batch_merge(i: Inputs) -> DataFrame:
    """All deliveries as one micro-batch: first valid copy for fixed columns, last for updatable ones."""
    routed = clean.route(i.raw(derived.RAW_EVENTS), "events", ["pos"], dedup=False)
    valid = routed.filter("_reject IS NULL")
    columns = routed.columns[: routed.columns.index("_raw")]
    merged = facts.latest_of_batch(valid.select(*columns, F.col("_o_pos")), F.col("_o_pos"))
    return rounded(merged.select(*columns))


@query
def chronology_check(i: Inputs) -> DataFrame:
    pairs = facts.chronology(i.fact)
    return rounded(i.named(i.named(pairs), "dim_lead"))


# ── Marts: AG-1..AG-8 ─────────────────────────────────────────────────────────


@query
def daily_agent_activity(i: Inputs) -> DataFrame:
    """From raw records to the mart in one plan: clean, resolve, aggregate, relate to the tier's cap."""
    fact = facts.resolve_keys(i.events, {"dim_agent": i.agents})
    names = i.agents.select("agent_key", "agent_id")
    days = marts.with_utilisation(marts.daily_agent_activity(fact), i.agents, i.tiers)
    return rounded(days.join(names, "agent_key").drop("agent_key"))


@query
def live_daily_refresh(i: Inputs) -> DataFrame:
    """Agent-days touched by meetings, recomputed in live style (0.0 instead of NULL rates)."""
    touched = marts.touched_groups(i.fact.filter("event_type = 'MEETING_BOOKED'"))
    return rounded(i.named(marts.refresh_activity(i.fact, touched)))


@query
def campaign_performance(i: Inputs) -> DataFrame:
    return rounded(i.named(marts.campaign_performance(i.fact), "dim_campaign"))


@query
def mart_upsert(i: Inputs) -> DataFrame:
    """The daily mart before and after redeliveries: recomputed groups replace, other groups stay."""
    by = ["agent_id", "date_key"]
    before = marts.daily_agent_activity(_copies(i, False), by)
    fresh = marts.daily_agent_activity(_copies(i, True), by)
    return rounded(marts.merge_mart(before, fresh, by).withColumnRenamed("_action", "action"))


@query
def kpi_summary(i: Inputs) -> DataFrame:
    return marts.kpi_summary(i.fact)


@query
def warehouse_vitals(i: Inputs) -> DataFrame:
    return marts.vitals(i.fact, i.agents_reloaded)


# ── Measures: KP-1..KP-14 ─────────────────────────────────────────────────────


@query
def core_measures(i: Inputs) -> DataFrame:
    names = ["Total Invites Sent", "Total Accepted", "Acceptance Rate", "Reply Rate", "Conversion Rate", "Total Meetings Booked"]
    return rounded(measures.measure(i.fact, names, ["date_key"], F.col("event_status") != "DUP"))


@query
def funnel(i: Inputs) -> DataFrame:
    return rounded(measures.funnel(i.fact))


@query
def utilisation_daily(i: Inputs) -> DataFrame:
    return rounded(measures.daily_utilisation(i.activity, i.tiers))


@query
def utilisation_measures(i: Inputs) -> DataFrame:
    """The same from the events, as dashboard measures by name."""
    names = ["Daily Invites Sent", "Daily Invite Limit", "Utilisation %"]
    return rounded(measures.measure(i.fact, names, ["date_key"], tiers=i.tiers))


@query
def agent_status(i: Inputs) -> DataFrame:
    return measures.agent_status(i.agents_reloaded)


@query
def agent_status_counts(i: Inputs) -> DataFrame:
    names = ["Active Agent Count", "Paused Agent Count", "Ghost Agent Count"]
    return measures.measure(i.agents_reloaded, names)


@query
def days_since_activity(i: Inputs) -> DataFrame:
    return rounded(i.named(measures.days_since_last_activity(i.fact, i.at("2024-02-10 00:00:00"))))


@query
def agent_utilisation_period(i: Inputs) -> DataFrame:
    second_week = F.col("date_key").between(20240108, 20240114)
    return rounded(measures.agent_utilisation(i.activity, i.stored("dim_agent"), i.tiers, second_week))


@query
def campaign_roi(i: Inputs) -> DataFrame:
    return rounded(i.named(measures.campaign_totals(i.fact), "dim_campaign"))


@query
def segment_rates(i: Inputs) -> DataFrame:
    return rounded(measures.segment_rates(i.fact, i.stored("dim_lead")))


# ── Data quality: DQ-1..DQ-10 ─────────────────────────────────────────────────


@query
def dq_completeness(i: Inputs) -> DataFrame:
    checks = [quality.table_profile(i.warehouse[t], t, required) for t, required in quality.REQUIRED.items()]
    holes = quality.table_profile(i.raw(derived.RAW_EVENTS), "raw_events", ["id", "agent_id", "event_type", "status"])
    return rounded(quality.union_all([*checks, holes]))


@query
def dq_uniqueness(i: Inputs) -> DataFrame:
    checks = [
        quality.uniqueness(i.warehouse[t], t, key, current_only=t in ("dim_agent", "dim_lead"))
        for t, key in quality.UNIQUE.items()
    ]
    checks.append(quality.uniqueness(i.raw(derived.RAW_EVENTS), "raw_events", "id"))
    checks.append(quality.uniqueness(i.table("lineitem"), "lineitem", ["l_orderkey", "l_linenumber"]))
    return rounded(quality.union_all(checks))


@query
def dq_validity_type(i: Inputs) -> DataFrame:
    checks = quality.table_profile(i.fact, "fact_outreach_event", ["event_type"], types=True)
    return rounded(checks.filter("check_dimension = 'validity'"))


@query
def dq_validity_tier(i: Inputs) -> DataFrame:
    return rounded(quality.tier_validity(i.activity, i.stored("dim_agent"), i.tiers))


@query
def dq_timeliness(i: Inputs) -> DataFrame:
    checks = quality.table_profile(i.fact, "fact_outreach_event", ["event_type"], i.as_of)
    return rounded(checks.filter("check_dimension = 'timeliness'"))


@query
def dq_referential(i: Inputs) -> DataFrame:
    checks = [
        quality.references(i.warehouse[t], t, [(c, i.warehouse[d], k) for c, d, k in foreign])
        for t, foreign in quality.REFERENCES.items()
    ]
    orders = i.table("orders").withColumn(
        "date_key", F.year("o_orderdate") * 10000 + F.month("o_orderdate") * 100 + F.dayofmonth("o_orderdate")
    )
    checks.append(quality.references(orders, "orders", [
        ("o_custkey", i.table("customer"), "c_custkey"), ("date_key", i.calendar, "date_key"),
    ]))
    # Natural ids, so that ids without a dimension row do occur.
    checks.append(quality.references(i.events, "events", [
        (natural, i.stored(t), natural) for t, (natural, _, _, _) in facts.DIMENSIONS.items()
    ]))
    return rounded(quality.union_all(checks))


@query
def dq_referential_empty(i: Inputs) -> DataFrame:
    """References of facts that hold no row of a kind that never occurs, to dimensions without rows."""
    rare = {"fact_outreach_event": "event_type = 'NEVER'", "fact_daily_agent_activity": "invites_sent < 0", "fact_campaign_performance": "connected < 0"}
    checks = [
        quality.references(i.warehouse[t].filter(rare[t]), t, [(c, i.warehouse[d].filter(F.col(k).isNull()), k) for c, d, k in foreign])
        for t, foreign in quality.REFERENCES.items()
    ]
    return rounded(quality.union_all(checks))


@query
def dq_composite(i: Inputs) -> DataFrame:
    return rounded(quality.composite(quality.run_checks(i.warehouse, i.as_of)))


@query
def dq_history(i: Inputs) -> DataFrame:
    rows = quality.history_rows(quality.run_checks(i.warehouse, i.as_of), "run_1", i.as_of)
    return rounded(rows.drop("details"))


@query
def stored_dq_history(i: Inputs) -> DataFrame:
    """Check rows of two runs, the first one stored twice, read back from the history table."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root)
        checks = write_stage(quality.run_checks(i.warehouse, i.as_of), "checks")
        for run_id in ("run_1", "run_2", "run_1"):
            warehouse.append("dq_results", quality.history_rows(checks, run_id, i.as_of), [run_id])

    return rounded(Warehouse(i.spark, i.once("dq-results", run)).read("dq_results").drop("details"))


def _dq_runs(i: Inputs) -> DataFrame:
    """Two runs of the event checks, a day apart: the later one finds more stale rows."""
    parts = []
    for run, at in (("run_1", "2024-01-30 00:00:00"), ("run_2", "2024-01-31 00:00:00")):
        checks = quality.table_profile(i.fact, "fact_outreach_event", ["event_type", "lead_key"], i.at(at), types=True)
        parts.append(quality.history_rows(checks, run, i.at(at), threshold=97.0))
    return quality.union_all(parts)


@query
def dq_trend(i: Inputs) -> DataFrame:
    return rounded(quality.score_trend(_dq_runs(i)))


@query
def dq_latest(i: Inputs) -> DataFrame:
    return rounded(quality.latest_score(_dq_runs(i), threshold=97.0))


# ── Anomalies: AN-1..AN-7 ─────────────────────────────────────────────────────

_SCORED = [
    "date_key", "metric", "current_value", "data_points", "baseline_points", "baseline_mean", "baseline_std", "z_score",
    "iqr_lower", "iqr_upper", "z_flag", "iqr_flag", "anomaly_score", "method_triggered", "reason",
]


@query
def anomaly_history(i: Inputs) -> DataFrame:
    scored = risk.score_metrics(i.activity)
    return rounded(i.named(scored.select("agent_key", *_SCORED, "is_latest")), 9)


@query
def anomaly_latest(i: Inputs) -> DataFrame:
    return rounded(i.named(risk.score_metrics(i.activity).filter("is_latest").select("agent_key", *_SCORED)), 9)


@query
def rate_collapse(i: Inputs) -> DataFrame:
    """The one-sided detector over campaigns: falls of the daily conversion rate."""
    rates = i.performance.select("campaign_key", "date_key", F.col("conversion_rate").alias("value")).filter("value IS NOT NULL")
    scored = anomaly.score_series(rates, ["campaign_key"], drops_only=F.lit(True))
    return rounded(i.named(scored.select(
        "campaign_key", "date_key", "current_value", "z_score", "iqr_lower", "iqr_upper", "anomaly_score", "method_triggered"
    ), "dim_campaign"), 9)


@query
def ghosting(i: Inputs) -> DataFrame:
    rates = i.activity.select(
        "agent_key", "date_key", anomaly.ghost_rate(F.col("invites_accepted"), F.col("replies_received")).alias("value")
    )
    # A three-day window is too short to judge by, so all earlier days count.
    scored = anomaly.score_series(rates, ["agent_key"], baseline_window=3)
    return rounded(i.named(scored.select(
        "agent_key", "date_key", "current_value", "baseline_points", "z_score", "anomaly_score", "method_triggered"
    )), 9)


# ── Risk: RK-1..RK-9, KP-9..KP-11 ─────────────────────────────────────────────


def _profiles(i: Inputs) -> DataFrame:
    return risk.score_agents(i.activity, i.stored("dim_agent"), i.tiers)


@query
def risk_scores(i: Inputs) -> DataFrame:
    return _profiles(i).select(
        "agent_id", "display_name", "tier_name", "risk_score", "risk_level",
        F.col("recommended_daily_invites").cast("double").alias("recommended_daily_invites"),
        F.col("recommended_daily_messages").cast("double").alias("recommended_daily_messages"),
        "justification",
    )


@query
def risk_scores_across_versions(i: Inputs) -> DataFrame:
    """Scores after the second load, with each agent's history kept across its versions."""
    scored = risk.score_agent_history(i.activity, i.agents_reloaded.drop("_action"), i.tiers)
    return scored.select("agent_id", "risk_score", "risk_level")


def _written_back(i: Inputs) -> DataFrame:
    risks = risk.agent_risk(risk.score_metrics(i.activity))
    return risk.write_back(i.activity, risks)


@query
def risk_latest_writeback(i: Inputs) -> DataFrame:
    return rounded(i.named(_written_back(i).select("agent_key", "date_key", "anomaly_score")))


@query
def platform_risk(i: Inputs) -> DataFrame:
    return rounded(measures.platform_risk(_written_back(i)))


@query
def recommended_capacity(i: Inputs) -> DataFrame:
    last = measures.agent_risk_on_last_date(_written_back(i), i.stored("dim_agent"))
    caps = last.join(i.tiers.select("tier_key", "daily_invite_limit"), "tier_key", "left")
    return rounded(measures.recommended_capacity(caps.drop("agent_key", "tier_key")))


# ── Alerts: AL-1..AL-5, AN-7 ──────────────────────────────────────────────────


@query
def alerts_high_risk(i: Inputs) -> DataFrame:
    rows = alerts.risky_agents(_profiles(i), ["Amber", "Red"])
    return rows.select("title", "message", "level", F.col("details")["risk_score"].alias("risk_score"))


@query
def alerts_dq(i: Inputs) -> DataFrame:
    rows = alerts.quality_breaches(_dq_runs(i), threshold=97.0)
    return rows.select("title", "level", *[F.col("details")[k].alias(k) for k in ("run_id", "dimension_scores")])


@query
def alerts_duration(i: Inputs) -> DataFrame:
    baseline = anomaly.duration_baseline(i.runs, ["pipeline"])
    rows = alerts.slow_runs(i.runs, baseline, ["pipeline"])
    return rows.select("title", "level", F.col("details")["run_id"].alias("run_id"),
                       F.round(F.col("details")["z_score"].cast("double"), 6).alias("z_score"))


def _incremental(i: Inputs) -> Warehouse:
    """Orders as lead records: a run up to a day, and one over all of them that reads what came after the first; then a run that fails."""

    def run(root: str) -> None:
        updated = F.col("o_orderdate").cast("timestamp")
        rows = i.table("orders").select(F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), updated.alias("updated_at"))
        day = datetime(1996, 1, 1)
        early = rows.filter(F.col("updated_at") <= F.lit(day))
        batch.run_batch(i.spark, f"{root}/none", root, day, "run_1", buckets=8, entity_frames={"leads": (early, ["pos"])}, since={"leads": "updated_at"})
        batch.run_batch(i.spark, f"{root}/none", root, datetime(2024, 1, 30), "run_2", buckets=8, entity_frames={"leads": (rows, ["pos"])}, since={"leads": "updated_at"})
        try:
            batch.run_batch(i.spark, f"{root}/none", root, datetime(2024, 1, 31), "run_3", buckets=8, entity_frames={"leads": (rows.drop("pos"), ["pos"])})
        except AnalysisException:
            pass  # the rows have no column to order by: this run is meant to fail

    return Warehouse(i.spark, i.once("incremental", run))


@query
def incremental_run(i: Inputs) -> DataFrame:
    """What each run read and loaded."""
    runs = _incremental(i).read("fact_pipeline_run")
    return runs.select("run_id", "status", "rows_extracted", "rows_loaded")


@query
def incremental_late_rows(i: Inputs) -> DataFrame:
    """Rows each incremental run took, dead letters, and lead versions: the second read finds late rows, rows without a time and changes within the overlap; the third nothing."""

    def run(root: str) -> None:
        day, late = datetime(1996, 1, 1), F.col("pos") % 5 == 0
        rows = i.table("orders").select(
            F.col("o_orderkey").alias("pos"), F.col("o_orderkey").cast("string").alias("id"), F.col("o_orderstatus").alias("status"), F.col("o_orderdate").cast("timestamp").alias("updated_at"),
        )
        first = rows.filter((F.col("updated_at") <= F.lit(day)) & ~late)
        newest = first.agg(F.max("updated_at")).first()[0]
        if newest is None:
            return
        changed = F.col("updated_at").between(F.lit(newest - timedelta(days=7)), F.lit(day)) & (F.col("pos") % 3 == 0) & ~late
        untimed = (F.col("pos") % 7 == 0) & (late | (F.col("updated_at") > F.lit(day)))
        second = rows.select(
            "pos", "id", F.when(changed, "X").otherwise(F.col("status")).alias("status"),
            F.when(untimed, F.lit(None)).when(changed, F.col("updated_at") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("updated_at")).alias("updated_at"),
        )
        for n, frame in enumerate((first, second, second), 1):
            batch.run_batch(i.spark, f"{root}/none", root, datetime(2024, 1, 28 + n), f"run_{n}", buckets=8, entity_frames={"leads": (frame, ["pos"])}, since={"leads": "updated_at"}, overlap=timedelta(days=7))

    warehouse = Warehouse(i.spark, i.once("incremental-late", run))
    taken = warehouse.read("fact_pipeline_run").select(F.lit("extracted").alias("what"), F.col("run_id").alias("name"), F.col("rows_extracted").cast("long").alias("n"))
    letters = warehouse.read("dead_letter_queue").groupBy(F.lit("letter").alias("what"), F.concat_ws(":", "run_id", "error_type").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    versions = warehouse.read("dim_lead").groupBy(F.lit("lead").alias("what"), F.concat_ws(":", "lead_status", "is_current").alias("name")).agg(F.count(F.lit(1)).alias("n"))
    return taken.unionByName(letters).unionByName(versions)


@query
def alert_table(i: Inputs) -> DataFrame:
    """Alerts that the runs stored, but those on durations, which differ from run to run."""
    found = _incremental(i).read("alerts").filter(F.col("title") != alerts.DURATION_TITLE)
    return found.select("run_id", "title", "level")


@query
def dq_key_collisions(i: Inputs) -> DataFrame:
    return quality.key_collisions({t: i.stored(t) for t in quality.SURROGATES})


@query
def alerts_failed_runs(i: Inputs) -> DataFrame:
    runs = i.runs.withColumns({"error_message": F.lit("source unreachable"), "end_time": i.as_of})
    return alerts.failed_runs(runs).select("title", "message", "level")


# ── Sources: SRC-1..SRC-12, FA-4..FA-6 ────────────────────────────────────────


@query
def entity_files(i: Inputs) -> DataFrame:
    """Leads from a folder of CSV and JSON files; the CSV copy of a lead comes first and wins."""
    raw = files.read_entity(i.spark, landing.entity_files(i), "leads", json_lines=True)
    return clean.clean_rows(clean.route(raw, "leads"))


@query
def epoch_event_times(i: Inputs) -> DataFrame:
    raw = files.read_json(i.spark, [landing.epoch_events(i)], "events", lines=True)
    routed = clean.route(raw, "events")
    return rounded(routed.select("event_source_id", "event_timestamp", F.col("_reject.rule").alias("rule")))


@query
def paged_leads(i: Inputs) -> DataFrame:
    raw = files.read_pages(i.spark, landing.pages(i), "leads")
    return clean.clean_rows(clean.route(raw, "leads")).select("lead_id", "full_name", "segment")


@query
def paged_pages_gap(i: Inputs) -> DataFrame:
    return files.missing_pages(i.spark, landing.pages(i))


@query
def incremental_orders(i: Inputs) -> DataFrame:
    newer = files.newer_than(i.table("orders"), "o_orderdate", datetime(1998, 6, 1))
    return newer.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))


@query
def watermark_upsert(i: Inputs) -> DataFrame:
    """Watermarks of event kinds moved from their first to their last time; a new entity is added."""
    events = i.table("events")
    first = events.groupBy(F.col("event_type").alias("entity_name")).agg(F.min("ts").cast("timestamp").alias("last_synced_at"))
    last = events.groupBy(F.col("event_type").alias("entity_name")).agg(F.max("ts").cast("timestamp").alias("last_synced_at"))
    orders = i.table("orders").agg(F.max("o_orderdate").cast("timestamp").alias("last_synced_at")).withColumn("entity_name", F.lit("orders"))
    merged = dims.upsert(first, last.unionByName(orders), "entity_name", ["last_synced_at"])
    return rounded(merged.withColumnRenamed("_action", "action"))


@query
def raw_landing(i: Inputs) -> DataFrame:
    landed = files.raw_landing(i.raw(derived.RAW_EVENTS), "events", "run_1", i.as_of)
    return landed.select("source_id", "source_type", "processed", "run_id",
                         F.get_json_object("raw_payload", "$.event_type").alias("payload_type"))


def _landed(i: Inputs) -> Warehouse:
    """Events that a run landed before it crashed, loaded from the landing table alone."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        batch.land_events(warehouse, i.raw(derived.RAW_EVENTS), "run_1", i.as_of, ["pos"])
        batch.reprocess(i.spark, root, "run_1", datetime(2024, 1, 30), "run_2", buckets=8)

    return Warehouse(i.spark, i.once("landed-events", run), buckets=8)


@query
def landed_states(i: Inputs) -> DataFrame:
    """What became of every landed record."""
    landed = _landed(i).read("stg_raw_events")
    return landed.groupBy("run_id", "state", "processed", F.get_json_object("raw_payload", "$.event_type").alias("payload_type")).agg(F.count(F.lit(1)).alias("n"))


@query
def reprocessed_events(i: Inputs) -> DataFrame:
    """The fact as loaded from the landing table: what a load of the source gives."""
    fact = _landed(i).read("fact_outreach_event")
    return rounded(fact.select("event_source_id", "event_type", "event_timestamp", "date_key", "event_status", "response_time_minutes"))


@query
def archive_leads(i: Inputs) -> DataFrame:
    people = facts.archive_connections(imports.connections(i.spark, landing.archive_connections(i)), i.as_of)
    return rounded(people)


@query
def archive_events(i: Inputs) -> DataFrame:
    """ACCEPTED events of connections and INVITE_SENT events of outgoing invitations."""
    agent, campaign = facts.ARCHIVE_AGENT["agent_id"], facts.ARCHIVE_CAMPAIGN["campaign_id"]
    people = facts.archive_connections(imports.connections(i.spark, landing.archive_connections(i)), i.as_of)
    accepted = facts.connection_events(people, agent, campaign)
    sent = facts.invitation_events(imports.invitations(i.spark, landing.archive_invitations(i)), agent, campaign, i.as_of)
    return rounded(accepted.unionByName(sent))


def _crm(i: Inputs) -> DataFrame:
    return imports.crm_export(i.spark, files.list_files(i.spark, landing.crm_exports(i), "*.csv"))


@query
def crm_leads(i: Inputs) -> DataFrame:
    """CRM leads over a dimension that already knows the suppliers, two of whose fields hold placeholders."""
    known = i.table("supplier").select(
        F.concat(F.lit("lead_"), F.lower(F.regexp_replace("s_name", "#", "_"))).alias("lead_id"), F.col("s_name").alias("full_name"),
        F.lit("Confidential").alias("company"), F.lit("Recruiter").alias("title"), F.lit("Old").alias("segment"),
        F.lit("NEW").alias("lead_status"), i.loaded.alias("valid_from"), F.lit(True).alias("is_current"),
    )
    merged = dims.refresh_leads(shape(known, "dim_lead"), dims.crm_leads(_crm(i)), i.reloaded)
    return rounded(merged.select(
        "lead_id", "full_name", "company", "title", "segment", "lead_status", "valid_from", F.col("_action").alias("action")
    ))


@query
def crm_events(i: Inputs) -> DataFrame:
    return rounded(facts.crm_events(_crm(i), "agent_crm", "camp_crm", i.as_of))


# ── Streaming: ST-1..ST-6, X-6 ────────────────────────────────────────────────


def _live_run(i: Inputs) -> Warehouse:
    """A warehouse whose events arrived as a stream, in two micro-batches (run once per session and inputs)."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        for name in facts.DIMENSIONS:
            warehouse.replace(name, i.stored(name))
        warehouse.replace("dim_account_tier", i.tiers)
        schema = StructType([*raw_schema("events").fields, StructField("pos", LongType())])
        landed = landing.live_events(i)
        half = -(-len(files.list_files(i.spark, landed, "part-*")) // 2)
        stream = i.spark.readStream.schema(schema).option("maxFilesPerTrigger", max(half, 1)).json(landed)
        live.start_ingest(stream, warehouse, f"{root}/checkpoint", ["pos"], at=i.as_of).awaitTermination()

    return Warehouse(i.spark, i.once("live-warehouse", run), buckets=8)


@query
def stream_daily_activity(i: Inputs) -> DataFrame:
    days = _live_run(i).read("fact_daily_agent_activity").drop("month", "loaded_at", "anomaly_score")
    return rounded(i.named(days))


@query
def stream_events(i: Inputs) -> DataFrame:
    fact = _live_run(i).read("fact_outreach_event")
    return rounded(fact.select("event_source_id", "event_type", "event_timestamp", "date_key", "event_status", "response_time_minutes"))


@query
def stream_receipts(i: Inputs) -> DataFrame:
    rows = _live_run(i).read("live_receipts", live.RECEIPTS)
    return rows.groupBy("status", "event_type", "warning").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_dead_letters(i: Inputs) -> DataFrame:
    return _live_run(i).read("dead_letter_queue").groupBy("error_type", "source", "resolved").agg(F.count(F.lit(1)).alias("n"))


@query
def live_lead_registration(i: Inputs) -> DataFrame:
    """Two snapshots of leads as two runs of one stream, merged into the stored dimension bucket by bucket."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        for sql, at in ((derived.RAW_LEADS_1, i.loaded), (derived.RAW_LEADS_2, i.reloaded)):
            i.raw(sql).coalesce(1).sortWithinPartitions("pos").drop("pos").write.mode("append").json(f"{root}/landing")
            stream = live.read_landing(i.spark, f"{root}/landing", "leads")
            live.start_leads(stream, warehouse, f"{root}/checkpoint", at=at).awaitTermination()

    return rounded(Warehouse(i.spark, i.once("live-leads", run)).read("dim_lead").drop("lead_key"))


@query
def landed_faults(i: Inputs) -> DataFrame:
    """Landed lines with a field nobody declared, and lines cut in the middle: each dead letter holds its line to the letter."""

    def run(root: str) -> None:
        line = F.concat(F.lit('{"lead_id": "d'), F.col("doc_id"), F.lit('", "Score": '), F.col("n_chars"), F.lit("}"))
        broken = F.col("doc_id") % 7 == 0
        keyless = F.concat(F.lit('{"Score": '), F.col("n_chars"), F.lit(', "source": "'), F.col("source"), F.lit('"}'))
        value = F.when(broken, F.substring(line, 1, 15)).when(F.col("doc_id") % 3 == 0, keyless).otherwise(line)
        i.table("documents").filter("n_chars IS NOT NULL AND source IS NOT NULL").select(value.alias("value")).write.text(f"{root}/leads.json")

    raw = files.read_entity(i.spark, i.once("landed-faults", run), "leads", json_lines=True)
    letters = clean.dead_letters(clean.route(raw, "leads"), "run_1", i.as_of)
    return letters.groupBy("error_type", "record_payload").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_same_file_copies(i: Inputs) -> DataFrame:
    """Copies of an id in one landed file, told apart by nothing but their place in it."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        i.raw(derived.RAW_EVENTS).repartition("id").sortWithinPartitions("pos").drop("pos").write.option("compression", "gzip").json(f"{root}/landing")
        stream = live.read_landing(i.spark, f"{root}/landing")
        live.start_ingest(stream, warehouse, f"{root}/checkpoint", at=i.as_of).awaitTermination()

    fact = Warehouse(i.spark, i.once("same-file-copies", run), buckets=8).read("fact_outreach_event")
    return rounded(fact.select("event_source_id", "event_type", "event_timestamp", "date_key", "event_status", "response_time_minutes"))


def _two_sources(i: Inputs) -> Warehouse:
    """A warehouse fed by two streams: events whose ids are made of whole texts, often too long to load, and webhooks with odd times."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        texts = i.table("documents").select(
            F.concat(F.lit("evt_"), F.col("text"), F.lit("_"), F.col("doc_id")).alias("id"), F.col("source").alias("agent_id"),
            F.lit("sent").alias("event_type"), F.lit("2024-01-15T08:30:00Z").alias("timestamp"),
        )
        # At the quickest level: whole texts hardly shrink more at a higher one.
        texts.write.option("compression", "gzip").option("zlib.compress.level", "BEST_SPEED").option("maxRecordsPerFile", landing.RECORDS_PER_FILE).json(f"{root}/events")
        turns = _turns(i).drop("pos").withColumn("created_at", F.when(F.col("action").isNull(), "never").otherwise(F.col("created_at")))
        turns.write.option("compression", "gzip").json(f"{root}/webhooks")
        events = live.read_landing(i.spark, f"{root}/events")
        hooks = live.read_landing(i.spark, f"{root}/webhooks", "webhooks")
        calls = live.webhook_payloads(live.with_arrival(hooks, i.as_of), ["_file", "_block"])
        for name, stream in (("events", events), ("webhooks", calls)):
            live.start_ingest(stream, warehouse, f"{root}/checkpoint-{name}", at=i.as_of).awaitTermination()

    return Warehouse(i.spark, i.once("two-sources", run), buckets=8)


@query
def stream_load_rejects(i: Inputs) -> DataFrame:
    """Records the fact cannot hold: a dead letter each, by the stage that rejected them."""
    letters = _two_sources(i).read("dead_letter_queue")
    return letters.groupBy("source", "error_type", "error_message").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_two_sources(i: Inputs) -> DataFrame:
    """Receipts of both streams next to what the fact holds."""
    warehouse = _two_sources(i)
    counted = F.count(F.lit(1)).alias("n")
    receipts = warehouse.read("live_receipts", live.RECEIPTS).groupBy("status", "event_type").agg(counted)
    stored = warehouse.read("fact_outreach_event").groupBy(F.lit("STORED").alias("status"), "event_type").agg(counted)
    return receipts.unionByName(stored)


@query
def replayed_duplicates(i: Inputs) -> DataFrame:
    """Each broken event has two letters, of which the later one was corrected: that one is loaded and resolved, the other stays."""
    letters = clean.dead_letters(i.routed("events", derived.RAW_EVENTS), "run_1", i.loaded).filter("error_type = 'bad_timestamp'")
    mended = F.regexp_replace("record_payload", "not-a-date", "2024-01-15 08:30:00")
    later = letters.withColumns({"record_payload": mended, "created_at": i.reloaded, "run_id": F.lit("run_2")})
    fixed, updated = clean.replay(letters.unionByName(later), "events", i.as_of)
    loaded = fixed.select("event_source_id", F.lit("loaded").alias("run_id"), F.lit(True).alias("resolved"))
    return updated.select(F.col("source_id").alias("event_source_id"), "run_id", "resolved").unionByName(loaded)


@query
def replayed_loader_rejects(i: Inputs) -> DataFrame:
    """A stored table of letters after replay: long names of leads were cut by hand, so those leads are loaded now."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        raw = i.table("documents").select(
            F.col("doc_id").alias("pos"), F.concat(F.lit("lead_d"), F.col("doc_id")).alias("lead_id"),
            F.col("lang").alias("first_name"), F.col("text").alias("last_name"), F.col("source").alias("segment"),
        )
        judged = clean.check_limits(clean.route(raw, "leads", ["pos"]), "dim_lead")
        letters = clean.dead_letters(judged, "run_1", i.loaded)
        shorter = F.regexp_replace("record_payload", '"last_name":".*","segment"', '"last_name":"Cut","segment"')
        warehouse.append("dead_letter_queue", letters.withColumn("record_payload", shorter), ["run_1"])
        batch.replay_letters(i.spark, root, datetime(2024, 1, 30), "leads", buckets=8)

    warehouse = Warehouse(i.spark, i.once("replayed-letters", run), buckets=8)
    letters = warehouse.read("dead_letter_queue").select("source_id", "source", "resolved")
    leads = warehouse.read("dim_lead").select("lead_id", "full_name")
    return letters.join(leads, letters["source_id"] == leads["lead_id"], "left").drop("lead_id")


@query
def replayed_bad_json(i: Inputs) -> DataFrame:
    """Landed lines that were cut before their end are letters of their entity: those mended by hand are loaded and resolved, the others stay."""

    def run(root: str) -> None:
        warehouse = Warehouse(i.spark, root, buckets=8)
        line = F.concat(F.lit('{"lead_id": "d'), F.col("doc_id"), F.lit('", "full_name": "Doc '), F.col("doc_id"), F.lit('"}'))
        cut = F.when(F.col("doc_id") % 7 == 0, F.expr("substring(line, 1, length(line) - 2)")).otherwise(F.col("line"))
        i.table("documents").select("doc_id", line.alias("line")).select(cut.alias("value")).write.text(f"{root}/landing/leads.json")
        raw = files.read_entity(i.spark, f"{root}/landing", "leads", json_lines=True)
        letters = clean.dead_letters(clean.check_limits(clean.route(raw, "leads"), "dim_lead"), "run_1", i.loaded, name="leads")
        mended = F.when(F.regexp_extract("record_payload", "Doc ([0-9]+)", 1).cast("long") % 2 == 1, F.concat("record_payload", F.lit('"}'))).otherwise(F.col("record_payload"))
        warehouse.append("dead_letter_queue", letters.withColumn("record_payload", mended), ["run_1"])
        batch.replay_letters(i.spark, root, datetime(2024, 1, 30), "leads", buckets=8)

    warehouse = Warehouse(i.spark, i.once("replayed-bad-json", run), buckets=8)
    letters = warehouse.read("dead_letter_queue").select("entity_name", "error_type", "resolved", F.regexp_extract("record_payload", "Doc ([0-9]+)", 1).alias("number"))
    leads = warehouse.read("dim_lead").select(F.regexp_replace("lead_id", "^d", "").alias("number"), "full_name")
    return letters.join(leads, "number", "left")


def _turns(i: Inputs) -> DataFrame:
    """Conversation turns as loosely named webhook payloads without ids."""
    return i.table("conversations").select(
        F.concat(F.lit("acc_"), F.col("role")).alias("account_id"), F.concat(F.lit("lead_"), F.col("conv_id")).alias("contact_id"),
        F.when(F.col("role") == "user", "reply").alias("action"),
        F.concat(F.lit("2024-02-01T00:"), F.lpad((F.col("turn") % 60).cast("string"), 2, "0"), F.lit(":00Z")).alias("created_at"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("pos"),
    )


@query
def webhook_events(i: Inputs) -> DataFrame:
    events = live.webhook_payloads(live.with_arrival(_turns(i), i.as_of), ["pos"])
    return rounded(clean.clean_rows(clean.route(events, "events", ["pos"])))


@query
def windowed_stream_activity(i: Inputs) -> DataFrame:
    """Days closed by the watermark, as a windowed stream aggregate over the events table."""

    def run(root: str) -> None:
        table = i.table("events")
        stream = i.spark.readStream.schema(table.schema).parquet(f"{i.sf_dir}/events*.parquet").select(
            F.col("event_id").cast("string").alias("event_source_id"),
            F.concat(F.lit("agent_"), F.floor(F.col("user_id") / 50)).alias("agent_id"),
            F.when(F.col("event_type") == "view", "INVITE_SENT").when(F.col("event_type") == "click", "ACCEPTED")
            .when(F.col("event_type") == "purchase", "MEETING_BOOKED").otherwise("FAILED").alias("event_type"),
            F.col("ts").cast("timestamp").alias("event_timestamp"),
        )
        sink = live.windowed_activity(stream).writeStream.format("parquet").outputMode("append")
        sink.option("checkpointLocation", f"{root}/checkpoint").option("path", f"{root}/days").trigger(availableNow=True).start().awaitTermination()

    days = i.spark.read.parquet(f"{i.once('windowed-stream', run)}/days")
    return days.withColumn("day", F.col("day").cast("string"))


# ── A whole batch run ─────────────────────────────────────────────────────────


@query
def batch_run_audit(i: Inputs) -> DataFrame:
    """Audit row of a full load of the derived entities into an empty warehouse."""

    def run(root: str) -> None:
        frames = {
            "agents": derived.RAW_AGENTS_1, "leads": derived.RAW_LEADS_1, "campaigns": derived.RAW_CAMPAIGNS_1,
            "templates": derived.RAW_TEMPLATES, "events": derived.RAW_EVENTS,
        }
        batch.run_batch(
            i.spark, "", root, datetime(2024, 1, 30), "run_1", buckets=8,
            entity_frames={name: (i.raw(sql), ["pos"]) for name, sql in frames.items()},
        )

    audit = Warehouse(i.spark, i.once("batch-warehouse", run), buckets=8).read("fact_pipeline_run")
    return audit.select("run_id", "rows_extracted", "rows_loaded", "rows_failed", "status", "dq_score", "dq_passed")
