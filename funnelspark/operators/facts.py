"""The event fact: key resolution, idempotent upsert, import-derived events (FA-1, FA-2, FA-4..FA-6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from funnelspark.functions import ids, text, times
from funnelspark.operators import dims
from funnelspark.operators.joins import lookup
from funnelspark.schemas import shape

# What a repeated event may change; everything else stays as first loaded.
EVENT_UPDATES = ["event_status", "response_time_minutes"]

# dimension table → (natural key, surrogate key, kept in versions, may outgrow a broadcast)
DIMENSIONS = {
    "dim_agent": ("agent_id", "agent_key", True, False),
    "dim_lead": ("lead_id", "lead_key", True, True),
    "dim_campaign": ("campaign_id", "campaign_key", False, False),
    "dim_message_template": ("template_id", "template_key", False, False),
}


def resolve_keys(events: DataFrame, tables: dict[str, DataFrame], large: set[str] | None = None) -> DataFrame:
    """Natural ids → surrogate keys for the dimensions in ``tables``; unresolved ids give NULL and the event stays.

    Versioned dimensions resolve to their current version. ``large`` names the dimensions that get the
    skew-proof lookup of ``joins.lookup`` (by default leads, the one dimension that grows with the data).
    """
    out = events
    for table, dim in tables.items():
        natural, surrogate, versioned, big = DIMENSIONS[table]
        big = big if large is None else table in large
        rows = dims.current(dim) if versioned else dim
        out = lookup(out, rows, natural, surrogate, large=big, spread=F.col("event_source_id"), keys_of=events)
    return out


def resolve_keys_at(events: DataFrame, dim: DataFrame, table: str, at: str = "event_timestamp", block: int = 3600) -> DataFrame:
    """Point-in-time resolution: the key of the version that was valid when the event happened.

    Events and versions are sorted together by id and time, and the last version before an event is its own, unless that has ended: the work is
    linear in both, however many versions an id has. A hot id is split into blocks of ``block`` seconds. The version that a block begins with comes
    from a small sort per id, of its versions and, one row each, the blocks that hold events. Events without id or time, or outside of all versions,
    have no key. Versions of one id do not overlap; one that ends when it begins is valid for no event.
    """
    natural, surrogate, _, _ = DIMENSIONS[table]
    known = F.col(natural).isNotNull() & F.col(at).isNotNull()
    # Events that cannot have a version are spread, whatever their share.
    spread = -1 - F.pmod(F.xxhash64(*events.columns), F.lit(4096))
    moved = events.select("*", F.col(natural).alias("_id"), F.when(known, F.floor(F.unix_seconds(at) / block)).otherwise(spread).alias("_block"),
                          F.col(at).alias("_at"), known.alias("_known"), F.lit(True).alias("_event"))
    version = F.struct(F.col("valid_from").alias("from"), F.col("valid_to").alias("to"), F.col(surrogate).alias("key")).alias("_version")
    living = F.col("valid_from").isNotNull() & (F.col("valid_to").isNull() | (F.col("valid_from") < F.col("valid_to")))
    versions = dim.filter(living & F.col(natural).isNotNull()).select(
        F.col(natural).alias("_id"), F.floor(F.unix_seconds("valid_from") / block).alias("_block"), F.col("valid_from").alias("_at"), version
    )
    # Blocks begin before their first version: what an earlier version left is handed on to the block's events.
    blocks = moved.filter("_known").select("_id", "_block").distinct().withColumn("_at", F.timestamp_seconds(F.col("_block") * block))
    per_id = Window.partitionBy("_id").orderBy("_at", F.col("_version").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    begun = versions.unionByName(blocks, allowMissingColumns=True).select(
        "_id", "_block", "_at", F.last("_version", ignorenulls=True).over(per_id).alias("_begun"), F.col("_version").isNull().alias("_start")
    ).filter("_start AND _begun IS NOT NULL").select("_id", "_block", "_at", F.col("_begun").alias("_version"))
    rows = moved.unionByName(versions.unionByName(begun).withColumn("_event", F.lit(False)), allowMissingColumns=True)
    # At one time: what the block begins with, then a version that begins there, then events.
    order = Window.partitionBy("_id", "_block").orderBy("_at", "_event", "_version.from").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_last", F.last("_version", ignorenulls=True).over(order)).filter("_event")
    valid = F.col("_known") & (F.col("_last.to").isNull() | (F.col(at) < F.col("_last.to")))
    return found.select(*events.columns, F.when(valid, F.col("_last.key")).alias(surrogate))


def backfill_keys(fact: DataFrame, ids_of: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """Fill NULL keys of events loaded before their dimension row (``ids_of``: event id + natural ids)."""
    keys = {DIMENSIONS[t][1]: f"_{DIMENSIONS[t][1]}" for t in tables}
    found = resolve_keys(ids_of, tables).select("event_source_id", *[F.col(k).alias(v) for k, v in keys.items()])
    joined = fact.join(found, "event_source_id", "left")
    return joined.withColumns({k: F.coalesce(k, v) for k, v in keys.items()}).select(*fact.columns)


def as_fact(events: DataFrame, loaded_at: Column) -> DataFrame:
    """Resolved events in the shape of the fact table."""
    keyed = events.withColumn("event_key", ids.surrogate_key(F.col("event_source_id"))).withColumn("loaded_at", loaded_at)
    return shape(keyed, "fact_outreach_event")


def upsert_events(fact: DataFrame, incoming: DataFrame) -> DataFrame:
    """Idempotent load: new ids are added, known ids take status and response time only."""
    return dims.upsert(fact, incoming, "event_source_id", EVENT_UPDATES)


def latest_of_batch(events: DataFrame, order: Column) -> DataFrame:
    """One row per id out of repeated deliveries: fixed columns from the first, updatable ones from the last.

    Both are min_by / max_by aggregates, combined map-side, whatever an id's share.
    """
    key, fixed = "event_source_id", [c for c in events.columns if c not in {"event_source_id", *EVENT_UPDATES}]
    first = F.min_by(F.struct(*fixed), order).alias("_first")
    last = F.max_by(F.struct(*EVENT_UPDATES), order).alias("_last")
    return events.groupBy(key).agg(first, last).select(key, "_first.*", "_last.*").select(*events.columns)


def absent_from(events: DataFrame, fact: DataFrame) -> DataFrame:
    """Insert-if-absent: the events whose id the fact does not hold yet."""
    return events.join(fact.select("event_source_id"), "event_source_id", "left_anti")


# ── Events derived from imports ───────────────────────────────────────────────

# The agent and campaign an archive import books its events on.
ARCHIVE_AGENT = {"agent_id": "my_live_account", "display_name": "My LinkedIn Account", "status": "active", "tier_key": 5}
ARCHIVE_CAMPAIGN = {
    "campaign_id": "camp_personal_network",
    "campaign_name": "Personal LinkedIn Network",
    "campaign_type": "ORGANIC_NETWORK",
    "target_segment": "Professional Network",
}
ARCHIVE_SEGMENT = "1st Degree Connections"


def archive_connections(rows: DataFrame, load_time: Column) -> DataFrame:
    """Connection rows → lead attributes and ACCEPTED time, one row per lead (the first in its file order)."""
    known = rows.filter((F.col("first_name") != "") | (F.col("last_name") != ""))
    url = F.concat(F.lit("https://linkedin.com/in/"), F.lower("first_name"), F.lit("-"), F.lower("last_name"))
    leads = known.select(
        text.strip(text.first_filled(F.col("url"), url)).alias("linkedin_url"),
        text.strip(F.concat_ws(" ", "first_name", "last_name")).alias("full_name"),
        text.strip(text.first_filled(F.col("company"), F.lit("Self-Employed"))).alias("company"),
        text.strip(text.first_filled(F.col("title"), F.lit("Professional"))).alias("title"),
        F.coalesce(times.parse_archive_time(F.col("connected_on")), load_time).alias("connected_at"),
        "_pos",
    ).withColumn("lead_id", ids.md5_id("real_lead_", F.col("linkedin_url")))
    values = [c for c in leads.columns if c not in ("lead_id", "_pos")]
    firsts = leads.groupBy("lead_id").agg(F.min_by(F.struct(*values), "_pos").alias("x"))
    return firsts.select("lead_id", "x.*").withColumns(
        {"segment": F.lit(ARCHIVE_SEGMENT), "lead_status": F.lit("CONNECTED")}
    )


def connection_events(connections: DataFrame, agent_id: str, campaign_id: str) -> DataFrame:
    """One ACCEPTED event per connected lead."""
    at = F.col("connected_at")
    return connections.select(
        F.concat(F.lit("evt_conn_"), F.col("lead_id")).alias("event_source_id"),
        F.lit(agent_id).alias("agent_id"),
        "lead_id",
        F.lit(campaign_id).alias("campaign_id"),
        F.lit("ACCEPTED").alias("event_type"),
        at.alias("event_timestamp"),
        times.date_key(at).alias("date_key"),
        F.lit("SUCCESS").alias("event_status"),
    )


def invitation_events(rows: DataFrame, agent_id: str, campaign_id: str, load_time: Column) -> DataFrame:
    """One INVITE_SENT event per outgoing invitation (a row without a direction is outgoing)."""
    outgoing = F.upper(text.strip(text.first_filled(F.col("direction"), F.lit("OUTGOING")))).contains("OUTGOING")
    at = F.coalesce(times.parse_archive_time(F.col("sent_at")), load_time)
    person = text.strip(F.coalesce(F.col("to"), F.lit("")))
    sent = rows.filter(outgoing).select(
        ids.md5_id("evt_inv_", F.concat(person, F.date_format(at, "yyyy-MM-dd HH:mm:ss"))).alias("event_source_id"),
        at.alias("event_timestamp"),
    )
    # Equal ids mean equal person and time, so any of the copies will do.
    return sent.distinct().select(
        "event_source_id",
        F.lit(agent_id).alias("agent_id"),
        F.lit(None).cast("string").alias("lead_id"),
        F.lit(campaign_id).alias("campaign_id"),
        F.lit("INVITE_SENT").alias("event_type"),
        "event_timestamp",
        times.date_key(F.col("event_timestamp")).alias("date_key"),
        F.lit("SUCCESS").alias("event_status"),
    )


def crm_events(rows: DataFrame, agent_id: str, campaign_id: str, load_time: Column) -> DataFrame:
    """Up to two events per CRM export row, one of each kind per lead (the lead's first such row).

    INVITE_SENT needs a sent time or a status that mentions invite or connect; ACCEPTED a connected time or a
    status that mentions connect. Missing times fall back to the added time (invites) and the load time.
    """
    status = F.lower("status_raw")
    sent, accepted, added = F.col("sent_at"), F.col("connected_at"), F.col("added_on")
    connected = F.coalesce(accepted, load_time)

    def event(kind: str, prefix: str, at: Column, minutes: Column) -> Column:
        return F.struct(
            F.concat(F.lit(prefix), F.col("lead_id")).alias("event_source_id"),
            F.lit(kind).alias("event_type"),
            at.alias("event_timestamp"),
            minutes.cast("int").alias("response_time_minutes"),
        )

    invite = F.when(
        sent.isNotNull() | status.contains("invite") | status.contains("connect"),
        event("INVITE_SENT", "evt_sent_", F.coalesce(sent, added, load_time), F.lit(None)),
    )
    accept = F.when(
        accepted.isNotNull() | status.contains("connect"),
        event("ACCEPTED", "evt_acc_", connected, times.response_minutes(sent, connected)),
    )
    each = rows.select("lead_id", "_pos", F.explode(F.filter(F.array(invite, accept), lambda e: e.isNotNull())).alias("e"))
    firsts = each.groupBy(F.col("e.event_source_id").alias("event_source_id")).agg(
        F.min_by(F.struct("lead_id", "e"), "_pos").alias("x")
    )
    return firsts.select(
        "event_source_id",
        F.lit(agent_id).alias("agent_id"),
        F.col("x.lead_id").alias("lead_id"),
        F.lit(campaign_id).alias("campaign_id"),
        F.col("x.e.event_type").alias("event_type"),
        F.col("x.e.event_timestamp").alias("event_timestamp"),
        times.date_key(F.col("x.e.event_timestamp")).alias("date_key"),
        F.lit("SUCCESS").alias("event_status"),
        F.col("x.e.response_time_minutes").alias("response_time_minutes"),
    )


def chronology(fact: DataFrame, by: list[str] = ("agent_key", "lead_key")) -> DataFrame:
    """Per agent and lead: first invite, first acceptance, and whether they are in order."""
    first = {
        "first_invite": F.min(F.when(F.col("event_type") == "INVITE_SENT", F.col("event_timestamp"))),
        "first_accept": F.min(F.when(F.col("event_type") == "ACCEPTED", F.col("event_timestamp"))),
    }
    known = fact.dropna(subset=list(by)).filter(F.col("event_type").isin("INVITE_SENT", "ACCEPTED"))
    pairs = known.groupBy(*by).agg(*[v.alias(k) for k, v in first.items()])
    return pairs.filter("first_accept IS NOT NULL AND first_invite IS NOT NULL").withColumn(
        "in_order", F.col("first_accept") >= F.col("first_invite")
    )
