"""Dimensions: static tables, type-1 and type-2 upserts, history (DM-1..DM-13)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions import ids, times
from funnelspark.operators.joins import lookup
from funnelspark.schemas import shape, table_schema

# Tier key, tier name, risk class, daily invite cap, daily message cap.
ACCOUNT_TIERS = [
    (1, "< 1 Month", "Very High Risk", 5, 10),
    (2, "1 Month", "High Risk", 10, 15),
    (3, "2-6 Months", "Moderate Risk", 15, 25),
    (4, "6-12 Months", "Low Risk", 25, 40),
    (5, "1+ Year", "Minimal Risk", 30, 60),
]

# First and last day of the calendar.
CALENDAR = ("2024-01-01", "2027-12-31")

# What a lead holds when nothing is known, and may therefore be filled in later.
CRM_COMPANY_DEFAULT = "Confidential"
CRM_TITLE_DEFAULT = "Recruiter"


def account_tiers(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({key}, '{name}', '{risk}', {invites}, {messages})" for key, name, risk, invites, messages in ACCOUNT_TIERS)
    columns = ", ".join(table_schema("dim_account_tier").names)
    # Inline VALUES keep their size visible to Catalyst, so joins with them broadcast.
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t({columns})")


def calendar(spark: SparkSession, first: str = CALENDAR[0], last: str = CALENDAR[1]) -> DataFrame:
    days = F.sequence(F.lit(first).cast("date"), F.lit(last).cast("date"), F.expr("interval 1 day"))
    day = F.col("full_date")
    return (
        spark.range(1).select(F.explode(days).alias("full_date"))
        .select(*[part.alias(name) for name, part in times.calendar_parts(day).items()])
    )


# ── Type 1 ────────────────────────────────────────────────────────────────────


def upsert(existing: DataFrame, incoming: DataFrame, key: str | list[str], update: list[str]) -> DataFrame:
    """Keyed upsert as a pure function; ``_action`` is insert, update, skip or keep.

    ``incoming`` holds one row per key. On a match the ``update`` columns take the incoming value, NULLs included;
    with no update columns a match changes nothing. ``existing`` rows that no incoming row names are kept.
    Both sides are unique per key, so no key can be heavier than two rows.
    """
    keys = [key] if isinstance(key, str) else key
    columns = existing.columns
    old = existing.select(*keys, F.struct(*columns).alias("_old"))
    new = incoming.select(*keys, F.struct(*[c for c in columns if c in incoming.columns]).alias("_new"))
    both = old.join(new, keys, "full_outer")
    given = set(incoming.columns)
    update = [c for c in update if c in given]
    absent, fresh = F.col("_new").isNull(), F.col("_old").isNull()
    changed = F.lit(False)
    for c in update:
        changed = changed | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    action = F.when(absent, "keep").when(fresh, "insert").when(changed, "update").otherwise("skip")

    def value(c: str) -> Column:
        kind = existing.schema[c].dataType
        inserted = F.col(f"_new.{c}") if c in given else F.lit(None).cast(kind)
        kept = F.col(f"_old.{c}")
        matched = F.col(f"_new.{c}") if c in update else kept
        return F.when(absent, kept).when(fresh, inserted).otherwise(matched).cast(kind).alias(c)

    return both.select(*[value(c) for c in columns], action.alias("_action"))


def load_counts(acted: DataFrame) -> DataFrame:
    """Load outcome per action; rows the load did not touch are not counted."""
    return acted.filter(F.col("_action") != "keep").groupBy(F.col("_action").alias("action")).agg(
        F.count(F.lit(1)).alias("n")
    )


def merge_campaigns(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    rows = incoming.withColumn("campaign_key", ids.surrogate_key(F.col("campaign_id")))
    return upsert(existing, rows, "campaign_id", ["campaign_name", "campaign_type", "target_segment"])


def merge_templates(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    rows = incoming.withColumn("template_key", ids.surrogate_key(F.col("template_id")))
    return upsert(existing, rows, "template_id", ["template_name", "template_body", "channel"])


def seed_tiers(existing: DataFrame) -> DataFrame:
    """Add missing tiers; tiers already there stay as they are."""
    return upsert(existing, account_tiers(existing.sparkSession), "tier_name", [])


# ── Type 2 ────────────────────────────────────────────────────────────────────


def merge_versions(
    existing: DataFrame, incoming: DataFrame, key: str, surrogate: str, tracked: list[str], as_of: Column
) -> DataFrame:
    """Type-2 merge: a change in a tracked column closes the current version and opens a new one.

    Everything else about an unchanged version stays as first loaded. One full outer join of current versions
    and incoming rows (both unique per key) decides; an array of one or two versions per key is then
    unfolded, so neither side is read twice. Closed history passes by untouched.
    """
    columns = existing.columns
    current = existing.filter("is_current").select(key, F.struct(*columns).alias("_old"))
    opened = incoming.withColumns(
        {
            "valid_from": as_of,
            "valid_to": F.lit(None).cast("timestamp"),
            "is_current": F.lit(True),
            surrogate: ids.surrogate_key(F.col(key), as_of),
        }
    )
    new = opened.select(
        key,
        F.struct(*[F.col(c).cast(existing.schema[c].dataType).alias(c) for c in columns]).alias("_new"),
    )
    both = current.join(new, key, "full_outer")
    differs = F.lit(False)
    for c in tracked:
        differs = differs | ~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}"))
    absent, fresh = F.col("_new").isNull(), F.col("_old").isNull()
    action = F.when(absent, "keep").when(fresh, "insert").when(differs, "update").otherwise("skip")
    closed = F.col("_old").withField("valid_to", as_of).withField("is_current", F.lit(False))
    closed = F.struct(*[closed.getField(c).alias(c) for c in columns])

    def tagged(version: Column, label: Column | str) -> Column:
        label = F.lit(label) if isinstance(label, str) else label
        return F.struct(version.alias("v"), label.alias("a"))

    versions = (
        F.when(action == "insert", F.array(tagged(F.col("_new"), "insert")))
        .when(action == "update", F.array(tagged(closed, "close"), tagged(F.col("_new"), "update")))
        .otherwise(F.array(tagged(F.col("_old"), action)))
    )
    merged = both.select(F.explode(versions).alias("x")).select("x.v.*", F.col("x.a").alias("_action"))
    history = existing.filter("NOT is_current").withColumn("_action", F.lit("keep"))
    return merged.unionByName(history)


def version_counts(merged: DataFrame) -> DataFrame:
    """insert / update / skip per incoming row (the closing half of an update is not a row of its own)."""
    return load_counts(merged.filter(F.col("_action") != "close"))


def merge_agents(existing: DataFrame, incoming: DataFrame, tiers: DataFrame, as_of: Column) -> DataFrame:
    """Type-2 agents; status and tier are tracked. The tier name resolves to its key first."""
    tiered = lookup(incoming, tiers.select("tier_name", "tier_key"), "tier_name", "tier_key")
    return merge_versions(existing, tiered, "agent_id", "agent_key", ["status", "tier_key"], as_of)


def merge_leads(existing: DataFrame, incoming: DataFrame, as_of: Column) -> DataFrame:
    return merge_versions(existing, incoming, "lead_id", "lead_key", ["segment", "lead_status"], as_of)


def current(dim: DataFrame) -> DataFrame:
    return dim.filter("is_current")


def versions_at(dim: DataFrame, at: Column) -> DataFrame:
    """The version of every entity that was valid at a time."""
    return dim.filter((F.col("valid_from") <= at) & (F.col("valid_to").isNull() | (at < F.col("valid_to"))))


# ── Imports ───────────────────────────────────────────────────────────────────


def ensure_row(existing: DataFrame, key: str, row: dict, surrogate: str, as_of: Column) -> DataFrame:
    """Add one default row (an importer's own agent or campaign) unless its key is already there."""
    spark = existing.sparkSession
    columns = {c: F.lit(v) for c, v in row.items()}
    if "valid_from" in existing.columns:
        columns |= {"valid_from": as_of, "is_current": F.lit(True), surrogate: ids.surrogate_key(columns[key], as_of)}
    else:
        columns |= {"created_at": as_of, surrogate: ids.surrogate_key(columns[key])}
    one = spark.range(1).select(*[
        (columns[f.name] if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in existing.schema.fields
    ])
    have = existing.filter("is_current") if "is_current" in existing.columns else existing
    missing = one.join(have.filter(F.col(key) == row[key]).select(key), key, "left_anti")
    return existing.unionByName(missing)


def _first_known(field: str, default: str) -> Column:
    """First value of a field, by position, that is more than its placeholder."""
    return F.min_by(field, F.when(~F.col(field).isin("", default), F.col("_pos"))).alias(field)


def crm_leads(rows: DataFrame) -> DataFrame:
    """One row per lead out of CRM export rows: first known company and title, first name, address and
    segment, last status. All combine map-side, so a lead repeated often arrives as one row per task."""
    return rows.groupBy("lead_id").agg(
        F.min_by("full_name", "_pos").alias("full_name"),
        _first_known("company", CRM_COMPANY_DEFAULT),
        _first_known("title", CRM_TITLE_DEFAULT),
        F.min_by("linkedin_url", "_pos").alias("linkedin_url"),
        F.min_by("segment", "_pos").alias("segment"),
        F.max_by("lead_status", "_pos").alias("lead_status"),
    )


def refresh_leads(dim: DataFrame, leads: DataFrame, as_of: Column) -> DataFrame:
    """In-place refresh of current leads from a CRM export: the status is overwritten, company and title
    are filled only where they hold a placeholder; unknown leads are added. ``leads`` as from ``crm_leads``."""
    columns = dim.columns
    new = leads.select("lead_id", F.struct("*").alias("_new"))
    both = dim.filter("is_current").select("lead_id", F.struct(*columns).alias("_old")).join(new, "lead_id", "full_outer")
    fresh, absent = F.col("_old").isNull(), F.col("_new").isNull()

    def fill(field: str, default: str) -> Column:
        old, given = F.col(f"_old.{field}"), F.col(f"_new.{field}")
        return F.when(fresh, F.coalesce(given, F.lit(default))).when(old.isin("", default), F.coalesce(given, old)).otherwise(old)

    values = {
        "company": fill("company", CRM_COMPANY_DEFAULT),
        "title": fill("title", CRM_TITLE_DEFAULT),
        "lead_status": F.when(absent, F.col("_old.lead_status")).otherwise(F.col("_new.lead_status")),
        "lead_key": F.when(fresh, ids.surrogate_key(F.col("lead_id"), as_of)).otherwise(F.col("_old.lead_key")),
        "valid_from": F.when(fresh, as_of).otherwise(F.col("_old.valid_from")),
        "valid_to": F.col("_old.valid_to"),
        "is_current": F.lit(True),
        "lead_id": F.col("lead_id"),
    }
    for c in ("full_name", "linkedin_url", "segment"):
        values[c] = F.when(fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}"))
    action = F.when(absent, "keep").when(fresh, "insert").otherwise("update")
    merged = both.select(*[values[c].alias(c) for c in columns], action.alias("_action"))
    return merged.unionByName(dim.filter("NOT is_current").withColumn("_action", F.lit("keep")))


def empty(spark: SparkSession, table: str) -> DataFrame:
    """A table before its first load; Catalyst drops joins and unions with it."""
    return shape(spark.range(0), table).limit(0)


