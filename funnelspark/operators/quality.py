"""Data-quality checks, composite score and history (DQ-1..DQ-10).

A check is one row: dimension, table, score 0-100, details as JSON. Counts of one table come from one
scan; distinct counts and key references shuffle pre-aggregated keys only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions import numbers, text
from funnelspark.operators import dims
from funnelspark.operators.joins import lookup
from funnelspark.schemas import shape

# Weight of each dimension in the composite, and the score a run passes with.
DIMENSION_WEIGHTS = {
    "completeness": 0.25,
    "uniqueness": 0.20,
    "validity": 0.25,
    "timeliness": 0.15,
    "referential_integrity": 0.15,
}
PASS_THRESHOLD = 85.0
SLA_HOURS = 24

# The columns each table must fill, its key, and what its keys refer to.
REQUIRED = {
    "fact_outreach_event": ["event_source_id", "event_type", "event_timestamp"],
    "fact_daily_agent_activity": ["agent_key", "date_key"],
    "dim_agent": ["agent_id", "status"],
    "dim_lead": ["lead_id"],
    "dim_campaign": ["campaign_id"],
}
UNIQUE = {
    "fact_outreach_event": "event_source_id",
    "dim_agent": "agent_id",
    "dim_lead": "lead_id",
    "dim_campaign": "campaign_id",
    "dim_message_template": "template_id",
}
# fact → its foreign keys: (column, dimension, dimension key)
REFERENCES = {
    "fact_outreach_event": [
        ("agent_key", "dim_agent", "agent_key"),
        ("lead_key", "dim_lead", "lead_key"),
        ("campaign_key", "dim_campaign", "campaign_key"),
        ("date_key", "dim_date", "date_key"),
    ],
    "fact_daily_agent_activity": [("agent_key", "dim_agent", "agent_key"), ("date_key", "dim_date", "date_key")],
    "fact_campaign_performance": [("campaign_key", "dim_campaign", "campaign_key")],
}


# dimension → its surrogate key, one per row (type-2 versions have keys of their own).
SURROGATES = {"dim_agent": "agent_key", "dim_lead": "lead_key", "dim_campaign": "campaign_key", "dim_message_template": "template_key"}


def key_collisions(tables: dict[str, DataFrame]) -> DataFrame:
    """Per dimension: its rows, and the surrogate keys that more than one of them has. Keys are 64-bit hashes, so any collision means wrong joins."""
    parts = []
    for name, surrogate in SURROGATES.items():
        per_key = tables[name].groupBy(surrogate).agg(F.count(F.lit(1)).alias("n"))
        parts.append(per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count_if(F.col("n") > 1).alias("collisions")).select(F.lit(name).alias("table_name"), "n_rows", "collisions"))
    return union_all(parts)


def _check(dimension: str, table: Column | str, score: Column, details: Column) -> Column:
    table = F.lit(table) if isinstance(table, str) else table
    return F.struct(
        F.lit(dimension).alias("check_dimension"), table.alias("table_name"), score.alias("score"),
        F.to_json(details).alias("details"),
    )


def _profile_flags(required: list[str], as_of: Column | None, types: bool) -> dict[str, Column]:
    """What of a row counts against completeness, type validity and timeliness."""
    flags = {f"null_{c}": F.col(c).isNull() for c in required}
    if types:
        flags["bad_type"] = text.is_unknown_type(F.col("event_type"))
    if as_of is not None:
        flags["stale"] = F.col("loaded_at") < as_of - F.expr(f"interval {SLA_HOURS} hours")
    return flags


def _profile_checks(table: str, required: list[str], as_of: Column | None, types: bool, n: Column) -> list[Column]:
    """Checks out of the number of rows and the counts of ``_profile_flags``."""
    nulls = sum((F.col(f"null_{c}") for c in required), F.lit(0))
    cells = n * len(required)
    checks = [_check(
        "completeness", table, numbers.share_score(cells - nulls, cells),
        F.struct(F.struct(*[F.col(f"null_{c}").alias(c) for c in required]).alias("null_counts"), n.alias("total_rows")),
    )] if required else []
    if types:
        checks.append(_check(
            "validity", f"{table}.event_type", numbers.share_score(n - F.col("bad_type"), n),
            F.struct(F.col("bad_type").alias("invalid_event_types")),
        ))
    if as_of is not None:
        fresh = n - F.col("stale")
        checks.append(_check(
            "timeliness", table, numbers.share_score(fresh, n),
            F.struct(n.alias("total"), fresh.alias("fresh"), F.col("stale"), F.lit(SLA_HOURS).alias("sla_hours")),
        ))
    return checks


def table_profile(
    df: DataFrame, table: str, required: list[str], as_of: Column | None = None, types: bool = False
) -> DataFrame:
    """Completeness and, for an event table, type validity and timeliness, all from one pass."""
    counts = [F.count_if(flag).alias(name) for name, flag in _profile_flags(required, as_of, types).items()]
    checks = _profile_checks(table, required, as_of, types, F.col("n"))
    return df.agg(F.count(F.lit(1)).alias("n"), *counts).select(F.inline(F.array(*checks)))


def _unique_check(table: str, distinct: Column, total: Column, current_only: bool) -> Column:
    details = F.struct(distinct.alias("distinct"), total.alias("total_current" if current_only else "total"))
    return _check("uniqueness", table, numbers.share_score(distinct, total), details)


def _reference_check(table: str, total: Column, orphans: Column) -> Column:
    return _check(
        "referential_integrity", F.concat(F.lit(f"{table}."), F.col("fk")), numbers.share_score(total - orphans, total),
        F.struct(total.alias("total_fks"), orphans.alias("orphans")),
    )


def uniqueness(df: DataFrame, table: str, key: str | list[str], current_only: bool = False) -> DataFrame:
    """Distinct non-NULL keys over rows (over current rows for a versioned table).

    Grouping by key first keeps one row per key and map task, whatever a key's share of the table.
    """
    keys = [key] if isinstance(key, str) else key
    rows = dims.current(df) if current_only else df
    whole = F.lit(True)
    for c in keys:
        whole = whole & F.col(c).isNotNull()
    per_key = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    counted = per_key.agg(
        F.count_if(whole).alias("distinct"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    )
    return counted.select(F.inline(F.array(_unique_check(table, F.col("distinct"), F.col("total"), current_only))))


def tier_validity(activity: DataFrame, agents: DataFrame, tiers: DataFrame) -> DataFrame:
    """Agent-days within the tier's daily invite cap; an agent without a tier cannot exceed it."""
    caps = lookup(dims.current(agents).select("agent_key", "tier_key"), tiers, "tier_key", "daily_invite_limit")
    judged = lookup(activity.select("agent_key", "invites_sent"), caps, "agent_key", "daily_invite_limit")
    counted = judged.agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("invites_sent") > F.col("daily_invite_limit")).alias("bad")
    )
    check = _check(
        "validity", "fact_daily_agent_activity.tier_limits", numbers.share_score(F.col("n") - F.col("bad"), F.col("n")),
        F.struct(F.col("bad").alias("tier_limit_violations")),
    )
    return counted.select(F.inline(F.array(check)))


def references(fact: DataFrame, table: str, foreign: list[tuple[str, DataFrame, str]]) -> DataFrame:
    """Orphans of all foreign keys of one fact from one scan and one shuffle, without a join.

    Fact values and dimension keys meet in one (column, value) grouping. Map tasks combine first, so a value
    that fills a third of the fact arrives as one row per task. NULLs are no references: they count 0. One such row per key is
    added, so that a key is reported (with 100) even if fact and dimension are both empty.
    """
    keys = F.array(*[F.struct(F.lit(c), F.lit(None).cast("string"), F.lit(0), F.lit(False)) for c, _, _ in foreign])
    pairs = F.array(*[
        F.struct(F.lit(c).alias("fk"), F.col(c).cast("string").alias("value"), F.col(c).isNotNull().cast("int").alias("n"))
        for c, _, _ in foreign
    ])
    used = fact.select(F.inline(pairs)).select("fk", "value", "n", F.lit(False).alias("known"))
    used = used.unionAll(fact.sparkSession.range(1).select(F.inline(keys)))
    for c, dim, pk in foreign:
        used = used.unionAll(dim.select(F.lit(c), F.col(pk).cast("string"), F.lit(0), F.lit(True)))
    per_value = used.groupBy("fk", "value").agg(F.sum("n").alias("n"), F.max("known").alias("known"))
    per_key = per_value.groupBy("fk").agg(
        F.sum("n").alias("total"), F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("orphans")
    )
    return per_key.select(F.inline(F.array(_reference_check(table, F.col("total"), F.col("orphans")))))


WHOLE = ("tinyint", "smallint", "int", "bigint")


def table_checks(
    df: DataFrame, table: str, required: list[str] = (), unique: str | None = None, current_only: bool = False,
    foreign: list[tuple[str, DataFrame, str]] = (), as_of: Column | None = None, types: bool = False,
) -> DataFrame:
    """Profile, uniqueness and references of one table from one scan and one shuffle.

    Each row becomes one entry for itself (its key, its flags) and one per foreign key. All are grouped by (kind, value) with the dimensions' keys,
    combined map-side first; a second, tiny grouping makes one row per kind. An empty table scores 100 in every check.
    """
    flags = _profile_flags(list(required), as_of, types)
    wide = dict(df.dtypes)
    # Whole numbers stay numbers where both sides are; anything else meets as text.
    whole = {c: wide[c] in WHOLE and dict(dim.dtypes)[pk] in WHOLE for c, dim, pk in foreign}

    def entry(kind: str, value: Column, n: Column, number: bool, known: bool = False, own: bool = False) -> Column:
        none = F.lit(None)
        return F.struct(
            F.lit(kind).alias("fk"), (value if number else none).cast("bigint").alias("number"), (none if number else value).cast("string").alias("text"),
            n.cast("bigint").alias("n"), F.lit(known).alias("known"), F.lit(int(own)).cast("bigint").alias("rows"),
            *[(F.coalesce(flag, F.lit(False)).cast("bigint") if own else F.lit(0).cast("bigint")).alias(name) for name, flag in flags.items()],
        )

    counted = F.col("is_current") if current_only else F.lit(True)
    own = entry("", F.col(unique) if unique else F.lit(None), F.coalesce(counted, F.lit(False)), False, own=True)
    used = df.select(F.inline(F.array(own, *[entry(c, F.col(c), F.col(c).isNotNull(), whole[c]) for c, _, _ in foreign])))
    nothing = [entry(kind, F.lit(None), F.lit(0), whole.get(kind, False)) for kind in ("", *whole)]
    used = used.unionAll(df.sparkSession.range(1).select(F.inline(F.array(*nothing))))
    # Without rows there is no reference to look up: the dimensions are not read.
    for c, dim, pk in foreign if foreign and not df.isEmpty() else []:
        used = used.unionAll(dim.select(F.inline(F.array(entry(c, F.col(pk), F.lit(0), whole[c], known=True)))))
    sums = [F.sum(name).alias(name) for name in ("n", "rows", *flags)]
    per_value = used.groupBy("fk", "number", "text").agg(F.max("known").alias("known"), *sums)
    per_kind = per_value.groupBy("fk").agg(
        F.count_if(F.col("text").isNotNull() & (F.col("n") > 0)).alias("distinct"),
        F.sum(F.when(F.col("known"), 0).otherwise(F.col("n"))).alias("orphans"), *sums,
    )
    checks = _profile_checks(table, list(required), as_of, types, F.col("rows"))
    if unique:
        checks.append(_unique_check(table, F.col("distinct"), F.col("n"), current_only))
    references_of = F.array(_reference_check(table, F.col("n"), F.col("orphans")))
    return per_kind.select(F.inline(F.when(F.col("fk") != "", references_of).otherwise(F.array(*checks) if checks else F.slice(references_of, 1, 0))))


def run_checks(tables: dict[str, DataFrame], as_of: Column) -> DataFrame:
    """All checks over a warehouse (a name → DataFrame mapping); each table is scanned once, the activity mart once more for its tier limits."""
    parts = []
    for table in dict.fromkeys([*REQUIRED, *UNIQUE, *REFERENCES]):
        event = table == "fact_outreach_event"
        foreign = [(c, tables[d], k) for c, d, k in REFERENCES.get(table, [])]
        parts.append(table_checks(
            tables[table], table, REQUIRED.get(table, []), UNIQUE.get(table), table in ("dim_agent", "dim_lead"), foreign, as_of if event else None, event
        ))
    parts.append(tier_validity(tables["fact_daily_agent_activity"], tables["dim_agent"], tables["dim_account_tier"]))
    return union_all(parts)


def union_all(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def dimension_scores(checks: DataFrame) -> DataFrame:
    return checks.groupBy("check_dimension").agg(F.avg("score").alias("dimension_score"))


def _weights(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"('{name}', {weight}D)" for name, weight in DIMENSION_WEIGHTS.items())
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(check_dimension, weight)")


def composite(checks: DataFrame, threshold: float = PASS_THRESHOLD) -> DataFrame:
    """One row: weighted composite to 2 places, and whether it passes. A dimension without checks scores 100."""
    weighted = _weights(checks.sparkSession).join(dimension_scores(checks), "check_dimension", "left")
    total = F.sum(F.coalesce(F.col("dimension_score"), F.lit(100.0)) * F.col("weight"))
    return weighted.agg(F.round(total, 2).alias("composite_score")).withColumn(
        "passed", F.col("composite_score") >= threshold
    )


def history_rows(checks: DataFrame, run_id: str, checked_at: Column, threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Check rows with their weight and the run's composite, ready to append."""
    run = F.lit(run_id).alias("run_id")
    verdict = composite(checks, threshold).withColumn("run_id", run)
    rows = checks.join(_weights(checks.sparkSession), "check_dimension", "left").withColumn("run_id", run)
    return shape(rows.join(verdict, "run_id").withColumn("checked_at", checked_at), "dq_results")


def score_trend(history: DataFrame) -> DataFrame:
    """Average composite per check time."""
    return history.groupBy("checked_at").agg(F.avg("composite_score").alias("composite_score"))


def latest_score(history: DataFrame, threshold: float = PASS_THRESHOLD) -> DataFrame:
    """Composite at the last check time, with its label."""
    latest = history.agg(F.max(F.struct("checked_at", "composite_score")).alias("x"))
    return latest.select("x.checked_at", "x.composite_score").withColumn(
        "label", F.when(F.col("composite_score") >= threshold, "Pass").otherwise("Fail")
    )
