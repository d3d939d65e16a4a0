"""Clean, validate and route raw records (CL-1..CL-10).

Each entity is a list of column expressions plus an ordered list of reject rules. One pass turns raw rows
into typed rows carrying ``_reject`` (NULL = clean); the two outputs are filters on it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import ids, numbers, records, text, times
from funnelspark.operators.joins import keep_first
from funnelspark.schemas import CORRUPT, POSITION, RAW_FIELDS, RECORD, carried, conform, shape


def _raw(*names: str) -> list[Column]:
    return [F.col(f"`{name}`") for name in names]


def _text(*names: str, cap: int | None = None, default: str | None = None) -> Column:
    value = text.clean_text(text.first_filled(*_raw(*names)), cap)
    return value if default is None else F.coalesce(value, F.lit(default))


def _time(*names: str) -> Column:
    return times.parse_timestamp(text.first_filled(*_raw(*names)))


@dataclass(frozen=True)
class Entity:
    """How raw fields become clean columns, and which of them a record cannot do without."""

    key: str
    columns: dict[str, Column]
    required: list[tuple[str, str, str]]  # clean column, rule id, message

    def reject(self) -> Column:
        """First broken rule as (rule, message), NULL for a good record."""
        broken = [
            F.when(F.col(column).isNull(), F.struct(F.lit(rule).alias("rule"), F.lit(message).alias("message")))
            for column, rule, message in self.required
        ]
        return F.coalesce(*broken)


def entity(name: str) -> Entity:
    """Rules of one entity (built on demand: columns need a running session)."""
    if name == "agents":
        return Entity(
            "agent_id",
            {
                "agent_id": _text("id", "agent_id"),
                "linkedin_email": _text("email", "linkedin_email", cap=255),
                "display_name": _text("name", "display_name", cap=255),
                "status": _text("status", cap=50, default="active"),
                "tier_name": _text("account_age", "tier"),
            },
            [("agent_id", "missing_agent_id", "Missing agent_id")],
        )
    if name == "leads":
        derived = ids.derived_lead_id(_raw("linkedin_url", "Profile URL", "URL"), *_raw("first_name", "last_name"))
        named = text.full_name(text.first_filled(*_raw("name", "full_name")), *_raw("first_name", "last_name"))
        return Entity(
            "lead_id",
            {
                "lead_id": F.coalesce(_text("id", "lead_id"), derived),
                "full_name": F.coalesce(named, F.lit("Unknown Prospect")),
                "company": _text("company", "organization", cap=255, default="Unknown Company"),
                "title": _text("title", "job_title", "Position", cap=255, default="Professional"),
                "linkedin_url": _text("linkedin_url", "profile_url", "URL", cap=500),
                "segment": _text("segment", "list_name", "location", cap=100, default="Target Prospects"),
                "lead_status": _text("status", "lead_status", cap=50, default="NEW"),
            },
            [("lead_id", "missing_lead_id", "Missing lead_id")],
        )
    if name == "campaigns":
        return Entity(
            "campaign_id",
            {
                "campaign_id": _text("id", "campaign_id"),
                "campaign_name": _text("name", "campaign_name", cap=255),
                "campaign_type": _text("type", "campaign_type", cap=100),
                "target_segment": _text("segment", "target_segment", cap=100),
                "created_at": _time("created_at"),
            },
            [("campaign_id", "missing_campaign_id", "Missing campaign_id")],
        )
    if name == "templates":
        return Entity(
            "template_id",
            {
                "template_id": _text("id", "template_id"),
                "template_name": _text("name", "template_name", cap=255),
                "template_body": _text("body", "template_body"),
                "channel": _text("channel", cap=50),
                "created_at": _time("created_at"),
            },
            [("template_id", "missing_template_id", "Missing template_id")],
        )
    if name == "events":
        return Entity(
            "event_source_id",
            {
                "event_source_id": _text("id", "event_id"),
                "agent_id": _text("agent_id"),
                "lead_id": _text("lead_id"),
                "campaign_id": _text("campaign_id"),
                "template_id": _text("template_id"),
                "event_type": text.event_type_of(text.first_filled(*_raw("event_type", "type", "action"))),
                "event_timestamp": _time("timestamp", "event_timestamp", "created_at", "date"),
                "event_status": _text("status", cap=50, default="SUCCESS"),
                "response_time_minutes": numbers.to_int(F.col("response_time_minutes")),
            },
            [
                ("event_source_id", "missing_event_id", "Missing event_id"),
                ("event_type", "missing_event_type", "Missing event_type"),
                ("event_timestamp", "bad_timestamp", "Missing or unparseable timestamp"),
            ],
        )
    raise ValueError(f"unknown entity {name!r}")


def route(raw: DataFrame, name: str, order: list[str] = POSITION, dedup: bool = True) -> DataFrame:
    """Typed rows with ``_raw`` (the record as it came) and ``_reject`` (NULL = clean).

    The first row of a key wins *before* validation, so a broken first copy hides a good later one; a row
    without a key is judged by itself. Only raw fields travel through the de-duplication shuffle: the clean columns and
    the payload of rejects are computed after it.
    """
    rules = entity(name)
    rows = conform(raw, name, list(order))
    if dedup:
        rows = keep_first(rows, rules.columns[rules.key], list(order))
    fixed = F.struct(
        *[column.alias(alias) for alias, column in rules.columns.items()],
        F.struct(*_raw(*RAW_FIELDS[name], *carried(rows))).alias("_raw"),
        *[F.col(c).alias(f"_o_{c}") for c in order],
    )
    # inline() of one struct fixes the typed values as columns: whatever reads them afterwards, above all a filter
    # on the verdict, would otherwise be merged with or pushed below the cleaning and work it out once more.
    typed = rows.select(F.inline(F.array(fixed)))
    # Rule and message of a record that is no JSON.
    no_json = F.struct(F.lit("bad_json").alias("rule"), F.lit("Malformed JSON record").alias("message"))
    broken = [F.when(F.col(f"_raw.{CORRUPT}").isNotNull(), no_json)] if CORRUPT in carried(rows) else []
    derived = {"date_key": times.date_key(F.col("event_timestamp"))} if name == "events" else {}
    return typed.select(
        *rules.columns, *[c.alias(alias) for alias, c in derived.items()], "_raw", *[f"_o_{c}" for c in order],
        F.coalesce(*broken, rules.reject()).alias("_reject"),
    )


def clean_rows(routed: DataFrame) -> DataFrame:
    return routed.filter(F.col("_reject").isNull()).select(*routed.columns[: routed.columns.index("_raw")])


def slim(routed: DataFrame) -> DataFrame:
    """Routed rows to be staged: only rejects keep their raw record, which nobody reads of a clean row."""
    return routed.withColumn("_raw", F.when(F.col("_reject").isNotNull(), F.col("_raw")))


def _record_id(payload: list[str]) -> Column:
    """Source id of a raw record; a record rejected at load time leads with its natural key."""
    names = [name for name in ("id", "event_id") if name in payload] or payload[:1]
    return text.first_filled(*[F.col(f"_raw.`{name}`") for name in names])


def payload(fields: list[str]) -> Column:
    """The record as it came: its own text where that says more than the declared fields, else those as JSON."""
    whole = [F.col(f"_raw.{c}") for c in (CORRUPT, RECORD) if c in fields]
    return F.coalesce(*whole, F.to_json(F.struct(*[F.col(f"_raw.`{n}`") for n in fields if n not in (RECORD, CORRUPT)])))


def dead_letters(routed: DataFrame, run_id: str, as_of: Column, source: str | None = None, name: str | None = None) -> DataFrame:
    """Rejected rows in the shape of the dead-letter table. ``source``: the stage that rejected them, else as ``check_limits`` noted it.

    ``name`` is the entity the records are of; with it a replay finds each of them, whatever rule it broke.
    """
    fields = routed.schema["_raw"].dataType.fieldNames()
    staged = source is None and "_stage" in routed.columns
    stage = F.col("_stage") if staged else F.lit(source or "transformer")
    record_id = _record_id(fields)
    if staged:
        # The loader knows a record by its clean key, wherever that came from.
        record_id = F.coalesce(record_id, F.when(stage == "loader", F.col(routed.columns[0])))
    return shape(
        routed.filter(F.col("_reject").isNotNull()).select(
            record_id.alias("source_id"),
            payload(fields).alias("record_payload"),
            F.col("_reject.message").alias("error_message"),
            F.col("_reject.rule").alias("error_type"),
            stage.alias("source"),
            F.lit(run_id).alias("run_id"),
            as_of.alias("created_at"),
            F.lit(False).alias("resolved"),
            F.lit(name).cast("string").alias("entity_name"),
        ),
        "dead_letter_queue",
    )


# Columns a table cannot store as NULL, and the longest text it stores.
TABLE_LIMITS = {
    "dim_agent": {"agent_id": 100, "linkedin_email": 255, "display_name": 255, "status": 50},
    "dim_lead": {"lead_id": 100, "full_name": 255, "company": 255, "title": 255, "linkedin_url": 500,
                 "segment": 100, "lead_status": 50},
    "dim_campaign": {"campaign_id": 100, "campaign_name": 255, "campaign_type": 100, "target_segment": 100},
    "dim_message_template": {"template_id": 100, "template_name": 255, "channel": 50},
    "fact_outreach_event": {"event_source_id": 200, "event_type": 50, "event_status": 50},
}
TABLE_NOT_NULL = {
    "dim_agent": ["agent_id", "status"],
    "dim_lead": ["lead_id"],
    "dim_campaign": ["campaign_id"],
    "dim_message_template": ["template_id"],
    "fact_outreach_event": ["event_source_id", "event_type", "event_timestamp"],
}


LOADED_INTO = {
    "agents": "dim_agent", "leads": "dim_lead", "campaigns": "dim_campaign", "templates": "dim_message_template",
    "events": "fact_outreach_event",
}


def check_limits(clean: DataFrame, table: str) -> DataFrame:
    """Load-time constraints, as ``_raw`` and ``_reject`` like ``route`` gives them.

    A row the table cannot hold is rejected by itself; the rest of its batch still loads. Rows as ``route`` gives them keep their raw
    record, so that what the loader rejects can be replayed like the rest; ``_stage`` says who rejected.
    """
    columns = clean.columns
    broken = [
        F.when(F.col(c).isNull(), F.struct(F.lit("not_null").alias("rule"), F.lit(f"{c} must not be NULL").alias("message")))
        for c in TABLE_NOT_NULL[table]
    ] + [
        F.when(F.length(c) > cap,
               F.struct(F.lit("too_long").alias("rule"), F.lit(f"{c} is longer than {cap}").alias("message")))
        for c, cap in TABLE_LIMITS[table].items()
    ]
    if "_raw" in columns:
        stage = F.when(F.col("_reject").isNotNull(), "transformer").otherwise("loader")
        return clean.withColumns({"_stage": stage, "_reject": F.coalesce("_reject", *broken)})
    return clean.select("*", F.struct(*columns).alias("_raw"), F.coalesce(*broken).alias("_reject"))


def reject_counts(routed: DataFrame) -> DataFrame:
    """Rows in, rows clean and rows rejected, and the run status they imply, as one row."""
    bad = F.count_if(F.col("_reject").isNotNull())
    return routed.agg(
        F.count(F.lit(1)).alias("rows_in"),
        F.count_if(F.col("_reject").isNull()).alias("rows_clean"),
        bad.alias("rows_rejected"),
        F.when(bad == 0, "SUCCESS").otherwise("PARTIAL").alias("status"),
    )


def letters_of(name: str) -> Column:
    """Whether a dead letter is a record of the entity: as it says itself, else by the rule it broke or the column it did not fit."""
    table = LOADED_INTO[name]
    columns = sorted({*TABLE_NOT_NULL[table], *TABLE_LIMITS[table]})
    by_rule = F.col("error_type").isin([rule for _, rule, _ in entity(name).required])
    return F.coalesce(F.col("entity_name") == name, by_rule | F.substring_index("error_message", " ", 1).isin(columns))


def replay(letters: DataFrame, name: str, as_of: Column) -> tuple[DataFrame, DataFrame]:
    """Judge stored payloads again: (rows to load, all letters with ``resolved`` updated).

    Each open letter of the entity is judged by itself, load-time limits included, so a letter that is still broken hides no
    corrected one of the same key. Of several corrected letters of a key the first is loaded, as in any batch. Exactly those that pass are resolved:
    their key is among the rows to load.
    """
    parsed = records.parsed(F.col("record_payload"), records.json_fields(name)).alias("_p")
    rows = letters.select(F.struct("*").alias("_letter"), parsed).select(
        "_letter", *[records.field(n, F.col(f"_p.`{n}`")) for n in RAW_FIELDS[name]], F.col(f"_p.{CORRUPT}").alias(CORRUPT),
    )
    judged = check_limits(route(rows, name, ["_letter"], dedup=False), LOADED_INTO[name])
    letter = F.col("_o__letter")
    wanted = judged.select("*", letter.getField("error_type").alias("error_type"), letter.getField("error_message").alias("error_message"), letter.getField("entity_name").alias("entity_name"))
    passes = ~F.coalesce(letter.getField("resolved"), F.lit(False)) & letters_of(name) & F.col("_reject").isNull()
    judged = wanted.withColumn("_passes", passes).drop("error_type", "error_message", "entity_name")

    order = [letter.getField(c) for c in ("created_at", "run_id", "record_payload")]
    first = keep_first(judged.filter("_passes"), F.col(entity(name).key), order)
    updated = judged.select("_o__letter.*", "_passes").withColumns({
        "resolved": F.coalesce("resolved", F.lit(False)) | F.col("_passes"),
        "resolved_at": F.when(F.col("_passes"), as_of).otherwise(F.col("resolved_at")),
    })
    return clean_rows(first), shape(updated, "dead_letter_queue")
