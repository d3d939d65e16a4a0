"""Live events as micro-batches (ST-1..ST-6, FN-25).

The stream itself is stateless: what makes a repeated or late event harmless is the fact table. Each micro-batch is cleaned, upserted by
event id, and the agent-days it touched are recomputed from the fact, so any lateness is accepted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from funnelspark.functions import records, text
from funnelspark.operators import clean, dims, facts, marts
from funnelspark.schemas import CORRUPT, RAW_FIELDS, TABLES, carried, conform, raw_schema
from funnelspark.session import prepare, write_stage
from funnelspark.sources.warehouse import Warehouse, month_of

ARRIVED = "_arrived"
RECEIPTS = TABLES["live_receipts"]
# Fixed value: the warning of a receipt.
DEAD_LETTER_WARNING = "Event format failed validation and was routed to Dead-Letter Queue."


# Where a landed record lies; ``_row`` is numbered within the micro-batch.
LANDED_ORDER = ["_file", "_block", "_row"]


def with_arrival(stream: DataFrame, at: Column | None = None) -> DataFrame:
    """Arrival time of each record: ``at``, else when the micro-batch read it."""
    return stream if ARRIVED in stream.columns else stream.withColumn(ARRIVED, F.current_timestamp() if at is None else at)


def _filled(*names: str) -> Column:
    return text.first_filled(*[F.col(f"`{n}`") for n in names])


def _payload_id(prefix: str, length: int, entity: str) -> Column:
    """Id of a record that came without one: a digest of its content, the same on redelivery."""
    body = F.to_json(F.struct(*[F.col(f"`{n}`") for n in RAW_FIELDS[entity]]))
    return F.concat(F.lit(prefix), F.substring(F.md5(body), 1, length))


def _arrival_text() -> Column:
    return F.date_format(ARRIVED, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def live_payloads(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Event records with defaults for a missing id, time or status."""
    rows = conform(with_arrival(df), "events", [ARRIVED, *keep])
    return rows.withColumns({
        "event_id": F.coalesce(_filled("id", "event_id"), _payload_id("live_evt_", 12, "events")),
        # Only an absent time is filled in; an empty one is a fault of the sender.
        "timestamp": F.coalesce("timestamp", F.when(_filled("event_timestamp", "created_at", "date").isNull(), _arrival_text())),
        "status": F.coalesce("status", F.lit("SUCCESS")),
    })


def webhook_payloads(df: DataFrame, keep: list[str] = ()) -> DataFrame:
    """Loosely named webhook records → event records."""
    rows = conform(with_arrival(df), "webhooks", [ARRIVED, *keep])
    return rows.select(
        F.coalesce(_filled("id", "event_id"), _payload_id("wh_", 10, "webhooks")).alias("id"),
        F.coalesce(_filled("agent_id", "account_id"), F.lit("live_agent_default")).alias("agent_id"),
        _filled("lead_id", "contact_id").alias("lead_id"),
        F.col("campaign_id"),
        F.coalesce(_filled("event_type", "type", "action"), F.lit("MESSAGE_SENT")).alias("event_type"),
        F.coalesce(_filled("timestamp", "created_at"), _arrival_text()).alias("timestamp"),
        F.coalesce("status", F.lit("SUCCESS")).alias("status"),
        F.col("response_time_minutes"),
        *carried(rows, keep), ARRIVED, *keep,
    )


def receipts(routed: DataFrame, run_id: str, at: Column) -> DataFrame:
    """One receipt per delivered record."""
    raw = F.col("_raw")
    bad = F.col("_reject").isNotNull()
    return routed.select(
        F.coalesce("event_source_id", raw["id"], raw["event_id"], F.lit("unknown")).alias("event_id"),
        F.coalesce("event_type", raw["event_type"], F.lit("UNKNOWN")).alias("event_type"),
        F.when(bad, "DEAD_LETTERED").otherwise("SUCCESS").alias("status"),
        F.when(bad, DEAD_LETTER_WARNING).alias("warning"),
        at.alias("persisted_at"),
        F.lit(run_id).alias("run_id"),
    )


def _staged(judged: DataFrame) -> DataFrame:
    """Routed events, stored once. An id that is clean as it came is stored with the raw record only, since ids may be as long as whole texts."""
    key, came = F.col("event_source_id"), F.col("_raw")["id"]
    slim = judged.withColumns({"event_source_id": F.when(~key.eqNullSafe(came), key), "_as_came": key.eqNullSafe(came)})
    stage = write_stage(slim, "live-routed")
    return stage.withColumn("event_source_id", F.when(F.col("_as_came"), came).otherwise(key)).drop("_as_came")


def ingest(events: DataFrame, warehouse: Warehouse, run_id: str, at: Column, order: list[str], zero_rate: bool = False) -> None:
    """One micro-batch: judge, dead-letter, upsert, refresh the touched agent-days, write receipts.

    Every write is keyed by event id, group or ``run_id``, so the same batch may run again. ``run_id`` must be this micro-batch's alone: its
    letters and receipts replace those stored under it. A record the table cannot hold is a dead letter like a malformed one.
    """
    warehouse.recover()
    judged = clean.check_limits(clean.route(events, "events", order, dedup=False), "fact_outreach_event")
    routed = _staged(judged)
    warehouse.append("dead_letter_queue", clean.dead_letters(routed, run_id, at, name="events"), [run_id])
    warehouse.append("live_receipts", receipts(routed, run_id, at), [run_id])

    columns = routed.columns[: routed.columns.index("_raw")]
    places = [f"_o_{c}" for c in order]
    valid = routed.filter("_reject IS NULL").select(*columns, F.struct(*places).alias("_place"))
    loadable = facts.latest_of_batch(valid, F.col("_place")).drop("_place")
    known = {t: warehouse.read(t) for t in facts.DIMENSIONS}
    # A micro-batch is small next to the dimensions: no key of it needs the skew-proof lookup.
    fact = write_stage(facts.as_fact(facts.resolve_keys(loadable, known, large=set()), at), "live-resolved")
    warehouse.upsert_events(fact)

    touched = marts.touched_groups(fact)
    months = [r[0] for r in touched.select(month_of()).distinct().collect()]
    if months:
        # Rows of the touched groups carry the date of their first load, so their month prunes the scan.
        stored = warehouse.read("fact_outreach_event").filter(F.col("month").isin(months))
        days = marts.refresh_activity(stored, touched, zero_rate=zero_rate)
        full = marts.with_utilisation(days, known["dim_agent"], warehouse.read("dim_account_tier"))
        warehouse.upsert_mart("fact_daily_agent_activity", write_stage(full, "live-days"), ["agent_key", "date_key"])


def _run_id(batch: DataFrame, batch_id: int) -> str:
    """Id of a micro-batch: the same when it is repeated, also after a restart, and never that of another stream."""
    stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    if not stream_id:
        raise RuntimeError("a micro-batch without the id of its stream")
    return f"{stream_id}_{batch_id:08d}"


def _numbered(batch: DataFrame, order: list[str]) -> DataFrame:
    """Landed records numbered as they lie in their files, where ``order`` asks for it."""
    return batch.withColumn("_row", F.monotonically_increasing_id()) if "_row" in order and "_row" not in batch.columns else batch


def start_ingest(
    stream: DataFrame, warehouse: Warehouse, checkpoint: str, order: list[str] = LANDED_ORDER, trigger: dict | None = None,
    at: Column | None = None, zero_rate: bool = False,
) -> StreamingQuery:
    """Run ``ingest`` for every micro-batch of a stream of event records.

    ``at`` fixes the load time (tests); by default it is the micro-batch's own time.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        prepare(batch.sparkSession)
        now = F.current_timestamp() if at is None else at
        ingest(_numbered(batch, order), warehouse, _run_id(batch, batch_id), now, order, zero_rate)

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def start_leads(stream: DataFrame, warehouse: Warehouse, checkpoint: str, order: list[str] = LANDED_ORDER, trigger: dict | None = None,
                at: Column | None = None) -> StreamingQuery:
    """Live lead registration: each micro-batch goes through the type-2 merge of the id buckets it touches."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        prepare(batch.sparkSession)
        now = F.current_timestamp() if at is None else at
        warehouse.recover()
        judged = clean.check_limits(clean.route(_numbered(batch, order), "leads", order), "dim_lead")
        routed = write_stage(judged, "live-leads")
        run_id, rows = _run_id(batch, batch_id), clean.clean_rows(routed)
        warehouse.append("dead_letter_queue", clean.dead_letters(routed, run_id, now, name="leads"), [run_id])
        warehouse.merge_leads(rows, lambda stored: dims.merge_leads(stored, rows, now))

    return (
        stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"availableNow": True})).start()
    )


def windowed_activity(events: DataFrame, delay: str = "2 days") -> DataFrame:
    """Daily counts per agent as a windowed stream aggregate in append mode.

    An alternative to the refresh for when lateness is bounded: a day is emitted once, after ``delay``, and
    the state holds open days only. Repeats are dropped within the same delay.
    """
    fresh = events.withWatermark("event_timestamp", delay).dropDuplicatesWithinWatermark(["event_source_id"])
    counted = fresh.groupBy(F.window("event_timestamp", "1 day").alias("w"), "agent_id").agg(
        *[marts.events_of(kind).alias(c) for c, kind in marts.ACTIVITY_COUNTS.items()]
    )
    return counted.select(F.to_date("w.start").alias("day"), "agent_id", *marts.ACTIVITY_COUNTS)


def read_landing(spark: SparkSession, path: str, entity: str = "events", max_files: int | None = None) -> DataFrame:
    """Stream of landed JSON-lines files under the entity's declared schema; a line that is no JSON is a row to be dead-lettered."""
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    schema = StructType([*raw_schema(entity), StructField(CORRUPT, StringType())])
    lines = reader.text(path).filter(F.trim("value") != "")
    return lines.select(records.parsed(F.col("value"), schema).alias("_fields"), records.undeclared(F.col("value"), entity),
                        F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")
                        ).select("_fields.*", "_record", "_file", "_block")
