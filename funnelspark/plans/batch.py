"""The nightly run: files → cleaned rows → dimensions → fact → marts → checks → audit row, and the risk run."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from funnelspark.operators import alerts, anomaly, clean, dims, facts, marts, quality, risk
from funnelspark.plans.increments import OVERLAP, Increment
from funnelspark.schemas import shape
from funnelspark.session import prepare, write_stage
from funnelspark.sources import files, imports
from funnelspark.sources.warehouse import BUCKETS, Warehouse, month_of

# entity → (dimension table, merge); events are loaded after all of them.
ENTITIES = {
    "agents": "dim_agent",
    "leads": "dim_lead",
    "campaigns": "dim_campaign",
    "templates": "dim_message_template",
}


def moment(at: datetime | str) -> Column:
    return F.lit(at if isinstance(at, str) else at.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")


def seed(warehouse: Warehouse) -> None:
    """Static tables, written once."""
    spark = warehouse.spark
    if not warehouse.written("dim_account_tier"):
        warehouse.replace("dim_account_tier", dims.account_tiers(spark))


def _merge(warehouse: Warehouse, table: str, rows: DataFrame, as_of: Column) -> DataFrame:
    """Rows merged into a stored dimension, with their actions. Of leads, which grow with the data, only touched id buckets are read and written."""
    if table == "dim_lead":
        return warehouse.merge_leads(rows, lambda stored: dims.merge_leads(stored, rows, as_of))
    existing = warehouse.read(table)
    if table == "dim_agent":
        merged = dims.merge_agents(existing, rows, warehouse.read("dim_account_tier"), as_of)
    elif table == "dim_campaign":
        merged = dims.merge_campaigns(existing, rows)
    else:
        merged = dims.merge_templates(existing, rows)
    merged = write_stage(merged, f"{table}-merged")
    warehouse.replace(table, merged)
    return merged


class Run:
    """Counters and rejects of one run."""

    def __init__(self, run_id: str, as_of: Column):
        self.run_id, self.as_of = run_id, as_of
        self.extracted = self.loaded = self.failed = self.dead = 0
        self.letters: list[DataFrame] = []
        self.synced: dict[str, Callable[[], Column]] = {}
        self.months: list[int] = []
        self.stages: dict[str, DataFrame] = {}

    def keep_letters(self, warehouse: Warehouse) -> None:
        """Store the rejects so far, in the place of those stored before under this run id."""
        if self.letters:
            warehouse.append("dead_letter_queue", quality.union_all(self.letters), [self.run_id])

    def judge(self, raw: DataFrame, entity: str, table: str, order: list[str], increment: Increment | None = None) -> DataFrame | None:
        """Clean one entity: stage the verdicts once, keep the rejects, return the loadable rows.

        Rows in and rows rejected are observed while the stage is written, so counting costs no pass of its own. Of an incremental read, the rows that were not
        taken before are the rows in. A stage keeps the raw records of rejects only.
        """
        if increment:
            rows, newest = increment.candidates(raw, order)
            both = clean.route(rows, entity, newest).unionByName(increment.untimed(raw, order))
            stage = write_stage(clean.slim(clean.check_limits(both, table)), f"{entity}-candidates")
            stage = increment.unseen(stage)
            counts = stage.agg(F.count(F.lit(1)), F.count_if(F.col("_reject").isNotNull()), F.count_if(F.col("_reject").isNotNull() & (F.col("_stage") == "loader"))).first()
            return self._judged(stage, entity, counts[0], *counts, synced=lambda: increment.synced(stage))
        if raw.isEmpty():  # no metrics are observed on a plan that is known to be empty
            return None
        seen, verdicts = Observation(), Observation()
        counted = raw.observe(seen, F.count(F.lit(1)).alias("n"))
        bad = F.col("_reject").isNotNull()
        routed = clean.check_limits(clean.route(counted, entity, order), table).observe(
            verdicts, F.count(F.lit(1)).alias("n"), F.count_if(bad).alias("bad"), F.count_if(bad & (F.col("_stage") == "loader")).alias("refused")
        )
        stage = write_stage(clean.slim(routed), f"{entity}-routed")
        return self._judged(stage, entity, seen.get["n"], verdicts.get["n"], verdicts.get["bad"], verdicts.get["refused"], synced=lambda: self.as_of)

    def _judged(self, stage: DataFrame, entity: str, rows_in: int, judged: int, rejected: int, refused: int, synced: Callable[[], Column]) -> DataFrame | None:
        self.extracted += rows_in
        self.stages[entity] = stage
        if rows_in and entity != "templates":
            self.synced[entity] = synced
        if rejected:
            self.letters.append(clean.dead_letters(stage, self.run_id, self.as_of, name=entity))
        self.dead += rejected
        self.failed += refused
        return clean.clean_rows(stage) if judged > rejected else None


def run_batch(
    spark: SparkSession,
    source_dir: str,
    root: str,
    as_of: datetime,
    run_id: str | None = None,
    buckets: int = BUCKETS,
    entity_frames: dict[str, tuple[DataFrame, list[str]]] | None = None,
    since: dict[str, str] | None = None,
    overlap: timedelta = OVERLAP,
    land: bool = False,
) -> dict:
    """Load of a folder of entity files into the warehouse under ``root``; returns the run's summary.

    ``entity_frames`` (entity → raw rows and their order columns) replaces files by tables of the caller, such as landed pages. ``since``
    (entity → column of its raw rows) makes the run incremental: rows after the entity's watermark, the newest time read so far, are taken, and those that came late or
    changed within ``overlap`` before it (see ``increments``); a full load sets the watermark to ``as_of``.
    With ``land`` events are first kept verbatim in ``stg_raw_events``, and the run reads them from there (``reprocess`` does so again, after a crash too).
    The run's alerts go to the table ``alerts``. A failure is
    recorded as a FAILED run, with the rejects found so far, and raised again; running the same batch once more converges.
    """
    prepare(spark)
    run_id = run_id or uuid.uuid4().hex
    started, at = time.time(), moment(as_of)
    warehouse, run = Warehouse(spark, root, buckets).recover(), Run(run_id, at)
    try:
        seed(warehouse)
        for entity, table in [*ENTITIES.items(), ("events", "fact_outreach_event")]:
            _load(spark, warehouse, run, entity, table, source_dir, entity_frames, since or {}, overlap, land)
        run.keep_letters(warehouse)
        refresh_marts(warehouse, run.months)
        score = check(warehouse, run_id, at)
        status = "PARTIAL" if run.dead else "SUCCESS"
        # Last: whatever fails before is read again.
        warehouse.set_watermarks({entity: synced() for entity, synced in run.synced.items()}, at)
        record(warehouse, run, as_of, started, status, score)
        raise_alerts(warehouse, run_id, at)
        return {
            "run_id": run_id, "status": status, "rows_extracted": run.extracted, "rows_loaded": run.loaded,
            "rows_failed": run.failed, "dlq_count": run.dead, "dq_score": score,
            "duration_seconds": time.time() - started,
        }
    except Exception as error:
        record(warehouse, run, as_of, started, "FAILED", None, str(error))
        run.keep_letters(warehouse)
        raise_alerts(warehouse, run_id, at)
        raise


def _load(spark, warehouse: Warehouse, run: Run, entity: str, table: str, source_dir: str, frames, since: dict[str, str], overlap: timedelta, land: bool) -> None:
    raw, order = (frames or {}).get(entity) or (files.read_entity(spark, source_dir, entity), files.POSITION)
    if land and entity == "events":
        if entity in since:
            raise ValueError("landed events are read whole: they keep no update time")
        _load_landed(warehouse, run, land_events(warehouse, raw, run.run_id, run.as_of, order))
        return
    increment = Increment(warehouse, entity, table, since[entity], overlap) if entity in since else None
    rows = run.judge(raw, entity, table, order, increment)
    if rows is not None:
        _store(warehouse, run, entity, table, rows)


def _store(warehouse: Warehouse, run: Run, entity: str, table: str, rows: DataFrame) -> None:
    """Clean rows of one entity into their table."""
    if entity == "events":
        known = {t: warehouse.read(t) for t in facts.DIMENSIONS}
        fact = facts.as_fact(facts.resolve_keys(rows, known), run.as_of)
        # A first load is read once, and is then the whole table; later ones are compared with the table first.
        first = not warehouse.written(table)
        fact = fact if first else write_stage(fact, "events-resolved")
        counts = warehouse.upsert_events(fact)
        fact = warehouse.read(table) if first else fact
        run.loaded += counts["insert"] + counts["update"]
        # One integer per month; months of the whole batch, so that a run repeated after a crash refreshes them too.
        run.months = [r[0] for r in fact.select(month_of()).distinct().collect()]
        return
    merged = _merge(warehouse, table, rows, run.as_of)
    done = dims.version_counts(merged).filter("action IN ('insert', 'update')").agg(F.sum("n")).head()[0]
    run.loaded += done or 0


def land_events(warehouse: Warehouse, raw: DataFrame, run_id: str, at: Column, order: list[str]) -> str:
    """Keep raw events verbatim under a run id, in the place of those landed before under it; returns the run id."""
    warehouse.append("stg_raw_events", write_stage(files.raw_landing(raw, "events", run_id, at, order=order), "landed"), [run_id])
    return run_id


def _load_landed(warehouse: Warehouse, run: Run, landed_run: str) -> None:
    """Judge and load the landed events of a run, then note what became of each record.

    The state is written last: a crash before leaves the records ``received``, and loading them again changes nothing.
    """
    landed = warehouse.read("stg_raw_events").filter(F.col("run_id") == landed_run)
    rows = run.judge(files.landed_records(landed, "events"), "events", "fact_outreach_event", ["position"])
    if rows is not None:
        _store(warehouse, run, "events", "fact_outreach_event", rows)
    stage = run.stages.get("events")
    if stage is None:
        return
    judged = stage.select(F.col("_o_position").alias("position"), F.when(F.col("_reject").isNull(), "processed").otherwise("dead_lettered").alias("_state"))
    # What is not among the judged is a later copy of a record that is.
    state = F.coalesce("_state", F.lit("duplicate"))
    marked = landed.join(judged, "position", "left").withColumns({"state": state, "processed": state != "dead_lettered"})
    warehouse.append("stg_raw_events", write_stage(shape(marked, "stg_raw_events"), "landed-states"), [landed_run])


def reprocess(spark: SparkSession, root: str, landed_run: str, as_of: datetime, run_id: str | None = None, buckets: int = BUCKETS) -> dict:
    """Load the landed events of a run again, from the landing table alone: after a crash, or with mended rules. The source is not read."""
    prepare(spark)
    warehouse, run = Warehouse(spark, root, buckets).recover(), Run(run_id or uuid.uuid4().hex, moment(as_of))
    _load_landed(warehouse, run, landed_run)
    run.keep_letters(warehouse)
    refresh_marts(warehouse, run.months)
    return {"rows_extracted": run.extracted, "rows_loaded": run.loaded, "dlq_count": run.dead}


def replay_letters(spark: SparkSession, root: str, as_of: datetime, entity: str, run_id: str | None = None, buckets: int = BUCKETS) -> dict:
    """Judge the open dead letters of an entity again, load those that pass now, and mark exactly them resolved.

    Letters are marked after the load, so a crash in between only means that the next replay loads the same rows once more, which changes nothing.
    """
    prepare(spark)
    warehouse, run = Warehouse(spark, root, buckets).recover(), Run(run_id or uuid.uuid4().hex, moment(as_of))
    letters = warehouse.read("dead_letter_queue")
    fixed, updated = clean.replay(letters.filter(~F.col("resolved") & clean.letters_of(entity)), entity, run.as_of)
    rows = write_stage(fixed, f"{entity}-replayed")
    verdicts = write_stage(updated, "letters-judged")
    resolved = verdicts.filter("resolved").count()
    if resolved:
        _store(warehouse, run, entity, clean.LOADED_INTO[entity], rows)
        refresh_marts(warehouse, run.months)
        # Only the runs that a resolved letter is of are written again: their judged letters, and the others as they are.
        others = letters.filter(F.coalesce(F.col("resolved"), F.lit(False)) | ~clean.letters_of(entity))
        touched = verdicts.filter("resolved").select("run_id").distinct()
        renewed = verdicts.unionByName(shape(others, "dead_letter_queue")).join(touched, "run_id", "left_semi")
        warehouse.append("dead_letter_queue", write_stage(shape(renewed, "dead_letter_queue"), "letters-renewed"), [r[0] for r in touched.collect()])
    return {"resolved": resolved, "rows_loaded": run.loaded}


def refresh_marts(warehouse: Warehouse, months: list[int]) -> None:
    """Recompute the daily marts for the given months; other months of the fact are not read."""
    if not months:
        return
    fact = warehouse.read("fact_outreach_event").filter(F.col("month").isin(months))
    days = marts.with_utilisation(
        marts.daily_agent_activity(fact), warehouse.read("dim_agent"), warehouse.read("dim_account_tier")
    )
    warehouse.upsert_mart("fact_daily_agent_activity", write_stage(days, "activity"), ["agent_key", "date_key"])
    campaigns = marts.campaign_performance(fact)
    warehouse.upsert_mart("fact_campaign_performance", write_stage(campaigns, "performance"), ["campaign_key", "date_key"])


CHECKED = ["fact_outreach_event", "fact_daily_agent_activity", "fact_campaign_performance", *ENTITIES.values(), "dim_account_tier"]


def check(warehouse: Warehouse, run_id: str, at: Column) -> float:
    """All quality checks over the stored tables; appends the history and returns the composite."""
    tables = {t: warehouse.read(t) for t in CHECKED} | {"dim_date": dims.calendar(warehouse.spark)}
    collided = quality.key_collisions(tables).filter("collisions > 0").collect()
    if collided:
        raise RuntimeError(f"surrogate keys of several rows: {[r.asDict() for r in collided]}")
    checks = write_stage(quality.run_checks(tables, at), "checks")
    warehouse.append("dq_results", quality.history_rows(checks, run_id, at), [run_id])
    return quality.composite(checks).head()[0]


def record(warehouse: Warehouse, run: Run, as_of: datetime, started: float, status: str, score, error: str | None = None) -> None:
    """One audit row per run."""
    seconds = time.time() - started
    values = {
        "run_id": run.run_id, "correlation_id": run.run_id, "duration_seconds": seconds, "rows_extracted": run.extracted,
        "rows_loaded": run.loaded, "rows_failed": run.failed, "rows_skipped": 0, "status": status, "error_message": error,
        "dq_score": score, "dq_passed": None if score is None else score >= quality.PASS_THRESHOLD,
    }
    row = warehouse.spark.range(1).select(
        *[F.lit(v).alias(k) for k, v in values.items()],
        moment(as_of).alias("start_time"), moment(as_of + timedelta(seconds=seconds)).alias("end_time"),
    )
    warehouse.append("fact_pipeline_run", shape(row, "fact_pipeline_run"), [run.run_id])


def raise_alerts(warehouse: Warehouse, run_id: str, at: Column) -> None:
    """Store what is to be reported of a run: its failure, a low quality score, an unusual duration."""
    kind = F.lit("batch").alias("pipeline")
    runs = warehouse.read("fact_pipeline_run").select("*", kind)
    own, good = runs.filter(F.col("run_id") == run_id), runs.filter(F.col("status") != "FAILED")
    found = alerts.all_alerts(
        alerts.failed_runs(own), alerts.quality_breaches(warehouse.read("dq_results").filter(F.col("run_id") == run_id)),
        alerts.slow_runs(own, anomaly.duration_baseline(good, ["pipeline"]), ["pipeline"]),
    )
    _store_alerts(warehouse, found, run_id, at)


def _store_alerts(warehouse: Warehouse, found: DataFrame, run_id: str, at: Column) -> None:
    warehouse.append("alerts", shape(found.select("*", F.lit(run_id).alias("run_id"), at.alias("raised_at")), "alerts"), [run_id])


def run_risk(spark: SparkSession, root: str, buckets: int = BUCKETS, as_of: datetime | None = None, run_id: str | None = None) -> DataFrame:
    """Score all current agents, write the scores onto their newest activity rows, store alerts of risky agents, return the profiles."""
    prepare(spark)
    warehouse = Warehouse(spark, root, buckets).recover()
    activity, agents = warehouse.read("fact_daily_agent_activity"), warehouse.read("dim_agent")
    profiles = write_stage(risk.score_agents(activity, agents, warehouse.read("dim_account_tier")), "profiles")
    scored = risk.write_back(activity.drop("month"), profiles.filter("days IS NOT NULL"))
    newest = scored.join(activity.groupBy("agent_key").agg(F.max("date_key").alias("date_key")), ["agent_key", "date_key"], "left_semi")
    warehouse.put_scores(write_stage(newest, "scores"))
    _store_alerts(warehouse, alerts.risky_agents(profiles), run_id or f"risk_{uuid.uuid4().hex}", F.current_timestamp() if as_of is None else moment(as_of))
    return profiles


def import_crm(spark: SparkSession, paths: list[str], root: str, as_of: datetime, agent: dict, campaign: dict, buckets: int = BUCKETS) -> dict:
    """CRM export files → leads refreshed in place, events added where absent. Returns rows per action."""
    prepare(spark)
    warehouse, at = Warehouse(spark, root, buckets).recover(), moment(as_of)
    seed(warehouse)
    rows = write_stage(imports.crm_export(spark, paths), "crm")
    leads = write_stage(dims.crm_leads(rows), "crm-leads")
    merged = warehouse.merge_leads(leads, lambda stored: dims.refresh_leads(stored, leads, at))
    events = facts.crm_events(rows, agent["agent_id"], campaign["campaign_id"], at)
    added = _book(warehouse, events, agent, campaign, at)
    leads = {r["action"]: r["n"] for r in dims.load_counts(merged).collect()}
    return {"leads_added": leads.get("insert", 0), "leads_updated": leads.get("update", 0), "events_added": added}


def import_archive(
    spark: SparkSession, root: str, as_of: datetime, connections: list[str] = (), invitations: list[str] = (), buckets: int = BUCKETS
) -> dict:
    """Account archive files → connected leads with their ACCEPTED events, and INVITE_SENT events."""
    prepare(spark)
    warehouse, at = Warehouse(spark, root, buckets).recover(), moment(as_of)
    seed(warehouse)
    agent, campaign = facts.ARCHIVE_AGENT, facts.ARCHIVE_CAMPAIGN
    done = {"leads_added": 0, "events_added": 0, "invites_added": 0}
    if connections:
        people = write_stage(facts.archive_connections(imports.connections(spark, list(connections)), at), "archive")
        new = people.drop("connected_at").join(dims.current(warehouse.read("dim_lead")).select("lead_id"), "lead_id", "left_anti")
        new = write_stage(new, "archive-leads")
        merged = warehouse.merge_leads(new, lambda stored: dims.merge_leads(stored, new, at))
        done["leads_added"] = merged.filter("_action = 'insert'").count()
        done["events_added"] = _book(
            warehouse, facts.connection_events(people, agent["agent_id"], campaign["campaign_id"]), agent, campaign, at
        )
    if invitations:
        sent = facts.invitation_events(imports.invitations(spark, list(invitations)), agent["agent_id"], campaign["campaign_id"], at)
        done["invites_added"] = _book(warehouse, sent, agent, campaign, at)
    return done


def _book(warehouse: Warehouse, events: DataFrame, agent: dict, campaign: dict, at: Column) -> int:
    """Add events that are not there yet, on an agent and campaign made if need be."""
    for table, key, row, surrogate in (
        ("dim_agent", "agent_id", agent, "agent_key"), ("dim_campaign", "campaign_id", campaign, "campaign_key"),
    ):
        warehouse.replace(table, dims.ensure_row(warehouse.read(table), key, row, surrogate, at))
    new = facts.absent_from(write_stage(events, "booked"), warehouse.read("fact_outreach_event"))
    known = {t: warehouse.read(t) for t in ("dim_agent", "dim_lead", "dim_campaign")}
    fact = write_stage(facts.as_fact(facts.resolve_keys(new, known), at), "booked-resolved")
    return warehouse.upsert_events(fact)["insert"]
