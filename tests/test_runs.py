"""Whole runs: a batch load, its repetition, imports, risk, and the same events as a stream."""

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import clean
from funnelspark.plans import batch
from funnelspark.sources.warehouse import Warehouse
from funnelspark.streaming import live

AS_OF = datetime(2026, 8, 20)
DAYS = 8


def write_sources(folder):
    (folder / "agents.csv").write_text("id,name,email,status,account_age\na1,Alpha,a@x,active,6-12 Months\na2,Beta,b@x,paused,1 Month\n,None,,,\n")
    (folder / "leads.json").write_text(json.dumps({"data": [{"id": f"l{n}", "name": f"Lead {n}", "segment": "s"} for n in range(6)]}))
    (folder / "campaigns.csv").write_text("id,name,type,segment,created_at\nc1,One,t,s,2026-01-01\n")
    (folder / "templates.csv").write_text("id,name,body,channel\nt1,Hello,Hi {{first_name}},email\n")
    (folder / "events.json").write_text(json.dumps(raw_events()))


def raw_events():
    out = []
    for day in range(DAYS):
        for n in range(6):
            kind = ["invite_sent", "Accepted", "message", "reply", "meeting", "odd-type"][n]
            out.append({"id": f"e{day}-{n}", "agent_id": f"a{1 + n % 2}", "lead_id": f"l{n}", "campaign_id": "c1", "template_id": "t1",
                        "event_type": kind, "timestamp": f"2026-08-{10 + day}T0{n}:00:00Z"})
    out.append({"id": "bad", "event_type": "sent", "timestamp": "never"})
    return out


def rows(warehouse, table, *drop):
    return sorted((tuple(r) for r in warehouse.read(table).drop("loaded_at", "anomaly_score", *drop).collect()), key=repr)


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("run")
    (folder / "in").mkdir()
    write_sources(folder / "in")
    summary = batch.run_batch(spark, str(folder / "in"), str(folder / "wh"), AS_OF, "run_1", buckets=4)
    return folder, Warehouse(spark, str(folder / "wh"), buckets=4), summary


def test_batch_run(loaded):
    _, warehouse, summary = loaded
    assert (summary["status"], summary["rows_extracted"], summary["dlq_count"]) == ("PARTIAL", 3 + 6 + 1 + 1 + 6 * DAYS + 1, 2)
    assert summary["rows_loaded"] == 2 + 6 + 1 + 1 + 6 * DAYS
    assert warehouse.read("fact_outreach_event").filter("agent_key is null or lead_key is null or campaign_key is null").count() == 0
    assert {r.error_type for r in warehouse.read("dead_letter_queue").collect()} == {"missing_agent_id", "bad_timestamp"}
    assert warehouse.read("fact_daily_agent_activity").count() == 2 * DAYS
    run = warehouse.read("fact_pipeline_run").first()
    assert run.status == "PARTIAL" and run.dq_score == summary["dq_score"] > 90 and run.dq_passed
    assert {r.entity_name for r in warehouse.read("pipeline_watermarks").collect()} == {"agents", "leads", "campaigns", "events"}
    assert warehouse.watermark("agents") == AS_OF
    assert warehouse.read("dq_results").count() == 20


def test_rerun_adds_nothing(spark, loaded):
    folder, warehouse, _ = loaded
    tables = ["fact_outreach_event", "fact_daily_agent_activity", "fact_campaign_performance", "dim_agent", "dim_lead", "dim_campaign"]
    before = {t: rows(warehouse, t) for t in tables}
    again = batch.run_batch(spark, str(folder / "in"), str(folder / "wh"), datetime(2026, 8, 21), "run_2", buckets=4)
    assert {t: rows(warehouse, t) for t in tables} == before and again["rows_loaded"] == 0
    repeated = batch.run_batch(spark, str(folder / "in"), str(folder / "wh"), datetime(2026, 8, 21), "run_2", buckets=4)
    assert repeated["rows_loaded"] == 0 and warehouse.read("dead_letter_queue").count() == 4  # two letters per run id


def test_failed_run_is_recorded(spark, tmp_path):
    (tmp_path / "agents.json").write_text("{ not json")
    with pytest.raises(Exception):
        batch.run_batch(spark, str(tmp_path), str(tmp_path / "wh"), AS_OF, "broken")
    run = Warehouse(spark, str(tmp_path / "wh")).read("fact_pipeline_run").first()
    assert run.status == "FAILED" and run.error_message and run.dq_score is None


def test_failed_run_keeps_its_letters(spark, tmp_path, monkeypatch):
    write_sources(tmp_path)

    def broken(*_):
        raise ValueError("no marts today")

    monkeypatch.setattr(batch, "refresh_marts", broken)
    with pytest.raises(ValueError):
        batch.run_batch(spark, str(tmp_path), str(tmp_path / "wh"), AS_OF, "run_1", buckets=4)
    warehouse = Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    assert warehouse.read("fact_pipeline_run").first().error_message == "no marts today"
    assert {r.error_type for r in warehouse.read("dead_letter_queue").collect()} == {"missing_agent_id", "bad_timestamp"}


def test_replay_of_stored_letters(spark, tmp_path):
    root, at = str(tmp_path), F.lit("2026-08-20").cast("timestamp")
    raw = spark.createDataFrame([(1, "x" * 201, "sent", "2026-08-15"), (2, "e2", "sent", "never"), (3, "e3", None, "2026-08-15")],
                                "pos int, id string, event_type string, timestamp string")
    judged = clean.check_limits(clean.route(raw, "events", ["pos"]), "fact_outreach_event")
    letters = clean.dead_letters(judged, "r1", at)
    assert {(r.source_id, r.source) for r in letters.collect()} == {("x" * 201, "loader"), ("e2", "transformer"), ("e3", "transformer")}
    mended = F.regexp_replace(F.regexp_replace("record_payload", "x{201}", "e1"), "never", "2026-08-16")
    warehouse = Warehouse(spark, root, buckets=4)
    warehouse.append("dead_letter_queue", letters.withColumn("record_payload", mended), ["r1"])
    others = clean.dead_letters(clean.route(spark.createDataFrame([(1, None)], "pos int, id string"), "agents", ["pos"]), "r1b", at)
    warehouse.append("dead_letter_queue", others, ["r1b"])

    def state():
        return {(r.error_type, r.resolved, r.resolved_at is not None) for r in warehouse.read("dead_letter_queue").collect()}

    assert batch.replay_letters(spark, root, AS_OF, "events", buckets=4) == {"resolved": 2, "rows_loaded": 2}
    after = {("too_long", True, True), ("bad_timestamp", True, True), ("missing_event_type", False, False), ("missing_agent_id", False, False)}
    assert state() == after and warehouse.read("dead_letter_queue").count() == 4
    assert {r.event_source_id for r in warehouse.read("fact_outreach_event").collect()} == {"e1", "e2"}
    assert batch.replay_letters(spark, root, AS_OF, "events", buckets=4) == {"resolved": 0, "rows_loaded": 0} and state() == after


def test_risk_run(spark, loaded):
    folder, warehouse, _ = loaded
    profiles = {r.agent_id: r for r in batch.run_risk(spark, str(folder / "wh"), buckets=4).collect()}
    assert set(profiles) == {"a1", "a2"} and profiles["a1"].tier_name == "6-12 Months"
    scored = warehouse.read("fact_daily_agent_activity").filter("anomaly_score is not null").collect()
    assert len(scored) == 2 and {r.date_key for r in scored} == {20260810 + DAYS - 1}


@pytest.mark.parametrize("files_per_batch", [1, 3])
def test_stream_equals_batch(spark, loaded, tmp_path, files_per_batch):
    _, batch_warehouse, _ = loaded
    warehouse = Warehouse(spark, str(tmp_path / "wh"), buckets=4)
    for table in ("dim_agent", "dim_lead", "dim_campaign", "dim_message_template", "dim_account_tier"):
        warehouse.replace(table, batch_warehouse.read(table))
    landing = tmp_path / "in"
    landing.mkdir()
    events = raw_events()
    for part in range(3):
        chosen = [e for n, e in enumerate(events) if n % 3 == part] + events[:2]  # the first two are redelivered every time
        (landing / f"part_{part}.json").write_text("\n".join(json.dumps(e) for e in chosen))
    at = F.lit("2026-08-20").cast("timestamp")
    stream = live.live_payloads(live.read_landing(spark, str(landing), max_files=files_per_batch), ["_file", "_block"])
    stream = stream.withColumn("_row", F.col("event_id"))
    query = live.start_ingest(stream, warehouse, str(tmp_path / "cp"), ["_file", "_block", "_row"], at=at)
    query.awaitTermination()
    for table in ("fact_outreach_event", "fact_daily_agent_activity"):
        assert rows(warehouse, table) == rows(batch_warehouse, table), table
    receipts = warehouse.read("live_receipts", live.RECEIPTS)
    assert {r.status: r["count"] for r in receipts.groupBy("status").count().collect()} == {"SUCCESS": 6 * DAYS + 3 * 2, "DEAD_LETTERED": 1}
    assert warehouse.read("dead_letter_queue").filter("error_type = 'bad_timestamp'").count() == 1


def test_replayed_micro_batch_changes_nothing(spark, loaded, tmp_path):
    _, batch_warehouse, _ = loaded
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    for table in ("dim_agent", "dim_account_tier"):
        warehouse.replace(table, batch_warehouse.read(table))
    events = spark.createDataFrame([(1, "e1", "a1", "sent", "2026-08-15"), (2, "e1", "a1", "reply", "2026-08-16"), (3, "x", "a1", None, "2026-08-16")],
                                   "pos int, event_id string, agent_id string, event_type string, timestamp string")
    at = F.lit("2026-08-20").cast("timestamp")
    for _ in range(2):
        live.ingest(live.live_payloads(events, ["pos"]), warehouse, "batch_1", at, ["pos"], zero_rate=True)
        assert warehouse.read("fact_outreach_event").count() == 1 and warehouse.read("live_receipts", live.RECEIPTS).count() == 3
        day = warehouse.read("fact_daily_agent_activity").first()
        assert (day.date_key, day.invites_sent, day.acceptance_rate, day.reply_rate) == (20260815, 1, 0.0, 0.0)
        assert warehouse.read("dead_letter_queue").count() == 1


def test_two_streams_keep_their_letters_and_receipts(spark, tmp_path):
    warehouse, at = Warehouse(spark, str(tmp_path / "wh"), buckets=4), F.lit("2026-08-20").cast("timestamp")
    for name in ("a", "b"):
        folder = tmp_path / name
        folder.mkdir()
        records = [{"id": name * 201, "event_type": "sent", "timestamp": "2026-08-15"}, {"id": name, "event_type": "sent", "timestamp": "2026-08-15"},
                   {"id": name, "event_type": "reply", "timestamp": "2026-08-16", "status": "DUP"}]
        (folder / "1.json").write_text("\n".join(map(json.dumps, records)))
        stream = live.read_landing(spark, str(folder))
        live.start_ingest(stream, warehouse, str(tmp_path / f"cp-{name}"), at=at).awaitTermination()
    receipts = warehouse.read("live_receipts", live.RECEIPTS).collect()
    assert sorted((r.event_id[0], len(r.event_id), r.status) for r in receipts) == [
        (n, k, s) for n in "ab" for k, s in ((1, "SUCCESS"), (1, "SUCCESS"), (201, "DEAD_LETTERED"))]
    assert len({r.run_id for r in receipts}) == 2
    assert {(r.source_id[0], r.source, r.error_type) for r in warehouse.read("dead_letter_queue").collect()} == {(n, "loader", "too_long") for n in "ab"}
    # Of two copies in one file the first fixes the kind, the last the status.
    assert {(r.event_source_id, r.event_type, r.event_status) for r in warehouse.read("fact_outreach_event").collect()} == {(n, "INVITE_SENT", "DUP") for n in "ab"}


def test_webhooks(spark):
    at = F.lit("2026-08-20 01:02:03").cast("timestamp")
    raw = spark.createDataFrame([(None, "acc", "l1", "reply", None), ("w1", None, None, None, "2026-08-01")],
                                "id string, account_id string, contact_id string, action string, created_at string")
    got = sorted(live.webhook_payloads(live.with_arrival(raw, at)).collect(), key=lambda r: r.id)
    assert (got[0].id, got[0].agent_id, got[0].event_type, got[0].timestamp) == ("w1", "live_agent_default", "MESSAGE_SENT", "2026-08-01")
    assert got[1].id.startswith("wh_") and got[1].lead_id == "l1" and got[1].timestamp.startswith("2026-08-20T01:02:03")


def test_live_leads(spark, tmp_path):
    (tmp_path / "in").mkdir()
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    at = F.lit("2026-08-20").cast("timestamp")

    def deliver(name, status):
        (tmp_path / "in" / name).write_text(json.dumps({"lead_id": "l1", "first_name": "Ann", "last_name": "Lee", "status": status}))
        stream = live.read_landing(spark, str(tmp_path / "in"), "leads").withColumn("_row", F.lit(0))
        live.start_leads(stream, warehouse, str(tmp_path / "cp"), ["_file", "_block", "_row"], at=at).awaitTermination()

    deliver("1.json", "NEW")
    deliver("2.json", "WON")
    assert {(r.full_name, r.lead_status, r.is_current) for r in warehouse.read("dim_lead").collect()} == {("Ann Lee", "NEW", False), ("Ann Lee", "WON", True)}


def test_imports(spark, tmp_path):
    (tmp_path / "crm.csv").write_text("name,job_title,company,location,status,linkedin_url,sent_at,accepted_at\nAnn,,,Town,connected,https://x/in/ann,2026-08-01,2026-08-02\n")
    (tmp_path / "con.csv").write_text("First Name,Last Name,URL,Company,Position,Connected On\nBob,Ray,https://x/in/bob,,,2026-08-03\n")
    agent, campaign = {"agent_id": "me", "status": "active", "tier_key": 5}, {"campaign_id": "camp"}
    root = str(tmp_path / "wh")
    first = batch.import_crm(spark, [str(tmp_path / "crm.csv")], root, AS_OF, agent, campaign, buckets=4)
    assert first == {"leads_added": 1, "leads_updated": 0, "events_added": 2}
    again = batch.import_crm(spark, [str(tmp_path / "crm.csv")], root, AS_OF, agent, campaign, buckets=4)
    assert again == {"leads_added": 0, "leads_updated": 1, "events_added": 0}
    done = batch.import_archive(spark, root, AS_OF, connections=[str(tmp_path / "con.csv")], buckets=4)
    assert done == {"leads_added": 1, "events_added": 1, "invites_added": 0}
    fact = Warehouse(spark, root, buckets=4).read("fact_outreach_event")
    assert fact.count() == 3 and fact.filter("agent_key is null or lead_key is null").count() == 0


def test_nightly_load_keeps_untouched_lead_files(spark, tmp_path):
    root = str(tmp_path / "wh")

    def load(rows, day):
        leads = spark.createDataFrame(rows, "id string, name string, status string, pos int")
        return batch.run_batch(spark, f"{root}/none", root, datetime(2026, 1, day), f"r{day}", buckets=16, entity_frames={"leads": (leads, ["pos"])})

    first = load([(f"l{n}", "Ann", "new", n) for n in range(64)], 1)
    before = {p: p.stat().st_mtime_ns for p in (tmp_path / "wh" / "dim_lead").rglob("*.parquet")}
    second = load([("l1", "Ann", "won", 1), ("l2", "Ann", "new", 2)], 2)
    assert (first["rows_loaded"], second["rows_loaded"]) == (64, 1)
    now = {p: p.stat().st_mtime_ns for p in (tmp_path / "wh" / "dim_lead").rglob("*.parquet")}
    assert 1 <= len({p.parent for p in before if now.get(p) != before[p]}) <= 2 and len({p.parent for p in before}) > 8
    rows = Warehouse(spark, root).read("dim_lead").collect()
    assert len(rows) == 65 and sum(r.is_current for r in rows) == 64 and {r.lead_id for r in rows if not r.is_current} == {"l1"}


def test_long_ids_are_staged_once(spark, monkeypatch):
    """An id that is clean as it came, maybe a whole text, lies in the stage of a micro-batch with the raw record only."""
    rows = [("x" * 5000, 1), (" padded ", 2), (None, 3), ("null", 4), ("plain", 5)]
    raw = spark.createDataFrame([(i, "sent", "2024-01-15T08:30:00Z", n) for i, n in rows], "id string, event_type string, timestamp string, pos long")
    judged = clean.check_limits(clean.route(raw, "events", ["pos"], dedup=False), "fact_outreach_event")
    stages, stage = [], live.write_stage
    monkeypatch.setattr(live, "write_stage", lambda df, label: stages.append(df) or stage(df, label))
    routed = live._staged(judged)
    assert routed.columns == judged.columns and sorted(map(str, routed.collect())) == sorted(map(str, judged.collect()))
    assert {r.event_source_id for r in stages[0].collect()} == {None, "padded"}


def test_a_first_load_stages_its_events_once(spark, tmp_path, monkeypatch):
    """Nothing is stored to compare a first load with, so its resolved events go straight into the table; the stage of verdicts keeps the raw records of rejects only."""
    root, staged, stage = str(tmp_path), {}, batch.write_stage
    monkeypatch.setattr(batch, "write_stage", lambda df, label: staged.setdefault(label, stage(df, label)))

    def load(rows, run_id):
        staged.clear()
        events = spark.createDataFrame(rows, "id string, event_type string, timestamp string, agent_id string, pos int")
        return batch.run_batch(spark, f"{root}/none", root, datetime(2026, 1, 30), run_id, buckets=4, entity_frames={"events": (events, ["pos"])})

    rows = [("e1", "sent", "2026-01-14", "a", 1), ("e1", "sent", "2026-01-15", "a", 2), ("e2", "sent", "2026-02-14", "a", 3), ("e3", "sent", "soon", "a", 4), (None, "sent", "2026-01-14", "a", 5)]
    done = load(rows, "r1")
    assert (done["rows_extracted"], done["rows_loaded"], done["dlq_count"]) == (5, 2, 2) and "events-resolved" not in staged
    assert {r["_o_pos"]: r["_raw"] is None for r in staged["events-routed"].collect()} == {1: True, 3: True, 4: False, 5: False}
    warehouse = Warehouse(spark, root, buckets=4)
    assert {r.date_key for r in warehouse.read("fact_outreach_event").collect()} == {20260114, 20260214}
    payloads = [r.record_payload for r in warehouse.read("dead_letter_queue").orderBy("source_id").collect()]
    assert '"timestamp":"soon"' in payloads[1] and len(payloads) == 2
    # A later load is compared with the table and counts only what is new.
    assert load([*rows, ("e4", "sent", "2026-01-16", "a", 6)], "r2")["rows_loaded"] == 1 and "events-resolved" in staged
    assert warehouse.read("fact_outreach_event").count() == 3
