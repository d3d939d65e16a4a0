"""Incremental runs take every row once: late ones, ones without a time, changes within the overlap."""

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from funnelspark.plans import batch, increments
from funnelspark.sources import warehouse as warehouses
from funnelspark.sources.warehouse import Warehouse

COLUMNS = "pos int, id string, status string, updated_at string"


def run(spark, root, rows, day, run_id):
    frame = spark.createDataFrame(rows, COLUMNS)
    return batch.run_batch(spark, f"{root}/none", root, datetime(2026, 8, day), run_id, buckets=4, entity_frames={"leads": (frame, ["pos"])}, since={"leads": "updated_at"}, overlap=timedelta(days=2))


def test_nothing_is_lost(spark, tmp_path):
    root = str(tmp_path)
    warehouse = Warehouse(spark, root, buckets=4)
    first = [(1, "a", "NEW", "2026-01-10 00:00:00"), (2, "b", "NEW", "2026-01-09 00:00:00"), (3, "old", "NEW", "2025-01-01 00:00:00")]
    assert run(spark, root, first, 1, "r1")["rows_extracted"] == 3
    # The watermark is the newest time read, not the clock of the run.
    assert warehouse.watermark("leads") == datetime(2026, 1, 10)
    second = first + [
        (4, "c", "NEW", "2026-01-11 00:00:00"),  # newer
        (5, "late", "NEW", "2025-03-01 00:00:00"),  # long before the watermark, unknown
        (6, "b", "WON", "2026-01-09 12:00:00"),  # a change within the overlap that arrived late
        (7, "b", "MID", "2026-01-09 06:00:00"),  # superseded by it
        (8, "old", "WON", "2024-01-01 00:00:00"),  # an older state of a known key
        (9, "no-time", "NEW", None), (10, "bad-time", "NEW", "soon"), (11, None, "NEW", "2026-01-01 00:00:00"),
    ]
    done = run(spark, root, second, 2, "r2")
    assert (done["rows_extracted"], done["dlq_count"]) == (6, 3)
    state = {(r.lead_id, r.lead_status) for r in warehouse.read("dim_lead").filter("is_current").collect()}
    assert state == {("a", "NEW"), ("b", "WON"), ("c", "NEW"), ("late", "NEW"), ("old", "NEW")}
    letters = [(r.error_type, r.source_id, r.entity_name) for r in warehouse.read("dead_letter_queue").collect()]
    assert sorted(letters, key=str) == sorted([("missing_update_time", "no-time", "leads"), ("missing_update_time", "bad-time", "leads"), ("missing_lead_id", None, "leads")], key=str)
    assert warehouse.watermark("leads") == datetime(2026, 1, 11)
    # Read again: nothing is taken twice, no letter is written twice, the ledger holds the overlap only.
    again = run(spark, root, second, 3, "r3")
    assert (again["rows_extracted"], again["dlq_count"]) == (0, 0) and warehouse.read("dead_letter_queue").count() == 3
    ledger = {(r.record_key, r.synced_at) for r in warehouse.read("pipeline_synced").collect()}
    assert ledger == {("a", datetime(2026, 1, 10)), ("b", datetime(2026, 1, 9, 12)), ("c", datetime(2026, 1, 11))}
    # A letter mended by hand is loaded by a replay of its entity.
    mended = warehouse.read("dead_letter_queue").filter("source_id = 'no-time'").withColumn("error_message", F.lit("checked"))
    warehouse.append("dead_letter_queue", mended, ["r2"])
    assert batch.replay_letters(spark, root, datetime(2026, 8, 4), "leads", buckets=4)["resolved"] == 1
    assert warehouse.read("dim_lead").filter("lead_id = 'no-time'").count() == 1


def test_a_failed_load_keeps_the_watermark(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    rows = [(1, "a", "NEW", "2026-01-10 00:00:00")]
    with monkeypatch.context() as patched:
        patched.setattr(batch, "check", lambda *_: 1 / 0)
        try:
            run(spark, root, rows, 1, "r1")
        except ZeroDivisionError:
            pass
    warehouse = Warehouse(spark, root, buckets=4)
    assert warehouse.watermark("leads") is None
    assert run(spark, root, rows, 2, "r2")["rows_extracted"] == 1 and warehouse.read("dim_lead").count() == 1


def test_a_run_reads_what_it_landed(spark, tmp_path, monkeypatch):
    root, schema = str(tmp_path), "pos int, id string, event_type string, timestamp string, agent_id string"
    raw = spark.createDataFrame([(2, "e1", "sent", "2026-08-15", "late copy"), (1, "e1", "sent", "2026-08-14", "a"), (3, "e2", None, "2026-08-15", "a"), (4, None, "sent", "2026-08-15", "a"), (10, "e3", "replied", "2026-08-15", "a")], schema)

    def load(run_id):
        return batch.run_batch(spark, f"{root}/none", root, datetime(2026, 8, 20), run_id, buckets=4, entity_frames={"events": (raw, ["pos"])}, land=True)

    with monkeypatch.context() as patched:
        patched.setattr(batch, "_store", lambda *_: 1 / 0)
        try:
            load("r1")
        except ZeroDivisionError:
            pass
    warehouse = Warehouse(spark, root, buckets=4)
    landed = lambda: sorted((r.source_id or "", r.position.lstrip("0"), r.state, r.processed) for r in warehouse.read("stg_raw_events").filter("run_id = 'r1'").collect())
    # A crash after the landing leaves every record there.
    assert {s for *_, s, _ in landed()} == {"received"} and len(landed()) == 5
    done = batch.reprocess(spark, root, "r1", datetime(2026, 8, 20), "again", buckets=4)
    assert done == {"rows_extracted": 5, "rows_loaded": 2, "dlq_count": 2}
    states = [("", "4", "dead_lettered", False), ("e1", "1", "processed", True), ("e1", "2", "duplicate", True), ("e2", "3", "dead_lettered", False), ("e3", "10", "processed", True)]
    assert landed() == states
    fact = lambda: {(r.event_source_id, str(r.event_timestamp)) for r in warehouse.read("fact_outreach_event").collect()}
    loaded = {("e1", "2026-08-14 00:00:00"), ("e3", "2026-08-15 00:00:00")}
    assert fact() == loaded
    assert batch.reprocess(spark, root, "r1", datetime(2026, 8, 21), "again", buckets=4)["rows_loaded"] == 0
    assert landed() == states and fact() == loaded
    assert load("r2")["rows_extracted"] == 5 and fact() == loaded and warehouse.read("stg_raw_events").count() == 10


def test_a_run_stages_only_what_is_read_again(spark, tmp_path, monkeypatch):
    """Clean rows are staged once and without their raw record; of a run that reads much, only rows that need a lookup are staged anew, and merged leads are written once beside their table."""
    root, staged = str(tmp_path), {}
    for module in (batch, increments, warehouses):
        stage = module.write_stage
        monkeypatch.setattr(module, "write_stage", lambda df, label, stage=stage: staged.setdefault(label, stage(df, label)))
    first = [(1, "a", "NEW", "2026-01-10 00:00:00"), (2, "old", "NEW", "2025-01-01 00:00:00")]
    run(spark, root, first, 1, "r1")
    staged.clear()
    second = [*first, (3, "c", "NEW", "2026-01-11 00:00:00"), (4, "late", "NEW", "2025-03-01 00:00:00"), (5, "no-time", "NEW", None), (6, None, "NEW", "2026-01-12 00:00:00")]
    done = run(spark, root, second, 2, "r2")
    assert (done["rows_extracted"], done["rows_loaded"], done["dlq_count"]) == (4, 2, 2)
    assert set(staged) >= {"leads-late", "leads-candidates", "leads-looked-up"} and not {"leads-routed", "leads-merged"} & set(staged)
    assert {r[0] for r in staged["leads-late"].collect()} == {"late"}
    assert {r["_o_pos"]: r["_raw"] is None for r in staged["leads-candidates"].collect()} == {1: True, 3: True, 4: True, 5: False, 6: False}
    # "a" is in the ledger; "c" and the new reject are looked up nowhere.
    assert {r["_o_pos"] for r in staged["leads-looked-up"].collect()} == {4, 5}
    warehouse = Warehouse(spark, root, buckets=4)
    assert {(r.lead_id, r.is_current) for r in warehouse.read("dim_lead").collect()} == {("a", True), ("old", True), ("c", True), ("late", True)}
    assert "_action" not in spark.read.parquet(f"{root}/dim_lead/v*").columns
    letters = {(r.source_id, json.loads(r.record_payload)["status"]) for r in warehouse.read("dead_letter_queue").collect()}
    assert letters == {("no-time", "NEW"), (None, "NEW")}
