"""Warehouse writes: nothing lost in a crash, only touched partitions rewritten, small batches that skip row groups."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import dims, facts
from funnelspark.sources import warehouse as module
from funnelspark.sources.warehouse import ConcurrentWrite, Warehouse


def fact(spark, rows, at="2026-08-01"):
    made = spark.createDataFrame(rows, "event_source_id string, event_status string, month int")
    full = made.withColumns({"event_type": F.lit("ACCEPTED"), "response_time_minutes": F.lit(1), "event_timestamp": F.make_timestamp(F.lit(2026), "month", F.lit(1), F.lit(0), F.lit(0), F.lit(0)), "date_key": 20260001 + 100 * F.col("month"),
                             **{k: F.lit(None).cast("bigint") for k in ("agent_key", "lead_key", "campaign_key", "template_key")}})
    return facts.as_fact(full.drop("month"), F.lit(at).cast("timestamp"))


def stored(warehouse):
    return sorted((r.event_source_id, r.event_status) for r in warehouse.read("fact_outreach_event").collect())


ROWS = [(f"e{n}", "SUCCESS", 1 + n % 3) for n in range(30)]
CHANGE = [("e0", "LATE", 1), ("new", "SUCCESS", 2)]


def test_a_crash_within_an_overwrite_loses_nothing(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    warehouse.upsert_events(fact(spark, ROWS))
    before = stored(warehouse)

    def crash(self, table):
        """The driver dies after it has deleted a partition and before it has put the new one in place."""
        part = warehouse.read(table).filter("event_source_id = 'e0'").select("bucket", "month").first()
        for file in tmp_path.glob(f"{table}/v*/bucket={part.bucket}/month={part.month}/*"):
            file.unlink()
        raise OSError("driver is gone")

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "_place", crash)
        with pytest.raises(OSError):
            warehouse.upsert_events(fact(spark, CHANGE))
    assert len(stored(warehouse)) < len(before)
    again = Warehouse(spark, str(tmp_path), buckets=4).recover()
    assert {i: s for i, s in stored(again) if i != "new"} == dict(before) | {"e0": "LATE"}
    again.upsert_events(fact(spark, CHANGE))
    assert stored(again) == sorted((dict(before) | {"e0": "LATE", "new": "SUCCESS"}).items())
    assert again.upsert_events(fact(spark, CHANGE)) == {"insert": 0, "update": 0, "skip": 2} and not list(tmp_path.glob("*/pending"))


def test_a_crash_before_the_overwrite_changes_nothing(spark, tmp_path, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    warehouse.upsert_events(fact(spark, ROWS))
    before = stored(warehouse)

    def crash(*_):
        raise OSError("driver is gone")

    with monkeypatch.context() as patched:
        patched.setattr(Warehouse, "_overwrite", crash)
        with pytest.raises(OSError):
            warehouse.upsert_events(fact(spark, CHANGE))
    assert stored(warehouse) == before
    assert warehouse.upsert_events(fact(spark, CHANGE)) == {"insert": 1, "update": 1, "skip": 0}


def test_versions(spark, tmp_path):
    one, two = Warehouse(spark, str(tmp_path)), Warehouse(spark, str(tmp_path))
    one.read("dim_campaign"), two.replace("dim_campaign", dims.empty(spark, "dim_campaign"))
    with pytest.raises(ConcurrentWrite):
        one.replace("dim_campaign", dims.empty(spark, "dim_campaign"))
    # A write that crashed leaves a version without its mark: nobody reads it, its number is not used again.
    (tmp_path / "dim_campaign" / "v00000002-b2048").mkdir()
    assert one.read("dim_campaign").count() == 0
    row = {"campaign_id": "c", "campaign_name": "n"}
    one.replace("dim_campaign", dims.ensure_row(one.read("dim_campaign"), "campaign_id", row, "campaign_key", F.current_timestamp()))
    assert two.read("dim_campaign").count() == 1 and (tmp_path / "dim_campaign" / "v00000003-b2048").exists()
    two.expire("dim_campaign", keep=1)
    assert [p.name for p in (tmp_path / "dim_campaign").glob("v*")] == ["v00000003-b2048"] and two.read("dim_campaign").count() == 1


def test_many_loads_other_buckets(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    want = {}
    for n in range(6):
        batch = [(f"e{n}", "SUCCESS", 1), *([("e0", f"S{n}", 1)] if n in (2, 4) else []), *[(f"f{n}-{k}", "SUCCESS", 2) for k in range(8)]]
        warehouse.upsert_events(fact(spark, batch))
        want |= {i: s for i, s, _ in batch}
        assert stored(warehouse) == sorted(want.items())
    files = len(list(tmp_path.rglob("month=*/*.parquet")))
    warehouse.compact("fact_outreach_event", files=1)
    assert len(list(tmp_path.rglob("month=*/*.parquet"))) < files and stored(warehouse) == sorted(want.items())
    warehouse.rebucket("fact_outreach_event", 16)
    assert Warehouse(spark, str(tmp_path), buckets=4).buckets_of("fact_outreach_event") == 16 and stored(warehouse) == sorted(want.items())
    assert warehouse.upsert_events(fact(spark, [("e0", "LATE", 1), ("new", "SUCCESS", 3)])) == {"insert": 1, "update": 1, "skip": 0}


def test_few_ids_skip_row_groups(spark, tmp_path):
    """The ids of a small batch reach the scan, where bloom filters skip the row groups of all files that do not hold them."""
    warehouse = Warehouse(spark, str(tmp_path), buckets=2)
    warehouse.upsert_events(fact(spark, [(f"e{n:05d}", "SUCCESS", 1 + n % 6) for n in range(6000)]))
    batch = fact(spark, [(f"e{n:05d}", "LATE", 1) for n in (30, 600, 1200, *range(90000, 90020))])
    rows = batch.withColumns({"bucket": module.id_bucket(2), "month": module.month_of()})
    found = warehouse._stored_of(rows)
    assert found.count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(event_source_id" in plan and "PartitionFilters: [bucket" in plan
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        ids = [r.event_source_id for r in rows.collect()]
        scan = warehouse.read("fact_outreach_event").filter(F.col("event_source_id").isin(ids)).select("event_source_id")._jdf.queryExecution()
        scan.toRdd().count()
        read = scan.executedPlan().collectLeaves().head().metrics().get("numOutputRows").get().value()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # Twelve partitions of 500 ids each lie over the same range of ids; those ids lie in one month, in both buckets.
    assert 0 < read <= 1500


def test_logs_hold_each_run_once(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)

    def put(run, n):
        rows = spark.range(n).select(F.concat(F.lit(run), "id").alias("event_id"), *[F.lit(None).cast(t).alias(c) for c, t in (
            ("event_type", "string"), ("status", "string"), ("warning", "string"), ("persisted_at", "timestamp"))], F.lit(run).alias("run_id"))
        warehouse.append("live_receipts", rows, [run])

    for run, n in (("a/1: x", 3), ("b", 2), ("a/1: x", 1), ("c", 0), ("b", 4), ("d", 1), ("a/1: x", 0)):
        put(run, n)
    assert {r.run_id: r["count"] for r in warehouse.read("live_receipts").groupBy("run_id").count().collect()} == {"b": 4, "d": 1}


def test_leads_keep_the_files_of_other_buckets(spark, tmp_path):
    warehouse, at = Warehouse(spark, str(tmp_path), buckets=8), F.lit(datetime(2026, 8, 1))

    def leads(ids, status):
        return spark.createDataFrame([(i, "n", "c", "t", None, "s", status) for i in ids], "lead_id string, full_name string, company string, title string, linkedin_url string, segment string, lead_status string")

    first = leads([f"l{n}" for n in range(40)], "NEW")
    warehouse.merge_leads(first, lambda old: dims.merge_leads(old, first, at))
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    change = leads(["l1"], "WON")
    warehouse.merge_leads(change, lambda old: dims.merge_leads(old, change, F.lit(datetime(2026, 8, 2))))
    now = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    assert len({p.parent for p in now.items() ^ before.items() for p in p[:1]}) == 1
    rows = warehouse.read("dim_lead").collect()
    assert len(rows) == 41 and {(r.lead_status, r.is_current) for r in rows if r.lead_id == "l1"} == {("NEW", False), ("WON", True)}


def test_a_load_stages_no_copy_of_its_events(spark, tmp_path, monkeypatch):
    """Of a batch that is a stage already only verdicts are staged, without the stored values they came from; tables are written compactly."""
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    warehouse.upsert_events(fact(spark, ROWS))
    staged, stage = {}, module.write_stage
    monkeypatch.setattr(module, "write_stage", lambda df, label: staged.setdefault(label, df.columns) and stage(df, label))
    assert warehouse.upsert_events(fact(spark, [*CHANGE, ("e1", "SUCCESS", 2)])) == {"insert": 1, "update": 1, "skip": 1}
    assert sorted(staged) == ["judged-events", "known-events"] and not {"_known", "_old_event_status"} & set(staged["judged-events"])
    assert stored(warehouse) == sorted([(i, "LATE" if i == "e0" else s) for i, s, _ in ROWS] + [("new", "SUCCESS")])
    files = list(tmp_path.rglob("month=*/*.parquet"))
    assert files and all(f.name.endswith(".zstd.parquet") for f in files)
