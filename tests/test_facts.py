import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from funnelspark.operators import dims, facts, marts
from funnelspark.sources.warehouse import Warehouse


def at(text="2026-01-01 00:00:00"):
    return F.lit(text).cast("timestamp")


def events(spark, rows):
    typed = spark.createDataFrame(
        rows, "event_source_id string, event_type string, event_timestamp timestamp, event_status string, response_time_minutes int"
    )
    return typed.withColumn("date_key", (F.year("event_timestamp") * 10000 + F.month("event_timestamp") * 100 + F.dayofmonth("event_timestamp")))


def test_upsert_changes_only_status_and_response(spark):
    old = facts.as_fact(events(spark, [("e1", "ACCEPTED", datetime(2026, 1, 1), "SUCCESS", 5)]), at())
    new = facts.as_fact(events(spark, [("e1", "FAILED", datetime(2026, 2, 1), "LATE", None), ("e2", "ACCEPTED", datetime(2026, 1, 3), "S", 1)]), at("2026-03-01"))
    got = {r.event_source_id: r for r in facts.upsert_events(old, new).collect()}
    assert (got["e1"].event_type, got["e1"].event_status, got["e1"].response_time_minutes, got["e1"].date_key) == ("ACCEPTED", "LATE", None, 20260101)
    assert got["e1"].loaded_at.month == 1 and got["e2"]._action == "insert"


def test_batch_keeps_first_and_last(spark):
    rows = events(spark, [("e", "SENT", datetime(2026, 1, 1), "A", 1), ("e", "LATER", datetime(2026, 1, 2), "B", None)])
    placed = rows.withColumn("_o", F.when(F.col("event_type") == "SENT", 1).otherwise(2))
    row = facts.latest_of_batch(placed, F.col("_o")).first()
    assert (row.event_type, row.event_status, row.response_time_minutes) == ("SENT", "B", None)


def test_point_in_time_keys(spark):
    leads = spark.createDataFrame([("x", "n", "c", "t", None, "s", "A")], "lead_id string, full_name string, company string, title string, linkedin_url string, segment string, lead_status string")
    dim = dims.merge_leads(dims.empty(spark, "dim_lead"), leads, at("2026-01-01")).drop("_action")
    dim = dims.merge_leads(dim, leads.withColumn("lead_status", F.lit("B")), at("2026-01-10")).drop("_action")
    rows = spark.createDataFrame([("x", datetime(2025, 12, 31)), ("x", datetime(2026, 1, 5)), ("x", datetime(2026, 1, 10)), ("y", datetime(2026, 1, 10))],
                                 "lead_id string, event_timestamp timestamp")
    status = dim.select("lead_key", "lead_status")
    got = facts.resolve_keys_at(rows, dim, "dim_lead").join(status, "lead_key", "left").orderBy("lead_id", "event_timestamp")
    assert [r.lead_status for r in got.collect()] == [None, "A", "B", None]


def test_keys_at_a_time_equal_brute_force(spark):
    """An id with thousands of versions, gaps, empty versions, events on every edge, without id or time, and repeated rows."""
    rng = random.Random(5)
    start = datetime(2026, 1, 1)
    versions, t = [], start
    for n in range(3000):
        end = t + timedelta(seconds=rng.choice([0, 1, 60, 3600, 5000]))
        versions.append(("hot", n, t, end))
        t = end + timedelta(seconds=rng.choice([0, 0, 0, 1800]))
    versions += [("open", 5000, start, None), ("late", 5001, datetime(2027, 1, 1), None), ("none", 5002, None, None), (None, 5003, start, None)]
    edges = [v[k] for v in rng.sample(versions[:3000], 300) for k in (2, 3)]
    times = edges + [start + timedelta(seconds=rng.uniform(-5000, (t - start).total_seconds() + 5000)) for _ in range(600)]
    rows = [(n, i, at) for n, at in enumerate([*times, None]) for i in ("hot", "open", "late", "none", None)] + [(0, "hot", times[0])]
    dim = spark.createDataFrame(versions, "lead_id string, lead_key bigint, valid_from timestamp, valid_to timestamp")
    got = facts.resolve_keys_at(spark.createDataFrame(rows, "n int, lead_id string, event_timestamp timestamp"), dim, "dim_lead")
    assert got.columns == ["n", "lead_id", "event_timestamp", "lead_key"]

    def key(i, at):
        if i is None or at is None:
            return None
        hits = [k for j, k, begin, end in versions if j == i and begin is not None and begin <= at and (end is None or at < end)]
        return hits[0] if hits else None

    want = [(n, i, at, key(i, at)) for n, i, at in rows]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr) and sum(w[3] is not None for w in want) > 1000
    assert facts.resolve_keys_at(spark.createDataFrame([], "n int, lead_id string, event_timestamp timestamp"), dim, "dim_lead").count() == 0


def test_stored_fact_upsert_is_idempotent_and_touches_little(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path), buckets=4)
    rows = [(f"e{n}", "ACCEPTED", datetime(2026, 1 + n % 3, 1), "SUCCESS", n) for n in range(60)]
    first = facts.as_fact(events(spark, rows), at())
    assert warehouse.upsert_events(first) == {"insert": 60, "update": 0, "skip": 0}
    assert warehouse.upsert_events(first) == {"insert": 0, "update": 0, "skip": 60}
    before = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    parts = {r[:] for r in warehouse.read("fact_outreach_event").filter("event_source_id = 'e0'").select("bucket", "month").collect()}
    change = [("e0", "FAILED", datetime(2027, 5, 5), "LATE", 9), ("new", "ACCEPTED", datetime(2026, 2, 2), "SUCCESS", None)]
    assert warehouse.upsert_events(facts.as_fact(events(spark, change), at("2026-06-01"))) == {"insert": 1, "update": 1, "skip": 0}
    got = {r.event_source_id: r for r in warehouse.read("fact_outreach_event").collect()}
    assert len(got) == 61 and (got["e0"].event_status, got["e0"].date_key, got["e0"].month) == ("LATE", 20260101, 202601)
    parts |= {r[:] for r in warehouse.read("fact_outreach_event").filter("event_source_id = 'new'").select("bucket", "month").collect()}
    now = {p: p.stat().st_mtime_ns for p in tmp_path.rglob("*.parquet")}
    touched = {p.parent for p in now.keys() ^ before.keys()}
    assert {tuple(int(f.name.split("=")[1]) for f in (p.parent, p)) for p in touched} == parts  # the changed part and that of the new row
    assert all(now[p] == t for p, t in before.items() if p.parent not in touched)


def test_mart_upsert_touches_only_its_months(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path))
    by = ["agent_key", "date_key"]

    def days(rows):
        fact = spark.createDataFrame(rows, "agent_key bigint, date_key int, event_type string")
        return marts.daily_agent_activity(fact)

    warehouse.upsert_mart("fact_daily_agent_activity", days([(1, 20260101, "ACCEPTED"), (1, 20260201, "ACCEPTED")]), by)
    january = set((tmp_path / "fact_daily_agent_activity").glob("v*/month=202601/*.parquet"))
    warehouse.upsert_mart("fact_daily_agent_activity", days([(1, 20260201, "INVITE_SENT"), (2, 20260202, "ACCEPTED")]), by)
    got = {(r.agent_key, r.date_key): (r.invites_sent, r.invites_accepted) for r in warehouse.read("fact_daily_agent_activity").collect()}
    assert got == {(1, 20260101): (0, 1), (1, 20260201): (1, 0), (2, 20260202): (0, 1)}
    assert january == set((tmp_path / "fact_daily_agent_activity").glob("v*/month=202601/*.parquet"))


def test_chronology(spark):
    rows = spark.createDataFrame(
        [(1, 1, "INVITE_SENT", datetime(2026, 1, 2)), (1, 1, "ACCEPTED", datetime(2026, 1, 1)), (1, 2, "ACCEPTED", datetime(2026, 1, 1)),
         (2, 1, "INVITE_SENT", datetime(2026, 1, 1)), (2, 1, "ACCEPTED", datetime(2026, 1, 1))],
        "agent_key int, lead_key int, event_type string, event_timestamp timestamp",
    )
    assert {(r.agent_key, r.lead_key): r.in_order for r in facts.chronology(rows).collect()} == {(1, 1): False, (2, 1): True}
