import json
import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import alerts, dims, measures, quality


def one(df):
    row = df.first()
    return row.score, json.loads(row.details)


def test_weights():
    assert sum(quality.DIMENSION_WEIGHTS.values()) == pytest.approx(1.0)
    assert set(quality.DIMENSION_WEIGHTS) == {"completeness", "uniqueness", "validity", "timeliness", "referential_integrity"}


def test_profile_in_one_pass(spark):
    rows = spark.createDataFrame(
        [("a", "ACCEPTED", datetime(2026, 1, 2)), ("b", None, datetime(2026, 1, 2)), (None, "ODD", datetime(2025, 12, 1)), ("d", "FAILED", datetime(2026, 1, 2))],
        "event_source_id string, event_type string, loaded_at timestamp")
    at = F.lit("2026-01-02 12:00:00").cast("timestamp")
    checks = {r.check_dimension: r for r in quality.table_profile(rows, "t", ["event_source_id", "event_type"], at, types=True).collect()}
    assert checks["completeness"].score == 75.0 and checks["validity"].score == 75.0 and checks["timeliness"].score == 75.0
    assert json.loads(checks["completeness"].details) == {"null_counts": {"event_source_id": 1, "event_type": 1}, "total_rows": 4}


def test_empty_tables_score_100(spark):
    empty = dims.empty(spark, "fact_outreach_event")
    at = F.lit("2026-01-02").cast("timestamp")
    assert {r.score for r in quality.table_profile(empty, "t", ["event_type"], at, types=True).collect()} == {100.0}
    assert one(quality.uniqueness(empty, "t", "event_source_id")) == (100.0, {"distinct": 0, "total": 0})


def test_uniqueness_ignores_nulls_and_closed_versions(spark):
    rows = spark.createDataFrame([("a", True), ("a", False), ("a", True), (None, True), ("b", True)], "k string, is_current boolean")
    assert one(quality.uniqueness(rows, "t", "k", current_only=True)) == (50.0, {"distinct": 2, "total_current": 4})


def test_references(spark):
    fact = spark.createDataFrame([(1, 10, None), (1, 99, None), (2, None, None), (7, 10, None)], "a int, b int, c int")
    dim = spark.createDataFrame([(1,), (1,), (2,)], "k int")
    other = spark.createDataFrame([(10,), (None,)], "k int")
    rows = {r.table_name: r for r in quality.references(fact, "f", [("a", dim, "k"), ("b", other, "k"), ("c", dim, "k")]).collect()}
    assert rows["f.a"].score == 75.0 and json.loads(rows["f.a"].details) == {"total_fks": 4, "orphans": 1}
    assert rows["f.b"].score == pytest.approx(200 / 3) and rows["f.c"].score == 100.0
    plan = quality.references(fact, "f", [("a", dim, "k"), ("b", other, "k")])._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan


def test_references_of_nothing(spark):
    empty = spark.createDataFrame([], "a int, k int")
    row = quality.references(empty, "f", [("a", empty, "k")]).first()
    assert row.score == 100.0 and json.loads(row.details) == {"total_fks": 0, "orphans": 0}


def test_one_pass_equals_the_single_checks(spark, tmp_path):
    rng = random.Random(3)
    pick = lambda *values: rng.choice([*values, None])
    rows = [(pick("a", "b", f"e{n}"), pick("ACCEPTED", "ODD"), pick(datetime(2026, 1, 2), datetime(2025, 12, 1)), pick(1, 2, 9), pick("x", "y"), pick(True, False)) for n in range(200)]
    schema = "id string, event_type string, loaded_at timestamp, a int, b string, is_current boolean"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "fact"))
    dim = spark.createDataFrame([(1, "x"), (1, "z"), (2, None)], "k bigint, t string")
    foreign, at = [("a", dim, "k"), ("b", dim, "t")], F.lit("2026-01-02 12:00:00").cast("timestamp")
    for fact in (spark.read.parquet(str(tmp_path / "fact")), spark.createDataFrame([], schema)):
        for current in (False, True):
            got = quality.table_checks(fact, "f", ["id", "a"], "id", current, foreign, at, True)
            parts = [quality.table_profile(fact, "f", ["id", "a"], at, True), quality.uniqueness(fact, "f", "id", current), quality.references(fact, "f", foreign)]
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, quality.union_all(parts).collect()))
    assert quality.table_checks(spark.createDataFrame([], schema), "f").count() == 0
    plan = quality.table_checks(spark.read.parquet(str(tmp_path / "fact")), "f", ["id"], "id", False, foreign, at, True)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_idle_agents_are_reported(spark):
    agents = spark.createDataFrame([(1, "a", 1, True), (2, "b", 1, True), (3, "c", 1, False)], "agent_key bigint, agent_id string, tier_key int, is_current boolean")
    days = spark.createDataFrame([(1, 20260801, 5, 0.2), (1, 20260802, 5, 0.4), (2, 20260801, 5, 1.9)],
                                 "agent_key bigint, date_key int, invites_sent bigint, anomaly_score double")
    last = {r.agent_id: (r.date_key, r.agent_risk_score) for r in measures.agent_risk_on_last_date(days, agents).collect()}
    assert last == {"a": (20260802, 20.0), "b": (20260802, None)}
    used = measures.agent_utilisation(days, agents, dims.account_tiers(spark), F.col("date_key") == 20260802).collect()
    assert {(r.agent_id, r.invites, r.active_days, r.agent_utilisation_pct) for r in used} == {("a", 5, 1, 1.0), ("b", 0, 0, 0.0)}
    fact = spark.createDataFrame([("INVITE_SENT",)] * 3, "event_type string")
    assert measures.measure(fact, ["Utilisation %"], tiers=dims.account_tiers(spark)).first()[0] == 0.1


def test_tier_validity(spark):
    days = spark.createDataFrame([(1, 6), (1, 5), (2, 99), (3, 99)], "agent_key bigint, invites_sent bigint")
    agents = spark.createDataFrame([(1, 1, True), (2, None, True), (3, 1, False)], "agent_key bigint, tier_key int, is_current boolean")
    assert one(quality.tier_validity(days, agents, dims.account_tiers(spark))) == (75.0, {"tier_limit_violations": 1})


def checks(spark, scores):
    return spark.createDataFrame([(d, f"t{n}", s, "{}") for n, (d, s) in enumerate(scores)],
                                 "check_dimension string, table_name string, score double, details string")


def test_composite_and_history(spark):
    rows = checks(spark, [("completeness", 100.0), ("completeness", 50.0), ("uniqueness", 100.0), ("validity", 80.0), ("timeliness", 0.0)])
    row = quality.composite(rows).first()
    assert (row.composite_score, row.passed) == (73.75, False)  # 75*.25 + 100*.2 + 80*.25 + 0 + 100*.15
    history = quality.history_rows(rows, "r1", F.lit("2026-01-01").cast("timestamp"))
    assert history.count() == 5 and {(r.composite_score, r.passed) for r in history.collect()} == {(73.75, False)}
    assert quality.latest_score(history).first().label == "Fail"
    alert = alerts.quality_breaches(history).first()
    assert alert.level == "WARNING" and json.loads(alert.details["dimension_scores"])["completeness"] == 75.0


def test_measures(spark):
    kinds = ["INVITE_SENT"] * 4 + ["ACCEPTED"] * 3 + ["REPLY_RECEIVED"] * 2 + ["MEETING_BOOKED"] + ["ODD"]
    fact = spark.createDataFrame([(k, n % 2) for n, k in enumerate(kinds)], "event_type string, g int")
    row = measures.measure(fact, ["Total Invites Sent", "Acceptance Rate", "Reply Rate", "Conversion Rate", "Campaign ROI Score"]).first()
    assert row[:4] == (4, 0.75, 2 / 3, 0.25) and row.campaign_roi_score == pytest.approx((0.75 * 0.3 + 2 / 3 * 0.3 + 0.25 * 0.4) * 100)
    assert {r.g: r.total_accepted for r in measures.measure(fact, ["Total Accepted"], ["g"]).collect()} == {0: 2, 1: 1}
    assert [(r.stage, r.n) for r in measures.funnel(fact).collect()] == [("Sent", 4), ("Accepted", 3), ("Replied", 2), ("Meeting Booked", 1)]
    assert measures.measure(fact.limit(0), ["Acceptance Rate"]).first()[0] == 0.0


def test_every_measure_has_a_query(spark):
    frame = spark.createDataFrame(
        [("INVITE_SENT", 5, "active", True, "a", 0.4, 90.0)],
        "event_type string, daily_invite_limit int, status string, is_current boolean, agent_id string, anomaly_score double, composite_score double")
    row = measures.measure(frame, list(measures.MEASURES)).first()
    assert len(row) == len(measures.MEASURES) and row.utilisation_pct == 0.2 and row.risk_level_label == "Low Risk"


def test_recommended_capacity_rounds(spark):
    rows = spark.createDataFrame([(10.0, 15), (45.0, 15), (80.0, 15), (None, 15)], "agent_risk_score double, daily_invite_limit int")
    assert [r.recommended_invites for r in measures.recommended_capacity(rows).collect()] == [15.0, 12.0, 8.0, 15.0]


def test_alert_rows(spark):
    runs = spark.createDataFrame([("r1", 12.34, "FAILED", "boom", datetime(2026, 1, 1)), ("r2", 1.0, "SUCCESS", None, datetime(2026, 1, 1))],
                                 "run_id string, duration_seconds double, status string, error_message string, end_time timestamp")
    risky = spark.createDataFrame([("a", 75.0, "Red", "why"), ("b", 40.0, "Amber", "why"), ("c", 0.0, "Green", "why")],
                                  "agent_id string, risk_score double, risk_level string, justification string")
    rows = alerts.all_alerts(alerts.failed_runs(runs), alerts.risky_agents(risky, ["Amber", "Red"])).collect()
    assert [r.level for r in rows] == ["CRITICAL", "CRITICAL", "WARNING"]
    assert rows[0].message == "Pipeline run `r1` failed after 12.3s.\n\nError: boom" and rows[1].details["risk_score"] == "75.0"
    assert alerts.risky_agents(risky).count() == 1


def test_a_table_without_rows_reads_no_dimension(spark, tmp_path):
    spark.range(5).withColumnRenamed("id", "agent_key").write.parquet(f"{tmp_path}/dim")
    dim = spark.read.parquet(f"{tmp_path}/dim")
    none = spark.createDataFrame([], "agent_key long")
    checks = quality.table_checks(none, "fact_daily_agent_activity", foreign=[("agent_key", dim, "agent_key")])
    assert not checks.inputFiles() and [(r.table_name, r.score) for r in checks.collect()] == [("fact_daily_agent_activity.agent_key", 100.0)]
    some = spark.createDataFrame([(1,), (9,)], "agent_key long")
    assert [r.score for r in quality.table_checks(some, "t", foreign=[("agent_key", dim, "agent_key")]).collect()] == [50.0]
