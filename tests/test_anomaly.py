import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelspark.operators import anomaly, dims, risk


def series(spark, named):
    rows = [(k, n, float(v)) for k, values in named.items() for n, v in enumerate(values) if v is not None]
    return spark.createDataFrame(rows, "k string, date_key int, value double")


def latest(spark, named, **options):
    scored = anomaly.score_series(series(spark, named), ["k"], **options)
    return {r.k: r for r in scored.filter("is_latest").collect()}


CALM = [10 + 0.2 * (-1) ** n for n in range(14)]


def test_two_sided(spark):
    got = latest(spark, {
        "normal": [*CALM, 10.1], "spike": [*CALM, 35.0], "short": [1, 2, 3, 4, 5], "flat": [4.0] * 10,
        "flat then up": [4.0] * 10 + [5.0], "tenths": [0.1] * 14 + [0.1],
    })
    assert (got["normal"].anomaly_score, got["normal"].method_triggered) == (0, "none")
    assert (got["spike"].anomaly_score, got["spike"].method_triggered) == (2, "both")
    assert (got["short"].anomaly_score, got["short"].reason, got["short"].data_points) == (0, "insufficient_baseline_data", 5)
    assert got["flat"].anomaly_score == 0
    up = got["flat then up"]
    assert (up.z_score, up.iqr_flag, up.anomaly_score, up.method_triggered) == (0.0, 2, 2, "iqr")
    assert (got["tenths"].z_score, got["tenths"].anomaly_score) == (0.0, 0)


def test_drops_only(spark):
    rates = [0.35 + 0.01 * (-1) ** n for n in range(14)]
    got = latest(spark, {"drop": [*rates, 0.05], "rise": [*rates, 0.9], "gaps": [None, *rates, None, 0.05]}, drops_only=F.lit(True))
    assert got["drop"].anomaly_score == 2 and got["drop"].method_triggered == "z_score_one_sided"
    assert got["rise"].anomaly_score == 0 and got["gaps"].anomaly_score == 2
    assert got["drop"].iqr_lower == pytest.approx(np.percentile(rates, 25))


def expected(values, window, drop):
    current, base = values[-1], values[max(0, len(values) - 1 - window):-1]
    if len(values) < 6:
        return 0
    if len(base) < 5:
        base = values[:-1]
    mean, std = np.mean(base), np.std(base, ddof=1)
    std = 0 if std < 1e-12 else std
    z = 0 if std == 0 or (drop and current >= mean) else abs(current - mean) / std
    flag = 2 if round(z, 9) >= 3 else 1 if round(z, 9) >= 2 else 0
    if drop:
        return flag
    q1, q3 = np.percentile(base, 25), np.percentile(base, 75)
    for score, width in ((2, 3.0), (1, 1.5)):
        if round(current, 9) < round(q1 - width * (q3 - q1), 9) or round(current, 9) > round(q3 + width * (q3 - q1), 9):
            return max(flag, score)
    return flag


@pytest.mark.parametrize("window,drop", [(14, False), (14, True), (3, False)])
def test_every_day_agrees_with_numpy(spark, window, drop):
    rng = np.random.default_rng(7)
    named = {f"s{n}": np.round(rng.gamma(2.0, 2.0, 40), int(rng.integers(0, 4))).tolist() for n in range(12)}
    scored = anomaly.score_series(series(spark, named), ["k"], drops_only=F.lit(drop), baseline_window=window)
    got = {(r.k, r.date_key): r.anomaly_score for r in scored.collect()}
    want = {(k, n): expected(v[: n + 1], window, drop) for k, v in named.items() for n in range(len(v))}
    assert got == want and {0, 1} <= set(want.values())


def test_ghost_rate(spark):
    rows = spark.createDataFrame([(4, 1), (0, 3), (2, 5), (2, 0)], "a int, r int")
    assert [r[0] for r in rows.select(anomaly.ghost_rate(F.col("a"), F.col("r"))).collect()] == [0.75, 0.0, 0.0, 1.0]


def activity(spark, agents):
    """agents: key → list of (invites, accepted, replies, acceptance rate, reply rate, utilisation) per day."""
    rows = [(k, 20260101 + n, *day) for k, days in agents.items() for n, day in enumerate(days)]
    return spark.createDataFrame(
        rows, "agent_key bigint, date_key int, invites_sent bigint, invites_accepted bigint, replies_received bigint, "
              "acceptance_rate double, reply_rate double, utilisation_pct double")


def agents(spark, tiers):
    rows = [(k, f"agent_{k}", f"Agent {k}", t, True) for k, t in tiers.items()]
    return spark.createDataFrame(rows, "agent_key bigint, agent_id string, display_name string, tier_key int, is_current boolean")


def test_risk_levels_and_advice(spark):
    calm = [(10 + n % 2, 5, 3, 0.5 + 0.01 * (n % 2), 0.6 + 0.01 * (n % 2), 0.4 + 0.01 * (n % 2)) for n in range(14)]
    days = activity(spark, {
        1: [*calm, (10, 5, 3, 0.5, 0.6, 0.4)],
        2: [*calm, (90, 5, 0, 0.05, 0.6, 3.0)],
        3: [*calm, (90, 5, 0, 0.05, 0.01, 3.0)],
        4: calm[:5],
        5: [*calm, (10, 5, 3, 0.5, 0.6, 0.4)],
    })
    tiers = dims.account_tiers(spark)
    got = {r.agent_id: r for r in risk.score_agents(days, agents(spark, {1: 3, 2: 3, 3: 3, 4: 3, 5: None, 6: 3}), tiers).collect()}
    one, two, three = got["agent_1"], got["agent_2"], got["agent_3"]
    assert (one.risk_score, one.risk_level, one.recommended_daily_invites) == (0.0, "Green", 15)
    assert one.justification == "Low risk (0.0). Maintaining tier ceiling: 15 invites, 25 messages/day."
    # acceptance 30 + ghosting 20 + utilisation 15 + volume 10, then the reply rate on top
    assert (two.risk_score, two.risk_level) == (75.0, "Red") and (three.risk_score, three.risk_level) == (100.0, "Red")
    assert (three.recommended_daily_invites, three.recommended_daily_messages) == (7, 12)
    assert three.justification == (
        "HIGH RISK (100.0). Halving capacity: 7 invites, 12 messages/day. Critical triggers: acceptance_rate, reply_rate, "
        "ghosting_rate, utilisation, activity_volume. Immediate review recommended."
    )
    assert got["agent_4"].justification.startswith("Insufficient") and got["agent_6"].risk_level == "Green"
    assert got["agent_5"].recommended_daily_invites is None and got["agent_5"].justification.startswith("No tier")


def test_one_exchange_scores_all_agents(spark, tmp_path):
    activity(spark, {1: [(1, 1, 1, 0.5, 0.5, 0.5)] * 8}).write.parquet(str(tmp_path / "a"))
    plan = risk.agent_risk(risk.score_metrics(spark.read.parquet(str(tmp_path / "a"))))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_write_back(spark):
    days = activity(spark, {1: [(1, 1, 1, 0.5, 0.5, 0.5)] * 3, 2: [(1, 1, 1, 0.5, 0.5, 0.5)] * 2})
    risks = spark.createDataFrame([(1, 50.0)], "agent_key bigint, risk_score double")
    got = {(r.agent_key, r.date_key): r.anomaly_score for r in risk.write_back(days, risks).collect()}
    assert got == {(1, 20260101): None, (1, 20260102): None, (1, 20260103): 1.0, (2, 20260101): None, (2, 20260102): None}


def test_weights():
    assert sum(risk.METRIC_WEIGHTS.values()) == pytest.approx(1.0) and len(risk.METRIC_WEIGHTS) == 5


def test_duration(spark):
    runs = spark.createDataFrame([("p", f"r{n}", 10.0 + n % 2) for n in range(20)] + [("p", "slow", 60.0), ("q", "only", 5.0)],
                                 "pipeline string, run_id string, duration_seconds double")
    slow = anomaly.duration_anomalies(runs, anomaly.duration_baseline(runs, ["pipeline"]), ["pipeline"])
    assert [r.run_id for r in slow.collect()] == ["slow"]
