from pyspark.sql import functions as F

from funnelspark.operators import clean
from funnelspark.operators.joins import heavy_keys, keep_first, lookup

FIELDS = "pos int, id string, agent_id string, event_type string, timestamp string, response_time_minutes string"
AT = "2026-08-20 00:00:00"


def routed(spark, rows, **options):
    return clean.route(spark.createDataFrame(rows, FIELDS), "events", ["pos"], **options)


def test_good_events(spark):
    rows = [
        (1, "evt_1", "agent_1", "INVITE_SENT", "2026-08-15T10:30:00Z", None),
        (2, "evt_2", "agent_1", "accepted", "2026-08-16T14:00:00Z", None),
        (3, "evt_3", "agent_1", "REPLY_RECEIVED", "2026-08-17T09:15:00Z", "120"),
    ]
    out = routed(spark, rows)
    good = clean.clean_rows(out).orderBy("event_source_id").collect()
    assert [r.event_type for r in good] == ["INVITE_SENT", "ACCEPTED", "REPLY_RECEIVED"]
    assert good[2].response_time_minutes == 120 and good[2].date_key == 20260817 and good[2].event_status == "SUCCESS"
    assert clean.reject_counts(out).first().status == "SUCCESS"


def test_bad_events_are_dead_lettered(spark):
    rows = [
        (1, None, "a", "INVITE_SENT", "2026-08-15T10:00:00Z", None), (2, "bad_1", "a", None, "2026-08-15T10:00:00Z", None),
        (3, "bad_2", "a", "INVITE_SENT", "not-a-date", None), (4, "bad_3", "a", "INVITE_SENT", "", None),
    ]
    out = routed(spark, rows)
    assert clean.clean_rows(out).count() == 0
    letters = clean.dead_letters(out, "run", F.lit(AT).cast("timestamp")).orderBy("error_type", "source_id").collect()
    assert [r.error_type for r in letters] == ["bad_timestamp", "bad_timestamp", "missing_event_id", "missing_event_type"]
    assert letters[2].source_id is None and '"event_type":"INVITE_SENT"' in letters[2].record_payload
    assert clean.reject_counts(out).first().status == "PARTIAL"


def test_first_copy_wins_before_validation(spark):
    rows = [(1, "e", "a", None, "2026-08-15", None), (2, "e", "a", "sent", "2026-08-15", None), (3, " e ", "a", "sent", "2026-08-16", None)]
    out = routed(spark, rows)
    assert out.count() == 1 and clean.clean_rows(out).count() == 0


def test_missing_ids_are_rejected_one_by_one(spark):
    out = routed(spark, [(n, "  " if n % 2 else None, "a", "sent", "2026-08-15", None) for n in range(7)])
    assert out.filter("_reject.rule = 'missing_event_id'").count() == 7


def test_unknown_type_and_missing_agent_are_kept(spark):
    row = clean.clean_rows(routed(spark, [(1, "e", None, "Profile-Viewed", "2026-08-15", "inf")])).first()
    assert (row.event_type, row.agent_id, row.response_time_minutes) == ("PROFILE-VIEWED", None, None)


def test_hot_key_is_cut_down_before_the_shuffle(spark):
    rows = spark.range(30_000, numPartitions=6).select(
        F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 3 == 1, F.col("id").cast("string")).alias("key")
    )
    kept = keep_first(rows, F.col("key"), ["pos"])
    assert kept.count() == 1 + 10_000 + 10_000  # the hot key once, distinct keys, every NULL
    assert kept.filter("key = 'hot'").first().pos == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and plan.count("Exchange hashpartitioning") == 1


def test_large_lookup_equals_plain_join(spark):
    facts = spark.range(20_000).select("id", F.when(F.col("id") % 3 == 0, "k0").when(F.col("id") % 7 == 0, None)
                                       .otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"))
    dim = spark.range(0, 400).select(F.concat(F.lit("k"), F.col("id")).alias("k"), (F.col("id") * 10).alias("v"))
    plain = {tuple(r) for r in lookup(facts, dim, "k", "v").select("id", "k", "v").collect()}
    split = lookup(facts, dim, "k", "v", large=True).select("id", "k", "v").collect()
    assert len(split) == 20_000 and {tuple(r) for r in split} == plain
    assert "k0" in {r.k for r in heavy_keys(facts, "k").collect()}


def test_large_lookup_of_nothing(spark):
    facts = spark.createDataFrame([], "id long, k string")
    dim = spark.createDataFrame([("a", 1)], "k string, v int")
    assert lookup(facts, dim, "k", "v", large=True).count() == 0
    nulls = spark.createDataFrame([(1, None)], "id long, k string")
    assert lookup(nulls, dim, "k", "v", large=True).select("id", "v").collect() == [(1, None)]
    assert lookup(nulls, dim.limit(0), "k", "v", large=True).count() == 1


def test_table_limits(spark):
    rows = spark.createDataFrame([("x" * 101, "n"), ("ok", "n")], "lead_id string, full_name string")
    full = rows.selectExpr("*", "cast(null as string) company", "cast(null as string) title", "cast(null as string) linkedin_url",
                           "cast(null as string) segment", "cast(null as string) lead_status")
    out = clean.check_limits(full, "dim_lead")
    assert [(r.lead_id, r._reject.rule) for r in out.filter("_reject is not null").collect()] == [("x" * 101, "too_long")]
    letters = clean.dead_letters(out, "run", F.current_timestamp(), source="loader").first()
    assert letters.source == "loader" and letters.error_message == "lead_id is longer than 100"


def test_replay(spark):
    at = F.lit(AT).cast("timestamp")
    letters = clean.dead_letters(routed(spark, [(1, "e1", "a", "sent", "bad", None), (2, "e2", "a", None, "2026-08-15", None)]), "r", at)
    mended = letters.withColumn("record_payload", F.regexp_replace("record_payload", '"bad"', '"2026-08-15"'))
    fixed, updated = clean.replay(mended, "events", at)
    assert [r.event_source_id for r in fixed.collect()] == ["e1"]
    assert {r.source_id: r.resolved for r in updated.collect()} == {"e1": True, "e2": False}
    again, _ = clean.replay(updated, "events", at)
    assert again.count() == 0


def test_replay_of_two_letters_of_one_key(spark):
    """A letter that is still broken hides no corrected one; of two corrected ones the first is loaded."""
    at = F.lit(AT).cast("timestamp")
    bad = clean.dead_letters(routed(spark, [(1, "e1", "a", "sent", "bad", None), (2, "e2", "a", "sent", "bad", None)]), "r", at)
    good = F.regexp_replace("record_payload", '"bad"', '"2026-08-15"')
    later = bad.withColumns({"record_payload": good, "created_at": F.lit("2026-08-21").cast("timestamp"), "run_id": F.lit("r2")})
    mended = bad.withColumn("record_payload", F.when(F.col("source_id") == "e2", good).otherwise(F.col("record_payload"))).unionByName(later)
    fixed, updated = clean.replay(mended, "events", at)
    assert sorted(r.event_source_id for r in fixed.collect()) == ["e1", "e2"]
    assert {(r.source_id, r.run_id, r.resolved) for r in updated.collect()} == {("e1", "r", False), ("e1", "r2", True), ("e2", "r", True), ("e2", "r2", True)}


def test_leads_without_id(spark):
    rows = [(1, None, "Ann", "Lee", None), (2, None, "Ann", "Lee", None), (3, None, None, None, None), (4, None, None, None, "https://x/in/a")]
    raw = spark.createDataFrame(rows, "pos int, id string, first_name string, last_name string, URL string")
    out = clean.route(raw, "leads", ["pos"])
    good = {r.full_name: r for r in clean.clean_rows(out).collect()}
    assert set(good) == {"Ann Lee", "Unknown Prospect"} and good["Ann Lee"].segment == "Target Prospects"
    assert out.filter("_reject.rule = 'missing_lead_id'").count() == 1
