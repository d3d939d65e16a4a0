from pyspark.sql import functions as F

from funnelspark.operators import dims


def at(day):
    return F.lit(f"2026-01-{day:02d} 00:00:00").cast("timestamp")


def leads(spark, rows):
    return spark.createDataFrame(
        [(i, "n", "c", "t", None, seg, st) for i, seg, st in rows],
        "lead_id string, full_name string, company string, title string, linkedin_url string, segment string, lead_status string",
    )


def load(spark, dim, rows, day):
    return dims.merge_leads(dim, leads(spark, rows), at(day))


def test_type_2_versions(spark):
    one = load(spark, dims.empty(spark, "dim_lead"), [("a", "s", "NEW"), ("b", None, "NEW"), ("c", "s", None)], 1)
    assert {r.action: r.n for r in dims.version_counts(one).collect()} == {"insert": 3}
    two = load(spark, one.drop("_action"), [("a", "s", "WON"), ("b", None, "NEW"), ("c", None, None), ("d", "s", "NEW")], 2)
    assert {r.action: r.n for r in dims.version_counts(two).collect()} == {"insert": 1, "update": 2, "skip": 1}
    rows = two.collect()
    assert len(rows) == 6 and len({r.lead_key for r in rows}) == 6
    current = [r.lead_id for r in rows if r.is_current]
    assert sorted(current) == ["a", "b", "c", "d"]
    closed = {r.lead_id: r for r in rows if not r.is_current}
    assert set(closed) == {"a", "c"} and all(r.valid_to.day == 2 and r.valid_from.day == 1 for r in closed.values())


def test_repeating_a_load_changes_nothing(spark):
    rows = [("a", "s", "NEW"), ("b", None, None)]
    one = load(spark, dims.empty(spark, "dim_lead"), rows, 1).drop("_action")
    again = load(spark, one, rows, 2)
    assert again.drop("_action").exceptAll(one).count() == 0 and {r._action for r in again.collect()} == {"skip"}


def test_validity_never_overlaps(spark):
    dim = dims.empty(spark, "dim_lead")
    for day, status in enumerate(["A", "B", "B", "C", "A"], start=1):
        dim = load(spark, dim, [("x", "s", status)], day).drop("_action")
    spans = sorted((r.valid_from.day, r.valid_to.day if r.valid_to else None, r.lead_status) for r in dim.collect())
    assert spans == [(1, 2, "A"), (2, 4, "B"), (4, 5, "C"), (5, None, "A")]
    assert [r.lead_status for r in dims.versions_at(dim, at(3)).collect()] == ["B"]


def test_agents_resolve_and_track_their_tier(spark):
    def agents(tier, status="active"):
        return spark.createDataFrame([("a", None, "n", status, tier)], "agent_id string, linkedin_email string, display_name string, status string, tier_name string")

    tiers = dims.account_tiers(spark)
    one = dims.merge_agents(dims.empty(spark, "dim_agent"), agents("1 Month"), tiers, at(1)).drop("_action")
    assert one.first().tier_key == 2
    two = dims.merge_agents(one, agents("1+ Year"), tiers, at(2))
    assert {(r.tier_key, r.is_current) for r in two.collect()} == {(2, False), (5, True)}
    assert dims.merge_agents(one, agents("unheard of"), tiers, at(2)).filter("is_current").first().tier_key is None


def test_upsert_takes_nulls_and_keeps_other_columns(spark):
    old = spark.createDataFrame([("a", "1", "x"), ("b", "2", "y")], "k string, u string, fixed string")
    new = spark.createDataFrame([("a", None, "z"), ("c", "3", "z")], "k string, u string, fixed string")
    got = {r.k: (r.u, r.fixed, r._action) for r in dims.upsert(old, new, "k", ["u"]).collect()}
    assert got == {"a": (None, "x", "update"), "b": ("2", "y", "keep"), "c": ("3", "z", "insert")}
    nothing = {r.k: (r.u, r._action) for r in dims.upsert(old, new, "k", []).collect()}
    assert nothing == {"a": ("1", "skip"), "b": ("2", "keep"), "c": ("3", "insert")}


def test_seed_and_calendar(spark):
    tiers = dims.seed_tiers(dims.empty(spark, "dim_account_tier"))
    assert {r._action for r in tiers.collect()} == {"insert"} and tiers.count() == 5
    days = dims.calendar(spark)
    assert days.count() == 1461 and days.agg(F.min("date_key"), F.max("date_key")).first()[:] == (20240101, 20271231)


def test_refresh_in_place(spark):
    dim = dims.empty(spark, "dim_lead").unionByName(
        load(spark, dims.empty(spark, "dim_lead"), [("lead_a", "s", "NEW")], 1).drop("_action").withColumn("company", F.lit("Confidential"))
    )
    rows = spark.createDataFrame(
        [(1, "lead_a", "Ann", "", "Seller", "u", "g", "INVITE_SENT"), (2, "lead_a", "Ann", "Firm", "x", "u", "g", "CONNECTED"),
         (3, "lead_b", "Bob", "", "", "v", "h", "CAPTURED")],
        "_pos int, lead_id string, full_name string, company string, title string, linkedin_url string, segment string, lead_status string",
    )
    got = {r.lead_id: r for r in dims.refresh_leads(dim, dims.crm_leads(rows), at(2)).collect()}
    a, b = got["lead_a"], got["lead_b"]
    assert (a.company, a.title, a.lead_status, a.segment, a.valid_from.day, a._action) == ("Firm", "t", "CONNECTED", "s", 1, "update")
    assert (b.company, b.title, b.lead_status, b._action) == ("Confidential", "Recruiter", "CAPTURED", "insert")


def test_ensure_row(spark):
    dim = dims.empty(spark, "dim_agent")
    one = dims.ensure_row(dim, "agent_id", {"agent_id": "me", "status": "active", "tier_key": 5}, "agent_key", at(1))
    assert one.count() == 1 and dims.ensure_row(one, "agent_id", {"agent_id": "me", "status": "active"}, "agent_key", at(2)).count() == 1
