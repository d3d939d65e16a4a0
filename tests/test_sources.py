import json
from datetime import datetime

from pyspark.sql import functions as F

from funnelspark.operators import clean, facts
from funnelspark.plans import landing
from funnelspark.plans.inputs import Inputs
from funnelspark.sources import files, imports


def test_entity_files_in_order(spark, tmp_path):
    (tmp_path / "agents_b.csv").write_text('name,id,status\n"Bee, B.",b,paused\n\nSecond,a,ghost\n', encoding="utf-8")
    (tmp_path / "agents_a.csv").write_text("\ufeffid,name,extra,email\na,First,x\n", encoding="utf-8")
    (tmp_path / "agents_1.json").write_text(json.dumps({"data": [{"id": "c", "name": "See", "account_age": "1 Month"}, {"id": "b", "name": "late"}]}))
    (tmp_path / "agents_2.json").write_text(json.dumps({"id": "d", "name": "Dee"}))
    (tmp_path / "agents_3.json").write_text(json.dumps([{"id": 5}, {"id": "c", "name": "late"}]))
    got = {r.agent_id: r for r in clean.clean_rows(clean.route(files.read_entity(spark, str(tmp_path), "agents"), "agents")).collect()}
    assert {k: r.display_name for k, r in got.items()} == {"a": "First", "b": "Bee, B.", "c": "See", "d": "Dee", "5": None}
    assert got["b"].status == "paused" and got["c"].tier_name == "1 Month" and got["a"].linkedin_email is None


def test_no_files(spark, tmp_path):
    assert files.read_entity(spark, str(tmp_path / "nowhere"), "leads").count() == 0


def test_json_numbers_are_epochs_and_texts_are_not(spark, tmp_path):
    path = tmp_path / "events.json"
    path.write_text(json.dumps([
        {"id": "a", "type": "sent", "timestamp": 1700000000.5, "response_time_minutes": 12.9}, {"id": "b", "type": "sent", "timestamp": "1700000000"},
        {"id": "c", "type": "sent", "created_at": "2026-01-01"},
    ]))
    routed = clean.route(files.read_json(spark, [str(path)], "events"), "events")
    got = {r.event_source_id: (r.event_timestamp, r._reject) for r in routed.collect()}
    assert got["a"][0] == datetime(2023, 11, 14, 22, 13, 20, 500000) and got["b"][1].rule == "bad_timestamp" and got["c"][0] == datetime(2026, 1, 1)


def test_json_documents_of_many_lines(spark, tmp_path):
    (tmp_path / "agents_1.json").write_text(json.dumps({"data": [{"id": "a", "name": "Ann"}, {"id": "b", "name": "two\nlines"}]}, indent=2))
    (tmp_path / "agents_2.json").write_text("\ufeff" + json.dumps([{"id": "c", "name": "Cy"}], indent="\t"), encoding="utf-8")
    rows = files.read_entity(spark, str(tmp_path), "agents").select("id", "name").collect()
    assert sorted(tuple(r) for r in rows) == [("a", "Ann"), ("b", "two\nlines"), ("c", "Cy")]


def test_pages(spark, tmp_path):
    pages = [{"cursor": None, "data": [{"id": "a"}, {"id": "b"}], "next_cursor": "c1"}, {"cursor": "c1", "data": [{"id": "c"}], "next_cursor": "c2"},
             {"cursor": "c3", "data": [{"id": "d"}], "next_cursor": "c4"}, {"cursor": "c4", "data": [], "next_cursor": "c5"}]
    for n, page in enumerate(pages):
        (tmp_path / f"page_{n}.json").write_text(json.dumps(page))
    assert sorted(r.id for r in files.read_pages(spark, str(tmp_path), "leads").collect()) == ["a", "b", "c", "d"]
    assert [r.cursor for r in files.missing_pages(spark, str(tmp_path)).collect()] == ["c2"]


def test_incremental_filter_reaches_the_scan(spark, tmp_path):
    spark.createDataFrame([(1, datetime(2026, 1, 1)), (2, datetime(2026, 2, 1))], "id int, updated_at timestamp").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    newer = files.newer_than(df, "updated_at", datetime(2026, 1, 15))
    assert [r.id for r in newer.collect()] == [2] and files.newer_than(df, "updated_at", None).count() == 2
    assert "GreaterThan(updated_at" in newer._jdf.queryExecution().executedPlan().toString()


def test_archive(spark, tmp_path):
    path = tmp_path / "Connections.csv"
    path.write_text('Notes:\n"Some text, quoted"\n\nFirst Name,Last Name,URL,Email Address,Company,Position,Connected On\n'
                    'Ann,Lee,https://x/in/ann,,"Firm, Inc.",Boss,15 Aug 2024\n,,,,,,\nBob,Ray,,,,,08/16/24\nAnn,Lee,https://x/in/ann,,Other,,2024-01-01\n')
    at = F.lit("2026-01-01").cast("timestamp")
    people = {r.full_name: r for r in facts.archive_connections(imports.connections(spark, [str(path)]), at).collect()}
    assert set(people) == {"Ann Lee", "Bob Ray"}
    assert (people["Ann Lee"].company, people["Ann Lee"].connected_at) == ("Firm, Inc.", datetime(2024, 8, 15))
    assert (people["Bob Ray"].linkedin_url, people["Bob Ray"].company, people["Bob Ray"].title) == (
        "https://linkedin.com/in/bob-ray", "Self-Employed", "Professional")


def test_archives_whole_or_split(spark, tmp_path, monkeypatch):
    names = {
        "a": "Notes:\r\nsee below\r\n\r\nFirst Name,Last Name,URL\r\nAda,L,u1\r\n\r\nBo,M,u2", "b": "\ufeffURL,First name\nu3,Cy\nFirst Name,no header\n", "c": "", "d": "\n", "e": "plain,cells\rx,y\r",
        "f": "First Name\n" + "".join(f"n{k}\n" for k in range(2000)),
    }
    for name, content in names.items():
        (tmp_path / f"{name}.csv").write_text(content, encoding="utf-8", newline="")
    paths = [str(tmp_path / f"{n}.csv") for n in names]

    def read():
        rows = imports.read_archive(spark, paths, imports.CONNECTION_MARKERS).orderBy("_pos").collect()
        return [(r._pos._file.rsplit("/", 1)[1], r._header, r._cells) for r in rows]

    every = {}
    for size in (1 << 20, 64, -1):
        monkeypatch.setattr(imports, "WHOLE_BYTES", size)
        every[size] = read()
    assert every[1 << 20] == every[64] == every[-1]
    small = [r for r in every[-1] if r[0] != "f.csv"]
    people = ["First Name", "Last Name", "URL"]
    assert small == [
        ("a.csv", people, ["Ada", "L", "u1"]), ("a.csv", people, ["Bo", "M", "u2"]), ("b.csv", ["URL", "First name"], ["u3", "Cy"]),
        ("b.csv", ["URL", "First name"], ["First Name", "no header"]), ("e.csv", ["plain", "cells"], ["x", "y"]),
    ]
    assert [r[2][0] for r in every[-1] if r[0] == "f.csv"] == [f"n{k}" for k in range(2000)]
    # The other size's files are not opened: a scan without files has no partitions.
    sized = spark.read.text(paths).filter(F.col("_metadata.file_size") > 1 << 20)
    assert sized.rdd.getNumPartitions() == 0


def test_many_csv_headers(spark, tmp_path):
    for k in range(300):
        columns = ["id", "name", "status"][:: 1 if k % 2 else -1]
        values = {"id": f"i{k}", "name": f"n{k}", "status": "active"}
        (tmp_path / f"agents_{k:03d}.csv").write_text(",".join(columns) + "\n" + ",".join(values[c] for c in columns) + "\n")
    rows = files.read_entity(spark, str(tmp_path), "agents").select("id", "name", "status").collect()
    assert sorted(tuple(r) for r in rows) == sorted((f"i{k}", f"n{k}", "active") for k in range(300))


def test_invitations(spark, tmp_path):
    path = tmp_path / "Invitations.csv"
    path.write_text("Export\nFrom,To,Sent At,Message,Direction\nMe,Ann,\"8/15/24\",hi,OUTGOING\nBob,Me,2024-08-15,,INCOMING\nMe,Cid,2024-08-16,,\n")
    rows = facts.invitation_events(imports.invitations(spark, [str(path)]), "me", "camp", F.lit("2026-01-01").cast("timestamp")).collect()
    assert sorted(r.date_key for r in rows) == [20240815, 20240816] and {r.event_type for r in rows} == {"INVITE_SENT"}


def test_crm_dialects(spark, tmp_path):
    (tmp_path / "a.csv").write_text(
        '\ufeffName,Job Title,Company,Industry,Location,SDR Status,LinkedIn URL,Added On,Invite Sent At,Connected At\n'
        'Ann Lee,Boss,"Firm, Inc.",Tech,Town,Connected,https://x/in/ann/,2024-01-01,2024-01-02 10:00,2024-01-02 12:30\n'
        "Bob Ray,,,,Town,Invite pending,,2024-01-05,,\nCid,,,,,captured,,,,\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("name,job_title,company,location,agent_name,status,linkedin_url,sent_at,accepted_at\nDee,,,,x,disconnected,,,\n")
    rows = imports.crm_export(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")])
    leads = {r.lead_id: r for r in rows.collect()}
    assert {k: (r.lead_status, r.segment) for k, r in leads.items()} == {
        "lead_ann": ("CONNECTED", "Tech"), "lead_bob_ray": ("INVITE_SENT", "Town"), "lead_cid": ("CAPTURED", "General"), "lead_dee": ("CONNECTED", "General")}
    got = {r.event_source_id: r for r in facts.crm_events(rows, "a", "c", F.lit("2026-01-01").cast("timestamp")).collect()}
    assert set(got) == {"evt_sent_lead_ann", "evt_acc_lead_ann", "evt_sent_lead_bob_ray", "evt_sent_lead_dee", "evt_acc_lead_dee"}
    assert got["evt_acc_lead_ann"].response_time_minutes == 150
    assert got["evt_sent_lead_bob_ray"].date_key == 20240105 and got["evt_sent_lead_dee"].date_key == 20260101


def test_live_landing_is_compressed_and_keeps_copies_together(spark, tmp_path):
    """A landing of many compressed files, so that no two tasks write and read it all; the copies of an id lie in one."""
    types = F.element_at(F.array(*[F.lit(t) for t in ("view", "click", "signup", "purchase", "error")]), (F.col("id") % 5 + 1).cast("int"))
    spark.range(400).select(
        F.col("id").alias("event_id"), types.alias("event_type"), F.lit(1.5).alias("value"), F.lit('{"k": 3}').alias("props"),
        (F.col("id") * 7 % 300).alias("user_id"), F.lit("2024-01-15 08:30:00").cast("timestamp").alias("ts"),
    ).coalesce(1).write.parquet(f"{tmp_path}/events.parquet")
    landed = spark.read.json(landing.live_events(Inputs(spark, str(tmp_path)))).select("*", F.col("_metadata.file_name").alias("file"))
    rows = landed.collect()
    assert len(rows) == 480 and all(r.file.endswith(".json.gz") for r in rows) and len({r.file for r in rows}) > 2
    assert all(len({r.file for r in rows if r.id == i}) == 1 for i in {r.id for r in rows if r.agent_id == "agent_late"})
