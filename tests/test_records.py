"""Records as they came: undeclared fields, broken lines, and their replay."""

import json

import pytest
from pyspark.sql import functions as F

from funnelspark.operators import clean
from funnelspark.sources import files

AT = "2026-08-20"


def letters(spark, raw, name):
    return {r.source_id: r for r in clean.dead_letters(clean.route(raw, name), "r", F.lit(AT).cast("timestamp")).collect()}


def test_undeclared_fields_stay_in_the_payload(spark, tmp_path):
    (tmp_path / "events_1.csv").write_text("id,Comment Status,timestamp\ne1,open,never\n")
    line = '{"timestamp": 1700000000.50, "id": "e2", "extra": {"b": 1, "a": [1.0]}}'
    (tmp_path / "events_2.json").write_text(f'[{line}, {{"id": "e3"}}]')
    found = letters(spark, files.read_entity(spark, str(tmp_path), "events"), "events")
    assert json.loads(found["e1"].record_payload) == {"id": "e1", "Comment Status": "open", "timestamp": "never"}
    assert json.loads(found["e2"].record_payload) == json.loads(line) and found["e3"].record_payload == '{"id":"e3"}'
    landed = files.raw_landing(files.read_entity(spark, str(tmp_path), "events"), "events", "r", F.lit(AT).cast("timestamp")).collect()
    assert "Comment Status" in {r.source_id: r for r in landed}["e1"].raw_payload


def test_a_broken_line_is_a_dead_letter(spark, tmp_path):
    (tmp_path / "events.json").write_text('\n{"id": "e1", "type": "sent", "timestamp": "2026-01-01"}\n{"id": "e2", "type\n\n"text"\n[{"id": "e3", "type": "sent", "timestamp": 1700000000}]\n')
    routed = clean.route(files.read_entity(spark, str(tmp_path), "events", json_lines=True), "events")
    bad = [(r.error_type, r.record_payload) for r in clean.dead_letters(routed, "r", F.lit(AT).cast("timestamp")).collect()]
    assert sorted(bad) == [("bad_json", '"text"'), ("bad_json", '{"id": "e2", "type')]
    assert {r.event_source_id for r in clean.clean_rows(routed).collect()} == {"e1", "e3"}
    with pytest.raises(Exception):
        files.read_entity(spark, str(tmp_path), "events").collect()


def test_replayed_payloads_read_like_files(spark, tmp_path):
    (tmp_path / "events.json").write_text('{"id": "e1", "timestamp": 1700000000, "score": 3}')
    routed = clean.check_limits(clean.route(files.read_entity(spark, str(tmp_path), "events"), "events"), "fact_outreach_event")
    stored = clean.dead_letters(routed, "r", F.lit(AT).cast("timestamp"))
    mended = stored.withColumn("record_payload", F.regexp_replace("record_payload", '"score"', '"type": "sent", "score"'))
    rows, after = clean.replay(mended, "events", F.lit(AT).cast("timestamp"))
    assert [str(r.event_timestamp) for r in rows.collect()] == ["2023-11-14 22:13:20"] and [r.resolved for r in after.collect()] == [True]
