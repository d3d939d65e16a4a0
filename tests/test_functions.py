from datetime import datetime

import pytest
from pyspark.sql import functions as F

from funnelspark.functions import ids, numbers, text, times


def values(spark, inputs, fn, kind="string"):
    rows = spark.createDataFrame([(n, v) for n, v in enumerate(inputs)], f"n int, v {kind}")
    return [r[0] for r in rows.orderBy("n").select(fn(F.col("v"))).collect()]


def test_event_types(spark):
    got = values(spark, ["invite_sent", "accepted", "Connected", " Reply ", "meeting-booked", "Profile-Viewed", "WITHDRAWN", "", "  ", None],
                 text.event_type_of)
    assert got == ["INVITE_SENT", "ACCEPTED", "ACCEPTED", "REPLY_RECEIVED", "MEETING_BOOKED", "PROFILE-VIEWED", "WITHDRAWN", None, None, None]


def test_timestamps(spark):
    cases = {
        "2026-08-15T10:30:00Z": datetime(2026, 8, 15, 10, 30),
        "2026-08-15T10:30:00.250Z": datetime(2026, 8, 15, 10, 30, 0, 250000),
        "2026-08-15T10:30:00+05:30": datetime(2026, 8, 15, 5, 0),
        "2026-08-15T10:30:00.5+0530": datetime(2026, 8, 15, 5, 0, 0, 500000),
        "2026-08-15T10:30:00": datetime(2026, 8, 15, 10, 30),
        "2026-08-15 10:30:00": datetime(2026, 8, 15, 10, 30),
        "2026-8-5": datetime(2026, 8, 5),
        "2026-08-15T10:30:00.123": None,
        "2026-02-30": None,
        "not-a-date": None,
        "1700000000": None,
        "2026": None,
        "": None,
        None: None,
    }
    assert values(spark, cases, times.parse_timestamp) == list(cases.values())


def test_archive_times(spark):
    cases = {
        "15 Aug 2024": datetime(2024, 8, 15), "15-Aug-24": datetime(2024, 8, 15), "15-aug-99": datetime(1999, 8, 15),
        "2024-08-15": datetime(2024, 8, 15), "08/15/2024": datetime(2024, 8, 15), "8/5/24": datetime(2024, 8, 5),
        "2024-08-15 14:30:00": datetime(2024, 8, 15, 14, 30), "08/15/2024 02:30:00 PM": datetime(2024, 8, 15, 14, 30),
        " 2024-08-15T01:02:03Z ": datetime(2024, 8, 15, 1, 2, 3), "15/15/2024": None, "soon": None, "": None,
    }
    assert values(spark, cases, times.parse_archive_time) == list(cases.values())


def test_crm_times(spark):
    cases = {"2024-08-15 14:30:05": datetime(2024, 8, 15, 14, 30, 5), "2024-08-15 14:30": datetime(2024, 8, 15, 14, 30),
             "2024-08-15": datetime(2024, 8, 15), "15 Aug 2024": None, " ": None}
    assert values(spark, cases, times.parse_crm_time) == list(cases.values())


def test_numbers(spark):
    got = values(spark, ["12.9", "-3.7", " 7 ", "1_000", "1e3", "inf", "nan", "1d", "", "null", "99999999999", None], numbers.to_int)
    assert got == [12, -3, 7, 1000, 1000, None, None, None, None, None, None, None]


def test_rates(spark):
    row = spark.range(1).select(
        numbers.rate(F.lit(1), F.lit(3)), numbers.rate(F.lit(1), F.lit(0)), numbers.rate_or_zero(F.lit(1), F.lit(0)),
        numbers.rate(F.lit(2469), F.lit(20000)), numbers.percent(F.lit(1), F.lit(8)), numbers.percent(F.lit(1), F.lit(0)),
        numbers.clamp_score(F.lit(101.0)), numbers.share_score(F.lit(0), F.lit(0)),
    ).first()
    assert tuple(row) == (0.3333, None, 0.0, 0.1235, 12.5, 0.0, 100.0, 100.0)


def test_clean_text(spark):
    got = values(spark, ["  a b　\n", "null", " null ", "", "\t", None, "abcdef"], lambda c: text.clean_text(c, 4))
    assert got == ["a b", None, "null", None, None, None, "abcd"]


def test_derived_ids(spark):
    rows = spark.createDataFrame(
        [(" https://x/in/ann ", None, None), (None, "Ann", "Lee"), (None, "", " "), (None, "Ann", None)], "u string, f string, l string"
    )
    got = [r[0] for r in rows.select(ids.derived_lead_id([F.col("u")], F.col("f"), F.col("l"))).collect()]
    import hashlib

    def want(s):
        return "lead_" + hashlib.md5(s.encode()).hexdigest()[:10]

    assert got == [want("https://x/in/ann"), want("Ann_Lee"), None, want("Ann_")]


@pytest.mark.parametrize("url,name,want", [
    ("https://x/in/ann-lee/", "Ann", "lead_ann-lee"), ("", "Ann O'Lée 3", "lead_ann_o_lée_3"),
])
def test_crm_lead_id(spark, url, name, want):
    assert spark.range(1).select(ids.crm_lead_id(F.lit(url), F.lit(name))).first()[0] == want


def test_csv_cells(spark):
    lines = ["a,b,c", ",,", '"x, y",z,"say ""hi"""', "", 'a"b,"",c']
    assert values(spark, lines, text.csv_cells) == [["a", "b", "c"], ["", "", ""], ["x, y", "z", 'say "hi"'], [""], ['a"b', "", "c"]]


def test_calendar_parts(spark):
    row = spark.range(1).select(F.lit("2024-12-30").cast("date").alias("d")).select(
        *[c.alias(n) for n, c in times.calendar_parts(F.col("d")).items()]
    ).first()
    assert (row.date_key, row.quarter, row.week_of_year, row.day_of_week, row.day_name, row.month_name, row.is_weekend) == (
        20241230, 4, 1, 0, "Monday", "December", False
    )
