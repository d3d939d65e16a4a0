"""Dates and times (FN-1, FN-6, FN-11, FN-12, FN-16, FN-24, FN-27).

A shape test by regular expression picks one parser per row. Trying parsers in turn would cost an
exception per miss, which is what makes lenient date parsing slow on large inputs.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelspark.functions.text import blank_to_null, strip

_DAY = r"\d{4}-\d{1,2}-\d{1,2}"
_CLOCK = r"\d{1,2}:\d{1,2}:\d{1,2}"

# Accepted event time texts: ISO with zone (fraction allowed), ISO without zone, spaced, date only.
EVENT_TIME = rf"^{_DAY}(T{_CLOCK}((\.\d{{1,6}})?(Z|[+-]\d{{2}}:?\d{{2}}))?| {_CLOCK})?$"
CRM_TIME = rf"^{_DAY}( \d{{1,2}}:\d{{1,2}}(:\d{{1,2}})?)?$"


def parse_timestamp(text: Column) -> Column:
    """UTC timestamp or NULL; text without a zone is UTC."""
    return F.when(text.rlike(EVENT_TIME), text.try_cast("timestamp"))


def epoch_to_text(seconds: Column) -> Column:
    """ISO text of epoch seconds, so that numbers and texts share one parser afterwards."""
    at = F.timestamp_micros(F.round(seconds * 1_000_000).cast("bigint"))
    return F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def parse_crm_time(text: Column) -> Column:
    text = blank_to_null(strip(text))
    return F.when(text.rlike(CRM_TIME), text.try_cast("timestamp"))


def _full_year(text: Column, sep: str) -> Column:
    """Expand a trailing two-digit year: 69-99 belong to the 1900s, 00-68 to the 2000s."""
    year = F.right(text, F.lit(2))
    century = F.when(year >= "69", "19").otherwise("20")
    return F.concat(F.substring_index(text, sep, 2), F.lit(sep), century, year)


def parse_archive_time(text: Column) -> Column:
    """The eight date spellings of an account archive, as UTC."""
    text = blank_to_null(strip(text))
    title = F.initcap(text)
    return (
        F.when(text.rlike(r"^\d{1,2}\s+[A-Za-z]{3}\s+\d{4}$"),
               F.try_to_timestamp(F.regexp_replace(title, r"\s+", " "), F.lit("d MMM yyyy")))
        .when(text.rlike(r"^\d{1,2}-[A-Za-z]{3}-\d{2}$"),
              F.try_to_timestamp(_full_year(F.initcap(F.translate(text, "-", " ")), " "), F.lit("d MMM yyyy")))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(text, F.lit("M/d/yyyy")))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{2}$"), F.try_to_timestamp(_full_year(text, "/"), F.lit("M/d/yyyy")))
        .when(text.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AaPp][Mm]$"),
              F.try_to_timestamp(F.upper(text), F.lit("M/d/yyyy h:m:s a")))
        .when(text.rlike(rf"^{_DAY}( {_CLOCK}|T{_CLOCK}Z)?$"), text.try_cast("timestamp"))
    )


def date_key(ts: Column) -> Column:
    """YYYYMMDD as int."""
    return (F.year(ts) * 10000 + F.month(ts) * 100 + F.dayofmonth(ts)).cast("int")


def key_to_date(key: Column) -> Column:
    return F.make_date(F.floor(key / 10000), F.floor(key / 100) % 100, key % 100)


def response_minutes(sent: Column, accepted: Column) -> Column:
    """Whole minutes between the two, NULL when either is missing or they are out of order."""
    micros = F.unix_micros(accepted) - F.unix_micros(sent)
    return F.when(accepted >= sent, F.floor(micros / 60_000_000).cast("int"))


def days_since(last: Column, as_of: Column) -> Column:
    return F.datediff(as_of, last)


def calendar_parts(day: Column) -> dict[str, Column]:
    return {
        "date_key": date_key(day),
        "full_date": day,
        "year": F.year(day),
        "quarter": F.quarter(day),
        "month": F.month(day),
        "month_name": F.date_format(day, "MMMM"),
        "week_of_year": F.weekofyear(day),
        "day_of_week": F.weekday(day),
        "day_name": F.date_format(day, "EEEE"),
        "is_weekend": F.weekday(day) >= 5,
    }
