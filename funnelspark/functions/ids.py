"""Derived identifiers (DM-10, FN-8, FN-13, FN-17, ST-4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from funnelspark.functions.text import blank_to_null, first_filled, strip


def surrogate_key(*parts: Column) -> Column:
    """64-bit key computed where the row is; a serial would need all rows in one place."""
    return F.xxhash64(*parts)


def md5_id(prefix: str, text: Column, length: int = 10) -> Column:
    return F.concat(F.lit(prefix), F.substring(F.md5(text), 1, length))


def derived_lead_id(urls: list[Column], first: Column, last: Column) -> Column:
    """Stable id from the profile address, else from the name; NULL when there is neither."""
    first, last = F.coalesce(first, F.lit("")), F.coalesce(last, F.lit(""))
    named = F.when(F.concat(strip(first), strip(last)) != "", F.concat(first, F.lit("_"), last))
    identity = blank_to_null(strip(first_filled(*urls, named)))
    return md5_id("lead_", identity)


def crm_lead_id(url: Column, name: Column) -> Column:
    """Last path part of the profile address, else the name with every other character as ``_``."""
    slug = F.element_at(F.split(F.rtrim(url, F.lit("/")), "/"), -1)
    spelled = F.regexp_replace(F.lower(name), r"(?U)[^\p{Alnum}]", "_")
    return F.concat(F.lit("lead_"), F.when(url != "", slug).otherwise(spelled))
