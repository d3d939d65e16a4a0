"""Account archives and CRM exports (SRC-9..SRC-11, FN-13..FN-18)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.functions import ids, text, times
from funnelspark.sources.files import read_csv

# Words that give the header line of each archive file away.
CONNECTION_MARKERS = ["First Name", "First name", "URL"]
INVITATION_MARKERS = ["From", "To", "Sent At"]


#: Bytes of a file up to which it is read as one text. An account's archive is far below.
WHOLE_BYTES = 32 << 20


def read_archive(spark: SparkSession, paths: list[str] | str, markers: list[str]) -> DataFrame:
    """Lines below the header of each file, as arrays: ``_header``, ``_cells`` and ``_pos``.

    The header is the first line with a marker word, else the first line; each line meets its own file's header, so files may order
    their columns differently. A file of at most ``WHOLE_BYTES`` is one row: it is scanned once, its header is found within it, and nothing
    is shuffled or joined. Larger files stay splittable: their headers are found by one min() per file and joined. The sizes prune
    the files of each scan. Quoted line breaks are not supported.
    """
    marked = lambda line: reduce(lambda a, b: a | b, [line.contains(marker) for marker in markers], F.lit(False))
    return _small_archives(spark, paths, marked).union(_large_archives(spark, paths, marked))


def _header_cells(line: Column) -> Column:
    return text.csv_cells(F.regexp_replace(line, "^\\x{FEFF}", ""))


def _small_archives(spark: SparkSession, paths: list[str] | str, marked: Callable[[Column], Column]) -> DataFrame:
    size, file = F.col("_metadata.file_size"), F.col("_metadata.file_path").alias("_file")
    files = spark.read.text(paths, wholetext=True).filter(size <= WHOLE_BYTES).select(file, F.split("value", r"\r\n|\r|\n").alias("lines"))
    # Number of the header line, from 1.
    headed = files.withColumn("at", F.greatest(F.lit(1), F.array_position(F.transform("lines", marked), True))).withColumn("_header", _header_cells(F.get("lines", F.col("at").cast("int") - 1)))
    body = headed.select("_file", "at", "_header", F.posexplode("lines").alias("k", "value")).filter((F.col("k") >= F.col("at")) & (F.trim("value") != ""))
    at = F.struct(F.lit(0).cast("long").alias("block"), F.col("k").cast("long").alias("row"))
    return body.select("_header", text.csv_cells(F.col("value")).alias("_cells"), F.struct("_file", at.alias("_at")).alias("_pos"))


def _large_archives(spark: SparkSession, paths: list[str] | str, marked: Callable[[Column], Column]) -> DataFrame:
    lines = spark.read.text(paths).filter(F.col("_metadata.file_size") > WHOLE_BYTES).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row")).alias("_at"),
    )
    place = F.struct("_at", "value")
    firsts = lines.groupBy("_file").agg(F.coalesce(F.min(F.when(marked(F.col("value")), place)), F.min(place)).alias("h"))
    headers = firsts.select("_file", F.col("h._at").alias("_header_at"), _header_cells(F.col("h.value")).alias("_header"))
    # How the join runs is left to the optimizer, which knows the size of the headers once they are found.
    body = lines.join(headers, "_file").filter((F.col("_at") > F.col("_header_at")) & (F.trim("value") != ""))
    return body.select("_header", text.csv_cells(F.col("value")).alias("_cells"), F.struct("_file", "_at").alias("_pos"))


def _cell(*names: str) -> Column:
    """First filled cell under one of the header names; empty text when there is none."""
    cells = [F.get("_cells", F.array_position("_header", name).cast("int") - 1) for name in names]
    return F.coalesce(text.first_filled(*cells), F.lit(""))


def connections(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    rows = read_archive(spark, paths, CONNECTION_MARKERS)
    return rows.select(
        text.strip(_cell("First Name", "First name")).alias("first_name"),
        text.strip(_cell("Last Name", "Last name")).alias("last_name"),
        _cell("URL", "Profile URL").alias("url"),
        _cell("Email Address", "Email").alias("email"),
        _cell("Company", "Organization").alias("company"),
        _cell("Position", "Job Title").alias("title"),
        _cell("Connected On", "Connected on").alias("connected_on"),
        "_pos",
    )


def invitations(spark: SparkSession, paths: list[str] | str) -> DataFrame:
    rows = read_archive(spark, paths, INVITATION_MARKERS)
    return rows.select(
        _cell("From").alias("from"), _cell("To").alias("to"), _cell("Sent At", "sent_at").alias("sent_at"),
        _cell("Direction").alias("direction"), "_pos",
    )


# Clean column ← header names of the two CRM export dialects.
CRM_COLUMNS = {
    "full_name": ["Name", "name"],
    "title": ["Job Title", "job_title"],
    "company": ["Company", "company"],
    "location": ["Location", "location"],
    "industry": ["Industry", "industry"],
    "status_raw": ["SDR Status", "status"],
    "linkedin_url": ["LinkedIn URL", "linkedin_url"],
    "sent_text": ["Invite Sent At", "sent_at"],
    "connected_text": ["Connected At", "accepted_at"],
    "added_text": ["Added On"],
}


def crm_export(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Rows of CRM exports in either dialect, typed, with lead id, status and segment. Empty files have no rows."""
    raw = read_csv(spark, paths)
    if raw is None:
        raw = spark.createDataFrame([], "_src_rank int, _file string, _block long, _row long")
    have = set(raw.columns)
    defaults = {"full_name": "Unknown Lead", "status_raw": "captured"}

    def column(name: str) -> Column:
        present = [F.col(f"`{n}`") for n in CRM_COLUMNS[name] if n in have]
        value = text.first_filled(*present, F.lit(defaults.get(name, ""))) if present else F.lit(None)
        return text.strip(F.coalesce(value, F.lit(defaults.get(name, "")))).alias(name)

    rows = raw.select(*[column(name) for name in CRM_COLUMNS], F.struct("_src_rank", "_file", "_block", "_row").alias("_pos"))
    status = F.lower("status_raw")
    return rows.select(
        ids.crm_lead_id(F.col("linkedin_url"), F.col("full_name")).alias("lead_id"),
        "full_name", "title", "company", "linkedin_url",
        text.first_filled(F.col("industry"), F.col("location"), F.lit("General")).alias("segment"),
        status.alias("status_raw"),
        text.crm_lead_status(status).alias("lead_status"),
        times.parse_crm_time(F.col("sent_text")).alias("sent_at"),
        times.parse_crm_time(F.col("connected_text")).alias("connected_at"),
        times.parse_crm_time(F.col("added_text")).alias("added_on"),
        "_pos",
    )
