"""Landed files derived from the test tables, so that the file readers have something of the tables' size to read.

Each function writes one landing into a fresh folder of the shared scratch space and returns its path. Rows are range-partitioned and
sorted by their position first, so the order of files and lines is the order of positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.plans import derived
from funnelspark.plans.inputs import Inputs
from funnelspark.session import new_scratch

RECORDS_PER_PAGE = 50
#: Files of a landing that a stream reads in two micro-batches, and the most records of a compressed file, which one task reads.
LIVE_FILES, RECORDS_PER_FILE = 32, 20_000


def _in_order(df: DataFrame, by: str = "pos") -> DataFrame:
    return df.repartitionByRange(by).sortWithinPartitions(by)


def _pages(df: DataFrame) -> DataFrame:
    """Records grouped into pages of a fixed size (``page``, ``records``)."""
    records = F.struct(*[c for c in df.columns if c != "pos"])
    page = F.floor(F.col("pos") / RECORDS_PER_PAGE)
    # At most RECORDS_PER_PAGE rows per group.
    grouped = df.groupBy(page.alias("page")).agg(F.array_sort(F.collect_list(F.struct("pos", records.alias("r")))).alias("x"))
    return grouped.select("page", F.transform("x", lambda e: e["r"]).alias("records"))


def entity_files(i: Inputs) -> str:
    """Leads as CSV (first snapshot) and as JSON envelopes (second snapshot)."""
    folder = new_scratch(i.spark, "entity-files")
    first = i.raw(derived.RAW_LEADS_1)
    _in_order(first).drop("pos").write.option("header", True).csv(f"{folder}/leads_1.csv")
    pages = _pages(i.raw(derived.RAW_LEADS_2))
    lines = pages.select("page", F.to_json(F.struct(F.col("records").alias("data"))).alias("value"))
    _in_order(lines, "page").select("value").write.text(f"{folder}/leads_2.json")
    return folder


def epoch_events(i: Inputs) -> str:
    """Events whose times are epoch seconds: as JSON numbers, and for views as JSON text."""
    path = f"{new_scratch(i.spark, 'epoch-events')}/events.json"
    seconds = F.unix_timestamp(F.col("ts").cast("timestamp")).cast("string")
    value = F.when(F.col("event_type") == "view", F.concat(F.lit('"'), seconds, F.lit('"'))).otherwise(seconds)
    line = F.concat(F.lit('{"id": '), F.col("event_id").cast("string"), F.lit(', "type": "sent", "timestamp": '), value, F.lit("}"))
    i.table("events").select(line.alias("value")).write.text(path)
    return path


def pages(i: Inputs) -> str:
    """Two chains of pages, customers and suppliers; the last page of each points to one that never landed."""
    path = new_scratch(i.spark, "pages")
    for prefix, sql in (("c", "SELECT c_custkey AS pos, cast(c_custkey AS string) AS id, c_name AS name, c_mktsegment AS segment FROM {customer}"),
                        ("s", "SELECT s_suppkey AS pos, concat('s', cast(s_suppkey AS string)) AS id, s_name AS name, 'Suppliers' AS segment FROM {supplier}")):
        chained = _pages(i.raw(sql)).select(
            F.when(F.col("page") > 0, F.concat(F.lit(prefix), F.col("page"))).alias("cursor"),
            F.col("records").alias("data"),
            F.concat(F.lit(prefix), F.col("page") + 1).alias("next_cursor"),
        )
        chained.write.mode("append").json(path)
    return path


def archive_connections(i: Inputs) -> str:
    """One archive per nation: two lines of preamble, a header in one of two column orders, a line per customer."""
    path = new_scratch(i.spark, "connections")
    day = F.expr("date_add(DATE'2024-01-01', cast(c_custkey % 300 AS int))")
    spelled = (
        F.when(F.col("c_custkey") % 4 == 0, F.date_format(day, "dd MMM yyyy"))
        .when(F.col("c_custkey") % 4 == 1, F.date_format(day, "dd-MMM-yy"))
        .when(F.col("c_custkey") % 4 == 2, F.date_format(day, "MM/dd/yyyy"))
        .otherwise(F.date_format(day, "yyyy-MM-dd"))
    )
    first = F.when(F.col("c_acctbal") < 0, "").otherwise("Cust")
    last = F.when(F.col("c_acctbal") < -500, "").otherwise(F.col("c_name"))
    url = F.when(F.col("c_acctbal") > 5000, F.concat(F.lit("https://example.test/in/"), F.col("c_custkey"))).otherwise("")
    company = F.concat(F.lit('"'), F.col("c_mktsegment"), F.lit(', Inc."'))
    a = F.concat_ws(",", first, last, url, F.lit(""), company, F.lit(""), spelled)
    b = F.concat_ws(",", spelled, company, url, last, first, F.lit("Buyer"))
    body = i.table("customer").select(
        F.col("c_nationkey").alias("archive"), F.col("c_custkey") + 10,
        F.when(F.col("c_nationkey") < 12, a).otherwise(b).alias("value"),
    ).toDF("archive", "n", "value")
    head = F.when(F.col("n_nationkey") < 12, "First Name,Last Name,URL,Email Address,Company,Position,Connected On").otherwise(
        "Connected On,Company,URL,Last Name,First Name,Position")
    top = [F.lit("Notes:"), F.lit('"Some addresses may be missing, see the help page."'), F.lit(""), head]
    preamble = i.table("nation").select(F.col("n_nationkey").alias("archive"), _numbered(top))
    _archive(body.unionByName(preamble), path)
    return path


def archive_invitations(i: Inputs) -> str:
    """One archive per supplier nation, a line per supplier: sent, received and undirected invitations."""
    path = new_scratch(i.spark, "invitations")
    sent = F.expr("date_add(DATE'2024-03-01', cast(s_suppkey % 60 AS int))")
    direction = F.when(F.col("s_acctbal") < 2000, "INCOMING").when(F.col("s_acctbal") < 6000, "outgoing").otherwise("")
    when = F.when(F.col("s_suppkey") % 2 == 0, F.concat(F.date_format(sent, "M/d/yyyy"), F.lit(" 2:05:09 PM"))).otherwise(
        F.concat(F.date_format(sent, "yyyy-MM-dd"), F.lit(" 14:05:09")))
    line = F.concat_ws(",", F.lit("Me"), F.col("s_name"), when, F.lit('"Hello, there"'), direction)
    body = i.table("supplier").select(F.col("s_nationkey").alias("archive"), (F.col("s_suppkey") + 10).alias("n"), line.alias("value"))
    top = [F.lit("Export"), F.lit("From,To,Sent At,Message,Direction")]
    preamble = i.table("nation").select(F.col("n_nationkey").alias("archive"), _numbered(top))
    _archive(body.unionByName(preamble), path)
    return path


def _numbered(lines: list[Column]) -> Column:
    return F.inline(F.array(*[F.struct(F.lit(n).cast("bigint").alias("n"), c.alias("value")) for n, c in enumerate(lines)]))


def _archive(lines: DataFrame, path: str) -> None:
    lines.repartition("archive").sortWithinPartitions("archive", "n").select("archive", "value").write.partitionBy("archive").text(path)


def crm_exports(i: Inputs) -> str:
    """A Title Case export with a row per order (so a lead recurs) and a snake_case one with a row per supplier."""
    folder = new_scratch(i.spark, "crm")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    status = F.when(F.col("o_orderstatus") == "F", "Connected").when(F.col("o_orderstatus") == "O", "Invite Sent").otherwise("Enriched")
    orders = i.table("orders").join(i.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
    title_case = orders.select(
        F.col("o_orderkey").alias("pos"),
        F.col("c_name").alias("Name"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "Buyer").otherwise("").alias("Job Title"),
        F.when(F.col("o_totalprice") > 250000, F.concat(F.lit("Firm, "), F.col("c_mktsegment"))).otherwise("").alias("Company"),
        F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).otherwise("").alias("Industry"),
        F.concat(F.lit("Town "), F.col("c_nationkey")).alias("Location"),
        status.alias("SDR Status"),
        F.concat(F.lit("https://example.test/in/c"), F.col("c_custkey"), F.lit("/")).alias("LinkedIn URL"),
        day.alias("Added On"),
        F.when(F.col("o_orderstatus") != "P", F.concat(day, F.lit(" 09:30"))).otherwise("").alias("Invite Sent At"),
        F.when(F.col("o_orderstatus") == "F", F.concat(day, F.lit(" 18:45:30"))).otherwise("").alias("Connected At"),
    )
    suppliers = i.table("supplier").select(
        F.col("s_suppkey").alias("pos"), F.col("s_name").alias("name"), F.lit("Seller").alias("job_title"), F.lit("").alias("company"),
        F.lit("").alias("location"), F.when(F.col("s_acctbal") < 0, "disconnected").otherwise("").alias("status"),
        F.lit("").alias("linkedin_url"), F.lit("").alias("sent_at"), F.lit("").alias("accepted_at"),
    )
    for name, df in (("export_1.csv", title_case), ("export_2.csv", suppliers)):
        _in_order(df).drop("pos").write.option("header", True).csv(f"{folder}/{name}")
    return folder


def live_events(i: Inputs) -> str:
    """Raw events as compressed JSON lines; the copies of an id lie in one file, their order in ``pos``."""
    path = new_scratch(i.spark, "live-events")
    i.raw(derived.RAW_EVENTS).repartition(LIVE_FILES, "id").write.option("compression", "gzip").json(path)
    return path
