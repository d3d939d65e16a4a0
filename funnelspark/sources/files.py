"""CSV, JSON and landed page files of the raw entities (SRC-1..SRC-6, SRC-12).

All values arrive as text under a declared schema. Every row carries its position (file kind, file, block,
row), so "the first copy wins" means the same on any number of executors.
"""

from __future__ import annotations

import csv
from concurrent.futures import ThreadPoolExecutor
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from funnelspark.functions import records, text
from funnelspark.schemas import CORRUPT, POSITION, RAW_FIELDS, RECORD, conform, raw_schema, shape

CSV_RANK, JSON_RANK = 0, 1
#: CSV files whose header line the driver reads at once; the wait is for the store, not for the driver.
OPENS = 32


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def list_files(spark: SparkSession, folder: str, pattern: str) -> list[str]:
    """Sorted files that match, a matching folder standing for the files in it; empty when there are none."""
    fs, path = _fs(spark, f"{folder}/{pattern}")
    out = []
    for status in fs.globStatus(path) or []:
        inside = fs.listStatus(status.getPath()) if status.isDirectory() else [status]
        out += [f.getPath() for f in inside if f is status or not f.getPath().getName().startswith(("_", "."))]
    return sorted(p.toString() for p in out)


def header_line(spark: SparkSession, path: str) -> str:
    """First line of a file. Column names are the one thing the driver reads itself."""
    fs, hadoop = _fs(spark, path)
    stream = fs.open(hadoop)
    try:
        jvm = spark._jvm.java.io
        line = jvm.BufferedReader(jvm.InputStreamReader(stream, "UTF-8")).readLine()
    finally:
        stream.close()
    return (line or "").removeprefix("\ufeff")


def _position(rank: int) -> list[Column]:
    return [
        F.lit(rank).alias("_src_rank"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_row"),
    ]


def read_csv(spark: SparkSession, paths: list[str], multi_line: bool = False, entity: str | None = None) -> DataFrame | None:
    """CSV files by header name. Files are grouped by equal headers, one scan per distinct header.

    Rows of files with columns that ``entity`` does not name bring their whole record along.
    ``multi_line`` allows line breaks inside quotes but makes a file unsplittable, so it is off by default.
    """
    with ThreadPoolExecutor(OPENS) as pool:
        headers = sorted(zip(pool.map(lambda p: header_line(spark, p), paths), paths, strict=True))
    out = None
    for header, group in groupby(headers, key=lambda pair: pair[0]):
        if not header:
            continue
        names = _distinct(next(csv.reader([header])))
        schema = StructType([StructField(name, StringType()) for name in names])
        reader = spark.read.schema(schema).option("header", True).option("escape", '"').option("multiLine", multi_line)
        rows = reader.csv([path for _, path in group]).select(
            *[F.col(f"`{n}`") for n in names if not n.startswith("_dup")], *_csv_record(names, entity), *_position(CSV_RANK)
        )
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def _csv_record(names: list[str], entity: str | None) -> list[Column]:
    own = [n for n in names if not n.startswith("_dup")]
    if entity is None or set(own) <= set(RAW_FIELDS[entity]):
        return []
    return [F.to_json(F.struct(*[F.col(f"`{n}`") for n in own])).alias(RECORD)]


def _distinct(names: list[str]) -> list[str]:
    """Give a repeated or blank header name a placeholder, which is then dropped."""
    seen: set[str] = set()
    out = []
    for i, name in enumerate(names):
        fresh = name and name.lower() not in seen
        out.append(name if fresh else f"_dup{i}")
        seen.add(name.lower())
    return out


def read_json(spark: SparkSession, paths: list[str], entity: str, lines: bool = False) -> DataFrame | None:
    """JSON files holding an array of records, a ``data`` envelope or a single record.

    ``lines`` reads one document per line, which is the splittable form for large landings: a broken line becomes a row of its own, to be
    dead-lettered. A broken document of the other form fails the read, since it stands for all its records.
    """
    if not paths:
        return None
    documents = spark.read.text(paths, wholetext=not lines).select(*_position(JSON_RANK), F.ltrim(F.col("value"), F.lit("\ufeff")).alias("value"))
    documents = documents.filter(F.trim("value") != "")
    if not lines:
        documents = documents.withColumn("value", records.whole(F.col("value")))
    rows = documents.select("*", F.posexplode(records.records_of(F.col("value"))).alias("_index", "_text"))
    parsed = rows.withColumn("_fields", records.parsed(F.col("_text"), records.json_fields(entity), strict=not lines))
    return parsed.select(
        *[records.field(name, F.col(f"_fields.`{name}`")) for name in RAW_FIELDS[entity]],
        records.undeclared(F.col("_text"), entity),
        *([F.col("_fields").getField(CORRUPT).alias(CORRUPT)] if lines else []),
        "_src_rank", "_file", "_block",
        # Records of one document keep their order behind the document's own place.
        F.concat(F.lpad(F.col("_row").cast("string"), 20, "0"), F.lit("-"), F.lpad(F.col("_index").cast("string"), 10, "0")).alias("_row"),
    )


def read_entity(
    spark: SparkSession, folder: str, entity: str, multi_line: bool = False, json_lines: bool = False
) -> DataFrame:
    """All files of an entity: ``<entity>*.csv`` first, then ``<entity>*.json``, each in name order."""
    parts = [
        read_csv(spark, list_files(spark, folder, f"{entity}*.csv"), multi_line, entity),
        read_json(spark, list_files(spark, folder, f"{entity}*.json"), entity, json_lines),
    ]
    found = [
        conform(p, entity, POSITION).withColumn("_row", F.lpad(F.col("_row").cast("string"), 20, "0")) for p in parts if p is not None
    ]
    if not found:
        empty = spark.range(0).select(*[F.lit(None).cast("string").alias(n) for n in RAW_FIELDS[entity]])
        return empty.select("*", F.lit(0).alias("_src_rank"), F.lit("").alias("_file"), F.lit(0).alias("_block"), F.lit("").alias("_row"))
    return found[0] if len(found) == 1 else found[0].unionByName(found[1], allowMissingColumns=True)


# ── Landed pages of a paged source ────────────────────────────────────────────


def page_schema(entity: str) -> StructType:
    return StructType([
        StructField("cursor", StringType()), StructField("data", ArrayType(raw_schema(entity))), StructField("next_cursor", StringType()),
    ])


def read_pages(spark: SparkSession, path: str, entity: str) -> DataFrame:
    """Records of landed pages (one JSON document per line: own cursor, data, next cursor)."""
    pages = spark.read.schema(page_schema(entity)).json(path)
    return pages.select(*_position(JSON_RANK), F.posexplode("data").alias("_index", "_record")).select(
        "_record.*", "_src_rank", "_file", "_block", F.struct("_row", "_index").alias("_row")
    )


def missing_pages(spark: SparkSession, path: str) -> DataFrame:
    """Cursors that a page points to but that never landed. Reads the two cursor fields only.

    An empty page ends a sequence, so what it points to is not missed.
    """
    schema = StructType([
        StructField("cursor", StringType()), StructField("data", ArrayType(StructType([]))), StructField("next_cursor", StringType()),
    ])
    pages = spark.read.schema(schema).json(path)
    landed = pages.select(F.col("cursor").alias("next_cursor")).filter("next_cursor IS NOT NULL")
    wanted = pages.filter((F.size("data") > 0) & (F.col("next_cursor") != "")).select("next_cursor").distinct()
    return wanted.join(landed, "next_cursor", "left_anti").withColumnRenamed("next_cursor", "cursor")


# ── Incremental reads and the raw landing table ───────────────────────────────


def newer_than(df: DataFrame, column: str, watermark) -> DataFrame:
    """Rows after the watermark; everything without one. The bare column comparison reaches the parquet scan."""
    return df if watermark is None else df.filter(F.col(column) > F.lit(watermark))


def place(raw: DataFrame, order: list[str]) -> Column:
    """The order columns of a row as one text that sorts as they do."""
    kinds = dict(raw.dtypes)
    whole = ("tinyint", "smallint", "int", "bigint")
    return F.concat_ws("\x01", *[F.lpad(F.col(c).cast("string"), 20, "0") if kinds[c] in whole else F.col(c).cast("string") for c in order])


def raw_landing(raw: DataFrame, entity: str, run_id: str, received_at: Column, source_type: str = "csv", order: list[str] = ()) -> DataFrame:
    """Records kept verbatim, in the shape of the raw landing table, with their place among the run's records if ``order`` is given."""
    names = [c for c in raw.columns if c in RAW_FIELDS[entity]]
    whole = [F.col(c) for c in (CORRUPT, RECORD) if c in raw.columns]
    return shape(
        raw.select(
            text.first_filled(*[F.col(f"`{n}`") for n in ("id", "event_id") if n in names]).alias("source_id"),
            F.lit(source_type).alias("source_type"),
            F.coalesce(*whole, F.to_json(F.struct(*[F.col(f"`{n}`").cast("string").alias(n) for n in names]))).alias("raw_payload"),
            received_at.alias("received_at"),
            F.lit(False).alias("processed"),
            F.lit(run_id).alias("run_id"),
            (place(raw, order) if order else F.lit(None).cast("string")).alias("position"),
            F.lit("received").alias("state"),
        ),
        "stg_raw_events",
    )


def landed_records(landed: DataFrame, entity: str) -> DataFrame:
    """Raw rows of landed records, with ``position``: what a run reads instead of the source."""
    payload = F.col("raw_payload")
    fields = records.parsed(payload, records.json_fields(entity))
    rows = landed.select("position", payload, fields.alias("_p"))
    return rows.select(
        *[records.field(n, F.col(f"_p.`{n}`")) for n in RAW_FIELDS[entity]], F.col("_p").getField(CORRUPT).alias(CORRUPT),
        F.when(F.col("_p").getField(CORRUPT).isNull(), records.undeclared(payload, entity)).alias(RECORD), "position",
    )
