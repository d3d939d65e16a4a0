"""Warehouse tables on plain parquet (SRC-7, SRC-13..SRC-16).

A table is a folder of versions. Readers take the newest version that carries Spark's own ``_SUCCESS``; a write that crashed has none.

* ``replace`` writes a whole new version (dimensions, small tables);
* ``append`` adds the rows of a run to a log, a folder per run;
* ``upsert_*``, ``merge_leads``, ``put_scores`` add files for new rows and rewrite, by dynamic partition overwrite, only the partitions whose
  rows change: event fact by id bucket and month, marts by month, leads by id bucket.

Changed partitions are staged in the shared scratch folder first and named in ``pending``, so an overwrite that dies between two partitions is done
again by the next ``recover`` (every run begins with one). A table has one writer at a time; readers of a partition that is being rewritten
repeat their query. Where a table format with MERGE is at hand, the upserts become one MERGE; the results are the same.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from funnelspark.operators import dims, facts
from funnelspark.schemas import TABLES, shape, table_schema
from funnelspark.session import COMPRESSION, new_scratch, write_stage
from funnelspark.sources.files import _fs, list_files

LOGS = {"dead_letter_queue", "dq_results", "stg_raw_events", "live_receipts", "fact_pipeline_run", "alerts"}
#: Folders that split a table; those that are no columns of its rows come with their types.
FOLDERS = {
    "fact_outreach_event": "bucket int, month int",
    "fact_daily_agent_activity": "month int",
    "fact_campaign_performance": "month int",
    "dim_lead": "bucket int",
}
KEYS = {"fact_outreach_event": "event_source_id", "dim_lead": "lead_id"}
#: Id buckets of a new warehouse. The number is part of a version's name; ``rebucket`` changes it.
BUCKETS = 2048
#: Up to this many ids of a batch go to the scan as literals, where row-group statistics and bloom filters skip what cannot hold them.
LITERALS = 1000


class ConcurrentWrite(RuntimeError):
    """Another writer has made a version since the table was read."""


def id_bucket(buckets: int, key: str = "event_source_id") -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def month_of(date_key: str = "date_key") -> Column:
    return F.floor(F.col(date_key) / 100).cast("int")


def _folders(table: str) -> list[str]:
    if table in FOLDERS:
        return [c.split()[0] for c in FOLDERS[table].split(", ")]
    return ["run_id"] if table in LOGS else []


class Warehouse:
    """Tables under one root folder. ``buckets`` is how tables made from now on are split by id; existing ones keep their own number."""

    def __init__(self, spark: SparkSession, root: str, buckets: int = BUCKETS):
        self.spark, self.root, self.buckets = spark, root.rstrip("/"), buckets
        # Newest version of a table this object has read or written: what a replacement is based on.
        self._seen: dict[str, str | None] = {}

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _version(self, table: str) -> str | None:
        """Folder of the current version, named by number and id buckets (``v00000002-b2048``)."""
        done = list_files(self.spark, self.path(table), "v*/_SUCCESS")
        return done[-1].rsplit("/", 1)[0] if done else None

    def _next(self, table: str, buckets: int) -> str:
        fs, pattern = _fs(self.spark, f"{self.path(table)}/v*")
        taken = [int(s.getPath().getName()[1:9]) for s in fs.globStatus(pattern) or []]
        return f"{self.path(table)}/v{max(taken, default=0) + 1:08d}-b{buckets}"

    def written(self, table: str) -> bool:
        return self._version(table) is not None

    def buckets_of(self, table: str) -> int:
        version = self._version(table)
        return int(version.rsplit("-b", 1)[1]) if version else self.buckets

    # ── Reading ──

    def read(self, table: str, schema: str | None = None) -> DataFrame:
        """Current rows of a table, none before its first write."""
        self._seen[table] = self._version(table)
        rows = self._rows(table, schema)
        return rows.drop("bucket") if table.startswith("dim_") else rows

    def _rows(self, table: str, schema: str | None = None) -> DataFrame:
        version = self._version(table)
        whole = ", ".join(filter(None, [schema or TABLES[table], FOLDERS.get(table)]))
        if version is None:
            return self.spark.createDataFrame([], whole).limit(0)
        names = self.spark.createDataFrame([], whole).columns
        return self.spark.read.schema(whole).parquet(version).select(*names)

    # ── Writing ──

    def _writer(self, df: DataFrame, table: str):
        """Large parts are split over tasks, small ones share a task and a file; rows lie in order of their key."""
        folders, key = _folders(table), KEYS.get(table)
        if table in FOLDERS:
            within = [*folders, *[c for c in (key, "agent_key", "campaign_key") if c in df.columns][:1]]
            df = df.hint("rebalance", *folders).sortWithinPartitions(*within)
        writer = df.write.partitionBy(*folders).option("compression", COMPRESSION)
        if key:
            writer = writer.option(f"parquet.bloom.filter.enabled#{key}", "true").option("parquet.bloom.filter.adaptive.enabled", "true")
        return writer

    def _add(self, df: DataFrame, table: str) -> None:
        """Rows in new files of the current version, or as the first version."""
        version = self._version(table)
        self._writer(df, table).mode("append").parquet(version or self._next(table, self.buckets))

    def _overwrite(self, df: DataFrame, table: str) -> DataFrame:
        """Rows in place of all that their partitions hold; returns them, staged."""
        staged = new_scratch(self.spark, f"{table}-parts")
        df.write.option("compression", COMPRESSION).parquet(staged)
        named = self.spark.range(1).select(F.concat_ws("\n", F.lit(staged), F.lit(self._version(table))).alias("value"))
        named.coalesce(1).write.mode("overwrite").text(f"{self.path(table)}/pending")
        self._place(table)
        return self.spark.read.parquet(staged)

    def _place(self, table: str) -> None:
        """Put staged partitions in place, without the actions a merge noted. Doing so again gives the same."""
        pending = f"{self.path(table)}/pending"
        staged, version = self.spark.read.text(pending, wholetext=True).head()[0].splitlines()
        rows = self.spark.read.parquet(staged).drop("_action")
        self._writer(rows, table).mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(version)
        fs, path = _fs(self.spark, pending)
        fs.delete(path, True)

    def recover(self) -> Warehouse:
        """Finish overwrites that a crash has cut. Every run that writes begins with this."""
        for done in list_files(self.spark, self.root, "*/pending/_SUCCESS"):
            self._place(done.rsplit("/", 3)[1])
        return self

    def replace(self, table: str, df: DataFrame, buckets: int | None = None) -> DataFrame:
        """Write a whole new version of a table and return it. Refused if the table has a newer version than this object read."""
        version = self._version(table)
        if self._seen.get(table, version) != version:
            raise ConcurrentWrite(f"{table}: changed since it was read")
        rows, buckets = shape(df, table), buckets or self.buckets_of(table)
        if table in KEYS:
            rows = rows.withColumn("bucket", id_bucket(buckets, KEYS[table]))
        if "month" in _folders(table):
            rows = rows.withColumn("month", month_of())
        self._writer(rows, table).parquet(self._next(table, buckets))
        return self.read(table)

    def rebucket(self, table: str, buckets: int) -> None:
        """Write a table anew under another number of id buckets."""
        self.replace(table, self.read(table), buckets)

    def compact(self, table: str, files: int = 16) -> None:
        """Rewrite the partitions that hold more than ``files`` files, after many small loads."""
        folders = _folders(table)
        rows = self._rows(table)
        counted = self.spark.read.schema(rows.schema).parquet(self._version(table)).groupBy(*folders).agg(F.countDistinct("_metadata.file_path").alias("_n"))
        crowded = write_stage(counted.filter(F.col("_n") > files).select(*folders), "crowded")
        if not crowded.isEmpty():
            self._overwrite(_in_parts(rows, crowded, folders), table)

    def expire(self, table: str, keep: int = 2) -> None:
        """Delete versions but the newest ``keep``, and what crashed writes left of older ones."""
        newest = [v.rsplit("/", 1)[0] for v in list_files(self.spark, self.path(table), "v*/_SUCCESS")][-keep:]
        fs, pattern = _fs(self.spark, f"{self.path(table)}/v*")
        for status in fs.globStatus(pattern) or []:
            if newest and status.getPath().toString() < newest[0]:
                fs.delete(status.getPath(), True)

    def append(self, table: str, df: DataFrame, run_ids: list[str]) -> None:
        """Add the rows of runs to a log, in place of those stored before under the same run ids."""
        version, escape = self._version(table), self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
        places = {run: _fs(self.spark, f"{version}/run_id={escape(run)}") for run in run_ids} if version else {}
        stored = {run: place for run, place in places.items() if place[0].exists(place[1])}
        if not stored:
            return self._add(df, table)
        # As many as the runs named.
        fresh = {r[0] for r in self._overwrite(df, table).select("run_id").distinct().collect()}
        for run in stored.keys() - fresh:
            stored[run][0].delete(stored[run][1], True)

    def merge_leads(self, incoming: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """Apply ``merge`` (stored rows → new rows) to the id buckets that ``incoming`` touches and return its rows; other buckets keep their files."""
        table = "dim_lead"
        bucket = id_bucket(self.buckets_of(table), "lead_id")
        # At most ``buckets`` integers.
        touched = [r[0] for r in incoming.select(bucket.alias("bucket")).distinct().collect()]
        merged = merge(self._rows(table).filter(F.col("bucket").isin(touched)).drop("bucket"))
        if not touched:
            return merged
        # The merged rows are staged once: what is put in place is also what their actions are counted from.
        placed = merged.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in table_schema(table).fields], bucket.alias("bucket"), "_action")
        if self.written(table):
            return self._overwrite(placed, table).drop("bucket")
        staged = write_stage(placed, "leads-merged")
        self._add(staged.drop("_action"), table)
        return staged.drop("bucket")

    def _merge(self, table: str, rows: DataFrame) -> None:
        self._overwrite(rows, table) if self.written(table) else self._add(rows, table)

    def upsert_events(self, incoming: DataFrame) -> dict[str, int]:
        """Idempotent load of resolved events (fact shape, one row per id). Returns rows per action. ``incoming`` is read once by the first load, several times by later ones: hand those a stored stage.

        The fact lies by id bucket and by the month of the *first* load's date. Only buckets that occur in the batch are scanned, for id, status and
        response time, once; the ids of a small batch reach the scan and skip row groups. Partitions that hold a row with a new status or response
        time are rewritten with the batch's new rows of theirs; all other new rows are added. A load that crashed in between is completed by repeating it.
        """
        table, key, columns = "fact_outreach_event", "event_source_id", facts.EVENT_UPDATES
        rows = shape(incoming, table).withColumns({"bucket": id_bucket(self.buckets_of(table)), "month": month_of()})
        if not self.written(table):
            self._add(rows, table)
            return {"insert": self._rows(table).count(), "update": 0, "skip": 0}
        known = write_stage(self._stored_of(rows).select(
            "bucket", key, F.lit(True).alias("_known"), F.col("month").alias("_month"), *[F.col(c).alias(f"_old_{c}") for c in columns]
        ), "known-events")
        differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in columns])
        action = F.when(F.col("_known").isNull(), "insert").when(differs, "update").otherwise("skip")
        judged = write_stage(rows.join(known, ["bucket", key], "left").select(*rows.columns, "_month", action.alias("action")), "judged-events")
        counts = {"insert": 0, "update": 0, "skip": 0} | {r["action"]: r["count"] for r in judged.groupBy("action").count().collect()}
        new = judged.filter("action = 'insert'").select(*rows.columns)
        if counts["update"]:
            renewed = judged.filter("action = 'update'")
            parts = renewed.select("bucket", F.col("_month").alias("month")).distinct()
            given = renewed.select("bucket", key, F.lit(True).alias("_given"), *[F.col(c).alias(f"_new_{c}") for c in columns])
            values = {c: F.when(F.col("_given"), F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}
            # At most ``buckets`` integers, and one per calendar month: they prune the folders, the join is exact.
            buckets, months = (list({r[0] for r in parts.select(c).distinct().collect()}) for c in ("bucket", "month"))
            near = self._rows(table).filter(F.col("bucket").isin(buckets) & (F.col("month").isin([m for m in months if m is not None]) | F.col("month").isNull()))
            changed = _in_parts(near, parts, ["bucket", "month"]).join(given, ["bucket", key], "left").withColumns(values)
            self._overwrite(changed.select(*rows.columns).unionByName(_in_parts(new, parts, ["bucket", "month"])), table)
            new = _in_parts(new, parts, ["bucket", "month"], "left_anti")
        if counts["insert"]:
            self._add(new, table)
        return counts

    def _stored_of(self, rows: DataFrame) -> DataFrame:
        """Stored events with an id of ``rows``."""
        key = "event_source_id"
        # At most ``buckets`` integers.
        touched = [r[0] for r in rows.select("bucket").distinct().collect()]
        stored = self._rows("fact_outreach_event").filter(F.col("bucket").isin(touched))
        few = [r[0] for r in rows.select(key).limit(LITERALS + 1).collect()]
        if len(few) <= LITERALS:
            stored = stored.filter(F.col(key).isin(few))
        return stored.join(rows.select("bucket", key), ["bucket", key], "left_semi")

    def upsert_mart(self, table: str, fresh: DataFrame, by: list[str]) -> None:
        """Merge recomputed groups into a daily mart, rewriting only the months they lie in."""
        fresh = shape(fresh, table).withColumn("month", month_of())
        # One integer per calendar month.
        months = [r[0] for r in fresh.select("month").distinct().collect()]
        if months:
            old = self._rows(table).filter(F.col("month").isin(months))
            measures = [c for c in table_schema(table).names if c not in by and c != "anomaly_score"]
            self._merge(table, dims.upsert(old, fresh, [*by, "month"], measures).select(*old.columns))

    def put_scores(self, scored: DataFrame) -> None:
        """Write risk scores onto their activity rows; only the months that hold such rows are rewritten."""
        table, by = "fact_daily_agent_activity", ["agent_key", "date_key"]
        scores = scored.select(*by, F.col("anomaly_score").alias("_score"), month_of().alias("month"))
        months = [r[0] for r in scores.select("month").distinct().collect()]
        if months:
            old = self._rows(table).filter(F.col("month").isin(months))
            updated = old.join(scores, [*by, "month"], "left").withColumn("anomaly_score", F.coalesce("_score", "anomaly_score"))
            self._merge(table, updated.select(*old.columns))

    # ── Watermarks ──

    def watermark(self, entity: str):
        row = self.read("pipeline_watermarks").filter(F.col("entity_name") == entity).select("last_synced_at").head()
        return row[0] if row else None

    def set_watermarks(self, times: dict[str, Column], at: Column) -> None:
        """Watermarks by entity; one row each."""
        if not times:
            return
        named = F.explode(F.array(*[F.struct(F.lit(e).alias("entity_name"), t.cast("timestamp").alias("last_synced_at")) for e, t in times.items()]))
        rows = self.spark.range(1).select(named.alias("w")).select("w.*", at.alias("updated_at"))
        merged = dims.upsert(self.read("pipeline_watermarks"), rows, "entity_name", ["last_synced_at", "updated_at"])
        self.replace("pipeline_watermarks", merged)


def _in_parts(rows: DataFrame, parts: DataFrame, folders: list[str], how: str = "left_semi") -> DataFrame:
    """Rows that lie in one of the given partitions (``left_anti``: in none). Folder columns may be null."""
    named = parts.select(*[F.col(c).alias(f"_part_{c}") for c in folders])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_part_{c}")) for c in folders])
    return rows.join(named, same, how)
