"""Incremental runs that lose nothing (SRC-6, SRC-7).

The watermark of an entity is the newest time any of its rows had, never the clock. A run reads

* what is newer than the watermark less an overlap; within the overlap, the sync ledger tells what was read before;
* late rows, older than that, whose key the target table does not know (a late state of a known key is superseded);
* rows without a readable time: each becomes a dead letter, once.

Of several states of a key the newest counts. The ledger holds the overlap only, so it does not grow with the source.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.functions import times
from funnelspark.operators import clean
from funnelspark.schemas import conform
from funnelspark.session import write_stage
from funnelspark.sources.warehouse import Warehouse

WHEN, NEWEST = "_when", "_newest"
OVERLAP = timedelta(days=1)
# Rule and message of a record that cannot be placed in time.
NO_TIME = ("missing_update_time", "Missing or unparseable update time")


class Increment:
    """One entity's incremental read. ``column`` holds the update time of its raw rows: a date, a timestamp or text."""

    def __init__(self, warehouse: Warehouse, name: str, table: str, column: str, overlap: timedelta = OVERLAP):
        self.warehouse, self.name, self.table, self.column = warehouse, name, table, column
        self.watermark = warehouse.watermark(name)
        self.overlap = overlap
        self.floor = None if self.watermark is None else self.watermark - overlap

    def _times(self, raw: DataFrame) -> tuple[Column, Column]:
        """The time of a row, and whether it is after the floor; on a typed column that reaches the scan."""
        stored = F.col(f"`{self.column}`")
        typed = dict(raw.dtypes)[self.column] in ("date", "timestamp", "timestamp_ntz")
        when = stored.cast("timestamp") if typed else times.parse_timestamp(stored.cast("string"))
        return when, (stored if typed else when) > F.lit(self.floor)

    def candidates(self, raw: DataFrame, order: list[str]) -> tuple[DataFrame, list[str]]:
        """Rows this run may have to take, with their time, and the order in which copies of a key win: newest first."""
        when, fresh = self._times(raw)
        timed = raw.withColumn(WHEN, when)
        rows = timed.filter(F.col(WHEN).isNotNull()) if self.floor is None else timed.filter(fresh)
        if self.floor is not None:
            late = timed.filter(F.col(WHEN) <= F.lit(self.floor))
            keys = self._unknown(late)
            whole = conform(late.select("*", F.struct("*").alias("_row")), self.name, ["_row"]).select("_row", self._key().alias("_key"))
            rows = rows.unionByName(whole.join(keys, F.col("_key").eqNullSafe(F.col("_unknown")), "left_semi").select("_row.*"))
        return rows.withColumn(NEWEST, -F.unix_micros(WHEN)), [NEWEST, WHEN, *order]

    def _key(self) -> Column:
        rules = clean.entity(self.name)
        return rules.columns[rules.key]

    def _unknown(self, late: DataFrame) -> DataFrame:
        """Keys of late rows that the target table does not have; only the key's own fields are read. Rows without a key are among them."""
        key = clean.entity(self.name).key
        found = conform(late, self.name).select(self._key().alias("_unknown"), F.lit(False).alias("_known"))
        known = self.warehouse.read(self.table).select(F.col(key).alias("_unknown"), F.lit(True).alias("_known")).filter("_unknown IS NOT NULL")
        # One grouping instead of a join: keys are combined by the map tasks and nothing is sorted.
        either = found.unionByName(known).groupBy("_unknown").agg(F.max("_known").alias("_known"))
        return write_stage(either.filter("NOT _known").select("_unknown"), f"{self.name}-late")

    def untimed(self, raw: DataFrame, order: list[str]) -> DataFrame:
        """Rows without a time, routed as rejects each by itself."""
        when, _ = self._times(raw)
        rows = raw.withColumn(WHEN, when).filter(F.col(WHEN).isNull()).withColumn(NEWEST, F.lit(None).cast("long"))
        rule, message = (F.lit(x) for x in NO_TIME)
        routed = clean.route(rows, self.name, [NEWEST, WHEN, *order], dedup=False)
        return routed.withColumn("_reject", F.coalesce("_reject", F.struct(rule.alias("rule"), message.alias("message"))))

    def unseen(self, routed: DataFrame) -> DataFrame:
        """Routed rows without those of the overlap that the ledger has, and without rejects that already are dead letters.

        ``routed`` is a stored stage. Rows that need no lookup, nearly all of a run that reads much, are left where they lie; only the others are staged anew.
        """
        when, key, bad = F.col(f"_o_{WHEN}"), F.col(clean.entity(self.name).key), F.col("_reject").isNotNull()
        old = F.lit(False) if self.watermark is None else F.coalesce(when <= F.lit(self.watermark), F.lit(False))
        ledger = self.ledger().select(F.col("record_key").alias("_seen"), F.col("synced_at").alias("_at"))
        again = routed.filter(~bad & old).join(ledger, (key == F.col("_seen")) & (when <= F.col("_at")), "left_anti")
        payload = clean.payload(routed.schema["_raw"].dataType.fieldNames())
        letters = self.warehouse.read("dead_letter_queue").select(F.col("record_payload").alias("_payload")).distinct()
        refused = routed.filter(bad & (old | when.isNull())).withColumn("_p", payload).join(letters, F.col("_p") == F.col("_payload"), "left_anti").drop("_p")
        return routed.filter(~old & (~bad | when.isNotNull())).unionByName(write_stage(again.unionByName(refused), f"{self.name}-looked-up"))

    def ledger(self) -> DataFrame:
        return self.warehouse.read("pipeline_synced").filter(F.col("entity_name") == self.name)

    def synced(self, stage: DataFrame) -> Column:
        """Write the ledger of the overlap before the new watermark, and return that watermark."""
        key, when = F.col(clean.entity(self.name).key), F.col(f"_o_{WHEN}")
        newest = stage.agg(F.max(when)).first()[0]
        after = newest if self.watermark is None else max(self.watermark, newest or self.watermark)
        if after is None:
            return F.lit(None).cast("timestamp")
        rows = stage.filter(F.col("_reject").isNull()).select(key.alias("record_key"), when.alias("synced_at")).unionByName(self.ledger().select("record_key", "synced_at"))
        kept = rows.filter(F.col("synced_at") > F.lit(after - self.overlap)).groupBy("record_key").agg(F.max("synced_at").alias("synced_at"))
        others = self.warehouse.read("pipeline_synced").filter(F.col("entity_name") != self.name)
        made = kept.select(F.lit(self.name).alias("entity_name"), "record_key", "synced_at").unionByName(others)
        self.warehouse.replace("pipeline_synced", write_stage(made, "synced"))
        return F.lit(after)
