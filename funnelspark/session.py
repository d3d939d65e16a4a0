"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. Sizes are left to the cluster's own configuration.
RUNTIME = {
    # Zone-less source text is UTC, so calendar arithmetic must be UTC as well.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a hot join partition even when the operator above would have liked its distribution.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Codec of stages and tables: about two thirds of the bytes of Spark's default, at the same speed.
COMPRESSION = "zstd"


def build_session(app_name: str = "funnelspark", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else built."""
    for key, value in RUNTIME.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def scratch_root(spark: SparkSession) -> str:
    """Folder all executors share, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting (tests) gets a folder of its own: on a cluster a
    machine-local folder would be lost with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = os.path.join(tempfile.gettempdir(), f"funnelspark-{spark.sparkContext.applicationId}")
    spark.conf.set("spark.checkpoint.dir", own)
    return own


def new_scratch(spark: SparkSession, label: str) -> str:
    """A fresh sub-folder name; it is never reused, so no run reads another run's leftovers."""
    return f"{scratch_root(spark)}/funnelspark/{label}-{uuid.uuid4().hex}"


def write_stage(df, label: str):
    """Write ``df`` once to the shared folder and read it back.

    Used where several jobs consume the same expensive intermediate: the work is done once and the
    lineage ends at files that outlive any executor.
    """
    spark = df.sparkSession
    path = new_scratch(spark, label)
    df.write.option("compression", COMPRESSION).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
