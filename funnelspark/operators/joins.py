"""Join and grouping helpers that keep their shape when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Upper bound on the heavy keys a lookup treats apart, hence on the rows it broadcasts, and what the sketch tracks
# to find them: any key with more than 1 / TRACKED of the rows is among them.
MAX_HEAVY_KEYS = 200
TRACKED = 2000
# Number of groups the map tasks' sketches are merged in.
SKETCH_GROUPS = 256


def keep_first(df: DataFrame, key: Column, order: list[str | Column], keyless: Column | None = None) -> DataFrame:
    """First row per key by ``order``; rows with a NULL key are all kept.

    Spark prunes to one row per key *before* the shuffle (partial ``WindowGroupLimit``), so a key that
    holds a third of the input sends one row per map task. NULL-key rows each get a key of their own
    (``keyless``, by default their position), so they spread over all partitions in the same pass
    instead of meeting in one.
    """
    alone = keyless if keyless is not None else F.to_json(F.struct(*order))
    group = F.coalesce(F.concat(F.lit("k"), key), F.concat(F.lit("-"), alone))
    rank = F.row_number().over(Window.partitionBy("_group").orderBy(*order))
    return (
        df.withColumn("_group", group).withColumn("_rank", rank).filter("_rank = 1").drop("_rank", "_group")
    )


def heavy_keys(df: DataFrame, key: str) -> DataFrame:
    """At most ``MAX_HEAVY_KEYS`` of the most frequent keys, from one sketch pass over the key column.

    A sketch has a fixed size. Map tasks' sketches merge in ``SKETCH_GROUPS`` groups, so no task receives them all, and
    each group hands on at most ``MAX_HEAVY_KEYS`` candidates.
    """
    part = (F.spark_partition_id() % SKETCH_GROUPS).alias("_part")
    top = F.expr(f"approx_top_k(`{key}`, {MAX_HEAVY_KEYS}, {TRACKED})")
    groups = df.filter(F.col(key).isNotNull()).select(key, part).groupBy("_part").agg(top.alias("t"))
    candidates = groups.select(F.inline("t")).groupBy(F.col("item").alias(key)).agg(F.sum("count").alias("_n"))
    return candidates.orderBy(F.desc("_n")).limit(MAX_HEAVY_KEYS).select(key)


def lookup(
    df: DataFrame,
    dim: DataFrame,
    on: str,
    value: str,
    large: bool = False,
    spread: Column | None = None,
    keys_of: DataFrame | None = None,
) -> DataFrame:
    """``df`` with ``value`` of the ``dim`` row whose unique ``on`` matches; NULL where none does.

    A small dimension needs nothing special: Catalyst broadcasts it when its size is under
    ``spark.sql.autoBroadcastJoinThreshold``. For a ``large`` one the rows are told apart:

    * heavy keys (at most ``MAX_HEAVY_KEYS``) meet a broadcast of just their own dimension rows, so the
      bulk of a skewed input is never shuffled;
    * all other keys go through the ordinary shuffled join;
    * rows with nothing left to look up (NULL or already served) get keys that match nothing, made from
      ``spread`` (by default the whole row), so they do not pile up in the NULL partition.

    Which keys the sketch calls heavy only moves rows between the two paths; the result is the same. The sketch reads
    the key column of ``keys_of`` (by default ``df``) first, so that should be a stored table.
    """
    slim = dim.select(F.col(on), F.col(value))
    if not large:
        return df.join(slim, on, "left")
    hot = slim.join(F.broadcast(heavy_keys(df if keys_of is None else keys_of, on)), on, "left_semi").select(
        F.col(on).alias("_hot_on"), F.col(value).alias("_hot"), F.lit(True).alias("_served")
    )
    # A digest, not a random number: a recomputed task sends each row where it went before.
    apart = F.concat(F.lit("\x00"), F.xxhash64(*([spread] if spread is not None else df.columns)).cast("string"))
    served = df.join(F.broadcast(hot), F.col(on) == F.col("_hot_on"), "left").withColumn(
        "_cold_on", F.when(F.col(on).isNull() | F.col("_served"), apart).otherwise(F.col(on))
    )
    cold = slim.select(F.col(on).alias("_dim_on"), F.col(value).alias("_cold"))
    joined = served.join(cold, F.col("_cold_on") == F.col("_dim_on"), "left")
    return joined.withColumn(value, F.coalesce("_hot", "_cold")).drop(
        "_hot_on", "_hot", "_served", "_cold_on", "_dim_on", "_cold"
    )
