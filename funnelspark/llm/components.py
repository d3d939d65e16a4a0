"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelspark.session import write_stage


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """``node`` and ``label`` (the smallest node it is linked to, itself included) of every node with a link.

    Each round hangs larger neighbours, then smaller ones, on the smallest node known; rounds are written to the shared
    folder and number about the logarithm of the longest chain. Links with a null end are none, an end linked to itself only has no
    row; no links, no rows.
    """
    edges = links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    edges = write_stage(edges, "links")
    state = _state(edges)
    while state[0]:
        both = edges.union(edges.select("v", "u")).toDF("u", "v")
        root = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        larger = both.where("v > u").join(root, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        root = larger.groupBy("u").agg(F.min("v").alias("m"))
        hung = larger.join(root, "u")
        edges = write_stage(hung.where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(hung.select("u", "m")).distinct(), "links")
        known, state = state, _state(edges)
        if known == state:
            break
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]
