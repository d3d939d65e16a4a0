"""License scan by diagonal voting.

Every rolling pair of words of a document is joined to the places of that pair in the templates. A hit votes for the diagonal
(place in the document minus place in the template). Votes are summed per diagonal; neighbouring diagonals, as words put in or left out
make them, are merged; and a span is verified by how much of its template it covers. Native plan throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from funnelspark.llm.common import let
from funnelspark.session import write_stage

# Phrases whose places count whatever else is found, with their labels.
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

#: Templates of the method and their labels, unless the caller brings a table of them.
TEMPLATES = {
    "licensed under the apache license version 2 0": "apache",
    "released under the mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit",
    "licensed under the gnu general public license version 3": "gpl-3",
    "licensed under cc by nc 4 0": "cc-by-nc",
    "licensed under cc by sa 4 0": "cc-by-sa",
    "redistribution and use in source and binary forms with or without modification are permitted": "bsd",
    "this source code form is subject to the terms of the mozilla public license": "mpl",
}
#: Diagonals at most this far apart are one span; share of a template's pairs that a span must hold.
NEIGHBOURS, COVERED = 3, 0.75
#: Pairs of all templates that are broadcast at most: some 30 MB.
BROADCAST_PAIRS = 1 << 18

_NO_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_KELVIN = "K"  # the only character that is no ASCII letter but whose lower case is one


def words_of(text: Column) -> Column:
    """Words, letters in lower case. Only words with non-ASCII letters differ from lower-casing A-Z alone, and no template has any."""
    folded = F.lower(F.replace(F.coalesce(text, F.lit("")), F.lit(_KELVIN), F.lit("ĸ")))
    return F.filter(F.split(folded, _NO_WORD), lambda w: w != "")


def listed(spark: SparkSession, templates: dict[str, str]) -> DataFrame:
    """Texts and labels of a dictionary as the columns ``text`` and ``label``."""
    pairs = [F.struct(F.lit(text).alias("text"), F.lit(label).alias("label")) for text, label in templates.items()]
    rows = F.array(*pairs) if pairs else F.array().cast("array<struct<text:string,label:string>>")
    return spark.range(1).select(F.inline(rows))


def template_pairs(templates: DataFrame, exact: bool) -> DataFrame:
    """Every pair of neighbouring words of the templates, with its place: as bit ``place`` modulo 64 of the mask number ``block``.

    Templates without words or without a label have no pairs; one of a single word is refused.
    """
    words = templates.where("label IS NOT NULL").select("label", words_of(F.col("text")).alias("words")).distinct()
    checked = F.when(F.size("words") == 1, F.raise_error(F.lit("a template has two words or more"))).otherwise(F.col("words"))
    named = words.where(F.size("words") > 0).select("label", checked.alias("words")).withColumn("pairs", F.size("words") - 1)
    places = F.transform(F.slice("words", 1, F.col("pairs")), lambda w, k: F.struct(w.alias("first"), F.get("words", k + 1).alias("second")))
    return named.select(
        F.unhex(F.md5(F.concat_ws(" ", "words"))).alias("template"), "label", F.lit(exact).alias("exact"), "pairs", F.posexplode(places).alias("place", "p"),
    ).select(
        "template", "label", "exact", "pairs", "place", F.floor(F.col("place") / 64).cast("int").alias("block"),
        F.call_function("shiftleft", F.lit(1).cast("long"), F.col("place") % 64).alias("bit"), "p.first", "p.second",
    )


def scan(
    docs: DataFrame, doc_id: Column, text: Column, phrases: dict[str, str] | DataFrame | None = None, templates: dict[str, str] | DataFrame | None = None,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    n_base counts the places of all phrases (first_word and last_word their smallest and largest start, null without any); spans
    holds the verified spans of phrases and templates by label, words and covered share; score is the largest share (0 without
    any). Null and empty texts have no words. Rows are told apart by id and text (64-bit hash); equal rows have equal results.
    Phrases and templates are dictionaries (text to label) or tables with the columns text and label, of texts of any length; a template that
    is there twice counts once. Their pairs are broadcast up to ``BROADCAST_PAIRS``, beyond that both sides meet by a shuffle on the
    pair. Other columns of ``docs`` are not used.
    """
    spark = docs.sparkSession
    as_table = lambda given, usual: given if isinstance(given, DataFrame) else listed(spark, usual if given is None else given)
    pairs = write_stage(template_pairs(as_table(phrases, PHRASES), True).union(template_pairs(as_table(templates, TEMPLATES), False)), "templates")
    keyed = docs.select(doc_id.alias("doc_id"), F.xxhash64(text).alias("text_hash"), words_of(text).alias("words"))
    rows = keyed.select("doc_id", "text_hash", F.size("words").cast("long").alias("n_words"))

    hits = _hits(keyed, pairs)
    votes = hits.groupBy("doc_id", "text_hash", "template", "label", "exact", "pairs", (F.col("at") - F.col("place")).alias("diagonal"), "block").agg(
        F.bit_or("bit").alias("held"),
    )

    # A document's hits of one template; a document is a row, so this is bounded as a row is. Masks of one diagonal are peers and share their span.
    own = Window.partitionBy("doc_id", "text_hash", "template", "label", "exact").orderBy("diagonal")
    step = F.col("diagonal") - F.lag("diagonal").over(own)
    apart = F.coalesce(F.when(F.col("exact"), step > 0).otherwise(step > NEIGHBOURS), F.lit(True))
    span = ["doc_id", "text_hash", "template", "label", "exact", "pairs", "span"]
    masks = votes.withColumn("span", F.sum(F.when(apart, 1).otherwise(0)).over(own)).groupBy(*span, "block").agg(
        F.min("diagonal").alias("start"), F.max("diagonal").alias("end"), F.bit_or("held").alias("held"),
    )
    merged = masks.groupBy(*span).agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum(F.bit_count("held")).alias("n"))
    share = F.col("n") / F.col("pairs")
    found = merged.withColumn("share", share).where(F.when(F.col("exact"), F.col("n") == F.col("pairs")).otherwise(F.col("share") >= COVERED))
    first = F.greatest(F.lit(0), F.col("start")).cast("long")
    by_doc = found.groupBy("doc_id", "text_hash").agg(
        F.count(F.when(F.col("exact"), 1)).alias("n_base"), F.min(F.when(F.col("exact"), first)).alias("first_word"), F.max(F.when(F.col("exact"), first)).alias("last_word"),
        F.array_join(F.sort_array(F.collect_set(F.when(F.col("exact"), F.col("label")))), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.collect_set("label")), ",").alias("labels"), F.max("share").alias("score"),
        F.sort_array(F.collect_list(F.struct(first.alias("first"), (F.col("end") + F.col("pairs")).cast("long").alias("last"), "label", "share"))).alias("spans"),
    )
    r, d = rows.alias("r"), by_doc.alias("d")
    joined = r.join(d, F.expr("r.doc_id <=> d.doc_id and r.text_hash <=> d.text_hash"), "left")
    return joined.select(
        "r.doc_id", "n_words", F.coalesce("n_base", F.lit(0)).cast("long").alias("n_base"), "first_word", "last_word",
        F.coalesce("base_labels", F.lit("")).alias("base_labels"), F.coalesce("labels", F.lit("")).alias("labels"), F.coalesce("score", F.lit(0.0)).alias("score"), "spans",
    )


def _hits(keyed: DataFrame, pairs: DataFrame) -> DataFrame:
    """Every place of a document (``at``) whose pair of words is one of ``pairs``."""
    over = lambda of: F.when(F.size("words") > 1, let(F.col("words"), lambda w: F.transform(F.sequence(F.lit(0), F.size(w) - 2), lambda i: of(F.get(w, i), F.get(w, i + 1)))))
    if pairs.count() <= BROADCAST_PAIRS:
        rolled = keyed.select("doc_id", "text_hash", "words", F.posexplode(over(lambda a, b: F.xxhash64(a, b))).alias("at", "h"))
        met = rolled.join(F.broadcast(pairs.withColumn("h", F.xxhash64("first", "second"))), "h")
        return met.where((F.get("words", F.col("at")) == F.col("first")) & (F.get("words", F.col("at") + 1) == F.col("second")))
    # Pairs go by themselves here, so that no shuffled row holds the document's words. A pair of all texts is a hot key of the larger side: the adaptive skew join splits it.
    rolled = keyed.select("doc_id", "text_hash", F.posexplode(over(lambda a, b: F.struct(a.alias("first"), b.alias("second")))).alias("at", "p"))
    return rolled.select("doc_id", "text_hash", "at", "p.first", "p.second").join(pairs.hint("merge"), ["first", "second"])
