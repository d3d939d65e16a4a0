"""Near-duplicate documents by DartMinHash signatures.

A document is a weighted set: its shingles of words, weighted by how often they occur. Weight times rank is a plane in which every element
owns a strip; darts fall into it as a Poisson process that depends on the element only, so documents that share an element share the darts
below the smaller weight. Darts of rank below about (k ln k + 2k) / (total weight) are thrown, whatever the weights are; the earliest dart
of each of the k coordinates makes the signature, and two documents agree in a coordinate with the probability of their weighted Jaccard
similarity. Bands of coordinates are joined; candidates are verified on the whole texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.llm.common import FOLDED, as_bytes, map_rows, mixed, number_words, runs, window_hashes, word_hashes
from funnelspark.llm.components import components
from funnelspark.session import write_stage

SHINGLE, SIMILARITY = 5, 0.8
#: A pair of similarity 0.8 misses all bands with a probability of 5 in 100,000.
BANDS, ROWS = 25, 5
#: Candidates whose signatures agree less are not verified: over four standard errors below the similarity asked for.
LIKELY = 0.65

_SIGNED = T.StructType([
    T.StructField("n_shingles", T.LongType()), T.StructField("bands", T.ArrayType(T.LongType())), T.StructField("signature", T.BinaryType()),
])


def cells(values: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash per unit of weight (a shingle and which occurrence of it) of all texts, and where each text's start.

    A text with fewer words than a shingle has is one shingle; a text without words has none.
    """
    docs = [v.translate(FOLDED).split() for v in values]
    short = [k for k, d in enumerate(docs) if 0 < len(d) < length]
    ids, starts, vocabulary = number_words(docs)
    counts = np.diff(starts)
    if not len(ids):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(docs) + 1, dtype=np.int64)
    words = word_hashes(vocabulary, 3)[ids]
    doc = np.repeat(np.arange(len(docs)), counts)
    rolled = np.concatenate([window_hashes(words, length), np.zeros(min(len(words), length - 1), dtype=np.uint64)])
    use = counts[doc] - (np.arange(len(ids)) - starts[doc]) >= length
    for k in short:
        rolled[starts[k]] = window_hashes(words[starts[k]: starts[k + 1]], int(counts[k]))[0]
        use[starts[k]] = True
    shingle, doc = rolled[use], doc[use]
    own = mixed(shingle + mixed(doc.astype(np.uint64) + np.uint64(1)))
    by = np.argsort(own)
    new = np.ones(len(by), dtype=bool)
    new[1:] = own[by][1:] != own[by][:-1]
    which = np.empty(len(by), dtype=np.uint64)
    which[by] = np.arange(len(by)) - np.maximum.accumulate(np.where(new, np.arange(len(by)), 0))
    sizes = np.bincount(doc, minlength=len(docs))
    return mixed(shingle + which * np.uint64(0xD6E8FEB86659FD93)), np.concatenate([[0], np.cumsum(sizes)])


def dart_signatures(cell: np.ndarray, starts: np.ndarray, k: int) -> np.ndarray:
    """Ids of the earliest dart per coordinate, one row per document; rows of documents without cells stay 0."""
    weight = np.diff(starts)
    out = np.zeros((len(weight), k), dtype=np.uint64)
    todo, reach = np.flatnonzero(weight), k * math.log(k) + 2 * k
    while len(todo):
        picked = np.concatenate([np.arange(starts[d], starts[d + 1]) for d in todo])
        row = np.repeat(np.arange(len(todo)), weight[todo])
        limit = (reach / weight[todo])[row]
        seed = cell[picked]
        rank = np.zeros(len(picked))
        darts, step = [], 0
        while len(seed):
            step += 1
            dart = mixed(seed + np.uint64(step * 0xA0761D6478BD642F % (1 << 64)))
            rank = rank - np.log(((dart >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53)
            near = rank < limit
            seed, rank, row, limit, dart = seed[near], rank[near], row[near], limit[near], dart[near]
            name = mixed(dart ^ np.uint64(0xE7037ED1A0B428DB))
            darts.append((row * k + (name >> np.uint64(32)).astype(np.int64) * k // (1 << 32), rank, name))
        slot, at, name = (np.concatenate(x) for x in zip(*darts, strict=True))
        late = np.argsort(-at)  # the earliest dart of a slot is written last
        signature, full = np.zeros(len(todo) * k, dtype=np.uint64), np.zeros(len(todo) * k, dtype=bool)
        signature[slot[late]] = name[late]
        full[slot] = True
        done = full.reshape(-1, k).all(axis=1)
        out[todo[done]] = signature.reshape(-1, k)[done]
        todo, reach = todo[~done], reach * 2
    return out


def _sign(values: list[bytes], length: int, bands: int, rows: int) -> list[list]:
    cell, starts = cells(values, length)
    signature = dart_signatures(cell, starts, bands * rows)
    by_band = signature.reshape(len(values), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), by_band.shape[:2]).copy()
    for r in range(rows):
        key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + by_band[:, :, r])
    some = np.diff(starts) > 0
    key, short = key.view(np.int64).tolist(), signature.astype("<u2")
    return [np.diff(starts).tolist(), [k if s else [] for k, s in zip(key, some, strict=True)], [x.tobytes() if s else b"" for x, s in zip(short, some, strict=True)]]


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield batch.set_column(1, "text", pa.array([pack(v) for v in as_bytes(batch.column(1))], pa.binary()))


def _verified(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Weighted Jaccard similarity of the two texts of each row."""
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        left, right = batch.column("text_a").to_pylist(), batch.column("text_b").to_pylist()
        for low, high in runs([4 * (len(x) + len(y)) for x, y in zip(left, right, strict=True)], 8 << 20):
            places: dict[bytes, int] = {}
            for x in (*left[low:high], *right[low:high]):
                places.setdefault(x, len(places))
            cell, starts = cells([unpack(x) for x in places], length)
            parts = [np.sort(cell[a:b]) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            scores = []
            for x, y in zip(left[low:high], right[low:high], strict=True):
                p, q = parts[places[x]], parts[places[y]]
                same = len(np.intersect1d(p, q, assume_unique=True))
                scores.append(same / max(1, len(p) + len(q) - same))
            part = batch.slice(low, high - low)
            yield pa.RecordBatch.from_arrays([part.column("a"), part.column("b"), pa.array(scores, pa.float64())], names=["a", "b", "similarity"])


def _agreement(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        p, q = (np.frombuffer(b"".join(batch.column(c).to_pylist()), dtype="<u2").reshape(batch.num_rows, -1) for c in ("signature_a", "signature_b"))
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array((p == q).mean(axis=1))], names=["a", "b", "agreement"])


def _in_split_buckets(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The members of buckets that hold several classes."""
    labelled = members.select("band", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = labelled.groupBy("band").agg((F.min("label") != F.max("label")).alias("split")).where("split").select("band")
    return members.select("band", "node").join(split, "band", "left_semi").select("node").distinct()


def _prefixes(texts: DataFrame, length: int, similarity: float) -> DataFrame:
    """node, n_cells, n_common (of them in other texts), cell and place of the rarest cells of each text, as far as a similar text must share one of them.

    With cells ordered from rare to frequent, two texts of m and n cells that share c of them share one among the first m - c + 1 of the one
    and n - c + 1 of the other. Cells of one text only are counted in the places but not returned.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            values = batch.column("text").to_pylist()
            for low, high in runs([4 * len(v) for v in values], 8 << 20):
                cell, starts = cells([unpack(v) for v in values[low:high]], length)
                sizes = np.diff(starts)
                node = np.repeat(batch.column("node").to_numpy()[low:high], sizes)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(np.repeat(sizes, sizes)), pa.array(cell.view(np.int64))], names=["node", "n_cells", "cell"])

    each = texts.mapInArrow(listed, "node long, n_cells long, cell long")
    common = each.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    own = Window.partitionBy("node")
    placed = each.join(common, "cell").withColumn("n_common", F.count(F.lit(1)).over(own))
    placed = placed.withColumn("place", F.col("n_cells") - F.col("n_common") + F.row_number().over(own.orderBy("n", "cell")))
    return placed.where(F.col("place") <= F.col("n_cells") - F.ceil(similarity * F.col("n_cells") - 1e-6) + 1).select("node", "n_cells", "n_common", "cell", "place")


def _across(of: DataFrame, others: DataFrame, similarity: float) -> DataFrame:
    """Pairs in different classes and how many shingles they share early enough in both orders. Of two classes the smaller one looks."""
    left = of.select("cell", *[F.col(c).alias(f"{c}_a") for c in ("node", "label", "size", "n_cells", "place")])
    right = others.select("cell", *[F.col(c).alias(f"{c}_b") for c in ("node", "label", "size", "n_cells", "place")])
    together = F.ceil(similarity / (1 + similarity) * (F.col("n_cells_a") + F.col("n_cells_b")) - 1e-6)
    met = left.join(right, "cell").where(
        F.expr("size_a < size_b or (size_a = size_b and label_a < label_b)")
        & (F.col("place_a") <= F.col("n_cells_a") - together + 1) & (F.col("place_b") <= F.col("n_cells_b") - together + 1)
    )
    return met.groupBy("node_a", "label_b", "node_b").agg(F.count(F.lit(1)).alias("n"))


def near_duplicates(
    docs: DataFrame, doc_id: Column, text: Column, similarity: float = SIMILARITY, shingle: int = SHINGLE, bands: int = BANDS, rows: int = ROWS,
) -> DataFrame:
    """One row per row of ``docs``: doc_id (long), node (hash of the text), class_node (smallest of a class), class_id, class_size.

    Texts are linked if the weighted Jaccard similarity of their shingles of ``shingle`` words is ``similarity`` or more; a class holds
    all that are connected, and class_id is its smallest doc_id. Words are runs of letters, digits and non-ASCII characters, A-Z
    lower-cased; fewer words than a shingle has are one shingle. Texts without words (null, empty) are like nothing: node is null
    and class_id their own doc_id. Equal texts are one node from the start. Null ids rank after all others (class_id is null where no
    row of a class has an id). Repeated rows each count. Other columns of ``docs`` are not used.

    Work: equal texts are not paired. In a bucket every member is compared with one centre by signature, and with the best centre of all its
    buckets on whole texts. Then members of buckets that still hold several classes are compared across classes, if they share one of their
    rarest shingles, as all similar pairs do. So every pair of a bucket ends up in one class or is compared or proven unlike,
    without all pairs of a large bucket of copies. A centre is skipped only if the signatures agree too little (LIKELY); the
    last step is exact.
    """
    keyed = docs.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text"), F.xxhash64(text).alias("node"))
    signed = write_stage(
        map_rows(keyed, F.col("text"), _SIGNED, lambda v: _sign(v, shingle, bands, rows), each=3000, keep=["doc_id", "node"])
        .select("doc_id", F.when(F.col("n_shingles") > 0, F.col("node")).alias("node"), "bands", "signature"),
        "signatures",
    )
    nodes = signed.where("node is not null").dropDuplicates(["node"])
    dealt = nodes.select("node", F.explode("bands").alias("band"))
    centres = (
        dealt.groupBy("band").agg(F.count(F.lit(1)).alias("n"), F.min_by("node", F.xxhash64("band", "node")).alias("centre"))
        .where("n > 1").select("band", "centre")
    )
    members = write_stage(dealt.join(centres, "band").select("band", "node", "centre"), "buckets")
    marked = members.select("node").distinct()
    signatures = write_stage(nodes.select("node", "signature").join(marked, "node", "left_semi"), "candidates")
    # One text of each node and task is shuffled.
    texts = keyed.select("node", "text").mapInArrow(_packed, "node long, text binary").dropDuplicates(["node"])
    texts = write_stage(texts.join(marked, "node", "left_semi"), "candidate-texts")

    def likely(pairs: DataFrame) -> DataFrame:
        both = (
            pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
            .join(signatures.toDF("a", "signature_a"), "a").join(signatures.toDF("b", "signature_b"), "b")
        )
        return both.mapInArrow(_agreement, "a long, b long, agreement double").where(F.col("agreement") >= min(LIKELY, similarity))

    def verified(pairs: DataFrame, label: str) -> DataFrame:
        both = pairs.select("a", "b").join(texts.toDF("a", "text_a"), "a").join(texts.toDF("b", "text_b"), "b")
        return write_stage(both.mapInArrow(lambda batches: _verified(batches, shingle), "a long, b long, similarity double"), label)

    near = write_stage(likely(members.where("node <> centre").select(F.col("node").alias("a"), F.col("centre").alias("b"))), "near-centres")
    sides = near.select("a", "b", "agreement").union(near.select("b", "a", "agreement")).toDF("node", "other", "agreement")
    best = sides.groupBy("node").agg(F.max_by("other", F.struct("agreement", "other")).alias("other"))
    first = verified(best.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b")).distinct(), "compared")
    links = first.where(F.col("similarity") >= similarity)

    # What is left: pairs in different classes among the members of buckets that hold several, found by the rarest shingles that they
    # must share. First the likeliest member of each other class for each member, until no class grows; then every pair.
    compared, labels = first.select("a", "b"), components(links)
    suspects = _in_split_buckets(members, labels)
    rare = write_stage(_prefixes(texts.join(suspects, "node", "left_semi"), shingle, similarity), "prefixes")
    every = False
    while True:
        sizes = labels.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
        of = rare.join(labels.join(sizes, "label"), "node", "left").withColumns({"label": F.coalesce("label", "node"), "size": F.coalesce("size", F.lit(1))})
        others = of if every else of.groupBy("cell", "label", "size").agg(F.max_by(F.struct("node", "n_cells", "place"), F.struct(F.col("n_common") / F.col("n_cells"), "node")).alias("one")).select("cell", "label", "size", "one.*")
        met = _across(of, others, similarity)
        if not every:
            met = met.groupBy("node_a", "label_b").agg(F.max_by("node_b", F.struct("n", "node_b")).alias("node_b"))
        tries = met.select(F.least("node_a", "node_b").alias("a"), F.greatest("node_a", "node_b").alias("b")).distinct()
        tried = verified(tries.join(compared, ["a", "b"], "left_anti"), "compared-rare")
        compared = compared.union(tried.select("a", "b"))
        found = tried.where(F.col("similarity") >= similarity)
        some = not found.isEmpty()
        if some:
            # A node and its label are connected already.
            labels = components(labels.toDF("a", "b").union(found.select("a", "b")))
        if every:
            break
        every = not some

    member = signed.select("doc_id", "node").join(labels, "node", "left").select("doc_id", "node", F.coalesce("label", "node").alias("label"))
    member = write_stage(member, "members")
    classes = member.where("label is not null").groupBy("label").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("class_size"))
    return member.join(classes, "label", "left").select(
        "doc_id", "node", F.col("label").alias("class_node"),
        F.when(F.col("label").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("class_size", F.lit(1)).alias("class_size"),
    )


def keep_one(docs: DataFrame, doc_id: Column, text: Column, **options) -> DataFrame:
    """``docs`` with one row of each class: that with the smallest id. Rows without words all stay, and so does one of equal rows only."""
    classes = near_duplicates(docs, doc_id, text, **options)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "node")).alias("first")
    winners = classes.where("node is not null").groupBy("class_node").agg(first).selectExpr("first.doc_id as _id", "first.node as _node")
    packed = docs.select(F.struct("*").alias("doc"), doc_id.cast("long").alias("id"), F.xxhash64(text).alias("node"), text.alias("text"))
    worded = F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
    kept = packed.where(worded).join(winners, F.expr("id <=> _id and node = _node"), "left_semi").dropDuplicates(["id", "node"])
    return kept.select("doc.*").unionByName(packed.where(~worded).select("doc.*"))
