"""Toxicity: a linear classifier over character n-grams whose features are scaled by naive Bayes log-count ratios.

A text is the set of its hashed n-grams of code points. The ratio of an n-gram is the log of its smoothed share among texts of label 1 over that among texts of
label 0, counted over all labelled training texts. Logistic regression on the scaled features is fitted on a bounded sample; n-grams outside it share
the mean weight that its n-grams got.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.llm.common import as_bytes, map_rows
from funnelspark.session import write_stage

LENGTHS, BITS = (3, 4, 5), 18
#: Bound of the sample the classifier is fitted on: different texts of label 1, and as many times that of label 0. Ratios are counted over all training texts.
SAMPLE, ZEROS_PER_ONE = 2000, 2
SMOOTHING, PENALTY, ROUNDS, RATE = 1.0, 30.0, 120, 0.05
#: N-grams of the sample that are added up together.
CHUNK = 1 << 20

SCORE = T.StructType([T.StructField("score", T.DoubleType())])


def features(text: bytes) -> np.ndarray:
    """Distinct hashed n-grams of a text's code points, A-Z lower-cased, ascending."""
    points = (" " + text.lower().decode("utf-8", "replace") + " ").encode("utf-32-le")
    raw = np.frombuffer(points, dtype=np.uint32).astype(np.uint64)
    found, gram = [], raw
    for n in range(2, max(LENGTHS) + 1):
        if len(raw) < n:
            break
        # 21 bits hold a code point; what runs over is mixed in by the odd factor.
        gram = gram[:-1] * np.uint64(0x9E3779B97F4A7C15) + raw[n - 1:]
        if n in LENGTHS:
            found.append(((gram + np.uint64(n << 56)) * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(64 - BITS))
    every = np.concatenate(found) if found else np.zeros(0, dtype=np.uint64)
    if len(every) < 4000:
        return np.unique(every).astype(np.uint32)
    held = np.zeros(1 << BITS, dtype=bool)
    held[every] = True
    return np.flatnonzero(held).astype(np.uint32)


def packed(docs: DataFrame, doc_id: Column, text: Column) -> DataFrame:
    """doc_id and the compressed text, for joining labels to texts with less to shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            yield batch.set_column(1, "text", pa.array([compress(t) for t in as_bytes(batch.column(1))], pa.binary()))

    return docs.select(doc_id.cast("long").alias("doc_id"), text.cast("string").alias("text")).mapInArrow(pack, "doc_id long, text binary")


def _unpacked(column: pa.Array) -> list[bytes]:
    unpack = zstandard.ZstdDecompressor().decompress
    return [unpack(t) for t in column.to_pylist()]


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many texts of each label hold each n-gram, summed over a task."""
    held = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        for label, text in zip(batch.column("label").to_pylist(), _unpacked(batch.column("text")), strict=True):
            held[label, features(text)] += 1
    some = np.flatnonzero(held.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(held[1, some]), pa.array(held[0, some])], names=["feature", "ones", "zeros"])


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The n-grams of sampled texts: their number, and the compressed differences of their ascending ids."""
    compress = zstandard.ZstdCompressor(level=3).compress
    for batch in batches:
        some = [features(t) for t in _unpacked(batch.column("text"))]
        made = [compress(np.diff(s, prepend=np.uint32(0)).astype(np.uint32).tobytes()) for s in some]
        yield pa.RecordBatch.from_arrays([batch.column("hash"), pa.array([len(s) for s in some], pa.int64()), pa.array(made, pa.binary())], names=["hash", "n", "ids"])


def _sampled(rows: DataFrame, label: int, most: int) -> list[tuple[int, bytes]]:
    """Numbers and packed ids of the texts of the smallest hashes, copies once; at most 2^18 ids a text reach the driver."""
    hashed = rows.where(F.col("label") == label).select(F.xxhash64("text").alias("hash"), "text")
    last = hashed.select("hash").distinct().orderBy("hash").limit(most).agg(F.max("hash")).first()[0]
    if last is None:
        return []
    chosen = hashed.where(F.col("hash") <= last).groupBy("hash").agg(F.min("text").alias("text"))
    found = chosen.mapInArrow(_ids, "hash long, n long, ids binary").toArrow().sort_by("hash")
    return list(zip(found.column("n").to_pylist(), found.column("ids").to_pylist(), strict=True))


def fit(training: DataFrame, text: Column, label: Column, sample: int = SAMPLE) -> tuple[np.ndarray, float]:
    """Weights per hashed n-gram (ratios included) and the intercept.

    ``text`` is a text as ``packed`` returns it (null counts as empty there). Rows with a label other than 0 or 1 are not used. Counts come from all rows; they reach the driver as at most 2^18 rows. The fit takes at most ``sample`` different texts
    of label 1 and ZEROS_PER_ONE times as many of label 0 as of label 1, those of the smallest hashes. Without texts of both labels all weights are 0.
    """
    rows = write_stage(training.select(label.cast("int").alias("label"), text.alias("text")).where("label in (0, 1)"), "training")
    counted = rows.mapInArrow(_counts, "feature long, ones long, zeros long").groupBy("feature").agg(F.sum("ones").alias("ones"), F.sum("zeros").alias("zeros")).toArrow()
    ones, zeros = np.full(1 << BITS, SMOOTHING), np.full(1 << BITS, SMOOTHING)
    at = counted.column("feature").to_numpy()
    ones[at] += counted.column("ones").to_numpy()
    zeros[at] += counted.column("zeros").to_numpy()
    ratio = np.log(ones / ones.sum()) - np.log(zeros / zeros.sum())

    positive = _sampled(rows, 1, sample)
    negative = _sampled(rows, 0, ZEROS_PER_ONE * len(positive)) if positive else []
    if not positive or not negative:
        return np.zeros(1 << BITS), 0.0
    sizes = np.array([n for n, _ in positive + negative])
    every, at, unpack = np.empty(sizes.sum(), dtype=np.uint32), 0, zstandard.ZstdDecompressor().decompress
    for n, ids in positive + negative:
        every[at:at + n] = np.cumsum(np.frombuffer(unpack(ids), dtype=np.uint32), dtype=np.uint32)
        at += n
    return _logistic(every, sizes, np.repeat([1.0, 0.0], [len(positive), len(negative)]), ratio)


def _scale(n: np.ndarray) -> np.ndarray:
    """Long texts count less, but not so little that one passage drowns."""
    return np.maximum(n, 1) ** -0.25


def _logistic(every: np.ndarray, sizes: np.ndarray, target: np.ndarray, ratio: np.ndarray) -> tuple[np.ndarray, float]:
    """Adam on the mean logistic loss with a squared penalty; features are ratios, scaled by the text's number of n-grams.

    ``every`` lists the n-grams of all texts, one text after the other; texts are added up in runs of about CHUNK n-grams, so nothing else grows with them.
    """
    ends, scale = np.cumsum(sizes), _scale(sizes)
    cuts = np.unique(np.append(np.searchsorted(ends, np.arange(0, ends[-1], CHUNK), side="left"), len(sizes)))
    times = np.bincount(every, minlength=len(ratio))
    weight, bias = np.where(times > 0, 1.0, 0.0), 0.0
    first, second = np.zeros(len(ratio) + 1), np.zeros(len(ratio) + 1)
    for step in range(1, ROUNDS + 1):
        grad, scaled = np.append(PENALTY * weight / np.count_nonzero(times), 0.0), weight * ratio
        for low, high in zip(cuts[:-1], cuts[1:]):
            ids = every[ends[low] - sizes[low]:ends[high - 1]]
            text = np.repeat(np.arange(high - low), sizes[low:high])
            z = np.bincount(text, weights=scaled[ids], minlength=high - low) * scale[low:high] + bias
            error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target[low:high]) / len(sizes)
            grad[:-1] += ratio * np.bincount(ids, weights=(error * scale[low:high])[text], minlength=len(ratio))
            grad[-1] += error.sum()
        first, second = 0.9 * first + 0.1 * grad, 0.999 * second + 0.001 * grad * grad
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
        weight, bias = weight - move[:-1], bias - move[-1]
    shared = float((weight * times).sum() / max(1, times.sum()))
    return np.where(times > 0, weight, shared) * ratio, float(bias)


def score_texts(docs: DataFrame, text: Column, model: tuple[np.ndarray, float], keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns or those to ``keep``) with score, the classifier's probability of label 1.

    A null text counts as empty; every text has a score. Rows, repeated ones included, are scored each on its own. An input column named score is replaced.
    The model is a vector of 2^18 weights (1 MB).
    """
    weights, bias = model[0].astype(np.float32), model[1]

    def run(values: list[bytes]) -> list[list]:
        scores = []
        for v in values:
            found = features(v)
            z = float(weights[found].sum(dtype=np.float64)) * max(1.0, len(found)) ** -0.25 + bias
            scores.append(float(1 / (1 + np.exp(-np.clip(z, -30, 30)))))
        return [scores]

    return map_rows(docs, text, SCORE, run, keep=keep)
