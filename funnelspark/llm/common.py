"""Helpers the operators of this package share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Byte tables: everything that is no word byte becomes a space, so that bytes.split() yields the words.
_WORD = bytes(range(0x30, 0x3A)) + bytes(range(0x41, 0x5B)) + bytes(range(0x61, 0x7B)) + bytes(range(0x80, 0x100))
FOLDED = bytes((b + 32 if 0x41 <= b <= 0x5A else b) if b in _WORD else 0x20 for b in range(256))
#: Words that are separated by space, tab, line feed, vertical tab, form feed and carriage return only.
BLANKS = bytes(0x20 if b == 0x20 or 0x09 <= b <= 0x0D else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Bind ``value`` once per row, so that a lambda in ``body`` does not evaluate it per element."""
    return F.transform(F.array(value), body)[0]


def chi_square_below(x: float, df: int) -> float:
    """Probability that a chi-square variable with a small whole number of degrees of freedom is below ``x``."""
    total = math.erf(math.sqrt(x / 2)) if df % 2 else 1 - math.exp(-x / 2)
    # Recurrence of the regularised gamma function from df = 1 or 2 upwards.
    for k in range(1 if df % 2 else 2, df, 2):
        total -= math.exp(k / 2 * math.log(x / 2) - x / 2 - math.lgamma(k / 2 + 1))
    return total


def chi_square_quantile(p: float, df: int) -> float:
    """Quantile of that distribution, by bisection."""
    low, high = 1e-9, 1e4
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi_square_below(mid, df) < p else (low, mid)
    return low


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, nulls as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def map_rows(
    df: DataFrame, value: Column, outputs: T.StructType, fn: Callable[[list], Iterable[list]], max_bytes: int = 8 << 20, each: int = 0,
    keep: list[str] | None = None,
) -> DataFrame:
    """All columns of ``df`` (or those to ``keep``) plus ``outputs``, computed by ``fn`` from runs of values.

    ``fn`` gets a list of values (bytes, nulls as b"") of at most ``max_bytes`` together, or a single longer one, and
    returns the output columns as lists. A value counts ``each`` bytes more than it has. An input column with the name of an
    output is replaced.
    """
    kept = [c for c in (df.columns if keep is None else keep) if c.lower() not in {f.name.lower() for f in outputs}]
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row") if kept else F.struct(F.lit(0).alias("_")).alias("row"), value.cast("string").alias("value"))
    schema = T.StructType([packed.schema["row"], *outputs])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        arrow = None
        for batch in batches:
            if arrow is None:
                from pyspark.sql.pandas.types import to_arrow_schema

                arrow = to_arrow_schema(outputs)
            # Only the values of one run become Python objects at a time.
            values = batch.column(1).cast(pa.binary())
            sizes = pc.fill_null(pc.binary_length(values), 0).to_pylist()
            for low, high in runs([n + each for n in sizes], max_bytes):
                columns = fn(as_bytes(values.slice(low, high - low)))
                arrays = [pa.array(c, type=f.type) for c, f in zip(columns, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), *arrays], names=["row", *arrow.names])
        # An idle worker holds no buffers of the partition that is done.
        pa.default_memory_pool().release_unused()

    made = packed.mapInArrow(run, schema)
    return made.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col(f"`{f.name}`") for f in outputs])


def runs(sizes: list[int], limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive ranges whose sizes sum to ``limit`` at most; a larger single element is a range of its own."""
    low, total = 0, 0
    for k, size in enumerate(sizes):
        if k > low and total + size > limit:
            yield low, k
            low, total = k, 0
        total += size
    if low < len(sizes):
        yield low, len(sizes)


def number_words(docs: list[list[bytes]], first: int = 0) -> tuple[np.ndarray, np.ndarray, dict[bytes, int]]:
    """Ids of all words in order, the start of each document (and the end), and the vocabulary; ids count from ``first``."""
    starts = np.zeros(len(docs) + 1, dtype=np.int64)
    np.cumsum([len(d) for d in docs], out=starts[1:])
    flat = [w for d in docs for w in d]
    vocabulary = {w: k for k, w in enumerate(dict.fromkeys(flat), first)}
    return np.fromiter(map(vocabulary.__getitem__, flat), dtype=np.int64, count=len(flat)), starts, vocabulary


def word_hashes(vocabulary: Iterable[bytes], seed: int) -> np.ndarray:
    """A 64-bit hash per word, the same on every machine."""
    import xxhash

    return np.fromiter((xxhash.xxh3_64_intdigest(w, seed) for w in vocabulary), dtype=np.uint64)


#: Odd multiplier of the rolling hashes.
BASE = 0x9E3779B97F4A7C15


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the word."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hashes of all windows of ``length`` words (uint64, modulo 2^64), by doubling."""
    if len(words) < length:
        return np.zeros(0, dtype=np.uint64)
    done, have = None, 0
    power, size = words, 1
    rest = length
    while rest:
        if rest & 1:
            if done is None:
                done, have = power, size
            else:
                n = len(words) - have - size + 1
                done = done[:n] * np.uint64(pow(BASE, size, 1 << 64)) + power[have:have + n]
                have += size
        rest >>= 1
        if rest:
            n = len(words) - 2 * size + 1
            power = power[:n] * np.uint64(pow(BASE, size, 1 << 64)) + power[size:size + n]
            size *= 2
    return mixed(done)


def ship_package(spark: SparkSession) -> None:
    """Give the executors this library, for sessions whose workers cannot import it otherwise; once per application."""
    import tempfile
    import zipfile
    from pathlib import Path

    context = spark.sparkContext
    if getattr(context, "_funnelspark_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="funnelspark-")) / "funnelspark.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(root.rglob("*.py")):
            archive.write(file, file.relative_to(root.parent))
    context.addPyFile(str(target))
    context._funnelspark_shipped = True
