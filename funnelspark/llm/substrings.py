"""Exact substring dedup with difference-cover anchors.

Two equal windows of ``window`` words may start anywhere. With a difference cover D of period v (every difference modulo v is one of two
members of D) some shift below v brings both starts to positions in D at once. So hashes of the shorter windows that start at
positions in D are enough to find every match: any long match shares such an anchor, at the same offset. Only windows that hold
an anchor seen in another document are then extended to full length and compared.

Plan: documents are dealt to shards of bounded size by one exchange, which all three passes read. A pass sends each hash
of a shard once, packed by hash range, so a passage that every document holds costs one entry a shard.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.llm.common import BLANKS, as_bytes, number_words, window_hashes, word_hashes

WINDOW = 13
#: Perfect difference sets: every non-zero difference modulo the period occurs exactly once.
COVERS = {1: (0,), 3: (0, 1), 7: (0, 1, 3), 13: (0, 1, 3, 9), 21: (0, 1, 4, 14, 16), 31: (0, 1, 3, 8, 12, 18)}
SHARD_BYTES = 5 << 20
#: Hashes a range of hashes holds on average.
RANGE_HASHES = 1 << 20

_LAST = np.iinfo(np.int64).max
_NO_HASHES = np.zeros(0, dtype=np.uint64)


def _compressed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts are compressed one by one before their only shuffle; a null text is an empty one."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        yield batch.set_column(2, "value", pa.array([pack(v) for v in as_bytes(batch.column(2))], pa.binary()))


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The longest period that leaves anchors of half a window or more."""
    period = max(v for v in COVERS if window - v + 1 >= (window + 1) // 2)
    return period, COVERS[period]


class Shard:
    """Words of some documents and the hashes of their windows."""

    def __init__(self, table: pa.Table, window: int):
        self.window = window
        unpack = zstandard.ZstdDecompressor().decompress
        values = [unpack(v) for v in table.column("value").to_pylist()]
        self.docs = [v.translate(BLANKS).split() for v in values]
        self.order = np.array([_LAST if x is None else x for x in table.column("doc").to_pylist()], dtype=np.int64)
        ids, self.starts, vocabulary = number_words(self.docs)
        counts = np.diff(self.starts)
        self.doc = np.repeat(np.arange(len(self.docs)), counts)
        self.place = np.arange(len(ids)) - self.starts[self.doc]
        self.left = counts[self.doc] - self.place  # words from here to the end of the document
        self.hashed = [word_hashes(vocabulary, seed)[ids] if len(ids) else _NO_HASHES for seed in (1, 2)]

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and hashes of the anchor windows; only documents with a full window have any."""
        period, cover = cover_for(self.window)
        length = self.window - period + 1
        at = np.flatnonzero(np.isin(self.place % period, cover) & (self.left >= length) & (self.place + self.left >= self.window))
        return at, window_hashes(self.hashed[0], length)[at]

    def shared_here(self, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Hashes that stand in two documents of this shard."""
        by = np.argsort(hashes)  # of equal hashes, two neighbours differ in document if any two do
        h, d = hashes[by], self.order[self.doc[at[by]]]
        return np.unique(h[1:][(h[1:] == h[:-1]) & (d[1:] != d[:-1])])

    def candidates(self, shared: np.ndarray) -> np.ndarray:
        """Starts of full windows that hold an anchor with one of these hashes."""
        if not len(shared):
            return np.zeros(0, dtype=np.int64)
        period, _ = cover_for(self.window)
        at, hashes = self.anchors()
        found = at[_within(hashes, shared)]
        mark = np.zeros(len(self.place) + 1, dtype=np.int64)
        np.add.at(mark, found - np.minimum(self.place[found], period - 1), 1)
        np.add.at(mark, found + 1, -1)
        return np.flatnonzero((np.cumsum(mark[:-1]) > 0) & (self.left >= self.window))

    def windows(self, at: np.ndarray) -> np.ndarray:
        """Two independent 64-bit hashes of the full windows at these starts, as records that sort."""
        out = np.empty(len(at), dtype=[("a", "<u8"), ("b", "<u8")])
        for name, hashed in zip("ab", self.hashed, strict=True):
            out[name] = window_hashes(hashed, self.window)[at] if len(at) else 0
        return out


def _within(values: np.ndarray, ascending: np.ndarray) -> np.ndarray:
    """Which values are in the sorted array."""
    if not len(ascending):
        return np.zeros(len(values), dtype=bool)
    return ascending[np.minimum(np.searchsorted(ascending, values), len(ascending) - 1)] == values


def _first_of(keys: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct records, the smallest order of each, and each key's place among them."""
    by = np.argsort(keys["a"])
    a, b = keys["a"][by], keys["b"][by]
    if np.any((a[1:] == a[:-1]) & (b[1:] != b[:-1])):
        by = np.lexsort((keys["b"], keys["a"]))
        a, b = keys["a"][by], keys["b"][by]
    new = np.ones(len(a), dtype=bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    which = np.empty(len(a), dtype=np.int64)
    which[by] = np.cumsum(new) - 1
    first = np.minimum.reduceat(order[by], np.flatnonzero(new)) if len(a) else order
    return keys[by[new]], first, which


def _dealt(shard: int, hashes: np.ndarray, ranges: int, **columns: np.ndarray) -> pa.Table:
    """Ascending hashes (and what belongs to each) as one row per range of hashes."""
    number = ((hashes >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)
    cuts = np.flatnonzero(np.diff(number, prepend=-1))
    ends = np.append(cuts, len(hashes))[1:]
    arrays = {"part": pa.array(number[cuts], pa.int64()), "shard": pa.array(np.full(len(cuts), shard), pa.int64())}
    for name, values in {"hashes": hashes, **columns}.items():
        arrays[name] = pa.array([_planes(values[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary())
    return pa.table(arrays)


def _planes(values: np.ndarray) -> bytes:
    """Eight-byte values by byte position, so that a shuffle's compression sees the equal high bytes together."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(-1, 8).T.tobytes()


def _loaded(column: pa.ChunkedArray, kind: str) -> np.ndarray:
    parts = [np.frombuffer(x, dtype=np.uint8).reshape(8, -1).T for x in column.to_pylist()]
    return np.concatenate([np.zeros((0, 8), dtype=np.uint8), *parts]).view(kind).ravel()


def _by_shard(table: pa.Table, keep: np.ndarray, **columns: np.ndarray) -> pa.Table:
    """One row per shard with the columns' kept elements. Elements lie in the order of the rows."""
    sizes = np.array([len(x) // 8 for x in table.column("hashes").to_pylist()], dtype=np.int64)
    shards = np.repeat(table.column("shard").to_numpy(), sizes)[keep]
    by = np.argsort(shards, kind="stable")
    names, cuts = np.unique(shards[by], return_index=True)
    ends = np.append(cuts, len(shards))[1:]
    arrays = {"shard": pa.array(names, pa.int64())}
    for name, values in columns.items():
        kept = values[keep][by]
        arrays[name] = pa.array([_planes(kept[a:b]) for a, b in zip(cuts, ends, strict=True)], pa.binary())
    return pa.table(arrays)


def remove_repeats(docs: DataFrame, doc_id: Column, text: Column, window: int = WINDOW, texts: bool = True, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns or those to ``keep``) with n_words, n_removed, kept_sha256 and (if asked for) kept_text.

    A word goes if a window of ``window`` words that covers it also starts in a document with a smaller ``doc_id`` (an integer). Windows are
    judged on the input. Null ids rank after all others; rows of one id are one document to each other, so they never remove
    each other's words. Null and empty texts have no words. Window hashes have 128 bits. Repeated rows each
    get their result. An input column of an output's name is replaced.
    """
    fields = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())]
    fields += [T.StructField("kept_text", T.StringType())] if texts else []
    outputs = {f.name for f in fields}
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    size = docs.agg(F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes"), F.count(F.lit(1)).alias("rows")).first()
    shards = max(1, math.ceil((size.bytes + 100 * size.rows) / SHARD_BYTES))
    ranges = max(1, math.ceil(size.bytes / 12 / RANGE_HASHES))
    dealt = docs.select(
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(shards)).cast("long").alias("shard"),
        doc_id.cast("long").alias("doc"), text.cast("string").alias("value"),
        (F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_"))).alias("row"),
    )
    row = dealt.schema["row"]
    dealt = dealt.mapInArrow(_compressed, T.StructType([*dealt.drop("value", "row").schema, T.StructField("value", T.BinaryType()), row]))

    def anchors(table: pa.Table) -> pa.Table:
        _, hashes = Shard(table, window).anchors()
        return _dealt(table.column("shard")[0].as_py(), np.unique(hashes), ranges)

    def shared(table: pa.Table) -> pa.Table:
        hashes = _loaded(table.column("hashes"), "<u8")
        by = np.argsort(hashes)
        same = hashes[by][1:] == hashes[by][:-1]
        keep = np.zeros(len(hashes), dtype=bool)
        keep[by[1:][same]] = keep[by[:-1][same]] = True
        return _by_shard(table, np.flatnonzero(keep), hashes=hashes)

    def extend(docs_: pa.Table, flagged: pa.Table) -> pa.Table:
        if not len(docs_) or not len(flagged):
            return _dealt(0, _NO_HASHES, ranges, more=_NO_HASHES, first=_NO_HASHES)
        shard = Shard(docs_, window)
        at = shard.candidates(np.unique(_loaded(flagged.column("hashes"), "<u8")))
        keys, first, _ = _first_of(shard.windows(at), shard.order[shard.doc[at]])
        return _dealt(docs_.column("shard")[0].as_py(), keys["a"].copy(), ranges, more=keys["b"].copy(), first=first)

    def earlier(table: pa.Table) -> pa.Table:
        keys = np.empty(sum(len(x) // 8 for x in table.column("hashes").to_pylist()), dtype=[("a", "<u8"), ("b", "<u8")])
        keys["a"], keys["b"] = _loaded(table.column("hashes"), "<u8"), _loaded(table.column("more"), "<u8")
        order = _loaded(table.column("first"), "<i8")
        _, first, which = _first_of(keys, order)
        return _by_shard(table, np.flatnonzero(first[which] < order), hashes=keys["a"], more=keys["b"])

    def remove(docs_: pa.Table, flagged: pa.Table) -> pa.Table:
        shard = Shard(docs_, window)
        at = shard.candidates(shard.shared_here(*shard.anchors()))
        gone = [at[:0]]
        if len(at):
            _, first, which = _first_of(shard.windows(at), shard.order[shard.doc[at]])
            gone.append(at[first[which] < shard.order[shard.doc[at]]])
        if len(flagged):
            a, b = _loaded(flagged.column("hashes"), "<u8"), _loaded(flagged.column("more"), "<u8")
            by = np.lexsort((b, a))
            a, b = a[by], b[by]
            wide = np.flatnonzero(shard.left >= window)
            wide = wide[_within(window_hashes(shard.hashed[0], window)[wide], a)]
            found = shard.windows(wide)
            low, high = np.searchsorted(a, found["a"], "left"), np.searchsorted(a, found["a"], "right")
            same = np.zeros(len(wide), dtype=bool)
            for step in range(int((high - low).max(initial=0))):
                same |= (low + step < high) & (b[np.minimum(low + step, len(b) - 1)] == found["b"])
            gone.append(wide[same])
        mark = np.zeros(len(shard.place) + 1, dtype=np.int64)
        for starts in gone:
            np.add.at(mark, starts, 1)
            np.add.at(mark, starts + window, -1)
        removed = np.cumsum(mark[:-1]) > 0
        columns: list[list] = [[] for _ in fields]
        for k, words in enumerate(shard.docs):
            lost = removed[shard.starts[k]: shard.starts[k + 1]]
            n = int(lost.sum())
            left = b" ".join(w for w, g in zip(words, lost.tolist(), strict=True) if not g) if n else b" ".join(words)
            for column, value in zip(columns, (len(words), n, hashlib.sha256(left).hexdigest(), left.decode("utf-8", "replace")), strict=False):
                column.append(value)
        kinds = {"n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string(), "kept_text": pa.string()}
        return pa.table({"row": docs_.column("row")} | {f.name: pa.array(c, kinds[f.name]) for f, c in zip(fields, columns, strict=True)})

    packed, by_shard = "part long, shard long, hashes binary", dealt.groupBy("shard")
    once = by_shard.applyInArrow(anchors, packed).groupBy("part").applyInArrow(shared, "shard long, hashes binary")
    wide = by_shard.cogroup(once.groupBy("shard")).applyInArrow(extend, packed + ", more binary, first binary")
    known = wide.groupBy("part").applyInArrow(earlier, "shard long, hashes binary, more binary")
    made = by_shard.cogroup(known.groupBy("shard")).applyInArrow(remove, T.StructType([row, *fields]))
    return made.select(*[F.col("row").getField(c).alias(c) for c in kept], *[F.col(f.name) for f in fields])
