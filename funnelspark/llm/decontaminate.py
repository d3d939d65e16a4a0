"""Benchmark decontamination: every training shard gets an FM-index in which the windows of all benchmark items are searched."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.llm.common import FOLDED, let, map_rows, number_words
from funnelspark.llm.fmindex import FMIndex
from funnelspark.session import new_scratch

WINDOW = 10
#: Bytes of text in a shard.
SHARD_BYTES = 6 << 20
#: Words of benchmark items searched at once, words of items that a worker keeps (some 20 bytes each), and items read at once.
BLOCK_WORDS, KEPT_WORDS, READ_ITEMS = 1 << 20, 1 << 22, 1024

SPAN = T.StructType([T.StructField(n, T.LongType()) for n in ("first_word", "last_word", "start", "stop")])
FOUND = T.StructType([
    T.StructField("n_words", T.LongType()), T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()), T.StructField("contaminated", T.BooleanType()),
    T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", T.ArrayType(SPAN)),
])



class Block(NamedTuple):
    """Distinct windows of some items, as places in the items' numbered words, and whose they are."""

    items: list[str]
    vocabulary: dict[bytes, int]
    words: np.ndarray
    first: np.ndarray  # of every window
    size: np.ndarray
    owner: np.ndarray  # items of window k: owner[bounds[k]:bounds[k + 1]]
    bounds: np.ndarray


#: Folder of the staged items, and their blocks if the worker keeps them.
_KEPT: dict[str, list[Block]] = {}


def _block(items: list[str], docs: list[list[bytes]], length: int) -> Block:
    words, starts, vocabulary = number_words(docs, first=1)
    counts = np.diff(starts)
    times = np.where(counts > 0, np.maximum(1, counts - length + 1), 0)
    owner = np.repeat(np.arange(len(docs)), times)
    first = starts[:-1][owner] + np.arange(len(owner)) - np.repeat(np.cumsum(times) - times, times)
    size = np.minimum(counts, length)[owner]
    windows = _rows(words, first, size, length).astype(np.int32)
    _, one, which = np.unique(windows, axis=0, return_index=True, return_inverse=True)
    which = which.reshape(-1)
    bounds = np.concatenate([[0], np.cumsum(np.bincount(which, minlength=len(one)))])
    small = lambda x: x.astype(np.int32)
    return Block(items, vocabulary, small(words), small(first[one]), small(size[one]), small(owner[np.argsort(which, kind="stable")]), bounds)


def _rows(words: np.ndarray, first: np.ndarray, size: np.ndarray, length: int) -> np.ndarray:
    """The words of each window, filled up with 0."""
    out = np.zeros((len(first), length), dtype=np.int64)
    for k in range(length):
        held = size > k
        out[held, k] = words[first[held] + k]
    return out


def _blocks(folder: str, length: int) -> Iterator[Block]:
    """The staged items, block by block. A worker numbers and cuts items of up to ``KEPT_WORDS`` words once and keeps them; more are read again for every shard."""
    if folder in _KEPT:
        yield from _KEPT[folder]
        return
    import pyarrow.dataset as ds
    from pyarrow import fs

    store, path = fs.FileSystem.from_uri(folder)
    files = [x.path for x in store.get_file_info(fs.FileSelector(path)) if x.path.endswith(".parquet")]
    kept: list[Block] | None = []
    items: list[str] = []
    docs: list[list[bytes]] = []
    n = total = 0
    for batch in ds.dataset(sorted(files), filesystem=store, format="parquet").to_batches(batch_size=READ_ITEMS):
        for item, text in zip(batch.column("item").to_pylist(), batch.column("text").to_pylist(), strict=True):
            words = text.encode().translate(FOLDED).split()
            items.append(item)
            docs.append(words)
            n, total = n + len(words), total + len(words)
            if n >= BLOCK_WORDS:
                made, items, docs, n = _block(items, docs, length), [], [], 0
                kept = kept + [made] if kept is not None and total <= KEPT_WORDS else None
                yield made
    made = _block(items, docs, length)
    _KEPT.clear()
    if kept is not None and total <= KEPT_WORDS:
        _KEPT[folder] = [*kept, made]
    yield made


def _search(values: list[bytes], folder: str, length: int) -> list[list]:
    texts = [v.translate(FOLDED) for v in values]
    docs = [t.split() for t in texts]
    ids, starts, vocabulary = number_words(docs, first=2)
    # One border symbol after every document, so that no window runs over it.
    n_docs, n = len(docs), len(ids)
    counts = np.diff(starts)
    place = np.arange(n) + np.repeat(np.arange(n_docs), counts)
    symbols = np.ones(n + n_docs, dtype=np.int64)
    symbols[place] = ids
    begin = starts[:-1] + np.arange(n_docs)
    index = FMIndex(symbols, len(vocabulary) + 1) if n else None
    covered = np.zeros(len(symbols) + 1, dtype=np.int32)
    items: list[set[str]] = [set() for _ in docs]
    for block in _blocks(folder, length) if n else ():
        lookup = np.zeros(len(block.vocabulary) + 1, dtype=np.int64)
        lookup[1:] = np.fromiter((vocabulary.get(w, 0) for w in block.vocabulary), dtype=np.int64, count=len(block.vocabulary))
        words = lookup[block.words]
        lacks = np.concatenate([[0], np.cumsum(words == 0)])
        known = np.flatnonzero(lacks[block.first + block.size] == lacks[block.first])
        if not len(known):
            continue
        lengths = block.size[known].astype(np.int64)
        low, high = index.search(_rows(words, block.first[known], lengths, length), lengths)
        times = high - low
        which = np.repeat(np.arange(len(known)), times)
        rows = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(low, times)
        at = index.locate(rows)
        np.add.at(covered, at, 1)
        np.add.at(covered, at + lengths[which], -1)
        doc = np.searchsorted(begin, at, side="right") - 1
        for pair in np.unique(doc * len(known) + which):
            window = known[pair % len(known)]
            items[pair // len(known)].update(block.items[k] for k in block.owner[block.bounds[window]:block.bounds[window + 1]])
    hit = np.cumsum(covered[:-1]) > 0
    out: list[list] = [[] for _ in FOUND]
    for k in range(n_docs):
        own = hit[begin[k]: begin[k] + counts[k]]
        names = sorted(items[k])
        n_hit = int(own.sum())
        row = (int(counts[k]), n_hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n_hit > 0, names, _spans(texts[k], own) if n_hit else [])
        for column, value in zip(out, row, strict=True):
            column.append(value)
    return out


def _spans(text: bytes, hit: np.ndarray) -> list[dict]:
    """Runs of hit words, as word numbers and code points [start, stop)."""
    raw = np.frombuffer(text, dtype=np.uint8)
    word = np.concatenate([[False], raw != 0x20, [False]])
    first, stop = np.flatnonzero(word[1:] & ~word[:-1]), np.flatnonzero(word[:-1] & ~word[1:])
    point = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
    edge = np.diff(np.concatenate([[0], hit.astype(np.int8), [0]]))
    return [
        {"first_word": a, "last_word": b, "start": int(point[first[a]]), "stop": int(point[stop[b]])}
        for a, b in zip(np.flatnonzero(edge == 1).tolist(), (np.flatnonzero(edge == -1) - 1).tolist(), strict=True)
    ]


def find_benchmark(docs: DataFrame, text: Column, benchmark: DataFrame, item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns or those to ``keep``) with n_words, n_hit, n_items, items_sha256, contaminated, items and merged removal spans.

    A window is ``window`` consecutive words of an item (a shorter item with words is one window). Documents are read as they lie, in
    shards of whole documents; nothing is shuffled. Items are staged in the shared folder and searched in
    blocks, so neither side has to fit anywhere whole; each worker cuts them into windows once, up to ``KEPT_WORDS``. Null texts, empty texts and texts without words have no hits; null items and items without
    words have no windows; a null item id reads as "null". Repeated rows are judged one by one; repeated item ids count once. An
    input column of an output's name is replaced.
    """
    spark = docs.sparkSession
    folder = new_scratch(spark, "benchmark")
    benchmark.select(
        F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("null")).alias("item"), F.coalesce(F.col(f"`{item_text}`"), F.lit("")).alias("text"),
    ).write.parquet(folder)
    folder = folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"
    return map_rows(docs, text, FOUND, lambda values: _search(values, folder, window), SHARD_BYTES, keep=keep)


def cut_spans(text: Column, spans: Column) -> Column:
    """The text without the code points of the spans (sorted, disjoint)."""
    gaps = lambda s, t: F.concat(
        F.transform(F.sequence(F.lit(0), F.size(s)), lambda k: F.substring(
            t,
            (F.when(k == 0, F.lit(0)).otherwise(F.get(s, k - 1)["stop"]) + 1).cast("int"),
            F.greatest(F.lit(0), F.coalesce(F.get(s, k)["start"], F.length(t)) - F.when(k == 0, F.lit(0)).otherwise(F.get(s, k - 1)["stop"])).cast("int"),
        )),
    )
    return F.when(F.size(spans) > 0, let(spans, lambda s: let(text, lambda t: F.array_join(gaps(s, t), "")))).otherwise(text)

