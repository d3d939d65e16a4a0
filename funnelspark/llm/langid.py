"""Language of words in code-switched text by a linear-chain conditional random field, and of texts by its words.

A word's features are its character n-grams, its affixes and the whole word, hashed, and the logarithms of its shares in a lexicon that is counted
over all labelled texts. Transitions between the languages of neighbouring words are learned along with them, from passages of sampled texts spliced
so that the language changes within. Labels of words come from forward-backward over whole texts: segments are scanned side by side and
linked by their transfer matrices, which is exact.
"""

from __future__ import annotations

import functools
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.llm.common import as_bytes, map_rows, mixed
from funnelspark.session import write_stage

#: Hashed features, and n-grams within a word (characters); affixes up to the longest of them.
BITS, GRAMS, AFFIXES = 18, (2, 3, 4), (1, 2, 3)
#: Bound of the sample the field is fitted on: texts per language (those of the smallest hashes), and the words of the passage taken from each.
SAMPLE, PASSAGE = 500, 60
#: Training sequences per language, their words, and the rounds, step and penalty of the fit.
SEQUENCES, LENGTH, ROUNDS, RATE, PENALTY = 400, 40, 40, 0.5, 1e-5
#: Code points whose features are worked out together, and words of a segment.
PIECE, SEGMENT = 1 << 21, 256
UNKNOWN = "und"
#: Scripts without blanks between words (fixed values): each character counts as a word.
SINGLE = [(0x3040, 0x30FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0x0E00, 0x0E7F), (0x20000, 0x323AF)]

RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
_STEP = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _characters() -> tuple[np.ndarray, np.ndarray]:
    """For every code point: its lower case if that is one code point, and 1 if it is a letter, 2 if it is a word by itself."""
    lower, kind = np.arange(sys.maxunicode + 1, dtype=np.uint32), np.zeros(sys.maxunicode + 1, dtype=np.uint8)
    for c in range(sys.maxunicode + 1):
        x = chr(c)
        if x.isalpha():
            kind[c] = 1
            y = x.lower()
            if len(y) == 1:
                lower[c] = ord(y)
    for low, high in SINGLE:
        kind[low:high + 1] *= 2
    return lower, kind


def code_points(text: bytes) -> np.ndarray:
    return np.frombuffer(text.decode("utf-8", "replace").encode("utf-32-le", "surrogatepass"), dtype=np.uint32)


class Words:
    """The words of a piece of text: their starts and stops in code points, and their hashed features."""

    def __init__(self, points: np.ndarray):
        lower, kind = _characters()
        kinds = kind[points]
        at = np.flatnonzero(kinds)
        own, kinds = lower[points[at]].astype(np.uint64), kinds[at]
        # A word begins after anything that is no letter, and at and after a single one.
        begins = np.ones(len(at), dtype=bool)
        begins[1:] = (at[1:] != at[:-1] + 1) | (kinds[1:] == 2) | (kinds[:-1] == 2)
        self.first = np.flatnonzero(begins)
        self.count = len(self.first)
        self.lengths = np.diff(np.append(self.first, len(at)))
        self.starts, self.stops = at[self.first], at[self.first] + self.lengths
        self.word = np.repeat(np.arange(self.count, dtype=np.int64), self.lengths)
        self.place = np.arange(len(at)) - self.first[self.word]
        self.own = own

    def only(self, chosen: np.ndarray) -> Words:
        """Some of the words, in the order of ``chosen``; places in the text are not kept."""
        some = object.__new__(Words)
        some.count, some.lengths = len(chosen), self.lengths[chosen]
        some.first = np.cumsum(some.lengths) - some.lengths
        some.word = np.repeat(np.arange(some.count, dtype=np.int64), some.lengths)
        some.place = np.arange(len(some.word)) - some.first[some.word]
        some.own = self.own[self.first[chosen][some.word] + some.place]
        return some

    def whole(self) -> np.ndarray:
        """A 64-bit hash per word."""
        if not self.count:
            return np.zeros(0, dtype=np.uint64)
        return mixed(np.add.reduceat(mixed(self.own + self.place.astype(np.uint64) * _STEP), self.first) + self.lengths.astype(np.uint64))

    def features(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Kinds of features one after the other: (words in order, slot of each)."""
        def slots(h: np.ndarray, salt: int) -> np.ndarray:
            return (mixed(h + np.uint64(salt * int(_STEP) % (1 << 64))) >> np.uint64(64 - BITS)).astype(np.int64)

        last = np.repeat(self.lengths, self.lengths) - 1 - self.place
        gram = self.own
        for n in range(1, max(*GRAMS, *AFFIXES) + 1):
            if n > 1:
                # Of a run that reaches back into another word nothing is used.
                gram = np.concatenate([np.zeros(1, dtype=np.uint64), gram[:-1]]) * np.uint64(0x100000001B3) + self.own
            if n in GRAMS:
                some = np.flatnonzero(self.place >= n - 1)
                yield self.word[some], slots(gram[some], n)
            if n in AFFIXES:
                for salt, some in ((10, np.flatnonzero(self.place == n - 1)), (20, np.flatnonzero((last == 0) & (self.place >= n - 1)))):
                    yield self.word[some], slots(gram[some], salt + n)
        yield np.arange(self.count), slots(self.whole(), 30)


def lexicon_slots(whole: np.ndarray) -> np.ndarray:
    return (whole >> np.uint64(64 - BITS)).astype(np.int64)


class Field:
    """Languages and weights: per feature slot and language, per lexicon slot and language, of transitions (from, to) and first words."""

    def __init__(self, languages: list[str], lexicon: np.ndarray):
        k = len(languages)
        self.languages, self.lexicon = languages, lexicon
        self.weights, self.trust = np.zeros((1 << BITS, k), dtype=np.float32), 1.0
        self.moves, self.opening = np.zeros((k, k)), np.zeros(k)

    def emissions(self, words: Words) -> np.ndarray:
        """Scores of every language (rows) at every word. Words that come again are worked out once."""
        whole = words.whole()
        _, chosen, again = np.unique(whole, return_index=True, return_inverse=True)
        some, tables = words.only(chosen), [np.ascontiguousarray(w) for w in self.weights.T]
        out = self.lexicon[lexicon_slots(whole[chosen])].T.astype(np.float64) * self.trust
        for word, slot in some.features():
            if len(word):
                cut = np.flatnonzero(np.append(True, word[1:] != word[:-1]))
                at = word[cut]
                for j, table in enumerate(tables):
                    scores = table[slot]
                    out[j, at] += scores if len(cut) == len(scores) else np.add.reduceat(scores, cut)
        return out[:, again]

    def of_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Scores of all words of some texts, one column a word, and the number of words of each; long texts are cut between words."""
        found, counts, pending, size = [], [], [], 0

        def flush() -> None:
            nonlocal pending, size
            if pending:
                # A blank between the pieces.
                joined = np.concatenate([np.append(p, np.uint32(32)) for _, p in pending])
                words = Words(joined)
                found.append(self.emissions(words))
                per = np.diff(np.searchsorted(words.starts, np.cumsum([0] + [len(p) + 1 for _, p in pending])))
                for (k, _), n in zip(pending, per):
                    counts[k] += int(n)
            pending, size = [], 0

        for k, text in enumerate(texts):
            counts.append(0)
            for piece in _pieces(code_points(text)):
                if size + len(piece) > PIECE:
                    flush()
                pending.append((k, piece))
                size += len(piece)
        flush()
        return (np.concatenate(found, axis=1) if found else np.zeros((len(self.languages), 0))), np.array(counts, dtype=np.int64)


def _pieces(points: np.ndarray) -> Iterator[np.ndarray]:
    """Pieces of at most PIECE code points that end behind something that is no letter; a longer run of letters is a piece."""
    low, kind = 0, _characters()[1]
    while len(points) - low > PIECE:
        blank = np.flatnonzero(kind[points[low:low + PIECE]] == 0)
        high = low + int(blank[-1]) + 1 if len(blank) else low + PIECE
        if not len(blank):
            while high < len(points) and kind[points[high]]:
                high += 1
        yield points[low:high]
        low = high
    yield points[low:]


def marginals(emissions: np.ndarray, counts: np.ndarray, moves: np.ndarray, opening: np.ndarray, segment: int = SEGMENT) -> np.ndarray:
    """Probability of each language (rows) at each word, by forward-backward over each text.

    Texts are cut into segments of at most ``segment`` words that are scanned side by side: first their transfer matrices, which give the messages at the
    borders, then forward and backward within.
    """
    k, total = emissions.shape
    if not total:
        return np.zeros((k, 0))
    step, begin = np.exp(moves - moves.max()), np.exp(opening - opening.max())
    # Segments: text, place in it, start, length; texts without words have none. Long ones first, so that those still running are always the first ones.
    per = -(-counts // segment)
    text = np.repeat(np.arange(len(counts)), per)
    rank = np.arange(len(text)) - np.repeat(np.cumsum(per) - per, per)
    length = np.minimum(segment, np.repeat(counts, per) - rank * segment)
    order = np.argsort(-length, kind="stable")
    start = (np.repeat(np.cumsum(counts) - counts, per) + rank * segment)[order]
    text, rank, length = text[order], rank[order], length[order]
    n, longest = len(start), int(length[0])
    alive = [int(np.searchsorted(-length, -t, side="left")) for t in range(longest)]
    # Scores by step; what lies beyond a segment's end is not used.
    own = np.take(np.exp(emissions - emissions.max(axis=0)), np.minimum(start + np.arange(longest)[:, None], total - 1), axis=1)

    inward, outward = np.repeat(begin[:, None], n, axis=1), np.ones((k, n))
    many = np.flatnonzero(per[text] > 1)
    if len(many):
        # Row i of a transfer: from language i before the segment to each of its last word; the row behind them scans a text's first segment from the opening.
        transfer = np.repeat(np.vstack([step, begin])[:, :, None], len(many), axis=2) * own[:, 0, many][None]
        for t in range(1, longest):
            m = int(np.searchsorted(many, alive[t]))
            moved = np.matmul(step.T, transfer[:, :, :m]) * own[:, t, many[:m]]
            # The rows of one segment by one factor; the opening's row by its own.
            transfer[:k, :, :m] = moved[:k] / moved[:k].sum(axis=(0, 1))
            transfer[k, :, :m] = _scaled(moved[k])
        place = np.zeros(n, dtype=np.int64)
        place[many] = np.arange(len(many))
        by_rank = [many[rank[many] == r] for r in range(int(rank.max()) + 1)]
        last, back = np.ones((k, len(counts))), np.ones((k, len(counts)))
        for r, some in enumerate(by_rank):
            if r:
                before = last[:, text[some]]
                inward[:, some] = step.T @ before
                last[:, text[some]] = _scaled(np.einsum("in,ijn->jn", before, transfer[:k][:, :, place[some]]))
            else:
                last[:, text[some]] = _scaled(transfer[k][:, place[some]])
        for some in reversed(by_rank):
            outward[:, some] = back[:, text[some]]
            back[:, text[some]] = _scaled(np.einsum("ijn,jn->in", transfer[:k][:, :, place[some]], outward[:, some]))
    forward = np.empty((k, longest, n))
    now = inward
    for t, m in enumerate(alive):
        now = _scaled((step.T @ now[:, :m] if t else now) * own[:, t, :m])
        forward[:, t, :m] = now
    message = outward
    for t in range(longest - 1, -1, -1):
        m = alive[t]
        forward[:, t, :m] *= message[:, :m]
        message[:, :m] = _scaled(step @ (message[:, :m] * own[:, t, :m]))
    out = np.empty((k, total))
    held = np.arange(longest)[:, None] < length
    out[:, (start + np.arange(longest)[:, None])[held]] = forward[:, held]
    return _scaled(out)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.sum(axis=0)


# ── Fitting ──


def _learned(batches: Iterator[pa.RecordBatch], languages: list[str]) -> Iterator[pa.RecordBatch]:
    """How many texts of each language hold each word, by lexicon slots, summed over a task."""
    number, held = {x: k for k, x in enumerate(languages)}, np.zeros((1 << BITS, len(languages)), dtype=np.int64)
    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), as_bytes(batch.column("text")), strict=True):
            slots = [lexicon_slots(Words(piece).whole()) for piece in _pieces(code_points(text))]
            held[np.unique(np.concatenate(slots)), number[lang]] += 1
    slot, lang = np.nonzero(held)
    yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(lang), pa.array(held[slot, lang])], names=["slot", "language", "n"])


def _passages(batches: Iterator[pa.RecordBatch], words: int) -> Iterator[pa.RecordBatch]:
    """A passage of each text, from a place that its own hash names."""
    for batch in batches:
        out = []
        for text, at in zip(as_bytes(batch.column("text")), batch.column("hash").to_pylist(), strict=True):
            points = code_points(text)
            found = Words(points)
            low = int(at) % max(1, found.count - words + 1)
            some = slice(low, low + words)
            out.append([points[a:b].tobytes().decode("utf-32-le", "surrogatepass") for a, b in zip(found.starts[some], found.stops[some])])
        yield pa.RecordBatch.from_arrays([batch.column("lang"), pa.array(out, pa.list_(pa.string()))], names=["lang", "words"])


def fit(training: DataFrame, text: Column, lang: Column, sample: int = SAMPLE) -> Field:
    """The field of all languages that some training text with a letter has; rows without a language teach nothing.

    The lexicon counts all texts and reaches the driver as at most 2^18 counts per language. Weights and transitions are fitted on at most ``sample`` texts
    of each language (those of the smallest hashes), a passage of PASSAGE words each.
    """
    rows = write_stage(training.select(lang.cast("string").alias("lang"), text.cast("string").alias("text")).where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")), "training")
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    if not languages:
        return Field([], np.zeros((1 << BITS, 0), dtype=np.float32))
    counted = rows.mapInArrow(functools.partial(_learned, languages=languages), "slot long, language long, n long").groupBy("slot", "language").agg(F.sum("n").alias("n")).toArrow()
    held = np.zeros((1 << BITS, len(languages)))
    held[counted.column("slot").to_numpy(), counted.column("language").to_numpy()] = counted.column("n").to_numpy()
    texts = np.zeros(len(languages))
    for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect():
        texts[languages.index(r["lang"])] = r["n"]
    # Smoothed shares of texts with the word; a word that no text has tells nothing.
    share = np.log((held + 0.5) / (texts + 1))
    share[held.sum(axis=1) == 0] = 0
    field = Field(languages, (share - share.mean(axis=1, keepdims=True)).astype(np.float32))

    hashed = rows.withColumn("hash", F.xxhash64("text"))
    chosen = hashed.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy("hash", "text"))).where(F.col("rank") <= sample).drop("rank")
    passages: list[list[list[str]]] = [[] for _ in languages]
    found = chosen.withColumn("hash", F.crc32(F.col("text").cast("binary"))).mapInArrow(functools.partial(_passages, words=PASSAGE), "lang string, words array<string>").collect()
    for r in sorted(found, key=lambda r: (r["lang"], r["words"])):
        if r["words"]:
            passages[languages.index(r["lang"])].append(r["words"])
    texts, labels = _spliced(passages)
    if texts:
        _train(field, texts, labels)
    return field


def _spliced(passages: list[list[list[str]]]) -> tuple[list[bytes], list[np.ndarray]]:
    """Training sequences of one to three pieces of passages, and the language of each word."""
    rng = np.random.default_rng(7)
    texts, labels = [], []
    some = [lang for lang, p in enumerate(passages) if p]
    for lang in some:
        for _ in range(SEQUENCES):
            parts = [lang, *rng.choice(some, size=rng.integers(0, 3))]
            cuts = np.sort(rng.integers(1, LENGTH, size=len(parts) - 1))
            words, label = [], []
            for part, room in zip(parts, np.diff(np.concatenate([[0], cuts, [LENGTH]]))):
                passage = passages[part][rng.integers(len(passages[part]))]
                low = int(rng.integers(max(1, len(passage) - room + 1)))
                piece = passage[low:low + room]
                words, label = words + piece, label + [part] * len(piece)
            texts.append(" ".join(words).encode())
            labels.append(np.array(label, dtype=np.int64))
    return texts, labels


def _train(field: Field, texts: list[bytes], labels: list[np.ndarray]) -> None:
    """Adagrad on the mean log-likelihood of the label sequences; gradients are label minus marginal."""
    k = len(field.languages)
    points = [code_points(t) for t in texts]
    words = Words(np.concatenate([np.append(p, np.uint32(32)) for p in points]))
    counts = np.array([len(x) for x in labels])
    every = list(words.features())
    word, slot = np.concatenate([w for w, _ in every]), np.concatenate([s for _, s in every])
    used, column = np.unique(slot, return_inverse=True)
    label = np.concatenate(labels)
    target = np.zeros((len(label), k))
    target[np.arange(len(label)), label] = 1
    lexical = field.lexicon[lexicon_slots(words.whole())].astype(np.float64)
    start = np.cumsum(counts) - counts
    inner = np.setdiff1d(np.arange(len(label)), start)
    weights, trust, moves, opening = np.zeros((len(used), k)), 1.0, np.zeros((k, k)), np.zeros(k)
    past = [np.full(s, 1e-8) for s in ((len(used), k), (), (k, k), (k,))]
    n = len(label)
    for _ in range(ROUNDS):
        emissions = lexical * trust + np.stack([np.bincount(word, weights=weights[column, j], minlength=n) for j in range(k)], axis=1)
        guess, pairs = _expected(emissions, counts, moves, opening, inner)
        error = target - guess
        seen = np.zeros((k, k))
        np.add.at(seen, (label[inner - 1], label[inner]), 1)
        grads = [
            np.stack([np.bincount(column, weights=error[word, j], minlength=len(used)) for j in range(k)], axis=1) / n - PENALTY * weights,
            (error * lexical).sum() / n - PENALTY * trust, (seen - pairs) / n - PENALTY * moves, error[start].sum(axis=0) / n - PENALTY * opening,
        ]
        past = [p + g * g for p, g in zip(past, grads)]
        weights, trust, moves, opening = (v + RATE * g / np.sqrt(p) for v, g, p in zip((weights, trust, moves, opening), grads, past))
    field.weights[used] = weights
    field.trust, field.moves, field.opening = float(trust), moves, opening


def _expected(emissions: np.ndarray, counts: np.ndarray, moves: np.ndarray, opening: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals, and the expected number of moves between languages.

    The probability of a pair of neighbours is that of the first times its move times what the second gains over its prediction; from marginals alone it is
    taken by scanning the sequences, all at once.
    """
    k = emissions.shape[1]
    own = np.exp(emissions - emissions.max(axis=1, keepdims=True))
    step, begin = np.exp(moves), np.exp(opening - opening.max())
    start, longest = np.cumsum(counts) - counts, int(counts.max())
    order = np.argsort(-counts, kind="stable")
    start, counts = start[order], counts[order]
    forward, backward = np.zeros_like(own), np.ones_like(own)
    alive = [int(np.searchsorted(-counts, -t, side="left")) for t in range(longest)]
    for t, m in enumerate(alive):
        now = own[start[:m] + t] * (begin if t == 0 else forward[start[:m] + t - 1] @ step)
        forward[start[:m] + t] = now / now.sum(axis=1, keepdims=True)
    for t in range(longest - 1, 0, -1):
        m = alive[t]
        now = (backward[start[:m] + t] * own[start[:m] + t]) @ step.T
        backward[start[:m] + t - 1] = now / now.sum(axis=1, keepdims=True)
    guess = forward * backward
    guess /= guess.sum(axis=1, keepdims=True)
    joint = forward[inner - 1][:, :, None] * step[None] * (own[inner] * backward[inner])[:, None, :]
    pairs = (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0) if len(inner) else np.zeros((k, k))
    return guess, pairs


# ── Labelling ──


def label_words(text: str, field: Field) -> list[tuple[int, int, str, float]]:
    """Words of one text: start and stop in code points, language and its probability."""
    points = code_points(text.encode())
    words = Words(points)
    sure = marginals(field.emissions(words), np.array([words.count]), field.moves, field.opening)
    best = sure.argmax(axis=0) if words.count else []
    return [(int(a), int(b), field.languages[j], float(p[j])) for a, b, j, p in zip(words.starts, words.stops, best, sure.T)]


def predict(docs: DataFrame, text: Column, field: Field, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns or those to ``keep``) with lang_pred, the language most words of the text are expected to be in, and score, their expected share.

    Null texts and texts without a letter (Unicode category L), and all texts if nothing was learned, are UNKNOWN with score 0. Every word of a text counts, however long it is.
    Equal shares go to the first language by name. Repeated rows are each judged. An input column of an output's name is replaced. The field is 2 MB per language.
    """
    def run(values: list[bytes]) -> list[list]:
        if not field.languages:
            return [[UNKNOWN] * len(values), [0.0] * len(values)]
        emissions, counts = field.of_texts(values)
        sure = marginals(emissions, counts, field.moves, field.opening)
        share = np.zeros((len(values), len(field.languages)))
        if (some := np.flatnonzero(counts)).size:
            share[some] = (np.add.reduceat(sure, (np.cumsum(counts) - counts)[some], axis=1) / counts[some]).T
        best = share.argmax(axis=1)
        return [
            [field.languages[j] if n else UNKNOWN for j, n in zip(best, counts)],
            [float(min(1.0, max(0.0, s[j]))) if n else 0.0 for s, j, n in zip(share, best, counts)],
        ]

    return map_rows(docs, text, RESULT, run, max_bytes=1 << 22, keep=keep)
