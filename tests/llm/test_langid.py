"""The language field against log-space forward-backward, plain feature lists, and held-out labels."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from funnelspark.llm import langid
from funnelspark.llm.langid import Field, Words, code_points

SCHEMA = "doc_id long, text string, lang string, score string"
SYLLABLES = {"xx": ["ka", "lo", "mi", "né"], "yy": ["ter", "sch", "ung", "lo"], "zz": ["漢", "字", "日", "本"]}


def prose(rng, lang, n):
    if lang == "zz":
        return "".join(rng.choice(SYLLABLES[lang]) for _ in range(n))
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 4))).title() for _ in range(n))


def plain_marginals(e, moves, opening):
    f, b = np.zeros_like(e), np.zeros_like(e)
    f[0] = opening + e[0]
    for t in range(1, len(e)):
        f[t] = np.logaddexp.reduce(f[t - 1][:, None] + moves, axis=0) + e[t]
    for t in range(len(e) - 2, -1, -1):
        b[t] = np.logaddexp.reduce(moves + e[t + 1] + b[t + 1], axis=1)
    g = f + b
    return np.exp(g - np.logaddexp.reduce(g, axis=1)[:, None])


@pytest.mark.parametrize("segment", [1, 2, 5, 256])
@pytest.mark.parametrize("k", [1, 3])
def test_marginals(segment, k):
    rng = np.random.default_rng(k)
    counts = np.array([0, 1, 7, 3, 20, 0, 64, 1])
    e, moves, opening = rng.standard_normal((counts.sum(), k)) * 3, rng.standard_normal((k, k)) * 2, rng.standard_normal(k)
    want = np.concatenate([plain_marginals(e[s - c:s], moves, opening) for c, s in zip(counts, np.cumsum(counts)) if c])
    assert np.allclose(langid.marginals(e.T, counts, moves, opening, segment).T, want, atol=1e-12)
    inner = np.setdiff1d(np.arange(counts.sum()), np.cumsum(counts) - counts)
    some = counts[counts > 0]
    guess, pairs = langid._expected(e, some, moves, opening, inner)
    assert np.allclose(guess, want, atol=1e-12) and np.isclose(pairs.sum(), len(inner))
    assert langid.marginals(np.zeros((k, 0)), np.array([0, 0]), moves, opening).shape == (k, 0)


def test_words():
    text = "Hello wörld, c'est 中文字! ½ x² _İst9a"
    found = Words(code_points(text.encode()))
    assert [text[a:b] for a, b in zip(found.starts, found.stops)] == ["Hello", "wörld", "c", "est", "中", "文", "字", "x", "İst", "a"]
    alone = [Words(code_points(text[a:b].encode())) for a, b in zip(found.starts, found.stops)]
    assert found.whole().tolist() == [w.whole()[0] for w in alone]
    # The features of a word do not depend on its neighbours, and case is folded.
    gathered = [sorted((j, int(s)) for j, (w, slots) in enumerate(found.features()) for x, s in zip(w, slots) if x == k) for k in range(found.count)]
    assert gathered == [sorted((j, int(s)) for j, (w, slots) in enumerate(a.features()) for s in slots) for a in alone]
    assert Words(code_points(b"HELLO")).whole().tolist() == Words(code_points(b"hello")).whole().tolist()
    # n-grams of 2 to 4, prefixes and suffixes of 1 to 3, the word
    assert len(gathered[0]) == 4 + 3 + 2 + 6 + 1 and len(gathered[2]) == 3


def test_pieces(monkeypatch):
    """Long texts are cut between words; nothing changes."""
    rng = random.Random(3)
    field = Field(["xx", "yy"], np.random.default_rng(1).standard_normal((1 << langid.BITS, 2)).astype(np.float32))
    field.weights[:] = np.random.default_rng(2).standard_normal(field.weights.shape)
    texts = [prose(rng, "xx", 90).encode(), b"", b"a" * 400, ("z" * 50 + " é " * 30 + "漢字" * 40).encode(), b" " * 300, prose(rng, "yy", 3).encode()]
    want, counts = field.of_texts(texts)
    monkeypatch.setattr(langid, "PIECE", 64)
    got, again = field.of_texts(texts)
    assert np.allclose(got, want) and again.tolist() == counts.tolist() == [Words(code_points(t)).count for t in texts]


def test_languages(spark):
    rng = random.Random(1)
    rows = [(k, prose(rng, "xyz"[k % 3] * 2, rng.choice([4, 30, 200])), "xyz"[k % 3] * 2, "x") for k in range(240)]
    switched = " ".join([prose(rng, "xx", 25), prose(rng, "yy", 60), prose(rng, "zz", 20)])
    odd = [(901, None, "xx", "x"), (902, "", "xx", "x"), (903, " 12 \n ½ ", "yy", "x"), (904, switched, None, "x"), (None, rows[0][1], None, "x"), (905, prose(rng, "yy", 60000), None, "x"), (1, rows[1][1], "yy", None)]
    docs = spark.createDataFrame(rows + odd, SCHEMA).repartition(4)
    out = zlib.crc32
    field = langid.fit(docs.where("doc_id is null or crc32(cast(doc_id as string)) % 3 != 1"), F.col("text"), F.col("lang"))
    assert field.languages == ["xx", "yy", "zz"] and (np.diag(field.moves) > field.moves.max(axis=1) - 1e-9).all()
    found = langid.predict(docs, F.col("text"), field, keep=["doc_id", "lang", "score"]).collect()
    assert len(found) == len(rows) + len(odd) and all(0 <= r.score <= 1 for r in found)
    held = [r for r in found if r.doc_id is not None and r.doc_id < 900 and out(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.99 * len(held) > 50
    by_id = {r.doc_id: r for r in found}
    assert [(by_id[k].lang_pred, by_id[k].score) for k in (901, 902, 903)] == [("und", 0.0)] * 3
    assert by_id[904].lang_pred == by_id[905].lang_pred == "yy" and by_id[None].lang_pred == "xx"
    # Words of switched text: each part in its own language.
    words = langid.label_words(switched, field)
    right = sum(label == ("xx" if k < 25 else "yy" if k < 85 else "zz") for k, (*_, label, _) in enumerate(words))
    assert len(words) == 105 and right >= 100


def test_nothing_learned(spark):
    docs = spark.createDataFrame([(1, "some words", None, "x"), (2, "12", "xx", "x"), (3, None, "yy", "x")], SCHEMA)
    field = langid.fit(docs, F.col("text"), F.col("lang"))
    assert field.languages == [] and {(r.lang_pred, r.score) for r in langid.predict(docs, F.col("text"), field).collect()} == {("und", 0.0)}
    one = langid.fit(spark.createDataFrame([(1, "some words", "xx", "x")], SCHEMA), F.col("text"), F.col("lang"))
    assert [r.lang_pred for r in langid.predict(docs, F.col("text"), one).orderBy("doc_id").collect()] == ["xx", "und", "und"]
    empty = spark.createDataFrame([], SCHEMA)
    assert langid.predict(empty, F.col("text"), langid.fit(empty, F.col("text"), F.col("lang"))).count() == 0
