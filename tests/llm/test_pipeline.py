"""The five stages against a plain program, and all operators on empty tables and clashing columns."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from funnelspark.llm import bpe, decontaminate, langid, licenses, minhash, quality, sanitize, substrings, toxicity, trie, urls, warc, whitening
from funnelspark.llm.queries import tokenizer_path

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans string"
WORDS = [a + b + c for a in ("ka", "lo", "mi", "né", "or", "su") for b in ("ta", "ru", "si", "vo") for c in ("x", "lle", "n", "mmo")]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def made():
    rng = random.Random(8)
    passage = prose(rng, 14)
    texts = {k: prose(rng, rng.randint(70, 120)) for k in range(1, 60)}
    texts[60] = texts[1]
    texts[61] = texts[2].rsplit(" ", 1)[0] + " other"
    texts[62] = texts[61]
    texts[63] = f"{prose(rng, 40)} {passage.capitalize()}, {prose(rng, 40)}"
    texts[64] = f"{prose(rng, 40)} jo@site.example.org und 10.0.0.1 {prose(rng, 40)}"
    texts[65], texts[66], texts[67] = prose(rng, 49), None, ""
    texts[68] = "a b c " * 60
    texts[69] = " ".join(f"w{k}###" for k in range(120))
    texts[70] = prose(rng, 900)
    return texts, passage


def expected_texts(texts, passage):
    """Text of every document that is kept, by id."""
    def repeats(words):
        windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
        often = Counter(windows)
        return len({k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)})

    kept = {}
    for i, text in texts.items():
        words = (text or "").split()
        if len(words) >= 50 and 2 * repeats(words) <= len(words) and i != 69:  # 69 is the planted outlier
            kept[i] = text
    cells = {}
    for i, text in kept.items():
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.lower())
        often = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        cells[i] = {(s, o) for s, n in often.items() for o in range(n)}
    label = {i: i for i in kept}
    for _ in range(4):
        for a in kept:
            for b in kept:
                if len(cells[a] & cells[b]) >= 0.8 * len(cells[a] | cells[b]):
                    label[a] = label[b] = min(label[a], label[b])
    kept = {i: t for i, t in kept.items() if label[i] == i}
    return {i: t.replace("jo@site.example.org", "[EMAIL]").replace("10.0.0.1", "[IP]") for i, t in kept.items()}


def test_pipeline(spark, tmp_path):
    tokenizers, _ = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    texts, passage = made()
    rows = [(i, t, "en", None if i % 2 else "a", None if t is None else len(t), "x", None) for i, t in texts.items()]
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, passage), (2, None), (3, "")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    library = tokenizers.Tokenizer.from_file(tokenizer_path())
    want = expected_texts(texts, passage)
    assert not {60, 61, 62, 65, 66, 67, 68, 69} & set(want) and {1, 2, 63, 64, 70} <= set(want)
    found = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter(r.doc_id for r in found) == Counter(want.keys())
    for r in found:
        if r.doc_id == 63:  # the passage is gone, everything beside it is there
            assert re.findall(r"\w+", r.text) == re.findall(r"\w+", texts[63].replace(passage.capitalize(), ""))
        else:
            assert r.text == want[r.doc_id]
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert b"".join(i.to_bytes(4, "little") for i in ids) == r.ids and r.kept == "x" and r.n_chars == len(r.text)


def test_stages_keep_the_columns(spark, tmp_path):
    docs = spark.createDataFrame([], SCHEMA)
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        made = stage(spark, docs, str(tmp_path))
        assert made.columns == docs.columns and made.count() == 0
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


CLASHING = "doc_id long, text string, label int, row string, value string, node string, at string, host string, base string, x string, r string, score string, n_words string, class_id string"


def everything(docs):
    """Each operator over one table whose other columns have the names of its own."""
    i, t = F.col("doc_id"), F.col("text")
    pages = docs.withColumn("html", F.col("text"))
    yield urls.judge_urls(docs, t), ["host", "verdict"]
    yield quality.judge(docs, t, ["row", "value"]), ["n_words", "kept"]
    yield warc.read_records(warc.write_archives(pages, i, t, F.col("html"))), ["page_id", "record_type"]
    yield licenses.scan(docs, i, t), ["doc_id", "n_words", "score"]
    yield decontaminate.find_benchmark(docs, t, docs.select(F.col("doc_id").alias("item_id"), "text", "node")), ["n_words", "spans"]
    yield substrings.remove_repeats(docs, i, t), ["doc_id", "n_words", "kept_text"]
    yield minhash.near_duplicates(docs, i, t), ["doc_id", "class_id"]
    yield minhash.keep_one(docs, i, t), docs.columns
    yield bpe.encode_texts(docs, t, tokenizer_path()), ["n_tokens", "ids"]
    yield sanitize.find_personal(docs, t), ["n_email", "found"]
    training = toxicity.packed(docs, i, t).join(docs.select("doc_id", "label"), "doc_id")
    yield toxicity.score_texts(docs, t, toxicity.fit(training, t, F.col("label"))), ["doc_id", "score"]
    yield langid.predict(docs, t, langid.fit(docs, t, F.col("base"))), ["doc_id", "lang_pred"]
    yield trie.prefix_trie(docs, i, F.col("label"), F.col("row"), t), ["conv_id", "depth"]
    yield whitening.whiten(docs, F.array(i.cast("double"), F.col("label").cast("double"))), ["doc_id", "whitened"]


def test_empty_tables(spark):
    pytest.importorskip("public_tokenizers")
    for found, columns in everything(spark.createDataFrame([], CLASHING)):
        assert set(columns) <= set(found.columns) and found.count() == 0


def test_nulls_ties_and_clashing_columns(spark):
    pytest.importorskip("public_tokenizers")
    rng = random.Random(3)
    texts = [None, "", " \n", "one", "one", prose(rng, 60), prose(rng, 60), "http://a.example.org/x"]
    rows = [(k % 7, t, k % 2, *["c"] * 11) for k, t in enumerate(texts)] + [(None, prose(rng, 60), None, *[None] * 11), (None, None, None, *[None] * 11)]
    docs = spark.createDataFrame(rows, CLASHING)
    counts = [found.count() for found, _ in everything(docs)]
    assert counts[:7] == [len(rows)] * 7 and counts[8:12] == [len(rows)] * 4 and counts[13] == 2 * (len(rows) - 2)
