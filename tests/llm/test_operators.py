"""Operators against brute force on small tables with nulls, empty texts, ties, repeated rows and clashing columns."""

import hashlib
import json
import math
import os
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from funnelspark.llm import bpe, decontaminate, expected, licenses, minhash, quality, queries, sanitize, substrings, toxicity, urls, warc

TABLES = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_words string"
VOCABULARY = [a + b for a in ("ka", "lo", "mi", "né", "or") for b in ("ta", "ru", "si", "vo", "xe", "ul")]


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = prose(rng, 120)
    out = [(1, base, "en", "a", "x"), (2, base, "en", "a", None), (3, base.replace("kata", "loru", 1), "en", None, "x"), (4, None, None, "a", "x"), (5, "", "en", "a", "x"), (6, " \n\t ", "en", "a", "x"),
           (7, "one two", "en", "a", "x"), (8, "one two", "en", "a", "x"), (9, prose(rng, 4000), "en", "a", "x"), (10, prose(rng, 30) + " " + base[:300], "en", "a", "x"), (11, base, "en", "a", "x"), (11, base, "en", "a", "x")]
    return out + [(k, prose(rng, rng.randint(1, 90)), "en", "b", "x") for k in range(12, 40)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3).cache()


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_near_duplicates(spark, docs, rows):
    def cells(text):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").lower())
        counted = Counter(tuple(words[k:k + 5]) for k in range(max(1, len(words) - 4))) if words else {}
        return {(s, o) for s, n in counted.items() for o in range(n)}

    own = [(i, cells(t)) for i, t, *_ in rows]
    label = {k: k for k in range(len(own))}
    for _ in own:
        for a, (_, x) in enumerate(own):
            for b, (_, y) in enumerate(own[:a]):
                if x and y and len(x & y) >= 0.8 * len(x | y):
                    label[a] = label[b] = min(label[a], label[b])
    want = Counter((own[k][0], min(own[j][0] for j in label if label[j] == label[k])) for k in label)
    found = minhash.near_duplicates(docs, F.col("doc_id"), F.col("text")).collect()
    assert Counter((r.doc_id, r.class_id) for r in found) == want
    kept = minhash.keep_one(docs, F.col("doc_id"), F.col("text"))
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect())
    assert ids == sorted({c for i, c in want} )
    assert minhash.near_duplicates(empty(spark), F.col("doc_id"), F.col("text")).count() == 0


def test_substrings(spark, docs, rows):
    first = {}
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    for i, w in sorted(words):
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k:k + 13]), i)
    want = Counter()
    for i, w in words:
        gone = {j for k in range(len(w) - 12) if first[tuple(w[k:k + 13])] < i for j in range(k, k + 13)}
        want[i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)] += 1
    found = substrings.remove_repeats(docs, F.col("doc_id"), F.col("text")).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in found) == want
    assert substrings.remove_repeats(empty(spark), F.col("doc_id"), F.col("text")).count() == 0


@pytest.mark.parametrize(("block", "kept"), [(1 << 20, 1 << 22), (300, 1 << 22), (300, 600)])
def test_decontamination_blocks(spark, rows, block, kept, monkeypatch, tmp_path):
    """The search itself, in this process, where the sizes of blocks can be set; against a plain search."""
    rng = random.Random(3)
    monkeypatch.setattr(decontaminate, "BLOCK_WORDS", block)
    monkeypatch.setattr(decontaminate, "KEPT_WORDS", kept)
    texts = [r[1] or "" for r in rows]
    items = [(f"i{k}", " ".join(rng.choice(texts).split()[k: k + rng.randint(1, 40)])) for k in range(60)] + [("i3", "Kata, kata"), ("none", " . "), ("far", prose(rng, 200)), ("copy", texts[0])]
    spark.createDataFrame(items, "item string, text string").coalesce(2).write.parquet(f"file://{tmp_path}/items")
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t))
    windows = {}
    for item, text in items:
        words = cut(text)
        for k in range(max(1, len(words) - 9) if words else 0):
            windows.setdefault(tuple(words[k:k + 10]), set()).add(item)
    for again in range(2):
        found = list(zip(*decontaminate._search([t.encode() for t in texts], f"file://{tmp_path}/items", 10), strict=True))
        for text, row in zip(texts, found, strict=True):
            words, hit, names = cut(text), set(), set()
            for size in {len(w) for w in windows}:
                for k in range(len(words) - size + 1):
                    own = windows.get(tuple(words[k:k + size]))
                    if own:
                        hit |= set(range(k, k + size))
                        names |= own
            assert (row[0], row[1], row[5]) == (len(words), len(hit), sorted(names))
        assert bool(decontaminate._KEPT) == (kept > 600)


def test_decontamination(spark, docs, rows):
    items = [(1, " ".join(rows[0][1].split()[20:50])), (2, "ONE two"), (3, None), (4, ""), (None, prose(random.Random(1), 12))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_benchmark(docs, F.col("text"), benchmark).collect()
    got = {(r.doc_id, r.n_hit, tuple(r.items)) for r in found}
    assert (1, 30, ("1",)) in got and (7, 2, ("2",)) in got and (4, 0, ()) in got
    cut = decontaminate.find_benchmark(docs, F.col("text"), benchmark).select("doc_id", decontaminate.cut_spans(F.col("text"), F.col("spans")).alias("text"))
    left = {r.doc_id: r.text for r in cut.collect()}
    assert left[1].split() == rows[0][1].split()[:20] + rows[0][1].split()[50:] and left[4] is None and left[7].strip() == ""
    assert decontaminate.find_benchmark(empty(spark), F.col("text"), benchmark).count() == 0


def test_bpe(spark, docs, rows):
    tokenizers, public = pytest.importorskip("tokenizers"), pytest.importorskip("public_tokenizers")
    path = public.path("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    extra = spark.createDataFrame([(100, "a<|endoftext|>b  's　\x1c\x85 12½ " + "z" * 5000, "en", "a", "x")], SCHEMA)
    for r in bpe.encode_texts(docs.union(extra), F.col("text"), path).join(docs.union(extra).select("doc_id", "text").distinct(), "doc_id").collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids) and b"".join(i.to_bytes(4, "little") for i in ids) == r.ids
        assert r.decoded_sha256 == hashlib.sha256((r.text or "").encode()).hexdigest()


def test_quality(spark, docs, rows):
    junk = spark.createDataFrame([(200, " ".join(f"w{k}###" for k in range(120)), "en", "a", "x")], SCHEMA)
    found = quality.judge(docs.union(junk), F.col("text"), ["lang", "source"]).collect()
    assert len(found) == len(rows) + 1
    for r in found:
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert r.kept == (not r.base_failed and r.doc_id != 200)
    assert quality.judge(empty(spark), F.col("text"), ["lang", "source"]).count() == 0


def test_licenses(spark, docs):
    extra = spark.createDataFrame([(300, "x Licensed under the Apache License, Version 2.0. All RIGHTS reserved, cc-by CC BY", "en", "a", "x"), (301, "cc bKy", "en", "a", "x")], SCHEMA)
    found = {r.doc_id: r for r in licenses.scan(docs.union(extra), F.col("doc_id"), F.col("text")).collect()}
    r = found[300]
    assert (r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) == (3, 9, 14, "cc-by,reserved", "apache,cc-by,reserved", 1.0)
    assert (found[301].n_base, found[4].n_words, found[4].labels) == (0, 0, "")


@pytest.mark.parametrize("most", [1 << 18, 0])
def test_long_license_templates(spark, docs, rows, most, monkeypatch):
    monkeypatch.setattr(licenses, "BROADCAST_PAIRS", most)
    rng = random.Random(9)
    long, phrase = [f"q{rng.randint(0, 150)}" for _ in range(1000)], [f"r{k}" for k in range(150)]
    templates = spark.createDataFrame([(" ".join(long), "long"), (" ".join(long), "long"), ("Kata, kata KATA", "three"), (None, "none"), ("", "none"), ("a b", None)], "text string, label string")
    phrases = spark.createDataFrame([(" ".join(phrase), "exact")], "text string, label string")
    put_in = long[:400] + ["x", "y"] + long[400:]
    texts = {
        400: prose(rng, 20) + " " + " ".join(long).upper(), 401: " ".join(put_in), 402: " ".join(long[:700]), 403: " ".join(long[:800]), 404: " ".join(phrase + phrase), 405: " ".join(phrase[:149]),
        406: " ".join(phrase[:70] + ["x"] + phrase[70:]),
    }
    extra = spark.createDataFrame([(k, t, "en", "a", "x") for k, t in texts.items()], SCHEMA)
    found = {r.doc_id: r for r in licenses.scan(docs.union(extra), F.col("doc_id"), F.col("text"), phrases, templates).collect()}
    label = {k: [x.label for x in found[k].spans or []] for k in texts}
    assert label == {400: ["long"], 401: ["long"], 402: [], 403: ["long"], 404: ["exact", "exact"], 405: [], 406: []}
    assert (found[400].score, found[400].spans[0].first, found[400].spans[0].last) == (1.0, 20, 1019) and abs(found[401].score - 998 / 999) < 1e-9
    assert (found[404].n_base, found[404].first_word, found[404].last_word) == (2, 0, 150) and found[4].labels == ""
    # Templates of two pairs: every document that holds the three words, by a plain search.
    three = {r[0] for r in rows if r[1] and re.search(r"\bkata kata kata\b", r[1])}
    assert {k for k, r in found.items() if "three" in r.labels} >= three
    with pytest.raises(Exception, match="two words or more"):
        licenses.scan(docs, F.col("doc_id"), F.col("text"), {"one": "x"}).count()


def test_personal_data(spark):
    beside = ["alpha", "bravo", "delta", "gamma", "omega"]
    rows = [(k, f"{beside[k]} Zanzibarski wrote to jo@site.example.org today {beside[k]}", "en", "a", "x") for k in range(5)]
    rows += [(9, "é 1.2.3.256 10.0.0.1, 4111 1111 1111 1111 +1 (377) 555-0271 a@b.c%d@e.f", "en", "a", "x"), (10, None, "en", "a", "x"), (11, "1" * 20000, "en", "a", "x")]
    rows += [(20 + k, f"wrote today {beside[k % 5]} something to " + "b" * 50, "en", "a", "x") for k in range(40)]
    found = {r.doc_id: r for r in sanitize.find_personal(spark.createDataFrame(rows, SCHEMA), F.col("text")).withColumn("spans", sanitize.written(F.col("found"))).withColumn("clean", sanitize.generalised(F.col("text"), F.col("found"))).collect()}
    assert found[0].spans == "term:6:17,email:27:46"
    assert found[0].clean == "alpha [TERM] wrote to [EMAIL] today alpha"
    assert found[9].spans == "ip:12:20,card:22:41,phone:42:59,email:60:65,email:65:71"
    assert found[10].spans == "" and found[11].spans == "" and found[20].spans == ""


def personal(spark, texts):
    docs = spark.createDataFrame([(k, t, "en", "a", "x") for k, t in enumerate(texts)], SCHEMA)
    found = sanitize.find_personal(docs, F.col("text")).withColumn("clean", sanitize.generalised(F.col("text"), F.col("found")))
    return {r.doc_id: r.clean for r in found.collect()}


def fill(rng, n, tag):
    """Words of a vocabulary of 900; each passage begins and ends in its own way."""
    return " ".join([f"{tag}a", *(rng.choice(VOCABULARY) + rng.choice(VOCABULARY) for _ in range(n)), f"{tag}b"])


def test_personal_terms_of_whole_texts(spark):
    rng = random.Random(8)
    far = [f"{fill(rng, 9, f'u{k}')} Zanzibarski {fill(rng, 60, f'v{k}')} Zanzibarski {fill(rng, 9, f'w{k}')} jo@site.example.org {fill(rng, 9, f'x{k}')}" for k in range(5)]
    clean = personal(spark, far + [fill(rng, 80, f"y{k}") for k in range(200)])
    for k in range(5):
        assert clean[k] == far[k].replace("Zanzibarski", "[TERM]").replace("jo@site.example.org", "[EMAIL]")


def test_personal_terms_of_rare_entities(spark):
    rng = random.Random(9)
    twice = [f"{fill(rng, 9, f'u{k}')} Zanzibarski {fill(rng, 9, f'v{k}')} 10.20.30.40 {fill(rng, 9, f'x{k}')}" for k in range(2)]
    domain = [f"{fill(rng, 9, f'p{k}')} Quuxcorp {fill(rng, 9, f'q{k}')} p{k}x@quux.example.org {fill(rng, 9, f'r{k}')}" for k in range(4)]
    once = [f"Dear Mrs Oberwasser, {fill(rng, 9, 's')} h.oberwasser@mail.example.org {fill(rng, 9, 't')}"]
    copies = [f"{fill(random.Random(1), 9, 'z')} Plainword 10.20.30.41 {fill(random.Random(1), 9, 'zz')}"] * 3
    texts = twice + domain + once + copies
    clean = personal(spark, texts + [fill(rng, 40, f"y{k}") for k in range(1500)])
    for k in range(2):
        assert clean[k] == twice[k].replace("Zanzibarski", "[TERM]").replace("10.20.30.40", "[IP]")
    for k in range(4):
        assert clean[2 + k] == domain[k].replace("Quuxcorp", "[TERM]").replace(f"p{k}x@quux.example.org", "[EMAIL]")
    assert clean[6] == once[0].replace("Oberwasser", "[TERM]").replace("h.oberwasser@mail.example.org", "[EMAIL]")
    for k in range(7, 10):  # copies are no evidence
        assert clean[k] == texts[k].replace("10.20.30.41", "[IP]")


def test_personal_terms_of_any_form(spark):
    rng = random.Random(10)
    first, last = VOCABULARY[3] * 2, VOCABULARY[7] * 2
    for name in ("李明", "k4", "AC77310", f"{first.title()} {last.title()}"):
        texts = [f"{fill(rng, 9, f'u{k}')} {name} {fill(rng, 9, f'v{k}')} +1 (377) 555-0271 {fill(rng, 9, f'x{k}')}" for k in range(5)]
        # Each word of the pair is common, and they meet nowhere else.
        rest = [f"{fill(rng, 40, f'y{k}')} {(first, last)[k % 2]}" for k in range(400)]
        clean = personal(spark, texts + rest)
        for k in range(5):
            assert clean[k] == texts[k].replace(name, "[TERM]").replace("+1 (377) 555-0271", "[PHONE]")


def test_urls(spark):
    rows = [(1, "http://A.Example.ORG/es/1?x"), (2, "https://example.org/en/12"), (3, "https://example.org/en/2"), (4, "http://x.com/de/"), (5, None), (6, "no scheme casino"), (7, "http://ads-track.net/p"), (8, "http://badads.net/tracks"), (9, "http://q.net?u=://r.org/")]
    found = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), F.col("url")).collect()}
    assert found == {
        1: ("a.example.org", "/es/1", "example.org/es/", "block"), 2: ("example.org", "/en/12", "example.org/en/1", "block"), 3: ("example.org", "/en/2", "org/", "allow"),
        4: ("x.com", "/de/", "com/de/", "block"), 5: ("", "", None, "allow"), 6: ("", "", None, "block"), 7: ("ads-track.net", "/p", None, "block"), 8: ("badads.net", "/tracks", None, "allow"), 9: ("q.net", "", None, "allow"),
    }


def test_url_vocabulary_of_a_table(spark):
    """60,000 terms from a table, many of them parts of others, against a search of every run of letters and digits."""
    rng = random.Random(4)
    names = [f"t{k:x}" for k in range(60000)]
    terms = [(t.upper() if k % 3 == 0 else f" {t} ", None if k % 4 == 0 else 0.5 + k % 3) for k, t in enumerate(names)] + [("t1", 0.1), ("t0", 9.0), (None, 1.0), (" ", None), ("größe", None)]
    words = urls.read_vocabulary(spark.createDataFrame(terms, "term string, weight double"))
    strict, soft = {t for k, t in enumerate(names) if k % 4 == 0}, {t: 0.5 + k % 3 for k, t in enumerate(names) if k % 4}
    assert words.strict == strict | {"größe"} and words.soft == soft
    pages = [(k, "http://h/" + "".join(rng.choice([f"T{rng.randint(0, 70000):x}", "x", "-", "/", "é"]) for _ in range(rng.randint(0, 8)))) for k in range(3000)] + [(5000, "http://h/Größe"), (5001, None)]
    found = {r.page_id: r for r in urls.judge_urls(spark.createDataFrame(pages, "page_id long, url string"), F.col("url"), {}, words).collect()}
    for k, url in pages[:3000]:
        runs = set(re.findall("[a-z0-9]+", url.lower()))
        hard, weak = sorted(runs & strict), sorted(runs & soft.keys())
        weight = sum(soft[t] for t in weak)
        assert (found[k].strict_terms, found[k].soft_terms, found[k].soft_weight) == (hard, weak, weight)
        assert found[k].verdict == ("block" if hard or (len(weak) >= 2 and weight >= 2) else "allow")
    assert found[5000].strict_terms == ["größe"] and found[5001].verdict == "allow"
    assert {r.verdict for r in found.values()} == {"block", "allow"}


def test_warc(spark):
    rows = [(1, "http://a/é b", "<p>x</p>"), (2, None, "<p>x</p>"), (3, "http://c", None), (4, "http://d", ""), (5, "http://e", "é" * 300000)]
    index = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), F.col("page_id"), F.col("url"), F.col("html"), file_bytes=100)
    found = {r.page_id: r for r in warc.read_records(index).collect()}
    assert {k: (r.record_type, r.refers_to, r.payload_bytes) for k, r in found.items()} == {
        1: ("revisit", 2, 8), 2: ("response", None, 8), 3: ("revisit", 4, 0), 4: ("response", None, 0), 5: ("response", None, 600000)}
    assert bytes(found[5].payload).decode() == "é" * 300000 and found[1].payload is None
    assert warc.read_records(index.where("page_id = 5")).count() == 1


def test_toxicity(spark):
    rng = random.Random(2)
    rows = [(k, prose(rng, 40) + (" you scumbag " if k % 3 == 0 else " ") + prose(rng, 40), int(k % 3 == 0)) for k in range(300)]
    docs = spark.createDataFrame([*rows, (900, None, None), (901, "", None)], "doc_id long, text string, label int")
    training = toxicity.packed(docs, F.col("doc_id"), F.col("text")).join(docs.where("doc_id < 200").select("doc_id", "label"), "doc_id")
    found = toxicity.score_texts(docs, F.col("text"), toxicity.fit(training, F.col("text"), F.col("label"))).collect()
    right = [(r.score >= 0.5) == (r.label == 1) for r in found if r.label is not None and r.doc_id >= 200]
    assert sum(right) >= 0.95 * len(right) and all(0 <= r.score <= 1 for r in found)
    nothing = toxicity.fit(training.where("label = 5"), F.col("text"), F.col("label"))
    assert not nothing[0].any()


def plain_grams(text):
    low = " " + "".join(c.lower() if "A" <= c <= "Z" else c for c in text) + " "
    return {low[k:k + n] for n in (3, 4, 5) for k in range(len(low) - n + 1)}


def test_toxicity_features():
    """An n-gram is of code points, whatever their bytes; a text is a set of them."""
    for text in ("", "a", "ABC é", "漢字漢字漢", "x" * 9000, "Ünï𝄞ab " * 700):
        grams = sorted(plain_grams(text))
        found = toxicity.features(text.encode())
        assert found.tolist() == sorted(set(found.tolist())) and 0.98 * len(grams) - 1 <= len(found) <= len(grams)
    # The n-grams of a text are those of its parts, so no byte position matters.
    one = set(toxicity.features("漢字".encode()).tolist())
    assert len(one) == 3 and one != set(toxicity.features("漢学".encode()).tolist())


def test_toxicity_model_by_plain_arithmetic(spark, monkeypatch):
    """Ratios of all rows, the fit on the sample by plain loops, and scores of texts with n-grams outside the sample."""
    monkeypatch.setattr(toxicity, "ROUNDS", 7)
    monkeypatch.setattr(toxicity, "CHUNK", 50)
    rng = random.Random(6)
    rows = [(k, prose(rng, 3 + k % 9) + (" scum" if k % 4 == 0 else ""), int(k % 4 == 0)) for k in range(40)]
    rows += [(100 + k, rows[4][1], 1) for k in range(5)] + [(200, None, 0), (201, "", 1), (202, "other", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    training = toxicity.packed(docs, F.col("doc_id"), F.col("text")).join(docs.select("doc_id", "label"), "doc_id")
    got, bias = toxicity.fit(training, F.col("text"), F.col("label"), sample=6)

    ids = {r[0]: toxicity.features((r[1] or "").encode()).tolist() for r in rows}
    held = {v: Counter(g for i, _, label in rows if label == v for g in ids[i]) for v in (0, 1)}
    share = {v: (1 << 18) + sum(held[v].values()) for v in (0, 1)}
    ratio = lambda g: math.log((1 + held[1][g]) / share[1]) - math.log((1 + held[0][g]) / share[0])
    packed = {r.doc_id: r.h for r in training.select("doc_id", F.xxhash64("text").alias("h")).collect()}
    texts = {v: sorted({packed[i]: ids[i] for i, _, label in rows if label == v}.items()) for v in (0, 1)}
    sample = [(g, 1) for _, g in texts[1][:6]] + [(g, 0) for _, g in texts[0][:12]]
    times = Counter(g for grams, _ in sample for g in grams)
    weight, own_bias, first, second = dict.fromkeys(times, 1.0), 0.0, Counter(), Counter()
    for step in range(1, 8):
        grad, slope = {g: 30.0 * w / len(weight) for g, w in weight.items()}, 0.0
        for grams, label in sample:
            scale = max(1, len(grams)) ** -0.25
            error = (1 / (1 + math.exp(-(sum(weight[g] * ratio(g) for g in grams) * scale + own_bias))) - label) / len(sample)
            slope += error
            for g in grams:
                grad[g] += error * scale * ratio(g)
        for g, x in [*grad.items(), ("bias", slope)]:
            first[g], second[g] = 0.9 * first[g] + 0.1 * x, 0.999 * second[g] + 0.001 * x * x
            move = 0.05 * (first[g] / (1 - 0.9**step)) / (math.sqrt(second[g] / (1 - 0.999**step)) + 1e-9)
            if g == "bias":
                own_bias -= move
            else:
                weight[g] -= move
    shared = sum(weight[g] * n for g, n in times.items()) / sum(times.values())
    assert abs(bias - own_bias) < 1e-9
    for text in ["kata scum", "zzz unseen", "", *(r[1] or "" for r in rows[:9])]:
        grams = toxicity.features(text.encode()).tolist()
        z = sum(weight.get(g, shared) * ratio(g) for g in grams) * max(1, len(grams)) ** -0.25 + own_bias
        score = toxicity.score_texts(spark.createDataFrame([(text,)], "text string"), F.col("text"), (got, bias)).first().score
        assert abs(score - 1 / (1 + math.exp(-z))) < 1e-5


@pytest.mark.skipif(not os.path.isdir(TABLES), reason="test tables absent")
@pytest.mark.parametrize("name", list(expected.statements()))
def test_query_equals_its_sql(spark, name):
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{TABLES}/{t}.parquet'")
    found = queries.registered()[name](spark, TABLES)
    want = con.execute(expected.statements()[name])
    order = [[c[0] for c in want.description].index(c) for c in found.columns]
    assert Counter(map(tuple, found.collect())) == Counter(tuple(r[k] for k in order) for r in want.fetchall())


def test_pieces_of_near_and_far_texts():
    """Texts without far code points are cut by a smaller pattern, into the same pieces."""
    anywhere, near = bpe.piece_pattern().findall, bpe.piece_pattern(0x10000).findall
    for text in ("it's 12 o'clock,\tnow!\n\n  end ", "Größe \u3000\u4e2d\u6587 \u0661\u0662 \u2028x \uffff\ue000", "", " \u00a0a"):
        assert near(text) == anywhere(text)
    assert anywhere("a \U00020000\U0001d7ce x") == ["a", " \U00020000", "\U0001d7ce", " x"]


def test_bpe_keeps_few_pieces_and_those_in_use(monkeypatch):
    # An idle worker keeps them beside what its executor does next: some 200 bytes a piece, 170 a neighbour test.
    assert bpe.KEPT_PIECES * 200 + bpe.KEPT_PAIRS * 170 <= 100 << 20
    with open(queries.tokenizer_path(), encoding="utf-8") as file:
        definition = json.load(file)
    texts = [f"often w{k} x{k * k} often" for k in range(200)]
    whole = bpe.PrefixEncoder(definition)
    expected_ids = [whole.encode(t) for t in texts]
    monkeypatch.setattr(bpe, "KEPT_PIECES", 16)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 16)
    small, made = bpe.PrefixEncoder(definition), []
    packed = small._packed
    small._packed = lambda piece: made.append(piece) or packed(piece)
    assert [small.encode(t) for t in texts] == expected_ids
    assert made.count("often") == made.count(" often") == 1
    assert max(map(len, (small.pieces, small.old_pieces, small.pairs, small.old_pairs))) <= 8
