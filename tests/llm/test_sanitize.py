"""Personal data against plain programs: base spans by the patterns as they stand, terms by counting, long texts by the clock."""

import hashlib
import math
import random
import time
from collections import Counter, defaultdict

import pytest
import regex
from pyspark.sql import functions as F

from funnelspark.llm import sanitize

PATTERNS = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
]


def valid(kind, value):
    digits = [int(c) for c in value if c.isdigit()]
    if kind == "ip":
        return all(int(p) <= 255 for p in value.split("."))
    if kind == "card":
        doubled = [d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits))]
        return 14 <= len(digits) <= 19 and sum(doubled) % 10 == 0
    return kind == "email" or 10 <= len(digits) <= 15


def base(text):
    """(start, kind number, stop, value), sorted."""
    return sorted((m.start(), k, m.end(), m.group()) for k, (kind, pattern) in enumerate(PATTERNS) for m in regex.finditer(pattern, text or "", regex.ASCII) if valid(kind, m.group()))


def odd_text(rng):
    parts = ["@", ".", "+", "1", "12", "255", "256", "7.", "é", "漢", "𝄞", " ", "-", "a@b.c", "%x", "(", ")", "4111 1111 1111 1111", "+1 (377) 555-0271", "10.0.0.1", "\n", "..", "0000", "a_b", "@@"]
    return "".join(rng.choice(parts) for _ in range(rng.randint(0, 40)))


def test_base_columns(spark):
    rng = random.Random(12)
    texts = [None, "", *[odd_text(rng) for _ in range(1500)], " ".join(odd_text(rng) for _ in range(400))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    found = sanitize.find_personal(docs, F.col("text")).select(
        "doc_id", *[f"n_{k}" for k in sanitize.KINDS], F.sha2(sanitize.written(F.col("found"), base_only=True), 256).alias("sha"), sanitize.written(F.col("found"), base_only=True).alias("spans")).collect()
    assert len(found) == len(texts)
    for r in found:
        want = base(texts[r.doc_id])
        written = ",".join(f"{PATTERNS[k][0]}:{a}:{b}" for a, k, b, _ in want)
        assert r.spans == written and r.sha == hashlib.sha256(written.encode()).hexdigest()
        assert [r[f"n_{kind}"] for kind in sanitize.KINDS] == [sum(k == j for _, j, _, _ in want) for k in range(4)]


def judged(texts, share=sanitize.DISCLOSED, doubt=sanitize.DOUBT):
    """Terms to mark in each text, by counting everything with everything."""
    word = r"[\p{L}\p{M}\p{N}]+"
    tokens, held, terms, total_words = {}, {}, {}, 0
    for i, text in enumerate(texts):
        spans, blanked = base(text), list(text)
        total_words += len(regex.findall(word, text))
        for a, _, b, _ in spans:
            blanked[a:b] = "\x01" * (b - a)
        tokens[i] = regex.findall(word + "|\x01+", "".join(blanked).lower())
        pairs = [f"{x} {y}" for x, y in zip(tokens[i], tokens[i][1:])]
        terms[i] = {t for t in tokens[i] + pairs if "\x01" not in t}
        held[i] = {}
        for a, k, b, value in spans:
            context = tuple(regex.findall(word + "|\x01", (text[max(0, a - 60):a] + "\x01" + text[b:b + 60]).lower().replace("\x01", " \x01 ")))
            context = tuple(w for w in context if w != "\x01")
            name = value.lower() if k == 0 else "".join(c for c in value if c.isdigit())
            names = [f"{k}:{name}"] + ([f"person:{name.split('@')[0]}", f"domain:{name.split('@')[1]}"] if k == 0 else [])
            for n in names:
                assert n not in held[i]  # one place per text in these tables, so its context is the text's
                held[i][n] = context
    n, whole = len(texts), {i: {t for t in _plain_terms(texts[i], word)} for i in range(len(texts))}
    df, df_entity = Counter(t for i in whole for t in whole[i]), Counter(e for i in held for e in held[i])
    meet = defaultdict(list)
    for i in held:
        for e in held[i]:
            for t in terms[i]:
                meet[t, e].append(i)
    tested = {e for e in df_entity if len({held[i][e] for i in held if e in held[i]}) > 1}
    limit = math.log(doubt / max(sum(e in tested for _, e in meet), n, 1))

    def chance(together, df_term, e):
        mean = df_term * df_entity[e] / n
        if mean >= together:
            return 0.0
        return together * (1 + math.log(mean / together)) - mean - math.log(2 * math.pi * together) / 2 - math.log(1 - mean / (together + 1))

    sure = set()
    for (t, e), where in meet.items():
        together = len(where)
        df_term = max(df[t], together)
        spelled = e.startswith("0:") and t in regex.findall(r"\p{L}+", e[2:].split("@")[0])
        several = e in tested and len({held[i][e] for i in where}) > 1
        if not spelled and not (several and chance(together, df_term, e) <= limit):
            continue
        if 1 - math.log((df_term + 1) / together) / max(math.log(n / df_entity[e]), 1e-9) < share:
            continue
        if " " in t and not df_term * total_words > df[t.split(" ")[0]] * df[t.split(" ")[1]]:
            continue
        around = set()
        for i in where:
            row = tokens[i] if " " not in t else [f"{x} {y}" for x, y in zip(tokens[i], tokens[i][1:])]
            at = row.index(t)
            around.add(tuple(tokens[i][max(0, at - 5):max(0, at - 5) + 11]))
        if spelled or chance(min(len({held[i][e] for i in where}), len(around)), df_term, e) <= limit:
            sure.add((t, e))
    marks = {i: {t for t in terms[i] for e in held[i] if (t, e) in sure} for i in held}
    return {i: {t for t in some if " " not in t or not set(t.split(" ")) & some} for i, some in marks.items()}


def _plain_terms(text, word):
    tokens = regex.findall(word + "|\x01+", text.lower())
    return set(tokens) | {f"{x} {y}" for x, y in zip(tokens, tokens[1:])}


def test_judgement(spark):
    rng = random.Random(21)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "né", "or", "su", "ta") for b in ("ta", "ru", "si", "vo", "xe", "ul")]
    filler = lambda m: " ".join(rng.choice(vocabulary) + rng.choice(vocabulary) for _ in range(m))
    texts = [filler(60) for _ in range(700)]
    for person in range(12):
        name, mail = f"Zan{person}bar Quo{person}x", rng.choice([f"zan{person}bar@one.example.org", f"x{person}@two{person}.example.org"])
        for _ in range(rng.randint(1, 6)):
            texts.append(f"{filler(12)} {name if rng.random() < 0.8 else filler(2)} {filler(rng.choice([2, 30]))} {rng.choice([mail, mail, f'10.1.2.{person}'])} {filler(12)}")
    texts += [texts[-1]] * 3
    rng.shuffle(texts)
    want = judged(texts)
    assert sum(map(len, want.values())) > 10
    found = sanitize.find_personal(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3), F.col("text"))
    for r in found.select("doc_id", "found").collect():
        low = texts[r.doc_id].lower()
        assert {" ".join(regex.findall(r"[\p{L}\p{M}\p{N}]+", low[s.start:s.stop])) for s in r.found if s.kind == 4} == want[r.doc_id]


def test_many_matches_in_one_text(spark):
    text = " ".join(f"user{k} u{k}@host{k % 97}.example.org from 10.0.{k % 250}.{k % 251} said" for k in range(10_000))
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    began = time.time()
    found = sanitize.find_personal(docs, F.col("text")).select("doc_id", "n_email", "n_ip", sanitize.generalised(F.col("text"), F.col("found")).alias("clean"), F.size("found").alias("n")).orderBy("doc_id").collect()
    assert (found[0].n_email, found[0].n_ip, found[0].n) == (10_000, 10_000, 20_000) and found[1].clean == "short"
    assert found[0].clean == " ".join(f"user{k} [EMAIL] from [IP] said" for k in range(10_000))
    assert time.time() - began < 60


@pytest.mark.parametrize("size", [0, 1, 2, 1023, 1024, 1025, 5000])
def test_pieces_of_text(spark, size):
    rng = random.Random(size)
    text = "".join(rng.choice("aé漢𝄞\n") for _ in range(size))
    places = [(a, b) for a in (0, 1, size // 2, size - 1, size) for b in (0, 1, size // 2, size - 1, size) if 0 <= a <= size and 0 <= b <= size]
    rows = spark.createDataFrame([(text, a, b) for a, b in places], "text string, a int, b int")
    for r in rows.select("a", "b", sanitize.between(sanitize.pieces(F.col("text")), F.col("a"), F.col("b")).alias("x")).collect():
        assert r.x == text[r.a:r.b]
