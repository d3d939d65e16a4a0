"""Quality rules against a plain program: base columns by counting, the robust estimate by numpy, a text per statistic."""

import math
import random
import re
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from funnelspark.llm import quality
from funnelspark.llm.common import chi_square_below, chi_square_quantile

SCHEMA = "doc_id long, text string, lang string, source string"
WORDS = [a + b + c for a in ("ka", "lo", "mi", "né", "or", "su") for b in ("ta", "ru", "si", "vo") for c in ("x", "lle", "n", "mmo")]
TOLERANCE = np.array(list(quality.STATISTICS.values()))


def base(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[k:k + 3]) for k in range(len(words) - 2)]
    often = Counter(windows)
    lines = [x for x in text.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len({k + j for k, w in enumerate(windows) if often[w] > 1 for j in range(3)}), "lines": len(lines), "capitals": sum("A" <= c <= "Z" for c in text),
    }


def vector(b):
    ratio = lambda x, y: math.sqrt(x / max(y, 1))
    return [math.log1p(b["n_words"]), math.log1p(b["word_chars"] / max(b["n_words"], 1)), ratio(b["n_symbols"], b["word_chars"]), ratio(b["n_dup_lines"], b["lines"]),
            ratio(b["n_repeat_words"], b["n_words"]), ratio(b["capitals"], b["word_chars"])]


def distances(x):
    """Squared distances of the rows of one group from its estimate."""
    n, p = x.shape
    factor = lambda q: q / chi_square_below(chi_square_quantile(q, p), p + 2)
    far = lambda m, c, y: np.einsum("ij,ji->i", y - m, np.linalg.solve(c, (y - m).T))
    with_tolerance = lambda c: c + np.diag(TOLERANCE**2)

    def moments(y, f):
        return y.mean(axis=0), with_tolerance(f * ((y - y.mean(axis=0)).T @ (y - y.mean(axis=0)) / len(y)))

    def step(m, c):
        bins = np.floor(np.log2(far(m, c, x) + 1e-9) * quality.BINS)
        return moments(x[bins <= np.sort(bins)[math.ceil(quality.SHARE * n * (1 + 1e-15)) - 1]], factor(quality.SHARE))

    grid = np.sort(np.floor(x * quality.GRID), axis=0)
    at = lambda q: (grid[math.ceil(q * n) - 1] + 0.5) / quality.GRID
    middle, spread = at(0.5), (at(0.75) - at(0.25)) / 1.349
    scale = np.sqrt(np.maximum(spread**2, TOLERANCE**2))
    z = (x - middle) / scale
    signs = z / np.maximum(np.linalg.norm(z, axis=1), 1e-9)[:, None]
    cov = lambda y: (y - y.mean(axis=0)).T @ (y - y.mean(axis=0)) / len(y)
    starts = [(middle, with_tolerance(np.diag(spread**2))), moments(x, 1.0), (middle, with_tolerance(cov(signs) * p * np.outer(scale, scale)))]
    tried = []
    for m, c in starts:
        for _ in range(quality.TRIAL):
            m, c = step(m, c)
        tried.append((np.linalg.slogdet(c)[1], m, c))
    logdet, m, c = min(tried, key=lambda t: t[0])
    for _ in range(quality.STEPS - quality.TRIAL):
        m, c = step(m, c)
        now = np.linalg.slogdet(c)[1]
        if not now < logdet - quality.FALL:
            break
        logdet = now
    m, c = moments(x[far(m, c, x) <= chi_square_quantile(0.975, p)], factor(0.975))
    return far(m, c, x)


def text_of(rng, n, line=12):
    words = [rng.choice(WORDS) for _ in range(n)]
    return "\n".join(" ".join(words[k:k + line]) for k in range(0, n, line))


def test_against_numpy(spark):
    rng = random.Random(31)
    rows = []
    for k in range(260):
        text = text_of(rng, rng.randint(40, 300), rng.choice([5, 12, 30]))
        if k % 9 == 0:
            text += "\n" + "\n".join([text.split("\n")[0]] * rng.randint(1, 30))
        if k % 13 == 0:
            text = text.replace(" ", " # ", rng.randint(1, 60)).title()
        rows.append((k, text, rng.choice(["en", "fr", None]), rng.choice(["a", "b"])))
    # A third of one group lies together far away: the classical moments are drawn to it, the estimate is not.
    rows += [(1000 + k, text_of(rng, 100).upper().replace(" ", " $$$ "), "fr", "a") for k in range(12)]
    rows += [(2000, None, "en", "a"), (2001, "", None, None), (2002, text_of(rng, 90), None, "alone"), (2002, text_of(rng, 90), None, "alone"), (2003, text_of(rng, 30_000), "en", "b")]
    found = quality.judge(spark.createDataFrame(rows, SCHEMA).repartition(5), F.col("text"), ["lang", "source"], keep=["doc_id"]).collect()
    limit = chi_square_quantile(quality.CUTOFF, 6)
    groups, got = defaultdict(list), defaultdict(list)
    for r in found:
        got[r.doc_id].append(r)
    for doc_id, text, lang, source in rows:
        b = base(text)
        failed = b["n_words"] < 50 or 100 * b["n_repeat_words"] > 50 * b["n_words"]
        r = next(r for r in got[doc_id] if r.n_words == b["n_words"] and r.word_chars == b["word_chars"])
        assert [r[c] for c in quality.BASE] == [b[c] for c in quality.BASE] and r.base_failed == failed
        if failed:
            assert not r.kept
        else:
            groups[lang, source].append((vector(b), r))
    rejected = 0
    for some in groups.values():
        for d, (_, r) in zip(distances(np.array([v for v, _ in some])), some):
            assert abs(r.distance - d) <= 1e-6 * max(1, d) and r.kept == (d <= limit)
            rejected += not r.kept
    assert rejected >= 12 and not any(r.kept for k in range(1000, 1012) for r in got[k])


def test_every_statistic_rejects_by_itself(spark):
    rng = random.Random(5)
    plain = [(k, text_of(rng, 240), "en", "a") for k in range(60)]
    unique = text_of(rng, 600, 20)
    odd = {
        "log_words": text_of(rng, 40_000),
        "log_length": " ".join(rng.choice(WORDS) + rng.choice(WORDS) + rng.choice(WORDS) + rng.choice(WORDS) for _ in range(240)),
        "symbols": text_of(rng, 240).replace("a", "#"),
        "dup_lines": unique[:2000] + "\n" + "\n".join(["menu", "home"] * 36),  # 70 of some 90 lines are copies of short ones
        "repeats": text_of(rng, 125) + "\n" + (block := text_of(rng, 62)) + " " + block.replace("\n", "  \n "),
        "capitals": text_of(rng, 240).upper(),
    }
    rows = plain + [(100 + k, t, "en", "a") for k, t in enumerate(odd.values())]
    found = {r.doc_id: r for r in quality.judge(spark.createDataFrame(rows, SCHEMA), F.col("text"), ["lang", "source"]).collect()}
    assert all(found[k].kept for k in range(60))
    assert {name: found[100 + k].base_failed for k, name in enumerate(odd)} == dict.fromkeys(odd, False)
    assert {name: found[100 + k].kept for k, name in enumerate(odd)} == dict.fromkeys(odd, False)
