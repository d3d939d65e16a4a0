"""The prefix trie against a plain program over all prefixes."""

import hashlib
import math
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from funnelspark.llm import trie

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def brute(rows):
    own = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(turns)] for c, turns in own.items()}
    made = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        made[c] = own.get(c - int(math.fmod(c, 100)), [])[:h] + own[c][h:]
    nodes = defaultdict(list)
    for c, turns in made.items():
        for d in range(len(turns) + 1):
            nodes[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in nodes:
        if node:
            children[node[:-1]].append(node)
    sums = {}
    for node in sorted(nodes, key=len, reverse=True):
        below = [sums[k] for k in children[node]]
        saved = (len(nodes[node]) - 1) * len(node[-1][1]) if node else 0
        sums[node] = (saved + sum(s for s, _ in below), sum(n for _, n in below) if below else 1)
    out = Counter()
    for node, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c in members if len(made[c]) == len(node)))
        parent = min(nodes[node[:-1]]) if node else None
        out[min(members), len(node), parent, len(members), len(children[node]), sums[node][1], sums[node][0], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def random_rows(rng, convs, turns=3, words=2):
    rows = []
    for c in convs:
        for t in range(rng.randint(1, rng.choice([2, 5, 12]))):
            rows.append((c, t, rng.choice(["user", "assistant"][:turns]), rng.choice(["a", "bé", "ccc"][:words]), "x"))
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_trie(spark, small):
    rng = random.Random(4)
    rows = random_rows(rng, [*range(0, 230), *range(1000, 1300), 7001, 7002])
    rows += [(k, t, "user", "same", "x") for k in range(2000, 2400) for t in range(8)]  # copies
    rows += [(2500, t, "user", str(t), "x") for t in range(700)] + [(2501, t, "user", str(t), "x") for t in range(700)]  # deep
    rows += [(3000, None, None, None, "x"), (3000, 5, "user", None, None), (3000, -1, None, "z", "x"), (3001, 1, "user", "q", "x"), (3001, 2, "user", "q", "x"), (None, 1, "user", "lost", "x"), (-5, 1, "user", "a", "x"), (-5, 2, "user", "bé", "x")]
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, SCHEMA).repartition(7)
    args = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    if small:
        docs = docs.where("conv_id < 2100")
        rows = [r for r in rows if r[0] is not None and r[0] < 2100]
    # Pieces of a few ids, peeled in many parts.
    found = trie.prefix_trie(docs, *args, **({"most": 20, "characters": 9} if small else {})).collect()
    assert Counter(map(tuple, found)) == brute(rows)


def test_ties_and_nothing(spark):
    args = [F.col(c) for c in ("conv_id", "turn", "role", "text")]
    assert trie.prefix_trie(spark.createDataFrame([], SCHEMA), *args).count() == 0
    assert trie.prefix_trie(spark.createDataFrame([(None, 1, "a", "b", "c")], SCHEMA), *args).count() == 0
    rows = [(k, 1, "user", t, "x") for k in (100, 200) for t in ("b", "a", "b")]
    found = trie.prefix_trie(spark.createDataFrame(rows, SCHEMA), *args).collect()
    # Equal turn numbers are in the same order everywhere: the two are copies.
    assert sorted((r.depth, r.n_convs) for r in found) == [(0, 2), (1, 2), (2, 2), (3, 2)]
