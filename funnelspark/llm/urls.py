"""URL filters: host and path rules first, then a weighted vocabulary searched by one automaton.

The automaton reports every term in a url; only hits whose neighbours are no letters or digits count. One strict term rejects, and so do
several distinct soft terms whose weights reach the limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from funnelspark.llm.common import map_rows

# Rules as host and path with their verdicts.
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}

#: Terms that reject alone, and soft terms with their weights.
STRICT = ["porn", "xxx", "viagra", "casino", "malware", "phishing", "warez", "torrent", "escort", "gambling"]
SOFT = {
    "ads": 1.0, "ad": 0.5, "track": 1.0, "tracker": 1.0, "click": 1.0, "banner": 1.0, "popup": 1.0, "promo": 1.0, "bet": 1.0, "poker": 1.0, "adult": 1.0,
    "dating": 1.0, "loan": 1.0, "loans": 1.0, "pills": 1.0, "crack": 1.0, "keygen": 1.0, "free": 0.5, "win": 0.5, "cheap": 0.5, "deal": 0.5, "download": 0.5,
}
SOFT_LIMIT, SOFT_TERMS = 2.0, 2

HITS = T.StructType([T.StructField("strict_terms", T.ArrayType(T.StringType())), T.StructField("soft_terms", T.ArrayType(T.StringType())), T.StructField("soft_weight", T.DoubleType())])
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_AUTOMATA: dict[str, object] = {}
_INSIDE = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


class Vocabulary(NamedTuple):
    """Strict terms and soft terms with their weights, under a name that tells vocabularies apart."""

    strict: frozenset[str]
    soft: dict[str, float]
    name: str


def vocabulary(strict: Iterable[str], soft: dict[str, float]) -> Vocabulary:
    strict = frozenset(strict)
    listed = "\n".join([*sorted(strict), "", *(f"{t} {w!r}" for t, w in sorted(soft.items()))])
    return Vocabulary(strict, soft, hashlib.sha256(listed.encode()).hexdigest())


def read_vocabulary(terms: DataFrame) -> Vocabulary:
    """The vocabulary in a table of ``term`` and ``weight``, in which a null weight makes a term strict.

    A-Z of a term are lower-cased and blanks around it cut off; null and empty terms are none; of several weights of a term the largest counts, and a term that
    is also strict is no soft one. The table is a parameter: it goes through the driver and every worker holds its automaton (150,000 terms: 60 MB).
    """
    term = F.translate(F.trim("term"), _UPPER, _LOWER)
    rows = terms.select(term.alias("term"), F.col("weight").cast("double").alias("weight")).where("term != ''").groupBy("term").agg(
        F.max("weight").alias("weight"), F.max(F.col("weight").isNull()).alias("strict"),
    ).collect()
    return vocabulary([r.term for r in rows if r.strict], {r.term: r.weight for r in rows if not r.strict})


def _automaton(words: Vocabulary):
    """Automaton of the terms' UTF-8 bytes, each with its text and length; built once per worker."""
    if words.name not in _AUTOMATA:
        import ahocorasick

        made = ahocorasick.Automaton()
        for term in words.strict | words.soft.keys():
            key = term.encode().decode("latin-1")
            made.add_word(key, (term, len(key)))
        made.make_automaton()
        _AUTOMATA.clear()
        _AUTOMATA[words.name] = made
    return _AUTOMATA[words.name]


def _hits(values: list[bytes], words: Vocabulary) -> list[list]:
    automaton = _automaton(words) if words.strict or words.soft else None
    out: list[list] = [[], [], []]
    for value in values:
        url = value.lower()  # of bytes: A-Z only
        found = set()
        for last, (term, size) in automaton.iter(url.decode("latin-1")) if automaton else ():
            first = last - size + 1
            if (first == 0 or url[first - 1] not in _INSIDE) and (last + 1 == len(url) or url[last + 1] not in _INSIDE):
                found.add(term)
        own = sorted(t for t in found if t in words.soft)
        for column, x in zip(out, (sorted(found & words.strict), own, float(sum(words.soft[t] for t in own))), strict=True):
            column.append(x)
    return out


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null url or one without ``://``."""
    whole = F.coalesce(url, F.lit(""))
    host = F.regexp_extract(whole, r"^(?s:.*?)://([^/?#]*)", 1)
    path = F.regexp_extract(whole, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: dict[str, str]) -> Column:
    """The longest rule whose host is the url's or a domain above it and whose path the url's path starts with; null if none."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit(f".{name}"))) & F.startswith(path, F.lit(f"/{rest}"))
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def judge_urls(
    pages: DataFrame, url: Column, rules: dict[str, str] | None = None, words: Vocabulary | None = None,
    soft_limit: float = SOFT_LIMIT, soft_terms_least: int = SOFT_TERMS, keep: list[str] | None = None,
) -> DataFrame:
    """``pages`` (all columns or those to ``keep``) with host, path, rule, verdict, strict_terms, soft_terms, soft_weight.

    verdict is the rule's, else block if the whole url holds a strict term, or at least ``soft_terms_least`` distinct soft terms that weigh
    ``soft_limit`` together, else allow. A term counts where no ASCII letter or digit adjoins it; only A-Z of a url is lower-cased. ``words`` is a list of any
    length (``read_vocabulary``), by default the short one above. A null or empty url has no host,
    path, rule or terms and is allowed. Rows, repeated ones included, are judged each on its own; an input column of an output's name is replaced.
    """
    rules, words = RULES if rules is None else rules, vocabulary(STRICT, SOFT) if words is None else words
    names = ["host", "path", "rule", "verdict"]
    kept = [c for c in (pages.columns if keep is None else keep) if c.lower() not in names]
    host, path = host_and_path(url)
    placed = pages.select(F.struct(*[F.col(f"`{c}`") for c in kept], F.lit(0).alias("_")).alias("row"), url.cast("string").alias("url"), host.alias("host"), path.alias("path"))
    found = map_rows(placed.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules)), F.col("url"), HITS, lambda v: _hits(v, words), each=200)
    verdicts = [w for r, v in rules.items() for w in (F.lit(r), F.lit(v))]
    own = F.when((F.size("strict_terms") > 0) | ((F.size("soft_terms") >= soft_terms_least) & (F.col("soft_weight") >= soft_limit)), "block").otherwise("allow")
    verdict = F.coalesce(F.element_at(F.create_map(*verdicts), F.col("rule")), own) if rules else own
    rest = [c for c in kept if c.lower() not in {f.name for f in HITS}]
    return found.select(*[F.col("row").getField(c).alias(c) for c in rest], "host", "path", "rule", verdict.alias("verdict"), *[f.name for f in HITS])
