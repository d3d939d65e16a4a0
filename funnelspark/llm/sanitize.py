"""Personal data: patterns for the protected entities, then terms that disclose them by corpus co-occurrence.

A term discloses an entity as far as it lowers the entity's information content: with N texts, the smoothed share is PMI(term; entity) /
IC(entity) = 1 - log((df(term) + 1) / n(term, entity)) / log(N / df(entity)), where n counts the texts that hold both, anywhere. Terms are
words and neighbouring pairs of words. A term whose share exceeds a threshold, and that meets the entity more often than chance explains, is a
span at every place in every text that holds the entity. Addresses are also pooled by person and by domain. Native plan throughout.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from funnelspark.llm.common import let
from funnelspark.session import write_stage

# Kinds in the order that sorts spans of one start.
KINDS = ["email", "ip", "card", "phone"]
TERM = "term"

#: Code points beside an entity, and words beside a term, that tell independent texts from copies. They bound no candidate.
CONTEXT, NEIGHBOURS = 60, 5
#: Share of an entity's information that a term may disclose, and the number of judgements by chance that all tests together may give.
DISCLOSED, DOUBT = 0.8, 0.05
#: Words of 64 bits in the filter of candidate terms that is broadcast (2 MB of bits, whatever the number of terms).
FILTER = 1 << 18
#: Code points of a piece of text, so that places far into a long text are reached in steps.
PIECE = 1024
#: What stands in for an entity, and a word.
BLANK = "\x01"
_WORD = r"[\p{L}\p{M}\p{N}]+"

# The patterns, with possessive repetition and anchors that spare attempts within a run: linear time, the same matches.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A cheap test that a text may hold the kind at all.
MAY_HOLD = {
    "email": lambda t: F.contains(t, F.lit("@")), "ip": lambda t: t.rlike(r"[0-9]\.[0-9]"),
    "card": lambda t: t.rlike(r"[0-9](?:[\x20-]?[0-9]){13}"), "phone": lambda t: F.contains(t, F.lit("+")),
}


def scan(items: Column, start: Column, step: Callable[[Column, Column], tuple[Column, Column]], out: str) -> Column:
    """Outputs of a running state over an array: ``step`` gives the next state and an array of outputs, of type ``array<out>``.

    Outputs are gathered in blocks of about the square root of the number of items, so adding to an array never copies a long one.
    """
    none = lambda depth: F.array().cast("array<" * depth + out + ">" * depth)

    def block(state: Column, some: Column) -> Column:
        def one(a: Column, x: Column) -> Column:
            after, more = step(a["state"], x)
            return F.struct(after.alias("state"), F.when(F.size(more) > 0, F.concat(a["found"], more)).otherwise(a["found"]).alias("found"))

        return F.aggregate(some, F.struct(state.alias("state"), none(1).alias("found")), one)

    def all_(x: Column) -> Column:
        size = F.ceil(F.sqrt(F.size(x))).cast("int")
        return F.aggregate(
            F.sequence(F.lit(0), F.ceil(F.size(x) / size).cast("int") - 1), F.struct(start.alias("state"), none(2).alias("found")),
            lambda a, k: let(block(a["state"], F.slice(x, k * size + 1, size)), lambda b: F.struct(b["state"].alias("state"), F.when(F.size(b["found"]) > 0, F.array_append(a["found"], b["found"])).otherwise(a["found"]).alias("found"))),
            lambda a: F.flatten(a["found"]),
        )

    return let(items, lambda x: F.when(F.size(x) > 0, all_(x)).otherwise(none(1)))


def pieces(text: Column) -> Column:
    """The text in pieces of PIECE code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def between(parts: Column, start: Column, stop: Column) -> Column:
    """Code points from ``start`` up to ``stop`` of a text in pieces; only the pieces they lie in are walked."""
    def of(first: Column, last: Column) -> Column:
        head = F.substring(F.get(parts, first), start % PIECE + 1, F.when(first == last, stop - start).otherwise(F.lit(PIECE)))
        rest = F.concat(F.array_join(F.slice(parts, first + 2, F.greatest(F.lit(0), last - first - 1)), ""), F.substring(F.get(parts, last), F.lit(1), (stop - 1) % PIECE + 1))
        return F.when(first == last, head).otherwise(F.concat(head, rest))

    whole = lambda n: F.floor(n / PIECE).cast("int")
    return F.when(stop > start, let(F.struct(whole(start).alias("a"), whole(stop - 1).alias("b")), lambda x: of(x["a"], x["b"]))).otherwise(F.lit(""))


def matches(text: Column, pattern: str) -> Column:
    """Leftmost non-overlapping matches as array of (start, stop, value), in code points: the lengths of gaps and values add up."""

    def step(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + F.length(x["gap"])
        stop = start + F.length(x["value"])
        return stop, F.array(F.struct(start.alias("start"), stop.alias("stop"), x["value"].alias("value")))

    def placed(values: Column, gaps: Column) -> Column:
        both = F.zip_with(values, F.slice(gaps, F.lit(1), F.size(values)), lambda v, g: F.struct(v.alias("value"), g.alias("gap")))
        return scan(both, F.lit(0), step, "struct<start:int,stop:int,value:string>")

    none = F.array().cast("array<struct<start:int,stop:int,value:string>>")
    return let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), lambda v: F.when(F.size(v) > 0, placed(v, F.split(text, pattern, -1))).otherwise(none))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    def weight(k: Column) -> Column:
        digit = F.substring(digits, F.length(digits) - k, F.lit(1)).cast("int")
        return F.when(k % 2 == 0, digit).when(digit > 4, 2 * digit - 9).otherwise(2 * digit)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), lambda a, k: a + weight(k)) % 10 == 0


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: F.forall(F.split(v, r"\."), lambda p: let(F.regexp_replace(p, "^0+", ""), lambda q: (F.length(q) <= 3) & (F.when(F.length(q) == 0, F.lit(0)).when(F.length(q) <= 3, q.cast("int")).otherwise(F.lit(999)) <= 255))),
    "card": lambda v: let(_digits(v), lambda d: F.length(d).between(14, 19) & F.when(F.length(d).between(14, 19), _luhn(d)).otherwise(F.lit(False))),
    "phone": lambda v: F.length(_digits(v)).between(10, 15),
}


def base_spans(text: Column) -> Column:
    """All valid spans as array of (start, kind number, stop, value), sorted."""
    none = F.array().cast("array<struct<start:int,stop:int,value:string>>")

    def of(k: int, kind: str) -> Column:
        found = F.when(MAY_HOLD[kind](text), matches(text, PATTERNS[kind])).otherwise(none)
        return F.transform(
            F.filter(found, lambda m: VALID[kind](m["value"])),
            lambda m: F.struct(m["start"].alias("start"), F.lit(k).alias("kind"), m["stop"].alias("stop"), m["value"].alias("value")),
        )

    found = [of(k, kind) for k, kind in enumerate(KINDS)]
    return F.sort_array(F.concat(*found))


def _entities(parts: Column, length: Column, spans: Column) -> Column:
    """For each entity, and the person and domain of an address: its name and a hash of the words beside it."""

    def of(x: Column) -> Column:
        beside = F.concat(between(parts, F.greatest(F.lit(0), x["start"] - CONTEXT), x["start"]), F.lit(BLANK), between(parts, x["stop"], F.least(x["stop"] + CONTEXT, length)))
        value = F.when(x["kind"] == 0, F.lower(x["value"])).otherwise(_digits(x["value"]))
        context = F.xxhash64(F.regexp_extract_all(F.lower(beside), F.lit(_WORD), F.lit(0)))
        pooled = F.when(x["kind"] == 0, F.array(F.concat(F.lit("person:"), F.substring_index(value, "@", 1)), F.concat(F.lit("domain:"), F.substring_index(value, "@", -1)))).otherwise(F.array().cast("array<string>"))
        names = F.concat(F.array(F.concat(x["kind"].cast("string"), F.lit(":"), value)), pooled)
        return let(context, lambda c: F.transform(names, lambda n: F.struct(n.alias("entity"), c.alias("context"))))

    return F.flatten(F.transform(spans, of))


def _replaced(parts: Column, length: Column, spans: Column, instead: Callable[[Column, Column], Column]) -> Column:
    """The text with the spans, sorted by start, replaced by ``instead`` of the span and the place up to which the text is done."""

    def step(at: Column, s: Column) -> tuple[Column, Column]:
        return F.greatest(at, s["stop"]), F.array(F.concat(between(parts, at, s["start"]), instead(s, at)))

    end = F.aggregate(spans, F.lit(0), lambda a, s: F.greatest(a, s["stop"]))
    return F.concat(F.array_join(scan(spans, F.lit(0), step, "string"), ""), between(parts, end, length))


def _blanked(parts: Column, length: Column, spans: Column) -> Column:
    """The text with the entities overwritten; places stay."""
    return _replaced(parts, length, spans, lambda s, at: F.repeat(F.lit(BLANK), F.greatest(F.lit(0), s["stop"] - F.greatest(at, s["start"]))))


def _tokens(text: Column) -> Column:
    """Words in lower case; an entity that is overwritten is a token of its own."""
    return F.regexp_extract_all(F.lower(text), F.lit(f"{_WORD}|{BLANK}+"), F.lit(0))


def _is_word(token: Column) -> Column:
    return ~token.startswith(BLANK)


def _pair(tokens: Column, i: Column) -> Column:
    """The token at ``i`` and the one after it; null at the end."""
    return F.concat(F.get(tokens, i), F.lit(" "), F.get(tokens, i + 1))


def _terms(tokens: Column) -> Column:
    """Distinct words and neighbouring pairs of words."""
    return F.array_distinct(F.filter(F.concat(tokens, F.transform(tokens, lambda _, i: _pair(tokens, i))), lambda w: w.isNotNull() & ~F.contains(w, F.lit(BLANK))))


def _first_places(tokens: Column) -> Column:
    """Distinct words and neighbouring pairs of words, each with the place (from 0) of its first token."""
    every = F.concat(F.transform(tokens, lambda w, i: F.struct(w.alias("term"), i.alias("at"))), F.transform(tokens, lambda _, i: F.struct(_pair(tokens, i).alias("term"), i.alias("at"))))
    some = F.sort_array(F.filter(every, lambda x: x["term"].isNotNull() & ~F.contains(x["term"], F.lit(BLANK))))
    return let(some, lambda x: F.filter(x, lambda y, k: (k == 0) | (F.get(x, k - 1)["term"] != y["term"])))


def _marks(text: Column, terms: Column) -> Column:
    """Every place of the terms in a text, as array of (start, kind, stop)."""
    span = lambda start, stop: F.struct(start.alias("start"), F.lit(len(KINDS)).alias("kind"), stop.alias("stop"))
    none = F.array().cast("array<struct<start:int,kind:int,stop:int>>")

    def step(a: Column, x: Column) -> tuple[Column, Column]:
        # x is a word with the gap before it; the state has the last word and where it begins and ends.
        stop = a["at"] + F.length(x["piece"])
        start = stop - F.length(x["word"])
        joined = F.array_contains(terms, F.concat(a["word"], F.lit(" "), x["low"])) & _is_word(a["word"]) & ~F.contains(x["piece"], F.lit(BLANK))
        found = F.when(F.array_contains(terms, x["low"]), F.array(span(start, stop))).otherwise(none)
        return F.struct(stop.alias("at"), start.alias("start"), x["low"].alias("word")), F.when(joined, F.array_append(found, span(a["start"], stop))).otherwise(found)

    # The empty remainder after the last word holds none.
    words = F.transform(
        F.regexp_extract_all(text, F.lit(r"[^\p{L}\p{M}\p{N}]*+[\p{L}\p{M}\p{N}]++"), F.lit(0)),
        lambda p: let(F.regexp_extract(p, f"{_WORD}$", 0), lambda w: F.struct(p.alias("piece"), w.alias("word"), F.lower(w).alias("low"))),
    )
    start = F.struct(F.lit(0).alias("at"), F.lit(0).alias("start"), F.lit(BLANK).alias("word"))
    return F.array_distinct(scan(words, start, step, "struct<start:int,kind:int,stop:int>"))


def _chance(together: Column, df_term: Column, df_entity: Column, total: int) -> Column:
    """Log of a bound of the probability that a term and an entity meet in so many texts by chance (Poisson tail, Stirling's factorial); 0 if that is expected."""
    mean = df_term * df_entity / F.lit(float(total))
    tail = together * (1 + F.log(mean / together)) - mean - F.log(F.lit(2 * math.pi) * together) / 2 - F.log(1 - mean / (together + 1))
    return F.when(mean < together, tail).otherwise(0.0)


def _disclosed(total: int) -> Column:
    """Share of the entity's information that the term discloses, by the columns df_term, together and df_entity."""
    return 1 - F.log((F.col("df_term") + 1) / F.col("together")) / F.greatest(F.log(F.lit(float(total)) / F.col("df_entity")), F.lit(1e-9))


def find_personal(docs: DataFrame, text: Column, share: float = DISCLOSED, doubt: float = DOUBT, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns or those to ``keep``) with n_email, n_ip, n_card, n_phone and found, all spans as array of (start, kind, stop).

    Kinds are numbered as in KINDS, ``len(KINDS)`` is a term; starts and stops count code points. A term is judged with the entities of all texts that
    hold it, and marked wherever it stands in a text of the entity it discloses. Frequencies count documents; the test against chance counts distinct
    contexts, the fewer of those of the entity and of the term, so copies alone are none; it needs no more evidence for a word that is a part of the address itself.
    A pair of words is no span if one of them is, or if they follow each other no more often than by chance. Null and empty texts have no spans. Repeated rows each have their spans. An input column of an output's name is replaced.
    """
    outputs = ["found", *[f"n_{k}" for k in KINDS]]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    whole = docs.select((F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_"))).alias("row"), F.coalesce(text, F.lit("")).alias("text"))
    held = lambda t, s: let(F.struct(pieces(t).alias("parts"), F.length(t).alias("length")), lambda x: F.struct(
        _entities(x["parts"], x["length"], s).alias("entities"), _blanked(x["parts"], x["length"], s).alias("blanked"),
    ))
    rows = whole.select("row", let(F.col("text"), lambda t: let(base_spans(t), lambda s: let(F.when(F.size(s) > 0, held(t, s)), lambda h: F.struct(
        s.alias("spans"), h["entities"].alias("entities"), h["blanked"].alias("blanked"), F.regexp_count(t, F.lit(_WORD)).alias("n_tokens"),
    )))).alias("x"))
    rows = write_stage(rows.select("row", F.monotonically_increasing_id().alias("number"), "x.*"), "personal")
    judged = _disclosing(whole, rows, share, doubt)
    if judged is None:
        found = rows.withColumn("more", F.lit(None).cast("array<struct<start:int,kind:int,stop:int>>"))
    else:
        marked = rows.join(judged.groupBy("number").agg(F.collect_set("term").alias("terms")), "number", "left")
        found = marked.withColumn("more", F.when(F.col("terms").isNotNull(), let(F.struct("blanked", "terms"), lambda x: _marks(x["blanked"], x["terms"]))))
    plain = F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        *[F.col("row").getField(c).alias(c) for c in kept], *[count(k).alias(f"n_{kind}") for k, kind in enumerate(KINDS)],
        F.when(F.col("more").isNull(), plain).otherwise(F.sort_array(F.concat(plain, F.col("more")))).alias("found"),
    )


def _among(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """``rows`` whose term may be one of ``terms``: by a bit per hash in a broadcast filter of at most FILTER words.

    It drops no term of ``terms``; the more there are, the more others pass, which a later join by term drops.
    """
    place = lambda h: F.shiftrightunsigned(h, 6).bitwiseAND(F.lit(FILTER - 1))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), h.bitwiseAND(F.lit(63)).cast("int"))
    hashed = F.xxhash64("term")
    bits = write_stage(terms.select(place(hashed).alias("place"), bit(hashed).alias("bit")).groupBy("place").agg(F.bit_or("bit").alias("bits")), "filter")
    return rows.withColumn("hash", hashed).withColumn("place", place(F.col("hash"))).join(F.broadcast(bits), "place").where(F.col("bits").bitwiseAND(bit(F.col("hash"))) != 0).drop("hash", "place", "bits")


def _disclosing(whole: DataFrame, rows: DataFrame, share: float, doubt: float) -> DataFrame | None:
    """number and term: the terms to mark in each text; None if there are none."""
    total, n_tokens = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("n_tokens"), F.lit(0))).first()
    texts = write_stage(rows.where(F.size("spans") > 0).select("number", "entities", _tokens(F.col("blanked")).alias("tokens")), "tokens")
    seen = write_stage(texts.select("number", F.explode("entities").alias("e")).groupBy("number", "e.entity").agg(F.min("e.context").alias("context")), "seen")
    entities = write_stage(seen.groupBy("entity").agg(F.count(F.lit(1)).alias("df_entity"), (F.min("context") != F.max("context")).alias("several")).withColumn("id", F.monotonically_increasing_id()), "entities")

    # An entity of one text, or of texts that begin it alike, cannot meet a term more often than chance explains: it is not tested.
    # The stage keeps the ids, which are shorter than names.
    tested = seen.join(entities.where("several").select("entity", "id"), "entity").groupBy("number").agg(F.collect_list(F.struct("id", "context")).alias("tested"))
    beside = texts.join(tested, "number").select(F.explode("tested").alias("e"), _terms(F.col("tokens")).alias("terms")).select("e.id", "e.context", F.explode("terms").alias("term"))
    tests = Observation()
    pairs = beside.groupBy("term", "id").agg(F.count(F.lit(1)).alias("together"), F.min("context").alias("low"), F.max("context").alias("high")).observe(tests, F.count(F.lit(1)).alias("n"))
    met = write_stage(pairs.where("low != high").select("term", "id", "together"), "beside")
    limit = math.log(doubt / max(tests.get["n"] or 0, total, 1))

    # Parts of the address's own name need no other evidence.
    parts = F.transform(
        F.filter("entities", lambda e: e["entity"].startswith("0:")),
        lambda e: F.struct(e["entity"].alias("entity"), F.regexp_extract_all(F.substring_index(F.substring(e["entity"], 3, 1 << 20), "@", 1), F.lit(r"\p{L}+"), F.lit(0)).alias("parts")),
    )
    named = texts.select("number", F.explode(parts).alias("e")).select("number", "e.entity", F.explode("e.parts").alias("term")).distinct()
    spelled = write_stage(named.join(texts.select("number", F.explode(F.array_distinct("tokens")).alias("term")), ["number", "term"], "left_semi"), "spelled")

    own = spelled.groupBy("term", "entity").agg(F.count(F.lit(1)).alias("together")).withColumn("spelled", F.lit(True))
    # At best a term stands in no text without entities: what fails then, fails with its true frequency.
    likely = met.join(entities, "id").where(_chance(F.col("together"), F.col("together"), F.col("df_entity"), total) <= limit)
    likely = write_stage(likely.select("term", "entity", "together", "df_entity"), "likely")
    least = _among(texts.select(F.explode(_terms(F.col("tokens"))).alias("term")), likely).groupBy("term").agg(F.count(F.lit(1)).alias("df_term"))
    likely = likely.join(least, "term").where(_disclosed(total) >= share).where(_chance(F.col("together"), F.col("df_term"), F.col("df_entity"), total) <= limit)
    candidates = likely.select("term", "entity", "together", F.lit(False).alias("spelled")).union(own.select("term", "entity", "together", "spelled"))
    candidates = candidates.groupBy("term", "entity").agg(F.max("together").alias("together"), F.max("spelled").alias("spelled"))
    candidates = write_stage(candidates, "candidates")
    if candidates.isEmpty():
        return None
    # Pairs come with their words.
    needed = candidates.select(F.explode(F.array_distinct(F.concat(F.array("term"), F.split("term", " ")))).alias("term"))
    every = whole.select(F.explode(let(_tokens(F.col("text")), _terms)).alias("term"))
    frequency = write_stage(_among(every, needed).groupBy("term").agg(F.count(F.lit(1)).alias("df_term")), "frequency")
    judged = candidates.join(frequency, "term", "left").join(entities.drop("id"), "entity")
    for k, at in ((1, 1), (2, -1)):
        judged = judged.withColumn(f"word_{k}", F.substring_index("term", " ", at)).join(frequency.select(F.col("term").alias(f"word_{k}"), F.col("df_term").alias(f"df_{k}")), f"word_{k}", "left")
    # Texts that hold the pair are a part of those that hold the term.
    judged = judged.withColumn("df_term", F.greatest("df_term", "together"))
    by_chance = lambda n: _chance(F.col(n), F.col("df_term"), F.col("df_entity"), total) > limit
    # The words of a pair must follow each other more often than their frequencies explain: "wrote to" is no name.
    attracted = ~F.contains(F.col("term"), F.lit(" ")) | (F.col("df_term") * F.lit(float(n_tokens)) > F.col("df_1") * F.col("df_2"))
    judged = write_stage(judged.where(_disclosed(total) >= share).where(attracted).where(F.col("spelled") | ~by_chance("together")).select("term", "entity", "spelled", "df_term", "df_entity"), "judged")
    if judged.isEmpty():
        return None

    # Judged terms in the texts of their entities, each at its first place, and the words around that place.
    places = _among(texts.select("number", F.explode(_first_places(F.col("tokens"))).alias("p")).select("number", "p.term", "p.at"), judged)
    held = places.join(judged, "term").join(seen.select("number", "entity", "context"), ["number", "entity"])
    listed = held.groupBy("number").agg(F.collect_list(F.struct("term", "entity", "context", "spelled", "df_term", "df_entity", "at")).alias("held"))
    around = F.xxhash64(F.slice("tokens", F.greatest(F.lit(1), F.col("h.at") + 1 - NEIGHBOURS), 2 * NEIGHBOURS + 1))
    placed = texts.select("number", "tokens").join(listed, "number").select("number", "tokens", F.explode("held").alias("h")).select("number", "h.*", around.alias("around"))
    placed = write_stage(placed, "placed")
    evidence = placed.groupBy("term", "entity", "spelled", "df_term", "df_entity").agg(F.least(F.count_distinct("context"), F.count_distinct("around")).alias("contexts"))
    sure = evidence.where(F.col("spelled") | ~by_chance("contexts")).select("term", "entity").union(judged.where("spelled").select("term", "entity")).distinct()
    sure = write_stage(sure, "disclosing")
    marks = placed.select("number", "entity", "term").union(spelled.select("number", "entity", "term")).distinct().join(sure, ["term", "entity"])
    # A pair adds nothing to a word that discloses the entity by itself.
    listed = marks.groupBy("number").agg(F.collect_set("term").alias("terms"))
    return listed.select("number", F.explode(F.filter("terms", lambda w: ~F.contains(w, F.lit(" ")) | ~F.arrays_overlap(F.split(w, " "), "terms"))).alias("term"))


def written(found: Column, base_only: bool = False) -> Column:
    """Spans as kind:start:stop, comma-joined."""
    names = F.array(*[F.lit(k) for k in [*KINDS, TERM]])
    some = F.filter(found, lambda s: s["kind"] < len(KINDS)) if base_only else found
    return F.array_join(F.transform(some, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def generalised(text: Column, found: Column) -> Column:
    """The text with every span replaced by its kind in brackets; overlapping spans become one, named after the first."""
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in [*KINDS, TERM]])
    # A span within what is done adds nothing, one that begins there only carries on.
    instead = lambda s, at: F.when(s["start"] < at, F.lit("")).otherwise(F.get(names, s["kind"]))
    done = let(F.struct(pieces(text).alias("parts"), F.length(text).alias("length")), lambda x: _replaced(x["parts"], x["length"], found, instead))
    return F.when(F.size(found) > 0, done).otherwise(text)
