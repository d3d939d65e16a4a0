"""Quality rules: base rules on each document, then robust multivariate outliers per language and source.

Statistic vectors of the documents that pass the base rules are transformed to be roughly symmetric. Per group, the minimum covariance
determinant is approached by concentration steps: mean and covariance of the h rows nearest by Mahalanobis distance are taken again and
again. Three starts (medians and quartiles, the classical moments, the signs of the scaled rows) take a few steps each; the one of the smallest
determinant goes on until no determinant falls, and one reweighting step follows. All of it is aggregation: histograms for medians and the
h-th distance, sums and products for the moments.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from funnelspark.llm.common import chi_square_below, chi_square_quantile, let
from funnelspark.session import write_stage

_BLANKS = r"[\x20\x09-\x0D]+"
_TRIM = " \t\n\x0b\x0c\r"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: Statistics and their tolerances: a spread that is always allowed, so that a group without any spread rejects nothing near its centre. Each is small
#: enough for its statistic to exceed the limit by itself.
STATISTICS = {"log_words": 0.5, "log_length": 0.1, "symbols": 0.04, "dup_lines": 0.13, "repeats": 0.11, "capitals": 0.05}
#: Share of a group that the concentration steps keep, steps of every start, most steps in all, and the fall of a log determinant that still counts.
SHARE, TRIAL, STEPS, FALL = 0.75, 2, 12, 1e-6
#: A vector is an outlier beyond this quantile of the chi-square distribution.
CUTOFF = 1 - 1e-6
#: Grid of the medians, and distance bins per doubling.
GRID, BINS = 64, 32
#: Groups whose estimates are broadcast (about 400 bytes each); more are joined by shuffle, each group dealt over SALTS.
MAX_BROADCAST_GROUPS, SALTS = 20_000, 32


def base_columns(text: Column) -> Column:
    """Struct of the base statistics. Native array functions only; 3-word windows are compared by 64-bit hashes within the document."""

    def of(words: Column, t: Column) -> Column:
        n = F.size(words)
        windows = F.when(n >= 3, F.transform(
            F.sequence(F.lit(0), n - 3),
            lambda i: F.struct(F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("p")),
        )).otherwise(F.array())
        found = let(F.sort_array(windows), lambda s: F.when(F.size(s) > 1, F.filter(
            F.transform(F.sequence(F.lit(0), F.size(s) - 1), lambda k: F.when(
                (F.get(s, k)["h"] == F.get(s, k + 1)["h"]) | F.coalesce(F.get(s, F.when(k > 0, k - 1))["h"] == F.get(s, k)["h"], F.lit(False)), F.get(s, k)["p"],
            )),
            lambda p: p.isNotNull(),
        )).otherwise(F.array().cast("array<int>")))
        covered = let(F.sort_array(found), lambda at: F.when(F.size(at) > 0, F.aggregate(
            at, F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
            lambda a, p: F.struct((a["n"] + F.least(F.lit(3), p - a["last"])).alias("n"), p.alias("last")),
            lambda a: a["n"],
        )).otherwise(F.lit(0)))
        lines = F.filter(F.split(t, "\n"), lambda line: F.btrim(line, F.lit(_TRIM)) != "")
        return F.struct(
            n.cast("long").alias("n_words"),
            F.aggregate(words, F.lit(0).cast("long"), lambda a, w: a + F.length(w)).alias("word_chars"),
            F.regexp_count(t, F.lit("[#*$%&|<>]")).cast("long").alias("n_symbols"),
            let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            covered.cast("long").alias("n_repeat_words"),
            F.size(lines).cast("long").alias("n_lines"),
            F.regexp_count(t, F.lit("[A-Z]")).cast("long").alias("n_capitals"),
        )

    whole = F.coalesce(text, F.lit(""))
    return let(whole, lambda t: let(F.filter(F.split(t, _BLANKS), lambda w: w != ""), lambda words: of(words, t)))


def judge(docs: DataFrame, text: Column, groups: list[str], share: float = SHARE, cutoff: float = CUTOFF, keep: list[str] | None = None) -> DataFrame:
    """``docs`` (all columns or those to ``keep``) with the base statistics, base_failed, distance and kept.

    base_failed: fewer than 50 words, or over half of them in repeated 3-word windows. Of the others, those whose squared
    Mahalanobis distance from their group (the ``groups`` columns; null is a value of its own) is beyond the ``cutoff`` quantile are not kept.
    Null and empty texts have no words and fail. Groups of any size are treated alike: the covariance includes fixed
    tolerances, so a group of one row or of equal rows rejects none. Repeated rows each count. An input column of an output's name is replaced.
    """
    names, p = list(STATISTICS), len(STATISTICS)
    outputs = [*BASE, "base_failed", "distance", "kept"]
    kept = [c for c in (docs.columns if keep is None else keep) if c.lower() not in outputs]
    b = F.col("base")
    ratio = lambda x, y: F.sqrt(x / F.greatest(y, F.lit(1)))
    rows = docs.select(
        (F.struct(*[F.col(f"`{c}`") for c in kept]) if kept else F.struct(F.lit(0).alias("_"))).alias("row"),
        F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(f"g{k}") for k, c in enumerate(groups)])).alias("group"),
        base_columns(text).alias("base"),
    )
    rows = rows.select("row", "group", "base", ((b["n_words"] < 50) | (100 * b["n_repeat_words"] > 50 * b["n_words"])).alias("base_failed"))
    rows = rows.select(
        "*",
        F.log1p(b["n_words"]).alias("log_words"), F.log1p(b["word_chars"] / F.greatest(b["n_words"], F.lit(1))).alias("log_length"),
        ratio(b["n_symbols"], b["word_chars"]).alias("symbols"), ratio(b["n_dup_lines"], b["n_lines"]).alias("dup_lines"),
        ratio(b["n_repeat_words"], b["n_words"]).alias("repeats"), ratio(b["n_capitals"], b["word_chars"]).alias("capitals"),
    )
    rows = write_stage(rows, "statistics")
    good = rows.where("not base_failed").select("group", *names)

    # Starts are groups of their own while they compete.
    trials = good.withColumn("start", F.explode(F.array(*[F.lit(k) for k in range(3)]))).withColumn("group", F.concat_ws("|", "start", "group")).drop("start")
    estimate = _starts(good, names)
    for _ in range(TRIAL):
        estimate = _concentrated(trials, estimate, names, share)
    numbered = estimate.select(F.substring("group", 1, 1).alias("start"), F.expr("substring(group, 3)").alias("group"), *[c for c in estimate.columns if c != "group"])
    best = numbered.groupBy("group").agg(F.min_by(F.struct(*estimate.columns[1:]), F.struct("logdet", "start")).alias("e"))
    estimate = write_stage(best.select("group", "e.*"), "estimate")
    for _ in range(STEPS - TRIAL):
        former, estimate = estimate, _concentrated(good, estimate, names, share)
        fell = former.select("group", F.col("logdet").alias("former")).join(estimate.select("group", "logdet"), "group").where(F.col("logdet") < F.col("former") - FALL)
        if fell.isEmpty():
            break
    near = _with_distance(good, estimate, names).where(F.col("distance") <= chi_square_quantile(0.975, p))
    estimate = _moments(near, names, _consistent(0.975, p))

    limit = chi_square_quantile(cutoff, p)
    out = _with_distance(rows, estimate, names)
    return out.select(
        *[F.col("row").getField(c).alias(c) for c in kept], *[F.col("base").getField(c).alias(c) for c in BASE], "base_failed", "distance",
        (~F.col("base_failed") & (F.coalesce("distance", F.lit(0.0)) <= limit)).alias("kept"),
    )


def _consistent(quantile: float, p: int) -> float:
    """Consistency: the covariance of the central part of a normal distribution is too small by this factor."""
    return quantile / chi_square_below(chi_square_quantile(quantile, p), p + 2)


def _concentrated(rows: DataFrame, estimate: DataFrame, names: list[str], share: float) -> DataFrame:
    """One concentration step: moments of the share of each group that is nearest to its estimate."""
    return _moments(_nearest(_with_distance(rows, estimate, names), share), names, _consistent(share, len(names)))


def _starts(good: DataFrame, names: list[str]) -> DataFrame:
    """Three estimates per group, named ``start|group``: medians and quartiles (0), mean and covariance of all rows (1), and the covariance of the signs (2)."""
    marks = _quartiles(good, names)
    p = range(len(names))
    centred = good.join(marks, "group").select("group", *[((F.col(n) - F.col(f"m{k}")) / F.greatest(F.col(f"c{k}{k}"), F.lit(STATISTICS[n] ** 2)) ** 0.5).alias(n) for k, n in enumerate(names)])
    norm = F.greatest(sum((F.col(n) * F.col(n) for n in names[1:]), F.col(names[0]) * F.col(names[0])) ** 0.5, F.lit(1e-9))
    signs = _sums(centred.select("group", *[(F.col(n) / norm).alias(n) for n in names]), names).select("group", *[F.col(f"c{i}{j}").alias(f"d{i}{j}") for i in p for j in range(i + 1)])
    wide = lambda i, j: (F.greatest(F.col(f"c{i}{i}"), F.lit(STATISTICS[names[i]] ** 2)) * F.greatest(F.col(f"c{j}{j}"), F.lit(STATISTICS[names[j]] ** 2))) ** 0.5
    third = marks.join(signs, "group").select("group", *[f"m{i}" for i in p], *[(F.col(f"d{i}{j}") * len(names) * wide(i, j)).alias(f"c{i}{j}") for i in p for j in range(i + 1)])
    all_ = [df.withColumn("group", F.concat_ws("|", F.lit(k), "group")) for k, df in enumerate((marks, _sums(good, names), third))]
    return _factored(all_[0].unionByName(all_[1]).unionByName(all_[2]), names)


def _quartiles(good: DataFrame, names: list[str]) -> DataFrame:
    """Medians and quartile ranges from counts on a grid, as means and a diagonal covariance."""
    bins = good.select("group", F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.floor(F.col(n) * GRID).alias("bin")) for k, n in enumerate(names)])).alias("x"))
    counted = bins.groupBy("group", "x.k", "x.bin").agg(F.count(F.lit(1)).alias("n"))
    # A group has as many bins as the statistic's range has, whatever its size.
    lists = counted.groupBy("group", "k").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total"))

    def at(q: float) -> Column:
        walk = F.aggregate(
            "bins", F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("bin")),
            lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), F.when(a["bin"].isNull() & (a["n"] + x["n"] >= q * F.col("total")), x["bin"]).otherwise(a["bin"]).alias("bin")),
            lambda a: a["bin"],
        )
        return (walk + 0.5) / GRID

    marks = lists.select("group", "k", at(0.5).alias("middle"), ((at(0.75) - at(0.25)) / 1.349).alias("spread"))
    wide = marks.groupBy("group").pivot("k", list(range(len(names)))).agg(F.first("middle").alias("m"), F.first("spread").alias("s"))
    means = [F.col(f"{k}_m").alias(f"m{k}") for k in range(len(names))]
    products = [
        (F.col(f"{i}_s") * F.col(f"{i}_s") if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i in range(len(names)) for j in range(i + 1)
    ]
    return write_stage(wide.select("group", *means, *products), "quartiles")


def _sums(rows: DataFrame, names: list[str], factor: float = 1.0) -> DataFrame:
    """Mean and covariance of each group, the covariance times ``factor``."""
    p = range(len(names))
    sums = rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(names[i]).alias(f"s{i}") for i in p],
        *[F.sum(F.col(names[i]) * F.col(names[j])).alias(f"s{i}{j}") for i in p for j in range(i + 1)],
    )
    mean = lambda i: F.col(f"s{i}") / F.col("n")
    return sums.select(
        "group", *[mean(i).alias(f"m{i}") for i in p],
        *[(factor * (F.col(f"s{i}{j}") / F.col("n") - mean(i) * mean(j))).alias(f"c{i}{j}") for i in p for j in range(i + 1)],
    )


def _moments(near: DataFrame, names: list[str], factor: float) -> DataFrame:
    return _factored(_sums(near, names, factor), names)


def _factored(moments: DataFrame, names: list[str]) -> DataFrame:
    """Means, the Cholesky factor of covariance plus squared tolerances, one column an entry, and the log of the determinant; written, as every use needs them."""
    out = moments
    for i, name in enumerate(names):
        for j in range(i + 1):
            rest = F.col(f"c{i}{j}") + (STATISTICS[name] ** 2 if i == j else 0.0)
            for k in range(j):
                rest = rest - F.col(f"l{i}{k}") * F.col(f"l{j}{k}")
            # Rounding can only make a pivot smaller than the tolerance itself.
            out = out.withColumn(f"l{i}{j}", F.sqrt(F.greatest(rest, F.lit(STATISTICS[name] ** 2 / 2))) if i == j else rest / F.col(f"l{j}{j}"))
    logdet = sum((2 * F.log(F.col(f"l{i}{i}")) for i in range(1, len(names))), 2 * F.log(F.col("l00")))
    return write_stage(out.select("group", *[f"m{i}" for i in range(len(names))], *[f"l{i}{j}" for i in range(len(names)) for j in range(i + 1)], logdet.alias("logdet")), "estimate")


def _with_distance(rows: DataFrame, estimate: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` with the squared Mahalanobis distance from their group; null where the group has no estimate."""
    columns = rows.columns
    if estimate.count() <= MAX_BROADCAST_GROUPS:
        joined = rows.join(F.broadcast(estimate), "group", "left")
    else:
        salted = estimate.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64(*names), F.lit(SALTS)).cast("int")).join(salted, ["group", "salt"], "left")
    for i, name in enumerate(names):
        rest = F.col(name) - F.col(f"m{i}")
        for k in range(i):
            rest = rest - F.col(f"l{i}{k}") * F.col(f"z{k}")
        joined = joined.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    total = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(1, len(names))), F.col("z0") * F.col("z0"))
    return joined.select(*columns, total.alias("distance"))


def _nearest(placed: DataFrame, share: float) -> DataFrame:
    """The rows of each group up to the distance bin that holds its h-th row."""
    binned = placed.withColumn("bin", F.floor(F.log2(F.col("distance") + 1e-9) * BINS))
    counted = binned.groupBy("group", "bin").agg(F.count(F.lit(1)).alias("n"))
    lists = counted.groupBy("group").agg(F.sort_array(F.collect_list(F.struct("bin", "n"))).alias("bins"), F.sum("n").alias("total"))
    last = F.aggregate(
        "bins", F.struct(F.lit(0).cast("long").alias("n"), F.lit(None).cast("long").alias("bin")),
        lambda a, x: F.struct((a["n"] + x["n"]).alias("n"), F.when(a["bin"].isNull() & (a["n"] + x["n"] >= math.nextafter(share, 1) * F.col("total")), x["bin"]).otherwise(a["bin"]).alias("bin")),
        lambda a: a["bin"],
    )
    limits = write_stage(lists.select("group", F.coalesce(last, F.lit(1 << 40)).alias("last")), "limits")
    if limits.count() <= MAX_BROADCAST_GROUPS:
        joined = binned.join(F.broadcast(limits), "group")
    else:
        salted = limits.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = binned.withColumn("salt", F.pmod(F.xxhash64("distance"), F.lit(SALTS)).cast("int")).join(salted, ["group", "salt"])
    return joined.where("bin <= last").drop("bin", "last", "salt")
