"""Quality rules: robust multivariate outliers by minimum covariance determinant.

Every document gives a vector of statistics, each put on a log scale: mean word length, symbols to letters, repeated
lines to words, repeated words to words. Per language and source the mean and covariance of the share SUBSET of a group's
documents whose covariance has the least determinant are sought from several starts: one from medians and quartiles,
RANDOM from few documents drawn by hash. FIRST concentration steps from each start keep the SUBSET share with the least
Mahalanobis distance and estimate anew; the start whose covariance then has the least determinant goes on for STEPS more,
and of all its estimates that with the least determinant is the group's. A document that passes the base rules is
rejected if its squared distance is above CUTOFF, the 0.999 quantile of chi-square with four degrees of freedom. A group
with under LEAST documents that pass is judged with the estimate of its whole language, and a language with under LEAST
with that of the whole table; both come from all documents that pass, those of large groups too.

Most documents have no symbol, repeated line or repeated word at all, so the least covariance of these statistics is
zero and its inverse has no bound. The covariance is therefore regularised before its determinant is taken: the squares of
FLOORS are added to its diagonal. A floor is what one accident changes in the shortest document that passes the base rules
(50 words of four letters): a pair of symbols, one repeated line, one window of three words that occurs twice.

Main path: DataFrame functions only. Text is read once; the steps run over the checkpointed statistics, groups are
summed before they are shuffled, and medians and the nearest share come from histograms with fixed bins, so no group is
ever gathered or sorted. Tables of groups are sent to every task up to SENT rows and joined by salted keys beyond.

Cases: a null text has no words and fails the base rules; null languages and sources are groups like others; documents
that fail the base rules take no part in the estimates; repeated rows count as often as they stand there; an empty table
gives no rows; other columns of any name are kept by accepted() and ignored by judge().
"""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm import common

SUBSET = 0.75
RANDOM = 3
DRAWN = 40
FIRST = 2
STEPS = 3
CUTOFF = 18.47
FLOORS = (0.25, math.log1p(100 * 2 / 200), math.log1p(100 / 50), math.log1p(100 * 6 / 50))
LEAST = 60
SYMBOLS = "[#*$%&|<>]"
FINE = 128
SPAN = 12.0


FEW = 32


def counted(docs: DataFrame, *kept: Column) -> DataFrame:
    """The kept columns, lang, source and the counts of every document."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        *kept,
        F.col("lang").cast("string").alias("lang"),
        F.col("source").cast("string").alias("source"),
        F.transform(F.array_remove(F.split(text, common.SPACES), ""), lambda w: F.xxhash64(w)).alias("_words"),
        (F.length(text) - F.regexp_count(text, F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]")).alias("_lines"),
    )
    w = F.col("_words")
    rows = rows.withColumns(
        {
            "n_words": F.size(w).cast("long"),
            "n_dup_lines": (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"),
            "_windows": F.transform(F.slice(w, 1, F.greatest(F.size(w) - 2, F.lit(0))), lambda x, i: F.xxhash64(x, F.get(w, i + 1), F.get(w, i + 2))),
        }
    )
    rows = rows.withColumn("_sorted", F.sort_array("_windows"))
    s = F.col("_sorted")
    rows = rows.withColumn("_twice", F.array_distinct(F.filter(s, lambda x, i: F.coalesce(x == F.get(s, i + 1), F.lit(False)))))
    rows = rows.withColumn("_places", F.when(F.size("_twice") == 0, F.array().cast("array<int>")).when(F.size("_twice") <= FEW, _few_places()).otherwise(_many_places()))
    at = F.col("_places")
    covered = F.aggregate(F.transform(at, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(at, j + 1) - x, F.lit(3)))), F.lit(0).cast("long"), lambda total, x: total + x)
    return rows.withColumn("n_repeat_words", covered).drop("_words", "_lines", "_windows", "_sorted", "_twice", "_places")


def _few_places() -> Column:
    """Where windows that occur twice begin, for a few such windows."""
    return F.filter(F.transform("_windows", lambda x, i: F.when(F.array_contains(F.col("_twice"), x), i)), lambda x: x.isNotNull())


def _many_places() -> Column:
    """The same for any number of them: equal windows stand side by side when sorted with their places."""
    pairs = F.sort_array(F.transform("_windows", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    before = F.transform(F.slice(pairs, 1, F.size(pairs) - 1), lambda x: x["h"])
    after = F.transform(F.slice(pairs, 2, F.size(pairs)), lambda x: x["h"])
    same = F.zip_with(before, after, lambda x, y: x == y)
    marked = F.zip_with(F.zip_with(pairs, F.concat(F.array(F.lit(False)), same), lambda x, y: F.struct(x["i"].alias("i"), y.alias("y"))), F.concat(same, F.array(F.lit(False))), lambda x, z: F.when(x["y"] | z, x["i"]))
    return F.sort_array(F.filter(marked, lambda x: x.isNotNull()))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def vector() -> list[Column]:
    words, letters = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    ratio = lambda a, b: F.log1p(100.0 * F.col(a) / b)
    return [F.log1p(letters / words), ratio("n_symbols", letters), ratio("n_dup_lines", words), ratio("n_repeat_words", words)]


P = len(FLOORS)
X = [f"x{i}" for i in range(P)]


def _chi2(x: float, pairs: int) -> float:
    """Distribution function of chi-square with 2 * pairs degrees of freedom."""
    return 1 - math.exp(-x / 2) * sum((x / 2) ** k / math.factorial(k) for k in range(pairs))


def consistency(subset: float = SUBSET) -> float:
    """What the covariance of the nearest share must be multiplied by to be that of a normal distribution."""
    low, high = 0.0, 100.0
    for _ in range(80):
        low, high = ((low + high) / 2, high) if _chi2((low + high) / 2, P // 2) < subset else (low, (low + high) / 2)
    return subset / _chi2(low, P // 2 + 1)


def _groups(stats: DataFrame) -> DataFrame:
    """lang, source, grp: the group that each language and source is judged in; into: the groups in use that it counts for."""
    both = stats.groupBy("lang", "source").agg(F.sum(F.when(base_failed(), 0).otherwise(1)).alias("n"))
    whole = Window.partitionBy("lang")
    both = both.withColumn("of_lang", F.sum("n").over(whole)).withColumn("least", F.min("n").over(whole))
    own, lang = (F.to_json(F.struct(*names), {"ignoreNullFields": "false"}) for names in (("lang", "source"), ("lang",)))
    large, large_lang = F.col("n") >= LEAST, F.col("of_lang") >= LEAST
    name = F.when(large, own).when(large_lang, lang).otherwise("all")
    into = [F.when(large, own), F.when(large_lang & (F.col("least") < LEAST), lang)]
    groups = common.cut(both.select("lang", "source", name.alias("grp"), F.array_compact(F.array(*into)).alias("into")))
    if groups.filter("grp = 'all'").isEmpty():
        return groups
    return groups.withColumn("into", F.array_append("into", "all"))


def _robust_start(rows: DataFrame) -> DataFrame:
    """Start 0 of each group: medians, and variances from quartiles."""
    long = rows.select("grp", F.posexplode(F.array(*X)).alias("k", "x")).groupBy("grp", "k", F.floor(F.col("x") * FINE).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("grp", "k")
    long = long.withColumn("upto", F.sum("n").over(whole.orderBy("bin"))).withColumn("all", F.sum("n").over(whole))
    at = lambda q: (F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("bin"))) + 0.5) / FINE
    spread = long.groupBy("grp", "k").agg(at(0.5).alias("mid"), ((at(0.75) - at(0.25)) / 1.349).alias("sd"))
    mids = [F.max(F.when(F.col("k") == i, F.col("mid"))).alias(f"m{i}") for i in range(P)]
    variances = [F.max(F.when(F.col("k") == i, F.col("sd") * F.col("sd"))).alias(f"c{i}{i}") for i in range(P)]
    zero = [F.lit(0.0).alias(f"c{i}{j}") for i in range(P) for j in range(i)]
    return spread.groupBy("grp").agg(*mids, *variances).select("*", F.lit(0).alias("start"), *zero)


def _drawn_starts(rows: DataFrame, sizes: DataFrame) -> DataFrame:
    """Starts 1 to RANDOM of each group: mean and covariance of about DRAWN documents. sizes: grp, n."""
    draw = lambda i: F.pmod(F.xxhash64(F.lit(i), *X), F.lit(1 << 30)) * F.col("n") < DRAWN * float(1 << 30)
    starts = F.array_compact(F.array(*(F.when(draw(i), i) for i in range(1, RANDOM + 1))))
    return _moments(common.with_table(rows, sizes, ["grp"]).select("grp", *X, F.explode(starts).alias("start")), 1.0)


def _moments(rows: DataFrame, scale: float) -> DataFrame:
    sums = [F.avg(x).alias(f"m{i}") for i, x in enumerate(X)] + [F.avg(F.col(X[i]) * F.col(X[j])).alias(f"s{i}{j}") for i in range(P) for j in range(i + 1)]
    summed = rows.groupBy("grp", "start").agg(*sums)
    return summed.select("grp", "start", *(F.round(f"m{i}", 9).alias(f"m{i}") for i in range(P)), *(F.round(scale * (F.col(f"s{i}{j}") - F.col(f"m{i}") * F.col(f"m{j}")), 9).alias(f"c{i}{j}") for i in range(P) for j in range(i + 1)))


def factored(params: DataFrame) -> DataFrame:
    """The means, the Cholesky factor of the regularised covariance, and det, the logarithm of its determinant."""
    for i in range(P):
        for j in range(i + 1):
            total = F.col(f"c{i}{j}") + (FLOORS[i] ** 2 if i == j else 0.0) - reduce(add, (F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0))
            params = params.withColumn(f"l{i}{j}", F.sqrt(F.greatest(total, F.lit(1e-9))) if i == j else total / F.col(f"l{j}{j}"))
    det = F.round(2 * reduce(add, (F.log(f"l{i}{i}") for i in range(P))), 9)
    return params.withColumn("det", det)


FACTORS = [f"m{i}" for i in range(P)] + [f"l{i}{j}" for i in range(P) for j in range(i + 1)]


def _measured(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance; one row for each start of the row's group."""
    out = common.with_table(rows, factors.select("grp", "start", *FACTORS), ["grp"])
    for i in range(P):
        out = out.withColumn(f"z{i}", (F.col(X[i]) - F.col(f"m{i}") - reduce(add, (F.col(f"l{i}{k}") * F.col(f"z{k}") for k in range(i)), F.lit(0.0))) / F.col(f"l{i}{i}"))
    return out.withColumn("d2", reduce(add, (F.col(f"z{i}") * F.col(f"z{i}") for i in range(P))))


def concentrated(rows: DataFrame, factors: DataFrame) -> DataFrame:
    """One concentration step: means and covariances of the nearest share of each group, from each of its starts."""
    near = _measured(rows, factors).select("grp", "start", *X, F.floor(F.log1p("d2") * FINE).alias("bin"))
    bins = near.groupBy("grp", "start", "bin").agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy("grp", "start")
    bins = bins.withColumn("upto", F.sum("n").over(whole.orderBy("bin"))).withColumn("all", F.sum("n").over(whole))
    limit = common.cut(bins.filter(F.col("upto") >= SUBSET * F.col("all")).groupBy("grp", "start").agg(F.min("bin").alias("last")))
    return _moments(common.with_table(near, limit, ["grp", "start"]).filter("bin <= last"), consistency())


def _least(estimates: DataFrame, *order: str) -> DataFrame:
    """The estimate of each group with the least determinant, the first of equal ones."""
    kept = [c for c in estimates.columns if c != "grp"]
    best = estimates.groupBy("grp").agg(F.min_by(F.struct(*kept), F.struct("det", *order)).alias("e"))
    return best.select("grp", "e.*")


def estimates(stats: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The groups of languages and sources, and each group's factored estimate. stats: checkpointed statistics."""
    groups = _groups(stats)
    counting = groups.select("lang", "source", "into")
    groups = groups.select("lang", "source", "grp")
    rows = common.with_table(stats, counting, ["lang", "source"]).filter(~base_failed()).select(F.explode("into").alias("grp"), *(v.alias(k) for k, v in zip(X, vector(), strict=True)))
    sizes = common.cut(rows.groupBy("grp").agg(F.count(F.lit(1)).alias("n")))
    now = common.cut(factored(_robust_start(rows).unionByName(_drawn_starts(rows, sizes))))
    for _ in range(FIRST):
        now = common.cut(factored(concentrated(rows, now)))
    now = common.cut(_least(now, "start"))
    found = now.withColumn("step", F.lit(0))
    for step in range(1, STEPS + 1):
        now = common.cut(factored(concentrated(rows, now)))
        found = found.unionByName(now.withColumn("step", F.lit(step)))
    return groups, common.cut(_least(found, "step"))


def _judged(stats: DataFrame, groups: DataFrame, factors: DataFrame, cutoff: float) -> DataFrame:
    rows = common.with_table(stats, groups, ["lang", "source"]).select("*", *(v.alias(k) for k, v in zip(X, vector(), strict=True)))
    out = _measured(rows, factors).withColumn("base_failed", base_failed())
    return out.withColumn("kept", ~F.col("base_failed") & F.coalesce(F.col("d2") <= cutoff, F.lit(True)))


def judge(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """One row per document: the base counts, base_failed, kept, and the squared distance."""
    stats = common.cut(counted(docs, F.col("doc_id").cast("long").alias("doc_id")))
    out = _judged(stats, *estimates(stats), cutoff)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("d2", 6).alias("distance2"))


def accepted(docs: DataFrame, cutoff: float = CUTOFF) -> DataFrame:
    """The rows of docs that are kept. The counts are written with the rows, so no text is counted twice, and read apart from them for the estimates."""
    counts = common.cut(counted(docs, F.struct("*").alias("row")))
    groups, factors = estimates(common.cut(counts.drop("row")))
    return _judged(counts, groups, factors, cutoff).filter("kept").select("row.*")
