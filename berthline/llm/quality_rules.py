"""Quality rules: base counts and robust multivariate outliers.

The minimum covariance determinant is found per group (language and source) by
concentration steps over a narrow table of statistic vectors; texts are read
once.  A step is one pass: squared distances fall into fine logarithmic bins,
(group, bin) sums are combined before the shuffle, and the bins up to the
wanted share give the next mean and covariance.  DataFrame functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SPACE = "[ \\t-\\r]"                 # the white space of the word rule
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "[#*$%&|<>]"

# Statistic -> smallest standard deviation it is judged by.  A group whose
# documents agree in a statistic (all copies, no symbols at all) would
# otherwise reject any document that differs in the least.  A floor must stay
# well below reach / sqrt(cutoff), or its statistic can reject nothing: the
# repeated lines reach 1, the repeated words sqrt(0.5), where the base rule ends.
FLOORS = {
    "ln_words": 0.5,            # ln(1 + words)
    "ln_word_length": 0.1,      # ln of the mean word length
    "root_symbols": 0.03,       # square root of symbols per word character
    "root_dup_lines": 0.15,     # square root of the share of repeated lines
    "root_repeats": 0.105,      # square root of the share of repeated words
}
STATS = list(FLOORS)
P = len(STATS)
SALTS = 64                  # join keys a group is dealt over
PAIRS = [(i, j) for i in range(P) for j in range(i + 1)]


@dataclass(frozen=True)
class Settings:
    min_words: int = 50
    max_repeat_percent: int = 50
    share: float = 0.75          # of a group in the concentrated half
    steps: int = 4               # concentration steps from each start
    reweight: float = 0.975      # chi-square level of the final reweighting
    level: float = 1 - 1e-6      # chi-square level of the verdict
    min_group: int = 50          # smaller groups pool by language, then together
    bins_per_e: int = 20         # distance bins per factor e

    @property
    def cutoff(self) -> float:
        """Squared distance beyond which a document goes (35.9)."""
        return chi2_quantile(self.level, P)


# ---------------------------------------------------------------- base counts
def _word_array(text: Column) -> Column:
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


def base_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """`docs` without its text, with n_words, word_chars, n_symbols, n_lines,
    n_dup_lines and n_repeat_words.  Windows of three words are compared by
    64-bit hash; positions that occur twice are found by one sort per text."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keep = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^ \\t-\\r]"))
    d = docs.select(*keep, _word_array(text).alias("__w"), lines.alias("__l"),
                    F.regexp_count(text, F.lit(SYMBOLS)).cast("long").alias("n_symbols"))
    n = F.size("__w")
    windows = F.when(n > 2, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(
        F.get("__w", i), F.get("__w", i + 1), F.get("__w", i + 2)))).otherwise(F.array().cast("array<bigint>"))
    d = d.select(*keep, "n_symbols", n.cast("long").alias("n_words"),
                 F.length(F.array_join("__w", "")).cast("long").alias("word_chars"),
                 F.size("__l").cast("long").alias("n_lines"),
                 (F.size("__l") - F.size(F.array_distinct("__l"))).cast("long").alias("n_dup_lines"),
                 windows.alias("__h"))
    counts = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    ordered = F.when(F.size(F.array_distinct("__h")) < F.size("__h"), F.sort_array(
        F.transform("__h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))))
    d = d.select(*keep, *counts, ordered.alias("__s"))
    twice = F.filter("__s", lambda s, i: (F.coalesce(F.get("__s", i - 1)["h"] == s["h"], F.lit(False)))
                     | (F.coalesce(F.get("__s", i + 1)["h"] == s["h"], F.lit(False))))
    d = d.select(*keep, *counts, F.sort_array(F.transform(twice, lambda s: s["i"])).alias("__at"))
    covered = F.aggregate(
        F.transform("__at", lambda at, k: F.least(F.lit(3), F.coalesce(F.get("__at", k + 1) - at, F.lit(3)))),
        F.lit(0).cast("long"), lambda total, x: total + x)
    return d.select(*keep, *counts, F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"))


def _statistics() -> list[Column]:
    words, chars = F.col("n_words"), F.greatest(F.col("word_chars"), F.lit(1))
    return [F.log1p(words), F.log(chars / F.greatest(words, F.lit(1))), F.sqrt(F.col("n_symbols") / chars),
            F.sqrt(F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))),
            F.sqrt(F.col("n_repeat_words") / F.greatest(words, F.lit(1)))]


# ---------------------------------------------------------------- chi-square
def chi2_cdf(x: float, k: int) -> float:
    """Chi-square distribution function for odd k."""
    total, term = 0.0, math.sqrt(x)
    for j in range(1, k, 2):
        total += term
        term *= x / (j + 2)
    return math.erf(math.sqrt(x / 2)) - math.sqrt(2 / math.pi) * math.exp(-x / 2) * total


def chi2_quantile(p: float, k: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if chi2_cdf(mid, k) < p else (low, mid)
    return (low + high) / 2


def consistency(share: float) -> float:
    """Factor that makes the covariance of the innermost `share` right for normal data."""
    return share / chi2_cdf(chi2_quantile(share, P), P + 2)


# ---------------------------------------------------------------- estimates
def _sums() -> list[Column]:
    xs = [F.col(s) for s in STATS]
    return [F.count("*").alias("n"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(xs)],
            *[F.sum(xs[i] * xs[j]).alias(f"q{i}{j}") for i, j in PAIRS]]


_SUM_COLS = ["n", *[f"s{i}" for i in range(P)], *[f"q{i}{j}" for i, j in PAIRS]]


def _with_inverse(params: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, m*, c*) -> (keys, m*, p*, ln_det): the inverse of the covariance c with
    the floors added to its diagonal, by elimination one pivot a step."""
    means = [f"m{i}" for i in range(P)]
    now = params.select(*keys, *means, F.lit(0.0).alias("ln_det"), *[
        (F.col(f"c{i}{j}") + (FLOORS[STATS[i]] ** 2 if i == j else 0.0)).alias(f"a{i}{j}") for i, j in PAIRS])
    at = lambda i, j: F.col(f"a{max(i, j)}{min(i, j)}")  # noqa: E731  symmetric up to the sweep's sign
    for k in range(P):                                   # sweep operator
        pivot = at(k, k)
        now = now.select(*keys, *means, (F.col("ln_det") + F.log(pivot)).alias("ln_det"), *[
            (-1 / pivot if i == j == k else at(i, j) / pivot if k in (i, j)
             else at(i, j) - at(i, k) * at(k, j) / pivot).alias(f"a{i}{j}") for i, j in PAIRS])
    return now.select(*keys, *means, "ln_det", *[(-F.col(f"a{i}{j}")).alias(f"p{i}{j}") for i, j in PAIRS])


def _from_sums(sums: DataFrame, keys: list[str], factor: float) -> DataFrame:
    mean = [F.col(f"s{i}") / F.col("n") for i in range(P)]
    return _with_inverse(sums.select(*keys, *[m.alias(f"m{i}") for i, m in enumerate(mean)], *[
        ((F.col(f"q{i}{j}") / F.col("n") - mean[i] * mean[j]) * factor).alias(f"c{i}{j}") for i, j in PAIRS]), keys)


def _distance2() -> Column:
    """Squared Mahalanobis distance of the row's statistics under its joined estimate."""
    d = [F.col(s) - F.col(f"m{i}") for i, s in enumerate(STATS)]
    return F.greatest(F.lit(0.0), sum(
        (d[i] * d[j] * F.col(f"p{i}{j}") * (1 if i == j else 2) for i, j in PAIRS), F.lit(0.0)))


def _with_params(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Rows with the estimates of their group.  A third of all rows may share a group, so
    a group's rows are dealt over SALTS join keys and its one estimate is copied."""
    copies = params.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.join(copies, ["grp", "salt"]).drop("salt")


def _starts(rows: DataFrame) -> DataFrame:
    """Two deterministic starts a group: medians with a diagonal of quartile scales
    (start 0), and the same with the correlations of tanh-squashed values (start 1)."""
    quart = rows.groupBy("grp").agg(*[
        F.percentile_approx(s, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), 10000).alias(f"z{i}")
        for i, s in enumerate(STATS)])
    centre = written(quart.select("grp", *[F.get(f"z{i}", F.lit(1)).alias(f"m{i}") for i in range(P)], *[
        F.greatest((F.get(f"z{i}", F.lit(2)) - F.get(f"z{i}", F.lit(0))) / 1.349, F.lit(FLOORS[s])).alias(f"d{i}")
        for i, s in enumerate(STATS)]), "mcd-centre")
    squashed = _with_params(rows, centre).select("grp", *[
        F.tanh((F.col(s) - F.col(f"m{i}")) / F.col(f"d{i}")).alias(s) for i, s in enumerate(STATS)])
    sums = squashed.groupBy("grp").agg(*_sums()).join(centre, "grp")
    cov = lambda i, j: F.col(f"q{i}{j}") / F.col("n") - F.col(f"s{i}") * F.col(f"s{j}") / F.col("n") ** 2
    spread = lambda i: F.sqrt(F.greatest(cov(i, i), F.lit(1e-12)))
    means, scale = [f"m{i}" for i in range(P)], lambda i, j: F.col(f"d{i}") * F.col(f"d{j}")
    diagonal = centre.select("grp", F.lit(0).alias("start"), *means, *[
        (scale(i, j) if i == j else F.lit(0.0)).alias(f"c{i}{j}") for i, j in PAIRS])
    squash = sums.select("grp", F.lit(1).alias("start"), *means, *[
        (scale(i, j) * (1.0 if i == j else 0.95 * cov(i, j) / spread(i) / spread(j))).alias(f"c{i}{j}")
        for i, j in PAIRS])
    return _with_inverse(diagonal.unionByName(squash), ["grp", "start"])


def _step(rows: DataFrame, params: DataFrame, conf: Settings) -> DataFrame:
    """One concentration step for every group and start."""
    keys = ["grp", "start"]
    binned = _with_params(rows, params).withColumn(
        "bin", F.floor(F.log(_distance2() + 1e-12) * conf.bins_per_e))
    per_bin = binned.groupBy(*keys, "bin").agg(*_sums())
    upto = Window.partitionBy(*keys).orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*keys)
    inner = per_bin.withColumn("before", F.coalesce(F.sum("n").over(upto), F.lit(0))).withColumn(
        "wanted", F.ceil(F.sum("n").over(whole) * conf.share)).where("before < wanted")
    sums = inner.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in _SUM_COLS])
    return _from_sums(sums, keys, consistency(conf.share))


def estimates(rows: DataFrame, conf: Settings) -> DataFrame:
    """`rows(grp, salt, statistics)` -> (grp, mean, inverse covariance): the start with the
    smaller determinant, reweighted by all rows within the chi-square level."""
    params = written(_starts(rows), "mcd-start")
    for _ in range(conf.steps):
        params = written(_step(rows, params, conf), "mcd-step")
    cols = [c for c in params.columns if c not in ("grp", "start", "ln_det")]
    best = params.groupBy("grp").agg(F.min_by(F.struct(*cols), F.struct("ln_det", "start")).alias("b")).select(
        "grp", "b.*")
    inside = _with_params(rows, best).where(_distance2() <= chi2_quantile(conf.reweight, P))
    sums = inside.groupBy("grp").agg(*_sums())
    again = _from_sums(sums, ["grp"], consistency(conf.reweight)).drop("ln_det")
    return written(best.join(again.select(F.col("grp"), F.struct(*cols).alias("r")), "grp", "left").select(
        "grp", F.coalesce("r", F.struct(*cols)).alias("b")).select("grp", "b.*"), "mcd-estimate")


def _groups(passed: DataFrame, conf: Settings) -> DataFrame:
    """(key, grp): a (language, source) pair of its own, or pooled with the other small
    ones of its language, or with all that are left.  One row a pair."""
    pairs = passed.groupBy("key", "lang_key").agg(F.count("*").alias("n"))
    small = F.col("n") < conf.min_group
    pooled = F.sum(F.when(small, F.col("n"))).over(Window.partitionBy("lang_key"))
    return pairs.select("key", F.when(~small, F.col("key")).when(
        pooled >= conf.min_group, F.concat(F.lit("pooled "), "lang_key")).otherwise(F.lit("pooled")).alias("grp"))


def judge(docs: DataFrame, conf: Settings = Settings(), id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang", source_col: str = "source", carry: tuple[str, ...] = ()) -> DataFrame:
    """One row per row of `docs`: doc_id, the columns named in `carry`, the base counts,
    base_failed, distance2 (squared, null where the base rules fail), kept.

    A null text has no words and fails; null languages and sources are values of
    their own; null and repeated ids keep their rows.  Estimates use every
    document that passes the base rules.  Other columns are not read.  An
    empty table gives an empty table."""
    lang, source = F.col(f"`{lang_col}`"), F.col(f"`{source_col}`")
    picked = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"), *[F.col(f"`{c}`") for c in carry],
        F.to_json(F.struct(lang.alias("l"), source.alias("s"))).alias("key"),
        F.to_json(F.struct(lang.alias("l"))).alias("lang_key"), F.col(f"`{text_col}`").alias("text"))
    failed = (F.col("n_words") < conf.min_words) | (
        100 * F.col("n_repeat_words") > conf.max_repeat_percent * F.col("n_words"))
    stats = written(base_counts(picked).withColumn("base_failed", failed).withColumns(
        dict(zip(STATS, _statistics()))), "quality-stats")
    groups = _groups(stats.where("not base_failed"), conf)
    salt = F.pmod(F.xxhash64("doc_id", *STATS), F.lit(SALTS)).cast("int")
    rows = written(stats.where("not base_failed").join(groups, "key").withColumn("salt", salt), "quality-groups")
    scored = _with_params(rows, estimates(rows, conf)).withColumn("distance2", _distance2())
    out = ["doc_id", *carry, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    return scored.select(*out, "distance2", (F.col("distance2") <= conf.cutoff).alias("kept")).unionByName(
        stats.where("base_failed").select(*out, F.lit(None).cast("double").alias("distance2"),
                                          F.lit(False).alias("kept")))
