"""Quality rules: base counts of a text, and a robust multivariate outlier test per
language and source.

Base counts come from array functions on the words and lines of a row; nothing is shuffled
for them.  The shape of a text is five transformed statistics (``FEATURES``).  For each
(language, source) the minimum covariance determinant is estimated from the rows that pass
the base rules:

* starts: the median with the median absolute deviation, and the mean with the covariance
  of all rows; concentration steps from each, the start with the smaller determinant wins;
* a concentration step takes the ``KEEP`` share of rows with the smallest Mahalanobis
  distances and computes mean and covariance again.  The share is cut on a histogram of
  log distances (fixed bins, added up map-side), so no group is ever sorted in one task;
* the covariance has a floor for each statistic (``FLOORS``): many groups have no spread at
  all in, say, symbols, and a few symbols must not reject a clean text;
* the winning covariance is scaled to put the median distance at that of the chi-squared
  distribution; that gives ``distance``;
* a count in a short text says little: the verdict takes the distance again with the
  measurement noise of the text's own length added to the variances (``noise``), and rejects
  texts beyond ``CUTOFF``.

Groups with fewer than ``MIN_ROWS`` such rows are pooled by language, languages that stay
below it are pooled together.  If those are still fewer, they get the estimate of all rows of
their language, or of all rows when the language has too few; only a table with fewer than
``MIN_ROWS`` such rows is kept as it is.

A null text has no words and fails the base rules; null languages and sources are groups of
their own.  Repeated rows count each, rows at one distance are kept or rejected
together.  Texts of any length are counted whole; other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kestrel.llm.common import SPACE_PATTERN, bind, words, written

FEATURES = ("f_length", "f_word", "f_symbols", "f_lines", "f_repeats")
#: Least standard deviation of each feature, in its own unit.
FLOORS = (0.25, 0.07, 0.25, 0.1, 0.1)
KEEP = 0.75
STEPS = 4
MIN_ROWS = 100
#: Chi-squared with 5 degrees of freedom: its median, and the cutoff (upper tail 0.001).
CHI2_MEDIAN = 4.351
CUTOFF = 20.515
#: Standard deviation of a word's length over its mean; words in one repeated phrase and its first copy.
WORD_SPREAD, PHRASE = 0.5, 6
#: Histogram of log2 of squared distances: BINS_PER_UNIT bins to a doubling, from 2**-20 to 2**40.
BINS_PER_UNIT, BIN_LOW, BIN_HIGH = 32, -20, 40
#: Rows of the table of estimates up to which it is broadcast (30 numbers each).
FEW_GROUPS = 10_000
SALTS = 64

P = len(FEATURES)
LOWER = [(i, j) for i in range(P) for j in range(i + 1)]


# ------------------------------------------------------------------ base counts
def repeated_words(w: Column) -> Column:
    """Words that lie in a 3-word window found twice or more in the array ``w`` of words."""
    windows = F.when(F.size(w) < 3, F.array().cast("array<struct<h:bigint,i:int>>")).otherwise(
        F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(
            F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i"))))

    def places(s: Column) -> Column:
        twin = F.filter(s, lambda x, k: (x["h"] == F.get(s, k - 1)["h"]) | (x["h"] == F.get(s, k + 1)["h"]))
        return F.array_sort(F.transform(twin, lambda x: x["i"]))

    def covered(p: Column) -> Column:
        step = F.transform(p, lambda x, k: F.least(F.lit(3), F.coalesce(F.get(p, k + 1) - x, F.lit(3))))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    return bind(F.sort_array(windows), lambda s: bind(places(s), covered))


def base_counts(df: DataFrame, id_col: str, text_col: str, *more: str) -> DataFrame:
    """(id, *more, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.btrim(x, F.lit(" \t\n\x0b\x0c\r"))) > 0)
    counts = bind(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"), repeated_words(w).cast("long").alias("n_repeat_words")))
    dups = bind(lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
    return (df.select(F.col(id_col).alias("id"), *[F.col(f"`{c}`").alias(f"g{i}") for i, c in enumerate(more)],
                      counts.alias("c"),
                      F.length(F.regexp_replace(text, SPACE_PATTERN, "")).cast("long").alias("word_chars"),
                      F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")).cast("long").alias("n_symbols"),
                      dups.cast("long").alias("n_dup_lines"),
                      F.length(F.regexp_replace(text, r"[^\n]+", "")).cast("long").alias("n_breaks"))
            .withColumns({"n_words": F.col("c.n_words"), "n_repeat_words": F.col("c.n_repeat_words")})
            .drop("c")
            .withColumn("base_failed", (F.col("n_words") < 50)
                        | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))))


def features() -> list[Column]:
    """The transformed statistics, in the order of FEATURES."""
    n = F.greatest(F.col("n_words"), F.lit(1))
    return [F.log1p(F.col("n_words").cast("double")),
            F.log(F.greatest(F.col("word_chars") / n, F.lit(0.1))),
            F.log1p(100.0 * F.col("n_symbols") / n),
            F.log1p(10.0 * F.col("n_dup_lines") / (F.col("n_breaks") + 1)),
            F.log1p(10.0 * F.col("n_repeat_words") / n)]


def noise() -> list[Column]:
    """Variances of FEATURES that come from the length of the text alone.  Symbols, repeated lines
    and repeated phrases are counts of events (variance: the count, at least one event) put
    through the logarithm; a repeated line makes the words of two lines repeated words."""
    n = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    lines = (F.col("n_breaks") + 1).cast("double")
    phrase = F.greatest(F.lit(float(PHRASE)), F.when(F.col("n_dup_lines") > 0, 2 * n / lines).otherwise(F.lit(0.0)))

    def logged(factor, count, size, event):
        """Variance of log1p(factor * count / size) where events of ``event`` each make the count."""
        return F.pow(factor / size, F.lit(2.0)) * event * F.greatest(count, event) / F.pow(1 + factor * count / size, F.lit(2.0))
    return [F.lit(0.0),
            WORD_SPREAD ** 2 / n,
            logged(100.0, F.col("n_symbols"), n, F.lit(1.0)),
            logged(10.0, F.col("n_dup_lines"), lines, F.lit(1.0)),
            logged(10.0, F.col("n_repeat_words"), n, phrase)]


# ------------------------------------------------------------------ estimates
def _by_group(rows: DataFrame, params: DataFrame, keys: list[str]) -> DataFrame:
    """Rows with the estimates of their group.  The estimates are broadcast behind a check of
    their number; otherwise each is repeated for SALTS salts, as one group may hold a third of the rows."""
    if params.limit(FEW_GROUPS + 1).count() <= FEW_GROUPS:
        return rows.join(F.broadcast(params), keys)
    salted = params.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    # a salt from the row itself: the same one when a lost task runs again
    return rows.withColumn("_salt", F.pmod(F.xxhash64(*FEATURES), F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"]).drop("_salt")


def _cholesky(params: DataFrame) -> DataFrame:
    """From m0.. and c_i_j (with floors added) the lower triangle l_i_j and logdet."""
    for i, j in LOWER:
        s = F.col(f"c_{i}_{j}")
        for k in range(j):
            s = s - F.col(f"l_{i}_{k}") * F.col(f"l_{j}_{k}")
        params = params.withColumn(f"l_{i}_{j}", F.sqrt(F.greatest(s, F.lit(1e-12))) if i == j else s / F.col(f"l_{j}_{j}"))
    return params.withColumn("logdet", sum((2 * F.log(F.col(f"l_{i}_{i}")) for i in range(P)), F.lit(0.0)))


def _distance(df: DataFrame) -> DataFrame:
    """Adds d2, the squared Mahalanobis distance, by forward substitution."""
    for i in range(P):
        z = F.col(FEATURES[i]) - F.col(f"m{i}")
        for k in range(i):
            z = z - F.col(f"l_{i}_{k}") * F.col(f"z{k}")
        df = df.withColumn(f"z{i}", z / F.col(f"l_{i}_{i}"))
    return df.withColumn("d2", sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(P)), F.lit(0.0)))


def _moments(df: DataFrame, keys: list[str]) -> DataFrame:
    """Mean and covariance (floors added) of each group, and its Cholesky factor."""
    sums = [F.avg(F.col(FEATURES[i])).alias(f"m{i}") for i in range(P)]
    cross = [F.covar_pop(FEATURES[i], FEATURES[j]).alias(f"c_{i}_{j}") for i, j in LOWER]
    out = df.groupBy(*keys).agg(*sums, *cross)
    for i in range(P):
        out = out.withColumn(f"c_{i}_{i}", F.col(f"c_{i}_{i}") + FLOORS[i] ** 2)
    return _cholesky(out)


def _bin(x: Column) -> Column:
    low, high = BIN_LOW * BINS_PER_UNIT, BIN_HIGH * BINS_PER_UNIT
    return F.least(F.greatest(F.floor(F.log2(F.greatest(x, F.lit(1e-30))) * BINS_PER_UNIT), F.lit(low)), F.lit(high))


def _quantile_bins(df: DataFrame, keys: list[str], bin_col: str, share: float) -> DataFrame:
    """(keys, cut): the smallest bin up to which each group has ``share`` of its rows."""
    counts = df.groupBy(*keys, F.col(bin_col).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    # at most (BIN_HIGH - BIN_LOW) * BINS_PER_UNIT + 1 rows for a group
    w = Window.partitionBy(*keys)
    return (counts.withColumn("upto", F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)))
            .withColumn("all", F.sum("n").over(w))
            .where(F.col("upto") >= F.lit(share) * F.col("all"))
            .groupBy(*keys).agg(F.min("bin").alias("cut"), F.first("all").alias("n_rows")))


#: Medians of features are cut on bins of this width; all features are logarithms below 100.
FEATURE_BIN = 1 / 256


def _medians(rows: DataFrame, values: list[Column]) -> DataFrame:
    """(g, v: array of medians) for the given values of each row, from fixed bins."""
    long = rows.select("g", F.posexplode(F.array(*[F.floor(v / FEATURE_BIN) for v in values])).alias("k", "b"))
    cut = _quantile_bins(long, ["g", "k"], "b", 0.5)
    return cut.groupBy("g").pivot("k", list(range(P))).agg(F.first((F.col("cut") + 0.5) * FEATURE_BIN))


def _robust_start(rows: DataFrame) -> DataFrame:
    """Median and median absolute deviation, as a diagonal covariance."""
    med = written(_medians(rows, [F.col(f) for f in FEATURES])
                  .select("g", *[F.col(str(i)).alias(f"m{i}") for i in range(P)]), "mcd-median")
    off = _by_group(rows, med, ["g"])
    mad = _medians(off, [F.abs(F.col(FEATURES[i]) - F.col(f"m{i}")) for i in range(P)])
    out = med.join(mad, "g")
    for i, j in LOWER:
        out = out.withColumn(f"c_{i}_{j}", F.pow(F.col(str(i)) * 1.4826, F.lit(2.0)) + FLOORS[i] ** 2 if i == j else F.lit(0.0))
    return _cholesky(out.drop(*[str(i) for i in range(P)]))


def estimate(rows: DataFrame, keep: float = KEEP, steps: int = STEPS) -> DataFrame:
    """The estimates of each group g of ``rows`` (g, features): m0.., l_i_j, scale."""
    params = written(_robust_start(rows).withColumn("start", F.lit(0)).unionByName(
        _moments(rows, ["g"]).withColumn("start", F.lit(1))), "mcd-start")
    for step in range(steps):
        dist = _distance(_by_group(rows, params, ["g"])).withColumn("bin", _bin(F.col("d2")))
        cut = written(_quantile_bins(dist, ["g", "start"], "bin", keep).drop("n_rows"), f"mcd-cut-{step}")
        inner = _by_group(dist.select("g", "start", "bin", *FEATURES), cut, ["g", "start"]).where(F.col("bin") <= F.col("cut"))
        params = written(_moments(inner, ["g", "start"]), f"mcd-{step}")
    best = params.groupBy("g").agg(F.min_by("start", F.struct("logdet", "start")).alias("start"))
    params = params.join(best, ["g", "start"]).drop("start")
    dist = _distance(_by_group(rows, written(params, "mcd-best"), ["g"])).withColumn("bin", _bin(F.col("d2")))
    half = _quantile_bins(dist, ["g"], "bin", 0.5)
    # a median below that of chi-squared (floors hold the covariance up) is left as it is
    scale = F.greatest(F.pow(F.lit(2.0), (F.col("cut") + 0.5) / BINS_PER_UNIT) / CHI2_MEDIAN, F.lit(1.0))
    return written(params.join(half.select("g", scale.alias("scale"), "n_rows"), "g"), "mcd-estimates")


def _last_rows(groups: DataFrame, min_rows: int) -> DataFrame:
    """(tag, g, into): the group that judges the rows of each tag, and the groups they are estimated in.
    A rest too small for an estimate is judged by its languages, or by all rows."""
    own = groups.select("tag", "lang", "g", F.array("g").alias("into"))
    left = groups.where("g = '0'").agg(F.sum("n")).first()[0]
    if left is None or left >= min_rows:
        return own
    # fewer than min_rows languages
    last = (groups.groupBy("lang").agg(F.sum("n").alias("n"), F.max(F.col("g") == "0").alias("left")).where("left")
            .select("lang", F.when(F.col("n") >= min_rows, F.concat(F.lit("3"), "lang")).otherwise(F.lit("4")).alias("last")))
    last = written(last, "rule-last")
    everything = [F.lit("4")] if last.where("last = '4'").limit(1).count() else []
    own = own.join(F.broadcast(last), "lang", "left")
    into = F.array(F.when(F.col("g") != "0", F.col("g")), F.col("last"), *everything)
    return written(own.select("tag", F.when(F.col("g") == "0", F.col("last")).otherwise(F.col("g")).alias("g"),
                              F.array_distinct(F.array_compact(into)).alias("into")), "rule-last-groups")


def judge(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          source_col: str = "source", cutoff: float = CUTOFF, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per input row: id, the base counts, base_failed, distance (null where base_failed
    or no estimate) and kept."""
    counts = base_counts(df, id_col, text_col, lang_col, source_col)
    counts = counts.select("*", *[f.alias(n) for f, n in zip(features(), FEATURES)])
    counts = written(counts, "rule-counts")
    passed = counts.where(~F.col("base_failed"))

    # the group of a row: (lang, source), or the language, or all the rest
    def tag(*c):
        return F.concat_ws("\x1f", *[F.coalesce(F.concat(F.lit("="), F.col(x)), F.lit("-")) for x in c])
    small = (passed.groupBy("g0", "g1").agg(F.count(F.lit(1)).alias("n"))
             .withColumn("by_lang", F.when(F.col("n") < min_rows, F.col("n")).otherwise(F.lit(0))))
    groups = written(small.withColumn("n_lang", F.sum("by_lang").over(Window.partitionBy("g0")))
                     .select(tag("g0", "g1").alias("tag"), tag("g0").alias("lang"), "n",
                             F.when(F.col("n") >= min_rows, F.concat(F.lit("2"), tag("g0", "g1")))
                             .when(F.col("n_lang") >= min_rows, F.concat(F.lit("1"), tag("g0")))
                             .otherwise(F.lit("0")).alias("g")), "rule-groups")
    groups = _last_rows(groups, min_rows)
    rows = written(_by_group(passed.select(tag("g0", "g1").alias("tag"), *FEATURES), groups.select("tag", "into"), ["tag"])
                   .select(F.explode("into").alias("g"), *FEATURES), "rule-features")
    est = estimate(rows).where(F.col("n_rows") >= min_rows)
    limits = written(groups.select("tag", "g").join(est, "g", "left").drop("g"), "rule-limits")
    scored = _distance(_by_group(passed.withColumn("tag", tag("g0", "g1")), limits, ["tag"]))
    base = ["id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    scored = scored.withColumn("distance", F.col("d2") / F.col("scale"))
    # the verdict: the scaled covariance with the row's own noise
    widened = {f"c_{i}_{j}": F.col(f"c_{i}_{j}") * F.col("scale") + (noise()[i] if i == j else F.lit(0.0)) for i, j in LOWER}
    judged = _distance(_cholesky(scored.withColumns(widened)))
    return (judged.select(*base, "distance", F.coalesce(F.col("d2") <= cutoff, F.lit(True)).alias("kept"))
            .unionByName(counts.where(F.col("base_failed"))
                         .select(*base, F.lit(None).cast("double").alias("distance"), F.lit(False).alias("kept"))))
