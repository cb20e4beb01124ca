"""Operator 7: quality rules, and robust multivariate outliers of each language and source.

Rules count what a text holds. Texts that pass them are then compared within their language and
source: the counts become five transformed numbers, whose centre and covariance come from the
minimum covariance determinant. From two starts, the medians with the quartiles and the mean with
the covariance of all, a concentration step refits mean and covariance on the ``KEPT_SHARE`` of
texts that lie closest, as long as that lessens the determinant; of the two, a group takes the
estimate of the smaller determinant. Texts whose squared Mahalanobis distance exceeds ``LIMIT``
are rejected.

Numbers are whole 256ths and sums are whole numbers, so results don't depend on the order of
rows. Each step sums by group and distance bin within the tasks, so a group that holds a third of
all rows is at most one row a bin and task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from locusmill.functions.basics import let
from locusmill.llm.shared import SPACES, table, written

# Limits of the rules, and the characters that count as symbols.
LEAST_WORDS, MOST_REPEATED_PERCENT, REPEAT_WORDS = 10, 20, 5
SYMBOLS = r"[#*$%&|<>]"

UNIT = 256
FEATURES = ("size", "word", "symbols", "lines", "repeats")
#: Spread below which a feature's differences are noise; added to its variance.
LEAST_SPREAD = {"size": 0.3, "word": 0.1, "symbols": 0.15, "lines": 0.15, "repeats": 0.15}
KEPT_SHARE, BINS = 0.75, 32
#: A step counts if it lessens the logarithm of the determinant by more.
LEAST_GAIN = 1e-6


def _chi_square(x: float, degrees: int) -> float:
    """Distribution function of chi-square with an odd number of degrees."""
    total, term = math.erf(math.sqrt(x / 2)), math.sqrt(2 * x / math.pi) * math.exp(-x / 2)
    for k in range(1, degrees - 1, 2):
        total -= term
        term *= x / (k + 2)
    return total


def _quantile(share: float, degrees: int) -> float:
    low, high = 0.0, 1000.0
    for _ in range(200):
        middle = (low + high) / 2
        low, high = (middle, high) if _chi_square(middle, degrees) < share else (low, middle)
    return low


P = len(FEATURES)
LIMIT = _quantile(0.9999, P)
#: Makes the covariance of the closest share that of all, for normal data.
CONSISTENCY = KEPT_SHARE / _chi_square(_quantile(KEPT_SHARE, P), P + 2)


def _repeated(windows: Column) -> Column:
    """Words in windows (as hashes) that occur twice or more."""
    def marked(placed: Column) -> Column:
        same = lambda k, j: F.get(placed, k)["h"] == F.get(placed, j)["h"]
        return F.transform(
            F.sequence(F.lit(0), F.size(placed) - 1),
            lambda k: F.when(same(k, k - 1) | same(k, k + 1), F.get(placed, k)["i"]),
        )

    placed = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    places = F.array_sort(F.filter(let(placed, marked), lambda x: x.isNotNull()))
    return F.aggregate(
        places,
        F.struct(F.lit(0).alias("words"), F.lit(-REPEAT_WORDS).alias("last")),
        lambda s, i: F.struct(
            (s["words"] + F.least(F.lit(REPEAT_WORDS), i - s["last"])).alias("words"), i.alias("last")
        ),
        lambda s: s["words"],
    )


def statistics(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` but ``text``, and the counts of each whole text.

    A null text has no words and no lines. Windows of words are compared by a 64-bit hash within
    their text.
    """
    others = [c for c in docs.columns if c != "text"]
    text = F.coalesce("text", F.lit(""))
    split = docs.select(
        *others,
        F.array_remove(F.split(text, f"[{SPACES}]+"), "").alias("_words"),
        F.filter(F.split(text, "\n", -1), lambda x: x.rlike(f"[^{SPACES}]")).alias("_lines"),
        F.regexp_count(text, F.lit(SYMBOLS)).alias("n_symbols"),
    )
    n_words = F.size("_words")
    hashes = F.transform(
        F.sequence(F.lit(1), n_words - REPEAT_WORDS + 1), lambda i: F.xxhash64(F.slice("_words", i, REPEAT_WORDS))
    )
    counted = split.select(
        *others,
        n_words.cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.col("n_symbols").cast("long").alias("n_symbols"),
        F.size("_lines").cast("long").alias("_n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.when(n_words >= REPEAT_WORDS, hashes).alias("_windows"),
    )
    repeated = F.when(
        F.col("_windows").isNull() | (F.size(F.array_distinct("_windows")) == F.size("_windows")), 0
    ).otherwise(_repeated(F.col("_windows")))
    return counted.select(
        *others, "n_words", "word_chars", "n_symbols", "n_dup_lines", "_n_lines", repeated.cast("long").alias("n_repeat_words")
    )


def _features() -> list[Column]:
    share = lambda part, whole: F.sqrt(F.col(part) / F.greatest(F.col(whole), F.lit(1)))
    values = {
        "size": F.log1p("n_words"),
        "word": F.log1p(F.col("word_chars") / F.greatest("n_words", F.lit(1))),
        "symbols": share("n_symbols", "word_chars"),
        "lines": share("n_dup_lines", "_n_lines"),
        "repeats": share("n_repeat_words", "n_words"),
    }
    return [F.round(v * UNIT).cast("long").alias(n) for n, v in values.items()]


def _robust_start(points: DataFrame) -> DataFrame:
    """Centre and spread of each feature from its quartiles; ``w_ij`` whitens."""
    long = points.select("group", F.explode(F.array(*[F.struct(F.lit(f).alias("f"), F.col(f).alias("x")) for f in FEATURES])).alias("v"))
    counts = long.groupBy("group", F.col("v.f").alias("f"), F.col("v.x").alias("x")).agg(F.count("*").alias("n"))
    by = Window.partitionBy("group", "f")
    ranked = counts.select(
        "group", "f", "x", F.sum("n").over(by.orderBy("x").rowsBetween(Window.unboundedPreceding, 0)).alias("upto"), F.sum("n").over(by).alias("all")
    )
    quartile = lambda q: F.min(F.when(F.col("upto") >= q * F.col("all"), F.col("x")))
    each = ranked.groupBy("group", "f").agg(
        (quartile(0.5) / UNIT).alias("m"), ((quartile(0.75) - quartile(0.25)) / UNIT / 1.349).alias("spread")
    )
    at = lambda f, c: F.max(F.when(F.col("f") == f, F.col(c)))
    wide = each.groupBy("group").agg(*[at(f, c).alias(f"{c}_{f}") for f in FEATURES for c in ("m", "spread")])
    whiten = [
        (1 / F.sqrt(F.col(f"spread_{f}") ** 2 + LEAST_SPREAD[f] ** 2) if i == j else F.lit(0.0)).alias(f"w_{i}{j}")
        for i, f in enumerate(FEATURES) for j in range(i + 1)
    ]
    return wide.select("group", *[f"m_{f}" for f in FEATURES], *whiten)


def _distance() -> Column:
    """Squared distance of a row from its group's centre, after whitening."""
    off = [F.col(f) / UNIT - F.col(f"m_{f}") for f in FEATURES]
    rows = []
    for i in range(P):
        z = sum((F.col(f"w_{i}{j}") * off[j] for j in range(1, i + 1)), F.col(f"w_{i}0") * off[0])
        rows.append(z * z)
    return sum(rows[1:], rows[0])


def _whitening(moments: DataFrame) -> DataFrame:
    """Inverse of the Cholesky factor of each covariance, from sums of features, and the logarithm
    of the covariance's determinant."""
    n = F.col("n")
    mean = {f: F.col(f"s_{f}") / n / UNIT for f in FEATURES}
    frame = moments.select(
        "group",
        "start",
        *[mean[f].alias(f"m_{f}") for f in FEATURES],
        *[
            (
                CONSISTENCY * (F.col(f"s_{f}_{g}") / n / UNIT**2 - mean[f] * mean[g])
                + (LEAST_SPREAD[f] ** 2 if f == g else 0.0)
            ).alias(f"c_{i}{j}")
            for i, f in enumerate(FEATURES) for j, g in enumerate(FEATURES[: i + 1])
        ],
    )
    col = lambda name, i, j: F.col(f"{name}_{i}{j}")
    for i in range(P):
        for j in range(i + 1):
            rest = col("c", i, j)
            for k in range(j):
                rest = rest - col("l", i, k) * col("l", j, k)
            frame = frame.withColumn(f"l_{i}{j}", F.sqrt(rest) if i == j else rest / col("l", j, j))
    for j in range(P):
        for i in range(j, P):
            rest = F.lit(1.0 if i == j else 0.0)
            for k in range(j, i):
                rest = rest - col("l", i, k) * col("w", k, j)
            frame = frame.withColumn(f"w_{i}{j}", rest / col("l", i, i))
    logdet = sum((2 * F.log(col("l", i, i)) for i in range(1, P)), 2 * F.log(col("l", 0, 0)))
    return frame.select("group", "start", *ESTIMATE, logdet.alias("logdet"))


#: Columns of an estimate: centre and whitening matrix.
ESTIMATE = [*[f"m_{f}" for f in FEATURES], *[f"w_{i}{j}" for i in range(P) for j in range(i + 1)]]
CROSSES = [(f, g) for i, f in enumerate(FEATURES) for g in FEATURES[: i + 1]]


def _sums() -> list[Column]:
    products = [F.sum(F.col(f) * F.col(g)).alias(f"s_{f}_{g}") for f, g in CROSSES]
    return [F.count("*").alias("n"), *[F.sum(f).alias(f"s_{f}") for f in FEATURES], *products]


def _starts(points: DataFrame) -> DataFrame:
    """``group, start`` and the estimates that steps begin with, which any step betters."""
    plain = _whitening(points.groupBy("group", F.lit(1).alias("start")).agg(*_sums()))
    both = _robust_start(points).withColumn("start", F.lit(0)).select("group", "start", *ESTIMATE).unionByName(
        plain.select("group", "start", *ESTIMATE)
    )
    return both.withColumns({"logdet": F.lit(math.inf), "moved": F.lit(True)})


def _concentrated(points: DataFrame, estimates: DataFrame) -> DataFrame:
    """New estimates from the texts that lie closest under the old ones.

    Distances fall into bins, and whole bins are taken until they hold the share.
    """
    near = points.join(estimates, "group").withColumn("bin", F.floor(F.log(_distance() + 1e-6) * BINS))
    binned = near.groupBy("group", "start", "bin").agg(*_sums())
    by = Window.partitionBy("group", "start")
    upto = F.sum("n").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    taken = binned.select("*", (upto - F.col("n")).alias("before"), F.sum("n").over(by).alias("all")).where(
        F.col("before") < F.ceil(KEPT_SHARE * F.col("all"))
    )
    sums = ["n", *[f"s_{f}" for f in FEATURES], *[f"s_{f}_{g}" for f, g in CROSSES]]
    return _whitening(taken.groupBy("group", "start").agg(*[F.sum(c).alias(c) for c in sums]))


def estimated(points: DataFrame) -> DataFrame:
    """``group`` and its estimate of the smaller determinant, from steps that go on in each group and
    start as long as they lessen it."""
    now = written(_starts(points), "quality-estimates")
    while not now.where("moved").isEmpty():
        step = _concentrated(points, now.where("moved").select("group", "start", *ESTIMATE))
        new = step.select("group", "start", F.struct(*ESTIMATE, "logdet").alias("new"))
        joined = now.join(new, ["group", "start"], "left")
        better = F.coalesce(F.col("new.logdet") < F.col("logdet") - LEAST_GAIN, F.lit(False))
        taken = [F.when(better, F.col(f"new.{c}")).otherwise(F.col(c)).alias(c) for c in (*ESTIMATE, "logdet")]
        now = written(joined.select("group", "start", *taken, better.alias("moved")), "quality-estimates")
    chosen = F.min_by(F.struct(*ESTIMATE), F.struct("logdet", "start")).alias("e")
    return now.groupBy("group").agg(chosen).select("group", "e.*")


def judged(docs: DataFrame) -> DataFrame:
    """``docs`` (``doc_id, text, lang, source``) with counts, ``base_failed``, ``distance``, ``kept``.

    Null languages and sources are groups of their own. A group of equal texts, or of one, has
    only the added variance, so its texts are kept if the rules keep them. ``distance`` is null
    where the rules failed. Rows that repeat are judged alike, and columns beyond the four named
    are not read.
    """
    rows = docs.select("doc_id", "text", F.to_json(F.array("lang", "source")).alias("group"))
    counted = statistics(rows)
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    base = written(counted.select("*", failed.alias("base_failed"), *_features()), "quality-counts")
    points = base.where(~F.col("base_failed")).select("group", *FEATURES)
    estimates = estimated(points)
    distance = F.when(~F.col("base_failed"), _distance()).alias("distance")
    found = base.join(estimates, "group", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", distance
    )
    return found.withColumn("kept", ~F.col("base_failed") & (F.col("distance") <= LIMIT))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdicts of every whole text of ``documents``; a null text has no words and fails."""
    return judged(table(spark, sf_dir, "documents"))
