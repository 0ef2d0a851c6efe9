"""Quality rules: robust multivariate outliers, with DataFrame functions only.

Each text gives five counts; their transformed vector is held against minimum-covariance-
determinant estimates (location and scatter of the most concentrated half of a group, (n + D + 1) / 2
of its n rows) of its language and source, and rejected where the squared Mahalanobis distance passes a cut.

The estimates come from concentration steps, each two aggregations over the rows of all groups that
still change: distances of the present estimate, the quantile of the held share in each group, then
means and covariances of the rows within it. A group is done when its determinant no longer falls.
There is one start (medians and their deviations, which half a group of junk can't move far): the
least determinant of several starts would choose the subset around a large group of copies, which
have no scatter of their own. Groups of fewer than LEAST rows share one estimate per language, and where
that has too few rows as well, one over all. No step brings a group to one task.

Defined results: a null or empty text has zero counts and fails the base rule (fewer than 50 words); a null
language or source is a group like any other; repeated rows count as often as they occur; a
group in which nothing varies rejects only rows that differ clearly (variances have a floor).
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.llm.common import SPACE_CHARS, word_array
from statmart.session import materialize

#: Least standard deviation of each transformed statistic (the floor keeps scatters invertible).
FLOORS = (0.30, 0.25, 0.70, 0.50, 0.70)
NAMES = ("v0", "v1", "v2", "v3", "v4")
D = len(NAMES)
LEAST = 100
#: Shares of a group that may be held: from half of it to all, a two-hundredth apart.
SHARES = [k / 200 for k in range(100, 201)]
#: A concentration step counts as a fall if the logarithm of the determinant falls by more.
FALL = 1e-3
#: 0.975 and 1 - 1e-5 quantiles of chi-square with 5 degrees of freedom.
REWEIGHT, CUT = 12.83, 30.86


def consistency(share: float) -> float:
    """The factor that makes the scatter of the closest ``share`` of rows consistent at the normal
    distribution: share / P(chi-square of D + 2 degrees <= quantile of chi-square of D at share)."""
    if share >= 1:
        return 1.0

    def below(x: float) -> float:  # chi-square with 5 degrees
        return math.erf(math.sqrt(x / 2)) - math.sqrt(2 * x / math.pi) * math.exp(-x / 2) * (1 + x / 3)

    low, high = 0.0, 100.0
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < share else (low, middle)
    return share / (share - math.sqrt(2 / math.pi) * math.exp(-low / 2) * low ** 2.5 / 15)


def text_statistics(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    blank = F.length(text) - F.length(F.translate(text, SPACE_CHARS, ""))
    symbols = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    lines = F.filter(F.split(text, "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    base = docs.select("doc_id", "lang", "source", word_array(F.col("text")).alias("words"),
                       (F.length(text) - blank).cast("long").alias("word_chars"), symbols.cast("long").alias("n_symbols"),
                       (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))
    # hashes of the 3-word windows; a window counts if its hash stands next to an equal one when sorted
    with_windows = base.withColumn("windows", F.when(F.size("words") < 3, F.array().cast("array<bigint>")).otherwise(F.zip_with(
        F.zip_with(F.slice("words", 1, F.size("words") - 2), F.slice("words", 2, F.size("words") - 2), lambda a, b: F.struct(a, b)),
        F.slice("words", 3, F.size("words") - 2), lambda ab, c: F.xxhash64(ab, c))))
    placed = F.array_sort(F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    sorted_windows = with_windows.withColumn("repeated", F.size("windows") > F.size(F.array_distinct("windows"))).withColumn(
        "placed", F.when(F.col("repeated"), placed))
    n = F.size("placed")
    pairs = F.zip_with(F.slice("placed", 1, n - 1), F.slice("placed", 2, n - 1),
                       lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])))
    covered = F.array_distinct(F.flatten(F.transform(F.array_distinct(F.flatten(F.filter(pairs, lambda x: x.isNotNull()))),
                                                     lambda i: F.array(i, i + 1, i + 2))))
    repeat = F.when(F.col("repeated"), F.size(covered)).otherwise(F.lit(0))
    return sorted_windows.select("doc_id", "lang", "source", F.size("words").cast("long").alias("n_words"), "word_chars",
                                 "n_symbols", "n_dup_lines", repeat.cast("long").alias("n_repeat_words"))


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _vector() -> list[Column]:
    words = F.greatest(F.col("n_words"), F.lit(1)).cast("double")
    return [F.log1p(F.col("n_words").cast("double")), F.col("word_chars") / words,
            F.log1p(100 * F.col("n_symbols") / words), F.log1p(F.col("n_dup_lines").cast("double")),
            F.log1p(100 * F.col("n_repeat_words") / words)]


def _cell(i: int, j: int) -> str:
    return f"c{max(i, j)}{min(i, j)}"


def _triangle() -> list[tuple[int, int]]:
    return [(i, j) for i in range(D) for j in range(i + 1)]


def _factored(estimate: DataFrame, *more: str) -> DataFrame:
    """The Cholesky factor (l00 .. l44) of an estimate's scatter, and its log determinant."""
    for j in range(D):  # a column of the factor at a time, which keeps plans small
        rest = [F.col(_cell(i, j)) - sum((F.col(f"l{i}{k}") * F.col(f"l{j}{k}") for k in range(j)), F.lit(0.0)) for i in range(j, D)]
        root = F.sqrt(F.greatest(rest[0], F.lit(1e-9)))
        estimate = estimate.withColumns({f"l{j}{j}": root, **{f"l{i}{j}": rest[i - j] / root for i in range(j + 1, D)}})
    log_det = 2 * sum((F.log(f"l{i}{i}") for i in range(D)), F.lit(0.0))
    return estimate.select("key", *[f"m{i}" for i in range(D)], *[f"l{i}{j}" for i, j in _triangle()], log_det.alias("log_det"), *more)


def _centred(points: DataFrame, estimate: DataFrame, *more: str) -> DataFrame:
    """``points`` with their squared Mahalanobis distance ``d2`` from their group's estimate and
    their vector from its centre (y0 .. y4)."""
    out = points.join(estimate, "key")
    out = out.withColumns({f"y{i}": F.col(v) - F.col(f"m{i}") for i, v in enumerate(NAMES)})
    for i in range(D):
        rest = F.col(f"y{i}") - sum((F.col(f"l{i}{j}") * F.col(f"z{j}") for j in range(i)), F.lit(0.0))
        out = out.withColumn(f"z{i}", rest / F.col(f"l{i}{i}"))
    d2 = sum((F.col(f"z{i}") * F.col(f"z{i}") for i in range(D)), F.lit(0.0))
    return out.withColumn("d2", d2).select(*points.columns, "d2", *more, *[f"y{i}" for i in range(D)])


def _distance(points: DataFrame, estimate: DataFrame) -> DataFrame:
    """``points`` with their squared Mahalanobis distance ``d2`` from their group's estimate."""
    return _centred(points, estimate).select(*points.columns, "d2")


def _scatter(points: DataFrame, estimate: DataFrame, factor: Column, *more: str) -> DataFrame:
    """Mean and covariance (times ``factor``, with floors) of each group's points, which lie around
    the centre of ``estimate``, factored; ``more`` columns have one value in a group.

    Sums of products around a near centre lose no digits and are a fifth of the state of as many
    covariance aggregates. They are written before they are factored, which keeps generated code small."""
    sums = materialize(points.groupBy("key").agg(
        F.first(factor).alias("factor"), *[F.first(c).alias(c) for c in more], F.count(F.lit(1)).alias("n"),
        *[F.sum(f"y{i}").alias(f"t{i}") for i in range(D)],
        *[F.sum(F.col(f"y{i}") * F.col(f"y{j}")).alias(f"s{i}{j}") for i, j in _triangle()]), "mcd-sums")
    centre = estimate.select("key", *[F.col(f"m{i}").alias(f"o{i}") for i in range(D)])
    off = [F.col(f"t{i}") / F.col("n") for i in range(D)]
    means = [(F.col(f"o{i}") + off[i]).alias(f"m{i}") for i in range(D)]
    cells = [((F.col(f"s{i}{j}") / F.col("n") - off[i] * off[j]) * F.col("factor") + F.lit(FLOORS[i] ** 2 if i == j else 0.0)).alias(_cell(i, j))
             for i, j in _triangle()]
    return _factored(sums.join(centre, "key").select("key", *means, *cells, *more), *more)


def _start(points: DataFrame) -> DataFrame:
    """First estimate: medians, and median absolute deviations as a diagonal scatter."""
    middle = points.groupBy("key").agg(*[F.percentile_approx(v, 0.5).alias(f"m{i}") for i, v in enumerate(NAMES)])
    spread = materialize(points.join(middle, "key").groupBy("key", *[f"m{i}" for i in range(D)]).agg(
        *[F.percentile_approx(F.abs(F.col(v) - F.col(f"m{i}")), 0.5).alias(f"a{i}") for i, v in enumerate(NAMES)]), "mcd-start")
    cells = [(F.pow(F.lit(1.4826) * F.col(f"a{i}"), F.lit(2)) + F.lit(FLOORS[i] ** 2) if i == j else F.lit(0.0)).alias(_cell(i, j))
             for i, j in _triangle()]
    return _factored(spread.select("key", *[f"m{i}" for i in range(D)], *cells))


def group_keys(points: DataFrame) -> DataFrame:
    """(lang, source, key): the group whose estimate judges a language and source."""
    counts = points.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n"))
    small = counts.where(F.col("n") < LEAST).groupBy("lang").agg(F.sum("n").alias("small_n"))
    joined = counts.alias("c").join(small.alias("s"), F.col("c.lang").eqNullSafe(F.col("s.lang")), "left").select(
        "c.lang", "c.source", "n", "small_n")
    named = F.concat_ws("\x1f", F.lit("g"), F.coalesce("lang", F.lit("\x1e")), F.coalesce("source", F.lit("\x1e")))
    key = F.when(F.col("n") >= LEAST, named).when(
        F.col("small_n") >= LEAST, F.concat_ws("\x1f", F.lit("l"), F.coalesce("lang", F.lit("\x1e")))).otherwise(F.lit("all"))
    return joined.select(F.col("lang").alias("g_lang"), F.col("source").alias("g_source"), key.alias("key"))


def _concentrated(points: DataFrame, estimate: DataFrame) -> DataFrame:
    """The estimate from the closest (n + D + 1) / 2 of each group's n rows by ``estimate``, and
    the latter's log determinant as ``old_det``."""
    measured = _centred(points, estimate, "log_det")
    limits = measured.groupBy("key").agg(F.percentile_approx("d2", F.array(*map(F.lit, SHARES))).alias("limits"), F.count(F.lit(1)).alias("n"),
                                           F.first("log_det").alias("old_det"))
    place = F.least(F.ceil(100 * (F.col("n") + D + 1) / F.col("n")), F.lit(200)).cast("int") - 99
    limits = limits.select("key", "old_det", F.element_at("limits", place).alias("limit"),
                           F.element_at(F.array(*[F.lit(consistency(x)) for x in SHARES]), place).alias("consistent"))
    return _scatter(measured.join(limits, "key").where(F.col("d2") <= F.col("limit")), estimate, F.col("consistent"), "old_det")


def minimum_covariance_determinant(points: DataFrame) -> DataFrame:
    """Factored robust estimates (key, m*, l*) of the vectors in ``points`` (key, v0 .. v4)."""
    # the start's determinant is that of no subset: the first step counts as a fall
    fallen = materialize(_start(points).withColumn("log_det", F.lit(math.inf)), "mcd")
    steps = []
    while not fallen.isEmpty():
        steps.append(fallen.withColumn("step", F.lit(len(steps))))
        # written before it is filtered: a filter on the determinant would be pushed below the factor,
        # with the whole factor in place of its name, which grows beyond what one method may hold
        step = materialize(_concentrated(points, fallen), "mcd")
        fallen = step.where(F.col("log_det") < F.col("old_det") - FALL).drop("old_det")
    if not steps:
        return fallen.drop("log_det")
    columns = [c for c in steps[0].columns if c not in ("key", "step")]
    last = reduce(DataFrame.unionByName, steps).groupBy("key").agg(F.max_by(F.struct(*columns), "step").alias("x"))
    estimate = materialize(last.select("key", "x.*").drop("log_det"), "mcd")
    return materialize(_scatter(_centred(points, estimate).where(F.col("d2") <= REWEIGHT), estimate, F.lit(1.0)).drop("log_det"), "mcd")


def quality_verdicts(docs: DataFrame, cut: float = CUT) -> DataFrame:
    """Statistics, ``base_failed``, ``d2`` and ``kept`` for every row of ``docs``
    (doc_id, text, lang, source). Estimates come from the rows that pass the base rule."""
    measured = materialize(text_statistics(docs).withColumn("base_failed", base_failed())
                           .select("*", *[v.alias(n) for v, n in zip(_vector(), NAMES)]), "statistics")
    passed = measured.where(~F.col("base_failed"))
    keys = materialize(group_keys(passed), "groups")
    points = materialize(
        passed.join(keys, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")))
        .select("key", *NAMES), "points")
    estimate = minimum_covariance_determinant(points)
    judged = _distance(passed.join(keys, F.col("lang").eqNullSafe(F.col("g_lang")) & F.col("source").eqNullSafe(F.col("g_source")))
                       .select(*measured.columns, "key"), estimate).withColumn("kept", F.col("d2") <= cut).drop("key")
    failed = measured.where("base_failed").withColumn("d2", F.lit(None).cast("double")).withColumn("kept", F.lit(False))
    return judged.unionByName(failed).drop(*NAMES)
