"""Exact quantiles with linear interpolation: a sketch brackets each wanted rank, a second scan
counts what lies below and sorts only the band between.

``percentile``/``median`` are exact in Spark but their final aggregation keeps every distinct
value of a group in one task. Here no value leaves its task but those of the bands:

1. one aggregation gives each group's size, mean and a mergeable quantile sketch
   (``percentile_approx``, rank error at most n / accuracy) with the values a margin below and
   above each quantile; the margin covers the sketch's error four times;
2. a second scan turns each value into its band's value, or into "below" (one counter for each
   task, group and quantile), and drops those above. Counts combine before the shuffle, so a value
   that holds a third of all rows is one row a task;
3. running counts over each band, about 8 / accuracy of a group's rows, tell the values at the
   wanted ranks. Groups so small that the margin is less than four ranks are their own band.

The ranks found are checked against the counts; should one lie outside its band, bands are widened
and the second scan runs again, so results are exact whatever the sketch does.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statmart.functions.coerce import nan_to_null
from statmart.session import settled

ACCURACY = 10_000


def _brackets(values: DataFrame, probs: Mapping[str, float], margin: float, accuracy: int) -> DataFrame:
    """(_g, _n, _mean, _ends): size, mean and sketched values around each quantile, a row a group."""
    around = [min(1.0, max(0.0, p + side * margin)) for p in probs.values() for side in (-1, 1)]
    return values.groupBy("_g").agg(F.count("_v").alias("_n"), F.avg("_v").alias("_mean"),
                                    F.percentile_approx("_v", around, accuracy).alias("_ends"))


def _place(p: float) -> Column:
    """Where a quantile lies among ``_n`` sorted values, counted from 0."""
    return (F.col("_n") - 1) * F.lit(float(p))


def _bands(groups: DataFrame, probs: Mapping[str, float], margin: float) -> DataFrame:
    """(_g, _q, _lo, _hi, _first, _second): a quantile's band of values and the 1-based ranks
    between which it is interpolated."""
    whole = F.col("_n") * margin < 4  # such a group is its own band

    def one(k: int, p: float) -> Column:
        return F.struct(F.lit(k).alias("_q"),
                        F.when(whole, F.lit(float("-inf"))).otherwise(F.col("_ends")[2 * k]).alias("_lo"),
                        F.when(whole, F.lit(float("inf"))).otherwise(F.col("_ends")[2 * k + 1]).alias("_hi"),
                        (F.floor(_place(p)) + 1).cast("long").alias("_first"), (F.ceil(_place(p)) + 1).cast("long").alias("_second"))

    rows = F.explode(F.array(*[one(k, p) for k, p in enumerate(probs.values())]))
    return groups.where("_n > 0").select("_g", rows.alias("_w")).select("_g", "_w.*")


def _selected(values: DataFrame, groups: DataFrame, probs: Mapping[str, float], margin: float) -> DataFrame:
    """(_g, _n, _mean, _a0, _b0, _a1, ...): the values at each quantile's two ranks, a row a group
    (null: a rank outside its band)."""
    bands = _bands(groups, probs, margin)
    # one row a group and quantile: broadcast when proven small, else a join on the group
    near = values.where("_v is not null").join(bands, "_g").where(F.col("_v") <= F.col("_hi"))
    banded = near.select("_g", "_q", "_first", "_second", F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v"))
    counts = banded.groupBy("_g", "_q", "_first", "_second", "_v").agg(F.count(F.lit(1)).alias("_c"))
    upto = Window.partitionBy("_g", "_q").orderBy(F.asc_nulls_first("_v")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counts.withColumn("_last", F.sum("_c").over(upto))

    def at(k: int, rank: str) -> Column:
        here = (F.col("_q") == k) & (F.col(rank) <= F.col("_last")) & (F.col(rank) > F.col("_last") - F.col("_c"))
        return F.max(F.when(here, F.col("_v")))

    ends = [at(k, rank).alias(f"{name}{k}") for k in range(len(probs)) for name, rank in (("_a", "_first"), ("_b", "_second"))]
    return groups.where("_n > 0").drop("_ends").join(placed.groupBy("_g").agg(*ends), "_g", "left")


def summaries(long_df: DataFrame, key: str, value: str, probs: Mapping[str, float],
              accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``key``, ``n``, ``mean`` and one column per entry of ``probs`` (name -> p).

    Linear interpolation between the closest ranks, NULL/NaN values skipped: the same
    definition as a continuous quantile (``q(0.5)`` of 1, 2, 3, 4 is 2.5; ``q(0.9)`` 3.7).
    The input is read twice; what is kept between the scans has a row a group.
    """
    values = long_df.select(F.col(key).alias("_g"), nan_to_null(F.col(value).cast("double")).alias("_v"))
    margin = 4.0 / accuracy
    while True:
        groups = settled(_brackets(values, probs, margin, accuracy), "quantile-brackets")
        found = settled(_selected(values, groups, probs, margin), "quantile-values")
        outside = " or ".join(f"_a{k} is null or _b{k} is null" for k in range(len(probs)))
        if margin >= 1 or found.where(outside).isEmpty():
            break
        margin *= 16

    def between(k: int, p: float) -> Column:
        a, b, frac = F.col(f"_a{k}"), F.col(f"_b{k}"), _place(p) - F.floor(_place(p))
        return F.when((a == b) | (frac == 0), a).otherwise(a + (b - a) * frac)

    return found.select(F.col("_g").alias(key), F.col("_n").alias("n"), F.col("_mean").alias("mean"),
                        *[between(k, p).alias(name) for k, (name, p) in enumerate(probs.items())])


def exact_quantiles(long_df: DataFrame, key: str, value: str, probs: Mapping[str, float],
                    accuracy: int = ACCURACY) -> DataFrame:
    """One row per group: ``key`` and one column per entry of ``probs``, see ``summaries``."""
    return summaries(long_df, key, value, probs, accuracy).select(key, *probs)


def approx_quantiles(long_df: DataFrame, key: str, value: str, probs: Mapping[str, float],
                     accuracy: int = ACCURACY) -> DataFrame:
    """Bounded-memory alternative: ``percentile_approx`` per group (rank error at most
    n / accuracy, the result is a value from the data, no interpolation)."""
    v = nan_to_null(F.col(value).cast("double"))
    names = list(probs)
    agg = long_df.groupBy(key).agg(
        F.percentile_approx(v, [float(probs[n]) for n in names], accuracy).alias("_qs"))
    return agg.select(key, *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)])
