"""Group and global statistics.

Every aggregation here is a ``groupBy().agg()`` (or a global ``agg``): partial aggregation
runs map-side, so the shuffle carries one row per group per task, never the raw rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.functions.arith import round_half_even
from statmart.functions.coerce import nan_to_null, to_double
from statmart.functions.text import format_2f, option_text
from statmart.operators.filters import has_columns
from statmart.operators.quantiles import approx_quantiles, summaries
from statmart.schemas import GROUP_METRICS, SUMMARY_STATS
from statmart.session import settled

QUANTILES = {"median": 0.5, "p90": 0.9}


def _known_positions(df: DataFrame, key: str) -> DataFrame:
    # Grouping drops rows whose key is missing.
    return df.where(F.col(key).isNotNull())


def selection_by_position(df: DataFrame, key: str = "position") -> DataFrame:
    """Per position, count of ids and mean selection percentage (coerced)."""
    return _known_positions(df, key).groupBy(key).agg(
        F.count("id").alias("id"),
        F.avg(to_double(df, "selected_by_percent")).alias("selected_by_percent"))


def metrics_by_position(df: DataFrame, metrics: Sequence[str] = GROUP_METRICS,
                        key: str = "position", scale: int | None = 2) -> DataFrame:
    """Per-position means, rounded half to even."""
    cols = has_columns(df, metrics)

    def mean(c):
        m = F.avg(to_double(df, c))
        return (round_half_even(m, scale) if scale is not None else m).alias(c)

    return _known_positions(df, key).groupBy(key).agg(*[mean(c) for c in cols])


def bounds(df: DataFrame, columns: Sequence[str] = ("price", "total_points")) -> DataFrame:
    """A4: one row with ``<c>_min`` and ``<c>_max`` for each column (one pass)."""
    aggs = []
    for c in columns:
        aggs += [F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max")]
    return df.agg(*aggs)


def options(df: DataFrame, columns: Sequence[str] = ("position", "team")) -> DataFrame:
    """Distinct values of each column as text (missing -> 'nan'), sorted."""
    cols = has_columns(df, columns)
    # one scan: each row becomes (kind, value) pairs, then one distinct
    texts = df.select(*[option_text(F.col(c)).alias(c) for c in cols])
    return texts.unpivot([], cols, "kind", "value").distinct().orderBy("kind", "value")


def latest_update(df: DataFrame, column: str = "last_updated") -> DataFrame:
    """A10: the latest load time."""
    return df.agg(F.max(column).alias(column))


def dashboard_summaries(df: DataFrame, metrics: Sequence[str] = GROUP_METRICS,
                        bound_columns: Sequence[str] = ("price", "total_points"),
                        option_columns: Sequence[str] = ("position",), key: str = "position",
                        updated: str = "last_updated", scale: int | None = 2) -> dict[str, DataFrame]:
    """``selection_by_position``, ``metrics_by_position``, ``bounds``, ``options`` and (where the column
    exists) ``last_updated`` from one scan: grouping sets by each key and over all rows.

    The scan runs when this is called. It leaves one row for each value of a key; the datasets
    are selections of these rows, with the values of the functions of the same names.
    """
    options_of = has_columns(df, option_columns)
    keys = list(dict.fromkeys([key, *options_of]))
    means = {c: F.avg(to_double(df, c)) for c in has_columns(df, metrics)}
    if scale is not None:
        means = {c: round_half_even(m, scale) for c, m in means.items()}
    aggs = [F.count("id").alias("_id"), F.avg(to_double(df, "selected_by_percent")).alias("_selected")]
    aggs += [m.alias(f"_mean_{c}") for c, m in means.items()]
    for c in bound_columns:
        aggs += [F.min(c).alias(f"_{c}_min"), F.max(c).alias(f"_{c}_max")]
    has_time = bool(has_columns(df, [updated]))
    if has_time:
        aggs.append(F.max(updated).alias("_updated"))
    found = df.groupingSets([[k] for k in keys] + [[]], *keys).agg(F.grouping_id().alias("_set"), *aggs)
    found = settled(found, "dashboard-summaries")
    everything = (1 << len(keys)) - 1  # a key's bit is 0 in the rows grouped by it
    of_key = {k: F.col("_set") == everything - (1 << (len(keys) - 1 - i)) for i, k in enumerate(keys)}
    total = found.where(F.col("_set") == everything)
    groups = found.where(of_key[key] & F.col(key).isNotNull())
    out = {
        "selection_by_position": groups.select(key, F.col("_id").alias("id"), F.col("_selected").alias("selected_by_percent")),
        "metrics_by_position": groups.select(key, *[F.col(f"_mean_{c}").alias(c) for c in means]),
        # an aggregate once more: one row also where there are no rows at all
        "bounds": total.agg(*[F.max(f"_{c}_{side}").alias(f"{c}_{side}") for c in bound_columns for side in ("min", "max")]),
    }
    texts = [found.where(of_key[c]).select(F.lit(c).alias("kind"), option_text(F.col(c)).alias("value")) for c in options_of]
    if texts:
        out["options"] = reduce(DataFrame.unionByName, texts).distinct().orderBy("kind", "value")
    if has_time:
        out["last_updated"] = total.agg(F.max("_updated").alias(updated))
    return out


def long_form(df: DataFrame, stats: Sequence[str]) -> DataFrame:
    """(stat, value) rows for the listed columns, NaN as missing."""
    wide = df.select(*[nan_to_null(to_double(df, s)).alias(s) for s in stats])
    return wide.unpivot([], list(stats), "stat", "value")


def stat_summary(df: DataFrame, stats: Sequence[str] = SUMMARY_STATS,
                 quantiles: Mapping[str, float] = QUANTILES, exact: bool = True,
                 accuracy: int = 10_000) -> DataFrame:
    """One row per statistic with its mean and quantiles (median, p90).

    ``exact=True`` (default): linear interpolation between the closest ranks; the two scans of
    ``quantiles.summaries`` run when this is called, no task holds a group. ``exact=False``:
    ``percentile_approx``, fully lazy.
    """
    stats = has_columns(df, stats)
    long = long_form(df, stats)
    if exact:
        found = summaries(long, "stat", "value", quantiles)
    else:
        found = long.groupBy("stat").agg(F.avg("value").alias("mean")).join(
            approx_quantiles(long, "stat", "value", quantiles, accuracy), "stat")
    # every listed statistic gets a row, NULL when it has no values
    names = df.sparkSession.createDataFrame([(s,) for s in stats], "stat string")
    return names.join(found, "stat", "left").select("stat", "mean", *quantiles)


def summary_text(summary: DataFrame) -> DataFrame:
    """Display text with two decimals next to each number."""
    num = [c for c in summary.columns if c != "stat"]
    return summary.withColumns({f"{c}_text": format_2f(F.col(c)) for c in num})
