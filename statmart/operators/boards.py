"""Leaderboards, tolerant tables, rank-limited and chart datasets.

Scale notes:
* ``top_k`` is ``orderBy(...).limit(k)``, planned as TakeOrderedAndProject: every task
  keeps its own k best rows, so only (tasks x k) rows ever meet in one place.
* ``rank_top`` keeps every row whose ``rank()`` is <= k with one scan of its input and without a
  global window (which would put the whole input in one task): each task keeps its own rows of
  rank <= k, ties included, by Spark's window group limit before anything is shuffled. On those
  few the k-th best value is found with a top-k, the ranks of the at most k distinct values
  above it come from a window over <= k rows, and those <= k rows are broadcast back: rows tied
  at the limit are all kept however many there are, and never meet in one task.
"""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from statmart.operators.filters import has_columns
from statmart.schemas import BOARD_SPECS, CHARTS, RANK_LIMIT, TOP_BOARD_COLUMNS, TOP_N
from statmart.session import settled


def _order(column: str, ascending: bool) -> Column:
    # Missing values sort last in both directions.
    return F.asc_nulls_last(column) if ascending else F.desc_nulls_last(column)


def tolerant_board(df: DataFrame, columns: Sequence[str], sort_by: str = "total_points",
                   ascending: bool = False) -> DataFrame:
    """The columns that exist, sorted by ``sort_by`` or, without it, by the first one."""
    shown = has_columns(df, columns)
    key = sort_by if sort_by in df.columns else shown[0]
    missing = [c for c in columns if c not in shown]
    if missing or key != sort_by:
        warnings.warn(f"board sorted by {key!r}; not available: {missing}")
    return df.orderBy(_order(key, ascending)).select(*shown)


def board(df: DataFrame, name: str) -> DataFrame:
    """One of the fixed boards: overview, attacking, defensive, value."""
    columns, sort_by = BOARD_SPECS[name]
    return tolerant_board(df, columns, sort_by)


def top_k(df: DataFrame, by: str, k: int = TOP_N, columns: Sequence[str] = TOP_BOARD_COLUMNS,
          tie_break: str = "id", ascending: bool = False) -> DataFrame:
    """The k best rows by ``by``; equal values are ordered by ``tie_break``."""
    keep = has_columns(df, list(columns) + [tie_break])
    return (df.orderBy(_order(by, ascending), F.asc(tie_break)).limit(k).select(*keep))


def leading_rows(df: DataFrame, by: str, k: int, ascending: bool = False) -> DataFrame:
    """Rows among the first ``k`` ranks of their own task: a superset of those of all ranks <= k."""
    own = Window.partitionBy("_task").orderBy(_order(by, ascending))
    return (df.withColumn("_task", F.spark_partition_id()).withColumn("_own", F.rank().over(own))
            .where(F.col("_own") <= k).drop("_task", "_own"))


def rank_top(df: DataFrame, by: str, k: int = RANK_LIMIT, ascending: bool = False,
             rank_col: str = "rank") -> DataFrame:
    """W1 + F9: rows with ``rank() <= k`` over ``by`` (missing values rank last), plus rank.

    Rank of a value v = 1 + number of rows strictly before v, so every value among the
    first k rows in sort order has rank <= k and no other value does. The scan runs when this is
    called: each task's leading rows are kept, as they are read twice.
    """
    near = settled(leading_rows(df, by, k, ascending), "leading-rows")
    firsts = near.select(F.col(by).alias("_v")).orderBy(_order("_v", ascending)).limit(k)
    counts = firsts.groupBy("_v").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy(_order("_v", ascending)).rowsBetween(Window.unboundedPreceding, -1)
    ranks = counts.select(
        "_v", (F.coalesce(F.sum("_n").over(before), F.lit(0)) + 1).cast("int").alias(rank_col))
    joined = near.join(F.broadcast(ranks), near[by].eqNullSafe(ranks["_v"]), "inner")
    return joined.drop("_v")


def chart_data(df: DataFrame, name: str) -> DataFrame:
    """The encoded columns of a chart (drawing is left to the caller)."""
    return df.select(*has_columns(df, CHARTS[name]))


def influence_chart(df: DataFrame, k: int = RANK_LIMIT) -> DataFrame:
    """P11 + W1: influence bars for the top-k ranked rows."""
    cols = has_columns(df, CHARTS["influence"])
    return rank_top(df.select(*cols), "influence", k)
