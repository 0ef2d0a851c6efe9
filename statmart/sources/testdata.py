"""Readers for the driver's parquet tables and the ``players`` stand-in built from them.

The stand-in: one player per part; its season statistics are aggregates of that part's
line items. Plan at scale: ``lineitem`` is pruned to 10 columns at the scan, aggregated by
``l_partkey`` with map-side partial aggregation (a hot part key pre-aggregates in every map
task, so the shuffle carries at most one row per key per task), then joined to ``part`` on
the same key, so the aggregate side keeps its hash partitioning and only ``part`` is
exchanged (or broadcast by AQE when it is small at run time).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from statmart.functions.arith import round_fixed

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# Line items shipped on/after this date count as "this season" for minutes, goals, assists.
SEASON_START = _dt.date(2001, 6, 1)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _n(col):
    return round_fixed(col, 6)


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``players`` stand-in (the snapshot's ``elements``), one row per part."""
    li = read_table(spark, sf_dir, "lineitem")
    part = read_table(spark, sf_dir, "part")
    since = F.lit(SEASON_START.isoformat()).cast("timestamp_ntz")
    recent = F.col("l_shipdate").cast("timestamp_ntz") >= since
    qty, disc, tax, ext = (F.col(c) for c in ("l_quantity", "l_discount", "l_tax", "l_extendedprice"))

    def count_where(cond):
        return F.count_if(cond).cast("int")

    def lines_numbered(n):
        return count_where(F.col("l_linenumber") == n)

    stats = li.groupBy("l_partkey").agg(
        F.sum(qty).cast("int").alias("total_points"),
        F.sum(F.when(recent, qty).otherwise(F.lit(0.0))).cast("int").alias("minutes"),
        count_where(recent & (F.col("l_returnflag") == "R")).alias("goals_scored"),
        count_where(recent & (F.col("l_returnflag") == "A")).alias("assists"),
        count_where(F.col("l_linestatus") == "F").alias("clean_sheets"),
        count_where(F.col("l_linestatus") == "O").alias("goals_conceded"),
        lines_numbered(4).alias("own_goals"),
        lines_numbered(5).alias("penalties_saved"),
        lines_numbered(6).alias("penalties_missed"),
        lines_numbered(2).alias("yellow_cards"),
        lines_numbered(3).alias("red_cards"),
        lines_numbered(1).alias("saves"),
        lines_numbered(7).alias("bonus"),
        F.count(F.lit(1)).cast("int").alias("bps"),
        _n(F.sum(ext)).alias("influence"),
        _n(F.sum(ext * disc)).alias("creativity"),
        _n(F.sum(ext * tax)).alias("threat"),
        _n(F.sum(ext * (1 - disc))).alias("ict_index"),
        _n(F.sum(disc)).alias("expected_goals"),
        _n(F.sum(tax)).alias("expected_assists"),
        _n(F.sum(disc + tax)).alias("expected_goal_involvements"),
        _n(F.sum(F.when(F.col("l_linestatus") == "O", disc).otherwise(F.lit(0.0))))
        .alias("expected_goals_conceded"),
        _n(F.avg(qty)).cast("string").alias("form"),
        _n(F.avg(100 * disc)).cast("string").alias("selected_by_percent"),
        # text stand-ins whose exact value has at most 6 decimals, so rounding never ties
        _n(F.avg(100 * tax)).cast("string").alias("value_form"),
        _n(F.sum(ext) / 1000).cast("string").alias("value_season"),
    )
    # count(distinct l_orderkey) per part as a narrow two-column dedup plus a count: the
    # other aggregates then combine map-side instead of riding along a (part, order) shuffle.
    # Both sides end hash-partitioned on l_partkey, so joining them adds no exchange.
    starts = (li.select("l_partkey", "l_orderkey").distinct()
              .groupBy("l_partkey").agg(F.count(F.lit(1)).cast("int").alias("starts")))
    stats = stats.join(starts, "l_partkey", "left")
    base = part.select(
        F.col("p_partkey").alias("id"),
        F.split_part("p_name", F.lit(" "), F.lit(1)).alias("first_name"),
        F.split_part("p_name", F.lit(" "), F.lit(2)).alias("second_name"),
        F.col("p_name").alias("web_name"),
        F.regexp_extract("p_brand", r"(\d+)", 1).cast("int").alias("team"),
        (F.col("p_size") % 5).alias("element_type"),
        F.col("p_retailprice").alias("now_cost"),
    )
    joined = base.join(stats, base["id"] == stats["l_partkey"], "left").drop("l_partkey")
    ppg = _n(F.col("total_points") / F.col("starts")).cast("string")
    return joined.withColumn("points_per_game", ppg)


def teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze ``teams`` stand-in: one row per nation."""
    return read_table(spark, sf_dir, "nation").select(
        (F.col("n_nationkey") + 1).alias("id"), F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region"))
