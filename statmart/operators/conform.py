"""Silver models: dimension and fact projections of the players snapshot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.functions.arith import price
from statmart.functions.coerce import cast_replace
from statmart.schemas import DIM_CASTS, DIM_COLUMNS, FACT_CASTS, FACT_COLUMNS


def dim_players(players: DataFrame, columns: Sequence[str] = DIM_COLUMNS) -> DataFrame:
    """Dimension: the 11 descriptive columns (raw bronze types)."""
    return players.select(*columns)


def fact_player_history(players: DataFrame, columns: Sequence[str] = FACT_COLUMNS) -> DataFrame:
    """Fact: ``id AS player_id`` plus the 31 statistic columns (raw bronze types)."""
    return players.select(F.col("id").alias("player_id"), *columns)


def typed_dim(dim: DataFrame, strict: bool = False) -> DataFrame:
    """Dim with its numeric columns replaced by typed ones, plus ``price`` (cost / 10)."""
    return cast_replace(dim, DIM_CASTS, strict).withColumn("price", price(F.col("now_cost")))


def typed_fact(fact: DataFrame, strict: bool = False) -> DataFrame:
    """Fact with 22 statistic columns replaced by typed ones."""
    return cast_replace(fact, FACT_CASTS, strict)
