"""Live dashboard enrichment (J2, J3, E1, E9-E12, P6): lookups, coercion, derived metrics."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from statmart.functions.arith import per90, price, ratio
from statmart.functions.coerce import coerce_numeric
from statmart.functions.lookup import map_lookup
from statmart.operators.mart import position_label
from statmart.schemas import LIVE_NUMERIC, TEAM_NAMES, UNKNOWN


def with_team_names(df: DataFrame, names: Mapping[int, str] = TEAM_NAMES,
                    default: str = UNKNOWN, column: str = "team") -> DataFrame:
    """Replace the team id by its name; an id without a name becomes ``default``."""
    return df.withColumn(column, map_lookup(F.col(column), names, default))


def with_positions(df: DataFrame, source: str = "element_type",
                   default: str | None = None) -> DataFrame:
    """Add ``position`` from the element type; no default here, a miss stays NULL."""
    return df.withColumn("position", position_label(F.col(source), default))


def live_metrics(players: DataFrame, on_zero: str = "ieee",
                 numeric: Sequence[str] = LIVE_NUMERIC) -> DataFrame:
    """Players -> team names, coerced numbers, 10 derived metrics and position.

    ``on_zero`` picks the zero-denominator rule (see ``functions.arith``); the default
    "ieee" gives +-inf / NaN as an unguarded division does.
    """
    df = with_team_names(players)
    df = coerce_numeric(df, numeric)
    df = df.withColumn("price", price(F.col("now_cost")))
    c = F.col
    df = df.withColumns({
        "points_per_million": ratio(c("total_points"), c("price"), on_zero),
        "points_per_90": per90(c("total_points"), c("minutes"), on_zero),
        "goals_per_90": per90(c("goals_scored"), c("minutes"), on_zero),
        "assists_per_90": per90(c("assists"), c("minutes"), on_zero),
        "goal_involvement_per_90": per90(c("goals_scored") + c("assists"), c("minutes"), on_zero),
        "xGI_per_90": per90(c("expected_goals") + c("expected_assists"), c("minutes"), on_zero),
        # named a percentage by the source, computed as a per-90 rate
        "clean_sheet_percentage": per90(c("clean_sheets"), c("minutes"), on_zero),
        "goals_conceded_per_90": per90(c("goals_conceded"), c("minutes"), on_zero),
        "value_ppg_per_cost": ratio(c("points_per_game"), c("price"), on_zero),
    })
    return with_positions(df)
