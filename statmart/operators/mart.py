"""Gold model: the player statistics mart.

Two plans give the same rows:

* ``build_mart(dim, fact)``: the general form, an inner equi-join of the dimension with
  the fact on ``id = player_id``. Catalyst/AQE pick broadcast or sort-merge; when both
  sides come from one plan the exchange is reused, so the data is shuffled once.
* ``mart_from_players(players)``: ``id`` is the snapshot's primary key, so the join is a
  1:1 self-join; this form applies both recasts to one scan and needs no join at all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.functions.arith import per90_guarded, ratio
from statmart.functions.lookup import map_lookup
from statmart.operators.conform import typed_dim, typed_fact
from statmart.schemas import DIM_COLUMNS, MART_FACT_OUTPUT, POSITION_NAMES, UNKNOWN


def position_label(element_type: Column, default: str | None = UNKNOWN) -> Column:
    """1..4 -> GK/DEF/MID/FWD; anything else is ``default`` (NULL when None)."""
    code = F.bround(element_type.try_cast("double"), 0).try_cast("int")
    return map_lookup(code, POSITION_NAMES, default)


def _mart_columns(pc: Callable[[str], Column], sc: Callable[[str], Column],
                  last_updated: Column | None | bool) -> list[Column]:
    """Output columns; ``pc``/``sc`` resolve a dim-side / fact-side column name."""
    cols = [pc(c).alias(c) for c in DIM_COLUMNS] + [pc("price").alias("price")]
    cols += [sc(c).alias(c) for c in MART_FACT_OUTPUT]
    minutes = sc("minutes")
    cols += [
        position_label(pc("element_type")).alias("position"),
        per90_guarded(sc("goals_scored"), minutes).alias("goals_per_90"),
        per90_guarded(sc("assists"), minutes).alias("assists_per_90"),
        per90_guarded(sc("expected_goals"), minutes).alias("xG_per_90"),
        per90_guarded(sc("expected_assists"), minutes).alias("xA_per_90"),
        ratio(pc("total_points"), pc("price"), "zero").alias("points_per_million"),
        per90_guarded(pc("total_points"), minutes).alias("points_per_90"),
        ratio(minutes, sc("starts"), "zero").alias("minutes_per_start"),
    ]
    if last_updated is not False:
        stamp = last_updated if isinstance(last_updated, Column) else F.current_timestamp()
        cols.append(stamp.alias("last_updated"))
    return cols


def build_mart(dim: DataFrame, fact: DataFrame, strict: bool = False,
               last_updated: Column | None | bool = None) -> DataFrame:
    """Mart from separate dim and fact tables (inner join on id = player_id).

    ``dim`` must be unique on ``id`` (it is a dimension), so the output has one row per
    fact row. ``last_updated=False`` leaves the (nondeterministic) load time out.
    """
    p = typed_dim(dim, strict).alias("p")
    s = typed_fact(fact, strict).alias("s")
    joined = p.join(s, F.col("p.id") == F.col("s.player_id"), "inner")
    return joined.select(*_mart_columns(lambda c: F.col(f"p.{c}"), lambda c: F.col(f"s.{c}"),
                                        last_updated))


def mart_from_players(players: DataFrame, strict: bool = False,
                      last_updated: Column | None | bool = None) -> DataFrame:
    """Mart from the players snapshot in one scan.

    The dim recasts and the fact recasts touch disjoint columns, and the mart reads the
    overlapping columns (team, element_type, total_points, ...) from the dim side, so
    both recasts can be applied to the same row.
    """
    typed = typed_fact(typed_dim(players, strict), strict)
    return typed.select(*_mart_columns(F.col, F.col, last_updated))
