"""Filters (F1-F13). Predicates are Column expressions, so they push down to the scan."""

from __future__ import annotations

import functools
import operator
from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statmart.schemas import COMPARE_COLUMNS, MAX_COMPARE, MIN_MINUTES

ALL = "All"


def conjunction(preds: Iterable[Column | None]) -> Column:
    """AND of the given predicates (None entries are skipped); no predicates -> TRUE."""
    present = [p for p in preds if p is not None]
    return functools.reduce(operator.and_, present) if present else F.lit(True)


def equals_unless_all(column: str, value) -> Column | None:
    """``column == value`` unless ``value`` is "All" (or None)."""
    if value is None or value == ALL:
        return None
    return F.col(column) == F.lit(value)


def member_unless_all(column: str, values: Sequence | None) -> Column | None:
    """membership; "All" among the values (or None) means no predicate.

    An empty selection matches nothing, as an empty ``isin`` does.
    """
    if values is None:
        return None
    values = list(values)
    if ALL in values:
        return None
    if not values:
        return F.lit(False)
    return F.col(column).isin(values)


def at_least(column: str, bound) -> Column:
    """``column >= bound``; with no bound (the full-range default) only drops missing."""
    if bound is None:
        return F.col(column).isNotNull()
    return F.col(column) >= F.lit(bound)


def within(column: str, bounds: tuple | None) -> Column:
    """closed range (both ends kept); None is the full range (drops missing only)."""
    if bounds is None:
        return F.col(column).isNotNull()
    lo, hi = bounds
    return F.col(column).between(F.lit(lo), F.lit(hi))


def filter_board(df: DataFrame, position: str | None = ALL, min_price=None,
                 min_points=None) -> DataFrame:
    """position equality (unless All) AND price >= min AND points >= min."""
    return df.where(conjunction([
        equals_unless_all("position", position),
        at_least("price", min_price),
        at_least("total_points", min_points),
    ]))


@dataclass(frozen=True)
class FilterSpec:
    """Widget state of the live dashboard, as data."""
    positions: Sequence[str] | None = (ALL,)
    teams: Sequence[str] | None = (ALL,)
    price_range: tuple[float, float] | None = None
    min_points: float | None = 0
    min_minutes: float | None = MIN_MINUTES

    def predicate(self) -> Column:
        """conjunction of F4-F6."""
        return conjunction([
            member_unless_all("position", self.positions),
            member_unless_all("team", self.teams),
            within("price", self.price_range),
            at_least("total_points", self.min_points),
            at_least("minutes", self.min_minutes),
        ])


def filter_live(df: DataFrame, spec: FilterSpec = FilterSpec()) -> DataFrame:
    return df.where(spec.predicate())


def compare_players(df: DataFrame, names: Sequence[str], columns: Sequence[str] | None = None,
                    max_names: int = MAX_COMPARE) -> DataFrame:
    """F8/P10: rows whose name is one of at most ``max_names`` picks; equal names all return."""
    names = list(dict.fromkeys(names))
    if len(names) > max_names:
        raise ValueError(f"at most {max_names} players can be compared, got {len(names)}")
    cols = list(columns or COMPARE_COLUMNS)
    pred = F.col("web_name").isin(names) if names else F.lit(False)
    return df.where(pred).select(*cols)


def is_empty(df: DataFrame) -> bool:
    """F11 (an action; reads at most one row)."""
    return df.isEmpty()


def all_missing(column: str) -> Column:
    """F12 as an aggregate expression: TRUE when no row has a value."""
    return F.count(F.col(column)) == 0


def has_columns(df: DataFrame, columns: Iterable[str]) -> list[str]:
    """the listed columns that exist, in order, without repeats."""
    return [c for c in dict.fromkeys(columns) if c in df.columns]
