"""End-to-end plans: what each entry point of the source project does, as Spark jobs.

* ``load_snapshot_file``: snapshot JSON -> ``players``, ``teams`` tables (replaced) + log.
* ``build_models``: ``players`` -> ``dim_players``, ``fact_player_history`` ->
  ``player_stats`` (the gold mart), each written as a table. ``refresh_models``: the same
  tables, kept in step by writing changed players only.
* ``board_dashboard`` / ``live_dashboard``: every table and chart dataset of the two
  dashboards for one filter state, as DataFrames.
* ``load_history``: landed season CSV families -> one bronze table per family,
  partitioned by season, each file loaded once.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.operators import boards, filters, live, stats
from statmart.operators.conform import dim_players, fact_player_history
from statmart.operators.mart import build_mart
from statmart.schemas import BOARD_SPECS, CHARTS, FAMILIES, TOP_BOARD_COLUMNS
from statmart.sinks.export import export_csv
from statmart.sinks.refresh import refresh_table
from statmart.sinks.tables import load_snapshot, replace_table
from statmart.sources.csv_files import family_glob, with_path_keys
from statmart.sources.json_docs import explode_records, read_documents
from statmart.sources.json_split import read_records
from statmart.streaming.incremental import batch_ingest, read_target


def load_snapshot_file(spark: SparkSession, path: str, database: str,
                       schema: T.StructType | None = None, multi_line: bool = True,
                       split: bool = False) -> list[str]:
    """Snapshot document(s) at ``path`` -> ``<db>.players`` and ``<db>.teams`` + log row.

    ``split=True`` (with ``schema``) reads each document by many tasks: for large ones.
    """
    if split:
        if schema is None:
            raise ValueError("split=True needs a schema")
        found = read_records(spark, path, {f.name: f.dataType.elementType for f in schema
                                           if f.name in ("elements", "teams")})
    else:
        docs = read_documents(spark, path, schema, multi_line)
        found = {name: explode_records(docs, name) for name in ("elements", "teams")
                 if name == "elements" or name in docs.columns}
    tables = {f"{database}.{'players' if name == 'elements' else name}": df for name, df in found.items()}
    return load_snapshot(spark, tables, f"{database}.snapshot_metadata")


def build_models(spark: SparkSession, database: str, source: str = "players",
                 last_updated: Column | None = None, buckets: int | None = None) -> DataFrame:
    """players -> dim and fact tables -> mart table; returns the mart table.

    The mart reads the two written tables (as the model graph does), not the source.
    With ``buckets``, dim and fact are written bucketed and sorted on the player id with
    the same bucket count, so the mart's join reads them co-located: no shuffle.
    """
    players = spark.table(f"{database}.{source}")
    replace_table(dim_players(players), f"{database}.dim_players",
                  bucket_by=(buckets, "id") if buckets else None)
    replace_table(fact_player_history(players), f"{database}.fact_player_history",
                  bucket_by=(buckets, "player_id") if buckets else None)
    mart = build_mart(spark.table(f"{database}.dim_players"),
                      spark.table(f"{database}.fact_player_history"),
                      last_updated=last_updated)
    replace_table(mart, f"{database}.player_stats")
    return spark.table(f"{database}.player_stats")


def refresh_models(spark: SparkSession, database: str, source: str = "players",
                   last_updated: Column | None | bool = None, path: str | None = None) -> dict[str, dict]:
    """The tables of ``build_models``, each brought up to date by writing changed players only.

    Dim and fact take the players whose own columns changed; the mart those whose dim or fact row
    changed. Returns what was written for each table (``sinks.refresh.refresh_table``).
    """
    players = spark.table(f"{database}.{source}")
    dim, fact, mart = (f"{database}.{n}" for n in ("dim_players", "fact_player_history", "player_stats"))
    done = {dim: refresh_table(dim, "id", [(dim_players(players), "id")], path=path),
            fact: refresh_table(fact, "player_id", [(fact_player_history(players), "player_id")], path=path)}
    done[mart] = refresh_table(mart, "id", [(spark.table(dim), "id"), (spark.table(fact), "player_id")],
                               partial(build_mart, last_updated=last_updated), path=path)
    return {name.split(".")[-1]: found for name, found in done.items()}


def board_dashboard(mart: DataFrame, position: str = filters.ALL, min_price=None,
                    min_points=None) -> dict[str, DataFrame]:
    """Every dataset of the mart dashboard for one filter state.

    Those that no filter changes come from one scan of the mart, which runs at the call."""
    from statmart.functions.coerce import coerce_numeric
    from statmart.schemas import BOARD_NUMERIC

    data = coerce_numeric(mart, BOARD_NUMERIC)
    chosen = filters.filter_board(data, position, min_price, min_points)
    out = {
        "top_performers": boards.top_k(chosen, "total_points", columns=TOP_BOARD_COLUMNS),
        "form_price": boards.chart_data(chosen, "form_price"),
        "top_value": boards.top_k(chosen, "points_per_million", columns=TOP_BOARD_COLUMNS),
        "xg_goals": boards.chart_data(chosen, "xg_goals"),
        "influence": boards.influence_chart(chosen),
        **stats.dashboard_summaries(data),
    }
    # F11 / F12 as lazy one-row flags: nothing matched the filters; no selection values
    out["no_rows"] = _no_rows(chosen)
    out["selection_missing"] = out["selection_by_position"].agg(
        filters.all_missing("selected_by_percent").alias("all_missing"))
    return out


def _no_rows(df: DataFrame) -> DataFrame:
    """One row, ``empty`` = no row in ``df`` (reads at most one row of it)."""
    return df.limit(1).agg((F.count(F.lit(1)) == 0).alias("empty"))


def live_dashboard(players: DataFrame, spec: filters.FilterSpec = filters.FilterSpec(),
                   compare: Sequence[str] = (), export_path: str | None = None,
                   on_zero: str = "ieee") -> dict[str, DataFrame]:
    """Every dataset of the live dashboard for one filter state (and optional export)."""
    data = live.live_metrics(players, on_zero=on_zero)
    chosen = filters.filter_live(data, spec)
    out = {f"board_{n}": boards.board(chosen, n) for n in BOARD_SPECS}
    out["value_chart"] = boards.chart_data(chosen, "value")
    out["momentum_chart"] = boards.chart_data(chosen, "momentum")
    out["comparison"] = filters.compare_players(data, compare)
    out["summary"] = stats.stat_summary(chosen)
    out["bounds"] = stats.bounds(data)
    out["options"] = stats.options(data)
    out["no_rows"] = _no_rows(chosen)
    if export_path:
        export_csv(chosen, export_path)
    return out


def load_history(spark: SparkSession, root: str, out_dir: str,
                 seasons: Sequence[str] | None = None,
                 families: Sequence[str] = FAMILIES,
                 schemas: dict[str, T.StructType] | None = None,
                 file_globs: dict[str, str] | None = None, infer: bool = False) -> dict[str, int]:
    """Landed CSV families -> one parquet dataset per family under ``out_dir``,
    partitioned by season.

    A file already loaded is not loaded again, a changed one replaces its earlier version
    (``streaming.incremental``). Later seasons may add columns: runs append, and ``read_history``
    merges the schemas. Rows that did not parse go to a partition of their own
    (``read_quarantine``). With ``infer`` the kinds of values are noted, for
    ``read_history(..., infer=True)``. ``file_globs`` replaces a family's file pattern within its folder.
    Returns the number of new files per family.
    """
    loaded = {}
    for family in families:
        globs = [family_glob(root, family, s, (file_globs or {}).get(family)) for s in (seasons or ["*"])]
        loaded[family] = batch_ingest(
            spark, globs, f"{out_dir.rstrip('/')}/{family}", (schemas or {}).get(family),
            transform=partial(with_path_keys, family=family), partition_by=["season"], infer=infer)
    return loaded


def read_history(spark: SparkSession, out_dir: str, family: str, infer: bool = False) -> DataFrame:
    """A family's rows that parsed, with the union of all seasons' columns; with ``infer`` as the
    types that all seasons loaded so far ask for."""
    return read_target(spark, f"{out_dir.rstrip('/')}/{family}", infer)


__all__ = ["load_snapshot_file", "build_models", "refresh_models", "board_dashboard", "live_dashboard",
           "load_history", "read_history", "CHARTS"]
