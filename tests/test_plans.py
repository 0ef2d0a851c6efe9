import json
import os

from pyspark.sql import types as T

from statmart.operators import stats
from statmart.operators.filters import FilterSpec
from statmart.plans import models
from tests.conftest import rows


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def _element(i, **kw):
    base = {"id": i, "first_name": f"F{i}", "second_name": f"S{i}", "web_name": f"P{i % 3}",
            "team": i % 22, "element_type": i % 5, "now_cost": 40 + i, "selected_by_percent": "1.5",
            "form": "2.0", "points_per_game": "3.5", "total_points": 10 * i, "minutes": 90 * i,
            "goals_scored": i % 4, "assists": 1, "clean_sheets": 2, "goals_conceded": 3,
            "own_goals": 0, "penalties_saved": 0, "penalties_missed": 0, "yellow_cards": 1,
            "red_cards": 0, "saves": 0, "bonus": 2, "bps": 20, "influence": f"{i * 1.5}",
            "creativity": "2.0", "threat": "3.0", "ict_index": "4.0", "value_form": "0.5",
            "value_season": "1.5", "starts": i, "expected_goals": "0.5", "expected_assists": "0.25",
            "expected_goal_involvements": "0.75", "expected_goals_conceded": "1.0"}
    base.update(kw)
    return base


def test_snapshot_models_and_dashboards(spark, tmp_dir):
    doc = {"elements": [_element(i) for i in range(25)] + [_element(99, minutes=0, starts=0)],
           "teams": [{"id": 1, "name": "Arsenal"}]}
    _write(f"{tmp_dir}/snap/bootstrap.json", json.dumps(doc))
    db = "t_plans"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    assert models.load_snapshot_file(spark, f"{tmp_dir}/snap/bootstrap.json", db) == [
        f"{db}.players", f"{db}.teams"]
    mart = models.build_models(spark, db)
    assert mart.count() == 26 and "last_updated" in mart.columns
    assert dict(mart.dtypes)["form"] == "double" and dict(mart.dtypes)["influence"] == "double"
    zero = mart.where("id = 99").first()
    assert zero.goals_per_90 == 0.0 and zero.minutes_per_start == 0.0

    board = models.board_dashboard(mart, position="MID", min_price=4.0, min_points=0)
    top = board["top_performers"].collect()
    assert 0 < len(top) <= 10 and all(r.position == "MID" for r in top)
    assert board["influence"].count() == min(20, board["form_price"].count())
    assert board["last_updated"].count() == 1
    apart = {"selection_by_position": stats.selection_by_position(mart), "bounds": stats.bounds(mart),
             "metrics_by_position": stats.metrics_by_position(mart), "options": stats.options(mart, ["position"]),
             "last_updated": stats.latest_update(mart)}
    for name, other in apart.items():
        assert sorted(map(str, board[name].collect())) == sorted(map(str, other.collect())), name
    assert board["no_rows"].first().empty is False
    assert board["selection_missing"].first().all_missing is False
    nothing = models.board_dashboard(mart, position="MID", min_price=1e9)
    assert nothing["no_rows"].first().empty is True
    assert {r.position for r in board["selection_by_position"].collect()} <= {
        "GK", "DEF", "MID", "FWD", "Unknown"}

    players = spark.table(f"{db}.players")
    live = models.live_dashboard(players, FilterSpec(), compare=["P1"],
                                 export_path=f"{tmp_dir}/export")
    assert live["board_overview"].count() == 24  # ids 0 and 99 have zero minutes
    assert live["comparison"].count() == 8  # every P1, unfiltered (ids 1, 4, ..., 22)
    summary = {r.stat: r for r in live["summary"].collect()}
    assert summary["total_points"].p90 >= summary["total_points"].median
    assert len([f for f in os.listdir(f"{tmp_dir}/export") if f.endswith(".csv")]) >= 1


def test_load_history_once_per_file_with_new_columns(spark, tmp_dir):
    root, out = f"{tmp_dir}/land", f"{tmp_dir}/bronze"
    _write(f"{root}/data/2022-23/gws/gw1.csv", "name,mins\na,90\n")
    schemas = {"gw": T.StructType([T.StructField("mins", T.IntegerType())])}
    first = models.load_history(spark, root, out, families=["gw", "players"], schemas=schemas)
    assert first == {"gw": 1, "players": 0}
    _write(f"{root}/data/2023-24/gws/gw1.csv", "name,starts,mins\nb,1,45\n")
    second = models.load_history(spark, root, out, families=["gw"], schemas=schemas)
    assert second == {"gw": 1}
    assert models.load_history(spark, root, out, families=["gw"], schemas=schemas) == {"gw": 0}
    got = models.read_history(spark, out, "gw")
    assert sorted(rows(got, "name", "starts", "mins", "season", "table_name")) == [
        ("a", None, 90, "2022-23", "gw_2022_23_gw1"), ("b", "1", 45, "2023-24", "gw_2023_24_gw1")]


def test_dashboard_summaries_scan_once_and_empty(spark, tmp_dir):
    columns = ["id", "position", "team", "selected_by_percent", "price", "total_points", "goals_per_90"]
    data = [(i, [None, "MID", "DEF"][i % 3], i % 4, float(i), i / 2, i, None if i % 5 == 0 else i / 7) for i in range(40)]
    spark.createDataFrame(data, columns).write.parquet(f"{tmp_dir}/mart")
    df = spark.read.parquet(f"{tmp_dir}/mart")
    for frame in (df, df.where("id < 0")):
        found = stats.dashboard_summaries(frame, option_columns=("position", "team"))
        assert "last_updated" not in found
        apart = {"selection_by_position": stats.selection_by_position(frame), "bounds": stats.bounds(frame),
                 "metrics_by_position": stats.metrics_by_position(frame), "options": stats.options(frame)}
        for name, other in apart.items():
            assert found[name].columns == other.columns
            assert sorted(map(str, found[name].collect())) == sorted(map(str, other.collect())), name
            assert "parquet" not in found[name]._jdf.queryExecution().executedPlan().toString().lower()
