import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from statmart.operators import boards, filters, live, stats
from statmart.operators.conform import dim_players, fact_player_history
from statmart.operators.mart import build_mart, mart_from_players
from statmart.operators.quantiles import exact_quantiles
from statmart.schemas import DIM_COLUMNS, FACT_COLUMNS
from tests.conftest import rows

TEXT = {"selected_by_percent", "form", "points_per_game", "value_form", "value_season"}


def _players(spark, data):
    """Players rows from dicts; unspecified columns get a neutral default."""
    cols = list(dict.fromkeys(DIM_COLUMNS + FACT_COLUMNS))

    def typ(c):
        if c in ("id",):
            return "long"
        if c in ("first_name", "second_name", "web_name") or c in TEXT:
            return "string"
        if c in ("now_cost", "influence", "creativity", "threat", "ict_index", "expected_goals",
                 "expected_assists", "expected_goal_involvements", "expected_goals_conceded"):
            return "double"
        return "int"

    defaults = {c: ("1.0" if c in TEXT else "x" if typ(c) == "string" else 1) for c in cols}
    schema = ", ".join(f"{c} {typ(c)}" for c in cols)
    recs = []
    for d in data:
        r = {**defaults, **d}
        recs.append(tuple(float(r[c]) if typ(c) == "double" and r[c] is not None else r[c]
                          for c in cols))
    return spark.createDataFrame(recs, schema)


def test_mart_zero_minutes_rule_and_join_equals_single_scan(spark):
    p = _players(spark, [
        {"id": 1, "minutes": 0, "total_points": 3, "now_cost": 105, "element_type": 9},
        {"id": 2, "minutes": 180, "total_points": 12, "goals_scored": 2, "starts": 2,
         "now_cost": 50, "element_type": 3},
        {"id": 3, "minutes": None, "total_points": -1, "now_cost": 0, "form": "x"},
    ])
    one = mart_from_players(p, last_updated=False)
    joined = build_mart(dim_players(p), fact_player_history(p), last_updated=False)
    assert sorted(rows(one)) == sorted(rows(joined))
    got = {r["id"]: r for r in one.collect()}
    assert got[1]["price"] == 10.5 and got[1]["position"] == "Unknown"
    assert got[1]["goals_per_90"] == 0.0 and got[1]["points_per_90"] == 0.0
    assert got[2]["goals_per_90"] == 1.0 and got[2]["points_per_million"] == 12 / 5.0
    assert got[2]["minutes_per_start"] == 90.0 and got[2]["position"] == "MID"
    assert got[3]["points_per_million"] == 0.0 and got[3]["form"] is None
    assert "starts" not in one.columns and len(one.columns) == 41
    assert one.columns[:12] == DIM_COLUMNS + ["price"]


def test_live_metrics_zero_modes(spark):
    p = _players(spark, [
        {"id": 1, "minutes": 0, "total_points": 3, "team": 99},
        {"id": 2, "minutes": 0, "total_points": 0, "team": 1},
        {"id": 3, "minutes": 0, "total_points": -1, "element_type": 9},
    ])
    ieee = {r["id"]: r for r in live.live_metrics(p).collect()}
    assert ieee[1]["points_per_90"] == math.inf and math.isnan(ieee[2]["points_per_90"])
    assert ieee[3]["points_per_90"] == -math.inf
    assert ieee[1]["team"] == "Unknown" and ieee[2]["team"] == "Arsenal"
    assert ieee[3]["position"] is None and ieee[1]["position"] == "GK"
    nul = {r["id"]: r["points_per_90"] for r in live.live_metrics(p, on_zero="null").collect()}
    assert nul == {1: None, 2: None, 3: None}


def _board_frame(spark):
    return spark.createDataFrame(
        [(1, "a", "MID", "Arsenal", 5.0, 3, 100), (2, "b", "FWD", "Chelsea", 7.5, None, 90),
         (3, "c", None, "Unknown", 10.0, 5, 80), (4, "a", "GK", "Arsenal", None, 1, 95)],
        "id long, web_name string, position string, team string, price double, "
        "total_points int, minutes int")


def test_filters(spark):
    df = _board_frame(spark)
    # full-range defaults drop only missing values (row 2: no points, row 4: no price)
    assert {r.id for r in filters.filter_live(df, filters.FilterSpec(
        positions=["All", "GK"], min_points=None, min_minutes=None)).collect()} == {1, 3}
    spec = filters.FilterSpec(positions=["MID", "FWD"], teams=["Arsenal", "Chelsea"],
                              price_range=(5.0, 7.5), min_points=0, min_minutes=90)
    assert [r.id for r in filters.filter_live(df, spec).collect()] == [1]  # ends kept, NULL dropped
    assert filters.filter_live(df, filters.FilterSpec(positions=[])).isEmpty()
    assert [r.id for r in filters.filter_board(df, "MID", 5.0, 3).collect()] == [1]
    assert [r.id for r in filters.filter_board(df).collect()] == [1, 3]


def test_compare(spark):
    df = _board_frame(spark)
    got = filters.compare_players(df, ["a"], columns=["id", "web_name"])
    assert sorted(r.id for r in got.collect()) == [1, 4]
    with pytest.raises(ValueError):
        filters.compare_players(df, ["a", "b", "c", "d"])
    assert filters.compare_players(df, [], columns=["id"]).isEmpty()


def test_all_missing_and_empty(spark):
    df = spark.createDataFrame([(1, None)], "a int, b double")
    assert df.agg(filters.all_missing("b")).first()[0] is True
    assert df.agg(filters.all_missing("a")).first()[0] is False
    assert filters.is_empty(df.where("a > 5"))


def test_sort_with_missing(spark):
    df = spark.createDataFrame([(1, 3.0), (2, None), (3, 5.0)], "id long, a double")
    assert [r.a for r in boards.tolerant_board(df, ["a"], "a").collect()] == [5.0, 3.0, None]
    assert [r.a for r in boards.tolerant_board(df, ["a"], "a", True).collect()] == [3.0, 5.0, None]


def test_tolerant_board(spark):
    df = _board_frame(spark)
    with pytest.warns(UserWarning):
        out = boards.tolerant_board(df, ["web_name", "nope", "team", "web_name"], sort_by="zzz")
    assert out.columns == ["web_name", "team"]
    assert [r.web_name for r in out.collect()] == ["c", "b", "a", "a"]


def test_top_k_ties_by_id(spark):
    df = spark.createDataFrame([(i, 10) for i in range(20, 0, -1)], "id long, total_points int")
    got = boards.top_k(df, "total_points", 10, columns=["id", "total_points"])
    assert [r.id for r in got.collect()] == list(range(1, 11))


def test_rank_top_keeps_ties_at_limit(spark):
    data = [(i, 100.0) for i in range(21)] + [(100 + i, float(i)) for i in range(30)]
    df = spark.createDataFrame(data, "id long, influence double")
    got = boards.rank_top(df, "influence", 20)
    assert got.count() == 21 and {r["rank"] for r in got.collect()} == {1}
    data2 = [(1, 5.0), (2, 5.0), (3, 4.0), (4, None), (5, 1.0)]
    got2 = {r.id: r["rank"] for r in boards.rank_top(
        spark.createDataFrame(data2, "id long, influence double"), "influence", 4).collect()}
    assert got2 == {1: 1, 2: 1, 3: 3, 5: 4}
    got3 = {r.id: r["rank"] for r in boards.rank_top(
        spark.createDataFrame(data2, "id long, influence double"), "influence", 10).collect()}
    assert got3[4] == 5


def test_quantiles_known_values(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 3.0), ("a", 4.0), ("b", 7.0),
                                ("b", None), ("b", float("nan"))], "k string, v double")
    got = {r.k: (r.median, r.p90) for r in
           exact_quantiles(df, "k", "v", {"median": 0.5, "p90": 0.9}).collect()}
    assert got["a"][0] == 2.5 and abs(got["a"][1] - 3.7) < 1e-12
    assert got["b"] == (7.0, 7.0)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=40),
       st.sampled_from([0.0, 0.1, 0.5, 0.9, 1.0]))
def test_quantiles_match_numpy(spark, values, p):
    df = spark.createDataFrame([("s", float(v)) for v in values], "k string, v double")
    got = exact_quantiles(df, "k", "v", {"q": p}).first()["q"]
    assert abs(got - float(np.quantile(np.array(values, dtype=float), p))) < 1e-9


def test_stat_summary_and_groups(spark):
    df = spark.createDataFrame(
        [("MID", 1, 1.0, "1"), ("MID", 2, 2.0, "x"), ("FWD", 3, 3.0, "3"), (None, 4, 4.0, "4")],
        "position string, id long, total_points double, selected_by_percent string")
    summ = {r.stat: r for r in stats.stat_summary(df, ["total_points"]).collect()}
    assert summ["total_points"].mean == 2.5 and summ["total_points"].median == 2.5
    assert summ["total_points"].p90 >= summ["total_points"].median
    sel = {r.position: (r.id, r.selected_by_percent) for r in
           stats.selection_by_position(df).collect()}
    assert sel == {"MID": (2, 1.0), "FWD": (1, 3.0)}  # NULL group absent, 'x' ignored
    assert sum(v[0] for v in sel.values()) == df.where("position IS NOT NULL").count()
    m = {r.position: r.total_points for r in
         stats.metrics_by_position(df, ["total_points", "absent"]).collect()}
    assert m == {"MID": 1.5, "FWD": 3.0}
    b = stats.bounds(df, ["total_points"]).first()
    assert (b.total_points_min, b.total_points_max) == (1.0, 4.0)
    opts = rows(stats.options(df, ["position"]))
    assert opts == [("position", "FWD"), ("position", "MID"), ("position", "nan")]


def test_summary_text(spark):
    df = spark.createDataFrame([("a", 2.675)], "stat string, mean double")
    assert stats.summary_text(df).first().mean_text == "2.67"


def test_stat_summary_approx_switch(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 101)], "total_points double")
    exact = stats.stat_summary(df, ["total_points"]).first()
    approx = stats.stat_summary(df, ["total_points"], exact=False).first()
    assert exact.median == 50.5 and abs(exact.p90 - 90.1) < 1e-9
    assert approx.mean == exact.mean and approx.median in (50.0, 51.0)
    assert approx.p90 in (90.0, 91.0)


def test_price_range_keeps_both_ends(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 7.5), (3, 7.51), (4, 4.99)], "id long, price double")
    spec = filters.FilterSpec(positions=None, teams=None, price_range=(5.0, 7.5),
                              min_points=None, min_minutes=None)
    got = sorted(r.id for r in df.where(filters.within("price", spec.price_range)).collect())
    assert got == [1, 2]


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["GK", "DEF", "MID"]), st.integers(0, 5),
                          st.integers(0, 200)), min_size=1, max_size=30))
def test_properties_identity_filter_and_rank_size(spark, data):
    recs = [(i, pos, "Arsenal", 5.0 + i, pts, mins, float(pts % 7))
            for i, (pos, pts, mins) in enumerate(data)]
    df = spark.createDataFrame(recs, "id long, position string, team string, price double, "
                                     "total_points int, minutes int, influence double")
    off = filters.FilterSpec(min_points=None, min_minutes=None)
    assert filters.filter_live(df, off).count() == len(recs)
    ranked = boards.rank_top(df, "influence", 20)
    assert ranked.count() >= min(20, len(recs))
    assert all(r["rank"] <= 20 for r in ranked.collect())


def test_quantiles_with_a_hot_value_and_many_groups(spark):
    rng = np.random.default_rng(7)
    data = []
    for g in "abcdefghijkl":  # more groups than shuffle partitions
        vals = np.concatenate([np.full(1000, 42.0), [3e9, 4e9], rng.normal(40, 10, 2000).round(3)])
        data += [(g, float(v)) for v in vals]
    df = spark.createDataFrame(data, "k string, v double")
    probs = {"p10": 0.1, "median": 0.5, "p90": 0.9, "top": 1.0}
    got = {r.k: r for r in exact_quantiles(df, "k", "v", probs).collect()}
    for g in "abcdefghijkl":
        vals = np.array([v for k, v in data if k == g])
        for name, p in probs.items():
            assert abs(got[g][name] - float(np.quantile(vals, p))) < 1e-9


def test_stat_summary_on_empty_input(spark):
    df = spark.createDataFrame([], "total_points double, assists double")
    got = {r.stat: (r.mean, r.median, r.p90) for r in
           stats.stat_summary(df, ["total_points", "assists"]).collect()}
    assert got == {"total_points": (None, None, None), "assists": (None, None, None)}


@pytest.mark.parametrize("accuracy", [16, 200, 10_000])
def test_quantile_bands_equal_numpy(spark, accuracy):
    from statmart.operators.quantiles import summaries

    rng = np.random.default_rng(4)
    n = 30_000
    groups = np.where(rng.random(n) < 0.01, "small", np.where(rng.random(n) < 0.5, "hot", "wide"))
    values = np.where((groups == "hot") & (rng.random(n) < 0.6), 7.25, np.round(rng.lognormal(3, 4, n), 3))
    values[:40] = [np.nan, np.inf, -np.inf, -0.0] * 10
    import pandas as pd
    df = spark.createDataFrame(pd.DataFrame({"k": groups, "v": values})).repartition(7)
    df = df.unionByName(spark.createDataFrame([("none", None), ("one", 3.5), ("two", 1.0), ("two", 2.0)], "k string, v double"))
    probs = {"least": 0.0, "median": 0.5, "p90": 0.9, "p999": 0.999, "most": 1.0}
    got = {r.k: r for r in summaries(df, "k", "v", probs, accuracy).collect()}
    assert set(got) == {"small", "hot", "wide", "one", "two"} and got["two"].median == 1.5
    for g in ("small", "hot", "wide"):
        own = np.sort(values[(groups == g) & ~np.isnan(values)])
        assert got[g].n == len(own)
        for name, p in probs.items():
            pos = (len(own) - 1) * p
            a, b = own[int(np.floor(pos))], own[int(np.ceil(pos))]
            assert got[g][name] == (a if a == b or pos == int(pos) else a + (b - a) * (pos - int(pos)))


def test_bands_are_widened_until_they_hold_the_ranks(spark, monkeypatch):
    from statmart.operators import quantiles

    honest = quantiles._brackets

    def wrong(values, probs, margin, accuracy):  # a sketch far off while the margin is small
        found = honest(values, probs, margin, accuracy)
        return found if margin > 0.5 else found.withColumn("_ends", F.transform("_ends", lambda x: x - 1e6))

    monkeypatch.setattr(quantiles, "_brackets", wrong)
    df = spark.range(5000).select(F.lit("g").alias("k"), F.col("id").cast("double").alias("v"))
    assert quantiles.exact_quantiles(df, "k", "v", {"q": 0.5}, 4000).first()["q"] == 2499.5


def test_rank_top_scans_once_and_limits_before_the_shuffle(spark):
    df = spark.range(0, 20_000, numPartitions=6).select("id", F.when(F.col("id") % 3 == 0, 50.0).otherwise(F.col("id") % 40).alias("v"))
    text = boards.leading_rows(df, "v", 20)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Range") == 1 and "WindowGroupLimit" in text
    got = boards.rank_top(df, "v", 20)
    assert got.count() == 6667 and {r["rank"] for r in got.select("rank").distinct().collect()} == {1}
    few = {r.id: r["rank"] for r in boards.rank_top(df.where("id < 9"), "v", 4).collect()}
    assert few == {0: 1, 3: 1, 6: 1, 8: 4}
