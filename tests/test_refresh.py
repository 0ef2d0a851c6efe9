"""Tables refreshed by changed rows: equal to a full build, bytes in proportion to the change."""

import pathlib
import random

import pytest
from pyspark.sql import functions as F

from statmart.operators.mart import build_mart
from statmart.plans import models
from statmart.sinks import refresh, tables
from tests.conftest import rows
from tests.test_plans import _element


def _db(spark, tmp_dir, name):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {name} LOCATION '{tmp_dir}/db'")
    return name


def _bytes(spark, table):
    detail = {r.col_name: r.data_type for r in spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()}
    place = pathlib.Path(detail["Location"].removeprefix("file:"))
    return sum(f.stat().st_size for f in place.glob("*.parquet"))


def _all(df):
    return sorted(map(repr, rows(df)))


def test_one_percent_changed_writes_about_one_percent(spark, tmp_dir):
    db = _db(spark, tmp_dir, "t_refresh_share")
    wide = [F.sha2(F.concat_ws("-", F.col("id"), F.lit(i)), 256).alias(f"c{i}") for i in range(6)]
    first = spark.range(40_000).select("id", *wide)
    first.write.saveAsTable(f"{db}.one")
    (first.withColumn("c0", F.when(F.xxhash64("id") % 100 == 0, F.lit("new")).otherwise(F.col("c0")))
     .write.saveAsTable(f"{db}.two"))
    two = spark.table(f"{db}.two")
    touched = two.where("c0 = 'new'").count()
    assert refresh.refresh_table(f"{db}.t", "id", [(spark.table(f"{db}.one"), "id")])["kind"] == "full"
    done = refresh.refresh_table(f"{db}.t", "id", [(two, "id")])
    assert done == {"kind": "delta", "keys": touched, "gone": 0} and 300 < touched < 500
    state = refresh.refresh_state(spark, f"{db}.t")
    delta, base = state["deltas"][0], state["base"]
    assert spark.table(delta[0]).count() == touched
    assert sum(_bytes(spark, t) for t in delta) < 0.02 * sum(_bytes(spark, t) for t in base)
    got = spark.table(f"{db}.t")
    assert got.exceptAll(two).isEmpty() and two.exceptAll(got).isEmpty()
    assert refresh.refresh_table(f"{db}.t", "id", [(two, "id")])["kind"] == "none"
    # a filter on the table reaches the scans of base and delta
    plan = got.where("c1 = 'x'")._jdf.queryExecution().toString()
    assert plan.count("EqualTo(c1,x)") >= 2


def test_random_snapshots_equal_full_builds(spark, tmp_dir):
    """Changed, new, leaving and returning players, several fact rows and null ids, with folds between."""
    db = _db(spark, tmp_dir, "t_refresh_random")
    rng = random.Random(7)
    schema = spark.createDataFrame([_element(1)]).schema
    pool = {i: _element(i) for i in range(60)}
    kinds, folded = [], False
    for step in range(6):
        for i in rng.sample(range(60), 4):
            pool[i] = None if rng.random() < 0.3 else _element(i, minutes=rng.randrange(900), form=None if i % 2 else "1.0")
        found = [e for e in pool.values() if e] + [dict(_element(0), id=None, web_name=None)]
        spark.createDataFrame(found, schema).write.saveAsTable(f"{db}.players_{step}")
        players = spark.table(f"{db}.players_{step}")
        dim = models.dim_players(players)
        fact = models.fact_player_history(players)
        fact = fact.unionByName(fact.where("player_id % 5 = 0"))  # two equal rows of a player
        done = refresh.refresh_table(f"{db}.mart", "id", [(dim, "id"), (fact, "player_id")],
                                     lambda d, f: build_mart(d, f, last_updated=False), fold_share=0.3)
        kinds.append(done["kind"])
        folded |= step > 1 and not refresh.refresh_state(spark, f"{db}.mart")["deltas"]
        assert _all(spark.table(f"{db}.mart")) == _all(build_mart(dim, fact, last_updated=False)), step
    assert kinds[0] == "full" and "delta" in kinds and folded
    before = _all(spark.table(f"{db}.mart"))
    refresh.fold_table(spark, f"{db}.mart")
    assert refresh.drop_unused_versions(spark, f"{db}.mart") > 0
    assert _all(spark.table(f"{db}.mart")) == before
    assert len(tables.versions(spark, f"{db}.mart")) == len(tables.versions(spark, f"{db}.mart__keys")) == 1


def test_null_keys_moved_nulls_and_swapped_values_are_changes(spark, tmp_dir):
    db = _db(spark, tmp_dir, "t_refresh_nulls")
    steps = [[(1, "a", None), (2, "a", "b"), (None, "n", "n"), (3, "x", "x"), (3, "y", "y")] + [(9 + i, "z", "z") for i in range(30)]]
    steps.append([(1, None, "a"), (2, "b", "a"), (None, "n", None), (3, "x", "y"), (3, "y", "x")] + steps[0][5:])
    steps.append(steps[1][:3] + steps[0][5:])
    for n, found in enumerate(steps):
        df = spark.createDataFrame(found, "k long, a string, b string")
        done = refresh.refresh_table(f"{db}.t", "k", [(df, "k")])
        assert _all(spark.table(f"{db}.t")) == _all(df)
        assert (done["kind"], done["keys"]) == [("full", 34), ("delta", 4), ("delta", 1)][n]
    assert done["gone"] == 1
    # no rows at all keep the table; other columns, or too many changes, build it anew
    empty = spark.createDataFrame([], "k long, a string, b string")
    assert refresh.refresh_table(f"{db}.t", "k", [(empty, "k")])["kind"] == "none"
    assert _all(spark.table(f"{db}.t")) == _all(df)
    more = df.withColumn("c", F.lit(1))
    assert refresh.refresh_table(f"{db}.t", "k", [(more, "k")])["kind"] == "full"
    assert _all(spark.table(f"{db}.t")) == _all(more)
    other = more.withColumn("c", F.lit(2))
    assert refresh.refresh_table(f"{db}.t", "k", [(other, "k")])["kind"] == "full"
    assert _all(spark.table(f"{db}.t")) == _all(other)


@pytest.mark.parametrize("step", ["_write_version", "_commit"])
def test_a_refresh_that_dies_leaves_the_table(spark, tmp_dir, monkeypatch, step):
    db = _db(spark, tmp_dir, f"t_refresh_dies{step}")
    one = spark.range(50).withColumn("v", F.lit(1))
    two = one.withColumn("v", F.when(F.col("id") == 3, 2).otherwise(1))
    refresh.refresh_table(f"{db}.t", "id", [(one, "id")])
    real, calls = getattr(refresh, step), []

    def dies(*args, **kw):
        calls.append(args)
        if step == "_commit" or len(calls) == 2:  # the second write is that of the rows
            raise RuntimeError("lost")
        return real(*args, **kw)
    monkeypatch.setattr(refresh, step, dies)
    with pytest.raises(RuntimeError, match="lost"):
        refresh.refresh_table(f"{db}.t", "id", [(two, "id")])
    monkeypatch.undo()
    assert _all(spark.table(f"{db}.t")) == _all(one)
    assert refresh.refresh_table(f"{db}.t", "id", [(two, "id")]) == {"kind": "delta", "keys": 1, "gone": 0}
    assert _all(spark.table(f"{db}.t")) == _all(two)
    assert refresh.drop_unused_versions(spark, f"{db}.t") >= 1
    assert _all(spark.table(f"{db}.t")) == _all(two)


def test_refreshed_models_take_changed_players_only(spark, tmp_dir):
    db = _db(spark, tmp_dir, "t_refresh_models")
    first = [_element(i) for i in range(40)]
    tables.replace_table(spark.createDataFrame(first), f"{db}.players")
    assert {d["kind"] for d in models.refresh_models(spark, db, last_updated=F.lit(1)).values()} == {"full"}
    first[4]["minutes"] = 7          # fact only
    first[5]["web_name"] = "Other"   # dim only
    tables.replace_table(spark.createDataFrame(first), f"{db}.players")
    done = models.refresh_models(spark, db, last_updated=F.lit(2))
    assert {n: d["keys"] for n, d in done.items()} == {"dim_players": 1, "fact_player_history": 1, "player_stats": 2}
    assert sorted(rows(spark.table(f"{db}.player_stats").where("last_updated = 2"), "id")) == [(4,), (5,)]
