"""Plans over a written gold table: filters reach the parquet scan, only used columns are read,
top-k stays a bounded TakeOrderedAndProject, and rank <= k has no single-partition window
over the data."""

from statmart.operators import boards, filters
from statmart.operators.mart import mart_from_players
from statmart.sources import testdata

SF = "/root/testdata/sf0.001"


def _plan(df):
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _gold(spark, tmp_dir):
    path = f"{tmp_dir}/gold"
    mart_from_players(testdata.players(spark, SF), last_updated=False).write.parquet(path)
    return spark.read.parquet(path)


def test_filters_and_columns_reach_the_scan(spark, tmp_dir):
    gold = _gold(spark, tmp_dir)
    q = filters.filter_board(gold, position="MID", min_price=95.0, min_points=800) \
        .select("id", "web_name", "price")
    plan = _plan(q)
    assert "PushedFilters: [IsNotNull(position), IsNotNull(price), IsNotNull(total_points), " \
           "EqualTo(position,MID), GreaterThanOrEqual(price,95.0), " \
           "GreaterThanOrEqual(total_points,800)]" in plan
    read = plan.split("ReadSchema: ")[1].split(">")[0]
    assert read == "struct<id:bigint,web_name:string,total_points:int,price:double,position:string"


def test_top_k_and_rank_are_bounded(spark, tmp_dir):
    gold = _gold(spark, tmp_dir)
    assert "TakeOrderedAndProject" in _plan(boards.top_k(gold, "points_per_million"))
    ranked = boards.rank_top(gold.select("id", "influence"), "influence", 20)
    plan = _plan(ranked)
    # the only window runs over the <= 20 rows of the top-k, never over the data
    assert "TakeOrderedAndProject" in plan and "BroadcastHashJoin" in plan
    assert plan.count("Window (") <= 1 and "Arguments: 20," in plan


def test_bucketed_models_join_without_shuffle(spark, tmp_dir):
    from statmart.operators.conform import dim_players
    from statmart.operators.mart import build_mart
    from statmart.plans.models import build_models
    from statmart.sinks.tables import replace_table
    db = "t_bucketed"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{tmp_dir}/db'")
    replace_table(testdata.players(spark, SF), f"{db}.players")
    mart = build_models(spark, db, last_updated=False, buckets=4)
    assert mart.count() == spark.table(f"{db}.players").count()
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = build_mart(spark.table(f"{db}.dim_players"),
                            spark.table(f"{db}.fact_player_history"), last_updated=False)
        plan = _plan(joined)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert replace_table(dim_players(spark.table(f"{db}.players")), f"{db}.dim_players",
                         bucket_by=(4, "id"))
    assert spark.table(f"{db}.dim_players").count() == mart.count()


def test_selective_player_filter_reaches_lineitem_as_bloom_filter(spark):
    from statmart.operators import live as live_ops
    conf = {"spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    prev = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        data = live_ops.live_metrics(testdata.players(spark, SF))
        q = filters.compare_players(data, ["small ring"])
        q.collect()
        plan = q._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.set(k, v)
    assert "might_contain" in plan and "xxhash64(l_partkey" in plan


def test_options_is_one_scan(spark, tmp_dir):
    from statmart.operators import stats
    gold = _gold(spark, tmp_dir)
    tree = _plan(stats.options(gold, ["position", "team"])).split("\n\n")[0]
    assert tree.count("Scan parquet") == 1 and "Expand" in tree
