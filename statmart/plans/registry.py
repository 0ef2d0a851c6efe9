"""Registered queries over the driver's tables: name -> (spark, sf_dir) -> DataFrame.

Each query reads the whole given tables (or what Spark derives from them). Double
columns are rounded to 6 places at the very end, so the DuckDB oracle can be compared
without last-bit differences from summation order.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from statmart.functions.arith import round_fixed
from statmart.operators import boards, filters, live, stats
from statmart.operators.conform import dim_players, fact_player_history, typed_dim
from statmart.operators.mart import build_mart, mart_from_players
from statmart.schemas import SUMMARY_STATS
from statmart.sources import testdata

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

DECIMALS = 6


def rounded(df: DataFrame, decimals: int = DECIMALS) -> DataFrame:
    """Round every double column (top level) to ``decimals`` places."""
    exprs = {f.name: round_fixed(F.col(f.name), decimals) for f in df.schema.fields
             if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.withColumns(exprs) if exprs else df


def query(name: str, round_output: bool = True):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            out = fn(spark, sf_dir)
            return rounded(out) if round_output else out
        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        return run
    return deco


# --- shared plans -------------------------------------------------------------------------

def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return testdata.players(spark, sf_dir)


def mart(spark: SparkSession, sf_dir: str, last_updated=False) -> DataFrame:
    """Gold mart from one scan of the players snapshot (load time left out by default)."""
    return mart_from_players(players(spark, sf_dir), last_updated=last_updated)


def live_data(spark: SparkSession, sf_dir: str, on_zero: str = "null") -> DataFrame:
    return live.live_metrics(players(spark, sf_dir), on_zero=on_zero)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 10 value players (points per million) from the gold mart."""
    return rounded(boards.top_k(mart(spark, sf_dir), "points_per_million"))


# --- projections and the mart ---------------------------------------------------------------

@query("dim_projection")
def q_dim_projection(spark, sf_dir):
    """Dimension projection of the players source."""
    return dim_players(players(spark, sf_dir))


@query("fact_projection")
def q_fact_projection(spark, sf_dir):
    """Fact projection, id renamed to player_id."""
    return fact_player_history(players(spark, sf_dir))


@query("cast_replace")
def q_cast_replace(spark, sf_dir):
    """Dim text columns replaced in place by typed casts, plus price."""
    return typed_dim(dim_players(players(spark, sf_dir)))


@query("mart_join")
def q_mart_join(spark, sf_dir):
    """Mart built by joining the dim and fact models on id = player_id.

    Both models read one materialised source, as they read one source table: the
    stand-in is written once instead of being aggregated from lineitem per side.
    """
    from statmart.session import materialize
    p = materialize(players(spark, sf_dir), "players")
    return build_mart(dim_players(p), fact_player_history(p), last_updated=False)


@query("mart_full")
def q_mart_full(spark, sf_dir):
    """P5: full mart from one scan (no self-join)."""
    return mart(spark, sf_dir)


@query("mart_position")
def q_mart_position(spark, sf_dir):
    """Position label with 'Unknown' default."""
    return mart(spark, sf_dir).select("id", "element_type", "position")


@query("mart_per90")
def q_mart_per90(spark, sf_dir):
    """Guarded per-90 rates (0 when minutes <= 0)."""
    return mart(spark, sf_dir).select("id", "minutes", "goals_per_90", "assists_per_90",
                                      "xG_per_90", "xA_per_90", "points_per_90")


@query("mart_value")
def q_mart_value(spark, sf_dir):
    """Guarded points per million and minutes per start."""
    return mart(spark, sf_dir).select("id", "price", "points_per_million", "minutes_per_start")


@query("price")
def q_price(spark, sf_dir):
    """Price from cost in tenths."""
    return mart(spark, sf_dir).select("id", "now_cost", "price")


# --- leaderboards ---------------------------------------------------------------------------

@query("topk_points")
def q_topk_points(spark, sf_dir):
    """Top 10 by total points (ties by id)."""
    return boards.top_k(mart(spark, sf_dir), "total_points")


@query("topk_value")
def q_topk_value(spark, sf_dir):
    """Top 10 by points per million (ties by id); the flagship."""
    return boards.top_k(mart(spark, sf_dir), "points_per_million")


@query("rank_top20")
def q_rank_top20(spark, sf_dir):
    """Influence chart rows with rank() <= 20, ties kept."""
    return boards.influence_chart(mart(spark, sf_dir)).withColumn("rank", F.col("rank").cast("long"))


# --- live dashboard: metrics, lookups, coercion -------------------------------------------

LIVE_OUT = ["id", "web_name", "team", "position", "price", "points_per_million",
            "points_per_90", "goals_per_90", "assists_per_90", "goal_involvement_per_90",
            "xGI_per_90", "clean_sheet_percentage", "goals_conceded_per_90",
            "value_ppg_per_cost"]


LIVE_RATIOS = ["points_per_million", "points_per_90", "goals_per_90", "assists_per_90",
               "xGI_per_90", "value_ppg_per_cost"]


@query("live_metrics")
def q_live_metrics(spark, sf_dir):
    """Ten derived metrics; zero denominators give NULL in this run."""
    return live_data(spark, sf_dir).select(*LIVE_OUT)


@query("live_metrics_ieee")
def q_live_metrics_ieee(spark, sf_dir):
    """E9-E11 by the live rule: x/0 gives an infinity, 0/0 NaN, a missing number NULL."""
    return live_data(spark, sf_dir, on_zero="ieee").select("id", *LIVE_RATIOS)


@query("lookup_team")
def q_lookup_team(spark, sf_dir):
    """Team id -> name, 'Unknown' when the id has no name."""
    return live_data(spark, sf_dir).select("id", "team")


@query("lookup_position")
def q_lookup_position(spark, sf_dir):
    """Element type -> position, NULL when the code has no label."""
    return live_data(spark, sf_dir).select("id", "element_type", "position")


@query("coerce_numeric")
def q_coerce_numeric(spark, sf_dir):
    """Text -> number, bad text -> NULL (events.props $.k, event_type, value)."""
    from statmart.functions.coerce import to_number
    ev = testdata.read_table(spark, sf_dir, "events").select(
        "event_id", F.get_json_object("props", "$.k").alias("k"), "event_type", "value")
    return ev.select("event_id", to_number(ev, "k").alias("k"),
                     to_number(ev, "event_type").alias("event_type_num"),
                     to_number(ev, "value").alias("value"))


@query("coerce_priority")
def q_coerce_priority(spark, sf_dir):
    """Text before '-' -> rounded integer (orders.o_orderpriority)."""
    from statmart.functions.coerce import to_int
    o = testdata.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", F.substring_index("o_orderpriority", "-", 1).alias("priority"))
    return o.select("o_orderkey", to_int(o, "priority").alias("priority"))


# --- filters ----------------------------------------------------------------------------------

FILTER_OUT = ["id", "web_name", "team", "position", "price", "total_points", "minutes"]
COMPOUND = filters.FilterSpec(positions=("MID", "FWD"),
                              teams=("Arsenal", "Chelsea", "Liverpool", "Unknown"),
                              price_range=(92.5, 97.5), min_points=600, min_minutes=90)
COMPARE_NAMES = ("small ring", "red widget", "blue bolt")


@query("filter_position")
def q_filter_position(spark, sf_dir):
    """position equality on the mart (other sliders at their full-range defaults)."""
    return filters.filter_board(mart(spark, sf_dir), position="MID").select(*FILTER_OUT)


@query("filter_bounds")
def q_filter_bounds(spark, sf_dir):
    """position AND price >= 95 AND total points >= 800."""
    return filters.filter_board(mart(spark, sf_dir), position="FWD", min_price=95.0,
                                min_points=800).select(*FILTER_OUT)


@query("filter_compound")
def q_filter_compound(spark, sf_dir):
    """Positions, teams, closed price range, points and minutes floors."""
    return filters.filter_live(live_data(spark, sf_dir), COMPOUND).select(*FILTER_OUT)


@query("compare_players")
def q_compare_players(spark, sf_dir):
    """F8/P10: up to three names on the unfiltered rows; repeated names all return."""
    return filters.compare_players(live_data(spark, sf_dir), COMPARE_NAMES)


# --- boards and charts ------------------------------------------------------------------------

def filtered_live(spark, sf_dir):
    return filters.filter_live(live_data(spark, sf_dir))


def filtered_mart(spark, sf_dir):
    return filters.filter_board(mart(spark, sf_dir))


def _board_query(name):
    @query(f"board_{name}")
    def q(spark, sf_dir):
        return boards.board(filtered_live(spark, sf_dir), name)
    q.__doc__ = f"P7/P9/O3: the {name} board on the filtered rows."
    return q


for _b in ("overview", "attacking", "defensive", "value"):
    _board_query(_b)


@query("board_tolerant")
def q_board_tolerant(spark, sf_dir):
    """Repeated and absent columns, absent sort key -> first column, ascending."""
    return boards.tolerant_board(filtered_live(spark, sf_dir),
                                 ["web_name", "nope", "team", "web_name", "price"],
                                 sort_by="not_a_column", ascending=True)


@query("chart_form_price")
def q_chart_form_price(spark, sf_dir):
    """Form vs price dataset on the filtered mart."""
    return boards.chart_data(filtered_mart(spark, sf_dir), "form_price")


@query("chart_xg_goals")
def q_chart_xg_goals(spark, sf_dir):
    """Expected vs actual goals dataset on the filtered mart."""
    return boards.chart_data(filtered_mart(spark, sf_dir), "xg_goals")


@query("chart_value")
def q_chart_value(spark, sf_dir):
    """Value analysis dataset on the filtered live rows."""
    return boards.chart_data(filtered_live(spark, sf_dir), "value")


@query("chart_momentum")
def q_chart_momentum(spark, sf_dir):
    """Form and momentum dataset on the filtered live rows."""
    return boards.chart_data(filtered_live(spark, sf_dir), "momentum")


# --- aggregates -------------------------------------------------------------------------------

@query("agg_selection")
def q_agg_selection(spark, sf_dir):
    """Per position, count of ids and mean selection percentage."""
    return stats.selection_by_position(mart(spark, sf_dir))


@query("agg_metrics")
def q_agg_metrics(spark, sf_dir):
    """Per-position means of five metrics, rounded to 2 (half to even)."""
    return stats.metrics_by_position(mart(spark, sf_dir))


@query("bounds")
def q_bounds(spark, sf_dir):
    """A4: min/max of price and total points."""
    return stats.bounds(mart(spark, sf_dir))


@query("dashboard_summaries")
def q_dashboard_summaries(spark, sf_dir):
    """A1-A5: the dashboard's small datasets from one scan of the mart, as (dataset, key, name, value) rows."""
    found = stats.dashboard_summaries(mart(spark, sf_dir))

    def long(dataset, key):
        names = [c for c in found[dataset].columns if c != "position"]
        values = found[dataset].select(key.alias("key"), *[F.col(c).cast("double").alias(c) for c in names])
        return values.unpivot(["key"], names, "name", "value").select(F.lit(dataset).alias("dataset"), "key", "name", "value")
    options = found["options"].select(F.lit("options").alias("dataset"), F.col("value").alias("key"),
                                      F.col("kind").alias("name"), F.lit(None).cast("double").alias("value"))
    return (long("selection_by_position", F.col("position")).unionByName(long("metrics_by_position", F.col("position")))
            .unionByName(long("bounds", F.lit(None).cast("string"))).unionByName(options))


@query("options")
def q_options(spark, sf_dir):
    """Sorted distinct positions (missing -> 'nan') and team names."""
    return stats.options(live_data(spark, sf_dir))


@query("latest_update")
def q_latest_update(spark, sf_dir):
    """A10: latest timestamp (events.ts stands in for the load time)."""
    ev = testdata.read_table(spark, sf_dir, "events").withColumnRenamed("ts", "last_updated")
    return stats.latest_update(ev)


@query("stat_summary")
def q_stat_summary(spark, sf_dir):
    """Mean, exact median and p90 of six statistics on the filtered rows."""
    return stats.stat_summary(_summary_input(spark, sf_dir))


def _summary_input(spark, sf_dir):
    """The filtered rows' statistics, written once: the summary scans them twice, as it scans a
    gold table, instead of building the stand-in from raw line items for each scan."""
    from statmart.session import materialize
    rows = filtered_live(spark, sf_dir)
    return materialize(rows.select(*filters.has_columns(rows, SUMMARY_STATS)), "summary-input")


@query("stat_summary_text")
def q_stat_summary_text(spark, sf_dir):
    """The summary's numbers as text with two decimals."""
    summary = stats.summary_text(rounded(stats.stat_summary(_summary_input(spark, sf_dir))))
    return summary.select("stat", "mean_text", "median_text", "p90_text")


# --- names, ingest, sinks ---------------------------------------------------------------------

@query("clean_names")
def q_clean_names(spark, sf_dir):
    """Table names a source gives its files (player folders, file names)."""
    from statmart.schemas import SEASONS
    from statmart.sources.csv_files import source_table_name
    season_now, season_before = F.lit(SEASONS[0]), F.lit(SEASONS[1])
    part = testdata.read_table(spark, sf_dir, "part")
    players_path = F.concat(F.lit("/data/"), season_now, F.lit("/players/"), F.col("p_name"),
                            F.lit("/gw.csv"))
    named_players = part.select(F.lit("player").alias("kind"), F.col("p_partkey").alias("key"),
                                source_table_name("players", season_now, players_path)
                                .alias("table_name"))
    pages = testdata.read_table(spark, sf_dir, "pages")
    named_understat = pages.select(F.lit("understat").alias("kind"), F.col("page_id").alias("key"),
                                   source_table_name("understat", season_before, F.col("url"))
                                   .alias("table_name"))
    named_gw = pages.select(F.lit("gw").alias("kind"), F.col("page_id").alias("key"),
                            source_table_name("gw", season_now, F.col("url")).alias("table_name"))
    return named_players.unionByName(named_understat).unionByName(named_gw)


def _fresh(spark, name):
    from statmart.plans.landing import fresh
    return fresh(spark, name)


@query("ingest_csv")
def q_ingest_csv(spark, sf_dir):
    """Part landed as CSV part files, read back by column name with types."""
    from statmart.plans.landing import land_csv
    from statmart.sources.csv_files import SOURCE, read_csv_files, split_quarantine
    part = testdata.read_table(spark, sf_dir, "part")
    root = _fresh(spark, "ingest-csv")
    land_csv(part, f"{root}/part")
    good, _bad = split_quarantine(read_csv_files(spark, f"{root}/part/*.csv", part.schema))
    return good.drop(SOURCE)


def _quoted_names(spark, sf_dir):
    """(good, put aside) of parts whose names hold quotes and separators, landed with one bad line."""
    from statmart.plans.landing import land_csv, land_lines
    from statmart.sources.csv_files import read_csv_files, write_bronze
    part = testdata.read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size")
    named = part.withColumn("p_name", F.concat(F.lit('"'), F.replace("p_name", F.lit(" "), F.lit(', "')), F.lit('"')))
    root = _fresh(spark, "ingest-quoted")
    land_csv(named, f"{root}/land")
    land_lines(part.select(F.concat(F.lit("x"), F.col("p_partkey"), F.lit(",bad,1")).alias("value")),
               "p_partkey,p_name,p_size", f"{root}/bad")
    return write_bronze(read_csv_files(spark, [f"{root}/land/*.csv", f"{root}/bad/*.csv"], named.schema), f"{root}/bronze")


@query("ingest_csv_quoted")
def q_ingest_csv_quoted(spark, sf_dir):
    """Names with quotes at both ends and separators within come back as they were."""
    return _quoted_names(spark, sf_dir)[0].select("p_partkey", "p_name", "p_size")


@query("ingest_quarantine")
def q_ingest_quarantine(spark, sf_dir):
    """Lines that don't parse are kept aside with their raw text."""
    return _quoted_names(spark, sf_dir)[1].select(F.col("_corrupt").alias("line"))


@query("ingest_mixed_headers")
def q_ingest_mixed_headers(spark, sf_dir):
    """Supplier landed under two seasons with different headers (reordered, one
    column missing); columns are matched by name, the missing one is NULL."""
    from statmart.plans.landing import land_csv
    from statmart.sources.csv_files import read_family
    sup = testdata.read_table(spark, sf_dir, "supplier")
    root = _fresh(spark, "ingest-mixed")
    first = F.coalesce(F.col("s_nationkey") < 12, F.lit(True))  # a missing key lands with the first
    land_csv(sup.where(first)
             .select("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
             f"{root}/data/2023-24/gws")
    land_csv(sup.where(~first).select("s_acctbal", "s_name", "s_suppkey"),
             f"{root}/data/2022-23/gws")
    df = read_family(spark, root, "gw", schema=sup.schema)
    return df.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", "season")


@query("ingest_path_keys")
def q_ingest_path_keys(spark, sf_dir):
    """Customer landed as data/<season>/gws/*.csv (season = market segment),
    plus a non-CSV file; season comes from the path, the non-CSV file is skipped."""
    from statmart.plans.landing import land_by_season, land_text
    from statmart.sources.csv_files import read_family
    cust = testdata.read_table(spark, sf_dir, "customer")
    root = _fresh(spark, "ingest-paths")
    folders = land_by_season(cust, root, F.col("c_mktsegment"), "gws")
    land_text(spark, cust.select("c_name"), folders[0])
    df = read_family(spark, root, "gw", schema=cust.schema)
    return df.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "season")


@query("ingest_name_collisions")
def q_ingest_name_collisions(spark, sf_dir):
    """Customer landed in player folders '<segment>-x' and '<segment>_x' (one write,
    partitioned by folder name); both clean to the same table name and the first folder
    by path order wins, with all of its files. The listing decides: no other file is opened."""
    from statmart.sources.first_files import read_first_files
    root, schema = _land_colliding_folders(spark, sf_dir)
    return read_first_files(spark, root, "players", schema=schema, file_glob="*/*.csv").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "table_name")


@query("ingest_keep_all")
def q_ingest_keep_all(spark, sf_dir):
    """Names collide as above, and every folder's rows are kept (told apart by their folder)."""
    from statmart.sources.csv_files import read_family
    root, schema = _land_colliding_folders(spark, sf_dir)
    return read_family(spark, root, "players", schema=schema, file_glob="*/*.csv").select(
        "c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "table_name", "entity")


def _land_colliding_folders(spark, sf_dir):
    cust = testdata.read_table(spark, sf_dir, "customer")
    root = _fresh(spark, "ingest-collisions")
    folder = F.concat(F.col("c_mktsegment"),
                      F.when(F.col("c_nationkey") < 12, F.lit("-x")).otherwise(F.lit("_x")))
    (cust.withColumn("name", folder).write.partitionBy("name").option("header", True)
     .csv(f"{root}/data/2023-24/players"))
    return root, cust.schema


@query("ingest_json_explode")
def q_ingest_json_explode(spark, sf_dir):
    """Nation records landed as snapshot documents (elements + teams), exploded."""
    from statmart.functions.lookup import join_lookup
    from statmart.sources.json_docs import explode_records, read_documents, snapshot_schema
    nation = testdata.read_table(spark, sf_dir, "nation")
    region = testdata.read_table(spark, sf_dir, "region").withColumnRenamed("r_regionkey",
                                                                          "n_regionkey")
    docs = join_lookup(nation, region, "n_regionkey").select(
        F.array(F.struct("n_nationkey", "n_name", "n_regionkey")).alias("elements"),
        F.array(F.struct(F.col("n_regionkey").alias("r_regionkey"), "r_name")).alias("teams"))
    path = _fresh(spark, "snapshot-json")
    docs.write.mode("overwrite").json(path)
    schema = snapshot_schema(nation.schema, T.StructType([
        T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]))
    return explode_records(read_documents(spark, path, schema, multi_line=False), "elements")


ORDERS_WAVE_SPLIT = "1997-01-01"


def _orders_waves(spark, sf_dir):
    orders = testdata.read_table(spark, sf_dir, "orders")
    cut = F.lit(ORDERS_WAVE_SPLIT).cast("timestamp_ntz")
    day = F.col("o_orderdate").cast("timestamp_ntz")
    first = F.coalesce(day < cut, F.lit(True))  # a missing day lands with the first wave
    return orders, orders.where(first), orders.where(~first)


@query("ingest_incremental")
def q_ingest_incremental(spark, sf_dir):
    """K7: orders land in two waves; an availableNow file stream loads each file once
    (the first wave is still there on the second and third runs and is not reloaded)."""
    from statmart.plans.landing import land_csv
    from statmart.streaming.incremental import read_target, stream_ingest
    orders, wave1, wave2 = _orders_waves(spark, sf_dir)
    root = _fresh(spark, "ingest-stream")
    target, ckpt = f"{root}/bronze_orders", f"{root}/_checkpoint"
    land_csv(wave1, f"{root}/land/wave1")
    stream_ingest(spark, f"{root}/land/*", target, ckpt, schema=orders.schema)
    land_csv(wave2, f"{root}/land/wave2")
    stream_ingest(spark, f"{root}/land/*", target, ckpt, schema=orders.schema)
    stream_ingest(spark, f"{root}/land/*", target, ckpt, schema=orders.schema)
    return read_target(spark, target).select(*orders.columns)


@query("ingest_anti")
def q_ingest_anti(spark, sf_dir):
    """Batch twin of K7; files already in the target are removed by a left-anti join."""
    from statmart.plans.landing import land_csv
    from statmart.streaming.incremental import batch_ingest, read_target
    orders, wave1, wave2 = _orders_waves(spark, sf_dir)
    root = _fresh(spark, "ingest-anti")
    target = f"{root}/bronze_orders"
    land_csv(wave1, f"{root}/land/wave1")
    batch_ingest(spark, f"{root}/land/*", target, schema=orders.schema)
    land_csv(wave2, f"{root}/land/wave2")
    batch_ingest(spark, f"{root}/land/*", target, schema=orders.schema)
    batch_ingest(spark, f"{root}/land/*", target, schema=orders.schema)
    return read_target(spark, target).select(*orders.columns)


@query("ingest_schema_growth")
def q_ingest_schema_growth(spark, sf_dir):
    """The second wave's files have a column more (and another order); rows of the
    first wave read NULL there."""
    from statmart.plans.landing import land_csv
    from statmart.streaming.incremental import batch_ingest, read_target
    orders, wave1, wave2 = _orders_waves(spark, sf_dir)
    root = _fresh(spark, "ingest-growth")
    target = f"{root}/bronze_orders"
    land_csv(wave1.select("o_orderkey", "o_totalprice"), f"{root}/land/wave1")
    batch_ingest(spark, f"{root}/land/*", target, schema=orders.schema)
    land_csv(wave2.select("o_orderpriority", "o_totalprice", "o_orderkey"), f"{root}/land/wave2")
    batch_ingest(spark, f"{root}/land/*", target, schema=orders.schema)
    return read_target(spark, target).select("o_orderkey", "o_totalprice", "o_orderpriority")


@query("ingest_inferred")
def q_ingest_inferred(spark, sf_dir):
    """Types come from all values of a column: orders land in two waves; in the last one the
    customer key turns to text and whole prices to broken ones, and a column is always empty."""
    from statmart.plans.landing import land_csv
    from statmart.sources.csv_files import read_csv_files
    _, wave1, wave2 = _orders_waves(spark, sf_dir)
    root = _fresh(spark, "ingest-inferred")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "amount", "o_orderdate", "o_orderpriority", "note"]
    note = F.lit(None).cast("string")
    early = wave1.withColumns({"amount": F.floor("o_totalprice"), "note": note})
    late = wave2.withColumns({"amount": F.col("o_totalprice"), "note": note,
                              "o_custkey": F.concat(F.lit("C"), F.col("o_custkey").cast("string"))})
    land_csv(early.select(*columns), f"{root}/land/1")
    land_csv(late.select(*reversed(columns)), f"{root}/land/2")
    return read_csv_files(spark, f"{root}/land/*/*.csv", infer=True).select(*columns)


@query("ingest_widening")
def q_ingest_widening(spark, sf_dir):
    """Types are reconciled from commit to commit. The first wave lands with whole amounts and a
    file with texts for keys, which is then delivered again with numbers; the second wave brings broken
    amounts and keys that are text. ``seen`` tells the types of key and amount after each run."""
    from statmart.plans.landing import land_csv, land_named
    from statmart.streaming.incremental import batch_ingest, read_target
    _, wave1, wave2 = _orders_waves(spark, sf_dir)
    root = _fresh(spark, "ingest-widening")
    columns = ["o_orderkey", "o_custkey", "o_totalprice", "amount", "o_orderdate", "o_orderpriority", "note"]
    note = F.lit(None).cast("string")
    early = wave1.withColumns({"amount": F.floor("o_totalprice"), "note": note}).select(*columns)
    key = F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    late = wave2.withColumns({"amount": F.col("o_totalprice"), "note": note, "o_custkey": key}).select(*columns)
    seen = []

    def run():
        batch_ingest(spark, f"{root}/land/*", f"{root}/bronze", infer=True)
        found = read_target(spark, f"{root}/bronze", infer=True)
        types = dict(found.dtypes)
        seen.append(f"{types['o_custkey']} {types['amount']}")
        return found

    land_named(early.withColumn("o_custkey", key), f"{root}/land/1")
    run()
    land_named(early, f"{root}/land/1")
    run()
    land_csv(late, f"{root}/land/2")
    return run().select(*columns, F.lit(", ".join(seen)).alias("seen"))


@query("ingest_manifest")
def q_ingest_manifest(spark, sf_dir):
    """The first wave lands with wrong prices beside a folder whose files hold headers only;
    the second wave lands and the first is delivered again, under the same names, with right ones.
    ``loaded`` tells that a run with nothing new (before and after) loads no file."""
    from statmart.plans.landing import land_csv, land_named
    from statmart.streaming.incremental import batch_ingest, read_target
    orders, wave1, wave2 = _orders_waves(spark, sf_dir)
    root = _fresh(spark, "ingest-manifest")
    target = f"{root}/bronze_orders"

    def run():
        return batch_ingest(spark, f"{root}/land/*", target, schema=orders.schema)

    land_named(wave1.withColumn("o_totalprice", F.col("o_totalprice") + 1), f"{root}/land/wave1")
    land_csv(orders.limit(0), f"{root}/land/empty")
    first, none = run(), run()
    land_named(wave1, f"{root}/land/wave1")
    land_csv(wave2, f"{root}/land/wave2")
    second, again = run(), run()
    state = f"{first > 0} {none} {second > 0} {again}"
    return read_target(spark, target).select(*orders.columns, F.lit(state).alias("loaded"))


@query("ingest_history")
def q_ingest_history(spark, sf_dir):
    """Two seasons of three families through the history loader; the loader runs
    after the first season, after the second, and once more with nothing new."""
    from statmart.plans.landing import land_csv
    from statmart.plans.models import load_history, read_history
    root = _fresh(spark, "ingest-history")
    out = f"{root}/bronze"
    tables = {
        "gw": testdata.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name"),
        "players": testdata.read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size"),
        "understat": testdata.read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"),
    }
    schemas = {family: df.schema for family, df in tables.items()}
    seasons = {"2022-23": 0, "2023-24": 1}
    for season, rest in [*seasons.items(), (None, None)]:
        if season:
            mine = {f: df.where(F.coalesce(df[df.columns[0]] % 2, F.lit(0)) == rest) for f, df in tables.items()}
            land_csv(mine["gw"], f"{root}/data/{season}/gws")
            land_csv(mine["understat"], f"{root}/data/{season}/understat")
            (mine["players"].withColumn("size", F.col("p_size")).write.partitionBy("size").option("header", True)
             .option("escape", '"').csv(f"{root}/data/{season}/players"))
        load_history(spark, root, out, list(seasons), schemas=schemas, file_globs={"players": "*/*.csv"})
    found = None
    for family, df in tables.items():
        entity = F.col("entity") if family == "players" else F.lit(None).cast("string")
        part = read_history(spark, out, family).select(
            F.lit(family).alias("family"), F.col("season").cast("string").alias("season"),
            F.col(df.columns[0]).alias("key"), F.col(df.columns[1]).alias("name"), entity.alias("entity"))
        found = part if found is None else found.unionByName(part)
    return found


@query("ingest_snapshot_document")
def q_ingest_snapshot_document(spark, sf_dir):
    """One document over many lines with all nations as elements and all regions as
    teams is loaded as a snapshot; both tables are read back."""
    from statmart.plans.landing import land_document
    from statmart.plans.models import load_snapshot_file
    from statmart.sources.json_docs import snapshot_schema
    nation = testdata.read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    region = testdata.read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    path, db = f"{_fresh(spark, 'snapshot-document')}/doc", _fresh_database(spark, "document")
    land_document(spark, {"elements": nation, "teams": region}, path)
    load_snapshot_file(spark, path, db, snapshot_schema(nation.schema, region.schema))
    return spark.table(f"{db}.players").select(
        F.lit("element").alias("kind"), F.col("n_nationkey").alias("key"), F.col("n_name").alias("name"),
        F.col("n_regionkey").alias("region")).unionByName(spark.table(f"{db}.teams").select(
            F.lit("team").alias("kind"), F.col("r_regionkey").alias("key"), F.col("r_name").alias("name"),
            F.col("r_regionkey").alias("region")))


@query("ingest_large_document")
def q_ingest_large_document(spark, sf_dir):
    """All orders as elements and all customers as teams in one document, which is read
    by as many tasks as its file has blocks. Comments get signs that JSON text has outside of strings."""
    from statmart.plans.landing import land_document
    from statmart.plans.models import load_snapshot_file
    from statmart.sources.json_docs import snapshot_schema
    orders = testdata.read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.concat("o_orderpriority", F.lit('"}], {')).alias("o_note"))
    customer = testdata.read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    path, db = f"{_fresh(spark, 'large-document')}/doc", _fresh_database(spark, "large")
    land_document(spark, {"elements": orders, "teams": customer}, path)
    load_snapshot_file(spark, path, db, snapshot_schema(orders.schema, customer.schema), split=True)
    return spark.table(f"{db}.players").select(
        F.lit("element").alias("kind"), F.col("o_orderkey").alias("key"), F.col("o_note").alias("name"),
        F.col("o_custkey").alias("other")).unionByName(spark.table(f"{db}.teams").select(
            F.lit("team").alias("kind"), F.col("c_custkey").alias("key"), F.col("c_name").alias("name"),
            F.col("c_custkey").alias("other")))


def _fresh_database(spark, name):
    import uuid
    db = f"sm_{name}_{uuid.uuid4().hex[:10]}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {db} LOCATION '{_fresh(spark, 'db-' + name)}'")
    return db


@query("sink_write_once")
def q_sink_write_once(spark, sf_dir):
    """Create-if-absent; the second write (prices doubled) is skipped."""
    from statmart.sinks.tables import create_table_once
    part = testdata.read_table(spark, sf_dir, "part")
    name = f"{_fresh_database(spark, 'once')}.parts"
    create_table_once(part, name)
    create_table_once(part.withColumn("p_retailprice", F.col("p_retailprice") * 2), name)
    return spark.table(name)


@query("sink_overwrite")
def q_sink_overwrite(spark, sf_dir):
    """K2/K5: create-or-replace; the second version wins, an empty third write is skipped."""
    from statmart.sinks.tables import replace_table
    part = testdata.read_table(spark, sf_dir, "part")
    name = f"{_fresh_database(spark, 'replace')}.parts"
    replace_table(part, name)
    doubled = part.withColumn("p_retailprice", F.col("p_retailprice") * 2)
    replace_table(doubled, name)
    replace_table(doubled.where(F.lit(False)), name)
    return spark.table(name)


@query("sink_replace_managed")
def q_sink_replace_managed(spark, sf_dir):
    """K1 then K2: a managed table is replaced, then replaced by a query that reads it, then
    offered an empty version, which leaves it as it is."""
    from statmart.sinks.tables import create_table_once, replace_table
    part = testdata.read_table(spark, sf_dir, "part")
    name = f"{_fresh_database(spark, 'managed')}.parts"
    create_table_once(part, name)
    replace_table(part.withColumn("p_retailprice", F.col("p_retailprice") * 2), name)
    replace_table(spark.table(name).where(F.col("p_partkey") % 2 == 0), name)
    replace_table(spark.table(name).where(F.lit(False)), name)
    return spark.table(name)


@query("snapshot_log")
def q_snapshot_log(spark, sf_dir):
    """Two snapshot loads (players, teams) each append one log row; the
    load time is the latest event time so the output is reproducible."""
    from statmart.sinks.tables import load_snapshot
    db = _fresh_database(spark, "snapshot")
    when = testdata.read_table(spark, sf_dir, "events").agg(F.max("ts")).first()[0]
    # the stand-in snapshot is an aggregate used by several actions: compute it once
    snap = players(spark, sf_dir).persist(StorageLevel.MEMORY_AND_DISK)
    tables = {f"{db}.players": snap, f"{db}.teams": testdata.teams(spark, sf_dir)}
    try:
        for _ in range(2):
            load_snapshot(spark, tables, f"{db}.snapshot_metadata", snapshot_time=when)
    finally:
        snap.unpersist()
    return spark.table(f"{db}.snapshot_metadata").select(
        F.col("snapshot_time").cast("timestamp_ntz").alias("snapshot_time"), "tables_updated")


EXPORT_COLUMNS = ["id", "web_name", "team", "position", "price", "total_points",
                  "points_per_game", "minutes", "form", "points_per_90", "value_ppg_per_cost"]


@query("export_csv")
def q_export_csv(spark, sf_dir):
    """K6: filtered rows exported as CSV part files and read back."""
    from statmart.sinks.export import export_csv
    df = filtered_live(spark, sf_dir).select(*EXPORT_COLUMNS)
    path = export_csv(df, _fresh(spark, "export"))
    return (spark.read.schema(df.schema).option("header", True).option("escape", '"')
            .csv(path))


@query("models_materialized")
def q_models_materialized(spark, sf_dir):
    """Players -> dim and fact tables (bucketed on the player id, so the mart
    join needs no shuffle) -> mart table, read back (load time left out)."""
    from statmart.plans.models import build_models
    from statmart.session import default_parallelism
    from statmart.sinks.tables import replace_table
    db = _fresh_database(spark, "models")
    replace_table(players(spark, sf_dir), f"{db}.players")
    return build_models(spark, db, last_updated=False, buckets=default_parallelism(spark))


@query("mart_incremental")
def q_mart_incremental(spark, sf_dir):
    """K5: the models of an earlier snapshot (1 % of its players with other figures, 1 % not there
    yet, 1 % that leave later) are refreshed to the present one by writing changed players only."""
    from statmart.plans.models import refresh_models
    from statmart.sinks.tables import replace_table
    db = _fresh_database(spark, "refresh")
    replace_table(players(spark, sf_dir), f"{db}.present")
    present = spark.table(f"{db}.present")
    turn = F.col("id") % 100
    earlier = present.where(turn != 2).withColumn("minutes", F.when(turn == 1, F.lit(0)).otherwise(F.col("minutes")))
    leave = present.where(turn == 3).withColumn("id", -F.col("id"))
    replace_table(earlier.unionByName(leave), f"{db}.players")
    refresh_models(spark, db, last_updated=False)
    refresh_models(spark, db, source="present", last_updated=False)
    return spark.table(f"{db}.player_stats")
