"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Written independently of the Spark code: plain SQL over the driver's tables. Double
outputs are rounded to 6 places, as the Spark side does.
"""

from __future__ import annotations

D = 6  # decimals for double outputs


def fx(expr: str, d: int = D) -> str:
    """Round half to even on the binary value, at every magnitude."""
    scale = f"1e{d}"
    return f"(round_even(CAST({expr} AS DOUBLE) * {scale}, 0) / {scale})"


def r(col: str, alias: str | None = None) -> str:
    return f"{fx(col)} AS {alias or col}"


def select_list(columns: list[str], doubles: set[str]) -> str:
    return ", ".join(r(c) if c in doubles else c for c in columns)


SINCE = "TIMESTAMP '2001-06-01'"


def _lines(n: int) -> str:
    return f"CAST(count(*) FILTER (WHERE l_linenumber = {n}) AS INTEGER)"


PLAYERS_CTE = f"""
li AS (
  SELECT l_partkey,
    CAST(sum(l_quantity) AS INTEGER) AS total_points,
    CAST(sum(CASE WHEN l_shipdate >= {SINCE} THEN l_quantity ELSE 0.0 END) AS INTEGER) AS minutes,
    CAST(count(*) FILTER (WHERE l_shipdate >= {SINCE} AND l_returnflag = 'R') AS INTEGER) AS goals_scored,
    CAST(count(*) FILTER (WHERE l_shipdate >= {SINCE} AND l_returnflag = 'A') AS INTEGER) AS assists,
    CAST(count(*) FILTER (WHERE l_linestatus = 'F') AS INTEGER) AS clean_sheets,
    CAST(count(*) FILTER (WHERE l_linestatus = 'O') AS INTEGER) AS goals_conceded,
    {_lines(4)} AS own_goals,
    {_lines(5)} AS penalties_saved,
    {_lines(6)} AS penalties_missed,
    {_lines(2)} AS yellow_cards,
    {_lines(3)} AS red_cards,
    {_lines(1)} AS saves,
    {_lines(7)} AS bonus,
    CAST(count(*) AS INTEGER) AS bps,
    {fx('sum(l_extendedprice)')} AS influence,
    {fx('sum(l_extendedprice * l_discount)')} AS creativity,
    {fx('sum(l_extendedprice * l_tax)')} AS threat,
    {fx('sum(l_extendedprice * (1 - l_discount))')} AS ict_index,
    CAST(count(DISTINCT l_orderkey) AS INTEGER) AS starts,
    {fx('sum(l_discount)')} AS expected_goals,
    {fx('sum(l_tax)')} AS expected_assists,
    {fx('sum(l_discount + l_tax)')} AS expected_goal_involvements,
    {fx("sum(CASE WHEN l_linestatus = 'O' THEN l_discount ELSE 0.0 END)")} AS expected_goals_conceded,
    CAST({fx('avg(l_quantity)')} AS VARCHAR) AS form,
    CAST({fx('avg(100 * l_discount)')} AS VARCHAR) AS selected_by_percent,
    CAST({fx('avg(100 * l_tax)')} AS VARCHAR) AS value_form,
    CAST({fx('sum(l_extendedprice) / 1000')} AS VARCHAR) AS value_season
  FROM lineitem GROUP BY l_partkey
),
players AS (
  SELECT p.p_partkey AS id,
    split_part(p.p_name, ' ', 1) AS first_name,
    split_part(p.p_name, ' ', 2) AS second_name,
    p.p_name AS web_name,
    CAST(regexp_extract(p.p_brand, '(\\d+)', 1) AS INTEGER) AS team,
    p.p_size % 5 AS element_type,
    p.p_retailprice AS now_cost,
    li.* EXCLUDE (l_partkey),
    CAST({fx('li.total_points / li.starts')} AS VARCHAR) AS points_per_game
  FROM part p JOIN li ON p.p_partkey = li.l_partkey
)"""

DIM = ["id", "first_name", "second_name", "web_name", "team", "element_type", "now_cost",
       "selected_by_percent", "form", "points_per_game", "total_points"]
FACT = ["total_points", "minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded",
        "own_goals", "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves",
        "bonus", "bps", "influence", "creativity", "threat", "ict_index", "element_type", "team",
        "now_cost", "selected_by_percent", "form", "points_per_game", "value_form", "value_season",
        "starts", "expected_goals", "expected_assists", "expected_goal_involvements",
        "expected_goals_conceded"]
FACT_INTS = ["minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded", "own_goals",
             "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves", "bonus",
             "bps", "starts"]
FACT_DOUBLES = ["influence", "creativity", "threat", "ict_index", "expected_goals",
                "expected_assists", "expected_goal_involvements", "expected_goals_conceded"]


def _per90(x: str) -> str:
    return (f"CASE WHEN minutes > 0 THEN CAST({x} AS DOUBLE) * 90.0e0 / CAST(minutes AS DOUBLE) "
            f"ELSE 0.0e0 END")


MART_CTE = PLAYERS_CTE + """,
mart AS (
  SELECT id, first_name, second_name, web_name, team, element_type, now_cost,
    TRY_CAST(selected_by_percent AS DOUBLE) AS selected_by_percent,
    TRY_CAST(form AS DOUBLE) AS form,
    TRY_CAST(points_per_game AS DOUBLE) AS points_per_game,
    total_points,
    CAST(now_cost AS DOUBLE) / 10 AS price,
    """ + ", ".join(FACT_INTS[:-1] + FACT_DOUBLES) + """,
    CASE element_type WHEN 1 THEN 'GK' WHEN 2 THEN 'DEF' WHEN 3 THEN 'MID' WHEN 4 THEN 'FWD'
      ELSE 'Unknown' END AS position,
    """ + _per90("goals_scored") + """ AS goals_per_90,
    """ + _per90("assists") + """ AS assists_per_90,
    """ + _per90("expected_goals") + """ AS xG_per_90,
    """ + _per90("expected_assists") + """ AS xA_per_90,
    CASE WHEN CAST(now_cost AS DOUBLE) / 10 > 0
      THEN CAST(total_points AS DOUBLE) / (CAST(now_cost AS DOUBLE) / 10) ELSE 0.0e0 END
      AS points_per_million,
    """ + _per90("total_points") + """ AS points_per_90,
    CASE WHEN starts > 0 THEN CAST(minutes AS DOUBLE) / CAST(starts AS DOUBLE) ELSE 0.0e0 END
      AS minutes_per_start
  FROM players
)"""

MART_COLUMNS = (DIM + ["price"] + FACT_INTS[:-1] + FACT_DOUBLES +
                ["position", "goals_per_90", "assists_per_90", "xG_per_90", "xA_per_90",
                 "points_per_million", "points_per_90", "minutes_per_start"])
MART_DOUBLES = {"now_cost", "selected_by_percent", "form", "points_per_game", "price",
                *FACT_DOUBLES, "goals_per_90", "assists_per_90", "xG_per_90", "xA_per_90",
                "points_per_million", "points_per_90", "minutes_per_start"}


def with_players(body: str) -> str:
    return f"WITH {PLAYERS_CTE}\n{body}"


def with_mart(body: str) -> str:
    return f"WITH {MART_CTE}\n{body}"


def mart_select(columns: list[str], tail: str = "") -> str:
    return with_mart(f"SELECT {select_list(columns, MART_DOUBLES)} FROM mart {tail}")


TOP = ["web_name", "team", "position", "total_points", "price", "points_per_million", "id"]

ORACLE: dict[str, str] = {
    "dim_projection": with_players(f"SELECT {select_list(DIM, {'now_cost'})} FROM players"),
    "fact_projection": with_players(
        f"SELECT id AS player_id, {select_list(FACT, {'now_cost', *FACT_DOUBLES})} FROM players"),
    "cast_replace": with_players(
        "SELECT id, first_name, second_name, web_name, team, element_type, " + r("now_cost") + ", "
        + ", ".join(r(f"TRY_CAST({c} AS DOUBLE)", c) for c in ("selected_by_percent", "form", "points_per_game"))
        + ", total_points, " + r("CAST(now_cost AS DOUBLE) / 10", "price") + " FROM players"),
    "mart_join": mart_select(MART_COLUMNS),
    "mart_full": mart_select(MART_COLUMNS),
    "mart_position": mart_select(["id", "element_type", "position"]),
    "mart_per90": mart_select(["id", "minutes", "goals_per_90", "assists_per_90", "xG_per_90",
                               "xA_per_90", "points_per_90"]),
    "mart_value": mart_select(["id", "price", "points_per_million", "minutes_per_start"]),
    "price": mart_select(["id", "now_cost", "price"]),
    "topk_points": mart_select(TOP, "ORDER BY total_points DESC NULLS LAST, id LIMIT 10"),
    "topk_value": mart_select(TOP, "ORDER BY points_per_million DESC NULLS LAST, id LIMIT 10"),
    "rank_top20": with_mart(
        "SELECT * FROM (SELECT web_name, " + r("influence") + ", position, team, "
        + r("creativity") + ", " + r("threat") + ", "
        "rank() OVER (ORDER BY influence DESC NULLS LAST) AS rank FROM mart) WHERE rank <= 20"),
}


# --- live dashboard ---------------------------------------------------------------------------

def _case(col: str, mapping: dict, default: str | None) -> str:
    whens = " ".join(f"WHEN {k} THEN '{v}'" for k, v in mapping.items())
    tail = f" ELSE '{default}'" if default is not None else ""
    return f"CASE {col} {whens}{tail} END"


def _live_cte() -> str:
    from statmart.schemas import POSITION_NAMES, TEAM_NAMES

    def p90(x):
        return f"CAST({x} AS DOUBLE) / NULLIF(CAST(minutes AS DOUBLE) / 90.0e0, 0)"

    return f"""
live0 AS (
  SELECT id, web_name, element_type, {_case('team', TEAM_NAMES, 'Unknown')} AS team,
    CAST(now_cost AS DOUBLE) / 10 AS price,
    total_points, minutes, goals_scored, assists, clean_sheets, goals_conceded, saves,
    yellow_cards, red_cards, expected_goals, expected_assists,
    TRY_CAST(form AS DOUBLE) AS form, TRY_CAST(points_per_game AS DOUBLE) AS points_per_game,
    {_case('element_type', POSITION_NAMES, None)} AS position
  FROM players
),
live AS (
  SELECT *,
    CAST(total_points AS DOUBLE) / NULLIF(price, 0) AS points_per_million,
    {p90('total_points')} AS points_per_90,
    {p90('goals_scored')} AS goals_per_90,
    {p90('assists')} AS assists_per_90,
    {p90('goals_scored + assists')} AS goal_involvement_per_90,
    {p90('expected_goals + expected_assists')} AS xGI_per_90,
    {p90('clean_sheets')} AS clean_sheet_percentage,
    {p90('goals_conceded')} AS goals_conceded_per_90,
    points_per_game / NULLIF(price, 0) AS value_ppg_per_cost
  FROM live0
),
filtered AS (
  SELECT * FROM live WHERE price IS NOT NULL AND total_points >= 0 AND minutes >= 90
),
mart_filtered AS (SELECT * FROM mart WHERE price IS NOT NULL AND total_points IS NOT NULL)"""


LIVE_DOUBLES = {"price", "form", "points_per_game", "expected_goals", "expected_assists",
                "points_per_million", "points_per_90", "goals_per_90", "assists_per_90",
                "goal_involvement_per_90", "xGI_per_90", "clean_sheet_percentage",
                "goals_conceded_per_90", "value_ppg_per_cost", "influence", "creativity", "threat"}
ALL_DOUBLES = LIVE_DOUBLES | MART_DOUBLES


def with_live(body: str) -> str:
    return f"WITH {MART_CTE},{_live_cte()}\n{body}"


def from_(table: str, columns: list[str], where: str = "") -> str:
    return with_live(f"SELECT {select_list(columns, ALL_DOUBLES)} FROM {table} {where}")


def _board_sql():
    from statmart.schemas import BOARD_SPECS
    return {f"board_{n}": from_("filtered", cols) for n, (cols, _) in BOARD_SPECS.items()}


def _charts_sql():
    from statmart.schemas import CHARTS
    return {
        "chart_form_price": from_("mart_filtered", CHARTS["form_price"]),
        "chart_xg_goals": from_("mart_filtered", CHARTS["xg_goals"]),
        "chart_value": from_("filtered", CHARTS["value"]),
        "chart_momentum": from_("filtered", CHARTS["momentum"]),
    }


def _stat_summary_sql():
    from statmart.schemas import SUMMARY_STATS
    parts = []
    for s in SUMMARY_STATS:
        x = f"CAST({s} AS DOUBLE)"
        parts.append(f"SELECT '{s}' AS stat, {r(f'avg({x})', 'mean')}, "
                     f"{r(f'quantile_cont({x}, 0.5)', 'median')}, "
                     f"{r(f'quantile_cont({x}, 0.9)', 'p90')} FROM filtered")
    return with_live(" UNION ALL ".join(parts))


def _agg_metrics_sql():
    from statmart.schemas import GROUP_METRICS
    cols = ", ".join(r(f"round_even(avg(CAST({c} AS DOUBLE)) * 100, 0) / 100", c)
                     for c in GROUP_METRICS)
    return with_live(f"SELECT position, {cols} FROM mart WHERE position IS NOT NULL "
                     f"GROUP BY position")


def _dashboard_summaries_sql():
    from statmart.schemas import GROUP_METRICS

    def rows(dataset, key, name, value, where=""):
        return f"SELECT '{dataset}' AS dataset, {key} AS key, '{name}' AS name, {fx(value)} AS value FROM mart {where}"
    known = "WHERE position IS NOT NULL GROUP BY position"
    parts = [rows("selection_by_position", "position", "id", "count(id)", known),
             rows("selection_by_position", "position", "selected_by_percent", "avg(selected_by_percent)", known)]
    parts += [rows("metrics_by_position", "position", c, f"round_even(avg(CAST({c} AS DOUBLE)) * 100, 0) / 100", known)
              for c in GROUP_METRICS]
    parts += [rows("bounds", "CAST(NULL AS VARCHAR)", f"{c}_{side}", f"{side}({c})")
              for c in ("price", "total_points") for side in ("min", "max")]
    parts.append("SELECT DISTINCT 'options', coalesce(position, 'nan'), 'position', CAST(NULL AS DOUBLE) FROM mart")
    return with_live(" UNION ALL ".join(parts))


LIVE_OUT = ["id", "web_name", "team", "position", "price", "points_per_million",
            "points_per_90", "goals_per_90", "assists_per_90", "goal_involvement_per_90",
            "xGI_per_90", "clean_sheet_percentage", "goals_conceded_per_90",
            "value_ppg_per_cost"]
FILTER_OUT = ["id", "web_name", "team", "position", "price", "total_points", "minutes"]


def _more():
    from statmart.schemas import COMPARE_COLUMNS
    return {
        "live_metrics": from_("live", LIVE_OUT),
        "lookup_team": from_("live", ["id", "team"]),
        "lookup_position": from_("live", ["id", "element_type", "position"]),
        "coerce_numeric": (
            "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, "
            "TRY_CAST(event_type AS DOUBLE) AS event_type_num, " + r("value") + " FROM events"),
        "coerce_priority": (
            "SELECT o_orderkey, CAST(round_even(TRY_CAST(split_part(o_orderpriority, '-', 1) "
            "AS DOUBLE), 0) AS INTEGER) AS priority FROM orders"),
        "filter_position": from_("mart", FILTER_OUT,
                                 "WHERE position = 'MID' AND price IS NOT NULL "
                                 "AND total_points IS NOT NULL"),
        "filter_bounds": from_("mart", FILTER_OUT,
                               "WHERE position = 'FWD' AND price >= 95 AND total_points >= 800"),
        "filter_compound": from_(
            "live", FILTER_OUT,
            "WHERE position IN ('MID', 'FWD') "
            "AND team IN ('Arsenal', 'Chelsea', 'Liverpool', 'Unknown') "
            "AND price BETWEEN 92.5 AND 97.5 AND total_points >= 600 AND minutes >= 90"),
        "compare_players": from_("live", COMPARE_COLUMNS,
                                 "WHERE web_name IN ('small ring', 'red widget', 'blue bolt')"),
        **_board_sql(),
        "board_tolerant": from_("filtered", ["web_name", "team", "price"]),
        **_charts_sql(),
        "agg_selection": with_live(
            "SELECT position, count(id) AS id, " + r("avg(selected_by_percent)", "selected_by_percent")
            + " FROM mart WHERE position IS NOT NULL GROUP BY position"),
        "agg_metrics": _agg_metrics_sql(),
        "dashboard_summaries": _dashboard_summaries_sql(),
        "bounds": with_live(
            "SELECT " + r("min(price)", "price_min") + ", " + r("max(price)", "price_max")
            + ", min(total_points) AS total_points_min, max(total_points) AS total_points_max "
            "FROM mart"),
        "options": with_live(
            "SELECT 'position' AS kind, coalesce(position, 'nan') AS value FROM live "
            "UNION SELECT 'team' AS kind, team AS value FROM live"),
        "latest_update": "SELECT max(ts) AS last_updated FROM events",
        "stat_summary": _stat_summary_sql(),
    }


ORACLE.update(_more())


# --- names, ingest, sinks ---------------------------------------------------------------------

def _clean(x: str) -> str:
    return f"regexp_replace({x}, '[^a-zA-Z0-9]', '_', 'g')"


def _last_segment(x: str) -> str:
    return f"string_split({x}, '/')[-1]"


_URL_STEM = "split_part(" + _last_segment("url") + ", '.', 1)"
EXPORT_COLUMNS = ["id", "web_name", "team", "position", "price", "total_points",
                  "points_per_game", "minutes", "form", "points_per_90", "value_ppg_per_cost"]
PART_COLUMNS = ("p_partkey, p_name, p_brand, p_type, p_size")
ORDERS_SQL = ("SELECT o_orderkey, o_custkey, o_orderstatus, " + r("o_totalprice")
              + ", o_orderdate, o_orderpriority FROM orders")

ORACLE.update({
    "clean_names": (
        "SELECT 'player' AS kind, p_partkey AS key, replace('player_' || replace('2023-24', '-', '_')"
        f" || '_' || {_clean('p_name')}, '-', '_') AS table_name FROM part "
        "UNION ALL SELECT 'understat' AS kind, page_id AS key, replace('understat_' || "
        "replace('2022-23', '-', '_') || '_' || " + _clean(_URL_STEM)
        + ", '-', '_') AS table_name FROM pages "
        "UNION ALL SELECT 'gw' AS kind, page_id AS key, replace('gw_' || replace('2023-24', '-', '_')"
        " || '_' || " + _URL_STEM + ", '-', '_') AS table_name FROM pages"),
    "ingest_csv": f"SELECT {PART_COLUMNS}, " + r("p_retailprice") + " FROM part",
    "ingest_mixed_headers": (
        "SELECT s_suppkey, s_name, CASE WHEN s_nationkey < 12 THEN s_nationkey END AS s_nationkey, "
        + r("s_acctbal") + ", CASE WHEN s_nationkey < 12 THEN '2023-24' ELSE '2022-23' END AS season "
        "FROM supplier"),
    "ingest_path_keys": ("SELECT c_custkey, c_name, c_nationkey, " + r("c_acctbal")
                         + ", c_mktsegment, c_mktsegment AS season FROM customer"),
    "ingest_json_explode": "SELECT n_nationkey, n_name, n_regionkey FROM nation",
    "ingest_incremental": ORDERS_SQL,
    "ingest_anti": ORDERS_SQL,
    "sink_write_once": f"SELECT {PART_COLUMNS}, " + r("p_retailprice") + " FROM part",
    "sink_overwrite": f"SELECT {PART_COLUMNS}, " + r("p_retailprice * 2", "p_retailprice")
                      + " FROM part",
    "sink_replace_managed": f"SELECT {PART_COLUMNS}, " + r("p_retailprice * 2", "p_retailprice")
                      + " FROM part WHERE p_partkey % 2 = 0",
    "snapshot_log": ("SELECT max(ts) AS snapshot_time, '[\"players\",\"teams\"]' AS tables_updated "
                     "FROM events UNION ALL SELECT max(ts) AS snapshot_time, "
                     "'[\"players\",\"teams\"]' AS tables_updated FROM events"),
    "export_csv": from_("filtered", EXPORT_COLUMNS),
})

ORACLE["models_materialized"] = mart_select(MART_COLUMNS)
ORACLE["mart_incremental"] = mart_select(MART_COLUMNS)

ORACLE["ingest_name_collisions"] = (
    "SELECT c_custkey, c_name, c_nationkey, " + r("c_acctbal") + ", c_mktsegment, "
    "'player_2023_24_name_' || " + _clean("c_mktsegment") + " || '_x' AS table_name "
    "FROM customer WHERE c_nationkey < 12")

ORACLE["ingest_keep_all"] = (
    "SELECT c_custkey, c_name, c_nationkey, " + r("c_acctbal") + ", c_mktsegment, "
    "'player_2023_24_name_' || " + _clean("c_mktsegment") + " || '_x' AS table_name, "
    "'name=' || c_mktsegment || CASE WHEN c_nationkey < 12 THEN '-x' ELSE '_x' END AS entity FROM customer")
ORACLE["ingest_csv_quoted"] = (
    """SELECT p_partkey, '"' || replace(p_name, ' ', ', "') || '"' AS p_name, p_size FROM part""")
ORACLE["ingest_quarantine"] = "SELECT 'x' || p_partkey || ',bad,1' AS line FROM part"
ORACLE["ingest_inferred"] = (
    "SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' "
    "THEN 'C' || o_custkey ELSE CAST(o_custkey AS VARCHAR) END AS o_custkey, " + r("o_totalprice") + ", "
    + r("CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' THEN o_totalprice ELSE floor(o_totalprice) END", "amount")
    + ", o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS note FROM orders")
ORACLE["ingest_widening"] = ORACLE["ingest_inferred"].replace(
    " FROM orders", ", 'string bigint, bigint bigint, string double' AS seen FROM orders")
ORACLE["ingest_manifest"] = ORDERS_SQL.replace(" FROM orders", ", 'True 0 True 0' AS loaded FROM orders")
ORACLE["ingest_schema_growth"] = (
    "SELECT o_orderkey, " + r("o_totalprice") + ", CASE WHEN o_orderdate >= TIMESTAMP '1997-01-01' "
    "THEN o_orderpriority END AS o_orderpriority FROM orders")
_SEASON = "CASE WHEN {0} % 2 = 1 THEN '2023-24' ELSE '2022-23' END AS season, {0} AS key, "
ORACLE["ingest_history"] = (
    "SELECT 'gw' AS family, " + _SEASON.format("c_custkey") + "c_name AS name, NULL AS entity FROM customer "
    "UNION ALL SELECT 'players', " + _SEASON.format("p_partkey") + "p_name, 'size=' || p_size FROM part "
    "UNION ALL SELECT 'understat', " + _SEASON.format("s_suppkey") + "s_name, NULL FROM supplier")
ORACLE["ingest_snapshot_document"] = (
    "SELECT 'element' AS kind, n_nationkey AS key, n_name AS name, n_regionkey AS region FROM nation "
    "UNION ALL SELECT 'team', r_regionkey, r_name, r_regionkey FROM region")
ORACLE["ingest_large_document"] = (
    "SELECT 'element' AS kind, o_orderkey AS key, o_orderpriority || '\"}], {' AS name, o_custkey AS other FROM orders "
    "UNION ALL SELECT 'team', c_custkey, c_name, c_custkey FROM customer")


def _ieee(num: str, den: str, alias: str) -> str:
    """x/0 as an infinity, 0/0 as NaN, missing as NULL."""
    n, d = f"CAST({num} AS DOUBLE)", f"({den})"
    return (f"CASE WHEN {n} IS NULL OR {d} IS NULL THEN NULL WHEN {d} <> 0 THEN {fx(f'{n} / {d}')} "
            f"WHEN {n} > 0 THEN CAST('inf' AS DOUBLE) WHEN {n} < 0 THEN CAST('-inf' AS DOUBLE) "
            f"ELSE CAST('nan' AS DOUBLE) END AS {alias}")


_NINETIES = "CAST(minutes AS DOUBLE) / 90.0e0"
ORACLE["live_metrics_ieee"] = with_live("SELECT id, " + ", ".join([
    _ieee("total_points", "price", "points_per_million"), _ieee("total_points", _NINETIES, "points_per_90"),
    _ieee("goals_scored", _NINETIES, "goals_per_90"), _ieee("assists", _NINETIES, "assists_per_90"),
    _ieee("(expected_goals + expected_assists)", _NINETIES, "xGI_per_90"),
    _ieee("points_per_game", "price", "value_ppg_per_cost")]) + " FROM live")
ORACLE["stat_summary_text"] = (
    "SELECT stat, printf('%.2f', mean) AS mean_text, printf('%.2f', median) AS median_text, "
    f"printf('%.2f', p90) AS p90_text FROM ({_stat_summary_sql()})")
