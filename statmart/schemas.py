"""Column lists, fixed lookup values and bronze schemas.

Everything here is data, not logic: the functions in ``operators`` and ``sources`` take
these lists as defaults so that callers can override them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- Fixed values: must equal the source dashboards for identical results -----------------
# Team id -> team name, in id order (20 entries).
TEAM_NAMES: dict[int, str] = {
    1: "Arsenal",
    2: "Aston Villa",
    3: "Bournemouth",
    4: "Brentford",
    5: "Brighton",
    6: "Chelsea",
    7: "Crystal Palace",
    8: "Everton",
    9: "Fulham",
    10: "Ipswich",
    11: "Leicester",
    12: "Liverpool",
    13: "Man City",
    14: "Man Utd",
    15: "Newcastle",
    16: "Nottingham Forest",
    17: "Southampton",
    18: "Tottenham",
    19: "West Ham",
    20: "Wolves",
}
# Element type code -> position label.
POSITION_NAMES: dict[int, str] = {1: "GK", 2: "DEF", 3: "MID", 4: "FWD"}
UNKNOWN = "Unknown"
MIN_MINUTES = 90          # live dashboard minutes floor
RANK_LIMIT = 20           # influence chart keeps rank <= 20
TOP_N = 10                # leaderboards
MAX_COMPARE = 3           # comparison picks at most three names
SEASONS = ["2023-24", "2022-23"]
FAMILIES = ["gw", "players", "understat"]

# Dimension projection (11 columns).
DIM_COLUMNS = [
    "id", "first_name", "second_name", "web_name", "team", "element_type", "now_cost",
    "selected_by_percent", "form", "points_per_game", "total_points",
]

# Fact projection (32 columns); ``id`` is renamed to ``player_id``.
FACT_COLUMNS = [
    "total_points", "minutes", "goals_scored", "assists", "clean_sheets", "goals_conceded",
    "own_goals", "penalties_saved", "penalties_missed", "yellow_cards", "red_cards", "saves",
    "bonus", "bps", "influence", "creativity", "threat", "ict_index", "element_type", "team",
    "now_cost", "selected_by_percent", "form", "points_per_game", "value_form", "value_season",
    "starts", "expected_goals", "expected_assists", "expected_goal_involvements",
    "expected_goals_conceded",
]

# Typed recasts applied by the mart: dim side and fact side.
DIM_CASTS = {
    "selected_by_percent": "double",
    "form": "double",
    "points_per_game": "double",
    "total_points": "int",
}
FACT_CASTS = {
    "minutes": "int", "goals_scored": "int", "assists": "int", "clean_sheets": "int",
    "goals_conceded": "int", "own_goals": "int", "penalties_saved": "int",
    "penalties_missed": "int", "yellow_cards": "int", "red_cards": "int", "saves": "int",
    "bonus": "int", "bps": "int",
    "influence": "double", "creativity": "double", "threat": "double", "ict_index": "double",
    "expected_goals": "double", "expected_assists": "double",
    "expected_goal_involvements": "double", "expected_goals_conceded": "double",
    "starts": "int",
}
# Fact columns carried into the mart output (``starts`` is used but not output).
MART_FACT_OUTPUT = [c for c in FACT_CASTS if c != "starts"]
MART_COMPUTED = [
    "position", "goals_per_90", "assists_per_90", "xG_per_90", "xA_per_90",
    "points_per_million", "points_per_90", "minutes_per_start",
]

# Columns the board dashboard coerces to numbers after reading the mart.
BOARD_NUMERIC = [
    "price", "selected_by_percent", "form", "points_per_game", "total_points", "minutes",
    "goals_scored", "assists", "clean_sheets", "goals_conceded", "influence", "creativity",
    "threat", "ict_index", "expected_goals", "expected_assists", "goals_per_90",
    "assists_per_90", "xG_per_90", "xA_per_90", "points_per_million", "points_per_90",
]

# Columns the live dashboard coerces to numbers (40).
LIVE_NUMERIC = [
    "cost_change_event", "cost_change_event_fall", "cost_change_start",
    "cost_change_start_fall", "dreamteam_count", "event_points", "form",
    "in_dreamteam", "now_cost", "points_per_game", "selected_by_percent",
    "total_points", "transfers_in", "transfers_in_event", "transfers_out",
    "transfers_out_event", "value_form", "value_season", "minutes",
    "goals_scored", "assists", "clean_sheets", "goals_conceded",
    "own_goals", "penalties_saved", "penalties_missed", "yellow_cards",
    "red_cards", "saves", "bonus", "bps", "influence", "creativity",
    "threat", "ict_index", "starts", "expected_goals", "expected_assists",
    "expected_goal_involvements", "expected_goals_conceded",
]

# Fixed board specs: (columns, sort key).
TOP_BOARD_COLUMNS = ["web_name", "team", "position", "total_points", "price", "points_per_million"]
BOARD_SPECS = {
    "overview": (["web_name", "team", "position", "price", "total_points", "points_per_game",
                  "minutes", "form"], "total_points"),
    "attacking": (["web_name", "team", "position", "goals_scored", "assists", "expected_goals",
                   "expected_assists", "goal_involvement_per_90", "xGI_per_90"], "goals_scored"),
    "defensive": (["web_name", "team", "position", "clean_sheets", "goals_conceded", "saves",
                   "yellow_cards", "red_cards"], "clean_sheets"),
    "value": (["web_name", "team", "position", "price", "total_points", "points_per_game",
               "value_ppg_per_cost", "points_per_90"], "value_ppg_per_cost"),
}
COMPARE_COLUMNS = [
    "web_name", "team", "position", "price", "total_points", "points_per_game", "minutes", "form",
    "goals_scored", "assists", "expected_goals", "expected_assists", "goal_involvement_per_90",
    "xGI_per_90", "clean_sheets", "goals_conceded", "saves", "yellow_cards", "red_cards",
    "value_ppg_per_cost", "points_per_90",
]
SUMMARY_STATS = ["total_points", "points_per_game", "value_ppg_per_cost", "goals_scored",
                 "assists", "clean_sheets"]
GROUP_METRICS = ["total_points", "goals_per_90", "assists_per_90", "xG_per_90", "xA_per_90"]

# Chart datasets: encoded columns only (x, y, color, size, tooltip...).
CHARTS = {
    "form_price": ["price", "form", "position", "total_points", "web_name", "team"],
    "xg_goals": ["expected_goals", "goals_scored", "position", "minutes", "web_name", "team"],
    "influence": ["web_name", "influence", "position", "team", "creativity", "threat"],
    "value": ["price", "value_ppg_per_cost", "position", "total_points", "web_name", "team"],
    "momentum": ["form", "points_per_90", "position", "minutes", "web_name", "team",
                 "total_points"],
}

# Snapshot log table schema (declared DDL).
SNAPSHOT_LOG_SCHEMA = T.StructType([
    T.StructField("snapshot_time", T.TimestampType()),
    T.StructField("tables_updated", T.StringType()),
])
# --- end of fixed values --------------------------------------------------------------------
