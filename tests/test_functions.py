import math

import pytest
from pyspark.sql import functions as F

from statmart.functions import arith, coerce, lookup, text
from statmart.operators.mart import position_label
from statmart.schemas import POSITION_NAMES, TEAM_NAMES


def test_text_to_number(spark):
    df = spark.createDataFrame(
        [("1.5",), (" 1e2 ",), ("",), ("x",), ("nan",), ("1d",), ("1,000",), ("-.5",), ("inf",),
         (None,)], "form string")
    got = [r[0] for r in df.select(coerce.to_number(df, "form")).collect()]
    assert got[:8] == [1.5, 100.0, None, None, None, None, None, -0.5]
    assert got[8] == math.inf and got[9] is None


def test_numbers_untouched_and_nan_is_missing(spark):
    df = spark.createDataFrame([(3, float("nan"), True)], "a int, b double, c boolean")
    out = coerce.coerce_numeric(df, ["a", "b", "c", "absent"])
    assert out.dtypes == [("a", "int"), ("b", "double"), ("c", "boolean")]
    assert out.first() == (3, None, True)


def test_integer_text_rounds(spark):
    df = spark.createDataFrame([("3.7",), ("3.0",), ("x",), ("2.5",)], "minutes string")
    got = [r[0] for r in df.select(coerce.to_int(df, "minutes")).collect()]
    assert got == [4, 3, None, 2]


def test_strict_cast_raises(spark):
    df = spark.createDataFrame([("x",)], "m string")
    with pytest.raises(Exception):
        df.select(coerce.to_int(df, "m", strict=True)).collect()


def test_cast_replace_keeps_names_and_order(spark):
    df = spark.createDataFrame([(1, "2.5", "7")], "id long, form string, total_points string")
    out = coerce.cast_replace(df, {"form": "double", "total_points": "int", "absent": "int"})
    assert out.columns == ["id", "form", "total_points"]
    assert out.dtypes[1:] == [("form", "double"), ("total_points", "int")]
    assert out.first() == (1, 2.5, 7)


@pytest.mark.parametrize("mode,expected", [
    ("zero", [0.0, 0.0, 0.0, 0.0, 2.0]),
    ("null", [None, None, None, None, 2.0]),
])
def test_ratio_modes(spark, mode, expected):
    df = spark.createDataFrame([(3, 0), (0, 0), (-1, 0), (3, None), (4, 2)], "x int, m int")
    got = [r[0] for r in df.select(arith.ratio(F.col("x"), F.col("m"), mode)).collect()]
    assert got == expected


def test_ratio_ieee(spark):
    df = spark.createDataFrame([(3, 0), (0, 0), (-1, 0), (3, None), (4, 2)], "x int, m int")
    got = [r[0] for r in df.select(arith.ratio(F.col("x"), F.col("m"), "ieee")).collect()]
    assert got[0] == math.inf and math.isnan(got[1]) and got[2] == -math.inf
    assert got[3] is None and got[4] == 2.0


def test_guarded_per90_and_price(spark):
    df = spark.createDataFrame([(3, 0, 105), (3, None, 0), (2, 180, 50)], "g int, m int, c int")
    out = df.select(arith.per90_guarded(F.col("g"), F.col("m")), arith.price(F.col("c"))).collect()
    assert [tuple(r) for r in out] == [(0.0, 10.5), (0.0, 0.0), (1.0, 5.0)]


def test_round_half_even(spark):
    df = spark.createDataFrame([(0.125,), (2.5,), (0.135,)], "x double")
    got = [r[0] for r in df.select(arith.round_half_even(F.col("x"), 2)).collect()]
    assert got[0] == 0.12 and got[1] == 2.5


def test_round_fixed_binary_half_up(spark):
    df = spark.createDataFrame([(2.0109375,), (1.5,), (-0.0000004,), (float("inf"),)], "x double")
    got = [r[0] for r in df.select(arith.round_fixed(F.col("x"), 6)).collect()]
    assert got[1] == 1.5 and got[2] == 0.0 and got[3] == math.inf
    assert abs(got[0] - 2.010937) < 1e-12 or abs(got[0] - 2.010938) < 1e-12


def test_lookups(spark):
    df = spark.createDataFrame([(1, 1), (20, 4), (99, 9), (None, 0)], "team int, et int")
    out = df.select(lookup.map_lookup(F.col("team"), TEAM_NAMES, "Unknown"),
                    position_label(F.col("et")), position_label(F.col("et"), None)).collect()
    assert [tuple(r) for r in out] == [("Arsenal", "GK", "GK"), ("Wolves", "FWD", "FWD"),
                                       ("Unknown", "Unknown", None), ("Unknown", "Unknown", None)]
    assert POSITION_NAMES[3] == "MID"


def test_join_lookup(spark):
    left = spark.createDataFrame([(1,), (2,), (None,)], "k int")
    right = spark.createDataFrame([(1, "a")], "k int, v string")
    assert {r.k: r.v for r in lookup.join_lookup(left, right, "k").collect()} == {1: "a", 2: None, None: None}


def test_lookup_misses_on_fractions(spark):
    df = spark.createDataFrame([("2",), ("2.0",), ("2.4",), ("2.7",), ("x",), (None,)], "k string")
    got = [r[0] for r in df.select(lookup.map_lookup(F.col("k"), {2: "two", 3: "three"}, "Unknown")).collect()]
    assert got == ["two", "two", "Unknown", "Unknown", "Unknown", "Unknown"]


def test_two_decimals(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1234567.891,), (float("inf"),), (float("nan"),), (None,), (-0.5,)], "v double")
    assert [r[0] for r in df.select(text.format_2f(F.col("v"))).collect()] == ["0.12", "2.67", "1234567.89", "inf", "nan", "nan", "-0.50"]


def test_names(spark):
    df = spark.createDataFrame([("Añe-x 1", "2023-24", "gw12.csv")], "n string, s string, f string")
    out = df.select(text.clean_identifier(F.col("n")), text.dashes_to_underscores(F.col("s")),
                    text.before_first_dot(F.col("f")),
                    text.table_name("player", F.col("s"), text.clean_identifier(F.col("n"))),
                    text.json_list("players", "teams"), text.format_2f(F.lit(2.675)),
                    text.option_text(F.lit(None).cast("string"))).first()
    assert tuple(out) == ("A_e_x_1", "2023_24", "gw12", "player_2023_24_A_e_x_1",
                          '["players","teams"]', "2.67", "nan")


def test_price_from_text_cost(spark):
    df = spark.createDataFrame([("105",), ("abc",), (None,)], "c string")
    assert [r[0] for r in df.select(arith.price(F.col("c"))).collect()] == [10.5, None, None]


def test_lookup_with_text_ids(spark):
    df = spark.createDataFrame([("1",), ("abc",), ("20",), (None,)], "team string")
    got = [r[0] for r in df.select(lookup.map_lookup(F.col("team"), TEAM_NAMES, "Unknown")).collect()]
    assert got == ["Arsenal", "Unknown", "Wolves", "Unknown"]
