"""Missing-value and arithmetic rules on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from panelproj.functions import (
    excel_serial_date,
    first_known,
    half_even,
    if_else,
    is_in,
    last_known,
    month_to_quarter,
    not_in,
    pad_code,
    quarter_shift,
    ratio,
    remap_prefix,
    safe_double,
    safe_int,
    sum_known,
)
from panelproj.operators.relational import (
    fill_from_group,
    flag_membership,
    keep_repeated,
    lookup_matched,
    na_anti,
    na_join,
    sort_rows,
    union_strict,
    weighted_quantile,
)

INF = float("inf")


def values(df, expr):
    return [r[0] for r in df.select(expr).collect()]


def test_missing_keys_match(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c")], "id int, k string")
    right = spark.createDataFrame([("a", 10), (None, 20), (None, 30)], "k string, v int")
    assert rows(na_join(left, right, ["k"], "left"), "id", "v") == [(1, 10), (2, 20), (2, 30), (3, None)]
    assert rows(na_anti(left, right, ["k"]), "id") == [(3,)]
    assert rows(flag_membership(left, right, ["k"], "f"), "id", "f") == [(1, 1), (2, 1), (3, 0)]
    assert rows(lookup_matched(left, right.filter("v < 30"), ["k"], "v"), "id", "v") == [(1, 10), (2, 20)]


def test_lookup_multiplicity_is_kept(spark):
    left = spark.createDataFrame([("a", 1.0)], "k string, x double")
    right = spark.createDataFrame([("a", "HTN"), ("a", "IHD")], "k string, market string")
    assert lookup_matched(left, right, ["k"], "market").agg(F.sum("x")).first()[0] == 2.0


def test_membership_is_never_missing(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert values(df, is_in("x", ["a"])) == [True, False, False]
    assert values(df, not_in("x", ["a"])) == [False, True, True]


def test_condition_missing(spark):
    df = spark.createDataFrame([(True,), (False,), (None,)], "c boolean")
    assert values(df, if_else(F.col("c"), F.lit(1), F.lit(2))) == [1, 2, None]


def test_sum_and_first_of_nothing(spark):
    df = spark.createDataFrame([("g", 1, None), ("g", 2, None), ("h", 1, None), ("h", 2, 5.0), ("h", 3, 7.0)], "k string, o int, x double")
    got = {
        r.k: (r.s, r.f, r.l)
        for r in df.groupBy("k").agg(sum_known("x").alias("s"), first_known("x", ["o"]).alias("f"), last_known("x", ["o"]).alias("l")).collect()
    }
    assert got == {"g": (0.0, None, None), "h": (12.0, 5.0, 7.0)}


def test_division(spark):
    pairs = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, None), (None, 1.0), (6.0, 3.0), (INF, INF)]
    df = spark.createDataFrame(pairs, "n double, d double")
    assert values(df, ratio("n", "d")) == [INF, -INF, None, None, None, 2.0, None]


def test_infinity_is_positive_and_undefined_is_dropped(spark):
    df = spark.createDataFrame([(1.0, 0.0), (0.0, 0.0)], "n double, d double").withColumn("u", ratio("n", "d"))
    assert [r.u for r in df.filter(F.col("u") > 0).collect()] == [INF]


def test_rounding(spark):
    df = spark.createDataFrame([(0.5,), (1.5,), (2.5,), (INF,)], "x double")
    assert values(df, half_even("x")) == [0.0, 2.0, 2.0, INF]
    assert values(spark.createDataFrame([(2.675,)], "x double"), half_even("x", 2)) == [2.68]


def test_codes(spark):
    df = spark.createDataFrame([("123",), ("1234567",), ("12345678",), ("abc",), (None,)], "c string")
    assert values(df, pad_code("c")) == ["0000123", "1234567", "12345678", "0000abc", None]
    old_new = {"47775": "58906", "06470": "64895"}
    codes = spark.createDataFrame([("4777512",), ("0647001",), ("1111111",), (None,)], "c string")
    assert values(codes, remap_prefix("c", old_new)) == ["5890612", "6489501", "1111111", None]
    long = spark.createDataFrame([("477751234",), ("111111111",)], "c string")
    assert values(long, remap_prefix("c", old_new)) == ["5890612", "111111111"]


def test_safe_numbers(spark):
    df = spark.createDataFrame([("10.5",), (" 30 ",), ("x",), ("1d",), ("NaN",), ("1e3",), (None,)], "c string")
    assert values(df, safe_int("c")) == [10, 30, None, None, None, 1000, None]
    long = spark.createDataFrame([("3000000001",), ("900719925474099312",), ("-5",)], "c string")
    assert values(long, safe_int("c")) == [3000000001, 900719925474099312, -5]
    assert values(df, safe_double("c")) == [10.5, 30.0, None, None, None, 1000.0, None]


def test_missing_sorts_last(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "x int")
    assert [r.x for r in sort_rows(df, "x").collect()] == [1, 2, None]
    assert [r.x for r in sort_rows(df, "-x").collect()] == [2, 1, None]


def test_periods(spark):
    df = spark.createDataFrame([("202001",), ("202012",), ("202013",), (None,)], "d string")
    assert values(df, month_to_quarter("d")) == ["2020Q1", "2020Q4", None, None]
    assert quarter_shift("2020Q1", -1) == "2019Q4" and quarter_shift("2020Q4", -3) == "2020Q1"
    serial = spark.createDataFrame([("44000",), ("x",)], "s string")
    assert values(serial, excel_serial_date("s")) == ["2020-06-18", None]


def test_union_rejects_type_clash(spark):
    with pytest.raises(TypeError):
        union_strict(spark.createDataFrame([("1",)], "a string"), spark.createDataFrame([(1,)], "a bigint"))


def test_group_fill_covers_missing_keys(spark, rows):
    df = spark.createDataFrame([(None, 1, None), (None, 2, "x"), ("k", 1, "y")], "k string, o int, v string")
    filled = fill_from_group(df.withColumn("w", F.col("v")), ["k"], {"v": first_known("w", ["o"])})
    assert rows(filled, "k", "o", "v") == [(None, 1, "x"), (None, 2, "x"), ("k", 1, "y")]


def test_repeated_keys(spark, rows):
    df = spark.createDataFrame([(None, 1), (None, 2), ("b", 3)], "k string, v int")
    assert rows(keep_repeated(df, ["k"]), "v", "n") == [(1, 2), (2, 2)]


@pytest.mark.parametrize("q", [0.0, 0.5, 0.9, 1.0])
def test_quantile_is_exact(spark, q):
    import numpy as np

    rng = np.random.default_rng(3)
    data = [(float(v), int(n)) for v, n in zip(rng.gamma(1, 5, 900).round(1), rng.integers(1, 9, 900), strict=True)]
    expanded = np.repeat([v for v, _ in data], [n for _, n in data])
    got = weighted_quantile(spark.createDataFrame(data, "v double, n int"), "v", "n", q, bins=16).first()[0]
    assert got == pytest.approx(float(np.quantile(expanded, q)), rel=1e-12)


def test_quantile_of_nothing(spark):
    empty = spark.createDataFrame([], "v double, n int")
    assert weighted_quantile(empty, "v", "n", 0.9).first()[0] is None
