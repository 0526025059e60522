"""Rule tables and mergeable quantiles."""

import random

import pytest

from panelproj.operators.delivery import DeliveryRules, classify
from panelproj.operators.relational import weighted_quantile
from panelproj.operators.rules import RULES, apply_rules, classification_rules
from panelproj.operators.sketch import merged_quantile, period_sketches, rank_error

ATTRIBUTES = "market string, atc3 string, atc4 string, molecule string, route string, n int"


@pytest.fixture(scope="module")
def products(spark):
    """Every market, class, subclass and route of the rules, unknown and missing ones, repeated rows."""
    r, rng = DeliveryRules(), random.Random(9)
    markets = ["HTN", "Diabetes", "IHD", "Venous Disease", "Other", None]
    classes = sorted({c for _, c in r.category_1} | {"C01D", "V03B", "V03X", "Z99Z"}) + [None]
    rows = [(m, c, rng.choice([*r.category_2_subclass, f"{c}1", None]), rng.choice(["TRIMETAZIDINE", "X", None]), rng.choice(["口服固体", "外用制剂", "other", None]), i) for i, (m, c) in enumerate((m, c) for m in markets for c in classes)]
    return spark.createDataFrame(rows + rows[:20], ATTRIBUTES)


def test_the_table_classifies_like_the_code(spark, products, rows):
    columns = [*products.columns, "category_1", "category_2"]
    assert rows(apply_rules(products, classification_rules(spark)), *columns) == rows(classify(products), *columns)
    rules = DeliveryRules(first_as_second=("IHD",), tcm_prefix="C0", nitrate_labels=("A", "B"))
    assert rows(apply_rules(products, classification_rules(spark, rules)), *columns) == rows(classify(products, rules), *columns)


def rule(step, priority, target, value=None, copy=None, **patterns):
    columns = ["market", "atc3", "atc4", "molecule", "route", "category_1", "category_2"]
    return (step, priority, *[patterns.get(c) for c in columns], target, value, copy)


def test_order_of_rules_and_steps(spark, rows):
    """Smallest priority wins whatever its shape and place in the table; a later step sees the earlier one."""
    df = spark.createDataFrame([("HTN", "C09A", None, "m", None, 1), ("HTN", "C07A", None, "m", None, 2), (None, None, None, None, None, 3)], ATTRIBUTES)
    wide, narrow = rule(1, 2, "category_1", "by class", atc3="C*"), rule(1, 1, "category_1", "by both", market="HTN", atc3="C09A")
    later = rule(2, 1, "category_2", copy="category_1", category_1="by both")
    rest = rule(2, 5, "category_2", "rest")

    def got(*table):
        return rows(apply_rules(df, spark.createDataFrame(list(table), RULES)), "n", "category_1", "category_2")

    assert got(wide, narrow, later, rest) == got(rest, later, narrow, wide) == [(1, "by both", "by both"), (2, "by class", "rest"), (3, None, "rest")]
    swapped = [rule(1, 3, "category_1", "by both", market="HTN", atc3="C09A"), wide, later, rest]
    assert got(*swapped) == [(1, "by class", "rest"), (2, "by class", "rest"), (3, None, "rest")]
    # the copying step first: nothing to copy yet, and the rest keeps what it has
    early = [rule(0, 1, "category_2", copy="category_1", category_1="by both"), wide, narrow]
    assert got(*early) == [(1, "by both", None), (2, "by class", None), (3, None, None)]
    assert got(rule(1, 1, "category_1", "none", market="?"), rule(1, 2, "category_1", "some", market="+")) == [(1, "some", None), (2, "some", None), (3, "none", None)]
    with pytest.raises(ValueError, match="several columns"):
        got(rule(1, 1, "category_1", "x"), rule(1, 2, "category_2", "y"))


def test_no_rules_and_no_rows(spark, products, rows):
    none = apply_rules(products, spark.createDataFrame([], RULES))
    assert none.count() == products.count() and none.filter("category_1 IS NOT NULL OR category_2 IS NOT NULL").isEmpty()
    assert apply_rules(products.filter("false"), classification_rules(spark)).isEmpty()


@pytest.mark.parametrize("q", [0.1, 0.5, 0.9])
def test_merged_sketches_are_near(spark, q):
    """Uneven, skewed and repeated values in uneven periods; the exact form has no rank error."""
    rng = random.Random(4)
    data = [(rng.choice(["a", "a", "a", "b", "c"]), rng.choice([rng.random(), rng.expovariate(1) ** 4, 7.0])) for _ in range(20_000)] + [("d", None)]
    df = spark.createDataFrame(data, "period string, v double")
    sketches = period_sketches(df, "v", "period")
    assert {r["period"]: r["n"] for r in sketches.collect()} == {p: sum(x == p for x, v in data if v is not None) for p in "abc"}
    merged = merged_quantile(sketches, q)
    assert merged.first()["n"] == 20_000
    assert rank_error(df, "v", merged, q).first()[0] <= 0.01
    exact = weighted_quantile(df.groupBy("v").count(), "v", "count", q)
    assert rank_error(df, "v", exact, q).first()[0] <= 1 / 20_000
