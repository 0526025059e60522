"""Standardisation, lookups, delivery and roll-forward on hand-made rows."""

import pytest
from pyspark.sql import functions as F

from panelproj.operators.delivery import DELIVERY_COLUMNS, DELIVERY_LABELS, DIMENSIONS, MEASURES, DeliveryRules, classify, label_delivery, national_rollup, split_markets
from panelproj.operators.dims import DISABLED_MARK, NAME_ATTRIBUTES, attribute_source, build_universe, city_tier, newest_attributes, product_master, tender_rounds
from panelproj.operators.periods import assemble_delivery, growth_rollforward, lead_growth, moving_annual_total, self_rollforward
from panelproj.operators.project import tier_districts
from panelproj.operators.review import duplicate_key_check, price_check_matrix, tender_coverage, uniformity_report
from panelproj.plans import published_parameters
from panelproj.operators.standardize import centre_places, combine_panels, standardize_panel

RAW = (
    "project string, year int, quarter string, month string, province string, city string, county string, hospital_name string, "
    "atc4_code string, molecule_desc string, packcode string, volume double, price double, value double"
)


def raw(**over):
    base = {
        "project": "P", "year": 2020, "quarter": "2020Q4", "month": "2020/10", "province": "北京市", "city": "市辖区", "county": "d",
        "hospital_name": "h", "atc4_code": "C07A0", "molecule_desc": "m", "packcode": "4777501", "volume": 2.0, "price": 5.0, "value": 10.0,
    }
    return tuple({**base, **over}.values())


def test_standardize(spark, rows):
    data = [
        raw(),
        raw(),  # an identical transaction collapses
        raw(volume=None),  # 10 / 5: the same as reported, collapses as well
        raw(volume=None, price=0.0, month="202011"),  # infinite units stay
        raw(value=0.0),
        raw(hospital_name="unknown"),
        raw(molecule_desc="unknown"),
        raw(project="Q"),
        raw(packcode="123", province=None),
    ]
    places = spark.createDataFrame([("北京", "北京", "d", "h", "k1"), (None, "北京", "d", "h", "k2")], "province string, city string, district string, hospital string, pchc string")
    markets = spark.createDataFrame([("C07A", "m", "HTN"), ("C07A", "m", "IHD")], "atc3 string, molecule string, market string")
    out = standardize_panel(spark.createDataFrame(data, RAW), places, markets, projects=["P"], exclude_provinces=["x"])
    inf = float("inf")
    assert rows(out, "pchc", "date", "market", "packid", "units") == sorted(
        [(k, d, m, p, u) for m in ("HTN", "IHD") for k, d, p, u in [("k1", "202010", "5890601", 2.0), ("k1", "202011", "5890601", inf), ("k2", "202010", "0000123", 2.0)]]
    )


FACT = "year string, date string, quarter string, province string, city string, district string, pchc string, market string, packid string, units double, sales double"


def test_combine_takes_the_first_known_place(spark, rows):
    a = spark.createDataFrame([("2020", "202010", "2020Q4", "p", "c", None, "k", "HTN", "1", 1.0, 5.0)], FACT)
    b = spark.createDataFrame([("2020", "202010", "2020Q4", "p", "other", "d", "k", "HTN", "1", 1.0, 5.0)], FACT)
    assert rows(combine_panels(a, b), "city", "district", "units", "sales", "flag") == [("c", "d", 2.0, 10.0, 0)]


def test_centre_places(spark, rows):
    names = [("p", None, "d", "a", "k"), ("p", "c", None, "b", "k")]
    df = spark.createDataFrame(names, "province string, city string, district string, hospital string, pchc string")
    assert rows(centre_places(df)) == [("k", "p", "c", "d")]


def test_universe(spark, rows):
    facts = spark.createDataFrame([("2020", "202010", "2020Q4", "p", "fact city", "d", "k1", "HTN", "1", 1.0, 5.0), ("2020", "202010", "2020Q4", "p", "c", "d", "k3", "HTN", "1", 1.0, 5.0)], FACT)
    registry = [("p省", "c市", "d", "k1", 10.0), ("p省", "c市", "d", "k1", 5.0), ("p省", "c市", "d", "k1", 5.0), ("p省", "c市", "d", "k2", 7.0), ("p省", "c市", "d", "k4", 0.0)]
    out = build_universe(facts, spark.createDataFrame(registry, "province string, city string, district string, pchc string, est double"))
    # k3 has no size and k4 no positive one.
    assert rows(out, "pchc", "city", "est", "flag_sample") == [("k1", "fact city", 15.0, 1), ("k2", "c", 7.0, 0)]


def test_tier_defaults(spark, rows):
    listing = spark.createDataFrame([("a", None), ("a", 2.0), ("b", None), ("c", 1.0), ("c", 3.0)], "city string, city_tier double")
    tiers = city_tier(listing, ["city_tier"])
    assert rows(tiers) == [("a", 2.0), ("b", 5.0), ("c", 1.0), ("c", 3.0)]
    universe = spark.createDataFrame([("k", "p", c, "d", 1.0, 0) for c in "abcz"], "pchc string, province string, city string, district string, est double, flag_sample int")
    assert rows(tier_districts(universe, tiers), "city", "tier") == [("a", 2.0), ("b", 5.0), ("c", 1.0), ("c", 3.0), ("z", 1.0)]


def test_product_master(spark):
    first = spark.createDataFrame([("1", "CO", "A", "M", "P", None), ("2", None, "A", "M", "P", None)], "packid string, corp string, atc3 string, molecule string, product string, pack string")
    second = spark.createDataFrame([("1", "Z", "zz", "名"), ("3", "A", "class", None)], "packid string, atc3 string, atc3_cn string, product_cn string")
    corps = spark.createDataFrame([("CO", "公司")], "name string, namec string")
    fallback = spark.createDataFrame([("2", "alt", "r1"), ("2", "alt2", "r2")], "packid string, product_cn string, route string")
    got = {(r.packid, r.route): r for r in product_master([first, second], corps, fallback).collect()}
    assert sorted(got) == [("1", None) , ("2", "r1"), ("2", "r2"), ("3", None)]
    one = got[("1", None)]
    # The class of the earlier source wins; its local name comes from another pack of the class.
    assert (one.corp_cn, one.atc3, one.atc3_cn, one.product_cn) == ("公司", "A", "class", "名")
    assert got[("2", "r1")].product_cn == "alt" and got[("3", None)].atc3_cn == "class"


def test_attribute_source(spark, rows):
    df = spark.createDataFrame([("01禁用", "n", None), ("01", "n", None)], "PACK_ID string, PROD_NAME_CH string, NFC1_NAME_CH string")
    assert rows(attribute_source(df, NAME_ATTRIBUTES, {"PACK_ID": DISABLED_MARK}), "packid", "product_cn", "route") == [("01", "n", None)]


def test_tender_rounds(spark, rows):
    packs = spark.createDataFrame([("National", "m", 2), ("c", "m", 2), ("c", "x", 1), ("c", None, 1), ("c", "m", 9)], "city string, molecule string, sheet int")
    out = tender_rounds(packs, labels={1: "4+7", 2: "扩围"}, merge_national=("扩围", "4+7"), exclude_molecules=["x"])
    assert rows(out) == sorted([("National", "m", "4+7"), ("c", "m", None), ("c", "m", "扩围")], key=lambda t: (t[0], t[2] is not None))


def test_newest_attributes(spark, rows):
    df = spark.createDataFrame([("k", 1, "a", "x"), ("k", 2, None, None), ("k", 3, None, "y")], "k string, o int, p string, q string")
    out = newest_attributes(df, ["k"], ["o"], last=["p"], last_known=["q"])
    assert rows(out, "o", "p", "q") == [(1, None, "y"), (2, None, "y"), (3, None, "y")]


@pytest.mark.parametrize(
    ("row", "expected"),
    [
        (("HTN", "C09A", None, "m", None), ("RAASi PLAIN", "ACEI")),
        (("HTN", "C09B", "C09B3", "m", None), ("RAASi FDC", "A+C")),
        (("HTN", "C03A", None, "m", None), ("DU", "DU")),
        (("HTN", "C02B", None, "m", None), ("Others", "Others")),
        (("IHD", "C09A", None, "m", None), (None, "ACEI")),
        (("Diabetes", "A10J", None, "m", None), ("OAD&GLP-1", "MET")),
        (("Diabetes", "C09A", None, "m", None), ("OAD&GLP-1", None)),
        (("IHD", "C01D", None, "TRIMETAZIDINE", None), ("TMZ", None)),
        (("IHD", "C01D", None, "x", None), ("OTHERS", None)),
        (("IHD", "C01D", None, None, None), (None, None)),
        (("IHD", "C01E", None, "x", None), ("LAN", None)),
        (("Venous Disease", "V03B", None, "x", "口服固体"), ("TCM", "TCM Oral")),
        (("Venous Disease", "V03B", None, "x", "other"), ("TCM", "TCM")),
        (("Venous Disease", "C05C", None, "x", "口服固体"), ("VAD Oral", "VAD Oral")),
        ((None, "C09A", None, "m", None), (None, None)),
    ],
)
def test_classify(spark, row, expected):
    got = classify(spark.createDataFrame([row], "market string, atc3 string, atc4 string, molecule string, route string")).first()
    assert (got.category_1, got.category_2) == expected


def test_split(spark):
    df = spark.createDataFrame([("HTN", "C07A", 8.0), ("IHD", "C08B", 10.0), ("HTN", "C09A", 3.0), (None, "C07A", 4.0)], "market string, atc3 string, x double")
    assert [r.y for r in split_markets(df, {"y": "x"}).collect()] == [6.0, 1.0, 3.0, 4.0]


def delivery(spark, *changes):
    types = {**dict.fromkeys(DIMENSIONS, "string"), "pack_size": "int", **dict.fromkeys(MEASURES, "double")}
    base = {c: None for c in DELIVERY_COLUMNS} | {
        "channel": "CHC", "city": "c", "city_en": "C", "period_type": "QTR", "year": "2020", "quarter": "Q3", "date": "2020Q3", "market": "HTN",
        "category_2": "x", "molecule": "m", "product": "P", "packid": "0000001", **dict.fromkeys(MEASURES, 10.0),
    }
    return spark.createDataFrame([tuple((base | c).values()) for c in changes], ", ".join(f"`{c}` {types[c]}" for c in base))


def test_national_member_comes_from_the_main_channel(spark, rows):
    df = delivery(spark, {"city": "a"}, {"city": "b", "manufacture_type": "MNC"}, {"channel": "CHS"})
    total = national_rollup(df).filter("_src = 0")
    assert rows(total, "city", "value_lc", "manufacture_type") == [("National", 20.0, "MNC")]
    assert national_rollup(df).count() == 4


def test_labels(spark):
    assert label_delivery(delivery(spark, {})).columns == list(DELIVERY_LABELS.values()) and len(DELIVERY_LABELS) == 34


def test_growth_pairs_rows_in_date_order(spark, rows):
    df = delivery(spark, {"date": "2020Q4", "value_lc": 30.0, "units": 5.0}, {"date": "2020Q3"}, {"date": "2020Q3", "packid": "2"})
    assert rows(lead_growth(df, ["packid"]), "packid", "growth_sales", "growth_units") == [("0000001", 3.0, 0.5)]


def test_growth_rollforward(spark, rows):
    history = delivery(
        spark, {"city": "proxy", "packid": "1"}, {"city": "gone", "packid": "1"}, {"city": "gone", "packid": "2"}, {"city": "gone", "packid": "3"}
    )
    current = delivery(spark, {"city": "proxy", "date": "2020Q4", "value_lc": 20.0, "units": 30.0})
    external = spark.createDataFrame(
        [("0000001", 1.0, 9.0, 1.0, 9.0), ("0000002", 10.0, 5.0, 10.0, 40.0), ("0000003", 0.0, 5.0, 1.0, 1.0)],
        "pack_id string, `2020Q3_RENMINBI` double, `2020Q4_RENMINBI` double, `2020Q3_UNIT` double, `2020Q4_UNIT` double",
    )
    out = growth_rollforward(current, history, external, missing_city="gone", proxy_city="proxy", quarter="2020Q4")
    # Pack 1 grows with the proxy, pack 2 with the external panel, pack 3 has no finite growth.
    assert rows(out, "packid", "date", "quarter", "value_lc", "units", "counting_units") == [
        ("0000001", "2020Q4", "Q4", 20.0, 30.0, 30.0), ("0000002", "2020Q4", "Q4", 5.0, 40.0, 40.0)
    ]


def test_self_rollforward(spark, rows):
    history = delivery(spark, {"date": "2020Q2", "value_lc": 5.0}, {"date": "2020Q3"}, {"date": "2020Q3", "molecule": "z"}, {"date": "2020Q3", "city": "new"})
    out = self_rollforward(history, molecule="m", quarter="2020Q4")
    assert rows(out, "city", "value_lc", "units") == [("c", 20.0, 10.0)]


def test_reports(spark, rows):
    clean = delivery(spark, {"date": "2020Q3"}, {"date": "2020Q4"}, {"city": "other"})
    assert uniformity_report(clean).count() == 0 and duplicate_key_check(clean).count() == 0
    odd = delivery(spark, {"atc3": "A"}, {"atc3": "B"}, {"packid": "0000002", "atc3": "A"})
    assert rows(uniformity_report(odd), "packid", "atc3", "n") == [("0000001", "A", 2), ("0000001", "B", 2)]
    assert duplicate_key_check(odd).count() == 2
    tenders = spark.createDataFrame([("c", "m", "0000001", 4), ("c", "m", "0000009", 4), ("c", "q", "0000001", 4), ("c", "m", "0000001", 1)], "city string, molecule string, packid string, sheet int")
    assert rows(tender_coverage(tenders, clean, sheet=4), "packid", "molecule", "existence") == [
        ("0000001", "m", "有"), ("0000001", "q", "没有"), ("0000009", "m", "Pack没有，产品有")
    ]


def test_price_matrix(spark):
    df = delivery(spark, {"value_lc": 25.0}, {"date": "2020Q4", "value_lc": 40.0}, {"date": "2020Q4", "value_lc": 90.0}, {"packid": "2", "value_lc": 999.0})
    matrix = price_check_matrix(df)
    assert [r.packid for r in matrix.collect()] == ["2", "0000001"]
    assert [tuple(r)[-2:] for r in matrix.collect()] == [([100.0], []), ([2.0], [4.0, 9.0])]
    single = price_check_matrix(df.filter("value_lc <> 90"), as_lists=False).filter("packid = '0000001'").first()
    assert (single["2020Q3"], single["2020Q4"]) == (2.0, 4.0)
    with pytest.raises(Exception, match="several prices in 2020Q4 of 0000001"):
        price_check_matrix(df, as_lists=False).collect()


def test_classes_do_not_gather_hot_groups(spark):
    """Group fills aggregate first: no window over the fact rows in the plan."""
    df = spark.range(100).select(F.lit("k").alias("k"), F.col("id").alias("o"), F.col("id").cast("string").alias("v"))
    plan = newest_attributes(df, ["k"], ["o"], last=["v"])._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_max_by" in plan


def test_last_is_the_last_delivered_row(spark, rows):
    """Within a delivered table QTR rows come before MAT rows, and a channel before the next one's older rows."""
    history = delivery(
        spark,
        {"period_type": "MAT", "product_name": "from MAT"}, {"period_type": "QTR", "product_name": "from QTR"},
        {"packid": "0000002", "channel": "CHC", "date": "2020Q4", "product_name": "new CHC"}, {"packid": "0000002", "channel": "CHS", "date": "2020Q1", "product_name": "old CHS"},
    )
    nothing = history.filter("false")
    named = assemble_delivery(history, nothing, nothing, sort=False)
    assert set(rows(named, "packid", "product_name")) == {("0000001", "from MAT"), ("0000002", "old CHS")}
    report = uniformity_report(history.withColumn("market", F.lit("m")).withColumn("atc3", F.col("period_type")))
    assert set(rows(report, "packid", "product_name")) == {("0000001", "from MAT")}
    total = moving_annual_total(history.filter("packid = '0000002'").withColumn("date", F.lit("2020Q3")), nothing, quarter="2020Q4")
    assert set(rows(total, "product_name")) == {("old CHS",)}


def test_missing_order_values_come_last(spark, rows):
    df = spark.createDataFrame([("k", None, "undated"), ("k", "2020Q3", "first"), ("k", "2020Q4", "second")], "k string, date string, v string")
    out = newest_attributes(df.withColumn("w", F.col("v")), ["k"], ["date"], last=["v"], first_known=["w"])
    assert set(rows(out, "v", "w")) == {("undated", "first")}
    periods = spark.createDataFrame([("k", None, 9.0, 9.0), ("k", "2020Q3", 2.0, 1.0), ("k", "2020Q4", 4.0, 2.0)], "k string, date string, value_lc double, units double")
    assert rows(lead_growth(periods, ["k"]), "growth_sales", "growth_units") == [(2.0, 2.0), (2.25, 4.5)]


def test_published_parameters_fit_the_run():
    params = published_parameters("2020Q4")
    assert params.missing_city in params.target_cities and params.proxy_city in params.target_cities
    assert set(params.exclude_donor_provinces) <= set(params.target_cities) and params.rules == DeliveryRules()
