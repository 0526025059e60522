"""Projection: aggregated form against the written-out form, and hand-made quirks."""

import numpy as np
import pytest

from panelproj.operators.price import price_level_table, price_levels, update_price
from by_centre import project_sample_by_centre
from panelproj.operators.project import project_nation, project_sample

FACT = "date string, province string, city string, district string, pchc string, market string, packid string, units double, sales double"
UNIVERSE = "pchc string, province string, city string, district string, est double, flag_sample int"


def panel(seed, hot=False):
    """Random universe with equal district names in several cities and centres outside the universe."""
    rng = np.random.default_rng(seed)
    centres, facts = [], []
    for i in range(160):
        place = (f"p{i % 3}", f"c{i % 5}", str(rng.choice(["north", "south", "west"])))
        share = {"north": 0.9, "south": 0.4, "west": 0.0}[place[2]]
        sampled = bool(rng.random() < share)
        name = f"k{i:03d}"
        if sampled:
            for _ in range(60 if hot and i == 0 else 6):
                facts.append(
                    (str(rng.choice(["202010", "202011"])), *place, name, str(rng.choice(["HTN", "IHD"])), f"{rng.integers(1, 4):07d}",
                     float(rng.integers(1, 9)), float(rng.integers(10, 99)))
                )
        if rng.random() < 0.93:
            centres.append((name, *place, float(rng.integers(1, 40)), int(sampled)))
    return facts, centres


@pytest.mark.parametrize(("seed", "key"), [(1, ("sample_dist",)), (2, ("sample_dist",)), (3, ("sample_city", "sample_dist"))])
def test_both_forms_agree(spark, rows, seed, key):
    facts, centres = panel(seed, hot=seed == 2)
    f, u = spark.createDataFrame(facts, FACT), spark.createDataFrame(centres, UNIVERSE)
    short = project_sample(f, u, ratio_key=key)
    long = project_sample_by_centre(f, u, ratio_key=key)
    columns = ["date", "province", "city", "district", "market", "packid", "flag_sample", "sales", "units"]
    a, b = rows(short, *columns), rows(long, *columns)
    assert len(a) > 50 and {r[6] for r in a} == {0, 1}
    assert a == b


def test_partitioning_does_not_matter(spark, rows):
    facts, centres = panel(5)
    results = []
    for partitions in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        f, u = spark.createDataFrame(facts, FACT).repartition(int(partitions)), spark.createDataFrame(centres, UNIVERSE)
        results.append(rows(project_sample(f, u)))
    assert results[0] == results[1]


@pytest.mark.parametrize(("sampled", "projected"), [(3, True), (4, False), (5, False)])
def test_coverage(spark, sampled, projected):
    """Five centres: at a share of 0.8 the remaining ones are left out, below it they are estimated."""
    centres = [(f"k{i}", "p", "c", "d", 10.0, int(i < sampled)) for i in range(5)]
    facts = [("202010", "p", "c", "d", f"k{i}", "HTN", "1", 2.0, 20.0) for i in range(sampled)]
    out = project_sample(spark.createDataFrame(facts, FACT), spark.createDataFrame(centres, UNIVERSE)).collect()
    got = {r.flag_sample: (r.sales, r.units) for r in out}
    assert got[1] == (20.0 * sampled, 2.0 * sampled)
    assert got.get(0) == ((20.0 * (5 - sampled), 2.0 * (5 - sampled)) if projected else None)


def test_outside_centre_is_appended_once(spark, rows):
    centres = [("k1", "p", "c", "d", 10.0, 1)]
    facts = [("202010", "p", "c", "d", "k1", "HTN", "1", 1.0, 10.0), ("202010", "p", "c", "d", "k9", "HTN", "1", 2.0, 5.0)]
    out = project_sample(spark.createDataFrame(facts, FACT), spark.createDataFrame(centres, UNIVERSE))
    assert rows(out, "sales", "units", "flag_sample") == [(15.0, 3.0, 1)]


SAMPLE = "date string, province string, city string, district string, market string, packid string, flag_sample int, sales double, units double"


def test_nation(spark, rows):
    """One sampled city, two missing ones; the cap is the quantile over all target x donor rows."""
    universe = [("k1", "p", "s", "d1", 10.0, 1), ("k2", "p", "s", "d2", 40.0, 1), ("k3", "q", "m", "d1", 30.0, 0), ("k4", "q", "n", "d1", 9.0, 0)]
    sample = [
        ("202010", "p", "s", "d1", "HTN", "1", 1, 100.0, 10.0),
        ("202011", "p", "s", "d1", "HTN", "2", 1, 50.0, 5.0),
        ("202010", "p", "s", "d2", "HTN", "1", 1, 400.0, 40.0),
    ]
    tiers = spark.createDataFrame([("s", 2.0), ("m", 2.0), ("n", 2.0)], "city string, tier double")
    out = project_nation(
        spark.createDataFrame(sample, SAMPLE), spark.createDataFrame(universe, UNIVERSE), tiers, exclude_provinces=[]
    )
    # Donor d2 (40) serves m (30): slope 0.75; donor d1 (10) serves n (9): slope 0.9; d1 and d2 serve themselves: 1.
    # Rows: d1 two packs x two months, d2 one pack x two months.
    slopes = [1.0] * 4 + [1.0] * 2 + [0.75] * 2 + [0.9] * 4
    cap = float(np.quantile(slopes, 0.9))
    assert cap == 1.0
    got = [r for r in rows(out, "city", "district", "packid", "date", "sales", "flag_sample") if r[5] == 0]
    assert got == [("m", "d1", "1", "202010", 300.0, 0), ("n", "d1", "1", "202010", 90.0, 0), ("n", "d1", "2", "202011", 45.0, 0)]
    assert out.filter("flag_sample = 1").count() == 3


def test_excluded_province_gives_nothing_but_receives(spark):
    universe = [("k1", "p", "s", "d", 10.0, 1), ("k2", "x", "t", "d", 10.0, 1), ("k3", "x", "m", "d", 5.0, 0)]
    sample = [("202010", "p", "s", "d", "HTN", "1", 1, 100.0, 10.0), ("202010", "x", "t", "d", "HTN", "9", 1, 70.0, 7.0)]
    tiers = spark.createDataFrame([], "city string, tier double")
    out = project_nation(
        spark.createDataFrame(sample, SAMPLE), spark.createDataFrame(universe, UNIVERSE), tiers, exclude_provinces=["x"]
    )
    assert [(r.city, r.packid, r.sales) for r in out.filter("flag_sample = 0").collect()] == [("m", "1", 50.0)]


RAW = "packid string, quarter string, year string, province string, city string, sales double, units double"


def test_price_levels_and_fallback(spark):
    raw = spark.createDataFrame(
        [
            ("1", "2020Q4", "2020", "p", "c", 10.0, 1.0),
            ("1", "2020Q3", "2020", "p", "c", 40.0, 2.0),
            ("1", "2020Q4", "2020", "p", "e", 60.0, 2.0),
            ("1", "2020Q1", "2020", "q", "f", 90.0, 1.0),
        ],
        RAW,
    )
    facts = [("CHC", d, p, c, "d", "HTN", k, 1, 120.0, 1.0) for d, p, c, k in [
        ("202010", "p", "c", "1"),  # city and quarter
        ("202004", "p", "c", "1"),  # city and year
        ("202010", "p", "z", "1"),  # province and quarter
        ("202004", "p", "z", "1"),  # province and year
        ("202010", "y", "z", "1"),  # pack and quarter
        ("202004", "y", "z", "1"),  # pack and year
        ("202010", "y", "z", "2"),  # no price at all
        ("202013", "p", "c", "1"),  # no quarter: falls through to the year
    ]]
    schema = "channel string, date string, province string, city string, district string, market string, packid string, flag_sample int, sales double, units double"
    got = {(r.date, r.province, r.city): (r.price, r.units) for r in update_price(spark.createDataFrame(facts, schema), raw).collect()}
    city_year = 50 / 3
    assert got == {
        ("202010", "p", "c"): (10.0, 12.0),
        ("202004", "p", "c"): (pytest.approx(city_year), pytest.approx(120 / city_year)),
        ("202010", "p", "z"): (pytest.approx(70 / 3), pytest.approx(360 / 70)),
        ("202004", "p", "z"): (22.0, pytest.approx(120 / 22)),
        ("202010", "y", "z"): (pytest.approx(70 / 3), pytest.approx(360 / 70)),
        ("202004", "y", "z"): (pytest.approx(200 / 6), pytest.approx(3.6)),
        ("202013", "p", "c"): (pytest.approx(city_year), pytest.approx(120 / city_year)),
    }
    one_pass = {}
    for r in price_level_table(raw).collect():
        one_pass.setdefault(r.level, []).append(r.price)
    for name, table in price_levels(raw).items():
        assert sorted(one_pass[name]) == pytest.approx(sorted(r[name] for r in table.collect()))
