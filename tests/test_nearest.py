"""Nearest-donor joins against brute force."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelproj.operators.impute import centre_months, knn_neighbours, knn_weights
from panelproj.operators.nearest import _candidate_cells, knn_join, nearest_in_block, nearest_values, value_bins
from panelproj.operators.project import nearest_district_donor


def brute(targets, donors):
    found = set()
    for by, v in targets:
        gaps = [(abs(v - d), d) for b, d in donors if b == by]
        if gaps:
            least = min(g for g, _ in gaps)
            found |= {(by, v, d) for g, d in gaps if g == least}
    return found


@pytest.mark.parametrize("per_bin", [1, 7, 4096])
def test_nearest_values(spark, per_bin):
    rng = np.random.default_rng(per_bin)
    targets = [(str(rng.choice(["a", "b", "z"])), float(v)) for v in rng.integers(0, 300, 200)]
    # Whole numbers give many two-sided ties and exact hits; block b is skewed, z has no donor.
    donors = [("a", float(v)) for v in rng.integers(0, 300, 60)] + [("b", float(v)) for v in rng.integers(40, 60, 90)]
    t, d = spark.createDataFrame(targets, "by string, v double"), spark.createDataFrame(donors, "by string, v double")
    got = {(r.by, r.v, r.donor_value) for r in nearest_values(t, d, "by", "v", per_bin).collect()}
    assert got == brute(targets, donors)


def test_targets_beyond_all_donors_are_spread(spark):
    """100,000 targets above 64 donors: no bin holds more than a few times its share."""
    points = spark.range(100_064).select(F.lit("a").alias("by"), F.col("id").cast("double").alias("v"))
    sizes = [r["count"] for r in value_bins(points, "by").groupBy("bin").count().collect()]
    assert len(sizes) >= 20 and max(sizes) <= 3 * 4096
    targets, donors = points.filter("v >= 64"), points.filter("v < 64")
    near = nearest_values(targets, donors, "by", "v")
    assert near.count() == 100_000 and near.filter("donor_value <> 63").count() == 0


def test_all_tied_donors_stay(spark, rows):
    t = spark.createDataFrame([("x", 1.0, 10.0)], "name string, tier double, est double")
    d = spark.createDataFrame(
        [("a", 1.0, 8.0), ("b", 1.0, 12.0), ("c", 1.0, 12.0), ("d", 1.0, 13.0)], "donor string, tier double, donor_est double"
    )
    assert rows(nearest_in_block(t, d, "tier", "est", "donor_est"), "donor") == [("a",), ("b",), ("c",)]


def test_district_donor_names(spark, rows):
    """A tie keeps the first donor's name only, but every donor that bears it."""
    districts = [
        ("p", "c0", "self", 50.0, 2),
        ("p", "c1", "north", 8.0, 1),
        ("p", "c2", "south", 12.0, 1),
        ("p", "c3", "north", 12.0, 1),
        ("p", "c4", "asks", 10.0, 0),
        ("q", "c5", "alone", 1.0, 0),
    ]
    df = spark.createDataFrame(districts, "province string, city string, district string, est double, sample int")
    got = [r for r in rows(nearest_district_donor(df), "city", "sample_city", "sample_dist") if r[0] in ("c0", "c4", "c5")]
    assert got == [("c0", "c0", "self"), ("c4", "c1", "north"), ("c4", "c3", "north")]


@pytest.mark.parametrize(("cells", "block"), [(1, 4), (8, 16), (64, 2048)])
def test_knn_matches_brute_force(spark, cells, block, monkeypatch):
    rng = np.random.default_rng(cells)
    donors = rng.integers(0, 4, (1600, 3)).astype(float)
    donors[:600] = donors[0]  # copies: one vector holds a third of the rows
    targets = rng.integers(0, 5, (40, 3)).astype(float)
    named = lambda prefix, m: [(f"{prefix}{i:04d}", *map(float, r)) for i, r in enumerate(m)]
    schema = "pchc string, a double, b double, c double"
    t, d = spark.createDataFrame(named("t", targets), schema), spark.createDataFrame(named("d", donors), schema)
    got = {(r.target, r.rank): (r.donor, r.distance) for r in knn_join(t, d, ["a", "b", "c"], "pchc", 3, cells=cells, block=block).collect()}
    for i, v in enumerate(targets):
        distance = np.sqrt(((donors - v) ** 2).sum(axis=1))
        for rank, j in enumerate(np.argsort(distance, kind="stable")[:3], start=1):
            assert got[(f"t{i:04d}", rank)] == (f"d{j:04d}", pytest.approx(distance[j]))
    assert len(got) == 120


def test_fewer_donors_than_k(spark):
    schema = "pchc string, a double"
    t, d = spark.createDataFrame([("t", 1.0)], schema), spark.createDataFrame([("d", 2.0)], schema)
    assert [(r.donor, r["rank"]) for r in knn_join(t, d, ["a"], "pchc", 3).collect()] == [("d", 1)]
    assert knn_join(t, d.limit(0), ["a"], "pchc", 3).count() == 0


FACT = "year string, date string, quarter string, province string, city string, district string, pchc string, market string, packid string, units double, sales double"


def fact(province, pchc, date, market, pack, sales):
    return ("2020", date, "2020Q4", province, "c", "d", pchc, market, pack, 1.0, float(sales))


def test_pack_in_two_markets_counts_once(spark):
    facts = [fact("x", "p1", "202010", "HTN", "1", 5), fact("x", "p1", "202010", "IHD", "1", 5), fact("x", "p1", "202011", "HTN", "1", 5)]
    row = centre_months(spark.createDataFrame(facts, FACT)).first()
    assert (row["202010"], row["202011"]) == (5.0, 5.0)


def test_weights(spark):
    facts = [fact("t", "t1", "202010", "HTN", "1", 10), fact("t", "t1", "202011", "HTN", "1", 3)]
    for i, s in enumerate([10, 12, 20, 50], start=1):
        facts += [fact("o", f"d{i}", "202010", "HTN", "1", s), fact("o", f"d{i}", "202011", "HTN", "1", 3)]  # second month is constant
    near = knn_neighbours(spark.createDataFrame(facts, FACT), target="t")
    found = {r["rank"]: (r.knn_pchc, r.distance) for r in near.collect()}
    sd = np.std([10, 12, 20, 50], ddof=1)
    assert [found[r][0] for r in (1, 2, 3)] == ["d1", "d2", "d3"]
    assert [found[r][1] for r in (1, 2, 3)] == pytest.approx([0, 2 / sd, 10 / sd])
    w = [1 / (1 + found[r][1]) for r in (1, 2, 3)]
    a = w[0] / sum(w)
    b = w[1] / (a + w[1] + w[2])
    c = w[2] / (a + b + w[2])
    assert [r.knn_weight for r in knn_weights(near).orderBy("rank").collect()] == pytest.approx([a, b, c])
    proper = [r.knn_weight for r in knn_weights(near, normalize="proper").orderBy("rank").collect()]
    assert sum(proper) == pytest.approx(1) and proper == pytest.approx([x / sum(w) for x in w])


def test_one_centre_at_two_places(spark):
    """Each place's vector is ranked on its own."""
    facts = [("2020", "202010", "2020Q4", "t", "c", d, "t1", "HTN", "1", 1.0, s) for d, s in (("north", 10.0), ("south", 50.0))]
    facts += [fact("o", f"d{i}", "202010", "HTN", "1", s) for i, s in enumerate([10, 20, 50], start=1)]
    near = knn_neighbours(spark.createDataFrame(facts, FACT), target="t", k=1)
    assert sorted((r.district, r.pchc, r.knn_pchc) for r in near.collect()) == [("north", "t1", "d1"), ("south", "t1", "d3")]


def test_weights_with_fewer_donors_than_k(spark):
    facts = [fact("t", "t1", "202010", "HTN", "1", 10)] + [fact("o", f"d{i}", "202010", "HTN", "1", s) for i, s in enumerate([10, 30], start=1)]
    near = knn_neighbours(spark.createDataFrame(facts, FACT), target="t")
    weights = [r.knn_weight for r in knn_weights(near).orderBy("rank").collect()]
    assert len(weights) == 2 and all(w > 0 for w in weights)


def test_clusters_are_pruned(spark):
    """On clustered donors a target looks at few cells."""
    rng = np.random.default_rng(0)
    centres = rng.uniform(0, 1000, (40, 3))
    donors = np.repeat(centres, 50, axis=0) + rng.normal(0, 1, (2000, 3))
    counts, pivots = np.full(40, 50), centres
    radii = np.array([np.sqrt(((donors[i * 50 : i * 50 + 50] - centres[i]) ** 2).sum(axis=1)).max() for i in range(40)])
    asked = pd.DataFrame({"target": [str(i) for i in range(200)], "vec": list(donors[::10] + 0.1)})
    cells = next(_candidate_cells(pivots, counts, radii, 3)(iter([asked])))["cells"]
    assert np.mean([len(c) for c in cells]) * 50 < 0.1 * len(donors)
