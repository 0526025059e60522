"""Partition numbers that follow the rows, and the vector join's blocks: same rows, bounded tasks."""

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelproj.catalog import fixtures
from panelproj.operators import relational
from panelproj.operators.audit import LookupAudit, cross_source_duplicates
from panelproj.operators.impute import centre_months
from panelproj.operators.nearest import _bins, _within_kth
from panelproj.operators.relational import spread
from panelproj.operators.standardize import FACT_COLUMNS, combine_panels
from panelproj.sources import ingest

FACTS = "year string, date string, quarter string, province string, city string, district string, pchc string, market string, packid string, units double, sales double"


def facts(spark, city):
    made = []
    for i in range(60):
        month, centre = f"2000{i % 5 + 1:02d}", f"C{i % 7}" if i % 7 else None
        made.append(("2000", month, "2000Q1", "P", f"{city}{i % 3}", None if i % 4 else "D", centre, "M", f"{i % 6:07d}", 1.0 + i % 3, 5.0 * (i % 8)))
    return spark.createDataFrame(made + made[:9], FACTS).select(*FACT_COLUMNS)


def test_parts_follow_the_rows(spark, tmp_path, monkeypatch):
    lines = [(i, i, i, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", None) for i in range(200)]
    spark.createDataFrame(lines, fixtures.TABLES["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    assert fixtures.Fixtures(spark, str(tmp_path)).parts is None
    monkeypatch.setattr(fixtures, "PART_ROWS", 10)
    fx = fixtures.Fixtures(spark, str(tmp_path))
    assert fx.parts == 20
    assert spread(fx.table("lineitem"), fx.parts, "l_orderkey").rdd.getNumPartitions() == 20


def test_combined_panels_in_parts(spark, rows):
    first, second = facts(spark, "a"), facts(spark, "b")
    whole, dealt = combine_panels(first, second), combine_panels(first, second, parts=9)
    assert rows(dealt) == rows(whole) and dealt.count() > 30
    places = [f.withColumn("_pos", F.xxhash64("date", "packid", "city", "pchc")) for f in (first, second)]
    assert rows(combine_panels(*places, parts=9)) == rows(combine_panels(*places))


def first_places(stacked, order):
    """Centre -> its first known province, city and district, one by one."""
    found = {}
    for r in sorted(stacked, key=lambda r: [(r[c] is None, r[c] or 0) for c in order]):
        for c in ("province", "city", "district"):
            if r[c] is not None:
                found.setdefault((r["pchc"], c), r[c])
    return found


def test_combined_panels_take_first_places(spark):
    both = [facts(spark, "a").withColumn("city", F.when(F.col("packid") != "0000000", F.col("city"))), facts(spark, "b")]
    for sources in (both, [f.withColumn("_pos", F.xxhash64("date", "packid", "city", "pchc")) for f in both]):
        order = ["_src", "_pos"] if "_pos" in sources[0].columns else ["_src", "date", "market", "packid", "province", "city", "district"]
        stacked = [r.asDict() | {"_src": i} for i, f in enumerate(sources) for r in f.collect()]
        found, sums = first_places(stacked, order), {}
        for r in stacked:
            r |= {c: found.get((r["pchc"], c)) for c in ("province", "city", "district")}
            total = sums.setdefault(tuple(r[c] for c in FACT_COLUMNS[:-2]), [0.0, 0.0])
            total[:] = total[0] + r["units"], total[1] + r["sales"]
        for parts in (None, 9):
            got = combine_panels(*sources, parts=parts)
            assert got.columns == [*FACT_COLUMNS, "flag"]
            assert {tuple(r[:9]): [r["units"], r["sales"]] for r in got.collect()} == sums


def test_combined_facts_move_once(spark, capsys):
    first, second = facts(spark, "a"), facts(spark, "b")
    for sources in ([first, second], [f.withColumn("_pos", F.xxhash64("date", "packid")) for f in (first, second)]):
        for parts in (None, 9):
            out = combine_panels(*sources, parts=parts)
            assert out.inputFiles() == []  # none are written between
            out.explain()
            assert capsys.readouterr().out.count("Exchange hashpartitioning(") == 1


def moves(plan, column):
    """For each scan that begins with a column, how many exchanges its rows pass."""
    above, found = [], []
    for line in plan.splitlines():
        if ("+- " in line or ":- " in line) and "Physical Plan" not in line:
            at = min(line.find(m) for m in ("+- ", ":- ") if m in line)
            above = [x for x in above if x[0] < at] + [(at, "Exchange " in line)]
            if f"FileScan parquet [{column}#" in line:
                found.append(sum(x[1] for x in above))
    return found


def test_order_lines_move_twice(spark, tmp_path, monkeypatch, capsys):
    """To their order, which has its centre by then, and to their pack."""
    monkeypatch.setattr(fixtures, "PART_ROWS", 1)
    lines = [(i, i, i, 1, 1.0, 1.0, 0.0, 0.0, "A", "F", None) for i in range(20)]
    for name, schema in fixtures.TABLES.items():
        spark.createDataFrame(lines if name == "lineitem" else [], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fixtures.Fixtures(spark, str(tmp_path)).sales.explain()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert moves(capsys.readouterr().out, "l_orderkey") == [2]


def test_sales_keep_all_matches(spark, tmp_path, rows):
    """Repeated keys multiply, missing ones match nothing."""
    made = {
        "region": [(0, "R")], "nation": [(7, "N", 0)], "supplier": [],
        "customer": [(1, "Customer#1", 7, 5.5, "S"), (1, "Customer#1b", 7, None, None), (None, "x", 7, 1.0, "S"), (2, "Customer#2", None, 1.0, "S")],
        "part": [(3, "p", "Brand#1", "LARGE", 4, 9.0), (3, "q", None, None, None, None), (None, "r", "Brand#1", "SMALL", 1, 1.0)],
    }
    for name, data in made.items():
        spark.createDataFrame(data, fixtures.TABLES[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    when = "timestamp_ntz'1995-05-09 00:00:00'"
    spark.sql(
        f"SELECT * FROM VALUES (8L, 1L, 'P', 1.0D, {when}, 'x'), (8L, 1L, 'F', 1.0D, null, 'x'), (9L, null, 'P', 1.0D, {when}, 'x'), (null, 1L, 'P', 1.0D, {when}, 'x') "
        "AS t(o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority)"
    ).write.parquet(f"{tmp_path}/orders.parquet")
    lines = [(8, 3, 1, 1, 2.0, 10.7, 0.0, 0.0, "A", "F", None), (9, 3, 1, 1, 2.0, 10.7, 0.0, 0.0, "A", "F", None), (None, 3, 1, 1, 2.0, 1.0, 0.0, 0.0, "A", "F", None), (8, None, 1, 1, 2.0, 1.0, 0.0, 0.0, "A", "F", None)]
    spark.createDataFrame(lines, fixtures.TABLES["lineitem"]).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = rows(fixtures.Fixtures(spark, str(tmp_path)).sales, "o_orderstatus", "year", "date", "quarter", "pchc", "est", "province", "city", "district", "packid", "market", "units", "sales")
    want = [
        (*order, *centre, *pack, 2.0, 10.0)
        for order in (("P", "1995", "199505", "1995Q2"), ("F", None, None, None))
        for centre in (("C1", 5.0, "R", "N", "S"), ("C1b", None, "R", "N", None))
        for pack in (("0000104", "Diabetes"), (None, None))
    ]
    assert len(got) == 8 and set(got) == set(want)


def test_centre_months_in_parts(spark, rows):
    panel = facts(spark, "a")
    months = [f"2000{m:02d}" for m in range(1, 6)]
    assert rows(centre_months(panel, months, 9)) == rows(centre_months(panel, months))


def test_cross_source_duplicates_in_parts(spark, rows):
    sources = [facts(spark, "a"), facts(spark, "a").filter("sales > 5")]
    keys = ["date", "city", "pchc", "units"]
    assert rows(cross_source_duplicates(sources, keys, 9)) == rows(cross_source_duplicates(sources, keys))


def test_lookup_does_not_sort_the_rows(spark, capsys):
    centres = spark.createDataFrame([("C1", "x"), ("C1", "y"), (None, "z")], "pchc string, name string")
    found = LookupAudit().lookup(facts(spark, "a"), centres, ["pchc"], "centre")
    found.explain()
    assert "ShuffledHashJoin" in capsys.readouterr().out
    per_centre = {r["pchc"]: r["n"] for r in found.groupBy("pchc").agg(F.count("name").alias("n")).collect()}
    rows_of = {r["pchc"]: r["n"] for r in facts(spark, "a").groupBy("pchc").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert per_centre == {c: n * {"C1": 2, None: 1}.get(c, 0) for c, n in rows_of.items()}


def test_lines_do_not_move_to_meet_their_blocks(spark, tmp_path, capsys):
    (tmp_path / "a.csv").write_text("k,v\n1,x\n\n2,y\n")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = ingest(spark, [f"{tmp_path}/a.csv"], StructType().add("k", "long").add("v", "string")).rows
        found.explain()
        assert [tuple(r) for r in found.orderBy("_row").collect()] == [(1, "x", 0, 1), (2, "y", 0, 3)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in capsys.readouterr().out


def test_kth_nearest_by_products_is_exact():
    """Large offsets make the products' rounding coarse; ties and copies stay whole."""
    rng = np.random.default_rng(5)
    for offset in (0.0, 1e6):
        donors = rng.integers(0, 4, (300, 6)).astype(float) + offset
        vectors = np.vstack([rng.integers(0, 4, (50, 6)).astype(float) + offset, donors[:20]])
        gaps = np.sqrt(((vectors[:, None, :] - donors[None, :, :]) ** 2).sum(axis=2))
        for k in (1, 3, 400):
            least = np.sort(gaps, axis=1)[:, min(k, 300) - 1]
            for lo, row, column, distance in _within_kth(vectors, donors, k):
                assert np.array_equal(distance, gaps[lo + row, column])
                for r in range(len(vectors) - lo):
                    assert set(column[row == r]) >= set(np.flatnonzero(gaps[lo + r] <= least[lo + r]))


def test_cells_are_packed_into_bins(spark):
    """64 cells of 10 donors are about 640 / 100 bins, so a target that asks for all cells is sent 7 times, not 64 times."""
    pivots, counts = np.arange(64, dtype=float)[:, None], np.full(64, 10)
    bins = [r["b"] for r in spark.range(64).select(_bins(pivots, counts, 100)(F.col("id").cast("int")).alias("b")).collect()]
    assert sorted(set(bins)) == list(range(7)) and max(bins.count(b) for b in set(bins)) == 10


def test_repeated_join_multiplies_after_dealing(spark, rows, monkeypatch):
    monkeypatch.setattr(relational, "REPEATS", 4)
    left = spark.createDataFrame([(i, ["a", "b", None, "d"][i % 4], i % 3 or None) for i in range(40)], "id int, k string, x int")
    right = spark.createDataFrame([("a", 1, "M")] * 11 + [("a", 1, None)] * 3 + [(None, 2, "N")] * 5 + [("b", None, "M"), ("z", 1, "M")], "r string, x int, m string")
    on = [("k", "r"), "x"]
    plain, dealt = relational.na_join(left, right, on), relational.na_join_repeated(left, right, on, 7)
    assert dealt.columns == plain.columns and rows(dealt) == rows(plain) and plain.count() > 50
    assert dealt.rdd.getNumPartitions() == 7
    # one hot key: every part gets rows to multiply
    hot = relational.na_join_repeated(spark.range(70).select(F.lit("a").alias("k"), F.lit(1).alias("x")), right, on, 7)
    assert len({r[0] for r in hot.select(F.spark_partition_id()).distinct().collect()}) == 7
    assert relational.na_join_repeated(left.limit(0), right, on, 3).count() == 0
