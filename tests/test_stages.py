"""Published tables, stages that are kept, audits and restatements."""

import importlib

import pytest
from pyspark.sql import functions as F

from panelproj.catalog.fixtures import Fixtures
from panelproj.catalog.run_queries import delivery_run
from panelproj.operators.audit import LookupAudit, cross_source_duplicates, restatement_report
from panelproj.operators.periods import moving_annual_series, quarter_index
from panelproj.plans import StageStore, files_version
from panelproj.sources.manifest import Manifest

whole = importlib.import_module("panelproj.plans.whole_run")
steps = importlib.import_module("panelproj.plans.delivery_run")


def test_a_reader_keeps_its_version(spark, tmp_path, rows):
    published = Manifest(spark, str(tmp_path))
    assert published.newest("t") is None
    published.publish(spark.range(3), "t", "one")
    reader = published.open(Manifest(spark, str(tmp_path)).newest("t"))
    published.publish(spark.range(5).withColumn("x", F.lit("a")), "t", "two", partition_by=["x"])
    assert reader.count() == 3 and reader.columns == ["id"]
    fresh = Manifest(spark, str(tmp_path))
    assert fresh.open(fresh.newest("t")).count() == 5
    assert fresh.newest("t", "one")["n_rows"] == 3 and fresh.newest("t")["number"] == 2


def test_what_is_not_named_is_not_there(spark, tmp_path):
    """Files of a run that was lost between writing and naming count for nothing."""
    spark.range(3).write.parquet(str(tmp_path / "t" / "half"))
    assert Manifest(spark, str(tmp_path)).newest("t") is None


def test_a_rerun_starts_at_the_first_unfinished_stage(spark, tmp_path):
    def run(fail_at=None, factor=2):
        store = StageStore(spark, str(tmp_path))
        store.source("input", "v1")
        frame = None
        for i, name in enumerate(["a", "b", "c", "d"]):
            if name == fail_at:
                raise RuntimeError("executor lost")
            before = frame

            def build(i=i, before=before):
                return spark.range(4) if before is None else before.withColumn("id", F.col("id") * factor)

            frame = store.stage(name, build, ["input" if i == 0 else "abcd"[i - 1]], factor if i > 1 else None)
        return store.built, [r["id"] for r in frame.orderBy("id").collect()]

    with pytest.raises(RuntimeError):
        run(fail_at="c")
    assert run() == (["c", "d"], [0, 8, 16, 24])
    assert run() == ([], [0, 8, 16, 24])
    # another parameter from the third stage on
    assert run(factor=3)[0] == ["c", "d"]


def test_versions_of_files(spark, tmp_path):
    one = tmp_path / "x" / "f.csv"
    one.parent.mkdir()
    one.write_text("a")
    before = files_version(spark, str(tmp_path / "x"))
    assert files_version(spark, str(tmp_path / "x")) == before
    (tmp_path / "x" / "g.csv").write_text("b")
    assert files_version(spark, str(tmp_path / "x")) != before


def test_the_whole_run_survives_a_stop(spark, monkeypatch, rows):
    """Stopped while it formats the quarter; the second run builds that stage and those after it, and every report."""
    stores, asked = [], {}

    def kept_store(spark, root):
        asked.setdefault("root", root)
        stores.append(StageStore(spark, asked["root"]))
        return stores[-1]

    class Stop(Exception):
        pass

    def stopped(*_, **__):
        raise Stop

    real = whole.run_delivery
    arguments = {}

    def remembered(inputs, params, store, after):
        arguments.update(inputs=inputs, params=params, after=after)
        return real(inputs, params, store, after)

    monkeypatch.setattr("panelproj.catalog.run_queries.StageStore", kept_store)
    monkeypatch.setattr(whole, "run_delivery", remembered)
    with monkeypatch.context() as patch:
        patch.setattr(steps, "format_delivery", stopped)
        with pytest.raises(Stop):
            delivery_run(Fixtures(spark, "/root/testdata/sf0.001"))
    done = stores[0].built
    assert done[:6] == ["raw-first", "problems-first", "facts-first", "raw-second", "problems-second", "facts-second"]
    assert done[6:] == ["panel", "sample", "priced", "quarter"]  # the last one was begun
    again = StageStore(spark, asked["root"])
    for name in ("lookups", *(n for n in arguments["after"] if n != "lookups")):
        again.source(name, stores[0]._keys[name])
    delivery = real(arguments["inputs"], arguments["params"], again, arguments["after"])
    assert again.built == ["quarter", "current", "delivery"]
    assert {r[0] for r in delivery.select("period_type").distinct().collect()} == {"QTR", "MAT"}


def test_audit_counts_without_a_job_of_its_own(spark, rows):
    left = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4), ("z", 5)], "k string, v int")
    right = spark.createDataFrame([("a", "x"), ("a", "y"), ("a", "z"), ("b", "w"), (None, "n"), (None, "m")], "k string, t string")
    audit = LookupAudit()
    joined = audit.lookup(left, right, ["k"], "names")
    inner = audit.lookup(joined, spark.createDataFrame([("x", 1)], "t string, w int"), ["t"], "weights", keep_unmatched=False)
    assert rows(inner, "k", "v", "t", "w") == [("a", 1, "x", 1), ("a", 2, "x", 1)]
    assert rows(audit.report(spark)) == [("names", 5, 10, 1, 3), ("weights", 10, 10, 8, 0)]


def test_audit_of_an_empty_frame(spark, rows):
    audit = LookupAudit()
    left = spark.createDataFrame([("a", 1)], "k string, v int").filter("rand() > 2")
    audit.lookup(left, spark.createDataFrame([("a", "x")], "k string, t string"), ["k"], "names").collect()
    assert rows(audit.report(spark)) == [("names", 0, 0, 0, 0)]


def test_bag_intersection(spark, rows):
    one = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "k string")
    two = spark.createDataFrame([("a",), ("c",), ("c",), (None,)], "k string")
    three = spark.createDataFrame([("a",), ("a",), ("a",)], "k string")
    assert rows(cross_source_duplicates([one, two, three], ["k"])) == [(None, 1, 1, 0, 1), ("a", 2, 1, 3, 3)]
    assert cross_source_duplicates([one], ["k"]).isEmpty()


def test_restatements(spark, rows):
    schema = "k string, v double"
    old = spark.createDataFrame([("same", 1.0), ("more", 1.0), ("gone", 2.0), (None, 1.0), ("twice", 1.0), ("null", None)], schema)
    new = spark.createDataFrame([("same", 1.0), ("more", 1.5), ("new", 3.0), (None, 1.0), ("twice", 0.5), ("twice", 0.5), ("null", None)], schema)
    got = rows(restatement_report(old, new, ["k"], ["v"]), "k", "status", "rows_before", "rows_after", "v_before", "v_after")
    assert got == [("gone", "gone", 1, 0, 2.0, None), ("more", "changed", 1, 1, 1.0, 1.5), ("new", "added", 0, 1, None, 3.0), ("twice", "changed", 1, 2, 1.0, 1.0)]
    assert restatement_report(old, old, ["k"], ["v"]).isEmpty()


def test_series_over_gaps(spark, rows):
    data = [("a", "2020Q1", 1.0), ("a", "2020Q2", 2.0), ("a", "2021Q1", 4.0), ("a", "2021Q1", 4.0), ("b", "2021Q2", 7.0), ("a", "bad", 100.0), (None, "2020Q4", 5.0)]
    history = spark.createDataFrame([("QTR", *d) for d in data] + [("MAT", "a", "2020Q1", 99.0)], "period_type string, k string, date string, v double")
    got = rows(moving_annual_series(history, ["k"], ["v"]), "k", "date", "n_quarters", "v", "v_growth")
    assert got == [
        (None, "2020Q4", 1, 5.0, None), (None, "2021Q1", 1, 5.0, None), (None, "2021Q2", 1, 5.0, None),
        ("a", "2020Q1", 1, 1.0, None), ("a", "2020Q2", 2, 3.0, None), ("a", "2020Q3", 2, 3.0, None), ("a", "2020Q4", 2, 3.0, None),
        ("a", "2021Q1", 2, 10.0, 10.0), ("a", "2021Q2", 1, 8.0, 2.666667), ("b", "2021Q2", 1, 7.0, None),
    ]
    odd = spark.createDataFrame([("2020Q5",), (None,), ("20203",)], "date string")
    assert odd.select(quarter_index()).distinct().collect() == [(None,)]
