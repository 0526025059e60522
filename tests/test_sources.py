import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from panelproj.operators.reshape import densify, pivot_longer_split, pivot_wider
from panelproj.sources import checkpoint_dir, materialize, read_parts, read_raw_csv, read_sheet, write_history, write_report


def test_materialize_writes_to_the_named_folder(spark):
    folder = spark.conf.get("spark.checkpoint.dir")
    assert checkpoint_dir(spark) == folder
    df = materialize(spark.range(3).withColumn("x", F.lit("a")), "probe")
    assert df.count() == 3 and any(f.startswith("probe-") for f in os.listdir(folder))


def test_gb18030_round_trip(spark, tmp_path, rows):
    schema = StructType().add("province", "string").add("value", "double").add("packcode", "string")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    spark.createDataFrame([("北京市", 1.5, "00123"), ("福建省", None, None)], schema).write.csv(
        str(tmp_path / "raw"), header=True, encoding="GB18030"
    )
    raw = b"".join(p.read_bytes() for p in (tmp_path / "raw").glob("*.csv"))
    assert "北京市".encode("gb18030") in raw
    got = read_raw_csv(spark, str(tmp_path / "raw"), schema)
    assert rows(got) == [("北京市", 1.5, "00123"), ("福建省", None, None)]


def test_sheet_with_leading_lines(spark, tmp_path, rows):
    path = tmp_path / "sheet.csv"
    path.write_text("Report\nmade by us\na,b,c\n1,x,9\n2,,8\n")
    schema = StructType().add("a", "integer").add("b", "string").add("c", "integer")
    got = read_sheet(spark, str(path), schema, first_columns=2, skip_lines=2)
    assert rows(got) == [(1, "x"), (2, None)]


def test_sheet_rows_that_look_like_leading_lines_stay(spark, tmp_path, rows):
    folder = tmp_path / "sheets"
    folder.mkdir()
    for name in ("one", "two"):
        (folder / f"{name}.csv").write_text(f"Report\na,b\na,1\nReport,2\n{name},3\n")
    schema = StructType().add("a", "string").add("b", "integer")
    got = read_sheet(spark, str(folder), schema, skip_lines=1)
    assert rows(got) == [("Report", 2), ("Report", 2), ("a", 1), ("a", 1), ("one", 3), ("two", 3)]


def test_sheet_with_wrong_numbers(spark, tmp_path, rows):
    path = tmp_path / "sheet.csv"
    path.write_text("a\n1\nx\n")
    schema = StructType().add("a", "integer")
    with pytest.raises(Exception, match="cannot hold x"):
        read_sheet(spark, str(path), schema).collect()
    assert rows(read_sheet(spark, str(path), schema, strict=False)) == [(None,), (1,)]


def test_parts_keep_their_ordinal(spark, tmp_path, rows):
    paths = []
    for i, name in enumerate(["b", "a", "c"]):
        spark.createDataFrame([(i,)], "v int").write.parquet(str(tmp_path / name))
        paths.append(str(tmp_path / name))
    assert rows(read_parts(spark, paths), "sheet", "v") == [(1, 0), (2, 1), (3, 2)]


def test_parts_may_be_files_and_have_spaces(spark, tmp_path, rows):
    spark.createDataFrame([(7,)], "v int").coalesce(1).write.parquet(str(tmp_path / "a part"))
    spark.createDataFrame([(8,)], "v int").coalesce(1).write.parquet(str(tmp_path / "b"))
    single = next((tmp_path / "b").glob("part-*.parquet"))
    assert rows(read_parts(spark, [str(single), str(tmp_path / "a part") + "/"]), "sheet", "v") == [(1, 8), (2, 7)]


def test_history_replaces_only_its_periods(spark, tmp_path, rows):
    path = str(tmp_path / "history")
    write_history(spark.createDataFrame([(1, "2020Q3"), (2, "2020Q4")], "v int, date string"), path)
    write_history(spark.createDataFrame([(9, "2020Q4")], "v int, date string"), path)
    assert rows(spark.read.parquet(path), "v", "date") == [(1, "2020Q3"), (9, "2020Q4")]


@pytest.mark.parametrize("fmt", ["parquet", "csv"])
def test_report(spark, tmp_path, fmt):
    path = str(tmp_path / fmt)
    write_report(spark.createDataFrame([(2, "a"), (1, "a"), (None, "a"), (3, "b"), (4, "b")], "v int, k string").repartition(4), path, ["-k", "v"], fmt)
    files = sorted(os.path.join(path, f) for f in os.listdir(path) if f.startswith("part-"))
    back = [r for f in files for r in (spark.read.csv(f, header=True) if fmt == "csv" else spark.read.parquet(f)).collect()]
    assert [(r.k, None if r.v is None else int(r.v)) for r in back] == [("b", 3), ("b", 4), ("a", 1), ("a", 2), ("a", None)]


def test_reshape(spark, rows):
    long = spark.createDataFrame([("a", "202010", 1.0, 2.0), ("a", "202011", 3.0, 4.0), ("b", "202010", 5.0, 6.0)], "k string, date string, sales double, units double")
    wide = pivot_wider(long, ["k"], "date", ["sales", "units"])
    assert wide.columns == ["k", "sales_202010", "units_202010", "sales_202011", "units_202011"]
    back = pivot_longer_split(wide, ["k"], wide.columns[1:], ("index", "date"), "value")
    assert back.count() == 8 and back.filter("value IS NULL").count() == 2
    assert pivot_wider(long, ["k"], "date", ["sales"], fill=0.0).columns == ["k", "202010", "202011"]
    assert rows(densify(long, ["k"], "date", ["sales"]), "k", "date", "sales") == [
        ("a", "202010", 1.0), ("a", "202011", 3.0), ("b", "202010", 5.0), ("b", "202011", None)
    ]


def test_wide_frames_lose_nothing(spark):
    double = spark.createDataFrame([("a", "x", 1.0), ("a", "x", 5.0)], "k string, n string, v double")
    with pytest.raises(Exception, match="several rows for one cell of x"):
        pivot_wider(double, ["k"], "n", ["v"]).collect()
    unlisted = spark.createDataFrame([("a", "x", 1.0), ("a", "z", 7.0)], "k string, n string, v double")
    with pytest.raises(Exception, match="outside the given members: z"):
        pivot_wider(unlisted, ["k"], "n", ["v"], members=["x", "y"]).collect()


def test_a_missing_period_is_a_period(spark, rows):
    facts = spark.createDataFrame([("a", "202010", 1.0), ("b", None, 2.0)], "k string, date string, sales double")
    assert rows(densify(facts, ["k"], "date", ["sales"]), "k", "date", "sales") == [
        ("a", None, None), ("a", "202010", 1.0), ("b", None, 2.0), ("b", "202010", None)
    ]
