"""Exports by line position, lines that do not fit, first and last by position."""

import random

import pytest
from pyspark.sql.types import StructType

from panelproj.operators.dims import product_master, registered_centres
from panelproj.operators.position import by_position, fill_by_position, with_position
from panelproj.operators.standardize import combine_panels, raw_transactions
from panelproj.sources import ingest, read_raw_csv

SCHEMA = StructType().add("province", "string").add("value", "double").add("n", "integer")
HEADING = "province,value,n\n"


def export(path, lines, charset="utf-8", heading=HEADING):
    path.parent.mkdir(exist_ok=True)
    path.write_bytes((heading + "".join(line + "\n" for line in lines)).encode(charset))
    return str(path)


@pytest.mark.parametrize("block", ["128m", "64"])
@pytest.mark.parametrize("charset", ["GB18030", "UTF-8"])
def test_rows_are_numbered_as_they_stand(spark, tmp_path, rows, block, charset):
    """Also in files that are read in many blocks, in folders, and with the second path first in the alphabet."""
    first = [f"北京{i},{i}.5,{i}" for i in range(40)]
    export(tmp_path / "z" / "b.csv", first[:15], charset)
    export(tmp_path / "z" / "c.csv", first[15:], charset)
    second = export(tmp_path / "a.csv", [f"福建,{i},{i}" for i in range(7)], charset)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", block)
    try:
        got = ingest(spark, [str(tmp_path / "z"), second], SCHEMA, charset=charset)
        # lines of the source count through its files, headings too
        want = [(0, i + 1 + (i >= 15), f"北京{i}", i + 0.5, i) for i in range(40)] + [(1, i + 1, "福建", float(i), i) for i in range(7)]
        assert rows(got.rows, "_src", "_row", "province", "value", "n") == want
        assert got.rejected.isEmpty() and got.problems.isEmpty()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_the_session_keeps_its_settings(spark, tmp_path):
    spark.conf.unset("spark.sql.legacy.javaCharsets")
    before = spark.conf.get("spark.sql.legacy.javaCharsets")
    ingest(spark, [export(tmp_path / "x.csv", ["北京,1,1"], "GB18030")], SCHEMA, charset="GB18030").rows.collect()
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == before


def test_problems_name_line_column_and_text(spark, tmp_path, rows):
    path = tmp_path / "faulty.csv"
    lines = ["北京,1,1", "福建,one,2", "上海,2", "", "浙江,2,x,", '"open,3,3', "江苏,,4", "山东,1e3,4.5", '"a ""b"", c",1,7', ",5,5"]
    export(path, lines)
    path.write_bytes(path.read_bytes() + b"\xff\xfe,1,1\n")
    got = ingest(spark, [str(path)], SCHEMA, required=["province"])
    assert rows(got.rows, "_row", "province", "value", "n") == [(1, "北京", 1.0, 1), (7, "江苏", None, 4), (9, 'a "b", c', 1.0, 7)]
    assert rows(got.problems, "line", "column", "text", "reason") == rows(
        spark.createDataFrame(
            [(3, "value", "one", "type"), (4, None, None, "cells"), (6, None, None, "cells"), (7, None, None, "cells"), (9, "n", "4.5", "type"), (11, "province", None, "missing"), (12, None, None, "encoding")],
            "line long, column string, text string, reason string",
        )
    )
    assert rows(got.rejected, "line") == [(k,) for k in (3, 4, 6, 7, 9, 11, 12)]
    # good and bad lines are all lines but the heading and the blank one
    assert got.rows.count() + got.rejected.count() == len(lines) - 1 + 1


def test_a_wrong_heading_rejects_its_file(spark, tmp_path, rows):
    good = export(tmp_path / "good.csv", ["a,1,1"])
    swapped = export(tmp_path / "swapped.csv", ["1,a,1", "2,b,2"], heading="value,province,n\n")
    got = ingest(spark, [swapped, good], SCHEMA)
    assert rows(got.rows, "province") == [("a",)]
    assert rows(got.rejected, "line", "text") == [(2, "1,a,1"), (3, "2,b,2")]
    assert rows(got.problems, "line", "text", "reason") == [(1, "value,province,n", "heading")]


def test_leading_lines_and_empty_files(spark, tmp_path, rows):
    path = export(tmp_path / "sheet.csv", ["a,1,1"], heading="Report\nmade by us\n" + HEADING)
    empty = tmp_path / "empty.csv"
    empty.write_bytes(b"")
    got = ingest(spark, [str(empty), path], SCHEMA, skip_lines=2)
    assert rows(got.rows, "_src", "_row", "province") == [(1, 3, "a")]
    assert got.problems.isEmpty()


def test_raw_export_with_a_fault_is_an_error(spark, tmp_path):
    with pytest.raises(ValueError, match="line 3, column n: 'x'"):
        read_raw_csv(spark, export(tmp_path / "x.csv", ["a,1,1", "b,1,x"], "GB18030"), SCHEMA)


def test_first_and_last_by_position(spark, rows):
    """Against plain loops over shuffled rows with missing keys and values; swapped sources swap the answers."""
    rng = random.Random(5)
    data = [(s, i, rng.choice(["k1", "k2", None]), rng.choice(["a", "b", None]), rng.choice([1, 2, None])) for s in (0, 1) for i in range(30)]

    def answer(some):
        out = []
        for key in ("k1", "k2", None):
            mine = sorted(r for r in some if r[2] == key)
            known = [r[3] for r in mine if r[3] is not None]
            numbers = [r[4] for r in mine if r[4] is not None]
            out.append((key, mine[0][3], numbers[-1]) if known else (key, None, numbers[-1]))
        return out

    def asked(some):
        rng.shuffle(some)
        df = with_position(spark.createDataFrame([(s, i, k, t, n) for s, i, k, t, n in some], "_src int, _row long, k string, t string, n int").repartition(5))
        return rows(by_position(df, ["k"], first=["t"], last_known_of=["n"]))

    swapped = [(1 - s, i, k, t, n) for s, i, k, t, n in data]
    assert asked(list(data)) == sorted(answer(data), key=lambda r: (r[0] is not None, r[0] or ""))
    assert asked(list(swapped)) == sorted(answer(swapped), key=lambda r: (r[0] is not None, r[0] or ""))


def test_fill_by_position(spark, rows):
    df = spark.createDataFrame([(3, "k", "x", 1), (1, "k", None, 2), (2, "k", "y", 3), (9, None, "z", 4)], "_pos long, k string, t string, v int")
    assert rows(fill_by_position(df, ["k"], first_known_of=["t"]), "k", "t", "v") == [(None, "z", 4), ("k", "y", 1), ("k", "y", 2), ("k", "y", 3)]


def test_facts_keep_their_position(spark, rows):
    """The first one of identical transactions counts, and a centre's place is that of its first line, not of its first month."""
    raw = spark.createDataFrame(
        [(5, "2020/01", "v"), (2, "2020/03", "w"), (9, "2020/03", "w")], "_pos long, month string, hospital_name string"
    ).selectExpr("_pos", "2020 AS year", "'2020Q1' AS quarter", "month", "'p' AS province", "'c' AS city", "'d' AS county", "hospital_name", "'C09A1' AS atc4_code", "'m' AS molecule_desc", "'1' AS packcode", "1.0D AS volume", "1.0D AS price", "1.0D AS value")
    assert rows(raw_transactions(raw), "_pos", "date") == [(2, "202003"), (5, "202001")]
    facts = "year string, date string, quarter string, province string, city string, district string, pchc string, market string, packid string, units double, sales double, _pos long"
    first = spark.createDataFrame([("2020", "202001", "2020Q1", "P", "late", None, "c1", "m", "7", 1.0, 1.0, 8), ("2020", "202003", "2020Q1", "P", "early", None, "c1", "m", "7", 1.0, 1.0, 3)], facts)
    second = spark.createDataFrame([("2020", "202002", "2020Q1", "Q", "other", "d", "c1", "m", "7", 1.0, 1.0, 1)], facts)
    got = rows(combine_panels(first, second), "date", "province", "city", "district", "sales")
    assert got == [("202001", "P", "early", "d", 1.0), ("202002", "P", "early", "d", 1.0), ("202003", "P", "early", "d", 1.0)]
    got = rows(combine_panels(second, first), "date", "province", "city", "district")
    assert {r[1:] for r in got} == {("Q", "other", "d")}


def test_lookups_choose_by_line(spark, rows):
    """Centres and packs take their first line's values, and equal rows count at their first line."""
    registry = spark.createDataFrame(
        [("甲省", "乙市", "z", "c1", 2.0, 1), ("甲省", "乙市", "a", "c1", 3.0, 2), ("甲省", "乙市", "z", "c1", 2.0, 9), ("甲省", "乙市", None, "c2", 1.0, 4), ("甲省", "丙市", "d", "c2", 1.0, 5)],
        "province string, city string, district string, pchc string, est double, _pos long",
    )
    assert rows(registered_centres(registry)) == [("c1", "甲", "乙", "z", 5.0), ("c2", "甲", "乙", "d", 2.0)]
    assert rows(registered_centres(registry.drop("_pos")), "pchc", "district") == [("c1", "a"), ("c2", "d")]
    first = spark.createDataFrame([("p1", "zeta", None, 1), ("p1", "alpha", "x", 2)], "packid string, corp string, atc3 string, _pos long")
    second = spark.createDataFrame([("p1", "early", "y", 0)], "packid string, corp string, atc3 string, _pos long")
    corporations = spark.createDataFrame([("zeta", "泽")], "name string, namec string")
    names = spark.createDataFrame([], "packid string, product_cn string, route string")
    assert rows(product_master([first, second], corporations, names), "corp", "corp_cn", "atc3") == [("zeta", "泽", "x")]
    assert rows(product_master([first.drop("_pos"), second], corporations, names), "corp", "atc3") == [("alpha", "x")]
