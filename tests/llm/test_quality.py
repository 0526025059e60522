"""Quality rules and the classifier."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from panelproj.llm import quality_classifier, quality_rules

DATA = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    count, repeated = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4)), [0] * len(w)
    for i in range(len(w) - 4):
        if count[tuple(w[i : i + 5])] > 1:
            repeated[i : i + 5] = [1] * 5
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n, r = len(w), sum(repeated)
    return n, sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, r, n < 10 or 100 * r > 20 * n


def test_base_rules(make_docs, spark, odd_rows):
    trusted = spark.createDataFrame([(6,), (8,)], "doc_id long")
    got = quality_rules.quality_rules(make_docs(odd_rows), trusted).collect()
    key = lambda r: str(r)
    assert sorted([tuple(r)[:7] for r in got], key=key) == sorted([(i, *brute(t)) for i, t, _ in odd_rows], key=key)
    assert all(r["kept"] == (not r["base_failed"] and r["score"] >= quality_rules.LEAST_SCORE) for r in got)


def test_scores_are_mean_log_ratios(make_docs, spark, odd_rows):
    """Against a plain count of hashed trigrams."""
    docs, trusted = make_docs(odd_rows), spark.createDataFrame([(6,), (8,)], "doc_id long")
    bucket = lambda g: ((int.from_bytes(g, "big") * quality_rules.textbytes.BASE) % 2**64) >> (64 - quality_rules.BUCKET_BITS)
    grams = lambda t: [bucket((t or "").encode()[i : i + 3]) for i in range(len((t or "").encode()) - 2)]
    raw, target = np.ones(1 << quality_rules.BUCKET_BITS), np.ones(1 << quality_rules.BUCKET_BITS)
    for i, t, _ in odd_rows:
        for g in grams(t):
            raw[g] += 1
            target[g] += i in (6, 8)
    ratio = np.log(target / target.sum()) - np.log(raw / raw.sum())
    got = {r["doc_id"]: r["score"] for r in quality_rules.quality_rules(docs, trusted).collect()}
    for i, t, _ in odd_rows:
        assert got[i] == pytest.approx(np.mean([ratio[g] for g in grams(t)]) if grams(t) else 0.0, abs=1e-5) or i is None


def test_without_trusted_text_only_base_rules(make_docs, spark, odd_rows):
    got = quality_rules.quality_rules(make_docs(odd_rows), spark.createDataFrame([], "doc_id long")).collect()
    assert all(r["kept"] == (not r["base_failed"]) and r["score"] == 0 for r in got)


def test_good_documents_keep_all_columns(make_docs, spark, odd_rows):
    docs, trusted = make_docs(odd_rows), spark.createDataFrame([(6,), (8,)], "doc_id long")
    verdict = sorted(str((r["doc_id"])) for r in quality_rules.quality_rules(docs, trusted).where("kept").collect())
    good = quality_rules.good_documents(docs, trusted)
    assert good.columns == docs.columns and sorted(str(r["doc_id"]) for r in good.collect()) == verdict


def test_trusted_ids_are_bounded_and_agreed(spark):
    labels = spark.createDataFrame([(i, 1) for i in range(50)] + [(3, 0), (None, 1)], "doc_id long, quality int")
    got = [r[0] for r in quality_rules.trusted_ids(labels, 20).collect()]
    assert len(got) == 20 and 3 not in got and None not in got


def test_all_trusted_ids_count_and_the_table_grows(spark):
    labels = spark.range(20_100).selectExpr("id AS doc_id", "1 AS quality")
    assert quality_rules.trusted_ids(labels).count() == 20_100
    assert [quality_rules.table_bits(b) for b in (0, 1 << 20, 1 << 34, 1 << 60)] == [14, 14, 18, 24]


def test_empty_tables(make_docs, spark):
    empty, labels = make_docs([(1, "x", "a")]).where("false"), spark.createDataFrame([], "doc_id long, quality int")
    assert quality_rules.quality_rules(empty, quality_rules.trusted_ids(labels)).count() == 0
    assert quality_classifier.quality_scores(empty, labels).count() == 0


def test_rules_reject_junk_and_keep_clean(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_rules.quality_rules(docs, quality_rules.trusted_ids(labels)).join(labels, "doc_id").toPandas()
    assert got[got.quality == 0].kept.mean() < 0.02
    assert got[(got.quality == 1) & ~got.base_failed].kept.mean() > 0.99


def test_classifier_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    got = quality_classifier.quality_scores(docs, labels).join(labels, "doc_id").toPandas()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert held[held.quality == 1].predicted.mean() > 0.9 and held[held.quality == 0].predicted.mean() < 0.1
    assert got.score.between(0, 1).all()


def test_classifier_ignores_held_out_and_negative_labels(spark):
    """Only trusted positives of the training fold are used: other labels may say anything."""
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    plain = quality_classifier.quality_scores(docs, labels)
    held = quality_classifier.held_out()
    fewer = quality_classifier.quality_scores(docs, labels.where((labels.quality == 1) & ~held))
    assert [tuple(r) for r in plain.orderBy("doc_id").collect()] == [tuple(r) for r in fewer.orderBy("doc_id").collect()]


def test_classifier_scores_every_row(make_docs, spark, odd_rows):
    labels = spark.createDataFrame([(6, 1), (8, 1), (9, 1), (9, 0)], "doc_id long, quality int")
    got = quality_classifier.quality_scores(make_docs(odd_rows), labels).collect()
    assert len(got) == len(odd_rows) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in got)
    none = quality_classifier.quality_scores(make_docs(odd_rows), labels.where("false")).collect()
    assert {r["score"] for r in none} == {0.5}


def test_risk_stays_non_negative_and_finds_the_prior():
    rng = np.random.default_rng(0)
    positive = np.c_[rng.normal(2, 1, (500, 1)), np.ones(500)]
    unlabelled = np.c_[np.r_[rng.normal(2, 1, (700, 1)), rng.normal(-2, 1, (300, 1))], np.ones(1000)]
    w = quality_classifier.fit(positive, unlabelled, 0.7)
    assert ((unlabelled @ w > 0) == (np.arange(1000) < 700)).mean() > 0.95


@pytest.mark.parametrize("most_bytes", [64_000_000, 0])
def test_membership_without_moving_rows(spark, most_bytes):
    """Both ways give the same answer, for negative, large, repeated and missing ids."""
    from panelproj.llm.shared import with_membership

    ids = [0, 1, 2, 7, 8, 32767, 32768, 32769, -1, -2, -32768, -40000, 2**40, 2**62, 5, 5, None]
    asked = [*range(-12, 20), *range(32760, 32775), -32767, -32768, -32769, -40000, -39999, 2**40, 2**40 + 1, 2**62, 2**62 - 1, None]
    rows = spark.createDataFrame([(i, "a", "b") for i in asked], "doc_id long, id_bucket string, id_bits string").repartition(3)
    got = with_membership(rows, spark.createDataFrame([(i,) for i in ids], "doc_id long"), "found", most_bytes)
    assert got.columns == [*rows.columns, "found"]
    assert sorted((r["doc_id"], r["found"]) for r in got.collect() if r["doc_id"] is not None) == sorted((i, i in ids) for i in asked if i is not None)
    assert [r["found"] for r in got.collect() if r["doc_id"] is None] == [False]
