"""Line dedup, decontamination, mixing and the pipeline."""

import hashlib
from collections import defaultdict

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from panelproj.llm import line_dedup as line_dedup_module
from panelproj.llm import mixing
from panelproj.llm.decontaminate import clean_documents, contamination
from panelproj.llm.line_dedup import frequencies, line_dedup, more_parities, shingles, without_repeated_lines
from panelproj.llm.shared import with_membership, written

DATA = "/root/testdata/sf0.001"


def tokens(line):
    w = line.split()
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)])


def check_lines(rows, texts, similarity=0.8):
    """Kept lines are the first of equal ones, no two of them match, and every other line matches an earlier one."""
    lines = []
    for i, before, after in sorted((i, t or "", texts[i] or "") for i, t, _ in rows):
        left = after.split("\n") if after or not before.strip() else []
        for n, line in enumerate(before.split("\n")):
            keep = bool(left) and left[0] == line
            if keep:
                left.pop(0)
            if line.split():
                lines.append(((i, n), tokens(line), keep))
        assert not left or left == [""]
    index = defaultdict(list)
    for at, (_, t, keep) in enumerate(lines):
        count = defaultdict(int)
        for token in t:
            for other in index[token]:
                count[other] += 1
            index[token].append(at)
        match = [o for o, c in count.items() if c >= similarity * (len(t) + len(lines[o][1]) - c) - 1e-9]
        if keep:
            assert not any(lines[o][2] for o in match), lines[at][0]
        else:
            assert match, lines[at][0]


@pytest.fixture(scope="module")
def line_rows(words):
    """Equal lines, edited lines, one passage in many lines, short lines, other white space."""
    base, passage = words(60, 1), words(40, 2)
    rows = [(i, "\n".join([" ".join(base[: 5 * (i % 7)] + ["edit"] * (i % 4 > 0) + base[5 * (i % 7) + (i % 4) :]), "licence line", " ".join(words(30, 10 + i))]), "a") for i in range(40)]
    rows += [(100 + i, " ".join(words(12 + i, 300 + i) + passage + words(12 + i, 400 + i)) + "\n\n" + "  licence \t line", "a") for i in range(30)]
    return rows + [(200, "\n \n", "a"), (201, " ".join(base) + "\r\n" + " ".join(base), "a")]


def test_lines(make_docs, line_rows):
    docs = make_docs(line_rows)
    texts = {r["doc_id"]: r["text"] for r in without_repeated_lines(docs).collect()}
    check_lines(line_rows, texts)
    for r in line_dedup(docs).collect():
        assert hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest() == r["kept_sha256"]


def test_lines_whose_earlier_match_goes(make_docs, words):
    """b matches a and goes, c matches only b; their edges are common passages, so the rare tokens of all three are headed by a."""
    core, (h, t, p, g) = words(48, 950), (words(6, 951 + k) for k in range(4))
    rows = [(1, " ".join(h + core + t), "a"), (2, " ".join(h + core + p), "a"), (3, " ".join(g + core + p), "a")]
    edges = [core[-4:] + p, core[-4:] + t, h + core[:4], g + core[:4]]
    rows += [(10 + i, " ".join(words(10 + i % 8, 1000 + i) + [w for k, e in enumerate(edges) for w in e + words(10, 2000 + 10 * i + k)]), "a") for i in range(64)]
    got = {r["doc_id"]: r["text"] for r in without_repeated_lines(make_docs(rows)).collect()}
    assert got == {i: "" if i in (2, 3) else text for i, text, _ in rows}


def test_rarity_counts_every_shingle(spark, words):
    """A passage at the same place in many lines is frequent in all its shingles."""
    passage = " ".join(words(14, 960))
    lines = spark.createDataFrame([(f"only{i} {passage}",) for i in range(20)], "line string")
    places = F.transform(shingles(F.col("line")), lambda t: F.get(frequencies(lines), t.bitwiseAND(65535).cast("int")))
    assert all(r[0][1:] == [8] * 10 for r in lines.select(places).collect())


def test_lines_of_the_example_table(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    rows = [(r["doc_id"], r["text"], None) for r in docs.collect()]
    check_lines(rows, {r["doc_id"]: r["text"] for r in without_repeated_lines(docs).collect()})


def test_odd_lines(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = without_repeated_lines(docs)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows)
    texts = defaultdict(list)
    for r in kept.collect():
        texts[r["doc_id"]].append(r["text"])
    assert texts[1] == [None] and texts[2] == [""] and texts[5] == [""]
    assert texts[13] == ["same line here with six words\n\nanother line"] * 2  # equal rows share a place and keep the same lines
    empty = docs.where("false")
    assert line_dedup(empty).count() == 0 and without_repeated_lines(empty).count() == 0


def test_only_texts_with_candidates_or_lost_lines_move(make_docs, words, monkeypatch):
    """Pairs name the texts that are compared, verdicts those that are rebuilt; all others stay."""
    asked = []

    def spy(rows, ids, flag):
        told = with_membership(rows, ids, flag)
        asked.append(sorted(r["doc_id"] for r in told.where(flag).collect()))
        return told

    monkeypatch.setattr(line_dedup_module, "with_membership", spy)
    near, equal, long = words(60, 970), " ".join(words(30, 971)), words(1700, 972)
    rows = [(i, " ".join(words(25, 5000 + i)), "a") for i in range(30)]
    rows += [(100, " ".join(near), "a"), (101, " ".join(near[:-1] + ["changed"]), "a"), (102, equal, "a"), (103, "first\n" + equal, "a")]
    rows += [(104, " ".join(long), "a"), (105, " ".join(words(150, 973) + long[150:]), "a")]  # shared tokens beyond position 255
    got = {r["doc_id"]: r["text"] for r in without_repeated_lines(make_docs(rows)).collect()}
    assert asked == [[100, 101, 104, 105], [], [101, 103, 105]]
    assert got == {i: {101: "", 103: "first", 105: ""}.get(i, t) for i, t, _ in rows}


def test_large_lines_that_share_a_passage_make_no_pairs(make_docs, words, monkeypatch):
    """A passage of 60 words in lines of 160 does not make them all candidates of each other; a line that does match, but not its group's first, is found."""
    pairs = []

    def spy(df):
        out = written(df)
        if {"x", "y"} <= set(out.columns):
            pairs.append(out.count())
        return out

    monkeypatch.setattr(line_dedup_module, "written", spy)
    passage = words(60, 980)
    lines = [words(50, 6000 + i) + passage + words(50, 7000 + i) for i in range(40)]
    lines.append(lines[20][:-4] + words(4, 981))
    rows = [(i, " ".join(line), "a") for i, line in enumerate(lines)]
    got = {r["doc_id"]: r["n_removed"] for r in line_dedup(make_docs(rows)).collect()}
    assert got == {i: int(i == 40) for i in range(41)}
    assert sum(pairs) <= 45, pairs


def test_parities_differ_in_no_more_bits_than_sets_in_tokens(spark, words):
    line = words(150, 982)
    sets = [line, line[:-6] + words(6, 983), line[75:] + line[:75], words(150, 984)]
    df = spark.createDataFrame([(" ".join(s),) for s in sets], "line string").select(shingles(F.col("line")).alias("t"))
    found = [(set(r["t"]), r["more"]) for r in df.select("t", more_parities(F.col("t")).alias("more")).collect()]
    bits = [sum(((x ^ y) & (2**64 - 1)).bit_count() for x, y in zip(found[0][1], more, strict=True)) for _, more in found]
    assert all(b <= len(found[0][0] ^ t) for b, (t, _) in zip(bits, found, strict=True))
    assert bits[0] == 0 and bits[1] > 0 and bits[3] > 100


ITEM = "If Anna has 12 apples and Bob gives Anna 5 more apples how many apples does she have after 3 days?"


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, ITEM), (2, "Short one"), (3, None), (4, ""), (5, "these words make a window")]
    return spark.createDataFrame(rows, "item_id long, text string")


def test_contamination(make_docs, items, odd_rows):
    rows = [
        (1, f"Before. {ITEM} After it.", "a"), (2, "If Carl has 7 apples and Dora gives Carl 9 more apples how many apples does she have after 4 days?", "a"),
        (3, "If Carl has 7 apples and Carl gives Dora 9 more apples how many apples does she have after 4 days?", "a"), (4, "How many apples does she have after all?", "a"),
        (5, "well these words make a window here", "a"), (6, "a short one", "a"), (7, ITEM.lower() + "\n" + ITEM, "a"), (7, ITEM.lower() + "\n" + ITEM, "a"), (None, ITEM, "a"), (None, "clean", "a"),
    ]
    docs = make_docs([*rows, *[(1000 + k, t, s) for k, (_, t, s) in enumerate(odd_rows)]])
    got = sorted({(str(r["doc_id"]), r["item_id"]) for r in contamination(docs, items).where("contaminated").collect()})
    assert got == [("1", 1), ("2", 1), ("5", 5), ("7", 1), ("None", 1)]
    clean = clean_documents(docs, items)
    assert clean.columns == docs.columns and clean.count() == docs.count() - 6
    by_shuffle = contamination(docs, items, most_broadcast=0)
    assert sorted({(str(r["doc_id"]), r["item_id"]) for r in by_shuffle.where("contaminated").collect()}) == got


def test_copies_in_another_case_and_in_mid_sentence(make_docs, spark):
    """Verbatim words match whatever their context or case makes of the template."""
    river = "Which river runs through the city of Rome"
    benchmark = spark.createDataFrame([(1, ITEM), (2, river)], "item_id long, text string")
    rows = [(1, f"so {ITEM.lower()} indeed", "a"), (2, ITEM.upper(), "a"), (3, f"now we ask {river} today", "a"), (4, "Now we ask which lake lies near the town of Rome", "a")]
    got = sorted((r["doc_id"], r["item_id"]) for r in contamination(make_docs(rows), benchmark).where("contaminated").collect())
    assert got == [(1, 1), (2, 1), (3, 2)]


def test_passages_of_long_items_and_items_without_literal_words(make_docs, spark, words):
    """A passage counts however long its item is; numbers are searched as they stand."""
    long_, numbers = words(300, 900), "3 14 15 92 65 35 89 79 32 38"
    benchmark = spark.createDataFrame([(1, " ".join(long_)), (2, numbers), (3, "Short one"), (4, "7 11 13")], "item_id long, text string")
    rows = [(1, " ".join(words(30, 901) + long_[100:200]), "a"), (2, " ".join(long_[40:50]), "a"), (3, f"digits {numbers} end", "a"), (4, numbers[:-3], "a"), (5, "a Short one", "a"), (6, "a short one", "a"), (7, "7 11 13", "a")]
    got = sorted((r["doc_id"], r["item_id"]) for r in contamination(make_docs(rows), benchmark).where("contaminated").collect())
    assert got == [(1, 1), (3, 2), (5, 3), (7, 4)]


def test_contamination_of_empty_tables(make_docs, items):
    docs = make_docs([(1, ITEM, "a")])
    assert contamination(docs, items.where("false")).where("contaminated").count() == 0
    assert contamination(docs.where("false"), items).count() == 0


def test_planted_items_are_found(spark):
    docs, benchmark = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "benchmark"))
    found = {r["doc_id"] for r in contamination(docs, benchmark).where("contaminated").collect()}
    texts = [b["text"] for b in benchmark.collect()]
    planted = {r["doc_id"] for r in docs.collect() if any(t in r["text"] for t in texts)}
    assert planted and planted <= found


def duck(con, docs):
    frame = docs.select("doc_id", "text", "source").toPandas()  # noqa: F841
    con.execute("CREATE OR REPLACE TABLE documents AS SELECT CAST(doc_id AS BIGINT) AS doc_id, CAST(text AS VARCHAR) AS text, CAST(source AS VARCHAR) AS source FROM frame")
    return sorted(con.execute(mixing.ORACLE).fetchall(), key=str)


def test_mix_against_sql(make_docs, words):
    rows = [(i, " ".join(words(i % 97, i)), None if i % 11 == 0 else f"s{i % 7 if i % 3 else 0}") for i in range(400)]
    docs = make_docs([*rows, (400, None, "empty"), (401, "x", "s0"), (401, "x", "s0"), (None, "y z", "s1")])
    got = mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken").collect()
    assert sorted((tuple(r) for r in got), key=str) == duck(duckdb.connect(), docs)


def test_mix_meets_its_targets(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = mixing.mix(docs, shard_docs=16).toPandas()
    assert (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    by_source = got.groupby("source").agg(target=("target", "first"), taken=("taken", "sum"), size=("size", "sum"))
    assert by_source.target.sum() == pytest.approx(1.5 * by_source["size"].sum())
    assert ((by_source.taken - by_source.target).abs() <= 0.02 * by_source.target + 64).all()
    again = mixing.mix(docs.repartition(5), shard_docs=16).toPandas()
    assert sorted(zip(got.doc_id, got.taken)) == sorted(zip(again.doc_id, again.taken))  # noqa: B905


def test_highest_quotients(spark):
    """Against listing all quotients."""
    shares = [(0, k, float(s)) for k, s in enumerate([1000, 10, 333, 0, 250, 250, 7, 1])]
    for seats in (0, 1, 2, 5, 9, 40, 211):
        cells = spark.createDataFrame(shares, "g int, k int, share double")
        got = {r["k"]: r["quota"] for r in mixing.sainte_lague(cells, ["g"], "share", mixing.F.lit(seats), "k").collect()}
        ranked = sorted(((s / (2 * a + 1), -k) for _, k, s in shares for a in range(seats) if s), reverse=True)[:seats]
        assert got == {k: sum(-x == k for _, x in ranked) for _, k, _ in shares}


def test_mix_of_odd_and_empty_tables(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    assert mixing.mix(docs).count() == len(odd_rows) and mixing.mix(docs.where("false")).count() == 0


def test_pipeline(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert len(names) == 5 and "simhash_near_dedup" in names
    rows = corpus_pipeline.run(spark, DATA).collect()
    total = spark.read.parquet(f"{DATA}/documents.parquet").count()
    assert 0 < len(rows) < total and all(r["taken"] <= 2 * r["size"] for r in rows)


def test_pipeline_stages_keep_columns(make_docs, odd_rows, spark):
    docs = make_docs(odd_rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, DATA)
        assert out.columns == docs.columns and out.dtypes == docs.dtypes
        assert stage(spark, docs.where("false"), DATA).count() == 0


def test_stages_one_by_one_against_plain_versions(spark):
    """Each stage's verdicts on its own input, by the tests' plain versions of the operators."""
    from panelproj.llm.shared import written
    from tests.llm.test_simhash import brute_components, brute_fingerprint

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    good = written(stages["quality_rules"](spark, docs, DATA))
    lined = written(stages["line_dedup"](spark, good, DATA))
    check_lines([(r["doc_id"], r["text"], None) for r in good.collect()], {r["doc_id"]: r["text"] for r in lined.collect()})
    rows = sorted((r["doc_id"], r["text"]) for r in lined.collect())
    roots = brute_components([brute_fingerprint(t) for _, t in rows])
    single = written(stages["simhash_near_dedup"](spark, lined, DATA))
    assert sorted(r["doc_id"] for r in single.collect()) == sorted(rows[i][0] for i in set(roots))
