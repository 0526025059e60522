"""Spelling variants, the LSH forest and ranked search against plain versions."""

import random

import brute
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from panelproj.llm import lsh_forest, ranked_search, spelling

VARIANT = "word string, n long"


def plain(row):
    return (row["form"], row["root"], row["n"], row["n_near"], row["form_n"])


def variants_of(spark, n, **parameters):
    words = spark.createDataFrame(list(n.items()), VARIANT).repartition(3)
    return {r["word"]: plain(r) for r in spelling.spelling_variants(words, **parameters).collect()}


def changed(rng, word, alphabet):
    at, letter = rng.randrange(len(word)), rng.choice(alphabet)
    return rng.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1 :], word[:at] + letter + word[at + 1 :], word[:at] + word[at + 1 :] + word[at]])


@pytest.mark.parametrize(("alphabet", "parts", "fewer"), [("ab", 4, 3), ("abcdeé", 4, 3), ("abc中\U0001d518", 3, 2), ("abcdefgh", 6, 2)])
def test_near_words_are_exact(spark, alphabet, parts, fewer):
    """Dense and thin neighbourhoods, anagrams, letters beyond one byte, words shorter and longer than a row of the table."""
    rng = random.Random(11)
    pool = ["".join(rng.choice(alphabet) for _ in range(rng.randint(1, 9))) for _ in range(60)] + ["a" * 30, alphabet[0] * 64, alphabet[:2] * 40]
    for _ in range(200):
        pool.append(changed(rng, rng.choice(pool), alphabet) or "a")
    n = {w: rng.choice([2, 3, 20, 30, 200, 3000]) for w in pool if w}
    got = variants_of(spark, n, parts=parts, fewer=fewer)
    assert got == brute.variants(n)


def test_roots_follow_long_paths(spark):
    n = {"a" * k + "b" * (30 - k): 2 * 10**k for k in range(17)}
    got = variants_of(spark, n)
    assert got == brute.variants(n) and got["b" * 30][1] == "a" * 16 + "b" * 14


def test_equal_counts_take_the_smallest_form(spark):
    got = variants_of(spark, {"wordz": 2, "worda": 30, "wordb": 30, "wordm": 29, "other": 500})
    assert got["wordz"] == ("worda", "worda", 2, 3, 30) and got["worda"][0] is None


def test_words_of_documents(make_docs, odd_rows):
    rows = [*odd_rows, (30, "Spelling SPELLING spelling spellinG ÉLÉVATION élévation École ×÷ÿ a1b2 " * 9, "a"), (30, "spelling " * 40, "a")]
    counted = {r["word"]: r["n"] for r in spelling.word_counts(make_docs(rows), noise_every=31).collect()}
    assert counted == brute.counted_words([r[:2] for r in rows])


def test_noise_takes_one_code_point(make_docs):
    rows = [(i, "différences extraordinary ß" + "xy" * (i % 7 + 3), "a") for i in range(200)]
    counted = {r["word"]: r["n"] for r in spelling.word_counts(make_docs(rows), noise_every=31).collect()}
    assert counted == brute.counted_words([r[:2] for r in rows]) and any(len(w) == 10 for w in counted)


def test_no_words(make_docs, spark):
    empty = make_docs([(1, "x", "a")]).where("false")
    assert spelling.spelling_variants(spelling.word_counts(empty)).count() == 0
    got = spelling.spelling_variants(spark.createDataFrame([(None, 3), ("alone", 4)], VARIANT)).collect()
    assert {r["word"]: plain(r) for r in got}["alone"] == (None, "alone", 4, 0, None)
    with pytest.raises(ValueError, match="more frequent"):
        spelling.spelling_variants(spark.createDataFrame([], VARIANT), ratio=1)


# --- LSH forest ----------------------------------------------------------------------


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=str)


def test_components_of_odd_rows(make_docs, odd_rows):
    got = lsh_forest.near_duplicates(make_docs(odd_rows)).collect()
    want, _ = brute.near_components([r[:2] for r in odd_rows])
    assert ordered(got) == ordered(want)


@pytest.fixture(scope="module")
def copied(words):
    """Groups of gradually edited copies, a large dense group, exact copies and strangers; ids do not follow the groups."""
    rng = random.Random(17)
    texts = [" ".join(words(rng.randint(40, 120), 500 + i)) for i in range(60)]
    for g in range(12):
        base = words(rng.choice([12, 60, 150]), 900 + g)
        for _ in range(6):
            base = list(base)
            for _ in range(max(1, len(base) // 40)):
                base[rng.randrange(len(base))] = f"edit{rng.randrange(10**6)}"
            texts.append(" ".join(base))
    base = words(100, 2000)
    for i in range(90):
        copy = list(base)
        for _ in range(rng.randint(0, 5)):
            copy[rng.randrange(100)] = f"new{i}x{rng.randrange(10**6)}"
        texts += [" ".join(copy)] * rng.choice([1, 1, 3])
    ids = rng.sample(range(10_000), len(texts))
    return [(i, t, "a") for i, t in zip(ids, texts, strict=True)]


@pytest.mark.parametrize("capacity", [512, 24])
def test_recall_of_links(make_docs, copied, capacity):
    """Components of nearly all links, also where regions are cut far down; never a link too many."""
    got = {r["doc_id"]: r["component_id"] for r in lsh_forest.near_duplicates(make_docs(copied), capacity=capacity).collect()}
    want, pairs = brute.near_components([r[:2] for r in copied])
    true = {d: c for d, _, c, _ in want}
    assert all(true[d] == true[c] for d, c in got.items())
    found = sum(got[copied[i][0]] == got[copied[j][0]] for i, j in pairs)
    assert found >= 0.98 * len(pairs)


@pytest.mark.parametrize("region_rows", [20_000, 7])
def test_no_candidate_is_dropped(spark, region_rows):
    """All agreeing classes of different components meet, however many share a region and however it is dealt."""
    rng = np.random.default_rng(5)
    signatures = np.repeat(rng.integers(0, 256, (1, lsh_forest.VALUES), np.uint8), 120, axis=0)
    for i, row in enumerate(signatures):
        some = rng.permutation(lsh_forest.VALUES)[: 12 if i < 100 else 60]
        row[some] = rng.integers(0, 256, len(some), np.uint8)
    roots = [0 if i < 40 else i for i in range(120)]  # one component of 40, the others single
    rows = [((i, i), 100, bytearray(x.tobytes()), (r, r)) for i, (x, r) in enumerate(zip(signatures, roots, strict=True))]
    pair = "struct<k1:long,k2:long>"
    classes = spark.createDataFrame(rows, f"k {pair}, n_shingles long, signature binary, root {pair}")
    found = lsh_forest._across(lsh_forest._whole_regions(classes, region_rows), 80, 0.7).collect()
    equal = signatures[:, None, :] == signatures[None, :, :]
    meet = np.zeros((120, 120), bool)
    for t in range(lsh_forest.TREES):
        meet |= equal[:, :, [(lsh_forest.STEP * t + i) % lsh_forest.VALUES for i in range(lsh_forest.LEAST_DEPTH)]].all(axis=2)
    want = {(i, j) for i, j in np.argwhere(meet & (equal.sum(axis=2) >= 56)).tolist() if i < j and roots[i] != roots[j]}
    assert len(want) > 1000 and {tuple(sorted((r["a"]["k1"], r["b"]["k1"]))) for r in found} == want


def test_runs_hold_every_label(spark):
    """Runs cover all rows that share the least depth with a neighbour, none is larger than the capacity."""
    rng = np.random.default_rng(3)
    labels = rng.integers(0, 3, (400, lsh_forest.VALUES), np.uint8)
    labels[100:180] = labels[100]
    labels = labels[np.lexsort(labels.T[::-1])]
    runs = list(lsh_forest._runs(labels, lambda a, b: b - a <= 20, 20))
    assert all(1 < b - a <= 20 for a, b in runs)
    assert all((labels[a:b, : lsh_forest.LEAST_DEPTH] == labels[a, : lsh_forest.LEAST_DEPTH]).all() for a, b in runs)
    same = np.flatnonzero((labels[1:] == labels[:-1]).all(axis=1))
    assert all(any(a <= i and i + 1 < b for a, b in runs) for i in same.tolist())


def test_regions_stay_whole_over_batches():
    """Sorted batches of any size give every region once and whole."""
    region = np.repeat(np.arange(300), np.arange(300) % 5)
    table = pa.table({"region": pa.array(region)})
    seen = []
    old, lsh_forest.REGION_ROWS = lsh_forest.REGION_ROWS, 50
    try:
        list(lsh_forest._by_region(iter(table.to_batches(max_chunksize=7)), lambda t: seen.append((t.column(0)[0].as_py(), t.num_rows))))
    finally:
        lsh_forest.REGION_ROWS = old
    assert seen == [(i, i % 5) for i in range(300) if i % 5 > 1]


def test_candidates_meet_once_and_no_link_is_ruled_out(spark):
    """Of agreeing classes with equal components none, of others each pair once, and all that are links: parities only rule out others."""
    rng = np.random.default_rng(9)
    base = rng.integers(0, 2**64, 120, np.uint64)
    sets = [np.unique(np.concatenate((base[rng.permutation(120)[: 120 - n]], rng.integers(0, 2**64, n, np.uint64)))) for n in [6, 9, 14, 20, 26] * 20]
    pair = "struct<k1:long,k2:long>"
    flat, rows = np.concatenate(sets), np.repeat(np.arange(100), [len(x) for x in sets])
    signed = np.hstack((lsh_forest._signature(flat, np.searchsorted(rows, np.arange(100))), lsh_forest._parities(flat, rows, 100, block=7)))
    classes = spark.createDataFrame([((i, i), len(x), bytearray(y.tobytes()), (i // 2, 0)) for i, (x, y) in enumerate(zip(sets, signed, strict=True))], f"k {pair}, n_shingles long, signature binary, root {pair}")
    found = [(r["a"]["k1"], r["b"]["k1"]) for r in lsh_forest._across(lsh_forest._whole_regions(classes, 20_000), 80, 0.7).collect()]
    plain = [(r["a"]["k1"], r["b"]["k1"]) for r in lsh_forest._across(lsh_forest._whole_regions(classes.withColumn("signature", F.substring("signature", 1, lsh_forest.VALUES)), 20_000), 80, 0.7).collect()]
    once = {tuple(sorted(p)) for p in found}
    assert len(once) == len(found) and all(a // 2 != b // 2 for a, b in found)
    links = {(a, b) for a, b in (tuple(sorted(p)) for p in plain) if 10 * len(np.intersect1d(sets[a], sets[b])) >= 8 * len(np.union1d(sets[a], sets[b]))}
    assert links and links <= once and len(found) < len(plain)
    best = lsh_forest._across(lsh_forest._whole_regions(classes, 20_000), 80, 0.7, best=True)
    assert {r["a"]["k1"] for r in best.collect()} >= {x for p in links for x in p if x > 1}


def test_no_documents_to_link(make_docs):
    assert lsh_forest.near_duplicates(make_docs([(1, "x", "a")]).where("false")).count() == 0
    got = lsh_forest.near_duplicates(make_docs([(3, None, "a"), (2, "", "a"), (1, " ", "a"), (None, "one", "a")])).collect()
    assert ordered(got) == ordered([(3, 0, 3, True), (2, 0, 2, True), (1, 0, 1, True), (None, 1, None, True)])


# --- ranked search -------------------------------------------------------------------


def searched(docs, items, spark, **parameters):
    queries = spark.createDataFrame([(i, t, "x", 1) for i, t in items], "item_id long, text string, doc_id string, score int")
    return ranked_search.ranked_search(docs, queries, **parameters)


@pytest.mark.parametrize("parameters", [{}, {"block_docs": 3, "first_docs": 2}, {"first_docs": 0, "batch_items": 2}, {"top": 3, "block_docs": 1}])
def test_ranking(spark, make_docs, odd_rows, words, parameters):
    rng = random.Random(23)
    rows = [*odd_rows, *((100 + i, " ".join(words(rng.choice([3, 8, 40]), 4000 + i % 25)).upper(), "a") for i in range(60))]
    items = [(1, "one two Three"), (2, " ".join(words(9, 4003))), (3, None), (4, "absent!?"), (5, " ".join(words(8, 4003) * 3)), (5, "ta ta re"), (5, "ta ta re"), (None, "Ünïcödé b")]
    got = searched(make_docs(rows), items, spark, **parameters).collect()
    want = brute.ranking([r[:2] for r in rows], items, parameters.get("top", 10))
    # rows without doc_id and of one id with different texts are ordered by a hash, which the plain version does not know
    assert ordered(r[:2] + r[3:] for r in map(tuple, got)) == ordered(r[:2] + r[3:] for r in want)
    settled = lambda some: ordered(r for r in some if r[2] is not None)
    assert settled(map(tuple, got)) == settled(want)


def test_search_of_nothing(spark, make_docs):
    docs = make_docs([(1, "some text", "a"), (2, "", "a")])
    assert searched(docs.where("false"), [(1, "text")], spark).count() == 0
    assert searched(docs, [], spark).count() == 0
    assert searched(docs, [(1, None), (2, "nothing")], spark).count() == 0
    assert [tuple(r)[:3] for r in searched(docs, [(7, "text text")], spark).collect()] == [(7, 1, 1)]


def test_bounds_hold(spark, make_docs, words):
    """No document of a stratum scores above the stratum's bound."""
    rows = [(i, " ".join(words(5 + i % 4, 70 + i)), "a") for i in range(50)]
    items = ranked_search._Items([[w.encode() for w in words(30, 3)], [w.encode() for w in words(4, 71)]])
    counted = ranked_search.tokenised(make_docs(rows), items.vocabulary)
    weights = items.weighted({}, 50)
    index = ranked_search.stratified_index(counted, 50, 350, 4).cache()
    bounds = {(r["m"], r["item"]): r["bound"] for r in ranked_search._strata(index, weights).collect()}
    visits = index.select("m").distinct().selectExpr("m", "array(0, 1) AS items")
    lengths = {r["doc_id"]: 25 + 75 * r["n"] * 50 // 350 for r in counted.collect()}
    for r in ranked_search._best(index, visits, weights, 50).collect():
        assert r["score"] <= bounds[lengths[r["doc_id"]], r["item"]]
    index.unpersist()
