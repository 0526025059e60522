"""Fingerprints, BK-trees, links and components."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from panelproj.llm import simhash
from panelproj.llm.components import components

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def brute_fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] if len(w) >= 3 else [" ".join(w)] if w else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, radius=3):
    """Least index reachable, for each value."""
    parent = list(range(len(values)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= radius:
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return [top(i) for i in range(len(values))]


def test_native_hash_is_the_same(spark):
    """The seed and encoding are those of the engine's own XXH64."""
    text = "ärger the of"
    native = spark.range(1).select(F.xxhash64(F.lit(text))).first()[0]
    assert native % 2**64 == xxhash.xxh64_intdigest(text.encode(), 42)


def test_components_of_documents(make_docs, odd_rows):
    got = simhash.simhash_components(make_docs(odd_rows)).collect()
    prints = [brute_fingerprint(t) for _, t, _ in odd_rows]
    roots = brute_components(prints)
    ids = {r: [i for (i, _, _), x in zip(odd_rows, roots, strict=True) if x == r and i is not None] for r in roots}
    want = [(i, f"{p:016x}", min(ids[r], default=None)) for (i, _, _), p, r in zip(odd_rows, prints, roots, strict=True)]
    assert sorted((tuple(r) for r in got), key=str) == sorted(want, key=str)


def test_one_of_each(make_docs, odd_rows):
    docs = make_docs(odd_rows)
    kept = simhash.one_of_each(docs)
    roots = brute_components([brute_fingerprint(t) for _, t, _ in odd_rows])
    assert kept.columns == docs.columns and kept.count() == len(set(roots))


@pytest.mark.parametrize("capacity", [8, 4096])
def test_links_connect_what_brute_force_connects(spark, capacity):
    """Chains, a dense ball and random values; small shards meet by groups."""
    rng = random.Random(3)
    values = [rng.getrandbits(64) for _ in range(150)]
    for start in values[:15]:
        for _ in range(6):
            start ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
            values.append(start)
    values += [values[0] ^ (1 << a) ^ (1 << b) for a in range(12) for b in range(a)]
    values = sorted(set(values))
    signed = np.array(values, np.uint64).view(np.int64).tolist()
    edges = simhash.links(spark.createDataFrame([(v,) for v in signed], "fingerprint long"), 3, capacity)
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    roots = brute_components(values)
    groups = {}
    for v, r in zip(signed, roots, strict=True):
        groups.setdefault(r, []).append(v)
    for members in groups.values():
        assert {got.get(m, m) for m in members} == {min(members)}


def test_tree_search_is_exact():
    rng = random.Random(5)
    values = [rng.getrandbits(16) for _ in range(300)]
    tree, queries = simhash.BKTree(values), np.array(values, np.uint64)
    got = {(tree.values[n], int(queries[q])) for n, near in tree.within(queries, 3) for q in near}
    assert got == {(a, b) for a in values for b in values if (a ^ b).bit_count() <= 3}


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + k) for k in range(1, 40)] + [(200, 200)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(61)} | {100 + k: 100 for k in range(40)}


def test_no_links_and_empty_tables(make_docs, spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
    empty = make_docs([(1, "x", "a")]).where("false")
    assert simhash.simhash_components(empty).count() == 0 and simhash.one_of_each(empty).count() == 0
    with pytest.raises(ValueError):
        simhash.simhash_components(empty, radius=4)
