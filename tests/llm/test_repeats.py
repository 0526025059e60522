"""Suffix and fixed-block removal against brute force."""

import hashlib
import re
from collections import Counter

import numpy as np
import pytest

from panelproj.llm import repeats, textbytes
from panelproj.llm.substring_dedup import substring_dedup
from panelproj.llm.suffix_dedup import COVER, PERIOD, suffix_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


def brute_bytes(rows, length):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = Counter(b[s : s + length] for _, b in texts for s in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        mask = np.zeros(len(b), dtype=bool)
        for s in range(len(b) - length + 1):
            if seen[b[s : s + length]] > 1:
                mask[s : s + length] = True
        spans = int(np.sum(mask & ~np.concatenate(([False], mask[:-1])))) if len(b) else 0
        out.append((i, len(b), int(mask.sum()), spans, sha(bytes(x for x, m in zip(b, mask, strict=True) if not m))))
    return out


def brute_words(rows, length):
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    seen, out = set(), []
    for i, t, _ in ordered:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for s in range(len(w) - length + 1):
            key = tuple(w[s : s + length])
            if key in seen:
                gone[s : s + length] = [True] * length
            seen.add(key)
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g).encode())))
    return out


def as_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def in_range_order(rows):
    """Rows without id are ordered by their chunk, which depends on their text; equal ones can be compared whatever the order."""
    return sorted(rows, key=str)


def test_cover_has_every_distance():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_suffix_dedup(make_docs, odd_rows):
    assert as_rows(suffix_dedup(make_docs(odd_rows))) == sorted(brute_bytes(odd_rows, 200), key=str)


@pytest.mark.parametrize("length", [140, 260])
def test_suffix_dedup_other_lengths(make_docs, odd_rows, length):
    assert as_rows(suffix_dedup(make_docs(odd_rows), length)) == sorted(brute_bytes(odd_rows, length), key=str)


def test_suffix_dedup_keeps_text(make_docs, odd_rows):
    for r in suffix_dedup(make_docs(odd_rows), with_text=True).collect():
        assert sha(r["kept"]) == r["kept_sha256"]


def test_substring_dedup(make_docs, odd_rows):
    assert as_rows(substring_dedup(make_docs(odd_rows))) == in_range_order(brute_words(odd_rows, 20))


def test_substring_dedup_extends_between_blocks(make_docs, words):
    """A repeat at any alignment is found, and a repeat one word too short is not."""
    base = words(100, 50)
    rows = [(1, " ".join(base), "a")] + [(2 + k, " ".join(words(k, 60 + k) + base[40 : 60 + k % 2 - 1] + words(9, 80 + k)), "a") for k in range(20)]
    assert as_rows(substring_dedup(make_docs(rows))) == in_range_order(brute_words(rows, 20))


def test_many_chunks_agree(make_docs, odd_rows, monkeypatch):
    monkeypatch.setattr(repeats, "chunked", lambda docs, f=repeats.chunked: f(docs, 300))
    assert as_rows(substring_dedup(make_docs(odd_rows))) == in_range_order(brute_words(odd_rows, 20))
    assert as_rows(suffix_dedup(make_docs(odd_rows))) == sorted(brute_bytes(odd_rows, 200), key=str)


def test_empty_tables(make_docs):
    empty = make_docs([(1, "x", "a")]).where("false")
    assert suffix_dedup(empty).count() == 0 and substring_dedup(empty).count() == 0


def test_packed_keys_round_trip():
    keys = np.sort(np.random.default_rng(1).integers(0, 2**64, 1000, dtype=np.uint64))
    assert (repeats.unpack(repeats.pack(keys)) == keys).all()
    assert (repeats.unpack(repeats.pack(keys, 6), 6) == (keys >> np.uint64(16)) << np.uint64(16)).all()
    batch = repeats.dealt(3, keys, 7)
    assert sum(len(repeats.unpack(x.as_py())) for x in batch.column(2)) == 1000


def test_words_do_not_cross_rows():
    import pyarrow as pa

    data, offsets = textbytes.buffer_of(pa.array(["ab", "", None, "c d", " e"]))
    words = textbytes.Words(data, offsets)
    assert words.counts.tolist() == [1, 0, 0, 2, 1] and words.row.tolist() == [0, 3, 3, 4]
