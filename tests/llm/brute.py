"""Plain versions of the operators of spelling, near duplicates and search, for small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def counted_words(docs, least_length=7, least_count=2):
    n = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    return {w: c for w, c in n.items() if len(w) >= least_length and c >= least_count}


def near(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))


def variants(n, ratio=10):
    """word: (form, root, n, n_near, form_n)."""
    meet = defaultdict(set)
    for w in n:
        for i in range(len(w)):
            meet[w[:i] + "\0" + w[i + 1 :]].add(w)
            meet[w[:i] + w[i + 1 :]].add(w)
        meet[w].add(w)
    links = defaultdict(set)
    for group in meet.values():
        for a in group:
            links[a].update(b for b in group if near(a, b))
    form = {}
    for w in n:
        best = min(links[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (form[w], root(w), n[w], len(links[w]), n[form[w]] if form[w] else None) for w in n}


def shingle_set(text):
    w = WORD.findall((text or "").translate(LOWER))
    return set(zip(w, w[1:], strict=False)) if len(w) > 1 else set(w)


def linked(x, y):
    both = len(x & y)
    return both > 0 and 100 * both >= 80 * (len(x) + len(y) - both)


def near_components(docs):
    """(doc_id, n_shingles, component_id, kept) of every document, and the linked pairs of places."""
    sets = [shingle_set(t) for _, t in docs]
    parent = list(range(len(docs)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 0.8 * len(sets[i]) <= len(sets[j]) <= len(sets[i]) / 0.8 and linked(sets[i], sets[j])]
    for i, j in pairs:
        a, b = top(i), top(j)
        parent[max(a, b)] = min(a, b)
    ids = defaultdict(list)
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            ids[top(i)].append(doc_id)
    least = [min(ids[top(i)], default=None) for i in range(len(docs))]
    return [(d, len(s), c, d == c) for (d, _), s, c in zip(docs, sets, least, strict=True)], pairs


def ranking(docs, items, top=10):
    """(item_id, rank, doc_id, score)."""
    terms = [Counter(TERM.findall((t or "").translate(LOWER))) for _, t in docs]
    n, total = sum(bool(t) for t in terms), sum(sum(t.values()) for t in terms)
    df = Counter(t for c in terms for t in c)
    out = []
    for item_id, text in items:
        asked = Counter(TERM.findall((text or "").translate(LOWER)))
        found = []
        for (doc_id, _), c in zip(docs, terms, strict=True):
            if c:
                m = 25 + 75 * sum(c.values()) * n // total
                score = sum(k * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t, k in asked.items() if t in c)
                if score > 0:
                    found.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item_id, r + 1, f[3], -f[0]) for r, f in enumerate(sorted(found)[:top])]
    return out
