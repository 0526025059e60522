import random

import pytest

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, row_key string, token string, size string, score string, chunk string, "
    "bucket string, keys string, kind string, fingerprint string, component_id string, line_hash string, place string, shard string, gone string, base string, "
    "row_key_of_doc string, row_key_found string, row_key_of_best string, key_of_doc string, key_of_gone string, gone_lines string, some string, wanted_key string, "
    "own_key string, other_key string, line_numbers string, all_spans string, word string, n string, form string, root string, label string, tree string, region string, "
    "signature string, n_shingles string, terms string, tfs string, m string, block string, copies string, doc_key string, item string"
)


def row(doc_id, text, source="a"):
    """A document with extra columns whose names the operators use inside."""
    return (doc_id, text, "en", source, len(text or ""), *["extra"] * (SCHEMA.count(",") - 4))


@pytest.fixture(scope="session")
def make_docs(spark):
    return lambda rows, parts=3: spark.createDataFrame([row(*r) for r in rows], SCHEMA).repartition(parts)


@pytest.fixture(scope="session")
def words():
    rng = random.Random(7)
    pool = ["".join(rng.choice(["ta", "re", "on", "mi", "éa", "lu", "st", "or"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def some(n, seed):
        pick = random.Random(seed)
        return [pick.choice(pool) for _ in range(n)]

    return some


@pytest.fixture(scope="session")
def odd_rows(words):
    """Nulls, empty and long texts, blanks, copies, near copies, shared passages, repeated rows and ids."""
    shared = " ".join(words(60, 1))
    long_text = "\n".join(" ".join(words(40, 100 + i)) for i in range(120))
    near = words(150, 2)
    rows = [
        (1, None), (2, ""), (3, " \t\n  "), (4, "one two three"), (5, "one two three"), (6, " ".join(words(30, 3)) + " " + shared + " " + " ".join(words(30, 4))),
        (7, shared + "\n" + " ".join(words(20, 5))), (8, long_text), (9, " ".join(near)), (10, " ".join(near[:70] + ["changed"] + near[71:])), (11, " ".join(near)),
        (12, " ".join(words(25, 6)) + "\n" + " ".join(near)), (13, "same line here with six words\nsame line here with six words\n\nanother line"), (13, "same line here with six words\nsame line here with six words\n\nanother line"),
        (14, "x" * 30_000), (15, "ab" * 400), (16, "a b \x0b c\x0c\rd Ünïcödé ÀB"), (None, shared), (None, None), (None, shared), (18, "\n".join([shared] * 3)), (19, shared[3:]),
    ]
    return [(*r, ("a", "b", None)[i % 3]) for i, r in enumerate(rows)]
