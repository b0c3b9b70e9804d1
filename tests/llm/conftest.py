import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, h string, n long, spans string, score string, size string, copies string, label string, key string, node string"


def clash(rows):
    """Rows of (doc_id, text, lang, source) with columns whose names operators use themselves."""
    return [(d, t, l, s, None if t is None else len(t), "h", 7, "spans", "score", "size", "copies", "label", "key", "node") for d, t, l, s in rows]


def words(rng, n, stems=("ta", "ri", "mo", "len", "us", "que", "or", "in")):
    return " ".join("".join(rng.choice(stems) for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="session")
def corpus(spark):
    """Nulls in every column, empty and long texts, copies, near copies, repeated rows, shared passages."""
    rng = random.Random(11)
    base, passage = words(rng, 200), words(rng, 120)
    rows = [(i, words(rng, rng.randint(1, 90)), rng.choice(["xx", "yy", None]), rng.choice(["a", "b", None])) for i in range(40)]
    rows += [(100 + i, base, "xx", "a") for i in range(3)]
    for i in range(8):
        w = base.split()
        w[rng.randrange(len(w))] = f"edit{i}"
        rows.append((110 + i, " ".join(w), "xx", "a"))
    rows += [(130 + i, words(rng, 30) + " " + passage + " " + words(rng, 20), "yy", "b") for i in range(4)]
    rows += [(150, None, None, None), (151, "", "xx", "a"), (152, " \n\t ", "xx", "b"), (None, "no id here at all", "xx", "a"), (None, None, None, None)]
    rows += [(160, words(rng, 6000), "xx", "b"), (161, "one", "xx", "a"), (162, "É▁\U0001f600 ß 💡\x00x", "yy", None), (163, "ab" * 3000, "xx", "a"), (164, "aaaa " * 400, None, "b")]
    rows += [rows[0], rows[0], rows[45]]
    return spark.createDataFrame(clash(rows), SCHEMA)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def texts(corpus):
    return [(r.doc_id, r.text) for r in corpus.select("doc_id", "text").collect()]
