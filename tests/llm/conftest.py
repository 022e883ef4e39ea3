"""Small tables with the awkward rows that every operator has to take."""

from __future__ import annotations

import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id string, size string, digest string"


def words(rnd: random.Random, n: int) -> list[str]:
    return [rnd.choice("abcdefghij") * rnd.randint(1, 3) + str(rnd.randint(0, 400)) for _ in range(n)]


@pytest.fixture(scope="session")
def texts() -> list[tuple[int | None, str | None, str | None]]:
    """(doc_id, text, source): copies, near copies, white space, nulls, empties, a long one and repeated rows."""
    rnd = random.Random(7)
    base = words(rnd, 120)
    out: list = [(0, " ".join(base), "a"), (1, "  ".join(base), "b"), (2, " ".join(base) + " end", None), (3, None, "a"), (4, "", "c"), (5, " \t\n ", "c"), (6, "one two", "a")]
    for i in range(7, 30):
        changed = [rnd.choice("xyz") if rnd.random() < 0.02 else w for w in base]
        out.append((i, " ".join(changed), rnd.choice(["a", "b", "c", "é", None])))
    out += [(i, " ".join(words(rnd, rnd.randint(1, 60))), rnd.choice("ab")) for i in range(30, 60)]
    out += [(60, " ".join(words(rnd, 9000)), "a"), (61, "x" * 5000, "b"), (62, "naïve Ünïcode " * 40, "c"), (6, "one two", "a"), (None, "one two", "a"), (None, None, None)]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    """The texts as a table of several partitions, with columns whose names clash with inner ones."""
    rows = [(i, t, "en", s, None if t is None else len(t), "x", None, "y") for i, t, s in texts]
    return spark.createDataFrame(rows, DOCS).repartition(5).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
