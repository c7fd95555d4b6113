import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

#: Names that the operators use inside, as extra columns.
CLASH = ["id", "node", "key", "row", "component", "cluster", "size", "target", "copies", "seed", "part", "w", "h", "l",
         "lines", "kept", "score", "_gone", "_text", "start", "end"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASH)


def as_docs(spark, rows):
    """Documents of (doc_id, text, lang, source) with clashing columns."""
    full = [(d, t, la, s, None if t is None else len(t), *["x"] * len(CLASH)) for d, t, la, s in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="session")
def odd_rows():
    """Null, empty, blank, long, repeated and tied rows."""
    rnd = random.Random(5)
    vocabulary = ["alpha", "Beta", "gamma", "delta", "épsilon", "zeta", "eta,", "theta", "Iota", "kappa", "lambda", "mu"]
    text = lambda n: " ".join(rnd.choice(vocabulary) + str(rnd.randint(0, 40)) for _ in range(n))
    base, other = text(120), text(90)
    lines = "\n".join(text(12) for _ in range(8))
    near = base.replace(base.split()[30], "changed", 1)
    rows = [
        (1, base, "en", "a"), (2, near, "en", "a"), (3, base, "en", None), (4, None, "en", "b"), (5, "", None, "b"),
        (6, " \t\n ", "de", "c"), (7, "one", "de", "c"), (8, "ONE", "de", "c"), (9, other, None, "d"), (10, lines, "fr", "d"),
        (11, lines + "\nmore " + text(10), "fr", None), (12, text(9000), "en", "a"), (13, "###  $$ <a> 12 34", "es", "e"),
        (14, "same words again " * 40, "es", "e"), (15, other + " " + base, "en", "ä"), (16, "\n".join([text(20)] * 3), "en", "b"),
    ]
    return rows


@pytest.fixture(scope="session")
def odd(spark, odd_rows):
    return as_docs(spark, odd_rows)


@pytest.fixture(scope="session")
def unruly(spark, odd_rows):
    """The odd rows with repeated rows, repeated ids and null ids."""
    return as_docs(spark, [*odd_rows, odd_rows[0], odd_rows[9], (1, "another text with that id", "en", "a"),
                           (None, odd_rows[0][1], None, None), (None, None, None, None)])


@pytest.fixture(scope="session")
def nothing(spark):
    return as_docs(spark, [])
