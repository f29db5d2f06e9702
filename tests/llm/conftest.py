import random

import pytest

# Names that operators might use themselves; they must not clash.
EXTRA = ["key", "words", "n", "start", "score", "size", "rank", "node", "label", "found", "kept", "_kept"]


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text[, source]) rows, with extra columns of clashing names."""
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(
        f"{name} string" for name in EXTRA
    )

    def make(rows):
        full = [
            (r[0], r[1], None, r[2] if len(r) > 2 else "s", len(r[1] or ""), *["x"] * len(EXTRA)) for r in rows
        ]
        return spark.createDataFrame(full, schema)

    return make


@pytest.fixture(scope="session")
def prose():
    """Random words of a few letters, the same for the same seed."""

    def make(n, seed, vocabulary=5000):
        rng = random.Random(seed)
        return " ".join("w%x" % rng.randrange(vocabulary) for _ in range(n))

    return make


# Rows every operator on documents must cope with.
ODD = [(101, None), (102, ""), (103, " \t\n "), (None, "no id here"), (104, "Ünïcödé ÀÉ ſ K"), (105, "one")]


@pytest.fixture(scope="session")
def odd():
    return list(ODD)
