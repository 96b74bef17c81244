import os
import random

import pytest

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# Columns with names that operators use or add themselves.
CLASHES = ("component_id", "toxic", "slot", "position", "node", "key", "run", "hash", "gone", "words", "label")


def frame(spark, texts, **columns):
    """Documents of the given texts, with doc_id from 0."""
    rows = []
    for i, text in enumerate(texts):
        row = {"doc_id": i, "text": text, "lang": "en", "source": "s", "n_chars": len(text or "")}
        rows.append({**row, **{name: values[i] for name, values in columns.items()}})
    return spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def odd(spark):
    """Rows of every odd kind, with columns whose names clash with the operators' own."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(200)]
    body = " ".join(rng.choice(words) for _ in range(120))
    long = "\n".join(" ".join(rng.choice(words) for _ in range(30)) for _ in range(400))
    rows = [
        (1, body, "en", "a", len(body)), (1, body, "en", "a", len(body)),  # a row twice
        (2, body, "en", "a", len(body)), (3, None, "en", "a", None), (4, "", None, None, 0),
        (None, body, "de", "b", 5), (None, None, None, None, None), (5, " \n\t ", "de", "b", 4),
        (6, "one two", "de", "b", 7), (7, long, "en", "b", len(long)), (8, "é ü ß", "de", "b", 5),
        (2, "other text under the same id", "en", "a", 28), (9, "...!!! 123", "en", "a", 10),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    for name in CLASHES:
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="session")
def no_rows(odd):
    return odd.where("false")


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(1, 1, 0), (2, 1, 0), (2, 1, 0), (6, 0, 1), (None, 1, 1), (7, None, None), (99, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def path_of(name):
    tokenizers = pytest.importorskip("public_tokenizers")
    assert os.path.exists(tokenizers.path(name))
    return tokenizers.path(name)
