import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture()
def docs(spark):
    """Builds a documents table from (doc_id, text) pairs, with more columns whose names could clash."""

    def build(rows, source="src0"):
        full = [(i, t, "en", source if isinstance(source, str) else source(i), len(t or ""), 1.0, "x") for i, t in rows]
        return spark.createDataFrame(full, SCHEMA + ", score double, component_id string")

    return build


@pytest.fixture()
def prose():
    rng = random.Random(7)
    words = ["".join(rng.choice("aeioudntrs") for _ in range(rng.randint(2, 8))) for _ in range(600)]

    def text(n, seed):
        r = random.Random(seed)
        return " ".join(r.choice(words) for _ in range(n))

    return text
