import random

import pytest

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def prose(seed: int, n: int) -> str:
    """Sentences of invented words, on lines."""
    rng = random.Random(seed)
    words = ["".join(rng.choice("bcdfglmnprst") + rng.choice("aeiou") for _ in range(rng.randint(1, 4))) for _ in range(n)]
    out = []
    for i, w in enumerate(words):
        out.append(w + (".\n" if i % 31 == 30 else "." if i % 9 == 8 else ""))
    return " ".join(out).replace("\n ", "\n")


@pytest.fixture(scope="session")
def make_docs(spark):
    def make(rows, **extra):
        """rows: (doc_id, text) or (doc_id, text, source)."""
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", len(r[1] or "")) for r in rows]
        return spark.createDataFrame(full, DOCS)

    return make


@pytest.fixture(scope="session")
def clashing():
    """Columns whose names the operators use themselves."""
    from pyspark.sql import functions as F

    def add(df, *names):
        return df.select("*", *[F.lit(1).alias(n) for n in names if n not in df.columns])

    return add
