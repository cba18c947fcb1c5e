import random

import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def table(spark):
    """Rows as a table of documents, with columns whose names clash with results."""
    def make(rows, extra=True):
        df = spark.createDataFrame([(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows], SCHEMA)
        if not extra:
            return df
        from pyspark.sql import functions as F
        return df.withColumns({c: F.lit(c) for c in (
            "_w", "size", "slot", "shard", "score", "region", "key_source", "b1_end", "kept_id", "words", "target")})
    return make


@pytest.fixture
def odd_rows():
    """Nulls, empty and blank texts, repeated rows, repeated ids, a very long text."""
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 7))) for _ in range(400)]
    prose = " ".join(rng.choice(words) for _ in range(300))
    long = " ".join(rng.choice(words) for _ in range(60_000))
    return [
        (1, prose, "en", "a"), (2, prose, "en", "a"), (2, prose, "en", "a"), (3, prose.upper(), None, None),
        (4, None, "en", "b"), (5, "", "de", "b"), (6, " \t\n ", "de", None), (7, "one two", "de", "b"),
        (8, "One\ttwo", "de", "b"), (None, prose + " tail", "en", "a"), (None, None, None, None),
        (9, long, "en", "c"), (10, "12 34 ?!", "en", "c"), (11, "x", "en", "c"),
    ]


@pytest.fixture(scope="session")
def duck(small_dir):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{small_dir}/{t}.parquet')")
    return con
