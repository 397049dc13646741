import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

DOCS = StructType(
    [
        StructField("doc_id", LongType()),
        StructField("text", StringType()),
        StructField("lang", StringType()),
        StructField("source", StringType()),
        StructField("n_chars", LongType()),
    ]
)
#: Names that operators use themselves.
CLASHES = ["k1", "k2", "fp", "spans", "anchor", "host", "line", "h", "hashes", "tokens", "items", "kept", "bucket", "rule", "verdict", "url", "seq",
           "__k1", "__k2", "__host", "__lines", "__0", "__1"]


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents of (doc_id, text) or (doc_id, text, source), with extra columns whose names clash."""

    def make(rows, clashes=True):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s0", None if r[1] is None else len(r[1])) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if clashes:
            from pyspark.sql import functions as F

            df = df.withColumns({c: F.lit(f"extra {c}") for c in CLASHES})
        return df

    return make


@pytest.fixture(scope="session")
def awkward(docs_of):
    """Nulls, empty texts, white space, a very long text, repeated rows and ids, a null id."""
    import random

    rng = random.Random(7)
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(30_000))
    plain = " ".join(f"plain{k} token{rng.randrange(50)}" for k in range(60))
    rows = [
        (1, None), (2, ""), (3, " \t\n \x0b"), (4, long), (5, plain), (5, plain), (5, plain + " more"), (None, plain), (None, None),
        (6, "x" * 70_000), (7, "é ü 日本 🙂 ﬁ"), (8, "one"), (9, "a b"), (10, plain, None),
    ]
    return docs_of(rows)
