import random

import pytest
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside or return.
CLASHING = ("ids", "fp", "part", "label", "digest", "score", "toxicity", "quality", "leaf", "host", "component_id",
            "_kept", "_lang", "_coded", "_ruled", "_text", "_scored", "_label", "row", "made", "kept", "scored", "ruled",
            "url_score", "vec_row", "bucket", "dim", "z", "a.b", "a`b")


def prose(n, seed=0, words=("river", "stone", "under", "light", "moving", "paper", "winter", "field", "open", "glass")):
    r = random.Random(seed)
    return " ".join(r.choice(words) + r.choice(["", "", "", ",", "s"]) for _ in range(n)) + "."


def with_clashes(df):
    """Extra columns by the operators' own names, with dots and back-ticks, and one of a type without order."""
    have = {c.lower() for c in df.columns}
    return df.select("*", *[F.lit("x").alias(c) for c in CLASHING if c not in have],
                     F.create_map(F.lit("k"), F.lit(1)).alias("m"))


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls in every column, empty and long texts, ties, repeated rows, extra columns."""
    long = prose(30_000, 9)
    rows = [(1, "one two three four five six", "en", "s", 27), (2, None, None, None, None), (3, "", "en", "s", 0),
            (None, "no id here", "en", "s", 10), (4, "   \n\t ", None, "s", 5), (5, long, "en", "s", len(long)),
            (6, "one two three four five six", "de", "t", 27), (1, "one two three four five six", "en", "s", 27),
            (7, "x" * 5000, "en", "s", 5000), (8, "日本語 текст ñandú 😀\x00", None, None, 1), (9, None, "fr", "s", 0),
            (10, "a  b\n\n c d ", "en", "s", 9)]
    return with_clashes(spark.createDataFrame(rows, SCHEMA))


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.where("false")


@pytest.fixture(scope="session")
def corpus(spark):
    """The small given tables."""
    return {t: spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet")
            for t in ("documents", "labels", "embeddings", "pages")}
