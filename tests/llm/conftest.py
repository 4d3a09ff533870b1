import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                       T.StructField("lang", T.StringType()), T.StructField("source", T.StringType())])


@pytest.fixture(scope="session")
def corpus(spark):
    """Whole small table of the driver: (doc_id, text) rows, the DataFrame, and its folder."""
    folder = "/root/testdata/sf0.001"
    df = spark.read.parquet(f"{folder}/documents.parquet")
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()], df, folder


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and blank texts, ties, near copies, other scripts, a very
    long text, and extra columns whose names clash with results."""
    rng = random.Random(4)
    words = ["alpha", "Beta", "gämma", "delta.", "eps", "zeta", "eta,", "theta", "iota", "日本", "ñandú", "x1", "<b>", "||", "42"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 120))) for _ in range(60)]
    long = " ".join(rng.choice(words) + str(rng.randrange(10 ** 6)) for _ in range(60_000))
    near = [t.split(" ") for t in texts[:10]]
    for t in near:
        t[len(t) // 2] = "changed"
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(100 + i, " ".join(t)) for i, t in enumerate(near)] + [(200 + i, texts[i].upper()) for i in range(5)]
    rows += [(300, None), (301, ""), (302, "  \n\t "), (303, "***"), (304, "***"), (305, "one two"), (306, "One, two!"),
             (307, long), (308, long[:200_000] + " tail"), (309, "a\n\nb\r\na\n" * 40), (310, "é" * 130), (311, "é" * 230),
             (312, "double  blank   and\ttab \n end  "), (313, "don't <|endoftext|> we'll"), (314, "　wide blank  x")]
    full = [(i, t, rng.choice(["en", "fr", None]), rng.choice(["a", "b", None, "c"])) for i, t in rows]
    df = spark.createDataFrame(full, SCHEMA).selectExpr(
        "*", "1 AS doc", "'x' AS score", "2 AS id", "3 AS key", "4 AS size", "5 AS run", "'y' AS lang_pred", "6 AS c0", "7 AS n")
    return rows, df


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
