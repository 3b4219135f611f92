import random

import pytest
from pyspark.sql.types import LongType, StringType, StructField, StructType

SF = "/root/testdata/sf0.001"

#: extra columns clash with names that operators use inside
SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
    *[StructField(c, StringType()) for c in ("score", "kind", "block", "key", "id", "held_out", "sha", "gone", "fp", "root")],
])


def edge_rows():
    """Nulls everywhere, empty, blank and long texts, repeated rows, near copies."""
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdefgh") for _ in range(draw.randint(2, 7))) for _ in range(400)]
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base = prose(300)
    texts = [None, "", " ", "\n\t", "one", "Two words", "a b c d", prose(5), base, base, base + " end", base.replace(" ", "  "),
             base.upper(), prose(30_000), "x" * 70_000, "9" * 5000, "!" * 3000, "é ß ñ Ünï", "日本 語", "Σίγμα ΣΑΣ", "İstanbul",
             "mail a.b@c.de and 1.2.3.4 or 4111 1111 1111 1111, +1 (017) 555-7713", "<|endoftext|> <|startoftext|>x"]
    texts += [" ".join(w if draw.random() > 0.02 else "zz" for w in base.split()) for _ in range(12)]
    rows = [(k, t, ("en", None, "de")[k % 3], "s", None) for k, t in enumerate(texts)]
    return rows + [rows[8], rows[8], (9, "another text for a used id", None, None, 3)]


def frame(spark, rows):
    return spark.createDataFrame([(*r[:5], *["x"] * 10) for r in rows], SCHEMA)


@pytest.fixture(scope="session")
def edge(spark):
    return frame(spark, edge_rows() + [(None, "no id here", None, None, None), (None, None, None, None, None)])


@pytest.fixture(scope="session")
def unique(spark):
    """Edge rows with ids of their own, for plain versions that go by id."""
    return [(k, r[1]) for k, r in enumerate(edge_rows())]


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet(f"{SF}/labels.parquet")


def as_rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
