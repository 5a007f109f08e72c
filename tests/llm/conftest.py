"""Small tables for the operators: the driver's smallest tables, edge cases, and empty tables."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Columns whose names the operators use themselves.
CLASHES = ("pii", "spans", "score", "lang_pred", "held_out", "simhash", "component_id", "size", "skey", "block", "start", "taken", "target",
           "ids", "n_tokens", "row", "rid", "name", "kind", "key", "rest", "variant", "fingerprint", "tail", "bucket", "word", "number", "c", "__text", "turn", "body", "n_words", "runs", "items")


def edge_rows():
    rng = random.Random(3)
    words = ["alpha", "beta", "the", "of", "gamma", "delta", "und", "der", "la", "que", "omega", "x1", "mail a.b@c.example", "4539 1488 0343 6467"]
    prose = lambda n: " ".join(rng.choice(words) for _ in range(n))
    passage = prose(60)
    rows = [
        (1, "Call +1 (555) 010-2345 or mail bob@mail.example, card 4111 1111 1111 1111, host 10.0.0.255.", "en", "a", 1),
        (2, None, "en", "a", None),
        (3, "", None, None, 0),
        (4, " \t\n ", "en", "b", 4),
        (5, passage, "de", "b", 5),
        (6, passage, "de", "c", 5),
        (7, prose(30) + " " + passage + " " + prose(20), "fr", None, 6),
        (8, "12345 !!! 67", "fr", "c", 7),
        (9, "a" * 5000, "es", "d", 8),
        (10, prose(20000), None, "d", 9),
        (11, "été ñandú straße 漢字 Привет \U0001F600 x́", "es", "e", 10),
        (12, passage.replace("alpha", "beta", 1), "en", "e", 11),
        (13, "ab " * 400, "en", "a", 12),
        (13, "ab " * 400, "en", "a", 12),
        (13, "another text under the same id", "en", "a", 13),
        (None, "a row without id", "en", "a", 14),
        (None, None, None, None, None),
    ]
    return rows + [(20 + i, prose(rng.randint(1, 80)), rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), i) for i in range(40)]


def _write(spark, folder, rows):
    docs = spark.createDataFrame(rows, DOCS)
    wide = docs.withColumns({c: F.lit(f"own {c}") for c in CLASHES})
    wide.repartition(3).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, i % 2, 0) for i in range(1, 60)] + [(5, 1, 0), (None, 1, 1), (7, None, None)]
    spark.createDataFrame(labels if rows else [], "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    items = [(1, rows[4][1]), (2, "Another TEXT"), (2, "under the same"), (3, None), (4, "..."), (None, "a row without id"), (5, rows[9][1][2000:9000]),
             (6, "Call +1 (555) 010-2345 or mail bob@mail.example"), (6, "no such words"), (7, "漢字 Привет")] if rows else []
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    bench.withColumns({c: F.lit("own") for c in ("item", "window", "w", "term", "score", "rank", "doc_id")}).write.parquet(f"{folder}/benchmark.parquet")
    rng = random.Random(4)
    vectors = [(i, [rng.gauss(0, 1) for _ in range(8)], 0) for i in range(120)]
    vectors += [(200, None, 0), (250, [0.0] * 8, 0), (300, [1.0, None] + [1.0] * 6, 0), (350, [float("nan")] * 8, 0), (400, [float("inf")] + [0.0] * 7, 0),
                (None, [1.0] * 8, 0), (450, [1.0] * 8, 0), (451, [1.0] * 8, 0), (451, [1.0] * 8, 0), (452, [2.0] * 8, 0)]
    table = spark.createDataFrame(vectors if rows else [], "vec_id bigint, embedding array<float>, label int")
    table.withColumns({c: F.lit("own") for c in ("vec", "near", "score", "rank", "query_id", "pivot", "block", "place")}).write.parquet(f"{folder}/embeddings.parquet")
    return folder


@pytest.fixture(scope="session")
def edge(spark):
    return _write(spark, tempfile.mkdtemp(prefix="llm-edge-"), edge_rows())


@pytest.fixture(scope="session")
def empty(spark):
    return _write(spark, tempfile.mkdtemp(prefix="llm-empty-"), [])


def documents(spark, folder):
    """Rows of a documents table as plain tuples, nulls as they are."""
    return [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text", "lang", "source").collect()]
