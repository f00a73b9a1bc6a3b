import os
import sys

import duckdb
import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tools"), os.path.dirname(os.path.abspath(__file__))]

SF = "/root/testdata/sf0.001"

#: Null, empty, blank, short and repeated texts, ties of ids, a null id, clashing column names.
AWKWARD = [
    (1, "the same line of text here\nand one more line of it", "x"),
    (2, "the same line of text here\nand one more line of it", None),
    (2, "the same line of text here\nand one more line of it", None),
    (3, None, "x"),
    (4, "", "x"),
    (5, " \t\n\x0b\r\n", "x"),
    (6, "short", "x"),
    (7, "The SAME line of text here  \nshort\nshort\nother words follow é ü 漢字 after that one line", "x"),
    (None, "the same line of text here\nand one more line of it", "x"),
    (None, None, None),
    (8, "word " * 30_000 + "end of a very long text", "x"),
]


@pytest.fixture(scope="session")
def awkward(spark):
    names = "doc_id bigint, text string, digest string, id bigint, token bigint, pos int"
    return spark.createDataFrame([(a, b, c, 1, 2, 3) for a, b, c in AWKWARD], names)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string, source string, n_chars bigint")


@pytest.fixture(scope="session")
def sample(spark):
    """Whole documents of the smallest tables."""
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "conversations"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con
