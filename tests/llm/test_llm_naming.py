"""Exact copies by block naming against brute force."""

import hashlib
import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from lakemart.llm import block_naming, queries

DOCS = "doc_id long, text string, row string, `name` string, block string, id string"


def frame(spark, rows):
    """Rows with columns whose names the operator uses itself."""
    return spark.createDataFrame([(doc_id, text, "r", "n", "b", "i") for doc_id, text in rows], DOCS)


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[re.sub("[\x20\x09-\x0d]+", " ", text or "")].append(doc_id)
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, ids[0], len(ids), n == 0, sha) for n, i in enumerate(ids)]
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()), key=repr)


@pytest.fixture
def texts():
    pick = random.Random(5)
    long = "".join(pick.choice("ab c\t\né😀") for _ in range(3000))
    return [
        (7, long), (3, long), (9, long[:-1]), (8, "z" + long), (12, long.replace("\t", " \n")),
        (1, ""), (2, None), (4, " "), (5, "\n\t "), (6, "\xa0"), (None, "a  b"), (11, "a b"), (None, ""), (10, "a\x0bb"),
        (13, "abcd" * 16), (14, "abcd" * 8), (15, "abcd" * 16 + "abcd"), (16, "x"), (16, "x"), (17, "x "),
        (None, "only null"), (None, "only  null"),
    ]


def test_groups_and_edge_rows(spark, texts):
    for size in (16, 4096):
        assert found(block_naming.exact_copies(frame(spark, texts), block_bytes=size)) == expected(texts)


def test_blocks_that_share_a_fingerprint_are_told_apart(spark, texts):
    salts = []

    def weak(block, salt):
        salts.append(salt)
        return block_naming.fingerprint(block, salt) if salt > 1 else [F.crc32(block) % 5, F.lit(0).cast("long")]

    assert found(block_naming.exact_copies(frame(spark, texts), block_bytes=32, marks=weak)) == expected(texts)
    assert set(salts) == {0, 1, 2}


def test_one_text_in_most_rows(spark):
    rows = [(n, "same text" if n % 3 else f"own {n}") for n in range(3000)]
    assert found(block_naming.exact_copies(frame(spark, rows), block_bytes=8)) == expected(rows)


def test_empty_table(spark):
    assert block_naming.exact_copies(frame(spark, [])).count() == 0


def test_query(spark, small):
    rows = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    assert found(queries.op12_block_naming(spark, small)) == expected([tuple(r) for r in rows])


def test_no_python_in_the_plan(spark, texts, capsys):
    block_naming.exact_copies(frame(spark, texts)).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
