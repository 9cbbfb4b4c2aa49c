"""Exact duplicates against grouping by text."""

import hashlib
from collections import defaultdict

import pytest

from strata.llm import exact_dedup as X

LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, text string, id string, `group` string, piece string, new string, n string, row string, doc string"


@pytest.fixture(scope="module")
def rows():
    long = "abc ÄÖ xyz " * 30_000
    texts = [None, "", "", "Same text", "same TEXT", "sAme text", "É", "é", "ab", "abc", "x" * 32, "X" * 32, "x" * 33, "x" * 256, "x" * 257, "x" * 257,
             long, long.lower(), long + "!", long + "?", "ß" * 16, "ß" * 16, "ß" * 17, "a\0b", "a\0b", "a\0", "a"]
    texts += ["hot copy " * 20] * 60 + ["y" * 31 + c for c in "abcabc"] + [f"only {k}" for k in range(50)]
    out = [(k * 7 % 1009, t) for k, t in enumerate(texts)]
    return out + [(None, "same text"), (None, "null id"), (None, "null id"), out[40], out[40], (5000, "tie"), (5000, "Tie"), (3, "tie")]


def frame(spark, rows):
    return spark.createDataFrame([(*r, *"abcdefg") for r in rows], SCHEMA).repartition(7)


def model(rows):
    by = defaultdict(list)
    for k, t in rows:
        by[(t or "").translate(LOWER)].append(k)
    return by


def test_groups_equal_those_by_text(spark, rows):
    by = model(rows)
    got = X.equal_texts(frame(spark, rows)).collect()
    sizes, kept = defaultdict(int), defaultdict(list)
    want = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in by.items()}
    for r in got:
        ids = want[r["digest"]]
        assert r["group_size"] == len(ids) and r["keep_id"] == max((k for k in ids if k is not None), default=None)
        sizes[r["digest"]] += 1
        if r["kept"]:
            kept[r["digest"]].append(r["id"])
    assert sizes == {d: len(ids) for d, ids in want.items()}
    assert kept == {d: [max((k for k in ids if k is not None), default=None)] for d, ids in want.items()}


def test_rounds_of_small_widths_and_no_hot_keys(spark, rows, monkeypatch):
    """Rounds that look at few bytes, and groups that all go through the shuffle, give the same."""
    want = sorted(map(str, X.equal_texts(frame(spark, rows)).drop("kept").collect()))
    monkeypatch.setattr(X, "FIRST", 3)
    monkeypatch.setattr(X, "HOT_ROWS", 1 << 20)
    monkeypatch.setattr(X, "HOT_BYTES", 1 << 40)
    assert sorted(map(str, X.equal_texts(frame(spark, rows)).drop("kept").collect())) == want


def test_distinct_documents_keep_rows_whole(spark, rows):
    docs = frame(spark, rows)
    got = X.distinct_documents(docs)
    assert got.schema == docs.schema
    by = model(rows)
    assert sorted((r["text"] or "").translate(LOWER) for r in got.collect()) == sorted(by)
    assert {r["piece"] for r in got.collect()} == {"c"}


def test_empty_table(spark, rows):
    docs = frame(spark, rows).limit(0)
    assert X.equal_texts(docs).count() == 0 and X.distinct_documents(docs).columns == docs.columns


def test_hot_copies_are_not_shuffled(spark):
    """A third of all rows in one group: partial counts, then a broadcast of its few pieces."""
    docs = spark.range(6000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN repeat('hot ', 100) ELSE concat('text ', id) END AS text")
    got = X.equal_texts(docs)
    assert got.filter("group_size = 2000 AND keep_id = 5997").count() == 2000
    assert got.filter("kept").count() == 4001
