"""Exact copies against a plain grouping, and their defined results in odd cases."""

import hashlib
import random
from collections import defaultdict

import pytest

from tallystream.llm import exact_copies as module
from tallystream.llm.exact_copies import exact_copies, exact_distinct
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def normal(text):
    return (text or "").translate(LOWER)


def brute(rows):
    """(doc_id, keep_id, group_size, kept, sha256) of rows (doc_id, text)."""
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[normal(text)].append(doc_id)
    out = []
    for doc_id, text in rows:
        ids = groups[normal(text)]
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(normal(text).encode()).hexdigest()
        out.append((doc_id, keep, len(ids), doc_id == keep, sha))
    return sorted(out, key=repr)


def made(seed, n=400):
    """Texts that share lengths, beginnings and letters up to case."""
    draw = random.Random(seed)
    begin = ["", "x" * 64, "É" * 64, "Q" * 70]
    body = ["a", "A", "b", "é", "É", "ab", "aB", "AB", "İ", "i̇", "ß", "SS", "ss"]
    return [(i, draw.choice(begin) + draw.choice(body)) for i in range(n)]


def result(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


@pytest.mark.parametrize("limit", [500_000, 2, 0])
def test_against_grouping(spark, monkeypatch, limit):
    """The same classes whether key sets are sent to tasks or not."""
    monkeypatch.setattr(module, "BROADCAST_KEYS", limit)
    rows = made(limit)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert result(exact_copies(frame)) == brute(rows)


def test_large_class(spark, monkeypatch):
    monkeypatch.setattr(module, "BROADCAST_KEYS", 0)
    monkeypatch.setattr(module, "HOT_SHARE", 0.05)
    rows = [(i, "Same Text" if i % 3 else f"text {i}") for i in range(3000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    assert result(exact_copies(frame)) == brute(rows)


def test_equals_sql(equals_sql):
    equals_sql("op11_exact_dedup")


def test_odd_rows(odd_table):
    got = result(exact_copies(odd_table))
    assert got == brute([r[:2] for r in ODD])
    by_id = {r[0]: r for r in got}
    assert by_id[1][1:4] == (2, 3, False)  # null, null and empty are one class


def test_distinct_keeps_columns_and_one_of_each(odd_table):
    stay = exact_distinct(odd_table)
    assert stay.columns == odd_table.columns
    ids = sorted((r.doc_id for r in stay.collect()), key=repr)
    assert ids == [2, 3, 4, 4, 6, None]  # of the two equal rows of id 4 one stays
    assert {r.text for r in stay.collect()} == {r[1] for r in ODD} - {None}


@pytest.mark.parametrize("limit", [500_000, 0])
def test_distinct_against_grouping(spark, monkeypatch, limit):
    monkeypatch.setattr(module, "BROADCAST_KEYS", limit)
    rows = made(7)
    stay = exact_distinct(spark.createDataFrame(rows, "doc_id long, text string"))
    want = {r[0] for r in brute(rows) if r[3]}
    assert sorted(r.doc_id for r in stay.collect()) == sorted(want)


def test_full_texts_are_hashed_for_survivors_only(spark):
    """Rows alone with their length or beginning are told apart without a full hash."""
    rows = [(1, "a"), (2, "bb"), (3, "cc"), (4, "dd" * 60), (5, "ee" * 60), (6, "BB")]
    marked = module._survivors(spark.createDataFrame(rows, "doc_id long, text string"), "s")
    assert {r.doc_id for r in marked.filter("s").collect()} == {2, 6}


def test_no_python_in_the_plan(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = exact_copies(docs)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, extra int")
    assert exact_copies(empty).isEmpty() and exact_distinct(empty).isEmpty()
