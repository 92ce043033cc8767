"""The filter audit against filters applied one after the other."""

import re
from collections import defaultdict
from itertools import permutations

import numpy as np
import pytest

from tallystream.llm import filter_audit as module
from tests.llm.conftest import DOCUMENTS, ODD

FILTERS = "ABCDE"


def failed(rows):
    """Per row (doc_id, text, part): the set of filters it fails, by the plain definitions."""
    out = []
    for doc_id, text, _ in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = set()
        if len(words) < 200:
            fails.add("A")
        if 100 * len(set(words)) < 50 * len(words):
            fails.add("B")
        if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text):
            fails.add("C")
        if re.search("[#$%&*|]", text):
            fails.add("D")
        if doc_id is not None and any(
            t == text and i is not None and i < doc_id for i, t, _ in rows
        ):
            fails.add("E")
        out.append(fails)
    return out


def brute(rows, labels):
    """All output rows, by applying the filters in turn."""
    fails, parts = failed(rows), defaultdict(list)
    for (doc_id, _, part), f in zip(rows, fails):
        marks = [x for x in labels if x[0] is not None and x[0] == doc_id]
        parts[part].append((f, any(m[1] == 1 for m in marks), any(m[2] == 1 for m in marks)))
    out = []
    for part, documents in parts.items():
        shapley, found = defaultdict(int), []
        for order in permutations(FILTERS):
            left = documents
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                shapley[x] += len(gone)
                found.append((
                    part, "".join(order), step, len(left), len(gone),
                    sum(x in d[0] for d in documents) - len(gone),
                    sum(d[0] == {x} for d in documents),
                    sum(d[1] for d in gone), sum(d[2] for d in gone), x,
                ))
        out += [(*row[:-1], shapley[row[-1]]) for row in found]
    return sorted(out)


def result(frame):
    assert tuple(frame.columns) == module.OUTPUT
    return sorted(tuple(r) for r in frame.collect())


def test_against_filters_in_turn(spark):
    many = " ".join(f"word{i}" for i in range(220))
    few = " ".join(f"word{i % 9}" for i in range(220))
    texts = [many, few, "short", "SHOUT", "a | b", many + " #", few + " &", "", "SHOUT $", many]
    rows = [(i % 47, texts[(i * i) % len(texts)], f"s{i % 3}") for i in range(150)]
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 40, 2)] + [(4, 1, 0), (None, 1, 1), (5, None, None)]
    frame = spark.createDataFrame(
        [(i, t, "en", p, 0) for i, t, p in rows], DOCUMENTS
    ).repartition(7)
    marks = spark.createDataFrame(
        [(a, b, None if c is None else int(c)) for a, b, c in labels], "doc_id long, quality int, toxic int"
    )
    assert result(module.filter_audit(frame, marks)) == brute(rows, labels)


def test_odd_rows(spark, odd_table):
    labels = spark.createDataFrame([(4, 1, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    rows = [(r[0], r[1] or "", r[3] or "") for r in ODD]
    assert result(module.filter_audit(odd_table, labels)) == brute(rows, [(4, 1, 1)])


def test_contraction_against_sums():
    tensor = np.random.default_rng(1).integers(0, 9, (3, 2, 2, 2, 2, 2, 3))
    got = module.contract(tensor, FILTERS, {"A": module.PASS, "D": module.FAIL})
    assert (got == tensor[:, 0, :, :, 1].sum(axis=(1, 2, 3))).all()


@pytest.mark.parametrize("text", ["", "a " * 199, "x" * 3, "É" * 50 + "A", "a\x0bb\x0cc\x1cd"])
def test_long_texts_in_pieces(text, monkeypatch):
    whole = module.text_failures(text.encode())
    monkeypatch.setattr(module, "pieces", lambda raw: re.split(rb"(?<=[ ])", raw))
    assert module.text_failures(text.encode()) == whole
    want = failed([(None, text, "")])[0]
    assert {x for k, x in enumerate("ABCD") if whole >> k & 1} == want


def test_other_numbers_of_filters(spark):
    rows = spark.createDataFrame(
        [("p", 0, 5, 1, 0), ("p", 1, 3, 0, 0), ("p", 3, 2, 0, 1)],
        "part string, fails int, n long, good int, toxic int",
    )
    got = {(r.filter_order, r.step): r for r in module.audit(rows, "XY").collect()}
    assert len(got) == 4
    assert (got["XY", 1].removed, got["XY", 2].removed, got["XY", 2].redundant) == (5, 0, 2)
    assert (got["YX", 1].removed, got["YX", 2].removed, got["YX", 2].unique_fails) == (2, 3, 3)
    assert got["XY", 1].shapley == 8 and got["XY", 1].toxic_lost == 2


def test_equals_sql(equals_sql):
    equals_sql("op13_filter_audit")


def test_empty_tables(spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert module.filter_audit(spark.createDataFrame([], DOCUMENTS), labels).isEmpty()
