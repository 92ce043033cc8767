"""Spelling variants against brute force, and their defined results in odd cases."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from tallystream.llm import spelling
from tests.llm.conftest import ODD

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counts(rows, min_length=7, min_count=2, every=31):
    total = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            total[run] += 1
    return {w: n for w, n in total.items() if len(w) >= min_length and n >= min_count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_pairs(words):
    return sorted((a, b) for a in words for b in words if one_edit(a, b))


def brute(words, ratio=10):
    """Rows (word, form, root, n, n_near, form_n) of counts by word."""
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best and words[best] >= ratio * words[w] else None

    def root(w):
        return root(form[w]) if form[w] else w

    return sorted(
        ((w, form[w], root(w), words[w], len(near[w]), words[form[w]] if form[w] else None) for w in words),
        key=repr,
    )


def vocabulary(seed, lengths, alphabet="aábé", size=300):
    """Words of a small alphabet, many of them one edit apart."""
    draw = random.Random(seed)
    words = set()
    while len(words) < size:
        word = "".join(draw.choices(alphabet, k=draw.choice(lengths)))
        words.add(word)
        place = draw.randrange(len(word))
        words.add(word[:place] + word[place + 1 :])
        words.add(word[:place] + draw.choice(alphabet) + word[place:])
        words.add(word[:place] + draw.choice(alphabet) + word[place + 1 :])
    return sorted(words)


def found_pairs(spark, words):
    frame = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    return sorted((r.word, r.near) for r in spelling.near_words(frame).collect())


@pytest.mark.parametrize("lengths", [range(2, 6), range(7, 10), range(60, 70), [1000]])
def test_pairs_against_brute_force(spark, lengths):
    """Each pair once in each direction, also across the length where segments widen."""
    words = vocabulary(len(lengths), lengths)
    assert found_pairs(spark, words) == brute_pairs(words)


def test_large_blocks_are_split(spark, monkeypatch):
    """Parts of a split block meet once each, and every tile size gives the same pairs."""
    monkeypatch.setattr(spelling, "BLOCK_WORDS", 6)
    monkeypatch.setattr(spelling, "SHORT", 4)
    words = vocabulary(3, range(6, 9), "ab")
    blocks = spelling._blocks(spark.createDataFrame([(w, 2) for w in words], "word string, n long"))
    assert {r.side for r in blocks.select("side").distinct().collect()} == {-1, 0, 1}
    # The workers' tiles are the module's own; only the plan is changed here.
    assert found_pairs(spark, words) == brute_pairs(words)


@pytest.mark.parametrize("tile", [1, 3, 64])
def test_tiles(monkeypatch, tile):
    monkeypatch.setattr(spelling, "TILE", tile)
    words = vocabulary(5, [4], "abc", 60)
    words = [w for w in words if len(w) == 4]
    rows = sorted((w[:2], w) for w in words)
    names = [r[0] for r in rows]
    block = np.array([sorted(set(names)).index(x) for x in names], np.int64)
    ordered = [r[1] for r in rows]
    full = np.full(len(rows), 4), np.full(len(rows), 2), np.full(len(rows), -1)
    i, j = spelling.near_pairs(block, *full, ordered)
    got = sorted((ordered[a], ordered[b]) for a, b in zip(i, j))
    # Segment 2 begins at 2: pairs that differ in the second half; none share an earlier one.
    want = [(a, b) for a, b in brute_pairs(ordered) if a < b and a[:2] == b[:2]]
    assert sorted(tuple(sorted(p)) for p in got) == want


def test_variants_against_brute_force(spark):
    draw = random.Random(11)
    words = [w for w in vocabulary(9, range(7, 10), "abÉx", 80)]
    rows = []
    for i in range(300):
        picked = draw.choices(words, weights=[1000 / (k + 1) ** 1.5 for k in range(len(words))], k=60)
        rows.append((i, " ".join(picked).replace("a", "A", 5)))
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in spelling.spelling_variants(frame).collect()), key=repr)
    want = brute(counts(rows))
    assert got == want
    assert any(r[1] for r in got)


def test_roots_follow_long_chains(spark):
    """Counts grow tenfold at each step, over more steps than one round follows."""
    chain = ["aaaaaaa", "aaaaaab", "aaaaabb", "aaaabbb", "aaabbbb", "aabbbbb"]
    forms = spark.createDataFrame(list(zip(chain, chain[1:])), "word string, form string")
    spelling.shared_checkpoints(spark)
    assert {r.root for r in spelling._roots(forms, 3).collect()} == {chain[-1]}
    text = " ".join(w for k, w in enumerate(chain[:4]) for _ in range(2 * 10**k))
    frame = spark.createDataFrame([(None, text)], "doc_id long, text string")
    rows = spelling.spelling_variants(frame, delete_every=1 << 40).collect()
    assert {r.word: r.root for r in rows} == dict.fromkeys(chain[:4], chain[3])


def test_equals_sql(equals_sql):
    equals_sql("op12_spelling_variants")


def test_odd_rows(spark, odd_table):
    rows = spelling.spelling_variants(odd_table, min_length=1, min_count=1).collect()
    want = brute(counts([r[:2] for r in ODD], 1, 1))
    assert sorted((tuple(r) for r in rows), key=repr) == want


def test_a_long_run_is_not_cut(spark):
    run = "abcdefghij" * 150_000  # longer than a piece, without white space
    frame = spark.createDataFrame([(1, run), (1, run)], "doc_id long, text string")
    words = spelling.word_counts(frame, delete_every=1 << 40).collect()
    assert [(len(r.word), r.n) for r in words] == [(1_500_000, 2)]


def test_empty_table(spark):
    assert spelling.spelling_variants(spark.createDataFrame([], "doc_id long, text string")).isEmpty()
