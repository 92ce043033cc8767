"""URL filters by a cascade of Bloom filters.

A rule list is a set of keys (host and start of a path). The universe is every
key that a URL of the corpus can match: its host and parent hosts with the
starts of its path that are as long as some rule's path. Level 0 encodes the
listed keys; level 1 the unlisted keys of the universe that level 0 lets
through; level 2 the listed keys that level 1 lets through; and so on until no
key is wrong. Membership is then exact for the universe, with a few bits per
listed key and no join.

The corpus is only filtered against level 0 in the tasks; what passes is about
as large as the list, whose size is checked. Null URLs and URLs without ``://``
have an empty host and path and match no rule. Where no rule fits, the verdict
is allow: the method found no listed key. Repeated pages each get a row. Only
page_id and url are read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallystream.llm.texts import mix

MAX_LISTED = 1_000_000


def key_hash(key: str) -> int:
    return int.from_bytes(hashlib.blake2b(key.encode(), digest_size=8).digest(), "little")


class Bloom:
    def __init__(self, hashes: np.ndarray, bits_per_key: float, level: int = 0):
        self.salt = mix(np.array([level + 1]))[0]
        self.count = max(1, round(bits_per_key * math.log(2)))
        self.size = max(64, math.ceil(len(hashes) * bits_per_key))
        self.bits = np.zeros(self.size, np.bool_)
        for place in self._places(hashes):
            self.bits[place] = True
        self.bits = np.packbits(self.bits)

    def _places(self, hashes: np.ndarray) -> Iterator[np.ndarray]:
        start = mix(hashes ^ self.salt)
        for k in range(self.count):
            yield mix(start + np.uint64(k)) % np.uint64(self.size)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        found = np.ones(len(hashes), np.bool_)
        for place in self._places(hashes):
            bit = np.uint8(0x80) >> (place & np.uint64(7)).astype(np.uint8)
            found &= (self.bits[place >> np.uint64(3)] & bit) != 0
        return found


class Cascade:
    """Exact membership for the keys of the universe it was built over."""

    def __init__(self, listed: np.ndarray, passed: np.ndarray, first: Bloom):
        """``passed``: the unlisted keys of the universe that the first level lets through."""
        self.levels, encoded, other = [first], passed, listed
        while len(encoded):
            level = Bloom(encoded, 3.0, len(self.levels))
            self.levels.append(level)
            encoded, other = other[level.has(other)], encoded

    def has(self, hashes: np.ndarray) -> np.ndarray:
        """A key that stops at an even level is unlisted, at an odd one listed; a key
        that passes all is of the kind that the last level encodes."""
        found = np.full(len(hashes), len(self.levels) % 2 == 1)
        left = np.arange(len(hashes))
        for depth, level in enumerate(self.levels):
            inside = level.has(hashes[left])
            found[left[~inside]] = depth % 2 == 1
            left = left[inside]
        return found


def split_rule(rule: str) -> tuple[str, str]:
    """Host and path of a rule such as ``example.net/en/``."""
    host, slash, path = rule.partition("/")
    return host.lower(), slash + path


def candidates(host: str, path: str, depths: int, lengths: Iterable[int]) -> list[str]:
    """Keys that a URL can match: hosts of up to ``depths`` labels, starts of the path."""
    if not host:
        return []
    labels = host.split(".")
    hosts = [".".join(labels[-k:]) for k in range(1, min(depths, len(labels)) + 1)]
    return [h + path[:n] for h in hosts for n in lengths if n <= len(path)]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, in SQL functions."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), upper, lower)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return host, path


def build(pages: DataFrame, listed: Iterable[str], depths: int, lengths: list[int]) -> Cascade:
    """The cascade of a list over all keys of the pages (columns host and path)."""
    keys = sorted(set(listed))
    if len(keys) > MAX_LISTED:
        raise ValueError(f"more than {MAX_LISTED} listed keys: split the list")
    inside = np.array([key_hash(k) for k in keys], np.uint64)
    known = set(inside.tolist())
    bits = 16.0
    while True:
        first = Bloom(inside, bits)

        def run(batches: Iterator[pa.RecordBatch], first=first) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
                found = {key_hash(k) for hp in set(zip(hosts, paths)) for k in candidates(*hp, depths, lengths)}
                hashes = np.fromiter(found, np.uint64, len(found))
                passed = set(hashes[first.has(hashes)].tolist()) - known
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.fromiter(passed, np.uint64, len(passed)).view(np.int64))], ["h"]
                )

        wrong = pages.mapInArrow(run, "h long").distinct().limit(4 * MAX_LISTED + 1).collect()
        if len(wrong) <= 4 * MAX_LISTED:
            break
        bits *= 1.5  # too many keys passed: a sharper first level, over the whole universe again
    return Cascade(inside, np.array([r.h for r in wrong], np.int64).view(np.uint64), first)


def url_verdicts(pages: DataFrame, rules: Iterable[tuple[str, str]]) -> DataFrame:
    """Per page: page_id, host, path, the longest rule that fits and the verdict.

    ``rules``: (verdict, rule) pairs, such as ``("block", "net/")``. Of equally
    long rules that fit, block wins, then the first by name.
    """
    rules = sorted(set(rules))
    split = {rule: split_rule(rule) for _, rule in rules}
    depths = max((len(h.split(".")) for h, _ in split.values()), default=0)
    lengths = sorted({len(p) for _, p in split.values()})
    host, path = host_and_path(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long"), host.alias("host"), path.alias("path"))
    spelled = {"".join(split[rule]): rule for _, rule in rules}
    keys = parts.select("host", "path")
    cascades = [
        (verdict, build(keys, ["".join(split[r]) for v, r in rules if v == verdict], depths, lengths))
        for verdict in ("block", "allow")
    ]

    def judge(found: list[str]) -> tuple[str | None, str]:
        hashes = np.array([key_hash(k) for k in found], np.uint64)
        best: tuple | None = None
        for rank, (verdict, cascade) in enumerate(cascades):
            for k in np.flatnonzero(cascade.has(hashes)):
                if found[k] not in spelled:  # its 64-bit hash is that of a listed key
                    continue
                order = (-len(found[k]), rank, found[k], verdict)
                best = order if best is None or order < best else best
        return (None, "allow") if best is None else (spelled[best[2]], best[3])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths = (batch.column(c).to_pylist() for c in ("host", "path"))
            known: dict[tuple, tuple] = {}
            out = []
            for h, p in zip(hosts, paths):
                found = tuple(candidates(h, p, depths, lengths))
                if found not in known:
                    known[found] = judge(list(found)) if found else (None, "allow")
                out.append(known[found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.string())],
                "page_id host path rule verdict".split(),
            )

    return parts.mapInArrow(
        run, "page_id long, host string, path string, rule string, verdict string"
    )
