"""Fingerprints bit by bit, links and classes against all pairs."""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from ordersight.llm import simhash
from ordersight.llm.queries import op12_simhash

from ..conftest import SF_SMALL


def plain_fingerprint(text: str | None) -> int:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_classes(fps: list[int], radius: int = 3) -> dict[int, int]:
    """Fingerprint -> least fingerprint of its class, by all pairs."""
    fps = sorted(set(fps))
    arr, label = np.array(fps, np.uint64), list(range(len(fps)))

    def top(i: int) -> int:
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(arr[i + 1 :] ^ arr[i]) <= radius).tolist():
            x, y = sorted((top(i), top(i + 1 + j)))
            label[y] = x
    return {f: fps[top(i)] for i, f in enumerate(fps)}


def plain(rows: list[tuple]) -> list[tuple]:
    fps = [plain_fingerprint(t) for _, t in rows]
    of = plain_classes(fps)
    least = defaultdict(list)
    for (i, _), f in zip(rows, fps):
        if i is not None:
            least[of[f]].append(i)
    return sorted(((i, f"{f:016x}", min(least[of[f]], default=None)) for (i, _), f in zip(rows, fps)), key=str)


def _got(df) -> list[tuple]:
    return sorted((tuple(r) for r in simhash.near_duplicates(df, "doc_id", "text").collect()), key=str)


@pytest.mark.parametrize("text", [None, "", " \t\n", "One", "one TWO", "a b c", "A b c d e", "Ä ä x y", "x\x0by\x0cz w", "no break here now", "a " * 1000, "words of one"])
def test_fingerprint(text):
    assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_fingerprint_of_a_very_long_text(monkeypatch):
    text = " ".join(f"w{i * 7919 % 1013}" for i in range(5000))
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "SHINGLES", 64)
    assert simhash.fingerprint(text) == whole == plain_fingerprint(text)


def _ball(centre: int, n: int, flips: int, seed: int) -> list[int]:
    rng = np.random.default_rng(seed)
    out = set()
    while len(out) < n:
        f = centre
        for b in rng.choice(64, rng.integers(0, flips + 1), replace=False):
            f ^= 1 << int(b)
        out.add(f)
    return sorted(out)


def _fingerprints(seed: int = 7) -> list[int]:
    rng = np.random.default_rng(seed)
    spread = [int(x) for x in rng.integers(0, 2**64, 800, np.uint64)]
    near = [f ^ sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for f in spread[:300] for k in (2, 3, 4)]
    return sorted(set(spread + near + _ball(0, 400, 8, 1) + _ball(spread[0], 500, 3, 2) + _ball(spread[1], 300, 12, 3)))


def test_trees_find_all_that_is_within_the_radius():
    fps = np.array(_fingerprints(), np.uint64)
    shard = np.sort(np.arange(len(fps)) % 3)
    a, b = simhash.Forest(shard, fps).within(np.arange(len(fps)), 3)
    got = set(zip(a.tolist(), b.tolist()))
    want = {(i, j) for i in range(len(fps)) for j in np.flatnonzero((np.bitwise_count(fps[:i] ^ fps[i]) <= 3) & (shard[:i] == shard[i])).tolist()}
    assert got == want and len(got) == len(a)


def test_shards_are_bounded_and_no_link_is_lost(spark):
    fps = _fingerprints()
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    placed = simhash.shards(df, size=256).collect()
    members = defaultdict(set)
    for r in placed:
        members[r["mask"], r["part"]].add(r["fp"] % 2**64)
    assert max(map(len, members.values())) <= 256 and min(map(len, members.values())) > 1
    together = defaultdict(set)
    for some in members.values():
        for f in some:
            together[f] |= some
    arr = np.array(fps, np.uint64)
    for f in fps:
        near = {int(x) for x in arr[np.bitwise_count(arr ^ np.uint64(f)) <= 3]}
        assert near <= together[f] | {f}

    found = [(a % 2**64, b % 2**64) for a, b in simhash.links(simhash.shards(df, size=256)).collect()]
    assert all((a ^ b).bit_count() for a, b in found)
    label = {f: f for f in fps}

    def top(f: int) -> int:
        while label[f] != f:
            f = label[f]
        return f

    for a, b in found:
        x, y = sorted((top(a), top(b)))
        label[y] = x
    assert {f: top(f) for f in fps} == plain_classes(fps)


def test_classes_with_nulls_copies_and_clashing_columns(spark):
    base = " ".join(f"word{i}" for i in range(300))
    rows = [(i, base + f" end{i % 4}") for i in range(40)] + [(100, None), (101, ""), (102, " \n"), (None, "alone in null"), (103, "one"), (104, "ONE"), (None, base), (5, "same id other text"), (5, "same id other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    df = df.withColumns({c: F.lit("mine") for c in ("id", "fp", "n", "mask", "component", "fingerprint", "component_id", "node")})
    assert _got(df) == plain(rows)


def test_a_fingerprint_with_a_third_of_the_rows(spark):
    rows = [(i, "the same text again" if i % 3 == 0 else f"text {i} of its own {i * 31 % 97}") for i in range(3000, 0, -1)]
    assert _got(spark.createDataFrame(rows, "doc_id long, text string")) == plain(rows)


def test_empty_table(spark):
    assert _got(spark.createDataFrame([], "doc_id long, text string")) == []


def test_query_over_its_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = op12_simhash(spark, SF_SMALL)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain(rows)
