"""The manifest equals a tree built list by list, for any fan, group sizes, nulls and repeated rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from ordersight.llm import merkle
from ordersight.llm.queries import op11_merkle

from ..conftest import SF_SMALL

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def _sha(*parts: str) -> str:
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def _leaf(row: dict) -> str:
    return _sha(*("-" if row[f] is None else f"{len(str(row[f]).encode())}:{row[f]}" for f in FIELDS))


def _tree(hashes: list[str], fan: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """(the last hash, for each leaf the text left and right of it level by level)."""
    steps: list[list[tuple[str, str]]] = [[] for _ in hashes]
    under = [[i] for i in range(len(hashes))]
    while len(hashes) > 1:
        up, up_under = [], []
        for at in range(0, len(hashes), fan):
            run = hashes[at : at + fan]
            for k in range(len(run)):
                for i in under[at + k]:
                    steps[i].append(("".join(run[:k]), "".join(run[k + 1 :])))
            up.append(_sha(*run))
            up_under.append([i for u in under[at : at + fan] for i in u])
        hashes, under = up, up_under
    return hashes[0], steps


def brute(rows: list[dict], fan: int = 8) -> list[tuple]:
    groups = defaultdict(list)
    for r in rows:
        groups[r["lang"]].append(r)
    least = -(2**63)
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    tops, below = [], {}
    for g in order:
        groups[g].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] if r["doc_id"] is not None else least, _leaf(r)))
        top, steps = _tree([_leaf(r) for r in groups[g]], fan)
        tops.append(top)
        below[g] = steps
    if not tops:
        return []
    root, above = _tree(tops, fan)
    out = []
    for g, sub, up in zip(order, tops, above):
        for r, own in zip(groups[g], below[g]):
            path = own + up
            text = r["text"]
            if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            h = _leaf(r | {"text": text})
            for left, right in path:
                h = _sha(left, h, right)
            out.append((r["doc_id"], _leaf(r), sub, root, _sha(*(x for step in path for x in step)), h, h == root))
    return sorted(out, key=str)


def _got(df, fan: int = 8) -> list[tuple]:
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return sorted((tuple(r) for r in merkle.manifest(df, "doc_id", "lang", FIELDS, "text", tampered, fan).collect()), key=str)


def _documents(n: int) -> list[dict]:
    langs = ["en"] * 7 + ["de", None, ""]
    return [
        {"doc_id": i * 3 if i % 17 else None, "text": [f"Text {i} ÄB", None, "", "abc"][i % 4], "lang": langs[i % 10], "source": None if i % 5 == 0 else f"s{i % 3}", "n_chars": i if i % 6 else None}
        for i in range(n)
    ]


@pytest.mark.parametrize("fan, n", [(8, 1), (8, 700), (2, 40)])
def test_equals_lists(spark, fan, n):
    rows = _documents(n)
    assert _got(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA), fan) == brute(rows, fan)


def test_repeated_rows_and_ids_and_clashing_columns(spark):
    rows = _documents(30) * 3 + [{"doc_id": 3, "text": "other", "lang": "en", "source": "x", "n_chars": 1}]
    df = spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA)
    df = df.withColumns({c: F.lit("mine") for c in ("leaf", "root", "hash", "idx", "grp", "n", "path", "id", "tie")})
    assert _got(df) == brute(rows)


def test_empty_table(spark):
    assert _got(spark.createDataFrame([], SCHEMA)) == []


def test_very_long_text_and_a_change_in_it(spark):
    rows = [{"doc_id": i, "text": "Ab" * 500_000 + str(i), "lang": "en", "source": "s", "n_chars": 1} for i in range(9)]
    got = _got(spark.createDataFrame([tuple(r.values()) for r in rows], SCHEMA))
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


def test_query_over_its_table(spark):
    rows = [r.asDict() for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()]
    got = op11_merkle(spark, SF_SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)
