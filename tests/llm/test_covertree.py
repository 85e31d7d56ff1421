import math

import numpy as np
import pytest

from ordersight.llm import covertree as ct
from ordersight.llm.queries import op10_top_k


def _brute(rows, k=5, step=50):
    """Every row is a candidate of every other row, whatever their ids."""
    whole = [
        (i, [math.floor(256 * float(np.float32(x))) for x in v])
        for i, v in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for n, (q, v) in enumerate(whole):
        if q % step == 0:
            best = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(whole) if m != n)[:k]
            out += [(q, r, i, -s) for r, (s, i) in enumerate(best, 1)]
    return sorted(out)


def _vectors(seed, n, d=16, clusters=6):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, d))
    rows = centres[rng.integers(0, clusters, n)] + rng.normal(size=(n, d)) * 0.3
    return [(int(i), [float(x) for x in v]) for i, v in zip(rng.permutation(2 * n)[:n], rows)]


def _net_size(points, centre, cover):
    """Points of a farthest-first net from ``centre`` that covers all within ``cover``."""
    nearest, n = np.linalg.norm(points - centre, axis=1), 1
    while nearest.max() > cover:
        nearest, n = np.minimum(nearest, np.linalg.norm(points - points[nearest.argmax()], axis=1)), n + 1
    return n


def _assert_cover_tree(t, rows):
    """Centres are points; radii cover; children cover within radius / BASE, lie farther apart, and one keeps the centre."""
    assert sorted(x for node, c in zip(t.points, t.children) if not c for x in node) == list(range(len(rows)))
    for node, (points, children) in enumerate(zip(t.points, t.children)):
        assert np.all(np.linalg.norm(rows[points] - t.centres[node], axis=1) <= t.radii[node] + 1e-6)
        assert (rows[points] == t.centres[node]).all(1).any()
        if children:
            cover = t.radii[node] / ct.BASE
            assert np.all(t.radii[children] <= cover + 1e-6)
            centres = t.centres[children]
            apart = np.linalg.norm(centres[:, None] - centres[None], axis=2) + np.eye(len(children)) * 1e18
            assert apart.min() > cover - 1e-6
            assert (centres == t.centres[node]).all(1).any()
        else:
            assert len(points) <= ct.LEAF or t.radii[node] == 0 or _net_size(rows[points], t.centres[node], t.radii[node] / ct.BASE) > ct.FAN


@pytest.mark.parametrize("seed,n,d", [(1, 300, 3), (2, 900, 16), (3, 900, 64)])
def test_dual_search_equals_brute_force_and_prunes(seed, n, d, monkeypatch):
    monkeypatch.setattr(ct, "LEAF", 16)
    rng = np.random.default_rng(seed)
    rows = np.floor(256 * np.array([v for _, v in _vectors(seed, n, d)])).astype(np.int64)
    rows[: n // 10] = rows[0]  # ties
    ids = rng.permutation(n).astype(np.int64)
    q, t = ct.CoverTree(ids[::7], rows[::7]), ct.CoverTree(ids, rows)
    _assert_cover_tree(t, rows)
    best = ct.TopK(len(q.ids), 5)
    compared = ct.search(q, t, best)
    for i, (qid, v) in enumerate(zip(q.ids, q.rows)):
        want = sorted((-int(s), int(j)) for s, j in zip(rows @ v, ids) if j != qid)[:5]
        assert [(-int(s), int(j)) for s, j in zip(best.scores[i], best.ids[i])] == want
    leaves = [sum(not c for c in x.children) for x in (q, t)]
    assert compared <= leaves[0] * leaves[1]
    if d == 3:
        assert compared < 0.75 * leaves[0] * leaves[1]


@pytest.mark.parametrize("block", [4096, 64])
def test_query_equals_brute_force(spark, tmp_path, block, monkeypatch):
    monkeypatch.setattr(ct, "BLOCK", block)
    monkeypatch.setattr(ct, "QUERY_BLOCK", max(4, block // 16))
    rows = _vectors(5, 1500)
    same = rows[10][1]
    rows += [(5000 + i, same) for i in range(200)]
    rows += [(9000, None), (9001, [1.0, None]), (9050, [float("nan")] * 16), (9100, [float("inf")] + [0.0] * 15), (9150, [0.0] * 16), (9200, [1.0, -2.0]), (9250, []), (None, same), (5000, same), (-50, [0.5] * 16)]
    spark.createDataFrame([(*r, 1, "z") for r in rows], "vec_id long, embedding array<float>, score int, pivot string").repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    got = op10_top_k(spark, str(tmp_path))
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == _brute(rows)


@pytest.mark.parametrize("rows", [[], [(50, [1.0, 2.0])], [(50, [1.0]), (3, [2.0]), (100, [-1.0])], [(7, [1.0])], [(50, [1.0]), (3, [1.0]), (3, [2.0]), (4, [0.5])], [(50, [1.0]), (50, [2.0]), (50, [2.0]), (3, [1.0])]])
def test_tiny_tables(spark, tmp_path, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert sorted(map(tuple, op10_top_k(spark, str(tmp_path)).collect())) == _brute(rows)
