"""Exact top-k by inner product: cover trees over queries and data, searched together.

Vectors are dealt to blocks of bounded size around pivots, and each block, of
data or of queries, gets a cover tree. For a query node with centre ``p`` and
covering radius ``a`` and a data node with centre ``c`` and radius ``b`` no inner
product exceeds ``p.c + |p| b + |c| a + a b``, nor what the same says of their means
and spreads. A pair of nodes is pruned when that is below the worst kth score of the node's queries; equal scores are kept, as
ties go by id. The same bound prunes pairs of whole blocks: each query block
first meets the data block around its own pivot, which sets its worst kth
score, then only those blocks that may still hold better ones.
"""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from ordersight.llm.common import hashed_sample, stored

#: Vectors of one block (data, queries), of one leaf, and pivots that seed the blocks.
BLOCK = 4096
QUERY_BLOCK = 2048
LEAF = 96
PIVOTS = 32
#: Vectors among which the pivots are chosen, at most.
PIVOT_SAMPLE = 1024
#: The children of a node cover it within its radius divided by this, and lie farther apart than that.
BASE = 1.3
#: Points that would need a net of more than FAN have no structure at this scale: they stay one leaf.
FAN = 64
#: No score (its negative is a long too), no id.
NONE, NO_ID = -(2**63 - 1), 2**63 - 1


# -- trees ----------------------------------------------------------------------


class CoverTree:
    """Nodes with a centre, a covering radius, children and, at the leaves, rows.

    Centres are points. The children of a node of radius r form a net of its
    points: its own centre, then always the point farthest from the net, until
    all lie within r / BASE of it. So children cover their node within that
    distance (covering), their centres are farther apart (separation), one of
    them has the node's centre (nesting), and each point belongs to the nearest.
    A node with at most LEAF rows, of radius 0 or with a net of over FAN points
    is a leaf, whose rows are compared by one matrix product. The mean of a
    node's points and their spread around it bound scores as well, often closer.
    """

    def __init__(self, ids: np.ndarray, rows: np.ndarray, keys: np.ndarray | None = None):
        #: ``keys`` tell rows apart that share an id.
        self.ids, self.rows, self.keys = ids, rows, ids if keys is None else keys
        self.points: list[np.ndarray] = []
        self.children: list[list[int]] = []
        centre: list[np.ndarray] = []
        radius: list[float] = []
        mean: list[np.ndarray] = []
        spread: list[float] = []
        exact = rows.astype(np.float64)
        stack = []
        if len(ids):
            middle = exact.mean(0)
            stack = [(np.arange(len(ids)), int(((exact - middle) ** 2).sum(1).argmin()), -1)]
        while stack:
            at, first, parent = stack.pop()
            if parent >= 0:
                self.children[parent].append(len(self.points))
            points = exact[at]
            far = np.sqrt(((points - exact[first]) ** 2).sum(1))
            centre.append(exact[first])
            radius.append(float(far.max()))
            mean.append(points.mean(0))
            spread.append(float(np.sqrt(((points - mean[-1]) ** 2).sum(1).max())))
            self.points.append(at)
            self.children.append([])
            if len(at) > LEAF and radius[-1] > 0:
                node = len(self.points) - 1
                picks, owner = self._net(points, far, int(np.flatnonzero(at == first)[0]), radius[-1] / BASE)
                if len(picks) <= FAN:
                    stack += [(at[owner == k], int(at[pick]), node) for k, pick in enumerate(picks)]
        self.centres = np.array(centre).reshape(len(centre), -1)
        self.radii = np.array(radius)
        self.norms = np.sqrt((self.centres**2).sum(1))
        self.means = np.array(mean).reshape(len(mean), -1)
        self.spreads = np.array(spread)
        self.mean_norms = np.sqrt((self.means**2).sum(1))

    @staticmethod
    def _net(points: np.ndarray, far: np.ndarray, first: int, cover: float) -> tuple[list[int], np.ndarray]:
        """The net points, and for each point the number of the one that it is nearest to; ``far``: distances to ``first``."""
        picks, nearest, owner = [first], far.copy(), np.zeros(len(points), np.int64)
        while nearest.max() > cover and len(picks) <= FAN:
            pick = int(nearest.argmax())
            d = np.sqrt(((points - points[pick]) ** 2).sum(1))
            owner[d < nearest] = len(picks)
            nearest = np.minimum(nearest, d)
            picks.append(pick)
        return picks, owner

    @property
    def width(self) -> int:
        return self.rows.shape[1]

    def widened(self, width: int) -> CoverTree:
        """The same tree with zeros for missing components."""
        if self.width == width:
            return self
        return CoverTree(self.ids, np.pad(self.rows, ((0, 0), (0, width - self.width))), self.keys)


class TopK:
    """The k best (score, id) of each query so far; ties go to the smaller id.

    ``floor`` is a score that each query is known to reach k times elsewhere.
    """

    def __init__(self, queries: int, k: int, floor: np.ndarray | None = None):
        self.scores = np.full((queries, k), NONE)
        self.ids = np.full((queries, k), NO_ID)
        self.floor = np.full(queries, -np.inf) if floor is None else floor
        self.worst = self.floor.copy()

    def offer(self, at: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` (queries x candidates) for the queries ``at``; NONE is not a candidate."""
        wanted = (scores >= self.worst[at][:, None]) & (scores != NONE)
        for row in np.flatnonzero(wanted.any(1)).tolist():
            q = at[row]
            new = np.flatnonzero(wanted[row])
            all_scores = np.concatenate([self.scores[q], scores[row, new]])
            all_ids = np.concatenate([self.ids[q], ids[new]])
            order = np.lexsort((all_ids, -all_scores))[: self.scores.shape[1]]
            self.scores[q], self.ids[q] = all_scores[order], all_ids[order]
            if self.ids[q, -1] != NO_ID:
                self.worst[q] = max(self.floor[q], float(self.scores[q, -1]))


def _products(q: CoverTree, qa: np.ndarray, d: CoverTree, da: np.ndarray) -> np.ndarray:
    """Exact integer inner products; through floats only where they are exact."""
    a, b = q.rows[qa].astype(np.float64), d.rows[da].astype(np.float64)
    if np.abs(a).sum(1).max(initial=0) * np.abs(b).max(initial=0) < 2**52:
        return (a @ b.T).astype(np.int64)
    return q.rows[qa].astype(np.int64) @ d.rows[da].T.astype(np.int64)


def search(q: CoverTree, d: CoverTree, best: TopK) -> int:
    """Dual-tree search of all queries of ``q`` in ``d``; returns how many leaf pairs were compared."""
    if not len(q.ids) or not len(d.ids):
        return 0

    def bounds(a: int, nodes: list[int]) -> np.ndarray:
        """No score of a query in ``a`` and a row in one of ``nodes`` exceeds these."""
        c, r, n = d.centres[nodes], d.radii[nodes], d.norms[nodes]
        cover = c @ q.centres[a] + q.norms[a] * r + q.radii[a] * n + q.radii[a] * r
        m, s, l = d.means[nodes], d.spreads[nodes], d.mean_norms[nodes]
        around = m @ q.means[a] + q.mean_norms[a] * s + q.spreads[a] * l + q.spreads[a] * s
        exact = np.minimum(cover, around)
        return exact + 1e-9 * (1 + np.abs(exact) + q.norms[a] * n)

    compared, count = 0, 0
    heap = [(-float(bounds(0, [0])[0]), 0, 0, 0)]
    while heap:
        up, _, a, b = heapq.heappop(heap)
        if -up < best.worst[q.points[a]].min():
            continue
        # Open the wider node first; compare when both are leaves.
        if d.children[b] and (not q.children[a] or d.radii[b] * max(q.norms[a], 1) >= q.radii[a] * max(d.norms[b], 1)):
            nodes = d.children[b]
            pairs = [(float(x), a, n) for x, n in zip(bounds(a, nodes), nodes)]
        elif q.children[a]:
            pairs = [(float(bounds(c, [b])[0]), c, b) for c in q.children[a]]
        else:
            at, of = q.points[a], d.points[b]
            scores = _products(q, at, d, of)
            scores[q.keys[at][:, None] == d.keys[of][None, :]] = NONE
            best.offer(at, scores, d.ids[of])
            compared += 1
            continue
        for x, m, n in pairs:
            if x >= best.worst[q.points[m]].min():
                count += 1
                heapq.heappush(heap, (-x, count, m, n))
    return compared


# -- Spark --------------------------------------------------------------------------


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, key, v): floor(scale * x) of every component, as longs; ``key`` tells rows apart.

    Vectors that are null, or hold null or non-finite components, and rows
    without an id are left out. Rows that share an id all count. Store the
    result before use, so that each row keeps its key.
    """
    ok = F.col("x").isNotNull() & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("x")).filter(F.col("id").isNotNull() & F.coalesce(ok, F.lit(False)))
    return rows.select("id", F.monotonically_increasing_id().alias("key"), F.transform("x", lambda c: F.floor(c * F.lit(scale))).alias("v"))


def _padded(vectors) -> np.ndarray:
    """Rows of equal length: a missing component counts as 0."""
    width = max((len(v) for v in vectors), default=0)
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def pivots(rows: DataFrame, n: int = PIVOTS, sample: int = PIVOT_SAMPLE) -> np.ndarray:
    """Up to ``n`` far-apart vectors among the ``sample`` with the smallest id hashes."""
    got = sorted(hashed_sample(rows.select("id", "v"), ["id", "v"], sample).collect(), key=lambda r: (r["id"], r["v"]))
    points = _padded([r["v"] for r in got]).astype(np.float64)
    if not len(points):
        return points
    chosen, nearest = [0], ((points - points[0]) ** 2).sum(1)
    while len(chosen) < min(n, len(points)) and nearest.max() > 0:
        chosen.append(int(nearest.argmax()))
        nearest = np.minimum(nearest, ((points - points[chosen[-1]]) ** 2).sum(1))
    return points[chosen]


def _near_pivot(centres: np.ndarray):
    @F.pandas_udf(LongType())
    def near(v: pd.Series) -> pd.Series:
        if not len(v) or not len(centres):
            return pd.Series(np.zeros(len(v), np.int64))
        rows = _padded(v.tolist()).astype(np.float64)
        width = max(rows.shape[1], centres.shape[1])
        rows, c = (np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (rows, centres))
        return pd.Series(((c**2).sum(1) - 2 * rows @ c.T).argmin(1))

    return near


_BLOCK = "pivot long, part long, size long, centre array<double>, radius double, tree binary"


def _blocks(rows: DataFrame, most: int) -> DataFrame:
    """Blocks of about ``most`` rows of one pivot at most, each with its tree; a crowded pivot fills several, by row hash."""
    sizes = rows.groupBy("pivot").agg(F.ceil(F.count(F.lit(1)) / most).alias("parts"))
    placed = rows.join(sizes, "pivot").withColumn("part", F.pmod(F.xxhash64("key"), F.col("parts")))

    def pack(block: pa.Table) -> pa.Table:
        ids, keys = (block.column(c).to_numpy().astype(np.int64) for c in ("id", "key"))
        order = np.lexsort((keys, ids))
        matrix = _padded(block.column("v").to_pylist())[order]
        small = next(t for t in (np.int16, np.int32, np.int64) if not len(matrix) or np.iinfo(t).min <= matrix.min(initial=0) and matrix.max(initial=0) <= np.iinfo(t).max)
        tree = CoverTree(ids[order], matrix.astype(small), keys[order])
        columns = {"size": [len(ids)], "centre": pa.array([tree.means[0].tolist()], pa.list_(pa.float64())), "radius": [float(tree.spreads[0])], "tree": pa.array([pickle.dumps(tree)], pa.binary())}
        return pa.table({"pivot": block.column("pivot")[:1], "part": block.column("part")[:1], **columns})

    return placed.select("pivot", "part", "id", "key", "v").groupBy("pivot", "part").applyInArrow(pack, _BLOCK)


def _searched(pairs: DataFrame, k: int) -> DataFrame:
    """Up to k results (query, query_id, vec_id, score) per query row and pair of blocks: (query, floors, data)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for query, floors, data in zip(*batch.columns):
                q, d = pickle.loads(query.as_buffer()), pickle.loads(data.as_buffer())
                width = max(q.width, d.width)
                known = dict(floors.as_py() or [])
                best = TopK(len(q.ids), k, np.array([known.get(i, -np.inf) for i in q.keys.tolist()], np.float64))
                search(q.widened(width), d.widened(width), best)
                row, col = np.nonzero(best.ids != NO_ID)
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q.keys[row], q.ids[row], best.ids[row, col], best.scores[row, col])], names=["query", "query_id", "vec_id", "score"])

    return pairs.select("query", "floors", "data").mapInArrow(run, "query long, query_id long, vec_id long, score long")


def _bound() -> Column:
    """No inner product of a query of the block (c, r) and a vector of the block (centre, radius) exceeds this."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda a, b: F.coalesce(a * b, F.lit(0.0))), F.lit(0.0), lambda s, v: s + v)
    norm = lambda x: F.sqrt(dot(x, x))
    exact = dot("c", "centre") + norm("c") * F.col("radius") + norm("centre") * F.col("r") + F.col("r") * F.col("radius")
    return exact + 1e-9 * (1 + F.abs(exact) + norm("c") * norm("centre"))


def top_k(df: DataFrame, id_col: str, vec_col: str, is_query: Callable[[Column], Column], k: int, scale: float = 256.0) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products of each query with all other vectors.

    Components count as floor(scale * x). ``is_query`` tells queries by their
    id. Every row but the query's own is a candidate, also rows of the same id;
    rows that share a query id are queries of their own. Equal scores rank by the
    smaller id; a query with fewer than k other vectors gets them all; see
    ``whole_vectors`` for rows that take no part.
    Shorter vectors are filled up with zeros. Empty tables give no rows.
    Block pairs are formed from the blocks' centres and radii alone, and only
    those that the bound leaves are joined with the vectors.
    """
    rows = stored(whole_vectors(df, id_col, vec_col, scale), "topk-vectors")
    placed = stored(rows.withColumn("pivot", _near_pivot(pivots(rows))("v")), "topk-placed")
    data = stored(_blocks(placed, BLOCK).withColumnRenamed("tree", "data"), "topk-data")
    queries = _blocks(placed.filter(is_query(F.col("id"))), QUERY_BLOCK)
    queries = stored(queries.select(F.col("pivot").alias("qp"), F.col("part").alias("qn"), F.col("size").alias("n"), F.col("centre").alias("c"), F.col("radius").alias("r"), F.col("tree").alias("query")), "topk-queries")
    floor = "map<bigint,bigint>"

    home = (F.col("qp") == F.col("pivot")) & (F.col("part") == 0)
    first = queries.join(data, home).withColumn("floors", F.lit(None).cast(floor))
    near = stored(_searched(first, k), "topk-near")

    reached = near.groupBy("query").agg(F.count(F.lit(1)).alias("m"), F.min("score").alias("floor")).filter(F.col("m") == k)
    own = placed.filter(is_query(F.col("id"))).select(F.col("key").alias("query"), F.col("pivot").alias("qp"))
    parts = queries.groupBy("qp").agg(F.count(F.lit(1)).alias("qparts"))
    own = own.join(parts, "qp").select("query", "qp", F.pmod(F.xxhash64("query"), F.col("qparts")).alias("qn"))
    floors = own.join(reached, "query").groupBy("qp", "qn").agg(F.map_from_entries(F.collect_list(F.struct("query", "floor"))).alias("floors"), F.min("floor").alias("least"), F.count(F.lit(1)).alias("known"))
    groups = queries.join(floors, ["qp", "qn"], "left").withColumn("least", F.when(F.col("known") == F.col("n"), F.col("least")))

    meet = groups.select("qp", "qn", "c", "r", "least").crossJoin(data.select("pivot", "part", "centre", "radius"))
    left = meet.filter(~home & (F.col("least").isNull() | (_bound() >= F.col("least")))).select("qp", "qn", "pivot", "part")
    far = left.join(groups.select("qp", "qn", "query", "floors"), ["qp", "qn"]).join(data.select("pivot", "part", "data"), ["pivot", "part"])
    found = near.union(_searched(far, k))
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
