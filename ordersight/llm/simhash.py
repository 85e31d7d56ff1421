"""SimHash near-duplicates: 64-bit fingerprints linked through BK-trees of bounded shards.

A text's fingerprint is the bitwise majority of its shingles' hashes. Texts are
linked when their fingerprints differ in at most ``RADIUS`` bits, and a class is
what links connect.

Each shard of fingerprints gets a BK-tree: the children of a node are keyed by
their integer Hamming distance to it, and a search follows only the edges whose
key is within the radius of the query's own distance. Which trees a fingerprint
must search follows from the pigeonhole principle: of ``RADIUS + 1`` parts of the
bits, two fingerprints within the radius agree in one part at least. So a shard
holds the fingerprints that agree in a part, and its tree is handed only to the
queries of that part. A shard that outgrows ``SHARD`` is parted again by its
remaining bits, which loses no link either, until it fits: with at most
log2(SHARD) free bits it always does. So no tree, no task and no group of
queries grows with the data, and no pairs of a group are listed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersight.llm.common import stored
from ordersight.llm.neardup import components

RADIUS = 3
WORDS = 3
SEED = 42
#: Fingerprints of one tree, a power of two; and of one set of trees built together.
SHARD = 8192
FOREST = 16_384
#: Queries that walk the trees at the same time, and shingles counted at once.
WALKERS = 512
SHINGLES = 65_536
#: A key that holds more than one in HOT rows is joined apart; there are at most HOT of them.
HOT = 1000


# -- fingerprints ---------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """The unsigned 64-bit fingerprint; 0 for a text without words."""
    # Lower-casing and splitting bytes touches A-Z and ASCII blanks only.
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    last = max(len(words) - WORDS, 0)
    ones = np.zeros(64, np.int64)
    for start in range(0, last + 1, SHINGLES):
        hashes = np.fromiter(
            (xxhash.xxh64_intdigest(b" ".join(words[i : i + WORDS]), SEED) for i in range(start, min(start + SHINGLES, last + 1))),
            np.dtype(">u8"),
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > last + 1).tobytes(), "big")


def fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, fp) of every row of ``df``; ``fp`` holds the 64 bits as a long."""
    rows = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([fingerprint(t) for t in batch.column(1).to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found.view(np.int64))], names=["id", "fp"])

    return rows.mapInArrow(run, f"id {rows.schema['id'].dataType.simpleString()}, fp long")


# -- shards ---------------------------------------------------------------------


def _signed(bits: int) -> int:
    return bits - (1 << 64) if bits >> 63 else bits


def parted(mask: int) -> list[int]:
    """``mask`` with each of ``RADIUS + 1`` parts of its free bits added."""
    free = [b for b in range(64) if not mask >> b & 1]
    cuts = [len(free) * i // (RADIUS + 1) for i in range(RADIUS + 2)]
    return [mask | sum(1 << b for b in free[x:y]) for x, y in zip(cuts, cuts[1:])]


def _by_key(rows: DataFrame, counted: DataFrame, on: list[str], total: int) -> DataFrame:
    """``rows`` joined with ``counted`` (keys ``on`` once each, ``n``, ...), whose ``n`` add up to ``total``.

    Keys with over ``total / HOT`` rows, so at most HOT, are broadcast and their
    rows stay where they are; the others are joined by key.
    """
    often = F.col("n") * HOT > total
    hot = F.broadcast(counted.filter(often))
    rest = rows.join(F.broadcast(counted.filter(often).select(*on)), on, "left_anti").join(counted.filter(~often), on)
    return rows.join(hot, on).unionByName(rest)


def _parted(rows: DataFrame) -> DataFrame:
    """(mask, part, fp) for ``rows`` (fp, mask): each row once for every mask that ``parted`` gives."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, mask = (c.to_numpy() for c in batch.columns)
            seen, of = np.unique(mask, return_inverse=True)
            finer = np.array([[_signed(m) for m in parted(int(x) % (1 << 64))] for x in seen], np.int64).reshape(-1, RADIUS + 1)
            masks, fps = finer[of].ravel(), np.repeat(fps, RADIUS + 1)
            yield pa.RecordBatch.from_arrays([pa.array(masks), pa.array(fps & masks), pa.array(fps)], names=["mask", "part", "fp"])

    return rows.select("fp", "mask").mapInArrow(run, "mask long, part long, fp long")


def shards(distinct: DataFrame, size: int = SHARD) -> DataFrame:
    """(mask, part, fp): shards of 2 to ``size`` fingerprints; any two within the radius share one.

    ``distinct`` holds each ``fp`` once. ``part`` is ``fp`` under ``mask``.
    """
    opened, done = distinct.select("fp", F.lit(0).cast("long").alias("mask")), None
    while True:
        opened = stored(_parted(opened), "simhash-open")
        counts = stored(opened.groupBy("mask", "part").agg(F.count(F.lit(1)).alias("n")), "simhash-sizes")
        total, widest = counts.agg(F.sum("n"), F.max("n")).first()
        fits = _by_key(opened, counts, ["mask", "part"], total or 0).filter(F.col("n") > 1)
        small = fits.filter(F.col("n") <= size).select("mask", "part", "fp")
        done = small if done is None else done.unionByName(small)
        if (widest or 0) <= size:
            return done
        opened = fits.filter(F.col("n") > size)


# -- trees ----------------------------------------------------------------------


class Forest:
    """A BK-tree for each run of equal ``shard`` in the sorted arrays ``shard`` and ``fps``; the run's first entry is its root."""

    _WIDTH = 128  # edge keys and what a search adds to them stay below

    def __init__(self, shard: np.ndarray, fps: np.ndarray):
        self.fps = fps
        starts = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1]])
        self.root = np.repeat(starts, np.diff(np.r_[starts, len(fps)]))
        places, nodes = [], []
        todo = np.setdiff1d(np.arange(len(fps)), starts, assume_unique=True)
        at = self.root[todo]
        while len(todo):
            place = at * self._WIDTH + np.bitwise_count(fps[todo] ^ fps[at])
            taken, first, of = np.unique(place, return_index=True, return_inverse=True)
            places.append(taken)
            nodes.append(todo[first])
            at = todo[first][of]
            down = np.ones(len(todo), bool)
            down[first] = False
            todo, at = todo[down], at[down]
        place, node = np.concatenate(places or [todo]), np.concatenate(nodes or [todo])
        order = np.argsort(place)
        #: parent * _WIDTH + distance to it, ascending, and the child there.
        self.places, self.children = place[order], node[order]

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """All (query, other) positions of one tree with ``other < query`` and a distance within ``radius``."""
        found = []
        q, at = queries, self.root[queries]
        while len(q):
            d = np.bitwise_count(self.fps[q] ^ self.fps[at]).astype(np.int64)
            near = (d <= radius) & (at < q)
            found.append((q[near], at[near]))
            low = np.searchsorted(self.places, at * self._WIDTH + np.maximum(d - radius, 0))
            n = np.searchsorted(self.places, at * self._WIDTH + d + radius, "right") - low
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            at = self.children[np.repeat(low, n) + step]
            q = np.repeat(q, n)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _united(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``label`` (the least position of each one's class) after the classes of every ``a`` and ``b`` are joined."""
    while True:
        x, y = label[a], label[b]
        apart = x != y
        if not apart.any():
            return label
        np.minimum.at(label, np.maximum(x, y)[apart], np.minimum(x, y)[apart])
        while (up := label[label]).tolist() != label.tolist():
            label = up


def links(placed: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Links (a, b) that connect, shard by shard, all fingerprints within ``radius``: one a member, to the least of its class."""

    def search(shard: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        forest, label = Forest(shard, fps), np.arange(len(fps))
        for start in range(0, len(fps), WALKERS):
            label = _united(label, *forest.within(np.arange(start, min(start + WALKERS, len(fps))), radius))
        linked = np.flatnonzero(label != np.arange(len(fps)))
        return pa.RecordBatch.from_arrays([pa.array(fps[linked].view(np.int64)), pa.array(fps[label[linked]].view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(np.stack([c.to_numpy() for c in batch.columns]))
            rows += batch.num_rows
            if rows < FOREST:
                continue
            # The last shard may go on in the next batch.
            block = np.concatenate(held, axis=1)
            last = np.flatnonzero((block[:2] != block[:2, -1:]).any(0))
            whole = last[-1] + 1 if len(last) else 0
            if whole:
                yield search(*_numbered(block[:, :whole]))
            held, rows = [block[:, whole:]], block.shape[1] - whole
        if rows:
            yield search(*_numbered(np.concatenate(held, axis=1)))

    dealt = placed.repartition("mask", "part").sortWithinPartitions("mask", "part", "fp").select("mask", "part", "fp")
    return dealt.mapInArrow(run, "a long, b long")


def _numbered(block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(shard number, fingerprint) of the columns (mask, part, fp)."""
    new = np.r_[False, (block[:2, 1:] != block[:2, :-1]).any(0)]
    return np.cumsum(new), np.ascontiguousarray(block[2]).view(np.uint64)


# -- operator -------------------------------------------------------------------


def near_duplicates(df: DataFrame, id_col: str, text_col: str, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``df``: id_col, fingerprint (16 lower-case hex digits) and component_id.

    Words are what lies between ASCII blanks, A-Z in lower case; shingles are
    three words joined by a space, repeats included; fewer words are one
    shingle. Null counts as empty, and texts without words have fingerprint
    zero, which links like any other. Equal texts have equal fingerprints and
    so one class. ``component_id`` is the smallest id in the class; null ids
    count for that only if the class has no other. Rows that share an id are
    judged by their own texts. Very long texts are read whole, in pieces.
    An empty table gives no rows; other columns are not read.
    """
    if not 0 <= radius <= RADIUS:
        raise ValueError(f"shards are parted for a radius of at most {RADIUS}")
    rows = stored(fingerprints(df, id_col, text_col), "simhash-rows")
    distinct = stored(rows.groupBy("fp").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n")), "simhash-distinct")
    found = stored(links(shards(distinct.select("fp")), radius).distinct(), "simhash-links")
    groups = components(found, "simhash-stars")

    all_rows, all_fps = distinct.agg(F.sum("n"), F.count(F.lit(1))).first()
    labelled = distinct.join(groups.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "least", F.col("n").alias("copies"), F.coalesce("component", "fp").alias("component"))
    labelled = stored(labelled, "simhash-labelled")
    tops = stored(labelled.groupBy("component").agg(F.count(F.lit(1)).alias("n"), F.min("least").alias("component_id")), "simhash-tops")
    of_fp = _by_key(labelled, tops, ["component"], all_fps).select("fp", F.col("copies").alias("n"), "component_id")
    of_fp = stored(of_fp, "simhash-classes")
    out = _by_key(rows, of_fp, ["fp"], all_rows or 0)
    return out.select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
