"""Near-duplicates by improved consistent weighted sampling over TF-IDF shingles.

Five-word shingles weigh ``tf * idf``. The document frequencies cover all
documents: a first pass sums a fixed number of hash buckets, a second counts
exactly the shingles of buckets that reach a share ``FREQUENT`` of the
documents. Rarer shingles share one idf, so the table of exact frequencies
holds at most (mean shingles a document / FREQUENT) entries at any size.

Each text is sketched by 64 consistent weighted samples. Bands of four samples
give candidates; sketches that disagree too much are dropped; what is left is
verified by the exact weighted Jaccard similarity. Verification runs twice:

1. every text of a band bucket against one leader of the bucket, which joins
   dense groups without listing their pairs;
2. in buckets that still hold several classes, the texts of different classes
   against each other, where their blocks of bounded size meet; only the links
   that join classes leave such a place.

Classes are the connected components of the links, found by alternating large
and small stars. Equal texts are one node throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType

from ordersight.llm.common import stored

WORDS = 5
SIMILARITY = 0.8
SAMPLES, BANDS = 64, 16
#: Sketch agreement below which a pair is not verified: more than four deviations under SIMILARITY, where the screen loses far less than the bands.
AGREEMENT = 0.5
#: idf runs from 1 (in every document) to 1 + IDF_RANGE (in at most FREQUENT of them).
IDF_RANGE = 0.25
FREQUENT = 0.02
BUCKETS = 1 << 16
#: Texts of a bucket in one block, bytes of text shingled at once, shingles sampled at once.
BLOCK = 256
PASS_BYTES = 4 << 20
PASS_SHINGLES = 512

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_POWERS = np.array([pow(0x100000001B3, i, 1 << 64) for i in range(256)], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


# -- shingles -----------------------------------------------------------------


def word_hashes(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the white-space separated words in UTF-8 bytes."""
    blank = _SPACE[data]
    before = np.concatenate([[True], blank[:-1]]) if len(data) else blank
    starts = np.flatnonzero(~blank & before)
    if not len(starts):
        return starts, np.empty(0, np.uint64)
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(starts[0], len(data)) - np.repeat(starts, lengths)
    rows = data[starts[0] :]
    value = np.where(blank[starts[0] :], np.uint64(0), (rows.astype(np.uint64) + np.uint64(1)) * _POWERS[place & 255] + (place >> 8).astype(np.uint64) * rows)
    return starts, _mixed(np.add.reduceat(value, starts - starts[0]) + _M1)


def _shingles(words: np.ndarray) -> np.ndarray:
    """Hashes of runs of WORDS words; of all words together if there are fewer; none without words."""
    n = min(WORDS, len(words))
    if not n:
        return words
    h = np.full(len(words) - n + 1, n, np.uint64)
    for j in range(n):
        h = h * _M1 + words[j : len(words) - n + 1 + j]
    return _mixed(h)


def _texts(column: pa.Array) -> Iterator[np.ndarray]:
    """UTF-8 bytes of each text of an Arrow column; a null is empty."""
    for value in column:
        buffer = value.as_buffer() if value.is_valid else None
        yield np.frombuffer(buffer, np.uint8) if buffer is not None and buffer.size else np.empty(0, np.uint8)


def shingle_lists(column: pa.Array) -> Iterator[np.ndarray]:
    """Shingle hashes of each text, hashed for many short texts at once."""
    held, size = [], 0
    for text in [*_texts(column), None]:
        if text is not None:
            held.append(text)
            size += len(text) + 1
        if held and (text is None or size >= PASS_BYTES):
            blank = np.array([32], np.uint8)
            joined = np.concatenate([x for t in held for x in (t, blank)])
            starts, words = word_hashes(joined)
            ends = np.cumsum([len(t) + 1 for t in held])
            cuts = np.searchsorted(starts, ends)
            for a, b in zip([0, *cuts[:-1]], cuts):
                yield _shingles(words[a:b])
            held, size = [], 0


# -- weights ------------------------------------------------------------------


def _counted(df: DataFrame, text_col: str, heavy: np.ndarray | None) -> DataFrame:
    """(key, n): documents per hash bucket, or per shingle of the ``heavy`` buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, found = np.zeros(BUCKETS, np.int64), []

        def rows(keys, n):
            return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(n, pa.int64())], names=["key", "n"])

        for batch in batches:
            for shingles in shingle_lists(batch.column(0)):
                distinct = np.unique(shingles)
                at = (distinct % np.uint64(BUCKETS)).astype(np.int64)
                if heavy is None:
                    np.add.at(sums, at, 1)
                else:
                    found.append(distinct[heavy[at]])
            if found:
                yield rows(*np.unique(np.concatenate(found), return_counts=True))
                found = []
        if heavy is None:
            used = np.flatnonzero(sums)
            yield rows(used, sums[used])

    pairs = df.select(F.col(text_col).cast("string").alias("text")).mapInArrow(run, "key long, n long")
    return pairs.groupBy("key").agg(F.sum("n").alias("n"))


class Weights:
    """tf * idf of shingles, from the exact document frequencies of the frequent ones."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray, documents: int):
        order = np.argsort(keys)
        self.keys = keys[order]
        share = np.clip(counts[order] / max(documents, 1), FREQUENT, 1.0)
        self.idf = 1 + IDF_RANGE * np.log(share) / math.log(FREQUENT)

    def of(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles, sorted, and their weights."""
        distinct, tf = np.unique(shingles, return_counts=True)
        idf = np.full(len(distinct), 1 + IDF_RANGE)
        if len(self.keys) and len(distinct):
            at = np.minimum(np.searchsorted(self.keys, distinct), len(self.keys) - 1)
            idf = np.where(self.keys[at] == distinct, self.idf[at], idf)
        return distinct, tf * idf


def learn_weights(df: DataFrame, text_col: str) -> Weights:
    """Document frequencies over all rows of ``df``; to the driver go bucket numbers and the frequent shingles."""
    documents = df.count()
    least = FREQUENT * documents
    heavy = np.zeros(BUCKETS, bool)
    heavy[[r["key"] for r in _counted(df, text_col, None).filter(F.col("n") >= least).collect()]] = True
    rows = _counted(df, text_col, heavy).filter(F.col("n") >= least).collect() if heavy.any() else []
    return Weights(np.array([r["key"] for r in rows], np.int64).view(np.uint64), np.array([r["n"] for r in rows], np.float64), documents)


# -- sampling -----------------------------------------------------------------


class Sampler:
    """Improved consistent weighted sampling, its gamma draws taken from a table of 4096 quantiles."""

    def __init__(self, samples: int = SAMPLES):
        rng = np.random.default_rng(20)
        self.salt = rng.integers(1, 2**63, samples, dtype=np.uint64)
        gamma = np.sort(rng.gamma(2.0, 1.0, (4096, 64)), axis=0).mean(1)
        self.r = gamma.astype(np.float32)
        self.per_r = (1 / gamma).astype(np.float32)
        self.ln_c = np.log(gamma).astype(np.float32)

    def sketch(self, shingles: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """One 64-bit sample per salt: equal for two texts with a probability of their weighted Jaccard similarity.

        With t = floor(ln w / r + beta), the sample is the shingle of the least
        ln c - r (t - beta) - r, and t. Each draw gives 12 bits for r, 12 for c and 24 for beta.
        """
        best = np.full(len(self.salt), np.inf, np.float32)
        out = np.zeros(len(self.salt), np.uint64)
        ln_w = np.log(weights).astype(np.float32)
        rows = np.arange(len(self.salt))
        for at in range(0, len(shingles), PASS_SHINGLES):
            keys, ln = shingles[at : at + PASS_SHINGLES], ln_w[at : at + PASS_SHINGLES]
            draw = keys[None, :] ^ self.salt[:, None]
            draw *= _M2
            part = draw >> np.uint64(29)
            draw ^= part
            draw *= _M3
            np.right_shift(draw, np.uint64(52), out=part)
            r, t = self.r.take(part.view(np.int64)), self.per_r.take(part.view(np.int64))
            np.right_shift(draw, np.uint64(40), out=part)
            part &= np.uint64(4095)
            value = self.ln_c.take(part.view(np.int64))
            np.right_shift(draw, np.uint64(16), out=part)
            part &= np.uint64(0xFFFFFF)
            beta = part.astype(np.float32)
            beta *= np.float32(2**-24)
            t *= ln
            t += beta
            np.floor(t, out=t)
            beta -= t
            beta -= np.float32(1)
            beta *= r
            value += beta
            least = value.argmin(1)
            found = value[rows, least]
            better = found < best
            sample = _mixed(keys[least] + t[rows, least].astype(np.int64).view(np.uint64) * _M1)
            best = np.where(better, found, best)
            out = np.where(better, sample, out)
        return out


def band_keys(sketch: np.ndarray, bands: int = BANDS) -> np.ndarray:
    parts = sketch.reshape(bands, -1)
    h = np.arange(1, bands + 1, dtype=np.uint64) * _M2
    for j in range(parts.shape[1]):
        h = _mixed(h * _M1 + parts[:, j])
    return h


def _row_key(id_col: str) -> Column:
    return F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63)))


def _keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, node, text): node is a 128-bit digest of the text, null as empty."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return df.select(_row_key(id_col).alias("id"), F.unhex(F.md5(text)).alias("node"), text.alias("text"))


def sketched(df: DataFrame, id_col: str, text_col: str, weights: Weights) -> DataFrame:
    """(id, node, bands, sketch) of every row; a text that its task has sketched already carries nulls."""
    sent = df.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, weights, seen = Sampler(), sent.value, set()
        for batch in batches:
            nodes = batch.column(1).to_pylist()
            fresh = []
            for node in nodes:
                fresh.append(node not in seen)
                seen.add(node)
            texts = batch.column(2).filter(pa.array(fresh))
            bands, sketches, found = [], [], shingle_lists(texts)
            for new in fresh:
                shingles = next(found) if new else np.empty(0, np.uint64)
                if len(shingles):
                    s = sampler.sketch(*weights.of(shingles))
                    bands.append(band_keys(s).view(np.int64))
                    sketches.append(s.astype(np.uint8).tobytes())
                else:
                    bands.append(None)
                    sketches.append(None)
            if len(seen) > 200_000:
                seen = set()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())], names=["id", "node", "bands", "sketch"])

    return _keyed(df, id_col, text_col).mapInArrow(run, "id long, node binary, bands array<long>, sketch binary")


# -- links --------------------------------------------------------------------


@F.pandas_udf(DoubleType())
def _agreement(a: pd.Series, b: pd.Series) -> pd.Series:
    if not len(a):
        return pd.Series([], dtype="float64")
    x, y = (np.frombuffer(b"".join(s), np.uint8).reshape(len(s), -1) for s in (a, b))
    return pd.Series((x == y).mean(1))


def _perhaps_in(wanted: DataFrame):
    """A test of ``node`` that is true for every node in ``wanted`` and false for most others.

    It looks up the first three bytes in a bitmap of fixed size (2 MB), so it
    thins out what a join shuffles as long as ``wanted`` has fewer nodes than
    the bitmap has bits, and never drops a row that the join would keep.
    """
    prefix = F.conv(F.hex(F.substring("node", 1, 3)), 16, 10).cast("long")
    rows = wanted.select(prefix.alias("p")).groupBy(F.expr("p div 32768").alias("part")).agg(F.bitmap_construct_agg(F.col("p") % 32768).alias("bits"))
    bitmap = np.zeros(512 * 4096, np.uint8)
    for r in rows.collect():
        bitmap[4096 * r["part"] : 4096 * (r["part"] + 1)] = np.frombuffer(r["bits"], np.uint8)
    sent = wanted.sparkSession.sparkContext.broadcast(bitmap)

    @F.pandas_udf(BooleanType())
    def perhaps(node: pd.Series) -> pd.Series:
        first = np.frombuffer(b"".join(x[:3] for x in node), np.uint8).reshape(-1, 3).astype(np.int64)
        p = first[:, 0] << 16 | first[:, 1] << 8 | first[:, 2]
        return pd.Series((sent.value[p >> 3] >> (p & 7) & 1).astype(bool))

    return perhaps


def vectors(wanted: DataFrame, docs: DataFrame, weights: Weights) -> DataFrame:
    """(node, keys, weights): the weighted shingles of the nodes ``wanted`` (node, id), packed.

    The row that stands for a node is found by (id, node), so its copies stay
    where they are; repeated rows of the same id and text collapse.
    """
    sent = docs.sparkSession.sparkContext.broadcast(weights)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sent.value.of(s) for s in shingle_lists(batch.column(1))]
            columns = [pa.array([k.tobytes() for k, _ in found], pa.binary()), pa.array([w.astype(np.float32).tobytes() for _, w in found], pa.binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["node", "keys", "weights"])

    texts = docs.filter(_perhaps_in(wanted)("node")).join(wanted, ["id", "node"]).dropDuplicates(["id", "node"]).select("node", "text")
    return texts.mapInArrow(run, "node binary, keys binary, weights binary")


class _Bag:
    """The weighted shingles of one text."""

    def __init__(self, keys: bytes, weights: bytes):
        self.keys = np.frombuffer(keys, np.uint64)
        self.weights = np.frombuffer(weights, np.float32).astype(np.float64)
        self.total = self.weights.sum()

    def similar(self, other: _Bag, similarity: float) -> bool:
        """Whether the weighted Jaccard similarity reaches ``similarity``."""
        if min(self.total, other.total) < (similarity - 1e-6) * max(self.total, other.total):
            return False
        _, i, j = np.intersect1d(self.keys, other.keys, assume_unique=True, return_indices=True)
        both = np.minimum(self.weights[i], other.weights[j]).sum()
        return bool(both >= (similarity - 1e-6) * (self.total + other.total - both))


def verified(pairs: DataFrame, bags: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) of nodes whose weighted Jaccard similarity is at least ``similarity``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [_Bag(ka, wa).similar(_Bag(kb, wb), similarity) for ka, wa, kb, wb in zip(*(c.to_pylist() for c in batch.columns[2:]))]
            keep = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in batch.columns[:2]], names=["a", "b"])

    side = lambda n: bags.select(F.col("node").alias(n), F.col("keys").alias(f"keys_{n}"), F.col("weights").alias(f"weights_{n}"))
    return pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "keys_a", "weights_a", "keys_b", "weights_b").mapInArrow(run, "a binary, b binary")


def _alike(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs whose sketches agree often enough to be worth verifying."""
    side = lambda n: nodes.select(F.col("node").alias(n), F.col("sketch").alias(f"sketch_{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    return both.filter(_agreement("sketch_a", "sketch_b") >= AGREEMENT).select("a", "b")


def _in_blocks(members: DataFrame, columns: list[str]) -> DataFrame:
    """``members`` (key, n, node, ...) dealt so that any two of a bucket meet in a place (key, i, j).

    A bucket of n texts is cut into blocks of about BLOCK by hash; block i meets
    block j once, so no place holds more than two blocks, however large n is.
    """
    cut = members.withColumn("blocks", F.ceil(F.col("n") / BLOCK).cast("long"))
    cut = cut.withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    placed = cut.select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", *columns)
    return placed.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j", "node")


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[bool, list[tuple]]]:
    """(whether one block meets itself, its rows from ``own`` on) place by place, as dealt by ``_in_blocks``."""
    place, held = None, []
    for batch in batches:
        for key, i, j, *row in zip(*(c.to_pylist() for c in batch.columns)):
            if (key, i, j) != place:
                if len(held) > 1:
                    yield place[1] == place[2], held
                place, held = (key, i, j), []
            held.append(tuple(row))
    if len(held) > 1:
        yield place[1] == place[2], held


def _in_company(members: DataFrame) -> DataFrame:
    """Nodes of ``members`` (key, n, node, sketch) whose sketch agrees with that of another one in their bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _places(batches):
            sketch = np.frombuffer(b"".join(r[2] for r in rows), np.uint8).reshape(len(rows), -1)
            found = np.zeros(len(rows), bool)
            for x in range(len(rows) - 1):
                rest = np.arange(x + 1, len(rows)) if not found[x] else x + 1 + np.flatnonzero(~found[x + 1 :])
                near = rest[(sketch[rest] == sketch[x]).mean(1) >= AGREEMENT]
                found[near] = True
                found[x] |= len(near) > 0
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r, f in zip(rows, found) if f], pa.binary())], names=["node"])

    return _in_blocks(members, ["node", "sketch"]).mapInArrow(run, "node binary").distinct()


def _across_classes(members: DataFrame, similarity: float) -> DataFrame:
    """Links (a, b) that join different classes of a bucket, verified where its blocks meet.

    ``members``: key, n, node, component, sketch, keys, weights. Texts of one class
    are not compared, and a link joins their classes in that place at once, so
    a place gives fewer links than it has texts, and no pairs.
    """

    def joined(inside: bool, rows: list[tuple]) -> Iterator[tuple[bytes, bytes]]:
        own = np.array([r[0] for r in rows])
        of = np.unique([r[2].hex() for r in rows], return_inverse=True)[1]
        if of.max() == 0:
            return
        sketch = np.frombuffer(b"".join(r[3] for r in rows), np.uint8).reshape(len(rows), -1)
        bags: dict[int, _Bag] = {}
        bag = lambda x: bags.get(x) or bags.setdefault(x, _Bag(*rows[x][4:6]))
        for x in range(len(rows) - 1):
            rest = np.flatnonzero(of[x + 1 :] != of[x]) + x + 1
            if not inside:
                rest = rest[own[rest] != own[x]]
            share = (sketch[rest] == sketch[x]).mean(1)
            for y in rest[np.argsort(-share, kind="stable")][: int((share >= AGREEMENT).sum())].tolist():
                if of[y] != of[x] and bag(x).similar(bag(y), similarity):
                    of[of == of[y]] = of[x]
                    yield tuple(sorted((rows[x][1], rows[y][1])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for inside, rows in _places(batches):
            found = list(joined(inside, rows))
            yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in found], pa.binary()) for i in (0, 1)], names=["a", "b"])

    return _in_blocks(members, ["node", "component", "sketch", "keys", "weights"]).mapInArrow(run, "a binary, b binary").distinct()


def components(links: DataFrame, label: str = "neardup-stars") -> DataFrame:
    """(node, component) of every node in ``links`` (a, b): the smallest node it is connected to.

    Alternating large and small stars; each round is written to the shared
    folder, so lineage stays short and a lost executor costs one round.
    """

    def both_ways(e: DataFrame) -> DataFrame:
        return e.select("a", "b").union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def starred(e: DataFrame, large: bool) -> DataFrame:
        """Each node's neighbours (the larger ones, or the smaller ones and itself) move to its smallest neighbour."""
        near = both_ways(e)
        least = near.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        if large:
            moved = near.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            smaller = near.filter("b < a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            moved = smaller.union(least.select("a", F.col("m").alias("b")))
        return moved.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = stored(links.filter("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label)
    before = state(edges)
    while before[0]:
        edges = stored(starred(starred(edges, True), False), label)
        now = state(edges)
        if now == before:
            break
        before = now
    tops = edges.select(F.col("b").alias("node")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(tops.select("node", F.col("node").alias("component")))


def _labelled(nodes: DataFrame, groups: DataFrame) -> DataFrame:
    """``nodes`` with ``component``; a node without links is its own."""
    return nodes.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))


def _grown(groups: DataFrame, links: DataFrame) -> DataFrame:
    """``groups`` (node, component) merged along new ``links``."""
    return components(groups.filter("node != component").select(F.col("node").alias("a"), F.col("component").alias("b")).union(links))


def classes(df: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY) -> DataFrame:
    """(id, node, class_id, keeper) of every row of ``df``.

    ``class_id`` is the smallest id among the texts connected to the row's text
    by links of weighted Jaccard similarity ``similarity`` or more; equal texts
    (null counts as empty) are always one class. ``keeper`` is the node of the
    row that stands for the class. Null ids sort first, as the least long.
    Texts of one to four words are one shingle; texts without words link only
    to equal texts. Rows that share an id but not the text are apart. Very long
    texts count with all their shingles. An empty table gives no rows.
    """
    weights = learn_weights(df, text_col)
    rows = stored(sketched(df, id_col, text_col, weights), "neardup-rows")
    nodes = stored(rows.groupBy("node").agg(F.min("id").alias("id"), F.max("bands").alias("bands"), F.max("sketch").alias("sketch")), "neardup-nodes")
    docs = _keyed(df, id_col, text_col)

    placed = nodes.filter("bands is not null").select("node", F.posexplode("bands").alias("band", "key"))
    shared = placed.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(F.xxhash64("node", "band").alias("o"), F.col("node").alias("node"))).alias("least")).filter("n > 1")
    members = stored(placed.join(shared.select("key", "n", F.col("least.node").alias("leader")), "key").select("key", "band", "n", "node", "leader"), "neardup-members")
    pairs = members.filter("leader != node").select(F.least("leader", "node").alias("a"), F.greatest("leader", "node").alias("b")).distinct()
    stars = stored(_alike(pairs, nodes), "neardup-pairs")

    sketches = nodes.select("node", "sketch")
    company = _in_company(members.filter("n > 2").select("key", "n", "node").join(sketches, "node"))
    wanted = stars.select(F.explode(F.array("a", "b")).alias("node")).union(company).distinct()
    wanted = stored(wanted.join(nodes.select("node", "id"), "node"), "neardup-wanted")
    bags = stored(vectors(wanted, docs, weights), "neardup-vectors")
    groups = components(verified(stars, bags, similarity))

    for last_band in (1, BANDS - 1):
        # The first bands join most of a large group, so that few of its texts
        # are left in different classes when all bands are looked at.
        labelled = _labelled(wanted.select("node"), groups)
        open_ = members.filter((F.col("n") > 2) & (F.col("band") <= last_band)).select("key", "node").join(labelled, "node")
        mixed = open_.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("component").alias("x"), F.max("component").alias("y")).filter("x != y").select("key", "n")
        meeting = open_.join(mixed, "key").join(sketches, "node").join(bags, "node")
        groups = _grown(groups, _across_classes(meeting, similarity))

    final = stored(_labelled(nodes.select("node", "id"), groups), "neardup-classes")
    tops = final.groupBy("component").agg(F.min(F.struct("id", "node")).alias("top"))
    of_node = final.join(tops, "component").select("node", F.col("top.id").alias("class_id"), F.col("top.node").alias("keeper"))
    return rows.select("id", "node").join(of_node, "node")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY) -> DataFrame:
    """One row per row of ``df``: id_col, class_id and kept (whether its id and text stand for the class)."""
    back = lambda c: F.when(F.col(c) != F.lit(-(1 << 63)), F.col(c))
    found = classes(df, id_col, text_col, similarity)
    return found.select(back("id").alias(id_col), back("class_id").alias("class_id"), ((F.col("id") == F.col("class_id")) & (F.col("node") == F.col("keeper"))).alias("kept"))


def without_near_duplicates(df: DataFrame, id_col: str, text_col: str, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of ``df`` that stand for their class, one to a class, with all its columns."""
    keepers = classes(df, id_col, text_col, similarity).filter((F.col("id") == F.col("class_id")) & (F.col("node") == F.col("keeper"))).select("id", "node").distinct()
    keepers = stored(keepers, "neardup-keepers")
    # The row travels as one column, so that no name of its own can clash; of
    # rows that share id and text the one with the least hash of all columns stays.
    own = [F.col(f"`{c}`") for c in df.columns]
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    marked = df.select(_row_key(id_col).alias("id"), F.unhex(F.md5(text)).alias("node"), F.struct(*own).alias("row"), F.xxhash64(*own).alias("first"))
    kept = marked.join(keepers, ["id", "node"], "left_semi").groupBy("id", "node").agg(F.min_by("row", "first").alias("row"))
    return kept.select(*[F.col("row")[c].alias(c) for c in df.columns])
