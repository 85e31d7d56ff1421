"""Context-triggered piecewise hashing: chunk signatures at block sizes that double.

A hash rolls over the last seven code points. Where its low bits are zero a
chunk ends; each further zero bit doubles the block size. The signature of a
block size has one base-64 letter per chunk, a digest of the chunk. A
fingerprint holds three signatures from the smallest block size with fewer
than 64 cuts on, so that two texts have a block size in common when their
lengths differ by a few times. Likeness is one minus the edit distance
(insertions and deletions) over the joint length at the best common block
size, and 0 if the signatures share no run of four letters.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

WINDOW = 7
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
MAX_CUTS = 64
LEVELS = 3
RUN = 4
#: Code points hashed at once; longer texts go stretch by stretch.
STRETCH = 1 << 20

_FACTORS = [np.uint32(pow(0x9E3779B1, j, 1 << 32)) for j in range(WINDOW)]


def _rolled(text: str) -> Iterator[np.ndarray]:
    """Mixed rolling hash (uint32) at each code point, a stretch at a time."""
    tail = np.zeros(WINDOW - 1, np.uint32)
    for at in range(0, len(text), STRETCH):
        code = np.frombuffer(text[at : at + STRETCH].encode("utf-32-le", "surrogatepass"), "<u4")
        padded = np.concatenate([tail, code])
        h = code * _FACTORS[0]
        for j in range(1, WINDOW):
            h += padded[WINDOW - 1 - j : len(padded) - j] * _FACTORS[j]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        h ^= h >> np.uint32(13)
        tail = padded[len(padded) - (WINDOW - 1) :]
        yield h


def _levels(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions where a chunk ends at the smallest block size, and the largest level at which it does."""
    at = np.flatnonzero((h & np.uint32(3)) == 0)
    low = h[at].astype(np.int64) | (1 << 32)
    return at, np.log2((low & -low).astype(np.float64)).astype(np.int64) - 2


def fingerprint(text: str) -> str:
    """``block:signature:signature:signature``; the same for equal texts, ``4:::`` for the empty one."""
    runs = list(_rolled(text)) if len(text) <= STRETCH else None
    counts = np.zeros(64, np.int64)
    for h in runs if runs is not None else _rolled(text):
        counts += np.bincount(_levels(h)[1], minlength=64)
    cuts = counts[::-1].cumsum()[::-1]
    level = int(np.argmax(cuts < MAX_CUTS))
    ends: list[list[np.ndarray]] = [[] for _ in range(LEVELS)]
    total, last = np.uint64(0), 0
    for h in runs if runs is not None else _rolled(text):
        sums = np.cumsum(h, dtype=np.uint64) + total
        at, of = _levels(h)
        for k in range(LEVELS):
            ends[k].append(sums[at[of >= level + k]])
        total, last = sums[-1], last + len(h)
    return ":".join([str(4 << level), *(_letters(np.concatenate(e) if e else np.empty(0, np.uint64), total) for e in ends)])


def _letters(ends: np.ndarray, total: np.uint64) -> str:
    if not len(ends) or ends[-1] != total:
        ends = np.append(ends, total)
    chunks = np.diff(ends, prepend=np.uint64(0))
    chunks = chunks[chunks != 0]
    chunks = (chunks * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(58)
    return "".join(LETTERS[c] for c in chunks.tolist())


def _common(a: str, b: str) -> int:
    """Length of the longest common subsequence, bit-parallel over ``a``."""
    masks: dict[str, int] = {}
    for i, c in enumerate(a):
        masks[c] = masks.get(c, 0) | 1 << i
    full = row = (1 << len(a)) - 1
    for c in b:
        hit = row & masks.get(c, 0)
        row = (row + hit) | (row - hit)
    return len(a) - (row & full).bit_count()


def likeness(one: str, other: str) -> float:
    """0 to 1; 1 for equal fingerprints."""
    if one == other:
        return 1.0
    a_block, *a = one.split(":")
    b_block, *b = other.split(":")
    best = 0.0
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            if int(a_block) << i == int(b_block) << j and {x[n : n + RUN] for n in range(len(x) - RUN + 1)} & {y[n : n + RUN] for n in range(len(y) - RUN + 1)}:
                best = max(best, 2 * _common(x, y) / (len(x) + len(y)))
    return best


def fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id_col, fingerprint)`` of every row; a null text counts as empty."""
    out = T.StructType([T.StructField(id_col, df.schema[id_col].dataType), T.StructField("fingerprint", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([fingerprint(t.as_py() or "") for t in batch.column(1)], pa.string())], names=out.names)

    return df.select(df[id_col], df[text_col].cast("string").alias("text")).mapInArrow(run, out)


_LEAST = -(1 << 63)
#: Text of one range, the slots of the sample from which ranges are cut, and the characters of a text that cuts look at.
RANGE_BYTES = 64 << 20
SLOTS = 8192
HEAD_CHARS = 128


def _ordered(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(down, head, id, text): ``down`` ascends where ids descend, null ids last; ``head`` is how the text begins."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    down = F.bitwise_not(F.coalesce("id", F.lit(_LEAST)))
    return rows.select(down.alias("down"), F.substring("text", 1, HEAD_CHARS).alias("head"), "id", "text")


def _cuts(rows: DataFrame) -> list[tuple[int, str]]:
    """Upper ends (down, head) of ranges of about RANGE_BYTES or less, at least one a shuffle partition.

    They come from an even sample of the different (down, head): the one with
    the smallest hash in each of SLOTS slots, whatever the size of the table.
    """
    mixed = rows.select("down", "head", F.octet_length("text").alias("n"), F.xxhash64("down", "head").alias("h"))
    slots = mixed.groupBy(F.pmod("h", F.lit(SLOTS)).alias("slot")).agg(F.sum("n").alias("n"), F.min(F.struct("h", "down", "head")).alias("one"))
    size, sample = slots.agg(F.sum("n"), F.sort_array(F.collect_list(F.struct("one.down", "one.head")))).first()
    n = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-(size or 0) // RANGE_BYTES), 1)
    return sorted({tuple(sample[len(sample) * i // n - 1]) for i in range(1, n) if len(sample) * i // n})


def with_next(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (bucket, closing, down, id, text) dealt and sorted so that each row's successor in
    descending id follows it in its task.

    Rows are cut into ranges by id and how the text begins, so rows that share an id,
    or have none, spread as well. The first row of a range is also sent, as a
    closing row, to the range whose last row precedes it; so no task needs
    another's rows and no task holds more than a range. To the driver go the
    sample of the cuts and one first row's (down, head) per range.
    """
    rows = _ordered(df, id_col, text_col)
    cuts = _cuts(rows)

    def own(down: pd.Series, head: pd.Series) -> list[int]:
        return [bisect_left(cuts, pair) for pair in zip(down.tolist(), head.tolist())]

    @F.pandas_udf("long")
    def bucket(down: pd.Series, head: pd.Series) -> pd.Series:
        return pd.Series(own(down, head), dtype="int64")

    # Rows that begin a range with the same id and head all go to the range before; the first in order closes it.
    firsts = rows.select("down", "head", bucket("down", "head").alias("bucket")).groupBy("bucket").agg(F.min(F.struct("down", "head")).alias("first"))
    heads = sorted((r["bucket"], tuple(r["first"])) for r in firsts.collect())
    closes = {first: heads[i - 1][0] for i, (_, first) in enumerate(heads)}

    @F.pandas_udf("array<long>")
    def buckets(down: pd.Series, head: pd.Series) -> pd.Series:
        pairs = zip(down.tolist(), head.tolist())
        return pd.Series([[b, closes[p]] if p in closes else [b] for p, b in zip(pairs, own(down, head))])

    dealt = rows.select("*", F.posexplode(buckets("down", "head")).alias("closing", "bucket"))
    dealt = dealt.select("bucket", "closing", "down", "id", "text").repartitionById(max(len(cuts) + 1, 1), F.col("bucket").cast("int"))
    return dealt.sortWithinPartitions("bucket", "closing", "down", "text")


def neighbour_fingerprints(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Each text, its half-edited text and the next document, fingerprinted and compared.

    The next document is the one that follows in descending ``id_col`` (null
    ids last, equal ids in the order of their texts; after the last row comes
    the first, and a lone row follows itself). The edited text is the text with
    its last floor(n/2) code points replaced by the first as many of the next
    text, or all of it. Texts of any length are hashed whole, in stretches. Rows: id_col, n_chars, edited (the text), fingerprint,
    edited_fingerprint, near_edited, near_next. A null text counts as empty.
    """
    out = "id long, n_chars long, edited string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
    arrow = pa.schema([("id", pa.int64()), ("n_chars", pa.int64()), ("edited", pa.string()), ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None
        for batch in batches:
            found = []
            for bucket, closing, row, value in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3)), batch.column(4)):
                if closing and last is None:
                    continue
                text = value.as_py()
                mark = last[2] if last and last[1] == text else fingerprint(text)
                if last is not None:
                    of, whole, own = last
                    half = len(whole) // 2
                    edited = whole[: len(whole) - half] + text[:half]
                    changed = fingerprint(edited) if edited != whole else own
                    found.append((of, len(whole), edited, own, changed, likeness(own, changed), likeness(own, mark)))
                last = None if closing else (row, text, mark)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found) if found else [[]] * 7, arrow)], schema=arrow)

    return with_next(df, id_col, text_col).mapInArrow(run, out).withColumnRenamed("id", id_col)
