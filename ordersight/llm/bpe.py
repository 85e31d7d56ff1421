"""Byte-level BPE as a monoid: encode halves, join neighbours, stop when the rest is proven stable.

Two monoids are nested. The *document* monoid joins two runs of pattern
matches: matches near the seam are split again in a window that grows to the
right until it meets a match boundary of the right half; from there on the
right half's own matches hold, because the pattern looks at no earlier text.
The *match* monoid joins the token runs of two halves of one pattern match:
the last and first k tokens are encoded again, k doubling until the pairs
across both window edges are encodings of their own bytes. A sequence in
which every neighbouring pair is so is the BPE encoding of the whole, so all
tokens outside the window are then final.

Decoding concatenates token bytes up the same kind of tree.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

LEAF_CHARS = 16_384
LEAF_BYTES = 16
#: Bounds of the per-worker memo tables (entries, in each of two generations), and the longest stretch worth one.
STRETCH_MEMO = 200_000
PIECE_MEMO = 100_000
PAIR_MEMO = 100_000
STRETCH_CHARS = 64
#: Tokens in one output batch.
BATCH_TOKENS = 1_000_000


def read_ranks(data: bytes) -> dict[bytes, int]:
    """Ranks of a ``.tiktoken`` file: a base64 token and its rank on each line."""
    return {base64.b64decode(token): int(rank) for token, rank in (line.split() for line in data.splitlines() if line.strip())}


class _Memo(dict):
    """A dict that fills itself by ``make``; at ``limit`` entries it becomes the older generation, which is asked before ``make``."""

    def __init__(self, make, limit: int):
        super().__init__()
        self.make, self.limit, self.old = make, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


# Blanks, tabs and line ends are white space to every engine. Where a text has
# no other kind, no pattern match spans from other characters into white space.
_STRETCHES = re.compile("[ \t\n\r]*[^ \t\n\r]+|[ \t\n\r]+").findall
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")
#: Parts of a split pattern whose matches take white space only before other characters.
_SPACE_FIRST = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d", r" ?\p{L}+", r" ?\p{N}+", r" ?[^\s\p{L}\p{N}]+", r"\s+(?!\S)", r"\s+"}


class ByteBPE:
    """Encoder and decoder for one rank table and split pattern.

    If the pattern's parts are known to take white space only before other
    characters, a text is first split into stretches (white space and what
    follows it), whose matches and tokens are remembered together.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES):
        self.ranks = ranks
        self.find = regex.compile(pattern).findall
        self.by_stretch = _SPACE_FIRST.issuperset(pattern.split("|"))
        self.leaf_chars, self.leaf_bytes = max(1, leaf_chars), max(1, leaf_bytes)
        self.token_bytes = {rank: token for token, rank in ranks.items()}
        longest = max(map(len, ranks), default=0)
        size = np.array([len(self.token_bytes.get(i, b"")) for i in range(max(self.token_bytes, default=-1) + 1)], np.int64)
        self._size, self._start = size, np.cumsum(size) - size
        # One more token's room at the end, so that a gather never runs out.
        self._blob = np.frombuffer(b"".join(self.token_bytes.get(i, b"") for i in range(len(size))) + bytes(longest), np.uint8)
        self._four = {token: rank.to_bytes(4, "little") for token, rank in ranks.items()}
        self._pair_ok = _Memo(lambda pair: self.merge(pair[0] + pair[1]) == [pair[0], pair[1]], PAIR_MEMO)
        self._packed = _Memo(self._pack, PIECE_MEMO)
        self._stretches = _Memo(lambda stretch: b"".join(map(self._packed.__getitem__, self.find(stretch))), STRETCH_MEMO)

    # -- one pattern match ---------------------------------------------------

    def merge(self, data: bytes) -> list[bytes]:
        """Plain BPE of ``data``, merge by merge: the encoding of a window, and what tells whether a pair is stable."""
        parts = [data[i : i + 1] for i in range(len(data))]
        if len(parts) > 64:
            return self._merge_long(parts)
        rank = self.ranks.get
        none = len(self.ranks) + 1
        scores = [rank(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores:
            best = min(scores)
            if best == none:
                break
            i = scores.index(best)
            parts[i] += parts.pop(i + 1)
            del scores[i]
            if i < len(scores):
                scores[i] = rank(parts[i] + parts[i + 1], none)
            if i:
                scores[i - 1] = rank(parts[i - 1] + parts[i], none)
        return parts

    def _merge_long(self, parts: list[bytes]) -> list[bytes]:
        """The same merges through a heap, for windows that had to grow long."""
        rank, n = self.ranks.get, len(parts)
        right, left, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] + parts[i + 1])) is not None]
        heapq.heapify(heap)

        def push(i: int) -> None:
            j = right[i]
            if j < n and (r := rank(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (r, i, parts[i], parts[j]))

        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if not alive[i] or j >= n or parts[i] is not a or parts[j] is not b:
                continue
            parts[i], alive[j], right[i] = a + b, False, right[j]
            if right[i] < n:
                left[right[i]] = i
            push(i)
            if left[i] >= 0:
                push(left[i])
        return [p for p, live in zip(parts, alive) if live]

    def join(self, a: list[bytes], b: list[bytes]) -> list[bytes]:
        """Encoding of the bytes of ``a`` and ``b`` together, from their own encodings."""
        k = 1
        while True:
            i, j = max(0, len(a) - k), min(len(b), k)
            window = self.merge(b"".join(a[i:]) + b"".join(b[:j]))
            if (i == 0 or self._pair_ok[a[i - 1], window[0]]) and (j == len(b) or self._pair_ok[window[-1], b[j]]):
                return a[:i] + window + b[j:]
            k *= 2

    def piece(self, data: bytes) -> list[bytes]:
        """Tokens of one pattern match, by tree reduction over its halves."""
        if data in self.ranks:
            return [data]
        return self._halves(data)

    def _halves(self, data: bytes) -> list[bytes]:
        if len(data) <= self.leaf_bytes:
            return self.merge(data)
        mid = len(data) // 2
        return self.join(self._halves(data[:mid]), self._halves(data[mid:]))

    def _pack(self, piece: str) -> bytes:
        return b"".join([self._four[t] for t in self.piece(piece.encode("utf-8", "replace"))])

    # -- one document --------------------------------------------------------

    def join_pieces(self, a: list[str], b: list[str], find=None) -> list[str]:
        """Pattern matches (or what else ``find`` gives) of two neighbouring texts together, from their own matches."""
        find = find or self.find
        seam, near = [], 0
        # A match depends on at most one character past its end, so one that
        # ends two or more characters before the seam cannot change.
        keep = len(a)
        while keep and near < 2:
            keep -= 1
            seam.append(a[keep])
            near += len(a[keep])
        head = "".join(reversed(seam))
        k = 4
        while True:
            k = min(k, len(b))
            window = head + "".join(b[:k])
            split = find(window)
            if k == len(b):
                return a[:keep] + split
            edges, at = {len(head): 0}, len(head)
            for n, p in enumerate(b[:k], 1):
                at += len(p)
                edges[at] = n
            at = 0
            for n, p in enumerate(["", *split]):
                at += len(p)
                if len(window) - at < 2:
                    break
                if at in edges:
                    return a[:keep] + split[:n] + b[edges[at] :]
            k *= 2

    def pieces(self, text: str, find=None) -> list[str]:
        find = find or self.find
        runs = [find(text[i : i + self.leaf_chars]) for i in range(0, len(text), self.leaf_chars)]
        while len(runs) > 1:
            runs = [self.join_pieces(*runs[i : i + 2], find) if i + 1 < len(runs) else runs[i] for i in range(0, len(runs), 2)]
        return runs[0] if runs else []

    def encode(self, text: str) -> np.ndarray:
        if self.by_stretch and not _ODD_SPACE.search(text):
            memo = self._stretches
            found = [memo[s] if len(s) <= STRETCH_CHARS else memo.make(s) for s in self.pieces(text, _STRETCHES)]
        else:
            found = map(self._packed.__getitem__, self.pieces(text))
        return np.frombuffer(b"".join(found), "<i4")

    def _bytes(self, ids: np.ndarray) -> bytes:
        """The token bytes of a run of ids, gathered at once."""
        if len(ids) and (int(ids.min()) < 0 or int(ids.max()) >= len(self._size) or not self._size[ids].all()):
            raise KeyError("an id outside the vocabulary")
        size = self._size[ids]
        ends = np.cumsum(size)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(self._start[ids] - (ends - size), size)
        return self._blob[at].tobytes()

    def decode(self, ids) -> bytes:
        ids = np.asarray(ids, np.int64)
        runs = [self._bytes(ids[i : i + self.leaf_chars]) for i in range(0, len(ids), self.leaf_chars)]
        while len(runs) > 1:
            runs = [b"".join(runs[i : i + 2]) for i in range(0, len(runs), 2)]
        return runs[0] if runs else b""


@lru_cache(maxsize=2)
def _coder(data: bytes, pattern: str, leaf_chars: int, leaf_bytes: int) -> ByteBPE:
    return ByteBPE(read_ranks(data), pattern, leaf_chars, leaf_bytes)


def encode_documents(df: DataFrame, id_col: str, text_col: str, rank_file: bytes, pattern: str, leaf_chars: int = LEAF_CHARS, leaf_bytes: int = LEAF_BYTES, decoded: bool = False) -> DataFrame:
    """``(id_col, ids array<int>)``: the token ids of every whole text, without special tokens.

    With ``decoded`` also the bytes that these ids decode to, from the same pass.
    A null text counts as empty and has no ids; a null or repeated id passes
    through row by row. Very long texts are split in pieces whose matches are
    joined, and are encoded whole. No shuffle: each task encodes its own rows.
    What the workers get is the rank file, whose size is the vocabulary's.
    """
    sent = df.sparkSession.sparkContext.broadcast(rank_file)
    fields = [T.StructField(id_col, df.schema[id_col].dataType), T.StructField("ids", T.ArrayType(T.IntegerType(), False))]
    out = T.StructType(fields + [T.StructField("decoded", T.BinaryType())] * decoded)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(sent.value, pattern, leaf_chars, leaf_bytes)
        for batch in batches:
            keys, start, found, total = batch.column(0), 0, [], 0
            for row, text in enumerate(batch.column(1)):
                found.append(coder.encode(text.as_py() or ""))
                total += len(found[-1])
                if total >= BATCH_TOKENS or row + 1 == batch.num_rows:
                    offsets = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype("int32")
                    ids = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(found)))
                    columns = [keys.slice(start, len(found)), ids]
                    if decoded:
                        columns.append(pa.array([coder.decode(x) for x in found], pa.binary()))
                    yield pa.RecordBatch.from_arrays(columns, names=out.names)
                    start, found, total = row + 1, [], 0

    return df.select(df[id_col], df[text_col].cast("string").alias("text")).mapInArrow(run, out)


def decode_documents(df: DataFrame, keep: list[str], ids_col: str, rank_file: bytes, pattern: str) -> DataFrame:
    """The columns ``keep`` and ``decoded`` (binary): the bytes that the ids of each row stand for.

    Null ids decode to no bytes; an id outside the vocabulary is an error.
    """
    sent = df.sparkSession.sparkContext.broadcast(rank_file)
    out = T.StructType([*(T.StructField(c, df.schema[c].dataType) for c in keep), T.StructField("decoded", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(sent.value, pattern, LEAF_CHARS, LEAF_BYTES)
        for batch in batches:
            decoded = [coder.decode(ids.values.to_numpy(zero_copy_only=False) if ids.is_valid else []) for ids in batch.column(len(keep))]
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(decoded, pa.binary())], names=[*keep, "decoded"])

    return df.select(*keep, df[ids_col].alias("ids")).mapInArrow(run, out)
