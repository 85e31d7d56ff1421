"""Hierarchical packing: window tiers, gaps filled from shorter tiers, balanced step groups.

Each task tokenizes its own rows and packs them in blocks of bounded size, so
there is no shuffle and nothing grows with the corpus. In a block a document
longer than the longest window gives whole windows of its own; what remains
of it is routed to the shortest tier that holds it. Tiers are packed from the
longest to the shortest: a gap takes the longest whole unit of any shorter
tier that fits, and when none fits, the front of the shortest one. What is
left over at the end of a block is laid end to end and cut at powers of two.
Every sequence thus has a power-of-two length and no padding. Sequences are
then dealt, longest first, to the step group with the fewest tokens.
"""

from __future__ import annotations

import heapq
import os
import re
import struct
from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import types as T

TIERS = (512, 1024, 2048, 4096)
#: Tokens packed together, and tokens of one training step.
BLOCK_TOKENS = 1_500_000
STEP_TOKENS = 65_536
#: White-space-free stretches, and their parts, that a worker remembers (in each of two generations), and the longest stretch worth it.
MEMO = 150_000
PARTS_MEMO = 150_000
MEMO_CHARS = 48
#: Characters whose ids are one token each, one of which can part words in a text.
MARKS = "|~^{}\\<>_="

# str.split() and the tokenizer agree on blanks, tabs and line ends; a text
# with any other white space or separator goes through the tokenizer whole.
_ODD_SPACE = re.compile("[\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200b\u2028\u2029\u202f\u205f\u3000\ufeff]")

# A stretch of letters, then stops: the tokenizer lowers these letters one by
# one and cuts before the stops, so both parts are pre-tokens of their own.
_PLAIN = re.compile("([A-Za-zÀ-ÖØ-öø-ÿ]+)([-!\"#$%&()*+,./:;=?@\\[\\\\\\]^_`{|}~]*)").fullmatch


def _byte_chars() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if it can be seen, else the next one from 256 on."""
    seen = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    hidden = [b for b in range(256) if b not in seen]
    return {b: chr(b) for b in seen} | {b: chr(256 + n) for n, b in enumerate(hidden)}


_BYTE_CHARS = _byte_chars()

Piece = tuple[int, int, int]


class WordTokenizer:
    """Ids of a tokenizer whose pre-tokens never span white space, remembered by stretch.

    Added tokens written out in a text, such as ``<|endoftext|>``, get their
    own ids, as the tokenizer does by default; such a text goes through it whole.
    """

    def __init__(self, data: bytes, end_id: int):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_buffer(data)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.end = np.array([end_id], "<u4").tobytes()
        #: Every id as bytes.
        self.words = [struct.pack("<I", i) for i in range(1 + max(self.tokenizer.get_vocab().values(), default=-1))]
        self.memo: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        #: Ids of lower-case letter runs and of runs of stops, from which those of a new stretch may follow.
        self.parts: dict[str, bytes] = {}
        self.before_parts: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of each word, all tokenized as one text with a mark between them that no word contains."""
        whole = "".join(words)
        mark = next((m for m in MARKS if m not in whole), None)
        if mark is None:
            return {w: self._ids(w).tobytes() for w in words}
        ids = self._ids(f" {mark} ".join(words))
        ends = np.flatnonzero(ids == self._ids(mark)[0]).tolist()
        data = ids.tobytes()
        return {w: data[4 * a : 4 * b] for w, a, b in zip(words, [0, *(e + 1 for e in ends)], [*ends, len(ids)])}

    def _part(self, part: str) -> bytes:
        """Ids of one pre-token, lower-case letters or stops, straight from the merges."""
        found = self.before_parts.get(part)
        if found is None:
            spelt = part if part.isascii() else part.encode().decode("latin-1").translate(_BYTE_CHARS)
            words = self.words
            found = b"".join([words[t.id] for t in self.tokenizer.model.tokenize(spelt)])
        self.parts[part] = found
        return found

    def _composed(self, words: list[str]) -> dict[str, bytes]:
        """Ids of new stretches: of letters and stops apart, whose ids depend on nothing beside them; others as they are."""
        parts, found, odd = self.parts, {}, []
        for w in words:
            if w.isalpha() and w.isascii():  # most words; their stops are none
                letters = w.lower()
                found[w] = parts.get(letters) or self._part(letters)
                continue
            plain = _PLAIN(w)
            if plain is None:
                odd.append(w)
                continue
            letters, stops = plain.groups()
            letters = letters.lower()
            ids = parts.get(letters) or self._part(letters)
            found[w] = ids + (parts.get(stops) or self._part(stops)) if stops else ids
        if odd:
            found.update(self._learn(odd))
        if len(parts) >= PARTS_MEMO:
            self.parts, self.before_parts = {}, parts
        return found

    def encode(self, text: str) -> bytes:
        """Ids of ``text`` and the end id, as little-endian unsigned 32-bit words."""
        if _ODD_SPACE.search(text) or any(a in text for a in self.added):
            return self._ids(text).tobytes() + self.end
        words = text.split()
        memo, before = self.memo, self.before
        new = []
        for w in set(words).difference(memo):
            if w in before:
                memo[w] = before[w]
            else:
                new.append(w)
        if new:
            memo.update(self._composed(new))
        out = b"".join(map(memo.__getitem__, words)) + self.end
        if new:
            for w in new:
                if len(w) > MEMO_CHARS:
                    del memo[w]
            if len(memo) >= MEMO:
                self.memo, self.before = {}, memo
        return out


def pack_block(lengths: list[int], tiers: tuple[int, ...] = TIERS) -> list[tuple[int, list[Piece]]]:
    """(window, pieces) of full sequences that hold documents of ``lengths`` tokens exactly once.

    A piece is (document, start, length). ``tiers`` are rising powers of two.
    """
    top, done, rest = tiers[-1], [], []
    for doc, n in enumerate(lengths):
        start = 0
        while n - start > top:
            done.append((top, [(doc, start, top)]))
            start += top
        if n > start:
            rest.append((n - start, doc, start))
    rest.sort()
    loose: list[Piece] = []
    for t in reversed(range(len(tiers))):
        window, below = tiers[t], tiers[t - 1] if t else 0
        cut = bisect_right(rest, (below, len(lengths), 0))
        own, rest = (rest[cut:], rest[:cut]) if t else ([], rest)
        while own or (t == 0 and rest):
            pieces, gap = [], window
            if own:  # longer than half the window, so one to each
                n, doc, start = own.pop()
                pieces, gap = [(doc, start, n)], window - n
            while gap and rest:
                at = bisect_right(rest, (gap, len(lengths), 0)) - 1
                n, doc, start = rest.pop(max(at, 0))
                used = min(n, gap)
                pieces.append((doc, start, used))
                gap -= used
                if n > used:
                    insort(rest, (n - used, doc, start + used))
            if gap:
                loose += pieces
            else:
                done.append((window, pieces))
    return done + _lay_out(loose, top)


def _lay_out(loose: list[Piece], top: int) -> list[tuple[int, list[Piece]]]:
    """Pieces end to end in windows of ``top``; the last stretch in falling powers of two."""
    left, out, queue = sum(p[2] for p in loose), [], loose[::-1]
    while left:
        window = min(top, 1 << (left.bit_length() - 1))
        pieces, gap = [], window
        while gap:
            doc, start, n = queue.pop()
            used = min(n, gap)
            pieces.append((doc, start, used))
            gap -= used
            if n > used:
                queue.append((doc, start + used, n - used))
        out.append((window, pieces))
        left -= window
    return out


def step_groups(windows: list[int], step_tokens: int = STEP_TOKENS) -> list[int]:
    """A group for each sequence: longest first, always to the group with the fewest tokens."""
    heap = [(0, g) for g in range(max(1, -(-sum(windows) // step_tokens)))]
    group = [0] * len(windows)
    for i in sorted(range(len(windows)), key=lambda i: (-windows[i], i)):
        load, g = heap[0]
        group[i] = g
        heapq.heapreplace(heap, (load + windows[i], g))
    return group


@lru_cache(maxsize=1)
def _tokenizer(data: bytes, end_id: int) -> WordTokenizer:
    return WordTokenizer(data, end_id)


def pack_documents(df: DataFrame, id_col: str, text_col: str, tokenizer_file: bytes, end_id: int, tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """One row per piece: id_col, start, length, ids (binary, little-endian unsigned 32-bit), doc_tokens,
    sequence_id, offset, window (the sequence's length) and step_group.

    A null text counts as empty: its only token is ``end_id``. Rows with a null
    or repeated id are documents of their own. ``sequence_id`` and
    ``step_group`` carry the task's partition in their upper 32 bits, so a
    task that runs again after a lost executor gives the same numbers.
    A very long text is tokenized whole and cut into windows of its own. An
    empty table gives no rows.
    """
    sent = df.sparkSession.sparkContext.broadcast(tokenizer_file)
    kind = df.schema[id_col].dataType
    longs = ("doc_tokens", "sequence_id", "offset", "window", "step_group")
    out = T.StructType([T.StructField(id_col, kind), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("ids", T.BinaryType()), *(T.StructField(c, T.LongType()) for c in longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _tokenizer(sent.value, end_id)
        base = TaskContext.get().partitionId() << 32
        next_sequence = next_group = base
        keys: list = []
        docs: list[bytes] = []
        held = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_sequence, next_group, keys, docs, held
            packed = pack_block([len(d) // 4 for d in docs], tiers)
            groups = step_groups([w for w, _ in packed])
            rows = [[] for _ in range(9)]
            for (window, pieces), group in zip(packed, groups):
                offset = 0
                for doc, start, n in pieces:
                    for column, value in zip(rows, (keys[doc], start, n, docs[doc][4 * start : 4 * (start + n)], len(docs[doc]) // 4, next_sequence, offset, window, next_group + group)):
                        column.append(value)
                    offset += n
                next_sequence += 1
            next_group += max(groups, default=-1) + 1
            types = [id_type, pa.int64(), pa.int64(), pa.binary(), *[pa.int64()] * 5]
            keys, docs, held = [], [], 0
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(rows, types)], names=[f.name for f in out])

        id_type = pa.int64()
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                docs.append(coder.encode(text.as_py() or ""))
                held += len(docs[-1]) // 4
                if held >= block_tokens:
                    yield from flush()
        if docs:
            yield from flush()

    return df.select(df[id_col], df[text_col].cast("string").alias("text")).mapInArrow(run, out)
