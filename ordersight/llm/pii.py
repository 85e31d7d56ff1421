"""Personal data by a skip-chain conditional random field.

Nodes are the *mentions* of a document: the fixed-rule spans (e-mail, IP,
card, phone) and whatever else might be one: numbers of seven or more digits
and words with an at sign that either resemble another mention or look like a
kind themselves (a plus sign, brackets, a valid check digit), say a phone
number that the fixed rule lost as another number follows it. In a stretch of
several blank-separated numbers, those runs of parts are mentions that equal
another number of the document or make up a card. All other text can only be
"other", so it needs no node. A linear chain joins neighbouring
mentions; skip edges join each mention to the previous one with the same
value (``exact``) or the same last seven digits or mail name (``similar``),
however far away. Labels are "other" and the four kinds. Loopy belief
propagation passes messages over both sorts of edges; fixed-rule spans are
clamped to their kind, and their neighbours by skip edge are drawn to it. A
mention whose most likely label is a kind with at least ``min_probability``
becomes an added span.

Weights maximise the pseudo-likelihood of a bounded sample of documents in
which a fixed rule fired. In training the tell-tale features of a mention
(plus sign, valid check digit, ..., or "plain", none of them) are hidden half
of the time; a mention with a skip edge is then shown as plain half of those
times, and exact edges count as similar half of the time. So the skip edges
have to carry what the mention itself does not show.
"""

from __future__ import annotations

import pickle
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersight.llm import spans as S
from ordersight.llm.common import thinned
from ordersight.llm.spans import Span

KINDS = ("email", "ip", "card", "phone")
LABELS = len(KINDS) + 1
#: The training sample: documents looked at, those used, and mentions in one of them.
SAMPLE_LOOKED_AT = 40_000
SAMPLE_DOCS = 2000
SAMPLE_MENTIONS = 100
MIN_PROBABILITY = 0.8
#: Messages have settled when none changes by more; they may take the first rounds and some for every mention of the document.
TOLERANCE = 1e-4
ROUNDS, ROUNDS_A_MENTION = 20, 4

_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# No earlier start can be in the middle of a digit run, so the look-behind
# only spares starts that must fail.
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"(?<![A-Za-z0-9])\+?[0-9](?:[\x20().-]{0,2}[0-9]){6,}(?![A-Za-z0-9])")
_PART = re.compile(r"[^\x20]+")
#: Digits of the shortest mention, and of the longest phone and card.
LEAST_DIGITS, PHONE_DIGITS, CARD_DIGITS = 7, 15, 19
#: Digits of the shortest card, and of the groups it is printed in (the last may be shorter).
LEAST_CARD, CARD_GROUP = 12, 3
#: Usual groups of a card, and first digits of the usual issuers.
_GROUPS = frozenset({(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3)})
_ISSUERS = frozenset("3456")
#: What a run of parts counts when runs overlap: equal to a fixed-rule span, a usual card, equal to another number, usual groups, any card.
SAME, USUAL_CARD, KNOWN, USUAL_GROUPS, ANY_CARD = 1000, 100, 20, 10, 1
_HANDLE = re.compile(r"@[A-Za-z0-9-]+")
_DIGITS = re.compile(r"[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _mail_start(text: str, at: int, floor: int) -> int:
    while at > floor and text[at - 1] in _LOCAL:
        at -= 1
    return at


def base_spans(text: str) -> list[Span]:
    """Spans of the fixed rules: leftmost and non-overlapping within a kind; matches that fail their test are dropped."""
    found: list[Span] = []
    if "@" in text:
        floor = 0
        for m in _AT.finditer(text):
            start = _mail_start(text, m.start(), floor)
            if start < m.start():
                found.append((start, m.end(), 0))
                floor = m.end()
    if _DIGITS.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
                found.append((m.start(), m.end(), 1))
        for m in _CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((m.start(), m.end(), 2))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 9 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                    found.append((m.start(), m.end(), 3))
    return S.ordered(found)


@dataclass
class Mentions:
    """The graph of one document: spans with their base label (0: none), features and edges by sort."""

    spans: list[Span]
    features: list[list[int]]
    edges: list[tuple[int, int, int]]  # node, node, sort: 0 chain, 1 exact, 2 similar


#: Features of a mention. Those from TELLING on give the kind away.
FEATURES = ("any", "digits<9", "digits<12", "digits<16", "digits=16", "digits>16", "no digits", "blanks", "brackets", "has @", "plus", "check digit", "four parts", "dotted host", "plain")
TELLING, PLAIN = FEATURES.index("plus"), FEATURES.index("plain")
#: A mention with one of these is a node also without a skip edge.
SHOWY = frozenset(map(FEATURES.index, ("brackets", "plus", "check digit")))


def _features(text: str) -> list[int]:
    digits = _NOT_DIGIT.sub("", text)
    n, mail = len(digits), "@" in text
    size = 6 if mail or not n else 1 if n < 9 else 2 if n < 12 else 3 if n < 16 else 4 if n == 16 else 5
    out = [0, size]
    if " " in text or "-" in text:
        out.append(7)
    if "(" in text:
        out.append(8)
    if mail:
        out.append(9)
        if "." in text.rpartition("@")[2]:
            out.append(13)
    else:
        if text[0] == "+":
            out.append(10)
        if 12 <= n <= 19 and luhn(digits):
            out.append(11)
        if text.count(".") == 3 and all(p.isdigit() and int(p) <= 255 for p in text.split(".") if len(p) <= 12) and n <= 12:
            out.append(12)
    if out[-1] < TELLING:
        out.append(PLAIN)
    return out


def _numbers(text: str, gaps: list[tuple[int, int]], base: list[Span]) -> list[list[tuple[int, int]]]:
    """Numbers in each gap between the spans of ``base``; stretches of several parts are cut by what the document shows."""
    digits = lambda a, b: _NOT_DIGIT.sub("", text[a:b])
    stretches = [[(*m.span(), _NOT_DIGIT.sub("", m[0])) for m in _NUMBER.finditer(text, a, b)] for a, b in gaps]
    sure = {digits(a, b) for a, b, k in base if k >= 2}
    known = {d for found in stretches for _, _, d in found if len(d) <= CARD_DIGITS}
    return [[n for a, b, d in found for n in _cut(text, a, b, d, sure, known)] for found in stretches]


def _cut(text: str, a: int, b: int, digits: str, sure: set[str], known: set[str]) -> Iterator[tuple[int, int]]:
    """Numbers in the stretch text[a:b]: runs of its parts that are cards or equal another number, and the rest between them."""
    parts = [m.span() for m in _PART.finditer(text, a, b)]
    card = text[a] != "+" and LEAST_CARD <= len(digits) <= CARD_DIGITS and luhn(digits)
    if len(parts) == 1 or digits in sure or card:
        yield a, b
        return
    at = 0
    for i, j in _runs(text, parts, digits, sure, known):
        yield from _rest(text, parts[at:i])
        # Brackets and dots at the ends belong to what is around a card.
        x, y = parts[i][0], parts[j - 1][1]
        while text[x] != "+" and not _DIGITS.match(text, x):
            x += 1
        while not _DIGITS.match(text, y - 1):
            y -= 1
        yield x, y
        at = j
    yield from _rest(text, parts[at:])


def _runs(text: str, parts: list[tuple[int, int]], digits: str, sure: set[str], known: set[str]) -> list[tuple[int, int]]:
    """The disjoint runs of ``parts`` (from, to), not all of them together, that count most: cards and what equals another number."""
    n, sizes = len(parts), [len(_NOT_DIGIT.sub("", text[a:b])) for a, b in parts]
    ends = [0]
    for size in sizes:
        ends.append(ends[-1] + size)
    # Check sums up to a digit, with the digits at even or at odd places doubled.
    sums = ([0], [0])
    for i, c in enumerate(digits):
        d = ord(c) - 48
        for odd in (0, 1):
            sums[odd].append(sums[odd][-1] + (d if i % 2 != odd else 2 * d if d < 5 else 2 * d - 9))

    def count(i: int, j: int) -> int:
        x, y = ends[i], ends[j]
        if y - x < LEAST_DIGITS or (i, j) == (0, n):
            return 0
        if digits[x:y] in sure:
            return SAME
        again = KNOWN if digits[x:y] in known else 0
        # The last digit is not doubled, the one before it is.
        if y - x < LEAST_CARD or text[parts[i][0]] == "+" or (sums[y % 2][y] - sums[y % 2][x]) % 10 or min(sizes[i : j - 1], default=CARD_GROUP) < CARD_GROUP:
            return again
        usual = j == i + 1 or tuple(sizes[i:j]) in _GROUPS
        return USUAL_CARD if usual and digits[x] in _ISSUERS else max(again, USUAL_GROUPS if usual else ANY_CARD)

    best, choice = [0] * (n + 1), [0] * n
    for i in reversed(range(n)):
        best[i], j = best[i + 1], i + 1
        while j <= n and ends[j] - ends[i] <= CARD_DIGITS:
            if (c := count(i, j)) and c + best[j] >= best[i]:
                best[i], choice[i] = c + best[j], j
            j += 1
    out, i = [], 0
    while i < n:
        if choice[i]:
            out.append((i, choice[i]))
        i = choice[i] or i + 1
    return out


def _rest(text: str, parts: list[tuple[int, int]]) -> Iterator[tuple[int, int]]:
    """What ``parts`` without a card hold: one number if it is no longer than one, else a leading phone and the long parts."""
    if not parts:
        return
    sizes = [len(_NOT_DIGIT.sub("", text[a:b])) for a, b in parts]
    if sum(sizes) <= (PHONE_DIGITS if text[parts[0][0]] == "+" else CARD_DIGITS):
        if sum(sizes) >= LEAST_DIGITS:
            yield parts[0][0], parts[-1][1]
        return
    held: list[int] | None = None
    for (a, b), n in zip(parts, sizes):
        if held and text[held[0]] == "+" and held[2] + n <= PHONE_DIGITS:
            held = [held[0], b, held[2] + n]
            continue
        if held and held[2] >= LEAST_DIGITS:
            yield held[0], held[1]
        held = [a, b, n]
    if held and held[2] >= LEAST_DIGITS:
        yield held[0], held[1]


def mentions(text: str, base: list[Span], plain_ones: bool = False) -> Mentions:
    """The mentions of ``text``; those that touch a fixed-rule span are left out.

    With ``plain_ones`` also those that neither resemble another one nor look
    like a kind: training needs them as examples of "other".
    """
    found = list(base)
    at, gaps = 0, []
    for a, b, _ in sorted(base):
        if a > at:
            gaps.append((at, a))
        at = max(at, b)
    gaps.append((at, len(text)))
    for (a, b), taken in zip(gaps, _numbers(text, gaps, base)):
        found += [(x, y, -1) for x, y in taken]
        if text.find("@", a, b) >= 0:
            for m in _HANDLE.finditer(text, a, b):
                start = _mail_start(text, m.start(), a)
                if start < m.start() and not any(x < m.end() and start < y for x, y in taken):
                    found.append((start, m.end(), -1))
    found = S.ordered(found)
    keys = []
    for a, b, _ in found:
        value = text[a:b]
        if "@" in value:
            keys.append((("m", value.lower()), ("n", value.lower().partition("@")[0])))
        else:
            digits = _NOT_DIGIT.sub("", value)
            keys.append((("d", digits), ("e", digits[-LEAST_DIGITS:])))
    common = Counter(similar for _, similar in keys)
    out = Mentions([], [], [])
    seen: dict[tuple, int] = {}
    for (a, b, k), (exact, similar) in zip(found, keys):
        features = _features(text[a:b])
        if k < 0 and not plain_ones and common[similar] < 2 and SHOWY.isdisjoint(features):
            continue
        i = len(out.spans)
        out.spans.append((a, b, k + 1))
        out.features.append(features)
        if i:
            out.edges.append((i - 1, i, 0))
        if exact in seen:
            out.edges.append((seen[exact], i, 1))
        elif similar in seen:
            out.edges.append((seen[similar], i, 2))
        seen[exact] = seen[similar] = i
    return out


@dataclass
class Model:
    unary: np.ndarray  # features x labels
    pair: np.ndarray  # edge sorts x labels x labels, symmetric

    @staticmethod
    def untrained() -> Model:
        return Model(np.zeros((len(FEATURES), LABELS)), np.zeros((3, LABELS, LABELS)))


def _joined(graphs: list[Mentions]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature rows, base labels and edges of several documents as one graph."""
    x = np.zeros((sum(len(g.spans) for g in graphs), len(FEATURES)))
    labels, edges, at = [], [], 0
    for g in graphs:
        for i, f in enumerate(g.features):
            x[at + i, f] = 1
        labels += [k for _, _, k in g.spans]
        edges += [(a + at, b + at, s) for a, b, s in g.edges]
        at += len(g.spans)
    return x, np.array(labels, np.int64), np.array(edges, np.int64).reshape(-1, 3)


def train(graphs: list[Mentions], steps: int = 300, rate: float = 0.5, shrink: float = 1e-3, seed: int = 7) -> Model:
    """Weights by pseudo-likelihood: each label given its neighbours' labels, tell-tale features hidden half of the time."""
    model = Model.untrained()
    if not graphs:
        return model
    x, y, edges = _joined(graphs)
    n = len(y)
    rng = np.random.default_rng(seed)
    ends = np.concatenate([edges[:, :2], edges[:, 1::-1]])
    sort = np.concatenate([edges[:, 2], edges[:, 2]])
    by_sort = [np.zeros((n, LABELS)) for _ in range(3)]
    for s in range(3):
        np.add.at(by_sort[s], ends[sort == s, 0], np.eye(LABELS)[y[ends[sort == s, 1]]])
    linked = np.zeros(n, bool)
    linked[ends[sort > 0].ravel()] = True
    want = np.eye(LABELS)[y]
    grams = [np.zeros_like(model.unary), np.zeros_like(model.pair)]
    for _ in range(steps):
        seen = x.copy()
        hidden = rng.random(n) < 0.5
        seen[hidden, TELLING:] = 0
        seen[hidden & linked & (rng.random(n) < 0.5), PLAIN] = 1
        demoted = (rng.random(n) < 0.5)[:, None]
        near = [by_sort[0], by_sort[1] * ~demoted, by_sort[2] + by_sort[1] * demoted]
        score = seen @ model.unary + sum(near[s] @ model.pair[s] for s in range(3))
        p = np.exp(score - score.max(1, keepdims=True))
        p /= p.sum(1, keepdims=True)
        off = want - p
        unary = seen.T @ off / n - shrink * model.unary
        pair = np.stack([near[s].T @ off / n for s in range(3)])
        pair = (pair + pair.transpose(0, 2, 1)) / 2 - shrink * model.pair
        for value, step, total in ((model.unary, unary, grams[0]), (model.pair, pair, grams[1])):
            total += step**2
            value += rate * step / np.sqrt(total + 1e-8)
    return model


def marginals(model: Model, graphs: list[Mentions], rounds: int | None = None) -> np.ndarray:
    """Label probabilities of all mentions by damped sum-product messages; fixed-rule mentions are certain.

    Messages of a document are passed until they settle, so a label reaches
    the end of any chain; ``rounds`` bounds them, by default with the number of mentions.
    """
    x, y, edges = _joined(graphs)
    local = x @ model.unary
    clamp = np.where(np.eye(LABELS, dtype=bool)[y], 0.0, -40.0)
    local = np.where((y > 0)[:, None], clamp, local)
    if len(edges):
        src, dst = np.concatenate([edges[:, 0], edges[:, 1]]), np.concatenate([edges[:, 1], edges[:, 0]])
        back = np.concatenate([np.arange(len(edges)) + len(edges), np.arange(len(edges))])
        sort = np.concatenate([edges[:, 2]] * 2)
        graph = np.tile(np.repeat(np.arange(len(graphs)), [len(g.edges) for g in graphs]), 2)
        most = np.array([rounds or ROUNDS + ROUNDS_A_MENTION * len(g.spans) for g in graphs])
        message = np.zeros((len(src), LABELS))
        at, done = np.arange(len(src)), 0
        while len(at):
            belief = local.copy()
            np.add.at(belief, dst[at], message[at])
            out = (belief[src[at]] - message[back[at]])[:, :, None] + model.pair[sort[at]]
            top = out.max(1)
            new = top + np.log(np.exp(out - top[:, None, :]).sum(1))
            new = 0.5 * message[at] + 0.5 * (new - new.max(1, keepdims=True))
            moved = np.zeros(len(graphs))
            np.maximum.at(moved, graph[at], np.abs(new - message[at]).max(1))
            message[at] = new
            done += 1
            at = at[((moved > TOLERANCE) & (done < most))[graph[at]]]
        np.add.at(local, dst, message)
    p = np.exp(local - local.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def added_spans(model: Model, graphs: list[Mentions], min_probability: float = MIN_PROBABILITY) -> list[list[Span]]:
    """For each document the spans that the model adds to those of the fixed rules."""
    open_ = [i for i, g in enumerate(graphs) if any(k == 0 for _, _, k in g.spans)]
    out: list[list[Span]] = [[] for _ in graphs]
    if not open_:
        return out
    p, at = marginals(model, [graphs[i] for i in open_]), 0
    for i in open_:
        for (a, b, k), row in zip(graphs[i].spans, p[at : at + len(graphs[i].spans)]):
            best = int(row.argmax())
            if k == 0 and best and row[best] >= min_probability:
                out[i].append((a, b, best - 1))
        at += len(graphs[i].spans)
    return out


def training_graphs(df: DataFrame, text_col: str, docs: int = SAMPLE_DOCS, most: int = SAMPLE_MENTIONS) -> list[Mentions]:
    """Mention graphs of at most ``docs`` documents in which a fixed rule fired, with at most ``most`` mentions.

    About SAMPLE_LOOKED_AT different texts, picked by their hash, are searched
    for them; copies count once. Only the graphs reach the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            rows = []
            for order, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                if order in seen:
                    continue
                seen.add(order)
                text = value.as_py() or ""
                if base := base_spans(text):
                    g = mentions(text, base, plain_ones=True)
                    if len(g.spans) <= most:
                        rows.append((order, pickle.dumps((g.spans, g.features, g.edges))))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.binary())], names=["hash", "graph"])

    texts = thinned(df.select(F.col(text_col).cast("string").alias("text")), ["text"], SAMPLE_LOOKED_AT, distinct=True)
    rows = texts.select(F.xxhash64("text").alias("hash"), "text")
    picked = rows.mapInArrow(run, "hash long, graph binary").dropDuplicates(["hash"]).orderBy("hash", "graph").limit(docs).collect()
    return [Mentions(*pickle.loads(r["graph"])) for r in picked]


def fit(df: DataFrame, text_col: str) -> Model:
    return train(training_graphs(df, text_col))


def find_personal_data(df: DataFrame, id_col: str, text_col: str, model: Model, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """One row per document: id_col, ``base`` and ``spans`` (array<struct<start,end,kind>>, kind as an index into KINDS).

    Spans are in code points, end exclusive, sorted by start and kind. A null
    text counts as empty; each row is a document, also with a null or repeated
    id; no rows give no rows. Very long texts are read whole; a task holds the
    mentions of one text at a time.
    """
    item = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32())]))
    kind = "array<struct<start:long,end:long,kind:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        as_rows = lambda spans: [{"start": a, "end": b, "kind": k} for a, b, k in spans]
        for batch in batches:
            texts = [t.as_py() or "" for t in batch.column(1)]
            base = [base_spans(t) for t in texts]
            more = added_spans(model, [mentions(t, b) for t, b in zip(texts, base)], min_probability)
            columns = [pa.array([as_rows(b) for b in base], item), pa.array([as_rows(S.ordered(b + m)) for b, m in zip(base, more)], item)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["id", "base", "spans"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id long, base {kind}, spans {kind}").withColumnRenamed("id", id_col)


def masked(text: str, spans: list[Span]) -> str:
    """``text`` with every span replaced by its kind in brackets; overlapping spans share one mark, the first one's."""
    out, at = [], 0
    for a, b, k in S.ordered(spans):
        if a >= at:
            out += [text[at:a], f"[{KINDS[k].upper()}]"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask_personal_data(df: DataFrame, text_col: str, model: Model, length_col: str | None = None, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """``df`` with the personal data in ``text_col`` masked; rows, columns and texts without any stay as they are.

    ``length_col`` names an integer column that gets the code points of the texts that changed.
    """
    at, names = df.columns.index(text_col), df.columns
    length_at = names.index(length_col) if length_col in names else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() for t in batch.column(at)]
            base = [base_spans(t or "") for t in texts]
            more = added_spans(model, [mentions(t or "", b) for t, b in zip(texts, base)], min_probability)
            done = [masked(t, b + m) if b or m else t for t, b, m in zip(texts, base, more)]
            columns = [*batch.columns]
            columns[at] = pa.array(done, batch.schema.field(at).type)
            if length_at is not None:
                lengths = [len(t) if b or m else n for t, b, m, n in zip(done, base, more, columns[length_at].to_pylist())]
                columns[length_at] = pa.array(lengths, batch.schema.field(length_at).type)
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, df.schema)
