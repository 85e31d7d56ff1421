"""Secrets by corpus-wide ownership: copied everywhere means an example, held by one owner means live.

A first pass finds in every whole text the spans of three fixed kinds and
further candidates, random-looking words of 20 or more characters. For each
candidate value it keeps a 128-bit hash. Hashes are counted over the corpus by
distinct repositories (documents by their id) and owners (their source). A
value of at most ``max_owners`` owners and ``max_repositories`` repositories is
owner-specific: if it also looks random it counts as live. A value of more
owners or more repositories is an example, also when a single source holds all
its copies. Live candidates outside the fixed kinds become spans of kind
``owned``.
"""

from __future__ import annotations

import hashlib
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ordersight.llm.common import stored

KINDS = ("assign", "access", "hex", "owned")
MAX_OWNERS = 2
#: Documents that may hold an owner-specific value: an owner may use it in a few places.
MAX_REPOSITORIES = 5
#: Bits a character for a value to look random.
LIVE_BITS = 3.0

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
_ASSIGN_HINTS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
_WORD = re.compile(r"[A-Za-z0-9+/_=-]{20,}")


def base_spans(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, kind, secret value) of the fixed kinds; leftmost, non-overlapping within a kind."""
    found = []
    low = text.lower()
    if any(hint in low for hint in _ASSIGN_HINTS):
        found += [(m.start(), m.end(), 0, m[2]) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [(m.start(), m.end(), 1, m[0]) for m in _ACCESS.finditer(text) if len(m[0]) >= 20]
    # A maximal run shorter than 24 fails and holds no longer one, so the
    # bound can stand in the pattern.
    found += [(m.start(), m.end(), 2, m[0]) for m in _HEX.finditer(text)]
    return found


def bits(value: str) -> float:
    """Entropy of the characters of ``value``, in bits a character."""
    return -sum(n / len(value) * math.log2(n / len(value)) for n in Counter(value).values())


def further_candidates(text: str, base: list[tuple[int, int, int, str]]) -> list[tuple[int, int, str]]:
    """Random-looking words that touch no base span: letters and digits, at least ``LIVE_BITS`` a character."""
    taken = sorted((a, b) for a, b, _, _ in base)
    out, i = [], 0
    for m in _WORD.finditer(text):
        word = m[0]
        if word.isalpha() or word.isdigit() or not any(map(str.isdigit, word)) or not any(map(str.isalpha, word)):
            continue
        while i < len(taken) and taken[i][1] <= m.start():
            i += 1
        near = itertools.takewhile(lambda t: t[0] < m.end(), itertools.islice(taken, i, None))
        if not any(b > m.start() for _, b in near) and bits(word) >= LIVE_BITS:
            out.append((m.start(), m.end(), word))
    return out


def _hashed(value: str) -> str:
    return hashlib.blake2b(value.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()


_CAND = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.int32()), ("value", pa.string()), ("random", pa.bool_())]))
_SCANNED = "id long, owner string, cands array<struct<start:long,end:long,kind:int,value:string,random:boolean>>"


def candidates(df: DataFrame, id_col: str, text_col: str, owner_col: str) -> DataFrame:
    """One row per document: id, owner and its candidates (span, kind, hash of the value, whether it looks random)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for value in batch.column(2):
                text = value.as_py() or ""
                base = base_spans(text)
                rows = [(a, b, k, v, len(v) >= 16 and bits(v) >= LIVE_BITS) for a, b, k, v in base]
                rows += [(a, b, 3, v, True) for a, b, v in further_candidates(text, base)]
                found.append([{"start": a, "end": b, "kind": k, "value": _hashed(v), "random": r} for a, b, k, v, r in rows])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, _CAND)], names=["id", "owner", "cands"])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(owner_col).cast("string").alias("owner"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, _SCANNED)


def ownership(values: DataFrame) -> DataFrame:
    """(value, repositories, owners) from rows of value, repository and owner, both distinct; rows of a hot value are dealt by all of them.

    A null owner is one owner of its own.
    """
    # A struct is never null, so a null owner counts.
    return values.groupBy("value").agg(F.count_distinct(F.struct("repository")).alias("repositories"), F.count_distinct(F.struct("owner")).alias("owners"))


def find_secrets(df: DataFrame, id_col: str, text_col: str, owner_col: str, max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """One row per document: id_col, base and all spans, and how many base values are live or examples.

    Columns: ``base`` and ``spans`` (array<struct<start,end,kind>>, kind as an
    index into KINDS), ``n_live``, ``n_example``. A null text counts as empty;
    rows that share an id stay rows of their own, but are one repository; a row
    without an id is a repository of its own; no rows give no rows. Very long
    texts are searched whole, also for matches of any length.
    """
    scanned = stored(candidates(df, id_col, text_col, owner_col).withColumn("row", F.monotonically_increasing_id()), "secret-candidates")
    # Without an id the row stands in for it.
    repository = F.struct("id", F.when(F.col("id").isNull(), F.col("row")).alias("row"))
    values = scanned.filter(F.size("cands") > 0).select("row", "owner", repository.alias("repository"), F.explode(F.array_distinct(F.col("cands.value"))).alias("value"))
    few = ownership(values).filter((F.col("owners") <= max_owners) & (F.col("repositories") <= max_repositories)).select("value")
    owned = values.select("row", "value").join(few, "value")
    per_row = owned.groupBy("row").agg(F.collect_list("value").alias("own"))
    kept = scanned.join(per_row, "row", "left").withColumn("own", F.coalesce("own", F.array().cast("array<string>")))
    span = lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["kind"].alias("kind"))
    is_base = lambda c: c["kind"] < 3
    live = lambda c: c["random"] & F.array_contains(F.col("own"), c["value"])
    base = F.filter("cands", is_base)
    return kept.select(
        F.col("id").alias(id_col),
        F.transform(base, span).alias("base"),
        F.transform(F.filter("cands", lambda c: is_base(c) | live(c)), span).alias("spans"),
        F.size(F.filter(base, live)).cast("long").alias("n_live"),
        F.size(F.filter(base, lambda c: ~F.array_contains(F.col("own"), c["value"]))).cast("long").alias("n_example"),
    )
