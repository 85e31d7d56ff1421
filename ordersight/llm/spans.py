"""Text spans: rendering and digests shared by the span-finding operators."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

Span = tuple[int, int, int]
"""(start, end, kind): code points, end exclusive, kind as an index into the operator's list of kinds."""


def ordered(spans: Iterable[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[0], s[2], s[1]))


def rendered(spans: str, kinds: Sequence[str]) -> Column:
    """An array column of spans as ``kind:start:end`` by start, then kind as listed, joined by commas."""
    names = F.array(*map(F.lit, kinds))
    order = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("a"), s["kind"].alias("k"), s["end"].alias("b"))))
    return F.array_join(F.transform(order, lambda s: F.concat_ws(":", F.element_at(names, s["k"] + 1), s["a"].cast("string"), s["b"].cast("string"))), ",")


def how_many(spans: str, kind: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")
