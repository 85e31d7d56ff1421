"""URL filter: fixed host-and-path rules first, else a logistic regression on hashed character n-grams.

The model reads the n-grams of host and path, hashed apart into one table of
weights. It is trained from a small labelled URL table; without one, the URLs
that a rule decides serve as labels, a bounded sample of each verdict.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.llm.common import hashed_sample

#: (verdict, host, path): fixed values. A rule's name is host and path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
BUCKETS = 1 << 14
GRAMS = (3, 4, 5)
#: Characters of URLs that are hashed together.
STRETCH = 1 << 20
#: Labelled URLs of each verdict in the training table, at most.
SAMPLE_URLS = 1500

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is none."""
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_index(host_col: Column, path_col: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Index of the longest rule that fits, the first listed of equally long ones; null if none does."""
    out = F.lit(None).cast("int")
    for i in sorted(range(len(rules)), key=lambda i: (len(rules[i][1] + rules[i][2]), -i)):
        _, h, p = rules[i]
        out = F.when(((host_col == h) | host_col.endswith(f".{h}")) & path_col.startswith(p), F.lit(i)).otherwise(out)
    return out


def gram_buckets(host_text: str, path_text: str, buckets: int = BUCKETS) -> np.ndarray:
    """Hash buckets of the n-grams of host and path; each is framed by a mark of its own."""
    found = []
    for mark, text in ((b"\x01", host_text), (b"\x02", path_text)):
        code = np.frombuffer(mark + text.encode("utf-8", "replace") + mark, np.uint8).astype(np.uint64)
        for n in GRAMS:
            if len(code) >= n:
                h = np.full(len(code) - n + 1, int(mark[0]) * 7 + n, np.uint64)
                for j in range(n):
                    h = (h ^ code[j : len(code) - n + 1 + j]) * np.uint64(0x100000001B3)
                found.append((h ^ (h >> np.uint64(29))) % np.uint64(buckets))
    return np.concatenate(found).astype(np.int64) if found else np.empty(0, np.int64)


def all_gram_buckets(hosts: Sequence[str], paths: Sequence[str], buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """(row, bucket) of the n-grams of many URLs, hashed together; what ``gram_buckets`` gives for each."""
    marks = (b"\x01", b"\x02")
    framed = [mark + text.encode("utf-8", "replace") + mark for pair in zip(hosts, paths) for mark, text in zip(marks, pair)]
    code = np.frombuffer(b"".join(framed), np.uint8).astype(np.uint64)
    part = np.repeat(np.arange(len(framed)), [len(f) for f in framed])
    mark = (part % 2 + 1).astype(np.uint64) * np.uint64(7)
    rows, found = [], []
    for n in GRAMS:
        m = max(len(code) - n + 1, 0)
        whole = np.flatnonzero(part[:m] == part[n - 1 : n - 1 + m])
        h = mark[whole] + np.uint64(n)
        for j in range(n):
            h = (h ^ code[whole + j]) * np.uint64(0x100000001B3)
        rows.append(part[whole] // 2)
        found.append(((h ^ (h >> np.uint64(29))) % np.uint64(buckets)).astype(np.int64))
    return np.concatenate(rows), np.concatenate(found)


def _stretches(hosts: Sequence[str], paths: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of URLs of about STRETCH characters together, or of one longer URL."""
    start = held = 0
    for i, (h, p) in enumerate(zip(hosts, paths)):
        if held and held + len(h) + len(p) > STRETCH:
            yield start, i
            start, held = i, 0
        held += len(h) + len(p) + 4
    if start < len(hosts):
        yield start, len(hosts)


@dataclass(frozen=True)
class UrlModel:
    intercept: float
    weights: np.ndarray

    def blocks(self, host_text: str, path_text: str) -> float:
        """Probability that the URL is to be blocked."""
        at = gram_buckets(host_text, path_text, len(self.weights))
        score = self.intercept + (self.weights[at].sum() / len(at) ** 0.5 if len(at) else 0.0)
        return float(1 / (1 + np.exp(-score)))

    def blocks_all(self, hosts: Sequence[str], paths: Sequence[str]) -> np.ndarray:
        """``blocks`` of many URLs at once."""
        out = [np.empty(0)]
        for a, b in _stretches(hosts, paths):
            row, at = all_gram_buckets(hosts[a:b], paths[a:b], len(self.weights))
            n = np.maximum(np.bincount(row, minlength=b - a), 1)
            score = self.intercept + np.bincount(row, self.weights[at], b - a) / n**0.5
            out.append(1 / (1 + np.exp(-score)))
        return np.concatenate(out)


def train(rows: Sequence[tuple[str, str, int]], steps: int = 200, rate: float = 0.5, shrink: float = 1e-3) -> UrlModel:
    """Weights from (host, path, 1 to block or 0) by full gradient steps. Without rows nothing is blocked."""
    if not rows:
        return UrlModel(-1.0, np.zeros(BUCKETS))
    grams = [gram_buckets(h, p) for h, p, _ in rows]
    row = np.repeat(np.arange(len(rows)), [len(g) for g in grams])
    at = np.concatenate(grams)
    value = np.repeat([1 / max(1, len(g)) ** 0.5 for g in grams], [len(g) for g in grams])
    y = np.array([r[2] for r in rows], np.float64)
    w, b, seen, seen_b = np.zeros(BUCKETS), 0.0, np.full(BUCKETS, 1e-8), 1e-8
    for _ in range(steps):
        score = np.bincount(row, w[at] * value, len(rows)) + b
        off = 1 / (1 + np.exp(-score)) - y
        g = np.bincount(at, off[row] * value, BUCKETS) / len(rows) + shrink * w
        seen += g * g
        seen_b += off.mean() ** 2
        w -= rate * g / np.sqrt(seen)
        b -= rate * off.mean() / seen_b**0.5
    return UrlModel(b, w)


def labelled_urls(df: DataFrame, url_col: str, rules: Sequence[tuple[str, str, str]] = RULES, each: int = SAMPLE_URLS) -> list[tuple[str, str, int]]:
    """(host, path, 1 for block) of at most ``each`` different URLs of either verdict, those with the smallest hashes."""
    rows = df.select(host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    rows = rows.select("host", "path", rule_index(F.col("host"), F.col("path"), rules).alias("rule"))
    verdict = F.get(F.array(*(F.lit(int(v == "block")) for v, _, _ in rules)), F.col("rule"))
    rows = rows.filter("rule is not null").select("host", "path", verdict.alias("block"))
    out = []
    for label in (0, 1):
        picked = hashed_sample(rows.filter(F.col("block") == label), ["host", "path"], each, distinct=True)
        out += [tuple(r) for r in picked.collect()]
    return out


def judge(df: DataFrame, id_col: str, url_col: str, model: UrlModel, rules: Sequence[tuple[str, str, str]] = RULES) -> DataFrame:
    """id_col, host, path, rule, verdict and probability (that the model would block) of every row.

    A null URL, or one without ``://``, has an empty host and path; no rule
    fits it and the model judges it. Rows pass one by one, repeated or not; a
    URL of any length counts whole. An empty table gives no rows.
    """

    @F.pandas_udf("double")
    def blocks(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series(model.blocks_all(hosts.tolist(), paths.tolist()), dtype="float64")

    rows = df.select(F.col(id_col), host(F.col(url_col)).alias("host"), path(F.col(url_col)).alias("path"))
    judged = rows.select(id_col, "host", "path", rule_index(F.col("host"), F.col("path"), rules).alias("at"), blocks("host", "path").alias("probability"))
    name = F.get(F.array(*(F.lit(h + p) for _, h, p in rules)), F.col("at"))
    fixed = F.get(F.array(*(F.lit(v) for v, _, _ in rules)), F.col("at"))
    learned = F.when(F.col("probability") > 0.5, "block").otherwise("allow")
    return judged.select(id_col, "host", "path", name.alias("rule"), F.coalesce(fixed, learned).alias("verdict"), "probability")
