"""Quality classifier: a sparse ensemble of rules read off shallow trees.

Boosted trees over text statistics give candidate rules, the conjunctions on
the paths to their nodes. A logistic regression with an L1 penalty keeps few
of them. Rules and weights are compiled into one Spark column, so scoring is a
projection without Python and reads each text once.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ordersight.llm.common import hashed_sample

#: Labelled rows in the training sample, at most.
SAMPLE_ROWS = 8000
TREES = 24
DEPTH = 3
BINS = 32
PENALTY = 0.002

STATISTICS = ("chars", "words", "word_length", "symbols", "marks", "capitals", "digits", "distinct_words", "distinct_lines", "line_length", "stops", "short_words")


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once a row, wherever the optimizer moves the whole."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def statistics(text: Column) -> Column:
    """Struct of the STATISTICS of one text; all are finite, also for null (as empty), blank and very long texts, which are read whole."""
    part = lambda a, b: a.cast("double") / F.greatest(b, F.lit(1)).cast("double")
    left = lambda t, pattern: F.length(F.regexp_replace(t, pattern, ""))

    def of_parts(p: Column) -> Column:
        t, words, lines, n = p["t"], p["words"], p["lines"], p["n"]
        n_words, n_lines = F.size(words), F.size(lines)
        return F.struct(
            F.log1p(n.cast("double")).alias("chars"),
            F.log1p(n_words.cast("double")).alias("words"),
            part(n, n_words).alias("word_length"),
            part(n - F.length(F.translate(t, "|%$#&*@^~<>{}[]\\/=_+", "")), n).alias("symbols"),
            part(n - F.length(F.translate(t, "!?", "")), n_words).alias("marks"),
            part(left(t, r"[^\p{Lu}]+"), n).alias("capitals"),
            part(n - F.length(F.translate(t, "0123456789", "")), n).alias("digits"),
            part(F.size(F.array_distinct(words)), n_words).alias("distinct_words"),
            part(F.size(F.array_distinct(lines)), n_lines).alias("distinct_lines"),
            part(n, n_lines).alias("line_length"),
            part(n - F.length(F.translate(t, ".,;:", "")), n_words).alias("stops"),
            part(F.size(F.filter(words, lambda w: F.length(w) <= 3)), n_words).alias("short_words"),
        )

    def of_text(t: Column) -> Column:
        words = F.filter(F.split(t, r"\s+"), lambda w: w != "")
        return _let(F.struct(t.alias("t"), F.length(t).alias("n"), words.alias("words"), F.split(t, "\n").alias("lines")), of_parts)

    return _let(F.coalesce(text.cast("string"), F.lit("")), of_text)


Condition = tuple[int, bool, float]
"""(statistic, above, bound): the statistic is above the bound, or not."""


@dataclass(frozen=True)
class RuleModel:
    intercept: float
    rules: tuple[tuple[Condition, ...], ...] = field(default=())
    weights: tuple[float, ...] = field(default=())

    def column(self, text: Column) -> Column:
        """The score of a text, 0 to 1, as a Spark expression."""

        def score(s: Column) -> Column:
            total = F.lit(float(self.intercept))
            for rule, weight in zip(self.rules, self.weights):
                holds = F.lit(True)
                for at, above, bound in rule:
                    holds = holds & (s[STATISTICS[at]] > bound if above else s[STATISTICS[at]] <= bound)
                total = total + F.when(holds, F.lit(float(weight))).otherwise(F.lit(0.0))
            return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

        return _let(statistics(text), score)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The same score for rows of statistics."""
        return 1 / (1 + np.exp(-(self.intercept + _holds(self.rules, x) @ np.array(self.weights))))


def _holds(rules, x: np.ndarray) -> np.ndarray:
    out = np.ones((len(x), len(rules)))
    for j, rule in enumerate(rules):
        for at, above, bound in rule:
            out[:, j] *= (x[:, at] > bound) == above
    return out


def _tree_rules(binned: np.ndarray, cuts: list[np.ndarray], residual: np.ndarray, rows: np.ndarray, path: tuple[Condition, ...], fit: np.ndarray, found: dict) -> None:
    """Grow one regression tree from ``path`` on; add its paths to ``found`` and its leaf means to ``fit``."""
    best = (1e-9, None)
    total, n = residual[rows].sum(), len(rows)
    if len(path) < DEPTH and n >= 20:
        for f, cut in enumerate(cuts):
            if len(cut):
                sums = np.bincount(binned[rows, f], residual[rows], len(cut) + 1).cumsum()[:-1]
                sizes = np.bincount(binned[rows, f], minlength=len(cut) + 1).cumsum()[:-1]
                ok = (sizes >= 5) & (n - sizes >= 5)
                gain = np.where(ok, sums**2 / np.maximum(sizes, 1) + (total - sums) ** 2 / np.maximum(n - sizes, 1) - total**2 / n, 0)
                if gain.max() > best[0]:
                    best = (gain.max(), (f, int(gain.argmax())))
    if best[1] is None:
        fit[rows] += total / max(n, 1)
        return
    f, b = best[1]
    above = binned[rows, f] > b
    for side in (False, True):
        longer = (*path, (f, side, float(cuts[f][b])))
        found.setdefault(longer)
        _tree_rules(binned, cuts, residual, rows[above == side], longer, fit, found)


def train(x: np.ndarray, y: np.ndarray, trees: int = TREES, penalty: float = PENALTY, seed: int = 11) -> RuleModel:
    """Rules and lasso weights. Without both labels the score is the smoothed share of label 1."""
    share = (y.sum() + 1) / (len(y) + 2)
    base = float(np.log(share / (1 - share)))
    if len(np.unique(y)) < 2:
        return RuleModel(base)
    rng = np.random.default_rng(seed)
    cuts = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, BINS + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(c, x[:, f], side="left") for f, c in enumerate(cuts)], 1)
    fit, found = np.full(len(y), base), {}
    for _ in range(trees):
        rows = np.flatnonzero(rng.random(len(y)) < 0.6)
        step = np.zeros(len(y))
        residual = y - 1 / (1 + np.exp(-fit))
        _tree_rules(binned, cuts, residual, rows, (), step, found)
        fit += 2.0 * step
    rules = list(found)
    a = _holds(rules, x)
    keep = {a[:, j].tobytes(): j for j in reversed(range(len(rules))) if 0 < a[:, j].mean() < 1}
    rules = [rules[j] for j in sorted(keep.values())]
    weights, intercept = _lasso(_holds(rules, x), y, penalty)
    used = np.flatnonzero(weights)
    return RuleModel(intercept, tuple(rules[j] for j in used), tuple(float(weights[j]) for j in used))


def _lasso(a: np.ndarray, y: np.ndarray, penalty: float, steps: int = 400) -> tuple[np.ndarray, float]:
    """Logistic weights under an L1 penalty, by accelerated proximal steps; the intercept is free."""
    n, m = a.shape
    a = np.concatenate([a, np.ones((n, 1))], 1).astype(np.float32)
    w = np.zeros(m + 1, np.float32)
    v = np.ones(m + 1, np.float32)
    for _ in range(20):  # largest eigenvalue, for the step size
        v = a.T @ (a @ v)
        v /= np.linalg.norm(v)
    rate = 4 * n / float(v @ (a.T @ (a @ v)))
    z, t = w.copy(), 1.0
    bound = np.full(m + 1, rate * penalty, np.float32)
    bound[-1] = 0
    for _ in range(steps):
        g = a.T @ (1 / (1 + np.exp(-(a @ z))) - y) / n
        new = z - rate * g
        new = np.sign(new) * np.maximum(np.abs(new) - bound, 0)
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        z, w, t = new + (t - 1) / t_new * (new - w), new, t_new
    return w[:-1], float(w[-1])


def held_out(id_col: Column) -> Column:
    """Whether the row's label must stay unseen: crc32 of the id as text is a multiple of 5. A null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int = SAMPLE_ROWS) -> RuleModel:
    """Train on the ``rows`` labelled rows with the smallest id hashes that are not held out.

    Rows without id or label, or without a document, do not count; of documents
    that share a labelled id only the text with the least hash does. So the
    driver gets the statistics of at most ``rows`` texts, and never the texts.
    With no labelled rows at all every text scores alike.
    """
    picked = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("double").alias("y"))
        .filter(F.col("id").isNotNull() & F.col("y").isin(0.0, 1.0) & ~held_out(F.col("id")))
    )
    picked = hashed_sample(picked, ["id", "y"], rows)
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    # Statistics are computed where the texts are; one row a label is shuffled.
    found = texts.join(F.broadcast(picked), "id").select("id", "y", F.xxhash64("text").alias("h"), F.octet_length(F.coalesce("text", F.lit(""))).alias("n"), statistics(F.col("text")).alias("s"))
    sample = found.groupBy("id", "y").agg(F.min(F.struct("h", "n", "s")).alias("one")).select("id", "y", "one.s.*")
    got = sorted(map(tuple, sample.limit(rows).collect()))
    data = np.array([r[1:] for r in got], np.float64).reshape(-1, len(STATISTICS) + 1)
    return train(data[:, 1:], data[:, 0])


def with_score(docs: DataFrame, text_col: str, model: RuleModel, score_col: str = "score") -> DataFrame:
    """``docs`` and ``score_col`` (0 to 1, higher: better text), also for null and empty texts. Replaces a column of that name."""
    return docs.withColumn(score_col, model.column(F.col(text_col)))
