import hashlib
import random

import numpy as np

from ordersight.llm import fingerprints as fp
from ordersight.llm.queries import op8_fingerprints


def _words(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopé") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_likeness_separates():
    near, far = [], []
    for seed, n in enumerate([30, 60, 200, 500, 3000] * 6):
        text, other = _words(seed, n), _words(1000 + seed, n)
        half = len(text) // 2
        edited = text[: len(text) - half] + other[:half]
        near.append(fp.likeness(fp.fingerprint(text), fp.fingerprint(edited)))
        far.append(fp.likeness(fp.fingerprint(text), fp.fingerprint(other)))
    assert min(near) > 0.3 and np.mean(near) > 0.5 and np.mean(far) < 0.05


def test_stretches_do_not_matter(monkeypatch):
    texts = ["", "a", "aaaaaaa" * 50, _words(3, 700), "x" * 5000 + _words(4, 50)]
    whole = [fp.fingerprint(t) for t in texts]
    monkeypatch.setattr(fp, "STRETCH", 37)
    assert [fp.fingerprint(t) for t in texts] == whole


def test_common_subsequence_brute():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randint(0, 12))) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = table[i - 1][j - 1] + 1 if x == y else max(table[i - 1][j], table[i][j - 1])
        assert fp._common(a, b) == table[-1][-1]


def _brute(rows):
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    out = []
    for at, (i, text) in enumerate(ordered):
        text, after = text or "", ordered[(at + 1) % len(ordered)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        a, b, c = map(fp.fingerprint, (text, edited, after))
        out.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, fp.likeness(a, b), fp.likeness(a, c)))
    return sorted(out, key=str)


def test_query_equals_brute_force(spark, tmp_path):
    rng = random.Random(9)
    rows = [(rng.randint(-50, 10**6), _words(i, rng.randint(1, 300))) for i in range(300)]
    rows += [(5, None), (5, ""), (5, "émoji 😀 text " * 9), (None, "no id"), (None, None), (77, rows[3][1]), (78, rows[3][1]), (79, _words(1, 20_000))]
    for name, some in (("many", rows), ("one", rows[:1]), ("none", [])):
        path = str(tmp_path / name)
        spark.createDataFrame([(*r, "z") for r in some], "doc_id long, text string, n_chars string").repartition(3).write.parquet(f"{path}/documents.parquet")
        assert sorted(map(tuple, op8_fingerprints(spark, path).collect()), key=str) == _brute(some)


def test_an_id_with_a_third_of_the_rows_spreads(spark):
    from pyspark.sql import functions as F

    rows = [(7 if i % 3 == 0 else i, f"{_words(i, 3)} {i}") for i in range(6000)] + [(None, _words(i, 3)) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    dealt = fp.with_next(df, "doc_id", "text")
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert max(sizes) <= 2 * sum(sizes) / len(sizes)
    assert sum(sizes) <= len(rows) + len(sizes)


def test_ranges_follow_the_size_of_the_texts(spark, monkeypatch):
    monkeypatch.setattr(fp, "RANGE_BYTES", 2_000)
    rows = [(i, _words(i, 40)) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert len(fp._cuts(fp._ordered(df, "doc_id", "text"))) > 20
    got = sorted((r["doc_id"], r["near_next"]) for r in fp.neighbour_fingerprints(df, "doc_id", "text").collect())
    assert got == [(r[0], r[6]) for r in sorted(_brute(rows))]
