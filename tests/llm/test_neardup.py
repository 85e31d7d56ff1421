import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from ordersight.llm import neardup as nd
from ordersight.llm.queries import op3_near_duplicates


def _shingles(text):
    words = [w for w in text.translate(str.maketrans("\t\n\r\x0b\x0c", "     ")).split(" ") if w]
    n = min(nd.WORDS, len(words))
    return Counter(tuple(words[i : i + n]) for i in range(len(words) - n + 1)) if n else Counter()


def _brute(rows, similarity=nd.SIMILARITY):
    """Class id by (id, text), by comparing all pairs."""
    bags = {t: _shingles(t) for t in {t or "" for _, t in rows}}
    df = Counter(s for _, t in rows for s in bags[t or ""])
    n = len(rows)
    idf = {s: 1 + nd.IDF_RANGE * math.log(max(c / n, nd.FREQUENT)) / math.log(nd.FREQUENT) for s, c in df.items()}
    texts = sorted(bags)
    parent = {t: t for t in texts}

    def top(t):
        while parent[t] != t:
            t = parent[t]
        return t

    for i, a in enumerate(texts):
        for b in texts[:i]:
            x, y = bags[a], bags[b]
            both = x.keys() & y.keys()
            if both:
                low = sum(min(x[s], y[s]) * idf[s] for s in both)
                high = sum(v * idf[s] for s, v in x.items()) + sum(v * idf[s] for s, v in y.items()) - low
                if low >= (similarity - 1e-6) * high:
                    parent[top(a)] = top(b)
    least = {}
    for i, t in rows:
        c = top(t or "")
        least[c] = min(least.get(c, i), i)
    return sorted((i, least[top(t or "")]) for i, t in rows)


def _edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        at = rng.randrange(len(out))
        if rng.random() < 0.5:
            out[at] = f"edit{rng.randrange(10**6)}"
        else:
            out.insert(at, f"more{rng.randrange(10**6)}")
    return " ".join(out)


def _corpus(seed, groups=14, hot=70):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8)))
    licence = [word() for _ in range(30)]
    texts = []
    for _ in range(groups):
        words = [word() for _ in range(rng.randint(20, 300))] + (licence if rng.random() < 0.5 else [])
        texts += [" ".join(words)] * rng.randint(1, 3)
        texts += [_edited(rng, words, max(1, int(len(words) * rng.choice([0.005, 0.02, 0.04, 0.1])))) for _ in range(rng.randint(0, 4))]
    words = [word() for _ in range(200)]
    texts += [_edited(rng, words, rng.randint(1, 8)) for _ in range(hot)] + [" ".join(words)] * hot
    texts += ["", None, " \n", "one", "one", "one two", "ü é ß", "a b c d", "a b c d e", "der der der " * 400, "der der der " * 401, " ".join(word() for _ in range(20_000))]
    rng.shuffle(texts)
    return [(i * 3 + 5, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("seed", [1, 2])
def test_classes_equal_all_pairs(spark, tmp_path, seed, monkeypatch):
    if seed == 2:
        monkeypatch.setattr(nd, "BLOCK", 16)
    rows = _corpus(seed)
    spark.createDataFrame([(*r, "x", 7) for r in rows], "doc_id long, text string, node string, class_id int").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    got = op3_near_duplicates(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == _brute(rows)
    kept = [r["doc_id"] for r in got if r["kept"]]
    assert sorted(kept) == sorted({r["class_id"] for r in got})


def test_odd_rows_and_filter(spark):
    rows = [(None, "a b c d e f", 1), (4, "a b c d e f", 2), (4, "other text here now ok", 3), (4, "a b c d e f", 4), (9, None, 5), (8, "", 6), (7, "x y", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id int")
    got = sorted(((r["doc_id"], r["class_id"]) for r in nd.near_duplicates(df, "doc_id", "text").collect()), key=str)
    assert got == sorted([(None, None), (4, None), (4, None), (4, 4), (9, 8), (8, 8), (7, 7)], key=str)
    plain = df.withColumnRenamed("__id", "extra")
    left = sorted(map(tuple, nd.without_near_duplicates(plain, "doc_id", "text").collect()), key=str)
    assert [(r[0], r[1]) for r in left] == [(r[0], r[1]) for r in sorted([(4, "other text here now ok", 3), (7, "x y", None), (8, "", 6), (None, "a b c d e f", 1)], key=str)]
    assert nd.near_duplicates(df.limit(0), "doc_id", "text").count() == 0


def test_samples_agree_as_often_as_similarity():
    rng = np.random.default_rng(3)
    sampler, weights = nd.Sampler(), nd.Weights(np.empty(0, np.uint64), np.empty(0), 10)
    for share in (0.5, 0.8, 0.95):
        hits, want = [], []
        for _ in range(60):
            common = rng.integers(0, 2**63, 400, dtype=np.uint64)
            cut = int(400 * 2 * share / (1 + share))
            bags = [np.concatenate([np.repeat(common[:cut], rng.integers(1, 3)), rng.integers(0, 2**63, 400 - cut, dtype=np.uint64)]) for _ in range(2)]
            (ka, wa), (kb, wb) = map(weights.of, bags)
            _, i, j = np.intersect1d(ka, kb, return_indices=True)
            low = np.minimum(wa[i], wb[j]).sum()
            want.append(low / (wa.sum() + wb.sum() - low))
            hits.append((sampler.sketch(ka, wa) == sampler.sketch(kb, wb)).mean())
        assert abs(np.mean(hits) - np.mean(want)) < 0.03


def test_shingles_do_not_depend_on_the_batch(monkeypatch):
    texts = ["a b c d e f g", "", " a  b\nc\td e f g ", "é ü", None, "x" * 1000 + " y z", "a b c d e f g"]
    whole = [s.tolist() for s in nd.shingle_lists(pa.array(texts))]
    monkeypatch.setattr(nd, "PASS_BYTES", 1)
    assert [s.tolist() for s in nd.shingle_lists(pa.array(texts))] == whole
    assert whole[0] == whole[2] == whole[6] and len(whole[0]) == 3 and whole[1] == whole[4] == [] and len(whole[5]) == 1


def test_components_of_a_path(spark):
    n = 60
    name = lambda i: int.to_bytes((i * 37) % 101, 2, "big")
    links = spark.createDataFrame([(bytearray(name(i)), bytearray(name(i + 1))) for i in range(n)], "a binary, b binary")
    got = {bytes(r["node"]): bytes(r["component"]) for r in nd.components(links).collect()}
    assert got == {name(i): min(name(j) for j in range(n + 1)) for i in range(n + 1)}


def test_screen_loses_far_less_than_the_bands():
    for similarity in (nd.SIMILARITY, 0.81, 0.85, 0.9):
        hit, need = similarity + (1 - similarity) / 256, math.ceil(nd.AGREEMENT * nd.SAMPLES)
        screen = sum(math.comb(nd.SAMPLES, k) * hit**k * (1 - hit) ** (nd.SAMPLES - k) for k in range(need))
        assert screen < 0.25 * (1 - similarity ** (nd.SAMPLES // nd.BANDS)) ** nd.BANDS


def test_rows_that_stay_keep_all_their_columns(spark):
    text = " ".join(f"word{i}" for i in range(200))
    rows = [(1, text, "mine", "keep", 5), (2, text + " more", "mine", "gone", 6), (3, "another text of its own altogether here", "mine", "keep", 7), (3, "another text of its own altogether here", "mine", "keep", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, __id string, node string, row int")
    assert sorted(map(tuple, nd.without_near_duplicates(df, "doc_id", "text").collect())) == [rows[0], rows[2]]
    assert nd.without_near_duplicates(df, "doc_id", "text").columns == df.columns


def test_which_of_two_equal_texts_stays_does_not_depend_on_their_order(spark):
    text = " ".join(f"word{i}" for i in range(50))
    rows = [(1, text, i) for i in range(20)]
    left = {tuple(map(tuple, nd.without_near_duplicates(spark.createDataFrame(some, "doc_id long, text string, x int").repartition(n), "doc_id", "text").collect())) for n, some in ((1, rows), (5, rows[::-1]))}
    assert len(left) == 1
