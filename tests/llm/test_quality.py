import random
import zlib

import numpy as np

from ordersight.llm import quality
from ordersight.llm.common import table
from ordersight.llm.queries import op6_quality
from pyspark.sql import functions as F

SF = "/root/testdata/sf0.01"


def _plain(text):
    t = text or ""
    words, lines = t.split(), t.split("\n")
    import unicodedata

    n, w, ln = len(t), max(1, len(words)), max(1, len(lines))
    share = lambda chars, b: sum(c in chars for c in t) / max(1, b)
    return (
        np.log1p(n),
        np.log1p(len(words)),
        n / w,
        share("|%$#&*@^~<>{}[]\\/=_+", n),
        share("!?", w),
        sum(unicodedata.category(c) == "Lu" for c in t) / max(1, n),
        share("0123456789", n),
        len(set(words)) / w,
        len(set(lines)) / ln,
        n / ln,
        share(".,;:", w),
        sum(len(x) <= 3 for x in words) / w,
    )


def test_statistics_and_compiled_rules_equal_plain_python(spark):
    texts = [None, "", " ", "\n\n", "One two. two!", "ÄÖ | x % 12\nÄÖ | x % 12", "a " * 50_000, "BUY!! NOW?"]
    df = spark.createDataFrame([(t, 1) for t in texts], "text string, score int")
    got = np.array([list(r[0]) for r in df.select(quality.statistics(F.col("text"))).collect()])
    assert np.allclose(got, [_plain(t) for t in texts])
    model = quality.RuleModel(0.3, (((0, True, 2.0), (5, False, 0.1)), ((3, True, 0.05),)), (1.5, -2.0))
    scores = [r["score"] for r in quality.with_score(df, "text", model).collect()]
    assert np.allclose(scores, model.scores(got))


def test_training_edge_cases():
    assert quality.train(np.zeros((0, 12)), np.zeros(0)).rules == ()
    one = quality.train(np.zeros((30, 12)), np.ones(30))
    assert one.rules == () and one.intercept > 0
    flat = quality.train(np.zeros((60, 12)), np.arange(60) % 2.0)
    assert abs(flat.scores(np.zeros((1, 12)))[0] - 0.5) < 0.1


def test_held_out_accuracy_and_query(spark):
    got = op6_quality(spark, SF).collect()
    truth = {r["doc_id"]: r["quality"] for r in table(spark, SF, "labels").collect()}
    assert len(got) == table(spark, SF, "documents").count()
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)
    test = [(r["predicted"], r["score"], truth[r["doc_id"]]) for r in got if r["held_out"] and r["doc_id"] in truth]
    good, bad = [s for _, s, y in test if y], [s for _, s, y in test if not y]
    auc = np.mean([[(g > b) + (g == b) / 2 for b in bad] for g in good])
    assert auc > 0.97 and np.mean([p == y for p, _, y in test]) > 0.95


def test_odd_tables(spark, tmp_path):
    rng = random.Random(5)
    rows = [(i if i % 9 else None, " ".join(rng.choice(["alpha", "beta", "gamma.", "delta"]) for _ in range(40)) if i % 2 else "$$ ## %% " * 20, None, "x") for i in range(300)]
    rows += [(1000, None, None, None), (1001, "", None, None), (1, rows[1][1], None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, score double, held_out string").write.parquet(str(tmp_path / "documents.parquet"))
    labels = [(i, i % 2) for i in range(300)] + [(None, 1), (5, None), (7, 1), (99_999, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(str(tmp_path / "labels.parquet"))
    got = op6_quality(spark, str(tmp_path)).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["predicted"] for r in got}
    assert by[11] == 1 and by[10] == 0


def test_documents_that_share_a_labelled_id_send_one_row(spark, monkeypatch):
    docs = spark.range(3000).select(F.when(F.col("id") % 3 != 0, F.lit(3)).otherwise(F.col("id")).alias("doc_id"), F.concat(F.lit("some words of text "), F.col("id")).alias("text"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(0, 600, 3)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda x, y: seen.append((len(x), len(y))))
    quality.fit(docs, labels, "doc_id", "text", "quality")
    want = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i in range(0, 600, 3))
    assert seen == [(want, want)]


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    assert op6_quality(spark, str(tmp_path)).collect() == []
