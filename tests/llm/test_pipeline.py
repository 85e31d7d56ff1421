"""The pipeline's stages against brute force on their own inputs."""

import zlib

import numpy as np
import public_tokenizers as P
from pyspark.sql.functions import lit
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from ordersight.llm import pii, quality
from ordersight.llm.common import stored, table
from tests.llm.test_neardup import _brute
from tests.llm.test_spans import _plain_pii

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = table(spark, SF, "documents")
    columns = docs.columns
    source = {r["doc_id"]: r for r in docs.collect()}

    good = stored(C.good_quality(spark, docs, SF), "t")
    assert good.columns == columns
    model = quality.fit(docs, table(spark, SF, "labels"), "doc_id", "text", "quality")
    stats = np.array([list(r["s"]) for r in docs.select("doc_id", quality.statistics(docs["text"]).alias("s")).orderBy("doc_id").collect()])
    keep = model.scores(stats) >= C.KEEP_SCORE
    kept = {r["doc_id"]: r for r in good.collect()}
    assert sorted(kept) == [i for i, k in zip(sorted(source), keep) if k] and all(kept[i] == source[i] for i in kept)

    single = stored(C.one_of_each_class(spark, good, SF), "t")
    assert single.columns == columns
    rows = single.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted({c for _, c in _brute([(i, r["text"]) for i, r in kept.items()])})
    assert all(r == kept[r["doc_id"]] for r in rows)

    clean = stored(C.masked_personal_data(spark, single, SF), "t")
    assert clean.columns == columns
    texts = {r["doc_id"]: r for r in clean.collect()}
    assert len(texts) == len(rows)
    changed = 0
    for r in rows:
        base, now = _plain_pii(r["text"]), texts[r["doc_id"]]
        if base:
            changed += 1
            assert not any(r["text"][a:b] in now["text"] for a, b, _ in base) and now["n_chars"] == len(now["text"])
        elif not pii.mentions(r["text"], []).spans:
            assert now == r
    assert changed

    pieces = C.packed(spark, clean, SF).collect()
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    ids = {i: np.array([*lib.encode(r["text"], add_special_tokens=False).ids, 2], "<u4") for i, r in texts.items()}
    total = dict.fromkeys(ids, 0)
    for p in pieces:
        part = ids[p["doc_id"]][p["start"] : p["start"] + p["length"]]
        assert p["ids_crc32"] == zlib.crc32(part.tobytes()) and len(part) == p["length"] and p["doc_tokens"] == len(ids[p["doc_id"]])
        total[p["doc_id"]] += p["length"]
    assert total == {i: len(x) for i, x in ids.items()}

    def facts(df):
        return sorted((r["doc_id"], r["doc_tokens"]) for r in df.select("doc_id", "doc_tokens").distinct().collect())

    assert facts(E.queries()["pipeline"](spark, SF)) == sorted((i, len(x)) for i, x in ids.items())


def test_nulls_repeated_rows_and_clashing_names(spark, tmp_path):
    good = [r for r in table(spark, SF, "documents").orderBy("doc_id").limit(30).collect()]
    rows = [(r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"]) for r in good]
    rows += rows[:5] + [(None, None, None, None, None), (None, rows[7][1], "en", "s", 1), (3, "", None, "s", 0), (3, rows[9][1], "en", None, None)]
    path = str(tmp_path / "odd")
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    extra = ("id", "node", "row", "first", "score", "bands", "key", "ids", "__id")
    for c in extra:
        df = df.withColumn(c, lit("mine"))
    df.write.parquet(f"{path}/documents.parquet")
    table(spark, SF, "labels").write.parquet(f"{path}/labels.parquet")
    docs, left = table(spark, path, "documents"), None
    for _, stage in C.STAGES[:-1]:
        docs = stored(stage(spark, docs, path), "t")
        assert docs.columns == df.columns
        now = docs.collect()
        assert all(r[c] == "mine" for r in now for c in extra)
        assert left is None or len(now) <= left
        left = len(now)
    pairs = [(r["doc_id"], r["text"]) for r in now]
    assert len(pairs) == len(set(pairs)) > 0
    pieces = C.packed(spark, docs, path).collect()
    assert len({(p["doc_id"], p["doc_tokens"]) for p in pieces}) > 0
    totals = sum(p["length"] for p in pieces)
    lib = Tokenizer.from_file(P.path("word_bpe_49k.json"))
    assert totals == sum(len(lib.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in pairs)


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert C.run(spark, str(tmp_path)).collect() == []


def test_every_operator_is_registered():
    names = E.queries()
    assert all(sum(n.startswith(f"op{i}_") for n in names) == 1 for i in range(1, 14)) and "pipeline" in names
    assert [n for n, _ in C.STAGES] == ["quality classifier", "near-duplicates", "personal data", "packing"]
