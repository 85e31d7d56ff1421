"""The queries of this package: thin forms that apply an operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm import bpe, conversations, covertree, fingerprints, merkle, neardup, oracles, packing, pii, quality, secrets, simhash, spans, urls, warc
from ordersight.llm.common import scratch, table, vocabulary


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode every text, decode it again, return digests of both."""
    with open(vocabulary("byte_bpe_multi_50k.tiktoken"), "rb") as f:
        ranks = f.read()
    coded = bpe.encode_documents(table(spark, sf_dir, "documents"), "doc_id", "text", ranks, public_tokenizers.PATTERN, decoded=True)
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every text: fixed rules, and what the skip-chain model adds."""
    docs = table(spark, sf_dir, "documents")
    found = pii.find_personal_data(docs, "doc_id", "text", pii.fit(docs, "text"))
    return found.select(
        "doc_id",
        *(spans.how_many("base", i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)),
        F.sha2(spans.rendered("base", pii.KINDS), 256).alias("base_sha256"),
        spans.rendered("spans", pii.KINDS).alias("spans"),
    )


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document."""
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write every page as a WARC record, read the archives back by byte ranges."""
    folder = scratch(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), folder, "page_id", "url", "html")
    back = warc.read_archives(spark, folder)
    return back.select(
        "page_id",
        F.coalesce(F.octet_length("payload").cast("long"), "http_length").alias("payload_bytes"),
        F.coalesce(F.sha2("payload", 256), "header_digest").alias("payload_digest"),
        "record_type",
        "refers_to",
    )


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Judge every URL: the longest fitting rule, else the n-gram model."""
    pages = table(spark, sf_dir, "pages")
    model = urls.train(urls.labelled_urls(pages, "url"))
    return urls.judge(pages, "page_id", "url", model)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every text by the rule ensemble; labels of held-out rows stay unseen."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    scored = docs.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), model.column(F.col("text")).alias("score"))
    return scored.select("*", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text: fixed rules, and owner-specific live-looking words."""
    found = secrets.find_secrets(table(spark, sf_dir, "documents"), "doc_id", "text", "source")
    return found.select(
        "doc_id",
        *(spans.how_many("base", i).alias(f"n_{kind}") for i, kind in enumerate(secrets.KINDS[:3])),
        F.sha2(spans.rendered("base", secrets.KINDS), 256).alias("base_sha256"),
        spans.rendered("spans", secrets.KINDS).alias("spans"),
        "n_live",
        "n_example",
    )


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint every text and its half-edited form; compare with that and with the next document."""
    found = fingerprints.neighbour_fingerprints(table(spark, sf_dir, "documents"), "doc_id", "text")
    return found.select("doc_id", "n_chars", F.sha2(F.encode("edited", "UTF-8"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def packed_pieces(docs: DataFrame) -> DataFrame:
    """Documents tokenized with the lower-case word vocabulary and packed, the ids as their CRC-32."""
    with open(vocabulary("word_bpe_49k.json"), "rb") as f:
        pieces = packing.pack_documents(docs, "doc_id", "text", f.read(), end_id=2)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "window", "step_group")


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pack all documents into sequences of at most 4096 tokens."""
    return packed_pieces(table(spark, sf_dir, "documents"))


def op10_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    return covertree.top_k(table(spark, sf_dir, "embeddings"), "vec_id", "embedding", lambda i: i % 50 == 0, 5)


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The hash tree over all documents, each row's proof, and what a tampered text folds to."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0
    return merkle.manifest(docs, "doc_id", "lang", ["doc_id", "source", "lang", "n_chars", "text"], "text", tampered)


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The SimHash of every document and the class it belongs to."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), "doc_id", "text")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damage every conversation, repair it by the cheapest edits, audit them."""
    return conversations.repaired(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_pii": op2_pii,
    "op3_near_duplicates": op3_near_duplicates,
    "op4_warc": op4_warc,
    "op5_url_filter": op5_url_filter,
    "op6_quality": op6_quality,
    "op7_secrets": op7_secrets,
    "op8_fingerprints": op8_fingerprints,
    "op9_packing": op9_packing,
    "op10_top_k": op10_top_k,
    "op11_merkle": op11_merkle,
    "op12_simhash": op12_simhash,
    "op13_conversations": op13_conversations,
}

#: DuckDB SQL for those queries that SQL can express.
ORACLE_SQL: dict[str, str] = {
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h, sha256(coalesce(html, '')) AS payload_digest FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first FROM p WHERE strlen(h) >= 100 GROUP BY 1)
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)""",
    "op10_top_k": """
WITH v AS (
  SELECT vec_id, row_number() OVER () AS r, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, q.r AS r, d.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.w, d.w), lambda z: coalesce(z[1] * z[2], 0))) AS BIGINT) AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.r <> q.r
), b AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s
)
SELECT * FROM b WHERE rank <= 5""",
    "op11_merkle": oracles.MERKLE,
    "op13_conversations": oracles.CONVERSATIONS,
}
