"""A training corpus from ``documents``: drop poor texts, near-duplicates and personal data, then pack.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes
each result to the shared folder and reads it back as the next stage's input.
All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ordersight.llm import neardup, pii, quality
from ordersight.llm.common import stored, table
from ordersight.llm.queries import packed_pieces

#: Documents that score less are dropped.
KEEP_SCORE = 0.3


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the rule ensemble, trained on ``labels``, does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"), "doc_id", "text", "quality")
    return docs.filter(model.column(F.col("text")) >= KEEP_SCORE)


def one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest id."""
    return neardup.without_near_duplicates(docs, "doc_id", "text")


def masked_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with personal data replaced by its kind in brackets; ``n_chars`` follows the text."""
    return pii.mask_personal_data(docs, "text", pii.fit(docs, "text"), "n_chars")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed into sequences."""
    return packed_pieces(docs)


STAGES = [
    ("quality classifier", good_quality),
    ("near-duplicates", one_of_each_class),
    ("personal data", masked_personal_data),
    ("packing", packed),
]

#: Trained models, sampling and tokenizing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
