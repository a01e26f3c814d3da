"""The pipeline's stages: each takes (spark, docs, sf_dir) and applies one operator to all of docs."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridseries.llm import language_id, ngram_join, packing, quality
from gridseries.llm.common import table

CAPACITY = 1024
#: A text whose letters are not mostly in one language's spans is rejected.
LANGUAGE_SHARE = 0.5


def _judged(docs: DataFrame, verdict: Column, keep: str) -> DataFrame:
    """Rows of docs whose verdict, under a name that no column has, satisfies ``keep``; the text is judged where it lies."""
    name = f"verdict_{uuid.uuid4().hex}"
    return docs.withColumn(name, verdict).where(keep.format(v=name)).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts without letters (null and empty ones too) and texts that no language covers half of."""
    model = language_id.train_on_rest(docs, "doc_id", "text", "lang")
    return _judged(docs, language_id.predictor(model)(F.col("text")), f"{{v}}.lang_pred <> 'und' AND {{v}}.score >= {LANGUAGE_SHARE}")


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject texts whose quality score is below the threshold of label 1; without labels nothing is rejected."""
    model = quality.train(docs, "doc_id", "text", table(spark, sf_dir, "labels"), "doc_id", "quality")
    return _judged(docs, quality.scorer(model)(F.col("text")), f"{{v}} >= {quality.THRESHOLD}")


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each group of near copies.

    Rows without a doc_id stay. Rows that share a doc_id are decided together,
    and those that repeat its text too become one.
    """
    kept = ngram_join.ngram_links(docs, "doc_id", "text").where("kept AND doc_id IS NOT NULL").select("doc_id").distinct()
    stay = docs.join(kept, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
    return stay.union(docs.where("doc_id IS NULL")).select(*[F.col(f"`{c}`") for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents with their place in sequences of at most 1024 tokens."""
    return packing.pack_documents(docs, "doc_id", "text", public_tokenizers.path("byte_bpe_50k.json"), CAPACITY)
