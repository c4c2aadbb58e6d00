"""A training-data pipeline over ``documents``: each stage reads what the one before has written.

Every stage works on all rows it gets, and all but the last return the columns of its input, whatever
they are. Rows with a null doc_id pass the deduplicating stages. An empty table runs through as one.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice._util import quote, temp_name
from sluice.llm._tables import stored, table
from sluice.llm.line_dedup import line_dedup
from sluice.llm.mixing import mix_sources, word_count
from sluice.llm.near_dup import near_duplicates
from sluice.llm.toxicity import drop_toxic, train
from sluice.llm.unigram import sampled_ids

MODEL = "piece_bpe_32k.model"
#: Sampling and an iterative label model can't be put in SQL; tests/llm/test_pipeline.py compares every
#: stage's rows with a brute-force version.
ORACLE_SQL = None


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches 0.5 go."""
    return drop_toxic(docs, train(docs, table(spark, sf_dir, "labels")))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated multi-line chunks go from the texts; n_chars follows the text."""
    out = line_dedup(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (similarity of 0.8 or more) stays, the one with the smallest doc_id."""
    key = temp_name(docs, "gone")
    gone = near_duplicates(docs, percent=80).where("NOT kept").select(F.col("doc_id").alias(key)).distinct()
    return docs.join(gone, F.col("doc_id") == F.col(key), "left_anti")


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    size, total, target, copies, copy = (temp_name(docs, x) for x in ("size", "total", "target", "copies", "copy"))
    mixed = mix_sources(docs.withColumn(size, word_count(F.col("text"))), size, out=(total, target, copies))
    mixed = mixed.where(F.col(copies) > 0).withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(copies))))
    return mixed.select(*[F.col(quote(c)) for c in docs.columns])


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids and n_pieces of one sampled segmentation of each document, and its digest after decoding."""
    rows = sampled_ids(docs, public_tokenizers.path(MODEL), with_text=True)
    return rows.select("doc_id", "ids", F.size("ids").cast("long").alias("n_pieces"), F.sha2("text", 256).alias("text_sha256"))


STAGES = [("toxicity", toxicity), ("line_dedup", lines), ("near_dup", near_dup), ("mixing", mixing), ("sentencepiece", sentencepiece)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
