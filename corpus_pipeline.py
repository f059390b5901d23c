"""Corpus pipeline: the stages from raw documents to packed sequences.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir) and returns a
DataFrame.  ``run`` writes each stage's result as Parquet and rereads it as the next one's
input.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import DOCUMENT_COLUMNS, read_table, written
from hourcast.llm.line_dedup import WHITE, line_dedup
from hourcast.llm.ngram_join import one_of_each
from hourcast.llm.packing import pack
from hourcast.llm.quality_classifier import score_quality
from hourcast.llm.quality_rules import quality_rules


def keep_by_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules accept."""
    return quality_rules(docs.select(DOCUMENT_COLUMNS)).where("kept").select(DOCUMENT_COLUMNS)


def keep_by_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, trained on the labels of its own input, accepts."""
    scored = score_quality(docs.select(DOCUMENT_COLUMNS), read_table(spark, sf_dir, "labels"))
    return scored.where("predicted = 1").select(DOCUMENT_COLUMNS)


def _has_text():
    return F.coalesce(F.btrim("text", F.lit(WHITE)) != "", F.lit(False))


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the later repeated runs of lines; n_chars follows the text.

    A document all of whose lines stood before has nothing left and goes; one that had no
    text to begin with stays.
    """
    cut = line_dedup(docs.select(DOCUMENT_COLUMNS).withColumn("had", _has_text()))
    left = cut.where(~F.col("had") | _has_text())
    return left.withColumn("n_chars", F.length("text").cast("long")).select(DOCUMENT_COLUMNS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies."""
    return one_of_each(docs.select(DOCUMENT_COLUMNS))


def pack_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality rules", keep_by_rules),
    ("quality classifier", keep_by_classifier),
    ("line dedup", cut_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("packing", pack_documents),
]

# A stage of this pipeline trains a classifier and another encodes tokens, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
