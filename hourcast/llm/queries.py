"""One registered query per operator, each over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourcast.llm.common import id_and_text, read_table
from hourcast.llm.hard_negatives import mine
from hourcast.llm.html_extract import extract_pages
from hourcast.llm.knn import top_k
from hourcast.llm.license_scan import scan_licenses
from hourcast.llm.line_dedup import dropped_lines
from hourcast.llm.ngram_join import near_duplicates
from hourcast.llm.packing import pack
from hourcast.llm.personal_data import KINDS, find_personal_data
from hourcast.llm.quality_classifier import score_quality
from hourcast.llm.quality_rules import quality_rules
from hourcast.llm.sentencepiece_codec import encode_texts
from hourcast.llm.sql import SQL  # noqa: F401
from hourcast.llm.token_counts import token_counts
from hourcast.llm.whitening import whiten
from hourcast.session import scratch_path


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: its lines, and those that later repeated runs make up."""
    found = dropped_lines(id_and_text(read_table(spark, sf_dir, "documents")))
    return found.withColumn("dropped", F.concat_ws(",", F.transform("dropped", lambda p: p.cast("string"))))


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document, learned from the labels of the rows not held out."""
    docs = id_and_text(read_table(spark, sf_dir, "documents"))
    return score_quality(docs, read_table(spark, sf_dir, "labels")).drop("text")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded, with parity against the sentencepiece library."""
    docs = id_and_text(read_table(spark, sf_dir, "documents"))
    return encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("text")


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    found = near_duplicates(id_and_text(read_table(spark, sf_dir, "documents")))
    return found.select("doc_id", F.col("n_shingles").cast("long").alias("n_shingles"), "component_id")


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of the quality rules for every document."""
    return quality_rules(id_and_text(read_table(spark, sf_dir, "documents"))).drop("text")


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract_pages(read_table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("html")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence of 1024 tokens."""
    return pack(id_and_text(read_table(spark, sf_dir, "documents")), public_tokenizers.path("byte_bpe_50k.json"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document, through a digest cache that starts empty."""
    return token_counts(read_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"),
                        cache=scratch_path(spark, "token-cache"))


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five best matches of every 50th vector among all other vectors."""
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence notices in every document, with coverage and spans."""
    return scan_licenses(id_and_text(read_table(spark, sf_dir, "documents"))).drop("text")


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector, one label step on for every 7th one."""
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read_table(spark, sf_dir, "embeddings").withColumn("label", label), F.col("vec_id") % 50 == 0)


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first eight whitened components; ``deviation`` is null beyond a long."""
    found = whiten(read_table(spark, sf_dir, "embeddings"))
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans, and all spans, of every document."""
    docs = find_personal_data(id_and_text(read_table(spark, sf_dir, "documents")))

    def text(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))))
    base = F.filter("personal_data", lambda s: ~s["disguised"])
    kinds = F.transform(base, lambda s: s["kind"])
    counts = [(F.size(kinds) - F.size(F.array_remove(kinds, kind))).cast("long").alias(f"n_{kind}") for kind in KINDS]
    return docs.select("doc_id", *counts, F.sha2(text(base), 256).alias("base_sha256"), text("personal_data").alias("spans"))


REGISTRY = {
    "op1_line_dedup": op1_line_dedup,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_sentencepiece": op3_sentencepiece,
    "op4_ngram_join": op4_ngram_join,
    "op5_quality_rules": op5_quality_rules,
    "op6_html_extraction": op6_html_extraction,
    "op7_packing": op7_packing,
    "op8_token_counts": op8_token_counts,
    "op9_exact_top_k": op9_exact_top_k,
    "op10_license_scan": op10_license_scan,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_personal_data": op13_personal_data,
}
