"""Token counts with a digest cache.

The cache is a Parquet table of (tokenizer, digest, n_tokens): ``tokenizer`` is the SHA-256 of
the tokenizer's file and names the folder, ``digest`` the SHA-256 of a document's normalised
content.  Documents are joined to it by digest; of the contents that it lacks, each distinct
one is encoded once, and its count is appended.  The texts of equal contents are combined in
the tasks that read them, before the shuffle, so a text that fills a third of the table still
sends one row per task.

Normalising (white space as one space, none at the ends) must not change a count; it holds
for tokenizers that drop white space.  Pass ``normalise=None`` for others.

Defined results
---------------
* null text: counts as empty, 0 bytes and 0 tokens.
* repeated rows each get their row; special strings in a text are handled as the library does
  by default; nothing is truncated or padded.
* further columns of the input are ignored; an empty table gives an empty result.
* two jobs that append the same content leave it twice in the cache; it is read once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import append_columns, id_and_text, vocabulary_bytes
from hourcast.llm.tokens import WHITE_SPACE, WORD_CHUNKS, ChunkEncoder
from hourcast.session import is_directory

CACHE_SCHEMA = "digest binary, n_tokens long"


def one_space(text: Column) -> Column:
    """White space as one space; a lone space is no match, so usual texts are read and not rebuilt."""
    other = f"[{WHITE_SPACE}&&[^ ]][{WHITE_SPACE}]*"
    return F.btrim(F.regexp_replace(text, f"{other}| [{WHITE_SPACE}]+", " "), F.lit(" "))


def read_cache(spark, folder: str) -> DataFrame:
    """The cached counts of one tokenizer, one row per digest."""
    if not is_directory(spark, folder):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def count_tokens(texts: DataFrame, spec: bytes, chunks: str) -> DataFrame:
    """``texts`` (with a column ``text``) and its ``n_tokens``."""
    def start():
        encoder = ChunkEncoder(spec, chunks)

        def compute(batch):
            for i in range(0, len(batch), 500):
                for ids in encoder.encode(batch[i:i + 500]):
                    yield (len(ids) // 4,)
        return compute

    return append_columns(texts, {"n_tokens": "long"}, start)


def token_counts(docs: DataFrame, tokenizer: str, cache: str, limit: int = 2048, chunks: str = WORD_CHUNKS,
                 normalise: Callable[[Column], Column] | None = one_space) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) for every row of ``docs``; appends to ``cache``."""
    spark = docs.sparkSession
    spec = vocabulary_bytes(tokenizer)
    folder = f"{cache}/tokenizer={hashlib.sha256(spec).hexdigest()}"
    text = F.col("text") if normalise is None else normalise(F.col("text"))
    keyed = id_and_text(docs).select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), text.alias("text"))
    keyed = keyed.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    misses = keyed.groupBy("digest").agg(F.first("text").alias("text"))
    if is_directory(spark, folder):
        misses = misses.join(read_cache(spark, folder), "digest", "left_anti")
    count_tokens(misses, spec, chunks).select("digest", "n_tokens").write.mode("append").parquet(folder)
    found = keyed.drop("text").join(read_cache(spark, folder), "digest")
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
