"""Harmonic packing of documents into sequences of ``capacity`` tokens.

A document's ids and the end id are cut into pieces: first whole sequences, then from the rest
halves, quarters and so on of the capacity down to ``least_cut``, then what remains.  A piece
belongs to class k if k pieces of its length fill a sequence but k + 1 don't; every sequence
of a class takes k of its pieces.  So a piece's place depends on its rank in its class alone:
ranks are counted in shards of bounded size, which workers handle independently, and the
shards' sizes give each shard its first rank.  Only the last sequence of a class can hold
fewer than k pieces, and cutting at powers of two leaves padding to the remainders alone.

Defined results
---------------
* null or empty text: one piece with the end id.
* repeated rows are packed each; rows are told apart by an id given where they are encoded,
  which is fixed once the pieces are written.  A null doc_id is allowed.
* further columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.common import id_and_text, slices, vocabulary_bytes, written
from hourcast.llm.tokens import SPACED_CHUNKS, worker_encoder

END = b"\0\0\0\0"
# Pieces that one worker ranks together.
SHARD_PIECES = 200_000
PIECE_SCHEMA = "doc_id long, row long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"


@dataclass(frozen=True)
class Packing:
    capacity: int = 1024
    least_cut: int = 128


def cut(n: int, cfg: Packing) -> Iterator[tuple[int, int]]:
    """(start, length) of the pieces of a document of ``n`` ids."""
    at, size = 0, cfg.capacity
    while n - at >= cfg.least_cut and size >= cfg.least_cut:
        if n - at >= size:
            yield at, size
            at += size
        else:
            size //= 2
    if at < n:
        yield at, n - at


def pieces(docs: DataFrame, tokenizer: str, cfg: Packing = Packing(), chunks: str = SPACED_CHUNKS,
           with_ids: bool = False) -> DataFrame:
    """The pieces of every row of ``docs``; ``ids`` holds their ids (unsigned 32-bit) if asked for."""
    spec = vocabulary_bytes(tokenizer)

    def run(batches):
        encoder = worker_encoder(spec, chunks)
        row = TaskContext.get().partitionId() << 40
        for batch in slices(batches):
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            for i in range(0, len(ids), 500):
                found = []
                for doc_id, encoded in zip(ids[i:i + 500], encoder.encode(texts[i:i + 500]), strict=True):
                    encoded += END
                    n = len(encoded) // 4
                    for start, length in cut(n, cfg):
                        part = encoded[4 * start:4 * (start + length)]
                        found.append((doc_id, row, start, length, zlib.crc32(part), n, part if with_ids else None))
                    row += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found, strict=True), [pa.int64()] * 6 + [pa.binary()], strict=True)],
                    names=["doc_id", "row", "start", "length", "ids_crc32", "doc_tokens", "ids"])

    return id_and_text(docs).mapInArrow(run, PIECE_SCHEMA)


def assign(made: DataFrame, n_pieces: int, cfg: Packing = Packing()) -> DataFrame:
    """``made`` (written pieces) with sequence_id and offset."""
    shards = max(1, -(-n_pieces // SHARD_PIECES))
    dealt = (made.withColumn("class", F.floor(F.lit(cfg.capacity) / F.col("length")))
             .withColumn("shard", F.pmod(F.xxhash64("row", "start"), F.lit(shards))))
    sizes = dealt.groupBy("class", "shard").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("class", "shard", (F.sum("n").over(Window.partitionBy("class").orderBy("shard")) - F.col("n")).alias("before"))
    # One row per class, so at most ``capacity`` rows reach this window.
    bins = sizes.groupBy("class").agg(F.ceil(F.sum("n") / F.col("class")).alias("bins"))
    bins = bins.select("class", (F.sum("bins").over(Window.orderBy("class")) - F.col("bins")).alias("base"))
    in_shard = F.row_number().over(Window.partitionBy("class", "shard").orderBy("doc_id", "row", "start")) - 1
    ranked = (dealt.withColumn("__in_shard", in_shard).join(before, ["class", "shard"]).join(bins, "class")
              .withColumn("__rank", F.col("before") + F.col("__in_shard"))
              .withColumn("sequence_id", (F.col("base") + F.floor(F.col("__rank") / F.col("class"))).cast("long")))
    sofar = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("__rank").rowsBetween(Window.unboundedPreceding, -1))
    return ranked.withColumn("offset", F.coalesce(sofar, F.lit(0)).cast("long"))


def pack(docs: DataFrame, tokenizer: str, cfg: Packing = Packing(), with_ids: bool = False) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) per piece, and ``ids`` if asked for."""
    made = written(pieces(docs, tokenizer, cfg, with_ids=with_ids), "pieces")
    out = assign(made, made.count(), cfg)
    return out.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
                      *(["ids"] if with_ids else []))
