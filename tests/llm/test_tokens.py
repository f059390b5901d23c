"""Codec parity, packing round trip, token counts through the cache."""

import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from __spark_entry__ import queries
from hourcast.llm import packing as PK
from hourcast.llm import sentencepiece_codec as SP
from hourcast.llm import token_counts as TC
from hourcast.llm.tokens import SPACED_CHUNKS, WORD_CHUNKS, ChunkEncoder
from hourcast.session import scratch_path

SF = "/root/testdata/sf0.001"
BYTE_BPE, WORD_BPE = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ODD = [" ", "  ", "   ", "\n", "\t", "\x85", "\xa0", " ", "　", "\x1c", "᠎", "​", "﻿", "a", "Z", "é",
       "é", "́", "ß", "Σ", "İ", "1", "²", "'s", "'", "?!", "<|endoftext|>", "<|startoftext|>", "<s>", "<0x41>", "▁",
       "中", "각", "\U0001f600", "don't", "\x00", " the", "ing", "x" * 130]


def odd_texts(n, seed):
    rng = random.Random(seed)
    return ["".join(rng.choice(ODD) for _ in range(rng.randint(0, 14))) for _ in range(n)]


@pytest.mark.parametrize("path, chunks", [(BYTE_BPE, SPACED_CHUNKS), (WORD_BPE, WORD_CHUNKS)])
def test_chunks_encode_like_whole_texts(path, chunks):
    texts = odd_texts(6000, 1)
    with open(path, "rb") as f:
        encoder = ChunkEncoder(f.read(), chunks)
    whole = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == [e.ids for e in whole]


# ---------------------------------------------------------------- sentencepiece

def field(number, value):
    """A field of a protobuf message."""
    def varint(n):
        out = b""
        while n > 127:
            out, n = out + bytes([n & 127 | 128]), n >> 7
        return out + bytes([n])
    if isinstance(value, float):
        return varint(number << 3 | 5) + struct.pack("<f", value)
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3) + varint(value)


def unigram_model(prefix=1, fewer=1):
    """A small unigram model with byte fallback, written by hand."""
    pieces = [("<unk>", 0.0, 2), ("<s>", 0.0, 3), ("</s>", 0.0, 3)] + [(f"<0x{i:02X}>", 0.0, 6) for i in range(256)]
    words = ["▁", "a", "b", "c", "ab", "▁a", "▁ab", "abc", "▁the", "t", "h", "e", "he", "é", "▁é", "bc", "ca", "▁c", "cab"]
    pieces += [(w, -1.0 - 0.37 * i - 0.01 * i * i, 1) for i, w in enumerate(words)]
    made = b"".join(field(1, field(1, p.encode()) + field(2, s) + field(3, k)) for p, s, k in pieces)
    return made + field(2, field(3, 1) + field(35, 1)) + field(3, field(1, b"identity") + field(3, prefix) + field(4, fewer) + field(5, 1))


@pytest.mark.parametrize("model", ["bpe", "unigram", "unigram bare"])
def test_codec_has_the_library_s_ids_and_texts(model):
    if model == "bpe":
        with open(MODEL, "rb") as f:
            data = f.read()
    else:
        data = unigram_model(0, 0) if "bare" in model else unigram_model()
    judge = sentencepiece.SentencePieceProcessor(model_proto=data)
    codec = SP.Codec(data)
    rng = random.Random(9)
    texts = odd_texts(3000, 2) if model == "bpe" else [
        "".join(rng.choice([" ", "  ", "a", "b", "c", "ab", "abc", "the", "é", "ü", "中", "x"]) for _ in range(rng.randint(0, 12)))
        for _ in range(3000)]
    ids = [np.frombuffer(x, "<u4").tolist() for x in codec.encode(texts)]
    assert ids == judge.encode(texts)
    assert codec.decode(codec.encode(texts)) == [judge.decode(x) for x in ids]
    assert [t for _, t in codec.encode_decode(texts)] == [codec.plain(t) for t in texts]


def test_codec_query_and_decoding(spark, edge_docs, no_docs):
    got = queries()["op3_sentencepiece"](spark, SF).cache()
    assert got.count() == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert got.where("not parity or not round_trip").count() == 0
    ids = SP.encode_texts(edge_docs, MODEL, with_ids=True)
    back = SP.decode_ids(ids, MODEL).collect()
    assert len(back) == 9 and all(r.decoded == (r.text or "") and r.parity and r.extra == 7 for r in back)
    assert SP.encode_texts(no_docs, MODEL).count() == 0


# ---------------------------------------------------------------- packing

@pytest.mark.parametrize("n", [*range(1, 140), 255, 256, 511, 1000, 1023, 1024, 1025, 5000, 20481])
def test_cut_covers_a_document(n):
    found = list(PK.cut(n, PK.Packing()))
    at = 0
    for start, length in found:
        assert start == at and 0 < length <= 1024
        at += length
    assert at == n


def check_packing(rows, documents, capacity=1024):
    """Pieces cover every document once, sequences are gapless and within the capacity."""
    tokenizer = Tokenizer.from_file(BYTE_BPE)
    want = sorted((str(i), bytes(np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [0], "<u4"))) for i, t in documents)
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault((str(r.doc_id), r.doc_tokens), []).append(r)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    total = {}
    for i, ids in want:
        total.setdefault((i, len(ids) // 4), []).append(ids)
    assert set(total) == set(pieces)
    for key, texts in total.items():
        found = sorted((r.start, r.length, r.ids_crc32) for r in pieces[key])
        should = sorted((s, n, zlib.crc32(ids[4 * s:4 * (s + n)])) for ids in texts for s, n in PK.cut(len(ids) // 4, PK.Packing()))
        assert found == should
    padding = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding / sum(len(ids) // 4 for _, ids in want)


def test_packing_round_trip(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = queries()["op7_packing"](spark, SF).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])


def test_packing_padding_falls_with_the_size(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    many = docs.select("doc_id", "text", F.explode(F.sequence(F.lit(0), F.lit(4))).alias("copy"))
    rows = PK.pack(many, BYTE_BPE).collect()
    assert check_packing(rows, [(r.doc_id, r.text) for r in many.collect()]) < 0.01


def test_packing_does_not_depend_on_shards(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    monkeypatch.setattr(PK, "SHARD_PIECES", 50)
    rows = PK.pack(docs, BYTE_BPE).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in docs.collect()])
    per_class = {}
    for r in rows:
        per_class.setdefault(1024 // r.length, {}).setdefault(r.sequence_id, []).append(r)
    for k, found in per_class.items():
        assert sum(len(parts) != k for parts in found.values()) <= 1


def test_packing_edges(spark, edge_docs, no_docs):
    rows = PK.pack(edge_docs, BYTE_BPE, with_ids=True).collect()
    check_packing(rows, [(r.doc_id, r.text) for r in edge_docs.collect()])
    assert all(zlib.crc32(r.ids) == r.ids_crc32 for r in rows)
    assert PK.pack(no_docs, BYTE_BPE).count() == 0


# ---------------------------------------------------------------- token counts

def test_counts_equal_the_library(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    tokenizer = Tokenizer.from_file(WORD_BPE)
    got = queries()["op8_token_counts"](spark, SF).collect()
    assert len(got) == len(docs)
    for r in got:
        n = len(tokenizer.encode(docs[r.doc_id], add_special_tokens=False).ids)
        assert (r.n_bytes, r.n_tokens, r.over_limit) == (len(docs[r.doc_id].encode()), n, n > 2048)


def test_cache_holds_each_content_once(spark, edge_docs, no_docs):
    cache = scratch_path(spark, "t-cache")
    first = {(r.doc_id, r.n_bytes): r.n_tokens for r in TC.token_counts(edge_docs, WORD_BPE, cache).collect()}
    rows = spark.read.parquet(cache)
    assert rows.count() == 6            # empty, blank and null are one content
    more = edge_docs.unionByName(edge_docs.withColumn("text", F.lit("one  two\nthree four five six seven ")))
    again = TC.token_counts(more, WORD_BPE, cache)
    assert again.count() == 18 and spark.read.parquet(cache).count() == 6
    assert {r.n_tokens for r in again.where("n_bytes = 35").collect()} == {first[1, 33]}
    TC.token_counts(spark.createDataFrame([(1, "new words")], "doc_id long, text string"), WORD_BPE, cache).count()
    assert spark.read.parquet(cache).count() == 7
    # Two jobs that appended the same content count it once.
    rows.select("digest", "n_tokens").write.mode("append").parquet(f"{cache}/{rows.inputFiles()[0].split('/')[-2]}")
    assert TC.token_counts(edge_docs, WORD_BPE, cache).count() == 9
    assert TC.token_counts(no_docs, WORD_BPE, scratch_path(spark, "t-cache")).count() == 0


def test_odd_texts_count_like_the_library(spark):
    texts = odd_texts(800, 4)
    tokenizer = Tokenizer.from_file(WORD_BPE)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.n_tokens for r in TC.token_counts(df, WORD_BPE, scratch_path(spark, "t-cache")).collect()}
    assert got == {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}


def test_worker_keeps_its_encoder_and_its_frequent_chunks(monkeypatch):
    """Tasks of one worker share an encoder; chunks in use stay known, and all ids are the library's."""
    from hourcast.llm import tokens

    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, "rb") as f:
        spec = f.read()
    encoder = tokens.worker_encoder(spec, SPACED_CHUNKS)
    assert tokens.worker_encoder(bytes(bytearray(spec)), SPACED_CHUNKS) is encoder
    monkeypatch.setattr(tokens, "KEPT_CHUNKS", 50)
    encoder, asked = tokens.ChunkEncoder(spec, SPACED_CHUNKS), []
    once = encoder.known.encode_chunk
    monkeypatch.setattr(encoder.known, "encode_chunk", lambda c: (asked.append(c), once(c))[1])
    texts = [f" the Éai ñ œuvre\xa0ß\xad ªº µ İx word{i} {'x' * i}é \t\n été{chr(0xc0 + i % 64)}, l'été" for i in range(300)]
    library = Tokenizer.from_file(path)
    assert encoder.encode(texts) == [tokens.pack(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert asked.count(" the") == 1
    assert len(encoder.known) <= 50 and len(encoder.known.older) <= 50
    assert max(map(len, encoder.known)) <= tokens.CHUNK_CHARS


def test_a_worker_makes_few_texts_python_objects_at_a_time(spark):
    """A batch is handed over in slices of bounded size, a longer row alone, and no row is lost."""
    from hourcast.llm import common

    step = common.SLICE_BYTES // 8
    df = spark.range(200).selectExpr("id", f"repeat('x', int(if(id = 7, {2 * common.SLICE_BYTES}, {step}))) text").coalesce(1)
    out = common.append_columns(df, {"together": "long"}, lambda: lambda texts: [(sum(map(len, texts)),)] * len(texts))
    got = {r.id: r.together for r in out.select("id", "together").collect()}
    assert sorted(got) == list(range(200))
    assert max(n for i, n in got.items() if i > 100) <= 2 * common.SLICE_BYTES
    batch = pa.RecordBatch.from_pydict({"text": ["y" * 1000] * 20_000})
    parts = list(common.slices([batch, batch.slice(0, 0)]))
    assert sum(p.num_rows for p in parts) == 20_000 and len(parts) > 3
    assert max(p.nbytes for p in parts) <= common.SLICE_BYTES
