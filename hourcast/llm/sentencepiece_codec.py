"""SentencePiece encoding and decoding with the tokenizers library as the backend.

The model file is a protobuf message.  It is read here field by field, and a tokenizers
pipeline is rebuilt from it: the normaliser (its character map, white space rules and the
meta symbol U+2581 for spaces), the model (unigram with the pieces' scores, or BPE with merges
in the order of the scores of the pieces they make), byte fallback, and the decoder.

No piece of such a model holds U+2581 behind another character, so ids never depend on what
stands before a word.  Where that holds (it is checked), a text is cut in front of each run of
U+2581, each distinct word is encoded once, and words are encoded in batches by the library's
threads.  Parity with the sentencepiece library is verified for every text: its normalised form
against the library's, and the ids of each distinct word against the library's when the word is
first met.  A text with a word that cannot be verified alone, or whose ids or decoding differ, is
encoded by the library as a whole and compared id by id.

Defined results
---------------
* null or empty text: no ids, an empty decoding, parity holds.
* text that the model's normaliser changes does not decode to itself; ``round_trip`` tells.
* repeated rows are encoded each; further columns of the input are passed through; one that bears
  the name of a result column is an error; an empty table gives an empty result.
* very long texts are encoded whole; a task holds one batch of texts and up to ``KNOWN_WORDS`` words.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame

from hourcast.llm.common import append_columns, vocabulary_bytes

META = "▁"
# Field numbers and piece types of the model's message.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
UNIGRAM, BPE = 1, 2
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
KNOWN_WORDS = 400_000
WORD_CHARS = 100


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a protobuf message: a whole number, or the bytes of the field."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = varint()
        kind = key & 7
        if kind == 0:
            yield key >> 3, varint()
            continue
        size = {1: 8, 5: 4}.get(kind) or varint()
        yield key >> 3, data[at:at + size]
        at += size


@dataclass
class Model:
    """What a SentencePiece model file says."""

    pieces: list[tuple[str, float, int]] = field(default_factory=list)
    kind: int = UNIGRAM
    byte_fallback: bool = False
    char_map: bytes = b""
    dummy_prefix: bool = True
    fewer_spaces: bool = True
    escape_spaces: bool = True

    @classmethod
    def parse(cls, data: bytes) -> Model:
        model = cls()
        for number, value in message_fields(data):
            if number == PIECES:
                piece = dict(message_fields(value))
                score = struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0
                model.pieces.append((piece[1].decode(), score, piece.get(3, NORMAL)))
            elif number == TRAINER:
                spec = dict(message_fields(value))
                model.kind, model.byte_fallback = spec.get(3, UNIGRAM), bool(spec.get(35, 0))
                if spec.get(24, 0):
                    raise ValueError("models with white space as suffix are not supported")
            elif number == NORMALIZER:
                spec = dict(message_fields(value))
                model.char_map = spec.get(2, b"")
                model.dummy_prefix, model.fewer_spaces, model.escape_spaces = (bool(spec.get(i, 1)) for i in (3, 4, 5))
        if model.kind not in (UNIGRAM, BPE) or not model.escape_spaces:
            raise ValueError("only unigram and BPE models with escaped spaces are supported")
        return model


def normalizer(model: Model):
    """The model's normaliser, up to and with the meta symbol."""
    from tokenizers import Regex, normalizers

    steps = [normalizers.Precompiled(model.char_map)] if model.char_map else []
    if model.fewer_spaces:
        steps += [normalizers.Replace(Regex("^ +| +$"), ""), normalizers.Replace(Regex(" {2,}"), " ")]
    if model.dummy_prefix:
        steps.append(normalizers.Prepend(META))
    return normalizers.Sequence([*steps, normalizers.Replace(" ", META)])


def _merges(scores: dict[str, float]) -> list[tuple[str, str]]:
    """Every way to make a piece of two pieces, by falling score of the piece made."""
    found = []
    for rank, piece in enumerate(sorted(scores, key=lambda p: -scores[p])):
        for cut in range(1, len(piece)):
            if piece[:cut] in scores and piece[cut:] in scores:
                found.append((rank, piece[:cut], piece[cut:]))
    return [(a, b) for _, a, b in sorted(found, key=lambda m: m[0])]


def build(model: Model):
    """The tokenizers pipeline without its normaliser, which the codec applies first."""
    from tokenizers import AddedToken, Tokenizer, decoders, models

    unknown = next(i for i, p in enumerate(model.pieces) if p[2] == UNKNOWN)
    if model.kind == UNIGRAM:
        # A piece that must not come out of a text can't win with this score.
        low = min((s for _, s, _ in model.pieces), default=0.0) - 1e6
        vocab = [(p, s if kind in (NORMAL, USER_DEFINED) else low) for p, s, kind in model.pieces]
        core = models.Unigram(vocab, unk_id=unknown, byte_fallback=model.byte_fallback)
    else:
        ids = {p: i for i, (p, _, _) in enumerate(model.pieces)}
        scores = {p: s for p, s, kind in model.pieces if kind == NORMAL}
        core = models.BPE(ids, _merges(scores), unk_token=model.pieces[unknown][0], fuse_unk=True,
                          byte_fallback=model.byte_fallback)
    tokenizer = Tokenizer(core)
    tokenizer.add_tokens([AddedToken(p, normalized=False) for p, _, kind in model.pieces if kind == USER_DEFINED])
    tokenizer.decoder = decoders.Sequence([decoders.Replace(META, " "), decoders.ByteFallback(), decoders.Fuse()])
    return tokenizer


class Codec:
    """Encodes and decodes texts; ``threads`` of the library work on a batch."""

    def __init__(self, data: bytes, threads: int = 2, verify: Callable[[list[str]], list[list[int]]] | None = None):
        """``verify`` gives another library's ids of texts, to hold the ids of new words against."""
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.model = Model.parse(data)
        self.tokenizer = build(self.model)
        self.normalise = normalizer(self.model).normalize_str
        inner = any(META in p.lstrip(META) for p, _, kind in self.model.pieces if kind in (NORMAL, USER_DEFINED))
        self.words = (lambda t: [t]) if inner else re.compile(f"{META}*[^{META}]+|{META}+").findall
        self.known: dict[str, bytes] = {}
        # Decodings of the words that do not decode to themselves, and words not verified.
        self.decoded: dict[str, str] = {}
        self.unsure: set[str] = set()
        self.verify = verify
        self.not_plain = {i for i, (_, _, kind) in enumerate(self.model.pieces) if kind not in (NORMAL, USER_DEFINED)}

    def _learn(self, new: list[str]) -> None:
        ids = [e.ids for e in self.tokenizer.encode_batch_fast(new, add_special_tokens=False)]
        self.known.update(zip(new, [array("I", i).tobytes() for i in ids], strict=True))
        # Plain pieces in a row spell their word; only other ones need the decoder.
        other = [(w, i) for w, i in zip(new, ids, strict=True) if not self.not_plain.isdisjoint(i)]
        back = self.tokenizer.decode_batch([i for _, i in other], skip_special_tokens=False)
        self.decoded.update((w, t) for (w, _), t in zip(other, back, strict=True) if t != w.replace(META, " "))
        if self.verify:
            # Alone, a word stands behind the prefix that the normaliser puts in front of a text.
            prefix = self.model.dummy_prefix
            alone = [w[1:] if prefix and w[0] == META and META not in w[1:] else "" for w in new]
            self.unsure.update(w for w, text, a, b in zip(new, alone, ids, self.verify(alone), strict=True) if not text or a != b)

    def coded(self, texts: list[str]) -> Iterator[tuple[str, bytes, str, bool]]:
        """Of each text its normalised form, ids (little-endian unsigned 32-bit), decoding, and whether
        all its words are verified.

        Bytes of a fallback never reach into the next word, which starts with the meta symbol,
        so the words' decodings in a row are the text's.
        """
        known = self.known
        if len(known) > KNOWN_WORDS:
            for held in (known, self.decoded, self.unsure):
                held.clear()
        marked = [self.normalise(t) if t else "" for t in texts]
        cut = [self.words(m) if m else [] for m in marked]
        new = list({w for words in cut for w in words if w not in known})
        self._learn(new)
        for text, words in zip(marked, cut, strict=True):
            ids = b"".join(map(known.__getitem__, words))
            if self.decoded and not self.decoded.keys().isdisjoint(words):
                decoded = "".join([self.decoded[w] if w in self.decoded else w.replace(META, " ") for w in words])
            else:
                decoded = text.replace(META, " ")
            yield text, ids, self._unprefixed(decoded), self.unsure.isdisjoint(words)
        for w in new:
            if len(w) > WORD_CHARS:
                del known[w]
                self.decoded.pop(w, None)
                self.unsure.discard(w)

    def encode_decode(self, texts: list[str]) -> list[tuple[bytes, str]]:
        """Ids of each text and their decoding."""
        return [(ids, decoded) for _, ids, decoded, _ in self.coded(texts)]

    def _unprefixed(self, text: str) -> str:
        return text[1:] if self.model.dummy_prefix and text.startswith(" ") else text

    def encode(self, texts: list[str]) -> list[bytes]:
        return [ids for ids, _ in self.encode_decode(texts)]

    def decode(self, encoded: list[bytes]) -> list[str]:
        """The texts of any ids."""
        ids = [np.frombuffer(e, "<u4").tolist() for e in encoded]
        return list(map(self._unprefixed, self.tokenizer.decode_batch(ids, skip_special_tokens=False)))

    def plain(self, text: str) -> str:
        """The text that an encoding of ``text`` stands for."""
        return self.unmarked(self.normalise(text)) if text else ""

    def unmarked(self, marked: str) -> str:
        """A normalised text without the prefix, with spaces."""
        return (marked[1:] if self.model.dummy_prefix else marked).replace(META, " ")


def encode_texts(docs: DataFrame, model_path: str, threads: int = 2, with_ids: bool = False) -> DataFrame:
    """Every row of ``docs`` with n_tokens, ids_crc32, n_byte_tokens (byte fallback), decoded_crc32,
    round_trip (the decoding is the normalised text) and parity (the ids are sentencepiece's);
    and ``ids`` (unsigned 32-bit) if asked for."""
    data = vocabulary_bytes(model_path)

    def start():
        import sentencepiece

        judge = sentencepiece.SentencePieceProcessor(model_proto=data)
        codec = Codec(data, threads, lambda words: judge.encode(words, num_threads=threads))
        is_byte = np.array([kind == BYTE for _, _, kind in codec.model.pieces])

        def compute(texts):
            for i in range(0, len(texts), 500):
                part = texts[i:i + 500]
                for text, (marked, ids, decoded, sure) in zip(part, codec.coded(part), strict=True):
                    numbers = np.frombuffer(ids, "<u4")
                    same = sure and (not text or judge.normalize(text) == marked) or np.array_equal(numbers, judge.encode(text))
                    row = (len(numbers), zlib.crc32(ids), int(is_byte[numbers].sum()), zlib.crc32(decoded.encode()),
                           decoded == codec.unmarked(marked), same)
                    yield (*row, ids) if with_ids else row
        return compute

    new = {"n_tokens": "long", "ids_crc32": "long", "n_byte_tokens": "long", "decoded_crc32": "long",
           "round_trip": "boolean", "parity": "boolean"}
    return append_columns(docs, new | ({"ids": "binary"} if with_ids else {}), start)


def decode_ids(rows: DataFrame, model_path: str, column: str = "ids", threads: int = 2) -> DataFrame:
    """Every row of ``rows`` with ``decoded``, the text of the ids (unsigned 32-bit) in ``column``."""
    data = vocabulary_bytes(model_path)

    def start():
        codec = Codec(data, threads)
        return lambda encoded: ((text,) for text in codec.decode([ids or b"" for ids in encoded]))

    return append_columns(rows, {"decoded": "string"}, start, column=column)
