"""Encoding with the tokenizers library, each distinct chunk of text once.

A chunk is a stretch of text that the tokenizer encodes alike alone and in its document, so
a document's ids are the ids of its chunks in a row.  Texts that hold one of the tokenizer's
special strings, and chunks longer than CHUNK_CHARS, go to the library as they are.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable
from functools import lru_cache

# The characters with the Unicode property White_Space, as a class body.
WHITE_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"

# A run of Latin letters, or of ASCII marks without the apostrophe, ends a word of the usual patterns
# if an ASCII character (for marks: no apostrophe or control character) or nothing follows.
LATIN_RUN = "[A-Za-z\\xc0-\\xd6\\xd8-\\xf6\\xf8-\\xff]++(?![^\\x00-\\x7f])"
MARKS_RUN = "[!-&(-/:-@\\[-`{-~]++(?!['\\x00-\\x08\\x0e-\\x1f\\x7f-\\U0010ffff])"

# Byte-level tokenizers with the usual word pattern: a word takes the one space before it.
SPACED_CHUNKS = f" ?(?:{LATIN_RUN}|{MARKS_RUN}|[^{WHITE_SPACE}]+)|[{WHITE_SPACE}]+(?![^{WHITE_SPACE}])|[{WHITE_SPACE}]+"
# Tokenizers that drop white space and join nothing across it.
WORD_CHUNKS = f"{LATIN_RUN}|{MARKS_RUN}|[^{WHITE_SPACE}]+"

CHUNK_CHARS = 100
# Two generations of so many take about 125 MB; a worker holds them beside the executor's heap.
KEPT_CHUNKS = 300_000


def pack(ids: list[int]) -> bytes:
    """Ids as little-endian unsigned 32-bit bytes."""
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_marks() -> dict[int, str]:
    """The characters that byte-level tokenizers write for the bytes, as a translation of latin-1 text."""
    shown = {*range(0x21, 0x7f), *range(0xa1, 0xad), *range(0xae, 0x100)}
    return {b: chr(0x100 + n) for n, b in enumerate(b for b in range(0x100) if b not in shown)}


class _Known(dict):
    """Encoded chunks; one that is asked for and not here is encoded.  When KEPT_CHUNKS are held they
    become the older ones, and those of the older ones that are not asked for meanwhile go."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode_chunk, self.older = encode, {}

    def __missing__(self, chunk: str) -> bytes:
        found = self.older.get(chunk)
        if found is None:
            found = self.encode_chunk(chunk)
        if len(chunk) <= CHUNK_CHARS:
            if len(self) >= KEPT_CHUNKS:
                self.older = dict(self)
                self.clear()
            self[chunk] = found
        return found


class ChunkEncoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    ``spec`` is the content of a tokenizers file, ``chunks`` the pattern that cuts a text into
    chunks.  At most two times KEPT_CHUNKS encoded chunks are remembered.
    """

    def __init__(self, spec: bytes, chunks: str):
        # A task has one core; the library's threads would only compete with other tasks.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec.decode())
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.tokenize = self.tokenizer.model.tokenize
        parsed = json.loads(spec)
        self.special = [t["content"] for t in parsed["added_tokens"]]
        self.split = re.compile(chunks).findall
        self.lower = '"Lowercase"' in json.dumps(parsed["normalizer"])
        # Latin letters beyond ASCII stand for their bytes where nothing is normalised before.
        self.by_bytes = parsed["normalizer"] is None and (parsed["pre_tokenizer"] or {}).get("type") == "ByteLevel"
        self.marks = byte_marks()
        self.known = _Known(self._encode_chunk)

    def _encode(self, text: str) -> bytes:
        return pack(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids)

    def _encode_chunk(self, chunk: str) -> bytes:
        """A chunk of Latin letters is a single word to the pattern, and its bytes stand for themselves
        or for their marks (the space before it as U+0120), so the model alone is asked."""
        word = chunk[1:] if chunk[0] == " " else chunk
        if word.isalpha():
            marked = word
            if not word.isascii():
                if not self.by_bytes or max(word) > "\xff":
                    return self._encode(chunk)
                marked = word.encode().decode("latin-1").translate(self.marks)
            elif self.lower:
                marked = word.lower()
            return pack([t.id for t in self.tokenize(marked if word is chunk else "\u0120" + marked)])
        return self._encode(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        find, special, split = self.known.__getitem__, self.special, self.split
        return [self._encode(t) if any(s in t for s in special) else b"".join(map(find, split(t))) for t in texts]


@lru_cache(maxsize=1)
def worker_encoder(spec: bytes, chunks: str) -> ChunkEncoder:
    """The encoder of a Python worker: its later tasks find it loaded, with the chunks it knows."""
    return ChunkEncoder(spec, chunks)
