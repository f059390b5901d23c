"""Quality rules: word and line counts, and repetition found with a suffix array.

Words are maximal runs of characters other than space and U+0009 to U+000D.  The
repetition rule builds the suffix array of each document's word sequence by prefix
doubling, reads the longest common prefix (LCP) of neighbouring suffixes, takes the
LCP intervals of at least ``min_match`` words (the maximal repeated substrings), unions
the spans of all their occurrences and limits the covered fraction of the text and the
longest repeat.  Suffixes that share fewer than ``min_match`` words with any other lie in
no such interval, so the array is only refined for the others.

Defined results
---------------
* null or empty text, or text without a word: all counts 0, ``base_failed`` true.
* repeated rows: each row is judged by itself; rows are never merged.
* further columns of the input are passed through; one that bears the name of a result column
  is an error (select it away first); an empty table gives an empty result.
* memory in a task is in proportion to one block of documents (``BLOCK_WORDS``) or to one
  longer document, times the logarithm of its longest repeat.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import count

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import append_columns, by_size

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
BLOCK_WORDS = 200_000


@dataclass(frozen=True)
class Limits:
    """Thresholds of the rules; counts are in words, fractions in percent of the words."""

    min_words: int = 50
    max_window_pct: int = 50
    min_match: int = 16
    max_covered_pct: int = 30
    max_repeat: int = 200


COLUMNS = dict.fromkeys(["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "covered_words", "longest_repeat"], "long")


def text_counts(text: str) -> tuple[int, int, int]:
    """(characters in words, symbols, lines with a word that equal an earlier line)."""
    word_chars = len(text) - sum(text.count(c) for c in WHITE)
    symbols = sum(text.count(c) for c in SYMBOLS)
    lines = [x for x in text.split("\n") if x.strip(WHITE)]
    return word_chars, symbols, len(lines) - len(set(lines))


def word_codes(documents: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray]:
    """One code sequence for all documents, and where each starts.

    Words of different documents never share a code, and each document ends in a code of
    its own, so no repeat crosses a boundary.
    """
    fresh = count().__next__
    parts, starts, at = [], [], 0
    for words in documents:
        table: defaultdict[bytes, int] = defaultdict(fresh)
        codes = np.empty(len(words) + 1, np.int64)
        codes[:-1] = np.fromiter(map(table.__getitem__, words), np.int64, len(words))
        codes[-1] = fresh()
        parts.append(codes)
        starts.append(at)
        at += len(codes)
    return np.concatenate(parts), np.array(starts, np.int64)


def suffix_classes(codes: np.ndarray) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Prefix doubling.  ``ranks[k]`` orders suffixes by their first 2**k codes (equal prefix,
    equal rank); ``alive[k]`` are the suffixes that share that prefix with another one."""
    sizes = np.bincount(codes)
    rank = (np.cumsum(sizes) - sizes)[codes]
    alive = np.flatnonzero(sizes[codes] > 1)
    ranks, lives, step, n = [rank], [alive], 1, len(codes)
    while alive.size:
        key = rank[alive] * (n + 1) + rank[alive + step]
        order = np.argsort(key)
        key, where = key[order], alive[order]
        old, index = rank[where], np.arange(len(where))
        starts = np.concatenate(([True], key[1:] != key[:-1]))
        old_starts = np.concatenate(([True], old[1:] != old[:-1]))
        start = np.maximum.accumulate(np.where(starts, index, 0))
        old_start = np.maximum.accumulate(np.where(old_starts, index, 0))
        rank = rank.copy()
        rank[where] = old + start - old_start
        alone = starts & np.concatenate((starts[1:], [True]))
        alive = where[~alone]
        step *= 2
        ranks.append(rank)
        lives.append(alive)
    return ranks, lives


def repeat_spans(ranks: list[np.ndarray], lives: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, length): each suffix that shares at least ``least`` codes with another one, and
    the longest such prefix, from the LCP of its neighbours in suffix order."""
    level = min(least.bit_length() - 1, len(lives) - 1)
    where = lives[level]
    if not where.size:
        return where, where
    where = where[np.argsort(ranks[-1][where])]
    a, b = where[:-1], where[1:]
    lcp = np.zeros(len(a), np.int64)
    for k in range(len(ranks) - 1, -1, -1):
        lcp += np.where(ranks[k][a + lcp] == ranks[k][b + lcp], 1 << k, 0)
    longest = np.maximum(np.concatenate(([0], lcp)), np.concatenate((lcp, [0])))
    keep = longest >= least
    return where[keep], longest[keep]


def covered_mask(n: int, starts: np.ndarray, lengths: np.ndarray | int) -> np.ndarray:
    """True at the positions that lie in one of the spans."""
    ends = np.bincount(starts + lengths, minlength=n + 1)
    return np.cumsum(np.bincount(starts, minlength=n + 1) - ends)[:n] > 0


def repetition(documents: list[list[bytes]], min_match: int) -> list[tuple[int, int, int]]:
    """Per document: words in repeated 3-word windows, words in repeats of at least
    ``min_match`` words, longest repeat of that kind (0 if none)."""
    codes, starts = word_codes(documents)
    n = len(codes)
    ranks, lives = suffix_classes(codes)
    pairs = lives[1] if len(lives) > 1 else lives[0]
    triples = pairs[:0]
    if pairs.size:
        key = ranks[1][pairs] * (n + 1) + codes[pairs + 2]
        _, inverse, sizes = np.unique(key, return_inverse=True, return_counts=True)
        triples = pairs[sizes[inverse] > 1]
    windows = covered_mask(n, triples, 3)
    at, length = repeat_spans(ranks, lives, min_match)
    spans = covered_mask(n, at, length)
    best = np.zeros(n, np.int64)
    best[at] = length
    return list(zip(np.add.reduceat(windows, starts, dtype=np.int64).tolist(),
                    np.add.reduceat(spans, starts, dtype=np.int64).tolist(),
                    np.maximum.reduceat(best, starts).tolist(), strict=True))


def measure(texts: list[str], min_match: int) -> Iterator[tuple[int, ...]]:
    """The measured columns of each text, in order."""
    rows = ((text, text.encode().split()) for text in texts)
    for block in by_size(rows, lambda row: len(row[1]), BLOCK_WORDS):
        found = repetition([words for _, words in block], min_match)
        for (text, words), (windows, covered, longest) in zip(block, found, strict=True):
            yield (len(words), *text_counts(text), windows, covered, longest)


def quality_rules(docs: DataFrame, limits: Limits = Limits()) -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed`` and ``kept``."""
    min_match = limits.min_match
    out = append_columns(docs, COLUMNS, lambda: lambda texts: measure(texts, min_match))
    n = F.col("n_words")
    base = (n < limits.min_words) | (F.col("n_repeat_words") * 100 > n * limits.max_window_pct)
    repeated = ((F.col("covered_words") * 100 > n * limits.max_covered_pct)
                | (F.col("longest_repeat") > limits.max_repeat))
    return out.withColumn("base_failed", base).withColumn("kept", ~base & ~repeated)
