"""Licence scans: winnowed fingerprints pick candidates, banded alignment confirms them.

Texts are compared as words ([a-z0-9]+ of the lower-cased text).  Every window of ``window``
consecutive ``gram``-word hashes of a notice gives its minimum to an inverted index of
(hash, notice, position); of a notice shorter than a window and the band, every gram is in it.  A document's grams are looked up in it; hits of one notice on near
diagonals form a candidate, which is aligned with the notice inside a band around them
(local alignment: a match 2, a mismatch or a gap -1), and again left and right of a place found.  A candidate with at least ``least_pct``
percent of the notice's words matched is reported with its coverage and its span of
characters.  Of reports that overlap, the one with more matched words stays, then the one
with the higher coverage.

A document that holds ``window + gram - 1`` words of a notice in a row that cover a fingerprint
is a candidate; no candidate is dropped.  The index has the size of the notices.

Defined results
---------------
* null, empty or word-free text: no match.
* repeated rows are scanned each; further columns of the input are passed through; an empty
  table gives an empty result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import xxhash
from pyspark.sql import DataFrame

from hourcast.llm.common import append_columns
from hourcast.llm.license_texts import NOTICES

WORD = re.compile(r"[a-z0-9]+")
FACTOR = np.uint64(0x9E3779B97F4A7C15)
KNOWN_WORDS = 500_000


@dataclass(frozen=True)
class Scan:
    gram: int = 3
    window: int = 3
    band: int = 8
    least_pct: int = 80


@dataclass(frozen=True)
class Match:
    notice: str
    matched: int
    words: int
    start: int
    end: int

    @property
    def coverage(self) -> float:
        return self.matched / self.words


def align(notice: list, words: list, low: int, high: int) -> tuple[int, int, int]:
    """(matches, first, behind the last) of the best local alignment of ``notice`` in ``words``, with
    word i of the notice at words low + i to high + i."""
    width = high - low + 1
    none = (0, 0, -1, -1)  # score, matches, first and last matched word
    above, best = [none] * (width + 1), none
    for i, word in enumerate(notice):
        row, left = [], none
        for d in range(width):
            at = low + i + d
            score, found, first, last = above[d]
            if 0 <= at < len(words) and words[at] == word:
                cell = (score + 2, found + 1, at if first < 0 else first, at)
            else:
                skip = max(above[d + 1], left)
                cell = max(above[d], skip)
                cell = (cell[0] - 1, *cell[1:]) if cell[0] > 1 else none
            row.append(cell)
            left = cell
            if cell > best:
                best = cell
        above = [*row, none]
    return best[1], best[2], best[3] + 1


class Scanner:
    """The index of the notices, and the search for them in texts."""

    def __init__(self, notices: dict[str, str], cfg: Scan):
        self.cfg, self.known = cfg, {}
        self.names, self.notices = list(notices), [WORD.findall(t.lower()) for t in notices.values()]
        index = defaultdict(list)
        for n, words in enumerate(self.notices):
            grams = self.grams(words)
            window = cfg.window if len(words) >= cfg.window + cfg.gram - 1 + cfg.band else 1
            for a in range(max(1, len(grams) - window + 1)):
                part = grams[a:a + window]
                if len(part):
                    at = a + int(np.argmin(part))
                    index[int(grams[at])].append((n, at))
        self.index = {h: sorted(set(places)) for h, places in index.items()}
        self.hashes = np.array(sorted(self.index), np.uint64)

    def _hash(self, word: str) -> int:
        found = self.known.get(word)
        if found is None:
            found = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def grams(self, words: list[str]) -> np.ndarray:
        k = self.cfg.gram
        if len(words) < k:
            return np.zeros(0, np.uint64)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        codes = np.fromiter(map(self._hash, words), np.uint64, len(words))
        n = len(codes) - k + 1
        mixed = codes[:n].copy()
        for i in range(1, k):
            mixed = mixed * FACTOR ^ codes[i:i + n]
        return mixed * FACTOR

    def candidates(self, grams: np.ndarray) -> list[tuple[int, int, int]]:
        """(notice, lowest and highest difference of positions) of hits that may be one place."""
        at = np.searchsorted(self.hashes, grams)
        at[at == len(self.hashes)] = 0
        hits = defaultdict(list)
        for i in np.flatnonzero(self.hashes[at] == grams).tolist():
            for n, j in self.index[int(grams[i])]:
                hits[n].append(i - j)
        found = []
        for n, shifts in hits.items():
            shifts = sorted(set(shifts))
            low = high = shifts[0]
            for shift in shifts[1:]:
                if shift - low > 2 * self.cfg.band:
                    found.append((n, low, high))
                    low = shift
                high = shift
            found.append((n, low, high))
        return found

    def places(self, n: int, words: list[str], low: int, high: int, start: int, stop: int) -> Iterator[tuple[int, int, int]]:
        """(matches, first, behind the last) of notice ``n`` in the band at words start to stop, each place it has there."""
        todo, need = [(start, stop)], self.cfg.least_pct * len(self.notices[n])
        while todo:
            start, stop = todo.pop()
            if (stop - start) * 100 < need:
                continue        # too few words are left
            matched, first, behind = align(self.notices[n], words[start:stop], low - start, high - start)
            if matched * 100 >= need:
                yield matched, start + first, start + behind
                todo += [(start, start + first), (start + behind, stop)]

    def scan(self, text: str) -> list[Match]:
        lower = text.lower()
        words = WORD.findall(lower)
        found = []
        for n, low, high in self.candidates(self.grams(words)):
            low, high = low - self.cfg.band, high + self.cfg.band
            size = len(self.notices[n])
            for matched, first, behind in self.places(n, words, low, high, max(0, low), min(len(words), high + size)):
                found.append((matched, matched / size, -first, behind, n))
        chosen = []
        for matched, _, first, behind, n in sorted(found, reverse=True):
            if all(behind <= a or -first >= b for _, a, b, _ in chosen):
                chosen.append((matched, -first, behind, n))
        if not chosen:
            return []
        # Lower-casing can lengthen a text; positions are those in the text as it was.
        spans = [m.span() for m in WORD.finditer(lower)]
        if len(lower) != len(text):
            origin = [i for i, c in enumerate(text) for _ in c.lower()]
            spans = [(origin[a], origin[b - 1] + 1) for a, b in spans]
        return [Match(self.names[n], matched, len(self.notices[n]), spans[a][0], spans[b - 1][1])
                for matched, a, b, n in sorted(chosen, key=lambda c: c[1])]


def scan_licenses(docs: DataFrame, notices: dict[str, str] | None = None, cfg: Scan = Scan()) -> DataFrame:
    """Every row of ``docs`` with n_matches, licenses (names in the order of the text), coverage (the
    highest, 0 without a match), covered_chars and spans ("start-end:matched/words" in that order)."""
    notices = NOTICES if notices is None else notices

    def start():
        scanner = Scanner(notices, cfg)

        def compute(texts):
            for found in map(scanner.scan, texts):
                yield (len(found), "; ".join(m.notice for m in found), max((m.coverage for m in found), default=0.0),
                       sum(m.end - m.start for m in found),
                       "; ".join(f"{m.start}-{m.end}:{m.matched}/{m.words}" for m in found))
        return compute

    return append_columns(docs, {"n_matches": "long", "licenses": "string", "coverage": "double",
                                 "covered_chars": "long", "spans": "string"}, start)
