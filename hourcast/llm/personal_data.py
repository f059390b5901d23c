"""Personal data in texts, also where it is written in disguise.

A text is searched twice.  The first search takes it as it stands and gives the base spans.
For the second one a chain of transducers rewrites the text: look-alike characters become the
ASCII ones they stand for and invisible ones go, letters between digits that look like digits
and digits spelled as words become digits, and ``at``/``dot`` disguises become ``@`` and ``.``.
Every transducer records its edits, so a span of the rewritten text is mapped back through them
to the source characters it was made of.  A span of the second search is added where something
in it was rewritten and no base span of its kind covers it.  Base spans are never changed.

Both searches use the same four patterns, leftmost and without overlaps in one kind:

* email: local part, ``@``, two labels or more;
* ip: four numbers of at most 255;
* card: 16 to 19 digits with a valid check digit, single spaces or hyphens between them;
* phone: ``+`` and 8 to 15 digits with spaces, dots, hyphens or parentheses.

Words alone are weak evidence, so ``at`` without brackets only counts in front of a domain whose
dots are spelled too ("ann at mail dot example dot org"), and at least three words of digits have
to stand in a row.

Defined results
---------------
* null or empty text: no span.
* offsets are code points of the source text, ends exclusive; overlapping spans of one kind can
  only be a base span and an added one.  Spans come by kind, start and end, so there are no ties.
* repeated rows are searched each; further columns of the input are passed through; one that
  bears the name of a result column is an error; an empty table gives an empty result.
* very long texts: every step is linear in the text, whatever it holds, and memory is a small
  multiple of the batch of texts and of the number of edits.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_right
from collections.abc import Callable, Iterable, Iterator

from pyspark.sql import DataFrame

from hourcast.llm.common import append_columns

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int]
Edit = tuple[int, int, str]

# ---------------------------------------------------------------- the four patterns

# The characters and bounds of the four kinds.
LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A number that starts no address is taken as well, so a long one is read once.
ADDRESS = re.compile(r"([0-9]++(?:\.[0-9]++){3})|[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
CARD_DIGITS, PHONE_DIGITS, MAX_PART = (16, 19), (8, 15), 255

_DIGITS_ONLY = {ord(c): None for c in " -().+"}
_TWICE = [0, 2, 4, 6, 8, 1, 3, 5, 7, 9]


def emails(text: str) -> Iterator[Span]:
    """Each ``@`` is looked at once: the local characters before it, back to the last span, and
    the domain behind it."""
    free, at = 0, text.find("@")
    while at >= 0:
        start = free + len(text[free:at].rstrip(LOCAL))
        domain = DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        free = domain.end() if domain else at + 1
        at = text.find("@", free)


def addresses(text: str) -> Iterator[Span]:
    for m in ADDRESS.finditer(text):
        parts = [p.lstrip("0") for p in m.group(1).split(".")] if m.group(1) else []
        if parts and all(len(p) <= 3 and int(p or 0) <= MAX_PART for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    """The check digit of a card number is right."""
    numbers = list(map(int, reversed(digits)))
    return (sum(numbers[::2]) + sum(_TWICE[d] for d in numbers[1::2])) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in CARD.finditer(text):
        if m.end() - m.start() < CARD_DIGITS[0]:
            continue
        digits = m.group().translate(_DIGITS_ONLY)
        if CARD_DIGITS[0] <= len(digits) <= CARD_DIGITS[1] and luhn(digits):
            yield m.span()


def phones(text: str) -> Iterator[Span]:
    for m in PHONE.finditer(text):
        if PHONE_DIGITS[0] <= len(m.group().translate(_DIGITS_ONLY)) <= PHONE_DIGITS[1]:
            yield m.span()


SEARCHES: dict[str, Callable[[str], Iterable[Span]]] = dict(zip(KINDS, (emails, addresses, cards, phones), strict=True))


# ---------------------------------------------------------------- rewriting with offsets

class Rewritten:
    """A text after edits, which maps its spans back to the text before them."""

    def __init__(self, text: str, edits: list[Edit]):
        """``edits`` (start, end, replacement) come in order and do not overlap."""
        parts, at, out = [], 0, 0
        self.begins, self.ends, self.sources = [], [], []
        for start, end, new in edits:
            parts += (text[at:start], new)
            out += start - at
            self.begins.append(out)
            out += len(new)
            self.ends.append(out)
            self.sources.append((start, end))
            at = end
        self.text = "".join([*parts, text[at:]]) if edits else text

    def _source(self, at: int, last: bool) -> int:
        """Where the character at ``at`` starts in the source, or ends with ``last``."""
        i = bisect_right(self.begins, at) - 1
        if i < 0:
            return at + last
        start, end = self.sources[i]
        if at < self.ends[i]:
            return end if last else start
        return end + at - self.ends[i] + last

    def back(self, span: Span) -> Span:
        return self._source(span[0], False), self._source(span[1] - 1, True)


# ---------------------------------------------------------------- look-alikes

# Letters of other scripts that look like an ASCII letter, and other signs for @ . + -.
LOOK_ALIKES = dict(zip(
    "АВЕЅІЈКМНОРСТХҮЗаеіјорсѕухһԁԛԝ" "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοναικρυχ" "ıɑɡօոս" "。٫․∙•·‐‑‒–−",
    "ABESIJKMHOPCTXY3aeijopcsyxhdqw" "ABEZHIKMNOPTYXovaikpux" "iagonu" "......-----", strict=True))
# Characters without a width of their own.
INVISIBLE = "­​‌‍⁠﻿‎‏"


def _folding() -> dict[str, str]:
    """Every character that stands for one ASCII character: compatibility forms (full width,
    mathematical, circled ...), decimal digits of all scripts, and the look-alikes."""
    plain = set("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789@.+-()[]{}")
    table = {}
    for code in (*range(0x80, 0xD800), *range(0xE000, 0x10000), *range(0x1D400, 0x1D800), *range(0x1F100, 0x1FC00)):
        char = chr(code)
        digit = unicodedata.decimal(char, None)
        form = unicodedata.normalize("NFKC", char).strip("()") if digit is None else str(digit)
        if form in plain:
            table[char] = form
    return table | LOOK_ALIKES | dict.fromkeys(INVISIBLE, "")


FOLD = _folding()
_LIKE_DIGITS = re.compile(r"[0-9]([OoIl])(?=[ .-]?[0-9])")


def look_alikes(text: str) -> list[Edit]:
    folded = [] if text.isascii() else sorted(FOLD.keys() & set(text))
    if not folded:
        return []
    return [(*m.span(), FOLD[m.group()]) for m in re.finditer("[" + re.escape("".join(folded)) + "]", text)]


def letters_as_digits(text: str) -> list[Edit]:
    """O and l between two digits, with at most a gap behind them."""
    return [(*m.span(1), "0" if m.group(1) in "Oo" else "1") for m in _LIKE_DIGITS.finditer(text)]


# ---------------------------------------------------------------- spelled digits

# The ten digits as words in English, German, French and Spanish.
DIGIT_WORDS = {word: str(digit) for digit, words in enumerate((
    "zero oh null zéro cero", "one eins un uno", "two zwei zwo deux dos", "three drei trois tres", "four vier quatre cuatro",
    "five fünf cinq cinco", "six sechs seis", "seven sieben sept siete", "eight acht huit ocho", "nine neun neuf nueve",
)) for word in words.split()}
TIMES = {"double": 2, "triple": 3}
LEAST_SPELLED = 3

_OPEN, _CLOSE = r"[\[({<][ \t]{0,2}", r"[ \t]{0,2}[\])}>]"
_DOT_WORDS = r"dot|punto|punkt|point"
_SHUT_DOT = rf"[ \t]{{0,3}}{_OPEN}(?:\.|{_DOT_WORDS}){_CLOSE}[ \t]{{0,3}}"
_SPELLED = rf"(?:(?:{'|'.join(TIMES)})[ -])?(?:{'|'.join(sorted(DIGIT_WORDS, key=len, reverse=True))})(?![^\W_])"
_GAP = rf"(?:{_SHUT_DOT}|[ ](?:{_DOT_WORDS})[ ]|[ ]?[-,./][ ]?|[ ])"
_RUN = re.compile(rf"(?<![^\W_])(?:[0-9]{{1,19}}{_GAP}){{0,4}}{_SPELLED}(?:{_GAP}(?:{_SPELLED}|[0-9]{{1,19}}(?![^\W_])))+", re.IGNORECASE)
_TOKEN = re.compile(rf"(?<![^\W_])({_SPELLED})|[0-9]+", re.IGNORECASE)
_PLAIN_GAP = re.compile(r"[ ,-]+")
_PLUS = re.compile(r"(?<![^\W_])(?:plus|más|mas)[ ]?(?=[0-9(])", re.IGNORECASE)


def _digits(word: str) -> str:
    first, _, second = word.lower().replace("-", " ").rpartition(" ")
    return DIGIT_WORDS[second] * TIMES.get(first, 1)


_WORD = re.compile(r"[^\W_]+")
_MARKS = dict.fromkeys([*DIGIT_WORDS, *TIMES], "s") | dict.fromkeys(_DOT_WORDS.split("|"), "d")
_THREE_OF_A_RUN = re.compile("s(?:d*s){%d}" % (LEAST_SPELLED - 1))


def may_spell_digits(text: str) -> bool:
    """Enough digit words follow each other with nothing but numbers and dots as words between them."""
    words = _WORD.findall(text.lower())
    if DIGIT_WORDS.keys().isdisjoint(words):
        return False
    marks = "".join([_MARKS.get(w) or ("d" if w.isdigit() else ".") for w in words])
    return _THREE_OF_A_RUN.search(marks) is not None


def spelled_digits(text: str) -> list[Edit]:
    """Runs of spelled digits, also mixed with written ones: words become digits, and plain
    gaps beside a word close."""
    if not may_spell_digits(text):
        return []
    edits: list[Edit] = []
    for run in _RUN.finditer(text):
        tokens = list(_TOKEN.finditer(text, run.start(), run.end()))
        if sum(len(_WORD.findall(t.group(1) or "")) for t in tokens) < LEAST_SPELLED:
            continue
        for i, token in enumerate(tokens):
            if i and (token.group(1) or tokens[i - 1].group(1)):
                gap = tokens[i - 1].end(), token.start()
                if _PLAIN_GAP.fullmatch(text, *gap):
                    edits.append((*gap, ""))
            if token.group(1):
                edits.append((*token.span(), _digits(token.group(1))))
    return edits


def spelled_plus(text: str) -> list[Edit]:
    lower = text.lower()
    if not any(word in lower for word in ("plus", "más", "mas")):
        return []
    return [(*m.span(), "+") for m in _PLUS.finditer(text)]


# ---------------------------------------------------------------- at and dot

_LABEL = "[A-Za-z0-9-]{1,63}"
_SHUT_AT = rf"[ \t]{{0,3}}{_OPEN}(?:@|at|ät|arroba|arobase|arobas|klammeraffe){_CLOSE}[ \t]{{0,3}}"
# Bare words: the sign at, the sign dot.  Languages do not mix, as "at this point in" is no address.
_BARE = (("at", "dot"), ("arroba", "punto"), ("arobase|arobas", "point"), ("ät|at|klammeraffe", "punkt"))


def _domain(dot: str) -> str:
    return rf"{_LABEL}(?:{dot}{_LABEL})+(?![^\W_])"


def _bare(words: str) -> str:
    return rf"(?:[ ](?:{words})[ ]|_(?:{words})_|-(?:{words})-)"


_BRACKETED = re.compile(rf"(?P<at>{_SHUT_AT}|@)(?:{'|'.join(_domain(d) for d in (_SHUT_DOT, *(_bare(dot) for _, dot in _BARE), re.escape('.')))})", re.IGNORECASE)
_SPACED = re.compile(rf"(?P<at>[ ]@[ ])(?:{_domain(' [.] ')}|{_domain('[.]')})")
_WORDS = [re.compile(rf"(?P<at>{_bare(at)})(?:{_domain(_bare(dot))}|{_domain(_SHUT_DOT)})", re.IGNORECASE) for at, dot in _BARE]
_ANY_DOT = re.compile(rf"{_SHUT_DOT}|{_bare(_DOT_WORDS)}|[ ][.][ ]", re.IGNORECASE)
_BETWEEN_DIGITS = re.compile(rf"(?<=[0-9])(?:{_SHUT_DOT}|{_bare(_DOT_WORDS)})(?=[0-9])", re.IGNORECASE)
# A local part has at most 64 characters; spelled dots take up to 5 more each.
_BEFORE = re.compile(rf"(?<![A-Za-z0-9._%+-])[A-Za-z0-9.%+_-]+(?:(?:{_SHUT_DOT}|{_bare(_DOT_WORDS)})[A-Za-z0-9.%+_-]+)*\Z", re.IGNORECASE)
LOCAL_WINDOW = 128
_SHUT = re.compile(rf"{_OPEN}(?:@|\.|[a-zä]{{2,12}}){_CLOSE}", re.IGNORECASE)
_BARE_DOTS = [a + word + a for word in _DOT_WORDS.split("|") for a in " _-"]


def may_disguise_signs(text: str) -> bool:
    """Some sign may stand in brackets, as a word or between spaces."""
    lower = text.lower()
    return " @ " in text or any(dot in lower for dot in _BARE_DOTS) or _SHUT.search(text) is not None


def at_and_dot(text: str) -> list[Edit]:
    """Disguised ``@`` and ``.`` of addresses, and disguised dots between digits."""
    if not may_disguise_signs(text):
        return []
    edits: set[Edit] = {(*m.span(), ".") for m in _BETWEEN_DIGITS.finditer(text)}
    for pattern in (_BRACKETED, _SPACED, *_WORDS):
        for m in pattern.finditer(text):
            window = max(0, m.start() - LOCAL_WINDOW)
            local = _BEFORE.search(text[window:m.start()])
            if not local:
                continue
            if m["at"] != "@":
                edits.add((*m.span("at"), "@"))
            edits.update((*d.span(), ".") for d in _ANY_DOT.finditer(text, m.end("at"), m.end()))
            edits.update((window + d.start(), window + d.end(), ".") for d in _ANY_DOT.finditer(local.string, local.start()))
    out: list[Edit] = []
    for edit in sorted(edits):
        if not out or edit[0] >= out[-1][1]:
            out.append(edit)
    return out


TRANSDUCERS = (look_alikes, letters_as_digits, spelled_digits, spelled_plus, at_and_dot)


# ---------------------------------------------------------------- the search

def rewrite(text: str) -> list[Rewritten]:
    """The text after each transducer that changed it."""
    chain = []
    for transducer in TRANSDUCERS:
        edits = transducer(text)
        if edits:
            chain.append(Rewritten(text, edits))
            text = chain[-1].text
    return chain


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, disguised) of all personal data in ``text``."""
    base = {kind: list(search(text)) for kind, search in SEARCHES.items()}
    found = [(kind, *span, False) for kind, spans in base.items() for span in spans]
    chain = rewrite(text)
    if chain:
        plain = chain[-1].text
        for kind, search in SEARCHES.items():
            starts = [s for s, _ in base[kind]]
            for a, b in search(plain):
                span = (a, b)
                for step in reversed(chain):
                    span = step.back(span)
                before = bisect_right(starts, span[0]) - 1
                covered = before >= 0 and base[kind][before][1] >= span[1]
                if not covered and text[span[0]:span[1]] != plain[a:b]:
                    found.append((kind, *span, True))
    order = {kind: i for i, kind in enumerate(KINDS)}
    return sorted(found, key=lambda f: (order[f[0]], *f[1:]))


def masked(text: str, found: list[tuple[str, int, int, bool]]) -> str:
    """``text`` with each span, overlapping ones together, as the kind of its first in brackets."""
    out, at = [], 0
    for start, end, kind in sorted((s, -e, k) for k, s, e, _ in found):
        if start >= at:
            out += (text[at:start], f"[{kind}]")
        at = max(at, -end)
    return "".join([*out, text[at:]])


SPAN_TYPE = "array<struct<kind:string,start:int,end:int,disguised:boolean>>"


def find_personal_data(docs: DataFrame, with_masked: bool = False) -> DataFrame:
    """Every row of ``docs`` with ``personal_data``, the spans found in ``text``, and with
    ``masked_text`` if asked for."""
    def start():
        def compute(texts):
            for text in texts:
                found = find(text)
                yield (found, masked(text, found)) if with_masked else (found,)
        return compute
    return append_columns(docs, {"personal_data": SPAN_TYPE} | ({"masked_text": "string"} if with_masked else {}), start)
