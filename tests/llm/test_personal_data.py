"""Personal data: base spans against plain patterns, disguises, offsets, odd texts."""

import hashlib
import random
import re
import time

import pytest

from __spark_entry__ import queries
from hourcast.llm import personal_data as PD

SF = "/root/testdata/sf0.001"
PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        d = int(d) * (1 + i % 2)
        total += d // 10 + d % 10
    return total % 10 == 0


def brute_base(text):
    """The patterns as they are written, each by itself."""
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "card" and not (16 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 8 <= len(digits) <= 15:
                continue
            out.append((kind, *m.span()))
    return out


def base_of(text):
    return [f[:3] for f in PD.find(text) if not f[3]]


def added_to(text):
    return [(k, text[a:b]) for k, a, b, d in PD.find(text) if d]


def test_base_spans_equal_the_patterns():
    rng = random.Random(1)
    pieces = ["a", "b.c", "@", ".", "x-y", "1", "12", "255", "256", "1.2.3.4", "4111 1111 1111 1111", "+", "+49 30 ", "(", ")", " ", "-", "_", "%",
              "é", "@x.de", "0", "00001", "\n", "５", " at ", " dot ", "one ", "[at]", "4111111111111111"]
    seen = set()
    for _ in range(6000):
        text = "".join(rng.choices(pieces, k=rng.randint(1, 25)))
        want = brute_base(text)
        assert base_of(text) == want, text
        seen |= {k for k, *_ in want}
    assert seen == set(PATTERNS)


@pytest.mark.parametrize("kind, hidden", [
    ("email", "ann dot lee at mail dot example dot org"), ("email", "ann [at] example.org"), ("email", "ann(AT)mail(DOT)example(DOT)org"),
    ("email", "ann_at_example_dot_org"), ("email", "ann@example dot org"), ("email", "ann@example[.]org"), ("email", "ann{at}example{dot}org"),
    ("email", "ann @ example . org"), ("email", "ann @ example.org"), ("email", "аnn@example.org"), ("email", "ａｎｎ＠ｅｘａｍｐｌｅ．ｏｒｇ"),
    ("email", "a​nn@exam​ple.org"), ("email", "ana arroba correo punto es"), ("email", "𝐚𝐧𝐧@example.org"),
    ("ip", "192[.]168[.]1[.]10"), ("ip", "192 dot 168 dot 1 dot 10"), ("ip", "one nine two dot one six eight dot zero dot one"),
    ("ip", "１９２．１６８．１．１０"), ("ip", "192(dot)168(dot)1(dot)1O1"),
    ("card", "４１１１ １１１１ １１１１ １１１１"), ("card", "4111 11l1 1111 1111"), ("card", "four one one one, one one one one, one one one one, one one one one"),
    ("card", "٤١١١١١١١١١١١١١١١"), ("card", "four triple one 1111 1111 1111"),
    ("phone", "+1 five five five 0123 four four"), ("phone", "plus four nine three zero one two three four five six"),
    ("phone", "＋49 30 1234567"), ("phone", "+4O 30 123 4567"), ("phone", "+49‑30‑1234567"), ("phone", "plus vier neun drei null eins zwei drei vier fünf"),
])
def test_disguised_data_is_found_where_it_stands(kind, hidden):
    for before, after in (("", ""), ("Write to me: ", ", thanks."), ("Straße – é ", "\nNext line.")):
        assert (kind, hidden) in added_to(before + hidden + after)


@pytest.mark.parametrize("text", [
    "Look at this point in time, dot by dot.", "We met at home. One two three, said the two of them.", "see look-at-me.com or snake_at_dot",
    "one two three four five six seven eight nine ten", "Version 3 dot 5 is at stage 2 dot 1", "ratio 1:2, (at) least", "f(x) = {a} [b] <c>",
    "ann@example.org is fine as it is", "call +49 30 1234567 or 10.0.0.1 now", "Das ist am Punkt, ein zwei drei", "un deux trois, point final",
    "m² and ½ and ① — naïve café", "Привет, как дела?", "user@host . Next sentence", "room 1O1 at 9 dot",
])
def test_plain_texts_are_left_alone(text):
    assert added_to(text) == []


def test_base_spans_stay_beside_disguised_ones():
    text = "jоhn@example.com"                     # the o is not a Latin one
    assert PD.find(text) == [("email", 0, 16, True), ("email", 2, 16, False)]
    assert brute_base(text) == [("email", 2, 16)]
    assert PD.masked("x " + text + " y", PD.find("x " + text + " y")) == "x [email] y"


def test_spans_map_back_through_all_edits():
    rng = random.Random(7)
    for _ in range(500):
        text = "".join(rng.choices("abcdefgh", k=30))
        edits, at = [], 0
        while at < 28:
            a = at + rng.randint(0, 4)
            b = a + rng.randint(0, 3)
            if b > 30:
                break
            edits.append((a, b, "".join(rng.choices("XYZ", k=rng.randint(0, 3)))))
            at = b + 1
        edits = [e for e in edits if e[0] < e[1] or e[2]]
        made = PD.Rewritten(text, edits)
        origin = []                                # for each new character, its source span
        pos = 0
        for a, b, new in [*edits, (30, 30, "")]:
            origin += [(i, i + 1) for i in range(pos, a)] + [(a, b)] * len(new)
            pos = b
        assert len(origin) == len(made.text)
        for a in range(len(origin)):
            for b in range(a + 1, len(origin) + 1):
                assert made.back((a, b)) == (origin[a][0], origin[b - 1][1])


@pytest.mark.parametrize("piece", ["a", "1", "1.1", "+", "+1 ", "@", "a@", "one ", " ", "[", "а", "a-at-", "a dot ", " at a dot b", "one 1 ", "a.@b.", "1 dot ", "[.]"])
def test_very_long_texts_take_linear_time(piece):
    def seconds(n):
        text = piece * (n // len(piece))
        start = time.process_time()
        PD.find(text)
        return time.process_time() - start
    assert seconds(160_000) < 12 * seconds(40_000) + 0.5


def test_every_row_has_its_spans(spark, edge_docs, no_docs):
    rows = [(1, "mail ann [at] example.org or bob@example.org"), (1, "mail ann [at] example.org or bob@example.org"), (2, None), (3, ""), (None, "+49 30 1234567")]
    got = PD.find_personal_data(spark.createDataFrame([(*r, 9) for r in rows], "doc_id long, text string, spans int"), with_masked=True).collect()
    assert [r.masked_text for r in got] == ["mail [email] or [email]"] * 2 + ["", "", "[phone]"]
    assert [tuple(s) for s in got[0].personal_data] == [("email", 5, 25, True), ("email", 29, 44, False)]
    assert got[0].spans == 9 and got[2].text is None
    assert PD.find_personal_data(edge_docs).count() == edge_docs.count()
    assert PD.find_personal_data(no_docs).count() == 0
    with pytest.raises(ValueError):
        PD.find_personal_data(spark.createDataFrame([(1, "x", 2)], "doc_id long, text string, Personal_Data int"))


def test_query_equals_brute_force(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = queries()["op13_personal_data"](spark, SF).collect()
    assert len(rows) == len(texts) and sum(r.n_email + r.n_ip + r.n_card + r.n_phone for r in rows)
    for r in rows:
        base = [":".join(map(str, b)) for b in brute_base(texts[r.doc_id])]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(b.startswith(k + ":") for b in base) for k in PD.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(",") if r.spans else [])
