"""Line dedup and the n-gram join against brute force."""

import random
import re
from collections import defaultdict

import pytest

from __spark_entry__ import oracle_sql, queries
from hourcast.llm import line_dedup as LD
from hourcast.llm import ngram_join as NJ
from hourcast.llm.components import components
from oracle_compare import compare

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- line dedup

def brute_dropped(docs, least):
    """Every line of an equal run of ``least`` characters that stood before, from all pairs of places."""
    table = [(i, [x for x in (s.strip(LD.WHITE) for s in re.split(r"(?<=\n)|(?<=[.!?] )", t)) if x]) for i, t in docs]
    out = []
    for d, (doc_id, lines) in enumerate(table):
        gone = set()
        for e in range(d + 1):
            other = table[e][1]
            for shift in range(1 if e == d else 1 - len(other), len(lines)):
                run = []
                for i in range(max(shift, 0), len(lines) + 1):
                    if i < len(lines) and i - shift < len(other) and lines[i] == other[i - shift]:
                        run.append(i)
                        continue
                    if sum(len(lines[j]) for j in run) >= least:
                        gone.update(run)
                    run = []
        out.append((doc_id, len(lines), len(gone), sum(len(lines[i]) for i in gone), sorted(gone)))
    return out


def assert_dropped(spark, docs, least):
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {tuple(r[:4]) + (tuple(r.dropped),) for r in LD.dropped_lines(df, LD.Winnow(min_chars=least)).collect()}
    want = {(*r[:4], tuple(r[4])) for r in brute_dropped(docs, least)}
    assert got == want
    assert sum(r[2] for r in want) > 20


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_line_dedup_equals_all_pairs_of_places(spark, seed):
    rng = random.Random(seed)
    pool = [" ".join(rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(rng.randint(1, 9))) for _ in range(25)]
    docs = []
    for i in range(60):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 14))]
        if docs and rng.random() < 0.4:
            lines += docs[rng.randrange(len(docs))][1].split("\n")[:rng.randint(1, 9)]
        docs.append((i, "\n".join(lines)))
    assert_dropped(spark, docs, 60)


def test_line_dedup_equals_all_pairs_for_short_lines_and_mixed_runs(spark):
    """Repeats of 2 and 3 lines, runs put together from several documents, single characters as lines,
    equal lines in a row."""
    rng = random.Random(4)
    pool = [rng.choice("abcdefghij") * rng.choice([1, 2, 25, 30, 35, 45, 70]) + str(i) for i in range(30)]
    a, b, c = "a" * 25, "b" * 25, "c" * 25
    texts = [f"{a}\n{b}", f"{b}\n{c}", f"{a}\n{b}\n{c}", f"x {a}\n{a}\n{b}\n{c}\nend", "", "\n".join("pqrst" * 40), "\n".join("zpqrst" * 40),
             "\n".join([a] * 9), "\n".join([b] + [a] * 5 + [b] + [a] * 5), "\n".join("q" * 200)]
    for _ in range(70):
        lines = [rng.choice(pool) for _ in range(rng.randint(0, 9))]
        source = rng.choice(texts).split("\n")
        at = rng.randrange(len(source))
        texts.append("\n".join(lines[:4] + source[at:at + rng.randint(1, 4)] + lines[4:]))
    assert_dropped(spark, list(enumerate(texts)), 60)


def test_line_dedup_copies_no_document_to_the_matches(spark):
    """A joined place carries its own windows only: no array of line hashes goes through a shuffle after the fingerprints."""
    docs = [(i, "\n".join(f"line {j} of many in this text, it is of some length" for j in range(6))) for i in range(4)]
    lines = LD.written(LD.line_table(spark.createDataFrame(docs, "doc_id long, text string")), "lines-test")
    plan = LD.repeated_lines(lines, LD.Winnow())._jdf.queryExecution().optimizedPlan().toString()
    assert "hashes" not in plan and "Join Inner" in plan


def test_line_dedup_cuts_a_run_whose_parts_first_stood_elsewhere(spark):
    a, b, c = "a" * 60, "b" * 60, "c" * 60
    docs = [(1, f"{a}\n{b}"), (2, f"{b}\n{c}"), (3, f"{a}\n{b}\n{c}"), (4, f"{a}\n{b}\n{c}")]
    got = {r.doc_id: r.text for r in LD.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == dict(docs) | {4: ""}


def test_line_dedup_cuts_two_lines_in_any_surroundings(spark):
    rng = random.Random(3)
    one, two = "one " * 25 + "end.", "two " * 25 + "end."
    docs = [(i, "\n".join([str(rng.random()) for _ in range(4)] + [one, two] + [str(rng.random()) for _ in range(4)])) for i in range(30)]
    got = LD.line_dedup(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sum(one in r.text or two in r.text for r in got) == 1


def test_line_dedup_cuts_the_later_passage(spark):
    passage = "It was a long passage that stood in many texts. It had a second sentence as well. And then a third that told some more. The fourth ended it all."
    docs = spark.createDataFrame([(1, f"First words.\n{passage}\nEnd of one."), (2, f"Other start. {passage} Other end."),
                                  (3, "Nothing shared here.")], "doc_id long, text string")
    got = {r.doc_id: r.text for r in LD.line_dedup(docs, LD.Winnow(min_chars=100)).collect()}
    assert got[1] == f"First words.\n{passage}\nEnd of one."
    assert got[2] == "Other start. Other end." and got[3] == "Nothing shared here."


def test_line_dedup_edges(spark, edge_docs, no_docs):
    got = LD.line_dedup(edge_docs).collect()
    assert edge_docs.columns == list(got[0].asDict()) and len(got) == 9
    texts = defaultdict(list)
    for r in got:
        texts[r.doc_id].append(r.text)
    assert texts[2] == [None] and texts[3] == [""] and texts[4] == [" \n\t \n"]
    assert texts[5][0].count("A sentence") == 1        # later repeats inside one text go
    assert sorted(texts[1]) == ["one two three four five six seven"] * 2 + ["other words under the same id"]
    assert LD.dropped_lines(no_docs).count() == 0 and LD.line_dedup(no_docs).count() == 0


# ---------------------------------------------------------------- n-gram join

def brute_components(docs, percent=75):
    sets = []
    for _, text in docs:
        words = (text or "").encode().lower().split()
        grams = [tuple(words[i:i + 5]) for i in range(len(words) - 4)] or ([tuple(words)] if words else [])
        sets.append(frozenset(grams))
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    least = {}
    for i, (doc_id, _) in enumerate(docs):
        if doc_id is not None:
            least[find(i)] = min(least.get(find(i), doc_id), doc_id)
    return sorted((str(doc_id), len(sets[i]), str(least.get(find(i)))) for i, (doc_id, _) in enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_join_equals_brute_force(spark, seed):
    """Families of near copies around the threshold, one of them large, and a common passage."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(3000)]
    passage = rng.sample(words, 30)
    docs = []
    for family in range(14):
        base = rng.sample(words, rng.randint(3, 70))
        for _ in range(60 if family == 0 else rng.randint(1, 8)):
            text = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 12))):
                text[rng.randrange(len(text))] = rng.choice(words)
            if rng.random() < 0.3:
                text += passage
            docs.append((len(docs), " ".join(text)))
    docs += [(len(docs) + i, " ".join(rng.sample(words, 4) + passage)) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = NJ.near_duplicates(df).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((str(a), b, str(c)) for a, b, c in got) == brute_components(docs)


def test_join_edges(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    got = NJ.near_duplicates(edge_docs).select("doc_id", "n_shingles", "component_id").collect()
    assert sorted((str(a), b, str(c)) for a, b, c in got) == brute_components(rows)
    assert NJ.near_duplicates(no_docs).count() == 0
    kept = NJ.one_of_each(edge_docs)
    assert kept.columns == edge_docs.columns and kept.count() == 8
    with pytest.raises(ValueError):
        NJ.Join(percent=50)


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7)], "a long, b long")
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: 0 for i in range(41)} | {100: 100, 101: 100}


@pytest.mark.parametrize("name", ["op1_line_dedup", "op4_ngram_join"])
def test_oracle(spark, name):
    _, problems = compare(spark, name, SF, queries()[name], oracle_sql()[name])
    assert not problems, problems


def family(kind, n, seed=5):
    """Texts that share much with one of them: ``apart`` (no links), ``few`` (some twins), ``twins``
    (each links with one other, none with the rest) and ``excerpts`` of one long text."""
    rng = random.Random(seed)
    fresh = iter(range(10**9))
    own = lambda k: [f"w{next(fresh)}" for _ in range(k)]
    common, texts = own(84), []
    if kind == "excerpts":
        long = own(40 * n)
        texts = [long] + [long[i * 37:i * 37 + 90] for i in range(n)]
        return [(i, " ".join(t)) for i, t in enumerate(texts)]
    while len(texts) < n:
        words = common + own(18)
        texts.append(words)
        if kind == "twins" or (kind == "few" and rng.random() < 0.03):
            texts.append(words[:100] + own(2))
    rng.shuffle(texts)
    return [(i, " ".join(t)) for i, t in enumerate(texts[:n])]


@pytest.mark.parametrize("kind", ["apart", "few", "twins", "excerpts"])
def test_join_of_a_family_equals_brute_force(spark, kind):
    docs = family(kind, 150)
    rows = NJ.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == brute_components(docs)


@pytest.mark.parametrize("kind", ["apart", "twins"])
def test_join_of_a_family_compares_no_product(spark, monkeypatch, kind):
    sizes, made = {}, NJ.written

    def counting(df, name):
        out = made(df, name)
        sizes[name] = out.count()
        return out

    monkeypatch.setattr(NJ, "written", counting)
    n = 600
    NJ.near_duplicates(spark.createDataFrame(family(kind, n), "doc_id long, text string")).collect()
    # No shingle is left to meet on in a family without links; twins meet on their own shingles alone.
    assert sizes["rest"] <= (0 if kind == "apart" else 40 * n)
    assert sizes["rest-links"] <= n
