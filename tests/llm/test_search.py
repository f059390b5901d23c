"""Top-k search, page extraction, licence scan and the pipeline."""

import html
import random
import re

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from __spark_entry__ import oracle_sql, queries
from hourcast.llm import html_extract as HX
from hourcast.llm import knn as KN
from hourcast.llm import license_scan as LS
from hourcast.llm.common import DOCUMENT_COLUMNS
from hourcast.llm.license_texts import NOTICES
from oracle_compare import compare

SF = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- top-k

def test_top_k_oracle(spark):
    _, problems = compare(spark, "op9_exact_top_k", SF, queries()["op9_exact_top_k"], oracle_sql()["op9_exact_top_k"])
    assert not problems, problems


def brute_top_k(rows, k, every):
    ok = [(i, np.floor(256 * np.array(v, float)).astype(int)) for i, v in rows
          if i is not None and v and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for q in sorted({i for i, _ in ok if i % every == 0}):
        query = min((len(v), v.tolist()) for i, v in ok if i == q)[1]
        found = sorted((-int(v @ np.array(query)), i) for i, v in ok if i != q and len(v) == len(query))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(found[:k])]
    return out


@pytest.mark.parametrize("shard_rows, part_queries", [(10_000, 10_000), (40, 7)])
def test_top_k_equals_brute_force(spark, shard_rows, part_queries):
    """Ties, copies, repeated ids, other lengths and bad rows, over one and many trees."""
    rng = random.Random(5)
    rows = [(i, [rng.choice([-1.0, -0.5, 0.0, 0.25, 0.5]) for _ in range(4)]) for i in range(400)]
    rows += [(10, [0.5, 0.5, 0.5, 0.5]), (rows[7][0], rows[7][1]), (20, None), (30, [1.0, None, 0.0, 0.0]),
             (40, [float("nan"), 0.0, 0.0, 0.0]), (50, [float("inf")] * 4), (None, [1.0] * 4), (60, []),
             (1000, [1.0, 2.0]), (1001, [0.5, 0.5]), (1010, [9.0])]
    df = spark.createDataFrame([(i, v, 0) for i, v in rows], "vec_id long, embedding array<float>, label int").repartition(5)
    cfg = KN.Search(shard_rows=shard_rows, part_queries=part_queries, leaf_rows=8)
    got = KN.top_k(df, F.col("vec_id") % 10 == 0, cfg).collect()
    assert sorted(tuple(r) for r in got) == sorted(brute_top_k(rows, 5, 10))


def test_tree_boxes_are_tight_and_skip():
    rng = np.random.default_rng(1)
    vectors = rng.normal(0, 1, (2000, 3)).round(2) * 100
    tree = KN.Tree(np.arange(2000), vectors, 16)
    for node, (a, b) in enumerate(tree.spans):
        assert (tree.low[node] == tree.vectors[a:b].min(0)).all() and (tree.high[node] == tree.vectors[a:b].max(0)).all()
    query = vectors[5]
    best = np.sort(vectors @ query)[::-1]
    bounds = tree.bounds(query[None])[0]
    found = sorted((s for s, _ in tree.search(query, bounds, -1, 5, -np.inf)), reverse=True)
    assert found == best[:5].tolist()
    assert (bounds >= best[4]).sum() < len(bounds) / 2      # most boxes stay closed


def test_top_k_empty(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert KN.top_k(none, F.col("vec_id") % 50 == 0).count() == 0


# ---------------------------------------------------------------- pages

def article_of(page):
    """The article of a page of the test table, by its known template."""
    body = page[page.index("<article>") + 9:]
    body = body[:body.index("</article>")] if "</article>" in body else body.split("<footer>")[0]
    blocks = [" ".join(html.unescape(re.sub("<[^>]*>", "", b.replace("<br>", " "))).split()) for b in re.split("</?(?:p|h1)>", body)]
    return "\n\n".join(b for b in blocks if b)


def test_pages_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet("/root/testdata/sf0.01/pages.parquet").collect()}
    got = queries()["op6_html_extraction"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == article_of(pages[r.page_id].html) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


LONG = "A paragraph of the article with quite some words in it, so that it is taken for content. " * 3


@pytest.mark.parametrize("page, want", [
    (f"<body><div class='site-header'>Logo</div><div id=content><h2>T &amp; t</h2><p>{LONG}<p>Short.</div>"
     f"<div class='comments'><p>{LONG}</p></div><div class=sidebar>{LONG}</div></body>", ["T & t", LONG, "Short."]),
    (f"<main><p>{LONG}</p><form><p>Name <input name=x></p></form><aside>{LONG}</aside><ul><li>one<li>two</ul>"
     f"<div role='alert'>Notice!</div><p>end&nbsp;here</p></main>", [LONG, "one", "two", "end here"]),
    (f"<article><header>Site</header><p>{LONG}</p><script>var a='<p>x</p>'</script><style>p{{}}</style><!-- <p>no</p> -->"
     f"<p hidden>no</p><p style='display: none'>no</p><table><tr><td>a<td>b<tr><td>c</table></article><footer>f</footer>", [LONG, "a b", "c"]),
    (f"<div><a href=a>One</a> <a href=b>Two</a></div><div><p>{LONG}</p><p>tail <b>bold</b></p></div>", [LONG, "tail bold"]),
    (f"<body class='has-sidebar'><article class='post no-comments'><p>{LONG}", [LONG]),
    (f"<p>{LONG}</p></div></p></span>after", [LONG, "after"]),
    ("plain &lt;text&gt;\n only", ["plain <text> only"]), ("<nav>a</nav>", []), ("", [])])
def test_extract(page, want):
    assert HX.extract(page) == "\n\n".join(" ".join(w.split()) for w in want)


@pytest.mark.parametrize("page, want", [
    (f"<body><nav>n</nav><article><h1>T</h1><div class=entry><p>{LONG}</p></div></article><div>x</div><footer>f</footer></body>", ["T", LONG]),
    (f"<nav>n</nav><article><section>{LONG * 40}</section><section>One more.</section></article><div>x</div>", [LONG * 40, "One more."]),
    (f"<main><h1>T</h1><article><p>{LONG}</p></article></main>", ["T", LONG]),
    (f"<body><nav>n</nav><div id=c><p>Intro.</p><ul>{f'<li>{LONG}' * 30}</ul></div><div>x</div></body>", ["Intro.", *[LONG] * 30]),
    (f"<body><nav>n</nav><p>Intro.</p><table>{f'<tr><td>{LONG}' * 30}</table><p>End.</p><footer>f</footer></body>", ["Intro.", *[LONG] * 30, "End."]),
    (f"<body><nav>n</nav><div class=post><h1>T</h1><div><p>{LONG}</p></div><div class=comments>c</div></div><div>x</div></body>", ["T", LONG]),
    (f"<body><nav>n</nav><div><p>By line</p><div><div><h2>T</h2><p>{LONG}</p></div></div></div><div>x</div></body>", ["By line", "T", LONG])])
def test_extract_keeps_the_article_around_its_longest_part(page, want):
    assert HX.extract(page) == "\n\n".join(" ".join(w.split()) for w in want)


def test_pages_edges(spark):
    df = spark.createDataFrame([(1, None, None, 3), (1, "u", "", 3), (2, "u", "<p>x", 3), (2, "u", "<p>x", 3), (3, "u", "<" * 5000, 3)],
                               "page_id long, url string, html string, extra int")
    got = [(r.page_id, r.text, r.n_chars) for r in HX.extract_pages(df).collect()]
    assert sorted(got[:4]) == [(1, "", 0), (1, "", 0), (2, "x", 1), (2, "x", 1)]
    assert HX.extract_pages(df.where("false")).count() == 0


WORDS = "The council met on Tuesday to talk about the bridge, and nobody had read the report that it had paid for. "
TEXT = f"<p>{WORDS * 3}</p><p>{WORDS * 2}</p>"
PLAIN = "\n\n".join([(WORDS * 3).strip(), (WORDS * 2).strip()])
MENU = "<nav><a href=1>Home</a> <a href=2>News</a></nav>"
NOISE = "<div class=sidebar><p>Most read today: a list of things.</p></div><footer>All rights.</footer>"


@pytest.mark.parametrize("body, want", [
    (f"{MENU}<div class='content-sidebar-wrap'><article><h1>Head</h1>{TEXT}</article>{NOISE}</div>", "Head\n\n" + PLAIN),
    (f"{MENU}<div class='page-with-sidebar'><article><h1>Head</h1>{TEXT}</article></div>{NOISE}", "Head\n\n" + PLAIN),
    (f"{MENU}<div id=main class='header-large'><article><h1>Head</h1>{TEXT}</article></div>{NOISE}", "Head\n\n" + PLAIN),
    (f"{MENU}<div class='elementor-widget-container'><article><h1>Head</h1>{TEXT}</article></div>{NOISE}", "Head\n\n" + PLAIN),
    (f"<form action=x>{MENU}<main><h1>Head</h1>{TEXT}</main>{NOISE}</form>", "Head\n\n" + PLAIN),
    (f"{MENU}<article><h1>Head</h1><div class='post-body share-enabled'>{TEXT}</div></article>{NOISE}", "Head\n\n" + PLAIN),
    (f"{MENU}<article><header><h1>Head</h1><p>By Ann, 3 May</p></header>{TEXT}</article>{NOISE}", "Head\n\n" + PLAIN),
    (f"{MENU}<div class='widget-area'><div class='sidebar-left'><h1>Head</h1>{TEXT}</div></div>{NOISE}", "Head\n\n" + PLAIN),
    (f"<header><h1>The Site</h1></header>{MENU}<article>{TEXT}</article>{NOISE}", PLAIN),
    # Long comments, notices and teasers stay out beside a short article.
    (f"{MENU}<article><h1>Head</h1><p>{WORDS}</p></article><div class=comments>{TEXT * 4}</div>", "Head\n\n" + WORDS.strip()),
    (f"{MENU}<article><h1>Head</h1><p>{WORDS}</p></article><div class='cookie-notice'><h1>Cookies</h1>{TEXT}</div>", "Head\n\n" + WORDS.strip()),
    (f"{MENU}<main><h1>Head</h1><p>{WORDS}</p></main><div class=related><article>{TEXT}</article></div>", "Head\n\n" + WORDS.strip()),
    (f"<div style='display:none'><article><h1>Old</h1>{TEXT}</article></div><div><p>{WORDS}</p></div>", WORDS.strip()),
    (f"<div class=comments>{TEXT}</div>", ""),
])
def test_wrappers_are_looked_through(body, want):
    assert HX.extract(f"<html><head><title>T</title></head><body>{body}</body></html>") == want



# ---------------------------------------------------------------- licences

def test_licence_query_finds_every_notice(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    got = queries()["op10_license_scan"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == len(docs)
    short = {n: " ".join(t.split()).rstrip(".") for n, t in NOTICES.items() if len(t.split()) < 13}
    hits = 0
    for r in got:
        text = docs[r.doc_id]
        exact = sorted((text.index(t), n, text.index(t) + len(t)) for n, t in short.items() if t in text)
        found = [x for x in zip(r.licenses.split("; "), r.spans.split("; ")) if x[0]]
        for at, name, end in exact:
            hits += 1
            assert any(n == name and s.startswith(f"{at}-{end}:") for n, s in found), (r.doc_id, exact, found)
        assert r.n_matches == len(found) and (r.coverage >= 0.8 if found else r.coverage == 0)
    assert hits > 10


PLANTED = ["Licensed under the Apache License, Version 2.0.", "Released under the MIT License.", "Licensed under CC BY-NC 4.0.",
           "This work is licensed under the GNU General Public License, version 3.", "All rights reserved."]


def test_licence_scan_reports_every_planted_line():
    docs = [r["text"] for r in pq.read_table("/root/testdata/sf0.01/documents.parquet", columns=["text"]).to_pylist()]
    scanner, seen = LS.Scanner(NOTICES, LS.Scan()), set()
    for text in docs:
        for line in PLANTED:
            at = (text or "").find(line)
            if at >= 0:
                seen.add(line)
                assert any(m.start <= at and m.end >= at + len(line) - 1 for m in scanner.scan(text)), line
    assert seen == set(PLANTED)


@pytest.mark.parametrize("name, start, end", [
    ("MIT text", "Permission is hereby granted", "OTHER DEALINGS IN THE SOFTWARE"),
    ("ISC text", "Permission to use", "PERFORMANCE OF THIS SOFTWARE"),
    ("BSD-2-Clause text", "Redistribution and use", "POSSIBILITY OF SUCH DAMAGE"),
    ("BSD-3-Clause text", "Redistribution and use", "POSSIBILITY OF SUCH DAMAGE"),
    ("BSD-4-Clause text", "Redistribution and use", "POSSIBILITY OF SUCH DAMAGE"),
    ("Unlicense", "This is free", "please refer to http://unlicense.org")])
def test_whole_licences_are_covered_to_their_end(name, start, end):
    text = f"Copyright 2020 someone. {NOTICES[name]} More."
    found = LS.Scanner(NOTICES, LS.Scan()).scan(text)
    assert [(m.notice, m.coverage) for m in found] == [(name, 1.0)]
    span = " ".join(text[found[0].start:found[0].end].split())
    assert span.startswith(start) and span.endswith(end)


@pytest.mark.parametrize("text, name", [
    ("Permission is hereby granted, free of charge, to any person obtaining a copy", None),
    ("Licensed under CC BY-NC-SA 4.0.", "CC-BY-NC-SA-4.0 notice"), ("Licensed under CC BY-ND 4.0.", "CC-BY-ND-4.0 notice"),
    ("Licensed under CC BY-NC 4.0.", "CC-BY-NC-4.0 notice"), ("Licensed under CC BY 4.0.", "CC-BY-4.0 notice"),
    ("This work is licensed under the GNU Affero General Public License, version 3.", "AGPL-3.0 notice")])
def test_licence_variants_have_their_own_names(text, name):
    assert [m.notice for m in LS.Scanner(NOTICES, LS.Scan()).scan(text)] == ([name] if name else [])


@pytest.mark.parametrize("name", sorted(NOTICES))
def test_notices_are_found_with_edits_and_spans(name):
    scanner = LS.Scanner(NOTICES, LS.Scan())
    words = NOTICES[name].split()
    if len(words) > 20:
        words[len(words) // 2:len(words) // 2] = ["inserted", "words"]
        del words[len(words) // 4]
    text = f"İntro of a text, ß. {' '.join(words)} And the rest."
    found = scanner.scan(text)
    assert [m.notice for m in found] == [name] or name == "Apache-2.0 header" and found[0].notice == name
    assert text[found[0].start:found[0].end].lower().startswith(re.findall("[a-z0-9]+", " ".join(words).lower())[0])
    assert found[0].coverage >= (0.9 if len(words) > 20 else 1.0)


@pytest.mark.parametrize("between", ["\n", " ", " one two ", " one two three four five six seven eight nine ten "])
def test_short_notices_in_a_row_are_each_found(between):
    notice = "Released under the MIT License."
    text = f"Some words. {between.join([notice] * 4)} All rights reserved. All rights reserved."
    found = LS.Scanner(NOTICES, LS.Scan()).scan(text)
    assert [m.notice for m in found] == ["MIT notice"] * 4 + ["All rights reserved notice"] * 2
    assert all(text[m.start:m.end] + "." in (notice, "All rights reserved.") for m in found)


def test_short_notice_with_one_word_changed():
    words = "Released under the MIT License".split()
    scanner = LS.Scanner(NOTICES, LS.Scan())
    for at in (0, 4):       # a word in the middle leaves no three in a row
        text = " ".join([*words[:at], "Other", *words[at + 1:]])
        assert [(m.notice, m.matched) for m in scanner.scan(text)] == [("MIT notice", 4)]


def test_alignment_equals_full_alignment():
    """Inside a band that holds everything, the score is that of an unbanded local alignment."""
    rng = random.Random(2)
    for _ in range(200):
        a = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        b = [rng.choice("abc") for _ in range(rng.randint(1, 9))]
        best, table = 0, [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a, 1):
            for j, y in enumerate(b, 1):
                table[i][j] = max(0, table[i - 1][j - 1] + (2 if x == y else -1), table[i - 1][j] - 1, table[i][j - 1] - 1)
                best = max(best, table[i][j])
        matched, first, behind = LS.align(a, b, -len(a) - 2, len(b) + 2)
        assert (best > 0) == (matched > 0) and 2 * matched >= best
        if matched:
            assert 0 <= first < behind <= len(b)


def test_licence_edges(spark, edge_docs, no_docs):
    got = LS.scan_licenses(edge_docs).collect()
    assert len(got) == 9 and all(r.n_matches == 0 and r.licenses == "" and r.extra == 7 for r in got)
    assert LS.scan_licenses(no_docs).count() == 0


# ---------------------------------------------------------------- pipeline

def test_pipeline_stages_and_effects(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "quality classifier", "line dedup", "n-gram Jaccard join", "packing"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    sizes, before = [], docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf).cache()
        assert after.columns == DOCUMENT_COLUMNS
        ids, had = {r.doc_id for r in after.collect()}, {r.doc_id for r in before.select("doc_id").collect()}
        assert ids <= had
        sizes.append(len(ids))
        if name == "quality classifier":
            assert all(labels.get(i) != 1 for i in had - ids)          # no clean document goes
        if name == "line dedup":
            assert after.where("n_chars <> length(text) or trim(text) = ''").count() == 0
            texts = {r.doc_id: r.text for r in before.collect()}
            kept = {t for i, t in texts.items() if i in ids}
            assert all(texts[i] in kept or len(texts[i]) >= 150 for i in had - ids)      # only copies go
        before = after
    assert docs.count() > sizes[0] >= sizes[1] > sizes[2] >= sizes[3] > 0
    packed = corpus_pipeline.STAGES[-1][1](spark, before, sf)
    assert {r.doc_id for r in packed.collect()} == ids
    assert sorted(map(tuple, corpus_pipeline.run(spark, sf).collect())) == sorted(map(tuple, packed.collect()))


def test_pipeline_edges(spark, edge_docs, no_docs, tmp_path):
    labels = spark.createDataFrame([(5, 0), (1, 1)], "doc_id long, quality int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for docs in (edge_docs, no_docs):
        out = docs
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, docs, str(tmp_path)).count()
            out = stage(spark, out, str(tmp_path))
        out.count()
