"""N-gram Jaccard join with adaptive multi-match prefixes, and the components of its links.

A document is its set of distinct ``ngram``-word shingles (words lower-cased in A-Z; a shorter
text is one shingle of all its words), as 64-bit hashes.  Documents with equal sets are one
class.  Two classes link if 100 * |intersection| >= percent * |union|.

Prefixes: under any order of all shingles, two linked sets of sizes n share at least l of
their first n - ceil(t n) + l shingles (t = percent / 100), for any l; with different l they
share the smaller one.

1. Multi-match filter, in the order of the hash: each class emits half of its shingles, which
   is a prefix with l of at least (t - 1/2) n.  A class stays if at least t (t - 1/2) n of them
   (the l of the smallest possible partner) occur in another class.  Shingles that several classes of one
   batch hold are counted there, and the batch sends one row for each, so a shingle that a
   third of all documents hold costs one row per batch.
2. Adaptive prefixes of the classes that stay, in the order of (frequency, hash): the prefix
   of each is lengthened to the l with the least estimated cost, which is the total length
   of the lists of its prefix shingles (scan) plus VERIFY_COST times that total over l (a
   partner must appear on l of them).
3. Stars: each list's classes are verified against its center, the class with the most frequent
   shingles (of a group of copies, the one they were made from).  This is linear in the lists
   and joins the bulk of a large group.
4. Rest: two classes of lists with one center share at most the smaller of what they share with
   the center, and the smaller of what each shares with others but not with the center.  Classes
   alike in their size and in both parts are one kind, and this bound is taken between kinds, so
   a family that shares much with its center but links nowhere ends here.  For kinds that it lets
   through, one class of a pair outside the center's component, a second prefix is taken inside
   the family: of the shingles outside the center where a link needs some of them, else of all,
   the rarest in the family first.  Pairs in different components that meet there, and that share the
   smaller l of the two first prefixes, are verified.  A pair left out has no link, a pair in one
   component needs none, so the components are exact.

Verification is exact on the full sets.

Defined results
---------------
* null, empty or word-free text: no shingles, linked with nothing, its own component.
* rows that repeat a text are copies and share a component; a repeated doc_id is no error; a
  null doc_id never names a component that has another id.
* further columns of the input are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.common import by_size, slices, written
from hourcast.llm.components import components

MIX = np.uint64(0x9E3779B97F4A7C15)
# Characters that are shingled together, so shared shingles among them are met before the shuffle.
BLOCK_CHARS = 12_000_000
KNOWN_WORDS = 300_000
# A verification reads two sets, a scan one row of a list.
VERIFY_COST = 16
FILTER_BITS = 23


@dataclass(frozen=True)
class Join:
    """``percent`` is over 50, as the filter's prefix is half of a set."""

    ngram: int = 5
    percent: int = 75

    def __post_init__(self):
        if not 50 < self.percent <= 100:
            raise ValueError("percent must be over 50 and at most 100")


class Shingler:
    """Sorted distinct shingle hashes of texts."""

    def __init__(self, ngram: int):
        self.ngram = ngram
        self.known: dict[bytes, int] = {}

    def _hash(self, word: bytes) -> int:
        found = self.known.get(word)
        if found is None:
            found = self.known[word] = xxhash.xxh3_64_intdigest(word)
        return found

    def __call__(self, text: str) -> np.ndarray:
        words = text.encode().lower().split()
        if len(words) < self.ngram:
            whole = xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))
            return np.array([whole] if words else [], np.uint64).view(np.int64)
        if len(self.known) > KNOWN_WORDS:
            self.known.clear()
        codes = np.fromiter(map(self._hash, words), np.uint64, len(words))
        n = len(codes) - self.ngram + 1
        mixed = np.full(n, np.uint64(self.ngram))
        for i in range(self.ngram):
            mixed = (mixed ^ codes[i:i + n]) * MIX
            mixed ^= mixed >> np.uint64(29)
        return np.unique(mixed.view(np.int64))


def class_id(shingles: np.ndarray) -> int | None:
    """A 64-bit digest of a set; null for an empty one."""
    return xxhash.xxh3_64_intdigest(shingles.tobytes()) - (1 << 63) if len(shingles) else None


def document_table(docs: DataFrame, cfg: Join) -> DataFrame:
    """(doc_id, k, n_shingles, class, met, tokens) per row.  ``met``: its half-prefix shingles that
    another class of the batch holds; ``tokens``: the ones to look for elsewhere.  Both are set
    for the first row of a class in a batch.  A row without doc_id, k and class carries
    shingles that the batch has met."""
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    names = ["doc_id", "k", "n_shingles", "class", "met", "tokens"]

    def block_rows(block, shingler):
        seen, rows, halves = set(), [], []
        for doc_id, k, text in block:
            shingles = shingler(text)
            cls = class_id(shingles)
            first = cls is not None and cls not in seen
            seen.add(cls)
            rows.append([doc_id, k, len(shingles), cls, None, None])
            # A copy, so the other half of the set goes with its row.
            halves.append(shingles[:(len(shingles) + 1) // 2].copy() if first else shingles[:0].copy())
        every = np.concatenate(halves)
        tokens, where, counts = np.unique(every, return_inverse=True, return_counts=True)
        shared = counts[where] > 1
        ends = np.cumsum([len(h) for h in halves])
        for row, half, end in zip(rows, halves, ends.tolist(), strict=True):
            if len(half):
                both = shared[end - len(half):end]
                row[4], row[5] = int(both.sum()), half[~both]
        if shared.any():
            rows.append([None, None, -1, None, None, tokens[counts > 1]])
        return rows

    def run(batches):
        shingler = Shingler(cfg.ngram)
        given = (row for batch in slices(batches)
                 for row in zip(batch.column("doc_id").to_pylist(), batch.column("k").to_pylist(),
                                (t or "" for t in batch.column("text").to_pylist()), strict=True))
        for block in by_size(given, lambda r: len(r[2]), BLOCK_CHARS):
            rows = block_rows(block, shingler)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)

    return (docs.select("doc_id", F.xxhash64("doc_id", "text").alias("k"), "text")
            .mapInArrow(run, "doc_id long, k long, n_shingles long, class long, met long, tokens array<long>"))


def sharing_classes(table: DataFrame, cfg: Join) -> DataFrame:
    """(class): those that pass the multi-match filter."""
    rows = table.select("class", F.explode("tokens").alias("token"))
    by_token = Window.partitionBy("token")
    # A row without class tells that a batch has met the token in two classes.
    elsewhere = (F.min("class").over(by_token) != F.max("class").over(by_token)) | (
        F.count(F.lit(1)).over(by_token) > F.count("class").over(by_token))
    hits = (rows.withColumn("elsewhere", elsewhere).where("elsewhere and class is not null")
            .groupBy("class").agg(F.count(F.lit(1)).alias("hits")))
    # The copy of a class that shares most in its batch decides; the rest of its shingles were looked up.
    sizes = table.where("met is not null").groupBy("class").agg(F.max("n_shingles").alias("n"), F.max("met").alias("met"))
    met = F.coalesce("hits", F.lit(0)) + F.col("met")
    least = F.col("n") * cfg.percent * (2 * cfg.percent - 100)
    return sizes.join(hits, "class", "left").where((met > 0) & (met * 20_000 >= least)).select("class")


def shingle_sets(docs: DataFrame, classes: DataFrame, cfg: Join) -> DataFrame:
    """(class, n, tokens) for ``classes``, made again from the texts.

    The tasks drop most other documents with a bitmap of fixed size (2**FILTER_BITS bits,
    whatever the number of classes); the join drops those that slip through.
    """
    bit = F.pmod(F.col("class"), F.lit(1 << FILTER_BITS))
    words = (classes.select(F.shiftright(bit, 6).alias("word"), bit.bitwiseAND(63).cast("int").alias("at"))
             .groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, at)")).alias("bits")).toArrow())
    bitmap = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    bitmap[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    mask = (1 << FILTER_BITS) - 1

    def run(batches):
        shingler, sent = Shingler(cfg.ngram), set()  # a task sends each class once
        for batch in slices(batches):
            ids, sets = [], []
            for text in batch.column("text").to_pylist():
                shingles = shingler(text or "")
                cls = class_id(shingles)
                if cls is not None and cls not in sent and int(bitmap[(cls & mask) >> 6]) >> (cls & 63) & 1:
                    sent.add(cls)
                    ids.append(cls)
                    sets.append(shingles)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array(sets, pa.list_(pa.int64()))], names=["class", "n", "tokens"])

    made = docs.select("text").mapInArrow(run, "class long, n long, tokens array<long>")
    return made.join(classes, "class", "left_semi").dropDuplicates(["class"])


def prefix_size(n: Column, cfg: Join) -> Column:
    """Length of the prefix for one match: n - ceil(t n) + 1."""
    return n - F.ceil(n * cfg.percent / 100) + 1


def adaptive_prefixes(sets: DataFrame, cfg: Join) -> DataFrame:
    """(token, class, n, held, typical, matches): the prefix shingles that several classes hold.

    ``held``: the class's shingles that others hold as well; ``typical``: the mean frequency of
    its shingles, which is highest for the class that a group's copies were made from.
    """
    rows = sets.select("class", "n", F.explode("tokens").alias("token"))
    frequent = rows.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    shared = rows.join(frequent, "token")
    of_class = Window.partitionBy("class")
    in_order = of_class.orderBy("df", "token")
    # Shingles of one class alone come first in the order and need no rows.
    ranked = (shared.withColumn("nth", F.row_number().over(in_order))
              .withColumn("scan", F.sum(F.col("df") - 1).over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
              .withColumn("held", F.count(F.lit(1)).over(of_class))
              .withColumn("typical", F.sum("df").over(of_class) / F.col("n"))
              .withColumn("l", F.col("n") - F.col("held") + F.col("nth") - prefix_size(F.col("n"), cfg) + 1))
    # A class whose prefix for one match holds only shingles of its own has no partner.
    ranked = ranked.where(F.col("n") - F.col("held") < prefix_size(F.col("n"), cfg))
    # l below 1: the prefix for one match holds this shingle and more.
    cost = F.col("scan") * (1 + F.lit(VERIFY_COST) / F.greatest("l", F.lit(1)))
    best = F.min(F.when(F.col("l") >= 1, F.struct(cost.alias("cost"), F.col("l").alias("l")))).over(of_class)
    return (ranked.withColumn("matches", F.coalesce(best["l"], F.lit(1))).where("l <= matches")
            .select("token", "class", "n", F.col("held").cast("long").alias("held"), "typical",
                    F.col("matches").cast("int").alias("matches")))


def overlaps(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (a, b) with both sizes and the exact size of the intersection."""
    side = lambda x: sets.select(F.col("class").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    return both.select("a", "b", "n_a", "n_b", F.size(F.array_intersect("t_a", "t_b")).cast("long").alias("shared"))


def _links(shared: Column, n: Column, m: Column, cfg: Join) -> Column:
    return shared * 100 >= (n + m - shared) * cfg.percent


def _kinds_may_link(x: str, y: str, cfg: Join) -> Column:
    """Two classes share at most the smaller inner and the smaller outer part."""
    most = F.least(f"{x}.inner", f"{y}.inner") + F.least(f"{x}.outer", f"{y}.outer")
    return _links(most, F.col(f"{x}.n"), F.col(f"{y}.n"), cfg)


def kind_needs(members: DataFrame, cfg: Join) -> DataFrame:
    """(center, kind, apart, need): the kinds of members (n, inner, outer) that may link with another
    kind of their center, one of the two outside the center's component.

    ``apart``: links that need shingles outside the center, ``need`` of them at least; of the
    others ``need`` is the least number of shingles shared in all.  Only kinds are compared here,
    whose number is bounded by the sizes of sets and not by how many classes there are.
    """
    kinds = members.groupBy("center", "kind").agg(F.max(F.col("component") != F.col("home")).alias("away"))
    x, y = kinds.where("away").alias("x"), kinds.alias("y")
    both = x.join(y, "center").where(_kinds_may_link("x.kind", "y.kind", cfg))
    least = F.ceil((F.col("x.kind.n") + F.col("y.kind.n")) * cfg.percent / (100 + cfg.percent))
    outside = least - F.least("x.kind.inner", "y.kind.inner")
    return (both.select("center", F.explode(F.array("x.kind", "y.kind")).alias("kind"), (outside > 0).alias("apart"),
                        F.when(outside > 0, outside).otherwise(least).alias("need"))
            .groupBy("center", "kind", "apart").agg(F.min("need").alias("need")))


def rest_lists(members: DataFrame, needs: DataFrame, sets: DataFrame) -> DataFrame:
    """``members`` of the kinds in ``needs`` with one row per (apart, token) of their prefixes.

    The shingles (``apart``: those outside the center) that several such members hold, in the order of
    their frequency among these; two that share ``need`` meet in the first held - need + 1.
    """
    of = sets.select("class", "tokens")
    centers = of.select(F.col("class").alias("center"), F.col("tokens").alias("central"))
    mine = members.join(needs, ["center", "kind"]).join(of, "class").join(centers, "center")
    tokens = F.when(F.col("apart"), F.array_except("tokens", "central")).otherwise(F.col("tokens"))
    rows = mine.select("center", "apart", "class", "need", F.explode(tokens).alias("token"))
    rows = written(rows, "rest-tokens")
    often = rows.groupBy("center", "apart", "token").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    one = Window.partitionBy("center", "apart", "class")
    prefix = (rows.join(often, ["center", "apart", "token"])
              .withColumn("nth", F.row_number().over(one.orderBy("df", "token")))
              .withColumn("held", F.count(F.lit(1)).over(one)).where("nth <= held - need + 1")
              .select("center", "apart", "class", "token"))
    return prefix.join(members, ["center", "class"])


def links(sets: DataFrame, cfg: Join) -> DataFrame:
    """(a, b): linked pairs of classes whose components are the components of all links."""
    lists = written(adaptive_prefixes(sets, cfg), "lists")
    center = lists.groupBy("token").agg(F.max(F.struct("typical", "class")).alias("c"), F.count(F.lit(1)).alias("size"))
    center = center.where("size > 1").select("token", F.col("c.class").alias("center"))
    placed = written(lists.drop("typical").join(center, "token"), "placed")
    star = placed.where("class <> center").select(F.col("class").alias("b"), F.col("center").alias("a")).distinct()
    tried = written(overlaps(star, sets), "stars")
    first = tried.where(_links(F.col("shared"), F.col("n_a"), F.col("n_b"), cfg)).select("a", "b")

    group = components(first).withColumnRenamed("node", "class")
    known = tried.select(F.col("a").alias("center"), F.col("b").alias("class"), "shared")
    members = (placed.select("center", "class", "n", "held", "matches").distinct()
               .join(known, ["center", "class"], "left").join(group, "class", "left")
               .select("center", "class", "n", "matches", F.coalesce("component", "class").alias("component"),
                       # What it shares with the center, and what it shares with others only.
                       F.coalesce("shared", "n").alias("inner"), (F.col("held") - F.coalesce("shared", "held")).alias("outer")))
    home = members.where("class = center").select("center", F.col("component").alias("home"))
    members = written(members.join(home, "center").withColumn("kind", F.struct("n", "inner", "outer")), "members")
    rest = written(rest_lists(members, kind_needs(members, cfg), sets), "rest")
    x, y = rest.where("component <> home").alias("x"), rest.alias("y")
    pairs = (x.join(y, ["center", "apart", "token"])
             .where((F.col("x.component") != F.col("y.component"))
                    & ((F.col("y.component") == F.col("y.home")) | (F.col("x.class") < F.col("y.class")))
                    & _kinds_may_link("x.kind", "y.kind", cfg))
             .select(F.least("x.class", "y.class").alias("a"), F.greatest("x.class", "y.class").alias("b"),
                     F.least("x.matches", "y.matches").alias("needed")).distinct())
    done = tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    prefixes = placed.groupBy("class").agg(F.collect_list("token").alias("prefix"))
    side = lambda c: prefixes.select(F.col("class").alias(c), F.col("prefix").alias(f"prefix_{c}"))
    met = (pairs.join(done, ["a", "b"], "left_anti").join(side("a"), "a").join(side("b"), "b")
           .where(F.size(F.array_intersect("prefix_a", "prefix_b")) >= F.col("needed")).select("a", "b"))
    more = overlaps(met, sets).where(_links(F.col("shared"), F.col("n_a"), F.col("n_b"), cfg)).select("a", "b")
    return first.union(written(more, "rest-links"))


def near_duplicates(docs: DataFrame, cfg: Join = Join()) -> DataFrame:
    """(doc_id, k, n_shingles, class, component_id, first_k) for every row of ``docs`` (doc_id, text).

    ``component_id`` is the smallest doc_id of the document's component.  ``k`` is a hash of
    (doc_id, text) and ``first_k`` the k of the component's first row in the order of (doc_id, k).
    """
    table = written(document_table(docs, cfg), "classes")
    sharing = written(sharing_classes(table, cfg), "sharing")
    sets = written(shingle_sets(docs, sharing, cfg), "sets")
    group = components(links(sets, cfg)).withColumnRenamed("node", "class")
    rows = table.where("n_shingles >= 0").select("doc_id", "k", "n_shingles", "class")
    rows = rows.join(group, "class", "left").withColumn("component", F.coalesce("component", "class"))
    least = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "k"))
    named = rows.where("component is not null").groupBy("component").agg(least.alias("first"))
    out = rows.join(named, "component", "left")
    alone = F.col("first").isNull()
    return out.select(
        "doc_id", "k", "n_shingles", "class",
        F.when(alone, F.col("doc_id")).otherwise(F.col("first.doc_id")).alias("component_id"),
        F.when(alone, F.col("k")).otherwise(F.col("first.k")).alias("first_k"))


def one_of_each(docs: DataFrame, cfg: Join = Join()) -> DataFrame:
    """The rows of ``docs`` that come first in their component, one for each (doc_id, text)."""
    first = near_duplicates(docs.select("doc_id", "text"), cfg).where("k = first_k").select(F.col("k").alias("__k")).distinct()
    kept = docs.withColumn("__k", F.xxhash64("doc_id", "text")).join(first, "__k", "left_semi")
    return kept.dropDuplicates(["__k"]).select(*docs.columns)
