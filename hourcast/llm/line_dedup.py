"""Line dedup by winnowing, in DataFrame operations only.

A line ends at a line feed or after ``.``, ``!`` or ``?`` followed by a space (a soft line
break), so a passage is found whether it stands on lines of its own or inside a paragraph.
Lines without a character other than white space are not compared.

A repeat is a run of neighbouring lines with ``min_chars`` characters or more that stood before, in
an earlier document or earlier in its own, in the order of (doc_id, text hash, line).  All lines of
all repeats are deleted, in whatever surroundings and however short or long their lines are.

1. Each line is hashed.  The windows are the shortest runs of ``min_chars`` characters, from each line
   on and up to each line.  The smallest line hash of a window (of equal ones the first) is its
   fingerprint.  A repeat holds such windows, and the run that it equals holds the same ones with
   the same minima, so the two share a fingerprint.
2. Fingerprints are joined by hash with those that stand at two places or more.  The places of one
   fingerprint are never paired with each other, so this is linear in the occurrences, however
   common one is; they are counted with map-side partial aggregates, and the join is a plain
   equi-join whose hot partitions the adaptive planner splits.
3. A joined place is extended both ways to the windows that hold it, each known by the content of
   its lines (64 bits).  Every occurrence of a window but the first is a repeat; repeated windows that
   overlap or touch are extended into one run.  Each line of a repeat lies in a window inside it: in
   the one from its first line, or in the one up to the line itself.
4. The runs are deleted.  Lines of white space inside a deleted run go with it.

A deleted line always equals an earlier one, so the first occurrence of every line stays.

Defined results
---------------
* null or empty text: no lines, nothing deleted, text returned as it is.
* very long texts: compared whole; work and arrays grow with the number of their lines.
* equal runs: the one that comes first in the order above stays.
* rows that repeat the same doc_id and text are one document: each gets the same result.
  Rows that share a doc_id but differ in text are different documents.  A null doc_id
  is allowed and comes first.
* further columns of the input are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourcast.llm.common import written

# The first look-behind is cheap and fails at most characters.
LINE_END = r"(?<=[\n ])(?<=\n|[.!?] )"
WHITE = " \t\n\x0b\x0c\r"
# Longer than any array, and a start can be added to it.
REST = 1 << 30
# Lines looked at first for a window's end, and then; longer ones are counted in full.
FEW_LINES = 8
MORE_LINES = 32


@dataclass(frozen=True)
class Winnow:
    min_chars: int = 150


def _key(doc_id: str = "doc_id", text: str = "text") -> Column:
    return F.xxhash64(doc_id, text)


def _segments(text: Column) -> Column:
    return F.filter(F.split(text, LINE_END, -1), lambda s: s != "")


def line_table(docs: DataFrame) -> DataFrame:
    """(doc_id, k, hashes, chars, at): the compared lines of each document in order; ``at`` is a
    line's place among all segments of the text."""
    trimmed = F.transform(_segments(F.col("text")), lambda s, i: F.struct(F.btrim(s, F.lit(WHITE)).alias("line"), i.alias("at")))
    lines = F.coalesce(F.filter(trimmed, lambda x: x["line"] != ""), F.array().cast("array<struct<line:string,at:int>>"))
    made = F.transform(lines, lambda x: F.struct(F.xxhash64(x["line"]).alias("h"), F.length(x["line"]).alias("n"), x["at"].alias("at")))
    return (docs.select("doc_id", _key().alias("k"), made.alias("made"))
            .select("doc_id", "k", F.col("made.h").alias("hashes"), F.col("made.n").alias("chars"), F.col("made.at").alias("at")))


def fingerprint_table(lines: DataFrame, min_chars: int) -> DataFrame:
    """(doc_id, k, every): per document struct(fp, pos, windows) of the fingerprints in order, each with the
    windows whose minimum it is, as struct(content, a, b) of their first and last line.  ``lines`` is
    read from files, so that lambdas see stored arrays."""
    full = min_chars * REST

    # Characters in the upper bits, lines in the lower ones; lines beyond the last needed add nothing.
    # The sum is read in its last step, as an expression that is named twice in a lambda runs twice.
    def counted(i: Column, most: int) -> Column:
        lines_needed = F.aggregate(F.slice("chars", i + 1, most), F.lit(0).cast("long"),
                                   lambda s, c: F.when(s >= full, s).otherwise(s + (c.cast("long") * REST + 1)),
                                   lambda s: F.when(s >= full, (s % REST).cast("int")))
        return lines_needed + i - 1

    def near(i: Column) -> Column:
        chars = F.get("chars", i)
        found = F.when(chars >= min_chars, i)
        for j in range(1, FEW_LINES):
            chars = chars + F.get("chars", i + j)
            found = found.when(chars >= min_chars, i + j)
        return found.when(chars.isNull(), -1).otherwise(F.coalesce(counted(i, MORE_LINES), counted(i, min_chars), F.lit(-1)))

    # Last line of the window from each line on; lines near the text's end have none.
    ends = F.filter(F.transform("chars", lambda _, i: near(i)), lambda e: e >= 0)
    # Ends grow with the starts; those between two of them end the shortest run up to them at the first start.
    spans = F.flatten(F.transform("ends", lambda e, a: F.transform(
        F.sequence(e, F.greatest(e, F.coalesce(F.get("ends", a + 1), F.size("hashes")) - 1)),
        lambda b: F.struct(F.slice("hashes", a + 1, b - a + 1).alias("inside"), a.alias("a"), b.alias("b")))))
    windows = F.transform(spans, lambda w: F.struct(
        (w["a"] + F.array_position(w["inside"], F.array_min(w["inside"])).cast("int") - 1).alias("pos"),
        F.xxhash64(w["inside"]).alias("content"), w["a"].alias("a"), w["b"].alias("b")))
    # Windows move on, and their minima with them: those of one minimum stand together.
    first = F.filter(F.transform("windows", lambda w, i: F.when((i == 0) | (w["pos"] != F.get("windows", i - 1)["pos"]), i)),
                     lambda i: i.isNotNull())
    every = F.zip_with("first", F.concat(F.slice("first", 2, REST), F.array(F.size("windows"))), lambda x, y: F.struct(
        F.get("hashes", F.get("windows", x)["pos"]).alias("fp"), F.get("windows", x)["pos"].alias("pos"),
        F.transform(F.slice("windows", x + 1, y - x), lambda w: F.struct(w["content"], w["a"], w["b"])).alias("windows")))
    return (lines.select("doc_id", "k", "hashes", ends.alias("ends"))
            .select("doc_id", "k", "hashes", windows.alias("windows"))
            .select("doc_id", "k", "hashes", "windows", first.alias("first"))
            .select("doc_id", "k", every.alias("every")))


def repeated_lines(lines: DataFrame, cfg: Winnow) -> DataFrame:
    """(k, runs): for documents that have any, the runs of lines to delete, as struct(a, b) of the
    first line and the one behind the last; runs are in order and apart."""
    prints = written(fingerprint_table(lines, cfg.min_chars), "fingerprints")
    prints = prints.select("doc_id", "k", F.explode("every").alias("f")).select("f.fp", "doc_id", "k", "f.pos", "f.windows")
    # Numbers instead of a struct, so the aggregate hashes; most fingerprints stand once and end here.
    often = prints.groupBy("fp").agg(F.min("k").alias("k0"), F.max("k").alias("k1"), F.min("pos").alias("p0"), F.max("pos").alias("p1"))
    often = often.where("k0 <> k1 or p0 <> p1").select("fp")
    hits = prints.join(often, "fp").select("doc_id", "k", F.explode("windows").alias("w"))
    hits = written(hits.select("w.content", "doc_id", "k", "w.a", "w.b"), "repeated-fingerprints")
    place = F.struct("doc_id", "k", "a")
    first = hits.groupBy("content").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where(F.col("first") != F.col("last")).select("content", "first")
    later = hits.join(first, "content").where(place != F.col("first"))
    found = later.groupBy("k").agg(F.sort_array(F.collect_set(F.struct("a", "b"))).alias("found"))
    # In order of their starts the ends are in order too.
    begins = F.transform("found", lambda r, i: F.when(r["a"] <= F.get("found", i - 1)["b"] + 1, None).otherwise(r["a"]))
    stops = F.transform("found", lambda r, i: F.when(F.get("found", i + 1)["a"] <= r["b"] + 1, None).otherwise(r["b"] + 1))
    return found.select("k", F.zip_with(F.filter(begins, lambda x: x.isNotNull()), F.filter(stops, lambda x: x.isNotNull()),
                                        lambda a, b: F.struct(a.alias("a"), b.alias("b"))).alias("runs"))


def dropped_lines(docs: DataFrame, cfg: Winnow = Winnow()) -> DataFrame:
    """(doc_id, n_lines, n_dropped, dropped_chars, dropped) for every row of ``docs``; ``dropped``
    lists the deleted lines' positions among the compared lines."""
    lines = written(line_table(docs), "lines")
    counted = lines.select("doc_id", "k", F.size("chars").cast("long").alias("n_lines"), "chars")
    out = counted.join(repeated_lines(lines, cfg), "k", "left")
    places = F.flatten(F.transform("runs", lambda r: F.sequence(r["a"], r["b"] - 1)))
    gone = F.coalesce(places, F.array().cast("array<int>"))
    return out.select("doc_id", "n_lines", "chars", gone.alias("dropped")).select(
        "doc_id", "n_lines", F.size("dropped").cast("long").alias("n_dropped"),
        F.aggregate("dropped", F.lit(0).cast("long"), lambda s, i: s + F.get("chars", i)).alias("dropped_chars"), "dropped")


def line_dedup(docs: DataFrame, cfg: Winnow = Winnow()) -> DataFrame:
    """``docs`` with the later repeated runs of lines cut from ``text``, with the white space
    between their lines; other columns as they are."""
    lines = written(line_table(docs), "lines")
    places = lines.select("k", "at").dropDuplicates(["k"])
    spans = F.transform("runs", lambda r: F.struct(F.get("at", r["a"]).alias("a"), F.get("at", r["b"] - 1).alias("b")))
    cuts = repeated_lines(lines, cfg).join(places, "k").select(F.col("k").alias("__k"), spans.alias("__cuts"))
    kept = docs.withColumn("__k", _key()).join(cuts, "__k", "left")
    rest = F.filter(_segments(F.col("text")), lambda s, i: ~F.exists("__cuts", lambda r: (r["a"] <= i) & (i <= r["b"])))
    cut = F.when(F.col("__cuts").isNotNull(), F.array_join(rest, "")).otherwise(F.col("text"))
    return kept.withColumn("text", cut).select(*docs.columns)
