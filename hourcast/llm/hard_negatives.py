"""Hard negatives by rotated one-bit codes.

Vectors become whole numbers, so scores (inner products) are exact.  A vector is rotated by a
fixed random rotation and kept as the signs of its entries, one bit each, together with its length
and its alignment: the cosine of the rotated vector with its own code.  An anchor is rotated as
well and its entries are rounded to 16 levels, so its product with a code is four counts of common
bits (popcounts of the levels' bit planes).  What the code leaves out of the vector is orthogonal
to the code and its length is known from the alignment, so Cauchy-Schwarz bounds what it can add to
the score: every estimate comes with an interval that holds the score for certain.  Candidates whose
interval cannot reach what is still asked for are dropped; the others are scored with whole numbers.

An anchor asks in slots, each with the range of scores that count.  First one slot for rows of its
own label: its positives.  Then one slot for each positive, for rows of other labels in the range
that the positive's score sets.  Vectors are dealt to shards by the nearest of some pivots, which
are a bounded sample (``max_pivots`` distinct vectors, those of the smallest hash); every row is
placed, and the rows of a crowded pivot are dealt on by a hash of their id, so a hot label or a
vector with very many copies is spread as well.  An anchor meets its home shard first; the kth score
found there is the floor in all other shards, and a shard whose ball (centre and radius of all its
rows) cannot reach into any slot is not visited.  Anchors travel in parts past the shard, or the
group of balls, that a task holds.

Defined results
---------------
* rows with a null id, label or vector, an empty vector, or a null or non-finite component take no part.
* a vector is compared with vectors of its own length only.
* repeated rows: each is a candidate of its own, but rows with the anchor's id are none; a repeated
  anchor id asks once, with its smallest (label, vector).  Ties in score go to the smaller id, and
  rows that tie in both are equal in the result.
* a positive with a negative score has an empty range, so no negatives; one with score 0 has 0 only.
* scores beyond 2^53 are computed with whole numbers of any size; one beyond a long is an error.
* further columns of the input are ignored; an empty table gives an empty result.
* very long vectors: a task holds one shard of ``shard_rows`` vectors and the rotation of its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourcast.llm.common import written

LEVEL_BITS = 4
# Rounding of the float64 work on rotated vectors, relative to the product of two lengths.
SLACK = 1e-9
NO_LOW, NO_HIGH = float("-inf"), float("inf")


@dataclass(frozen=True)
class Mining:
    """``shard_rows`` and ``part_anchors`` bound what meets in one task on average."""

    positives: int = 5
    negatives: int = 3
    scale: int = 256
    shard_rows: int = 16_384
    part_anchors: int = 20_000
    max_pivots: int = 4096
    ball_group: int = 8192
    # A negative's score is at least the first and at most the second hundredth of the positive's.
    low_pct: int = 50
    high_pct: int = 95


# ---------------------------------------------------------------- codes

@cache
def rotation(dim: int) -> np.ndarray:
    """The fixed random rotation of vectors of this length."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def packed(bits: np.ndarray) -> np.ndarray:
    """Rows of bits as rows of 64-bit words."""
    rows, dim = bits.shape
    wide = np.zeros((rows, -(-dim // 64) * 64), np.uint8)
    wide[:, :dim] = bits
    return np.packbits(wide, axis=1).view(np.uint64)


class Codes:
    """One-bit codes of vectors with lengths and alignments."""

    def __init__(self, vectors: np.ndarray):
        self.dim = vectors.shape[1]
        turned = vectors @ rotation(self.dim)
        self.length = np.sqrt((turned * turned).sum(1))
        self.bits = packed(turned > 0)
        self.ones = np.bitwise_count(self.bits).sum(1, dtype=np.int64)
        with np.errstate(divide="ignore", invalid="ignore"):
            align = np.abs(turned).sum(1) / (np.sqrt(self.dim) * self.length)
        self.align = np.clip(np.where(self.length > 0, align, 1.0), 0.0, 1.0)
        self.rest = np.sqrt(1.0 - self.align ** 2)

    def intervals(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(least, most) that the inner product of each coded vector with ``query`` can be."""
        turned = query @ rotation(self.dim)
        own = float(np.sqrt(turned @ turned))
        least, top = float(turned.min()), float(turned.max())
        step = (top - least) / ((1 << LEVEL_BITS) - 1) or 1.0
        levels = np.rint((turned - least) / step).astype(np.int64)
        planes = packed(((levels[None, :] >> np.arange(LEVEL_BITS)[:, None]) & 1).astype(np.uint8))
        # The rounded anchor with a code of entries +-1: 2 * (its sum over the ones) - its whole sum.
        common = np.zeros(len(self.bits), np.int64)
        for k in range(LEVEL_BITS):
            common += np.bitwise_count(self.bits & planes[k]).sum(1, dtype=np.int64) << k
        whole = self.dim * least + step * int(levels.sum())
        root = np.sqrt(self.dim)
        estimate = (2 * (least * self.ones + step * common) - whole) / root
        error = float(np.abs(turned - least - step * levels).sum()) / root + SLACK * own
        # What the code leaves out meets the part of the anchor that the code leaves out.
        sure = np.maximum(np.abs(estimate) - error, 0.0)
        spread = self.align * error + self.rest * np.sqrt(np.maximum(own * own - sure * sure, 0.0)) + SLACK * own
        middle = self.align * estimate
        return self.length * (middle - spread), self.length * (middle + spread)


# ---------------------------------------------------------------- search in a shard

class Shard:
    """The vectors of one shard and length, with their codes."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.ids, self.labels, self.vectors = ids, labels, vectors
        self.codes = Codes(vectors)
        self.largest = float(np.abs(vectors).max(initial=0.0))

    def scores(self, rows: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products; float64 holds them up to 2^53."""
        if self.largest * float(np.abs(query).max()) * len(query) < 2 ** 53:
            return (self.vectors[rows] @ query).astype(np.int64)
        whole = [int(x) for x in query.tolist()]
        return np.array([sum(int(a) * b for a, b in zip(v, whole, strict=True)) for v in self.vectors[rows].tolist()], object)

    def search(self, own: int, label: int, query: np.ndarray, slots: list[tuple[float, float]], same: bool, k: int):
        """(slot, score, id): for each slot (low, high) the k best of the rows of the anchor's label,
        or of other labels, with ties of the kth."""
        wanted = ((self.labels == label) if same else (self.labels != label)) & (self.ids != own)
        least, most = self.codes.intervals(query)
        reach = np.zeros(len(self.ids), bool)
        for low, high in slots:
            inside = wanted & (most >= low) & (least <= high)
            sure = least[inside & (least >= low) & (most <= high)]
            if len(sure) >= k:          # k rows score at least this and lie in the range
                inside &= most >= np.partition(sure, len(sure) - k)[len(sure) - k]
            reach |= inside
        rows = np.flatnonzero(reach)
        if not rows.size:
            return
        scores, ids = self.scores(rows, query), self.ids[rows]
        for slot, (low, high) in enumerate(slots):
            fits = np.flatnonzero((scores >= low) & (scores <= high))
            if len(fits) > k:
                kth = np.sort(scores[fits])[len(fits) - k]
                fits = fits[scores[fits] >= kth]
                fits = fits[np.lexsort((ids[fits], -scores[fits]))][:k]
            for i in fits.tolist():
                yield slot, int(scores[i]), int(ids[i])


def _matrix(batch: pa.RecordBatch, dim: int, column: str = "vector") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[pa.RecordBatch], pa.RecordBatch | None]]:
    """The rows that a task holds and, one after the other, the batches of anchors that come past.

    Rows come sorted by (dim, shard, part, kind): of one (dim, shard, part) those of kind 0 are
    held, those of kind 1 come past.  The end of a batch is marked by None, to hand on results.
    """
    at, held = None, []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "part", "kind")], 1)
        cuts = np.flatnonzero(np.any(keys[1:] != keys[:-1], 1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if a == b:
                continue
            *here, kind = keys[a].tolist()
            if here != at:
                at, held = here, []
            if kind == 0:
                held.append(batch.slice(a, b - a))
            elif held:
                yield held, batch.slice(a, b - a)
        yield held, None


def search_shards(vectors: DataFrame, asked: DataFrame, n_parts: int, n_tasks: int, same: bool, k: int) -> DataFrame:
    """(anchor_id, slot, score, vec_id) for each row of ``asked`` (anchor_id, label, vector, slots,
    dim, shard, part) in its shard.  A shard's rows come first in a task, then its anchors."""
    no_slots = F.array().cast("array<struct<low:double,high:double>>")
    rows = vectors.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    stream = (rows.select("dim", "shard", "part", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "label", "vector", no_slots.alias("slots"))
              .unionByName(asked.select("dim", "shard", "part", F.lit(1).alias("kind"), F.col("anchor_id").alias("id"), "label", "vector", "slots"))
              .repartition(n_tasks, "dim", "shard", "part").sortWithinPartitions("dim", "shard", "part", "kind", "id"))

    def run(batches):
        known, shard, found = None, None, []
        for held, block in _met(batches):
            if block is None:
                if found:
                    types = [pa.int64(), pa.int32(), pa.int64(), pa.int64()]
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*found, strict=True), types, strict=True)],
                                                     names=["anchor_id", "slot", "score", "vec_id"])
                found = []
                continue
            dim = block.column("dim")[0].as_py()
            if held is not known:
                known = held
                shard = Shard(*(np.concatenate([h.column(c).to_numpy() for h in held]) for c in ("id", "label")),
                              np.concatenate([_matrix(h, dim) for h in held]))
            ids, labels, values = block.column("id").to_pylist(), block.column("label").to_pylist(), _matrix(block, dim)
            slots = [[(s["low"], s["high"]) for s in row] for row in block.column("slots").to_pylist()]
            for own, label, query, ranges in zip(ids, labels, values, slots, strict=True):
                found += [(own, *hit) for hit in shard.search(own, label, query, ranges, same, k)]
    return stream.mapInArrow(run, "anchor_id long, slot int, score long, vec_id long")


# ---------------------------------------------------------------- shards and their balls

def deal(rows: DataFrame, cfg: Mining) -> DataFrame:
    """``rows`` with ``dim`` and ``shard``: the nearest pivot of their length, and a hash of the id
    where a pivot has more than ``shard_rows`` rows.  Lengths without a pivot count as one."""
    rows = rows.withColumn("dim", F.size("vector"))
    n_pivots = max(1, min(cfg.max_pivots, -(-rows.count() // cfg.shard_rows)))
    drawn = rows.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(n_pivots).collect()
    pivots: dict[int, list] = {}
    for r in drawn:
        pivots.setdefault(len(r.vector), []).append(r.vector)

    def run(batches):
        centres = {dim: np.array(v) for dim, v in pivots.items()}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            cells = np.zeros(len(dims), np.int64)
            for dim in np.unique(dims).tolist():
                if dim in centres:
                    mine = np.flatnonzero(dims == dim)
                    vectors = _matrix(batch.filter(pa.array(dims == dim)), dim)
                    half = (centres[dim] ** 2).sum(1) / 2
                    for i in range(0, len(mine), 1024):
                        cells[mine[i:i + 1024]] = np.argmax(vectors[i:i + 1024] @ centres[dim].T - half, 1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cells)], names=[*batch.schema.names, "cell"])

    placed = written(rows.mapInArrow(run, "vec_id long, label long, vector array<double>, dim int, cell long"), "placed-vectors")
    crowd = placed.groupBy("dim", "cell").agg(F.ceil(F.count(F.lit(1)) / cfg.shard_rows).alias("n_salts"))
    salt = F.pmod(F.xxhash64("vec_id"), F.col("n_salts"))
    # One row for each pivot, and one for each length without one.
    return placed.join(crowd, ["dim", "cell"]).select(
        "vec_id", "label", "vector", "dim", (F.col("cell") * F.lit(1 << 32) + salt).alias("shard"))


def shard_balls(vectors: DataFrame) -> DataFrame:
    """(dim, shard, centre, radius): every vector of the shard is within the radius of the centre."""
    entries = vectors.select("dim", "shard", F.posexplode("vector"))
    ends = entries.groupBy("dim", "shard", "pos").agg(((F.min("col") + F.max("col")) / 2).alias("c"))
    centres = ends.groupBy("dim", "shard").agg(F.transform(F.sort_array(F.collect_list(F.struct("pos", "c"))), lambda e: e["c"]).alias("centre"))
    off = F.zip_with("vector", "centre", lambda a, b: (a - b) * (a - b))
    far = F.sqrt(F.aggregate(off, F.lit(0.0), lambda total, d: total + d)) * F.lit(1 + SLACK)
    return vectors.join(centres, ["dim", "shard"]).groupBy("dim", "shard").agg(F.first("centre").alias("centre"), F.max(far).alias("radius"))


def visits(asked: DataFrame, balls: DataFrame, n_shards: int, n_parts: int, cfg: Mining) -> DataFrame:
    """(anchor_id, shard) for every shard but the home one whose ball reaches into one of the slots.

    A task holds a group of balls, and a part of the anchors comes past it."""
    n_groups = -(-n_shards // cfg.ball_group)
    group = F.pmod(F.xxhash64("shard"), F.lit(n_groups))
    every = F.sequence(F.lit(0).cast("long"), F.lit(n_groups - 1).cast("long"))
    held = balls.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(n_parts - 1))))
    no_slots = F.array().cast("array<struct<low:double,high:double>>")
    stream = (held.select("dim", group.alias("shard"), "part", F.lit(0).alias("kind"), F.col("shard").alias("id"), F.col("centre").alias("vector"),
                          "radius", no_slots.alias("slots"), F.lit(0).cast("long").alias("home"))
              .unionByName(asked.select("dim", F.explode(every).alias("g"), "part", F.lit(1).alias("kind"), F.col("anchor_id").alias("id"), "vector",
                                        F.lit(0.0).alias("radius"), "slots", F.col("shard").alias("home")).withColumnRenamed("g", "shard"))
              .repartition(n_groups * n_parts, "dim", "shard", "part").sortWithinPartitions("dim", "shard", "part", "kind", "id"))

    def run(batches):
        known, found = None, []
        for held, block in _met(batches):
            if block is None:
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], names=["anchor_id", "shard"])
                found = []
                continue
            dim = block.column("dim")[0].as_py()
            if held is not known:
                known = held
                centres = np.concatenate([_matrix(h, dim) for h in held])
                shards, radius = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in ("id", "radius"))
                sizes = np.sqrt((centres * centres).sum(1))
            ids, homes, queries = block.column("id").to_numpy(), block.column("home").to_numpy(), _matrix(block, dim)
            slots = block.column("slots").to_pylist()
            for i in range(0, len(ids), 64):
                middle = queries[i:i + 64] @ centres.T
                own = np.sqrt((queries[i:i + 64] ** 2).sum(1))[:, None]
                spread = own * (radius * (1 + SLACK) + sizes * SLACK)
                for j in range(len(middle)):
                    reach = np.zeros(len(shards), bool)
                    for s in slots[i + j]:
                        reach |= (s["low"] <= middle[j] + spread[j]) & (s["high"] >= middle[j] - spread[j])
                    reach &= shards != homes[i + j]
                    found.append((np.full(int(reach.sum()), ids[i + j]), shards[reach]))
    return stream.mapInArrow(run, "anchor_id long, shard long")


# ---------------------------------------------------------------- the operator

def whole_vectors(table: DataFrame, cfg: Mining) -> DataFrame:
    """(vec_id, label, vector) of the rows that take part; vectors as whole numbers in doubles."""
    def finite(x: Column) -> Column:
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    rows = table.where("vec_id is not null and label is not null").select(
        "vec_id", F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where((F.size("v") > 0) & F.forall("v", finite))
    return rows.select("vec_id", "label", F.transform("v", lambda x: F.floor(x * cfg.scale).cast("double")).alias("vector"))


def best(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of each slot with their rank.  A shard gives at most k of a slot."""
    order = Window.partitionBy("anchor_id", "slot").orderBy(F.desc("score"), "vec_id")
    return hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


@dataclass(frozen=True)
class Index:
    """The dealt vectors, the balls of their shards, and how many shards and parts of anchors there are."""

    vectors: DataFrame
    balls: DataFrame
    n_shards: int
    n_parts: int
    cfg: Mining


def ask_all(index: Index, asked: DataFrame, same: bool, k: int, name: str) -> DataFrame:
    """The k best of each slot of each anchor: the home shard first, then the shards still in reach."""
    n_tasks = index.n_shards * index.n_parts
    near = written(search_shards(index.vectors, asked, index.n_parts, n_tasks, same, k), f"{name}-home")
    kth = near.groupBy("anchor_id", "slot").agg(F.min("score").alias("least"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    floors = kth.groupBy("anchor_id").agg(F.map_from_entries(F.collect_list(F.struct("slot", F.col("least").cast("double")))).alias("floors"))

    def raised(slot: Column, i: Column) -> Column:
        return F.struct(F.greatest(slot["low"], F.coalesce(F.try_element_at("floors", i), slot["low"])).alias("low"), slot["high"].alias("high"))
    ahead = asked.join(floors, "anchor_id", "left").withColumn("slots", F.transform("slots", raised)).drop("floors")
    ahead = written(ahead, f"{name}-asked")
    to = visits(ahead, index.balls, index.n_shards, index.n_parts, index.cfg)
    far = search_shards(index.vectors, ahead.drop("shard").join(to, "anchor_id"), index.n_parts, n_tasks, same, k)
    return written(best(near.unionByName(far), k), f"{name}-best")


def mine(table: DataFrame, is_anchor: Column, cfg: Mining = Mining()) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) over ``table``
    (vec_id, label, embedding), for the anchors that ``is_anchor`` selects."""
    rows = written(whole_vectors(table, cfg), "labelled-vectors")
    vectors = written(deal(rows, cfg), "dealt-vectors")
    anchors = vectors.where(is_anchor).groupBy("vec_id").agg(F.min(F.struct("label", "vector", "dim", "shard")).alias("a"))
    anchors = written(anchors.select(F.col("vec_id").alias("anchor_id"), "a.label", "a.vector", "a.dim", "a.shard"), "anchors")
    n_parts = max(1, -(-anchors.count() // cfg.part_anchors))
    anchors = anchors.withColumn("part", F.pmod(F.xxhash64("anchor_id", F.lit(1)), F.lit(n_parts)).cast("int"))
    balls = written(shard_balls(vectors), "balls")
    index = Index(vectors, balls, max(1, balls.count()), n_parts, cfg)

    anything = F.array(F.struct(F.lit(NO_LOW).alias("low"), F.lit(NO_HIGH).alias("high")))
    positives = ask_all(index, anchors.withColumn("slots", anything), True, cfg.positives, "positives")
    positives = positives.select("anchor_id", (F.col("rank") - 1).alias("slot"), F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))

    # Whole numbers between the bounds: low is rounded up and high down.
    low = F.expr(f"positive_score - (positive_score div 100) * {100 - cfg.low_pct} - ((positive_score % 100) * {100 - cfg.low_pct}) div 100")
    high = F.expr(f"(positive_score div 100) * {cfg.high_pct} + ((positive_score % 100) * {cfg.high_pct}) div 100")
    wanted = F.when(F.col("positive_score") >= 0, F.struct(low.cast("double").alias("low"), high.cast("double").alias("high"))).otherwise(
        F.struct(F.lit(NO_HIGH).alias("low"), F.lit(NO_LOW).alias("high")))
    slots = positives.groupBy("anchor_id").agg(F.transform(F.sort_array(F.collect_list(F.struct("slot", wanted.alias("r")))), lambda s: s["r"]).alias("slots"))
    negatives = ask_all(index, anchors.join(slots, "anchor_id"), False, cfg.negatives, "negatives")
    return positives.join(negatives, ["anchor_id", "slot"]).select(
        "anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
