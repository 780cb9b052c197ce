"""Hard negatives by dual-tree search over anchors and candidates, by exact integer inner products.

1. Vectors become integers, are written once with a row number, and are dealt by label and by nearest
   centre (centres from a bounded sample) into blocks of at most about `BLOCK`; a hot label or cell is many
   blocks.  Each block is one row: its vectors in the order of a balanced tree, halved by label and then
   along the axis of greatest spread, with the nodes' centres, radii and labels.
2. Anchors are taken `CHUNK` at a time, so their number doesn't matter.  A chunk's tree, made the same way
   with leaves of `FEW`, and each anchor's bounds are broadcast (a bounded size).  Every task walks the chunk's tree and each of
   its blocks' trees together.  The inner products of a pair of nodes lie in centre . centre +- (|a| rb +
   |b| ra + ra rb); where that interval, or the labels, leave nothing for any anchor of the node, all of
   its anchors are dropped for all of the other node at once.  Pairs of leaves are scored exactly.
3. First walk: each anchor's best `k` rows of its label (its bound is the k-th best so far, to begin with
   that in a sample).  Second walk: the best `per` rows of other labels in each positive's range of scores
   (bounds: the range's upper end, and its lower end or the last of the best so far).  Each task gives its
   best; a window over those few ranks them.

Scores are sums of integer products without rounding: in single precision where lengths say that they stay
below 2**24, in double below 2**53, else in 64-bit integers.  Bounds are widened by more than their
rounding.  Nothing but work depends on samples, trees or bounds.

No part is taken by rows whose id, label or vector is null, that hold a null or non-finite component, or
whose integers have a length of 2**28 or more (scores might not be longs).  A shorter vector counts as one
that ends in zeros.  Rows that repeat an id are rows of their own.  Anchors without positives, and pairs
without negatives, give no rows.  Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, written

BLOCK, LEAF, CHUNK, FEW, SAMPLE, MOST_CELLS, MOST_LABELS = 4096, 64, 16_384, 8, 4096, 256, 64

#: Hits that are held before they are cut to the best, and scores worked out at once.
HITS, SCORES = 1 << 21, 1 << 22

LONGEST = float(1 << 56)  # squared


def usable(rows: DataFrame, label: Column, vec_id: str = "vec_id", embedding: str = "embedding", scale: float = 256.0) -> DataFrame:
    """vec_id, label and vec (array of longs: scaled, floored) of the rows that take part."""
    x = F.transform(F.col(embedding), lambda v: F.floor(v.cast("double") * scale))
    ok = F.forall(embedding, lambda v: v.isNotNull() & (F.abs(v.cast("double")) < float(1 << 53)))
    long = F.aggregate("vec", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double"))
    rows = rows.where(F.col(vec_id).isNotNull() & label.isNotNull() & F.coalesce(ok, F.lit(False)))
    return rows.select(F.col(vec_id).cast("long").alias("vec_id"), label.cast("long").alias("label"), x.alias("vec")).where(long < LONGEST)


def matrix(vectors: pa.ChunkedArray | pa.Array, width: int) -> np.ndarray:
    """Lists as rows of a matrix; shorter ones end in zeros."""
    flat = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    size = np.diff(flat.offsets.to_numpy())
    out = np.zeros((len(flat), width), np.int64)
    at = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(np.arange(len(flat)), size), at] = flat.flatten().to_numpy()
    return out


def kind(x: np.ndarray) -> type:
    most = np.abs(x).max(initial=0)
    return np.int16 if most < 1 << 15 else np.int32 if most < 1 << 31 else np.int64


class Tree:
    """A balanced binary tree over rows: node i has children 2 i + 1 and 2 i + 2, its rows are first[i]:first[i] + size[i] of `order`."""

    def __init__(self, x: np.ndarray, label: np.ndarray, leaf: int = LEAF):
        depth = max(0, int(np.ceil(np.log2(max(1, len(x)) / leaf))))
        nodes = (2 << depth) - 1
        self.inner = nodes // 2
        self.order = np.arange(len(x))
        self.first, self.size = np.zeros((2, nodes), np.int64)
        self.size[0] = len(x)
        self.centre, self.radius = np.zeros((nodes, x.shape[1])), np.zeros(nodes)
        self.low, self.high = np.zeros((2, nodes), np.int64)
        for i in range(nodes):
            a, n = self.first[i], self.size[i]
            mine = self.order[a : a + n]
            y, labels = x[mine].astype(np.float64), label[mine]
            self.low[i], self.high[i] = labels.min(initial=np.iinfo(np.int64).max), labels.max(initial=np.iinfo(np.int64).min)
            if n:
                self.centre[i] = y.mean(0)
                self.radius[i] = np.sqrt(((y - self.centre[i]) ** 2).sum(1).max())
            if i < self.inner:
                along = labels if self.low[i] < self.high[i] else y[:, int(np.ptp(y, axis=0).argmax())] if n and x.shape[1] else labels
                self.order[a : a + n] = mine[np.argsort(along, kind="stable")]
                self.first[2 * i + 1], self.size[2 * i + 1] = a, n // 2
                self.first[2 * i + 2], self.size[2 * i + 2] = a + n // 2, n - n // 2
        self.length = np.sqrt((self.centre**2).sum(1))
        self.radius = self.radius * (1 + 1e-9) + 1e-9 * self.length  # more than rounding


class Side:
    """Rows in their tree's order: integers, row numbers, ids and labels."""

    def __init__(self, rows: pa.Table, width: int, leaf: int = LEAF):
        x, label = matrix(rows["vec"], width), rows["label"].to_numpy()
        self.tree = Tree(x, label, leaf)
        at = self.tree.order
        self.x = x[at].astype(kind(x))
        self.row, self.id, self.label = rows["row"].to_numpy()[at], rows["vec_id"].to_numpy()[at], label[at]
        self.long = float(np.sqrt((self.x.astype(np.float64) ** 2).sum(1).max(initial=0.0)))


def dots(a: np.ndarray, b: np.ndarray, longest: float) -> np.ndarray:
    """Exact inner products of rows whose lengths multiply to no more than `longest`."""
    how = np.float32 if longest < 1 << 24 else np.float64 if longest < 1 << 53 else np.int64
    return a.astype(how) @ b.astype(how).T


class Best:
    """The best `k` hits of each of n slots: score falling, then id; `bar` is the k-th best score, or the floor."""

    def __init__(self, n: int, k: int, floor: np.ndarray):
        self.n, self.k, self.bar = n, k, floor.copy()
        self.parts, self.size = [], 0

    def add(self, slot: np.ndarray, score: np.ndarray, id_: np.ndarray) -> None:
        self.parts.append((slot, score, id_))
        self.size += len(slot)
        if self.size > HITS:
            self.cut()

    def cut(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Only the best stay."""
        if not self.parts:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        slot, score, id_ = map(np.concatenate, zip(*self.parts, strict=True))
        order = np.lexsort((id_, -score, slot))
        slot, score, id_ = slot[order], score[order], id_[order]
        rank = np.arange(len(slot)) - np.searchsorted(slot, slot)
        last = rank == self.k - 1
        self.bar[slot[last]] = np.maximum(self.bar[slot[last]], score[last])
        keep = rank < self.k
        self.parts = [(slot[keep], score[keep], id_[keep])]
        self.size = int(keep.sum())
        return self.parts[0]


class Walk:
    """What a walk looks for.  Slots are the `wide` searches of each anchor of the chunk, in the tree's order."""

    def __init__(self, anchors: Side, same: bool, k: int, floor: np.ndarray, top: np.ndarray):
        self.anchors, self.same, self.k, self.floor, self.top = anchors, same, k, floor, top  # floor and top: anchors x wide

    def begin(self) -> Walk:
        self.best = Best(self.floor.size, self.k, self.floor.ravel())
        self.scored = self.all = 0
        return self

    def spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Of each node of the anchors: the least bar and the greatest top."""
        bar = self.best.bar.reshape(self.floor.shape).min(1) if self.floor.size else np.zeros(0, np.int64)
        top = self.top.max(1) if self.floor.size else np.zeros(0, np.int64)
        tree = self.anchors.tree
        low, high = np.full(len(tree.size), np.iinfo(np.int64).max), np.full(len(tree.size), np.iinfo(np.int64).min)
        for i in range(tree.inner, len(tree.size)):
            rows = slice(tree.first[i], tree.first[i] + tree.size[i])
            low[i], high[i] = bar[rows].min(initial=low[i]), top[rows].max(initial=high[i])
        for i in range(tree.inner - 1, -1, -1):
            low[i], high[i] = min(low[2 * i + 1], low[2 * i + 2]), max(high[2 * i + 1], high[2 * i + 2])
        return low.astype(np.float64), high.astype(np.float64)

    def pairs(self, block: Side) -> Iterator[tuple[int, np.ndarray]]:
        """Leaves of the block, each with the anchors' leaves that it must be scored with."""
        a, b = self.anchors.tree, block.tree
        bar, top = self.spans()
        middles = a.centre @ b.centre.T
        i, j = np.zeros((2, 1), np.int64)
        leaves: list[tuple[np.ndarray, np.ndarray]] = []
        while len(i):
            mid = middles[i, j]
            off = a.length[i] * b.radius[j] + b.length[j] * a.radius[i] + a.radius[i] * b.radius[j] + 1e-9 * (1 + np.abs(mid))
            ok = (mid + off >= bar[i]) & (mid - off <= top[i]) & (a.size[i] > 0) & (b.size[j] > 0)
            if self.same:
                ok &= (a.low[i] <= b.high[j]) & (b.low[j] <= a.high[i])
            else:
                ok &= ~((a.low[i] == a.high[i]) & (b.low[j] == b.high[j]) & (a.low[i] == b.low[j]))
            i, j = i[ok], j[ok]
            end = (i >= a.inner) & (j >= b.inner)
            leaves.append((i[end], j[end]))
            i, j = i[~end], j[~end]
            left = (j >= b.inner) | ((i < a.inner) & (a.radius[i] >= b.radius[j]))  # the wider node is opened
            i = np.concatenate((2 * i[left] + 1, 2 * i[left] + 2, i[~left], i[~left]))
            j = np.concatenate((j[left], j[left], 2 * j[~left] + 1, 2 * j[~left] + 2))
        i, j = map(np.concatenate, zip(*leaves, strict=True))
        order = np.lexsort((i, j))
        i, j = i[order], j[order]
        for leaf in np.unique(j):
            yield int(leaf), i[slice(*np.searchsorted(j, (leaf, leaf + 1)))]

    def visit(self, block: Side) -> None:
        """Scores what the two trees leave."""
        mine, wide = self.anchors, self.floor.shape[1]
        self.all += len(mine.x) * len(block.x)
        for leaf, nodes in self.pairs(block):
            there = slice(block.tree.first[leaf], block.tree.first[leaf] + block.tree.size[leaf])
            first, size = mine.tree.first[nodes], mine.tree.size[nodes]
            rows = np.repeat(first - np.cumsum(size) + size, size) + np.arange(int(size.sum()))
            y, label = block.x[there], block.label[there]
            for some in np.array_split(rows, max(1, -(-len(rows) * len(y) // SCORES))):
                score = dots(mine.x[some], y, mine.long * block.long)
                self.scored += score.size
                bar = self.best.bar.reshape(-1, wide)[some]
                at, to = np.nonzero((score >= bar.min(1)[:, None]) & (score <= self.top[some].max(1)[:, None]))
                ok = (label[to] == mine.label[some][at]) == self.same
                if self.same:
                    ok &= block.row[there][to] != mine.row[some][at]
                at, to = at[ok], to[ok]
                got = score[at, to].astype(np.int64)
                for s in range(wide):
                    fits = (got >= bar[at, s]) & (got <= self.top[some[at], s])
                    self.best.add(some[at[fits]] * wide + s, got[fits], block.id[there][to[fits]])
        self.best.cut()


def centres(x: np.ndarray, cells: int) -> np.ndarray:
    """Centres of `cells` leaves of a tree over x (a power of two)."""
    tree = Tree(x, np.zeros(len(x), np.int64), max(1, -(-len(x) // cells)))
    return tree.centre[tree.inner :][tree.size[tree.inner :] > 0]


def _blocks(rows: DataFrame, n: int, width: int, block: int) -> DataFrame:
    """block, rows (binary): the candidates as packed blocks with their trees."""
    spark = rows.sparkSession
    labels = rows.select(F.pmod(F.xxhash64("label"), F.lit(MOST_LABELS)).alias("l")).distinct().count()
    cells = 1 << max(0, int(np.log2(max(1, min(MOST_CELLS, n // (block * max(1, labels)))))))
    some = rows.where(F.pmod(F.xxhash64("row"), F.lit(1 << 20)) < max(1, min(1.0, SAMPLE / max(1, n)) * (1 << 20))).orderBy("row").limit(2 * SAMPLE).select("vec").toArrow()
    middle = centres(matrix(some["vec"], width).astype(np.float64), cells) if cells > 1 and len(some) else np.zeros((1, width))
    share = spark.sparkContext.broadcast(middle)

    def cell(batches):
        mid = share.value
        half = (mid**2).sum(1) / 2
        for batch in batches:
            x = matrix(batch.column(3), width).astype(np.float64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array((x @ mid.T - half).argmax(1).astype(np.int32))], [*batch.schema.names, "cell"])

    placed = rows.select("row", "vec_id", "label", "vec").mapInArrow(lean(cell), "row long, vec_id long, label long, vec array<long>, cell int")
    placed = written(placed.withColumn("part", F.pmod(F.xxhash64("label"), F.lit(MOST_LABELS)).cast("int") * MOST_CELLS + F.col("cell")).drop("cell"), "cells")
    count = F.broadcast(placed.groupBy("part").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks")))  # MOST_LABELS * MOST_CELLS rows at most
    dealt = placed.join(count, "part").withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))

    def pack(rows: pa.Table) -> pa.Table:
        import pickle

        return pa.table({"body": [pickle.dumps(Side(rows, width), 5)]})

    return written(dealt.groupBy("part", "block").applyInArrow(pack, "body binary"), "blocks")


def _run(blocks: DataFrame, walk: Walk, told: list | None = None) -> DataFrame:
    """slot, score, id: each task's best of every slot of a walk."""
    share = blocks.sparkSession.sparkContext.broadcast(walk)

    def run(batches):
        import pickle

        walk = share.value.begin()
        for batch in batches:
            for body in batch.column(0):
                walk.visit(pickle.loads(body.as_buffer()))
        slot, score, id_ = walk.best.cut()
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(score), pa.array(id_), pa.array(np.zeros(len(slot), np.int64))], ["slot", "score", "id", "pairs"])
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.int64()) for x in (-1, walk.scored, walk.all, 1)], ["slot", "score", "id", "pairs"])

    found = written(blocks.mapInArrow(lean(run), "slot long, score long, id long, pairs long"), "hits")
    if told is not None:
        told += [tuple(r) for r in found.where("pairs = 1").agg(F.sum("score"), F.sum("id")).collect()]
    rank = F.row_number().over(Window.partitionBy("slot").orderBy(F.desc("score"), "id"))
    return found.where("slot >= 0").select("slot", "score", "id", rank.alias("rank")).where(F.col("rank") <= walk.k)


def mine(rows: DataFrame, anchors: Column, k: int = 5, per: int = 3, low: int = 50, high: int = 95, block: int = BLOCK, chunk: int = CHUNK, scored: Callable[[str, float], None] | None = None) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of rows (vec_id, label, vec) as `usable` gives them.

    Of each of the first `k` positives, the first `per` rows of another label whose score is from `low` to `high` percent of
    the positive's.  `scored` is told the share of all pairs that was scored, for each walk.
    """
    spark = rows.sparkSession
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", "vec", anchors.alias("anchor")), "rows")
    n, asked, width = rows.agg(F.count("*"), F.count_if("anchor"), F.max(F.size("vec"))).head()
    if not asked:
        return spark.createDataFrame([], schema)
    blocks = _blocks(rows, n, width, block)
    seeds = rows.where(F.pmod(F.xxhash64("row", F.lit(1)), F.lit(1 << 20)) < max(1, min(1.0, SAMPLE / n) * (1 << 20))).orderBy("row").limit(2 * SAMPLE).toArrow()
    seeds = Side(seeds, width)
    chunks = -(-asked // chunk)
    mine_ = written(rows.where("anchor").withColumn("chunk", F.pmod(F.xxhash64("row", F.lit(2)), F.lit(chunks)).cast("int")), "anchors")
    out = []
    least, most = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    for c in range(chunks):  # one for each CHUNK anchors
        got = mine_.where(F.col("chunk") == c).toArrow()
        if not len(got):
            continue
        side = Side(got, width, FEW)
        said: list = []
        walk = _seeded(Walk(side, True, k, np.full((len(got), 1), least), np.full((len(got), 1), most)), seeds)
        positives = written(_run(blocks, walk, said if scored else None), "positives")
        best = positives.toArrow()  # k rows an anchor of the chunk
        slot, score, at = best["slot"].to_numpy(), best["score"].to_numpy(), best["rank"].to_numpy() - 1
        floor, top = np.full((len(got), k), most), np.full((len(got), k), least)  # nothing fits where there is no positive
        floor[slot, at], top[slot, at] = -((-low * score) // 100), (high * score) // 100
        walk = _seeded(Walk(side, False, per, floor, top), seeds)
        negatives = _run(blocks, walk, said if scored else None)
        ids = spark.createDataFrame(pa.table({"slot": np.arange(len(got)), "anchor_id": side.id}))
        first = positives.join(ids, "slot").select("anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"), (F.col("slot") * k + F.col("rank") - 1).alias("slot"))
        out.append(written(first.join(negatives.select("slot", "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score")), "slot"), "negatives").drop("slot"))
        if scored:
            for name, (some, all_) in zip(("positives", "negatives"), said, strict=True):
                scored(name, some / max(1, all_))
    result = out[0]
    for more in out[1:]:
        result = result.unionByName(more)
    return result.select(*[x.split()[0] for x in schema.split(", ")])


def _seeded(walk: Walk, seeds: Side) -> Walk:
    """The walk with bars as high as a sample lets them be."""
    walk.begin().visit(seeds)
    walk.floor = walk.best.bar.reshape(walk.floor.shape)
    del walk.best
    return walk


def hard_negatives(embeddings: DataFrame, every: int = 50, noisy: int = 7, labels: int = 10, **how) -> DataFrame:
    """`mine` over a table of embeddings: anchors are ids divisible by `every`; where an id is divisible by `noisy`, its label moves on by one."""
    label = F.when(F.col("vec_id") % noisy == 0, (F.col("label") + 1) % labels).otherwise(F.col("label"))
    return mine(usable(embeddings, label), F.col("vec_id") % every == 0, **how)


ORACLE = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS vec
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x::DOUBLE)]) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same, CAST(list_dot_product(a.vec, b.vec) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
n AS (
  SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id) AS INTEGER) AS rank
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3"""
