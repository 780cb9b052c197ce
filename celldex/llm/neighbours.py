"""Approximate nearest neighbours by learned partitions, for the largest inner product.

1. Fit, from a bounded sample (`SAMPLE` vectors drawn by a hash of the id): its graph of nearest
   neighbours is cut into balanced parts, by halving along main directions and then moving nodes to the
   part of most of their neighbours while sizes allow.  A small network learns, from a vector, the shares
   of its neighbours in each part.  There are as many parts as keep them near `PART` vectors.  Up to
   `MOST_PARTS` are fitted on the driver; if it takes more, each part is cut again the same way, from a
   sample of its own vectors, in a task of its own.  So parts stay of one size up to PART * MOST_PARTS ** 2
   (43 million) vectors, and grow beyond; a third level isn't built.
2. Every vector is indexed in its most probable part.  Queries visit their most probable parts; all
   vectors there are compared exactly.  How many parts is what gives a recall of `AIM` to `HELD` queries
   that were compared with every vector, and of which none was learned from.
3. Parts are split into blocks of at most about `BLOCK` vectors, and their queries into blocks of
   `QUERIES`, by a hash of the id, so a part of a third of all vectors is many small groups.  Each
   group gives its queries' best `k`; a window over the few lists of a query ranks them.
4. Queries that found less than k, with more to be found, visit all parts.

Vectors that are null, zero, hold null or non-finite components, have no id, or aren't as long as most
take no part.  Rows that repeat an id are one vector, the least.  Ties go to the smaller id.  Queries
with no other vector give no rows.  Scores are sums of products in double precision.  Other columns are
not read.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import lean, written

SAMPLE, GRAPH, PART, MOST_PARTS, BLOCK, QUERIES, AIM, HELD = 6000, 12, 3000, 120, 16_384, 4096, 0.95, 256
HIDDEN, EPOCHS, SALT = 128, 30, 77


def usable(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and vec (array of doubles) of the vectors that take part; only rows of repeated ids are shuffled."""
    x = F.transform(F.col(embedding), lambda v: v.cast("double"))
    rows = vectors.where(F.col(vec_id).isNotNull() & F.col(embedding).isNotNull()).select(F.col(vec_id).cast("long").alias("vec_id"), x.alias("vec"))
    finite = F.forall("vec", lambda v: v.isNotNull() & (F.abs(v) < float("inf")))
    rows = rows.where(F.coalesce(finite, F.lit(False)) & F.exists("vec", lambda v: v != 0))
    size = rows.groupBy(F.size("vec").alias("size")).count().orderBy(F.desc("count"), "size").head()
    rows = rows.where(F.size("vec") == (size["size"] if size else 0))
    again = rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1").select("vec_id")
    if again.isEmpty():
        return rows
    return rows.join(again, "vec_id", "left_anti").unionByName(rows.join(again, "vec_id", "left_semi").groupBy("vec_id").agg(F.min("vec").alias("vec")))


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    out = np.empty((len(x), min(k, max(0, len(x) - 1))), np.int64)
    for a in range(0, len(x), 1000):
        s = x[a : a + 1000] @ x.T
        s[np.arange(len(s)), np.arange(a, a + len(s))] = -np.inf
        out[a : a + 1000] = np.argpartition(-s, out.shape[1] - 1, axis=1)[:, : out.shape[1]] if out.shape[1] else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 8, slack: float = 1.1) -> np.ndarray:
    part = np.zeros(len(x), np.int64)
    todo = [(np.arange(len(x)), 0, parts)]
    while todo:
        at, low, n = todo.pop()
        if n == 1 or len(at) < 2:
            part[at] = low
            continue
        c = x[at] - x[at].mean(0)
        axis = np.linalg.svd(c, full_matrices=False)[2][0]
        order = at[np.argsort(c @ axis, kind="stable")]
        half, cut = n // 2, len(at) * (n // 2) // n
        todo += [(order[:cut], low, half), (order[cut:], low + half, n - half)]
    size = np.bincount(part, minlength=parts)
    most = int(np.ceil(slack * len(x) / parts))
    both = [[] for _ in x]
    for i, row in enumerate(graph.tolist()):
        both[i] += row
        for j in row:
            both[j].append(i)
    order = np.random.default_rng(0)
    for _ in range(rounds):
        moved = 0
        for i in order.permutation(len(x)):
            votes = np.bincount(part[both[i]], minlength=parts)
            votes[size >= most] = -1
            best = int(votes.argmax())
            if votes[best] > np.sum(part[both[i]] == part[i]) and best != part[i]:
                size[part[i]] -= 1
                size[best] += 1
                part[i] = best
                moved += 1
        if not moved:
            break
    return part


class Router:
    """A network with one hidden layer, from vectors to log odds of parts."""

    def __init__(self, width: int, parts: int, seed: int = 0):
        r = np.random.default_rng(seed)
        self.p = [r.normal(0, (2 / width) ** 0.5, (width, HIDDEN)), np.zeros(HIDDEN), r.normal(0, 0.1, (HIDDEN, parts)), np.zeros(parts)]

    def __call__(self, x: np.ndarray) -> np.ndarray:
        a, b, c, d = self.p
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) * np.sqrt(x.shape[1])
        return np.maximum(x @ a + b, 0) @ c + d

    def train(self, x: np.ndarray, target: np.ndarray, rate: float = 0.003, batch: int = 128) -> Router:
        x = x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300) * np.sqrt(x.shape[1])
        r, m, v, step = np.random.default_rng(1), [0] * 4, [0] * 4, 0
        for _ in range(EPOCHS):
            order = r.permutation(len(x))
            for at in range(0, len(x), batch):
                i = order[at : at + batch]
                a, b, c, d = self.p
                h = np.maximum(x[i] @ a + b, 0)
                z = h @ c + d
                q = np.exp(z - z.max(1, keepdims=True))
                q = (q / q.sum(1, keepdims=True) - target[i]) / len(i)
                back = (q @ c.T) * (h > 0)
                step += 1
                for k, g in enumerate((x[i].T @ back, back.sum(0), h.T @ q, q.sum(0))):
                    m[k] = 0.9 * m[k] + 0.1 * g
                    v[k] = 0.999 * v[k] + 0.001 * g * g
                    self.p[k] = self.p[k] - rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)
        return self


def fit(x: np.ndarray, parts: int) -> Router:
    """A router to about `parts` balanced parts of the graph of x."""
    x = np.unique(x, axis=0)
    parts = max(1, min(parts, len(x) // 50 or 1, MOST_PARTS))
    if parts == 1:
        return Router(x.shape[1], 1)
    graph = neighbour_graph(x, GRAPH)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    np.add.at(target, (np.arange(len(x)), part), 1.0)
    np.add.at(target, (np.repeat(np.arange(len(x)), graph.shape[1]), part[graph.ravel()]), 1.0)
    return Router(x.shape[1], parts).train(x, target / target.sum(1, keepdims=True))


def _log_shares(z: np.ndarray) -> np.ndarray:
    z = z - z.max(1, keepdims=True)
    return z - np.log(np.exp(z).sum(1, keepdims=True))


class Tree:
    """Routers: the root's to parts, and each part's to its leaves; a part without one is a leaf."""

    def __init__(self, root: Router, inner: dict[int, Router]):
        self.root, self.inner = root, inner
        sizes = [len(inner[p].p[3]) if p in inner else 1 for p in range(len(root.p[3]))]
        self.first = np.concatenate(([0], np.cumsum(sizes)))  # of each part's leaves
        self.leaves = int(self.first[-1])

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector: its most probable part's most probable one."""
        part = self.root(x).argmax(1)
        leaf = self.first[part]
        for p in np.intersect1d(part, list(self.inner)):
            mine = part == p
            leaf[mine] += self.inner[p](x[mine]).argmax(1)
        return leaf

    def order(self, x: np.ndarray) -> np.ndarray:
        """All leaves by falling probability, for each vector."""
        outer = _log_shares(self.root(x))
        odds = np.repeat(outer, np.diff(self.first), axis=1)
        for p, router in self.inner.items():
            odds[:, self.first[p] : self.first[p + 1]] += _log_shares(router(x))
        return np.argsort(-odds, axis=1, kind="stable")


def _draw(share: float | Column, salt: int = 0) -> Column:
    """Whether a hash of the id falls in a share of its range."""
    return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(1 << 20)) / float(1 << 20) < share


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def grow(vectors: DataFrame, n: int, part: int = PART, sample: int = SAMPLE) -> Tree:
    """The tree of routers for n vectors (vec_id, vec) in leaves of about `part`."""
    spark = vectors.sparkSession
    train = vectors.where(~_draw(min(0.5, HELD / max(1, n)), SALT)) if n > 4 * HELD else vectors
    got = train.where(_draw(min(1.0, sample / n))).orderBy("vec_id").limit(2 * sample).toArrow()
    got = got if len(got) else vectors.limit(1).toArrow()
    leaves = -(-n // part)
    root = fit(_matrix(got["vec"]), leaves if leaves <= MOST_PARTS else max(2, min(MOST_PARTS, int(np.ceil(np.sqrt(leaves))))))
    if leaves <= MOST_PARTS or len(root.p[3]) < 2:
        return Tree(root, {})
    share = spark.sparkContext.broadcast(root)

    def split(batches):
        for batch in batches:
            if len(batch):
                yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(share.value(_matrix(batch.column(1))).argmax(1).astype(np.int32))], ["vec_id", "vec", "part"])

    placed = written(train.select("vec_id", "vec").mapInArrow(lean(split), "vec_id long, vec array<double>, part int"), "split")
    sizes = F.broadcast(placed.groupBy("part").agg(F.count("*").alias("size")))  # MOST_PARTS rows at most
    some = placed.join(sizes, "part").where((F.col("size") > 2 * part) & _draw(sample / F.col("size"), 1))

    def one(key: tuple, rows: pa.Table) -> pa.Table:
        x = _matrix(rows["vec"])[np.argsort(rows["vec_id"].to_numpy())][: 2 * sample]
        return pa.table({"part": pa.array([key[0].as_py()], pa.int32()), "model": [pickle.dumps(fit(x, -(-rows["size"][0].as_py() // part)))]})

    models = some.groupBy("part").applyInArrow(one, "part int, model binary").collect()
    return Tree(root, {r["part"]: m for r in models if len((m := pickle.loads(r["model"])).p[3]) > 1})


def exact(vectors: DataFrame, queries: pa.Table, k: int) -> DataFrame:
    """query_id, vec_id, score: the k nearest among all vectors of a bounded number of queries; each batch gives its best k."""
    share = vectors.sparkSession.sparkContext.broadcast((queries["vec_id"].to_numpy(), _matrix(queries["vec"])))

    def run(batches):
        ids, q = share.value
        for batch in batches:
            if len(batch):
                names = batch.column(0).to_numpy()
                s = q @ _matrix(batch.column(1)).T
                s[ids[:, None] == names] = -np.inf
                top = np.argpartition(-s, min(k, s.shape[1]) - 1, axis=1)[:, :k]
                score = np.take_along_axis(s, top, 1).ravel()
                ok = np.isfinite(score)
                yield pa.RecordBatch.from_arrays([pa.array(np.repeat(ids, top.shape[1])[ok]), pa.array(names[top.ravel()][ok]), pa.array(score[ok])], ["query_id", "vec_id", "score"])

    found = vectors.select("vec_id", "vec").mapInArrow(lean(run), "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).drop("rank")


def visits(vectors: DataFrame, tree: Tree, n: int, k: int, aim: float = AIM) -> int:
    """How many leaves a query must visit for a recall of `aim`, by held-out queries and all vectors."""
    held = vectors.where(_draw(min(0.5, HELD / max(1, n)), SALT)).orderBy("vec_id").limit(2 * HELD).toArrow()
    if tree.leaves == 1 or not len(held):
        return tree.leaves
    near = written(exact(vectors, held, k), "near")
    where = near.join(vectors.select("vec_id", "vec"), "vec_id").select("query_id", "vec").toArrow()  # HELD * k rows
    if not len(where):
        return tree.leaves
    row = np.searchsorted(held["vec_id"].to_numpy(), where["query_id"].to_numpy())
    place = np.argsort(tree.order(_matrix(held["vec"])), axis=1)  # of each leaf among a query's
    at = place[row, tree.place(_matrix(where["vec"]))]
    recall = np.searchsorted(np.sort(at), np.arange(tree.leaves), side="right") / len(at)
    return int(np.argmax(recall >= min(aim, recall[-1]))) + 1


def search(placed: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each query (id, body, part) in each of its parts' blocks of vectors (id, body, part)."""
    blocks = placed.groupBy("part").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks"))
    groups = asked.groupBy("part").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("groups"))
    size = F.broadcast(written(blocks.join(groups, "part"), "parts"))  # MOST_PARTS ** 2 rows at most
    cell = lambda mine, count: F.pmod(F.xxhash64(mine), F.col(count)).cast("int")
    left = asked.join(size, "part").select("id", "body", "part", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), cell("id", "groups").alias("group"))
    right = placed.join(size, "part").select("id", "body", "part", cell("id", "blocks").alias("block"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"))

    def compare(q: pa.Table, v: pa.Table) -> pa.Table:
        ids, names = q["id"].to_numpy(), v["id"].to_numpy()
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        if len(ids) and len(names):
            x = np.frombuffer(b"".join(q["body"].to_pylist())).reshape(len(ids), -1)
            y = np.frombuffer(b"".join(v["body"].to_pylist())).reshape(len(names), -1)
            for a in range(0, len(ids), 64):
                s = x[a : a + 64] @ y.T
                s[ids[a : a + 64, None] == names] = -np.inf
                for i, row in enumerate(s, a):
                    least = np.partition(row, len(row) - k)[len(row) - k] if len(row) > k else -np.inf
                    pick = np.flatnonzero((row >= least - 1e-9 * max(1.0, abs(least)) if np.isfinite(least) else True) & (row > -np.inf))
                    score = (x[i] * y[pick]).sum(1)  # the same for equal vectors
                    best = np.lexsort((names[pick], -score))[:k]
                    out[0].append(np.full(len(best), ids[i]))
                    out[1].append(names[pick][best])
                    out[2].append(score[best])
        return pa.table({"query_id": np.concatenate(out[0]), "vec_id": np.concatenate(out[1]), "score": np.concatenate(out[2])})

    at = ["part", "block", "group"]
    return left.groupBy(*at).cogroup(right.groupBy(*at)).applyInArrow(compare, "query_id long, vec_id long, score double")


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, sample: int = SAMPLE, part: int = PART, scanned: Callable[[float], None] | None = None) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest found; both sides are (vec_id, vec) as `usable` gives them.

    `scanned` is told the mean share of all vectors that queries are compared with; that takes another pass over small tables.
    """
    spark = vectors.sparkSession
    n = vectors.count()
    if not n:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    tree = grow(vectors, n, part, sample)
    many = visits(vectors, tree, n, k)
    share = spark.sparkContext.broadcast(tree)

    def route(how_many: int):
        """The vector's own leaf (0), or its first leaves."""

        def run(batches):
            tree = share.value
            for batch in batches:
                step = max(1, (1 << 21) // max(1, tree.leaves))
                for at in range(0, len(batch), step):
                    some = batch.slice(at, step)
                    x = np.ascontiguousarray(_matrix(some.column(1)))
                    top = tree.order(x)[:, :how_many] if how_many else tree.place(x)[:, None]
                    row = pa.array(np.repeat(np.arange(len(some)), top.shape[1]))
                    body = pa.array([v.tobytes() for v in x], pa.binary())
                    yield pa.RecordBatch.from_arrays([some.column(0).take(row), body.take(row), pa.array(top.ravel().astype(np.int32))], ["id", "body", "part"])

        return lean(run)

    schema = "id long, body binary, part int"
    placed = written(vectors.select("vec_id", "vec").mapInArrow(route(0), schema), "placed")
    asked = written(queries.select("vec_id", "vec").mapInArrow(route(many), schema), "asked")
    found = search(placed, asked, k)
    if many < tree.leaves:
        found = written(found, "found")
        short = found.groupBy("query_id").agg(F.count("*").alias("n")).where(F.col("n") >= min(k, n - 1)).select(F.col("query_id").alias("vec_id"))
        rest = written(queries.select("vec_id", "vec").join(short, "vec_id", "left_anti"), "rest")
        if not rest.isEmpty():
            every = written(rest.mapInArrow(route(tree.leaves), schema), "every")
            found = found.join(rest.select(F.col("vec_id").alias("query_id")), "query_id", "left_anti").unionByName(search(placed, every, k))
    if scanned:
        sizes = placed.groupBy("part").agg(F.count("*").alias("size"))
        scanned((asked.join(sizes, "part").agg(F.sum("size")).head()[0] or 0) / (n * max(1, queries.count())))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
