"""Jaccard join of documents' shingle sets: subsets for small sets, inverted lists for large ones.

Sets are distinct shingles of some lower-cased words, 5 if not told otherwise; documents with equal sets are one class, with the
least id as its representative, and need no pairs.  Classes link if 100 |x & y| >= T |x | y|, with
T = 80 if not told otherwise.

Light sets (up to a boundary) are filed under every subset that leaves out no more than a link allows:
two linked sets share the subset that is their intersection.  Heavy sets are filed in the inverted
lists of their prefix: the first n - ceil(T n / 100) + 1 shingles, those of the table of most frequent
shingles last; linked sets share one.  The boundary is the cheapest of the largest sizes of which a link
allows 0 to `MOST_OUT` shingles to be left out (so a set has 106 subsets at T = 80, 436 at 90, at most), by
the sizes of the light sets, the subsets they would file, and the expected length of a list.

A list holds sets of like size only: sizes are cut in bands of `BAND` steps of 100 / T, and a set in
the last step of a band is filed in the next one too.  Lists of up to `SMALL_LIST` classes are
compared pair by pair, after a bound on the overlap: the sum of the lesser counts in parts of the
range of hashes, of about `PER_PART` shingles each.  Longer lists aren't expanded into pairs.
1. Lists with two classes or more are found by a grouped minimum and maximum; a bitmap of them lets a
   second reading of the texts file only what can meet something.
2. In each long list, every class is compared with one leader, the class that meets most classes in all
   its lists, so one near the middle of its group.  That links nearly all copies of a text, and gives
   each class x its difference D from the leader: the shingles it has more, then those it lacks.
3. Classes in one list that aren't linked through the leader may still link with each other.  Where a
   leader has no more such classes than a difference has shingles to be looked up, each of them is paired
   with all the leader's classes, which is cheaper, and pairs go by the bound on the overlap.  Else, as
   |x ^ y| = |Dx ^ Dy|, and |x ^ y| <= n (100 - T) / T, they must share some of the first shingles of
   their differences (or have differences so small that none need be shared); those are joined, with
   a bound by position, and compared exactly.  Pairs of which both are linked to the leader are in one
   component already.  So no link between different texts is lost, for components.
4. Components are found over classes, not ids: two texts of one id don't link what they link with.

Classes are told apart by 128-bit digests in results and by 64 bits in lists.

Empty and null texts have empty sets and link with nothing.  Rows without an id get their n_shingles
and no component, and link nothing.  Rows that repeat an id each get the component of their own text.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.matching import components
from .common import Membership, Words, chunks, lean, mix, most_frequent, row_key, signed, small_batches, written

SHINGLE, PERCENT, FREQUENT = 5, 80, 1 << 20
MOST_OUT, MOST_LIGHT = 2, 29
SEEN_LEAST, SEEN_WITHIN = 3, 3_000_000
SMALL_LIST, BAND, PER_PART, MOST_PARTS = 12, 3, 16, 1 << 14


def sets(texts: list[bytes], shingle: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words = Words(texts, lower=True)
    at, grams = words.grams(shingle)
    cut = np.searchsorted(at, words.first)
    n = np.diff(words.first)
    short = np.flatnonzero((n > 0) & (n < shingle))
    whole = words.spans(words.first[:-1][short], words.first[1:][short])
    out = [np.unique(grams[a:b]) for a, b in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True)]
    for i, h in zip(short.tolist(), whole, strict=True):
        out[i] = np.array([h], np.uint64)
    return out


def digest(x: np.ndarray) -> tuple[int, int]:
    """128 bits of a set, whatever its order."""
    m = mix(x + np.uint64(0x632BE59BD9B4E019))
    return int(signed(mix(np.array([m.sum() + np.uint64(len(x))], np.uint64)))[0]), int(signed(np.array([np.bitwise_xor.reduce(mix(m)) if len(x) else 0], np.uint64))[0])


def counts(x: np.ndarray) -> np.ndarray:
    """How many of x are in each of equal parts of the range of hashes."""
    bits = min(MOST_PARTS, max(32, len(x) // PER_PART)).bit_length() - 1
    return np.bincount((x >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype("<u4")


def most_shared(a: np.ndarray, b: np.ndarray) -> int:
    """No overlap of sets with these counts is greater."""
    n = min(len(a), len(b))
    return int(np.minimum(a.reshape(n, -1).sum(1), b.reshape(n, -1).sum(1)).sum())


def least_overlap(n: int, percent: int) -> int:
    return -(-percent * n // 100)


def boundaries(percent: int) -> list[int]:
    """The largest sizes of which a link allows 0 to MOST_OUT shingles to be left out, MOST_LIGHT at most."""
    return [min(MOST_LIGHT, -(-100 * (j + 1) // max(1, 100 - percent)) - 1) for j in range(MOST_OUT + 1)]


def subsets(x: np.ndarray, percent: int) -> np.ndarray:
    """Hashes of the subsets of x that leave out no more than a link allows."""
    m = mix(x + np.uint64(0x1D8E4E27C47D124F))
    total = m.sum(dtype=np.uint64)
    out = []
    for j in range(len(x) - least_overlap(len(x), percent) + 1):
        gone = [m[list(c)].sum(dtype=np.uint64) for c in combinations(range(len(x)), j)]
        out.append(mix(total - np.array(gone, np.uint64) + np.uint64(len(x) - j)))
    return np.concatenate(out)


class Filing:
    """Where classes are filed."""

    def __init__(self, frequent: np.ndarray, boundary: int, percent: int):
        self.frequent, self.boundary, self.percent = frequent, boundary, percent  # frequent: the rarest first
        self.order = np.argsort(frequent)
        self.sorted = frequent[self.order]
        self.maybe = np.zeros(1 << 22, bool)
        self.maybe[(frequent >> np.uint64(42)).astype(np.int64)] = True

    def _bands(self, n: int) -> list[int]:
        """Sets of sizes a link allows have a band in common."""
        step = math.log(n) / math.log(100 / self.percent) / BAND if self.percent < 100 else n
        band = math.floor(step)
        return [band, band + 1] if self.percent < 100 and step - band >= 1 - 1 / BAND - 1e-9 else [band]

    def keys(self, x: np.ndarray) -> np.ndarray:
        out = []
        if len(x) <= self.boundary:
            out.append(subsets(x, self.percent))
        if len(x) >= least_overlap(self.boundary + 1, self.percent):
            level = np.zeros(len(x), np.int64)
            near = np.flatnonzero(self.maybe[(x >> np.uint64(42)).astype(np.int64)])
            if len(near) and len(self.sorted):
                at = np.minimum(np.searchsorted(self.sorted, x[near]), len(self.sorted) - 1)
                level[near] = np.where(self.sorted[at] == x[near], self.order[at] + 1, 0)
            k = len(x) - least_overlap(len(x), self.percent) + 1
            if not level[:k].any():  # x is sorted by hash
                first = x[:k]
            else:
                first = x[np.lexsort((x, level))[:k]]
            for band in self._bands(len(x)):
                out.append(mix(first + np.uint64(3 + band)))
        return np.concatenate(out)


def _rows(docs: DataFrame, shingle: int) -> DataFrame:
    """A row for each document: doc_id, n, h1, h2, counts, key; and rows of shingles seen often within a task: shingle, seen."""
    names, kinds = ["doc_id", "n", "h1", "h2", "counts", "key", "shingle", "seen"], [*[pa.int64()] * 4, pa.binary(), *[pa.int64()] * 3]

    def read(batches):
        pending, size = [], 0

        def often():
            value, n = np.unique(np.concatenate(pending), return_counts=True)
            value, n = value[n >= SEEN_LEAST], n[n >= SEEN_LEAST]
            none = pa.nulls(len(n), pa.int64())
            return pa.RecordBatch.from_arrays([none] * 4 + [pa.nulls(len(n), pa.binary()), none, pa.array(signed(value)), pa.array(n)], names)

        for batch in batches:
            for some in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True), size=lambda r: len(r[1] or b"")):
                all_sets = sets([r[1] or b"" for r in some], shingle)
                pending += all_sets
                size += sum(map(len, all_sets))
                h = [digest(x) for x in all_sets]
                cols = [[r[0] for r in some], [len(x) for x in all_sets], [a for a, _ in h], [b for _, b in h], [counts(x).tobytes() for x in all_sets], [r[2] for r in some]]
                none = pa.nulls(len(some), pa.int64())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=False)] + [none, none], names)
                if size > SEEN_WITHIN:
                    yield often()
                    pending, size = [], 0
        if pending:
            yield often()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"), row_key()).mapInArrow(lean(read), ", ".join(f"{c} {'binary' if c == 'counts' else 'long'}" for c in names))


def _files(docs: DataFrame, filing, shingle: int, keep=None) -> DataFrame:
    """key, cls: where each class is filed (by `keep`, a broadcast Membership, only in lists that it has)."""

    def file(batches):
        done: set[int] = set()  # copies within a task are filed once
        for batch in batches:
            for some in chunks(t for t in batch.column(0).to_pylist() if t):
                keys, classes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
                for x in sets(some, shingle):
                    if len(x) and (cls := digest(x)[0]) not in done:
                        done.add(cls)
                        keys.append(filing.value.keys(x))
                        classes.append(np.full(len(keys[-1]), cls))
                key, cls = np.concatenate(keys), np.concatenate(classes)
                if keep is not None:
                    ok = keep.value.has(key)
                    key, cls = key[ok], cls[ok]
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(cls)], ["key", "cls"])

    return docs.where("doc_id is not null").select(F.col("text").cast("binary")).mapInArrow(lean(file), "key long, cls long")


def _sets_of(docs: DataFrame, classes: DataFrame, shingle: int) -> DataFrame:
    """cls, items (sorted hashes, as bytes) of classes (cls, rep), read from their representatives."""
    spark = docs.sparkSession
    need = classes.select(F.xxhash64("rep").alias("at"))
    share = spark.sparkContext.broadcast(Membership.of(need, "at", classes.count()))

    def read(batches):
        for batch in batches:
            at = batch.column(1).to_numpy().view(np.uint64)
            pick = np.flatnonzero(share.value.has(at))
            rows = batch.take(pa.array(pick))
            for some in chunks(zip(rows.column(0).to_pylist(), rows.column(2).to_pylist(), strict=True), size=lambda r: len(r[1])):
                all_sets = sets([r[1] for r in some], shingle)
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in some], pa.int64()), pa.array([digest(x)[0] for x in all_sets]), pa.array([x.tobytes() for x in all_sets], pa.binary())], ["rep", "cls", "items"])

    rows = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long"), F.xxhash64(F.col("doc_id").cast("long")).alias("at"), F.col("text").cast("binary"))
    got = rows.mapInArrow(lean(read), "rep long, cls long, items binary")
    return got.join(classes.select("cls", "rep"), ["cls", "rep"], "left_semi").dropDuplicates(["cls"]).select("cls", "items")


def _compared(pairs: DataFrame, items: DataFrame, percent: int, differences: bool) -> DataFrame:
    """pairs (a, b) with link, n (of a) and, if asked for, diff: how many shingles differ, and the first of them."""

    def compare(batches):
        for batch in batches:
            link, n, size, diff = [], [], [], []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                place = np.minimum(np.searchsorted(y, x), len(y) - 1)
                inside = y[place] == x
                both = int(inside.sum())
                link.append(100 * both >= percent * (len(x) + len(y) - both))
                n.append(len(x))
                if differences:
                    lacks = np.ones(len(y), bool)
                    lacks[place[inside]] = False
                    d = np.concatenate((x[~inside], y[lacks]))
                    size.append(len(d))
                    diff.append(signed(d[: _most_apart(len(x), percent) + 1]).tolist())
            cols = [batch.column(0), batch.column(1), pa.array(link, pa.bool_()), pa.array(n, pa.int32())]
            if differences:
                cols += [pa.array(size, pa.int32()), pa.array(diff, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(cols, ["a", "b", "link", "n", "apart", "diff"][: len(cols)])

    rows = pairs.join(items.select(F.col("cls").alias("a"), F.col("items").alias("x")), "a").join(items.select(F.col("cls").alias("b"), F.col("items").alias("y")), "b").select("a", "b", "x", "y")
    return rows.mapInArrow(lean(compare), "a long, b long, link boolean, n int" + ", apart int, diff array<long>" * differences)


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that may link by the counts of their shingles in parts of the range of hashes."""

    def bound(batches):
        for batch in batches:
            ok = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                x, y = np.frombuffer(x.as_buffer(), "<u4"), np.frombuffer(y.as_buffer(), "<u4")
                both = most_shared(x, y)
                ok.append(100 * both >= percent * (int(x.sum()) + int(y.sum()) - both))
            yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))

    rows = pairs.join(classes.select(F.col("cls").alias("a"), F.col("counts").alias("x")), "a").join(classes.select(F.col("cls").alias("b"), F.col("counts").alias("y")), "b")
    return rows.select("a", "b", "x", "y").mapInArrow(lean(bound), "a long, b long")


def _most_apart(n: int, percent: int) -> int:
    """|x ^ y| of linked sets of which one has n: their union has n * 100 / percent at most."""
    return n * (100 - percent) // percent


def ngram_join(docs: DataFrame, percent: int = PERCENT, frequent: int = FREQUENT, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, component_id, key (`row_key`) of every row of docs (doc_id, text)."""
    spark = docs.sparkSession
    rows = written(_rows(docs, shingle), "sets")
    each = rows.where("n is not null").select("doc_id", "n", "h1", "h2", "counts", "key")
    classes = written(each.where("n > 0 and doc_id is not null").groupBy("h1", "h2", "n", "counts").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")), "classes")

    seen = written(rows.where("seen is not null").groupBy("shingle").agg(F.sum("seen").alias("seen")), "seen")
    top = most_frequent(seen, "seen", frequent).toArrow()
    value, count = top["shingle"].to_numpy().view(np.uint64), top["seen"].to_numpy()
    filing = spark.sparkContext.broadcast(Filing(value[np.lexsort((value, count))], _boundary(classes, seen, percent), percent))

    live = _files(docs, filing, shingle).groupBy("key").agg(F.min("cls").alias("a"), F.max("cls").alias("b")).where("a <> b").select("key")
    live = written(live, "lists")
    keep = spark.sparkContext.broadcast(Membership.of(live, "key", live.count()))
    filed = written(_files(docs, filing, shingle, keep).distinct(), "filed")
    named = classes.select(F.col("h1").alias("cls"), "rep", "copies", "n", "counts")
    ranked = filed.join(named.select("cls", "copies", "n"), "cls")
    sized = ranked.join(ranked.groupBy("key").agg(F.count("*").alias("size")).where("size > 1"), "key")
    central = sized.groupBy("cls").agg(F.sum("size").alias("met"))
    lists = sized.join(central, "cls").groupBy("key").agg(F.max(F.struct("met", "copies", "cls")).alias("lead"), F.count("*").alias("size"))
    ranked = written(ranked.join(lists.select("key", F.col("lead.cls").alias("b"), "size"), "key"), "ranked")
    stars = written(ranked.where((F.col("size") > SMALL_LIST) & (F.col("cls") != F.col("b"))).select(F.col("cls").alias("a"), "b").distinct(), "stars")
    short = ranked.where(F.col("size") <= SMALL_LIST)
    one, two = short.select("key", F.col("cls").alias("a"), F.col("n").alias("an")), short.select("key", F.col("cls").alias("b"), F.col("n").alias("bn"))
    like = 100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")
    direct = one.join(two, "key").where((F.col("a") < F.col("b")) & like).select("a", "b").distinct()
    direct = written(_bounded(direct, named, percent), "direct")

    met = stars.unionAll(direct)
    need = met.select(F.col("a").alias("cls")).unionAll(met.select("b")).distinct()
    items = written(_sets_of(docs, written(named.join(need, "cls").select("cls", "rep"), "need"), shingle), "items")
    with small_batches(spark):
        compared = written(_compared(stars, items, percent, True), "compared")

    apart = F.floor(F.col("n") * (100 - percent) / percent).cast("int")
    open_at = compared.groupBy("b").agg(F.count_if(~F.col("link")).alias("open"), F.max(apart).alias("reach")).where("open > 0")
    near = written(compared.join(open_at, "b").withColumn("most", apart), "near")
    few = near.where("open <= reach + 1")
    other = few.select("b", F.col("a").alias("y"), "link")
    few = few.where("not link").select("b", F.col("a").alias("x")).join(other, "b").where((F.col("link") & (F.col("x") != F.col("y"))) | (F.col("x") < F.col("y")))
    few = written(_bounded(few.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), named, percent), "few")
    near = near.where("open > reach + 1")
    # The mark 0 stands for differences that are small enough to share nothing.
    small = F.when(F.col("apart") <= F.col("most"), F.array(F.lit(0).cast("long"))).otherwise(F.array().cast("array<long>"))
    tokens = written(near.select("a", "b", "link", "apart", "most", F.posexplode(F.concat(small, "diff")).alias("at", "token"), F.size(small).alias("shift")), "differences")
    x = tokens.where("not link").select("b", "token", F.col("a").alias("x"), F.col("apart").alias("xn"), F.col("most").alias("xm"), (F.col("at") - F.col("shift")).alias("xp"))
    y = tokens.select("b", "token", F.col("a").alias("y"), "link", F.col("apart").alias("yn"), F.col("most").alias("ym"), (F.col("at") - F.col("shift")).alias("yp"))
    most = F.least("xm", "ym")
    shared = F.when(F.col("xp") < 0, 0).otherwise(1 + F.least(F.col("xn") - F.col("xp"), F.col("yn") - F.col("yp")) - 1)
    pairs = x.join(y, ["b", "token"]).where((F.col("link") & (F.col("x") != F.col("y"))) | (F.col("x") < F.col("y"))).where(2 * shared >= F.col("xn") + F.col("yn") - most)
    pairs = written(pairs.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "pairs")
    with small_batches(spark):
        more = written(_compared(pairs.unionAll(direct).unionAll(few).distinct(), items, percent, False), "compared")

    links = compared.where("link").select("a", "b").unionAll(more.where("link").select("a", "b"))
    found = written(components(links, written, lambda df: df, 0).withColumnRenamed("node", "h1"), "linked")
    least = classes.join(found, "h1").groupBy("component").agg(F.min("rep").alias("least"))
    to = found.join(least, "component").select("h1", "least")
    of_class = written(classes.join(to, "h1", "left").select("h1", "h2", F.coalesce("least", "rep").alias("component")), "components")
    out = each.join(of_class, ["h1", "h2"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), "key")


def _boundary(classes: DataFrame, seen: DataFrame, percent: int) -> int:
    """The size up to which filing subsets is cheaper than scanning inverted lists."""
    size = {r["n"]: r["count"] for r in classes.where(F.col("n") <= max(boundaries(percent))).groupBy("n").count().collect()}
    total = classes.agg(F.sum(F.col("n") * F.col("copies"))).head()[0] or 1
    length = 1 + (seen.agg(F.sum(F.col("seen").cast("double") * F.col("seen"))).head()[0] or 0) / total

    def light(n: int) -> int:
        out, term = 0, 1
        for j in range(n - least_overlap(n, percent) + 1):
            out += term
            term = term * (n - j) // (j + 1)
        return out

    cost = {t: sum(k * (light(n) if n <= t else (n - least_overlap(n, percent) + 1) * length) for n, k in size.items()) for t in boundaries(percent)}
    return min(cost, key=lambda t: (cost[t], t))


def brute(texts: dict[int, str | None], percent: int = PERCENT, shingle: int = SHINGLE) -> dict[int, tuple[int, int]]:
    """n_shingles and component_id by doc_id, the plain way; for tests."""
    own: dict[int, frozenset] = {}
    for k, t in texts.items():
        w = bytes(c + 32 if 65 <= c <= 90 else c for c in (t or "").encode()).split()
        own[k] = frozenset(tuple(w[i : i + shingle]) for i in range(max(1, len(w) - shingle + 1))) if w else frozenset()
    top = {k: k for k in own}

    def root(k: int) -> int:
        while top[k] != k:
            k = top[k]
        return k

    ids = sorted(own)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            n, m = len(own[a]), len(own[b])
            if n and m and 100 * min(n, m) >= percent * max(n, m):
                both = len(own[a] & own[b])
                if 100 * both >= percent * (n + m - both):
                    ra, rb = sorted((root(a), root(b)))
                    top[rb] = ra
    return {k: (len(own[k]), root(k)) for k in own}
