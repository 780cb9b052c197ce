"""Substring dedup over a log-structured index of window fingerprints.

Windows are runs of `WIDTH` words.  Indexing every window would cost as much as the words themselves,
so a window is filed under its minimizer: the least hash among its runs of `SEED` words (the first of
equals).  Neighbouring windows share minimizers; a block is a maximal run of windows under one.  Equal
windows have equal minimizers, and equal blocks hold equal windows.

The index (class Log) is a list of immutable runs, tables bucketed and sorted by fingerprint with one
row for each: the hash of its block, and whether the fingerprint was met once (0), repeatedly with the
same block (1) or with different blocks (2).  Rows are combined before they are shuffled, so a passage
in a third of all documents is a row for each task.  A new batch becomes a run; it is merge-joined with
every earlier run, both being sorted, to find fingerprints met before; when there are more than `FAN`
runs they are compacted into one by merging.  A log given a folder keeps a list of its runs there, and
goes on from it in a later job.

For the whole corpus, `BATCHES` batches are added in turn.  The fingerprints met twice make bitmaps for
a second reading of the texts.  Blocks of state 1 repeat whole; an exact join confirms them.  Of state 2,
where copies begin and end, each window is grouped with its fingerprint, those met twice make a bitmap,
and a third reading finds where they are; an exact join confirms them too.  Covered words are then taken
out of each text.  `new_batch` does the same for a batch against a kept log: of the documents before, only
windows of state 2 are read again.

Fingerprints, and the hashes of blocks and windows, come from two hashes of each word, by independent
random values of bytes, so windows are told apart by 128 bits, of 8 of their words and of all 35; words aren't compared byte by byte.

Windows of both copies are removed, the first one's too, as the input is judged, not what is left.
Null text has no words.  Rows that repeat an id and a text repeat each other's windows.  Every row
gives one row; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from itertools import compress

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import Membership, Words, chunks, lean, mix, row_key, shared_dir, signed, written

WIDTH, SEED, FAN, BATCHES = 35, 8, 4, 6


def blocks(words: Words, width: int = WIDTH, seed: int = SEED) -> tuple[np.ndarray, ...]:
    """First and last window of each block, its fingerprint, and where its minimizer begins."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    n, reach = len(words.hash), width - seed + 1
    at = np.arange(n)
    window = at[at + width <= words.end]
    if not len(window):
        return none
    least = np.full(n + reach, np.iinfo(np.uint64).max, np.uint64)
    start, grams = words.grams(seed)
    least[start] = grams
    full = least
    where = np.arange(n + reach)
    done = 1
    while done < reach:  # the least of the first `done` places from each, doubled
        step = min(done, reach - done)
        other, other_at = least[step:], where[step:]
        take = other < least[: len(other)]
        least = np.where(take, other, least[: len(other)])
        where = np.where(take, other_at, where[: len(other_at)])
        done += step
    chosen = where[window]
    edge = np.flatnonzero(np.concatenate(([True], (chosen[1:] != chosen[:-1]) | (window[1:] != window[:-1] + 1))))
    first, last = window[edge], window[np.append(edge[1:], len(window)) - 1]
    seed_at = chosen[edge]
    return first, last, full[seed_at], seed_at


def block_hashes(words: Words, first: np.ndarray, last: np.ndarray, seed_at: np.ndarray, width: int) -> np.ndarray:
    """Of all the words of each block, by their second hashes, and their places about the minimizer."""
    shape = ((seed_at - first) << 32 | (last - first)).astype(np.uint64)
    return mix(words.others(first, last + width) ^ mix(shape + np.uint64(1)))


def _fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """One row for each fingerprint: fp, block, state."""

    def emit(batches):
        for batch in batches:
            for some in chunks((t for t in batch.column(0).to_pylist() if t)):
                words = Words(some, two=True)
                first, last, fp, seed_at = blocks(words, width)
                block = block_hashes(words, first, last, seed_at, width)
                yield pa.RecordBatch.from_arrays([pa.array(signed(fp)), pa.array(signed(block))], ["fp", "block"])

    rows = docs.select(F.col("text").cast("binary")).mapInArrow(lean(emit), "fp long, block long")
    return _combined(rows.withColumn("state", F.lit(0).cast("byte")))


def _combined(rows: DataFrame) -> DataFrame:
    low, high = F.min("block"), F.max("block")
    state = F.when(low != high, 2).when(F.max("state") > 0, F.max("state")).when(F.count("*") > 1, 1).otherwise(0)
    return rows.groupBy("fp").agg(low.alias("block"), state.cast("byte").alias("state"))


class Log:
    """The index: sorted immutable runs of fingerprints; with a folder, their names are kept in it."""

    def __init__(self, spark: SparkSession, width: int = WIDTH, fan: int = FAN, folder: str | None = None):
        self.spark, self.width, self.fan, self.folder = spark, width, fan, folder
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.runs: list[str] = []
        self.version = 0
        for r in self._kept():
            self.version = r["version"]
            self.runs.append(r["name"])
            spark.sql(f"create table if not exists {r['name']} (fp long, block long, state byte) using parquet clustered by (fp) sorted by (fp) into {r['buckets']} buckets location '{r['path']}'")

    def _kept(self) -> list:
        """The rows of the newest list of runs in the folder."""
        if not self.folder:
            return []
        try:
            lists = self.spark.read.schema("version long, at long, name string, path string, buckets long").parquet(f"{self.folder}/runs")
        except AnalysisException:  # no list yet
            return []
        newest = lists.agg(F.max("version")).head()[0]
        return lists.where(F.col("version") == newest).orderBy("at").collect() if newest else []

    def _keep(self) -> None:
        if self.folder:
            self.version += 1
            rows = [(self.version, i, name, self._path(name), self._buckets(name)) for i, name in enumerate(self.runs)]
            self.spark.createDataFrame(rows, "version long, at long, name string, path string, buckets long").coalesce(1).write.mode("append").parquet(f"{self.folder}/runs")

    def _describe(self, name: str, what: str) -> str:
        return next(r["data_type"] for r in self.spark.sql(f"describe table extended {name}").collect() if r["col_name"] == what)

    def _path(self, name: str) -> str:
        return self._describe(name, "Location")

    def _buckets(self, name: str) -> int:
        return int(self._describe(name, "Num Buckets"))

    def _write(self, rows: DataFrame) -> str:
        name = f"celldex_run_{uuid.uuid4().hex}"
        path = f"{self.folder or shared_dir(self.spark) + '/celldex'}/{name}"
        rows.write.bucketBy(self.buckets, "fp").sortBy("fp").option("path", path).saveAsTable(name)
        return name

    def add(self, batch: DataFrame) -> DataFrame:
        """Files a batch of documents (text); returns fp, state of fingerprints of it met twice, in it or before."""
        run = self._write(_fingerprints(batch, self.width))
        new = self.spark.table(run)
        found = new.where("state > 0").select("fp", "state")
        for old in self.runs:
            before = self.spark.table(old).select("fp", F.col("block").alias("was"), F.col("state").alias("old"))
            state = F.when((F.col("block") != F.col("was")) | (F.col("state") == 2) | (F.col("old") == 2), 2).otherwise(1)
            found = found.unionAll(new.hint("merge").join(before, "fp").select("fp", state.cast("byte")))
        found = written(found, "met")
        self.runs.append(run)
        if len(self.runs) > self.fan:
            self.compact()
        self._keep()
        return found

    def compact(self) -> None:
        """Merges all runs into one; they are sorted alike, so their buckets are merged where they lie."""
        rows = self.spark.table(self.runs[0])
        for name in self.runs[1:]:
            rows = rows.unionAll(self.spark.table(name))
        merged = self._write(_combined(rows))
        self.drop()
        self.runs = [merged]

    def drop(self) -> None:
        for name in self.runs:
            self.spark.sql(f"drop table if exists {name}")


def _texts(docs: DataFrame) -> DataFrame:
    return docs.where("text is not null and text <> ''").select(F.col("doc_id").cast("long"), row_key().alias("key"), F.col("text").cast("binary"))


def _met_blocks(docs: DataFrame, met, width: int) -> DataFrame:
    """doc_id, key, fp, first, n of blocks whose fingerprint passes the bitmap (a broadcast Membership)."""

    def pick(batches):
        for batch in batches:
            for some in chunks(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), size=lambda r: len(r[2])):
                words = Words([r[2] for r in some])
                first, last, fp, _ = blocks(words, width)
                ok = met.value.has(fp)
                first, last, fp = first[ok], last[ok], fp[ok]
                doc = np.searchsorted(words.first, first, side="right") - 1
                ids, keys = (pa.array([r[i] for r in some], pa.int64()).take(pa.array(doc)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([ids, keys, pa.array(signed(fp)), pa.array((first - words.first[doc]).astype(np.int32)), pa.array((last - first + 1).astype(np.int32))], ["doc_id", "key", "fp", "first", "n"])

    return _texts(docs).mapInArrow(lean(pick), "doc_id long, key long, fp long, first int, n int")


def _windows(docs: DataFrame, met, width: int, keep=None) -> DataFrame:
    """fp, window (its hash) of the windows of blocks that pass the bitmap; by `keep`, a bitmap of windows, only those, with doc_id, key, first."""

    def pick(batches):
        for batch in batches:
            for some in chunks(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), size=lambda r: len(r[2])):
                words = Words([r[2] for r in some], two=True)
                first, last, fp, _ = blocks(words, width)
                ok = met.value.has(fp)
                first, n, fp = first[ok], (last - first + 1)[ok], fp[ok]
                window = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                hashes, fp = words.others(window, window + width), np.repeat(fp, n)
                if keep is None:
                    yield pa.RecordBatch.from_arrays([pa.array(signed(fp)), pa.array(signed(hashes))], ["fp", "window"])
                    continue
                ok = keep.value.has(hashes)
                window, hashes, fp = window[ok], hashes[ok], fp[ok]
                doc = np.searchsorted(words.first, window, side="right") - 1
                ids, keys = (pa.array([r[i] for r in some], pa.int64()).take(pa.array(doc)) for i in (0, 1))
                yield pa.RecordBatch.from_arrays([pa.array(signed(fp)), pa.array(signed(hashes)), ids, keys, pa.array((window - words.first[doc]).astype(np.int32))], ["fp", "window", "doc_id", "key", "first"])

    return _texts(docs).mapInArrow(lean(pick), "fp long, window long" + ("" if keep is None else ", doc_id long, key long, first int"))


def covered(docs: DataFrame, met: DataFrame, width: int = WIDTH, others: DataFrame | None = None) -> DataFrame:
    """Runs of words of docs under repeated windows: doc_id, key (row_key), first, last (exclusive).

    met (fp, state) has the fingerprints met twice; `others` are documents whose windows count too.
    """
    share = docs.sparkSession.sparkContext.broadcast
    once, apart = (met.where(F.col("state") == s).select("fp") for s in (1, 2))
    one, two = (share(Membership.of(m, "fp", m.count())) for m in (once, apart))
    whole = _met_blocks(docs, one, width).join(once, "fp").select("doc_id", "key", "first", (F.col("first") + F.col("n") + width - 1).alias("last"))
    every = docs.select("doc_id", "text") if others is None else docs.select("doc_id", "text").unionAll(others.select("doc_id", "text"))
    counts = _windows(every, two, width).groupBy("fp", "window").agg(F.count("*").alias("n")).where("n > 1").select("fp", "window")
    twice = written(counts, "twice")
    keep = share(Membership.of(twice, "window", twice.count()))
    parts = _windows(docs, two, width, keep).join(twice, ["fp", "window"])
    return whole.unionAll(parts.select("doc_id", "key", "first", (F.col("first") + width).alias("last")))


def repeated(docs: DataFrame, width: int = WIDTH, batches: int = BATCHES) -> DataFrame:
    """Runs of words covered by windows that occur elsewhere too: doc_id, key (row_key), first, last (exclusive)."""
    log, found = Log(docs.sparkSession, width), None
    draw = F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(batches))
    for i in range(batches):
        one = log.add(docs.where(draw == i).select("text"))
        found = one if found is None else found.unionAll(one)
    met = written(found.groupBy("fp").agg(F.max("state").alias("state")), "fingerprints")
    log.drop()
    return covered(docs, met, width)


def new_batch(log: Log, docs: DataFrame, before: DataFrame) -> DataFrame:
    """`substring_dedup` of docs, judged also by the documents before, whose fingerprints the log has; docs are filed in it."""
    met = written(log.add(docs.select("text")).groupBy("fp").agg(F.max("state").alias("state")), "fingerprints")
    old = before.select("doc_id", "text")
    return _rebuilt(docs, covered(docs, met, log.width, old))


def substring_dedup(docs: DataFrame, width: int = WIDTH, batches: int = BATCHES) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256, kept (text of the words left) of every row."""
    return _rebuilt(docs, repeated(docs, width, batches))


def _rebuilt(docs: DataFrame, spans: DataFrame) -> DataFrame:
    spans = spans.groupBy(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).agg(F.collect_list("first").alias("first"), F.collect_list("last").alias("last"))

    @F.pandas_udf("n_words long, n_removed long, kept_sha256 string, kept string")
    def rebuild(text: pd.Series, first: pd.Series, last: pd.Series) -> pd.DataFrame:
        out = []
        for t, a, b in zip(text, first, last, strict=True):
            words = (t or "").encode().split()
            n = len(words)
            if a is not None:
                step = np.zeros(n + 1, np.int64)
                np.add.at(step, a, 1)
                np.add.at(step, b, -1)
                words = list(compress(words, (np.cumsum(step[:-1]) == 0).tolist()))
            body = b" ".join(words)
            out.append((n, n - len(words), hashlib.sha256(body).hexdigest(), body.decode()))
        return pd.DataFrame(out, columns=["n_words", "n_removed", "kept_sha256", "kept"])

    rows = docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), "text").join(spans, (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left")
    return rows.select("doc_id", rebuild("text", "first", "last").alias("new")).select("doc_id", "new.*")


def brute(texts: list[str | None], width: int = WIDTH) -> list[tuple[int, int, str]]:
    """n_words, n_removed, kept_sha256 of each text, the plain way; for tests."""
    words = [(t or "").encode().split() for t in texts]
    seen: dict[tuple, int] = {}
    for w in words:
        for i in range(len(w) - width + 1):
            seen[tuple(w[i : i + width])] = seen.get(tuple(w[i : i + width]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i : i + width])] > 1:
                gone.update(range(i, i + width))
        kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return out
