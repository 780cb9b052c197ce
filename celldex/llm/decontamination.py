"""Benchmark decontamination by a prefix-filtered join of shingles.

An item's windows are its runs of 10 words (an item of fewer is one window).  A document that holds a
window holds all the window's shingles of 3 words, so one of them is enough as the join's key: the
rarest one, by counts over all documents.  A document's shingle that is a key fixes where the window
would begin; it must lie inside the text (length and position), and then every word of the window is
compared.  Items of fewer than 3 words have themselves as their shingle.

The benchmark side is read in blocks of at most `MOST_BYTES` of text, each broadcast by itself; the
usual benchmark is one block.  All documents are read whole for every block and nothing is shuffled
but the few rows with hits, where there are several blocks.

Null and wordless texts have no words and no hits.  Items without an id or without words take no part;
rows that repeat an item's id are one item.  Every document row gives one row, whatever its id.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM, Words, chunks, lean, row_key, signed, written

WIDTH, SHINGLE = 10, 3
MOST_BYTES = 16 << 20


class Windows:
    """Distinct windows of a block of items; `keys[g]` are the shingles of g words that lead to windows."""

    def __init__(self, items: list[tuple[str, bytes]]):
        self.names = sorted({k for k, _ in items})
        name = {k: i for i, k in enumerate(self.names)}
        words = Words([t for _, t in items], ALNUM, lower=True)
        found: dict[bytes, set[int]] = {}
        for (k, _), a, b in zip(items, words.first[:-1].tolist(), words.first[1:].tolist(), strict=True):
            for s in range(a, max(a + 1, b - WIDTH + 1)) if b > a else ():
                found.setdefault(words.hash[s : min(b, s + WIDTH)].tobytes(), set()).add(name[k])
        self.words = [np.frombuffer(w, np.uint64) for w in found]
        self.items = [sorted(v) for v in found.values()]
        self.keys: dict[int, np.ndarray] = {}
        self.counts: dict[int, np.ndarray] = {}
        self.shingles = []  # of each window: (g, hashes)
        for w in self.words:
            g = min(SHINGLE, len(w))
            self.shingles.append((g, _gram(w, g)))
        for g in {g for g, _ in self.shingles}:
            self.keys[g] = np.unique(np.concatenate([h for k, h in self.shingles if k == g]))
            self.counts[g] = np.zeros(len(self.keys[g]), np.int64)

    def choose(self) -> None:
        """Leaves the rarest shingle of each window as its key; `led[g]` has (key's place, window, offset), by key."""
        self.led = {}
        for g in self.keys:
            rows = []
            for i, (k, h) in enumerate(self.shingles):
                if k == g:
                    n = self.counts[g][np.searchsorted(self.keys[g], h)]
                    at = int(np.lexsort((h, n))[0])
                    rows.append((h[at], i, at))
            rows.sort()
            keys = np.array([r[0] for r in rows], np.uint64)
            self.keys[g], first = np.unique(keys, return_index=True)
            self.led[g] = (np.append(first, len(rows)), np.array([r[1] for r in rows], np.int64), np.array([r[2] for r in rows], np.int64))
        self.length = np.array([len(w) for w in self.words], np.int64)
        self.table = np.zeros((len(self.words), WIDTH), np.uint64)
        for i, w in enumerate(self.words):
            self.table[i, : len(w)] = w
        self.shingles = self.words = None

    def near(self, hashes: np.ndarray, g: int) -> tuple[np.ndarray, np.ndarray]:
        """Places among hashes that are keys, and which keys."""
        keys = self.keys[g]
        maybe = np.zeros(1 << 16, bool)
        maybe[(keys >> np.uint64(48)).astype(np.int64)] = True
        at = np.flatnonzero(maybe[(hashes >> np.uint64(48)).astype(np.int64)])
        place = np.minimum(np.searchsorted(keys, hashes[at]), len(keys) - 1)
        ok = keys[place] == hashes[at]
        return at[ok], place[ok]

    def hits(self, words: Words) -> tuple[np.ndarray, np.ndarray]:
        """Starts and numbers of the windows that occur."""
        starts, windows = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        text = np.repeat(words.first[:-1], np.diff(words.first))  # where each word's text begins
        padded = np.append(words.hash, np.zeros(WIDTH, np.uint64))
        for g in self.keys:
            at, grams = words.grams(g)
            near, key = self.near(grams, g)
            first, window, offset = self.led[g]
            n = first[key + 1] - first[key]
            place = np.repeat(at[near], n)
            row = np.repeat(first[key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w, s = window[row], place - offset[row]
            ok = (s >= text[place]) & (s + self.length[w] <= words.end[place])
            w, s = w[ok], s[ok]
            same = (padded[s[:, None] + np.arange(WIDTH)] == self.table[w]) | (np.arange(WIDTH) >= self.length[w][:, None])
            ok = same.all(1)
            starts.append(s[ok])
            windows.append(w[ok])
        return np.concatenate(starts), np.concatenate(windows)


def _gram(w: np.ndarray, g: int) -> np.ndarray:
    """The hashes that Words.grams(g) gives a text of these words."""
    text = Words.__new__(Words)
    text.hash, text.end = w, np.full(len(w), len(w))
    return text.grams(g)[1]


def _blocks(items: DataFrame, most: int):
    """The benchmark's items in blocks of about `most` bytes of text."""
    items = items.where("item_id is not null and text is not null").select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("binary").alias("text"))
    n = max(1, -(-(items.agg(F.sum(F.octet_length("text"))).head()[0] or 0) // most))
    for k in range(n):
        got = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == k).toArrow()
        yield Windows(sorted(zip(got["item"].to_pylist(), got["text"].to_pylist(), strict=True)))


def _count(docs: DataFrame, block: Windows) -> None:
    """Counts the block's shingles over all documents."""
    share = docs.sparkSession.sparkContext.broadcast(block)

    def count(batches):
        block = share.value
        n = {g: np.zeros(len(k), np.int64) for g, k in block.keys.items()}
        for batch in batches:
            for some in chunks((t for t in batch.column(0).to_pylist() if t)):
                words = Words(some, ALNUM, lower=True)
                for g in n:
                    np.add.at(n[g], block.near(words.grams(g)[1], g)[1], 1)
        for g, v in n.items():
            at = np.flatnonzero(v)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), g)), pa.array(at), pa.array(v[at])], ["g", "at", "n"])

    got = docs.select(F.col("text").cast("binary")).mapInArrow(lean(count), "g long, at long, n long").groupBy("g", "at").agg(F.sum("n").alias("n")).toArrow()
    for g, at, n in zip(got["g"].to_pylist(), got["at"].to_pylist(), got["n"].to_pylist(), strict=True):
        block.counts[g][at] = n


def _hits(docs: DataFrame, block: Windows) -> DataFrame:
    """doc_id, key, n_words, hits (places of words), items of every row."""
    share = docs.sparkSession.sparkContext.broadcast(block)

    def find(batches):
        block = share.value
        for batch in batches:
            for some in chunks(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), size=lambda r: len(r[2] or b"")):
                words = Words([r[2] or b"" for r in some], ALNUM, lower=True)
                start, window = block.hits(words)
                step = np.zeros(len(words.hash) + 1, np.int64)
                np.add.at(step, start, 1)
                np.add.at(step, start + block.length[window], -1)
                hit = np.flatnonzero(np.cumsum(step[:-1]) > 0)
                doc_of = np.searchsorted(words.first, start, side="right") - 1
                items: dict[int, set[str]] = {}
                for d, w in set(zip(doc_of.tolist(), window.tolist(), strict=True)):
                    items.setdefault(d, set()).update(block.names[i] for i in block.items[w])
                cut = np.searchsorted(hit, words.first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([r[0] for r in some], pa.int64()),
                        pa.array([r[1] for r in some], pa.int64()),
                        pa.array(np.diff(words.first)),
                        pa.array([(hit[a:b] - f).tolist() for a, b, f in zip(cut[:-1], cut[1:], words.first[:-1], strict=True)], pa.list_(pa.int32())),
                        pa.array([sorted(items.get(d, ())) for d in range(len(some))], pa.list_(pa.string())),
                    ],
                    ["doc_id", "key", "n_words", "hits", "items"],
                )

    rows = docs.select(F.col("doc_id").cast("long"), row_key().alias("key"), F.col("text").cast("binary"))
    return rows.mapInArrow(lean(find), "doc_id long, key long, n_words long, hits array<int>, items array<string>")


def decontaminate(docs: DataFrame, items: DataFrame, most_bytes: int = MOST_BYTES) -> DataFrame:
    """doc_id, key (common.row_key), n_words, n_hit, n_items, items_sha256, contaminated of every row of docs."""
    found = None
    for block in _blocks(items, most_bytes):
        if len(block.names) and block.keys:
            _count(docs, block)
            block.choose()
        else:
            block.choose()
        one = _hits(docs, block)
        if found is None:
            found = one
        else:
            if "more" not in found.columns:
                found, more = found.withColumn("more", F.lit(True)), None
            more = written(one.where(F.size("hits") > 0).dropDuplicates(["doc_id", "key"]).select("key", F.col("doc_id").alias("_id"), F.col("hits").alias("_hits"), F.col("items").alias("_items")), "hits")
            found = found.join(more.withColumnRenamed("key", "_key"), (F.col("key") == F.col("_key")) & F.col("doc_id").eqNullSafe(F.col("_id")), "left").select(
                "doc_id", "key", "n_words", F.array_union("hits", F.coalesce("_hits", F.array().cast("array<int>"))).alias("hits"), F.array_union("items", F.coalesce("_items", F.array().cast("array<string>"))).alias("items"), "more"
            )
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "key", "n_words", n_hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"),
    )


def brute(doc: str | None, items: dict[str, str | None]) -> tuple[int, int, list[str]]:
    """n_words, n_hit and items of one document, the plain way; for tests."""
    import re

    split = lambda t: re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    words, hit, found = split(doc), set(), set()
    for k, t in items.items():
        item = split(t)
        n = min(WIDTH, len(item))
        for i in range(len(item) - n + 1) if n else ():
            for s in range(len(words) - n + 1):
                if words[s : s + n] == item[i : i + n]:
                    hit.update(range(s, s + n))
                    found.add(k)
    return len(words), len(hit), sorted(found)


def items_digest(items: list[str]) -> str:
    return hashlib.sha256(",".join(sorted(items)).encode()).hexdigest()


ORACLE = """
with dw as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
iw as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark where item_id is not null),
win as (select item, least(10, len(w)) as n, array_to_string(w[s : s + least(10, len(w)) - 1], ' ') as body from (select item, w, unnest(range(1, greatest(2, len(w) - 8))) as s from iw where len(w) > 0)),
sizes as (select distinct n from win),
dwin as (select doc_id, s, n, array_to_string(w[s : s + n - 1], ' ') as body from (select doc_id, w, n, unnest(range(1, len(w) - n + 2)) as s from dw, sizes where len(w) >= n)),
hits as (select doc_id, s, dwin.n, item from dwin join win using (n, body)),
pos as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(s, s + n)) as p from hits) group by 1),
its as (select doc_id, list_sort(list(distinct item)) as items from hits group by 1)
select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_hit, 0) as n_hit, cast(coalesce(len(items), 0) as bigint) as n_items,
       sha256(coalesce(array_to_string(items, ','), '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from dw left join pos using (doc_id) left join its using (doc_id)
"""
