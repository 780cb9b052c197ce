"""Packing of token sequences by non-negative least squares over length combinations.

1. Tasks tokenize whole texts (ids of the library, then `END`), cut each document after every
   `WINDOW` ids, and number the remaining pieces of each length within the task.
2. The histogram of those lengths (at most WINDOW - 1 numbers) goes to the driver.  Lengths are put in
   bins of `BIN`; all combinations of up to `DEPTH` bins that fill a window are enumerated, and the
   repeat counts that explain the histogram best are found by non-negative least squares, scaled to what
   there is, rounded down, and solved again for the rest.  Their windows take actual lengths, the
   longest of a bin first and the last one to fit; more than half of the pieces are placed so.
3. What is left is packed greedily: it tops up those windows, then fills others, longest first, into
   the fullest that has room.
   The plan is a table of runs: pieces of one length with numbers from a to b go to windows
   s, s + 1, ... at one offset.  Its size depends on WINDOW, not on the number of documents.
4. Each piece finds its run by its length and number; nothing is sorted or gathered by document.

Null text is empty and has the one id END.  Every row is a document of its own, repeated ids too.
"""

from __future__ import annotations

import os
import zlib
from bisect import bisect_left, bisect_right, insort
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import HELD, lean, written

WINDOW, END, BIN, DEPTH, ROUNDS = 4096, 2, 64, 5, 8
#: Combinations are fitted to this share of each bin; the rest fills what they leave open.
KEEP = 0.7
MOST_CACHED, TOGETHER = 100_000, 2 << 20

#: Latin-1 letters, then ASCII marks: at most two pre-tokens, whatever the tokenizer's normaliser does.
_PLAIN = r"^(?P<head>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{FF}]+)(?P<mark>[!-/:-@\[-`{-~]*)$"
_LOADED: dict[str, Encoder] = {}
HELD.append(_LOADED)


class Recent:
    """The words of late and their ids: two dictionaries of about `most` each, of which the older one goes when the newer is full."""

    def __init__(self, most: int):
        self.most, self.young, self.old = most, {}, {}

    def get(self, word: str) -> bytes | None:
        got = self.young.get(word)
        if got is None and (got := self.old.get(word)) is not None:
            self.young[word] = got
        return got

    def unknown(self, words: set[str]) -> set[str]:
        """Those of the words that aren't held; all others are in `young` from now on."""
        rest = words.difference(self.young)
        back = rest.intersection(self.old)
        self.young.update((w, self.old[w]) for w in back)
        return rest - back

    def turn(self) -> None:
        if len(self.young) > self.most:
            self.young, self.old = {}, self.young


class Ragged:
    """Lists of numbers, one after the other: list i is items[first[i] : first[i + 1]]."""

    def __init__(self, items: np.ndarray, sizes: np.ndarray):
        self.items, self.first = items, np.concatenate(([0], np.cumsum(sizes)))

    @classmethod
    def of(cls, bodies: list[bytes]) -> Ragged:
        return cls(np.frombuffer(b"".join(bodies), "<u4"), np.fromiter(map(len, bodies), np.int64, len(bodies)) // 4)

    def take(self, at: np.ndarray) -> Ragged:
        sizes = (self.first[1:] - self.first[:-1])[at]
        out = Ragged(self.items, sizes)
        out.items = self.items[np.repeat(self.first[at] - out.first[:-1], sizes) + np.arange(out.first[-1])]
        return out


class Encoder:
    """Ids of texts, as little-endian 32-bit bytes, by their distinct words and a cache of bounded size.

    The tokenizer drops white space and lets no pre-token cross it, so a text's ids are its words'.  A
    word of letters with marks behind it has the ids of the letters in lower case, then those of the marks.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.heads, self.others = Recent(MOST_CACHED), Recent(MOST_CACHED // 2)
        self.ends = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)  # ids that end a pre-token
        self.ends[[i for t, i in self.tokenizer.get_vocab().items() if t.endswith("</w>")]] = True

    def _library(self, words: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _single(self, words: list[str]) -> list[bytes]:
        """Of words that are one pre-token each: they are encoded as texts of many words, and cut where a pre-token ends."""
        out: list[bytes] = []
        for a in range(0, len(words), 2000):
            some = words[a : a + 2000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            cut = np.flatnonzero(self.ends[ids]) + 1
            if len(cut) == len(some):
                body, at = ids.tobytes(), [0, *(4 * cut).tolist()]
                out += [body[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]
            else:
                out += self._library(some)
        return out

    def _ids(self, words: list[str], held: Recent, encode) -> Ragged:
        new = list(held.unknown(set(words)))
        held.young.update(zip(new, encode(new), strict=True))
        return Ragged.of(list(map(held.young.__getitem__, words)))

    def texts(self, texts: pa.Array | list[str]) -> list[bytes]:
        split = pc.ascii_split_whitespace(pa.array(texts, pa.large_string()) if isinstance(texts, list) else texts.cast(pa.large_string()))
        words = split.flatten().dictionary_encode()
        got = pc.extract_regex(words.dictionary, _PLAIN)
        plain = got.is_valid().to_numpy(zero_copy_only=False)
        head, mark = pc.utf8_lower(got.field("head").filter(got.is_valid())).dictionary_encode(), got.field("mark").filter(got.is_valid()).dictionary_encode()
        rest = words.dictionary.filter(got.is_null())
        self.heads.turn()
        self.others.turn()
        heads = self._ids(head.dictionary.to_pylist(), self.heads, self._single)
        others = self._ids(mark.dictionary.to_pylist() + rest.to_pylist(), self.others, self._library)
        # Each distinct word is two lists: its head and mark, or an empty one and itself.
        both = Ragged(np.concatenate((heads.items, others.items)), np.concatenate((np.diff(heads.first), np.diff(others.first), [0])))
        n, m = len(heads.first) - 1, len(mark.dictionary)
        at = np.full((len(plain), 2), len(both.first) - 2)
        at[plain, 0], at[plain, 1] = head.indices.to_numpy(), n + mark.indices.to_numpy()
        at[~plain, 1] = n + m + np.arange(len(rest))
        each = both.take(at.ravel())
        each.first = each.first[::2]
        ids = each.take(words.indices.to_numpy())
        body, cut = ids.items.tobytes(), (4 * ids.first[split.offsets.to_numpy() - split.offsets[0].as_py()]).tolist()
        return [body[i:j] for i, j in zip(cut[:-1], cut[1:], strict=True)]


def encoder(path: str) -> Encoder:
    if path not in _LOADED:
        _LOADED[path] = Encoder(path)
    return _LOADED[path]


def combinations(n: int, depth: int) -> list[tuple[int, ...]]:
    """Non-increasing tuples of up to `depth` whole numbers from 1 to n whose sum is n."""
    out: list[tuple[int, ...]] = []

    def grow(head: tuple[int, ...], left: int, most: int) -> None:
        if not left:
            out.append(head)
        elif len(head) < depth:
            for x in range(min(left, most), 0, -1):
                if x * (depth - len(head)) >= left:
                    grow((*head, x), left - x, x)

    grow((), n, n)
    return out


def nnls(a: np.ndarray, b: np.ndarray, steps: int = 400) -> np.ndarray:
    """x >= 0 that minimises |a x - b|, by an active set that grows by the steepest column."""
    x, on = np.zeros(a.shape[1]), np.zeros(a.shape[1], bool)
    for _ in range(steps):
        slope = a.T @ (b - a @ x)
        slope[on] = -np.inf
        j = int(slope.argmax())
        if slope[j] <= 1e-9 * max(1.0, np.abs(b).max()):
            break
        on[j] = True
        while True:
            at = np.flatnonzero(on)
            z = np.linalg.lstsq(a[:, at], b, rcond=None)[0]
            if (z > 0).all():
                x[:] = 0
                x[at] = z
                break
            low = z <= 0
            share = np.min(x[at][low] / np.maximum(x[at][low] - z[low], 1e-300))
            x[at] += share * (z - x[at])
            on[at[(x[at] <= 1e-12) & low]] = False
            x[~on] = 0
    return x


def repeats(a: np.ndarray, hist: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """How often to use each combination (column of a): whole numbers x with a x <= hist, near the least squares.

    What non-negative least squares asks of a length beyond its count scales its combinations down; x is
    rounded down, and what is left of the histogram is solved again.
    """
    x, left = np.zeros(a.shape[1], np.int64), hist.astype(float)
    for _ in range(rounds):
        want = nnls(a, left)
        share = np.minimum(1.0, np.divide(left, a @ want, out=np.ones(len(left)), where=a @ want > 0))
        least = np.where(a > 0, share[:, None], 1.0).min(axis=0)
        step = np.floor(want * least + 1e-9).astype(np.int64)
        x += step
        left = hist - a @ x
        if step.sum() <= x.sum() // 200:
            break
    return x


def plan(counts: np.ndarray, window: int = WINDOW, width: int = BIN, depth: int = DEPTH) -> tuple[list[tuple[int, int, int, int, int]], int]:
    """Runs (length, from, to, sequence, offset) that place counts[l] pieces of each length l < window; the number of sequences."""
    return plan_of(counts, window, width, depth)[:2]


def plan_of(counts: np.ndarray, window: int = WINDOW, width: int = BIN, depth: int = DEPTH) -> tuple[list[tuple[int, int, int, int, int]], int, int]:
    """`plan`, and how many pieces combinations placed."""
    left, taken = counts.astype(np.int64).copy(), np.zeros(len(counts), np.int64)
    runs: list[tuple[int, int, int, int, int]] = []
    total = 0
    groups: list[tuple[int, int, int]] = []  # first sequence, how many, filled

    def put(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, int(taken[length]), int(taken[length]) + n, first, offset))
        taken[length] += n
        left[length] -= n

    bins = -(-np.arange(len(counts)) // width)
    n_bins = window // width
    if counts.sum():
        hist = np.bincount(bins, weights=counts, minlength=n_bins + 1)[1 : n_bins + 1]
        ways = [w for w in combinations(n_bins, depth) if hist[np.array(w) - 1].all()]
        a = np.zeros((n_bins, len(ways)))
        for j, way in enumerate(ways):
            for b in way:
                a[b - 1, j] += 1
        repeat = repeats(a, np.floor(KEEP * hist)) if ways else np.zeros(0, np.int64)
        of_bin = {b: [x for x in range(min(b * width, len(counts) - 1), (b - 1) * width, -1) if left[x]] for b in range(1, n_bins + 1)}
        for j in np.argsort(-repeat, kind="stable"):
            want = int(repeat[j])
            while want > 0:
                need: dict[int, int] = defaultdict(int)
                lengths = []
                for b in ways[j][:-1]:
                    if (x := next((x for x in of_bin[b] if left[x] > need[x]), 0)) == 0:
                        break
                    need[x] += 1
                    lengths.append(x)
                room = window - sum(lengths)
                last = next((x for x in range(min(room, len(counts) - 1), (ways[j][-1] - 1) * width, -1) if left[x] > need[x]), 0)
                if len(lengths) < len(ways[j]) - 1 or not last:
                    break
                need[last] += 1
                lengths.append(last)
                n = min(want, *(int(left[x]) // k for x, k in need.items() if k))
                offset = 0
                for x in lengths:
                    put(x, n, total, offset)
                    offset += x
                groups.append((total, n, offset))
                total += n
                want -= n
    planned = int(taken.sum())
    free = [x for x in range(1, len(counts)) if left[x]]

    def longest(room: int) -> int:
        """The longest length that is left and fits, or 0."""
        i = bisect_right(free, room)
        while i and not left[free[i - 1]]:
            free.pop(i - 1)
            i -= 1
        return free[i - 1] if i else 0

    gaps: list[int] = []
    open_at: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for first, n, filled in groups:  # topped up
        todo = [(first, n, filled)]
        while todo:
            first, n, filled = todo.pop()
            x = longest(window - filled)
            if not x:
                continue
            k = min(n, int(left[x]))
            put(x, k, first, filled)
            todo.append((first, k, filled + x))
            if n > k:
                todo.append((first + k, n - k, filled))
    for x in range(len(counts) - 1, 0, -1):  # the rest, best fit first
        while left[x]:
            i = bisect_left(gaps, x)
            if i == len(gaps):
                n = int(left[x])
                put(x, n, total, 0)
                first, gap = total, window - x
                total += n
            else:
                gap = gaps[i]
                first, have = open_at[gap].pop()
                n = min(have, int(left[x]))
                put(x, n, first, window - gap)
                if have > n:
                    open_at[gap].append((first + n, have - n))
                if not open_at[gap]:
                    gaps.pop(i)
                gap -= x
            if gap:
                if not open_at[gap]:
                    insort(gaps, gap)
                open_at[gap].append((first, n))
    return runs, total, planned


def together(batches: Iterator[pa.RecordBatch], most: int = TOGETHER) -> Iterator[pa.RecordBatch]:
    """Batches put together until they have about `most` bytes; none is empty."""
    some, size = [], 0
    for batch in batches:
        if len(batch):
            some.append(batch)
            size += batch.nbytes
        if size >= most:
            yield pa.concat_batches(some)
            some, size = [], 0
    if some:
        yield pa.concat_batches(some)


def pieces(docs: DataFrame, path: str) -> DataFrame:
    """The pieces, each with its task, and its number among those of its length there."""

    def cut(batches):
        task, code = TaskContext.get().partitionId(), encoder(path)
        seen = [0] * (WINDOW + 1)
        end = np.array([END], "<u4").tobytes()
        for some in together(batches):
            out = []
            for doc_id, body in zip(some.column(0).to_pylist(), code.texts(some.column(1)), strict=True):
                body += end
                n = len(body) // 4
                for s in range(0, n, WINDOW):
                    k = min(WINDOW, n - s)
                    out.append((doc_id, s, k, zlib.crc32(body[4 * s : 4 * (s + k)]), n, task, seen[k]))
                    seen[k] += 1
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "number"])

    return docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(lean(cut, keep=True), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, task long, number long")


def pack(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece."""
    cut = written(pieces(docs, path), "pieces")
    each = cut.groupBy("length", "task").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    each = written(each.withColumn("before", before), "numbers")
    counts = np.zeros(WINDOW + 1, np.int64)
    for r in each.groupBy("length").agg(F.sum("n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    whole = int(counts[WINDOW])
    runs, total = plan(counts[:WINDOW])
    runs.append((WINDOW, 0, whole, total, 0))
    table = np.array(sorted(r for r in runs if r[2] > r[1]) or [(0, 0, 0, 0, 0)], np.int64)
    share = docs.sparkSession.sparkContext.broadcast(table)

    def place(batches):
        t = share.value
        key = t[:, 0] << 48 | t[:, 1]
        for batch in batches:
            length, number = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            run = t[np.searchsorted(key, length << 48 | number, side="right") - 1]
            cols = [batch.column(c) for c in ("doc_id", "start", "length", "ids_crc32", "doc_tokens")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(run[:, 3] + number - run[:, 1]), pa.array(run[:, 4])], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    ranked = cut.join(each.select("length", "task", "before").hint("merge"), ["length", "task"]).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("number")).alias("rank"))
    return ranked.mapInArrow(lean(place), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
