"""Alignment of two tokenizers' tokens, with corpus-wide counts of aligned id pairs.

A text's tokens by a byte-level tokenizer (A, of a space and the text) and by a sentencepiece model (B,
of the text; it adds that space) cover the same bytes.  Offsets where tokens of both end cut them into
groups; the A token and the B token that end there are a link.

1. Every task encodes its texts.  Both tokenizers treat each space-led word by itself (checked when they
   are loaded; else texts stay whole), so a word is encoded and aligned once and then looked up.  A row
   holds its text's sizes, the digest of its groups, and its distinct link keys with their numbers.  A key
   packs the B id in its upper 32 bits and the A id in the lower, so all pairs of a B id are neighbours.
2. Partial counts by np.unique in every task; a global sort by key ranges; runs of equal keys are summed.
   Each range becomes a shard in the shared folder: its sorted keys, then their counts.
3. Tasks map the shards they need into memory and look keys up by binary search, so the lookup shuffles
   nothing and no key is hot.  What the driver holds is a line for each shard and the highest count of
   each B id, bounded by B's vocabulary.

Texts that are null or empty, or whose A or B bytes joined aren't a space and the text (such as those
that hold U+2581), have no tokens: zeros, and '' for the digest.  Every row gives one row, repeated and
null ids too; other columns are not read.  Where the shared folder isn't a file system that can be mapped,
shards are read whole by the tasks that need them.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyarrow import fs as files
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HELD, chunks, lean, shared_dir, written

#: Keys that a task sums at once, and words that a worker remembers, of LONGEST characters on average.
MOST_KEYS, MOST_WORDS, LONGEST = 2_000_000, 60_000, 40

#: A space and what follows it, up to a space behind a character that isn't white space.
_WORD = re.compile(r" (?:[^ ]+|(?<=\s) )*")

_LOADED: dict[tuple[str, str], Pair] = {}
_KNOWN: dict[str, int] = {}  # rows of words in the table
_TABLE: dict[str, Aligned] = {}
HELD += [_LOADED, _KNOWN, _TABLE]


def _byte_level() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for themselves, the rest in order from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class Pair:
    """Both tokenizers, the bytes of their tokens, and whether words may be encoded one by one."""

    def __init__(self, a_path: str, b_path: str):
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = b = SentencePieceProcessor(model_file=b_path)
        byte = _byte_level()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for t, i in vocabulary.items():
            self.a_bytes[i] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        pre = json.loads(self.a.to_str())
        by_word = pre["normalizer"] is None and (pre["pre_tokenizer"] or {}).get("type") == "ByteLevel" and pre["pre_tokenizer"]["use_regex"] and not pre["pre_tokenizer"]["add_prefix_space"]
        crossing = any(re.search("[^▁]▁", p) for p in pieces)
        same = [b.encode(x) for x in ("a  b", "a", "b", " b")]  # a leading space is added, and spaces are kept
        self.by_word = bool(by_word and not crossing and same[0] == same[1] + same[3] and b.id_to_piece(same[1][0]).startswith("▁"))
        self.blank = b.encode("a ")[len(same[1]) :]  # of a last space
        self.a_size, self.b_size = (np.array([len(x) for x in of], np.int64) for of in (self.a_bytes, self.b_bytes))
        self.ids = max(len(self.a_size), len(self.b_size))
        self.shown = [f"{i}{c}" for c in ",|;" for i in range(self.ids)]

    def words(self, text: str) -> list[str]:
        return _WORD.findall(" " + text) if self.by_word else [" " + text]

    def align(self, words: list[str]) -> Aligned:
        """Words that end in no white space are encoded together, as one text, and cut apart again."""
        fine = [i for i, w in enumerate(words) if "▁" not in w]  # that bytes differ there is certain
        joined = [i for i in fine if self.by_word and not words[i][-1].isspace()]
        parts: list[tuple[list[int], Aligned]] = []
        for some in chunks(joined, size=lambda i: len(words[i]), most=1 << 16):
            parts += [(some, got)] if (got := self.cut([words[i] for i in some])) else [([i], one) for i in some if (one := self.cut([words[i]]))]
        parts += [([i], one) for i in sorted({*fine}.difference(joined)) if (one := self.cut([words[i]]))]
        out = Aligned(np.full((len(words), 3), -1, np.int64), np.zeros(len(words), np.int64), np.concatenate([np.zeros(0, np.int64), *(x.keys for _, x in parts)]), [""] * len(words))
        at = 0
        for some, x in parts:
            out.size[some], out.first[some] = x.size, x.first + at
            at += len(x.keys)
            for i, text in zip(some, x.shown, strict=True):
                out.shown[i] = text
        return out

    def cut(self, words: list[str]) -> Aligned | None:
        """Both encodings of words put together, word by word; None where their bytes aren't the text's or tokens go over words."""
        text = "".join(words)
        a, b = self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(text[1:]) or self.blank
        if not b"".join(map(self.a_bytes.__getitem__, a)) == text.encode() == b"".join(map(self.b_bytes.__getitem__, b)):
            return None
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.cumsum([len(w) if w.isascii() else len(w.encode()) for w in words])
        both = a_end[b_end[np.minimum(np.searchsorted(b_end, a_end), len(b_end) - 1)] == a_end]
        i, j = np.searchsorted(a_end, both), np.searchsorted(b_end, both)
        k = np.searchsorted(both, ends)
        if len(both) == 0 or (both[np.minimum(k, len(both) - 1)] != ends).any():
            return None
        # a group is its A tokens, then its B tokens; each with the mark that follows it
        rank = np.concatenate((2 * np.searchsorted(both, a_end), 2 * np.searchsorted(both, b_end) + 1))
        shown = np.concatenate((a, b))
        shown[i] += self.ids
        shown[len(a) + j] += 2 * self.ids
        parts = list(map(self.shown.__getitem__, shown[np.argsort(rank, kind="stable")].tolist()))
        stops = np.stack((i[k] + 1, j[k] + 1, k + 1))
        begin = np.concatenate((np.zeros((3, 1), np.int64), stops[:, :-1]), axis=1)
        at = (begin[0] + begin[1]).tolist()
        return Aligned((stops - begin).T, begin[2], b[j] << 32 | a[i], ["".join(parts[p:q])[:-1] for p, q in zip(at, [*at[1:], len(parts)], strict=True)])


@dataclass
class Aligned:
    """Of each word: numbers of A tokens, B tokens and groups (-1 where bytes differ), where its link keys begin, and its groups as text."""

    size: np.ndarray
    first: np.ndarray
    keys: np.ndarray
    shown: list[str]

    def __add__(self, more: Aligned) -> Aligned:
        return Aligned(np.concatenate((self.size, more.size)), np.concatenate((self.first, more.first + len(self.keys))), np.concatenate((self.keys, more.keys)), self.shown + more.shown)


def _pair(a_path: str, b_path: str) -> Pair:
    if (a_path, b_path) not in _LOADED:
        _LOADED[a_path, b_path] = Pair(a_path, b_path)
    return _LOADED[a_path, b_path]


def _aligned(pair: Pair, words: list[str]) -> tuple[np.ndarray, Aligned]:
    """`align` of distinct words (and their rows in it), those met before from memory; the first MOST_WORDS words are remembered."""
    row = np.fromiter((_KNOWN.get(w, -1) for w in words), np.int64, len(words))
    new = np.flatnonzero(row < 0)
    fresh = [words[i] for i in new.tolist()]
    have, got = _TABLE.get("words"), pair.align(fresh)
    row[new] = np.arange(len(new)) + (len(have.shown) if have else 0)
    table = have + got if have else got
    if len(table.shown) <= MOST_WORDS and sum(map(len, fresh)) <= LONGEST * max(1, len(fresh)):
        _TABLE["words"] = table
        _KNOWN.update(zip(fresh, row[new].tolist(), strict=True))
    return row, table


def _spread(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places first[i], first[i] + 1, .. size[i] of them, for each i in turn."""
    before = np.cumsum(size) - size
    return np.repeat(first - before, size) + np.arange(int(size.sum()))


def align(docs: DataFrame, a_path: str, b_path: str, with_groups: bool = False) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, keys (distinct link keys), times (of each), and the groups as text if asked for."""
    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, keys array<long>, times array<long>" + ", groups string" * with_groups

    def run(batches):
        pair = _pair(a_path, b_path)
        for batch in batches:
            for rows in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), size=lambda r: len(r[1] or ""), most=4 << 20):
                each = [pair.words(text) if text else [] for _, text in rows]
                words = list(dict.fromkeys(chain.from_iterable(each)))
                row, known = _aligned(pair, words)
                at = dict(zip(words, row.tolist(), strict=True))
                docs = [np.fromiter(map(at.__getitem__, words), np.int64, len(words)) for words in each]
                del each, words, at
                bad, size, first, keys, shown = known.size[:, 0] < 0, known.size, known.first, known.keys, known.shown
                out: list[list] = [[] for _ in range(5)]
                for words in docs:
                    words = words[:0] if bad[words].any() else words
                    text = ";".join([shown[i] for i in words.tolist()])
                    mine = np.unique(keys[_spread(first[words], size[words, 2])], return_counts=True)
                    for to, x in zip(out, (size[words].sum(0), hashlib.sha256(text.encode()).hexdigest() if text else "", *mine, text), strict=True):
                        to.append(x)
                totals = np.array(out[0], np.int64).reshape(-1, 3)
                ends = pa.array(np.concatenate(([0], np.cumsum([len(x) for x in out[2]]))), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(x), pa.int64())) for x in out[2:4]]
                columns = [pa.array([i for i, _ in rows], pa.int64()), *(pa.array(totals[:, i]) for i in range(3)), pa.array(out[1], pa.string()), *lists]
                names = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "keys", "times"]
                if with_groups:
                    columns, names = [*columns, pa.array(out[4], pa.string())], [*names, "groups"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(run, keep=True), schema)


def summed(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and the sum of n of each."""
    distinct, at = np.unique(keys, return_inverse=True)
    total = np.zeros(len(distinct), np.int64)
    np.add.at(total, at, n)
    return distinct, total


def partial_counts(aligned: DataFrame) -> DataFrame:
    """key, n: sums over each task's rows; a key may come again where a task has very many."""

    def run(batches):
        parts, size = [], 0
        for batch in batches:
            parts.append(summed(batch.column(0).flatten().to_numpy(), batch.column(1).flatten().to_numpy()))
            size += len(parts[-1][0])
            if size > MOST_KEYS:
                parts = [summed(*map(np.concatenate, zip(*parts, strict=True)))]
                size = len(parts[0][0])
                if size > MOST_KEYS // 2:
                    yield pa.RecordBatch.from_arrays([pa.array(x) for x in parts.pop()], ["key", "n"])
                    size = 0
        if parts:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in summed(*map(np.concatenate, zip(*parts, strict=True)))], ["key", "n"])

    return aligned.select("keys", "times").where(F.size("keys") > 0).mapInArrow(lean(run), "key long, n long")


def runs(parts: Iterable[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Sorted keys with numbers, in pieces, as distinct keys with sums; a run that goes over a border is one."""
    last = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for keys, n in parts:
        keys, n = np.concatenate((last[0], keys)), np.concatenate((last[1], n))
        if len(keys):
            start = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
            keys, n = keys[start], np.add.reduceat(n, start)
            yield keys[:-1], n[:-1]
            last = keys[-1:], n[-1:]
    yield last


def _opened(uri: str) -> tuple[files.FileSystem, str]:
    return files.FileSystem.from_uri(uri)


class Shards:
    """Sorted count shards: `of` gives the corpus-wide counts of keys; what it reads is mapped, not loaded."""

    def __init__(self, lows: np.ndarray, uris: list[str], best: np.ndarray):
        self.lows, self.uris, self.best, self.maps = lows, uris, best, {}

    def shard(self, i: int) -> np.ndarray:
        if i not in self.maps:
            system, path = _opened(self.uris[i])
            if isinstance(system, files.LocalFileSystem):
                flat = np.memmap(path, np.int64, "r")
            else:
                with system.open_input_file(path) as f:
                    flat = np.frombuffer(f.readall(), np.int64)
            self.maps[i] = flat.reshape(2, -1)
        return self.maps[i]

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Counts of sorted keys, all of which are in the shards."""
        out = np.zeros(len(keys), np.int64)
        where = np.searchsorted(self.lows, keys, side="right") - 1
        for i in np.unique(where):
            a, b = np.searchsorted(where, (i, i + 1))
            have = self.shard(int(i))
            out[a:b] = have[1][np.searchsorted(have[0], keys[a:b])]
        return out


def count_shards(partials: DataFrame, shards: int | None = None) -> Shards:
    """Shards of key ranges (as many as asked for, else as Spark sees fit) in the shared folder.  A task that runs again writes a file of its own; the table of shards names those that count."""
    folder = f"{shared_dir(partials.sparkSession)}/celldex/shards-{uuid.uuid4().hex}"
    schema = "low long, uri string, b array<long>, most array<long>"

    def run(batches):
        parts = list(runs((b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches))
        keys, n = map(np.concatenate, zip(*parts, strict=True))
        if len(keys):
            uri = f"{folder}/{TaskContext.get().partitionId():06d}-{uuid.uuid4().hex}"
            system, path = _opened(uri)
            system.create_dir(path.rpartition("/")[0], recursive=True)
            with system.open_output_stream(path) as f:
                f.write(keys.tobytes())
                f.write(n.tobytes())
            b = keys >> 32
            start = np.flatnonzero(np.concatenate(([True], b[1:] != b[:-1])))
            row = [pa.array([int(keys[0])]), pa.array([uri]), pa.array([b[start]]), pa.array([np.maximum.reduceat(n, start)])]
            yield pa.RecordBatch.from_arrays(row, ["low", "uri", "b", "most"])

    ranges = partials.repartitionByRange(*([shards] if shards else []), "key").sortWithinPartitions("key")
    table = written(ranges.mapInArrow(lean(run), schema), "shards").orderBy("low").toArrow()  # a line a shard; of B ids, no more than there are
    ids, most = (table[c].combine_chunks().flatten().to_numpy() for c in ("b", "most"))
    best = np.zeros(int(ids.max(initial=-1)) + 1, np.int64)
    np.maximum.at(best, ids, most)
    return Shards(table["low"].to_numpy(), table["uri"].to_pylist(), best)


def with_counts(aligned: DataFrame, shards: Shards) -> DataFrame:
    """n_links, n_best and count_sum in place of the keys."""
    share = aligned.sparkSession.sparkContext.broadcast(shards)
    kept = ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256"]

    def run(batches):
        shards = share.value
        for batch in batches:
            keys, times = (batch.column(i).flatten().to_numpy() for i in (5, 6))
            size = np.diff(batch.column(5).offsets.to_numpy())
            distinct, at = np.unique(keys, return_inverse=True)
            count = shards.of(distinct)
            best = count == shards.best[distinct >> 32] if len(distinct) else np.zeros(0, bool)
            row = np.repeat(np.arange(len(size)), size)
            sums = []
            for each in (times, times * best[at], times * count[at]):
                total = np.zeros(len(size), np.int64)
                np.add.at(total, row, each)
                sums.append(pa.array(total))
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(5)), *sums], [*kept, "n_links", "n_best", "count_sum"])

    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, n_links long, n_best long, count_sum long"
    return aligned.select(*kept, "keys", "times").mapInArrow(lean(run), schema)


def token_alignment(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, groups_sha256, n_links, n_best, count_sum of every row."""
    aligned = written(align(docs, a_path, b_path), "aligned")
    return with_counts(aligned, count_shards(written(partial_counts(aligned), "pairs")))
