"""Shared helpers of the training-data operators: tables, shared folder, row keys, word kernels.

Word kernels work on the UTF-8 bytes of many texts at once.  A batch of texts is joined by a
separator byte that no word contains, so word borders, word hashes and n-gram hashes come from a
few numpy passes whatever the number of texts.
"""

from __future__ import annotations

import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import shared_dir, table  # noqa: F401  (the operators take them from here)

#: Texts are handed to the kernels in pieces of about this many bytes.
CHUNK_BYTES = 1 << 20

#: Most rows and bytes of a batch for Python, in what `written` runs; a batch ends at the first text that passes either.
BATCH, BATCH_BYTES = 2048, 2 << 20

SPACES = b" \t\n\x0b\x0c\r"


def written(df: DataFrame, what: str) -> DataFrame:
    """df as a Parquet table in the shared folder, read again: lineage ends there and survives lost executors.

    Python gets batches of `BATCH` rows or `BATCH_BYTES` meanwhile, so that a partition of texts isn't one batch.  Shuffles of df
    are removed as soon as it is written; else they stay until the driver collects its garbage, however many they are.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/celldex/{what}-{uuid.uuid4().hex}"
    with small_batches(spark, BATCH), no_shuffles_left(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def set_batches(spark: SparkSession, rows: int = BATCH, size: int = BATCH_BYTES) -> dict[str, str]:
    """From now on a batch for Python has no more rows, and about no more bytes, than these; gives the settings as they were."""
    was = {}
    for name, most in (("spark.sql.execution.arrow.maxRecordsPerBatch", rows), ("spark.sql.execution.arrow.maxBytesPerBatch", size)):
        was[name] = spark.conf.get(name)
        have = was[name].strip().lower().removesuffix("b")
        if not have.lstrip("-").isdecimal() or not 0 < int(have) <= most:
            spark.conf.set(name, most)
    return was


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int = 256) -> Iterator[None]:
    """While rows are large, for what runs inside: fewer of them at once go to Python."""
    was = set_batches(spark, rows)
    try:
        yield
    finally:
        for name, value in was.items():
            spark.conf.set(name, value)


@contextlib.contextmanager
def no_shuffles_left(spark: SparkSession) -> Iterator[None]:
    """What is run inside removes its shuffles when it ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    was = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if was is None else spark.conf.set(name, was)


def hand_back() -> None:
    """Memory that this process has freed goes back to the system."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError):  # another C library
        ctypes.CDLL(None).malloc_trim(0)


#: Caches that workers hold between tasks; tasks that don't use them empty them.
HELD: list[dict] = []


def lean(f: Callable, keep: bool = False) -> Callable:
    """f for mapInArrow; a worker that waits, or runs another task, keeps nothing of what came before, but caches if asked to."""

    def run(batches):
        for cache in [] if keep else HELD:
            cache.clear()
        hand_back()
        yield from f(batches)
        hand_back()

    return run


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """64 bits by which rows of one id and one text agree; joins on it also compare the ids, null-safe."""
    return F.xxhash64(F.col(doc_id), F.col(doc_id).isNull(), F.col(text), F.col(text).isNull())


def in_train(doc_id: str = "doc_id") -> Column:
    """Whether labels of a document may be learned from: crc32 of its id as text, modulo 4, is not 2."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 != 2


def chunks(items: Iterable, size=len, most: int = CHUNK_BYTES) -> Iterator[list]:
    """Lists of items of about `most` in total size."""
    out, total = [], 0
    for x in items:
        out.append(x)
        total += size(x) + 1
        if total >= most:
            yield out
            out, total = [], 0
    if out:
        yield out


def _class_table(keep) -> np.ndarray:
    return np.array([keep(i) for i in range(256)], dtype=bool)


#: Bytes of words [^\x20\x09-\x0D]+, and of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing.
PLAIN = _class_table(lambda i: i not in SPACES)
ALNUM = _class_table(lambda i: 0x30 <= i <= 0x39 or 0x61 <= i <= 0x7A or i >= 0x80)
_LOWER = np.array([i + 32 if 65 <= i <= 90 else i for i in range(256)], dtype=np.uint8)
_BYTE, _BYTE_2 = np.random.default_rng(7).integers(1, 1 << 63, (2, 256), dtype=np.uint64) | np.uint64(1)
_BASES = {"byte": 0x9E3779B97F4A7C15, "word": 0xD6E8FEB86659FD93}
_POWERS: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit sways every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _powers(kind: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n-1 of an odd base modulo 2**64, and of its inverse."""
    have = _POWERS.get(kind)
    if have is None or len(have[0]) < n:
        size = 1 << max(16, int(n - 1).bit_length())
        base = _BASES[kind]
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _POWERS[kind] = (out[0], out[1])
    return have


def _spans(values: np.ndarray, kind: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Polynomial hash of values[start:end] for each pair, whatever its place."""
    up, down = _powers(kind, len(values) + 1)
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * up[: len(values)], out=total[1:])
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


class Words:
    """Words of a batch of texts: `hash` of each, `first[i]:first[i+1]` are those of text i.

    If asked for, `other` has a second hash of each, by other random values of bytes.
    """

    def __init__(self, texts: list[bytes], kind: np.ndarray = PLAIN, lower: bool = False, two: bool = False):
        buf = np.frombuffer(b"\n".join(texts) + b"\n", dtype=np.uint8)
        if lower:
            buf = _LOWER[buf]
        edge = np.diff(np.concatenate(([0], kind[buf].view(np.int8), [0])))
        start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        begin = np.zeros(len(texts) + 1, dtype=np.int64)
        np.cumsum([len(t) + 1 for t in texts], out=begin[1:])
        self.first = np.searchsorted(start, begin)
        self.hash = _spans(_BYTE[buf], "byte", start, end) if len(start) else np.zeros(0, np.uint64)
        self.other = _spans(_BYTE_2[buf], "byte", start, end) if two and len(start) else np.zeros(0, np.uint64)
        self.end = np.repeat(self.first[1:], np.diff(self.first))  # of each word's text, in words

    def grams(self, n: int, start: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Starts of runs of n words within one text (or those given), and the runs' hashes."""
        if start is None:
            start = np.arange(len(self.hash))
            start = start[start + n <= self.end]
        return start, self.spans(start, start + n)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return _spans(self.hash, "word", start, end)

    def others(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """`spans` by the second hashes."""
        return _spans(self.other, "word", start, end)


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def most_frequent(rows: DataFrame, n: str, most: int) -> DataFrame:
    """The rows of the greatest n, `most` of them or fewer, without a sort: whole steps of an eighth of a doubling."""
    level = F.floor(F.log2(F.col(n)) * 8).cast("int")
    total, least = 0, None
    for r in rows.groupBy(level.alias("level")).agg(F.count("*").alias("rows")).orderBy(F.desc("level")).collect():
        if (total := total + r["rows"]) > most:
            break
        least = r["level"]
    return rows.where(F.lit(False) if least is None else level >= least)


class Membership:
    """A set of 64-bit keys as a bitmap of capped size, for filters ahead of an exact join.

    Keys in the set always pass; of others one in hundreds, more once the cap is reached.
    Only the work of the later join depends on that, never its result.
    """

    MOST_BITS = 1 << 27

    def __init__(self, words: np.ndarray, bits: int):
        self.words, self.mask, self.shift = words, np.uint64(bits - 1), np.uint64(64 - bits.bit_length() + 1)

    @classmethod
    def of(cls, keys: DataFrame, key: str, n: int) -> Membership:
        bits = min(cls.MOST_BITS, 1 << max(10, int(32 * n).bit_length()))
        low = F.col(key).bitwiseAND(F.lit(bits - 1))
        high = F.shiftrightunsigned(F.col(key), 64 - bits.bit_length() + 1)
        rows = (
            keys.select(F.explode(F.array(low, high)).alias("at"))
            .groupBy(F.shiftright("at", 6).cast("int").alias("word"))
            .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 as int))")).alias("bits"))
            .toArrow()
        )
        words = np.zeros(max(1, bits >> 6), dtype=np.uint64)
        words[rows["word"].to_numpy()] = rows["bits"].to_numpy().view(np.uint64)
        return cls(words, bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        one, six, low6 = np.uint64(1), np.uint64(6), np.uint64(63)
        ok = np.ones(len(keys), dtype=bool)
        for at in (keys & self.mask, keys >> self.shift):
            ok &= (self.words[(at >> six).astype(np.int64)] >> (at & low6)) & one != 0
        return ok
