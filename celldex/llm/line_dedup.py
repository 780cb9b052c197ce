"""Near-duplicate lines by a deletion-neighbourhood join, within an edit distance of one character.

Two lines are within one edit exactly if deleting one character at the same place leaves the same rest
(a changed character), or deleting one character of the longer leaves the shorter (an added one).
So every line's deletion variants are hashed, with the place for the former, and equal ones joined.

A long line has many variants, so a coarse round goes first: a line is cut into `PARTS` parts, and the
rest without one part is hashed.  An edit lies inside some part, so lines within one edit share a
coarse key, whose two sides must be different lines.  Only lines with such a key, and only deletions inside its
part, reach the fine round; that leaves out no pair.

1. Coarse keys of all lines; a grouped minimum and maximum of line hashes finds keys of two lines.
2. A bitmap of those keys picks candidate lines on a second reading of the texts.
3. Variants of candidates: a grouped minimum and maximum finds those of two lines, whose bitmap lets only
   such variants be shuffled with their places.  Grouped, they give the earliest line of each key.  No
   pair inside a group is made; a line only needs the earliest.  A key of a changed character joins its lines pairwise; in one of an
   added character the shorter line is within one edit of all others, so either side is compared with
   the earliest of the other.
4. The edit distance of each line and the earliest it met is verified on their texts.
5. The earliest of every distinct line stays, unless removed by 4; texts are put together again.

A line is removed if an earlier line, by (doc_id, line number), equals it or is within one edit of
it, whether or not that one stays.  The edit bound is one for lines of `FUZZY_FROM` characters or more and
none for shorter ones, of which one edit makes another word or number; it is the same at every size of input.
Lines are compared unchanged; lines of white space are never removed.  If every other line of a text
is removed, its text is empty.  Null text stays null and has no lines.  Null ids come first in order.
Rows that repeat an id and its text are one document, and stay alike.  Other columns are kept;
columns named n_lines and n_removed are replaced.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Membership, _powers, chunks, fresh, hand_back, lean, mix, row_key, signed, written

PARTS, FUZZY_FROM = 4, 16


def _digest(line: str) -> tuple[int, int]:
    h = xxhash.xxh3_128_intdigest(line.encode())
    return _signed(h & (1 << 64) - 1), _signed(h >> 64)


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def cuts(base: int, parts: int = PARTS) -> list[int]:
    return [base * i // parts for i in range(parts + 1)]


def coarse_keys(line: str) -> list[int]:
    """Of the line as one of its own length, then as one with a character more than its base."""
    out, n, hash64 = [], len(line), xxhash.xxh3_64_intdigest
    for base in (n, n - 1):
        c = cuts(base)
        for i in range(PARTS):
            rest = line[: c[i]] + "\n" + line[n - (base - c[i + 1]) :]
            out.append(hash64(rest.encode(), base * PARTS + i))
    return out


def _lines(text: str) -> list[tuple[int, str]]:
    return [(i, x) for i, x in enumerate(text.split("\n")) if x and not x.isspace()]


def _coarse(texts: DataFrame, fuzzy_from: int) -> DataFrame:
    """Coarse keys that two different lines share."""

    def keys(batches):
        for batch in batches:
            for some in chunks((t for t in batch.column(0).to_pylist() if t)):
                lines = {x for t in some for _, x in _lines(t) if len(x) >= fuzzy_from}
                key = np.array([k for x in lines for k in coarse_keys(x)], np.uint64)
                line = np.repeat(np.array([_digest(x)[0] for x in lines], np.int64), 2 * PARTS)
                yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array(line)], ["key", "line"])

    rows = texts.select("text").mapInArrow(lean(keys), "key long, line long")
    return rows.groupBy("key").agg(F.min("line").alias("a"), F.max("line").alias("b")).where("a <> b").select("key")


def _distinct(texts: DataFrame) -> DataFrame:
    """The earliest place of each distinct line: h1, h2, at (doc_id, number, key of the row)."""

    def lines(batches):
        for batch in batches:
            for some in chunks(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), size=lambda r: len(r[2]), most=8 << 20):
                first: dict[tuple[int, int], tuple] = {}
                for doc, key, text in some:
                    for i, x in _lines(text):
                        h, at = _digest(x), (doc, i, key)
                        if h not in first or _before(at, first[h]):
                            first[h] = at
                cols = list(zip(*[(*h, *at) for h, at in first.items()], strict=True)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], ["h1", "h2", "doc", "number", "key"])

    rows = texts.mapInArrow(lean(lines), "h1 long, h2 long, doc long, number long, key long")
    return rows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "number", "key")).alias("at"))


def _before(a: tuple, b: tuple) -> bool:
    low = lambda t: (t[0] is not None, t[0] or 0, *t[1:])
    return low(a) < low(b)


def _candidates(texts: DataFrame, coarse: DataFrame, fuzzy_from: int) -> DataFrame:
    """Distinct lines with a coarse key that another line has: h1, h2, at, line, parts (places of such keys)."""
    n = coarse.count()
    share = texts.sparkSession.sparkContext.broadcast(Membership.of(coarse, "key", n))

    def pick(batches):
        for batch in batches:
            for some in chunks(zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True), size=lambda r: len(r[2])):
                first: dict[str, tuple] = {}
                for doc, key, text in some:
                    for i, x in _lines(text):
                        if len(x) >= fuzzy_from and (x not in first or _before((doc, i, key), first[x])):
                            first[x] = (doc, i, key)
                lines = list(first)
                has = share.value.has(np.array([k for x in lines for k in coarse_keys(x)], np.uint64)).reshape(-1, 2 * PARTS)
                out = [(*_digest(lines[i]), *first[lines[i]], lines[i], np.flatnonzero(has[i]).tolist()) for i in np.flatnonzero(has.any(1))]
                cols = list(zip(*out, strict=True)) or [()] * 7
                kinds = (*[pa.int64()] * 5, pa.string(), pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["h1", "h2", "doc", "number", "key", "line", "parts"])

    rows = texts.mapInArrow(lean(pick), "h1 long, h2 long, doc long, number long, key long, line string, parts array<long>")
    return rows.groupBy("h1", "h2").agg(F.min(F.struct("doc", "number", "key")).alias("at"), F.min("line").alias("line"), F.min("parts").alias("parts"))


def variants(line: str, parts: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Keys and roles of the deletions inside the parts: 0 a changed character, 1 the shorter line, 2 the longer."""
    x = mix(np.frombuffer(line.encode("utf-32-le"), "<u4").astype(np.uint64) + np.uint64(0x51))
    n = len(x)
    up, down = _powers("byte", n + 1)
    head = np.zeros(n + 1, np.uint64)
    np.cumsum(x * up[:n], out=head[1:])
    tail = head[n] - head
    base_inverse = down[1]
    keys, roles = [], []
    for p in parts:
        longer, i = divmod(p, PARTS)
        c = cuts(n - longer)
        at = np.arange(c[i], c[i + 1] + longer)
        rest = head[at] + tail[at + 1] * base_inverse  # what is behind moves one place forward
        if longer:
            keys.append(mix(mix(rest) + np.uint64(n - 1)))
        else:
            keys.append(mix(mix(rest) + (at.astype(np.uint64) << np.uint64(32)) + np.uint64(n) + np.uint64(1 << 62)))
            keys.append(mix(mix(head[n : n + 1]) + np.uint64(n)))
            roles.append(np.zeros(len(at), np.int8))
            roles.append(np.ones(1, np.int8))
        if longer:
            roles.append(np.full(len(at), 2, np.int8))
    key, role = np.concatenate(keys), np.concatenate(roles)
    _, one = np.unique(key, return_index=True)
    return key[one], role[one]


def _removed(candidates: DataFrame) -> DataFrame:
    """h1, h2 of lines with an earlier line within one edit, verified on the texts."""

    def spread(keep=None):
        """Variants and lines; by `keep`, a broadcast Membership, only variants that it has, with all columns."""

        def run(batches):
            for batch in batches:
                for some in chunks(zip(*(batch.column(i).to_pylist() for i in range(7)), strict=True), size=lambda r: 64 + len(r[5]), most=1 << 18):
                    got = [variants(r[5], r[6]) for r in some]
                    key, role = (np.concatenate([g[i] for g in got]) for i in (0, 1))
                    of = np.repeat(np.arange(len(some)), [len(k) for k, _ in got])
                    if keep is None:
                        yield pa.RecordBatch.from_arrays([pa.array(signed(key)), pa.array([r[0] for r in some], pa.int64()).take(pa.array(of))], ["variant", "h1"])
                        continue
                    ok = keep.value.has(key)
                    fixed = [pa.array([r[i] for r in some], pa.int64()).take(pa.array(of[ok])) for i in range(5)]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(key[ok])), pa.array(role[ok]), *fixed], ["variant", "role", "h1", "h2", "doc", "number", "key"])

        return run

    places = candidates.select("h1", "h2", "at.doc", "at.number", "at.key", "line", "parts")
    every = places.mapInArrow(lean(spread()), "variant long, h1 long")
    live = written(every.groupBy("variant").agg(F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high").select("variant"), "live")
    keep = candidates.sparkSession.sparkContext.broadcast(Membership.of(live, "variant", live.count()))
    rows = places.mapInArrow(lean(spread(keep)), "variant long, role byte, h1 long, h2 long, doc long, number long, key long")
    rows = written(rows.select("variant", "role", "h1", "h2", F.struct("doc", "number", "key").alias("at")), "variants")
    me = F.struct("at", "h1", "h2")
    of = lambda *roles: F.min(F.when(F.col("role").isin(*roles), me))
    least = rows.groupBy("variant").agg(of(0).alias("changed"), of(1).alias("shorter"), of(2).alias("longer"), F.min("h1").alias("low"), F.max("h1").alias("high")).where("low <> high")
    least = written(least.drop("low", "high"), "earliest")
    met = rows.join(least, "variant")
    other = F.when(F.col("role") == 0, F.col("changed")).when(F.col("role") == 1, F.col("longer")).otherwise(F.col("shorter"))
    pairs = met.withColumn("other", other).where("other is not null and other.at < at").groupBy("h1", "h2", F.col("other.h1").alias("o1"), F.col("other.h2").alias("o2")).agg(F.lit(1).alias("one"))
    text = candidates.select("h1", "h2", "line")
    pairs = pairs.join(text, ["h1", "h2"]).join(text.select(F.col("h1").alias("o1"), F.col("h2").alias("o2"), F.col("line").alias("earlier")), ["o1", "o2"])
    return pairs.where(F.levenshtein("line", "earlier", 1).between(0, 1)).select("h1", "h2").distinct()


def line_dedup(docs: DataFrame, fuzzy_from: int = FUZZY_FROM) -> DataFrame:
    """docs with repeated lines taken out of text, and n_lines and n_removed (lines that aren't blank)."""
    docs = docs.drop("n_lines", "n_removed")
    key, doc_at, key_at, kept_at = (fresh(docs, c) for c in ("row_key", "kept_doc", "kept_key", "kept_lines"))
    texts = docs.where("text is not null and text <> ''").select(F.col("doc_id").cast("long").alias("doc"), row_key().alias("key"), "text")
    coarse = written(_coarse(texts, fuzzy_from), "coarse")
    candidates = written(_candidates(texts, coarse, fuzzy_from), "candidates")
    removed = written(_removed(candidates), "removed")
    stay = _distinct(texts).join(removed, ["h1", "h2"], "left_anti").select("at.*")
    kept = stay.groupBy(F.col("doc").alias(doc_at), F.col("key").alias(key_at)).agg(F.collect_list(F.col("number").cast("int")).alias(kept_at))

    @F.pandas_udf("text string, n_lines long, n_removed long")
    def rebuild(text: pd.Series, kept: pd.Series) -> pd.DataFrame:
        hand_back()
        out = []
        for t, k in zip(text, kept, strict=True):
            if t is None:
                out.append((None, 0, 0))
                continue
            lines, stay = t.split("\n"), set() if k is None else set(k.tolist())
            real = [bool(x) and not x.isspace() for x in lines]
            n = sum(real)
            out.append((t if len(stay) == n else "\n".join(x for i, (x, r) in enumerate(zip(lines, real, strict=True)) if not r or i in stay) if stay else "", n, n - len(stay)))
        return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])

    new = fresh(docs, "new")
    out = docs.withColumn(key, row_key()).join(kept, (F.col(key) == F.col(key_at)) & F.col("doc_id").eqNullSafe(F.col(doc_at)), "left")
    out = out.withColumn(new, rebuild.asNondeterministic()("text", kept_at))  # so a filter on what it gives doesn't run it twice
    return out.select(*[F.col(f"{new}.text").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns], f"{new}.n_lines", f"{new}.n_removed")


def brute(docs: list[tuple[int, str]], fuzzy_from: int = FUZZY_FROM) -> dict[int, str]:
    """The same the plain way, for tests: docs by id."""

    def near(a: str, b: str) -> bool:
        if a == b:
            return True
        if min(len(a), len(b)) < fuzzy_from or abs(len(a) - len(b)) > 1:
            return False
        i = next((k for k, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
        return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i + 1 :] == b[i:] if len(a) > len(b) else a[i:] == b[i + 1 :]

    seen: list[str] = []
    out = {}
    for doc, text in sorted(docs):
        lines = text.split("\n")
        keep = []
        for x in lines:
            blank = not x or x.isspace()
            keep.append(blank or not any(near(x, y) for y in seen))
            if not blank:
                seen.append(x)
        stays = any(k for k, x in zip(keep, lines, strict=True) if x and not x.isspace())
        out[doc] = "\n".join(x for k, x in zip(keep, lines, strict=True) if k) if stays or not any(x and not x.isspace() for x in lines) else ""
    return out
