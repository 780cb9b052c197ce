"""URL filters by a bit-parallel wildcard automaton (Shift-And over many words).

A rule is a host and a path; it fits its host and all subdomains where the URL's path starts with the
rule's, so it is two globs, `host|path**` and `*.host|path**`, over the canonical URL: host, border, path.
In a glob `*` is any run within the host or within a path segment (it stops at the border and at `/`),
`**` any run at all; hosts and paths of rules may hold them too, and `\\` takes the next character as it is.

Every glob takes one bit for its start and one for each character; all globs lie behind each other in
64-bit words.  A step over one byte of all URLs of a batch is (state << 1 & take[byte]) | (state &
stay[byte]), with the carry between words, so all globs move at once, whatever their number.  A URL is done
when no bit can change any more.  Where several rules fit, that with the longest host and path decides, then
the longer host, then `block`; where none does, the default does (`allow`: what no rule names is let through).

The host is what follows the first `://` up to `/`, `?`, `#` or the end, A-Z in lower case; the path goes
from there up to `?`, `#` or the end.  URLs that are null or hold no `://` have neither (both empty).
Every row gives one row and keeps its place: nothing is shuffled.  Repeated rows, null ids and other
columns are as they are; other columns are not read.  Rules are an argument, so they are broadcast with the
function; sets of more than `WORDS` words are run block by block.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))

DEFAULT = "allow"

#: Words of states that are run at once, and bytes of states of a batch of URLs.
WORDS, STATE_BYTES = 1024, 16 << 20

#: The border between host and path, beside the 256 bytes.
BORDER = 256

_ONE = np.uint64(1)
_AFTER = "(?s)^.*?://([^/?#]*)([^?#]*)"


def tokens(text: str) -> list[int | str]:
    """Bytes, `*` and `**` of a glob's part."""
    out: list[int | str] = []
    i = 0
    while i < len(text):
        if text.startswith("**", i):
            out.append("**")
            i += 2
        elif text[i] == "*":
            out.append("*")
            i += 1
        else:
            i += text[i] == "\\" and i + 1 < len(text)
            out += text[i].encode()
            i += 1
    return out


def globs(host: str, path: str) -> list[list[int | str]]:
    h, p = tokens(host), tokens(path)
    return [[*h, BORDER, *p, "**"], ["*", ord("."), *h, BORDER, *p, "**"]]


class Automaton:
    """Globs in words of bits: `take[c]` are places that c leads to, `stay[c]` those that c doesn't end."""

    def __init__(self, patterns: list[list[int | str]]):
        bits = sum(1 + sum(isinstance(t, int) for t in p) for p in patterns)
        words = max(1, -(-bits // 64))
        self.take, self.stay = np.zeros((2, BORDER + 1, words), np.uint64)
        self.start = np.zeros(words, np.uint64)
        self.last = np.zeros(len(patterns), np.int64)
        within = [c for c in range(256) if c != ord("/")]
        at = 0
        for k, pattern in enumerate(patterns):
            self.start[at >> 6] |= _ONE << np.uint64(at & 63)
            for t in pattern:
                if isinstance(t, int):
                    at += 1
                    self.take[t, at >> 6] |= _ONE << np.uint64(at & 63)
                else:
                    self.stay[within if t == "*" else slice(None), at >> 6] |= _ONE << np.uint64(at & 63)
            self.last[k] = at
            at += 1
        self.accept = np.zeros(words, np.uint64)
        np.bitwise_or.at(self.accept, self.last >> 6, _ONE << (self.last & 63).astype(np.uint64))
        # such a place stays whatever comes, and it is the end of a glob: it can't change
        self.settled = np.bitwise_and.reduce(self.stay, axis=0) & self.accept

    def run(self, symbols: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether each glob fits each of the URLs symbols[begin:begin + size]."""
        state = np.broadcast_to(self.start, (len(begin), len(self.start))).copy()
        final = state.copy()
        live = np.argsort(-size, kind="stable")
        state, step = state[live], 0
        while len(live):
            n = int(np.searchsorted(-size[live], -step))  # those that are longer than step
            final[live[n:]] = state[n:]
            live, state = live[:n], state[:n]
            if not n:
                break
            c = symbols[begin[live] + step]
            moved = state << _ONE
            moved[:, 1:] |= state[:, :-1] >> np.uint64(63)
            state = (moved & self.take[c]) | (state & self.stay[c])
            step += 1
            if step % 8 == 0:
                going = (state & ~self.settled).any(1)
                final[live[~going]] = state[~going]
                live, state = live[going], state[going]
        return (final[:, self.last >> 6] >> (self.last & 63).astype(np.uint64)) & _ONE != 0


class Rules:
    """Rules by falling precedence; `first` gives each URL's first rule that fits, -1 for none."""

    def __init__(self, rules: Sequence[tuple[str, str, str]], words: int = WORDS):
        self.rules = sorted(rules, key=lambda r: (-len(r[0]) - len(r[1]), -len(r[0]), r[2] != "block", r))
        self.shown = [h + p for h, p, _ in self.rules]
        self.blocks: list[Automaton] = []
        for some in chunks([globs(h, p) for h, p, _ in self.rules], size=lambda g: sum(map(len, g)) + 2, most=64 * words):
            self.blocks.append(Automaton([p for two in some for p in two]))

    def first(self, hosts: list[bytes], paths: list[bytes]) -> np.ndarray:
        size = np.array([len(h) + len(p) + 1 for h, p in zip(hosts, paths, strict=True)], np.int64)
        begin = np.cumsum(size) - size
        symbols = np.frombuffer(b"".join(h + b"\0" + p for h, p in zip(hosts, paths, strict=True)), np.uint8).astype(np.int16)
        symbols[begin + np.array([len(h) for h in hosts], np.int64)] = BORDER
        out, before = np.full(len(hosts), -1, np.int64), 0
        for block in self.blocks:
            fits = block.run(symbols, begin, size).reshape(len(hosts), -1, 2).any(2)
            new = (out < 0) & fits.any(1)
            out[new] = before + fits[new].argmax(1)
            before += fits.shape[1]
        return out


def url_parts(url: str = "url"):
    """Host and path as columns."""
    parts = [F.coalesce(F.regexp_extract(F.col(url), _AFTER, i), F.lit("")) for i in (1, 2)]
    return F.translate(parts[0], string.ascii_uppercase, string.ascii_lowercase), parts[1]


def url_filter(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, default: str = DEFAULT, key: str = "page_id", url: str = "url", words: int = WORDS) -> DataFrame:
    """The key, host, path, rule (host and path of the one that decides, or null) and verdict of every row."""
    compiled = Rules(rules, words)
    step = max(1, STATE_BYTES // (8 * max([len(b.start) for b in compiled.blocks], default=1)))

    def run(batches):
        for batch in batches:
            for at in range(0, len(batch), step):
                some = batch.slice(at, step)
                hosts, paths = (some.column(i).cast(pa.binary()).to_pylist() for i in (1, 2))
                found = compiled.first(hosts, paths).tolist()
                rule = pa.array([compiled.shown[i] if i >= 0 else None for i in found], pa.string())
                verdict = pa.array([compiled.rules[i][2] if i >= 0 else default for i in found], pa.string())
                yield pa.RecordBatch.from_arrays([*some.columns, rule, verdict], [*some.schema.names, "rule", "verdict"])

    host, path = url_parts(url)
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(lean(run), f"key {kind}, host string, path string, rule string, verdict string").withColumnRenamed("key", key)


ORACLE = r"""
WITH u AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
    WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
    WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule
  FROM u)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict
FROM r"""
