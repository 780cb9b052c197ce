"""Token counts by distinct pre-token.

A byte-pair tokenizer never merges across pre-tokens, so a text has as many tokens as its pre-tokens
have together.  The pre-tokens here are white-space-led words: a run of white space with the run of
other characters behind it.  Splitting there is exact for tokenizers whose pattern lets no pre-token
cross from another character into white space (the byte-level pattern of byte_bpe_50k.json does not).

1. Every task counts its pre-tokens; a grouped sum gives each distinct one's frequency.
2. The library counts the pieces of each distinct pre-token once.
3. The `frequent` most frequent of them are broadcast (a bound that doesn't grow with the data) and
   summed where the texts are; the remaining (document, pre-token, frequency) rows, among which no key
   is hot any more, are joined to the table of counts.

Null text counts as empty.  Every row gives one row, repeated ids and null ids too; other columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import chunks, lean, most_frequent, written

#: Unicode white space, as the tokenizers library reads \s.
_WS = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_PIECE = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
FREQUENT = 200_000


def pre_tokens(text: str) -> list[str]:
    return _PIECE.findall(text)


_LOADED: dict[str, object] = {}


def _tokenizer(path: str):
    if path not in _LOADED:
        from tokenizers import Tokenizer

        _LOADED[path] = Tokenizer.from_file(path)
    return _LOADED[path]


def count_pieces(pieces: DataFrame, path: str) -> DataFrame:
    """Adds `tokens`, the library's count, to a table of distinct `piece`."""

    @F.pandas_udf("int")
    def tokens(piece: pd.Series) -> pd.Series:
        found = _tokenizer(path).encode_batch_fast(piece.tolist(), add_special_tokens=False)
        return pd.Series([len(x) for x in found], dtype="int32")

    return pieces.withColumn("tokens", tokens("piece"))


def token_counts(docs: DataFrame, path: str, frequent: int = FREQUENT, limit: int = 1024) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row, without the texts' ids ever being held."""
    spark = docs.sparkSession

    def tally(batches):
        for batch in batches:
            for some in chunks(batch.column(0).to_pylist(), most=8 << 20):
                got = Counter()
                for text in some:
                    got.update(_PIECE.findall(text))
                yield pa.RecordBatch.from_arrays([pa.array(got.keys(), pa.string()), pa.array(got.values(), pa.int64())], ["piece", "n"])

    texts = docs.select("text").where(F.length("text") > 0)
    each = texts.mapInArrow(lean(tally), "piece string, n long").groupBy("piece").agg(F.sum("n").alias("n"))
    counted = written(count_pieces(each, path), "pieces")
    top = most_frequent(counted, "n", frequent).select("piece", "tokens").toArrow()
    common = spark.sparkContext.broadcast(dict(zip(top["piece"].to_pylist(), top["tokens"].to_pylist(), strict=True)))

    def sums(batches):
        known, row = common.value, TaskContext.get().partitionId() << 36
        for batch in batches:
            for some in chunks(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True), size=lambda r: len(r[1] or ""), most=4 << 20):
                rows, ids, size, tokens, pieces, n = [], [], [], [], [], []
                for doc_id, text in some:
                    got = Counter(_PIECE.findall(text or ""))
                    rare = [x for x in got if x not in known]
                    many = [got.pop(x) for x in rare]
                    rows += [row] * (len(rare) + 1)
                    ids += [doc_id] + [None] * len(rare)
                    size += [len((text or "").encode())] + [None] * len(rare)
                    tokens += [sum(known[x] * k for x, k in got.items())] + [None] * len(rare)
                    pieces += [None, *rare]
                    n += [None, *many]
                    row += 1
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip((rows, ids, size, tokens, pieces, n), (*[pa.int64()] * 4, pa.string(), pa.int64()), strict=True)], ["row", "doc_id", "n_bytes", "tokens", "piece", "n"])

    parts = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(sums), "row long, doc_id long, n_bytes long, tokens long, piece string, n long"), "parts")
    rare = parts.where("piece is not null").select("row", "piece", "n").join(counted.select("piece", F.col("tokens").alias("each")), "piece")
    rare = rare.groupBy("row").agg(F.sum(F.col("each") * F.col("n")).alias("more"))
    out = parts.where("piece is null").select("row", "doc_id", "n_bytes", "tokens").join(rare, "row", "left")
    n = F.col("tokens") + F.coalesce("more", F.lit(0))
    return out.select("doc_id", "n_bytes", n.alias("n_tokens"), (n > limit).alias("over_limit"))
