"""Language identification by a small byte convolutional network.

Texts are cut into windows of `WINDOW` bytes, the last one padded.  Filters of widths 2, 3 and 4 over
byte embeddings, max pooling over the window, a rectifier and a softmax layer give each window's log
probabilities; a document's are their mean, weighted by the windows' bytes, over all its windows.

Training is numpy (Adam, gradients by hand) on the driver, over a bounded sample of labelled rows:
about `PER_LANGUAGE` documents of each language (drawn by a hash of the id), `PER_DOC` windows each; fewer
of each where there are so many languages that it would be more than `MOST_SAMPLED` documents, but about
`LEAST_SAMPLED` of each at least, or all it has; so no language is left out.
For prediction, embeddings and filters are folded into tables over byte pairs, so a convolution is a
few row lookups; tasks handle blocks of `BLOCK` windows whatever the texts' lengths.

Null text and text without a letter give `und` with score 0, as does every text where no row has a
label.  A null id is never learned from and counts as not held out.  Every row gives one row.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import HELD, chunks, fresh, hand_back, in_train

WINDOW, PER_LANGUAGE, PER_DOC, BLOCK = 256, 1500, 3, 64
WIDTHS, FILTERS, EMBED = (2, 3, 4), 16, 8
LEAST_SAMPLED, MOST_SAMPLED = 20, 300_000


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of the texts, the number of each text's, and each window's bytes without padding."""
    n = np.array([max(1, -(-len(t) // WINDOW)) for t in texts])
    buf = np.frombuffer(b"".join(t.ljust(k * WINDOW, b"\0") for t, k in zip(texts, n.tolist(), strict=True)), np.uint8)
    full = np.full(n.sum(), WINDOW)
    full[np.cumsum(n) - 1] = [len(t) - (k - 1) * WINDOW for t, k in zip(texts, n.tolist(), strict=True)]
    return buf.reshape(-1, WINDOW), n, full


class ByteCNN:
    """Parameters: embedding E, filters W[width] of shape (width, EMBED, FILTERS), biases, softmax V, c."""

    def __init__(self, languages: list[str], seed: int = 0):
        r = np.random.default_rng(seed)
        self.languages = languages
        self.p = {"E": r.normal(0, 0.5, (256, EMBED)), "V": r.normal(0, 0.1, (len(WIDTHS) * FILTERS, len(languages))), "c": np.zeros(len(languages))}
        for w in WIDTHS:
            self.p[f"W{w}"] = r.normal(0, 0.3, (w, EMBED, FILTERS))
            self.p[f"b{w}"] = np.zeros(FILTERS)
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int = 4, batch: int = 64, rate: float = 0.01, seed: int = 1) -> ByteCNN:
        r, m, v, step = np.random.default_rng(seed), {}, {}, 0
        for _ in range(epochs):
            order = r.permutation(len(x))
            for at in range(0, len(order), batch):
                pick = order[at : at + batch]
                step += 1
                for k, g in self._gradients(x[pick], y[pick]).items():
                    m[k] = 0.9 * m.get(k, 0) + 0.1 * g
                    v[k] = 0.999 * v.get(k, 0) + 0.001 * g * g
                    self.p[k] -= (rate * (m[k] / (1 - 0.9**step)) / (np.sqrt(v[k] / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        return self

    def _gradients(self, x: np.ndarray, y: np.ndarray) -> dict[str, np.ndarray]:
        p, n, places = self.p, len(x), WINDOW - max(WIDTHS) + 1
        pooled, where = [], {}
        for w in WIDTHS:
            tables = [p["E"] @ p[f"W{w}"][j] for j in range(w)]
            conv = sum(tables[j][x[:, j : j + places]] for j in range(w))
            where[w] = conv.argmax(axis=1)
            pooled.append(np.take_along_axis(conv, where[w][:, None, :], 1)[:, 0] + p[f"b{w}"])
        h = np.concatenate(pooled, 1)
        a = np.maximum(h, 0)
        z = a @ p["V"] + p["c"]
        q = np.exp(z - z.max(1, keepdims=True))
        q /= q.sum(1, keepdims=True)
        q[np.arange(n), y] -= 1
        q /= n
        out = {"V": a.T @ q + 1e-4 * p["V"], "c": q.sum(0), "E": np.zeros_like(p["E"])}
        back = (q @ p["V"].T) * (h > 0)
        filters = np.broadcast_to(np.arange(FILTERS), (n, FILTERS))
        for i, w in enumerate(WIDTHS):
            g = back[:, i * FILTERS : (i + 1) * FILTERS]
            out[f"b{w}"], out[f"W{w}"] = g.sum(0), np.zeros_like(p[f"W{w}"])
            for j in range(w):
                table = np.zeros((256, FILTERS), np.float32)
                np.add.at(table, (np.take_along_axis(x, where[w] + j, 1), filters), g)
                out[f"W{w}"][j] = p["E"].T @ table
                out["E"] += table @ p[f"W{w}"][j].T
        return out

    def folded(self) -> dict[str, np.ndarray]:
        """Tables: by byte pair for the first two places of all widths, by byte for the third of width 3, by pair for the last two of width 4."""
        p = self.p
        t = {(w, j): p["E"] @ p[f"W{w}"][j] for w in WIDTHS for j in range(w)}
        pair = lambda w, j: (t[w, j][:, None, :] + t[w, j + 1][None, :, :]).reshape(65536, FILTERS)
        return {"head": np.concatenate([pair(w, 0) for w in WIDTHS], 1), "third": t[3, 2], "last": pair(4, 2), "bias": np.concatenate([p[f"b{w}"] for w in WIDTHS]), "V": p["V"], "c": p["c"]}


def log_probabilities(tables: dict[str, np.ndarray], x: np.ndarray) -> np.ndarray:
    """Of each window, by folded tables."""
    places, out = WINDOW - max(WIDTHS) + 1, []
    for at in range(0, len(x), BLOCK):
        b = x[at : at + BLOCK]
        code = (b[:, :-1].astype(np.uint16) << 8) | b[:, 1:]
        conv = np.take(tables["head"], code[:, :places], axis=0)
        conv[:, :, FILTERS : 2 * FILTERS] += np.take(tables["third"], b[:, 2 : 2 + places], axis=0)
        conv[:, :, 2 * FILTERS :] += np.take(tables["last"], code[:, 2 : 2 + places], axis=0)
        a = np.maximum(conv.max(axis=1) + tables["bias"], 0)
        z = a @ tables["V"] + tables["c"]
        z -= z.max(1, keepdims=True)
        out.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
    return np.concatenate(out)


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> tuple[list[bytes], list[str]]:
    """A bounded, hash-drawn sample of the rows that may be learned from: windows and their languages."""
    rows = docs.where(in_train() & F.col("lang").isNotNull() & F.col("text").rlike("\\p{L}"))
    n = {r["lang"]: r["n"] for r in docs.where(in_train() & F.col("lang").isNotNull()).groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not n:
        return [], []
    per_language = max(LEAST_SAMPLED, min(per_language, MOST_SAMPLED // len(n)))
    rates = docs.sparkSession.createDataFrame([(k, min(1.0, per_language / v)) for k, v in sorted(n.items())], "lang string, rate double")  # a row a language
    draw = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) / float(1 << 20)
    body = F.col("text").cast("binary")
    room = F.greatest(F.octet_length("text") - WINDOW, F.lit(0))
    step = F.floor(room / (PER_DOC - 1)).cast("int")
    cut = F.array_distinct(F.array(*[F.substring(body, step * i + 1, F.lit(WINDOW)) for i in range(PER_DOC)]))
    got = rows.select("doc_id", "lang", "text").join(F.broadcast(rates), "lang").where(draw < F.col("rate")).select("doc_id", "lang", cut.alias("cut")).toArrow()
    x, y, per = [], [], {}
    for lang, cuts in sorted(zip(got["lang"].to_pylist(), got["cut"].to_pylist(), strict=True)):
        if (k := per.get(lang, 0)) < 2 * per_language:  # the draw is of about per_language
            per[lang] = k + 1
            x += cuts
            y += [lang] * len(cuts)
    return x, y


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> ByteCNN | None:
    x, y = sample(docs, per_language)
    if not x:
        return None
    languages = sorted(set(y))
    at = {k: i for i, k in enumerate(languages)}
    return ByteCNN(languages).train(windows(x)[0], np.array([at[k] for k in y]))


def with_language(docs: DataFrame, lang_pred: str = "lang_pred", score: str = "score", per_language: int = PER_LANGUAGE) -> DataFrame:
    """docs with the predicted language and its probability in columns of these names."""
    model = fit(docs, per_language)
    if model is None:
        return docs.withColumns({lang_pred: F.lit("und"), score: F.lit(0.0)})
    share = docs.sparkSession.sparkContext.broadcast((model.folded(), model.languages))

    @F.pandas_udf("lang_pred string, score double")
    def predict(text: pd.Series) -> pd.DataFrame:
        for cache in HELD:
            cache.clear()
        hand_back()
        (tables, languages), out = share.value, []
        for some in chunks(text, size=lambda t: len(t or b"")):
            x, n, size = windows([t or b"" for t in some])
            first = np.concatenate(([0], np.cumsum(n)[:-1]))
            mean = np.add.reduceat(log_probabilities(tables, x) * size[:, None], first, axis=0)
            mean /= np.maximum(np.add.reduceat(size, first), 1)[:, None]
            q = np.exp(mean - mean.max(1, keepdims=True))
            q /= q.sum(1, keepdims=True)
            out += [("und", 0.0) if t is None else (languages[b], float(s)) for t, b, s in zip(some, q.argmax(1), q.max(1), strict=True)]
        return pd.DataFrame(out, columns=["lang_pred", "score"])

    new = fresh(docs, "new")
    text = F.when(F.col("text").rlike("\\p{L}"), F.col("text").cast("binary"))
    out = docs.withColumn(new, predict(text)).withColumns({lang_pred: F.col(f"{new}.lang_pred"), score: F.col(f"{new}.score")})
    return out.drop(new)


def language_id(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row of docs (doc_id, text, lang)."""
    held = F.coalesce(~in_train(), F.lit(False)).alias("held_out")
    return with_language(docs.select("doc_id", "text", "lang"), per_language=per_language).select(F.col("doc_id").cast("long"), held, "lang_pred", "score")
