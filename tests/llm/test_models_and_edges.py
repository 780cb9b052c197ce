"""Gradients, folded tables and optima of the models; empty tables, very long texts, repeated rows and clashing columns everywhere."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest

from celldex.llm import decontamination, language_id, licenses, line_dedup, neighbours, ngram_join, packing, quality, substring_dedup, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n_lines int, score string, part string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), "k", 7, "x", "y") for i, t in texts], SCHEMA).repartition(3)


def network(languages=3, seed=4):
    model = language_id.ByteCNN([str(i) for i in range(languages)], seed)
    r = np.random.default_rng(seed)
    model.p = {k: r.normal(0, 0.4, v.shape) for k, v in model.p.items()}  # in double precision
    return model, r


def plain_log_probabilities(p, window):
    """One window's, by loops over places."""
    places = language_id.WINDOW - max(language_id.WIDTHS) + 1
    pooled = []
    for w in language_id.WIDTHS:
        conv = [sum(p["E"][window[i + j]] @ p[f"W{w}"][j] for j in range(w)) + p[f"b{w}"] for i in range(places)]
        pooled.append(np.maximum(np.max(conv, axis=0), 0))
    z = np.concatenate(pooled) @ p["V"] + p["c"]
    return z - z.max() - np.log(np.exp(z - z.max()).sum())


def test_folded_tables_are_the_convolution():
    model, r = network()
    x = r.integers(0, 256, (5, language_id.WINDOW)).astype(np.uint8)
    got = language_id.log_probabilities(model.folded(), x)
    assert np.allclose(got, [plain_log_probabilities(model.p, w) for w in x])


def test_gradients_are_the_losses_slopes():
    model, r = network()
    x, y = r.integers(0, 256, (4, language_id.WINDOW)).astype(np.uint8), np.array([0, 2, 1, 2])
    slopes = model._gradients(x, y)

    def loss():
        return -np.mean([plain_log_probabilities(model.p, w)[k] for w, k in zip(x, y, strict=True)]) + 0.5e-4 * (model.p["V"] ** 2).sum()

    for name, v in model.p.items():
        biggest = np.unravel_index(np.abs(slopes[name]).argmax(), v.shape)
        for at in (biggest, tuple(r.integers(0, n) for n in v.shape)):
            keep, step = v[at], 1e-5
            v[at] = keep + step
            up = loss()
            v[at] = keep - step
            down = loss()
            v[at] = keep
            assert slopes[name][at] == pytest.approx((up - down) / (2 * step), rel=1e-3, abs=1e-7)


def test_coordinate_descent_finds_the_optimum():
    """At the optimum the primal and the dual objective are equal."""
    r = np.random.default_rng(0)
    rows, y = [], np.where(np.arange(60) % 3 > 0, 1.0, -1.0)
    for k in y:
        at = np.sort(r.choice(20, 6, replace=False)).astype(np.int32)
        rows.append((at, r.normal(0.3 * k, 1, 6)))
    cost = np.where(y > 0, 0.75, 1.5)
    w, bias = quality.coordinate_descent(rows, y, cost, 20, epochs=2000)
    margins = y * np.array([w[at] @ v + bias for at, v in rows])
    primal = 0.5 * (w @ w + bias * bias) + (cost * np.maximum(0, 1 - margins)).sum()
    for _ in range(300):
        v, b = w + r.normal(0, 0.02, 20), bias + r.normal(0, 0.02)
        m = y * np.array([v[at] @ u + b for at, u in rows])
        assert 0.5 * (v @ v + b * b) + (cost * np.maximum(0, 1 - m)).sum() >= primal - 1e-6


def test_ties_of_labels_and_repeated_rows(spark):
    texts = [(i, ("good one" if i % 2 else "bad two") + f" w{i}") for i in range(80)] + [(500, "good one"), (500, "good one"), (501, "good one"), (None, "good one")]
    labels = [(i, i % 2, 0) for i in range(80)] + [(501, 1, 0), (501, 0, 0), (3, 1, 0), (3, 1, 0)]
    got = quality.quality(docs(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert len(got) == 84 and len({x["score"] for x in got if x["doc_id"] in (500, 501, None)}) == 1
    tied = quality.quality(docs(spark, texts), spark.createDataFrame([(1, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")).collect()
    assert {x["score"] for x in tied} == {0.5}


def test_every_language_is_learned_however_many(spark, monkeypatch):
    monkeypatch.setattr(language_id, "MOST_SAMPLED", 30)
    rows = [(i, f"{'abcdefghijklmno'[i % 15] * 5} " * 8, f"l{i % 15}", "s", 0, "k", 1, "x", "y") for i in range(600)]
    model = language_id.fit(spark.createDataFrame(rows, SCHEMA))
    assert model.languages == sorted(f"l{i}" for i in range(15))


def operators(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k"), (2, None)], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    return {
        "lines": line_dedup.line_dedup, "substrings": substring_dedup.substring_dedup, "language": language_id.language_id, "join": ngram_join.ngram_join,
        "licenses": lambda d: licenses.license_scan(d, licenses.known(spark)), "tokens": lambda d: token_counts.token_counts(d, public_tokenizers.path("byte_bpe_50k.json")),
        "packing": lambda d: packing.pack(d, public_tokenizers.path("word_bpe_49k.json")), "benchmark": lambda d: decontamination.decontaminate(d, bench), "quality": lambda d: quality.quality(d, labels),
    }


NAMES = ["lines", "substrings", "language", "join", "licenses", "tokens", "packing", "benchmark", "quality"]


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, name):
    assert operators(spark)[name](docs(spark, [(1, "x")]).limit(0)).count() == 0


@pytest.mark.parametrize("name", NAMES)
def test_nulls_empties_and_repeats_give_a_row_each(spark, name):
    texts = [(1, None), (2, ""), (None, None), (None, "a b"), (3, "same text here"), (3, "same text here"), (3, "other"), (4, " \n\t ")]
    got = operators(spark)[name](docs(spark, texts)).collect()
    assert sorted(str(x["doc_id"]) for x in got) == sorted(str(i) for i, _ in texts)
    same = [tuple(v for k, v in sorted(x.asDict().items()) if k not in ("sequence_id", "offset")) for x in got if x["doc_id"] == 3]
    assert len(set(map(str, same))) == 2 or name in ("licenses", "language", "quality")


@pytest.fixture(scope="module")
def long_text():
    r = random.Random(6)
    body = " ".join(f"w{r.randrange(10**6)}" for _ in range(200_000))
    assert len(body) > 1 << 20
    return body


def test_very_long_texts(spark, long_text):
    """Texts beyond a chunk of the kernels, values compared."""
    passage = " ".join(long_text.split()[777:850])
    texts = [(1, long_text), (2, "short " + passage + " end"), (3, long_text + " more")]
    df = docs(spark, texts)
    got = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substring_dedup.substring_dedup(df).collect()}
    assert [got[i] for i, _ in texts] == substring_dedup.brute([t for _, t in texts])
    got = {x["doc_id"]: x["component_id"] for x in ngram_join.ngram_join(df).collect()}
    assert got == {1: 1, 2: 2, 3: 1}
    item = " ".join(long_text.split()[150_000:150_012])
    got = {x["doc_id"]: (x["n_words"], x["n_hit"]) for x in decontamination.decontaminate(df, spark.createDataFrame([(9, item)], "item_id long, text string")).collect()}
    assert got == {1: (200_000, 12), 2: (75, 0), 3: (200_001, 12)}
    lines = {x["doc_id"]: (x["n_lines"], x["n_removed"]) for x in line_dedup.line_dedup(df).collect()}
    assert lines == {1: (1, 0), 2: (1, 0), 3: (1, 0)}


def test_very_long_texts_of_tokens(spark, long_text):
    from tokenizers import Tokenizer

    df = docs(spark, [(1, long_text), (2, "b c")])
    byte, word = (Tokenizer.from_file(public_tokenizers.path(f"{n}.json")) for n in ("byte_bpe_50k", "word_bpe_49k"))
    got = {x["doc_id"]: x["n_tokens"] for x in token_counts.token_counts(df, public_tokenizers.path("byte_bpe_50k.json")).collect()}
    assert got == {i: len(byte.encode(t, add_special_tokens=False).ids) for i, t in ((1, long_text), (2, "b c"))}
    ids = np.array([*word.encode(long_text, add_special_tokens=False).ids, 2], "<u4")
    pieces = sorted((x["start"], x["length"], x["ids_crc32"]) for x in packing.pack(df, public_tokenizers.path("word_bpe_49k.json")).where("doc_id = 1").collect())
    assert pieces == [(s, min(4096, len(ids) - s), zlib.crc32(ids[s : s + 4096].tobytes())) for s in range(0, len(ids), 4096)]


def test_very_long_texts_of_models(spark, long_text):
    df = docs(spark, [(i, f"good text {i}" if i % 2 else f"bad words {i}") for i in range(60)] + [(99, long_text)])
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    assert 0 <= quality.quality(df, labels).where("doc_id = 99").head()["score"] <= 1
    assert language_id.language_id(df).where("doc_id = 99").head()["lang_pred"] == "en"
    assert licenses.license_scan(df, licenses.known(spark)).where("doc_id = 99").head()["license"] is None


def test_neighbours_with_other_columns_of_its_names(spark):
    rows = [(i, [float(i % 7), 1.0 + i % 3, 2.0], "x", 1, "b") for i in range(40)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<float>, vec string, part int, body string")
    v = neighbours.usable(v)
    assert neighbours.nearest(v, v.where("vec_id % 20 = 0")).count() == 40


def test_pipeline_is_its_plain_stages(spark, tmp_path):
    """All rows of the pipeline's result but where pieces lie, against stages done the plain way."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    r = random.Random(12)
    words = lambda n: " ".join(f"w{r.randrange(5000)}" for _ in range(n))
    base = [words(60) for _ in range(8)]
    leak = words(30)
    texts = [(i, base[i % 8] + "\n" + words(6) + ("\n" + leak if i % 9 == 0 else "") + ("\nshared line of the footer" if i % 3 else "")) for i in range(40)]
    texts += [(100 + i, base[0].replace("w1", "v1", i)) for i in range(4)] + [(200, None), (201, ""), (202, "12 ?"), (203, base[1])]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], "doc_id long, text string, lang string, source string, n_chars long").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    item = " ".join(leak.split()[3:20])
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    left = [(i, t) for i, t in texts if t and any(c.isalpha() for c in t)]
    left = [(i, t) for i, t in line_dedup.brute(left).items() if t]
    near = ngram_join.brute(dict(left), 80, 5)
    left = [(i, t) for i, t in left if near[i][1] == i]
    left = [(i, t) for i, t in left if not decontamination.brute(t, {"1": item})[1]]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = {(i, 0, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, t in left for ids in [[*library.encode(t, add_special_tokens=False).ids, 2]]}
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert 10 < len(want) < len(texts) and {(x["doc_id"], x["start"], x["length"], x["ids_crc32"]) for x in got} == want and len(got) == len(want)
    at = {}
    for x in sorted(got, key=lambda x: (x["sequence_id"], x["offset"])):
        assert x["offset"] == at.get(x["sequence_id"], 0)
        at[x["sequence_id"]] = x["offset"] + x["length"]
    assert max(at.values()) <= 4096


def test_pushed_columns(spark, tmp_path):
    """Operators read no column that they don't need."""
    docs(spark, [(1, "a b c")]).write.parquet(f"{tmp_path}/d.parquet")
    df = spark.read.parquet(f"{tmp_path}/d.parquet")
    plan = packing.pieces(df, public_tokenizers.path("word_bpe_49k.json"))._jdf.queryExecution().executedPlan().toString()
    assert "source" not in plan
