"""The pipeline's stages on small tables."""

import random

import corpus_pipeline
from celldex.llm import decontamination, line_dedup, ngram_join

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, lang="en"):
    return spark.createDataFrame([(i, t, lang, "s", len(t or "")) for i, t in texts], SCHEMA).repartition(3)


def test_language_keeps_texts_with_a_letter_without_labels_too(spark):
    texts = [(1, "some clean text"), (2, "12 !"), (3, None), (4, ""), (5, "über"), (None, "x")]
    want = sorted(str(i) for i, t in texts if t and any(c.isalpha() for c in t))
    for lang in (None, "en"):
        assert sorted(str(x["doc_id"]) for x in corpus_pipeline.language(spark, docs(spark, texts, lang), "").collect()) == want


def test_near_copies_judges_rows_and_keeps_one_of_repeats(spark):
    a, b = (" ".join(f"{k}{i}" for i in range(30)) for k in "ab")
    texts = [(3, a), (3, a), (5, a + " z"), (5, b), (6, b), (7, "short"), (7, "short"), (None, a), (None, a), (8, None), (9, "")]
    got = corpus_pipeline.near_copies(spark, docs(spark, texts), "").collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "lang", "source", "n_chars"}
    want = [(3, a), (5, b), (7, "short"), (None, a), (None, a), (8, None), (9, "")]
    assert sorted(map(str, ((x["doc_id"], x["text"]) for x in got))) == sorted(map(str, want))


def test_stages_rows_are_those_of_plain_versions(spark, tmp_path):
    r = random.Random(3)
    base = [" ".join(f"w{r.randrange(3000)}" for _ in range(40)) for _ in range(6)]
    item = " ".join(base[0].split()[5:20])
    texts = [(i, base[i % 6] + "".join(f" x{r.randrange(99)}" for _ in range(i % 4)) + f"\nown line {'qrstuvwxyz'[i % 10] * 9} {i}") for i in range(30)]
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = lambda df: {x["doc_id"]: (x["text"], x["n_chars"]) for x in df.collect()}
    df = docs(spark, texts)

    left = {i: t for i, t in line_dedup.brute(texts).items() if t != ""}
    assert rows(corpus_pipeline.lines(spark, df, "")) == {i: (t, len(t)) for i, t in left.items()}

    plain = ngram_join.brute(dict(texts), 80, 5)
    assert rows(corpus_pipeline.near_copies(spark, df, "")) == {i: (t, len(t)) for i, t in texts if plain[i][1] == i}

    free = {i: (t, len(t)) for i, t in texts if not decontamination.brute(t, {"1": item})[1]}
    assert 0 < len(free) < len(texts) and rows(corpus_pipeline.benchmarks(spark, df, str(tmp_path))) == free
