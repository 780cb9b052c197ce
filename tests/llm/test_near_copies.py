"""Near copies by both measures in use (5 words at 80 %, 3 words at 90 %), and the pipeline's stage."""

import random

import pytest

import corpus_pipeline
from celldex.llm import ngram_join, queries

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in texts], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def texts():
    """Copies with a few changed words of texts of many lengths; pairs lie on both sides of either measure."""
    r = random.Random(11)
    out = []
    for i in range(24):
        base = [f"w{r.randrange(4000)}" for _ in range(r.choice((5, 6, 9, 12, 14, 18, 19, 24, 34, 60, 150)))]
        for _ in range(6):
            w = list(base)
            for _ in range(r.randrange(0, 3)):
                w[r.randrange(len(w))] = f"y{r.randrange(9)}"
            out.append(" ".join(w[r.randrange(2) : len(w) - r.randrange(2)]))
    return [*enumerate(out), (900, None), (901, ""), (902, "a b")]


def linked(texts, percent, shingle):
    return {k for k, (_, c) in ngram_join.brute(dict(texts), percent, shingle).items() if k != c}


@pytest.mark.parametrize("percent,shingle", [(80, 5), (90, 3)])
@pytest.mark.parametrize("small_list,out", [(12, 2), (1, 0)])
def test_both_measures(spark, texts, percent, shingle, small_list, out, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_LIST", small_list)
    monkeypatch.setattr(ngram_join, "_boundary", lambda classes, seen, percent: ngram_join.boundaries(percent)[out])
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.ngram_join(docs(spark, texts), percent=percent, shingle=shingle).collect()}
    assert got == ngram_join.brute(dict(texts), percent, shingle)


def test_groups_that_share_differences_lose_no_link(spark, monkeypatch):
    """Variants of one text far from the leader of their lists."""
    monkeypatch.setattr(ngram_join, "SMALL_LIST", 1)
    r = random.Random(5)
    first = [f"w{i}" for i in range(60)]
    out = [" ".join(first)] * 5
    for start in (12, 25):
        other = first[:start] + [f"v{start}_{i}" for i in range(60 - start)]
        for _ in range(25):
            w = list(other)
            for _ in range(r.randrange(0, 4)):
                w[r.randrange(len(w))] = f"y{r.randrange(5)}"
            out.append(" ".join(w))
    texts = list(enumerate(out))
    for percent, shingle in ((80, 5), (60, 2)):
        got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.ngram_join(docs(spark, texts), percent=percent, shingle=shingle).collect()}
        assert got == ngram_join.brute(dict(texts), percent, shingle)


def test_boundaries_hold_subsets_few():
    assert ngram_join.boundaries(90) == [9, 19, 29] and ngram_join.boundaries(80) == [4, 9, 14]
    for percent in (50, 75, 80, 90, 95, 99, 100):
        for n in ngram_join.boundaries(percent):
            m = n - ngram_join.least_overlap(n, percent)
            assert m <= ngram_join.MOST_OUT and sum(1 for _ in ngram_join.subsets(ngram_join.np.arange(n, dtype="u8"), percent)) <= 1 + n + n * (n - 1) // 2


def test_query_keeps_its_measure(spark, texts, tmp_path):
    docs(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in queries.op5_ngram_join(spark, str(tmp_path)).collect()}
    assert got == ngram_join.brute(dict(texts), 90, 3)


def test_stage_removes_near_copies_by_five_words_at_80(spark, texts):
    gone = linked(texts, 80, 5)
    assert gone - linked(texts, 90, 3)
    got = {x["doc_id"] for x in corpus_pipeline.near_copies(spark, docs(spark, texts), "").collect()}
    assert got == {i for i, _ in texts} - gone
