"""Order of neighbours, labels that mustn't count, and the pipeline on odd tables."""

import random
import zlib

import numpy as np
import pytest

from celldex.llm import language_id, neighbours, quality


def test_rank_score_and_ties_of_neighbours(spark):
    r = np.random.default_rng(3)
    x = np.round(r.normal(0, 1, (400, 6)), 1)
    x[100:400:2] = x[0]  # ties by the hundred
    ids = r.permutation(4000)[:400]
    v = neighbours.usable(spark.createDataFrame([(int(i), [float(f) for f in row]) for i, row in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").repartition(5))
    got: dict[int, list] = {}
    for row in neighbours.nearest(v, v.where("vec_id % 20 = 0"), k=20).collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert set(got) == {int(i) for i in ids if i % 20 == 0}
    for q, rows in got.items():
        me = x[list(ids).index(q)]
        want = sorted((-float((me * row).sum()), int(i)) for i, row in zip(ids, x, strict=True) if i != q)[:20]
        rows.sort()
        assert [k for k, _, _ in rows] == list(range(1, 21))
        assert [i for _, i, _ in rows] == [i for _, i in want]
        assert [s for _, _, s in rows] == [-s for s, _ in want]


def held_out(i: int) -> bool:
    return zlib.crc32(str(i).encode()) % 4 == 2


LETTERS = {"en": "the and of with", "xx": "zzu qqa vvo kkx", "fr": "le la des avec"}


def corpus(r):
    rows = []
    for i in range(240):
        lang = ["en", "xx", "fr"][i % 3]
        rows.append((i, " ".join(r.choice(LETTERS[lang].split()) + r.choice("abc") for _ in range(40)), lang, "s"))
    return rows


def test_languages_of_held_out_rows_sources_and_ids_dont_count(spark):
    rows = corpus(random.Random(1))
    schema = "doc_id long, text string, lang string, source string"

    def predictions(some):
        return {x["doc_id"]: (x["held_out"], x["lang_pred"], x["score"]) for x in language_id.language_id(spark.createDataFrame(some, schema).repartition(3, "doc_id")).collect()}

    first = predictions(rows)
    assert {i for i, (held, _, _) in first.items() if held} == {i for i, *_ in rows if held_out(i)}
    again = predictions([(i, t, "fr" if held_out(i) else lang, "other") for i, t, lang, _ in rows])
    assert again == first
    gone = predictions([(i, t, None if held_out(i) else lang, None) for i, t, lang, _ in rows])
    assert gone == first
    same = predictions([*rows, (10_000, rows[5][1], "xx", "s"), (None, rows[5][1], "xx", "t")]) if held_out(10_000) else None
    assert same is None or same[10_000][1] == same[5][1] == same[None][1]


def test_labels_of_held_out_rows_and_other_columns_dont_count(spark):
    r = random.Random(2)
    rows = [(i, " ".join(r.choice(("good fine clear plain" if i % 2 else "spam click buy now").split()) + r.choice("xyz") for _ in range(30)), "en", "s") for i in range(200)]
    schema = "doc_id long, text string, lang string, source string"

    def scores(some, labels):
        out = quality.quality(spark.createDataFrame(some, schema).repartition(3, "doc_id"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int").repartition(2, "doc_id")).collect()
        return {x["doc_id"]: (x["held_out"], x["score"], x["predicted"]) for x in out}

    labels = [(i, i % 2, 0) for i in range(0, 200)]
    first = scores(rows, labels)
    assert np.mean([p == i % 2 for i, (_, _, p) in first.items()]) > 0.9
    assert scores([(i, t, "de", "other") for i, t, _, _ in rows], [(i, 1 - q if held_out(i) else q, 1) for i, q, _ in labels]) == first
    assert scores(rows, [x for x in labels if not held_out(x[0])]) == first


BENCHMARK = "item_id long, text string"
DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


def tables(spark, at, rows, schema=DOCUMENTS):
    spark.createDataFrame(rows, schema).repartition(2).write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame([(1, "one two three four five six seven eight nine ten eleven")], BENCHMARK).write.parquet(f"{at}/benchmark.parquet")


def test_pipeline_without_documents(spark, tmp_path):
    import corpus_pipeline

    tables(spark, tmp_path, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_with_columns_of_its_own_names(spark, tmp_path):
    import corpus_pipeline

    extra = "key string, n_lines int, n_removed long, lang_pred string, lang_score double, row_key long, stay_id long, copies int, component_id long, contaminated boolean, Text_ string"
    rows = [(i, f"own words {i} {chr(97 + i) * 7}\nshared line of a footer here", "en", "s", 5, "k", 1, 2, "x", 0.5, 3, 4, 5, 6, True, "t") for i in range(12)]
    tables(spark, tmp_path, [*rows, rows[3], (None, None, *rows[0][2:])], f"{DOCUMENTS}, {extra}")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert {x["doc_id"] for x in got} == set(range(12))
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns, name


@pytest.mark.parametrize("breaks", [" ", "\n"])
def test_pipeline_with_a_very_long_text(spark, tmp_path, breaks):
    import corpus_pipeline

    r = random.Random(4)
    long = breaks.join(f"w{r.randrange(10**6)}x{i % 7}" for i in range(120_000))
    tables(spark, tmp_path, [(1, long, "en", "s", len(long)), (2, "short text of its own", "en", "s", 20), (3, long + breaks + "more", "en", "s", len(long))])
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by = {}
    for x in got:
        by.setdefault(x["doc_id"], []).append((x["start"], x["length"], x["doc_tokens"]))
    assert {1, 2} <= set(by)
    for pieces in by.values():
        pieces.sort()
        assert sum(n for _, n, _ in pieces) == pieces[0][2] and [s for s, _, _ in pieces] == [sum(n for _, n, _ in pieces[:k]) for k in range(len(pieces))]
