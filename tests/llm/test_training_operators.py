"""The training-data operators against plain versions, on small tables with nulls, ties, repeats and clashing columns."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from celldex.llm import decontamination, language_id, licenses, line_dedup, neighbours, ngram_join, packing, quality, substring_dedup, token_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key string, n_lines int"


def docs(spark, texts):
    rows = [(i, t, "en", "s", len(t or ""), "k", 7) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def words(r, n, vocabulary=4000):
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="module")
def corpus():
    """Copies, near copies, shared passages, repeated words, nulls, empties and a very long text."""
    r = random.Random(5)
    out, base, passage = [], words(r, 120), " ".join(words(r, 40))
    for i in range(60):
        kind = i % 6
        w = words(r, r.randrange(1, 90))
        if kind == 0:
            w = list(base)
            for _ in range(r.randrange(0, 6)):
                w[r.randrange(len(w))] = f"x{r.randrange(10**6)}"
        text = " ".join(w)
        if kind == 1:
            text += "\n" + passage + "\n" + " ".join(words(r, 5))
        out.append((i, text))
    out += [(100, None), (101, ""), (102, " \n\t "), (103, "a"), (104, "B c"), (105, "a " * 80), (106, out[7][1]), (107, " ".join(words(r, 5000)))]
    short = [" ".join(base[:k]) for k in (11, 12, 13, 20, 21, 30)]
    return out + [(200 + i, t) for i, t in enumerate(short)]


def test_line_dedup(spark):
    r = random.Random(2)
    lines = [" ".join(words(r, 8)) for _ in range(12)]
    for x in list(lines):
        k = r.randrange(len(x))
        lines += [x[:k] + x[k + 1 :], x[:k] + "Z" + x[k:], x[:k] + "Z" + x[k + 1 :], x[: k // 2] + "QQ" + x[k // 2 :]]
    texts = [(i, "\n".join(r.choice(lines + ["", " ", "short", "shor"]) for _ in range(r.randrange(1, 12)))) for i in range(60)]
    got = {x["doc_id"]: x for x in line_dedup.line_dedup(docs(spark, [*texts, (900, None), (901, "")])).collect()}
    want = line_dedup.brute(texts)
    assert {k: got[k]["text"] for k in want} == want
    assert got[900]["text"] is None and got[901]["text"] == "" and got[900]["key"] == "k" and got[900]["n_lines"] == 0
    assert line_dedup.line_dedup(docs(spark, [(1, "x")]).limit(0)).count() == 0
    twice = line_dedup.line_dedup(docs(spark, [(5, "one\ntwo"), (5, "one\ntwo"), (None, "two")])).collect()
    assert sorted((x["doc_id"] or -1, x["text"]) for x in twice) == [(-1, "two"), (5, "one"), (5, "one")]


def test_substring_dedup(spark, corpus):
    got = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substring_dedup.substring_dedup(docs(spark, corpus)).collect()}
    assert [got[i] for i, _ in corpus] == substring_dedup.brute([t for _, t in corpus])
    assert substring_dedup.substring_dedup(docs(spark, [(None, None)])).head()["n_words"] == 0
    assert substring_dedup.substring_dedup(docs(spark, [(1, "x")]).limit(0)).count() == 0


def test_index_compacts(spark, corpus):
    some = docs(spark, corpus)
    a = substring_dedup.substring_dedup(some, batches=6).select("doc_id", "kept_sha256")
    b = substring_dedup.substring_dedup(some, batches=1).select("doc_id", "kept_sha256")
    assert a.exceptAll(b).count() == 0


def test_new_batches_against_a_kept_index(spark, corpus, tmp_path):
    """Three batches, each in a log opened anew: every text loses what repeats in it or in those before."""
    r = random.Random(8)
    texts = [(i, t) for i, t in corpus if t]
    r.shuffle(texts)
    cut = [texts[:25], texts[25:50], texts[50:]]
    for i, batch in enumerate(cut):
        log = substring_dedup.Log(spark, fan=1, folder=str(tmp_path / "index"))
        assert len(log.runs) == min(i, 1)
        before = [x for b in cut[:i] for x in b]
        got = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept_sha256"]) for x in substring_dedup.new_batch(log, docs(spark, batch), docs(spark, before)).collect()}
        want = substring_dedup.brute([t for _, t in batch + before])[: len(batch)]
        assert [got[k] for k, _ in batch] == want
        log.drop()


@pytest.mark.parametrize("small_list", [12, 1])
def test_ngram_join(spark, corpus, small_list, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL_LIST", small_list)
    r = random.Random(9)
    base, more = words(r, 60), []
    for i in range(40):
        w = list(base)
        for _ in range(r.randrange(0, 3)):
            w[r.randrange(len(w))] = f"y{r.randrange(9)}"
        more.append((500 + i, " ".join(w[: r.randrange(50, 61)])))
    texts = corpus + more
    got = {x["doc_id"]: (x["n_shingles"], x["component_id"]) for x in ngram_join.ngram_join(docs(spark, texts)).collect()}
    assert got == ngram_join.brute(dict(texts))
    assert ngram_join.ngram_join(docs(spark, [(None, "a b c"), (None, None)])).where("component_id is null").count() == 2
    assert ngram_join.ngram_join(docs(spark, [(1, "x")]).limit(0)).count() == 0


def test_decontamination(spark, corpus):
    items = {"1": " ".join(corpus[1][1].split()[:14]), "2": "W5", "3": corpus[2][1][:30], "4": None, "5": "...", "6": "B c", "7": "a a a a a a a a a a a a"}
    bench = spark.createDataFrame([(int(k), t) for k, t in items.items()] + [(None, "a"), (2, "W5")], "item_id long, text string")
    for most in (1 << 20, 60):
        got = {x["doc_id"]: x for x in decontamination.decontaminate(docs(spark, corpus), bench, most).collect()}
        for i, t in corpus:
            n, hit, found = decontamination.brute(t, items)
            x = got[i]
            assert (x["n_words"], x["n_hit"], x["n_items"], x["items_sha256"], x["contaminated"]) == (n, hit, len(found), decontamination.items_digest(found), hit > 0)
    assert decontamination.decontaminate(docs(spark, corpus), bench.limit(0)).where("contaminated").count() == 0


def test_token_counts(spark, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    odd = [(300, "it's<|endoftext|> a\n\n  b　c\x1cd"), (301, "éß " * 50), (None, "x y"), (None, "x y")]
    library = Tokenizer.from_file(path)
    want = sorted((i if i is not None else -1, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in corpus + odd)
    for frequent in (200_000, 0, 20):
        got = token_counts.token_counts(docs(spark, corpus + odd), path, frequent).collect()
        assert sorted((x["doc_id"] if x["doc_id"] is not None else -1, x["n_bytes"], x["n_tokens"]) for x in got) == want
        assert all(x["over_limit"] == (x["n_tokens"] > 1024) for x in got)


def test_packing(spark, corpus):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    odd = [(300, "It's<|endoftext|> a\n\n  B　c\x1cd.́ 12,5"), (301, "Éßİ " * 50), (None, "x y"), (301, "other")]
    texts = corpus + odd
    library = Tokenizer.from_file(path)
    got = packing.pack(docs(spark, texts), path).collect()
    whole = sorted((i if i is not None else -1, tuple(library.encode(t or "", add_special_tokens=False).ids + [2])) for i, t in texts)
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    want = sorted((i, s, len(ids[s : s + 4096]), crc(ids[s : s + 4096]), len(ids)) for i, ids in whole for s in range(0, len(ids), 4096))
    assert sorted((x["doc_id"] if x["doc_id"] is not None else -1, x["start"], x["length"], x["ids_crc32"], x["doc_tokens"]) for x in got) == want
    by = {}
    for x in got:
        by.setdefault(x["sequence_id"], []).append((x["offset"], x["length"]))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096


def test_packing_plan_wastes_little():
    n = np.bincount(np.clip(np.random.default_rng(0).lognormal(6.4, 1, 20_000), 1, 4095).astype(int), minlength=4096)
    runs, total = packing.plan(n)
    placed = np.zeros(4096, int)
    for length, a, b, _, _ in runs:
        placed[length] += b - a
    assert (placed == n).all() and 1 - (n * np.arange(4096)).sum() / (4096 * total) < 0.01
    assert packing.plan_of(n)[2] > n.sum() / 2


def test_repeats_never_ask_for_more_than_there_is():
    r = np.random.default_rng(1)
    ways = packing.combinations(16, 4)
    a = np.array([[w.count(b) for w in ways] for b in range(1, 17)], float)
    for hist in (r.integers(0, 50, 16), np.eye(16, dtype=int)[3] * 40, np.zeros(16, int)):
        x = packing.repeats(a, hist)
        assert (x >= 0).all() and (a @ x <= hist).all()


def test_language_id(spark):
    r = random.Random(1)
    make = {"aa": "kla mor tep sun", "bb": "über öst äng ßu", "cc": "xyz zyx qqx zzq"}
    rows = [(i, " ".join(r.choices(make[k].split(), k=r.randrange(5, 200))), k, "s", 0, "k", 1) for i in range(300) for k in [r.choice(list(make))]]
    odd = [(1000, None, "aa", "s", 0, "k", 1), (1001, "12 !", "bb", "s", 0, "k", 1), (None, "kla mor", None, "s", 0, "k", 1)]
    df = spark.createDataFrame(rows + odd, SCHEMA)
    got = {x["doc_id"]: x for x in language_id.language_id(df).collect()}
    held = [x for x in rows if zlib.crc32(str(x[0]).encode()) % 4 == 2]
    assert sum(got[x[0]]["lang_pred"] == x[2] for x in held) > 0.95 * len(held) and all(got[x[0]]["held_out"] for x in held)
    assert got[1000]["lang_pred"] == got[1001]["lang_pred"] == "und" and got[None]["held_out"] is False
    assert language_id.language_id(df.limit(0)).count() == 0 and language_id.language_id(df.withColumn("lang", F.lit(None).cast("string"))).where("lang_pred <> 'und'").count() == 0


def test_quality(spark):
    r = random.Random(1)
    texts = [(i, " ".join((["good"] if i % 4 else ["bad"]) * (r.random() < 0.95) + words(r, r.randrange(3, 60), 300))) for i in range(600)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i, _ in texts] + [(3, None, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    df = docs(spark, [*texts, (9000, None), (9001, "")])
    got = {x["doc_id"]: x for x in quality.quality(df, labels).collect()}
    held = [i for i, _ in texts if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([got[i]["predicted"] == (i % 4 > 0) for i in held]) > 0.85
    assert all(0 <= x["score"] <= 1 and x["predicted"] == (x["score"] >= 0.7) for x in got.values()) and got[9000]["score"] == got[9001]["score"]
    assert quality.quality(df, labels.limit(0)).head()["score"] == 0.5


def test_licenses(spark):
    mit = licenses.KNOWN["MIT"][1]
    texts = [(1, "Copyright (c) 2020 X\n\n" + mit.replace("sublicense", "sub" + "licence").upper()), (2, "hello\n  released under the MIT licence!\nAll  rights reserved"), (3, None), (4, ""), (5, "Copyright all rights reserved")]
    got = {x["doc_id"]: (x["license"], x["n_lines"], x["licenses"]) for x in licenses.license_scan(docs(spark, texts), licenses.known(spark)).collect()}
    assert got == {1: ("MIT", 0, ""), 2: (None, 2, "LicenseRef-all-rights-reserved,MIT"), 3: (None, 0, ""), 4: (None, 0, ""), 5: (None, 0, "")}


def test_neighbours(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(900, 16)).astype(np.float32)
    x[100:400] = x[100]
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + [(2000, None, 0), (2001, [0.0] * 16, 0), (2002, [float("nan")] * 16, 0), (2003, [1.0, 2.0], 0), (None, x[0].tolist(), 0)]
    v = neighbours.usable(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")).cache()
    assert v.count() == 900
    got = {}
    for a in neighbours.nearest(v, v.where("vec_id % 20 = 0"), sample=400).collect():
        got.setdefault(a["query_id"], []).append((a["rank"], a["vec_id"], a["score"]))
    s, hit = x.astype(float) @ x.astype(float).T, 0
    for q in range(0, 900, 20):
        want = [i for i in np.lexsort((np.arange(900), -np.round(s[q], 9))) if i != q][:20]
        mine = [i for _, i, _ in sorted(got[q])]
        hit += len(set(want) & set(mine))
        assert len(mine) == 20
    assert hit >= 0.9 * 20 * 45
    assert neighbours.nearest(v.limit(0), v.limit(0)).count() == 0


@pytest.mark.parametrize("most_parts", [120, 6])
def test_neighbours_route_to_few_of_many_parts(spark, monkeypatch, most_parts):
    """Clustered vectors in 30 leaves, at one level and at two: a recall of 0.9 by comparing with less than 0.3 of all."""
    monkeypatch.setattr(neighbours, "MOST_PARTS", most_parts)
    r = np.random.default_rng(2)
    centre = r.normal(size=(60, 24))
    x = centre[r.integers(0, 60, 4500)] + 0.35 * r.normal(size=(4500, 24))
    v = neighbours.usable(spark.createDataFrame([(i, a.tolist(), "x") for i, a in enumerate(x)], "vec_id long, embedding array<float>, part string").repartition(3)).cache()
    share, got = [], {}
    for a in neighbours.nearest(v, v.where("vec_id % 20 = 0"), part=150, scanned=share.append).collect():
        got.setdefault(a["query_id"], []).append(a["vec_id"])
    tree = neighbours.grow(v, 4500, 150)
    assert tree.leaves >= 20 and bool(tree.inner) == (most_parts == 6)
    x = x.astype(np.float32).astype(float)
    s = x[::20] @ x.T
    s[np.arange(225), np.arange(0, 4500, 20)] = -np.inf
    best = np.argsort(-s, axis=1)[:, :20]
    assert all(len(got[q]) == 20 for q in range(0, 4500, 20))
    assert np.mean([len(set(best[i]) & set(got[q])) / 20 for i, q in enumerate(range(0, 4500, 20))]) >= 0.9
    assert share[0] < 0.3


def test_neighbours_with_few_in_their_parts_visit_all(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "visits", lambda *_: 1)
    r = np.random.default_rng(3)
    rows = [(i, a.tolist()) for i, a in enumerate(r.normal(size=(240, 6)))]
    v = neighbours.usable(spark.createDataFrame([*rows, *rows[:9]], "vec_id long, embedding array<float>")).cache()
    n = neighbours.nearest(v, v.where("vec_id % 20 = 0"), k=100, part=20).groupBy("query_id").count().collect()
    assert v.count() == 240 and len(n) == 12 and all(x["count"] == 100 for x in n)


def test_pipeline(spark, tmp_path, corpus):
    import corpus_pipeline

    r = random.Random(4)
    clean = [(3000 + i, " ".join(words(r, 50, 10**6))) for i in range(5)]
    leak = (4000, " ".join(words(r, 30, 10**6)))
    keep = docs(spark, [*corpus, *clean, leak]).drop("key", "n_lines")
    keep.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, " ".join(leak[1].split()[5:20]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    ids = {x["doc_id"] for x in out}
    assert {i for i, _ in clean} <= ids and not ids & {100, 101, 102, 4000, 106}
