"""Token alignment, hard negatives and URL rules against plain versions."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from celldex.llm import hard_negatives, token_alignment, url_rules

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog."),
    (2, None),
    (3, ""),
    (4, "double  spaces, a tab\tand\nnew  \n lines \u00a0 end "),
    (5, "holds ▁ itself"),
    (6, "naïve café 漢字 🙂 <|endoftext|> <s> <unk> <0x41>"),
    (7, " leading and trailing  "),
    (8, "x" * 30_000 + " " + "it's we'll 12345 " * 3000),
    (9, "The quick brown fox jumps over the lazy dog."),
    (9, "The quick brown fox"),
    (None, "no id\x00 here \x1c  y"),
    (10, "   "),
    (11, " "),
    (12, "a\u3000 b\u2028 c"),
]


def plain(texts):
    """Whole texts by the libraries; rows of the contract."""
    import json

    from sentencepiece import SentencePieceProcessor
    from tokenizers import Tokenizer

    a, b = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a.encode_special_tokens = True
    table = {v: k for k, v in json.load(open(A, encoding="utf-8"))["model"]["vocab"].items()}
    level = token_alignment._byte_level()
    rows, links = [], []
    for doc_id, text in texts:
        got, mine, shown = [], [], ""
        if text:
            want = (" " + text).encode()
            x, y = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
            p = [bytes(level[c] for c in table[i]) for i in x]
            q = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
            if b"".join(p) == want == b"".join(q):
                at = {int(e): k for k, e in enumerate(np.cumsum([len(t) for t in p]))}
                of = {int(e): k for k, e in enumerate(np.cumsum([len(t) for t in q]))}
                i = j = 0
                parts = []
                for e in sorted(at.keys() & of.keys()):
                    parts.append(",".join(map(str, x[i : at[e] + 1])) + "|" + ",".join(map(str, y[j : of[e] + 1])))
                    i, j = at[e] + 1, of[e] + 1
                    mine.append((x[i - 1], y[j - 1]))
                got, shown = [len(x), len(y), len(parts)], ";".join(parts)
        rows.append([doc_id, *(got or [0, 0, 0]), hashlib.sha256(shown.encode()).hexdigest() if got else "", shown])
        links.append(mine)
    count = Counter(p for m in links for p in m)
    best = Counter()
    for (_, j), n in count.items():
        best[j] = max(best[j], n)
    return [(*r[:5], len(m), sum(count[p] == best[p[1]] for p in m), sum(count[p] for p in m)) for r, m in zip(rows, links, strict=True)], [r[5] for r in rows]


def test_alignment_is_the_libraries(spark):
    docs = spark.createDataFrame([(i, t, 1, "k") for i, t in TEXTS], "doc_id long, text string, n_a int, keys string").repartition(4)
    got = token_alignment.token_alignment(docs, A, B)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "n_links", "n_best", "count_sum"]
    want, shown = plain(TEXTS)
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(map(str, want))
    assert want[4][1:4] == (0, 0, 0) and want[4][4] == "" and want[6][1] > 0
    groups = token_alignment.align(docs, A, B, with_groups=True).select("groups").collect()
    assert sorted(x["groups"] for x in groups) == sorted(shown)
    assert token_alignment.token_alignment(docs.limit(0), A, B).count() == 0
    assert token_alignment.token_alignment(docs.where("text is null or text = ''"), A, B).agg(F.sum("n_links")).head()[0] == 0


def test_alignment_of_the_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want, _ = plain([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert sorted(map(str, map(tuple, token_alignment.token_alignment(docs.repartition(5), A, B).collect()))) == sorted(map(str, want))


def test_runs_and_shards(spark, monkeypatch):
    r = np.random.default_rng(1)
    keys, n = np.sort(r.integers(0, 50, 400)) + (3 << 32), r.integers(1, 9, 400)
    pieces = np.array_split(np.arange(400), 23)
    got = [np.concatenate(x) for x in zip(*token_alignment.runs((keys[i], n[i]) for i in [*pieces, pieces[0][:0]]), strict=True)]
    want = token_alignment.summed(keys, n)
    assert all((a == b).all() for a, b in zip(got, want, strict=True))
    pairs = spark.createDataFrame([(int(k), int(v)) for k, v in zip(keys, n, strict=True)] + [(7, 1)], "key long, n long")
    shards = token_alignment.count_shards(pairs, 3)
    every = np.concatenate(([7], want[0]))
    assert len(shards.uris) > 1 and shards.of(every).tolist() == [1, *want[1].tolist()]
    assert isinstance(shards.shard(0).base, np.memmap) or isinstance(shards.shard(0), np.memmap)
    assert shards.best[3] == want[1].max() and shards.best[0] == 1
    monkeypatch.setattr(token_alignment, "MOST_KEYS", 4)  # flushes early; sums are the same
    rows = spark.createDataFrame([([1, 5, 9], [1, 2, 3]), ([1, 2, 3], [1, 1, 1]), ([9, 10], [4, 5]), ([], [])] * 5, "keys array<long>, times array<long>").repartition(2)
    sums = {k: v for k, v in token_alignment.partial_counts(rows).groupBy("key").agg(F.sum("n")).collect()}
    assert sums == {1: 10, 5: 10, 9: 35, 2: 5, 3: 5, 10: 25}


# ---- hard negatives


def brute(rows, k=5, per=3):
    """rows: (vec_id, label, ints or None); the contract by sorting."""
    rows = [(i, lab, v) for i, lab, v in rows if i is not None and lab is not None and v is not None]
    width = max((len(v) for _, _, v in rows), default=0)
    x = [[*v, *[0] * (width - len(v))] for _, _, v in rows]
    out = []
    for a, (i, lab, _) in enumerate(rows):
        if i % 50:
            continue
        score = [sum(p * q for p, q in zip(x[a], y, strict=True)) for y in x]
        order = sorted(range(len(rows)), key=lambda j: (-score[j], rows[j][0]))
        for p in [j for j in order if j != a and rows[j][1] == lab][:k]:
            fit = [j for j in order if rows[j][1] != lab and 50 * score[p] <= 100 * score[j] <= 95 * score[p]]
            out += [(i, rows[p][0], r, rows[j][0], score[p], score[j]) for r, j in enumerate(fit[:per], 1)]
    return sorted(out)


def vectors(spark, rows, cut=4):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, anchor string, row int").repartition(cut)


def relabelled(rows):
    def ints(v):
        if v is None or any(x is None or not np.isfinite(x) for x in v):
            return None
        return [int(np.floor(256 * x)) for x in v]

    return [(i, (lab + 1) % 10 if i is not None and lab is not None and i % 7 == 0 else lab, ints(v)) for i, v, lab, *_ in rows]


@pytest.mark.parametrize("scale", [1.0, 300.0, 70_000.0])
def test_hard_negatives_by_brute_force(spark, scale):
    r = np.random.default_rng(4)
    middle = r.normal(0, 1, (12, 8))
    rows = []
    for i in range(700):
        v = (middle[i % 12] + r.normal(0, 0.4, 8)) * scale
        rows.append((i, [float(x) for x in np.round(v, 2)], int(i % 12 % 10) if i % 3 else int(r.integers(0, 10)), "x", 1))
    rows += [(1000 + i, rows[5][1], i % 10, "x", 1) for i in range(80)]  # ties
    rows += [(2000, None, 1, "x", 1), (2050, [1.0] * 8, None, "x", 1), (2100, [float("nan")] * 8, 2, "x", 1), (2150, [None] * 8, 3, "x", 1), (2200, [float("inf"), *[0.0] * 7], 3, "x", 1)]
    rows += [(None, [0.5] * 8, 3, "x", 1), (2250, [0.0] * 8, 3, "x", 1), (2300, [], 4, "x", 1), (2350, [scale] * 3, 4, "x", 1), (-50, [-scale] * 8, 5, "x", 1)]
    rows += [(350, rows[1][1], 3, "x", 1), (350, rows[2][1], 6, "x", 1), rows[100], rows[3], rows[3]]  # repeated ids and rows
    rows += [(5000, [scale * 2] * 8, 77, "x", 1)]  # no positive
    got = hard_negatives.hard_negatives(vectors(spark, rows), block=64, chunk=9)
    assert got.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, got.collect())) == brute(relabelled(rows))


def test_hard_negatives_of_nothing_and_of_one_label(spark):
    none = vectors(spark, [(1, [1.0], 1, "x", 1)]).where("vec_id > 1")
    assert hard_negatives.hard_negatives(none).count() == 0
    assert hard_negatives.hard_negatives(vectors(spark, [(1, [1.0], 1, "x", 1)])).count() == 0
    same = [(i, [float(i % 5), 1.0], 1, "x", 1) for i in range(1, 120) if i % 7]
    assert hard_negatives.hard_negatives(vectors(spark, same), block=16).count() == 0
    every = [(i, [float(i % 5), 1.0], i % 90, "x", 1) for i in range(1, 300) if i % 7]  # many labels
    assert sorted(map(tuple, hard_negatives.hard_negatives(vectors(spark, every), block=16).collect())) == brute(relabelled(every))


def test_trees_drop_most_pairs_of_clusters(spark):
    r = np.random.default_rng(6)
    middle = r.normal(0, 1, (40, 16))
    rows = [(i, [float(x) for x in middle[i % 40] * (1 + i % 3) + r.normal(0, 0.05, 16)], i % 40 % 10, "x", 1) for i in range(4000)]
    share = {}
    got = hard_negatives.hard_negatives(vectors(spark, rows), scored=share.__setitem__)
    assert sorted(map(tuple, got.collect())) == brute(relabelled(rows))
    assert share["positives"] < 0.2 and share["negatives"] < 0.8, share


def test_tree_and_intervals():
    r = np.random.default_rng(2)
    x, label = r.normal(0, 50, (500, 6)).round().astype(np.int64), np.sort(r.integers(0, 3, 500))
    tree = hard_negatives.Tree(x, label, 16)
    assert sorted(tree.order.tolist()) == list(range(500))
    for i in range(len(tree.size)):
        rows = tree.order[tree.first[i] : tree.first[i] + tree.size[i]]
        assert (np.sqrt(((x[rows] - tree.centre[i]) ** 2).sum(1)) <= tree.radius[i]).all()
        assert (tree.low[i], tree.high[i]) == (label[rows].min(), label[rows].max())
    big = np.array([[1 << 27, 3], [5, 7]])
    assert hard_negatives.dots(big, big, float(1 << 54)).tolist() == [[(1 << 54) + 9, 5 * (1 << 27) + 21], [5 * (1 << 27) + 21, 74]]


# ---- URL rules


def fits(url, rules, default="allow"):
    """The contract, rule by rule; rules without wildcards."""
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (re.sub("[A-Z]", lambda x: x[0].lower(), m[1]), m[2]) if m else ("", "")
    best = max(((len(h) + len(p), len(h), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)), default=None)
    return host, path, best and best[3], best[4] if best else default


URLS = [
    None, "", "no scheme/en/", "://", "http://", "http://EXAMPLE.com/en/x?q#f", "http://www.example.com/en/", "https://m.www.Example.COM/en/a", "http://aexample.com/en/1",
    "http://example.com/en", "http://example.com/EN/1", "http://a.net/es/1", "http://net/fr/", "http://b.net/de/", "http://com", "http://com/", "http://x.com?y=/en/", "http://x.org/a.com/",
    "ftp://a://b.com/en/", "http://user@www.example.com:80/en/", "http://x.net#/es/", "//x.com/en/", "http://ÜX.com/ü", "http://\nx.com/\n/en/", "http://.com/", "http://com./", "http://x.com/" + "a" * 50_000, "http://" + "a" * 9000 + ".net/es/?" + "b" * 9000, "http://x.net/es/\x00",
]


def test_url_rules(spark):
    rows = [(i, u, "k", "h") for i, u in enumerate(URLS)] + [(None, "http://a.com/", "k", "h"), (3, URLS[3], "k", "h")]
    pages = spark.createDataFrame(rows, "page_id long, url string, host string, Path string").repartition(3)
    got = url_rules.url_filter(pages)
    assert got.columns == ["page_id", "host", "path", "rule", "verdict"] and dict(got.dtypes)["page_id"] == "bigint"
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((i, *fits(u, url_rules.RULES))) for i, u, *_ in rows)
    assert url_rules.url_filter(pages.limit(0)).count() == 0
    assert {x["verdict"] for x in url_rules.url_filter(pages, [], "block").collect()} == {"block"}


def test_many_rules_over_many_words_and_blocks():
    r = random.Random(3)
    name = lambda: "".join(r.choice("ab.") for _ in range(r.randrange(1, 5)))
    rules = [(name(), "/" * r.randrange(2) + name() * r.randrange(2), r.choice(["allow", "block"])) for _ in range(300)]
    urls = [f"x://{name()}{name()}/{name()}{name()}" for _ in range(400)]
    for words in (2, 7, 1024):
        compiled = url_rules.Rules(rules, words)
        assert words < 1024 or len(compiled.blocks) == 1
        hosts, paths = zip(*[fits(u, [])[:2] for u in urls], strict=True)
        found = compiled.first([h.encode() for h in hosts], [p.encode() for p in paths])
        got = [(compiled.shown[i], compiled.rules[i][2]) if i >= 0 else (None, "allow") for i in found]
        assert got == [fits(u, rules)[2:] for u in urls]


def test_wildcards():
    rules = [("ads*.x.org", "/*/pic", "block"), ("x.org", "/**/raw/*.png", "block"), ("y.org", "/a\\*b", "block"), ("**", "/deny/", "block")]
    compiled = url_rules.Rules(rules)
    ask = {
        ("ads7.x.org", "/a/pic9"): 0, ("ads.x.org", "/a/b/pic"): -1, ("m.ads.net.x.org", "/a/pic"): 0, ("x.org", "/p/q/raw/z.png"): 1, ("x.org", "/p/raw/q/z.png"): -1,
        ("x.org", "/raw/z.png"): -1, ("y.org", "/a*b"): 2, ("y.org", "/acb"): -1, ("any.where", "/deny/x"): 3, ("any.where", "/x/deny/"): -1,
    }
    got = compiled.first([h.encode() for h, _ in ask], [p.encode() for _, p in ask])
    assert [compiled.rules[i] if i >= 0 else None for i in got] == [rules[i] if i >= 0 else None for i in ask.values()]
