"""Operators beyond SQL against plain versions, and edge cases."""

import itertools
import json
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from celldex.functions import scalars
from celldex.operators import export, geometry, manifest, matching
from celldex.plans.queries import ALL

DIR = "/root/testdata/sf0.01"


def test_assign():
    r = np.random.default_rng(0)
    for n, m in ((1, 1), (2, 4), (4, 4), (5, 6)):
        for _ in range(20):
            cost = r.integers(0, 9, (n, m)).astype(float)
            got = cost[np.arange(n), matching.assign(cost)].sum()
            assert got == min(sum(cost[i, j] for i, j in enumerate(p)) for p in itertools.permutations(range(m), n))


def test_best_matches(spark):
    r = random.Random(3)
    a, b = ([(i, r.uniform(0, 30), r.uniform(0, 30)) for i in range(n)] for n in (14, 11))
    a.append((99, None, 1.0))
    frame = lambda rows: spark.createDataFrame(rows, "id long, x double, y double")
    near = {(i, j): d for i, x, y in a[:-1] for j, u, v in b if (d := ((x - u) ** 2 + (y - v) ** 2) ** 0.5) <= 5}

    def best(left, used):
        if not left:
            return 0, 0.0
        tries = [best(left[1:], used)]
        for j in range(11):
            if (left[0], j) in near and j not in used:
                n, d = best(left[1:], used | {j})
                tries.append((n + 1, d - near[left[0], j]))
        return max(tries)

    got = matching.best_matches(frame(a), frame(b), 5.0).collect()
    n, d = best([x[0] for x in a[:-1]], frozenset())
    assert len(got) == n == len({x["a"] for x in got}) == len({x["b"] for x in got})
    assert sum(x["distance"] for x in got) == pytest.approx(-d)
    large = matching.best_matches(frame(a), frame(b), 5.0, most=0).collect()
    assert 0 < len(large) <= n and all((x["a"], x["b"]) in near for x in large)
    assert matching.best_matches(frame(a), frame([]), 5.0).count() == 0


def test_convex_area(spark):
    square = [(1, x, y) for x in range(4) for y in range(4)]
    ell = [(2, x, y) for x in range(5) for y in range(5) if x == 0 or y == 0]
    got = {x["label"]: x for x in geometry.convex_area(spark.createDataFrame([*square, *square, *ell, (None, 0, 0), (3, 7, 7)], "label long, x long, y long")).collect()}
    assert (got[1]["area"], got[1]["convex_area"], got[3]["convex_area"]) == (16, 16, 1)
    assert (got[2]["area"], got[2]["convex_area"]) == (9, 15) and set(got) == {1, 2, 3}


def test_features(spark):
    rows = spark.createDataFrame([(7, 2.0, 4.0, 1.23456, float("nan"))], "label long, cx double, cy double, A double, B double")
    got = json.loads(export.features(rows, "label", "cx", "cy", ["A", "B"], 0.5).head()["feature"])
    assert got["geometry"] == {"type": "Point", "coordinates": [2.0, 4.0]} and got["id"] == "7"
    assert {m["name"]: m["value"] for m in got["properties"]["measurements"]} == {"label": 7.0, "Centroid X µm": 1.25, "Centroid Y µm": 2.25, "A": 1.2346}


def test_pair_by_signature(spark):
    frame = lambda rows: spark.createDataFrame(rows, "name string, channels array<string>")
    slides = frame([("s1", ["DAPI", "CD3"]), ("s2", ["DAPI", "CD8"])])
    got = manifest.pair_by_signature(slides, frame([("f2", ["cd8", "dapi"]), ("f1", ["cd3", "dapi"])])).collect()
    assert {(x["slide"], x["file"]) for x in got} == {("s1", "f1"), ("s2", "f2")}
    with pytest.raises(ValueError, match="cd8"):
        manifest.pair_by_signature(slides, frame([("f1", ["cd3", "dapi"])]))


def test_scalars(spark):
    rows = spark.createDataFrame([("1h 2m 3.5s", "50 %", "a| b ||"), ("-", "-", ""), (None, None, None), ("250ms", "nan%", "x")], "t string, p string, c string")
    got = rows.select(scalars.parse_duration(F.col("t")).alias("t"), scalars.parse_percent(F.col("p")).alias("p"), scalars.split_channels(F.col("c")).alias("c"), scalars.packed_color(F.lit(0), F.lit(255), F.lit(255), F.lit(255)).alias("k")).collect()
    assert [x["t"] for x in got] == [3723.5, None, None, 0.25] and [x["p"] for x in got] == [50.0, None, None, None]
    assert [x["c"] for x in got] == [["a", "b"], [], None, ["x"]] and got[0]["k"] == -16711681


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in ALL.items() if not sql))
def test_runs(spark, name):
    assert ALL[name][0](spark, DIR).count() > 0
