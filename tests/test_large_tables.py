"""Large keys, far coordinates, crowded places and hot labels: what once failed, differed or grew beyond the input."""

import json
import math
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from celldex.functions import scalars
from celldex.operators import export, geometry, manifest, matching, pairing, planes, registration, shapes, tile_registration


def test_downsample_factor_of_narrow_planes(spark):
    sizes = [(120_100, 87), (100, 87), (7, 90_001), (9000, 1), (1, 1), (5_000_000, 2), (450, 1900)]
    rows = spark.createDataFrame(sizes, "h long, w int").select("h", "w", *[scalars.downsample_factor(F.col("h"), F.col("w"), most).alias(f"f{most}") for most in (9000, 7, 1)])
    for r in rows.collect():
        for most in (9000, 7, 1):
            f = r[f"f{most}"]
            blocks = lambda f: -(-r["h"] // f) * -(-r["w"] // f)  # noqa: B023, E731
            assert blocks(f) <= most and (f == 1 or blocks(f - 1) > most)


def test_area_closing_of_a_high_plane_number(spark):
    a = np.random.default_rng(4).integers(0, 3, (20, 19))
    rows = [(p, x, y, int(a[y, x])) for p in (0, 5000) for y in range(20) for x in range(19)]
    got = planes.unpacked(planes.area_closing(planes.packed(spark.createDataFrame(rows, "plane long, x long, y long, v long"), 20, 19, 8), 9)).collect()
    by = {p: {(r["x"], r["y"]): r["v"] for r in got if r["plane"] == p} for p in (0, 5000)}
    assert len(by[0]) == 380 and by[0] == by[5000]


def test_json_numbers_are_plain(spark):
    values = [0.0, -0.5, 1e7, 123456789.125, -9.87654321e15, 1e16, 1.5e300, 0.0012, 0.00012345, 1e-5, -2.5e-7, 1234.5678]
    got = spark.createDataFrame([(v,) for v in values], "v double").select(F.col("v"), scalars.number_text(F.col("v")).alias("t")).collect()
    assert [r["t"] for r in got] == [json.dumps(r["v"]) for r in got]
    rows = spark.createDataFrame([(12_345_678, 2e7, 4.0, 1.23456, None)], "label long, cx double, cy double, `A \"x\"` double, B double")
    text = export.features(rows, "label", "cx", "cy", ['A "x"', "B"], 0.5).head()["feature"]
    assert '"value":12345678.0}' in text and '"coordinates":[20000000.0,4.0]' in text
    assert [m["name"] for m in json.loads(text)["properties"]["measurements"]] == ["label", "Centroid X µm", "Centroid Y µm", 'A "x"']


def test_exported_values_round_as_doubles(spark):
    """Halves by the scaled double, a sign that stays on zero, and values of which Spark's decimals have other last digits."""
    values = [0.00015, 0.00025, -0.00005, -2e-6, 963351482145.6399, 411684586580.0687, 6654.29655, 1e305, float("inf"), -1234.5]
    got = spark.createDataFrame([(v,) for v in values], "v double").select("v", scalars.round_even(F.col("v"), 4).alias("r")).collect()
    assert [str(r["r"]) for r in got] == [str(v if abs(v) > 1e300 else float(np.rint(v * 1e4) / 1e4)) for v in values]
    rows = spark.createDataFrame([(1, 2e-6, 963351482145.6399, -2e-6)], "label long, cx double, cy double, A double")
    assert [m["value"] for m in json.loads(export.features(rows, "label", "cx", "cy", ["A"], 0.5).head()["feature"])["properties"]["measurements"]] == [1.0, 0.25, 481675741073.07, 0.0]
    assert '"value":-0.0}' in export.features(rows, "label", "cx", "cy", ["A"], 0.5).head()["feature"]


def test_centroids_far_out(spark):
    ring = lambda x, y, n: [{"x": float(x + a), "y": float(y + b)} for a, b in ((0, 0), (n, 0), (n, n), (0, n))]
    rows = [(1, ring(360_000_000, 500, 5)), (2, ring(60_000_000, 90_000_000, 5)), (3, ring(50_000_000, 0, 9)), (3, ring(50_000_003, 3, 3)[::-1])]
    got = {r["f"]: (r["area"], r["cx"], r["cy"]) for r in geometry.ring_centroids(spark.createDataFrame(rows, "f long, ring array<struct<x: double, y: double>>"), "f", "ring").collect()}
    for f, want in ((1, (25, 360_000_002.5, 502.5)), (2, (25, 60_000_002.5, 90_000_002.5)), (3, (72, 50_000_004.5, 4.5))):
        assert got[f] == pytest.approx(want, abs=2e-7)


def crowd(n, seed, spread):
    """Points, many in one place, some alone, one without a coordinate."""
    r = random.Random(seed)
    rows = [(i, *r.choice([(5.0, 5.0), (r.uniform(0, spread), r.uniform(0, spread)), (r.gauss(5, 1.5), r.gauss(5, 1.5))])) for i in range(n)]
    return [*rows, (n, None, 1.0), (n + 1, float("nan"), 1.0)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "id long, x double, y double")


def plain_pairs(a, b, radius):
    real = lambda rows: [p for p in rows if None not in p and not math.isnan(p[1])]
    return [((x - u) * (x - u) + (y - v) * (y - v), i, j) for i, x, y in real(a) for j, u, v in real(b) if (x - u) * (x - u) + (y - v) * (y - v) <= radius * radius]


def counted(monkeypatch, module):
    seen, within = [], pairing.within

    def count(*args):
        out = within(*args)
        seen.append(out.count())
        return out

    monkeypatch.setattr(module, "within", count)
    return seen


def test_nearest_of_crowds(spark, monkeypatch):
    a, b = crowd(1500, 1, 60), crowd(1200, 2, 60)
    near, back = {}, {}
    for d2, i, j in plain_pairs(a, b, 9.0):
        near[i], back[j] = min(near.get(i, (9e9, 0)), (d2, j)), min(back.get(j, (9e9, 0)), (d2, i))
    seen = counted(monkeypatch, pairing)
    got = {r["a"]: (r["d2"], r["b"]) for r in pairing.nearest_within(frame(spark, a), frame(spark, b), 9.0).collect()}
    assert got == near and sum(seen) < 40 * len(a) < len(plain_pairs(a, b, 9.0))
    mutual = {(r["a"], r["b"]) for r in pairing.mutual_nearest(frame(spark, a), frame(spark, b), 9.0).collect()}
    assert mutual == {(i, j) for i, (_, j) in near.items() if back[j][1] == i}
    assert pairing.nearest_within(frame(spark, a), frame(spark, []), 9.0).isEmpty() and pairing.nearest_within(frame(spark, a), frame(spark, b), 0.0).isEmpty()


def plain_components(pairs):
    top = {}

    def find(x):
        while top.setdefault(x, x) != x:
            x = top[x]
        return x

    for _, i, j in pairs:
        p, q = find(2 * i), find(2 * j + 1)
        top[max(p, q)] = min(p, q)
    return {x: find(x) for x in list(top)}


@pytest.mark.parametrize(("seed", "spread", "radius"), [(5, 60, 3.0), (6, 300, 6.0), (7, 12, 0.4)])
def test_components_of_crowds(spark, seed, spread, radius):
    a, b = crowd(400, seed, spread), crowd(300, seed + 50, spread)
    got = {r["node"]: r["component"] for r in matching.linked(frame(spark, a), frame(spark, b), radius).collect()}
    assert got == plain_components(plain_pairs(a, b, radius))
    assert matching.linked(frame(spark, a), frame(spark, []), radius).isEmpty() and matching.linked(frame(spark, a), frame(spark, b), 0.0).isEmpty()


def test_cells_that_only_a_few_places_link(spark):
    """Two crowds whose first places are apart, and one pair of places that is in reach."""
    a = [(i, 0.01 * i, 0.0) for i in range(40)] + [(50 + i, 2.0 + 0.01 * i, 0.1) for i in range(3)]
    b = [(i, 0.01 * i, 0.05) for i in range(40)] + [(50 + i, 2.0 + 0.01 * i, 0.1) for i in range(3)]
    for radius in (1.6, 1.61, 1.612, 1.65, 1.9):
        got = {r["node"]: r["component"] for r in matching.linked(frame(spark, a), frame(spark, b), radius).collect()}
        assert got == plain_components(plain_pairs(a, b, radius))


@pytest.fixture
def plans(monkeypatch):
    """Plans of all tables written meanwhile."""
    seen, parquet = [], DataFrameWriter.parquet
    monkeypatch.setattr(DataFrameWriter, "parquet", lambda self, *args, **more: (seen.append(self._df._jdf.queryExecution().executedPlan().toString()), parquet(self, *args, **more))[1])
    return seen


def test_components_of_points_pass_no_table_through_the_driver(spark, plans):
    a, b = crowd(60, 8, 20), crowd(50, 9, 20)
    out = matching.linked(frame(spark, a), frame(spark, b), 4.0)
    assert {r["node"]: r["component"] for r in out.collect()} == plain_components(plain_pairs(a, b, 4.0))
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert len(plans) > 5 and not [p for p in plans if "Broadcast" in p]


def test_large_components_take_no_table_of_pairs(spark, monkeypatch):
    a, b = [(i, i * 1e-4, 0.0) for i in range(900)], [(i, i * 1e-4, 1e-5) for i in range(800)]
    seen = counted(monkeypatch, matching)
    got = matching.best_matches(frame(spark, a), frame(spark, b), 5.0, most=1000).collect()
    assert sum(seen) == 0 and {(r["a"], r["b"], r["exact"]) for r in got} == {(i, i, False) for i in range(800)}


def test_a_component_of_any_size_is_solved_exactly(spark, plans):
    """One chain of 5,202 points, some of them in one place, where the best pairs aren't all each other's nearest."""
    a = [(i, 2.0 * i, 0.0) for i in range(2600)] + [(9000, 0.0, 0.0)]
    b = [(i, 2.0 * i + 1.25, 0.0) for i in range(2600)] + [(9000, 1.25, 0.0)]
    got = matching.best_matches(frame(spark, a), frame(spark, b), 1.5).collect()
    assert len(got) == len({r["a"] for r in got}) == len({r["b"] for r in got}) == 2601 and all(r["exact"] for r in got)
    assert sum(r["distance"] for r in got) == pytest.approx(1.25 * 2601)
    assert plans and not [p for p in plans if "Broadcast" in p]


def test_shipped_is_the_best_of_all():
    r = random.Random(1)
    for _ in range(300):
        supply, room = {i: r.randint(1, 3) for i in range(r.randint(1, 5))}, {j: r.randint(1, 3) for j in range(r.randint(1, 5))}
        length = {(i, j): float(r.choice([r.randint(1, 6), r.uniform(0, 6)])) for i in supply for j in room if r.random() < 0.6}
        supply, room = {i: n for i, n in supply.items() if any(i == k for k, _ in length)}, {j: n for j, n in room.items() if any(j == k for _, k in length)}
        rows, price = matching.shipped(*([*c] for c in zip(*[(i, j, d) for (i, j), d in length.items()], strict=True)), supply, room, 6.0) if length else ([], {})
        u, v = [i for i, n in supply.items() for _ in range(n)], [j for j, n in room.items() for _ in range(n)]
        cost = np.array([[length.get((i, j), 1e4) for j in v] for i in u]).reshape(len(u), len(v))
        best = [x for x in (cost[np.arange(len(u)), matching.assign(cost)] if len(u) <= len(v) else cost[matching.assign(cost.T), np.arange(len(v))]) if x < 1e4] if length else []
        assert sum(n for *_, n in rows) == len(best) and sum(d * n for _, _, d, n in rows) == pytest.approx(sum(best))
        for k, most in ((0, supply), (1, room)):
            assert all(sum(x[3] for x in rows if x[k] == i) <= n for i, n in most.items())
        for i, n in supply.items():  # the price: all that is dearer can be left out
            assert all(length[i, j] <= price[i] + 1e-9 for k, j, *_ in rows if k == i) and (price[i] > 6 or sum(x[3] for x in rows if x[0] == i) == n)


def test_small_components_share_batches(spark):
    """Stars take the nearest; others the best assignment, whichever batch they come in."""
    a = [(10 * k + i, 100.0 * k + i, 0.0) for k in range(60) for i in range(1 + k % 3)]
    b = [(10 * k + i, 100.0 * k + i + 0.25, 0.0) for k in range(60) for i in range(1 + k % 2)]
    got = {r["a"]: r["b"] for r in matching.best_matches(frame(spark, a), frame(spark, b), 2.0).collect()}
    assert got == {10 * k + i: 10 * k + i for k in range(60) for i in range(min(1 + k % 3, 1 + k % 2))}


def test_dense_labels_leave_background_out_of_the_join(spark):
    rows = spark.createDataFrame([(0, i) for i in range(50)] + [(None, 50), (7, 51), (-3, 52), (7, 53)], "label long, k long")
    out = manifest.dense_labels(rows, "label")
    assert {r["k"]: r["label"] for r in out.collect()} == {i: 0 for i in range(50)} | {50: None, 51: 2, 52: 1, 53: 2}
    assert "Union" in out._jdf.queryExecution().optimizedPlan().toString()


def plain_overlap(row, scale=2):
    def inside(ring, origin, height, width):
        out, q = np.zeros((height, width), bool), (ring - origin) * scale
        for y in range(height):
            at = sorted(x0 + (y - y0) * (x1 - x0) / (y1 - y0) for (x0, y0), (x1, y1) in zip(q, np.roll(q, -1, axis=0), strict=True) if (y0 <= y) != (y1 <= y))
            for s, e in zip(at[::2], at[1::2], strict=True):
                out[y, max(0, math.ceil(s)) : max(0, math.floor(e) + 1)] = True
        return out

    rings = {k: [np.array([(p["x"], p["y"]) for p in r], float) for r in v] for k, v in row.items()}
    every = np.concatenate([r for v in rings.values() for r in v] or [np.full((1, 2), np.nan)])
    if not (rings["p"] and rings["q"]):
        return np.nan
    low = every.min(0)
    width, height = (np.ceil((every.max(0) - low) * scale) + 2).astype(int)
    of = lambda k: np.any([inside(r, low - 1 / scale, height, width) for r in rings[k]] or [np.zeros((height, width), bool)], axis=0)
    m, n = of("p") & ~of("p_holes"), of("q") & ~of("q_holes")
    return (m & n).sum() / (m | n).sum() if (m | n).any() else np.nan


def test_overlaps_of_many_rows_at_once(monkeypatch):
    r = np.random.default_rng(1)
    ring = lambda: [{"x": float(x), "y": float(y)} for x, y in np.round(r.normal(0, 4, (r.integers(1, 9), 2)), r.integers(0, 3))]
    rows = [{k: [ring() for _ in range(r.integers(0, most))] for k, most in (("p", 3), ("p_holes", 2), ("q", 3), ("q_holes", 2))} for _ in range(150)]
    kind = pa.list_(pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())])))
    batch = pa.RecordBatch.from_pylist(rows, pa.schema([(k, kind) for k in ("p", "p_holes", "q", "q_holes")]))
    want = [plain_overlap(row) for row in rows]
    for points in (1 << 20, 700):
        monkeypatch.setattr(shapes, "POINTS", points)
        np.testing.assert_array_equal(shapes.overlaps(batch, 2, 4_000_000), want)


@pytest.mark.parametrize(("h", "w"), [(70, 41), (37, 90)])
def test_anchor_by_strips(spark, monkeypatch, h, w):
    r = np.random.default_rng(h)
    a = r.normal(0, 1, (2, h + 9, w + 9))
    both = [(p, v[4 : 4 + h, 4 : 4 + w], v[4 + dy : 4 + dy + h, 4 + dx : 4 + dx + w] + r.normal(0, 0.1, (h, w))) for p, v, dy, dx in ((0, a[0], 3, -2), (7, a[1], -4, 5))]
    rows = [(p, x, y, float(v[y, x])) for p, *vs in both for v in vs[:1] for y in range(h) for x in range(w)], [(p, x, y, float(v[y, x])) for p, *vs in both for v in vs[1:] for y in range(h) for x in range(w)]
    ref, mov = (planes.packed(spark.createDataFrame(k, "plane long, x long, y long, v double"), h, w, 16, kind="<f8") for k in rows)
    monkeypatch.setattr(registration, "STRIP", 300)
    monkeypatch.setattr(tile_registration, "MOST_WHOLE", 10)
    monkeypatch.setattr(registration, "residual", None)  # no task has a whole plane
    got = {r["plane"]: (r["dx"], r["dy"], r["tre"], r["error"]) for r in tile_registration.coarse_anchor(ref, mov, 1000).collect()}
    for p, one, two in both:
        assert got[p] == pytest.approx(tile_registration.residual(one, two))
