"""Shapes, registration and merged tables against plain versions."""

import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from celldex.functions import scalars
from celldex.operators import matching, measure, merge, pairing, registration, seg_quality, shapes
from celldex.streaming.groups import complete_groups, conserved, counted, stream_sized_groups


def test_outline_of_shapes():
    square = shapes.outline(np.ones((3, 3), bool))
    assert len(square) == 13 and (square[0] == square[-1]).all()
    x, y = square[:-1].T
    assert abs(np.sum(x * np.roll(y, -1) - np.roll(x, -1) * y)) / 2 == 8.5 and set(map(tuple, square)) >= {(-0.5, 0.0), (1.0, 2.5)}
    ring = np.ones((5, 5), bool)
    ring[2, 2] = False
    assert len(shapes.outline(ring)) == 21  # the outer one, not the hole's
    apart = np.eye(2, dtype=bool)
    assert len(shapes.outline(apart)) == 5  # corners don't join


def test_simplified():
    line = np.array([(0, 0), (1, 0.1), (2, 0), (2, 2), (0, 0)], float)
    assert shapes.simplified(line, 0.5).tolist() == [[0, 0], [2, 0], [2, 2], [0, 0]]
    assert len(shapes.simplified(line, 0.01)) == 5


def test_contours(spark):
    px = [(1, x, y) for x in range(10, 16) for y in range(20, 24)] + [(2, 0, 0), (0, 5, 5), (None, 6, 6)]
    got = {r["label"]: [(p["x"], p["y"]) for p in r["ring"]] for r in shapes.contours(spark.createDataFrame([*px, px[0]], "label long, x long, y long"), tolerance=0.3).collect()}
    assert got[1][0] == got[1][-1] and min(x for x, _ in got[1]) == 10.0 and max(x for x, _ in got[1]) == 16.0 and max(y for _, y in got[1]) == 24.0
    assert set(got) == {1, 2} and shapes.contours(spark.createDataFrame(px, "label long, x long, y long")).where("label = 2").isEmpty()


def test_pair_overlap(spark):
    def square(x, y, n):
        return [{"x": float(x + dx), "y": float(y + dy)} for dx, dy in ((0, 0), (n, 0), (n, n), (0, n))]

    rows = [(1, False, square(0, 0, 10)), (2, False, square(5, 0, 10)), (3, False, square(0, 0, 10)), (3, True, square(2, 2, 6)), (4, False, square(0, 0, 9000)), (5, False, [{"x": math.nan, "y": 0.0}] * 3)]
    rings = spark.createDataFrame(rows, "feature long, hole boolean, ring array<struct<x: double, y: double>>")
    pairs = spark.createDataFrame([(1, 1), (1, 2), (1, 3), (1, 4), (1, 5), (1, 6)], "a long, b long")
    got = {r["b"]: r["iou"] for r in shapes.pair_overlap(pairs, rings, rings).collect()}
    assert got[1] == 1.0 and got[2] == pytest.approx(1 / 3, abs=0.03) and got[3] == pytest.approx(0.64, abs=0.06) and got[4] is got[5] is got[6] is None


def test_collection_is_one_document(spark, tmp_path):
    cells = spark.createDataFrame([(i, float(i), 1.0) for i in range(20)] + [(99, float("nan"), 1.0)], "label long, cx double, cy double")
    rings = cells.where("label = 3").select("label", F.array(F.struct(F.lit(0.0).alias("x"), F.lit(1.0).alias("y"))).alias("ring"))
    shapes.write_collection(shapes.feature_text(cells, rings, "label", "cx", "cy", F.struct(F.lit("cell").alias("objectType"))), str(tmp_path / "out"), "label")
    parts = sorted(p for p in (tmp_path / "out").rglob("part-*.txt"))
    doc = json.loads("".join(p.read_text() for p in parts))
    assert [f["id"] for f in doc["features"]] == [str(i) for i in range(20)]
    assert doc["features"][3]["geometry"] == {"type": "Polygon", "coordinates": [[[0.0, 1.0]]]} and doc["features"][4]["geometry"]["type"] == "Point"


def test_residual_finds_shifts():
    r = np.random.default_rng(0)
    y, x = np.mgrid[:64, :64]
    spots = r.uniform(8, 56, (25, 2))
    plane = lambda dx, dy: sum(np.exp(-((x - a - dx) ** 2 + (y - b - dy) ** 2) / 4) for a, b in spots)
    for dx, dy in ((0, 0), (2, -1), (1.5, 0.4)):
        got = registration.residual(plane(0, 0), plane(dx, dy))
        assert got[0] == pytest.approx(-dx, abs=0.15) and got[1] == pytest.approx(-dy, abs=0.15) and got[2] == pytest.approx(math.hypot(*got[:2])) and got[3] < 0.5
    assert registration.residual(plane(0, 0), r.normal(size=(64, 64)))[3] > 0.8
    assert math.isnan(registration.residual(plane(0, 0), np.zeros((64, 64)))[3]) and math.isnan(registration.residual(np.zeros((0, 0)), np.zeros((0, 0)))[3])


@pytest.mark.parametrize("model", ["euclidean", "similarity", "affine"])
def test_transform_leaves_outliers(model):
    r = np.random.default_rng(1)
    m = np.eye(3)
    a = 0.3
    m[:2, :2] = np.array([[np.cos(a), -np.sin(a)], [np.sin(a), np.cos(a)]]) * (1.2 if model != "euclidean" else 1) + (np.array([[0, 0.2], [0, 0]]) if model == "affine" else 0)
    m[:2, 2] = 5, -7
    src = r.uniform(0, 100, (60, 2))
    dst = registration.moved(m, src)
    dst[:20] += r.uniform(30, 60, (20, 2))
    got, away, n = registration.transform(src, dst, model)
    assert np.allclose(got, m, atol=1e-6) and away < 1e-6 and n == 40
    with pytest.raises(ValueError, match="unknown model"):
        registration.transform(src, dst, "x")


def test_mesh_is_constant_beyond_its_nodes():
    mesh = registration.Mesh([0, 10, 30], [0, 20], np.arange(12).reshape(2, 3, 2))
    at = mesh(np.array([(-5.0, -5), (0, 0), (5, 0), (30, 20), (99, 99), (20, 10)]))
    assert at.tolist() == [[0, 1], [0, 1], [1, 2], [10, 11], [10, 11], [6, 7]]
    m = np.array([[1.0, 0, 3], [0, 1, -2], [0, 0, 1]])
    v = registration.source(m, mesh, np.array([(15.0, 10.0)]), rounds=40)
    assert np.allclose(registration.moved(m, v) + mesh(registration.moved(m, v)), [(15, 10)], atol=1e-3)
    assert registration.source_window(m, None, 0, 0, 10, 10, 2, (100, 100)) == (0, 0, 9, 14)


def test_otsu_fraction():
    assert registration.otsu_fraction(np.array([50, 40, 0, 0, 0, 0, 10])) == pytest.approx(0.1)
    assert registration.otsu_fraction(np.full(50, 3)) == 0 and registration.otsu_fraction(np.array([9, 0, 0])) == 0


def test_matched_masks(spark):
    r = random.Random(4)
    px = [(g, r.randrange(0, 7), r.randrange(0, 6), r.random() < 0.8) for g in (1, 2) for _ in range(150)]
    got = {(x["slide"], x["cell"], x["nucleus"], x["label"]) for x in matching.matched_masks(spark.createDataFrame(px, "slide long, cell long, nucleus long, interior boolean"), "slide").collect()}
    want = set()
    for g in (1, 2):
        taken, k = set(), 0
        for c in range(1, 7):
            best, pick = 1.0, None
            for n in range(1, 6):
                size = sum(p[0] == g and p[2] == n for p in px)
                inside = sum(p == (g, c, n, True) for p in px)
                if n not in taken and inside and (size - inside) / size < best:
                    best, pick = (size - inside) / size, n
            if pick:
                k += 1
                taken.add(pick)
                want.add((g, c, pick, k))
    assert got == want


def test_resolve_join(spark):
    flow = spark.createDataFrame([(1, 10.25, 20.25), (2, 500.0, 500.0)], "id long, x double, y double")
    cells = spark.createDataFrame([(7, 20.0, 40.0), (8, 0.0, 0.0)], "id long, x double, y double")
    got = pairing.resolve_join(flow, cells, 0.5, 3.0, 0.5).collect()
    assert sorted((r["b"], r["a"], r["method"], r["matched"], r["cells"], r["match_fraction"]) for r in got) == [(7, 1, "centroid", 1, 2, 0.5), (8, None, "centroid", 1, 2, 0.5)]
    exact = cells.where("id = 7").withColumn("x", F.lit(20.5)).withColumn("y", F.lit(40.5))  # corners on both sides: no half pixel between them
    assert pairing.by_centroid(flow, exact, 0.5, 0.01).select("d2").head()[0] == 0.0
    with pytest.raises(Exception, match="1 of 2 cells"):
        pairing.resolve_join(flow, cells, 0.5, 3.0, 0.9).collect()
    with pytest.raises(Exception, match="1 of 3 cells"):  # two rows of one label are one match
        pairing.resolve_join(flow.withColumn("label", F.lit(8)), cells.union(cells.limit(1).selectExpr("9L", "0D", "0D")), 0.5, 3.0, 0.9).collect()
    last = pairing.resolve_join(flow.withColumn("label", F.lit(8)), cells, 0.5, 3.0, 0.5).where("a is not null").collect()
    assert [(r["a"], r["b"], r["method"]) for r in last] == [(2, 8, "label")]
    with pytest.raises(ValueError, match="no label"):
        pairing.resolve_join(flow.select("id"), cells, 0.5, 3.0, 0.5)


def test_pair_inputs():
    assert pairing.pair_inputs(["/a/P1.zarr", "/a/P2.zarr"], ["x/P2_cells.csv", "x/P1_cells.csv"]) == [("/a/P2.zarr", "x/P2_cells.csv"), ("/a/P1.zarr", "x/P1_cells.csv")]
    assert pairing.pair_inputs(["b.zarr", "a.zarr"], ["y.csv", "x.csv"]) == [("a.zarr", "x.csv"), ("b.zarr", "y.csv")]
    with pytest.raises(ValueError, match="2 stores and 1 tables"):
        pairing.pair_inputs(["b.zarr", "a.zarr"], ["y.csv"])


def test_failing_joins(spark):
    left, right = spark.createDataFrame([(1,), (2,)], "k long"), spark.createDataFrame([(5, 1, "x")], "k long, at long, v string")
    with pytest.raises(ValueError, match="no row has a partner"):
        merge.attach_all_or_fail(left, right, "k", "at")
    with pytest.raises(Exception, match="several reports"):
        pairing.with_report(spark.createDataFrame([("/a/x",)], "url string"), spark.createDataFrame([("/b/x",), ("/c/x",)], "url string"), "url").collect()
    with pytest.raises(ValueError, match="unknown method"):
        matching.match_cells(left, right, 1.0, "x")


def test_quantify_without_labels(spark):
    empty = measure.quantify(spark.createDataFrame([(None, True, 1.0)], "label long, in_nucleus boolean, value double"), "CD3", expanded=True)
    assert empty.count() == 0 and len(empty.columns) == 11 and empty.columns[1] == "CD3"


def test_errors_of_scalars(spark):
    one = spark.createDataFrame([("x",)], "v string")
    for bad in (scalars.is_reference(F.col("v")), scalars.pixel_size(F.col("v"), F.lit(1.0)), scalars.pixel_size(F.lit("auto"), F.lit(None).cast("double"))):
        with pytest.raises(Exception, match="is_reference|no pixel size"):
            one.select(bad.alias("b")).collect()
    assert scalars.markers_of(" dapi , ") == ["DAPI"]
    with pytest.raises(ValueError, match="no nuclear"):
        scalars.markers_of(" ,")
    got = one.select(scalars.shown_bytes(F.lit(float("inf"))).alias("a"), scalars.shown_pixels(F.lit(float("nan"))).alias("b"), scalars.shown_pixels(F.lit(1.005)).alias("c"), scalars.parse_bytes(F.lit("12 XB")).alias("d"), scalars.parse_duration(F.lit("7")).alias("e"), scalars.stem(F.lit("/a/b.ome.tif")).alias("f")).head()
    assert (got["a"], got["b"], got["d"], got["e"], got["f"]) == ("n/a", "n/a", None, 7.0, "b") and got["c"].endswith(" px")


def test_moments_merge():
    r = np.random.default_rng(0)
    x = r.normal(1e6, 1, (50, 3))
    got = seg_quality.Moments.of(x[:1]) + seg_quality.Moments.of(x[1:20]) + seg_quality.Moments.of(x[20:])
    assert got.n == 50 and got.mean == pytest.approx(x.mean(0)) and got.spread == pytest.approx(np.cov(x.T) * 49, abs=1e-3)
    values = np.linalg.eigvalsh(np.cov(x.T))
    assert got.first_share() == pytest.approx(values[-1] / values.sum(), abs=1e-6)


def plain_uniformity(raw, z, cluster):
    cvs, firsts = [], []
    for c in np.unique(cluster):
        m, n = raw[cluster == c], (cluster == c).sum()
        v = [0.0 if m[:, i].min() == m[:, i].max() else m[:, i].std() / m[:, i].mean() for i in range(m.shape[1])]
        e = np.linalg.eigvalsh(np.cov(z[cluster == c].T)) if n > 1 else [1.0]
        cvs.append(np.mean(v) * n)
        firsts.append((e[-1] / sum(e)) * n)
    away = np.sqrt(((z[:, None] - z[None]) ** 2).sum(2))
    s = []
    for i, c in enumerate(cluster):
        mine = (cluster == c) & (np.arange(len(z)) != i)
        if len(np.unique(cluster)) == 1:
            s.append(1.0)
        elif not mine.any():
            s.append(0.0)
        else:
            a, b = away[i, mine].mean(), min(away[i, cluster == o].mean() for o in np.unique(cluster) if o != c)
            s.append((b - a) / max(a, b))
    return sum(cvs) / len(z), sum(firsts) / len(z), np.mean(s)


def test_uniformity(spark):
    r = np.random.default_rng(1)
    raw = np.concatenate([r.normal((50, 20), 1, (40, 2)), r.normal((100, 40), 1, (41, 2)), [[300.0, 7.0]]])
    z = (raw - raw.mean(0)) / raw.std(0)
    rows = [(i, *map(float, a), *map(float, b), 0, *[i % k for k in range(2, 10)], min(i // 40, 2)) for i, (a, b) in enumerate(zip(raw, z, strict=True))]
    cells = spark.createDataFrame(rows, "label long, a double, b double, a_z double, b_z double, " + ", ".join(f"k{k} int" for k in range(1, 11))).repartition(5)
    got = {r["k"]: (r["cv"], r["fraction"], r["silhouette"]) for r in seg_quality.uniformity(cells, ["a", "b"]).collect()}
    for k in range(1, 11):
        assert got[k] == pytest.approx(plain_uniformity(raw, z, np.array([row[4 + k] for row in rows])), abs=1e-9)
    found = seg_quality.kmeans(cells.select("label", "a_z", "b_z"), ["a_z", "b_z"]).collect()
    assert {r["k1"] for r in found} == {0} and all(len({r[f"k{k}"] for r in found}) <= k for k in range(2, 11))


def test_evaluation(spark):
    r = np.random.default_rng(5)
    y, x = np.indices((24, 30))
    cell, nucleus = np.where((y % 8 < 7) & (x % 10 < 9), y // 8 * 3 + x // 10 + 1, 0), np.where((abs(y % 8 - 3) < 2) & (abs(x % 10 - 4) < 3) & (x < 20), y // 8 * 3 + x // 10 + 1, 0)
    edge = np.pad(cell, 1, mode="edge")
    inner = np.all([edge[1 + dy : 25 + dy, 1 + dx : 31 + dx] == cell for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0))], axis=0)
    a, b = r.gamma(2, 3, cell.shape), r.gamma(3, 2, cell.shape)
    fg = a > 3
    rows = [(int(u), int(v), int(cell[v, u]), int(nucleus[v, u]), bool(inner[v, u]), bool(fg[v, u]), float(a[v, u]), float(b[v, u])) for v in range(24) for u in range(30)]
    px = spark.createDataFrame(rows, "x long, y long, cell long, nucleus long, interior boolean, foreground boolean, a double, b double").repartition(3)
    by = lambda cells: cells.select("*", F.lit(0).alias("k1"), *[(F.col("label") % k).cast("int").alias(f"k{k}") for k in range(2, 11)])
    got = seg_quality.evaluation(px, ["a", "b"], 0.25, by).head().asDict()
    assert list(got) == seg_quality.MEASURES

    kept = sorted(set(cell[(nucleus > 0) & (cell == nucleus) & inner]))  # each cell has its own nucleus, in columns 0 and 1
    number = {c: i + 1 for i, c in enumerate(kept)}
    matched = np.vectorize(lambda c: number.get(c, 0))(cell)
    inside = np.where((nucleus == cell) & inner & (nucleus > 0), matched, 0)
    on, raw, z = matched > 0, np.stack((a, b), -1), np.stack([(c - c.mean(0)) / c.std(0) for c in (a, b)], -1)
    assert got["cells_per_100um2"] == pytest.approx(len(kept) / (24 * 30 * 0.25) * 100)
    assert (got["foreground_fraction"], got["background_left"], got["mask_fraction"]) == pytest.approx(((fg & on).sum() / fg.sum(), 1 - (~fg & on).sum() / (~fg).sum(), (fg & on).sum() / on.sum()))
    sizes = np.bincount(matched.ravel())[1:]
    assert got["size_evenness"] == (pytest.approx(1 / (np.log(sizes.std()) + 1)) if sizes.std() else None)
    m = len(kept) + 1
    assert got["matched_fraction"] == pytest.approx(m / (10 + 7 - m))
    rest = fg & ~on
    assert got["foreground_evenness"] == pytest.approx(1 / (np.mean([c[rest].std() / c.mean() for c in (a, b)]) + 1))
    e = np.linalg.eigvalsh(np.cov(z[rest].T))
    assert got["foreground_first_share"] == pytest.approx(e[-1] / e.sum())
    for name, mask in (("nucleus", inside), ("outside", matched - inside)):
        labels = [c for c in np.unique(mask) if c]
        f, g = (np.array([v[mask == c].mean(0) for c in labels]) for v in (raw, z))
        each = np.array([plain_uniformity(f, g, np.zeros(len(labels)) if k == 1 else np.array(labels) % k) for k in range(1, 11)])
        want = 1 / (each[:, 0].mean() + 1), each[:, 1].mean(), each[:, 2].mean()
        assert (got[f"{name}_evenness"], got[f"{name}_first_share"], got[f"{name}_silhouette"]) == pytest.approx(want)


def test_stream_sized_groups(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for i, rows in enumerate(([(1, "a"), (2, "x")], [(1, "b"), (1, "c")], [(2, "y"), (3, "z")])):
        spark.createDataFrame(rows, "k long, item string").coalesce(1).write.mode("append").parquet(str(source / f"f{i}"))
    stream = spark.readStream.schema("k long, item string").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(source))
    q = stream_sized_groups(stream, "k", "item", 2).writeStream.format("memory").queryName("sized").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["k"]: r["items"] for r in spark.table("sized").collect()}
    assert set(got) == {1, 2} and all(len(v.split(",")) == 2 for v in got.values())


def test_groups_that_must_be_complete(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k long, item string")
    with pytest.raises(ValueError, match=r"2 \(1 of 2\)"):
        complete_groups(rows, "k", "item", 2)
    assert [r["items"] for r in complete_groups(rows.where("k = 1"), "k", "item", 2).collect()] == ["a,b"]


def test_rows_are_conserved(spark):
    rows, seen = counted(spark.range(10), "passing")
    assert rows.where("id > 3").count() == 6
    conserved(seen, 10)
    with pytest.raises(ValueError, match="10 rows passed, 11"):
        conserved(seen, 11)


def test_mask_features_are_from_pixel_centres(spark):
    px = spark.createDataFrame([(1, x, y) for x in range(4) for y in range(4)], "label long, x long, y long")
    ring = json.loads(shapes.mask_features(px, 0.3).head()["feature"])["geometry"]["coordinates"][0]
    assert min(x for x, _ in ring) == -0.5 and max(y for _, y in ring) == 3.5 and ring[0] == ring[-1]


def test_quantiles_are_exact_whatever_the_group(spark):
    r = np.random.default_rng(3)
    groups = {"hot": r.normal(size=5000).round(2), "one": np.array([7.0]), "same": np.full(9, 3.0), "far": np.array([-1e300, 0.0, 1e300, 5.0])}
    rows = [(k, float(v)) for k, values in groups.items() for v in values] + [("hot", None), ("hot", float("nan")), ("none", None), (None, 1.0), (None, 2.0)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(5)
    shares = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.998, "e": 1.0}
    got = {x["g"]: x for x in measure.quantiles(df, "g", "v", shares).collect()}
    for k, values in groups.items():
        assert [got[k][s] for s in shares] == pytest.approx(np.percentile(values, [100 * q for q in shares.values()]), rel=1e-9)
    assert got[None]["c"] == 1.5 and got["none"]["c"] is None
    near = {x["g"]: x["p90"] for x in measure.nearest_rank(df, "g", "v", 90).collect()}
    assert near["hot"] == np.sort(groups["hot"])[4499] and near["one"] == 7.0 and "none" not in near
