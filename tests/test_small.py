"""Small operators put together: exports, entries, fields, tables of markers, ranks with far values."""

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from celldex.functions import scalars
from celldex.operators import export, geometry, matching, measure, merge, raster, registration


def test_slide_is_written_as_one_collection(spark, tmp_path):
    cells = spark.createDataFrame([(1, 2.0, 2.0, 16.0, 0.5, float("nan")), (2, 9.0, 9.0, 1.0, None, 3.0), (3, None, 1.0, 1.0, 1.0, 1.0)], "label long, x double, y double, area double, solidity double, CD3 double")
    px = spark.createDataFrame([(1, x, y) for x in range(5) for y in range(5)], "label long, x long, y long")
    export.write_slide(cells, px, str(tmp_path / "out"), "label", "x", "y", ["CD3"], 0.5, ["area", "solidity"])
    doc = json.loads("".join(p.read_text() for p in sorted((tmp_path / "out").rglob("part-*.txt"))))
    assert [f["geometry"]["type"] for f in doc["features"]] == ["Polygon", "Point"]
    said = [{m["name"]: m["value"] for m in f["properties"]["measurements"]} for f in doc["features"]]
    assert said[0] == {"label": 1.0, "Centroid X µm": 1.25, "Centroid Y µm": 1.25, "Area µm²": 4.0, "Solidity": 0.5}
    assert said[1] == {"label": 2.0, "Centroid X µm": 4.75, "Centroid Y µm": 4.75, "CD3": 3.0, "Area µm²": 0.25}


def plain_perimeter(mask):
    m = np.pad(mask, 2).astype(int)
    inner = m.copy()
    for dy, dx in ((0, 1), (1, 0), (0, -1), (-1, 0)):
        inner &= np.roll(m, (dy, dx), (0, 1))
    border = m - inner
    code = border.copy()
    for dy in (-1, 0, 1):
        for dx in (-1, 0, 1):
            if dy or dx:
                code = code + (10 if dy and dx else 2) * np.roll(border, (dy, dx), (0, 1))
    weight = np.zeros(50)
    weight[[5, 7, 15, 17, 25, 27]], weight[[21, 33]], weight[[13, 23]] = 1, 2**0.5, (1 + 2**0.5) / 2
    return weight[code[border == 1]].sum()


def test_perimeters_boundaries_and_described(spark):
    r = np.random.default_rng(3)
    masks = {1: np.ones((4, 6), bool), 2: r.random((12, 12)) < 0.7, 3: np.ones((1, 1), bool), 4: np.eye(5, dtype=bool)}
    rows = [(k, int(x), int(y)) for k, m in masks.items() for y, x in zip(*np.nonzero(m), strict=True)] + [(1, 0, 0), (None, 3, 3)]
    df = spark.createDataFrame(rows, "label long, x long, y long")
    got = {x["label"]: x["perimeter"] for x in geometry.perimeter(df).collect()}
    assert got == pytest.approx({k: plain_perimeter(m) for k, m in masks.items()}) and got[3] == 0.0
    square = spark.createDataFrame([(1, x, y) for x in range(3) for y in range(3)], "label long, x long, y long")
    assert geometry.boundary(square).count() == 8 and geometry.boundary(square, 3, 3).count() == 0 and geometry.boundary(square, 4, 4).count() == 5
    all_ = {x["label"]: x for x in geometry.described(df).collect()}
    assert all_[4]["convex_area"] == 5 and all_[1]["solidity"] == 1.0 and all_[3]["area"] == 1


def test_greedy_rounds_are_one_pass(spark):
    r = np.random.default_rng(9)
    rows = [(g, int(c), int(n), float(o)) for g in (1, 2) for c in range(1, 41) for n, o in zip(r.choice(30, 4, replace=False), r.integers(0, 4, 4) / 4, strict=True)]
    rows += [(3, c, n, 0.0) for c in range(1, 16) for n in (c, c + 1)]  # a chain
    got = {tuple(x) for x in matching.greedy_pairs(spark.createDataFrame(rows, "g int, cell int, nucleus int, out double").repartition(6), "g").collect()}
    want = set()
    for g in (1, 2, 3):
        taken = set()
        for c in sorted({x[1] for x in rows if x[0] == g}):
            free = sorted((o, n) for h, d, n, o in rows if (h, d) == (g, c) and n not in taken)
            if free:
                taken.add(free[0][1])
                want.add((g, c, free[0][1]))
    assert got == want
    numbers = matching.numbered(spark.createDataFrame(rows, "g int, cell int, nucleus int, out double").repartition(6), "g", ["cell", "nucleus"], "at").collect()
    for g in (1, 2, 3):
        mine = sorted((x["cell"], x["nucleus"], x["at"]) for x in numbers if x["g"] == g)
        assert [m[2] for m in mine] == list(range(1, len(mine) + 1))


@pytest.mark.parametrize("far", [1e300, float("inf"), -1e300, 1e-300])
def test_ranks_with_a_far_value(spark, far):
    r = np.random.default_rng(1)
    values = {0: [far, *r.normal(0, 1, 3000)], 1: [0.0, -0.0, far, 5.0], 2: [far], 3: list(r.integers(-9, 9, 500).astype(float)), 4: [float("nan")]}
    rows = [(g, float(v)) for g, vs in values.items() for v in vs] + [(5, None)]
    df = spark.createDataFrame(rows, "g int, v double").repartition(5)
    got = {x["g"]: x for x in measure.at_ranks(df, "g", "v", {"low": F.lit(0), "mid": F.floor(F.col("n") / 2), "top": F.col("n") - 1}).collect()}
    for g, vs in values.items():
        real = sorted(v for v in vs if v == v)
        want = (len(real), *((real[0], real[len(real) // 2], real[-1]) if real else (None, None, None)))
        assert (got[g]["n"], got[g]["low"], got[g]["mid"], got[g]["top"]) == want
    assert got[5]["n"] == 0
    q = {x["g"]: x["p"] for x in measure.quantiles(df.where("g in (0, 3)"), "g", "v", {"p": 0.9}).collect()}
    assert q == pytest.approx({g: np.quantile(values[g], 0.9) for g in (0, 3)})


def test_marker_tables(spark, tmp_path):
    base = spark.createDataFrame([(1, 0.5, 1.0), (2, 0.7, 2.0)], "label long, area double, CD3 double")
    for name, head, rows in (("a_quant", "label,CD3,area", "1,5,9\n2,6,9"), ("b_quant", "label,CD3,CD8", "1,7,8"), ("other", "label,X", "1,1")):
        (tmp_path / f"{name}.csv").write_text(f"{head}\n{rows}\n")
    tables = merge.marker_tables(spark, folder=str(tmp_path))
    assert [t.rpartition("/")[2] for t, _ in tables] == ["a_quant.csv", "b_quant.csv"]
    got = merge.merged_markers(base, tables, protected=("area",)).select("label", "area", "CD3", "CD8").orderBy("label").collect()
    assert [tuple(x) for x in got] == [(1, 0.5, 7.0, 8.0), (2, 0.7, None, None)]
    one = merge.merged_markers(base, merge.marker_tables(spark, [str(tmp_path / "a_quant.csv")]), protected=("area",))
    assert {(x["label"], x["CD3"]) for x in one.collect()} == {(1, 5.0), (2, 6.0)}
    with pytest.raises(ValueError, match="no tables"):
        merge.marker_tables(spark, [])


def test_entries_margins_and_fields(spark):
    slides = spark.createDataFrame([("r", True), ("b", False), ("a", False)], "slide string, is_reference boolean")
    assert registration.moving_entry(slides).head()["slide"] == "a" and registration.moving_entry(slides, "b").head()["slide"] == "b" and registration.moving_entry(slides, "zz").head()["slide"] == "a"
    with pytest.raises(ValueError, match="no moving"):
        registration.moving_entry(slides.where("is_reference"))
    assert registration.mesh_margin(None) == 4 and registration.mesh_margin(registration.Mesh([0.0, 1], [0.0, 1], np.full((2, 2, 2), -2.3))) == 7
    assert raster.fields_for_profiles(100, 90, 50, 50) == (2, 2)
    with pytest.raises(ValueError, match="45 or less"):
        raster.fields_for_profiles(100, 90, 100, 100)
    assert raster.correctable(["DAPI", "dapi_2", "CD3"], ["DAPI"]) == ["CD3"] and raster.correctable(["DAPI"], ["DAPI"], False) == ["DAPI"]


def test_documents_and_colours(spark):
    rows = spark.createDataFrame([('{"a":null,"b":[null,1,{"c":null}]}',), ("x",), (None,)], "t string")
    got = [x["c"] for x in rows.select(scalars.clean_document(F.col("t")).alias("c")).collect()]
    assert got == ['{"a": NaN, "b": [NaN, 1, {"c": NaN}]}', None, None]
    names = spark.createDataFrame([("cd4", 0), ("CD45", 1), ("CD1", 0)], "n string, i int")
    assert [tuple(x["c"]) for x in names.select(scalars.marker_color(F.col("n"), F.col("i")).alias("c")).collect()][:2] == [(0, 255, 255), (0, 255, 0)]


def test_sheets_of_many_files_and_writers(spark, tmp_path):
    from celldex.sources import sheets

    for name, text in (("s1_plan.csv", "ix,iy\n0,0\n\n 1 ,0\n"), ("s2_plan.csv", "ix,iy\n5,6\n")):
        (tmp_path / name).write_text(text)
    got = sheets.tagged_sheets(spark, str(tmp_path / "*_plan.csv"), "_plan.csv").collect()
    assert sorted((r["source"], r["row"], r["ix"], r["iy"]) for r in got) == [("s1", 1, "0", "0"), ("s1", 2, "1", "0"), ("s2", 1, "5", "6")]
    docs = tmp_path / "docs"
    docs.mkdir()
    for name, text in (("a.json", '{"moving":"m1","v":1}'), ("b.json", '{"moving":"m1","v":2}'), ("c.json", '{"v":3}'), ("d.json", "{broken")):
        (docs / name).write_text(text)
    assert {r["key"]: json.loads(r["text"])["v"] for r in sheets.keyed_documents(spark, str(docs), "moving").collect()} == {"m1": 2, "c": 3}
    assert {r["name"] for r in sheets.texts(spark, str(docs)).collect()} == {"a.json", "b.json", "c.json", "d.json"}
    log = spark.createDataFrame([("p", "s", "b", 2), ("p", "s", "a", 1)], "process string, sample_id string, filename string, bytes long")
    sheets.write_size_log(log.repartition(2), str(tmp_path / "log"))
    assert next((tmp_path / "log").glob("part-*.csv")).read_text().split() == ["process,sample_id,filename,bytes", "p,s,a,1", "p,s,b,2"]
    sheets.write_summary(log.agg(F.sum("bytes").alias("bytes"), F.lit(None).cast("string").alias("note")), str(tmp_path / "sum"))
    assert json.loads(next((tmp_path / "sum").glob("part-*.json")).read_text()) == {"bytes": 3, "note": None}
    with pytest.raises(ValueError, match="one row"):
        sheets.write_summary(log, str(tmp_path / "no"))
