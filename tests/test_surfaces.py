"""Release of groups of a stream, table functions, and the tile reader."""

import numpy as np
import pytest

from celldex.functions.tables import lateral
from celldex.operators import planes
from celldex.sources.tiles import TileSource, read_planes
from celldex.streaming.release import keep_state_on_disk, released


def run(spark, tmp_path, batches, must=False):
    """Each batch a file, one a trigger; rows are (key, item, minute)."""
    keep_state_on_disk(spark)
    source = tmp_path / "in"
    source.mkdir()
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "key string, item string, m int").selectExpr("key", "item", "timestamp_seconds(1000000 + m * 60) as at").coalesce(1).write.parquet(str(source / f"b{i:02d}"))
    manifest = spark.createDataFrame([("a", 3), ("b", 2), ("c", 5), ("z", 1), ("w", 2)], "key string, expected int")
    stream = spark.readStream.schema("key string, item string, at timestamp").option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(str(source))
    name = f"released_{tmp_path.name.replace('-', '_')}"
    q = released(stream, manifest, "10 minutes", must).writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / "cp")).outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination(180)
    if q.exception():
        raise q.exception()
    return sorted((r["key"], r["status"], ",".join(r["items"])) for r in spark.table(name).collect()), q.lastProgress["stateOperators"][0]["numRowsTotal"]


def test_groups_leave_when_complete_and_state_expires(spark, tmp_path):
    batches = [
        [("a", "1", 0), ("a", "2", 1), ("b", "x", 1)],
        [("a", "3", 2), ("c", "p", 3), ("q", "?", 3)],
        [("a", "4", 4), ("b", "y", 5), ("b", "w", 6)],
        [("z", "1", 60)],
        [("z", "2", 61)],
        [("w", "1", 200)],
        [("w", "2", 201)],
        [("z", "3", 202)],  # its mark has gone
    ]
    got, state = run(spark, tmp_path, batches)
    assert got == [("a", "complete", "1,2,3"), ("a", "late", "4"), ("b", "complete", "x,y"), ("b", "late", "w"), ("c", "incomplete", "p"), ("q", "incomplete", "?"), ("w", "complete", "1,2"), ("z", "complete", "1"), ("z", "complete", "3"), ("z", "late", "2")]
    assert state <= 4  # marks and timers of the last two keys are left


def test_groups_that_must_be_complete_fail(spark, tmp_path):
    with pytest.raises(Exception, match="group c is incomplete: 1 of 5"):
        run(spark, tmp_path, [[("c", "p", 0)], [("z", "1", 60)], [("z", "1", 200)]], must=True)


def test_table_functions(spark):
    slides = spark.createDataFrame([(1, 600, 300), (2, 256, 257)], "id int, width long, height long")
    tiles = lateral(slides, "tile_grid(s.width, s.height, 256, 16)").collect()
    assert len(tiles) == 3 * 2 + 1 * 2
    assert {(t["ix"], t["iy"], t["x0"], t["y0"], t["x1"], t["y1"]) for t in tiles if t["id"] == 2} == {(0, 0, 0, 0, 256, 257), (0, 1, 0, 240, 256, 257)}
    parts = lateral(slides, "fov_split(s.width, 7)", "s.id, t.*").where("id = 1").orderBy("i").collect()
    assert [p["size"] for p in parts] == [86] * 5 + [85] * 2 and [p["start"] for p in parts][-1] == 515
    fields = lateral(slides, "fov_grid(s.height, s.width, 2, 3)").where("id = 1").orderBy("index").collect()
    assert [(f["y0"], f["x0"], f["h"], f["w"]) for f in fields] == [(y, x, 150, 200) for y in (0, 150) for x in (0, 200, 400)]
    levels = lateral(slides, "pyramid_levels(s.height, s.width, 64, 10)").where("id = 1").orderBy("level").collect()
    assert [(x["h"], x["w"]) for x in levels] == [(300, 600), (150, 300), (75, 150)]
    assert lateral(slides.selectExpr("id", "cast(null as long) as width", "height"), "tile_grid(s.width, s.height, 256, 16)").count() == 0


def test_tile_source(spark, tmp_path):
    r = np.random.default_rng(1)
    a, b = r.integers(0, 60_000, (2, 70, 90)).astype("<u2"), r.integers(0, 60_000, (2, 70, 90)).astype("<u2")
    np.save(tmp_path / "p0.npy", a)
    np.save(tmp_path / "p1.npy", b)
    got = read_planes(spark, str(tmp_path), 32)
    assert (got.depth, got.height, got.width, got.kind) == (2, 70, 90, "<u2") and got.tiles.rdd.getNumPartitions() == 6
    for plane, want in enumerate((a, b)):
        rows = {(x["ty"], x["tx"]): got.array(x["ty"], x["tx"], x["body"]) for x in got.tiles.where(f"plane = {plane}").collect()}
        assert len(rows) == 9 and all((v == want[:, ty * 32 : ty * 32 + 32, tx * 32 : tx * 32 + 32]).all() for (ty, tx), v in rows.items())
    spark.dataSource.register(TileSource)
    part = spark.read.format("celldex_tiles").option("tile", 32).option("window", "33,40,64,60").load(str(tmp_path / "p1.npy"))
    assert {(x["ty"], x["tx"]) for x in part.collect()} == {(1, 1)} and part.rdd.getNumPartitions() == 1
    shown = planes.unpacked(planes.stencil(got, 0, lambda v, inside: v[:1], kind="<i4")).where("plane = 1 and x = 5 and y = 69").head()
    assert shown["v"] == b[0, 69, 5]
    np.save(tmp_path / "p2.npy", a[0])
    with pytest.raises(ValueError, match="several shapes"):
        read_planes(spark, str(tmp_path))
