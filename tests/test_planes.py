"""Stencils over tiles against plain versions on whole planes."""

import numpy as np
import pytest

from celldex.operators import planes


def table(spark, a, plane=0):
    rows = [(plane, x, y, int(a[y, x])) for y in range(a.shape[0]) for x in range(a.shape[1]) if a[y, x]]
    return spark.createDataFrame(rows, "plane long, x long, y long, v long")


def whole(df, shape, value="v"):
    out = np.zeros(shape, np.int64)
    rows = df.collect()
    assert len(rows) == shape[0] * shape[1]
    for r in rows:
        out[r["y"], r["x"]] = r[value]
    return out


def at(a, y, x, default):
    return a[y, x] if 0 <= y < a.shape[0] and 0 <= x < a.shape[1] else default


def plain_closing(a, r):
    disk = [(dy, dx) for dy in range(-r, r + 1) for dx in range(-r, r + 1) if dy * dy + dx * dx <= r * r]

    def each(b, pick):
        return np.array([[pick(b[y + dy, x + dx] for dy, dx in disk if 0 <= y + dy < b.shape[0] and 0 <= x + dx < b.shape[1]) for x in range(b.shape[1])] for y in range(b.shape[0])])

    return each(each(a, max), min)


def plain_components(mask):
    out, n = np.zeros(mask.shape, int), 0
    for y, x in zip(*np.nonzero(mask), strict=True):
        if out[y, x]:
            continue
        n += 1
        todo = [(y, x)]
        out[y, x] = n
        while todo:
            cy, cx = todo.pop()
            for dy in (-1, 0, 1):
                for dx in (-1, 0, 1):
                    py, px = cy + dy, cx + dx
                    if at(mask, py, px, False) and not out[py, px]:
                        out[py, px] = n
                        todo.append((py, px))
    return out


def plain_area_closing(a, area):
    out = np.full(a.shape, a.max())
    for t in sorted(np.unique(a), reverse=True):
        c = plain_components(a <= t)
        size = np.bincount(c.ravel())
        out[(c > 0) & (size[c] >= area)] = t
    return out


def plain_contour(u, image, rounds=5):
    u = (u > 0).astype(int)
    slopes = np.gradient(image.astype(float))
    for k in range(rounds):
        grown = np.array([[max(at(u, y + dy, x + dx, 0) for dy in (-1, 0, 1) for dx in (-1, 0, 1)) for x in range(u.shape[1])] for y in range(u.shape[0])])
        u = np.where(image > 0.5 / 0.8, grown, u)
        pull = sum(s * d for s, d in zip(slopes, np.gradient(u.astype(float)), strict=True))
        u = np.where(pull > 0, 1, np.where(pull < 0, 0, u))
        lines = [[(-1, -1), (0, 0), (1, 1)], [(-1, 1), (0, 0), (1, -1)], [(-1, 0), (0, 0), (1, 0)], [(0, -1), (0, 0), (0, 1)]]

        def lower(b):  # the least over lines of the greatest on each
            return np.array([[min(max(at(b, y + dy, x + dx, 0) for dy, dx in line) for line in lines) for x in range(b.shape[1])] for y in range(b.shape[0])])

        def upper(b):
            return np.array([[max(min(at(b, y + dy, x + dx, 0) for dy, dx in line) for line in lines) for x in range(b.shape[1])] for y in range(b.shape[0])])

        u = upper(lower(u)) if k % 2 == 0 else lower(upper(u))
    return u


def plain_separation(a, disks, areas):
    now = a
    for r in disks:
        now = 1 - plain_closing(now, r)
    now = plain_area_closing(now, areas[0])
    return 1 - plain_area_closing(plain_contour(1 - now, 1 - a), areas[1])


@pytest.fixture(scope="module")
def blobs():
    r = np.random.default_rng(3)
    y, x = np.indices((37, 45))
    a = np.zeros(y.shape, int)
    for cy, cx, s in zip(r.integers(0, 37, 9), r.integers(0, 45, 9), r.integers(2, 8, 9), strict=True):
        a += (y - cy) ** 2 + (x - cx) ** 2 < s * s
    return np.minimum(a + (r.random(a.shape) < 0.08), 3)


def test_packed_round_trip_and_empty_tiles(spark, blobs):
    got = planes.packed(table(spark, blobs), 37, 45, 16)
    assert got.tiles.count() == 9 and (whole(planes.unpacked(got), blobs.shape) == blobs).all()
    two = table(spark, blobs).unionByName(table(spark, blobs[::-1], 5))
    back = planes.unpacked(planes.packed(two, 37, 45, 16))
    assert (whole(back.where("plane = 5"), blobs.shape) == blobs[::-1]).all()
    odd = spark.createDataFrame([(0, 1, 1, 7), (0, 1, 1, 9), (0, -1, 0, 5), (0, 45, 0, 5), (0, 2, 2, None)], "plane long, x long, y long, v long")
    flat = whole(planes.unpacked(planes.packed(odd, 37, 45, 16)), blobs.shape)
    assert flat[1, 1] == 9 and flat.sum() == 9


@pytest.mark.parametrize(("radius", "tile"), [(1, 16), (3, 8), (7, 5)])
def test_closing(spark, blobs, radius, tile):
    got = planes.closing(planes.packed(table(spark, blobs), 37, 45, tile), radius)
    assert (whole(planes.unpacked(got), blobs.shape) == plain_closing(blobs, radius)).all()


def test_labelled(blobs):
    for mask in (blobs > 0, blobs < 2, np.zeros((4, 5), bool), np.ones((4, 5), bool), np.indices((9, 9)).sum(0) % 2 == 0):
        got, want = planes.labelled(mask), plain_components(mask)
        assert len({*zip(got.ravel(), want.ravel(), strict=True)}) == len(np.unique(got)) == len(np.unique(want)) and ((got > 0) == mask).all()


@pytest.mark.parametrize(("area", "tile"), [(1, 16), (12, 7), (200, 16), (5000, 16)])
def test_area_closing(spark, blobs, area, tile):
    got = planes.area_closing(planes.packed(table(spark, blobs), 37, 45, tile), area)
    assert (whole(planes.unpacked(got), blobs.shape) == plain_area_closing(blobs, area)).all()


def test_area_closing_of_a_snake_and_a_flat_plane(spark):
    snake = np.ones((20, 20), int)
    snake[::4] = 0
    for k in range(0, 16, 4):
        snake[k : k + 5, 0 if k % 8 else 19] = 0
    for area in (101, 117, 118):
        assert (whole(planes.unpacked(planes.area_closing(planes.packed(table(spark, snake), 20, 20, 6), area)), snake.shape) == plain_area_closing(snake, area)).all()
    flat = np.full((5, 5), 2)
    assert (whole(planes.unpacked(planes.area_closing(planes.packed(table(spark, flat), 5, 5, 4), 3)), flat.shape) == flat).all()


@pytest.mark.parametrize("tile", [8, 64])
def test_contour(spark, blobs, tile):
    both = table(spark, blobs).selectExpr("plane", "x", "y", "1 - v as image", "cast(v > 1 as int) as u")
    every = planes.unpacked(planes.packed(table(spark, blobs), 37, 45, 16)).selectExpr("plane", "x", "y", "1 - v as image", "cast(v > 1 as int) as u")
    assert both.count() < every.count()
    # packed keeps the greatest of repeats, so negative numbers need no repeats
    got = planes.geodesic_contour(planes.packed(every, 37, 45, tile, ["u", "image"]))
    assert (whole(planes.unpacked(got), blobs.shape) == plain_contour(blobs > 1, 1 - blobs)).all()


def test_foreground_separation(spark, blobs):
    got = planes.foreground_separation(planes.packed(table(spark, blobs), 37, 45, 16), (1, 2, 4, 3), (60, 12))
    want = plain_separation(blobs, (1, 2, 4, 3), (60, 12))
    assert 0 < want.sum() < want.size and (whole(planes.unpacked(got), blobs.shape) == want).all()


@pytest.mark.parametrize(("reach", "tile"), [(2, 16), (20, 16), (3, 64)])
def test_grown(spark, reach, tile):
    r = np.random.default_rng(8)
    a = np.where(r.random((30, 41)) < 0.02, r.integers(1, 9, (30, 41)) * 10**10, 0)
    a[10, 10], a[10, 14] = 7, 3
    rows = [(0, x, y, int(a[y, x])) for y in range(30) for x in range(41) if a[y, x]]
    got = whole(planes.grown(spark.createDataFrame(rows, "plane long, x long, y long, label long"), 30, 41, reach, tile), a.shape, "label")
    spots = [(y, x, a[y, x]) for y, x in zip(*np.nonzero(a), strict=True)]
    want = np.array([[min((((y - py) ** 2 + (x - px) ** 2, v) for py, px, v in spots if (y - py) ** 2 + (x - px) ** 2 <= reach * reach), default=(0, 0))[1] for x in range(41)] for y in range(30)])
    assert (got == want).all()


def test_registration_finds_a_known_transform_and_mesh(spark):
    from celldex.operators import registration, tile_registration

    r = np.random.default_rng(11)
    rows = [(p, x, y, float(v), float(2 * v)) for p in (0, 3) for (y, x), v in np.ndenumerate(r.gamma(2, 50, (120, 150)))]
    reference = planes.packed(spark.createDataFrame(rows, "plane long, x long, y long, v double, w double"), 120, 150, 40, ["v", "w"], "<f8")
    turn = np.array([[1.004, 0.006, 4.3], [-0.006, 1.004, -3.4], [0, 0, 1]])
    bend = registration.Mesh([0.0, 75.0, 149.0], [0.0, 119.0], np.array([[(0, 0), (0.8, 0.4), (1.5, 0.5)], [(0.2, 0), (1.0, 0.6), (1.4, 0.8)]]))
    known = {0: (turn, bend), 3: (np.array([[1.0, 0, -6.0], [0, 1, 5.0], [0, 0, 1]]), None)}
    moving = tile_registration.warped_planes(reference, known, 120, 150)
    found = tile_registration.register(reference, moving, halo=16, gate=0.1)
    q = np.array([(x, y) for x in range(20, 140, 30) for y in range(20, 110, 30)], float)
    for plane, (m, mesh) in known.items():
        back = registration.source(m, mesh, registration.source(*found.moves[plane], q), 20)
        assert np.hypot(*(back - q).T).max() < 0.5, plane
    report = {(x["plane"], x["step"]): x["tre_mean"] for x in found.report().collect()}
    assert len(report) == 6 and report[0, "mesh"] < report[0, "anchor"] and report[3, "mesh"] < 0.1
    got = planes.unpacked(found.planes, ["v", "w"]).where("plane = 3 and x between 10 and 130 and y between 10 and 100").collect()
    want = {(x, y): v for p, x, y, v, _ in rows if p == 3}
    assert all(abs(g["v"] - want[g["x"], g["y"]]) < 30 and abs(g["w"] - 2 * g["v"]) < 1e-6 for g in got)


def test_warped_planes_are_those_of_pixels(spark):
    from celldex.operators import registration, tile_registration

    r = np.random.default_rng(2)
    a = r.random((30, 41))
    rows = [(0, x, y, float(v)) for (y, x), v in np.ndenumerate(a)]
    px = spark.createDataFrame(rows, "plane long, x long, y long, v double")
    m = np.array([[0.9, 0.2, 3.0], [-0.2, 1.1, 2.0], [0, 0, 1]])
    mesh = registration.Mesh([0.0, 30.0], [0.0, 20.0], r.normal(0, 2, (2, 2, 2)))
    got = {(x["x"], x["y"]): x["v"] for x in planes.unpacked(tile_registration.warped_planes(planes.packed(px, 30, 41, 8, kind="<f8"), {0: (m, mesh)}, 26, 37)).collect()}
    want = {(x["x"], x["y"]): x["v"] for x in registration.warped(px.drop("plane"), m, mesh, 26, 37, (30, 41)).collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_stage_plan():
    from celldex.operators.assemble import stage_plan

    assert stage_plan(False, True) == (["native", "rigid", "micro"], False)
    assert stage_plan(True, False) == (["native", "rigid", "non_rigid"], True)
    assert stage_plan(True, True) == (["native", "rigid", "non_rigid", "micro"], True)
