"""Spatial operators against brute force on small fixtures, edges and dense places included."""

import math
import random

import pytest
from pyspark.sql import functions as F

from unitledger.functions import geo
from unitledger.operators import spatial


def points_df(spark, pts):
    return spark.createDataFrame([(i, float(x), float(y)) for i, (x, y) in enumerate(pts)], "id bigint, x double, y double")


def rings_df(spark, rings):
    return spark.createDataFrame(
        [(name, [{"x": float(x), "y": float(y)} for x, y in ring]) for name, ring in rings],
        "region_id string, ring array<struct<x:double,y:double>>",
    )


def inside(x, y, ring):
    odd = False
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        if (y1 > y) != (y2 > y) and x < x1 + (y - y1) * (x2 - x1) / (y2 - y1):
            odd = not odd
    return odd


def gap(x, y, ring):
    best = math.inf
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
        dx, dy = x2 - x1, y2 - y1
        t = max(0.0, min(1.0, ((x - x1) * dx + (y - y1) * dy) / (dx * dx + dy * dy or 1)))
        best = min(best, math.hypot(x - x1 - t * dx, y - y1 - t * dy))
    return best


HOLE = [("h", [(0, 0), (10, 0), (10, 10), (0, 10)]), ("h", [(4, 4), (6, 4), (6, 6), (4, 6)])]
SHAPES = [
    ("a", [(0, 0), (9, 1), (8, 9), (4, 3), (1, 8)]),
    ("b", [(5, 5), (15, 5), (15, 15), (5, 15)]),
    ("tiny", [(12.1, 12.1), (12.2, 12.1), (12.15, 12.2)]),
]


@pytest.mark.parametrize("cell", [0.7, 3.0, 50.0])
def test_containment_equals_brute_force_for_any_cell_size(spark, cell):
    rng = random.Random(1)
    pts = [(rng.uniform(-2, 17), rng.uniform(-2, 17)) for _ in range(400)] + [(5, 5), (15, 15), (12.15, 12.15), (0, 0)]
    edges = spatial.ring_edges(rings_df(spark, SHAPES))
    got = {(r["id"], r["region_id"]) for r in spatial.join_regions(points_df(spark, pts), edges, "x", "y", cell).collect()}
    assert got == {(i, n) for i, (x, y) in enumerate(pts) for n, ring in SHAPES if inside(x, y, ring)}
    near = spatial.join_regions(points_df(spark, pts), edges, "x", "y", cell, buffer=0.8).collect()
    want = {(i, n) for i, (x, y) in enumerate(pts) for n, ring in SHAPES if inside(x, y, ring) or gap(x, y, ring) <= 0.8}
    assert {(r["id"], r["region_id"]) for r in near} == want


@pytest.mark.parametrize("cell", [1.0, 2.5])
@pytest.mark.parametrize("buffer", [None, 0.5])
def test_corners_and_edges_on_cell_borders(spark, cell, buffer):
    """Rings with whole corners, level edges, repeated corners and crossings, left of and below zero too."""
    rng = random.Random(11)
    rings = [(f"r{k}", [(rng.randint(-6, 6), rng.randint(-6, 6)) for _ in range(rng.randint(3, 9))]) for k in range(12)]
    rings.append(("level", [(-5, -5), (0, -5), (0, -5), (5, -5), (5, 0), (5, 5), (0, 5), (-5, 5), (-5, 0)]))
    pts = [(a / 2, b / 2) for a in range(-14, 15) for b in range(-14, 15)] + [(rng.uniform(-7, 7), rng.uniform(-7, 7)) for _ in range(200)]
    edges = spatial.ring_edges(rings_df(spark, rings))
    got = {(r["id"], r["region_id"]) for r in spatial.join_regions(points_df(spark, pts), edges, "x", "y", cell, buffer=buffer).collect()}
    near = lambda x, y, ring: buffer is not None and gap(x, y, ring) <= buffer
    assert got == {(i, n) for i, (x, y) in enumerate(pts) for n, ring in rings if inside(x, y, ring) or near(x, y, ring)}


def test_a_ring_of_many_corners_is_cut_to_cells(spark):
    """No cell carries more than the edges near it, whatever the ring has in its row."""
    n = 60_000
    radius = lambda k: 10 + 2 * math.sin(40 * math.pi * k / n) + 0.01 * (k % 2)
    ring = [(radius(k) * math.cos(2 * math.pi * k / n), radius(k) * math.sin(2 * math.pi * k / n)) for k in range(n)]
    edges = spatial.written(spatial.ring_edges(rings_df(spark, [("star", ring)])).repartition(8))
    largest = spatial.region_cells(edges, 0.25).agg(F.max(F.size("border_edges"))).first()[0]
    assert largest < n / 50
    rng = random.Random(12)
    pts = [(rng.uniform(-13, 13), rng.uniform(-13, 13)) for _ in range(60)]
    got = {r["id"] for r in spatial.join_regions(points_df(spark, pts), edges, "x", "y", 0.25).collect()}
    assert got == {i for i, (x, y) in enumerate(pts) if inside(x, y, ring)}


def test_holes_boundaries_and_missing_positions(spark):
    edges = spatial.ring_edges(rings_df(spark, HOLE))
    pts = spark.createDataFrame(
        [(1, 5.0, 5.0), (2, 3.0, 5.0), (3, 10.0, 5.0), (4, None, 5.0), (5, 20.0, 5.0)], "id int, x double, y double"
    )
    rows = {r["id"]: r["region_id"] for r in spatial.join_regions(pts, edges, "x", "y", 1.0, how="left").collect()}
    assert rows == {1: None, 2: "h", 3: None, 4: None, 5: None}
    touching = {r["id"] for r in spatial.join_regions(pts, edges, "x", "y", 1.0, buffer=0.0).collect()}
    assert touching == {2, 3}
    assert spatial.ring_edges(rings_df(spark, [("none", [])])).count() == 0


def dense(rng, n):
    spots = [(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(n)]
    copies = [(7.0, 7.0)] * (n // 3)  # a third of all points at one place
    clump = [(20 + rng.uniform(0, 2), 20 + rng.uniform(0, 2)) for _ in range(n // 3)]
    return spots + copies + clump


def test_neighbour_counts_equal_brute_force(spark):
    pts = dense(random.Random(2), 240)
    got = {r["id"]: r["neighbours"] for r in spatial.neighbour_counts(points_df(spark, pts), "id", "x", "y", 1.5).collect()}
    want = {
        i: sum(1 for j, q in enumerate(pts) if j != i and (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= 2.25)
        for i, p in enumerate(pts)
    }
    assert got == want


@pytest.mark.parametrize("leaf", [1, 40])
def test_levels_as_deep_as_the_places_ask_for(spark, monkeypatch, leaf):
    monkeypatch.setattr(spatial, "LEAF", leaf)
    rng = random.Random(5)
    pts = dense(rng, 200) + [(3.0 + rng.gauss(0, 1e-4), 4.5 + rng.gauss(0, 1e-4)) for _ in range(60)] + [(-0.5 * k, -1.5) for k in range(8)]
    counts = {r["id"]: r["neighbours"] for r in spatial.neighbour_counts(points_df(spark, pts), "id", "x", "y", 1.5).collect()}
    near = lambda p, q, d: (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= d * d
    assert counts == {i: sum(near(p, q, 1.5) for q in pts) - 1 for i, p in enumerate(pts)}
    found = spatial.clusters(points_df(spark, pts), "id", "x", "y", 0.6)
    assert {r["id"]: r["cluster"] for r in found.collect()} == components(pts, 1.2)


def test_dense_places_are_compared_in_few_pairs(spark):
    """Places inside one radius: pairs tested per place grow far slower than the places."""
    tested = []
    for n in (1000, 16_000):
        r = random.Random(n)
        df = points_df(spark, [(r.uniform(0, 1), r.uniform(0, 1)) for _ in range(n)])
        places = spatial.written(spatial.locations(df, "x", "y", spatial.side_of(0.9)))
        _, leaves = spatial.refined(places, places, spatial.cell_pairs(places, places, 0.9), 0.9)
        boxes = spatial.written(leaves)
        every = places.withColumn("level", F.explode(F.sequence(F.lit(0), F.lit(8))))
        sizes = every.groupBy("level", *[spatial._box_number(q, F.col("level")).alias(a) for q, a in (("qx", "ax"), ("qy", "ay"))]).count()
        other = sizes.withColumnsRenamed({"ax": "bx", "ay": "by", "count": "m"})
        total = boxes.join(sizes, ["level", "ax", "ay"]).join(other, ["level", "bx", "by"]).agg(F.sum(F.col("count") * F.col("m"))).first()[0]
        tested.append(total / n)
    assert tested[1] < 6 * tested[0] and tested[1] < 0.2 * 16_000


def components(pts, d):
    label = list(range(len(pts)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, p in enumerate(pts):
        for j in range(i):
            q = pts[j]
            if (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= d * d:
                a, b = sorted((root(i), root(j)))
                label[b] = a
    return {i: root(i) for i in range(len(pts))}


def test_clusters_and_membership_equal_brute_force(spark):
    rng = random.Random(3)
    pts = dense(rng, 150)
    found = spatial.clusters(points_df(spark, pts), "id", "x", "y", 0.9)
    got = {r["id"]: r["cluster"] for r in found.collect()}
    want = components(pts, 1.8)
    assert got == want
    others = [(rng.uniform(0, 40), rng.uniform(0, 40)) for _ in range(150)] + [(7.0, 7.5)]
    members = points_df(spark, pts).join(found, "id")
    hits = spatial.in_clusters(points_df(spark, others), "id", "x", "y", members, "x", "y", "cluster", 0.9).collect()
    expected = {
        (i, want[j]) for i, o in enumerate(others) for j, p in enumerate(pts) if (o[0] - p[0]) ** 2 + (o[1] - p[1]) ** 2 <= 0.81
    }
    assert {(r["id"], r["cluster"]) for r in hits} == expected and len(hits) == len(expected)


def test_long_chain_is_one_component(spark):
    chain = [(float(i), 0.0) for i in range(120)]
    got = {r["cluster"] for r in spatial.clusters(points_df(spark, chain), "id", "x", "y", 0.5).collect()}
    assert got == {0}


def test_projection_and_offsets(spark):
    # Published test point of the projection: 5 E, 50 N -> 3962799.45, 2999718.85.
    df = spark.createDataFrame([(5.0, 50.0), (10.0, 52.0)], "lon double, lat double")
    x, y = geo.to_laea(F.col("lon"), F.col("lat"))
    rows = df.select(F.round(x, 2).alias("x"), F.round(y, 2).alias("y")).collect()
    assert tuple(rows[0]) == (3962799.45, 2999718.85) and tuple(rows[1]) == (4321000.0, 3210000.0)
    ring = df.select(geo.octagon(F.col("lon"), F.col("lat"), F.lit(50.0)).alias("r")).first()["r"]
    assert len(ring) == 8 and ring[0]["lat"] > 50.0 and abs(ring[0]["lon"] - 5.0) < 1e-12
    box = df.select(geo.panel_box(F.col("lon"), F.col("lat"), F.lit(10.0)).alias("r")).first()["r"]
    assert len(box) == 4


def test_surface_point_of_a_u_shape_lies_inside(spark):
    u = [(0, 0), (9, 0), (9, 10), (8, 10), (8, 1), (3, 1), (3, 10), (0, 10)]
    row = spatial.surface_points(spatial.ring_edges(rings_df(spark, [("u", u)]))).first()
    assert inside(row["point_x"], row["point_y"], u)


def test_totals_of_all_levels_keep_empty_regions(spark):
    from unitledger.plans import quality

    square = lambda key, x: (key, [(x, 0.0), (x + 1.0, 0.0), (x + 1.0, 1.0), (x, 1.0)])
    layer = [square("01001001", 0.0), square("01001002", 1.0), square("01002001", 2.0), square("02001001", 3.0)]
    rings = spark.createDataFrame(layer, "region_id string, ring array<struct<x:double,y:double>>")
    units = spark.createDataFrame([(0.5, 0.5, 2.0), (0.6, 0.5, 3.0), (1.5, 0.5, None), (9.0, 9.0, 7.0), (None, 0.5, 7.0)], "x double, y double, value double")
    got = quality.region_level_totals(units, spatial.ring_edges(rings), "x", "y", "value", 0.5)
    assert {(r.level, r.region_id): (r.units, r.capacity) for r in got.collect()} == {
        ("state", "01"): (3, 5.0), ("state", "02"): (None, None),
        ("district", "01001"): (3, 5.0), ("district", "01002"): (None, None), ("district", "02001"): (None, None),
        ("municipality", "01001001"): (2, 5.0), ("municipality", "01001002"): (1, None),
        ("municipality", "01002001"): (None, None), ("municipality", "02001001"): (None, None),
    }
    text = got._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Expand") == 1  # one rollup for all levels


def test_comparable_units(spark):
    from unitledger.plans import quality

    rows = [(1, 1.0, "a", "1", "Windkraft an Land"), (2, 1.0, "a", "0", "Windkraft an Land"), (3, 1.0, "a", None, "Windkraft an Land"), (4, None, "a", "1", None), (5, 1.0, "a", "1", None), (6, 1.0, "a", "1", "Windkraft auf See")]
    df = spark.createDataFrame(rows, "id int, Laengengrad double, Landkreis string, NetzbetreiberpruefungStatus string, Lage string").withColumn("Gemeinde", F.lit("g"))
    ids = lambda *a, **k: sorted(r.id for r in quality.comparable_units(df, *a, **k).collect())
    assert ids("solar") == [1, 2, 3, 5, 6] and ids("solar_extended", checked=True) == [1, 5, 6]
    assert ids("wind_extended") == [1, 2, 3] and ids("wind", checked=True) == [1]


def test_points_near_are_counted_in_blocks():
    import numpy as np

    rng = np.random.default_rng(3)
    for sizes, spread in (((700, 2500), 4.0), ((1, 900), 1.0), ((900, 1), 1.0), ((300, 300), 0.0), ((0, 5), 1.0), ((5, 0), 1.0)):
        (xa, ya), (xb, yb) = ([np.round(rng.uniform(0, spread, n), 2) for _ in "xy"] for n in sizes)
        for nb in (np.ones(sizes[1], np.int64), rng.integers(1, 5, sizes[1])):
            near = (xa[:, None] - xb) ** 2 + (ya[:, None] - yb) ** 2 <= 2.25
            assert spatial.near_points(xa, ya, xb, yb, nb, 2.25).tolist() == (near * nb).sum(axis=1).tolist()


@pytest.mark.parametrize("pack,group,pairs", [(1, 1, 50), (8, 20, 1000), (4096, 1 << 16, 1 << 24)])
def test_neighbours_are_counted_in_groups_of_any_size(spark, monkeypatch, pack, group, pairs):
    for name, value in (("PACK", pack), ("GROUP", group), ("TASK_PAIRS", pairs)):
        monkeypatch.setattr(spatial, name, value)
    pts = dense(random.Random(7), 200)
    near = {i: {j for j, q in enumerate(pts) if j != i and (p[0] - q[0]) ** 2 + (p[1] - q[1]) ** 2 <= 2.25} for i, p in enumerate(pts)}
    df = points_df(spark, pts)
    got = {r["id"]: r["neighbours"] for r in spatial.neighbour_counts(df, "id", "x", "y", 1.5).collect()}
    assert got == {i: len(found) for i, found in near.items()}
    found = spatial.neighbours_of(df, df.filter("id % 3 = 0"), "id", "x", "y", 1.5)
    assert sorted((r.unit, r.id) for r in found.select("unit", "id").collect()) == sorted((i, j) for i, js in near.items() if i % 3 == 0 for j in js)


def test_moved_rows_grow_with_places_and_looked_up_pairs_are_dealt(spark, monkeypatch):
    from unitledger.operators import skew

    monkeypatch.setattr(spatial, "TASK_PAIRS", 2000)
    dealt = []
    counted = spatial._counted
    monkeypatch.setattr(spatial, "_counted", lambda limit: dealt.append(limit) or counted(limit))
    df = points_df(spark, [(random.Random(i).uniform(0, 3), random.Random(-i - 1).uniform(0, 3)) for i in range(400)])
    assert spatial.neighbour_counts(df, "id", "x", "y", 1.0).count() == 400 and dealt == [1.0]
    found = spatial.neighbours_of(df, df.filter("id < 100"), "id", "x", "y", 1.0)
    sizes = [n for n in found.rdd.glom().map(len).collect() if n]
    assert len(sizes) > 5 and max(sizes) <= 8 * 2000  # not a task or two, however few the bytes
    assert skew.written(found).count() == sum(sizes)
