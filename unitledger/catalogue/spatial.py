"""Queries for positions, regions, distances and the cleansing chains."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from unitledger.catalogue import Tables, query
from unitledger.functions import geo
from unitledger.operators import spatial
from unitledger.operators.skew import keyed_join
from unitledger.plans import cleansing, quality, worklist

# Stand-in positions: customers scattered over a 100 x 100 square by integer arithmetic, and
# one five-cornered region per nation, whose notch grows with the nation number.
POINTS_SQL = """(SELECT c_custkey AS id, (c_custkey * 7919 % 100003) / 1e3 AS x, (c_custkey * 104729 % 99991) / 1e3 AS y, c_nationkey AS declared,
   c_acctbal AS power, c_mktsegment AS segment FROM customer)"""
EDGES_SQL = """(SELECT n_nationkey AS region_id, i AS edge_no, (n_nationkey % 5) * 2e1 + x1 AS x1, (n_nationkey // 5) * 2e1 + CASE WHEN i = 3 THEN y1 - (n_nationkey % 3) * 4e0 ELSE y1 END AS y1,
   (n_nationkey % 5) * 2e1 + x2 AS x2, (n_nationkey // 5) * 2e1 + CASE WHEN i = 2 THEN y2 - (n_nationkey % 3) * 4e0 ELSE y2 END AS y2
   FROM nation, (VALUES (0, 1e0, 1e0, 19e0, 2e0), (1, 19e0, 2e0, 17e0, 18e0), (2, 17e0, 18e0, 9e0, 12e0), (3, 9e0, 12e0, 2e0, 19e0), (4, 2e0, 19e0, 1e0, 1e0)) v(i, x1, y1, x2, y2))"""
CROSS_SQL = "(e.y1 > p.y) <> (e.y2 > p.y) AND p.x < e.x1 + (p.y - e.y1) * (e.x2 - e.x1) / nullif(e.y2 - e.y1, 0)"
INSIDE_SQL = f"""(SELECT p.id, e.region_id FROM {POINTS_SQL} p CROSS JOIN {EDGES_SQL} e GROUP BY p.id, e.region_id
   HAVING count(*) FILTER ({CROSS_SQL}) % 2 = 1)"""
ALONG_SQL = """greatest(0e0, least(1e0, coalesce(((p.x - e.x1) * (e.x2 - e.x1) + (p.y - e.y1) * (e.y2 - e.y1)) / nullif((e.x2 - e.x1) * (e.x2 - e.x1) + (e.y2 - e.y1) * (e.y2 - e.y1), 0), 0e0)))"""
NEAR_SQL = f"""(SELECT p.id, e.region_id FROM {POINTS_SQL} p CROSS JOIN LATERAL (SELECT e.*, {ALONG_SQL} AS t FROM {EDGES_SQL} e) e GROUP BY p.id, e.region_id
   HAVING count(*) FILTER ({CROSS_SQL}) % 2 = 1 OR min((p.x - (e.x1 + e.t * (e.x2 - e.x1))) * (p.x - (e.x1 + e.t * (e.x2 - e.x1))) + (p.y - (e.y1 + e.t * (e.y2 - e.y1))) * (p.y - (e.y1 + e.t * (e.y2 - e.y1)))) <= 1.5e0 * 1.5e0)"""
CELL = 4.0


def points(t: Tables):
    k = F.col("c_custkey")
    return t.customer.select(
        k.alias("id"), (k * 7919 % 100003 / 1000.0).alias("x"), (k * 104729 % 99991 / 1000.0).alias("y"),
        F.col("c_nationkey").alias("declared"), F.col("c_acctbal").alias("power"), F.col("c_mktsegment").alias("segment"),
    )


def rings(t: Tables):
    k = F.col("n_nationkey")
    ox, oy = (k % 5) * 20.0, F.floor(k / 5) * 20.0
    corners = [(1.0, 1.0), (19.0, 2.0), (17.0, 18.0), (9.0, 12.0), (2.0, 19.0)]
    ring = [
        F.struct((ox + x).alias("x"), (oy + (F.lit(y) - (k % 3) * 4.0 if (x, y) == (9.0, 12.0) else F.lit(y))).alias("y"))
        for x, y in corners
    ]
    return t.nation.select(k.alias("region_id"), F.array(*ring).alias("ring"))


def edges(t: Tables):
    return spatial.ring_edges(rings(t))


@query(
    f"""SELECT region_id, count(*) AS n_edges, min(least(x1, x2)) AS min_x, max(greatest(x1, x2)) AS max_x, min(least(y1, y2)) AS min_y, max(greatest(y1, y2)) AS max_y
        FROM {EDGES_SQL} GROUP BY region_id"""
)
def polygon_edges_bbox(t: Tables):
    e = edges(t)
    sizes = e.groupBy("region_id").agg(F.count(F.lit(1)).alias("n_edges"))
    return spatial.bounding_boxes(e).join(sizes, "region_id")


@query(f"SELECT region_id, edge_no, x1, y1, x2, y2 FROM {EDGES_SQL}")
def boundary_layer_rows(t: Tables):
    return edges(t)


@query(f"SELECT id, region_id FROM {INSIDE_SQL}")
def point_in_polygon(t: Tables):
    return spatial.join_regions(points(t), edges(t), "x", "y", CELL).select("id", "region_id")


@query(f"SELECT p.id, i.region_id FROM {POINTS_SQL} p LEFT JOIN {INSIDE_SQL} i ON i.id = p.id")
def point_in_polygon_left(t: Tables):
    found = spatial.join_regions(points(t).select("id", "x", "y"), edges(t), "x", "y", CELL, how="left")
    return found.select("id", "region_id")


@query(f"SELECT p.id, i.id IS NOT NULL AS correct FROM {POINTS_SQL} p LEFT JOIN {INSIDE_SQL} i ON i.id = p.id AND i.region_id = p.declared")
def declared_region_check(t: Tables):
    checked = spatial.in_declared_region(points(t), edges(t), "x", "y", CELL, "declared")
    return checked.select("id", "correct")


@query(f"SELECT id, region_id FROM {NEAR_SQL}")
def buffered_containment(t: Tables):
    return spatial.join_regions(points(t), edges(t), "x", "y", CELL, buffer=1.5).select("id", "region_id")


@query(
    f"""SELECT a.id, count(b.id) AS neighbours FROM {POINTS_SQL} a LEFT JOIN {POINTS_SQL} b ON b.id <> a.id
        AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 3e0 * 3e0 GROUP BY a.id"""
)
def neighbours_within(t: Tables):
    return spatial.neighbour_counts(points(t), "id", "x", "y", 3.0)


@query(
    f"""SELECT a.id AS unit, b.id, b.power FROM {POINTS_SQL} a JOIN {POINTS_SQL} b ON b.id <> a.id
        AND (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= 2e0 * 2e0 JOIN supplier s ON s.s_suppkey = a.id"""
)
def neighbours_of_units(t: Tables):
    wanted = t.supplier.select(F.col("s_suppkey").alias("id"))
    return spatial.neighbours_of(points(t), wanted, "id", "x", "y", 2.0).select("unit", "id", "power")


_e2 = geo.GRS80_F * (2 - geo.GRS80_F)
_e = math.sqrt(_e2)


def _q(s: float) -> float:
    return (1 - _e2) * (s / (1 - _e2 * s * s) - math.log((1 - _e * s) / (1 + _e * s)) / (2 * _e))


_beta0 = math.asin(_q(math.sin(math.radians(52))) / _q(1.0))
_rq = 6378137.0 * math.sqrt(_q(1.0) / 2)
_d = 6378137.0 * math.cos(math.radians(52)) / math.sqrt(1 - _e2 * math.sin(math.radians(52)) ** 2) / (_rq * math.cos(_beta0))
DEGREES_SQL = f"(SELECT id, 5e0 + x * 1e-1 AS lon, 47e0 + y * 8e-2 AS lat, power FROM {POINTS_SQL})"


def laea_sql(source: str, columns: str) -> str:
    """The projection in SQL over a source with `lon` and `lat`."""
    return f"""(SELECT *, 4321000 + b * {_d!r} * cos(beta) * sin(turn) AS px, 3210000 + b / {_d!r} * ({math.cos(_beta0)!r} * sin(beta) - {math.sin(_beta0)!r} * cos(beta) * cos(turn)) AS py
      FROM (SELECT *, {_rq!r} * sqrt(2 / (1 + {math.sin(_beta0)!r} * sin(beta) + {math.cos(_beta0)!r} * cos(beta) * cos(turn))) AS b
      FROM (SELECT {columns}, radians(lon) - radians(10) AS turn, asin({1 - _e2!r} * (sin(radians(lat)) / (1 - {_e2!r} * sin(radians(lat)) * sin(radians(lat)))
        - ln((1 - {_e!r} * sin(radians(lat))) / (1 + {_e!r} * sin(radians(lat)))) / {2 * _e!r}) / {_q(1.0)!r}) AS beta FROM {source})))"""


def degrees(t: Tables):
    return points(t).select("id", (5.0 + F.col("x") * 0.1).alias("lon"), (47.0 + F.col("y") * 0.08).alias("lat"), "power", "declared", "segment")


@query(f"SELECT id, round(px, 3) AS x_3035, round(py, 3) AS y_3035 FROM {laea_sql(DEGREES_SQL, 'id, lon, lat')}")
def project_laea(t: Tables):
    x, y = geo.to_laea(F.col("lon"), F.col("lat"))
    return degrees(t).select("id", F.round(x, 3).alias("x_3035"), F.round(y, 3).alias("y_3035"))


_w2 = geo.WGS84_F * (2 - geo.WGS84_F)


@query(
    f"""WITH g AS (SELECT id, lon, lat, sqrt(abs(power) * 5.5e0) * {math.sqrt(2)!r} / 2 AS m, 1 - {_w2!r} * sin(radians(lat)) * sin(radians(lat)) AS w FROM {DEGREES_SQL}),
        c AS (SELECT id, 'panel' AS shape, a AS bearing, lon, lat, m, w FROM g, (VALUES (45), (135), (225), (315)) v(a)
              UNION ALL SELECT id, 'octagon', a, lon, lat, 50e0, w FROM g, (VALUES (0), (45), (90), (135), (180), (225), (270), (315)) v(a))
        SELECT id, shape, bearing, round(lat + degrees(m * cos(radians(bearing)) / ({6378137.0 * (1 - _w2)!r} / (w * sqrt(w)))), 7) AS lat,
               round(lon + degrees(m * sin(radians(bearing)) / (6378137.0 / sqrt(w) * cos(radians(lat)))), 7) AS lon FROM c"""
)
def destination_polygons(t: Tables):
    units = degrees(t).select("id", F.col("lon").alias("Laengengrad"), F.col("lat").alias("Breitengrad"), F.abs("power").alias("Bruttoleistung"))
    shapes = worklist.with_outlines(units)
    corner = F.round("c.lat", 7).alias("lat"), F.round("c.lon", 7).alias("lon")
    panel = shapes.select("id", F.posexplode("panel").alias("i", "c")).select("id", F.lit("panel").alias("shape"), (F.col("i") * 90 + 45).alias("bearing"), *corner)
    octagon = shapes.select("id", F.posexplode("octagon").alias("i", "c")).select("id", F.lit("octagon").alias("shape"), (F.col("i") * 45).alias("bearing"), *corner)
    return panel.unionByName(octagon)


CENTRES_SQL = f"""(SELECT region_id, sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cy
   FROM {EDGES_SQL} GROUP BY region_id)"""
SURFACE_SQL = f"""(WITH c AS {CENTRES_SQL}, s AS (SELECT c.region_id, cx, cy, e.x1 + (cy - e.y1) * (e.x2 - e.x1) / (e.y2 - e.y1) AS pos FROM c JOIN {EDGES_SQL} e ON e.region_id = c.region_id AND (e.y1 > cy) <> (e.y2 > cy)),
   n AS (SELECT *, row_number() OVER (PARTITION BY region_id ORDER BY pos) AS rn, lead(pos) OVER (PARTITION BY region_id ORDER BY pos) AS nxt FROM s),
   w AS (SELECT *, nxt - pos AS width FROM n WHERE rn % 2 = 1)
   SELECT region_id, CASE WHEN bool_or(pos <= cx AND cx < nxt) THEN any_value(cx) ELSE arg_max((pos + nxt) / 2, width) END AS point_x, any_value(cy) AS point_y FROM w GROUP BY region_id)"""


@query(f"SELECT c.region_id, round(cx, 6) AS centre_x, round(cy, 6) AS centre_y, round(point_x, 6) AS point_x, round(point_y, 6) AS point_y FROM {CENTRES_SQL} c JOIN {SURFACE_SQL} s ON s.region_id = c.region_id")
def polygon_centres(t: Tables):
    e = edges(t)
    both = spatial.polygon_centres(e).join(spatial.surface_points(e), "region_id")
    return both.select("region_id", *[F.round(c, 6).alias(c) for c in ["centre_x", "centre_y", "point_x", "point_y"]])


# ------------------------------------------------------------------ clusters

METRES_SQL = "(SELECT c_custkey AS id, (c_custkey * 7919 % 100003) / 4e1 AS x, (c_custkey * 104729 % 99991) / 4e1 AS y, c_acctbal AS power FROM customer)"
OTHER_SQL = "(SELECT s_suppkey AS id, (s_suppkey * 7919 * 13 % 100003) / 4e1 AS x, (s_suppkey * 104729 * 13 % 99991) / 4e1 AS y FROM supplier)"


def metres(t: Tables):
    k = F.col("c_custkey")
    return t.customer.select(k.alias("id"), (k * 7919 % 100003 / 40.0).alias("x"), (k * 104729 % 99991 / 40.0).alias("y"), F.col("c_acctbal").alias("power"))


def other_metres(t: Tables):
    k = F.col("s_suppkey")
    return t.supplier.select(k.alias("id"), (k * 7919 * 13 % 100003 / 40.0).alias("x"), (k * 104729 * 13 % 99991 / 40.0).alias("y"))


def clusters_sql(source: str, d: str) -> str:
    return f"""RECURSIVE links AS (SELECT a.id AS a, b.id AS b FROM {source} a JOIN {source} b ON (a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y) <= {d} * {d}),
      reach(id, r) AS (SELECT id, id FROM {source} UNION SELECT reach.id, links.b FROM reach JOIN links ON links.a = reach.r),
      parts AS (SELECT id, min(r) AS cluster FROM reach GROUP BY id)"""


@query(f"WITH {clusters_sql(METRES_SQL, '5e1')} SELECT id, cluster FROM parts")
def buffer_clusters(t: Tables):
    return spatial.clusters(metres(t), "id", "x", "y", 25.0)


@query(
    f"""WITH {clusters_sql(METRES_SQL, '5e1')},
        hits AS (SELECT DISTINCT o.id, p.cluster FROM {OTHER_SQL} o JOIN {METRES_SQL} m ON (o.x - m.x) * (o.x - m.x) + (o.y - m.y) * (o.y - m.y) <= 25e0 * 25e0 JOIN parts p ON p.id = m.id)
        SELECT p.cluster, count(*) AS units, round(sum(m.power), 2) AS capacity, any_value(coalesce(h.n, 0)) AS other_points
        FROM parts p JOIN {METRES_SQL} m ON m.id = p.id LEFT JOIN (SELECT cluster, count(*) AS n FROM hits GROUP BY cluster) h ON h.cluster = p.cluster GROUP BY p.cluster"""
)
def buffer_cluster_sums(t: Tables):
    units, other = metres(t), other_metres(t)
    parts = keyed_join(units, spatial.clusters(units, "id", "x", "y", 25.0), ["id"], "inner")
    inside = spatial.in_clusters(other, "id", "x", "y", parts, "x", "y", "cluster", 25.0)
    sums = parts.groupBy("cluster").agg(F.count(F.lit(1)).alias("units"), F.round(F.sum("power"), 2).alias("capacity"))
    counts = inside.groupBy("cluster").agg(F.count(F.lit(1)).alias("other_points"))
    return keyed_join(sums, counts, ["cluster"], "left").withColumn("other_points", F.coalesce("other_points", F.lit(0).cast("bigint")))


# ------------------------------------------------------------------ reports and chains

VALID_SQL = f"(SELECT id, x * 5 - 250 AS lon, y * 2 - 100 AS lat, segment FROM {POINTS_SQL})"


@query(f"SELECT id, lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 AS valid, CASE WHEN lon BETWEEN -180 AND 180 AND lat BETWEEN -90 AND 90 THEN round(lon, 6) END AS lon FROM {VALID_SQL}")
def point_column_validity(t: Tables):
    p = points(t).select("id", (F.col("x") * 5 - 250).alias("lon"), (F.col("y") * 2 - 100).alias("lat"))
    valid = geo.valid_position(F.col("lon"), F.col("lat"))
    return p.select("id", valid.alias("valid"), F.when(valid, F.round("lon", 6)).alias("lon"))


@query(
    f"""SELECT technology, count(*) AS n, count(*) FILTER (hit IS NULL) AS mismatches, round(count(*) FILTER (hit IS NULL) * 1.0 / count(*), 6) AS share
        FROM (SELECT p.segment AS technology, i.id AS hit FROM {POINTS_SQL} p LEFT JOIN {NEAR_SQL} i ON i.id = p.id AND i.region_id = p.declared) GROUP BY technology"""
)
def region_mismatch_report(t: Tables):
    every = points(t)
    kinds = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    tables = {k: every.filter(F.col("segment") == k) for k in kinds}
    report = quality.mismatch_report(tables, edges(t), "declared", "x", "y", CELL, buffer=1.5)
    return report.withColumn("share", F.round("share", 6))


@query(
    f"""SELECT n.n_nationkey AS region_id, n.n_name, a.units, a.capacity FROM nation n LEFT JOIN (SELECT i.region_id, count(*) AS units, round(sum(p.power), 2) AS capacity
        FROM {INSIDE_SQL} i JOIN {POINTS_SQL} p ON p.id = i.id GROUP BY i.region_id) a ON a.region_id = n.n_nationkey"""
)
def region_capacity(t: Tables):
    regions = t.nation.select(F.col("n_nationkey").alias("region_id"), "n_name")
    return quality.region_totals(points(t), regions, edges(t), "x", "y", "power", CELL)


@query(
    f"""SELECT * FROM (SELECT n.n_nationkey AS region_id, n.n_name, a.units, a.capacity FROM nation n LEFT JOIN (SELECT i.region_id, count(*) AS units, round(sum(p.power), 2) AS capacity
        FROM {INSIDE_SQL} i JOIN {POINTS_SQL} p ON p.id = i.id GROUP BY i.region_id) a ON a.region_id = n.n_nationkey) WHERE CAST(region_id AS VARCHAR) LIKE '1%'"""
)
def region_capacity_prefix(t: Tables):
    """The totals of one upper level: regions whose key starts with a prefix."""
    regions = t.nation.select(F.col("n_nationkey").alias("region_id"), "n_name")
    return quality.region_totals(points(t), regions, edges(t), "x", "y", "power", CELL, prefix="1")


LEVEL_SQL = "lpad(CAST(n_regionkey AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey % 3 AS VARCHAR), 3, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0')"


@query(
    f"""WITH r AS (SELECT n_nationkey, {LEVEL_SQL} AS ags FROM nation),
       u AS (SELECT r.ags, p.power FROM {INSIDE_SQL} i JOIN {POINTS_SQL} p ON p.id = i.id JOIN r ON r.n_nationkey = i.region_id WHERE p.x >= 20),
       l(level, n) AS (VALUES ('state', 2), ('district', 5), ('municipality', 8))
       SELECT level, region_id, units, capacity FROM (SELECT DISTINCT level, n, left(ags, n) AS region_id FROM r, l)
       LEFT JOIN (SELECT level, left(ags, n) AS region_id, count(*) AS units, round(sum(power), 2) AS capacity FROM u, l GROUP BY ALL) USING (level, region_id)"""
)
def region_capacity_levels(t: Tables):
    """Totals of state, district and municipality in one pass over the units and their regions."""
    nation = F.col("n_nationkey")
    ags = F.concat(F.lpad(F.col("n_regionkey").cast("string"), 2, "0"), F.lpad((nation % 3).cast("string"), 3, "0"), F.lpad(nation.cast("string"), 3, "0"))
    named = edges(t).join(t.nation.select(nation.alias("region_id"), ags.alias("ags")), "region_id").drop("region_id").withColumnRenamed("ags", "region_id")
    units = points(t).filter("x >= 20")  # the first column of regions is empty
    return quality.region_level_totals(units, named, "x", "y", "power", CELL)


@query(
    f"""SELECT technology, count(*) AS n, count(*) FILTER (hit IS NULL) AS mismatches, round(count(*) FILTER (hit IS NULL) * 1.0 / count(*), 6) AS share
        FROM (SELECT p.segment AS technology, i.id AS hit FROM {POINTS_SQL} p LEFT JOIN {NEAR_SQL} i ON i.id = p.id AND i.region_id = p.declared
              WHERE p.id % 5 > 0 AND p.id % 3 > 0 AND (p.segment <> 'BUILDING' OR p.id % 2 = 0)) GROUP BY technology"""
)
def region_mismatch_checked(t: Tables):
    """The mismatch report over comparable units: confirmed by the grid operator, wind on land."""
    n = F.col("id")
    every = points(t).withColumns(
        {
            "NetzbetreiberpruefungStatus": F.when(n % 5 > 0, "1").when(n % 10 > 0, "0"),
            "Gemeinde": F.when(n % 3 > 0, "a town"),
            "Lage": F.when(n % 2 == 0, "Windkraft an Land").when(n % 7 > 0, "Windkraft auf See"),
        }
    )
    kinds = {"AUTOMOBILE": "solar", "BUILDING": "wind_extended", "FURNITURE": "hydro", "HOUSEHOLD": "biomass", "MACHINERY": "storage"}
    tables = {technology: every.filter(F.col("segment") == kind) for kind, technology in kinds.items()}
    report = quality.mismatch_report(tables, edges(t), "declared", "x", "y", CELL, buffer=1.5, required=["x", "Gemeinde"], checked=True)
    back = F.create_map(*[F.lit(x) for pair in ((v, k) for k, v in kinds.items()) for x in pair])
    return report.withColumns({"technology": back[F.col("technology")], "share": F.round("share", 6)})


ROUND_SQL = f"""(SELECT id, x, y, segment <> 'BUILDING' AS running FROM {POINTS_SQL})"""


@query(
    f"""WITH u AS {ROUND_SQL}, picked AS (SELECT * FROM u WHERE running ORDER BY md5(id || '-11'), id LIMIT 20)
       SELECT 'picked' AS part, id AS unit, NULL AS neighbour, 0 AS label FROM picked
       UNION ALL SELECT 'near', p.id, u.id, NULL FROM picked p JOIN u ON u.id <> p.id AND (u.x - p.x) * (u.x - p.x) + (u.y - p.y) * (u.y - p.y) <= 4
       UNION ALL SELECT 'label', id, NULL, CAST(id % 4 AS INTEGER) FROM u WHERE running AND id % 4 > 0"""
)
def worklist_round(t: Tables):
    """A round of the validation worklist: units drawn from all relevant ones, the units near them,
    and the label file of all labelled units, written and read back."""
    import uuid

    from unitledger.session import shared_dir

    n = F.col("id")
    units = points(t).select(
        n.alias("EinheitMastrNummer"), F.col("x").alias("Laengengrad"), F.col("y").alias("Breitengrad"), F.lit(100.0).alias("Bruttoleistung"),
        F.when(F.col("segment") != "BUILDING", "In Betrieb").alias("EinheitBetriebsstatus"),
    )
    picked, near = worklist.validation_round(units, units, "biomass", 2.0, count=20, seed=11)
    marked = worklist.add_relevance(units, "biomass").withColumn(
        "manval_location", F.when(F.col("EinheitMastrNummer") % 4 > 0, (F.col("EinheitMastrNummer") % 4).cast("int"))
    )
    path = f"{shared_dir(t.spark)}/labels-{uuid.uuid4().hex}"
    worklist.write_labels(marked, "biomass", path)
    labels = t.spark.read.schema("id bigint, label int").csv(path, header=True)
    none = F.lit(None).cast("bigint")
    key = F.col("EinheitMastrNummer")
    return (
        picked.filter(F.size("octagon") > 0).select(F.lit("picked").alias("part"), key.alias("unit"), none.alias("neighbour"), F.lit(0).alias("label"))
        .unionByName(near.select(F.lit("near").alias("part"), "unit", key.alias("neighbour"), F.lit(None).cast("int").alias("label")))
        .unionByName(labels.select(F.lit("label").alias("part"), F.col("id").alias("unit"), none.alias("neighbour"), "label"))
    )


UNITS_SQL = f"""(SELECT id, CASE WHEN id % 4 > 0 THEN x END AS x, CASE WHEN id % 4 > 0 THEN y END AS y, CASE WHEN id % 7 > 0 THEN declared END AS state, power FROM {POINTS_SQL})"""


@query(
    f"""WITH u AS {UNITS_SQL}, r AS (SELECT u.*, i.id IS NOT NULL AS hit FROM u LEFT JOIN {NEAR_SQL} i ON i.id = u.id AND i.region_id = u.state)
        SELECT 'all' AS name, (SELECT count(*) * 2 - count(*) FILTER (state IS NULL) FROM u) AS n UNION ALL SELECT 'duplicated', (SELECT count(*) * 2 FROM u WHERE state IS NOT NULL)
        UNION ALL SELECT 'unique', (SELECT count(*) FROM u) UNION ALL SELECT 'unlocated', (SELECT count(*) FROM u WHERE x IS NULL)
        UNION ALL SELECT 'located', (SELECT count(*) FROM u WHERE x IS NOT NULL) UNION ALL SELECT 'no_state', (SELECT count(*) FROM u WHERE x IS NOT NULL AND state IS NULL)
        UNION ALL SELECT 'right_state', (SELECT count(*) FROM r WHERE x IS NOT NULL AND state IS NOT NULL AND hit) UNION ALL SELECT 'wrong_state', (SELECT count(*) FROM r WHERE x IS NOT NULL AND state IS NOT NULL AND NOT hit)"""
)
def location_funnel(t: Tables):
    placed = F.col("id") % 4 > 0
    units = points(t).select(
        "id", F.when(placed, F.col("x")).alias("x"), F.when(placed, F.col("y")).alias("y"),
        F.when(F.col("id") % 7 > 0, F.col("declared")).alias("state"), "power", F.lit(1).alias("stamp"),
    )
    repeats = units.filter("state is not null").withColumn("stamp", F.lit(2))
    return quality.location_funnel([units, repeats], edges(t), "stamp", "state", "x", "y", CELL, buffer=1.5)


@query(
    """WITH u AS (SELECT o_orderkey, o_custkey AS k FROM orders WHERE o_orderstatus = 'F'), s AS (SELECT c_custkey AS k FROM customer WHERE c_acctbal > 2000 AND c_mktsegment <> 'BUILDING')
       SELECT 0 AS step, 'unlocated' AS name, count(*) AS n FROM u UNION ALL SELECT 1, 'shared_keys', count(DISTINCT k) FROM u WHERE k IN (SELECT k FROM s)
       UNION ALL SELECT 2, 'found', count(*) FROM u WHERE k IN (SELECT k FROM s) UNION ALL SELECT 3, 'missing', count(*) FROM u WHERE k NOT IN (SELECT k FROM s)"""
)
def supplement_funnel(t: Tables):
    unlocated = t.orders.filter("o_orderstatus = 'F'").select("o_orderkey", F.col("o_custkey").alias("k"))
    rich = F.when((F.col("c_acctbal") > 2000) & (F.col("c_mktsegment") != "BUILDING"), F.col("c_acctbal"))
    source = t.customer.select(F.col("c_custkey").alias("k"), rich.alias("lon"), rich.alias("lat"))
    return quality.supplement_funnel(unlocated, source, "k", ["lon", "lat"], [F.desc("lon")])


@query(
    """WITH u AS (SELECT (CASE WHEN o_orderkey % 3 = 0 THEN 'SME' ELSE 'SEE' END) || o_orderkey AS id, o_custkey AS plz, o_orderpriority AS kind, o_orderdate AS dt, o_orderkey FROM orders),
       f AS (SELECT *, CASE WHEN o_orderkey % 3 = 0 AND dt <= TIMESTAMP '1999-01-31' THEN 'old' WHEN o_orderkey % 3 > 0 AND dt > TIMESTAMP '1999-01-31' THEN 'new' END AS side FROM u),
       g AS (SELECT plz, kind, count(*) FILTER (side = 'old') AS n_old, count(*) FILTER (side = 'new') AS n_new FROM f GROUP BY plz, kind)
       SELECT f.plz, f.kind, f.side, f.id, n_old, n_new FROM f JOIN g ON g.plz = f.plz AND g.kind = f.kind WHERE side IS NOT NULL AND n_old > 0 AND n_new > 0"""
)
def migration_candidates(t: Tables):
    prefix = F.when(F.col("o_orderkey") % 3 == 0, "SME").otherwise("SEE")
    units = t.orders.select(
        F.concat(prefix, "o_orderkey").alias("id"), F.col("o_custkey").alias("plz"), F.col("o_orderpriority").alias("kind"), F.col("o_orderdate").alias("at")
    )
    return quality.migration_candidates(units, "id", "at", ["plz", "kind"], cut="1999-01-31")


@query(
    """SELECT event_id, CASE WHEN event_id % 5 > 0 AND event_type IN ('click', 'view') AND user_id % 2 = 0 THEN true END AS relevant, 3 AS label FROM events
       WHERE event_id % 5 > 0 AND event_type IN ('click', 'view') AND user_id % 2 = 0 AND value > 20
       UNION ALL SELECT event_id, CASE WHEN event_id % 5 > 0 AND event_type IN ('click', 'view') AND user_id % 2 = 0 THEN true END, NULL FROM events
       WHERE NOT (event_id % 5 > 0 AND event_type IN ('click', 'view') AND user_id % 2 = 0 AND value > 20)"""
)
def worklist_relevance(t: Tables):
    n = F.col("event_id")
    units = t.events.select(
        n.alias("EinheitMastrNummer"), F.when(n % 5 > 0, n * 1.0).alias("Laengengrad"), (n * 1.0).alias("Breitengrad"),
        F.when(F.col("event_type").isin("click", "view"), "In Betrieb").otherwise("Geplant").alias("EinheitBetriebsstatus"),
        F.when(F.col("user_id") % 2 == 0, "Windkraft an Land").otherwise("Windkraft auf See").alias("Lage"), "value",
    )
    marked = worklist.add_relevance(units, "wind")
    labels = marked.filter("manval_relevant and value > 20").select("EinheitMastrNummer", F.lit(3).alias("manval_location"))
    done = worklist.import_labels(marked, labels, "wind")
    return done.select(F.col("EinheitMastrNummer").alias("event_id"), F.col("manval_relevant").alias("relevant"), F.col("manval_location").alias("label"))


@query(
    """SELECT event_id AS "EinheitMastrNummer", CAST(event_id % 3 AS INTEGER) AS manval_location FROM events WHERE event_type = 'click' AND event_id % 3 > 0"""
)
def worklist_label_export(t: Tables):
    n = F.col("event_id")
    units = t.events.select(
        n.alias("EinheitMastrNummer"), F.when(F.col("event_type") == "click", F.lit(True)).alias("manval_relevant"),
        F.when(n % 3 > 0, (n % 3).cast("int")).alias("manval_location"),
    )
    return worklist.labelled(units, "wind")


CHAIN_UNITS_SQL = f"""(SELECT id, CASE WHEN id % 3 = 0 THEN 'SME' ELSE 'SEE' END || id AS key, CASE WHEN id % 4 > 0 THEN 5e0 + x * 1e-1 END AS lon, CASE WHEN id % 4 > 0 THEN 47e0 + y * 8e-2 END AS lat,
    CASE WHEN id % 6 > 0 THEN 10000 + declared END AS plz, CASE WHEN id % 2 = 0 THEN 'D-' || (10000 + id % 30) || ' Ort' ELSE 'Ort ' || id END AS address,
    CASE segment WHEN 'BUILDING' THEN 'WindAufSee' WHEN 'MACHINERY' THEN NULL ELSE 'WindAnLand' END AS lage, CASE WHEN id % 2 = 0 THEN 'A' ELSE 'B' END AS flag,
    CASE id % 4 WHEN 0 THEN 'InBetrieb' WHEN 1 THEN 'InPlanung' WHEN 2 THEN 'DauerhaftStillgelegt' ELSE 'Unbekannt' END AS status, abs(power) AS power FROM {POINTS_SQL})"""
PLZ_EDGES_SQL = f"(SELECT 10000 + region_id AS plz, 5e0 + x1 * 1e-1 AS x1, 47e0 + y1 * 8e-2 AS y1, 5e0 + x2 * 1e-1 AS x2, 47e0 + y2 * 8e-2 AS y2 FROM {EDGES_SQL})"
COUNTRY_SQL = "(VALUES (6e0, 48e0, 14e0, 48e0), (14e0, 48e0, 14e0, 54e0), (14e0, 54e0, 6e0, 54e0), (6e0, 54e0, 6e0, 48e0)) c(x1, y1, x2, y2)"
SEA_SQL = "(VALUES (5e0, 51e0, 13e0, 51e0), (13e0, 51e0, 13e0, 55e0), (13e0, 55e0, 5e0, 55e0), (5e0, 55e0, 5e0, 51e0)) c(x1, y1, x2, y2)"


def chain_units(t: Tables):
    n, p = F.col("id"), degrees(t)
    placed = n % 4 > 0
    return p.select(
        n.alias("id"),
        F.concat(F.when(n % 3 == 0, "SME").otherwise("SEE"), n).alias("EinheitMastrNummer"),
        F.when(placed, F.col("lon")).alias("Laengengrad"), F.when(placed, F.col("lat")).alias("Breitengrad"),
        F.when(n % 6 > 0, (F.col("declared") + 10000).cast("string")).alias("Postleitzahl"),
        F.when(n % 2 == 0, F.concat(F.lit("D-"), (n % 30 + 10000).cast("string"), F.lit(" Ort"))).otherwise(F.concat(F.lit("Ort "), n)).alias("Standort"),
        F.when(F.col("segment") == "BUILDING", "WindAufSee").when(F.col("segment") == "MACHINERY", F.lit(None)).otherwise("WindAnLand").alias("Lage"),
        F.when(n % 2 == 0, "A").otherwise("B").alias("StatisikFlag"),
        F.when(n % 4 == 0, "InBetrieb").when(n % 4 == 1, "InPlanung").when(n % 4 == 2, "DauerhaftStillgelegt").otherwise("Unbekannt").alias("EinheitBetriebsstatus"),
        F.abs("power").alias("Bruttoleistung"),
    )


def chain_bounds(t: Tables):
    x, y = (lambda c: F.col(c) * 0.1 + 5.0), (lambda c: F.col(c) * 0.08 + 47.0)
    postcodes = edges(t).select(
        (F.col("region_id") + 10000).cast("string").alias("region_id"), "edge_no",
        x("x1").alias("x1"), y("y1").alias("y1"), x("x2").alias("x2"), y("y2").alias("y2"),
    )

    def box(name, x0, y0, x1, y1):
        # The stand-in country and zone are one box each, drawn from the region table.
        corners = [(x0, y0), (x1, y0), (x1, y1), (x0, y1)]
        ring = F.array(*[F.struct(F.lit(a).alias("x"), F.lit(b).alias("y")) for a, b in corners])
        one = t.region.agg(F.min("r_regionkey").alias("k")).select(F.lit(name).alias("region_id"), ring.alias("ring"))
        return spatial.ring_edges(one)

    return cleansing.Boundaries(
        country=box("land", 6.0, 48.0, 14.0, 54.0), postcodes=postcodes, offshore=box("sea", 5.0, 51.0, 13.0, 55.0), postcode_cell=0.4
    )


def _inside_sql(units: str, edges_sql: str, x: str, y: str) -> str:
    return f"""(SELECT u.id FROM {units} u CROSS JOIN {edges_sql} GROUP BY u.id HAVING count(*) FILTER ((c.y1 > u.{y}) <> (c.y2 > u.{y})
      AND u.{x} < c.x1 + (u.{y} - c.y1) * (c.x2 - c.x1) / nullif(c.y2 - c.y1, 0)) % 2 = 1)"""


CHAIN_CENTRES_SQL = f"""(SELECT plz, sum((x1 + x2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cx, sum((y1 + y2) * (x1 * y2 - x2 * y1)) / (3 * sum(x1 * y2 - x2 * y1)) AS cy
   FROM {PLZ_EDGES_SQL} GROUP BY plz)"""


def short_chain_sql(technology: str, strict: bool) -> str:
    steps = cleansing.SHORT_STEPS[technology]
    gone = "false" if strict else "lon IS NOT NULL AND NOT inside"
    address = "NULL" if not steps.address_step else "{}"
    return f"""WITH u AS {CHAIN_UNITS_SQL}, c AS {CHAIN_CENTRES_SQL}, i AS {_inside_sql('u', COUNTRY_SQL, 'lon', 'lat')},
        j AS (SELECT u.*, i.id IS NOT NULL AS inside, a.cx AS ax, a.cy AS ay, {address.format('b.cx')} AS bx, {address.format('b.cy')} AS byy FROM u LEFT JOIN i ON i.id = u.id LEFT JOIN c a ON a.plz = u.plz
              LEFT JOIN c b ON length(regexp_replace(u.address, '[^0-9]', '', 'g')) = 5 AND b.plz = TRY_CAST(regexp_replace(u.address, '[^0-9]', '', 'g') AS INTEGER)),
        k AS (SELECT *, {gone} AS gone, lon IS NULL OR {gone} AS bare FROM j)
        SELECT id, nullif(CASE WHEN lon IS NOT NULL THEN 'has_geom; ' ELSE '{"no_geom; " if steps.mark_missing else ""}' END || CASE WHEN inside THEN 'inside_vg250; ' WHEN gone THEN 'outside_vg250; remove_geom; ' ELSE '' END
                   || CASE WHEN NOT bare THEN '' WHEN ax IS NOT NULL THEN 'make_geom_plz; ' WHEN bx IS NOT NULL THEN 'make_geom_standort_plz; ' ELSE '' END, '') AS comment,
               round(CASE WHEN bare THEN COALESCE(ax, bx) ELSE lon END, 6) AS lon, round(CASE WHEN bare THEN COALESCE(ay, byy) ELSE lat END, 6) AS lat
        FROM k {"WHERE NOT bare OR ax IS NOT NULL OR bx IS NOT NULL" if steps.drop_unlocated else ""}"""


def _short_chain(t: Tables, technology: str, strict: bool = True):
    done = cleansing.short_cleansing(chain_units(t), chain_bounds(t), technology, strict)
    return done.select("id", "comment", F.round("Laengengrad", 6).alias("lon"), F.round("Breitengrad", 6).alias("lat"))


@query(short_chain_sql("combustion", False))
def cleansing_chain_short(t: Tables):
    return _short_chain(t, "combustion", strict=False)


@query(short_chain_sql("combustion", True))
def cleansing_chain_short_strict(t: Tables):
    return _short_chain(t, "combustion")


@query(short_chain_sql("solar", True))
def cleansing_chain_solar(t: Tables):
    return _short_chain(t, "solar")


@query(short_chain_sql("hydro", False))
def cleansing_chain_hydro_corrected(t: Tables):
    return _short_chain(t, "hydro", strict=False)


@query(short_chain_sql("hydro", True))
def cleansing_chain_hydro(t: Tables):
    return _short_chain(t, "hydro")


@query(short_chain_sql("biomass", True))
def cleansing_chain_biomass(t: Tables):
    return _short_chain(t, "biomass")


CHAIN_SURFACE_SQL = f"(SELECT 10000 + region_id AS plz, 5e0 + point_x * 1e-1 AS sx, 47e0 + point_y * 8e-2 AS sy FROM {SURFACE_SQL})"


def full_chain_sql(strict: bool) -> str:
    gone1 = "false" if strict else "onshore AND lon IS NOT NULL AND NOT inside"
    gone2 = "false" if strict else "offshore AND lon IS NOT NULL AND NOT sea"
    return f"""u AS {CHAIN_UNITS_SQL}, s AS {CHAIN_SURFACE_SQL}, i AS {_inside_sql('u', COUNTRY_SQL, 'lon', 'lat')}, z AS {_inside_sql('u', SEA_SQL, 'lon', 'lat')},
      a AS (SELECT u.*, lage = 'WindAnLand' AND lage IS NOT NULL AS onshore, lage = 'WindAufSee' AND lage IS NOT NULL AS offshore, i.id IS NOT NULL AND lage IS NOT DISTINCT FROM 'WindAnLand' AS inside,
              z.id IS NOT NULL AND lage IS NOT DISTINCT FROM 'WindAufSee' AS sea, p.sx AS ax, p.sy AS ay, q.sx AS bx, q.sy AS byy FROM u LEFT JOIN i ON i.id = u.id LEFT JOIN z ON z.id = u.id LEFT JOIN s p ON p.plz = u.plz
              LEFT JOIN s q ON length(regexp_replace(u.address, '[^0-9]', '', 'g')) = 5 AND q.plz = TRY_CAST(regexp_replace(u.address, '[^0-9]', '', 'g') AS INTEGER)),
      b AS (SELECT *, {gone1} AS gone1, {gone2} AS gone2 FROM a),
      d AS (SELECT *, onshore AND (lon IS NULL OR gone1) AND ax IS NOT NULL AS fix1, onshore AND (lon IS NULL OR gone1) AND ax IS NULL AND bx IS NOT NULL AS fix2 FROM b),
      f AS (SELECT *, CASE WHEN fix1 THEN ax WHEN fix2 THEN bx WHEN gone1 OR gone2 THEN NULL ELSE lon END AS x, CASE WHEN fix1 THEN ay WHEN fix2 THEN byy WHEN gone1 OR gone2 THEN NULL ELSE lat END AS y FROM d),
      g AS (SELECT *, x IS NULL AS guess, COALESCE(x, 8e0) AS gx, COALESCE(y, 54e0) AS gy FROM f),
      k AS (SELECT g.id FROM g JOIN {PLZ_EDGES_SQL} c ON c.plz = g.plz WHERE onshore GROUP BY g.id HAVING count(*) FILTER ((c.y1 > g.gy) <> (c.y2 > g.gy)
              AND g.gx < c.x1 + (g.gy - c.y1) * (c.x2 - c.x1) / nullif(c.y2 - c.y1, 0)) % 2 = 1),
      done AS (SELECT g.*, k.id IS NOT NULL AS own, CASE WHEN inside THEN 'onshore_inside; ' ELSE '' END || CASE WHEN fix1 THEN 'onshore_fix_plz; ' WHEN fix2 THEN 'onshore_fix_plz2; ' ELSE '' END
              || CASE WHEN sea THEN 'offshore_inside; ' ELSE '' END || CASE WHEN guess THEN 'guess_geom; ' ELSE '' END AS note FROM g LEFT JOIN k ON k.id = g.id)"""


FULL_SELECT = """SELECT id, nullif(note, '') AS comment,
   CASE WHEN power > 9500 THEN 'capacity=reduce/10;' ELSE '' END || 'einheit=' || left(key, 3) || ';flag=' || flag || ';' ||
   CASE WHEN fix1 OR fix2 OR guess THEN 'geom=true;' WHEN lon IS NULL OR gone1 OR gone2 THEN 'geom=false;' ELSE '' END ||
   CASE WHEN guess THEN 'geom_guess=somewhere;' WHEN fix1 THEN 'geom_guess=plz;' WHEN fix2 THEN 'geom_guess=standort_plz;' ELSE '' END ||
   CASE WHEN gone1 OR gone2 THEN 'geom_remove=true;' ELSE '' END ||
   'inside_germany=' || CASE WHEN inside OR sea OR fix1 OR fix2 OR guess THEN 'true' ELSE 'false' END || ';location=' || CASE WHEN onshore THEN 'onshore' WHEN offshore THEN 'offshore' ELSE 'na' END ||
   ';plz_check=' || CASE WHEN own THEN 'true' ELSE 'false' END || ';processed=true' ||
   CASE status WHEN 'InBetrieb' THEN ';status=operating' WHEN 'InPlanung' THEN ';status=planned' WHEN 'DauerhaftStillgelegt' THEN ';status=shutdown' ELSE '' END AS tags,
   round(CASE WHEN power > 9500 THEN power / 10 ELSE power END, 3) AS power, round(gx, 6) AS lon, round(gy, 6) AS lat FROM done"""


def _chain_result(done):
    from unitledger.functions.nested import tags_text

    return done.select(
        "id", "comment", tags_text(F.col("tags")).alias("tags"), F.round("Bruttoleistung", 3).alias("power"),
        F.round("lon", 6).alias("lon"), F.round("lat", 6).alias("lat"),
    )


@query(f"WITH {full_chain_sql(True)} {FULL_SELECT}")
def cleansing_chain_full(t: Tables):
    return _chain_result(cleansing.wind_cleansing(chain_units(t), chain_bounds(t)))


@query(f"WITH {full_chain_sql(False)} {FULL_SELECT}")
def cleansing_chain_full_corrected(t: Tables):
    return _chain_result(cleansing.wind_cleansing(chain_units(t), chain_bounds(t), strict=False))


@query(
    f"""WITH {full_chain_sql(True)} SELECT p.id, round(p.px, 2) AS x_3035, round(p.py, 2) AS y_3035 FROM {laea_sql('(SELECT id, gx AS lon, gy AS lat FROM done)', 'id, lon, lat')} p"""
)
def cleansing_chain_projected(t: Tables):
    done = cleansing.wind_cleansing(chain_units(t), chain_bounds(t))
    return done.select("id", F.round("x_3035", 2).alias("x_3035"), F.round("y_3035", 2).alias("y_3035"))


@query(
    f"""WITH {clusters_sql(OTHER_SQL, '12e1')}, hits AS (SELECT DISTINCT m.id, p.cluster FROM {METRES_SQL} m JOIN {OTHER_SQL} o ON (o.x - m.x) * (o.x - m.x) + (o.y - m.y) * (o.y - m.y) <= 6e1 * 6e1 JOIN parts p ON p.id = o.id)
        SELECT p.cluster, any_value(p.n) AS osm_count, round(sum(m.power), 2) AS mastr_sum, CASE WHEN count(m.id) > 0 THEN count(m.id) END AS mastr_count
        FROM (SELECT cluster, count(*) AS n FROM parts GROUP BY cluster) p LEFT JOIN hits h ON h.cluster = p.cluster LEFT JOIN {METRES_SQL} m ON m.id = h.id GROUP BY p.cluster"""
)
def external_match_table(t: Tables):
    _, table = _matched(t)
    return table.select("cluster", "osm_count", F.round("mastr_sum", 2).alias("mastr_sum"), "mastr_count")


def _matched(t: Tables):
    units = metres(t).select(
        F.col("id").alias("EinheitMastrNummer"), F.col("x").alias("x_3035"), F.col("y").alias("y_3035"), F.col("power").alias("Bruttoleistung"),
        F.create_map(F.lit("processed"), F.lit("true")).alias("tags"), F.lit(None).cast("string").alias("comment"),
    )
    external = other_metres(t).select(F.col("id").alias("osm_id"), F.col("x").alias("x_3035"), F.col("y").alias("y_3035"))
    return cleansing.match_external(units, external, reach=60.0)


@query(
    f"""WITH {clusters_sql(OTHER_SQL, '12e1')}, hits AS (SELECT DISTINCT m.id, p.cluster FROM {METRES_SQL} m JOIN {OTHER_SQL} o ON (o.x - m.x) * (o.x - m.x) + (o.y - m.y) * (o.y - m.y) <= 6e1 * 6e1 JOIN parts p ON p.id = o.id)
        SELECT m.id, h.cluster AS osm_id, CASE WHEN h.cluster IS NOT NULL THEN 'in_osm=true;match_osm=true;processed=true' ELSE 'processed=true' END AS tags,
               CASE WHEN h.cluster IS NOT NULL THEN 'match_osm; ' ELSE '' END AS comment
        FROM {METRES_SQL} m LEFT JOIN hits h ON h.id = m.id"""
)
def external_match_units(t: Tables):
    from unitledger.functions.nested import tags_text

    units, _ = _matched(t)
    return units.select(F.col("EinheitMastrNummer").alias("id"), "osm_id", tags_text(F.col("tags")).alias("tags"), F.coalesce("comment", F.lit("")).alias("comment"))
