"""Spatial joins by grid cell: points in polygons, neighbours, buffers and their unions.

Everything is an equi-join on integer cell columns followed by exact tests on columns, so
Spark partitions the work by place. Points at equal coordinates are merged before any
distance work, and cells that are certainly near or certainly far from each other are settled
by their bounding boxes, so dense places never meet point by point.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from unitledger.functions.geo import squared_distance
from unitledger.operators.skew import keyed_join, written

# ---------------------------------------------------------------- polygons


def ring_edges(regions: DataFrame, region: str = "region_id", ring: str = "ring") -> DataFrame:
    """One row per polygon edge. `ring` is an array of (x, y) structs; a ring that does not
    return to its start is closed. Holes are further rings of the same region."""
    points = F.col(ring)
    closed = F.when(F.element_at(points, 1) == F.element_at(points, -1), points).otherwise(
        F.concat(points, F.slice(points, 1, 1))
    )
    edges = F.transform(
        F.sequence(F.lit(1), F.size("_closed") - 1),
        lambda i: F.struct(
            F.element_at("_closed", i)["x"].alias("x1"),
            F.element_at("_closed", i)["y"].alias("y1"),
            F.element_at("_closed", i + 1)["x"].alias("x2"),
            F.element_at("_closed", i + 1)["y"].alias("y2"),
        ),
    )
    long_enough = regions.filter(F.size(ring) >= 3).withColumn("_closed", closed)
    return long_enough.select(region, F.posexplode(edges).alias("edge_no", "e")).select(region, "edge_no", "e.*")


def bounding_boxes(edges: DataFrame, region: str = "region_id") -> DataFrame:
    return edges.groupBy(region).agg(
        F.min(F.least("x1", "x2")).alias("min_x"),
        F.max(F.greatest("x1", "x2")).alias("max_x"),
        F.min(F.least("y1", "y2")).alias("min_y"),
        F.max(F.greatest("y1", "y2")).alias("max_y"),
    )


def crosses(x: Column, y: Column, e: Column) -> Column:
    """Half-open crossing rule: does a ray to the right of (x, y) cross edge `e`?"""
    straddles = (e["y1"] > y) != (e["y2"] > y)
    at = e["x1"] + (y - e["y1"]) * (e["x2"] - e["x1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0))
    return straddles & F.coalesce(x < at, F.lit(False))


def squared_edge_distance(x: Column, y: Column, e: Column) -> Column:
    dx, dy = e["x2"] - e["x1"], e["y2"] - e["y1"]
    along = ((x - e["x1"]) * dx + (y - e["y1"]) * dy) / F.nullif(dx * dx + dy * dy, F.lit(0.0))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce(along, F.lit(0.0))))
    return squared_distance(x, y, e["x1"] + t * dx, e["y1"] + t * dy)


def near_edge(x: Column, y: Column, edges: Column, distance: float) -> Column:
    return F.exists(edges, lambda e: squared_edge_distance(x, y, e) <= distance * distance)


def region_cells(edges: DataFrame, cell: float, buffer: float = 0.0, region: str = "region_id") -> DataFrame:
    """Grid cells a region covers. A cell no edge comes near is wholly inside and carries no edges;
    a border cell carries the edges that come near it, and `flipped`, the parity along its row.

    Each edge goes to the cells it crosses, row by row. Edges that lie right of a cell are only
    counted: those that come up through the bottom of the row by a running sum over the border
    cells of the row, and those that start within the row where an edge of the cell ends, because
    every corner of closed rings has an even number of edges. Such ends are kept with the cell's
    edges (`s1`, `s2`: the height of an end in the row and right of the cell). So the largest
    group holds the edges of one cell, and the largest window the border cells of one row.
    """

    def place(c: Column) -> Column:
        return F.floor(c / cell).cast("bigint")

    x1, y1, x2, y2, cx, cy = (F.col(c) for c in ("x1", "y1", "x2", "y2", "cx", "cy"))
    slack = cell * 1e-9  # more cells than needed carry an edge, never fewer
    low, high = cy * cell - buffer - slack, (cy + 1) * cell + buffer + slack

    def within_row(x: Column, y: Column) -> Column:
        """Where the edge from this end comes into the row."""
        bound = F.greatest(low, F.least(high, y))
        moved = F.when(bound == y, x).otherwise(x + (bound - y) * (x2 - x1) / F.nullif(y2 - y1, F.lit(0.0)))
        return F.greatest(F.least(x1, x2), F.least(F.greatest(x1, x2), F.coalesce(moved, x)))

    from_row, to_row = place(F.least(y1, y2) - buffer), place(F.greatest(y1, y2) + buffer)
    rows = edges.select(region, "x1", "y1", "x2", "y2", F.explode(F.sequence(from_row, to_row)).alias("cy"))
    ends = within_row(x1, y1), within_row(x2, y2)
    spans = rows.select(
        "*",
        place(F.least(*ends) - buffer - slack).alias("_first"),
        place(F.greatest(*ends) + buffer + slack).alias("_last"),
        ((place(y1) >= cy) != (place(y2) >= cy)).alias("_rises"),
    )
    listed = spans.withColumn("cx", F.explode(F.sequence("_first", "_last")))

    def end_beyond(x: Column, y: Column) -> Column:
        return F.when((place(y) == cy) & (place(x) > cx), y)

    edge = F.struct("x1", "y1", "x2", "y2", end_beyond(x1, y1).alias("s1"), end_beyond(x2, y2).alias("s2"))
    starts = F.sum((F.col("_rises") & (F.col("_first") == cx)).cast("int"))
    border = listed.groupBy(region, "cx", "cy").agg(F.collect_list(edge).alias("border_edges"), starts.alias("_starts"))
    leftwards = Window.partitionBy(region, "cy").orderBy(F.desc("cx"))
    beyond = F.sum("_starts").over(leftwards.rowsBetween(Window.unboundedPreceding, -1))
    border = border.select(
        region, "cx", "cy", "border_edges",
        (F.coalesce(beyond, F.lit(0)) % 2 == 1).alias("flipped"),
        F.lag("cx").over(leftwards).alias("_next"),
    )
    # Between two border cells of a row the parity does not change.
    inner = border.filter("flipped and _next > cx + 1").select(
        region,
        F.explode(F.sequence(cx + 1, F.col("_next") - 1)).alias("cx"),
        "cy",
        F.lit(None).cast(border.schema["border_edges"].dataType).alias("border_edges"),
        "flipped",
    )
    return border.drop("_next").unionByName(inner)


def inside_cell(x: Column, y: Column, entry: Column) -> Column:
    """Whether a point of a border cell lies in the region of an entry of the index."""

    def flips(e: Column) -> Column:
        beyond = [F.when(e[s] <= y, 1).otherwise(0) for s in ("s1", "s2")]
        return F.when(crosses(x, y, e), 1).otherwise(0) + beyond[0] + beyond[1]

    count = F.aggregate(entry["border_edges"], entry["flipped"].cast("int"), lambda n, e: n + flips(e))
    return count % 2 == 1


def region_index(edges: DataFrame, cell: float, buffer: float = 0.0, region: str = "region_id") -> DataFrame:
    """One row per grid cell with the regions that reach into it: the lookup side of every
    containment question. Its size depends on the layer only, never on the points; it is
    written once, so the planner broadcasts it only when its true size allows."""
    cells = region_cells(edges, cell, buffer, region)
    entry = F.struct(F.col(region).alias("region"), "border_edges", "flipped")
    return written(cells.groupBy("cx", "cy").agg(F.collect_list(entry).alias("_regions")))


def located(
    points: DataFrame, edges: DataFrame, x: str, y: str, cell: float,
    buffer: float | None = None, name: str = "regions", region: str = "region_id",
) -> DataFrame:
    """Add the array of regions that contain each point; no row is added, lost or moved when
    the region index can be broadcast. Points without a position get an empty array.

    `buffer` also accepts points within that distance of an edge (0 accepts points on it);
    without it only the half-open inside counts.
    """
    index = region_index(edges, cell, buffer or 0.0, region)
    placed = points.withColumns(
        {"cx": F.floor(F.col(x) / cell).cast("bigint"), "cy": F.floor(F.col(y) / cell).cast("bigint")}
    )
    joined = keyed_join(placed, index, ["cx", "cy"], "left")

    def holds(r: Column) -> Column:
        hit = r["border_edges"].isNull() | inside_cell(F.col(x), F.col(y), r)
        return hit if buffer is None else hit | near_edge(F.col(x), F.col(y), r["border_edges"], buffer)

    found = F.transform(F.filter("_regions", holds), lambda r: r["region"])
    none = F.array().cast(joined.select(found.alias("f")).schema["f"].dataType)
    return joined.select(*points.columns, F.coalesce(found, none).alias(name))


def join_regions(
    points: DataFrame, edges: DataFrame, x: str, y: str, cell: float,
    how: str = "inner", buffer: float | None = None, region: str = "region_id",
) -> DataFrame:
    """One row per point and region that contains it; `how="left"` keeps points in none."""
    found = located(points, edges, x, y, cell, buffer, "_found", region)
    spread = F.explode("_found") if how == "inner" else F.explode_outer("_found")
    return found.withColumn(region, spread).drop("_found")


def in_declared_region(
    points: DataFrame, edges: DataFrame, x: str, y: str, cell: float, declared: str,
    buffer: float | None = None, name: str = "correct", region: str = "region_id",
) -> DataFrame:
    """Flag points whose position lies in the region they name; never NULL."""
    found = located(points, edges, x, y, cell, buffer, "_found", region)
    own = F.coalesce(F.array_contains("_found", F.col(declared)), F.lit(False))
    return found.withColumn(name, own).drop("_found")


def polygon_centres(edges: DataFrame, region: str = "region_id") -> DataFrame:
    """Area-weighted centre of each polygon (shoelace sums per region)."""
    cross = F.col("x1") * F.col("y2") - F.col("x2") * F.col("y1")
    sums = edges.groupBy(region).agg(
        F.sum(cross).alias("_a2"),
        F.sum((F.col("x1") + F.col("x2")) * cross).alias("_sx"),
        F.sum((F.col("y1") + F.col("y2")) * cross).alias("_sy"),
    )
    area = F.nullif(F.col("_a2") * 3, F.lit(0.0))
    return sums.select(region, (F.col("_sx") / area).alias("centre_x"), (F.col("_sy") / area).alias("centre_y"))


def surface_points(edges: DataFrame, region: str = "region_id") -> DataFrame:
    """A point inside each polygon: its centre when inside, otherwise the middle of the
    longest inner span on the horizontal line through the centre."""
    centres = polygon_centres(edges, region)
    joined = edges.join(centres, region)
    straddles = (F.col("y1") > F.col("centre_y")) != (F.col("y2") > F.col("centre_y"))
    at = F.col("x1") + (F.col("centre_y") - F.col("y1")) * (F.col("x2") - F.col("x1")) / F.nullif(
        F.col("y2") - F.col("y1"), F.lit(0.0)
    )
    lines = joined.groupBy(region, "centre_x", "centre_y").agg(
        F.array_sort(F.collect_list(F.when(straddles, at))).alias("_xs")
    )
    spans = F.transform(
        F.sequence(F.lit(1), F.greatest(F.floor(F.size("_xs") / 2).cast("int"), F.lit(1))),
        lambda i: F.struct(
            (F.try_element_at("_xs", 2 * i) - F.try_element_at("_xs", 2 * i - 1)).alias("width"),
            ((F.try_element_at("_xs", 2 * i) + F.try_element_at("_xs", 2 * i - 1)) / 2).alias("middle"),
            (
                (F.try_element_at("_xs", 2 * i - 1) <= F.col("centre_x"))
                & (F.col("centre_x") < F.try_element_at("_xs", 2 * i))
            ).alias("holds_centre"),
        ),
    )
    picked = lines.withColumn("_spans", spans)
    centre_fits = F.exists("_spans", lambda s: F.coalesce(s["holds_centre"], F.lit(False)))
    widest = F.array_max("_spans")["middle"]
    return picked.select(
        region,
        F.when(centre_fits, F.col("centre_x")).otherwise(F.coalesce(widest, F.col("centre_x"))).alias("point_x"),
        F.col("centre_y").alias("point_y"),
    )


# ---------------------------------------------------------------- distances

FOLD = 4  # a box splits into FOLD x FOLD boxes of the next level
LEAF = 256  # pairs of places up to which a pair of boxes is compared place by place
PACK = 16 * LEAF  # places up to which a box is compared inside one group, see `_near_counts`
GROUP = 1 << 16  # places such a group compares with, so that none outgrows a task
TASK_PAIRS = 1 << 24  # candidate pairs that a task of a look-up gets; a task of numpy counts 16 times as many
LINK_STEPS = 2  # of the component search, before pairs of cells are looked into
DEPTH = 14  # levels at most; cell numbers and level numbers together stay within 63 bits


def locations(points: DataFrame, x: str, y: str, side: float, weight: Column | None = None) -> DataFrame:
    """Distinct coordinates with the number of points there, their cells, and their position in
    units of a cell, from which the boxes of all levels follow without rounding."""
    merged = (
        points.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
        .groupBy(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))
        .agg(F.sum(weight if weight is not None else F.lit(1)).alias("n"))
        .withColumns({"qx": F.col("x") / side, "qy": F.col("y") / side})
    )
    return merged.withColumns({"cx": _box_number("qx", 0), "cy": _box_number("qy", 0)})


def _box_number(position: str, level: int | Column) -> Column:
    """Number of the box of a level that holds a position; that of the box above is a quarter of it."""
    scale = F.pow(F.lit(float(FOLD)), level) if isinstance(level, Column) else F.lit(float(FOLD**level))
    return F.floor(F.col(position) * scale).cast("bigint")


def _boxes(places: DataFrame, keys: Sequence[str], tag: str) -> DataFrame:
    return places.groupBy(*keys).agg(
        F.sum("n").alias(f"n_{tag}"),
        F.count(F.lit(1)).alias(f"places_{tag}"),
        F.min("x").alias(f"x0_{tag}"),
        F.max("x").alias(f"x1_{tag}"),
        F.min("y").alias(f"y0_{tag}"),
        F.max("y").alias(f"y1_{tag}"),
    )


def _verdict(distance: float) -> Column:
    """`all` pairs of two boxes are near, `none` is, or `some` may be."""
    limit = F.lit(distance * distance)
    far_x = F.greatest(F.abs(F.col("x1_a") - F.col("x0_b")), F.abs(F.col("x1_b") - F.col("x0_a")))
    far_y = F.greatest(F.abs(F.col("y1_a") - F.col("y0_b")), F.abs(F.col("y1_b") - F.col("y0_a")))
    gap_x = F.greatest(F.lit(0.0), F.col("x0_b") - F.col("x1_a"), F.col("x0_a") - F.col("x1_b"))
    gap_y = F.greatest(F.lit(0.0), F.col("y0_b") - F.col("y1_a"), F.col("y0_a") - F.col("y1_b"))
    return (
        F.when(far_x * far_x + far_y * far_y <= limit, "all")
        .when(gap_x * gap_x + gap_y * gap_y > limit, "none")
        .otherwise("some")
    )


A_CELL = ["ax", "ay"]
B_CELL = ["bx", "by"]


def cell_pairs(a: DataFrame, b: DataFrame, distance: float) -> DataFrame:
    """Pairs of non-empty coarse cells that may be within the distance, with a verdict.

    The cell side is the distance divided by the square root of two, so a cell meets at most
    the 25 cells around it, whatever the number of points.
    """
    offsets = F.sequence(F.lit(-2), F.lit(2))
    box_a = _boxes(a, ["cx", "cy"], "a").withColumnsRenamed({"cx": "ax", "cy": "ay"})
    box_b = _boxes(b, ["cx", "cy"], "b").withColumnsRenamed({"cx": "bx", "cy": "by"})
    around = (
        box_a.withColumn("_dx", F.explode(offsets))
        .withColumn("_dy", F.explode(offsets))
        .withColumns({"bx": F.col("ax") + F.col("_dx"), "by": F.col("ay") + F.col("_dy")})
        .drop("_dx", "_dy")
    )
    return around.join(box_b, B_CELL).withColumn("verdict", _verdict(distance)).filter("verdict <> 'none'")


def side_of(distance: float) -> float:
    """Side of a cell whose diagonal stays within the distance."""
    return distance / math.sqrt(2) * (1 - 1e-9)


def _children(places: DataFrame, parents: DataFrame, level: int, tag: str) -> DataFrame:
    """Boxes of a level below the given boxes of the level above (`p<tag>x`, `p<tag>y`)."""
    names = [f"p{tag}x", f"p{tag}y"]
    numbered = places.withColumns({"ix": _box_number("qx", level), "iy": _box_number("qy", level)})
    above = {n: F.shiftright(i, 2) for n, i in zip(names, ("ix", "iy"))}
    own = numbered.withColumns(above).join(parents.select(*names).distinct(), names, "left_semi")
    return _boxes(own, [*names, "ix", "iy"], tag).withColumnsRenamed({"ix": f"{tag}x", "iy": f"{tag}y"})


def refined(
    a: DataFrame, b: DataFrame, pairs: DataFrame, distance: float, first_hit: bool = False, pack: int | None = None
) -> tuple[DataFrame, DataFrame]:
    """Undecided cell pairs taken apart level by level, as deep as their places ask for.

    A pair of boxes with more than LEAF pairs of places is replaced by the pairs of its sub-boxes
    that may be near. Returns the pairs of boxes that are near as a whole and those to be compared
    place by place: level, boxes (ax, ay, bx, by at that level), `n_b`. With `first_hit` a cell
    pair is done as soon as one pair of its boxes is near. With `pack` only boxes of more places
    than that are taken apart, and the pairs left over come with their numbers of places.
    """
    columns = [F.lit(0).alias("level"), *A_CELL, *B_CELL, "n_b", "places_a", "places_b"]
    pending = pairs.filter("verdict = 'some'").select(*columns)
    large = F.greatest("places_a", "places_b") > pack if pack else F.col("places_a") * F.col("places_b") > LEAF
    sure: list[DataFrame] = []
    leaves: list[DataFrame] = []
    for level in range(1, DEPTH + 1):
        leaves.append(pending.filter(~large))
        up = pending.filter(large).select(*[F.col(c).alias(f"p{c}") for c in (*A_CELL, *B_CELL)])
        if up.isEmpty():
            break
        below = written(
            up.join(_children(a, up, level, "a"), ["pax", "pay"])
            .join(_children(b, up, level, "b"), ["pbx", "pby"])
            .withColumn("verdict", _verdict(distance))
            .filter("verdict <> 'none'")
            .select(F.lit(level).alias("level"), *columns[1:], "verdict")
        )
        sure.append(below.filter("verdict = 'all'").drop("verdict"))
        pending = below.filter("verdict = 'some'").drop("verdict")
        if first_hit:
            hit = sure[-1].select(*_roots()).distinct()
            roots = [f"r{c}" for c in (*A_CELL, *B_CELL)]
            pending = written(pending.withColumns(dict(zip(roots, _roots()))).join(hit, roots, "left_anti").drop(*roots))
    else:
        leaves.append(pending)  # as deep as numbers reach
    none = pairs.limit(0).select(*columns)
    kept = ["level", *A_CELL, *B_CELL, "n_b"]
    union = lambda parts, *more: reduce(DataFrame.unionAll, parts, none).select(*kept, *more)
    return union(sure), union(leaves, "places_a", "places_b") if pack else union(leaves)


def _roots() -> list[Column]:
    """The cells (level 0) of a pair of boxes."""
    return [F.expr(f"shiftright({c}, 2 * level)").alias(f"r{c}") for c in (*A_CELL, *B_CELL)]


def _in_boxes(places: DataFrame, boxes: DataFrame, tag: str) -> DataFrame:
    """Places with the rows of their boxes; these are named by `level`, `<tag>x`, `<tag>y`."""
    levels = [r[0] for r in boxes.select("level").distinct().collect()]  # DEPTH at most
    every = places.withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]) if levels else F.array().cast("array<int>")))
    numbers = {f"{tag}x": _box_number("qx", F.col("level")), f"{tag}y": _box_number("qy", F.col("level"))}
    return every.withColumns(numbers).join(boxes, ["level", *numbers])


def _place_pairs(a: DataFrame, b: DataFrame, pairs: DataFrame, distance: float) -> DataFrame:
    """Exact test of the places of undecided pairs of boxes."""
    pairs = written(pairs.drop("n_b"))
    boxes_a, boxes_b = (pairs.select("level", *names).distinct() for names in (A_CELL, B_CELL))
    left = _in_boxes(a, boxes_a, "a").select("level", *A_CELL, F.col("x").alias("xa"), F.col("y").alias("ya"))
    right = _in_boxes(b, boxes_b, "b").select("level", *B_CELL, F.col("x").alias("xb"), F.col("y").alias("yb"), F.col("n").alias("nb"))
    near = squared_distance(F.col("xa"), F.col("ya"), F.col("xb"), F.col("yb")) <= distance * distance
    return pairs.join(left, ["level", *A_CELL]).join(right, ["level", *B_CELL]).filter(near)


def _near_counts(a: DataFrame, b: DataFrame, pairs: DataFrame, distance: float) -> DataFrame:
    """Points of b near each place of a, over undecided pairs of boxes: (x, y, `_near`), a row per
    group a place is in.

    A group is a box of a with boxes of b of about GROUP places. The places of both travel to it once
    per pair of boxes, never as pairs of places; tasks are as many as rows and pairs ask for.
    """
    pairs = written(pairs)
    places = (F.col("places_a") + F.col("places_b")) / F.lit(1 << 20)
    work = F.sum(F.greatest(places, F.col("places_a") * F.col("places_b") / F.lit(16 * TASK_PAIRS)))
    tasks = max(1, math.ceil(pairs.agg(work).first()[0] or 0))
    here = Window.partitionBy("level", *A_CELL)
    parts = F.ceil(F.sum("places_b").over(here) / F.lit(GROUP))
    pairs = written(pairs.select("level", *A_CELL, *B_CELL, F.pmod(F.xxhash64(*B_CELL), parts).cast("int").alias("part")))
    key = ["level", *A_CELL, "part"]
    left = _in_boxes(a, pairs.select(*key).distinct(), "a").select(*key, F.lit(0).alias("side"), "x", "y", F.col("n").cast("bigint").alias("n"))
    right = _in_boxes(b, pairs, "b").select(*key, F.lit(1).alias("side"), "x", "y", F.col("n").cast("bigint").alias("n"))
    grouped = left.unionAll(right).repartition(tasks, *key).sortWithinPartitions(*key, "side")
    return grouped.mapInArrow(_counted(distance * distance), "x double, y double, _near bigint")


def _counted(limit: float):
    """Counts of the groups of a sorted partition, group by group as the batches come."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def output(found):
            columns = [np.concatenate(c) for c in zip(*found)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["x", "y", "_near"])

        held: list[list] = []  # pieces of the group that may go on
        last, found, size = None, [], 0

        def close():
            side, x, y, n = (np.concatenate(c) for c in zip(*held))
            cut = int(np.searchsorted(side, 1))
            near = near_points(x[:cut], y[:cut], x[cut:], y[cut:], n[cut:], limit)
            hit = near > 0
            return x[:cut][hit], y[:cut][hit], near[hit]

        for batch in batches:
            if not batch.num_rows:
                continue
            *keys, side, x, y, n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            changes = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
            for begin, end in zip([0, *changes.tolist()], [*changes.tolist(), batch.num_rows]):
                key = tuple(k[begin] for k in keys)
                if held and key != last:
                    found.append(close())
                    size += len(found[-1][0])
                    held = []
                last = key
                held.append([c[begin:end] for c in (side, x, y, n)])
            if size > 10_000:
                yield output(found)
                found, size = [], 0
        if held:
            found.append(close())
        if found:
            yield output(found)

    return run


def near_points(xa, ya, xb, yb, nb, limit: float):
    """For each place of a the points (`nb` per place) of b within the squared distance, in numpy.

    Both sides are cut into blocks of some fifty places; a pair of blocks that is near or far as a
    whole is settled by its corners, as pairs of boxes are (`_verdict`).
    """
    import numpy as np

    near = np.zeros(len(xa), np.int64)
    if not len(xa) or not len(xb):
        return near

    def blocks(x, y):
        """Order of the places by block, and where each block starts."""
        across = max(1, int(math.sqrt(len(x) / 48)))
        if across == 1:
            return np.arange(len(x)), np.array([0])
        number = lambda v: np.minimum((v - v.min()) * (across / (np.ptp(v) or 1.0)), across - 1).astype(np.int64)
        block = number(x) * across + number(y)
        order = np.argsort(block, kind="stable")
        return order, np.flatnonzero(np.diff(block[order], prepend=-1))

    order_a, starts_a = blocks(xa, ya)
    order_b, starts_b = blocks(xb, yb)
    xb, yb, nb = xb[order_b], yb[order_b], nb[order_b]
    x0, x1, y0, y1 = (f.reduceat(v, starts_b) for v in (xb, yb) for f in (np.minimum, np.maximum))
    points, sizes = np.add.reduceat(nb, starts_b), np.diff(starts_b, append=len(xb))
    single = bool((nb == 1).all())
    for begin, end in zip(starts_a.tolist(), [*starts_a[1:].tolist(), len(xa)]):
        own = order_a[begin:end]
        x, y = xa[own], ya[own]
        left, right, low, high = x.min(), x.max(), y.min(), y.max()
        far_x, far_y = np.maximum(abs(right - x0), abs(x1 - left)), np.maximum(abs(high - y0), abs(y1 - low))
        gap_x = np.maximum(0.0, np.maximum(x0 - right, left - x1))
        gap_y = np.maximum(0.0, np.maximum(y0 - high, low - y1))
        whole = far_x * far_x + far_y * far_y <= limit
        some = ~whole & ~(gap_x * gap_x + gap_y * gap_y > limit)
        near[own] += points[whole].sum()
        if some.any():
            chosen = np.repeat(some, sizes)
            cx, cy, cn = xb[chosen], yb[chosen], nb[chosen]
            step = max(1, (1 << 20) // len(cx))
            for i in range(0, len(own), step):
                dx, dy = x[i : i + step, None] - cx, y[i : i + step, None] - cy
                hits = dx * dx + dy * dy <= limit
                near[own[i : i + step]] += np.count_nonzero(hits, axis=1) if single else (hits * cn).sum(axis=1)
    return near


def neighbour_counts(points: DataFrame, id_column: str, x: str, y: str, distance: float, name: str = "neighbours") -> DataFrame:
    """Number of other points within the distance of each point (ids without a position: NULL).

    Cells and boxes are added by their totals; only boxes cut by the circle's edge are compared
    place by place, inside groups, so that what moves grows with the places and not their pairs.
    """
    places = written(locations(points, x, y, side_of(distance)))
    pairs = written(cell_pairs(places, places, distance))
    sure, leaves = refined(places, places, pairs, distance, pack=PACK)
    whole = pairs.filter("verdict = 'all'").select(F.lit(0).alias("level"), *A_CELL, *B_CELL, "n_b").unionAll(sure)
    by_box = written(whole.groupBy("level", *A_CELL).agg(F.sum("n_b").alias("_near")))
    of_boxes = _in_boxes(places, by_box, "a").select("x", "y", "_near")
    of_places = _near_counts(places, places, leaves, distance)
    per_place = (
        of_boxes.unionAll(of_places)
        .groupBy(F.col("x").alias("_px"), F.col("y").alias("_py"))
        .agg((F.sum("_near") - 1).cast("bigint").alias(name))
    )
    keyed = points.withColumns({"_px": F.col(x).cast("double"), "_py": F.col(y).cast("double")})
    joined = keyed_join(keyed, per_place, ["_px", "_py"], "left")
    return joined.select(id_column, name)


def neighbours_of(points: DataFrame, wanted: DataFrame, id_column: str, x: str, y: str, distance: float) -> DataFrame:
    """All points within the distance of each wanted unit, without the unit itself.

    Made for looking up chosen units; the work is (wanted units) x (their surroundings). It is dealt
    by pairs, not bytes: cells with too many are cut, and the tasks are as many as the pairs ask for.
    """
    cell = distance

    def at(c: str) -> Column:
        return F.floor(F.col(c) / cell).cast("bigint")

    centre = written(
        keyed_join(points, wanted.select(id_column).distinct(), [id_column], "left_semi").select(
            F.col(id_column).alias("unit"), F.col(x).alias("_x0"), F.col(y).alias("_y0"), at(x).alias("_cx"), at(y).alias("_cy")
        )
    )
    offsets = F.sequence(F.lit(-1), F.lit(1))
    around = (
        centre.withColumn("_dx", F.explode(offsets))
        .withColumn("_dy", F.explode(offsets))
        .withColumns({"cx": F.col("_cx") + F.col("_dx"), "cy": F.col("_cy") + F.col("_dy")})
        .drop("_dx", "_dy", "_cx", "_cy")
    )
    placed = points.withColumns({"cx": at(x), "cy": at(y)})
    size = lambda df, name: df.groupBy("cx", "cy").agg(F.count(F.lit(1)).alias(name))
    work = F.col("_points") * F.col("_units")
    cells = written(size(placed, "_points").join(size(around, "_units"), ["cx", "cy"]).select("cx", "cy", work.alias("_work")))
    tasks = max(1, math.ceil((cells.agg(F.sum("_work")).first()[0] or 0) / TASK_PAIRS))
    cut = F.ceil(F.col("_work") / F.lit(TASK_PAIRS)).cast("int")
    cells = cells.select("cx", "cy", cut.alias("_cut"))
    key = ["cx", "cy", "_part"]
    part = F.pmod(F.xxhash64("unit", "_x0", "_y0"), F.col("_cut")).cast("int")
    units = around.join(cells, ["cx", "cy"]).withColumn("_part", part).drop("_cut").repartition(tasks, *key)
    parts = F.explode(F.sequence(F.lit(0), F.col("_cut") - 1))
    dealt = placed.join(cells, ["cx", "cy"]).withColumn("_part", parts).drop("_cut").repartition(tasks, *key)
    near = squared_distance(F.col(x), F.col(y), F.col("_x0"), F.col("_y0")) <= distance * distance
    return dealt.join(units, key).filter(near & (F.col(id_column) != F.col("unit"))).select("unit", *points.columns)


def connected_components(edges: DataFrame, a: str, b: str) -> DataFrame:
    """Smallest reachable node per node, for an undirected edge list.

    Alternates the large-star and small-star steps, which shrink the graph to stars in a
    logarithmic number of rounds. Each round is written to the checkpoint folder; the loop ends
    when a round changes nothing. Returns (node, component) for nodes with an edge.
    """
    pairs, state = _written_round(
        edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct()
    )
    while True:
        pairs, new_state = _written_round(_star_step(pairs))
        if new_state == state:
            break
        state = new_state
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    centres = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return members.unionByName(centres)


def _star_step(pairs: DataFrame) -> DataFrame:
    """One large-star and one small-star step on pairs (u, v), v the smaller node."""
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    large = keyed_join(both, least, ["u"], "inner").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    least = large.groupBy("u").agg(F.min("v").alias("m"))
    return (
        keyed_join(large, least, ["u"], "inner")
        .filter("v <> m")
        .select(F.col("v").alias("u"), F.col("m").alias("v"))
        .unionByName(least.select("u", F.col("m").alias("v")))
        .distinct()
    )


def _written_round(pairs: DataFrame) -> tuple[DataFrame, dict]:
    """Write a round's pairs; their count and checksum are observed by the same job."""
    seen = Observation()
    total = F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
    table = written(pairs.observe(seen, F.count(F.lit(1)).alias("n"), total.alias("sum")))
    return table, seen.get


def _cell_id(x: Column, y: Column) -> Column:
    """Both cell numbers in one bigint, which aggregates and shuffles cheaper than a struct."""
    fits = (F.abs(x) < 2**31) & (F.abs(y) < 2**31)
    packed = F.shiftleft(x, 32).bitwiseOR(y.bitwiseAND(F.lit(0xFFFFFFFF)))
    return F.when(fits, packed).otherwise(F.raise_error(F.lit("cell number out of range: distance too small")).cast("bigint"))


def clusters(points: DataFrame, id_column: str, x: str, y: str, reach: float) -> DataFrame:
    """Parts of the union of circles of radius `reach` around the points.

    Two points share a part when a chain of points with gaps of at most twice the radius links
    them. All points of one cell are near each other, so the graph is one of cells, not points.
    Cells that are near as a whole are linked first; of the other pairs only those that a few
    steps along these links do not join yet are looked into, each until a pair of boxes or places
    is near. The part is named by its smallest point id. Returns (id, cluster).
    """
    distance = 2 * reach
    side = side_of(distance)
    places = written(locations(points, x, y, side))
    near = cell_pairs(places, places, distance).filter("ax < bx or (ax = bx and ay < by)")
    pairs = written(near.withColumns({"p": _cell_id(F.col("ax"), F.col("ay")), "q": _cell_id(F.col("bx"), F.col("by"))}))
    known = pairs.filter("verdict = 'all'").select(F.greatest("p", "q").alias("u"), F.least("p", "q").alias("v"))
    for _ in range(LINK_STEPS):
        known = written(_star_step(known))
    led = known.groupBy("u").agg(F.min("v").alias("_leader"))

    def with_leader(df: DataFrame, node: str, name: str) -> DataFrame:
        return keyed_join(df, led.withColumnRenamed("u", node), [node], "left").withColumn(name, F.coalesce("_leader", node)).drop("_leader")

    some = with_leader(with_leader(pairs.filter("verdict = 'some'"), "p", "_a"), "q", "_b").filter("_a <> _b")
    sure, leaves = refined(places, places, written(some), distance, first_hit=True)
    tested = _place_pairs(places, places, leaves, distance)
    found = sure.select(*_roots()).unionAll(tested.select(*_roots())).distinct()
    new = found.select(_cell_id(F.col("rax"), F.col("ray")).alias("u"), _cell_id(F.col("rbx"), F.col("rby")).alias("v"))
    parts = connected_components(known.unionByName(new), "u", "v")
    cell = _cell_id(
        F.floor(F.col(x).cast("double") / side).cast("bigint"), F.floor(F.col(y).cast("double") / side).cast("bigint")
    )
    placed = points.filter(F.col(x).isNotNull() & F.col(y).isNotNull()).select(id_column, cell.alias("node"))
    labelled = keyed_join(placed, parts, ["node"], "left").withColumn("component", F.coalesce("component", "node"))
    names = labelled.groupBy("component").agg(F.min(id_column).alias("cluster"))
    return keyed_join(labelled, names, ["component"], "inner").select(id_column, "cluster")


def in_clusters(
    points: DataFrame, id_column: str, x: str, y: str,
    members: DataFrame, members_x: str, members_y: str, cluster: str, reach: float,
) -> DataFrame:
    """Points inside the union of circles around cluster members: (id, cluster), one row per
    point, because two circles that share a point belong to one cluster."""
    side = side_of(reach)
    left = written(locations(points, x, y, side))
    labelled = members.groupBy(F.col(members_x).cast("double").alias("x"), F.col(members_y).cast("double").alias("y")).agg(
        F.min(cluster).alias(cluster)
    )
    right_places = locations(members, members_x, members_y, side)
    right = written(right_places.join(labelled, ["x", "y"]))
    pairs = written(cell_pairs(left, right, reach))
    sure, leaves = refined(left, right, pairs, reach)
    whole = pairs.filter("verdict = 'all'").select(F.lit(0).alias("level"), *A_CELL, *B_CELL, "n_b").unionAll(sure)
    # Members of one cell are near each other, so any of them names the cell's cluster.
    cell_cluster = right.groupBy(F.col("cx").alias("rbx"), F.col("cy").alias("rby")).agg(F.min(cluster).alias(cluster))
    named = lambda df: df.withColumns(dict(zip(("rax", "ray", "rbx", "rby"), _roots()))).join(cell_cluster, ["rbx", "rby"])
    by_box = written(named(whole).groupBy("level", *A_CELL).agg(F.min(cluster).alias(cluster)))
    of_boxes = _in_boxes(left.drop(cluster), by_box, "a").select("x", "y", cluster)
    of_places = named(_place_pairs(left, right, leaves, reach)).select(F.col("xa").alias("x"), F.col("ya").alias("y"), cluster)
    placed = of_boxes.unionAll(of_places).groupBy(F.col("x").alias("_px"), F.col("y").alias("_py")).agg(F.min(cluster).alias(cluster))
    keyed = points.withColumns({"_px": F.col(x).cast("double"), "_py": F.col(y).cast("double")})
    return keyed_join(keyed, placed, ["_px", "_py"], "inner").select(id_column, cluster)
