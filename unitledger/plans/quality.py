"""Reports on registry quality that a user calls as a whole."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.operators import profile, relational
from unitledger.operators.skew import first_per_key, keyed_join
from unitledger.operators.snapshot import union_by_name
from unitledger.operators.spatial import in_declared_region, join_regions


def mismatch_totals(flagged: DataFrame, key: str) -> DataFrame:
    """Mismatches per key and their share of all rows.

    The total is summed over the per-key rows, so the table is read once.
    """
    per_key = flagged.groupBy(key).agg(F.count_if("mismatch").alias("mismatches"), F.count(F.lit(1)).alias("n"))
    total = per_key.agg(F.sum("n")).scalar()
    return per_key.select(key, "mismatches", (F.col("mismatches") / total).alias("share"))


def completeness_report(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Filled percentage of every column of every table, one scan per table."""
    return union_by_name([profile.completeness(df).withColumn("table_name", F.lit(name)) for name, df in tables.items()])


def region_mismatch(
    units: DataFrame,
    edges: DataFrame,
    declared: str,
    x: str,
    y: str,
    cell: float,
    buffer: float = 0.015,
) -> DataFrame:
    """One row per located unit: does its position lie in (or near) its declared region?

    A unit that touches several buffered regions counts as right if one of them matches; a
    unit in no region is a mismatch.
    """
    placed = units.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    checked = in_declared_region(placed, edges, x, y, cell, declared, buffer, "mismatch")
    return checked.withColumn("mismatch", ~F.col("mismatch"))


# The grid operator's check has passed; a wind unit stands on land.
CHECKED = ("NetzbetreiberpruefungStatus", "1")
ON_LAND = ("Lage", "Windkraft an Land")


def comparable_units(
    units: DataFrame, technology: str, required: Sequence[str] = ("Laengengrad", "Landkreis", "Gemeinde"), checked: bool = False
) -> DataFrame:
    """Units whose position can be compared with a declared region: nothing required is NULL, wind
    units stand on land, and with `checked` the grid operator has confirmed the unit. NULL is
    neither on land nor confirmed."""
    kept = units.dropna(subset=list(required))
    if checked:
        kept = kept.filter(F.col(CHECKED[0]) == CHECKED[1])
    if technology.partition("_")[0] == "wind":
        kept = kept.filter(F.col(ON_LAND[0]) == ON_LAND[1])
    return kept


def mismatch_report(
    units_by_technology: Mapping[str, DataFrame],
    edges: DataFrame,
    declared: str,
    x: str,
    y: str,
    cell: float,
    buffer: float = 0.015,
    required: Sequence[str] | None = None,
    checked: bool = False,
) -> DataFrame:
    """Share of mismatching units per technology, one pass over the union of all tables. With
    `required` only comparable units count (see `comparable_units`)."""
    if required is not None:
        units_by_technology = {n: comparable_units(df, n, required, checked) for n, df in units_by_technology.items()}
    units = union_by_name(
        [df.select(declared, x, y).withColumn("technology", F.lit(n)) for n, df in units_by_technology.items()]
    )
    flagged = region_mismatch(units, edges, declared, x, y, cell, buffer)
    return flagged.groupBy("technology").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("mismatch").alias("mismatches"),
        F.avg(F.col("mismatch").cast("int")).alias("share"),
    )


def location_funnel(
    frames: Sequence[DataFrame],
    edges: DataFrame,
    stamp: str,
    state: str,
    x: str,
    y: str,
    cell: float,
    buffer: float = 0.01,
) -> DataFrame:
    """Rows left after each cleaning step: all, duplicated, unique, unlocated, located,
    without state, with right state, with wrong state."""
    everything = union_by_name(frames)
    compared = [c for c in everything.columns if c != stamp]
    digests = everything.withColumn("_digest", profile.row_digest(everything, compared))
    sizes = digests.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n"))
    counts = sizes.agg(
        F.sum("_n").alias("all"), F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(0)).alias("duplicated")
    )
    unique = profile.unique_rows(everything, [F.col(stamp)], ignore=[stamp])
    judged = in_declared_region(unique, edges, x, y, cell, state, buffer, "_right")
    located = F.col(x).isNotNull() & F.col(y).isNotNull()
    with_state = located & F.col(state).isNotNull()
    rest = profile.funnel_flags(
        judged,
        {
            "unique": F.lit(True),
            "unlocated": ~located,
            "located": located,
            "no_state": located & F.col(state).isNull(),
            "right_state": with_state & F.col("_right"),
            "wrong_state": with_state & ~F.col("_right"),
        },
    )
    return counts.unpivot([], ["all", "duplicated"], "name", "n").unionByName(rest)


def compare_registers(ours: DataFrame, theirs: DataFrame, key: str, category: str) -> DataFrame:
    """Keys only in one register, in both, only in the other, per category and in total."""
    tagged = ours.select(key, category, F.lit(True).alias("a"), F.lit(False).alias("b")).unionByName(
        theirs.select(key, category, F.lit(False).alias("a"), F.lit(True).alias("b"))
    )
    members = tagged.filter(F.col(key).isNotNull()).groupBy(key, category).agg(F.bool_or("a").alias("a"), F.bool_or("b").alias("b"))
    return profile.overlap_totals(members, category, "a", "b")


def supplement_positions(
    unlocated: DataFrame, source: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column]
) -> tuple[DataFrame, DataFrame]:
    """Take positions from another register by shared plant key; returns (found, still missing)."""
    usable = source.dropna(subset=[key, *columns])
    found = relational.supplement_by_key(unlocated.filter(F.col(key).isNotNull()), usable, key, columns, order)
    keys = usable.select(key).distinct().withColumn("_known", F.lit(True))
    missing = keyed_join(unlocated, keys, [key], "left").filter(F.col("_known").isNull()).select(*unlocated.columns)
    return found, missing


def supplement_funnel(
    unlocated: DataFrame, source: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Counts of the coordinate supplement: rows without position, shared keys, rows found, rows left."""
    found, missing = supplement_positions(unlocated, source, key, columns, order)
    usable = source.dropna(subset=[key, *columns])
    shared = unlocated.select(key).filter(F.col(key).isNotNull()).intersect(usable.select(key))
    return profile.funnel([("unlocated", unlocated), ("shared_keys", shared), ("found", found), ("missing", missing)])


def migration_candidates(
    units: DataFrame, id_column: str, stamp: str, keys: Sequence[str], cut: str = "2019-01-31", strict: bool = False
) -> DataFrame:
    """Units entered twice: migrated ids up to the cut date against new ids after it, equal keys."""
    when = F.col(stamp).cast("timestamp")
    limit = F.lit(cut).cast("timestamp")
    is_old = F.col(id_column).contains("SME") & (when <= limit)
    is_new = F.col(id_column).contains("SEE") & (when > limit)
    return relational.duplicate_candidates(units.filter(F.col(stamp).isNotNull()), keys, id_column, is_old, is_new, strict)


def region_totals(
    units: DataFrame, regions: DataFrame, edges: DataFrame, x: str, y: str, value: str, cell: float, prefix: str | None = None
) -> DataFrame:
    """Number and capacity of units per region; regions without units keep NULL.

    `prefix` keeps only regions whose key starts with it, so only their edges are spread.
    """
    if prefix is not None:
        regions = regions.filter(F.substring("region_id", 1, len(prefix)) == prefix)
        edges = edges.filter(F.substring("region_id", 1, len(prefix)) == prefix)
    placed = join_regions(units, edges, x, y, cell)
    return relational.join_back(
        regions, placed, "region_id", {"units": F.count(F.lit(1)), "capacity": F.round(F.sum(value), 2)}
    )


#: Lengths of the key prefixes that name the upper levels of an eight-digit municipality key.
LEVELS = {"state": 2, "district": 5, "municipality": 8}


def region_level_totals(
    units: DataFrame, edges: DataFrame, x: str, y: str, value: str, cell: float, levels: Mapping[str, int] | None = None
) -> DataFrame:
    """Number and capacity of units per region on all levels of its key, from one containment pass.

    `edges` are those of the lowest level, with text keys (`region_id`) whose prefixes name the
    upper ones; regions of a layer do not overlap. One rollup over the prefixes gives all levels.
    Regions without units stay with NULL on every level, so a state whose municipalities are all
    empty is there too. Rows: level, region_id, units, capacity.
    """
    levels = levels or LEVELS
    names, lengths = list(levels), list(levels.values())
    prefixes = [F.substring("region_id", 1, n).alias(name) for name, n in levels.items()]
    placed = join_regions(units, edges, x, y, cell).select(*prefixes, F.col(value).alias("_value"))
    totals = placed.rollup(*names).agg(
        F.count(F.lit(1)).alias("units"), F.round(F.sum("_value"), 2).alias("capacity"), F.grouping_id().alias("_missing")
    )
    # The number of upper prefixes that a row has, and the longest of them.
    depth = F.lit(len(names)) - F.bit_count("_missing")
    rows = totals.filter(depth > 0).select(
        F.element_at(F.array(*[F.lit(n) for n in names]), depth.cast("int")).alias("level"),
        F.element_at(F.array(*names), depth.cast("int")).alias("region_id"),
        "units",
        "capacity",
    )
    own = F.array(*[F.struct(F.lit(n).alias("level"), F.substring("region_id", 1, k).alias("region_id")) for n, k in zip(names, lengths)])
    known = edges.select("region_id").distinct().select(F.inline(own)).distinct()
    return known.join(rows, ["level", "region_id"], "left")


def newest_first(df: DataFrame, key: str, stamp: str) -> DataFrame:
    return first_per_key(df, [key], [F.desc_nulls_last(stamp)])
