"""Position cleansing of unit tables: tags, containment, postcode fallback, matching."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.functions import geo, nested, text
from unitledger.operators import spatial
from unitledger.operators.skew import keyed_join, written


@dataclass(frozen=True)
class Boundaries:
    """Edge tables (see `ring_edges`) in degrees and the grid cell to index each with."""

    country: DataFrame
    postcodes: DataFrame
    offshore: DataFrame | None = None
    country_cell: float = 0.25
    postcode_cell: float = 0.05
    offshore_cell: float = 0.25


# Texts of the source and the tag values they stand for.
LOCATION_TAGS = {"WindAnLand": "onshore", "WindAufSee": "offshore"}
STATUS_TAGS = {
    "InBetrieb": "operating",
    "InPlanung": "planned",
    "DauerhaftStillgelegt": "shutdown",
    "VoruebergehendStillgelegt": "shutdown",
}
CAPACITY_LIMIT_KW = 9500


def _flag_inside(units: DataFrame, edges: DataFrame, x: str, y: str, cell: float, flag: str, where: Column) -> DataFrame:
    """A never-NULL column telling whether the position lies in any region."""
    found = spatial.located(units, edges, x, y, cell, name="_found")
    return found.withColumn(flag, where & (F.size("_found") > 0)).drop("_found")


def _postcode_points(units: DataFrame, points: DataFrame, postcode: Column, lon: str, lat: str) -> DataFrame:
    """Attach the point of a postcode area as `lon`/`lat`; unknown postcodes give NULL."""
    named = points.select(F.col("region_id").alias("_plz"), F.col("point_x").alias(lon), F.col("point_y").alias(lat))
    keyed = units.withColumn("_plz", postcode)
    return keyed_join(keyed, named, ["_plz"], "left").select(*units.columns, lon, lat)


def _address_postcode() -> Column:
    """The digits of the address where they make up one postcode."""
    digits = text.digits_or_null(F.col("Standort"))
    return F.when(F.length(digits) == 5, digits)


@dataclass(frozen=True)
class ShortSteps:
    """Which steps the short chain takes besides the checks of position and postcode."""

    mark_missing: bool = False  # units without a position say so in their comment
    address_step: bool = False  # a postcode in the address helps where the postcode column does not
    drop_unlocated: bool = False  # units left without a position go


# The published scripts by technology.
SHORT_STEPS = {
    "solar": ShortSteps(),
    "hydro": ShortSteps(),
    "biomass": ShortSteps(drop_unlocated=True),
    "combustion": ShortSteps(mark_missing=True, address_step=True, drop_unlocated=True),
}


def short_cleansing(units: DataFrame, bounds: Boundaries, technology: str, strict: bool = True) -> DataFrame:
    """Keep a position, or take the centre of the postcode area, as the technology's steps say.

    `strict` keeps positions outside the country unless a row's comment history says the
    position was made earlier, as the published scripts do; `strict=False` removes them.
    """
    steps = SHORT_STEPS[technology]
    has = F.col("Laengengrad").isNotNull() & F.col("Breitengrad").isNotNull()
    comment = F.col("comment") if "comment" in units.columns else F.lit(None).cast("string")
    comment = text.append_comment(comment, "has_geom; ", has)
    if steps.mark_missing:
        comment = text.append_comment(comment, "no_geom; ", ~has)
    units = _flag_inside(
        units.withColumn("comment", comment), bounds.country, "Laengengrad", "Breitengrad", bounds.country_cell, "_inside", F.lit(True)
    )
    units = units.withColumn("comment", text.append_comment(F.col("comment"), "inside_vg250; ", F.col("_inside")))
    outside = F.col("comment") == "make_geom; has_geom; " if strict else has & ~F.col("_inside")
    units = units.withColumn("_outside", F.coalesce(outside, F.lit(False))).withColumns(
        {
            "comment": text.append_comment(F.col("comment"), "outside_vg250; remove_geom; ", F.col("_outside")),
            "Laengengrad": F.when(~F.col("_outside"), F.col("Laengengrad")),
            "Breitengrad": F.when(~F.col("_outside"), F.col("Breitengrad")),
        }
    ).drop("_inside", "_outside")
    centres = written(
        spatial.polygon_centres(bounds.postcodes).withColumnsRenamed({"centre_x": "point_x", "centre_y": "point_y"})
    )
    sources = [("make_geom_plz; ", F.col("Postleitzahl"))]
    if steps.address_step:
        sources.append(("make_geom_standort_plz; ", _address_postcode()))
    for mark, postcode in sources:
        placed = _postcode_points(units, centres, postcode, "_lon", "_lat")
        bare = ~has & F.col("_lon").isNotNull()
        # One select, so that every expression sees the position as it was before.
        units = placed.withColumns(
            {
                "comment": text.append_comment(F.col("comment"), mark, bare),
                "Laengengrad": F.when(bare, F.col("_lon")).otherwise(F.col("Laengengrad")),
                "Breitengrad": F.when(bare, F.col("_lat")).otherwise(F.col("Breitengrad")),
            }
        ).drop("_lon", "_lat")
    units = units.withColumn("comment", text.null_if_empty(F.col("comment")))
    return units.filter(has) if steps.drop_unlocated else units


def wind_tags(units: DataFrame) -> DataFrame:
    """First tags of a wind unit and the capacity correction."""
    tags = F.create_map(F.lit("processed"), F.lit("true"))
    place, unit, status = F.col("Lage"), F.left("EinheitMastrNummer", F.lit(3)), F.col("EinheitBetriebsstatus")
    for source, value in LOCATION_TAGS.items():
        tags = nested.merge_tags(tags, {"location": value}, place == source)
    tags = nested.merge_tags(tags, {"location": "na"}, place.isNull())
    for prefix in ("SME", "SEE"):
        tags = nested.merge_tags(tags, {"einheit": prefix}, unit == prefix)
    for flag in ("A", "B"):
        tags = nested.merge_tags(tags, {"flag": flag}, F.col("StatisikFlag") == flag)
    for source, value in STATUS_TAGS.items():
        tags = nested.merge_tags(tags, {"status": value}, status == source)
    too_big = F.col("Bruttoleistung") > CAPACITY_LIMIT_KW
    tags = nested.merge_tags(tags, {"capacity": "reduce/10"}, too_big)
    tags = nested.merge_tags(tags, {"geom": "false"}, F.col("Laengengrad").isNull() | F.col("Breitengrad").isNull())
    power = F.when(too_big, F.col("Bruttoleistung") / 10).otherwise(F.col("Bruttoleistung"))
    return units.withColumns({"tags": tags, "Bruttoleistung": power})


def wind_cleansing(units: DataFrame, bounds: Boundaries, strict: bool = True) -> DataFrame:
    """Tag, locate and check wind units. Adds `tags`, `comment`, the position in degrees
    (`lon`, `lat`) and in EPSG:3035 metres (`x_3035`, `y_3035`).

    `strict` reproduces the published scripts, whose removal of outside positions never
    matches a row; `strict=False` removes onshore positions outside the country and offshore
    ones outside the zone.
    """
    if "comment" not in units.columns:
        units = units.withColumn("comment", F.lit(None).cast("string"))
    units = wind_tags(units).withColumns({"lon": F.col("Laengengrad"), "lat": F.col("Breitengrad")})
    units = units.withColumn("lat", F.when(F.col("lon").isNotNull(), F.col("lat")))
    units = units.withColumn("lon", F.when(F.col("lat").isNotNull(), F.col("lon")))
    onshore = F.coalesce(nested.tag(F.col("tags"), "location") == "onshore", F.lit(False))
    offshore = F.coalesce(nested.tag(F.col("tags"), "location") == "offshore", F.lit(False))
    placed = F.col("lon").isNotNull()

    units = _flag_inside(units, bounds.country, "lon", "lat", bounds.country_cell, "_in", onshore)
    tags = nested.merge_tags(F.col("tags"), {"inside_germany": "true"}, F.col("_in"))
    tags = nested.merge_tags(tags, {"inside_germany": "false"}, ~F.col("_in"))
    units = units.withColumns({"comment": text.append_comment(F.col("comment"), "onshore_inside; ", F.col("_in")), "tags": tags})
    units = _remove_outside(units, onshore & ~F.col("_in"), strict)

    points = written(spatial.surface_points(bounds.postcodes))
    units = _postcode_points(units, points, F.col("Postleitzahl"), "_lon1", "_lat1")
    units = _postcode_points(units, points, _address_postcode(), "_lon2", "_lat2")
    first = ~placed & onshore & F.col("_lon1").isNotNull()
    second = ~placed & onshore & F.col("_lon1").isNull() & F.col("_lon2").isNotNull()
    guessed = {"geom": "true", "inside_germany": "true"}
    tags = nested.merge_tags(F.col("tags"), {**guessed, "geom_guess": "plz"}, first)
    tags = nested.merge_tags(tags, {**guessed, "geom_guess": "standort_plz"}, second)
    comment = text.append_comment(F.col("comment"), "onshore_fix_plz; ", first)
    units = units.withColumns(
        {
            "comment": text.append_comment(comment, "onshore_fix_plz2; ", second),
            "tags": tags,
            "lon": F.when(first, F.col("_lon1")).when(second, F.col("_lon2")).otherwise(F.col("lon")),
            "lat": F.when(first, F.col("_lat1")).when(second, F.col("_lat2")).otherwise(F.col("lat")),
        }
    ).drop("_lon1", "_lat1", "_lon2", "_lat2", "_in")

    if bounds.offshore is not None:
        units = _flag_inside(units, bounds.offshore, "lon", "lat", bounds.offshore_cell, "_sea", offshore)
        units = units.withColumns(
            {
                "comment": text.append_comment(F.col("comment"), "offshore_inside; ", F.col("_sea")),
                "tags": nested.merge_tags(F.col("tags"), {"inside_germany": "true"}, F.col("_sea")),
            }
        )
        units = _remove_outside(units, offshore & ~F.col("_sea"), strict).drop("_sea")

    tags = nested.merge_tags(F.col("tags"), {**guessed, "geom_guess": "somewhere"}, ~placed)
    units = units.withColumns(
        {
            "comment": text.append_comment(F.col("comment"), "guess_geom; ", ~placed),
            "tags": tags,
            "lon": F.coalesce("lon", F.lit(geo.FALLBACK_LON)),
            "lat": F.coalesce("lat", F.lit(geo.FALLBACK_LAT)),
        }
    )
    checked = spatial.in_declared_region(
        units, bounds.postcodes, "lon", "lat", bounds.postcode_cell, "Postleitzahl", name="_own"
    )
    own = (onshore & F.col("_own")).cast("string")
    tags = F.map_concat("tags", F.create_map(F.lit("plz_check"), own))
    x, y = geo.to_laea(F.col("lon"), F.col("lat"))
    comment = text.null_if_empty(F.col("comment"))
    return checked.withColumns({"tags": tags, "comment": comment, "x_3035": x, "y_3035": y}).drop("_own")


def _remove_outside(units: DataFrame, outside: Column, strict: bool) -> DataFrame:
    remove = outside & (nested.tag_is_true(F.col("tags"), "geom") if strict else F.col("lon").isNotNull())
    return units.withColumn("_remove", remove).withColumns(
        {
            "tags": nested.merge_tags(F.col("tags"), {"geom": "false", "geom_remove": "true"}, F.col("_remove")),
            "lon": F.when(~F.col("_remove"), F.col("lon")),
            "lat": F.when(~F.col("_remove"), F.col("lat")),
        }
    ).drop("_remove")


def match_external(
    units: DataFrame,
    external: DataFrame,
    key: str = "EinheitMastrNummer",
    external_key: str = "osm_id",
    reach: float = 25.0,
) -> tuple[DataFrame, DataFrame]:
    """Compare cleansed units with points of another map (both in `x_3035`, `y_3035`).

    Circles around the external points merge to clusters. Units inside one get its id as
    `osm_id`, the tags `in_osm` and `match_osm` and a comment; every unit gets the size of its
    own cluster as `mastr_buffer_cnt`. Returns the units and the table of external clusters
    with unit count, unit capacity and external count.
    """
    units, external = written(units), written(external)
    groups = written(spatial.clusters(external, external_key, "x_3035", "y_3035", reach))
    members = keyed_join(external.select(external_key, "x_3035", "y_3035"), groups, [external_key], "inner")
    inside = written(
        spatial.in_clusters(
            units.select(key, "x_3035", "y_3035"), key, "x_3035", "y_3035", members, "x_3035", "y_3035", "cluster", reach
        )
    )
    unit_sums = (
        keyed_join(inside, units.select(key, "Bruttoleistung"), [key], "inner")
        .groupBy("cluster")
        .agg(F.sum("Bruttoleistung").alias("mastr_sum"), F.count(F.lit(1)).alias("mastr_count"))
    )
    table = groups.groupBy("cluster").agg(F.count(F.lit(1)).alias("osm_count")).join(unit_sums, "cluster", "left")

    own = written(spatial.clusters(units.select(key, "x_3035", "y_3035"), key, "x_3035", "y_3035", reach))
    sizes = own.groupBy("cluster").agg(F.count(F.lit(1)).alias("mastr_buffer_cnt"))
    own_size = keyed_join(own, sizes, ["cluster"], "inner").drop("cluster")

    matched = keyed_join(units, inside.withColumnRenamed("cluster", "osm_id"), [key], "left")
    matched = keyed_join(matched, own_size, [key], "left")
    hit = F.col("osm_id").isNotNull()
    tags = nested.merge_tags(F.col("tags"), {"in_osm": "true", "match_osm": "true"}, hit)
    return (
        matched.withColumns({"comment": text.append_comment(F.col("comment"), "match_osm; ", hit), "tags": tags}),
        table,
    )


def flag_b_units(units: DataFrame) -> DataFrame:
    """The reduced copy: operating units with flag B."""
    return units.filter((F.col("StatisikFlag") == "B") & (F.col("EinheitBetriebsstatus") == "InBetrieb"))
