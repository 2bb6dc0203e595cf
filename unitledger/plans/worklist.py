"""Manual validation: which units to look at, what lies around them, and the labels given."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from unitledger.functions import geo
from unitledger.operators.relational import update_by_key
from unitledger.operators.skew import written
from unitledger.operators.spatial import neighbours_of

# Labels per technology.
LABELS = {
    "solar": ["manval_location", "manval_size", "manval_orientation"],
    "wind": ["manval_location"],
    "biomass": ["manval_location"],
}


def add_relevance(units: DataFrame, technology: str) -> DataFrame:
    """Located units in operation are relevant, wind units only on land; others stay NULL."""
    relevant = (
        F.col("Laengengrad").isNotNull()
        & F.col("Breitengrad").isNotNull()
        & (F.col("EinheitBetriebsstatus") == "In Betrieb")
    )
    if technology == "wind":
        relevant = relevant & (F.col("Lage") == "Windkraft an Land")
    labels = [c for c in LABELS[technology] if c not in units.columns]
    return units.withColumns(
        {"manval_relevant": F.when(relevant, F.lit(True)), **{c: F.lit(None).cast("int") for c in labels}}
    )


def pick_random(units: DataFrame, count: int = 1, seed: int | None = None, key: str = "EinheitMastrNummer") -> DataFrame:
    """A random choice of relevant units (top-k by a random number, no full sort).

    With a seed the choice depends on the seed and the keys alone, however the rows lie.
    """
    if seed is None:
        order = [F.rand()]
    else:
        order = [F.md5(F.concat(F.col(key).cast("string"), F.lit(f"-{seed}"))), F.col(key)]
    return units.filter("manval_relevant").orderBy(*order).limit(count)


def validation_round(
    units: DataFrame, others: DataFrame, technology: str, reach: float, count: int = 1, seed: int | None = None, key: str = "EinheitMastrNummer"
) -> tuple[DataFrame, DataFrame]:
    """One round of the worklist: picked relevant units with outlines, and the other units near them."""
    picked = written(pick_random(add_relevance(units, technology), count, seed, key))
    near = neighbours_of(others, picked, key, "Laengengrad", "Breitengrad", reach)
    return with_outlines(picked), near


def with_outlines(units: DataFrame, rotor_radius: float = 50.0) -> DataFrame:
    """Estimated panel square and an octagon around each unit."""
    lon, lat = F.col("Laengengrad"), F.col("Breitengrad")
    return units.withColumns(
        {"panel": geo.panel_box(lon, lat, F.col("Bruttoleistung")), "octagon": geo.octagon(lon, lat, F.lit(rotor_radius))}
    )


def labelled(units: DataFrame, technology: str, key: str = "EinheitMastrNummer") -> DataFrame:
    """The rows of the label export."""
    return units.filter("manval_relevant and manval_location is not null").select(key, *LABELS[technology])


def write_labels(units: DataFrame, technology: str, path: str, key: str = "EinheitMastrNummer") -> None:
    """The label export as CSV with a header."""
    labelled(units, technology, key).write.mode("overwrite").csv(path, header=True)


def import_labels(units: DataFrame, labels: DataFrame, technology: str, key: str = "EinheitMastrNummer") -> DataFrame:
    return update_by_key(units, labels, key, LABELS[technology])
