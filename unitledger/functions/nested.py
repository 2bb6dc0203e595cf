"""Flattening of nested replies and the tag document of a unit."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Columns that arrive as {Wert, ...} structs.
VALUE_STRUCTS = [
    "Hausnummer",
    "Kraftwerksnummer",
    "Weic",
    "WeitereBrennstoffe",
    "WeitererHauptbrennstoff",
    "AnlagenkennzifferAnlagenregister",
    "VerhaeltnisErtragsschaetzungReferenzertrag",
    "VerhaeltnisReferenzertragErtrag10Jahre",
    "VerhaeltnisReferenzertragErtrag15Jahre",
    "VerhaeltnisReferenzertragErtrag5Jahre",
    "RegistrierungsnummerPvMeldeportal",
    "BiogasGaserzeugungskapazitaet",
    "BiomethanErstmaligerEinsatz",
    "Frist",
    "WasserrechtAblaufdatum",
]
# Linked-entity arrays and the field holding the id.
LINKED_ARRAYS = {
    "VerknuepfteEinheit": "MaStRNummer",
    "VerknuepfteEinheiten": "MaStRNummer",
    "Netzanschlusspunkte": "NetzanschlusspunktMastrNummer",
}
# Plain lists that become comma separated text.
PLAIN_LISTS = ["ArtDerFlaeche", "WeitereBrennstoffe", "VerknuepfteErzeugungseinheiten"]


def joined_ids(array: Column, field: str) -> Column:
    """Ids of linked entities joined by `", "`; an empty array gives an empty text."""
    return F.array_join(F.transform(array, lambda x: x[field]), ", ")


def joined_list(array: Column) -> Column:
    """A list joined by `","`; an empty one gives NULL."""
    return F.when(F.size(array) > 0, F.array_join(array, ","))


def first_as_text(array: Column) -> Column:
    return F.try_element_at(array, F.lit(1)).cast("string")


def columns_of_arrays(array: Column, fields: Sequence[str]) -> list[Column]:
    """One array column per field of a list of structs."""

    def column(field: str) -> Column:
        return F.transform(array, lambda x: x[field]).alias(field)

    return [column(f) for f in fields]


def sorted_json(c: Column, fields: Sequence[str]) -> Column:
    """JSON text with keys in alphabetical order and NULLs kept."""
    return F.to_json(F.struct(*[c[f].alias(f) for f in sorted(fields)]), {"ignoreNullFields": "false"})


def sorted_json_list(c: Column, fields: Sequence[str]) -> Column:
    ordered = F.transform(c, lambda x: F.struct(*[x[f].alias(f) for f in sorted(fields)]))
    return F.to_json(ordered, {"ignoreNullFields": "false"})


def flatten_reply(df: DataFrame) -> DataFrame:
    """Flatten a table of nested replies to plain columns, driven by the schema alone."""
    kinds = {f.name: f.dataType for f in df.schema}
    new: dict[str, Column] = {}
    for name in VALUE_STRUCTS:
        if isinstance(kinds.get(name), T.StructType):
            new[name] = F.col(name)["Wert"]
            kinds[name] = kinds[name]["Wert"].dataType
    for name, field in LINKED_ARRAYS.items():
        if isinstance(kinds.get(name), T.ArrayType):
            new[name] = joined_ids(F.col(name), field)
    if isinstance(kinds.get("Hersteller"), T.StructType):
        new["HerstellerId"] = F.col("Hersteller")["Id"]
        new["Hersteller"] = F.col("Hersteller")["Wert"]
    for name in PLAIN_LISTS:
        if isinstance(kinds.get(name), T.ArrayType):
            new[name] = joined_list(new.get(name, F.col(name)))
    if isinstance(kinds.get("Ertuechtigung"), T.ArrayType):
        fields = kinds["Ertuechtigung"].elementType.names
        new["Ertuechtigung"] = sorted_json_list(F.col("Ertuechtigung"), fields)
    return df.withColumns(new)


# Tags: a map of text to text, merged with the last value winning.


NO_TAGS = "map<string,string>"


def merge_tags(tags: Column, new: Mapping[str, str], where: Column | None = None) -> Column:
    """Set tags, for rows where the condition holds. The old tags appear once in the
    expression, so long chains stay small."""
    added = F.create_map(*[F.lit(x) for pair in new.items() for x in pair])
    if where is not None:
        added = F.when(where, added).otherwise(F.create_map().cast(NO_TAGS))
    return F.map_concat(tags, added)


def tag(tags: Column, name: str) -> Column:
    return F.try_element_at(tags, F.lit(name))


def tag_is_true(tags: Column, name: str) -> Column:
    return F.coalesce(tag(tags, name).try_cast("boolean"), F.lit(False))


def tags_text(tags: Column) -> Column:
    """One text per distinct document: entries in key order."""
    entries = F.array_sort(F.map_entries(tags))
    return F.array_join(F.transform(entries, lambda e: F.concat(e["key"], F.lit("="), e["value"])), ";")
