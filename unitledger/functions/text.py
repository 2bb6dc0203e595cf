"""Column expressions for identifiers, codes and free text."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Code lists that come with the registry's documentation.
MARKET_FUNCTIONS = {
    1: "Stromnetzbetreiber",
    2: "Anlagenbetreiber",
    3: "Akteur im Strommarkt",
    4: "Organisierter Marktplatz",
    5: "Behörde, Verband, Institution",
    6: "Sonstiger Marktakteur",
    7: "Bundesnetzagentur",
    8: "Gasnetzbetreiber",
    9: "Akteur im Gasmarkt",
    10: "Supportpartner",
}
LOCATION_TYPES = {
    1: "Stromerzeugungslokation",
    2: "Stromverbrauchslokation",
    3: "Gaserzeugungslokation",
    4: "Gasverbrauchslokation",
}

# Widths of digit keys that lose a leading zero in some exports.
KEY_WIDTHS = {"Gemeindeschluessel": 8, "Postleitzahl": 5}

# Short maker names used in turbine class codes.
MAKER_CODES = {
    "Nordex": "N",
    "Adwen/Areva": "AD",
    "Senvion/REpower": "S",
    "Enercon": "E",
    "Siemens": "SWT",
    "Vestas": "V",
    "Vensys": "VS",
    "GE Wind": "GE",
    "Eno": "ENO",
    "aerodyn": "SCD",
}
AW_POWERS = (1500, 3000)
AW_DIAMETERS = (70, 77, 82, 100, 116, 125, 132, 140)
MM_POWERS = (2000, 2050)

# Fixed value: ids of units entered directly (the commas are members of the classes).
DIRECT_ENTRY_IDS = "^[S,G][E,S,V][E,L]"


def literal_map(values: Mapping) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])


def plain_number_text(c: Column) -> Column:
    """`9162000.0` -> `9162000`; text that is no whole number passes unchanged."""
    return F.when(c.rlike(r"^\s*\d+(\.0*)?\s*$"), F.regexp_replace(F.trim(c), r"\.0*$", "")).otherwise(c)


def pad_key(c: Column, width: int) -> Column:
    """Restore one lost leading zero, only where the text is exactly one digit short."""
    text = plain_number_text(c.cast("string"))
    lost = (F.length(text) == width - 1) & text.rlike(r"^\d+$")
    return F.when(lost, F.concat(F.lit("0"), text)).otherwise(text)


def pad_known_keys(df: DataFrame) -> DataFrame:
    return df.withColumns({n: pad_key(F.col(n), w) for n, w in KEY_WIDTHS.items() if n in df.columns})


def code_to_text(c: Column, catalog: Mapping) -> Column:
    """Catalog text where the code is known, the value itself otherwise."""
    return F.coalesce(literal_map({str(k): v for k, v in catalog.items()})[c.cast("string")], c.cast("string"))


def code_list(c: Column) -> Column:
    """`"1, 2,,x"` -> `[1, 2]` as bigint codes."""
    parts = F.transform(F.split(c, ","), lambda x: F.trim(x).try_cast("double").try_cast("bigint"))
    return F.filter(parts, lambda x: x.isNotNull())


def decode_list(c: Column, catalog: Column) -> Column:
    """Decode a comma separated code list; unknown codes drop out, nothing left gives NULL.

    A single code is a list of one, for which an unknown code gives NULL.
    """
    names = F.transform(code_list(c), lambda x: F.try_element_at(catalog, x))
    return F.nullif(F.array_join(F.filter(names, lambda x: x.isNotNull()), ","), F.lit(""))


def digits_or_null(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, r"[^0-9]", ""), F.lit(""))


def coordinate(c: Column) -> Column:
    """Number left in a free-text coordinate after everything but `-0-9.` is removed."""
    return F.nullif(F.regexp_replace(c, r"[^-0-9.]+", ""), F.lit("")).try_cast("double")


def coordinate_without_letters(c: Column) -> Column:
    return F.nullif(F.regexp_replace(c, r"[A-Za-z]+", ""), F.lit("")).try_cast("double")


def strip_carriage_returns(df: DataFrame, columns=("Aktenzeichen", "Behoerde")) -> DataFrame:
    return df.withColumns({n: F.replace(F.col(n), F.lit("\r"), F.lit("")) for n in columns if n in df.columns})


def append_comment(comment: Column, text: str, where: Column) -> Column:
    """Append to the audit comment; a comment nothing was ever added to is empty text.

    The comment appears once in the expression, so long chains stay small.
    """
    return F.concat_ws("", comment, F.when(where, F.lit(text)))


def null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def full_name(first: Column, second: Column) -> Column:
    return F.concat(F.coalesce(first, F.lit("")), F.coalesce(second, F.lit("")))


def turbine_class(maker: Column, power: Column, diameter: Column) -> Column:
    """`<maker code>-<diameter>_<power>`; two makers use another code for some sizes."""
    whole_power, whole_diameter = power.cast("int"), diameter.cast("int")
    is_aw = (maker == "Nordex") & whole_power.isin(*AW_POWERS) & whole_diameter.isin(*AW_DIAMETERS)
    is_mm = (maker == "Senvion/REpower") & whole_power.isin(*MM_POWERS)
    code = (
        F.when(is_aw, F.lit("AW"))
        .when(is_mm, F.lit("MM"))
        .otherwise(F.coalesce(literal_map(MAKER_CODES)[maker], F.lit("")))
    )
    return F.concat(code, F.lit("-"), diameter.cast("string"), F.lit("_"), whole_power.cast("string"))


def relabel(c: Column, names: Mapping[str, str]) -> Column:
    return F.coalesce(literal_map(names)[c], c)
