"""One wide snapshot per unit type: basic rows joined with unit, subsidy, CHP and permit detail."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.operators.skew import keyed_join

# Columns that get a suffix in the joined export, by role of their table.
SUFFIXED = {
    "basic": ["BestandsanlageMastrNummer"],
    "extended": [
        "EinheitMastrNummer",
        "EegMastrNummer",
        "KwkMastrNummer",
        "GenMastrNummer",
        "SpeMastrNummer",
        "EinheitBetriebsstatus",
        "NichtVorhandenInMigriertenEinheiten",
        "Bruttoleistung",
    ],
    "eeg": ["EegMastrNummer", "DatumLetzteAktualisierung", "Meldedatum"],
    "kwk": [
        "KwkMastrNummer",
        "Meldedatum",
        "Inbetriebnahmedatum",
        "DatumLetzteAktualisierung",
        "AnlageBetriebsstatus",
        "VerknuepfteEinheiten",
        "AusschreibungZuschlag",
    ],
    "permit": ["GenMastrNummer", "DatumLetzteAktualisierung", "Meldedatum"],
}

# The key that links a basic unit to each role.
ROLE_KEYS = {
    "extended": "EinheitMastrNummer",
    "eeg": "EegMastrNummer",
    "kwk": "KwkMastrNummer",
    "permit": "GenMastrNummer",
}


def suffixed(df: DataFrame, columns: Sequence[str], suffix: str) -> DataFrame:
    """Add the suffix to the listed columns only."""
    return df.withColumnsRenamed({c: f"{c}_{suffix}" for c in columns if c in df.columns})


def numbered_repeats(names: Sequence[str]) -> list[str]:
    """Output names without repeats: the n-th repeat of a name becomes `name_<n>`."""
    seen: dict[str, int] = {}
    out = []
    for name in names:
        repeat = seen.get(name, 0)
        seen[name] = repeat + 1
        out.append(f"{name}_{repeat}" if repeat else name)
    if len(set(out)) != len(out):
        raise ValueError("column names clash after numbering repeats")
    return out


def left_join_details(
    base: DataFrame,
    details: Sequence[tuple[DataFrame, str, str]],
    split: bool | None = None,
    names: Sequence[str] | None = None,
) -> DataFrame:
    """Left join several detail tables, each on its own key pair `(base key, detail key)`.

    All columns of all tables are kept; repeated names are numbered. Detail tables are unique
    per key; hot and missing keys of the base are spread when a detail table needs a shuffle.
    `names` gives the base columns their output names, which may repeat.
    """
    out_names = list(names or base.columns)
    start_rows = joined = base.toDF(*[f"c{i}" for i in range(len(base.columns))])
    for n, (detail, base_key, detail_key) in enumerate(details):
        key_col = f"c{base.columns.index(base_key)}"
        start = len(out_names)
        positions = {name: f"c{start + i}" for i, name in enumerate(detail.columns)}
        right = detail.select(
            F.col(detail_key).alias(key_col), *[F.col(f"`{c}`").alias(p) for c, p in positions.items()]
        )
        # Left joins with unique keys keep key frequencies, so one column of the base tells them.
        counts = start_rows.groupBy(key_col).agg(F.count(F.lit(1)).alias("_n"))
        joined = keyed_join(joined, right, [key_col], "left", counts=counts, split=split)
        out_names += detail.columns
    order = [f"c{i}" for i in range(len(out_names))]
    return joined.select(*[F.col(c).alias(n) for c, n in zip(order, numbered_repeats(out_names))])


def technology_snapshot(
    basic: DataFrame,
    details: Mapping[str, DataFrame],
    unit_type: str,
    limit: int | None = None,
) -> DataFrame:
    """Basic units of one type left joined with their detail tables by role.

    The type filter comes before the joins, so only units of that type are shuffled; a limit
    takes the first units by key, so the result is the same on every run.
    """
    units = first_units(basic.filter(F.col("Einheittyp") == unit_type), limit)
    return left_join_details(suffixed(units, SUFFIXED["basic"], "basic"), _sides(details))


def snapshot_from_extended(
    extended: DataFrame,
    details: Mapping[str, DataFrame],
    unit_type: str,
    basic_columns: Sequence[str],
    limit: int | None = None,
) -> DataFrame:
    """The same snapshot where the basic rows come from the unit table itself.

    Both share the unique unit key, so the basic columns are a projection of the unit row and
    the widest join falls away.
    """
    units = first_units(extended, limit)
    basic = {
        c: F.lit(unit_type) if c == "Einheittyp" else F.col(c) if c in units.columns else F.lit(None).cast("string")
        for c in basic_columns
    }
    # Positional names keep both copies apart until the repeats are numbered.
    copies = {f"_b{i}": value for i, value in enumerate(basic.values())}
    wide = units.select(*[v.alias(k) for k, v in copies.items()], *units.columns)
    names = [f"{c}_basic" if c in SUFFIXED["basic"] else c for c in basic_columns]
    names += [f"{c}_extended" if c in SUFFIXED["extended"] else c for c in units.columns]
    sides = [(detail, f"_b{list(basic_columns).index(key)}", name) for detail, key, name in _sides(details)]
    return left_join_details(wide, sides, names=names)


def first_units(units: DataFrame, limit: int | None) -> DataFrame:
    return units.orderBy("EinheitMastrNummer").limit(limit) if limit else units


def _sides(details: Mapping[str, DataFrame]) -> list[tuple[DataFrame, str, str]]:
    return [
        (suffixed(details[role], SUFFIXED[role], role), key, f"{key}_{role}")
        for role, key in ROLE_KEYS.items()
        if role in details
    ]


def matching_columns(df: DataFrame, target_columns: Sequence[str], **literals: Column) -> DataFrame:
    """The columns of `df` that the target has too, plus literal columns."""
    shared = [c for c in df.columns if c in target_columns and c not in literals]
    return df.select(*shared, *[v.alias(k) for k, v in literals.items()])


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """Union of tables with differing columns; missing ones become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def reverse_fill(units_by_type: Mapping[str, DataFrame], target_columns: Sequence[str], type_column: str) -> DataFrame:
    """Rebuild the basic table from the per-type unit tables with the type as a literal."""
    parts = [matching_columns(df, target_columns, **{type_column: F.lit(name)}) for name, df in units_by_type.items()]
    filled = union_by_name(parts)
    missing = [c for c in target_columns if c not in filled.columns]
    return filled.withColumns({c: F.lit(None).cast("string") for c in missing}).select(*target_columns)


def translate_columns(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    """Rename columns by a dictionary. A rename that would hit an existing or already used
    name is skipped, because the dictionary is not one-to-one."""
    taken = set(df.columns)
    renames = {}
    for name in df.columns:
        new = names.get(name)
        if new and new not in taken:
            renames[name] = new
            taken.add(new)
    return df.withColumnsRenamed(renames)
