"""Decoding of coded columns through the code catalog (`Id`, `Wert`)."""

from __future__ import annotations

import json
from collections.abc import Sequence
from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.functions.text import LOCATION_TYPES, MARKET_FUNCTIONS, code_list, code_to_text
from unitledger.operators.skew import broadcast_limit, keyed_join, written

#: What an entry of the hash table takes besides its text.
_ENTRY_BYTES = 64


def catalog_entries(catalog: DataFrame) -> DataFrame:
    """One text per code: of several the first in text order. Rows without code or text say nothing."""
    return (
        catalog.select(F.col("Id").cast("bigint").alias("_code"), F.col("Wert").cast("string").alias("_text"))
        .dropna()
        .groupBy("_code")
        .agg(F.min("_text").alias("_text"))
    )


def decode_columns(df: DataFrame, catalog: DataFrame, columns: Sequence[str], in_place: bool | None = None) -> DataFrame:
    """Replace codes, single or comma separated, by catalog text in the given columns.

    A catalog below the broadcast threshold travels with the tasks as a hash table and is looked up
    inside each row, so that no row moves; a larger one is joined. Both give the same: texts in the
    order of the codes, unknown codes drop out, nothing left gives NULL. Of several texts of one
    code the first in text order counts. Rows and the order of columns stay as they are; rows may
    repeat and need no key. `in_place` decides the way regardless of size.
    """
    present = [c for c in columns if c in df.columns]
    if not present:
        return df
    entries = catalog_entries(catalog)
    if in_place is None:
        size = entries.agg(F.sum(F.octet_length("_text") + _ENTRY_BYTES)).first()[0] or 0
        in_place = size <= broadcast_limit(df)
    return _looked_up(df, entries, present) if in_place else _joined(df, entries, present)


def _buckets(entries: DataFrame) -> list[list[dict]]:
    """The entries by code modulo a power of two not below their number."""
    rows = entries.collect()  # below the broadcast threshold
    buckets: list[list[dict]] = [[] for _ in range(1 << max(0, len(rows) - 1).bit_length())]
    for row in rows:
        buckets[row["_code"] % len(buckets)].append({"code": row["_code"], "text": row["_text"]})
    return buckets


def _looked_up(df: DataFrame, entries: DataFrame, present: list[str]) -> DataFrame:
    """Codes mapped inside each row. The hash table is one constant of the plan, whatever the
    number of columns."""
    buckets = _buckets(entries)
    table = F.from_json(F.lit(json.dumps(buckets)), "array<array<struct<code:bigint,text:string>>>")

    def texts(codes: Column) -> Column:
        own = F.transform(codes, lambda c: F.filter(F.get(table, F.pmod(c, F.lit(len(buckets))).cast("int")), lambda e: e["code"] == c))
        return F.transform(F.flatten(own), lambda e: e["text"])

    lists = F.array(*[F.coalesce(code_list(F.col(f"`{c}`")), F.array().cast("array<bigint>")) for c in present])
    name = next(n for n in (f"_texts{i}" for i in count()) if n not in df.columns)
    decoded = {c: F.nullif(F.array_join(F.get(F.col(name), F.lit(i)), ","), F.lit("")).alias(c) for i, c in enumerate(present)}
    return df.withColumn(name, F.transform(lists, texts)).select(*[decoded.get(c, F.col(f"`{c}`")) for c in df.columns])


def _joined(df: DataFrame, entries: DataFrame, present: list[str]) -> DataFrame:
    """All codes through one join, whatever the size of the catalog; texts come back to their row."""
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()))
    lists = F.array(*[F.struct(F.lit(i).alias("column"), code_list(F.col(f"`{c}`")).alias("codes")) for i, c in enumerate(present)])
    codes = rows.select("_row", F.inline(lists)).select("_row", "column", F.posexplode("codes").alias("place", "_code"))
    found = (
        keyed_join(codes, entries, ["_code"], "inner")
        .groupBy("_row")
        .agg(F.array_sort(F.collect_list(F.struct("column", "place", "_text"))).alias("_found"))
    )
    decoded = {c: _texts(i).alias(c) for i, c in enumerate(present)}
    return rows.join(found, "_row", "left").select(*[decoded.get(c, F.col(f"`{c}`")) for c in df.columns])


def _texts(column: int) -> Column:
    """Texts found for one column, joined; the codes of a row are few."""
    own = F.filter("_found", lambda x: x["column"] == column)
    return F.nullif(F.array_join(F.transform(own, lambda x: x["_text"]), ","), F.lit(""))


def decode_fixed(df: DataFrame) -> DataFrame:
    """Market functions and location types come from the documentation, not the catalog;
    unknown values stay."""
    fixed = {"Marktfunktion": MARKET_FUNCTIONS, "Lokationtyp": LOCATION_TYPES}
    return df.withColumns({c: code_to_text(F.col(c), m) for c, m in fixed.items() if c in df.columns})
