"""Key-based joins, rewrites and set operations on registry tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.operators.skew import first_per_key, keyed_join


def distinct_keys(df: DataFrame, key: str, alias: str | None = None) -> DataFrame:
    return df.select(F.col(key).alias(alias or key)).distinct()


def missing_detail(base: DataFrame, detail: DataFrame, base_key: str, detail_key: str) -> DataFrame:
    """Rows with a key for which no detail row exists."""
    keys = distinct_keys(detail, detail_key, base_key)
    return keyed_join(base.filter(F.col(base_key).isNotNull()), keys, [base_key], "left_anti")


def existing_keys(base: DataFrame, other: DataFrame, base_key: str, other_key: str) -> DataFrame:
    return keyed_join(base, distinct_keys(other, other_key, base_key), [base_key], "left_semi")


def drop_keys(base: DataFrame, keys: DataFrame, base_key: str, keys_key: str | None = None, where: Column | None = None) -> DataFrame:
    """Delete rows whose key is listed; rows outside `where` stay."""
    gone = distinct_keys(keys, keys_key or base_key, base_key).withColumn("_gone", F.lit(True))
    flagged = keyed_join(base, gone, [base_key], "left")
    drop = F.coalesce(F.col("_gone"), F.lit(False))
    if where is not None:
        drop = drop & F.coalesce(where, F.lit(False))
    return flagged.filter(~drop).select(*base.columns)


def has_older_version(new: DataFrame, stored: DataFrame, key: str, stamp: str) -> DataFrame:
    """Rows for which a stored row of the same key is older.

    Comparing with the oldest stored stamp per key equals the theta condition and keeps the
    join to one row per key.
    """
    oldest = stored.groupBy(key).agg(F.min(stamp).alias("_oldest"))
    return keyed_join(new, oldest, [key], "inner").filter(F.col("_oldest") < F.col(stamp)).select(*new.columns)


def member_flag(df: DataFrame, key: str, members: DataFrame, members_key: str, flag: str) -> DataFrame:
    """True where the key is in the other table; never NULL."""
    marks = distinct_keys(members, members_key, key).filter(F.col(key).isNotNull()).withColumn(flag, F.lit(True))
    joined = keyed_join(df, marks, [key], "left")
    return joined.select(*df.columns, F.coalesce(F.col(flag), F.lit(False)).alias(flag))


def supplement_by_key(
    df: DataFrame, source: DataFrame, key: str, columns: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Take columns from a source table by key; of several source rows the last one wins."""
    newest = first_per_key(source, [key], [o for o in order]).select(key, *columns)
    rest = [c for c in df.columns if c not in columns]
    return keyed_join(df.select(*rest), newest, [key], "inner")


def write_back(df: DataFrame, matches: DataFrame, key: str, values: Mapping[str, str]) -> DataFrame:
    """Set columns from the match of a row where there is one; the smallest match wins.

    `values` maps target columns to columns of `matches`.
    """
    picked = matches.groupBy(key).agg(
        F.min(F.struct(*[F.col(v).alias(f"_{t}") for t, v in values.items()])).alias("_match")
    )
    joined = keyed_join(df, picked, [key], "left")
    kept = [c for c in df.columns if c not in values]
    return joined.select(
        *kept,
        *[
            F.when(F.col("_match").isNotNull(), F.col("_match")[f"_{t}"])
            .otherwise(F.col(t) if t in df.columns else F.lit(None))
            .alias(t)
            for t in values
        ],
    )


def update_by_key(df: DataFrame, updates: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Overwrite columns of rows whose key is in the update table, whatever value it brings."""
    marked = updates.select(
        key, F.lit(True).alias("_hit"), *[F.col(c).alias(f"_new_{c}") for c in columns]
    )
    joined = keyed_join(df, marked, [key], "left")
    kept = [c for c in df.columns if c not in columns]
    return joined.select(
        *kept, *[F.when(F.col("_hit"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c) for c in columns]
    )


def override_flags(df: DataFrame, overrides: DataFrame, exclusions: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Manual corrections: non-NULL override values replace flags, listed keys leave the table."""
    kept = keyed_join(df, distinct_keys(exclusions, key), [key], "left_anti")
    marked = overrides.select(key, *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = keyed_join(kept, marked, [key], "left")
    rest = [c for c in df.columns if c not in columns]
    return joined.select(*rest, *[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) for c in columns])


def join_back(dimension: DataFrame, facts: DataFrame, key: str, aggregates: Mapping[str, Column]) -> DataFrame:
    """Aggregate facts per key and attach to the dimension; keys without facts keep NULL."""
    per_key = facts.groupBy(key).agg(*[v.alias(k) for k, v in aggregates.items()])
    return dimension.join(per_key, key, "left")


def shared_groups(flagged: DataFrame, keys: Sequence[str], strict: bool = False) -> DataFrame:
    """Key combinations that hold rows of both sides, with the size of each side.

    `strict` keeps a combination only if every new unit under the first key has the same
    remaining keys.
    """
    sizes = flagged.groupBy(*keys).agg(
        F.count_if(F.col("side") == "old").alias("n_old"), F.count_if(F.col("side") == "new").alias("n_new")
    )
    shared = sizes.filter("n_old > 0 and n_new > 0")
    if strict:
        totals = sizes.groupBy(keys[0]).agg(F.sum("n_new").alias("_all_new"))
        shared = keyed_join(shared, totals, [keys[0]], "inner").filter("n_new = _all_new").drop("_all_new")
    return shared


def duplicate_candidates(
    units: DataFrame, keys: Sequence[str], id_column: str, is_old: Column, is_new: Column, strict: bool = False
) -> DataFrame:
    """Possible duplicates: units under a key combination that occurs on the old and the new side.

    The relation is kept as group membership, one row per unit with both group sizes, so a
    combination shared by many units grows with them, never with all their pairs.
    """
    side = F.when(is_old, F.lit("old")).when(is_new, F.lit("new"))
    flagged = units.withColumn("side", side).filter("side is not null").dropna(subset=list(keys))
    members = keyed_join(flagged, shared_groups(flagged, keys, strict), list(keys), "inner")
    return members.select(*keys, "side", id_column, "n_old", "n_new")
