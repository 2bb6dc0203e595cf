"""Counts, completeness and duplicates of registry tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from unitledger.operators.skew import first_per_key, keyed_join, row_digest


def grouped_count(df: DataFrame, *keys: str, name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(F.desc(name), *keys)


def total_and_groups(df: DataFrame, key: str, label: str = "ALL", name: str = "n") -> DataFrame:
    """One row per key plus a total row labelled `ALL`, from one pass."""
    rolled = df.rollup(key).agg(F.count(F.lit(1)).alias(name), F.grouping(key).alias("_total"))
    return rolled.select(F.when(F.col("_total") == 1, F.lit(label)).otherwise(F.col(key)).alias(key), name)


def null_profile(df: DataFrame, columns: Sequence[str], total: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(total), *[F.count(c).alias(f"n_{c}") for c in columns])


def completeness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Percentage of non-NULL values per column; all columns share one scan."""
    columns = list(columns or df.columns)
    shares = df.agg(*[(F.avg(F.col(f"`{c}`").isNotNull().cast("int")) * 100).alias(c) for c in columns])
    return shares.unpivot([], columns, "column_name", "filled_percent")


def order_by_fill(df: DataFrame, descending: bool = True, keep: int | None = None, min_share: float | None = None) -> DataFrame:
    """Columns reordered by fill ratio; `keep` takes the first n of them, `min_share` those
    filled at least to that share. Only the ratios, one row, reach the driver."""
    filled = completeness(df).collect()
    ratio = {r["column_name"]: r["filled_percent"] or 0.0 for r in filled}
    columns = sorted(df.columns, key=lambda c: (-ratio[c] if descending else ratio[c], c))
    if min_share is not None:
        columns = [c for c in columns if ratio[c] >= min_share * 100]
    return df.select(*columns[: keep or len(columns)])


def filled_columns(columns: Sequence[str]) -> Column:
    """Number of non-NULL values in a row."""
    return reduce(lambda a, b: a + b, [F.col(f"`{c}`").isNotNull().cast("int") for c in columns])


def row_completeness(df: DataFrame, key: str, columns: Sequence[str]) -> DataFrame:
    """Fewest and most filled rows, with the smallest key reaching each."""
    rows = df.select(F.col(key).alias("k"), filled_columns(columns).alias("filled"))
    return rows.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min("filled").alias("min_filled"),
        F.max("filled").alias("max_filled"),
        F.min(F.struct("filled", "k"))["k"].alias("min_key"),
        (F.min(F.struct(-F.col("filled"), "k"))["k"]).alias("max_key"),
    )


def facts(df: DataFrame, key: str, value: str, digits: int = 2) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(value).alias("n"),
        F.min(value).alias("smallest"),
        F.max(value).alias("largest"),
        F.round(F.sum(value), digits).alias("total"),
        F.round(F.avg(value), digits).alias("mean"),
    )


def funnel(steps: Sequence[tuple[str, DataFrame]]) -> DataFrame:
    """Row count of each step, one row per step."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(i).alias("step"), F.lit(name).alias("name"), "n")
        for i, (name, df) in enumerate(steps)
    ]
    return reduce(DataFrame.unionAll, counts)


def funnel_flags(df: DataFrame, steps: Mapping[str, Column]) -> DataFrame:
    """Counts of nested conditions in one pass over the table, in long form."""
    wide = df.agg(*[F.count_if(c).alias(name) for name, c in steps.items()])
    return wide.unpivot([], list(steps), "name", "n")


def membership(sets: Mapping[str, DataFrame], key: str) -> DataFrame:
    """Which sets contain each id: one row per id, one flag per set."""
    tagged = reduce(
        DataFrame.unionByName,
        [df.select(F.col(df.columns[0]).alias(key), *[F.lit(n == name).alias(n) for n in sets]) for name, df in sets.items()],
    )
    return tagged.filter(F.col(key).isNotNull()).groupBy(key).agg(*[F.bool_or(n).alias(n) for n in sets])


def combination_sizes(members: DataFrame, flags: Sequence[str], name: str = "n") -> DataFrame:
    return members.groupBy(*flags).agg(F.count(F.lit(1)).alias(name))


def overlap_totals(members: DataFrame, category: str, left: str, right: str) -> DataFrame:
    """Only-left, both, only-right per category with a total row."""
    a, b = F.col(left), F.col(right)
    rolled = members.rollup(category).agg(
        F.count_if(a & ~b).alias("only_left"),
        F.count_if(a & b).alias("both"),
        F.count_if(~a & b).alias("only_right"),
        F.count_if(a | b).alias("total"),
        F.grouping(category).alias("_total"),
    )
    label = F.when(F.col("_total") == 1, F.lit("sum")).otherwise(F.col(category))
    return rolled.withColumn(category, label).drop("_total")


def duplicated_rows(df: DataFrame, ignore: Sequence[str] = ()) -> DataFrame:
    """All members of groups that are equal in every column but the ignored ones.

    Groups are counted on a digest with map-side combine and joined back, so no group is
    gathered in one task.
    """
    compared = [c for c in df.columns if c not in ignore]
    keyed = df.withColumn("_digest", row_digest(df, compared))
    counts = keyed.groupBy("_digest").agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1")
    return keyed_join(keyed, counts.select("_digest"), ["_digest"], "left_semi", counts=counts).drop("_digest")


def unique_rows(df: DataFrame, order: Sequence[Column], ignore: Sequence[str] = ()) -> DataFrame:
    """The first row of each such group."""
    compared = [c for c in df.columns if c not in ignore]
    keyed = df.withColumn("_digest", row_digest(df, compared))
    return first_per_key(keyed, ["_digest"], order).drop("_digest")


def duplicate_columns(df: DataFrame, key: str) -> list[str]:
    """Columns whose values equal those of a later column of the same type, row by row.

    One pass compares an order-free fingerprint (sum of hashes of key and value) per column;
    one more pass verifies the pairs whose fingerprints agree.
    """
    columns = [c for c in df.columns if c != key]
    kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    prints = df.agg(
        *[F.sum(F.xxhash64(F.col(key), F.col(c)).cast("decimal(38,0)")).alias(c) for c in columns]
    ).first()
    pairs = [
        (a, b)
        for i, a in enumerate(columns)
        for b in columns[i + 1 :]
        if kinds[a] == kinds[b] and prints[a] == prints[b]
    ]
    if not pairs:
        return []
    checked = df.agg(
        *[F.count_if(~F.col(a).eqNullSafe(F.col(b))).alias(f"p{i}") for i, (a, b) in enumerate(pairs)]
    ).first()
    return list(dict.fromkeys(a for i, (a, _) in enumerate(pairs) if checked[f"p{i}"] == 0))


def min_max_scaled(df: DataFrame, value: str, low: float, high: float, name: str) -> DataFrame:
    """Scale a column to a range; the extremes come from a scalar subquery of one row."""
    extremes = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    return (
        df.withColumn("_extremes", extremes)
        .withColumn(
            name,
            low
            + (F.col(value) - F.col("_extremes.low"))
            * (high - low)
            / F.nullif(F.col("_extremes.high") - F.col("_extremes.low"), F.lit(0.0)),
        )
        .drop("_extremes")
    )
