"""Joins and per-key picks that stay balanced when one key holds a large share of all rows."""

from __future__ import annotations

import sys
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.session import shared_dir

# A key is hot if it alone has more than this part of what a shuffle partition gets on average.
# There are at most partitions / HOT_SHARE of them, which bounds the list that is broadcast.
HOT_SHARE = 0.5
HOT_ROWS = 1000  # fewer rows of a key need no split in any case
SALTS = 64  # of rows without a key, and where a caller names none


def plan_bytes(df: DataFrame) -> int:
    """Catalyst's size estimate of a plan; used to leave small lookups to a broadcast join."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except ValueError:  # estimates of long join chains can exceed what Python parses
        return sys.maxsize


def broadcast_limit(df: DataFrame) -> int:
    text = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold")
    if text.lstrip("-").isdigit():
        return int(text)
    return int(df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text))


def hot_keys(df: DataFrame, keys: Sequence[str], counts: DataFrame | None = None) -> DataFrame:
    """The keys that would overfill a task, with the number of salts that cuts them to size.

    One map-side combined count of the keys; the share of a task follows from its sum.
    """
    if counts is None:
        counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = written(counts)
    rows = counts.agg(F.sum("_n")).first()[0] or 0
    share = max(float(HOT_ROWS), HOT_SHARE * rows / partitions)
    salts = F.least(F.ceil(F.col("_n") / F.lit(share)), F.lit(4 * partitions)).cast("int")
    return counts.filter(F.col("_n") > share).select(*keys, salts.alias("_salts"))


def row_salt(df: DataFrame, salts: int | Column = SALTS) -> Column:
    """A salt that a re-run task computes again: row content plus the input partition."""
    hashable = [c.name for c in df.schema if not _has_map(c.dataType)]
    return F.pmod(F.xxhash64(F.spark_partition_id(), *hashable), salts if isinstance(salts, Column) else F.lit(salts)).cast("int")


def _has_map(kind: T.DataType) -> bool:
    return "map<" in kind.simpleString() or "variant" in kind.simpleString()


def keyed_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    counts: DataFrame | None = None,
    split: bool | None = None,
) -> DataFrame:
    """Join a large table to a keyed one on equally named columns, splitting hot keys.

    A right side below the broadcast threshold needs no shuffle, so it is left to Catalyst.
    Otherwise rows of the hot left keys spread over as many buckets as their count asks for and
    the matching right rows are repeated per bucket; with `how="left"` rows with a NULL key spread as well,
    because they match nothing and would share one task. `counts` passes key frequencies
    (`keys`, `_n`) a caller can get cheaper than by counting `left`.
    """
    keys = list(keys)
    if split is None:
        split = how in ("left", "inner", "left_semi", "left_anti") and plan_bytes(right) > broadcast_limit(right)
    if not split:
        return _join(left, right, keys, how, null_safe)
    # Written once, so that a chain of such joins does not repeat its inputs join by join.
    hot = written(hot_keys(left, keys, counts))
    keyless = not null_safe and how == "left" and any(left.schema[k].nullable for k in keys)
    if not keyless and hot.isEmpty():
        return _join(left, right, keys, how, null_safe)
    hot = F.broadcast(hot)
    no_key = F.lit(False)
    if not null_safe:
        for key in keys:
            no_key = no_key | F.col(key).isNull()
    salts = F.coalesce("_salts", F.when(no_key, F.lit(SALTS)), F.lit(1))
    salted_left = (
        _join(left, hot, keys, "left", null_safe).withColumn("_salt", row_salt(left, salts)).drop("_salts")
    )
    buckets = F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1)
    salted_right = (
        _join(right, hot, keys, "left", null_safe).withColumn("_salt", F.explode(buckets)).drop("_salts")
    )
    return _join(salted_left, salted_right, keys + ["_salt"], how, null_safe).drop("_salt")


def _join(left: DataFrame, right: DataFrame, keys: list[str], how: str, null_safe: bool) -> DataFrame:
    if not null_safe:
        return left.join(right, keys, how)
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_r_{key}"))
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of every key. Spark keeps one row per key in each map task
    (window group limit) before it shuffles, so a hot key costs one row per task."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def _exact_text(c: Column, kind: T.DataType) -> Column:
    """A text that two values share only if they are equal; NULL has its own. Each part carries
    its length, so that no two sequences of values look alike."""
    if isinstance(kind, T.StructType):
        text = F.concat(F.lit(""), *[_exact_text(c[f.name], f.dataType) for f in kind.fields])
    elif isinstance(kind, T.ArrayType):
        text = F.array_join(F.transform(c, lambda x: _exact_text(x, kind.elementType)), "")
    elif isinstance(kind, T.MapType):
        entries = T.ArrayType(T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)]))
        text = F.array_join(F.array_sort(F.transform(F.map_entries(c), lambda x: _exact_text(x, entries.elementType))), "")
    elif isinstance(kind, T.TimestampType):
        text = F.unix_micros(c).cast("string")
    elif isinstance(kind, T.DoubleType | T.FloatType):
        text = (c + F.lit(0.0).cast(kind)).cast("string")  # -0.0 equals 0.0, NaN equals NaN
    elif isinstance(kind, T.BinaryType):
        text = F.hex(c)
    else:
        text = c.cast("string")
    return F.when(c.isNull(), F.lit("N")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))


def row_digest(df: DataFrame, columns: Sequence[str]) -> Column:
    """A 256-bit digest of exact column values, NULLs included, to group wide rows by."""
    return F.sha2(F.concat(F.lit(""), *[_exact_text(F.col(c), df.schema[c].dataType) for c in columns]), 256)


def ranked(df: DataFrame, order: Sequence[Column], rank: str = "position", start: int = 1) -> DataFrame:
    """Global row numbers without pulling all rows into one task.

    Rows are range-partitioned and sorted; a row number is its place within the partition plus
    the number of rows in earlier partitions. The per-partition counts are at most as many rows
    as there are shuffle partitions, which bounds the broadcast. The order must be total.
    """
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # The id holds the partition in its upper bits and the place within it in the lower 33.
    placed = written(
        df.repartitionByRange(partitions, *order)
        .sortWithinPartitions(*order)
        .withColumn("_id", F.monotonically_increasing_id())
    )
    part = F.shiftright("_id", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.col("_id") - F.shiftleft(part, 33)
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(rank, (F.col("_before") + place + start).cast("bigint"))
        .drop("_part", "_id", "_before")
    )


def written(df: DataFrame, narrow: bool = False) -> DataFrame:
    """Write a result to the cluster's checkpoint folder and read it back.

    Lost executors then cost no recomputation, later readers see one fixed result, and the
    planner knows its true size instead of a product of estimates. `narrow` is for results of a few
    numbers per row: every file costs several calls of the file system (on local disks processes
    that Hadoop starts), so up to eight partitions go to one file, but four files per core are left.
    """
    if narrow:
        partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        df = df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, -(-partitions // 8)))
    path = f"{shared_dir(df.sparkSession)}/written/{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
