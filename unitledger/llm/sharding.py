"""Shards of nearly equal size by sampled splitters.

Records are ordered by the hash of their text, then of their id, so that equal texts lie side by
side. A size-weighted sample of keys gives quantile boundaries; ranges that still hold too much
are sampled again and subdivided. Each range is one task that sorts its records and sums their
sizes; with the sizes of the earlier ranges every record knows its place in the whole, and the
place decides the shard. The few records larger than a hundredth of a shard are placed first.
Texts are read once for their size and hash and not moved.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import batch_of, fresh, in_batches, prepare, written

SHARDS = 24
#: Keys drawn per round, on average; they come to the driver (16 bytes each).
SAMPLE = 20_000
#: A record of more than this part of a shard is placed by itself; fewer than SHARDS * PART exist.
PART = 100
ROUNDS = 6


def _range_of(h: np.ndarray, k: np.ndarray, bound_h: np.ndarray, bound_k: np.ndarray) -> np.ndarray:
    """Number of boundaries before each key; keys compare by `h`, then by `k`."""
    low = np.searchsorted(bound_h, h, side="left")
    high = np.searchsorted(bound_h, h, side="right")
    tied = np.flatnonzero(high > low)
    out = low.copy()
    for first in np.unique(low[tied]).tolist():
        rows = tied[low[tied] == first]
        out[rows] = first + np.searchsorted(bound_k[first : high[rows[0]]], k[rows], side="left")
    return out


def _ranged(rows: DataFrame, bounds: list[tuple[int, int]]) -> DataFrame:
    shared = rows.sparkSession.sparkContext.broadcast(
        tuple(np.array(x, dtype=np.int64) for x in (zip(*bounds) if bounds else ((), ())))
    )
    names = rows.columns

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        h, k = (batch.column(names.index(c)).to_numpy() for c in ("h", "k"))
        return batch_of([*names, "range"], [*batch.columns, pa.array(_range_of(h, k, *shared.value), pa.int32())])

    return rows.mapInArrow(in_batches(one), T.StructType([*rows.schema, T.StructField("range", T.IntegerType())]))


def _drawn(rows: DataFrame, total: int, seed: int) -> list[tuple[int, int, float]]:
    """Keys drawn with a chance in proportion to the size of all their rows, with the size each
    stands for: equal rows are one key, drawn once, so that about SAMPLE keys come at most."""
    rate = SAMPLE / max(total, 1)
    rows = rows.groupBy("h", "k").agg(F.sum("size").alias("size"))
    chance = F.col("size") * F.lit(rate)
    draw = F.shiftrightunsigned(F.xxhash64("h", "k", F.lit(seed)), 11) / F.lit(float(1 << 53))
    drawn = rows.filter(draw < chance).select("h", "k", F.greatest("size", F.lit(1 / rate)).alias("weight"))
    return sorted((r.h, r.k, r.weight) for r in drawn.collect())


def _quantiles(keys: list[tuple[int, int, float]], parts: int) -> list[tuple[int, int]]:
    if not keys or parts < 2:
        return []
    sums = np.cumsum([w for _, _, w in keys])
    at = np.searchsorted(sums, sums[-1] * np.arange(1, parts) / parts)
    return sorted({keys[i][:2] for i in at.tolist()})


def splitters(rows: DataFrame, total: int, parts: int) -> tuple[list[tuple[int, int]], dict[int, tuple[int, int]]]:
    """Boundaries that cut `rows` (h, k, size) into about `parts` ranges, none over twice its share
    unless a single key is larger; and (bytes, rows) of each range."""
    bounds = _quantiles(_drawn(rows, total, 0), parts)
    for attempt in range(1, ROUNDS + 1):
        ranged = _ranged(rows, bounds)
        held = {r.range: (r.b, r.n) for r in ranged.groupBy("range").agg(F.sum("size").alias("b"), F.count("*").alias("n")).collect()}
        large = {r: b for r, (b, _) in held.items() if b > 2 * total / parts}
        if not large or attempt == ROUNDS:
            break
        keys = _drawn(ranged.filter(F.col("range").isin(list(large))), sum(large.values()), attempt)
        more = set()
        for r, b in large.items():
            low = bounds[r - 1] if r else (-(1 << 63), -(1 << 63))
            high = bounds[r] if r < len(bounds) else (1 << 63, 0)
            own = [x for x in keys if low < x[:2] <= high]
            more |= set(_quantiles(own, int(np.ceil(b * parts / total)) + 1))
        if not more - set(bounds):
            break
        bounds = sorted({*bounds, *more})
    return bounds, held


def _rooms(loads: list[int], rest: int) -> list[float]:
    """Room of each shard for the small records, so that all end as level as the large ones allow."""
    order = sorted(loads)
    for n in range(len(order), 0, -1):
        level = (rest + sum(order[:n])) / n
        if level >= order[n - 1]:
            break
    return [max(0.0, level - load) for load in loads]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 8).cast("long").alias("size"),
        F.crc32(text).cast("long").alias("crc"),
        F.xxhash64(text).alias("h"),
        F.xxhash64(F.col(id_col)).alias("k"),
    )


def _of_shard(values: list, shard: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), shard + 1)


def shard_by_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> DataFrame:
    """Shard and slot of every input row under the law `bytes`: sizes of shards nearly equal.

    A row's size is that of its text in UTF-8 plus 8; null texts have no bytes. Sizes of shards
    differ by a hundredth of their mean or so, and by more only where a single record is larger
    than that. Slots of a shard run from 0 without gaps. Returns id, `size`, `text_crc32`, `law`,
    `shard`, `slot` and `grown_shard` (null under this law). Rows of equal texts are neighbours in
    the order, so they share a shard unless it is cut there; repeated rows, null ids and an empty
    table are fine. Other columns are not looked at.
    """
    spark = prepare(docs.sparkSession)
    rows = written(keyed(docs, id_col, text_col))
    total = rows.agg(F.sum("size")).first()[0] or 0
    is_large = F.col("size") * shards * PART > total
    large = rows.filter(is_large).collect()
    loads, slots = [0] * shards, [0] * shards
    chosen = []
    for r in sorted(large, key=lambda r: (-r["size"], r.h, r.k)):
        shard = min(range(shards), key=loads.__getitem__)
        chosen.append((r.id, r["size"], r.crc, shard, slots[shard]))
        loads[shard] += r["size"]
        slots[shard] += 1
    small = rows.filter(~is_large)
    rest = total - sum(loads)
    parts = max(shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    bounds, held = splitters(small, rest, parts) if rest else ([], {})
    offsets, bytes_before, rows_before = [], 0, 0
    for r in sorted(held):
        offsets.append((r, bytes_before, rows_before))
        bytes_before, rows_before = bytes_before + held[r][0], rows_before + held[r][1]
    # One row per range.
    before = F.broadcast(spark.createDataFrame(offsets, "range int, bytes_before long, rows_before long"))
    edges = np.cumsum(_rooms(loads, rest)).tolist()[:-1]
    order = Window.partitionBy("range").orderBy("h", "k", "size")
    middle = F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size") / 2
    placed = written(
        _ranged(small, bounds)
        .withColumns({"_at": middle, "_n": F.row_number().over(order)})
        .join(before, "range")
        .withColumn("shard", sum((F.col("_at") + F.col("bytes_before") >= e).cast("int") for e in edges) if edges else F.lit(0))
        .select("id", "size", "crc", "shard", (F.col("rows_before") + F.col("_n") - 1).alias("rank"))
        if rest
        else small.select("id", "size", "crc", F.lit(0).alias("shard"), F.lit(0).cast("long").alias("rank"))
    )
    firsts = {r.shard: r.first for r in placed.groupBy("shard").agg(F.min("rank").alias("first")).collect()}
    slot = F.col("rank") - _of_shard([firsts.get(s, 0) for s in range(shards)], F.col("shard")) + _of_shard(slots, F.col("shard"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), *(T.StructField(c, T.LongType()) for c in ("size", "crc", "shard", "slot"))])
    both = placed.select("id", "size", "crc", F.col("shard").cast("long"), slot.cast("long").alias("slot")).unionByName(
        spark.createDataFrame(chosen, schema)
    )
    return both.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def write_shards(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS) -> None:
    """Writes all columns of the documents as Parquet, one folder `shard=<n>` per shard.

    Rows that agree in id, size and checksum of the text are the same record to this function.
    """
    docs = docs.drop("shard")
    own = fresh(docs, "_own_")
    assigned = (
        shard_by_bytes(docs, id_col, text_col, shards)
        .groupBy(F.col(id_col).alias(f"{own}id"), F.col("size").alias(f"{own}size"), F.col("text_crc32").alias(f"{own}crc"))
        .agg(F.min("shard").alias("shard"))
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = (
        F.col(id_col).eqNullSafe(F.col(f"{own}id"))
        & ((F.octet_length(text) + 8).cast("long") == F.col(f"{own}size"))
        & (F.crc32(text).cast("long") == F.col(f"{own}crc"))
    )
    joined = docs.join(assigned, same).select(*docs.columns, "shard")
    joined.repartition(F.col("shard"), F.pmod(F.xxhash64(id_col), F.lit(8))).write.partitionBy("shard").parquet(path)
