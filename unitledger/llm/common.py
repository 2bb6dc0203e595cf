"""Helpers the operators of this subpackage share."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from unitledger.operators.skew import written
from unitledger.session import configure

__all__ = [
    "bloom_bits",
    "bloom_slots",
    "bounded_batches",
    "fresh",
    "in_bloom",
    "maybe_among",
    "prepare",
    "swept",
    "table",
    "text_bytes",
    "written",
]

#: Rows a Python task holds at a time. Texts differ much in length, so batches stay small.
BATCH_ROWS = 1000
#: Bytes of a batch; it ends with the row that reaches them.
BATCH_BYTES = 1 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """The session settings these operators rely on."""
    configure(spark)
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") != str(BATCH_ROWS):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def bounded_batches(spark: SparkSession) -> SparkSession:
    """`prepare`, with batches that end at a number of bytes too, for operators that hold several
    times their batch."""
    if spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch", None) != str(BATCH_BYTES):
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return prepare(spark)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that no column of `df` has or begins with."""
    taken = [c.lower() for c in df.columns]
    while any(c.startswith(name.lower()) for c in taken):
        name = "_" + name
    return name


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column, empty for null."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def text_values(column: pa.Array) -> list[str]:
    return [x or "" for x in column.to_pylist()]


def signed(values: np.ndarray) -> np.ndarray:
    """Unsigned hashes as the longs Spark has."""
    return values.astype(np.uint64, copy=False).view(np.int64)


# A Bloom filter of hashed keys. Its size follows the number of keys up to a fixed bound; with
# more keys it lets more through, which costs work and changes no result.
_SHIFTS = (0, 19, 38)
MAX_LOG_BITS = 26


def bloom_slots(n: int, most: int = MAX_LOG_BITS) -> int:
    """Bits (as a power of two) for `n` keys."""
    return int(min(most, max(12, np.ceil(np.log2(16 * max(n, 1))))))


def bloom_bits(keys: DataFrame, hashed: Column, log_bits: int) -> np.ndarray:
    """The filter as 64-bit words: every key sets its bits, words are combined by bit_or in Spark
    before at most 2^(log_bits - 6) of them come to the driver (8 MB at the largest size)."""
    mask = (1 << log_bits) - 1
    slots = F.array(*[F.shiftrightunsigned(hashed, s).bitwiseAND(F.lit(mask).cast("long")) for s in _SHIFTS])
    words = (
        keys.select(F.explode(slots).alias("slot"))
        .groupBy(F.shiftright("slot", 6).alias("at"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(slot & 63 as int)))").alias("word"))
        .toArrow()
    )
    out = np.zeros(1 << (log_bits - 6), dtype=np.uint64)
    out[words.column("at").to_numpy()] = words.column("word").to_numpy().view(np.uint64)
    return out


def in_bloom(bits: np.ndarray, hashed: np.ndarray) -> np.ndarray:
    """Whether each hash may be a key; `hashed` are the same longs the filter was built from."""
    h = hashed.view(np.uint64)
    mask = np.uint64(len(bits) * 64 - 1)
    found = np.ones(len(h), dtype=bool)
    for s in _SHIFTS:
        slot = (h >> np.uint64(s)) & mask
        found &= (bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) == 1
    return found


def maybe_among(rows: DataFrame, column: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows whose `column` may be among the one column of `keys`, and those where it surely is not.

    A Bloom filter of at most 8 MB decides in place, so no row is moved and any column types will do.
    """
    log_bits = bloom_slots(keys.count())
    words = bloom_bits(keys, F.xxhash64(keys.columns[0]), log_bits)
    name = fresh(rows, "_words")
    one = F.broadcast(rows.sparkSession.createDataFrame(pa.table({name: pa.array([words.view(np.int64)])})))
    found = F.lit(True)
    for s in _SHIFTS:
        slot = F.shiftrightunsigned(F.xxhash64(column), s).bitwiseAND(F.lit((1 << log_bits) - 1).cast("long"))
        word = F.get(name, F.shiftright(slot, 6).cast("int"))
        bit = F.call_function("shiftrightunsigned", word, slot.bitwiseAND(F.lit(63).cast("long")).cast("int"))
        found = found & (bit.bitwiseAND(F.lit(1).cast("long")) == 1)
    return rows.join(one, found, "left_semi"), rows.join(one, found, "left_anti")


def swept(spark: SparkSession) -> None:
    """Let the driver collect its garbage, as Spark deletes shuffle files only when it finds that
    nobody holds their results any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def in_sorted(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each value its place in a sorted array, and whether it is there."""
    if not len(sorted_values):
        return np.zeros(len(values), dtype=np.int64), np.zeros(len(values), dtype=bool)
    at = np.searchsorted(sorted_values, values)
    at[at == len(sorted_values)] = 0
    return at, sorted_values[at] == values


def in_batches(function: Callable[[pa.RecordBatch], pa.RecordBatch | None]) -> Callable:
    """A function of one Arrow batch as one over a task's batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = function(batch)
                if out is not None and out.num_rows:
                    yield out

    return run


def batch_of(names: Sequence[str], arrays: Sequence) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in arrays], names=list(names))
