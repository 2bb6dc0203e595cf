"""Benchmark decontamination as a prefix-filtered containment join.

A window of an item (`size` consecutive words, or the whole of a shorter item) occurs in a
document only if all its word shingles do. Containment needs every shingle, so the prefix of a
window is a single one: its rarest over all documents. Windows with a shingle that no document
holds are gone at once. Documents give up the places where a prefix shingle stands; a join on
that shingle proposes windows, the place of the shingle and the length of the document bound
where the window can lie, and the words there are compared exactly.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import (
    batch_of,
    bloom_bits,
    bloom_slots,
    fresh,
    in_batches,
    in_bloom,
    prepare,
    signed,
    text_bytes,
    written,
)
from unitledger.llm.words import NOT_ALNUM, hashed_words, window_hashes
from unitledger.operators.skew import keyed_join

#: Words of a window, and of a shingle (fewer where the item has fewer).
WINDOW, SHINGLE = 10, 3
_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())  # bytes.lower changes A-Z alone


def _windows(size: int):
    """(item, words of a window, its length, its shingles in order) of every item."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        rows = []
        for item, text in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
            words = words_of(text)
            if not words:
                continue
            length, k = min(size, len(words)), min(SHINGLE, len(words))
            hashes, _ = hashed_words([text], NOT_ALNUM)
            shingles = signed(window_hashes(hashes, k)).tolist()
            for i in range(len(words) - length + 1):
                rows.append((item, b" ".join(words[i : i + length]).decode(), length, k, shingles[i : i + length - k + 1]))
        if not rows:
            return None
        kinds = (pa.string(), pa.string(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
        return batch_of(
            ["item", "words", "length", "k", "shingles"], [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        )

    return in_batches(one)


def _found(texts: list[bytes], filters):
    """Of a batch: first word of each text, and per shingle length the places of filtered shingles."""
    words, at = hashed_words(texts, NOT_ALNUM)
    of = np.repeat(np.arange(len(texts)), np.diff(at))
    places = []
    for k, bits in filters.value:
        shingles = window_hashes(words, k)
        inside = in_bloom(bits, shingles) & (of[: len(shingles)] == of[k - 1 : k - 1 + len(shingles)])
        place = np.flatnonzero(inside)
        places.append((place, shingles[place]))
    place = np.concatenate([p for p, _ in places]) if places else np.zeros(0, dtype=np.int64)
    shingles = np.concatenate([s for _, s in places]) if places else np.zeros(0, dtype=np.uint64)
    return at, of[place], place, shingles


def _frequencies(filters):
    """(shingle, texts that hold it) of a batch."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        _, of, _, shingles = _found(text_bytes(batch.column(0)), filters)
        if not len(of):
            return None
        order = np.lexsort((of, shingles))
        of, shingles = of[order], shingles[order]
        first = np.append(True, (shingles[1:] != shingles[:-1]) | (of[1:] != of[:-1]))
        values, seen = np.unique(shingles[first], return_counts=True)
        return batch_of(["shingle", "texts"], [signed(values), seen.astype(np.int64)])

    return in_batches(one)


_PLACES = pa.list_(pa.struct([("shingle", pa.int64()), ("place", pa.int64()), ("before", pa.int32()), ("around", pa.string())]))


def _places(size: int, filters):
    """Per document its number of words and the places of prefix shingles with the words around."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column(1))
        at, of, place, shingles = _found(texts, filters)
        found: list[list | None] = [None] * len(texts)
        order = np.argsort(of, kind="stable")
        of, place, shingles = of[order], place[order], signed(shingles[order])
        own, starts = np.unique(of, return_index=True)
        for d, part in zip(own.tolist(), np.split(np.arange(len(of)), starts[1:])):
            words = words_of(texts[d])
            rows = []
            for i in part.tolist():
                p = int(place[i] - at[d])
                low = max(0, p - size + 1)
                rows.append((int(shingles[i]), p, p - low, b" ".join(words[low : p + size]).decode()))
            found[d] = [dict(zip(("shingle", "place", "before", "around"), r)) for r in rows]
        return batch_of(
            ["id", "key", "n_words", "places"],
            [batch.column(0), batch.column(2), np.diff(at), pa.array(found, _PLACES)],
        )

    return in_batches(one)


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """Words of documents that lie in windows of benchmark items, one row per input row.

    Returns the id, `n_words`, `n_hit` (words inside an occurrence of a window), `n_items` (items
    with an occurring window), `items` (their ids as strings, sorted) and `contaminated`. Null and
    empty texts have no words; with an empty benchmark nothing is hit. Items without words are
    skipped; an item without an id hits words and names nothing. Repeated documents and items are
    fine, and columns beyond the named ones are not looked at.
    """
    found = _contamination(docs, items, id_col, text_col, item_col, item_text_col, size)
    return found.select(F.col("id").alias(id_col), "n_words", "n_hit", "n_items", "items", "contaminated")


def _text_key(text: Column) -> Column:
    """Tells the texts of one id apart; null counts as empty."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _contamination(
    docs: DataFrame, items: DataFrame, id_col: str, text_col: str, item_col: str, item_text_col: str, size: int
) -> DataFrame:
    """`contamination` with the key of the text (`id`, `key`)."""
    spark = prepare(docs.sparkSession)
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), _text_key(F.col(text_col)).alias("key"))
    id_type = source.schema["id"].dataType
    windows = written(
        items.select(F.col(item_col).cast("string"), F.col(item_text_col))
        .mapInArrow(_windows(size), "item string, words string, length int, k int, shingles array<long>")
        .groupBy("words", "length", "k", "shingles")
        .agg(F.collect_set("item").alias("items"))
    )
    exploded = windows.select("k", "words", F.posexplode("shingles").alias("offset", "shingle"))

    def filters(of: DataFrame):
        """A filter of bounded size for each shingle length in use."""
        counts = of.groupBy("k").agg(F.countDistinct("shingle").alias("n")).collect()
        return spark.sparkContext.broadcast(
            [(r.k, bloom_bits(of.filter(F.col("k") == r.k), F.col("shingle"), bloom_slots(4 * r.n))) for r in counts]
        )

    frequency = (
        source.select("text")
        .mapInArrow(_frequencies(filters(exploded)), "shingle long, texts long")
        .groupBy("shingle")
        .agg(F.sum("texts").alias("texts"))
    )
    rarest = (
        exploded.join(frequency, "shingle", "left")
        .groupBy("words")
        .agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "shingle", "offset")).alias("low"))
        .filter("low.texts > 0")
        .select("words", "low.shingle", "low.offset")
    )
    prefixes = written(rarest.join(windows.select("words", "length", "k", "items"), "words"))
    kinds = [T.StructField("id", id_type)] + [T.StructField(c, T.LongType()) for c in ("key", "n_words")]
    scanned = written(
        source.mapInArrow(
            _places(size, filters(prefixes)),
            T.StructType(
                kinds
                + [
                    T.StructField(
                        "places", T.ArrayType(T._parse_datatype_string("struct<shingle:long,place:long,before:int,around:string>"))
                    )
                ]
            ),
        )
    )
    start = F.col("place") - F.col("offset")
    hits = (
        scanned.filter("places is not null")
        .select("id", "key", "n_words", F.inline("places"))
        .join(prefixes, "shingle")
        .filter((start >= 0) & (start + F.col("length") <= F.col("n_words")))
        .filter(
            F.array_join(F.slice(F.split("around", " "), F.col("before") - F.col("offset") + 1, F.col("length")), " ")
            == F.col("words")
        )
        .select("id", "key", start.alias("start"), (start + F.col("length")).alias("stop"), "items")
    )
    earlier = Window.partitionBy("id", "key").orderBy("start", "stop").rowsBetween(Window.unboundedPreceding, -1)
    per_document = (
        hits.withColumn("_end", F.coalesce(F.max("stop").over(earlier), F.lit(0)))
        .withColumn("_new", F.greatest(F.lit(0), F.col("stop") - F.greatest("start", "_end")))
        .groupBy("id", "key")
        .agg(F.sum("_new").alias("n_hit"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
        .select(F.col("id").alias("_id"), F.col("key").alias("_key"), "n_hit", "items")
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    return scanned.join(
        per_document, F.col("id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left"
    ).select(
        "id",
        "key",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
        (n_hit > 0).alias("contaminated"),
    )


def clean_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    size: int = WINDOW,
) -> DataFrame:
    """The documents without any benchmark window; all their columns stay.

    Every row is decided by its own text: rows that share an id with a contaminated one, or have
    none as it has, stay if their text is clean.
    """
    found = _contamination(docs, items, id_col, text_col, item_col, item_text_col, size)
    of_id, key = fresh(docs, "_of_id"), fresh(docs, "_text_key")
    dirty = written(found.filter("contaminated").select(F.col("id").alias(of_id), F.col("key").alias(key)).distinct())
    keyed = docs.withColumns({of_id: F.col(id_col), key: _text_key(F.col(text_col))})
    return keyed_join(keyed, dirty, [of_id, key], "left_anti", null_safe=True).select(*docs.columns)
