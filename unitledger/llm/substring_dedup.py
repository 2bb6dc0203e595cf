"""Removal of word passages that repeat, by super-k-mers.

A window of 35 words has a minimiser: the smallest hash among its runs of five words. Windows
that follow one another and share it form a super-k-mer, which travels as one string of words to
the bucket of the minimiser; equal windows have equal minimisers and so meet there. A bucket's
task sorts its windows and compares them word by word, so that nothing rests on a hash.

A minimiser that occurs once in the corpus has no repeated window; only super-k-mers of repeated
ones travel. Equal texts travel once, as every window of theirs is known to repeat. A bucket that
would overfill a task is dealt over several; each sends one row per different window to a second
round, whose groups have at most as many rows as the bucket has parts.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import batch_of, bloom_bits, bloom_slots, fresh, in_batches, in_bloom, bounded_batches, signed, text_bytes, written
from unitledger.llm.words import SPACES, hashed_words, mix, window_hashes
from unitledger.operators.skew import hot_keys, keyed_join

WINDOW = 35
#: Words of the runs whose hashes are compared for the minimiser.
RUN = 5
#: Windows that share one string at most; a longer super-k-mer goes as several.
TOGETHER = 128
#: Bytes of strings a bucket task sorts at a time, in whole buckets.
SORTED_BYTES = 4 << 20
#: Bits of the filters of repeated minimisers and texts, as a power of two (32 MB). With more keys
#: than it holds a filter lets more strings travel, at most about three times the text in all.
FILTER_BITS = 28


def text_key(text: Column) -> Column:
    """128 bits of the SHA-256 of a text; null counts as empty."""
    return F.substring(F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256)), 1, 16)


def _key_hash(key: Column) -> Column:
    return F.conv(F.hex(F.substring(key, 1, 8)), 16, -10).cast("long")


def _key_hashes(keys: pa.Array) -> np.ndarray:
    """The same numbers of a whole batch of 16-byte keys."""
    return np.array([int.from_bytes(k[:8], "big", signed=True) for k in keys.to_pylist()], dtype=np.int64)


def super_kmers(words: np.ndarray, at: np.ndarray, window: int, run: int = RUN) -> tuple[np.ndarray, ...]:
    """Of word hashes of several texts (`at`: first word of each, then the end) the super-k-mers:
    text number, first word within it, number of windows, minimiser, and whether the minimiser
    stands at several places of it."""
    run = min(run, window)
    wide = window - run + 1
    h = window_hashes(words, run)
    n = len(words) - window + 1
    none = np.zeros(0, dtype=np.int64)
    if n <= 0:
        return none, none, none, none.view(np.uint64), none.astype(bool)
    least, size = h, 1
    while 2 * size <= wide:
        least = np.minimum(least[:-size], least[size:])
        size *= 2
    if size < wide:
        least = np.minimum(least[: n], least[wide - size : wide - size + n])
    places = np.arange(n)
    text = np.searchsorted(at, places, side="right") - 1
    inside = places + window <= at[text + 1]
    places, text, least = places[inside], text[inside], least[:n][inside]
    if not len(places):
        return none, none, none, none.view(np.uint64), none.astype(bool)
    new = np.ones(len(places), dtype=bool)
    new[1:] = (least[1:] != least[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    count = np.diff(first, append=len(places))
    if (count > TOGETHER).any():
        parts = -(-count // TOGETHER)
        step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first = np.repeat(first, parts) + step * TOGETHER
        count = np.diff(first, append=len(places))
    begin, last, value = places[first], places[first] + count - 1, least[first]
    across = np.arange(wide)
    from_left = begin + (h[begin[:, None] + across] == value[:, None]).argmax(axis=1)
    from_right = last + wide - 1 - (h[last[:, None] + across[::-1]] == value[:, None]).argmax(axis=1)
    # Parts of one longer super-k-mer share the minimiser with each other.
    joined = np.zeros(len(first), dtype=bool)
    same = (value[1:] == value[:-1]) & (text[first][1:] == text[first][:-1])
    joined[1:] |= same
    joined[:-1] |= same
    return text[first], begin - at[text[first]], count, value, (from_left != from_right) | joined


def _profile(keyed: DataFrame, key: str, id_col: str, text: str, window: int) -> DataFrame:
    """Per row: id, key, number of words, SHA-256 of all words, minimisers (twice if at two places)."""
    schema = T.StructType(
        [
            keyed.schema[id_col],
            T.StructField(key, T.BinaryType()),
            T.StructField("n_words", T.LongType()),
            T.StructField("words_sha", T.StringType()),
            T.StructField("minimisers", T.ArrayType(T.LongType())),
        ]
    )

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = text_bytes(batch.column(2))
        words, at = hashed_words(texts, SPACES, fold=False)
        owner, _, _, value, several = super_kmers(words, at, window)
        times = 1 + several.astype(np.int64)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(np.repeat(owner, times), minlength=len(texts)))])
        lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(signed(np.repeat(value, times))))
        shas = [hashlib.sha256(b" ".join(t.split())).hexdigest() for t in texts]
        return batch_of(schema.names, [batch.column(0), batch.column(1), pa.array(np.diff(at), pa.int64()), shas, lists])

    return keyed.select(id_col, key, text).mapInArrow(in_batches(one), schema)


def _filtered(keyed: DataFrame, key: str, bits, inside: bool) -> DataFrame:
    """Rows whose key is (or is not) in a filter."""
    names = keyed.columns

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = in_bloom(bits.value, _key_hashes(batch.column(names.index(key))))
        return batch.filter(pa.array(found if inside else ~found))

    return keyed.mapInArrow(in_batches(one), keyed.schema)


def _strings(texts: DataFrame, window: int, bits) -> DataFrame:
    """Super-k-mers whose minimiser may repeat, as strings, of rows (key, text, many)."""
    schema = "h long, key binary, start long, many boolean, packed string"

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = text_bytes(batch.column(1))
        words, at = hashed_words(own, SPACES, fold=False)
        owner, start, count, value, _ = super_kmers(words, at, window)
        go = np.flatnonzero(in_bloom(bits.value, signed(value)))
        packed, split, of = [], [], -1
        for t, s, n in zip(owner[go].tolist(), start[go].tolist(), count[go].tolist()):
            if t != of:
                of, split = t, own[t].split()
            packed.append(b" ".join(split[s : s + n + window - 1]))
        rows = pa.array(owner[go])
        return batch_of(
            ["h", "key", "start", "many", "packed"],
            [signed(value[go]), batch.column(0).take(rows), start[go], batch.column(2).take(rows), pa.array(packed, pa.binary()).cast(pa.string())],
        )

    return texts.mapInArrow(in_batches(one), schema)


def _groups(ids: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """A number for each window (given by its first word), equal for equal windows only: windows
    are sorted by hash and neighbours compared word by word."""
    h = window_hashes(mix(ids.astype(np.uint64)), window)[places]
    order = np.argsort(h, kind="stable")
    s = h[order]
    other = np.ones(len(order), dtype=bool)
    other[1:] = s[1:] != s[:-1]
    twin = np.flatnonzero(~other)
    across = np.arange(window)
    for a in range(0, len(twin), 1 << 14):  # a bounded number of pairs at a time
        t = twin[a : a + (1 << 14)]
        x, y = places[order[t]], places[order[t - 1]]
        unlike = (ids[x[:, None] + across] != ids[y[:, None] + across]).any(axis=1)
        if unlike.any():
            return _exact_groups(ids, places, window)
    out = np.empty(len(order), dtype=np.int64)
    out[order] = np.cumsum(other) - 1
    return out


def _exact_groups(ids: np.ndarray, places: np.ndarray, window: int) -> np.ndarray:
    """The same without hashes, for the case that two different windows share one."""
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(ids[p : p + window].tobytes(), len(seen)) for p in places.tolist()], dtype=np.int64)


def _bucket(rows: pa.Table, window: int) -> pa.RecordBatch | None:
    """Repeated stretches (key, first, last word + 1) of whole buckets, and for buckets dealt over
    several tasks one row per different window (`window`; without key if known to repeat)."""
    packed = [p.split(b" ") for p in rows.column("packed").cast(pa.binary()).to_pylist()]
    numbers: defaultdict[bytes, int] = defaultdict()
    numbers.default_factory = numbers.__len__
    lengths = np.array([len(p) for p in packed])
    ids = np.fromiter((numbers[w] for p in packed for w in p), dtype=np.int64, count=int(lengths.sum()))
    windows = lengths - window + 1
    base = np.cumsum(lengths) - lengths
    row = np.repeat(np.arange(len(packed)), windows)
    nth = np.arange(windows.sum()) - np.repeat(np.cumsum(windows) - windows, windows)
    group = _groups(ids, base[row] + nth, window)
    many, parts = rows.column("many").to_numpy(), rows.column("_salts").to_numpy()
    times = np.bincount(group) + np.bincount(group, weights=many[row].astype(np.int64)).astype(np.int64)
    repeated = times[group] > 1
    start = rows.column("start").to_numpy()
    # Stretches of repeated windows within a string.
    hit = np.flatnonzero(repeated & ~many[row])
    new = np.ones(len(hit), dtype=bool)
    new[1:] = (hit[1:] != hit[:-1] + 1) | (row[hit[1:]] != row[hit[:-1]])
    begin = np.flatnonzero(new)
    end = np.append(begin[1:], len(hit)) - 1 if len(begin) else begin
    owner = row[hit[begin]] if len(begin) else begin
    keys = rows.column("key").combine_chunks().take(pa.array(owner)).to_pylist()
    firsts = (start[owner] + nth[hit[begin]]).tolist() if len(begin) else []
    lasts = (start[owner] + nth[hit[end]] + window).tolist() if len(begin) else []
    texts: list[bytes | None] = [None] * len(keys)
    # One row per different window of a dealt bucket.
    dealt = np.flatnonzero(parts[row] > 1)
    if len(dealt):
        _, of = np.unique(group[dealt], return_index=True)
        all_keys = rows.column("key").to_pylist()
        for i in dealt[of].tolist():
            r, k = int(row[i]), int(nth[i])
            known = bool(repeated[i])
            keys.append(None if known else all_keys[r])
            firsts.append(int(start[r]) + k)
            lasts.append(int(start[r]) + k + window)
            texts.append(b" ".join(packed[r][k : k + window]))
    if not keys:
        return None
    arrays = [pa.array(keys, pa.binary()), pa.array(firsts, pa.int64()), pa.array(lasts, pa.int64()), pa.array(texts, pa.binary()).cast(pa.string())]
    return batch_of(["key", "first", "last", "window"], arrays)


def _stretches(strings: DataFrame, window: int) -> DataFrame:
    """Repeated stretches of each text from the strings of all buckets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        last = None

        def flush() -> Iterator[pa.RecordBatch]:
            out = _bucket(pa.Table.from_batches(held), window) if held else None
            if out is not None:
                yield out

        for batch in batches:
            h, salt = batch.column(0).to_numpy(), batch.column(6).to_numpy()
            cuts = np.flatnonzero((h[1:] != h[:-1]) | (salt[1:] != salt[:-1])) + 1
            bytes_at = batch.column(4).cast(pa.binary())
            ends = np.cumsum([len(x) for x in bytes_at.to_pylist()])
            at = 0
            for cut in [*([0] if held and last != (h[0], salt[0]) else []), *cuts.tolist()]:
                # Buckets are complete up to here.
                if size + (ends[cut - 1] - (ends[at - 1] if at else 0) if cut else 0) >= SORTED_BYTES:
                    if cut > at:
                        held.append(batch.slice(at, cut - at))
                    yield from flush()
                    held, size, at = [], 0, cut
            if at < batch.num_rows:
                held.append(batch.slice(at))
                size += int(ends[-1] - (ends[at - 1] if at else 0))
            last = (h[-1], salt[-1])
        yield from flush()

    partitions = int(strings.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = strings.repartition(partitions, "h", "_salt").sortWithinPartitions("h", "_salt")
    found = written(dealt.select("h", "key", "start", "many", "packed", "_salts", "_salt").mapInArrow(count, "key binary, first long, last long, window string"))
    # Windows of dealt buckets: a group has at most one row per part of its bucket.
    again = (
        found.filter(F.col("window").isNotNull())
        .groupBy("window")
        .agg(F.collect_list(F.struct("key", "first", "last")).alias("rows"))
        .filter((F.size("rows") > 1))
        .select(F.inline("rows"))
        .filter(F.col("key").isNotNull())
    )
    return found.filter(F.col("window").isNull()).select("key", "first", "last").unionByName(again)


def _plan(docs: DataFrame, id_col: str, text_col: str, window: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame, str]:
    """Keyed rows (id, key, text), their profile, keys of equal texts with counts, and for other
    texts the list of repeated stretches; with the name of the key column."""
    spark = bounded_batches(docs.sparkSession).sparkContext
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    key = "key"
    keyed = docs.select(F.col(id_col).alias("id"), text_key(F.col(text_col)).alias(key), F.col(text_col).alias("text"))
    profile = written(_profile(keyed, key, "id", "text", window))
    enough = profile.filter(F.size("minimisers") > 0)
    copied = written(enough.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.first("n_words").alias("n_words")).filter("_n > 1"))
    counts = enough.select(F.explode("minimisers").alias("h")).groupBy("h").agg(F.count(F.lit(1)).alias("_n"))
    repeated = written(counts.filter("_n > 1"))
    bits = spark.broadcast(bloom_bits(repeated, F.col("h"), bloom_slots(repeated.count(), FILTER_BITS)))
    copies = spark.broadcast(bloom_bits(copied, _key_hash(F.col(key)), bloom_slots(copied.count(), FILTER_BITS)))
    once = _filtered(keyed, key, copies, False).select(key, "text", F.lit(False).alias("many"))
    other = _filtered(keyed, key, copies, True).groupBy(key).agg(F.first("text").alias("text"), (F.count(F.lit(1)) > 1).alias("many"))
    strings = _strings(once, window, bits).unionByName(_strings(other, window, bits))
    hot = hot_keys(repeated, ["h"], repeated)
    parts = F.coalesce("_salts", F.lit(1))
    dealt = strings.join(F.broadcast(hot), "h", "left").select(
        "h", "key", "start", "many", "packed", parts.alias("_salts"), F.pmod(F.xxhash64("key", "start"), parts).cast("int").alias("_salt")
    )
    found = _stretches(dealt, window).repartition(partitions, key)
    marks = written(found.groupBy(key).agg(F.collect_list(F.struct("first", "last")).alias("stretches")))
    return keyed, profile, copied, marks, key


def _uncovered(words: list[bytes], stretches: list[dict]) -> list[bytes]:
    """Words in no stretch."""
    out: list[bytes] = []
    at = 0
    for first, last in sorted((s["first"], s["last"]) for s in stretches):
        if first > at:
            out += words[at:first]
        at = max(at, last)
    return out + words[at:]


def repeat_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Per input row: number of words, number of words removed, SHA-256 of the words kept (joined by
    one blank).

    A word is removed if a window of `window` words that covers it also starts elsewhere, in the
    same text or another one. Null and empty texts have no words; texts shorter than a window keep
    all words. Repeated rows and equal texts count as several texts, whatever their ids.
    """
    keyed, profile, copied, marks, key = _plan(docs, id_col, text_col, window)
    bits = keyed.sparkSession.sparkContext.broadcast(
        bloom_bits(marks, _key_hash(F.col(key)), bloom_slots(marks.count(), FILTER_BITS))
    )
    counts = copied.select(key, "_n")
    touched = keyed_join(_filtered(keyed.select(key, "text"), key, bits, True), marks, [key], "inner", counts=counts)

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        removed, shas = [], []
        for text, stretches in zip(text_bytes(batch.column(1)), batch.column(2).to_pylist()):
            words = text.split()
            kept = _uncovered(words, stretches)
            removed.append(len(words) - len(kept))
            shas.append(hashlib.sha256(b" ".join(kept)).hexdigest())
        return batch_of([key, "n_removed", "kept_sha256"], [batch.column(0), pa.array(removed, pa.int64()), shas])

    some = touched.select(key, "text", "stretches").mapInArrow(in_batches(one), f"{key} binary, n_removed long, kept_sha256 string")
    whole = copied.select(key, F.col("n_words").alias("n_removed"), F.lit(hashlib.sha256().hexdigest()).alias("kept_sha256"))
    outcome = written(some.unionByName(whole))
    out = keyed_join(profile.select("id", key, "n_words", "words_sha"), outcome, [key], "left", counts=counts)
    return out.select(
        F.col("id").alias(id_col),
        "n_words",
        F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("kept_sha256", "words_sha").alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, text_col: str = "text", kept_col: str = "kept", window: int = WINDOW) -> DataFrame:
    """Adds the words that stay, joined by one blank, to every row (rules as in `repeat_report`).
    A column named `kept_col` is replaced; other rows and columns stay."""
    _, _, copied, marks, _ = _plan(docs, text_col, text_col, window)
    names = [c for c in docs.columns if c.lower() != kept_col.lower()]
    key, flag, places = fresh(docs, "_key"), fresh(docs, "_copied"), fresh(docs, "_stretches")
    known = marks.select(F.col("key").alias(key), F.lit(False).alias(flag), F.col("stretches").alias(places))
    whole = copied.select(F.col("key").alias(key), F.lit(True).alias(flag), F.lit(None).cast(marks.schema["stretches"].dataType).alias(places))
    counts = copied.select(F.col("key").alias(key), "_n")
    joined = keyed_join(docs.withColumn(key, text_key(F.col(text_col))), written(known.unionByName(whole)), [key], "left", counts=counts)
    source = joined.select(*[F.col(f"`{c}`") for c in names], F.col(text_col).alias("_" + key), flag, places)
    schema = T.StructType([docs.schema[c] for c in names] + [T.StructField(kept_col, T.StringType())])

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = len(names)
        out = []
        for text, gone, stretches in zip(text_bytes(batch.column(n)), batch.column(n + 1).to_pylist(), batch.column(n + 2).to_pylist()):
            out.append(b"" if gone else b" ".join(_uncovered(text.split(), stretches or [])))
        return batch_of([*names, kept_col], [*[batch.column(i) for i in range(n)], pa.array(out, pa.binary()).cast(pa.string())])

    return source.mapInArrow(in_batches(one), schema)
