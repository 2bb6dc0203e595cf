"""Near duplicates by word shingles: an exact Jaccard join with grouped prefixes.

Every document is the set of its distinct word shingles. In one global order of shingles, two
sets that link share a shingle among their first `n - ceil(t n) + 1` ones (their prefixes).
Sets with identical prefixes and size form one group. Groups that share a prefix shingle form a
list; pairs of groups in a list pass the size bound, are expanded to their members, and members
are verified on whole sets.

* The order is by rarity: shingles of a single set first, then repeated ones, frequent ones last.
  Prefixes of most documents then hold shingles of a single set only, which match nothing and
  are left out. Repeated shingles, and those of many sets, are found by counting the hashes of all
  shingles of distinct sets, frequent ones block by block; a wrong guess there only costs work,
  because any order that is the same for all documents gives the same links, and no repeated
  shingle is ever taken for a single one.
* Prefixes travel packed as arrays, in buckets of shingles. A frequent shingle is spread over
  buckets by group, so none holds more than its share.
* Pairs of short lists are counted over their lists first: too few common prefix shingles leave
  no room for a link. Long lists of copies overlap much. Those whose leader (the member in most
  lists) is the same are compared as one group.
* Members of a group of several blocks are first compared with the leader alone. Pairs of members
  that link with it add nothing to the components, so only the others are compared with all, in
  cells of two blocks of members each; near copies of one text cost linear time. A cell reports no
  pairs but at most one link per member that joins it to its component. No link between components
  is lost.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import (
    batch_of,
    bloom_bits,
    bloom_slots,
    fresh,
    in_batches,
    in_bloom,
    in_sorted,
    maybe_among,
    prepare,
    signed,
    swept,
    text_bytes,
    written,
)
from unitledger.llm.words import SPACES, mix, shingle_sets
from unitledger.operators.skew import broadcast_limit, keyed_join, plan_bytes
from unitledger.operators.spatial import connected_components

#: A shingle is called frequent where at least so many sets of a block, and this share, hold it.
FREQUENT_SETS, FREQUENT_SHARE = 4, 0.0005
#: Longest list of frequent shingles (16 bytes each); the most frequent come first.
FREQUENT_MOST = 1 << 18
#: Shingles counted together in a task.
BLOCK_SHINGLES = 4_000_000
#: Shingles (5 bytes each) of one range of hashes, which one task counts at a time.
RANGE_SHINGLES = 1_000_000
#: Bits of the filter of repeated shingles at most (32 MB); that of shingles of many sets has a quarter of them.
FILTER_BITS = 1 << 28
#: Prefix entries (20 bytes each) of one bucket, which one task holds at a time.
BUCKET_ENTRIES = 500_000
#: Lists of up to so many sets give pairs, longer ones are compared as groups.
SHORT_LIST = 8
#: Weight of a list whose members have the whole prefix in common.
ALL_COMMON = 1 << 30
#: Sets, and shingles of them, in one block; a task compares two blocks at a time.
BLOCK_SETS, BLOCK_TOTAL = 256, 1_000_000
#: Columns of a membership matrix held at a time.
SLICE = 4096


def set_id(shingles: np.ndarray) -> int:
    """64 bits that name a set; sets of all documents are told apart by it."""
    return int.from_bytes(hashlib.blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def prefix_length(n: int, percent: int) -> int:
    return n - (-(-n * percent // 100)) + 1


def _frequent(block: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The frequent shingles of a block's sets, ascending, and their counts. Empties the block, as its
    shingles are sorted in one copy: other arrays are as short as the list of frequent ones."""
    least = max(FREQUENT_SETS, int(np.ceil(FREQUENT_SHARE * len(block))))
    values = np.concatenate(list(block.values()))
    block.clear()
    values.sort()
    first = values[: max(0, len(values) - least + 1)]
    found = first[first == values[least - 1 :]]
    found = found[np.append(True, found[1:] != found[:-1])[: len(found)]]
    return found, np.searchsorted(values, found, "right") - np.searchsorted(values, found)


def _describe(k: int, id_type: pa.DataType):
    """Rows (id, n, set) of documents, and rows (shingle, seen) of a block's frequent shingles."""

    def counted(block: dict[int, np.ndarray]) -> pa.RecordBatch | None:
        values, seen = _frequent(block)
        if not len(values):
            return None
        none = pa.nulls(len(values), pa.int64())
        return batch_of(["id", "n", "set", "shingle", "seen"], [none.cast(id_type), none, none, signed(values), seen])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: dict[int, np.ndarray] = {}
        held = 0
        for batch in batches:
            sizes, names = [], []
            for s in shingle_sets(text_bytes(batch.column(1)), SPACES, k):
                sizes.append(len(s))
                names.append(set_id(s) if len(s) else None)
                if len(s) and names[-1] not in block:
                    block[names[-1]] = s
                    held += len(s)
            none = pa.nulls(batch.num_rows, pa.int64())
            yield batch_of(
                ["id", "n", "set", "shingle", "seen"],
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(names, pa.int64()), none, none],
            )
            if held >= BLOCK_SHINGLES:
                if (out := counted(block)) is not None:
                    yield out
                block, held = {}, 0
        if block and (out := counted(block)) is not None:
            yield out

    return run


class Repeated:
    """Filters of the shingles that at least two sets hold, and of those that more than `SHORT_LIST`
    sets do, in one slice per range of hashes.

    The first never misses one. Their sizes follow the input up to `FILTER_BITS`. Beyond that they
    let more shingles through, which costs work and loses nothing; a slice with many keys sets fewer
    bits for each, so that it does so as late as it can.
    """

    def __init__(self, log_ranges: int, total: int):
        self.log_ranges = log_ranges
        per_range = max(1024, min(FILTER_BITS, 2 * total) >> log_ranges)
        most = int(np.log2(per_range))
        self.log_bits = (most, most - 2)
        self.words = [np.zeros((1 << log_ranges) << (bits - 6), dtype=np.uint64) for bits in self.log_bits]
        self.marks = [np.full(1 << log_ranges, 3, dtype=np.uint8) for _ in self.log_bits]

    def split(self, shingles: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range, and the 40 bits below it, of each hash."""
        shift = np.uint64(64 - self.log_ranges)
        key = (shingles >> np.uint64(24 - self.log_ranges)) & np.uint64((1 << 40) - 1)
        return (shingles >> shift).astype(np.int64), key

    def slots(self, key: np.ndarray, level: int) -> list[np.ndarray]:
        h = mix(key)
        return [(h >> np.uint64(s)) & np.uint64((1 << self.log_bits[level]) - 1) for s in (0, 20, 40)]

    def slice_of(self, keys: np.ndarray, level: int) -> tuple[int, np.ndarray]:
        """How many bits each key sets, and the words."""
        bits = self.log_bits[level]
        marks = int(np.clip(np.round(np.log(2) * (1 << bits) / max(1, len(keys))), 1, 3))
        out = np.zeros(1 << (bits - 6), dtype=np.uint64)
        for slot in self.slots(keys, level)[:marks]:
            np.bitwise_or.at(out, (slot >> np.uint64(6)).astype(np.int64), np.uint64(1) << (slot & np.uint64(63)))
        return marks, out

    def put(self, part: int, level: int, marks: int, words: np.ndarray) -> None:
        each = 1 << (self.log_bits[level] - 6)
        self.words[level][part * each : (part + 1) * each] = words
        self.marks[level][part] = marks

    def holds(self, shingles: np.ndarray, level: int) -> np.ndarray:
        ranges, key = self.split(shingles)
        start = ranges << (self.log_bits[level] - 6)
        marks = self.marks[level][ranges]
        found = np.ones(len(shingles), dtype=bool)
        for i, slot in enumerate(self.slots(key, level)):
            word = self.words[level][start + (slot >> np.uint64(6)).astype(np.int64)]
            found &= (marks <= i) | ((word >> (slot & np.uint64(63))) & np.uint64(1) == 1)
        return found

    def order(self, shingles: np.ndarray) -> np.ndarray:
        """0 for shingles of one set, 1 for repeated ones, 2 for those of many sets."""
        out = self.holds(shingles, 0).astype(np.int64)
        some = np.flatnonzero(out)
        out[some] += self.holds(shingles[some], 1)
        return out


def _texts(batch: pa.RecordBatch, wanted) -> list[bytes]:
    """The texts of a batch of (hashed id, text) whose id may be wanted."""
    hashed = batch.column(0).to_numpy(zero_copy_only=False)
    return text_bytes(batch.filter(pa.array(in_bloom(wanted.value, hashed))).column(1))


def _keys(k: int, frequent, repeated: Repeated, first):
    """Packed hashes (5 bytes each) by range; a batch gives each shingle at most twice."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        own = {set_id(s): s for s in shingle_sets(_texts(batch, first), SPACES, k) if len(s)}
        if not own:
            return None
        values, seen = np.unique(np.concatenate(list(own.values())), return_counts=True)
        keep = ~in_sorted(frequent.value[0], values)[1]
        values = np.repeat(values[keep], np.minimum(seen[keep], 2))
        if not len(values):
            return None
        ranges, key = repeated.split(values)  # sorted, so ranges follow each other
        names, starts = np.unique(ranges, return_index=True)
        packed = np.ascontiguousarray(key.view(np.uint8).reshape(-1, 8)[:, :5])
        parts = [x.tobytes() for x in np.split(packed, starts[1:])]
        return batch_of(["part", "keys"], [pa.array(names, pa.int32()), pa.array(parts, pa.binary())])

    return in_batches(one)


def _slices(repeated: Repeated):
    def run(table: pa.Table) -> pa.Table:
        raw = np.frombuffer(b"".join(table.column("keys").to_pylist()), dtype=np.uint8).reshape(-1, 5)
        wide = np.zeros((len(raw), 8), dtype=np.uint8)
        wide[:, :5] = raw
        keys, seen = np.unique(wide.view(np.uint64).ravel(), return_counts=True)
        part = table.column("part")[0].as_py()
        marks, words = zip(*(repeated.slice_of(keys[seen > more], level) for level, more in enumerate((1, SHORT_LIST))))
        return pa.table(
            [
                pa.array([part, part], pa.int32()),
                pa.array([0, 1], pa.int32()),
                pa.array(marks, pa.int32()),
                pa.array([x.tobytes() for x in words], pa.binary()),
            ],
            names=["part", "level", "marks", "words"],
        )

    return run


def _prefixes(k: int, percent: int, buckets: int, frequent, repeated, first):
    """Packed prefix entries by bucket, and the members of each group (bucket below zero).

    Shingles of a single set come first in the order; they match nothing and are left out.
    """

    def packed(bucket: int, *arrays: np.ndarray) -> tuple:
        return (bucket, *(x.tobytes() for x in arrays))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        common, rank = frequent.value
        entries: dict[int, tuple[np.ndarray, int]] = {}
        members: dict[int, tuple[int, int]] = {}
        sets = list(shingle_sets(_texts(batch, first), SPACES, k))
        shingles = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
        at, often = in_sorted(common, shingles)
        # 0 for shingles of one set, 1 for repeated ones, 2 for those of many, above that the count of frequent ones
        order = np.where(often, rank[at] + 1 if len(rank) else 1, repeated.value.order(shingles))
        stop = 0
        for s in sets:
            start, stop = stop, stop + len(s)
            length = prefix_length(len(s), percent)
            own = order[start:stop]
            single = int((own == 0).sum())
            if single >= length:
                continue
            name = set_id(s)
            if name in members:
                continue
            prefix = s[np.argsort(own, kind="stable")[single:length]]
            group = set_id(np.append(prefix, np.array([len(s), single], dtype=np.uint64)))
            members[name] = (group, len(s))
            entries[group] = (prefix, len(s))
        if not members:
            return None
        lengths = [len(p) for p, _ in entries.values()]
        tokens = np.concatenate([p for p, _ in entries.values()])
        groups = np.repeat(np.array(list(entries), dtype=np.int64), lengths)
        sizes = np.repeat(np.array([n for _, n in entries.values()], dtype=np.int32), lengths)
        _, hot = in_sorted(common, tokens)
        bucket = (tokens >> np.uint64(40)).astype(np.int64) % buckets
        spread = (mix(tokens ^ groups.view(np.uint64)) >> np.uint64(40)).astype(np.int64) % buckets
        bucket = np.where(hot, buckets + spread, bucket)
        order = np.argsort(bucket, kind="stable")
        own, starts = np.unique(bucket[order], return_index=True)
        rows = [
            packed(b, tokens[part], groups[part], sizes[part])
            for b, part in zip(own.tolist(), np.split(order, starts[1:]))
        ]
        names = np.array(list(members), dtype=np.int64)
        of = np.array([g for g, _ in members.values()], dtype=np.int64)
        n = np.array([n for _, n in members.values()], dtype=np.int32)
        place = of % buckets
        rows += [packed(-1 - b, names[place == b], of[place == b], n[place == b]) for b in np.unique(place).tolist()]
        kinds = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        return batch_of(["bucket", "a", "b", "c"], [pa.array(x, t) for x, t in zip(zip(*rows), kinds)])

    return in_batches(one)


LISTS = T.StructType(
    [T.StructField("list", T.LongType()), T.StructField("grp", T.LongType()), T.StructField("set", T.LongType()), T.StructField("size", T.IntegerType()), T.StructField("weight", T.IntegerType())]
)


def _gather(buckets: int):
    """A bucket's lists of groups with a common shingle; a bucket's members of groups.

    Each distinct list comes once, its weight being the number of shingles it stands for.
    """

    def rows(lists, groups, sets, sizes, weights) -> pa.Table:
        n = len(groups)
        full = lambda x: pa.nulls(n, pa.int64()) if x is None else pa.array(x)
        weights = np.full(n, 1) if weights is None else weights
        return pa.table(
            [full(lists), full(groups), full(sets), pa.array(sizes, pa.int32()), pa.array(weights, pa.int32())],
            names=LISTS.names,
        )

    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        a, b, c = (
            np.concatenate([np.frombuffer(x, dtype=t) for x in table.column(name).to_pylist()])
            for name, t in (("a", np.uint64), ("b", np.int64), ("c", np.int32))
        )
        if bucket < 0:
            _, first = np.unique(a, return_index=True)
            return rows(None, b[first], a.view(np.int64)[first], c[first], None)
        order = np.lexsort((b, a))
        a, b, c = a[order], b[order], c[order]
        new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1]))
        a, b, c = a[new], b[new], c[new]
        if bucket >= buckets:  # parts of frequent shingles: the shingle names the list
            return rows(a.view(np.int64), b, None, c, None)
        starts = np.flatnonzero(np.append(True, a[1:] != a[:-1]))
        lengths = np.diff(starts, append=len(a))
        names = mix(np.add.reduceat(mix(b.view(np.uint64)), starts) + lengths.astype(np.uint64))
        names, first, weights = np.unique(np.where(lengths > 1, names, np.uint64(0)), return_index=True, return_counts=True)
        real = names != 0
        names, first, weights = names[real], first[real], weights[real]
        keep = [np.arange(starts[i], starts[i] + lengths[i]) for i in first]
        keep = np.concatenate(keep) if keep else np.zeros(0, dtype=np.int64)
        times = lengths[first]
        return rows(np.repeat(names.view(np.int64), times), b[keep], None, c[keep], np.repeat(weights, times))

    return run


def _whole_sets(k: int, wanted):
    """(set, shingles) of the documents whose hashed id may be wanted."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        own = {set_id(s): s.tobytes() for s in shingle_sets(_texts(batch, wanted), SPACES, k) if len(s)}
        if not own:
            return None
        return batch_of(["set", "shingles"], [pa.array(list(own), pa.int64()), pa.array(list(own.values()), pa.binary())])

    return in_batches(one)


def linked(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Places (member, first of its component) for the links among some sets, exactly.

    Overlaps of all pairs are one product of membership matrices over the shingles that at least
    two of the sets hold, taken in slices of columns.
    """
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    values = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), sizes)
    _, value, seen = np.unique(values, return_inverse=True, return_counts=True)
    column = np.cumsum(seen > 1) - 1
    shared = seen[value] > 1
    of, column = of[shared], column[value[shared]]
    order = np.argsort(column, kind="stable")
    of, column = of[order], column[order]
    both = np.zeros((len(sets), len(sets)), dtype=np.float64)
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, SLICE):
        a, b = np.searchsorted(column, [low, low + SLICE])
        held = np.zeros((len(sets), min(SLICE, int(column[b - 1]) - low + 1)), dtype=np.float32)
        held[of[a:b], column[a:b] - low] = 1
        both += held @ held.T
    near = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    label = np.arange(len(sets))
    while True:
        lower = np.where(near, label[None, :], len(sets)).min(axis=1)
        lower = np.minimum(label, lower)
        lower = lower[lower]
        if (lower == label).all():
            break
        label = lower
    return [(i, int(label[i])) for i in np.flatnonzero(label != np.arange(len(sets))).tolist()]


def _leader_links(percent: int):
    """Members of each part of a group that link with its leader; a part's rows follow each other,
    the leader's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.zeros(0, dtype=np.uint64)
        for batch in batches:
            out: list[tuple[int, int]] = []
            columns = (batch.column(c).to_pylist() for c in ("leader", "set", "shingles"))
            for led, name, shingles in zip(*columns):
                shingles = np.frombuffer(shingles, dtype=np.uint64)
                if name == led:
                    leader, own = led, np.sort(shingles)
                    continue
                both = int(in_sorted(own, shingles)[1].sum()) if leader == led else 0
                if 100 * both >= percent * (len(own) + len(shingles) - both):
                    out.append((led, name))
            if out:
                yield batch_of(["leader", "set"], [pa.array(c, pa.int64()) for c in zip(*out)])

    return run


def _cell_links(percent: int):
    """Links of each cell; the rows of a cell follow each other."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, names, sets = None, [], []

        def close() -> list[tuple[int, int]]:
            return [(names[i], names[j]) for i, j in linked(sets, percent)] if len(sets) > 1 else []

        for batch in batches:
            out: list[tuple[int, int]] = []
            keys = zip(*(batch.column(c).to_pylist() for c in ("leader", "i", "j")))
            for key, name, shingles in zip(keys, batch.column("set").to_pylist(), batch.column("shingles").to_pylist()):
                if key != cell:
                    out += close()
                    cell, names, sets = key, [], []
                names.append(name)
                sets.append(np.frombuffer(shingles, dtype=np.uint64))
            if out:
                yield batch_of(["a", "b"], [pa.array(c, pa.int64()) for c in zip(*out)])
        if out := close():
            yield batch_of(["a", "b"], [pa.array(c, pa.int64()) for c in zip(*out)])

    return run


def ngram_components(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75
) -> DataFrame:
    """Components of documents whose shingle sets have a Jaccard similarity of `percent` or more.

    Words are runs of other characters than blanks, tab to carriage return; A-Z count as a-z. A
    text of fewer than `k` words is one shingle; null, empty and blank texts have no set and link
    with nothing. Returns one row per input row: the id, `n_shingles`, `set_id` (equal for equal
    sets, null without a set), and `component_id`, the smallest id reachable. Repeated rows and
    repeated ids are kept; a null id is never the smallest unless a component has no other. Other
    columns of `docs` are not looked at.
    """
    return _placed(docs, id_col, text_col, k, percent).select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.col("set").alias("set_id"), "component_id"
    )


def _placed(docs: DataFrame, id_col: str, text_col: str, k: int, percent: int) -> DataFrame:
    """One row per input row: id, n, set, `component` (a set of the component, null without one) and `component_id`."""
    spark = prepare(docs.sparkSession)
    context = spark.sparkContext
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    id_type = source.schema["id"].dataType
    arrow_id = pa.int64() if isinstance(id_type, T.LongType) else pa.int32() if isinstance(id_type, T.IntegerType) else pa.string()
    described = written(
        source.mapInArrow(
            _describe(k, arrow_id),
            T.StructType(
                [T.StructField("id", id_type)] + [T.StructField(c, T.LongType()) for c in ("n", "set", "shingle", "seen")]
            ),
        )
    )
    documents = described.filter("shingle is null").select("id", "n", "set")
    top = (
        described.filter("shingle is not null")
        .groupBy("shingle")
        .agg(F.sum("seen").alias("seen"))
        .orderBy(F.desc("seen"), "shingle")
        .limit(FREQUENT_MOST)
        .toArrow()
    )
    shingles = top.column("shingle").to_numpy().view(np.uint64)
    order = np.argsort(shingles)
    frequent = context.broadcast((shingles[order], top.column("seen").to_numpy()[order]))

    # Distinct sets with the smallest id of their documents. Only documents with such an id are looked
    # at further: copies of a set add nothing to lists, and its shingles are no more frequent for them.
    sets = written(
        documents.filter("set is not null").groupBy("set").agg(F.min("id").alias("least"), F.max("n").alias("n")), narrow=True
    )
    first = context.broadcast(bloom_bits(sets, F.xxhash64("least"), bloom_slots(sets.count())))
    hashed = source.select(F.xxhash64("id").alias("h"), "text")

    total = described.agg(F.sum("n")).first()[0] or 0
    repeated = Repeated(int(np.clip(np.ceil(np.log2(total / RANGE_SHINGLES + 1)), 4, 16)), total)
    slices = (
        hashed.mapInArrow(_keys(k, frequent, repeated, first), "part int, keys binary")
        .groupBy("part")
        .applyInArrow(_slices(repeated), "part int, level int, marks int, words binary")
        .toArrow()
    )
    swept(spark)
    for part, level, marks, words in zip(*(x.to_pylist() for x in slices.columns)):
        repeated.put(part, level, marks, np.frombuffer(words, dtype=np.uint64))
    repeated = context.broadcast(repeated)

    buckets = int(2 ** np.ceil(np.log2(max(16, total * (100 - percent) / 100 / BUCKET_ENTRIES))))
    lists = written(
        hashed.mapInArrow(
            _prefixes(k, percent, buckets, frequent, repeated, first), "bucket int, a binary, b binary, c binary"
        )
        .groupBy("bucket")
        .applyInArrow(_gather(buckets), LISTS)
    )
    swept(spark)
    members = written(lists.filter("list is null").select("grp", "set", "size").distinct(), narrow=True)
    grouped = lists.filter("list is not null").groupBy("list", "grp", "size").agg(F.sum("weight").alias("weight"))
    # A group of several sets is a list of its own.
    crowded = members.groupBy("grp").agg(F.count("*").alias("sets")).filter("sets > 1").select("grp")
    listed = written(
        grouped.join(members.select("grp", "set"), "grp")
        .select("list", "set", "size", "weight")
        .unionByName(
            members.join(crowded, "grp").select(F.col("grp").alias("list"), "set", "size", F.lit(ALL_COMMON).alias("weight"))
        ),
        narrow=True,
    )
    fits = F.expr(f"100 * low >= {percent} * high")

    def bounded(rows: DataFrame, key: str) -> DataFrame:
        """Size and number of members of each key's rows, without keys whose only pair differs too much in size."""
        return (
            rows.groupBy(key)
            .agg(F.count("*").alias("n"), F.min("size").alias("low"), F.max("size").alias("high"), F.sum("size").alias("all"))
            .filter((F.col("n") > 2) | ((F.col("n") == 2) & fits))
        )

    open_lists = written(listed.join(bounded(listed, "list").select("list", "n"), "list"), narrow=True)
    # Pairs of short lists with the number of shingles their prefixes share. Of the set whose
    # prefix ends first, all other prefix shingles are missing in the other set.
    short = open_lists.filter(F.col("n") <= SHORT_LIST)
    rest = F.expr(f"greatest((size_a * {percent}L + 99) div 100, (size_b * {percent}L + 99) div 100) - 1")
    pairs = (
        short.select("list", F.col("set").alias("a"), F.col("size").alias("size_a"), "weight")
        .join(short.select("list", F.col("set").alias("b"), F.col("size").alias("size_b")), "list")
        .filter("a < b")
        .filter(f"100 * least(size_a, size_b) >= {percent} * greatest(size_a, size_b)")
        .groupBy("a", "b", "size_a", "size_b")
        .agg(F.sum("weight").alias("common"))
        .filter((100 + percent) * (F.col("common") + rest) >= percent * (F.col("size_a") + F.col("size_b")))
    )
    ends = F.array(F.struct(F.col("a").alias("set"), F.col("size_a").alias("size")), F.struct(F.col("b").alias("set"), F.col("size_b").alias("size")))
    of_pairs = pairs.select(F.col("a").alias("leader"), F.inline(ends))
    # Long lists with the same leader, the member in most lists, are compared together: copies of
    # one text share many lists, and each pair of a list is a pair of its leader's group.
    long = open_lists.filter(F.col("n") > SHORT_LIST)
    degree = long.groupBy("set").agg(F.count("*").alias("lists"))
    leaders = (
        long.join(degree, "set").groupBy("list").agg(F.max_by("set", F.struct("lists", "set")).alias("leader"))
    )
    of_lists = long.join(leaders, "list").select("leader", "set", "size")
    groups = written(of_lists.unionByName(of_pairs).distinct(), narrow=True)
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def blocks(n: Column, shingles: Column) -> Column:
        return F.ceil(F.greatest(n / BLOCK_SETS, shingles / BLOCK_TOTAL)).cast("int")

    def block_of(count: str) -> Column:
        return F.expr(f"cast(pmod(xxhash64(set), {count}) as int)")

    def with_shingles(rows: DataFrame) -> DataFrame:
        """Rows that name a set, with its shingles taken from one of its texts."""
        named = rows.select("set").distinct()
        wanted = written(named.join(sets, "set").select(F.xxhash64("least").alias("h")), narrow=True)
        bits = context.broadcast(bloom_bits(wanted, F.col("h"), bloom_slots(wanted.count())))
        whole = (
            hashed.mapInArrow(_whole_sets(k, bits), "set long, shingles binary")
            .join(named, "set", "left_semi")
            .dropDuplicates(["set"])
        )
        return keyed_join(rows, whole, ["set"], "inner")

    sized = bounded(groups, "leader").select("leader", blocks(F.col("n"), F.col("all")).alias("blocks"))
    placed = written(groups.join(sized, "leader"), narrow=True)
    one_cell = placed.filter("blocks = 1").select("leader", "set", F.lit(0).alias("i"), F.lit(0).alias("j"))
    large = placed.filter("blocks > 1")
    cells, links = one_cell, None
    if not large.isEmpty():
        parts = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part")
        rows = (
            large.filter("set <> leader").select("leader", "set", block_of("blocks").alias("part"))
            .unionByName(large.filter("set = leader").select("leader", "set", parts))
        )
        links = written(
            with_shingles(written(rows, narrow=True))
            .repartition(partitions, "leader", "part")
            .sortWithinPartitions("leader", "part", F.col("set") != F.col("leader"))
            .mapInArrow(_leader_links(percent), "leader long, set long")
        )
        swept(spark)
        near = F.col("near") | (F.col("set") == F.col("leader"))
        judged = large.join(links.withColumn("near", F.lit(True)), ["leader", "set"], "left")
        judged = judged.select("leader", "set", "size", F.coalesce(near, F.lit(False)).alias("near"))
        # Blocks of the members that are not near come first; only they meet all blocks.
        shares = judged.groupBy("leader").agg(
            *[
                blocks(F.count(F.when(side, 1)), F.coalesce(F.sum(F.when(side, F.col("size"))), F.lit(0))).alias(name)
                for name, side in (("near_blocks", F.col("near")), ("far_blocks", ~F.col("near")))
            ]
        )
        dealt = judged.join(shares.filter("far_blocks > 0"), "leader").select(
            "leader",
            "set",
            F.when(F.col("near"), F.col("far_blocks") + block_of("near_blocks")).otherwise(block_of("far_blocks")).alias("own"),
            F.explode(
                F.sequence(F.lit(0), F.col("far_blocks") - 1 + F.when(F.col("near"), 0).otherwise(F.col("near_blocks")))
            ).alias("other"),
        )
        cells = one_cell.unionByName(
            dealt.select("leader", "set", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
        )
    compared = (
        with_shingles(written(cells, narrow=True))
        .repartition(partitions, "leader", "i", "j")
        .sortWithinPartitions("leader", "i", "j", "set")
        .mapInArrow(_cell_links(percent), "a long, b long")
    )
    if links is not None:
        compared = compared.unionByName(links.select(F.col("leader").alias("a"), F.col("set").alias("b")))
    links = written(compared.distinct(), narrow=True)
    swept(spark)
    placed = connected_components(links, "a", "b")
    of_component = (
        sets.join(placed.withColumnRenamed("node", "set"), "set", "left")
        .select("set", "least", F.coalesce("component", "set").alias("component"))
    )
    lowest = of_component.groupBy("component").agg(F.min("least").alias("component_id"))
    of_set = of_component.join(lowest, "component").select("set", "component", "component_id")
    joined = keyed_join(documents, of_set, ["set"], "left")
    return joined.select(
        "id", "n", "set", "component", F.when(F.col("set").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id")
    )


def _own_sets(k: int, text_at: int):
    """The input columns and the set of each row's text, null without one."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        own = [set_id(s) if len(s) else None for s in shingle_sets(text_bytes(batch.column(text_at)), SPACES, k)]
        return pa.RecordBatch.from_arrays([*batch.columns, pa.array(own, pa.int64())], names=[*batch.schema.names, "set"])

    return in_batches(one)


def _row_digest(docs: DataFrame) -> Column:
    """A hash of all columns of a row."""
    return F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in t or "variant" in t else F.col(c) for c, t in docs.dtypes])


def one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75) -> DataFrame:
    """The documents with one row of each component kept: of those with the smallest id that of the
    smallest set, of equal ones the row with the smallest digest.

    Where several texts share an id, each goes or stays with its own component. Documents without
    a set and those without an id stay. All columns are kept.
    """
    rows = _placed(docs, id_col, text_col, k, percent).filter("id is not null")
    pairs = written(
        rows.groupBy("id", "set").agg(
            F.count("*").alias("n"), F.first("component").alias("component"), F.first("component_id").alias("component_id")
        )
    )
    # Of the texts that have their component's smallest id one stays.
    least = pairs.filter("set is not null and id = component_id")
    chosen = least.groupBy("component").agg(F.min("set").alias("set")).select("set", F.lit(True).alias("stays"))
    judged = (
        least.join(chosen, "set", "left")
        .select("id", "set", "n", F.coalesce("stays", F.lit(False)).alias("stays"))
        .unionByName(pairs.filter("set is null or id <> component_id").select("id", "set", "n", F.col("set").isNull().alias("stays")))
    )
    # An id whose rows all stay or all go decides alone; rows of the others are looked at one by one.
    decided = written(
        judged.groupBy("id").agg(
            F.expr("every(stays and (n = 1 or set is null))").alias("stay"), F.expr("every(not stays)").alias("go")
        )
    )
    by_id = written(decided.filter("not stay").select("id", "go"))
    gone = fresh(docs, "_gone")
    not_staying = by_id.select(F.col("id").alias(gone))
    same_id = F.col(id_col) == F.col(gone)
    if plan_bytes(not_staying) <= broadcast_limit(docs):
        kept = docs.join(not_staying, same_id, "left_anti")
    elif 2 * by_id.count() <= decided.count():
        # A join moves whole rows, so only those that may go are joined, or only those that may stay.
        open_rows, sure = maybe_among(docs, id_col, by_id.select("id"))
        kept = sure.unionByName(open_rows.join(not_staying, same_id, "left_anti"))
    else:
        open_rows, _ = maybe_among(docs.filter(F.col(id_col).isNotNull()), id_col, decided.filter("stay").select("id"))
        kept = docs.filter(F.col(id_col).isNull()).unionByName(open_rows.join(not_staying, same_id, "left_anti"))
    mixed = by_id.filter("not go").select(F.col("id").alias(gone))
    if mixed.isEmpty():
        return kept
    names = [f"c{i}" for i in range(len(docs.columns))]
    looked_at = docs if plan_bytes(mixed) <= broadcast_limit(docs) else maybe_among(docs, id_col, mixed.toDF("id"))[0]
    open_rows = looked_at.join(mixed, same_id, "left_semi").toDF(*names)
    id_at, text_at = docs.columns.index(id_col), docs.columns.index(text_col)
    schema = T.StructType([*open_rows.schema.fields, T.StructField("set", T.LongType())])
    open_rows = written(open_rows.mapInArrow(_own_sets(k, text_at), schema))
    stays = judged.filter("stays and set is not null").select(F.col("id").alias(names[id_at]), "set")
    # The copies are aggregated first, so that a row repeated often needs no task of its own.
    picked = (
        open_rows.filter("set is not null")
        .groupBy(names[id_at], "set")
        .agg(F.min_by(F.struct(*names), _row_digest(open_rows.select(*names))).alias("row"))
        .join(stays, [names[id_at], "set"], "left_semi")
        .select("row.*")
    )
    without = open_rows.filter("set is null").select(*names)
    return kept.unionByName(picked.unionByName(without).toDF(*docs.columns))
