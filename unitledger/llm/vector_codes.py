"""Product codes for vectors, with nearest codebook entries found by a GNAT.

Vectors become whole numbers and are cut into equal parts; each part position has a codebook that
a few rounds of exact Lloyd iteration refine. Rows stay where they are: a round broadcasts the
codebooks (at most 256 entries of one vector's size in all parts together) and brings back sums
per entry.

The nearest entry is found in a geometric near-neighbour access tree over the entries: a node has
split points, each other entry hangs below its nearest one, and the node stores for every split
point and child the least and largest distance from that point to the child's entries. A query's
distances to the split points rule out whole children strictly: only where every entry is surely
farther than the best one known. Bounds are widened beyond rounding; the decision among what is
left compares whole numbers, ties go to the lower index.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import batch_of, in_batches, bounded_batches, written
from unitledger.operators.skew import keyed_join

SCALE, PARTS, ENTRIES, ROUNDS = 1024, 4, 256, 4
#: Children of a node; a node of fewer than twice as many entries is a leaf.
SPLITS = 12
#: Relative slack of distances as floating numbers; their own error is below 1e-15.
SLACK = 1e-12


def largest_component(dimension: int) -> int:
    """Up to here squared distances of whole vectors fit 63 bits."""
    return isqrt((2**63 - 1) // (4 * max(dimension, 1)))


def squared(points: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of whole-number points (rows) to entries (columns)."""
    reach = max((int(np.abs(x).max()) if x.size else 0) for x in (points, entries))
    if 4 * reach * reach * max(points.shape[1], 1) < 2**53:  # every sum on the way is exact
        p, e = points.astype(np.float64), entries.astype(np.float64)
        return ((p * p).sum(axis=1)[:, None] - 2 * (p @ e.T) + (e * e).sum(axis=1)).astype(np.int64)
    out = np.zeros((len(points), len(entries)), dtype=np.int64)
    for j in range(points.shape[1]):
        gap = points[:, j, None] - entries[None, :, j]
        out += gap * gap
    return out


@dataclass
class Node:
    """Split points (entry numbers), children, and by split point and child the least and largest
    distance from the point to any entry of the child."""

    points: np.ndarray
    children: list[Node | None] = field(default_factory=list)
    low: np.ndarray | None = None
    high: np.ndarray | None = None


def build(entries: np.ndarray, members: np.ndarray | None = None) -> Node:
    """The tree over entries. Split points are chosen far from each other, the first entry first."""
    members = np.arange(len(entries)) if members is None else members
    if len(members) < 2 * SPLITS:
        return Node(members)
    apart = squared(entries[members], entries[members[:1]])[:, 0]
    chosen = [0]
    while len(chosen) < SPLITS:
        far = int(apart.argmax())
        if apart[far] == 0:  # the rest repeats the chosen ones
            break
        chosen.append(far)
        apart = np.minimum(apart, squared(entries[members], entries[members[[far]]])[:, 0])
    if len(chosen) == 1:
        return Node(members)
    points = members[chosen]
    rest = np.delete(members, chosen)
    gaps = np.sqrt(squared(entries[rest], entries[points]).astype(np.float64))
    nearest = gaps.argmin(axis=1)
    node = Node(points, [], np.full((len(points), len(points)), np.inf), np.full((len(points), len(points)), -np.inf))
    for child in range(len(points)):
        own = np.flatnonzero(nearest == child)
        node.children.append(build(entries, rest[own]) if len(own) else None)
        if len(own):
            node.low[:, child] = gaps[own].min(axis=0) * (1 - SLACK)
            node.high[:, child] = gaps[own].max(axis=0) * (1 + SLACK)
    return node


class Nearest:
    """Nearest entry of a codebook for many points at once."""

    def __init__(self, entries: np.ndarray):
        self.entries, self.root = entries, build(entries)

    def __call__(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry of each point (the lower one of equals) and its squared distance."""
        self.best = np.full(len(points), np.iinfo(np.int64).max)
        self.index = np.full(len(points), len(self.entries))
        self.points = points
        self._search(self.root, np.arange(len(points)))
        return self.index, self.best

    def _offer(self, rows: np.ndarray, numbers: np.ndarray, gaps: np.ndarray) -> None:
        order = np.argsort(numbers)
        at = order[gaps[:, order].argmin(axis=1)]  # the first of equals is the lower number
        gap, number = gaps[np.arange(len(rows)), at], numbers[at]
        better = (gap < self.best[rows]) | ((gap == self.best[rows]) & (number < self.index[rows]))
        self.best[rows[better]], self.index[rows[better]] = gap[better], number[better]

    def _search(self, node: Node, rows: np.ndarray) -> None:
        gaps = squared(self.points[rows], self.entries[node.points])
        self._offer(rows, node.points, gaps)
        if not node.children:
            return
        far = np.sqrt(gaps.astype(np.float64))
        for child, below in enumerate(node.children):
            if below is None:
                continue
            reach = np.sqrt(self.best[rows].astype(np.float64)) * (1 + SLACK)
            out = (far * (1 + SLACK) + reach[:, None] < node.low[:, child]) | (far * (1 - SLACK) - reach[:, None] > node.high[:, child])
            left = ~out.any(axis=1)
            if left.any():
                self._search(below, rows[left])


def whole_vectors(vectors: DataFrame, vector_col: str) -> DataFrame:
    """Rows with a vector of finite components, each floored after scaling (`_whole`, doubles)."""
    v = F.col(vector_col)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    scaled = F.transform(v, lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))).cast("double"))
    return vectors.filter(v.isNotNull() & fine).withColumn("_whole", scaled)


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dimension)


def _searchers(books) -> list[Nearest]:
    """The trees of broadcast codebooks, made once per task and batch run."""
    return [Nearest(book) for book in books]


def _sums(whole: DataFrame, books: np.ndarray, dimension: int) -> tuple[np.ndarray, np.ndarray]:
    """Counts and component sums of every entry's parts over all rows."""
    parts, entries, width = books.shape
    shared = whole.sparkSession.sparkContext.broadcast(books)

    def count(batches):
        searchers = _searchers(shared.value)
        n = np.zeros((parts, entries), dtype=np.int64)
        sums = np.zeros((parts, entries, width), dtype=np.int64)
        for batch in batches:
            matrix = _matrix(batch.column(0), dimension)
            for p, search in enumerate(searchers):
                own = matrix[:, p * width : (p + 1) * width]
                index, _ = search(own)
                n[p] += np.bincount(index, minlength=entries)
                np.add.at(sums[p], index, own)
        used = np.flatnonzero(n.ravel())
        if len(used):
            values = sums.reshape(parts * entries, width)[used].ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(used) + 1) * width, pa.int32()), pa.array(values))
            yield batch_of(["slot", "n", "sums"], [used, n.ravel()[used], lists])

    partial = whole.select("_whole").mapInArrow(count, "slot long, n long, sums array<long>")
    totals = partial.groupBy("slot").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[j]).alias(f"s{j}") for j in range(width)]).toArrow()
    n = np.zeros(parts * entries, dtype=np.int64)
    sums = np.zeros((parts * entries, width), dtype=np.int64)
    slots = totals.column("slot").to_numpy()
    n[slots] = totals.column("n").to_numpy()
    for j in range(width):
        sums[slots, j] = totals.column(f"s{j}").to_numpy()
    return n.reshape(parts, entries), sums.reshape(books.shape)


def train_codebooks(whole: DataFrame, order: list, dimension: int, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks (part, entry, component) from the first rows in the given order, refined by Lloyd
    rounds: an entry becomes the floored mean of its parts, an unused one stays."""
    first = whole.orderBy(*order).limit(entries).select("_whole").toArrow()  # a bounded number of vectors
    width = dimension // parts
    rows = _matrix(first.column(0).combine_chunks(), dimension) if first.num_rows else np.zeros((0, dimension), dtype=np.int64)
    books = np.ascontiguousarray(rows.reshape(len(rows), parts, width).transpose(1, 0, 2))
    for _ in range(rounds if rows.size else 0):
        n, sums = _sums(whole, books, dimension)
        books = np.where(n[:, :, None] > 0, np.floor_divide(sums, np.maximum(n, 1)[:, :, None]), books)
    return books


def codebooks_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def vector_codes(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS
) -> tuple[DataFrame, np.ndarray]:
    """Codes of all usable vectors, and the codebooks.

    Rows: id, label, `code` (two hex digits per part), `error` (squared distances over all parts).
    Rows whose vector is null or holds a null or non-finite component are left out. Codebooks start
    from the smallest ids (null last; rows of one id in the order of vector and label), so repeated
    rows count as often as they occur. Equal distances go to the lower index. The vector of the
    smallest id gives the dimension, which the number of parts must divide; rows of another
    dimension, or with a component whose squares would not fit 63 bits, take no part in the
    codebooks and have null code and error.
    """
    bounded_batches(vectors.sparkSession)
    named = vectors.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    order = [F.asc_nulls_last("id"), "_whole", F.asc_nulls_last("label")]
    usable = written(whole_vectors(named, "vector").drop("vector"))
    head = usable.orderBy(*order).select(F.size("_whole").alias("n")).limit(1).collect()
    dimension = head[0].n if head else 0
    if dimension % parts:
        raise ValueError(f"{parts} parts do not divide {dimension} components")
    reach = largest_component(dimension)
    fits = (F.size("_whole") == dimension) & F.forall("_whole", lambda x: F.abs(x) <= F.lit(float(reach)))
    whole = usable.filter(fits).withColumn("_whole", F.col("_whole").cast("array<long>"))
    books = train_codebooks(whole, order, dimension, parts)
    shared = vectors.sparkSession.sparkContext.broadcast(books)
    schema = T.StructType([*whole.schema.fields[:2], T.StructField("code", T.StringType()), T.StructField("error", T.LongType())])

    def code(batches):
        searchers = _searchers(shared.value)
        width = dimension // parts

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            matrix = _matrix(batch.column(2), dimension)
            found = [search(matrix[:, p * width : (p + 1) * width]) for p, search in enumerate(searchers)]
            codes = np.stack([index for index, _ in found], axis=1).astype(np.uint8)
            error = np.sum([gap for _, gap in found], axis=0)
            return batch_of(schema.names, [batch.column(0), batch.column(1), [c.tobytes().hex() for c in codes], error])

        yield from in_batches(one)(batches)

    coded = whole.select("id", "label", "_whole").mapInArrow(code, schema)
    odd = usable.filter(~fits).select("id", "label", F.lit(None).cast("string").alias("code"), F.lit(None).cast("long").alias("error"))
    return coded.unionByName(odd), books


def code_report(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """Codes and errors by row, with the error of all rows of the same label (null labels are one)
    and the digest of the codebooks."""
    codes, books = vector_codes(vectors, id_col, vector_col, label_col)
    codes = written(codes)
    by_label = codes.groupBy("label").agg(F.sum("error").alias("label_error"))
    joined = keyed_join(codes, by_label, ["label"], "left", null_safe=True)
    return joined.select(F.col("id").alias(id_col), "code", "error", "label_error", F.lit(codebooks_digest(books)).alias("codebooks_sha256"))
