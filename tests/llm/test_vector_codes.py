"""Vector codes against plain versions: nearest entries, Lloyd rounds, edge cases."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import types as T

from unitledger.llm import vector_codes as vc


def nearest(point, book):
    gaps = [sum((a - b) ** 2 for a, b in zip(point, e)) for e in book]
    return min(range(len(book)), key=lambda i: (gaps[i], i)), min(gaps)


def plain_version(rows, parts=4, entries=256, rounds=4):
    """Codes by row in the order given, and codebooks, in plain Python."""
    whole = [(i, [math.floor(1024 * np.float32(x).item()) for x in v]) for i, v in rows]
    width = len(whole[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v in whole]
    first = sorted(range(len(whole)), key=lambda k: (whole[k][0], whole[k][1]))[:entries]
    books = [[cut[k][p] for k in first] for p in range(parts)]
    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(nearest(c[p], books[p])[0], []).append(c[p])
            for e, own in members.items():
                books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for c in cut:
        found = [nearest(c[p], books[p]) for p in range(parts)]
        out.append(("".join(f"{i:02x}" for i, _ in found), sum(g for _, g in found)))
    return out, books


@pytest.mark.parametrize("seed, spread, n, width", [(1, 5, 256, 2), (2, 1000, 256, 16), (3, 1, 200, 3), (4, 10**9, 100, 1), (5, 3, 1, 4), (6, 0, 256, 4)])
def test_nearest_entries(seed, spread, n, width):
    g = np.random.Generator(np.random.PCG64(seed))
    book = g.integers(-spread, spread + 1, (n, width))
    points = np.concatenate([g.integers(-spread, spread + 1, (300, width)), book[:20], (book[:20] + book[-20:]) // 2 if n > 40 else book[:0]])
    index, gap = vc.Nearest(book)(points)
    assert [(i, d) for i, d in zip(index.tolist(), gap.tolist())] == [nearest(p, book.tolist()) for p in points.tolist()]


def test_subtrees_are_ruled_out():
    g = np.random.Generator(np.random.PCG64(7))
    centres = g.integers(-(10**5), 10**5, (16, 8))
    book = (centres[:, None] + g.integers(-20, 20, (16, 16, 8))).reshape(-1, 8)
    points = book[g.integers(0, 256, 500)] + g.integers(-5, 5, (500, 8))
    looked = []
    search = vc.Nearest(book)
    plain = search._offer
    search._offer = lambda rows, numbers, gaps: (looked.append(gaps.size), plain(rows, numbers, gaps))
    index, _ = search(points)
    assert index.tolist() == [nearest(p, book.tolist())[0] for p in points.tolist()]
    assert sum(looked) < 0.3 * len(points) * len(book)


def frame(spark, rows):
    fields = [T.StructField("code", T.StringType()), T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))]
    return spark.createDataFrame(rows, T.StructType([*fields, T.StructField("label", T.IntegerType()), T.StructField("id", T.LongType())])).repartition(3)


def test_rows_equal_the_plain_version(spark):
    r = random.Random(9)
    vectors = [[round(r.gauss(0, 1), 3) for _ in range(8)] for _ in range(330)]
    vectors += [vectors[0]] * 40 + [[0.0] * 8] * 5
    rows = [(k // 2 * 2, v) for k, v in enumerate(vectors)]  # ids repeat
    want, books = plain_version(rows)
    bad = [(900, None), (901, [1.0, None] + [0.0] * 6), (902, [float("nan")] + [0.0] * 7), (903, [float("-inf")] + [0.0] * 7)]
    label = lambda i: None if i % 5 == 0 else i % 5
    df = frame(spark, [("x", i, v, label(i), 1) for i, v in rows + bad])
    codes, got_books = vc.vector_codes(df)
    assert got_books.tolist() == books
    assert sorted((x.id, x.code, x.error) for x in codes.collect()) == sorted((i, c, e) for (i, _), (c, e) in zip(rows, want))
    out = vc.code_report(df).collect()
    sums = {}
    for (i, _), (_, e) in zip(rows, want):
        sums[label(i)] = sums.get(label(i), 0) + e
    assert len(out) == len(rows) and all(x.label_error == sums[label(x.vec_id)] for x in out)
    assert {x.codebooks_sha256 for x in out} == {vc.codebooks_digest(np.array(books))}


def test_odd_rows(spark):
    rows = [(1, [0.5] * 4), (2, [0.25] * 4), (3, [1.0] * 5), (4, []), (5, [3e38] * 4), (None, [0.5] * 4), (None, [-0.0005] * 4)]
    df = frame(spark, [("x", i, v, None, 1) for i, v in rows])
    got = {(x.vec_id, x.code, x.error, x.label_error) for x in vc.code_report(df).collect()}
    # The null ids come last; of two the smaller vector is first: entries 1, 2, null (-1), null (512).
    assert got == {(1, "00000000", 0, 0), (2, "01010101", 0, 0), (None, "00000000", 0, 0), (None, "02020202", 0, 0)} | {(i, None, None, 0) for i in (3, 4, 5)}
    assert vc.code_report(df.limit(0)).collect() == []
    assert vc.code_report(frame(spark, [("x", 1, [], 1, 1)])).collect()[0].error == 0
    with pytest.raises(ValueError):
        vc.vector_codes(frame(spark, [("x", 1, [1.0] * 6, 1, 1)]))
