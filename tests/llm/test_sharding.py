"""The law of byte-level shards, with hot texts, large records and ties."""

import zlib
from collections import defaultdict

import pytest

from unitledger.llm import sharding


def check(rows, got, shards=24, slack=0.03):
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=repr) == sorted(
        ((i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t in rows), key=repr
    )
    slots, size = defaultdict(list), defaultdict(int)
    for r in got:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(0 <= s < shards for s in slots) and all(sorted(v) == list(range(len(v))) for v in slots.values())
    mean = sum(size.values()) / shards
    largest = max(r.size for r in got)
    assert max(size.values()) <= max(mean * (1 + slack), largest + mean * slack)
    return size


@pytest.mark.parametrize("hot", [0, 900])
def test_sizes_are_level(spark, hot):
    rows = [(i, ("é" if i % 3 else "x") * (i * 7 % 400)) for i in range(1800)] + [(5000 + i, "hot text") for i in range(hot)]
    rows += [(9000, "L" * 6000), (9001, None), (0, rows[0][1]), (0, rows[0][1]), (None, "n")]
    df = spark.createDataFrame([(i, t, 1, "s") for i, t in rows], "doc_id long, text string, shard int, h string").repartition(5)
    size = check(rows, sharding.shard_by_bytes(df).collect())
    assert len(size) == 24 and min(size.values()) > 0.95 * sum(size.values()) / 24


def test_a_record_larger_than_a_shard_and_few_rows(spark):
    rows = [(1, "x" * 100_000), (2, "y"), (3, None)] + [(10 + i, "z" * 50) for i in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(rows, sharding.shard_by_bytes(df).collect())
    few = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    check([(1, "a"), (2, "b")], sharding.shard_by_bytes(few).collect())
    assert sharding.shard_by_bytes(few.limit(0)).collect() == []


def test_overfull_ranges_are_cut_again(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SAMPLE", 40)  # a poor sample at first
    df = spark.range(20_000).selectExpr("id as doc_id", "repeat('a', cast(id % 50 as int)) as text")
    rows = sharding.keyed(df, "doc_id", "text")
    total = rows.agg({"size": "sum"}).first()[0]
    _, held = sharding.splitters(rows, total, 32)
    assert max(b for b, _ in held.values()) < 2.5 * total / 32 and sum(n for _, n in held.values()) == 20_000


def test_written_shards(spark, tmp_path):
    rows = [(i, "t" * (i % 40), i) for i in range(600)] + [(None, None, 1), (3, "ttt", 3)]
    df = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    sharding.write_shards(df, str(tmp_path / "out"), shards=4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(map(str, back.select("doc_id", "text", "extra").collect())) == sorted(map(str, df.collect()))
    assert back.select("shard").distinct().count() == 4


def test_equal_rows_are_drawn_as_one_key(spark):
    rows = spark.range(200_000).selectExpr("1L as h", "2L as k", "30L as size").unionByName(
        spark.range(1000).selectExpr("id + 5 as h", "id as k", "30L as size")
    )
    for seed in range(5):
        drawn = sharding._drawn(rows, 201_000 * 30, seed)
        assert len(drawn) < 400 and [w for h, _, w in drawn if h == 1] == [200_000 * 30]


def test_many_equal_rows_are_spread(spark):
    df = spark.range(30_000).selectExpr("id % 3 as doc_id", "'the same text' as text")
    got = sharding.shard_by_bytes(df).groupBy("shard").count().collect()
    assert len(got) == 24 and max(r["count"] for r in got) - min(r["count"] for r in got) <= 40
