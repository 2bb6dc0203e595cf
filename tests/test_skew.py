"""Hot keys: the split joins give the plain join's result and spread the hot rows."""

import pytest
from pyspark.sql import functions as F

from unitledger.operators import profile, relational
from unitledger.operators.skew import first_per_key, keyed_join, ranked


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows share key 0, a sixth have no key."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 0).when(n % 6 == 1, F.lit(None)).otherwise(n % 500)
    return spark.range(30_000).select(n, key.cast("bigint").alias("k"), (n % 7).alias("v")).cache()


@pytest.fixture(scope="module")
def lookup(spark):
    return spark.range(0, 400).select(F.col("id").alias("k"), (F.col("id") * 2).alias("twice"))


def as_set(df):
    return sorted(map(tuple, df.select(*sorted(df.columns)).collect()), key=str)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_split_join_equals_plain_join(hot, lookup, how):
    assert as_set(keyed_join(hot, lookup, ["k"], how, split=True)) == as_set(hot.join(lookup, ["k"], how))


def test_null_safe_split_join(hot, lookup, spark):
    with_null = lookup.unionAll(spark.createDataFrame([(None, -1)], "k bigint, twice bigint"))
    got = keyed_join(hot, with_null, ["k"], "inner", null_safe=True, split=True)
    assert got.filter("k is null").count() == hot.filter("k is null").count() > 0


def test_hot_and_missing_keys_spread_over_partitions(hot, lookup, spark):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)

        def largest_share(df):
            sizes = [r["n"] for r in df.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
            return max(sizes) / sum(sizes)

        assert largest_share(hot.join(lookup, ["k"], "left")) > 0.35
        assert largest_share(keyed_join(hot, lookup, ["k"], "left")) < 0.25
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_first_per_key_limits_groups_before_the_shuffle(hot):
    picked = first_per_key(hot.filter("k is not null"), ["k"], [F.col("id")])
    plan = picked._jdf.queryExecution().executedPlan().toString()
    limits = plan.split("WindowGroupLimit")
    assert len(limits) == 3 and "Partial" in plan and "Final" in plan
    rows = {r["k"]: r["id"] for r in picked.collect()}
    assert rows[0] == 0 and len(rows) == hot.select("k").filter("k is not null").distinct().count()


def test_duplicates_of_one_hot_group(spark):
    df = spark.range(9_000).select("id", F.when(F.col("id") % 3 == 0, "same").otherwise(F.col("id").cast("string")).alias("text"), F.lit(None).cast("int").alias("none"))
    assert profile.duplicated_rows(df, ignore=["id"]).count() == 3_000
    assert profile.unique_rows(df, [F.col("id")], ignore=["id"]).count() == 6_001


def test_candidates_grow_linearly_with_a_hot_combination(spark):
    n = F.col("id")
    units = spark.range(4_000).select(n, F.lit("10115").alias("plz"), F.lit(5.0).alias("power"))
    found = relational.duplicate_candidates(units, ["plz", "power"], "id", n % 2 == 0, n % 2 == 1)
    assert found.count() == 4_000 and found.select("n_old", "n_new").distinct().collect() == [(2_000, 2_000)]


def test_ranked_numbers_all_rows_once(hot):
    rows = ranked(hot, [F.desc_nulls_last("k"), F.col("id")]).orderBy("position").collect()
    assert [r["position"] for r in rows] == list(range(1, 30_001))
    keys = [(-1 if r["k"] is None else r["k"], -r["id"]) for r in rows]
    assert keys == sorted(keys, reverse=True)


def test_chained_split_joins_read_the_base_once(spark, tmp_path):
    """Hot keys are taken from one column of the base, not from the joins before."""
    from unitledger.operators.snapshot import left_join_details

    n = F.col("id")
    spark.range(2_000).select(n, *[(n % k).alias(f"k{k}") for k in (3, 5, 7)]).write.parquet(str(tmp_path / "base"))
    base = spark.read.parquet(str(tmp_path / "base"))
    details = [(spark.range(7).select(n.alias("key"), (n * k).alias(f"v{k}")), f"k{k}", "key") for k in (3, 5, 7)]
    joined = left_join_details(base, details, split=True)
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("k3#") and plan.count("Relation [id#") == 1
    assert joined.columns == ["id", "k3", "k5", "k7", "key", "v3", "key_1", "v5", "key_2", "v7"]
    row = joined.filter("id = 104").first()
    assert (row["v3"], row["v5"], row["v7"]) == (104 % 3 * 3, 104 % 5 * 5, 104 % 7 * 7) and joined.count() == 2_000


def test_every_key_that_overfills_a_task_is_split(spark, monkeypatch):
    from unitledger.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 1)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    n = F.col("id")
    df = spark.range(80_000).select(F.when(n < 60_000, n % 1500).otherwise(n).alias("k"))
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "4000")
        found = skew.hot_keys(df, ["k"]).agg(F.count("*").alias("n"), F.min("_salts").alias("low"), F.max("k").alias("k")).first()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert (found["n"], found["k"]) == (1500, 1499) and found["low"] == 4  # 40 rows each against a share of 10


def test_exact_row_identity(spark):
    import datetime

    stamp = datetime.datetime(2024, 1, 1)
    rows = [
        (1, stamp, 0.0, None, [1, 2]), (2, stamp, -0.0, None, [1, 2]),  # equal
        (3, stamp + datetime.timedelta(microseconds=1), 0.0, None, [1, 2]), (4, stamp, 0.0, "", [1, 2]), (5, stamp, 0.0, None, [12]),
        (6, stamp, float("nan"), "N", None), (7, stamp, float("nan"), "N", None),  # equal
        (8, None, None, "a", []), (9, None, None, None, []),
    ]
    df = spark.createDataFrame(rows, "id int, t timestamp, v double, s string, a array<int>")
    assert sorted(r["id"] for r in profile.duplicated_rows(df, ["id"]).collect()) == [1, 2, 6, 7]
    assert sorted(r["id"] for r in profile.unique_rows(df, [F.col("id")], ["id"]).collect()) == [1, 3, 4, 5, 6, 8, 9]
