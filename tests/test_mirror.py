"""Incremental mirror: batch rules, restart of the stream, compaction."""

import datetime

from pyspark.sql import functions as F

from unitledger.streaming import mirror

SCHEMA = "k string, ts timestamp, v int"


def rows(spark, *items):
    day = datetime.datetime(2024, 1, 1)
    return spark.createDataFrame([(k, None if d is None else day + datetime.timedelta(days=d), v) for k, d, v in items], SCHEMA)


def values(df):
    return {r["k"]: r["v"] for r in df.collect()}


def test_only_newer_rows_replace_known_keys(spark):
    stored = rows(spark, ("old", 1, 1), ("same", 5, 1), ("newer", 9, 1))
    batch = rows(spark, ("old", 2, 2), ("same", 5, 2), ("newer", 3, 2), ("new", 1, 2), ("new", 1, 3))
    order = [F.desc("ts"), F.desc("v")]
    assert values(mirror.upsert(stored, batch, "k", "ts", order)) == {"old": 2, "same": 1, "newer": 1, "new": 3}
    ops = {r["k"]: r["op"] for r in mirror.changes(stored, mirror.last_per_key(batch, "k", order), "k", "ts").collect()}
    assert ops == {"old": "update", "new": "insert"}
    always = values(mirror.upsert(stored, rows(spark, ("newer", 3, 2)), "k", None, order))
    assert always["newer"] == 2


def test_stream_restarts_without_loss_or_repeats(spark, tmp_path):
    source, log_dir, check = str(tmp_path / "in"), str(tmp_path / "log"), str(tmp_path / "check")
    rows(spark, ("a", 1, 1), ("b", 1, 1), ("a", 2, 2)).coalesce(1).write.parquet(source)
    log = mirror.ChangeLog(spark, log_dir, "k", "ts", rows(spark).schema)

    def drain():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(source)
        mirror.mirror_stream(stream, log, check).awaitTermination()

    drain()
    assert values(log.current()) == {"a": 2, "b": 1}
    drain()  # nothing new
    rows(spark, ("b", 3, 3), ("c", 1, 3), ("a", 2, 9)).coalesce(1).write.mode("append").parquet(source)
    drain()
    expected = {"a": 2, "b": 3, "c": 3}  # an equal stamp is not newer
    assert values(log.current()) == expected
    log.write_batch(rows(spark, ("b", 3, 3), ("c", 1, 3), ("a", 2, 9)), 1)  # a repeated batch replaces itself
    assert values(log.current()) == expected
    assert values(log.compact(str(tmp_path / "compact")).current()) == expected


def test_a_new_checkpoint_on_the_same_log_loses_nothing(spark, tmp_path):
    schema = rows(spark).schema
    log = mirror.ChangeLog(spark, str(tmp_path / "log"), "k", "ts", schema)
    seen = []
    for run, items in enumerate([[("a", 1, 1), ("b", 5, 1)], [("b", 5, 2), ("c", 2, 2)], [("b", 6, 3), ("a", 0, 3)]]):
        source = str(tmp_path / f"in{run}")
        rows(spark, *items).coalesce(1).write.parquet(source)
        stream = spark.readStream.schema(SCHEMA).parquet(source)
        note = lambda changed, batch, run: seen.append(sorted((r["k"], r["op"]) for r in changed.collect()))
        mirror.mirror_stream(stream, log, str(tmp_path / f"check{run}"), note).awaitTermination()
        log.current().collect(), log.current().collect()
    assert values(log.current()) == {"a": 1, "b": 3, "c": 2}
    assert seen == [[("a", "insert"), ("b", "insert")], [("c", "insert")], [("b", "update")]]
    assert log.schema == schema and len(schema.fields) == 3


def scanned_rows(df):
    """Rows that the file scans of a query put out."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    found = [leaves.apply(i) for i in range(leaves.size())]
    return sum(x.metrics().get("numOutputRows").get().value() for x in found if "FileScan" in x.toString() or "FileSourceScan" in x.getClass().getName())


def test_a_batch_reads_its_own_part_of_the_log(spark, tmp_path):
    schema = rows(spark).schema
    keyed = lambda low, high: spark.range(low, high).selectExpr("concat('k', id) as k", "timestamp'2024-01-01' as ts", "int(id) as v")
    read = []
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for n, size in enumerate((2000, 20_000)):
            log = mirror.ChangeLog(spark, str(tmp_path / f"log{n}"), "k", "ts", schema)
            for batch in range(4):
                log.write_batch(keyed(batch * size // 4, (batch + 1) * size // 4), batch)
            log = log.compact(str(tmp_path / f"compact{n}"), bucket_rows=100)
            assert log.buckets == size // 100 and log.current().count() == size
            batch = rows(spark, ("k7", 5, -1), ("k1999", -5, -1), ("new", 1, -1), (None, 1, -1))
            changed = log.changes(batch, 5).collect()
            assert {(r["k"], r["op"]) for r in changed} == {("k7", "update"), ("new", "insert"), (None, "insert")}
            read.append(scanned_rows(log.touched(log.newest(batch))))
            again = mirror.ChangeLog(spark, log.path, "k", "ts", schema, buckets=3)  # the log knows its buckets
            assert again.buckets == log.buckets
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert read[1] <= 1.5 * read[0] and read[1] < 1000


def test_a_large_batch_and_a_small_one_see_the_same(spark, tmp_path, monkeypatch):
    log = mirror.ChangeLog(spark, str(tmp_path / "log"), "k", "ts", rows(spark).schema, buckets=4)
    assert log.changes(rows(spark, ("a", 1, 1)), 0).count() == 1  # nothing is stored yet
    log.write_batch(rows(spark, *[(f"k{i}", i % 7, i) for i in range(60)], (None, 3, 0)), 0)
    batch = rows(spark, *[(f"k{i}", 3, -i) for i in range(0, 90, 2)], (None, 4, 1))
    want = {(f"k{i}", "insert") for i in range(60, 90, 2)} | {(f"k{i}", "update") for i in range(0, 60, 2) if i % 7 < 3}
    for listed in (1000, 5):
        monkeypatch.setattr(mirror.ChangeLog, "LISTED", listed)
        got = {(r["k"], r["op"]) for r in log.changes(batch, 1).collect()}
        assert got - {(None, "insert")} == want
    assert log.changes(batch.limit(0), 1).count() == 0


def test_requests_of_a_restarted_stream(spark, tmp_path):
    """Two checkpoints on one log; the first is restarted after the second has written."""
    schema = "EinheitMastrNummer string, EegMastrNummer string, KwkMastrNummer string, GenMastrNummer string, ts timestamp"
    log = mirror.ChangeLog(spark, str(tmp_path / "log"), "EinheitMastrNummer", "ts", spark.createDataFrame([], schema).schema)
    day = lambda d: datetime.datetime(2024, 1, d)
    steps = [(0, [("a", 2, "E1"), ("x", 5, "E2")]), (1, [("y", 1, "E3"), ("x", 3, "E4"), ("b", 1, "E5")]), (1, [("y", 4, "E6")]), (0, [("b", 2, "E7"), ("a", 1, "E8")])]
    for run, units in steps:
        source = str(tmp_path / f"in{run}")
        spark.createDataFrame([(u, e, None, None, day(d)) for u, d, e in units], schema).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(schema).parquet(source)
        mirror.request_stream(stream, log, str(tmp_path / f"check{run}"), str(tmp_path / "requests"), F.lit("wind")).awaitTermination()
    got = {(r["unit_id"], r["additional_data_id"]) for r in mirror.requests(spark, str(tmp_path / "requests")).collect()}
    assert got == {(u, x) for u, e in (("a", "E1"), ("x", "E2"), ("y", "E6"), ("b", "E7")) for x in (u, e)}


def test_requests_and_reconciliation(spark):
    units = spark.createDataFrame(
        [("SEE1", "EEG1", None, "", "Windeinheit"), ("SEE2", None, "KWK2", "SGE2", "Biomasse")],
        "EinheitMastrNummer string, EegMastrNummer string, KwkMastrNummer string, GenMastrNummer string, Einheittyp string",
    )
    found = mirror.detail_requests(units, F.col("Einheittyp"))
    assert sorted((r["unit_id"], r["data_type"], r["additional_data_id"]) for r in found.collect()) == [
        ("SEE1", "eeg_data", "EEG1"), ("SEE1", "unit_data", "SEE1"),
        ("SEE2", "kwk_data", "KWK2"), ("SEE2", "permit_data", "SGE2"), ("SEE2", "unit_data", "SEE2"),
    ]
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "id string")
    failed = ids("c").withColumn("reason", F.lit("Broken"))
    got = {r["id"]: r["reason"] for r in mirror.reconcile(ids("a", "b", "c"), ids("a"), failed, "id").collect()}
    assert got == {"b": "Timeout", "c": "Broken"}


def test_service_rows_are_flat_and_named(spark):
    schema = (
        "EinheitMastrNummer string, Ergebniscode string, DatumLetzeAktualisierung string, Weic struct<Wert:string,NichtVorhanden:boolean>, "
        "NetzbetreiberMastrNummer array<string>, zugeordneteWirkleistungWechselrichter double"
    )
    rows = spark.createDataFrame([("SEE1", "OK", "2024-01-01", ("W", False), ["SNB1", "SNB2"], 2.5), ("SEE2", "OK", None, None, [], None)], schema)
    got = {r["EinheitMastrNummer"]: r for r in mirror.service_rows(rows, "2024-02-01").collect()}
    first = got["SEE1"]
    assert "Ergebniscode" not in first and first["DatumLetzteAktualisierung"] == "2024-01-01"
    assert (first["Weic"], first["NetzbetreiberMastrNummer"], first["ZugeordneteWirkleistungWechselrichter"]) == ("W", "SNB1", 2.5)
    assert got["SEE2"]["NetzbetreiberMastrNummer"] is None and first["DatenQuelle"] == "API"


def test_deduplication_over_batches_keeps_a_bounded_state(spark, tmp_path):
    """Repeats within the delay go, state older than the watermark is forgotten, also over restarts."""
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    start = datetime.datetime(2024, 1, 1)
    kept = []
    for n in range(4):
        new = [(i, start + datetime.timedelta(hours=i)) for i in range(n * 100, n * 100 + 100)]
        again = [(i, start + datetime.timedelta(hours=i)) for i in range(max(0, n * 100 - 10), n * 100)]
        spark.createDataFrame(new + again, "k int, ts timestamp").coalesce(1).write.mode("append").parquet(source)
        stream = mirror.deduplicated(spark.readStream.schema("k int, ts timestamp").parquet(source), ["k"], "ts", "20 hours")
        query = (
            stream.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "check"))
            .option("path", out).outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        kept.append(query.lastProgress["stateOperators"][0]["numRowsTotal"])
    assert sorted(r.k for r in spark.read.parquet(out).collect()) == list(range(400))
    assert max(kept) < 150
