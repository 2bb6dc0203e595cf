"""Queries for the incremental mirror."""

from __future__ import annotations

from pyspark.sql import functions as F

from unitledger.catalogue import Tables, query
from unitledger.operators.skew import keyed_join
from unitledger.session import shared_dir
from unitledger.streaming import mirror

HALVES_SQL = """
  stored AS (SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
             FROM events WHERE event_id % 2 = 0) WHERE rn = 1),
  batch AS (SELECT user_id, event_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events WHERE event_id % 2 = 1) WHERE rn = 1),
  changed AS (SELECT b.*, CASE WHEN s.user_id IS NULL THEN 'insert' ELSE 'update' END AS op FROM batch b LEFT JOIN stored s ON s.user_id = b.user_id
              WHERE s.user_id IS NULL OR s.ts < b.ts)"""


def stored_and_batch(t: Tables):
    """Every other event is stored already, all the rest are the new batch."""
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    order = [F.desc("ts"), F.desc("event_id")]
    stored = mirror.last_per_key(rows.filter("event_id % 2 = 0"), "user_id", order)
    return stored, rows.filter("event_id % 2 = 1"), order


@query(f"WITH {HALVES_SQL} SELECT user_id, event_id, event_type FROM changed UNION ALL SELECT user_id, event_id, event_type FROM stored WHERE user_id NOT IN (SELECT user_id FROM changed)")
def upsert_newer_wins(t: Tables):
    stored, batch, order = stored_and_batch(t)
    return mirror.upsert(stored, batch, "user_id", "ts", order).select("user_id", "event_id", "event_type")


@query(f"WITH {HALVES_SQL} SELECT user_id, event_id, op FROM changed")
def upsert_operations(t: Tables):
    stored, batch, order = stored_and_batch(t)
    return mirror.changes(stored, mirror.last_per_key(batch, "user_id", order), "user_id", "ts").select("user_id", "event_id", "op")


UNITS_SQL = """(SELECT 'SEE' || o_orderkey AS unit_id, CASE o_orderpriority WHEN '1-URGENT' THEN 'wind' WHEN '2-HIGH' THEN 'solar' ELSE 'hydro' END AS technology,
   CASE WHEN o_orderstatus = 'F' THEN 'EEG' || o_custkey WHEN o_orderstatus = 'O' THEN '' END AS eeg, CASE WHEN o_orderkey % 3 = 0 THEN 'KWK' || o_orderkey END AS kwk,
   CASE WHEN o_orderkey % 5 = 0 THEN 'SGE' || o_orderkey END AS gen FROM orders)"""

REQUESTS_SQL = f"""(SELECT unit_id, technology, 'unit_data' AS data_type, unit_id AS additional_data_id FROM {UNITS_SQL}
   UNION ALL SELECT unit_id, technology, 'eeg_data', eeg FROM {UNITS_SQL} WHERE eeg <> '' UNION ALL SELECT unit_id, technology, 'kwk_data', kwk FROM {UNITS_SQL} WHERE kwk IS NOT NULL
   UNION ALL SELECT unit_id, technology, 'permit_data', gen FROM {UNITS_SQL} WHERE gen IS NOT NULL)"""


def request_rows(t: Tables):
    k, status, kind = F.col("o_orderkey"), F.col("o_orderstatus"), F.col("o_orderpriority")
    units = t.orders.select(
        F.concat(F.lit("SEE"), k).alias("EinheitMastrNummer"),
        F.when(status == "F", F.concat(F.lit("EEG"), "o_custkey")).when(status == "O", "").alias("EegMastrNummer"),
        F.when(k % 3 == 0, F.concat(F.lit("KWK"), k)).alias("KwkMastrNummer"),
        F.when(k % 5 == 0, F.concat(F.lit("SGE"), k)).alias("GenMastrNummer"),
        F.when(kind == "1-URGENT", "wind").when(kind == "2-HIGH", "solar").otherwise("hydro").alias("technology"),
    )
    return mirror.detail_requests(units, F.col("technology"))


@query(f"SELECT * FROM {REQUESTS_SQL}")
def request_generation(t: Tables):
    return request_rows(t)


@query(
    f"""SELECT unit_id, data_type, technology FROM {REQUESTS_SQL} r WHERE NOT (technology = 'wind' AND unit_id IN (SELECT unit_id FROM {REQUESTS_SQL} n WHERE data_type = 'permit_data'))
        UNION ALL SELECT unit_id, data_type, technology FROM {REQUESTS_SQL} WHERE data_type = 'permit_data'"""
)
def request_replacement(t: Tables):
    rows = request_rows(t)
    fresh = rows.filter("data_type = 'permit_data'")
    return mirror.replace_requests(rows, fresh, technology="wind").select("unit_id", "data_type", "technology")


@query(
    """SELECT o_custkey AS id, 'Broken' AS reason FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F' GROUP BY o_custkey
       UNION ALL SELECT c_custkey, 'Timeout' FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')
         AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F')"""
)
def reconcile_requests(t: Tables):
    requested = t.customer.select(F.col("c_custkey").alias("id"))
    retrieved = t.orders.filter("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("id"))
    failed = t.orders.filter("o_orderpriority = '5-LOW' and o_orderstatus = 'F'").select(F.col("o_custkey").alias("id")).distinct()
    return mirror.reconcile(requested, retrieved, failed.withColumn("reason", F.lit("Broken")), "id")


@query(
    """SELECT c_custkey AS id, c_mktsegment, 'Broken' AS reason FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus = 'F')"""
)
def remaining_requests(t: Tables):
    requests = t.customer.select(F.col("c_custkey").alias("id"), "c_mktsegment")
    missed = t.orders.filter("o_orderpriority = '5-LOW' and o_orderstatus = 'F'").select(F.col("o_custkey").alias("id"), F.lit("Broken").alias("reason"))
    return mirror.remaining_requests(requests, missed, "id")


@query(
    """SELECT event_id, event_type FROM events WHERE NOT (event_type = 'error' AND value > 65) AND user_id NOT IN
         (SELECT user_id FROM events WHERE event_type = 'error' AND value > 65)"""
)
def tombstone_removal(t: Tables):
    deleted = t.events.filter("event_type = 'error' and value > 65")
    return mirror.without_deleted(t.events.filter("not (event_type = 'error' and value > 65)"), deleted, "user_id").select("event_id", "event_type")


@query(
    """SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING' AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')"""
)
def open_detail_requests(t: Tables):
    pending = t.orders.filter("o_orderstatus = 'P'")
    base = t.customer.select("c_custkey", "c_mktsegment")
    return mirror.open_requests(base, pending, "c_custkey", "o_custkey", F.col("c_mktsegment") == "BUILDING")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1")
def incremental_stream(t: Tables):
    """All events, written as several files, streamed in micro-batches and merged by key."""
    import uuid

    folder = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    rows.repartition(4, "event_id").write.parquet(f"{folder}/source")
    source = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/source")
    log = mirror.ChangeLog(t.spark, f"{folder}/log", "user_id", "ts", rows.schema, buckets=8)
    stream = mirror.mirror_stream(source, log, f"{folder}/checkpoint")
    stream.awaitTermination()
    return log.current().select("user_id", "event_id", "event_type")


@query("SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY event_type")
def streamed_deduplication(t: Tables):
    """Events sent twice, deduplicated by the stream itself."""
    import uuid

    folder = f"{shared_dir(t.spark)}/dedupe-{uuid.uuid4().hex}"
    rows = t.events.select("event_id", "event_type", "ts")
    rows.unionAll(rows).repartition(4).write.parquet(f"{folder}/source")
    source = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/source")
    stamped = source.withColumn("ts", F.col("ts").cast("timestamp"))
    unique = mirror.deduplicated(stamped, ["event_id"], "ts", "60 days")
    query = (
        unique.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
        .option("path", f"{folder}/out").outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_id, event_type, count(*) AS n FROM events GROUP BY event_id, event_type")
def streamed_deduplication_restarted(t: Tables):
    """Three batches of a stream that is restarted before each: new events, repeats of recent ones,
    and in the last batch repeats of all, most of them later than the watermark. The state carried
    over and the watermark between them let every event through once."""
    import uuid

    folder = f"{shared_dir(t.spark)}/dedupe-{uuid.uuid4().hex}"
    rows = t.events.select("event_id", "event_type", F.col("ts").cast("timestamp").alias("ts"))
    low, high = rows.agg(F.min("ts"), F.max("ts")).first()
    third = (high - low) / 3
    first, second, delay = low + third, low + 2 * third, third / 6
    ts = F.col("ts")
    repeats = rows.filter((ts >= F.lit(first - delay / 2)) & (ts < F.lit(first)))
    batches = [
        rows.filter(ts < F.lit(first)),
        rows.filter((ts >= F.lit(first)) & (ts < F.lit(second))).unionAll(repeats),
        rows.filter(ts >= F.lit(second)).unionAll(rows),
    ]
    for batch in batches:
        batch.repartition(2, "event_id").write.mode("append").parquet(f"{folder}/source")
        source = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/source")
        unique = mirror.deduplicated(source, ["event_id"], "ts", f"{int(delay.total_seconds())} seconds")
        query = (
            unique.writeStream.format("parquet").option("checkpointLocation", f"{folder}/checkpoint")
            .option("path", f"{folder}/out").outputMode("append").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return t.spark.read.parquet(f"{folder}/out").groupBy("event_id", "event_type").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT max(ts) AS ts, 'bought' AS kind FROM events WHERE event_type IN ('purchase', 'click') UNION ALL SELECT max(ts), 'all' FROM events")
def newest_of_set(t: Tables):
    """Newest stamp of a set of types and of all rows: where a fetch of all of them starts."""
    some = mirror.newest_stamp(t.events, "ts", F.col("event_type").isin("purchase", "click")).withColumn("kind", F.lit("bought"))
    return some.unionByName(mirror.newest_stamp(t.events, "ts").withColumn("kind", F.lit("all")))


@query("SELECT event_id, strftime(ts, '%Y-%m-%d') AS newest, event_type AS dso FROM events")
def service_names_corrected(t: Tables):
    """A batch of the service with its misspelt and renamed columns."""
    batch = t.events.select(
        "event_id", F.date_format("ts", "yyyy-MM-dd").alias("DatumLetzeAktualisierung"),
        F.col("event_type").alias("zugeordneteNetzbetreiber"), F.lit("OK").alias("Ergebniscode"),
    )
    fixed = mirror.corrected_names(batch, {"zugeordneteNetzbetreiber": "ZugeordneteNetzbetreiber"})
    return fixed.select("event_id", F.col("DatumLetzteAktualisierung").alias("newest"), F.col("ZugeordneteNetzbetreiber").alias("dso"))


@query(
    """SELECT e.event_id FROM events e JOIN (SELECT event_type, max(ts) AS ts FROM events WHERE value > 30 GROUP BY event_type) m
       ON m.event_type = e.event_type WHERE e.ts > m.ts"""
)
def rows_after_high_water(t: Tables):
    """Rows a next fetch would bring: newer than the newest stored stamp of their type."""
    marks = mirror.high_water_marks(t.events.filter("value > 30"), "event_type", "ts").withColumnRenamed("ts", "_mark")
    return keyed_join(t.events, marks, ["event_type"], "inner").filter("ts > _mark").select("event_id")


@query("SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events) WHERE rn = 1")
def stream_two_checkpoints(t: Tables):
    """Two streams with checkpoints of their own feed one log; neither overwrites the other."""
    import uuid

    folder = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    rows = t.events.select("user_id", "event_id", "event_type", "ts")
    log = mirror.ChangeLog(t.spark, f"{folder}/log", "user_id", "ts", rows.schema, buckets=8)
    for part in (0, 1):
        rows.filter(F.col("event_id") % 2 == part).repartition(2, "event_id").write.parquet(f"{folder}/source{part}")
        source = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/source{part}")
        mirror.mirror_stream(source, log, f"{folder}/checkpoint{part}").awaitTermination()
    return log.current().select("user_id", "event_id", "event_type")


STREAM_REQUESTS_SQL = """WITH n AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) = 1)
   SELECT CAST(user_id AS VARCHAR) AS unit_id, event_type AS technology, 'unit_data' AS data_type, CAST(user_id AS VARCHAR) AS additional_data_id FROM n
   UNION ALL SELECT CAST(user_id AS VARCHAR), event_type, 'eeg_data', 'E' || event_id FROM n WHERE event_id % 3 > 0
   UNION ALL SELECT CAST(user_id AS VARCHAR), event_type, 'permit_data', 'P' || event_id FROM n WHERE event_id % 2 = 0"""


def _stream_rows(t: Tables):
    """Events as units with foreign ids."""
    number = F.col("event_id")
    return t.events.select(
        F.col("user_id").cast("string").alias("EinheitMastrNummer"),
        F.when(number % 3 > 0, F.concat(F.lit("E"), number)).alias("EegMastrNummer"),
        F.lit("").alias("KwkMastrNummer"),
        F.when(number % 2 == 0, F.concat(F.lit("P"), number)).alias("GenMastrNummer"),
        "event_type",
        "ts",
    )


def _drain_requests(t: Tables, rows, log, folder: str, run: int, files: int = 2):
    """Adds rows to the source of a run and drains it through the run's own checkpoint."""
    rows.repartition(files, "ts").write.mode("append").parquet(f"{folder}/source{run}")
    source = t.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{folder}/source{run}")
    mirror.request_stream(source, log, f"{folder}/checkpoint{run}", f"{folder}/requests", F.col("event_type")).awaitTermination()


@query(STREAM_REQUESTS_SQL)
def stream_change_requests(t: Tables):
    """Requests follow from the rows that the stream inserts and updates."""
    import uuid

    folder = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    rows = _stream_rows(t)
    log = mirror.ChangeLog(t.spark, f"{folder}/log", "EinheitMastrNummer", "ts", rows.schema, buckets=8)
    _drain_requests(t, rows, log, folder, 0, files=4)
    return mirror.requests(t.spark, f"{folder}/requests").select("unit_id", "technology", "data_type", "additional_data_id")


@query(STREAM_REQUESTS_SQL)
def stream_restarted_requests(t: Tables):
    """Two streams with checkpoints of their own feed one log, and the first is restarted after the
    second: no request is lost, and the newest change of a unit decides, whoever brought it."""
    import uuid

    folder = f"{shared_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    rows = _stream_rows(t)
    log = mirror.ChangeLog(t.spark, f"{folder}/log", "EinheitMastrNummer", "ts", rows.schema, buckets=8)
    for part, run in enumerate((0, 1, 0)):
        _drain_requests(t, rows.filter(F.pmod(F.xxhash64("ts"), F.lit(3)) == part), log, folder, run)
    return mirror.requests(t.spark, f"{folder}/requests").select("unit_id", "technology", "data_type", "additional_data_id")


@query(
    """WITH u AS (SELECT CAST(o_orderkey AS VARCHAR) AS id, o_orderkey AS n, o_orderstatus AS s FROM orders),
       d AS (SELECT id AS unit_id, n, s AS technology, 'unit_data' AS data_type, id AS additional_data_id FROM u
             UNION ALL SELECT id, n, s, 'eeg_data', 'E' || id FROM u WHERE n % 3 > 0),
       k AS (SELECT DISTINCT 'unit_data' AS data_type, CAST(l_orderkey AS VARCHAR) AS x FROM lineitem WHERE l_linenumber >= 4
             UNION SELECT DISTINCT 'eeg_data', 'E' || l_orderkey FROM lineitem WHERE l_linenumber = 6)
       SELECT unit_id, technology, data_type, additional_data_id FROM d WHERE technology <> 'F' AND n % 2 = 0
       UNION ALL SELECT unit_id, technology, data_type, additional_data_id FROM d
         WHERE technology = 'F' AND NOT EXISTS (SELECT 1 FROM k WHERE k.data_type = d.data_type AND k.x = d.additional_data_id)"""
)
def request_rebuild(t: Tables):
    """Requests of one type thrown away and made anew from its missing details, in one call."""
    ids = {"unit": "unit_data", "eeg": "eeg_data"}
    key = F.col("o_orderkey")
    base = t.orders.select(
        key.cast("string").alias("unit"), F.when(key % 3 > 0, F.concat(F.lit("E"), key)).alias("eeg"), key.alias("n"), F.col("o_orderstatus").alias("s")
    )
    queue = mirror.detail_requests(base.filter("n % 2 = 0"), F.col("s"), ids)
    units = t.lineitem.filter("l_linenumber >= 4").select(F.col("l_orderkey").cast("string").alias("id"))
    subsidies = t.lineitem.filter("l_linenumber = 6").select(F.concat(F.lit("E"), "l_orderkey").alias("id"))
    details = {"unit_data": (units, "id"), "eeg_data": (subsidies, "id")}
    return mirror.rebuilt_requests(queue, base, details, "F", F.col("s") == "F", ids).select("unit_id", "technology", "data_type", "additional_data_id")
