"""Incremental mirror of a register: newest stamps, keyed upserts, detail requests, streaming."""

from __future__ import annotations

import threading
from collections.abc import Callable, Sequence
from itertools import zip_longest

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.functions.nested import first_as_text, flatten_reply
from unitledger.operators.relational import distinct_keys, drop_keys, missing_detail
from unitledger.operators.skew import first_per_key, keyed_join, written

# Foreign ids of a basic unit and the detail data each one stands for.
DETAIL_IDS = {
    "EinheitMastrNummer": "unit_data",
    "EegMastrNummer": "eeg_data",
    "KwkMastrNummer": "kwk_data",
    "GenMastrNummer": "permit_data",
}


# Misspelt columns, status columns of a reply, and columns that come as lists.
MISSPELT = {
    "DatumLetzeAktualisierung": "DatumLetzteAktualisierung",
    "zugeordneteWirkleistungWechselrichter": "ZugeordneteWirkleistungWechselrichter",
}
FIRST_OF_LIST = ["NetzbetreiberMastrNummer", "Netzbetreiberzuordnungen"]
STATUS_COLUMNS = ["Ergebniscode", "AufrufVeraltet", "AufrufVersion", "AufrufLebenszeitEnde"]


def corrected_names(batch: DataFrame, aliases: dict[str, str] | None = None) -> DataFrame:
    """Give columns their table names. Where both spellings arrive, the right one is used
    first; status columns of the reply are dropped."""
    for wrong, right in {**MISSPELT, **(aliases or {})}.items():
        if wrong in batch.columns:
            value = F.coalesce(right, wrong) if right in batch.columns else F.col(wrong)
            batch = batch.withColumn(f"_{right}", value).drop(wrong, right).withColumnRenamed(f"_{right}", right)
    return batch.drop(*STATUS_COLUMNS)


def service_rows(replies: DataFrame, download_date: str) -> DataFrame:
    """Nested replies of the service as plain table rows with provenance."""
    flat = flatten_reply(corrected_names(replies))
    kinds = dict(flat.dtypes)
    lists = {c: first_as_text(F.col(c)) for c in FIRST_OF_LIST if kinds.get(c, "").startswith("array")}
    return flat.withColumns({**lists, "DatenQuelle": F.lit("API"), "DatumDownload": F.lit(download_date).cast("date")})


def high_water_marks(stored: DataFrame, kind: str, stamp: str) -> DataFrame:
    """Newest stored stamp per type: where the next fetch starts."""
    return stored.groupBy(kind).agg(F.max(stamp).alias(stamp))


def newest_stamp(stored: DataFrame, stamp: str, where: Column | None = None) -> DataFrame:
    chosen = stored if where is None else stored.filter(where)
    return chosen.agg(F.max(stamp).alias(stamp))


def last_per_key(batch: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    return first_per_key(batch, [key], order)


def changes(stored: DataFrame, batch: DataFrame, key: str, stamp: str | None) -> DataFrame:
    """Rows of the batch to write, marked `insert` or `update`.

    A known key is updated only if its stored stamp is older; without a stamp always. A stored
    or new stamp that is NULL is not older than anything.
    """
    # Only the batch's keys matter: with a small batch the stored table is filtered in place.
    touched = keyed_join(stored.select(key, *([stamp] if stamp else [])), distinct_keys(batch, key), [key], "left_semi")
    known = touched.select(key, F.lit(True).alias("_known"), *([F.col(stamp).alias("_stored")] if stamp else []))
    joined = keyed_join(batch, known, [key], "left")
    newer = F.coalesce(F.col("_stored") < F.col(stamp), F.lit(False)) if stamp else F.lit(True)
    op = F.when(F.col("_known").isNull(), "insert").when(newer, "update")
    return joined.withColumn("op", op).filter("op is not null").select(*batch.columns, "op")


def upsert(stored: DataFrame, batch: DataFrame, key: str, stamp: str | None, order: Sequence[Column]) -> DataFrame:
    """The stored table after the batch: new keys added, known keys replaced by newer rows."""
    done = written(changes(stored, last_per_key(batch, key, order), key, stamp).drop("op"))  # used twice
    kept = keyed_join(stored, distinct_keys(done, key), [key], "left_anti")
    return kept.unionByName(done)


def detail_requests(
    units: DataFrame, technology: Column, ids: dict[str, str] | None = None, stamp: str | None = None
) -> DataFrame:
    """Up to one request per non-empty foreign id of each changed unit, in one pass; with the
    unit's stamp (`stamp`), if its column is named."""
    ids = ids or DETAIL_IDS
    key = next(iter(ids))
    kept = {"unit_id": F.col(key), "technology": technology, **({"stamp": F.col(stamp)} if stamp else {})}
    wide = units.select(*[c.alias(n) for n, c in kept.items()], *[F.col(c).cast("string").alias(kind) for c, kind in ids.items()])
    long = wide.unpivot(list(kept), list(ids.values()), "data_type", "additional_data_id")
    return long.filter("additional_data_id is not null and additional_data_id <> ''")


def replace_requests(requests: DataFrame, new: DataFrame, technology: str | None = None) -> DataFrame:
    """Requests of changed units are dropped, of one technology or all, and the new ones added."""
    where = None if technology is None else F.col("technology") == technology
    return drop_keys(requests, new, "unit_id", where=where).unionByName(new)


def open_requests(base: DataFrame, detail: DataFrame, base_key: str, detail_key: str, kind: Column) -> DataFrame:
    """Units of a type whose detail row is missing."""
    return missing_detail(base.filter(kind), detail, base_key, detail_key)


def reconcile(requested: DataFrame, retrieved: DataFrame, failed: DataFrame, key: str) -> DataFrame:
    """Requested ids that neither came back nor failed: missed by `Timeout`, next to the failures."""
    left = keyed_join(requested.select(key).distinct(), distinct_keys(retrieved, key), [key], "left_anti")
    timed_out = keyed_join(left, distinct_keys(failed, key), [key], "left_anti").withColumn("reason", F.lit("Timeout"))
    return failed.select(key, "reason").unionByName(timed_out)


def remaining_requests(requests: DataFrame, missed: DataFrame, key: str) -> DataFrame:
    """Only missed requests stay in the queue, with their reason."""
    return keyed_join(requests, missed.groupBy(key).agg(F.min("reason").alias("reason")), [key], "inner")


def outcome_counts(replies: DataFrame, reply: str, *keys: str) -> DataFrame:
    return replies.groupBy(*keys).agg(
        F.count_if(F.col(reply).isNotNull()).alias("fetched"), F.count_if(F.col(reply).isNull()).alias("missed")
    )


def without_deleted(units: DataFrame, tombstones: DataFrame, key: str) -> DataFrame:
    return keyed_join(units, distinct_keys(tombstones, key), [key], "left_anti")


class ChangeLog:
    """A mirrored table kept as an append-only log of keyed rows, in buckets by the hash of the key.

    A micro-batch costs its own size, not the size of the log: `write_batch` stores the last row
    per key of the batch in a folder of its run and batch, so a repeated batch replaces itself and
    another run (a new checkpoint on the same log) never touches what is there. `changes` reads
    the folders of the batch's buckets only, and of their files, sorted by key and with a filter
    of their keys each, what may hold the batch's keys. `current` reads the newest row per key;
    `compact` writes that elsewhere in as many buckets as its rows ask for, so that a bucket and
    what a batch reads stay the same while the table grows. The number of buckets is kept in the
    log; `buckets` counts for a new one.
    """

    #: Keys of a batch that are pushed to the scan; a larger batch reads its buckets whole.
    LISTED = 1000
    #: Rows of a bucket that `compact` aims at.
    BUCKET_ROWS = 100_000

    def __init__(self, spark: SparkSession, path: str, key: str, stamp: str, schema: T.StructType, buckets: int = 64):
        self.spark, self.path, self.key, self.stamp, self.schema = spark, path, key, stamp, schema
        self.buckets = self._kept_buckets() or buckets

    def _folders(self, prefix: str) -> list[str]:
        """What follows the prefix in the names of the log's folders, in order."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in fs.listStatus(root)] if fs.exists(root) else []
        return sorted(n.removeprefix(prefix) for n in names if n.startswith(prefix))

    def _kept_buckets(self) -> int | None:
        kept = self._folders("_buckets-")
        return int(kept[0]) if kept else None

    def _runs(self) -> list[str]:
        """Names of the runs that have written, oldest first."""
        return self._folders("run=")

    def run_name(self, run: str) -> str:
        """The folder name of a run: a running number, so that runs have an order, and its id."""
        runs = self._runs()
        return next((r for r in runs if r.partition("-")[2] == run), f"{len(runs):06d}-{run}")

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(self.key), F.lit(self.buckets)).cast("int")

    def newest(self, batch: DataFrame) -> DataFrame:
        """The last row per key of a batch: the newest stamp, of equal ones the same in every run."""
        return last_per_key(batch, self.key, [F.desc_nulls_last(self.stamp), F.desc(F.xxhash64(*batch.columns))])

    def write_batch(self, batch: DataFrame, batch_id: int, run: str = "base") -> None:
        self.write_newest(self.newest(batch), batch_id, run)

    def write_newest(self, newest: DataFrame, batch_id: int, run: str = "base") -> None:
        """Store rows that are one per key."""
        if self._kept_buckets() is None:
            mark = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_buckets-{self.buckets}")
            mark.getFileSystem(self.spark._jsc.hadoopConfiguration()).mkdirs(mark)
        sorted_rows = newest.withColumn("bucket", self._bucket()).repartition("bucket").sortWithinPartitions("bucket", self.key)
        folder = f"{self.path}/run={self.run_name(run)}/batch={batch_id}"
        sorted_rows.write.mode("overwrite").option(f"parquet.bloom.filter.enabled#{self.key}", "true").partitionBy("bucket").parquet(folder)

    def _rows(self, buckets: Sequence[int] | None = None) -> DataFrame:
        """All rows of the log with run, batch and bucket, or those of some buckets."""
        added = [T.StructField("run", T.StringType()), T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
        schema = T.StructType([*self.schema.fields, *added])
        files = f"{self.path}/run=*/batch=*/bucket=" + ("*" if buckets is None else "{" + ",".join(map(str, buckets)) + "}")
        pattern = self.spark._jvm.org.apache.hadoop.fs.Path(files)
        if not pattern.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(pattern):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.option("basePath", self.path).schema(schema).parquet(files)

    def current(self, without: tuple[str, int] | None = None) -> DataFrame:
        """Newest stamp wins; at equal stamps the earlier batch stays, because an update must be newer.
        `without` leaves one batch of a run out."""
        return self._newest_stored(self._rows(), without)

    def _newest_stored(self, rows: DataFrame, without: tuple[str, int] | None) -> DataFrame:
        if without is not None:
            rows = rows.filter(~((F.col("run") == self.run_name(without[0])) & (F.col("batch") == without[1])))
        order = [F.desc_nulls_last(self.stamp), F.col("run"), F.col("batch")]
        return first_per_key(rows, [self.key], order).drop("run", "batch", "bucket")

    def touched(self, newest: DataFrame) -> DataFrame:
        """Rows of the log that may have a key of the batch: its buckets (a bounded number of them),
        and in these, for a small batch, what passes a filter on its keys."""
        buckets = sorted(r["b"] for r in newest.select(self._bucket().alias("b")).distinct().collect())
        if not buckets:
            return self._rows().limit(0)
        rows = self._rows(buckets)
        keys = [r[0] for r in newest.select(self.key).limit(self.LISTED + 1).collect()]
        if len(keys) > self.LISTED:
            return rows
        # The scan takes exact lists of ten values; longer ones it widens to a range.
        known = [k for k in keys if k is not None]
        tests = [F.col(self.key).isin(known[i : i + 10]) for i in range(0, len(known), 10)]
        if len(known) < len(keys):
            tests.append(F.col(self.key).isNull())
        while len(tests) > 1:
            tests = [a | b for a, b in zip_longest(tests[::2], tests[1::2], fillvalue=F.lit(False))]
        return rows.filter(tests[0])

    def changes(self, batch: DataFrame, batch_id: int, run: str = "base") -> DataFrame:
        """Rows of a batch that insert or update (`op`), seen from the log without this batch."""
        return self.changes_of(self.newest(batch), batch_id, run)

    def changes_of(self, newest: DataFrame, batch_id: int, run: str = "base") -> DataFrame:
        stored = self._newest_stored(self.touched(newest), (run, batch_id))
        return changes(stored, newest, self.key, self.stamp)

    def compact(self, new_path: str, bucket_rows: int | None = None) -> "ChangeLog":
        """Rewrite the log as one batch elsewhere; the caller switches to the returned log."""
        rows = self.current()
        buckets = max(1, -(-rows.count() // (bucket_rows or self.BUCKET_ROWS)))
        done = ChangeLog(self.spark, new_path, self.key, self.stamp, self.schema, buckets)
        if done._runs():
            raise ValueError(f"{new_path} already holds a log")
        done.write_newest(rows, 0)
        return done


def mirror_stream(
    source: DataFrame, log: ChangeLog, checkpoint: str, on_changes: Callable[[DataFrame, int, str], None] | None = None
):
    """Start the query that merges a stream of rows into the log, batch by batch.

    Offsets live in the checkpoint, each batch overwrites its own folder, so a restart neither
    loses nor doubles rows; the id of the query, kept in the checkpoint too, names its folders.
    `on_changes` gets the rows a batch inserts or updates (with `op`), the batch's number and the
    run's folder name; the same ones if the batch is repeated. The trigger drains what is there
    and stops.
    """
    started = threading.Event()
    own: dict[str, str] = {}

    def merge(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        newest = written(log.newest(batch))
        changed = written(log.changes_of(newest, batch_id, own["run"])) if on_changes else None
        log.write_newest(newest, batch_id, own["run"])
        if on_changes:
            on_changes(changed, batch_id, log.run_name(own["run"]))

    query = source.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    own["run"] = query.id
    started.set()
    return query


def request_stream(source: DataFrame, log: ChangeLog, checkpoint: str, requests_path: str, technology: Column):
    """Mirror a stream and keep the detail requests its inserted and updated rows ask for.

    Each batch writes its requests, with the stamp of the row they follow from, to a folder of its
    own run and batch; `requests` reads those of the newest change per unit.
    """

    def ask(changed: DataFrame, batch_id: int, run: str) -> None:
        new = detail_requests(changed, technology, stamp=log.stamp)
        new.write.mode("overwrite").parquet(f"{requests_path}/run={run}/batch={batch_id}")

    return mirror_stream(source, log, checkpoint, ask)


def requests(spark: SparkSession, requests_path: str) -> DataFrame:
    """The requests of the newest change of each unit: the newest stamp, whatever run or batch
    brought it; of equal ones the earlier batch, as in the log."""
    rows = spark.read.parquet(requests_path).withColumn("batch", F.col("batch").cast("long"))
    brought = ["unit_id", "run", "batch"]
    found = rows.groupBy(*brought).agg(F.max("stamp").alias("stamp"))
    newest = first_per_key(found, ["unit_id"], [F.desc_nulls_last("stamp"), F.col("run"), F.col("batch")])
    return keyed_join(rows, newest.select(*brought), brought, "left_semi").drop("run", "batch", "stamp")


def rebuilt_requests(
    requests: DataFrame, base: DataFrame, details: dict[str, tuple[DataFrame, str]], technology: str, kind: Column, ids: dict[str, str] | None = None
) -> DataFrame:
    """Requests after those of one technology were thrown away and made anew from missing details.

    `details` gives the detail table and its key column by kind of request (see `DETAIL_IDS`).
    """
    ids = ids or DETAIL_IDS
    units = base.filter(kind)
    kept = requests.filter(~F.col("technology").eqNullSafe(F.lit(technology)))
    new = detail_requests(units, F.lit(technology), ids)
    for data_type, (detail, key) in details.items():
        known = detail.select(F.col(key).cast("string").alias("additional_data_id"), F.lit(data_type).alias("data_type")).distinct()
        new = keyed_join(new, known, ["data_type", "additional_data_id"], "left_anti")
    return kept.unionByName(new.select(*kept.columns))


def deduplicated(source: DataFrame, keys: Sequence[str], stamp: str, delay: str) -> DataFrame:
    """Drop repeats of a row that arrive within the delay; older state is forgotten."""
    return source.withWatermark(stamp, delay).dropDuplicatesWithinWatermark(list(keys))
