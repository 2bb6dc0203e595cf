"""Session settings every job of the package relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings that change results; they are applied to whatever session a caller brings.
RESULT_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.ansi.enabled": "true",
}

# Settings that only change speed.
SPEED_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for name, value in {**RESULT_SETTINGS, **SPEED_SETTINGS}.items():
        if spark.conf.get(name, None) != value:
            spark.conf.set(name, value)
    return spark


def spark_session(master: str | None = None, app: str = "unitledger", **conf: str) -> SparkSession:
    """A session with the package settings; `master` is left to spark-submit unless given."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**RESULT_SETTINGS, **SPEED_SETTINGS, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local-mode session may fall back to a temporary folder; a cluster without the
    setting is an error, because a machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="unitledger-")
        spark.conf.set("spark.checkpoint.dir", folder)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder
