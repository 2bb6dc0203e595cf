"""Registry analytics on Spark: load, clean, join, check and map unit registers."""

from unitledger.session import configure, shared_dir, spark_session

__all__ = ["configure", "shared_dir", "spark_session"]
