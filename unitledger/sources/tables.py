"""CSV and boundary scans, and the sinks of snapshots, labels and missed records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# windows-1252 differs from ISO-8859-1 in these characters (fixed values).
WINDOWS_1252 = dict(zip(range(0x80, 0xA0), "€\x81‚ƒ„…†‡ˆ‰Š‹Œ\x8dŽ\x8f\x90‘’“”•–—˜™š›œ\x9džŸ"))


def text_schema(columns: Sequence[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in columns])


def read_csv(
    spark: SparkSession,
    path: str,
    types: Mapping[str, str],
    sep: str = ",",
    encoding: str = "UTF-8",
    decimal_comma: bool = False,
    null_value: str = "",
    multi_line: bool = False,
) -> DataFrame:
    """Typed CSV scan. `types` names every column in file order; nothing is inferred, values
    of the wrong type become NULL, and unread columns are pruned at the scan.

    Files are split among tasks unless `multi_line` says that quoted values hold line breaks.
    """
    latin = encoding.lower() in ("windows-1252", "cp1252")
    raw = (
        spark.read.options(header=True, sep=sep, encoding="ISO-8859-1" if latin else encoding, nullValue=null_value)
        .options(multiLine=multi_line, escape='"')
        .schema(text_schema(list(types)))
        .csv(path)
    )
    columns = {}
    for name, kind in types.items():
        value = F.col(name)
        if latin:
            value = F.translate(value, "".join(map(chr, WINDOWS_1252)), "".join(WINDOWS_1252.values()))
        if decimal_comma and kind == "double":
            value = F.replace(value, F.lit(","), F.lit("."))
        columns[name] = value if kind == "string" else value.try_cast(kind)
    return raw.withColumns(columns)


def read_geojson(spark: SparkSession, path: str, name: str, region: str = "region_id") -> DataFrame:
    """Rings of GeoJSON features, one feature per line (polygons and multipolygons)."""
    schema = (
        f"properties struct<`{name}`:string>, geometry struct<type:string, coordinates:string>"
    )
    rows = spark.read.schema(schema).json(path)
    polygon = F.from_json("geometry.coordinates", "array<array<array<double>>>")
    multi = F.from_json("geometry.coordinates", "array<array<array<array<double>>>>")
    rings = F.when(F.col("geometry.type") == "MultiPolygon", F.flatten(multi)).otherwise(polygon)
    point = F.transform("_ring", lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return rows.select(F.col("properties")[name].alias(region), F.explode(rings).alias("_ring")).select(region, point.alias("ring"))


def key_first(df: DataFrame, key: str | None) -> DataFrame:
    if len(set(df.columns)) != len(df.columns):
        raise ValueError("duplicate column names in export")
    return df if key is None else df.select(key, *[c for c in df.columns if c != key])


def write_csv(df: DataFrame, path: str, key: str | None = None, mode: str = "overwrite", sep: str = ",") -> None:
    """A folder of UTF-8 CSV parts, each with a header, the key first. An empty result is a
    folder without parts."""
    out = key_first(df, key)
    out.write.mode(mode).options(header=True, sep=sep, escape='"', nullValue="", emptyValue='""').csv(path)


def write_csv_observed(df: DataFrame, path: str, stamp: str, key: str | None = None, sep: str = ",") -> tuple[int, object]:
    """`write_csv` that also gives the number of rows and the newest stamp (None without any), taken
    from the rows on their way into the file: the table is read once."""
    seen = Observation()
    write_csv(df.observe(seen, F.count(F.lit(1)).alias("rows"), F.max(stamp).alias("newest")), path, key, sep=sep)
    return seen.get["rows"], seen.get["newest"]


def write_missed(missed: DataFrame, path: str, key: str) -> None:
    """`(id, reason)` lines of requests that failed; later runs append."""
    missed.select(key, "reason").write.mode("append").csv(path)


def write_jdbc(df: DataFrame, url: str, table: str, batch: int = 10_000, **properties: str) -> None:
    """Bulk insert into a database the user runs, in batches per partition."""
    df.write.option("batchsize", batch).mode("append").jdbc(url, table, properties=properties)


def read_jdbc(
    spark: SparkSession, url: str, table: str, column: str, low: int, high: int, partitions: int, **properties: str
) -> DataFrame:
    """Partitioned scan of a database table by ranges of a numeric column."""
    return spark.read.jdbc(url, table, column, low, high, partitions, properties=properties)
