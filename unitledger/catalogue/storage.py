"""Queries that write whole tables in the registry's formats and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from unitledger import specs
from unitledger.catalogue import Tables, query
from unitledger.registry import Registry, cleansed
from unitledger.session import shared_dir
from unitledger.sources import tables
from unitledger.sources.xml import folder_records

#: Rows of one XML file that Spark's XML writer makes, some 25 MB of part rows.
ROWS_OF_FILE = 100_000


def scratch(t: Tables, name: str) -> str:
    return f"{shared_dir(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("SELECT p_partkey, p_name, p_brand, p_size, p_retailprice, lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS ags FROM part")
def typed_csv_scan(t: Tables):
    path = scratch(t, "csv")
    out = t.part.select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice", F.lpad(F.col("p_partkey").cast("string"), 8, "0").alias("ags"))
    tables.write_csv(out, path, sep=";")
    kinds = {"p_partkey": "bigint", "p_name": "string", "p_brand": "string", "p_size": "int", "p_retailprice": "double", "ags": "string"}
    return tables.read_csv(t.spark, path, kinds, sep=";")


@query("SELECT c_custkey, 'Größe ' || c_name AS label, c_nationkey * 1.5e0 AS value FROM customer UNION ALL SELECT -c_custkey, 'Größe ' || c_name, c_nationkey * 1.5e0 FROM customer")
def legacy_csv_appended(t: Tables):
    """ISO-8859-1 text and decimal commas, written in two appends."""
    path = scratch(t, "legacy")
    rows = t.customer.select(
        "c_custkey", F.concat(F.lit("Größe "), "c_name").alias("label"), F.replace((F.col("c_nationkey") * 1.5).cast("string"), F.lit("."), F.lit(",")).alias("value")
    )
    for part in (rows, rows.withColumn("c_custkey", -F.col("c_custkey"))):
        part.write.mode("append").options(header=True, sep=";", encoding="ISO-8859-1").csv(path)
    return tables.read_csv(t.spark, path, {"c_custkey": "bigint", "label": "string", "value": "double"}, sep=";", encoding="windows-1252", decimal_comma=True)


@query('SELECT c_custkey, c_name AS "Behoerde", c_acctbal, n_name FROM customer JOIN nation ON n_nationkey = c_nationkey')
def snapshot_csv_roundtrip(t: Tables):
    from unitledger.functions.text import strip_carriage_returns

    path = scratch(t, "snapshot")
    rows = t.customer.withColumnRenamed("c_nationkey", "n_nationkey").join(t.nation, "n_nationkey")
    out = rows.select(F.concat("c_name", F.lit("\r")).alias("Behoerde"), "c_acctbal", "n_name", "c_custkey")
    tables.write_csv(strip_carriage_returns(out), path, key="c_custkey")
    return tables.read_csv(t.spark, path, {"c_custkey": "bigint", "Behoerde": "string", "c_acctbal": "double", "n_name": "string"})


@query(
    """SELECT CAST(p_partkey AS VARCHAR) AS "EinheitMastrNummer", p_name AS "NameWindpark", p_retailprice AS "Bruttoleistung",
              CASE WHEN length(CAST(p_size * 211 AS VARCHAR)) = 4 THEN '0' ELSE '' END || p_size * 211 AS "Postleitzahl",
              n_name AS "Bundesland", 'bulk' AS "DatenQuelle", '2024-01-31' AS "DatumDownload"
       FROM part LEFT JOIN nation ON n_nationkey = p_size"""
)
def xml_scan_roundtrip(t: Tables):
    """Part rows as XML with every row twice, loaded through the whole cleansing."""
    path = scratch(t, "xml")
    raw = t.part.select(
        F.col("p_partkey").cast("string").alias("EinheitMastrNummer"), F.col("p_name").alias("NameWindpark"),
        F.col("p_retailprice").cast("string").alias("Bruttoleistung"), (F.col("p_size") * 211).cast("string").alias("Postleitzahl"),
        F.col("p_size").cast("string").alias("Bundesland"),
    )
    twice = raw.unionAll(raw)
    # A file is one task for Spark's XML source, so files are cut by rows, whatever a writing task holds.
    twice.write.format("xml").options(rootTag="EinheitenWind", rowTag="EinheitWind", maxRecordsPerFile=ROWS_OF_FILE).save(path)
    rows = folder_records(t.spark, path, "einheitenwind", "EinheitWind", raw.columns, encoding="UTF-8")
    catalog = t.nation.select(F.col("n_nationkey").alias("Id"), F.col("n_name").alias("Wert"))
    done = cleansed(rows, specs.TABLES["einheitenwind"], catalog, "2024-01-31")
    return done.withColumn("DatumDownload", F.date_format("DatumDownload", "yyyy-MM-dd"))


@query(
    """SELECT 'wind' AS technology, count(*) AS units, count(*) FILTER (c_custkey IS NOT NULL) AS with_eeg FROM orders LEFT JOIN customer ON c_custkey = o_custkey AND o_orderstatus <> 'F'
       UNION ALL SELECT 'nuclear', count(*), NULL FROM supplier"""
)
def snapshot_tables(t: Tables):
    """A registry of two technologies, exported as CSV snapshots and counted from the files."""
    folder = scratch(t, "registry")
    registry = Registry(t.spark, folder)
    units = t.orders.select(
        F.concat(F.lit("SEE"), "o_orderkey").alias("EinheitMastrNummer"), F.col("o_totalprice").alias("Bruttoleistung"),
        F.when(F.col("o_orderstatus") != "F", F.concat(F.lit("EEG"), "o_custkey")).alias("EegMastrNummer"),
    )
    units.write.parquet(f"{folder}/wind_extended")
    t.customer.select(F.concat(F.lit("EEG"), "c_custkey").alias("EegMastrNummer"), F.col("c_acctbal").alias("InstallierteLeistung")).write.parquet(f"{folder}/wind_eeg")
    t.supplier.select(F.concat(F.lit("SEE"), "s_suppkey").alias("EinheitMastrNummer"), F.col("s_acctbal").alias("Bruttoleistung")).write.parquet(f"{folder}/nuclear_extended")
    registry.to_csv(f"{folder}/out", date="2024-01-31")
    base = f"{folder}/out/dataversion=2024-01-31"
    wind = t.spark.read.csv(f"{base}/table=wind", header=True)
    nuclear = t.spark.read.csv(f"{base}/table=nuclear", header=True)
    return wind.agg(F.count(F.lit(1)).alias("units"), F.count("EegMastrNummer_eeg").alias("with_eeg")).select(
        F.lit("wind").alias("technology"), "units", "with_eeg"
    ).unionAll(nuclear.select(F.lit("nuclear").alias("technology")).groupBy("technology").agg(F.count(F.lit(1)).alias("units"), F.lit(None).cast("bigint").alias("with_eeg")))


@query(
    """SELECT c_custkey AS id, 'Timeout' AS reason FROM customer WHERE c_mktsegment = 'BUILDING' UNION ALL SELECT s_suppkey, 'Broken' FROM supplier"""
)
def missed_record_file(t: Tables):
    path = scratch(t, "missed")
    tables.write_missed(t.customer.filter("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("id"), F.lit("Timeout").alias("reason")), path, "id")
    tables.write_missed(t.supplier.select(F.col("s_suppkey").alias("id"), F.lit("Broken").alias("reason")), path, "id")
    return t.spark.read.schema("id bigint, reason string").csv(path)


@query("SELECT n_nationkey AS id, n_name AS name, NULL::DOUBLE AS extra FROM nation UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def schema_evolution(t: Tables):
    """A later file with one more column joins the table; older rows carry NULL there."""
    path = scratch(t, "evolve")
    t.nation.select(F.col("n_nationkey").cast("bigint").alias("id"), F.col("n_name").alias("name")).write.parquet(f"{path}/wind_extended")
    t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("extra")).write.mode("append").parquet(f"{path}/wind_extended")
    return Registry(t.spark, path).table("wind_extended")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority = '1-URGENT'")
def reduced_copy(t: Tables):
    """The filtered copy of a cleansed table, written as a table of its own."""
    from unitledger.plans.cleansing import flag_b_units

    path = scratch(t, "reduced")
    units = t.orders.select(
        "o_orderkey", "o_totalprice", F.when(F.col("o_orderstatus") == "F", "B").otherwise("A").alias("StatisikFlag"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "InBetrieb").otherwise("InPlanung").alias("EinheitBetriebsstatus"),
    )
    flag_b_units(units).select("o_orderkey", "o_totalprice").write.parquet(path)
    return t.spark.read.parquet(path)


@query(
    """SELECT 'N' || c_custkey AS region_id, 5 AS n_corners, (c_custkey % 50) * 2e1 AS first_x FROM customer"""
)
def boundary_json_scan(t: Tables):
    """A boundary layer written as GeoJSON lines and read back as rings."""
    path = scratch(t, "rings")
    k = F.col("c_custkey")
    x, y = (k % 50) * 20.0, F.floor(k / 50) * 20.0

    def at(dx, dy):
        return F.array(x + dx, y + dy)

    ring = F.array(at(0, 0), at(10, 0), at(10, 10), at(0, 10), at(0, 0))
    feature = F.struct(
        F.struct(F.concat(F.lit("N"), k).alias("AGS")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates")).alias("geometry"),
    )
    t.customer.select(F.to_json(feature).alias("value")).write.text(path)
    rings = tables.read_geojson(t.spark, path, "AGS")
    return rings.select("region_id", F.size("ring").alias("n_corners"), F.element_at("ring", 1)["x"].alias("first_x"))


# Orders as units in numbered files: file 1 to 4 by key, and file 10 with some keys again. One in
# 13 has no key, one in 17 a broken record, one in 7 a `<` in its text.
ARCHIVE_FILES_SQL = """(SELECT o_orderkey AS n, 1 + o_orderkey % 4 AS file, o_totalprice AS p, o_orderdate AS d FROM orders
   UNION ALL SELECT o_orderkey, 10, o_totalprice, o_orderdate FROM orders WHERE o_orderkey % 5 = 0)"""


def _archive(t: Tables) -> Registry:
    """Writes the files, loads them and returns the loaded registry."""
    folder = scratch(t, "export").removeprefix("file:")
    n, file = F.col("n"), F.col("file")
    rows = t.orders.select(F.col("o_orderkey").alias("n"), (F.col("o_orderkey") % 4 + 1).alias("file"), "o_totalprice", "o_orderdate")
    rows = rows.unionByName(rows.filter("n % 5 = 0").withColumn("file", F.lit(10).cast("bigint")))
    element = lambda name, value: F.concat(F.lit(f"<{name}>"), value.cast("string"), F.lit(f"</{name}>"))
    park = F.when(n % 17 == 0, "<NameWindpark>open").when(n % 7 == 0, "<NameWindpark>a < b</NameWindpark>").otherwise("<NameWindpark>x &amp; y</NameWindpark>")
    record = F.concat(
        F.lit("<EinheitWind>"),
        F.when(n % 13 > 0, element("EinheitMastrNummer", F.concat(F.lit("SEE"), n))).otherwise(""),
        element("Weic", n), element("Bruttoleistung", F.col("o_totalprice")), element("Registrierungsdatum", F.to_date("o_orderdate")),
        element("Bundesland", 335 + n % 3), element("Gemeinde", file), element("AnzahlNeu", F.concat(n, F.lit(".5"))), park, F.lit("</EinheitWind>"),
    )
    catalog = "".join(f"<Katalogwert><Id>{335 + i}</Id><Wert>state {i}</Wert></Katalogwert>" for i in range(3))

    def write(batches):
        import os

        import pyarrow.compute as pc

        os.makedirs(folder, exist_ok=True)
        open_number, out = None, None
        for batch in batches:
            runs, begin = pc.run_end_encode(batch.column(0)), 0
            for number, end in zip(runs.values.to_pylist(), runs.run_ends.to_pylist()):
                if number != open_number:
                    if out:
                        out.write("</Root>")
                        out.close()
                    name = f"EinheitenWind_{number}" if number else "Katalogwerte"
                    open_number, out = number, open(f"{folder}/{name}.xml", "w", encoding="utf-16")
                    out.write("<Root>")
                out.write("".join(batch.column(1).slice(begin, end - begin).to_pylist()))
                begin = end
        if out:
            out.write("</Root>")
            out.close()
        yield from ()

    # One task per file. The rows move as they are; their texts are made where they are written.
    codes = t.spark.range(1).select(F.lit(0).cast("bigint").alias("file"))
    files = rows.unionByName(codes, allowMissingColumns=True).repartitionById(6, F.least(file, F.lit(5)).cast("int")).sortWithinPartitions("file")
    files = files.select("file", F.when(file == 0, F.lit(catalog)).otherwise(record).alias("record"))
    files.mapInArrow(write, "done int").write.format("noop").mode("overwrite").save()
    registry = Registry(t.spark, scratch(t, "registry"))
    registry.load(folder, "2024-01-31", data=["wind"])
    return registry


@query(
    f"""SELECT 'SEE' || n AS unit, round(min(p), 2) AS power, CAST(min(d) AS DATE) AS day, 'state ' || n % 3 AS state, n || '.5' AS unlisted,
          CASE WHEN n % 7 > 0 THEN 'x & y' END AS park FROM {ARCHIVE_FILES_SQL} WHERE n % 13 > 0 AND n % 17 > 0 GROUP BY n"""
)
def archive_load(t: Tables):
    table = _archive(t).table("wind_extended")
    return table.select(
        F.col("EinheitMastrNummer").alias("unit"), F.round("Bruttoleistung", 2).alias("power"), F.col("Registrierungsdatum").alias("day"),
        F.col("Bundesland").alias("state"), F.col("AnzahlNeu").alias("unlisted"), F.col("NameWindpark").alias("park"),
    )


@query(
    f"""SELECT CAST(file AS INT) AS file, CAST(n AS VARCHAR) AS n, CASE WHEN n % 17 = 0 THEN 'broken record' ELSE 'no key' END AS reason
        FROM {ARCHIVE_FILES_SQL} WHERE n % 13 = 0 OR n % 17 = 0"""
)
def archive_quarantine(t: Tables):
    aside = _archive(t).table("wind_extended__quarantine")
    return aside.select(F.col("file_no").alias("file"), F.regexp_extract("record", "<Weic>([0-9]+)<", 1).alias("n"), "reason")


@query(f"SELECT 'SEE' || n AS unit, CAST(min(file) AS VARCHAR) AS file FROM {ARCHIVE_FILES_SQL} WHERE n % 13 > 0 AND n % 17 > 0 GROUP BY n")
def archive_file_order(t: Tables):
    """The first file by number wins a repeated key: 2 comes before 10."""
    return _archive(t).table("wind_extended").select(F.col("EinheitMastrNummer").alias("unit"), F.col("Gemeinde").alias("file"))


@query(
    """SELECT o_orderpriority AS "table", count(*) AS "rows", max(o_orderdate) AS newest, round(sum(o_totalprice), 1) AS exported
       FROM orders WHERE o_orderstatus <> 'P' GROUP BY o_orderpriority
       UNION ALL SELECT NULL, count(*), max(o_orderdate), NULL FROM orders WHERE o_orderstatus <> 'P'"""
)
def export_newest_date(t: Tables):
    """Cleaned tables exported one by one; their newest stamps are seen on the way, and the files
    are read back to show what they hold."""
    path = scratch(t, "cleaned")
    rows = t.orders.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("EinheitMastrNummer"), F.col("o_orderpriority").alias("kind"), F.col("o_totalprice"),
        F.col("o_orderdate").cast("timestamp").alias("DatumLetzteAktualisierung"),
    )
    kinds = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    cleaned = {k: rows.filter(F.col("kind") == k) for k in kinds}
    told = Registry(t.spark, path).export_cleaned(cleaned, path, date="2024-01-01")
    # The same schema for every table, so the folder is read as one.
    back = t.spark.read.schema("EinheitMastrNummer bigint, kind string, o_totalprice double, at string").csv(f"{path}/dataversion=2024-01-01/table=*", header=True)
    sums = back.groupBy(F.col("kind").alias("table")).agg(F.round(F.sum("o_totalprice"), 1).alias("exported"))
    return told.join(sums, "table", "left").select("table", "rows", F.col("newest").cast("timestamp_ntz").alias("newest"), "exported")
