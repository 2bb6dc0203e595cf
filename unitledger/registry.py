"""The registry as a user meets it: load an export, read tables, export snapshots, translate."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from unitledger import specs
from unitledger.functions.text import pad_known_keys, strip_carriage_returns
from unitledger.operators.skew import first_per_key
from unitledger.operators.snapshot import reverse_fill, snapshot_from_extended, translate_columns
from unitledger.session import configure
from unitledger.sources.catalog import decode_columns, decode_fixed
from unitledger.sources.tables import write_csv, write_csv_observed
from unitledger.sources.xml import ORDER, archive_records, parse_records
from unitledger.streaming.mirror import newest_stamp


def cleansed(
    rows: DataFrame, spec: specs.TableSpec, catalog: DataFrame | None, download_date: str, order: Sequence[str] = ORDER
) -> DataFrame:
    """Raw text rows of one table to registry rows: padded keys, names, provenance, types,
    decoded texts, and one row per primary key (the first in file order)."""
    named = pad_known_keys(rows).withColumnsRenamed(spec.renames)
    unique = named
    if spec.key in named.columns:
        unique = first_per_key(named.filter(F.col(spec.key).isNotNull()), [spec.key], [F.col(c) for c in order])
    plain = unique.drop(*order, "stem", "_corrupt")
    marked = plain.withColumns({"DatenQuelle": F.lit("bulk"), "DatumDownload": F.lit(download_date)})
    typed = specs.typed(marked, spec.types)
    if catalog is None:
        return typed
    return decode_columns(decode_fixed(typed), catalog, specs.CODED_COLUMNS)


class Registry:
    """Parquet tables below one folder, one sub-folder per table.

    A table folder holds versions and a pointer to the current one. A load writes a new version
    and moves the pointer when it is complete, so readers see the old table or the new one, and a
    load that fails leaves the old one. The version before stays for those who still read it.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = configure(spark), path

    def _place(self, name: str):
        """File system, and path below the registry's folder."""
        place = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return place.getFileSystem(self.spark._jsc.hadoopConfiguration()), place

    def _version(self, name: str) -> str | None:
        """The folder of a table's current version: that with the highest pointer."""
        fs, place = self._place(name)
        names = [f.getPath().getName() for f in fs.listStatus(place)] if fs.exists(place) else []
        pointers = sorted(n for n in names if n.startswith("_current-"))
        return pointers[-1].removeprefix("_current-") if pointers else None

    def table(self, name: str) -> DataFrame:
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/{name}/{self._version(name) or ''}")

    def has(self, name: str) -> bool:
        fs, place = self._place(name)
        return fs.exists(place)

    def replace(self, name: str, rows: DataFrame) -> None:
        """Make `rows` the content of a table, all at once. The pointer is an empty folder made in one
        step; versions before the last one are removed."""
        before = self._version(name)
        number = int(before.partition("-")[0].removeprefix("v")) + 1 if before else 0
        version = f"v{number:08d}-{uuid.uuid4().hex}"
        rows.write.parquet(f"{self.path}/{name}/{version}")
        fs, _ = self._place(name)
        fs.mkdirs(self._place(f"{name}/_current-{version}")[1])
        for status in fs.listStatus(self._place(name)[1]):
            old = status.getPath().getName().removeprefix("_current-")
            if old.startswith("v") and old not in (version, before) and old < version:
                fs.delete(status.getPath(), True)

    def load(
        self, source: str, date: str, data: list[str] | str | None = None, cleansing: bool = True, encoding: str = "utf-16"
    ) -> list[str]:
        """Load the chosen datasets from a zip or folder of XML files; each table is replaced at once.

        Columns the files bring are all kept. Broken records and those without a key, if any, go to
        `<table>__quarantine` with the reason.
        """
        stems = specs.stems_of(specs.check_datasets(data))
        records = archive_records(self.spark, source, [*stems, "katalogwerte"], encoding)
        catalog = None
        if cleansing:
            catalog, _ = parse_records(records.filter("stem = 'katalogwerte'"), ["Id", "Wert"])
        present = {r["stem"] for r in records.select("stem").distinct().collect()}
        loaded = []
        for stem in stems:
            spec = specs.TABLES[stem]
            if stem not in present:
                continue
            seen = Observation()
            keys = [spec.key, *[raw for raw, name in spec.renames.items() if name == spec.key]] if spec.key else []
            rows, broken = parse_records(records.filter(F.col("stem") == stem), seen=seen, keys=keys)
            self.replace(spec.table, cleansed(rows, spec, catalog, date))
            if seen.get["broken"]:
                self.replace(f"{spec.table}__quarantine", broken)
            loaded.append(spec.table)
        return loaded

    def basic_units(self, technologies: Sequence[str]) -> DataFrame:
        """The basic table rebuilt from the unit tables of the technologies."""
        units = {specs.TYPE_OF_TECHNOLOGY[t]: self.table(f"{t}_extended") for t in technologies}
        return reverse_fill(units, specs.BASIC_COLUMNS, "Einheittyp")

    def snapshot(self, technology: str, limit: int | None = None) -> DataFrame:
        """All data of one technology joined per unit."""
        details = {}
        for role in specs.TECHNOLOGY_ROLES[technology][1:]:
            name = role if role in ("kwk", "permit") else f"{technology}_{role}"
            if self.has(name):
                details[role] = self.table(name)
        unit_type = specs.TYPE_OF_TECHNOLOGY[technology]
        units = self.table(f"{technology}_extended")
        return strip_carriage_returns(snapshot_from_extended(units, details, unit_type, specs.BASIC_COLUMNS, limit))

    def to_csv(self, out: str, tables: Sequence[str] | None = None, limit: int | None = None, date: str | None = None) -> list[str]:
        """Export technologies as joined snapshots and other tables as they are, by default all
        that are loaded, into `<out>/dataversion=<date>/table=<name>`."""
        known = [*specs.TECHNOLOGY_ROLES, *specs.ADDITIONAL_TABLES]
        wanted = list(tables or known)
        if unknown := [t for t in wanted if t not in known]:
            raise ValueError(f"unknown tables {unknown}")
        base = f"{out}/dataversion={date}" if date else out
        done = []
        for name in wanted:
            if name in specs.TECHNOLOGY_ROLES:
                if self.has(f"{name}_extended"):
                    write_csv(self.snapshot(name, limit), f"{base}/table={name}", key="EinheitMastrNummer")
                    done.append(name)
            elif self.has(name):
                df = self.table(name)
                key = next((s.key for s in specs.TABLES.values() if s.table == name), None)
                rows = df.orderBy(key).limit(limit) if limit and key in df.columns else df
                write_csv(rows, f"{base}/table={name}", key=key if key in df.columns else None)
                done.append(name)
        return done

    def newest(self, tables: Sequence[str], stamp: str = "DatumLetzteAktualisierung") -> DataFrame:
        """Newest stamp of each loaded table that carries one."""
        from functools import reduce

        parts = [
            newest_stamp(self.table(t), stamp).select(F.lit(t).alias("table"), F.col(stamp).cast("string").alias("newest"))
            for t in tables
            if self.has(t) and stamp in self.table(t).columns
        ]
        if not parts:
            return self.spark.createDataFrame([], "table string, newest string")
        return reduce(DataFrame.unionAll, parts)

    def export_cleaned(
        self, cleaned: Mapping[str, DataFrame], out: str, limit: int | None = None, date: str | None = None,
        key: str = "EinheitMastrNummer", stamp: str = "DatumLetzteAktualisierung",
    ) -> DataFrame:
        """Export post-processed tables, one folder each below `<out>/dataversion=<date>`, and tell
        rows and newest stamp of each and of all (`table` NULL), seen while they were written.
        A limit takes the first rows by key of every table."""
        base = f"{out}/dataversion={date}" if date else out
        kind = next((df.schema[stamp].dataType.simpleString() for df in cleaned.values()), "timestamp")
        told = []
        for name, df in cleaned.items():
            rows = df.orderBy(key).limit(limit) if limit else df
            told.append((name, *write_csv_observed(rows, f"{base}/table={name}", stamp, key)))
        stamps = [x for *_, x in told if x is not None]
        told.append((None, sum(n for _, n, _ in told), max(stamps, default=None)))
        return self.spark.createDataFrame(told, f"table string, rows bigint, newest {kind}")

    def translate(self, names: Mapping[str, str], target: str, tables: Sequence[str] | None = None) -> "Registry":
        """Copy the tables with translated column names; the dictionary is the user's."""
        done = Registry(self.spark, target)
        for name in tables or [s.table for s in specs.TABLES.values() if s.table and self.has(s.table)]:
            done.replace(name, translate_columns(self.table(name), names))
        return done
