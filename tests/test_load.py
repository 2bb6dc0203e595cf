"""Loading exports: zip and folder sources, padding, types, decoding, keys, repair."""

import datetime
import random
import zipfile

import pytest
from pyspark.sql import functions as F

from unitledger import specs
from unitledger.registry import Registry
from unitledger.sources.xml import archive_records, folder_records, parse_records, split_records

CATALOG = '<?xml version="1.0" encoding="UTF-16"?><Katalogwerte>%s</Katalogwerte>'
VALUE = "<Katalogwert><Id>%d</Id><Wert>%s</Wert></Katalogwert>"


def unit(number, state="335", day="2022-03-22", extra="", power="2300.5"):
    return (
        f"<EinheitWind><EinheitMastrNummer>SEE{number}</EinheitMastrNummer><LokationMaStRNummer>SEL{number}</LokationMaStRNummer>"
        f"<Registrierungsdatum>{day}</Registrierungsdatum><Bundesland>{state}</Bundesland><Gemeindeschluessel>9162000</Gemeindeschluessel>"
        f"<Postleitzahl>1067</Postleitzahl><Bruttoleistung>{power}</Bruttoleistung>{extra}</EinheitWind>"
    )


def document(*units):
    return '<?xml version="1.0" encoding="UTF-16"?>\n<EinheitenWind>\n' + "\n".join(units) + "\n</EinheitenWind>"


@pytest.fixture(scope="module")
def archive(tmp_path_factory):
    path = tmp_path_factory.mktemp("export") / "export.zip"
    files = {f"EinheitenWind_{i}.xml": document(unit(i), unit(100 + i)) for i in range(1, 12)}
    files["EinheitenWind_2.xml"] = document(
        unit(2, state="336", day="2022-03-35"),
        unit(1, state="336"),  # key of file 1 again
        unit(200, state="335, 336 ,9", extra="<NameWindpark>A & B</NameWindpark><Neu>x &amp; y</Neu>"),
        unit(201, state="9", power="viel"),
        unit(202, extra="<NameWindpark>tief\x03</NameWindpark>"),
        "<EinheitWind><EinheitMastrNummer>SEE203</EinheitMastrNummer><NameWindpark>a < b</NameWindpark></EinheitWind>",
        "<EinheitWind><EinheitMastrNummer>SEE204</EinheitMastrNummer><NameWindpark>a <b</NameWindpark></EinheitWind>",
        "<EinheitWind><EinheitMastrNummer>SEE205</EinheitMastrNummer><NameWindpark>open</EinheitWind>",
        "<EinheitWind><NameWindpark>keyless</NameWindpark></EinheitWind>",
    )
    files["Katalogwerte.xml"] = CATALOG % (VALUE % (335, "Bayern") + VALUE % (336, "Bremen"))
    files["Unbekannt.xml"] = document(unit(999))
    with zipfile.ZipFile(path, "w") as z:
        for name, content in files.items():
            z.writestr(name, content.encode("utf-16"))
    return str(path)


@pytest.fixture(scope="module")
def registry(spark, archive, tmp_path_factory):
    registry = Registry(spark, str(tmp_path_factory.mktemp("registry")))
    assert registry.load(archive, "2024-01-31", data=["wind"]) == ["wind_extended"]
    return registry


def rows_of(registry):
    return {r["EinheitMastrNummer"]: r for r in registry.table("wind_extended").collect()}


def test_load_pads_types_decodes_and_keeps_first_per_key(registry):
    rows = rows_of(registry)
    assert len(rows) == 10 * 2 + 6 and "SEE999" not in rows  # ten plain files, six good new keys in file 2
    first = rows["SEE1"]
    assert first["Bundesland"] == "Bayern"  # file 1 wins over file 2, and 2 comes before 10
    assert (first["Gemeindeschluessel"], first["Postleitzahl"]) == ("09162000", "01067")
    assert first["LokationMastrNummer"] == "SEL1" and first["Bruttoleistung"] == 2300.5
    assert str(first["Registrierungsdatum"]) == "2022-03-22"
    assert (first["DatenQuelle"], str(first["DatumDownload"])) == ("bulk", "2024-01-31")


def test_load_nulls_bad_values_and_unknown_codes(registry):
    rows = rows_of(registry)
    assert rows["SEE2"]["Bundesland"] == "Bremen" and rows["SEE2"]["Registrierungsdatum"] is None
    assert rows["SEE200"]["Bundesland"] == "Bayern,Bremen"
    assert rows["SEE201"]["Bundesland"] is None and rows["SEE201"]["Bruttoleistung"] is None


def test_load_repairs_records_and_quarantines_the_rest(registry):
    rows = rows_of(registry)
    assert rows["SEE200"]["NameWindpark"] is None and rows["SEE200"]["Neu"] == "x & y"
    assert rows["SEE202"]["NameWindpark"] is None and rows["SEE202"]["Bruttoleistung"] == 2300.5
    assert "SEE203" in rows and rows["SEE203"]["NameWindpark"] is None  # `a < b` is blanked, the row stays
    aside = {r["reason"]: r["record"] for r in registry.table("wind_extended__quarantine").collect()}
    assert set(aside) == {"broken record", "no key"}
    assert rows["SEE204"]["NameWindpark"] is None and "b" not in registry.table("wind_extended").columns  # `a <b` too
    assert "SEE205" in aside["broken record"] and "keyless" in aside["no key"]


def test_snapshot_export_and_translation(spark, registry, tmp_path):
    assert registry.to_csv(str(tmp_path / "out"), tables=["wind"], limit=5) == ["wind"]
    out = spark.read.csv(str(tmp_path / "out" / "table=wind"), header=True)
    assert out.columns[0] == "EinheitMastrNummer" and out.count() == 5
    assert "EinheitMastrNummer_extended" in out.columns and "Bruttoleistung_extended" in out.columns
    with pytest.raises(ValueError):
        registry.to_csv(str(tmp_path), tables=["wint"])
    english = registry.translate({"Bruttoleistung": "gross_power", "Neu": "gross_power"}, str(tmp_path / "en"))
    columns = english.table("wind_extended").columns
    assert "gross_power" in columns and "Neu" in columns  # the clash is skipped


def test_folder_source_reads_utf16(spark, tmp_path):
    for i in (1, 10):
        (tmp_path / f"EinheitenWind_{i}.xml").write_bytes(document(unit(i), unit(5, state=str(i))).encode("utf-16"))
    columns = ["EinheitMastrNummer", "Bundesland", "Postleitzahl"]
    rows = folder_records(spark, str(tmp_path), "einheitenwind", "EinheitWind", columns).collect()
    assert sorted((r["file_no"], r["EinheitMastrNummer"]) for r in rows) == [(1, "SEE1"), (1, "SEE5"), (10, "SEE10"), (10, "SEE5")]
    records = archive_records(spark, str(tmp_path), ["einheitenwind"])
    good, _ = parse_records(records)
    assert good.filter("EinheitMastrNummer = 'SEE5'").count() == 2


def test_records_split_at_any_chunk_size():
    body = document(unit(1), unit(2, extra="<X/>"), unit(3))
    for size in (1, 7, 64, 10_000):
        chunks = (body[i : i + size] for i in range(0, len(body), size))
        assert [r.count("EinheitMastrNummer") for r in split_records(chunks)] == [2, 2, 2]


def test_file_order_is_numeric():
    names = [f"EinheitenSolar_{i}.xml" for i in (1, 10, 11, 2)] + ["Katalogwerte.xml", "EinheitenSolar_02.xml"]
    assert [specs.stem_of_file(n) for n in names] == [
        ("einheitensolar", 1), ("einheitensolar", 10), ("einheitensolar", 11), ("einheitensolar", 2), ("katalogwerte", 1), ("einheitensolar", 2),
    ]


def test_dataset_names():
    assert len(specs.stems_of(["wind", "hydro"])) == 4
    assert specs.tables_of(["market"]) == ["market_actors", "market_roles"]
    for name in specs.DATASETS:
        assert specs.check_datasets([name]) == [name] == specs.check_datasets(name)
    for bad in (["wint"], ["Solar"], "biomasse", 5, []):
        with pytest.raises(ValueError):
            specs.check_datasets(bad)


def test_catalog_decoding_has_one_rule(spark):
    from unitledger.sources import catalog

    codes = spark.createDataFrame([(1, "b"), (1, "a"), (2, "b"), (3, None), (None, "n")], "Id int, Wert string")
    df = spark.createDataFrame([(1, "2, 1,9", "x"), (2, "9", "x"), (3, None, "x"), (None, "1", "x"), (1, "2", "x")], "k int, c string, z string")
    want = [(1, "b,a", "x"), (1, "b", "x"), (2, None, "x"), (3, None, "x"), (None, "a", "x")]
    for limit in ("10m", "-1", "100"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            got = catalog.decode_columns(df, codes, ["c"])
            assert got.columns == ["k", "c", "z"] and sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_decoding_in_place_equals_the_join_and_moves_no_row(spark):
    from unitledger.sources import catalog

    codes = spark.range(3000).selectExpr("(id - 700) * 3 % 2000 as Id", "concat('text ', id % 97) as Wert")
    codes = codes.unionByName(spark.createDataFrame([(5, ""), (None, "n"), (6, None), (-9_000_000_000, "far")], "Id long, Wert string"))
    lists = "concat_ws(',', id * 7 % 2500 - 300, nullif(id % 5, 0), if(id % 3 = 0, ' x ,', null), if(id % 11 = 0, '-9000000000', null))"
    df = spark.range(2000).selectExpr("nullif(id % 900, 7) as k", f"if(id % 13 = 0, null, {lists}) as `a.b`", "cast(id % 6 as string) as c", "'kept' as _texts0")
    in_place, joined = (catalog.decode_columns(df, codes, ["a.b", "c", "absent"], in_place=way) for way in (True, False))
    assert in_place.columns == df.columns == joined.columns
    key = lambda r: tuple(map(str, r))
    got = sorted(map(key, in_place.collect()))
    assert got == sorted(map(key, joined.collect())) and len(got) == 2000
    plan = in_place._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and plan.count("text 42") <= 40  # the table stands there once
    assert catalog.decode_columns(df, codes.limit(0), ["c"]).filter("c is not null").count() == 0
    assert catalog.decode_columns(df.limit(0), codes, ["c"]).count() == 0


def test_no_record_gets_lost():
    split = lambda text, size=5: list(split_records(text[i : i + size] for i in range(0, len(text), size)))
    assert split("<R><U>1</U><U/><U a='1'/><U>2</U ><U>3</U></R>") == ["<U>1</U>", "<U/>", "<U a='1'/>", "<U>2</U >", "<U>3</U>"]
    assert split("<R><U>1</U><U>cut o") == ["<U>1</U>", "<U>cut o"]
    assert split("<R><U>1</U>tail</R>") == ["<U>1</U>", "tail</R>"]
    assert split("") == split("<R></R>") == split("<?xml version='1.0'?>\n<R/>") == []
    assert split("no xml at all") == ["no xml at all"]


def test_export_tells_the_newest_stamp_it_wrote(spark, tmp_path):
    from unitledger.registry import Registry

    schema = "EinheitMastrNummer string, DatumLetzteAktualisierung date, v int"
    day = lambda d: None if d is None else datetime.date(2024, 1, d)
    make = lambda *rows: spark.createDataFrame([(k, day(d), v) for k, d, v in rows], schema)
    cleaned = {"wind": make(("b", 9, 1), ("a", 3, 2), ("c", None, 3)), "solar": make(("x", 20, 1)), "none": make(), "unknown": make(("k", None, 1))}
    registry = Registry(spark, str(tmp_path / "r"))
    got = {r.table: (r.rows, r.newest) for r in registry.export_cleaned(cleaned, str(tmp_path / "out"), date="d").collect()}
    assert got == {"wind": (3, day(9)), "solar": (1, day(20)), "none": (0, None), "unknown": (1, None), None: (5, day(20))}
    back = spark.read.csv(str(tmp_path / "out/dataversion=d/table=wind"), header=True)
    assert back.columns == ["EinheitMastrNummer", "DatumLetzteAktualisierung", "v"] and back.count() == 3
    first = {r.table: (r.rows, r.newest) for r in registry.export_cleaned(cleaned, str(tmp_path / "two"), limit=1).collect()}
    assert first["wind"] == (1, day(3)) and first[None] == (3, day(20))
    assert registry.newest(["wind_extended"]).collect() == []


def test_stray_brackets_are_blanked_and_their_records_kept(spark):
    cases = {
        "<U><A>1</A><B>a <b</B><C>x</C></U>": ("1", None, "x"),
        "<U><A>2</A><B>a <b> c <d e</B><C>x</C></U>": ("2", None, "x"),
        "<U><A>3</A><B>a << < <b &amp; &</B><C>x</C></U>": ("3", None, "x"),
        "<U><A>4</A><B k='v'>" + "long <text " * 50_000 + "</B><C>x</C></U>": ("4", None, "x"),
        "<U><A>5</A><B>fine</B><C/></U>": ("5", "fine", None),
        "<U><A>6</A><B>open<C>x</C></U>": None,
        "<U><A>7</A><B>open": None,
    }
    df = spark.createDataFrame([("u", 1, i, r) for i, r in enumerate(cases)], "stem string, file_no int, row_no long, record string")
    good, aside = parse_records(df, keys=["A"])
    assert good.columns == ["stem", "file_no", "row_no", "A", "B", "C"]
    assert sorted((r.A, r.B, r.C) for r in good.collect()) == sorted(w for w in cases.values() if w)
    assert {r.record for r in aside.collect()} == {r for r, w in cases.items() if w is None}


def test_a_long_record_stays_whole():
    text = "<R><U><A>" + "x" * 40_000_000 + "</A></U><U/></R>"
    chunks = (text[i : i + (1 << 20)] for i in range(0, len(text), 1 << 20))
    assert [len(r) for r in split_records(chunks)] == [len(text) - 11, 4]


def test_a_failed_load_leaves_the_old_table(spark, tmp_path):
    registry = Registry(spark, str(tmp_path))
    rows = lambda v: spark.range(4).selectExpr("id", f"{v} as v")
    registry.replace("t", rows(1))
    reader = registry.table("t")
    with pytest.raises(Exception):
        registry.replace("t", rows(2).withColumn("v", F.expr("if(id = 3, raise_error('half way'), v)").cast("int")))
    assert {r.v for r in registry.table("t").collect()} == {1}
    registry.replace("t", rows(3))
    assert {r.v for r in registry.table("t").collect()} == {3} and {r.v for r in reader.collect()} == {1}  # still readable
    registry.replace("t", rows(4))
    registry.replace("t", rows(5))
    assert {r.v for r in registry.table("t").collect()} == {5}
    assert sum(p.name.startswith("v") for p in (tmp_path / "t").iterdir()) == 2


def test_one_file_is_read_in_ranges(spark, tmp_path):
    from unitledger.sources import xml

    rng = random.Random(5)
    units = [unit(i, extra=f"<NameWindpark>{'Größe ' * rng.randrange(40)}&amp;</NameWindpark><EinheitWindTyp>{i}</EinheitWindTyp>") for i in range(900)]
    units[100] = "<EinheitWind><EinheitMastrNummer>SEE100</EinheitMastrNummer><Weic>" + "y" * 90_000 + "</Weic></EinheitWind>"  # over several ranges
    units[200:203] = ["<EinheitWind/>", "<EinheitWind a='1'><EinheitMastrNummer>SEE201</EinheitMastrNummer></EinheitWind>", "<EinheitWind>\n</EinheitWind >"]
    body = document(*units).replace(' encoding="UTF-16"', "")
    for encoding, given, data in (
        ("utf-16-le", "utf-16", b"\xff\xfe" + body.encode("utf-16-le")),
        ("utf-16-be", "utf-16", b"\xfe\xff" + body.encode("utf-16-be")),
        ("utf-8", "utf-8", body.encode()),
        ("utf-8", "utf-8", b"\xef\xbb\xbf" + body.encode()),
    ):
        file = tmp_path / f"{encoding}{len(data)}" / "EinheitenWind_12.xml"
        file.parent.mkdir()
        file.write_bytes(data)
        assert xml.record_start(spark, [str(file)], given) == ("<EinheitWind>", encoding)
        for size in (1_001, 20_000, 10_000_000):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", 1)
            try:
                records = xml.split_records_of(spark, "einheitenwind", [str(file)], "<EinheitWind>", encoding)
                rows = sorted(records.collect(), key=lambda r: r.row_no)
                # The session packs ranges into tasks; at 1001 bytes each task has about that much.
                assert records.rdd.getNumPartitions() > 5 if size < 100_000 else len(rows) == 900
            finally:
                spark.conf.unset("spark.sql.files.maxPartitionBytes")
                spark.conf.unset("spark.sql.files.openCostInBytes")
            assert [r.record for r in rows] == units
            assert {(r.stem, r.file_no) for r in rows} == {("einheitenwind", 12)}
        got = archive_records(spark, f"file:{file.parent}", ["einheitenwind"], given)
        assert sorted(r.record for r in got.collect()) == sorted(units)


def test_odd_files_lose_nothing(spark, tmp_path):
    good = "<U><A>1</A></U>"
    cases = {
        "EinheitenWind_1": ("<R>" + good * 3 + "</R>", [good] * 3),
        "EinheitenWind_2": ("<R/>", []),
        "EinheitenWind_3": ("", []),
        "EinheitenWind_4": ("<R></R>", []),
        "EinheitenWind_5": ("no xml at all", ["no xml at all"]),
        "EinheitenWind_6": ("<R><U>cut o<U><A>2</A></U>tail" + good + "<U><A>3", ["<U>cut o", "<U><A>2</A></U>", "tail", good, "<U><A>3"]),
        "EinheitenWind_7": ("<?xml version='1.0'?>\n<!-- c -->\n<R k='v'>\n<U/>\n" + good + "\n</R >\n", ["<U/>", good]),
        "EinheitenSolar_1": ("<R><S a='1'><A>1</A></S><S><A>2</A></S></R>", ["<S a='1'><A>1</A></S>", "<S><A>2</A></S>"]),
        "Netze": ("<R/>", []),
    }
    for name, (content, _) in cases.items():
        (tmp_path / f"{name}.xml").write_text(content, encoding="utf-8")
    rows = archive_records(spark, str(tmp_path), encoding="utf-8").orderBy("stem", "file_no", "row_no").collect()
    for name, (_, want) in cases.items():
        stem, number = specs.stem_of_file(name)
        assert [r.record for r in rows if (r.stem, r.file_no) == (stem, number)] == want, name
    assert len(rows) == sum(len(want) for _, want in cases.values())


def test_a_record_is_parsed_once_and_columns_are_found_whole(spark):
    from pyspark.sql import Observation

    from unitledger.sources.xml import record_columns

    records = ["<U><A>1</A><B k='v'/><C.d >x</C.d ></U>", "<U><A>2</A><E/><F_1>a < b</F_1></U>", "<U><A>3</A><G>open</U>", "<U><H>4</H></U>", None, "text"]
    df = spark.createDataFrame([("u", 1, i, r) for i, r in enumerate(records)], "stem string, file_no int, row_no long, record string")
    assert record_columns(df) == ["A", "B", "C.d", "E", "F_1", "H"]
    seen = Observation()
    good, aside = parse_records(df, seen=seen, keys=["A"])
    assert seen.get["broken"] == 4  # counted while the parsed rows are written, before either is read
    for part in (good, aside):
        assert "from_xml" not in part._jdf.queryExecution().optimizedPlan().toString()
    plan = parse_records(df, ["A", "E", "H"], keys=["A"])[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_xml(") + plan.count("XmlToStructsEvaluator") <= 2  # the first try and the second, not one per column
    assert sorted(r.A for r in good.collect()) == ["1", "2"]
    assert sorted(r.reason for r in aside.collect()) == ["broken record", "broken record", "broken record", "no key"]


def test_numbered_files_are_written_by_a_task_each(spark, tmp_path, monkeypatch):
    from unitledger.catalogue import Tables, storage

    rows = spark.range(400).selectExpr("id as o_orderkey", "cast(id as double) as o_totalprice", "timestamp_ntz'2024-01-01' as o_orderdate")
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    seen = []
    monkeypatch.setattr(storage.Registry, "load", lambda self, folder, *a, **k: seen.append(folder))
    storage._archive(Tables(spark, str(tmp_path)))
    texts = {p.stem: p.read_text("utf-16") for p in __import__("pathlib").Path(seen[0]).iterdir()}
    counts = {name: text.count("<EinheitWind>") for name, text in texts.items()}
    assert counts == {"Katalogwerte": 0, **{f"EinheitenWind_{i}": 100 for i in (1, 2, 3, 4)}, "EinheitenWind_10": 80}
    assert all(text.startswith("<Root>") and text.endswith("</Root>") for text in texts.values()) and texts["Katalogwerte"].count("<Id>") == 3


def test_written_xml_files_stay_small(spark, tmp_path, monkeypatch):
    from unitledger.catalogue import Tables, storage

    spark.range(300).selectExpr(
        "id as p_partkey", "concat('p', id) as p_name", "cast(id as double) as p_retailprice", "cast(id % 50 as int) as p_size"
    ).coalesce(1).write.parquet(str(tmp_path / "part.parquet"))
    spark.range(25).selectExpr("cast(id as int) as n_nationkey", "concat('n', id) as n_name").write.parquet(str(tmp_path / "nation.parquet"))
    monkeypatch.setattr(storage, "ROWS_OF_FILE", 40)
    folder = tmp_path / "out"
    monkeypatch.setattr(storage, "scratch", lambda t, name: str(folder))
    assert storage.xml_scan_roundtrip(Tables(spark, str(tmp_path))).count() == 300
    counts = [p.read_text().count("<EinheitWind>") for p in folder.glob("part-*")]
    assert sum(counts) == 600 and max(counts) <= 40
