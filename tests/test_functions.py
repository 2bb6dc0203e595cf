"""Column functions on the inputs their rules are known for."""

import datetime

from pyspark.sql import functions as F

from unitledger.functions import dates, nested, text
from unitledger.operators import snapshot as snap


def one(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"c {kind}")
    return [r[0] for r in df.select(expression(F.col("c"))).collect()]


def test_zero_padding(spark):
    assert one(spark, [9162000.0, None, 19123456.0], "double", lambda c: text.pad_key(c.cast("bigint"), 8)) == ["09162000", None, "19123456"]
    assert one(spark, ["9162000.0", "DK-9999", "A-99", "1067", "123"], "string", lambda c: text.pad_key(c, 5)) == ["9162000", "DK-9999", "A-99", "01067", "123"]


def test_lenient_dates(spark):
    got = one(spark, ["2022-03-22", "2020-01-02", "2022-03-35", "x"], "string", dates.lenient_timestamp)
    assert got == [datetime.datetime(2022, 3, 22), datetime.datetime(2020, 1, 2), None, None]
    got = one(spark, ["2020-01-02 03:04:05.123456+0200", "2020-01-02 03:04:05", "gestern"], "string", dates.two_format_timestamp)
    assert got == [datetime.datetime(2020, 1, 2, 1, 4, 5, 123456), datetime.datetime(2020, 1, 2, 3, 4, 5), None]
    assert one(spark, ["2016.0", "2016"], "string", dates.year_only_date) == [datetime.date(2016, 1, 1), None]


def test_release_versions(spark):
    days = ["2024-01-01", "2024-04-01", "2024-04-02", "2024-10-01", "2024-10-02", "2024-12-31"]
    got = one(spark, days, "string", lambda c: dates.release_version(c.cast("date")))
    assert got == ["23.2", "23.2", "24.1", "24.1", "24.2", "24.2"]


def test_code_lists(spark):
    catalog = text.literal_map({335: "Bayern", 336: "Bremen"})
    got = one(spark, ["335", "335.0", "336", "335, 336,,1", " ,", "1", None], "string", lambda c: text.decode_list(c, catalog))
    assert got == ["Bayern", "Bayern", "Bremen", "Bayern,Bremen", None, None, None]
    assert one(spark, ["1", "77", None], "string", lambda c: text.code_to_text(c, text.LOCATION_TYPES)) == ["Stromerzeugungslokation", "77", None]


def test_coordinates_and_ids(spark):
    assert one(spark, ["8.1° E", "-7,5", "", "n/a"], "string", text.coordinate) == [8.1, -75.0, None, None]
    assert one(spark, ["SEE1", "SME1", "GEL2", "ABR1", ",,E"], "string", lambda c: c.rlike(text.DIRECT_ENTRY_IDS)) == [True, False, True, False, True]


def test_flatten_reply(spark):
    schema = (
        "Frist struct<Wert:date,NichtVorhanden:boolean>, WasserrechtAblaufdatum struct<Wert:date,NichtVorhanden:boolean>, "
        "VerknuepfteEinheiten array<struct<MaStRNummer:string,Einheittyp:string>>, Hersteller struct<Id:int,Wert:string>, ArtDerFlaeche array<string>, "
        "Ertuechtigung array<struct<Id:int,Art:string>>"
    )
    day = datetime.date(2020, 1, 2)
    rows = [((day, False), (None, True), [("SEE1", "W"), ("SEE2", "W")], (3, "Vestas"), ["a", "b"], [(1, None)]), ((None, True), None, [], None, [], None)]
    flat = nested.flatten_reply(spark.createDataFrame(rows, schema)).collect()
    assert (flat[0]["Frist"], flat[0]["VerknuepfteEinheiten"], flat[0]["ArtDerFlaeche"]) == (day, "SEE1, SEE2", "a,b")
    assert (flat[1]["Frist"], flat[1]["VerknuepfteEinheiten"], flat[1]["ArtDerFlaeche"], flat[1]["Hersteller"]) == (None, "", None, None)


def test_repeated_names_and_translation(spark):
    assert snap.numbered_repeats(["a", "b", "a", "a"]) == ["a", "b", "a_1", "a_2"]
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert snap.translate_columns(df, {"a": "x", "b": "x", "c": "a"}).columns == ["x", "b", "c"]
