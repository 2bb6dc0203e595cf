"""The snapshot read from the unit table equals the join of rebuilt basic rows with it."""

from unitledger import specs
from unitledger.operators import snapshot as snap


def test_projection_equals_join(spark):
    units = spark.createDataFrame(
        [("SEE1", "2024", "EEG1", 5.0, "GEN9"), ("SEE2", "2023", None, 7.0, None), ("SEE3", "2022", "EEG1", None, "GEN1")],
        "EinheitMastrNummer string, DatumLetzteAktualisierung string, EegMastrNummer string, Bruttoleistung double, GenMastrNummer string",
    )
    eeg = spark.createDataFrame([("EEG1", "x", "r")], "EegMastrNummer string, Meldedatum string, DatumLetzteAktualisierung string")
    permit = spark.createDataFrame([("GEN9", "a\rb")], "GenMastrNummer string, Behoerde string")
    details = {"eeg": eeg, "permit": permit}
    basic = snap.reverse_fill({"Windeinheit": units}, specs.BASIC_COLUMNS, "Einheittyp")
    joined = snap.technology_snapshot(basic, {"extended": units, **details}, "Windeinheit")
    direct = snap.snapshot_from_extended(units, details, "Windeinheit", specs.BASIC_COLUMNS)
    assert direct.columns == joined.columns
    assert "DatumLetzteAktualisierung_1" in direct.columns and "EegMastrNummer_eeg" in direct.columns
    assert sorted(map(tuple, direct.collect())) == sorted(map(tuple, joined.collect()))

    def joins(df):
        return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")

    assert joins(direct) < joins(joined)
    limited = snap.snapshot_from_extended(units, details, "Windeinheit", specs.BASIC_COLUMNS, limit=2)
    assert sorted(r["EinheitMastrNummer"] for r in limited.collect()) == ["SEE1", "SEE2"]
