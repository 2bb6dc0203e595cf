"""The validation worklist as one job: pick, neighbours, outlines, label file."""

from unitledger.plans import worklist


def units(spark):
    rows = [
        (f"SEE{i}", 10.0 + i * 0.01, 50.0 if i != 3 else None, "In Betrieb" if i % 4 else "In Planung", "Windkraft an Land", 100.0) for i in range(20)
    ]
    return spark.createDataFrame(
        rows, "EinheitMastrNummer string, Laengengrad double, Breitengrad double, EinheitBetriebsstatus string, Lage string, Bruttoleistung double"
    )


def test_a_round_picks_relevant_units_and_their_neighbours(spark):
    df = units(spark)
    picked, near = worklist.validation_round(df, df, "wind", 0.015, count=5, seed=7)
    rows = picked.collect()
    assert len(rows) == 5 and all(r.EinheitBetriebsstatus == "In Betrieb" and r.Breitengrad for r in rows)
    assert {"panel", "octagon"} <= set(picked.columns)
    again, _ = worklist.validation_round(df.repartition(7), df, "wind", 0.015, count=5, seed=7)
    assert {r.EinheitMastrNummer for r in again.collect()} == {r.EinheitMastrNummer for r in rows}
    wanted = {int(r.EinheitMastrNummer[3:]) for r in rows}
    expected = sum(0 <= n < 20 and n != 3 for i in wanted for n in (i - 1, i + 1))
    assert near.count() == expected


def test_label_file(spark, tmp_path):
    df = worklist.add_relevance(units(spark), "wind").withColumn("manval_location", worklist.F.lit(1))
    worklist.write_labels(df, "wind", str(tmp_path / "labels"))
    back = spark.read.csv(str(tmp_path / "labels"), header=True)
    assert back.columns == ["EinheitMastrNummer", "manval_location"] and back.count() == 14
