"""Archives: exact round trip, pushdown, skipped payloads, and archives of other writers."""

import gzip
import hashlib
import io

import pyarrow as pa

from unitledger.llm import warc


def test_round_trip_with_copies(spark):
    copy = "<p>" + "é" * 80
    rows = [(i, f"http://h/{i}", copy if i % 3 == 0 else f"page {i}" * (i % 40)) for i in range(1, 200)]
    rows += [(300, None, None), (301, "http://h/\r\nX: y", ""), (None, "u", copy), (3, "again", copy), (302, "u", "short"), (303, "u", "short")]
    df = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string").repartition(4)
    got = sorted(map(tuple, warc.archive_round_trip(df).collect()), key=repr)
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        same = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        first = min(same) if len(raw) >= warc.REVISIT_FROM and same else i
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "response" if i == first else "revisit", None if i == first else first))
    assert got == sorted(want, key=repr)
    assert warc.archive_round_trip(df.limit(0)).collect() == []


def test_files_are_bounded_and_filters_pushed_down(spark, tmp_path):
    df = spark.range(60).selectExpr("id as page_id", "concat('http://h/', id) as url", "repeat(cast(id as string), 3000) as html")
    records = warc.page_records(df)
    warc.register(spark)
    path = str(tmp_path / "a")
    records.coalesce(1).write.format("warc").option("fileBytes", "1000").mode("append").save(path)
    read = warc.read_archives(spark, path)
    assert read.rdd.getNumPartitions() > 3
    one = read.filter("record_id = '7' and type = 'response'")
    assert [bytes(r.payload).decode() for r in one.collect()] == ["7" * 3000]
    assert " Filter " not in one._jdf.queryExecution().executedPlan().toString()  # the source took it all
    lean = warc.read_archives(spark, path, payloads=False).filter("type in ('response')")
    assert {r.payload for r in lean.collect()} == {None} and lean.count() == 60


def test_unwanted_records_are_not_unpacked(monkeypatch):
    data = b"".join(
        warc.member(warc.record({"type": "response", "record_id": str(i), "uri": None, "refers_to": None, "digest": "d", "payload_length": 90_000, "payload": bytes(range(256)) * 400}))
        for i in range(5)
    )
    read = []

    class File(io.BytesIO):
        def size(self):
            return len(data)

        def read(self, n=-1):
            out = super().read(n)
            read.append(len(out))
            return out

    found = list(warc.read_records(File(data), lambda h: h["WARC-Record-ID"] == "3", True))
    assert len(found) == 1 and len(found[0][1]) == 102_400
    skipped = list(warc.read_records(File(data), lambda h: True, False))
    assert len(skipped) == 5 and all(p is None for _, p in skipped)


def test_archives_of_other_writers(tmp_path):
    records = [
        warc.record({"type": t, "record_id": str(i), "uri": "u", "refers_to": None, "digest": None, "payload_length": None, "payload": bytes([65 + i]) * 5000})
        for i, t in enumerate(["response", "request", "response"])
    ]
    for name, data in (("a.warc", b"".join(records)), ("b.warc.gz", b"".join(map(gzip.compress, records)))):
        (tmp_path / name).write_bytes(data)
        with pa.fs.LocalFileSystem().open_input_file(str(tmp_path / name)) as file:
            got = [(h["WARC-Record-ID"], p) for h, p in warc.read_records(file, lambda h: h["WARC-Type"] == "response", True)]
        assert got == [("0", b"A" * 5000), ("2", b"C" * 5000)]
