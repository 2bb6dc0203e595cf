"""The pipeline against brute-force stages on the smallest tables."""

import public_tokenizers
import sentencepiece

import corpus_pipeline
from unitledger.llm import pii, quality
from tests_llm_brute import near_groups, windows_hit

SF_DIR = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(SF_DIR + "/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF_DIR}/{t}.parquet") for t in ("labels", "benchmark"))
    rows = {r.doc_id: r for r in docs.collect()}
    good = {r.doc_id for r in quality.quality_report(docs, labels).collect() if r.kept}
    left = near_groups([(i, rows[i].text) for i in sorted(good)])
    left -= windows_hit([(i, rows[i].text) for i in left], [r.text for r in bench.collect()])
    masked = {r.doc_id: r.text for r in pii.mask_pii(docs).collect()}
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    out = corpus_pipeline.run(spark, SF_DIR)
    assert out.columns == [*docs.columns, "ids"]
    got = {r.doc_id: r for r in out.collect()}
    assert set(got) == left and 0 < len(left) < len(rows)
    for i, r in got.items():
        ids = library.encode(masked[i] or "", add_eos=True)
        assert r.ids == ids and r.text == library.decode(ids) and r.source == rows[i].source


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(SF_DIR + "/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs.limit(20), SF_DIR).columns == docs.columns, name
        assert stage(spark, docs.limit(0), SF_DIR).count() == 0, name


def test_encoding_replaces_ids_and_keeps_nulls(spark):
    name, stage = corpus_pipeline.STAGES[-1]
    docs = spark.createDataFrame([("old", 1, "a b"), ("old", 2, None), ("old", 2, None), ("old", None, "")], "ids string, doc_id long, text string")
    out = stage(spark, docs, SF_DIR)
    assert out.columns == ["doc_id", "text", "ids"]
    got = sorted(((r.doc_id, r.text, len(r.ids)) for r in out.collect()), key=repr)
    assert got == sorted([(1, "a b", 3), (2, None, 1), (2, None, 1), (None, "", 1)], key=repr)
    assert stage(spark, docs.limit(0), SF_DIR).count() == 0
