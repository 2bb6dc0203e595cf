"""Encoding and decoding against the sentencepiece library."""

import hashlib
import random

import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from unitledger.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    return pieces.Pieces(pieces.read_model(PATH))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("ab the▁ \n\té中国😀.,<>0"), st.characters(exclude_categories=["Cs"])), max_size=60))
def test_any_text(library, own, text):
    ids = library.encode(text, add_eos=True)
    assert own.encode(text) == ids
    assert own.decode(ids) == library.decode(ids)


def test_any_ids(library, own):
    r = random.Random(4)
    for _ in range(2000):
        ids = [r.choice([r.randrange(32000), r.randrange(3, 259), r.randrange(3)]) for _ in range(r.randint(0, 8))]
        assert own.decode(ids) == library.decode(ids), ids


def test_long_texts_without_blanks(library, own):
    for text in ("the" * 50_000, "e" * 30_001, "▁" * 999, " " * 777 + "x", "中" * 20_000, "\n" * 5000):
        assert own.encode(text) == library.encode(text, add_eos=True)


def test_texts_over_several_parts(library, own, monkeypatch):
    monkeypatch.setattr(pieces, "PART", 50)
    text = " ".join(f"word{i}  {'▁' * (i % 3)} x" for i in range(200))
    assert own.encode(text) == library.encode(text, add_eos=True)


def test_memories_are_bounded_by_bytes(library, monkeypatch):
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 5000)
    small = pieces.Pieces(pieces.read_model(PATH))
    text = " ".join(f"word{i} {'long' * (i % 40)}" for i in range(300))
    assert small.encode(text) == library.encode(text, add_eos=True)
    assert all(m.held <= 5000 and len(m) <= 33 for m in (small.inner, small.first, small.pair))
    assert max(map(len, [*small.inner, *small.first]), default=0) <= pieces.REMEMBERED_CHARS


def test_a_worker_keeps_little_between_tasks(monkeypatch):
    monkeypatch.setattr(pieces, "_own", {})
    model = type("Shared", (), {"value": pieces.read_model(PATH) | {"key": "model"}})
    batch = pa.RecordBatch.from_pydict({"text": [f"word{i} other{i}\nline{i}" for i in range(200)]})

    def ids(own, batch):
        return pa.RecordBatch.from_pydict({"ids": [own.encode(t) for t in batch.column(0).to_pylist()]})

    def held_after_a_task():
        out = [*pieces._in_batches(model, ids)(iter([batch]))]
        assert [len(x) for x in out] == [200]
        own = pieces._own["model"]
        return [(len(m) > 0, m.held > 0) for m in (own.inner, own.first, own.pair)]

    assert held_after_a_task() == [(True, True)] * 3
    monkeypatch.setattr(pieces, "KEPT_BYTES", 5000)
    assert held_after_a_task() == [(False, False)] * 3
    assert [*pieces._in_batches(model, ids)(iter([]))] == []


def test_round_trips_keep_their_words_between_tasks(monkeypatch):
    monkeypatch.setattr(pieces, "_own", {})
    monkeypatch.setattr(pieces, "REMEMBERED_BYTES", 5000)
    monkeypatch.setattr(pieces, "KEPT_BYTES", 4000)
    model = type("Shared", (), {"value": pieces.read_model(PATH) | {"key": "model"}})
    batch = pa.RecordBatch.from_pydict({"text": [f"word{i} other{i}\nline{i}" for i in range(200)]})
    computed = []

    def ids(own, batch):
        inner = own.inner.function
        own.inner.function = lambda word: computed.append(word) or inner(word)
        out = pa.RecordBatch.from_pydict({"ids": [own.encode(t) for t in batch.column(0).to_pylist()]})
        own.inner.function = inner
        return out

    def computed_in_a_task(most):
        computed.clear()
        out = [*pieces._in_batches(model, ids, most)(iter([batch]))]
        return out, len(computed)

    first, n = computed_in_a_task(1 << 20)
    assert n == 400
    assert computed_in_a_task(1 << 20) == (first, 0)
    # A task with the smaller bound leaves no more than that.
    again, n = computed_in_a_task(None)
    assert again == first and n == 400
    own = pieces._own["model"]
    assert sum(m.held for m in (own.inner, own.first, own.pair)) <= 4000


def test_documents(spark, library):
    rows = [(1, "Hello there\nworld", 7), (2, None, 7), (3, "", 7), (3, "", 7), (None, "  é😀 ", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    got = pieces.round_trip(df, PATH).collect()
    want = []
    for i, text, _ in rows:
        ids = library.encode(text or "", add_eos=True)
        want.append(
            (i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(library.decode(ids).encode()).hexdigest())
        )
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    encoded = pieces.encode_documents(df, PATH)
    assert encoded.columns == ["doc_id", "text", "ids"]
    decoded = {r.decoded for r in pieces.decode_documents(encoded, PATH).collect()}
    assert decoded == {"Hello there\nworld", "", "  é😀 "}
    assert pieces.round_trip(df.limit(0), PATH).collect() == []
    one_pass = pieces.recode_documents(df, PATH)
    assert one_pass.columns == ["doc_id", "text", "ids"]
    both = {(r.text, tuple(r.ids)) for r in one_pass.collect()}
    assert both == {(t, tuple(library.encode(t or "", add_eos=True))) for _, t, _ in rows}
