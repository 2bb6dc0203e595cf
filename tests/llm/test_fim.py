"""Fill-in-the-middle against a plain version, and the exact way back."""

import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from unitledger.llm import fim

RULES = fim.Rules()


def plain_version(doc_id, text):
    text = text or ""
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    own = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(own[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(tokens)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(tokens[:a]), "".join(tokens[a:b]), "".join(tokens[b:])
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@settings(max_examples=200, deadline=None)
@given(st.lists(st.binary(max_size=40), min_size=3, max_size=3), st.sampled_from(["psm", "spm"]))
def test_rotations_and_their_inverse(parts, form):
    p, m, s = (x.replace(b"<", b"(") + b"<" * (len(x) % 3) for x in parts)
    text = p + m + s
    out = bytes(fim.rearranged(text, form, len(p), len(p) + len(m), RULES))
    assert out == (b"<P>" + p + b"<S>" + s + b"<M>" + m if form == "psm" else b"<S>" + s + b"<P>" + p + b"<M>" + m)
    assert fim.restored(out, form, RULES) == text


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="ab Z1é中😀\n<", max_size=50), st.integers(0, 60), st.integers(0, 60))
def test_places_of_tokens_over_steps(text, a, b):
    tokens = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    first, second = sorted((a % (len(tokens) + 1), b % (len(tokens) + 1)))
    whole = fim.STEP
    try:
        fim.STEP = 7
        data = np.frombuffer(text.encode(), dtype=np.uint8)
        assert fim.count_tokens(data) == len(tokens)
        p, q = "".join(tokens[:first]), "".join(tokens[:second])
        assert fim.cut_places(data, first, second) == (len(p.encode()), len(q.encode()), len(p), len(q))
        changed = np.array(data)
        fim.exchange(changed, 0, len(p.encode()), len(data))
        assert changed.tobytes() == text.encode()[len(p.encode()) :] + p.encode()
    finally:
        fim.STEP = whole


def test_documents(spark):
    texts = [None, "", "one", "two words", "a <S> b", "é中😀 mixed\n\x00 text", "long " * 50_000, "x" * 2_000_001, " ", "two words"]
    rows = [(i, t, "theirs") for i, t in enumerate(texts)] + [(7, "y" * 9, None), (7, "y" * 9, None), (None, "no id", "n"), (-5, "minus", "n")]
    df = spark.createDataFrame(rows, "doc_id long, text string, form string")
    got = fim.fill_in_middle(df, restored_col="restored")
    assert got.columns == ["doc_id", "text", "n", "form", "prefix_chars", "middle_chars", "output", "restored"]
    out = [tuple(r) for r in got.collect()]
    want = [(i, t, *plain_version(i, t), t or "") for i, t, _ in rows]
    assert sorted(out, key=repr) == sorted(want, key=repr)
    assert {r[3] for r in out} == {"plain", "psm", "spm"}
    assert fim.restore_texts(got).columns == got.columns
    assert all(r.restored == (r.text or "") for r in fim.restore_texts(got).collect())
    assert fim.fill_in_middle(df.limit(0)).count() == 0


def test_form_without_output_is_null(spark):
    df = spark.createDataFrame([("plain", None), (None, "x"), ("plain", "x")], "form string, output string")
    assert [r.restored for r in fim.restore_texts(df).collect()] == [None, None, "x"]
