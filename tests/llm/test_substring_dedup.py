"""Repeated windows against a plain version: shared passages, copies, hot windows, edge cases."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from unitledger.llm import substring_dedup as sub
from unitledger.llm.words import SPACES, hashed_words


def plain_version(rows, window):
    words = [re.findall("[^\x20\x09-\x0d]+", t or "") for _, t in rows]
    starts = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for (doc_id, _), w in zip(rows, words):
        gone = set()
        for i in range(len(w) - window + 1):
            if starts[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        kept = [x for k, x in enumerate(w) if k not in gone]
        out.append((doc_id, len(w), len(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return sorted(out, key=repr)


def text(r, n, vocabulary=300):
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(n))


def rows_of_all_kinds():
    r = random.Random(12)
    passage, longer = text(r, 40), text(r, 120)
    out = [text(r, r.randint(1, 400)) for _ in range(40)]
    out += [f"{text(r, r.randint(0, 50))} {passage}\n{text(r, r.randint(0, 50))}" for _ in range(12)]
    out += [f"{text(r, 30)}\t{longer} {text(r, 3)} {longer}" for _ in range(3)]
    base = text(r, 200).split()
    for k in range(8):  # near copies
        own = list(base)
        own[20 * k] = f"other{k}"
        out.append(" ".join(own))
    out += [text(r, 90)] * 2 + [text(r, 34)] * 3 + [text(r, 35)] * 2
    out += ["one " * 300, "a b " * 200, "x y z " * 90 + "end", None, "", " \n\t ", "é中😀 " * 50, "single"]
    return [(i, t) for i, t in enumerate(out)] + [(None, passage), (3, "twice " + passage), (3, "twice " + passage)]


def test_documents_equal_the_plain_version(spark):
    rows = rows_of_all_kinds()
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, key string, h int").repartition(4)
    got = sorted((tuple(r) for r in sub.repeat_report(df).collect()), key=repr)
    assert got == plain_version(rows, 35)
    assert sum(r[2] for r in got) > 0
    assert sub.repeat_report(df.limit(0)).collect() == []


def test_dealt_buckets_and_small_batches(spark, monkeypatch):
    from unitledger.operators import skew

    monkeypatch.setattr(skew, "HOT_ROWS", 2)
    monkeypatch.setattr(skew, "HOT_SHARE", 0.001)
    monkeypatch.setattr(sub, "SORTED_BYTES", 300)
    monkeypatch.setattr(sub, "TOGETHER", 3)
    rows = rows_of_all_kinds()
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert sorted((tuple(r) for r in sub.repeat_report(df).collect()), key=repr) == plain_version(rows, 35)
    assert sorted((tuple(r) for r in sub.repeat_report(df, window=7).collect()), key=repr) == plain_version(rows, 7)
    assert sorted((tuple(r) for r in sub.repeat_report(df, window=1).collect()), key=repr) == plain_version(rows, 1)


def test_an_overfull_filter_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(sub, "FILTER_BITS", 6)
    rows = rows_of_all_kinds()
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert sorted((tuple(r) for r in sub.repeat_report(df).collect()), key=repr) == plain_version(rows, 35)


def test_colliding_hashes_are_told_apart(monkeypatch):
    ids = np.array([0, 1, 2, 3, 0, 1, 2, 4])
    places = np.arange(6)
    want = [ids[p : p + 3].tolist() for p in places]
    monkeypatch.setattr(sub, "window_hashes", lambda words, k: np.zeros(len(words) - k + 1, dtype=np.uint64))
    got = sub._groups(ids, places, 3)
    assert [[a == b for b in got] for a in got] == [[a == b for b in want] for a in want]


@pytest.mark.parametrize("window", [1, 4, 35])
def test_super_kmers_hold_every_window_once(window):
    r = random.Random(window)
    texts = [text(r, n, 6).encode() for n in (0, 1, 34, 35, 36, 200, 1000)] + [b"a " * 500]
    words, at = hashed_words(texts, SPACES, fold=False)
    owner, start, count, value, several = sub.super_kmers(words, at, window)
    seen = Counter((t, s + k) for t, s, n in zip(owner.tolist(), start.tolist(), count.tolist()) for k in range(n))
    want = Counter((t, i) for t, x in enumerate(texts) for i in range(len(x.split()) - window + 1))
    assert seen == want
    by_window = {}  # equal windows have equal minimisers; those of one super-k-mer differ unless it says so
    for t, s, n, v, more in zip(owner.tolist(), start.tolist(), count.tolist(), value.tolist(), several.tolist()):
        w = texts[t].split()
        own = [tuple(w[s + k : s + k + window]) for k in range(n)]
        assert more or len(set(own)) == len(own)
        assert all(by_window.setdefault(x, v) == v for x in own)


def test_kept_texts(spark):
    rows = rows_of_all_kinds()
    df = spark.createDataFrame([(t, i, "old") for i, t in rows], "text string, doc_id long, kept string").repartition(3)
    out = sub.without_repeats(df)
    assert out.columns == ["text", "doc_id", "kept"]
    got = sorted(((r.doc_id, hashlib.sha256(r.kept.encode()).hexdigest()) for r in out.collect()), key=repr)
    assert got == sorted(((i, h) for i, _, _, h in plain_version(rows, 35)), key=repr)
