"""Language identification on held-out documents, and the filter itself."""

import random
from collections import Counter

import numpy as np
import pytest

from unitledger.llm import langid
from unitledger.llm.words import mix

SF_DIR = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SF_DIR.replace("0.001", "0.01") + "/documents.parquet")
    got = langid.language_report(docs).join(docs.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert len(got) > 200
    assert sum(r.lang == r.lang_pred for r in got) / len(got) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_held_out_rows_teach_nothing(spark):
    rows = [(i, "alpha beta gamma delta " * 3, "aa") for i in range(30)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    own = langid.held_out("doc_id")
    mixed = df.withColumn("lang", langid.F.when(own, "zz").otherwise(langid.F.col("lang")))
    assert {r.lang_pred for r in langid.language_report(mixed).collect()} == {"aa"}


def test_texts_without_letters_and_empty_tables(spark):
    rows = [(1, "hello world", "en", 1), (2, None, "en", 1), (3, "123 !!", None, 1), (4, "", "en", 1), (None, "hello", None, 1), (1, "hello world", "en", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    made = langid.learn(df)
    got = sorted(((r.doc_id, r.lang_pred) for r in langid.identify(df, made).collect()), key=repr)
    assert got == sorted([(1, "en"), (1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "en")], key=repr)
    assert langid.learn(df.filter("lang is null")) is None
    assert {r.lang_pred for r in langid.language_report(df.filter("lang is null")).collect()} == {"und"}
    assert langid.language_report(df.limit(0)).collect() == []


def test_more_than_64_languages_and_false_hits():
    names = tuple(f"l{i:03d}" for i in range(70))
    made = langid.Filter(names, np.zeros((1 << 14, 2), dtype=np.uint64))
    grams = {b: mix(np.arange(b * 100, b * 100 + 50, dtype=np.uint64)) for b in (0, 5, 69)}
    for b, h in grams.items():
        made.add(h, b)
    for b, h in grams.items():
        assert (made.bit(made.masks(h), b) == 1).all()
    other = mix(np.arange(10**6, 10**6 + 20_000, dtype=np.uint64))
    seen = np.mean([made.bit(made.masks(other), b).mean() for b in grams])
    assert abs(seen - made.false_hits[[0, 5, 69]].mean()) < 0.002


def plain_grams(text):
    """All n-grams of a text, counted plainly."""
    kept = [c if c.isalpha() else " " for c in (text or "").lower()]
    words = "".join(kept).split()
    line = " " + " ".join(words) + " " if words else " "
    return Counter(line[i : i + n] for n in langid.LENGTHS for i in range(len(line) - n + 1) if line[i : i + n] != " ")


def hashed(gram):
    h = np.array([len(gram)], dtype=np.uint64)
    for j, c in enumerate(gram):
        h += np.uint64(ord(c)) * langid._PLACES[j]
    return int(mix(h)[0])


TEXTS = ["Straße  und\n\nWeg", "x", "", "12 34", "ab " * 50, "é中文字 Ωσς ΑΣ" * 9, " a1b2  c3 " * 20, "q" * 333, "İ  ́x" * 30]


@pytest.mark.parametrize("group", [7, 40, 1 << 18])
def test_n_grams_are_counted_whole_at_any_part_size(monkeypatch, group):
    monkeypatch.setattr(langid, "GROUP", group)
    got = Counter()
    for _, of, h in langid.grams(TEXTS):
        got.update(zip(of.tolist(), h.tolist()))
    want = Counter()
    for k, t in enumerate(TEXTS):
        want.update({(k, hashed(g)): n for g, n in plain_grams(t).items()})
    assert got == want


def test_masks_and_predictions_equal_a_plain_version(spark, monkeypatch):
    monkeypatch.setattr(langid, "KEPT", 2)
    r = random.Random(8)
    syllables = {"aa": "ka lo mi tu ra no", "bb": "ka lo shi ven dor no", "cc": "mi tu éx ölk dor zz"}
    rows = [(k, " ".join("".join(r.choices(syllables[lang].split(), k=2)) for _ in range(60)), lang) for k in range(60) for lang in syllables]
    rows += [(900, "ka" * 400, "cc"), (901, None, "aa"), (902, "words", None), (1, rows[0][1], "bb")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    made = langid.learn(df)
    counts = {}
    for _, t, lang in rows:
        if t is not None and lang is not None:
            counts.setdefault(lang, Counter()).update(plain_grams(t))
    totals = {(lang, n): sum(c for g, c in own.items() if len(g) == n) for lang, own in counts.items() for n in langid.LENGTHS}
    held = {lang: {g for g, c in own.items() if c >= max(totals[lang, len(g)] / langid.MOST, totals[lang, len(g)] ** (2 / 3) / 2)} for lang, own in counts.items()}
    assert made.languages == tuple(sorted(counts, key=lambda x: (-sum(totals[x, n] for n in langid.LENGTHS), x)))
    every = sorted(set().union(*counts.values()))
    assert any(len([x for x in held if g in held[x]]) > 1 for g in every) and any(g not in held["aa"] for g in counts["aa"])
    masks = made.masks(np.array([hashed(g) for g in every], dtype=np.uint64))
    wrong = 0
    for b, lang in enumerate(made.languages):
        found = made.bit(masks, b)
        own = np.array([g in held[lang] for g in every])
        assert found[own].all()  # no n-gram of a language is missed
        wrong += int(found[~own].sum())
    assert wrong < 0.01 * len(every) * 3
    rates = made.false_hits
    got = {(x.doc_id, x.lang_pred, round(x.score, 9)) for x in langid.identify(df, made).collect()}
    want = set()
    for k, t, _ in rows:
        own = plain_grams(t)
        total = sum(own.values())
        if not total:
            want.add((k, "und", 0.0))
            continue
        bits = made.masks(np.array([hashed(g) for g in own], dtype=np.uint64))
        real = [max(0.0, (float((made.bit(bits, b) * np.array(list(own.values()))).sum()) - total * rates[b]) / (1 - rates[b])) for b in range(3)]
        best = max(range(3), key=lambda b: (real[b], -b))
        want.add((k, made.languages[best], round(min(1.0, real[best] / total), 9)))
    assert got == want


def test_equal_hits_go_to_the_more_common_language(spark):
    rows = [(i, "same words here", "bb") for i in range(3)] + [(i, "same words here", "aa") for i in range(2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    made = langid.learn(df)
    assert {r.lang_pred for r in langid.identify(df, made).collect()} == {"bb"}
