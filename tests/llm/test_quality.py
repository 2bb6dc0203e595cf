"""Document statistics against plain Python, the trees' monotonic features, and verdicts."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from unitledger.llm import quality
from unitledger.llm.boosting import train

WORD = re.compile(r"[^ \t-\r]+")


def brute(text):
    words = WORD.findall(text or "")
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(zip(words, words[1:], words[2:]))
    hit = {i + k for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for k in range(3)}
    return [len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(hit)]


def texts():
    r = random.Random(5)
    out = [None, "", " \n\t", "a", "a a a a", "x\nx\n x\nx", "é😀 # é😀 # é😀", "w " * 60, "A a A a A a"]
    for _ in range(150):
        out.append("".join(r.choice(["ab ", "Ab ", "cd", "\n", " ", "é ", "#*", "ab cd ef ", "\x0b", "1 "]) for _ in range(r.randint(1, 90))))
    return out + ["q" * 600_000 + " z", " ".join(f"n{i}" for i in range(90_000))]


def test_statistics_equal_python():
    rows = texts()
    base, features = quality.statistics([(t or "").encode() for t in rows])
    assert base.tolist() == [brute(t) for t in rows]
    assert np.isfinite(features).all()


@pytest.mark.parametrize("seed", [1, 2])
def test_score_follows_the_constraint(seed):
    r = np.random.default_rng(seed)
    x = r.normal(size=(3000, 3))
    y = (x[:, 0] + np.sin(3 * x[:, 1]) + 0.3 * r.normal(size=3000) < 0).astype(float)
    model = train(x, y, np.array([-1, 0, 1]), trees=30)
    for f, way in ((0, -1), (2, 1)):
        at = np.repeat(x[:50], 40, axis=0)
        at[:, f] = np.tile(np.linspace(-4, 4, 40), 50)
        steps = np.diff(model.score(at).reshape(50, 40), axis=1)
        assert (way * steps >= -1e-12).all()
    assert ((model.score(x) > 0.5) == y).mean() > 0.8


def documents(spark):
    r = random.Random(9)
    words = [f"word{i}" for i in range(500)]
    rows, labels = [], []
    for i in range(400):
        good = i % 4 > 0
        own = r.choices(words, k=r.randint(60, 150))
        rows.append((i, " ".join(own if good else [w + r.choice(["###", "$$$", "&&&"]) for w in own]), 7, "x"))
        labels.append((i, int(good) if i % 11 else None, 0))
    rows += [(400, None, 7, "x"), (401, "few words", 7, "x"), (0, rows[0][1], 7, "x"), (None, rows[1][1], 7, "x")]
    labels += [(None, 1, 0), (3, 1, 0)]
    return spark.createDataFrame(rows, "doc_id long, text string, kept int, score string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_verdicts(spark):
    docs, labels = documents(spark)
    rows = quality.quality_report(docs, labels).collect()
    assert len(rows) == 404
    for r in rows:
        want = r.doc_id is None or r.doc_id < 400 and r.doc_id % 4 > 0
        assert r.kept == want, r
        assert r.base_failed == (r.n_words < 50)
    kept = quality.good_documents(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r.kept for r in rows)


def test_without_labels_the_base_rules_decide(spark):
    docs, labels = documents(spark)
    for none in (labels.limit(0), labels.filter("quality = 1")):
        assert all(r.kept != r.base_failed for r in quality.quality_report(docs, none).collect())
    assert quality.quality_report(docs.limit(0), labels).collect() == []


def test_repeated_labelled_ids_train_once(spark, monkeypatch):
    import unitledger.llm.quality as Q

    seen = []
    monkeypatch.setattr(Q, "train", lambda x, y, *rest, train=Q.train: seen.append(len(y)) or train(x, y, *rest))
    rows = [(i, f"word{i} and some more words of text {i}") for i in range(40)]
    docs = spark.createDataFrame(rows + [rows[0]] * 300 + [(0, "another text")], "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    Q.fit(docs, labels)
    assert seen == [30]
