"""Decontamination against a plain search for every window."""

import random
import re

from unitledger.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items):
    windows = {}
    for item, text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    sizes = {len(w) for w in windows}
    out = []
    for doc, text in docs:
        w = words(text)
        hit, found = set(), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if tuple(w[i : i + n]) in windows:
                    hit |= set(range(i, i + n))
                    found |= {str(x) for x in windows[tuple(w[i : i + n])] if x is not None}
        out.append((doc, len(w), len(hit), sorted(found), bool(hit)))
    return sorted(out, key=repr)


def test_equals_plain_search(spark):
    r = random.Random(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["é", "straße", "x1"]
    items = [(i, " ".join(r.choices(vocabulary, k=k))) for i, k in enumerate([1, 2, 3, 9, 10, 11, 25, 25, 40, 0])]
    items += [(20, items[6][1]), (21, None), (None, " ".join(r.choices(vocabulary, k=14)))]
    docs = []
    for i in range(200):
        parts = [" ".join(r.choices(vocabulary, k=r.randint(0, 30)))]
        for _ in range(r.choice([0, 1, 2])):
            w = words(r.choice(items)[1])
            a = r.randrange(len(w) + 1)
            parts.append((", ".join(w[a : a + r.randint(1, 30)])).title() if "ß" not in "".join(w) else " ".join(w[a:]))
            parts.append(r.choice(vocabulary))
        docs.append((i, "; ".join(parts)))
    docs += [(500, None), (501, ""), (502, "..."), (0, docs[0][1]), (0, docs[1][1]), (None, docs[2][1])]
    d = spark.createDataFrame([(i, t, 0, "k") for i, t in docs], "doc_id long, text string, n_hit int, key string").repartition(3)
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, shingle int")
    got = sorted(
        ((x.doc_id, x.n_words, x.n_hit, x["items"], x.contaminated) for x in D.contamination(d, b).collect()), key=repr
    )
    assert got == brute(docs, items)
    clean = [(i, t) for i, t in docs if not brute([(i, t)], items)[0][2]]
    out = D.clean_documents(d, b)
    assert out.columns == d.columns and 0 < len(clean) < len(docs)
    assert sorted(((x.doc_id, x.text) for x in out.collect()), key=repr) == sorted(clean, key=repr)


def test_clean_rows_stay_beside_contaminated_ones_of_the_same_id(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    rows = [(None, passage), (None, "clean"), (None, None), (7, passage), (7, "clean too"), (7, passage), (8, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = sorted(((r.doc_id, r.text) for r in D.clean_documents(docs, items).collect()), key=repr)
    assert got == sorted([(None, "clean"), (None, None), (7, "clean too"), (8, "")], key=repr)


def test_long_text_and_equally_rare_shingles(spark):
    passage = " ".join(f"w{i}" for i in range(10))  # all its shingles occur equally often
    text = "filler words " * 100_000 + passage + " more" * 5 + " " + passage
    docs = spark.createDataFrame([(1, text), (2, passage)], "doc_id long, text string")
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    got = {r.doc_id: (r.n_words, r.n_hit) for r in D.contamination(docs, items).collect()}
    assert got == {1: (200_025, 20), 2: (10, 10)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    row = D.contamination(docs, none).first()
    assert (row.n_words, row.n_hit, row.n_items, row.contaminated) == (3, 0, 0, False)
    assert D.contamination(docs.limit(0), none).collect() == []
