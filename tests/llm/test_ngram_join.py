"""The shingle join against all pairs, with hot groups, ties, nulls and clashing columns."""

import random
import re
import tracemalloc
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest

from unitledger.llm import ngram_join as J
from unitledger.operators import skew

WORD = re.compile(r"[^ \t-\r]+")


def shingles(text):
    text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(text)
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def brute(rows, percent=75):
    sets = [shingles(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * len(sets[i] | sets[j]):
                a, b = label[i], label[j]
                label = [b if x == a else x for x in label]
    out = []
    for i, (own, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        out.append((own, len(sets[i]), min(ids) if ids and sets[i] else own))
    return sorted(out, key=repr)


def rows_of(seed, n=160):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(400)]
    line = " ".join(r.choices(words, k=12))
    base = [r.choices(words, k=r.randint(1, 60)) for _ in range(n // 4)]
    out = []
    for i in range(n):
        own = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 5])):
            own[r.randrange(len(own))] = r.choice(words)
        text = " ".join(own)
        if r.random() < 0.3:
            text += "\n" + line
        out.append((i, text.upper() if r.random() < 0.2 else text))
    hot = r.choices(words, k=40)
    for i in range(n, n + 120):  # a third of the rows: near copies of one text
        own = list(hot)
        own[r.randrange(40)] = r.choice(words)
        out.append((i, " ".join(own)))
    return out + [(900, None), (901, ""), (902, " \n\t"), (903, "a b"), (904, "A  b"), (0, out[0][1]), (None, out[3][1]), (None, "only one here")]


@pytest.mark.parametrize("seed", [1, 2])
def test_components_equal_all_pairs(spark, monkeypatch, seed):
    monkeypatch.setattr(J, "BLOCK_SETS", 16)  # so that groups take several blocks
    rows = rows_of(seed)
    df = spark.createDataFrame([(i, t, "x", 1, 2, 3) for i, t in rows], "doc_id long, text string, id string, set long, size int, leader int").repartition(3)
    got = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in J.ngram_components(df).collect()), key=repr)
    assert got == brute(rows)


def test_pairs_of_near_copies_are_not_compared(spark, monkeypatch):
    """Near copies of one text meet its leader alone; one that links with another member only is found."""
    monkeypatch.setattr(J, "BLOCK_SETS", 50)
    compared = spark.sparkContext.accumulator(0)
    inner = J._cell_links

    def counting(percent):
        run = inner(percent)

        def counted(batches):
            def each():
                for batch in batches:
                    compared.add(batch.num_rows)
                    yield batch

            yield from run(each())

        return counted

    monkeypatch.setattr(J, "_cell_links", counting)
    r = random.Random(3)
    hot = [f"h{i}" for i in range(200)]
    rows = []
    for i in range(2000):
        own = list(hot)
        own[r.randrange(200)] = f"x{i}"
        rows.append((i, " ".join(own)))
    chain = list(hot)
    for step, at in enumerate((10, 30, 50, 70, 90, 110, 130, 150, 170)):
        chain[at] = f"c{step}"
        rows.append((2000 + step, " ".join(chain)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert {r.component_id for r in J.ngram_components(df).collect()} == {0}
    assert 0 < compared.value < 2 * len(rows)  # cells of all pairs of blocks would read some 40 times the rows


def test_one_per_component_keeps_columns_and_unlinked_rows(spark):
    text = " ".join(f"t{i}" for i in range(30))
    df = spark.createDataFrame([(5, text, 1), (3, text + " z", 2), (9, None, 3), (10, None, 4), (None, text, 5)], "doc_id long, text string, _gone int")
    kept = sorted(r._gone for r in J.one_per_component(df).collect())
    assert kept == [2, 3, 4, 5]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert J.ngram_components(df).collect() == []


def test_a_very_long_text(spark):
    long = " ".join(f"v{i}" for i in range(120_000))
    df = spark.createDataFrame([(1, long), (2, long + " end"), (3, "x" * 700_000)], "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in J.ngram_components(df).collect()}
    assert got == {1: (119_996, 1), 2: (119_997, 1), 3: (1, 3)}


def test_repeated_rows_of_the_smallest_id_leave_one(spark):
    text = "one text of seven words for copies"
    rows = [(1, text, "b", {"k": 1})] * 5 + [(1, text, "a", {"k": 2})] * 5 + [(2, text, "c", None), (1, None, "n", None), (1, " ", "n", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, more map<string,int>").repartition(4)
    kept = J.one_per_component(df)
    assert kept.columns == df.columns
    got = sorted((r.doc_id, r.source) for r in kept.collect())
    assert got in ([(1, "a"), (1, "n"), (1, "n")], [(1, "b"), (1, "n"), (1, "n")])
    assert sorted((r.doc_id, r.source) for r in J.one_per_component(df.repartition(2)).collect()) == got


def test_texts_that_share_an_id_are_judged_apart(spark):
    copied, own, third = "copied text of seven words in all", "quite another text that nobody has copied", "a third text which two rows share here"
    rows = [(1, copied, "x"), (5, copied, "gone"), (5, own, "kept"), (7, third, "y"), (7, third.upper(), "y"), (8, third, "gone")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = sorted((r.doc_id, r.source) for r in J.one_per_component(df).collect())
    assert got == [(1, "x"), (5, "kept"), (7, "y")]


@pytest.mark.parametrize("sets, words", [(1, 3), (5, 1), (40, 30), (9000, 40)])
def test_frequent_shingles_are_counted_in_place(sets, words):
    r = np.random.default_rng(sets)
    block = {i: np.unique(r.integers(0, 2500, r.integers(1, words + 1)).astype(np.uint64)) for i in range(sets)}
    values, seen = np.unique(np.concatenate(list(block.values())), return_counts=True)
    keep = seen >= max(J.FREQUENT_SETS, J.FREQUENT_SHARE * sets)
    found, counts = J._frequent(block)
    assert found.tolist() == values[keep].tolist() and counts.tolist() == seen[keep].tolist()
    assert counts.dtype == np.int64 and not block


def test_frequent_shingles_take_little_more_than_their_block():
    r = np.random.default_rng(1)
    block = {i: np.unique(r.integers(0, 1 << 63, 1000, dtype=np.uint64)) for i in range(500)}
    size = sum(s.nbytes for s in block.values())
    tracemalloc.start()
    J._frequent(block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 1.6 * size


def test_narrow_results_take_few_files(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    most = max(8, 4 * spark.sparkContext.defaultParallelism)
    try:
        rows = spark.range(20_000).selectExpr("id % 10000 AS k").groupBy("k").count()
        table = skew.written(rows, narrow=True)
        assert len(table.inputFiles()) <= most < 65
        assert table.count() == 10_000 and table.agg({"count": "sum"}).first()[0] == 20_000
        assert len(skew.written(rows).inputFiles()) > most
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_common_shingles_stay_out_of_prefixes_where_the_filter_is_overfull(monkeypatch):
    """Every shingle is repeated and the filter too small for them; those of many sets still come last."""
    monkeypatch.setattr(J, "FILTER_BITS", 1 << 14)
    r = random.Random(5)
    passage = " ".join(f"p{i}" for i in range(40))
    texts = []
    for i in range(150):
        words = [f"u{i}x{j}" for j in range(200)]
        own = " ".join([*words, passage] if i % 3 == 0 else words)
        texts += [own, own + " end"]
    r.shuffle(texts)
    frequent = SimpleNamespace(value=(np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64)))
    everyone = SimpleNamespace(value=np.full(64, 2**64 - 1, dtype=np.uint64))
    batches = [
        pa.RecordBatch.from_arrays([pa.array(range(25), pa.int64()), pa.array(texts[a : a + 25])], names=["h", "text"])
        for a in range(0, len(texts), 25)
    ]
    repeated = J.Repeated(4, 60_000)
    keys = pa.Table.from_batches(J._keys(5, frequent, repeated, everyone)(iter(batches)))
    for part in range(16):
        of_part = keys.filter(pa.array([x == part for x in keys.column("part").to_pylist()]))
        for row in J._slices(repeated)(of_part).to_pylist():
            repeated.put(row["part"], row["level"], row["marks"], np.frombuffer(row["words"], dtype=np.uint64))
    common = next(J.shingle_sets([passage.encode()], J.SPACES, 5))
    assert (repeated.order(common) == 2).all()
    bucketed = J._prefixes(5, 75, 16, frequent, SimpleNamespace(value=repeated), everyone)(iter(batches))
    rows = [row for batch in bucketed for row in batch.to_pylist() if row["bucket"] >= 0]
    tokens = np.concatenate([np.frombuffer(row["a"], dtype=np.uint64) for row in rows])
    assert len(tokens) > 1000 and not np.isin(common, tokens).any()


def test_copies_of_a_set_add_nothing_to_lists(spark, monkeypatch):
    """Texts without near copies give no prefixes, however often each comes."""
    packed = spark.sparkContext.accumulator(0)
    inner = J._gather

    def counting(buckets):
        run = inner(buckets)

        def counted(table):
            packed.add(table.num_rows)
            return run(table)

        return counted

    monkeypatch.setattr(J, "_gather", counting)
    texts = [" ".join(f"t{i}w{j}" for j in range(50)) for i in range(40)]
    df = spark.createDataFrame([(100 * c + i, t) for c in range(6) for i, t in enumerate(texts)], "doc_id long, text string").repartition(6)
    got = {(r.doc_id, r.component_id) for r in J.ngram_components(df).collect()}
    assert got == {(100 * c + i, i) for c in range(6) for i in range(40)}
    assert packed.value == 0


@pytest.mark.parametrize("copied, copies", [(20, 1), (100, 5)])
def test_few_rows_are_moved_to_drop_the_others(spark, copied, copies):
    """With more ids than a broadcast holds, a filter finds the rows that a join has to look at."""
    texts = [" ".join(f"k{i}w{j}" for j in range(30)) for i in range(100)]
    rows = [(i, t, "first", {"k": i}) for i, t in enumerate(texts)]
    rows += [(1000 * c + i, t, "copy", None) for c in range(1, copies + 1) for i, t in enumerate(texts[:copied])]
    rows += [(None, texts[0], "no id", None), (5000, None, "no text", None), (5001, "", "no text", None)]
    mixed = "another text of seven words for ids"
    rows += [(6000, mixed, "first", None), (6001, mixed, "copy", None), (6001, "a text of its own beside the copy", "first", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _words string, more map<string,int>").repartition(4)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        kept = J.one_per_component(df)
        assert "BroadcastNestedLoopJoin" in kept._jdf.queryExecution().executedPlan().toString()
        got = sorted(((r.doc_id, r._words) for r in kept.collect()), key=repr)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert got == sorted(((i, kind) for i, _, kind, _ in rows if kind != "copy"), key=repr)
