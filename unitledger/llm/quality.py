"""Quality rules: fixed limits on document statistics, then boosted trees over them.

One pass over the texts makes the statistics and scores them. The trees are trained on a sample
of labelled documents whose size is a parameter; all other work covers every document.
"""

from __future__ import annotations

from dataclasses import replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.boosting import Trees, train
from unitledger.llm.common import batch_of, in_batches, prepare, text_bytes
from unitledger.llm.words import SPACES, hashed_words, mix, window_hashes

#: Labelled documents the trees are fitted on at most (25 numbers each come to the driver).
SAMPLE = 20_000
#: Share of good held-out documents the cut may cost.
GOOD_LOST = 0.002
LEAST_WORDS, REPEAT_PERCENT = 50, 50

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
# Features of the trees and the direction their score must follow: -1 means more is never better.
FEATURES = {
    "log_words": 0,
    "chars_per_word": 0,
    "symbols_per_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "upper_share": 0,
    "digit_share": -1,
    "mark_share": -1,
    "shout_share": -1,
    "bar_share": -1,
    "beyond_ascii": 0,
    "words_per_line": 0,
    "distinct_share": 0,
    "stops_per_word": 0,
}


def _class(characters: bytes) -> np.ndarray:
    table = np.zeros(256)
    table[list(characters)] = 1
    return table


_STARTS = np.ones(256)  # bytes that start a character
_STARTS[0x80:0xC0] = 0
_CLASSES = np.stack(
    [
        _STARTS,
        SPACES.astype(float),
        _class(b"#*$%&|<>"),
        _class(bytes(range(65, 91))),
        _class(bytes(range(97, 123))),
        _class(b"0123456789"),
        _class(bytes(b for b in range(33, 127) if not chr(b).isalnum())),
        _class(b"!"),
        _class(b"|"),
        _class(bytes(range(0xC0, 256))),
        _class(b"\n"),
        _class(b".,;:?"),
    ],
    axis=1,
)


def _distinct(keys: np.ndarray, of: np.ndarray, texts: int) -> tuple[np.ndarray, np.ndarray]:
    """How often each key stands in its own text, and the number of distinct keys per text."""
    own = mix(keys + mix(of.astype(np.uint64) + np.uint64(1)))
    _, first, back, seen = np.unique(own, return_index=True, return_inverse=True, return_counts=True)
    return seen[back], np.bincount(of[first], minlength=texts)


def statistics(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Base statistics (as in `BASE`) and features (as in `FEATURES`) of each text."""
    words, at = hashed_words(texts, SPACES, fold=False)
    n_words = np.diff(at)
    of = np.repeat(np.arange(len(texts)), n_words)
    _, distinct = _distinct(words, of, len(texts)) if len(words) else (None, np.zeros(len(texts)))
    windows = window_hashes(words, 3)
    inside = np.flatnonzero(of[: len(windows)] == of[2:]) if len(windows) else np.zeros(0, dtype=np.int64)
    covered = np.zeros(len(words) + 1, dtype=bool)
    if len(inside):
        seen, _ = _distinct(windows[inside], of[inside], len(texts))
        again = inside[seen > 1]
        for k in range(3):
            covered[again + k] = True
    total = np.append(0, np.cumsum(covered))
    repeats = total[at[1:]] - total[at[:-1]]
    counts = np.zeros((len(texts), _CLASSES.shape[1]))
    dup_lines = np.zeros(len(texts), dtype=np.int64)
    lines = np.zeros(len(texts))
    for i, text in enumerate(texts):
        counts[i] = np.bincount(np.frombuffer(text, dtype=np.uint8), minlength=256) @ _CLASSES
        real = [line for line in text.split(b"\n") if line.strip(b" \t\r\x0b\x0c")]
        dup_lines[i] = len(real) - len(set(real))
        lines[i] = len(real)
    chars, blanks, symbols, upper, lower, digits, marks, shouts, bars, beyond, _, stops = counts.T
    per_word, per_char = 1 / np.maximum(n_words, 1), 1 / np.maximum(chars - blanks, 1)
    base = np.stack([n_words, (chars - blanks).astype(np.int64), symbols.astype(np.int64), dup_lines, repeats], axis=1)
    features = np.stack(
        [
            np.log1p(n_words),
            (chars - blanks) * per_word,
            symbols * per_word,
            dup_lines / np.maximum(lines, 1),
            repeats * per_word,
            upper / np.maximum(upper + lower, 1),
            digits * per_char,
            marks * per_char,
            shouts * per_word,
            bars * per_word,
            beyond * per_char,
            n_words / np.maximum(lines, 1),
            distinct * per_word,
            stops * per_word,
        ],
        axis=1,
    )
    return base.astype(np.int64), features


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> Trees | None:
    """Trees for good (1) against bad (0) documents, or None without labels of both kinds.

    At most `sample` labelled ids are used, those with the smallest hash. A quarter of them stays
    out of the training and sets the cut, which is 0.5 or lower so that it costs no more than
    `GOOD_LOST` of the good ones. Null ids and null labels are skipped, repeated ids count once.
    """
    prepare(docs.sparkSession)
    chosen = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .dropna()
        .groupBy("id")
        .agg(F.max("label").alias("label"))
        .withColumn("h", F.xxhash64("id"))
        .orderBy("h", "id")
        .limit(sample)
    )
    names = [f"f{i}" for i in range(len(FEATURES))]

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, x = statistics(text_bytes(batch.column("text")))
        return batch_of(["h", "label", "digest", *names], [batch.column("h"), batch.column("label"), batch.column("digest"), *x.T])

    schema = T.StructType(
        [T.StructField("h", T.LongType()), T.StructField("label", T.IntegerType()), T.StructField("digest", T.LongType())]
        + [T.StructField(c, T.DoubleType()) for c in names]
    )
    # Of several rows with an id that of the smallest text hash counts.
    rows = (
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
        .join(F.broadcast(chosen), "id")  # at most `sample` rows
        .select("h", "label", F.xxhash64("text").alias("digest"), "text")
        .mapInArrow(in_batches(one), schema)
        .groupBy("h", "label")
        .agg(F.min(F.struct("digest", *names)).alias("x"))
        .select("h", "label", *[f"x.{c}" for c in names])
        .toArrow()
        .sort_by([("h", "ascending"), ("f0", "ascending")])
    )
    y = rows.column("label").to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    x = np.stack([rows.column(c).to_numpy() for c in names], axis=1)
    out = np.arange(len(y)) % 4 == 3
    if not 0 < y[~out].sum() < (~out).sum():
        out[:] = False
    model = train(x[~out], y[~out], np.array(list(FEATURES.values())))
    good = model.score(x[out | (~out.any())])[y[out | (~out.any())] == 1]
    cut = min(0.5, float(np.quantile(good, GOOD_LOST)) - 1e-9) if len(good) else 0.5
    return replace(model, cut=cut)


def _judge(model, text_at: int, columns: list[str] | None, id_at: int = 0):
    """Rows of statistics and verdict, or with `columns` the kept input rows."""

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        base, x = statistics(text_bytes(batch.column(text_at)))
        failed = (base[:, 0] < LEAST_WORDS) | (100 * base[:, 4] > REPEAT_PERCENT * base[:, 0])
        trees = model.value
        score = np.ones(len(x)) if trees is None else trees.score(x)
        kept = ~failed & (score >= (0.5 if trees is None else trees.cut))
        if columns is not None:
            return batch.filter(pa.array(kept))
        return batch_of(["id", *BASE, "base_failed", "kept", "score"], [batch.column(id_at), *base.T, failed, kept, score])

    return in_batches(one)


def quality_report(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """Statistics and verdict of every input row.

    Returns the id, the columns of `BASE`, `base_failed`, `kept` and `score`. Words are runs of
    other characters than blank and tab to carriage return. `base_failed`: fewer than 50 words, or
    more than half of them in repeated 3-word windows. `kept` is false for these and for a score
    below the cut; without labels of both kinds only the base rules decide. Null and empty texts
    have no words and fail. Repeated rows get equal verdicts; other columns are not looked at.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, sample))
    source = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    schema = T.StructType(
        [source.schema["id"]]
        + [T.StructField(c, T.LongType()) for c in BASE]
        + [T.StructField("base_failed", T.BooleanType()), T.StructField("kept", T.BooleanType()), T.StructField("score", T.DoubleType())]
    )
    return source.mapInArrow(_judge(model, 1, None), schema).withColumnRenamed("id", id_col)


def good_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> DataFrame:
    """The input rows that `quality_report` keeps, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col, sample))
    return docs.mapInArrow(_judge(model, docs.columns.index(text_col), docs.columns), docs.schema)
