"""Fill-in-the-middle transformation by block rotation in place, and its exact inverse.

Two hashed cuts divide a text into prefix, middle and suffix. One buffer takes the three blocks
in text order, a sentinel before each; exchanging neighbouring blocks by three reversals brings
them into the order of the form. Rotating back restores the text from output and form alone.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import batch_of, fresh, in_batches, bounded_batches, text_bytes

#: Bytes that are scanned or reversed at a time.
STEP = 1 << 20

_LETTER = np.zeros(256, dtype=bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
_LATER = np.zeros(256, dtype=bool)  # bytes of a code point after its first one
_LATER[128:192] = True


@dataclass(frozen=True)
class Rules:
    """Sentinels, the share of plain texts and of suffix-first ones (in percent), and the salt of
    the hash. No sentinel may be part of another or begin with another's end; `<X>` forms are fine."""

    prefix: bytes = b"<P>"
    suffix: bytes = b"<S>"
    middle: bytes = b"<M>"
    plain_from: int = 90
    suffix_first: int = 20
    salt: str = "1:"

    def draws(self, doc_id: str | None) -> list[int]:
        """Four unsigned 32-bit numbers of an id; a null id hashes the bare salt."""
        own = hashlib.sha256(f"{self.salt}{doc_id or ''}".encode()).hexdigest()
        return [int(own[i : i + 8], 16) for i in (0, 8, 16, 24)]


def _token_starts(data: np.ndarray, begin: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the bytes from `begin`, one step long: which start a token, which start a code point.
    A token is a run of ASCII letters or any other single code point."""
    part = data[begin : begin + STEP]
    letter = _LETTER[part]
    before = np.empty_like(letter)
    before[1:] = letter[:-1]
    before[0] = bool(begin) and _LETTER[data[begin - 1]]
    point = ~_LATER[part]
    return point & ~(letter & before), point


def count_tokens(data: np.ndarray) -> int:
    return sum(int(np.count_nonzero(_token_starts(data, b)[0])) for b in range(0, len(data), STEP))


def cut_places(data: np.ndarray, first: int, second: int) -> tuple[int, int, int, int]:
    """Bytes before token number `first` and `second` (0-based, first <= second; the number of
    tokens means the end), and the code points before each."""
    places: list[tuple[int, int]] = []
    tokens = points = 0
    for begin in range(0, len(data), STEP):
        starts, point = _token_starts(data, begin)
        n = int(np.count_nonzero(starts))
        while len(places) < 2 and (want := (first, second)[len(places)]) < tokens + n:
            at = int(np.flatnonzero(starts)[want - tokens])
            places.append((begin + at, points + int(np.count_nonzero(point[:at]))))
        if len(places) == 2:
            break
        tokens += n
        points += int(np.count_nonzero(point))
    places += [(len(data), points)] * (2 - len(places))
    return places[0][0], places[1][0], places[0][1], places[1][1]


def reverse(data: np.ndarray, a: int, b: int) -> None:
    """Reverse bytes `a` to `b` in place, a step from either end at a time."""
    while b - a > 1:
        n = min(STEP, (b - a) // 2)
        front = data[a : a + n][::-1].copy()
        data[a : a + n] = data[b - n : b][::-1]
        data[b - n : b] = front
        a, b = a + n, b - n


def exchange(data: np.ndarray, a: int, middle: int, b: int) -> None:
    """Exchange the neighbouring blocks `a` to `middle` and `middle` to `b` by three reversals."""
    reverse(data, a, middle)
    reverse(data, middle, b)
    reverse(data, a, b)


def rearranged(text: bytes, form: str, first: int, second: int, rules: Rules) -> bytearray:
    """The text cut at two byte places in the order of a form (`psm` or `spm`)."""
    out = bytearray(rules.prefix)
    out += memoryview(text)[:first]
    a = len(out)
    out += rules.middle
    out += memoryview(text)[first:second]
    b = len(out)
    out += rules.suffix
    out += memoryview(text)[second:]
    view = np.frombuffer(out, dtype=np.uint8)
    if form == "psm":
        exchange(view, a, b, len(out))  # prefix | middle | suffix -> prefix | suffix | middle
    else:
        exchange(view, 0, b, len(out))  # prefix, middle | suffix -> suffix | prefix, middle
    del view
    return out


def restored(output: bytes, form: str, rules: Rules) -> bytes:
    """The text that was rearranged; a plain one is its own output."""
    if form == "plain":
        return output
    buffer = bytearray(output)
    view = np.frombuffer(buffer, dtype=np.uint8)
    if form == "psm":
        b = output.index(rules.suffix)
        cut = output.index(rules.middle)
        exchange(view, b, cut, len(output))
        middle = b
        suffix = b + len(output) - cut
    else:
        cut = output.index(rules.prefix)
        exchange(view, 0, cut, len(output))
        middle = output.index(rules.middle) - cut
        suffix = len(output) - cut
    del view
    out = buffer[len(rules.prefix) : middle]
    out += memoryview(buffer)[middle + len(rules.middle) : suffix]
    out += memoryview(buffer)[suffix + len(rules.suffix) :]
    return bytes(out)


def fill_in_middle(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Rules = Rules(), restored_col: str | None = None
) -> DataFrame:
    """Adds `n`, `form`, `prefix_chars`, `middle_chars` and `output` to every row.

    `n` counts tokens. A text that is null (taken as empty), empty or holds a sentinel is plain:
    its output is itself and its two counts are null; so is the share of texts that the hash of
    the id leaves plain. A null id has one hash of its own; repeated rows get equal results.
    Columns of these names are replaced, other rows and columns stay. With `restored_col` the
    text is also rebuilt from output and form in the same pass.
    """
    bounded_batches(docs.sparkSession)
    added = [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
        *([T.StructField(restored_col, T.StringType())] if restored_col else []),
    ]
    new = [f.name.lower() for f in added]
    kept = [c for c in docs.columns if c.lower() not in new]
    # The id goes along as decimal text; so does the text, if its column is replaced.
    key, text = fresh(docs, "_fim_id"), fresh(docs, "_fim_text")
    extra = [F.col(id_col).cast("string").alias(key), *([] if text_col in kept else [F.col(text_col).alias(text)])]
    source = docs.select(*[F.col(f"`{c}`") for c in kept], *extra)
    at = kept.index(text_col) if text_col in kept else len(kept) + 1

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[] for _ in added]
        ids = batch.column(len(kept)).to_pylist()
        for doc_id, own in zip(ids, text_bytes(batch.column(at))):
            data = np.frombuffer(own, dtype=np.uint8)
            n = count_tokens(data)
            h = rules.draws(doc_id)
            plain = not own or any(s in own for s in (rules.prefix, rules.suffix, rules.middle)) or h[2] % 100 >= rules.plain_from
            row = [n, "plain", None, None, own]
            if not plain:
                form = "spm" if h[3] % 100 < rules.suffix_first else "psm"
                first, second, chars, chars_later = cut_places(data, *sorted((h[0] % (n + 1), h[1] % (n + 1))))
                row = [n, form, chars, chars_later - chars, bytes(rearranged(own, form, first, second, rules))]
            if restored_col:
                row.append(restored(row[4], row[1], rules))
            for values, value in zip(columns, row):
                values.append(value)
        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        arrays = [pa.array(v, kind) for v, kind in zip(columns, kinds)]
        arrays = [a.cast(pa.string()) if pa.types.is_binary(a.type) else a for a in arrays]
        return batch_of([*kept, *[f.name for f in added]], [*[batch.column(i) for i in range(len(kept))], *arrays])

    return source.mapInArrow(in_batches(one), T.StructType([docs.schema[c] for c in kept] + added))


def restore_texts(docs: DataFrame, output_col: str = "output", form_col: str = "form", text_col: str = "restored", rules: Rules = Rules()) -> DataFrame:
    """Adds the text rebuilt from output and form; null if either is null. Other columns stay."""
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c.lower() != text_col.lower()]
    output, form = fresh(docs, "_fim_output"), fresh(docs, "_fim_form")
    source = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(output_col).alias(output), F.col(form_col).alias(form))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        pairs = zip(batch.column(len(kept)).cast(pa.binary()).to_pylist(), batch.column(len(kept) + 1).to_pylist())
        texts = [None if o is None or f is None else restored(o, f, rules) for o, f in pairs]
        return batch_of([*kept, text_col], [*[batch.column(i) for i in range(len(kept))], pa.array(texts, pa.binary()).cast(pa.string())])

    return source.mapInArrow(in_batches(one), T.StructType([docs.schema[c] for c in kept] + [T.StructField(text_col, T.StringType())]))
