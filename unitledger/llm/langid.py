"""Language identification with one bit-sliced Bloom filter over character n-grams.

Every slot of the filter is a mask with one bit per language. Looking an n-gram up takes the AND
of its slots, which names all languages that hold it at once. A text's hits are counted per
language, corrected for the false positives that the filter's fill of that language's bit
predicts, and the language with the most corrected hits is the answer.

The filter is learnt from all training texts: n-grams are counted per language in Spark. A
language holds all that occur a number of times that grows slower than its corpus, so that rarer
ones come in as the corpus grows; every language that holds an n-gram has its bit. There are at
most MOST of them per length and language, which bounds the filter.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import batch_of, in_batches, prepare, signed, text_values, written
from unitledger.llm.words import mix

LENGTHS = (1, 2, 3, 4)
#: Of n n-grams of a language and length those count that make up one in KEPT * n ** (1/3) at least,
#: and one in MOST, which comes to bear beyond two billion.
KEPT, MOST = 200, 1 << 18
HASHES = 3
#: Code points worked on at once; a longer text is worked off in parts of this size.
GROUP = 1 << 18
#: Counts a task holds before it hands them on.
HELD = 1_000_000
UNKNOWN = "und"
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x27D4EB2F165667C5], dtype=np.uint64)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(i).isalpha() for i in range(0x110000)), dtype=bool, count=0x110000)


def _codes(text: str) -> np.ndarray:
    """Code points, all but letters as blanks."""
    data = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    return np.where(_letters()[data], data, np.uint32(32)).astype(np.uint64)


def _squeezed(code: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which code points stay when blanks in a row of one text are one."""
    return np.append(True, (code[1:] != 32) | (code[:-1] != 32) | (of[1:] != of[:-1]))


def _runs(texts: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(place of the text, code point, number of first ones seen before), short texts together and
    long ones in parts that begin with the last code points of the part before."""
    places: list[int] = []
    parts: list[str] = []
    held = 0

    def together() -> tuple[np.ndarray, np.ndarray, int]:
        of = np.repeat(np.array(places, dtype=np.int32), [len(p) + 2 for p in parts])
        code = _codes(" " + "  ".join(parts) + " ")
        keep = _squeezed(code, of)
        return of[keep], code[keep], 0

    for k, text in enumerate(texts):
        text = text.lower()
        if len(text) > GROUP:
            seen = np.zeros(0, dtype=np.uint64)
            for at in range(0, len(text), GROUP):
                part = _codes(" " * (at == 0) + text[at : at + GROUP] + " " * (at + GROUP >= len(text)))
                code = np.concatenate([seen, part])
                code = code[_squeezed(code, np.zeros(len(code)))]
                yield np.full(len(code), k, dtype=np.int32), code, len(seen)
                seen = code[-(max(LENGTHS) - 1) :] if max(LENGTHS) > 1 else seen
            continue
        places.append(k)
        parts.append(text)
        held += len(text)
        if held >= GROUP:
            yield together()
            places, parts, held = [], [], 0
    if parts:
        yield together()


def grams(texts: Sequence[str]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, place of the text, hash) of all n-grams, group by group.

    Letters are lower case, all else is a blank; blanks in a row are one, and texts begin and end
    with one. A blank alone is no n-gram.
    """
    for of, code, seen in _runs(texts):
        for n in LENGTHS:
            begin = max(0, seen - n + 1)  # those before end in the part before
            count = len(code) - n + 1
            if count <= begin:
                continue
            h = np.full(count, n, dtype=np.uint64)
            for j in range(n):
                h += code[j : j + count] * _PLACES[j]
            inside = of[:count] == of[n - 1 :]
            inside[:begin] = False
            if n == 1:
                inside &= code != 32
            yield n, of[:count][inside], mix(h[inside])


@dataclass(frozen=True)
class Filter:
    languages: tuple[str, ...]  # most common first
    slots: np.ndarray  # (slots, words of 64 languages)

    @property
    def false_hits(self) -> np.ndarray:
        """Chance per language that an n-gram it does not hold is found."""
        fill = np.array([self.bit(self.slots, b).mean() for b in range(len(self.languages))])
        return fill**HASHES

    @staticmethod
    def bit(masks: np.ndarray, b: int) -> np.ndarray:
        return (masks[:, b // 64] >> np.uint64(b % 64)) & np.uint64(1)

    def places(self, h: np.ndarray) -> list[np.ndarray]:
        most = np.uint64(len(self.slots) - 1)
        return [(h >> np.uint64(s)) & most for s in range(0, 20 * HASHES, 20)]

    def add(self, h: np.ndarray, b: int) -> None:
        for place in self.places(h):
            np.bitwise_or.at(self.slots[:, b // 64], place.astype(np.int64), np.uint64(1) << np.uint64(b % 64))

    def masks(self, h: np.ndarray) -> np.ndarray:
        found = None
        for place in self.places(h):
            own = self.slots[place.astype(np.int64)]
            found = own if found is None else found & own
        return found


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(lang, n, gram, seen), summed up within the task."""
    held: dict[tuple[str, int], list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def merged() -> dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]:
        out = {}
        for key, parts in held.items():
            values, back = np.unique(np.concatenate([v for v, _ in parts]), return_inverse=True)
            out[key] = (values, np.bincount(back, np.concatenate([c for _, c in parts])).astype(np.int64))
        return out

    def rows() -> Iterator[pa.RecordBatch]:
        for (lang, n), (values, seen) in merged().items():
            full = pa.array([lang] * len(values), pa.string())
            yield batch_of(["lang", "n", "gram", "seen"], [full, np.full(len(values), n, dtype=np.int32), signed(values), seen])

    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = text_values(batch.column(1))
        for lang in sorted(set(langs)):
            for n, _, h in grams([t for own, t in zip(langs, texts) if own == lang]):
                values, seen = np.unique(h, return_counts=True)
                held.setdefault((lang, n), []).append((values, seen))
                size += len(values)
        if size > HELD:
            held = {k: [v] for k, v in merged().items()}
            size = sum(len(v) for parts in held.values() for v, _ in parts)
            if size > HELD // 2:
                yield from rows()
                held, size = {}, 0
    yield from rows()


def learn(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> Filter | None:
    """A filter of the languages of `docs`, or None without any labelled text. Rows without text or
    language are skipped."""
    prepare(docs.sparkSession)
    source = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text")).dropna()
    counts = (
        source.mapInArrow(_counts, "lang string, n int, gram long, seen long")
        .groupBy("lang", "n", "gram")
        .agg(F.sum("seen").alias("seen"))
    )
    counts = written(counts)
    totals = counts.groupBy("lang", "n").agg(F.sum("seen").alias("all"))
    least = F.greatest(F.col("all") / MOST, F.pow(F.col("all").cast("double"), F.lit(2 / 3)) / KEPT)
    own = counts.join(totals, ["lang", "n"]).filter(F.col("seen") >= least).select("lang", "gram").toArrow()
    languages = [r.lang for r in totals.groupBy("lang").agg(F.sum("all").alias("all")).orderBy(F.desc("all"), "lang").collect()]
    if not languages:
        return None
    gram, lang = own.column("gram").to_numpy().view(np.uint64), np.array(own.column("lang").to_pylist())
    slots = 1 << int(np.ceil(np.log2(16 * max(64, len(np.unique(gram))))))
    made = Filter(tuple(languages), np.zeros((slots, -(-len(languages) // 64)), dtype=np.uint64))
    for b, name in enumerate(languages):
        made.add(gram[lang == name], b)
    return made


def predict(made: Filter, rates: np.ndarray, texts: Sequence[str]) -> tuple[list[str], np.ndarray]:
    """Language and score of each text; the score is the part of its n-grams the language holds."""
    hits = np.zeros((len(texts), len(made.languages)))
    total = np.zeros(len(texts))
    for _, of, h in grams(texts):
        masks = made.masks(h)
        total += np.bincount(of, minlength=len(texts))
        for b in range(len(made.languages)):
            hits[:, b] += np.bincount(of, made.bit(masks, b), len(texts))
    real = np.maximum(0, (hits - total[:, None] * rates) / (1 - rates))
    best = real.argmax(axis=1)
    score = np.clip(real[np.arange(len(texts)), best] / np.maximum(total, 1), 0, 1)
    return [made.languages[b] if n else UNKNOWN for b, n in zip(best, total)], np.where(total > 0, score, 0.0)


def held_out(id_col: str) -> Column:
    """The rows that are kept out of the learning: crc32 of the id as text leaves 2 when divided by 4."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))


def identify(docs: DataFrame, made: Filter | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row the id, `lang_pred` and `score`. Texts that are null or have no letter get `und`
    and 0; so do all without a filter. Of equal hits the more common language wins. Repeated rows
    are kept and other columns not looked at."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast((made, made.false_hits if made else None))
    source = docs.select(F.col(id_col), F.col(text_col))

    def one(batch: pa.RecordBatch) -> pa.RecordBatch:
        own, rates = shared.value
        texts = text_values(batch.column(1))
        langs, scores = predict(own, rates, texts) if own else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
        return batch_of([id_col, "lang_pred", "score"], [batch.column(0), pa.array(langs, pa.string()), scores])

    schema = T.StructType([source.schema[id_col], T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return source.mapInArrow(in_batches(one), schema)


def language_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Learns from the rows that are not held out, then identifies all: id, `held_out`, `lang_pred`, `score`."""
    made = learn(docs.filter(~held_out(id_col)), text_col, lang_col)
    return identify(docs, made, id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
