"""SentencePiece (byte-pair) encoding by a table of prefixes, and decoding.

The encoding of a prefix of a text ends in exactly one token. A table holds that last token for
every prefix: a token that ends there (an automaton finds all of them) is the one if it fits the
last token of the prefix before it, that is, if merging the two tokens' text gives these two
tokens. Ids are recovered from the end of the table backwards. The time is linear in the text,
also for a text without any blank.

Merges never cross from another character to a blank mark, so the words of a text are encoded
one by one, and repeated words once per task.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator
from itertools import chain

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from unitledger.llm.common import batch_of, bounded_batches, in_batches, text_values

MARK = "▁"
#: Bytes each memory of words (and of token pairs) may take, about, before it starts anew, the
#: bytes of all of them that a worker keeps between tasks, and the longest word that is remembered.
REMEMBERED_BYTES = 24 << 20
KEPT_BYTES = 16 << 20
#: The bytes of each memory, all kept between tasks, where a pass returns no texts or ids.
ALONE_BYTES = 48 << 20
REMEMBERED_CHARS = 64
#: What an entry takes besides its characters and ids.
_ENTRY = 150
#: Code points encoded at a time; a longer text is worked off in parts.
PART = 1 << 20
_NEVER = float("inf")
_BASE = 1 << 24
_BORDER, _UNIT = re.compile(f"[^ {MARK}][ {MARK}]"), re.compile(f"{MARK}+[^{MARK}]*|[^{MARK}]+")


def read_model(path: str) -> dict:
    """Vocabulary and settings of a model file, on the driver."""
    from sentencepiece import sentencepiece_model_pb2

    with open(path, "rb") as file:
        model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
    spec = model.normalizer_spec
    if model.trainer_spec.model_type != 2 or model.pieces[0].type != 2 or spec.precompiled_charsmap or not spec.escape_whitespaces:
        raise ValueError("only byte-pair models without character mapping are supported")
    if model.trainer_spec.treat_whitespace_as_suffix or any(p.type in (4, 5) for p in model.pieces):
        raise ValueError("blank suffixes, user-defined and unused pieces are not supported")
    return {
        "pieces": [p.piece for p in model.pieces],
        "scores": [p.score for p in model.pieces],
        "types": [p.type for p in model.pieces],  # 1 normal, 2 unknown, 3 control, 6 byte
        "prefix": spec.add_dummy_prefix,
        "squeeze": spec.remove_extra_whitespaces,
        "fallback": model.trainer_spec.byte_fallback,
        "unknown_surface": model.trainer_spec.unk_surface,
    }


class _Memory(dict):
    """Results by argument; starts anew when it has filled its bytes."""

    def __init__(self, function, size=lambda key, value: _ENTRY):
        super().__init__()
        self.function, self.size, self.held = function, size, 0
        self.most: int | None = None  # bytes, if not REMEMBERED_BYTES

    def __missing__(self, key):
        value = self.function(key)
        size = self.size(key, value)
        if size:
            self.held += size
            if self.held > (self.most or REMEMBERED_BYTES):
                self.forget()
                self.held = size
            self[key] = value
        return value

    def forget(self) -> None:
        self.clear()
        self.held = 0


def _word_size(word: str, ids: tuple[int, ...]) -> int:
    """Bytes a word takes in memory, 0 for one that is too long to be kept."""
    return _ENTRY + 2 * len(word) + 8 * len(ids) if len(word) <= REMEMBERED_CHARS else 0


class Pieces:
    """Encoder and decoder for one model, as `read_model` returns it."""

    def __init__(self, model: dict):
        self.pieces, self.scores, types = model["pieces"], model["scores"], model["types"]
        self.prefix, self.squeeze = model["prefix"], model["squeeze"]
        self.rank: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        self.unknown = types.index(2)
        self.fallback = model["fallback"]
        for i, (piece, score, kind) in enumerate(zip(self.pieces, self.scores, types)):
            if kind == 1:
                self.rank[piece], self.id[piece] = -score, i
            elif kind == 6:
                self.byte[int(piece[3:-1], 16)] = i
        self.end = self.pieces.index("</s>")
        if any(MARK in p.lstrip(MARK) for p in self.id):
            raise ValueError("a piece has a blank mark behind another character")
        self.singles = {p for p in self.id if len(p) == 1}
        self._unseen = re.compile("[^" + re.escape("".join(sorted(self.singles))) + "]|" + MARK + "{2,}")
        self.lengths = [len(p) for p in self.pieces]
        self._tables()
        self.pair = _Memory(self._fitting)
        self.inner = _Memory(lambda w: self._word(MARK + w), _word_size)
        self.first = _Memory(self._word, _word_size)
        self.lines = "\n" not in self.singles  # then no token holds one
        # Decoding: blank marks are blanks, bytes from 128 on are marked to be joined later.
        self.text = [p.replace(MARK, " ") if k == 1 else "" for p, k in zip(self.pieces, types)]
        self.text[self.unknown] = model["unknown_surface"]
        for b, i in self.byte.items():
            self.text[i] = chr(b) if b < 128 else chr(0xDC00 + b)
        self.silent = {i for i, k in enumerate(types) if k == 3}
        self.bytes = set(self.byte.values())

    def merged(self, symbols: Iterable[str]) -> list[str]:
        """Plain merging: always the pair with the best score, the leftmost of equal ones."""
        parts: list[str | None] = list(symbols)
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap: list[tuple[float, int, str]] = []

        def offer(i: int) -> None:
            j = after[i]
            if i >= 0 and j < len(parts) and (rank := self.rank.get(parts[i] + parts[j])) is not None:
                heapq.heappush(heap, (rank, i, parts[i] + parts[j]))

        for i in range(len(parts) - 1):
            offer(i)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= len(parts) or parts[j] is None or parts[i] + parts[j] != joined:
                continue
            parts[i], parts[j] = joined, None
            after[i] = after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            if before[i] >= 0:
                offer(before[i])
            offer(i)
        return [p for p in parts if p is not None]

    def _tables(self) -> None:
        """The automaton of pieces that merging can make, and how each is made: its spines are the
        tokens that hold its first (or last) character on the way, from that character on."""
        self.left: dict[str, tuple[tuple[str, float], ...]] = {}
        self.right: dict[str, tuple[tuple[str, float], ...]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece in sorted(self.id, key=len):
            rank = self.rank[piece]
            if len(piece) == 1:
                self.left[piece] = self.right[piece] = ((piece, -_NEVER),)
            elif piece.startswith(MARK * 2):
                continue  # runs of marks have equal scores; such words are merged plainly
            else:
                made = [k for k in range(1, len(piece)) if self._last_pair(piece, k, rank)]
                if not made:
                    continue
                a, b = piece[: made[0]], piece[made[0] :]
                self.left[piece] = (*self.left[a], (piece, rank))
                self.right[piece] = (*self.right[b], (piece, rank))
            self.automaton.add_word(piece, self.id[piece])
        self.automaton.make_automaton()

    def _last_pair(self, piece: str, k: int, rank: float) -> bool:
        a, b = piece[:k], piece[k:]
        if a not in self.left or b not in self.left:
            return False
        if max(self.left[a][-1][1], self.left[b][-1][1]) >= rank:
            return False
        return self._fits((a, b), rank)

    def _fits(self, pair: tuple[str, str], own: float | None = None) -> bool:
        """Whether merging the text of two tokens gives just these two (but for merging them, `own`).

        Follows both sides of the border through time: at each moment a token ends there and one
        starts there. They are merged if that comes before either takes part in its next merge;
        of equal scores the left one comes first.
        """
        a, b = self.right[pair[0]], self.left[pair[1]]
        i = j = 0
        while True:
            next_a = a[i + 1][1] if i + 1 < len(a) else _NEVER
            next_b = b[j + 1][1] if j + 1 < len(b) else _NEVER
            across = self.rank.get(a[i][0] + b[j][0])
            whole = i + 1 == len(a) and j + 1 == len(b)
            if across is not None and across < next_a and across <= next_b and not (whole and own == across):
                return False
            if whole:
                return True
            if next_a <= next_b:
                i += 1
            else:
                j += 1

    def _fitting(self, key: int) -> bool:
        return self._fits((self.pieces[key // _BASE], self.pieces[key % _BASE]))

    def _known(self, text: str) -> list[int]:
        """Ids of a text of characters that are all pieces, without runs of marks."""
        if text in self.left:  # a piece that merging makes is its own encoding
            return [self.id[text]]
        last = [0] * len(text)  # by the place of a prefix's last character; 0 is no token
        pair, lengths = self.pair, self.lengths
        for stop, token in self.automaton.iter(text):
            if not last[stop]:
                before = stop - lengths[token]
                if before < 0 or pair[last[before] * _BASE + token]:
                    last[stop] = token
        out = []
        at = len(text) - 1
        while at >= 0:
            token = last[at]
            out.append(token)
            at -= lengths[token]
        return out[::-1]

    def _word(self, word: str) -> tuple[int, ...]:
        if self._unseen.search(word) is None:
            return tuple(self._known(word)) if word else ()
        out: list[int] = []
        at = 0
        for odd in self._unseen.finditer(word):
            if odd.start() < at:
                continue
            if odd[0][0] == MARK:
                stop = next((m.start() for m in self._unseen.finditer(word, odd.end())), len(word))
                if odd.start() > at:
                    out += self._known(word[at : odd.start()])
                out += [self.id[p] for p in self.merged(word[odd.start() : stop])]
                at = stop
                continue
            if odd.start() > at:
                out += self._known(word[at : odd.start()])
            out += [self.byte[b] for b in odd[0].encode()] if self.fallback else [self.unknown]
            at = odd.end()
        if at < len(word):
            out += self._known(word[at:])
        return tuple(out)

    def parts(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, part by part, without the end id."""
        if self.squeeze:
            text = re.sub(" {2,}", " ", text.strip(" ")).rstrip(" " + MARK)
        if text and self.prefix:
            text = " " + text
        at = 0
        while at < len(text):
            cut = _BORDER.search(text, at + PART)
            stop = cut.start() + 1 if cut else len(text)
            yield self._units(text[at:stop].replace(" ", MARK))
            at = stop

    def _units(self, text: str) -> list[int]:
        """Ids of a text that ends where no merge can cross."""
        if MARK * 2 in text:
            return [*chain.from_iterable(map(self.first.__getitem__, _UNIT.findall(text)))]
        ids: list[int] = []
        for k, line in enumerate(text.split("\n") if self.lines else [text]):
            if k:
                ids += self.first["\n"]
            head, *words = line.split(MARK)
            if head:
                ids += self.first[head]
            ids += chain.from_iterable(map(self.inner.__getitem__, words))
        return ids

    def begin(self, most: int | None) -> None:
        """What a worker does at the start of a task: each memory may take `most` bytes, or
        REMEMBERED_BYTES."""
        for m in (self.pair, self.inner, self.first):
            m.most = most
            if m.held > (most or REMEMBERED_BYTES):
                m.forget()

    def rest(self, kept: int | None = None) -> None:
        """What a worker does at the end of a task, as it may wait, or run other code, for long:
        the memories stay if they take up to `kept` bytes, or KEPT_BYTES, in all."""
        memories = (self.pair, self.inner, self.first)
        if sum(m.held for m in memories) > (kept or KEPT_BYTES):
            for m in memories:
                m.forget()

    def encode(self, text: str) -> list[int]:
        return [*chain.from_iterable(self.parts(text)), self.end]

    def decode(self, ids: list[int]) -> str:
        body = ids
        while body and body[-1] in self.silent:
            body = body[:-1]
        if self.silent.isdisjoint(body):
            return self._join([body])
        runs: list[list[int]] = [[]]  # bytes on both sides of a control id are no character
        for i in body:
            if i in self.silent:
                runs.append([])
            else:
                runs[-1].append(i)
        return self._join(runs)

    def _join(self, runs: list[list[int]]) -> str:
        out: list[str] = []
        begun = not (self.prefix or self.squeeze)
        for ids in runs:
            start = 0
            while not begun and start < len(ids):
                i = ids[start]
                if i in self.bytes:
                    break
                piece = self.text[i]  # a text's first blank goes, all of them if blanks are squeezed
                bare = piece[1:] if piece.startswith(" ") and i != self.unknown else piece
                out.append(bare)
                begun = bool(bare) or not self.squeeze
                start += 1
            rest = ids[start:]
            begun = begun or bool(rest)
            joined = "".join(map(self.text.__getitem__, rest))
            if not joined.isascii():
                raw = joined.encode("utf-8", "surrogateescape")
                try:
                    joined = raw.decode()
                except UnicodeDecodeError:
                    joined = self._lenient(raw)
            out.append(joined)
        return "".join(out)

    @staticmethod
    def _lenient(raw: bytes) -> str:
        out, at = [], 0
        while at < len(raw):
            for n in (1, 2, 3, 4):
                try:
                    out.append(raw[at : at + n].decode())
                    at += n
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                at += 1
        return "".join(out)


_own: dict[int, Pieces] = {}


def _pieces(model) -> Pieces:
    """The tables of a broadcast model, made once per Python worker."""
    key = model.value["key"]
    if key not in _own:
        _own.clear()
        _own[key] = Pieces(model.value)
    return _own[key]


def _in_batches(model, function, most: int | None = None):
    """`in_batches` of a function of the model's tables and a batch. With `most`, each memory may
    take so many bytes and all of them are kept between tasks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for own in _own.values():
            own.begin(most)

        def one(batch: pa.RecordBatch) -> pa.RecordBatch | None:
            if model.value["key"] not in _own:
                _pieces(model).begin(most)
            return function(_pieces(model), batch)

        try:
            yield from in_batches(one)(batches)
        finally:
            for own in _own.values():
                own.rest(3 * most if most else None)

    return run


def _share(docs: DataFrame, path: str):
    model = read_model(path)
    with open(path, "rb") as file:
        model["key"] = hashlib.sha256(file.read()).hexdigest()
    return docs.sparkSession.sparkContext.broadcast(model)


def encode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds the ids of each text, end id last, as an array column; null and empty texts have only
    the end id. All rows and columns stay; a column named `ids_col` is replaced."""
    bounded_batches(docs.sparkSession)
    model = _share(docs, path)
    kept = [c for c in docs.columns if c != ids_col]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    at = kept.index(text_col)

    def one(own: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = pa.array([own.encode(t) for t in text_values(batch.column(at))], pa.list_(pa.int32()))
        return batch_of([*kept, ids_col], [*batch.columns, ids])

    return docs.select(*kept).mapInArrow(_in_batches(model, one), schema)


def decode_documents(docs: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Adds the text of each array of ids; null gives the empty text. Other rows and columns stay."""
    bounded_batches(docs.sparkSession)
    model = _share(docs, path)
    kept = [c for c in docs.columns if c != text_col]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(text_col, T.StringType())])
    at = kept.index(ids_col)

    def one(own: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = [own.decode(ids or []) for ids in batch.column(at).to_pylist()]
        return batch_of([*kept, text_col], [*batch.columns, pa.array(texts, pa.string())])

    return docs.select(*kept).mapInArrow(_in_batches(model, one), schema)


def recode_documents(docs: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Adds the ids of each text, end id last, and replaces the text by what they decode to, in one
    pass. A null text has the ids of an empty one and stays null. All rows and other columns stay;
    a column named `ids_col` is replaced."""
    bounded_batches(docs.sparkSession)
    model = _share(docs, path)
    kept = [c for c in docs.columns if c.lower() != ids_col.lower()]
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(ids_col, T.ArrayType(T.IntegerType()))])
    at = kept.index(text_col)

    def one(own: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        ids = [own.encode(t or "") for t in texts]
        decoded = pa.array([None if t is None else own.decode(i) for t, i in zip(texts, ids)], pa.string())
        columns = [decoded if k == at else c for k, c in enumerate(batch.columns)]
        return batch_of([*kept, ids_col], [*columns, pa.array(ids, pa.list_(pa.int32()))])

    return docs.select(*kept).mapInArrow(_in_batches(model, one), schema)


def round_trip(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per input row: number of ids, SHA-256 of the ids as decimals joined by blanks, and SHA-256 of
    the text decoded from them. Ids and text stay in the task that made them."""
    bounded_batches(docs.sparkSession)
    model = _share(docs, path)
    source = docs.select(F.col(id_col), F.col(text_col))
    schema = T.StructType(
        [source.schema[id_col], T.StructField("n_tokens", T.LongType())]
        + [T.StructField(c, T.StringType()) for c in ("ids_sha256", "decoded_sha256")]
    )

    def one(own: Pieces, batch: pa.RecordBatch) -> pa.RecordBatch:
        names = own.__dict__.setdefault("names", [str(i) for i in range(len(own.pieces))])
        counts, id_hashes, text_hashes = [], [], []
        for text in text_values(batch.column(1)):
            ids = own.encode(text)
            counts.append(len(ids))
            id_hashes.append(hashlib.sha256(" ".join(map(names.__getitem__, ids)).encode()).hexdigest())
            text_hashes.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return batch_of(schema.names, [batch.column(0), pa.array(counts, pa.int64()), id_hashes, text_hashes])

    return source.mapInArrow(_in_batches(model, one, ALONE_BYTES), schema)
