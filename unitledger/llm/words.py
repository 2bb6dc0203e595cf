"""Vectorised words, word hashes and word shingles of many texts at once.

Texts are UTF-8 bytes. A word is a run of bytes outside a set of ASCII separators; as no byte of
a multi-byte character is ASCII, byte runs and character runs are the same. Hashes have 64 bits
and only name words and shingles: equal ones always agree, so a filter on hashes loses nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

#: Bytes that are worked on at once; a longer text is cut at separators.
SEGMENT = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def _random_words(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_BYTE = _random_words(1, 256)
_STEP = _random_words(2, 1)[0]
_PLACE = _random_words(3, 256)


def separators(pattern_bytes: Sequence[int]) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list(pattern_bytes)] = True
    return table


#: Separators of `[^\x20\x09-\x0D]+`.
SPACES = separators([0x20, *range(0x09, 0x0E)])
#: Separators of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, applied after A-Z became a-z.
NOT_ALNUM = separators([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _STEP, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _pieces(texts: Sequence[bytes], separator: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Texts with their place; a long one comes in pieces that end at separators."""
    for k, text in enumerate(texts):
        start = 0
        while len(text) - start > SEGMENT:
            view = np.frombuffer(text, dtype=np.uint8, offset=start, count=SEGMENT)
            cuts = np.flatnonzero(separator[_LOWER[view]])
            if len(cuts):
                end = start + int(cuts[-1]) + 1
            else:
                rest = np.frombuffer(text, dtype=np.uint8, offset=start)
                cuts = np.flatnonzero(separator[_LOWER[rest]])
                end = start + int(cuts[0]) + 1 if len(cuts) else len(text)
            yield k, text[start:end]
            start = end
        yield k, text[start:]


def hashed_words(
    texts: Sequence[bytes], separator: np.ndarray, fold: bool = True
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts in order, and the place of each text's first word
    (with the number of all words as last entry). `fold`: A-Z count as a-z."""
    parts: list[np.ndarray] = []
    counts = np.zeros(len(texts) + 1, dtype=np.int64)
    group: list[tuple[int, bytes]] = []
    held = 0

    def flush() -> None:
        nonlocal group, held
        if not group:
            return
        data = np.frombuffer(b"\n".join(piece for _, piece in group) + b"\n", dtype=np.uint8)
        low = _LOWER[data] if fold else data
        inside = ~separator[low]
        edge = np.flatnonzero(np.diff(inside, prepend=False))
        starts, ends = edge[0::2], edge[1::2]
        if len(starts):
            gaps = np.diff(starts, append=len(data))
            place = np.arange(starts[0], len(data)) - np.repeat(starts, gaps)
            longest = int((ends - starts).max())
            place[place > longest] = longest
            value = _BYTE[low[starts[0] :]] * _powers(longest + 1)[place]
            value[~inside[starts[0] :]] = 0
            h = np.add.reduceat(value, starts - starts[0])
            parts.append(mix(h + (ends - starts).astype(np.uint64)))
            bounds = np.cumsum([0] + [len(piece) + 1 for _, piece in group])
            at = np.searchsorted(starts, bounds)
            for (k, _), n in zip(group, np.diff(at)):
                counts[k + 1] += n
        group, held = [], 0

    for k, piece in _pieces(texts, separator):
        group.append((k, piece))
        held += len(piece) + 1
        if held >= SEGMENT:
            flush()
    flush()
    words = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
    return words, np.cumsum(counts)


def sequence_hash(words: np.ndarray) -> int:
    """One hash for a whole short sequence, other than the hash of any window of fixed length."""
    own = np.append(words, np.uint64(len(words))) * _PLACE[: len(words) + 1]
    return int(mix(own.sum(dtype=np.uint64, keepdims=True) + _BYTE[:1])[0])


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """A hash for every window of `k` words, by the place of its first word."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    h = np.zeros(n, dtype=np.uint64)
    for j in range(k):
        h += words[j : j + n] * _PLACE[j]
    return mix(h)


def shingle_sets(texts: Sequence[bytes], separator: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its `k`-word windows; of fewer words, one for all."""
    words, at = hashed_words(texts, separator)
    all_windows = window_hashes(words, k)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        if b - a >= k:
            yield np.unique(all_windows[a : b - k + 1])
        elif b > a:
            yield np.array([sequence_hash(words[a:b])], dtype=np.uint64)
        else:
            yield np.zeros(0, dtype=np.uint64)
