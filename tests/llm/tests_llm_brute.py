"""Plain versions of two operators, for comparison."""

from test_decontaminate import words
from test_ngram_join import shingles


def near_groups(rows, percent=75):
    """The smallest id of each component."""
    sets = {i: shingles(t) for i, t in rows}
    least = {i: i for i in sets}
    order = sorted(sets)
    for a in order:
        for b in order:
            if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((least[a], least[b]))
                least = {i: x if v == y else v for i, v in least.items()}
    return {i for i in order if least[i] == i}


def windows_hit(rows, items):
    wanted = {}
    for text in items:
        w = words(text)
        for i in range(max(1, len(w) - 9) if w else 0):
            wanted.setdefault(len(w[i : i + 10]), set()).add(tuple(w[i : i + 10]))
    return {
        i for i, t in rows for w in [words(t)] for n, own in wanted.items() if any(tuple(w[k : k + n]) in own for k in range(len(w) - n + 1))
    }
