"""Patience alignment of two sequences, and its blocks."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Sequence


def longest_increasing(values: Sequence[int]) -> list[int]:
    """Positions of a longest strictly increasing subsequence."""
    ends: list[int] = []
    at: list[int] = []
    back = [-1] * len(values)
    for i, v in enumerate(values):
        k = bisect_left(ends, v)
        if k:
            back[i] = at[k - 1]
        if k == len(ends):
            ends.append(v)
            at.append(i)
        else:
            ends[k], at[k] = v, i
    out, i = [], at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = back[i]
    return out[::-1]


def align(a: Sequence, b: Sequence, repeats: bool = False) -> list[tuple[int, int]]:
    """Matched positions (in a, in b), both increasing.

    Anchors are items found once in either range; the longest increasing
    subsequence of them is matched, and each gap is aligned in its turn.  Equal
    items at the ends of a range match as they are.  With ``repeats``, a range without
    anchors takes each item's first, second and further occurrences in one with those in the other
    for anchors: a common subsequence in a time that repeated items don't square.
    """
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.append((i, k))
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            j, m = j - 1, m - 1
            out.append((j, m))
        if i >= j or k >= m:
            continue
        once: dict = {}
        for p in range(i, j):
            once[a[p]] = -1 if a[p] in once else p
        other: dict = {}
        for q in range(k, m):
            if once.get(b[q], -1) >= 0:
                other[b[q]] = -1 if b[q] in other else q
        anchors = sorted((once[x], q) for x, q in other.items() if q >= 0)
        if not anchors and repeats:
            anchors = _by_rank(a, i, j, b, k, m)
        kept = [anchors[p] for p in longest_increasing([q for _, q in anchors])]
        if not kept:
            continue
        out += kept
        before = (i - 1, k - 1)
        for p, q in [*kept, (j, m)]:
            todo.append((before[0] + 1, p, before[1] + 1, q))
            before = (p, q)
    return sorted(out)


def _by_rank(a: Sequence, i: int, j: int, b: Sequence, k: int, m: int) -> list[tuple[int, int]]:
    """The nth occurrence of each item in a's range with the nth in b's, in order of a."""
    places: dict = {}
    for q in range(m - 1, k - 1, -1):
        places.setdefault(b[q], []).append(q)
    return [(p, places[a[p]].pop()) for p in range(i, j) if places.get(a[p])]


def blocks(pairs: list[tuple[int, int]]) -> list[tuple[int, int, int]]:
    """(start in a, start in b, length) of maximal runs of matches that follow one another in both."""
    out: list[tuple[int, int, int]] = []
    for i, k in pairs:
        if out and (i, k) == (out[-1][0] + out[-1][2], out[-1][1] + out[-1][2]):
            out[-1] = (*out[-1][:2], out[-1][2] + 1)
        else:
            out.append((i, k, 1))
    return out
