"""Edit distances of many pairs of sequences, bit-parallel.

Columns of the distance matrix are kept as bit vectors of its vertical
differences (Myers), 64 rows of the longer sequence a word.  All pairs of as many
words take a step at once, one item of the shorter sequence; pairs too few for that
take theirs in Python's long integers.  Both give the same numbers.

A limit cuts a pair off: what is left of the shorter sequence lowers the distance by one an
item at the most, so a pair is dropped as soon as its distance can't come down to the limit.
"""

from __future__ import annotations

import numpy as np

WORD = 64
ONE = np.uint64(1)
TOGETHER = 4096  # pairs that take their steps at once
LOOK = 16  # steps between looks for pairs beyond their limit
FEW = 12  # pairs a word below which long integers are faster


def distances(codes: np.ndarray, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, limit: np.ndarray | None = None) -> np.ndarray:
    """Unit-cost distance of ``codes[a:a + n]`` and ``codes[b:b + m]`` for each pair of starts and lengths.

    With ``limit``, a distance that is greater is any number above it that isn't above the distance.
    """
    a, b, n, m = np.where(n < m, b, a), np.where(n < m, a, b), np.maximum(n, m), np.minimum(n, m)
    out = np.where(m > 0, n - m, n)
    most = n if limit is None else limit
    todo = np.flatnonzero((m > 0) & (out <= most))
    words = -(-n[todo] // WORD)
    for w in np.unique(words).tolist():
        rows = todo[words == w]
        if len(rows) < FEW * w:
            for r in rows.tolist():
                out[r] = _alone(codes[a[r] : a[r] + n[r]].tolist(), codes[b[r] : b[r] + m[r]].tolist(), int(most[r]))
            continue
        for at in range(0, len(rows), TOGETHER):
            part = rows[at : at + TOGETHER]
            out[part] = _together(codes, a[part], n[part], b[part], m[part], most[part], w)
    return out


def _items(codes: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sequence, place in it, code) of all items."""
    row = np.repeat(np.arange(len(start)), length)
    place = np.arange(len(row)) - np.repeat(np.cumsum(length) - length, length)
    return row, place, codes[start[row] + place]


def _together(codes: np.ndarray, a: np.ndarray, n: np.ndarray, b: np.ndarray, m: np.ndarray, most: np.ndarray, words: int) -> np.ndarray:
    span = int(codes.max()) + 1
    row, place, code = _items(codes, a, n)
    known, which = np.unique(row * span + code, return_inverse=True)
    rows_of = np.zeros((len(known) + 1, words), np.uint64)  # where a pair's long sequence has an item; the last row: nowhere
    np.bitwise_or.at(rows_of, (which, place // WORD), ONE << (place % WORD).astype(np.uint64))
    row, _, code = _items(codes, b, m)
    key = row * span + code
    found = np.minimum(np.searchsorted(known, key), len(known) - 1)
    item = np.where(known[found] == key, found, len(known))
    first = np.cumsum(m) - m

    out = np.zeros(len(a), np.int64)
    pair = np.argsort(-m, kind="stable")  # those that end first are the last ones
    up = np.full((words, len(pair)), np.iinfo(np.uint64).max)
    down = np.zeros((words, len(pair)), np.uint64)
    score, last = n[pair].copy(), ((n[pair] - 1) % WORD).astype(np.uint64)
    length, first, limit = m[pair], first[pair], most[pair]
    for j in range(int(m.max())):
        k = np.searchsorted(-length, -j)  # pairs longer than j
        if j % LOOK == 0 or k < len(pair):
            gone = score - (length - j) > limit
            if k < len(pair) or 2 * gone.sum() > len(pair):
                gone[k:] = True
                out[pair[gone]] = (score - (length - j))[gone]
                stay = ~gone
                pair, score, last, length, first, limit = (x[stay] for x in (pair, score, last, length, first, limit))
                up, down = up[:, stay], down[:, stay]
                if not len(pair):
                    return out
        more, less = np.ones(len(pair), np.uint64), np.zeros(len(pair), np.uint64)  # the row above the first rises by one
        there = rows_of[item[first + j]]
        for w in range(words):
            p, v, x = up[w], down[w], there[:, w]
            xv = x | v
            x = x | less
            xh = (((x & p) + p) ^ p) | x
            rise, fall = v | ~(xh | p), p & xh
            if w == words - 1:
                score += ((rise >> last) & ONE).astype(np.int64) - ((fall >> last) & ONE).astype(np.int64)
            rise, fall, more, less = (rise << ONE) | more, (fall << ONE) | less, rise >> np.uint64(63), fall >> np.uint64(63)
            up[w], down[w] = fall | ~(xv | rise), rise & xv
    out[pair] = score
    return out


def _alone(a: list[int], b: list[int], most: int) -> int:
    places: dict[int, list[int]] = {}
    for i, x in enumerate(a):
        places.setdefault(x, []).append(i)
    there = {}
    for x in set(b) & places.keys():
        bits = bytearray(len(a) // 8 + 1)
        for i in places[x]:
            bits[i >> 3] |= 1 << (i & 7)
        there[x] = int.from_bytes(bits, "little")
    whole, top = (1 << len(a)) - 1, 1 << (len(a) - 1)
    up, down, score, left = whole, 0, len(a), len(b)
    for item in b:
        x = there.get(item, 0)
        xv = x | down
        xh = (((x & up) + up) ^ up) | x
        rise, fall = down | (whole & ~(xh | up)), up & xh
        if rise & top:
            score += 1
        elif fall & top:
            score -= 1
        rise, fall = (rise << 1) | 1, fall << 1
        up, down = (fall | ~(xv | rise)) & whole, rise & xv & whole
        left -= 1
        if score - left > most:
            return score - left
    return score
