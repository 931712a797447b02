"""Sequence packing by non-negative least squares.

Documents are cut into windows and a remainder.  Remainders are gathered in
blocks of a bounded number of tokens; for each block

1. lengths are counted in a histogram of ``window / unit`` bins,
2. all combinations of at most ``depth`` bins that fill the window exactly are
   enumerated (a remainder counts with the upper bound of its bin),
3. repeat counts are solved by Lawson and Hanson's NNLS, rounded, and laid out
   while their bins last,
4. what is left is packed greedily, largest piece first; a gap that no piece
   fits is closed by cutting one.

Every document is in the histogram of its block.  A block belongs to one task,
so there is no shuffle, memory is bounded, and a lost executor repeats its own
tasks with the same result.  A task's last tokens go to sequences whose lengths
are powers of two, which need no padding: there is none at all.
"""

from __future__ import annotations

from bisect import bisect_right, insort
from collections.abc import Iterator
from functools import cache
from itertools import combinations_with_replacement
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import text_batches
from takepick.llm.tokens import OWNER, library_ids

SCHEMA = "doc_id long, start long, length long, doc_tokens long, sequence_id long, offset long"


@cache
def fillings(bins: int, depth: int) -> np.ndarray:
    """Matrix (bins, combinations): how often each combination that fills the window uses each bin."""
    columns = []
    for d in range(2, depth + 1):
        for head in combinations_with_replacement(range(1, bins), d - 1):
            last = bins - sum(head)
            if last >= head[-1]:
                columns.append((*head, last))
    out = np.zeros((bins, len(columns)))
    for j, c in enumerate(columns):
        for u in c:
            out[u - 1, j] += 1
    return out


@cache
def gram(bins: int, depth: int) -> np.ndarray:
    a = fillings(bins, depth)
    return a.T @ a


def nnls(a: np.ndarray, b: np.ndarray, g: np.ndarray | None = None, rounds: int = 400) -> np.ndarray:
    """Minimise |a x - b| over x >= 0 (Lawson and Hanson's active set method, on normal equations ``g = a.T a``)."""
    g, ab = a.T @ a if g is None else g, a.T @ b
    x, active = np.zeros(len(ab)), np.zeros(len(ab), bool)
    gradient = ab.copy()
    tolerance = 1e-9 * max(1.0, float(np.abs(ab).max(initial=0)))
    for _ in range(rounds):
        free = np.where(active, -np.inf, gradient)
        best = int(np.argmax(free)) if len(free) else -1
        if best < 0 or free[best] <= tolerance:
            break
        active[best] = True
        while True:
            on = np.flatnonzero(active)
            if not len(on):
                break
            part = g[np.ix_(on, on)]
            part[np.diag_indices(len(on))] += 1e-10  # columns may depend on one another
            trial = np.linalg.solve(part, ab[on])
            bad = trial <= 1e-12
            if not bad.any():
                x[on] = trial
                break
            step = np.min(x[on][bad] / np.maximum(x[on][bad] - trial[bad], 1e-300))
            x[on] += min(max(step, 0.0), 1.0) * (trial - x[on])
            active &= x > 1e-12
            x[~active] = 0
        on = np.flatnonzero(active)
        gradient = ab - g[:, on] @ x[on]
    return x


Piece = tuple[int, int, int]  # row, start, length


def pack_block(pieces: list[Piece], window: int, unit: int, depth: int) -> tuple[list[list[Piece]], list[Piece]]:
    """Full sequences of ``window`` tokens, and the pieces left over (less than a window in all)."""
    bins = window // unit
    by_bin: list[list[Piece]] = [[] for _ in range(bins)]
    for p in pieces:
        by_bin[-(-p[2] // unit) - 1].append(p)
    counts = np.array([len(x) for x in by_bin])
    full: list[list[Piece]] = []
    a = fillings(bins, depth)
    usable = np.flatnonzero((a <= counts[:, None]).all(axis=0))
    if len(usable):
        solved = nnls(a[:, usable], counts.astype(float), gram(bins, depth)[np.ix_(usable, usable)])
        for j in np.argsort(-solved, kind="stable"):
            uses = [(u, int(a[u, usable[j]])) for u in np.flatnonzero(a[:, usable[j]])]
            times = min(int(solved[j] + 0.5), *(len(by_bin[u]) // n for u, n in uses))
            full += [[by_bin[u].pop() for u, n in uses for _ in range(n)] for _ in range(times)]
    # pool: (length, row, start), so that bisection finds the largest piece that fits
    pool = sorted((p[2], p[0], p[1]) for x in by_bin for p in x)
    total = sum(p[0] for p in pool)
    out: list[list[Piece]] = []

    def close(sequence: list[Piece], gap: int) -> None:
        nonlocal total
        total -= gap
        while gap:
            at = bisect_right(pool, (gap, 1 << 62, 0))
            if at:
                size, row, start = pool.pop(at - 1)
            else:
                size, row, start = pool.pop()
                insort(pool, (size - gap, row, start + gap))
                size = gap
            sequence.append((row, start, size))
            gap -= size

    while full:
        sequence = full.pop()
        gap = window - sum(p[2] for p in sequence)
        if gap > total:  # nothing is left to close it with: its pieces go back
            for row, start, size in sequence:
                insort(pool, (size, row, start))
            total += window - gap
            continue
        close(sequence, gap)
        out.append(sequence)
    while total >= window:
        sequence = []
        close(sequence, window)
        out.append(sequence)
    return out, [(row, start, size) for size, row, start in reversed(pool)]


def pack(
    docs: DataFrame,
    tokenizer: str,
    window: int = 2048,
    end_id: int = 1,
    unit: int = 16,
    depth: int = 3,
    block_tokens: int = 1 << 21,
    id_col: str = "doc_id",
    text_col: str = "text",
    checksums: bool = False,
) -> DataFrame:
    """One row per piece: doc_id, start, length, doc_tokens, sequence_id, offset, ids (unsigned 32-bit, little-endian).

    ``checksums`` returns ids_crc32 (CRC-32 of those bytes) instead of the ids.

    Each document is its tokens and ``end_id``.  All sequences have ``window``
    tokens, but for the last few of a task, whose lengths are powers of two.  A
    null or empty text is the end id alone.  Null and repeated ids are carried as
    they are, each row being packed once.  No rows give no rows; other columns
    are ignored.  ``window`` must be a multiple of ``unit``.
    """
    if window % unit or window & (window - 1):
        raise ValueError("window must be a power of two and a multiple of unit")
    last_column = "ids_crc32" if checksums else "ids"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = library_ids(tokenizer)
        number = TaskContext.get().partitionId() << 33
        held: dict[int, tuple[int | None, np.ndarray]] = {}  # row: doc_id, ids
        pieces: list[Piece] = []
        waiting = row = 0

        def rows(sequences: list[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            for at in range(0, len(sequences), 256):
                out: list[tuple] = []
                for sequence in sequences[at : at + 256]:
                    offset = 0
                    for r, start, size in sequence:
                        doc, ids = held[r]
                        raw = ids[start : start + size].astype("<u4").tobytes()
                        out.append((doc, start, size, len(ids), number, offset, crc32(raw) if checksums else raw))
                        offset += size
                    number += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64()] * 6 + [pa.int64() if checksums else pa.binary()])],
                    ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", last_column],
                )

        for batch in text_batches(batches, "text", 4 << 20, OWNER):
            whole: list[list[Piece]] = []
            for doc, ids in zip(batch.column(0).to_pylist(), ids_of(batch.column(1))):
                held[row] = doc, np.append(ids, ids.dtype.type(end_id))
                n = len(held[row][1])
                whole += [[(row, at, window)] for at in range(0, n - window + 1, window)]
                if n % window:
                    pieces.append((row, n - n % window, n % window))
                    waiting += n % window
                row += 1
            yield from rows(whole)
            if waiting >= block_tokens:
                done, pieces = pack_block(pieces, window, unit, depth)
                yield from rows(done)
                waiting = sum(p[2] for p in pieces)
            keep = {p[0] for p in pieces}
            held = {r: x for r, x in held.items() if r in keep}
        done, pieces = pack_block(pieces, window, unit, depth)
        yield from rows(done)
        rest, last = sum(p[2] for p in pieces), []
        while rest:
            size = 1 << (rest.bit_length() - 1)
            rest -= size
            sequence = []
            while size:
                r, start, n = pieces.pop(0)
                if n > size:
                    pieces.insert(0, (r, start + size, n - size))
                    n = size
                sequence.append((r, start, n))
                size -= n
            last.append(sequence)
        yield from rows(last)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        run, f"{SCHEMA}, {last_column} {'long' if checksums else 'binary'}"
    )
