"""Edit distance over tokens, and the error rates made of it."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf
from pyspark.sql.types import DoubleType, IntegerType, StructType

from takepick.functions.distances import distances
from takepick.functions.text import tokens

ITEMS = 1 << 20  # tokens coded at once


def _coded(*sides: pa.Array) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray, np.ndarray]]]:
    """One number for each distinct token; of each side start, length and whether the array is there."""
    flat = [x.flatten() for x in sides]
    codes = pc.fill_null(pa.chunked_array(flat).combine_chunks().dictionary_encode(null_encoding="encode").indices, 0)
    out, at = [], 0
    for side, items in zip(sides, flat):
        length = np.asarray(pc.fill_null(pc.list_value_length(side), 0), np.int64)
        out.append((at + np.cumsum(length) - length, length, np.asarray(side.is_valid())))
        at += len(items)
    return np.asarray(codes, np.int64), out


def _parts(ref: pa.Array, hyp: pa.Array) -> Iterator[slice]:
    """Slices of a batch with about ``ITEMS`` tokens (one row at least)."""
    inner = pc.list_value_length(hyp)
    if pa.types.is_list(hyp.type.value_type):
        each = np.concatenate(([0], np.cumsum(np.asarray(pc.fill_null(pc.list_value_length(hyp.flatten()), 0), np.int64))))
        ends = np.cumsum(np.asarray(pc.fill_null(inner, 0), np.int64))
        size = np.diff(each[np.concatenate(([0], ends))])
    else:
        size = np.asarray(pc.fill_null(inner, 0), np.int64)
    part = np.cumsum(size + np.asarray(pc.fill_null(pc.list_value_length(ref), 0), np.int64)) // ITEMS
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(ref)]
    return (slice(a, b) for a, b in zip(cuts, cuts[1:]))


def _rates(distance: np.ndarray, length: np.ndarray) -> np.ndarray:
    return np.where(length > 0, distance / np.maximum(length, 1), np.minimum(distance, 1))


def _pairs(ref: pa.Array, hyp: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(distance, length of the reference, whether one side is null) of a batch, part by part."""
    for part in _parts(ref, hyp):
        codes, ((a, n, there), (b, m, said)) = _coded(ref[part], hyp[part])
        yield distances(codes, a, n, b, m), n, ~(there & said)


@arrow_udf(IntegerType())
def edit_distance(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    """Unit-cost edit distance of two token arrays of any length; null if one of them is."""
    return pa.concat_arrays([pa.array([], pa.int32()), *(pa.array(d, pa.int32(), mask=no) for d, _, no in _pairs(ref, hyp))])


@arrow_udf(DoubleType())
def error_rate(ref: pa.Array, hyp: pa.Array) -> pa.Array:
    """Distance over reference length, not clipped; of an empty reference 0 if both are empty, else 1."""
    return pa.concat_arrays([pa.array([], pa.float64()), *(pa.array(_rates(d, n), pa.float64(), mask=no) for d, n, no in _pairs(ref, hyp))])


@arrow_udf(StructType().add("place", "integer").add("rate", "double"))
def least_error_rate(ref: pa.Array, hyps: pa.Array) -> pa.Array:
    """Place (from 0) and error rate of the candidate nearest to the reference, the first of equals.

    ``hyps`` holds the candidates' token arrays in order; a null one takes no part, and if
    none does, place and rate are null.  All first candidates of a batch are compared, then all second
    ones, and so on, each only up to the best distance that its record has so far.
    """
    out = []
    for part in _parts(ref, hyps):
        lists = hyps[part]
        codes, ((a, n, _), (b, m, said)) = _coded(ref[part], lists.flatten())
        held = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), np.int64)
        first = np.cumsum(held) - held
        place, least = np.full(len(n), -1), np.full(len(n), np.iinfo(np.int64).max)
        for c in range(int(held.max(initial=0))):
            rows = np.flatnonzero(held > c)
            rows = rows[said[first[rows] + c]]
            at = first[rows] + c
            found = distances(codes, a[rows], n[rows], b[at], m[at], least[rows] - 1)
            found = np.where(n[rows] > 0, found, np.minimum(found, 1))  # of an empty reference all but 0 are as bad
            better = found < least[rows]
            place[rows[better]], least[rows[better]] = c, found[better]
        none = (place < 0) | ~np.asarray(ref[part].is_valid())
        columns = [pa.array(place, pa.int32(), mask=none), pa.array(_rates(np.where(none, 0, least), n), pa.float64(), mask=none)]
        out.append(pa.StructArray.from_arrays(columns, ["place", "rate"]))
    return pa.concat_arrays(out) if out else pa.array([], pa.struct([("place", pa.int32()), ("rate", pa.float64())]))


def wer(ref: Column, hyp: Column, normalize: str = "basic", tokenizer: str = "word", **how: bool) -> Column:
    """Word (or character) error rate of two texts."""
    return error_rate(tokens(ref, normalize, tokenizer, **how), tokens(hyp, normalize, tokenizer, **how))
