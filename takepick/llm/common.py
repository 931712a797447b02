"""What the operators of this folder share: scratch tables and vectorised words.

Scratch tables are Parquet below ``spark.checkpoint.dir``, the folder that the
driver and all executors see, so a lost executor costs a re-read and nothing
more.  They are deleted when the operator ends; what it returns is cut with
``checkpoint()``, whose files go with the last reference to it.
"""

from __future__ import annotations

import hashlib
import uuid
import warnings
from collections.abc import Iterable

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takepick.sources.shared import checkpointed, delete, shared_dir

#: The white space bytes of the word contract, and A-Z.
SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


class Scratch:
    """Tables of one operator run: ``table`` writes one, the end of the block deletes all."""

    def __init__(self, spark: SparkSession):
        if spark.conf.get("spark.sql.adaptive.enabled") != "true":
            warnings.warn("spark.sql.adaptive.enabled is off: joins on frequent keys will not be split", stacklevel=3)
        self.spark, self.base, self.n = spark, f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}", 0

    def table(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.base}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            delete(self.spark, t._scratch_path)

    def keep(self, df: DataFrame) -> DataFrame:
        """The operator's result, free of the scratch tables."""
        return checkpointed(df)

    def __enter__(self) -> "Scratch":
        return self

    def __exit__(self, *_: object) -> None:
        delete(self.spark, self.base)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names not among the columns of ``df`` (compared without case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def ascii_lower(c: Column) -> Column:
    """Null as empty, A-Z in lower case, everything else as it is."""
    return F.translate(F.coalesce(c.cast("string"), F.lit("")), UPPER, UPPER.lower())


def let(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, even where lambdas use it for each item."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(n: int, seed: int) -> np.ndarray:
    """``n`` odd pseudo-random 64-bit numbers, a function of the seed alone."""
    at = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(at + np.uint64(seed)) | np.uint64(1)


_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


class Words:
    """All words of a batch of texts, flat.

    ``hash`` word hashes, ``doc`` the text of each word, ``start``/``end`` its
    bytes in ``data`` (the texts' lower-cased UTF-8, one after another, each
    followed by a space), ``first`` the index of each text's first word (with
    one more entry at the end).
    """

    def __init__(self, texts: Iterable[str | None], lower: bool = True):
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sizes = np.fromiter((len(r) for r in raw), np.int64, len(raw))
        self.base = np.concatenate(([0], np.cumsum(sizes + 1)))
        data = np.frombuffer(b" ".join(raw) + b" ", np.uint8) if raw else np.zeros(0, np.uint8)
        self.data = data = _LOWER[data] if lower else data
        space = _SPACE[data]
        before = np.concatenate(([True], space[:-1])) if len(data) else space
        self.start = np.flatnonzero(~space & before)
        self.end = np.flatnonzero(space & ~before) if len(data) else self.start
        self.doc = np.searchsorted(self.base, self.start, "right") - 1
        self.first = np.searchsorted(self.start, self.base)
        length = self.end - self.start
        if len(length):
            inside = np.flatnonzero(~space)
            pos = inside - np.repeat(self.start, length)
            terms = (data[inside].astype(np.uint64) + np.uint64(1)) * stream(int(length.max()), 7)[pos]
            self.hash = mix(np.add.reduceat(terms, np.concatenate(([0], np.cumsum(length)[:-1]))))
        else:
            self.hash = np.zeros(0, np.uint64)

    def count(self) -> np.ndarray:
        return np.diff(self.first)

    def digests(self) -> list[bytes]:
        """128 bits of the SHA-256 of each text's words, one space after each."""
        after = np.zeros(len(self.data), bool)
        after[self.end] = True
        kept = after | ~_SPACE[self.data]
        raw = np.where(after, np.uint8(32), self.data)[kept].tobytes()
        cuts = np.concatenate(([0], np.cumsum(kept)))[self.base].tolist()
        return [hashlib.sha256(raw[a:b]).digest()[:16] for a, b in zip(cuts, cuts[1:])]


def sets_of_shingles(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of ``k`` words: (text, hash), sorted by text and hash.

    A text of fewer words has its whole sequence as its one shingle; a text
    without words has none.
    """
    counts, coef = words.count(), stream(k, 11)
    h = np.zeros(max(len(words.hash) - k + 1, 0), np.uint64)
    for j in range(k):
        h += words.hash[j : j + len(h)] * coef[j]
    whole = words.doc[: len(h)] == words.doc[k - 1 : k - 1 + len(h)] if len(h) else np.zeros(0, bool)
    doc, hashes = words.doc[: len(h)][whole], mix(h[whole])
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        s = np.zeros(len(short), np.uint64)
        for j in range(k - 1):
            has = counts[short] > j
            s[has] += words.hash[words.first[short[has]] + j] * coef[j]
        doc = np.concatenate((doc, short))
        hashes = np.concatenate((hashes, mix(s ^ mix(counts[short].astype(np.uint64)))))
    order = np.lexsort((hashes, doc))
    doc, hashes = doc[order], hashes[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (hashes[1:] != hashes[:-1])
    return doc[new], hashes[new]


#: What a worker process keeps between the tasks of one operator.
kept: dict = {}
_owner = [""]


def claim(owner: str) -> None:
    """The worker now serves ``owner``: what another operator has kept goes, and unused memory back to the system."""
    if owner == _owner[0]:
        return
    _owner[0] = owner
    kept.clear()
    import ctypes
    import gc

    import pyarrow as pa

    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):
        pass


def text_batches(batches: Iterable, text: str, limit: int = 2 << 20, owner: str = "none"):
    """Cut Arrow batches so that each holds about ``limit`` bytes of text at most (one text at least)."""
    import pyarrow.compute as pc

    claim(owner)
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        if column.nbytes <= limit or batch.num_rows <= 1:
            yield batch
            continue
        part = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(column), 0), np.int64)) // limit
        cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            yield batch.slice(a, b - a)
