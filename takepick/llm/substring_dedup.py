"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of a byte covers the 16 bytes up to it, so a chunk's ends depend on
the text near them alone and an insertion changes the chunks around it, no more.
A byte ends a chunk if its hash is below a threshold (a chunk in ``mean`` bytes),
no other byte of the 8 before it does so, and a character ends there.  Text of a short
period may have no such byte at all.  So a stretch of more than ``LONG`` bytes without one is cut where the hash is least
among the ``NEAR`` bytes before and after, in steps of ``mean`` bytes at least: in periodic text that is one
phase of the period, wherever the stretch begins.

Texts are chunked once; each document's digests are written down.  A chunk's
128-bit digest (of 10^12 distinct chunks any two share one with probability 10^-15) is grouped once over the corpus: the document of least id
holds the original.  Chunks that have an original elsewhere are joined into runs,
and a run of at least ``min_bytes`` is a duplicate span; short chunks alone,
which any two texts may share, are not.  Both exchanges carry digests and places,
never text; grouping combines before it shuffles and the join is one that
adaptive execution splits, so a passage that a third of all documents share
does not gather in one task.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from takepick.llm.common import Scratch, fresh, let, mix, stream, text_batches

WINDOW = 16
LONG, NEAR = 160, 64
GAP = max(WINDOW, NEAR)  # bytes between texts, so that none has a part in another's hashes
GEAR = (stream(256, 53) >> np.uint64(20)).astype(np.uint16)


def _least(h: np.ndarray) -> np.ndarray:
    """The least of the ``NEAR`` values up to each place."""
    m, k = h.copy(), 1
    while k < NEAR:
        m[k:] = np.minimum(m[k:], m[:-k])
        k *= 2
    return m


def _within_stretches(h: np.ndarray, data: np.ndarray, at: np.ndarray, base: np.ndarray, sizes: np.ndarray, mean: int) -> np.ndarray:
    """Last bytes of chunks within long stretches without a cut."""
    bounds = np.unique(np.concatenate((base, at + 1, base + sizes)))  # with the gaps between texts, which are short
    first, length = bounds[:-1], np.diff(bounds)
    first, length = first[length > LONG], length[length > LONG]
    if not len(first):
        return np.zeros(0, np.int64)
    stretch = np.zeros(len(data) + 1, np.int8)
    np.add.at(stretch, first, 1)
    np.add.at(stretch, first + length - 1, -1)  # but its last byte, which may be a cut
    stretch = np.cumsum(stretch[:-1]).astype(bool)
    v = np.where(stretch, h, np.uint16(0xFFFF))
    cut = stretch & (v <= _least(v)) & (v <= _least(v[::-1])[::-1])
    cut[:-1] &= (data[1:] & 0xC0) != 0x80
    places, out = np.flatnonzero(cut), []
    ends = np.searchsorted(places, first + length)
    for a, z, i in zip(first.tolist(), ends.tolist(), np.searchsorted(places, first).tolist()):
        mine = places[i:z].tolist()
        k = bisect_left(mine, a + 8)
        while k < len(mine):
            out.append(mine[k])
            k = bisect_left(mine, mine[k] + mean, k)
    return np.array(out, np.int64)


def chunk(texts: list[str | None], mean: int = 24) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, length, digest) of all chunks, in bytes, in order; a digest is two words."""
    raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
    gap = bytes(GAP)
    data = np.frombuffer(gap.join(raw) + gap, np.uint8)
    sizes = np.fromiter((len(r) for r in raw), np.int64, len(raw))
    base = np.concatenate(([0], np.cumsum(sizes + GAP)))[:-1]
    inside = np.zeros(len(data) + 1, np.int8)
    np.add.at(inside, base, 1)
    np.add.at(inside, base + sizes, -1)
    inside = np.cumsum(inside[:-1]).astype(bool)
    h = np.where(inside, GEAR[data], np.uint16(0))
    for k in (1, 2, 4, 8):  # doubling: after step k the hash covers 2k bytes
        h[k:] = h[k:] + (h[:-k] << np.uint16(k))
    cut = (h < (1 << 16) // mean) & inside
    cut[:-1] &= (data[1:] & 0xC0) != 0x80
    at = np.flatnonzero(cut)
    if len(at):
        lone = np.ones(len(at), bool)
        lone[1:] = np.diff(at) > 8
        at = at[lone]
    more = _within_stretches(h, data, at, base, sizes, mean)
    ends = np.unique(np.concatenate((at + 1, more + 1, (base + sizes)[sizes > 0])))
    if not len(ends):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty, np.zeros((0, 2), np.uint64)
    doc = np.searchsorted(base, ends - 1, "right") - 1
    first = np.ones(len(ends), bool)
    first[1:] = doc[1:] != doc[:-1]
    start = np.where(first, base[doc], np.concatenate(([0], ends[:-1])))
    length = ends - start
    held = np.flatnonzero(inside)
    pos = held - np.repeat(start, length)
    value, first_of, size = data[held].astype(np.uint64) + np.uint64(1), np.cumsum(length) - length, mix(length.astype(np.uint64))
    longest = int(length.max())
    digest = np.stack([mix(np.add.reduceat(value * stream(longest, seed)[pos], first_of) ^ size) for seed in (59, 61)], axis=1)
    return doc, start - base[doc], length, digest


def duplicate_spans(docs: DataFrame, mean: int = 24, min_bytes: int = 100, id_col: str = "doc_id", text_col: str = "text", within: bool = False) -> DataFrame:
    """One row per duplicate span: doc_id, text_hash, start, length (bytes of UTF-8), n_chunks, first_doc_id.

    The original of a chunk is in the document of least id; the
    span's ``first_doc_id`` is the document with the originals of most of its
    chunks.  Text that one document repeats (a refrain, a heading) is no duplicate,
    unless ``within`` asks for it: then only the first place in that document is the
    original.  A document without duplicates has no row.  Null and empty texts have
    no chunks.  Rows with a null id take no part.  Rows of one id are not compared
    with one another.  No rows give no rows; other columns
    are ignored.  ``text_hash`` (xxhash64) tells rows of one id apart.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            doc, start, length, digest = chunk(batch.column("text").to_pylist(), mean)
            order = np.lexsort((start, digest[:, 1], digest[:, 0], doc))
            again = np.zeros(len(doc), bool)
            again[order[1:]] = within & (doc[order[1:]] == doc[order[:-1]]) & (digest[order[1:]] == digest[order[:-1]]).all(axis=1)
            cuts = pa.array(np.searchsorted(doc, np.arange(batch.num_rows + 1)), pa.int32())
            columns = (digest[:, 0].copy().view(np.int64), digest[:, 1].copy().view(np.int64), again, start.astype(np.int32), length.astype(np.int32))
            lists = [pa.ListArray.from_arrays(cuts, pa.array(x)) for x in columns]
            yield pa.RecordBatch.from_arrays([batch.column("rid"), batch.column("doc_id"), batch.column("text_hash"), *lists], ["rid", "doc_id", "text_hash", "a", "b", "again", "start", "length"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).where("doc_id is not null")
    with Scratch(docs.sparkSession) as s:
        source = source.withColumn("rid", F.monotonically_increasing_id())
        described = s.table(source.mapInArrow(run, "rid long, doc_id long, text_hash long, a array<long>, b array<long>, again array<boolean>, start array<int>, length array<int>"))
        # rows of a chunk are its digest, its text's number and its own number there: all that both exchanges carry
        chunks = described.select("rid", "doc_id", F.posexplode(F.arrays_zip("a", "b", "again")).alias("n", "c")).select("rid", "doc_id", "n", "c.*")
        repeated, mine = (F.max("again"), ["again"]) if within else (F.lit(False), [])
        grouped = chunks.groupBy("a", "b").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"), repeated.alias("again"))
        twice = s.table(grouped.where("first_doc_id < last or again").select("a", "b", "first_doc_id"))
        found = chunks.select("rid", "n", "a", "b", *mine).join(twice, ["a", "b"]).drop("a", "b").join(described.select("rid", "doc_id"), "rid")
        found = found.where("doc_id > first_doc_id" + " or again" * within)
        run = F.col("n") - F.row_number().over(Window.partitionBy("rid").orderBy("n"))
        runs = found.withColumn("run", run).groupBy("rid", "run").agg(
            F.min("n").alias("from"), F.max("n").alias("to"), F.count(F.lit(1)).alias("n_chunks"), F.mode("first_doc_id", True).alias("first_doc_id")
        )
        place = lambda array, n: F.get(array, F.col(n)).cast("long")
        spans = runs.join(described.select("rid", "doc_id", "text_hash", F.col("start").alias("starts"), F.col("length").alias("lengths")), "rid")
        spans = spans.withColumn("start", place("starts", "from")).withColumn("length", place("starts", "to") + place("lengths", "to") - F.col("start"))
        # equal rows have one result
        owners = described.groupBy("doc_id", "text_hash").agg(F.min("rid").alias("rid")).select("rid")
        spans = spans.where(F.col("length") >= min_bytes).select("rid", "doc_id", "text_hash", "start", "length", "n_chunks", "first_doc_id")
        return s.keep(spans.join(owners, "rid").drop("rid"))


def without_spans(text: Column, spans: Column) -> Column:
    """The text without the given byte spans (array of (start, length), sorted); they begin and end at characters."""
    stop = F.concat(F.transform(spans, lambda x: x["start"]), F.array(F.octet_length(text).cast("long")))
    go = F.concat(F.array(F.lit(0).cast("long")), F.transform(spans, lambda x: x["start"] + x["length"]))

    def cut(raw: Column) -> Column:
        return F.array_join(F.transform(F.arrays_zip(go.alias("go"), stop.alias("stop")), lambda p: F.decode(F.substr(raw, (p["go"] + 1).cast("int"), (p["stop"] - p["go"]).cast("int")), "UTF-8")), "")

    return let(F.encode(text, "UTF-8"), cut)


def dedup_substrings(docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, all rows and columns, without their duplicate spans."""
    by_doc = spans.groupBy("doc_id", "text_hash").agg(F.array_sort(F.collect_list(F.struct("start", "length"))).alias("spans"))
    k, h, x = fresh(docs, "tp_id", "tp_hash", "tp_spans")
    by_doc = by_doc.select(F.col("doc_id").alias(k), F.col("text_hash").alias(h), F.col("spans").alias(x))
    same = (docs[id_col].cast("long") == by_doc[k]) & (F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == by_doc[h])
    joined = docs.join(by_doc, same, "left")
    cleaned = F.when(F.col(x).isNull(), F.col(text_col)).otherwise(without_spans(F.col(text_col), F.col(x)))
    return joined.withColumn(text_col, cleaned).select(*docs.columns)
