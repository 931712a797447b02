"""Line dedup by pairwise alignment.

Documents that overlap are found by the hashes of rare shared lines, taken in runs
of just ``min_bytes``: a common block of any two documents is made of such runs.
Each run has an earliest holder.  A document's shared runs are looked at in two rounds.
In the first, those that are rarer than the runs next to them nominate their
earliest holders as partners; in the second, all runs that no
alignment has covered so far.  So a frequent line makes a pair only where
nothing rarer leads to it, no run is too common to be found, and a group of copies
makes no pairs among its members.

A pair is aligned by patience diff over line hashes; stretches without unique lines are aligned by
their lines' occurrences.  Where that leaves a run that both documents hold, repeated in one
of the two or in another order, the two are aligned once more from there on.  Aligned blocks of at
least ``min_bytes`` are deleted from the later document.  The earliest holder of a line never loses it,
so of every deleted line one copy stays.

Hashes travel, a text only once, when its lines are deleted.  A partner's hashes are
there once for ``SHARE`` documents compared with it, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import Scratch, fresh, let, text_batches
from takepick.llm.patience import align, blocks

SHARE = 64  # documents compared with one copy of their partner's hashes


def line_hashes(text: str) -> tuple[list[int], list[int]]:
    """Hash and bytes of each line without the white space at its ends; 0 for an empty line."""
    lines = [x.strip().encode("utf-8", "surrogatepass") for x in text.split("\n")]
    return [xxhash.xxh3_64_intdigest(x) - (1 << 63) if x else 0 for x in lines], [len(x) for x in lines]


def runs(hashes: list[int], sizes: list[int], min_bytes: int) -> list[tuple[int, int, int]]:
    """(hash, start, end) of all shortest runs of at least ``min_bytes`` that begin or end at a line; no line may be empty.

    Every line of a longer run is in one of the shortest runs within it.
    """
    raw = memoryview(np.array(hashes, np.int64).tobytes())
    ends = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
    n = len(hashes)
    to = np.searchsorted(ends, ends[:-1] + min_bytes)  # from each line on
    back = np.searchsorted(ends, ends[1:] - min_bytes, "right") - 1  # up to each line
    cuts = {(i, j) for i, j in enumerate(to.tolist()) if j <= n} | {(i, j) for j, i in enumerate(back.tolist(), 1) if i >= 0}
    return [(xxhash.xxh3_64_intdigest(raw[8 * i : 8 * j]) - (1 << 63), i, j) for i, j in sorted(cuts)]


def starts(hashes: list[int], sizes: list[int], min_bytes: int) -> dict[int, int]:
    """Where each run begins first."""
    out: dict[int, int] = {}
    for key, i, _ in runs(hashes, sizes, min_bytes):
        out.setdefault(key, i)
    return out


def common_lines(later: list[int], sizes: list[int], earlier: list[int], min_bytes: int, held: dict[int, int] | None = None) -> list[int]:
    """Lines of the later document within aligned blocks of at least ``min_bytes`` (empty lines don't end a block).

    The documents are aligned as wholes first, which matches each line of either once and in order.  A run of the later one with lines that are
    left, and that the earlier one holds too (``held``: where each of its runs begins), is aligned from there on:
    so passages that are repeated or in another order have blocks as well.
    """
    full_a, full_b = [i for i, x in enumerate(later) if x], [i for i, x in enumerate(earlier) if x]
    a, b, of_a = [later[p] for p in full_a], [earlier[p] for p in full_b], [sizes[p] for p in full_a]
    lost = bytearray(len(a))

    def take(at: int, pairs: list[tuple[int, int]]) -> None:
        for i, _, n in blocks(pairs):
            if sum(of_a[at + i : at + i + n]) >= min_bytes:
                lost[at + i : at + i + n] = b"\1" * n

    take(0, align(a, b, repeats=True))
    if 0 in lost:
        if held is None:
            size = dict(zip(a, of_a))
            held = starts(b, [size.get(x, min_bytes) for x in b], min_bytes)
        for key, i, j in runs(a, of_a, min_bytes):
            if key not in held or 0 not in lost[i:j]:
                continue
            k, n, pairs = held[key], j - i, []
            while len(pairs) < n:  # as far as the block goes
                pairs = align(a[i : i + n], b[k : k + n])
                if len(pairs) < n or min(len(a) - i, len(b) - k) <= n:
                    break
                n = min(2 * n, len(a) - i, len(b) - k)
            take(i, pairs)
    spans, i = [], 0
    while (i := lost.find(1, i)) >= 0:
        j = lost.find(0, i)
        j = len(lost) if j < 0 else j
        spans.append((i, j))
        i = j
    return sorted({r for i, j in spans for r in range(full_a[i], full_a[j - 1] + 1)})


def duplicate_lines(docs: DataFrame, min_bytes: int = 64, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document that loses lines: doc_id, text_hash, lines (sorted line numbers from 0), sources (ids).

    Lines are compared without white space at their ends, short ones too.  The later of two
    documents is that of the larger id.  Rows with a null id take no part; rows
    of one id are not compared with one another, and equal ones have one result.
    Null and empty texts have no lines to lose.  No rows give no rows; other
    columns are ignored.  ``text_hash`` (xxhash64) tells rows of one id apart.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in text_batches(batches, "text"):
            made, found = [line_hashes(t) for t in batch.column("text").to_pylist()], []
            for h, n in made:
                full = [i for i, x in enumerate(h) if x]
                found.append([(k, full[i], full[j - 1]) for k, i, j in runs([h[i] for i in full], [n[i] for i in full], min_bytes)])
            arrays = [pa.array([m[0] for m in made], pa.list_(pa.int64())), pa.array([m[1] for m in made], pa.list_(pa.int32()))]
            arrays += [pa.array([[r[c] for r in f] for f in found], pa.list_(t)) for c, t in enumerate((pa.int64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("text_hash"), *arrays], ["doc_id", "text_hash", "hashes", "sizes", "keys", "starts", "ends"])

    def nominate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Partners for the runs not yet covered: in the first round (no lines known) of the rarest among their neighbours."""
        for batch in batches:
            rows = []
            for row in batch.to_pylist():
                lost, marks = set(row["lines"] or ()), row["marks"]
                if row["lines"] is not None:
                    chosen = [m for m in marks if not lost.issuperset(range(m["start"], m["end"] + 1))]
                else:
                    near = [a["end"] >= b["start"] for a, b in zip(marks, marks[1:])]  # runs that share lines
                    chosen = [
                        m
                        for i, m in enumerate(marks)
                        if not (i and near[i - 1] and marks[i - 1]["holders"] < m["holders"]) and not (i < len(near) and near[i] and marks[i + 1]["holders"] <= m["holders"])
                    ]
                rows += [(row["doc_id"], row["text_hash"], *first) for first in sorted({(m["first"], m["first_hash"]) for m in chosen})]
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64()) for c in range(4)], ["doc_id", "text_hash", "first", "first_hash"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come partner first, then the documents compared with it."""
        hashes, held = [], {}
        for whole in batches:
            for cut in range(0, whole.num_rows, 256):
                out = []
                for row in whole.slice(cut, 256).to_pylist():
                    if row["doc_id"] is None:
                        full = [(h, n) for h, n in zip(row["hashes"], row["sizes"]) if h]
                        hashes, held = row["hashes"], starts([h for h, _ in full], [n for _, n in full], min_bytes)
                        continue
                    out.append((row["doc_id"], row["text_hash"], row["first"], common_lines(row["hashes"], row["sizes"], hashes, min_bytes, held)))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in out], t) for c, t in enumerate(kinds)], ["doc_id", "text_hash", "first", "lines"])

    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text")).where("doc_id is not null")
    with Scratch(docs.sparkSession) as s:
        described = source.mapInArrow(describe, "doc_id long, text_hash long, hashes array<long>, sizes array<int>, keys array<long>, starts array<int>, ends array<int>")
        described = s.table(described.dropDuplicates(["doc_id", "text_hash"]))
        held = described.select("doc_id", "text_hash", F.inline(F.arrays_zip("keys", "starts", "ends")).alias("key", "start", "end"))
        first = F.min("doc_id").alias("first"), F.min_by("text_hash", "doc_id").alias("first_hash")  # of several texts of that id any that holds the run
        shared = held.groupBy("key").agg(*first, F.max("doc_id").alias("last"), F.count(F.lit(1)).alias("holders")).where("first < last")
        shared = s.table(shared.select("key", "first", "first_hash", "holders"))  # written down, so that the join may split a frequent run
        marks = held.join(shared, "key").where("doc_id > first").groupBy("doc_id", "text_hash")
        marks = s.table(marks.agg(F.array_sort(F.collect_list(F.struct("start", "end", "first", "first_hash", "holders"))).alias("marks")))

        partner = ["first", "first_hash"]  # one text, however many have its id

        def lost(known: DataFrame) -> DataFrame:
            pairs = s.table(known.mapInArrow(nominate, "doc_id long, text_hash long, first long, first_hash long"))
            shares = pairs.groupBy(*partner).agg(F.ceil(F.count(F.lit(1)) / SHARE).cast("int").alias("shares"))
            other = described.select(F.col("doc_id").alias("first"), F.col("text_hash").alias("first_hash"), "hashes", "sizes")
            heads = shares.join(other, partner).select(*partner, F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"), F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("long").alias("text_hash"), "hashes", "sizes")
            rows = pairs.join(shares, partner).withColumn("share", F.pmod(F.xxhash64("doc_id", "text_hash"), "shares").cast("int"))
            rows = rows.join(described.select("doc_id", "text_hash", "hashes", "sizes"), ["doc_id", "text_hash"]).select(*heads.columns)
            dealt = heads.unionAll(rows).repartition(*partner, "share").sortWithinPartitions(*partner, "share", "doc_id")  # null first: the partner
            return s.table(dealt.mapInArrow(compare, "doc_id long, text_hash long, first long, lines array<int>"))

        def together(found: DataFrame) -> DataFrame:
            lines, sources = F.array_distinct(F.flatten(F.collect_list("lines"))), F.collect_set(F.when(F.size("lines") > 0, F.col("first")))
            return found.groupBy("doc_id", "text_hash").agg(F.array_sort(lines).alias("lines"), F.array_sort(sources).alias("sources"))

        found = lost(marks.withColumn("lines", F.lit(None).cast("array<int>")))
        found = found.unionAll(lost(marks.join(together(found).select("doc_id", "text_hash", "lines"), ["doc_id", "text_hash"])))
        return s.keep(together(found).where(F.size("lines") > 0))


def dedup_lines(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text", report: bool = False) -> DataFrame:
    """The documents, all rows and columns, without their duplicate lines.

    With ``report`` also removed_lines (their number) and sources (ids of the
    documents that keep them), in place of columns so named.
    """
    k, h, x, o = fresh(docs, "tp_id", "tp_hash", "tp_lines", "tp_sources")
    lost = found.select(F.col("doc_id").alias(k), F.col("text_hash").alias(h), F.col("lines").alias(x), F.col("sources").alias(o))
    same = (docs[id_col].cast("long") == lost[k]) & (F.xxhash64(F.coalesce(docs[text_col].cast("string"), F.lit(""))) == lost[h])

    def kept(lines: Column) -> Column:
        return F.array_join(F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col(x)), lambda i: F.get(lines, i)), "\n")

    cleaned = let(F.split(F.col(text_col), "\n", -1), kept)
    joined = docs.join(lost, same, "left").withColumn(text_col, F.when(F.col(x).isNull(), F.col(text_col)).otherwise(cleaned))
    more = [F.coalesce(F.size(x), F.lit(0)).cast("long").alias("removed_lines"), F.coalesce(o, F.array().cast("array<long>")).alias("sources")] if report else []
    return joined.select(*(c for c in docs.columns if not report or c.lower() not in ("removed_lines", "sources")), *more)
