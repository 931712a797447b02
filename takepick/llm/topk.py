"""Exact top-k search by exhaustive term-at-a-time accumulation.

Candidates become blocks of postings (for each term the rows that hold it, with
their weights), queries blocks of sparse rows.  Blocks are dealt into bundles of a
few, and each pair of bundles is a cell of a grid: all blocks of queries in a cell
meet all its blocks of candidates, as any exhaustive search asks for.  There, for one term
after another, the queries that hold it scatter weight times posting into dense
score arrays, from which the k best are selected.  A cell merges the selections of its
candidate blocks, one window per query merges those of the cells.  Blocks and
bundles have a fixed size, so memory does not depend on the data, nothing is
broadcast, and nothing is gathered on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from takepick.llm.common import Scratch

TILE = 64  # queries whose score arrays are held at once
BUNDLE = {"candidate": 4, "query": 16}  # blocks
BLOCK = "id binary, ptr binary, at binary, weight binary"


def quantised(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of every component; null unless all are there and finite."""
    v = vector.cast("array<double>")
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(good, F.transform(v, lambda x: F.floor(x * F.lit(float(scale)))))


def _csr(ids: np.ndarray, rows: np.ndarray, terms: np.ndarray, weights: np.ndarray, by_term: bool) -> dict[str, bytes]:
    """Compressed by term (postings) or by row (queries)."""
    major, minor = (terms, rows) if by_term else (rows, terms)
    n = int(terms.max(initial=-1)) + 1 if by_term else len(ids)
    order = np.lexsort((minor, major))
    ptr = np.concatenate(([0], np.cumsum(np.bincount(major, minlength=n))))
    return {"id": ids.tobytes(), "ptr": ptr.astype(np.int64).tobytes(), "at": minor[order].astype(np.int32).tobytes(), "weight": weights[order].tobytes()}


def _blocks(rows: DataFrame, size: int, by_term: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cut in range(0, batch.num_rows, size):
                part = batch.slice(cut, size)
                lists = part.column(1)
                lengths = np.diff(np.asarray(lists.offsets))
                flat = np.asarray(lists.flatten(), np.int64)
                row = np.repeat(np.arange(len(lengths)), lengths)
                term = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                there = flat != 0
                made = _csr(np.asarray(part.column(0), np.int64), row[there], term[there], flat[there], by_term)
                yield pa.RecordBatch.from_pylist([made], pa.schema([(c, pa.binary()) for c in made]))

    return rows.mapInArrow(run, BLOCK)


def _accumulate(q: dict[str, np.ndarray], c: dict[str, np.ndarray], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query id, candidate id, score) of each query's k best in one block of candidates."""
    n, out = len(c["id"]), []
    order = np.argsort(c["id"], kind="stable")
    ids = c["id"][order]
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    at = place[c["at"]]  # postings point to candidates in order of id, so that ties fall to the smaller one
    for first in range(0, len(q["id"]), TILE):
        mine = np.arange(first, min(first + TILE, len(q["id"])))
        lo, hi = q["ptr"][mine[0]], q["ptr"][mine[-1] + 1]
        row = np.repeat(np.arange(len(mine)), np.diff(q["ptr"][mine[0] : mine[-1] + 2]))
        term, weight = q["at"][lo:hi], q["weight"][lo:hi]
        scores = np.zeros((len(mine), n), np.int64)
        by_term = np.argsort(term, kind="stable")
        cuts = np.flatnonzero(np.diff(term[by_term])) + 1
        for held in np.split(by_term, cuts) if len(by_term) else []:
            t = term[held[0]]
            if t + 1 >= len(c["ptr"]) or c["ptr"][t] == c["ptr"][t + 1]:
                continue
            posting = slice(c["ptr"][t], c["ptr"][t + 1])
            where, w = at[posting], c["weight"][posting]
            for r, x in zip(row[held], weight[held]):
                scores[r, where] += x * w
        for r, me in enumerate(q["id"][mine]):
            own = ids != me
            s, i = scores[r][own], ids[own]
            if len(s) > k:
                least = np.partition(s, len(s) - k)[len(s) - k]
                above = np.flatnonzero(s > least)
                ties = np.flatnonzero(s == least)[: k - len(above)]
                best = np.concatenate((above, ties))
                s, i = s[best], i[best]
            out.append((np.full(len(s), me), i, s))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3


def _top(found: tuple[np.ndarray, ...], k: int) -> tuple[np.ndarray, ...]:
    q, i, s = found
    order = np.lexsort((i, -s, q))
    q, i, s = q[order], i[order], s[order]
    start = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1]))) if len(q) else np.zeros(0, np.int64)
    rank = np.arange(len(q)) - np.repeat(start, np.diff(np.append(start, len(q))))
    return tuple(x[rank < k] for x in (q, i, s))


def exact_topk(rows: DataFrame, queries: DataFrame, k: int = 5, scale: int = 256, id_col: str = "vec_id", vector_col: str = "embedding", block: int = 2048) -> DataFrame:
    """The k best rows for each query: query_id, rank (from 1), vec_id, score.

    The score is the inner product of the quantised vectors; terms that one
    vector lacks count as 0.  A row is no candidate for a query of its own id.
    Ties go to the smaller id; with fewer candidates there are fewer rows.
    Vectors that are null or hold null or non-finite components, and rows with a
    null id, take no part; an empty vector scores 0 with all.  Rows repeated with
    one id are each a candidate, and as queries share one list of k.  No queries
    or no candidates give no rows.  Scores must fit 64 bits.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come cell by cell, a cell's query blocks first."""
        held, size, cell, asked = [], 0, None, []
        kinds = {"id": np.int64, "ptr": np.int64, "at": np.int32, "weight": np.int64}

        def give() -> pa.RecordBatch:
            best = _top(tuple(np.concatenate(x) for x in zip(*held)), k)
            return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in best], ["query_id", "vec_id", "score"])

        for batch in batches:
            for at in range(batch.num_rows):
                row = {c: np.frombuffer(batch.column(c)[at].as_py(), kinds[c]) for c in kinds}
                mine = batch.column("row")[at].as_py(), batch.column("col")[at].as_py()
                if mine != cell:
                    cell, asked = mine, []
                if batch.column("kind")[at].as_py() == 0:
                    asked.append(row)
                    continue
                held += [_accumulate(x, row, k) for x in asked]
                size += sum(len(x[0]) for x in held[len(held) - len(asked) :])
                if size > 1 << 20:
                    held = [_top(tuple(np.concatenate(x) for x in zip(*held)), k)]
                    size = len(held[0][0])
                    if size > 1 << 19:
                        yield give()
                        held, size = [], 0
        if held:
            yield give()

    def sparse(df: DataFrame) -> DataFrame:
        return df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col), scale).alias("v")).where("id is not null and v is not null")

    with Scratch(rows.sparkSession) as s:
        c = s.table(_blocks(sparse(rows), block, True))
        q = s.table(_blocks(sparse(queries), block, False))
        rows_of, cols_of = (max(1, -(-x.count() // BUNDLE[n])) for x, n in ((q, "query"), (c, "candidate")))

        def dealt(blocks: DataFrame, kind: int, mine: str, bundles: int, other: str, cells: int) -> DataFrame:
            """Each block in its bundle, once for each bundle of the other side."""
            placed = blocks.withColumn(mine, F.pmod(F.xxhash64("id"), F.lit(bundles)).cast("int")).withColumn("kind", F.lit(kind))
            return placed.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(cells - 1)))).select("row", "col", "kind", *blocks.columns)

        grid = dealt(q, 0, "row", rows_of, "col", cols_of).unionAll(dealt(c, 1, "col", cols_of, "row", rows_of))
        found = grid.repartition("row", "col").sortWithinPartitions("row", "col", "kind").mapInArrow(run, "query_id long, vec_id long, score long")
        w = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return s.keep(found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
