"""Sinks: compact JSON, manifests, shards, label logs, the result document."""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takepick.sources.listing import literal
from takepick.sources.shared import checkpointed

TOGETHER = 256  # results that a task holds at once, besides their Arrow batch


def compact_json(*columns: str | Column) -> Column:
    """One row as JSON without spaces; null fields are written as null."""
    return F.to_json(F.struct(*columns), {"ignoreNullFields": "false"})


def write_jsonl(df: DataFrame, path: str) -> None:
    """Rows as JSON Lines, replacing what was there."""
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def append_jsonl(df: DataFrame, path: str) -> None:
    """Rows appended; a task's rows appear once it has succeeded."""
    df.write.mode("append").json(path, ignoreNullFields=False)


def write_manifests(candidates: DataFrame, groups: DataFrame, errors: DataFrame, folder: str) -> None:
    for name, df in (("candidates", candidates), ("groups", groups), ("errors", errors)):
        write_jsonl(df, f"{folder}/{name}")


def write_shards(df: DataFrame, folder: str) -> None:
    """One folder per ``shard_id``; shards of an earlier, larger run go."""
    df.repartition("shard_id").write.mode("overwrite").partitionBy("shard_id").json(folder, ignoreNullFields=False)


def result_json(results: DataFrame) -> DataFrame:
    """Each result as JSON: ``wer`` is written even if null, ``error`` only if there is one."""
    whole = "ignoreNullFields", "false"
    good = lambda x: F.struct(x["candidate"].alias("candidate"), x["wer"].alias("wer"), x["transcript"].alias("transcript"), x["audio"].alias("audio"))
    bad = lambda x: F.struct(*(x[c].alias(c) for c in ("candidate", "wer", "transcript", "audio", "error")))
    options = dict([whole])
    detail = F.transform("detail", lambda x: F.when(x["error"].isNull(), F.to_json(good(x), options)).otherwise(F.to_json(bad(x), options)))
    head = F.to_json(F.struct("id", "text", "best_candidate"), options)
    return results.select(F.concat(F.substring(head, F.lit(1), F.length(head) - 1), F.lit(',"detail":['), F.array_join(detail, ","), F.lit("]}")).alias("value"))


def _parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, TOGETHER):
            yield batch.slice(at, TOGETHER)


def rendered(results: DataFrame) -> DataFrame:
    """Each result as it stands in the document, a comma before it; in order of the records, if they are numbered."""

    def render(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _parts(batches):
            bodies = [json.dumps(json.loads(x), ensure_ascii=False, indent=2).replace("\n", "\n    ") for x in part.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([",\n    " + b for b in bodies], pa.string())], ["value"])

    ordered = results.sort("record_index") if "record_index" in results.columns else results
    return result_json(ordered).mapInArrow(render, "value string")


def write_document(results: DataFrame, missing: int, path: str) -> None:
    """One indented JSON document with all results, in a folder that driver and executors share.

    Results are rendered and written down once; the lengths of their partitions say where each one's part
    begins, and all tasks write their parts of the file at the same time.  A task that is repeated writes the same bytes to the
    same place, and the file takes its name when it is whole.
    """
    head, tail = b'{\n  "results": [', f'],\n  "missing_labels": {int(missing)}\n}}\n'.encode()
    pieces = checkpointed(rendered(results))
    sizes = {r.p: r.n for r in pieces.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(F.octet_length("value")).cast("long").alias("n")).collect()}
    at, begins = len(head) - 1, {}  # no comma before the first result: the head is written over it
    for p in sorted(sizes):
        begins[p] = at
        at += sizes[p]
    tail = (b"\n  " if sizes else b"") + tail
    at += not sizes
    unfinished = f"{path}.{uuid.uuid4().hex}"

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = 0
        with open(unfinished, "r+b") as f:
            f.seek(begins.get(TaskContext.get().partitionId(), 0))
            for part in _parts(batches):
                n += f.write("".join(part.column(0).to_pylist()).encode("utf-8"))
            f.flush()
            os.fsync(f.fileno())
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64())], ["n"])

    try:
        open(unfinished, "wb").close()
        done = pieces.mapInArrow(put, "n long").agg(F.sum("n")).first()[0] or 0
        if done != sum(sizes.values()):
            raise RuntimeError(f"{path}: {done} bytes written of {sum(sizes.values())}")
        with open(unfinished, "r+b") as f:
            f.write(head)
            f.seek(at)
            f.write(tail)
        os.replace(unfinished, path)
    finally:
        if os.path.exists(unfinished):
            os.remove(unfinished)


def read_document(spark: SparkSession, path: str) -> tuple[DataFrame, int]:
    """A document of ``write_document``: its results (result variant), one row each, and its number of missing labels.

    Only between two results a line begins with four spaces and a bracket, as strings hold no line ends. So the file is
    read by a task for each of its splits, and no task holds more than a result at a time.  A document without its end stops the run.
    """
    end = r'(?s)\],\n  "missing_labels": (\d+)\n\}\n?\z'
    rows = spark.read.text(literal(path), lineSep="\n    {")
    ends = rows.where(F.col("value").rlike(end)).select(F.regexp_extract("value", end, 1).cast("long")).take(2)
    if len(ends) != 1:
        raise ValueError(f"{path} is no whole document of results")
    body = F.regexp_replace(F.regexp_replace("value", end, ""), r"[\s,]+\z", "")
    return rows.where(~F.col("value").startswith('{\n  "results": [')).select(F.parse_json(F.concat(F.lit("{"), body)).alias("result")), ends[0][0]
