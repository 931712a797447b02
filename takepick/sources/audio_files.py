"""Audio files: read beside their rows, concatenated, written."""

from __future__ import annotations

import os
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from takepick.functions.audio import concat_files


def write_candidate_audio(candidates: DataFrame, sample_rate: int, gap_ms: float = 0.0, method: str = "polyphase") -> DataFrame:
    """Write each candidate's clips (``audio_paths``) as one WAV to its path ``audio``; the rows, and ``error`` where that fails.

    Clips are read, resampled and written piece by piece, so the memory of a task doesn't depend on how long they are.
    Files lie in a file system that all executors share.  A file gets its name once it is whole, so a repeated task is
    harmless; one that is there is written anew.
    """
    schema = StructType([*candidates.schema.fields, StructField("error", StringType())])

    def one(paths: list[str], path: str) -> str | None:
        part = f"{path}.{uuid.uuid4().hex}.part"
        try:
            for p in paths:
                if not os.path.exists(p):
                    raise FileNotFoundError(p)
            os.makedirs(os.path.dirname(path), exist_ok=True)
            with open(part, "wb") as out:
                concat_files(list(paths), out, sample_rate, gap_ms, method)
            os.replace(part, path)
        except Exception as e:
            if os.path.exists(part):
                os.remove(part)
            return f"{type(e).__name__}: {e}"

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf.assign(error=[one(paths, path) for paths, path in zip(pdf["audio_paths"], pdf["audio"])])

    return candidates.mapInPandas(run, schema)


def write_wavs(rows: DataFrame, path_col: str = "audio", data_col: str = "wav", overwrite: bool = False) -> DataFrame:
    """Write each row's bytes to its path (a file system that all executors share); the rows without the bytes, and ``written``.

    A file gets its name once it is whole, so a repeated task is harmless; an
    existing one is kept unless ``overwrite``, and null bytes make none.
    """
    kept = [f for f in rows.schema.fields if f.name != data_col]
    schema = StructType([*kept, StructField("written", BooleanType())])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            written = []
            for path, data in zip(pdf[path_col], pdf[data_col]):
                if data is None or not overwrite and os.path.exists(path):
                    written.append(False)
                    continue
                os.makedirs(os.path.dirname(path), exist_ok=True)
                part = f"{path}.{os.getpid()}.part"
                with open(part, "wb") as f:
                    f.write(data)
                os.replace(part, path)
                written.append(True)
            yield pdf.drop(columns=data_col).assign(written=written)

    return rows.mapInPandas(run, schema)


def read_audio(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(path, content) of whole files by Spark's own reader, for stores that only Spark reaches."""
    return spark.read.format("binaryFile").load(paths).select("path", "content")


def not_yet_written(candidates: DataFrame) -> DataFrame:
    """Candidates whose WAV is still to be made."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pdf[[not os.path.exists(p) for p in pdf["audio"]]]

    return candidates.mapInPandas(run, candidates.schema)
