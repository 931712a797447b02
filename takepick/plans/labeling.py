"""A labeling run: prepare, transcribe, collect; each can be run again by itself."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from takepick.config import LabelingConfig
from takepick.operators import collect, prepare, shard
from takepick.operators.transcribe import Transcriber, transcribe
from takepick.plans.jobs import ENDED, run_tagged
from takepick.plans.progress import Progress
from takepick.sources.audio_files import not_yet_written, write_candidate_audio
from takepick.sources.label_store import LabelStore
from takepick.sources.listing import expand_paths
from takepick.sources.records import read_records
from takepick.sources.shared import checkpointed, delete
from takepick.sources.sinks import write_document


class LabelingRun:
    """State of a run below ``folder``, a file system that driver and executors share."""

    def __init__(self, spark: SparkSession, folder: str, config: LabelingConfig = LabelingConfig()):
        self.spark, self.folder, self.config = spark, os.path.abspath(folder), config
        self.store = LabelStore(spark, self._path("labels"))

    def _path(self, name: str) -> str:
        return f"{self.folder}/{name}"

    def _marked(self, name: str) -> bool:
        """Whether the mark is there, of the same settings."""
        mark = self._path(name)
        if not os.path.exists(mark):
            return False
        with open(mark, encoding="utf-8") as f:
            return f.read() == self.config.fingerprint()

    def _mark(self, name: str) -> None:
        os.makedirs(self.folder, exist_ok=True)
        with open(self._path(name), "w", encoding="utf-8") as f:
            f.write(self.config.fingerprint())

    def prepared(self) -> bool:
        """Whether manifests of the same settings are there."""
        return self._marked("fingerprint")

    def prepare(self, inputs: list[str]) -> dict[str, int]:
        """Read, validate and write groups, candidates and errors, and each candidate's WAV.

        Recordings that a run of the same settings has written before, even one
        that was cut short, are kept; those of other settings go first.
        """
        files = expand_paths(self.spark, inputs)
        if not files:
            raise FileNotFoundError("no input files")
        valid = prepare.validate(read_records(self.spark, files), self.config)
        with Progress(self.spark, "validation") as progress:
            progress.watch(valid, F.col("error").isNotNull()).write.mode("overwrite").parquet(self._path("validated"))
        progress.done()
        valid = self.spark.read.parquet(self._path("validated"))
        wavs = self._path("prepared_audio")
        rows = prepare.candidates(valid, wavs)
        if self.config.overwrite_audio or not self._marked("audio"):
            delete(self.spark, wavs)
            self._mark("audio")
        made = write_candidate_audio(not_yet_written(rows), self.config.sample_rate, self.config.gap_ms, self.config.resample)
        made = checkpointed(made.select("record_index", "id", "source_json", "candidate_index", "error"))
        # a record with a candidate that can't be built is an error as a whole: its first one
        failed = made.where("error is not null").groupBy("record_index", "id", "source_json").agg(F.min_by("error", "candidate_index").alias("error"))
        good = valid.where("error is null").join(failed, "record_index", "left_anti")
        prepare.groups(good, wavs).write.mode("overwrite").parquet(self._path("groups"))
        sharded = shard.round_robin(prepare.candidates(good, wavs).drop("audio_paths"), self.config.workers, ["record_index", "candidate_index"])
        sharded.write.mode("overwrite").partitionBy("shard_id").parquet(self._path("manifest"))
        prepare.errors(valid).unionByName(failed.drop("record_index")).write.mode("overwrite").parquet(self._path("errors"))
        self._mark("fingerprint")
        counts = {n: self.spark.read.parquet(self._path(n)).count() for n in ("groups", "manifest", "errors")}
        if not counts["manifest"]:
            raise RuntimeError("no candidate could be prepared")
        return counts

    def manifest(self) -> DataFrame:
        return self.spark.read.parquet(self._path("manifest"))

    def labels(self) -> DataFrame:
        return self.store.labels()

    def status(self) -> DataFrame:
        return shard.shard_status(self.manifest(), self.labels())

    def transcribe(self, make: Callable[[], Transcriber], **how) -> int:
        """Label what has no successful label yet; returns how many rows were labeled.

        Labels are appended with a sequence number above all before, so the last
        label of a key is well defined and a run that was cut short is repeated
        without harm.  Labels are summed up by key first, so that none is read
        twice to find what remains.
        """
        c = self.config
        self.store.compact()
        todo = self.store.todo(self.manifest(), c.overwrite_labels)
        n = todo.count()
        if not n:
            return 0
        made = transcribe(todo.repartition(min(c.workers, n)).drop("shard_id", "position", "record_index"), make, c.batch_size, c.language, c.context, **how)
        with Progress(self.spark, "labels") as progress:
            self.store.append(progress.watch(made, F.col("error").isNotNull()), self.store.begin())
        progress.done()
        return n

    def transcribe_shards(self, make: Callable[[], Transcriber], concurrent: int = 4, **how) -> dict[int, tuple[str, str | None]]:
        """Label the shards with remaining work, each by a job of its own; (state, error) of every such shard.

        ``concurrent`` shards run at a time.  A shard that fails, say because its model can't be loaded, leaves
        no label; it cancels those that run and keeps the rest from beginning.  Labels of shards that ended stay.
        """
        c = self.config
        start = self.store.begin()
        self.store.compact()
        todo = checkpointed(self.store.todo(self.manifest(), c.overwrite_labels))

        def label(number: int) -> Callable[[], None]:
            def run() -> None:
                rows = todo.where(F.col("shard_id") == number).coalesce(1).drop("shard_id", "position", "record_index")
                made = transcribe(rows, make, c.batch_size, c.language, c.context, **how)
                self.store.append(made, start, number)

            return run

        shards = sorted(r.shard_id for r in todo.select("shard_id").distinct().collect())  # no more than there are workers
        return run_tagged(self.spark, {n: label(n) for n in shards}, concurrent)

    def scored(self) -> DataFrame:
        return collect.score(self.spark.read.parquet(self._path("groups")), self.labels(), self.config.normalize, self.config.tokenizer)

    def collect(self, document: str | None = None) -> DataFrame:
        """Results, one row per record; with ``document`` also the JSON file."""
        scored = self.scored().persist()
        try:
            out = collect.results(scored)
            out.write.mode("overwrite").parquet(self._path("results"))
            out = self.spark.read.parquet(self._path("results"))
            if document:
                write_document(out, collect.missing_labels(scored).first()[0], document)
            return out
        finally:
            scored.unpersist()

    def run(self, inputs: list[str], make: Callable[[], Transcriber], document: str | None = None, concurrent: int = 0) -> DataFrame:
        """All three stages.  With ``concurrent`` each shard is a job of its own, and a failed one stops the run before collection."""
        if not self.prepared() or self.config.overwrite_audio:
            self.prepare(inputs)
        if not concurrent:
            self.transcribe(make)
        elif failed := {n: e for n, (state, e) in self.transcribe_shards(make, concurrent).items() if state != ENDED}:
            raise RuntimeError(f"{len(failed)} shards did not end: " + "; ".join(f"{n}: {e or 'not begun'}" for n, e in failed.items()))
        return self.collect(document)
