"""Labels as a stream: new manifest files are transcribed as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from takepick.operators.shard import KEY
from takepick.operators.transcribe import Transcriber, label_batch
from takepick.schemas import CANDIDATE, LABEL
from takepick.sources.listing import make_file, matching

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
MADE = ["asr_text", "language", "error", "asr_extra"]


class Labeler(StatefulProcessor):
    """Transcribes a bucket's rows whose key has no successful label yet.

    Its state holds of each key the number of its last label and whether one was
    successful, and the bucket's next number.  State and labels of a micro-batch are committed
    together, so a batch that is repeated after a failure begins where it began before.
    """

    def __init__(self, make: Callable[[], Transcriber], batch_size: int, language: str | None, context: str, isolate: bool):
        self.make, self.batch_size, self.how, self.model = make, batch_size, (language, context, isolate), None

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.known = handle.getMapState("known", "id string, candidate_index int", "seq long, done boolean")
        self.next = handle.getValueState("next", "seq long")

    def handleInitialState(self, key: tuple, rows: pd.DataFrame, timers: object) -> None:
        for r in rows.itertuples():
            self.known.updateValue((r.id, int(r.candidate_index)), (int(r.seq), bool(r.done)))
        self.next.update((int(rows["seq"].max()) + 1,))

    def _done(self, key: tuple) -> bool:
        return self.known.containsKey(key) and self.known.getValue(key)[1]

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timers: object) -> Iterator[pd.DataFrame]:
        seq = self.next.get()[0] if self.next.exists() else 0
        for part in rows:
            waiting, asked = [], set()
            for row in part[[f.split()[0] for f in CANDIDATE.split(", ")]].to_dict("records"):
                mine = None if row["id"] is None or pd.isna(row["candidate_index"]) else (row["id"], int(row["candidate_index"]))
                if mine is not None and (mine in asked or self._done(mine)):
                    continue
                asked.add(mine)
                waiting.append((mine, row))
            out = []
            for at in range(0, len(waiting), self.batch_size):
                batch = waiting[at : at + self.batch_size]
                self.model = self.model or self.make()
                for (mine, row), label in zip(batch, label_batch(self.model, [r["audio"] for _, r in batch], *self.how)):
                    out.append(row | dict(zip(MADE, label)) | {"seq": seq})
                    if mine is not None:
                        self.known.updateValue(mine, (seq, label[MADE.index("error")] is None))
                    seq += 1
            if out:
                yield pd.DataFrame(out)
        self.next.update((seq,))


def _buckets(spark: SparkSession, checkpoint: str, wanted: int) -> int:
    """The number of buckets that a checkpoint was begun with; keys must stay where their state is."""
    there = matching(spark, f"{checkpoint}/buckets-*")
    if there:
        return int(there[0].rsplit("-", 1)[1])
    make_file(spark, f"{checkpoint}/buckets-{wanted}")
    return wanted


def stream_labels(
    spark: SparkSession,
    manifests: str,
    labels: str,
    checkpoint: str,
    make: Callable[[], Transcriber],
    batch_size: int = 8,
    buckets: int = 64,
    language: str | None = None,
    context: str = "",
    isolate: bool = False,
    known: DataFrame | None = None,
) -> StreamingQuery:
    """Follow a folder of JSON Lines manifests until it holds nothing new, adding labels to a folder of Parquet files.

    A key without a successful label is labeled, once in a micro-batch; rows without a key always are.  What was labeled before is
    in the query's state, which is kept by bucket of keys in a store beside the checkpoint: no label is read again.
    ``known`` are labels made elsewhere, taken over when a checkpoint begins.  ``seq`` grows with each label of a key.
    The folder of labels is the stream's own; each label is there once, whatever was repeated.  ``buckets`` bounds the tasks that
    transcribe; a checkpoint keeps the number it began with.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be > 0")
    n = _buckets(spark, checkpoint, buckets)
    bucket = F.pmod(F.xxhash64(*KEY), F.lit(n)).cast("int").alias("bucket")
    source = spark.readStream.schema(CANDIDATE).json(manifests).select("*", bucket)
    if known is None:
        known = spark.createDataFrame([], LABEL)
    before = known.where("id is not null and candidate_index is not null").groupBy(*KEY).agg(F.max("seq").alias("seq"), F.bool_or(F.col("error").isNull()).alias("done"))
    store = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)  # read when the query starts
    try:
        made = source.groupBy("bucket").transformWithStateInPandas(
            Labeler(make, batch_size, language, context, isolate), LABEL, "append", "none", before.select("*", bucket).groupBy("bucket")
        )
        return made.writeStream.format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(labels)
    finally:
        spark.conf.unset(PROVIDER) if store is None else spark.conf.set(PROVIDER, store)
