"""How far a run is and how fast: rows written so far, looked at while a stage runs, and exact counts when it ends."""

from __future__ import annotations

import logging
import threading
import time
import uuid

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger("takepick")
SHORTEST = 0.001  # fixed value: seconds that a rate is taken over at the least


def rate(completed: Column, seconds: Column) -> Column:
    """Rows a second."""
    return completed / F.greatest(F.lit(SHORTEST), seconds)


class Progress:
    """Counts of a stage: ``watch`` a table, write it within ``with progress:``, then ``done``.

    The block's Spark jobs carry a tag.  Every ``interval`` seconds a thread of the driver asks Spark's status for the rows that
    they have written so far, logs them, and notes how many the interval added.  No row takes another way for
    it.  Spark counts while tasks run, a repeated task again; so the last interval makes up for the difference to the exact counts.
    """

    def __init__(self, spark: SparkSession, stage: str, interval: float = 10.0):
        if interval <= 0:
            raise ValueError("interval must be > 0")
        self.spark, self.stage, self.interval = spark, stage, interval
        self.start, self.seen, self.tag = time.monotonic(), Observation(f"progress {stage} {uuid.uuid4().hex}"), f"takepick-progress-{uuid.uuid4().hex}"
        self.intervals: list[tuple[float, int]] = []  # seconds since the start, rows since the last one
        self._over = threading.Event()

    def watch(self, rows: DataFrame, failed: Column) -> DataFrame:
        return rows.observe(self.seen, F.count(F.lit(1)).alias("completed"), F.count_if(failed).alias("failed"))

    def _written(self) -> int:
        """Rows that the stages of the block's jobs have written so far."""
        sc = self.spark.sparkContext._jsc.sc()
        total = 0
        for job in sc.statusTracker().getJobIdsForTag(self.tag):
            info = sc.statusTracker().getJobInfo(job)
            for stage in info.get().stageIds() if info.isDefined() else ():
                if sc.statusTracker().getStageInfo(stage).isDefined():  # else it hasn't begun, or was skipped
                    total += sc.statusStore().lastStageAttempt(stage).outputRecords()
        return total

    def _look(self) -> None:
        total = 0
        while not self._over.wait(self.interval):
            try:
                now = self._written()
            except Exception as e:  # progress must not end a run
                log.debug("%s: no status: %s", self.stage, e)
                continue
            seconds = max(SHORTEST, time.monotonic() - self.start)
            self.intervals.append((seconds, max(0, now - total)))
            total = max(total, now)
            log.info("%s: %d rows so far, %.1f s, %.2f rows a second", self.stage, total, seconds, total / seconds)

    def __enter__(self) -> "Progress":
        self.start = time.monotonic()
        self.spark.sparkContext.addJobTag(self.tag)
        self._thread = threading.Thread(target=inheritable_thread_target(self.spark)(self._look), daemon=True)
        self._thread.start()
        return self

    def __exit__(self, *_: object) -> None:
        self._over.set()
        self._thread.join()
        self.spark.sparkContext.removeJobTag(self.tag)

    def done(self) -> dict[str, float]:
        seconds = max(SHORTEST, time.monotonic() - self.start)
        counts = self.seen.get
        left = counts["completed"] - sum(n for _, n in self.intervals)
        self.intervals.append((seconds, max(0, left)))
        for i in range(len(self.intervals) - 2, -1, -1):  # rows of repeated tasks
            if left >= 0:
                break
            at, n = self.intervals[i]
            self.intervals[i] = at, max(0, n + left)
            left += n
        out = {"completed": counts["completed"], "failed": counts["failed"], "seconds": seconds, "rate": counts["completed"] / seconds}
        log.info("%s: %d rows, %d failed, %.1f s, %.2f rows a second", self.stage, *out.values())
        return out
