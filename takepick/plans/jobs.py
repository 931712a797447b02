"""Several pieces of work as Spark jobs side by side; if one fails, the others are stopped."""

from __future__ import annotations

import threading
import uuid
from collections.abc import Callable, Hashable
from concurrent.futures import ThreadPoolExecutor
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

ENDED, FAILED, CANCELLED, NOT_BEGUN = "ended", "failed", "cancelled", "not begun"


def run_tagged(spark: SparkSession, work: dict[Hashable, Callable[[], Any]], concurrent: int = 4) -> dict[Hashable, tuple[str, str | None]]:
    """(state, error) of every piece of work, by its name.

    ``concurrent`` pieces run at a time, begun in order.  All their Spark jobs carry one tag: when a piece fails, the jobs
    of those that run are cancelled, and the rest doesn't begin.  Nothing is raised here.
    """
    if concurrent <= 0:
        raise ValueError("concurrent must be > 0")
    sc, tag = spark.sparkContext, f"takepick-{uuid.uuid4().hex}"
    out: dict[Hashable, tuple[str, str | None]] = {name: (NOT_BEGUN, None) for name in work}
    stopped, lock = threading.Event(), threading.Lock()

    def run(name: Hashable) -> None:
        with lock:
            if stopped.is_set():
                return
        sc.addJobTag(tag)
        try:
            work[name]()
            out[name] = ENDED, None
        except BaseException as e:
            with lock:
                out[name] = (CANCELLED if stopped.is_set() else FAILED), f"{type(e).__name__}: {e}".splitlines()[0]
                stopped.set()
            sc.cancelJobsWithTag(tag)
        finally:
            sc.removeJobTag(tag)

    with ThreadPoolExecutor(concurrent) as pool:
        for name in work:
            pool.submit(inheritable_thread_target(spark)(run), name)
    return out
