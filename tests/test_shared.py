"""Checkpoints of ours go with their last reference; those of others stay."""

import gc
import os
import time

from takepick.sources.shared import CLEAN, checkpointed, delete, shared_dir, written


def files(folder):
    return {os.path.join(d, n) for d, _, names in os.walk(folder) for n in names}


def test_checkpoints_go_with_the_last_reference(spark):
    folder = shared_dir(spark).removeprefix("file:")
    before = files(folder)
    conf = spark.sparkContext._jsc.sc().conf()
    theirs = spark.range(10).checkpoint(eager=True)
    kept = files(folder) - before
    ours = checkpointed(spark.range(100)).where("id >= 50")
    made = files(folder) - before - kept
    assert kept and made and conf.get(CLEAN, None) is None
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    assert ours.count() == 50
    del ours
    for _ in range(60):
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        if not files(folder) & made:
            break
        time.sleep(0.5)
    assert not files(folder) & made and files(folder) >= kept and theirs.count() == 10


def test_written_and_deleted_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    assert not written(spark, path)
    spark.range(3).write.parquet(path)
    assert written(spark, path)
    delete(spark, path)
    delete(spark, path)
    assert not os.path.exists(path)
