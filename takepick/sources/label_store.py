"""Labels in batches, and what they say of every key in buckets, so that remaining work is found without reading them again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from takepick.operators.shard import KEY, succeeded
from takepick.schemas import LABEL
from takepick.sources.listing import inside
from takepick.sources.shared import delete, written

KEYS = "id string, candidate_index int, seq long, done boolean"


class LabelStore:
    """Labels of one run below ``folder``, on any file system that Spark knows; one driver writes at a time.

    ``batches/<first>-<part>`` holds the labels of one write, numbered (``seq``) from ``first`` on, so batches are in order of
    their names.  ``keys/<first>-<buckets>`` sums up all batches up to that one: a row for each key with its last number and whether any of its
    labels was a success, in buckets by key.  Only what was written to its end counts, and a write that was cut short is made again.
    Labels without an id or a candidate are stored, but are of no key.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int | None = None):
        if buckets is not None and buckets <= 0:
            raise ValueError("buckets must be > 0")
        if set(folder) & set("*?[]{}"):
            raise ValueError(f"a table can't lie in a folder with signs of a pattern: {folder}")
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets

    def _whole(self, kind: str) -> list[tuple[int, int, str]]:
        """(first number, part or buckets, path) of what was written to its end, in order."""
        paths = [p for p in inside(self.spark, f"{self.folder}/{kind}") if written(self.spark, p)]
        return sorted((*map(int, p.rsplit("/", 1)[1].split("-")), p) for p in paths)

    def _read(self, batches: list[tuple[int, int, str]]) -> DataFrame:
        return self.spark.read.schema(LABEL).parquet(*(p for _, _, p in batches)) if batches else self.spark.createDataFrame([], LABEL)

    def labels(self) -> DataFrame:
        return self._read(self._whole("batches"))

    def begin(self) -> int:
        """The first number for new labels, above all that are there; only the last batch's numbers are read."""
        batches = self._whole("batches")
        if not batches:
            return 1
        first = batches[-1][0]
        last = self._read([b for b in batches if b[0] == first]).agg(F.max("seq")).first()[0]
        return max(first, last or 0) + 1

    def append(self, made: DataFrame, first: int, part: int = 0) -> None:
        """Labels (``LABEL`` without ``seq``) as one batch; several parts may be written at a time under one first number."""
        numbered = made.withColumn("seq", F.lit(first) + F.monotonically_increasing_id())
        numbered.write.mode("overwrite").parquet(f"{self.folder}/batches/{first:019d}-{part:05d}")

    def _bucketed(self) -> tuple[int, DataFrame | None]:
        """The first number of the last batch that the keys sum up, and the keys; (-1, None) if there are none."""
        there = self._whole("keys")
        if not there:
            return -1, None
        first, buckets, path = there[-1]
        name, place = f"takepick_keys_{uuid.uuid4().hex}", path.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(f"CREATE TABLE {name} ({KEYS}) USING parquet CLUSTERED BY ({', '.join(KEY)}) INTO {buckets} BUCKETS LOCATION '{place}'")
        try:
            return first, self.spark.table(name)
        finally:
            self.spark.sql(f"DROP TABLE {name}")  # the files stay, and the rows that are read from them

    def _later(self, first: int) -> DataFrame | None:
        later = [b for b in self._whole("batches") if b[0] > first]
        return self._read(later) if later else None

    def compact(self) -> bool:
        """Sum up the batches that the keys don't hold yet; whether there were any.

        New labels are added up by key and joined to the buckets, which stay where they are: nothing but the new keys is
        shuffled.  The keys before are kept until the next time, for those who still read them.
        """
        covered, before = self._bucketed()
        later = self._later(covered)
        if later is None:
            return False
        first = self._whole("batches")[-1][0]
        fresh = later.where("id is not null and candidate_index is not null").groupBy(*KEY).agg(F.max("seq").alias("seq"), F.bool_or(F.col("error").isNull()).alias("done"))
        if before is None:
            buckets = self.buckets or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            keys = fresh.repartition(buckets, *KEY)
        else:
            buckets = self._whole("keys")[-1][1]
            new = fresh.withColumnsRenamed({"seq": "new_seq", "done": "new_done"})
            known = lambda c: F.coalesce(c, F.lit(False))
            keys = before.join(new, KEY, "full_outer").select(*KEY, F.greatest("seq", "new_seq").alias("seq"), (known(F.col("done")) | known(F.col("new_done"))).alias("done"))
        old = self._whole("keys")
        name = f"takepick_keys_{uuid.uuid4().hex}"
        try:
            keys.write.mode("overwrite").bucketBy(buckets, *KEY).sortBy(*KEY).option("path", f"{self.folder}/keys/{first:019d}-{buckets}").saveAsTable(name)
        finally:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        for _, _, path in old[:-1]:
            delete(self.spark, path)
        return True

    def todo(self, manifest: DataFrame, overwrite: bool = False) -> DataFrame:
        """Manifest rows whose key has no successful label; of labels only those after the last ``compact`` are read.

        The buckets of keys aren't shuffled where there are at least as many as ``spark.sql.shuffle.partitions``.
        """
        if overwrite:
            return manifest
        covered, keys = self._bucketed()
        later = self._later(covered)
        if keys is not None:
            manifest = manifest.join(keys.where("done").select(*KEY), KEY, "left_anti")
        return manifest if later is None else manifest.join(succeeded(later), KEY, "left_anti")

    def last(self) -> DataFrame:
        """(id, candidate_index, seq, done) of every key, all batches included."""
        self.compact()
        keys = self._bucketed()[1]
        return self.spark.createDataFrame([], KEYS) if keys is None else keys
