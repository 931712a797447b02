"""A corpus from raw documents to packed sequences; each stage is one operator of ``takepick.llm``.

A stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as
Parquet and read again as the next one's ``docs``.  All but the last return the
columns of ``documents``; those that change a text set ``n_chars`` anew.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from takepick.llm.common import fresh
from takepick.llm.line_dedup import dedup_lines, duplicate_lines
from takepick.llm.minhash import near_duplicates
from takepick.llm.packing import pack
from takepick.llm.substring_dedup import dedup_substrings, duplicate_spans
from takepick.llm.tokens import default_tokenizer
from takepick.llm.toxicity import fit_toxicity, score_toxicity
from takepick.sources.shared import checkpointed, delete, shared_dir, written


def _measured(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go; labels of the held-out fold are not learned from."""
    model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    own = {c: fresh(docs, c)[0] for c in docs.columns if c.lower() in ("score", "predicted")}  # columns of the documents, not the score's
    renamed = docs.withColumnsRenamed(own)
    kept = score_toxicity(renamed, model).where("predicted = 0").select(*renamed.columns)
    return kept.withColumnsRenamed({name: c for c, name in own.items()})


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Blocks of lines that an earlier document holds are deleted; every document stays."""
    return _measured(dedup_lines(docs, duplicate_lines(docs)))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of linked documents (shingles of five words, similarity of 0.8 or more) the one of least id stays, one row of it."""
    k, h = fresh(docs, "tp_id", "tp_hash")
    rows = near_duplicates(docs, shingle=5, percent=80).groupBy(F.col("doc_id").alias(k), F.col("text_hash").alias(h))
    gone = rows.agg(F.min("first").alias("all"), F.max("first").alias("any")).where("not all")

    def same(keys: DataFrame) -> Column:
        return docs["doc_id"].eqNullSafe(keys[k]) & (F.xxhash64(F.coalesce(docs["text"], F.lit(""))) == keys[h])

    left = docs.join(gone, same(gone), "left_anti")
    repeated = gone.where("any")  # the row that stays has others of its id and text
    if repeated.isEmpty():
        return left
    return left.unionAll(docs.join(repeated, same(repeated), "left_semi").dropDuplicates(["doc_id", "text"]))


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans whose original is elsewhere are cut out; every document stays."""
    return _measured(dedup_substrings(docs, duplicate_spans(docs)))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 2048 tokens without padding, one row per piece, with its token ids."""
    return pack(docs, default_tokenizer())


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("packing", packing),
]

#: Learned scores, alignment, sketches and token ids are beyond SQL: tests compare each stage with brute force.
ORACLE_SQL = None


def made_of(spark: SparkSession, sf_dir: str) -> str:
    """What a run's tables depend on: the stages, and name, size and time of every input file."""
    said = [name for name, _ in STAGES]
    for table in ("documents", "labels"):
        files = spark.read.format("binaryFile").load(f"{sf_dir}/{table}.parquet")
        said += map(str, files.agg(F.count(F.lit(1)), F.sum(F.xxhash64("path", "modificationTime", "length").cast("decimal(38,0)"))).first())
    return "; ".join(said)


def run(spark: SparkSession, sf_dir: str, folder: str | None = None) -> DataFrame:
    """All stages over ``documents``, each written down before the next.

    ``folder`` keeps the stages' tables, and a run that finds whole ones there, made of the same input by the
    same stages, goes on after them; others go.  Without it they are in the shared folder, and each goes
    once the next is there, or when the run fails.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    base = folder or f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    if folder:
        mine, mark = made_of(spark, sf_dir), f"{folder}/made_of"
        if not written(spark, mark) or spark.read.text(mark).first()[0] != mine:
            delete(spark, folder)
            spark.createDataFrame([(mine,)], "value string").coalesce(1).write.text(mark)
    try:
        for n, (_, stage) in enumerate(STAGES):
            path = f"{base}/{n}"
            if not written(spark, path):
                stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
            docs = spark.read.parquet(path)
            if n and not folder:
                delete(spark, f"{base}/{n - 1}")
        return docs if folder else checkpointed(docs)
    finally:
        if not folder:
            delete(spark, base)
