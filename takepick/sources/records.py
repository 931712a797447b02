"""Record sources: JSON arrays and JSON Lines of any file system that Spark knows, label logs."""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from takepick.functions.text import py_strip
from takepick.sources import json_arrays
from takepick.sources.json_arrays import HEAD
from takepick.sources.listing import exists, literal, matching, pin_splits, resolved
from takepick.sources.shared import checkpointed


def _file() -> Column:
    """A row's file: a local one's path, any other's URL."""
    return F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), r"\Afile:/+", "/")


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """Lines that are not blank, with their file, split and row."""
    rows = spark.read.text([literal(p) for p in paths]).select(py_strip(F.col("value")).alias("value"), _file().alias("file"), F.col("_metadata.file_block_start").alias("block"))
    return rows.where("value <> ''").withColumn("row", F.monotonically_increasing_id())


def _line_splits(lines: DataFrame) -> DataFrame:
    """A row for each split: file, block, first row, number of rows, and the form that its first line speaks for."""
    head = F.substring("value", 1, HEAD)
    kind = F.when(head.startswith("["), "array").when((F.length("value") <= HEAD) & F.try_parse_json("value").isNull(), "object").otherwise("lines")
    return checkpointed(lines.groupBy("file", "block").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n"), F.min_by(kind, "row").alias("kind")))


def _numbered(lines: DataFrame, splits: DataFrame, bases: DataFrame) -> DataFrame:
    """Lines with ``n``, their position from the base of their file on.

    Only one row for each split is gathered; no line is sorted or shuffled.
    """
    before = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = splits.select("file", "block", "first", before.alias("before")).join(bases, "file")
    placed = placed.select("file", "block", (F.col("base") + F.col("before") - F.col("first")).alias("shift"))
    joined = lines.join(F.broadcast(placed), ["file", "block"], "left")  # some 100 bytes for each split of the input
    changed = F.raise_error(F.lit("a file was cut otherwise before: its size or Spark's settings have changed")).cast("long")
    return joined.withColumn("n", F.when(F.col("shift").isNull(), changed).otherwise(F.col("row") + F.col("shift")))


def _bases(spark: SparkSession, paths: list[str], counts: DataFrame) -> DataFrame:
    """(file, base): how many records the files before each one hold, in the order of ``paths``."""
    rank = spark.createDataFrame(list(enumerate(paths)), "rank long, file string")
    before = F.coalesce(F.sum("n").over(Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return checkpointed(counts.groupBy("file").agg(F.sum("n").alias("n")).join(rank, "file").select("file", before.cast("long").alias("base")))


def _object(value: Column, message: str) -> Column:
    """The JSON object that a text is as a whole; the parser by itself would take what begins with one."""
    framed = F.parse_json(F.concat(F.lit('{"value":'), value, F.lit(',"_end":0}')))
    v = F.variant_get(framed, "$.value", "variant")
    whole = F.coalesce(F.variant_get(framed, "$._end", "int") == 0, F.lit(False)) & F.schema_of_variant(v).startswith("OBJECT")
    return F.when(whole, v).otherwise(F.raise_error(F.lit(message)).cast("variant"))


def _kinds(splits: DataFrame) -> dict[str, str]:
    """The form of each file, told by its first split: one short row a file."""
    return {r.file: r.kind for r in splits.groupBy("file").agg(F.min_by("kind", "block").alias("kind")).collect()}


def read_records(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(record_index, source_json, record): all records of all files, in order.

    The form of each file is told from its start, where it is read: files named ``.jsonl`` first as lines, others
    first as arrays, and those of another form once more.  Every record must be an object; a bad line,
    item or a missing file stops the run.  Lines and arrays are read by as many tasks as a file has splits, a
    file that is one object by one.
    """
    paths = list(dict.fromkeys(resolved(spark, p) for p in paths))
    pin_splits(spark)
    named = [p for p in paths if p.endswith(".jsonl")]
    other = [p for p in paths if not p.endswith(".jsonl")]
    try:
        lines = _line_splits(_lines(spark, named)) if named else None
        arrays = json_arrays.describe(spark, other, _file()) if other else None
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            raise FileNotFoundError(str(e)) from None
        raise
    kinds = {f: k for found in (lines, arrays) if found for f, k in _kinds(found).items()}
    of = {kind: [p for p in paths if kinds.get(p) == kind] for kind in ("lines", "array", "object")}
    # how files are cut depends on all that are read together
    if of["lines"] and of["lines"] != named:
        lines = _line_splits(_lines(spark, of["lines"]))
    if of["array"] and of["array"] != other:
        arrays = json_arrays.describe(spark, of["array"], _file())
    counts, made = [], []
    if of["lines"]:
        counts.append(lines.select("file", "n"))
    if of["array"]:
        begins = checkpointed(json_arrays.states(arrays))
        counts.append(begins.where("block = 0").select("file", F.col("items").alias("n")))
    if of["object"]:
        counts.append(spark.createDataFrame([(p, 1) for p in of["object"]], "file string, n long"))
    if not counts:
        empty = spark.createDataFrame([], "record_index long, source_json string, value string")
        return empty.select("record_index", "source_json", F.parse_json("value").alias("record"))
    bases = _bases(spark, paths, reduce(DataFrame.unionAll, counts))
    if of["lines"]:
        rows = _numbered(_lines(spark, of["lines"]), lines, bases)
        made.append(rows.select("n", "file", _object(F.col("value"), "JSONL line must be an object").alias("record")))
    if of["array"]:
        rows = json_arrays.read_arrays(spark, of["array"], _file(), begins.join(bases, "file"))
        made.append(rows.select("n", "file", _object(F.col("value"), "array item must be an object").alias("record")))
    if of["object"]:
        rows = spark.read.text([literal(p) for p in of["object"]], wholetext=True).select("value", _file().alias("file")).join(bases, "file")
        made.append(rows.select(F.col("base").alias("n"), "file", _object(F.col("value"), "JSON file must be an object").alias("record")))
    return reduce(DataFrame.unionAll, made).select(F.col("n").alias("record_index"), F.col("file").alias("source_json"), "record")


def read_jsonl(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    """JSON Lines, strictly: a bad line or one that is no object stops the run; missing files have no rows.

    ``seq`` is the position over all files, in the order given.
    """
    there = list(dict.fromkeys(resolved(spark, p) for p in paths if exists(spark, p)))
    pin_splits(spark)
    fields = [f.strip() for f in schema.split(",")]
    if not there:
        return spark.createDataFrame([], ", ".join([*fields, "seq long"]))
    splits = _line_splits(_lines(spark, there))
    rows = _numbered(_lines(spark, there), splits, _bases(spark, there, splits.select("file", "n")))
    v = _object(F.col("value"), "line must be a JSON object")
    return rows.select(v.alias("v"), F.col("n").alias("seq")).select(
        *(F.variant_get("v", "$." + f.split()[0], f.split()[1]).alias(f.split()[0]) for f in fields), "seq"
    )


def label_files(spark: SparkSession, folder: str, pattern: str = "*.labels.jsonl") -> list[str]:
    """Label files in order of their names."""
    return matching(spark, f"{folder}/{pattern}")
