"""Input files of any file system that Spark knows."""

from __future__ import annotations

import os
import re

from pyspark.sql import SparkSession


def _system(spark: SparkSession, path: str) -> tuple:
    sc = spark.sparkContext
    p = sc._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(sc._jsc.hadoopConfiguration())


def plain(url: str) -> str:
    """A local file's path without the scheme, any other as it is."""
    return re.sub(r"\Afile:/+", "/", url)


def literal(path: str) -> str:
    """A path that a reader takes as it is, whatever signs are in it."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _pattern(value: str) -> str:
    """A shell pattern in Hadoop's form: braces are letters, ``!`` negates a class."""
    return re.sub(r"([\\{}])", r"\\\1", value).replace("[!", "[^")


def _urls(spark: SparkSession, statuses: object) -> list[str]:
    """All paths of an array of statuses, in a few calls however many they are."""
    if not len(statuses):
        return []
    jvm = spark.sparkContext._jvm
    job = jvm.org.apache.hadoop.mapred.JobConf(spark.sparkContext._jsc.hadoopConfiguration())
    jvm.org.apache.hadoop.mapred.FileInputFormat.setInputPaths(job, jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses))
    said = job.get("mapreduce.input.fileinputformat.inputdir")  # commas and backslashes in a path have a backslash in front
    return [re.sub(r"\\(.)", r"\1", x) for x in re.findall(r"(?:\\.|[^,\\])+", said)]


def exists(spark: SparkSession, path: str) -> bool:
    p, files = _system(spark, path)
    return files.exists(p)


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """What is there of a pattern, sorted; names that begin with a dot only if the pattern says so."""
    p, files = _system(spark, _pattern(pattern))
    found = files.globStatus(p)
    hidden = os.path.basename(pattern.rstrip("/")).startswith(".")
    return sorted(plain(x) for x in (_urls(spark, found) if found else []) if hidden or not os.path.basename(x).startswith("."))


def inside(spark: SparkSession, folder: str) -> list[str]:
    """What lies in a folder, sorted; nothing if it isn't there."""
    p, files = _system(spark, folder)
    return sorted(plain(x) for x in _urls(spark, files.listStatus(p))) if files.exists(p) else []


def expand_paths(spark: SparkSession, values: list[str]) -> list[str]:
    """Files of globs, folders (their .json, then .jsonl files) and literal paths, each once, first place kept.

    A value is a path or URL of any file system that Spark knows.  Folders and patterns are listed in one call each,
    and no file is opened.  What matches nothing is kept as it is: reading it fails.
    """
    out: dict[str, None] = {}
    for value in values:
        for path in (re.search(r"[*?\[]", value) and matching(spark, value)) or [value]:
            path = os.path.expanduser(path)
            p, files = _system(spark, path)
            inside = [path]
            if files.exists(p) and files.getFileStatus(p).isDirectory():
                every = sorted(plain(x) for x in _urls(spark, files.listStatus(p)) if not os.path.basename(x).startswith("."))
                inside = [f for kind in (".json", ".jsonl") for f in every if f.endswith(kind)]
            for f in inside:
                out.setdefault(resolved(spark, f), None)
    return list(out)


def resolved(spark: SparkSession, path: str) -> str:
    """One name for a file: a local one's path without links, any other's full URL."""
    path = plain(path)
    if not re.match(r"\w[\w+.-]*:/", path):
        return os.path.realpath(path)
    p, files = _system(spark, path)
    return files.makeQualified(p).toString()


def pin_splits(spark: SparkSession) -> None:
    """From now on the session cuts files alike whenever it reads them, also when executors come and go."""
    if not spark.conf.get("spark.sql.files.minPartitionNum", None):
        spark.conf.set("spark.sql.files.minPartitionNum", spark.sparkContext.defaultParallelism)


def make_file(spark: SparkSession, path: str) -> None:
    """An empty file, in folders made as needed."""
    p, files = _system(spark, path)
    files.createNewFile(p) if files.mkdirs(p.getParent()) else None
