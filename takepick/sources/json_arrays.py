"""Files that hold one JSON array each, every file read by as many tasks as it has splits.

A file is read as text between commas.  A split then begins after a comma, and there only
two things about it are unknown: whether the comma is within a string, and how deep
the brackets are.  So a first pass states of each split, for both answers, how the depth changes and
how many commas lie at each relative depth; prefix sums over a file's splits settle the answers, and the
number of the item that each split begins in.  A second pass cuts the splits at the commas of depth one.
An item that lies in several splits is put together from its parts; all others leave their task whole.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from takepick.sources.listing import literal
from takepick.sources.shared import checkpointed

HEAD = 4096  # bytes from which the form of a file is told
BLANK = b" \t\r\n"
_STEP = np.zeros(256, np.int64)
_STEP[list(b"[{")], _STEP[list(b"]}")] = 1, -1
_MARK = _STEP != 0
_MARK[ord(",")] = True


def kind_of(head: bytes) -> str:
    """``empty``, ``array``, ``object`` (one, over several lines) or ``lines``, from the first bytes of a file."""
    head = head.lstrip()
    if not head:
        return "empty"
    if head[:1] == b"[":
        return "array"
    line, end, _ = head.partition(b"\n")
    try:
        json.loads(line)
    except ValueError:
        return "object" if end or len(head) < HEAD else "lines"  # a line longer than the head is no indented object
    return "lines"


class Walk:
    """Brackets and commas outside strings, chunk after chunk; chunks begin after or at a comma."""

    def __init__(self, inside: int, depth: int):
        self.inside, self.depth = inside, depth

    def __call__(self, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places, signs, and the depth after each."""
        x = np.frombuffer(data, np.uint8)
        quotes = np.flatnonzero(x == ord('"'))
        if b"\\" in data:  # a quote after an odd number of backslashes is text
            other = np.maximum.accumulate(np.where(x != ord("\\"), np.arange(len(x)), -1))
            before = np.maximum(quotes - 1, 0)
            quotes = quotes[(np.where(quotes > 0, before - other[before], 0)) % 2 == 0]
        at = np.flatnonzero(_MARK[x])
        at = at[(np.searchsorted(quotes, at) + self.inside) % 2 == 0]
        depth = self.depth + np.cumsum(_STEP[x[at]])
        self.inside = (self.inside + len(quotes)) % 2
        self.depth = int(depth[-1]) if len(depth) else self.depth
        return at, x[at], depth


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, bytes, bool, bool]]:
    """(columns of the split, text, whether it is the first and the last chunk of the split); rows come split by split."""
    waiting = None
    for batch in batches:
        path, block = batch.column("file"), np.asarray(batch.column("block"))
        coded = np.asarray(path.dictionary_encode().indices)
        cuts = [0, *(np.flatnonzero((np.diff(coded) != 0) | (np.diff(block) != 0)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            part = batch.slice(a, b - a)
            pieces = part.column("value")
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, len(pieces)], pa.int32()), pieces), ",")[0].as_buffer().to_pybytes()
            split = {n: part.column(n)[0].as_py() for n in part.schema.names if n != "value"}
            same = waiting is not None and (waiting[0]["file"], waiting[0]["block"]) == (split["file"], split["block"])
            if waiting is not None:
                yield *waiting, not same
            waiting = split, b"," + text if same else text, not same
    if waiting is not None:
        yield *waiting, True


def _describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for each split; depths and commas are counted for a begin outside and within a string."""
    for split, text, first, last in _chunks(batches):
        if first:
            walks, counts, solid, head = (Walk(0, 0), Walk(1, 0)), ({}, {}), 0, b""
        for walk, count in zip(walks, counts):
            _, sign, depth = walk(text)
            for d, n in zip(*np.unique(depth[sign == ord(",")], return_counts=True)):
                count[int(d)] = count.get(int(d), 0) + int(n)
        solid += len(text.translate(None, BLANK))
        if len(head) < HEAD:
            head += text[:HEAD] if head else text.lstrip()[:HEAD]
        if last:
            row = {"file": split["file"], "block": split["block"], "kind": kind_of(head) if not split["block"] else None, "quotes": walks[0].inside, "solid": solid}
            for name, walk, count in zip(("out", "in"), walks, counts):
                row |= {f"{name}_step": walk.depth, f"{name}_commas": list(count.items())}
            yield pa.RecordBatch.from_pylist([row], _DESCRIBED)


_COMMAS = pa.map_(pa.int32(), pa.int64())
_DESCRIBED = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("kind", pa.string()), ("quotes", pa.int32()), ("solid", pa.int64()), ("out_step", pa.int64()), ("out_commas", _COMMAS), ("in_step", pa.int64()), ("in_commas", _COMMAS)]
)


def _pieces(spark: SparkSession, paths: list[str], file: Column) -> DataFrame:
    rows = spark.read.text([literal(p) for p in paths], lineSep=",")
    return rows.select("value", file.alias("file"), F.col("_metadata.file_block_start").alias("block"))


def describe(spark: SparkSession, paths: list[str], file: Column) -> DataFrame:
    """A row for each split of files of any form, written down: file, block, kind (at the start of a file) and what an array's states are made of."""
    kinds = "file string, block long, kind string, quotes int, solid long, out_step long, out_commas map<int,long>, in_step long, in_commas map<int,long>"
    return checkpointed(_pieces(spark, paths, file).mapInArrow(_describe, kinds))


def states(described: DataFrame) -> DataFrame:
    """file, block, inside, depth and item in which a split begins, whether it is the file's last, and items of the file; a file that is no whole array stops the run."""
    w = Window.partitionBy("file").orderBy("block")
    before, every = w.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("file")
    so_far = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    s = described.withColumn("inside", so_far("quotes") % 2).withColumn("last", F.lead("block").over(w).isNull())
    s = s.withColumn("step", F.when(F.col("inside") == 0, F.col("out_step")).otherwise(F.col("in_step"))).withColumn("depth", so_far("step"))
    count = F.when(F.col("inside") == 0, F.col("out_commas")).otherwise(F.col("in_commas"))
    ends = ((F.col("inside") + F.col("quotes")) % 2 == 0) & (F.col("depth") + F.col("step") == 1)  # the comma between two splits is an item's end
    commas = F.coalesce(F.element_at(count, (1 - F.col("depth")).cast("int")), F.lit(0)) + (~F.col("last") & ends).cast("int")
    s = s.withColumn("commas", commas).withColumn("item", so_far("commas").cast("long"))
    whole = (F.sum("step").over(every) == 0) & (F.sum("quotes").over(every) % 2 == 0)
    items = F.sum("commas").over(every) + F.when(F.sum("solid").over(every) > 2, 1).otherwise(0)
    said = F.concat("file", F.lit(" starts with '[' but did not parse as a JSON array"))
    return s.select("file", "block", F.col("inside").cast("int").alias("inside"), F.col("depth").cast("int").alias("depth"), "item", "last", F.when(whole, items).otherwise(F.raise_error(said).cast("long")).alias("items"))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, n, block, value, whole): items, and parts of items that begin or end in another split."""
    out: list[tuple] = []
    for split, text, first, last in _chunks(batches):
        if last and not split["last"]:
            text += b","
        if first:
            if split["depth"] is None:
                raise RuntimeError(f"{split['file']} was cut otherwise before: its size or Spark's settings have changed")
            walk, item, rest, whole = Walk(split["inside"], split["depth"]), split["item"], b"", False
            opened, closed = split["depth"] > 0, split["block"] > 0 and split["depth"] == 0

        def give(value: bytes, begins: bool, ends: bool, comma: bool) -> None:
            if begins and ends and not value.strip():
                if comma or item:
                    raise ValueError(f"{split['file']} starts with '[' but did not parse as a JSON array")
                return  # an empty array
            out.append((split["file"], split["base"] + item, split["block"], value.decode("utf-8"), begins and ends))

        at, sign, depth = walk(text)
        bounds = (sign == ord(",")) & (depth == 1) | (sign == ord("[")) & (depth == 1) | (sign == ord("]")) & (depth == 0)
        done = 0
        for p, c in zip(at[bounds].tolist(), sign[bounds].tolist()):
            if c == ord("["):
                if opened:  # an item that is an array is no bound: its depth is 2
                    raise ValueError(f"{split['file']} starts with '[' but did not parse as a JSON array")
                opened, whole = True, True
            else:
                give(rest + text[done:p], whole, True, c == ord(","))
                whole, closed = True, c == ord("]")
                item += 1
            rest, done = b"", p + 1
        rest += text[done:]
        if closed and rest.strip(BLANK):
            raise ValueError(f"{split['file']} starts with '[' but did not parse as a JSON array")
        if last and opened and not closed and rest:
            give(rest, whole, False, False)
        if len(out) >= 256 or last:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["file", "n", "block", "value", "whole"])
            out = []


def read_arrays(spark: SparkSession, paths: list[str], file: Column, begins: DataFrame) -> DataFrame:
    """(n, file, value): all items in their JSON, numbered from their file's base (the column ``base`` of ``begins``, which is ``states``)."""
    rows = _pieces(spark, paths, file).join(F.broadcast(begins.drop("items")), ["file", "block"], "left")  # a row of some 100 bytes for each split of the input
    cut = checkpointed(rows.mapInArrow(_cut, "file string, n long, block long, value string, whole boolean"))
    parts = cut.where("not whole").groupBy("n", "file").agg(F.array_sort(F.collect_list(F.struct("block", "value"))).alias("p"))
    joined = parts.select("n", "file", F.array_join(F.transform("p", lambda x: x["value"]), "").alias("value"))
    return cut.where("whole").select("n", "file", "value").unionAll(joined)
