"""Exact dedup by deterministic block naming, DataFrame functions only.

A text is cut into blocks of a fixed number of characters.  Level 0 gives equal
blocks equal integer names; each further level names the distinct pairs of
adjacent names in sorted order, until one name is left.  Two texts share a last
name exactly if they have equal blocks, so the identity is free of collisions.

Blocks travel once, to a distinct that compares them in full.  It proves the
128-bit key of each block to be its own; where it is not (it never was), other
seeds are tried, so a name never rests on an unproven digest.  All that moves
afterwards are keys and integers.  Names come from one sort of the distinct
keys, written down before use, so a lost executor can't change them.

A third of all rows may be copies of one text: distincts combine before they
shuffle, and joins back to the rows are plain shuffled joins of narrow rows,
which adaptive execution splits.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import Scratch, ascii_lower


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_chars: int = 1024) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Equal texts are those identical after lower-casing A-Z.  The row with the
    largest id of a group stays.  Null texts count as empty, and all empty texts
    are one group.  A null id sorts below every other.  Rows repeated with one id
    each count; exactly one of a group stays.  No rows give no rows.  Other
    columns are ignored.
    """
    with Scratch(docs.sparkSession) as s:
        norm = docs.select(F.col(id_col).cast("long").alias("doc_id"), ascii_lower(F.col(text_col)).alias("norm"))
        blocks = F.when(F.col("norm") == "", F.array(F.lit(""))).otherwise(
            F.regexp_extract_all("norm", F.lit("(?s).{1,%d}" % block_chars), F.lit(0))
        )
        seed = 0
        while True:
            key = lambda b, k=seed: (F.xxhash64(F.lit(k), b), F.xxhash64(b, F.lit(k + 1)))
            keys = _proven(s, norm.select(F.explode(blocks).alias("b")), key)
            if keys is not None:
                break
            seed += 2
        rows = s.table(
            norm.select(
                F.monotonically_increasing_id().alias("rid"),
                "doc_id",
                F.sha2("norm", 256).alias("text_sha256"),
                F.transform(blocks, lambda b: F.struct(*(c.alias(n) for c, n in zip(key(b), ("a", "b"))))).alias("keys"),
            )
        )
        names = _name(s, keys)
        level = rows.select("rid", F.size("keys").cast("long").alias("width"), F.posexplode("keys")).select(
            "rid", F.col("pos").cast("long").alias("pos"), "width", "col.a", "col.b"
        )
        level = s.table(_named(level, names))
        widest, n, last = level.agg(F.max("width")).first()[0] or 0, 0, []
        while True:
            last.append(level.where("width = 1").select("rid", F.lit(n).alias("level"), "name"))
            if widest <= 1:
                break
            pairs = s.table(
                level.where("width > 1")
                .groupBy("rid", "width", F.expr("pos div 2").alias("pos"))
                .agg(F.max(F.expr("if(pos % 2 = 0, name, null)")).alias("a"), F.coalesce(F.max(F.expr("if(pos % 2 = 1, name, null)")), F.lit(-1)).alias("b"))
                .select("rid", "pos", F.expr("(width + 1) div 2").alias("width"), "a", "b")
            )
            level, widest, n = s.table(_named(pairs, _name(s, pairs.select("a", "b").distinct()))), (widest + 1) // 2, n + 1
        ends = last[0]
        for x in last[1:]:
            ends = ends.unionAll(x)
        named = s.table(rows.select("rid", "doc_id", "text_sha256").join(ends, "rid"))
        groups = named.groupBy("level", "name").agg(F.max(F.struct("doc_id", "rid")).alias("top"), F.count(F.lit(1)).alias("group_size"))
        groups = s.table(groups.select("level", "name", F.col("top.doc_id").alias("keep_id"), F.col("top.rid").alias("keep_rid"), "group_size"))
        return s.keep(
            named.join(groups, ["level", "name"]).select(
                "doc_id", "keep_id", "group_size", (F.col("rid") == F.col("keep_rid")).alias("kept"), "text_sha256"
            )
        )


def _proven(s: Scratch, blocks: DataFrame, key) -> DataFrame | None:
    """Keys (a, b) of the distinct blocks, or None if two blocks share one."""
    a, b = key(F.col("b"))
    distinct = blocks.select(a.alias("ka"), b.alias("kb"), "b").distinct()
    counted = s.table(distinct.groupBy(F.col("ka").alias("a"), F.col("kb").alias("b")).agg(F.count(F.lit(1)).alias("n")))
    return counted.select("a", "b") if counted.where("n > 1").isEmpty() else None


def _name(s: Scratch, distinct: DataFrame) -> DataFrame:
    """Integer names of distinct pairs, ascending in their sorted order."""
    return s.table(distinct.orderBy("a", "b").withColumn("name", F.monotonically_increasing_id()))


def _named(rows: DataFrame, names: DataFrame) -> DataFrame:
    return rows.join(names, ["a", "b"]).select("rid", "pos", "width", "name")
