"""Connected components of a link table, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from takepick.llm.common import Scratch


def components(s: Scratch, links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b); label is the smallest node of its component.

    Each round every node learns the least neighbour by a combining aggregate
    and hands it on by a join, which adaptive execution splits at a hub.  Rounds
    grow with the logarithm of the nodes; each is written down before the next.
    """
    edges = s.table(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = None
    while True:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = s.table(both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct())
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        hooked = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = s.table(hooked.unionAll(least.select("a", F.col("m").alias("b"))).distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        s.drop(edges, large)
        edges = now
        if state == before or not state[0]:
            break
        before = state
    return s.table(edges.select(F.col("a").alias("node"), F.col("b").alias("label")).unionAll(edges.select(F.col("b").alias("node"), F.col("b").alias("label"))).distinct())


def merged(s: Scratch, labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """(node, label) after more links: only they go through the rounds, between the components there are."""
    if labels is None:
        return components(s, links)
    now = links
    for end in ("a", "b"):
        known = labels.select(F.col("node").alias(end), F.col("label").alias("known"))
        now = now.join(known, end, "left").withColumn(end, F.coalesce("known", end)).drop("known")
    now = s.table(now.where("a <> b").distinct())
    if now.isEmpty():
        return labels
    new = components(s, now)
    moved = labels.join(new.select(F.col("node").alias("label"), F.col("label").alias("to")), "label", "left").select("node", F.coalesce("to", "label").alias("label"))
    return s.table(moved.unionAll(new.join(labels.select("node"), "node", "left_anti").select("node", "label")))
