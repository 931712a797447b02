"""Labels back to candidates: last one wins, error rates, the best candidate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takepick.functions.metrics import error_rate, least_error_rate
from takepick.functions.text import tokens

MISSING = "missing worker output"  # fixed value


def latest(labels: DataFrame, key: list[str], seq: str = "seq") -> DataFrame:
    """The last row of each key; a later error replaces an earlier success.

    Rows combine before they shuffle, so a key that is labeled over and over
    gathers nowhere.  ``seq`` must be unique within a key.
    """
    rest = [c for c in labels.columns if c not in key]
    return labels.groupBy(*key).agg(F.max_by(F.struct(*rest), seq).alias("_last")).select(*key, "_last.*")


def score(groups: DataFrame, labels: DataFrame, normalize: str = "basic", tokenizer: str = "word", **how: bool) -> DataFrame:
    """One row per candidate: record_index, id, text, candidate_index, wer, transcript, audio, error, missing.

    Reference tokens are made once per record, before its candidates are.  A
    candidate without a label, or with an error, has no rate; an empty error text
    is none.  Records that repeat an id share its labels, each against its own text.
    """
    rows = groups.select("record_index", "id", "text", tokens(F.col("text"), normalize, tokenizer, **how).alias("_ref"), F.explode("candidates").alias("c"))
    rows = rows.select("record_index", "id", "text", "_ref", F.col("c.candidate_index").cast("int").alias("candidate_index"), F.col("c.audio").alias("_audio"))
    last = latest(labels.select("id", "candidate_index", "asr_text", "audio", "error", "seq"), ["id", "candidate_index"]).withColumn("_there", F.lit(True))
    joined = rows.join(last, ["id", "candidate_index"], "left").withColumn("missing", F.col("_there").isNull())
    said = F.coalesce("asr_text", F.lit(""))
    failed = F.coalesce(F.col("error") != "", F.lit(False))
    return joined.select(
        "record_index",
        "id",
        "text",
        "candidate_index",
        F.when(~F.col("missing") & ~failed, error_rate(F.col("_ref"), tokens(said, normalize, tokenizer, **how))).alias("wer"),
        F.when(F.col("missing"), "").otherwise(said).alias("transcript"),
        F.coalesce(F.when(F.col("audio") != "", F.col("audio")), F.col("_audio")).alias("audio"),
        F.when(F.col("missing"), MISSING).when(failed, F.col("error")).alias("error"),
        "missing",
    )


def best(rate: str = "wer", index: str = "candidate_index") -> Column:
    """Aggregate: the index of least rate, the first of equals; null if no candidate has a rate."""
    return F.min(F.when(F.col(rate).isNotNull(), F.struct(F.col(rate), F.col(index))))[index]


def best_of(groups: DataFrame, labels: DataFrame, normalize: str = "basic", tokenizer: str = "word", **how: bool) -> DataFrame:
    """One row per record: record_index, id, best_candidate, best_wer, missing, unrated (numbers of candidates).

    The same as ``score`` and ``best``, for those who need no other rates: a
    record's candidates are compared together, and one is given up as soon as it can't be better than those before it.
    Labels are gathered by id before they meet the records, so no candidate row carries a text.
    """
    last = latest(labels.select("id", "candidate_index", "asr_text", "error", "seq"), ["id", "candidate_index"])
    said = tokens(F.coalesce("asr_text", F.lit("")), normalize, tokenizer, **how)
    last = last.select("id", F.col("candidate_index").cast("int").alias("candidate_index"), F.when(~F.coalesce(F.col("error") != "", F.lit(False)), said).alias("said"))
    by_id = last.groupBy("id").agg(F.collect_list(F.struct("candidate_index", "said")).alias("_labels"))
    joined = groups.join(by_id, "id", "left").withColumn("_labels", F.map_from_entries(F.coalesce("_labels", F.array().cast("array<struct<candidate_index:int,said:array<string>>>"))))
    index = F.array_sort(F.transform("candidates", lambda c: c["candidate_index"].cast("int")))
    rows = joined.select("record_index", "id", tokens(F.col("text"), normalize, tokenizer, **how).alias("_ref"), index.alias("_index"), "_labels")
    rows = rows.select("*", F.transform("_index", lambda i: F.element_at("_labels", i)).alias("_said"))
    rows = rows.select("*", least_error_rate("_ref", "_said").alias("_best"))
    return rows.select(
        "record_index",
        "id",
        F.get("_index", F.col("_best.place")).alias("best_candidate"),
        F.col("_best.rate").alias("best_wer"),
        F.size(F.filter("_index", lambda i: ~F.map_contains_key("_labels", i))).cast("long").alias("missing"),
        F.size(F.filter("_said", lambda s: s.isNull())).cast("long").alias("unrated"),
    )


def results(scored: DataFrame) -> DataFrame:
    """One row per record, repeated ids included: record_index, id, text, best_candidate, detail (candidates in order of index)."""
    item = F.struct(F.col("candidate_index").alias("candidate"), "wer", "transcript", "audio", "error")
    return scored.groupBy("record_index", "id", "text").agg(best().alias("best_candidate"), F.array_sort(F.collect_list(item)).alias("detail"))


def missing_labels(scored: DataFrame) -> DataFrame:
    """How many candidates have no label at all (failed ones have one)."""
    return scored.agg(F.count_if("missing").alias("missing_labels"))
