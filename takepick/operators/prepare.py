"""Records to candidates, groups and quarantined errors, in one pass of expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from takepick.config import LabelingConfig
from takepick.functions.text import join_texts, resolve_path, safe_name


def _get(v: Column, key: str) -> Column:
    """Member of an object variant: SQL null where absent, a variant null where null."""
    return F.try_variant_get(v, "$['%s']" % key.replace("'", "\\'"), "variant")


def _list(v: Column) -> Column:
    return F.try_variant_get(v, "$", "array<variant>")


def as_text(v: Column) -> Column:
    """``str`` of a scalar variant: booleans as True and False, null as None."""
    s = F.try_variant_get(v, "$", "string")
    return F.when(F.is_variant_null(v), "None").when(F.schema_of_variant(v) == "BOOLEAN", F.initcap(s)).otherwise(s)


def _text_or_empty(v: Column) -> Column:
    """Falsy values (null, false, 0, empty) are the empty text."""
    kind = F.schema_of_variant(v)
    number = F.try_variant_get(v, "$", "double")
    falsy = v.isNull() | F.is_variant_null(v) | ((kind == "BOOLEAN") & ~F.try_variant_get(v, "$", "boolean")) | (~kind.isin("STRING", "BOOLEAN") & (number == 0))
    empty = kind.startswith("ARRAY") & (F.size(_list(v)) == 0)
    return F.when(F.coalesce(falsy, F.lit(False)) | F.coalesce(empty, F.lit(False)), "").otherwise(F.coalesce(as_text(v), F.lit("")))


def validate(records: DataFrame, config: LabelingConfig = LabelingConfig()) -> DataFrame:
    """One row per record: record_index, id, source_json, text, n_candidates, num_segments, paths (by candidate), error.

    Checks run in order and the first failure is the record's error; what they
    compute is null then.  An absent id is made of the record's position.
    """
    c = config
    items = _list(_get(F.col("record"), c.output_key))
    rows = records.select(
        "record_index",
        "source_json",
        F.when(_get(F.col("record"), c.id_key).isNull(), F.format_string("record_%09d", "record_index")).otherwise(as_text(_get(F.col("record"), c.id_key))).alias("id"),
        items.alias("items"),
    )
    rows = rows.withColumn("lists", F.transform("items", lambda x: _list(_get(x, c.candidate_key))))
    rows = rows.withColumn("sizes", F.transform("lists", lambda x: F.coalesce(F.size(x), F.lit(0))))

    def first(array: Column, test) -> Column:
        """Position of the first item that fails, or -1."""
        return F.coalesce(F.array_position(F.transform(array, lambda x: ~F.coalesce(test(x), F.lit(False))), True), F.lit(0)) - 1

    bad_item = first(F.col("items"), lambda x: F.schema_of_variant(x).startswith("OBJECT"))
    bad_list = first(F.col("sizes"), lambda n: n > 0)
    bad_size = first(F.col("sizes"), lambda n: n == F.get("sizes", F.lit(0)))
    text = join_texts(F.transform("items", lambda x: _text_or_empty(_get(x, c.text_key))), c.text_separator)
    rows = rows.withColumns({"bad_item": bad_item, "bad_list": bad_list, "bad_size": bad_size, "joined": text})
    # fixed values: the messages
    error = (
        F.when(F.coalesce(F.size("items"), F.lit(0)) <= 0, F.lit(f"ValueError: {c.output_key} must be a non-empty list"))
        .when(F.col("bad_item") >= 0, F.format_string(f"ValueError: {c.output_key}[%d] must be an object", "bad_item"))
        .when(F.col("bad_list") >= 0, F.format_string(f"ValueError: output[%d].{c.candidate_key} must be a non-empty list", "bad_list"))
        .when(
            F.col("bad_size") >= 0,
            F.format_string(
                "ValueError: candidate count mismatch: output[0] has %d, output[%d] has %d", F.get("sizes", F.lit(0)), "bad_size", F.get("sizes", F.col("bad_size").cast("int"))
            ),
        )
        .when(F.col("joined") == "", F.lit("ValueError: concatenated reference text is empty"))
    )
    rows = rows.withColumn("error", error)
    good = F.col("error").isNull()
    by_candidate = F.transform(
        F.sequence(F.lit(0), F.get("sizes", F.lit(0)) - 1), lambda i: F.transform("lists", lambda x: resolve_path(as_text(F.get(x, i)), F.col("source_json"), c.audio_root, c.home))
    )
    return rows.select(
        "record_index",
        "id",
        "source_json",
        F.when(good, F.col("joined")).alias("text"),
        F.when(good, F.get("sizes", F.lit(0))).alias("n_candidates"),
        F.when(good, F.size("items")).alias("num_segments"),
        F.when(good, by_candidate).alias("paths"),
        "error",
    )


def errors(validated: DataFrame) -> DataFrame:
    """The quarantined records."""
    return validated.where("error is not null").select("id", "source_json", "error")


def candidates(validated: DataFrame, audio_folder: str) -> DataFrame:
    """One row per candidate of the good records, in the candidate schema, with its record_index and its segments' audio_paths."""
    return validated.where("error is null").select("*", F.posexplode("paths").alias("candidate_index", "audio_paths")).select(
        "id",
        "candidate_index",
        F.col("candidate_index").cast("string").alias("candidate"),
        F.format_string("%s/%s/candidate_%03d.wav", F.lit(audio_folder.rstrip("/")), safe_name(F.col("id")), "candidate_index").alias("audio"),
        "text",
        "source_json",
        "num_segments",
        "record_index",
        "audio_paths",
    )


def groups(validated: DataFrame, audio_folder: str) -> DataFrame:
    """One nested row per good record, candidates in order of index."""
    wav = lambda i: F.format_string("%s/%s/candidate_%03d.wav", F.lit(audio_folder.rstrip("/")), safe_name(F.col("id")), i)
    nested = F.transform(
        F.sequence(F.lit(0), F.col("n_candidates") - 1), lambda i: F.struct(i.alias("candidate_index"), i.cast("string").alias("candidate"), wav(i).alias("audio"))
    )
    return validated.where("error is null").select("record_index", "id", "text", F.col("n_candidates").alias("candidate_count"), nested.alias("candidates"))


def counters(validated: DataFrame) -> DataFrame:
    """Good records, failed records and candidates."""
    return validated.agg(
        F.count_if(F.col("error").isNull()).alias("ok"), F.count_if(F.col("error").isNotNull()).alias("failed"), F.coalesce(F.sum("n_candidates"), F.lit(0)).alias("candidates")
    )
