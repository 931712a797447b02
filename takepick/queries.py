"""Queries of the labeling operators over the shared tables, and their SQL.

Conversations stand for records: a conversation is a record, its turns in order
are the segments.  Candidate transcripts of a turn are made by expressions that
both engines have: the text itself, its upper case (of a to z) with other marks, the text
without every fifth word, and the next turn.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from takepick.config import LabelingConfig
from takepick.functions import audio, metrics, text
from takepick.operators import collect, prepare, shard
from takepick.operators.transcribe import transcribe


LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def normalize_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", text.normalize_basic(F.col("text")).alias("normalized"))


def _joined(c: F.Column) -> F.Column:
    return F.array_join(c, chr(31))


def tokenize_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.tokens(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.size(words).cast("long").alias("n_tokens"), F.md5(_joined(words)).alias("tokens_md5"))


def tokenize_char(spark: SparkSession, sf_dir: str) -> DataFrame:
    chars = text.tokens(F.col("text"), tokenizer="char")
    return table(spark, sf_dir, "benchmark").select("item_id", F.size(chars).cast("long").alias("n_tokens"), F.md5(_joined(chars)).alias("tokens_md5"))


def tokenize_unnormalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = text.tokens(F.col("html"), "none")
    return table(spark, sf_dir, "pages").select("page_id", F.size(words).cast("long").alias("n_tokens"), F.md5(_joined(words)).alias("tokens_md5"))


def _turn_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    return table(spark, sf_dir, "conversations").withColumn("next", F.lead("text").over(w)).where("next is not null")


def wer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each turn against the next."""
    return _turn_pairs(spark, sf_dir).select("conv_id", "turn", metrics.wer(F.col("text"), F.col("next")).alias("wer"))


def cer_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each benchmark passage against its own first half, by characters."""
    half = F.expr("substring(text, 1, length(text) div 2)")
    rate = metrics.wer(F.col("text"), half, tokenizer="char")
    return table(spark, sf_dir, "benchmark").select("item_id", rate.alias("cer"))


def _candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn")
    base = table(spark, sf_dir, "conversations").withColumn("next", F.coalesce(F.lead("text").over(w), F.lit("")))
    words = F.split("text", " ")
    made = F.array(
        F.col("text"), F.translate("text", LOWER + ".", LOWER.upper() + "!"), F.array_join(F.filter(words, lambda x, i: i % 5 != 4), " "), F.col("next")
    )
    return base.select("conv_id", "turn", "text", F.posexplode(made).alias("candidate_index", "transcript"))


def _groups_and_labels(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Conversations' turns as groups; labels lack candidate 0 of every third record and fail candidate 2 of every fourth."""
    ident = F.concat_ws("-", "conv_id", "turn")
    rows = _candidates(spark, sf_dir).select(ident.alias("id"), "conv_id", "text", "candidate_index", "transcript")
    nested = F.array_sort(F.collect_list(F.struct("candidate_index", F.col("candidate_index").cast("string").alias("candidate"), F.concat_ws("/", "id", "candidate_index").alias("audio"))))
    groups = rows.groupBy("id", "text").agg(nested.alias("candidates")).withColumn("record_index", F.xxhash64("id"))
    labels = rows.where("not (conv_id % 3 = 0 and candidate_index = 0)").select(
        "id",
        "candidate_index",
        F.col("transcript").alias("asr_text"),
        F.lit(None).cast("string").alias("audio"),
        F.when((F.col("conv_id") % 4 == 0) & (F.col("candidate_index") == 2), "RuntimeError: no signal").alias("error"),
        F.lit(1).cast("long").alias("seq"),
    )
    return groups, labels


def best_candidate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: labels joined back, rated, the best candidate of each record, its rate and how many are missing."""
    groups, labels = _groups_and_labels(spark, sf_dir)
    return collect.best_of(groups, labels).drop("record_index")


def candidate_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups, labels = _groups_and_labels(spark, sf_dir)
    done = collect.results(collect.score(groups, labels))
    return done.select("id", F.explode("detail").alias("d")).select("id", "d.candidate", "d.wer", F.md5("d.transcript").alias("transcript_md5"), "d.audio", "d.error")


def missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels").select("doc_id", F.lit(True).alias("there"))
    return docs.join(labels, "doc_id", "left").agg(F.count(F.lit(1)).alias("documents"), F.count_if(F.col("there").isNull()).alias("missing_labels"))


def reference_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "text"))).alias("t"))
    return turns.select("conv_id", text.join_texts(F.transform("t", lambda x: x["text"])).alias("reference"))


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records as variants: some broken, in a different way for each remainder of conv_id by 11."""
    paths = F.array(F.concat_ws("", F.lit("a/"), "conv_id", F.lit("_"), "turn", F.lit(".wav")), F.concat_ws("", F.lit("/b/"), "conv_id", F.lit("_"), "turn", F.lit(".wav")))
    one = F.when((F.col("conv_id") % 11 == 3) & (F.col("turn") == 1), F.array(F.lit("x"))).when((F.col("conv_id") % 11 == 4) & (F.col("turn") == 1), F.array().cast("array<string>")).otherwise(paths)
    said = F.when(F.col("conv_id") % 11 == 5, "  ").otherwise(F.col("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.struct(said.alias("text"), one.alias("candidate_audio_path")).alias("s"))
    nested = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "s"))).alias("o")).withColumn("o", F.transform("o", lambda x: x["s"]))
    whole = F.when(F.col("conv_id") % 11 == 1, F.lit("[]")).when(F.col("conv_id") % 11 == 2, F.lit('[{"text":"a","candidate_audio_path":["b"]},7]')).otherwise(F.to_json("o"))
    ident = F.when(F.col("conv_id") % 11 == 6, F.lit("null")).otherwise(F.col("conv_id").cast("string"))
    head = F.when(F.col("conv_id") % 11 == 7, F.lit("{")).otherwise(F.concat(F.lit('{"id":'), ident, F.lit(",")))
    return nested.select(
        F.col("conv_id").alias("record_index"), F.lit("/in/records.json").alias("source_json"), F.parse_json(F.concat(head, F.lit('"output":'), whole, F.lit("}"))).alias("record")
    )


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.errors(prepare.validate(_records(spark, sf_dir)))


def explode_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = prepare.candidates(prepare.validate(_records(spark, sf_dir), LabelingConfig()), "/out/prepared_audio")
    return rows.select("id", "candidate_index", "candidate", "audio", F.md5("text").alias("text_md5"), "num_segments", F.array_join("audio_paths", "|").alias("audio_paths"))


def preparation_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepare.counters(prepare.validate(_records(spark, sf_dir)))


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("candidate_index"), "doc_id")


def round_robin_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.round_robin(_manifest(spark, sf_dir), 8, ["doc_id"]).select("doc_id", "shard_id")


def _labeled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of documents; low quality ones are failures."""
    return table(spark, sf_dir, "labels").select(
        F.col("doc_id").cast("string").alias("id"), F.lit(0).alias("candidate_index"), F.when(F.col("quality") == 0, "RuntimeError: low").alias("error")
    )


def shard_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = _manifest(spark, sf_dir).withColumn("shard_id", F.expr("cast(doc_id % 8 as int)"))
    return shard.shard_status(manifest, _labeled(spark, sf_dir))


def resume_todo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard.todo(_manifest(spark, sf_dir), _labeled(spark, sf_dir)).select("doc_id")


def latest_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("user_id", "event_type", "event_id", "value")
    return collect.latest(events, ["user_id", "event_type"], "event_id")


def safe_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select("page_id", text.safe_name(F.col("url")).alias("name"))


def resolved_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = F.when(F.col("page_id") % 2 == 0, F.concat(F.lit("/abs/"), F.col("page_id").cast("string"))).otherwise(F.concat(F.lit("rel/"), F.col("page_id").cast("string")))
    path = F.when(F.col("page_id") % 5 == 0, F.concat(F.lit("~/"), F.col("page_id").cast("string"))).otherwise(path)
    return table(spark, sf_dir, "pages").select("page_id", text.resolve_path(path, F.col("url"), home="/home/someone").alias("path"))


def batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shard.batches(table(spark, sf_dir, "documents").select("doc_id"), 8, ["doc_id"])
    return placed.groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_doc"))


def _signal_hash(c: F.Column) -> F.Column:
    return F.aggregate(c, F.lit(0.0), lambda a, x: a + x.cast("double"))


def concat_signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vector, a gap and the same vector again as one signal."""
    signal = audio.join_signals(F.array("embedding", "embedding"), audio.gap_samples(16000, 0.5))
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.size(signal).cast("long").alias("samples"), F.round(_signal_hash(signal), 4).alias("total"), F.round(F.get(signal, F.lit(64 + 8)).cast("double"), 4).alias("after_gap")
    )


def resample_linear(spark: SparkSession, sf_dir: str) -> DataFrame:
    signal = audio.resample_linear(F.col("embedding"), 16000, 24000)
    rows = table(spark, sf_dir, "embeddings").select("vec_id", F.posexplode(signal).alias("sample", "x"))
    return rows.select("vec_id", F.col("sample").cast("long").alias("sample"), (F.round(F.col("x").cast("double"), 4) + F.lit(0.0)).alias("value"))


def json_props(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Semi-structured events: whether the document is an object, its member as a number and as text, and one that isn't there."""
    v = F.try_parse_json("props")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.schema_of_variant(v).startswith("OBJECT").alias("is_object"),
        F.variant_get(v, "$.k", "long").alias("k"),
        F.variant_get(v, "$.k", "string").alias("k_text"),
        F.variant_get(v, "$.none", "string").alias("none"),
    )


class EchoTranscriber:
    """Stands for a model: says the name of the recording."""

    def transcribe(self, audio: list[str], language: str | None, context: str) -> list[dict]:
        return [{"text": a, "language": language, "n": len(a)} for a in audio]


def transcribe_fake(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.concat_ws("/", "conv_id", "turn").alias("audio"))
    return transcribe(manifest, EchoTranscriber, 8, "en")


QUERIES = (
    best_candidate,
    candidate_detail,
    normalize_basic,
    tokenize_word,
    tokenize_char,
    tokenize_unnormalized,
    wer_pairs,
    cer_pairs,
    reference_text,
    quarantine,
    explode_candidates,
    preparation_counts,
    round_robin_shards,
    shard_completeness,
    resume_todo,
    latest_label,
    missing_labels,
    safe_names,
    resolved_paths,
    batches,
    concat_signal,
    resample_linear,
    json_props,
    transcribe_fake,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


NORM = r"trim(regexp_replace(lower({0}), '[^\p{{L}}\p{{N}}]+', ' ', 'g'))"
WORDS = "list_filter(string_split(" + NORM + ", ' '), lambda x: x <> '')"


def _distance(pairs: str) -> str:
    """Token distances by a recursive row-wise programme; ``pairs`` selects k, r, h."""
    return f"""
pairs AS ({pairs}),
step AS (
  SELECT k, r, h, 0 AS i, range(0, len(h) + 1) AS v FROM pairs
  UNION ALL
  SELECT k, r, h, i + 1, list_transform(range(1, len(t) + 1), lambda j: list_min(t[1:j]) + j - 1)
  FROM (SELECT k, r, h, i, list_transform(range(0, len(h) + 1),
          lambda j: CASE WHEN j = 0 THEN i + 1 ELSE least(v[j + 1] + 1, v[j] + CASE WHEN h[j] = r[i + 1] THEN 0 ELSE 1 END) - j END) AS t
        FROM step WHERE i < len(r))),
rated AS (SELECT k, CASE WHEN len(r) = 0 THEN CASE WHEN len(h) = 0 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END ELSE v[len(h) + 1]::DOUBLE / len(r) END AS rate FROM step WHERE i = len(r))
"""


CANDIDATES = """
b AS (SELECT conv_id, turn, text, coalesce(lead(text) OVER (PARTITION BY conv_id ORDER BY turn), '') AS next FROM conversations),
c AS (
  SELECT conv_id, turn, conv_id || '-' || turn AS id, text, u.i::INT AS candidate_index,
    [text, translate(text, 'abcdefghijklmnopqrstuvwxyz.', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ!'), array_to_string(list_filter(string_split(text, ' '), lambda x, n: (n - 1) % 5 <> 4), ' '), next][u.i + 1] AS transcript
  FROM b, (SELECT unnest([0, 1, 2, 3]) AS i) u),
l AS (
  SELECT *, conv_id % 3 = 0 AND candidate_index = 0 AS missing,
    CASE WHEN conv_id % 4 = 0 AND candidate_index = 2 THEN 'RuntimeError: no signal' END AS failed FROM c)
"""
RATED = "SELECT id || '|' || candidate_index AS k, " + WORDS.format("text") + " AS r, " + WORDS.format("transcript") + " AS h FROM l WHERE NOT missing AND failed IS NULL"

RECORDS = """
s AS (
  SELECT conv_id, turn, text, CASE WHEN conv_id % 11 = 3 AND turn = 1 THEN 1 WHEN conv_id % 11 = 4 AND turn = 1 THEN 0 ELSE 2 END AS n FROM conversations),
g AS (
  SELECT conv_id, CASE WHEN conv_id % 11 = 6 THEN 'None' WHEN conv_id % 11 = 7 THEN printf('record_%09d', conv_id) ELSE conv_id::VARCHAR END AS id,
    count(*)::INT AS num_segments, list(n ORDER BY turn) AS ns, list(turn ORDER BY turn) AS turns, string_agg(trim(text), ' ' ORDER BY turn) AS joined
  FROM s GROUP BY conv_id),
e AS (
  SELECT *, list_position(list_transform(ns, lambda n: n = 0), true) - 1 AS none, list_position(list_transform(ns, lambda n: n <> ns[1]), true) - 1 AS other FROM g),
v AS (
  SELECT *, CASE
    WHEN conv_id % 11 = 1 THEN 'ValueError: output must be a non-empty list'
    WHEN conv_id % 11 = 2 THEN 'ValueError: output[1] must be an object'
    WHEN none >= 0 THEN 'ValueError: output[' || none || '].candidate_audio_path must be a non-empty list'
    WHEN other >= 0 THEN 'ValueError: candidate count mismatch: output[0] has ' || ns[1] || ', output[' || other || '] has ' || ns[other + 1]
    WHEN conv_id % 11 = 5 THEN 'ValueError: concatenated reference text is empty' END AS error FROM e)
"""
SAFE = "substr(CASE WHEN b = '' THEN 'record' ELSE b END, 1, 120) || '_' || substr(sha1({0}), 1, 10)"


def oracle_sql() -> dict[str, str]:
    return {
        "best_candidate": f"""WITH RECURSIVE {CANDIDATES}, {_distance(RATED)},
j AS (SELECT l.*, rated.rate FROM l LEFT JOIN rated ON rated.k = l.id || '|' || l.candidate_index)
SELECT id, (min({{'w': rate, 'i': candidate_index}}) FILTER (WHERE rate IS NOT NULL)).i AS best_candidate, min(rate) AS best_wer,
  count(*) FILTER (WHERE missing) AS missing, count(*) FILTER (WHERE rate IS NULL) AS unrated FROM j GROUP BY id""",
        "candidate_detail": f"""WITH RECURSIVE {CANDIDATES}, {_distance(RATED)}
SELECT l.id, l.candidate_index AS candidate, rated.rate AS wer, md5(CASE WHEN missing THEN '' ELSE transcript END) AS transcript_md5,
  l.id || '/' || l.candidate_index AS audio, CASE WHEN missing THEN 'missing worker output' ELSE failed END AS error
FROM l LEFT JOIN rated ON rated.k = l.id || '|' || l.candidate_index""",
        "normalize_basic": f"SELECT doc_id, {NORM.format('nfc_normalize(text)')} AS normalized FROM documents",
        "tokenize_word": f"SELECT doc_id, len(w) AS n_tokens, md5(array_to_string(w, chr(31))) AS tokens_md5 FROM (SELECT doc_id, {WORDS.format('text')} AS w FROM documents)",
        "tokenize_char": f"""SELECT item_id, len(w) AS n_tokens, md5(array_to_string(w, chr(31))) AS tokens_md5
FROM (SELECT item_id, list_filter(string_split(replace({NORM.format('text')}, ' ', ''), ''), lambda x: x <> '') AS w FROM benchmark)""",
        "tokenize_unnormalized": r"""SELECT page_id, len(w) AS n_tokens, md5(array_to_string(w, chr(31))) AS tokens_md5
FROM (SELECT page_id, list_filter(regexp_split_to_array(html, '[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+'), lambda x: x <> '') AS w FROM pages)""",
        "wer_pairs": f"""WITH RECURSIVE t AS (SELECT conv_id, turn, text, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next FROM conversations),
{_distance("SELECT {'c': conv_id, 't': turn} AS k, " + WORDS.format('text') + " AS r, " + WORDS.format('next') + " AS h FROM t WHERE next IS NOT NULL")}
SELECT k.c AS conv_id, k.t AS turn, rate AS wer FROM rated""",
        "reference_text": "SELECT conv_id, string_agg(trim(text), ' ' ORDER BY turn) FILTER (WHERE trim(text) <> '') AS reference FROM conversations GROUP BY conv_id",
        "quarantine": f"WITH {RECORDS} SELECT id, '/in/records.json' AS source_json, error FROM v WHERE error IS NOT NULL",
        "explode_candidates": f"""WITH {RECORDS}, x AS (SELECT *, unnest([0, 1])::INT AS candidate_index, regexp_replace(id, '[^A-Za-z0-9._-]+', '_', 'g') AS b FROM v WHERE error IS NULL)
SELECT id, candidate_index, candidate_index::VARCHAR AS candidate, '/out/prepared_audio/' || {SAFE.format('id')} || '/candidate_00' || candidate_index || '.wav' AS audio,
  md5(joined) AS text_md5, num_segments,
  array_to_string(list_transform(turns, lambda t: CASE WHEN candidate_index = 0 THEN '/in/a/' ELSE '/b/' END || conv_id || '_' || t || '.wav'), '|') AS audio_paths FROM x""",
        "preparation_counts": f"WITH {RECORDS} SELECT count(*) FILTER (WHERE error IS NULL) AS ok, count(*) FILTER (WHERE error IS NOT NULL) AS failed, (2 * count(*) FILTER (WHERE error IS NULL))::BIGINT AS candidates FROM v",
        "round_robin_shards": "SELECT doc_id, ((row_number() OVER (ORDER BY doc_id) - 1) % 8)::INT AS shard_id FROM documents",
        "shard_completeness": """WITH ok AS (SELECT DISTINCT doc_id FROM labels WHERE quality IS NULL OR quality <> 0)
SELECT (d.doc_id % 8)::INT AS shard_id, count(DISTINCT d.doc_id) AS required, count(DISTINCT ok.doc_id) AS done, count(DISTINCT d.doc_id) = count(DISTINCT ok.doc_id) AS complete
FROM documents d LEFT JOIN ok ON ok.doc_id = d.doc_id GROUP BY 1""",
        "resume_todo": "SELECT doc_id FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND (l.quality IS NULL OR l.quality <> 0))",
        "latest_label": "SELECT user_id, event_type, event_id, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id DESC) = 1",
        "missing_labels": "SELECT count(*) AS documents, count(*) FILTER (WHERE l.doc_id IS NULL) AS missing_labels FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id",
        "safe_names": f"""SELECT page_id, {SAFE.format('url')} AS name FROM (SELECT *, regexp_replace(regexp_replace(url, '[^A-Za-z0-9._-]+', '_', 'g'), '^[._]+|[._]+$', '', 'g') AS b FROM pages)""",
        "resolved_paths": "SELECT page_id, CASE WHEN page_id % 5 = 0 THEN '/home/someone/' || page_id WHEN page_id % 2 = 0 THEN '/abs/' || page_id ELSE regexp_replace(url, '/[^/]*$', '') || '/rel/' || page_id END AS path FROM pages",
        "batches": "SELECT p // 8 AS batch_id, count(*) AS n, min(doc_id) AS first_doc FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS p FROM documents) GROUP BY 1",
        "concat_signal": """SELECT vec_id, len(x) AS samples, round(list_sum(list_transform(x, lambda v: v::DOUBLE)), 4) AS total, round(x[73]::DOUBLE, 4) AS after_gap
FROM (SELECT vec_id, list_concat(list_concat(embedding, [0::FLOAT for i in range(8)]), embedding) AS x FROM embeddings)""",
        "resample_linear": """WITH p AS (SELECT vec_id, embedding AS e, len(embedding) AS n, greatest(1, round_even(len(embedding) * 1.5, 0))::BIGINT AS m FROM embeddings),
q AS (SELECT *, unnest(range(0, m)) AS sample FROM p), z AS (SELECT *, least(sample * n::DOUBLE / m, n - 1.0) AS x FROM q)
SELECT vec_id, sample, round((e[floor(x)::BIGINT + 1]::DOUBLE + (e[least(floor(x)::BIGINT + 1, n - 1) + 1]::DOUBLE - e[floor(x)::BIGINT + 1]::DOUBLE) * (x - floor(x)))::FLOAT::DOUBLE, 4) + 0.0 AS value FROM z""",
        "json_props": "SELECT event_id, json_type(props) = 'OBJECT' AS is_object, json_extract(props, '$.k')::BIGINT AS k, json_extract_string(props, '$.k') AS k_text, json_extract_string(props, '$.none') AS none FROM events",
        "transcribe_fake": """SELECT conv_id, turn, conv_id || '/' || turn AS audio, conv_id || '/' || turn AS asr_text, 'en' AS language, NULL::VARCHAR AS error,
  '{"n": ' || length(conv_id || '/' || turn) || '}' AS asr_extra FROM conversations""",
        "cer_pairs": f"""WITH RECURSIVE {_distance("SELECT item_id AS k, list_filter(string_split(replace(" + NORM.format('text') + ", ' ', ''), ''), lambda x: x <> '') AS r, list_filter(string_split(replace(" + NORM.format("substr(text, 1, length(text) // 2)") + ", ' ', ''), ''), lambda x: x <> '') AS h FROM benchmark")}
SELECT k AS item_id, rate AS cer FROM rated""",
    }
