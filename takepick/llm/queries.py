"""Queries of the operators in this folder, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from takepick.llm.bpe import bpe_round_trip
from takepick.llm.chat_format import format_chats, loss_text
from takepick.llm.exact_dedup import exact_dedup
from takepick.llm.license_scan import scan_licenses
from takepick.llm.line_dedup import dedup_lines, duplicate_lines
from takepick.llm.lloyd import cluster
from takepick.llm.minhash import near_duplicates
from takepick.llm.packing import pack
from takepick.llm.quality import fit_quality, score_quality
from takepick.llm.rope import fill_in_middle
from takepick.llm.substring_dedup import duplicate_spans
from takepick.llm.tokens import default_tokenizer
from takepick.llm.topk import exact_topk
from takepick.llm.toxicity import fit_toxicity, held_out, score_toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(_table(spark, sf_dir, "documents"), default_tokenizer(), checksums=True)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = duplicate_spans(_table(spark, sf_dir, "documents"))
    return spans.select("doc_id", "start", "length", "n_chunks", "first_doc_id")


def op3_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_round_trip(_table(spark, sf_dir, "documents"), default_tokenizer())
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    cleaned = dedup_lines(docs, duplicate_lines(docs), report=True)
    return cleaned.select(
        "doc_id",
        "removed_lines",
        F.array_join(F.col("sources").cast("array<string>"), ",").alias("sources"),
        F.length("text").cast("long").alias("kept_chars"),
        F.sha2("text", 256).alias("kept_sha256"),
    )


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(_table(spark, sf_dir, "documents"))


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "embeddings")
    return exact_topk(rows, rows.where("vec_id % 50 = 0"))


def op8_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    chats = format_chats(turns.unionByName(probe)).withColumn("loss", loss_text(F.col("rendered"), F.col("loss_spans")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return chats.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("rendered").cast("long").alias("formatted_chars"),
    )


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_quality(docs, fit_quality(docs, _table(spark, sf_dir, "labels")))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = cluster(_table(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    hashed = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return made.select("doc_id", F.col("n_units").alias("n"), "form", "prefix_chars", "middle_chars", *hashed)


OPERATORS = (
    op1_packing,
    op2_substring_dedup,
    op3_bpe,
    op4_line_dedup,
    op5_license_scan,
    op6_exact_dedup,
    op7_topk,
    op8_chat_format,
    op9_toxicity,
    op10_minhash,
    op11_quality,
    op12_clusters,
    op13_fill_in_middle,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": OP6_SQL, "op7_topk": OP7_SQL, "op8_chat_format": OP8_SQL, "op12_clusters": OP12_SQL, "op13_fill_in_middle": OP13_SQL}


OP6_SQL = """
WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents),
g AS (SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY norm)
SELECT t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id AS kept, sha256(t.norm) AS text_sha256
FROM t JOIN g ON t.norm = g.norm
"""

OP7_SQL = """
WITH v AS (
  SELECT vec_id, [floor(256 * x::DOUBLE)::BIGINT for x in embedding] AS q FROM embeddings
  WHERE len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
t AS (SELECT vec_id, unnest(q) AS w, generate_subscripts(q, 1) AS term FROM v),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id, sum(a.w * b.w)::BIGINT AS score FROM t a JOIN t b ON a.term = b.term AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0 GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP8_SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_matches(text, '</?s>|\[/?INST\]|\\[012]') AS hit, regexp_matches(role, '</?s>|\[/?INST\]|\\[012]') AS role_hit,
    length(text) + length(text) - length(replace(text, '\', '')) AS esc0,
    len(regexp_extract_all(text, '</?s>|\[/?INST\]')) AS marks,
    length(role) + length(role) - length(replace(role, '\', '')) + len(regexp_extract_all(role, '</?s>|\[/?INST\]')) AS esc_role
  FROM t)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
  sum(22 + CASE WHEN hit OR role_hit THEN esc_role + esc0 + marks ELSE length(role) + length(text) END)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""

_ASSIGNED = """a{0} AS MATERIALIZED (
  SELECT v.vec_id, v.row, v.q, min({{'d': list_sum(list_transform(list_zip(v.q, c.q), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::HUGEINT, 'k': c.k}}) AS m
  FROM v, c{0} c GROUP BY ALL)"""
_MOVED = """s{0} AS (SELECT m.k AS k, i, floor_div(sum(x), count(*)) AS x FROM (SELECT m, unnest(q)::HUGEINT AS x, generate_subscripts(q, 1) AS i FROM a{0}) GROUP BY ALL),
c{1} AS MATERIALIZED (SELECT c.k, coalesce(n.q, c.q) AS q FROM c{0} c LEFT JOIN (SELECT k, list(x::BIGINT ORDER BY i) AS q FROM s{0} GROUP BY k) n ON n.k = c.k)"""
_ROUNDS = ",\n".join(_ASSIGNED.format(i) + ",\n" + _MOVED.format(i, i + 1) for i in range(10)) + ",\n" + _ASSIGNED.format(10)
OP12_SQL = f"""
WITH v AS MATERIALIZED (
  SELECT vec_id, row_number() OVER () AS row, [floor(1024 * x::DOUBLE)::BIGINT for x in embedding] AS q FROM embeddings
  WHERE len(embedding) = 64 AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('3:' || coalesce(vec_id::VARCHAR, '')), q) - 1)::INT AS k, q FROM v QUALIFY k < 8),
{_ROUNDS}
SELECT vec_id, m.k AS cluster, m.d::BIGINT AS distance, (sum(m.d) OVER (PARTITION BY m.k))::BIGINT AS cluster_inertia, (sum(m.d) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(c.q, ',')) AS centroid_sha256
FROM a10 JOIN c10 c ON c.k = m.k
""".replace("floor_div(sum(x), count(*))", "(sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*)")

OP13_SQL = """
WITH t AS (SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents),
u AS (SELECT *, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS w, [('0x' || substr(h, 1 + 8 * i, 8))::BIGINT for i in range(4)] AS r FROM t),
x AS (
  SELECT *, len(w) AS n, least(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS a, greatest(r[1] % (len(w) + 1), r[2] % (len(w) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR r[3] % 100 >= 90 THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
y AS (SELECT *, array_to_string(w[1:a], '') AS prefix, array_to_string(w[a + 1:b], '') AS middle, array_to_string(w[b + 1:], '') AS suffix FROM x)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
  sha256(text) AS restored_sha256
FROM y
"""
