"""Chat formatting with a grammar round trip, DataFrame functions only.

Grammar of a conversation (fixed values: the four control strings)::

    conversation = turn*
    turn         = "<s>[INST] " role " [/INST]" body "</s>"

No role or body may hold a control string (``<s> </s> [INST] [/INST]``), and the
parser reads ``\\0 \\1 \\2`` in them as a backslash, ``<`` and ``[``.  Each turn
is first rendered as it is and parsed again; where the parser does not return
the source, the turn is escaped.  The whole rendered conversation is then parsed
and compared with its source; a difference stops the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, MIDDLE, CLOSE = "<s>[INST] ", " [/INST]", "</s>"
CONTROL = r"</?s>|\[/?INST\]"


def _escape(x: Column) -> Column:
    x = F.replace(x, F.lit("\\"), F.lit("\\0"))
    x = F.regexp_replace(x, r"<(?=/?s>)", r"\\1")
    return F.regexp_replace(x, r"\[(?=/?INST\])", r"\\2")


def _unescape(x: Column) -> Column:
    for code, char in (("\\2", "["), ("\\1", "<"), ("\\0", "\\")):
        x = F.replace(x, F.lit(code), F.lit(char))
    return x


def _turn(role: Column, body: Column) -> Column:
    return F.concat(F.lit(OPEN), role, F.lit(MIDDLE), body, F.lit(CLOSE))


def parse(rendered: Column) -> Column:
    """Turns of a rendered conversation: array of (role, text); null fields where a turn breaks the grammar."""
    raw = F.filter(F.split(rendered, CLOSE, -1), lambda t: t != "")

    def one(t: Column) -> Column:
        head = F.substring_index(t, MIDDLE, 1)
        role, body = F.substr(head, F.lit(len(OPEN) + 1)), F.substr(t, F.length(head) + F.lit(len(MIDDLE) + 1))
        good = F.startswith(t, F.lit(OPEN)) & F.contains(t, F.lit(MIDDLE)) & ~role.rlike(CONTROL) & ~body.rlike(CONTROL)
        return F.struct(F.when(good, _unescape(role)).alias("role"), F.when(good, _unescape(body)).alias("text"))

    return F.transform(raw, one)


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", loss_role: str = "assistant") -> DataFrame:
    """One row per conversation: conv_id, rendered, turns (parsed back), loss_spans.

    ``loss_spans`` are (start, length) in characters of the texts of ``loss_role``
    within ``rendered``.  Rows are put in order of turn, then role, then text, so
    repeated turns have a place; a null turn comes first.  Null roles and texts
    count as empty; a null conversation id is a conversation of its own.  No rows
    give no rows.  Other columns are ignored.
    """
    source = turns.select(
        F.col(conv).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.coalesce(F.col(role).cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )
    same = parse(_turn(F.col("role"), F.col("text"))) == F.array(F.struct(F.col("role").alias("role"), F.col("text").alias("text")))
    keep = F.coalesce(same, F.lit(False))
    pieces = source.withColumns({"as_is": keep}).withColumns(
        {n: F.when(F.col("as_is"), F.col(c)).otherwise(_escape(F.col(c))) for n, c in (("head", "role"), ("body", "text"))}
    )
    so_far = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    extra = len(OPEN) + len(MIDDLE) + len(CLOSE)
    placed = pieces.withColumn("at", F.coalesce(F.sum(F.length("head") + F.length("body") + F.lit(extra)).over(so_far), F.lit(0)))
    chats = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text", "at", "head", "body"))).alias("t"))
    chats = chats.select(
        "conv_id",
        F.array_join(F.transform("t", lambda x: _turn(x["head"], x["body"])), "").alias("rendered"),
        F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("source"),
        F.transform(
            F.filter("t", lambda x: x["role"] == loss_role),
            lambda x: F.struct(
                (x["at"] + F.length(x["head"]) + F.lit(len(OPEN) + len(MIDDLE))).alias("start"), F.length(x["body"]).cast("long").alias("length")
            ),
        ).alias("loss_spans"),
    )
    return chats.withColumn("turns", parse(F.col("rendered"))).select(
        "conv_id",
        "rendered",
        F.when(F.col("turns") == F.col("source"), F.col("turns")).otherwise(F.raise_error(F.lit("round trip failed"))).alias("turns"),
        "loss_spans",
    )


def loss_text(rendered: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, in order, nothing between."""
    return F.array_join(F.transform(spans, lambda s: _unescape(F.substr(rendered, s["start"] + F.lit(1), s["length"]))), "")
