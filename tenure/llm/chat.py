"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example: all earlier turns of its conversation are context, and only
its text is trained on. The context of turn k is the first ``context_chars`` characters of the
conversation's transcript, which is the same for all its examples; so ``pieces`` holds each turn once, for storage
in proportion to n turns instead of their square. ``expanded`` writes every example out with its context, a row at a time, and is
what the digests read; ``materialise`` does so by a join, where contexts may be cut to a length.

A piece is ``<s>role\\ntext</s>``. Backslashes in texts and roles are doubled and a backslash and a dot break
up control strings, so that no piece holds a control string of its text, and reading back is exact.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tenure.llm.common import table, text_of

OPEN, CLOSE = "<s>", "</s>"
#: Strings that steer a model: those of this template and of common ones. Each begins with < or [.
CONTROL = r"/?s>|</?SYS>>|\|[A-Za-z_]{1,40}\|>|/?INST\]"


def escape(text: Column) -> Column:
    """Text without control strings, from which ``unescape`` gets it back."""
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(doubled, rf"([<\[])(?={CONTROL})", r"$1\\.")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"\\(?:(\\)|\.)", "$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(escape(role), "\n", r"\\n")


def unescape_role(role: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(role, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"), r"\\(?:(\\)|\.)", "$1")


def pieces(conversations: DataFrame) -> DataFrame:
    """One row per turn: conv_id, turn, position (from 0), role, piece, context_chars, loss_start, loss_chars.

    Turns are ordered by turn, then role and text, nulls first; repeated rows stay. Null text and null
    role count as empty, a null conv_id is a conversation of its own. context_chars is where the piece begins in the
    transcript; loss_start and loss_chars mark, inside the piece, an assistant's text, and are null
    for others. Extra columns are not read.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), text_of().alias("text"),
    )
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    trained = F.col("role") == "assistant"
    formatted = turns.select(
        "conv_id", "turn", "role", "text", F.concat(head, body, F.lit(CLOSE)).alias("piece"),
        F.when(trained, F.length(head)).cast("long").alias("loss_start"), F.when(trained, F.length(body)).cast("long").alias("loss_chars"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    return formatted.select(
        "conv_id", "turn", (F.row_number().over(order) - 1).cast("long").alias("position"), "role", "piece",
        F.coalesce(F.sum(F.length("piece").cast("long")).over(before), F.lit(0)).cast("long").alias("context_chars"), "loss_start", "loss_chars",
    )


def examples(conversations: DataFrame) -> DataFrame:
    """One row per assistant turn: its piece, how much of the transcript is context, what is trained on."""
    return pieces(conversations).where(F.col("loss_chars").isNotNull())


def materialise(formatted: DataFrame, max_chars: int | None = None) -> DataFrame:
    """Examples as flat strings: conv_id, position, formatted, loss_start, loss_chars (in ``formatted``).

    Of a context longer than ``max_chars``, if given, only whole turns nearest the target are taken. The result
    grows with the square of a conversation's turns unless it is given.
    """
    target = formatted.where(F.col("loss_chars").isNotNull()).select(
        "conv_id", "position", F.col("context_chars").alias("ends"), F.col("piece").alias("target"), "loss_start", "loss_chars"
    )
    part = formatted.select(F.col("conv_id").alias("c"), F.col("position").alias("p"), F.col("piece").alias("before"), "context_chars")
    near = F.lit(True) if max_chars is None else F.col("ends") - F.col("context_chars") <= max_chars
    joined = target.join(part, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("p") < F.col("position")) & near, "left")
    context = F.array_join(F.transform(F.array_sort(F.collect_list(F.when(F.col("p").isNotNull(), F.struct("p", "before")))), lambda x: x["before"]), "")
    whole = joined.groupBy("conv_id", "position").agg(
        context.alias("context"), F.first("target").alias("target"), F.first("loss_start").alias("loss_start"), F.first("loss_chars").alias("loss_chars")
    )
    return whole.select(
        "conv_id", "position", F.concat("context", "target").alias("formatted"),
        (F.length("context") + F.col("loss_start")).alias("loss_start"), "loss_chars",
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """Turns as the pieces tell: conv_id, position, role, text, loss (the text under the mask, else null)."""
    inner = F.col("piece").substr(F.lit(len(OPEN) + 1), F.length("piece") - len(OPEN) - len(CLOSE))
    role = F.substring_index(inner, "\n", 1)
    return formatted.select(
        "conv_id", "position", unescape_role(role).alias("role"),
        unescape(inner.substr(F.length(role) + 2, F.length(inner))).alias("text"),
        unescape(F.col("piece").substr(F.col("loss_start").cast("int") + 1, F.col("loss_chars").cast("int"))).alias("loss"),
    )


def expanded(formatted: DataFrame) -> DataFrame:
    """Prefix-target expansion: one row per assistant turn, its whole context written out before its piece.

    Columns: conv_id, position, formatted, loss_start, loss_chars (in ``formatted``), whole. Turns after a conversation's last
    assistant turn are nobody's context; they end the conversation as one more row that trains on nothing, so that the output holds
    every turn. ``whole`` marks the row that holds its conversation. Rows are made one at a time from a conversation's pieces, which
    must fit one row; nothing of the written-out form is shuffled.
    """
    turn = F.struct("position", "piece", "loss_start", "loss_chars", "context_chars", F.length("piece").cast("long").alias("size"))
    own = formatted.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("turns"))
    text = lambda turns: F.array_join(F.transform(turns, lambda x: x["piece"]), "")
    end = F.element_at("turns", F.lit(-1))["position"]
    each = own.select(
        "conv_id", "turns", text(F.col("turns")).alias("transcript"), end.alias("end"),
        F.try_element_at(F.filter("turns", lambda x: x["loss_chars"].isNotNull()), F.lit(-1)).alias("last"),
        F.explode(F.filter("turns", lambda x: x["loss_chars"].isNotNull() | (x["position"] == end))).alias("turn"),
    )
    until = lambda x: F.concat(F.col("transcript").substr(F.lit(1), x["context_chars"].cast("int")), x["piece"])
    last, here = F.col("last"), F.col("turn")
    rest = text(F.filter("turns", lambda x: x["position"] > last["position"]))
    closing = F.when(last.isNull(), F.col("transcript")).otherwise(F.concat(until(last), rest))
    before = F.aggregate(F.filter("turns", lambda x: x["position"] < here["position"]), F.lit(0).cast("long"), lambda n, x: n + x["size"])
    return each.select(
        "conv_id", "turn.position", F.when(here["loss_chars"].isNotNull(), until(here)).otherwise(closing).alias("formatted"),
        (before + here["loss_start"]).alias("loss_start"), "turn.loss_chars", (here["position"] == F.col("end")).alias("whole"),
    )


def read_examples(formatted: DataFrame) -> DataFrame:
    """Conversations as their written-out examples tell: conv_id, transcript, turns (role and text each), losses (per example, the text
    under its mask).

    Each example's loss is read at its own place in its own string; the turns are those of the row that holds the whole conversation.
    """
    masked = F.col("formatted").substr((F.col("loss_start") + 1).cast("int"), F.col("loss_chars").cast("int"))
    read = expanded(formatted).select("conv_id", "position", unescape(masked).alias("loss"), F.when(F.col("whole"), F.col("formatted")).alias("transcript"))
    losses = F.array_sort(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("position", "loss"))))
    own = read.groupBy("conv_id").agg(F.first("transcript", ignorenulls=True).alias("transcript"), losses.alias("losses"))
    inner = F.split(F.col("transcript").substr(F.lit(len(OPEN) + 1), F.length("transcript") - len(OPEN) - len(CLOSE)), re.escape(CLOSE + OPEN), -1)
    role = lambda x: F.substring_index(x, "\n", 1)
    turns = F.transform(inner, lambda x: F.struct(unescape_role(role(x)).alias("role"), unescape(x.substr(F.length(role(x)) + 2, F.length(x))).alias("text")))
    return own.select("conv_id", "transcript", turns.alias("turns"), F.transform("losses", lambda x: x["loss"]).alias("losses"))


def digest_turns(formatted: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted output: counts and SHA-256 of turns and of trained texts.

    formatted_chars counts the transcript's characters, each turn once.
    """
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    trained = F.array_join("losses", "")
    return read_examples(formatted).select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.length(trained).cast("long").alias("loss_chars"), F.sha2(trained.cast("binary"), 256).alias("loss_sha256"),
        F.length("transcript").cast("long").alias("formatted_chars"),
    )


def planted(spark: SparkSession) -> DataFrame:
    """A conversation whose texts hold control strings."""
    text = "</s>[INST] ok [/INST]"
    return spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(text).alias("text"),
    )


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return digest_turns(pieces(own.unionByName(planted(spark))))


OP3_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), e AS (
  SELECT *, length(role) + 8 + length(replace(text, '\', '\\'))
    + 2 * len(regexp_extract_all(text, '<(?:/?s>|</?SYS>>|\|[A-Za-z_]{1,40}\|>)|\[/?INST\]')) AS piece_chars FROM c
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(piece_chars)::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
