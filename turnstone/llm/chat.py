r"""Chat formatting by prefix-target expansion.

Every assistant turn becomes an example of its own: all turns before it are
context and only its text is trainable. A conversation that does not end in an
assistant turn has one more example, without a trainable part, so that no turn
is lost. One example's ``text`` is the whole formatted prefix with the reply;
``start`` and ``length`` (code points) are the trainable span.

Template: ``[INST]`` user ``[/INST]``, ``[SYS]`` system ``[/SYS]``, ``<s>``
assistant ``</s>``, and ``[ROLE]`` role ``[ROLE/]`` text ``[/ROLE]`` for any
other role. Texts are escaped: a backslash is doubled, and a backslash follows
every ``[`` and ``<``, so that no control string can appear in a text, and
reading the escapes from left to right gives the text back.

Turns are ordered by (turn, role, text). A conversation is one unit: its
examples contain each other's prefixes, so the output of one conversation grows
with the square of its length by definition of the method; conversations are
independent of each other.

Defined cases: a null text is empty, a null role is the empty role; turns that
repeat are kept in the stated order; rows without a conv_id form one
conversation. Further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

#: control strings before and after a text, by role (fixed values)
MARKS = {"user": ("[INST]", "[/INST]"), "system": ("[SYS]", "[/SYS]"), "assistant": ("<s>", "</s>")}
_TURN = r"(?s)\[INST\].*?\[/INST\]|\[SYS\].*?\[/SYS\]|<s>.*?</s>|\[ROLE\].*?\[/ROLE\]"


def escape(c):
    return F.replace(F.replace(F.replace(c, F.lit("\\"), F.lit("\\\\")), F.lit("["), F.lit("[\\")), F.lit("<"), F.lit("<\\"))


def unescape(c):
    return F.regexp_replace(c, r"([\[<])\\|\\(\\)", "$1$2")


def examples(conversations: DataFrame) -> DataFrame:
    """One row per example: conv_id, example, target_turn, text, start, length."""
    c = conversations
    role, text = F.coalesce(c["role"], F.lit("")), F.coalesce(c["text"], F.lit(""))
    head = F.concat(F.lit("[ROLE]"), escape(role), F.lit("[ROLE/]"))
    tail = F.lit("[/ROLE]")
    for name, (a, b) in MARKS.items():
        head = F.when(role == name, F.lit(a)).otherwise(head)
        tail = F.when(role == name, F.lit(b)).otherwise(tail)
    turns = c.select(c["conv_id"], c["turn"], role.alias("role"), text.alias("raw"), escape(text).alias("body"),
                     head.alias("head"), tail.alias("tail"))
    order = W.partitionBy("conv_id").orderBy("turn", "role", "raw")
    whole = W.partitionBy("conv_id")
    t = (turns.withColumn("n", F.row_number().over(order)).withColumn("last", F.count(F.lit(1)).over(whole))
         .withColumn("parts", F.collect_list(F.concat("head", "body", "tail")).over(
             order.rowsBetween(W.unboundedPreceding, W.currentRow))))
    reply = F.col("role") == "assistant"
    t = t.where(reply | (F.col("n") == F.col("last"))).withColumn("text", F.array_join("parts", ""))
    after = F.when(reply, F.length("body") + F.length("tail")).otherwise(0)
    return t.select("conv_id", F.col("n").alias("example"), F.when(reply, F.col("turn")).alias("target_turn"), "text",
                    (F.length("text") - after).alias("start"), F.when(reply, F.length("body")).otherwise(0).alias("length"))


def read_back(formatted: DataFrame) -> DataFrame:
    """Digest per conversation from its examples alone: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256,
    formatted_chars."""
    target = unescape(F.substring(F.col("text"), F.col("start") + 1, F.col("length")))
    # only the last example of a conversation is read as turns; the others give their spans
    own = formatted.select("conv_id", "example", "target_turn", target.alias("target"), "text")
    g = own.groupBy("conv_id").agg(
        F.max_by("text", "example").alias("longest"),
        F.array_sort(F.collect_list(F.when(F.col("target_turn").isNotNull() | (F.length("target") > 0),
                                           F.struct("example", "target")))).alias("targets"),
        F.sum(F.length("text")).cast("bigint").alias("formatted_chars"))
    parts = F.regexp_extract_all("longest", F.lit(_TURN), F.lit(0))

    def line(p):
        out = F.concat(unescape(F.regexp_extract(p, r"(?s)^\[ROLE\](.*?)\[ROLE/\]", 1)), F.lit("\n"),
                       unescape(F.regexp_extract(p, r"(?s)\[ROLE/\](.*)\[/ROLE\]$", 1)), F.lit("\n"))
        for name, (a, b) in MARKS.items():
            body = F.substring(p, F.lit(len(a) + 1), F.length(p) - len(a) - len(b))
            out = F.when(F.startswith(p, F.lit(a)), F.concat(F.lit(name + "\n"), unescape(body), F.lit("\n"))).otherwise(out)
        return out

    loss = F.array_join(F.transform("targets", lambda x: x["target"]), "")
    return g.select("conv_id", F.size(parts).cast("bigint").alias("n_turns"),
                    F.sha2(F.array_join(F.transform(parts, line), ""), 256).alias("turns_sha256"),
                    F.length(loss).cast("bigint").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"),
                    "formatted_chars")


SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
l AS (
  SELECT *, length(text) + length(text) - length(replace(text, '\', '')) + length(text) - length(replace(text, '[', ''))
         + length(text) - length(replace(text, '<', ''))
         + CASE role WHEN 'user' THEN 13 WHEN 'system' THEN 11 WHEN 'assistant' THEN 7
           ELSE 20 + length(role) + length(role) - length(replace(role, '\', '')) + length(role) - length(replace(role, '[', ''))
                + length(role) - length(replace(role, '<', '')) END AS chars,
         row_number() OVER w AS n, count(*) OVER (PARTITION BY conv_id) AS last
  FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
s AS (SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY n) AS upto FROM l)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (WHERE role = 'assistant' OR n = last) AS BIGINT) AS formatted_chars
FROM s GROUP BY conv_id
"""
