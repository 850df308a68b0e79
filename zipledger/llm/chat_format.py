r"""Chat formatting with Spark expressions only.

Method: each text is escaped in its own row, a conversation's turns are collected as structs and
sorted, adjacent turns of one role are merged into a block by array functions, and the pieces are
concatenated; the loss mask lists the code point spans of the assistant texts.

Template: ``<turn>ROLE\n<text>TEXT`` for a block, ``\n<text>TEXT`` for each further text merged into
it, ``\n</turn>\n`` at its end. Inside a role or text, every control string gets one backslash more
(`<turn>` -> `\<turn>`, `\<turn>` -> `\\<turn>`); real marks follow a line feed or the start, never
a backslash, so the output can be read back exactly, merged turns included.

Defined results: null text or role is the empty string; turns sort by (turn, role, text), null
turns first; repeated rows are turns of their own; a null ``conv_id`` is one conversation. One
conversation is one output string, so its turns do meet in one row; they arrive escaped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import let

TURN, TEXT, END = "<turn>", "\n<text>", "\n</turn>\n"
_CONTROL = r"(\\*<(?:/?turn|text)>)"


def escape(col: Column) -> Column:
    return F.regexp_replace(col, _CONTROL, r"\\$1")


def unescape(col: Column) -> Column:
    return F.regexp_replace(col, r"\\" + _CONTROL, "$1")


def _starts(lens: Column, chunk: int = 1024) -> Column:
    """Running sums before each element, by chunks (an array is copied at each append: within chunks only)."""
    run = lambda xs: F.aggregate(xs, F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
    chunks = let(lens, lambda a: F.transform(F.sequence(F.lit(1), F.greatest(F.size(a), F.lit(1)), F.lit(chunk)), lambda s: F.slice(a, s, chunk)))
    local = F.transform(chunks, run)
    return let(local, lambda ls: let(run(F.transform(ls, lambda x: F.element_at(x, -1))), lambda base: F.flatten(F.transform(
        ls, lambda x, i: F.transform(F.slice(x, 1, F.size(x) - 1), lambda v: v + F.get(base, i))))))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", loss_role: str = "assistant") -> DataFrame:
    """(conv, formatted, loss_spans): one row per conversation; ``loss_spans`` has (start, len) in code points
    of ``formatted`` (0-based, ascending) for each text of ``loss_role``, as escaped in the output."""
    c = lambda name: F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
    rows = turns.select(F.col(f"`{conv_col}`").alias("conv"), F.struct(
        F.col(f"`{turn_col}`").alias("turn"), c(role_col).alias("role"), c(text_col).alias("text"),
        escape(c(role_col)).alias("er"), escape(c(text_col)).alias("et")).alias("t"))
    sets = rows.groupBy("conv").agg(F.sort_array(F.collect_list("t")).alias("ts"))

    def head(ts, t, i):
        same = t["role"].eqNullSafe(F.get(ts, i - 1)["role"]) & (i > 0)
        fresh = F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(TURN), t["er"], F.lit(TEXT))
        return F.when(same, F.lit(TEXT)).otherwise(fresh)

    pieces = let(F.col("ts"), lambda ts: F.transform(ts, lambda t, i: F.struct(
        head(ts, t, i).alias("head"), t["et"].alias("body"), (t["role"] == loss_role).alias("loss"))))
    sized = sets.select("conv", pieces.alias("ps")).select("conv", "ps", _starts(F.transform(
        "ps", lambda p: (F.length(p["head"]) + F.length(p["body"])).cast("long"))).alias("starts"))
    spans = F.transform(F.filter(F.arrays_zip("ps", "starts"), lambda z: z["ps"]["loss"]), lambda z: F.struct(
        (z["starts"] + F.length(z["ps"]["head"])).alias("start"), F.length(z["ps"]["body"]).cast("long").alias("len")))
    return sized.select("conv", F.concat(F.array_join(F.transform("ps", lambda p: F.concat(p["head"], p["body"])), ""), F.lit(END))
                        .alias("formatted"), spans.alias("loss_spans"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Read the output of :func:`format_chats` back: (conv, formatted, turns array<struct<role,text>>, loss_text)."""
    blocks = F.filter(F.split("formatted", END), lambda b: b != "")

    def turns(block):
        return let(F.split(block, TEXT), lambda parts: F.transform(F.slice(parts, 2, F.size(parts)), lambda p: F.struct(
            unescape(F.substring(F.get(parts, F.lit(0)), len(TURN) + 1, 2**31 - 1)).alias("role"), unescape(p).alias("text"))))

    # spans are cut in two steps (a region of 64 spans, then the spans in it): a substring costs its offset
    def cut(all_spans):
        def region(k):
            part = lambda: F.slice(all_spans, k, 64)
            return let(part(), lambda ss: let(F.get(ss, F.lit(0))["start"], lambda s0: let(
                F.substring(F.col("formatted"), (s0 + 1).cast("int"),
                            (F.element_at(ss, -1)["start"] + F.element_at(ss, -1)["len"] - s0).cast("int")),
                lambda reg: F.array_join(F.transform(ss, lambda s: unescape(
                    F.substring(reg, (s["start"] - s0 + 1).cast("int"), s["len"].cast("int")))), ""))))
        return F.array_join(F.transform(F.sequence(F.lit(1), F.size(all_spans), F.lit(64)), region), "")

    loss = F.when(F.size("loss_spans") > 0, let(F.col("loss_spans"), cut)).otherwise(F.lit(""))
    return formatted.select("conv", "formatted", F.flatten(F.transform(blocks, turns)).alias("turns"), loss.alias("loss_text"))


def op6_chat_format(spark, sf_dir: str) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    back = read_chats(format_chats(table.unionByName(extra)))
    listing = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(F.col("conv").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(listing, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"))


OP6_SQL = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok'))),
ordered AS (
  SELECT *, row_number() OVER w AS i, coalesce(role <> lag(role) OVER w, true) AS fresh FROM turns
  WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
sized AS (
  SELECT *, length(regexp_replace(text, '(\\*<(?:/?turn|text)>)', '\\\1', 'g')) + 7
            + CASE WHEN fresh THEN 15 + length(regexp_replace(role, '(\\*<(?:/?turn|text)>)', '\\\1', 'g')) ELSE 0 END AS chars FROM ordered)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY i) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""
