"""Chat formatting with typed content parts.

A message is a list of typed parts.  The visitor :func:`visit_parts` flattens
them, in order, into one string: text parts are copied (neighbours are joined,
then escaped), image, audio and document parts become placeholders, each with an
attachment reference and the number of tokens into which the placeholder expands.  A conversation is its
turns in order between ``<s>`` and ``</s>``, a turn being

    <|role|>ROLE<|text|>FLATTENED<|end|>

and the loss mask is a run-length list over the formatted text (characters,
loss yes or no), three runs a turn.

Control strings inside texts and roles get a backslash after their first
character (``<|`` becomes ``<\\|``); a control string that already has such
backslashes gets one more, so taking one away restores every text.

All of it is native column code.  Turns are formatted where they are read;
conversations are put together in two steps (blocks of 64 turn numbers, then
blocks), so one very long conversation is not sorted row by row in one task.

Defined cases: null text or null parts are empty; a null role is empty; rows are
ordered by turn (null first), then role, then text, and repeated rows stay; a
null conversation id is a conversation of its own; parts of any other type are
kept as placeholders ``<|unknown|>`` that expand to no token, their type and
reference among the attachments; an empty table gives none; extra
columns are ignored.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import barrier

PART_TYPE = ("struct<type:string,text:string,ref:string,width:int,height:int,"
             "seconds:double,pages:int>")
#: Types whose placeholder bears their name.
PLACEHOLDERS = ("image", "audio", "document")
ROLE, TEXT, END, BOS, EOS = "<|role|>", "<|text|>", "<|end|>", "<s>", "</s>"
#: First character, escapes so far, and the rest of any control string.
CONTROL = r"(<|\[)(\\*)(\||/?s>|/?INST\])"
ESCAPED = r"(<|\[)\\(\\*)(\||/?s>|/?INST\])"
TURNS_PER_BLOCK = 64
#: How far attachments expand.
IMAGE_PATCH, AUDIO_TOKENS_PER_SECOND, TOKENS_PER_PAGE = 28, 25, 512


def escape(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2$3")


def text_part(text: Column) -> Column:
    """A message of a single text part."""
    null = F.lit(None)
    return F.array(F.struct(F.lit("text").alias("type"), text.cast("string").alias("text"),
                            null.cast("string").alias("ref"), null.cast("int").alias("width"),
                            null.cast("int").alias("height"), null.cast("double").alias("seconds"),
                            null.cast("int").alias("pages")))


def _expanded(part: Column) -> Column:
    """Tokens into which a part's placeholder expands."""
    def tiles(side):
        return F.ceil(F.greatest(F.coalesce(side, F.lit(0)), F.lit(0)) / IMAGE_PATCH)
    return (F.when(part["type"] == "image", tiles(part["width"]) * tiles(part["height"]))
            .when(part["type"] == "audio", F.ceil(F.greatest(F.coalesce(part["seconds"], F.lit(0.0)), F.lit(0.0))
                                                  * AUDIO_TOKENS_PER_SECOND))
            .when(part["type"] == "document", F.greatest(F.coalesce(part["pages"], F.lit(0)), F.lit(0)) * TOKENS_PER_PAGE)
            .otherwise(F.lit(0))).cast("long")


def visit_parts(parts: Column) -> tuple[Column, Column]:
    """(flattened text, attachments) of a message's parts, in order."""
    parts = F.coalesce(parts, F.array().cast(f"array<{PART_TYPE}>"))
    is_text = lambda p: p["type"].eqNullSafe("text")
    texts = F.transform(parts, lambda p: F.when(is_text(p), F.coalesce(p["text"], F.lit(""))).otherwise(F.lit("")))
    other = F.filter(F.transform(parts, lambda p, i: F.struct(
        (i + 1).alias("at"), (~is_text(p)).alias("other"),
        F.when(p["type"].isin(*PLACEHOLDERS), p["type"]).otherwise(F.lit("unknown")).alias("name"))), lambda p: p["other"])
    # An array of one element, so that both are worked out once.
    flat = F.element_at(F.transform(F.array(F.struct(texts.alias("texts"), other.alias("other"))), _flatten), 1)
    attached = F.transform(F.filter(parts, lambda p: ~p["type"].eqNullSafe("text")),
                           lambda p: F.struct(p["type"].alias("type"), p["ref"].alias("ref"),
                                              _expanded(p).alias("n_tokens")))
    return flat, attached


def _flatten(parts: Column) -> Column:
    """Neighbouring texts are joined before they are escaped, so that no control
    string can come about where they meet."""
    texts, other = parts["texts"], parts["other"]

    def run(begin: Column, end: Column) -> Column:
        return escape(F.array_join(F.slice(texts, begin, end - begin), ""))

    def begin(i: Column) -> Column:
        return F.when(i == 0, F.lit(1)).otherwise(F.get(other, i - 1)["at"] + 1)

    return F.concat(
        F.array_join(F.transform(other, lambda p, i: F.concat(run(begin(i), p["at"]), F.lit("<|"), p["name"], F.lit("|>"))), ""),
        run(begin(F.size(other)), F.size(texts) + 1))


def format_conversations(messages: DataFrame, id_col: str = "conv_id", turn_col: str = "turn",
                         role_col: str = "role", parts_col: str = "parts",
                         loss_role: str = "assistant") -> DataFrame:
    """(id, formatted, mask, attachments) per conversation."""
    role = escape(F.coalesce(F.col(f"`{role_col}`"), F.lit("")))
    flat, attached = visit_parts(F.col(f"`{parts_col}`"))
    turns = messages.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{turn_col}`").alias("turn"),
                            role.alias("role"), flat.alias("flat"), attached.alias("attached"),
                            F.coalesce(F.col(f"`{role_col}`") == loss_role, F.lit(False)).alias("loss"))
    block = F.floor(F.col("turn") / TURNS_PER_BLOCK)
    rows = F.sort_array(F.collect_list(F.struct("turn", "role", "flat", "loss", "attached")))
    blocks = turns.groupBy("id", block.alias("block")).agg(rows.alias("rows")).select(
        "id", "block",
        F.array_join(F.transform("rows", lambda t: F.concat(F.lit(ROLE), t["role"], F.lit(TEXT), t["flat"], F.lit(END))), "")
        .alias("formatted"),
        F.flatten(F.transform("rows", lambda t: F.array(
            _run(F.length(t["role"]) + len(ROLE + TEXT), F.lit(False)), _run(F.length(t["flat"]), t["loss"]),
            _run(F.lit(len(END)), F.lit(False))))).alias("mask"),
        F.flatten(F.transform("rows", lambda t: t["attached"])).alias("attachments"))
    whole = F.sort_array(F.collect_list(F.struct("block", "formatted", "mask", "attachments")))
    done = barrier(
        blocks.groupBy("id").agg(whole.alias("blocks")),
        formatted=F.concat(F.lit(BOS), F.array_join(F.transform("blocks", lambda b: b["formatted"]), ""), F.lit(EOS)),
        mask=F.concat(F.array(_run(F.lit(len(BOS)), F.lit(False))), F.flatten(F.transform("blocks", lambda b: b["mask"])),
                      F.array(_run(F.lit(len(EOS)), F.lit(False)))),
        attachments=F.flatten(F.transform("blocks", lambda b: b["attachments"])))
    return done.select(F.col("id").alias(id_col), "formatted", "mask", "attachments")


def _run(n: Column, loss: Column) -> Column:
    return F.struct(n.cast("long").alias("n"), loss.alias("loss"))


def read_back(formatted: Column, mask: Column) -> tuple[Column, Column]:
    """(turns, loss texts) of a formatted conversation, unescaped.

    The control strings split the text (none is left inside a turn), and turn
    i's text is run 3i + 2 of the mask.
    """
    inner = F.substring(formatted, F.lit(len(BOS) + 1), F.length(formatted) - len(BOS + EOS))
    pieces = F.split(inner, re.escape(END))
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)
    turns = F.transform(pieces, lambda p: F.struct(
        unescape(F.substring_index(F.regexp_replace(p, r"^<\|role\|>", ""), TEXT, 1)).alias("role"),
        unescape(F.regexp_replace(p, r"^<\|role\|>(?s:.*?)<\|text\|>", "")).alias("text")))
    lossy = F.filter(F.transform(turns, lambda t, i: F.struct(t["text"].alias("text"),
                                                             F.get(mask, i * 3 + 2)["loss"].alias("loss"))),
                     lambda t: t["loss"])
    return turns, F.transform(lossy, lambda t: t["text"])


def digest(formatted: DataFrame, id_col: str = "conv_id") -> DataFrame:
    """What is read back from formatted conversations."""
    turns, losses = read_back(F.col("formatted"), F.col("mask"))
    read = barrier(formatted.select(id_col, "formatted", "mask"), turns=turns, loss=F.array_join(losses, ""))
    spoken = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        F.col(id_col), F.size("turns").cast("long").alias("n_turns"), F.sha2(spoken, 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"), F.sha2(F.col("loss"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


#: Fixed value: both texts of the added conversation -1.
PLANTED = "</s>[INST] ok [/INST]"

ORACLE_SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (SELECT *, length(regexp_replace(text, '(<|\[)(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g'))
              + length(regexp_replace(role, '(<|\[)(\\*)(\||/?s>|/?INST\])', '\1\\\2\3', 'g'))
              + length('<|role|><|text|><|end|>') AS n FROM c)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       (sum(n) + length('<s></s>'))::BIGINT AS formatted_chars
FROM e GROUP BY conv_id
"""
