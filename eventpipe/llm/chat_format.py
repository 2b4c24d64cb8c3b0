"""Chat formatting with a grammar round trip.

A conversation is rendered turn by turn, without anything between turns::

    user       [INST]TEXT[/INST]
    assistant  <s>TEXT</s>
    system     <<SYS>>TEXT<</SYS>>
    any other  <|turn:ROLE|>TEXT<|end|>

``&`` in texts is always written ``&amp;``. Escaping a text further turns
``<`` into ``&lt;``, ``[`` into ``&lsb;`` and ``|`` into ``&bar;``; reading back
undoes all four, ``&amp;`` last. Roles in a header are always escaped.

A deterministic parser cuts the rendered text at the end marks and takes each
piece's role from its header. It rejects a text that still holds a control
string. The turns it recovers are compared with the source, and rendering goes
up by levels until they are identical: level 0 escapes no text further, level 1
those with a control string, level 2 all. At level 2 no text holds ``<`` or
``[``, with which every control string begins.

Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from eventpipe.llm.common import sha256_hex

MARKS = {"user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>"), "system": ("<<SYS>>", "<</SYS>>")}
OTHER_OPEN, OTHER_CLOSE, OTHER_END = "<|turn:", "|>", "<|end|>"
CONTROL = [mark for pair in MARKS.values() for mark in pair] + [OTHER_OPEN, OTHER_END]
END_MARKS = r"\[/INST\]|</s>|<</SYS>>|<\|end\|>"
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lsb;"), ("|", "&bar;"))
LOSS_ROLE = "assistant"
LEVELS = 3
# The conversation that every run of the query adds.
PROBE_TEXT = "</s>[INST] ok [/INST]"


def escape(text: Column, further: bool = True) -> Column:
    for plain, code in ESCAPES if further else ESCAPES[:1]:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def holds_control(text: Column) -> Column:
    found = F.lit(False)
    for mark in CONTROL:
        found = found | text.contains(mark)
    return found


def by_role(role: Column, which: int, other: Column) -> Column:
    out = other
    for name, marks in MARKS.items():
        out = F.when(role == name, marks[which]).otherwise(out)
    return out


def render(turns: Column, level: int) -> Column:
    """Array of (role, text) as one text."""

    def one(turn: Column) -> Column:
        text = turn["text"]
        further = {0: F.lit(False), 1: holds_control(text), 2: F.lit(True)}[level]
        opened = F.concat(F.lit(OTHER_OPEN), escape(turn["role"]), F.lit(OTHER_CLOSE))
        return F.concat(
            by_role(turn["role"], 0, opened),
            F.when(further, escape(text)).otherwise(escape(text, False)),
            by_role(turn["role"], 1, F.lit(OTHER_END)),
        )

    return F.array_join(F.transform(turns, one), "")


def pieces(rendered: Column) -> Column:
    """Array of (role, body, head_chars, end_chars): what stands before each end mark, cut at its header.

    A piece without header, or with a control string in its body, has a null
    role, so it equals no source turn.
    """

    def cut(piece: Column) -> Column:
        head = F.substring_index(piece, OTHER_CLOSE, 1)
        named = piece.startswith(OTHER_OPEN) & piece.contains(OTHER_CLOSE)
        role = F.when(named, unescape(F.substr(head, F.lit(len(OTHER_OPEN) + 1))))
        size = F.when(named, F.char_length(head) + len(OTHER_CLOSE)).otherwise(0)
        for name, (opened, _) in MARKS.items():
            role = F.when(piece.startswith(opened), name).otherwise(role)
            size = F.when(piece.startswith(opened), len(opened)).otherwise(size)
        body = F.substr(piece, size + 1)
        end = F.lit(len(OTHER_END))
        for name, (_, closed) in MARKS.items():
            end = F.when(role == name, len(closed)).otherwise(end)
        return F.struct(
            F.when(~holds_control(body), role).alias("role"),
            body.alias("body"),
            size.alias("head_chars"),
            end.alias("end_chars"),
        )

    parts = F.split(rendered, F.lit(END_MARKS), F.lit(-1))
    # After the last end mark stands nothing; anything else would be an unended turn.
    ended = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)
    return F.transform(ended, cut)


def parse(rendered: Column) -> Column:
    """Array of (role, text), read back from a rendered text."""
    return F.transform(
        pieces(rendered), lambda p: F.struct(p["role"].alias("role"), unescape(p["body"]).alias("text"))
    )


def loss_mask(rendered: Column) -> Column:
    """Run lengths over the rendered text, turn by turn: (head_chars, body_chars, end_chars, in_loss).

    Of each turn only the body can be under the loss mask; the runs add up to
    the length of the text.
    """
    return F.transform(
        pieces(rendered),
        lambda p: F.struct(
            p["head_chars"].alias("head_chars"),
            F.char_length(p["body"]).alias("body_chars"),
            p["end_chars"].alias("end_chars"),
            (p["role"] == LOSS_ROLE).alias("in_loss"),
        ),
    )


def conversations_of(rows: DataFrame) -> DataFrame:
    """One row per conversation: (conv_id, turns), in the order of turn, then role, then text.

    A conversation is one training example, so its turns meet in one row; many
    conversations never do.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    turn = F.struct(F.col("turn"), role.alias("role"), text.alias("text"))
    return (
        rows.groupBy("conv_id")
        .agg(F.array_sort(F.collect_list(turn)).alias("all"))
        .select(
            "conv_id",
            F.transform("all", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))).alias("turns"),
        )
    )


def format_conversations(rows: DataFrame) -> DataFrame:
    """(conv_id, formatted, level) of rows (conv_id, turn, role, text, more).

    ``level`` is the first whose text reads back as the source turns. Null
    roles and texts are empty, a null turn sorts first, repeated rows are
    repeated turns, and rows without conv_id form one conversation. Other
    columns are ignored. An empty table gives an empty one.
    """
    frame = conversations_of(rows)
    formatted, level = F.lit(None).cast("string"), F.lit(None).cast("int")
    for n in reversed(range(LEVELS)):
        text = render(F.col("turns"), n)
        same = parse(text) == F.col("turns")
        formatted = F.when(same, text).otherwise(formatted)
        level = F.when(same, n).otherwise(level)
    # A one-row generator: the rendered text is worked out once, not in every use of it.
    found = F.explode(F.array(F.struct(formatted.alias("formatted"), level.alias("level")))).alias("found")
    return frame.select("conv_id", found).select("conv_id", "found.*")


def read_back(formatted: DataFrame) -> DataFrame:
    """(conv_id, turns, loss_mask, loss_text, formatted, level) from the formatted text alone.

    ``loss_text`` is all text under the mask, unescaped.
    """
    turns = F.explode(F.array(parse(F.col("formatted")))).alias("turns")
    spoken = F.filter("turns", lambda t: t["role"] == LOSS_ROLE)
    return formatted.select("*", turns).select(
        "conv_id",
        "turns",
        loss_mask(F.col("formatted")).alias("loss_mask"),
        F.array_join(F.transform(spoken, lambda t: t["text"]), "").alias("loss_text"),
        "formatted",
        "level",
    )


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ``conversations`` and conversation -1, formatted and read back."""
    given = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    probe = spark.createDataFrame(
        [(-1, 0, "user", PROBE_TEXT), (-1, 1, "assistant", PROBE_TEXT)], given.schema
    )
    back = read_back(format_conversations(given.unionByName(probe)))
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        sha256_hex(F.array_join(spoken, "")).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        sha256_hex(F.col("loss_text")).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


ORACLE = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
),
escaped AS (
  SELECT *, replace(text, '&', '&amp;') AS plain,
    replace(replace(replace(replace(text, '&', '&amp;'), '<', '&lt;'), '[', '&lsb;'), '|', '&bar;') AS safe,
    replace(replace(replace(replace(role, '&', '&amp;'), '<', '&lt;'), '[', '&lsb;'), '|', '&bar;') AS safe_role,
    len(list_filter(['[INST]', '[/INST]', '<s>', '</s>', '<<SYS>>', '<</SYS>>', '<|turn:', '<|end|>'],
      lambda mark: contains(text, mark))) > 0 AS control
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  sum(length(CASE WHEN control THEN safe ELSE plain END) + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 7
    WHEN 'system' THEN 15 ELSE 16 + length(safe_role) END)::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""
