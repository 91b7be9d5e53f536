"""Chat formatting with a grammar that reads its own output back.

A conversation is rendered as its turns in order, each between an opening and a closing control string:
``<<SYS>>..<</SYS>>`` for system, ``[INST]..[/INST]`` for user, ``<s>..</s>`` for assistant, and
``<<ROLE=name>>..<</ROLE>>`` for any other role. The text is read back by a deterministic parser and
compared with its source: first with only the turns escaped that hold a control string, then, where a
conversation still does not come back as it was, with all its turns escaped. Escaping puts a backslash
after each backslash and each ``<``, ``>`` and ``[``, so that no control string is left whole and every
text comes back; the parser takes it away again.

The loss mask is the stretches between ``<s>`` and ``</s>``: positions in characters of the rendered
text, read from it.

Defined cases: null text and null role are empty; a null conversation id is an id; turns go by number,
null first, equal numbers by role and text, repeated rows stay; an empty table gives no rows; other
columns are left out. A conversation becomes one text, so it has to fit into one row; rendering and
escaping happen before rows of a conversation meet.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paceline.llm.tables import text_of

# The control strings.
MARKS = {"system": ("<<SYS>>", "<</SYS>>"), "user": ("[INST]", "[/INST]"), "assistant": ("<s>", "</s>")}
OTHER = ("<<ROLE=", ">>", "<</ROLE>>")
CONTROL = r"<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|<<ROLE=|<</ROLE>>"
# One turn: its opening string, the name of another role, the text up to the first closing string.
TURN = r"(?s)(<s>|\[INST\]|<<SYS>>|<<ROLE=(.*?)>>)(.*?)(</s>|\[/INST\]|<</SYS>>|<</ROLE>>)"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<>\[])", r"$1\\")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\<>\[])\\", "$1")


def rendered(role: Column, text: Column) -> Column:
    """One turn; ``role`` and ``text`` are escaped already where they need it."""
    out = F.concat(F.lit(OTHER[0]), role, F.lit(OTHER[1]), text, F.lit(OTHER[2]))
    for name, (opening, closing) in MARKS.items():
        out = F.when(role == name, F.concat(F.lit(opening), text, F.lit(closing))).otherwise(out)
    return out


def parsed(formatted: Column) -> Column:
    """The turns of a rendered text as structs of role and text."""
    openings, names, texts = (F.regexp_extract_all(formatted, F.lit(TURN), F.lit(i)) for i in (1, 2, 3))

    def role(opening: Column, name: Column) -> Column:
        out = unescape(name)
        for known, (start, _) in MARKS.items():
            out = F.when(opening == start, known).otherwise(out)
        return out

    roles = F.zip_with(openings, names, role)
    return F.zip_with(roles, texts, lambda r, t: F.struct(r.alias("role"), unescape(t).alias("text")))


def _joined(turns: Column, field: str) -> Column:
    return F.array_join(F.transform(turns, lambda t: t[field]), "")


def format_chat(
    turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, and ``escaped``, the level that came back whole
    (0: only turns with control strings, 1: all turns)."""
    said, who = text_of(text), text_of(role)
    conflict = F.concat(who, F.lit("\n"), said).rlike(CONTROL + r"|[\\<>\[]\\")
    rows = turns.select(
        F.col(conversation).alias("_id"), F.col(turn).alias("_turn"), who.alias("_role"), said.alias("_text"), conflict.alias("_hit")
    )
    turned = F.struct(
        F.col("_turn").alias("turn"), F.col("_role").alias("role"), F.col("_text").alias("text"),
        F.when(F.col("_hit"), rendered(escape(F.col("_role")), escape(F.col("_text"))))
        .otherwise(rendered(F.col("_role"), F.col("_text"))).alias("out"),
    )
    grouped = rows.groupBy("_id").agg(F.array_sort(F.collect_list(turned)).alias("turns"))
    source = F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    first = grouped.select("_id", source.alias("source"), _joined(F.col("turns"), "out").alias("light"))
    whole = F.array_join(F.transform("source", lambda t: rendered(escape(t["role"]), escape(t["text"]))), "")
    same = parsed(F.col("light")) == F.col("source")
    chosen = first.withColumn("escaped", F.when(same, 0).otherwise(1))
    chosen = chosen.withColumn("formatted", F.when(F.col("escaped") == 0, F.col("light")).otherwise(whole))
    return chosen.select(F.col("_id").alias(conversation), "formatted", "escaped")


def read_chat(formatted: DataFrame, column: str = "formatted") -> DataFrame:
    """Adds what the rendered text says: ``turns`` (role, text), and ``loss`` (start, length of each
    stretch under the loss mask, in characters from 1, as it stands in the rendered text)."""
    whole = F.regexp_extract_all(F.col(column), F.lit(TURN), F.lit(0))
    inner = F.regexp_extract_all(F.col(column), F.lit(TURN), F.lit(3))
    opening = F.regexp_extract_all(F.col(column), F.lit(TURN), F.lit(1))
    turns = F.arrays_zip(opening.alias("o"), inner.alias("t"), whole.alias("w"))
    begin = F.struct(F.lit(1).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        span = F.struct((state["at"] + F.length(turn["o"])).alias("start"), F.length(turn["t"]).alias("length"))
        spans = F.when(turn["o"] == MARKS["assistant"][0], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((state["at"] + F.length(turn["w"])).alias("at"), spans.alias("spans"))

    return formatted.withColumn("turns", parsed(F.col(column))).withColumn(
        "loss", F.aggregate(turns, begin, step, lambda state: state["spans"])
    )


def under_loss(formatted: Column, loss: Column) -> Column:
    """All text under the mask, one stretch after the other, unescaped."""
    return F.array_join(F.transform(loss, lambda s: unescape(F.substring(formatted, s["start"], s["length"]))), "")
