"""Chat formatting with a grammar round trip, as DataFrame expressions only.

A turn is ``<|im_start|>role NEWLINE text<|im_end|> NEWLINE``. The parser splits a formatted text at every
control string; it accepts only start and end marks in turn, each body with a role line. A turn
is first rendered as it is and parsed again; where the parser doesn't return the same role and
text, the turn is escaped: one backslash goes behind the first character of each control string, also of
one that has backslashes there already, so that taking one away gives the source back. The
whole conversation is then parsed and compared once more (``identical``).

The loss mask is a list of spans (start from 1, length, in code points) of the formatted text:
the assistant texts.

A conversation becomes one text, so it must fit in one value (2 GB); conversations are spread by id.

Edge cases: a null text or role is empty; turns are ordered by turn (nulls first), then role and
text, so repeated rows stay and reruns agree; rows with a null conversation id are one conversation;
other columns don't matter; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placelens.llm.shared import column

START, END = "<|im_start|>", "<|im_end|>"
#: Control strings of common chat templates. None starts inside another.
CONTROLS = (START, END, "<|endoftext|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")


def _quoted(text: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c not in "<>/_ " else c for c in text)


def _after_first(behind: str) -> str:
    """A pattern that finds the backslashes ``behind`` the first character of a control string."""
    by_first: dict[str, list[str]] = {}
    for c in CONTROLS:
        by_first.setdefault(c[0], []).append(_quoted(c[1:]))
    return "|".join(f"(?<={_quoted(first)}){behind}(?=\\\\*(?:{'|'.join(rest)}))" for first, rest in by_first.items())


_PLAIN = "|".join(_quoted(c) for c in CONTROLS)


def escape(text: Column) -> Column:
    """One backslash more behind the first character of each control string, escaped or not."""
    return F.regexp_replace(text, _after_first(""), r"\\")


def unescape(text: Column) -> Column:
    """One backslash less behind the first character of each escaped control string."""
    return F.regexp_replace(text, _after_first(r"\\"), "")


def render(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END + "\n"))


def parse(formatted: Column) -> Column:
    """The turns (role, text) of a formatted text, or null where it isn't of the grammar."""
    marks = F.regexp_extract_all(formatted, F.lit(f"({_PLAIN})"), F.lit(1))
    parts = F.split(formatted, _PLAIN, -1)
    n = (F.size(marks) / 2).cast("int")
    bodies = F.filter(parts, lambda _, i: i % 2 == 1)
    gaps = F.filter(parts, lambda _, i: i % 2 == 0)
    right = (
        (F.array_join(marks, "") == F.repeat(F.lit(START + END), n))
        & (F.array_join(gaps, "\u0001") == F.repeat(F.lit("\u0001\n"), n))
        & F.forall(bodies, lambda b: F.contains(b, F.lit("\n")))
    )
    turns = F.transform(
        bodies,
        lambda b: F.struct(
            F.url_decode(F.substring_index(b, "\n", 1)).alias("role"),
            unescape(F.substring(b, F.instr(b, "\n") + 1, F.length(b))).alias("text"),
        ),
    )
    return F.when(right, turns)


def format_chats(
    turns: DataFrame,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: id, formatted, turns (parsed), loss_spans, escaped_turns, identical."""
    role, text = F.coalesce(column(role_col).cast("string"), F.lit("")), F.coalesce(column(text_col), F.lit(""))
    rows = turns.select(
        column(conv_col).alias("conv"), column(turn_col).alias("turn"), role.alias("role"), text.alias("text")
    )
    # A role is encoded for urls: letters stay, and no mark or line end can occur in it.
    plain = rows.withColumn("name", F.url_encode("role")).withColumn("raw", render(F.col("name"), F.col("text")))
    same = F.coalesce(parse(F.col("raw")) == F.array(F.struct("role", "text")), F.lit(False))
    marked = plain.withColumn("same", same).withColumn(
        "shown", F.when(F.col("same"), F.col("text")).otherwise(escape(F.col("text")))
    )
    grouped = marked.groupBy("conv").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role", "text", "name", "shown", "same"))).alias("t")
    )
    done = grouped.select(
        "conv",
        F.transform("t", lambda x: F.struct(x.role.alias("role"), x.text.alias("text"))).alias("source"),
        F.array_join(F.transform("t", lambda x: render(x["name"], x.shown)), "").alias("formatted"),
        F.size(F.filter("t", lambda x: ~x.same)).cast("long").alias("escaped_turns"),
        F.aggregate(
            "t",
            F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,length:int>>").alias("spans")),
            lambda acc, x: F.struct(
                (acc.at + F.length(render(x["name"], x.shown))).alias("at"),
                F.when(
                    x.role == "assistant",
                    F.concat(
                        acc.spans,
                        F.array(
                            F.struct(
                                (acc.at + len(START) + F.length(x["name"]) + 2).alias("start"),
                                F.length(x.shown).alias("length"),
                            )
                        ),
                    ),
                )
                .otherwise(acc.spans)
                .alias("spans"),
            ),
            lambda acc: acc.spans,
        ).alias("loss_spans"),
    )
    parsed = done.withColumn("turns", parse(F.col("formatted")))
    return parsed.select(
        F.col("conv").alias(conv_col),
        "formatted",
        "turns",
        "loss_spans",
        "escaped_turns",
        F.coalesce(F.col("turns") == F.col("source"), F.lit(False)).alias("identical"),
    )


def loss_text(formatted: str = "formatted", spans: str = "loss_spans") -> Column:
    """The text under the loss mask, read from the formatted text, unescaped."""
    part = F.transform(spans, lambda x: unescape(F.substring(F.col(formatted), x.start, x.length)))
    return F.array_join(part, "")
