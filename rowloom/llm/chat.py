"""Chat formatting by a finite-state machine and a declarative template, DataFrame operations only.

The template names, per role, whether the body is under the loss; the machine is a table
of allowed moves.  A conversation becomes segments (text, loss flag) whose concatenation
is the formatted text.  Control strings inside a text are escaped reversibly: backslashes
are doubled, then ``<|`` becomes ``<\\|``, so the formatted text holds control strings at
turn marks only and can be read back exactly.  Roles are percent-encoded, which leaves
plain names as they are.

A conversation is one training sample and one row: its turns meet in one group of the
size of the sample, as the output itself does.  Nothing else is gathered.

Defined cases: a null text is the empty text, a null role the empty role; rows with equal
turn numbers are ordered by role and text, null turns come first; repeated rows are
turns of their own; conversations that break the order are formatted all the same and
marked (valid, bad_turn); a null id is a conversation of its own; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around a turn, roles whose body is learned, and the moves between states."""

    open: str = OPEN
    close: str = CLOSE
    learned: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: Mapping[str, Mapping[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "asked", "user": "user"},
            "asked": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user"},
        }
    )
    accepting: tuple[str, ...] = ("assistant",)


def escaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("<|"), F.lit("<\\|"))


def unescaped(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("<\\|"), F.lit("<|")), F.lit("\\\\"), F.lit("\\"))


def format_conversations(
    df: DataFrame,
    template: ChatTemplate = ChatTemplate(),
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> DataFrame:
    """conv_id, segments array<struct<text, loss>>, formatted, valid, bad_turn (0-based place)."""
    one = F.struct(
        F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    rows = df.groupBy(F.col(f"`{conv}`").alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))
    moves = [(f"{a}\n{r}", b) for a, to in template.moves.items() for r, b in to.items()]
    table = F.create_map(*[F.lit(x) for pair in moves for x in pair])
    # A move that the table lacks leads to the empty state, which no move leaves.
    go = lambda s, t: F.coalesce(F.try_element_at(table, F.concat(s["state"], F.lit("\n"), t["role"])), F.lit(""))
    walked = F.aggregate(
        "turns",
        F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad")),
        lambda s, t: F.struct(
            go(s, t).alias("state"),
            (s["at"] + 1).alias("at"),
            F.when((s["bad"] < 0) & (go(s, t) == ""), s["at"]).otherwise(s["bad"]).alias("bad"),
        ),
    )
    segments = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(
                    F.concat(F.lit(template.open), F.url_encode(t["role"]), F.lit("\n")).alias("text"),
                    F.lit(False).alias("loss"),
                ),
                F.struct(escaped(t["text"]).alias("text"), t["role"].isin(*template.learned).alias("loss")),
                F.struct(F.lit(template.close).alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    rows = rows.select("conv_id", walked.alias("walk"), segments.alias("segments"))
    return rows.select(
        "conv_id",
        "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        F.col("walk.state").isin(*template.accepting).alias("valid"),
        F.when(F.col("walk.bad") >= 0, F.col("walk.bad")).alias("bad_turn"),
    )


def read_back(formatted: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """conv_id, turns array<struct<role, text>> from the formatted text, learned text from the segments."""
    parts = F.filter(F.split("formatted", r"\Q" + template.open + r"\E"), lambda p: p != "")
    turns = F.transform(
        parts,
        lambda p: F.struct(
            F.url_decode(F.substring_index(p, "\n", 1)).alias("role"),
            unescaped(
                F.substring(
                    p,
                    F.instr(p, "\n") + 1,
                    F.length(p) - F.instr(p, "\n") - len(template.close),
                )
            ).alias("text"),
        ),
    )
    learned = F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"]))
    return formatted.select("*", turns.alias("turns"), F.array_join(learned, "").alias("learned"))


def digests(read: DataFrame) -> DataFrame:
    told = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(told, 256).alias("turns_sha256"),
        F.length("learned").cast("long").alias("loss_chars"),
        F.sha2("learned", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "bad_turn",
    )
