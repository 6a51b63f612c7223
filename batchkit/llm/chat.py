"""Chat formatting with a declarative template. DataFrame functions only."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F


@dataclass(frozen=True)
class Template:
    """How a turn is written, which roles may follow which, and whose text is learned.

    A turn is ``open + role + middle + text + close``. ``follows`` is the transition table of the
    state machine: the state is the role of the last turn, ``""`` before the first one. A role
    outside the table is never valid. ``ends`` are the roles a conversation may end with, ``learn``
    those whose text is under the loss mask.
    """

    open: str = "[INST]"
    middle: str = "[/INST]"
    close: str = "</s>"
    more_controls: tuple[str, ...] = ("<s>",)
    follows: dict[str, tuple[str, ...]] = field(
        default_factory=lambda: {
            "": ("system", "user"),
            "system": ("user",),
            "user": ("assistant",),
            "assistant": ("user",),
        }
    )
    ends: tuple[str, ...] = ("user", "assistant")
    learn: tuple[str, ...] = ("assistant",)

    @property
    def controls(self) -> tuple[str, ...]:
        return (self.open, self.middle, self.close, *self.more_controls)

    @property
    def codes(self) -> dict[str, str]:
        """The code that stands for the first character of a control string inside a text."""
        firsts = sorted({c[0] for c in self.controls})
        if "~" in firsts or len(firsts) > 9:
            raise ValueError("control strings start with at most nine characters, none of them ~")
        return {c: f"~{i}" for i, c in enumerate(firsts, 1)}


def escape(text: Column, template: Template) -> Column:
    """Replace ``~`` by ``~0`` and the first character of every control string by its code.

    What is left holds no control string: a code has no character of one but its own first.
    """
    text = F.replace(text, F.lit("~"), F.lit("~0"))
    for first, code in template.codes.items():
        rest = sorted({c[1:] for c in template.controls if c[0] == first}, key=len, reverse=True)
        ahead = "|".join(re.escape(r) for r in rest)
        text = F.regexp_replace(text, f"{re.escape(first)}(?={ahead})", code)
    return text


def unescape(text: Column, template: Template) -> Column:
    """Undo ``escape``. ``~0`` comes last, so that an escaped ``~`` never starts a code."""
    for first, code in template.codes.items():
        text = F.replace(text, F.lit(code), F.lit(first))
    return F.replace(text, F.lit("~0"), F.lit("~"))


def format_chats(
    rows: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation: its id, ``formatted``, ``segments``, ``n_turns``, ``valid``.

    ``segments`` are pairs (text, loss) that put together are ``formatted``; loss is true only for
    the text of a learned role. ``valid`` is what the state machine says of the turn order; an
    invalid conversation is formatted all the same.

    Turns are ordered by number, then role and text, nulls first; repeated rows are repeated turns.
    Null roles and texts are empty. Rows with a null conversation form one conversation. An empty
    table gives no rows; other columns are not read. A conversation is one output row, so its turns
    meet in one task: its size is that of one formatted text.
    """
    turn = F.struct(
        F.col(turn_col).alias("turn"),
        F.coalesce(role_col, F.lit("")).alias("role"),
        F.coalesce(text_col, F.lit("")).alias("text"),
    )
    chats = rows.groupBy(F.col(conv_col).alias("_conv")).agg(
        F.array_sort(F.collect_list(turn)).alias("_turns")
    )

    def segments(t: Column) -> Column:
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        head = F.concat(
            F.lit(template.open), escape(t["role"], template), F.lit(template.middle)
        )
        return F.array(
            part(head, F.lit(False)),
            part(escape(t["text"], template), t["role"].isin(*template.learn)),
            part(F.lit(template.close), F.lit(False)),
        )

    rules = F.create_map(
        *[
            x
            for state, then in template.follows.items()
            for x in (F.lit(state), F.array(*[F.lit(r) for r in then]))
        ]
    )
    # the state after a turn is its role, or null for good once the order is broken
    state = F.aggregate(
        "_turns",
        F.lit(""),
        lambda state, t: F.when(
            F.array_contains(F.element_at(rules, state), t["role"]), t["role"]
        ),
    )
    made = chats.select(
        F.col("_conv").alias(conv_col),
        F.flatten(F.transform("_turns", segments)).alias("segments"),
        F.size("_turns").cast("long").alias("n_turns"),
        F.coalesce(state.isin(*template.ends), F.lit(False)).alias("valid"),
    )
    return made.withColumn("formatted", F.array_join(F.col("segments.text"), ""))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    pieces = F.split(formatted, re.escape(template.close), -1)

    def turn(piece: Column) -> Column:
        parts = F.split(
            F.substr(piece, F.lit(len(template.open) + 1)), re.escape(template.middle), 2
        )
        return F.struct(
            unescape(parts[0], template).alias("role"), unescape(parts[1], template).alias("text")
        )

    # the last close leaves one empty piece behind it
    return F.transform(F.slice(pieces, 1, F.size(pieces) - 1), turn)


def learned_text(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"], template)), "")
