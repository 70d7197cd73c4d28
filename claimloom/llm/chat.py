"""Chat formatting: roles through a state machine, turns through a declarative template.

Everything is DataFrame expressions. The output of a conversation is a list of text segments,
each with a loss flag. Control strings of the template begin with ``<`` or ``[``. Neither character
survives in an escaped text, so a control string inside a text can never be taken for a mark, and
unescaping is exact.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The state machine. From a state, a role leads to the state of its name.
START = "start"
TURNS = {
    START: ("system", "user"),
    "system": ("user",),
    "user": ("assistant",),
    "assistant": ("user",),
}
#: States in which a conversation may end.
ENDS = ("assistant",)

#: The escape character, and what may follow it: the first stands for itself, the next for the
#: marking characters in the order of their code points.
ESCAPE = "\\"
CODES = "slbcdefghijkmnopqrtuvwxyz0123456789"


def marking(control: str) -> str:
    """The character that marks a control string: its first sign, or else its first character."""
    return next((c for c in control if not c.isalnum() and not c.isspace()), control[0])


@dataclass(frozen=True)
class Template:
    """A turn is ``opening, role, heading, text, closing``; texts of ``trained`` roles have loss.

    Opening and heading are not empty, no string holds the escape character, and no opening can be
    read across or inside another string, whatever text stands beside it.
    """

    opening: str = "<s>"
    heading: str = "[INST] "
    closing: str = " [/INST]</s>"
    trained: tuple[str, ...] = ("assistant",)

    def __post_init__(self) -> None:
        if not self.opening or not self.heading:
            raise ValueError("a template needs an opening and a heading")
        if ESCAPE in self.opening + self.heading + self.closing:
            raise ValueError(f"control strings must not hold the escape character {ESCAPE}")
        for other in (self.heading, self.closing, self.opening[1:]):
            if _can_lie_over(self.opening, other):
                raise ValueError(f"an opening {self.opening!r} could be read in {other!r}")

    @property
    def escapes(self) -> list[tuple[str, str]]:
        """What each escape stands for. The escape character is escaped first and undone last."""
        marks = sorted({marking(c) for c in (self.opening, self.heading, self.closing) if c})
        codes = [c for c in CODES if c not in marks]
        return [(plain, ESCAPE + code) for plain, code in zip([ESCAPE, *marks], codes)]


def _can_lie_over(control: str, other: str) -> bool:
    """Whether ``control``, its marking character in ``other``, fits there with any text around."""
    place = control.index(marking(control))
    return any(
        all(
            control[at] == other[at + start]
            for at in range(len(control))
            if 0 <= at + start < len(other)
        )
        for start in (at - place for at, c in enumerate(other) if c == control[place])
    )


def escaped(text: Column, template: Template = Template()) -> Column:
    for plain, code in template.escapes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescaped(text: Column, template: Template = Template()) -> Column:
    for plain, code in reversed(template.escapes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def literal_pattern(text: str) -> str:
    """A pattern that matches just ``text``."""
    return "\\Q" + text.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def in_order(roles: Column) -> Column:
    """Whether the state machine accepts the roles."""
    allowed = F.array(*(F.lit(f"{state}>{role}") for state, to in TURNS.items() for role in to))
    last = F.aggregate(
        roles,
        F.lit(START),
        lambda state, role: F.when(
            F.array_contains(allowed, F.concat(state, F.lit(">"), role)), role
        ).otherwise(F.lit("")),
    )
    return last.isin(*ENDS)


def format_chats(
    turns: DataFrame,
    template: Template = Template(),
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``<conv>, segments, in_order``: one row per conversation.

    ``segments`` is an array of ``text, loss``; together the texts are the formatted
    conversation. Turns are ordered by ``turn_col`` (NULL first), ties by role and text, so
    repeated rows give repeated turns. NULL roles and texts count as empty, roles outside the
    machine are formatted and make ``in_order`` false. A NULL conversation is one of its own. An
    empty table gives no rows. Other columns are not read.
    """
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    row = F.struct(F.col(turn_col).alias("turn"), role.alias("role"), text.alias("text"))
    ordered = turns.groupBy(F.col(conv_col).alias("conv")).agg(
        F.sort_array(F.collect_list(row)).alias("turns")
    )

    def segment(text: Column, loss: Column | bool = False) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    def segments(turn: Column) -> Column:
        trained = turn["role"].isin(*template.trained)
        return F.array(
            segment(F.lit(template.opening)),
            segment(escaped(turn["role"], template)),
            segment(F.lit(template.heading)),
            segment(escaped(turn["text"], template), trained),
            segment(F.lit(template.closing)),
        )

    return ordered.select(
        F.col("conv").alias(conv_col),
        F.flatten(F.transform("turns", segments)).alias("segments"),
        in_order(F.col("turns.role")).alias("in_order"),
    )


def read_chats(chats: DataFrame, template: Template = Template()) -> DataFrame:
    """``chats`` with ``formatted``, ``turns`` (role and text, read from it) and ``loss_text``."""
    heading, closing = len(template.heading), len(template.closing)

    def turn(part: Column) -> Column:
        role = F.substring_index(part, template.heading, 1)
        start = F.length(role) + heading + 1
        text = F.substring(part, start, F.length(part) - start - closing + 1)
        return F.struct(unescaped(role, template).alias("role"), unescaped(text, template).alias("text"))

    marked = F.filter("segments", lambda s: s["loss"])
    trained = F.transform(marked, lambda s: unescaped(s["text"], template))
    parts = F.split("formatted", literal_pattern(template.opening))
    return (
        chats.withColumn("formatted", F.array_join("segments.text", ""))
        .withColumn("turns", F.transform(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), turn))
        .withColumn("loss_text", F.array_join(trained, ""))
    )


def chat_digests(chats: DataFrame, template: Template = Template(), conv_col: str = "conv_id") -> DataFrame:
    """Counts and digests of formatted conversations, read back from their segments."""
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read_chats(chats, template).select(
        conv_col,
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "in_order",
    )
