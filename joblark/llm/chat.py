"""Chat formatting: a finite-state machine over roles and a declarative template.

A template says how each role's turns are marked, which roles are learned from, which turns may
follow which, and thereby its control strings. Control strings inside texts
get a backslash after their first character, backslashes are doubled before, so that a
formatted text can be split again and gives back the very texts. In names of roles, which end
with their line, line breaks are escaped too.

Columns only. Null text, role: empty. Turns are ordered by turn (null first), role and
text. A null conversation id is a conversation. Roles the template does not know are
written with their name; the order of turns is judged, not changed: ``valid`` says whether
the machine accepted it, ``stopped_at`` which turn it refused. Repeated rows are repeated turns.
An empty table gives an empty result. Other columns are ignored. A conversation is one
output row, so its turns meet in one task.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    role: str
    prefix: str
    suffix: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Every turn starts with ``begin``; prefixes tell known roles apart, the plain one is last."""

    begin: str = "<s>"
    turns: tuple[Turn, ...] = (
        Turn("system", "<<SYS>>\n", "\n<</SYS>>"),
        Turn("user", "[INST] ", " [/INST]"),
        Turn("assistant", "", "</s>", loss=True),
    )
    other: Turn = Turn("", "[ROLE] ", "</s>")
    control: tuple[str, ...] = ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "[ROLE]")
    start: str = "start"
    transitions: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
            ("user", "assistant"): "assistant", ("assistant", "user"): "user",
        }
    )
    accepting: tuple[str, ...] = ("user", "assistant")

    def escape(self, text: Column) -> Column:
        text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
        return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(f"{c[0]}\\{c[1:]}")), self.control, text)

    def escape_name(self, name: Column) -> Column:
        """A role's name, whose line breaks would end it, as one line."""
        return F.replace(self.escape(name), F.lit("\n"), F.lit("\\n"))

    def unescape_name(self, name: Column) -> Column:
        """Backslashes of a name are doubled, so that an odd one before n stands for a line break."""
        return self.unescape(F.regexp_replace(name, r"(?<!\\)((?:\\\\)*)\\n", "$1\n"))

    def unescape(self, text: Column) -> Column:
        text = reduce(lambda t, c: F.replace(t, F.lit(f"{c[0]}\\{c[1:]}"), F.lit(c)), self.control, text)
        return F.replace(text, F.lit("\\\\"), F.lit("\\"))


DEFAULT = Template()
_SEGMENTS = "array<struct<text: string, loss: boolean>>"


def _segments(turn: Column, template: Template) -> Column:
    """A turn's marks and text, each with its loss flag."""

    def parts(kind: Turn, before: Column) -> Column:
        mark = lambda c: F.struct(c.alias("text"), F.lit(False).alias("loss"))
        body = F.struct(template.escape(turn["text"]).alias("text"), F.lit(kind.loss).alias("loss"))
        return F.array(mark(before), body, mark(F.lit(kind.suffix)))

    known = None
    for kind in template.turns:
        condition, value = turn["role"] == kind.role, parts(kind, F.lit(template.begin + kind.prefix))
        known = F.when(condition, value) if known is None else known.when(condition, value)
    named = F.concat(F.lit(template.begin + template.other.prefix), template.escape_name(turn["role"]), F.lit("\n"))
    return known.otherwise(parts(template.other, named))


def format_chats(rows: DataFrame, template: Template = DEFAULT, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(conv_id, segments, formatted, valid, stopped_at)`` a conversation."""
    turns = rows.select(
        F.col(id_col).alias("conv_id"),
        F.struct(
            F.col(turn_col).alias("turn"),
            F.coalesce(F.col(role_col).cast("string"), F.lit("")).alias("role"),
            F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
        ).alias("t"),
    )
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    table = F.create_map(*[F.lit(x) for (state, role), after in template.transitions.items() for x in (f"{state}\n{role}", after)])
    machine = F.aggregate(
        "turns",
        F.struct(F.lit(template.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("stopped")),
        lambda s, t: F.struct(
            F.coalesce(table[F.concat(s["state"], F.lit("\n"), t["role"])], F.lit("")).alias("state"),
            (s["at"] + 1).alias("at"),
            F.when(s["stopped"].isNull() & table[F.concat(s["state"], F.lit("\n"), t["role"])].isNull(), s["at"]).otherwise(s["stopped"]).alias("stopped"),
        ),
    )
    out = chats.select("conv_id", F.flatten(F.transform("turns", lambda t: _segments(t, template))).cast(_SEGMENTS).alias("segments"), machine.alias("machine"))
    return out.select(
        "conv_id", "segments", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
        (F.col("machine.stopped").isNull() & F.col("machine.state").isin(*template.accepting)).alias("valid"),
        F.col("machine.stopped").alias("stopped_at"),
    )


def read_back(formatted: Column, template: Template = DEFAULT) -> Column:
    """The turns ``array<struct<role, text>>`` of a formatted text."""

    def inner(part: Column, kind: Turn) -> Column:
        size = len(kind.prefix) + len(kind.suffix)
        return F.substring(part, F.lit(len(kind.prefix) + 1), F.char_length(part) - size)

    def turn(part: Column) -> Column:
        rest = inner(part, template.other)
        line = F.instr(rest, F.lit("\n"))
        named = F.struct(template.unescape_name(F.substring(rest, F.lit(1), line - 1)).alias("role"), template.unescape(F.substring(rest, line + 1, F.char_length(rest))).alias("text"))
        out = F.when(F.startswith(part, F.lit(template.other.prefix)), named)
        plain = None
        for kind in template.turns:
            value = F.struct(F.lit(kind.role).alias("role"), template.unescape(inner(part, kind)).alias("text"))
            if kind.prefix:
                out = out.when(F.startswith(part, F.lit(kind.prefix)), value)
            else:
                plain = value
        return out.otherwise(plain)

    parts = F.split(formatted, "\\Q" + template.begin + "\\E")
    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), turn)


def learned(segments: Column, template: Template = DEFAULT) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"])), "")
