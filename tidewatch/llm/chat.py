"""Chat formatting: a state machine over roles and a declarative template, in DataFrame functions only.

Every conversation becomes a list of text segments, each with its loss flag; joined, they are the formatted text. Control
strings inside texts and roles are escaped so that the formatted text can be read back exactly.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BAD = "bad"


@dataclass(frozen=True)
class Template:
    """A turn is ``open + role + close + text + end``. ``end`` starts with ``open``.

    ``loss_roles`` are those whose texts are learned. ``moves`` maps a state and a role to the next state; a role that has no
    move from a state breaks the turn order for good. ``final`` are states in which a conversation may stop.
    """

    open: str = "<|"
    close: str = "|>\n"
    end: str = "<|end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "told", ("start", "user"): "asked", ("told", "user"): "asked", ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    final: tuple[str, ...] = ("answered",)

    def __post_init__(self):
        if not self.end.startswith(self.open) or self.end == self.open or "\\" in self.close + self.end or not self.open or not self.close:
            raise ValueError("end must start with open and go on, and none of the three may be empty or hold a backslash")

    def escape(self, text: Column) -> Column:
        for raw, coded in (("\\", "\\b"), (self.open, "\\o"), (self.close, "\\c")):
            text = F.replace(text, F.lit(raw), F.lit(coded))
        return text

    def header(self, role: Column) -> Column:
        """``open``, the escaped role and ``close``; a role with which a header could begin like ``end`` is set off by an empty escape."""
        inner = F.lit(self.end[len(self.open) :])
        named = F.concat(self.escape(role), F.lit(self.close))
        return F.concat(F.lit(self.open), F.when(F.startswith(named, inner) | F.startswith(inner, named), "\\e").otherwise(""), named)

    def unescape(self, text: Column) -> Column:
        for raw, coded in (("", "\\e"), (self.close, "\\c"), (self.open, "\\o"), ("\\", "\\b")):
            text = F.replace(text, F.lit(coded), F.lit(raw))
        return text

    def state(self, roles: Column) -> Column:
        """Where the machine stands after all roles."""
        moves = F.create_map(*(F.lit(x) for (a, b), c in self.moves.items() for x in (f"{a}\n{b}", c)))
        return F.aggregate(roles, F.lit(self.start), lambda s, r: F.coalesce(moves[F.concat(s, F.lit("\n"), r)], F.lit(BAD)))


def format_chats(
    turns: DataFrame, template: Template = Template(), conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv_id, valid, segments (text, loss), formatted``.

    Turns are ordered by number, then role, then text; null numbers come first. Null texts and roles are empty; rows with a
    null conversation form one. A conversation is one row of the result, so it must fit in memory of a task. Repeated rows are turns of their own. Conversations out of order are formatted too,
    with ``valid`` false. An empty table has no conversations. Only the four named columns are read.
    """
    row = F.struct(F.col(turn).alias("turn"), F.coalesce(F.col(role), F.lit("")).alias("role"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    grouped = turns.groupBy(F.col(conversation).alias("conv_id")).agg(F.sort_array(F.collect_list(row)).alias("turns"))
    state = template.state(F.transform("turns", lambda t: t["role"]))

    def segment(value: Column, loss: Column) -> Column:
        return F.struct(value.alias("text"), loss.alias("loss"))

    def parts(t: Column) -> Column:
        learned = t["role"].isin(*template.loss_roles)
        return F.array(segment(template.header(t["role"]), F.lit(False)), segment(template.escape(t["text"]), learned), segment(F.lit(template.end), F.lit(False)))

    out = grouped.select("conv_id", state.isin(*template.final).alias("valid"), F.flatten(F.transform("turns", parts)).alias("segments"))
    return out.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column, template: Template = Template()) -> Column:
    """The (role, text) pairs that a formatted text holds."""
    pieces = F.split(formatted, re.sub(r"([^A-Za-z0-9\n])", r"\\\1", template.end), -1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, template.close, 1)
        role = F.substr(head, F.lit(len(template.open) + 1))
        body = F.substr(piece, F.char_length(head) + len(template.close) + 1)
        return F.struct(template.unescape(role).alias("role"), template.unescape(body).alias("text"))

    return F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), turn)


def read_loss(segments: Column, template: Template = Template()) -> Column:
    """All text under the loss mask, unescaped."""
    learned = F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: template.unescape(s["text"]))
    return F.array_join(learned, "")
