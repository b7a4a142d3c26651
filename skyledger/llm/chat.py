"""Chat formatting by a declarative template and a finite-state machine over roles.

A template tells for each role what opens and closes its turns and whether its text counts for the
loss. Every turn becomes three segments: opening, text, closing; each has a loss flag. Control
strings of the template inside a text are escaped, so a text can never end its own turn, and the
formatted conversation can be read back exactly.

The state of the machine is the role of the last turn. A conversation is valid if each step is
allowed from the state before and it ends in an accepting state; invalid ones are formatted too and
carry the place of the first wrong turn.

Everything is DataFrame and SQL functions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class Turn(NamedTuple):
    opening: str
    closing: str
    loss: bool


class Template(NamedTuple):
    """`roles`: how their turns look. `other`: turns of any other role, which carry the role's name
    between `other.opening` and `name_end`. `steps`: allowed (state, role); the state before the
    first turn is ''. `accepting`: states that a conversation may end in. `reserved`: strings that
    must not occur in a text besides the openings and closings. No control string may hold the
    escape character or start with the end of another one."""

    roles: dict[str, Turn]
    other: Turn
    name_end: str
    steps: frozenset[tuple[str, str]]
    accepting: frozenset[str]
    reserved: tuple[str, ...] = ()
    escape: str = "\\"

    @property
    def controls(self) -> list[str]:
        turns = [*self.roles.values(), self.other]
        marks = {m.strip() for t in turns for m in (t.opening, t.closing)}
        return sorted(marks | {self.name_end.strip(), *self.reserved})


INSTRUCT = Template(
    roles={
        "system": Turn("<<SYS>>", "<</SYS>>", False),
        "user": Turn("[INST]", "[/INST]", False),
        "assistant": Turn("<s>", "</s>", True),
    },
    other=Turn("[TURN]", "[/TURN]", False),
    name_end="[SAYS]",
    steps=frozenset(
        {("", "system"), ("", "user"), ("system", "user"), ("user", "assistant"),
         ("assistant", "user")}
    ),
    accepting=frozenset({"assistant"}),
)


def escaped(text: Column, template: Template) -> Column:
    """`text` without control strings: each becomes the escape character and its number."""
    text = F.replace(text, F.lit(template.escape), F.lit(f"{template.escape}0;"))
    for k, control in enumerate(template.controls, 1):
        text = F.replace(text, F.lit(control), F.lit(f"{template.escape}{k};"))
    return text


def unescaped(text: Column, template: Template) -> Column:
    for k, control in enumerate(template.controls, 1):
        text = F.replace(text, F.lit(f"{template.escape}{k};"), F.lit(control))
    return F.replace(text, F.lit(f"{template.escape}0;"), F.lit(template.escape))


def _by_role(role: Column, template: Template, pick, other: Column) -> Column:
    out = F.when(F.lit(False), other)
    for name, turn in template.roles.items():
        out = out.when(role == F.lit(name), F.lit(pick(turn)))
    return out.otherwise(other)


def segments(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, turn, role, text, opening, body, closing, loss) for each row of `turns`.

    Needs conv_id, turn, role, text; other columns are ignored. A NULL text is empty, a NULL role
    is the empty role. Each row stands alone, so a long conversation needs no task of its own here.
    """
    role = F.coalesce("role", F.lit(""))
    named = F.concat(
        F.lit(template.other.opening), escaped(role, template), F.lit(template.name_end)
    )
    return turns.select(
        "conv_id",
        "turn",
        role.alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
        _by_role(role, template, lambda t: t.opening, named).alias("opening"),
        escaped(F.coalesce("text", F.lit("")), template).alias("body"),
        _by_role(role, template, lambda t: t.closing, F.lit(template.other.closing)).alias(
            "closing"
        ),
        _by_role(role, template, lambda t: t.loss, F.lit(template.other.loss)).alias("loss"),
    )


def format_chats(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """(conv_id, formatted, segments, valid, first_bad_turn), one row per conversation.

    `segments` are (text, loss) in order and make up `formatted`. Turns are ordered by turn number
    (NULL first), equal numbers by role and text; repeated rows are turns of their own. Rows without
    conv_id are one conversation. `first_bad_turn` counts from 0; a wrong end counts as the turn
    after the last. A conversation is one value of the result, so its rows meet in one task.
    """
    each = segments(turns, template)
    # The text itself, not its escaped form, tells the order.
    turn = F.struct("turn", "role", "text", "opening", "closing", "loss")
    chats = each.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    parts = F.flatten(
        F.transform(
            "turns",
            lambda t: F.array(
                F.struct(t["opening"].alias("text"), F.lit(False).alias("loss")),
                F.struct(escaped(t["text"], template).alias("text"), t["loss"].alias("loss")),
                F.struct(t["closing"].alias("text"), F.lit(False).alias("loss")),
            ),
        )
    )
    states = F.concat(F.array(F.lit("")), F.transform("turns", lambda t: t["role"]))
    good = _allowed(template.steps)
    wrong = F.filter(
        F.sequence(F.lit(0), F.size("turns") - 1),
        lambda k: ~good(F.get(F.col("states"), k), F.get(F.col("states"), k + 1)),
    )
    ends_well = F.element_at("states", -1).isin(sorted(template.accepting))
    bad = F.coalesce(F.get(wrong, F.lit(0)), F.when(~ends_well, F.size("turns")))
    return (
        chats.withColumn("segments", parts)
        .withColumn("states", states)
        .select(
            "conv_id",
            F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
            "segments",
            bad.isNull().alias("valid"),
            bad.alias("first_bad_turn"),
        )
    )


def _allowed(steps: frozenset[tuple[str, str]]):
    def good(state: Column, role: Column) -> Column:
        out = F.lit(False)
        for before, after in sorted(steps):
            out = out | ((state == F.lit(before)) & (role == F.lit(after)))
        return out

    return good


def read_back(formatted: Column, template: Template = INSTRUCT) -> Column:
    """Array of (role, text, loss) that a formatted conversation holds."""
    turns = {**{name: t for name, t in template.roles.items()}, None: template.other}
    openings = "|".join(re.escape(t.opening) for t in turns.values())
    chunks = F.filter(F.split(formatted, f"(?={openings})"), lambda c: c != F.lit(""))

    def read(chunk: Column) -> Column:
        out = None
        for name, turn in turns.items():
            skip = len(turn.opening)
            inner = F.substr(
                chunk,
                F.lit(skip + 1),
                F.char_length(chunk) - F.lit(skip + len(turn.closing)),
            )
            role = F.lit(name)
            if name is None:
                role = unescaped(F.substring_index(inner, template.name_end, 1), template)
                inner = F.substring_index(inner, template.name_end, -1)
            value = F.struct(
                role.alias("role"),
                unescaped(inner, template).alias("text"),
                F.lit(turn.loss).alias("loss"),
            )
            test = F.startswith(chunk, F.lit(turn.opening))
            out = F.when(test, value) if out is None else out.when(test, value)
        return out

    return F.transform(chunks, read)


def digests(chats: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """Lengths and digests of what `format_chats` wrote, read back from the formatted text.

    (conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars, valid,
    first_bad_turn). The text under the loss is also taken from the flagged segments; both must
    agree, else the digest is NULL.
    """
    read = chats.withColumn("read", read_back(F.col("formatted"), template))
    lines = F.transform("read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    under_loss = F.array_join(
        F.transform(F.filter("read", lambda t: t["loss"]), lambda t: t["text"]), ""
    )
    flagged = F.array_join(
        F.transform(
            F.filter("segments", lambda s: s["loss"]), lambda s: unescaped(s["text"], template)
        ),
        "",
    )
    return read.withColumn("under_loss", under_loss).select(
        "conv_id",
        F.size("read").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("under_loss").cast("long").alias("loss_chars"),
        F.when(F.col("under_loss") == flagged, F.sha2(F.col("under_loss").cast("binary"), 256)).alias(
            "loss_sha256"
        ),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        "valid",
        "first_bad_turn",
    )


def extra_turns(like: DataFrame, conv_id: int, turns: Sequence[tuple[str, str]]) -> DataFrame:
    """A conversation in the columns of `like`, from plan literals."""
    rows = F.array(
        *[
            F.struct(
                F.lit(conv_id).cast("long").alias("conv_id"),
                F.lit(k).cast("long").alias("turn"),
                F.lit(role).alias("role"),
                F.lit(text).alias("text"),
            )
            for k, (role, text) in enumerate(turns)
        ]
    )
    return like.sparkSession.range(1).select(F.inline(rows))
