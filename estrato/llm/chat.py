"""Chat formatting by a finite-state machine over roles and a declarative template.

The template names, per role, the text before and after a turn and whether the turn bears
loss. Control strings of the template that occur inside a text get a backslash behind their
first character (one more if backslashes are there already), so that they cannot be taken
for control strings and the escaping can be undone exactly.

The machine starts in `start`; a turn's role leads from the role before it to the next
state. A turn for which there is no transition is marked invalid; formatting goes on from
its role. Turns are ordered by (turn, role, text), nulls first. Null text is empty, a null
role is the role "". Repeated rows are turns of their own. Other columns are dropped.

Output is one row per turn with its segments, so a conversation of any length streams
through sorted partitions and is never held as one value.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Turn:
    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    turns: dict[str, Turn] = field(default_factory=lambda: {
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("[OUT]", "</s>", loss=True),
    })
    # Any other role is written out between `role` and `says`.
    role: str = "[ROLE]"
    says: str = "[SAYS]"
    done: str = "[/ROLE]"
    start: str = "<s>"
    moves: tuple[tuple[str, str], ...] = (
        ("start", "system"), ("start", "user"), ("system", "user"), ("user", "assistant"),
        ("assistant", "user"),
    )

    @property
    def controls(self) -> tuple[str, ...]:
        marks = [m for t in self.turns.values() for m in (t.before, t.after)]
        return tuple(dict.fromkeys([*marks, self.role, self.says, self.done, self.start]))

    def escape(self, text: Column) -> Column:
        for head, tails in self._tails().items():
            text = F.regexp_replace(text, rf"({head})(\\*)({tails})", r"$1\\$2$3")
        return text

    def unescape(self, text: str) -> str:
        for head, tails in self._tails().items():
            text = re.sub(rf"({head})\\(\\*)({tails})", r"\1\2\3", text)
        return text

    def _tails(self) -> dict[str, str]:
        tails: dict[str, list[str]] = {}
        for c in self.controls:
            tails.setdefault(re.escape(c[0]), []).append(re.escape(c[1:]))
        return {head: "|".join(t) for head, t in tails.items()}

    def read(self, formatted: str) -> list[tuple[str, str, bool]]:
        """The turns (role, text, bears loss) of formatted text, escapes undone."""
        out, ends = [], "|".join(re.escape(c) for c in self.controls)
        by_start = {t.before: (role, t) for role, t in self.turns.items()}
        marks = list(re.finditer(ends, formatted))
        at = 0
        while at < len(marks):
            mark = marks[at][0]
            if mark == self.start:
                at += 1
                continue
            if mark == self.role:
                role = self.unescape(formatted[marks[at].end() : marks[at + 1].start()])
                turn, at = Turn(self.role, self.done), at + 1
            else:
                role, turn = by_start[mark]
            body = formatted[marks[at].end() : marks[at + 1].start()]
            if marks[at + 1][0] != turn.after:
                raise ValueError(f"{marks[at + 1][0]!r} ends a turn of {role!r}")
            out.append((role, self.unescape(body), turn.loss))
            at += 2
        return out


def format_turns(rows: DataFrame, template: Template = Template()) -> DataFrame:
    """One row per turn: conv_id, position (from 0), role, valid, segments (text, loss)."""
    role = F.coalesce(F.col("role"), F.lit(""))
    inside = Window.partitionBy("conv_id").orderBy(
        F.col("turn").asc_nulls_first(), "role", "text"
    )
    turns = rows.select(
        "conv_id", "turn", role.alias("role"), F.coalesce("text", F.lit("")).alias("text")
    ).select(
        "conv_id", "role", "text",
        (F.row_number().over(inside) - 1).cast("long").alias("position"),
        F.coalesce(F.lag("role").over(inside), F.lit("start")).alias("state"),
    )
    move = F.concat_ws(">", "state", "role")
    valid = move.isin(*[f"{a}>{b}" for a, b in template.moves])
    return turns.select(
        "conv_id", "position", "role", valid.alias("valid"), _segments(template).alias("segments")
    )


def _segments(template: Template) -> Column:
    def segment(text: Column, loss: bool = False) -> Column:
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    text = template.escape(F.col("text"))
    first = F.when(F.col("position") == 0, F.lit(template.start)).otherwise("")
    named = F.concat(
        first, F.lit(template.role), template.escape(F.col("role")), F.lit(template.says)
    )
    made = F.array(segment(named), segment(text), segment(F.lit(template.done)))
    for role, turn in template.turns.items():
        made = F.when(
            F.col("role") == role,
            F.array(
                segment(F.concat(first, F.lit(turn.before))),
                segment(text, turn.loss),
                segment(F.lit(turn.after)),
            ),
        ).otherwise(made)
    return made


def by_conversation(turns: DataFrame) -> DataFrame:
    """The turns of each conversation next to each other and in order in one partition."""
    return turns.repartition("conv_id").sortWithinPartitions("conv_id", "position")
