r"""Chat formatting: a state machine over roles and a declarative template.

Each turn becomes three segments, header, text and end mark, with a loss flag of its own.  What is
escaped follows from the template's marks: inside a text a backslash goes behind each character that a
mark begins with, where the mark's second character or the end of the text comes next, backslashes in
between not counted.  So no mark begins inside a text, and taking one backslash away undoes it.  In roles
the first characters of marks are coded by their numbers.

Defined cases: a null text or role is empty; turns that tie in ``turn`` are ordered by role and text,
repeated rows all stay; a null ``turn`` comes first; a null ``conv_id`` is one conversation; a role
without a rule is formatted like any other, without loss, and makes the conversation invalid; an empty
table gives none; other columns are ignored.  A conversation is one row of the result, so its text must
fit into one value; the turns of different conversations never meet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.llm.common import whole


@dataclass(frozen=True)
class Template:
    """Marks around a turn, roles under the loss, and which role may follow in which state."""

    open: str = "<|"
    close: str = "|>\n"
    end: str = "<|end|>\n"
    loss: Sequence[str] = ("assistant",)
    start: str = "start"
    moves: Mapping[tuple[str, str], str] = field(
        default_factory=lambda: {
            ("start", "system"): "briefed",
            ("start", "user"): "asked",
            ("briefed", "user"): "asked",
            ("asked", "assistant"): "answered",
            ("answered", "user"): "asked",
        }
    )
    accept: Sequence[str] = ("answered",)

    def __post_init__(self) -> None:
        for mark in (self.open, self.end):
            if len(mark) < 2 or "\\" in mark[:2]:
                raise ValueError(f"a mark needs two characters before any backslash: {mark!r}")
        if not self.close or self.close[0] in "%0123456789;":
            raise ValueError(f"no end of a header: {self.close!r}")

    def escaped(self) -> dict[str, str]:
        """For each character that a mark of a text begins with, a pattern of what must not follow it."""
        follows: dict[str, set[str]] = {}
        for mark in (self.open, self.end):
            follows.setdefault(mark[0], set()).add(mark[1])
        return {head: rf"(?=\\*+(?:[{''.join(map(_literal, sorted(nexts)))}]|\z))" for head, nexts in follows.items()}

    def coded(self) -> list[str]:
        """Characters that a role is written without, the sign of the code first."""
        return ["%", *sorted({self.open[0], self.close[0], self.end[0]} - {"%"})]


def _literal(char: str) -> str:
    return rf"\x{{{ord(char):x}}}"


TEMPLATE = Template()


def escape(text: Column, template: Template = TEMPLATE) -> Column:
    pattern = "|".join(_literal(head) + behind for head, behind in template.escaped().items())
    return F.regexp_replace(text, pattern, r"$0\\")


def unescape(text: Column, template: Template = TEMPLATE) -> Column:
    heads = template.escaped()
    pattern = "|".join(rf"({_literal(head)})\\{behind}" for head, behind in heads.items())
    return F.regexp_replace(text, pattern, "".join(f"${k + 1}" for k in range(len(heads))))


def escape_role(role: Column, template: Template = TEMPLATE) -> Column:
    for char in template.coded():
        role = F.replace(role, F.lit(char), F.lit(f"%{ord(char):02X};"))
    return role


def unescape_role(role: Column, template: Template = TEMPLATE) -> Column:
    for char in reversed(template.coded()):
        role = F.replace(role, F.lit(f"%{ord(char):02X};"), F.lit(char))
    return role


def final_state(roles: Column, template: Template = TEMPLATE) -> Column:
    """Runs the machine; ``invalid`` once a role has no move."""

    def step(state: Column, role: Column) -> Column:
        out = F.lit("invalid")
        for (at, by), to in template.moves.items():
            out = F.when((state == at) & (role == by), F.lit(to)).otherwise(out)
        return out

    return F.aggregate(roles, F.lit(template.start), step)


def format_chats(turns: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation: segments with loss flags, the formatted text, whether the order of roles is valid."""
    rows = turns.select(
        "conv_id", F.struct(F.col("turn").alias("turn"), whole("role").alias("role"), whole("text").alias("text")).alias("_turn")
    )

    def segments(turn: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        no = F.lit(False)
        return F.array(
            segment(F.concat(F.lit(template.open), escape_role(turn["role"], template), F.lit(template.close)), no),
            segment(escape(turn["text"], template), turn["role"].isin(list(template.loss))),
            segment(F.lit(template.end), no),
        )

    return (
        rows.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("_turn")).alias("_turns"))
        .select(
            "conv_id",
            F.flatten(F.transform("_turns", segments)).alias("segments"),
            final_state(F.transform("_turns", lambda t: t["role"]), template).isin(list(template.accept)).alias("valid"),
        )
        .select("*", F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"))
    )


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """Turns as an array of (role, text), from the formatted text alone."""
    turn = rf"(?s)\Q{template.open}\E([^{_literal(template.close[0])}]*+)\Q{template.close}\E(.*?)\Q{template.end}\E"
    return F.zip_with(
        F.regexp_extract_all(formatted, F.lit(turn), F.lit(1)),
        F.regexp_extract_all(formatted, F.lit(turn), F.lit(2)),
        lambda role, text: F.struct(unescape_role(role, template).alias("role"), unescape(text, template).alias("text")),
    )


def loss_text(turns: Column, template: Template = TEMPLATE) -> Column:
    """All text under the loss of turns that were read back."""
    return F.array_join(F.transform(F.filter(turns, lambda t: t["role"].isin(list(template.loss))), lambda t: t["text"]), "")


def digests(formatted: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """What the format holds, read back from it."""
    told = F.array_join(F.transform("_read", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    read = formatted.select("conv_id", "valid", "formatted", read_turns(F.col("formatted"), template).alias("_read"))
    return read.select("*", loss_text(F.col("_read"), template).alias("_loss")).select(
        "conv_id",
        F.size("_read").cast("bigint").alias("n_turns"),
        F.sha2(told.cast("binary"), 256).alias("turns_sha256"),
        F.length("_loss").cast("bigint").alias("loss_chars"),
        F.sha2(F.col("_loss").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
        "valid",
    )


#: The conversation that the contract adds: control strings in both texts.
PROBE = r"\### Assistant: </turn> ok"


def with_probe(conversations: DataFrame) -> DataFrame:
    spark = conversations.sparkSession
    probe = spark.range(2).select(
        F.lit(-7).cast("bigint").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PROBE).alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(probe)


SQL = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
t AS (SELECT conv_id, count(*) AS n_turns,
    string_agg(concat(role, chr(10), text, chr(10)), '' ORDER BY turn NULLS FIRST, role, text) AS told,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
    string_agg(role, ' ' ORDER BY turn NULLS FIRST, role, text) AS roles,
    sum(13 + length(replace(replace(replace(role, '%', '%25;'), '|', '%7C;'), '<', '%3C;')) + length(regexp_replace(text, '<(\\*)(\||$)', '<\\\1\2', 'g'))) AS formatted_chars
  FROM c GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(told) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256,
  CAST(formatted_chars AS BIGINT) AS formatted_chars, regexp_full_match(roles, '(system )?user assistant( user assistant)*') AS valid FROM t
"""
