"""Chat formatting by a finite-state machine over roles and a template.

A template names, per role, the text before a turn, the text after it and
whether the turn's text is under the loss; a machine gives the state after each
role. Conversations come out as one formatted string with the segments that make
it up (text, loss). All on DataFrame functions.

In texts (and in roles that the template doesn't know) every backslash, ``#``
and ``<`` (in roles ``)`` too) gets a backslash before it; each control string begins with ``###``
or ends a turn with a line ``</turn>``, so none can appear in an escaped text,
and dropping those backslashes restores it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalmine.llm.common import let


@dataclass(frozen=True)
class Template:
    """before: control string of each known role; other roles get ``other`` with
    the escaped role in it. after: ends every turn. loss: roles under the loss.
    machine: state -> {role: next state}; final: states a conversation may end in."""

    before: dict[str, str] = field(default_factory=lambda: {
        "system": "### System: ", "user": "### User: ", "assistant": "### Assistant: "})
    other: str = "### Other({}): "
    after: str = "\n</turn>\n"
    loss: tuple[str, ...] = ("assistant",)
    start: str = "start"
    machine: dict[str, dict[str, str]] = field(default_factory=lambda: {
        "start": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user"}})
    final: tuple[str, ...] = ("assistant", "user")


TEMPLATE = Template()


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"([\\#<])", r"\\$1")


def escape_role(role: Column) -> Column:
    return F.regexp_replace(role, r"([\\#<)])", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _map(pairs: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def final_state(roles: Column, t: Template = TEMPLATE) -> Column:
    """The machine's state after an array of roles; null once no step is allowed."""
    steps = _map({f"{a}\n{role}": b for a, by in t.machine.items() for role, b in by.items()})
    return F.aggregate(roles, F.lit(t.start), lambda s, r: steps[F.concat(s, F.lit("\n"), F.coalesce(r, F.lit("")))])


def formatted(turns: DataFrame, t: Template = TEMPLATE) -> DataFrame:
    """(conv_id, valid, formatted, segments) of turns (conv_id, turn, role, text).

    segments: array of (text, loss); formatted: their texts in order. Turns go by
    turn number (null first), then role and text; repeated rows are turns of
    their own. valid: the machine accepts the roles; invalid conversations are
    formatted all the same. Null role or text: empty. A null conv_id is one
    conversation. An empty table gives none.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    convs = turns.select("conv_id", F.struct(F.col("turn"), role.alias("role"), text.alias("text")).alias("t"))
    convs = convs.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    known, left, right = _map(t.before), *[F.lit(x) for x in t.other.split("{}")]

    def segments(x: Column) -> Column:
        r = x["role"]
        before = F.coalesce(known[r], F.concat(left, escape_role(r), right))
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(before, F.lit(False)), part(escape(x["text"]), r.isin(*t.loss)),
                       part(F.lit(t.after), F.lit(False)))

    out = convs.select("conv_id", "turns", F.flatten(F.transform("turns", segments)).alias("segments"))
    state = final_state(F.transform("turns", lambda x: x["role"]), t)
    return out.select("conv_id", F.coalesce(state.isin(*t.final), F.lit(False)).alias("valid"),
                      F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"), "segments")


def read_back(chats: DataFrame, t: Template = TEMPLATE) -> DataFrame:
    """(conv_id, turns, loss_text) from formatted strings alone and from the
    places that the segments' flags mark in them: the unescaped turns (role,
    text), and the unescaped text under the loss."""
    pieces = F.slice(F.split("formatted", r"\Q" + t.after + r"\E", -1), 1,
                     F.size(F.split("formatted", r"\Q" + t.after + r"\E", -1)) - 1)
    left, right = t.other.split("{}")

    def turn(x: Column) -> Column:
        role, text = None, None
        for name, before in t.before.items():
            is_it = x.startswith(before)
            rest = F.substr(x, F.lit(len(before) + 1))
            role = F.when(is_it, name) if role is None else role.when(is_it, name)
            text = F.when(is_it, rest) if text is None else text.when(is_it, rest)
        other = r"(?s)^\Q" + left + r"\E((?:\\.|[^\\#<)])*)\Q" + right + r"\E(.*)$"
        role = role.otherwise(unescape(F.regexp_extract(x, other, 1)))
        text = text.otherwise(F.regexp_extract(x, other, 2))
        return F.struct(role.alias("role"), unescape(text).alias("text"))

    start = F.struct(F.lit(1).cast("long").alias("at"), F.lit([]).cast("array<struct<at:bigint,n:bigint>>").alias("spans"))
    spans = F.aggregate("segments", start, lambda a, s: F.struct(
        (a["at"] + F.length(s["text"])).alias("at"),
        F.when(s["loss"], F.concat(a["spans"], F.array(F.struct(
            a["at"].alias("at"), F.length(s["text"]).cast("long").alias("n"))))).otherwise(a["spans"]).alias("spans")),
        lambda a: a["spans"])
    under = let(F.struct("formatted", spans.alias("spans")), lambda x: F.array_join(F.transform(
        x["spans"], lambda s: unescape(F.substr(x["formatted"], s["at"].cast("int"), s["n"].cast("int")))), ""))
    return chats.select("conv_id", "formatted", F.transform(pieces, turn).alias("turns"), under.alias("loss_text"), "valid")


def digests(chats: DataFrame, t: Template = TEMPLATE) -> DataFrame:
    """(conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars,
    valid), all read back from the formatted output."""
    back = read_back(chats, t)
    flat = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    return back.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(flat, 256).alias("turns_sha256"),
                       F.length("loss_text").cast("long").alias("loss_chars"), F.sha2("loss_text", 256).alias("loss_sha256"),
                       F.length("formatted").cast("long").alias("formatted_chars"), "valid")
