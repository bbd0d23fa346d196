"""Chat formatting from a declarative template; DataFrame functions only.

A template names, for every role, the literal and text segments of a turn and which of them are learned from.
Turn order is checked by a finite-state machine over roles. Each turn becomes its segments row by row; the
turns of a conversation then meet in one row, ordered, and the machine folds over the roles with a state of
two numbers. The output of a conversation is one sequence, so it is one row; collecting merges the turns of a
task before the shuffle.

Control strings inside texts are escaped: every ``<|`` becomes ``<||``. Markers have exactly one bar after
``<``, so no text can end or begin a turn, and dropping one bar gives the text back.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TEXT, ROLE = object(), object()


@dataclass(frozen=True)
class Part:
    """A piece of a turn: a literal, the turn's TEXT or its ROLE, and whether it is learned from."""

    what: object
    loss: bool = False


START, END = "<|im_start|>", "<|im_end|>"


def _turn(loss: bool) -> tuple[Part, ...]:
    return (Part(START), Part(ROLE), Part("\n"), Part(TEXT, loss), Part(END + "\n"))


@dataclass(frozen=True)
class Template:
    """``turns``: parts by role; ``other``: parts of roles not named. ``follows``: the roles that may come
    after a role, ``None`` standing for the begin of a conversation; ``final``: roles that may end one.
    Literals may only hold ``<|`` as the begin of a marker with a single bar."""

    turns: Mapping[str, Sequence[Part]] = field(default_factory=lambda: {"assistant": _turn(True)})
    other: Sequence[Part] = _turn(False)
    follows: Mapping[str | None, Sequence[str]] = field(
        default_factory=lambda: {None: ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}
    )
    final: Sequence[str] = ("assistant",)


CHATML = Template()


def escape(text: Column) -> Column:
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit("<||"), F.lit("<|"))


def _escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("<|nl|>"))


def _unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("<|nl|>"), F.lit("\n")))


def _segments(parts: Sequence[Part], role: Column, text: Column) -> Column:
    value = {id(TEXT): escape(text), id(ROLE): _escape_role(role)}
    merged: list[tuple[list[Column], bool]] = []
    for part in parts:
        column = value.get(id(part.what), None)
        column = F.lit(part.what) if column is None else column
        if merged and merged[-1][1] == part.loss:
            merged[-1][0].append(column)
        else:
            merged.append(([column], part.loss))
    return F.array(*(F.struct(F.concat(*columns).alias("text"), F.lit(loss).alias("loss")) for columns, loss in merged))


def _states(template: Template) -> list[str | None]:
    return list(dict.fromkeys([*template.follows, *(r for after in template.follows.values() for r in after)]))


def _bad_turn(template: Template, roles: Column) -> Column:
    """Position of the first turn the machine does not accept, or -1. The state is the last role's number."""
    states = _states(template)
    begin = states.index(None)

    def number(role: Column) -> Column:
        chain = F.lit(-1)
        for i, name in enumerate(states):
            if name is not None:
                chain = F.when(role == name, F.lit(i)).otherwise(chain)
        return chain

    def allowed(state: Column, to: Column) -> Column:
        return F.array(*(F.lit(states.index(a) * len(states) + states.index(b)) for a, after in template.follows.items() for b in after)), state * len(states) + to

    def step(acc: Column, role: Column) -> Column:
        to = number(role)
        pairs, pair = allowed(acc["state"], to)
        ok = (to >= 0) & F.array_contains(pairs, pair)
        return F.struct(
            to.alias("state"),
            (acc["at"] + 1).alias("at"),
            F.when((acc["bad"] < 0) & ~F.coalesce(ok, F.lit(False)), acc["at"]).otherwise(acc["bad"]).alias("bad"),
        )

    final = [states.index(r) for r in template.final if r in states]
    start = F.struct(F.lit(begin).alias("state"), F.lit(0).alias("at"), F.lit(-1).alias("bad"))
    return F.aggregate(roles, start, step, lambda a: F.when((a["bad"] < 0) & ~a["state"].isin(final), a["at"]).otherwise(a["bad"]))


def format_chats(turns: DataFrame, template: Template = CHATML, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: ``conv, n_turns, valid, bad_turn, segments``.

    ``segments`` is the formatted conversation, an array of ``(text, loss)`` in order; their texts joined are
    the sequence to train on. ``valid`` tells whether the machine accepts the roles, ``bad_turn`` counts the
    turns before the first one it refuses (the number of turns if only the end is refused, null if valid);
    invalid conversations are formatted like the others and left to the caller.

    Turns are ordered by ``turn`` (null first), ties by role and text; repeated rows are turns like any
    other. Null text and null role are empty; a null conversation id is a conversation of its own. An empty
    table gives no rows. Other columns are ignored.
    """
    r, t = F.coalesce(F.col(role), F.lit("")), F.coalesce(F.col(text), F.lit(""))
    segments = _segments(template.other, r, t)
    for name, parts in template.turns.items():
        segments = F.when(r == name, _segments(parts, r, t)).otherwise(segments)
    rows = turns.select(F.col(conv).alias("conv"), F.struct(F.col(turn).alias("turn"), r.alias("role"), segments.alias("segments")).alias("one"))
    chats = rows.groupBy("conv").agg(F.array_sort(F.collect_list("one")).alias("all"))
    bad = _bad_turn(template, F.col("roles"))
    chats = chats.select("conv", F.transform("all", lambda x: x["role"]).alias("roles"), F.flatten(F.transform("all", lambda x: x["segments"])).alias("segments"))
    return chats.select(F.col("conv").alias(conv), F.size("roles").cast("bigint").alias("n_turns"), "segments", bad.alias("bad")).select(
        conv, "n_turns", (F.col("bad") < 0).alias("valid"), F.when(F.col("bad") >= 0, F.col("bad")).alias("bad_turn"), "segments"
    )


def sequence(segments: Column) -> Column:
    """The formatted conversation."""
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def learned(segments: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def parse(formatted: Column) -> Column:
    """Back from a sequence made with ``CHATML``: an array of ``(role, text)``."""
    pieces = F.filter(F.split(formatted, r"<\|im_start\|>"), lambda p: p != "")
    return F.transform(
        pieces,
        lambda p: F.struct(
            _unescape_role(F.substring_index(p, "\n", 1)).alias("role"),
            unescape(F.regexp_replace(F.regexp_replace(p, r"\A[^\n]*\n", ""), r"<\|im_end\|>\n\z", "")).alias("text"),
        ),
    )
