"""Chat formatting: a finite-state machine over roles, and a declarative template.

The machine reads the roles in order. Its state after a turn says whether the turn's text is learnt, and whether the move was one of the template. After a
move that the template lacks it goes on from the state named like the role (an unnamed one if there is none), so later turns keep their flags.

Each turn becomes ``<|role|>`` line feed, text, ``<|end|>`` line feed. Inside roles and texts ``\\``, ``<`` and ``[`` are
written as ``\\\\``, ``\\l`` and ``\\b`` (and in roles ``|`` as ``\\p``), so no text can hold a marker of this template or any other control string
such as ``</s>`` or ``[INST]``; the reading side takes the escapes back. Everything is one
aggregation by conversation and column expressions over its turns.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Text around a turn, the states whose text is learnt, and the machine: state -> {role: next state}."""

    before_role: str = "<|"
    after_role: str = "|>\n"
    after_text: str = "<|end|>\n"
    learnt: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[str, dict[str, str]] = field(
        default_factory=lambda: {
            "start": {"system": "system", "user": "user"},
            "system": {"user": "user"},
            "user": {"assistant": "assistant"},
            "assistant": {"user": "user", "tool": "tool"},
            "tool": {"assistant": "assistant", "tool": "tool"},
        }
    )


TEMPLATE = Template()
#: Written form of each character that could begin a control string; the escape character comes first.
_ESCAPES = (("\\", "\\\\"), ("<", "\\l"), ("[", "\\b"))


def escape(text: Column) -> Column:
    for raw, written in _ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    # Split at escaped escapes first, so that the rest of each part holds only the others.
    parts = F.split(text, r"\\\\", -1)
    plain = F.transform(parts, lambda p: F.replace(F.replace(F.replace(p, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("[")), F.lit("\\p"), F.lit("|")))
    return F.array_join(plain, "\\")


def run_machine(roles: Column, template: Template) -> Column:
    """[(state, valid)] of the roles, one for each turn. The fold writes one letter for a state, a capital after a move that the template lacks."""
    states = list(dict.fromkeys([template.start, *template.moves, *(s for to in template.moves.values() for s in to.values()), *template.learnt, ""]))
    if len(states) > 26:
        raise ValueError("a template has at most 25 states")
    letter = {s: chr(ord("a") + i) for i, s in enumerate(states)}
    moves = F.create_map(*(F.lit(x) for state, to in template.moves.items() for role, nxt in to.items() for x in (f"{letter[state]} {role}", letter[nxt])))
    again = F.create_map(*(F.lit(x) for s in states for x in (s, letter[s].upper())))
    step = lambda path, role: F.concat(
        path, F.coalesce(F.element_at(moves, F.concat_ws(" ", F.lower(F.right(path, F.lit(1))), role)), F.element_at(again, role), F.lit(letter[""].upper()))
    )
    path = F.aggregate(roles, F.lit(letter[template.start]), step)
    names = F.create_map(*(F.lit(x) for s in states for x in (letter[s], s)))
    return F.transform(F.split(F.substr(path, F.lit(2)), ""), lambda c: F.struct(F.element_at(names, F.lower(c)).alias("state"), (c == F.lower(c)).alias("valid")))


def format_conversations(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", template: Template = TEMPLATE) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid_order (every move is one of the template), segments [(text, loss)] and formatted (segments joined).

    Turns are ordered by turn number, then role, then text, so ties and repeated rows have one result; a null turn
    number comes first, a null role or text is empty. A conversation whose roles break the machine is formatted all
    the same, with valid_order false. Rows with a null conversation id form one conversation. Other columns are
    ignored; an empty table gives no rows. A conversation is one row, so its own texts are held together.
    """
    s = F.struct(F.col(turn_col).alias("turn"), F.coalesce(F.col(role_col), F.lit("")).alias("role"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    grouped = turns.select(F.col(conv_col).alias("conv_id"), s.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))

    def segments(t: Column, state: Column) -> Column:
        head = F.concat(F.lit(template.before_role), F.replace(escape(t["role"]), F.lit("|"), F.lit("\\p")), F.lit(template.after_role))
        learnt = state["state"].isin(*template.learnt)
        part = lambda text, loss: F.struct(text.alias("text"), loss.alias("loss"))
        return F.array(part(head, F.lit(False)), part(escape(t["text"]), learnt), part(F.lit(template.after_text), F.lit(False)))

    ran = grouped.withColumn("states", run_machine(F.transform("turns", lambda t: t["role"]), template))
    return ran.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.forall("states", lambda x: x["valid"]).alias("valid_order"),
        F.flatten(F.zip_with("turns", "states", segments)).alias("segments"),
    ).withColumn("formatted", F.array_join(F.transform("segments", lambda x: x["text"]), ""))


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """[(role, text)] of a formatted text: the reverse of the template."""
    parts = F.filter(F.split(formatted, _literal(template.after_text), -1), lambda p, i: p != "")
    body = lambda p: F.substring_index(p, template.after_role, 1)

    def turn(p: Column) -> Column:
        role = F.substr(body(p), F.lit(len(template.before_role) + 1))
        text = F.substr(p, F.length(body(p)) + len(template.after_role) + 1)
        return F.struct(unescape(role).alias("role"), unescape(text).alias("text"))

    return F.transform(parts, turn)


def _literal(text: str) -> str:
    return "".join("\\" + c if c in "\\|^$.?*+()[]{}" else c for c in text)


def learnt_texts(segments: Column) -> Column:
    """Texts under the loss mask, unescaped, in order."""
    return F.transform(F.filter(segments, lambda x: x["loss"]), lambda x: unescape(x["text"]))
