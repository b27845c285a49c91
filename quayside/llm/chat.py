"""Chat formatting: a finite-state machine over roles, and text segments with a loss flag for each.

Everything is a column expression over the sorted array of a conversation's turns. A conversation is the unit of
the output, so its turns meet in one row; nothing larger than one conversation does.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

REJECT = "reject"


@dataclass(frozen=True)
class Template:
    """How turns are written and which role may follow which.

    ``moves`` has the next state for a state and a role; what is missing rejects the conversation. A turn is
    ``opening``, the role, ``after_role``, the text, ``closing``. ``escapes`` are (string, replacement) pairs, the
    first of which is the escape character itself: each replacement is that character and one letter, so undoing
    them from the last to the first restores the text. ``role_escapes`` are further pairs for the role only.
    """

    opening: str = "<|im_start|>"
    after_role: str = "\n"
    closing: str = "<|im_end|>\n"
    loss_roles: tuple[str, ...] = ("assistant",)
    start: str = "start"
    moves: dict[tuple[str, str], str] = field(default_factory=lambda: {
        ("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
        ("user", "assistant"): "assistant", ("assistant", "user"): "user"})
    accepting: tuple[str, ...] = ("assistant",)
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\s"), ("<|", "\\c"))
    role_escapes: tuple[tuple[str, str], ...] = (("\n", "\\n"),)


CHAT = Template()


def _swap(c: Column, pairs) -> Column:
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def escape(c: Column, pairs) -> Column:
    """Write control strings so that they can't be read as turns."""
    return _swap(c, pairs)


def unescape(c: Column, pairs) -> Column:
    return _swap(c, [(new, old) for old, new in reversed(pairs)])


def final_state(turns: Column, template: Template = CHAT) -> Column:
    """The state of the machine after all turns; a role that may not come next leads to ``reject`` for good."""
    moves = F.create_map(*[F.lit(x) for (state, role), after in template.moves.items()
                           for x in (f"{state} {role}", after)])
    return F.aggregate(turns, F.lit(template.start), lambda state, turn: F.coalesce(
        F.try_element_at(moves, F.concat(state, F.lit(" "), turn["role"])), F.lit(REJECT)))


def format_conversations(turns: DataFrame, template: Template = CHAT) -> DataFrame:
    """One row per ``conv_id``: conv_id, valid, segments (array of text and loss), formatted.

    Turns are in the order of ``turn`` (nulls first), then role and text; repeated rows are turns of their own. A
    null text or role is empty, a null ``conv_id`` is a conversation. A conversation that the machine rejects is
    formatted like any other and has ``valid`` false. Other columns are ignored; an empty table gives no rows.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    rows = turns.select("conv_id", F.struct("turn", role.alias("role"), text.alias("text")).alias("_t"))
    talk = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("_t")).alias("_turns"))

    def pieces(turn: Column) -> Column:
        head = F.concat(F.lit(template.opening), escape(turn["role"], template.escapes + template.role_escapes),
                        F.lit(template.after_role))
        body = escape(turn["text"], template.escapes)
        parts = [(head, F.lit(False)), (body, turn["role"].isin(*template.loss_roles)),
                 (F.lit(template.closing), F.lit(False))]
        return F.array(*[F.struct(a.alias("text"), b.alias("loss")) for a, b in parts])

    return (talk.withColumn("valid", final_state(F.col("_turns"), template).isin(*template.accepting))
            .withColumn("segments", F.flatten(F.transform("_turns", pieces))).drop("_turns")
            .withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), "")))


def read_turns(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (array of role and text) that a formatted text holds."""
    close = "\\Q" + template.closing + "\\E"
    parts = F.split(formatted, close, -1)
    whole = F.slice(parts, 1, F.size(parts) - 1)

    def turn(part: Column) -> Column:
        rest = F.substr(part, F.lit(len(template.opening) + 1))
        head = F.substring_index(rest, template.after_role, 1)
        body = F.substr(rest, F.char_length(head) + len(template.after_role) + 1)
        return F.struct(unescape(head, template.escapes + template.role_escapes).alias("role"),
                        unescape(body, template.escapes).alias("text"))

    return F.transform(whole, turn)


def loss_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, as it was before it was escaped."""
    under = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(under, lambda s: unescape(s["text"], template.escapes)), "")
