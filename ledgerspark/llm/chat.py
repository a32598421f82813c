"""Chat formatting: a template, a state machine over roles, segments with loss flags.

Built-in expressions only. A conversation becomes one string, so its turns are
gathered in one row; that row is as large as the result it stands for.

Nulls and odd rows: a null text or role counts as empty, a null conversation id is
a conversation of its own, turns with equal numbers follow each other by role and
text, repeated rows stay. A role the machine does not expect makes the conversation
invalid; it is formatted all the same. Other columns are not looked at. Without rows
there is no conversation.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """Marks around turns, the roles that are trained on, and the order roles may come in.

    ``escapes`` holds (text, written as) in the order of replacement. The first
    pair frees the escape sign itself; no control string can then be in a text.
    A mark must not begin with the characters it ends with, so that text before
    it cannot complete another one.
    """

    open: str = "### "
    after_role: str = ": "
    close: str = "</turn>\n"
    escapes: tuple[tuple[str, str], ...] = (("\\", "\\0"), ("</turn>", "\\1"), ("### ", "\\2"))
    role_escapes: tuple[tuple[str, str], ...] = ((": ", "\\3"),)
    trained: tuple[str, ...] = ("assistant",)
    moves: dict[str, tuple[str, ...]] = field(default_factory=lambda: {
        "start": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    })


def _escape(value: Column, pairs) -> Column:
    for plain, written in pairs:
        value = F.replace(value, F.lit(plain), F.lit(written))
    return value


def _unescape(value: Column, pairs) -> Column:
    for plain, written in reversed(pairs):
        value = F.replace(value, F.lit(written), F.lit(plain))
    return value


def end_state(roles: Column, template: Template) -> Column:
    """State after all roles; ``invalid`` once a role came that its state does not allow."""
    moves = [F.lit(x) for state, after in template.moves.items() for role in after
             for x in (f"{state}>{role}", role)]
    table = F.create_map(*moves)
    return F.aggregate(roles, F.lit("start"), lambda state, role: F.coalesce(
        F.try_element_at(table, F.concat(state, F.lit(">"), role)), F.lit("invalid")))


def format_conversations(df: DataFrame, template: Template = Template()) -> DataFrame:
    """(conv_id, state, valid, segments, formatted) from rows (conv_id, turn, role, text).

    ``segments`` is an array of (text, loss); ``formatted`` is their concatenation.
    ``state`` is the machine's last state, ``valid`` says that every move was allowed.
    """
    turn = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    both = (*template.escapes, *template.role_escapes)

    def pieces(t: Column) -> Column:
        def segment(text: Column, loss: Column) -> Column:
            return F.struct(text.alias("text"), loss.alias("loss"))

        no = F.lit(False)
        return F.array(
            segment(F.concat(F.lit(template.open), _escape(t["role"], both), F.lit(template.after_role)), no),
            segment(_escape(t["text"], template.escapes), t["role"].isin(*template.trained)),
            segment(F.lit(template.close), no),
        )

    grouped = df.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    state = end_state(F.transform("turns", lambda t: t["role"]), template)
    return grouped.select(
        "conv_id", state.alias("state"), F.flatten(F.transform("turns", pieces)).alias("segments"),
    ).select(
        "conv_id", "state", (F.col("state") != "invalid").alias("valid"), "segments",
        F.array_join(F.transform("segments", lambda s: s["text"]), "").alias("formatted"),
    )


def trained_text(template: Template = Template()) -> Column:
    """Text under the loss flags of ``segments``, as it was before it was escaped."""
    flagged = F.filter("segments", lambda s: s["loss"])
    return F.array_join(F.transform(flagged, lambda s: _unescape(s["text"], template.escapes)), "")


def read_back(df: DataFrame, template: Template = Template()) -> DataFrame:
    """The rows with ``turns``: array of (role, text, loss) parsed from ``formatted`` alone."""
    both = (*template.escapes, *template.role_escapes)
    after_open = len(template.open) + 1

    def turn(written: Column) -> Column:
        body = F.substring(written, after_open, F.length(written))
        role = _unescape(F.substring_index(body, template.after_role, 1), both)
        # substring_index counts from the left, so what follows the first mark is cut by length
        text = F.substring(body, F.length(F.substring_index(body, template.after_role, 1))
                           + len(template.after_role) + 1, F.length(body))
        return F.struct(role.alias("role"), _unescape(text, template.escapes).alias("text"),
                        role.isin(*template.trained).alias("loss"))

    written = F.split("formatted", "\\Q" + template.close + "\\E")
    return df.withColumn("turns", F.transform(F.slice(written, 1, F.size(written) - 1), turn))
