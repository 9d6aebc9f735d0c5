"""Chat formatting: a finite-state machine over roles checks turn order; a declarative template emits segments.

DataFrame functions only. Control strings inside texts are escaped by a backslash between ``<`` and ``|`` (one more
where some stand there already), which ``unescape`` takes back; so no text holds a control string, and formatted
output splits into turns without ambiguity. Role names are percent-escaped.

Null roles and texts count as empty. Turns with the same number are ordered by role and text; repeated rows stay.
Roles that the template doesn't know are formatted, carry no loss and make the order invalid. A text of any length is
formatted whole; a conversation's turns meet in one row, so they must fit in a task. Extra columns are ignored; an empty
table gives an empty table.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A template: control strings, roles under the loss mask, and the machine: state -> role -> next state.
CHATML = {
    "open": "<|im_start|>",
    "after_role": "\n",
    "close": "<|im_end|>\n",
    "loss": ["assistant"],
    "begin": "begin",
    "moves": {
        "begin": {"system": "system", "user": "user"},
        "system": {"user": "user"},
        "user": {"assistant": "assistant"},
        "assistant": {"user": "user", "tool": "tool"},
        "tool": {"tool": "tool", "assistant": "assistant"},
    },
    "final": ["assistant"],
}


def escape(text: Column) -> Column:
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", "<$1|")


def escape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%"), F.lit("%25")), F.lit("\n"), F.lit("%0A")), F.lit("|"), F.lit("%7C"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("%7C"), F.lit("|")), F.lit("%0A"), F.lit("\n")), F.lit("%25"), F.lit("%"))


def run_machine(roles: Column, template: dict) -> Column:
    """struct(state, bad): the state after the last role, and how many roles the machine refused."""
    moves = [F.lit(x) for state, to in template["moves"].items() for role, new in to.items() for x in (f"{state}\n{role}", new)]
    table = F.create_map(*moves)

    def step(at: Column, role: Column) -> Column:
        new = F.try_element_at(table, F.concat(at["state"], F.lit("\n"), role))
        return F.struct(F.coalesce(new, role).alias("state"), (at["bad"] + F.when(new.isNull(), 1).otherwise(0)).alias("bad"))

    return F.aggregate(roles, F.struct(F.lit(template["begin"]).alias("state"), F.lit(0).alias("bad")), step)


def format_chats(turns: DataFrame, template: dict = CHATML) -> DataFrame:
    """turns (conv_id, turn, role, text) to one row per conversation: segments array<struct<text, loss>>, formatted
    text, valid (the machine took every role and ended in a final state) and bad_turns."""
    row = F.struct("turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    chats = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("turns"))

    def emit(t: Column) -> Column:
        return F.array(
            F.struct(F.concat(F.lit(template["open"]), escape_role(t["role"]), F.lit(template["after_role"])).alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(t["text"]).alias("text"), t["role"].isin(template["loss"]).alias("loss")),
            F.struct(F.lit(template["close"]).alias("text"), F.lit(False).alias("loss")),
        )

    chats = chats.select("conv_id", F.flatten(F.transform("turns", emit)).alias("segments"), run_machine(F.col("turns.role"), template).alias("machine"))
    return chats.select(
        "conv_id",
        "segments",
        F.array_join("segments.text", "").alias("formatted"),
        ((F.col("machine.bad") == 0) & F.col("machine.state").isin(template["final"])).alias("valid"),
        F.col("machine.bad").alias("bad_turns"),
    )


def parse_chats(formatted: Column, template: dict = CHATML) -> Column:
    """Formatted text back to array<struct<role, text>>."""
    quoted = "".join(f"\\{c}" if not c.isalnum() and c != "_" else c for c in template["open"])
    parts = F.split(formatted, quoted)

    def read(part: Column) -> Column:
        role = F.substring_index(part, template["after_role"], 1)
        head, tail = len(template["after_role"]), len(template["close"])
        return F.struct(unescape_role(role).alias("role"), unescape(F.substring(part, F.length(role) + head + 1, F.length(part) - F.length(role) - head - tail)).alias("text"))

    return F.transform(F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0))), read)


def loss_text(segments: Column) -> Column:
    """The text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")
