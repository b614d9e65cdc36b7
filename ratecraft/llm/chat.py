"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent turns of one role become one
message. A message is ``<|role|>`` + its turns' texts, with ``<+>`` between them, + ``</s>``. Inside
texts and roles ``&``, ``<``, ``[`` and ``|`` are written ``&amp;``, ``&lt;``, ``&lb;`` and ``&bar;``, so that neither these
control strings nor those of other templates (``[INST]``) can come from a text or a role; reading back undoes it.

The loss mask tells, for each stretch of the formatted text in order, its length and whether it counts:
the texts of assistant turns do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Control strings of the template.
OPEN, SHUT, AND, END = "<|", "|>", "<+>", "</s>"
#: How a text's characters are written where they could start a control string, in the order of escaping.
ESCAPES = (("&", "&amp;"), ("<", "&lt;"), ("[", "&lb;"), ("|", "&bar;"))
TRAINED_ROLE = "assistant"


def escape(text: Column) -> Column:
    for raw, written in ESCAPES:
        text = F.replace(text, F.lit(raw), F.lit(written))
    return text


def unescape(text: Column) -> Column:
    for raw, written in reversed(ESCAPES):
        text = F.replace(text, F.lit(written), F.lit(raw))
    return text


def format_conversations(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, formatted, loss_mask (array of chars, loss).

    ``turns`` has conv_id, turn, role and text; other columns are not read. Null texts and roles count as
    empty. Turns are sorted by turn (null first), then role, then text; repeated rows stay. A null conv_id is
    one conversation. An empty table gives no row. A conversation must fit one value (2 GB).
    """
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    turn = F.struct("turn", blank("role").alias("role"), blank("text").alias("text"))
    sorted_turns = turns.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn), _by_turn).alias("_t"))
    # Each turn with its neighbours' roles, by position: a first or last turn has none.
    roles = F.transform("_t", lambda x: x["role"])
    none = F.array(F.lit(None).cast("string"))
    size = F.size("_t")
    with_roles = sorted_turns.select("conv_id", F.arrays_zip(
        F.col("_t").alias("t"), F.concat(none, F.slice(roles, 1, size - 1)).alias("before"),
        F.concat(F.slice(roles, 2, size), none).alias("after")).alias("_z"))

    def stretches(x: Column) -> Column:
        role = x["t"]["role"]
        head = F.when(x["before"].eqNullSafe(role), F.lit(AND)).otherwise(F.concat(F.lit(OPEN), escape(role), F.lit(SHUT)))
        tail = F.when(x["after"].eqNullSafe(role), F.lit("")).otherwise(F.lit(END))
        part = lambda s, loss: F.struct(s.alias("s"), loss.alias("loss"))
        return F.array(part(head, F.lit(False)), part(escape(x["t"]["text"]), role == TRAINED_ROLE), part(tail, F.lit(False)))

    parts = with_roles.select("conv_id", F.flatten(F.transform("_z", stretches)).alias("_p"))
    return parts.select("conv_id", F.array_join(F.transform("_p", lambda p: p["s"]), "").alias("formatted"),
                        F.transform("_p", lambda p: F.struct(F.char_length(p["s"]).alias("chars"), p["loss"].alias("loss"))).alias("loss_mask"))


def _by_turn(a: Column, b: Column) -> Column:
    """Order of two turns: by number, null first, then role, then text."""
    def compare(x: Column, y: Column, otherwise: Column) -> Column:
        return (F.when(x.isNull() & y.isNotNull(), -1).when(x.isNotNull() & y.isNull(), 1)
                .when(x < y, -1).when(x > y, 1).otherwise(otherwise))
    return compare(a["turn"], b["turn"], compare(a["role"], b["role"], compare(a["text"], b["text"], F.lit(0))))


def read_back(formatted: DataFrame) -> DataFrame:
    """conv_id, turns (array of role, text) and loss_text, from the formatted text and its mask alone.

    The formatted text is cut at the control strings; the mask says which of the texts between them count.
    """
    messages = F.filter(F.split("formatted", r"</s>", -1), lambda m: m != "")

    def turns(message: Column) -> Column:
        role = unescape(F.substring_index(F.substring_index(message, SHUT, 1), OPEN, -1))
        body = F.substring(message, F.instr(message, SHUT) + 2, F.char_length(message))
        return F.transform(F.split(body, r"<\+>", -1), lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    read = formatted.select("conv_id", F.flatten(F.transform(messages, turns)).alias("turns"), "loss_mask")
    # Three stretches of the mask to a turn: what opens it, its text, what ends it.
    counts = F.transform(F.sequence(F.lit(2), F.size("loss_mask") - 1, F.lit(3)), lambda i: F.element_at("loss_mask", i))
    kept = F.filter(F.arrays_zip(F.col("turns").alias("t"), counts.alias("m")), lambda x: x["m"]["loss"])
    return read.select("conv_id", "turns", F.array_join(F.transform(kept, lambda x: x["t"]["text"]), "").alias("loss_text"))


def digest(formatted: DataFrame) -> DataFrame:
    """Per conversation: conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars."""
    keep = formatted.select("conv_id", "formatted", "loss_mask")
    messages = read_back(keep.withColumn("conv_id", F.struct("conv_id", F.char_length("formatted").alias("n"))))
    every = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return messages.select(F.col("conv_id.conv_id").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"),
                           F.sha2(every, 256).alias("turns_sha256"), F.char_length("loss_text").cast("long").alias("loss_chars"),
                           F.sha2("loss_text", 256).alias("loss_sha256"), F.col("conv_id.n").cast("long").alias("formatted_chars"))
