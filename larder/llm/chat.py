"""Chat formatting by prefix-target expansion, in DataFrame functions only.

Every assistant turn becomes an example: the text of all turns up to and with it, of which only that reply is
trainable. Turns after the last reply make one more example without a trainable part, so nothing is lost.

    turn       <s>ROLE newline BODY space </s> newline
    BODY       user: [INST] TEXT [/INST]    system: <<SYS>> TEXT <</SYS>>    any other role: TEXT

A control string inside a text gets one backslash in front of it (and of the backslashes before it); taking one away
gives the text back. A text always ends with a space before the next control string, so its own last backslash is no
escape. Roles are percent-encoded.

Defined results: null role and text are empty strings; turns are ordered by turn, then role, then text, nulls first;
repeated rows are turns of their own; a null conv_id is one conversation; an empty table gives none. Extra columns are
not read. A conversation is one value (its text is hashed as a whole), so its turns meet in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTROL = r"(?:</?s>|\[/?INST\]|<</?SYS>>)"
TURN = r"(?s)(?<!\\)<s>([^\n]*)\n(.*?) (?<!\\)</s>\n"


def escape(text: Column) -> Column:
    return F.regexp_replace(text, rf"(\\*{CONTROL})", r"\\$1")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, rf"\\(\\*{CONTROL})", "$1")


def _around(role: Column, user: str, system: str) -> Column:
    return F.when(role == "user", user).when(role == "system", system).otherwise("")


def examples(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, example (from 0), formatted, loss_start, loss_length (code points; null and 0: nothing to train on)."""
    role_col = F.coalesce(turns[role].cast("string"), F.lit(""))
    before = F.concat(F.lit("<s>"), F.url_encode(role_col), F.lit("\n"), _around(role_col, "[INST] ", "<<SYS>> "))
    body = escape(F.coalesce(turns[text].cast("string"), F.lit("")))
    after = F.concat(_around(role_col, " [/INST]", " <</SYS>>"), F.lit(" </s>\n"))
    made = turns.select(
        turns[conv_id].alias("conv_id"),
        F.struct(turns[turn].alias("turn"), role_col.alias("role"), turns[text].cast("string").alias("text"), F.concat(before, body, after).alias("piece"), F.length(before).alias("skip"), F.length(body).alias("size")).alias("t"),
    )
    whole = made.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    zero = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<end:int,loss_start:int,loss_length:int>>").alias("made"))

    def step(state: Column, t: Column) -> Column:
        end = state["end"] + F.length(t["piece"])
        cut = F.struct(end.alias("end"), (state["end"] + t["skip"]).alias("loss_start"), t["size"].alias("loss_length"))
        return F.struct(end.alias("end"), F.when(t["role"] == "assistant", F.concat(state["made"], F.array(cut))).otherwise(state["made"]).alias("made"))

    def finish(state: Column) -> Column:
        tail = F.struct(state["end"].alias("end"), F.lit(None).cast("int").alias("loss_start"), F.lit(0).alias("loss_length"))
        done = F.size(state["made"]) > 0
        return F.when(done & (F.element_at(state["made"], -1)["end"] == state["end"]), state["made"]).otherwise(F.concat(state["made"], F.array(tail)))

    cuts = whole.select("conv_id", F.array_join(F.transform("turns", lambda t: t["piece"]), "").alias("all"), F.aggregate("turns", zero, step, finish).alias("cuts"))
    each = cuts.select("conv_id", "all", F.posexplode("cuts").alias("example", "cut"))
    return each.select("conv_id", "example", F.substring("all", F.lit(1), F.col("cut.end")).alias("formatted"), F.col("cut.loss_start").alias("loss_start"), F.col("cut.loss_length").alias("loss_length"))


def parse(formatted: Column) -> Column:
    """The turns of a formatted text as an array of (role, text)."""
    roles, bodies = F.regexp_extract_all(formatted, F.lit(TURN), F.lit(1)), F.regexp_extract_all(formatted, F.lit(TURN), F.lit(2))

    def back(role: Column, body: Column) -> Column:
        name = F.url_decode(role)
        inner = F.when(name == "user", F.substring(body, F.lit(8), F.length(body) - 15)).when(name == "system", F.substring(body, F.lit(9), F.length(body) - 17)).otherwise(body)
        return F.struct(name.alias("role"), unescape(inner).alias("text"))

    return F.zip_with(roles, bodies, back)


def digest(made: DataFrame) -> DataFrame:
    """Per conversation, read back from its examples: the turns of the longest one, and what the loss masks cover."""
    loss = F.coalesce(unescape(F.substring("formatted", F.col("loss_start") + 1, F.col("loss_length"))), F.lit(""))
    by = made.select("conv_id", "example", F.length("formatted").alias("size"), loss.alias("loss"), "formatted").groupBy("conv_id").agg(
        F.max_by("formatted", "example").alias("formatted"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("example", "loss"))), lambda x: x["loss"]), "").alias("loss"),
        F.sum("size").alias("formatted_chars"),
    )
    read = by.select("conv_id", parse(F.col("formatted")).alias("turns"), "loss", "formatted_chars")
    text = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return read.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), sha(text).alias("turns_sha256"), F.length("loss").cast("bigint").alias("loss_chars"), sha(F.col("loss")).alias("loss_sha256"), F.col("formatted_chars").cast("bigint").alias("formatted_chars"))
