"""Chat formatting with a grammar round trip, on DataFrame functions alone.

A turn is rendered as ``### Role: text</turn>`` and a line end; a conversation is its turns in order. The parser
cuts the output at the end marks, takes the role up to the first ``": "`` and undoes escapes. It is first run on the
plain rendering of each turn; a turn that doesn't come back identical has its control strings escaped, and the
escaped rendering is parsed and compared again. ``round_trip`` says whether the whole conversation came back.

Escapes put a backslash and one letter for a control string, and also for each backslash, so that no control string
is left and undoing them is exact.

Defined cases: null text or role is the empty string; rows order by turn (nulls last), then role and text; rows
with a null conv_id form one conversation; repeated rows are turns of their own; no rows give no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, END = "### ", "</turn>\n"
# Control strings and their escapes. The backslash comes first when escaping and last when undoing.
ESCAPES = [("\\", "\\s"), ("</turn>", "\\t"), ("###", "\\m")]
ROLE_ESCAPES = [*ESCAPES, (":", "\\c"), ("\n", "\\n")]


def _each(text: Column, pairs: list[tuple[str, str]]) -> Column:
    for a, b in pairs:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def escape(text: Column, pairs=ESCAPES) -> Column:
    return _each(text, pairs)


def unescape(text: Column, pairs=ESCAPES) -> Column:
    return _each(text, [(b, a) for a, b in reversed(pairs)])


def render_turn(role: Column, text: Column) -> Column:
    """``role`` and ``text`` as they shall stand in the output."""
    return F.concat(F.lit(OPEN), role, F.lit(": "), text, F.lit(END))


def parse(formatted: Column) -> Column:
    """The turns of a rendered text as an array of ``role, raw, text``."""
    pieces = F.filter(F.split(formatted, END), lambda p: p != "")
    body = F.transform(pieces, lambda p: F.substr(p, F.lit(len(OPEN) + 1)))
    return F.transform(body, lambda p: F.struct(unescape(F.substring_index(p, ": ", 1), ROLE_ESCAPES).alias("role"), F.substr(p, F.locate(": ", p) + 2).alias("raw"), unescape(F.substr(p, F.locate(": ", p) + 2)).alias("text")))


def format_conversations(turns: DataFrame, trained_role: str = "assistant") -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans, round_trip, turns`` with the turns read back from the output.

    ``loss_spans`` are code point spans (start, end; end exclusive) of ``formatted`` that count towards the loss: the trained role's texts.
    """
    t = turns.select("conv_id", "turn", F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # Plain rendering, parsed back turn by turn; what differs is escaped.
    t = t.withColumn("back", parse(render_turn(F.col("role"), F.col("text"))))
    same = (F.size("back") == 1) & (F.get("back", F.lit(0))["role"] == F.col("role")) & (F.get("back", F.lit(0))["text"] == F.col("text"))
    # The grammar has no control string inside a text or role.
    marks = [~F.contains(F.concat("role", "text"), F.lit(a)) for a, _ in ESCAPES]
    t = t.withColumn("plain", F.coalesce(same, F.lit(False)) & marks[0] & marks[1] & marks[2]).drop("back")
    t = t.withColumn("r", F.when(F.col("plain"), F.col("role")).otherwise(escape(F.col("role"), ROLE_ESCAPES))).withColumn("x", F.when(F.col("plain"), F.col("text")).otherwise(escape(F.col("text"))))
    row = F.struct(F.col("turn").isNull().alias("none"), F.col("turn"), F.col("role"), F.col("text"), F.col("r"), F.col("x"))
    c = t.groupBy("conv_id").agg(F.sort_array(F.collect_list(row)).alias("t"))
    c = c.select("conv_id", "t", F.array_join(F.transform("t", lambda y: render_turn(y["r"], y["x"])), "").alias("formatted"))
    lengths = F.transform("t", lambda y: F.struct((y["role"] == trained_role).alias("on"), (F.length(y["r"]) + len(OPEN) + 2).alias("head"), F.length(y["x"]).alias("body")))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"))
    c = c.withColumn("len", lengths)
    spans = F.aggregate(
        "len",
        zero,
        lambda a, y: F.struct(
            (a["at"] + y["head"] + y["body"] + len(END)).alias("at"),
            F.when(y["on"], F.concat(a["spans"], F.array(F.struct((a["at"] + y["head"]).alias("start"), (a["at"] + y["head"] + y["body"]).alias("end"))))).otherwise(a["spans"]).alias("spans"),
        ),
        lambda a: a["spans"],
    )
    c = c.select("conv_id", "formatted", spans.alias("loss_spans"), parse(F.col("formatted")).alias("turns"), F.transform("t", lambda y: F.struct(y["role"], y["text"])).alias("source"))
    back = F.transform("turns", lambda y: F.struct(y["role"], y["text"]))
    return c.select("conv_id", "formatted", "loss_spans", "turns", (back == F.col("source")).alias("round_trip"))


def digests(formatted: DataFrame) -> DataFrame:
    """Counts and digests of the formatted conversations, all read from the output and its mask."""
    masked = F.transform("loss_spans", lambda s: unescape(F.substr("formatted", s["start"] + 1, s["end"] - s["start"])))
    f = formatted.withColumn("loss", F.array_join(masked, "")).withColumn("whole", F.array_join(F.transform("turns", lambda y: F.concat(y["role"], F.lit("\n"), y["text"], F.lit("\n"))), ""))
    return f.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2("whole", 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "round_trip",
    )
