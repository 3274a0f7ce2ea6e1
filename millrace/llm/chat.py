r"""Chats from event logs: fold the events of each message, then render them with a reversible template.

Events have conv_id, seq, turn, place, kind, role and text.  ``message`` sets a message, ``delta`` appends to it,
``edit`` replaces it and ``regenerate`` empties it for new deltas; the last two also withdraw every earlier event of
later turns, as the talk goes on from there.  ``place`` tells messages of one turn apart.

Template: ``### Role: text</turn>`` and a line end for each message.  Within a text a backslash is doubled,
``</turn>`` becomes ``<\/turn>`` and ``### `` becomes ``#\## ``, so the marks occur only as marks and dropping one
backslash before any character restores the text.  Roles of small letters are capitalised; any other role is written
as ``=`` and its escaped text.

Formatted text is kept in chunks of ``CHUNK`` turns of a conversation with the spans of assistant text (the loss mask),
so a conversation that holds a third of all rows is rendered by many tasks; the chunks in order are the chat.

Null texts and roles are empty.  Null turns come first; null conversation ids are one conversation.  Equal turns are
ordered by role and text; repeated rows are messages of their own.  Conversations without live messages give no row.
Events of equal seq are ordered by kind and text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CHUNK = 64
ASSISTANT = "assistant"
_CUTS = ("edit", "regenerate")
_RESETS = ("message", *_CUTS)
_MESSAGE = ["conv_id", "turn", "place"]


def log_of(rows: DataFrame) -> DataFrame:
    """Each row (conv_id, turn, role, text) of a finished table as one ``message`` event."""
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    clean = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    return clean.select(
        "conv_id", F.lit(0).cast("long").alias("seq"), "turn", F.row_number().over(order).alias("place"),
        F.lit("message").alias("kind"), "role", "text",
    )


def fold(events: DataFrame) -> DataFrame:
    """Final messages: conv_id, turn, place, role (the last one given), text.

    The last reset of each message and the last cut at or before its turn bound its live events from below.  Running
    over a conversation's turns needs one small row per message, never the texts.
    """
    last = lambda kinds: F.max(F.when(F.col("kind").isin(*kinds), F.col("seq")))
    role = F.max_by("role", F.when(F.col("role").isNotNull(), F.col("seq")))
    bounds = events.groupBy(*_MESSAGE).agg(last(_RESETS).alias("reset"), last(_CUTS).alias("cut"), F.coalesce(role, F.lit("")).alias("role"))
    before = Window.partitionBy("conv_id").orderBy("turn").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    bounds = bounds.select(*_MESSAGE, "role", F.greatest("reset", F.max("cut").over(before)).alias("since"))
    e, b = events.alias("e"), bounds.alias("b")
    same = [F.col(f"e.{c}").eqNullSafe(F.col(f"b.{c}")) for c in _MESSAGE]
    live = e.join(b, same[0] & same[1] & same[2]).where("b.since is null or e.seq >= b.since")
    kept = F.array_sort(F.collect_list(F.struct("e.seq", "e.kind", "e.text")))
    text = F.array_join(F.transform(kept, lambda x: F.coalesce(x["text"], F.lit(""))), "")
    return live.groupBy(*[F.col(f"e.{c}") for c in _MESSAGE], "b.role").agg(text.alias("text"))


def escape(text: Column) -> Column:
    text = F.replace(text, F.lit("\\"), F.lit("\\\\"))
    text = F.replace(text, F.lit("</turn>"), F.lit("<\\/turn>"))
    return F.replace(text, F.lit("### "), F.lit("#\\## "))


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _role_out(role: Column) -> Column:
    plain = F.concat(F.upper(F.substring(role, 1, 1)), F.substring(role, 2, 1 << 30))
    other = F.concat(F.lit("="), F.replace(escape(role), F.lit(": "), F.lit(":\\ ")))
    return F.when(role.rlike(r"\A[a-z]+\z"), plain).otherwise(other)


def _role_in(written: Column) -> Column:
    return F.when(written.startswith("="), unescape(F.substring(written, 2, 1 << 30))).otherwise(F.lower(written))


def render(messages: DataFrame) -> DataFrame:
    """conv_id, chunk, formatted, spans (start and length in code points of assistant text within the chunk)."""
    head = F.concat(F.lit("### "), _role_out(F.col("role")), F.lit(": "))
    rows = messages.select(
        *_MESSAGE, "role", F.floor(F.col("turn") / CHUNK).alias("chunk"), head.alias("head"), escape(F.col("text")).alias("body")
    ).withColumn("shown", F.concat("head", "body", F.lit("</turn>\n")))
    before = Window.partitionBy("conv_id", "chunk").orderBy("turn", "place").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum(F.length("shown")).over(before), F.lit(0)) + F.length("head")
    rows = rows.select(*_MESSAGE, "chunk", "shown", F.when(F.col("role") == ASSISTANT, F.struct(start.alias("start"), F.length("body").cast("long").alias("length"))).alias("span"))
    kept = rows.groupBy("conv_id", "chunk").agg(F.array_sort(F.collect_list(F.struct("turn", "place", "shown", "span"))).alias("own"))
    spans = F.transform(F.filter("own", lambda x: x["span"].isNotNull()), lambda x: x["span"])
    return kept.select("conv_id", "chunk", F.array_join(F.transform("own", lambda x: x["shown"]), "").alias("formatted"), spans.alias("spans"))


def format_chats(events: DataFrame) -> DataFrame:
    """Formatted chats of an event log."""
    return render(fold(events))


def digests(formatted: DataFrame) -> DataFrame:
    """Read the formatted chats back: turns, loss text and lengths per conversation."""
    turns = F.split("formatted", "</turn>\n")
    turns = F.slice(turns, 1, F.size(turns) - 1)

    def read(turn: Column) -> Column:
        body = F.substring(turn, 5, 1 << 30)
        at = F.instr(body, ": ")
        return F.concat(_role_in(body.substr(F.lit(1), at - 1)), F.lit("\n"), unescape(body.substr(at + 2, F.length(body))), F.lit("\n"))

    loss = F.transform("spans", lambda s: unescape(F.col("formatted").substr((s["start"] + 1).cast("int"), s["length"].cast("int"))))
    chunks = formatted.select(
        "conv_id", "chunk", F.size(turns).cast("long").alias("n"), F.array_join(F.transform(turns, read), "").alias("told"),
        F.array_join(loss, "").alias("loss"), F.length("formatted").cast("long").alias("chars"),
    )
    own = chunks.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), F.array_sort(F.collect_list(F.struct("chunk", "told", "loss"))).alias("own"),
        F.sum("chars").alias("formatted_chars"), F.sum(F.length("loss")).alias("loss_chars"),
    )
    whole = lambda part: F.sha2(F.array_join(F.transform("own", lambda x: x[part]), ""), 256)
    return own.select(
        "conv_id", "n_turns", whole("told").alias("turns_sha256"), F.col("loss_chars").cast("long").alias("loss_chars"),
        whole("loss").alias("loss_sha256"), "formatted_chars",
    )
