"""Chat formatting by event-sourced reconstruction. DataFrame only.

A conversation is a log of events; each names the turn it writes to:

* ``message``    - sets the turn's text;
* ``delta``      - appends to it (streamed pieces);
* ``edit``       - sets it, and discards every later turn written before;
* ``regenerate`` - the same, for an answer made anew.

Events are folded in sequence order: first per (conversation, turn), which
spreads a long conversation's events over tasks, then the final messages of a
conversation are joined into one string, as the format asks for.

Template: ``<|role|>`` line feed, text, ``<|end|>`` line feed, per turn. Inside
roles and texts ``~ < [`` (and in roles ``|`` and line feeds) are written as
``~0 ~1 ~2 ~3 ~4``, so no text can form a control string of this template or of
the common ones that begin with ``<`` or ``[``; :func:`unescape` restores them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Control strings and the escapes, ``~`` first when escaping.
END = "<|end|>\n"
HEAD_END = "|>\n"
TEXT_ESCAPES = (("~", "~0"), ("<", "~1"), ("[", "~2"))
ROLE_ESCAPES = TEXT_ESCAPES + (("|", "~3"), ("\n", "~4"))
RESETS = ("message", "edit", "regenerate")
REWINDS = ("edit", "regenerate")


def escape(text: Column, pairs=TEXT_ESCAPES) -> Column:
    for plain, code in pairs:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column) -> Column:
    for plain, code in reversed(ROLE_ESCAPES):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


def fold_events(events: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) of the final messages of an event log.

    ``events``: conv_id, seq long, turn long, kind, role, text. Events of one
    turn are taken by seq, ties by kind, role and text. Null text is empty, null
    role the empty role, null kind a message, null seq first. A turn with only
    deltas starts empty. The role is the last reset's, else the first event's.
    """
    e = events.select(
        "conv_id", F.coalesce("seq", F.lit(-(1 << 62))).alias("seq"), "turn", F.coalesce("kind", F.lit("message")).alias("kind"),
        F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    # Per turn: the last rewind of any earlier turn; events before it are discarded.
    at = F.max(F.when(F.col("kind").isin(*REWINDS), F.col("seq")))
    earlier = Window.partitionBy("c").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        e.groupBy(F.col("conv_id").alias("c"), F.col("turn").alias("t")).agg(at.alias("at"))
        .select("c", "t", F.max("at").over(earlier).alias("after"))
        .where("after is not null")
    )
    same = F.col("conv_id").eqNullSafe(F.col("c")) & F.col("turn").eqNullSafe(F.col("t"))
    live = e.join(cut, same, "left").where("after is null or seq > after").select(e.columns)
    reset = F.col("kind").isin(*RESETS)
    event = F.struct("seq", "kind", "role", "text")
    log = live.groupBy("conv_id", "turn").agg(
        F.max(F.when(reset, event)).alias("base"), F.array_sort(F.collect_list(F.when(~reset, event))).alias("deltas")
    )
    after = F.filter("deltas", lambda d: F.col("base").isNull() | (d > F.col("base")))
    return log.select(
        "conv_id", "turn",
        F.coalesce(F.col("base.role"), F.col("deltas")[0]["role"]).alias("role"),
        F.concat(F.coalesce("base.text", F.lit("")), F.array_join(F.transform(after, lambda d: d["text"]), "")).alias("text"),
    )


def render(messages: DataFrame) -> DataFrame:
    """(conv_id, formatted, spans) from (conv_id, turn, role, text).

    spans: one (start, length, loss) per turn, in code points of ``formatted``,
    covering the turn's escaped text; loss is set on assistant turns.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text").rowsBetween(Window.unboundedPreceding, 0)
    head = F.concat(F.lit("<|"), escape(F.col("role"), ROLE_ESCAPES), F.lit(HEAD_END))
    parts = messages.select(
        "conv_id", "turn", "role", "text", head.alias("head"), escape(F.col("text")).alias("body")
    ).withColumn("piece", F.concat("head", "body", F.lit(END)))
    placed = parts.withColumn("to", F.sum(F.char_length("piece").cast("long")).over(order)).withColumn(
        "place", F.count(F.lit(1)).over(order)
    )
    start = F.col("to") - F.char_length("body") - len(END)
    span = F.struct(start.alias("start"), F.char_length("body").alias("length"), (F.col("role") == "assistant").alias("loss"))
    gathered = placed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("place", "piece", span.alias("span")))).alias("x"))
    return gathered.select("conv_id", F.array_join(F.col("x.piece"), "").alias("formatted"), F.col("x.span").alias("spans"))


def read_back(rendered: DataFrame) -> DataFrame:
    """(conv_id, turns array of (role, text), loss_text): what a formatted string says."""
    parts = F.split("formatted", END.replace("|", "\\|"), -1)
    turns = F.transform(
        F.slice(parts, 1, F.size(parts) - 1),
        lambda p: F.struct(
            unescape(F.substr(F.substring_index(p, HEAD_END, 1), F.lit(3))).alias("role"),
            unescape(F.substr(p, F.char_length(F.substring_index(p, HEAD_END, 1)) + len(HEAD_END) + 1)).alias("text"),
        ),
    )
    read = rendered.select("conv_id", "formatted", "spans", turns.alias("turns"))
    masked = F.filter(F.arrays_zip("turns", "spans"), lambda z: z["spans"]["loss"])
    return read.select(
        "conv_id", "formatted", "turns", F.array_join(F.transform(masked, lambda z: z["turns"]["text"]), "").alias("loss_text")
    )


def format_conversations(events: DataFrame) -> DataFrame:
    """(conv_id, formatted, spans) of an event log; see :func:`fold_events`."""
    return render(fold_events(events))


def table_events(conversations: DataFrame) -> DataFrame:
    """Every row of (conv_id, turn, role, text) as one message event.

    Rows with the same turn, and fully repeated rows, are turns of their own,
    ordered by turn, role and text.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    place = F.row_number().over(order).cast("long")
    return conversations.select("conv_id", "turn", "role", "text").select(
        "conv_id", place.alias("seq"), place.alias("turn"), F.lit("message").alias("kind"), "role", "text"
    )


def digest(rendered: DataFrame) -> DataFrame:
    """The counts and digests of :func:`read_back`, one row per conversation."""
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read_back(rendered).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
