"""Chat formatting by event-sourced reconstruction.

A conversation is a log of events with one ``seq`` for the whole conversation; events of its
messages may interleave. ``start`` opens a message with its role, ``delta`` appends text,
``edit`` replaces ``size`` code points from ``at`` on (without ``at``: the whole text),
``regenerate`` drops the text so that later deltas write it anew. A message is folded from
its last reset (a start, a regeneration or an edit of the whole text) on, in order of
``seq``; conversations are laid out by the sequence of their messages' starts.

Any log of these columns can be folded and rendered: message names are only compared for
equality, a message without a start begins with its first event, other kinds of events
change nothing, an edit beyond the end appends. ``conversation_events`` makes such a log
from a table of final turns: user messages are first sent with a wrong opening and then
edited there, assistant messages are regenerated, and the last event of each message comes
after those of the next one.

The template writes a turn as ``<turn>ROLE newline TEXT</turn> newline``. Inside role and
text ``\\`` becomes ``\\b`` and ``<`` becomes ``\\l`` (in roles a newline ``\\n``), so no
mark can occur inside a text and unescaping is exact. The loss mask gives, per turn, how
many code points of the rendered turn to skip and then to take (0 unless assistant).

Defined results: null text and null role are empty; null conversation ids form one
conversation; turns with equal numbers are ordered by role and text, repeated rows stay
separate turns, null turns come first; an empty table gives no rows. One conversation is
one output row, so its size is bounded by what a row can hold (2 GB).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>\n"
CHUNK = 512  # code points of one streamed delta
EVENTS = 1 << 40  # numbers kept free for the events of one message
ASSISTANT = "assistant"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return unescape(F.replace(role, F.lit("\\n"), F.lit("\n")))


def conversation_events(conversations: DataFrame) -> DataFrame:
    """The event log behind a table of final turns: ``(conv_id, message, seq, kind, role, at,
    size, text)``. Turns are numbered by turn, role and text."""
    c = conversations
    rows = c.select(
        c["conv_id"].alias("conv_id"),
        c["turn"].alias("turn"),
        F.coalesce(c["role"], F.lit("")).alias("role"),
        F.coalesce(c["text"], F.lit("")).alias("t"),
    )
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "t")
    rows = rows.withColumn("message", F.row_number().over(order).cast("long"))
    pieces = F.transform(
        F.sequence(F.lit(0), F.greatest(F.lit(0), F.floor((F.char_length("t") - 1) / CHUNK).cast("int"))),
        lambda i: F.substr("t", i * CHUNK + 1, F.lit(CHUNK)),
    )
    none = F.lit(None).cast("int")

    def event(kind: str, text: Column, at: Column = none, size: Column = none) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"), at.alias("at"), size.alias("size"))

    empty, first = F.lit(""), F.substr("t", F.lit(1), F.lit(1))
    deltas = lambda p: F.transform(p, lambda x: event("delta", x))
    wrong = F.concat(F.array(F.concat(F.lit("?"), F.substr(F.get("p", F.lit(0)), F.lit(2)))), F.slice("p", 2, F.size("p")))
    log = (
        F.when(
            F.col("role") == ASSISTANT,
            F.concat(
                F.array(event("start", empty), event("delta", F.get("p", F.lit(0))), event("regenerate", empty)),
                deltas(F.col("p")),
            ),
        )
        .when(
            F.col("role") == "user",
            F.concat(F.array(event("start", empty)), deltas(wrong), F.array(event("edit", first, F.lit(0), F.lit(1)))),
        )
        .otherwise(F.concat(F.array(event("start", empty)), deltas(F.col("p"))))
    )
    rows = rows.withColumn("p", pieces).withColumn("log", log)
    rows = rows.select("conv_id", "message", "role", F.size("log").alias("n"), F.posexplode("log").alias("k", "e"))
    # The last event comes in the middle of the next message's numbers, behind its events.
    last = (F.col("k") == F.col("n") - 1) & (F.col("k") > 0)
    seq = (F.col("message") + last.cast("long")) * EVENTS + F.when(last, F.lit(EVENTS // 2)).otherwise(F.col("k"))
    return rows.select("conv_id", "message", seq.alias("seq"), "e.kind", "role", "e.at", "e.size", "e.text")


def fold_events(events: DataFrame) -> DataFrame:
    """``(conv_id, message, start, role, text)``: the final state of every message, and the
    ``seq`` it began with. ``at`` and ``size`` may be missing."""
    none = F.lit(None).cast("int")
    at, size = (F.col(c).cast("int") if c in events.columns else none for c in ("at", "size"))
    log = events.select(
        "conv_id", "message", "seq", "kind", "role", at.alias("at"), F.greatest(F.coalesce(size, F.lit(0)), F.lit(0)).alias("size"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    whole = F.col("kind").isin("start", "regenerate") | ((F.col("kind") == "edit") & F.col("at").isNull())
    folded = log.groupBy("conv_id", "message").agg(
        F.max("role").alias("role"),
        F.coalesce(F.min(F.when(F.col("kind") == "start", F.col("seq"))), F.min("seq")).alias("start"),
        F.coalesce(F.max(F.when(whole, F.col("seq"))), F.min("seq")).alias("reset"),
        F.collect_list(F.struct("seq", "kind", "at", "size", "text")).alias("log"),
    )
    left = F.sort_array(F.filter("log", lambda e: e["seq"] >= F.col("reset")))

    def step(text: Column, e: Column) -> Column:
        place = F.greatest(e["at"], F.lit(0))
        edited = F.concat(F.substr(text, F.lit(1), place), e["text"], F.substr(text, place + e["size"] + 1))
        return (
            F.when(e["kind"] == "delta", F.concat(text, e["text"]))
            .when((e["kind"] == "edit") & e["at"].isNotNull(), edited)
            .when(e["kind"].isin("start", "edit", "regenerate"), e["text"])
            .otherwise(text)
        )

    text = F.aggregate(left, F.lit(""), step)
    return folded.select("conv_id", "message", "start", F.coalesce("role", F.lit("")).alias("role"), text.alias("text"))


def render(messages: DataFrame) -> DataFrame:
    """``(conv_id, n_turns, formatted, loss_mask)``, one row per conversation: its messages by
    their starts."""
    head = F.concat(F.lit(OPEN), escape_role(F.col("role")), F.lit("\n"))
    turns = messages.select(
        "conv_id",
        "start",
        head.alias("head"),
        escape(F.col("text")).alias("body"),
        (F.col("role") == ASSISTANT).alias("learn"),
    ).select(
        "conv_id",
        "start",
        F.concat("head", "body", F.lit(CLOSE)).alias("rendered"),
        F.struct(
            F.char_length("head").alias("skip"),
            F.when(F.col("learn"), F.char_length("body")).otherwise(0).alias("take"),
        ).alias("mask"),
    )
    order = F.struct("start", "rendered", "mask")
    laid = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(order)).alias("x"))
    return laid.select(
        "conv_id",
        F.size("x").cast("long").alias("n_turns"),
        F.array_join(F.transform("x", lambda e: e["rendered"]), "").alias("formatted"),
        F.transform("x", lambda e: e["mask"]).alias("loss_mask"),
    )


def read_back(formatted: DataFrame) -> DataFrame:
    """``formatted`` plus ``turns`` (role and text of each) and ``loss_text``, both taken
    from the formatted string and the mask alone."""
    parts = F.split("formatted", CLOSE)  # one more part than turns, the last one empty
    rendered = formatted.withColumn("parts", F.slice(parts, 1, F.size(parts) - 1))
    inner = F.transform("parts", lambda x: F.substr(x, F.lit(len(OPEN) + 1)))
    role = lambda x: F.substring_index(x, "\n", 1)
    turns = F.transform(
        inner,
        lambda x: F.struct(
            unescape_role(role(x)).alias("role"),
            unescape(F.substr(x, F.char_length(role(x)) + 2)).alias("text"),
        ),
    )
    learnt = F.zip_with("parts", "loss_mask", lambda x, m: unescape(F.substr(x, m["skip"] + 1, m["take"])))
    return rendered.withColumns({"turns": turns, "loss_text": F.array_join(learnt, "")}).drop("parts")


def format_conversations(conversations: DataFrame) -> DataFrame:
    """All conversations of a table of turns, through the event log, rendered."""
    return render(fold_events(conversation_events(conversations)))
