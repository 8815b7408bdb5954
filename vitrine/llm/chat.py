"""Chat formatting by event sourcing: fold a log of chat events into final messages, then render them.

An event is ``(conv_id, seq, message, kind, role, text)``. Within a conversation events take effect by ``seq``:

* ``message``     starts message number ``message`` with ``role`` and ``text``;
* ``delta``       appends streamed ``text`` to it;
* ``edit``        replaces its text so far (later deltas append to the new text);
* ``regenerate``  starts it anew and discards all later messages that were begun before this event.

Null text is empty, a null kind counts as ``message``; a message whose first event is a delta starts empty. An event without a
role leaves the message the last role that a start, edit or regeneration gave it; a message that never had one has the empty role. Null ``conv_id`` is a conversation of its own. Equal ``seq`` are ordered by kind, role and text,
so a repeated event gives the same result on every run. An empty log gives no conversations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

START, END = "<|im_start|>", "<|im_end|>"
TURN_END = END + "\n"

EVENT_COLUMNS = ["conv_id", "seq", "message", "kind", "role", "text"]


def escape(text: Column) -> Column:
    r"""No ``<|`` remains: ``<``, n backslashes, ``|`` gets one backslash more. :func:`unescape` takes it away."""
    return F.regexp_replace(text, r"<(\\*)\|", r"<\\$1|")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, r"<\\(\\*)\|", r"<$1|")


def escape_role(role: Column) -> Column:
    """A role ends at the first line feed, so line feeds inside it are escaped as well."""
    return escape(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescape_role(role: Column) -> Column:
    plain = F.regexp_replace(unescape(role), r"(?<!\\)((?:\\\\)*)\\n", "$1\n")
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def fold_events(events: DataFrame) -> DataFrame:
    """Final messages ``(conv_id, message, role, text)``; other columns of ``events`` are not carried.

    One shuffle by conversation. The two windows hold what the rendered conversation holds anyway.
    """
    log = events.select(
        "conv_id",
        "seq",
        "message",
        F.coalesce("kind", F.lit("message")).alias("kind"),
        "role",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    # A message is gone when one before it was regenerated after this event.
    earlier = (
        Window.partitionBy("conv_id").orderBy("message").rangeBetween(Window.unboundedPreceding, -1)
    )
    rewound = F.max(F.when(F.col("kind") == "regenerate", F.col("seq"))).over(earlier)
    alive = log.withColumn("rewound", rewound).where(
        F.col("rewound").isNull() | (F.col("seq") > F.col("rewound"))
    )
    own = Window.partitionBy("conv_id", "message")
    reset = F.max(F.when(F.col("kind") != "delta", F.col("seq"))).over(own)
    given = F.when(F.col("role").isNotNull() & (F.col("kind") != "delta"), F.struct("seq", "role"))
    known = alive.withColumns({"reset": reset, "known": F.max(given).over(own)["role"]})
    current = known.where(
        F.col("reset").isNull() | (F.col("seq") >= F.col("reset"))
    )
    pieces = F.sort_array(
        F.collect_list(F.struct("seq", (F.col("kind") == "delta").alias("late"), "role", "text"))
    )
    # Of equal reset events the last one in order counts, with all deltas after it.
    folded = current.groupBy("conv_id", "message").agg(pieces.alias("pieces"), F.max("known").alias("known"))
    last = F.size(F.filter("pieces", lambda p: ~p["late"]))
    kept = F.when(last > 1, F.expr("slice(pieces, size(filter(pieces, p -> not p.late)), size(pieces))"))
    kept = F.coalesce(kept, F.col("pieces"))
    return folded.select(
        "conv_id",
        "message",
        F.coalesce(kept[0]["role"], "known", F.lit("")).alias("role"),
        F.array_join(F.transform(kept, lambda p: p["text"]), "").alias("text"),
    )


def turn_events(rows: DataFrame) -> DataFrame:
    """Events of a plain table ``(conv_id, turn, role, text)``: every row is a message of its own, by turn.

    Rows of one turn, also equal ones, follow each other in order of role and text (nulls first).
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = rows.withColumn("seq", F.row_number().over(order).cast("bigint"))
    return numbered.select(
        "conv_id", "seq", F.col("seq").alias("message"), F.lit("message").alias("kind"), "role", "text"
    )


def render(messages: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """``(conv_id, formatted, loss_spans)``: the marked-up conversation and the code-point spans under the loss mask.

    A conversation becomes one string, so it must fit in one row (2 GB), as must its turns.
    """
    head = F.concat(F.lit(START), escape_role(F.col("role")), F.lit("\n"))
    body = escape(F.col("text"))
    parts = messages.select(
        "conv_id",
        "message",
        F.col("role").isin(*loss_roles).alias("loss"),
        head.alias("head"),
        body.alias("body"),
    )
    length = F.length("head") + F.length("body") + len(TURN_END)
    so_far = Window.partitionBy("conv_id").orderBy("message").rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.withColumn(
        "start", F.coalesce(F.sum(length.cast("bigint")).over(so_far), F.lit(0)) + F.length("head")
    )
    turn = F.struct(
        "message",
        F.concat("head", "body", F.lit(TURN_END)).alias("rendered"),
        "loss",
        "start",
        (F.col("start") + F.length("body")).alias("end"),
    )
    joined = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    masked = F.filter("turns", lambda t: t["loss"])
    return joined.select(
        "conv_id",
        F.array_join(F.transform("turns", lambda t: t["rendered"]), "").alias("formatted"),
        F.transform(masked, lambda t: F.struct(t["start"].alias("start"), t["end"].alias("end"))).alias(
            "loss_spans"
        ),
    )


def format_conversations(events: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    return render(fold_events(events), loss_roles)


def parse(formatted: Column) -> Column:
    """Array of ``(role, text)`` read back from a rendered conversation."""
    turns = F.split(formatted, r"<\|im_end\|>\n")
    whole = F.slice(turns, F.lit(1), F.size(turns) - 1)

    def turn(part: Column) -> Column:
        inner = F.substring(part, len(START) + 1, 2_147_483_647)
        role = F.substring_index(inner, "\n", 1)
        text = F.substr(inner, F.length(role) + 2)
        return F.struct(unescape_role(role).alias("role"), unescape(text).alias("text"))

    return F.transform(whole, turn)


def masked_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, with nothing between."""
    return F.array_join(
        F.transform(
            spans, lambda s: unescape(F.substr(formatted, (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")))
        ),
        "",
    )
