"""Conversations rebuilt from event logs and rendered for training, in DataFrame functions only.

A log row is an event ``(conv_id, seq, kind, turn, role, text)``:

    start        the message at ``turn`` begins anew, with ``role`` and ``text`` (often none yet)
    delta        ``text`` is appended to the message at ``turn``
    edit         ``text`` replaces the message at ``turn``
    regenerate   the messages at ``turn`` and after it are discarded

Fixed values of the template: a conversation begins with ``<s>`` and ends with ``</s>``; a turn is
``<|turn|>`` role ``<|text|>`` text ``<|end|>``. Inside roles and texts a backslash follows every
backslash and the first character of every control string, so no control string is left in them, and
a backslash before any character stands for that character when reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BEGIN, FINISH, TURN, TEXT, END = "<s>", "</s>", "<|turn|>", "<|text|>", "<|end|>"
CONTROL = (BEGIN, FINISH, TURN, TEXT, END, "[INST]", "[/INST]")
LEARNED_ROLE = "assistant"


def _quoted(text: str) -> str:
    return rf"\Q{text}\E"


def escaped(text: Column) -> Column:
    """``text`` without a control string in it; :func:`unescaped` gives the text back."""
    first = "|".join(f"{_quoted(c[0])}(?={_quoted(c[1:])})" for c in CONTROL)
    return F.regexp_replace(text, rf"\\|{first}", r"$0\\")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def messages(log: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)``: the messages that are left when a log has been played to its end.

    Events are taken by ``seq``; of equal ones in the order turn, kind, role, text, nulls first. A
    ``regenerate`` undoes all earlier events at its turn and after it; a ``start`` or ``edit`` undoes the
    earlier events of its message. A message's role is the last one given; its text is null only if no event had one. Other
    kinds and null kinds count as ``delta``; null ids and null turns are ids and turns, a null turn the first.

    The log is dealt out by conversation once and sorted by sequence; both windows and the grouping use
    that order. Windows spill, so an overlong conversation costs its task time, not memory.
    """
    order = [F.col("seq"), F.col("turn"), F.col("kind"), F.col("role"), F.col("text")]
    numbered = log.select("conv_id", "seq", "kind", F.coalesce("turn", F.lit(-(2**62))).alias("turn"), "role", "text")
    backwards = Window.partitionBy("conv_id").orderBy(*[c.desc_nulls_last() for c in order])
    later = backwards.rowsBetween(Window.unboundedPreceding, -1)
    cut = F.min(F.when(F.col("kind") == "regenerate", F.col("turn"))).over(later)
    place = F.row_number().over(backwards)
    alive = numbered.select("*", cut.alias("cut"), place.alias("from_end"))
    alive = alive.filter("(cut is null or cut > turn) and not (kind <=> 'regenerate')")
    # from_end counts from the last event, so the latest start or edit has the smallest
    of_message = Window.partitionBy("conv_id", "turn")
    reset = F.min(F.when(F.col("kind").isin("start", "edit"), F.col("from_end"))).over(of_message)
    pieces = alive.select("*", reset.alias("reset")).filter("reset is null or from_end <= reset or role is not null")
    used = F.when(F.col("reset").isNull() | (F.col("from_end") <= F.col("reset")), F.col("text"))
    return (
        pieces.groupBy("conv_id", "turn")
        .agg(
            F.sort_array(F.collect_list(F.struct((-F.col("from_end")).alias("at"), used.alias("text")))).alias("parts"),
            F.max(F.when(F.col("role").isNotNull(), F.struct((-F.col("from_end")).alias("at"), "role")))["role"].alias("role"),
            F.count(used).alias("texts"),
        )
        .select(
            "conv_id",
            F.when(F.col("turn") != -(2**62), F.col("turn")).alias("turn"),
            "role",
            F.when(F.col("texts") > 0, F.array_join(F.transform("parts", lambda p: p["text"]), "")).alias("text"),
        )
    )


def rendered(turns: DataFrame, learned: str = LEARNED_ROLE) -> DataFrame:
    """``(conv_id, formatted, mask)`` from messages: one text per conversation, turns in order.

    ``mask`` has an element per turn, ``(chars, loss_start, loss_chars)``: the turn's length in code
    points with its marks, and which part of it is trained on, which is the text of ``learned`` turns
    and nothing of others. Null roles and texts are rendered as empty.
    """
    text = escaped(F.coalesce("text", F.lit("")))
    role = escaped(F.coalesce("role", F.lit("")))
    head = F.concat(F.lit(TURN), role, F.lit(TEXT))
    is_learned = F.col("role").eqNullSafe(learned)
    one = turns.select(
        "conv_id",
        F.struct(
            "turn",
            F.concat(head, text, F.lit(END)).alias("piece"),
            F.struct(
                F.char_length(F.concat(head, text, F.lit(END))).alias("chars"),
                F.char_length(head).alias("loss_start"),
                F.when(is_learned, F.char_length(text)).otherwise(0).alias("loss_chars"),
            ).alias("mask"),
        ).alias("t"),
    )
    whole = one.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    return whole.select(
        "conv_id",
        F.concat(F.lit(BEGIN), F.array_join(F.transform("t", lambda t: t["piece"]), ""), F.lit(FINISH)).alias("formatted"),
        F.transform("t", lambda t: t["mask"]).alias("mask"),
    )


def read_turns(formatted: Column) -> Column:
    """The turns of a rendered conversation as an array of ``(role, text)``."""
    pieces = F.filter(F.split(formatted, _quoted(TURN)), lambda _, i: i > 0)

    def parsed(piece: Column) -> Column:
        parts = F.split(piece, f"{_quoted(TEXT)}|{_quoted(END)}")
        return F.struct(unescaped(parts[0]).alias("role"), unescaped(parts[1]).alias("text"))

    return F.transform(pieces, parsed)


def read_learned(formatted: Column, mask: Column) -> Column:
    """What lies under the loss mask, unescaped and joined."""
    pieces = F.filter(F.split(formatted, _quoted(TURN)), lambda _, i: i > 0)
    parts = F.zip_with(
        pieces,
        mask,
        # splitting took the mark before each piece
        lambda p, m: unescaped(F.substring(p, m["loss_start"] - len(TURN) + 1, m["loss_chars"])),
    )
    return F.array_join(parts, "")


def log_of(conversations: DataFrame) -> DataFrame:
    """An event log that ends in finished rows ``(conv_id, turn, role, text)``, as a service would have written it.

    Every message starts and arrives in three deltas. Of every third one a draft comes first, which an edit replaces by the
    first part; before every fourth one it and the message after it were said otherwise, and were regenerated. Rows are
    numbered by turn, then role and text, so rows with equal or null turns stay apart.
    """
    by_turn = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    numbered = conversations.select(
        "conv_id", F.row_number().over(by_turn).cast("bigint").alias("turn"), "role", F.coalesce("text", F.lit("")).alias("text")
    )
    turn, text = F.col("turn"), F.col("text")
    third = F.floor(F.char_length(text) / 3).cast("int")
    parts = [F.substring(text, F.lit(1), third), F.substring(text, third + 1, third), F.substring(text, 2 * third + 1, F.char_length(text))]

    def event(kind: str, at: Column = turn, role: Column | None = None, said: Column | None = None) -> Column:
        nothing = F.lit(None).cast("string")
        return F.struct(
            F.lit(kind).alias("kind"), at.alias("turn"), (nothing if role is None else role).alias("role"),
            (nothing if said is None else said).alias("text"),
        )

    other = F.lit("said otherwise at first")
    undone = [
        event("start", role=F.lit("user")), event("delta", said=other), event("start", turn + 1, F.lit(LEARNED_ROLE), other),
        event("regenerate"),
    ]
    none = F.array().cast("array<struct<kind:string,turn:bigint,role:string,text:string>>")
    events = F.concat(
        F.when(turn % 4 == 2, F.array(*undone)).otherwise(none),
        F.array(event("start", role=F.col("role"))),
        F.when(turn % 3 == 0, F.array(event("delta", said=other), event("edit", said=parts[0]))).otherwise(F.array(event("delta", said=parts[0]))),
        F.array(event("delta", said=parts[1]), event("delta", said=parts[2])),
    )
    return numbered.select("conv_id", turn.alias("place"), F.posexplode(events).alias("at", "e")).select(
        "conv_id", (16 * F.col("place") + F.col("at")).alias("seq"), "e.kind", "e.turn", "e.role", "e.text"
    )


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from rendered conversations, as counts and SHA-256 digests."""
    turns = read_turns(F.col("formatted"))
    learned = read_learned(F.col("formatted"), F.col("mask"))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return formatted.select("conv_id", "formatted", turns.alias("turns"), learned.alias("learned")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.col("learned"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
