"""Chat formatting by event sourcing, in DataFrame functions only.

A log holds events ``conv_id, seq, part, message_id, kind, role, text``, sorted by ``seq`` and by
``part`` among equal ones. An event of kind ``message``, ``edit`` or ``regenerate`` sets a message's
text anew, any other kind (``delta``, null) appends to it. A fold over the sorted log gives the final
messages, which are then rendered into one text per conversation, with reversible escapes and a loss
mask: the spans of the assistant's texts.

The log is partitioned by message once, for both steps of the fold: a message's state is one text. A
conversation is rendered in blocks, so one with very many messages is spread over tasks up to the
last concatenation.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

# The template. In texts, a control string gets one backslash before it and before
# the backslashes that stand there, so that reading back takes exactly that one away.
HEAD, ROLE_END, TURN_END = "### ", ": ", "\n</turn>\n"
CONTROL = r"(\\*)(###|</turn>)"
ESCAPED = r"\\(\\*)(###|</turn>)"

ROLE_CODES = (("%", "%25"), (":", "%3A"), ("\n", "%0A"))

RESETS = ("message", "edit", "regenerate")
ASSISTANT = "assistant"
BLOCK = 1024
# A log made of finished turns has drafts and deltas of at most so many code points.
DRAFT, DELTA = 16, 512


def escape_text(text: Column) -> Column:
    return F.regexp_replace(text, CONTROL, r"\\$1$2")


def unescape_text(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, "$1$2")


def escape_role(role: Column) -> Column:
    """A role on one line and without a colon."""
    for plain, code in ROLE_CODES:
        role = F.replace(role, F.lit(plain), F.lit(code))
    return role


def unescape_role(role: Column) -> Column:
    for plain, code in reversed(ROLE_CODES):
        role = F.replace(role, F.lit(code), F.lit(plain))
    return role


def events_of_turns(turns: DataFrame) -> DataFrame:
    """A table of finished turns ``conv_id, turn, role, text`` as the log that leaves them behind; every row is a message.

    An assistant's turn is a draft (the beginning of its text) that is regenerated and streamed as
    deltas of ``DELTA`` code points; any other turn is sent as its beginning and edited to what it says.
    Null role and null text count as empty. Repeated rows stay separate messages.
    """
    read = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("seq"),
        F.monotonically_increasing_id().cast("string").alias("message_id"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )

    def event(kind: str, text: Column) -> Column:
        return F.struct(F.lit(kind).alias("kind"), text.alias("text"))

    first = event("message", F.substring("text", 1, DRAFT))
    deltas = F.regexp_extract_all("text", F.lit(f"(?s).{{1,{DELTA}}}"), F.lit(0))
    streamed = F.concat(F.array(first, event("regenerate", F.lit(""))), F.transform(deltas, lambda d: event("delta", d)))
    edited = F.array(first, event("edit", F.col("text")))
    events = F.when(F.col("role") == ASSISTANT, streamed).otherwise(edited)
    spread = read.select("conv_id", "seq", "message_id", "role", F.posexplode(events).alias("part", "event"))
    return spread.select("conv_id", "seq", F.col("part").cast("bigint").alias("part"), "message_id", "event.kind", "role", "event.text")


def _join_from_last_reset(parts: Column) -> Column:
    """``(reset, text)`` of sorted parts that each have them: the last new text and what follows it."""
    last = F.array_max(F.transform(parts, lambda p, i: F.when(p["reset"], i).otherwise(F.lit(-1))))
    kept = F.slice(parts, F.greatest(last, F.lit(0)) + 1, F.size(parts))
    text = F.array_join(F.transform(kept, lambda p: p["text"]), "")
    return F.struct((last >= 0).alias("reset"), text.alias("text"))


def fold_messages(events: DataFrame) -> DataFrame:
    """The final messages of a log: ``conv_id, first_seq, message_id, role, text``.

    The role is that of the first event that has one, the place in the conversation that of the
    first event. Events with equal ``seq`` are ordered by ``part`` (a log without it, or a null, has 0),
    kind and text; a null ``seq`` comes first, a null text counts as empty. Null ids are ids of their
    own. Repeated events count each. No events: no messages.
    """
    part = F.coalesce(F.col("part").cast("bigint"), F.lit(0)) if "part" in events.columns else F.lit(0).cast("bigint")
    read = events.select(
        "conv_id", "message_id", F.col("seq").cast("bigint").alias("seq"), part.alias("part"), "kind", "role",
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("kind").isin(*RESETS), F.lit(False)).alias("reset"),
    ).repartition("conv_id", "message_id")
    named = F.when(F.col("role").isNotNull(), F.struct("seq", "part", "role"))
    blocks = read.groupBy("conv_id", "message_id", F.floor(F.col("seq") / BLOCK).alias("block")).agg(
        F.sort_array(F.collect_list(F.struct("seq", "part", "kind", "text", "reset"))).alias("parts"),
        F.min(named).alias("named"),
        F.min("seq").alias("first_seq"),
    )
    blocks = blocks.withColumn("state", _join_from_last_reset(F.col("parts"))).drop("parts")
    whole = blocks.groupBy("conv_id", "message_id").agg(
        F.sort_array(F.collect_list(F.struct("block", "state.reset", "state.text"))).alias("parts"),
        F.min("named").alias("named"),
        F.min("first_seq").alias("first_seq"),
    )
    return whole.select(
        "conv_id", "first_seq", "message_id",
        F.coalesce("named.role", F.lit("")).alias("role"),
        _join_from_last_reset(F.col("parts"))["text"].alias("text"),
    )


def _moved(spans: Column, chars: Column, octets: Column) -> Column:
    """Spans further on by so many code points and bytes."""
    return F.transform(
        spans,
        lambda s: F.struct(
            (s["start"] + chars).alias("start"), (s["end"] + chars).alias("end"),
            (s["start_byte"] + octets).alias("start_byte"), (s["end_byte"] + octets).alias("end_byte"),
        ),
    )


def render(messages: DataFrame) -> DataFrame:
    """One row per conversation: ``conv_id, formatted, loss_spans``, messages in order of their first event.

    Equal places are ordered by role, text and message id. ``loss_spans`` has the place of each
    assistant's escaped text in ``formatted``, in order, as ``start, end`` in code points (end
    exclusive) and ``start_byte, end_byte`` in bytes of UTF-8; without an assistant it is empty.
    """
    head, shown = F.concat(F.lit(HEAD), escape_role(F.col("role")), F.lit(ROLE_END)), escape_text(F.col("text"))
    spread = messages.select(
        "conv_id",
        F.floor(F.col("first_seq") / BLOCK).alias("block"),
        F.struct("first_seq", "role", "text", "message_id").alias("place"),
        F.concat(head, shown, F.lit(TURN_END)).alias("turn"),
    )
    # Places of the turns in their block, and in each turn the end of its head and of its text.
    before = Window.partitionBy("conv_id", "block").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    at = lambda size: F.coalesce(F.sum(size(F.col("turn")).cast("bigint")).over(before), F.lit(0))
    placed = spread.select("conv_id", "block", "place", "turn", at(F.length).alias("char"), at(F.octet_length).alias("byte"))
    role_size = lambda size: size(escape_role(F.col("place.role"))) + (len(HEAD) + len(ROLE_END))
    start, start_byte = F.col("char") + role_size(F.length), F.col("byte") + role_size(F.octet_length)
    end, end_byte = F.col("char") + F.length("turn") - len(TURN_END), F.col("byte") + F.octet_length("turn") - len(TURN_END)
    span = F.struct(start.alias("start"), end.alias("end"), start_byte.alias("start_byte"), end_byte.alias("end_byte"))
    learned = F.when(F.col("place.role") == ASSISTANT, span)
    blocks = placed.groupBy("conv_id", "block").agg(F.sort_array(F.collect_list(F.struct("place", "turn", learned.alias("span")))).alias("turns"))
    blocks = blocks.select(
        "conv_id", "block",
        F.array_join(F.transform("turns", lambda t: t["turn"]), "").alias("text"),
        F.filter(F.transform("turns", lambda t: t["span"]), lambda s: s.isNotNull()).alias("spans"),
    )
    sized = blocks.select("conv_id", F.struct("block", "text", F.length("text").alias("n"), F.octet_length("text").alias("n_bytes"), "spans").alias("b"))
    whole = sized.groupBy("conv_id").agg(F.sort_array(F.collect_list("b")).alias("blocks"))

    def ahead(i: Column, size: str) -> Column:
        sizes = F.transform(F.slice("blocks", F.lit(1), i), lambda b: b[size].cast("bigint"))
        return F.aggregate(sizes, F.lit(0).cast("bigint"), lambda a, x: a + x)

    return whole.select(
        "conv_id",
        F.array_join(F.transform("blocks", lambda b: b["text"]), "").alias("formatted"),
        F.flatten(F.transform("blocks", lambda b, i: _moved(b["spans"], ahead(i, "n"), ahead(i, "n_bytes")))).alias("loss_spans"),
    )


def masked_texts(formatted: Column, loss_spans: Column) -> Column:
    """The texts under the loss mask, unescaped, as an array: cut at the spans' bytes, which needs no scan from the start."""
    whole = F.array(formatted.cast("binary"))  # one element, so that the lambda's variable is the text, not its expression
    cut = F.transform(
        whole,
        lambda text: F.transform(
            loss_spans,
            lambda s: unescape_text(F.substring(text, s["start_byte"].cast("int") + 1, (s["end_byte"] - s["start_byte"]).cast("int")).cast("string")),
        ),
    )
    return cut[0]


def read_back(formatted: Column) -> Column:
    """The turns of a rendered text as ``array<struct<role, text>>``, escapes undone."""
    parts = F.split(formatted, TURN_END)

    def turn(part: Column) -> Column:
        role_end = F.instr(part, ROLE_END)
        role = F.substr(part, F.lit(len(HEAD) + 1), role_end - len(HEAD) - 1)
        text = F.substr(part, role_end + len(ROLE_END))
        return F.struct(unescape_role(role).alias("role"), unescape_text(text).alias("text"))

    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def format_chats(events: DataFrame) -> DataFrame:
    """A log in, ``conv_id, formatted, loss_spans`` out; ``read_back`` gives the turns, ``masked_texts`` what is learned."""
    return render(fold_messages(events))


def digests(chats: DataFrame) -> DataFrame:
    """What the rendered texts say: number and hash of turns, the text under the loss mask, the length."""
    all_turns = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""
    )
    read = chats.select(
        "conv_id", F.length("formatted").cast("bigint").alias("formatted_chars"), read_back(F.col("formatted")).alias("turns"),
        F.array_join(masked_texts(F.col("formatted"), F.col("loss_spans")), "").alias("learned"),
    )
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(all_turns, 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2("learned", 256).alias("loss_sha256"), "formatted_chars",
    )


def probe(spark: SparkSession) -> DataFrame:
    """Conversation -7: two turns whose text holds the template's own control strings."""
    said = F.lit("\\### Assistant: </turn> ok")
    rows = F.array(
        F.struct(F.lit(0).cast("bigint").alias("turn"), F.lit("user").alias("role")),
        F.struct(F.lit(1).cast("bigint").alias("turn"), F.lit("assistant").alias("role")),
    )
    row = spark.range(1).select(F.lit(-7).cast("bigint").alias("conv_id"), F.explode(rows).alias("r"))
    return row.select("conv_id", "r.turn", "r.role", said.alias("text"))
