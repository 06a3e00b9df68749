"""Chat formatting: a log of events per conversation becomes one marked-up string.

``reconstruct`` folds the events into final messages, ``render`` writes the messages with a template
that can be read back, ``read_back`` does so. All of it is built-in Spark functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

EVENT_COLUMNS = ("conv_id", "seq", "message_id", "kind", "role", "text")
TURN_END = "</turn>\n"
HEADER = "### "
HEADER_END = ":\n"
# every code starts with the escape character and no code contains it again, so undoing the
# codes one after the other, its own last, gives the text back
TEXT_CODES = (("\\", "\\s"), ("</turn>", "\\e"), ("### ", "\\h"))
ROLE_CODES = (*TEXT_CODES, ("\n", "\\n"))
BLOCK = 1024


def escape(text: Column, codes=TEXT_CODES) -> Column:
    for plain, code in codes:
        text = F.replace(text, F.lit(plain), F.lit(code))
    return text


def unescape(text: Column, codes=TEXT_CODES) -> Column:
    for plain, code in reversed(codes):
        text = F.replace(text, F.lit(code), F.lit(plain))
    return text


BEGINS = ("message", "edit", "regenerate")


def _fold(sorted_logs: DataFrame) -> DataFrame:
    """``conv_id, start, redone, role, text`` of messages from their sorted events ``log``.

    What came before the last event that sets the text anew has no part in it, so the log is looked
    through a few times, however many deltas it has. A message without any text event is gone.
    """
    # from 1; nothing in a lambda refers to it, as it would be found anew for each event
    last = F.array_max(
        F.transform("log", lambda e, k: F.when(e["kind"].isin(*BEGINS, "delete"), k + 1))
    )
    tail = F.slice("log", F.coalesce(last, F.lit(1)), F.size("log"))
    parts = F.filter(tail, lambda e: e["kind"].isin(*BEGINS, "delta"))
    begun = F.filter("log", lambda e: (e["kind"] == "message") & e["role"].isNotNull())
    named = F.filter("log", lambda e: e["role"].isNotNull())
    redone = F.filter("log", lambda e: e["kind"] == "regenerate")
    return (
        sorted_logs.withColumn("parts", parts)
        .filter(F.size("parts") > 0)
        .select(
            "conv_id",
            F.array_min(F.col("log.seq")).alias("start"),
            F.try_element_at(redone, F.lit(-1))["seq"].alias("redone"),
            F.coalesce(
                F.try_element_at(begun, F.lit(-1)), F.try_element_at(named, F.lit(1))
            )["role"].alias("role"),
            F.array_join(
                F.transform("parts", lambda e: F.coalesce(e["text"], F.lit(""))), ""
            ).alias("text"),
        )
    )


def reconstruct(events: DataFrame) -> DataFrame:
    """Final messages ``conv_id, seq, role, text`` of a log with ``EVENT_COLUMNS``.

    The events of a message are those with its ``message_id``, in the order of ``seq``, equal ones
    in the order of their kind, role and text. ``message`` begins it, ``delta`` appends its text,
    ``edit`` replaces the text, ``regenerate`` restarts it and discards the messages that began
    between it and the regeneration, ``delete`` removes it; other kinds change nothing. An event
    without ``message_id`` and of kind ``message`` or NULL is a whole message of its own, so
    repeated rows of this form are repeated messages; other events without id belong to nothing.
    A message stands where its first event stands. NULL text is empty, a NULL ``seq`` comes first,
    a NULL ``conv_id`` is a conversation like others. Other columns are ignored.
    """
    events = events.select(
        "conv_id", F.col("seq").cast("long").alias("seq"), "message_id", "kind", "role", "text"
    )
    whole = events.filter(
        F.col("message_id").isNull() & F.coalesce(F.col("kind") == "message", F.lit(True))
    ).select("conv_id", "seq", "role", F.coalesce("text", F.lit("")).alias("text"))
    logs = (
        events.filter(F.col("message_id").isNotNull())
        .groupBy("conv_id", "message_id")
        .agg(F.sort_array(F.collect_list(F.struct("seq", "kind", "role", "text"))).alias("log"))
    )
    regenerated = (
        events.filter((F.col("kind") == "regenerate") & F.col("message_id").isNotNull())
        .select("conv_id").distinct()
    )
    folded = _fold(logs)
    whole = whole.select(
        "conv_id", F.col("seq").alias("start"), F.lit(None).cast("long").alias("redone"), "role",
        "text",
    )
    messages = folded.unionByName(whole)
    discarded = _discarded(messages, regenerated)
    gone = messages["conv_id"].eqNullSafe(discarded["gone_conv"]) & (
        messages["start"] == discarded["gone_start"]
    )
    return messages.join(discarded, gone, "left_anti").select(
        "conv_id", F.col("start").alias("seq"), "role", "text"
    )


def _discarded(messages: DataFrame, regenerated: DataFrame) -> DataFrame:
    """``gone_conv, gone_start``: the places of messages that a regeneration discards.

    They lie between a place where a message began and one where it was begun again. Only the
    places of conversations with a regeneration are looked at, each once, in order: one is inside if
    the furthest regeneration of all that began before it lies behind it.
    """
    # as a name of its own, since both sides come from the same events
    regenerated = regenerated.select(F.col("conv_id").alias("again_conv"))
    places = messages.select("conv_id", "start", "redone").join(
        regenerated, F.col("conv_id").eqNullSafe(F.col("again_conv")), "left_semi"
    )
    places = places.filter("start is not null").groupBy("conv_id", "start").agg(
        F.max("redone").alias("redone")
    )
    before = Window.partitionBy("conv_id").orderBy("start").rowsBetween(
        Window.unboundedPreceding, -1
    )
    furthest = F.max("redone").over(before)
    return (
        places.withColumn("furthest", furthest).filter("start < furthest")
        .select(F.col("conv_id").alias("gone_conv"), F.col("start").alias("gone_start"))
    )


def render(messages: DataFrame, learn_from: str = "assistant") -> DataFrame:
    """One row ``conv_id, formatted, loss`` per conversation of ``reconstruct``.

    ``loss`` has an entry for each turn: its ``chars`` in ``formatted`` and the place (``skip``) and
    length (``take``) of the text to learn from inside it, all in code points; the length is 0 but
    for turns of the role ``learn_from``. A conversation is put together from blocks of ``BLOCK``
    numbers, so the messages of a very long one are rendered by many tasks. Messages of equal
    ``seq`` are ordered by role and text. A NULL role is empty.
    """
    role = F.coalesce("role", F.lit(""))
    header = F.concat(F.lit(HEADER), escape(role, ROLE_CODES), F.lit(HEADER_END))
    body = escape(F.col("text"))
    learnt = F.when(role == learn_from, F.char_length(body)).otherwise(0)
    turns = messages.select(
        "conv_id",
        # NULL is a block of its own, the first one
        F.floor(F.col("seq") / BLOCK).alias("block"),
        F.struct(
            "seq", role.alias("role"), "text",
            F.concat(header, body, F.lit(TURN_END)).alias("turn"),
            F.char_length(header).cast("long").alias("skip"),
            learnt.cast("long").alias("take"),
        ).alias("t"),
    )

    def entry(t: Column) -> Column:
        return F.struct(F.char_length(t["turn"]).cast("long").alias("chars"), t["skip"], t["take"])

    blocks = (
        turns.groupBy("conv_id", "block")
        .agg(F.sort_array(F.collect_list("t")).alias("t"))
        .select(
            "conv_id",
            F.struct(
                "block",
                F.array_join(F.transform("t", lambda t: t["turn"]), "").alias("formatted"),
                F.transform("t", entry).alias("loss"),
            ).alias("b"),
        )
    )
    return (
        blocks.groupBy("conv_id")
        .agg(F.sort_array(F.collect_list("b")).alias("b"))
        .select(
            "conv_id",
            F.array_join(F.col("b.formatted"), "").alias("formatted"),
            F.flatten(F.col("b.loss")).alias("loss"),
        )
    )


def read_back(rendered: DataFrame) -> DataFrame:
    """``render``'s rows with ``turns`` (role, text) and ``learnt``, the unescaped texts in order."""
    pieces = F.split("formatted", TURN_END)
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        head = F.substring_index(piece, HEADER_END, 1)
        text = F.substr(piece, F.char_length(head) + len(HEADER_END) + 1)
        role = F.substr(head, F.lit(len(HEADER) + 1))
        return F.struct(unescape(role, ROLE_CODES).alias("role"), unescape(text).alias("text"))

    def masked(piece: Column, loss: Column) -> Column:
        start, length = (loss["skip"] + 1).cast("int"), loss["take"].cast("int")
        return F.when(length > 0, unescape(F.substr(piece, start, length))).otherwise("")

    return rendered.withColumn("pieces", pieces).select(
        "*",
        F.transform("pieces", turn).alias("turns"),
        F.zip_with("pieces", "loss", masked).alias("learnt"),
    ).drop("pieces")


def log_of_turns(turns: DataFrame) -> DataFrame:
    """Rows ``conv_id, turn, role, text`` as a log in which each row begins a message of its own."""
    return turns.select(
        "conv_id", F.col("turn").alias("seq"),
        F.monotonically_increasing_id().cast("string").alias("message_id"),
        F.lit("message").alias("kind"), "role", "text",
    )


def digests(read: DataFrame) -> DataFrame:
    """Sizes and digests of what ``read_back`` returns."""
    line = F.lit("\n")
    whole = F.array_join(
        F.transform("turns", lambda t: F.concat(t["role"], line, t["text"], line)), ""
    )
    learnt = F.array_join("learnt", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(whole.cast("binary"), 256).alias("turns_sha256"),
        F.char_length(learnt).cast("long").alias("loss_chars"),
        F.sha2(learnt.cast("binary"), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )
