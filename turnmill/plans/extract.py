"""Message rows to turns to reply pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions import body as B
from turnmill.functions import clock as C
from turnmill.functions import text as X
from turnmill.functions.jsonl import line_of
from turnmill.plans.chats import optional
from turnmill.session import cut

BLOCK_S = 86_400.0


def is_effect(df: DataFrame) -> Column:
    """Reactions, effects and system rows; never null, absent columns count as null."""
    text = lambda c: F.coalesce(optional(df, c, "string") != "", F.lit(False))
    number = lambda c: F.coalesce(optional(df, c, "int") != 0, F.lit(False))
    return text("associated_message_guid") | number("associated_message_type") | number("item_type") | text("balloon_bundle_id") | text("expressive_send_style_id")


def attachment_flags(messages: DataFrame, attachments: DataFrame | None) -> DataFrame:
    """Adds ``has_attachment``; the ids are made distinct first, so no row doubles."""
    if attachments is None:
        return messages.withColumn("has_attachment", F.lit(False))
    ids = attachments.select(F.col("message_id").alias("_m")).where("_m is not null").distinct()
    return messages.join(ids, messages["message_id"] == ids["_m"], "left").withColumn("has_attachment", F.col("_m").isNotNull()).drop("_m")


def classified(message: DataFrame, chat_message_join: DataFrame, chats: DataFrame, attachments: DataFrame | None = None, hosts: tuple[str, ...] = ()) -> DataFrame:
    """Every row of the selected chats with its fate, before anything is dropped.

    Repeated links stay repeated. Columns: chat_id, contact_label, message_id,
    ts, me, effect, own_text, body_text, text, has_body, has_attachment. Only
    linked rows are recovered, and of them those without text and effect; no
    other body is carried through the join, and property lists reach Python
    only by their first bytes. A body stored as text (``attributedbody_text``)
    counts as it is.
    """
    body, as_text = optional(message, "attributedbody", "binary"), optional(message, "attributedbody_text", "string")
    m = message.select(
        F.col("rowid").alias("message_id"),
        C.to_unix(F.col("date")).alias("ts"),
        (F.coalesce(F.col("is_from_me"), F.lit(0)) != 0).alias("me"),
        is_effect(message).alias("effect"),
        X.normalize(optional(message, "text", "string")).alias("own_text"),
        body.alias("body"),
        as_text.alias("body_as_text"),
    )
    bare = (F.col("own_text") == "") & ~F.col("effect")
    m = m.withColumn("has_body", F.col("body").isNotNull() | F.col("body_as_text").isNotNull()).withColumns({c: F.when(bare, F.col(c)) for c in ("body", "body_as_text")})
    rows = chat_message_join.select("chat_id", "message_id").join(chats.select("chat_id", "contact_label"), "chat_id").join(m, "message_id")
    rows = attachment_flags(rows, attachments)
    rows = rows.withColumn("body_text", F.when(F.col("body_as_text").isNotNull(), X.normalize(F.col("body_as_text"))).otherwise(B.recover(F.col("body"), hosts=hosts)))
    rows = with_text(rows)
    return rows.select("chat_id", "contact_label", "message_id", "ts", "me", "effect", "own_text", "body_text", "text", "has_body", "has_attachment")


def with_text(rows: DataFrame) -> DataFrame:
    """Adds ``text``: a row's own text, or what its body holds."""
    return rows.withColumn("text", F.when(F.col("own_text") != "", F.col("own_text")).otherwise(F.col("body_text")))


def kept(rows: DataFrame) -> DataFrame:
    """Rows that are messages: no effects, no empty texts, no media without own text."""
    stay = ~F.col("effect") & (F.col("text") != "") & ~(F.col("has_attachment") & (F.col("own_text") == ""))
    return rows.where(stay).select("chat_id", "contact_label", "message_id", "ts", "me", "text")


def turns(rows: DataFrame, gap_seconds: float = 600) -> DataFrame:
    """Consecutive rows of one speaker, each at most ``gap_seconds`` after the one before.

    Columns: chat_id, contact_label, me, start_ts, end_ts, message_ids, text
    (joined by LF), in the order of time, then id. Rows are ordered in
    groups of (chat, day), each with the last ``gap_seconds`` of the day
    before; a turn that passes midnight is put together from its parts by
    one summary row for each chat and day, so a hot chat is many groups.
    """
    block = F.floor(F.col("ts") / F.lit(BLOCK_S)).cast("long")
    reach = F.sequence(block, F.floor((F.col("ts") + F.lit(float(gap_seconds))) / F.lit(BLOCK_S)).cast("long"))
    lent = rows.select("*", block.alias("home"), F.explode(reach).alias("block"))
    w = Window.partitionBy("chat_id", "block").orderBy("ts", "message_id")
    new = F.coalesce((F.lag("me").over(w) != F.col("me")) | (F.col("ts") - F.lag("ts").over(w) > gap_seconds), F.lit(True))
    at = F.struct("ts", "message_id")
    own = lent.withColumn("new", new).where("block = home")
    own = own.withColumn("turn", F.max(F.when(F.col("new"), at)).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    parts = cut(own.groupBy("chat_id", "block", "turn").agg(F.first("contact_label").alias("contact_label"), F.first("me").alias("me"), F.array_sort(F.collect_list(F.struct("ts", "message_id", "text"))).alias("rows")))
    days = parts.groupBy("chat_id", "block").agg(F.max("turn").alias("top"))
    back = days.select("chat_id", "block", F.last("top", True).over(Window.partitionBy("chat_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    full = parts.join(back, ["chat_id", "block"]).withColumn("turn", F.coalesce("turn", "carried"))
    whole = full.groupBy("chat_id", "turn").agg(F.first("contact_label").alias("contact_label"), F.first("me").alias("me"), F.array_sort(F.flatten(F.collect_list("rows"))).alias("rows"))
    return whole.select(
        "chat_id", "contact_label", "me", F.col("rows")[0]["ts"].alias("start_ts"), F.element_at("rows", -1)["ts"].alias("end_ts"),
        F.transform("rows", lambda r: r["message_id"]).alias("message_ids"), F.array_join(F.transform("rows", lambda r: r["text"]), "\n").alias("text"),
    )


def pairs(t: DataFrame, hosts: tuple[str, ...] = (), clean: bool = True) -> DataFrame:
    """(chat_id, contact_label, user, assistant, accepted): an inbound turn directly before an own one.

    The next turn is found inside the day; the last turn of a day takes the
    first of the chat's next day, from one summary row for each day. There
    is no limit on the time between the two. With ``clean``, pairs with
    metadata or junk on either side are not accepted.
    """
    day = F.floor(F.col("start_ts") / F.lit(BLOCK_S)).cast("long")
    key = F.struct(F.col("start_ts").alias("ts"), F.col("message_ids")[0].alias("id"), "me", "text")
    t = cut(t.select("chat_id", "contact_label", "me", "text", day.alias("day"), key.alias("key")))
    firsts = t.groupBy("chat_id", "day").agg(F.min("key").alias("first"))
    after = firsts.select("chat_id", "day", F.lead("first").over(Window.partitionBy("chat_id").orderBy("day")).alias("later"))
    nxt = F.lead("key").over(Window.partitionBy("chat_id", "day").orderBy("key"))
    both = t.withColumn("next", nxt).where("not me").join(after, ["chat_id", "day"]).withColumn("next", F.coalesce("next", "later")).where("next.me")
    out = both.select("chat_id", "contact_label", F.col("text").alias("user"), F.col("next.text").alias("assistant"))
    bad = F.lit(False)
    if clean:
        # Texts of turns are made of normalised rows; joined by one line end each, they stay normalised.
        bad = X.is_metadata(F.col("user"), hosts, True) | X.is_metadata(F.col("assistant"), hosts, True) | X.is_junk(F.col("user"), True) | X.is_junk(F.col("assistant"), True)
    return out.withColumn("accepted", ~bad)


def messages_of(user: Column, assistant: Column) -> Column:
    """The two-message array of a record."""
    return F.array(F.struct(F.lit("user").alias("role"), user.alias("content")), F.struct(F.lit("assistant").alias("role"), assistant.alias("content")))


def dedupe(p: DataFrame) -> DataFrame:
    """One record for each JSON line, kept for the contact of the smallest chat id."""
    lined = p.withColumn("line", line_of(messages_of(F.col("user"), F.col("assistant"))))
    return lined.groupBy("line").agg(F.min_by("contact_label", F.struct("chat_id", "contact_label")).alias("contact_label"), F.first("user").alias("user"), F.first("assistant").alias("assistant"))


def contact_minimum(records: DataFrame, least: int = 5) -> DataFrame:
    """Records of contacts that have at least ``least`` of them after dedupe.

    Counts are aggregated and joined back rather than windowed, so a contact
    with a third of all records is no single task.
    """
    enough = records.groupBy("contact_label").agg(F.count("*").alias("n")).where(F.col("n") >= least).select("contact_label")
    return records.join(enough, "contact_label", "left_semi")


def stats(rows: DataFrame, p: DataFrame) -> DataFrame:
    """The extractor's seven counters as one row; they overlap as documented in the README."""
    live = ~F.col("effect")
    no_own = live & (F.col("own_text") == "")
    counted = rows.agg(
        F.count_if(live & (F.col("own_text") != "")).alias("clean_text"),
        F.count_if(no_own & F.col("has_body") & (F.col("body_text") != "")).alias("clean_attributed_body"),
        F.count_if(no_own & F.col("has_body") & (F.col("body_text") == "")).alias("low_confidence"),
        F.count_if(F.col("effect")).alias("reactions"),
        F.count_if(no_own & (F.col("body_text") != "") & F.col("has_attachment")).alias("media_only"),
        F.count_if(no_own & (F.col("body_text") == "")).alias("empty_text"),
    )
    return counted.crossJoin(p.agg(F.count_if(~F.col("accepted")).alias("junk_pairs")))  # one row each


# How each counter is called in the printed line.
PRINTED = {
    "clean_text": "message.text", "clean_attributed_body": "clean_attributedBody", "low_confidence": "low_confidence_attributed_dropped", "reactions": "reaction_or_effect_dropped",
    "media_only": "media_only_dropped", "empty_text": "empty_text_dropped", "junk_pairs": "junk_pairs_dropped",
}


def format_stats(row) -> str:
    """The counters as one printed line."""
    return "Extraction stats: " + ", ".join(f"{shown}={row[k]}" for k, shown in PRINTED.items())
