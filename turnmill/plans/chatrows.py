"""Rows of one-to-one chats, ready for ordering: the input of turn and run building."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions import body as B
from turnmill.functions import clock as C
from turnmill.session import table

#: Nanoseconds of one block of a chat's time line (a day).
BLOCK_NS = 86_400 * 1_000_000_000


def _blank(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("")) == ""


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0)) == 0


def is_plain() -> Column:
    """True for messages that are no reaction, effect or system row; never null."""
    return _blank("associated_message_guid") & _blank("balloon_bundle_id") & _blank("expressive_send_style_id") & _zero("associated_message_type") & _zero("item_type")


def one_to_one(spark: SparkSession, root: str) -> DataFrame:
    """chat_id of chats with exactly one distinct member that exists."""
    members = table(spark, root, "chat_handle_join").join(table(spark, root, "handle").select(F.col("rowid").alias("handle_id")).distinct(), "handle_id", "left_semi")
    return members.groupBy("chat_id").agg(F.countDistinct("handle_id").alias("n")).where("n = 1").select("chat_id")


def links(spark: SparkSession, root: str) -> DataFrame:
    """Distinct (chat_id, message_id)."""
    return table(spark, root, "chat_message_join").select("chat_id", "message_id").where("chat_id is not null and message_id is not null").distinct()


def dated_rows(spark: SparkSession, root: str) -> DataFrame:
    """(id, t, me, body_text): plain dated messages; ``t``, ``me`` and ``body_text`` as in ``chat_rows``."""
    return (
        table(spark, root, "message")
        .where(is_plain() & F.col("date").isNotNull() & (F.col("date") != 0))
        .select(
            F.col("rowid").alias("id"),
            C.to_nanos(F.col("date")).alias("t"),
            (F.coalesce(F.col("is_from_me"), F.lit(0)) != 0).alias("me"),
            B.row_text(F.col("text"), F.col("attributedbody")).alias("body_text"),
        )
    )


def chat_rows(spark: SparkSession, root: str) -> DataFrame:
    """(chat_id, id, t, me, body_text): plain dated rows of one-to-one chats.

    ``t`` is nanoseconds since 2001, ``me`` whether the row is one's own
    (null means not), ``body_text`` the row text or null. Repeated links
    count once; rows without a link, a date or a known chat are left out.
    """
    kept = links(spark, root).join(one_to_one(spark, root), "chat_id", "left_semi")
    return dated_rows(spark, root).join(kept.withColumnRenamed("message_id", "id"), "id").select("chat_id", "id", "t", "me", "body_text")


def with_halo(rows: DataFrame, reach_ns: int, block_ns: int = BLOCK_NS) -> DataFrame:
    """Rows by (chat_id, block), each block with the rows up to ``reach_ns`` before it.

    A hot chat becomes as many groups as it has blocks of time, so no task
    gets a whole chat, and the row before any row is in its block if it is
    no more than ``reach_ns`` older. ``halo`` marks the rows lent to the
    next block; with blocks longer than the reach, one copy is enough.
    """
    block = F.floor(F.col("t") / F.lit(block_ns)).cast("long")
    late = F.pmod(F.col("t"), F.lit(block_ns)) >= block_ns - reach_ns
    return rows.select(
        "*", F.explode(F.when(late, F.array(F.struct(block.alias("block"), F.lit(False).alias("halo")), F.struct((block + 1).alias("block"), F.lit(True).alias("halo")))).otherwise(F.array(F.struct(block.alias("block"), F.lit(False).alias("halo"))))).alias("_b")
    ).select("*", "_b.*").drop("_b")
