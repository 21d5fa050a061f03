"""Chat selection: one-to-one chats, contact labels, exclusion, seeded sampling."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions import text as X


def optional(df: DataFrame, name: str, kind: str) -> Column:
    """The column ``name``, or a typed null where the source lacks it."""
    return (F.col(name) if name in df.columns else F.lit(None)).cast(kind).alias(name)


def contact_label(uncanonicalized: Column, handle: Column, identifier: Column, chat_id: Column) -> Column:
    """The first non-empty of three names, trimmed; else ``chat_<id>``.

    Emptiness is tested before trimming, so a name of white space only gives
    an empty label.
    """
    first = F.coalesce(F.nullif(uncanonicalized, F.lit("")), F.nullif(handle, F.lit("")), F.nullif(identifier, F.lit("")))
    return F.coalesce(X.strip(first), F.concat(F.lit("chat_"), chat_id.cast("string")))


def one_to_one_chats(chat: DataFrame, chat_handle_join: DataFrame, handle: DataFrame) -> DataFrame:
    """(chat_id, contact_label) of chats with exactly one distinct existing handle.

    Membership rows that point nowhere do not count and repeated ones count
    once. The aggregate combines before its shuffle.
    """
    c = chat.select(F.col("rowid").alias("chat_id"), optional(chat, "chat_identifier", "string"))
    h = handle.select(F.col("rowid").alias("handle_id"), F.col("id").alias("handle"), optional(handle, "uncanonicalized_id", "string"))
    one = chat_handle_join.select("chat_id", "handle_id").join(h, "handle_id").groupBy("chat_id").agg(
        F.countDistinct("handle_id").alias("n"), F.min("handle").alias("handle"), F.min("uncanonicalized_id").alias("other")
    ).where("n = 1")
    return c.join(one, "chat_id").select("chat_id", contact_label(F.col("other"), F.col("handle"), F.col("chat_identifier"), F.col("chat_id")).alias("contact_label"))


def exclude(chats: DataFrame, labels: list[str]) -> DataFrame:
    """Without chats whose label equals one of the trimmed, non-blank ``labels``."""
    drop = [x.strip() for x in labels if x.strip()]
    return chats.where(~F.col("contact_label").isin(drop)) if drop else chats


def sample(chats: DataFrame, limit: int | None, seed: int) -> DataFrame:
    """``limit`` chats by the seeded generator, positions counted in (label, id) order.

    Only the number of chats and the drawn positions are on the driver. The
    positions of all rows come from counts of range partitions, so no task
    numbers the whole table.
    """
    if limit is None:
        return chats
    n = chats.count()
    if limit >= n:
        return chats
    spark = chats.sparkSession
    picked = spark.createDataFrame([(i,) for i in sorted(random.Random(seed).sample(range(n), limit))], "position long")
    return positions(chats, ["contact_label", "chat_id"]).join(picked, "position").drop("position")


def positions(df: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``position``, from 0, in the order of columns that identify a row.

    Rows are numbered inside range partitions, whose sizes are then summed.
    """
    from turnmill.session import cut

    parts = cut(df.repartitionByRange(*order).withColumn("_p", F.spark_partition_id()))
    sizes = parts.groupBy("_p").agg(F.count("*").alias("k"))
    before = sizes.select("_p", F.coalesce(F.sum("k").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("skip"))
    inside = parts.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(*order)))
    return inside.join(F.broadcast(before), "_p").withColumn("position", F.col("_n") - 1 + F.col("skip")).drop("_p", "_n", "skip")
