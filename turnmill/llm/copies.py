"""Problem 2: copies that differ only in formatting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions import text as X
from turnmill.functions.jsonl import check_line
from turnmill.plans.chatrows import is_plain, links
from turnmill.session import cut, table

#: Shortest bare form of a message that counts as a copy.
MIN_CHARS = 20


def _digest(c: str):
    return F.unhex(F.md5(F.col(c).cast("binary")))


def collapse(keys: DataFrame, texts: DataFrame, scope: list[str], canon) -> tuple[DataFrame, DataFrame]:
    """Byte-identical rows first, then equal canonical texts, both with counts.

    ``keys`` has ``id``, the ``scope`` columns and ``raw``, a 16-byte digest of
    the row's text; ``texts`` has ``id`` and ``text``; ``canon`` adds to distinct
    rows with their text the column ``canon`` (null drops the row). Returns
    (distinct, sets): one row for each raw text with its smallest id and
    count, and one for each full canonical text with first_id and copies.
    Only one row of each raw text meets its text. Both groupings combine
    before the shuffle, so a text that holds a third of all rows is one row
    for each task there. Null texts are left out.
    """
    once = keys.groupBy(*scope, "raw").agg(F.min("id").alias("low_id"), F.count("*").alias("n"))
    seen = once.join(texts.withColumnRenamed("id", "low_id"), "low_id")
    distinct = cut(canon(seen).where("canon is not null").select(*scope, "raw", "low_id", "n", "canon"))
    sets = distinct.groupBy(*scope, "canon").agg(F.min("low_id").alias("first_id"), F.sum("n").alias("copies"))
    return distinct, sets


def members(keys: DataFrame, distinct: DataFrame, sets: DataFrame, scope: list[str]) -> DataFrame:
    """(first_id, copy_id) for every copy but the first of each set.

    Joins are on digests, not on texts; a hot text meets exactly one row
    there, which skew handling can split. The other ids of byte-identical
    rows come from ``keys``.
    """
    many = sets.where("copies > 1").select(*scope, _digest("canon").alias("key"), "first_id")
    known = distinct.select(*scope, "raw", "low_id", "n", _digest("canon").alias("key")).join(many, [*scope, "key"])
    again = keys.join(known.where("n > 1").select(*scope, "raw", "first_id", "low_id"), [*scope, "raw"]).where("id <> low_id").select("first_id", F.col("id").alias("copy_id"))
    return known.where("low_id <> first_id").select("first_id", F.col("low_id").alias("copy_id")).unionByName(again)


def _lines(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    texts = table(spark, root, "pair_line").where(F.col("line_id").isNotNull() & F.col("line").isNotNull()).select(F.col("line_id").alias("id"), F.col("line").alias("text"))
    return texts.select("id", _digest("text").alias("raw")), texts


def canon_line(distinct: DataFrame) -> DataFrame:
    """Canonical text of a valid line: both bare forms; null for other lines."""
    return distinct.withColumn("p", check_line(F.col("text"))).withColumn("canon", F.when(F.col("p.problem").isNull(), F.concat(X.bare(F.col("p.user")), F.lit("\n"), X.bare(F.col("p.assistant"))))).drop("p")


def _messages(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    plain = table(spark, root, "message").where(is_plain() & (2 * F.length("text") >= MIN_CHARS))
    keys = plain.select(F.col("rowid").alias("id"), (F.coalesce(F.col("is_from_me"), F.lit(0)) != 0).alias("me"), _digest("text").alias("raw"))
    return cut(keys.join(links(spark, root).withColumnRenamed("message_id", "id"), "id")), plain.select(F.col("rowid").alias("id"), "text")


def canon_message(distinct: DataFrame) -> DataFrame:
    """Canonical text of a message: its bare form where it is long enough, else null."""
    return distinct.withColumn("canon", X.bare(F.col("text"))).withColumn("canon", F.when(F.length("canon") >= MIN_CHARS, F.col("canon")))


SCOPES = (("pair_line", _lines, [], canon_line), ("message", _messages, ["chat_id", "me"], canon_message))


def found(spark: SparkSession, root: str) -> DataFrame:
    """(origin, first_id, copy_id) for lines and messages (see TESTDATA.md)."""
    out = []
    for origin, source, scope, canon in SCOPES:
        keys, texts = source(spark, root)
        distinct, sets = collapse(keys, texts, scope, canon)
        out.append(members(keys, distinct, sets, scope).select(F.lit(origin).alias("origin"), "first_id", "copy_id"))
    return out[0].unionByName(out[1]).distinct()


def collapsed(spark: SparkSession, root: str) -> DataFrame:
    """(origin, first_id, copies, record): one record for each set, lone ones included, as its first copy has it.

    A message counts once in each chat it is linked to.
    """
    out = []
    for origin, source, scope, canon in SCOPES:
        keys, texts = source(spark, root)
        _, sets = collapse(keys, texts, scope, canon)
        firsts = sets.select(F.col("first_id").alias("id"), "copies").join(texts.select("id", F.col("text").alias("record")), "id")
        out.append(firsts.select(F.lit(origin).alias("origin"), F.col("id").alias("first_id"), "copies", "record"))
    return out[0].unionByName(out[1])
