"""Problem 6: runs of (nearly) the same message by one speaker."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.functions import text as X
from turnmill.plans.chatrows import chat_rows, with_halo
from turnmill.session import cut

GAP_NS = 600 * 1_000_000_000


def bare_or_plain(c):
    """Bare form; where nothing is left, lower case without white space."""
    b = X.bare(c)
    return F.when(b != "", b).otherwise(X.squeeze_spaces(F.lower(c)))


def near(a, b):
    """Edit distance of at most one character for every ten of the longer text.

    Stops early beyond that distance; unequal lengths are told apart before.
    """
    longer = F.greatest(F.length(a), F.length(b))
    limit = F.floor(longer / 10).cast("int")
    return F.when(a == b, F.lit(True)).when(F.abs(F.length(a) - F.length(b)) > limit, F.lit(False)).when(limit == 0, F.lit(False)).otherwise(F.call_function("levenshtein", a, b, limit) >= 0)


def linked(rows: DataFrame, gap_ns: int = GAP_NS) -> DataFrame:
    """Rows that continue a run, with the id and time of the row before each.

    ``rows``: chat_id, id, t, me, body_text; rows without text must be gone.
    The canonical event is compared inside (chat, day) groups that also hold
    the last ``gap_ns`` of the day before, so no group is a whole chat.
    ``island`` is the within-group row number less the number among rows
    that continue: constant on each stretch of continuing rows.
    """
    halo = with_halo(rows.select("chat_id", "id", "t", "me", bare_or_plain(F.col("body_text")).alias("event")), gap_ns)
    w = Window.partitionBy("chat_id", "block").orderBy("t", "id")
    before = lambda c: F.lag(c).over(w)
    pairs = halo.select("chat_id", "block", "halo", "id", "t", before("id").alias("prev_id"), before("t").alias("prev_t"), F.row_number().over(w).alias("n"),
        (before("me") == F.col("me")).alias("same"), "event", before("event").alias("prev_event"))
    goes_on = pairs.where("not halo and same").where(F.col("t") - F.col("prev_t") <= gap_ns).where(near(F.col("event"), F.col("prev_event")))
    among = F.row_number().over(Window.partitionBy("chat_id", "block").orderBy("t", "id"))
    return goes_on.select("chat_id", "block", "id", "t", "prev_id", "prev_t", (F.col("n") - among).alias("island"))


def runs(rows: DataFrame, gap_ns: int = GAP_NS, with_ids: bool = False) -> DataFrame:
    """(chat_id, first_id, last_id, first_t, last_t, n) of each run of two or more.

    Islands of one day are aggregated first; those that continue one of the
    day before are then joined to it by their first row (at most one for
    each chat and day). Equal times are ordered by id; repeated (chat, id)
    rows must be gone; an empty input gives an empty result. With
    ``with_ids`` the ids come too, in order.
    """
    ids = [F.array_sort(F.collect_list(F.struct("t", "id"))).alias("rows")] if with_ids else []
    parts = linked(rows, gap_ns).groupBy("chat_id", "block", "island").agg(
        F.min(F.struct("t", "id", "prev_id", "prev_t")).alias("a"), F.max(F.struct("t", "id")).alias("z"), F.count("*").alias("n"), *ids
    )
    parts = cut(parts.select("chat_id", F.col("a.prev_id").alias("head_id"), F.col("a.prev_t").alias("head_t"), F.col("z.id").alias("tail_id"), F.col("z.t").alias("tail_t"), "n", *(["rows"] if with_ids else [])))
    # A part whose head is the tail of another goes on from it: a chain over days, at most one link a day.
    tails = parts.select("chat_id", F.col("tail_id").alias("head_id"), F.lit(True).alias("on"))
    heads = parts.join(tails, ["chat_id", "head_id"], "left")
    chains = heads.where("on").select("chat_id").distinct()
    alone = heads.join(chains, "chat_id", "left_anti")
    # Only chats with such a chain get their parts numbered in order, day by day and then over days.
    day = F.floor(F.col("head_t") / F.lit(86_400 * 1_000_000_000)).cast("long")
    some = heads.join(chains, "chat_id", "left_semi").withColumn("day", day)
    w = Window.partitionBy("chat_id", "day").orderBy("head_t", "head_id").rowsBetween(Window.unboundedPreceding, 0)
    some = some.withColumn("own", F.max(F.when(F.col("on").isNull(), F.struct("head_t", "head_id"))).over(w))
    per_day = some.groupBy("chat_id", "day").agg(F.max("own").alias("top"))
    back = per_day.select("chat_id", "day", F.last("top", True).over(Window.partitionBy("chat_id").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)).alias("carried"))
    some = some.join(back, ["chat_id", "day"]).withColumn("start", F.coalesce("own", "carried"))
    out_ids = [F.expr("flatten(transform(array_sort(collect_list(struct(tail_t, rows))), x -> x.rows))").alias("rows")] if with_ids else []
    joined = some.groupBy("chat_id", "start").agg(F.max(F.struct("tail_t", "tail_id")).alias("z"), F.sum("n").alias("n"), *out_ids)
    shape = lambda df: df.select("chat_id", F.col("head_id").alias("first_id"), F.col("tail_id").alias("last_id"), F.col("head_t").alias("first_t"), F.col("tail_t").alias("last_t"), (F.col("n") + 1).alias("n"), *(["rows"] if with_ids else []))
    more = joined.select("chat_id", F.col("start.head_id").alias("head_id"), F.col("z.tail_id").alias("tail_id"), F.col("start.head_t").alias("head_t"), F.col("z.tail_t").alias("tail_t"), "n", *(["rows"] if with_ids else []))
    return shape(alone).unionByName(shape(more))


def _rows(spark: SparkSession, root: str) -> DataFrame:
    return chat_rows(spark, root).where("body_text is not null")


def found(spark: SparkSession, root: str) -> DataFrame:
    """(chat_id, first_message_id, last_message_id) of each run (see TESTDATA.md)."""
    return runs(_rows(spark, root)).select("chat_id", F.col("first_id").alias("first_message_id"), F.col("last_id").alias("last_message_id"))


def entries(spark: SparkSession, root: str) -> DataFrame:
    """One entry for each run: message ids in order, count, duration in seconds."""
    r = runs(_rows(spark, root), with_ids=True)
    ids = F.concat(F.array("first_id"), F.transform("rows", lambda x: x["id"]))
    return r.select("chat_id", ids.alias("message_ids"), F.col("n").alias("copies"), ((F.col("last_t") - F.col("first_t")) / 1e9).alias("seconds"))
