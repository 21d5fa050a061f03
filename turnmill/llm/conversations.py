"""Problem 3: conversations made of turns, from message rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.plans.chatrows import BLOCK_NS, chat_rows, dated_rows, with_halo
from turnmill.session import cut, table

SECOND = 1_000_000_000
TURN_GAP_NS, TALK_GAP_NS = 600 * SECOND, 3600 * SECOND
#: Largest clock offset that is looked for; a row that seems earlier than that is late, whatever the clocks.
MAX_SKEW_NS = 900 * SECOND
#: Share of reply-before constraints that late rows break where both clocks are right, and the evidence (in nats) against that share from which a clock, or a conversation, is taken to be wrong.
LATE, EVIDENCE = 0.03, 16.0
#: Bits of an offset found in each pass, and passes: 2 ** (5 * 8) ns are more than MAX_SKEW_NS.
BITS, PASSES = 5, 8


def constraints(rows: DataFrame) -> DataFrame:
    """Adds ``d``: what each row tells of the clocks, in nanoseconds, else null.

    A message that arrives (has the next id) right after one of the other
    speaker, on the same day of the chat, answers it and cannot have been
    sent before it. ``d`` is the time between the two; with the offset x of
    the other side's clock it asks for ``x <= d`` of an own reply and for
    ``x >= -d`` of the other's. Below -MAX_SKEW_NS it asks for nothing.
    """
    w = Window.partitionBy("chat_id", F.floor(F.col("t") / F.lit(BLOCK_NS))).orderBy("id", "t")
    d = F.col("t") - F.lag("t").over(w)
    return rows.withColumn("d", F.when((F.lag("me").over(w) != F.col("me")) & (d > -MAX_SKEW_NS), d))


def evidence(broken: Column, n: Column) -> Column:
    """How far ``broken`` of ``n`` constraints speak against LATE of them, in nats; 0 if they are no more than that.

    The large-deviation exponent: by chance alone so many are broken with a
    probability of at most exp(-evidence), whatever the number of constraints.
    """
    q = broken / F.when(n > 0, n)
    part = lambda x, y: F.when(x > 0, x * F.log(x / F.lit(y))).otherwise(F.lit(0.0))
    return F.when(q > LATE, n * (part(q, LATE) + part(1 - q, 1 - LATE))).otherwise(F.lit(0.0))


def offsets(rows: DataFrame) -> DataFrame:
    """(chat_id, offset_ns): the other side's clock against one's own, of chats where it is wrong.

    ``rows`` with ``constraints``. A clock is wrong where the constraints of
    one direction are broken beyond what late rows explain (``evidence``);
    all chats are tested alike, whatever their length. The offset is the
    least-squares solution of all constraints of the chat, i.e. it has the
    least sum of squared violations, and of several the one nearest to zero:
    the derivative of that sum grows with x, and the place where it turns is
    found bit by bit, in PASSES sums over the constraints of those chats. No
    chat's constraints are gathered anywhere.
    """
    told = rows.where(F.col("d").isNotNull()).select("chat_id", "me", "d")
    own, other, late = F.col("me"), ~F.col("me"), F.col("d") < 0
    pull = F.sum(F.when(late, F.when(own, -F.col("d")).otherwise(F.col("d"))).otherwise(F.lit(0)).cast("double"))
    by = told.groupBy("chat_id").agg(F.count_if(own).alias("n_own"), F.count_if(own & late).alias("b_own"), F.count_if(other).alias("n_other"), F.count_if(other & late).alias("b_other"), pull.alias("pull"))
    wrong = (evidence(F.col("b_own"), F.col("n_own")) > EVIDENCE) | (evidence(F.col("b_other"), F.col("n_other")) > EVIDENCE)
    # Positive pull: the own replies ask for less than zero, so the way is down.
    found = cut(by.where(wrong).select("chat_id", (-F.signum("pull")).alias("way"), F.lit(0).cast("long").alias("low")))
    if found.isEmpty():
        return found.select("chat_id", F.col("low").alias("offset_ns"))
    told = cut(told.join(found.select("chat_id"), "chat_id"))
    # Along the way y = way * x >= 0: how far a constraint is broken there, and in which direction it pulls.
    for p in reversed(range(PASSES)):
        step = 1 << (BITS * p)
        at = told.join(found, "chat_id").withColumn("a", F.when(own, F.col("d")).otherwise(-F.col("d")) * F.col("way")).withColumn("up", own == (F.col("way") > 0))
        force = lambda y: F.sum(F.when(F.col("up"), F.greatest(y - F.col("a"), F.lit(0.0))).otherwise(-F.greatest(F.col("a") - y, F.lit(0.0))))
        sums = at.groupBy("chat_id", "way", "low").agg(*(force((F.col("low") + j * step).cast("double")).alias(f"f{j}") for j in range(1, 1 << BITS)))
        below = sum((F.when(F.col(f"f{j}") < 0, 1).otherwise(0) for j in range(1, 1 << BITS)), F.lit(0))
        found = cut(sums.select("chat_id", "way", (F.col("low") + below.cast("long") * F.lit(step).cast("long")).alias("low")))
    # ``low`` is the last nanosecond at which the sum still falls along the way.
    return found.select("chat_id", (F.col("way") * F.when(F.col("way") != 0, F.col("low") + 1)).cast("long").alias("offset_ns")).where("offset_ns is not null")


def corrected(rows: DataFrame, moved: DataFrame) -> DataFrame:
    """Rows with the other side's times, and what they tell of the clocks (``d``), moved by the ``offsets``."""
    x = F.coalesce("offset_ns", F.lit(0))
    out = rows.join(moved, "chat_id", "left").withColumn("t", F.when(F.col("me"), F.col("t")).otherwise(F.col("t") + x))
    if "d" in rows.columns:
        out = out.withColumn("d", F.when(F.col("me"), F.col("d") - x).otherwise(F.col("d") + x))
    return out.drop("offset_ns")


def conversations(rows: DataFrame, turn_gap_ns: int = TURN_GAP_NS, talk_gap_ns: int = TALK_GAP_NS, correct: bool = True) -> DataFrame:
    """One row for each turn of each kept conversation.

    ``rows``: chat_id, id, t, me, has_text, whole (text or attachment).
    Columns out: chat_id, conversation (its first row's id), conversation_first_message_id,
    turn_no, me, first_message_id, last_message_id, first_t, last_t, n.
    Times are corrected by ``offsets``; a conversation whose constraints are
    still broken beyond what late rows explain is infeasible and rejected
    (with ``correct``, rows without ``d`` get their constraints here; without
    it, times are taken as they are, and only rows with ``d`` are tested). Broken ones and those without an own turn after another's go too.
    Equal times are ordered by id. All ordering is done in groups of
    (chat, day); what passes midnight is carried over from day to day on one
    summary row for each chat and day, so no task gets a whole chat. An
    empty input gives an empty result.
    """
    if correct:
        rows = rows if "d" in rows.columns else cut(constraints(rows))
        rows = corrected(rows, offsets(rows))
    elif "d" not in rows.columns:
        rows = rows.withColumn("d", F.lit(None).cast("long"))
    halo = with_halo(rows, talk_gap_ns)
    by_day = Window.partitionBy("chat_id", "block").orderBy("t", "id")
    so_far = by_day.rowsBetween(Window.unboundedPreceding, 0)
    earlier = by_day.rowsBetween(Window.unboundedPreceding, -1)
    key = F.struct("t", "id")
    said = F.last(F.when(F.col("has_text"), F.struct("t", "me")), True).over(earlier)
    step = halo.select(
        "*",
        F.coalesce(F.col("t") - F.lag("t").over(by_day) > talk_gap_ns, F.lit(True)).alias("new_talk"),
        (F.col("has_text") & F.coalesce((said["me"] != F.col("me")) | (F.col("t") - said["t"] > turn_gap_ns), F.lit(True))).alias("new_turn"),
    ).where("not halo")
    marked = step.select(
        "chat_id", "block", "id", "t", "me", "has_text", "whole", "d",
        F.max(F.when(F.col("new_talk"), key)).over(so_far).alias("talk"),
        F.max(F.when(F.col("new_turn"), key)).over(so_far).alias("turn"),
    )
    # Parts of turns, day by day. Rows without text form parts of their own (turn null), for breaks and for what is carried.
    parts = cut(
        marked.groupBy("chat_id", "block", "talk", "has_text", F.when(F.col("has_text"), F.col("turn")).alias("turn"))
        .agg(F.first("me").alias("me"), F.min(key).alias("a"), F.max(key).alias("z"), F.count("*").alias("n"), F.bool_and("whole").alias("whole"), F.count("d").alias("told"), F.count_if(F.col("d") < 0).alias("against"))
    )
    days = parts.groupBy("chat_id", "block").agg(F.max("talk").alias("talk"), F.max("turn").alias("turn"))
    before = Window.partitionBy("chat_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = days.select("chat_id", "block", F.last("talk", True).over(before).alias("c_talk"), F.last("turn", True).over(before).alias("c_turn"))
    full = parts.join(carried, ["chat_id", "block"]).withColumn("talk", F.coalesce("talk", "c_talk"))
    full = full.withColumn("turn", F.when(F.col("has_text"), F.coalesce("turn", "c_turn"))).drop("c_talk", "c_turn")
    # Without a break before it, an other's turn somewhere before an own one means that one directly follows the other.
    talks = full.groupBy("chat_id", "talk").agg(
        F.bool_and("whole").alias("whole"), F.min("turn").alias("first_turn"),
        F.min(F.when(~F.col("me"), F.col("turn"))).alias("other_from"), F.max(F.when(F.col("me"), F.col("turn"))).alias("own_to"),
        evidence(F.sum("against"), F.sum("told")).alias("evidence"),
    ).where((F.col("evidence") <= EVIDENCE) & F.expr("whole and other_from < own_to")).select("chat_id", "talk", "first_turn")
    turns = full.where("has_text").groupBy("chat_id", "talk", "turn").agg(F.first("me").alias("me"), F.min("a").alias("a"), F.max("z").alias("z"), F.sum("n").alias("n"))
    kept = turns.join(talks, ["chat_id", "talk"]).withColumn("day", F.floor(F.col("turn.t") / F.lit(BLOCK_NS)).cast("long"))
    # Turn numbers: inside each day, plus the turns of the conversation's days before (hardly ever more than two).
    within = F.row_number().over(Window.partitionBy("chat_id", "talk", "day").orderBy("turn"))
    kept = kept.withColumn("no", within)
    crossing = full.where("has_text").groupBy("chat_id", "talk", F.floor(F.col("turn.t") / F.lit(BLOCK_NS)).cast("long").alias("day")).agg(F.countDistinct("turn").alias("k"))
    skip = crossing.select("chat_id", "talk", "day", F.sum("k").over(Window.partitionBy("chat_id", "talk").orderBy("day").rowsBetween(Window.unboundedPreceding, -1)).alias("skip")).where("skip > 0")
    return kept.join(skip, ["chat_id", "talk", "day"], "left").select(
        "chat_id", F.col("talk.id").alias("conversation"), F.col("first_turn.id").alias("conversation_first_message_id"),
        (F.col("no") + F.coalesce("skip", F.lit(0))).cast("long").alias("turn_no"), "me",
        F.col("a.id").alias("first_message_id"), F.col("z.id").alias("last_message_id"), F.col("a.t").alias("first_t"), F.col("z.t").alias("last_t"), "n",
    )


def state_rows(spark: SparkSession, root: str) -> DataFrame:
    """Chat rows with has_text and whole (text or an attachment), without the text."""
    attached = table(spark, root, "message_attachment_join").select(F.col("message_id").alias("id")).where("id is not null").distinct().withColumn("att", F.lit(True))
    rows = chat_rows(spark, root).select("chat_id", "id", "t", "me", F.col("body_text").isNotNull().alias("has_text"))
    return rows.join(attached, "id", "left").select("chat_id", "id", "t", "me", "has_text", (F.col("has_text") | F.coalesce("att", F.lit(False))).alias("whole"))


def found(spark: SparkSession, root: str) -> DataFrame:
    """Turns of kept conversations, with the columns TESTDATA.md gives.

    Several readers use the narrow rows (times, speaker, two flags), so they
    are written once.
    """
    return conversations(cut(constraints(state_rows(spark, root)))).select("chat_id", "conversation_first_message_id", "turn_no", "first_message_id", "last_message_id")


def transcripts(spark: SparkSession, root: str) -> DataFrame:
    """(chat_id, conversation_first_message_id, turn_no, role, content) with the turns' texts joined by LF.

    Narrow rows are attached to their turns by chat and day, then by time,
    both with times corrected by the same offsets; only then do they meet
    their texts, which are shuffled twice in all: to their ids and to their
    turns. A message id names one row.
    """
    state = cut(constraints(state_rows(spark, root)))
    moved = cut(offsets(state))
    state = corrected(state, moved)
    turns = conversations(state, correct=False)
    spans = turns.withColumn("block", F.explode(F.sequence(day_of(F.col("first_t")), day_of(F.col("last_t")))))
    rows = state.where("has_text").select("chat_id", day_of(F.col("t")).alias("block"), "t", "id", F.lit(1).alias("kind"), F.lit(None).cast("struct<c:bigint,n:bigint,me:boolean,zt:bigint,zi:bigint>").alias("turn"))
    begun = day_of(F.col("first_t")) == F.col("block")
    marks = spans.select(
        "chat_id", "block", F.greatest(F.col("first_t"), F.col("block") * BLOCK_NS).alias("t"), F.when(begun, F.col("first_message_id")).otherwise(F.lit(-1)).alias("id"), F.lit(0).alias("kind"),
        F.struct(F.col("conversation_first_message_id").alias("c"), F.col("turn_no").alias("n"), "me", F.col("last_t").alias("zt"), F.col("last_message_id").alias("zi")).alias("turn"),
    )
    # The turn a row belongs to is the last one that began: an as-of match by one ordered union.
    w = Window.partitionBy("chat_id", "block").orderBy("t", "id", "kind").rowsBetween(Window.unboundedPreceding, 0)
    at = rows.unionByName(marks).withColumn("turn", F.last("turn", True).over(w)).where("kind = 1 and (t < turn.zt or t = turn.zt and id <= turn.zi)")
    said = at.select("chat_id", "id", "t", "turn.c", "turn.n", "turn.me").join(dated_rows(spark, root).where("body_text is not null").select("id", "body_text"), "id")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("t", "id", "body_text"))), lambda x: x["body_text"]), "\n")
    role = F.when(F.first("me"), F.lit("assistant")).otherwise(F.lit("user"))
    return said.groupBy("chat_id", F.col("c").alias("conversation_first_message_id"), F.col("n").alias("turn_no")).agg(role.alias("role"), text.alias("content"))


def day_of(c):
    return F.floor(c / F.lit(BLOCK_NS)).cast("long")
