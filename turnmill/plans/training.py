"""Records to training examples: prompt shapes, splits, prompt texts."""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from turnmill.functions import text as X
from turnmill.plans.chats import positions


def prompt_completion(messages: Column) -> Column:
    """Struct of a one-message prompt and a one-message completion."""
    return F.struct(F.array(messages[0]).alias("prompt"), F.array(messages[1]).alias("completion"))


def prompt_text(history: Column) -> Column:
    """``role: content`` lines and the assistant's cue, for models without a template."""
    lines = F.transform(history, lambda m: F.concat_ws(": ", m["role"], F.coalesce(m["content"], F.lit(""))))
    return F.concat(F.array_join(lines, "\n"), F.lit("\nassistant:"))


def histories(turns: DataFrame, key: str, order: str) -> DataFrame:
    """Adds ``history``: all (role, content) of the key's session up to the row.

    What a user says is stripped of all white space at both ends, tested and
    stored so: ``reset`` (in any case) starts a new session, ``exit`` and
    ``quit`` end the key's history, blank contents are passed over. Replies
    stay as they are, blank ones included. A session's history grows with it
    by definition.
    """
    user = F.col("role") == "user"
    t = turns.withColumn("content", F.when(user, X.strip(F.coalesce("content", F.lit("")))).otherwise(F.col("content")))
    said = lambda *words: (F.coalesce(user & F.lower("content").isin(*words), F.lit(False))).cast("int")
    upto = Window.partitionBy(key).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    t = t.withColumn("_end", F.max(said("exit", "quit")).over(upto)).withColumn("_reset", said("reset")).where("_end = 0")
    t = t.withColumn("session", F.sum("_reset").over(upto)).where(~F.coalesce(user & ((F.col("content") == "") | (F.col("_reset") == 1)), F.lit(False)))
    w = Window.partitionBy(key, "session").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return t.withColumn("history", F.collect_list(F.struct("role", "content")).over(w)).drop("_end", "_reset")


def check_settings(val_size: float = 0.02, batch_size: int = 1, accumulation: int = 16, max_length: int = 512, epochs: float = 1.0) -> None:
    """Errors for settings of a training run that cannot be."""
    for name, value in (("batch_size", batch_size), ("accumulation", accumulation), ("max_length", max_length)):
        if value < 1:
            raise ValueError(f"{name} must be at least 1")
    if epochs <= 0:
        raise ValueError("epochs must be more than 0")
    if not 0 < val_size < 1:
        raise ValueError("val_size must be between 0 and 1")


def totals(examples: DataFrame, val_size: float = 0.02, batch_size: int = 1, accumulation: int = 16) -> DataFrame:
    """One row (total_rows, train_rows, val_rows, effective_batch) that a run starts from.

    At least one example is for validation; where that leaves none to train
    on, the error comes when the row is computed.
    """
    check_settings(val_size, batch_size, accumulation)
    n = examples.agg(F.count("*").alias("n"))
    k = F.greatest(F.lit(1), F.floor(F.col("n") * F.lit(float(val_size)))).cast("long")
    k = F.when(k >= F.col("n"), F.raise_error("no example would be left to train on").cast("long")).otherwise(k)
    return n.select(F.col("n").alias("total_rows"), (F.col("n") - k).alias("train_rows"), k.alias("val_rows"), F.lit(batch_size * accumulation).cast("long").alias("effective_batch"))


def split_seeded(examples: DataFrame, order: list[str], val_size: float = 0.02, seed: int = 42) -> DataFrame:
    """Adds ``split`` by the seeded shuffle of positions: the first val_size of them is validation.

    At least one example is; an error if none would be left to train on.
    The seeded generator needs all positions in one list on the driver (tens
    of bytes a row), so this is for sets that were split so before, of some
    10 million rows at most; ``split_hashed`` is the way beyond.
    """
    check_settings(val_size)
    n = examples.count()
    k = max(1, int(n * val_size))
    if k >= n:
        raise ValueError("no example would be left to train on")
    order_ = list(range(n))
    random.Random(seed).shuffle(order_)
    held = examples.sparkSession.createDataFrame([(i, True) for i in order_[:k]], "position long, held boolean")
    return positions(examples, order).join(held, "position", "left").withColumn("split", F.when(F.col("held"), "validation").otherwise("train")).drop("position", "held")


def split_hashed(examples: DataFrame, key: Column, val_size: float = 0.02, seed: int = 42) -> DataFrame:
    """Adds ``split`` by a digest of the key: no shuffle and no driver, the share is met on average."""
    bound = f"{int(val_size * 0xFFFFFFFF):08x}"
    return examples.withColumn("split", F.when(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key).cast("binary")), 1, 8) < bound, "validation").otherwise("train"))
