"""JSON-lines files: strict reader, folder sink and exact single-file sink."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from turnmill.functions import text as X
from turnmill.functions.jsonl import check_line
from turnmill.plans.extract import messages_of
from turnmill.session import cut


def checked(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``problem`` (null if valid) and ``messages`` to non-blank lines."""
    kept = lines.where(X.strip(F.col(column)) != "")
    c = kept.withColumn("_c", check_line(F.col(column)))
    return c.select(*kept.columns, F.col("_c.problem").alias("problem"), F.when(F.col("_c.problem").isNull(), messages_of(F.col("_c.user"), F.col("_c.assistant"))).alias("messages"))


def load_strict(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, messages) of one file; the first bad line is an error with its number, as is an empty file.

    Blank lines are skipped but numbered. The file is read and validated
    once, block by block; a block's lines keep their order, and the counts of
    the blocks before are added, so no task sees more than its block.
    """
    rows = spark.read.text(path).select("value", F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"))
    tested = rows.withColumn("c", check_line(F.col("value")))
    blank = X.strip(F.col("value")) == ""
    messages = F.when(F.col("c.problem").isNull() & ~blank, messages_of(F.col("c.user"), F.col("c.assistant")))
    tested = cut(tested.select("block", "n", F.when(~blank, F.col("c.problem")).alias("problem"), messages.alias("messages")))
    blocks = tested.groupBy("block").agg(F.min("n").alias("first"), F.count("*").alias("k"))
    before = F.coalesce(F.sum("k").over(Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    # One row for each block of the file. Ids of one block are consecutive, as its lines are read in one go.
    numbered = tested.join(blocks.select("block", "first", before.alias("before")), "block").withColumn("line_no", F.col("before") + F.col("n") - F.col("first") + 1)
    bad = numbered.where("problem is not null").agg(F.min(F.struct("line_no", "problem")).alias("b")).first()["b"]
    if bad:
        raise ValueError(f"line {bad['line_no']}: {bad['problem']}")
    good = numbered.where("messages is not null").select("line_no", "messages")
    if good.isEmpty():
        raise ValueError("no examples")
    return good


def write_folder(records: DataFrame, path: str) -> int:
    """The lines in order, as text files of a folder: ranges are sorted in parallel. Returns their number."""
    lines = records.select(F.col("line").alias("value"))
    lines.orderBy("value").write.mode("overwrite").text(path)
    return lines.sparkSession.read.text(path).count()


def write_file(records: DataFrame, path: str) -> int:
    """The lines in order in exactly one local file, streamed range by range; returns their number."""
    p = Path(path)
    p.parent.mkdir(parents=True, exist_ok=True)
    n = 0
    with p.open("w", encoding="utf-8", newline="\n") as f:
        for r in records.select("line").orderBy("line").toLocalIterator(prefetchPartitions=True):
            f.write(r["line"] + "\n")
            n += 1
    return n
