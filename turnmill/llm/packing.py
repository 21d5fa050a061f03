"""Problem 8: texts into sequences of fixed capacity."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm.tokens import tokenizer
from turnmill.session import cut, ship, table

#: Capacity in tokens, and the number of length classes; the last class holds all shorter texts.
CAPACITY, CLASSES = 2048, 16
#: Share of a full bin's leftover space that a text must fill to go there instead of into a bin of its class.
SNUG = 0.9
#: Full bins of a worker whose leftover space is still on offer; beyond it those with the least space are closed.
OFFERED = 4096
#: Bins that a task of the second round fills at least (or all there are).
SECOND_BINS = 1000
SCHEMA = "bin string, class int, counted boolean, doc_id long, piece int, tokens int, at int"
_COLUMNS = [c.split()[0] for c in SCHEMA.split(", ")]


class Harmonic:
    """Bins of one worker: class k has lengths in (C / (k + 1), C / k] and k texts a bin.

    What a full bin has left over takes a later text that fits it snugly, or
    any text of the last class, whose texts have no fixed number and else
    fill a bin of their own, one after the other. Rows come out when their
    bin has its number; those of unfinished bins, fewer than k for each
    class, at the end and without a bin.
    """

    def __init__(self, capacity: int, classes: int, tag: str, snug: float = SNUG, offered: int = OFFERED) -> None:
        self.c, self.k, self.tag, self.snug, self.offered = capacity, classes, tag, snug, offered
        #: By class: rows (place, ...) so far and tokens used.
        self.open: dict[int, tuple[list, int]] = {}
        self.room: list[tuple[int, str]] = []
        self.made = 0

    def _close(self, rows: list, used: int) -> list[tuple]:
        self.made += 1
        name = f"{self.tag}-{self.made}"
        if used < self.c:
            insort(self.room, (self.c - used, name))
            if len(self.room) > self.offered:
                self.room.pop(0)
        return [(name, *r) for r in rows]

    def put(self, doc: int, piece: int, tokens: int) -> list[tuple]:
        """Rows (bin, class, counted, doc, piece, tokens, at) that are placed for good by a text of at most the capacity."""
        k = min(self.k, self.c // max(tokens, 1))
        if k > 1:
            i = bisect_left(self.room, (tokens, ""))
            if i < len(self.room) and (k == self.k or tokens >= self.snug * self.room[i][0]):
                left, name = self.room.pop(i)
                if left > tokens:
                    insort(self.room, (left - tokens, name))
                return [(name, k, False, doc, piece, tokens, self.c - left)]
        rows, used = self.open.pop(k, ([], 0))
        out = []
        if used + tokens > self.c:
            out, rows, used = self._close(rows, used), [], 0
        rows.append((k, k < self.k, doc, piece, tokens, used))
        if k < self.k and len(rows) == k:
            return out + self._close(rows, used + tokens)
        self.open[k] = (rows, used + tokens)
        return out

    def rest(self, last: bool) -> list[tuple]:
        """Rows of the unfinished bins: without a bin, or as they are if this round is the ``last``."""
        held, self.open = self.open, {}
        if last:
            return [r for rows, used in held.values() for r in self._close(rows, used)]
        return [(None, *r) for rows, _ in held.values() for r in rows]


def _filled(pieces: DataFrame, capacity: int, classes: int, tag: str, last: bool, sized) -> DataFrame:
    """Each task's own bins; ``sized`` gives (doc, piece, tokens) of a batch."""

    def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        context = TaskContext.get()
        own = Harmonic(capacity, classes, f"{tag}{context.partitionId() if context else 0}")
        for pdf in batches:
            yield pd.DataFrame([r for x in sized(pdf) for r in own.put(*x)], columns=_COLUMNS)
        yield pd.DataFrame(own.rest(last), columns=_COLUMNS)

    return pieces.mapInPandas(fill, SCHEMA)


def pack(docs: DataFrame, capacity: int = CAPACITY, classes: int = CLASSES, path: str | None = None, second_bins: int = SECOND_BINS) -> DataFrame:
    """(bin, class, counted, doc_id, piece, tokens, at): every text's place in a bin.

    ``docs``: doc_id, text. No text is split that fits; one that exceeds the
    capacity gives full pieces and a rest. Each task fills its own bins by
    fixed numbers (``counted``), without a shuffle. What it leaves in
    unfinished bins, fewer than k texts for each class, is shuffled to few
    tasks and filled in a second round, so unfinished bins do not add up with
    the number of tasks. Space left over in a full bin is offered inside its
    task only. Null texts and those without tokens need no place
    and are left out; repeated rows are packed each; an empty table gives an
    empty result.
    """
    ship(docs.sparkSession)

    def counted(pdf: pd.DataFrame) -> Iterator[tuple[int, int, int]]:
        tok = tokenizer(path)
        for doc, text in zip(pdf["doc_id"], pdf["text"]):
            n = tok.count(text)
            for piece, start in enumerate(range(0, n, capacity)):
                yield doc, piece, min(capacity, n - start)

    known = lambda pdf: zip(pdf["doc_id"], pdf["piece"], pdf["tokens"])
    first = cut(_filled(docs.where("doc_id is not null and text is not null").select("doc_id", "text"), capacity, classes, "a", False, counted))
    rest = first.where("bin is null").select("doc_id", "piece", "tokens")
    tasks = max(1, (rest.agg(F.sum("tokens")).first()[0] or 0) // (second_bins * capacity))
    return first.where("bin is not null").unionByName(_filled(rest.repartition(int(tasks)), capacity, classes, "b", True, known))


def packed(spark: SparkSession, root: str) -> DataFrame:
    """All documents in sequences of CAPACITY tokens."""
    return pack(table(spark, root, "documents"))


def fill_report(spark: SparkSession, root: str) -> DataFrame:
    """(bins, tokens, fill, counted): bins used, tokens placed, their share of the capacity, and the share of tokens that went by a class's fixed number."""
    got = packed(spark, root).agg(F.countDistinct("bin").alias("bins"), F.coalesce(F.sum("tokens"), F.lit(0)).alias("tokens"), F.sum(F.when(F.col("counted"), F.col("tokens"))).alias("c"))
    some = lambda c: F.when(F.col("bins") > 0, c)
    return got.select("bins", "tokens", some(F.col("tokens") / (F.col("bins") * CAPACITY)).alias("fill"), some(F.coalesce("c", F.lit(0)) / F.col("tokens")).alias("counted"))


def faults(spark: SparkSession, root: str) -> DataFrame:
    """One row that counts what must not be: bins over the capacity, texts that overlap or leave a gap in a bin, texts split though they fit, pieces placed not once; and the texts placed."""
    placed = cut(packed(spark, root))
    bins = placed.groupBy("bin").agg(F.sum("tokens").alias("tokens"), F.max(F.col("at") + F.col("tokens")).alias("end"), F.countDistinct("at").alias("places"), F.count("*").alias("n"))
    docs = placed.groupBy("doc_id").agg(F.count("*").alias("n"), F.countDistinct("piece").alias("pieces"), F.sum("tokens").alias("tokens"), F.max("piece").alias("last"))
    of_bins = bins.agg(F.count_if(F.col("tokens") > CAPACITY).alias("bins_over"), F.count_if((F.col("end") != F.col("tokens")) | (F.col("places") != F.col("n"))).alias("bins_with_gaps"))
    split = (F.col("n") > 1) & (F.col("tokens") <= CAPACITY)
    odd = (F.col("n") != F.col("pieces")) | (F.col("n") != F.col("last") + 1) | (F.col("n") != F.ceil(F.col("tokens") / CAPACITY))
    of_docs = docs.agg(F.count_if(split).alias("split_though_fitting"), F.count_if(odd).alias("not_placed_once"), F.count("*").alias("texts_placed"))
    return of_bins.crossJoin(of_docs)  # one row each
