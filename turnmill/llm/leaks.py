"""Problem 9: passages of test items inside the corpus."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.session import ship, table

#: Consecutive words that make a leak.
MIN_RUN = 12
#: Test words in one automaton. A larger test set is worked off in blocks of whole
#: items, each broadcast by itself, so what is sent to a worker has a fixed bound.
BLOCK_WORDS = 400_000
JUDGED = pa.schema([("doc_id", pa.int64()), ("words", pa.int32()), ("covered", pa.int32()), ("verdict", pa.string()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("stop", pa.int32())]))), ("text", pa.string())])


def normal_word(w: str) -> str:
    """Letters and digits of a lower-case word."""
    return w if w.isalnum() else "".join(c for c in w if c.isalnum())


def split_words(text: str) -> list[str]:
    """Lower case, split at white space, only letters and digits, no empty words."""
    return [x for x in map(normal_word, text.lower().split()) if x]


class Automaton:
    """Generalised suffix automaton over the words of many short texts.

    ``sources[s]`` holds the texts (item, part) whose run of words ends in
    state s; link ancestors hold those of their descendants too, so the
    items that contain a matched run are read off one state.
    """

    def __init__(self) -> None:
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ids: dict[str, int] = {}
        self._ends: list[set[int]] = [set()]

    def add(self, words: list[str], item: int) -> None:
        last = 0
        for w in words:
            last = self._extend(last, self.ids.setdefault(w, len(self.ids)))
            self._ends[last].add(item)

    def _state(self, length: int, link: int, step: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.step.append(step)
        self._ends.append(set())
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        twin = self._state(self.length[p] + 1, self.link[q], dict(self.step[q]))
        self.link[q] = twin
        while p >= 0 and self.step[p].get(c) == q:
            self.step[p][c] = twin
            p = self.link[p]
        return twin

    def _extend(self, last: int, c: int) -> int:
        q = self.step[last].get(c)
        if q is not None:  # the run is known from an earlier text
            return q if self.length[q] == self.length[last] + 1 else self._split(last, c, q)
        new = self._state(self.length[last] + 1, 0, {})
        p = last
        while p >= 0 and c not in self.step[p]:
            self.step[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.step[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, c, q)
        return new

    def finish(self) -> Automaton:
        """Hand the items of each state on to its link ancestors that long runs can match."""
        for s in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[s]
            if self.length[up] >= MIN_RUN:
                self._ends[up] |= self._ends[s]
        self.sources = [tuple(sorted(x)) if n >= MIN_RUN else () for x, n in zip(self._ends, self.length)]
        self._ends = []
        return self

    def spans(self, words: list[str], least: int = MIN_RUN) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) at each word where the longest match has ``least`` words or more."""
        step, link, length = self.step, self.link, self.length
        get = self.ids.get
        s = n = 0
        for i, w in enumerate(words):
            c = get(w)
            if c is None:
                s = n = 0
                continue
            t = step[s].get(c)
            if t is None:
                while s >= 0 and c not in step[s]:
                    s = link[s]
                if s < 0:
                    s = n = 0
                    continue
                n = length[s] + 1
                s = step[s][c]
            else:
                s = t
                n += 1
            if n >= least:
                yield i, n, s

    def leaks(self, words: list[str], least: int = MIN_RUN) -> dict[int, list[int]]:
        """For each leaked item its longest run and its words covered in the text."""
        got: dict[int, list[int]] = {}
        until: dict[int, int] = {}
        for i, n, s in self.spans(words, least):
            # Items of the state have the whole run; shorter suffixes, down to ``least`` words, may be in more items.
            seen: set[int] = set()
            while True:
                for item in self.sources[s]:
                    if item not in seen:
                        seen.add(item)
                        best = got.setdefault(item, [0, 0])
                        best[0] = max(best[0], n)
                        best[1] += i + 1 - max(until.get(item, 0), i + 1 - n)
                        until[item] = i + 1
                s = self.link[s]
                if s < 0 or self.length[s] < least:
                    break
                n = self.length[s]
        return got


def blocks(items: pd.DataFrame, most: int = BLOCK_WORDS) -> Iterator[Automaton]:
    """Automata over whole items, each of at most ``most`` words (or one item)."""
    auto, size = Automaton(), 0
    for item, prompt, reference in items.itertuples(index=False):
        parts = [split_words(t) for t in (prompt, reference) if t]
        n = sum(map(len, parts))
        if size and size + n > most:
            yield auto.finish()
            auto, size = Automaton(), 0
        for words in parts:
            auto.add(words, int(item))
        size += n
    if size:
        yield auto.finish()


def leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, longest, covered): items with MIN_RUN consecutive words in a document.

    ``docs``: doc_id, text; ``items``: item_id, prompt, reference. The items
    are the stated query set; every document is streamed against them, in
    blocks of items of bounded size. ``longest`` is in words, ``covered``
    counts the document's words inside such runs. Null texts have no words;
    a null id is left out; an empty table gives an empty result.
    """
    return _scanned(docs.where("doc_id is not null and text is not null").select("doc_id", "text"), items, lambda auto, words: [(item, a, b) for item, (a, b) in auto.leaks(words).items()], "doc_id long, item_id long, longest long, covered long")


def _scanned(docs: DataFrame, items: DataFrame, rows_of: Callable[[Automaton, list[str]], list[tuple]], schema: str) -> DataFrame:
    """``rows_of`` each document's words and each block of items, after the first column of (key, text)."""
    spark = docs.sparkSession
    ship(spark)
    names = [x.split()[0] for x in schema.split(", ")]
    # Read by one iterator, so that the driver holds one block of items at a time.
    rows = items.where("item_id is not null").select("item_id", "prompt", "reference").toLocalIterator(prefetchPartitions=True)
    frames, batch, size = [], [], 0

    def scan(chunk: list) -> DataFrame:
        sent = [spark.sparkContext.broadcast(a) for a in blocks(pd.DataFrame(chunk, columns=["item_id", "prompt", "reference"]))]

        def stream(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            autos = [b.value for b in sent]
            for pdf in batches:
                out = []
                for key, text in pdf.itertuples(index=False):
                    words = split_words(text)
                    if len(words) < MIN_RUN:
                        continue
                    for auto in autos:
                        out += [(key, *x) for x in rows_of(auto, words)]
                yield pd.DataFrame(out, columns=names)

        return docs.mapInPandas(stream, schema)

    for r in rows:
        batch.append(tuple(r))
        size += sum(len(x.split()) for x in (r["prompt"], r["reference"]) if x)
        if size >= BLOCK_WORDS:
            frames.append(scan(batch))
            batch, size = [], 0
    if batch or not frames:
        frames.append(scan(batch))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def union(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans (start, stop) in order, those that meet or overlap made one."""
    out: list[tuple[int, int]] = []
    for a, z in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], z))
        else:
            out.append((a, z))
    return out


def _all(spark: SparkSession, root: str) -> DataFrame:
    return leaked(table(spark, root, "documents"), table(spark, root, "eval_item"))


def found(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, item_id), each once (see TESTDATA.md)."""
    return _all(spark, root).select("doc_id", "item_id").distinct()


def by_item(spark: SparkSession, root: str) -> DataFrame:
    """Documents for each leaked item, and the longest run found."""
    return _all(spark, root).groupBy("item_id").agg(F.countDistinct("doc_id").alias("documents"), F.max("longest").alias("longest"))


def _runs(auto: Automaton, words: list[str]) -> list[tuple]:
    got = union((i + 1 - n, i + 1) for i, n, _ in auto.spans(words))
    return [([a for a, _ in got], [z for _, z in got])] if got else []


def places(text: str) -> list[tuple[int, int]]:
    """Where each of ``split_words`` stands in the text: (start, stop) in characters."""
    return [m.span() for m in re.finditer(r"\S+", text) if normal_word(m.group().lower())]


def without(text: str, spans: list[tuple[int, int]]) -> str:
    """The text without the spans (start, stop); what is around them stays as it is."""
    at, kept = 0, []
    for a, z in spans:
        kept.append(text[at:a])
        at = z
    return "".join([*kept, text[at:]])


def judged(docs: DataFrame, items: DataFrame, max_share: float = 0.5) -> DataFrame:
    """(doc_id, words, covered, verdict, spans, text): every document with its leaked spans removed.

    ``spans`` are the leaked runs of all items and blocks of items, united:
    (start, stop) in characters of the document. ``covered`` counts the words
    inside them, ``words`` all words, both as ``split_words`` has them.
    ``verdict`` is "keep" (no leak, the text as it was), "cut" (the text
    without the spans) or, where more than ``max_share`` of the words are
    covered, "drop" (no text). Spans go by the digest of the text, so ids
    that are null or repeated do no harm; a null text is kept as it is.
    """
    ship(docs.sparkSession)
    docs = docs.select("doc_id", "text").withColumn("key", F.sha2(F.col("text"), 256))
    spans = _scanned(docs.where("text is not null").select("key", "text"), items, _runs, "key string, starts array<int>, stops array<int>")
    spans = spans.groupBy("key").agg(F.flatten(F.collect_set(F.arrays_zip("starts", "stops"))).alias("runs"))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                text, n, covered, verdict, cuts = r["text"], len(split_words(r["text"] or "")), 0, "keep", []
                if r["runs"]:
                    at, runs = places(text), union((x["starts"], x["stops"]) for x in r["runs"])
                    covered = sum(z - a for a, z in runs)
                    cuts = [(at[a][0], at[z - 1][1]) for a, z in runs]
                    verdict, text = ("drop", None) if covered > max_share * n else ("cut", without(text, cuts))
                out.append({"doc_id": r["doc_id"], "words": n, "covered": covered, "verdict": verdict, "spans": [{"start": a, "stop": z} for a, z in cuts], "text": text})
            yield pa.RecordBatch.from_pylist(out, schema=JUDGED)

    return docs.join(spans, "key", "left").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "runs").mapInArrow(judge, "doc_id long, words int, covered int, verdict string, spans array<struct<start:int,stop:int>>, text string")


def cleaned(spark: SparkSession, root: str, max_share: float = 0.5) -> DataFrame:
    """``judged`` over the documents: leaked spans are cut out, a document leaked for more than ``max_share`` goes."""
    return judged(table(spark, root, "documents"), table(spark, root, "eval_item"), max_share)
