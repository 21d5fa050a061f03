"""Problem 1: the same or nearly the same record in several splits."""

from __future__ import annotations

from bisect import bisect_left
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.functions import text as X
from turnmill.session import cut, ship, table

#: Words in a gram, grams in a window at least. A pair within one edit for every ten words always
#: shares six words in a row (12 words or more), hence a whole window and its least gram.
GRAM, WINDOW, MIN_WORDS = 5, 2, 12
#: Base of the rolling hash.
BASE = 0x9E3779B97F4A7C15


def contents(messages):
    """Both contents in order, as one text; null messages give an empty text."""
    return F.concat_ws("\n", F.transform(messages, lambda m: F.coalesce(m["content"], F.lit(""))))


def records(spark: SparkSession, root: str) -> DataFrame:
    """(pair_id, split, source, words) of records with at least MIN_WORDS words, joined by single blanks."""
    pairs = table(spark, root, "reply_pair").where("split in ('train', 'validation', 'test')").select("pair_id", "split", "source", X.word_line(contents(F.col("messages"))).alias("words"))
    return pairs.where(F.size(F.split("words", " ")) >= MIN_WORDS)


@lru_cache(None)
def window(n: int) -> int:
    """Grams in a window of a text of n words: as many as any partner within the limit must share in a row.

    The longer text of L words keeps L - k of them in k + 1 stretches at
    most, k being the edits allowed; the longer may be any up to n * 10 / 9.
    A gram that is least in a large window is so in each smaller one inside
    it, so partners with windows of unlike sizes still meet.
    """
    runs = (-(-(m - m // 10) // (m // 10 + 1)) for m in range(n, n + n // 9 + 1))
    return max(WINDOW, min(runs) - GRAM + 1)


def fingerprints(lines: pd.Series) -> pd.DataFrame:
    """Winnowed grams of each line of words: the least rolling hash of every window, the first of equals.

    (hs, ats, win): hashes, their positions in order, grams in a window. All
    lines are rolled and windowed at once, by size of window.
    """
    split = [x.split(" ") for x in lines]
    sizes = np.array([len(x) for x in split], dtype=np.int64)
    flat = pd.util.hash_array(np.array([w for x in split for w in x], dtype=object), categorize=True)
    grams = np.maximum(sizes - GRAM + 1, 0)
    wins = np.minimum([window(int(n)) for n in sizes], np.maximum(grams, 1)).astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        rolled = np.zeros(len(flat), dtype=np.uint64)
        for i in range(GRAM):
            rolled[: len(flat) - GRAM + 1] = rolled[: len(flat) - GRAM + 1] * np.uint64(BASE) + flat[i : len(flat) - GRAM + 1 + i]
        rolled ^= rolled >> np.uint64(31)
    line = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(flat)) - starts[line]
    keep = np.zeros(len(flat), dtype=bool)
    for w in np.unique(wins):
        # Windows that begin here and lie within their line.
        at = np.flatnonzero((wins[line] == w) & (place + w <= grams[line]))
        if len(at):
            best, least = at.copy(), rolled[at]
            for i in range(1, w):
                less = rolled[at + i] < least
                best[less], least[less] = at[less] + i, rolled[at + i][less]
            keep[best] = True
    got = np.flatnonzero(keep)
    cuts = np.cumsum(np.bincount(line[got], minlength=len(sizes)))[:-1] if len(sizes) else []
    return pd.DataFrame({"hs": np.split(rolled[got].view(np.int64), cuts) if len(sizes) else [], "ats": np.split(place[got].astype(np.int32), cuts) if len(sizes) else [], "win": wins.astype(np.int32)})


@F.pandas_udf(T.StructType([T.StructField("hs", T.ArrayType(T.LongType())), T.StructField("ats", T.ArrayType(T.IntegerType())), T.StructField("win", T.IntegerType())]))
def _fingerprints(lines: pd.Series) -> pd.DataFrame:
    return fingerprints(lines)


def with_fingerprints(df: DataFrame) -> DataFrame:
    """Adds ``seeds``: arrays of rolling hashes and positions, the least of each window of ``seeds.win`` grams."""
    ship(df.sparkSession)
    return df.withColumn("seeds", _fingerprints("words"))


def word_distance(a, b, limit: int) -> int:
    """Insertions, deletions and replacements of words, or -1 beyond ``limit``.

    Furthest-reaching diagonals: each round extends every diagonal along
    equal words, so texts that nearly agree cost about their length.
    """
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return -1
    reach = {1: -1}
    for d in range(limit + 1):
        now = {}
        for k in range(-d, d + 1):
            if d == 0:
                i = 0
            else:
                i = max(reach.get(k - 1, -2), reach.get(k, -2) + 1, reach.get(k + 1, -2) + 1)
                # from diagonal k - 1: a word of b inserted; from k: replaced; from k + 1: a word of a deleted
            if i < 0 or i > n or i + k > m:
                i = min(i, n, m - k)
                if i < 0 or i + k < 0:
                    continue
            if i + k < 0:
                continue
            while i < n and i + k < m and a[i] == b[i + k]:
                i += 1
            now[k] = i
            if k == m - n and i >= n:
                return d
        reach = now
    return -1


def chain(seeds: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The longest chain of collinear seeds: both places grow (longest increasing subsequence)."""
    ends: list[tuple[int, int]] = []  # (place in b, index) that ends the best chain of each length
    back, order = [], sorted(set(seeds), key=lambda s: (s[0], -s[1]))
    for i, (_, y) in enumerate(order):
        at = bisect_left(ends, (y, -1))
        back.append(ends[at - 1][1] if at else -1)
        ends[at : at + 1] = [(y, i)]
    out, i = [], ends[-1][1] if ends else -1
    while i >= 0:
        out.append(order[i])
        i = back[i]
    return out[::-1]


def extended(a: list[str], b: list[str], seeds: list[tuple[int, int]], limit: int) -> int:
    """Edits between two word lists, or -1 beyond ``limit``: chained seeds are extended to a whole alignment.

    Each seed of the chain is extended over equal words to its right; what
    is left between two seeds, before the first and after the last is
    aligned by itself. That is one alignment, hence a bound from above; where
    it exceeds the limit, the lists are aligned as a whole. Words that one
    list lacks altogether are a bound from below, tested first.
    """
    one, two = set(a), set(b)
    if max(len(one - two), len(two - one)) > limit:
        return -1
    total, x, y = 0, 0, 0
    for p, q in [*chain(seeds), (len(a), len(b))]:
        if p < x or q < y:
            if p - x != q - y or p == len(a):  # inside what an earlier seed was extended over: on its diagonal, or passed by
                continue
        elif p > x or q > y:
            d = word_distance(a[x:p], b[y:q], limit - total)
            if d < 0:
                return word_distance(a, b, limit)
            total += d
            x, y = p, q
        while x < len(a) and y < len(b) and a[x] == b[y]:
            x, y = x + 1, y + 1
    if (x, y) != (len(a), len(b)):
        return word_distance(a, b, limit)
    return total


@F.pandas_udf(T.IntegerType())
def align(a: pd.Series, b: pd.Series, seeds: pd.Series, limit: pd.Series) -> pd.Series:
    """Extend chained seeds to a whole alignment: the word edits, or -1."""
    return pd.Series([extended(x.split(" "), y.split(" "), [(s["ta"], s["ea"]) for s in z], int(d)) for x, y, z, d in zip(a, b, seeds, limit)], dtype="int32")


def allowed(n, m):
    """Edits that two texts of n and m words may differ by."""
    return F.floor(F.greatest(n, m) / 10).cast("int")


def classes(recs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct word sequences and the records of each.

    (class, key, n, words, in_train, in_eval) and (key, pair_id, split, source):
    exact copies are one class, compared once whatever their number. Records
    are written once, with the digest of their words as key.
    """
    keyed = cut(recs.withColumn("key", F.unhex(F.md5(F.col("words").cast("binary")))))
    held = F.col("split") != "train"
    groups = keyed.groupBy("key").agg(F.min("pair_id").alias("class"), F.first("words").alias("words"), F.bool_or(~held).alias("in_train"), F.bool_or(held).alias("in_eval"))
    return groups.withColumn("n", F.size(F.split("words", " "))), keyed.select("key", "pair_id", "split", "source")


def class_links(groups: DataFrame) -> DataFrame:
    """(train, eval, edits, words): class pairs across the splits within the limit.

    Seeds meet on their gram, a bucket of their place and one of the text's
    length; the side of the evaluation splits is entered into the
    neighbouring buckets that an allowed shift can reach. A seed pair stays
    if the edits before and after it that lengths and places force are few
    enough, a text pair if it has as many different seeds as the limit leaves
    at least; these are chained and extended to an alignment. No
    pair within the limit is lost, and no frequent gram is dropped; a gram
    that many texts share at one place is split by skew handling.
    """
    zipped = F.arrays_zip(F.col("seeds.hs").alias("h"), F.col("seeds.ats").alias("at"))
    base = groups.select("class", "n", "in_train", "in_eval", F.col("seeds.win").alias("win"), F.explode(zipped).alias("f")).select("class", "n", "win", "in_train", "in_eval", "f.h", "f.at")
    t = base.where("in_train").select("h", F.floor(F.col("at") / 4).alias("pb"), F.floor(F.col("n") / 6).alias("nb"), F.col("class").alias("train"), F.col("n").alias("tn"), F.col("at").alias("ta"), F.col("win").alias("tw"))
    # The longer text may have up to n / 9 more words than the shorter.
    d = F.floor(F.col("n") / 9).cast("int")
    span = lambda c, w: F.explode(F.sequence(F.floor((F.col(c) - d) / w), F.floor((F.col(c) + d) / w)))
    e = base.where("in_eval").select("h", F.col("class").alias("eval"), F.col("n").alias("en"), F.col("at").alias("ea"), F.col("win").alias("ew"), span("at", 4).alias("pb")).withColumn("n", F.col("en"))
    e = e.select("h", "eval", "en", "ea", "ew", "pb", span("n", 6).alias("nb"))
    shift, more = F.col("ta") - F.col("ea"), F.col("tn") - F.col("en")
    limit = allowed(F.col("tn"), F.col("en"))
    seeds = t.join(e, ["h", "pb", "nb"]).where((F.col("train") != F.col("eval")) & (F.abs(shift) + F.abs(more - shift) <= limit))
    longer = F.greatest("tn", "en")
    # A pair's seeds are bounded by its texts, not by the data. Each edit spoils the windows that it touches; a seed is the least of as many windows as one has grams.
    chained = seeds.groupBy("train", "eval").agg(F.max("tn").alias("tn"), F.max("en").alias("en"), F.max(F.greatest("tw", "ew")).alias("w"), F.collect_list(F.struct("ta", "ea")).alias("seeds"))
    w = F.col("w")
    chained = chained.where(w * F.size(F.array_distinct("seeds.ta")) >= longer - GRAM - w + 2 - (GRAM + w - 1) * limit)
    words = groups.select("class", "words")
    pairs = chained.join(words.select(F.col("class").alias("train"), F.col("words").alias("tw")), "train").join(words.select(F.col("class").alias("eval"), F.col("words").alias("ew")), "eval")
    return pairs.withColumn("edits", align("tw", "ew", "seeds", allowed(F.col("tn"), F.col("en")))).where("edits >= 0").select("train", "eval", "edits", longer.alias("words"))


def linked_classes(groups: DataFrame) -> DataFrame:
    """(train, eval, edits, words): ``class_links`` and classes with records on both sides."""
    same = groups.where("in_train and in_eval").select(F.col("class").alias("train"), F.col("class").alias("eval"), F.lit(0).alias("edits"), F.col("n").alias("words"))
    return class_links(groups).unionByName(same)


def _prepared(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    groups, members = classes(records(spark, root))
    groups = cut(with_fingerprints(groups))
    return groups, members.join(groups.select("key", "class"), "key").select("class", "pair_id", "split", "source")


def found(spark: SparkSession, root: str) -> DataFrame:
    """(pair_id_a, pair_id_b), the smaller id first (see TESTDATA.md).

    Null or blank messages have too few words; records outside the three
    splits are left out; empty tables give an empty result.
    """
    groups, ids = _prepared(spark, root)
    train = ids.where("split = 'train'").select(F.col("class").alias("train"), F.col("pair_id").alias("train_id"))
    held = ids.where("split <> 'train'").select(F.col("class").alias("eval"), F.col("pair_id").alias("eval_id"))
    r = linked_classes(groups).join(train, "train").join(held, "eval")
    return r.select(F.least("train_id", "eval_id").alias("pair_id_a"), F.greatest("train_id", "eval_id").alias("pair_id_b")).distinct()


def report(spark: SparkSession, root: str) -> DataFrame:
    """One row for each held-out record with an overlap: (eval_id, split, source, links, coverage).

    ``links`` is the number of training records that overlap; coverage the
    share of words of the longer text that stay as they are in the closest
    of them. Made from counts for each class: copies are never paired. An id
    names one record; repeated rows of it count once.
    """
    groups, ids = _prepared(spark, root)
    copies = ids.where("split = 'train'").select("class", "pair_id").distinct().groupBy(F.col("class").alias("train")).agg(F.count("*").alias("k"))
    per = linked_classes(groups).join(copies, "train").groupBy(F.col("eval").alias("class")).agg(F.sum("k").alias("links"), F.max(1 - F.col("edits") / F.col("words")).alias("coverage"))
    return ids.where("split <> 'train'").distinct().join(per, "class").select(F.col("pair_id").alias("eval_id"), "split", "source", "links", "coverage")


def by_source(spark: SparkSession, root: str) -> DataFrame:
    """Overlapping records for each split and source, with their links and mean coverage (to six places)."""
    return report(spark, root).groupBy("split", "source").agg(F.count("*").alias("records"), F.sum("links").alias("links"), F.round(F.avg("coverage"), 6).alias("coverage"))
