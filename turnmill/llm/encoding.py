"""Problem 7: text that was read with a wrong character encoding."""

from __future__ import annotations

import math
import re
from array import array
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import cached_property, lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions import body as B
from turnmill.session import cut, ship, table

# One-byte encodings a text may have been read in by mistake, and encodings it may really be in.
READ_AS = ("cp1252", "latin-1", "mac_roman", "cp437", "cp850", "cp1251", "cp1250", "iso8859_15", "koi8_r")
WIDE_READ_AS = ("cp932", "gbk", "euc_jp")
REALLY = ("cp1252", "mac_roman", "cp1251", "cp850", "koi8_r", "cp1250", "cp932", "euc_jp")

#: Hash buckets of trigrams, bigrams and characters: the bound on what the model takes on driver and workers.
BUCKETS = (1 << 18, 1 << 16, 1 << 14)
#: Parts of the rows, by hash; each is judged by a model of the others.
TENTHS = 10
#: Margins of which the one with the fewest errors is taken.
MARGINS = np.arange(4.0, 20.5, 0.5)
#: Characters of windows that are judged at a time, and of texts that are scored at a time: what they take in memory, not what is left out.
JUDGED_AT_ONCE, SCORED_AT_ONCE = 1 << 12, 1 << 17
#: Negative log-likelihood of a character from which a window is looked at; and while the clean windows are chosen, when
#: a damaged text that many rows share is itself in the counts and surprises less.
SURPRISE, WARY = 5.0, 3.0
#: Windows: stretches of non-ASCII characters, at most two ASCII characters apart, with two characters on either side.
WINDOW = r"(?s).{0,2}[^\x00-\x7F](?:.{0,2}[^\x00-\x7F])*.{0,2}"
_WINDOW = re.compile(WINDOW)
_RUN = re.compile(r"[^\x00-\x7F]+")


@lru_cache(None)
def _table(name: str) -> dict[str, int]:
    """Character to byte; bytes that the encoding leaves open stand for themselves."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(name)] = b
        except UnicodeDecodeError:
            out[chr(b)] = b
    return out


def _back(text: str, name: str) -> bytes | None:
    """The bytes that gave ``text`` when read as ``name``, if any did."""
    if name in WIDE_READ_AS:
        try:
            return text.encode(name)
        except UnicodeEncodeError:
            return None
    t = _table(name)
    try:
        return bytes(t[c] for c in text)
    except KeyError:
        return None


def _read(raw: bytes, name: str) -> str | None:
    try:
        return raw.decode(name)
    except UnicodeDecodeError:
        return None


@lru_cache(200_000)
def candidates(text: str) -> tuple[tuple[str, str], ...]:
    """(chain, restored) for every encode-decode chain that gives another text."""
    out: dict[str, str] = {}
    known = {}
    for w in (*READ_AS, *WIDE_READ_AS):
        raw = _back(text, w)
        if raw is None:
            continue
        known[w] = raw
        s = _read(raw, "utf-8")
        if s is not None and s != text:
            out.setdefault(s, f"utf-8 as {w}")
    for s, chain in list(out.items()):  # read wrongly twice (or three times)
        for _ in range(2):
            for w in READ_AS:
                raw = _back(s, w)
                t = raw and _read(raw, "utf-8")
                if t and t != s and t != text:
                    chain = f"{chain}, utf-8 as {w}"
                    out.setdefault(t, chain)
                    s = t
                    break
            else:
                break
    for w, raw in known.items():
        if w in READ_AS:
            for r in REALLY:
                s = r != w and _read(raw, r)
                if s and s != text:
                    out.setdefault(s, f"{r} as {w}")
    return tuple((c, s) for s, c in out.items())


def redecodable(text: str) -> bool:
    """Whether some stretch is valid UTF-8 once more, or shows marks of damage; such rows train no model."""
    if "�" in text or any("\x80" <= c <= "\x9f" for c in text):
        return True
    return any(len(r) > 1 and c.startswith("utf-8") for r in _RUN.findall(text) for c, _ in candidates(r))


@lru_cache(1 << 17)
def _hash(s: str, order: int) -> int:
    h = 0
    for c in s:
        h = (h * 1_000_003 + ord(c)) & 0xFFFFFFFFFFFF
    return (h ^ (h >> 21)) % BUCKETS[order]


def portions(items: Iterable, size: Callable, enough: int) -> Iterator[list]:
    """The items in lists, each closed as soon as its sizes come to ``enough``."""
    out, total = [], 0
    for x in items:
        out.append(x)
        total += size(x)
        if total >= enough:
            yield out
            out, total = [], 0
    if out:
        yield out


def grams(window: str) -> Iterator[tuple[int, int]]:
    """(order, bucket) of trigrams, bigrams and characters of a window."""
    t = "\x02\x02" + window.lower()
    for i in range(2, len(t)):
        yield 0, _hash(t[i - 2 : i + 1], 0)
        yield 1, _hash(t[i - 1 : i + 1], 1)
        yield 2, _hash(t[i], 2)


class Model:
    """Interpolated character trigrams around non-ASCII stretches, in hashed counts."""

    def __init__(self, counts: tuple[np.ndarray, np.ndarray, np.ndarray]) -> None:
        self.c3, self.c2, self.c1 = (array("d", c.tobytes()) for c in counts)  # read one by one, faster than numpy's
        self.n = float(counts[2].sum())
        self.margin, self.surprise = 8.0, SURPRISE

    @cached_property
    def known(self) -> dict[str, float]:
        return {}

    @cached_property
    def known_least(self) -> dict[str, float]:
        return {}

    def learn(self, texts: Iterable[str]) -> None:
        """Keep the scores of these texts only, all worked out at once as ``parts`` does it one by one."""
        self.known.clear()
        self.known_least.clear()
        for some in portions((t for t in dict.fromkeys(texts) if t and len(t) == len(t.lower())), len, SCORED_AT_ONCE):  # the few others are left to ``parts``
            least, total = self.scores(some)
            self.known_least.update(zip(some, least.tolist()))
            self.known.update(zip(some, total.tolist()))

    def scores(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Of each text: the least of its ``parts`` at a non-ASCII character or up to two after it, and their sum."""
        written, c = (np.frombuffer("".join(f"\x02\x02{t}" for t in x).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) for x in (texts, [t.lower() for t in texts]))
        begins = np.cumsum([0] + [len(t) for t in texts[:-1]])
        at = np.ones(len(c), bool)
        pads = begins + 2 * np.arange(len(texts))
        at[pads] = at[pads + 1] = False
        at = np.flatnonzero(at)
        two = np.zeros_like(c)
        two[1:] = (c[:-1] * np.uint64(1_000_003) + c[1:]) & np.uint64(0xFFFFFFFFFFFF)
        three = np.zeros_like(c)
        three[1:] = (two[:-1] * np.uint64(1_000_003) + c[1:]) & np.uint64(0xFFFFFFFFFFFF)
        three, two, one = (((h ^ (h >> np.uint64(21))) % np.uint64(b)).astype(np.intp) for h, b in zip((three, two, c), BUCKETS))
        c3, c2, c1 = map(np.frombuffer, (self.c3, self.c2, self.c1))
        first, n = c[at - 1] == 2, self.n
        p = 0.02 * (c1[one[at]] + 0.05) / (n + 0.05 * BUCKETS[2])
        more = 0.18 * c2[two[at]] / np.maximum(1.0, np.where(first, n / 4, c1[one[at - 1]]))
        more += 0.8 * np.minimum(1.0, c3[three[at]] / np.maximum(1.0, np.where(first, n / 4, c2[two[at - 1]])))
        x = np.log(p + np.where(c2[two[at]] > 0, more, 0.0))
        wide = written > 127
        return np.minimum.reduceat(np.where(wide[at] | wide[at - 1] | wide[at - 2], x, np.inf), begins), np.add.reduceat(x, begins)

    def parts(self, window: str) -> list[float]:
        """Log-likelihood of each character of the window."""
        t = "\x02\x02" + window.lower()
        c3, c2, c1, n = self.c3, self.c2, self.c1, self.n
        out = []
        for i in range(2, len(t)):
            p = 0.02 * (c1[_hash(t[i], 2)] + 0.05) / (n + 0.05 * BUCKETS[2])
            two = c2[_hash(t[i - 1 : i + 1], 1)]
            if two:
                first = t[i - 1] == "\x02"
                p += 0.18 * two / max(1.0, n / 4 if first else c1[_hash(t[i - 1], 2)])
                p += 0.8 * min(1.0, c3[_hash(t[i - 2 : i + 1], 0)] / max(1.0, n / 4 if first else c2[_hash(t[i - 2 : i], 1)]))
            out.append(math.log(p))
        return out

    def score(self, window: str) -> float:
        """Log-likelihood of the window's characters."""
        got = self.known.get(window)
        if got is None:
            if len(self.known) > 300_000:
                self.known.clear()
            got = self.known[window] = sum(self.parts(window))
        return got

    def best(self, window: str) -> tuple[float, str, str]:
        """(gain, chain, restored) of the likeliest reading; gain 0 leaves the window as it is.

        A window whose characters are all expected where they stand is not
        looked at further: no reading could gain much.
        """
        least = self.known_least.get(window)
        if least is None:
            each = self.parts(window)
            least = min(x for x, i in zip(each, range(len(each))) if not window[max(0, i - 2) : i + 1].isascii())
        if least > -self.surprise:
            return 0.0, "", window
        base = self.score(window)
        top = (0.0, "", window)
        for chain, s in candidates(window):
            g = self.score(s) - base
            if g > top[0]:
                top = (g, chain, s)
        if top[1].startswith("utf-8"):
            return top
        now, chains = window, []  # damage in part only: stretch by stretch, its head or tail may be sound
        for r in dict.fromkeys(_RUN.findall(window)):
            was = self.score(now)
            halves = [("", r, "")] + [(r[:k], r[k:], "") for k in range(1, min(len(r), 3))] + [("", r[:-k], r[-k:]) for k in range(1, min(len(r), 3))]
            g, c, s = max(((self.score(now.replace(r, a + s + z)) - was, c, a + s + z) for a, x, z in halves for c, s in candidates(x) if c.startswith("utf-8")), default=(0.0, "", r))
            if g > 0:
                now = now.replace(r, s)
                chains.append(c)
        partly = (self.score(now) - base, chains[0], now) if chains else top
        return max(partly, top)

    def repair(self, text: str) -> tuple[float, str, str]:
        """(gain, chain, restored) of a whole text.

        UTF-8 read wrongly may touch a text in part, so its windows' gains
        add up by themselves. One one-byte encoding taken for another touches
        all of a text: such a chain gains the sum over all windows, those
        that it makes less likely included.
        """
        found = [(m.group(), *self.cached(m.group())) for m in _WINDOW.finditer(text)]
        by: dict[str, float] = {}
        for _, g, chain, _ in found:
            if g > 0:
                by[chain] = by.get(chain, 0.0) + g
        top = (0.0, "", {})
        for chain, g in by.items():
            if chain.startswith("utf-8"):
                swaps = {w: s for w, _, _, s in found}
            else:
                swaps = {w: dict(candidates(w)).get(chain, w) for w, _, _, _ in found}
                g = sum(self.score(swaps[w]) - self.score(w) for w, _, _, _ in found)
            if g > top[0]:
                top = (g, chain, swaps)
        if not top[1]:
            return 0.0, "", text
        return top[0], top[1], _WINDOW.sub(lambda m: top[2][m.group()], text)

    def cached(self, window: str) -> tuple[float, str, str]:
        got = self.best_known.get(window)
        if got is None:
            if len(self.best_known) > 200_000:
                self.best_known.clear()
            got = self.best_known[window] = self.best(window)
        return got

    @cached_property
    def best_known(self) -> dict:
        return {}


def strings(spark: SparkSession, root: str) -> DataFrame:
    """(message_id, s, broken): the text, or where it is null the archived string; only those with non-ASCII characters.

    ``broken`` marks archived bytes that are not UTF-8; they are shown as the
    text that one character for each byte makes of them.
    """
    raw = F.when(F.col("text").isNull(), B.stored_bytes(F.col("attributedbody")))
    plist = F.when(F.col("text").isNull(), B.plist_string(F.col("attributedbody")))
    m = table(spark, root, "message").where(F.col("rowid").isNotNull()).select(F.col("rowid").alias("message_id"), "text", raw.alias("raw"), plist.alias("plist"))
    as_utf8 = F.col("raw").cast("string")
    broken = F.coalesce(~F.is_valid_utf8(as_utf8), F.lit(False))
    s = F.coalesce("text", F.when(broken, F.decode("raw", "ISO-8859-1")).otherwise(as_utf8), "plist")
    return m.select("message_id", s.alias("s"), broken.alias("broken")).where(F.col("s").rlike(r"[^\x00-\x7F]"))


def train(texts: DataFrame) -> Model:
    """A model of the clean records' windows, with a validated margin.

    All windows of all rows are counted, each distinct one once with its
    numbers; those that can be decoded once more or show damage are left out,
    and in a second round those that the first model would rather read otherwise.
    The margin is validated on all rows: each tenth's windows (those that the
    first round kept), as they are and read wrongly on purpose by every chain,
    are judged by a model of the other nine, and the margin is the one with
    the fewest errors, a false alarm counting as five misses. The final model
    has the counts of all rows.
    """
    spark = texts.sparkSession
    ship(spark)
    tenth = F.pmod(F.xxhash64("message_id"), F.lit(TENTHS))
    windows = cut(
        texts.where(~F.col("broken")).select(F.explode(F.regexp_extract_all("s", F.lit(WINDOW), F.lit(0))).alias("w"), tenth.alias("tenth"))
        .groupBy("w").agg(F.array(*[F.count_if(F.col("tenth") == i) for i in range(TENTHS)]).alias("n"))
        .repartition(spark.sparkContext.defaultParallelism)  # few bytes, much to do with each
    )

    def counts(first: Model | None) -> pd.DataFrame:
        sent = first and spark.sparkContext.broadcast(first)

        def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            arrays = [np.zeros((b, TENTHS)) for b in BUCKETS]
            for pdf in batches:
                for w, n in zip(pdf["w"], pdf["n"]):
                    if not redecodable(w) and not (sent and sent.value.best(w)[0] > 0.0):
                        for order, bucket in grams(w):
                            arrays[order][bucket] += n
            for order, a in enumerate(arrays):
                at = np.flatnonzero(a.any(axis=1))
                yield pd.DataFrame({"kind": order, "bucket": at} | {f"n{i}": a[at, i] for i in range(TENTHS)})

        each = [f"n{i}" for i in range(TENTHS)]
        counted = windows.mapInPandas(count, ", ".join(["kind int, bucket long", *[f"{c} double" for c in each]])).groupBy("kind", "bucket").agg(*[F.sum(c).alias(c) for c in each])
        return counted.toPandas()  # at most the sum of BUCKETS rows

    first = model_of(counts(None))
    first.surprise = WARY
    got = counts(first)
    sent = spark.sparkContext.broadcast(got)

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        models = [model_of(sent.value, i) for i in range(TENTHS)]
        for pdf in batches:
            out: Counter = Counter()
            for some in portions(zip(pdf["w"], pdf["n"]), lambda x: len(x[0]), JUDGED_AT_ONCE):
                out.update(judged(models, some))
            yield pd.DataFrame([(*key, n) for key, n in out.items()], columns=["form", "passed", "n"])

    passed = windows.mapInPandas(judge, "form string, passed int, n long").groupBy("form", "passed").agg(F.sum("n").alias("n")).collect()  # at most two rows for each margin
    model = model_of(got)
    model.margin = validated({(r["form"], r["passed"]): r["n"] for r in passed})
    return model


def model_of(counted: pd.DataFrame, without: int | None = None) -> Model:
    """The model of all tenths' counts, or of all but one."""
    each = counted[[f"n{i}" for i in range(TENTHS) if i != without]].to_numpy().sum(axis=1)
    arrays = [np.zeros(b) for b in BUCKETS]
    for order, a in enumerate(arrays):
        part = (counted["kind"] == order).to_numpy()
        a[counted["bucket"].to_numpy(dtype=int)[part]] = each[part]
    return Model(tuple(arrays))


def damaged(window: str) -> list[str]:
    """The window read wrongly in the common ways."""
    out = []
    for really, read in (("utf-8", "cp1252"), ("utf-8", "latin-1"), ("utf-8", "mac_roman"), ("utf-8", "cp437"), ("cp1252", "latin-1"), ("mac_roman", "cp1252"), ("cp1251", "cp1252")):
        try:
            raw = window.encode(really)
        except UnicodeEncodeError:
            continue
        back = {b: c for c, b in _table(read).items()}
        s = "".join(back[b] for b in raw)
        if s != window:
            out.append(s)
    return out


def judged(models: list[Model], windows: Iterable[tuple[str, list[int]]]) -> Counter[tuple[str, int]]:
    """(form, number of margins that its gain reaches): windows as they are ("sound") and read wrongly ("hurt"), by the model without the tenth, for each tenth that has them."""
    out: Counter = Counter()
    forms = [((w, *damaged(w)), n) for w, n in windows if not redecodable(w)]
    for i, m in enumerate(models):
        here = [f for f, n in forms if n[i]]
        m.learn(s for f in here for x in f for s in (x, *(s for _, s in candidates(x))))
        for f in here:
            for k, x in enumerate(f):
                out["hurt" if k else "sound", bisect_right(MARGINS, m.best(x)[0])] += 1
    candidates.cache_clear()  # hardly a form comes again
    return out


def validated(passed: dict[tuple[str, int], int]) -> float:
    """The margin with the fewest errors on windows and their damaged forms (see ``judged``)."""
    sound, hurt = (np.array([passed.get((form, j), 0) for j in range(len(MARGINS) + 1)]) for form in ("sound", "hurt"))
    alarms, missed = sound.sum() - np.cumsum(sound)[:-1], np.cumsum(hurt)[:-1]
    return float(MARGINS[int(np.argmin(5 * alarms / max(1, sound.sum()) + missed / max(1, hurt.sum())))])


def repaired(texts: DataFrame, model: Model) -> DataFrame:
    """(message_id, chain, gain, restored) of the affected rows.

    ``restored`` is null where bytes are lost (U+FFFD). Rows without
    non-ASCII characters, null texts and empty ones are not affected.
    """
    ship(texts.sparkSession)
    sent = texts.sparkSession.sparkContext.broadcast(model)

    def fix(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = sent.value
        for pdf in batches:
            out = []
            for i, s, broken in zip(pdf["message_id"], pdf["s"], pdf["broken"]):
                if "�" in s:
                    out.append((i, "lost", 0.0, None))
                    continue
                gain, chain, fixed = m.repair(s)
                if broken:
                    out.append((i, f"{chain or REALLY[0]} as stored bytes", gain, fixed))
                elif gain >= m.margin:
                    out.append((i, chain, gain, fixed))
            yield pd.DataFrame(out, columns=["message_id", "chain", "gain", "restored"])

    return texts.select("message_id", "s", "broken").mapInPandas(fix, "message_id long, chain string, gain double, restored string")


def restored(spark: SparkSession, root: str) -> DataFrame:
    """Affected rows with their chain, gain and the original string where it can be had."""
    texts = strings(spark, root)
    return repaired(texts, train(texts))


def found(spark: SparkSession, root: str) -> DataFrame:
    """(message_id) of the affected rows (see TESTDATA.md)."""
    return restored(spark, root).select("message_id")


def faults(spark: SparkSession, root: str) -> DataFrame:
    """One row: affected texts with U+FFFD (every one of the table must be), and what must not be: affected texts of ASCII only, restored as they were, or without a restored string though nothing is lost; ids that come twice."""
    got = cut(restored(spark, root))
    both = got.join(table(spark, root, "message").select(F.col("rowid").alias("message_id"), "text"), "message_id")
    lost = F.coalesce(F.contains("text", F.lit("�")), F.lit(False))
    each = both.agg(
        F.count_if(lost).alias("lost_texts"), F.count_if(~F.col("text").rlike(r"[^\x00-\x7F]")).alias("ascii_texts"), F.count_if(F.col("restored") == F.col("text")).alias("restored_as_they_were"),
        F.count_if(F.col("restored").isNull() & F.col("text").isNotNull() & ~lost).alias("not_restored"),
    )
    return each.crossJoin(got.groupBy("message_id").agg(F.count("*").alias("k")).agg(F.count_if(F.col("k") > 1).alias("ids_twice")))  # one row each
