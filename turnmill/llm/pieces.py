"""Problem 10: long texts into pieces at natural boundaries."""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.llm.tokens import Tokenizer, tokenizer
from turnmill.session import cut, ship, table

LIMIT, OVERLAP = 512, 64
SCHEMA = "doc_id long, piece int, start int, stop int, overlap int, tokens int, text string"
#: Strength of a boundary.
TOKEN, WORD, SENTENCE, LINE, PARAGRAPH = range(5)
_BREAKS = re.compile(r"(?P<p>\r?\n[ \t]*(?:\r?\n\s*)+)|(?P<l>\r\n|\r|\n)|(?P<s>(?<=[.!?…])[\"”’»)\]]*(?=\s)|(?<=[。！？]))")
_WORDS = re.compile(r"\s*\S+|\s+")


def boundaries(text: str) -> list[tuple[int, int]]:
    """(character position, strength) of ends of paragraphs, lines and sentences, in order."""
    kinds = {"p": PARAGRAPH, "l": LINE, "s": SENTENCE}
    return [(m.end(), kinds[m.lastgroup]) for m in _BREAKS.finditer(text) if 0 < m.end() < len(text)]


class Cutter:
    """Cuts one text; token positions come from one encoding of the whole."""

    def __init__(self, text: str, tok: Tokenizer, limit: int, overlap: int) -> None:
        self.text, self.tok, self.limit, self.overlap = text, tok, limit, overlap
        self.room = limit - overlap
        self.ends = tok.ends(text)
        widths = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        self.byte = np.concatenate([[0], np.cumsum(1 + (widths >= 0x80) + (widths >= 0x800) + (widths >= 0x10000))])

    def at(self, char: int) -> int:
        """Tokens that begin before a character."""
        return 0 if char == 0 else int(np.searchsorted(self.ends, self.byte[char], "left")) + 1

    def char(self, token: int) -> int:
        """The character at which a token begins, or the next whole one."""
        return 0 if token <= 0 else int(np.searchsorted(self.byte, self.ends[token - 1], "left"))

    def size(self, a: int, z: int) -> int:
        return self.at(z) - self.at(a)

    def atoms(self) -> list[tuple[int, int, int]]:
        """(start, stop, strength of the boundary before): sentences; their words or tokens where one is too large."""
        out, a, strength = [], 0, PARAGRAPH
        for z, s in [*boundaries(self.text), (len(self.text), PARAGRAPH)]:
            if z > a:
                out += self._split(a, z, strength)
                a, strength = z, s
            else:
                strength = max(strength, s)
        return out

    def _split(self, a: int, z: int, strength: int) -> list[tuple[int, int, int]]:
        if self.size(a, z) <= self.room:
            return [(a, z, strength)]
        out = []
        for m in _WORDS.finditer(self.text, a, z):
            x, y, s = m.start(), m.end(), WORD if out else strength
            while self.size(x, y) > self.room:
                cut = max(x + 1, min(y, self.char(self.at(x) + self.room) - 1))
                out.append((x, cut, s))
                x, s = cut, TOKEN
            if y > x:
                out.append((x, y, s))
        return out

    def merged(self) -> list[tuple[int, int]]:
        """Spans left when the weakest boundaries have gone as long as size and overlap fit."""
        atoms = self.atoms()
        n = len(atoms)
        start, stop = [a for a, _, _ in atoms], [z for _, z, _ in atoms]
        size = [self.size(a, z) for a, z, _ in atoms]
        after = [*range(1, n), -1]
        before = [-1, *range(n - 1)]
        alive = [True] * n
        heap = [(atoms[i + 1][2], size[i] + size[i + 1], i, i + 1) for i in range(n - 1)]
        heapq.heapify(heap)
        while heap:
            s, both, i, j = heapq.heappop(heap)
            if not (alive[i] and alive[j]) or after[i] != j or size[i] + size[j] != both or both > self.room:
                continue
            stop[i], size[i], alive[j] = stop[j], both, False
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
                k = after[j]
                heapq.heappush(heap, (atoms[k][2], both + size[k], i, k))
            if before[i] >= 0:
                h = before[i]
                heapq.heappush(heap, (atoms[i][2], size[h] + both, h, i))
        return [(start[i], stop[i]) for i in range(n) if alive[i]]

    def pieces(self) -> Iterator[tuple[int, int, int, int]]:
        """(start, stop, overlap in characters, tokens): each piece as it is, encoded by itself, is under the limit."""
        todo = self.merged()[::-1]
        while todo:
            a, z = todo.pop()
            back = max(0, self.at(a) - self.overlap)
            lead = self.char(back) if a else a
            n = self.tok.count(self.text[lead:z])
            while n > self.limit and lead < a:  # encoded alone, an edge may take a token more
                lead = min(a, max(lead + 1, self.char(self.at(lead) + n - self.limit)))
                n = self.tok.count(self.text[lead:z])
            if n > self.limit and z - a > 1:
                mid = (a + z) // 2
                todo += [(mid, z), (a, mid)]
                continue
            yield lead, z, a - lead, n


def split(docs: DataFrame, limit: int = LIMIT, overlap: int = OVERLAP, path: str | None = None) -> DataFrame:
    """(doc_id, piece, start, stop, overlap, tokens, text): ordered pieces of texts over the limit.

    ``docs``: doc_id, text. Pieces are spans of the text (characters); all
    but the first repeat about ``overlap`` tokens of the one before, so the
    text is the pieces without their overlaps, in order. Texts within the
    limit, nulls and empty texts give none; a text of no more bytes than
    the limit has tokens at most is not encoded. A limit of four tokens or
    more holds any character.
    """
    if not 0 <= overlap < limit or limit - overlap < 4:
        raise ValueError("the overlap must leave four tokens at least")

    ship(docs.sparkSession)

    def cut_each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tok = tokenizer(path)
        for pdf in batches:
            out = []
            for doc, text in zip(pdf["doc_id"], pdf["text"]):
                c = Cutter(text, tok, limit, overlap)
                if len(c.ends) > limit:
                    out += [(doc, i, a, z, o, n, text[a:z]) for i, (a, z, o, n) in enumerate(c.pieces())]
            yield pd.DataFrame(out, columns=["doc_id", "piece", "start", "stop", "overlap", "tokens", "text"])

    long = docs.where(F.col("doc_id").isNotNull() & (F.octet_length("text") > limit))
    return long.select("doc_id", "text").mapInPandas(cut_each, SCHEMA)


def found_pieces(spark: SparkSession, root: str) -> DataFrame:
    """Pieces of all documents longer than LIMIT tokens."""
    return split(table(spark, root, "documents"))


def by_document(spark: SparkSession, root: str) -> DataFrame:
    """(doc_id, pieces, tokens, largest) of the documents that were cut."""
    return found_pieces(spark, root).groupBy("doc_id").agg(F.count("*").alias("pieces"), F.sum("tokens").alias("tokens"), F.max("tokens").alias("largest"))


def faults(spark: SparkSession, root: str, limit: int = LIMIT, overlap: int = OVERLAP) -> DataFrame:
    """One row that counts what must not be: pieces over the limit or empty, overlaps beyond the one given, texts that the pieces without their overlaps do not give back, texts cut though they have no more bytes than the limit has tokens."""
    docs = table(spark, root, "documents").select("doc_id", F.col("text").alias("whole"))
    got = cut(split(table(spark, root, "documents"), limit, overlap))
    each = got.agg(F.count_if(F.col("tokens") > limit).alias("pieces_over"), F.count_if((F.col("start") >= F.col("stop")) | (F.col("text") == "")).alias("pieces_empty"))
    fresh = F.expr("substr(text, overlap + 1)")
    told = got.groupBy("doc_id").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("piece", fresh.alias("t")))), lambda x: x["t"]), "").alias("told"), F.count("*").alias("n"), F.max("piece").alias("last"))
    both = told.join(docs, "doc_id")
    whole = both.agg(F.count_if(F.col("told") != F.col("whole")).alias("texts_changed"), F.count_if(F.col("n") != F.col("last") + 1).alias("pieces_missing"), F.count_if(F.octet_length("whole") <= limit).alias("cut_though_fitting"))
    return each.crossJoin(whole)  # one row each
