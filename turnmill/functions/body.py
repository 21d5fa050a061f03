"""Strings inside archived message bodies (BINARY -> STRING), JVM-side."""

from __future__ import annotations

import plistlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.functions import text as X
from turnmill.session import ship

# Fixed value: what stands before the string in a typed stream.
STREAM_MARK = "NSString\x01\x94\x84\x01+"
# Fixed value: the key before the string in a one-key binary property list.
PLIST_KEY = "YNS.string"


def _let(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is computed once: SQL expressions have no variables, lambdas do."""
    return F.transform(F.array(value), f)[0]


def _byte(s: Column, at: Column) -> Column:
    return F.ascii(F.substr(s, at, F.lit(1)))


def _one_for_each_byte(body: Column) -> Column:
    return F.decode(body, "ISO-8859-1")


def _stream(s: Column) -> Column:
    """The string's characters (one for each byte) after the mark of a typed stream, else null."""

    def sized(at: Column) -> Column:
        long = F.substr(s, at + 3, _byte(s, at + 1) + 256 * _byte(s, at + 2))
        return _let(_byte(s, at), lambda n: F.when(n < 128, F.substr(s, at + 1, n)).when(n == 129, long))

    return _let(F.locate(STREAM_MARK, s), lambda at: F.when(at > 0, sized(at + len(STREAM_MARK))))


def stored_bytes(body: Column) -> Column:
    """The string's bytes in a typed stream, else null."""
    return F.encode(_let(_one_for_each_byte(body), _stream), "ISO-8859-1")


def _plist(s: Column) -> Column:
    """The string after the key of a one-key binary property list, else null."""

    def text(at: Column, kind: Column, n: Column) -> Column:
        wide = F.decode(F.encode(F.substr(s, at, 2 * n), "ISO-8859-1"), "UTF-16BE")
        return F.when(kind == 5, F.substr(s, at, n)).when(kind == 6, wide)

    def counted(at: Column, kind: Column, low: Column) -> Column:
        # A count of 15 or more stands in one, two or four bytes of its own.
        be = lambda n: sum((_byte(s, at + 2 + i) * 256 ** (n - 1 - i) for i in range(n)), F.lit(0))
        own = lambda w: F.when(w == 0, text(at + 3, kind, be(1))).when(w == 1, text(at + 4, kind, be(2))).otherwise(text(at + 6, kind, be(4)))
        return F.when(low < 15, text(at + 1, kind, low)).otherwise(_let(_byte(s, at + 1).bitwiseAND(F.lit(15)), own))

    valued = lambda at: _let(_byte(s, at), lambda m: counted(at, F.shiftright(m, 4), m.bitwiseAND(F.lit(15))))
    return F.when(s.startswith("bplist00"), _let(F.locate(PLIST_KEY, s), lambda at: F.when(at > 0, valued(at + len(PLIST_KEY)))))


def plist_string(body: Column) -> Column:
    """The value of the key in a one-key binary property list, else null."""
    return _let(_one_for_each_byte(body), _plist)


def stored_text(body: Column) -> Column:
    """The archived string as UTF-8 (damaged bytes become U+FFFD), else null.

    Null, empty and unknown archives give null; nothing is dropped or raised.
    Each value on the way is bound once by a lambda, which keeps it out of
    generated code: spelled out, the expression grows beyond what compiles.
    """
    stream = lambda s: F.make_valid_utf8(F.encode(_stream(s), "ISO-8859-1").cast("string"))
    return _let(_one_for_each_byte(body), lambda s: F.coalesce(stream(s), _plist(s)))


def row_text(text: Column, body: Column) -> Column:
    """``text``, or the archived string where ``text`` shows nothing; null if neither shows anything."""
    return F.when(X.has_text(text), text).otherwise(_let(stored_text(body), lambda t: F.when(X.has_text(t), t)))


def _strings(node) -> Iterator[str]:
    if isinstance(node, str):
        yield node
    elif isinstance(node, bytes):
        try:
            yield node.decode()
        except UnicodeDecodeError:
            pass
    elif isinstance(node, dict):
        for v in node.values():
            yield from _strings(v)
    elif isinstance(node, (list, tuple, set)):
        for v in node:
            yield from _strings(v)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _plist_strings(bodies: pd.Series) -> pd.Series:
    def one(b):
        if b is None:
            return None
        try:
            return [s.encode("utf-8", "replace").decode() for s in _strings(plistlib.loads(bytes(b)))]
        except Exception:  # any damage at all means that this is no property list
            return None

    return bodies.map(one)


def plist_strings(body: Column) -> Column:
    """Every string inside a property list; null for other bytes."""
    ship()
    return _plist_strings(body)


def _gate(body: Column) -> Column:
    """Only bytes that the property-list parser could accept; others null."""
    head = F.hex(F.substring(body, 1, 8))
    marks = [b"bplist00".hex().upper(), b"<?xml".hex().upper(), b"<plist".hex().upper()]
    bom = head.startswith("EFBBBF") | head.startswith("FEFF") | head.startswith("FFFE")
    return F.when(head.startswith(marks[0]) | head.startswith(marks[1]) | head.startswith(marks[2]) | bom, body)


def printable_runs(body: Column) -> Column:
    """All runs of two or more printable ASCII bytes (with TAB, CR, LF)."""
    return F.regexp_extract_all(F.decode(body, "ISO-8859-1"), F.lit(r"[ -~\t\r\n]{2,}"), F.lit(0))


def best_human(candidates: Column, hosts: tuple[str, ...] = ()) -> Column:
    """The best-ranked human text of an array, the first of equals; null if there is none."""
    kept = F.filter(F.transform(candidates, lambda t: X.normalize(t)), lambda t: X.is_human(t, hosts, normalized=True))
    ranked = F.transform(kept, lambda t, i: F.struct(X.score(t).alias("score"), (-i).alias("first"), t.alias("text")))
    return F.array_max(ranked)["text"]


def recover(body: Column, structured: bool = True, hosts: tuple[str, ...] = ()) -> Column:
    """Human text from an archived body: property list first, then byte runs; else empty."""
    raw = best_human(printable_runs(body), hosts)
    if not structured:
        return F.coalesce(raw, F.lit(""))
    return F.coalesce(best_human(plist_strings(_gate(body)), hosts), raw, F.lit(""))
