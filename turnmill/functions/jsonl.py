"""JSON lines of two-message records: rendering and strict validation."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from turnmill.session import ship

# Characters with a short escape.
_SHORT = (("\\", "\\\\"), ('"', '\\"'), ("\b", "\\b"), ("\t", "\\t"), ("\n", "\\n"), ("\f", "\\f"), ("\r", "\\r"))
_REST = [chr(i) for i in range(0x20) if chr(i) not in "\b\t\n\f\r"]


def _escaped(c: Column) -> Column:
    for raw, out in _SHORT:
        c = F.replace(c, F.lit(raw), F.lit(out))
    # Other control characters are rare: their replacements run only where one occurs.
    slow = c
    for raw in _REST:
        slow = F.replace(slow, F.lit(raw), F.lit(f"\\u{ord(raw):04x}"))
    return F.when(c.rlike(r"[\x00-\x1f]"), slow).otherwise(c)


def line_of(messages: Column) -> Column:
    """Compact JSON array, non-ASCII as is, control characters in lower-case hex."""
    one = lambda m: F.concat(F.lit('{"role":"'), _escaped(m["role"]), F.lit('","content":"'), _escaped(m["content"]), F.lit('"}'))
    return F.concat(F.lit("["), F.array_join(F.transform(messages, one), ","), F.lit("]"))


def _problem(line: str) -> tuple[str | None, str | None, str | None]:
    try:
        rows = json.loads(line)
    except (ValueError, RecursionError):
        return "not JSON", None, None
    if not isinstance(rows, list) or len(rows) != 2:
        return "not an array of two", None, None
    for m, role in zip(rows, ("user", "assistant")):
        if not isinstance(m, dict):
            return "not an object", None, None
        if m.get("role") != role:
            return f"role is not {role}", None, None
        if not isinstance(m.get("content"), str):
            return "content is not a string", None, None
    return None, *(m["content"].encode("utf-8", "replace").decode() for m in rows)


@F.pandas_udf(T.StructType([T.StructField(n, T.StringType()) for n in ("problem", "user", "assistant")]))
def _check(lines: pd.Series) -> pd.DataFrame:
    return pd.DataFrame([_problem(x) if x is not None else ("null", None, None) for x in lines], columns=["problem", "user", "assistant"], dtype=object)


def check_line(line: Column) -> Column:
    """Struct (problem, user, assistant) of a line; problem is null for a valid one.

    Strict: exactly two objects, roles in order, string contents. Native JSON
    functions coerce types and so cannot tell. Extra keys are ignored.
    """
    ship()
    return _check(line)
