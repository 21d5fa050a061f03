"""Text rules as Column -> Column functions (no Python in the data path)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 Unicode white-space characters that trimming removes.
WHITESPACE = "".join(
    map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])
)
_SPACE_CLASS = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"

# Substrings that mark serialized archives.
ARCHIVE_MARKERS = (
    "streamtyped", "bplist", "nsattributedstring", "nsmutableattributedstring", "nsstring", "nsmutablestring", "nsdictionary",
    "nsdict", "nsnumber", "nsdata", "nsurl", "__kim", "ns.objects", "nskeyedarchiver",
)
# Prefixes no written message starts with.
ARCHIVE_PREFIXES = ("ns", "__k", "ddscannerresult", "relativeday")
# Patterns of serialized metadata.
METADATA_PATTERNS = (
    r"x?nsobject", r"(?:time|date)duration", r"\$objects|\$archiver|\$version|\$top", r"fulladdress",
    r"https?://\S+/users/\d+", r"https?://\S+/groups/\d+", r"\\(?:TimeDuration|DateDuration)\b",
)
# Patterns of one-time codes and service notices.
JUNK_PATTERNS = (
    r"\b(?:verification|security|pass|login|otp)\s*code\b",
    r"\bone[- ]time\s+password\b",
    r"\buse\s+\d{4,8}\s+(?:as|for)\b",
    r"\b\d{4,8}\b.*\b(?:verification|security|pass|login|otp)\b",
    r"\b(?:msg|message|messages?)\s*&\s*data rates may apply\b",
    r"\breply\s+(?:stop|unsubscribe|cancel|end)\b",
    r"\bfree msg:",
    r"\bmessage blocking is active\b",
    r"\btracking number\b",
    r"\bshipment\b.*\b(?:delivered|delivery|tracking)\b",
    r"\bnot delivered\b",
)
# Addresses of the web, UUIDs, and the punctuation stripped before a lone UUID is compared.
URL = r"(?Ud)https?://\S+"
UUID = r"(?iUd)\b[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}\b"
UUID_EDGE = "$#%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def _any(conditions) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def strip(c: Column) -> Column:
    """Trim every kind of Unicode white space from both ends."""
    return F.btrim(c, F.lit(WHITESPACE))


def normalize(c: Column) -> Column:
    """Null to empty, line ends to LF, trimmed, three or more LF to two."""
    return F.regexp_replace(strip(F.regexp_replace(F.coalesce(c, F.lit("")), "\r\n?", "\n")), "\n{3,}", "\n\n")


def squeeze_spaces(c: Column) -> Column:
    """Without white space."""
    return F.regexp_replace(c, _SPACE_CLASS + "+", "")


def bare(c: Column) -> Column:
    """Lower case, without punctuation (category P) and white space."""
    return F.regexp_replace(F.lower(c), r"[\p{P}\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+", "")


def word_line(c: Column) -> Column:
    """Lower case, punctuation dropped, words joined by single blanks; without words, an empty text."""
    return F.btrim(F.regexp_replace(F.regexp_replace(F.lower(c), r"\p{P}+", ""), _SPACE_CLASS + "+", " "))


def words(c: Column) -> Column:
    """Lower case, punctuation dropped, split at white space; no empty words."""
    line = word_line(c)
    return F.when(line == "", F.array().cast("array<string>")).otherwise(F.split(line, " "))


def has_text(c: Column) -> Column:
    """True where something besides white space and U+FFFC is left; never null."""
    return F.coalesce(F.btrim(c, F.lit(WHITESPACE + "￼")) != "", F.lit(False))


def marker_hits(c: Column) -> Column:
    """How many distinct archive markers the text contains, in any case."""
    low = F.lower(F.coalesce(c, F.lit("")))
    return reduce(lambda a, b: a + b, (low.contains(m).cast("int") for m in ARCHIVE_MARKERS))


def control_ratio(c: Column) -> Column:
    """Share of control characters other than TAB, LF and CR; 1.0 if empty."""
    t = F.coalesce(c, F.lit(""))
    n = F.regexp_count(t, F.lit(r"[\x00-\x08\x0b\x0c\x0e-\x1f]")).cast("double")
    return F.when(F.length(t) == 0, F.lit(1.0)).otherwise(n / F.length(t))


def alnum_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[\p{L}\p{N}]"))


def visible_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(r"[^\p{C}\p{Z}]"))


def space_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(_SPACE_CLASS))


def url_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(URL))


def uuid_count(c: Column) -> Column:
    return F.regexp_count(c, F.lit(UUID))


def _quoted(host: str) -> str:
    """A host name as a pattern: every character but letters and digits stands for itself."""
    return re.sub(r"([^\w])", r"\\\1", host, flags=re.ASCII)


def is_metadata(c: Column, hosts: tuple[str, ...] = (), normalized: bool = False) -> Column:
    """True for serialized metadata; ``hosts`` adds host names to the patterns.

    Texts are normalised first, unless ``normalized`` says that they are.
    """
    t = c if normalized else normalize(c)
    joined = "|".join([*METADATA_PATTERNS, *map(_quoted, hosts)])
    uuids = uuid_count(t)
    edge = F.ltrim(t, F.lit(UUID_EDGE))
    lone = (uuids == 1) & (edge.rlike(r"(?iUd)\A[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\z") | (F.lit(36.0) / F.greatest(visible_count(t), F.lit(1)) >= 0.6))
    return (t != "") & (
        t.rlike(f"(?iUd)(?:{joined})") | F.lower(t).contains("$null") | (url_count(t) >= 2) | (uuids > 1) | lone
        | t.contains("$classname") | t.contains("$classes") | t.contains("NSValue")
    )


def is_junk(c: Column, normalized: bool = False) -> Column:
    """True for empty texts, one-time codes and service notices (one fused pattern), after normalising."""
    t = c if normalized else normalize(c)
    return (t == "") | t.rlike("(?iUd)(?:" + "|".join(f"(?:{p})" for p in JUNK_PATTERNS) + ")")


def junk_rule(c: Column, n: int) -> Column:
    """Whether junk rule ``n`` (from 0) alone matches the normalised text."""
    return normalize(c).rlike("(?iUd)" + JUNK_PATTERNS[n])


def is_human(c: Column, hosts: tuple[str, ...] = (), normalized: bool = False) -> Column:
    """Whether recovered text looks like something a person wrote.

    ``normalized`` says that the text has been through ``normalize``; inside
    array functions nothing is shared between the tests, so it should have.
    Cheap tests come first.
    """
    t = c if normalized else normalize(c)
    low = F.lower(t)
    return ~(
        (F.length(t) < 2) | _any(low.startswith(p) for p in ARCHIVE_PREFIXES) | low.rlike("|".join(m.replace(".", r"\.") for m in ARCHIVE_MARKERS))
        | t.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]") | ~t.rlike(r"[\p{L}\p{N}]") | (visible_count(t) < 2)
        | (F.regexp_count(t, F.lit(r"[{}\[\]<>|\\^~]")) > 2) | is_metadata(t, hosts, normalized=True)
    )


def score(c: Column) -> Column:
    """Rank of a candidate: letters and digits, then spaces, then shortness."""
    return F.struct(alnum_count(c).alias("alnum"), space_count(c).alias("spaces"), (-F.length(c)).alias("short"))
