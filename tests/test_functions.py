"""Text, clock, body and JSON rules on hand-made values."""

import json
import plistlib

import pytest
from pyspark.sql import functions as F

from turnmill.functions import body as B
from turnmill.functions import clock as C
from turnmill.functions import text as X
from turnmill.functions.jsonl import check_line, line_of


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(f(F.col("v"))).first()[0]


def many(spark, values, f, kind="string"):
    df = spark.createDataFrame(list(enumerate(values)), f"i int, v {kind}")
    return [r[1] for r in df.select("i", f(F.col("v"))).orderBy("i").collect()]


def test_normalize(spark):
    got = many(spark, [None, "", " a\r\nb\rc ", "a\n\n\n\n\nb", " \t x　", "￼"], X.normalize)
    assert got == ["", "", "a\nb\nc", "a\n\nb", "x", "￼"]


def test_strip_equals_python(spark):
    odd = [chr(i) + "x" + chr(i) for i in range(1, 0x3100) if not 0xD800 <= i < 0xE000]
    assert many(spark, odd, X.strip) == [s.strip() for s in odd]


def test_junk_and_metadata(spark):
    yes = ["", None, "Your LOGIN code", "one-time password", "use 1234 for x", "55120 security", "msg & data rates may apply", "reply stop", "free msg: x", "tracking number", "shipment was delivered", "not delivered"]
    assert all(many(spark, yes, X.is_junk)) and not any(many(spark, ["see you at 5", "a code of honour", "1234 apples"], X.is_junk))
    meta = ["a $NULL b", "http://a.b http://c.d", "6F9619FF-8B86-D011-B42D-00C04FC964FF", "-6F9619FF-8B86-D011-B42D-00C04FC964FF", "$classname", "xNSObject", "https://a.b/groups/7"]
    assert all(many(spark, meta, X.is_metadata))
    assert not any(many(spark, [None, "", "$CLASSNAME", "nsvalue", "one http://a.b only", "see 6F9619FF-8B86-D011-B42D-00C04FC964FF in the long list of all things"], X.is_metadata))
    assert one(spark, "seen at campus.example today", lambda c: X.is_metadata(c, ("campus.example",)))
    odd = lambda c: X.is_metadata(c, ("a+b(c.example",))
    assert many(spark, ["at a+b(c.example", "at aab(c.example", "at a+b(cxexample"], odd) == [True, False, False]
    assert many(spark, [" \t\n", " \u3000"], X.is_junk) == [True, True]
    assert many(spark, ["\n-6F9619FF-8B86-D011-B42D-00C04FC964FF\r", " \r\n "], X.is_metadata) == [True, False]


def test_human(spark):
    assert all(many(spark, ["hello there", "ok", "7 pm?", "naïve"], X.is_human))
    assert not any(many(spark, [None, "", "x", "...", "streamtyped hi", "nsomething", "{a}[b]<c>", "ok\x01fine", "__kThing", "a "], X.is_human))


def test_bare(spark):
    assert many(spark, ["It’s  OK!", " A b-c ", "¡Hola!", "…", None], X.bare) == ["itsok", "abc", "hola", "", None]


def test_clock(spark):
    raw = [None, 0, 5, 10**9, 10**9 + 1, 7 * 10**11, 7 * 10**17]
    assert many(spark, raw, C.to_unix, "long") == [0.0, 978307200.0, 978307205.0, 1978307200.0, 1000000.001 + 978307200.0, 7e11 / 1e6 + 978307200.0, 7e8 + 978307200.0]
    assert one(spark, 7 * 10**11, lambda c: C.to_unix(c, "ms"), "long") == 7e8 + 978307200.0


def stream(text):
    raw = text.encode() if isinstance(text, str) else text
    n = len(raw)
    size = bytes([n]) if n < 128 else b"\x81" + n.to_bytes(2, "little")
    return b"\x04\x0bstreamtyped\x81\xe8\x03\x84\x01@\x84\x84\x84\x08NSString\x01\x94\x84\x01\x2b" + size + raw + b"\x86\x84\x02iI\x01\x0c"


@pytest.mark.parametrize("text", ["hi", "x" * 127, "x" * 128, "naïve 😀 " * 40, "日本語"])
def test_stored_strings(spark, text):
    assert one(spark, stream(text), B.stored_text, "binary") == text
    assert one(spark, plistlib.dumps({"NS.string": text}, fmt=plistlib.FMT_BINARY), B.stored_text, "binary") == text


def test_stored_strings_of_odd_bytes(spark):
    assert many(spark, [None, b"", b"bplist00", b"\x04\x0bstreamtyped", b"NSString\x01\x94\x84\x01\x2b"], B.stored_text, "binary")[:4] == [None] * 4
    assert one(spark, stream(b"caf\xe9"), B.stored_text, "binary") == "caf�"


def test_recover(spark):
    f = lambda c: B.recover(c)
    assert one(spark, b"\x01\x00see you at the gate\x00\x02", f, "binary") == "see you at the gate"
    assert one(spark, b"streamtyped\x00\x01NSString\x00meet me at noon\x00NSDictionary", f, "binary") == "meet me at noon"
    assert many(spark, [None, b"", b"NSDictionary\x00$objects", b"6F9619FF-8B86-D011-B42D-00C04FC964FF"], f, "binary") == ["", "", "", ""]
    # Looks like a phone number between marks; noise of durations; a dump of addresses.
    assert one(spark, b"\x84\x01streamtyped\x00+1 999 000 0117\x00NSString\x01", f, "binary") == "+1 999 000 0117"
    assert many(spark, [b"\x01TimeDuration\x00DateDuration 5\x00__kIMx", b"\x00https://a.example/users/7 https://b.example/groups/9\x00", b"\x01$version\x00$archiver\x00$top\x00$objects"], f, "binary") == ["", "", ""]
    assert one(spark, b"\x00campus.example says so\x00", lambda c: B.recover(c, hosts=("campus.example",)), "binary") == ""
    assert one(spark, plistlib.dumps({"a": ["short", {"b": "the longest text of them all"}]}), f, "binary") == "the longest text of them all"


def test_lines(spark):
    m = [("user", 'a "b" \\ \x01\x0b\n/é'), ("assistant", "\\u0041")]
    df = spark.createDataFrame([(m,)], "m array<struct<role:string,content:string>>")
    want = json.dumps([{"role": r, "content": c} for r, c in m], ensure_ascii=False, separators=(",", ":"))
    assert df.select(line_of(F.col("m"))).first()[0] == want


def test_strict_lines(spark):
    ok = '[{"role":"user","content":""},{"role":"assistant","content":"x","more":1}]'
    bad = ["", "{}", "[]", "nope", ok[:-1], '[{"role":"assistant","content":"x"},{"role":"user","content":"x"}]', '[{"role":"user","content":5},{"role":"assistant","content":"x"}]', "[1,2]", None, "[" * 100_000]
    assert [r is None for r in many(spark, [ok, *bad], lambda c: check_line(c)["problem"])] == [True] + [False] * len(bad)
