"""The queries over whole texts, against SQL and plain Python that leave nothing out."""

import math
import os

import duckdb
import pytest

from turnmill import oracle
from turnmill.queries import QUERIES, SAMPLES

ROOT = "/root/testdata/sf0.001"
TEXT_QUERIES = ("normalize_text", "junk_flag", "junk_by_rule", "metadata_flag", "human_candidate", "text_scores", "url_uuid_counts")


def same(a, b):
    return len(a) == len(b) and all(type(x) is type(y) and (math.isclose(x, y) if isinstance(x, float) else x == y) for x, y in zip(a, b))


def held(spark, root, name):
    """The query's rows and those of its SQL."""
    db = duckdb.connect()
    db.execute(f"create view message as from read_parquet('{root}/message.parquet{'/*.parquet' * os.path.isdir(f'{root}/message.parquet')}')")
    want = db.execute(oracle.SQL[name])
    cols = [d[0] for d in want.description]
    return sorted(tuple(r) for r in QUERIES[name](spark, root).select(*cols).collect()), sorted(want.fetchall())


@pytest.mark.skipif(not os.path.exists(ROOT), reason="no test tables")
@pytest.mark.parametrize("name", TEXT_QUERIES)
def test_texts_as_they_are(spark, name):
    got, want = held(spark, ROOT, name)
    assert len(got) == len(want) and all(map(same, got, want))


@pytest.fixture(scope="module")
def samples(spark, tmp_path_factory):
    """The sample texts inside longer ones, and three others."""
    said = [*(f" {t}\n" for t in SAMPLES), *(f"so: {t}" for t in SAMPLES), None, "see you at noon", "Reply STOP, please, to end it"]
    root = str(tmp_path_factory.mktemp("samples"))
    spark.createDataFrame(list(enumerate(said)), "rowid long, text string").write.parquet(f"{root}/message.parquet")
    return root


@pytest.mark.parametrize("name", TEXT_QUERIES)
def test_samples_in_longer_texts(spark, samples, name):
    got, want = held(spark, samples, name)
    assert len(got) == len(want) and all(map(same, got, want))


def test_added_texts_are_the_same_in_sql():
    assert SAMPLES == oracle.ADDED


def body(text):
    return b"streamtyped\x00\x01NSString\x00" + text.encode() + b"\x00NSDictionary"


#: chat_id, message_id, seconds, me, text, body, effect, attachment, what the row says.
SAID = [(1, 10 * k + j, 10_000 * k + t, me, s if own else None, None if own else body(s), 0, 0, s)
        for k in range(6) for j, (t, me, s, own) in enumerate([(0, 0, f"are you there {k}", k % 2 == 0), (500, 0, f"it is about number {k}", k % 2 == 1), (900, 0, f"do tell me {k}", k != 3), (950, 1, f"here is the answer {k}", k % 3 == 0)])] + [
    (2, 101, 10, 0, "what about lunch", None, 0, 0, "what about lunch"), (2, 102, 20, 1, " ", body("at noon then"), 0, 0, "at noon then"),
    (2, 103, 30, 0, None, body("a picture of the lake"), 0, 1, None), (2, 104, 40, 1, None, body("liked a message"), 2001, 0, None),
    (2, 105, 50, 0, None, b"\x00\x01", 0, 0, None), (2, 106, 60, 1, None, None, 0, 0, None), (2, 107, 70, 0, "your login code is 5", None, 0, 0, "your login code is 5"),
    (2, 108, 80, 1, None, body("thank you so much"), 0, 0, "thank you so much"),
]
CONTACT = {1: "one@x.test", 2: "two@x.test"}


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("archive"))
    for name, rows, schema in (
        ("chat", [(1, "a"), (2, "b")], "rowid long, chat_identifier string"),
        ("handle", [(1, "one@x.test", None), (2, "two@x.test", None)], "rowid long, id string, uncanonicalized_id string"),
        ("chat_handle_join", [(1, 1), (2, 2)], "chat_id long, handle_id long"),
        ("message", [(i, s, b, t * 10**9 + 10**18 // 2, me, None, e, 0, None, None) for _, i, t, me, s, b, e, _, _ in SAID], "rowid long, text string, attributedbody binary, date long, is_from_me int, associated_message_guid string, associated_message_type int, item_type int, balloon_bundle_id string, expressive_send_style_id string"),
        ("chat_message_join", [(r[0], r[1]) for r in SAID], "chat_id long, message_id long"),
        ("message_attachment_join", [(r[1], 1) for r in SAID if r[7]], "message_id long, attachment_id long"),
    ):
        spark.createDataFrame(rows, schema).write.parquet(f"{root}/{name}.parquet")
    return root


def test_bodies_are_read(spark, archive):
    """Rows, turns, pairs, records and counters of chats whose texts stand partly in bodies."""
    rows = sorted((c, t, i, bool(me), s) for c, i, t, me, _, _, _, _, s in SAID if s)
    turns = []
    for c, t, i, me, s in rows:
        if turns and turns[-1][0] == c and turns[-1][1] == me and t - turns[-1][3] <= 600:
            turns[-1][3], turns[-1][5] = t, turns[-1][5] + [s]
        else:
            turns.append([c, me, i, t, None, [s]])
    pairs = [(a[0], CONTACT[a[0]], "\n".join(a[5]), "\n".join(b[5])) for a, b in zip(turns, turns[1:]) if a[0] == b[0] and not a[1] and b[1]]
    good = [p for p in pairs if "login code" not in p[2]]
    many = [p for p in good if sum(q[1] == p[1] for q in good) >= 5]
    got = lambda name, *cols: sorted(tuple(r) for r in QUERIES[name](spark, archive).select(*cols).collect())
    assert got("message_rows", "chat_id", "message_id", "me", "text") == sorted((c, i, me, s) for c, _, i, me, s in rows)
    assert got("turns_gap", "chat_id", "me", "first_id", "n", "text") == sorted((x[0], x[1], x[2], len(x[5]), "\n".join(x[5])) for x in turns)
    assert got("reply_pairs", "chat_id", "contact_label", "user", "assistant", "accepted") == sorted((*p, p in good) for p in pairs)
    assert got("dedupe_pairs", "contact_label", "user", "assistant") == sorted(p[1:] for p in good) and len(good) == 7
    assert got("contact_minimum", "contact_label", "records") == [("one@x.test", 6)]
    assert got("pair_pipeline", "contact_label", "user", "assistant") == sorted(p[1:] for p in many)
    live = [r for r in SAID if not r[6]]
    own = [r for r in live if (r[4] or "").strip()]
    want = {"clean_text": len(own), "clean_attributed_body": len(live) - len(own) - 2, "low_confidence": 1, "reactions": 1, "media_only": 1, "empty_text": 2, "junk_pairs": len(pairs) - len(good)}
    assert QUERIES["extraction_stats"](spark, archive).first().asDict() == want
