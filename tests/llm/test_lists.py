"""The list queries against plain Python, on the whole smallest tables and on hand-made ones."""

import os

import brute as b
import duckdb
import pyarrow.parquet as pq
import pytest

from turnmill.llm import conversations, copies, leaks, overlap, runs, splits
from turnmill.llm.queries import QUERIES, SQL

ROOT = "/root/testdata/sf0.001"
load = lambda t: pq.read_table(f"{ROOT}/{t}.parquet").to_pylist()
rows = lambda df: {tuple(r) for r in df.collect()}
pytestmark = pytest.mark.skipif(not os.path.exists(ROOT), reason="no test tables")


@pytest.fixture(scope="module")
def chats():
    return b.chat_rows(load("message"), load("chat_message_join"), load("chat_handle_join"), load("handle"))


def test_overlaps(spark):
    assert rows(overlap.found(spark, ROOT)) == b.p1(load("reply_pair"))


def test_copies(spark):
    want = b.p2(load("pair_line"), load("message"), load("chat_message_join"))
    got = copies.found(spark, ROOT)
    assert rows(got) == want and got.count() == len(want)
    sets = copies.collapsed(spark, ROOT)
    assert sets.where("copies > 1").selectExpr("sum(copies - 1)").first()[0] == len(want)


def test_conversations(spark, chats):
    want = b.p3(chats, {x["message_id"] for x in load("message_attachment_join")})
    assert rows(conversations.found(spark, ROOT)) == want
    told = conversations.transcripts(spark, ROOT).collect()
    assert len(told) == len(want) and all(r["content"].strip() for r in told)


def test_splits(spark):
    pairs = load("reply_pair")
    assert rows(splits.found(spark, ROOT)) == b.p4(pairs)
    got = {r["pair_id"]: r for r in splits.assign(spark, ROOT).collect()}
    assert len(got) == len(pairs)
    for first, other in b.p4(pairs):
        assert got[first]["new_split"] == got[other]["new_split"]


def test_runs(spark, chats):
    assert rows(runs.found(spark, ROOT)) == b.p6(chats)
    for r in runs.entries(spark, ROOT).collect():
        assert len(r["message_ids"]) == r["copies"] >= 2 and r["seconds"] >= 0


def test_leaks(spark):
    assert rows(leaks.found(spark, ROOT)) == b.p9(load("documents"), load("eval_item"))


def test_every_query_runs(spark):
    for name in ("p1_by_source", "p5_redacted", "p7_restored", "p8_fill", "p9_cleaned", "p10_by_document"):
        assert QUERIES[name](spark, ROOT).count() > 0, name


def test_offset_clock_is_corrected(spark):
    """The other side's clock runs 120 s ahead: replies seem to come before what they answer."""
    s, out = 10**9, []
    for k in range(60):
        out += [(1, 2 * k, (k * 300 + 120) * s, False, True, True), (1, 2 * k + 1, (k * 300 + 60) * s, True, True, True)]
    df = spark.createDataFrame(out, "chat_id long, id long, t long, me boolean, has_text boolean, whole boolean")
    assert conversations.offsets(conversations.constraints(df)).first()["offset_ns"] == -60 * s
    turns = conversations.conversations(df)
    assert turns.count() == 120 and turns.where("turn_no = 1").first()["first_message_id"] == 0


@pytest.mark.parametrize("name", ["p1_report", "p1_by_source", "p2_collapsed", "p3_transcripts", "p4_faults", "p5_faults", "p7_faults", "p8_faults", "p9_by_item", "p10_faults"])
def test_against_sql(spark, name):
    """The lists themselves are held against plain Python above; what follows from them, against SQL."""
    db = duckdb.connect()
    for t in ("message", "chat", "handle", "chat_handle_join", "chat_message_join", "message_attachment_join", "reply_pair", "pair_line", "documents", "eval_item"):
        db.execute(f"create view {t} as from '{ROOT}/{t}.parquet'")
    want = db.execute(SQL[name])
    cols = [d[0] for d in want.description]
    shown = lambda r: repr(tuple(round(x, 9) if isinstance(x, float) else x for x in r))
    assert sorted(map(shown, want.fetchall())) == sorted(shown(r) for r in QUERIES[name](spark, ROOT).select(*cols).collect())


@pytest.mark.skipif(not os.path.exists(ROOT), reason="no test tables")
@pytest.mark.parametrize("name", ["p1_found", "p2_found", "p3_found", "p4_found", "p6_found", "p9_found"])
def test_sql_of_lists(name):
    """Their SQL against plain Python as well, one scale up where that is quick."""
    root = ROOT.replace("0.001", "0.01")
    read = lambda t: pq.read_table(f"{root}/{t}.parquet").to_pylist()
    db = duckdb.connect()
    for t in ("message", "chat", "handle", "chat_handle_join", "chat_message_join", "message_attachment_join", "reply_pair", "pair_line", "documents", "eval_item"):
        db.execute(f"create view {t} as from '{root}/{t}.parquet'")
    got = db.execute(SQL[name]).fetchall()
    said = lambda: b.chat_rows(read("message"), read("chat_message_join"), read("chat_handle_join"), read("handle"))
    want = {
        "p1_found": lambda: b.p1(read("reply_pair")), "p2_found": lambda: b.p2(read("pair_line"), read("message"), read("chat_message_join")), "p4_found": lambda: b.p4(read("reply_pair")),
        "p3_found": lambda: b.p3(said(), {x["message_id"] for x in read("message_attachment_join")}), "p6_found": lambda: b.p6(said()), "p9_found": lambda: b.p9(read("documents"), read("eval_item")),
    }[name]()
    assert set(got) == want and len(got) == len(want)


def test_hot_keys(spark, tmp_path):
    """A third of all records share the first eight words, another third one contact; every overlap and group is found."""
    import random

    r = random.Random(11)
    word = lambda: "w" + str(r.randint(0, 400))
    out = []
    for i in range(420):
        said = "thank you very much for your kind message".split() + [word() for _ in range(12)] if i % 3 == 0 else [word() for _ in range(r.randint(10, 30))]
        if i % 7 == 0 and i:
            said = out[r.randrange(len(out))]["messages"][0]["content"].split()
            said[r.randrange(len(said))] = "changed"
        out.append({"pair_id": i, "contact_label": "+999 000 11" if i % 3 == 1 else f"c{i % 40}", "split": ("train", "train", "test", "validation")[i % 4], "source": "s", "messages": [{"role": "user", "content": " ".join(said)}, {"role": "assistant", "content": "ok"}]})
    spark.createDataFrame(out, "pair_id long, contact_label string, split string, source string, messages array<struct<role:string,content:string>>").write.parquet(f"{tmp_path}/reply_pair.parquet")
    assert rows(overlap.found(spark, str(tmp_path))) == b.p1(out) != set()
    assert rows(splits.found(spark, str(tmp_path))) == b.p4(out)


def test_planted_skews_of_short_chats(spark):
    """Few replies, uneven delays; one late row and a chat with a right clock beside them."""
    s, out, order, skews = 10**9, [], {}, {}
    for chat, (replies, ahead) in enumerate([(n, x) for n in (5, 8, 12, 20) for x in (150, -150)] + [(9, 0)]):
        skews[chat], order[chat] = ahead, []
        for k in range(replies):
            asked = 5000 + k * 1007
            said = asked + 20 + 11 * (k % 5)
            again = said + 15 + 7 * (k % 3)
            for j, (t, me) in enumerate(((asked, False), (said, True), (again, False))):
                out.append((chat, 3 * k + j, (t + (0 if me else ahead)) * s, me, True, True))
                order[chat].append((t, 3 * k + j))
    out.append((8, 27, 5030 * s, False, True, True))  # arrives last, sent at the beginning
    df = spark.createDataFrame(out, "chat_id long, id long, t long, me boolean, has_text boolean, whole boolean")
    df = conversations.constraints(df)
    moved = {r["chat_id"]: r["offset_ns"] / s for r in conversations.offsets(df).collect()}
    assert set(moved) == set(range(8)) and all(abs(x + skews[c]) <= 64 for c, x in moved.items())
    got = {}
    for r in conversations.conversations(df).orderBy("chat_id", "first_t", "first_message_id").collect():
        got.setdefault(r["chat_id"], []).append(r["first_message_id"])
    assert {c: got[c] for c in range(8)} == {c: [i for _, i in sorted(order[c])] for c in range(8)}


def test_least_squares_offset(spark):
    """Against the minimum of the sum of squared violations, searched for on a fine grid."""
    import random

    r = random.Random(5)
    rows = [(1, r.randint(-300, 40) if k % 2 else r.randint(-60, 500), bool(k % 2)) for k in range(80)]
    df = spark.createDataFrame([(c, d * 10**6, me) for c, d, me in rows], "chat_id long, d long, me boolean")
    cost = lambda x: sum(max(0, x - d) ** 2 if me else max(0, -d - x) ** 2 for _, d, me in rows)
    want = min((cost(x / 100), x / 100) for x in range(-40_000, 40_001))[1]
    assert abs(conversations.offsets(df).first()["offset_ns"] / 10**6 - want) <= 0.011


def test_transcripts_of_an_offset_clock(spark, tmp_path):
    """Texts follow the corrected times of their turns; a chat with a right clock beside it stays as it is."""
    s, said = 10**9, {}
    for chat, ahead in ((1, 120), (2, 0)):
        for k in range(60):
            said[chat, 2 * k] = (10_000 * chat + 2 * k, f"asked {k}", (10**9 // 2 + k * 300 + ahead) * s, 0)
            said[chat, 2 * k + 1] = (10_000 * chat + 2 * k + 1, f"answered {k}", (10**9 // 2 + k * 300 + 60) * s, 1)
    for name, out, schema in (
        ("handle", [(1,), (2,)], "rowid long"),
        ("chat_handle_join", [(1, 1), (2, 2)], "chat_id long, handle_id long"),
        ("message", [(i, x, None, t, me, None, 0, 0, None, None) for i, x, t, me in said.values()], "rowid long, text string, attributedbody binary, date long, is_from_me int, associated_message_guid string, associated_message_type int, item_type int, balloon_bundle_id string, expressive_send_style_id string"),
        ("chat_message_join", [(k[0], v[0]) for k, v in said.items()], "chat_id long, message_id long"),
        ("message_attachment_join", [], "message_id long, attachment_id long"),
    ):
        spark.createDataFrame(out, schema).write.parquet(f"{tmp_path}/{name}.parquet")
    got = {(r["chat_id"], r["turn_no"]): (r["role"], r["content"]) for r in conversations.transcripts(spark, str(tmp_path)).collect()}
    assert got == {(c, n + 1): ("assistant" if v[3] else "user", v[1]) for (c, n), v in said.items()}


def test_contradicting_clocks_are_rejected(spark):
    s = 10**9
    out = [(1, i, (10_000 - 10 * i) * s, i % 2 == 1, True, True) for i in range(200)]
    df = spark.createDataFrame(out, "chat_id long, id long, t long, me boolean, has_text boolean, whole boolean")
    assert conversations.conversations(df).count() == 0
    assert conversations.conversations(df, correct=False).count() > 0


def test_midnight_is_no_boundary(spark):
    """A run and a turn that pass several days' ends, in one chat."""
    step, day = 500, 86_400
    out = [(5, i, (day - 2_000 + i * step) * 10**9, True, "the very same long text again") for i in range(400)]
    df = spark.createDataFrame(out, "chat_id long, id long, t long, me boolean, body_text string")
    got = runs.runs(df).collect()
    assert [(r["first_id"], r["last_id"], r["n"]) for r in got] == [(0, 399, 400)]
    both = [(5, -1, (day - 2_100) * 10**9, False, True, True)] + [(5, i, t, me, True, True) for _, i, t, me, _ in out]
    turns = conversations.conversations(spark.createDataFrame(both, "chat_id long, id long, t long, me boolean, has_text boolean, whole boolean"), correct=False).orderBy("turn_no").collect()
    assert [(r["turn_no"], r["n"]) for r in turns] == [(1, 1), (2, 400)]


def test_empty_tables(spark, tmp_path):
    for t in ("chat", "handle", "chat_handle_join", "message", "chat_message_join", "message_attachment_join", "reply_pair", "pair_line", "documents", "eval_item", "name_list"):
        spark.read.parquet(f"{ROOT}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, f in QUERIES.items():
        assert f(spark, str(tmp_path)).count() == (name == "p8_fill" or name.endswith("_faults")), name


def test_nulls_ties_repeats_and_extra_columns(spark, tmp_path):
    """Every column null in half of the rows, all rows doubled, and a clashing extra column: nothing breaks."""
    from pyspark.sql import functions as F

    for t in ("chat", "handle", "chat_handle_join", "message", "chat_message_join", "message_attachment_join", "reply_pair", "pair_line", "documents", "eval_item", "name_list"):
        df = spark.read.parquet(f"{ROOT}/{t}.parquet").limit(120)
        holes = df.select(*(F.when(F.rand(3) > 0.5, F.col(c)).alias(c) for c in df.columns))
        df.unionByName(holes).unionByName(df).withColumn("n", F.lit("x")).withColumn("block", F.lit(1)).withColumn("class", F.lit("y")).write.parquet(f"{tmp_path}/{t}.parquet")
    for name, f in QUERIES.items():
        f(spark, str(tmp_path)).count()
