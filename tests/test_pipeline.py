"""Chats, turns, pairs, records, splits, sources on an invented chat database."""

import json
import sqlite3

import duckdb
import pytest
from pyspark.sql import functions as F

from turnmill import oracle
from turnmill.operators.components import components
from turnmill.plans import chats as K
from turnmill.plans import config as G
from turnmill.plans import extract as E
from turnmill.plans import training as T
from turnmill.plans.pipeline import TABLES, extract
from turnmill.queries import QUERIES
from turnmill.sources.jsonl import load_strict, write_file
from turnmill.sources.sqlite import read_tables, table_columns, table_exists

#: Held against their SQL in test_whole.
TEXT_QUERIES = ("normalize_text", "junk_flag", "junk_by_rule", "metadata_flag", "human_candidate", "text_scores", "url_uuid_counts")

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database(tmp_path_factory):
    path = str(tmp_path_factory.mktemp("db") / "chat.db")
    db = sqlite3.connect(path)
    db.executescript("""
        create table chat (ROWID integer primary key, chat_identifier text);
        create table handle (ROWID integer primary key, id text, uncanonicalized_id text);
        create table chat_handle_join (chat_id integer, handle_id integer);
        create table message (ROWID integer primary key, text text, attributedBody blob, date integer, is_from_me integer, associated_message_guid text, associated_message_type integer, item_type integer);
        create table chat_message_join (chat_id integer, message_id integer);
        create table message_attachment_join (message_id integer, attachment_id integer);
    """)
    db.executemany("insert into chat values (?,?)", [(1, "a"), (2, "b"), (3, "c"), (4, None)])
    db.executemany("insert into handle values (?,?,?)", [(1, "one@x.test", None), (2, "two@x.test", ""), (3, "", " "), (4, "four", None)])
    db.executemany("insert into chat_handle_join values (?,?)", [(1, 1), (1, 1), (2, 2), (2, 99), (3, 1), (3, 2), (4, 3)])
    rows, i = [], 0
    for k in range(6):  # six pairs in chat 1; the first inbound turn has two messages exactly 600 s apart
        for text, me, t in ((f"question {k} {'x' * k}", 0, k * 10_000), (f"answer {k}", 1, k * 10_000 + 700)):
            i += 1
            rows.append((i, text, None, t + 1, me, None, 0, 0))
    rows.append((50, "and more", None, 601, 0, None, None, None))
    rows.append((51, "Liked it", None, 650, 1, "p:0/x", 2001, 0))
    rows.append((60, "question 1 x", None, 5, 0, None, 0, 0))  # chat 2: copy of a pair of chat 1
    rows.append((61, "answer 1", None, 6, 1, None, 0, 0))
    rows.append((62, "your login code is 5", None, 90_000, 0, None, 0, 0))
    rows.append((63, "thanks", None, 90_001, 1, None, 0, 0))
    rows.append((64, None, None, 90_002, 0, None, 0, 0))
    rows.append((65, None, b"\x00picture of the lake\x00", 90_003, 0, None, 0, 0))
    db.executemany("insert into message values (?,?,?,?,?,?,?,?)", rows)
    db.execute("insert into message values (66, null, ?, 90004, 0, null, 0, 0)", ("  {kept} [as] <it> is | streamtyped \r\n",))  # text in the blob column
    rows.append((66,))
    db.executemany("insert into chat_message_join values (?,?)", [(1 if r[0] < 60 else 2, r[0]) for r in rows])
    db.execute("insert into message_attachment_join values (65, 1)")
    db.commit()
    db.close()
    return path


def test_source(spark, database):
    assert table_exists(database, "chat") and not table_exists(database, "nope")
    assert "attributedbody" in table_columns(database, "message")
    src = read_tables(spark, database, (*TABLES, "nope"))
    assert set(src) == set(TABLES) and src["message"].count() == 21


def test_labels(spark, database):
    src = read_tables(spark, database, TABLES)
    got = {r["chat_id"]: r["contact_label"] for r in K.one_to_one_chats(src["chat"], src["chat_handle_join"], src["handle"]).collect()}
    assert got == {1: "one@x.test", 2: "two@x.test", 4: ""}
    assert K.exclude(K.one_to_one_chats(src["chat"], src["chat_handle_join"], src["handle"]), [" one@x.test ", ""]).count() == 2


def test_records(spark, database, tmp_path):
    got = extract(read_tables(spark, database, TABLES))
    rows = got.records.orderBy("line").collect()
    assert len(rows) == 6 and {r["contact_label"] for r in rows} == {"one@x.test"}
    assert "question 0\nand more" in {r["user"] for r in rows}
    s = got.stats().first().asDict()
    assert s == {"clean_text": 17, "clean_attributed_body": 2, "low_confidence": 0, "reactions": 1, "media_only": 1, "empty_text": 1, "junk_pairs": 1}
    assert "{kept} [as] <it> is | streamtyped" in {r["text"] for r in got.rows.collect()}
    assert E.format_stats(got.stats().first()) == (
        "Extraction stats: message.text=17, clean_attributedBody=2, low_confidence_attributed_dropped=0, reaction_or_effect_dropped=1, media_only_dropped=1, empty_text_dropped=1, junk_pairs_dropped=1"
    )
    path = str(tmp_path / "deep" / "out.jsonl")
    assert write_file(got.records, path) == 6
    assert [x for x in open(path, encoding="utf-8").read().split("\n") if x] == sorted(r["line"] for r in rows)
    assert load_strict(spark, path).count() == 6
    assert extract(read_tables(spark, database, TABLES), G.Config(min_contact_pairs=7)).records.count() == 0
    assert extract(read_tables(spark, database, TABLES), G.Config(excluded_contact_labels=("one@x.test",), min_contact_pairs=1)).records.count() == 1


def test_command_line(spark, database, tmp_path, capsys, monkeypatch):
    from turnmill import cli

    monkeypatch.setattr(cli, "clean", lambda: None)  # the session goes on
    out = tmp_path / "out.jsonl"
    assert cli.main([database, str(out), "--min-contact-pairs", "5", "--metadata-host", "nowhere.example"]) == 0
    said = capsys.readouterr().out
    assert f"Wrote 6 reply pairs to {out}\nExtraction stats: message.text=17, " in said and len(out.read_text().splitlines()) == 6


def test_strict_reader_numbers_blocks(spark, tmp_path):
    """A file of many blocks: numbers go on from block to block, blank lines count."""
    ok = '[{"role":"user","content":"%s"},{"role":"assistant","content":"b"}]'
    lines = ["" if i % 7 == 3 else ok % (i * "x") for i in range(400)]
    p = tmp_path / "many.jsonl"
    p.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        got = {r["line_no"]: len(r["messages"][0]["content"]) for r in load_strict(spark, str(p)).collect()}
        assert got == {i + 1: i for i in range(400) if i % 7 != 3}
        lines[390], lines[50] = "[]", "{"
        p.write_text("\n".join(lines) + "\n")
        with pytest.raises(ValueError, match="line 51: not JSON"):
            load_strict(spark, str(p))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_strict_reader_names_the_line(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('[{"role":"user","content":"a"},{"role":"assistant","content":"b"}]\n\n[1]\n')
    with pytest.raises(ValueError, match="line 3"):
        load_strict(spark, str(p))
    p.write_text("\n")
    with pytest.raises(ValueError, match="no examples"):
        load_strict(spark, str(p))


def test_turns_over_midnight(spark):
    rows = [(1, "c", i, 86_000.0 + 300 * i, i % 50 < 25, f"t{i}") for i in range(400)]
    df = spark.createDataFrame(rows, "chat_id long, contact_label string, message_id long, ts double, me boolean, text string")
    got = E.turns(df).orderBy("start_ts").collect()
    assert len(got) == 16 and all(len(r["message_ids"]) == 25 for r in got)
    assert got[3]["message_ids"] == list(range(75, 100)) and got[3]["text"].split("\n")[0] == "t75"
    assert E.pairs(E.turns(df), clean=False).count() == 7
    assert E.turns(df, 299).count() == 400 and E.turns(df.limit(0)).count() == 0


def test_first_chat_keeps_the_record(spark):
    p = spark.createDataFrame([(9, "late", "a", "b"), (2, "early", "a", "b"), (3, "early", "c", "d")], "chat_id long, contact_label string, user string, assistant string")
    got = E.dedupe(p)
    assert {(r["contact_label"], r["user"]) for r in got.collect()} == {("early", "a"), ("early", "c")}
    assert E.contact_minimum(got, 2).count() == 2 and E.contact_minimum(got, 3).count() == 0


def test_sample_positions(spark):
    chats = spark.range(50).select(F.col("id").alias("chat_id"), F.concat(F.lit("l"), F.lpad((F.lit(49) - F.col("id")).cast("string"), 2, "0")).alias("contact_label"))
    import random

    want = {49 - i for i in random.Random(7).sample(range(50), 9)}
    assert {r["chat_id"] for r in K.sample(chats, 9, 7).collect()} == want
    assert K.sample(chats, 50, 7).count() == 50 and K.sample(chats, None, 7).count() == 50


def test_splits(spark):
    import random

    df = spark.range(100).select(F.col("id").alias("k"))
    order = list(range(100))
    random.Random(42).shuffle(order)
    got = {r["k"] for r in T.split_seeded(df, ["k"]).where("split = 'validation'").collect()}
    assert got == set(order[:2])
    with pytest.raises(ValueError):
        T.split_seeded(df.limit(1), ["k"])
    with pytest.raises(ValueError):
        T.split_seeded(df, ["k"], 1.0)


def test_history_resets_and_ends(spark):
    said = [("user", "hi"), ("assistant", "yo"), ("user", " RESET "), ("user", "again"), ("user", ""), ("assistant", "ok"), ("user", "Exit"), ("user", "lost")]
    df = spark.createDataFrame([("k", i, r, c) for i, (r, c) in enumerate(said)], "key string, n int, role string, content string")
    got = [[m["content"] for m in r["history"]] for r in T.histories(df, "key", "n").orderBy("n").collect()]
    assert got == [["hi"], ["hi", "yo"], ["again"], ["again", "ok"]]
    said = [("user", " hi\t"), ("assistant", ""), ("assistant", " yo "), ("user", "\treset\n"), ("user", "\u3000"), ("assistant", "reset"), (None, "x"), ("user", None)]
    df = spark.createDataFrame([("k", i, r, c) for i, (r, c) in enumerate(said)], "key string, n int, role string, content string")
    got = [[m["content"] for m in r["history"]] for r in T.histories(df, "key", "n").orderBy("n").collect()]
    assert got == [["hi"], ["hi", ""], ["hi", "", " yo "], ["reset"], ["reset", "x"]]


def test_totals(spark):
    df = lambda n: spark.range(n)
    assert tuple(T.totals(df(1000)).first()) == (1000, 980, 20, 16) and tuple(T.totals(df(3), 0.5, 2, 4).first()) == (3, 2, 1, 8)
    with pytest.raises(Exception, match="no example"):
        T.totals(df(1)).collect()
    for bad in ({"val_size": 0.0}, {"batch_size": 0}, {"accumulation": 0}, {"max_length": 0}, {"epochs": 0}):
        with pytest.raises(ValueError):
            T.check_settings(**bad)


def test_config(tmp_path):
    p = tmp_path / "c.json"
    p.write_text(json.dumps({"seed": 7, "excluded_contact_labels": ["a"]}))
    c = G.resolve({"seed": None, "min_contact_pairs": 2}, G.load(str(p)))
    assert (c.seed, c.min_contact_pairs, c.merge_gap_seconds, c.excluded_contact_labels) == (7, 2, 600, ("a",))
    for bad in ({"seed": True}, {"nope": 1}, [], {"excluded_contact_labels": "a"}):
        p.write_text(json.dumps(bad))
        with pytest.raises(ValueError):
            G.load(str(p))
    with pytest.raises(FileNotFoundError) as e:
        G.load(str(tmp_path / "none.json"))
    assert "Copy" not in str(e.value)
    (tmp_path / G.EXAMPLE).write_text("{}")
    with pytest.raises(FileNotFoundError, match="Copy"):
        G.load(str(tmp_path / "none.json"))
    assert G.resolve({"metadata_hosts": ["a.b"]}, {}).metadata_hosts == ("a.b",)
    for bad in ({"min_contact_pairs": 0}, {"merge_gap_seconds": -1}, {"limit_chats": 0}):
        with pytest.raises(ValueError):
            G.resolve(bad, {})


def test_components(spark):
    edges = [(str(i), str(i + 1)) for i in range(100, 160)] + [("a", "b"), ("b", "c"), ("z", "z"), (None, "q")] + [("hub", f"n{i}") for i in range(50)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a string, b string")).collect()}
    assert {got[str(i)] for i in range(100, 161)} == {"100"} and got["c"] == "a" and got["z"] == "z" and got["n7"] == got["hub"] == "hub" and "q" not in got
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0


@pytest.mark.parametrize("name", sorted(set(oracle.SQL) - set(TEXT_QUERIES)))
def test_against_sql(spark, name):
    db = duckdb.connect()
    for t in (*TABLES, "reply_pair", "pair_line"):
        db.execute(f"create view {t} as from '{ROOT}/{t}.parquet'")
    want = db.execute(oracle.SQL[name])
    cols = [d[0] for d in want.description]
    shown = lambda r: repr(tuple(round(x, 9) if isinstance(x, float) else x for x in r))
    assert sorted(map(shown, want.fetchall())) == sorted(shown(r) for r in QUERIES[name](spark, ROOT).select(*[f"`{c}`" for c in cols]).collect())
