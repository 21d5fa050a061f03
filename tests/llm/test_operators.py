"""Operators without lists, on hand-made values and round trips."""

import os

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from turnmill.llm import encoding, leaks, overlap, packing, personal, pieces, splits
from turnmill.llm.overlap import word_distance
from turnmill.llm.tokens import FILE, FOLDER, tokenizer

tokens = pytest.mark.skipif(not os.path.exists(os.path.join(FOLDER, FILE)), reason="no tokenizer files")


@given(st.lists(st.sampled_from("abc"), max_size=14), st.lists(st.sampled_from("abc"), max_size=14), st.integers(0, 5))
@settings(max_examples=400, deadline=None)
def test_word_distance(a, b, limit):
    from brute import edits

    d = edits(a, b)
    assert word_distance(a, b, limit) == (d if d <= limit else -1)


@given(st.lists(st.sampled_from("abcdefgh"), min_size=12, max_size=45), st.lists(st.tuples(st.integers(0, 44), st.sampled_from(["in", "out", "for"])), max_size=5))
@settings(max_examples=300, deadline=None)
def test_chained_seeds(a, changes):
    """Texts within the limit share a seed, and its extension is an alignment within the limit; others give none."""
    import pandas as pd
    from brute import edits

    b = list(a)
    for at, how in changes:
        at %= len(b)
        b[at : at + (how != "in")] = ["x"] * (how != "out")
    if len(b) < 12:
        return
    limit, d = max(len(a), len(b)) // 10, edits(a, b)
    both = overlap.fingerprints(pd.Series(["q " * 20 + "q", " ".join(a), " ".join(b), " ".join(a)])).to_dict("records")
    x, y = (list(zip(r["hs"], r["ats"])) for r in both[1:3])
    assert list(zip(both[3]["hs"], both[3]["ats"])) == x
    seeds = [(i, j) for h, i in x for g, j in y if h == g]
    w = max(both[1]["win"], both[2]["win"])
    near = {i for i, j in seeds if abs(i - j) + abs(len(a) - len(b) - i + j) <= limit}
    assert d > limit or w * len(near) >= max(len(a), len(b)) - overlap.GRAM - w + 2 - (overlap.GRAM + w - 1) * limit
    got = overlap.extended(a, b, seeds, limit)
    assert got == -1 if d > limit else bool(seeds) and d <= got <= limit


@given(st.lists(st.text("ab ", max_size=40), min_size=1, max_size=4), st.text("ab ", max_size=60))
@settings(max_examples=200, deadline=None)
def test_automaton(items, text):
    auto = leaks.Automaton()
    for i, t in enumerate(items):
        auto.add(t.split(), i)
    words = text.split()
    want = {i for i, t in enumerate(items) for k in range(len(words) - leaks.MIN_RUN + 1) if f" {' '.join(words[k : k + leaks.MIN_RUN])} " in f" {' '.join(t.split())} "}
    assert set(auto.finish().leaks(words)) == want


def test_automaton_in_blocks(spark):
    run = " ".join(f"w{i}" for i in range(14))
    items = spark.createDataFrame([(1, run, None), (2, None, f"x {run} y"), (3, "short", ""), (None, run, run)], "item_id long, prompt string, reference string")
    docs = spark.createDataFrame([(7, f"a {run} b"), (8, None), (9, ""), (10, " ".join(run.split()[:11]))], "doc_id long, text string")
    old, leaks.BLOCK_WORDS = leaks.BLOCK_WORDS, 10
    try:
        got = {tuple(r) for r in leaks.leaked(docs, items).collect()}
    finally:
        leaks.BLOCK_WORDS = old
    assert got == {(7, 1, 14, 14), (7, 2, 14, 14)}


def test_leaks_of_several_items_count_together(spark):
    """Three items that overlap in part, each in a block of its own: more than half of the words in all, less for each."""
    w = [f"w{i}" for i in range(60)]
    parts = [w[0:14], w[10:26], w[30:44]]
    items = spark.createDataFrame([(i, " ".join(p), None) for i, p in enumerate(parts)], "item_id long, prompt string, reference string")
    docs = spark.createDataFrame([(7, " - ".join(w)), (8, " ".join(w[0:14] + ["x"] * 30)), (None, " ".join(w[30:44]))], "doc_id long, text string")
    for most in (10, 400_000):
        old, leaks.BLOCK_WORDS = leaks.BLOCK_WORDS, most
        try:
            got = {(r["doc_id"], r["words"], r["covered"], r["verdict"]) for r in leaks.judged(docs, items).where("covered > 0").collect()}
        finally:
            leaks.BLOCK_WORDS = old
        assert got == {(7, 60, 40, "drop"), (8, 44, 14, "cut"), (None, 14, 14, "drop")}


def test_leaked_spans_are_removed(spark):
    run = [f"w{i}" for i in range(14)]
    items = spark.createDataFrame([(1, " ".join(run), None)], "item_id long, prompt string, reference string")
    said, tail = "İt begins 😀 --\n", "\nand ends - here " + "y " * 20
    docs = [(1, said + " -- ".join(run).upper() + "!" + tail), (2, " ".join(run) + " x"), (3, "nothing  leaked\t"), (4, None), (5, " ".join(run[:11])), (None, said + " ".join(run) + tail), (6, "")]
    got = {r["doc_id"]: r for r in leaks.judged(spark.createDataFrame(docs, "doc_id long, text string"), items).collect()}
    assert {k: (r["verdict"], r["text"]) for k, r in got.items()} == {
        1: ("cut", said + tail), 2: ("drop", None), 3: ("keep", docs[2][1]), 4: ("keep", None), 5: ("keep", docs[4][1]), None: ("cut", said + tail), 6: ("keep", ""),
    }
    a, z = got[1]["spans"][0]
    assert docs[0][1][a:z] == " -- ".join(run).upper() + "!" and got[1]["covered"] == got[2]["covered"] == 14 and got[3]["spans"] == []


@given(st.lists(st.integers(1, 64), max_size=300), st.integers(2, 12), st.sampled_from([3, 4096]))
@settings(max_examples=150, deadline=None)
def test_bins(sizes, classes, offered):
    h, out = packing.Harmonic(64, classes, "x", offered=offered), []
    for i, n in enumerate(sizes):
        out += h.put(i, 0, n)
        assert len(h.room) <= offered
    open_ = {k: len(rows) for k, (rows, _) in h.open.items()}
    assert all(n < k for k, n in open_.items() if k < classes)
    out += h.rest(True)
    bins = {}
    for b, k, counted, doc, _, n, at in out:
        assert sizes[doc] == n and (counted or k > 1)
        bins.setdefault(b, []).append((at, n, k, counted))
    assert sorted(r[3] for r in out) == list(range(len(sizes))) and None not in bins
    unfinished = 0
    for placed in bins.values():
        end = 0
        for at, n, _, _ in sorted(placed):
            assert at == end
            end = at + n
        assert end <= 64
        fixed = [k for _, _, k, counted in placed if counted]
        assert len(set(fixed)) <= 1
        unfinished += bool(fixed) and len(fixed) != fixed[0]
    assert unfinished <= len(open_)


@tokens
def test_packing_does_not_depend_on_tasks(spark):
    """Unfinished bins of many tasks meet in a second round; nulls, empty and long texts, repeated rows."""
    from pyspark.sql import functions as F

    said = [f"{'word ' * (i * 37 % 90 + 1)}" for i in range(900)] + [None, "", "long " * 700]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(said)] + [(7, said[7])], "doc_id long, text string").withColumn("bin", F.lit("x"))
    fill = []
    for tasks in (1, 24):
        got = packing.pack(df.repartition(tasks), 256, 8, second_bins=10).collect()
        assert {r["doc_id"] for r in got} == set(range(900)) | {902} and sum(r["doc_id"] == 7 for r in got) == 2
        assert sorted(r["piece"] for r in got if r["doc_id"] == 902) == [0, 1, 2]
        used = {}
        for r in got:
            used[r["bin"]] = used.get(r["bin"], 0) + r["tokens"]
        assert max(used.values()) <= 256
        fill.append(sum(used.values()) / (256 * len(used)))
        # Bins with fewer texts than their class has: one for each class and task of the second round at most.
        tasks2 = max(1, sum(r["tokens"] for r in got if r["bin"][0] == "b") // (10 * 256))
        of = {}
        for r in got:
            if r["counted"]:
                of.setdefault((r["bin"], r["class"]), []).append(r)
        assert sum(len(v) < k for (_, k), v in of.items()) <= 8 * tasks2
    assert fill[0] > 0.93 and fill[1] > 0.85
    assert packing.pack(df.limit(0)).count() == 0


@tokens
@pytest.mark.parametrize("limit,overlap", [(8, 2), (20, 0), (64, 16)])
def test_pieces_round_trip(limit, overlap):
    tok = tokenizer()
    texts = ["word " * 500, "x" * 5000, "日本語の文章です。" * 200, "a\n\nb\n\n" * 90, "One. Two! Three? " * 90 + "\r\n\r\n" + "é" * 400, "😀" * 300, " " * 900, "line\n" * 300]
    for t in texts:
        cut = pieces.Cutter(t, tok, limit, overlap)
        got = list(cut.pieces())
        assert "".join(t[a + o : z] for a, z, o, _ in got) == t
        assert all(n <= limit and tok.count(t[a:z]) == n for a, z, _, n in got)


@tokens
def test_pieces_prefer_natural_ends(spark):
    text = "\n\n".join("This is a sentence of a paragraph. And here is one more." for _ in range(30))
    df = spark.createDataFrame([(1, text), (2, "short"), (3, None), (4, "")], "doc_id long, text string").withColumn("tokens", F.lit("x"))
    got = pieces.split(df, 64, 8).orderBy("piece").collect()
    assert {r["doc_id"] for r in got} == {1} and [r["piece"] for r in got] == list(range(len(got)))
    assert all(text[: r["stop"]].endswith("\n\n") or r["stop"] == len(text) for r in got)
    with pytest.raises(ValueError):
        pieces.split(df, 10, 8)


def test_allocation():
    bundles = [(900, "a", 1), (40, "a", 10), (10, "b", 30), (3, "a", 100), (1, "b", 400)]
    total = sum(s * k for s, _, k in bundles)
    got = splits.allocate(bundles)
    assert all(sum(k for _, k in g) == b[2] for g, b in zip(got, bundles))
    share = {s: sum(dict(g).get(s, 0) * b[0] for g, b in zip(got, bundles)) / total for s, _ in splits.TARGETS}
    assert all(abs(share[s] - p) < 0.03 for s, p in splits.TARGETS)
    assert splits.allocate([]) == []


@given(st.lists(st.tuples(st.integers(1, 400), st.sampled_from("abc"), st.integers(1, 60)), max_size=60, unique_by=lambda b: b[:2]))
@settings(max_examples=150, deadline=None)
def test_allocation_is_even(bundles):
    """Every group has a split; each split's records, in all and of each profile, and the groups of each bundle are near their share."""
    got = [dict(g) for g in splits.allocate(bundles)]
    assert all(sum(g.values()) == k for g, (_, _, k) in zip(got, bundles))
    most, total = max((s for s, _, _ in bundles), default=0), sum(s * k for s, _, k in bundles)
    for s, p in splits.TARGETS:
        # Within one and a half of the largest group: whole groups allow no less in general.
        assert abs(sum(g.get(s, 0) * size for g, (size, _, _) in zip(got, bundles)) - p * total) <= 1.5 * most


def test_large_groups_are_made_up_for():
    """A group of two fifths of all records is in one split; smaller groups of its source, then any, meet the quotas; sources stay alike where they can."""
    bundles = [(900, "a", 1), (40, "a", 10), (10, "b", 30), (3, "a", 100), (1, "b", 400)]
    got = [dict(g) for g in splits.allocate(bundles)]
    for s, p in splits.TARGETS:
        for f in "ab":
            of = [(g.get(s, 0) * size, size * k) for g, (size, ff, k) in zip(got, bundles) if ff == f]
            assert abs(sum(x for x, _ in of) / sum(y for _, y in of) - p) < 0.01
    only = [(900, "a", 1), (1, "b", 1400)]
    got = [dict(g) for g in splits.allocate(only)]
    assert {s: sum(g.get(s, 0) * b[0] for g, b in zip(got, only)) for s, _ in splits.TARGETS} == {"train": 1840, "validation": 230, "test": 230}


def test_unit_flow_is_least_cost():
    """One band of equal sizes against every other placing of its groups."""
    from itertools import product

    for bundles in ([(4, "a", 1), (4, "b", 1), (4, "c", 1)], [(4, "a", 2), (4, "b", 3)], [(4, "a", 4), (4, "b", 1), (4, "c", 2)]):
        names = [s for s, _ in splits.TARGETS]

        def cost(placed, bundles=bundles):
            out = 0.0
            for s, p in splits.TARGETS:
                for f in {b[1] for b in bundles}:
                    out += abs(sum(4 * (p * k - g[s]) for g, (_, ff, k) in zip(placed, bundles) if f == ff))
                out += abs(sum(4 * (p * k - g[s]) for g, (_, _, k) in zip(placed, bundles)))
                for g, (_, _, k) in zip(placed, bundles):
                    n, own = g[s] - int(k * p + 1e-9), k * p - int(k * p + 1e-9)
                    out += sum(4 * (j - own) for j in range(1, n + 1))
            return out

        each = [[dict(zip(names, c)) for c in product(range(k + 1), repeat=3) if sum(c) == k and all(x >= int(k * p + 1e-9) for x, (_, p) in zip(c, splits.TARGETS))] for _, _, k in bundles]
        assert cost(splits.Flow().place(bundles)) <= min(map(cost, product(*each))) + 1e-6


def test_labels(spark):
    got = [r[0] for r in spark.createDataFrame([("+999 000-17",), ("0099900017",), (" A b@X.y ",), ("ab@x.y",), (" ",), (None,), ("000",)], "v string").select(splits.label_key(F.col("v"))).collect()]
    assert got == ["99900017", "99900017", "ab@x.y", "ab@x.y", None, None, None]


def test_repair():
    clean = ["the café is très naïve", "größe und straße", "mañana en el jardín", "“quoted” – text…", "поезд до станции опоздал"] * 40
    arrays = [np.zeros(b) for b in encoding.BUCKETS]
    for t in clean:
        for m in encoding._WINDOW.finditer(t):
            for order, bucket in encoding.grams(m.group()):
                arrays[order][bucket] += 1
    model = encoding.Model(tuple(arrays))
    for t in set(clean):
        assert model.repair(t)[0] < model.margin
        for read in ("cp1252", "latin-1", "mac_roman", "cp437", "cp1251"):
            back = {b: c for c, b in encoding._table(read).items()}
            hurt = "".join(back[b] for b in t.encode())
            gain, chain, fixed = model.repair(hurt)
            assert gain >= model.margin and fixed == t, (t, read, chain, fixed)
    assert model.repair("plain ascii") == (0.0, "", "plain ascii")


def test_damage_that_many_rows_share(spark):
    """A hurt text that comes as often as a seventieth of the sound ones teaches the model nothing."""
    sound = [f"it’s {a} in {b}, “{c}”, the café is très naïve" for a in ("warm", "cold", "wet") for b in ("town", "the hall", "here") for c in ("yes", "no", "ok")] * 20
    hurt = ["itÕs warm in the hall"] * 8
    df = spark.createDataFrame([(i, t, False) for i, t in enumerate([*sound, *hurt])], "message_id long, s string, broken boolean")
    got = {r["message_id"]: r["restored"] for r in encoding.repaired(df, encoding.train(df)).collect()}
    assert got == {len(sound) + i: "it’s warm in the hall" for i in range(8)}


@given(st.lists(st.text(st.sampled_from("abÀéı\x02 Ж中😀İ\xa0ß"), max_size=9), max_size=8), st.integers(1, 40))
@settings(max_examples=100, deadline=None)
def test_scores_at_once_are_those_one_by_one(texts, enough):
    model = encoding.Model(tuple(np.random.default_rng(1).integers(0, 3, b).astype(float) for b in encoding.BUCKETS))
    slow = [model.best(t) for t in texts if not t.isascii()]
    before = encoding.SCORED_AT_ONCE
    encoding.SCORED_AT_ONCE = enough
    try:
        model.learn(texts)
    finally:
        encoding.SCORED_AT_ONCE = before
    assert set(model.known) == {t for t in texts if t and len(t) == len(t.lower())}
    for t, x in model.known.items():
        assert abs(x - sum(model.parts(t))) < 1e-9
    for (g, _, _), t in zip(slow, [t for t in texts if not t.isascii()]):
        assert abs(model.best(t)[0] - g) < 1e-9


@pytest.mark.parametrize("tenths", [range(10), range(1, 10)])
def test_margin_of_all_rows(spark, tenths):
    """The margin is that of a plain ten-fold validation on every window, none sampled; also where a tenth has no rows."""
    tenth = F.pmod(F.xxhash64("message_id"), F.lit(10))
    df = encoding.strings(spark, "/root/testdata/sf0.001").where(tenth.isin(list(tenths)))
    rows = [(w, r["t"]) for r in df.where("not broken").select("s", tenth.alias("t")).collect() for w in encoding._WINDOW.findall(r["s"])]
    sound = [(w, t) for w, t in rows if not encoding.redecodable(w)]

    def model(said):
        arrays = [np.zeros(b) for b in encoding.BUCKETS]
        for w in said:
            for order, bucket in encoding.grams(w):
                arrays[order][bucket] += 1
        return encoding.Model(tuple(arrays))

    first = model([w for w, _ in sound])
    first.surprise = encoding.WARY
    counted = [(w, t) for w, t in sound if not first.best(w)[0] > 0]
    kept, hurt = [], []
    for i in tenths:
        m = model([w for w, t in counted if t != i])
        for w in {w for w, t in sound if t == i}:
            kept.append(m.best(w)[0])
            hurt += [m.best(d)[0] for d in encoding.damaged(w)]
    errors = {x / 2: 5 * sum(g >= x / 2 for g in kept) / len(kept) + sum(g < x / 2 for g in hurt) / len(hurt) for x in range(8, 41)}
    assert encoding.train(df).margin == min(errors, key=errors.get)


def test_learnt_forms(spark):
    """Street types and spellings that are no seeds, listed or not, are told by surroundings; the same forms elsewhere are not."""
    names = spark.createDataFrame([], "name_id long, name string, kind string")
    said = [f"we live at {i} Hira{x}lok Street now" for i, x in enumerate("abcdefgh", 11)] + [f"write to k{x}@post.example today" for x in "abcdefgh"]
    learnt = ["we live at 12 Hiralok Lane now", "we live at 7 Welmar Mews now", "write to kim at post dot example today", "write to kim [arobase] post [point] example today"]
    other = ["it took 12 Hiralok Players", "we met kim at post. example", "kim [who] post [what] example"]
    rows = spark.createDataFrame([("message", i, 0, t) for i, t in enumerate([*said, *learnt, *other])], "origin string, record_id long, part int, text string")
    got = {r["record_id"]: (rows_text[r["a"] : r["z"]], r["kind"]) for r in personal.scored(personal.candidates(rows, names)).where("kind is not null").collect() for rows_text in [[*said, *learnt, *other][r["record_id"]]]}
    n = len(said)
    assert set(got) == set(range(n + len(learnt)))
    assert [got[n + i] for i in range(4)] == [("12 Hiralok Lane", "address"), ("7 Welmar Mews", "address"), ("kim at post dot example", "email"), ("kim [arobase] post [point] example", "email")]


@given(st.text(st.sampled_from("ab. \n-;!x"), max_size=400), st.integers(0, 400), st.integers(0, 6))
@settings(max_examples=300, deadline=None)
def test_surroundings_look_as_far_as_they_must(text, start, length):
    start = min(start, len(text))
    end = min(start + length, len(text))
    left, right = text[:start], text[end:]
    cuts = [m.end() for m in personal._BREAK.finditer(left)]
    words = [w.lower() for w in personal._WORD.findall(left[cuts[-1] :] if cuts else left)]
    m = personal._BREAK.search(right)
    after = personal._WORD.findall(right[: m.start()] if m else right)
    assert personal._around(text, start, end) == (" ".join(["^", "^", *words][-2:]), after[0].lower() if after else "$")


def test_very_long_texts_take_linear_time():
    import time

    names = personal.Names([])
    for t in ("x" * 200_000 + " (ok)", "a.b" * 60_000 + "@", "1 " * 60_000, "word at " * 20_000 + "[dot]", "-" * 100_000 + "(at)"):
        began = time.time()
        personal.instances(t, names)
        assert time.time() - began < 20, t[:10]


def test_redaction(spark):
    names = spark.createDataFrame([(i, n, k) for i, (n, k) in enumerate([("Kerato", "given"), ("Velia", "given"), ("Trenholm", "family"), ("Ulmwick", "family")])], "name_id long, name string, kind string")
    said = ["write to a.b@c.example now", "x AT post DOT example", "call +999627054193 ok", "ssn 919 58 8791", "we live at 12 Hiralok Street now", "drop it off at Qomayajstraße 28", "i met Kerato Trenholm yesterday", "Ulmwick, Velia quit", "only Kerato here", "room 16 at 17:05 for $40", "follow @lamp_73", "version 46.20.1", None, "", "x" * 50_000]
    rows = spark.createDataFrame([("message", i, 0, t) for i, t in enumerate(said)], "origin string, record_id long, part int, text string").where("text is not null")
    got = {(r["record_id"], r["kind"]) for r in personal.scored(personal.candidates(rows, names)).where("kind is not null").collect()}
    assert got == {(0, "email"), (1, "email"), (2, "phone"), (3, "id_number"), (4, "address"), (5, "address"), (6, "name"), (7, "name")}
