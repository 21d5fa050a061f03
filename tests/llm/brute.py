"""Plain Python statements of the list queries, for small inputs."""

from __future__ import annotations

import json
import plistlib
import unicodedata
from collections import Counter, defaultdict

WS = set(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def punct(c):
    return unicodedata.category(c)[0] == "P"


def bare(s):
    return "".join(c for c in s.lower() if not punct(c) and c not in WS)


def words(s):
    return "".join(c for c in s.lower() if not punct(c)).split()


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def shows(s):
    return s is not None and any(c not in WS and c != "￼" for c in s)


def stored(b):
    if not b:
        return None
    b = bytes(b)
    if b.startswith(b"bplist00"):
        try:
            v = plistlib.loads(b).get("NS.string")
        except Exception:
            return None
        return v.decode("utf-8", "replace") if isinstance(v, bytes) else v
    mark = b"NSString\x01\x94\x84\x01\x2b"
    at = b.find(mark)
    if at < 0:
        return None
    at += len(mark)
    n = b[at]
    at += 1
    if n == 0x81:
        n = b[at] + 256 * b[at + 1]
        at += 2
    return b[at : at + n].decode("utf-8", "replace")


def row_text(text, body):
    if shows(text):
        return text
    s = stored(body)
    return s if shows(s) else None


def plain(m):
    return not (m["associated_message_guid"] or m["balloon_bundle_id"] or m["expressive_send_style_id"] or m["associated_message_type"] or m["item_type"])


def p1(pairs):
    recs = []
    for r in pairs:
        w = words("\n".join((m["content"] or "") for m in (r["messages"] or [])))
        if len(w) >= 12:
            recs.append((r["pair_id"], r["split"], w))
    out = set()
    train = [r for r in recs if r[1] == "train"]
    for i, s, w in recs:
        if s not in ("validation", "test"):
            continue
        cw = Counter(w)
        for j, _, v in train:
            k = max(len(w), len(v)) // 10
            if abs(len(w) - len(v)) > k or max(len(w), len(v)) - sum((cw & Counter(v)).values()) > 2 * k:
                continue
            if edits(w, v) <= k:
                out.add((min(i, j), max(i, j)))
    return out


def p2(lines, messages, links):
    sets = defaultdict(list)
    for r in lines:
        try:
            x = json.loads(r["line"])
            assert isinstance(x, list) and len(x) == 2 and [m["role"] for m in x] == ["user", "assistant"] and all(isinstance(m["content"], str) for m in x)
        except Exception:
            continue
        sets["pair_line", *(bare(m["content"]) for m in x)].append(r["line_id"])
    by = {m["rowid"]: m for m in messages}
    for c, i in {(x["chat_id"], x["message_id"]) for x in links}:
        m = by.get(i)
        if m and plain(m) and m["text"] and len(b := bare(m["text"])) >= 20:
            sets["message", c, bool(m["is_from_me"]), b].append(i)
    return {(k[0], min(v), x) for k, v in sets.items() for x in v if x != min(v)}


def chat_rows(messages, links, members, handles):
    known = {h["rowid"] for h in handles}
    who = defaultdict(set)
    for x in members:
        if x["handle_id"] in known:
            who[x["chat_id"]].add(x["handle_id"])
    by = {m["rowid"]: m for m in messages}
    chats = defaultdict(list)
    for c, i in {(x["chat_id"], x["message_id"]) for x in links}:
        m = by.get(i)
        if m and len(who[c]) == 1 and plain(m) and m["date"]:
            t = m["date"] if m["date"] > 1e14 else m["date"] * 10**9
            chats[c].append((t, i, bool(m["is_from_me"]), row_text(m["text"], m["attributedbody"])))
    return {c: sorted(v) for c, v in chats.items()}


def p3(chats, attached):
    out = set()
    for c, rows in chats.items():
        talks = []
        for r in rows:
            if not talks or r[0] - talks[-1][-1][0] > 3600 * 10**9:
                talks.append([])
            talks[-1].append(r)
        for talk in talks:
            if any(r[3] is None and r[1] not in attached for r in talk):
                continue
            turns = []
            for r in talk:
                if r[3] is None:
                    continue
                if not turns or turns[-1][-1][2] != r[2] or r[0] - turns[-1][-1][0] > 600 * 10**9:
                    turns.append([])
                turns[-1].append(r)
            if any(not a[0][2] and b[0][2] for a, b in zip(turns, turns[1:])):
                out |= {(c, turns[0][0][1], k, t[0][1], t[-1][1]) for k, t in enumerate(turns, 1)}
    return out


def p4(pairs):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for r in pairs:
        up[find(("r", r["pair_id"]))] = find(("r", r["pair_id"]))
        s = "".join(ch for ch in (r["contact_label"] or "").lower() if ch not in WS)
        if s:
            key = s if any(unicodedata.category(ch)[0] == "L" for ch in s) else "".join(ch for ch in s if ch.isdecimal()).lstrip("0")
            if key:
                up[find(("r", r["pair_id"]))] = find(("c", key))
        both = [m["content"] or "" for m in (r["messages"] or [])]
        if len(words("\n".join(both))) >= 12:
            up[find(("r", r["pair_id"]))] = find(("t", *map(bare, both)))
    groups = defaultdict(list)
    for r in pairs:
        groups[find(("r", r["pair_id"]))].append(r["pair_id"])
    return {(min(v), x) for v in groups.values() for x in v if x != min(v)}


def p6(chats):
    out = set()
    for c, rows in chats.items():
        run = []

        def close(run=run):
            pass

        runs = []
        for t, i, me, s in rows:
            if s is None:
                continue
            e = bare(s) or "".join(ch for ch in s.lower() if ch not in WS)
            if runs and runs[-1][-1][2] == me and t - runs[-1][-1][0] <= 600 * 10**9:
                p = runs[-1][-1][3]
                k = max(len(e), len(p)) // 10
                if e == p or (abs(len(e) - len(p)) <= k and k and edits(e, p) <= k):
                    runs[-1].append((t, i, me, e))
                    continue
            runs.append([(t, i, me, e)])
        out |= {(c, r[0][1], r[-1][1]) for r in runs if len(r) > 1}
    return out


def p9(docs, items):
    grams = defaultdict(set)
    norm = lambda s: [w for w in ("".join(c for c in x if c.isalnum()) for x in s.lower().split()) if w]
    for r in items:
        for part in (r["prompt"], r["reference"]):
            w = norm(part or "")
            for i in range(len(w) - 11):
                grams[tuple(w[i : i + 12])].add(r["item_id"])
    out = set()
    for r in docs:
        w = norm(r["text"] or "")
        for i in range(len(w) - 11):
            out |= {(r["doc_id"], x) for x in grams.get(tuple(w[i : i + 12]), ())}
    return out
