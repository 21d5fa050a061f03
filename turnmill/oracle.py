"""ANSI SQL of the queries, as DuckDB runs it."""

from __future__ import annotations

#: The values that the SQL goes by. They are spelled out here, not imported, so that a wrong one in the library shows.
SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
SPACE_CLASS = r"[\t\n\v\f\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
MARKS = "streamtyped bplist nsattributedstring nsmutableattributedstring nsstring nsmutablestring nsdictionary nsdict nsnumber nsdata nsurl __kim ns.objects nskeyedarchiver".split()
PREFIXES = "ns __k ddscannerresult relativeday".split()
SERIALIZED = (r"x?nsobject", r"(?:time|date)duration", r"\$objects|\$archiver|\$version|\$top", r"fulladdress", r"https?://\S+/users/\d+", r"https?://\S+/groups/\d+")
SERVICE = (
    r"\b(?:verification|security|pass|login|otp)\s*code\b", r"\bone[- ]time\s+password\b", r"\buse\s+\d{4,8}\s+(?:as|for)\b", r"\b\d{4,8}\b.*\b(?:verification|security|pass|login|otp)\b",
    r"\b(?:msg|message|messages)\s*&\s*data rates may apply\b", r"\breply\s+(?:stop|unsubscribe|cancel|end)\b", r"\bfree msg:", r"\bmessage blocking is active\b", r"\btracking number\b",
    r"\bshipment\b.*\b(?:delivered|delivery|tracking)\b", r"\bnot delivered\b",
)
EDGE = "$#%&'()*+,-./:;<=>?@[\\]^_`{|}~"
#: The texts that the rule queries add to the table's, under the ids -1, -2, ...
ADDED = (
    "Your login code is 402113", "use 88213 as your one-time password", "55120 is your security number", "Msg & data rates may apply", "Reply STOP to end",
    "free msg: hello", "Message blocking is active", "tracking number 12", "shipment 5 was delivered today", "not delivered", "a $null b",
    "one http://a.example/x two https://b.example/y", "6F9619FF-8B86-D011-B42D-00C04FC964FF", "see 6F9619FF-8B86-D011-B42D-00C04FC964FF in the list of all things",
    "$classname", "NSValue", "streamtyped hello", "nsomething", "{a}[b]<c>", "x", "  padded\r\n\r\n\r\n\r\nlines \r", "", "...", "https://c.example/users/12",
    "TimeDuration 5", "bplist00 nsdata", "ok\x01fine", " \t\n", "\n-6F9619FF-8B86-D011-B42D-00C04FC964FF\r",
)
EXCLUDED = ("chat_1", "+999 000 000 017")


def q(s: str) -> str:
    """A string literal; control characters by chr()."""
    parts, run = [], ""
    for c in s:
        if ord(c) < 32:
            parts += [f"'{run}'"] * bool(run) + [f"chr({ord(c)})"]
            run = ""
        else:
            run += "''" if c == "'" else c
    parts += [f"'{run}'"] * bool(run or not parts)
    return "(" + " || ".join(parts) + ")" if len(parts) > 1 else parts[0]


WS = q(SPACES)
TEXTS = "texts as (select rowid, text from message union all values " + ", ".join(f"({-1 - i}, {q(t)})" for i, t in enumerate(ADDED)) + ")"


def norm(c: str) -> str:
    return f"regexp_replace(trim(regexp_replace(coalesce({c}, ''), '\\r\\n?', chr(10), 'g'), {WS}), '\\n{{3,}}', chr(10) || chr(10), 'g')"


def hit(c: str, pattern: str, flags: str = "'i'") -> str:
    return f"regexp_matches({c}, {q(pattern)}, {flags})"


def count(c: str, pattern: str, insensitive: bool = False) -> str:
    return f"len(regexp_extract_all({c}, {q(('(?i)' if insensitive else '') + pattern)}))"


UUID = r"\b[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12}\b"
URL = r"https?://\S+"


def junk(c: str) -> str:
    return f"({c} = '' or " + " or ".join(hit(c, p) for p in SERVICE) + ")"


def markers(c: str) -> str:
    return "(" + " + ".join(f"contains(lower({c}), {q(m)})::int" for m in MARKS) + ")"


def metadata(c: str) -> str:
    u = count(c, UUID, True)
    lone = rf"({u} = 1 and (regexp_full_match(ltrim({c}, {q(EDGE)}), '(?i)[0-9a-f]{{8}}(-[0-9a-f]{{4}}){{3}}-[0-9a-f]{{12}}') or 36.0 / greatest({count(c, r'[^\p{C}\p{Z}]')}, 1) >= 0.6))"
    return (
        f"({c} <> '' and (" + " or ".join(hit(c, p) for p in SERIALIZED)
        + f" or contains(lower({c}), '$null') or {count(c, URL)} >= 2 or {u} > 1 or {lone} or contains({c}, '$classname') or contains({c}, '$classes') or contains({c}, 'NSValue')))"
    )


def human(c: str) -> str:
    starts = " or ".join(f"starts_with(lower({c}), '{p}')" for p in PREFIXES)
    control = r"[\x00-\x08\x0b\x0c\x0e-\x1f]"
    return (
        f"not ({c} = '' or {markers(c)} > 0 or {metadata(c)} or regexp_matches({c}, '{control}') or length({c}) < 2 or {count(c, r'[^\p{C}\p{Z}]')} < 2 "
        + f"or {count(c, r'[\p{L}\p{N}]')} = 0 or {count(c, r'[{}\[\]<>|\\^~]')} > 2 or {starts})"
    )


UNIX = "case when date is null then 0.0::double else (case when abs(date::double) > 1e14 then date::double / 1e9 when abs(date::double) > 1e11 then date::double / 1e6 when abs(date::double) > 1e9 then date::double / 1e3 else date::double end) + 978307200e0 end"
EFFECT = "(coalesce(associated_message_guid, '') <> '' or coalesce(associated_message_type, 0) <> 0 or coalesce(item_type, 0) <> 0 or coalesce(balloon_bundle_id, '') <> '' or coalesce(expressive_send_style_id, '') <> '')"
CHATS = f"""one as (select j.chat_id, min(h.id) as handle, min(h.uncanonicalized_id) as other from chat_handle_join j join handle h on h.rowid = j.handle_id group by j.chat_id having count(distinct j.handle_id) = 1),
chats as (select c.rowid as chat_id, coalesce(trim(coalesce(nullif(other, ''), nullif(handle, ''), nullif(chat_identifier, '')), {WS}), 'chat_' || c.rowid) as contact_label from chat c join one on one.chat_id = c.rowid)"""


def _int(c: str) -> str:
    return f"('0x' || {c})::int"


def _unescaped(v: str) -> str:
    """Bytes as DuckDB writes them (printable ASCII, others as \\xHH) to runs of printable characters, TAB, CR and LF, parted by chr(1)."""
    v = rf"regexp_replace({v}, '\\x(0[0-8BCEF]|1[0-9A-F]|7F|[89A-F][0-9A-F])', chr(1), 'g')"
    for code, out in (("22", "chr(34)"), ("27", "chr(39)"), ("09", "chr(9)"), ("0A", "chr(10)"), ("0D", "chr(13)"), ("5C", "chr(92)")):
        v = f"replace({v}, '\\x{code}', {out})"
    return v


def recovered(rows: str) -> str:
    """CTEs that end in recovered(rowid, body_text): the best human text of each body in ``rows`` (rowid, body)."""
    unit = lambda i: _int(f"substr(h, pos + 4 * ({i}), 4)")
    return rf"""b as (select rowid, body::varchar as v, hex(body) as h from {rows} where body is not null),
p as (select rowid, h, substr(h, 43, 1) as kind, {_int("substr(h, 44, 1)")} as low, {_int("substr(h, 46, 1)")} as wide from b where starts_with(h, '62706C6973743030D10102594E532E737472696E67')),
pn as (select rowid, h, kind, case when low < 15 then low when wide = 0 then {_int("substr(h, 47, 2)")} when wide = 1 then {_int("substr(h, 47, 4)")} else {_int("substr(h, 47, 8)")} end as n,
  case when low < 15 then 45 when wide = 0 then 49 when wide = 1 then 51 else 55 end as pos from p),
ps as (select rowid, case kind when '5' then array_to_string(list_transform(range(n), lambda i: chr({_int("substr(h, pos + 2 * i, 2)")})), '')
  when '6' then array_to_string(list_transform(range(n), lambda i: case when {unit("i")} between 55296 and 56319 then chr(65536 + ({unit("i")} - 55296) * 1024 + {unit("i + 1")} - 56320) when {unit("i")} between 56320 and 57343 then '' else chr({unit("i")}) end), '') end as t from pn),
runs as (select rowid, string_split({_unescaped("v")}, chr(1)) as parts from b),
each as (select rowid, 1 as src, unnest(parts) as t, unnest(range(len(parts))) as idx from runs union all select rowid, 0 as src, t, 0 as idx from ps where t is not null),
normal as (select rowid, src, idx, {norm("t")} as t from each where src = 0 or length(t) >= 2),
recovered as (select rowid, t as body_text from normal where {human("t")}
  qualify row_number() over (partition by rowid order by src, {count("t", r"[\p{L}\p{N}]")} desc, {count("t", SPACE_CLASS)} desc, length(t), idx) = 1)"""


ROWS = f"""{CHATS}, att as (select distinct message_id from message_attachment_join),
said as (select j.chat_id, k.contact_label, j.message_id, {UNIX} as ts, coalesce(m.is_from_me, 0) <> 0 as me, {EFFECT} as effect, {norm("m.text")} as own_text, attributedbody as body, att.message_id is not null as has_attachment
  from chat_message_join j join chats k on k.chat_id = j.chat_id join message m on m.rowid = j.message_id left join att on att.message_id = j.message_id),
wanted as (select distinct message_id as rowid, body from said where own_text = '' and not effect), {recovered("wanted")},
classified as (select chat_id, contact_label, message_id, ts, me, effect, own_text, coalesce(body_text, '') as body_text, case when own_text <> '' then own_text else coalesce(body_text, '') end as text, body is not null as has_body, has_attachment
  from said left join recovered r on r.rowid = said.message_id),
kept as (select chat_id, contact_label, message_id, ts, me, text from classified where not effect and text <> '' and not (has_attachment and own_text = ''))"""
TURNS = f"""{ROWS}, flagged as (select *, case when lag(me) over w = me and ts - lag(ts) over w <= 600 then 0 else 1 end as brk from kept window w as (partition by chat_id order by ts, message_id)),
numbered as (select *, sum(brk) over (partition by chat_id order by ts, message_id rows unbounded preceding) as turn from flagged),
turns as (select chat_id, turn, min(contact_label) as contact_label, bool_and(me) as me, min(ts) as start_ts, max(ts) as end_ts, arg_min(message_id, struct_pack(ts := ts, id := message_id)) as first_id, count(*)::int as n,
  string_agg(text, chr(10) order by ts, message_id) as text from numbered group by chat_id, turn)"""
PAIRS = f"""{TURNS}, ahead as (select chat_id, contact_label, me, text, lead(me) over w as next_me, lead(text) over w as next_text from turns window w as (partition by chat_id order by turn)),
pairs as (select chat_id, contact_label, text as "user", next_text as assistant, not ({metadata("text")} or {metadata("next_text")} or {junk("text")} or {junk("next_text")}) as accepted from ahead where not me and next_me)"""
DEDUPED = f"""{PAIRS}, deduped as (select arg_min(contact_label, struct_pack(c := chat_id, l := contact_label)) as contact_label, "user", assistant from pairs where accepted group by "user", assistant)"""
ENOUGH = f"{DEDUPED}, enough as (select * from deduped where contact_label in (select contact_label from deduped group by contact_label having count(*) >= 5))"


def _json(c: str) -> str:
    for raw, out in (("\\", "\\\\"), ('"', '\\"'), ("\b", "\\b"), ("\t", "\\t"), ("\n", "\\n"), ("\f", "\\f"), ("\r", "\\r")):
        c = f"replace({c}, {q(raw)}, {q(out)})"
    for i in range(1, 32):
        if chr(i) not in "\b\t\n\f\r":
            c = f"replace({c}, chr({i}), '\\u{i:04x}')"
    return c


def _line(x: str) -> str:
    return f"""'{{"role":"' || {_json(x + ".role")} || '","content":"' || {_json(f"coalesce({x}.content, '')")} || '"}}'"""


VALID = f"""t as (select line_id, case when json_valid(line) then line::json end as j from pair_line where trim(line, {WS}) <> ''),
        v as (select line_id, j, coalesce(json_type(j) = 'ARRAY' and json_array_length(j) = 2 and json_type(j, '$[0]') = 'OBJECT' and json_type(j, '$[1]') = 'OBJECT' and j->>'$[0].role' = 'user' and j->>'$[1].role' = 'assistant'
          and json_type(j, '$[0].content') = 'VARCHAR' and json_type(j, '$[1].content') = 'VARCHAR', false) as valid from t)"""
NORMAL = f"with {TEXTS}, n as (select rowid, {norm('text')} as t from texts)"
LINE = f"""'[{{"role":"user","content":"' || {_json('"user"')} || '"}},{{"role":"assistant","content":"' || {_json("assistant")} || '"}}]'"""
_T = "coalesce(text, '')"
SQL = {
    "normalize_text": f"{NORMAL} select rowid, t as norm from n",
    "junk_flag": f"{NORMAL} select rowid, {junk('t')} as junk from n",
    "junk_by_rule": f"{NORMAL} select " + ", ".join(f"count(*) filter (where {hit('t', p)}) as rule_{n}" for n, p in enumerate(SERVICE)) + " from n",
    "metadata_flag": f"{NORMAL} select rowid, {metadata('t')} as metadata from n",
    "human_candidate": f"{NORMAL} select rowid, {human('t')} as human from n",
    "text_scores": f"with {TEXTS} select rowid, {markers(_T)}::int as markers, case when {_T} = '' then 1.0::double else {count(_T, r'[\x00-\x08\x0b\x0c\x0e-\x1f]')}::double / length({_T}) end as control_ratio, {count(_T, r'[\p{L}\p{N}]')}::int as alnum, length({_T})::int as chars from texts",
    "url_uuid_counts": f"with {TEXTS} select rowid, {count(_T, URL)}::int as urls, {count(_T, UUID, True)}::int as uuids from texts",
    "clock_unix": f"select rowid, {UNIX} as ts from message",
    "effect_filter": f"select rowid, coalesce(is_from_me, 0) <> 0 as me from message where not {EFFECT}",
    "attachment_flag": "select m.rowid as message_id, a.message_id is not null as has_attachment from message m left join (select distinct message_id from message_attachment_join) a on a.message_id = m.rowid",
    "one_to_one_chats": f"with {CHATS} select chat_id, contact_label from chats",
    "exclude_labels": f"with {CHATS} select chat_id, contact_label from chats where contact_label not in ({', '.join(q(x) for x in EXCLUDED)})",
    "message_rows": f"with {ROWS} select * from kept",
    "turns_gap": f"with {TURNS} select chat_id, contact_label, me, start_ts, end_ts, first_id, n, text from turns",
    "reply_pairs": f"with {PAIRS} select * from pairs",
    "dedupe_pairs": f"with {DEDUPED} select * from deduped",
    "records": f"""with {ENOUGH} select contact_label, {LINE} as line, length("user")::int as user_chars, length(assistant)::int as assistant_chars from enough""",
    "body_recover": f"""with every as (select rowid, attributedbody as body from message), {recovered("every")} select every.rowid, coalesce(body_text, '') as text from every left join recovered r on r.rowid = every.rowid""",
    "training_totals": f"""with {VALID}, c as (select count(*) as n, greatest(1, floor(count(*) * 0.02::double)::bigint) as k from v where valid) select n as total_rows, n - k as train_rows, k as val_rows, 16::bigint as effective_batch from c""",
    "contact_minimum": f"with {ENOUGH} select contact_label, count(*) as records from enough group by contact_label",
    "pair_pipeline": f"with {ENOUGH} select * from enough",
    "extraction_stats": f"""with {PAIRS} select count(*) filter (where not effect and own_text <> '') as clean_text, count(*) filter (where not effect and own_text = '' and has_body and body_text <> '') as clean_attributed_body,
        count(*) filter (where not effect and own_text = '' and has_body and body_text = '') as low_confidence, count(*) filter (where effect) as reactions, count(*) filter (where not effect and own_text = '' and body_text <> '' and has_attachment) as media_only,
        count(*) filter (where not effect and own_text = '' and body_text = '') as empty_text, (select count(*) from pairs where not accepted) as junk_pairs from classified""",
    "jsonl_lines": f"select pair_id, '[' || array_to_string(list_transform(messages, lambda x: {_line('x')}), ',') || ']' as line from reply_pair where messages is not null",
    "validate_jsonl": f"""with {VALID} select line_id, valid, case when valid then j->>'$[0].content' end as "user", case when valid then j->>'$[1].content' end as assistant from v""",
    "prompt_completion": "select pair_id, messages[1].role as prompt_role, messages[1].content as prompt, messages[2].role as completion_role, messages[2].content as completion from reply_pair where len(messages) = 2",
    "prompt_text": "select pair_id, array_to_string(list_transform(messages, lambda x: concat_ws(': ', x.role, coalesce(x.content, ''))), chr(10)) || chr(10) || 'assistant:' as prompt from reply_pair where messages is not null",
    "prompt_history": f"""with m as (select pair_id, unnest(messages) as m, unnest(range(len(messages))) as turn from reply_pair where messages is not null),
        t as (select pair_id, turn::int as turn, m.role as role, coalesce(m.role = 'user', false) as own, case when m.role = 'user' then trim(coalesce(m.content, ''), {WS}) else m.content end as content from m),
        e as (select *, max((own and lower(content) in ('exit', 'quit'))::int) over (partition by pair_id order by turn) as done, sum((own and lower(content) = 'reset')::int) over (partition by pair_id order by turn) as session from t),
        k as (select * from e where done = 0 and not (own and lower(content) in ('', 'reset')))
        select pair_id, turn, string_agg(concat_ws(': ', role, coalesce(content, '')), chr(10)) over (partition by pair_id, session order by turn) || chr(10) || 'assistant:' as prompt from k""",
    "split_hashed": f"select pair_id, case when substr(md5('42:' || pair_id), 1, 8) < '{int(0.02 * 0xFFFFFFFF):08x}' then 'validation' else 'train' end as split from reply_pair",
}
