"""Queries of the chat-log operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.functions import body as B
from turnmill.functions import clock as C
from turnmill.functions import text as X
from turnmill.functions.jsonl import line_of
from turnmill.plans import chats as K
from turnmill.plans import extract as E
from turnmill.plans import pipeline as P
from turnmill.plans import training as T
from turnmill.session import table
from turnmill.sources.jsonl import checked

#: Texts that meet each rule, added to the table's own under the ids -1, -2, ... so that no rule is checked on texts alone that it never meets.
SAMPLES = (
    "Your login code is 402113", "use 88213 as your one-time password", "55120 is your security number", "Msg & data rates may apply", "Reply STOP to end",
    "free msg: hello", "Message blocking is active", "tracking number 12", "shipment 5 was delivered today", "not delivered", "a $null b",
    "one http://a.example/x two https://b.example/y", "6F9619FF-8B86-D011-B42D-00C04FC964FF", "see 6F9619FF-8B86-D011-B42D-00C04FC964FF in the list of all things",
    "$classname", "NSValue", "streamtyped hello", "nsomething", "{a}[b]<c>", "x", "  padded\r\n\r\n\r\n\r\nlines \r", "", "...", "https://c.example/users/12",
    "TimeDuration 5", "bplist00 nsdata", "ok\x01fine", " \t\n", "\n-6F9619FF-8B86-D011-B42D-00C04FC964FF\r",
)


def _texts(spark: SparkSession, root: str) -> DataFrame:
    more = spark.createDataFrame([(-1 - i, t) for i, t in enumerate(SAMPLES)], "rowid long, text string")
    return table(spark, root, "message").select("rowid", "text").unionByName(more)


def normalize_text(spark, root):
    return _texts(spark, root).select("rowid", X.normalize(F.col("text")).alias("norm"))


def junk_flag(spark, root):
    return _texts(spark, root).select("rowid", X.is_junk(F.col("text")).alias("junk"))


def junk_by_rule(spark, root):
    flags = [F.count_if(X.junk_rule(F.col("text"), n)).alias(f"rule_{n}") for n in range(len(X.JUNK_PATTERNS))]
    return _texts(spark, root).agg(*flags)


def metadata_flag(spark, root):
    return _texts(spark, root).select("rowid", X.is_metadata(F.col("text")).alias("metadata"))


def human_candidate(spark, root):
    return _texts(spark, root).select("rowid", X.is_human(F.col("text")).alias("human"))


def text_scores(spark, root):
    t = F.coalesce("text", F.lit(""))
    return _texts(spark, root).select("rowid", X.marker_hits(t).alias("markers"), X.control_ratio(t).alias("control_ratio"), X.alnum_count(t).alias("alnum"), F.length(t).alias("chars"))


def url_uuid_counts(spark, root):
    t = F.coalesce("text", F.lit(""))
    return _texts(spark, root).select("rowid", X.url_count(t).alias("urls"), X.uuid_count(t).alias("uuids"))


def clock_unix(spark, root):
    return table(spark, root, "message").select("rowid", C.to_unix(F.col("date")).alias("ts"))


def effect_filter(spark, root):
    m = table(spark, root, "message")
    return m.where(~E.is_effect(m)).select("rowid", (F.coalesce("is_from_me", F.lit(0)) != 0).alias("me"))


def attachment_flag(spark, root):
    m = table(spark, root, "message").select(F.col("rowid").alias("message_id"))
    return E.attachment_flags(m, table(spark, root, "message_attachment_join")).select("message_id", "has_attachment")


def _chats(spark, root):
    return K.one_to_one_chats(table(spark, root, "chat"), table(spark, root, "chat_handle_join"), table(spark, root, "handle"))


def one_to_one_chats(spark, root):
    return _chats(spark, root)


EXCLUDED = ["chat_1", "+999 000 000 017", "  "]


def exclude_labels(spark, root):
    return K.exclude(_chats(spark, root), EXCLUDED)


def sample_chats(spark, root):
    return K.sample(_chats(spark, root), 20, 42)


def _rows(spark, root):
    s = P.source_tables(spark, root)
    return E.classified(s["message"], s["chat_message_join"], _chats(spark, root), s["message_attachment_join"])


def message_rows(spark, root):
    return E.kept(_rows(spark, root))


def turns_gap(spark, root):
    t = E.turns(E.kept(_rows(spark, root)))
    return t.select("chat_id", "contact_label", "me", "start_ts", "end_ts", F.col("message_ids")[0].alias("first_id"), F.size("message_ids").alias("n"), "text")


def _pairs(spark, root, clean=True):
    return E.pairs(E.turns(E.kept(_rows(spark, root))), clean=clean)


def reply_pairs(spark, root):
    return _pairs(spark, root).select("chat_id", "contact_label", "user", "assistant", "accepted")


def dedupe_pairs(spark, root):
    return E.dedupe(_pairs(spark, root).where("accepted")).select("contact_label", "user", "assistant")


def contact_minimum(spark, root):
    return E.contact_minimum(E.dedupe(_pairs(spark, root).where("accepted"))).groupBy("contact_label").agg(F.count("*").alias("records"))


def pair_pipeline(spark, root):
    got = P.extract(P.source_tables(spark, root))
    return got.records.select("contact_label", "user", "assistant")


def extraction_stats(spark, root):
    got = P.extract(P.source_tables(spark, root))
    return got.stats()


def body_recover(spark, root):
    return table(spark, root, "message").select("rowid", B.recover(F.col("attributedbody")).alias("text"))


def jsonl_lines(spark, root):
    m = F.transform("messages", lambda x: F.struct(x["role"].alias("role"), F.coalesce(x["content"], F.lit("")).alias("content")))
    return table(spark, root, "reply_pair").where("messages is not null").select("pair_id", line_of(m).alias("line"))


def validate_jsonl(spark, root):
    return checked(table(spark, root, "pair_line").select("line_id", "line"), "line").select("line_id", F.col("problem").isNull().alias("valid"), F.col("messages")[0]["content"].alias("user"), F.col("messages")[1]["content"].alias("assistant"))


def prompt_completion(spark, root):
    e = table(spark, root, "reply_pair").where("messages is not null and size(messages) = 2").select("pair_id", T.prompt_completion(F.col("messages")).alias("e"))
    return e.select("pair_id", F.col("e.prompt")[0]["role"].alias("prompt_role"), F.col("e.prompt")[0]["content"].alias("prompt"), F.col("e.completion")[0]["role"].alias("completion_role"), F.col("e.completion")[0]["content"].alias("completion"))


def prompt_text(spark, root):
    return table(spark, root, "reply_pair").where("messages is not null").select("pair_id", T.prompt_text(F.col("messages")).alias("prompt"))


def _spoken(spark, root):
    return table(spark, root, "reply_pair").select("pair_id", F.posexplode("messages").alias("turn", "m")).select("pair_id", "turn", F.col("m.role").alias("role"), F.col("m.content").alias("content"))


def prompt_history(spark, root):
    return T.histories(_spoken(spark, root), "pair_id", "turn").select("pair_id", "turn", T.prompt_text(F.col("history")).alias("prompt"))


def training_totals(spark, root):
    return T.totals(checked(table(spark, root, "pair_line").select("line_id", "line"), "line").where("problem is null"))


def split_hashed(spark, root):
    return T.split_hashed(table(spark, root, "reply_pair").select("pair_id"), F.col("pair_id").cast("string"))


def split_seeded(spark, root):
    return T.split_seeded(table(spark, root, "reply_pair").select("pair_id"), ["pair_id"])


NAMES = (
    "normalize_text junk_flag junk_by_rule metadata_flag human_candidate text_scores url_uuid_counts clock_unix effect_filter attachment_flag one_to_one_chats exclude_labels sample_chats message_rows turns_gap "
    "reply_pairs dedupe_pairs contact_minimum pair_pipeline extraction_stats body_recover jsonl_lines validate_jsonl prompt_completion prompt_text prompt_history training_totals split_hashed split_seeded"
).split()
QUERIES = {n: globals()[n] for n in NAMES} | {"records": P.records}
