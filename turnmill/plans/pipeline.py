"""The whole extraction, from source tables to records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from turnmill.plans import chats as K
from turnmill.plans import extract as E
from turnmill.plans.config import Config
from turnmill.session import cut, table

TABLES = ("chat", "handle", "chat_handle_join", "message", "chat_message_join", "message_attachment_join")


@dataclass
class Extraction:
    rows: DataFrame
    pairs: DataFrame
    records: DataFrame

    def stats(self) -> DataFrame:
        return E.stats(self.rows, self.pairs)


def selected(src: dict[str, DataFrame], config: Config) -> DataFrame:
    """Chats after exclusion, then sampling."""
    return K.sample(K.exclude(K.one_to_one_chats(src["chat"], src["chat_handle_join"], src["handle"]), list(config.excluded_contact_labels)), config.limit_chats, config.seed)


def extract(src: dict[str, DataFrame], config: Config = Config()) -> Extraction:
    """Records (contact_label, line, user, assistant) of the source tables.

    ``src`` maps the names in TABLES to frames; the attachment table may be
    missing. Sort ``records`` by line for the file's order. The classified
    rows are written once, for the records and for the counters; like every
    query that cuts its lineage, this runs jobs while it is built.
    """
    rows = E.classified(src["message"], src["chat_message_join"], selected(src, config), src.get("message_attachment_join"), config.metadata_hosts)
    rows = E.with_text(cut(rows.drop("text")))
    p = E.pairs(E.turns(E.kept(rows), config.merge_gap_seconds), config.metadata_hosts)
    return Extraction(rows, p, E.contact_minimum(E.dedupe(p.where("accepted")), config.min_contact_pairs))


def source_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The source tables as parquet under ``root``."""
    return {t: table(spark, root, t) for t in TABLES}


def records(spark: SparkSession, root: str) -> DataFrame:
    """The flagship query: all records with default settings."""
    return extract(source_tables(spark, root)).records.select("contact_label", "line", F.length("user").alias("user_chars"), F.length("assistant").alias("assistant_chars"))
