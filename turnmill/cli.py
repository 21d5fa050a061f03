"""python -m turnmill.cli: chat database to JSON lines."""

from __future__ import annotations

import argparse
from pathlib import Path

from pyspark.sql import SparkSession

from turnmill.plans import config as C
from turnmill.plans.extract import format_stats
from turnmill.plans.pipeline import TABLES, extract, source_tables
from turnmill.session import clean
from turnmill.sources.jsonl import write_file, write_folder
from turnmill.sources.sqlite import read_tables


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("source", help="SQLite database, or a folder of parquet tables")
    p.add_argument("output", help="a .jsonl file, or a folder to be written in parallel")
    p.add_argument("--config")
    p.add_argument("--min-contact-pairs", type=int)
    p.add_argument("--merge-gap-seconds", type=int)
    p.add_argument("--seed", type=int)
    p.add_argument("--limit-chats", type=int)
    p.add_argument("--metadata-host", action="append", dest="metadata_hosts", help="a host name that marks serialized metadata")
    p.add_argument("--exclude-contact-label", action="append", dest="excluded_contact_labels")
    a = vars(p.parse_args(argv))
    source, output, path = a.pop("source"), a.pop("output"), a.pop("config")
    settings = C.resolve(a, C.load(path))
    if not Path(source).exists():
        p.error(f"no database at {source}")
    spark = SparkSession.builder.getOrCreate()
    src = source_tables(spark, source) if Path(source).is_dir() else read_tables(spark, source, TABLES)
    got = extract(src, settings)
    n = (write_file if output.endswith(".jsonl") else write_folder)(got.records, output)
    print(f"Wrote {n} reply pairs to {output}")
    print(format_stats(got.stats().first()))
    clean()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
