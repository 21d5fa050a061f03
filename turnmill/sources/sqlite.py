"""SQLite tables as a Python data source, read in ranges of rowid."""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

# Declared types to Spark types; others are read as strings.
_TYPES = {"INTEGER": "bigint", "INT": "bigint", "BIGINT": "bigint", "TEXT": "string", "VARCHAR": "string", "BLOB": "binary", "REAL": "double", "FLOAT": "double", "DOUBLE": "double"}

#: What is added to a BLOB column's name for the text in it.
TEXT_OF = "_text"


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def table_columns(path: str, name: str) -> dict[str, str]:
    """Lower-case column names and Spark types; empty if there is no such table."""
    with _open(path) as db:
        if not table_exists(path, name):
            return {}
        found = {r[1].lower(): _TYPES.get(r[2].upper().split("(")[0], "string") for r in db.execute(f'PRAGMA table_info("{name}")')}
    return found if "rowid" in found else {"rowid": "bigint", **found}


def table_exists(path: str, name: str) -> bool:
    with _open(path) as db:
        return db.execute("SELECT 1 FROM sqlite_master WHERE type = 'table' AND name = ?", (name,)).fetchone() is not None


class _Range(InputPartition):
    def __init__(self, low: int, high: int) -> None:
        self.low, self.high = low, high


class _Reader(DataSourceReader):
    def __init__(self, schema, options) -> None:
        self.names, self.kinds = schema.fieldNames(), [f.dataType.simpleString() for f in schema.fields]
        self.blobs = {c for c, k in table_columns(options["path"], options["table"]).items() if k == "binary"}
        self.path, self.name, self.parts = options["path"], options["table"], int(options.get("partitions", 8))

    def partitions(self) -> list[_Range]:
        with _open(self.path) as db:
            low, high = db.execute(f'SELECT min(rowid), max(rowid) FROM "{self.name}"').fetchone()
        if low is None:
            return []
        step = max(1, -(-(high - low + 1) // self.parts))
        return [_Range(a, min(a + step, high + 1)) for a in range(low, high + 1, step)]

    def blob_part(self, c: str) -> str:
        """SQL of a column: of a BLOB column the bytes, and the text under ``c_text``."""
        if c in self.blobs:
            return f"""CASE WHEN typeof("{c}") <> 'text' THEN "{c}" END"""
        if c.endswith(TEXT_OF) and (own := c[: -len(TEXT_OF)]) in self.blobs:
            return f"""CASE WHEN typeof("{own}") = 'text' THEN "{own}" END"""
        return f'"{c}"'

    def read(self, part: _Range) -> Iterator[tuple]:
        as_kind = {"string": lambda v: v if isinstance(v, str) else v.decode("utf-8", "replace") if isinstance(v, bytes) else str(v), "bigint": int, "double": float, "binary": lambda v: v.encode() if isinstance(v, str) else v}
        cols = ", ".join(self.blob_part(c) for c in self.names)
        with _open(self.path) as db:
            db.text_factory = lambda b: b.decode("utf-8", "replace")
            for row in db.execute(f'SELECT {cols} FROM "{self.name}" WHERE rowid >= ? AND rowid < ?', (part.low, part.high)):
                yield tuple(None if v is None else as_kind[k](v) for v, k in zip(row, self.kinds))


class SqliteSource(DataSource):
    """``spark.read.format("sqlite_table").option("path", p).option("table", t).load()``; the file must be on a folder that all workers see.

    A BLOB column ``c`` may hold text in some rows: that comes as ``c_text``,
    and ``c`` is null there.
    """

    @classmethod
    def name(cls) -> str:
        return "sqlite_table"

    def schema(self) -> str:
        cols = table_columns(self.options["path"], self.options["table"])
        if not cols:
            raise ValueError(f"no table {self.options['table']}")
        return ", ".join([f"`{c}` {t}" for c, t in cols.items()] + [f"`{c}{TEXT_OF}` string" for c, t in cols.items() if t == "binary" and c + TEXT_OF not in cols])

    def reader(self, schema) -> _Reader:
        return _Reader(schema, self.options)


def read_tables(spark, path: str, names) -> dict:
    """Frames of those ``names`` that exist in the database."""
    from turnmill.session import ship

    ship(spark)
    spark.dataSource.register(SqliteSource)
    return {n: spark.read.format("sqlite_table").option("path", path).option("table", n).load() for n in names if table_exists(path, n)}
