"""SQLite databases: their tables, and scans in equal shares of rows. Files must lie where every executor can open them.

A table's rowids may be sparse, so ranges of equal width can leave nearly all rows to one task. Shares are cut where the
rowid index itself says so: a task steps along each file's index by a number of rows at a time and returns the rowids that
it lands on; the rows between them are then read by as many tasks.
"""

from __future__ import annotations

import sqlite3
from collections.abc import Iterator, Sequence
from contextlib import closing

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

_KINDS = (("INT", T.LongType(), pa.int64()), ("REAL", T.DoubleType(), pa.float64()), ("FLOA", T.DoubleType(), pa.float64()), ("DOUB", T.DoubleType(), pa.float64()))
#: Rows of a share.
SHARE = 1 << 16


def _open(path: str) -> sqlite3.Connection:
    return sqlite3.connect(f"file:{path}?mode=ro", uri=True)


def _quoted(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def table_names(path: str) -> list[str]:
    with closing(_open(path)) as con:
        return [r[0] for r in con.execute("SELECT name FROM sqlite_master WHERE type = 'table' ORDER BY name")]


def shares(con: sqlite3.Connection, table: str, rows: int) -> Iterator[tuple[int, int]]:
    """(first, last) rowids of neighbouring shares of so many rows; the last share may have fewer."""
    name = _quoted(table)
    begin = con.execute(f"SELECT min(rowid) FROM {name}").fetchone()[0]
    while begin is not None:
        after = con.execute(f"SELECT rowid FROM {name} WHERE rowid >= ? ORDER BY rowid LIMIT 1 OFFSET ?", (begin, rows)).fetchone()
        if after is None:
            yield begin, con.execute(f"SELECT max(rowid) FROM {name}").fetchone()[0]
            return
        yield begin, after[0] - 1
        begin = after[0]


def scan(spark: SparkSession, paths: str | Sequence[str], table: str, share: int = SHARE, rowid: str = "rowid_") -> DataFrame:
    """A table with its rowid, of one file or of several with equal columns, each task reading a share of rows.

    Declared integers and reals keep their type, the rest is text.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    with closing(_open(paths[0])) as con:
        columns = [(r[1], (r[2] or "").upper()) for r in con.execute(f"PRAGMA table_info({_quoted(table)})")]
    if not columns:
        raise ValueError(f"no table {table} in {paths[0]}")
    kinds = [next(((s, a) for key, s, a in _KINDS if key in declared), (T.StringType(), pa.string())) for _, declared in columns]
    schema = T.StructType([T.StructField(rowid, T.LongType()), *[T.StructField(n, s) for (n, _), (s, _) in zip(columns, kinds, strict=True)]])
    arrow = pa.schema([(rowid, pa.int64()), *[(n, a) for (n, _), (_, a) in zip(columns, kinds, strict=True)]])
    select = f"SELECT rowid, {', '.join(_quoted(n) for n, _ in columns)} FROM {_quoted(table)} WHERE rowid BETWEEN ? AND ? ORDER BY rowid"
    text = [i + 1 for i, (s, _) in enumerate(kinds) if isinstance(s, T.StringType)]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                with closing(_open(path)) as con:
                    for a, b in shares(con, table, share):
                        yield pa.RecordBatch.from_pydict({"path": [path], "a": [a], "b": [b]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, a, b in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                with closing(_open(path)) as con:
                    cursor = con.execute(select, (a, b))
                    while rows := cursor.fetchmany(4096):
                        cols = [list(c) for c in zip(*rows, strict=True)]
                        for i in text:
                            cols[i] = [v if v is None or isinstance(v, str) else str(v) for v in cols[i]]
                        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)

    listed = spark.createDataFrame([(p,) for p in paths], "path string").repartition(min(len(paths), 64), "path")
    bounds = listed.mapInArrow(cut, "path string, a long, b long")
    return bounds.repartition("path", "a").mapInArrow(run, schema)


def write(rows: DataFrame, folder: str, table: str) -> DataFrame:
    """(path): one SQLite file in `folder` for each partition of rows, written by its task. Types are those of scan()."""
    declared = {T.LongType: "INTEGER", T.IntegerType: "INTEGER", T.ShortType: "INTEGER", T.DoubleType: "REAL", T.FloatType: "REAL"}
    columns = ", ".join(f"{_quoted(f.name)} {declared.get(type(f.dataType), 'TEXT')}" for f in rows.schema)
    marks = ", ".join("?" * len(rows.schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os
        import uuid

        os.makedirs(folder, exist_ok=True)
        side = f"{folder}/.{uuid.uuid4().hex}"
        with closing(sqlite3.connect(side)) as con:
            con.execute(f"CREATE TABLE {_quoted(table)} ({columns})")
            for batch in batches:
                con.executemany(f"INSERT INTO {_quoted(table)} VALUES ({marks})", zip(*(c.to_pylist() for c in batch.columns), strict=True))
            con.commit()
        path = f"{folder}/{uuid.uuid4().hex}.db"
        os.rename(side, path)  # a task that is tried again leaves a file that nothing names
        yield pa.RecordBatch.from_pydict({"path": [path]})

    return rows.mapInArrow(run, "path string")
