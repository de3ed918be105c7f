"""Contracts of tables of many Parquet files: every file's own footer, read by tasks, against the columns promised.

A table whose files differ reads as whatever Spark takes from one of them; only the footers tell which file drifted.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

_FOOTER = pa.schema([("file", pa.string()), ("n_rows", pa.int64()), ("columns", pa.list_(pa.struct([("name", pa.string()), ("type", pa.string())]))), ("error", pa.string())])


def files(spark: SparkSession, path: str) -> DataFrame:
    """(file): the Parquet files of a table, listed by Spark's reader."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    return listed.select(F.col("path").alias("file"))


def footers(paths: DataFrame, tasks: int = 64) -> DataFrame:
    """(file, n_rows, columns, error) of each file; no data page is read. A file that has no footer has an error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for file in batch.column(0).to_pylist():
                try:
                    store, at = fs.FileSystem.from_uri(file if "://" in file or not file.startswith("file:") else f"file://{file.removeprefix('file:')}")
                    with store.open_input_file(at) as f:
                        p = pq.ParquetFile(f)
                        columns = [{"name": c.name, "type": from_arrow_type(c.type, prefer_timestamp_ntz=c.type.tz is None if pa.types.is_timestamp(c.type) else False).simpleString()} for c in p.schema_arrow]
                        out.append({"file": file, "n_rows": p.metadata.num_rows, "columns": columns, "error": None})
                except (OSError, pa.ArrowInvalid) as e:
                    out.append({"file": file, "n_rows": None, "columns": [], "error": str(e)[:200]})
            yield pa.RecordBatch.from_pylist(out, schema=_FOOTER)

    return paths.repartition(tasks, "file").mapInArrow(run, "file string, n_rows long, columns array<struct<name: string, type: string>>, error string")


def states(found: DataFrame, contract: T.StructType) -> DataFrame:
    """(file, n_rows, name, type, state) of each file and column: held, changed, missing or extra; unreadable for a file."""
    want = F.array(*[F.struct(F.lit(f.name).alias("name"), F.lit(f.dataType.simpleString()).alias("type")) for f in contract])
    row = lambda name, kind, state: F.struct(name.alias("name"), kind.alias("type"), state.alias("state"))

    def judged(w):
        got = F.try_element_at(F.filter("columns", lambda c: c["name"] == w["name"]), F.lit(1))
        state = F.when(got.isNull(), "missing").when(got["type"] == w["type"], "held").otherwise("changed")
        return row(w["name"], got["type"], state)

    extra = F.transform(F.filter("columns", lambda c: ~F.array_contains(F.lit([f.name for f in contract]), c["name"])), lambda c: row(c["name"], c["type"], F.lit("extra")))
    broken = F.array(row(F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit("unreadable")))
    every = F.when(F.col("error").isNotNull(), broken).otherwise(F.concat(F.transform(want, judged), extra))
    return found.select("file", "n_rows", F.inline(every))


def verdicts(judged: DataFrame) -> DataFrame:
    """(file, n_rows, status, bad): FAIL for a file with a missing or changed column or without a footer; extra ones may be."""
    bad = F.when(F.col("state").isin("missing", "changed", "unreadable"), F.concat_ws(" ", "state", "name"))
    return judged.groupBy("file").agg(F.first("n_rows").alias("n_rows"), F.when(F.count(bad) > 0, "FAIL").otherwise("PASS").alias("status"), F.array_join(F.sort_array(F.collect_set(bad)), ", ").alias("bad"))
