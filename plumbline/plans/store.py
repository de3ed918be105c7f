"""The warehouse: month tables that are published together or not at all, and an audit of every attempt.

A run writes a month's tables to a folder of its own. Publications are numbered: commit n is one small file that says for
each month which folder holds, and the greatest number is what readers see. A writer reads the last commit, adds its
month and creates the next number, which only one writer can: whoever comes second reads again and adds its month to
what the first has published. So runs at the same time lose nothing, and readers see a month as it was or as it is.

Folders that a later commit has replaced stay for a retention time, so that open readers finish. A failed run leaves a
folder that no commit names.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Mapping
from datetime import UTC, datetime, timedelta
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.operators.copies import assert_unique
from plumbline.sources.tables import parameter_rows

#: Table -> key. The schema of a table is that of what is written; EMPTY has those that may be read before any month is.
KEYS: dict[str, tuple[str, ...]] = {
    "fct_wav_trip": ("month", "source_row_id"),
    "agg_segment_month": ("month", "level", "hvfhs_license_num", "wav_requested", "pu_borough", "hour_band"),
    "validation_rule_result": ("month", "rule_id", "hvfhs_license_num", "wav_requested"),
    "diag_negative_response": ("month", "hvfhs_license_num", "wav_requested"),
    "diag_segment": ("month", "hvfhs_license_num", "wav_requested"),
    "file_check": ("month", "check_id"),
    "reconciliation": ("month", "control_source", "scope"),
    "month_status": ("month",),
}
STATUS = "month string, retrieval_status string, metric_status string, trips_sha256 string, trips_rows long, run_id string, loaded_at string"
AUDIT = "run_id string, month string, started_at string, finished_at string, status string, error_type string, detail string"
CHECK = "month string, check_id string, name string, severity string, status string, observed string, expected string, detail string"
RECON = "month string, control_source string, scope string, file_trips long, control_trips long, diff long, diff_pct double, status string"
#: How long a replaced folder stays for those who have opened it.
RETENTION = timedelta(days=1)


class Shared:
    """Copies of the driver's preserved files where every machine can read them, named by digest.

    Where the shared folder's file system is the driver's own disk and all runs on one machine, files are read where
    they are; a cluster whose shared folder is a local one is refused.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        jvm = spark.sparkContext._jvm
        self._path, conf = jvm.org.apache.hadoop.fs.Path, spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(conf)
        self.root = str(self._fs.makeQualified(self._path(root)))
        if self.root.startswith("file:") and not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"paths.shared: {self.root} is the driver's own disk, which executors can't read")

    def of(self, path: Path, sha256: str) -> str:
        """The URI of a file's content; it is copied there unless a copy is there."""
        if self.root.startswith("file:"):
            return path.resolve().as_uri()
        name = self._path(f"{self.root}/{sha256[:16]}-{path.name}")
        if not self._fs.exists(name):
            side = self._path(f"{self.root}/.{uuid.uuid4().hex}")
            self._fs.copyFromLocalFile(False, True, self._path(path.resolve().as_uri()), side)
            if not self._fs.rename(side, name):  # another run was first
                self._fs.delete(side, False)
        return str(name)


class Warehouse:
    """Tables below one folder of any Hadoop file system."""

    def __init__(self, spark: SparkSession, root: str, retention: timedelta = RETENTION) -> None:
        jvm = spark.sparkContext._jvm
        self.retention = retention
        self._path = jvm.org.apache.hadoop.fs.Path
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._fs = self._path(root).getFileSystem(self._conf)
        self.spark, self.root = spark, str(self._fs.makeQualified(self._path(root)))
        self._jvm = jvm

    # --- small files -------------------------------------------------------------------------------------------------

    def _read(self, name: str) -> str | None:
        path = self._path(f"{self.root}/{name}")
        if not self._fs.exists(path):
            return None
        stream = self._fs.open(path)
        try:
            return bytes(self._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
        finally:
            stream.close()

    def _create(self, name: str, text: str) -> bool:
        """Create a small file with all of its text unless the name is taken; whether this call did.

        A local file gets its name by a hard link, any other by a rename that doesn't overwrite: both fail if another
        writer was first. A store whose rename isn't atomic can't hold a warehouse.
        """
        path, part = self._path(f"{self.root}/{name}"), self._path(f"{self.root}/.{name.replace('/', '_')}.{uuid.uuid4().hex}")
        self._fs.mkdirs(path.getParent())
        out = self._fs.create(part, True)
        out.write(bytearray(text.encode()))
        out.close()
        try:
            if self._fs.getUri().getScheme() == "file":
                local = lambda p: self._jvm.java.io.File(p.toUri().getPath()).toPath()
                self._jvm.java.nio.file.Files.createLink(local(path), local(part))
            else:
                how = self.spark.sparkContext._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 1)
                how[0] = self._jvm.org.apache.hadoop.fs.Options.Rename.NONE
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(self._fs.makeQualified(part), self._fs.makeQualified(path), how)
            return True
        except Py4JJavaError as e:
            if "AlreadyExists" not in e.java_exception.getClass().getSimpleName():
                raise
            return False
        finally:
            self._fs.delete(part, False)

    # --- commits -----------------------------------------------------------------------------------------------------

    def commits(self) -> list[int]:
        """The numbers of all publications, in order."""
        here = self._path(f"{self.root}/commits")
        if not self._fs.exists(here):
            return []
        return sorted(int(f.getPath().getName().removesuffix(".json")) for f in self._fs.listStatus(here) if f.getPath().getName().endswith(".json"))

    def state(self, number: int | None = None) -> dict:
        """What a commit says, the last one by default: number, at, month (the one it published) and months."""
        numbers = self.commits()
        if not numbers:
            return {"number": 0, "at": None, "month": None, "months": {}}
        return json.loads(self._read(f"commits/{number or numbers[-1]:010d}.json"))

    def commit(self, month: str, entry: dict, now: Callable[[], datetime] = lambda: datetime.now(UTC)) -> int:
        """Publish a month's entry beside all that others have published by then; the number of the publication."""
        while True:
            last = self.state()
            number = last["number"] + 1
            text = {"number": number, "at": now().isoformat(), "month": month, "months": last["months"] | {month: entry}}
            if self._create(f"commits/{number:010d}.json", json.dumps(text, indent=1, sort_keys=True)):
                return number

    def vacuum(self, now: datetime | None = None) -> list[str]:
        """Drop folders that a commit named once and that were replaced longer ago than the retention time."""
        states = [self.state(n) for n in self.commits()]
        horizon, kept, gone = (now or datetime.now(UTC)) - self.retention, set(), {}
        for i, state in enumerate(states):
            later = states[i + 1] if i + 1 < len(states) else None
            folders = {e["folder"] for e in state["months"].values()}
            if later is None or datetime.fromisoformat(later["at"]) > horizon:  # readers may have opened this state since
                kept |= folders
            gone |= dict.fromkeys(folders)
        dropped = [f for f in gone if f not in kept and self._fs.exists(self._path(f))]
        for f in dropped:
            self.drop(f)
        return dropped

    # --- published months --------------------------------------------------------------------------------------------

    def published(self) -> dict[str, str]:
        """Month -> the folder that holds its tables."""
        return {m: e["folder"] for m, e in self.state()["months"].items()}

    def staging(self, run_id: str, month: str) -> str:
        return f"{self.root}/runs/{run_id}/{month}"

    def publish(self, folder: str, month: str, tables: Mapping[str, DataFrame], reference: Mapping[str, str] | None = None) -> int:
        """Write a month's tables to `folder`, hold their keys to be unique, then commit the folder for the month.

        The fact's key is a row's position in one file, which is unique by construction; all other tables are small.
        reference: name -> what snapshot() returned for the reference tables that the month was built with.
        """
        for name, df in tables.items():
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            if name != "fct_wav_trip":
                assert_unique(self.spark.read.parquet(f"{folder}/{name}"), KEYS[name])
        number = self.commit(month, {"folder": folder, "reference": dict(reference or {})})
        self.vacuum()
        return number

    def drop(self, folder: str) -> None:
        self._fs.delete(self._path(folder), True)

    def table(self, name: str, month: str | None = None) -> DataFrame | None:
        """A table over all published months, or one; None before the first."""
        named = self.published()
        folders = [f for m, f in sorted(named.items()) if month in (None, m)]
        return self.spark.read.parquet(*[f"{f}/{name}" for f in folders]) if folders else None

    # --- reference tables --------------------------------------------------------------------------------------------

    def snapshot(self, name: str, rows: DataFrame) -> str:
        """The folder of a reference table's content. Equal contents share one folder; a folder never changes.

        A reference table has a few hundred rows, which pass through the driver.
        """
        held = sorted(json.dumps(r.asDict(), sort_keys=True, default=str) for r in rows.collect())
        told = json.dumps([rows.schema.jsonValue(), held], sort_keys=True)
        folder = f"{self.root}/reference/{name}/{hashlib.sha256(told.encode()).hexdigest()[:16]}"
        if not self._fs.exists(self._path(folder)):
            side = f"{self.root}/reference/.{name}.{uuid.uuid4().hex}"
            rows.coalesce(1).write.parquet(side)
            self._fs.mkdirs(self._path(folder).getParent())
            # a rename to a folder that another run has made meanwhile may fail or nest; both leave the same content
            if not self._fs.rename(self._path(side), self._path(folder)):
                self.drop(side)
        return folder

    def reference(self, name: str) -> DataFrame | None:
        """(month, columns...): each published month with the rows of the reference table that it was built with."""
        by: dict[str, list[str]] = {}
        for month, e in sorted(self.state()["months"].items()):
            if name in e["reference"]:
                by.setdefault(e["reference"][name], []).append(month)
        out = None
        for folder, months in by.items():
            one = self.spark.read.parquet(folder).select(F.explode(F.array(*map(F.lit, months))).alias("month"), "*")
            out = one if out is None else out.unionByName(one, allowMissingColumns=True)
        return out

    # --- audit -------------------------------------------------------------------------------------------------------

    def audit(self, row: tuple) -> None:
        """Append one attempt."""
        parameter_rows(self.spark, [row], AUDIT).coalesce(1).write.mode("append").parquet(f"{self.root}/pipeline_run")

    def attempts(self) -> DataFrame:
        path = f"{self.root}/pipeline_run"
        if not self._fs.exists(self._path(path)):
            return parameter_rows(self.spark, [], AUDIT)
        return self.spark.read.schema(AUDIT).parquet(path)
