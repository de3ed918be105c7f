"""Paginated APIs as a Spark source: pages are asked for by tasks, and what they add up to decides whether they count.

Pages come as rows (page, n_rows, sha256, body, waits, error): a page that can't be had is a row with an error, so a server
isn't asked again by retried tasks, and every retrieval ends with a table that says what happened. A retrieval is written
to a folder of its own below the shared root. It is the one that holds only once a note names it, and that is written
when the table proves whole: no error, as many rows as the server counts, and whatever else the API promises.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from plumbline.errors import Altered, Unavailable
from plumbline.settings import Month
from plumbline.sources.files import TRANSIENT, Fetched, FileStore, Patience, Transient, now, write_json

PAGE = "page long, n_rows long, sha256 string, body string, waits long, error string"
#: Tasks that ask a server at the same time.
TASKS = 4


@dataclass
class Asking:
    """How to ask an API for a page; it is sent to the tasks, so its session must pickle."""

    session: Any
    url: str
    params: Callable[[int], dict[str, Any]]
    rows_of: Callable[[Any], list]
    patience: Patience
    options: dict[str, Any] = field(default_factory=dict)

    def ask(self, params: dict[str, Any]) -> tuple[str, Any, int]:
        """(text, parsed body, tries that failed) of an answer; Unavailable if there is none."""
        waits = 0

        def once() -> tuple[str, Any]:
            nonlocal waits
            answer = self.session.get(self.url, params=params, **self.options)
            if answer.status_code in TRANSIENT:
                waits += 1
                asked = answer.json().get("retry_after_seconds") if answer.status_code == 429 and answer.text else None
                raise Transient(f"status {answer.status_code}", None if asked is None else float(asked))
            if answer.status_code != 200:
                raise Unavailable(f"status {answer.status_code}: {answer.text[:200]}")
            body = answer.json()
            if not isinstance(self.rows_of(body), list):
                raise Unavailable(f"no list of rows: {answer.text[:200]}")
            return answer.text, body

        text, body = self.patience.until_done(once, self.url)
        return text, body, waits

    def page(self, n: int) -> tuple:
        """A row of PAGE."""
        try:
            text, body, waits = self.ask(self.params(n))
        except (Unavailable, LookupError, AttributeError, TypeError) as e:
            return n, 0, None, None, 0, f"page {n}: {e}"
        return n, len(self.rows_of(body)), hashlib.sha256(text.encode()).hexdigest(), text, waits, None


class _Pages(InputPartition):
    def __init__(self, pages: range) -> None:
        super().__init__(None)
        self.pages = pages


def read_pages(spark: SparkSession, how: Asking, pages: range, tasks: int = TASKS) -> DataFrame:
    """PAGE rows of some pages, asked for by so many tasks at most, each of neighbouring pages."""
    step = max(1, -(-len(pages) // tasks))

    class Reader(DataSourceReader):
        def partitions(self) -> list[InputPartition]:
            return [_Pages(pages[i : i + step]) for i in range(0, len(pages), step)]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            return map(how.page, partition.pages)

    class Source(DataSource):
        @classmethod
        def name(cls) -> str:
            return "plumbline_pages"

        def schema(self) -> str:
            return PAGE

        def reader(self, schema: Any) -> DataSourceReader:
            return Reader()

    spark.dataSource.register(Source)
    return spark.read.format("plumbline_pages").load() if pages else spark.createDataFrame([], PAGE)


def bodies(rows: DataFrame, schema: str) -> DataFrame:
    """The rows of pages whose bodies are JSON arrays."""
    return rows.select(F.inline(F.from_json("body", f"array<struct<{schema}>>")))


# --- an API that counts ----------------------------------------------------------------------------------------------


class CountedPages:
    """An API that counts the rows of a filter and hands them out by limit and offset in a total order.

    Notes lie in `folder` on the driver's disk, one for each month, pages below `root`, which all machines share.
    """

    SOURCE, ORDER = "base_aggregate", "base_license_number,:id"

    def __init__(self, spark: SparkSession, store: FileStore, endpoint: str, page_size: int, folder: Path, root: str) -> None:
        self.spark, self.store, self.endpoint, self.page_size, self.folder, self.root = spark, store, endpoint, page_size, folder, root

    def fetch(self, month: Month) -> Fetched:
        """The month's rows, if as many came as the server counts. Failing that: preserved pages, else unavailable."""
        held = self._held(month)
        whole = held is not None and held["status"] == "complete"
        if self.store.offline or (whole and not self.store.refresh):
            return self._as("cached", held) if held else self._as("unavailable", {"status": "unavailable"})
        try:
            found = self._retrieve(month)
        except Unavailable as e:
            return self._as("cached_after_failure", held) if whole else self._as("unavailable", {"status": "unavailable", "error": str(e)})
        if found["status"] == "complete" and whole:
            same = held["digest"] == found["digest"]
            found["superseded"] = held["superseded"] if same else [{k: held[k] for k in ("pages_at", "retrieved_at", "digest")}, *held["superseded"]]
        self.folder.mkdir(parents=True, exist_ok=True)
        write_json(self._note(month), found)  # from here on the retrieval holds
        return self._as("downloaded" if found["status"] == "complete" else found["status"], found)

    def rows(self, got: Fetched, schema: str) -> DataFrame:
        return bodies(self.spark.read.parquet(got.manifest["pages_at"]), schema)

    def _note(self, month: Month) -> Path:
        return self.folder / f"{month}.json"

    def _as(self, status: str, note: dict[str, Any]) -> Fetched:
        return Fetched(self.SOURCE, self.folder, status, note)

    def _held(self, month: Month) -> dict[str, Any] | None:
        """The note of an earlier run, if the pages that it names are as they were."""
        try:
            note = json.loads(self._note(month).read_text())
        except FileNotFoundError:
            return None
        if note["status"] == "complete" and (found := self._proof(self.spark.read.schema(PAGE).parquet(note["pages_at"])))["digest"] != note["digest"]:
            raise Altered(f"{note['pages_at']} has digest {found['digest'][:12]}, its note {note['digest'][:12]}")
        return note

    @staticmethod
    def _proof(pages: DataFrame) -> dict[str, Any]:
        """What written pages add up to. The digest is of the page bodies' own digests, taken from what is there."""
        own = F.concat_ws(":", F.lpad(F.col("page").cast("string"), 12, "0"), F.sha2(F.col("body").cast("binary"), 256))
        r = pages.agg(F.count("*").alias("n_pages"), F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.sha2(F.array_join(F.sort_array(F.collect_list(own)), ","), 256).alias("digest"), F.max("error").alias("error")).first()
        return r.asDict()

    def _retrieve(self, month: Month) -> dict[str, Any]:
        """A note on the pages that the server has now."""
        where = f"year={month.year} AND month={month.month}"
        http = self.store.http
        how = Asking(
            self.store.session, self.endpoint, _Offsets(where, self.ORDER, self.page_size), _whole, self.store.patience, {"headers": self.store.headers, "timeout": http["timeout_s"]}
        )
        try:
            promised = int(how.ask({"$select": "count(*) AS n", "$where": where})[1][0]["n"])
        except (LookupError, TypeError, ValueError) as e:
            raise Unavailable(f"no count of {where}: {e}") from e
        facts = {"source": self.SOURCE, "endpoint": self.endpoint, "where": where, "order": self.ORDER, "page_size": self.page_size, "retrieved_at": now(), "expected_rows": promised, "superseded": []}
        if not promised:  # asked again in the next run
            return facts | {"status": "not_published", "retrieved_rows": 0}
        at = f"{self.root}/{self.SOURCE}/{month}-{uuid.uuid4().hex[:12]}"
        read_pages(self.spark, how, range(-(-promised // self.page_size))).write.parquet(at)
        proof = self._proof(self.spark.read.schema(PAGE).parquet(at))
        if proof["error"] or proof["n_rows"] != promised:
            raise Unavailable(proof["error"] or f"{month}: {proof['n_rows']} rows came of {promised}")
        return facts | {"status": "complete", "retrieved_rows": proof["n_rows"], "n_pages": proof["n_pages"], "digest": proof["digest"], "pages_at": at}


@dataclass(frozen=True)
class _Offsets:
    """Parameters of a page of an API that takes limit and offset."""

    where: str
    order: str
    size: int

    def __call__(self, n: int) -> dict[str, Any]:
        return {"$where": self.where, "$order": self.order, "$limit": self.size, "$offset": n * self.size}


def _whole(body: Any) -> Any:
    return body


# --- an API that numbers its pages -----------------------------------------------------------------------------------


@dataclass(frozen=True)
class _Numbers:
    """Parameters of a page of an API whose pages are numbered from 1."""

    size: int

    def __call__(self, n: int) -> dict[str, Any]:
        return {"page": n + 1, "page_size": self.size}


def _data(body: Any) -> Any:
    return body["data"]


def listed_pages(spark: SparkSession, session: Any, url: str, at: str, key: str, page_size: int = 50, tries: int = 4, timeout: float = 10, sleep: Callable[[float], None] | None = None) -> tuple[DataFrame, dict[str, Any]]:
    """(PAGE rows below `at`, proof) of an API that says total_records and has_more, and that may ask to wait.

    The first page is asked for by the driver, as it tells how many there are, and all of them by tasks. A status of 429 is
    waited out for as long as the server asks. Unless the rows are as many as the server says, keys are unique, and only
    the last page says that no more follow, it raises; the pages stay as evidence.
    """
    how = Asking(session, url, _Numbers(page_size), _data, Patience(tries, 1.0, *([sleep] if sleep else [])), {"timeout": timeout})
    first = how.ask(how.params(0))
    total = int(first[1]["total_records"])
    pages = max(1, -(-total // page_size))
    read_pages(spark, how, range(pages)).write.parquet(at)
    rows = spark.read.schema(PAGE).parquet(at)
    ends = F.get_json_object("body", "$.has_more") == "false"
    seen = rows.agg(F.sum("n_rows").alias("n"), F.sum("waits").alias("waits"), F.max("error").alias("error"), F.count_if(ends != (F.col("page") == pages - 1)).alias("odd_ends")).first()
    keys = rows.select(F.explode(F.from_json(F.get_json_object("body", "$.data"), "array<string>")).alias("row")).select(F.get_json_object("row", f"$.{key}").alias("k"))
    unique = keys.agg(F.count_distinct("k")).first()[0]
    proof = {"pages_fetched": pages, "records_retrieved": seen["n"], "api_total_records": total, "unique_keys": unique, "retries": seen["waits"] + first[2]}
    claims = {seen["error"] or "": seen["error"] is None, "rows differ from the total": seen["n"] == total, "keys repeat": unique == seen["n"], "pages end elsewhere than the total says": seen["odd_ends"] == 0}
    problems = [claim for claim, holds in claims.items() if not holds]
    if problems:
        raise Unavailable(f"not whole: {problems} {proof}")
    return rows, proof
