"""Retrieval against a server that fails in every way it can."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from plumbline.errors import Altered, Unavailable
from plumbline.settings import load
from plumbline.sources import tables
from plumbline.sources.files import FileStore, digest, manifest_of
from plumbline.sources.pages import PAGE, Asking, CountedPages, _Offsets, _whole, listed_pages, read_pages
from tests import made_month as m

URL = "https://example.test/f"


@pytest.fixture
def server():
    s = m.Server(load(), b"trips")
    s.files[URL] = b"payload"
    return s


def store(server, **how):
    return FileStore(load()["http"], server, sleep=lambda _: None, **how)


def test_download_writes_a_manifest(server, tmp_path):
    got = store(server).fetch("x", URL, tmp_path / "f")
    assert got.status == "downloaded" and got.manifest["sha256"] == digest(tmp_path / "f") and got.manifest["attempts"] == 1 and manifest_of(tmp_path / "f").exists()


@pytest.mark.parametrize("bad", [m.Answer(500), m.Answer(429), m.Answer(body=b"pay", headers={"Content-Length": "7"}), m.Answer(), ConnectionResetError("reset")])
def test_transient_failures_are_retried(server, tmp_path, bad):
    server.fail = [bad]
    assert store(server).fetch("x", URL, tmp_path / "f").manifest["attempts"] == 2 and (tmp_path / "f").read_bytes() == b"payload"


@pytest.mark.parametrize("status", [403, 404])
def test_final_answers_are_not_retried(server, tmp_path, status):
    server.fail = [m.Answer(status)] * 3
    with pytest.raises(Unavailable):
        store(server).fetch("x", URL, tmp_path / "f")
    assert len(server.calls) == 1 and not list(tmp_path.iterdir())


def test_gives_up_and_leaves_nothing(server, tmp_path):
    server.fail = [m.Answer(503)] * 3
    with pytest.raises(Unavailable, match="gave up"):
        store(server).fetch("x", URL, tmp_path / "f")
    assert not list(tmp_path.iterdir())


def test_length_is_compared_on_the_wire(server, tmp_path):
    class Raw:
        def tell(self):
            return 3

    server.fail = [m.Answer(body=b"payload", headers={"Content-Length": "3", "Content-Encoding": "gzip"}, raw=Raw())]
    assert store(server).fetch("x", URL, tmp_path / "f").manifest["bytes"] == 7


def test_cached_copy_is_verified(server, tmp_path):
    store(server).fetch("x", URL, tmp_path / "f")
    assert store(server).fetch("x", URL, tmp_path / "f").status == "cached" and len(server.calls) == 1
    (tmp_path / "f").write_bytes(b"changed")
    with pytest.raises(Altered):
        store(server, offline=True).fetch("x", URL, tmp_path / "f")


def test_offline_without_a_copy(server, tmp_path):
    with pytest.raises(Unavailable, match="offline"):
        store(server, offline=True).fetch("x", URL, tmp_path / "f")


def test_file_without_manifest_is_fetched_again(server, tmp_path):
    (tmp_path / "f").write_bytes(b"half")
    assert store(server).fetch("x", URL, tmp_path / "f").status == "downloaded" and (tmp_path / "f").read_bytes() == b"payload"


def test_refresh_keeps_the_old_version(server, tmp_path):
    store(server).fetch("x", URL, tmp_path / "f")
    assert store(server, refresh=True).fetch("x", URL, tmp_path / "f").status == "cached"
    server.files[URL] = b"new payload"
    assert store(server, refresh=True).fetch("x", URL, tmp_path / "f").status == "refreshed"
    assert (tmp_path / "f").read_bytes() == b"new payload" and len(list((tmp_path / "superseded").iterdir())) == 2


def test_failed_refresh_keeps_the_copy(server, tmp_path):
    store(server).fetch("x", URL, tmp_path / "f")
    server.files[URL] = b"new payload"
    server.fail = [m.Answer(500)] * 3
    assert store(server, refresh=True).fetch("x", URL, tmp_path / "f").status == "cached_after_failure" and (tmp_path / "f").read_bytes() == b"payload"


def pages(spark, server, folder, size=1, **how):
    return CountedPages(spark, store(server, **how), load()["sources.base_aggregate.endpoint"], size, folder / "notes", f"file://{folder}/pages")


def test_pages_add_up_to_the_count(spark, server, tmp_path):
    got = pages(spark, server, tmp_path).fetch(m.MONTH)
    assert got.status == "downloaded" and got.manifest["retrieved_rows"] == 2 and got.manifest["n_pages"] == 2
    cached = pages(spark, server, tmp_path, offline=True)
    again = cached.fetch(m.MONTH)
    assert again.status == "cached" and {r[0] for r in cached.rows(again, "base_license_number string").collect()} == set(server.control)
    assert pages(spark, server, tmp_path / "other", offline=True).fetch(m.MONTH).status == "unavailable"


class Miscounting(m.Server):
    """Says that there is a row more than it has."""

    def _api(self, params):
        return m.Answer(body=json.dumps([{"n": str(len(self.control) + 1)}]).encode()) if "$select" in params else super()._api(params)


def test_short_pagination_is_unavailable(spark, tmp_path):
    got = pages(spark, Miscounting(load(), b""), tmp_path).fetch(m.MONTH)
    assert got.status == "unavailable" and "2 rows came of 3" in got.manifest["error"] and not (tmp_path / "notes").exists()


def test_unpublished_month_is_asked_again(spark, server, tmp_path):
    control, server.control = server.control, {}
    assert pages(spark, server, tmp_path).fetch(m.MONTH).status == "not_published"
    server.control = control
    assert pages(spark, server, tmp_path).fetch(m.MONTH).status == "downloaded"


def test_api_failure_falls_back_to_preserved_pages(spark, server, tmp_path):
    pages(spark, server, tmp_path).fetch(m.MONTH)
    for bad in (m.Answer(500), m.Answer(body=b"{}"), m.Answer(body=b"[]"), m.Answer(404)):
        server.fail = [bad] * 3
        assert pages(spark, server, tmp_path, refresh=True).fetch(m.MONTH).status == "cached_after_failure"


def test_changed_pages_are_superseded_and_tampered_ones_refused(spark, server, tmp_path):
    first = pages(spark, server, tmp_path).fetch(m.MONTH).manifest
    assert pages(spark, server, tmp_path, refresh=True).fetch(m.MONTH).manifest["superseded"] == []
    server.control["UBER"] += 1
    second = pages(spark, server, tmp_path, refresh=True).fetch(m.MONTH).manifest
    assert [x["digest"] for x in second["superseded"]] == [first["digest"]] and spark.read.parquet(first["pages_at"]).count() == 2
    spark.createDataFrame([(0, 1, "", "[]", 0, None)], PAGE).write.mode("append").parquet(second["pages_at"])
    with pytest.raises(Altered):
        pages(spark, server, tmp_path).fetch(m.MONTH)


# --- over a real connection ------------------------------------------------------------------------------------------


class Http:
    """The part of a session that sources use, over the standard library; it pickles."""

    def get(self, url, params=None, headers=None, timeout=10):
        from urllib import error, parse, request

        try:
            with request.urlopen(request.Request(f"{url}?{parse.urlencode(params)}", headers=headers or {}), timeout=timeout) as r:
                return m.Answer(r.status, r.read())
        except error.HTTPError as e:
            return m.Answer(e.code, e.read())


@pytest.fixture
def web():
    """A server of 97 rows in pages that are counted or numbered; `busy` pages answer 429 once, `short` ones lack a row."""
    import threading
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from urllib.parse import parse_qs, urlsplit

    rows = [{"base_license_number": f"B{i:03d}", "total_dispatched_trips": str(i)} for i in range(97)]

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            q = {k: v[0] for k, v in parse_qs(urlsplit(self.path).query).items()}
            state, status = self.server.state, 200
            if "$select" in q:
                body = [{"n": "97"}]
            elif "page" in q:
                size, n = int(q["page_size"]), int(q["page"])
                body = {"data": rows[(n - 1) * size : n * size], "has_more": n * size < len(rows), "total_records": len(rows)}
                if n in state["busy"]:
                    state["busy"].remove(n)
                    status, body = 429, {"retry_after_seconds": 0.01}
            else:
                lo = int(q["$offset"])
                body = rows[lo : lo + int(q["$limit"])]
                body = body[:-1] if lo in state["short"] else body
            state["asked"].append(threading.get_ident())
            text = json.dumps(body).encode()
            self.send_response(status)
            self.send_header("Content-Length", str(len(text)))
            self.end_headers()
            self.wfile.write(text)

        def log_message(self, *_):
            pass

    web = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    web.state = {"busy": [], "short": [], "asked": []}
    threading.Thread(target=web.serve_forever, daemon=True).start()
    web.url = f"http://127.0.0.1:{web.server_port}/api"
    yield web
    web.shutdown()


def test_twenty_pages_are_asked_for_by_several_tasks(spark, web, tmp_path):
    source = CountedPages(spark, FileStore(load()["http"], Http(), sleep=lambda _: None), web.url, 5, tmp_path / "notes", f"file://{tmp_path}/pages")
    got = source.fetch(m.MONTH)
    assert got.status == "downloaded" and got.manifest["n_pages"] == 20 and got.manifest["retrieved_rows"] == 97
    rows = source.rows(got, "base_license_number string, total_dispatched_trips string")
    assert rows.agg({"total_dispatched_trips": "sum"}).first()[0] == 97 * 48
    how = Asking(Http(), web.url, _Offsets("x", "y", 5), _whole, source.store.patience)
    assert read_pages(spark, how, range(20)).rdd.getNumPartitions() == 4
    web.state["short"] = [35]
    refused = CountedPages(spark, source.store, web.url, 5, tmp_path / "n2", f"file://{tmp_path}/p2").fetch(m.MONTH)
    assert refused.status == "unavailable" and "96 rows came of 97" in refused.manifest["error"]


def test_listed_pages(spark, web, tmp_path):
    web.state["busy"] = [3, 7]
    rows, proof = listed_pages(spark, Http(), web.url, f"file://{tmp_path}/p", "base_license_number", 10, sleep=lambda _: None)
    assert proof == {"pages_fetched": 10, "records_retrieved": 97, "api_total_records": 97, "unique_keys": 97, "retries": 2}
    assert rows.select(F.explode(F.from_json(F.get_json_object("body", "$.data"), "array<struct<base_license_number: string>>"))).count() == 97


class Listed:
    def __init__(self, rows, total):
        self.rows, self.total = rows, total

    def get(self, url, params, timeout):
        lo = (params["page"] - 1) * params["page_size"]
        return m.Answer(body=json.dumps({"data": self.rows[lo : lo + params["page_size"]], "has_more": lo + params["page_size"] < len(self.rows), "total_records": self.total}).encode())


@pytest.mark.parametrize("rows,total,problem", [([{"order_id": 1}] * 2, 2, "keys repeat"), ([{"order_id": 1}], 2, "rows differ"), ([{"order_id": i} for i in range(9)], 5, "rows differ|end elsewhere")])
def test_listed_pages_that_are_not_whole(spark, tmp_path, rows, total, problem):
    with pytest.raises(Unavailable, match=problem):
        listed_pages(spark, Listed(rows, total), URL, f"file://{tmp_path}/p", "order_id", 5, sleep=lambda _: None)


def test_csv_as_text_and_number_lookup(spark, tmp_path):
    (tmp_path / "r.csv").write_text('a,b\n1,\n2,"21,500"\n')
    rows = tables.csv(spark, str(tmp_path / "r.csv"))
    assert rows.dtypes == [("a", "string"), ("b", "string")] and rows.filter("b is null").count() == 1
    assert tables.lookup_number(rows, {"a": "2"}, "b").first()[0] == 21500


def test_sqlite_scan(spark, tmp_path):
    import sqlite3

    from plumbline.operators.copies import first_of_key
    from plumbline.sources import sqlite

    path = str(tmp_path / "d.db")
    with sqlite3.connect(path) as con:
        con.execute("CREATE TABLE orders (order_id TEXT, n INTEGER, km REAL, at)")
        con.executemany("INSERT INTO orders VALUES (?, ?, ?, ?)", [(f"O{i % 40}", i, i / 2, None if i % 7 else str(i)) for i in range(100)])
        con.execute("CREATE TABLE empty_one (x INTEGER)")
    assert sqlite.table_names(path) == ["empty_one", "orders"]
    rows = sqlite.scan(spark, path, "orders", 30)
    assert rows.dtypes == [("rowid_", "bigint"), ("order_id", "string"), ("n", "bigint"), ("km", "double"), ("at", "string")]
    assert sorted(r["n"] for r in rows.collect()) == list(range(100)) and rows.filter("at is null").count() == 85
    assert sorted(r["n"] for r in first_of_key(rows, ["order_id"], ["rowid_"]).collect()) == list(range(40))
    assert sqlite.scan(spark, path, "empty_one").count() == 0
    with pytest.raises(ValueError):
        sqlite.scan(spark, path, "absent")


def test_sqlite_shares_are_equal_however_sparse_rowids_are(spark, tmp_path):
    import sqlite3

    from plumbline.sources import sqlite

    paths = []
    for k in range(2):
        paths.append(str(tmp_path / f"{k}.db"))
        with sqlite3.connect(paths[-1]) as con:
            con.execute("CREATE TABLE t (x INTEGER)")
            ids = [-(2**60), *range(5, 305), 2**40, 2**62 - k]
            con.executemany("INSERT INTO t(rowid, x) VALUES (?, ?)", [(i, i) for i in ids])
    with sqlite3.connect(paths[0]) as con:
        cut = list(sqlite.shares(con, "t", 100))
        assert [con.execute("SELECT count(*) FROM t WHERE rowid BETWEEN ? AND ?", c).fetchone()[0] for c in cut] == [100, 100, 100, 3]
        assert list(sqlite.shares(con, "t", 303)) == [(-(2**60), 2**62)]
    rows = sqlite.scan(spark, paths, "t", 100)
    assert sorted(r["x"] for r in rows.collect()) == sorted(i for k in range(2) for i in [-(2**60), *range(5, 305), 2**40, 2**62 - k])
    back = sqlite.write(spark.createDataFrame([(1, 2.5, "é", True), (None, None, None, None)], "a long, b double, `c d` string, e boolean").coalesce(1), str(tmp_path / "out"), "w")
    [file] = [r[0] for r in back.collect()]
    assert {tuple(r)[1:] for r in sqlite.scan(spark, file, "w").collect()} == {(1, 2.5, "é", "1"), (None, None, None, None)}


def test_footers_of_many_files(spark, tmp_path):
    from pyspark.sql import types as T

    from plumbline.sources import footers

    at = tmp_path / "t"
    good = spark.createDataFrame([(1, 2.0, "x"), (2, None, "y")], "a long, b double, c string").withColumn("t", F.lit("2020-01-01").cast("timestamp_ntz"))
    good.repartition(3).write.parquet(f"file://{at}/one")
    good.withColumn("b", F.col("b").cast("float")).drop("c").withColumn("n", F.lit(1)).coalesce(1).write.parquet(f"file://{at}/two")
    (at / "one" / "cut.parquet").write_bytes(b"PAR1 not whole")
    found = footers.footers(footers.files(spark, f"file://{at}"))
    judged = footers.states(found, T.StructType.fromDDL("a long, b double, c string, t timestamp_ntz"))
    two = {(r["name"], r["type"], r["state"]) for r in judged.filter("file like '%/two/%'").collect()}
    assert two == {("a", "bigint", "held"), ("b", "float", "changed"), ("c", None, "missing"), ("t", "timestamp_ntz", "held"), ("n", "int", "extra")}
    got = {(r["status"], r["bad"], "cut" in r["file"]) for r in footers.verdicts(judged).collect()}
    assert got == {("PASS", "", False), ("FAIL", "changed b, missing c", False), ("FAIL", "unreadable", True)}
    assert found.agg(F.sum("n_rows")).first()[0] == 4
