"""Publication: writers at the same time, readers of what is replaced, reference tables as of a publication."""

from __future__ import annotations

import threading
from datetime import UTC, datetime, timedelta

import pytest

from plumbline.plans.store import CHECK, Warehouse
from plumbline.sources.tables import parameter_rows


@pytest.fixture(params=["file", "viewfs"])
def root(request, spark, tmp_path):
    """A warehouse on the local disk, and one behind another file system, which has no hard links."""
    if request.param == "file":
        return f"file://{tmp_path}/wh"
    spark.sparkContext._jsc.hadoopConfiguration().set(f"fs.viewfs.mounttable.{tmp_path.name.replace('_', '-')}.link./w", f"file://{tmp_path}")
    return f"viewfs://{tmp_path.name.replace('_', '-')}/w/wh"


def tables(spark, month, n):
    return {"file_check": parameter_rows(spark, [(month, f"C{i}", "n", "WARN", "PASS", "o", "e", "") for i in range(n)], CHECK)}


def publish(w, run, month, n, **more):
    return w.publish(w.staging(run, month), month, tables(w.spark, month, n), **more)


def counts(w):
    return {r["month"]: r["count"] for r in w.table("file_check").groupBy("month").count().collect()}


def test_a_number_is_taken_once(spark, root):
    w, got = Warehouse(spark, root), []
    writers = [threading.Thread(target=lambda i=i: got.append((w._create("commits/0000000001.json", f"text {i}"), i))) for i in range(8 if root.startswith("file") else 1)]
    for t in writers:
        t.start()
    for t in writers:
        t.join()
    winners = [i for won, i in got if won]
    assert len(winners) == 1 and w._read("commits/0000000001.json") == f"text {winners[0]}"
    assert not w._create("commits/0000000001.json", "late") and w._read("commits/0000000001.json") == f"text {winners[0]}"


def test_interleaved_writers_lose_no_month(spark, root):
    """The second writer commits between the first one's reading and its creation."""
    one, two = Warehouse(spark, root), Warehouse(spark, root)
    state, once = one.state, []

    def interrupted(number=None):
        found = state(number)
        if not once:
            once.append(publish(two, "b", "2026-02", 2))
        return found

    one.state = interrupted
    assert publish(one, "a", "2026-01", 1) == 2 and once == [1]
    assert counts(two) == {"2026-01": 1, "2026-02": 2} and two.commits() == [1, 2]


def test_writers_at_the_same_time_lose_no_month(spark, tmp_path):
    root = f"file://{tmp_path}/wh"
    months = [f"2026-{m:02d}" for m in range(1, 9)]
    writers = [threading.Thread(target=lambda m=m: [Warehouse(spark, root).commit(m, {"folder": f"{m}/{i}", "reference": {}}) for i in range(3)]) for m in months]
    for t in writers:
        t.start()
    for t in writers:
        t.join()
    w = Warehouse(spark, root)
    assert w.published() == {m: f"{m}/2" for m in months} and w.commits() == list(range(1, 25))


def test_a_reader_of_a_replaced_month_finishes(spark, root):
    w = Warehouse(spark, root)
    publish(w, "a", "2026-01", 3)
    before, folder = w.table("file_check"), w.published()["2026-01"]
    publish(w, "b", "2026-01", 5)
    assert before.count() == 3 and counts(w) == {"2026-01": 5}
    assert w.vacuum(datetime.now(UTC) + timedelta(hours=23)) == []
    assert w.vacuum(datetime.now(UTC) + timedelta(hours=25)) == [folder]
    assert counts(w) == {"2026-01": 5} and w.vacuum(datetime.now(UTC) + timedelta(hours=25)) == []


def test_what_stands_unchanged_is_never_dropped(spark, root):
    w = Warehouse(spark, root, retention=timedelta(0))
    publish(w, "a", "2026-01", 1)
    publish(w, "b", "2026-02", 2)
    publish(w, "c", "2026-02", 3)
    assert counts(w) == {"2026-01": 1, "2026-02": 3}
    assert w.state(1)["months"].keys() == {"2026-01"} and w.state()["month"] == "2026-02"


def test_months_keep_the_names_they_were_published_with(spark, root):
    w = Warehouse(spark, root)
    names = lambda *rows: parameter_rows(spark, rows, "hvfhs_license_num string, brand string")
    old, same, new = (w.snapshot("dim_licensee", names(*x)) for x in ([("L1", "Click"), ("L2", "View")], [("L2", "View"), ("L1", "Click")], [("L1", "Clack"), ("L2", "View"), ("L3", "Buy")]))
    assert old == same != new
    publish(w, "a", "2026-01", 1, reference={"dim_licensee": old})
    publish(w, "b", "2026-02", 1, reference={"dim_licensee": new})
    publish(w, "c", "2026-03", 1)
    got = sorted(tuple(r) for r in w.reference("dim_licensee").collect())
    assert got == [("2026-01", "L1", "Click"), ("2026-01", "L2", "View"), ("2026-02", "L1", "Clack"), ("2026-02", "L2", "View"), ("2026-02", "L3", "Buy")]
    assert w.reference("dim_zone") is None


def test_nothing_is_published_at_first(spark, root):
    w = Warehouse(spark, root)
    assert w.commits() == [] and w.published() == {} and w.table("file_check") is None and w.reference("dim_zone") is None and w.vacuum() == []
