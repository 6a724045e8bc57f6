"""Replacement under readers, crashes and other writers; what a landing table's layout saves."""

import threading
import time
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.operators import dedup, ledger, rollup, storage
from gridloom.plans import reports
from tests.test_telemetry import T, flat, stored


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_a_reader_keeps_what_it_bound_to(spark, tmp_path):
    """Before, between and after the steps of a replacement: the old month or the new one, never both or none."""
    path = str(tmp_path / "events")
    for k in range(2):
        early = stored(spark, path, [dict(event_id="a", timestamp=T, ingested_at=T + timedelta(seconds=k))])
    seen = []

    def read():
        seen.append(storage.scan(spark, path).count())

    old = storage._ledger(spark, path).live()
    made = storage._write(dedup.latest_version(storage._bound(spark, path, old).drop("yyyymm")).withColumn("yyyymm", F.lit(202401)), path)
    read()  # written, not counted yet: as before, and nothing is repaired
    assert storage._ledger(spark, path).commit(made, old)
    read()
    assert seen == [2, 1] and early.count() == 2
    # what nobody reads any more goes by age
    assert storage.vacuum(spark, path, 3600) == 0 and early.count() == 2
    assert storage.vacuum(spark, path, 0) == 2 and storage.scan(spark, path).count() == 1


def test_a_reader_does_not_undo_the_writers_day(spark, tmp_path):
    """The race of an earlier mechanism: a reader between the writer's steps put the old day back, and the exact rows were lost."""
    stop = dict(event_type="SESSION_STOP", event_id="a", cost_eur=3.0, timestamp=T - timedelta(hours=20))
    rows = stored(spark, str(tmp_path / "events"), [stop, {**stop, "ingested_at": T + timedelta(seconds=9)}, dict(timestamp=T + timedelta(hours=1))])
    path = str(tmp_path / "revenue")
    rollup.append_parts(rollup.partial(rows), path, batch=1)
    read = lambda: [(r["revenue_eur"], r["sessions"]) for r in rollup.stored(spark, path).collect()]
    bound, old = rollup.stored(spark, path), rollup._ledger(spark, path).live()
    made = rollup._write(rollup.exact_day(rows, rollup.day_before(rows)), path)
    assert read() == [(6.0, 2)]
    rollup._ledger(spark, path).commit(made, old)
    assert read() == [(3.0, 1)] and [(r["revenue_eur"], r["sessions"]) for r in bound.collect()] == [(6.0, 2)]
    # a batch that is given again takes the place of what it wrote, once
    rollup.append_parts(rollup.partial(rows), path, batch=2)
    rollup.append_parts(rollup.partial(rows), path, batch=2)
    assert read() == [(9.0, 3)]


def test_of_two_replacements_one_counts(spark, tmp_path):
    path = str(tmp_path / "events")
    for k in range(2):
        stored(spark, path, [dict(event_id="a", timestamp=T, ingested_at=T + timedelta(seconds=k))])
    done, errors = [], []

    def compact():
        try:
            done.append(storage.compact(spark, path, "202401"))
        except Exception as e:  # noqa: BLE001
            errors.append(e)

    threads = [threading.Thread(target=compact) for _ in range(3)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not errors and storage.scan(spark, path).count() == 1 and done.count(True) >= 1
    # rows that come while a month is rewritten are not lost
    old = storage._ledger(spark, path).live()
    stored(spark, path, [dict(event_id="b", timestamp=T)])
    assert storage.replace_month(spark, path, "202401", storage._bound(spark, path, old).drop("yyyymm"), old)
    assert not storage.replace_month(spark, path, "202401", storage._bound(spark, path, old).drop("yyyymm"), old)
    assert storage.scan(spark, path).count() == 2


def test_readers_and_a_writer_at_once(spark, tmp_path):
    path = str(tmp_path / "events")
    stored(spark, path, [dict(event_id=str(k), timestamp=T) for k in range(5)])
    stored(spark, path, [dict(event_id=str(k), timestamp=T, ingested_at=T + timedelta(seconds=1)) for k in range(5)])
    seen, stop = [], threading.Event()

    def read():
        while not stop.is_set():
            seen.append(storage.scan(spark, path).count())

    reader = threading.Thread(target=read)
    reader.start()
    for k in range(3):
        storage.compact(spark, path, "202401")
        stored(spark, path, [dict(event_id=str(j), timestamp=T, ingested_at=T + timedelta(seconds=2 + k)) for j in range(5)])
    stop.set()
    reader.join()
    assert set(seen) <= {10, 5} and len(seen) > 2


def test_many_changes_are_summed_up(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(ledger, "MANY", 5)
    book = ledger.Ledger(spark, str(tmp_path / "t"), "day")
    book.store.mkdirs(book.of(f"{book.root}/_ledger"))
    for k in range(12):
        one = ledger.Segment(f"s{k}", "d", f"batch {k}")
        assert book.commit([one], [s for s in book.live() if k % 3 == 0])
    assert [s.name for s in book.live()] == ["s10", "s11", "s9"]
    monkeypatch.setattr(ledger, "KEEP_SECONDS", 0.0)
    time.sleep(0.01)
    for k in range(12, 20):
        assert book.commit([ledger.Segment(f"s{k}", "d")])
    assert len(book.live()) == 11 and len(book._changes()) < 12
    assert not book.commit([ledger.Segment("late", "d")], [ledger.Segment("s0", "d")]) and len(book.live()) == 11


def history(spark, path, months=3):
    """Sessions over some months, stored in two segments."""
    rows = []
    for s in range(30):
        at = T - timedelta(days=30 * (s % months))
        rows += [dict(event_id=f"{s}-{k}", event_type=kind, session_id=f"s{s}", station_id=f"ST-{s % 3}", timestamp=at + timedelta(minutes=k), energy_kwh=float(k), power_kw=5.0 + s % 7, vehicle_brand="b") for k, kind in enumerate(["SESSION_START", "METER_UPDATE", "METER_UPDATE", "METER_UPDATE", "SESSION_STOP"])]
    stored(spark, path, rows)
    return stored(spark, path, [{**r, "ingested_at": T + timedelta(days=1)} for r in rows[::7]])


@pytest.mark.parametrize("report", [reports.hourly_energy, reports.sessions_by_brand, reports.power_anomalies, reports.revenue])
def test_stale_versions_go_without_a_shuffle(spark, tmp_path, report):
    """No exchange stands below the rank of versions: buckets are read where they lie."""
    rows = history(spark, str(tmp_path / "events"))
    lines = plan_of(report(rows)).split("\n")
    ranks = [k for k, line in enumerate(lines) if "Window [row_number()" in line]
    assert ranks
    for k in ranks:
        depth = lambda x: len(x) - len(x.lstrip(" :+-*("))
        below = []
        for line in lines[k + 1 :]:
            if depth(line) <= depth(lines[k]):
                break
            below.append(line)
        assert any("Bucketed: true" in x for x in below) and not any("Exchange" in x for x in below)


def test_hourly_energy_needs_one_row_a_session_of_the_history(spark, tmp_path):
    """What is shuffled for A1: the window's rows, and of older ones what is summed up before the exchange."""
    path = str(tmp_path / "events")
    rows = []
    for s in range(20):  # all sessions go on from long before the window into it
        rows += [dict(event_id=f"{s}-{k}", event_type="METER_UPDATE", session_id=f"s{s}", station_id="ST-1", timestamp=T - timedelta(days=40) + timedelta(hours=k), energy_kwh=float(k)) for k in range(200)]
        rows += [dict(event_id=f"{s}-in{k}", event_type="METER_UPDATE", session_id=f"s{s}", station_id="ST-1", timestamp=T - timedelta(hours=k), energy_kwh=500.0 - k) for k in range(2)]
    table = stored(spark, path, rows)
    out = reports.hourly_energy(table)
    assert [round(r["energy_kwh"], 3) for r in out.collect()] == [20 * 300.0, 20 * 1.0]
    sent = []

    def walk(node):
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(node.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(node.plan())
        if name == "ShuffleExchangeExec":
            sent.append(node.metrics().apply("shuffleRecordsWritten").value())
        kids = node.children()
        for k in range(kids.size()):
            walk(kids.apply(k))

    walk(out._jdf.queryExecution().executedPlan())
    # at most: the window's 40 rows, and 20 sessions from each of a few tasks
    assert sent and max(sent) <= 40 + 20 * storage.BUCKETS and sum(sent) < 20 * 200


def test_row_groups_are_skipped(spark, tmp_path):
    """Bloom filters and the sort order: a look for one event or session reads few of the rows."""
    import pyarrow.parquet as pq

    path = str(tmp_path / "events")
    ids = [dict(event_id=f"{k:05d}", event_type="METER_UPDATE", session_id=f"s{k % 500}", timestamp=T + timedelta(seconds=k)) for k in range(4000)]
    rows = flat(spark, ids)
    storage.append(rows, path)
    found = storage.scan(spark, path)
    groups = sum(pq.ParquetFile(f.removeprefix("file:")).num_row_groups for f in found.inputFiles())

    def rows_read(df):
        df.collect()
        scan = df._jdf.queryExecution().executedPlan()
        text = scan.toString()
        assert "PushedFilters: [" in text
        node = [n for n in _leaves(scan)][0]
        return node.metrics().apply("numOutputRows").value()

    assert groups >= 8
    assert rows_read(found.where("event_id = '01234'")) <= 4000 / 5  # one bucket of eight
    assert rows_read(found.where("session_id = 'nobody'")) == 0  # bloom filters of all buckets say no
    assert found.where("session_id = 's7'").count() == 8


def _leaves(plan):
    name = plan.getClass().getSimpleName()
    if name == "AdaptiveSparkPlanExec":
        yield from _leaves(plan.executedPlan())
        return
    kids = plan.children()
    if kids.size() == 0:
        yield plan
    for k in range(kids.size()):
        yield from _leaves(kids.apply(k))


def test_another_session_registers_the_table(spark, tmp_path):
    path = str(tmp_path / "events")
    stored(spark, path, [dict(event_id="a", timestamp=T)])
    spark.sql(f"DROP TABLE {storage._table(spark, path)}")
    assert storage.scan(spark, path).count() == 1 and storage.scan(spark, path, until=datetime(2023, 1, 1)).count() == 0
    with pytest.raises(FileNotFoundError):
        storage.scan(spark, str(tmp_path / "none"))
