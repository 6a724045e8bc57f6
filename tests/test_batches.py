"""Batches closed by size or by time, across files and a restart."""

import time
from datetime import datetime

from gridloom.sources import batches


def _add(spark, folder, first, n):
    rows = spark.range(first, first + n, 1, 1).selectExpr("concat('k', id) AS key", "concat('v', id) AS value", "timestamp_seconds(1700000000 + id) AS produced_at", "id AS offset")
    rows.write.mode("append").parquet(folder)


def _until(done, seconds=60):
    end = time.monotonic() + seconds
    while not done() and time.monotonic() < end:
        time.sleep(0.1)
    assert done()


def test_size_under_load_and_time_when_idle(spark, tmp_path):
    folder, checkpoint, seen, why = str(tmp_path / "in"), str(tmp_path / "c"), [], []

    def start():
        take = lambda df, batch: seen.append([r["offset"] for r in df.orderBy("offset").collect()])
        return batches.from_folder(spark, folder, checkpoint, rows=1000, millis=300).writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()

    for k in range(4):
        _add(spark, folder, 700 * k, 700)
    q = start()
    try:
        _until(lambda: sum(map(len, seen)) == 2800)
        assert [len(x) for x in seen] == [1000, 1000, 800]
        _add(spark, folder, 2800, 10)
        _until(lambda: sum(map(len, seen)) == 2810)
        assert len(seen[-1]) == 10
        time.sleep(1)  # idle: no batches without rows
        why = [batches.closed_by(p) for p in q.recentProgress if p["numInputRows"]]
    finally:
        q.stop()
    assert len(seen) == 4 and why == ["size", "size", "time", "time"]
    _add(spark, folder, 2810, 1200)
    q = start()  # goes on at the row where it was
    try:
        _until(lambda: sum(map(len, seen)) == 4010)
    finally:
        q.stop()
    assert [len(x) for x in seen[4:]] == [1000, 200]
    assert sorted(x for part in seen for x in part) == list(range(4010))


def test_rows_come_as_they_were_written(spark, tmp_path):
    folder, checkpoint = str(tmp_path / "in"), str(tmp_path / "c")
    _add(spark, folder, 0, 3)
    got = []
    q = batches.from_folder(spark, folder, checkpoint, rows=2, millis=50).writeStream.foreachBatch(lambda df, _: got.extend(df.collect())).option("checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    try:
        _until(lambda: len(got) == 3)
    finally:
        q.stop()
    assert sorted(r["key"] for r in got) == ["k0", "k1", "k2"] and {r["produced_at"] for r in got} == {datetime.fromtimestamp(1700000000 + k) for k in range(3)}


def test_duplicates_by_state_are_those_by_marks(spark, tmp_path):
    """Three batches, one after a restart: the store lets the rows through that the anti-join against marks does."""
    from functools import reduce

    from pyspark.sql import DataFrame

    from gridloom.operators import dedup

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, out, checkpoint, kind = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "c"), "event_id string, offset long, x string"
    parts = [spark.createDataFrame([(f"e{k * k % 17}", 100 * b + k, f"{b}-{k}") for k in range(20)], kind) for b in range(3)]
    marks, want = None, []
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(source)
        q = dedup.first_in_state(spark.readStream.schema(kind).parquet(source)).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        assert q.awaitTermination(100)
        first = dedup.first_in_batch(part)
        passed = first if marks is None else dedup.unseen(first, marks)
        want.append(passed)
        marks = reduce(DataFrame.unionByName, [w.select("event_id") for w in want])
    assert sorted(map(tuple, spark.read.parquet(out).collect())) == sorted(tuple(r) for w in want for r in w.collect())


def test_streaming_totals_equal_the_parts(spark, tmp_path):
    """Update mode with upserts, against the parts that foreachBatch adds; late rows and copies among them."""
    from datetime import timedelta

    from gridloom.operators import rollup
    from tests.test_telemetry import T, flat

    source, totals, parts, checkpoint = (str(tmp_path / n) for n in ("in", "totals", "parts", "c"))
    for b in range(3):
        rows = flat(spark, [dict(event_type="SESSION_STOP", event_id=str(k), cost_eur=float(k), city=f"C{k % 2}", timestamp=T - timedelta(hours=7 * (k + b))) for k in range(8)])
        rows.coalesce(1).write.mode("append").parquet(source)
        q = rollup.start_totals(spark.readStream.schema(rows.schema).parquet(source), totals, checkpoint, availableNow=True)
        assert q.awaitTermination(100)
        rollup.append_parts(rollup.partial(rows), parts, batch=b)
    read = lambda path: sorted(tuple(map(str, r)) for r in rollup.stored(spark, path).select(*rollup.KEY, "revenue_eur", "sessions").collect())
    assert read(totals) == read(parts) and len(read(parts)) > 8
    again = spark.read.parquet(source).limit(0)
    rollup.upsert(rollup.partial(again), totals, 2)
    assert read(totals) == read(parts)
