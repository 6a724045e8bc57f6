"""Generator and streams: what is made is valid, and streams give what batches give."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gridloom.operators import dedup, state, validate
from gridloom.sources import generator, registry, streams
from gridloom.streaming import metrics, pipeline

FLEET = generator.Fleet(stations=12, sessions=3, fault_rate=0.3, duplicate_rate=0.2, late_rate=0.2)


@pytest.fixture(scope="module")
def made(spark):
    roster = generator.stations(spark, FLEET).cache()
    sent = generator.arrivals(generator.events(spark, FLEET), FLEET)
    from pyspark.sql import Window

    w = Window.orderBy("produced_at", "value")
    rows = sent.withColumn("offset", F.row_number().over(w).cast("long")).cache()
    return roster, rows


def test_roster(spark):
    many = generator.stations(spark, generator.Fleet(stations=50_000))
    assert many.select("station_id").distinct().count() == 50_000 and many.select("operator_id").distinct().count() == 5
    for bad in (dict(stations=0), dict(connectors=(3, 2)), dict(sessions=-1), dict(operators=()), dict(cities=()), dict(vehicles=()), dict(session_minutes=(5, 1, 10, 90)), dict(meter_seconds=(0, 5)), dict(idle_minutes=0), dict(fault_rate=1.5), dict(late_seconds=(5, 2)), dict(peak_windows=((9, 7, 1.0),))):
        with pytest.raises(ValueError):
            generator.Fleet(**bad).check()


def test_faults_and_gaps_follow_their_rates(spark):
    """Faults come by hours of charging, and gaps are shorter where a connector's own clock is at peak."""
    fleet = generator.Fleet(stations=150, sessions=6, fault_rate=0.5, idle_minutes=60, start="2026-07-01 15:30:00", peak_windows=((17, 20, 6.0),))
    roster = generator.stations(spark, fleet)
    plugs = generator.connectors(roster, fleet)
    runs = generator.sessions(roster, plugs, fleet).cache()
    r = runs.agg((F.sum("minutes") / 60).alias("hours"), F.count_if("faulted").alias("faults"), F.min("down").alias("least")).first()
    assert r["faults"] / r["hours"] == pytest.approx(0.5, rel=0.15) and r["least"] == 0
    from pyspark.sql import Window

    w = Window.partitionBy("station_id", "connector_id").orderBy("s")
    # a gap begins where the session before, and the repair after it, ended
    freed = F.unix_millis(F.lag("t_stop").over(w)) + F.lag("down").over(w) * 60000
    gaps = runs.select(F.hour(F.timestamp_millis(freed.cast("long"))).alias("h"), ((F.unix_millis("t_start") - freed) / 60000).alias("gap")).where("gap IS NOT NULL")
    mean = {r["peak"]: r["m"] for r in gaps.groupBy(F.col("h").between(17, 19).alias("peak")).agg(F.avg("gap").alias("m")).collect()}
    assert mean[True] == pytest.approx(10, rel=0.2) and mean[False] == pytest.approx(60, rel=0.2) and gaps.agg(F.min("gap")).first()[0] > 0.24
    assert generator.sessions(roster, plugs, generator.Fleet(sessions=0)).count() == 0


def test_generated_events_are_valid(spark, made):
    roster, rows = made
    out = validate.judged(validate.decode(rows), roster, registry.tariff_table(spark))
    assert out.groupBy("rule").count().collect() == [out.sparkSession.createDataFrame([(None, rows.count())], "rule string, count long").first()]
    kinds = {r["k"] for r in out.select(F.col("event.event_type").alias("k")).distinct().collect()}
    assert kinds == {"SESSION_START", "METER_UPDATE", "STATUS_CHANGE", "SESSION_STOP", "HEARTBEAT", "FAULT_ALERT"}
    assert rows.count() > rows.select("value").distinct().count()
    stops = out.where("event.event_type = 'SESSION_STOP'").select("event.*")
    assert stops.where("cost_eur <= 0 OR meter.energy_kwh <= 0 OR meter.soc_percent > 100").count() == 0
    assert stops.where("is_peak_priced AND tariff_id <> 'peak-rate-v2'").count() == 0


def test_streams_equal_batches(spark, made, tmp_path):
    roster, rows = made
    source = str(tmp_path / "raw")
    n = rows.count()
    junk = spark.createDataFrame([("k", "{", None, n + 1), ("k", '{"event_id": ""}', None, n + 2)], streams.RAW)
    all_rows = rows.select("key", "value", "produced_at", "offset").unionByName(junk)
    for part in range(3):
        all_rows.where((F.col("offset") > part * (n // 3)) & ((F.col("offset") <= (part + 1) * (n // 3)) | F.lit(part == 2))).coalesce(1).write.mode("append").json(source)
    known = {"stations": roster, "tariffs": registry.tariff_table(spark)}
    consumer = pipeline.Analytics(str(tmp_path / "a"), lambda: known, clock=lambda: 0.0)
    q = pipeline.start_analytics(streams.from_files(spark, source, 1), consumer, str(tmp_path / "c1"), availableNow=True)
    assert q.awaitTermination(180)
    clean = pipeline.clean_rows(spark, str(tmp_path / "a"))
    want = {r["id"] for r in rows.select(F.get_json_object("value", "$.event_id").alias("id")).collect()}
    assert clean.count() == len(want) == clean.select("event_id").distinct().count()
    assert pipeline.dead_letter_rows(spark, str(tmp_path / "a")).count() == 2
    m = consumer.metrics
    assert m.get("clean_produced") == len(want) and m.get("duplicates_dropped") == n - len(want)
    assert m.get("dead_letters", reason="invalid_json") == 1 and m.get("validation_errors", rule="missing_event_id") == 1
    assert m.frame(spark).count() > 5
    assert pipeline.lags(clean).where("ingestion_s IS NULL").count() == 0
    # a batch that is given again replaces itself
    consumer._marks.clear()  # as after a restart
    again = spark.read.schema(streams.RAW).json(source).where(F.col("offset") <= 20)
    for _ in range(2):
        consumer(again, 7)
        assert spark.read.parquet(consumer.path("clean", 7)).count() == again.select("value").distinct().count()

    real = pipeline.Realtime(str(tmp_path / "r"), lambda: known)
    q = pipeline.start_realtime(streams.from_files(spark, source, 100), real, str(tmp_path / "c2"), availableNow=True)
    assert q.awaitTermination(180)
    decoded, _ = validate.split(validate.judged(validate.decode(rows), roster, known["tariffs"]))
    fields = state.carried(F.col("event.event_type"), F.coalesce("event.status", F.lit("")), F.col("event.meter").isNotNull(), F.col("event.meter.power_kw"), F.col("event.meter.soc_percent"), F.coalesce("event.session_id", F.lit("")))
    writes = decoded.select(state.state_key(F.col("event.event_type"), F.col("event.station_id"), F.col("event.connector_id")).alias("key"), F.col("offset").alias("arrival"), F.col("event_time").alias("ts"), *[c.alias(k) for k, c in fields.items()])
    columns = ["key", "last_seen", "status", "power", "soc", "session"]
    assert sorted(map(str, real.read(spark).select(columns).collect())) == sorted(map(str, state.current_state(writes).select(columns).collect()))
    assert real.metrics.get("state_errors") == 0 and real.metrics.get("state_applied") > 0


def test_watermark_variant_drops_repeats(spark, tmp_path):
    source = str(tmp_path / "w")
    spark.createDataFrame([("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:30"), ("b", "2024-01-01 00:00:10")], "event_id string, t string").selectExpr("event_id", "to_timestamp(t) AS timestamp").coalesce(1).write.parquet(source)
    stream = spark.readStream.schema("event_id string, timestamp timestamp").parquet(source)
    q = dedup.within_watermark(stream).writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cw")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    assert sorted(r["event_id"] for r in spark.table("kept").collect()) == ["a", "b"]


def test_stateful_stream_equals_batch(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    rows = spark.range(200).selectExpr("concat('k', id % 5) AS key", "id AS arrival", "timestamp_seconds(1700000000 + id - if(id % 7 = 3, 30, 0)) AS ts", "if(id % 3 = 0, concat('s', id), NULL) AS status", "if(id % 4 = 1, double(id), NULL) AS power", "if(id % 4 = 1, int(id % 100), NULL) AS soc", "if(id % 5 = 2, concat('x', id), NULL) AS session")
    source = str(tmp_path / "s")
    for lo in (0, 100):
        rows.where(f"arrival >= {lo} AND arrival < {lo + 100}").coalesce(1).write.mode("append").parquet(source)
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(source)
    q = state.streaming_state(stream).writeStream.outputMode("update").format("memory").queryName("states").option("checkpointLocation", str(tmp_path / "cs")).trigger(availableNow=True).start()
    assert q.awaitTermination(240)
    got = spark.table("states")
    want = {r["arrival"]: r["applied"] for r in state.with_applied(rows).collect()}
    assert {r["arrival"]: r["applied"] for r in got.collect()} == want
    last = got.groupBy("key").agg(F.max_by("status", "arrival").alias("status"), F.max_by("power", "arrival").alias("power"))
    final = state.current_state(rows)
    assert sorted(map(str, last.select("key", "status", "power").collect())) == sorted(map(str, final.select("key", "status", "power").collect()))


def test_state_after_each_event_is_that_of_the_definition():
    import random

    import pandas as pd

    rng = random.Random(4)
    pick = lambda x: x if rng.random() < 0.5 else None
    for _ in range(60):
        events = [dict(ts=pd.Timestamp("2024-01-01") + pd.Timedelta(seconds=rng.randrange(20)), status=pick(f"s{rng.random():.2f}"), power=pick(rng.random()), soc=pick(rng.randrange(100)), session=pick("x")) for _ in range(rng.randrange(1, 12))]
        cut = rng.randrange(len(events) + 1)
        want = [(a, s["last_seen"], s["status"], s["power"], s["soc"], s["session"]) for _, a, s in state.apply_in_order(None, events)]
        got, held = [], None
        for part in (events[:cut], events[cut:]):
            if part:
                frame = state.after_each(held, pd.DataFrame(part))
                got += [tuple(None if isinstance(v, float) and v != v else v for v in r) for r in frame.itertuples(index=False)]
                held = got[-1][1:]
        assert got == want


def test_state_in_the_store_survives_a_restart_and_is_read_from_outside(spark, tmp_path):
    """Two batches, a key that falls silent, a restart from the checkpoint, reads of the store by key."""
    import time

    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    source, checkpoint = str(tmp_path / "s"), str(tmp_path / "c")
    kind = "key string, arrival long, ts timestamp, status string, power double, soc int, session string"

    def batch(rows, ttl=None):
        spark.createDataFrame(rows, kind).coalesce(1).write.mode("append").parquet(source)
        stream = spark.readStream.schema(kind).parquet(source)
        trigger = {"availableNow": True} if ttl is None else {"processingTime": "200 milliseconds"}
        q = state.streaming_state(stream, ttl).writeStream.outputMode("update").format("noop").option("checkpointLocation", checkpoint if ttl is None else checkpoint + "t").trigger(**trigger).start()
        if ttl is None:
            assert q.awaitTermination(240)
        else:
            end = time.monotonic() + 60  # such a query runs on, also without rows
            while sum(p["numInputRows"] for p in q.recentProgress) < len(rows) and time.monotonic() < end:
                time.sleep(0.2)
            q.stop()

    at = lambda s: datetime(2024, 1, 1, 0, 0, s)
    batch([("a", 1, at(10), "Charging", 5.0, 40, "x"), ("b", 2, at(10), "Available", None, None, None)])
    batch([("a", 3, at(5), "Faulted", None, None, None), ("a", 4, at(20), None, 7.0, None, "")])  # another process; b is silent
    read = lambda c=checkpoint: {r["key"]: (r["status"], r["power"], r["soc"], r["session"], r["last_seen"].second) for r in state.stored_state(spark, c).collect()}
    assert read() == {"a": ("Charging", 7.0, 40, "", 20), "b": ("Available", None, None, None, 10)}
    one = state.stored_state(spark, checkpoint).where("key = 'a'")
    assert [r["power"] for r in one.collect()] == [7.0]
    # with a time to live, keys that nothing refreshed are gone for readers, and then any event applies
    batch([("a", 1, at(10), "Charging", 5.0, 40, "x"), ("b", 2, at(10), "Available", None, None, None)], ttl=25)
    assert set(read(checkpoint + "t")) == {"a", "b"}
    time.sleep(26)
    batch([("a", 5, at(1), "Faulted", None, None, None)], ttl=25)
    assert {k: v[:2] for k, v in read(checkpoint + "t").items()} == {"a": ("Faulted", None)}


def test_dashboard_queries(spark):
    samples = spark.createDataFrame([("a", "i", f"2024-01-01 00:00:{s:02d}", v) for s, v in ((0, 10), (20, 40), (40, 5))], "kind string, instance string, t string, value long").selectExpr("kind", "instance", "to_timestamp(t) AS at", "value")
    assert metrics.rates(samples, "kind").first()["per_second"] == pytest.approx(35 / 60)
    h = {r["le"]: r["n"] for r in metrics.histogram(spark.createDataFrame([(0.5,), (2.0,), (99.0,)], "x double"), "x", (1, 5)).collect()}
    assert h == {1.0: 1, 5.0: 2, float("inf"): 3}
    p = metrics.quantiles(spark.range(101).selectExpr("double(id) AS x"), "x").first()
    assert (p["p50"], p["p95"], p["p99"]) == (50, 95, 99)


def _raw(spark, rows):
    return spark.createDataFrame(rows, streams.RAW)


def _beat(key, at, n, **more):
    import json

    e = {"event_id": f"00000000-0000-4000-8000-{n:012d}", "event_type": "STATUS_CHANGE", "station_id": "ST-1", "connector_id": key, "timestamp": f"2024-01-01T00:00:{at:02d}.000Z", "operator_id": "Op", "location": {"lat": 41.0, "lon": 29.0, "city": "C", "country": "TR"}, "status": "Available"}
    return ("k", json.dumps({**e, **more}), None, n)


@pytest.fixture(scope="module")
def one_station(spark):
    from gridloom.functions.schema import STATIONS

    return {"stations": spark.createDataFrame([("ST-1", "Op", "C", "TR", 41.0, 29.0, 9, None)], STATIONS), "tariffs": registry.tariff_table(spark)}


def test_state_survives_restarts_and_forgets_silent_keys(spark, one_station, tmp_path):
    from gridloom.operators import versions

    clock = [1000]
    now = lambda: F.timestamp_seconds(F.lit(clock[0]))
    consumer = lambda: pipeline.Realtime(str(tmp_path), lambda: one_station, now=now, retry_seconds=0, keep_seconds=0)
    consumer()(_raw(spark, [_beat(1, 10, 1), _beat(2, 10, 2, status="Charging")]), 0)
    clock[0] += 200
    # another process goes on from what is stored: an older event of connector 1 stays stale
    consumer()(_raw(spark, [_beat(1, 5, 3, status="Faulted"), _beat(1, 20, 4, status="Charging")]), 1)
    state_of = lambda c: {r["key"]: (r["status"], r["last_seen"].second) for r in c.read(spark).collect()}
    assert state_of(consumer()) == {"station:ST-1:1": ("Charging", 20), "station:ST-1:2": ("Charging", 10)}
    # a batch that is given again starts from the version before it
    again = consumer()
    again(_raw(spark, [_beat(1, 5, 3, status="Faulted"), _beat(1, 20, 4, status="Charging")]), 1)
    assert again.metrics.get("state_applied") == 1 and again.metrics.get("state_stale_skipped") == 1
    # connector 2 has been silent for 310 s and is forgotten; an older event then applies to it
    clock[0] += 110
    assert state_of(consumer()) == {"station:ST-1:1": ("Charging", 20)}
    last = consumer()
    last(_raw(spark, [_beat(2, 1, 5, status="Faulted"), _beat(9, 1, 6, event_type="NOPE")]), 2)
    assert state_of(last) == {"station:ST-1:1": ("Charging", 20), "station:ST-1:2": ("Faulted", 1)}
    assert last.metrics.get("invalid_skipped") == 1 and last.metrics.get("state_errors") == 0
    assert [v for v, _ in versions.listed(spark, last.root)] == [1, 2]
    # a version that was cut off counts for nothing
    spark.range(1).write.parquet(versions.place(last.root, 3))
    assert state_of(consumer()) == state_of(last)


def test_a_read_state_outlives_the_next_batches(spark, one_station, tmp_path):
    """A frame from read() serves while later batches replace what it reads."""
    consumer = pipeline.Realtime(str(tmp_path), lambda: one_station, retry_seconds=0)
    consumer(_raw(spark, [_beat(1, 10, 1)]), 0)
    held = consumer.read(spark)
    for k in range(1, 5):
        consumer(_raw(spark, [_beat(1, 10 + k, 1 + k, status="Charging")]), k)
    assert [r["status"] for r in held.collect()] == ["Available"] and [r["status"] for r in consumer.read(spark).collect()] == ["Charging"]
    # kept by age, not by number
    from gridloom.operators import versions

    assert len(versions.listed(spark, consumer.root)) == 5
    versions.complete(spark, consumer.root, 4, keep_seconds=0)
    assert [v for v, _ in versions.listed(spark, consumer.root)] == [3, 4]


def test_marks_survive_restarts_and_expire(spark, one_station, tmp_path):
    import os

    clock, folder = [0.0], str(tmp_path / "a")
    sent, refused = [], []
    ways = dict(publish=lambda m: sent.extend(m.collect()), reject=lambda m: refused.extend(m.collect()), landing=str(tmp_path / "landing"), revenue=str(tmp_path / "revenue"), most=2)
    consumer = lambda: pipeline.Analytics(folder, lambda: one_station, clock=lambda: clock[0], **ways)
    rows = [_beat(1, 10, 1), _beat(2, 10, 2)]
    first = consumer()
    first(_raw(spark, rows), 0)
    assert first.metrics.get("clean_produced") == 2 and first.metrics.get("batches", reason="size") == 1
    clock[0] = 60.0
    second = consumer()
    second(_raw(spark, [rows[0]]), 1)
    assert second.metrics.get("clean_produced") == 0 and second.metrics.get("duplicates_dropped") == 1 and second.metrics.get("batches", reason="timer") == 1
    clock[0] = 150.0
    third = consumer()
    third(_raw(spark, [rows[0], ("key", "{", None, 9)]), 2)
    assert third.metrics.get("clean_produced") == 1
    assert sorted(os.listdir(f"{folder}/seen")) == ["at=150000_batch=2", "at=60000_batch=1"]
    assert [r["key"] for r in sent] == ["ST-1"] * 3 and [r["key"] for r in refused] == ["key"]
    letters = validate.read_dead_letters(spark.createDataFrame([tuple(r) for r in refused] + [("x", "{")], "key string, value string")).collect()
    assert [(r["raw_payload"], r["error"]) for r in letters] == [("{", "invalid json")] and letters[0]["ingested_at"] is not None
    # marks that cannot be read let duplicates through
    for f in os.listdir(f"{folder}/seen/at=150000_batch=2"):
        if f.endswith(".parquet"):
            with open(f"{folder}/seen/at=150000_batch=2/{f}", "wb") as out:
                out.write(b"no parquet")
    fourth = consumer()
    fourth(_raw(spark, [rows[0]]), 3)
    assert fourth.metrics.get("dedup_errors") == 1 and fourth.metrics.get("clean_produced") == 1
    from gridloom.operators import storage

    stored = storage.scan(spark, ways["landing"])
    assert stored.count() == 4 and dedup.latest_version(stored).count() == 2


def test_unknown_types_are_one_label(spark, one_station):
    m = metrics.Metrics()
    rows = validate.judged(validate.decode(_raw(spark, [_beat(1, 1, n, event_type=f"T{n}") for n in range(5)])), one_station["stations"], one_station["tariffs"])
    m.count_batch(rows, rows.limit(0))
    assert m.get("events_consumed", event_type="other") == 5 and len([k for k in m.counts if k[0] == "events_consumed"]) == 1


def test_metrics_endpoint_and_panels(spark):
    from urllib.error import HTTPError
    from urllib.request import urlopen

    m = metrics.Metrics()
    m.add("events_consumed", 3, event_type='a"b')
    m.set("batch_size", 2.5)
    for x in (0.5, 3, 99):
        m.observe("flush_s", x, (1, 5))
    server = metrics.serve(m)
    try:
        at = f"http://127.0.0.1:{server.server_address[1]}"
        text = urlopen(f"{at}/metrics").read().decode()
        with pytest.raises(HTTPError):
            urlopen(f"{at}/other")
    finally:
        server.shutdown()
    assert text == '# TYPE events_consumed_total counter\nevents_consumed_total{event_type="a\\"b"} 3\n# TYPE batch_size gauge\nbatch_size 2.5\n# TYPE flush_s histogram\nflush_s_bucket{le="1"} 1\nflush_s_bucket{le="5"} 2\nflush_s_bucket{le="+Inf"} 3\nflush_s_sum 102.5\nflush_s_count 3\n'
    buckets = spark.createDataFrame([("transport_s", 1.0, 10), ("transport_s", 2.0, 30), ("transport_s", float("inf"), 30)], "name string, le double, n long")
    got = {r["q"]: r["value"] for r in metrics.quantile_panel(buckets, "transport lag").collect()}
    assert got == pytest.approx({0.5: 1.25, 0.95: 1.925, 0.99: 1.985})
    samples = spark.createDataFrame([("events_consumed", {"event_type": "x"}, i, f"2024-01-01 00:00:{s:02d}", v) for i in "ab" for s, v in ((0, 10), (30, 70))], "name string, labels map<string,string>, instance string, t string, value long").selectExpr("name", "labels", "instance", "to_timestamp(t) AS at", "value")
    assert metrics.rate_panel(samples, "consumed").first()["per_second"] == pytest.approx(2.0)
    assert metrics.behind('{"raw": {"0": 5, "1": 9}}', '{"raw": {"0": 8, "1": 7, "2": 4}}') == 7 and metrics.behind(None, "7") == 0


def test_every_panel_has_a_source(spark, one_station, tmp_path):
    """Lags are counted in the write of each batch, by group; quantiles of panels come from them."""
    moment = lambda s: F.timestamp_seconds(F.lit(1704067200 + s))
    raw = _raw(spark, [_beat(1, 10, 1), _beat(2, 10, 2)]).withColumn("produced_at", moment(11))
    a = pipeline.Analytics(str(tmp_path / "a"), lambda: one_station, now=lambda: moment(14))
    b = pipeline.Realtime(str(tmp_path / "b"), lambda: one_station, now=lambda: moment(12), retry_seconds=0)
    started = []
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("batch", "")
    a(raw, 0)
    b(raw, 0)
    started += jobs.getJobIdsForGroup("batch")
    assert b.metrics.get("state_errors") == 0
    text = a.metrics.text() + b.metrics.text()
    for name, total in (("transport_s", 6.0), ("ingestion_s", 8.0)):
        assert f'{name}_sum{{group="analytics"}} {total}' in text and f'{name}_count{{group="analytics"}} 2' in text
    assert 'transport_s_bucket{group="analytics",le="2.5"} 0' in text and 'transport_s_bucket{group="analytics",le="5"} 2' in text
    assert 'state_s_sum{group="realtime"} 2.0' in text and 'state_applied_total{group="realtime"} 2' in text
    made_ = set(a.metrics.spreads) | set(b.metrics.spreads)
    assert {name for name, _ in metrics.QUANTILE_PANELS.values()} <= made_
    counters = {n for m in (a.metrics, b.metrics) for n, _ in m.counts}
    assert {n for n, _ in metrics.RATE_PANELS.values()} - {"events_generated", "validation_errors", "dead_letters"} <= counters


def test_generator_counters(spark, made):
    m = metrics.Metrics()
    m.count_sent(made[1])
    assert sum(n for (name, _), n in m.counts.items() if name == "events_generated") == made[1].count()
    assert sum(n for (name, _), n in m.counts.items() if name == "duplicates_injected") > 0


def test_settings():
    from gridloom.streaming import settings

    assert settings.read({}) == settings.Settings() and settings.read({"realtime": {"batch_rows": 9}}).realtime == settings.Group(9, 25)
    assert settings.Settings().analytics.trigger() == {"processingTime": "1000 milliseconds"}
    for bad, why in (({"x": 1}, "unknown"), ({"servers": " "}, "empty"), ({"dedup_ttl_seconds": 0}, "above 0"), ({"raw_topic": "clean"}, "differ"), ({"metrics_port": 70000}, "between"), ({"analytics": {"batch_rows": "x"}}, "whole"), ({"folder": 3}, "text"), ({"realtime": {"batch_millis": 0}}, "realtime.batch_millis")):
        with pytest.raises(ValueError, match=why):
            settings.read(bad)
