"""Validation, flattening, state, storage, gates and streams on hand-made rows."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from gridloom.functions import scalars
from gridloom.functions.schema import CLEAN_COLUMNS, STATIONS
from gridloom.operators import dedup, flatten, gates, rollup, state, storage, validate
from gridloom.plans import reports
from gridloom.sources import registry

ID = "a1b2c3d4-e5f6-7890-abcd-ef1234567890"


def event(**changes):
    e = {
        "event_id": ID, "event_type": "METER_UPDATE", "station_id": "ST-1", "connector_id": 1, "session_id": "s1", "timestamp": "2026-07-01T09:59:00.000Z", "operator_id": "Op",
        "location": {"lat": 41.0, "lon": 29.0, "city": "C", "country": "TR"}, "meter": {"power_kw": 50.0, "energy_kwh": 12.5, "voltage_v": 400, "current_a": 125, "soc_percent": 60}, "tariff_id": "standard-v1",
    }
    for path, value in changes.items():
        at, *rest = path.split("__")
        if rest:
            e[at] = {**e[at], rest[0]: value}
        else:
            e[at] = value
    return e


@pytest.fixture(scope="module")
def known(spark):
    return spark.createDataFrame([("ST-1", "Op", "C", "TR", 41.0, 29.0, 2, None)], STATIONS), registry.tariff_table(spark)


def judge(spark, known, payloads):
    raw = spark.createDataFrame([(i, p if isinstance(p, str) else json.dumps(p)) for i, p in enumerate(payloads)], "offset long, value string")
    return [r["rule"] for r in validate.judged(validate.decode(raw), *known).orderBy("offset").collect()]


START, STATUS, FAULT = {"event_type": "SESSION_START", "vehicle": {"brand": "b"}}, {"event_type": "STATUS_CHANGE", "meter": None}, {"event_type": "FAULT_ALERT", "meter": None}
CASES = [
    (event(), None), (event(event_id=""), "missing_event_id"), (event(event_id=ID + "0"), "bad_event_id"), (event(event_id=ID.replace("-", "0", 1)), "bad_event_id"), (event(event_type="NOPE"), "unknown_event_type"),
    (event(station_id="ST-9"), "unknown_station"), (event(timestamp="not-a-time"), "bad_timestamp"), (event(timestamp="2026-07-01"), "bad_timestamp"), (event(operator_id=""), "missing_operator"),
    (event(location__city=""), "missing_location"), (event(location__lat=91.0), "bad_geo"), (event(operator_id="Other"), "operator_mismatch"), (event(location__city="D"), "city_mismatch"),
    (event(location__country="DE"), "country_mismatch"), (event(location__lat=40.0), "geo_mismatch"), (event(location__lat=41.00005, location__lon=28.99995), None),
    (event(event_type="HEARTBEAT", connector_id=1), "bad_connector"), (event(event_type="HEARTBEAT", connector_id=0), None), (event(connector_id=9), "connector_out_of_range"), (event(tariff_id="ghost"), "unknown_tariff"),
    (event(session_id=None), "missing_session"), (event(event_type="SESSION_START"), "missing_vehicle"), (event(**START), None), (event(**START, tariff_id=""), "missing_tariff"), (event(meter=None), "missing_meter"),
    (event(event_type="SESSION_STOP", cost_eur=-1.0), "bad_cost"), (event(**STATUS, status="Weird"), "bad_status"), (event(**STATUS, status="Faulted"), None), (event(**FAULT), "missing_fault"),
    (event(**FAULT, fault={"error_code": "X"}), None), (event(meter__soc_percent=150), "soc_out_of_range"), (event(meter__power_kw=1000.5), "bad_power"), (event(meter__energy_kwh=-1.0), "bad_energy"),
    (event(meter__voltage_v=-1.0), "bad_voltage"), (event(meter__current_a=-1.0), "bad_current"), (event(event_id="", event_type="NOPE"), "missing_event_id"),
    (json.dumps(event()) + "}", "invalid_json"), (json.dumps(event()) + json.dumps(event()), "invalid_json"), (event(connector_id="x"), "invalid_json"), (event(connector_id=1.5), "invalid_json"), ("", "invalid_json"), ("[1]", "invalid_json"),
    ("null", "missing_event_id"), (event(unknown_key=1), None),
]


def test_first_broken_rule_names_the_reason(spark, known):
    assert judge(spark, known, [c for c, _ in CASES]) == [r for _, r in CASES]
    assert {r for _, r in CASES if r} == set(validate.RULES) == {r.name for r in validate.rules()}


def test_flatten_fills_what_is_missing(spark, known):
    raw = spark.createDataFrame([(json.dumps(event()),), (json.dumps(event(**FAULT, fault={"error_code": "X"}, is_peak_priced=True)),)], "value string")
    rows = flatten.flatten(validate.judged(validate.decode(raw), *known), F.lit(datetime(2026, 7, 1)), F.lit(datetime(2026, 7, 1)))
    assert rows.columns == CLEAN_COLUMNS and len(CLEAN_COLUMNS) == 27
    meter, fault = sorted(rows.collect(), key=lambda r: r["event_type"], reverse=True)
    assert meter["power_kw"] == 50 and meter["city"] == "C" and meter["error_code"] == "" and meter["vehicle_brand"] == "" and meter["is_peak_priced"] == 0
    assert fault["power_kw"] == 0 and fault["soc_percent"] == 0 and fault["error_code"] == "X" and fault["is_peak_priced"] == 1
    assert not any(v is None for r in (meter, fault) for v in r)
    again = flatten.from_json(flatten.to_json(rows))
    assert sorted(again.collect()) == sorted(rows.collect())
    broken = flatten.to_json(rows).select("key", F.lit("{").alias("value"))
    assert flatten.from_json(flatten.to_json(rows).unionByName(broken), strict=False).count() == 2


T = datetime(2024, 1, 10)
FLAT = "event_id string, event_type string, station_id string, connector_id int, session_id string, timestamp timestamp_ntz, ingested_at timestamp_ntz, operator_id string, city string, tariff_id string, power_kw double, energy_kwh double, cost_eur double, status string, is_peak_priced int, vehicle_brand string, lat double, lon double"


def flat(spark, rows):
    base = dict(event_id="e", event_type="METER_UPDATE", station_id="s", connector_id=1, session_id="x", timestamp=T, ingested_at=T, operator_id="o", city="c", tariff_id="t", power_kw=0.0, energy_kwh=0.0, cost_eur=0.0, status="", is_peak_priced=0, vehicle_brand="", lat=0.0, lon=0.0)
    names = [c.split()[0] for c in FLAT.split(", ")]
    return spark.createDataFrame([tuple({**base, "event_id": f"e{i}", **r}[n] for n in names) for i, r in enumerate(rows)], FLAT)


def test_latest_version_and_batch_order(spark):
    df = flat(spark, [dict(event_id="a", ingested_at=T), dict(event_id="a", ingested_at=T + timedelta(seconds=1), cost_eur=2.0), dict(event_id="a", station_id="other")])
    kept = dedup.latest_version(df).collect()
    assert sorted((r["station_id"], r["cost_eur"]) for r in kept) == [("other", 0.0), ("s", 2.0)]
    assert dedup.audit(df).first().asDict() == {"total_rows": 3, "unique_events": 1, "duplicates": 2}
    batch = spark.createDataFrame([("e1", 1), ("e1", 2), ("e2", 3)], "event_id string, offset long")
    assert sorted(map(tuple, dedup.first_in_batch(batch).collect())) == [("e1", 1), ("e2", 3)]
    seen = spark.createDataFrame([("e1", T), ("e2", T - timedelta(seconds=200))], "event_id string, marked_at timestamp_ntz")
    assert sorted({r[0] for r in dedup.unseen(batch, seen, now=F.lit(T).cast("timestamp_ntz")).collect()}) == ["e2"]


def test_hourly_energy_edges(spark):
    h = timedelta(hours=1)
    rows = [dict(timestamp=T - timedelta(days=7) - h, energy_kwh=5.0), dict(timestamp=T - timedelta(days=7) + h, energy_kwh=8.0), dict(session_id="y", timestamp=T - 2 * h, energy_kwh=5.0), dict(session_id="y", timestamp=T - h, energy_kwh=3.0), dict(session_id="y", timestamp=T, energy_kwh=4.0)]
    got = [(r["hour"], r["energy_kwh"]) for r in reports.hourly_energy(flat(spark, rows)).collect()]
    assert got == [(T - timedelta(days=7) + h, 3.0), (T - 2 * h, 5.0), (T - h, 0.0), (T, 1.0)]
    assert reports.hourly_energy(flat(spark, rows).limit(0)).count() == 0


def test_uptime_carries_status_forward(spark):
    rows = [dict(event_type="STATUS_CHANGE", status="Available", timestamp=T - timedelta(days=20)), dict(event_type="STATUS_CHANGE", status="Faulted", timestamp=T - timedelta(days=9)), dict(timestamp=T), dict(event_type="STATUS_CHANGE", station_id="z", status="Faulted", timestamp=T)]
    got = {r["station_id"]: (r["total_s"], r["downtime_s"], r["uptime_ratio"]) for r in reports.station_uptime(flat(spark, rows)).collect()}
    assert got == {"s": (7 * 86400, 7 * 86400, 0.0), "z": (0, 0, None)}


def test_incomplete_sessions_and_zero_revenue(spark):
    rows = [dict(event_type="SESSION_START", vehicle_brand="b"), dict(event_type="SESSION_STOP", session_id="other", timestamp=T)]
    df = flat(spark, rows)
    assert reports.sessions_by_brand(df).count() == 0
    assert reports.revenue(df).first()["peak_pct"] is None
    assert reports.power_anomalies(df).count() == 0


def test_rollup_counts_copies_until_reconciled(spark):
    day = T - timedelta(hours=20)
    stop = dict(event_type="SESSION_STOP", event_id="a", cost_eur=3.0, timestamp=day)
    df = flat(spark, [stop, {**stop, "ingested_at": T + timedelta(seconds=9)}, dict(timestamp=T + timedelta(hours=1))])
    parts = rollup.partial(df)
    assert [(r["revenue_eur"], r["sessions"]) for r in rollup.merged(parts).collect()] == [(6.0, 2)]
    assert [(r["revenue_eur"], r["sessions"]) for r in rollup.reconciled(parts, df).collect()] == [(3.0, 1)]


def test_drift_gate(spark):
    spans = [(T - timedelta(days=10), 1.0), (T - timedelta(days=3), 1.0)]
    rows = [dict(timestamp=t + timedelta(minutes=k), power_kw=v * (k + 1)) for t, v in spans for k in range(50)] + [dict(timestamp=T, power_kw=0.0)]
    assert gates.drift(flat(spark, rows), "power_kw").first()["psi"] == pytest.approx(0, abs=1e-9)
    moved = rows[:50] + [{**r, "power_kw": 900.0} for r in rows[50:]]
    bad = gates.drift(flat(spark, moved), "power_kw")
    assert not bad.first()["passed"]
    with pytest.raises(gates.GateFailed):
        gates.require(bad, "drift")
    flat_rows = [{**r, "power_kw": 7.0} for r in rows]
    assert gates.drift(flat(spark, flat_rows), "power_kw").count() == 0
    empty = flat(spark, rows).limit(0)
    now = F.lit(T).cast("timestamp_ntz")
    assert not gates.freshness(empty, now).first()["passed"]
    assert gates.dead_letter_rate(empty, empty, now).first()["rate"] == 0


def test_compare_and_set(spark):
    at = lambda s: T + timedelta(seconds=s)
    rows = [(1, "STATUS_CHANGE", 10, "Charging", None), (2, "METER_UPDATE", 12, "", 50.0), (3, "STATUS_CHANGE", 11, "Faulted", None), (4, "METER_UPDATE", 12, "", 60.0), (5, "SESSION_STOP", 13, "", 99.0)]
    df = spark.createDataFrame([(o, k, "s", 1, "sess", at(t), st_, p or 0.0, 40) for o, k, t, st_, p in rows], "offset long, event_type string, station_id string, connector_id int, session_id string, timestamp timestamp_ntz, status string, power_kw double, soc_percent int")
    w = state.writes(df, "offset")
    assert [r["applied"] for r in state.with_applied(w).orderBy("arrival").collect()] == [True, True, False, True, True]
    s = state.current_state(w).first()
    assert (s["key"], s["status"], s["power"], s["soc"], s["session"], s["last_seen"]) == ("station:s:1", "Charging", 0.0, 40, "", at(13))
    beat = state.writes(df.limit(1).withColumn("event_type", F.lit("HEARTBEAT")), "offset").first()
    assert beat["key"] == "station_liveness:s" and beat["status"] is None
    # a time to live that runs out lets any event in
    seq = [{"ts": 100, "at": 0}, {"ts": 50, "at": 10}, {"ts": 50, "at": 302}]
    assert [a for _, a, _ in state.apply_in_order(None, seq, ttl=300)] == [True, False, True]


def test_scalars(spark):
    one = spark.range(1)
    pick = lambda c: one.select(c.alias("x")).first()["x"]
    assert pick(scalars.parse_rfc3339(F.lit("2026-07-01"))) is None
    assert pick(scalars.parse_rfc3339(F.lit("2026-07-01T10:00:00+02:00")).cast("string")) == "2026-07-01 08:00:00"
    assert pick(scalars.format_rfc3339(F.lit("2026-07-01 08:00:00.5").cast("timestamp"))) == "2026-07-01T08:00:00.500Z"
    assert [pick(scalars.in_peak(F.lit(h))) for h in (6, 7, 8, 9, 16, 17, 19, 20)] == [False, True, True, False, False, True, True, False]
    assert pick(scalars.taper_power(F.lit(80.0), F.lit(100.0))) == pytest.approx(100) and pick(scalars.taper_power(F.lit(100.0), F.lit(100.0))) == pytest.approx(8)
    assert pick(scalars.bucket_of(F.lit(5.0), F.array(*map(F.lit, (1.0, 5.0, 9.0))))) == 2
    assert pick(scalars.ratio(F.lit(1), F.lit(0))) is None


def test_landing_table(spark, tmp_path):
    path = str(tmp_path / "events")
    jan, feb = flat(spark, [dict(event_id="a", timestamp=T)]), flat(spark, [dict(event_id="b", timestamp=datetime(2024, 2, 3))])
    again = flat(spark, [dict(event_id="a", timestamp=T, ingested_at=T + timedelta(seconds=5), cost_eur=1.0)])
    for df in (jan, feb, again):
        storage.append(df, path)
    listed = {str(r["yyyymm"]): (r["files"], r["rows"]) for r in storage.parts(storage.scan(spark, path)).collect()}
    assert listed == {"202401": (2, 2), "202402": (1, 1)}
    assert storage.closed_month(datetime(2024, 2, 20)) == "202401" and storage.closed_month(datetime(2024, 1, 2)) == "202312"
    assert storage.compact(spark, path, "202401") and not storage.compact(spark, path, "202402")
    assert [(r["event_id"], r["cost_eur"]) for r in storage.scan(spark, path).orderBy("event_id").collect()] == [("a", 1.0), ("b", 0.0)]
    assert storage.scan(spark, path, since=datetime(2024, 2, 1)).count() == 1
    assert storage.cutoff(datetime(2025, 3, 15)) == datetime(2024, 2, 1)
    assert storage.drop_expired(spark, path, datetime(2025, 3, 15)) == ["202401"]
    storage.write_csv(spark.range(3), str(tmp_path / "csv"))
    assert spark.read.option("header", True).csv(str(tmp_path / "csv")).count() == 3


def test_registry(spark, tmp_path):
    one = {"stations": spark.createDataFrame([("ST-1", "Op", "C", "TR", 41.0, 29.0, 2, None)], STATIONS), "connectors": spark.createDataFrame([("ST-1", 1), ("ST-2", 1)], "station_id string, connector_id int"), "tariffs": registry.tariff_table(spark)}
    registry.seed(one, str(tmp_path))
    registry.seed(one, str(tmp_path))
    tables = registry.load_until_ready(lambda: registry.from_parquet(spark, str(tmp_path)), 5, 0.1)
    assert {r["name"]: r["n"] for r in registry.counts(tables).collect()} == {"stations": 1, "connectors": 2, "tariffs": 4}
    assert [r["station_id"] for r in registry.orphans(tables["connectors"], tables["stations"], "station_id").collect()] == ["ST-2"]
    assert registry.repeated_keys(tables["stations"], "station_id").count() == 0
    clock, calls = [0.0], []

    def load():
        calls.append(1)
        if len(calls) == 2:
            raise OSError("gone")
        return {"stations": one["stations"] if len(calls) < 4 else one["stations"].limit(0), "n": len(calls)}

    snap = registry.Snapshot(load, 300, lambda: clock[0])
    for at, want in ((10, 1), (301, 1), (602, 3), (903, 3)):
        clock[0] = at
        assert snap.get()["n"] == want
    with pytest.raises(TimeoutError):
        registry.load_until_ready(lambda: {"stations": one["stations"].limit(0)}, 0.2, 0.05)


def stored(spark, path, rows):
    storage.append(flat(spark, rows), path)
    return storage.scan(spark, path)


def test_report_bounds_reach_the_scan(spark, tmp_path):
    """Months are pruned, times pushed down, and only the columns of the report read, below versions."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    rows = stored(spark, str(tmp_path / "events"), [dict(event_type=k, timestamp=T - timedelta(days=40 * n), status="Faulted", cost_eur=1.0) for n in range(4) for k in ("SESSION_STOP", "STATUS_CHANGE")])
    for report, unread in ((reports.revenue, ("energy_kwh", "lat", "session_id")), (reports.fault_geography, ("energy_kwh", "cost_eur")), (lambda r: rollup.exact_day(r, rollup.day_before(r)), ("energy_kwh", "lat", "status"))):
        plan = report(rows)._jdf.queryExecution().executedPlan().toString()
        scan = next(x for x in plan.split("\n") if "FileScan" in x)
        assert "PartitionFilters" in scan and "yyyymm" in scan.partition("PartitionFilters")[2].partition("]")[0]
        assert "GreaterThanOrEqual(timestamp," in scan
        assert not any(c in scan.partition("ReadSchema")[2] for c in unread)
        assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert reports.revenue(rows).first()["sessions"] == 1 and reports.revenue(rows.limit(0)).count() == 0


def test_exact_quantiles_equal_a_sort(spark):
    import random

    import numpy as np

    rng = random.Random(3)
    for n in (1, 2, 3, 11, 1000, 30_000):
        xs = [rng.choice([rng.gauss(0, 1), 7.0, 1e6 * rng.random() ** 9]) for _ in range(n)]
        df = spark.createDataFrame([(x,) for x in xs] + [(None,)], "x double")
        cuts = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
        assert gates.exact_quantiles(df, "x", cuts) == pytest.approx(np.quantile(xs, cuts).tolist())
    assert gates.exact_quantiles(df.limit(0), "x", cuts) is None


@pytest.mark.parametrize("ranked", [100_000, 40])
def test_quantiles_of_all_groups_at_once(spark, ranked):
    """Equal to a sort, whether brackets hold whole groups or are narrowed; one group holds most rows."""
    import random

    import numpy as np

    rng, groups = random.Random(3), {}
    for name, n in (("one", 1), ("two", 2), ("ties", 500), ("hot", 6000), (None, 90)):
        groups[name] = [7.0 if name == "ties" and rng.random() < 0.9 else rng.choice([rng.gauss(0, 1), 1e6 * rng.random() ** 9]) for _ in range(n)]
    rows = [(g, x) for g, xs in groups.items() for x in xs] + [("none", None), ("one", None)]
    df = spark.createDataFrame(rows, "g string, x double").repartition(4)
    cuts = [0.0, 0.1, 0.5, 0.95, 1.0]
    got = {(r["g"], r["k"]): r["value"] for r in gates.exact_quantiles_by(df, "x", ["g"], cuts, ranked).collect()}
    want = {(g, k): v for g, xs in groups.items() for k, v in enumerate(np.quantile(xs, cuts).tolist())}
    assert set(got) == set(want) and all(got[k] == pytest.approx(want[k]) for k in want)
    assert gates.exact_quantiles_by(df.limit(0), "x", ["g"], cuts).count() == 0


def test_stored_rollup_and_daily_run(spark, tmp_path):
    from gridloom.plans import daily

    stop = dict(event_type="SESSION_STOP", event_id="a", cost_eur=3.0, timestamp=T - timedelta(hours=20))
    events = [stop, {**stop, "ingested_at": T + timedelta(seconds=9)}, {**stop, "event_id": "b", "timestamp": T - timedelta(days=3)}, dict(timestamp=T + timedelta(hours=1), ingested_at=T + timedelta(hours=1))]
    rows, revenue = stored(spark, str(tmp_path / "events"), events), str(tmp_path / "revenue")
    for _ in range(2):  # the second is the same batch again
        rollup.append_parts(rollup.partial(rows), revenue, batch=4)
    read = lambda: sorted((r["revenue_eur"], r["sessions"]) for r in rollup.stored(spark, revenue).collect())
    assert read() == [(3.0, 1), (6.0, 2)]
    dead = spark.createDataFrame([], "raw_payload string, error string, ingested_at timestamp")
    run = daily.Daily(spark, str(tmp_path / "events"), revenue, dead, T + timedelta(hours=2))
    done = run.run()
    assert [n for n, _ in done] == list(daily.TASKS) and done[2] == ("reconcile", "2024-01-09") and done[4] == ("retention", "none")
    assert read() == [(3.0, 1), (3.0, 1)]
    assert rollup.overwrite_day(rows, revenue) and read() == [(3.0, 1), (3.0, 1)]
    late = daily.Daily(spark, str(tmp_path / "events"), revenue, dead, T + timedelta(days=3))
    with pytest.raises(gates.GateFailed):
        late.run()
    assert late.done == [] and late.next == "freshness"


def test_sql_files_and_charts(spark, tmp_path):
    from gridloom.plans import runner

    runner.views(flat(spark, [dict(event_id="a"), dict(event_id="a", ingested_at=T + timedelta(seconds=1)), dict(event_id="b")]))
    (tmp_path / "A1_all.sql").write_text("SELECT count(*) AS n FROM events_raw;\n")
    (tmp_path / "A2_final.sql").write_text("-- one row an event\nSELECT event_id, count(*) AS n FROM events_final GROUP BY 1 ORDER BY 1 ;")
    (tmp_path / "notes.txt").write_text("no query")
    found = runner.run(spark, str(tmp_path), str(tmp_path / "out"))
    assert list(found) == ["A1_all", "A2_final"] and found["A1_all"].first()["n"] == 3 and found["A2_final"].count() == 2
    assert spark.read.option("header", True).csv(str(tmp_path / "out" / "A2_final")).count() == 2
    import xml.dom.minidom

    rows = found["A2_final"].collect()
    for kind in ("bar", "barh", "line"):
        svg = runner.chart(rows, "event_id", "n", kind, "a < b")
        xml.dom.minidom.parseString(svg)
        assert "a &lt; b" in svg
    xml.dom.minidom.parseString(runner.chart([], "x", "y"))


def test_best_effort_times(spark):
    texts = ["2024-01-10T08:00:00Z", "2024-01-10 08:00:00", "2024-01-10T10:00:00+02:00", "20240110080000", "10.1.2024 8:00:00", "1704873600", "1704873600000", " 2024-01-10T08:00:00.000Z "]
    rows = spark.createDataFrame([(t,) for t in texts + ["soon", ""]], "t string").select(scalars.best_effort_time(F.col("t")).cast("string").alias("x"))
    assert [r["x"] for r in rows.collect()] == ["2024-01-10 08:00:00"] * len(texts) + [None, None]
