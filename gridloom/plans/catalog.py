"""Every telemetry query by name, with the SQL that an independent engine runs for it.

Queries take (spark, sf_dir) and read the generic tables through the telemetry view; fixed clocks
stand in for now, so that results depend on the data alone.
"""

import json
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions import scalars
from gridloom.functions.schema import EVENT_TYPES, SESSION_TYPES
from gridloom.operators import dedup, flatten, gates, rollup, state, storage, validate, versions
from gridloom.plans import daily, reports
from gridloom.sources import adapter, registry
from gridloom.streaming import metrics

QUERIES = {}
ORACLES = {}


def query(oracle: str | None = None, final: bool = True):
    """Register a function under its name; oracle is SQL over raw and final."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle is not None:
            ORACLES[f.__name__] = adapter.sql(oracle, final)
        return f

    return add


raw = adapter.raw_events
NOW = "TIMESTAMP '2024-01-31 00:00:00'"
_BOUND = "b AS (SELECT max(timestamp) AS win_end, max(timestamp) - INTERVAL '{d}' DAY AS win_start FROM raw)"


def _with(bound_days: int, body: str) -> str:
    return f", {_BOUND.format(d=bound_days)}{body}"


def _oracle(ctes: str, select: str, final: bool = True) -> str:
    """SQL with further CTEs after the view's."""
    return f"WITH {adapter.view()}{',' + adapter.FINAL if final else ''}{ctes}\n{select}"


def query_with(ctes: str, select: str, final: bool = True):
    def add(f):
        QUERIES[f.__name__] = f
        ORACLES[f.__name__] = _oracle(ctes, select, final)
        return f

    return add


# ---- reports

_DELTAS = ", r AS (SELECT *, energy_kwh - lag(energy_kwh, 1, CAST(0 AS DOUBLE)) OVER (PARTITION BY session_id ORDER BY timestamp, event_id) AS delta_kwh FROM final WHERE event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP'))"


@query_with(_with(7, _DELTAS), "SELECT date_trunc('hour', timestamp) AS hour, round(sum(greatest(delta_kwh, 0)), 3) AS energy_kwh FROM r, b WHERE timestamp BETWEEN win_start AND win_end GROUP BY 1 ORDER BY 1")
def a1_hourly_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.hourly_energy(raw(spark, sf_dir))


# every change is numbered along its connector; the one numbered next ends it, and the window clips both
_CHANGES = """, s AS (SELECT *, row_number() OVER (PARTITION BY station_id, connector_id ORDER BY timestamp, event_id) AS k FROM final WHERE event_type = 'STATUS_CHANGE'),
t AS (SELECT x.operator_id, x.station_id, x.connector_id, x.status, greatest(x.timestamp, win_start) AS seg_start, coalesce(y.timestamp, win_end) AS seg_end,
             greatest(date_diff('second', greatest(x.timestamp, win_start), coalesce(y.timestamp, win_end)), 0) AS sec
      FROM b, s x LEFT JOIN s y ON y.station_id = x.station_id AND y.connector_id = x.connector_id AND y.k = x.k + 1
      WHERE x.timestamp >= win_start OR coalesce(y.timestamp, win_end) >= win_start)"""


@query_with(
    _with(7, _CHANGES),
    """SELECT operator_id, station_id, sum(sec)::BIGINT AS total_s, sum(CASE WHEN status = 'Faulted' THEN sec ELSE 0 END)::BIGINT AS downtime_s,
       round(1 - sum(CASE WHEN status = 'Faulted' THEN sec ELSE 0 END)::DOUBLE / nullif(sum(sec), 0), 4) AS uptime_ratio
       FROM t GROUP BY 1, 2 ORDER BY downtime_s DESC, operator_id, station_id LIMIT 20""",
)
def a2_station_uptime(spark, sf_dir):
    return reports.station_uptime(raw(spark, sf_dir))


# starts, stops and registers are looked up apart, and only sessions that have all of them are left
_SESSIONS = """, starts AS (SELECT session_id, min(timestamp) AS t_start, min(vehicle_brand) AS brand FROM final WHERE event_type = 'SESSION_START' GROUP BY 1),
stops AS (SELECT session_id, max(timestamp) AS t_stop FROM final WHERE event_type = 'SESSION_STOP' GROUP BY 1),
registers AS (SELECT session_id, max(energy_kwh) - min(energy_kwh) AS energy_kwh FROM final WHERE session_id IN (SELECT session_id FROM starts) AND energy_kwh IS NOT NULL AND event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') GROUP BY 1),
s AS (SELECT * FROM starts JOIN stops USING (session_id) JOIN registers USING (session_id))"""


@query_with(
    _SESSIONS,
    """SELECT brand, count(*) AS sessions, round(avg(date_diff('second', t_start, t_stop)) / 60, 1) AS avg_duration_min, round(avg(energy_kwh), 2) AS avg_energy_kwh
       FROM s WHERE t_stop >= t_start AND coalesce(brand, '') <> '' GROUP BY brand ORDER BY sessions DESC, brand""",
)
def a3_brand_sessions(spark, sf_dir):
    return reports.sessions_by_brand(raw(spark, sf_dir))


@query_with(
    _with(30, ""),
    """SELECT operator_id, city, tariff_id, round(sum(cost_eur), 2) AS revenue_eur, round(sum(CASE WHEN is_peak_priced = 1 THEN cost_eur ELSE 0 END), 2) AS peak_revenue_eur,
       round(100 * sum(CASE WHEN is_peak_priced = 1 THEN cost_eur ELSE 0 END) / nullif(sum(cost_eur), 0), 1) AS peak_pct, count(*) AS sessions
       FROM final, b WHERE event_type = 'SESSION_STOP' AND timestamp BETWEEN win_start AND win_end GROUP BY 1, 2, 3 ORDER BY revenue_eur DESC, 1, 2, 3""",
)
def a4_revenue(spark, sf_dir):
    return reports.revenue(raw(spark, sf_dir))


@query_with(
    _with(30, ""),
    """SELECT city, count(DISTINCT event_id) AS fault_count, count(DISTINCT station_id) AS stations_affected,
       round(count(DISTINCT event_id)::DOUBLE / count(DISTINCT station_id), 2) AS faults_per_station, round(avg(lat), 4) AS lat, round(avg(lon), 4) AS lon
       FROM raw, b WHERE event_type = 'FAULT_ALERT' AND timestamp BETWEEN win_start AND win_end GROUP BY city ORDER BY fault_count DESC, city""",
    final=False,
)
def a5_fault_geo(spark, sf_dir):
    return reports.fault_geography(raw(spark, sf_dir))


# readings and starts are summed up apart; the spread is written out from its definition
_POWER = """, readings AS (SELECT session_id, sum(power_kw) / count(*) AS a, min(station_id) AS station_id FROM final WHERE event_type = 'METER_UPDATE' GROUP BY 1 HAVING count(*) > 2),
starts AS (SELECT session_id, min(vehicle_brand) AS brand, min(station_id) AS first_station FROM final WHERE event_type = 'SESSION_START' GROUP BY 1),
p AS (SELECT session_id, a, brand, least(station_id, coalesce(first_station, station_id)) AS station_id FROM readings LEFT JOIN starts USING (session_id)),
m AS (SELECT sum(a) / count(*) AS mu FROM p), f AS (SELECT any_value(mu) AS mu, sqrt(sum((a - mu) * (a - mu)) / count(*)) AS sigma FROM p, m)"""


@query_with(
    _POWER,
    """SELECT session_id, station_id, brand, round(a, 1) AS avg_power_kw, round((a - mu) / sigma, 2) AS z_score FROM p, f
       WHERE a > mu + 2 * sigma AND coalesce(brand, '') <> '' ORDER BY z_score DESC, session_id LIMIT 100""",
)
def a6_power_anomaly(spark, sf_dir):
    return reports.power_anomalies(raw(spark, sf_dir))


_ROLLUP = "SELECT date_trunc('hour', timestamp) AS hour, operator_id, city, tariff_id, is_peak_priced AS is_peak, round(sum(cost_eur), 2) AS revenue_eur, count(*) AS sessions FROM {t} WHERE event_type = 'SESSION_STOP' GROUP BY ALL"


def _cents(rows: DataFrame) -> DataFrame:
    return rows.withColumn("revenue_eur", F.round("revenue_eur", 2))


@query(_ROLLUP.format(t="raw"), final=False)
def r1_revenue_hourly_approx(spark, sf_dir):
    """Parts of two insert batches, merged on read."""
    rows = raw(spark, sf_dir)
    return _cents(rollup.merged(rollup.partial(rows.where("copy_no = 0")).unionByName(rollup.partial(rows.where("copy_no = 1")))))


@query(_ROLLUP.format(t="final"))
def r1_revenue_hourly_exact(spark, sf_dir):
    return _cents(rollup.partial(dedup.latest_version(raw(spark, sf_dir).where("event_type = 'SESSION_STOP'"))))


@query_with(
    ", d AS (SELECT date_trunc('day', max(timestamp)) AS e FROM raw)",
    """SELECT date_trunc('hour', timestamp) AS hour, operator_id, city, tariff_id, is_peak_priced AS is_peak, round(sum(cost_eur), 2) AS revenue_eur, count(*) AS sessions
       FROM raw, d WHERE event_type = 'SESSION_STOP' AND (timestamp < e - INTERVAL '1' DAY OR timestamp >= e) GROUP BY ALL
       UNION ALL
       SELECT date_trunc('hour', timestamp), operator_id, city, tariff_id, is_peak_priced, round(sum(cost_eur), 2), count(*)
       FROM final, d WHERE event_type = 'SESSION_STOP' AND timestamp >= e - INTERVAL '1' DAY AND timestamp < e GROUP BY ALL""",
)
def r1_revenue_reconciled(spark, sf_dir):
    rows = raw(spark, sf_dir)
    return _cents(rollup.reconciled(rollup.partial(rows), rows))


@query("SELECT count(*) AS total_rows, count(DISTINCT event_id) AS unique_events, count(*) - count(DISTINCT event_id) AS duplicates FROM raw", final=False)
def r2_dedup_audit(spark, sf_dir):
    return dedup.audit(raw(spark, sf_dir))


# ---- ingest: nested JSON with deliberate faults, in both dialects

_MUTATED = """, i AS (SELECT n, event_type, station_id, connector_id, session_id, operator_id, city, lat, lon, tariff_id, cost_eur, status, power_kw, energy_kwh, vehicle_brand, ingested_at,
   strftime(timestamp, '%Y-%m-%dT%H:%M:%S') || '.000Z' AS t,
   CASE WHEN n % 101 = 0 THEN 'invalid_json' WHEN n % 97 = 0 THEN 'missing_event_id' WHEN n % 89 = 0 THEN 'bad_event_id' WHEN n % 83 = 0 THEN 'unknown_event_type'
        WHEN n % 79 = 0 THEN 'unknown_station' WHEN n % 73 = 0 THEN 'bad_timestamp' WHEN n % 71 = 0 THEN 'missing_operator' WHEN n % 67 = 0 THEN 'missing_location'
        WHEN n % 61 = 0 THEN 'bad_geo' WHEN n % 59 = 0 THEN 'operator_mismatch' WHEN n % 53 = 0 THEN 'city_mismatch' WHEN n % 47 = 0 THEN 'geo_mismatch'
        WHEN n % 43 = 0 THEN 'connector_out_of_range' WHEN n % 41 = 0 THEN 'unknown_tariff'
        WHEN n % 37 = 0 AND event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN 'missing_session'
        WHEN n % 31 = 0 AND event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN 'missing_meter'
        WHEN n % 29 = 0 AND event_type = 'STATUS_CHANGE' THEN 'bad_status' WHEN n % 29 = 0 AND event_type = 'FAULT_ALERT' THEN 'missing_fault'
        WHEN n % 23 = 0 AND event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN 'soc_out_of_range' END AS rule
   FROM raw)"""

_BROKEN = {101: "invalid_json", 97: "missing_event_id", 89: "bad_event_id", 83: "unknown_event_type", 79: "unknown_station", 73: "bad_timestamp", 71: "missing_operator", 67: "missing_location", 61: "bad_geo", 59: "operator_mismatch", 53: "city_mismatch", 47: "geo_mismatch", 43: "connector_out_of_range", 41: "unknown_tariff", 37: "missing_session", 31: "missing_meter", 29: "bad_status", 23: "soc_out_of_range"}


def _uuid(n):
    return F.concat(F.lit("00000000-0000-4000-8000-"), F.lpad(n.cast("string"), 12, "0"))


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """value, offset, n, copy_no: the events as nested JSON, each fault in those whose number its prime divides."""
    e = raw(spark, sf_dir)
    n, kind = F.col("n"), F.col("event_type")
    bad = F
    for prime, name in _BROKEN.items():
        bad = bad.when(n % prime == 0, F.lit(name))
    e = e.withColumn("bad", bad.otherwise(F.lit("")))
    # a fault that a kind of event cannot have is no fault: the next that fits applies
    metered = kind.isin(*SESSION_TYPES)
    is_ = lambda *names: F.col("bad").isin(*names)
    later = lambda prime: (n % prime == 0) & ~is_(*[v for p, v in _BROKEN.items() if p > 37])
    no_session = later(37) & metered
    no_meter = later(31) & metered & ~no_session
    bad_state = later(29) & ~no_session & ~no_meter
    bad_soc = later(23) & metered & ~no_session & ~no_meter
    meter = F.when(metered & ~no_meter, F.struct(F.col("power_kw"), F.col("energy_kwh"), F.lit(400.0).alias("voltage_v"), scalars.current_of(F.col("power_kw"), F.lit(400.0)).alias("current_a"), F.when(bad_soc, 150).otherwise((n % 101).cast("int")).alias("soc_percent")))
    event = F.struct(
        F.when(is_("missing_event_id"), "").when(is_("bad_event_id"), "not-a-uuid").otherwise(_uuid(n)).alias("event_id"),
        F.when(is_("unknown_event_type"), "NOPE").otherwise(kind).alias("event_type"),
        F.when(is_("unknown_station"), "ST-none").otherwise(F.col("station_id")).alias("station_id"),
        F.when(is_("connector_out_of_range"), 9).otherwise(F.col("connector_id")).alias("connector_id"),
        F.when(metered & ~no_session, F.col("session_id")).alias("session_id"),
        F.when(is_("bad_timestamp"), F.date_format("timestamp", "yyyy-MM-dd")).otherwise(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.'000Z'")).alias("timestamp"),
        F.when(is_("missing_operator"), "").when(is_("operator_mismatch"), "Other").otherwise(F.col("operator_id")).alias("operator_id"),
        F.struct(F.when(is_("bad_geo"), 91.0).when(is_("geo_mismatch"), F.col("lat") + 0.01).otherwise(F.col("lat") + 0.00005).alias("lat"), F.col("lon"), F.when(is_("missing_location"), "").when(is_("city_mismatch"), "Elsewhere").otherwise(F.col("city")).alias("city"), F.col("country")).alias("location"),
        meter.alias("meter"),
        F.when(kind == "SESSION_START", F.struct(F.col("vehicle_brand").alias("brand"), F.lit("m").alias("model"), F.lit("v").alias("ev_id"))).alias("vehicle"),
        F.when(is_("unknown_tariff"), "ghost").otherwise(F.col("tariff_id")).alias("tariff_id"),
        F.col("cost_eur"),
        F.when((kind == "FAULT_ALERT") & ~bad_state, F.struct(F.lit("OverVoltage").alias("error_code"), F.lit("PowerModule").alias("component"))).alias("fault"),
        F.when((kind == "STATUS_CHANGE") & ~bad_state, F.col("status")).alias("status"),
        (F.col("is_peak_priced") == 1).alias("is_peak_priced"),
    )
    tail = F.when(is_("invalid_json"), "}").otherwise("")
    return e.select(F.concat(F.to_json(event), tail).alias("value"), (n * 2 + F.col("copy_no")).alias("offset"), "n", "copy_no", "ingested_at", "produced_at")


def judged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.judged(validate.decode(payloads(spark, sf_dir)), adapter.stations(spark, sf_dir), registry.tariff_table(spark))


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid events of the payloads, flat."""
    rows, _ = validate.split(judged(spark, sf_dir))
    return flatten.flatten(rows.withColumn("n_", F.col("n")), F.col("ingested_at"), F.col("produced_at"))


@query_with(_MUTATED, "SELECT coalesce(rule, 'valid') AS rule, count(*) AS n FROM i GROUP BY 1", final=False)
def validate_rules(spark, sf_dir):
    return judged(spark, sf_dir).groupBy(F.coalesce("rule", F.lit("valid")).alias("rule")).agg(F.count("*").alias("n"))


@query_with(_MUTATED, "SELECT n, rule FROM i", final=False)
def validate_events(spark, sf_dir):
    return judged(spark, sf_dir).select("n", "rule")


@query_with(
    _MUTATED,
    """SELECT CASE rule WHEN 'invalid_json' THEN 'invalid json' WHEN 'missing_event_id' THEN 'missing event_id' WHEN 'bad_event_id' THEN 'malformed event_id "not-a-uuid"'
       WHEN 'unknown_event_type' THEN 'unknown event_type "NOPE"' WHEN 'unknown_station' THEN 'unknown station_id "ST-none"' WHEN 'missing_operator' THEN 'missing operator_id'
       WHEN 'bad_timestamp' THEN 'unparseable timestamp "' || substr(t, 1, 10) || '"' WHEN 'operator_mismatch' THEN 'operator_id "Other" does not match station operator "' || operator_id || '"'
       WHEN 'city_mismatch' THEN 'city "Elsewhere" does not match station city "' || city || '"'
       WHEN 'geo_mismatch' THEN 'lat/lon (' || (lat + 0.01::DOUBLE)::VARCHAR || ',' || lon::VARCHAR || ') does not match station (' || lat::VARCHAR || ',' || lon::VARCHAR || ')'
       WHEN 'missing_location' THEN 'missing location city/country' WHEN 'bad_geo' THEN 'lat/lon out of range' WHEN 'connector_out_of_range' THEN 'connector_id 9 exceeds station connector count 4'
       WHEN 'unknown_tariff' THEN 'unknown tariff_id "ghost"' WHEN 'missing_session' THEN event_type || ' missing session_id' WHEN 'missing_meter' THEN event_type || ' missing meter'
       WHEN 'bad_status' THEN 'invalid status ""' WHEN 'missing_fault' THEN 'FAULT_ALERT missing fault error_code' WHEN 'soc_out_of_range' THEN 'soc_percent 150 out of range [0,100]' END AS error, count(*) AS n
       FROM i WHERE rule IS NOT NULL GROUP BY 1 ORDER BY n DESC, error""",
    final=False,
)
def r3_dlq_breakdown(spark, sf_dir):
    dead = validate.dead_letters(validate.split(judged(spark, sf_dir))[1])
    return dead.groupBy("error").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "error")


@query_with(_MUTATED, "SELECT CASE rule WHEN 'invalid_json' THEN rule ELSE 'validation' END AS reason, count(*) AS n FROM i WHERE rule IS NOT NULL GROUP BY 1", final=False)
def dlq_records(spark, sf_dir):
    _, rejected = validate.split(judged(spark, sf_dir))
    return rejected.groupBy(validate.reason(F.col("rule")).alias("reason")).agg(F.count("*").alias("n"))


_FLAT = """SELECT '00000000-0000-4000-8000-' || lpad(n::VARCHAR, 12, '0') AS event_id, i.event_type, i.station_id, i.connector_id,
   CASE WHEN i.event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN i.session_id ELSE '' END AS session_id, round(power_kw, 2) AS power_kw,
   CASE WHEN i.event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN (n % 101)::INT ELSE 0 END AS soc_percent,
   vehicle_brand, CASE WHEN i.event_type = 'FAULT_ALERT' THEN 'OverVoltage' ELSE '' END AS error_code, status, CASE WHEN i.event_type = 'SESSION_STOP' AND n % 4 = 1 AND (hour(strptime(t, '%Y-%m-%dT%H:%M:%S.000Z')) BETWEEN 7 AND 8 OR hour(strptime(t, '%Y-%m-%dT%H:%M:%S.000Z')) BETWEEN 17 AND 19) THEN 1 ELSE 0 END AS is_peak_priced
   FROM i WHERE rule IS NULL"""


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select("event_id", "event_type", "station_id", "connector_id", "session_id", F.round(F.col("power_kw").cast("double"), 2).alias("power_kw"), "soc_percent", "vehicle_brand", "error_code", "status", "is_peak_priced")


@query_with(_MUTATED, _FLAT, final=False)
def flatten_clean(spark, sf_dir):
    return _flat(valid(spark, sf_dir))


@query_with(_MUTATED, _FLAT, final=False)
def json_roundtrip(spark, sf_dir):
    """Flat rows to messages and back, strictly. Messages are dealt out between the two, as by a topic: they are read
    in tasks of even size, and neither side's generated code grows by the other's."""
    return _flat(flatten.from_json(flatten.to_json(valid(spark, sf_dir)).repartition("value")))


# ---- duplicates

@query("SELECT event_id, event_type, station_id, connector_id, timestamp, ingested_at FROM final")
def final_dedup(spark, sf_dir):
    return dedup.latest_version(raw(spark, sf_dir)).select("event_id", "event_type", "station_id", "connector_id", "timestamp", "ingested_at")


@query("SELECT event_id, 0 AS copy_no FROM raw GROUP BY event_id", final=False)
def inbatch_dedup(spark, sf_dir):
    rows = raw(spark, sf_dir).withColumn("offset", F.col("n") * 2 + F.col("copy_no"))
    return dedup.first_in_batch(rows).select("event_id", "copy_no")


@query("SELECT event_id FROM raw WHERE copy_no = 0 AND event_id NOT IN (SELECT event_id FROM raw WHERE copy_no = 1 AND ingested_at > (SELECT max(ingested_at) FROM raw WHERE copy_no = 1) - INTERVAL '10' DAY)", final=False)
def seen_antijoin(spark, sf_dir):
    rows = raw(spark, sf_dir)
    marks = rows.where("copy_no = 1").select("event_id", F.col("ingested_at").alias("marked_at"))
    newest = marks.agg(F.max("marked_at").alias("_now"))
    return dedup.unseen(rows.where("copy_no = 0"), marks.crossJoin(F.broadcast(newest)), now=F.col("_now"), ttl_seconds=10 * 86400).select("event_id")


@query("SELECT city, count(DISTINCT event_id) AS events, count(DISTINCT station_id) AS stations FROM raw GROUP BY city", final=False)
def uniq_exact(spark, sf_dir):
    return raw(spark, sf_dir).groupBy("city").agg(F.count_distinct("event_id").alias("events"), F.count_distinct("station_id").alias("stations"))


# ---- windows and segments

@query_with(_DELTAS, "SELECT event_id, round(delta_kwh, 3) AS delta_kwh FROM r")
def lag_delta(spark, sf_dir):
    rows = dedup.latest_version(raw(spark, sf_dir).where(F.col("event_type").isin(*SESSION_TYPES)))
    return reports.register_deltas(rows).select("event_id", F.round("delta_kwh", 3).alias("delta_kwh"))


@query_with(_with(7, _CHANGES), "SELECT station_id, connector_id, status, seg_start, seg_end, sec::BIGINT AS seconds FROM t")
def lead_segments(spark, sf_dir):
    s = reports.status_segments(raw(spark, sf_dir))
    length = F.greatest(scalars.seconds_between(F.col("seg_start"), F.col("seg_end")), F.lit(0))
    return s.select("station_id", "connector_id", "status", "seg_start", "seg_end", length.alias("seconds"))


@query_with(_with(7, ""), "SELECT station_id, connector_id, arg_max(status, timestamp) AS status, max(timestamp) AS since FROM final, b WHERE event_type = 'STATUS_CHANGE' AND timestamp < win_start GROUP BY 1, 2")
def carry_forward_asof(spark, sf_dir):
    rows = raw(spark, sf_dir)
    at = reports.window(rows, 7)
    early = storage.between(rows, until=at[0], until_open=True) if at else rows.limit(0)
    return reports.last_status(early.where("event_type = 'STATUS_CHANGE'")).select("station_id", "connector_id", "status", "since")


@query_with(_with(7, ""), "SELECT win_start, win_end FROM b", final=False)
def scalar_anchor(spark, sf_dir):
    return reports.bounds(raw(spark, sf_dir), 7)


@query("SELECT station_id, connector_id, arg_max(status, timestamp) AS status FROM final WHERE event_type = 'STATUS_CHANGE' GROUP BY 1, 2")
def argmax_latest(spark, sf_dir):
    rows = dedup.latest_version(raw(spark, sf_dir).where("event_type = 'STATUS_CHANGE'"))
    return rows.groupBy("station_id", "connector_id").agg(F.max_by("status", F.struct("timestamp", "event_id")).alias("status"))


@query(
    """SELECT operator_id, count(*) FILTER (WHERE event_type = 'METER_UPDATE') AS meters, round(coalesce(sum(cost_eur) FILTER (WHERE is_peak_priced = 1), 0), 2) AS peak, round(avg(power_kw) FILTER (WHERE event_type = 'METER_UPDATE'), 4) AS power,
       min(timestamp) FILTER (WHERE event_type = 'SESSION_START') AS first_start, max(timestamp) FILTER (WHERE event_type = 'SESSION_STOP') AS last_stop, min(vehicle_brand) FILTER (WHERE event_type = 'SESSION_START') AS brand FROM final GROUP BY 1""",
)
def conditional_aggs(spark, sf_dir):
    kind, t = F.col("event_type"), F.col("timestamp")
    return dedup.latest_version(raw(spark, sf_dir)).groupBy("operator_id").agg(
        F.count_if(kind == "METER_UPDATE").alias("meters"), F.round(F.sum(F.when(F.col("is_peak_priced") == 1, F.col("cost_eur")).otherwise(0.0)), 2).alias("peak"),
        F.round(F.avg(F.when(kind == "METER_UPDATE", F.col("power_kw"))), 4).alias("power"), F.min(F.when(kind == "SESSION_START", t)).alias("first_start"),
        F.max(F.when(kind == "SESSION_STOP", t)).alias("last_stop"), F.min(F.when(kind == "SESSION_START", F.col("vehicle_brand"))).alias("brand"),
    )


@query_with(_with(7, _CHANGES), "SELECT station_id, sum(CASE WHEN status = 'Faulted' THEN sec ELSE 0 END)::BIGINT AS downtime_s FROM t GROUP BY 1 ORDER BY downtime_s DESC, station_id LIMIT 12")
def topk_downtime(spark, sf_dir):
    s = reports.status_segments(raw(spark, sf_dir))
    length = F.greatest(scalars.seconds_between(F.col("seg_start"), F.col("seg_end")), F.lit(0))
    return s.groupBy("station_id").agg(F.sum(F.when(F.col("status") == "Faulted", length).otherwise(0)).alias("downtime_s")).orderBy(F.desc("downtime_s"), "station_id").limit(12)


# ---- state

_ARRIVAL = """, a AS (SELECT CASE WHEN event_type = 'HEARTBEAT' THEN 'station_liveness:' || station_id ELSE 'station:' || station_id || ':' || connector_id::VARCHAR END AS key,
   n + CASE WHEN n % 10 = 3 THEN 400 ELSE 0 END + n / 1000000000.0 AS arrival, timestamp AS ts, event_type, CASE WHEN event_type = 'STATUS_CHANGE' THEN status END AS status,
   CASE event_type WHEN 'SESSION_STOP' THEN 0.0::DOUBLE WHEN 'SESSION_START' THEN power_kw WHEN 'METER_UPDATE' THEN power_kw END AS power,
   CASE WHEN event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN (n % 101)::INT END AS soc,
   CASE WHEN event_type = 'SESSION_STOP' THEN '' WHEN event_type IN ('SESSION_START', 'METER_UPDATE') THEN session_id END AS session FROM one),
c AS (SELECT *, coalesce(ts >= max(ts) OVER (PARTITION BY key ORDER BY arrival ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), true) AS applied FROM a)"""


def arrivals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in an order of arrival in which every tenth comes 400 places late."""
    rows = raw(spark, sf_dir).where("copy_no = 0")
    late = F.when(F.col("n") % 10 == 3, 400).otherwise(0)
    return rows.withColumn("offset", F.col("n") + late + F.col("n") / 1e9).withColumn("soc_percent", (F.col("n") % 101).cast("int"))


@query_with(_ARRIVAL, "SELECT key, count(*) FILTER (WHERE applied) AS applied, count(*) FILTER (WHERE NOT applied) AS stale FROM c GROUP BY key", final=False)
def cas_applied(spark, sf_dir):
    rows = state.with_applied(state.writes(arrivals(spark, sf_dir), "offset"))
    return rows.groupBy("key").agg(F.count_if("applied").alias("applied"), F.count_if(~F.col("applied")).alias("stale"))


@query_with(
    _ARRIVAL,
    """SELECT key, max(ts) AS last_seen, arg_max(status, arrival) FILTER (WHERE status IS NOT NULL) AS status, arg_max(power, arrival) FILTER (WHERE power IS NOT NULL) AS power,
       arg_max(soc, arrival) FILTER (WHERE soc IS NOT NULL) AS soc, arg_max(session, arrival) FILTER (WHERE session IS NOT NULL) AS session FROM c WHERE applied GROUP BY key""",
    final=False,
)
def r5_current_state(spark, sf_dir):
    return state.current_state(state.writes(arrivals(spark, sf_dir), "offset")).drop("applied_at")


@query_with(
    _ARRIVAL,
    "SELECT key, max(ts) AS last_seen, arg_max(status, arrival) FILTER (WHERE status IS NOT NULL) AS status FROM c WHERE applied AND key = 'station:ST-1:2' GROUP BY key",
    final=False,
)
def r5_point_read(spark, sf_dir):
    """One key: the filter reaches the rows before the windows, which are by key."""
    return state.current_state(state.writes(arrivals(spark, sf_dir), "offset")).where("key = 'station:ST-1:2'").select("key", "last_seen", "status")


@query("SELECT 'station_liveness:' || station_id AS key, max(timestamp) AS last_seen FROM one GROUP BY 1", final=False)
def r5_liveness(spark, sf_dir):
    beats = arrivals(spark, sf_dir).withColumn("event_type", F.lit("HEARTBEAT"))
    return state.current_state(state.writes(beats, "offset", F.lit(False))).select("key", "last_seen")


@query_with(
    _ARRIVAL + """, h AS (SELECT key, max(ts) AS last_seen, floor((SELECT max(arrival) FROM c WHERE applied)) - floor(max(arrival)) AS silence FROM c WHERE applied GROUP BY key),
q AS (SELECT quantile_disc(silence, 0.5) AS ttl FROM h)""",
    "SELECT key, last_seen FROM h, q WHERE silence <= ttl",
    final=False,
)
def state_ttl_live(spark, sf_dir):
    """Keys that an event refreshed within the TTL, which is the median silence of all keys in whole seconds:
    about half of them have expired. Arrival is the clock."""
    held = state.current_state(state.writes(arrivals(spark, sf_dir), "offset")).withColumn("at", F.floor("applied_at"))
    newest = held.agg(F.max("at")).first()[0] or 0
    silence = held.selectExpr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {newest} - at)").first()[0]
    return state.live(held.withColumn("applied_at", F.timestamp_seconds("at")), F.timestamp_seconds(F.lit(newest)), int(silence or 0)).select("key", "last_seen")


# ---- quality, storage, clocks

@query(f"SELECT greatest(date_diff('second', max(ingested_at), {NOW}), 0) AS age_s, max(ingested_at) AS newest, date_diff('second', max(ingested_at), {NOW}) <= 86400 AS passed FROM raw", final=False)
def r6_freshness(spark, sf_dir):
    return gates.freshness(raw(spark, sf_dir), F.expr(NOW))


@query(f"SELECT greatest(coalesce(date_diff('millisecond', max(produced_at), {NOW}), 0), 0)::BIGINT AS produced_to_queryable_ms FROM raw", final=False)
def freshness_probe_ms(spark, sf_dir):
    return raw(spark, sf_dir).agg(F.greatest(F.coalesce(scalars.millis_between(F.max("produced_at"), F.expr(NOW)), F.lit(0)), F.lit(0)).alias("produced_to_queryable_ms"))


_WINDOWS = ", w AS (SELECT date_trunc('second', max(timestamp)) AS act_end FROM raw)"
_VALUES = """, ev AS (SELECT max(energy_kwh) - min(energy_kwh) AS v FROM final, w WHERE event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP')
  AND timestamp >= act_end - INTERVAL '14' DAY AND timestamp < act_end - INTERVAL '7' DAY GROUP BY session_id
  HAVING max(timestamp) FILTER (WHERE event_type = 'SESSION_STOP') >= min(timestamp) FILTER (WHERE event_type = 'SESSION_START')),
av AS (SELECT max(energy_kwh) - min(energy_kwh) AS v FROM final, w WHERE event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP')
  AND timestamp >= act_end - INTERVAL '7' DAY AND timestamp < act_end GROUP BY session_id
  HAVING max(timestamp) FILTER (WHERE event_type = 'SESSION_STOP') >= min(timestamp) FILTER (WHERE event_type = 'SESSION_START')),
ep AS (SELECT power_kw AS v FROM final, w WHERE event_type = 'METER_UPDATE' AND power_kw > 0 AND timestamp >= act_end - INTERVAL '14' DAY AND timestamp < act_end - INTERVAL '7' DAY),
ap AS (SELECT power_kw AS v FROM final, w WHERE event_type = 'METER_UPDATE' AND power_kw > 0 AND timestamp >= act_end - INTERVAL '7' DAY AND timestamp < act_end)"""
_CUTS = "quantile_cont(v, [0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9])"
_COUNTS = """, xe AS (SELECT 'energy_delta' AS metric, {q} AS e FROM ev UNION ALL SELECT 'power_kw', {q} FROM ep),
bk AS (SELECT metric, side, len(list_filter(e, lambda x: v >= x)) AS bucket FROM (SELECT 'energy_delta' AS metric, 'exp' AS side, v FROM ev UNION ALL SELECT 'energy_delta', 'act', v FROM av
   UNION ALL SELECT 'power_kw', 'exp', v FROM ep UNION ALL SELECT 'power_kw', 'act', v FROM ap) JOIN xe USING (metric) WHERE len(list_distinct(e)) >= 2),
ct AS (SELECT m.metric, s.side, k.bucket::INT AS bucket, count(bk.bucket) AS n FROM (SELECT DISTINCT metric FROM xe) m CROSS JOIN (VALUES ('exp'), ('act')) s(side) CROSS JOIN range(10) k(bucket)
   LEFT JOIN bk ON bk.metric = m.metric AND bk.side = s.side AND bk.bucket = k.bucket GROUP BY 1, 2, 3)""".replace("{q}", _CUTS)


def _both(make) -> DataFrame:
    parts = [make(m) for m in gates.METRICS]
    return parts[0].unionByName(parts[1])


@query_with(_WINDOWS + _VALUES, f"SELECT 'energy_delta' AS metric, k AS edge, round({_CUTS}[k], 6) AS value FROM ev, range(1, 10) r(k) GROUP BY k UNION ALL SELECT 'power_kw', k, round({_CUTS}[k], 6) FROM ep, range(1, 10) r(k) GROUP BY k")
def quantile_edges(spark, sf_dir):
    rows = raw(spark, sf_dir)
    found = [(m, k, float(v)) for m in gates.METRICS for k, v in enumerate(gates.measured(rows, m)[0] or [], 1)]  # nine a metric
    return spark.createDataFrame(found, "metric string, edge long, value double").withColumn("value", F.round("value", 6))


@query_with(_WINDOWS + _VALUES + _COUNTS, "SELECT metric, side, bucket, n FROM ct")
def psi_buckets(spark, sf_dir):
    rows = raw(spark, sf_dir)
    return _both(lambda m: gates.measured(rows, m)[1].select(F.lit(m).alias("metric"), "side", "bucket", "n"))


@query_with(
    _WINDOWS + _VALUES + _COUNTS,
    """SELECT metric, round(sum((q - p) * ln(q / p)), 6) AS psi, sum((q - p) * ln(q / p)) <= 0.25 AS passed FROM (
       SELECT metric, bucket, greatest(max(n) FILTER (WHERE side = 'exp')::DOUBLE / max(t) FILTER (WHERE side = 'exp'), 1e-6) AS p, greatest(max(n) FILTER (WHERE side = 'act')::DOUBLE / max(t) FILTER (WHERE side = 'act'), 1e-6) AS q
       FROM (SELECT *, sum(n) OVER (PARTITION BY metric, side) AS t FROM ct) GROUP BY 1, 2) GROUP BY metric""",
)
def psi_score(spark, sf_dir):
    rows = raw(spark, sf_dir)
    return _both(lambda m: gates.drift(rows, m)).withColumn("psi", F.round("psi", 6))


@query_with(
    _MUTATED,
    f"""SELECT d AS dead, t AS total, round(d::DOUBLE / t, 6) AS rate, d::DOUBLE / t <= 0.05 AS passed FROM (SELECT
        (SELECT count(*) FROM i WHERE rule IS NOT NULL AND ingested_at >= {NOW} - INTERVAL '7' DAY AND ingested_at < {NOW}) AS d,
        (SELECT count(*) FROM raw WHERE ingested_at >= {NOW} - INTERVAL '7' DAY AND ingested_at < {NOW}) AS t)""",
    final=False,
)
def dlq_rate(spark, sf_dir):
    """Dead letters against all stored rows, copies among both."""
    dead = validate.dead_letters(judged(spark, sf_dir).where("rule IS NOT NULL"), ingested_at=F.col("ingested_at"))
    return gates.dead_letter_rate(dead, raw(spark, sf_dir), F.expr(NOW)).withColumn("rate", F.round("rate", 6))


@query("SELECT strftime(timestamp, '%Y%m') AS yyyymm, count(*) AS rows, min(timestamp) AS oldest FROM raw GROUP BY 1 ORDER BY 1", final=False)
def partition_counts(spark, sf_dir):
    return storage.months(raw(spark, sf_dir)).orderBy("yyyymm")


@query("SELECT strftime(timestamp, '%Y%m') AS yyyymm, min(timestamp) AS oldest FROM raw GROUP BY 1 HAVING min(timestamp) < TIMESTAMP '2024-02-01'", final=False)
def ttl_candidates(spark, sf_dir):
    """A report in March 2025: thirteen months back is February 2024."""
    return storage.expired(storage.months(raw(spark, sf_dir)), datetime(2025, 3, 15)).select("yyyymm", "oldest")


@query("SELECT count(*) AS n FROM raw WHERE timestamp + INTERVAL '13' MONTH >= TIMESTAMP '2025-02-15'", final=False)
def ttl_filter(spark, sf_dir):
    return storage.unexpired(raw(spark, sf_dir), datetime(2025, 2, 15)).agg(F.count("*").alias("n"))


@query("SELECT date_trunc('day', max(timestamp)) - INTERVAL '1' DAY AS day_start, date_trunc('day', max(timestamp))::TIMESTAMP AS day_end FROM raw", final=False)
def prev_day_bounds(spark, sf_dir):
    return rollup.previous_day(raw(spark, sf_dir))


# ---- registry, pricing, observability

@query("SELECT 'stations' AS name, count(DISTINCT station_id) AS n FROM raw UNION ALL SELECT 'connectors', 4 * count(DISTINCT station_id) FROM raw UNION ALL SELECT 'tariffs', 4", final=False)
def r4_registry_counts(spark, sf_dir):
    s = adapter.stations(spark, sf_dir)
    return registry.counts({"stations": s, "connectors": s.select("station_id", F.explode(F.sequence(F.lit(1), "num_connectors"))), "tariffs": registry.tariff_table(spark)})


@query_with("", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)", final=False)
def registry_fk_check(spark, sf_dir):
    """Rows whose key has no partner: here orders without a line."""
    orders, lines = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("orders", "lineitem"))
    return registry.orphans(orders, lines.withColumnRenamed("l_orderkey", "o_orderkey"), "o_orderkey").select("o_orderkey", "o_custkey")


@query_with("", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1", final=False)
def registry_pk_check(spark, sf_dir):
    """Keys that more than one row has."""
    return registry.repeated_keys(spark.read.parquet(f"{sf_dir}/lineitem.parquet"), "l_orderkey", "l_linenumber")


_PRICE = "CASE tariff_id WHEN 'standard-v1' THEN 0.39 WHEN 'peak-rate-v2' THEN 0.49 WHEN 'off-peak-v1' THEN 0.29 ELSE 0.34 END::DOUBLE"
_MULT = "CASE tariff_id WHEN 'peak-rate-v2' THEN 1.35 WHEN 'off-peak-v1' THEN 0.8 ELSE 1.0 END::DOUBLE"
_PEAK = "(hour(timestamp) BETWEEN 7 AND 8 OR hour(timestamp) BETWEEN 17 AND 19)"


@query(f"SELECT event_id, round(energy_kwh * {_PRICE} * CASE WHEN {_PEAK} THEN {_MULT} ELSE 1 END, 4) AS cost, {_PEAK} AND {_MULT} > 1 AS peak_priced FROM final WHERE event_type = 'SESSION_STOP'")
def pricing_peak(spark, sf_dir):
    """Bills by tariff; only a premium in a peak window counts as peak."""
    rows = dedup.latest_version(raw(spark, sf_dir).where("event_type = 'SESSION_STOP'"))
    tariffs = registry.tariff_table(spark).select("tariff_id", F.round(F.col("price_per_kwh_eur").cast("double"), 4).alias("p"), F.round(F.col("peak_multiplier").cast("double"), 4).alias("m"))
    peak = scalars.in_peak(F.hour("timestamp"))
    priced = rows.join(F.broadcast(tariffs), "tariff_id")  # four rows, fixed
    return priced.select("event_id", F.round(scalars.billed(F.col("energy_kwh"), F.col("p"), F.col("m"), peak), 4).alias("cost"), (peak & (F.col("m") > 1)).alias("peak_priced"))


@query("SELECT event_id, round(CASE WHEN n % 101 < 80 THEN power_kw ELSE power_kw * (0.08 + 0.92 * (100 - n % 101) / 20.0) END, 4) AS power, round(power_kw * 1000 / 400, 3) AS amps FROM one WHERE event_type = 'METER_UPDATE'", final=False)
def taper_power(spark, sf_dir):
    rows = raw(spark, sf_dir).where("copy_no = 0 AND event_type = 'METER_UPDATE'")
    return rows.select("event_id", F.round(scalars.taper_power((F.col("n") % 101).cast("double"), F.col("power_kw")), 4).alias("power"), F.round(scalars.current_of(F.col("power_kw"), F.lit(400.0)), 3).alias("amps"))


@query(
    """SELECT grp, sum(greatest(newest - committed, 0))::BIGINT AS lag FROM (SELECT station_no % 12 AS part, max(n) AS newest FROM one GROUP BY 1) a
       JOIN (SELECT 'analytics' AS grp, station_no % 12 AS part, max(n) - 7 AS committed FROM one GROUP BY 2 UNION ALL SELECT 'realtime', station_no % 12, max(n) + 1 - station_no % 12 FROM one GROUP BY 2, station_no % 12) c USING (part) GROUP BY grp""",
    final=False,
)
def consumer_lag_join(spark, sf_dir):
    part = (F.col("station_no") % 12).alias("part")
    newest = raw(spark, sf_dir).where("copy_no = 0").groupBy(part).agg(F.max("n").alias("newest")).withColumn("topic", F.lit("raw"))
    one = newest.select("topic", "part", F.lit("analytics").alias("grp"), (F.col("newest") - 7).alias("committed"))
    two = newest.select("topic", "part", F.lit("realtime").alias("grp"), (F.col("newest") + 1 - F.col("part")).alias("committed"))
    return metrics.consumer_lag(newest, one.unionByName(two))


@query("SELECT event_type, quantile_cont(l, 0.5) AS p50, quantile_cont(l, 0.95) AS p95, quantile_cont(l, 0.99) AS p99 FROM (SELECT event_type, date_diff('millisecond', produced_at, ingested_at) / 1000.0 AS l FROM raw) GROUP BY 1", final=False)
def lag_percentiles(spark, sf_dir):
    rows = raw(spark, sf_dir).select("event_type", metrics.lag_seconds("produced_at", "ingested_at").alias("lag"))
    return metrics.quantiles(rows, "lag", ["event_type"])


@query_with(
    """, s AS (SELECT event_type, station_no % 3 AS instance, date_trunc('second', timestamp) AS moment, count(*) AS n FROM one GROUP BY 1, 2, 3),
t AS (SELECT *, sum(n) OVER (PARTITION BY event_type, instance ORDER BY moment) AS total, row_number() OVER (PARTITION BY event_type, instance ORDER BY moment) AS place FROM s)""",
    # what a counter grew by between two samples is what was counted at the second one; the first sample grows by nothing
    "SELECT event_type, date_trunc('minute', moment) AS minute, round(sum(CASE WHEN place > 1 THEN n ELSE 0 END) / 60.0, 6) AS per_second FROM t GROUP BY 1, 2",
    final=False,
)
def event_rates(spark, sf_dir):
    """Rates a second, by type and minute, of counters that three instances sample whenever they count.

    Every counter begins anew after each fiftieth sample."""
    by = ["event_type", "instance"]
    counted = raw(spark, sf_dir).where("copy_no = 0").groupBy("event_type", (F.col("station_no") % 3).alias("instance"), F.date_trunc("second", "timestamp").alias("at")).agg(F.count("*").alias("n"))
    place = F.floor((F.row_number().over(Window.partitionBy(*by).orderBy("at")) - 1) / 50)
    counted = counted.withColumn("life", place)
    samples = counted.withColumn("value", F.sum("n").over(Window.partitionBy(*by, "life").orderBy("at")))
    # a reset shows as a fall; lives end high enough for that, as each holds fifty counts and the next begins with few
    found = metrics.rates(samples, "event_type")
    return found.select("event_type", F.col("minute").cast("timestamp_ntz").alias("minute"), F.round("per_second", 6).alias("per_second"))


@query("SELECT b AS le, (SELECT count(*) FROM one WHERE power_kw <= b) AS n FROM (VALUES (0.0), (5.0), (25.0), (100.0), (250.0), ('inf')) t(b)".replace("(0.0), (5.0)", "(0.0::DOUBLE), (5.0)"), final=False)
def histogram_buckets(spark, sf_dir):
    return metrics.histogram(raw(spark, sf_dir).where("copy_no = 0"), "power_kw", (0, 5, 25, 100, 250))


@query("SELECT operator_id, median(cost_eur) AS median_cost FROM final WHERE event_type = 'SESSION_STOP' GROUP BY 1")
def median_cost(spark, sf_dir):
    stops = dedup.latest_version(raw(spark, sf_dir).where("event_type = 'SESSION_STOP'"))
    return gates.exact_quantiles_by(stops, "cost_eur", ["operator_id"], [0.5]).select("operator_id", F.col("value").alias("median_cost"))


@query("SELECT key, row_number() OVER (PARTITION BY key ORDER BY arrival)::INT AS place, n FROM (SELECT station_id AS key, n, n + CASE WHEN n % 10 = 3 THEN 400 ELSE 0 END + n / 1000000000.0 AS arrival FROM one)", final=False)
def delayed_arrival_order(spark, sf_dir):
    """The order in which delayed events are released, by key."""
    w = Window.partitionBy("station_id").orderBy("offset")
    return arrivals(spark, sf_dir).select(F.col("station_id").alias("key"), F.row_number().over(w).alias("place"), "n")


# ---- stored tables, the daily run, streams' other ends

def _landing(spark: SparkSession, sf_dir: str) -> tuple[str, DataFrame]:
    """A landing table of the view's rows in a folder of this call's own, and its rows as stored."""
    path = f"{versions.scratch(spark)}/events"
    for k in (0, 1):
        storage.append(raw(spark, sf_dir).where(f"copy_no = {k}"), path)
    return path, storage.scan(spark, path)


@query_with(_with(30, ""), "SELECT strftime(timestamp, '%Y%m') AS yyyymm, event_type, count(*) AS n FROM raw, b WHERE timestamp BETWEEN win_start AND win_end GROUP BY 1, 2", final=False)
def landing_scan(spark, sf_dir):
    """Rows of the last thirty days of a landing table: bounds prune its months."""
    _, rows = _landing(spark, sf_dir)
    return reports.inside(rows, 30).groupBy(F.col("yyyymm").cast("string").alias("yyyymm"), "event_type").agg(F.count("*").alias("n"))


_DAY = ", d AS (SELECT date_trunc('day', max(timestamp)) AS e FROM raw)"


@query_with(
    _DAY,
    """SELECT date_trunc('hour', timestamp) AS hour, operator_id, city, tariff_id, is_peak_priced AS is_peak, round(sum(cost_eur), 2) AS revenue_eur, count(*) AS sessions
       FROM raw, d WHERE event_type = 'SESSION_STOP' AND (copy_no = 0 OR timestamp < e - INTERVAL '1' DAY OR timestamp >= e) GROUP BY ALL""",
)
def r1_day_overwritten(spark, sf_dir):
    """The stored rollup after two batches of parts and the overwriting of the previous day."""
    rows, path = raw(spark, sf_dir), f"{versions.scratch(spark)}/revenue"
    for k in (0, 1):
        rollup.append_parts(rollup.partial(rows.where(f"copy_no = {k}")), path, batch=k)
    rollup.append_parts(rollup.partial(rows.where("copy_no = 1")), path, batch=1)  # a batch that is given again
    rollup.overwrite_day(rows, path)
    return _cents(rollup.stored(spark, path))


@query_with(
    _DAY + _WINDOWS + _VALUES + _COUNTS + """, ps AS (SELECT metric, sum((q - p) * ln(q / p)) AS psi FROM (
       SELECT metric, bucket, greatest(max(n) FILTER (WHERE side = 'exp')::DOUBLE / max(t) FILTER (WHERE side = 'exp'), 1e-6) AS p, greatest(max(n) FILTER (WHERE side = 'act')::DOUBLE / max(t) FILTER (WHERE side = 'act'), 1e-6) AS q
       FROM (SELECT *, sum(n) OVER (PARTITION BY metric, side) AS t FROM ct) GROUP BY 1, 2) GROUP BY metric)""",
    """SELECT 'freshness' AS task, date_diff('second', max(ingested_at), max(ingested_at) + INTERVAL '1' HOUR)::VARCHAR AS found FROM raw
       UNION ALL SELECT 'compact', strftime(date_trunc('month', max(ingested_at) + INTERVAL '1' HOUR) - INTERVAL '1' DAY, '%Y%m') || CASE WHEN count(DISTINCT CASE WHEN strftime(timestamp, '%Y%m') = strftime(date_trunc('month', (SELECT max(ingested_at) FROM raw) + INTERVAL '1' HOUR) - INTERVAL '1' DAY, '%Y%m') THEN copy_no END) > 1 THEN ' compacted' ELSE ' as it was' END FROM raw
       UNION ALL SELECT 'reconcile', strftime(e - INTERVAL '1' DAY, '%Y-%m-%d') FROM d
       UNION ALL SELECT 'quality', CASE WHEN max(psi) > 0.25 THEN 'failed' ELSE string_agg(metric || ' ' || printf('%.6f', psi), ', ' ORDER BY metric) END FROM ps
       UNION ALL SELECT 'retention', 'none' FROM ps HAVING max(psi) <= 0.25""",
)
def daily_run(spark, sf_dir):
    """The five tasks over a landing table, an hour after its newest row; no dead letters. Where a gate
    fails its task is the last row, and those after it have none."""
    path, rows = _landing(spark, sf_dir)
    revenue = f"{versions.scratch(spark)}/revenue"
    rollup.append_parts(rollup.partial(rows), revenue)
    now = datetime.fromisoformat(rows.agg(F.max("ingested_at").cast("string")).first()[0]) + timedelta(hours=1)
    dead = rows.limit(0).select(F.lit("").alias("raw_payload"), F.lit("").alias("error"), "ingested_at")
    chain = daily.Daily(spark, path, revenue, dead, now)
    try:
        chain.run()
    except gates.GateFailed:
        chain.done.append((chain.next, "failed"))
    return spark.createDataFrame(chain.done, "task string, found string")


@query_with(_MUTATED, "SELECT CASE rule WHEN 'invalid_json' THEN 'invalid json' ELSE 'other' END AS kind, count(*) AS n, date_trunc('milliseconds', max(ingested_at)) AS newest FROM i WHERE rule IS NOT NULL GROUP BY 1", final=False)
def dlq_reader(spark, sf_dir):
    """Dead letters as messages under their raw keys, with malformed ones among them, read back."""
    rejected = validate.split(judged(spark, sf_dir))[1].withColumn("key", F.col("n").cast("string"))
    sent = validate.dead_letter_messages(rejected, ingested_at=F.col("ingested_at"))
    broken = sent.limit(3).select("key", F.lit('{"raw_payload": ').alias("value"))
    rows = validate.read_dead_letters(sent.unionByName(broken))
    kind = F.when(F.col("error") == "invalid json", F.col("error")).otherwise("other")
    return rows.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"), F.max("ingested_at").cast("timestamp_ntz").alias("newest"))


@query("SELECT DISTINCT station_id, c::INT AS connector_id FROM one, range(1, 5) r(c) WHERE station_no % 5 = 0", final=False)
def registry_connector_orphans(spark, sf_dir):
    """Connectors whose station is not in the registry: every fifth station is left out of it."""
    known = adapter.stations(spark, sf_dir)
    plugs = known.select("station_id", F.explode(F.sequence(F.lit(1), F.col("num_connectors"))).alias("connector_id"))
    kept = known.where("cast(substring(station_id, 4) AS int) % 5 <> 0")
    return registry.orphans(plugs, kept, "station_id").select("station_id", "connector_id")


@query("SELECT station_id, count(*) AS n FROM (SELECT DISTINCT station_id FROM one UNION ALL SELECT DISTINCT station_id FROM one WHERE station_no % 7 = 0) t GROUP BY 1 HAVING count(*) > 1", final=False)
def registry_repeated_stations(spark, sf_dir):
    """Station ids that the registry has twice: every seventh is seeded again."""
    known = adapter.stations(spark, sf_dir).select("station_id")
    again = known.where("cast(substring(station_id, 4) AS int) % 7 = 0")
    return registry.repeated_keys(known.unionByName(again), "station_id")


@query_with(
    """, h AS (SELECT event_type, b AS le, sum(CASE WHEN power_kw <= b THEN 1 ELSE 0 END)::DOUBLE AS n FROM one, (VALUES (0.0::DOUBLE), (5), (25), (100), (250), ('inf')) t(b) GROUP BY 1, 2),
k AS (SELECT *, max(n) OVER (PARTITION BY event_type) * 0.95 AS rank, lag(n, 1, 0) OVER (PARTITION BY event_type ORDER BY le) AS below, lag(le) OVER (PARTITION BY event_type ORDER BY le) AS low FROM h),
p AS (SELECT event_type, min(le) AS le FROM k WHERE n >= rank GROUP BY 1)""",
    """SELECT event_type, round(CASE WHEN isinf(le) THEN low WHEN low IS NULL THEN le ELSE low + (le - low) * (rank - below) / (n - below) END, 6) AS value
       FROM k JOIN p USING (event_type, le)""",
    final=False,
)
def histogram_p95(spark, sf_dir):
    """The 95th percentile of power by event type, as estimated from fixed buckets."""
    rows = raw(spark, sf_dir).where("copy_no = 0")
    kinds = ("SESSION_START", "METER_UPDATE", "SESSION_STOP", "FAULT_ALERT", "STATUS_CHANGE")
    parts = [metrics.histogram(rows.where(F.col("event_type") == k), "power_kw", (0, 5, 25, 100, 250)).withColumn("event_type", F.lit(k)) for k in kinds]
    return metrics.histogram_quantile(reduce(DataFrame.unionByName, parts), 0.95, ["event_type"]).withColumn("value", F.round("value", 6))


#: For each rule the field that breaks it, how, and the kinds of events that it judges.
_FAULTS = [
    ("missing_event_id", "event_id", "", "*"), ("bad_event_id", "event_id", "x", "*"), ("unknown_event_type", "event_type", "NOPE", "*"), ("unknown_station", "station_id", "ST-none", "*"), ("bad_timestamp", "timestamp", "soon", "*"),
    ("missing_operator", "operator_id", "", "*"), ("missing_location", "city", "", "*"), ("bad_geo", "lat", 91.0, "*"), ("operator_mismatch", "operator_id", "Other", "*"), ("city_mismatch", "city", "Elsewhere", "*"), ("country_mismatch", "country", "YY", "*"),
    ("geo_mismatch", "lon", -170.0, "*"), ("bad_connector", "connector_id", 3, "HEARTBEAT"), ("connector_out_of_range", "connector_id", 9, "SESSION_START METER_UPDATE SESSION_STOP STATUS_CHANGE FAULT_ALERT"), ("unknown_tariff", "tariff_id", "ghost", "*"),
    ("missing_session", "session_id", "", "SESSION_START METER_UPDATE SESSION_STOP"), ("missing_vehicle", "vehicle", None, "SESSION_START"), ("missing_tariff", "tariff_id", "", "SESSION_START METER_UPDATE SESSION_STOP"), ("missing_meter", "meter", None, "SESSION_START METER_UPDATE SESSION_STOP"),
    ("bad_cost", "cost_eur", -1.0, "SESSION_STOP"), ("bad_status", "status", "Odd", "STATUS_CHANGE"), ("missing_fault", "fault", None, "FAULT_ALERT"), ("soc_out_of_range", "soc_percent", 101, "METERED"), ("bad_power", "power_kw", 1000.5, "METERED"),
    ("bad_energy", "energy_kwh", -1.0, "METERED"), ("bad_voltage", "voltage_v", -1.0, "METERED"), ("bad_current", "current_a", -1.0, "METERED"),
]
_METER = ("power_kw", "energy_kwh", "voltage_v", "current_a", "soc_percent")
#: Pairs of faults in different parts of an event, the earlier rule first.
_PAIRS = [(a, b) for i, a in enumerate(_FAULTS) for b in _FAULTS[i + 1 :] if a[1] != b[1] and "event_type" not in (a[1], b[1]) and not (a[1] == "meter" and b[1] in _METER)]
_PAIR_ROWS = ", ".join(f"({k}, '{a[0]}', '{a[3]}', '{b[0]}', '{b[3]}')" for k, (a, b) in enumerate(_PAIRS))


@query_with(
    f""", p(k, first, first_kinds, second, second_kinds) AS (VALUES {_PAIR_ROWS}), x AS (SELECT CASE WHEN n % 11 = 0 THEN 'HEARTBEAT' ELSE event_type END AS kind, n % {len(_PAIRS)} AS k FROM one),
j AS (SELECT *, first_kinds IN ('*', 'METERED') OR list_contains(string_split(first_kinds, ' '), kind) AS one_judges, second_kinds IN ('*', 'METERED') OR list_contains(string_split(second_kinds, ' '), kind) AS two_judges FROM x JOIN p USING (k))""",
    """SELECT kind, first, second, CASE WHEN one_judges THEN first WHEN two_judges THEN second ELSE 'valid' END AS rule, count(*) AS n FROM j
       WHERE (kind = 'HEARTBEAT') = ('bad_connector' IN (first, second)) OR 'bad_connector' NOT IN (first, second) AND NOT (kind = 'HEARTBEAT' AND 'connector_out_of_range' IN (first, second)) GROUP BY ALL""",
    final=False,
)
def validate_precedence(spark, sf_dir):
    """The table's events, each with a pair of faults in different parts of it: the earlier rule that judges
    such an event names the reason. Every eleventh is a heartbeat; faults that its kind can't have are left out."""
    pairs = F.broadcast(spark.createDataFrame([(k, a[0], b[0]) for k, (a, b) in enumerate(_PAIRS)], "k int, first string, second string"))
    e = raw(spark, sf_dir).where("copy_no = 0").withColumn("k", (F.col("n") % len(_PAIRS)).cast("int")).join(pairs, "k")
    e = e.withColumn("kind", F.when(F.col("n") % 11 == 0, "HEARTBEAT").otherwise(F.col("event_type")))
    has = lambda name: (F.col("first") == name) | (F.col("second") == name)
    beat = F.col("kind") == "HEARTBEAT"
    e = e.where((beat == has("bad_connector")) | ~has("bad_connector") & ~(beat & has("connector_out_of_range")))

    def put(part: str, good):
        """A part of the event, or what a fault of it makes of that."""
        for name, own, value, _ in _FAULTS:
            if own == part:
                good = F.when(has(name), F.lit(value)).otherwise(good)
        return good.alias(part)

    at = F.struct(*[put(c, F.col(c)) for c in ("lat", "lon", "city", "country")])
    meter = F.struct(*[put(c, F.lit(1) if c == "soc_percent" else F.lit(1.0)) for c in _METER])
    event = F.struct(
        put("event_id", _uuid(F.col("n"))), put("event_type", F.col("kind")), put("station_id", F.col("station_id")), put("connector_id", F.when(beat, 0).otherwise(F.col("connector_id"))), put("session_id", F.col("session_id")),
        put("timestamp", F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.'000Z'")), put("operator_id", F.col("operator_id")), put("tariff_id", F.col("tariff_id")), put("cost_eur", F.lit(1.0)), put("status", F.lit("Available")),
        put("vehicle", F.struct(F.lit("b").alias("brand"))), put("fault", F.struct(F.lit("OverVoltage").alias("error_code"))), at.alias("location"), put("meter", meter),
    )
    found = validate.judged(validate.decode(e.select("kind", "first", "second", F.to_json(event).alias("value"))), adapter.stations(spark, sf_dir), registry.tariff_table(spark))
    return found.groupBy("kind", "first", "second", F.coalesce("rule", F.lit("valid")).alias("rule")).agg(F.count("*").alias("n"))
