"""The analytical reports, as DataFrame plans over stored telemetry.

Windows end at the newest event time, never at the clock. That time is looked up first, by a small
job over one column, so that a report's bounds are literals: they reach the scan, prune months, and
stand below the removal of stale versions (event time is part of an event's key: all versions of it
lie on one side of a bound). Each plan takes ``raw`` (rows as stored) and removes stale versions
itself where the report calls for it. Ties in reported orders fall to the next columns, so that
results are the same every time.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.scalars import hour_of, ratio, seconds_between
from gridloom.functions.schema import SESSION_TYPES
from gridloom.operators.dedup import latest_version
from gridloom.operators.storage import between, newest, shifted

#: A session's mean power is unusual from so many standard deviations above the fleet's mean.
SIGMAS = 2
LEAST_READINGS = 3


def bounds(raw: DataFrame, days: int, time: str = "timestamp") -> DataFrame:
    """win_start, win_end: the days before raw's newest event, as one row; none if raw has no rows."""
    end = raw.agg(F.max(time).alias("win_end")).where("win_end IS NOT NULL")
    return end.select((F.col("win_end") - F.expr(f"INTERVAL {days} DAYS")).alias("win_start"), "win_end")


def window(raw: DataFrame, days: int) -> tuple[str, str] | None:
    """The same bounds as text; None if raw has no rows."""
    end = newest(raw)
    return None if end is None else (shifted(raw, end, f"- INTERVAL {days} DAYS"), end)


def inside(raw: DataFrame, days: int) -> DataFrame:
    """raw's rows within its bounds()."""
    at = window(raw, days)
    return raw.limit(0) if at is None else between(raw, *at)


def register_deltas(events: DataFrame) -> DataFrame:
    """delta_kwh: what each reading adds to its session's cumulative register; the first adds all of it."""
    w = Window.partitionBy("session_id").orderBy("timestamp", "event_id")
    energy = F.col("energy_kwh").cast("double")
    return events.withColumn("delta_kwh", energy - F.lag(energy, 1, 0.0).over(w))


def last_registers(readings: DataFrame) -> DataFrame:
    """session_id, timestamp, event_id, energy_kwh: each session's last reading, by its newest version. Sums
    up before the shuffle: a task sends one row a session, whatever the history."""
    newest_of = F.struct("timestamp", "event_id", *[c for c in ("ingested_at", "produced_at") if c in readings.columns])
    last = readings.groupBy("session_id").agg(F.max_by(F.struct("timestamp", "event_id", "energy_kwh"), newest_of).alias("_last"))
    return last.select("session_id", "_last.timestamp", "_last.event_id", "_last.energy_kwh")


def hourly_energy(raw: DataFrame, days: int = 7) -> DataFrame:
    """A1: energy by hour. A reading adds what its register rose by since the one before, which may lie
    before the window: of the history, each session's last reading before the window is enough."""
    at, readings = window(raw, days), raw.where(F.col("event_type").isin(*SESSION_TYPES))
    late = latest_version(between(readings, *at) if at else readings.limit(0)).select("session_id", "timestamp", "event_id", "energy_kwh", F.lit(True).alias("_in"))
    if at:
        late = late.unionByName(last_registers(between(readings, until=at[0], until_open=True)).withColumn("_in", F.lit(False)))
    hours = register_deltas(late).where("_in").groupBy(hour_of(F.col("timestamp")).alias("hour"))
    return hours.agg(F.round(F.sum(F.greatest("delta_kwh", F.lit(0.0))), 3).alias("energy_kwh")).orderBy("hour")


def last_status(changes: DataFrame) -> DataFrame:
    """station_id, connector_id, operator_id, status, since: each connector's last change, by its newest
    version. Sums up before the shuffle: a task sends one row a connector, whatever the history."""
    newest_of = F.struct("timestamp", "event_id", "ingested_at")
    by = changes.groupBy("station_id", "connector_id")
    return by.agg(F.max_by(F.struct("operator_id", "status"), newest_of).alias("_last"), F.max("timestamp").alias("since")).select("station_id", "connector_id", "_last.operator_id", "_last.status", "since")


def status_segments(raw: DataFrame, days: int = 7) -> DataFrame:
    """operator_id, station_id, connector_id, status, seg_start, seg_end within the window.

    Of the changes before the window, each connector's last is carried to its start.
    """
    changes, at = raw.where("event_type = 'STATUS_CHANGE'"), window(raw, days)
    kind = raw.schema["timestamp"].dataType
    start, end = (F.lit(t).cast(kind) for t in at or (None, None))
    columns = ("operator_id", "station_id", "connector_id", "status", "timestamp", "event_id")
    late = latest_version(between(changes, *at) if at else changes.limit(0)).select(*columns)
    carried = last_status(changes.where(F.col("timestamp") < start)).select("operator_id", "station_id", "connector_id", "status", start.alias("timestamp"), F.lit("").alias("event_id"))
    w = Window.partitionBy("station_id", "connector_id").orderBy("timestamp", "event_id")
    return late.unionByName(carried).select("operator_id", "station_id", "connector_id", "status", F.col("timestamp").alias("seg_start"), F.lead("timestamp", 1).over(w).alias("_next")).select("operator_id", "station_id", "connector_id", "status", "seg_start", F.coalesce("_next", end).alias("seg_end"))


def station_uptime(raw: DataFrame, days: int = 7, top: int = 20) -> DataFrame:
    """A2: seconds observed and faulted by station, the worst first."""
    length = F.greatest(seconds_between(F.col("seg_start"), F.col("seg_end")), F.lit(0))
    by = status_segments(raw, days).withColumn("_s", length).groupBy("operator_id", "station_id")
    sums = by.agg(F.sum("_s").alias("total_s"), F.sum(F.when(F.col("status") == "Faulted", F.col("_s")).otherwise(0)).alias("downtime_s"))
    out = sums.withColumn("uptime_ratio", F.round(F.lit(1.0) - ratio(F.col("downtime_s"), F.col("total_s")), 4))
    return out.orderBy(F.desc("downtime_s"), "operator_id", "station_id").limit(top)


def sessions(raw: DataFrame) -> DataFrame:
    """Each session's brand, start, stop and energy; only those that started and stopped."""
    kind = F.col("event_type")
    by = latest_version(raw.where(kind.isin(*SESSION_TYPES))).groupBy("session_id")
    out = by.agg(
        F.min(F.when(kind == "SESSION_START", F.col("vehicle_brand"))).alias("brand"),
        F.min(F.when(kind == "SESSION_START", F.col("timestamp"))).alias("t_start"),
        F.max(F.when(kind == "SESSION_STOP", F.col("timestamp"))).alias("t_stop"),
        (F.max(F.col("energy_kwh").cast("double")) - F.min(F.col("energy_kwh").cast("double"))).alias("energy_kwh"),
    )
    return out.where("t_start IS NOT NULL AND t_stop >= t_start")


def sessions_by_brand(raw: DataFrame) -> DataFrame:
    """A3: completed sessions by vehicle brand."""
    by = sessions(raw).where("coalesce(brand, '') <> ''").groupBy("brand")
    out = by.agg(
        F.count("*").alias("sessions"),
        F.round(F.avg(seconds_between(F.col("t_start"), F.col("t_stop"))) / 60, 1).alias("avg_duration_min"),
        F.round(F.avg("energy_kwh"), 2).alias("avg_energy_kwh"),
    )
    return out.orderBy(F.desc("sessions"), "brand")


def revenue(raw: DataFrame, days: int = 30) -> DataFrame:
    """A4: revenue and its share at peak price by operator, city and tariff."""
    stops = latest_version(inside(raw, days).where("event_type = 'SESSION_STOP'"))
    cost = F.col("cost_eur").cast("double")
    sums = stops.groupBy("operator_id", "city", "tariff_id").agg(F.sum(cost).alias("_all"), F.sum(F.when(F.col("is_peak_priced") == 1, cost).otherwise(0.0)).alias("_peak"), F.count("*").alias("sessions"))
    out = sums.select("operator_id", "city", "tariff_id", F.round("_all", 2).alias("revenue_eur"), F.round("_peak", 2).alias("peak_revenue_eur"), F.round(ratio(100 * F.col("_peak"), F.col("_all")), 1).alias("peak_pct"), "sessions")
    return out.orderBy(F.desc("revenue_eur"), "operator_id", "city", "tariff_id")


def fault_geography(raw: DataFrame, days: int = 30) -> DataFrame:
    """A5: faults by city. Counts are of distinct events; positions average the rows as stored."""
    faults = inside(raw, days).where("event_type = 'FAULT_ALERT'")
    sums = faults.groupBy("city").agg(F.count_distinct("event_id").alias("fault_count"), F.count_distinct("station_id").alias("stations_affected"), F.round(F.avg("lat"), 4).alias("lat"), F.round(F.avg("lon"), 4).alias("lon"))
    out = sums.withColumn("faults_per_station", F.round(ratio(F.col("fault_count"), F.col("stations_affected")), 2))
    return out.orderBy(F.desc("fault_count"), "city")


def session_power(raw: DataFrame) -> DataFrame:
    """Mean power of each session with enough meter readings."""
    kind = F.col("event_type")
    by = latest_version(raw.where(kind.isin("SESSION_START", "METER_UPDATE"))).groupBy("session_id")
    out = by.agg(
        F.min("station_id").alias("station_id"),
        F.min(F.when(kind == "SESSION_START", F.col("vehicle_brand"))).alias("brand"),
        F.avg(F.when(kind == "METER_UPDATE", F.col("power_kw").cast("double"))).alias("avg_power_kw"),
        F.count_if(kind == "METER_UPDATE").alias("readings"),
    )
    return out.where(F.col("readings") >= LEAST_READINGS)


def power_anomalies(raw: DataFrame, top: int = 100) -> DataFrame:
    """A6: sessions far above the fleet's mean power. The fleet is one row, broadcast."""
    each = session_power(raw)
    fleet = each.agg(F.avg("avg_power_kw").alias("mu"), F.stddev_pop("avg_power_kw").alias("sigma"))
    far = each.crossJoin(F.broadcast(fleet)).where((F.col("avg_power_kw") > F.col("mu") + SIGMAS * F.col("sigma")) & (F.coalesce("brand", F.lit("")) != ""))
    z = F.round(ratio(F.col("avg_power_kw") - F.col("mu"), F.col("sigma")), 2)
    out = far.select("session_id", "station_id", "brand", z.alias("z_score"), F.round("avg_power_kw", 1).alias("avg_power_kw"))
    return out.orderBy(F.desc("z_score"), "session_id").limit(top)
