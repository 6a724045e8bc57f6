"""Scalar expressions of the telemetry model, as Column functions."""

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from gridloom.functions.schema import PEAK_WINDOWS

_RFC3339 = r"^\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2})$"
_UUID = r"^[0-9a-fA-F]{8}-([0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$"


def hour_of(ts: Column) -> Column:
    """Start of the hour. date_trunc gives a zoned timestamp; zone-less input stays zone-less."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def seconds_between(start: Column, end: Column) -> Column:
    """Second boundaries between two times."""
    return F.unix_seconds(end.cast("timestamp")) - F.unix_seconds(start.cast("timestamp"))


def millis_between(start: Column, end: Column) -> Column:
    return F.unix_millis(end.cast("timestamp")) - F.unix_millis(start.cast("timestamp"))


def parse_rfc3339(text: Column) -> Column:
    """Timestamp, or null unless text is a full RFC 3339 time (a date alone is not)."""
    return F.when(text.rlike(_RFC3339), F.try_to_timestamp(text))


def best_effort_time(text: Column) -> Column:
    """Timestamp from the forms that producers use: RFC 3339 with T or a blank and with or without a
    zone, a date alone, compact digits (YYYYMMDDhhmmss), day-first dates with dots, and Unix seconds
    or milliseconds; null for anything else."""
    t = F.trim(text)
    digits = lambda low, high: t.rlike(rf"^\d{{{low},{high}}}$")
    return (
        F.when(digits(14, 14), F.try_to_timestamp(t, F.lit("yyyyMMddHHmmss")))
        .when(digits(9, 10), F.timestamp_seconds(t.cast("long")))
        .when(digits(12, 13), F.timestamp_millis(t.cast("long")))
        .when(t.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}( \d{1,2}:\d{2}:\d{2})?$"), F.coalesce(F.try_to_timestamp(t, F.lit("d.M.yyyy H:mm:ss")), F.try_to_timestamp(t, F.lit("d.M.yyyy"))))
        .when(t.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(t))
    )


def format_rfc3339(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def is_uuid(text: Column) -> Column:
    return text.rlike(_UUID)


def year_month(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp_ntz"), "yyyyMM")


def ratio(a: Column, b: Column) -> Column:
    """a / b in double; null where b is 0."""
    return a.cast("double") / F.nullif(b.cast("double"), F.lit(0.0))


def bucket_of(value: Column, edges: Column) -> Column:
    """How many of the ascending edges value reaches: 0 to their number."""
    return F.aggregate(edges, F.lit(0), lambda n, e: n + (value >= e).cast("int"))


def in_peak(hour: Column, windows=PEAK_WINDOWS) -> Column:
    return reduce(lambda a, b: a | b, [(hour >= s) & (hour < e) for s, e in windows])


#: Share of full power that is left at a full battery.
TAPER_FLOOR = 0.08


def taper_power(soc: Column, target_kw: Column) -> Column:
    """Full power below 80 percent of charge, from there in a straight line to TAPER_FLOOR at 100."""
    left = (100 - soc) / 20
    return F.when(soc < 80, target_kw).otherwise(target_kw * (TAPER_FLOOR + (1 - TAPER_FLOOR) * left))


def current_of(power_kw: Column, volts: Column) -> Column:
    return F.when(volts > 0, power_kw * 1000 / volts).otherwise(F.lit(0.0))


def billed(energy_kwh: Column, base: Column, multiplier: Column, peak: Column) -> Column:
    return energy_kwh * base * F.when(peak, multiplier).otherwise(F.lit(1.0))


def state_key(event_type: Column, station_id: Column, connector_id: Column) -> Column:
    """Heartbeats have a name space of their own, so that no connector 0 appears."""
    return F.when(event_type == "HEARTBEAT", F.concat(F.lit("station_liveness:"), station_id)).otherwise(F.concat(F.lit("station:"), station_id, F.lit(":"), connector_id.cast("string")))


def dedup_key(event_id: Column) -> Column:
    return F.concat(F.lit("dedup:"), event_id)
