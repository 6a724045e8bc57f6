"""Nested events to flat rows of 27 columns, none of them null, and back to JSON."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.schema import CLEAN, CLEAN_COLUMNS

_NESTED = {
    "lat": "location.lat", "lon": "location.lon", "city": "location.city", "country": "location.country",
    "power_kw": "meter.power_kw", "energy_kwh": "meter.energy_kwh", "voltage_v": "meter.voltage_v", "current_a": "meter.current_a", "soc_percent": "meter.soc_percent",
    "vehicle_brand": "vehicle.brand", "vehicle_model": "vehicle.model", "ev_id": "vehicle.ev_id", "error_code": "fault.error_code", "component": "fault.component",
}


def flatten(rows: DataFrame, ingested_at: Column | None = None, produced_at: Column | None = None, event: str = "event", event_time: str = "event_time") -> DataFrame:
    """One flat row for each; what an event lacks is '' or 0, and true is 1."""
    times = {"timestamp": F.col(event_time), "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at, "produced_at": F.col(event_time) if produced_at is None else produced_at}
    out = []
    for f in CLEAN.fields:
        if f.name in times:
            c = F.date_trunc("millisecond", times[f.name].cast("timestamp"))
        else:
            c = F.coalesce(F.col(f"{event}.{_NESTED.get(f.name, f.name)}").cast(f.dataType), F.lit("" if f.dataType.typeName() == "string" else 0).cast(f.dataType))
        out.append(c.alias(f.name))
    return rows.select(*out)


def to_json(clean: DataFrame) -> DataFrame:
    """key, value: messages of the clean stream, keyed by station."""
    return clean.select(F.col("station_id").alias("key"), F.to_json(F.struct(*CLEAN_COLUMNS), {"ignoreNullFields": "false"}).alias("value"))


def from_json(messages: DataFrame, strict: bool = True) -> DataFrame:
    """Flat rows from messages. strict fails on a malformed one; otherwise they are left out."""
    if strict:
        return messages.select(F.from_json("value", CLEAN, {"mode": "FAILFAST"}).alias("r")).select("r.*")
    from pyspark.sql import types as T

    schema = T.StructType([*CLEAN.fields, T.StructField("_corrupt", T.StringType())])
    rows = messages.select(F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*")
    return rows.where("_corrupt IS NULL AND event_id IS NOT NULL").drop("_corrupt")
