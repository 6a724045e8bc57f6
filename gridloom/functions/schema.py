"""Schemas and closed vocabularies of the telemetry model."""

from pyspark.sql import types as T

# Event types, statuses, fault codes with components, and tariffs (id, name, base price, peak multiplier).
EVENT_TYPES = ("SESSION_START", "METER_UPDATE", "STATUS_CHANGE", "SESSION_STOP", "HEARTBEAT", "FAULT_ALERT")
SESSION_TYPES = ("SESSION_START", "METER_UPDATE", "SESSION_STOP")
STATUSES = ("Available", "Charging", "Faulted")
FAULTS = (
    ("GroundFailure", "EVSE"), ("OverCurrentFailure", "Connector"), ("OverVoltage", "PowerModule"),
    ("HighTemperature", "CoolingSystem"), ("ConnectorLockFailure", "Connector"), ("CommunicationError", "Controller"),
)
TARIFFS = (
    ("standard-v1", "Standard", 0.39, 1.00), ("peak-rate-v2", "Peak Rate", 0.49, 1.35),
    ("off-peak-v1", "Off Peak", 0.29, 0.80), ("fleet-v1", "Fleet Contract", 0.34, 1.00),
)
#: Peak hours, end-exclusive.
PEAK_WINDOWS = ((7, 9), (17, 20))


_TYPES = {"string": T.StringType(), "int": T.IntegerType(), "long": T.LongType(), "float": T.FloatType(), "double": T.DoubleType(), "boolean": T.BooleanType(), "timestamp": T.TimestampType()}


def struct(text: str) -> T.StructType:
    """A schema from "name type, ..." with struct<...> for nesting; needs no running session."""
    parts, depth, at = [], 0, 0
    for k, c in enumerate(text + ","):
        depth += (c == "<") - (c == ">")
        if c == "," and depth == 0:
            parts.append(text[at:k].strip())
            at = k + 1
    out = []
    for part in parts:
        name, _, kind = part.partition(" ")
        out.append(T.StructField(name, struct(kind[len("struct<") : -1]) if kind.startswith("struct<") else _TYPES[kind]))
    return T.StructType(out)


LOCATION = "location struct<lat double, lon double, city string, country string>"
METER = "meter struct<power_kw double, energy_kwh double, voltage_v double, current_a double, soc_percent int>"
VEHICLE = "vehicle struct<brand string, model string, ev_id string>"
FAULT = "fault struct<error_code string, component string>"

#: The nested event, as producers send it in JSON.
EVENT = struct(
    "event_id string, event_type string, station_id string, connector_id int, session_id string, timestamp string, "
    f"operator_id string, {LOCATION}, {METER}, {VEHICLE}, tariff_id string, cost_eur double, {FAULT}, status string, is_peak_priced boolean"
)
#: The flat event, as it is stored: 27 columns, none of them null.
CLEAN = struct(
    "event_id string, event_type string, station_id string, connector_id int, session_id string, "
    "timestamp timestamp, ingested_at timestamp, produced_at timestamp, operator_id string, lat double, lon double, "
    "city string, country string, power_kw float, energy_kwh float, voltage_v float, current_a float, soc_percent int, "
    "vehicle_brand string, vehicle_model string, ev_id string, tariff_id string, cost_eur float, error_code string, "
    "component string, status string, is_peak_priced int"
)
CLEAN_COLUMNS = CLEAN.fieldNames()
DEAD_LETTER = struct("raw_payload string, error string, ingested_at timestamp")
STATIONS = struct("station_id string, operator_id string, city string, country string, lat double, lon double, num_connectors int, created_at timestamp")
CONNECTORS = struct("station_id string, connector_id int, power_kw_rating float, connector_type string")
TARIFF = struct("tariff_id string, name string, price_per_kwh_eur float, peak_multiplier float")
#: The columns that name a stored event; of rows that agree in them the last ingested counts.
VERSION_KEY = ("station_id", "connector_id", "event_type", "timestamp", "event_id")
