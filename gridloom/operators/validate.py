"""Validation: an ordered list of rules, of which the first that an event breaks names the reason.

Rules are data (name, condition, message); they become one CASE expression, so that a whole batch
is judged in one pass of generated code. The registry is a snapshot of stations and tariffs. Tariffs
are broadcast; stations are while they are below Spark's own limit, and joined by shuffle beyond.
"""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gridloom.functions.scalars import best_effort_time, format_rfc3339, is_uuid, parse_rfc3339
from gridloom.functions.schema import EVENT, EVENT_TYPES, STATUSES

#: Coordinates may differ by so much from the station's.
GEO_EPSILON = 1e-4


@dataclass(frozen=True)
class Rule:
    name: str
    broken: Column
    message: Column


def decode(raw: DataFrame, payload: str = "value") -> DataFrame:
    """raw with ``event`` (nested) and ``bad_json``.

    A payload is bad if it is no JSON object, if a value has another type than the schema says, or
    if anything but white space follows the object. Unknown keys are ignored; JSON null is an
    empty event.
    """
    text = F.col(payload).cast("string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    parsed = F.from_json(text, _with_corrupt(), options)
    out = raw.withColumn("_p", parsed)
    empty = F.trim(text) == "null"
    # the parser does not look at text behind the object; as the one element of an array it must be all
    whole = F.json_array_length(F.concat(F.lit("["), text, F.lit("]"))) == 1
    fields = F.struct(*[F.col(f"_p.{f}").alias(f) for f in EVENT.fieldNames()])
    return out.withColumn("bad_json", ~F.coalesce(empty, F.lit(False)) & (text.isNull() | ~F.coalesce(whole, F.lit(False)) | F.col("_p").isNull() | F.col("_p._corrupt").isNotNull())).withColumn("event", fields).drop("_p")


def _with_corrupt():
    from pyspark.sql import types as T

    return T.StructType([*EVENT.fields, T.StructField("_corrupt", T.StringType())])


def rules() -> list[Rule]:
    """All rules in their order, over the columns of judged()."""
    e = lambda name: F.col(f"event.{name}")
    text = lambda name: F.coalesce(e(name), F.lit(""))
    number = lambda name: F.coalesce(e(name), F.lit(0))
    kind, quoted = text("event_type"), lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    in_session = kind.isin("SESSION_START", "METER_UPDATE", "SESSION_STOP")
    lat, lon = number("location.lat"), number("location.lon")
    connector, has_meter = number("connector_id"), e("meter").isNotNull()
    say = lambda *parts: F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])

    def mismatch(what, field, known):
        return Rule(f"{what}_mismatch", text(field) != F.col(known), say(f"{field.rpartition('.')[2]} ", quoted(text(field)), f" does not match station {what} ", quoted(F.col(known))))

    return [
        Rule("invalid_json", F.col("bad_json"), say("invalid json")),
        Rule("missing_event_id", text("event_id") == "", say("missing event_id")),
        Rule("bad_event_id", ~is_uuid(text("event_id")), say("malformed event_id ", quoted(text("event_id")))),
        Rule("unknown_event_type", ~kind.isin(*EVENT_TYPES), say("unknown event_type ", quoted(kind))),
        Rule("unknown_station", F.col("known_station").isNull(), say("unknown station_id ", quoted(text("station_id")))),
        Rule("bad_timestamp", parse_rfc3339(text("timestamp")).isNull(), say("unparseable timestamp ", quoted(text("timestamp")))),
        Rule("missing_operator", text("operator_id") == "", say("missing operator_id")),
        Rule("missing_location", (text("location.city") == "") | (text("location.country") == ""), say("missing location city/country")),
        Rule("bad_geo", ~lat.between(-90, 90) | ~lon.between(-180, 180), say("lat/lon out of range")),
        mismatch("operator", "operator_id", "known_operator"),
        mismatch("city", "location.city", "known_city"),
        mismatch("country", "location.country", "known_country"),
        Rule("geo_mismatch", (F.abs(lat - F.col("known_lat")) > GEO_EPSILON) | (F.abs(lon - F.col("known_lon")) > GEO_EPSILON), say("lat/lon (", lat, ",", lon, ") does not match station (", F.col("known_lat"), ",", F.col("known_lon"), ")")),
        Rule("bad_connector", (kind == "HEARTBEAT") & (connector != 0), say("HEARTBEAT connector_id must be 0, got ", connector)),
        Rule("connector_out_of_range", (kind != "HEARTBEAT") & ~connector.between(F.lit(1), F.col("known_connectors")), say("connector_id ", connector, " exceeds station connector count ", F.col("known_connectors"))),
        Rule("unknown_tariff", (text("tariff_id") != "") & F.col("known_tariff").isNull(), say("unknown tariff_id ", quoted(text("tariff_id")))),
        Rule("missing_session", in_session & (text("session_id") == ""), say(kind, " missing session_id")),
        Rule("missing_vehicle", (kind == "SESSION_START") & (text("vehicle.brand") == ""), say("SESSION_START missing vehicle brand")),
        Rule("missing_tariff", in_session & (text("tariff_id") == ""), say(kind, " missing tariff_id")),
        Rule("missing_meter", in_session & ~has_meter, say(kind, " missing meter")),
        Rule("bad_cost", (kind == "SESSION_STOP") & (number("cost_eur") < 0), say("negative cost_eur ", number("cost_eur"))),
        Rule("bad_status", (kind == "STATUS_CHANGE") & ~text("status").isin(*STATUSES), say("invalid status ", quoted(text("status")))),
        Rule("missing_fault", (kind == "FAULT_ALERT") & (text("fault.error_code") == ""), say("FAULT_ALERT missing fault error_code")),
        Rule("soc_out_of_range", has_meter & ~number("meter.soc_percent").between(0, 100), say("soc_percent ", number("meter.soc_percent"), " out of range [0,100]")),
        Rule("bad_power", has_meter & ~number("meter.power_kw").between(0, 1000), say("power_kw ", number("meter.power_kw"), " out of range [0,1000]")),
        Rule("bad_energy", has_meter & (number("meter.energy_kwh") < 0), say("negative energy_kwh ", number("meter.energy_kwh"))),
        Rule("bad_voltage", has_meter & (number("meter.voltage_v") < 0), say("negative voltage_v ", number("meter.voltage_v"))),
        Rule("bad_current", has_meter & (number("meter.current_a") < 0), say("negative current_a ", number("meter.current_a"))),
    ]


RULES = (
    "invalid_json missing_event_id bad_event_id unknown_event_type unknown_station bad_timestamp missing_operator missing_location bad_geo "
    "operator_mismatch city_mismatch country_mismatch geo_mismatch bad_connector connector_out_of_range unknown_tariff missing_session "
    "missing_vehicle missing_tariff missing_meter bad_cost bad_status missing_fault soc_out_of_range bad_power bad_energy bad_voltage bad_current"
).split()


def judged(decoded: DataFrame, stations: DataFrame, tariffs: DataFrame) -> DataFrame:
    """decoded with ``rule`` and ``error`` (null for valid events) and ``event_time``."""
    known = stations.select(
        F.col("station_id").alias("known_station"), F.col("operator_id").alias("known_operator"), F.col("city").alias("known_city"), F.col("country").alias("known_country"),
        F.col("lat").alias("known_lat"), F.col("lon").alias("known_lon"), F.col("num_connectors").cast("int").alias("known_connectors"),
    )
    # a price list has a handful of rows; dealt out by it, all events would go to as many tasks
    priced = F.broadcast(tariffs.select(F.col("tariff_id").alias("known_tariff")).distinct())
    joined = decoded.join(known, F.col("event.station_id") == F.col("known_station"), "left").join(priced, F.col("event.tariff_id") == F.col("known_tariff"), "left")
    name, message = F, F
    for k, r in enumerate(rules()):
        name = F.when(r.broken, F.lit(r.name)) if k == 0 else name.when(r.broken, F.lit(r.name))
        message = F.when(r.broken, r.message) if k == 0 else message.when(r.broken, r.message)
    out = joined.withColumn("rule", name).withColumn("error", message).withColumn("event_time", parse_rfc3339(F.col("event.timestamp")))
    return out.drop(*known.columns, "known_tariff")


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid and rejected rows of judged()."""
    return rows.where("rule IS NULL"), rows.where("rule IS NOT NULL")


def dead_letters(rejected: DataFrame, payload: str = "value", ingested_at: Column | None = None) -> DataFrame:
    """raw_payload, error, ingested_at of rejected rows; they are never deduplicated."""
    return rejected.select(F.col(payload).cast("string").alias("raw_payload"), "error", (F.current_timestamp() if ingested_at is None else ingested_at).alias("ingested_at"))


def dead_letter_messages(rejected: DataFrame, payload: str = "value", ingested_at: Column | None = None) -> DataFrame:
    """key, value of the dead-letter stream: the letter as JSON under its raw message's own key."""
    at = F.current_timestamp() if ingested_at is None else ingested_at
    body = F.struct(F.col(payload).cast("string").alias("raw_payload"), F.col("error"), format_rfc3339(at.cast("timestamp")).alias("ingested_at"))
    key = F.col("key").cast("string") if "key" in rejected.columns else F.lit(None).cast("string")
    return rejected.select(key.alias("key"), F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))


def read_dead_letters(messages: DataFrame) -> DataFrame:
    """raw_payload, error, ingested_at from dead-letter messages. Malformed ones are left out, unknown
    fields ignored, and times read in any of the forms of best_effort_time()."""
    schema = "raw_payload string, error string, ingested_at string, _corrupt string"
    rows = messages.select(F.from_json(F.col("value").cast("string"), schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("r")).select("r.*")
    return rows.where("_corrupt IS NULL AND raw_payload IS NOT NULL").select("raw_payload", "error", best_effort_time(F.col("ingested_at")).alias("ingested_at"))


def reason(rule: Column) -> Column:
    """The coarse label of a rejection."""
    return F.when(rule == "invalid_json", "invalid_json").otherwise("validation")
