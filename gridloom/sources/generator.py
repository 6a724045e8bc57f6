"""A synthetic fleet and its events, as DataFrame expressions over hashed seeds.

Every random choice is a hash of the seed, a name and the row's own keys, so that any partition can
be made again by itself. Sessions of a connector follow one another: a fold over its sessions
carries its own clock, which the gaps between them depend on.
"""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.scalars import current_of, format_rfc3339, in_peak, taper_power
from gridloom.functions.schema import FAULTS, PEAK_WINDOWS, TARIFFS

#: Invented defaults of a fleet: brand, model, battery in kWh, most power in kW, weight.
VEHICLES = (
    ("Aster", "One", 52, 110, 18), ("Aster", "Two", 64, 170, 14), ("Borea", "Coupe", 70, 200, 9), ("Cirrus", "Van", 88, 120, 6),
    ("Delphin", "City", 40, 80, 16), ("Delphin", "Tour", 76, 220, 11), ("Ember", "S", 95, 270, 5), ("Fjord", "Cross", 82, 150, 7),
)
#: Invented defaults of a fleet: code, name, latitude, longitude, weight.
CITIES = (
    ("NOR", "Northport", 41.2, 29.1, 24), ("MID", "Midvale", 39.6, 32.4, 14), ("WES", "Westbay", 38.3, 27.0, 11), ("SOU", "Southmere", 37.1, 30.6, 8), ("EAS", "Eastholm", 38.8, 35.2, 5),
)


@dataclass(frozen=True)
class Fleet:
    """What is generated. check() names the first setting that makes no sense."""

    stations: int = 200
    connectors: tuple[int, int] = (2, 6)
    sessions: int = 4
    operators: tuple[str, ...] = ("North Grid", "Volt & Co", "Parkside", "Autobahn Energy", "Citycharge")
    cities: tuple = CITIES
    vehicles: tuple = VEHICLES
    country: str = "TR"
    start: str = "2026-07-01 00:00:00"
    session_minutes: tuple[float, float, float, float] = (35, 15, 10, 90)
    meter_seconds: tuple[int, int] = (60, 300)
    idle_minutes: float = 8.0
    #: faults an hour of charging
    fault_rate: float = 0.05
    duplicate_rate: float = 0.02
    late_rate: float = 0.01
    late_seconds: tuple[float, float] = (2, 10)
    peak_windows: tuple = field(default=tuple((a, b, w) for (a, b), w in zip(PEAK_WINDOWS, (3.0, 3.5), strict=True)))
    seed: int = 42

    def check(self) -> "Fleet":
        mean, std, low, high = self.session_minutes
        wrong = {
            "stations": self.stations <= 0,
            "connectors": not 1 <= self.connectors[0] <= self.connectors[1],
            "sessions": self.sessions < 0,
            "operators": not self.operators,
            "cities": not self.cities or sum(c[4] for c in self.cities) <= 0 or any(c[4] < 0 for c in self.cities),
            "vehicles": not self.vehicles or sum(v[4] for v in self.vehicles) <= 0 or any(v[4] < 0 for v in self.vehicles),
            "session_minutes": not (0 < low <= mean <= high and std >= 0),
            "meter_seconds": not 0 < self.meter_seconds[0] <= self.meter_seconds[1],
            "idle_minutes": self.idle_minutes <= 0,
            "rates": not all(0 <= r <= 1 for r in (self.fault_rate, self.duplicate_rate, self.late_rate)),
            "late_seconds": not 0 <= self.late_seconds[0] <= self.late_seconds[1],
            "peak_windows": any(not 0 <= a < b <= 24 or w <= 0 for a, b, w in self.peak_windows),
        }
        for name, bad in wrong.items():
            if bad:
                raise ValueError(f"{name} = {getattr(self, name, None)}")
        return self


def _draw(fleet: Fleet, name: str, *keys) -> Column:
    """A number in [0, 1) that depends on seed, name and keys alone."""
    return F.pmod(F.xxhash64(F.lit(fleet.seed), F.lit(name), *keys), F.lit(1 << 40)) / float(1 << 40)


def _pick(draw: Column, weighted: list) -> Column:
    """The value whose share of the summed weights draw falls in."""
    total, so_far, out = float(sum(w for _, w in weighted)), 0.0, F
    for value, weight in weighted[:-1]:
        so_far += weight
        out = out.when(draw < so_far / total, F.lit(value))
    return out.otherwise(F.lit(weighted[-1][0])) if out is not F else F.lit(weighted[-1][0])


def _normal(fleet: Fleet, name: str, mean, std, low, high, *keys) -> Column:
    """Truncated normal: the first of eight draws within bounds, else the mean."""
    tries = []
    for k in range(8):
        u, v = (_draw(fleet, f"{name}{k}{x}", *keys) for x in "uv")
        z = mean + std * F.sqrt(-2 * F.log(1 - u)) * F.cos(v * 2 * 3.141592653589793)
        tries.append(F.when((z >= low) & (z <= high), z))
    return F.coalesce(*tries, F.lit(float(min(max(mean, low), high))))


def stations(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """The roster: ids count up within each city and stay unique whatever their number."""
    k = F.col("id")
    city = _pick(_draw(fleet, "city", k), [(i, c[4]) for i, c in enumerate(fleet.cities)])
    of = lambda j: F.element_at(F.array(*[F.lit(c[j]) for c in fleet.cities]), F.col("c") + 1)
    rows = spark.range(fleet.stations).select("id", city.alias("c"))
    rows = rows.withColumn("n", F.row_number().over(Window.partitionBy("c").orderBy("id")))
    lo, hi = fleet.connectors
    return rows.select(
        F.concat(F.lit(f"{fleet.country}-"), of(0), F.lit("-"), F.when(F.col("n") < 10000, F.lpad(F.col("n").cast("string"), 4, "0")).otherwise(F.col("n").cast("string"))).alias("station_id"),
        F.element_at(F.array(*map(F.lit, fleet.operators)), (F.floor(_draw(fleet, "operator", k) * len(fleet.operators)) + 1).cast("int")).alias("operator_id"),
        of(1).alias("city"), F.lit(fleet.country).alias("country"),
        (of(2) + (_draw(fleet, "lat", k) - 0.5) * 0.12).alias("lat"), (of(3) + (_draw(fleet, "lon", k) - 0.5) * 0.12).alias("lon"),
        (F.floor(_draw(fleet, "connectors", k) * (hi - lo + 1)) + lo).cast("int").alias("num_connectors"), F.to_timestamp(F.lit(fleet.start)).alias("created_at"),
    )


def connectors(roster: DataFrame, fleet: Fleet) -> DataFrame:
    rows = roster.select("station_id", F.explode(F.sequence(F.lit(1), F.col("num_connectors"))).alias("connector_id"))
    power = _pick(_draw(fleet, "rating", F.col("station_id"), F.col("connector_id")), [(22.0, 3), (50.0, 3), (150.0, 2), (350.0, 2)])
    return rows.withColumn("power_kw_rating", power.cast("float")).withColumn("connector_type", F.when(F.col("power_kw_rating") < 30, "AC").otherwise("DC"))


def _uuid(*keys: Column) -> Column:
    h = F.sha2(F.concat_ws("|", *[k.cast("string") for k in keys]), 256)
    return F.concat_ws("-", *[F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])


_RUN = "struct<s:int,start:double,minutes:double,faulted:boolean,down:double>"


def _runs(fleet: Fleet) -> Column:
    """A connector's sessions in order: start and length in minutes, whether a fault cut it short, and
    how long that took to mend.

    The fold's clock is the connector's own: the exponential gap before a session is shorter where it
    begins at peak. While a session charges, a fault comes with the rate's chance in every moment.
    """
    place = (F.col("station_id"), F.col("connector_id"))
    begin = F.to_timestamp(F.lit(fleet.start))
    opened = F.hour(begin) * 60 + F.minute(begin)

    def step(held, s):
        hour = F.floor(F.pmod(opened + held["t"], F.lit(1440.0)) / 60)
        weight = F.lit(1.0)
        for a, b, w in fleet.peak_windows:
            weight = F.when((hour >= a) & (hour < b), F.lit(w)).otherwise(weight)
        idle = F.greatest(F.lit(0.25), -F.log(1 - _draw(fleet, "idle", *place, s)) * fleet.idle_minutes / weight)
        planned = _normal(fleet, "minutes", *fleet.session_minutes, *place, s)
        until = -F.log(1 - _draw(fleet, "fault", *place, s)) * (60.0 / fleet.fault_rate) if fleet.fault_rate else F.lit(float("inf"))
        faulted = until < planned
        down = F.when(faulted, 5 + 25 * _draw(fleet, "down", *place, s)).otherwise(0.0)
        start, minutes = held["t"] + idle, F.least(planned, F.greatest(until, F.lit(1.0)))
        run = F.struct(s.alias("s"), start.alias("start"), minutes.alias("minutes"), faulted.alias("faulted"), down.alias("down"))
        return F.struct((start + minutes + down).alias("t"), F.concat(held["out"], F.array(run)).alias("out"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(max(1, fleet.sessions))), F.struct(F.lit(0.0).alias("t"), F.array().cast(f"array<{_RUN}>").alias("out")), step, lambda held: held["out"])


def sessions(roster: DataFrame, plugs: DataFrame, fleet: Fleet) -> DataFrame:
    """Sessions of each connector, one after another with an idle gap before each, shorter at peak."""
    keys = [F.col("station_id"), F.col("connector_id"), F.col("s")]
    rows = plugs.join(roster, "station_id").withColumn("_run", F.explode(_runs(fleet))).select("*", "_run.*").drop("_run")
    rows = rows if fleet.sessions else rows.limit(0)
    car = _pick(_draw(fleet, "car", *keys), [(i, v[4]) for i, v in enumerate(fleet.vehicles)])
    of = lambda j: F.element_at(F.array(*[F.lit(v[j]) for v in fleet.vehicles]), F.col("car") + 1)
    rows = rows.withColumn("car", car)
    start = F.timestamp_millis((F.unix_millis(F.to_timestamp(F.lit(fleet.start))) + F.col("start") * 60000).cast("long"))
    rows = rows.withColumn("t_start", start).withColumn("t_stop", F.timestamp_millis((F.unix_millis(start) + F.col("minutes") * 60000).cast("long")))
    alphabet = "ABCDEFGHJKLMNPRSTUVWXYZ0123456789"
    vin = F.concat(*[F.substring(F.lit(alphabet), (F.floor(_draw(fleet, f"vin{i}", *keys) * len(alphabet)) + 1).cast("int"), F.lit(1)) for i in range(17)])
    peak = in_peak(F.hour("t_start"), [(a, b) for a, b, _ in fleet.peak_windows])
    other = _pick(_draw(fleet, "tariff", *keys), [("off-peak-v1", 1), ("fleet-v1", 1), ("standard-v1", 2)])
    return rows.select(
        *keys, "operator_id", "city", "country", "lat", "lon", "connector_type", "t_start", "t_stop", "faulted", "down", "minutes",
        F.concat(F.lit("sess-"), F.substring(_uuid(F.lit(fleet.seed), *keys), 1, 18)).alias("session_id"),
        of(0).alias("brand"), of(1).alias("model"), vin.alias("ev_id"), of(2).cast("double").alias("battery"),
        F.least(F.col("power_kw_rating").cast("double"), of(3).cast("double")).alias("target"), (10 + 40 * _draw(fleet, "soc", *keys)).alias("soc0"),
        F.when(peak & (_draw(fleet, "peak", *keys) < 0.6), "peak-rate-v2").otherwise(other).alias("tariff_id"),
        (F.floor(_draw(fleet, "meter", *keys) * (fleet.meter_seconds[1] - fleet.meter_seconds[0] + 1)) + fleet.meter_seconds[0]).alias("every"),
    )


def advance(soc: Column, energy: Column, battery: Column, target: Column, hours: Column) -> Column:
    """struct(soc, energy, power) after so many hours of charging; a full battery takes no more."""
    power = taper_power(soc, target)
    added = F.when(soc < 100, power * hours).otherwise(F.lit(0.0))
    return F.struct(F.least(F.lit(100.0), soc + added / battery * 100).alias("soc"), (energy + added).alias("energy"), power.alias("power"))


def stop_cost(energy: Column, tariff: Column, hour: Column, windows=PEAK_WINDOWS) -> tuple[Column, Column]:
    """Cost of a session and whether it was billed at a premium: in a peak window, by a multiplier above 1."""
    base, mult = F, F
    for i, _, p, m in TARIFFS:
        base, mult = base.when(tariff == i, F.lit(p)), mult.when(tariff == i, F.lit(m))
    peak = in_peak(hour, windows)
    return F.round(energy * base * F.when(peak, mult).otherwise(F.lit(1.0)), 2), peak & (mult > 1.0)


def events(spark: SparkSession, fleet: Fleet) -> DataFrame:
    """Nested events with event_ts; one row each, no order implied."""
    fleet.check()
    roster = stations(spark, fleet)
    runs = sessions(roster, connectors(roster, fleet), fleet)
    # readings of a session: state after each interval, folded over the session's own steps
    seconds = F.floor((F.unix_millis("t_stop") - F.unix_millis("t_start")) / 1000)
    steps = F.greatest(F.floor((seconds - 1) / F.col("every")).cast("int"), F.lit(0))
    first = F.struct(F.col("soc0").alias("soc"), F.lit(0.0).alias("energy"), F.lit(0.0).alias("power"))
    folded = F.aggregate(
        F.sequence(F.lit(1), F.greatest(steps, F.lit(1))),
        F.array(first),
        lambda a, i: F.when(i > steps, a).otherwise(F.concat(a, F.array(advance(F.element_at(a, -1)["soc"], F.element_at(a, -1)["energy"], F.col("battery"), F.col("target"), F.col("every") / 3600.0)))),
    )
    runs = runs.withColumn("steps", steps).withColumn("states", folded)
    rest = (F.unix_millis("t_stop") - F.unix_millis("t_start")) / 3600000.0 - F.col("steps") * F.col("every") / 3600.0
    last = F.element_at("states", -1)
    runs = runs.withColumn("final", advance(last["soc"], last["energy"], F.col("battery"), F.col("target"), rest))
    volts = F.when(F.col("connector_type") == "DC", 400.0).otherwise(230.0)

    def meter(power, energy, soc):
        return F.struct(F.round(power, 1).alias("power_kw"), F.round(energy, 3).alias("energy_kwh"), volts.alias("voltage_v"), F.round(current_of(power, volts), 1).alias("current_a"), F.floor(soc).cast("int").alias("soc_percent"))

    def row(kind, ts, **has):
        null = {"session_id": "string", "meter": "struct<power_kw double,energy_kwh double,voltage_v double,current_a double,soc_percent int>", "vehicle": "struct<brand string,model string,ev_id string>", "tariff_id": "string", "cost_eur": "double", "fault": "struct<error_code string,component string>", "status": "string", "is_peak_priced": "boolean"}
        return F.struct(F.lit(kind).alias("event_type"), ts.alias("event_ts"), *[has.get(n, F.lit(None)).cast(t).alias(n) for n, t in null.items()])

    zero, sid, tariff = F.lit(0.0), F.col("session_id"), F.col("tariff_id")
    cost, peak = stop_cost(F.col("final.energy"), tariff, F.hour("t_stop"), [(a, b) for a, b, _ in fleet.peak_windows])
    readings = F.transform(F.slice("states", F.lit(2), F.greatest(F.col("steps"), F.lit(0))), lambda x, i: row("METER_UPDATE", F.timestamp_millis(F.unix_millis("t_start") + (i + 1) * F.col("every") * 1000), session_id=sid, tariff_id=tariff, meter=meter(x["power"], x["energy"], x["soc"])))
    fault = F.floor(_draw(fleet, "code", sid) * len(FAULTS)).cast("int") + 1
    broken = F.struct(F.element_at(F.array(*[F.lit(c) for c, _ in FAULTS]), fault).alias("error_code"), F.element_at(F.array(*[F.lit(c) for _, c in FAULTS]), fault).alias("component"))
    t0, t1 = F.col("t_start"), F.col("t_stop")
    always = F.array(
        row("SESSION_START", t0, session_id=sid, tariff_id=tariff, vehicle=F.struct("brand", "model", "ev_id"), meter=meter(zero, zero, F.col("soc0"))),
        row("STATUS_CHANGE", t0, session_id=sid, status=F.lit("Charging")),
        row("SESSION_STOP", t1, session_id=sid, tariff_id=tariff, cost_eur=cost, is_peak_priced=peak, meter=meter(zero, F.col("final.energy"), F.col("final.soc"))),
        row("STATUS_CHANGE", t1, status=F.when(F.col("faulted"), "Faulted").otherwise("Available")),
    )
    back = F.timestamp_millis((F.unix_millis("t_stop") + F.col("down") * 60000).cast("long"))
    after = F.when(F.col("faulted"), F.array(row("FAULT_ALERT", t1, fault=broken), row("STATUS_CHANGE", back, status=F.lit("Available")))).otherwise(F.array().cast(always_type(always)))
    place = ["station_id", "connector_id", "operator_id", F.struct("lat", "lon", "city", "country").alias("location")]
    out = runs.select(*place, F.posexplode(F.concat(always, readings, after)).alias("k", "e")).select(*place[:3], "location", "k", F.col("e.session_id").alias("_sid"), "e.*")
    begin = F.to_timestamp(F.lit(fleet.start))
    opening = connectors(roster, fleet).join(roster, "station_id").select(*place, F.lit(-1).alias("k"), F.lit(None).cast("string").alias("_sid"), row("STATUS_CHANGE", begin, status=F.lit("Available")).alias("e")).select(*place[:3], "location", "k", "_sid", "e.*")
    beat = roster.withColumn("connector_id", F.lit(0)).select(*place, F.lit(-2).alias("k"), F.lit(None).cast("string").alias("_sid"), row("HEARTBEAT", begin).alias("e")).select(*place[:3], "location", "k", "_sid", "e.*")
    both = out.unionByName(opening).unionByName(beat)
    named = both.withColumn("event_id", _uuid(F.lit(fleet.seed), F.col("station_id"), F.col("connector_id"), F.col("event_type"), F.col("event_ts"), F.col("k")))
    return named.withColumn("timestamp", format_rfc3339(F.col("event_ts"))).drop("k", "_sid")


def always_type(column: Column) -> str:
    """The type of an array of event rows, for an empty one."""
    e = "struct<event_type:string,event_ts:timestamp,session_id:string,meter:struct<power_kw:double,energy_kwh:double,voltage_v:double,current_a:double,soc_percent:int>,vehicle:struct<brand:string,model:string,ev_id:string>,tariff_id:string,cost_eur:double,fault:struct<error_code:string,component:string>,status:string,is_peak_priced:boolean>"
    return f"array<{e}>"


def arrivals(rows: DataFrame, fleet: Fleet) -> DataFrame:
    """key, value, produced_at: what a consumer sees. Some rows come late, some twice with the same bytes."""
    key = F.col("event_id")
    lo, hi = fleet.late_seconds
    late = F.when(_draw(fleet, "late", key) < fleet.late_rate, lo + (hi - lo) * _draw(fleet, "delay", key)).otherwise(0.0)
    nested = F.struct(*[f for f in ("event_id", "event_type", "station_id", "connector_id", "session_id", "timestamp", "operator_id", "location", "meter", "vehicle", "tariff_id", "cost_eur", "fault", "status", "is_peak_priced")])
    sent = rows.select(F.col("station_id").alias("key"), F.to_json(nested).alias("value"), F.timestamp_millis((F.unix_millis("event_ts") + late * 1000).cast("long")).alias("produced_at"), (_draw(fleet, "again", key) < fleet.duplicate_rate).alias("_again"))
    return sent.drop("_again").unionByName(sent.where("_again").drop("_again"))
