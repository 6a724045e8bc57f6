"""The generic event table seen as charging telemetry.

It is written twice, as DataFrame expressions for the engine and as SQL for the oracles, so that a
slip in one shows against the other. Registers are whole cents until the end, so that both engines
sum them exactly.
"""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gridloom.functions.scalars import in_peak
from gridloom.functions.schema import SESSION_TYPES


def view(events: str = "events", nation: str = "nation", region: str = "region") -> str:
    """CTEs up to ``raw``, for oracles: every stored row, copies of every fiftieth event among them."""
    return f"""
e0 AS (SELECT event_id AS n, ts, user_id, value, event_type AS kind, CAST(json_extract_string(props, '$.k') AS INT) AS k,
              CAST(floor(user_id / 4.0) AS BIGINT) AS station_no, CAST(round(value * 100) AS BIGINT) AS cents FROM {events}),
e1 AS (SELECT *, concat(CAST(user_id AS STRING), '-', CAST(CAST(ts AS DATE) AS STRING)) AS session_id FROM e0),
e2 AS (SELECT *, sum(cents) OVER (PARTITION BY session_id ORDER BY ts, n ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS register FROM e1),
e3 AS (SELECT e2.*, n_name AS city, r_name AS operator_id,
              CASE kind WHEN 'signup' THEN 'SESSION_START' WHEN 'view' THEN 'METER_UPDATE' WHEN 'purchase' THEN 'SESSION_STOP'
                        WHEN 'error' THEN 'FAULT_ALERT' ELSE 'STATUS_CHANGE' END AS event_type
       FROM e2 JOIN {nation} ON n_nationkey = station_no % 25 JOIN {region} ON r_regionkey = n_regionkey),
one AS (SELECT CAST(n AS STRING) AS event_id, n, event_type, concat('ST-', CAST(station_no AS STRING)) AS station_id, station_no,
               CAST(user_id % 4 + 1 AS INT) AS connector_id, session_id, ts AS timestamp, operator_id,
               CAST(station_no % 90 AS DOUBLE) AS lat, CAST(station_no % 180 AS DOUBLE) AS lon, city, 'XX' AS country,
               CASE WHEN event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN CAST(value AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS power_kw,
               CASE WHEN event_type IN ('SESSION_START', 'METER_UPDATE', 'SESSION_STOP') THEN CAST(register AS DOUBLE) / CAST(100 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS energy_kwh,
               CASE WHEN event_type = 'SESSION_START' THEN concat('brand', CAST(k % 9 AS STRING)) ELSE '' END AS vehicle_brand,
               CASE n % 4 WHEN 0 THEN 'standard-v1' WHEN 1 THEN 'peak-rate-v2' WHEN 2 THEN 'off-peak-v1' ELSE 'fleet-v1' END AS tariff_id,
               CASE WHEN event_type = 'SESSION_STOP' THEN CAST(value AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS cost_eur,
               CASE WHEN event_type = 'STATUS_CHANGE' THEN CASE n % 3 WHEN 0 THEN 'Available' WHEN 1 THEN 'Charging' ELSE 'Faulted' END ELSE '' END AS status,
               CASE WHEN n % 4 = 1 AND event_type = 'SESSION_STOP' AND (hour(ts) BETWEEN 7 AND 8 OR hour(ts) BETWEEN 17 AND 19) THEN 1 ELSE 0 END AS is_peak_priced
        FROM e3),
raw AS (SELECT *, timestamp + INTERVAL '1' SECOND AS produced_at, timestamp + INTERVAL '2' SECOND AS ingested_at, 0 AS copy_no FROM one
        UNION ALL
        SELECT *, timestamp + INTERVAL '1' SECOND, timestamp + INTERVAL '62' SECOND, 1 AS copy_no FROM one WHERE n % 50 = 0)"""


FINAL = """
final AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY station_id, connector_id, event_type, timestamp, event_id
                                                      ORDER BY ingested_at DESC) AS version FROM raw) v WHERE version = 1)"""


def sql(query: str, final: bool = True) -> str:
    """An oracle query over raw (and final)."""
    return f"WITH {view()}{',' + FINAL if final else ''}\n{query}"


#: What each kind of generic event stands for; every other kind is a change of status.
_KINDS = {"signup": "SESSION_START", "view": "METER_UPDATE", "purchase": "SESSION_STOP", "error": "FAULT_ALERT"}


def _places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations and their regions, 25 rows at any size of the tables; broadcast, as events dealt out by them would go to 25 tasks at most."""
    nation, region = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("nation", "region"))
    known = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    return F.broadcast(known.select("n_nationkey", F.col("n_name").alias("city"), F.col("r_name").alias("operator_id")))


def _station_no(user: Column) -> Column:
    return F.floor(user / 4).cast("long")


def _station(number: Column) -> dict[str, Column]:
    """What the number of a station tells of it."""
    return {
        "station_id": F.concat(F.lit("ST-"), number.cast("string")), "country": F.lit("XX"),
        "lat": (number % 90).cast("double"), "lon": (number % 180).cast("double"),
    }


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stored rows of the telemetry view, duplicates included."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    n, station, kind, cost = F.col("n"), F.col("station_no"), F.col("event_type"), F.col("value").cast("double")
    meaning = F.coalesce(*[F.when(F.col("event_type") == k, F.lit(v)) for k, v in _KINDS.items()], F.lit("STATUS_CHANGE"))
    e = events.select(F.col("event_id").alias("n"), F.col("ts").alias("timestamp"), "user_id", "value", F.get_json_object("props", "$.k").cast("int").alias("k"), meaning.alias("event_type"))
    e = e.withColumn("station_no", _station_no(F.col("user_id"))).withColumn("session_id", F.concat_ws("-", F.col("user_id").cast("string"), F.date_format("timestamp", "yyyy-MM-dd")))
    so_far = Window.partitionBy("session_id").orderBy("timestamp", "n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e = e.withColumn("register", F.sum(F.round(F.col("value") * 100).cast("long")).over(so_far)).join(_places(spark, sf_dir), F.col("n_nationkey") == station % 25)
    of = lambda when, value, other: F.when(when, value).otherwise(other)
    metered, stop, known = kind.isin(*SESSION_TYPES), kind == "SESSION_STOP", _station(station)
    status = F.element_at(F.array(F.lit("Available"), F.lit("Charging"), F.lit("Faulted")), (n % 3 + 1).cast("int"))
    tariff = F.element_at(F.array(*map(F.lit, ("standard-v1", "peak-rate-v2", "off-peak-v1", "fleet-v1"))), (n % 4 + 1).cast("int"))
    one = e.select(
        n.cast("string").alias("event_id"), "n", "event_type", known["station_id"].alias("station_id"), "station_no",
        (F.col("user_id") % 4 + 1).cast("int").alias("connector_id"), "session_id", "timestamp", "operator_id",
        known["lat"].alias("lat"), known["lon"].alias("lon"), "city", known["country"].alias("country"),
        of(metered, cost, F.lit(0.0)).alias("power_kw"), of(metered, F.col("register").cast("double") / 100, F.lit(0.0)).alias("energy_kwh"),
        of(kind == "SESSION_START", F.concat(F.lit("brand"), (F.col("k") % 9).cast("string")), F.lit("")).alias("vehicle_brand"), tariff.alias("tariff_id"),
        of(stop, cost, F.lit(0.0)).alias("cost_eur"), of(kind == "STATUS_CHANGE", status, F.lit("")).alias("status"),
        (stop & (n % 4 == 1) & in_peak(F.hour("timestamp"))).cast("int").alias("is_peak_priced"),
    )
    stored = lambda rows, late, copy: rows.select("*", (F.col("timestamp") + F.expr("INTERVAL 1 SECOND")).alias("produced_at"), (F.col("timestamp") + F.expr(f"INTERVAL {late} SECONDS")).alias("ingested_at"), F.lit(copy).alias("copy_no"))
    return stored(one, 2, 0).unionByName(stored(one.where(n % 50 == 0), 62, 1))


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row a station, as the registry would have it: the numbers of raw_events() once each, then what is known of them."""
    numbers = spark.read.parquet(f"{sf_dir}/events.parquet").select(_station_no(F.col("user_id")).alias("station_no")).distinct()
    found = numbers.join(F.broadcast(_places(spark, sf_dir).distinct()), F.col("n_nationkey") == F.col("station_no") % 25)
    known = {**{c: F.col(c) for c in ("operator_id", "city")}, **_station(F.col("station_no"))}
    return found.select(*[known[c].alias(c) for c in ("station_id", "operator_id", "city", "country", "lat", "lon")]).selectExpr("*", "4 AS num_connectors")
