"""Current state by connector, with compare-and-set in order of arrival.

An event applies unless it is older than the newest that has applied to its key; what applies sets
last_seen and the fields it carries, and nothing else. A stale event writes nothing at all. State
that no event refreshed for the TTL is gone, and then any event applies.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.scalars import state_key

TTL_SECONDS = 300
FIELDS = "status string, power double, soc int, session string"


def carried(event_type: Column, status: Column, has_meter: Column, power: Column, soc: Column, session: Column) -> dict[str, Column]:
    """The fields an event writes; null where it writes none.

    Status comes from status changes alone. A stop clears session and power, whatever its meter says.
    """
    stop = event_type == "SESSION_STOP"
    return {
        "status": F.when((event_type == "STATUS_CHANGE") & (status != ""), status),
        "power": F.when(stop, F.lit(0.0)).when(has_meter, power.cast("double")),
        "soc": F.when(has_meter, soc.cast("int")),
        "session": F.when(stop, F.lit("")).when(event_type.isin("SESSION_START", "METER_UPDATE") & (session != ""), session),
    }


def writes(events: DataFrame, arrival: str, has_meter: Column | None = None) -> DataFrame:
    """key, arrival, ts and the carried fields of flat events."""
    meter = F.col("event_type").isin("SESSION_START", "METER_UPDATE", "SESSION_STOP") if has_meter is None else has_meter
    fields = carried(F.col("event_type"), F.col("status"), meter, F.col("power_kw"), F.col("soc_percent"), F.col("session_id"))
    return events.select(state_key(F.col("event_type"), F.col("station_id"), F.col("connector_id")).alias("key"), F.col(arrival).alias("arrival"), F.col("timestamp").alias("ts"), *[c.alias(n) for n, c in fields.items()])


def with_applied(rows: DataFrame) -> DataFrame:
    """rows with ``applied``: as what applies never goes back in time, it is at least the newest so far."""
    before = Window.partitionBy("key").orderBy("arrival").rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("applied", F.coalesce(F.col("ts") >= F.max("ts").over(before), F.lit(True)))


def current_state(rows: DataFrame) -> DataFrame:
    """key, last_seen and fields after all rows, without expiry."""
    done = with_applied(rows).where("applied")
    last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("arrival"))).alias(c)
    return done.groupBy("key").agg(F.max("ts").alias("last_seen"), *[last(c) for c in ("status", "power", "soc", "session")], F.max("arrival").alias("applied_at"))


def live(state: DataFrame, now: Column, seconds: int = TTL_SECONDS, at: str = "applied_at") -> DataFrame:
    """States that some event refreshed within the TTL: a key that is there was seen lately."""
    return state.where(F.col(at) >= now - F.expr(f"INTERVAL {seconds} SECONDS"))


STATE = f"last_seen timestamp, {FIELDS}"
OUTPUT = f"key string, arrival long, ts timestamp, applied boolean, last_seen timestamp, {FIELDS}"
_NAMES = ("status", "power", "soc", "session")


def apply_in_order(held: tuple | None, events, ttl: float | None = None):
    """The definition, one event after another, which tests hold the others against: yields (event,
    applied, state). Events are dicts in arrival order.

    ttl expires by the events' ``at`` (seconds of arrival time), where they have one.
    """
    state, touched = dict(held[0]) if held else None, held[1] if held else None
    for e in events:
        at = e.get("at")
        if state is not None and ttl is not None and at is not None and touched is not None and at - touched > ttl:
            state = None
        applied = state is None or e["ts"] >= state["last_seen"]
        if applied:
            state = {**(state or dict.fromkeys(("status", "power", "soc", "session"))), "last_seen": e["ts"], **{k: e[k] for k in ("status", "power", "soc", "session") if e.get(k) is not None}}
            touched = at
        yield e, applied, state


def after_each(held: tuple | None, events):
    """Compare-and-set of one key's events (a pandas frame with ts and the fields), in order of arrival:
    applied, last_seen and the fields after each event, as columns.

    held is (last_seen, fields...) before them. What applies never goes back in time, so an event applies if
    it is at least as new as the newest so far; a field is that of the last event that applied and carried it.
    No event is looked at by itself.
    """
    import numpy as np
    import pandas as pd

    ts = pd.to_datetime(events["ts"]).astype("datetime64[us]").astype("int64").to_numpy()
    start = np.iinfo(np.int64).min if held is None else pd.Timestamp(held[0]).tz_localize(None).to_datetime64().astype("datetime64[us]").astype("int64")
    newest = np.maximum.accumulate(np.append(start, ts))
    applied = ts >= newest[:-1]
    out = {"applied": applied, "last_seen": pd.to_datetime(newest[1:], unit="us")}
    for k, name in enumerate(_NAMES, 1):
        carries = np.append(True, applied & events[name].notna().to_numpy())
        values = np.empty(len(carries), object)
        values[0], values[1:] = None if held is None else held[k], events[name].to_numpy(object)
        # each place takes the value of the last one that carries any; what was held carries
        out[name] = values[np.maximum.accumulate(np.where(carries, np.arange(len(carries)), 0))][1:]
    return pd.DataFrame(out, index=events.index)


def streaming_state(rows: DataFrame, ttl_seconds: int | None = None) -> DataFrame:
    """The same as a stateful stream over writes(): one output row for each event.

    State lies in the engine's store by key, and only keys of a batch are read and written. Without a
    TTL the state runs under any trigger. With one, the engine expires keys that no event refreshed, by
    processing time, for queries that run on until they are stopped. stored_state() reads it from outside.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class CompareAndSet(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            extra = {} if ttl_seconds is None else {"ttlDurationMs": ttl_seconds * 1000}
            self.held = handle.getValueState("held", STATE, **extra)

        def handleInputRows(self, key, batches, timer_values):
            events = pd.concat(list(batches), ignore_index=True).sort_values("arrival", kind="stable", ignore_index=True)
            after = after_each(self.held.get() if self.held.exists() else None, events)
            if after["applied"].any():  # a stale event refreshes nothing
                last = after.iloc[-1]
                soc = last["soc"]
                self.held.update((last["last_seen"].to_pydatetime(), last["status"], None if last["power"] is None else float(last["power"]), None if soc is None else int(soc), last["session"]))
            frame = pd.concat([events[["arrival", "ts"]], after], axis=1)
            frame.insert(0, "key", key[0])
            frame["soc"], frame["power"] = frame["soc"].astype("Int32"), frame["power"].astype("Float64")
            yield frame

        def close(self) -> None:
            pass

    mode = "None" if ttl_seconds is None else "ProcessingTime"
    return rows.groupBy("key").transformWithStateInPandas(CompareAndSet(), OUTPUT, "Update", mode)


def stored_state(spark, checkpoint: str) -> DataFrame:
    """key, last_seen and fields as streaming_state() last committed them, read from the store below the
    query's checkpoint: no event is looked at. Expired keys are not there."""
    held = spark.read.format("statestore").option("stateVarName", "held").load(checkpoint)
    value = F.col("value.value") if "value" in held.schema["value"].dataType.names else F.col("value")
    rows = held.select(F.col("key.key").alias("key"), value.alias("v"), *([F.col("value.ttlExpirationMs").alias("until")] if "ttlExpirationMs" in held.schema["value"].dataType.names else []))
    live = rows.where(F.col("until") > F.unix_millis(F.current_timestamp())) if "until" in rows.columns else rows
    return live.select("key", "v.last_seen", *[f"v.{n}" for n in _NAMES])
