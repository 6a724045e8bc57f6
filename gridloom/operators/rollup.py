"""The hourly revenue rollup: incremental and approximate, its exact recomputation, and its stored form.

Stored parts lie by day; a stream adds the parts of each batch, and once a day the previous day's
parts give way to exact ones.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.functions.scalars import hour_of
from gridloom.operators.dedup import latest_version
from gridloom.operators.ledger import Ledger, Segment, fresh
from gridloom.operators.storage import between, newest, shifted

KEY = ("hour", "operator_id", "city", "tariff_id", "is_peak")


def partial(events: DataFrame) -> DataFrame:
    """Sums of one inserted batch. Stale versions count as often as they arrive."""
    stops = events.where("event_type = 'SESSION_STOP'")
    by = stops.groupBy(hour_of(F.col("timestamp")).alias("hour"), "operator_id", "city", "tariff_id", F.col("is_peak_priced").alias("is_peak"))
    return by.agg(F.sum(F.col("cost_eur").cast("double")).alias("revenue_eur"), F.count("*").alias("sessions"))


def merged(parts: DataFrame) -> DataFrame:
    """The rollup as read: parts of the same key summed up."""
    return parts.groupBy(*KEY).agg(F.sum("revenue_eur").alias("revenue_eur"), F.sum("sessions").alias("sessions"))


def exact(raw: DataFrame, start: Column, end: Column) -> DataFrame:
    """The rollup of [start, end), every event once."""
    rows = latest_version(raw.where("event_type = 'SESSION_STOP'"))
    return partial(rows.where((F.col("timestamp") >= start) & (F.col("timestamp") < end)))


def previous_day(raw: DataFrame) -> DataFrame:
    """day_start, day_end: the last full day before that of the newest event. No row if there is none."""
    end = F.date_trunc("day", F.max("timestamp")).cast("timestamp_ntz").alias("day_end")
    return raw.agg(end).where("day_end IS NOT NULL").select((F.col("day_end") - F.expr("INTERVAL 1 DAY")).alias("day_start"), "day_end")


def day_before(raw: DataFrame) -> tuple[str, str] | None:
    """previous_day() as text, for literal bounds; None if raw has no rows."""
    end = newest(raw)
    if end is None:
        return None
    end = f"{end[:10]} 00:00:00"
    return shifted(raw, end, "- INTERVAL 1 DAY"), end


def exact_day(raw: DataFrame, day: tuple[str, str]) -> DataFrame:
    """The rollup of one day, every event once: the bounds reach the scan, below the removal of versions."""
    return partial(latest_version(between(raw.where("event_type = 'SESSION_STOP'"), *day, until_open=True)))


def reconciled(parts: DataFrame, raw: DataFrame) -> DataFrame:
    """The rollup with the previous day's rows replaced by exact ones."""
    day = day_before(raw)
    if day is None:
        return merged(parts)
    kind = parts.schema["hour"].dataType
    outside = (F.col("hour") < F.lit(day[0]).cast(kind)) | (F.col("hour") >= F.lit(day[1]).cast(kind))
    return merged(parts.where(outside)).unionByName(exact_day(raw, day))


def _ledger(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, path, "day")


def _write(rows: DataFrame, path: str, label: str | None = None) -> list[Segment]:
    """Write parts as new segments of their days. They don't count yet."""
    name = fresh()
    days = rows.withColumn("day", F.date_format("hour", "yyyy-MM-dd")).withColumn("seg", F.lit(name))
    days.repartition("day").write.mode("append").partitionBy("day", "seg").parquet(path)
    return _ledger(rows.sparkSession, path).written(name, label)


def append_parts(parts: DataFrame, path: str, batch: int | None = None) -> None:
    """Add parts to the stored rollup, by day. The parts of a stream's batch bear its number and take the
    place of what the same batch wrote before."""
    label = None if batch is None else f"batch {batch}"
    made, ledger = _write(parts, path, label), _ledger(parts.sparkSession, path)
    before = [s for s in ledger.live() if label is not None and s.label == label]
    ledger.commit(made, before)


def stored(spark: SparkSession, path: str) -> DataFrame:
    """The rollup as read: all parts that count at this moment, and exact days, summed up by key."""
    rows = _ledger(spark, path).read()
    if rows is None:
        raise FileNotFoundError(f"there is no rollup at {path}")
    return merged(rows)


def overwrite_day(raw: DataFrame, path: str) -> tuple[str, str] | None:
    """Put the exact rows of the previous day in place of its parts in the stored rollup; returns the day.

    A day whose events are all gone loses its parts. Parts that come while the exact ones are made stay
    beside them, until the next time; so do readers with what they have bound to.
    """
    spark, day = raw.sparkSession, day_before(raw)
    if day is None:
        return None
    ledger = _ledger(spark, path)
    old = [s for s in ledger.live() if s.slice == day[0][:10]]
    made = _write(exact_day(raw, day), path)
    return day if ledger.commit(made, old) else None


def upsert(totals: DataFrame, path: str, batch: int) -> None:
    """Put whole sums, such as a streaming aggregate in update mode gives, in place of the stored ones of
    their keys; days without any stay as they are. A batch that is given again changes nothing.

    For days that are kept in this way only: parts that append_parts adds are summed up instead.
    """
    spark, label = totals.sparkSession, f"totals {batch}"
    ledger, fresh_totals = _ledger(spark, path), totals.select(*KEY, "revenue_eur", "sessions").persist()
    try:
        days = {r[0] for r in fresh_totals.select(F.date_format("hour", "yyyy-MM-dd")).distinct().collect()}  # days of one batch
        held = [s for s in ledger.live() if s.slice in days]
        if not days or any(s.label == label for s in ledger.live()):
            return
        before = ledger.read(held)
        rows = fresh_totals
        if before is not None:
            same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in KEY]
            stay = before.alias("a").join(fresh_totals.alias("b"), reduce(lambda x, y: x & y, same), "left_anti").select(*KEY, "revenue_eur", "sessions")
            rows = rows.unionByName(stay)
        ledger.commit(_write(rows, path, label), held)
    finally:
        fresh_totals.unpersist()


def start_totals(clean: DataFrame, path: str, checkpoint: str, **trigger) -> StreamingQuery:
    """The rollup as a streaming aggregate of clean rows: each batch's changed sums take the place of the stored ones.

    Copies count as often as they come, as in partial(). State is a row a key, without a watermark: late rows
    change their hour whenever they come.
    """
    sums = partial(clean)
    return sums.writeStream.outputMode("update").foreachBatch(lambda totals, batch: upsert(totals, path, batch)).option("checkpointLocation", checkpoint).queryName("totals").trigger(**(trigger or {"processingTime": "1 second"})).start()
