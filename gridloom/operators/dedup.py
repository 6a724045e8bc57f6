"""Layers of duplicate removal: by version on read, within a batch, against what was seen, and in streams."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.schema import VERSION_KEY


def latest_version(events: DataFrame, key=VERSION_KEY, version: str = "ingested_at", ties: tuple[str, ...] = ("produced_at",)) -> DataFrame:
    """One row for each key: the last ingested, of those the last produced (where that is stored).

    Rows that agree in all of these are deliveries of one message, and any of them serves. Only the
    key, these two and what the caller goes on to use are read and shuffled. Ranking stops at one
    row a key, which Spark applies before the shuffle as well.
    """
    order = [F.col(c).desc() for c in (version, *ties) if c in events.columns]
    w = Window.partitionBy(*key).orderBy(*order)
    return events.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def first_in_batch(events: DataFrame, key: str = "event_id", arrival: str = "offset") -> DataFrame:
    """Of the rows of a batch with one key, the first to arrive."""
    w = Window.partitionBy(key).orderBy(arrival)
    return events.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")


def unseen(events: DataFrame, seen: DataFrame, key: str = "event_id", now: Column | None = None, ttl_seconds: int = 120) -> DataFrame:
    """events whose key isn't among seen (key, marked_at); marks older than the TTL no longer count."""
    live = seen if now is None else seen.where(F.col("marked_at") > now - F.expr(f"INTERVAL {ttl_seconds} SECONDS"))
    return events.join(live.select(key).distinct(), key, "left_anti")


def first_in_state(events: DataFrame, key: str = "event_id", arrival: str = "offset", ttl_seconds: int | None = None) -> DataFrame:
    """A stream's first row of each key, by what the engine's store remembers: an alternative to unseen() and
    marks in files, which drops the same rows.

    The store holds a key and nothing else. With a TTL, which needs a query that runs on, a key is forgotten
    so long after it was first seen, by processing time, and its next row passes. Late rows are not dropped; null keys
    are one key. State survives a restart with the query's checkpoint.
    """
    import pandas as pd
    from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

    class First(StatefulProcessor):
        def init(self, handle: StatefulProcessorHandle) -> None:
            extra = {} if ttl_seconds is None else {"ttlDurationMs": ttl_seconds * 1000}
            self.seen = handle.getValueState("seen", "seen boolean", **extra)

        def handleInputRows(self, key, batches, timer_values):
            if self.seen.exists():
                return
            rows = pd.concat(list(batches), ignore_index=True)
            self.seen.update((True,))
            yield rows.iloc[[rows[arrival].argmin()]]

        def close(self) -> None:
            pass

    return events.groupBy(key).transformWithStateInPandas(First(), events.schema, "Append", "None" if ttl_seconds is None else "ProcessingTime")


def within_watermark(events: DataFrame, key: str = "event_id", time: str = "timestamp", delay: str = "120 seconds") -> DataFrame:
    """A load-shedding variant for streams. It drops late rows, so the stored path never uses it."""
    return events.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def audit(events: DataFrame, key: str = "event_id") -> DataFrame:
    """Rows, distinct keys and the difference."""
    both = events.agg(F.count("*").alias("total_rows"), F.count_distinct(key).alias("unique_events"))
    return both.withColumn("duplicates", F.col("total_rows") - F.col("unique_events"))
