"""The two consumers of the raw stream, as foreachBatch queries.

The analytics query decodes, validates, flattens, removes duplicates, appends clean rows and dead
letters, and only then marks what it saw: a batch that fails on the way is given again and counts
once. Batches carry their number into the path they write, so that a repeated one replaces itself.
Late rows are never dropped; stale versions are resolved on read. Marks are found again after a
restart, and removed when they are too old to count.

The state query applies events in order of arrival, tries a failed batch once more and then goes
on: it is a view of the present that the next event repairs. It too goes on after a restart from
what it stored, and forgets keys that no event refreshed.
"""

import time
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from gridloom.operators import dedup, flatten, rollup, state, storage, validate, versions
from gridloom.streaming.metrics import LAG_BUCKETS, Metrics, absorb, lag_seconds, spread


@dataclass
class Analytics:
    """One analytics consumer: where it writes, whom it trusts, and what it remembers.

    ``registry`` gives {"stations", "tariffs"}; ``now`` the ingestion time of a batch (a Column).
    Marks are one small file set a batch, in a folder named by the time; the anti-join reads only
    those within the TTL. Optional ways out: ``publish`` gets the clean rows as messages, ``reject``
    the dead letters as messages under their raw keys, ``landing`` is a table by month that clean
    rows are added to, ``revenue`` the stored rollup that each batch adds its parts to. ``most`` is
    the size that closes a batch before its time.
    """

    folder: str
    registry: Callable[[], dict[str, DataFrame]]
    now: Callable[[], object] = F.current_timestamp
    ttl_seconds: int = 120
    metrics: Metrics = field(default_factory=lambda: Metrics("analytics"))
    clock: Callable[[], float] = time.time
    publish: Callable[[DataFrame], None] | None = None
    reject: Callable[[DataFrame], None] | None = None
    landing: str | None = None
    revenue: str | None = None
    most: int | None = None
    _marks: list[tuple[float, int]] | None = None

    def path(self, table: str, batch: int) -> str:
        return f"{self.folder}/{table}/batch={batch}"

    def __call__(self, raw: DataFrame, batch: int) -> None:
        spark, known, began = raw.sparkSession, self.registry(), time.monotonic()
        rows = validate.judged(validate.decode(raw), known["stations"], known["tariffs"]).withColumn("ingested_at", self.now()).persist()
        clean = seen = None
        try:
            valid, rejected = validate.split(rows)
            first = dedup.first_in_batch(valid.withColumn("event_id", F.col("event.event_id")), "event_id", "offset")
            seen = self._seen(spark, batch)
            fresh = first if seen is None else dedup.unseen(first, seen)
            clean = flatten.flatten(fresh, F.col("ingested_at"), F.col("produced_at")).persist()
            # lags are counted while the rows are written: no job of their own
            seen_lags = Observation()
            watched = clean.observe(seen_lags, *spread(lag_seconds("produced_at", "ingested_at"), "transport_s"), *spread(lag_seconds("timestamp", "ingested_at"), "ingestion_s"))
            watched.write.mode("overwrite").parquet(self.path("clean", batch))
            validate.dead_letters(rejected, ingested_at=F.col("ingested_at")).write.mode("overwrite").parquet(self.path("dead_letter", batch))
            if self.publish:
                self.publish(flatten.to_json(clean))
            if self.reject:
                self.reject(validate.dead_letter_messages(rejected, ingested_at=F.col("ingested_at")))
            if self.landing:
                storage.append(clean, self.landing)  # a batch that is given again adds versions, which reads resolve
            if self.revenue:
                rollup.append_parts(rollup.partial(clean), self.revenue, batch)
            self._mark(clean, batch)
            self.metrics.count_batch(rows, clean, self.most)
            for name in ("transport_s", "ingestion_s"):
                absorb(self.metrics, seen_lags.get, name)
            self.metrics.observe("flush_s", time.monotonic() - began, LAG_BUCKETS)
        finally:
            for df in (rows, clean, seen):
                if df is not None:
                    df.unpersist()

    def _mark_path(self, at: float, batch: int) -> str:
        return f"{self.folder}/seen/at={int(at * 1000)}_batch={batch}"

    def marks(self, spark: SparkSession) -> list[tuple[float, int]]:
        """Time and batch of all complete marks; after a restart, those of the folder."""
        if self._marks is None:
            store, of = versions.store_of(spark, self.folder)
            root, found = f"{self.folder}/seen", []
            for f in store.listStatus(of(root)) if store.exists(of(root)) else ():
                name = f.getPath().getName()
                if store.exists(of(f"{root}/{name}/_SUCCESS")):
                    at, _, batch = name.removeprefix("at=").partition("_batch=")
                    found.append((int(at) / 1000, int(batch)))
            self._marks = sorted(found)
        return self._marks

    def _seen(self, spark: SparkSession, batch: int) -> DataFrame | None:
        """The ids marked within the TTL; a memory that cannot be read lets duplicates through, which reads resolve."""
        # what this very batch marked when it ran before is not seen: it is about to be replaced
        lately = [self._mark_path(at, b) for at, b in self.marks(spark) if b != batch and self.clock() - at <= self.ttl_seconds]
        if not lately:
            return None
        try:
            seen = spark.read.schema("event_id string").parquet(*lately).distinct().persist()
            seen.count()  # a failure to read shows here, not in the middle of the batch
            return seen
        except Exception:
            self.metrics.add("dedup_errors", 1)
            return None

    def _mark(self, clean: DataFrame, batch: int) -> None:
        spark, now = clean.sparkSession, int(self.clock() * 1000) / 1000
        clean.select("event_id").write.mode("overwrite").parquet(self._mark_path(now, batch))
        store, of = versions.store_of(spark, self.folder)
        kept = [(now, batch)]
        for at, b in self.marks(spark):
            if (at, b) == (now, batch):
                continue
            if b == batch or now - at > self.ttl_seconds:
                store.delete(of(self._mark_path(at, b)), True)
            else:
                kept.append((at, b))
        self._marks = sorted(kept)


def start_analytics(raw: DataFrame, consumer: Analytics, checkpoint: str, **trigger) -> StreamingQuery:
    return raw.writeStream.foreachBatch(consumer).option("checkpointLocation", checkpoint).queryName("analytics").trigger(**(trigger or {"processingTime": "1 second"})).start()


@dataclass
class Realtime:
    """The state consumer: merges each batch into the stored state, one version of it a batch.

    A batch starts from the newest complete version before it, so that one that is given again, or
    the first after a restart, finds what was known. ``now`` is the time at which events apply; a
    key that none refreshed for the TTL is forgotten, and then any event applies to it. A version stays
    for keep_seconds after the next one, for those who read it. Every batch
    writes all live keys: for fleets whose state is large against a batch, state.streaming_state
    keeps it in the engine's own store.
    """

    folder: str
    registry: Callable[[], dict[str, DataFrame]]
    retry_seconds: float = 0.05
    metrics: Metrics = field(default_factory=lambda: Metrics("realtime"))
    now: Callable[[], Column] = F.current_timestamp
    ttl_seconds: int = state.TTL_SECONDS
    keep_seconds: float = versions.KEEP_SECONDS

    @property
    def root(self) -> str:
        return f"{self.folder}/state"

    def __call__(self, raw: DataFrame, batch: int) -> None:
        for attempt in (0, 1):
            try:
                self._apply(raw, batch)
                return
            except Exception:
                self.metrics.add("state_errors", 1)
                if attempt == 0:
                    time.sleep(self.retry_seconds)

    def _apply(self, raw: DataFrame, batch: int) -> None:
        known, spark = self.registry(), raw.sparkSession
        rows = validate.judged(validate.decode(raw), known["stations"], known["tariffs"]).persist()
        valid, _ = validate.split(rows)
        fields = state.carried(F.col("event.event_type"), F.coalesce("event.status", F.lit("")), F.col("event.meter").isNotNull(), F.coalesce("event.meter.power_kw", F.lit(0.0)), F.coalesce("event.meter.soc_percent", F.lit(0)), F.coalesce("event.session_id", F.lit("")))
        key = state.state_key(F.col("event.event_type"), F.col("event.station_id"), F.col("event.connector_id"))
        names = ("status", "power", "soc", "session")
        news = valid.select(key.alias("key"), F.col("offset").alias("arrival"), F.col("event_time").alias("ts"), *[c.alias(n) for n, c in fields.items()], self.now().alias("at"), "produced_at")
        base = versions.newest(spark, self.root, below=batch)
        if base is not None:
            # the stored state is an event that came before all of the batch; what expired is not there
            held = state.live(spark.read.parquet(versions.place(self.root, base)), self.now(), self.ttl_seconds)
            news = news.unionByName(held.select("key", F.lit(-1).cast("long").alias("arrival"), F.col("last_seen").alias("ts"), *names, F.col("applied_at").alias("at"), F.lit(None).cast("timestamp").alias("produced_at")))
        marked = state.with_applied(news).persist()
        try:
            last = lambda c: F.max_by(c, F.when(F.col(c).isNotNull(), F.col("arrival"))).alias(c)
            # the time of what is held stays where nothing new applied
            now = marked.where("applied").groupBy("key").agg(F.max("ts").alias("last_seen"), *[last(c) for c in names], F.max("at").alias("applied_at"))
            now.write.mode("overwrite").parquet(versions.place(self.root, batch))
            versions.complete(spark, self.root, batch, self.keep_seconds)
            lag = F.when(F.col("applied"), F.unix_millis("at") - F.unix_millis("produced_at")) / 1000
            counts = marked.where("arrival >= 0").agg(F.count_if("applied").alias("a"), F.count_if(~F.col("applied")).alias("s"), F.max(lag).alias("lag"), *spread(lag, "state_s")).first()
            self.metrics.add("state_applied", counts["a"])
            self.metrics.add("state_stale_skipped", counts["s"])
            self.metrics.add("invalid_skipped", rows.where("rule IS NOT NULL").count())
            absorb(self.metrics, counts.asDict(), "state_s")
            if counts["lag"] is not None:
                self.metrics.set("produce_to_state_s", counts["lag"])
        finally:
            marked.unpersist()
            rows.unpersist()

    def read(self, spark: SparkSession) -> DataFrame:
        """The newest complete state, without the keys that have expired by now."""
        return state.live(spark.read.parquet(versions.place(self.root, versions.newest(spark, self.root))), self.now(), self.ttl_seconds)


def start_realtime(raw: DataFrame, consumer: Realtime, checkpoint: str, **trigger) -> StreamingQuery:
    return raw.writeStream.foreachBatch(consumer).option("checkpointLocation", checkpoint).queryName("realtime").trigger(**(trigger or {"processingTime": "25 milliseconds"})).start()


def drain(query: StreamingQuery, seconds: float = 30) -> None:
    """Let the batch in hand finish, then stop."""
    end = time.monotonic() + seconds
    while query.status["isTriggerActive"] and time.monotonic() < end:
        time.sleep(0.05)
    query.stop()


def clean_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/clean").drop("batch")


def dead_letter_rows(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/dead_letter").drop("batch")


def lags(clean: DataFrame) -> DataFrame:
    """transport_s and ingestion_s of clean rows: producer to ingestion, and event to ingestion."""
    return clean.select(lag_seconds("produced_at", "ingested_at").alias("transport_s"), lag_seconds("timestamp", "ingested_at").alias("ingestion_s"))
