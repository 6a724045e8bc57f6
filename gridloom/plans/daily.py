"""The daily run: five tasks in a chain, each of which must pass before the next begins.

1. freshness: the newest row was ingested lately;
2. compaction of the calendar month before now's;
3. the previous day's revenue, recomputed exactly, takes the place of its parts;
4. drift of each metric between the last two weeks, and the share of dead letters;
5. a report of the months that are past retention (nothing is dropped).

Each task may be run again: compaction of a compact month does nothing, the day's exact rows replace
themselves, and the others only read.
"""

from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.operators import gates, rollup, storage


TASKS = ("freshness", "compact", "reconcile", "quality", "retention")


@dataclass
class Daily:
    """Where the tables lie, and the clock. done collects (task, what it found)."""

    spark: SparkSession
    landing: str
    revenue: str
    dead: DataFrame
    now: datetime
    done: list[tuple[str, str]] = field(default_factory=list)

    def _now(self):
        return F.lit(f"{self.now:%Y-%m-%d %H:%M:%S.%f}").cast("timestamp")

    def rows(self) -> DataFrame:
        return storage.scan(self.spark, self.landing)

    def freshness(self) -> str:
        check = gates.freshness(self.rows(), self._now())
        gates.require(check, "freshness")
        return str(check.first()["age_s"])

    def compact(self) -> str:
        month = storage.closed_month(self.now)
        done = storage.compact(self.spark, self.landing, month)
        storage.vacuum(self.spark, self.landing)  # what was replaced by earlier runs
        return f"{month} {'compacted' if done else 'as it was'}"

    def reconcile(self) -> str:
        day = rollup.overwrite_day(self.rows(), self.revenue)
        return day[0][:10] if day else "no day"

    def quality(self) -> str:
        found = []
        for metric in gates.METRICS:
            check = gates.drift(self.rows(), metric).cache()
            gates.require(check, "drift")
            row = check.first()
            found.append(f"{metric} {round(row['psi'], 6) + 0.0:.6f}" if row else f"{metric} too few")
            check.unpersist()
        # the clean side is the table by month: its bound on ingestion needs no bound on event time
        gates.require(gates.dead_letter_rate(self.dead, self.rows(), self._now()), "dead letters")
        return ", ".join(found)

    def retention(self) -> str:
        old = storage.expired(storage.parts(self.rows()), self.now)
        return " ".join(sorted(str(r["yyyymm"]) for r in old.select("yyyymm").collect())) or "none"  # a row a month

    @property
    def next(self) -> str:
        """The task whose turn it is."""
        return TASKS[len(self.done)]

    def run(self) -> list[tuple[str, str]]:
        """All tasks in order; a gate that does not pass raises GateFailed, and nothing after it runs."""
        while len(self.done) < len(TASKS):
            name = self.next
            self.done.append((name, getattr(self, name)()))
        return self.done
