"""The registry of stations, connectors and tariffs: loading, retrying, refreshing, seeding, checking."""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.functions.schema import TARIFF, TARIFFS
from gridloom.operators import versions

TABLES = ("stations", "connectors", "tariffs")


def from_parquet(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """The tables of the newest complete version that seed() wrote; all of one version."""
    version = versions.newest(spark, folder)
    if version is None:
        raise FileNotFoundError(f"{folder} has no complete registry")
    return {t: spark.read.parquet(f"{versions.place(folder, version)}/{t}") for t in TABLES}


def from_jdbc(spark: SparkSession, url: str, properties: dict[str, str]) -> dict[str, DataFrame]:
    """The same tables of a relational database; its driver must be on the class path."""
    return {t: spark.read.jdbc(url, t, properties=properties) for t in TABLES}


def tariff_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, n, float(p), float(m)) for i, n, p, m in TARIFFS], TARIFF)


def seed(tables: dict[str, DataFrame], folder: str) -> int:
    """Replace all tables at once: a new version beside the old ones, which counts when it is whole."""
    spark = next(iter(tables.values())).sparkSession
    version = max((v for v, _ in versions.listed(spark, folder)), default=-1) + 1
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{versions.place(folder, version)}/{name}")
    versions.complete(spark, folder, version)
    return version


def load_until_ready(load: Callable[[], dict[str, DataFrame]], seconds: float = 90, pause: float = 2) -> dict[str, DataFrame]:
    """The first load that has stations; other failures are tried again until time is up."""
    end, why = time.monotonic() + seconds, None
    while True:
        try:
            tables = load()
            if tables["stations"].limit(1).count():
                return tables
            why = ValueError("the registry has no stations")
        except Exception as e:  # the store may still be starting
            why = e
        if time.monotonic() >= end:
            raise TimeoutError(f"the registry is not ready after {seconds} s") from why
        time.sleep(pause)


class Snapshot:
    """Tables that are loaded anew when they are older than ``every`` seconds.

    A load that fails or finds no stations leaves the last good tables in place. All tables are
    swapped at once: one batch never sees two registries.
    """

    def __init__(self, load: Callable[[], dict[str, DataFrame]], every: float = 300, clock: Callable[[], float] = time.monotonic):
        self.load, self.every, self.clock = load, every, clock
        self.tables, self.at = load(), clock()

    def get(self) -> dict[str, DataFrame]:
        if self.clock() - self.at >= self.every:
            self.at = self.clock()
            try:
                tables = self.load()
                if tables["stations"].limit(1).count():
                    self.tables = tables
            except Exception:  # keep what is known
                pass
        return self.tables


def counts(tables: dict[str, DataFrame]) -> DataFrame:
    """name, n for each table."""
    from functools import reduce

    return reduce(DataFrame.unionByName, [df.agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n") for name, df in tables.items()])


def orphans(child: DataFrame, parent: DataFrame, key: str) -> DataFrame:
    """Rows of child without a row of parent: none if the foreign key holds."""
    return child.join(parent.select(key).distinct(), key, "left_anti")


def repeated_keys(table: DataFrame, *key: str) -> DataFrame:
    """Keys with more than one row: none if they are primary."""
    return table.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
