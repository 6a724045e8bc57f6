"""The landing table: by month, bucketed by event, read and replaced by a ledger; compaction, retention.

Files of a month are dealt into buckets by event id, a part of the version key, and sorted by that key.
So versions of one event lie in one bucket, and whoever removes stale ones reads buckets where they lie
instead of shuffling. Event ids are spread evenly whatever a station sends.

Bloom filters on event and session ids, and the sort order, let readers skip row groups. Buckets need a table in the
session's catalog: one is registered for each path, and knows the months and segments that reads have
met; what counts is told by the ledger.
"""

import hashlib
import json
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from gridloom.functions.scalars import year_month
from gridloom.functions.schema import VERSION_KEY
from gridloom.operators.dedup import latest_version
from gridloom.operators.ledger import KEEP_SECONDS, Ledger, Segment, fresh
from gridloom.operators.versions import store_of

RETENTION_MONTHS = 13
#: Buckets of a table, unless it is made with another number; a file each in a month. At a hundred
#: terabytes and thousands of cores, take thousands.
BUCKETS = 8
BUCKET_BY = "event_id"
#: Bytes of a row group: what one skip saves, against what each costs.
ROW_GROUP = 32 << 20
#: Columns with a bloom filter, and how many ids one is made for.
BLOOM, BLOOM_IDS = ("event_id", "session_id"), 200_000


def _ledger(spark: SparkSession, path: str) -> Ledger:
    return Ledger(spark, path, "yyyymm")


def _options(columns: list[str]) -> dict[str, str]:
    """How files are written: codec, row groups, bloom filters and the pages that they rest on."""
    bloom = {f"parquet.bloom.filter.{k}#{c}": v for c in BLOOM if c in columns for k, v in (("enabled", "true"), ("expected.ndv", str(BLOOM_IDS)))}
    return {"compression": "zstd", "parquet.block.size": str(ROW_GROUP), **bloom}


def _table(spark: SparkSession, path: str, schema: StructType | None = None, buckets: int = BUCKETS) -> str:
    """The name under which the session's catalog knows the table at path; registered if it doesn't.

    The table's columns and buckets are kept beside its ledger, so that any session can register it.
    """
    root = path.rstrip("/")
    name = "default.gridloom_" + hashlib.sha256(root.encode()).hexdigest()[:16]
    if spark.catalog.tableExists(name):
        return name
    store, of = store_of(spark, root)
    layout = of(f"{root}/_ledger/layout")
    if not store.exists(layout):
        if schema is None:
            raise FileNotFoundError(f"there is no table at {path}")
        out = store.create(layout, True)
        out.write(bytearray(json.dumps({"schema": schema.jsonValue(), "buckets": buckets}).encode()))
        out.close()
    stream = store.open(layout)
    told = json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    stream.close()
    kept = StructType.fromJson(told["schema"])
    # nulls may come in any column: the catalog is not told otherwise
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    order = ", ".join(c for c in VERSION_KEY if c in kept.names)
    where = store.makeQualified(of(root)).toString()
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, yyyymm INT, seg STRING) USING parquet PARTITIONED BY (yyyymm, seg) CLUSTERED BY ({BUCKET_BY}) SORTED BY ({order}) INTO {told['buckets']} BUCKETS LOCATION '{where}'")
    return name


def _buckets(spark: SparkSession, name: str) -> int:
    return int(next(r["data_type"] for r in spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect() if r["col_name"] == "Num Buckets"))


def _write(rows: DataFrame, path: str, buckets: int = BUCKETS, label: str | None = None) -> list[Segment]:
    """Write rows, which have yyyymm, as new segments of their months. They don't count yet."""
    spark, seg = rows.sparkSession, fresh()
    own = [c for c in rows.columns if c != "yyyymm"]
    name = _table(spark, path, rows.select(*own).schema, buckets)
    n = _buckets(spark, name)
    kept = [f for f in spark.table(name).schema if f.name not in ("yyyymm", "seg")]
    # dealt out as buckets are: a task writes the one file of its bucket in each month
    dealt = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in kept], F.col("yyyymm").cast("int").alias("yyyymm"), F.lit(seg).alias("seg")).repartition(n, BUCKET_BY)
    order = [c for c in VERSION_KEY if c in own]
    dealt.write.mode("append").format("parquet").options(**_options(own)).partitionBy("yyyymm", "seg").bucketBy(n, BUCKET_BY).sortBy(*order).saveAsTable(name)
    return _ledger(spark, path).written(seg, label)


def append(clean: DataFrame, path: str, time: str = "timestamp", buckets: int = BUCKETS) -> None:
    """Add rows to the table; they count all at once."""
    made = _write(clean.withColumn("yyyymm", year_month(F.col(time))), path, buckets)
    _ledger(clean.sparkSession, path).commit(made)


def _bound(spark: SparkSession, path: str, segments: list[Segment]) -> DataFrame:
    """The rows of some segments, with yyyymm: buckets are read where they lie."""
    name, root = _table(spark, path), path.rstrip("/")
    known = {r[0] for r in spark.sql(f"SHOW PARTITIONS {name}").collect()}
    new = [s for s in segments if f"yyyymm={s.slice}/seg={s.name}" not in known]
    store, of = store_of(spark, root)
    if new:
        spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"PARTITION (yyyymm={s.slice}, seg='{s.name}') LOCATION '{store.makeQualified(of(f'{root}/yyyymm={s.slice}/seg={s.name}'))}'" for s in new))
    names = sorted({s.name for s in segments})
    rows = spark.table(name)
    return (rows.where(F.col("seg").isin(names)) if names else rows.limit(0)).drop("seg")


def scan(spark: SparkSession, path: str, since: datetime | None = None, until: datetime | None = None) -> DataFrame:
    """The rows that count at this moment, whatever is replaced later. Bounds on event time prune whole months as well as rows."""
    rows = _bound(spark, path, _ledger(spark, path).live())
    since, until = (None if t is None else f"{t:%Y-%m-%d %H:%M:%S.%f}" for t in (since, until))
    return between(rows, since, until)


def newest(rows: DataFrame, time: str = "timestamp") -> str | None:
    """The newest event time, as text in the session's time zone; None without rows.

    One small job. In a table by month it reads that one column of the last month.
    """
    if "yyyymm" in rows.columns:
        month = rows.agg(F.max("yyyymm")).first()[0]
        rows = rows.where(F.col("yyyymm") == F.lit(month)) if month is not None else rows
    return rows.agg(F.max(time).cast("string")).first()[0]


def between(rows: DataFrame, since: str | None = None, until: str | None = None, time: str = "timestamp", until_open: bool = False) -> DataFrame:
    """Rows within [since, until] (or [since, until)), by literals that reach the scan; in a table by
    month, also by the months they lie in."""
    kind = rows.schema[time].dataType
    if since is not None:
        rows = rows.where(F.col(time) >= F.lit(since).cast(kind))
    if until is not None:
        last = F.lit(until).cast(kind)
        rows = rows.where(F.col(time) < last if until_open else F.col(time) <= last)
    if "yyyymm" in rows.columns:
        for bound, op in ((since, ">="), (until, "<=")):
            if bound is not None:
                rows = rows.where(f"cast(yyyymm AS int) {op} {bound[:4]}{bound[5:7]}")
    return rows


def shifted(rows: DataFrame, at: str, interval: str, time: str = "timestamp") -> str:
    """A time from newest(), moved by an interval such as '- INTERVAL 7 DAYS', as the engine counts."""
    kind = rows.schema[time].dataType.simpleString()
    return rows.sparkSession.range(1).select(F.expr(f"CAST(CAST('{at}' AS {kind}) {interval} AS string)")).first()[0]


def parts(rows: DataFrame) -> DataFrame:
    """yyyymm, files, rows, oldest for each month of a scan."""
    by = rows.select("yyyymm", "timestamp", F.col("_metadata.file_path").alias("file")).groupBy("yyyymm")
    return by.agg(F.count_distinct("file").alias("files"), F.count("*").alias("rows"), F.min("timestamp").alias("oldest"))


def months(raw: DataFrame) -> DataFrame:
    """yyyymm, rows, oldest of rows that are in no table yet."""
    return raw.groupBy(year_month(F.col("timestamp")).alias("yyyymm")).agg(F.count("*").alias("rows"), F.min("timestamp").alias("oldest"))


def closed_month(now: datetime) -> str:
    """The calendar month before now's."""
    return f"{now.year - (now.month == 1)}{(now.month - 2) % 12 + 1:02d}"


def replace_month(spark: SparkSession, path: str, month: str, rows: DataFrame, instead_of: list[Segment]) -> bool:
    """Put rows in place of some segments of a month, which they were made from; segments that came meanwhile
    stay. Readers see the one or the other. False if another writer replaced them first."""
    made = _write(rows.withColumn("yyyymm", F.lit(int(month))), path)
    return _ledger(spark, path).commit(made, instead_of)


def compact(spark: SparkSession, path: str, month: str) -> bool:
    """Rewrite one month with its latest versions only; False if it is one segment already."""
    old = [s for s in _ledger(spark, path).live() if s.slice == month]
    if len(old) < 2:
        return False
    return replace_month(spark, path, month, latest_version(_bound(spark, path, old).drop("yyyymm")), old)


def vacuum(spark: SparkSession, path: str, seconds: float = KEEP_SECONDS) -> int:
    """Delete segments that were replaced so long ago; how many."""
    gone = _ledger(spark, path).vacuum(seconds)
    name = _table(spark, path)
    for folder in gone:
        month, seg = (x.partition("=")[2] for x in folder.split("/")[-2:])
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (yyyymm={month}, seg='{seg}')")
    return len(gone)


def cutoff(now: datetime, months: int = RETENTION_MONTHS) -> datetime:
    """The first of the month so many months before now."""
    n = now.year * 12 + now.month - 1 - months
    return datetime(n // 12, n % 12 + 1, 1)


def expired(listed: DataFrame, now: datetime) -> DataFrame:
    """Months of parts() or months() whose oldest row is past retention. A report: nothing is dropped."""
    return listed.where(F.col("oldest") < F.lit(cutoff(now)).cast("timestamp_ntz"))


def unexpired(rows: DataFrame, now: datetime, months: int = RETENTION_MONTHS) -> DataFrame:
    """Rows within retention, for reads before the months themselves are dropped."""
    return rows.where(F.col("timestamp") + F.expr(f"INTERVAL {months} MONTHS") >= F.lit(now).cast("timestamp_ntz"))


def drop_expired(spark: SparkSession, path: str, now: datetime) -> list[str]:
    """Take out months that ended before retention began; returns them. Their files go by vacuum()."""
    ledger = _ledger(spark, path)
    held = ledger.live()
    newest_of = _bound(spark, path, held).groupBy("yyyymm").agg(F.max("timestamp").alias("newest")).collect()  # a row a month
    gone = sorted(str(r["yyyymm"]) for r in newest_of if r["newest"].replace(tzinfo=None) < cutoff(now))
    if gone:
        ledger.commit([], [s for s in held if s.slice in gone])
    return gone


def write_csv(rows: DataFrame, path: str) -> None:
    """A report's rows (few by its own limit) as one CSV file with a header."""
    rows.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
