"""What the corpus operators share: staging through the shared folder, and access to it from Python workers."""

import ctypes
import gc
import os
import tempfile
from contextlib import contextmanager
from contextvars import ContextVar
from functools import wraps
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space that separates words, as a character class for Java, Python and RE2 patterns.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir, which all executors see.

    Where no session setting names one, a temporary folder serves if driver and executors are one
    process (tests, single machines); on a cluster that is an error, as each executor would write
    to a disk of its own.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="gridloom-")
        spark.conf.set("spark.checkpoint.dir", root)
    if "://" not in root and not root.startswith("file:"):
        root = "file://" + os.path.abspath(root)
    return f"{root.rstrip('/')}/gridloom-{uuid.uuid4().hex}"


#: Folders that stage() wrote, for each staged_folders() block that this thread is in.
_open: ContextVar[tuple[list[str], ...]] = ContextVar("staged", default=())


@contextmanager
def staged_folders():
    """A list of all that stage() writes within the block, for callers that materialise what comes of
    it and then remove the rest."""
    made: list[str] = []
    token = _open.set((*_open.get(), made))
    try:
        yield made
    finally:
        _open.reset(token)


#: The engine's switch for removing a query's shuffle files when it ends, not when its plan is collected.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def tidy(spark: SparkSession):
    """Writes within the block leave no shuffle files."""
    before = spark.conf.get(TIDY, "false")
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.set(TIDY, before)


def stage(df: DataFrame) -> DataFrame:
    """Write df below the shared folder and read it back: the lineage ends there, and a lost
    executor costs no recomputation of what came before."""
    spark = df.sparkSession
    path = shared_folder(spark)
    with tidy(spark):
        df.write.parquet(path)
    for made in _open.get():
        made.append(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._staged = path
    return out


def release(*staged: DataFrame) -> None:
    """Delete what stage() wrote, once nothing reads it any more."""
    for df in staged:
        remove(df.sparkSession, df._staged)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a staged folder that no later job reads."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def lean(run):
    """A batch function that hands free memory back at the end of each task, as workers live on."""

    @wraps(run)
    def trimmed(batches):
        try:
            yield from run(batches)
        finally:
            import pyarrow as pa

            gc.collect()
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):
                pass  # another C library than glibc

    return trimmed


def few(batches, rows: int = 1024):
    """The batches in slices of so many rows: what a batch function makes of a slice goes before the next."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def column(name: str) -> Column:
    """The column of this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def numbered(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """df with its columns called c0, c1, ..., so that no name of theirs meets one of ours; and what each
    is called now. toDF(*names) gives the names back."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))]), {c: f"c{k}" for k, c in enumerate(df.columns)}


#: A row's own key, where ids don't tell rows apart (see rows_of).
ROW = "__row"


def repeats(df: DataFrame, key: str = "doc_id") -> bool:
    """Whether rows share a non-null key: a count over the key column alone."""
    return df.select(column(key).alias("k")).where("k IS NOT NULL").groupBy("k").count().where("count > 1").limit(1).count() > 0


def rows_of(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """df with ROW, a number for each row in the order of key (nulls last) and text; written to the
    shared folder, as the numbers must not change between readers. df has no column of that name: its
    own are numbered() where they can be anything."""
    ordered = df.orderBy(F.col(key).cast("long").asc_nulls_last(), F.col(text).cast("string"))
    return stage(ordered.withColumn(ROW, F.monotonically_increasing_id()))


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
