"""Whole new versions beside the old: a folder a version, of which the newest complete one counts.

A version is complete once its marker exists, and a marker appears at once or not at all; whoever
reads meanwhile goes on with the version before. Older versions are removed by age.
"""

import os
import tempfile
import time
import uuid

from pyspark.sql import SparkSession

MARK = "_COMPLETE"


def store_of(spark: SparkSession, path: str):
    """The file system that path lies in, and a function from text to its paths."""
    of = spark._jvm.org.apache.hadoop.fs.Path
    return of(path).getFileSystem(spark._jsc.hadoopConfiguration()), of


def scratch(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir; a temporary one if none is set and all runs in one process."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        master = spark.conf.get("spark.master", "")
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = tempfile.mkdtemp(prefix="gridloom-")
    if "://" not in root and not root.startswith("file:"):
        root = "file://" + os.path.abspath(root)
    return f"{root.rstrip('/')}/gridloom-{uuid.uuid4().hex}"


def place(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def listed(spark: SparkSession, root: str) -> list[tuple[int, bool]]:
    """Number and completeness of each version, in order."""
    store, of = store_of(spark, root)
    found = []
    for f in store.listStatus(of(root)) if store.exists(of(root)) else ():
        name = f.getPath().getName()
        if name.startswith("version="):
            found.append((int(name[len("version=") :]), store.exists(of(f"{root.rstrip('/')}/{name}/{MARK}"))))
    return sorted(found)


def newest(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    """The newest complete version, or the newest below a number."""
    return max((v for v, done in listed(spark, root) if done and (below is None or v < below)), default=None)


#: Seconds that a version stays for its readers after the next one is complete.
KEEP_SECONDS = 60.0


def complete(spark: SparkSession, root: str, version: int, keep_seconds: float = KEEP_SECONDS) -> None:
    """Mark a version as complete, and remove those that nobody can be reading any more: a reader binds to
    the newest, so a version stays for so long after the next one was marked; the one before the newest stays in any
    case, as a batch that is given again starts from it. What was cut off goes, too, once a later version is that old."""
    store, of = store_of(spark, root)
    mark = of(f"{place(root, version)}/{MARK}")
    store.create(mark, True).close()
    now = time.time()
    marked = [(v, store.getFileStatus(of(f"{place(root, v)}/{MARK}")).getModificationTime() / 1000) for v, done in listed(spark, root) if done]
    old = max((v for v, at in [x for x in marked if x[0] <= version][:-1] if now - at >= keep_seconds), default=None)
    for v, _ in listed(spark, root):
        if old is not None and v < old:
            store.delete(of(place(root, v)), True)
