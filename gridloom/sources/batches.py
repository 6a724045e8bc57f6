"""A stream source whose batches are closed by size or by time: N rows, or what came within T milliseconds.

It reads a folder of Parquet files of messages that others add to. Each file gets its place in an index
when it is first seen; offsets count rows along the index, so that a batch ends within a file where N says so.
The index and the engine's own log of offsets lie below the query's checkpoint: a restarted query goes on
at the row where it was, and a batch that is given again has the same rows.

A broker has the same by options of its own connector (see streams.from_broker).
"""

import json
import re
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from gridloom.sources.streams import RAW

NAME = "size_or_time"


class Rows(InputPartition):
    """Some rows of one file, in order."""

    def __init__(self, file: str, first: int, end: int):
        self.file, self.first, self.end = file, first, end


def _store(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri if "://" in uri or uri.startswith("file:") else f"file://{uri}")


class Reader(DataSourceStreamReader):
    """Decides where batches end. Lives in one process at the driver, for one query."""

    def __init__(self, folder: str, checkpoint: str, rows: int, millis: int):
        self.folder, self.checkpoint, self.rows, self.millis = folder, checkpoint, rows, millis
        #: (file, rows) in the order of discovery, and the row at which the last batch ended.
        self.index: list[tuple[str, int]] | None = None
        self.last = 0

    def initialOffset(self) -> dict:
        return {"rows": 0, "closed": ""}

    def _load(self) -> None:
        if self.index is not None:
            return
        store, root = _store(self.checkpoint)
        from pyarrow import fs

        path = f"{root}/size_or_time_index"
        self.index = []
        if store.get_file_info(path).type == fs.FileType.File:
            with store.open_input_stream(path) as f:
                self.index = [tuple(x) for x in json.loads(f.read())]
        logged = [i.path for i in store.get_file_info(fs.FileSelector(f"{root}/offsets", allow_not_found=True)) if i.base_name.isdigit()]
        if logged:
            with store.open_input_stream(max(logged, key=lambda p: int(p.rpartition("/")[2]))) as f:
                line = f.read().decode().strip().split("\n")[-1]
            self.last = json.loads(line)["rows"] if line.startswith("{") and "rows" in json.loads(line) else 0

    def _discover(self) -> None:
        """Give files that are new their place; the index is written before any of their rows is offered."""
        import pyarrow.parquet as pq
        from pyarrow import fs

        store, root = _store(self.folder)
        known = {f for f, _ in self.index}
        found = [i for i in store.get_file_info(fs.FileSelector(root, recursive=True, allow_not_found=True)) if i.type == fs.FileType.File and i.path.endswith(".parquet") and not any(x[:1] in "._" for x in i.path[len(root) :].split("/") if x)]
        new = sorted((i for i in found if i.path not in known), key=lambda i: (i.mtime_ns or 0, i.path))
        if not new:
            return
        for i in new:
            with store.open_input_file(i.path) as f:
                self.index.append((i.path, pq.ParquetFile(f).metadata.num_rows))
        keep, where = _store(self.checkpoint)
        keep.create_dir(where, recursive=True)
        with keep.open_output_stream(f"{where}/size_or_time_index.tmp") as f:
            f.write(json.dumps(self.index).encode())
        keep.move(f"{where}/size_or_time_index.tmp", f"{where}/size_or_time_index")

    def latestOffset(self) -> dict:
        """Wait until there are enough rows or the time is over; tells which closed the batch."""
        self._load()
        over = time.monotonic() + self.millis / 1000
        while True:
            self._discover()
            waiting = sum(n for _, n in self.index) - self.last
            if waiting >= self.rows:
                self.last += self.rows
                return {"rows": self.last, "closed": "size"}
            if time.monotonic() >= over:
                self.last += waiting
                return {"rows": self.last, "closed": "time"} if waiting else {"rows": self.last, "closed": self.closed}
            time.sleep(min(0.005, self.millis / 1000))

    #: A batch without rows is none: the offset stays the one before, to the letter.
    closed = ""

    def partitions(self, start: dict, end: dict) -> list[Rows]:
        self._load()
        self.last, self.closed = max(self.last, end["rows"]), end["closed"]
        out, at = [], 0
        for file, n in self.index:
            a, b = max(start["rows"], at), min(end["rows"], at + n)
            if a < b:
                out.append(Rows(file, a - at, b - at))
            at += n
        return out

    def read(self, partition: Rows):
        import pyarrow as pa
        import pyarrow.parquet as pq

        kinds = {"produced_at": pa.timestamp("us", "UTC"), "offset": pa.int64()}
        shape = pa.schema([(c.name, kinds.get(c.name, pa.string())) for c in RAW])
        store, _ = _store(self.folder)
        at = 0
        with store.open_input_file(partition.file) as f:
            for batch in pq.ParquetFile(f).iter_batches(columns=[c.name for c in RAW]):
                a, b = max(partition.first, at), min(partition.end, at + batch.num_rows)
                if a < b:
                    part = pa.Table.from_batches([batch.slice(a - at, b - a)])
                    if part.schema.field("produced_at").type.tz is None:  # instants in an older form
                        part = part.set_column(part.schema.get_field_index("produced_at"), "produced_at", part["produced_at"].cast(pa.timestamp("us")))
                    yield from part.select(shape.names).cast(shape).to_batches()
                at += batch.num_rows
                if at >= partition.end:
                    return

    def commit(self, end: dict) -> None:
        pass


class SizeOrTime(DataSource):
    @classmethod
    def name(cls) -> str:
        return NAME

    def schema(self):
        return RAW

    def streamReader(self, schema) -> Reader:
        return Reader(self.options["folder"], self.options["checkpoint"], int(self.options.get("rows", "750")), int(self.options.get("millis", "25")))


def from_folder(spark: SparkSession, folder: str, checkpoint: str, rows: int = 750, millis: int = 25) -> DataFrame:
    """A stream of RAW rows in batches of rows, or of what came within millis; checkpoint is that of its query."""
    spark.dataSource.register(SizeOrTime)
    return spark.readStream.format(NAME).option("folder", folder).option("checkpoint", checkpoint).option("rows", rows).option("millis", millis).load()


def closed_by(progress) -> str:
    """size or time: what closed the batch of a query's progress."""
    told = progress["sources"][0]["endOffset"]
    # the engine gives an offset as text or as what that says
    found = re.search(r"closed\W+(\w*)", told if isinstance(told, str) else json.dumps(told))
    return found[1] if found else ""
