"""WARC archives: writing, normalising monolithic gzip files, and reading by offset.

``write_archives`` writes each task's records as one gzip stream (a monolithic file, as some
crawlers leave them). ``normalise`` inflates such a stream once, rewrites every record as a gzip
member of its own and writes a sidecar index of offsets beside it. ``read_archives`` opens single
records through that index.

Files go to a folder of the shared store under a name of the task's attempt and are renamed when
complete; a repeated task writes the same bytes, so the rename may replace an earlier copy.
"""

import hashlib
import json
import re
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm.common import partitions, remove, shared_folder, tidy

#: Records with shorter payloads are never revisits.
LEAST_REVISIT = 100
#: A fixed date: the archives depend on their input alone.
DATE = "1970-01-01T00:00:00Z"
_CHUNK = 1 << 18


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def _clean(value: str) -> str:
    """A header value on one line."""
    return re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(key, url, payload: bytes, digest: str, refers_to=None) -> bytes:
    """One WARC record: a response with its payload, or a revisit that names the response.

    Both carry the digest and length of the full payload.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{json.dumps(key)}>",
        f"WARC-Date: {DATE}",
        *([f"WARC-Target-URI: {_clean(url)}"] if url is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <urn:page:{json.dumps(refers_to)}>", "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"] if refers_to is not None else []),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers (names in lower case) and block of a record."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    headers = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:])}
    return headers, rest[: int(headers["content-length"])]


def records(chunks):
    """Split an inflated stream, given in chunks, into whole records; holds one record at a time."""
    buffer = bytearray()
    chunks = iter(chunks)

    def more() -> bool:
        x = next(chunks, None)
        buffer.extend(x or b"")
        return x is not None

    while True:
        while (end := buffer.find(b"\r\n\r\n")) < 0:
            if not more():
                if buffer.strip():
                    raise ValueError("the stream ends within a record's head")
                return
        length = int(re.search(rb"(?im)^content-length:\s*(\d+)", bytes(buffer[:end]))[1])
        whole = end + 4 + length + 4
        while len(buffer) < whole:
            if not more():
                raise ValueError("the stream ends within a record")
        yield bytes(buffer[:whole])
        del buffer[:whole]


def inflate(stream):
    """Chunks of a gzip file of one member or several."""
    z = zlib.decompressobj(31)
    while data := stream.read(_CHUNK):
        while data:
            yield z.decompress(data)
            data = z.unused_data
            if z.eof:
                z = zlib.decompressobj(31)


def member(data: bytes) -> bytes:
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Whole:
    """A file that appears under its name only when complete."""

    def __init__(self, uri: str):
        self.store, self.path = open_store(uri)
        self.part = f"{self.path}.{TaskContext.get().taskAttemptId()}.tmp"

    def __enter__(self):
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.file = self.store.open_output_stream(self.part)
        return self

    def write(self, data: bytes) -> None:
        self.file.write(data)

    def __exit__(self, kind, *_):
        self.file.close()
        if kind is None:
            self.store.move(self.part, self.path)
        else:
            self.store.delete_file(self.part)


def write_archives(pages: DataFrame, folder: str) -> DataFrame:
    """Write (key, url, payload binary, digest, refers_to) rows; returns one row (path, n) a file.

    Every row is a record, rows that repeat a key too; a task without rows writes a file without records,
    and an empty table such files only. A null url has no header of its own.
    """

    def run(batches):
        path, n, z = f"{folder}/part-{TaskContext.get().partitionId():06d}.warc.gz", 0, zlib.compressobj(1, zlib.DEFLATED, 31)
        with _Whole(path) as f:
            for b in batches:
                for row in zip(*(b[c].to_pylist() for c in ("key", "url", "payload", "digest", "refers_to")), strict=True):
                    f.write(z.compress(record(*row)))
                    n += 1
            f.write(z.flush())
        yield pa.RecordBatch.from_pydict({"path": [path], "n": pa.array([n], pa.int64())})

    return pages.mapInArrow(run, "path string, n long")


def normalise(files: DataFrame, folder: str) -> DataFrame:
    """Rewrite each monolithic file of (path) rows with a member a record; returns (path, n).

    The sidecar, beside the new file, has a line of JSON a record: its id, offset and length.
    A file without records becomes an empty file with an empty sidecar.
    """

    def run(batches):
        for b in batches:
            for source in b["path"].to_pylist():
                path = f"{folder}/{source.rpartition('/')[2]}"
                store, where = open_store(source)
                at = n = 0
                with _Whole(path) as out, _Whole(path + ".idx") as index, store.open_input_stream(where, compression=None) as f:
                    for data in records(inflate(f)):
                        packed = member(data)
                        out.write(packed)
                        index.write((json.dumps({"id": parse(data)[0]["warc-record-id"], "offset": at, "length": len(packed)}) + "\n").encode())
                        at, n = at + len(packed), n + 1
                yield pa.RecordBatch.from_pydict({"path": [path], "n": pa.array([n], pa.int64())})

    return files.mapInArrow(run, "path string, n long")


def read_record(stream, offset: int, length: int) -> tuple[dict[str, str], bytes]:
    stream.seek(offset)
    return parse(zlib.decompress(stream.read(length), 31))


READ = "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
_READ = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary())])


def _page(uri: str):
    return json.loads(uri[len("<urn:page:") : -1])


def read_archives(files: DataFrame) -> DataFrame:
    """A row for each record of normalised archives, opened one by one through their sidecars.

    A response's digest and length are those of the payload that was read (a digest that differs
    from the header's is an error); a revisit has those its headers state, and no payload. Records that share a
    key each come back; files without records, and no files, give no rows.
    """

    def run(batches):
        for b in batches:
            for path in b["path"].to_pylist():
                store, where = open_store(path)
                with store.open_input_file(where + ".idx") as f:
                    entries = [json.loads(x) for x in f.read().splitlines()]
                rows, size = [], 0
                with store.open_input_file(where) as f:
                    for e in entries:
                        headers, block = read_record(f, e["offset"], e["length"])
                        http, _, payload = block.partition(b"\r\n\r\n")
                        stated, kind = headers["warc-payload-digest"].partition(":")[2], headers["warc-type"]
                        n = int(re.search(rb"(?i)content-length:\s*(\d+)", http)[1])
                        if headers["warc-record-id"] != e["id"] or kind == "response" and (len(payload) != n or hashlib.sha256(payload).hexdigest() != stated):
                            raise ValueError(f"{path}: the record at {e['offset']} is not what its headers say")
                        to = headers.get("warc-refers-to")
                        rows.append((_page(e["id"]), headers.get("warc-target-uri"), n, stated, kind, _page(to) if to else None, payload if kind == "response" else None))
                        size += len(payload)
                        if size > 1 << 22:
                            yield _batch(rows)
                            rows, size = [], 0
                if rows:
                    yield _batch(rows)

    return files.select("path").mapInArrow(run, READ)


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _READ, strict=True)], schema=_READ)


def archive(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT) -> DataFrame:
    """Write pages as archives, normalise them, and return (path, n) of the normalised files.

    Of records with equal payloads of at least least bytes the one with the smallest key is the
    response (rows that repeat that key too); null html is an empty payload; a null key never is
    the smallest unless all are null; an empty table gives no files. Only digests with more than one
    record are joined back; adaptive execution splits a payload that a third of the pages share.
    """
    spark = pages.sparkSession
    rows = pages.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{url}`").cast("string").alias("url"), F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    many = rows.where(F.octet_length("payload") >= least).groupBy("digest").agg(F.count("*").alias("n"), F.min("key").alias("first")).where("n > 1 and first is not null").select("digest", "first")
    joined = rows.join(many, "digest", "left").withColumn("refers_to", F.when(~F.col("key").eqNullSafe(F.col("first")), F.col("first")))
    raw, out = shared_folder(spark), shared_folder(spark)
    listed, made = shared_folder(spark), shared_folder(spark)
    with tidy(spark):  # the exchanged payloads are in the archives then
        write_archives(joined.select("key", "url", "payload", "digest", "refers_to"), raw).write.parquet(listed)
    files = spark.read.schema("path string, n long").parquet(listed).where("n > 0")
    normalise(files.repartition(partitions(spark), "path"), out).write.parquet(made)
    remove(spark, raw)
    remove(spark, listed)
    return spark.read.schema("path string, n long").parquet(made)


def round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Every record of pages, read back from its archive: a row for each row of pages, repeated and null keys
    too; an empty table gives none."""
    return read_archives(archive(pages).repartition(partitions(spark), "path"))


ORACLE = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, sha256(b) AS h FROM p),
f AS (SELECT page_id, n, h, CASE WHEN n >= 100 THEN min(page_id) OVER (PARTITION BY h) ELSE page_id END AS m FROM d)
SELECT page_id, n::BIGINT AS payload_bytes, h AS payload_digest,
       CASE WHEN m = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN m <> page_id THEN m END AS refers_to FROM f
"""
