"""Counters of the consumers, and the queries that dashboards put to them."""

import json
from collections import Counter
from functools import reduce
from threading import Lock

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

from gridloom.functions.scalars import millis_between
from gridloom.functions.schema import EVENT_TYPES
from gridloom.operators import gates


def lag_seconds(start: str, end: str) -> Column:
    return millis_between(F.col(start), F.col(end)) / 1000.0


class Metrics:
    """Named counts and levels with labels. Batches are counted once what they wrote is complete.

    group, where given, is a label of all of them: which consumer group counts.
    """

    def __init__(self, group: str | None = None):
        self.own = () if group is None else (("group", group),)
        self.counts: Counter = Counter()
        self.levels: dict = {}
        self.spreads: dict = {}
        self._lock = Lock()

    def add(self, name: str, n: int, **labels) -> None:
        with self._lock:
            self.counts[name, tuple(sorted(labels.items()))] += n

    def get(self, name: str, **labels) -> int:
        return self.counts[name, tuple(sorted(labels.items()))]

    def set(self, name: str, value: float, **labels) -> None:
        """A level: the last value counts."""
        with self._lock:
            self.levels[name, tuple(sorted(labels.items()))] = value

    def observe(self, name: str, value: float, bounds: tuple) -> None:
        """One more value of a histogram with fixed upper bounds, the last of them infinite."""
        with self._lock:
            counts, total = self.spreads.setdefault(name, ([0] * (len(bounds) + 1), [0.0]))
            counts[sum(value > b for b in bounds)] += 1
            total[0] += value
            self.spreads[name, "bounds"] = bounds

    def merge(self, name: str, counts: list[int], total: float, bounds: tuple) -> None:
        """Values that were counted elsewhere, by the same bounds: counts of each bucket alone."""
        with self._lock:
            held, so_far = self.spreads.setdefault(name, ([0] * (len(bounds) + 1), [0.0]))
            for k, n in enumerate(counts):
                held[k] += n
            so_far[0] += total
            self.spreads[name, "bounds"] = bounds

    def count_batch(self, judged: DataFrame, clean: DataFrame, most: int | None = None) -> None:
        """Events by type, rejections by rule and reason, clean rows and duplicates, and why the batch
        was closed: by its size, if it has most rows, else by time. Types outside the vocabulary count
        as one, so that what is gathered stays a few rows whatever producers send."""
        fine = total = 0
        kind = F.coalesce("event.event_type", F.lit("unknown"))
        label = F.when(F.col("rule") == "invalid_json", "unknown").when(kind.isin(*EVENT_TYPES, "unknown"), kind).otherwise("other")
        for r in judged.groupBy(label.alias("kind"), "rule").count().collect():
            self.add("events_consumed", r["count"], event_type=r["kind"])
            total += r["count"]
            if r["rule"] is None:
                fine += r["count"]
            else:
                self.add("validation_errors", r["count"], rule=r["rule"])
                self.add("dead_letters", r["count"], reason="invalid_json" if r["rule"] == "invalid_json" else "validation")
        n = clean.count()
        self.add("clean_produced", n)
        self.add("duplicates_dropped", fine - n)
        self.add("batches", 1, reason="size" if most is not None and total >= most else "timer")
        self.set("last_batch_size", total)
        self.observe("batch_size", total, SIZE_BUCKETS)

    def count_sent(self, sent: DataFrame) -> None:
        """Generator counters: messages made, by event type, and repeats among them."""
        kind = F.get_json_object("value", "$.event_type")
        label = F.when(kind.isin(*EVENT_TYPES), kind).otherwise("other")
        for r in sent.groupBy(label.alias("kind")).agg(F.count("*").alias("n"), F.count_distinct("value").alias("d")).collect():  # a row a type
            self.add("events_generated", r["n"], event_type=r["kind"])
            self.add("duplicates_injected", r["n"] - r["d"], event_type=r["kind"])

    def frame(self, spark) -> DataFrame:
        rows = [(n, ",".join(f"{k}={v}" for k, v in (*self.own, *labels)), c) for (n, labels), c in sorted(self.counts.items())]
        return spark.createDataFrame(rows, "name string, labels string, value long")

    def text(self) -> str:
        """All counts and levels in the plain text form that scrapers read."""
        quote = lambda v: str(v).replace("\\", r"\\").replace('"', r"\"").replace("\n", r"\n")
        out: list[str] = []
        with self._lock:
            for kind, values, tail in (("counter", self.counts, "_total"), ("gauge", self.levels, "")):
                named: dict[str, list] = {}
                for (n, labels), v in sorted(values.items()):
                    named.setdefault(n + tail, []).append(((*self.own, *labels), v))
                for n, rows in named.items():
                    out.append(f"# TYPE {n} {kind}")
                    out += [n + ("{" + ",".join(f'{k}="{quote(x)}"' for k, x in labels) + "}" if labels else "") + f" {v}" for labels, v in rows]
            own = "".join(f'{k}="{quote(x)}",' for k, x in self.own)
            only = "{" + own[:-1] + "}" if own else ""
            for name in sorted(k for k in self.spreads if isinstance(k, str)):
                (counts, total), bounds, so_far = self.spreads[name], self.spreads[name, "bounds"], 0
                out.append(f"# TYPE {name} histogram")
                for b, n in zip([*bounds, "+Inf"], counts, strict=True):
                    so_far += n
                    out.append(f'{name}_bucket{{{own}le="{b}"}} {so_far}')
                out += [f"{name}_sum{only} {total[0]}", f"{name}_count{only} {so_far}"]
        return "\n".join(out) + "\n"


def serve(metrics: Metrics, port: int = 0, host: str = "127.0.0.1"):
    """An HTTP server of metrics.text() at /metrics, in a thread of its own; close it with shutdown()."""
    from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
    from threading import Thread

    class Page(BaseHTTPRequestHandler):
        def do_GET(self):
            found = self.path.partition("?")[0] == "/metrics"
            body = metrics.text().encode() if found else b""
            self.send_response(200 if found else 404)
            self.send_header("Content-Type", "text/plain; version=0.0.4; charset=utf-8")
            self.send_header("Content-Length", str(len(body)))
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *_):
            pass

    server = ThreadingHTTPServer((host, port), Page)
    Thread(target=server.serve_forever, daemon=True).start()
    return server


class Progress(StreamingQueryListener):
    """Rows, durations and source offsets of each batch, as the engine reports them."""

    def __init__(self):
        self.batches: list[dict] = []
        self.offsets: dict[str, list[tuple[str, str]]] = {}

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        p = event.progress
        self.batches.append({"name": p.name, "batch": p.batchId, "rows": p.numInputRows, "millis": p.batchDuration})
        self.offsets[p.name] = [(s.endOffset, s.latestOffset) for s in p.sources]

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass

    def lag(self) -> dict[str, int]:
        """Events that each query is behind, over all partitions of sources that report offsets as
        {topic: {partition: offset}}; others count as none."""
        return {name: sum(behind(end, latest) for end, latest in sources) for name, sources in self.offsets.items()}


def behind(end: str | None, latest: str | None) -> int:
    """Events between two offsets in JSON, {topic: {partition: offset}}; never below 0."""
    try:
        done, known = json.loads(end or "{}"), json.loads(latest or "{}")
        return sum(max(0, int(n) - int(done.get(topic, {}).get(part, 0))) for topic, parts in known.items() for part, n in parts.items())
    except (ValueError, AttributeError, TypeError):
        return 0


def consumer_lag(newest: DataFrame, committed: DataFrame) -> DataFrame:
    """grp, lag: events each group is behind, over all partitions; never below 0."""
    joined = committed.join(newest, ["topic", "part"])
    return joined.groupBy("grp").agg(F.sum(F.greatest(F.col("newest") - F.col("committed"), F.lit(0))).alias("lag"))


def rates(samples: DataFrame, label: str, seconds: int = 60) -> DataFrame:
    """label, minute, per_second: growth of a counter within each window; a reset counts from 0."""
    w = Window.partitionBy(label, "instance").orderBy("at")
    step = F.col("value") - F.lag("value").over(w)
    grown = samples.withColumn("grown", F.when(step < 0, F.col("value")).otherwise(F.coalesce(step, F.lit(0))))
    minute = F.window("at", f"{seconds} seconds")["start"]
    return grown.groupBy(label, minute.alias("minute")).agg((F.sum("grown") / seconds).alias("per_second"))


def quantiles(lags: DataFrame, column: str, by: list[str] | None = None, exact: bool = True) -> DataFrame:
    """p50, p95, p99 of a lag column, by group; exact ones hold no group's values in one task."""
    by, cuts = by or [], (0.5, 0.95, 0.99)
    if exact:
        found = gates.exact_quantiles_by(lags, column, by, list(cuts))
        return found.groupBy(*by).agg(*[F.max(F.when(F.col("k") == k, F.col("value"))).alias(f"p{int(q * 100)}") for k, q in enumerate(cuts)])
    return lags.groupBy(*by).agg(*[F.percentile_approx(column, q, 10_000).cast("double").alias(f"p{int(q * 100)}") for q in cuts])


# Upper bounds of the histograms of lags (seconds) and of batch sizes.
LAG_BUCKETS = (0.005, 0.01, 0.025, 0.05, 0.1, 0.25, 0.5, 1, 2.5, 5, 10, 20, 30, 60, 120)
SIZE_BUCKETS = (1, 5, 10, 25, 50, 100, 200, 350, 500, 750, 1000)


def spread(lag: Column, name: str, bounds=LAG_BUCKETS) -> list[Column]:
    """Aggregates that count a column by fixed bounds, and sum it up: for an observation of a write, or beside
    other aggregates. absorb() takes what they gave."""
    edges = [None, *bounds, None]
    fits = [(F.lit(True) if a is None else lag > a) & (F.lit(True) if b is None else lag <= b) for a, b in zip(edges, edges[1:], strict=False)]
    return [F.coalesce(F.sum(lag), F.lit(0.0)).alias(f"{name}_sum"), *[F.count_if(lag.isNotNull() & f).alias(f"{name}_{k}") for k, f in enumerate(fits)]]


def absorb(metrics: Metrics, found: dict, name: str, bounds=LAG_BUCKETS) -> None:
    """Add what the aggregates of spread() gave to a histogram."""
    metrics.merge(name, [int(found[f"{name}_{k}"]) for k in range(len(bounds) + 1)], float(found[f"{name}_sum"]), bounds)


def histogram(rows: DataFrame, column: str, bounds=LAG_BUCKETS) -> DataFrame:
    """le, n: cumulative counts of values up to each bound; the last bound is infinite."""
    at = F.aggregate(F.array(*[F.lit(float(b)) for b in bounds]), F.lit(0), lambda n, b: n + (F.col(column) > b).cast("int"))
    found = rows.where(F.col(column).isNotNull()).groupBy(at.alias("k")).agg(F.count("*").alias("c"))
    spine = rows.sparkSession.createDataFrame([(k, float(b)) for k, b in enumerate([*bounds, float("inf")])], "k int, le double")
    both = F.broadcast(spine).join(F.broadcast(found), "k", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    return both.select("le", F.sum("c").over(Window.orderBy("k")).alias("n"))


def histogram_quantile(buckets: DataFrame, q: float, by: list[str] | None = None) -> DataFrame:
    """by, value: the q-quantile of cumulative counts (le, n), as dashboards estimate it.

    Within the bucket that holds the rank values are taken as evenly spread; the lowest bucket begins
    at 0, unless its bound is not above 0, which is then the value; ranks in the infinite bucket give
    the highest finite bound. Null where nothing was counted. Buckets are few: a window a group.
    """
    by = by or []
    w = Window.partitionBy(*by).orderBy("le") if by else Window.orderBy("le")
    rows = buckets.groupBy(*by, "le").agg(F.sum("n").cast("double").alias("n"))
    rows = rows.withColumn("_below", F.lag("n", 1, 0.0).over(w)).withColumn("_low", F.lag("le").over(w))
    whole = Window.partitionBy(*by) if by else Window.partitionBy()
    rows = rows.withColumn("_rank", F.max("n").over(whole) * q)
    held = rows.where((F.col("n") >= F.col("_rank")) & (F.col("n") > 0))
    low = F.coalesce("_low", F.lit(0.0))
    inside = low + (F.col("le") - low) * (F.col("_rank") - F.col("_below")) / (F.col("n") - F.col("_below"))
    value = F.when(F.col("le") == float("inf"), F.col("_low")).when(F.col("_low").isNull() & (F.col("le") <= 0), F.col("le")).when(F.col("n") == F.col("_below"), F.col("le")).otherwise(inside)
    return held.groupBy(*by).agg(F.min_by(value, F.col("le")).alias("value"))


#: What each panel of the operations dashboard shows: (counter, label) for rates a second over a
#: minute, or (histogram, quantile) over five.
RATE_PANELS = {
    "produced": ("events_generated", "event_type"), "consumed": ("events_consumed", "event_type"), "clean": ("clean_produced", None), "rejected": ("validation_errors", "rule"),
    "dead letters": ("dead_letters", "reason"), "duplicates": ("duplicates_dropped", None), "state applied": ("state_applied", None), "state stale": ("state_stale_skipped", None), "batches": ("batches", "reason"),
}
QUANTILE_PANELS = {"transport lag": ("transport_s", (0.5, 0.95, 0.99)), "ingestion lag": ("ingestion_s", (0.5, 0.95, 0.99)), "state lag": ("state_s", (0.5, 0.95, 0.99)), "batch size": ("batch_size", (0.5, 0.95)), "flush time": ("flush_s", (0.95,))}


def rate_panel(samples: DataFrame, panel: str, seconds: int = 60) -> DataFrame:
    """label, minute, per_second of a panel from samples (name, labels as a map, instance, at, value)."""
    name, label = RATE_PANELS[panel]
    rows = samples.where(F.col("name") == name).withColumn("label", F.col("labels")[label] if label else F.lit(""))
    # a counter is one instance's labels together; its growth is then summed up by the panel's label
    rows = rows.withColumn("instance", F.concat_ws("|", "instance", F.array_sort(F.transform(F.map_entries("labels"), lambda e: F.concat_ws("=", e["key"], e["value"])))))
    return rates(rows, "label", seconds)


def quantile_panel(buckets: DataFrame, panel: str) -> DataFrame:
    """q, value of a panel from grown bucket counts (name, le, n)."""
    name, qs = QUANTILE_PANELS[panel]
    rows = buckets.where(F.col("name") == name).select("le", "n")
    out = [histogram_quantile(rows, q).select(F.lit(q).alias("q"), "value") for q in qs]
    return reduce(DataFrame.unionByName, out)
