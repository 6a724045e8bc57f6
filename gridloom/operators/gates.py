"""Data quality: drift between two windows, dead-letter rate, freshness. Clocks are parameters."""

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridloom.functions.scalars import bucket_of, ratio
from gridloom.functions.schema import SESSION_TYPES
from gridloom.operators.dedup import latest_version
from gridloom.operators.storage import between, newest, shifted
from gridloom.operators.versions import scratch

BUCKETS = 10
EPSILON = 1e-6
MAX_PSI = 0.25
MAX_DEAD_LETTER_RATE = 0.05
MAX_AGE_HOURS = 24


def energy_deltas(rows: DataFrame) -> DataFrame:
    """side, v: energy of each session that starts and stops within its side's window."""
    kept = latest_version(rows.where(F.col("event_type").isin(*SESSION_TYPES)))
    start = F.min(F.when(F.col("event_type") == "SESSION_START", F.col("timestamp")))
    stop = F.max(F.when(F.col("event_type") == "SESSION_STOP", F.col("timestamp")))
    energy = F.col("energy_kwh").cast("double")
    return kept.groupBy("side", "session_id").agg((F.max(energy) - F.min(energy)).alias("v"), start.alias("a"), stop.alias("b")).where("b >= a").select("side", "v")


def meter_powers(rows: DataFrame) -> DataFrame:
    """side, v: power of each reading above 0."""
    return latest_version(rows.where("event_type = 'METER_UPDATE' AND power_kw > 0")).select("side", F.col("power_kw").cast("double").alias("v"))


METRICS = {"energy_delta": energy_deltas, "power_kw": meter_powers}


def drift_windows(raw: DataFrame) -> DataFrame:
    """exp_start, exp_end, act_start, act_end: the week up to the newest event, in whole seconds, and that before."""
    end = raw.agg(F.date_trunc("second", F.max("timestamp")).cast("timestamp_ntz").alias("act_end")).where("act_end IS NOT NULL")
    week = F.expr("INTERVAL 7 DAYS")
    return end.select((F.col("act_end") - week - week).alias("exp_start"), (F.col("act_end") - week).alias("exp_end"), (F.col("act_end") - week).alias("act_start"), "act_end")


def values(raw: DataFrame, metric: str) -> DataFrame:
    """side ("exp" or "act"), v: one metric in both windows, from one scan.

    The windows are literals, from a small job, and are applied before versions are resolved: event
    time is part of an event's key, so that no version of it falls outside.
    """
    end = newest(raw)
    if end is None:
        return METRICS[metric](raw.limit(0).withColumn("side", F.lit("exp")))
    end = end[:19]  # whole seconds
    start, middle = (shifted(raw, end, f"- INTERVAL {d} DAYS") for d in (14, 7))
    rows = between(raw, start, end, until_open=True)
    later = F.col("timestamp") >= F.lit(middle).cast(raw.schema["timestamp"].dataType)
    return METRICS[metric](rows.withColumn("side", F.when(later, "act").otherwise("exp")))


#: The sketch's ranks are within 1 / ACCURACY of the truth; brackets reach ten times as far.
ACCURACY = 10_000


def exact_quantiles(rows: DataFrame, column: str, cuts: list[float]) -> list[float] | None:
    """The quantiles of a column, linear between neighbours; None without values.

    A sketch brackets each cut between two values; a second pass counts what lies below each bracket,
    and ranks the values inside, a five-hundredth of all. No task holds all values, and the answer is
    that of a sort.
    """
    v = F.col(column).cast("double")
    n = rows.agg(F.count(v)).first()[0]
    if not n:
        return None
    reach = 10 / ACCURACY + 2 / n  # and the neighbours on both sides
    at = [x for q in cuts for x in (max(0.0, q - reach), min(1.0, q + reach))]
    found = rows.agg(F.percentile_approx(v, at, ACCURACY)).first()[0]
    brackets = list(zip(found[0::2], found[1::2], strict=True))
    places = [(n - 1) * q for q in cuts]
    within = F.filter(F.array(*[F.when((v >= lo) & (v <= hi), F.lit(k)) for k, (lo, hi) in enumerate(brackets)]), lambda k: k.isNotNull())
    below = rows.agg(*[F.count_if(v < lo).alias(f"b{k}") for k, (lo, _) in enumerate(brackets)]).first()
    tallies = rows.select(F.explode(within).alias("k"), v.alias("v")).groupBy("k", "v").agg(F.count("*").alias("c"))
    # the last place of each value, from 0; each bracket's values are ranked by themselves
    w = Window.partitionBy("k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    first = F.element_at(F.array(*[F.lit(below[f"b{k}"]) for k in range(len(cuts))]), F.col("k") + 1)
    ranked = tallies.withColumn("last", first + F.sum("c").over(w) - 1).withColumn("first", F.col("last") - F.col("c") + 1)
    needed = F.lit(False)
    for k, p in enumerate(places):
        for r in {math.floor(p), math.ceil(p)}:
            needed = needed | ((F.col("k") == k) & (F.col("first") <= r) & (F.col("last") >= r))
    held = ranked.where(needed).collect()  # two rows a cut at most

    def value(k, r):
        return next(x["v"] for x in held if x["k"] == k and x["first"] <= r <= x["last"])

    return [value(k, math.floor(p)) * (1 - (p - math.floor(p))) + value(k, math.ceil(p)) * (p - math.floor(p)) for k, p in enumerate(places)]


#: Values that a cut's bracket may hold when it is ranked, and the steps in which brackets are narrowed.
RANKED, STEPS = 100_000, 100


def _brackets(base: DataFrame, state: DataFrame, by: list[str], n: int) -> DataFrame:
    """base beside its group's brackets: b, an array of n (lo, hi)."""
    wide = state.groupBy(*by).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "lo", "hi"))), lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"))).alias("b"))  # n entries
    there = wide.select(*[F.col(c).alias(f"_{c}") for c in by], "b")
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return base.join(there, reduce(lambda x, y: x & y, same)).select(*by, "v", "b")


def exact_quantiles_by(rows: DataFrame, column: str, by: list[str], cuts: list[float], ranked: int = RANKED) -> DataFrame:
    """by, k (the number of the cut), value: each group's exact quantiles, linear between neighbours, for all
    groups at once. Groups without values have no rows; null keys are a group.

    Each cut of each group has a bracket, at first all of the group's values. Sketches of what lies in brackets narrow
    them a hundredth part at a time, and counts tell what lies below, until none holds more than ``ranked``
    values, or only equal ones; these are then ranked. No task holds a group's values, and no group is
    brought together but by counts and sketches that are summed up first.
    """
    names = [f"g{k}" for k in range(len(by) + 1)]
    base = rows.select(*[F.col(c).alias(n) for c, n in zip(by, names, strict=False)], F.lit(0).alias(names[-1]), F.col(column).cast("double").alias("v")).where("v IS NOT NULL")
    each = base.groupBy(*names).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
    cut = F.posexplode(F.array(*[F.lit(float(q)) for q in cuts])).alias("k", "q")
    state = kept(each.select(*names, "n", "lo", "hi", cut).withColumn("below", F.lit(0).cast("long")).withColumn("m", F.col("n")).withColumn("before", F.lit(None).cast("long")))
    # a bracket that no longer shrinks holds few values, each of them many times
    while (state.where("lo < hi AND (before IS NULL OR m < before)").agg(F.max("m")).first()[0] or 0) > ranked:
        inside = _brackets(base, state, names, len(cuts)).select(*names, "v", F.posexplode("b").alias("k", "x")).where("v >= x.lo AND v <= x.hi")
        grid = inside.groupBy(*names, "k").agg(F.percentile_approx("v", [j / STEPS for j in range(STEPS + 1)], 10 * STEPS).alias("s"))
        both = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*names, "k")]
        place = ((F.col("n") - 1) * F.col("q") - F.col("below")) / F.greatest(F.col("m") - 1, F.lit(1)) * STEPS
        at = lambda j: F.element_at("s", F.least(F.greatest(j, F.lit(0)), F.lit(STEPS)).cast("int") + 1)
        near = state.alias("a").join(grid.alias("b"), reduce(lambda x, y: x & y, both)).select("a.*", "s")
        # two steps on either side: more than the sketch's error and the neighbour that a cut may lie between
        near = near.withColumn("lo_", F.when(F.col("m") > ranked, F.greatest("lo", at(F.floor(place) - 2))).otherwise(F.col("lo"))).withColumn("hi_", F.when(F.col("m") > ranked, F.least("hi", at(F.ceil(place) + 2))).otherwise(F.col("hi")))
        narrowed = kept(near.select(*names, "n", "k", "q", F.col("lo_").alias("lo"), F.col("hi_").alias("hi"), F.col("m").alias("before")))
        x = _brackets(base, narrowed, names, len(cuts))
        tally = [F.struct(F.count_if(F.col("v") < F.col("b")[j]["lo"]).alias("below"), F.count_if((F.col("v") >= F.col("b")[j]["lo"]) & (F.col("v") <= F.col("b")[j]["hi"])).alias("m")) for j in range(len(cuts))]
        counts = x.groupBy(*names).agg(*[t.alias(f"t{j}") for j, t in enumerate(tally)]).select(*names, F.posexplode(F.array(*[f"t{j}" for j in range(len(cuts))])).alias("k", "t"))
        state = kept(narrowed.alias("a").join(counts.alias("b"), reduce(lambda p, q: p & q, both)).select(*[f"a.{c}" for c in (*names, "n", "k", "q", "lo", "hi")], "t.below", "t.m", "a.before"))
    inside = _brackets(base, state, names, len(cuts)).select(*names, "v", F.posexplode("b").alias("k", "x")).where("v >= x.lo AND v <= x.hi")
    tallies = inside.groupBy(*names, "k", "v").agg(F.count("*").alias("c"))
    both = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*names, "k")]
    w = Window.partitionBy(*names, "k").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
    last = tallies.alias("a").join(state.alias("b"), reduce(lambda x, y: x & y, both)).select("a.*", ((F.col("n") - 1) * F.col("q")).alias("place"), F.col("below").alias("under"))
    last = last.withColumn("last", F.col("under") + F.sum("c").over(w) - 1).withColumn("first", F.col("last") - F.col("c") + 1)
    held = lambda r: F.max(F.when((F.col("first") <= r) & (F.col("last") >= r), F.col("v")))
    low, part = F.floor("place"), F.max(F.col("place") - F.floor("place"))
    found = last.groupBy(*names, "k").agg((held(low) * (1 - part) + held(F.ceil("place")) * part).alias("value"))
    return found.select(*[F.col(n).alias(c) for c, n in zip(by, names, strict=False)], "k", "value")


def kept(rows: DataFrame) -> DataFrame:
    """rows, written to the shared folder and read again: a few numbers a group, which later steps read."""
    path = scratch(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def edges(both: DataFrame, exact: bool = True) -> list[float] | None:
    """The nine inner deciles of the expected side; None without values or two distinct edges.

    exact=False takes the sketch's own answers, in one pass.
    """
    cuts, side = [k / BUCKETS for k in range(1, BUCKETS)], both.where("side = 'exp'")
    found = exact_quantiles(side, "v", cuts) if exact else side.agg(F.percentile_approx("v", cuts, ACCURACY)).first()[0]
    return found if found and len(set(found)) >= 2 else None


def bucket_counts(both: DataFrame, cuts: list[float] | None) -> DataFrame:
    """side, bucket, n for each of the buckets, empty ones too (all of them, without cuts)."""
    spine = both.sparkSession.range(2 * BUCKETS).select(F.when(F.col("id") < BUCKETS, "exp").otherwise("act").alias("side"), (F.col("id") % BUCKETS).cast("int").alias("bucket"))
    if cuts is None:
        return spine.withColumn("n", F.lit(0).cast("long"))
    found = both.groupBy("side", bucket_of(F.col("v"), F.array(*map(F.lit, cuts))).alias("bucket")).agg(F.count("*").alias("n"))
    return spine.join(F.broadcast(found), ["side", "bucket"], "left").select("side", "bucket", F.coalesce("n", F.lit(0)).cast("long").alias("n"))  # twenty rows


def measured(raw: DataFrame, metric: str, exact: bool = True) -> tuple[list[float] | None, DataFrame]:
    """A metric's edges and bucket counts. Its values are computed once and kept, on disk beyond memory,
    until both are known."""
    both = values(raw, metric).persist()
    try:
        cuts = edges(both, exact)
        rows = [tuple(r) for r in bucket_counts(both, cuts).collect()]  # twenty
    finally:
        both.unpersist()
    return cuts, raw.sparkSession.createDataFrame(rows, "side string, bucket int, n long")


def psi(counts: DataFrame) -> DataFrame:
    """One row, psi of bucket_counts(): null if either side is empty. Shares are at least EPSILON."""
    total = Window.partitionBy("side")  # twenty rows
    share = counts.withColumn("p", F.greatest(ratio(F.col("n"), F.sum("n").over(total)), F.lit(EPSILON))).withColumn("t", F.sum("n").over(total))
    of = lambda side, c: F.max(F.when(F.col("side") == side, F.col(c)))
    x = share.groupBy("bucket").agg(of("exp", "p").alias("e"), of("act", "p").alias("a"), F.min("t").alias("t"))
    return x.agg(F.when(F.min("t") > 0, F.sum((F.col("a") - F.col("e")) * F.log(F.col("a") / F.col("e")))).alias("psi"))


def drift(raw: DataFrame, metric: str, exact: bool = True) -> DataFrame:
    """metric, psi, passed: no row where the expected window is too small to cut."""
    cuts, counts = measured(raw, metric, exact)
    score = psi(counts).where("psi IS NOT NULL")
    return (score if cuts else score.limit(0)).select(F.lit(metric).alias("metric"), "psi", (F.col("psi") <= MAX_PSI).alias("passed"))


def dead_letter_rate(dead: DataFrame, clean: DataFrame, now: Column, days: int = 7, time: str = "ingested_at") -> DataFrame:
    """dead, total, rate, passed over the days before now. total counts clean rows as stored; 0 of 0 is 0."""
    lately = (F.col(time) >= now - F.expr(f"INTERVAL {days} DAYS")) & (F.col(time) < now)
    d = dead.where(lately).agg(F.count("*").alias("dead"))
    out = d.crossJoin(F.broadcast(clean.where(lately).agg(F.count("*").alias("total"))))
    return out.withColumn("rate", F.coalesce(ratio(F.col("dead"), F.col("total")), F.lit(0.0))).withColumn("passed", F.col("rate") <= MAX_DEAD_LETTER_RATE)


def freshness(raw: DataFrame, now: Column, hours: int = MAX_AGE_HOURS, time: str = "ingested_at") -> DataFrame:
    """newest, age_s, passed; an empty table fails."""
    newest = raw.agg(F.max(time).alias("newest"))
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col("newest").cast("timestamp"))
    return newest.withColumn("age_s", F.when(F.col("newest").isNotNull(), F.greatest(age, F.lit(0)))).withColumn("passed", F.coalesce(F.col("age_s") <= hours * 3600, F.lit(False)))


class GateFailed(ValueError):
    """A check whose rows say that it did not pass."""


def require(check: DataFrame, what: str) -> None:
    """Raise GateFailed if any row of check has passed = false."""
    bad = [r.asDict() for r in check.where("NOT passed").limit(20).collect()]
    if bad:
        raise GateFailed(f"{what}: {bad}")
