"""Periodic runs of words by partition refinement, and texts without their repeats.

A run is a stretch of words with a smallest period q, at least twice as long as q, that keeps that
period no further on either side. Positions of a text are in one class of level k if the same k
words start there. Level k + 1 refines level k: two positions stay together if their successors
were together, too. Only the small classes are looked at: where a class has fallen into parts, all
but the largest of them split their predecessors, so that a position is touched a logarithm of times.

A class keeps its positions in order. Two neighbours at distance k in a class of level k are a
square, whose root is no power itself: with a shorter period, an occurrence would lie between them.
Squares of one root length that start side by side are one run.

Many texts are refined together, level by level, in numpy; texts of similar length share a batch.
No row leaves its task, so no key can be hot, and a text must fit in a task.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridloom.llm.common import SPACE, lean

#: Runs have so many words at least.
LEAST = 12
#: Words that are refined together, about.
BATCH = 1 << 19
#: Texts above so many words are batched apart from shorter ones, which need fewer levels.
LONG = (512, 2048, 8192)


class _Squares:
    """Neighbours of a class that will be a square if they are still neighbours when the level is
    their distance: kept by the power of two below it, and sorted when the level gets there."""

    def __init__(self, following: np.ndarray, reach: np.ndarray):
        self.following, self.reach, self.far = following, reach, {}
        self.top, self.near, self.late = 1, (np.zeros(0, np.int64),) * 2, []
        self.due = 1  # the next level at which there may be something to do
        self.found: list[tuple[int, np.ndarray]] = []

    def add(self, at: np.ndarray, to: np.ndarray, level: int) -> None:
        gap = to.astype(np.int64) - at
        keep = (gap >= level) & (gap <= self.reach[at])
        if not keep.any():
            return
        gap, at = gap[keep], at[keep]
        now = gap < self.top
        if now.any():
            self.late.append((gap[now], at[now]))
            self.due = min(self.due, int(gap[now].min()))
            gap, at = gap[~now], at[~now]
        power = np.frexp(gap)[1]
        for p in np.unique(power).tolist():
            self.far.setdefault(p, []).append((gap[power == p], at[power == p]))

    def at(self, level: int) -> None:
        """Note the squares of this root length."""
        if level < self.due:
            return
        if level >= self.top:
            self.top *= 2
            got = self.far.pop(level.bit_length(), [])
            if got:
                gap, at = (np.concatenate(x) for x in zip(*got, strict=True))
                keep = self.following[at] == at + gap
                gap, at = gap[keep], at[keep]
                order = np.argsort(gap, kind="stable")
                self.near = gap[order], at[order]
            else:
                self.near = (np.zeros(0, np.int64),) * 2
            self.late = []
        gap, at = self.near
        a, b = np.searchsorted(gap, (level, level + 1))
        here = [at[a:b]] if b > a else []
        if self.late:
            gap, at = (np.concatenate(x) for x in zip(*self.late, strict=True)) if len(self.late) > 1 else self.late[0]
            here.append(at[gap == level])
            later = gap > level
            self.late = [(gap[later], at[later])] if later.any() else []
        self.due = min([self.top, *self.near[0][b : b + 1].tolist(), *(int(g.min()) for g, _ in self.late)])
        if here:
            x = np.concatenate(here)
            x = x[self.following[x] == x + level]
            if len(x):
                self.found.append((level, np.unique(x)))


def runs(symbol: np.ndarray, sizes: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, length and period of every run of at least ``least`` symbols, by start and period.

    symbol holds several sequences one after another, of the given sizes; two sequences have no
    symbol in common. Starts count from the first symbol of all.
    """
    n, sizes = len(symbol), np.asarray(sizes, np.int64)
    none = (np.zeros(0, np.int64),) * 3
    if n == 0:
        return none
    ends = np.cumsum(sizes)
    home, reach = np.repeat(np.arange(len(sizes)), sizes), np.repeat(sizes // 2, sizes)
    first = np.zeros(n + 1, bool)
    first[ends - sizes] = True
    # classes of level 1: symbols
    kind = np.unique(symbol, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(kind, kind="stable")
    classes = int(kind.max()) + 1
    count = np.zeros(4 * n + 16, np.int64)
    count[:classes] = np.bincount(kind)
    same = kind[order[1:]] == kind[order[:-1]]
    following, before = np.full(n, -1), np.full(n, -1)
    following[order[:-1][same]], before[order[1:][same]] = order[1:][same], order[:-1][same]
    shared = count[kind] > 1
    busy = np.bincount(home[shared], minlength=len(sizes))
    # what each class held when it was made: a place in kept, of which some may have left since
    kept, used = np.empty(4 * n + 16, np.int64), n
    kept[:n] = order
    place, held = np.zeros(4 * n + 16, np.int64), np.zeros(4 * n + 16, np.int64)
    place[:classes], held[:classes] = np.cumsum(count[:classes]) - count[:classes], count[:classes]
    leaves = np.zeros(n, bool)
    squares = _Squares(following, reach)
    squares.add(order[:-1][same], order[1:][same], 1)
    small, level = np.arange(n), 1
    live = np.flatnonzero((busy > 0) & (sizes >= 2))
    while len(live):
        squares.at(level)
        live = live[(busy[live] > 0) & (sizes[live] // 2 > level)]
        if not len(live):
            break
        # positions from which one more symbol would pass the sequence's end are the last of their class
        over = ends[live] - level
        over = over[shared[over]]
        level += 1
        x = small[~first[small]] - 1 if len(small) else small
        x = x[shared[x] & (reach[x] >= level)] if len(x) else x
        to = kind[x + 1] if len(x) else x
        if len(over):
            last = before[over]
            following[last], before[over], shared[over] = -1, -1, False
            count[kind[over]] -= 1
            kind[over] = -1
            last = last[count[kind[last]] == 1]
            shared[last] = False
            busy[home[over]] -= 1
            busy[home[last]] -= 1
        stay = shared[x]
        x, to = x[stay], to[stay]
        if not len(x):
            small = x
            continue
        old = kind[x]
        # members that leave, by class and place: stretches of neighbours, whose ends are joined
        leaves[x] = True
        y = x[np.argsort(old, kind="stable")]
        prior, later = before[y], following[y]
        head, tail = (prior < 0) | ~leaves[prior], (later < 0) | ~leaves[later]
        left, right = prior[head], later[tail]
        leaves[x] = False
        left_ok, right_ok = left >= 0, right >= 0
        following[left[left_ok]] = right[left_ok]
        before[right[right_ok]] = left[right_ok]
        both = left_ok & right_ok
        if both.any():
            squares.add(left[both], right[both], level)
        ends_now = np.concatenate([left[left_ok], right[right_ok]])
        alone = np.unique(ends_now[(following[ends_now] < 0) & (before[ends_now] < 0)])
        # parts: members of one class whose successors share a class
        by = np.argsort(old * (classes + 1) + to, kind="stable")
        y, old, to = x[by], old[by], to[by]
        edge = np.append(True, (old[1:] != old[:-1]) | (to[1:] != to[:-1]))
        starts = np.flatnonzero(edge)
        part_n = np.diff(np.append(starts, len(y)))
        part_old, part_to = old[starts], to[starts]
        lead = np.append(True, part_old[1:] != part_old[:-1])
        owner = np.cumsum(lead) - 1
        olds = part_old[lead]
        count[olds] -= np.add.reduceat(part_n, np.flatnonzero(lead))
        # the largest part, or the rest of the class, does not count as small
        most = np.maximum.reduceat(part_n, np.flatnonzero(lead))
        top = (part_n == most[owner]) & (part_n > count[olds][owner])
        top &= np.cumsum(top) - np.maximum.accumulate(np.where(lead, np.cumsum(top) - top, 0)) == 1
        fresh = classes + np.arange(len(starts))
        if classes + len(starts) > len(count):
            count, place, held = (np.append(a, np.zeros(len(a) + len(starts), np.int64)) for a in (count, place, held))
        if used + len(y) > len(kept):
            kept = np.append(kept, np.empty(len(kept) + len(y), np.int64))
        classes += len(starts)
        kept[used : used + len(y)], place[fresh], held[fresh], count[fresh] = y, used + starts, part_n, part_n
        used += len(y)
        kind[y] = np.repeat(fresh, part_n)
        # links within parts
        mine = ~edge[1:]
        a, b = y[:-1][mine], y[1:][mine]
        new = following[a] != b
        following[y], before[y] = -1, -1
        following[a], before[b] = b, a
        if new.any():
            squares.add(a[new], b[new], level)
        lone = np.concatenate([y[starts[part_n == 1]], alone])
        shared[lone] = False
        np.subtract.at(busy, home[lone], 1)
        small = y[np.repeat(~top, part_n)]
        rest = olds[(np.bincount(owner, top) > 0) & (count[olds] > 0)]
        if len(rest):
            sizes_of = held[rest]
            at = np.arange(sizes_of.sum()) + np.repeat(place[rest] - (np.cumsum(sizes_of) - sizes_of), sizes_of)
            still = kept[at]
            still = still[kind[still] == np.repeat(rest, sizes_of)]
            kept[place[rest].repeat(count[rest]) + np.arange(len(still)) - np.repeat(np.cumsum(count[rest]) - count[rest], count[rest])] = still
            held[rest] = count[rest]
            small = np.concatenate([small, still])
        small = np.sort(small)
    if not squares.found:
        return none
    at = np.concatenate([x for _, x in squares.found])
    period = np.repeat([k for k, _ in squares.found], [len(x) for _, x in squares.found])
    edge = np.append(True, (period[1:] != period[:-1]) | (at[1:] != at[:-1] + 1))
    start, q = at[edge], period[edge]
    length = at[np.append(edge[1:], True)] - start + 2 * q
    keep = length >= least
    start, length, q = start[keep], length[keep], q[keep]
    order = np.lexsort((q, start))
    return start[order], length[order], q[order]



def _collapsed(words: list, start: np.ndarray, length: np.ndarray, period: np.ndarray) -> bytes:
    """The words that no run holds after its first period, joined by one space."""
    if not len(start):
        return b" ".join(words)
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, start + period, 1)
    np.add.at(depth, start + length, -1)
    keep = np.cumsum(depth[:-1]) == 0
    return b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k])


_FOUND = pa.schema([("key", pa.int64()), ("n_words", pa.int64()), ("runs", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))), ("collapsed", pa.binary())])


def _found(rows: list, least: int):
    """Batches for (key, words) rows: their runs, and their words without repeats."""
    symbols, at = [], 0
    for _, words in rows:
        number: dict[bytes, int] = {}
        own = np.array([number.setdefault(w, len(number)) for w in words], np.int64)
        symbols.append(own + at)
        at += len(number)
    sizes = np.array([len(w) for _, w in rows], np.int64)
    start, length, period = runs(np.concatenate(symbols), sizes, least)
    ends = np.cumsum(sizes)
    cut = np.searchsorted(start, ends)
    start = start - np.repeat(ends - sizes, np.diff(np.append(0, cut)))
    out, size, first = [], 0, 0
    for k, ((key, words), b) in enumerate(zip(rows, cut.tolist(), strict=True)):
        a = 0 if k == 0 else int(cut[k - 1])
        out.append((key, len(words), _collapsed(words, start[a:b], length[a:b], period[a:b])))
        size += len(out[-1][2])
        if size >= 1 << 22 or k == len(rows) - 1:
            spans = pa.StructArray.from_arrays([pa.array(x[cut[first - 1] if first else 0 : b]) for x in (start, length, period)], ["start", "length", "period"])
            offsets = np.append(0, cut[first : k + 1]) - (cut[first - 1] if first else 0)
            offsets[0] = 0
            keys, n, body = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), spans), pa.array(body, pa.binary())], schema=_FOUND)
            out, size, first = [], 0, k + 1


def find_runs(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = LEAST) -> DataFrame:
    """key (as long), n_words, runs (array of start, length, period, by start and period) and collapsed:
    the text without words that a run holds after its first period, joined by one space.

    Words are split at ASCII white space and compared as they are; starts count words from 0. A row
    for each row of docs, rows with a null or repeated key too, each by its own text. Null and empty
    texts have no words and no runs, and collapse to the empty text; an empty table gives no rows.
    Runs may overlap; a word goes if any of them says so.
    """
    given = docs.select(F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{text}`").cast("string").cast("binary").alias("text"))

    def run(batches):
        waiting: list[list] = [[] for _ in range(len(LONG) + 1)]
        held = [0] * len(waiting)
        for b in batches:
            for k, t in zip(b["key"].to_pylist(), b["text"].to_pylist(), strict=True):
                words = (t or b"").split()
                of = int(np.searchsorted(LONG, len(words)))
                waiting[of].append((k, words))
                held[of] += len(words) + 1
                if held[of] >= BATCH:
                    yield from _found(waiting[of], least)
                    waiting[of], held[of] = [], 0
        for rows in waiting:
            if rows:
                yield from _found(rows, least)

    found = given.mapInArrow(lean(run), "key long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")
    return found.select(F.col("key").alias(key), "n_words", "runs", F.col("collapsed").cast("string").alias("collapsed"))


def with_tails(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and text, where one text in ten (by the checksum of its key) ends in a period of its own words.

    With h the crc32 of the decimal key and g = h div 10, texts of n > 0 words and h mod 10 = 0 keep
    the first a = g mod n words; those after repeat the next 1 + (n - a) div (3 + g mod 8) ones. Other
    texts, and those without a key, stay as they are.
    """
    k, body = F.col(f"`{key}`").cast("long"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    h = F.crc32(k.cast("string").cast("binary"))
    chosen = F.coalesce(h % 10 == 0, F.lit(False))
    words = F.when(chosen, F.array_remove(F.split(body, f"{SPACE}+"), ""))
    split = docs.select(k.alias("k"), body.alias("t"), F.floor(h / 10).alias("g"), words.alias("w"))
    at = split.withColumn("n", F.size("w")).withColumn("a", F.when(F.col("n") > 0, (F.col("g") % F.col("n")).cast("int")))
    at = at.withColumn("p", F.lit(1) + F.floor((F.col("n") - F.col("a")) / (F.lit(3) + F.col("g") % 8)).cast("int"))
    left = F.col("n") - F.col("a")
    tail = F.slice(F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int"))), F.lit(1), left)
    return at.select(F.col("k").alias(key), F.when(F.col("a").isNotNull(), F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), tail)).otherwise(F.col("t")).alias(text))


def digest(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """key, n_runs, the longest run (of those the first, of those the one of least period) and digests
    of all runs and of the collapsed text, from find_runs rows."""
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    rows = found.select(key, F.size("runs").cast("long").alias("n_runs"), best.alias("best"), F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    start, length, period = -F.col("best.start"), F.col("best.length"), -F.col("best.period")
    return rows.select(key, "n_runs", start.alias("start"), length.alias("length"), period.alias("period"), F.floor(1000 * length / period).alias("exponent_milli"), "runs_sha256", "collapsed_sha256")


ORACLE = r"""
WITH c AS (SELECT doc_id, coalesce(text, '') AS t, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: [ascii(x)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))),
             lambda r, x: CASE WHEN x >= 0 THEN xor(r, x) ELSE xor(r >> 1, (r & 1) * 3988292384) END), 4294967295) AS h FROM documents),
d AS (SELECT doc_id, h % 10 = 0 AS planted, h // 10 AS g, list_filter(regexp_split_to_array(t, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM c),
e AS (SELECT *, CASE WHEN planted AND len(w) > 0 THEN g % len(w) ELSE len(w) END AS a FROM d),
f AS (SELECT *, 1 + (len(w) - a) // (3 + g % 8) AS p FROM e),
v AS (SELECT doc_id, [w[1 + (CASE WHEN i < a THEN i ELSE a + (i - a) % p END)::BIGINT] for i in range(len(w))] AS w FROM f),
x AS (SELECT doc_id, w, unnest(range(len(w) - 5)) AS i FROM v WHERE len(w) >= 6),
s AS (SELECT doc_id, i, array_to_string(w[i + 1:i + 6], ' ') AS s FROM x),
q AS (SELECT y.doc_id, y.i, z.i - y.i AS p, y.i - row_number() OVER (PARTITION BY y.doc_id, z.i - y.i ORDER BY y.i) AS k FROM s y JOIN s z ON y.doc_id = z.doc_id AND y.s = z.s AND y.i < z.i),
o AS (SELECT doc_id, p AS period, min(i) AS start, count(*) + 5 + p AS length FROM q GROUP BY doc_id, p, k),
u AS (SELECT doc_id, start, length, min(period) AS period FROM o WHERE length >= 2 * period AND length >= 12 GROUP BY doc_id, start, length),
b AS (SELECT doc_id, count(*) AS n_runs, arg_min([start, length, period], [-length, start, period]) AS b, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM u GROUP BY doc_id),
g AS (SELECT DISTINCT doc_id, unnest(range(start + period, start + length)) AS i FROM u),
n AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) - 1 AS i FROM v),
m AS (SELECT n.doc_id, string_agg(word, ' ' ORDER BY n.i) AS kept FROM n ANTI JOIN g ON n.doc_id = g.doc_id AND n.i = g.i GROUP BY n.doc_id)
SELECT v.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b[1]::BIGINT AS start, b[2]::BIGINT AS length, b[3]::BIGINT AS period, (1000 * b[2] // b[3])::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256 FROM v LEFT JOIN b USING (doc_id) LEFT JOIN m USING (doc_id)
"""
