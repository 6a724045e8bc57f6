"""Reports from files of SQL: each file's query over registered views, as CSV and as a chart."""

from collections.abc import Iterable
from pathlib import PurePosixPath
from xml.sax.saxutils import escape

from pyspark.sql import DataFrame, SparkSession

from gridloom.operators.dedup import latest_version
from gridloom.operators.storage import write_csv
from gridloom.operators.versions import store_of


def views(raw: DataFrame) -> None:
    """The names that queries read: events_raw as stored, events_final with stale versions resolved."""
    raw.createOrReplaceTempView("events_raw")
    latest_version(raw).createOrReplaceTempView("events_final")


def files(spark: SparkSession, folder: str, pattern: str = "*.sql") -> list[str]:
    """The query files of a folder in any store, by name."""
    store, of = store_of(spark, folder)
    return sorted(str(f.getPath()) for f in store.globStatus(of(f"{folder.rstrip('/')}/{pattern}")) or ())


def query(spark: SparkSession, path: str) -> DataFrame:
    """The one query of a file; closing semicolons and blank space go."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return spark.sql(text.strip().rstrip(";").rstrip())


def drawn(df: DataFrame) -> dict | None:
    """How a report is drawn unless told: its first number by its first other column, as a line over time and
    else as bars with the largest on top. None without both."""
    plain = [(f.name, f.dataType.typeName()) for f in df.schema]
    number = next((n for n, t in plain if t in ("double", "float", "long", "integer", "decimal")), None)
    label, kind = next(((n, t) for n, t in plain if t in ("string", "timestamp", "timestamp_ntz", "date")), (None, ""))
    return {"label": label, "value": number, "kind": "barh" if kind == "string" else "line"} if number and label else None


def run(spark: SparkSession, folder: str, out: str | None = None, pattern: str = "*.sql", charts: dict[str, dict] | None = None) -> dict[str, DataFrame]:
    """Each file's name (without its ending) and rows; with out, each report's rows as CSV below it, and beside
    them an SVG, as charts says (arguments of chart() by name) or drawn() does."""
    found = {PurePosixPath(p).stem: query(spark, p) for p in files(spark, folder, pattern)}
    if out:
        store, of = store_of(spark, out)
        for name, df in found.items():
            write_csv(df, f"{out.rstrip('/')}/{name}")
            how = (charts or {}).get(name) or drawn(df)
            if how:
                # a report limits itself; a chart of more rows than anyone can see shows the first
                svg = chart(df.limit(MOST_DRAWN).collect(), **{"title": name, "top": 20 if how.get("kind") == "barh" else None, **how})
                to = store.create(of(f"{out.rstrip('/')}/{name}.svg"), True)
                to.write(bytearray(svg.encode()))
                to.close()
    return found


#: Rows of a report that its chart takes.
MOST_DRAWN = 1000


def chart(rows: Iterable, label: str, value: str, kind: str = "bar", title: str = "", top: int | None = None) -> str:
    """An SVG of a report's rows (few, as reports limit themselves): bars, horizontal bars with the
    largest on top ("barh"), or a line. Nulls count as 0; no rows give an empty chart."""
    data = [(str(r[label]), float(r[value] or 0)) for r in rows][:top]
    width, height, left, base = 900, 420, 160 if kind == "barh" else 60, 360
    high, low = max([v for _, v in data] + [0.0]), min([v for _, v in data] + [0.0])
    span, n = (high - low) or 1.0, max(1, len(data))
    out = [f'<svg xmlns="http://www.w3.org/2000/svg" width="{width}" height="{height}" font-family="sans-serif" font-size="11">', f'<text x="{width / 2:.0f}" y="20" text-anchor="middle" font-size="15">{escape(title)}</text>']
    if kind == "barh":
        step = (base - 40) / n
        for k, (name, v) in enumerate(data):
            y = 40 + k * step
            out.append(f'<rect x="{left}" y="{y:.1f}" width="{(width - left - 80) * max(0.0, v) / span:.1f}" height="{step * 0.8:.1f}" fill="#4477aa"><title>{escape(name)}: {v:g}</title></rect>')
            out.append(f'<text x="{left - 6}" y="{y + step * 0.55:.1f}" text-anchor="end">{escape(name)}</text>')
    else:
        step = (width - left - 20) / n
        y_of = lambda v: base - (base - 40) * (v - low) / span
        points = [(left + (k + 0.5) * step, y_of(v)) for k, (_, v) in enumerate(data)]
        if kind == "line":
            out.append('<polyline fill="none" stroke="#4477aa" stroke-width="2" points="' + " ".join(f"{x:.1f},{y:.1f}" for x, y in points) + '"/>')
        else:
            zero = y_of(0.0)
            out += [f'<rect x="{x - 0.4 * step:.1f}" y="{min(y, zero):.1f}" width="{0.8 * step:.1f}" height="{abs(zero - y):.1f}" fill="#4477aa"><title>{escape(name)}: {v:g}</title></rect>' for (x, y), (name, v) in zip(points, data, strict=True)]
        every = -(-n // 12)
        out += [f'<text x="{x:.1f}" y="{base + 16}" text-anchor="middle">{escape(name[:18])}</text>' for k, ((x, _), (name, _)) in enumerate(zip(points, data, strict=True)) if k % every == 0]
        out += [f'<text x="{left - 6}" y="{y_of(v):.1f}" text-anchor="end">{v:g}</text>' for v in (low, high)]
    return "\n".join([*out, "</svg>"])
