"""Anchored correlation windows: receptions of one message within 2 ms of the first.

A window is anchored at its first reception, unlike a session. One shuffle brings a key's
rows together in order; the rows then pass in batches of any cut, with the key and anchor of
the row before carried along. In a batch each row's successor (the first row past its
window, or of the next key) is looked up for all rows at once, and the chain of successors
from the first open window marks the anchors. No array holds a run, and a row costs the same
however dense its key is.

With ``split`` a key's long runs are not one task's: a lag over the key cuts runs where
two rows are further apart than the window, and rows past the window of a run's first are cut
into spans of time. Within a span chains are followed by doubling, to where a chain that enters at
each of the span's first rows leaves it; these few rows of all spans are walked in order,
and each span is cut from where its chain enters.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Windows in a span.
SPAN_WINDOWS = 1024


def anchored(rows: DataFrame, keys: list[str], t: str, ties: list[str], window: int, split: bool = False) -> DataFrame:
    """``rows`` with ``anchor``: the time of the first row of each row's group.

    ``t`` and ``window`` are integers of one unit; equal times are ordered by ``ties``. A
    null time has a null anchor. ``split`` is for keys whose runs are many tasks' work.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    rest = [c for c in rows.columns if c not in (*keys, t, *ties)]
    names = [*keys, "anchor", t, *ties, *rest]
    if not split:
        schema = T.StructType([*rows.schema.fields, T.StructField("anchor", T.LongType())])
        arrow = to_arrow_schema(schema)
        near = rows.repartition(*keys).sortWithinPartitions(*keys, t, *ties)
        return near.mapInArrow(lambda bs: _chained(bs, keys, t, window, arrow), schema).select(*names)
    order = Window.partitionBy(*keys).orderBy(t, *ties)
    gap = F.col(t) - F.lag(t).over(order)
    opens = F.when(gap <= window, None).otherwise(F.col(t).cast("long"))
    began = F.last(opens, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0))
    marked = rows.withColumn("__run", began)
    first = F.coalesce(F.col(t) - F.col("__run") <= window, F.lit(True))
    near = marked.where(first).withColumn("anchor", F.col("__run")).select(*names)
    return near.unionByName(_long_runs(marked.where(~first), keys, t, window).select(*names))


def _chained(batches: Iterator[pa.RecordBatch], keys: list[str], t: str, window: int, arrow: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows sorted by key and time, with their anchors. Between batches only the last row's
    key and anchor are kept."""
    last, anchor = None, None
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        none = b.column(t).is_null().to_numpy(zero_copy_only=False)
        at = b.column(t).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        apart = none.copy()
        apart[1:] |= none[:-1]
        apart[starts(b, keys)] = True
        # gaps over the window are all one: neither long times nor other keys' rows matter
        gap = np.diff(at, prepend=at[0])
        line = np.cumsum(np.where(apart | (gap > window), window + 1, gap))
        same = anchor is not None and not none[0] and len(starts(pa.concat_batches([last, b.slice(0, 1)]), keys)) == 1 and at[0] - anchor <= window
        held = int(np.searchsorted(line, line[0] + window - (at[0] - anchor), "right")) if same else 0
        after = np.searchsorted(line, line + window, "right").tolist()
        marks, i = [], held
        while i < n:
            marks.append(i)
            i = after[i]
        mine = np.full(n, anchor if same else 0, np.int64)
        mine[held:] = np.repeat(at[marks], np.diff([*marks, n]))
        last, anchor = b.slice(n - 1), None if none[-1] else int(mine[-1])
        cols = [*b.columns, pa.array(mine, mask=none)]
        yield pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)


def _long_runs(rows: DataFrame, keys: list[str], t: str, window: int) -> DataFrame:
    """``rows`` (past the window of their runs' first) with their anchors."""
    span = SPAN_WINDOWS * window
    at = F.col(t).cast("long") - F.col("__run")
    cut = rows.withColumn("__span", F.floor(at / span).cast("long")).withColumn("__u", at - F.col("__span") * span)
    run, one = [*keys, "__run"], [*keys, "__run", "__span"]
    kind = T.StructType([cut.schema[c] for c in one])
    chains = T.StructType([*kind, *[T.StructField(n, T.LongType()) for n in ("__u", "__leaves")]])
    inward = _by_groups(cut.select(*one, "__u"), one, ["__u"], lambda b: _leaving(b, one, window, span), chains)
    entries = T.StructType([*kind, T.StructField("__enters", T.LongType())])
    entered = inward.repartition(*run).sortWithinPartitions(*run, "__span", "__u").mapInArrow(lambda bs: _walked(bs, run, entries, window, span), entries)
    named = entered.select(*[F.col(c).alias(f"__of_{c}") for c in one], "__enters")
    same = [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in keys] + [F.col(c) == F.col(f"__of_{c}") for c in ("__run", "__span")]
    both = cut.join(named, same).select(*cut.columns, "__enters")
    out = T.StructType([*both.schema.fields, T.StructField("anchor", T.LongType())])
    return _by_groups(both, one, ["__u"], lambda b: _cut(b, one, window, span), out)


def _by_groups(df: DataFrame, keys: list[str], order: list[str], work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: T.StructType) -> DataFrame:
    """``work`` on batches of whole groups of ``keys``, sorted by keys and ``order``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in whole_groups(batches, keys):
            done = work(b)
            yield pa.RecordBatch.from_arrays([done.column(f.name).cast(f.type) for f in arrow], schema=arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(run, schema)


def starts(b: pa.RecordBatch, keys: list[str]) -> np.ndarray:
    """Where each group of equal, adjacent keys begins."""
    new = np.zeros(b.num_rows, bool)
    new[:1] = True
    for k in keys:
        codes = b.column(k).dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False)
        new[1:] |= codes[1:] != codes[:-1]
    return np.flatnonzero(new)


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows again, in batches that end where a group ends. A group is held as a whole."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        if not b.num_rows:
            continue
        if held:
            edge = pa.concat_batches([held[-1].slice(held[-1].num_rows - 1), b])
            begin = starts(edge, keys)
            begin = begin[begin > 0] - 1
        else:
            begin = starts(b, keys)[1:]
        if len(begin):
            yield pa.concat_batches([*held, b.slice(0, begin[-1])])
            held = [b.slice(begin[-1])]
        else:
            held.append(b)
    if held:
        yield pa.concat_batches(held)


def _followed(b: pa.RecordBatch, keys: list[str], window: int, span: int) -> tuple[np.ndarray, ...]:
    """Of rows sorted by group and time: each row's group, group ends, times, and successors
    (the first row of the group past the window, or where the group ends)."""
    begin = starts(b, keys)
    end = np.append(begin[1:], b.num_rows)
    of = np.repeat(np.arange(len(begin)), end - begin)
    u = b.column("__u").to_numpy(zero_copy_only=False).astype(np.int64)
    after = np.empty(len(u), np.int64)
    most = max(1, (1 << 62) // (span + 2 * window + 2))  # groups whose times fit in one number line
    for g in range(0, len(begin), most):
        part = slice(begin[g], end[min(g + most, len(end)) - 1])
        line = u[part] + (of[part] - g) * (span + 2 * window + 2)
        after[part] = begin[g] + np.searchsorted(line, line + window, "right")
    return of, end, u, np.minimum(after, end[of])


def _leaving(b: pa.RecordBatch, keys: list[str], window: int, span: int) -> pa.RecordBatch:
    """A span's rows up to the first past one window, at one of which a chain enters, and
    the time of that chain's last row in the span."""
    of, end, u, after = _followed(b, keys, window, span)
    last = np.where(after < end[of], after, np.arange(len(u)))
    while True:
        further = last[last]
        if (further == last).all():
            break
        last = further
    entry = (u <= window) | np.append(True, (u[:-1] <= window) | (of[1:] != of[:-1]))
    i = np.flatnonzero(entry)
    return pa.RecordBatch.from_arrays([*[b.column(k).take(pa.array(i)) for k in keys], pa.array(u[i]), pa.array(u[last[i]])], names=[*keys, "__u", "__leaves"])


def _walked(batches: Iterator[pa.RecordBatch], run: list[str], schema: T.StructType, window: int, span: int) -> Iterator[pa.RecordBatch]:
    """For each span of a run the end of the window that is open as it begins, from its start on."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    key, now, until, entering, entered = None, None, 0, 0, True
    for b in batches:
        rows = []
        for *k, s, u, leaves in zip(*[b.column(c).to_pylist() for c in (*run, "__span", "__u", "__leaves")]):
            if k != key:
                key, now, until = k, None, window  # the run's first row is an anchor
            if s != now:
                now, entered, entering = s, False, max(until - s * span, -1)
                rows.append((*k, s, entering))
            if not entered and u > entering:
                entered, until = True, s * span + leaves + window
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def _cut(b: pa.RecordBatch, keys: list[str], window: int, span: int) -> pa.RecordBatch:
    """The rows of spans with their anchors: all spans' chains are followed at once."""
    of, end, u, after = _followed(b, keys, window, span)
    enters = b.column("__enters").to_numpy(zero_copy_only=False).astype(np.int64)
    n = np.arange(len(u))
    begins = np.append(0, end[:-1])
    at = begins + np.add.reduceat(u <= enters, begins)
    mark = np.zeros(len(u), bool)
    live = at < end
    at, end = at[live], end[live]
    while len(at):
        mark[at] = True
        at = after[at]
        live = at < end
        at, end = at[live], end[live]
    behind = np.maximum.accumulate(np.where(mark, n, -1))
    anchor = np.where(u <= enters, enters - window, u[np.maximum(behind, 0)])
    base = b.column("__run").to_numpy(zero_copy_only=False) + b.column("__span").to_numpy(zero_copy_only=False) * span
    return b.append_column("anchor", pa.array(base + anchor))


def first_per(rows: DataFrame, group: list[str], member: str, order: list[str]) -> DataFrame:
    """The first row of each member within each group."""
    n = F.row_number().over(Window.partitionBy(*group, member).orderBy(*order))
    return rows.withColumn("__n", n).where("__n = 1").drop("__n")


def correlate(decoded: DataFrame, window_ns: int = 2_000_000, min_receptions: int = 2) -> DataFrame:
    """Groups of receptions of the same message by different sensors.

    A sensor counts once, first come; groups under ``min_receptions`` sensors go. The
    first reception's format, altitude and squawk are the group's.
    """
    df = decoded.where("icao is not null and icao <> '' and raw_msg is not null and raw_msg <> '' and sensor_id is not null and df_type is not null")
    df = df.withColumn("t_ns", F.col("timestamp_s") * F.lit(1_000_000_000).cast("long") + F.col("timestamp_ns"))
    rows = anchored(df, ["icao", "raw_msg"], "t_ns", ["sensor_id"], window_ns)
    rows = first_per(rows, ["icao", "raw_msg", "anchor"], "sensor_id", ["t_ns"])
    reception = F.struct("t_ns", "sensor_id", "lat", "lon", "alt", "timestamp_s", "timestamp_ns")
    by = rows.groupBy("icao", "raw_msg", "anchor").agg(
        F.array_sort(F.collect_list(reception)).alias("rs"),
        F.min_by(F.struct("df_type", F.col("altitude_ft").cast("double").alias("altitude_ft"), "squawk"), F.struct("t_ns", "sensor_id")).alias("first"),
    )
    by = by.where(F.size("rs") >= min_receptions)
    plain = F.transform("rs", lambda r: F.struct(*[r[k].alias(k) for k in ("sensor_id", "lat", "lon", "alt", "timestamp_s", "timestamp_ns")]))
    return by.select(
        "icao", "first.df_type", "first.altitude_ft", "first.squawk", "raw_msg", F.size("rs").alias("num_sensors"), plain.alias("receptions"), F.col("anchor").alias("t_ns")
    )
