"""Clock filters of few pairs over long times, split in time.

A pair's filter runs through its measurements in order, so :func:`skyweft.operators.clock.offsets`
has one task for each pair at most. It forgets, though: started anew some time before, it comes
to the same state. Here a pair's time is cut into spans that are filtered apart, each with a
warm-up of the measurements before it. Where the state that a warm-up ends in is not that in
which the span before ended (a jump, a gap, too short a warm-up), the span is filtered again
from the latter, until all seams fit.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.operators import clock
from skyweft.operators.kept import kept
from skyweft.schemas import struct

#: Length of a span and of a warm-up: hours of measurements a second or so apart.
SPAN_NS, WARM_NS = 6 * 3600 * 10**9, 2 * 3600 * 10**9
#: By how much states may differ at a seam: offset (s), drift, and variances by a share.
SAME_OFFSET, SAME_DRIFT, SAME_SHARE = 1e-13, 1e-15, 1e-6

_STATE = struct(clock.STATE)
_PAIR = ("sensor_a", "sensor_b")
_GROUP = (*_PAIR, "span")
#: A filtered measurement, or (with ``end``) what a span began and ended in.
_OUT = T.StructType([*clock.HISTORY.fields, T.StructField("span", T.LongType()), T.StructField("anew", T.BooleanType()), T.StructField("begin", _STATE), T.StructField("end", _STATE), T.StructField("resets", T.BooleanType())])


def offsets(measured: DataFrame, span_ns: int = SPAN_NS, warm_ns: int = WARM_NS) -> DataFrame:
    """HISTORY rows as :func:`skyweft.operators.clock.offsets` gives them, to the tolerances at
    seams. Runs at once and writes what it makes; ``warm_ns`` is ``span_ns`` at most."""
    if warm_ns > span_ns:
        raise ValueError("a warm-up is no longer than a span")
    rows = kept(measured.select(*_PAIR, "t_ns", "measured").withColumn("span", F.floor(F.col("t_ns") / span_ns).cast("long")))
    ahead = rows.where(F.pmod("t_ns", F.lit(span_ns)) >= span_ns - warm_ns).withColumn("span", F.col("span") + 1)
    own = rows.select("span", *_PAIR).distinct()  # spans without measurements of their own need no warm-up
    none = F.lit(None).cast(_STATE)
    both = rows.withColumn("own", F.lit(True)).unionByName(ahead.join(own, list(_GROUP), "left_semi").withColumn("own", F.lit(False)))
    done = kept(_filtered(both.withColumn("begin", none)))
    while True:
        bad = kept(_bad_seams(done))
        if bad.isEmpty():
            return _numbered(done)
        again = rows.join(bad, list(_GROUP)).withColumn("own", F.lit(True))
        done = kept(done.join(bad.select(*_GROUP), list(_GROUP), "left_anti").select(*_OUT.names).unionByName(_filtered(again)))


def _filtered(rows: DataFrame) -> DataFrame:
    """_OUT rows of spans: sensor_a, sensor_b, span, t_ns, measured, own, begin (a state or null)."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(_OUT)
    src = rows.select(*_GROUP, "t_ns", "measured", "own", "begin").repartition(*_GROUP).sortWithinPartitions(*_GROUP, "t_ns", "measured")

    def told(f: clock.PairFilter) -> dict | None:
        return dict(zip(_STATE.names, f.state())) if f.n else None

    def run(batches):
        key, f, begin, begun, resets = None, None, None, False, False
        for b in batches:
            out = []
            for a, c, span, t, z, own, state in zip(*[b.column(i).to_pylist() for i in range(7)]):
                if (a, c, span) != key:
                    if key:
                        out.append(_seam(key, begin, told(f), resets))
                    key, begun, resets = (a, c, span), False, False
                    f = clock.PairFilter.of(tuple(state[n] for n in _STATE.names)) if state else clock.PairFilter()
                    begin = state
                if own and not begun:
                    begun = True
                    begin = begin or told(f)
                was = f.n
                ok = f.update(t, z)
                if own:
                    resets |= bool(was) and f.n == 1
                    out.append({"sensor_a": a, "sensor_b": c, "t_ns": t, "k": f.k, "offset": f.offset, "drift": f.drift, "variance": f.p00, "n": f.n, "valid": f.valid, "accepted": ok, "innovation": f.innovation, "span": span, "anew": resets})
            if out:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
        if key:
            yield pa.RecordBatch.from_pylist([_seam(key, begin, told(f), resets)], schema=arrow)

    return src.mapInArrow(run, _OUT)


def _seam(key: tuple, begin: dict | None, end: dict | None, resets: bool) -> dict:
    return {"sensor_a": key[0], "sensor_b": key[1], "span": key[2], "begin": begin, "end": end, "resets": resets}


def _bad_seams(done: DataFrame) -> DataFrame:
    """Spans that did not begin as the pair's span before ended, with that state as ``begin``."""
    order = Window.partitionBy(*_PAIR).orderBy("span")
    seams = done.where("end is not null").select(*_GROUP, F.col("begin").alias("b"), F.lag("end").over(order).alias("e"))
    near = lambda k, most: F.abs(F.col(f"b.{k}") - F.col(f"e.{k}")) <= most
    share = lambda k: near(k, F.abs(F.col(f"e.{k}")) * SAME_SHARE + 1e-30)
    sure = lambda k: F.col(f"{k}.n") >= clock.VALID_AFTER
    same = near("offset", SAME_OFFSET) & near("drift", SAME_DRIFT) & share("p00") & share("p01") & share("p11") & (F.col("b.t_ns") == F.col("e.t_ns")) & (F.col("b.run") == F.col("e.run")) & (sure("b") == sure("e"))
    return seams.where(F.col("e").isNotNull() & ~F.coalesce(same, F.lit(False))).select(*_GROUP, F.col("e").alias("begin"))


def _numbered(done: DataFrame) -> DataFrame:
    """Measurements with the numbers that one run through all spans would give them."""
    order = Window.partitionBy(*_PAIR).orderBy("span")
    seams = done.where("end is not null")
    begun = lambda k: F.coalesce(F.col(f"begin.{k}"), F.lit(0))
    seams = seams.select(*_GROUP, begun("n").alias("n0"), begun("k").alias("k0"), F.col("end.n").alias("n1"), F.col("end.k").alias("k1"), "resets")
    seams = seams.withColumn("era", F.sum(F.col("resets").cast("int")).over(order))
    grown = F.when(F.col("resets"), F.col("n1")).otherwise(F.col("n1") - F.col("n0"))
    seams = seams.withColumn("ended", F.sum(grown).over(Window.partitionBy(*_PAIR, "era").orderBy("span")))
    seams = seams.withColumn("counted", F.sum(F.col("k1") - F.col("k0")).over(order) - (F.col("k1") - F.col("k0")))
    seams = seams.select(*_GROUP, "k0", "counted", (F.coalesce(F.lag("ended").over(order), F.lit(0)) - F.col("n0")).alias("more"))
    rows = done.where("end is null").drop("begin", "end", "resets").join(seams, list(_GROUP))
    n = F.when(F.col("anew"), F.col("n")).otherwise(F.col("n") + F.col("more")).cast("int")
    return rows.withColumns({"k": F.col("k") - F.col("k0") + F.col("counted"), "n": n, "valid": n >= clock.VALID_AFTER}).select(*clock.HISTORY.names)
