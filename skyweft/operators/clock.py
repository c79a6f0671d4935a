"""Sensor clock calibration: an offset and drift filter for each pair of sensors.

Reference positions give each pair of receptions a measured clock difference. Pairs
are partitioned by their two sensors and filtered in time order; the history of states
is joined back to groups as of their times, and a spanning tree of least variance
corrects each group's times.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.functions import geo
from skyweft.operators.joins import reception_pairs
from skyweft.schemas import struct

R, Q_DRIFT, GATE_SIGMA, RESET_AFTER, VALID_AFTER = 25e-12, 1e-18, 3.5, 5, 3
MAX_CORRECTION_S = 0.5
#: Fixes of this quality residual or more do not train clocks.
OWN_QUALITY_M = 200.0
#: Look-ups of a pair's offset are worked through in spans of so much time.
LOOKUP_SPAN_NS = 60_000_000_000

#: ``k`` numbers a pair's measurements.
HISTORY = struct("sensor_a BIGINT, sensor_b BIGINT, t_ns BIGINT, k BIGINT, offset DOUBLE, drift DOUBLE, variance DOUBLE, n INT, valid BOOLEAN, accepted BOOLEAN, innovation DOUBLE")


def difference(a: str, b: str, ecef: str) -> Column:
    """Clock difference of two receptions in seconds, ranges to ``ecef`` taken off.

    Times are compared as integers before they become seconds.
    """
    ns = lambda r: F.col(f"{r}.timestamp_s") * F.lit(1_000_000_000).cast("long") + F.col(f"{r}.timestamp_ns")
    far = lambda r: geo.distance(F.col(ecef), geo.lla_to_ecef(F.col(f"{r}.lat"), F.col(f"{r}.lon"), F.col(f"{r}.alt")))
    return (ns(a) - ns(b)).cast("double") * 1e-9 - (far(a) - far(b)) / geo.C_AIR


def measurements(groups: DataFrame) -> DataFrame:
    """sensor_a < sensor_b, t_ns and the clock difference a - b in seconds.

    ``groups``: t_ns, ecef (the reference position) and receptions.
    """
    pairs = reception_pairs(groups, ["t_ns", "ecef"]).where("a.sensor_id <> b.sensor_id")
    return pairs.select(F.col("a.sensor_id").alias("sensor_a"), F.col("b.sensor_id").alias("sensor_b"), "t_ns", difference("a", "b", "ecef").alias("measured"))


STATE = "offset DOUBLE, drift DOUBLE, p00 DOUBLE, p01 DOUBLE, p11 DOUBLE, n BIGINT, run BIGINT, t_ns BIGINT, k BIGINT"


class PairFilter:
    """Offset and drift of one pair. A handful of sums a measurement: as there are far
    more measurements than pairs, plain floats beat arrays over the pairs."""

    __slots__ = ("offset", "drift", "p00", "p01", "p11", "n", "run", "t_ns", "k", "innovation")

    def __init__(self):
        self.n = self.k = 0

    @property
    def valid(self) -> bool:
        return self.n >= VALID_AFTER

    def state(self) -> tuple:
        """All that the next measurement needs: STATE."""
        return self.offset, self.drift, self.p00, self.p01, self.p11, self.n, self.run, self.t_ns, self.k

    @classmethod
    def of(cls, state: tuple) -> PairFilter:
        f = cls()
        f.offset, f.drift, f.p00, f.p01, f.p11, f.n, f.run, f.t_ns, f.k = state
        f.innovation = None
        return f

    def at(self, t_ns: int) -> float:
        """The offset that the state predicts for a time."""
        return self.offset + self.drift * ((t_ns - self.t_ns) * 1e-9)

    def start(self, t_ns: int, z: float) -> None:
        self.offset, self.drift, self.p00, self.p01, self.p11 = z, 0.0, 100 * R, 0.0, 1e-12
        self.n, self.run, self.t_ns, self.innovation = 1, 0, t_ns, None

    def update(self, t_ns: int, z: float) -> bool:
        """Whether the measurement was accepted (also as a new start)."""
        self.k += 1
        if not self.n:
            self.start(t_ns, z)
            return True
        dt = (t_ns - self.t_ns) * 1e-9
        if dt > 0:
            self.offset += self.drift * dt
            self.p00 += 2 * dt * self.p01 + dt * dt * self.p11 + Q_DRIFT * dt**3 / 3
            self.p01 += dt * self.p11 + Q_DRIFT * dt * dt / 2
            self.p11 += Q_DRIFT * dt
            self.t_ns = t_ns
        y, total = z - self.offset, self.p00 + R
        self.innovation = y
        if self.n >= VALID_AFTER and y * y > GATE_SIGMA**2 * total:
            self.run += 1
            if self.run < RESET_AFTER:
                return False
            self.start(t_ns, z)
            return True
        k0, k1 = self.p00 / total, self.p01 / total
        a, p00, p01 = 1 - k0, self.p00, self.p01
        self.offset += k0 * y
        self.drift += k1 * y
        self.p11 += k1 * k1 * (p00 + R) - 2 * k1 * p01
        self.p01 = a * (p01 - k1 * p00) + k0 * k1 * R
        self.p00 = a * a * p00 + k0 * k0 * R
        self.n += 1
        self.run = 0
        return True


def offsets(measured: DataFrame) -> DataFrame:
    """HISTORY rows: each pair's filter after each measurement. One shuffle, by pair."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(HISTORY)
    src = measured.select("sensor_a", "sensor_b", "t_ns", "measured").repartition("sensor_a", "sensor_b").sortWithinPartitions("t_ns", "sensor_a", "sensor_b", "measured")

    def run(batches):
        filters: dict[tuple, PairFilter] = {}
        for b in batches:
            rows = []
            for a, c, t, z in zip(*[b.column(i).to_pylist() for i in range(4)]):
                f = filters.get((a, c))
                if f is None:
                    f = filters[a, c] = PairFilter()
                ok = f.update(t, z)
                rows.append((a, c, t, f.k, f.offset, f.drift, f.p00, f.n, f.valid, ok, f.innovation))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows), arrow)], schema=arrow)

    return src.mapInArrow(run, HISTORY)


def innovations(history: DataFrame) -> DataFrame:
    """Number, median and 95th percentile of each pair's innovations (starts have none)."""
    from skyweft.operators.aggregates import order_statistics

    return order_statistics(history.select("sensor_a", "sensor_b", "innovation"), "innovation", ["sensor_a", "sensor_b"])


def pair_table(history: DataFrame, most: int = 10) -> DataFrame:
    """The latest state of the first ``most`` pairs: microseconds, ppm, square microseconds."""
    last = history.groupBy("sensor_a", "sensor_b").agg(F.max_by(F.struct("offset", "drift", "variance", "n", "valid"), F.struct("t_ns", "k") if "k" in history.columns else F.col("t_ns")).alias("s"))
    out = last.select("sensor_a", "sensor_b", (F.col("s.offset") * 1e6).alias("offset_us"), (F.col("s.drift") * 1e6).alias("drift_ppm"), (F.col("s.variance") * 1e12).alias("variance_us2"), "s.n", "s.valid")
    return out.orderBy("sensor_a", "sensor_b").limit(most)


@np.errstate(invalid="ignore")
def corrections(variance: np.ndarray, offset: np.ndarray) -> np.ndarray:
    """Seconds to add to each reception of groups of equal size [g, n].

    ``variance`` and ``offset`` [g, n, n] are of the pairs of receptions, infinite where
    there is no valid one; ``offset`` [i, j] is what j's time takes to be as i's. From the
    node of most pairs (of ties the first) along the spanning tree of least variance, all
    groups at once; of equal variances the first node's, then to the first.
    """
    g, n = variance.shape[:2]
    k = np.arange(g)
    there = np.isfinite(variance)
    cost = np.where(there, np.maximum(variance, 1e-20), np.inf)
    out, seen = np.zeros((g, n)), np.zeros((g, n), bool)
    seen[k, there.sum(2).argmax(1)] = True
    for _ in range(n - 1):
        step = np.where(seen[:, :, None] & ~seen[:, None, :], cost, np.inf).reshape(g, -1)
        best = step.argmin(1)
        go = np.isfinite(step[k, best])
        if not go.any():
            break
        i, j, r = best[go] // n, best[go] % n, k[go]
        out[r, j] = out[r, i] + offset[r, i, j]
        seen[r, j] = True
    return np.where(np.abs(out) <= MAX_CORRECTION_S, out, 0.0)


def corrected_batch(b: pa.RecordBatch, arrow: pa.Schema) -> pa.RecordBatch:
    """A batch's groups at corrected times, worked out on its flat buffers by group size.

    ``__pairs`` lists each group's valid pairs: sensor_a, sensor_b, offset, variance.
    """
    lists, pairs = b.column("receptions"), b.column("__pairs")
    length = lambda c: np.nan_to_num(pc.list_value_length(c).to_numpy(zero_copy_only=False)).astype(np.int64)
    size, found = length(lists), length(pairs)
    begin = np.cumsum(size) - size
    heard, seen = lists.flatten(), pairs.flatten()
    number = lambda c, k: c.field(k).to_numpy(zero_copy_only=False)
    sensor = number(heard, "sensor_id")
    ns = number(heard, "timestamp_s").astype(np.int64) * 1_000_000_000 + number(heard, "timestamp_ns").astype(np.int64)
    lo, hi, off, var = (number(seen, k) for k in ("sensor_a", "sensor_b", "offset", "variance"))
    of = np.repeat(np.arange(len(size)), found)
    sure = np.full(len(size), np.nan)
    for n in np.unique(size[found > 0]).tolist():
        mine = np.flatnonzero((size == n) & (found > 0))
        at = begin[mine][:, None] + np.arange(n)
        row = np.full(len(size), -1)
        row[mine] = np.arange(len(mine))
        p = np.flatnonzero(row[of] >= 0)
        r = row[of[p]]
        first, second = sensor[at][r] == lo[p][:, None], sensor[at][r] == hi[p][:, None]
        q, i, j = np.nonzero(first[:, :, None] & second[:, None, :])
        variance, offset = np.full((len(mine), n, n), np.inf), np.zeros((len(mine), n, n))
        variance[r[q], i, j] = variance[r[q], j, i] = var[p][q]
        offset[r[q], i, j], offset[r[q], j, i] = off[p][q], -off[p][q]
        c = corrections(variance, offset) * 1e9
        ns[at] += np.trunc(c + np.copysign(0.5, c)).astype(np.int64)
        if n == 2:
            sure[mine] = np.where(np.isfinite(variance[:, 0, 1]), variance[:, 0, 1], np.nan)
    kind = arrow.field("receptions").type.value_type
    new = {"timestamp_s": pa.array(ns // 1_000_000_000), "timestamp_ns": pa.array(ns % 1_000_000_000)}
    flat = pa.StructArray.from_arrays([new.get(f.name, heard.field(f.name)).cast(f.type) for f in kind], fields=list(kind))
    moved = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), flat, mask=pc.is_null(lists))
    made = {"receptions": moved, "pair_variance": pa.array(sure, pa.float64(), mask=np.isnan(sure)), "calibrated": pa.array(found > 0)}
    return pa.RecordBatch.from_arrays([made[f.name].cast(f.type) if f.name in made else b.column(f.name).cast(f.type) for f in arrow], schema=arrow)


def corrected(groups: DataFrame, history: DataFrame) -> DataFrame:
    """``groups`` with corrected reception times, ``pair_variance`` of two-sensor ones, and
    ``calibrated``: whether any of its pairs had a valid state.

    Each pair of a group's sensors looks up its filter's last state as of the group's
    time. A state that is not valid (a pair just begun or reset) takes part in the
    look-up and is then no pair, so that it hides the states before it. The look-ups come
    back as one list a group.
    """
    from skyweft.operators.joins import as_of

    group = ["icao", "raw_msg", "t_ns"]
    pairs = reception_pairs(groups, group).select(*group, F.col("a.sensor_id").alias("sensor_a"), F.col("b.sensor_id").alias("sensor_b"))
    key = F.struct("sensor_a", "sensor_b")
    take = ["k", "offset", "drift", "variance", "valid"]  # of states of one time the latest
    found = as_of(pairs.withColumn("pair", key), history.withColumn("pair", key).select("pair", "t_ns", *take), "pair", "t_ns", ["icao", "raw_msg"], take, F.lit(2**62), LOOKUP_SPAN_NS)
    now = F.col("prior_offset") + F.col("prior_drift") * (F.col("age").cast("double") * 1e-9)
    found = found.where("prior_valid")
    by = found.groupBy(*group).agg(F.collect_list(F.struct("sensor_a", "sensor_b", now.alias("offset"), F.col("prior_variance").alias("variance"))).alias("__pairs"))
    both = groups.join(by, group, "left").select(*groups.columns, "__pairs")
    schema = T.StructType([*groups.schema.fields, T.StructField("pair_variance", T.DoubleType()), T.StructField("calibrated", T.BooleanType())])
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)

    def run(batches):
        for b in batches:
            if b.num_rows:
                yield corrected_batch(b, arrow)

    return both.mapInArrow(run, schema)


def own_references(records: DataFrame, groups: DataFrame, calibrated: DataFrame) -> DataFrame:
    """t_ns, ecef and the uncorrected receptions of groups whose fix may train the clocks: of
    good quality, with a pair of sensors whose clocks were known.

    ``groups`` are those before, ``calibrated`` those after :func:`corrected`.
    """
    key = ["icao", "raw_msg", "t_ns"]
    good = records.where(F.col("fix.quality_residual_m") < OWN_QUALITY_M).select("icao", "fix.raw_msg", "t_ns", geo.lla_to_ecef("fix.lat", "fix.lon", F.col("fix.alt_ft") * geo.FEET).alias("ecef"))
    known = calibrated.where("calibrated").select(*key)
    return groups.select(*key, "receptions").join(good, key).join(known, key, "left_semi").select("t_ns", "ecef", "receptions")
