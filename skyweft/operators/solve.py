"""Position solving of reception groups, with a position cache for each aircraft.

State is per aircraft, so groups are partitioned by address and sorted by time; a
partition's aircraft advance in lockstep: the k-th groups of all aircraft in an Arrow
batch are prepared, solved and checked together, as numpy arrays read from the batch's
own buffers. Only the caches (a few numbers an aircraft) outlive a batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.config import Config
from skyweft.functions.geo import C_VACUUM, FEET
from skyweft.operators import solver_np as S
from skyweft.schemas import FIX, GROUP

CACHE_AGE_S = 120.0
PREDICT_S = 60.0
MAX_PAIR_VARIANCE_S2 = 50e-12
DEFAULT_ALT_M = 10_000.0
#: An output row: a fix, a group passed on unsolved, or neither, with the reason.
RECORD = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("reason", T.StringType()),
        T.StructField("t_ns", T.LongType()),
        T.StructField("icao", T.StringType()),
        T.StructField("fix", FIX),
        T.StructField("unsolved_group", GROUP),
        T.StructField("sensor_ids", T.ArrayType(T.LongType())),
        T.StructField("sensor_residuals", T.ArrayType(T.DoubleType())),
    ]
)


class Slots:
    """Arrays with a row for each key, grown by doubling."""

    def __init__(self, **fields: tuple[int, ...]):
        self._of: dict[str, int] = {}
        self._shape = fields
        self.live = np.zeros(0, bool)
        self.t = np.zeros(0, np.int64)
        for k, shape in fields.items():
            setattr(self, k, np.zeros((0, *shape)))

    def __len__(self) -> int:
        return len(self._of)

    def of(self, keys: np.ndarray) -> np.ndarray:
        """Slots of distinct keys; new keys get one that is not live."""
        known = self._of
        out = np.fromiter((known.setdefault(k, len(known)) for k in keys), np.int64, len(keys))
        if len(known) > len(self.t):
            size = 2 * len(known)
            for k in ("live", "t", *self._shape):
                old = getattr(self, k)
                grown = np.zeros((size, *old.shape[1:]), old.dtype)
                grown[: len(old)] = old
                setattr(self, k, grown)
        return out

    def age(self, i: np.ndarray, t_ns: np.ndarray) -> np.ndarray:
        return (t_ns - self.t[i]) * 1e-9


class Cache(Slots):
    """What is known of each aircraft: last position and, apart from it, a velocity (NaN
    if unknown). A few numbers an address, of which there are at most 2^24."""

    def __init__(self):
        super().__init__(ecef=(3,), velocity=(3,), lat=(), lon=(), alt_m=(), residual=(), solves=())

    def seen(self, i: np.ndarray, t_ns: np.ndarray) -> np.ndarray:
        return self.live[i] & (np.abs(self.age(i, t_ns)) <= CACHE_AGE_S)

    def moving(self, i: np.ndarray) -> np.ndarray:
        return np.isfinite(self.velocity[i, 0])

    def predict(self, i: np.ndarray, t_ns: np.ndarray) -> np.ndarray:
        dt = self.age(i, t_ns)
        go = self.moving(i) & (dt > 0) & (dt < PREDICT_S)
        return self.ecef[i] + np.where(go[:, None], self.velocity[i] * dt[:, None], 0.0)

    def consistent(self, i: np.ndarray, x: np.ndarray, t_ns: np.ndarray, residual: np.ndarray) -> np.ndarray:
        """Whether moves are physically possible: speed, then miss of the prediction."""
        age = self.age(i, t_ns)
        dt = np.abs(age)
        safe = np.maximum(dt, 1e-3)
        slack = 2 * (self.residual[i] + residual)
        reach = np.maximum(0.0, np.linalg.norm(x - self.ecef[i], axis=1) - slack) / safe <= 1030.0
        off = np.linalg.norm(x - (self.ecef[i] + self.velocity[i] * age[:, None]), axis=1)
        most = np.maximum(np.maximum(25 * dt * dt + slack, np.where(self.solves[i] < 5, 10_000.0, 5_000.0)), 1.5 * slack)
        return (dt < 1e-3) | (reach & (~self.moving(i) | (dt <= 0.1) | (off <= most)))

    def put(self, i: np.ndarray, ecef, lat, lon, alt_m, t_ns, residual) -> None:
        dt = self.age(i, t_ns)
        known = self.live[i] & (dt > 0.1) & (dt < PREDICT_S)
        self.velocity[i] = np.where(known[:, None], (ecef - self.ecef[i]) / np.where(known, dt, 1.0)[:, None], np.nan)
        self.solves[i] = np.where(self.live[i], self.solves[i], 0) + 1
        self.ecef[i], self.lat[i], self.lon[i], self.alt_m[i], self.residual[i] = ecef, lat, lon, alt_m, residual
        self.t[i], self.live[i] = t_ns, True


def uncertainty(seen, moving, dt, residual) -> np.ndarray:
    """Metres by which a prior may be off: by its age, and more so without a velocity."""
    return np.where(seen, np.where(moving, np.maximum(50.0, 25 * dt * dt + residual), np.maximum(100.0, 300 * dt + residual)), 500.0)


def enu_vectors(lat, lon, e, n, u) -> np.ndarray:
    p, q = np.radians(lat), np.radians(lon)
    sp, cp, sl, cl = np.sin(p), np.cos(p), np.sin(q), np.cos(q)
    return np.stack([-sl * e - sp * cl * n + cp * cl * u, cl * e - sp * sl * n + cp * sl * u, cp * n + sp * u], axis=-1)


def lockstep(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Row numbers of the first rows of all keys, then of the second, and so on."""
    rank = pd.Series(keys).groupby(keys, sort=False).cumcount().to_numpy()
    order = np.argsort(rank, kind="stable")
    yield from np.split(order, np.flatnonzero(np.diff(rank[order])) + 1) if len(order) else ()


def numbers(column: pa.Array) -> np.ndarray:
    """Doubles of a column, NaN for null."""
    return column.cast(pa.float64()).to_numpy(zero_copy_only=False)


class Receptions:
    """A batch's receptions as flat arrays; groups of n have theirs at ``rows(i, n)``."""

    def __init__(self, column: pa.Array):
        self.size = np.nan_to_num(pc.list_value_length(column).to_numpy(zero_copy_only=False)).astype(np.int64)
        self.begin = np.cumsum(self.size) - self.size
        flat = column.flatten()
        self.sensor = flat.field("sensor_id")
        self.place = np.stack([numbers(flat.field(k)) for k in ("lat", "lon", "alt")], axis=1)
        self.ns = flat.field("timestamp_s").to_numpy(zero_copy_only=False).astype(np.int64) * 1_000_000_000 + flat.field("timestamp_ns").to_numpy(zero_copy_only=False).astype(np.int64)
        # a sensor's place is worked out once for each place that the batch holds
        places, which = np.unique(self.place, axis=0, return_inverse=True)
        self.ecef = S.lla_to_ecef(places[:, 0], places[:, 1], places[:, 2])[which.reshape(-1)]

    def rows(self, i: np.ndarray, n: int) -> np.ndarray:
        return self.begin[i][:, None] + np.arange(n)


class Solver:
    """Solves the groups of Arrow batches; ``cache`` lives as long as the partition."""

    def __init__(self, config: Config):
        self.config, self.cache = config, Cache()

    def batch(self, b: pa.RecordBatch) -> pa.RecordBatch:
        """RECORD rows of a batch of groups, in its order."""
        g = {k: b.column(k) for k in b.schema.names}
        n_rows = b.num_rows
        heard = Receptions(g["receptions"])
        codes, keys = pd.factorize(pc.fill_null(g["icao"], "").to_numpy(zero_copy_only=False))
        slot = self.cache.of(keys)[codes] if n_rows else np.zeros(0, np.int64)
        t = g["t_ns"].to_numpy(zero_copy_only=False).astype(np.int64)
        v = {k: numbers(g[k]) for k in ("altitude_ft", *EXTRA)}
        out = {k: np.full(n_rows, np.nan) for k in ("lat", "lon", "alt_ft", "residual", "quality", "gdop", "t0")}
        out |= {"kind": np.full(n_rows, None, object), "reason": np.full(n_rows, None, object), "method": np.full(n_rows, None, object)}
        out |= {"n": np.zeros(n_rows, np.int64), "first": np.zeros(n_rows, np.int64), "off": np.zeros(len(heard.ns)), "alt": v["altitude_ft"].copy()}
        for part in lockstep(codes):
            ready, cases = self._prepare(part, slot, t, v, heard.size, out)
            for n in np.unique(heard.size[ready]).tolist():
                same = heard.size[ready] == n
                self._solve(ready[same], n, slot, t, heard, {k: a[same] for k, a in cases.items()}, out)
        return self._records(b, g, heard, out)

    def _prepare(self, i: np.ndarray, slot, t, v, size, out) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Rows to be solved, with altitude, prior and uncertainty of each; records of the rest."""
        few = size[i] < 2
        out["kind"][i[few]], out["reason"][i[few]] = "skipped", "too_few_sensors"
        i = i[~few]
        if self.config.seed_prior_from_own_message:
            self._seed(i[np.isfinite(v["cpr_lat"][i])], slot, t, v)
        k, c = slot[i], self.cache
        seen = c.seen(k, t[i])
        told = seen & np.isfinite(v["vel_e"][i])
        j, m = k[told], i[told]
        c.velocity[j] = enu_vectors(c.lat[j], c.lon[j], v["vel_e"][m], v["vel_n"][m], v["vel_u"][m])
        alt = np.where(np.isfinite(v["altitude_ft"][i]), v["altitude_ft"][i], v["cpr_alt_ft"][i])
        alt = np.where(np.isfinite(alt) | ~seen, alt, np.floor(c.alt_m[k] / FEET + 0.5))
        out["alt"][i] = alt
        two = (size[i] == 2) & np.isfinite(alt)
        moving, least = c.moving(k), self.config.delegate_2sensor_min_solves
        reason = np.full(len(i), None, object)
        reason[two & (np.nan_to_num(v["pair_variance"][i]) > MAX_PAIR_VARIANCE_S2)] = "pair_variance_exceeded"
        if least > 0:
            reason[two & (c.solves[k] >= least) & moving & (c.residual[k] > 0)] = "delegated_2sensor_prediction"
        reason[two & ~seen] = "no_prior_2sensor"
        passed = reason != None  # noqa: E711  element by element
        out["kind"][i[passed]], out["reason"][i[passed]] = "unsolved_group", reason[passed]
        i, k, seen, alt, moving = (a[~passed] for a in (i, k, seen, alt, moving))
        dt = np.abs(c.age(k, t[i]))
        prior = np.where(seen[:, None], c.predict(k, t[i]), np.nan)
        return i, {"alt": alt * FEET, "prior": prior, "uncertainty": uncertainty(seen, moving, dt, c.residual[k]), "seen": seen}

    def _seed(self, i: np.ndarray, slot, t, v) -> None:
        """A decoded position message is the aircraft's position at its time."""
        k, lat, lon, alt = slot[i], v["cpr_lat"][i], v["cpr_lon"][i], v["cpr_alt_ft"][i] * FEET
        told = np.isfinite(alt)
        x = S.lla_to_ecef(lat, lon, np.where(told, alt, DEFAULT_ALT_M))
        known = np.where(told, alt, np.where(self.cache.seen(k, t[i]), self.cache.alt_m[k], DEFAULT_ALT_M))
        self.cache.put(k, x, lat, lon, known, t[i], np.zeros(len(i)))

    def _solve(self, i: np.ndarray, n: int, slot, t, heard: Receptions, case: dict, out: dict) -> None:
        at = heard.rows(i, n)
        stamps = heard.ns[at]
        first = stamps.min(1)
        s, rel, salt, alt = heard.ecef[at], (stamps - first[:, None]) * 1e-9, heard.place[at, 2], case["alt"]
        f = S.solve(s, rel, salt, alt, case["prior"], case["uncertainty"])
        lat, lon, h = S.ecef_to_lla(f["x"])
        alt_m = np.where(np.isfinite(alt), alt, h)
        x = S.lla_to_ecef(lat, lon, alt_m)
        fail = f["fail"].copy()
        ok = fail == None  # noqa: E711  element by element
        jump = ok & case["seen"] & ~self.cache.consistent(slot[i], x, t[i], f["quality"])
        fail[jump] = "physically_inconsistent"
        ok &= ~jump
        out["reason"][i] = fail
        out["kind"][i] = np.where(ok, "fix", np.where(~jump & np.isfinite(alt), "unsolved_group", "failed"))
        j = i[ok]
        self.cache.put(slot[j], x[ok], lat[ok], lon[ok], alt_m[ok], t[j], f["residual"][ok])
        for name, values in (("lat", lat), ("lon", lon), ("residual", f["residual"]), ("quality", f["quality"]), ("gdop", f["gdop"]), ("t0", f["t0"]), ("n", f["n"]), ("method", f["method"]), ("first", first)):
            out[name][j] = values[ok]
        out["alt_ft"][j] = np.where(np.isfinite(out["alt"][j]), out["alt"][j], alt_m[ok] / FEET)
        out["off"][at[ok]] = ((rel - f["t0"][:, None]) * C_VACUUM - np.linalg.norm(x[:, None] - s, axis=2))[ok]

    def _records(self, b: pa.RecordBatch, g: dict, heard: Receptions, out: dict) -> pa.RecordBatch:
        fixed, passed = out["kind"] == "fix", out["kind"] == "unsolved_group"
        double = lambda a: pa.array(a, pa.float64())
        fix = [
            g["icao"], double(out["lat"]), double(out["lon"]), double(out["alt_ft"]), double(out["residual"]), double(out["quality"]), double(out["gdop"]), pa.array(out["n"], pa.int32()),
            pa.array(out["method"], pa.string()), pa.array(out["first"] // 1_000_000_000), pa.array(out["first"] % 1_000_000_000), g["df_type"], g["squawk"], g["raw_msg"], double(out["t0"]),
        ]
        group = [g["icao"], g["df_type"], pa.array(out["alt"], pa.float64(), mask=~np.isfinite(out["alt"])), g["squawk"], g["raw_msg"], g["num_sensors"], g["receptions"]]
        offsets = np.append(0, np.cumsum(np.where(fixed, heard.size, 0))).astype(np.int32)
        mine = np.repeat(fixed, heard.size)
        lists = lambda flat: pa.ListArray.from_arrays(pa.array(offsets), flat, mask=pa.array(~fixed))
        arrow = arrow_schema(RECORD)
        cols = [
            pa.array(out["kind"], pa.string()), pa.array(out["reason"], pa.string()), g["t_ns"], g["icao"], structs(FIX, fix, ~fixed), structs(GROUP, group, ~passed),
            lists(heard.sensor.filter(pa.array(mine))), lists(double(out["off"][mine])),
        ]
        return pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(cols, arrow)], schema=arrow)


def arrow_schema(kind: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(kind)


def structs(kind: T.StructType, columns: list[pa.Array], null: np.ndarray) -> pa.StructArray:
    fields = list(arrow_schema(kind))
    return pa.StructArray.from_arrays([c.cast(f.type) for c, f in zip(columns, fields)], fields=fields, mask=pa.array(null))


#: Optional columns of a group and their types.
EXTRA = {"cpr_lat": "double", "cpr_lon": "double", "cpr_alt_ft": "double", "vel_e": "double", "vel_n": "double", "vel_u": "double", "pair_variance": "double"}
OWN = ("icao", "t_ns", "df_type", "altitude_ft", "squawk", "raw_msg", "num_sensors", "receptions")


def by_aircraft(groups: DataFrame) -> DataFrame:
    """What the solver reads, partitioned by aircraft and sorted by time: one shuffle.

    The number of partitions is given, so that small rows that cost much to solve are
    not coalesced by their bytes.
    """
    parts = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    extra = [F.col(c).cast(k) if c in groups.columns else F.lit(None).cast(k).alias(c) for c, k in EXTRA.items()]
    return groups.select(*OWN, *extra).repartition(parts, "icao").sortWithinPartitions("t_ns", "icao", "raw_msg")


def solve_groups(groups: DataFrame, config: Config = Config()) -> DataFrame:
    """RECORD rows, one a group: fixes, groups passed on, failures with reasons.

    One shuffle, by aircraft. Needs ``t_ns``; the columns in EXTRA are used if there.
    """

    def run(batches):
        solver = Solver(config)
        for b in batches:
            if b.num_rows:
                yield solver.batch(b)

    return by_aircraft(groups).mapInArrow(run, RECORD)


def fixes(records: DataFrame) -> DataFrame:
    return records.where("kind = 'fix'").select(*[F.col(f"fix.{f.name}") for f in FIX.fields])
