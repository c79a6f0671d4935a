"""Kalman tracks: a constant-velocity filter for each aircraft, in lockstep.

Records (fixes and unsolved groups) are partitioned by aircraft and sorted by time.
All aircraft of a partition advance together: predictions, gates and updates of the
k-th records of an Arrow batch are one set of batched matrix operations.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from skyweft.config import Config
from skyweft.functions.geo import FEET, FPM, KNOTS
from skyweft.operators import solver_np as S
from skyweft.operators.solve import Receptions, Slots, Solver, arrow_schema, by_aircraft, lockstep, numbers
from skyweft.schemas import TRACK

GATE = 14.16
MAX_QUALITY_2SENSOR = 50.0
DEFAULT_NOISE = 200.0
ACCEL_VAR = 25.0
#: Over longer gaps a state is not moved, but its variances grow by GAP_VAR.
MAX_PREDICT_S, GAP_VAR = 60.0, 1e6
STALE_S = 300.0
HISTORY = 100


class Filters(Slots):
    """States of the filters by slot: x [k, 6], p [k, 6, 6], times and counts."""

    def __init__(self):
        super().__init__(x=(6,), p=(6, 6), n=(), positions=())
        self.squawk = np.zeros(0, object)

    def of(self, keys: np.ndarray) -> np.ndarray:
        out = super().of(keys)
        if len(self.squawk) < len(self.t):
            self.squawk = np.append(self.squawk, np.full(len(self.t) - len(self.squawk), None, object))
        return out

    def start(self, i: np.ndarray, pos: np.ndarray, t_ns: np.ndarray) -> None:
        """New tracks, or stale ones anew in the same slots."""
        self.x[i] = np.concatenate([pos, np.zeros_like(pos)], axis=1)
        self.p[i] = np.diag([DEFAULT_NOISE**2] * 3 + [1e6] * 3)
        self.t[i], self.n[i], self.positions[i], self.live[i] = t_ns, 1, 1, True
        self.squawk[i] = None

    def predict(self, i: np.ndarray, t_ns: np.ndarray) -> None:
        """Advance to the times; earlier ones leave the state alone. Over a gap the state
        stays where it is and becomes unsure by GAP_VAR all over."""
        dt = (t_ns - self.t[i]) * 1e-9
        gap = i[dt > MAX_PREDICT_S]
        self.p[gap] += GAP_VAR * np.eye(6)
        self.t[gap] = t_ns[dt > MAX_PREDICT_S]
        go = (dt > 0) & (dt <= MAX_PREDICT_S)
        i, dt, t_ns = i[go], dt[go], t_ns[go]
        if not len(i):
            return
        f = np.tile(np.eye(6), (len(i), 1, 1))
        f[:, [0, 1, 2], [3, 4, 5]] = dt[:, None]
        q = np.zeros((len(i), 6, 6))
        for k in range(3):
            q[:, k, k], q[:, k + 3, k + 3] = ACCEL_VAR * dt**4 / 4, ACCEL_VAR * dt**2
            q[:, k, k + 3] = q[:, k + 3, k] = ACCEL_VAR * dt**3 / 2
        self.x[i] = (f @ self.x[i][..., None])[..., 0]
        self.p[i] = f @ self.p[i] @ f.transpose(0, 2, 1) + q
        self.t[i] = t_ns

    def update(self, i: np.ndarray, pos: np.ndarray, noise: np.ndarray) -> np.ndarray:
        """Gated updates in Joseph form; whether each was accepted."""
        y = pos - self.x[i, :3]
        r = noise[:, None, None] ** 2 * np.eye(3)
        inv = np.linalg.inv(self.p[i][:, :3, :3] + r)
        ok = np.einsum("gi,gij,gj->g", y, inv, y) <= GATE
        j, y, r, inv = i[ok], y[ok], r[ok], inv[ok]
        k = self.p[j][:, :, :3] @ inv
        self.x[j] += (k @ y[..., None])[..., 0]
        a = np.tile(np.eye(6), (len(j), 1, 1))
        a[:, :, :3] -= k
        p = a @ self.p[j] @ a.transpose(0, 2, 1) + k @ r @ k.transpose(0, 2, 1)
        self.p[j] = (p + p.transpose(0, 2, 1)) / 2
        self.n[j] += 1
        self.positions[j] = np.minimum(self.positions[j] + 1, HISTORY)
        return ok


def noise(n: np.ndarray, q: np.ndarray, gdop: np.ndarray) -> np.ndarray:
    """Measurement noise of fixes by sensors, quality and geometry."""
    two = np.clip(np.where(gdop > 0, q * gdop * 3, q * 8), 500.0, 3000.0)
    more = np.clip(np.where(gdop > 0, q * gdop, q * 2), 50.0, 2000.0)
    return np.where(n == 2, two, np.where(q > 0, more, DEFAULT_NOISE))


class Tracker:
    def __init__(self):
        self.f = Filters()
        self.counts = {k: 0 for k in ("received", "accepted", "rejected", "rejected_quality", "created", "aided")}

    def batch(self, b: pa.RecordBatch) -> pa.RecordBatch:
        """TRACK rows of the accepted records of a batch, in its order."""
        return self.numbered(b)[0]

    def numbered(self, b: pa.RecordBatch) -> tuple[pa.RecordBatch, np.ndarray]:
        """TRACK rows of the accepted records of a batch, and which records these are."""
        n = b.num_rows
        fix, group = b.column("fix"), b.column("unsolved_group")
        fixed = fix.is_valid().to_numpy(zero_copy_only=False)
        passed = group.is_valid().to_numpy(zero_copy_only=False) & ~fixed
        fix_of, group_of = (dict(zip((f.name for f in c.type), c.flatten())) for c in (fix, group))
        codes, keys = pd.factorize(pc.fill_null(b.column("icao"), "").to_numpy(zero_copy_only=False))
        slot = self.f.of(keys)[codes] if n else np.zeros(0, np.int64)
        w = {k: np.where(fixed, np.nan_to_num(numbers(fix_of[c])), 0.0) for k, c in (("lat", "lat"), ("lon", "lon"), ("alt", "alt_ft"), ("residual", "residual_m"), ("quality", "quality_residual_m"), ("gdop", "gdop"), ("n", "num_sensors"), ("t0", "t0_s"))}
        whole = lambda c: np.nan_to_num(c.to_numpy(zero_copy_only=False)).astype(np.int64)
        w["t"] = np.where(fixed, whole(fix_of["timestamp_s"]) * 1_000_000_000 + whole(fix_of["timestamp_ns"]), 0)
        pick = lambda k: pc.if_else(pa.array(fixed), fix_of[k], group_of[k])
        own = {k: pick(k) for k in ("icao", "df_type", "squawk", "raw_msg")}
        w["method"], w["squawk"] = fix_of["solve_method"].to_numpy(zero_copy_only=False).astype(object), own["squawk"].to_numpy(zero_copy_only=False).astype(object)
        w["feet"] = numbers(group_of["altitude_ft"])
        named = pc.fill_null(pc.not_equal(own["icao"], ""), False).to_numpy(zero_copy_only=False)
        heard = Receptions(group_of["receptions"])
        w |= {k: np.zeros((n, *shape)) for k, shape in (("out_lat", ()), ("out_lon", ()), ("heading", ()), ("speed", ()), ("climb", ()), ("updates", ()), ("positions", ()), ("cov", (4,)))}
        done = np.zeros(n, bool)
        for part in lockstep(codes):
            mine = np.concatenate([part[fixed[part]], self._aided(part[passed[part]], slot, heard, w)])
            mine = self._fixes(mine[named[mine]], slot, w)
            self._output(mine, slot, w)
            done[mine] = True
        return self._tracks(own, w, done), np.flatnonzero(done)

    def _fixes(self, i: np.ndarray, slot: np.ndarray, w: dict) -> np.ndarray:
        """The rows of those fixes that start a track or that theirs accepts."""
        self.counts["received"] += len(i)
        good = ~((w["n"][i] == 2) & (w["quality"][i] > MAX_QUALITY_2SENSOR))
        self.counts["rejected_quality"] += int((~good).sum())
        i = i[good]
        k, t = slot[i], w["t"][i]
        pos = S.lla_to_ecef(w["lat"][i], w["lon"][i], w["alt"][i] * FEET)
        new = ~self.f.live[k] | (self.f.age(k, t) > STALE_S)  # a stale track begins anew
        self.f.start(k[new], pos[new], t[new])
        old = ~new
        accepted = new.copy()
        self.f.predict(k[old], t[old])
        accepted[old] = self.f.update(k[old], pos[old], noise(w["n"][i[old]], w["quality"][i[old]], w["gdop"][i[old]]))
        self.counts["created"] += int(new.sum())
        self.counts["accepted"] += int(accepted.sum())
        self.counts["rejected"] += int((~accepted).sum())
        i = i[accepted]
        told = np.array([bool(s) for s in w["squawk"][i]], bool)
        self.f.squawk[slot[i[told]]] = w["squawk"][i[told]]
        return i

    def _aided(self, i: np.ndarray, slot: np.ndarray, heard: Receptions, w: dict) -> np.ndarray:
        """Rows of unsolved groups that are solved around their established track's prediction."""
        i = i[self.f.live[slot[i]] & (self.f.n[slot[i]] >= 2) & np.isfinite(w["feet"][i]) & (heard.size[i] >= 2)]
        solved = [i[:0]]
        for n in np.unique(heard.size[i]).tolist():
            j = i[heard.size[i] == n]
            at = heard.rows(j, n)
            stamps = heard.ns[at]
            first, k = stamps.min(1), slot[j]
            self.f.predict(k, first)  # the filter stays there whatever comes of the group
            around = self.f.x[k, :3]
            u = np.sqrt(np.trace(self.f.p[k][:, :3, :3], axis1=1, axis2=2))
            s, rel, salt, alt = heard.ecef[at], (stamps - first[:, None]) * 1e-9, heard.place[at, 2], w["feet"][j] * FEET
            weight = S.prior_weight(u)
            r = S.toa(around.copy(), s, rel, salt, alt, around, weight, 50)
            offset = np.linalg.norm(r["x"] - around, axis=1)
            ok = r["ok"] & (r["residual"] <= np.clip(u * 0.5, 100.0, 500.0)) & (offset <= np.clip(3 * u, 500.0, 5000.0))
            every, _ = S.rows(r["x"], s, rel, S.speeds(salt, alt), alt, around, weight)
            lat, lon, _ = S.ecef_to_lla(r["x"])
            m = j[ok]
            for name, values in (("lat", lat), ("lon", lon), ("alt", w["feet"][j]), ("residual", r["residual"]), ("quality", np.sqrt((every**2).mean(1))), ("t0", r["t0"]), ("t", first)):
                w[name][m] = values[ok]
            w["gdop"][m], w["n"][m], w["method"][m] = 0.0, n, f"prediction_aided_{n}sensor"
            self.counts["aided"] += len(m)
            solved.append(m)
        return np.concatenate(solved)

    def _output(self, i: np.ndarray, slot: np.ndarray, w: dict) -> None:
        k = slot[i]
        x, p = self.f.x[k], self.f.p[k]
        lat, lon, _ = S.ecef_to_lla(x[:, :3])
        v, cov = local_motion(lat, lon, x[:, 3:], p[:, :3, :3])
        ground = np.hypot(v[:, 0], v[:, 1])
        w["out_lat"][i], w["out_lon"][i] = lat, lon
        w["heading"][i] = np.where(ground < 1.0, 0.0, np.degrees(np.arctan2(v[:, 0], v[:, 1])) % 360)
        w["speed"][i], w["climb"][i], w["updates"][i], w["positions"][i] = ground * KNOTS, v[:, 2] * FPM, self.f.n[k], self.f.positions[k]
        w["cov"][i] = cov.reshape(-1, 4)
        w["squawk"][i] = self.f.squawk[k]

    def _tracks(self, own: dict, w: dict, done: np.ndarray) -> pa.RecordBatch:
        i = np.flatnonzero(done)
        arrow = arrow_schema(TRACK)
        took = {k: c.take(pa.array(i)) for k, c in own.items()}
        flat = pa.array(w["cov"][i].reshape(-1))
        cov = pa.ListArray.from_arrays(pa.array(np.arange(0, 2 * len(i) + 1, 2), pa.int32()), pa.ListArray.from_arrays(pa.array(np.arange(0, 4 * len(i) + 1, 2), pa.int32()), flat))
        of = {
            "icao": took["icao"], "lat": w["out_lat"][i], "lon": w["out_lon"][i], "alt_ft": w["alt"][i], "residual_m": w["residual"][i], "quality_residual_m": w["quality"][i], "gdop": w["gdop"][i],
            "num_sensors": w["n"][i].astype(np.int64), "solve_method": w["method"][i], "timestamp_s": w["t"][i] // 1_000_000_000, "timestamp_ns": w["t"][i] % 1_000_000_000, "df_type": took["df_type"],
            "squawk": w["squawk"][i], "raw_msg": took["raw_msg"], "t0_s": w["t0"][i], "heading_deg": w["heading"][i], "speed_kts": w["speed"][i], "vrate_fpm": w["climb"][i],
            "track_quality": w["updates"][i].astype(np.int64), "positions_count": w["positions"][i].astype(np.int64), "cov_matrix": cov,
        }
        return pa.RecordBatch.from_arrays([c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c).cast(f.type) for c, f in ((of[f.name], f) for f in arrow)], schema=arrow)


def local_motion(lat, lon, v: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """East, north and up of velocities, and the east-north part of covariances."""
    phi, lam = np.radians(lat), np.radians(lon)
    sp, cp, sl, cl = np.sin(phi), np.cos(phi), np.sin(lam), np.cos(lam)
    r = np.stack([np.stack([-sl, cl, 0 * sl], 1), np.stack([-sp * cl, -sp * sl, cp], 1), np.stack([cp * cl, cp * sl, sp], 1)], 1)
    return (r @ v[..., None])[..., 0], (r @ p @ r.transpose(0, 2, 1))[:, :2, :2]


def tracks(records: DataFrame) -> DataFrame:
    """TRACK rows, one for each accepted fix, of records (t_ns, icao, fix, unsolved_group).

    One shuffle, by aircraft; :func:`solved_tracks` does without a second one.
    """
    src = records.where("fix is not null or unsolved_group is not null").select("t_ns", "icao", "fix", "unsolved_group").repartition("icao").sortWithinPartitions("t_ns", "icao")

    def run(batches):
        tracker = Tracker()
        for b in batches:
            if b.num_rows:
                yield tracker.batch(b)

    return src.mapInArrow(run, TRACK)


def solved_tracks(groups: DataFrame, config: Config = Config()) -> DataFrame:
    """TRACK rows of groups, solved and tracked in one pass after one shuffle."""

    def run(batches):
        solver, tracker = Solver(config), Tracker()
        for b in batches:
            if b.num_rows:
                yield tracker.batch(solver.batch(b))

    return by_aircraft(groups).mapInArrow(run, TRACK)
