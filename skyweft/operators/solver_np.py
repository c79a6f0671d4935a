"""Time-of-arrival solving in numpy, batched over groups with equal sensor counts.

Every function takes a leading group axis. Positions are ECEF metres, times seconds
relative to the earliest reception. Unknown altitudes and priors are NaN.
"""

from __future__ import annotations

import numpy as np

from skyweft.functions.geo import A, B, C_VACUUM, DECAY, E2, EP2, REFRACTIVITY

SOFT, ALT_WEIGHT = 500.0, 10.0
MAX_RANGE_M, OUTLIER_M = 500_000.0, 3000.0
MAX_GDOP, MAX_GDOP_2D = 20.0, 10.0
PIVOT = 1e-15
#: Share of the cost that its own rounding may make up.
ROUNDING = 1e-11


def lla_to_ecef(lat, lon, alt) -> np.ndarray:
    phi, lam = np.radians(lat), np.radians(lon)
    n = A / np.sqrt(1 - E2 * np.sin(phi) ** 2)
    return np.stack([(n + alt) * np.cos(phi) * np.cos(lam), (n + alt) * np.cos(phi) * np.sin(lam), (n * (1 - E2) + alt) * np.sin(phi)], axis=-1)


def _vertical(x: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sine and cosine of latitude and longitude, prime radius and height, without angles."""
    p = np.hypot(x[..., 0], x[..., 1])
    z = x[..., 2]
    za, pb = z * A, p * B
    hyp = np.maximum(np.hypot(za, pb), 1e-300)
    rise, run = z + EP2 * B * (za / hyp) ** 3, p - E2 * A * (pb / hyp) ** 3
    sin = rise / np.maximum(np.hypot(rise, run), 1e-300)
    rise = z + E2 * A / np.sqrt(1 - E2 * sin * sin) * sin
    hyp = np.maximum(np.hypot(rise, p), 1e-300)
    sin, cos = rise / hyp, p / hyp
    n = A / np.sqrt(1 - E2 * sin * sin)
    flat = p > 0
    safe = np.where(flat, p, 1.0)
    height = np.where(cos > 1e-10, p / np.maximum(cos, 1e-10) - n, np.abs(z) - B)
    return sin, cos, np.where(flat, x[..., 1] / safe, 0.0), np.where(flat, x[..., 0] / safe, 1.0), n, height


def ecef_to_lla(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    sin, cos, _, _, _, height = _vertical(x)
    return np.degrees(np.arctan2(sin, cos)), np.degrees(np.arctan2(x[..., 1], x[..., 0])), height


def speeds(sensor_alt: np.ndarray, alt: np.ndarray) -> np.ndarray:
    """Light's mean speed from each sensor to the aircraft; in vacuum without altitude."""
    ha = np.where(np.isfinite(alt), alt, 0.0)[:, None]
    dh = ha - sensor_alt
    flat = np.abs(dh) < 1.0
    safe = np.where(flat, 1.0, dh)
    e = np.exp(-DECAY * sensor_alt)
    corr = np.where(flat, REFRACTIVITY * e, REFRACTIVITY / (DECAY * safe) * (e - np.exp(-DECAY * ha)))
    return np.where(np.isfinite(alt)[:, None], C_VACUUM / (1 + corr), C_VACUUM)


def timing(x: np.ndarray, s: np.ndarray, t: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Residuals in metres, their Jacobian, and the emission time they imply."""
    d = x[:, None, :] - s
    r = np.linalg.norm(d, axis=2)
    u = d / np.maximum(r, 1e-9)[..., None]
    t0 = (t - r / v).mean(1)
    j = (v / t.shape[1])[..., None] * (u / v[..., None]).sum(1)[:, None, :] - u
    return (t - t0[:, None]) * v - r, j, t0


def rows(x, s, t, v, alt, prior, weight) -> tuple[np.ndarray, np.ndarray]:
    """All residual rows and their Jacobian: timing, altitude, three of the prior."""
    return _rows(x, s, t, v, np.isfinite(alt), np.nan_to_num(alt), *_pull(prior, weight))


def _pull(prior: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Priors and weights of their rows; unknown priors weigh nothing."""
    has = np.isfinite(prior).all(1)
    return np.where(has[:, None], prior, 0.0), np.where(has, weight, 0.0)


def _rows(x, s, t, v, known, alt, prior, weight) -> tuple[np.ndarray, np.ndarray]:
    g, n = t.shape
    r, j = np.empty((g, n + 4)), np.zeros((g, n + 4, 3))
    d = x[:, None, :] - s
    far = np.sqrt(np.einsum("gnk,gnk->gn", d, d))
    q = d / (np.maximum(far, 1e-9) * v)[..., None]
    late = t - far / v
    r[:, :n] = (late - (late.sum(1) / n)[:, None]) * v
    j[:, :n] = ((q.sum(1) / n)[:, None] - q) * v[..., None]
    sin, cos, sl, cl, _, height = _vertical(x)
    a = np.where(known, ALT_WEIGHT, 0.0)
    r[:, n] = a * (height - alt)
    j[:, n, 0], j[:, n, 1], j[:, n, 2] = a * cos * cl, a * cos * sl, a * sin
    r[:, n + 1 :] = weight[:, None] * (x - prior)
    for k in range(3):
        j[:, n + 1 + k, k] = weight
    return r, j


def cost(r: np.ndarray) -> np.ndarray:
    return (2 * SOFT**2 * (np.sqrt(1 + (r / SOFT) ** 2) - 1)).sum(1)


def solve3(m: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Solutions of 3 x 3 systems and whether they are regular: no pivot under PIVOT.

    Gaussian elimination with row exchanges, over all systems at once.
    """
    a = np.concatenate([m, b[..., None]], axis=2)
    ok = np.isfinite(a).all((1, 2))
    a[~ok] = np.eye(3, 4)
    i = np.arange(len(a))
    for k in range(3):
        top = k + np.abs(a[:, k:, k]).argmax(1)
        a[i, k], a[i, top] = a[i, top], a[i, k]
        pivot = a[:, k, k]
        fine = np.abs(pivot) > PIVOT
        ok &= fine
        a[:, k] /= np.where(fine, pivot, 1.0)[:, None]
        for other in range(k + 1, 3):
            a[:, other] -= a[:, other, k : k + 1] * a[:, k]
    z = a[:, 2, 3]
    y = a[:, 1, 3] - a[:, 1, 2] * z
    return np.stack([a[:, 0, 3] - a[:, 0, 1] * y - a[:, 0, 2] * z, y, z], axis=1), ok


def damped_step(m: np.ndarray, b: np.ndarray, damp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Solutions of (m + damp) step = -b, m symmetric, and whether no pivot is under PIVOT."""
    p0, m01, m02 = m[:, 0, 0] + damp, m[:, 0, 1], m[:, 0, 2]
    l1, l2 = m01 / p0, m02 / p0
    p1 = m[:, 1, 1] + damp - l1 * m01
    l3 = (m[:, 1, 2] - l2 * m01) / p1
    p2 = m[:, 2, 2] + damp - l2 * m02 - l3 * l3 * p1
    y1 = b[:, 1] - l1 * b[:, 0]
    z = (b[:, 2] - l2 * b[:, 0] - l3 * y1) / p2
    y = y1 / p1 - l3 * z
    ok = (np.abs(p0) > PIVOT) & (np.abs(p1) > PIVOT) & (np.abs(p2) > PIVOT)
    return -np.stack([b[:, 0] / p0 - l1 * y - l2 * z, y, z], axis=1), ok


def _normal(r: np.ndarray, j: np.ndarray, bent: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost, curvature matrix and gradient of soft-L1 rows.

    Rows count in the matrix by the cost's slope over the residual or, if ``bent``, by its
    second derivative, which is always positive: steps from large residuals then don't fall
    short, which takes a third of the steps where a prior holds the solution.
    """
    square = 1 + (r * (1 / SOFT)) ** 2
    root = np.sqrt(square)
    flat = j / root[..., None]
    jt = flat.transpose(0, 2, 1)
    m = (flat / square[..., None]).transpose(0, 2, 1) @ j if bent else jt @ j
    return 2 * SOFT**2 * (root.sum(1) - r.shape[1]), m, (jt @ r[..., None])[..., 0]


@np.errstate(divide="ignore", invalid="ignore", over="ignore")
def levenberg_marquardt(x0, s, t, v, alt, prior, weight, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and whether they are finite: robust least squares, all groups at once.

    Damping is added to the diagonal, halved on an accepted step and raised tenfold on
    a rejected one; a group is done on a step under 0.1 mm, accepted or not (a rejected
    one that short says that nothing near is better), on a rejected step that promised
    a decrease within rounding of the cost, or when damping has run away. Each trial's
    rows are worked out once; groups that are done leave when they are the half.
    """
    x = x0.copy()
    good = np.isfinite(x).all(1)
    i = np.flatnonzero(good)
    fixed = [a[i] for a in (s, t, v, np.isfinite(alt), np.nan_to_num(alt), *_pull(prior, weight))]
    at, damp, live = x[i], np.full(len(i), 1e-3), np.ones(len(i), bool)
    bent = bool(np.any(fixed[-1] > 0))
    now, m, b = _normal(*_rows(at, *fixed), bent)
    for _ in range(most):
        if not len(i):
            break
        step, ok = damped_step(m, b, damp)
        then, m2, b2 = _normal(*_rows(at + step, *fixed), bent)
        better = ok & live & (then < now)
        w = better[:, None]
        promised = -np.einsum("gk,gk->g", step, b)
        vain = ~better & (promised <= ROUNDING * now)
        at, now = np.where(w, at + step, at), np.where(better, then, now)
        m, b = np.where(w[..., None], m2, m), np.where(w, b2, b)
        damp *= np.where(better, 0.5, 10.0)
        live &= ~((np.einsum("gk,gk->g", step, step) < 1e-8) | vain | (damp > 1e12))
        if 2 * np.count_nonzero(live) <= len(i):
            x[i] = at
            i, at, now, m, b, damp = i[live], at[live], now[live], m[live], b[live], damp[live]
            fixed, live = [f[live] for f in fixed], live[live]
    x[i] = at
    return x, good & np.isfinite(x).all(1)


def snapped(x: np.ndarray, alt: np.ndarray) -> np.ndarray:
    """The position put at the known altitude, on its own vertical."""
    sin, cos, sl, cl, n, _ = _vertical(x)
    h = np.nan_to_num(alt)
    up = np.stack([(n + h) * cos * cl, (n + h) * cos * sl, (n * (1 - E2) + h) * sin], axis=-1)
    return np.where(np.isfinite(alt)[:, None], up, x)


def toa(x0, s, t, salt, alt, prior, weight, most: int) -> dict[str, np.ndarray]:
    """Solve and snap: position, RMS timing residual there, emission time, validity."""
    v = speeds(salt, alt)
    x, ok = levenberg_marquardt(x0, s, t, v, alt, prior, weight, most)
    x = snapped(np.where(ok[:, None], x, x0), alt)
    r, _, t0 = timing(x, s, t, v)
    return {"x": x, "residual": np.sqrt((r**2).mean(1)), "t0": t0, "ok": ok & np.isfinite(r).all(1)}


def centroid(s: np.ndarray, alt: np.ndarray) -> np.ndarray:
    c = s.mean(1)
    return snapped(c, np.where(np.isfinite(alt), alt, 10_000.0))


@np.errstate(divide="ignore", invalid="ignore")
def closed_form(s: np.ndarray, t: np.ndarray, pairs: list[tuple[int, int]], alt: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Linear start from range differences to sensor 0; with ``alt``, a row of altitude.

    Four sensors leave two independent rows, which the plane tangent at the sensors'
    centroid, at the known altitude, completes.
    """
    q = s - s[:, :1]
    d = (t - t[:, :1]) * C_VACUUM
    m, b = [], []
    for j, k in pairs:
        rho = d[:, k] / d[:, j]
        m.append(2 * (q[:, k] - rho[:, None] * q[:, j]))
        b.append(((q[:, k] ** 2).sum(1) - d[:, k] ** 2) - rho * ((q[:, j] ** 2).sum(1) - d[:, j] ** 2))
    if alt is not None:
        c = centroid(s, alt)
        up = c / np.linalg.norm(c, axis=1, keepdims=True)
        m[-1], b[-1] = up * 1e5, ((c - s[:, 0]) * up).sum(1) * 1e5
    m, b = np.stack(m, 1), np.stack(b, 1)
    x, ok = solve3(m, b)
    x = x + s[:, 0]
    return x, ok & np.isfinite(x).all(1) & (np.linalg.norm(x - s[:, 0], axis=1) < 4 * MAX_RANGE_M)


def gdop_3d(x: np.ndarray, s: np.ndarray, used: np.ndarray | None = None) -> np.ndarray:
    """Dilution by all sensors, or by those that each group ``used``."""
    used = np.ones(s.shape[:2], bool) if used is None else used
    d = x[:, None, :] - s
    r = np.linalg.norm(d, axis=2)
    h = np.concatenate([d / np.maximum(r, 1e-9)[..., None], np.ones((*r.shape, 1))], axis=2) * used[..., None]
    return _dilution(h, ((r >= 1.0) | ~used).all(1) & (used.sum(1) >= 3))


def gdop_2d(x: np.ndarray, s: np.ndarray, used: np.ndarray | None = None) -> np.ndarray:
    used = np.ones(s.shape[:2], bool) if used is None else used
    east, north, size = _across(x)
    d = x[:, None, :] - s
    r = np.linalg.norm(d, axis=2)
    u = d / np.maximum(r, 1e-9)[..., None]
    h = np.stack([np.einsum("gnk,gk->gn", u, east), np.einsum("gnk,gk->gn", u, north)], axis=2) * used[..., None]
    return _dilution(h, ((r >= 1.0) | ~used).all(1) & (size >= 1e-10) & (used.sum(1) >= 2))


def _across(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """East and north across the position vector; under 1e-10 in the third, there is no east."""
    up = x / np.linalg.norm(x, axis=1, keepdims=True)
    east = np.stack([-up[:, 1], up[:, 0], np.zeros(len(x))], axis=1)
    size = np.linalg.norm(east, axis=1)
    east = east / np.maximum(size, 1e-10)[:, None]
    return east, np.cross(up, east), size


def gdop_3d_of_sums(m: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """:func:`gdop_3d` from ``m`` [g, 4, 4], the sums over all sensors of the products of
    their unit vectors and a one, and the ``nearest`` sensor's distance."""
    return _inverted(m, (nearest >= 1.0) & (m[:, 3, 3] >= 3))


def gdop_2d_of_sums(x: np.ndarray, m: np.ndarray, nearest: np.ndarray) -> np.ndarray:
    """:func:`gdop_2d` from the same sums."""
    east, north, size = _across(x)
    plane = np.stack([east, north], axis=1)
    with np.errstate(invalid="ignore"):  # of sums that are not finite
        return _inverted(plane @ m[:, :3, :3] @ plane.transpose(0, 2, 1), (nearest >= 1.0) & (size >= 1e-10) & (m[:, 3, 3] >= 2))


def _dilution(h: np.ndarray, ok: np.ndarray) -> np.ndarray:
    return _inverted(h.transpose(0, 2, 1) @ h, ok)


def _inverted(m: np.ndarray, ok: np.ndarray) -> np.ndarray:
    k = m.shape[2]
    ok = ok & np.isfinite(m).all((1, 2))
    ok &= np.abs(np.linalg.det(np.where(ok[:, None, None], m, np.eye(k)))) > 1e-13
    inv = np.linalg.inv(np.where(ok[:, None, None], m, np.eye(k)))
    trace = np.trace(inv, axis1=1, axis2=2)
    return np.where(ok & (trace >= 0), np.sqrt(np.maximum(trace, 0)), np.inf)


def prior_weight(uncertainty: np.ndarray) -> np.ndarray:
    """Weight of a prior's rows: the surer, the more."""
    return np.clip(500.0 / np.maximum(uncertainty, 1.0), 1.0, 12.0)


METHODS = ("prior_2sensor", "constrained_3sensor", "inamdar_5sensor", "inamdar_4sensor_alt", "frisch_toa")


def solve(s: np.ndarray, t: np.ndarray, salt: np.ndarray, alt: np.ndarray, prior: np.ndarray, uncertainty: np.ndarray) -> dict[str, np.ndarray]:
    """Outcomes of groups with equally many receptions, as arrays.

    ``fail`` (a reason or None), x, residual, quality, gdop, n (sensors used), method
    and t0; ``alt`` in metres. All but ``fail`` mean nothing where it isn't None.
    """
    g, n = t.shape
    has_alt, has_prior = np.isfinite(alt), np.isfinite(prior).all(1)
    need = np.where(has_alt & has_prior, 2, np.where(has_alt, 3, 4))
    out = {
        "fail": np.full(g, None, object), "method": np.full(g, None, object), "x": np.zeros((g, 3)), "n": np.full(g, n),
        **{k: np.zeros(g) for k in ("residual", "quality", "gdop", "t0")},
    }
    out["fail"][n < need] = "too_few_sensors"
    i = np.flatnonzero(n >= need)
    if not len(i):
        return out
    s, t, salt, alt, prior, need = (a[i] for a in (s, t, salt, alt, prior, need))
    start = np.where(has_prior[i][:, None], prior, centroid(s, alt))
    used = np.ones(t.shape, bool)
    if n == 2:
        weight = prior_weight(uncertainty[i])
        r = toa(start, s, t, salt, alt, prior, weight, 50)
        method = np.full(len(i), "prior_2sensor", object)
    elif n == 3:
        r = toa(start, s, t, salt, alt, np.full_like(prior, np.nan), np.zeros(len(i)), 50)
        method = np.full(len(i), "constrained_3sensor", object)
    else:
        r, method, used = _with_outliers(s, t, salt, alt, prior, start, need)
    out["x"][i], out["residual"][i], out["t0"][i], out["method"][i], out["n"][i] = r["x"], r["residual"], r["t0"], method, used.sum(1)
    out["quality"][i], out["gdop"][i], out["fail"][i] = _checked(r, used, s, alt, prior)
    return out


def _checked(r: dict, used: np.ndarray, s: np.ndarray, alt: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Quality, GDOP and failure of each solution: the first limit that it breaks."""
    x, res, n = r["x"], r["residual"], used.shape[1]
    n_used = used.sum(1)
    has_prior, has_alt = np.isfinite(prior).all(1), np.isfinite(alt)
    offset = np.where(has_prior, np.linalg.norm(x - np.where(has_prior[:, None], prior, 0), axis=1), 0.0)
    quality = np.where((n == 2) & has_prior, np.maximum(res, offset), res)
    far = (np.linalg.norm(x[:, None] - s, axis=2) > MAX_RANGE_M) & used
    cap = np.where((n == 2) & has_prior, 200.0, np.where((n_used == 3) & has_alt, 2000.0, np.where(n_used >= 4, 5000.0, 10_000.0)))
    drift = (5_000.0 if n == 2 else 30_000.0) * np.clip(200.0 / np.maximum(res, 10.0), 1.0, 3.0)
    gdop = np.zeros(len(x))
    four, flat = n_used >= 4, (n_used < 4) & has_alt
    gdop[four], gdop[flat] = gdop_3d(x[four], s[four], used[four]), gdop_2d(x[flat], s[flat], used[flat])
    fail = np.full(len(x), None, object)
    for broken, reason in (
        ((n_used <= 3) & ~np.isfinite(gdop), "degenerate_geometry"),
        ((n_used == 3) & has_alt & (gdop > MAX_GDOP_2D), "gdop_2d_exceeded"),
        ((n_used >= 4) & (gdop > MAX_GDOP), "gdop_exceeded"),
        (has_prior & (n <= 3) & (offset > drift), "prior_drift_exceeded"),
        (res > cap, "residual_exceeded"),
        (far.any(1), "range_exceeded"),
        (~r["ok"], "solver_diverged"),
    ):
        fail[broken] = reason  # the last that holds is the first in order
    return quality, gdop, fail


def _starts(s, t, alt, fallback) -> tuple[np.ndarray, np.ndarray]:
    """Start of four sensors or more: closed forms, then the prior or centroid."""
    n = t.shape[1]
    x, names = fallback.copy(), np.full(len(t), "frisch_toa", object)
    tries = []
    for shift in range(min(n, 4) if n >= 5 else 0):  # the sensors in turn, until one order gives a start
        five = [(k + shift) % n for k in range(5)]
        tries.append(("inamdar_5sensor", closed_form(s[:, five], t[:, five], [(1, 2), (1, 3), (1, 4)], None)))
    tries.append(("inamdar_4sensor_alt", closed_form(s[:, :4], t[:, :4], [(1, 2), (1, 3), (1, 3)], alt)))
    done = np.zeros(len(t), bool)
    for name, (y, ok) in tries:
        ok = ok & ~done & (np.isfinite(alt) | (name == "inamdar_5sensor"))
        x[ok], names[ok] = y[ok], name
        done |= ok
    return x, names


def _with_outliers(s, t, salt, alt, prior, fallback, need) -> tuple[dict, np.ndarray, np.ndarray]:
    """Solve, and while one sensor's residual is large and enough remain, drop that sensor.

    Returns the last solutions, their methods and which sensors remain. Groups that go on
    have all dropped equally many sensors, so each round is one batch: the kept sensors'
    arrays are a column narrower, and start anew from their own closed forms.
    """
    g, n = t.shape
    has_prior = np.isfinite(prior).all(1)
    used, method = np.ones((g, n), bool), np.full(g, None, object)
    out = {"x": fallback.copy(), "residual": np.zeros(g), "t0": np.zeros(g), "ok": np.zeros(g, bool)}
    i, keep = np.arange(g), np.tile(np.arange(n), (g, 1))
    for m in range(n, 2, -1):
        at = i[:, None], keep
        sm, tm, saltm, altm = s[at], t[at], salt[at], alt[i]
        start = fallback[i] if m == n else np.where(has_prior[i][:, None], prior[i], centroid(sm, altm))
        if m == 3:
            x0, names = start, np.full(len(i), "constrained_3sensor", object)
        else:
            x0, names = _starts(sm, tm, altm, start)
        r = toa(x0, sm, tm, saltm, altm, np.full((len(i), 3), np.nan), np.zeros(len(i)), 50 if m == 3 else 1000)
        good = r["ok"]
        i, keep, sm, tm, saltm = (a[good] for a in (i, keep, sm, tm, saltm))
        for k in out:
            out[k][i] = r[k][good]
        method[i] = names[good]
        off, _, _ = timing(r["x"][good], sm, tm, speeds(saltm, alt[i]))
        worst = np.abs(off).argmax(1)
        on = (np.abs(off)[np.arange(len(i)), worst] >= OUTLIER_M) & (m > np.maximum(3, need[i]))
        i, keep, worst = i[on], keep[on], worst[on]
        if not len(i):
            break
        used[i, keep[np.arange(len(i)), worst]] = False
        rest = np.ones(keep.shape, bool)
        rest[np.arange(len(i)), worst] = False
        keep = keep[rest].reshape(len(i), m - 1)
    gone = n - used.sum(1)
    for k in np.flatnonzero(out["ok"] & (gone > 0)).tolist():
        method[k] = f"{method[k]}_drop{gone[k]}"
    return out, method, used
