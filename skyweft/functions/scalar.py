"""Scalar column functions: rounding, time, units and the pipeline's error models."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyweft.functions.let import col

FEET = 0.3048
NS = 1_000_000_000


def clamp(v, low, high) -> Column:
    return F.least(F.greatest(col(v), col(low)), col(high))


def round_to(v, digits: int) -> Column:
    """Half away from zero at ``digits`` decimals; null and non-finite become null."""
    v = col(v)
    scale = float(10**digits)
    r = F.signum(v) * F.floor(F.abs(v) * scale + 0.5) / scale
    return F.when(finite(v), r)


def finite(v) -> Column:
    v = col(v)
    return v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))


def positive_mod(a, b) -> Column:
    """Floor modulus: in [0, b) for b > 0."""
    a, b = col(a), col(b)
    return a - b * F.floor(a / b)


def ft_to_m(ft) -> Column:
    return col(ft) * FEET


def m_to_ft(m) -> Column:
    return col(m) / FEET


def t_ns(s, ns) -> Column:
    """One int64 of nanoseconds; differences are exact before they become doubles."""
    return col(s).cast("long") * NS + col(ns).cast("long")


def seconds_between(later_ns, earlier_ns) -> Column:
    return (col(later_ns) - col(earlier_ns)).cast("double") * 1e-9


def altitude_band(alt_ft) -> Column:
    """Map colour band of an altitude."""
    a = col(alt_ft)
    return F.when(a.isNull(), "grey").when(a < 10_000, "low").when(a < 25_000, "mid").when(a < 35_000, "high").otherwise("top")
