"""Settings of the pipeline in one frozen place."""

from __future__ import annotations

import os
from collections.abc import Mapping
from dataclasses import dataclass


@dataclass(frozen=True)
class Config:
    """Correlation, solving, tracking and serving settings with their defaults."""

    window_ms: float = 2.0
    min_receptions: int = 2
    delegate_2sensor_min_solves: int = 0
    map_host: str = "127.0.0.1"
    map_port: int = 8080
    update_interval_s: float = 1.0
    #: Whether a position message may seed the prior of its own group.
    seed_prior_from_own_message: bool = True

    @property
    def window_ns(self) -> int:
        return round(self.window_ms * 1e6)

    @classmethod
    def from_env(cls, env: Mapping[str, str] | None = None) -> Config:
        """Defaults overridden by environment variables; unparsable ones are ignored."""
        env = os.environ if env is None else env
        names = {
            "window_ms": ("MLAT_WINDOW_MS", float),
            "min_receptions": ("MLAT_MIN_RECEPTIONS", int),
            "delegate_2sensor_min_solves": ("NATIVE_L45_DELEGATE_2SENSOR_MIN_SOLVES", int),
            "map_host": ("MLAT_MAP_HOST", str),
            "map_port": ("MLAT_MAP_PORT", int),
            "update_interval_s": ("MLAT_UPDATE_INTERVAL", float),
        }
        found = {}
        for field, (name, kind) in names.items():
            if env.get(name):
                try:
                    found[field] = kind(env[name])
                except ValueError:
                    continue
        return cls(**found)
