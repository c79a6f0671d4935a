"""The whole pipeline as one plan: packets in, tracks and what is served of them out."""

from __future__ import annotations

from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyweft.config import Config
from skyweft.functions import geo
from skyweft.operators import aggregates, clock, correlate, cprframes, decode, joins, snapshot, solve, track
from skyweft.operators.kept import kept


@dataclass(frozen=True)
class Layers:
    """Lazy results of each layer; nothing runs until one is read."""

    decoded: DataFrame
    groups: DataFrame
    clock_history: DataFrame
    records: DataFrame
    tracks: DataFrame
    #: Whether the layers are files.
    is_written: bool = False

    def written(self) -> Layers:
        """The same, each layer worked out once, from the written one before, and read from files from then on."""
        return self if self.is_written else Layers(*[kept(getattr(self, f.name)) for f in fields(self)[:-1]], is_written=True)

    @property
    def fixes(self) -> DataFrame:
        return solve.fixes(self.records)

    def snapshot(self, now_ns: int | None = None) -> DataFrame:
        return snapshot.snapshot(self.tracks, now_ns)

    def statistics(self) -> dict[str, DataFrame]:
        return {
            "formats": aggregates.histogram(self.decoded, "df_type"),
            "solver": aggregates.solve_stats(self.records),
            "methods": aggregates.method_counts(self.records),
            "failures": aggregates.failure_counts(self.records),
            "residuals": aggregates.order_statistics(self.fixes, "residual_m"),
            "sensor_bias": aggregates.sensor_bias(self.records),
            "clock_pairs": clock.pair_table(self.clock_history),
            "tracks": aggregates.track_stats(self.tracks),
        }


def build(packets: DataFrame, overrides: DataFrame | None = None, config: Config = Config(), clocks: bool = True, own_passes: int = 0, write: bool = False) -> Layers:
    """Layers of a batch of packets; sensor places come from ``overrides`` if given.

    Groups are formed first and then put at their sensors' surveyed places. Clocks are
    trained by the aircraft that tell their position; groups are corrected by the offsets
    as of their times (not without ``clocks``), then solved and tracked by aircraft.

    With ``own_passes`` the solver's own good fixes train the clocks, too. As a state only
    ever depends on what was before it, each pass over all groups (clocks from the fixes of
    the pass before, then solving: three shuffles, whatever the time that the feed covers)
    makes right what hangs on one more fix that trained another; see the README for figures.

    Nothing runs until a layer is read, and each that is read runs what is below it; with
    ``write`` (always with ``own_passes``) each layer runs once, at once, and is read from files.
    """
    keep = kept if write or own_passes else lambda df: df
    decoded = keep(decode.decode(decode.valid_packets(packets)))
    groups = correlate.correlate(decoded, config.window_ns, config.min_receptions)
    if overrides is not None:
        groups = joins.groups_at_overrides(groups, joins.surveyed(decoded, overrides))
    groups = keep(groups)
    told = keep(cprframes.decoded_positions(groups))
    reference = told.where("cpr_lat is not null").withColumn("ecef", geo.position_to_ecef("cpr_lat", "cpr_lon", "cpr_alt_ft"))
    measured = clock.measurements(reference)
    for k in range(own_passes + 1):
        history = keep(clock.offsets(measured))
        corrected = keep(clock.corrected(told, history)) if clocks else told
        records = keep(solve.solve_groups(corrected, config))
        if k < own_passes:
            own = clock.own_references(records, told, corrected)
            measured = clock.measurements(reference).unionByName(clock.measurements(own))
    return Layers(decoded, groups, history, records, keep(track.tracks(records)), is_written=write or own_passes > 0)


def observed(df: DataFrame, name: str, **counts) -> DataFrame:
    """``df`` with running counters that a query listener can read as it runs."""
    return df.observe(name, F.count("*").alias("rows"), *[F.count_if(c).alias(n) for n, c in counts.items()])
