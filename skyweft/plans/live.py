"""The whole pipeline as one streaming query: packets in, records and tracks out."""

from __future__ import annotations

from pyspark.sql import DataFrame

from skyweft.config import Config
from skyweft.operators import decode
from skyweft.streaming import state


def live(packets: DataFrame, config: Config = Config(), delay: str = "1 second", clocks: bool = True) -> DataFrame:
    """LIVE rows of a stream of packets, under one watermark ``delay`` behind the newest.

    Four stateful operators in a chain, each keyed by what its state is of: windows by
    message, position frames by aircraft, clock filters by pair of sensors (left out
    without ``clocks``), and solving with tracking by aircraft. Rows reach each in the order of
    time, so that the records and tracks are those of :func:`skyweft.plans.pipeline.build`.
    ``state.tracks_of`` has the tracks.
    """
    rows = state.timed(decode.valid_packets(packets)).withWatermark("event_time", delay)
    decoded = decode.decode(rows)
    groups = state.correlate_stream(decoded, config.window_ns, config.min_receptions)
    told = state.position_stream(groups)
    return state.aircraft_stream(state.clock_stream(told) if clocks else told, config)
