"""Stateful stream operators: correlation windows, position frames, clocks, and an
aircraft's solving and tracking.

All need the RocksDB state store (:func:`configure`). Event time is ``event_time``; one
watermark, set where rows come in, serves a whole chain, and each operator passes on an
event time that is not behind it (the times that matter are in ``t_ns``). The watermark
drops what is later than its delay, which batch runs would still place.

Correlation windows are given out once the watermark has passed them, so that every
later operator gets its rows in the order of time, from one micro-batch to the next too: a
chain's results are those of the batch operators.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from skyweft.config import Config
from skyweft.functions import geo
from skyweft.operators import clock
from skyweft.operators.cprframes import FIELDS, Buffer, with_fields
from skyweft.operators.joins import reception_pairs
from skyweft.operators.solve import EXTRA, OWN, RECORD, Solver, arrow_schema
from skyweft.operators.track import Tracker
from skyweft.schemas import FIX, GROUP, RECEPTION, TRACK, struct

PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
KEPT = struct("t_ns BIGINT, df_type INT, altitude_ft DOUBLE, squawk STRING, sensor_id BIGINT, lat DOUBLE, lon DOUBLE, alt DOUBLE, timestamp_s BIGINT, timestamp_ns BIGINT")
RECEPTION_NAMES = [f.name for f in RECEPTION.fields]
CACHE_STATE = "ecef ARRAY<DOUBLE>, lat DOUBLE, lon DOUBLE, alt_m DOUBLE, t BIGINT, residual DOUBLE, solves INT, velocity ARRAY<DOUBLE>"
TRACK_STATE = "x ARRAY<DOUBLE>, p ARRAY<DOUBLE>, t BIGINT, n BIGINT, positions BIGINT, squawk STRING"
FRAME_STATE = "even_t BIGINT, even_y INT, even_x INT, odd_t BIGINT, odd_y INT, odd_x INT, lat DOUBLE, lon DOUBLE, t BIGINT"

#: How long after its last row an aircraft's cache, track and frames are kept, in seconds.
CACHE_S, TRACK_S, FRAMES_S = 120.0, 300.0, 600.0
#: A pair's filter is kept for so long after its last measurement.
CLOCK_S = 86_400.0
#: How far the watermark of solutions and tracks is behind the newest row.
DELAY = "60 seconds"
EVENT_TIME = T.StructField("event_time", T.TimestampType())
CLOSED = T.StructType([*GROUP.fields, T.StructField("t_ns", T.LongType()), EVENT_TIME])
SOLVED = T.StructType([T.StructField("t_ns", T.LongType()), *GROUP.fields, *[T.StructField(k, T.DoubleType()) for k in EXTRA]])
TRACKED = T.StructType([T.StructField("t_ns", T.LongType()), T.StructField("icao", T.StringType()), T.StructField("fix", FIX), T.StructField("unsolved_group", GROUP)])
#: A group with what its message tells and its position, if that is known.
TOLD = T.StructType([*GROUP.fields, *[T.StructField(n, T.LongType() if n == "t_ns" else T.DoubleType()) for n in ("t_ns", "cpr_lat", "cpr_lon", "cpr_alt_ft", "vel_e", "vel_n", "vel_u")], EVENT_TIME])
_PAIR = struct("sensor_a BIGINT, sensor_b BIGINT, offset DOUBLE, variance DOUBLE")
#: A pair of a group at its time, with the pair's state if that is valid; one pair of each
#: group carries the group.
LOOKED_UP = T.StructType([*struct("icao STRING, raw_msg STRING, t_ns BIGINT").fields, *_PAIR.fields, T.StructField("told", T.StructType(TOLD.fields[:-1])), EVENT_TIME])
#: A record and, if its fix was accepted, the track.
LIVE = T.StructType([*RECORD.fields, T.StructField("track", TRACK), EVENT_TIME])


def configure(spark: SparkSession) -> None:
    """The state store, and batch after batch (the last without data) until all is read for
    ``availableNow`` queries of sources that don't offer this themselves."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", PROVIDER)
    spark.conf.set("spark.sql.streaming.triggerAvailableNowWrapper.enabled", "true")


def timed(df: DataFrame) -> DataFrame:
    """Adds t_ns, and event_time (microseconds) for the watermark."""
    t = F.col("timestamp_s") * F.lit(1_000_000_000).cast("long") + F.col("timestamp_ns")
    return df.withColumn("t_ns", t).withColumn("event_time", F.timestamp_micros(F.floor(F.col("t_ns") / 1000)))


def names_of(kind: T.StructType) -> list[str]:
    return [f.name for f in kind.fields]


def rows_of(rows: Iterator[pd.DataFrame], order: list[str]) -> pd.DataFrame:
    """A key's rows of a micro-batch in order, missing values as None."""
    now = pd.concat(list(rows)).sort_values(order, kind="stable")
    return now.astype(object).where(now.notna(), None)


def passed_on(rows: list[dict], kind: T.StructType, timers, stamps: list | None = None) -> pd.DataFrame:
    """Rows with an event time that is not behind the watermark: their own or a later one."""
    least = pd.Timestamp(timers.getCurrentWatermarkInMs() + 1, unit="ms")
    for i, r in enumerate(rows):
        own = stamps[i] if stamps is not None else None
        r["event_time"] = least if own is None or own < least else own
    return pd.DataFrame(rows, columns=names_of(kind))


class CorrelationProcessor(StatefulProcessor):
    """A message's receptions, until the watermark has passed their windows.

    Nothing that comes later can then belong to them: they are cut at their anchors and
    go; the rest waits for a timer of its own.
    """

    def __init__(self, window_ns: int, min_receptions: int):
        self.window_ns, self.min_receptions = window_ns, min_receptions

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getListState("open", KEPT)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        now = rows_of(rows, ["t_ns", "sensor_id"])
        self.open.appendList(list(now[names_of(KEPT)].itertuples(index=False, name=None)))
        self._wait(int(now["t_ns"].iloc[0]))
        yield pd.DataFrame([], columns=names_of(CLOSED))

    def _wait(self, anchor: int) -> None:
        self.handle.registerTimer((anchor + self.window_ns) // 1_000_000 + 1)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held = sorted(self.open.get(), key=lambda r: (r[0], r[4])) if self.open.exists() else []
        until = timerValues.getCurrentWatermarkInMs() * 1_000_000
        closed: list[list] = []
        while held and held[0][0] + self.window_ns < until:
            n = sum(r[0] <= held[0][0] + self.window_ns for r in held)
            closed.append(held[:n])
            held = held[n:]
        if closed:
            if held:
                self.open.put([tuple(h) for h in held])
                self._wait(held[0][0])
            else:
                self.open.clear()
        yield passed_on(self.groups(key, closed), CLOSED, timerValues)

    def groups(self, key, closed: list[list]) -> list[dict]:
        out = []
        for rows in closed:
            heard: dict = {}
            for r in rows:
                heard.setdefault(r[4], r)  # a sensor counts once, first come
            if len(heard) >= self.min_receptions:
                first, receptions = rows[0], [dict(zip(RECEPTION_NAMES, r[4:])) for r in heard.values()]
                out.append({"icao": key[0], "df_type": first[1], "altitude_ft": first[2], "squawk": first[3], "raw_msg": key[1], "num_sensors": len(heard), "receptions": receptions, "t_ns": first[0]})
        return out

    def close(self) -> None:
        pass


def correlate_stream(decoded: DataFrame, window_ns: int = 2_000_000, min_receptions: int = 2, delay: str = "1 second") -> DataFrame:
    """GROUP rows, t_ns and event_time of a stream of decoded messages, in append mode.

    Windows newer than the last watermark stay open when a stream ends, until rows come
    that move it: :func:`skyweft.sources.packets.closing_packet` makes such a one. If
    ``decoded`` has an event_time with a watermark, that one holds.
    """
    configure(decoded.sparkSession)
    marked = "event_time" in decoded.columns
    df = decoded if marked else timed(decoded)
    df = df.where("icao <> '' and raw_msg <> '' and sensor_id is not null and df_type is not null")
    df = df.withColumn("altitude_ft", F.col("altitude_ft").cast("double"))
    df = df if marked else df.withWatermark("event_time", delay)
    processor = CorrelationProcessor(window_ns, min_receptions)
    rows = df.select("icao", "raw_msg", *names_of(KEPT), "event_time").groupBy("icao", "raw_msg")
    return rows.transformWithStateInPandas(processor, CLOSED, outputMode="Append", timeMode="EventTime", eventTimeColumnName="event_time")


class Expiring(StatefulProcessor):
    """State of one key that a timer drops.

    That is when the watermark has passed its last row by ``keep_s``. There is one timer
    a key: if rows have come since it was set, it is set again.
    """

    kind: T.StructType

    def __init__(self, keep_s: float, timed: bool):
        self.keep_ms, self.timed = int(keep_s * 1000), timed

    def last_ns(self) -> int | None:
        """The time of the state's last row, if there is a state."""
        raise NotImplementedError

    def drop(self) -> None:
        raise NotImplementedError

    def wait(self, t_ns: int) -> None:
        """Set the timer, when the state begins."""
        if self.timed:
            self.handle.registerTimer(t_ns // 1_000_000 + self.keep_ms)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if (last := self.last_ns()) is not None:
            end = last // 1_000_000 + self.keep_ms
            if end >= timerValues.getCurrentWatermarkInMs():
                self.handle.registerTimer(end + 1)  # rows have come since
            else:
                self.drop()
        yield pd.DataFrame([], columns=names_of(self.kind))

    def close(self) -> None:
        pass


class FrameProcessor(Expiring):
    """An aircraft's latest even and odd position frame and its last decoded position."""

    kind = TOLD

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("frames", FRAME_STATE)

    def last_ns(self) -> int | None:
        return self.kept.get()[8] if self.kept.exists() else None

    def drop(self) -> None:
        self.kept.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        buffer, last = Buffer(), None
        if was := self.kept.exists():
            s = self.kept.get()
            buffer = Buffer(s[0:3] if s[0] is not None else None, s[3:6] if s[3] is not None else None, s[6], s[7])
            last = s[8]
        out, stamps = [], []
        for r in rows_of(rows, ["t_ns", "raw_msg"]).to_dict("records"):
            place = None
            if r["cpr_odd"] is not None:
                place = buffer.add(int(r["t_ns"]), int(r["cpr_odd"]), int(r["cpr_y"]), int(r["cpr_x"]))
                last = max(last or 0, int(r["t_ns"]))
            stamps.append(r["event_time"])
            out.append(whole(plain({n: r.get(n) for n in names_of(TOLD)[:-1]} | {"icao": key[0], "cpr_lat": place and place[0], "cpr_lon": place and place[1]})))
        if last is not None:
            if not was:
                self.wait(last)
            none = (None, None, None)
            self.kept.update((*(buffer.even or none), *(buffer.odd or none), buffer.lat, buffer.lon, last))
        yield passed_on(out, TOLD, timerValues, stamps)


def position_stream(groups: DataFrame, keep_s: float = FRAMES_S) -> DataFrame:
    """A stream of groups (with t_ns and a watermarked event_time) with the positions and
    velocities that their messages tell: TOLD.

    The batch counterpart decodes single frames near the last position that a pair gave; here
    the last position is that of the last frame, however it was decoded. They agree as long
    as an aircraft has moved less than half a zone (3 degrees) since its last pair.
    """
    configure(groups.sparkSession)
    rows = with_fields(groups).select(*names_of(GROUP), "t_ns", *FIELDS, "event_time").groupBy("icao")
    return rows.transformWithStateInPandas(FrameProcessor(keep_s, True), TOLD, outputMode="Append", timeMode="EventTime", eventTimeColumnName="event_time")


class ClockProcessor(Expiring):
    """The clock filter of a pair of sensors: measurements move it, groups look it up.

    Of one time, measurements come first, as the batch's as-of join has it.
    """

    kind = LOOKED_UP

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("filter", clock.STATE)

    def last_ns(self) -> int | None:
        return self.kept.get()[7] if self.kept.exists() else None

    def drop(self) -> None:
        self.kept.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        f, was = clock.PairFilter(), self.kept.exists()
        if was:
            f = clock.PairFilter.of(self.kept.get())
        now = rows_of(rows, ["t_ns", "measured", "icao", "raw_msg"])
        out, stamps = [], []
        for _, same in now.groupby("t_ns", sort=True):
            for z in same["measured"]:
                if z is not None:
                    f.update(int(same["t_ns"].iloc[0]), float(z))
            for r in same.to_dict("records"):
                t = int(r["t_ns"])
                state = {"offset": f.at(t), "variance": f.p00} if f.valid else {"offset": None, "variance": None}
                told = plain(r["told"])
                stamps.append(r["event_time"])
                out.append({"icao": r["icao"], "raw_msg": r["raw_msg"], "t_ns": t, "sensor_a": key[0], "sensor_b": key[1], **state, "told": told and whole(told)})
        if f.n:
            if not was:
                self.wait(f.t_ns)
            self.kept.update(f.state())
        yield passed_on(out, LOOKED_UP, timerValues, stamps)


def clock_stream(told: DataFrame, keep_s: float = CLOCK_S) -> DataFrame:
    """LOOKED_UP rows: each pair of each group of :func:`position_stream` with the state of
    the pair's clocks as of the group's time, the group's own position included."""
    kept = names_of(TOLD)[:-1]
    group = F.struct(*[F.col(c) for c in kept])
    known = F.col("cpr_lat").isNotNull()
    ecef = F.when(known, geo.position_to_ecef("cpr_lat", "cpr_lon", "cpr_alt_ft"))
    df = told.select("icao", "raw_msg", "t_ns", ecef.alias("ecef"), group.alias("told"), "event_time", "receptions")
    first = F.array_min(F.transform("receptions", lambda r: r["sensor_id"]))
    pairs = reception_pairs(df.withColumn("first", first), ["icao", "raw_msg", "t_ns", "ecef", "told", "event_time", "first"])
    # the pair of the two smallest sensors carries the group
    second = F.array_min(F.transform(F.filter("told.receptions", lambda r: r["sensor_id"] > F.col("first")), lambda r: r["sensor_id"]))
    carries = (F.col("a.sensor_id") == F.col("first")) & (F.col("b.sensor_id") == second)
    rows = pairs.select(
        "icao", "raw_msg", "t_ns", F.col("a.sensor_id").alias("sensor_a"), F.col("b.sensor_id").alias("sensor_b"),
        F.when(F.col("ecef").isNotNull(), clock.difference("a", "b", "ecef")).alias("measured"), F.when(carries, F.col("told")).alias("told"), "event_time",
    )
    return rows.groupBy("sensor_a", "sensor_b").transformWithStateInPandas(ClockProcessor(keep_s, True), LOOKED_UP, outputMode="Append", timeMode="EventTime", eventTimeColumnName="event_time")


class AircraftProcessor(Expiring):
    """One aircraft's position cache and track: its groups are corrected, solved and tracked."""

    kind = LIVE

    def __init__(self, config: Config, cache_s: float, track_s: float, corrects: bool):
        super().__init__(cache_s, True)
        self.config, self.track_ms, self.corrects = config, int(track_s * 1000), corrects

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.cache, self.filter = handle.getValueState("cache", CACHE_STATE), handle.getValueState("track", TRACK_STATE)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """One timer serves both states: it is set to when the next of them may go."""
        ends = []
        for state, at, keep in ((self.cache, 4, self.keep_ms), (self.filter, 2, self.track_ms)):
            if state.exists():
                end = state.get()[at] // 1_000_000 + keep
                if end < timerValues.getCurrentWatermarkInMs():
                    state.clear()
                else:
                    ends.append(end)
        if ends:
            self.handle.registerTimer(min(ends) + 1)
        yield pd.DataFrame([], columns=names_of(LIVE))

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        solver, tracker = Solver(self.config), Tracker()
        cached = load_cache(solver, key[0], self.cache)
        tracked = load_track(tracker, key[0], self.filter)
        groups, stamps = self._groups(key, rows)
        out = []
        if groups:
            batch = pa.RecordBatch.from_pylist(groups, schema=arrow_schema(SOLVED))
            records = solver.batch(batch)
            tracks, of = tracker.numbered(records.select(names_of(TRACKED)))
            out = [r | {"track": None} for r in records.to_pylist()]
            for i, t in zip(of.tolist(), tracks.to_pylist()):
                out[i]["track"] = t
            times = [*keep_cache(solver, self.cache), *keep_track(tracker, self.filter)]
            if times and not (cached or tracked):
                self.wait(min(times))
        yield passed_on(out, LIVE, timerValues, stamps)

    def _groups(self, key, rows: Iterator[pd.DataFrame]) -> tuple[list[dict], list]:
        """The aircraft's groups of a micro-batch in time order, at corrected times, and their event times."""
        now = rows_of(rows, ["t_ns", "raw_msg"])
        if not self.corrects:
            return [whole(plain(r)) for r in now.drop(columns="event_time").to_dict("records")], now["event_time"].tolist()
        groups, stamps = [], []
        for _, same in now.groupby(["t_ns", "raw_msg"], sort=True):
            carrier = next((r for r in same.to_dict("records") if r["told"] is not None), None)
            if carrier is not None:
                found = same[same["variance"].map(lambda v: v is not None)]
                pairs = found[names_of(_PAIR)].drop_duplicates(["sensor_a", "sensor_b"]).to_dict("records")
                groups.append(whole(plain(carrier["told"])) | {"icao": key[0], "__pairs": plain(pairs)})
                stamps.append(carrier["event_time"])
        if not groups:
            return [], []
        kind = T.StructType([f for f in SOLVED.fields if f.name != "pair_variance"])
        batch = pa.RecordBatch.from_pylist(groups, schema=arrow_schema(T.StructType([*kind, T.StructField("__pairs", T.ArrayType(_PAIR))])))
        return clock.corrected_batch(batch, arrow_schema(SOLVED)).to_pylist(), stamps


def aircraft_stream(groups: DataFrame, config: Config = Config(), cache_s: float = CACHE_S, track_s: float = TRACK_S) -> DataFrame:
    """LIVE rows of a stream of groups: of :func:`clock_stream` (LOOKED_UP), which are corrected
    first, or with GROUP columns, t_ns, a watermarked event_time and any of the solver's extra ones.

    Solver and tracker of an aircraft are one processor with two states and one timer.
    """
    configure(groups.sparkSession)
    corrects = "told" in groups.columns
    if corrects:
        src = groups.select(*names_of(LOOKED_UP))
    else:
        extra = [F.col(c).cast(k) if c in groups.columns else F.lit(None).cast(k).alias(c) for c, k in EXTRA.items()]
        src = groups.select(*OWN, *extra, "event_time")
    processor = AircraftProcessor(config, cache_s, track_s, corrects)
    return src.groupBy("icao").transformWithStateInPandas(processor, LIVE, outputMode="Append", timeMode="EventTime", eventTimeColumnName="event_time")


def tracks_of(live: DataFrame) -> DataFrame:
    """TRACK rows of :func:`aircraft_stream`."""
    return live.where("track is not null").select("track.*")


def load_cache(solver: Solver, key: str, state) -> bool:
    c = solver.cache
    slot = c.of(np.array([key], object))[0]
    if was := state.exists():
        ecef, c.lat[slot], c.lon[slot], c.alt_m[slot], c.t[slot], c.residual[slot], c.solves[slot], velocity = state.get()
        c.ecef[slot], c.velocity[slot], c.live[slot] = ecef, np.nan if velocity is None else velocity, True
    return was


def keep_cache(solver: Solver, state) -> list[int]:
    """Store the cache of the solver's only aircraft; its time, if there is one."""
    c = solver.cache
    if not c.live[0]:
        return []
    velocity = c.velocity[0].tolist() if np.isfinite(c.velocity[0, 0]) else None
    state.update((c.ecef[0].tolist(), float(c.lat[0]), float(c.lon[0]), float(c.alt_m[0]), int(c.t[0]), float(c.residual[0]), int(c.solves[0]), velocity))
    return [int(c.t[0])]


def load_track(tracker: Tracker, key: str, state) -> bool:
    f = tracker.f
    slot = f.of(np.array([key], object))[0]
    if was := state.exists():
        x, p, f.t[slot], f.n[slot], f.positions[slot], f.squawk[slot] = state.get()
        f.x[slot], f.p[slot], f.live[slot] = np.array(x), np.array(p).reshape(6, 6), True
    return was


def keep_track(tracker: Tracker, state) -> list[int]:
    f = tracker.f
    if not f.live[0]:
        return []
    state.update((f.x[0].tolist(), f.p[0].reshape(-1).tolist(), int(f.t[0]), int(f.n[0]), int(f.positions[0]), f.squawk[0]))
    return [int(f.t[0])]


class SolveProcessor(Expiring):
    """One aircraft's position cache between micro-batches."""

    kind = T.StructType([*RECORD.fields, EVENT_TIME])

    def __init__(self, config: Config, keep_s: float, timed: bool):
        super().__init__(keep_s, timed)
        self.config = config
        self.kind = self.kind if timed else RECORD

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("cache", CACHE_STATE)

    def last_ns(self) -> int | None:
        return self.kept.get()[4] if self.kept.exists() else None

    def drop(self) -> None:
        self.kept.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        solver = Solver(self.config)
        was = load_cache(solver, key[0], self.kept)
        now = rows_of(rows, ["t_ns", "raw_msg"])
        groups = [whole(plain(r)) for r in now.drop(columns="event_time", errors="ignore").to_dict("records")]
        out = solver.batch(pa.RecordBatch.from_pylist(groups, schema=arrow_schema(SOLVED))).to_pylist()
        times = keep_cache(solver, self.kept)
        if times and not was:
            self.wait(times[0])
        yield passed_on(out, self.kind, timerValues, now["event_time"].tolist()) if self.timed else pd.DataFrame(out, columns=names_of(RECORD))


class TrackProcessor(Expiring):
    """One aircraft's filter between micro-batches."""

    kind = TRACK

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle, self.kept = handle, handle.getValueState("filter", TRACK_STATE)

    def last_ns(self) -> int | None:
        return self.kept.get()[2] if self.kept.exists() else None

    def drop(self) -> None:
        self.kept.clear()

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        tracker = Tracker()
        was = load_track(tracker, key[0], self.kept)
        now = pd.concat(list(rows)).sort_values("t_ns")
        records = [{"t_ns": int(r.t_ns), "icao": key[0], "fix": plain(r.fix), "unsolved_group": plain(r.unsolved_group)} for r in now.itertuples()]
        out = tracker.batch(pa.RecordBatch.from_pylist(records, schema=arrow_schema(TRACKED)))
        times = keep_track(tracker, self.kept)
        if times and not was:
            self.wait(times[0])
        yield pd.DataFrame(out.to_pylist(), columns=names_of(TRACK))


def whole(group: dict) -> dict:
    """Integers that pandas made floats of because of nulls beside them, back again."""
    for k in ("t_ns", "df_type", "num_sensors"):
        if group[k] is not None:
            group[k] = int(group[k])
    return group


def _keyed(rows: DataFrame, columns: list, delay: str | None):
    """Rows by aircraft, and the time mode of their timers. An event time that the rows have
    already is one with a watermark, which holds for the chain."""
    if delay is None:
        return rows.select(*columns).groupBy("icao"), "None"
    if "event_time" not in rows.columns:
        rows = rows.withColumn("event_time", F.timestamp_micros(F.floor(F.col("t_ns") / 1000))).withWatermark("event_time", delay)
    return rows.select(*columns, "event_time").groupBy("icao"), "EventTime"


def solve_stream(groups: DataFrame, config: Config = Config(), keep_s: float = CACHE_S, delay: str | None = DELAY) -> DataFrame:
    """RECORD rows of a stream of groups (GROUP columns, t_ns and any of the solver's
    extra ones), with the event_time that :func:`track_stream` goes by.

    An aircraft's state goes once the watermark, ``delay`` behind the newest row, has
    passed its last solution by ``keep_s``; rows behind the watermark are dropped. With
    ``delay`` None there is no watermark and nothing goes.
    """
    configure(groups.sparkSession)
    extra = [F.col(c).cast(k) if c in groups.columns else F.lit(None).cast(k).alias(c) for c, k in EXTRA.items()]
    src, mode = _keyed(groups, [*OWN, *extra], delay)
    processor = SolveProcessor(config, keep_s, delay is not None)
    more = {"eventTimeColumnName": "event_time"} if delay is not None else {}
    return src.transformWithStateInPandas(processor, processor.kind, outputMode="Append", timeMode=mode, **more)


def plain(value):
    """Rows, arrays and missing values of a pandas cell as dicts, lists and None."""
    if value is None or (isinstance(value, float) and np.isnan(value)):
        return None
    if hasattr(value, "asDict"):
        value = value.asDict(recursive=True)
    if isinstance(value, dict):
        return {k: plain(v) for k, v in value.items()}
    if isinstance(value, (list, np.ndarray)):
        return [plain(v) for v in value]
    return value


def track_stream(records: DataFrame, keep_s: float = TRACK_S, delay: str | None = DELAY) -> DataFrame:
    """TRACK rows of a stream of records (t_ns, icao, fix, unsolved_group); a track is
    dropped as :func:`solve_stream` drops its state."""
    configure(records.sparkSession)
    src, mode = _keyed(records, ["t_ns", "icao", "fix", "unsolved_group"], delay)
    return src.transformWithStateInPandas(TrackProcessor(keep_s, delay is not None), TRACK, outputMode="Append", timeMode=mode)
