"""Serving a live stream: a latest-state table upserted batch by batch, connections, statistics."""

from __future__ import annotations

import json
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener

from skyweft.operators.windows import latest

TRAIL = 50
#: Versions that stay.
KEPT = 2
#: Aircraft that a snapshot may bring to the driver.
MOST_AIRCRAFT = 100_000


class LatestState:
    """Latest row and trail of each aircraft, in Parquet versions under ``path``.

    Each micro-batch is merged with the version before it into a new one, named by the
    batch id: the versions on disk are the state, so a restarted query goes on from
    them, and a batch that is run again gives the same version again. The last ``KEPT``
    versions stay, so that readers of the one before are not cut off. ``path`` must be
    shared by driver and executors.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def _folder(self):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(self.path)
        return p, p.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        """Batch ids of the committed versions, oldest first."""
        p, files = self._folder()
        if not files.exists(p):
            return []
        names = [s.getPath().getName() for s in files.listStatus(p)]
        done = lambda n: files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{n}/_SUCCESS"))
        return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and done(n))

    def upsert(self, batch: DataFrame, batch_id: int) -> None:
        t = F.col("timestamp_s") * F.lit(1_000_000_000).cast("long") + F.col("timestamp_ns")
        new = batch.withColumn("t_ns", t).withColumn("points", F.array(F.struct("t_ns", "lon", "lat")))
        before = [v for v in self.versions() if v < batch_id]
        both = self.spark.read.parquet(f"{self.path}/v{before[-1]}").unionByName(new) if before else new
        trail = F.array_sort(F.array_distinct(F.flatten(F.collect_list("points"))))
        trails = both.groupBy("icao").agg(trail.alias("points")).withColumn("points", F.slice("points", F.greatest(F.size("points") - TRAIL + 1, F.lit(1)), TRAIL))
        state = latest(both.drop("points"), "icao", ["t_ns", "raw_msg"]).join(trails, "icao")
        state.write.mode("overwrite").parquet(f"{self.path}/v{batch_id}")
        _, files = self._folder()
        for old in [v for v in before if v <= batch_id - KEPT]:
            files.delete(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/v{old}"), True)

    def current(self, least_ns: int | None = None) -> DataFrame:
        """The last version, of aircraft not older than ``least_ns`` if that is given."""
        there = self.versions()
        if not there:
            raise ValueError("no batch has come yet")
        state = self.spark.read.parquet(f"{self.path}/v{there[-1]}")
        state = state if least_ns is None else state.where(F.col("t_ns") >= least_ns)
        return state.withColumn("trail", F.when(F.size("points") >= 2, F.transform("points", lambda p: F.array(p["lon"], p["lat"])))).drop("points")

    def start(self, tracks: DataFrame, checkpoint: str, interval: str = "1 second", once: bool = False):
        w = tracks.writeStream.foreachBatch(self.upsert).option("checkpointLocation", checkpoint)
        return (w.trigger(availableNow=True) if once else w.trigger(processingTime=interval)).start()


def aircraft(state: LatestState, least_ns: int | None = None) -> dict:
    """What the REST snapshot returns: all present aircraft, whose number is checked."""
    rows = state.current(least_ns).toJSON().take(MOST_AIRCRAFT + 1)
    if len(rows) > MOST_AIRCRAFT:
        raise ValueError(f"over {MOST_AIRCRAFT} aircraft in one snapshot; give least_ns")
    return {"count": len(rows), "aircraft": [json.loads(r) for r in rows]}


def connections(events: DataFrame, key: str, t: str, ties: list[str], connected: str = "connected") -> DataFrame:
    """The present connections of a log of (dis)connect events: the last event of each
    ``key``, unless that is a disconnect (``connected`` is false or null)."""
    return latest(events, key, [t, *ties]).where(F.col(connected))


class Statistics(StreamingQueryListener):
    """Adds up the counters that :func:`skyweft.plans.pipeline.observed` gives with each
    micro-batch and reports them every ``interval`` seconds, and when a query ends.

    ``report`` gets the counters' name and a dictionary of totals; by default it writes
    a line to the standard error.
    """

    def __init__(self, report: Callable[[str, dict], None] | None = None, interval: float = 30.0):
        self.report = report or (lambda name, totals: print(f"[{name}] {json.dumps(totals)}", file=sys.stderr))
        self.interval, self.totals, self.last = interval, {}, time.monotonic()

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        for name, row in event.progress.observedMetrics.items():
            mine = self.totals.setdefault(name, {})
            for k, v in row.asDict().items():
                mine[k] = mine.get(k, 0) + (v or 0)
        if time.monotonic() - self.last >= self.interval:
            self._tell()

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._tell()

    def _tell(self) -> None:
        self.last = time.monotonic()
        for name, totals in sorted(self.totals.items()):
            self.report(name, dict(totals))
