"""Binary packets: a length byte, then 55 bytes or more.

``i64 sensor | f64 lat | f64 lon | f64 alt | u64 s | u64 ns | message``, big-endian. A
Python data source reads files of such frames, in batch and as a stream of files; a large
file is read by many tasks, each of which finds the first frame of its range of bytes.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from skyweft.operators.decode import valid_packets
from skyweft.schemas import PACKET

HEAD = struct.Struct(">qdddQQ")
LEAST_BYTES = HEAD.size + 7


def frames(data: bytes) -> Iterator[bytes]:
    """Payloads of length-prefixed frames; length 0 is skipped, a cut frame ends it."""
    at = 0
    while at < len(data):
        n = data[at]
        if at + 1 + n > len(data):
            return
        if n:
            yield data[at + 1 : at + 1 + n]
        at += 1 + n


def unpack(payload: bytes) -> tuple | None:
    """A PACKET row, or None for a short payload."""
    if len(payload) < LEAST_BYTES:
        return None
    sensor, lat, lon, alt, s, ns = HEAD.unpack_from(payload)
    return sensor, lat, lon, alt, s, ns, payload[HEAD.size :].hex().upper()


def parse_payloads(df: DataFrame, payload: str = "payload") -> DataFrame:
    """PACKET rows of binary payloads; malformed and out-of-bounds ones go."""

    def run(batches):
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(PACKET)
        for b in batches:
            rows = [r for r in (unpack(p) for p in b.column(0).to_pylist() if p) if r]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)

    return valid_packets(df.select(F.col(payload)).mapInArrow(run, PACKET))


#: Bytes of a file that one task reads.
RANGE_BYTES = 64 << 20
#: Frames in a row by which a range's task knows where frames begin, and how far before the
#: range it looks for them at first.
SOUND_FRAMES, BACKWARDS = 3, 4096
CHUNK_BYTES = 4 << 20
LONGEST = 256


@dataclass
class _Range(InputPartition):
    """The frames of a file that begin in [begin, end)."""

    path: str
    begin: int
    end: int


def _files(path: str) -> list[str]:
    if os.path.isdir(path):
        return sorted(os.path.join(path, n) for n in os.listdir(path) if not n.startswith((".", "_")))
    return [path]


def _ranges(path: str, size: int, most: int) -> list[InputPartition]:
    return [_Range(path, at, min(at + most, size)) for at in range(0, size, most)]


def _sound(data: bytes, at: int) -> bool:
    """Whether SOUND_FRAMES whole frames of sane times follow each other from ``at`` on."""
    for _ in range(SOUND_FRAMES):
        if at >= len(data) or data[at] < LEAST_BYTES or at + 1 + data[at] > len(data):
            return False
        _, _, _, _, s, ns = HEAD.unpack_from(data, at + 1)
        if s >> 36 or ns >= 1_000_000_000:
            return False
        at += 1 + data[at]
    return True


def first_frame(f, begin: int, size: int) -> int:
    """Where the first frame that begins at ``begin`` or later does.

    Looks backwards for frames of sane times in a row (by chance they would come once in
    2^170 places) and follows the lengths from there; if there are none, from the file's start.
    """
    reach = BACKWARDS
    while True:
        low = max(0, begin - reach)
        f.seek(low)
        data = f.read(begin - low)
        at = next((i for i in range(len(data)) if _sound(data, i)), None) if low else 0
        if at is not None:
            while at < len(data):
                at += 1 + data[at]
            return min(low + at, size)
        reach *= 16


def _batches(part: _Range) -> Iterator[pa.RecordBatch]:
    """PACKET rows of a range's frames, one batch for each few megabytes."""
    size = os.path.getsize(part.path)
    with open(part.path, "rb") as f:
        at = first_frame(f, part.begin, size)
        while at < part.end:
            f.seek(at)
            data = f.read(min(CHUNK_BYTES, part.end - at + LONGEST))
            places, i = [], 0
            while i < len(data) and at + i < part.end and i + 1 + data[i] <= len(data):
                if data[i] >= LEAST_BYTES:
                    places.append(i)
                i += 1 + data[i]
            if places:
                yield packet_batch(data, places)
            if i == 0:
                return  # a cut frame ends the file
            at += i


def packet_batch(data: bytes, places: list[int]) -> pa.RecordBatch:
    """PACKET rows of the frames at ``places`` of ``data``, all of LEAST_BYTES or more."""
    from pyspark.sql.pandas.types import to_arrow_schema

    raw = np.frombuffer(data, np.uint8)
    heads = raw[np.array(places)[:, None] + np.arange(1, HEAD.size + 1)]
    column = lambda k, kind: np.ascontiguousarray(heads[:, 8 * k : 8 * k + 8]).view(kind)[:, 0]
    native = [column(0, ">i8").astype(np.int64), *[column(k, ">f8").astype(np.float64) for k in (1, 2, 3)], *[column(k, ">u8").astype(np.int64) for k in (4, 5)]]
    messages = [data[p + 1 + HEAD.size : p + 1 + data[p]].hex().upper() for p in places]
    return pa.RecordBatch.from_arrays([*map(pa.array, native), pa.array(messages, pa.string())], schema=to_arrow_schema(PACKET))


class PacketSource(DataSource):
    """``format("packets")``: options ``path`` (a file or folder that all workers see) and
    ``range_bytes`` (of a file, for one task); of a stream also ``log``, the folder of its
    log of files, by default ``_packets`` in the folder that is read."""

    @classmethod
    def name(cls) -> str:
        return "packets"

    def schema(self):
        return PACKET

    def _range_bytes(self) -> int:
        return int(self.options.get("range_bytes", RANGE_BYTES))

    def reader(self, schema) -> DataSourceReader:
        return _BatchReader(self.options["path"], self._range_bytes())

    def streamReader(self, schema) -> DataSourceStreamReader:
        path = self.options["path"]
        return _StreamReader(path, self.options.get("log") or os.path.join(path, "_packets"), self._range_bytes())


class _BatchReader(DataSourceReader):
    def __init__(self, path: str, range_bytes: int):
        self.path, self.range_bytes = path, range_bytes

    def partitions(self) -> list[InputPartition]:
        return [r for p in _files(self.path) for r in _ranges(p, os.path.getsize(p), self.range_bytes)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        yield from _batches(partition)


class FileLog:
    """The files that have been seen, in numbered entries of one folder.

    An entry is made under a name of its own and then linked to its number, which fails if
    that is taken: several streams of one folder may write to one log. Each stream's place in it is
    its offset.
    """

    def __init__(self, folder: str):
        self.folder = folder

    def _name(self, k: int) -> str:
        return os.path.join(self.folder, f"{k:012d}.json")

    def last(self) -> int:
        if not os.path.isdir(self.folder):
            return 0
        return max((int(n[:12]) for n in os.listdir(self.folder) if len(n) == 17 and n.endswith(".json")), default=0)

    def entry(self, k: int) -> list[tuple[str, int]]:
        """Names and sizes of an entry's files."""
        with open(self._name(k)) as f:
            return [tuple(x) for x in json.load(f)]

    def append(self, files: list[tuple[str, int]]) -> None:
        os.makedirs(self.folder, exist_ok=True)
        draft = os.path.join(self.folder, f".{uuid.uuid4().hex}")
        with open(draft, "w") as f:
            json.dump(files, f)
        k = self.last() + 1
        while True:
            try:
                os.link(draft, self._name(k))
                break
            except FileExistsError:  # another stream's: its files are no news any more
                known = set(self.entry(k))
                files = [x for x in files if tuple(x) not in known]
                if not files:
                    break
                with open(draft, "w") as f:
                    json.dump(files, f)
                k += 1
        os.unlink(draft)


class _StreamReader(DataSourceStreamReader):
    """Files as they come, whatever their times and names, each once.

    The offset is a place in the log of files (:class:`FileLog`): what was planned for two
    offsets is planned again alike after a restart. A file must be whole when it appears
    under a name without a leading dot or underscore (moved there, not written there),
    and its name is its identity: one that is renamed later is another file.
    """

    def __init__(self, path: str, log: str, range_bytes: int):
        self.path, self.log, self.range_bytes = path, FileLog(log), range_bytes
        self.seen: set[str] = set()
        self.read_to = 0

    def initialOffset(self) -> dict:
        return {"entry": 0}

    def latestOffset(self) -> dict:
        self._catch_up()
        new = [(p, os.path.getsize(p)) for p in _files(self.path) if p not in self.seen]
        if new:
            self.log.append(new)
            self._catch_up()
        return {"entry": self.read_to}

    def _catch_up(self) -> None:
        while self.read_to < self.log.last():
            self.read_to += 1
            self.seen.update(name for name, _ in self.log.entry(self.read_to))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        entries = range(start["entry"] + 1, end["entry"] + 1)
        return [r for k in entries for name, size in self.log.entry(k) for r in _ranges(name, size, self.range_bytes)]

    def read(self, partition) -> Iterator[pa.RecordBatch]:
        yield from _batches(partition)


def closing_packet(after_ns: int, sensor_id: int = -1) -> bytes:
    """A frame that ends a finite stream: a sound message of one sensor, which makes no
    group, at a time that moves the watermark past all that came before ``after_ns``."""
    payload = HEAD.pack(sensor_id, 0.0, 0.0, 0.0, after_ns // 1_000_000_000, after_ns % 1_000_000_000) + bytes.fromhex("8D000001000000000000" + "00000000")
    return bytes([len(payload)]) + payload


def read_packets(spark, path: str) -> DataFrame:
    """Packets of a file or folder on any file system that Spark reads: whole files are
    binary rows, cut into frames where they are."""

    def run(batches):
        for b in batches:
            for data in b.column(0).to_pylist():
                yield pa.RecordBatch.from_arrays([pa.array(list(frames(data)), pa.binary())], names=["payload"])

    files = spark.read.format("binaryFile").load(path).select("content")
    return parse_payloads(files.mapInArrow(run, "payload binary"))
