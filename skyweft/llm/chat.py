"""Chat formatting: fold event logs of conversations into messages and render them.

A log row is an event: ``conv_id``, ``seq``, ``kind``, ``turn``, ``role``, ``text``.
Rows are partitioned by conversation, sorted by (seq, role, text), nulls first, and
folded in that order:

* ``message`` (or null): sets the text and role of its turn; a null turn appends
  a message after all others.
* ``delta``: appends its text to the turn, which it begins if need be.
* ``edit``: replaces the turn's text and drops all later turns.
* ``regenerate``: empties the turn and drops all later turns; deltas refill it.

Other kinds are ignored. Messages come out by turn. Null texts and roles are
empty; rows with a null conv_id are one conversation; repeated rows of turn-less
messages are messages each. An empty log gives no rows. One conversation's final
text is one output string, so it must fit a worker; nothing else is held.

Rendering marks each turn as ``<|turn|>role\\n text<|end|>`` after ``<s>``. Control
strings inside texts and roles (those of this template and of common others) are
escaped with a backslash, which doubles itself: the output parses back exactly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import small_batches, table

BOS, TURN, END = "<s>", "<|turn|>", "<|end|>"
#: Control strings of this and other public templates (fixed values).
CONTROL = (BOS, "</s>", TURN, END, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>", "<|endoftext|>", "<|startoftext|>")
#: The role whose text is under the loss mask.
LOSS_ROLE = "assistant"

_ESCAPE = re.compile(r"\\|" + "|".join(re.escape(c) for c in sorted(CONTROL, key=len, reverse=True)))
_SAFE = {"<": "\\l", "[": "\\b", "\\": "\\\\"}
_BACK = {"l": "<", "b": "[", "\\": "\\", "n": "\n"}
_UNESCAPE = re.compile(r"\\([lbn\\])")

EVENTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("seq", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()),
        T.StructField("text", T.StringType()),
    ]
)
FORMATTED = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("formatted", T.StringType()),
        T.StructField("loss_starts", T.ArrayType(T.IntegerType())),
        T.StructField("loss_ends", T.ArrayType(T.IntegerType())),
    ]
)
DIGESTS = T.StructType(
    [
        T.StructField("conv_id", T.LongType()),
        T.StructField("n_turns", T.LongType()),
        T.StructField("turns_sha256", T.StringType()),
        T.StructField("loss_chars", T.LongType()),
        T.StructField("loss_sha256", T.StringType()),
        T.StructField("formatted_chars", T.LongType()),
    ]
)


def escape(text: str) -> str:
    """No control string is left: each begins with < or [, and those go."""
    return _ESCAPE.sub(lambda m: _SAFE[m[0][0]] + m[0][1:], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(lambda m: _BACK[m[1]], text)


def escape_role(role: str) -> str:
    return escape(role).replace("\n", "\\n")


class Fold:
    """One conversation's messages so far."""

    def __init__(self):
        self.turns: dict[int, list] = {}  # turn: [role, parts of the text]
        self.last = -1

    def add(self, kind: str | None, turn: int | None, role: str | None, text: str | None) -> None:
        kind, text = kind or "message", text or ""
        if turn is None:
            turn = self.last + 1
        self.last = max(self.last, turn)
        if kind == "delta" and turn in self.turns:
            self.turns[turn][1].append(text)
        elif kind in ("message", "delta"):
            self.turns[turn] = [role or "", [text]]
        elif kind in ("edit", "regenerate"):
            was = self.turns.get(turn, ["", []])[0]
            self.turns = {k: v for k, v in self.turns.items() if k < turn}
            self.turns[turn] = [role or was, [text] if kind == "edit" else []]
            self.last = turn

    def messages(self) -> list[tuple[str, str]]:
        return [(r, "".join(t)) for _, (r, t) in sorted(self.turns.items())]


def render(messages: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The formatted text and the code-point spans under the loss mask."""
    parts, size, starts, ends = [BOS], len(BOS), [], []
    for role, text in messages:
        head, body = f"{TURN}{escape_role(role)}\n", escape(text)
        size += len(head)
        if role == LOSS_ROLE:
            starts.append(size)
            ends.append(size + len(body))
        size += len(body) + len(END)
        parts += [head, body, END]
    return "".join(parts), starts, ends


def parse(formatted: str) -> list[tuple[str, str]]:
    """The messages that :func:`render` got."""
    out, at = [], len(BOS)
    while at < len(formatted):
        line = formatted.index("\n", at)
        end = formatted.index(END, line)
        out.append((unescape(formatted[at + len(TURN) : line]), unescape(formatted[line + 1 : end])))
        at = end + len(END)
    return out


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list[tuple[str, str]]]]:
    """Conversations of a partition sorted by conv_id, one at a time."""
    now, fold = None, None
    for b in batches:
        cols = [b.column(n).to_pylist() for n in ("conv_id", "kind", "turn", "role", "text")]
        for conv, kind, turn, role, text in zip(*cols):
            if fold is None or conv != now:
                if fold is not None:
                    yield now, fold.messages()
                now, fold = conv, Fold()
            fold.add(kind, turn, role, text)
    if fold is not None:
        yield now, fold.messages()


def format_conversations(events: DataFrame) -> DataFrame:
    """conv_id, n_turns, the formatted text and its loss spans, a row a conversation."""
    from pyspark.sql.pandas.types import to_arrow_schema

    small_batches(events.sparkSession)
    # one shuffle; the sort spills, so that a worker holds one conversation's result only
    src = events.select(*[F.col(f.name).cast(f.dataType) for f in EVENTS]).repartition("conv_id").sortWithinPartitions("conv_id", "seq", "role", "text")
    arrow = to_arrow_schema(FORMATTED)

    def run(batches):
        rows, size = [], 0
        for conv, messages in _folded(batches):
            text, starts, ends = render(messages)
            rows.append((conv, len(messages), text, starts, ends))
            size += len(text)
            if size > 1 << 22:
                yield _batch(rows, arrow)
                rows, size = [], 0
        if rows:
            yield _batch(rows, arrow)

    return src.mapInArrow(run, FORMATTED)


def _batch(rows: list[tuple], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), arrow)], schema=arrow)


def digests(formatted: DataFrame) -> DataFrame:
    """What can be read back from formatted texts, as digests."""
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(DIGESTS)

    def run(batches):
        for b in batches:
            rows = []
            for conv, text, starts, ends in zip(*[b.column(n).to_pylist() for n in ("conv_id", "formatted", "loss_starts", "loss_ends")]):
                turns = parse(text)
                loss = "".join(unescape(text[s:e]) for s, e in zip(starts, ends))
                all_turns = "".join(f"{r}\n{t}\n" for r, t in turns)
                rows.append((conv, len(turns), sha256(all_turns), len(loss), sha256(loss), len(text)))
            if rows:
                yield _batch(rows, arrow)

    return formatted.mapInArrow(run, DIGESTS)


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def conversation_events(rows: DataFrame) -> DataFrame:
    """Rows by turn as a log in which each row is one whole message."""
    null = F.lit(None)
    return rows.select(
        F.col("conv_id").cast("long"), F.col("turn").cast("long").alias("seq"), F.lit("message").alias("kind"), null.cast("long").alias("turn"), "role", "text"
    )


PROBE = "</s>[INST] ok [/INST]"


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise(LOSS_ROLE).alias("role"),
        F.lit(PROBE).alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(probe)
    return digests(format_conversations(conversation_events(rows)))


def _sql_escaped(x: str) -> str:
    """Characters that escaping adds: one for each backslash and control string."""
    return f"len(regexp_extract_all({x}, '{_ESCAPE.pattern}'))"


_ROWS = f"SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '{PROBE}'), (-1, 1, '{LOSS_ROLE}', '{PROBE}'))"
_MARKS = len(TURN) + 1 + len(END)

QUERIES = {"op1_chat_format": op1_chat_format}
ORACLES = {
    "op1_chat_format": f"""
WITH r AS (SELECT conv_id, turn, role AS r0, text AS t0, coalesce(role, '') AS role, coalesce(text, '') AS text FROM ({_ROWS}))
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = '{LOSS_ROLE}'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, r0 NULLS FIRST, t0 NULLS FIRST) FILTER (role = '{LOSS_ROLE}'), '')) AS loss_sha256,
  ({len(BOS)} + sum({_MARKS} + length(role) + length(text) + {_sql_escaped("role")} + {_sql_escaped("text")} + length(role) - length(replace(role, chr(10), ''))))::BIGINT AS formatted_chars
FROM r GROUP BY conv_id"""
}
