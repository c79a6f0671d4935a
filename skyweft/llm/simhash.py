"""SimHash near-duplicates by the generalised pigeonhole principle.

A text is lower-cased (A-Z only), cut at ASCII white space into words and into
shingles of consecutive words (repeats included; fewer words are one shingle). A
fingerprint bit is 1 if it is set in over half of the shingles' XXH64 (seed 42);
no words give fingerprint zero, which links like any other. Fingerprints within
``tau`` bits link; components are those of the link graph.

Equal fingerprints collapse first, so copies cost one row each. For the distinct
ones the 64 bits are ordered so that correlated ones are neighbours, and a dynamic
programme cuts the order into parts of unequal widths and gives each a threshold t, -1
to ``tau``, such that t + 1 add up to ``tau`` + 1: two linked fingerprints are then
within t on some part. Costs are the rows emitted and the candidate pairs, estimated
for the number of fingerprints there are from the pairs of a bounded sample of them.
Estimates decide speed only.

Fingerprints that share a part's value (or a neighbour of it, for t > 0) meet in a
bucket. Buckets of at most ``COLD`` members are verified inside their row. Members
of larger ones emit their 65 words at distance 0 or 1 instead: two fingerprints
within 2 bits share one, and all that share one are within 2 bits, so a star replaces
the pairs. Every link's component is found without quadratic work in any bucket.
Components are found by large-star and small-star steps on the distributed links.

Null and empty texts have fingerprint zero. A null id takes part, and is never the
smallest unless all of its component are null. Repeated rows come out each. Other
columns are ignored, whatever their names. Texts are read whole; a very long one takes
about twelve bytes of a worker's memory a byte. An empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import discard, map_text, table, written

#: Production parameters.
SHINGLE = 3
TAU = 2
SEED = 42
COLD = 128
#: Distinct fingerprints sampled for cost estimates, smallest by hash: their 2 billion
#: pairs tell shares of 5e-10.
PLAN_SAMPLE = 65_536
#: Widths of parts are multiples of this many bits.
GRID = 4
#: Shingles of which hashes are held at a time.
SHINGLES = 200_000
#: Cost of a candidate pair that is verified, in rows that are emitted and shuffled.
PAIR_COST = 0.05

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
BITS = 64


def fingerprint_batch(texts: list, shingle: int = SHINGLE) -> np.ndarray:
    """Unsigned 64-bit fingerprints of texts. Shingles of short texts are counted together, those
    of a long one SHINGLES at a time."""
    from xxhash import xxh64_intdigest as xx

    out = np.zeros(len(texts), np.uint64)
    h: list[int] = []
    counts: list[int] = []
    which: list[int] = []

    def flush() -> None:
        if which:
            out[which] = _majority(_ones(h, counts), np.array(counts))
        h.clear(), counts.clear(), which.clear()

    for i, t in enumerate(texts):
        joined = b" ".join(t.encode("utf-8", "surrogatepass").translate(_LOWER).split()) if t else b""
        if not joined:
            continue
        ends = np.append(np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), len(joined))
        n = max(1, len(ends) - shingle + 1)
        starts, stops = np.append(0, ends[:-1] + 1)[:n], ends[min(shingle, len(ends)) - 1 :]
        hashed = lambda k: [xx(joined[a:b], SEED) for a, b in zip(starts[k : k + SHINGLES].tolist(), stops[k : k + SHINGLES].tolist())]
        if n > SHINGLES:
            ones = sum(_ones(part, [len(part)]).astype(np.int64) for part in map(hashed, range(0, n, SHINGLES)))
            out[i] = _majority(ones, np.array([n]))[0]
            continue
        h += hashed(0)
        which.append(i)
        counts.append(n)
        if len(h) > SHINGLES:
            flush()
    flush()
    return out


def _ones(h: list[int], counts: list[int]) -> np.ndarray:
    """How often each bit is set in each of the runs of ``counts`` hashes."""
    bits = np.unpackbits(np.array(h, np.uint64).byteswap().view(np.uint8).reshape(-1, 8), axis=1)
    return np.add.reduceat(bits, np.cumsum(counts) - counts, axis=0, dtype=np.int32)


def _majority(ones: np.ndarray, n: np.ndarray) -> np.ndarray:
    return np.packbits(ones * 2 > n[:, None], axis=1).view(np.uint64).reshape(-1).byteswap()


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """id and its fingerprint ``fp`` as a signed long, a row a document; no shuffle."""
    score = lambda texts: {"fp": fingerprint_batch(texts, shingle).view(np.int64)}
    return map_text(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), "text", ["id"], score, [("fp", T.LongType())])


# ---- the plan: parts and thresholds ------------------------------------------------


def bit_correlation(groups: DataFrame) -> tuple[int, np.ndarray]:
    """How many distinct fingerprints there are, and their 64 x 64 correlation."""

    def run(batches):
        total, n = np.zeros((BITS, BITS)), 0
        for b in batches:
            x = as_bits(b.column("fp").to_numpy().view(np.uint64)).astype(np.float32)
            total += x.T @ x
            n += len(x)
        cells = np.append(total.reshape(-1), n)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cells))), pa.array(cells)], names=["cell", "n"])

    rows = groups.select("fp").mapInArrow(run, "cell long, n double").groupBy("cell").agg(F.sum("n").alias("n")).collect()  # 4097 rows
    cells = np.zeros(BITS * BITS + 1)
    for r in rows:
        cells[r["cell"]] = r["n"]
    n = max(1.0, cells[-1])
    both = cells[:-1].reshape(BITS, BITS) / n
    p = np.diag(both)
    sd = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    return int(cells[-1]), (both - np.outer(p, p)) / np.outer(sd, sd)


def as_bits(fp: np.ndarray) -> np.ndarray:
    return np.unpackbits(fp.astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)


def bit_order(corr: np.ndarray) -> list[int]:
    """Bits (0 is the highest) in an order that keeps correlated ones together."""
    left, strength = set(range(BITS)), np.abs(corr)
    out = [max(left, key=lambda b: (strength[b].sum(), -b))]
    left.discard(out[0])
    while left:
        # each bit follows those that it goes with most, of the last few
        out.append(max(left, key=lambda b: (strength[b, out[-8:]].mean(), -b)))
        left.discard(out[-1])
    return out


def pair_shares(sample: np.ndarray, bits: list[int], tau: int) -> list[float]:
    """For t = 0 .. ``tau`` the share of all pairs that are within t on ``bits``, by
    exact counts over the sample's pairs, or what independent bits of the sample's bias
    would give if that is more (pairs too rare for the sample).

    Above t = 0 the pairs are counted that agree on all bits but one, for some bits.
    """
    pairs = max(1.0, len(sample) * (len(sample) - 1) / 2)

    def agreeing(mask: int) -> float:
        key = np.sort(sample & np.uint64(mask))
        n = np.diff(np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1], [True]]))).astype(float)
        return float((n * (n - 1) / 2).sum()) / pairs

    flag = [1 << (BITS - 1 - b) for b in bits]
    whole = sum(flag)
    ones = np.array([(sample & np.uint64(f) > 0).mean() if len(sample) else 0.5 for f in flag])
    alike = ones**2 + (1 - ones) ** 2
    base = float(np.exp(np.log(alike).sum()))
    same = max(agreeing(whole), base)
    out = [same]
    if tau > 0:
        odds = (1 - alike) / alike
        tried = flag[:: -(-len(flag) // 8)]  # about eight of the bits stand for all
        apart = sum(max(0.0, agreeing(whole & ~f) - same) for f in tried) * len(flag) / len(tried)
        out.append(same + max(apart, base * float(odds.sum())))
        if tau > 1:
            # of pairs two apart: those of the model, or as many more as one bit brings
            out.append(out[1] + max(base * float((odds.sum() ** 2 - (odds**2).sum()) / 2), (out[1] - same) ** 2 / max(same, 1e-300) / 2))
    return out


def choose(n: float, order: list[int], sample: np.ndarray, tau: int = TAU) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts of least cost for ``n`` distinct fingerprints.

    Parts are runs of ``order`` cut at multiples of ``GRID``. A dynamic programme over
    cuts and spent thresholds finds their number, widths and thresholds t at once: each
    part spends t + 1 (or 0: it is not probed), all spend ``tau`` + 1. A part's cost is
    the rows that it emits and, at ``PAIR_COST`` each, the candidate pairs expected.
    No part spends all: there are always two that are probed, or more.
    """
    cuts = range(0, BITS + 1, GRID)
    wide = {(i, j): pair_shares(sample, order[i:j], tau - 1) for i in cuts for j in cuts if i < j and j - i < BITS}
    best: dict[tuple[int, int], tuple] = {(0, 0): (0.0, ())}
    for j in cuts[1:]:
        for i in [c for c in cuts if c < j and (c, j) in wide]:
            for u in range(tau + 1):
                t = u - 1
                cost = 0.0 if t < 0 else n * (1 if t == 0 else 1 + j - i) + PAIR_COST * wide[i, j][t] * n * n / 2
                for used in range(tau + 2 - u):
                    if (i, used) in best:
                        c, parts = best[i, used]
                        x = (c + cost, (*parts, (i, j, t)))
                        if (j, used + u) not in best or x < best[j, used + u]:
                            best[j, used + u] = x
    return [(sorted(order[i:j]), t) for i, j, t in best[BITS, tau + 1][1] if t >= 0]


def plan(groups: DataFrame, tau: int = TAU) -> list[tuple[list[int], int]]:
    """(bits, threshold) of the parts to probe, from all fingerprints' correlation and
    number and the pairs of a bounded sample."""
    n, corr = bit_correlation(groups)
    rows = groups.select("fp").orderBy(F.xxhash64("fp", F.lit(5)), "fp").limit(PLAN_SAMPLE).toArrow()
    return choose(max(n, 1), bit_order(corr), rows.column("fp").to_numpy().view(np.uint64), tau)


# ---- links -------------------------------------------------------------------------


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _flip(bit: int) -> int:
    return _signed(1 << (BITS - 1 - bit))


def _emitted(k: int, bits: list[int], t: int) -> list:
    """Arrays of (part, key, d): the part's own value and, for t > 0, its neighbours."""
    key = F.col("fp").bitwiseAND(F.lit(_signed(sum(1 << (BITS - 1 - b) for b in bits))))
    of = lambda x, d: F.struct(F.lit(k).alias("part"), x.alias("key"), F.lit(d).alias("d"))
    out = [F.array(of(key, 0))]
    if t > 0:
        out.append(F.transform(F.array(*[F.lit(_flip(b)) for b in bits]), lambda f: of(key.bitwiseXOR(f), 1)))
    return out


def links(groups: DataFrame, tau: int = TAU, parts: list | None = None, cold: int = COLD) -> DataFrame:
    """Links (a, b) of distinct fingerprints whose components are those of all links."""
    if tau not in (1, 2):
        raise ValueError("tau is 1 or 2")
    parts = plan(groups, tau) if parts is None else parts
    fps = groups.select("fp")
    emitted = [x for k, (bits, t) in enumerate(parts) for x in _emitted(k, bits, t)]
    keys = fps.select("fp", F.inline(F.concat(*emitted)))
    # at t = 1 two neighbours that meet are two apart: a bucket needs a member of its own
    exact = F.col("part").isin([k for k, (_, t) in enumerate(parts) if t < 2])
    shared = keys.groupBy("part", "key").agg(F.count("*").alias("count"), F.min("d").alias("least")).where(F.col("count") > 1).where(~exact | (F.col("least") == 0)).drop("least")
    met = written(keys.join(shared, ["part", "key"]))
    member = F.struct("fp", "d")
    near = lambda x, y: (y["fp"] > x["fp"]) & (F.bit_count(x["fp"].bitwiseXOR(y["fp"])) <= tau)
    buckets = met.where(F.col("count") <= cold).groupBy("part", "key").agg(F.collect_list(member).alias("ms"))
    found = F.flatten(F.transform("ms", lambda x: F.transform(F.filter("ms", lambda y: near(x, y)), lambda y: F.struct(x["fp"].alias("a"), y["fp"].alias("b")))))
    few = buckets.select(F.inline(found))
    many = _stars(met.where(F.col("count") > cold).select("fp").distinct(), tau)
    return few.union(many).distinct()


def _stars(fps: DataFrame, tau: int) -> DataFrame:
    """Links by shared words at distance 0 or 1; a word has at most 65 sharers.

    With tau = 1 only a word that is itself a fingerprint links, to its neighbours.
    """
    flips = F.array(F.lit(0).cast("long"), *[F.lit(_flip(b)) for b in range(BITS)])
    words = fps.select("fp", F.explode(flips).alias("flip")).select("fp", F.col("fp").bitwiseXOR(F.col("flip")).alias("word"))
    by = words.groupBy("word").agg(F.collect_set("fp").alias("ms")).where(F.size("ms") > 1)
    if tau == 1:
        by = by.where(F.array_contains("ms", F.col("word")))
    hub = F.array_min("ms") if tau == 2 else F.col("word")
    return by.select(hub.alias("hub"), F.explode("ms").alias("fp")).where("fp <> hub").select(F.least("hub", "fp").alias("a"), F.greatest("hub", "fp").alias("b")).distinct()


# ---- components --------------------------------------------------------------------


def roots(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root (the smallest node of its component) of all nodes on edges (a, b).

    Alternating large-star and small-star steps until nothing changes. Minima are
    pre-aggregated; a hub's edges meet its minimum in a join that can be split. Rounds
    grow with the logarithm of the longest path; it is an error if ``rounds`` of them,
    enough for any graph that can be stored, do not suffice.
    """
    now = written(edges.select("a", "b"))
    before = None
    for _ in range(rounds):
        both = now.union(now.select(F.col("b"), F.col("a"))).toDF("u", "v")
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("low"))
        # large star: each larger neighbour of u links to the smallest around u
        large = both.where("v > u").join(low, "u").select(F.col("low").alias("a"), F.col("v").alias("b")).distinct()
        # small star: u and its smaller neighbours link to the smallest of them
        down = large.toDF("v", "u")
        low = down.groupBy("u").agg(F.min("v").alias("low"))
        small = down.join(low, "u").select(F.col("low").alias("a"), F.col("v").alias("b")).union(low.select(F.col("low").alias("a"), F.col("u").alias("b")))
        nxt = written(small.where("a <> b").distinct())
        discard(now)
        now = nxt
        state = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before or state[0] == 0:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return now.select(F.col("b").alias("node"), F.col("a").alias("root")).union(now.select("a", "a").distinct())


def component_of_fp(fps: DataFrame, tau: int = TAU, parts: list | None = None, cold: int = COLD) -> DataFrame:
    """fp, root and component_id of the distinct fingerprints of ``fps`` (id, fp).

    The root is the smallest fingerprint of the component: components whose ids are
    all null, or that share their smallest id, differ in it.
    """
    groups = written(fps.groupBy("fp").agg(F.min("id").alias("first")))
    node = written(roots(links(groups, tau, parts, cold)))
    members = node.join(groups, node["node"] == groups["fp"]).groupBy("root").agg(F.min("first").alias("component_id"))
    linked = node.join(members, "root").select(F.col("node").alias("fp"), "root", "component_id")
    alone = groups.join(node, groups["fp"] == node["node"], "left_anti")
    return linked.union(alone.select("fp", F.col("fp").alias("root"), F.col("first").alias("component_id")))


def with_components(fps: DataFrame, tau: int = TAU, parts: list | None = None, cold: int = COLD) -> DataFrame:
    """id, fp and component_id of every row of ``fps`` (id, fp)."""
    fps = written(fps)
    return fps.join(component_of_fp(fps, tau, parts, cold), "fp").select("id", "fp", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """id, fingerprint (hex) and component_id, a row a document."""
    found = with_components(fingerprints(docs, id_col, text_col, shingle), tau)
    return found.select(F.col("id").alias(id_col), hexed("fp").alias("fingerprint"), "component_id")


def hexed(col: str):
    return F.lower(F.lpad(F.hex(F.col(col)), 16, "0"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, tau: int = TAU) -> DataFrame:
    """``docs`` with one document of each component: the row of the smallest id.

    Components are told apart by their roots, so that those without ids, or with the
    same smallest id, keep one document each. All columns stay. Of rows that repeat that id the one with the smallest hash of
    its text stays, then of its whole row: each task picks its own of them first, so that no
    number of repeats is one task's. Only ids and hashes meet before the kept rows' texts
    move.
    """
    text_hash = F.xxhash64(F.col(text_col))
    score = lambda texts: {"fp": fingerprint_batch(texts, shingle).view(np.int64)}
    src = docs.select(F.col(id_col).alias("id"), text_hash.alias("h"), F.col(text_col).alias("text"))
    rows = written(map_text(src, "text", ["id", "h"], score, [("fp", T.LongType())]))
    of = component_of_fp(rows, tau)
    first = rows.join(of, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    keep = first.groupBy("root").agg(F.min(F.struct("h", "id")).alias("m")).select(F.col("m.id").alias("__skyweft_id"), F.col("m.h").alias("__skyweft_h"))
    marked = docs.withColumn("__skyweft_text", text_hash).join(keep.distinct(), F.col(id_col).eqNullSafe(F.col("__skyweft_id")) & (F.col("__skyweft_text") == F.col("__skyweft_h")))
    own = [F.col(f"`{c}`") for c in docs.columns]
    # maps have no hash of their own
    hashed = F.xxhash64(*[F.to_json(c) if "map<" in kind else c for c, (_, kind) in zip(own, docs.dtypes)])
    one = marked.groupBy("__skyweft_id", "__skyweft_h").agg(F.min_by(F.struct(*own), hashed).alias("__skyweft_row"))
    return one.select(*[F.col(f"__skyweft_row.`{c}`") for c in docs.columns])


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


QUERIES = {"op6_simhash": op6_simhash}
ORACLES: dict[str, str] = {}
