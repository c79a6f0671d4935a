"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree.

All DataFrame functions; no Python runs on the executors.

1. Sizes (words) of all documents, their sources' totals and targets. Sources in
   order (null last) weigh 5, 2, 1, repeating, and share 100 % of all words; a
   target stops at ``MOST`` times its source's size and the excess is reshared.
2. Each source's words, its documents in hashed order, are one line, cut into equal
   blocks. A source's quota is the number of blocks whose words come nearest its
   target; over one epoch it takes whole epochs and part of the last.
3. The quotas are split over the output shards by a binary tree. At each node the
   left half's share of every source is drawn, source by source, from the
   hypergeometric distribution given what is left, so that the leaves are exact
   quotas and each shard is a fair random mix of the whole.
4. In each epoch a keyed permutation (swap-or-not) orders the source's blocks; each
   shard's quota is the next run of it, so the shards' blocks are disjoint.
   :func:`shards` cuts the words out and shuffles each shard locally by a hash.

Draws and orders are hashes of ``seed``, so reruns agree. A null text has size 0;
a null source is a source of its own. Documents of size 0 are taken 0 times.
Repeated rows are documents each; where they tie in order, they are alike. With no
words at all the targets are 0. An empty table gives no rows. A very long text is one
document of many blocks; only its size and pieces are held. Extra columns are ignored.
Sources are a dimension: one small row each, put in order and levelled in one sort.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from skyweft.llm.common import table, written

#: Production parameters.
WEIGHTS = (5.0, 2.0, 1.0)
MOST = 3
SHARDS = 16
BLOCK_WORDS = 256
SEED = 42
#: Rows that one bucket of a source holds, on average, while lines are laid out.
BUCKET_ROWS = 1_000
#: Sources that one row of the splitting tree holds, on average.
TREE_SOURCES = 256
#: Rounds of the block permutation.
ROUNDS = 12
WORD = r"[^\x20\x09-\x0D]+"


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """doc_id, source, size and ``h``, a hash of the text that tells apart rows of one id."""
    words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    return docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), words.alias("size"), F.xxhash64(F.col(text_col)).alias("h"))


def targets(sized: DataFrame, weights: tuple = WEIGHTS, most: float = MOST) -> DataFrame:
    """source, source_size, target: one row a source, by water-filling.

    A source is capped if its cap per weight is under the level that the others
    share. In order of that ratio, the level after capping the first k sources is
    (all words - their caps) / (weights of the rest); the first k at which the next
    ratio is no longer under the level is where capping ends.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # a row a source
    w = F.get(F.array(*map(F.lit, weights)), ((F.row_number().over(order) - 1) % len(weights)).cast("int"))
    by = by.withColumn("w", w).withColumn("cap", F.lit(float(most)) * F.col("source_size"))
    ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before, rest, whole = ratio.rowsBetween(Window.unboundedPreceding, -1), ratio.rowsBetween(0, Window.unboundedFollowing), Window.partitionBy()
    by = by.withColumn("ratio", F.col("cap") / F.col("w"))
    by = by.withColumn("level", (F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum("w").over(rest))
    by = by.withColumn("level", F.min(F.when(F.col("ratio") >= F.col("level"), F.struct("ratio", "source", "level"))).over(whole)["level"])
    share = F.when((F.col("ratio") < F.col("level")) | F.col("level").isNull(), F.col("cap")).otherwise(F.col("w") * F.col("level"))
    return by.select("source", "source_size", share.alias("target"))


def quotas(goal: DataFrame, block_words: int, most: int) -> DataFrame:
    """Adds words a block, blocks of the source and the quota of blocks to draw."""
    block = F.greatest(F.lit(1), F.least(F.lit(block_words), F.floor(F.col("source_size") / 512))).cast("long")
    goal = goal.withColumn("block", block).withColumn("blocks", F.ceil(F.col("source_size") / F.col("block")).cast("long"))
    quota = F.least(F.round(F.col("target") * F.col("blocks") / F.col("source_size")).cast("long"), most * F.col("blocks"))
    return goal.withColumn("quota", F.when(F.col("source_size") > 0, quota).otherwise(F.lit(0).cast("long")))


def _let(value, use):
    """``use(value)`` with ``value`` evaluated once, whatever ``use`` does with it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _log_factorial(n):
    """ln n! of a double column, by Stirling's series shifted by 8."""

    def series(m):
        shift = (m + 1) * (m + 2) * (m + 3) * (m + 4) * (m + 5) * (m + 6) * (m + 7) * (m + 8)
        return _let(m + 9.0, lambda z: (z - 0.5) * F.log(z) - z + 0.5 * math.log(2 * math.pi) + 1 / (12 * z) - 1 / (360 * z * z * z)) - F.log(shift)

    return _let(n, series)


def _hypergeometric(total, good, drawn, u):
    """One draw by inversion: good ones among ``drawn`` of ``total``, ``good`` of them good.

    The range is the mean and 10 standard deviations to either side, within what is
    possible; what lies outside has a chance under 1e-20.
    """
    ln = lambda a, b: _log_factorial(a) - _log_factorial(b) - _log_factorial(a - b)
    case = F.struct(total.cast("double").alias("t"), good.cast("double").alias("g"), drawn.cast("double").alias("d"), u.alias("u"))

    def within(c):
        share = c["g"] / F.greatest(c["t"], F.lit(1.0))
        var = c["d"] * share * (1 - share) * (c["t"] - c["d"]) / F.greatest(c["t"] - 1, F.lit(1.0))
        return F.struct(c.alias("c"), (c["d"] * share).alias("mean"), F.sqrt(F.greatest(F.lit(0.0), var)).alias("sd"))

    def bounds(w):
        c = w["c"]
        lo = F.greatest(F.lit(0.0), c["d"] - (c["t"] - c["g"]), F.floor(w["mean"] - 10 * w["sd"] - 3))
        hi = F.least(c["g"], c["d"], F.ceil(w["mean"] + 10 * w["sd"] + 3))
        return F.struct(c.alias("c"), lo.cast("long").alias("lo"), hi.cast("long").alias("hi"))

    def invert(r):
        c, x = r["c"], r["lo"].cast("double")
        # chances built up from the low end, in logarithms
        first = ln(c["g"], x) + ln(c["t"] - c["g"], c["d"] - x) - ln(c["t"], c["d"])

        def step(acc, k):
            below = acc["sum"] + F.exp(acc["ln"])
            ratio = (c["g"] - k) * (c["d"] - k) / ((k + 1) * (c["t"] - c["g"] - c["d"] + k + 1))
            return F.struct(
                (acc["ln"] + F.when(ratio > 0, F.log(ratio)).otherwise(F.lit(-1e9))).alias("ln"),
                below.alias("sum"),
                F.when(below < c["u"], k + 1).otherwise(acc["k"]).alias("k"),
            )

        start = F.struct(first.alias("ln"), F.lit(0.0).alias("sum"), r["lo"].alias("k"))
        return F.least(r["hi"], F.aggregate(F.sequence(r["lo"], r["hi"]), start, step)["k"])

    return _let(_let(_let(case, within), bounds), invert)


def _uniform(*keys):
    """In [0, 1), from a hash."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


def split_tree(goal: DataFrame, shards: int, seed: int) -> DataFrame:
    """source and its cumulative quotas over the shards: ``ends`` array<long>.

    A node is a row: the first shard, how many it covers, and an array of its
    sources' quotas. A level of the tree splits every node in two at once. Over
    TREE_SOURCES sources are grouped by hash: a tree splits the groups' sums, and in
    each group a tree of its own splits what that one gave it, so no row or task holds
    all sources.
    """
    n = goal.count()
    keyed = goal.withColumn("group", F.pmod(F.xxhash64("source", F.lit(seed)), F.lit(math.ceil(n / TREE_SOURCES) or 1)))
    nodes = keyed.groupBy("group").agg(F.array_sort(F.collect_list(F.struct(F.col("source"), F.col("quota").alias("q")))).alias("qs"))
    if n > TREE_SOURCES:
        above = split_tree(keyed.groupBy(F.col("group").cast("string").alias("source")).agg(F.sum("quota").alias("quota")), shards, seed + 1)
        nodes = nodes.join(above.select(F.col("source").cast("long").alias("group"), F.col("ends").alias("given")), "group")
    else:
        nodes = nodes.withColumn("given", F.lit(None).cast("array<bigint>"))
    nodes = nodes.select(F.lit(0).alias("shard"), F.lit(shards).alias("width"), "given", "qs")
    for _ in range(max(0, math.ceil(math.log2(shards)))):
        left = F.floor(F.col("width") / 2).cast("int")
        total = F.aggregate("qs", F.lit(0).cast("long"), lambda a, x: a + x["q"])
        # the left half takes its shards' share of all blocks, to the next whole one, or
        # what the tree above gave its shards
        upto = lambda k: F.when(k > 0, F.get("given", k - 1)).otherwise(F.lit(0).cast("long"))
        share = F.floor(F.col("total") * F.col("left") / F.col("width")).cast("long")
        nodes = nodes.withColumn("left", left).withColumn("total", total)
        nodes = nodes.withColumn("want", F.when(F.col("given").isNull(), share).otherwise(upto(F.col("shard") + F.col("left")) - upto(F.col("shard"))))

        def draw(acc, x):
            u = _uniform(x["source"], F.col("shard"), F.col("width"), F.lit(seed))
            k = F.when(acc["total"] > x["q"], _hypergeometric(acc["total"], x["q"], acc["want"], u)).otherwise(acc["want"])
            return F.struct((acc["total"] - x["q"]).alias("total"), (acc["want"] - k).alias("want"), F.concat(acc["out"], F.array(k)).alias("out"))

        zero = F.struct(F.col("total"), F.col("want"), F.array().cast("array<bigint>").alias("out"))
        nodes = nodes.withColumn("k", F.aggregate("qs", zero, draw)["out"])
        halves = F.array(
            F.struct(F.col("shard"), F.col("left").alias("width"), "given", F.zip_with("qs", "k", lambda x, k: F.struct(x["source"].alias("source"), k.alias("q"))).alias("qs")),
            F.struct(
                (F.col("shard") + F.col("left")).alias("shard"),
                (F.col("width") - F.col("left")).alias("width"),
                "given",
                F.zip_with("qs", "k", lambda x, k: F.struct(x["source"].alias("source"), (x["q"] - k).alias("q"))).alias("qs"),
            ),
        )
        nodes = nodes.select(F.inline(F.filter(halves, lambda h: h["width"] > 0)))
    leaf = nodes.select("shard", F.inline("qs"))
    ends = leaf.groupBy("source").agg(F.array_sort(F.collect_list(F.struct("shard", "q"))).alias("by"))
    add = lambda a, x: F.concat(a, F.array(F.coalesce(F.element_at(a, -1), F.lit(0).cast("long")) + x["q"]))
    # element_at of an empty array fails under ANSI, so sums start from one zero
    return ends.select("source", F.slice(F.aggregate("by", F.array(F.lit(0).cast("long")), add), 2, shards).alias("ends"))


def laid_out(sized: DataFrame, seed: int) -> DataFrame:
    """Adds ``at``: the words of the source that come before the document's own.

    Sources are laid out in buckets of about BUCKET_ROWS rows, by a hash of id and
    text, and the buckets' words are added up within and over runs of BUCKET_ROWS
    buckets, so that no source, however hot, is ordered in one task.
    """
    n = sized.count()
    buckets = max(1, math.ceil(n / BUCKET_ROWS))
    keyed = sized.withColumn("k", F.xxhash64("doc_id", "h", F.lit(seed))).withColumn("bucket", F.pmod("k", F.lit(buckets)))
    totals = keyed.groupBy("source", "bucket").agg(F.sum("size").alias("words")).withColumn("run", F.floor(F.col("bucket") / BUCKET_ROWS))
    prior = lambda by, order: F.coalesce(F.sum("words").over(Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    within = totals.select(F.col("source").alias("s"), F.col("bucket").alias("b"), F.col("run").alias("r"), prior(["source", "run"], "bucket").alias("base"))
    if buckets > BUCKET_ROWS:
        runs = totals.groupBy("source", "run").agg(F.sum("words").alias("words")).select(F.col("source").alias("s2"), F.col("run").alias("r2"), prior(["source"], "run").alias("more"))
        within = within.join(runs, within["s"].eqNullSafe(runs["s2"]) & (within["r"] == runs["r2"])).withColumn("base", F.col("base") + F.col("more"))
    inside = Window.partitionBy("source", "bucket").orderBy("k", "doc_id", "h", "size").rowsBetween(Window.unboundedPreceding, -1)
    keyed = keyed.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    within = within.select("s", "b", "base")
    found = keyed.join(within, keyed["source"].eqNullSafe(within["s"]) & (keyed["bucket"] == within["b"]))
    return found.select("doc_id", "source", "size", "h", (F.col("base") + F.col("before")).alias("at"))


def _position(block, blocks, *keys):
    """Where a keyed permutation of 0 .. blocks - 1 puts ``block``: swap-or-not."""

    def swap(x, r):
        partner = F.pmod(F.pmod(F.xxhash64(r, *keys), blocks) - x, blocks)
        return F.when(F.pmod(F.xxhash64(F.greatest(x, partner), r, F.lit(1), *keys), F.lit(2)) == 1, partner).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), block, swap)


def mix(
    docs: DataFrame,
    weights: tuple = WEIGHTS,
    most: int = MOST,
    shards: int = SHARDS,
    block_words: int = BLOCK_WORDS,
    seed: int = SEED,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, source, size, source_size, target, h, pieces, shards: a row a document.

    ``pieces``: array<struct<shard, rank, first, words>>, the word ranges that the
    mix takes and the shard that each goes to; ``rank`` orders a shard.
    """
    return plan(written(sizes(docs, id_col, source_col, text_col)), weights, most, shards, block_words, seed)


def plan(sized: DataFrame, weights: tuple, most: int, shards: int, block_words: int, seed: int) -> DataFrame:
    goal = written(quotas(targets(sized, weights, most), block_words, most))
    tree = split_tree(goal, shards, seed)
    per_source = goal.join(tree, goal["source"].eqNullSafe(tree["source"]), "left").select(goal["source"].alias("s"), "source_size", "target", "block", "blocks", "quota", "ends")
    # rows are few bytes but costly to place, so they are dealt out again, not coalesced
    placed = laid_out(sized, seed).repartition(int(sized.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    d = placed.join(per_source, placed["source"].eqNullSafe(per_source["s"])).drop("s")
    first, last = F.floor(F.col("at") / F.col("block")), F.floor((F.col("at") + F.col("size") - 1) / F.col("block"))
    epochs = F.sequence(F.lit(0).cast("long"), F.floor((F.col("quota") - 1) / F.col("blocks")))
    start = lambda b: F.greatest(b * F.col("block"), F.col("at"))
    end = lambda b: F.least((b + 1) * F.col("block"), F.col("at") + F.col("size"))

    def piece(b, e):
        j = e * F.col("blocks") + _position(b, F.col("blocks"), F.col("source"), e, F.lit(seed))
        return F.struct(
            F.size(F.filter("ends", lambda c: c <= j)).alias("shard"),
            F.xxhash64(F.col("source"), b, e, F.lit(seed + 1)).alias("rank"),
            (start(b) - F.col("at")).alias("first"),
            (end(b) - start(b)).alias("words"),
        )

    every = F.flatten(F.transform(F.sequence(first, last), lambda b: F.transform(epochs, lambda e: piece(b, e))))
    # the tree's last leaf ends at the quota: a block past it is in no shard
    pieces = F.when((F.col("size") > 0) & (F.col("quota") > 0), F.filter(every, lambda p: p["shard"] < shards))
    return d.select("doc_id", "source", "size", "source_size", "target", "h", F.coalesce(pieces, F.array()).alias("pieces"), F.lit(shards).alias("shards"))


def taken(mixed: DataFrame) -> DataFrame:
    """What each shard takes of a document, ``shard_words``, and the sum of it, ``taken``."""
    none = F.lit(0).cast("long")
    # one pass over the pieces: inside a lambda they would be worked out for each shard
    add = lambda by, p: F.transform(by, lambda n, k: n + F.when(k == p["shard"], p["words"]).otherwise(none))
    by = mixed.withColumn("shard_words", F.aggregate("pieces", F.array_repeat(none, F.col("shards")), add))
    return by.select("doc_id", "size", "source_size", "target", F.aggregate("shard_words", none, lambda a, n: a + n).alias("taken"), "shard_words")


def shards(docs: DataFrame, mixed: DataFrame, n_shards: int = SHARDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: shard, source, doc_id, text - each shard shuffled locally.

    Texts meet their pieces by id (null is one) and text hash. Rows that repeat both
    have pieces each and one text, which goes with each row once: it is cut into its words once,
    and the pieces are slices of them. A shard is one key; ranks split it further if it
    is large.
    """
    p = mixed.where(F.size("pieces") > 0).select(F.col("doc_id").alias("p_id"), F.col("h").alias("p_h"), "source", "pieces")
    texts = docs.select(F.col(id_col).alias("id"), F.xxhash64(F.col(text_col)).alias("h"), F.col(text_col).alias("t")).groupBy("id", "h").agg(F.first("t").alias("t"))
    cut = p.join(texts, p["p_id"].eqNullSafe(texts["id"]) & (p["p_h"] == texts["h"]))
    # a generator in between: the words would else be found again for each piece
    cut = cut.select("source", F.col("id").alias("doc_id"), "pieces", F.explode(F.array(F.regexp_extract_all(F.col("t"), F.lit(f"({WORD})"), F.lit(1)))).alias("ws"))
    part = lambda p: F.array_join(F.slice("ws", (p["first"] + 1).cast("int"), p["words"].cast("int")), " ")
    each = F.transform("pieces", lambda p: F.struct(p["shard"].alias("shard"), p["rank"].alias("rank"), p["first"].alias("first"), part(p).alias("text")))
    cut = cut.select("source", "doc_id", F.inline(each)).select("shard", "rank", "source", "doc_id", "first", "text")
    return cut.repartitionByRange(n_shards, "shard", "rank").sortWithinPartitions("shard", "rank", "doc_id", "first")


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return taken(mix(table(spark, sf_dir, "documents")))


QUERIES = {"op3_mixing": op3_mixing}
ORACLES: dict[str, str] = {}
