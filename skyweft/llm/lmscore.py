"""LM scoring: cross-entropy difference of matched target and background models.

Both models are bigram models of the same vocabulary, order and smoothing. The
background's counts are of all documents, the target's of all documents in its domain
(in the query: every one labelled of good quality), whatever their number. Up to
TARGET_IDS ids of the target are broadcast, so that no text is shuffled to learn which is
which; more ids meet the texts in one shuffle. Either way all is counted in one pass. A
document's score is its mean loss
per token under the target less that under the background: the lower, the closer to
the target.

Counts cover all words of all documents: each task sums its own before they are
shuffled. The vocabulary is the VOCAB most frequent words, ties by the word's bytes; others
are one unknown word. p(b|a) = max(c(a,b) - D, 0) / c(a) + rest(a) p(b), where rest(a)
is D times the distinct words after a, over c(a).

All counted bigrams are scored with their counts. Those with the highest background
counts, as many classes of counts as fit into NGRAMS, are broadcast; the others are joined
to the documents' bigrams by key, none of which is frequent. Losses are summed in
fixed point (a ``UNIT`` of a nat), so that sums do not depend on their order or on
the way a bigram takes.

Null texts and texts without words have 0 tokens and null losses. With no target
document the target is uniform over the vocabulary. An id with differing labels counts
with the smallest. Equal texts score equally; repeated rows count and are scored each. Texts
are read whole, a few megabytes of them at a time, a very long one alone. An empty table
gives no rows; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from skyweft.llm.common import chunks, map_text, small_batches, table, written
from skyweft.llm.decontam import words_of

#: Production parameters.
VOCAB = 50_000
NGRAMS = 1_000_000
DISCOUNT = 0.75
#: Ids of target documents that are broadcast; more are joined by a shuffle.
TARGET_IDS = 1_000_000
#: Fixed point of summed losses.
UNIT = 2.0**-32
#: Distinct words or bigrams that a task holds before it passes its sums on.
HELD = 400_000

UNK, BOS = 0, 1


def word_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """word (binary) and n over all texts."""
    small_batches(docs.sparkSession)

    def run(batches):
        from collections import Counter

        held: Counter = Counter()
        for b in batches:
            for t in b.column(0).to_pylist():
                held.update(words_of(t))
                if len(held) > HELD:
                    yield _pairs(held)
                    held = Counter()
        if held:
            yield _pairs(held)

    part = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "word binary, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n"))


def _pairs(held) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(list(held), pa.binary()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])


def top_words(counts: DataFrame, most: int = VOCAB) -> list[bytes]:
    """The most frequent words; ``most`` bounds what comes to the driver."""
    return [bytes(r["word"]) for r in counts.orderBy(F.desc("n"), "word").limit(most).collect()]


class Vocabulary:
    """Numbers of words from 2; 0 is any other word and 1 a text's beginning."""

    def __init__(self, words: list[bytes]):
        self.words = words
        self.ids = {w: i + 2 for i, w in enumerate(words)}
        self.size = len(words) + 2

    def encode(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Word numbers of all texts, each after a BOS, and the number of words of each."""
        docs = [words_of(t) for t in texts]
        n = np.fromiter(map(len, docs), np.int64, len(docs))
        get = self.ids.get
        flat = np.fromiter((get(w, UNK) for d in docs for w in d), np.int64, int(n.sum()))
        out = np.full(len(flat) + len(docs), BOS, np.int64)
        place = np.ones(len(out), bool)
        place[np.cumsum(n + 1) - n - 1] = False
        out[place] = flat
        return out, n

    def bigrams(self, texts: list) -> tuple[np.ndarray, np.ndarray]:
        """Keys of consecutive numbers within a text, and the number of each text's."""
        ids, n = self.encode(texts)
        keys = ids[:-1] * self.size + ids[1:] if len(ids) else ids
        return keys[ids[1:] != BOS] if len(ids) else keys, n


def bigram_counts(flagged: DataFrame, vocabulary, background: bool = True) -> DataFrame:
    """key, n and t: bigrams of ``flagged`` (text, is_target), summed in each task.

    t counts the target's texts, n all of them; n is 0 without ``background``.
    """
    small_batches(flagged.sparkSession)

    def run(batches):
        vocab = vocabulary.value
        held: list = []
        for b in batches:
            texts, mine = b.column("text").to_pylist(), np.array(b.column("is_target").to_pylist(), bool)
            for i, j in chunks(texts):
                keys, n = vocab.bigrams(texts[i:j])
                if background:
                    k, c = np.unique(keys, return_counts=True)
                    held.append((k, c, np.zeros_like(c)))
                if mine[i:j].any():
                    k, c = np.unique(keys[np.repeat(mine[i:j], n)], return_counts=True)
                    held.append((k, np.zeros_like(c), c))
            if sum(len(h[0]) for h in held) > 2 * HELD:
                held = [_summed(held)]
                if len(held[0][0]) > HELD:
                    yield _batch(held[0])
                    held = []
        if held:
            yield _batch(_summed(held))

    return flagged.select("text", "is_target").mapInArrow(run, "key long, n long, t long")


def _summed(held: list) -> tuple:
    cols = [np.concatenate(c) for c in zip(*held)]
    keys, where = np.unique(cols[0], return_inverse=True)
    return keys, *[np.bincount(where, weights=c, minlength=len(keys)).astype(np.int64) for c in cols[1:]]


def _batch(cols: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["key", "n", "t"])


def flagged(docs: DataFrame, ids: DataFrame, most: int) -> DataFrame:
    """text and is_target of every row of ``docs`` (id, text): whether its id is in ``ids``.

    Rows without an id stay where they are. In the shuffled join a frequent id's rows can
    be split (``ids`` holds each once).
    """
    mine = ids.withColumn("is_target", F.lit(True))
    flag = F.coalesce("is_target", F.lit(False)).alias("is_target")
    if ids.count() <= most:
        return docs.join(F.broadcast(mine), "id", "left").select("text", flag)
    met = docs.where("id is not null").join(mine.hint("merge"), "id", "left").select("text", flag)
    return met.union(docs.where("id is null").select("text", F.lit(False)))


def all_counts(docs: DataFrame, vocabulary: Vocabulary, target: list[str] | DataFrame, most_ids: int | None = None) -> DataFrame:
    """key, n and t of all bigrams of ``docs`` (id, text) and the target.

    The target is given by its texts or by a frame of document ids, of any number.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(vocabulary)
    if isinstance(target, DataFrame):
        ids = written(target.toDF("id", *target.columns[1:]).select("id").where("id is not null").distinct())
        parts = bigram_counts(flagged(docs, ids, most_ids or TARGET_IDS), shared)
    else:
        parts = bigram_counts(docs.select("text", F.lit(False).alias("is_target")), shared)
        if target:
            own = spark.createDataFrame([(t, True) for t in target], "text string, is_target boolean")
            parts = parts.union(bigram_counts(own, shared, False))
    return written(parts.groupBy("key").agg(F.sum("n").alias("n"), F.sum("t").alias("t")))


def _count_class(n: str):
    """Counts to 256 one by one, those above by sixteenths of an octave: few classes, in
    the counts' order, each of which is broadcast whole or not at all."""
    return F.when(F.col(n) <= 256, F.col(n)).otherwise(F.floor(F.log2(n) * 16).cast("long") + 256)


class Models:
    """Target and background losses of bigrams.

    Word and context numbers, and the counts of the most frequent bigrams, are arrays
    of bounded size; ``tail`` has the counts of all other bigrams.
    """

    def __init__(self, vocab: Vocabulary, word: np.ndarray, context: np.ndarray, after: np.ndarray, keys: np.ndarray, counts: np.ndarray, tail: DataFrame):
        """``word``, ``context``, ``after`` (distinct words after each) [2, vocabulary] and ``counts`` [2, keys]: background, target."""
        self.vocab, self.keys, self.tail = vocab, keys, tail
        uniform = 1.0 / vocab.size
        self.unigram = np.stack([(w + uniform * 10) / (w.sum() + 10) for w in word.astype(float)])
        self.context = np.maximum(context, 1)
        self.rest = np.where(context > 0, DISCOUNT * after / self.context, 1.0)
        self.direct = np.maximum(counts - DISCOUNT, 0) / self.context[:, keys // vocab.size]

    def __getstate__(self) -> dict:
        return {**self.__dict__, "tail": None}

    def _losses(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[2, bigrams]: -ln p by the broadcast counts, and which bigrams have such."""
        at = np.searchsorted(self.keys, keys)
        at[at == len(self.keys)] = 0
        found = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        a, b = keys // self.vocab.size, keys % self.vocab.size
        back = self.rest[:, a] * self.unigram[:, b]
        return -np.log(np.maximum(back + (np.where(found, self.direct[:, at], 0) if len(self.keys) else 0), 1e-12)), found

    def losses(self, keys: np.ndarray) -> np.ndarray:
        """[2, bigrams]: -ln p under background and target, of a few bigrams on the driver."""
        loss, found = self._losses(keys)
        missing = self.tail.sparkSession.createDataFrame([(int(k),) for k in set(keys[~found].tolist())], "key long")
        for r in self.tail_losses(F.broadcast(missing)).collect():
            loss[:, keys == r["key"]] = np.array([[r["background"]], [r["target"]]]) * UNIT
        return loss

    def tail_losses(self, rows: DataFrame) -> DataFrame:
        """``rows`` (key, ...) that are of the tail, with losses in ``UNIT``."""
        spark, size = self.tail.sparkSession, self.vocab.size
        cols = np.concatenate([self.context, self.rest, self.unigram])
        names = ["cn", "ct", "rn", "rt", "un", "ut"]
        stats = spark.createDataFrame(pa.table({"w": np.arange(size), **{k: pa.array(c.astype(float)) for k, c in zip(names, cols)}}))
        of = lambda k, cs: F.broadcast(stats.select(F.col("w").alias(k), *cs))  # noqa: E731  VOCAB + 2 rows
        x = rows.join(self.tail, "key").withColumns({"a": F.floor(F.col("key") / size).cast("long"), "b": F.pmod("key", F.lit(size))})
        x = x.join(of("a", names[:4]), "a").join(of("b", names[4:]), "b")
        loss = lambda n, c, r, u: F.round(-F.log(F.greatest(F.greatest(F.col(n) - DISCOUNT, F.lit(0.0)) / F.col(c) + F.col(r) * F.col(u), F.lit(1e-12))) / UNIT).cast("long")
        return x.select(*rows.columns, loss("n", "cn", "rn", "un").alias("background"), loss("t", "ct", "rt", "ut").alias("target"))

    def score(self, texts: list) -> dict:
        """Words of each text, summed losses of broadcast bigrams, and the other bigrams."""
        keys, n = self.vocab.bigrams(texts)
        loss, found = self._losses(keys)
        ends = np.cumsum(n)
        added = np.concatenate([np.zeros((2, 1), np.int64), np.cumsum(np.where(found, np.rint(loss / UNIT).astype(np.int64), 0), axis=1)], axis=1)
        background, target = added[:, ends] - added[:, ends - n]
        left = keys[~found]
        cuts = np.concatenate([[0], np.cumsum(~found)])
        return {"n_tokens": n, "background": background, "target": target, "others": [left[i:j] for i, j in zip(cuts[ends - n].tolist(), cuts[ends].tolist())]}


def build(docs: DataFrame, vocabulary: Vocabulary, target: list[str] | DataFrame, most: int = NGRAMS, text_col: str = "text", most_ids: int | None = None) -> Models:
    """Models of all ``docs`` against the target's texts, or documents of its ids; ``most`` bounds the broadcast."""
    d = docs.select(F.col("id") if "id" in docs.columns else F.lit(None).cast("long").alias("id"), F.col(text_col).alias("text"))
    counts = all_counts(d, vocabulary, target, most_ids)
    size = vocabulary.size
    word, context, after = (np.zeros((2, size), np.int64) for _ in range(3))
    sums = [F.sum("n").alias("n"), F.sum("t").alias("t"), F.count_if(F.col("n") > 0).alias("an"), F.count_if(F.col("t") > 0).alias("at")]
    for r in counts.groupBy(F.pmod("key", F.lit(size)).alias("k")).agg(*sums[:2]).collect():  # at most VOCAB + 2 rows
        word[:, r["k"]] = r["n"], r["t"]
    for r in counts.groupBy(F.floor(F.col("key") / size).cast("long").alias("k")).agg(*sums).collect():
        context[:, r["k"]], after[:, r["k"]] = (r["n"], r["t"]), (r["an"], r["at"])
    # the least count broadcast: as many of the highest classes of counts as the bound has room for
    least, kept = None, 0
    for r in counts.groupBy(_count_class("n").alias("c")).agg(F.count("*").alias("m"), F.min("n").alias("low")).orderBy(F.desc("c")).collect():  # under 1,300 rows
        if kept + r["m"] > most:
            break
        least, kept = r["low"], kept + r["m"]
    if least is None:
        return Models(vocabulary, word, context, after, np.zeros(0, np.int64), np.zeros((2, 0), np.int64), counts)
    rows = counts.where(F.col("n") >= F.lit(least)).toArrow()  # at most NGRAMS rows
    key, n, t = (rows.column(c).to_numpy() for c in ("key", "n", "t"))
    order = np.argsort(key)
    return Models(vocabulary, word, context, after, key[order], np.stack([n[order], t[order]]), counts.where(F.col("n") < F.lit(least)))


def cross_entropy_difference(docs: DataFrame, target: list[str] | DataFrame, id_col: str = "doc_id", text_col: str = "text", vocab: int = VOCAB, ngrams: int = NGRAMS, most_ids: int | None = None) -> DataFrame:
    """id, n_tokens, target_loss, background_loss and score of every row of ``docs``.

    The target is given by its texts, or by a frame with its documents' ids in the first column.
    """
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    models = build(d, Vocabulary(top_words(word_counts(d), vocab)), target, ngrams, "text", most_ids)
    shared = docs.sparkSession.sparkContext.broadcast(models)
    kinds = [("n_tokens", T.LongType()), ("background", T.LongType()), ("target", T.LongType()), ("others", T.ArrayType(T.LongType()))]
    rows = written(map_text(d, "text", ["id"], lambda texts: shared.value.score(texts), kinds).withColumn("row", F.monotonically_increasing_id()))
    others = models.tail_losses(rows.select("row", F.explode("others").alias("key")))
    more = others.groupBy("row").agg(F.sum("background").alias("more_b"), F.sum("target").alias("more_t"))
    mean = lambda x, y: F.when(F.col("n_tokens") > 0, (F.col(x) + F.coalesce(F.col(y), F.lit(0))) * F.lit(UNIT) / F.col("n_tokens"))
    out = rows.drop("others").join(more, "row", "left").select(F.col("id").alias(id_col), "n_tokens", mean("target", "more_t").alias("target_loss"), mean("background", "more_b").alias("background_loss"))
    return out.withColumn("score", F.col("target_loss") - F.col("background_loss"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where("doc_id is not null and quality is not null")
    good = labels.groupBy("doc_id").agg(F.min("quality").alias("q")).where("q = 1").select("doc_id")
    return cross_entropy_difference(table(spark, sf_dir, "documents"), good)


QUERIES = {"op7_lm_score": op7_lm_score}
ORACLES: dict[str, str] = {}
