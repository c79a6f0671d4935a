"""Operators over the whole corpus: mixing, near-duplicates, neighbours, the pipeline."""

from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.llm import ann, mixing, simhash

# ---- op3 ---------------------------------------------------------------------------


def waterfill(sizes: dict, weights=mixing.WEIGHTS, most=3):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, capped = sum(sizes.values()), set()
    while True:
        rest = total - sum(most * sizes[s] for s in capped)
        free = [s for s in order if s not in capped]
        share = {s: rest * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > most * sizes[s]]
        if not over:
            return share | {s: float(most * sizes[s]) for s in capped}
        capped |= set(over)


def test_targets_are_water_filled(spark):
    for sizes in ({"a": 10, "b": 5000, "c": 3000, None: 100, "d": 0}, {"a": 7}, {"b": 100, "a": 1, "c": 1}, {"x": 0, "y": 0}):
        df = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
        got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
        assert got == pytest.approx(waterfill(sizes))


def test_mix(spark, corpus, docs, no_docs):
    d, _ = corpus
    mixed = mixing.mix(d, block_words=4).cache()
    got = mixing.taken(mixed).join(d.select("doc_id", "source"), "doc_id").collect()
    by = defaultdict(int)
    for r in got:
        by[r["source"]] += r["taken"]
        assert r["taken"] <= 3 * r["size"]
    target = {r["source"]: r["target"] for r in got}
    assert all(abs(by[s] - target[s]) <= 8 for s in by)
    again = mixing.taken(mixing.mix(d.repartition(7), block_words=4)).collect()
    assert {(r["doc_id"], r["taken"]) for r in got} == {(r["doc_id"], r["taken"]) for r in again}
    out = mixing.shards(d, mixed)
    assert out.agg(F.sum(F.size(F.split("text", " ")))).first()[0] == sum(by.values())
    assert out.select("shard").distinct().count() == mixing.SHARDS
    by_shard = defaultdict(int)
    for r in out.select("shard", F.size(F.split("text", " ")).alias("n")).collect():
        by_shard[r["shard"]] += r["n"]
    words = mixing.taken(mixed).collect()
    assert all(r["taken"] == sum(r["shard_words"]) for r in words)
    assert [by_shard[k] for k in range(mixing.SHARDS)] == [sum(r["shard_words"][k] for r in words) for k in range(mixing.SHARDS)]
    odd = mixing.taken(mixing.mix(docs)).collect()
    assert len(odd) == docs.count() and all(r["taken"] <= 3 * r["size"] for r in odd)
    assert mixing.taken(mixing.mix(no_docs)).count() == 0


def test_permutation_and_draws(spark):
    p = spark.range(1000).select(mixing._position(F.col("id"), F.lit(1000).cast("long"), F.lit("s"), F.lit(3)).alias("p"))
    assert p.distinct().count() == 1000
    assert p.where("p between 0 and 999").count() == 1000
    k = mixing._hypergeometric(F.lit(50).cast("long"), F.lit(20).cast("long"), F.lit(10).cast("long"), (F.col("id") + 0.5) / 2000)
    n = [r["n"] for r in spark.range(2000).select(k.alias("k")).groupBy("k").agg(F.count("*").alias("n")).orderBy("k").collect()]
    from math import comb

    want = [2000 * comb(20, i) * comb(30, 10 - i) / comb(50, 10) for i in range(11)]
    assert np.allclose(n, [w for w in want if w > 0.5][: len(n)], atol=1.01)


def test_shards_of_repeated_rows(spark):
    """Rows that share an id, or have none, are cut each from their own text, once."""
    rows = [(1, "a b c d", "x"), (1, "a b c d", "x"), (1, "e f g", "y"), (2, "h i j k l", "x"), (None, "m n", "y"), (None, "o p q", "y"), (None, None, "y"), (3, "r " * 3000, "z")]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumns({"h": F.lit("clash"), "shard": F.lit("clash")})
    mixed = mixing.mix(d, block_words=2).cache()
    words = mixing.taken(mixed).collect()
    out = mixing.shards(d, mixed).collect()
    assert sum(len(r["text"].split(" ")) for r in out) == sum(r["taken"] for r in words) > 0
    of = defaultdict(int)
    for r in out:
        of[r["doc_id"], r["text"].split(" ")[0] > "d"] += len(r["text"].split(" "))
    assert sum(n for (i, _), n in of.items() if i == 1) == sum(r["taken"] for r in words if r["doc_id"] == 1)
    assert {w for r in out for w in r["text"].split(" ") if r["doc_id"] is None} <= set("mnopq")


def test_a_mix_is_brute_force(spark):
    """Blocks, permutation and tree of a small mix, worked out in plain Python."""
    rows = [(i, " ".join(["w"] * (3 + i % 7)), "ab"[i % 2]) for i in range(60)]
    d = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = mixing.mix(d, block_words=5, shards=4).collect()
    sizes = {s: sum(r["size"] for r in mixed if r["source"] == s) for s in "ab"}
    want = waterfill(sizes)
    for s in "ab":
        mine = [r for r in mixed if r["source"] == s]
        pieces = [p for r in mine for p in r["pieces"]]
        # a block (one rank) is in one shard; blocks of the source have its block's words, the last fewer
        by = defaultdict(list)
        for p in pieces:
            by[p["rank"]].append(p)
        assert all(len({p["shard"] for p in ps}) == 1 for ps in by.values())
        block = max(1, min(5, sizes[s] // 512))
        words = [sum(p["words"] for p in ps) for ps in by.values()]
        assert max(words) <= block and sum(w < block for w in words) <= 3
        assert len(by) == round(want[s] * -(-sizes[s] // block) / sizes[s])
        assert all(0 <= p["first"] and p["first"] + p["words"] <= r["size"] for r in mine for p in r["pieces"])
    share = [len({(r["source"], p["rank"]) for r in mixed for p in r["pieces"] if p["shard"] == k}) for k in range(4)]
    assert max(share) - min(share) <= 1


def test_tree_of_many_sources(spark, monkeypatch):
    monkeypatch.setattr(mixing, "TREE_SOURCES", 8)
    quotas = {f"s{i}": (i * 37) % 101 for i in range(50)} | {None: 900}
    goal = spark.createDataFrame(list(quotas.items()), "source string, quota long")
    got = {r["source"]: r["ends"] for r in mixing.split_tree(goal, 4, 3).collect()}
    assert {s: e[-1] for s, e in got.items()} == quotas and all(sorted(e) == e and len(e) == 4 for e in got.values())
    total = [sum(e[k] for e in got.values()) for k in range(4)]
    steps = np.diff([0, *total])
    assert max(steps) - min(steps) <= 3


def test_tree_keeps_quotas(spark):
    goal = spark.createDataFrame([("a", 1000), ("b", 3), (None, 50), ("c", 0)], "source string, quota long")
    for shards in (1, 3, 16):
        got = {r["source"]: r["ends"] for r in mixing.split_tree(goal, shards, 1).collect()}
        assert {s: e[-1] for s, e in got.items()} == {"a": 1000, "b": 3, None: 50, "c": 0}
        assert all(len(e) == shards and sorted(e) == e for e in got.values())


# ---- op6 ---------------------------------------------------------------------------


def brute_fingerprint(text, shingle=3):
    from xxhash import xxh64_intdigest

    w = (text or "").encode().translate(simhash._LOWER).split()
    if not w:
        return 0
    hs = [xxh64_intdigest(b" ".join(w[i : i + shingle]), 42) for i in range(max(1, len(w) - shingle + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def test_fingerprints(docs):
    got = sorted((r["id"] or 0, r["fp"] & (2**64 - 1)) for r in simhash.fingerprints(docs).collect())
    assert got == sorted((r["doc_id"] or 0, brute_fingerprint(r["text"])) for r in docs.collect())


def test_spark_hash_is_the_same(spark):
    r = spark.range(1).select(F.xxhash64(F.lit("the cat sat"))).first()[0]
    assert brute_fingerprint("The CAT\nsat") == r & (2**64 - 1)


def brute_components(rows, tau):
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if ((rows[i][1] ^ rows[j][1]) & (2**64 - 1)).bit_count() <= tau:
                parent[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(low.get(find(i), d), d)
    return sorted(((d is None, d or 0), fp, low.get(find(i))) for i, (d, fp) in enumerate(rows))


@pytest.mark.parametrize("tau", [1, 2])
@pytest.mark.parametrize("plan", [None, [(list(range(40)), 2), (list(range(40, 64)), -1)][:1], [(list(range(0, 64, 2)), 1), (list(range(1, 64, 2)), 0)], [(list(range(20)), 0), (list(range(20, 42)), 0), (list(range(42, 64)), 0)]])
def test_components(spark, tau, plan):
    if tau == 1 and plan and plan[0][1] == 2:
        plan = [(plan[0][0], 1)]
    rng = np.random.default_rng(3)
    rows, seed = [], 0
    for _ in range(12):
        fp = int(rng.integers(0, 2**63)) - 2**62
        for _ in range(int(rng.integers(1, 12))):
            rows.append((seed, fp))
            seed += 1
            for _ in range(int(rng.integers(0, 4))):
                fp ^= 1 << int(rng.integers(0, 62))
    rows += [(None, rows[0][1]), (999, 0), (998, 0), (None, 2**40 + 7), (5000, rows[3][1])]
    df = spark.createDataFrame(rows, "id long, fp long")
    got = simhash.with_components(df, tau, plan, cold=4).collect()
    assert sorted(((r["id"] is None, r["id"] or 0), r["fp"], r["component_id"]) for r in got) == brute_components(rows, tau)


def correlated_fingerprints(n=20_000):
    """Bits that go together in fours, some of them biased."""
    rng = np.random.default_rng(8)
    bits = rng.random((n, 16)) < np.linspace(0.1, 0.9, 16)
    noise = rng.random((n, 64)) < 0.2
    return np.unique(np.packbits(np.repeat(bits, 4, axis=1) ^ noise, axis=1).view(">u8").reshape(-1).astype(np.uint64))


@pytest.mark.parametrize("tau", [1, 2])
def test_plan_keeps_its_method_at_every_size(tau):
    """Several parts with thresholds that cover tau, from 10 to 1e11 fingerprints, over all bits or fewer."""
    for sample in (correlated_fingerprints(), np.random.default_rng(1).integers(0, 2**63, 20_000).astype(np.uint64), np.zeros(1, np.uint64), np.zeros(0, np.uint64)):
        corr = np.corrcoef(simhash.as_bits(sample).T) if len(sample) > 1 else np.eye(64)
        order = simhash.bit_order(corr)
        assert sorted(order) == list(range(64))
        for n in (10, 1e5, 1e7, 1e8, 1e9, 1e10, 1e11):
            parts = simhash.choose(n, order, sample, tau)
            assert len(parts) >= 2 and sum(t + 1 for _, t in parts) == tau + 1
            assert len({b for bits, _ in parts for b in bits}) == sum(len(bits) for bits, _ in parts) <= 64
    wide = [max(len(bits) for bits, _ in simhash.choose(n, list(range(64)), np.zeros(0, np.uint64), 2)) for n in (1e5, 1e11)]
    assert wide[0] < wide[1]  # more fingerprints, wider parts


def test_pair_shares_are_exact_counts():
    x = correlated_fingerprints(400)
    for bits in (list(range(8)), list(range(20, 26))):
        mask = sum(1 << (63 - b) for b in bits)
        far = np.array([[(int(a) ^ int(b) & mask) & mask for b in x] for a in x])
        same = sum(int(far[i, j]) == 0 for i in range(len(x)) for j in range(i)) / (len(x) * (len(x) - 1) / 2)
        got = simhash.pair_shares(x, bits, 2)
        assert got[0] == pytest.approx(same) and got[0] <= got[1] <= got[2]


def test_deduplication(docs, no_docs):
    got = simhash.deduplicated(docs)
    assert got.columns == docs.columns
    ids = sorted(r["doc_id"] or 0 for r in got.collect())
    assert ids == [0, 1, 2, 7, 8, 9]  # 5 and 6 are copies of 1, 3 and 4 of 2 (no words)
    assert simhash.deduplicated(no_docs).count() == 0
    assert simhash.near_duplicates(no_docs).count() == 0


def test_deduplication_keeps_one_of_each_component(spark):
    """Unrelated texts without ids, or under one id, are components of their own."""
    a, b, c, e = (" ".join(f"{k}{i * i}" for i in range(40)) for k in "abce")
    rows = [(None, a), (None, a), (None, b), (5, c), (5, c), (5, e), (6, e)]
    got = simhash.deduplicated(spark.createDataFrame(rows, "doc_id long, text string").repartition(2)).collect()
    assert sorted((r["doc_id"] or 0, r["text"]) for r in got) == [(0, a), (0, b), (5, c), (5, e)]


# ---- op8 ---------------------------------------------------------------------------


def test_neighbours(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 16)).astype(np.float32)
    x[1000:1800] = x[7]  # one vector in a third of the rows
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    nan = float("nan")
    bad = [(5000, None), (5100, [0.0] * 16), (5200, [nan] * 16), (None, [1.0] * 16), (5300, [1.0, 2.0]), (5400, [float("inf")] + [1.0] * 15), (5500, [None] + [1.0] * 15)]
    df = df.union(spark.createDataFrame(bad, df.schema)).withColumns({"score": F.lit("x"), "code": F.lit("x"), "id": F.lit("x")}).repartition(4)
    got = defaultdict(list)
    for r in ann.nearest(df).orderBy("query_id", "rank").collect():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    assert set(got) == set(range(0, 3000, 100))
    hit = 0
    for q in got:
        d = np.sqrt(((x.astype(float) - x[q].astype(float)) ** 2).sum(1))
        want = [i for i in np.lexsort((np.arange(3000), d)) if i != q][:10]
        hit += len(set(want) & {v for v, _ in got[q]})
        assert np.allclose([s for _, s in got[q]], [d[v] for v, _ in got[q]], rtol=1e-14)
        assert got[q] == sorted(got[q], key=lambda t: (t[1], t[0]))
    assert hit / 300 >= 0.9
    assert [v for v, _ in got[1100]] == [7, *range(1000, 1009)]
    assert ann.nearest(df.where("false")).count() == 0 and ann.nearest(df.where("vec_id = 0")).count() == 0


def test_recall_on_a_thousand_queries(spark, monkeypatch):
    """Against the exact ten, over several blocks of queries and one shortlist a task."""
    monkeypatch.setattr(ann, "QUERY_BLOCK", 300)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(200, 24))
    x = (centres[rng.integers(0, 200, 10_000)] + 0.7 * rng.normal(size=(10_000, 24))).astype(np.float32)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>").repartition(2)
    got = defaultdict(set)
    for r in ann.nearest(df, every=10).collect():
        got[r["query_id"]].add(r["vec_id"])
    hit = 0
    for q in range(0, 10_000, 10):
        d = ((x - x[q]) ** 2).sum(1)
        d[q] = np.inf
        hit += len(got[q] & set(np.argpartition(d, 10)[:10].tolist()))
    assert len(got) == 1000 and hit / 10_000 >= 0.9


# ---- the pipeline ------------------------------------------------------------------


def test_pipeline(spark, corpus, tmp_path):
    import corpus_pipeline

    d, labels = corpus
    d.write.parquet(f"{tmp_path}/documents.parquet")
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "nothing of this occurs in any of the documents here today")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    now = d
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, str(tmp_path)).cache()
        assert out.columns == d.columns, name
        assert out.join(now, "doc_id", "left_anti").count() == 0
        now = out
    final = corpus_pipeline.STAGES[-1][1](spark, now, str(tmp_path))
    assert {r["doc_id"] for r in final.collect()} == {r["doc_id"] for r in now.collect()}
    assert all(r["doc_id"] % 5 != 1 for r in now.collect())
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == now.count()


def test_registered_queries():
    import __spark_entry__

    names = __spark_entry__.queries()
    assert all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)) and "pipeline" in names
    assert set(__spark_entry__.oracle_sql()) <= set(names)


def test_fingerprints_of_long_texts_in_blocks(monkeypatch):
    """A text over the block size, alone and among others, against a loop over its shingles."""
    import xxhash

    def plain(text):
        w = text.lower().split()
        parts = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rng = np.random.default_rng(2)
    texts = [" \n".join(f"w{x}" for x in rng.integers(0, 60, n)) for n in (1, 2, 3, 9, 10, 11, 12, 40, 41, 42, 400, 5)] + ["", None]
    for size in (10, 40, 10**6):
        monkeypatch.setattr(simhash, "SHINGLES", size)
        assert simhash.fingerprint_batch(texts).tolist() == [plain(t or "") for t in texts]


def test_dedup_keeps_one_of_rows_that_repeat_an_id(spark):
    rows = [(1, "a b c d", "x"), (1, "a b c d", "y"), (1, "a b c d", "y"), (1, "e f g h i", "z"), (2, "a b c d", "x"), (None, "q r s t", "n"), (None, "q r s t", "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
    got = simhash.deduplicated(docs.repartition(4))
    assert got.columns == docs.columns
    texts = sorted((r["doc_id"] or 0, r["text"]) for r in got.collect())
    assert len(texts) == 3 and texts[0] == (0, "q r s t") and {t for _, t in texts} == {"q r s t", "a b c d", "e f g h i"}
