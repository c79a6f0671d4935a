"""Periodic runs, whitening and byte-level BPE against brute force."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.llm import bpe, runs, whiten

# ---- op11 --------------------------------------------------------------------------


def slow_runs(words):
    """All runs by a scan of every lag."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            s = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i - s + q >= max(6, 4 * q):
                found.setdefault((s, i - s + q), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def odd_words(rng):
    """Random words with repeats of all sorts of periods, broken and cut."""
    few = rng.choice([1, 2, 3, 5, 50])
    w = [rng.randrange(few) for _ in range(rng.randint(0, 60))]
    for _ in range(rng.randint(0, 3)):
        p = [rng.randrange(rng.choice([2, 3, 100])) for _ in range(rng.choice([1, 2, 5, 7, 8, 9, 15, 16, 17, 31, 32, 33, 60, 64, 65]))]
        if rng.random() < 0.3:
            p = p + p + [rng.randrange(3)]
        r = p * rng.randint(2, 7)
        r = r[: len(r) - rng.randrange(len(p))]
        if rng.random() < 0.3 and r:
            r[rng.randrange(len(r))] = "z"
        w += r + [rng.randrange(few) for _ in range(rng.randint(0, 30))]
    return [str(x).encode() for x in w]


def test_runs_are_all_runs():
    rng = random.Random(5)
    texts = [odd_words(rng) for _ in range(800)]
    got = [list(map(tuple, r.tolist())) for i in range(0, len(texts), 100) for r in runs.find_runs(texts[i : i + 100])]
    want = [slow_runs(t) for t in texts]
    assert got == want and sum(map(len, want)) > 800


def test_long_periods_and_one_word():
    rng = random.Random(6)
    w = [b"%d" % rng.randrange(500) for _ in range(20_011)]
    lead = [b"x"] * 3
    assert runs.find_runs([lead + w * 5])[0].tolist() == [[3, 100_055, 20_011]]
    assert runs.find_runs([[b"a"] * 50_000])[0].tolist() == [[0, 50_000, 1]]
    assert len(runs.find_runs([w * 3])[0]) == 0
    assert [r.tolist() for r in runs.find_runs([[], [b"a"] * 5, [b"a"] * 6])] == [[], [], [[0, 6, 1]]]


def run_rows(rows):
    """The contract's columns, word by word."""
    for doc_id, text in rows:
        words = text.encode().split() if text else []
        h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
        n, g = len(words), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        found = slow_runs(words)
        gone = {i for s, m, q in found for i in range(s + q, s + m)}
        best = min(found, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
        lines = "".join(f"{s},{m},{q}\n" for s, m, q in sorted(found, key=lambda r: (r[0], r[2])))
        left = b" ".join(w for i, w in enumerate(words) if i not in gone)
        yield (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2], hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left).hexdigest())


def test_run_query(spark, docs, no_docs, tmp_path):
    rng = random.Random(7)
    rows = [(i, b" ".join(odd_words(rng)).decode()) for i in range(400)] + [(500, None), (501, ""), (502, " \x0b\n "), (None, "a a a a a a a"), (503, "é" * 9 + " ï ï" * 9), (503, "same"), (503, "same")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"runs": F.lit("clash"), "best": F.lit(1), "start": F.lit("x")})
    df.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    out = runs.op11_runs(spark, str(tmp_path))
    key = lambda r: tuple((x is not None, x) for x in r)
    assert sorted(map(tuple, out.collect()), key=key) == sorted(run_rows(rows), key=key)
    assert [t for _, t in out.dtypes] == ["bigint"] * 6 + ["string"] * 2
    got = {r["doc_id"]: r for r in runs.periodic_runs(docs, ["doc_id", "lang"]).collect()}
    assert [tuple(r) for r in got[7]["runs"]] == [(0, 60_000, 1)] and got[7]["collapsed"] == "word" and got[2]["collapsed"] == ""
    assert runs.periodic_runs(no_docs, ["doc_id"]).count() == 0


# ---- op12 --------------------------------------------------------------------------


def slow_whitening(vectors, components=4):
    x = np.array([np.floor(256 * np.array(v, float)) for v in vectors])
    f = np.unique(x, axis=0)
    c = f - f.mean(0)
    v = c.T @ c / len(f)
    values, axes = np.linalg.eigh(v)
    values, axes = values[::-1], axes[:, ::-1]
    whole, sums = x.astype(object), f.sum(0).astype(int)
    deviation = [sum(int(len(f) * a - s) ** 2 for a, s in zip(map(int, r), sums.tolist())) for r in whole]
    return len(f), deviation, ((x - f.mean(0)) @ axes / np.sqrt(values))[:, :components], values / values.sum()


@pytest.mark.parametrize("block,split", [(1024, 8), (16, 1)])
def test_whitening(spark, monkeypatch, block, split):
    monkeypatch.setattr(whiten, "BLOCK_ROWS", block)
    monkeypatch.setattr(whiten, "BLOCK_COLS", 4 if block == 16 else 1024)
    monkeypatch.setattr(whiten, "BLOCKS_A_SPLIT", split)
    rng = np.random.default_rng(3)
    good = [(i, [float(np.float32(a)) for a in rng.normal(size=6) * [3, 2, 1, 0.5, 0.3, 0.1]]) for i in range(120)]
    good += [(i, good[0][1]) for i in range(200, 260)] + [(7, good[7][1]), (None, good[3][1])]
    odd = [(300, None), (301, []), (302, [1.0] * 5), (303, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (304, [float("nan")] * 6), (305, [float("inf")] * 6)]
    df = spark.createDataFrame(good + odd, "vec_id long, embedding array<float>").withColumns({c: F.lit("clash") for c in ("x", "i", "id", "n", "v")})
    got = whiten.whiten(df.repartition(5)).collect()
    n, deviation, white, explained = slow_whitening([v for _, v in good])
    assert {r["n"] for r in got} == {n} and len(got) == 4 * len(good)
    for k in range(4):
        # rows in any order: match them by id and value, an eigenvector's sign for all
        mine = sorted((str(r["vec_id"]), r["deviation"], round(r["whitened"], 9)) for r in got if r["component"] == k + 1)
        for sign in (1, -1):
            want = sorted((str(i), d, round(sign * w, 9)) for (i, _), d, w in zip(good, deviation, white[:, k]))
            if all(a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-8 for a, b in zip(mine, want)):
                break
        else:
            raise AssertionError(k)
        assert all(abs(r["explained"] - explained[k]) < 1e-12 for r in got if r["component"] == k + 1)
    assert max(r["identity_error"] for r in got) < 1e-9
    assert dict(whiten.whiten(df).dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double", "explained": "double", "identity_error": "double"}


def test_whitening_of_little(spark):
    some = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert whiten.whiten(some).count() == 0 and whiten.whiten(some.where("false")).count() == 0
    line = spark.createDataFrame([(i, [float(i), 2.0 * i]) for i in range(5)], "vec_id long, embedding array<double>")
    got = whiten.whiten(line).orderBy("vec_id").collect()  # rank one: one component
    assert [r["component"] for r in got] == [1] * 5 and got[0]["explained"] == pytest.approx(1.0)
    assert np.allclose(np.abs([r["whitened"] for r in got]), np.abs(np.arange(5) - 2) / np.sqrt(2))


# ---- op13 --------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tok():
    import public_tokenizers as p
    import tiktoken

    ranks = bpe.read_ranks(p.path(bpe.RANKS))
    return tiktoken.Encoding("own", pat_str=p.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Vocabulary(ranks), p


ALPHABETS = ["ab", "abc", "aeiourstln", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ", "éàüß日本語中文한국어", "=-#*_", "\n\t \r", "aA1 .,é\n'", "🙂👩‍🚀​́"]


def test_ids_are_the_librarys(tok):
    enc, vocabulary, p = tok
    rng = random.Random(3)
    texts = ["".join(rng.choice(a) for _ in range(rng.randint(1, 60))) for _ in range(1500) for a in [rng.choice(ALPHABETS)]]
    texts += ["".join(rng.choice(a) for _ in range(n)) for n in (511, 512, 513, 5000, 60_000) for a in ALPHABETS]
    texts += ["", "<|endoftext|>", "a<|endoftext|>b", "a\x00b", " " * 1000, "don't we'll"]
    mine = bpe.Encoder(vocabulary, p.PATTERN)
    want = [enc.encode_ordinary(t) for t in texts]
    assert mine.encode(texts) == want
    assert mine.encode(texts) == want  # out of the cache
    assert mine.encode([None]) == [[]]


def test_long_matches_as_pair_by_pair(tok):
    """The rows that merge many pairs at once, on short words too, against the matrices and the library."""
    enc, vocabulary, _ = tok
    rng = random.Random(4)
    words = ["".join(rng.choice(a) for _ in range(rng.randint(2, 60))).encode() for _ in range(1500) for a in [rng.choice(ALPHABETS)]]
    want = [tuple(enc._core_bpe.encode_single_piece(w)) if w not in vocabulary.ranks else (vocabulary.ranks[w],) for w in words]
    rows = vocabulary.merge_rows(words)
    for w, a, b in zip(words, want, rows):
        if w not in vocabulary.ranks:
            assert b == a and vocabulary.merge_long(w) == a


def test_merges_that_make_lower_pairs():
    """A vocabulary whose ranks do not rise with length, against a loop over single pairs."""
    rng = random.Random(8)
    for _ in range(60):
        ranks = {bytes([i]): 1000 + i for i in range(256)}
        while len(ranks) < 256 + 60:
            ranks.setdefault("".join(rng.choice("abc") for _ in range(rng.randint(2, 6))).encode(), len(ranks))
        order = list(range(60))
        rng.shuffle(order)
        for i, w in enumerate([w for w in ranks if len(w) > 1]):
            ranks[w] = order[i]
        v = bpe.Vocabulary(ranks)
        for _ in range(40):
            word = "".join(rng.choice("abc") for _ in range(rng.randint(2, 40))).encode()
            parts = [word[i : i + 1] for i in range(len(word))]
            while True:
                found = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
                if not found:
                    break
                _, i = min(found)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
            want = tuple(ranks[p] for p in parts)
            assert v.merge_long(word) == want == v.merge_rows([word])[0]


def test_blocks_of_a_long_text(tok, monkeypatch):
    enc, vocabulary, p = tok
    monkeypatch.setattr(bpe, "MATCHES", 7)
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 5)
    texts = ["Some words, then  more   spaces.\n\nAnd 123 don't ", None, "short", "zxqj wvkq " * 40]
    mine = bpe.Encoder(vocabulary, p.PATTERN)
    for _ in range(2):
        assert mine.encode(texts) == [enc.encode_ordinary(t) if t else [] for t in texts]


def test_bpe_query(spark, docs, no_docs, tok, tmp_path):
    enc, _, p = tok
    docs.withColumn("ids", F.lit("clash")).write.parquet(str(tmp_path / "documents.parquet"))
    got = bpe.op13_bpe(spark, str(tmp_path))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(r["doc_id"], len(ids), sha(" ".join(map(str, ids)).encode()), sha((r["text"] or "").encode())) for r in docs.select("doc_id", "text").collect() for ids in [enc.encode_ordinary(r["text"] or "")]]
    key = lambda r: (r[0] is None, r[0] or 0, r[1:])
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)
    assert got.dtypes == [("doc_id", "bigint"), ("n_tokens", "bigint"), ("ids_sha256", "string"), ("decoded_sha256", "string")]
    path = p.path(bpe.RANKS)
    kept = bpe.encode(docs, path, p.PATTERN, ["doc_id", "n", "size"])
    assert kept.columns == ["doc_id", "n", "size", "ids"]
    assert bpe.encode(no_docs, path, p.PATTERN, ["doc_id"]).count() == 0
    assert bpe.decode(kept.select("doc_id", F.lit(None).cast("array<int>").alias("ids")), path, ["doc_id"]).where("bytes is null").count() == docs.count()
