"""Operators that score or scan single documents, against brute force."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from skyweft.llm import chat, common, decontam, langid, lmscore, quality, tokens, toxicity


def out(i) -> bool:
    return zlib.crc32(str(i).encode()) % 5 == 0


# ---- op1 ---------------------------------------------------------------------------


def events(spark, rows):
    return spark.createDataFrame(rows, chat.EVENTS)


def test_fold_of_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, "message", 0, "user", "hi"), (1, 2, "delta", 1, "assistant", "he"), (1, 3, "delta", 1, None, "llo"), (1, 4, "message", 2, "user", "x"),
        (1, 5, "regenerate", 1, None, None), (1, 6, "delta", 1, None, "bye"), (1, 7, "edit", 0, None, "hey"), (1, 8, "delta", 1, "assistant", "new"), (1, 9, "odd", 5, "user", "ignored"),
        (None, 1, None, None, None, None), (2, 1, "message", None, "user", "same"), (2, 1, "message", None, "user", "same"),
    ]
    got = {r["conv_id"]: r for r in chat.format_conversations(events(spark, rows)).collect()}
    assert chat.parse(got[1]["formatted"]) == [("user", "hey"), ("assistant", "new")]
    assert [got[1]["formatted"][a:b] for a, b in zip(got[1]["loss_starts"], got[1]["loss_ends"])] == ["new"]
    assert chat.parse(got[None]["formatted"]) == [("", "")]
    assert chat.parse(got[2]["formatted"]) == [("user", "same")] * 2
    assert chat.format_conversations(events(spark, [])).count() == 0


@pytest.mark.parametrize("text", ["", "\\", "\\\\l", "<s>", "</s>[INST] ok [/INST]", "<<SYS>>a<</SYS>>", "<<s>", "<|tur<|turn|>n|>", "\\n\n", "[[INST]", "é<|end|>日本", "<" * 9])
def test_escaping_is_reversible(text):
    hidden = chat.escape(text)
    assert chat.unescape(hidden) == text
    assert not any(c in hidden for c in chat.CONTROL)
    whole, _, _ = chat.render([(text, text), ("assistant", text)])
    assert chat.parse(whole) == [(text, text), ("assistant", text)]


def test_chat_digests(spark):
    rows = spark.createDataFrame([(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, None, "c"), (1, 3, "assistant", "d" * 50_000)], "conv_id long, turn long, role string, text string")
    r = chat.digests(chat.format_conversations(chat.conversation_events(rows.withColumn("seq", F.lit("clash"))))).first()
    assert r["turns_sha256"] == hashlib.sha256(("user\n\nassistant\nb\n\nc\nassistant\n" + "d" * 50_000 + "\n").encode()).hexdigest()
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (4, 50_001, hashlib.sha256(b"b" + b"d" * 50_000).hexdigest())


# ---- op2, op9, op10 ----------------------------------------------------------------


def test_quality(spark, corpus, docs, no_docs):
    d, labels = corpus
    chain = quality.trained(d, labels)
    got = {r["doc_id"]: r["score"] for r in quality.score_quality(d, chain).collect()}
    assert all((got[i] >= quality.THRESHOLD) == (i % 5 != 1) for i in got if out(i))
    odd = quality.score_quality(docs, chain).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert quality.score_quality(no_docs, chain).count() == 0
    kept = quality.keep_good(d.withColumn("score", F.lit("x")), chain)
    assert kept.columns == [*d.columns, "score"] and {r["doc_id"] for r in kept.collect()} == {i for i, s in got.items() if s >= quality.THRESHOLD}
    none = quality.trained(d, labels.where("false"))
    assert none.score(["a", None]).tolist() == [0.5, 0.5]
    assert quality.trained(no_docs, labels).constant == 0.5


def test_chain_marginals_are_exact():
    """Forward-backward against all labelings of a short chain."""
    rng = np.random.default_rng(1)
    c = quality.Chain(np.zeros((quality.N_FEATURES, quality.BINS - 1)))
    c.trans = rng.normal(size=(2, 2))
    e = rng.normal(size=6)
    p, pairs = c.marginals(e, np.array([4, 2]), pairs=np.ones(2))
    want, expect = np.zeros(6), np.zeros((2, 2))
    for start, n in ((0, 4), (4, 2)):
        total, good, trans = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            ys = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(e[start + k] * ys[k] for k in range(n)) + sum(c.trans[a, b] for a, b in zip(ys, ys[1:])))
            total += w
            good += w * np.array(ys)
            for a, b in zip(ys, ys[1:]):
                trans[a, b] += w
        want[start : start + n] = good / total
        expect += trans / total
    assert np.allclose(p, want) and np.allclose(pairs, expect)


def test_chain_gradient_is_finite_differences():
    rng = np.random.default_rng(2)
    n = np.array([3, 1, 5])
    b, label = rng.integers(0, quality.BINS, (9, quality.N_FEATURES)), rng.integers(0, 2, 9).astype(float)
    weight = np.repeat([0.5, 2.0, 1.5], n)
    c = quality.Chain(np.zeros((quality.N_FEATURES, quality.BINS - 1)))
    params = rng.normal(size=3 * quality.N_FEATURES * quality.BINS + 7) * 0.3
    g = quality.gradient(c, b, n, label, weight)(params)

    def at(i, step):
        moved = params.copy()
        moved[i] += step
        c.use(moved)
        return quality.likelihood(c, b, n, label, weight)

    used = [int(j * quality.BINS + b[2, j]) for j in (0, 7)] + [len(params) - k for k in range(1, 8)]
    for i in used:
        assert g[i] == pytest.approx((at(i, 1e-5) - at(i, -1e-5)) / 2e-5, abs=1e-6)


def test_labels_of_held_out_rows_are_not_used(corpus):
    d, labels = corpus
    flipped = labels.withColumn("quality", F.when(quality.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.labelled_sample(d, labels, "quality", 50, 1 << 20) == quality.labelled_sample(d, flipped, "quality", 50, 1 << 20)


def test_language(spark, corpus, docs, no_docs):
    d, _ = corpus
    model = langid.trained(d)
    got = langid.identify(d, model).collect()
    assert all(r["lang_pred"] == ("en" if r["doc_id"] % 2 == 0 else "fr") for r in got if out(r["doc_id"]) and r["doc_id"] % 5 != 1)
    odd = {(r["doc_id"], r["lang_pred"], r["score"]) for r in langid.identify(docs, model).collect()}
    assert {x[1] for x in odd if x[0] in (2, 3, 4)} == {"und"} and {x[2] for x in odd if x[0] in (2, 3, 4)} == {0.0}
    assert all(0 <= x[2] <= 1 and x[1] in ("en", "fr", "und") for x in odd)
    assert langid.identify(no_docs, model).count() == 0
    empty = langid.trained(d.where("false"))
    assert {r["lang_pred"] for r in langid.identify(docs, empty).collect()} == {"und"}
    assert {2, 3, 4}.isdisjoint({r["doc_id"] for r in langid.keep_known(docs, model).collect()})


def test_language_spans():
    rows = [("the house of the river under water", "en"), ("la maison dans le fleuve et la pierre", "fr")] * 20 + [("привет как дела", "ru")] * 20
    m = langid.train(rows)
    letters, label, chance = m.spans(["the house of the river la maison dans le fleuve et la pierre"])[0]
    assert label.tolist() == [0] * 5 + [1] * 8 and ((0 < chance) & (chance <= 1)).all()
    assert m.predict(["дела"])[0] == ["ru"] and m.predict(["²³ ½ 12"])[0] == ["und"]
    assert m.predict(["water " * 50_000])[0] == ["en"]


def brute_language(m, text):
    """Labels by trying every path of languages; word scores gram by gram."""
    from itertools import product

    words, rows = langid._words(text), []
    for w in words:
        total, count = np.zeros(len(m.langs)), 0
        marked = f"\x02{w}\x03"
        for n in langid.ORDERS:
            for i in range(len(marked) - n + 1):
                h = 0
                for k, c in enumerate(marked[i : i + n]):
                    h = (h * 0x100000001B3 + ord(c) + k + 1) % 2**64
                total += m.weights[(h * 0x9E3779B97F4A7C15 % 2**64 >> 32) % len(m.weights)]
                count += 1
        score = total / count * np.sqrt(len(w)) * 3
        ok = m.scripts.get(langid.script_of(w))
        if ok and len(ok) < len(m.langs):
            low = score.min() - 20
            score = np.array([x if k in ok else low for k, x in enumerate(score)])
        rows.append(score - score.max())
    best = max(product(range(len(m.langs)), repeat=len(words)), key=lambda p: sum(r[k] for r, k in zip(rows, p)) - langid.SWITCH * sum(a != b for a, b in zip(p, p[1:])))
    near = [rows[i] + 0.5 * ((rows[i - 1] if i else 0) + (rows[i + 1] if i + 1 < len(rows) else 0)) for i in range(len(rows))]
    return list(best), [float(np.exp(x[k]) / np.exp(x).sum()) for x, k in zip(near, best)]


@pytest.mark.parametrize("cells", [8, 1 << 19])
def test_language_labels_are_brute_force(monkeypatch, cells):
    """Also in blocks of a step or two, as a very long text is worked through."""
    rows = [("the house of the river under water", "en"), ("la maison dans le fleuve et la pierre", "fr"), ("привет как дела мир", "ru")] * 10
    m = langid.train(rows)
    monkeypatch.setattr(langid, "CELLS", cells)
    texts = ["the house la maison привет river", "et la pierre of the water", "дела under le fleuve", "water", "", "the maison of дела le river"]
    for text, (letters, label, chance) in zip(texts, m.spans(texts)):
        want = brute_language(m, text) if text else ([], [])
        assert label.tolist() == want[0] and chance == pytest.approx(want[1], rel=1e-4)
        assert letters.tolist() == list(map(len, langid._words(text)))


def test_no_language_is_left_out(spark):
    rows = [(i, f"word{chr(97 + i % 26)}{chr(97 + i // 26 % 26)} " * 5, f"l{i % 300:03d}") for i in range(1500)]
    m = langid.trained(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert len(m.langs) == 300 and len(m.weights) < langid.BUCKETS


def brute_toxic(net, text):
    """A document's logit by a plain loop over windows, words and directions."""
    sig = lambda x: 1 / (1 + np.exp(-x))
    words, k = toxicity.words_of(text), toxicity.HIDDEN
    if not words:
        return float(net.p["bias"][0])
    best = -np.inf
    for s in toxicity.window_starts(len(words)).tolist():
        x = []
        for w in words[s : s + toxicity.WINDOW]:
            grams = [toxicity._bucket(g) for g in toxicity.grams(w)]
            x.append(np.concatenate([net.p["word"][toxicity._bucket(w)], sum(net.p["char"][g] for g in grams) / np.sqrt(len(grams))]).astype(float))
        states = [[None, None] for _ in x]
        for d in (0, 1):
            h = np.zeros(k)
            for t in range(len(x)) if d == 0 else reversed(range(len(x))):
                g, a = x[t] @ net.p["w"][d] + net.p["b"][d][0], h @ net.p["u"][d]
                z, r = sig(g[:k] + a[:k]), sig(g[k : 2 * k] + a[k : 2 * k])
                c = np.tanh(g[2 * k :] + r * a[2 * k :])
                h = (1 - z) * c + z * h
                states[t][d] = h
        st = np.array([np.concatenate(s) for s in states])
        att = np.exp(st @ net.p["att"] - (st @ net.p["att"]).max())
        best = max(best, float((att / att.sum()) @ st @ net.p["out"] + net.p["bias"][0]))
    return best


def test_network_is_brute_force():
    rng = np.random.default_rng(5)
    net = toxicity.Net(rng)
    net.p["b"] = rng.normal(size=net.p["b"].shape).astype(np.float32)
    texts = ["", "one", " ".join(f"w{i % 7}" for i in range(24)), " ".join(f"w{i * i % 19}" for i in range(61)), "ça va Bien"]
    assert net.document_logits(texts) == pytest.approx([brute_toxic(net, t) for t in texts], abs=1e-4)


def brute_lines(text):
    """Some of a line's features by plain string work."""
    out = []
    lines = (text or "").strip("\n").split("\n")
    for line in lines:
        words = line.split()
        raw = line.encode()
        same = sum(a == b for a, b in zip(words, words[1:]))
        again = len(words) >= 3 and sum(sorted(x.split()) == sorted(words) for x in lines) > 1
        out.append((np.log1p(len(raw)), np.log1p(len(words)), sum(97 <= c <= 122 for c in raw) / max(len(raw), 1), same / max(len(words), 1), len(set(words)) / max(len(words), 1), again))
    return out


def test_line_features_and_weighting_are_brute_force():
    texts = ["The cat sat.\nthe the cat\n\nBUY now!! now\nThe cat sat.", "", None, "é à la la\none two three", "x"]
    x, length, n = quality.line_features(texts)
    want = [r for t in texts for r in brute_lines(t)]
    assert n.tolist() == [len(brute_lines(t)) for t in texts] and length.tolist() == [len(line.encode()) + 1 for t in texts for line in (t or "").strip("\n").split("\n")]
    assert np.allclose(x[:, [0, 1, 2, 9, 10]], [r[:5] for r in want]) and ((x[:, 14] >= 2) == [r[5] for r in want]).all()
    p = np.arange(1, len(x) + 1) / 20
    ends = np.cumsum(n)
    assert np.allclose(quality.weighted(p, length, n), [(p[e - k : e] * length[e - k : e]).sum() / length[e - k : e].sum() for e, k in zip(ends, n)])


def test_toxicity(spark, corpus, docs, no_docs, monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 10)
    d, labels = corpus
    net = toxicity.trained(d, labels)
    got = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(d, net).collect()}
    right = [(got[i] >= toxicity.THRESHOLD) == (i % 5 == 2) for i in got if out(i)]
    assert np.mean(right) > 0.97
    odd = toxicity.score_toxicity(docs, net).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    assert toxicity.score_toxicity(no_docs, net).count() == 0
    assert toxicity.trained(d, labels.where("toxic = 0")).score(["a"]).tolist() == [0.0]


def test_windows_cover_every_word():
    for n in range(200):
        s = toxicity.window_starts(n)
        covered = {k for a in s.tolist() for k in range(a, min(a + toxicity.WINDOW, n))}
        assert covered == set(range(n)) and (n <= toxicity.WINDOW or s[-1] + toxicity.WINDOW == n)


def test_gradients_are_finite_differences():
    n = toxicity.Net(np.random.default_rng(0))
    n.p = {k: v.astype(np.float64) for k, v in n.p.items()}
    enc = toxicity.encoded(["a", "bc", "def", "ghij"])
    wid, y, w = np.random.default_rng(1).integers(0, 4, (5, 3)), np.array([1, 0, 1.0]), np.array([1, 2, 1.0])

    def loss():
        n.table = (n.inputs(*enc) @ n.p["w"] + n.p["b"]).astype(np.float32)
        z = n._run(wid).astype(float)
        return ((np.logaddexp(0, z) - y * z) * w).sum() / w.sum()

    g = n.gradients(wid, enc, y, w)
    for k, at in (("w", (0, 3, 5)), ("u", (1, 3, 4)), ("u", (0, 2, 20)), ("att", (3,)), ("out", (9,)), ("word", (enc[0][1], 2)), ("char", (enc[1][3], 1)), ("b", (1, 0, 9))):
        was = n.p[k][at]
        n.p[k][at] = was + 1e-2
        up = loss()
        n.p[k][at] = was - 1e-2
        down = loss()
        n.p[k][at] = was
        assert g[k].reshape(n.p[k].shape)[at] == pytest.approx((up - down) / 2e-2, rel=0.02, abs=2e-6)


# ---- op4 ---------------------------------------------------------------------------


def brute_hits(text, bench, n=10):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    w, hit, items = words(text), set(), set()
    for i, t in bench:
        b = words(t)
        size = min(n, len(b))
        for k in range(len(b) - size + 1 if size else 0):
            for a in range(len(w) - size + 1):
                if w[a : a + size] == b[k : k + size]:
                    hit |= set(range(a, a + size))
                    if i is not None:
                        items.add(str(i))
    return len(w), len(hit), sorted(items)


BENCH = [(10, "a b c d e f g h i j k l"), (9, "short Item"), (9, "short item"), (3, None), (4, " ... "), (None, "p q r s t u v w x y z"), (11, "ÉA b c d e f g h i j")]


@pytest.mark.parametrize("block_bytes", [1 << 20, 12])
def test_decontamination_is_brute_force(spark, docs, block_bytes):
    bench = spark.createDataFrame(BENCH, "item_id long, text string").withColumn("hits", F.lit(1))
    texts = ["x a b c d e f g h i j k l y A-B-C-D-E-F-G-H-I-J", "a short item, a SHORT\nITEM short", "p q r s t u v w x y", "éa b c d e f g h i j", "ÉA b c d e f g h i j!", "short", None, "", "a b c d e f g h i"]
    d = spark.createDataFrame([(i % 7, t) for i, t in enumerate(texts)], "doc_id long, text string").withColumn("n_words", F.lit("x"))
    got = decontam.scan(d, bench, block_bytes=block_bytes).collect()
    key = lambda r: (r["doc_id"], r["n_words"], r["n_hit"], r["items"])
    assert sorted(map(key, got)) == sorted((i % 7, *brute_hits(t, BENCH)) for i, t in enumerate(texts))
    assert decontam.scan(docs, bench, block_bytes=block_bytes).count() == docs.count()
    assert decontam.scan(docs, bench.where("false")).where("n_hit > 0").count() == 0


def test_removal(spark, docs, no_docs):
    bench = spark.createDataFrame(BENCH, "item_id long, text string")
    long = "Before it all, some quite different words come first here. a b c d e f g h i j k l! And after it, more words follow."
    d = spark.createDataFrame([(1, long, len(long), "u"), (2, "a b c d e f g h i j k l", 23, "u"), (3, "clean text", None, "u"), (4, None, 0, "u")], "doc_id long, text string, n_chars long, hits string")
    got = {r["doc_id"]: r for r in decontam.remove(d, bench).collect()}
    assert set(got) == {1, 3, 4} and got[1]["text"] == "Before it all, some quite different words come first here. ! And after it, more words follow."
    assert got[1]["n_chars"] == len(got[1]["text"]) and got[3]["n_chars"] is None and got[1]["hits"] == "u"
    assert decontam.remove(docs, bench).columns == docs.columns and decontam.remove(no_docs, bench).count() == 0
    seam = "a b c d e a b c d e f g h i j k l f g h i j " + "z" * 3
    assert decontam.cut(seam + " y" * 40, decontam.Index([("1", decontam.words_of(BENCH[0][1]))], 10)) is not None


def test_removal_does_not_depend_on_block_size(spark, docs, no_docs):
    b = lambda x, n=12: " ".join(f"{x}{i}" for i in range(n))
    over = " ".join([*b("u").split(), "v0"])  # its windows overlap those of the next item
    bench = spark.createDataFrame([(1, b("p")), (2, b("q")), (3, over), (4, " ".join([*over.split()[5:], b("v", 9)])), (5, b("w"))], "item_id long, text string")
    own = b("own", 28)
    texts = [
        f"{own[:100]} {b('p')} {b('q')}",  # over half of it by both items only
        f"{own} {' '.join(over.split()[:5])} {' '.join(over.split()[5:])} {b('v', 9)}",
        f"{own} {b('w', 5)} {b('p')} {' '.join(b('w').split()[5:])}",  # a passage at the seam of another
        own, None,
    ]
    d = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, n_chars long")
    whole = {r["doc_id"]: (r["text"], r["n_chars"]) for r in decontam.remove(d, bench).collect()}
    assert 0 not in whole and whole[1][0].split() == whole[2][0].split() == own.split()
    for size in (1, 60, 100):
        assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in decontam.remove(d, bench, block_bytes=size).collect()} == whole
    assert decontam.remove(docs, bench, block_bytes=1).columns == docs.columns and decontam.remove(docs, bench, block_bytes=1).count() == docs.count()
    assert decontam.remove(no_docs, bench, block_bytes=1).count() == 0


def test_further_blocks_write_only_what_they_hit(spark, monkeypatch):
    """Clean texts, of which one key holds a third, are neither written nor moved for a block."""
    bench = spark.createDataFrame([(i, " ".join(f"{x}{k}" for k in range(12))) for i, x in enumerate("pqr")], "item_id long, text string")
    texts = [f"clean text {max(i, 60)}" for i in range(90)] + ["r0 r1 r2 r3 r4 r5 r6 r7 r8 r9 and " + "more " * 20] * 5
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    wrote = []
    monkeypatch.setattr(decontam, "written", lambda df: _counted(wrote, df))
    assert [r["doc_id"] for r in decontam.scan(d, bench, block_bytes=1).where("n_hit = 10").orderBy("doc_id").collect()] == list(range(90, 95))
    assert sum(wrote) == 1, wrote  # five equal texts are one
    kept = decontam.remove(d, bench, chars_col=None, block_bytes=1).collect()
    assert len(kept) == 95 and max(wrote) == 5 and sorted(r["text"] for r in kept)[0].startswith(" and more")


def _counted(wrote, df):
    out = common.written(df)
    wrote.append(out.count())
    return out


def test_an_item_of_equal_words_is_not_quadratic():
    import time

    index = decontam.Index([("1", [b"x"] * 100_000), ("2", [b"x"] * 50), ("3", b"a b c d e f g h i j".split() * 3)], 10)
    began = time.time()
    found = index.scan([[b"x"] * 100_000, b"a b c d e f g h i j".split(), [b"x"] * 9])
    assert time.time() - began < 10
    assert decontam.union(found[0][0]) == [0, 100_000] and found[0][1] == {0, 1} and found[1][1] == {2} and 2 not in found


def test_index_of_another_benchmark_is_not_reused(spark, monkeypatch):
    """Even if the second benchmark's broadcast has the address of the first's."""
    monkeypatch.setattr(decontam, "id", lambda _: 1, raising=False)
    d = spark.createDataFrame([(1, "a b c d"), (2, "p q r s")], "doc_id long, text string").coalesce(1)
    for text, want in (("a b c d", [1]), ("p q r s", [2])) * 3:
        bench = spark.createDataFrame([(1, text)], "item_id long, text string")
        assert [r["doc_id"] for r in decontam.scan(d, bench).where("n_hit > 0").collect()] == want
        assert [r["doc_id"] for r in decontam.remove(d, bench, chars_col=None).collect()] == [3 - want[0]]


# ---- the registered queries --------------------------------------------------------

SF = "/root/testdata/sf0.001"
CONTRACT = {
    "op1_chat_format": "conv_id bigint, n_turns bigint, turns_sha256 string, loss_chars bigint, loss_sha256 string, formatted_chars bigint",
    "op2_quality": "doc_id bigint, held_out boolean, score double, predicted int",
    "op3_mixing": "doc_id bigint, size bigint, source_size bigint, target double, taken bigint",
    "op4_decontaminate": "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean",
    "op5_token_counts": "doc_id bigint, n_bytes bigint, n_tokens bigint, over_limit boolean",
    "op6_simhash": "doc_id bigint, fingerprint string, component_id bigint",
    "op8_ann": "query_id bigint, rank int, vec_id bigint, score double",
    "op9_language_id": "doc_id bigint, held_out boolean, lang_pred string, score double",
    "op10_toxicity": "doc_id bigint, held_out boolean, score double, predicted int",
}


@pytest.mark.parametrize("name", CONTRACT)
def test_contract_columns(spark, name):
    from skyweft import llm

    got = llm.queries()[name](spark, SF)
    kinds = [tuple(c.split()) for c in CONTRACT[name].split(", ")]
    assert got.dtypes[: len(kinds)] == kinds
    rows = got.collect()
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id").collect()
    if "doc_id" in got.columns:
        assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in docs)
    if "held_out" in got.columns:
        assert all(r["held_out"] == out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)
    if "predicted" in got.columns:
        least = quality.THRESHOLD if name.startswith("op2") else toxicity.THRESHOLD
        assert all(r["predicted"] == int(r["score"] >= least) for r in rows)


# ---- op5 ---------------------------------------------------------------------------


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(tokens.TOKENIZER)
    return path, Tokenizer.from_file(path)


def test_token_counts_are_the_librarys(docs, no_docs, tokenizer):
    path, lib = tokenizer
    got = tokens.count_tokens(docs.withColumn("n_tokens", F.lit("clash")), path).collect()
    want = [(r["doc_id"], len((r["text"] or "").encode()), len(lib.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()]
    key = lambda x: (x[0] is None, x[0] or 0, *x[1:])
    assert sorted(((r["doc_id"], r["n_bytes"], r["n_tokens"]) for r in got), key=key) == sorted(want, key=key)
    assert all(r["over_limit"] == (r["n_tokens"] > 2048) for r in got)
    assert tokens.count_tokens(no_docs, path).count() == 0


def test_token_counts_of_odd_texts(tokenizer, monkeypatch):
    import random

    path, lib = tokenizer
    monkeypatch.setattr(tokens, "CACHE_ENTRIES", 50)
    rng = random.Random(4)
    chars = [chr(i) for i in range(1, 256)] + list("’“中文ßΣς́ İ") + ["<|endoftext|>", "<|startoftext|>", "'s", "'LL", "<|"] * 4
    texts = ["".join(rng.choice(chars) for _ in range(60)) for _ in range(400)]
    c = tokens.Counts(path, {})
    got = [int(n) for i in range(0, 400, 20) for n in c.count(texts[i : i + 20])]
    assert got == [len(e) for e in lib.encode_batch(texts, add_special_tokens=False)]


# ---- op7 ---------------------------------------------------------------------------


def test_lm_scores(spark, corpus, docs, no_docs):
    d, _ = corpus
    good = [r["text"] for r in d.where("lang = 'en'").limit(50).collect()]
    got = lmscore.cross_entropy_difference(d, good).join(d.select("doc_id", "lang"), "doc_id").groupBy("lang").agg(F.avg("score").alias("s")).collect()
    by = {r["lang"]: r["s"] for r in got}
    assert by["en"] < by["fr"]
    odd = {r["doc_id"]: r for r in lmscore.cross_entropy_difference(docs, good).collect()}
    assert odd[2]["score"] is None and odd[3]["n_tokens"] == 0 and odd[7]["n_tokens"] == 60_000
    assert lmscore.cross_entropy_difference(no_docs, []).count() == 0
    assert lmscore.cross_entropy_difference(docs, []).count() == docs.count()


def test_lm_probabilities_sum_to_one(spark, corpus):
    d, _ = corpus
    vocab = lmscore.Vocabulary(lmscore.top_words(lmscore.word_counts(d), 20))
    models = lmscore.build(d, vocab, ["the river"], most=30)
    for a in (1, 2, 5):
        p = np.exp(-models.losses(a * vocab.size + np.arange(vocab.size)))
        assert np.allclose(p.sum(1), 1.0, atol=1e-4)


def brute_losses(texts, target):
    """(tokens, target loss, background loss) of each text by full bigram counts."""
    from collections import Counter
    from math import log

    words = lambda t: decontam.words_of(t)
    size = len({w for t in texts for w in words(t)}) + 2
    models = []
    for part in (target, texts):
        pair, first, word, after = Counter(), Counter(), Counter(), Counter()
        for t in part:
            pair.update(zip([None, *words(t)], words(t)))
            word.update(words(t))
        for (a, _), n in pair.items():
            first[a] += n
            after[a] += 1
        models.append((pair, first, word, after, word.total()))
    out = []
    for t in texts:
        w, row = words(t), [len(words(t))]
        for pair, first, word, after, total in models:
            uni = lambda b: (word[b] + 10 / size) / (total + 10)  # noqa: E731, B023
            p = [max(pair[a, b] - 0.75, 0) / max(first[a], 1) + (0.75 * after[a] / first[a] if first[a] else 1) * uni(b) for a, b in zip([None, *w], w)]
            row.append(-sum(map(log, p)) / len(w) if w else None)
        out.append(tuple(row))
    return out


@pytest.mark.parametrize("ngrams", [3, 1000])
def test_lm_scores_with_every_bigram_and_all_targets(spark, ngrams):
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{k}" for k in rng.integers(0, 40, rng.integers(0, 30))) for _ in range(60)]
    d = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    ids = spark.createDataFrame([(i,) for i in range(0, 60, 2)] * 2 + [(None,), (999,)], "doc_id long")
    got = lmscore.cross_entropy_difference(d, ids, ngrams=ngrams, most_ids=7).orderBy("doc_id").collect()
    for r, (n, target, background) in zip(got, brute_losses(texts, texts[::2]), strict=True):
        assert r["n_tokens"] == n
        assert (r["target_loss"], r["background_loss"]) == (pytest.approx(target, abs=1e-8), pytest.approx(background, abs=1e-8)) if n else r["score"] is None


def test_op7_target_is_every_good_document(spark, tmp_path):
    """A held-out id and a text over 839 KB count; an id with differing labels does not."""
    held = next(i for i in range(100, 200) if out(i))
    rows = [(0, "a b c d"), (1, "x " * 430_000), (held, "b c d e"), (3, "c d e f"), (4, "d e f a"), (5, "e f a b")]
    labels = [(0, 1), (1, 1), (held, 1), (3, 0), (3, 1), (4, 0)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    got = {r["doc_id"]: r["target_loss"] for r in lmscore.op7_lm_score(spark, str(tmp_path)).collect()}
    want = brute_losses([t for _, t in rows], [t for _, t in rows[:3]])
    assert got == {i: pytest.approx(w[1], abs=1e-6) for (i, _), w in zip(rows, want)}


@pytest.mark.parametrize("most", [0, 10])
def test_target_flags_by_broadcast_and_by_shuffle(spark, most):
    d = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (None, "c"), (3, None)], "id long, text string")
    ids = spark.createDataFrame([(1,), (3,), (9,)], "id long")
    got = sorted((r["text"] or "", r["is_target"]) for r in lmscore.flagged(d, ids, most).collect())
    assert got == [("", True), ("a", True), ("a", True), ("b", False), ("c", False)]
