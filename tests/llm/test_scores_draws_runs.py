"""Language-model scores, importance resampling and periodic runs against plain versions: nulls, empty and long texts, ties, repeats, clashes."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from notelake.llm import ngrams, periods, resampling

DOCS = "doc_id long, text string"
RND = random.Random(11)
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(n, rnd=RND):
    return " ".join(rnd.choice(["the", "Of", "and", "Édu", "über", "KK", "x1"]) if rnd.random() < 0.5 else f"w{int(rnd.paretovariate(0.6)) % 400}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rows = [(i, prose(RND.randrange(1, 80))) for i in range(120)]
    rows += [(200 + i, rows[i][1]) for i in range(40)] + [(5, rows[5][1])] * 3 + [(5, "other text of one id")]
    rows += [(300, None), (301, ""), (302, " \t\n\x0b\x0c\r "), (303, prose(4000)), (304, "one"), (305, "\x1c odd\x1dgaps stay"), (None, prose(30)), (None, None)]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


# Language-model scores


def plain_model(rows, order, folds):
    counts = Counter()
    for i, ws in rows:
        if fold(i) in folds:
            seq = ["<b>"] * (order - 1) + ws
            counts.update(("<b>",) * j for j in range(1, order))
            counts.update(tuple(seq[k - j + 1 : k + 1]) for k in range(order - 1, len(seq)) for j in range(1, order + 1))
    n = sum(c for g, c in counts.items() if len(g) == 1 and g != ("<b>",))
    return counts, n, sum(len(g) == 1 and g != ("<b>",) for g in counts)


def fold(i):
    return 0 if i is None else zlib.crc32(str(i).encode()) % 5


def estimates(model, seq, k, order):
    counts, n, v = model
    p, bucket = [1 / (v + 1)], 0
    for j in range(1, order + 1):
        met = counts[tuple(seq[k - j + 1 : k])] if j > 1 else n
        if not met:
            break
        p.append(counts[tuple(seq[k - j + 1 : k + 1])] / met)
        bucket = 64 * j + met.bit_length()
    return bucket, tuple(p)


@pytest.mark.parametrize("order", [1, 2, 3])
def test_scores(spark, corpus, order):
    rows = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER)) + [None]) for i, t in corpus]
    docs = frame(spark, corpus).withColumns({"score": F.lit("clash"), "block": F.lit(1), "fold": F.lit(2)})
    got = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in ngrams.scored(docs, order, size=3000, keys=300).collect())
    kept, every = plain_model(rows, order, (0, 2, 3)), plain_model(rows, order, (0, 2, 3, 4))
    events = {}
    for i, ws in rows:
        if fold(i) == 4:
            seq = ["<b>"] * (order - 1) + ws
            for k in range(order - 1, len(seq)):
                bucket, p = estimates(kept, seq, k, order)
                events.setdefault(bucket, Counter())[p] += 1
    weights = {b: ngrams.em(np.array(list(c.values()), float), np.array(list(c))) for b, c in events.items()}
    of = ngrams.Mixture(order, 0, 0, weights).of
    counts, n, v = every
    want, scores = Counter(), []
    for i, ws in rows:
        seq = ["<b>"] * (order - 1) + ws
        met = [estimates(every, seq, k, order) for k in range(order - 1, len(seq))]
        scores.append((i or -1, sum(math.log10(sum(a * b for a, b in zip(of(b), p, strict=False))) for b, p in met)))
        want[i, fold(i) == 1, len(ws), sum(counts[w,] > 0 for w in ws), n, round(sum(math.log10((counts[w,] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)] += 1
    assert got == want
    found = sorted((r.doc_id or -1, r.score) for r in ngrams.scored(frame(spark, corpus), order).collect())
    assert [i for i, _ in found] == [i for i, _ in sorted(scores)]
    assert all(abs(a - b) < 1e-3 + 2e-3 * abs(b) for (_, a), (_, b) in zip(found, sorted(scores), strict=True))


def test_probabilities_sum_to_one(spark, corpus):
    texts = [t for _, t in corpus]
    block = ngrams.Block(texts, 2)
    counts = block.counts(np.ones(len(texts), bool)).astype(float)
    words = np.unique(block.grams[0])
    model = ngrams.Mixture(2, int(counts[words].sum()), len(words), {})
    bucket, p = model.estimates(block, counts)
    for context in np.unique(block.contexts[0])[:30]:
        at = np.flatnonzero(block.contexts[0] == context)
        w = model.of(int(bucket[at[0]]))
        _, first = np.unique(block.grams[0][at], return_index=True)
        total = w[2] * p[2][at[first]].sum() + w[1] * (counts[words] / model.n).sum() + w[0] * (model.v + 1) / (model.v + 1)
        assert abs(total - 1) < 1e-9


def test_more_context_scores_better(spark):
    rnd = random.Random(3)
    chain = {w: rnd.sample(range(60), 3) for w in range(60)}

    def walk(n):
        w, out = rnd.randrange(60), []
        for _ in range(n):
            out.append(f"v{w}")
            w = rnd.choice(chain[w])
        return " ".join(out)

    rows = [(i, walk(60)) for i in range(300)]
    held = ngrams.scored(frame(spark, rows)).where("held_out").agg(F.sum("score").alias("s"), F.sum("base_score").alias("b")).first()
    assert held.s > 0.6 * held.b  # log10 60 against log10 3


def test_scores_of_nothing(spark):
    assert ngrams.scored(frame(spark, [])).count() == 0
    untaught = ngrams.scored(frame(spark, [(i, "a b") for i in range(40) if fold(i) == 1])).collect()
    assert untaught and all((r.score, r.base_score, r.n_known, r.train_tokens) == (0, 0, 0, 0) for r in untaught)


# Importance resampling


def test_bit_planes():
    rnd = np.random.default_rng(1)
    for n in (1, 63, 64, 1000):
        gains = rnd.integers(-5000, 5000, n)
        planes = resampling.GainPlanes(gains)
        for m in (0, 1, 50, 3000):
            buckets = np.minimum(rnd.geometric(0.05, m) - 1, n - 1)
            assert planes.weight(buckets) == gains[buckets].sum()
    assert resampling.GainPlanes(np.zeros(5)).weight(np.array([1, 1])) == 0


@pytest.mark.parametrize(("longest", "buckets"), [(1, 10_000), (2, 37)])
def test_resampling(spark, corpus, longest, buckets):
    target = ["the of and", None, "", "Édu w1 w2 w1", "KK"]
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def found(t):
        ws = word.findall((t or "").translate(LOWER))
        return len(ws), [zlib.crc32(" ".join(ws[i : i + k]).encode()) % buckets for k in range(1, longest + 1) for i in range(len(ws) - k + 1)]

    s, t = Counter(b for _, x in corpus for b in found(x)[1]), Counter(b for x in target for b in found(x)[1])
    gain = [math.floor(1000 * math.log((t[b] + 1) * (s.total() + buckets) / ((s[b] + 1) * (t.total() + buckets)))) for b in range(buckets)]
    rows = []
    for i, x in corpus:
        n, bs = found(x)
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in bs)
        rows.append((i, n, len(bs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))))
    may = sorted((r for r in rows if r[1] >= 20), key=lambda r: (-r[4], -1 if r[0] is None else r[0], r[2], r[3]))
    drawn = 10 * len(may) // 100
    want = Counter((*r[:1], *r[2:], k + 1 if k < drawn else None) for k, r in enumerate(may)) + Counter((r[0], *r[2:], None) for r in rows if r[1] < 20)
    docs = frame(spark, corpus).withColumns({"rank": F.lit("x"), "weighed": F.lit("y"), "part": F.lit(1)})
    got = resampling.resampled(docs, spark.createDataFrame([(x,) for x in target], "text string"), longest, buckets)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert Counter(map(tuple, got.collect())) == want


def test_resampling_of_nothing(spark, corpus):
    empty = spark.createDataFrame([], "text string")
    assert resampling.resampled(frame(spark, []), empty).count() == 0
    assert resampling.resampled(frame(spark, corpus), empty).where("rank IS NOT NULL").count() > 0


def test_places_over_many_ranges(spark, monkeypatch):
    monkeypatch.setattr(resampling, "RANGE", 40)
    rows = frame(spark, [(i, i % 7, 0, 0) for i in range(1000)] + [(3, 3, 0, 0)] * 5, "doc_id long, score long, n_features long, weight long")
    got = [(r.score, r.doc_id) for r in resampling._placed(rows).orderBy("place").collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and len(got) == 1005
    assert [r.place for r in resampling._placed(rows).orderBy("place").collect()] == list(range(1, 1006))


# Periodic runs


def plain_runs(t, exponent=4, least=6):
    n, out = len(t), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i < n - q:
            j = i
            while j < n - q and t[j] == t[j + q]:
                j += 1
            size = j + q - i
            if j > i and size >= max(least, exponent * q) and not any(t[i : j + q - d] == t[i + d : j + q] for d in range(1, q)):
                out.append((i, size, q))
            i = max(j, i + 1)
    return sorted(out)


def repetitive(rnd):
    k = rnd.choice([1, 2, 2, 3, 5, 50])
    t = [rnd.randrange(k) for _ in range(rnd.randrange(120))]
    for _ in range(rnd.randrange(4)):
        p, at = rnd.randrange(1, 20), rnd.randrange(len(t) + 1)
        t[at:at] = ([rnd.randrange(k) for _ in range(p)] * 9)[: rnd.randrange(p, p * 8)]
    return t


def test_catchers_whole_and_word_by_word():
    rnd = random.Random(2)
    for _ in range(600):
        t, e = repetitive(rnd), rnd.choice([3, 4, 4, 5])
        whole, grown, i = periods.Catchers(e), periods.Catchers(e), 0
        whole.append(np.array(t), last=True)
        assert whole.runs() == plain_runs(t, e)
        while i < len(t):
            step = rnd.choice([1, 1, 2, 3, 7, 30])
            grown.append(np.array(t[i : i + step]))
            i += step
            if rnd.random() < 0.1:
                assert grown.runs() == plain_runs(t[:i], e)
        assert grown.runs() == plain_runs(t, e)


def test_catchers_despite_equal_hashes(monkeypatch):
    monkeypatch.setattr(periods, "_POWERS", [np.zeros(2048, np.uint64), np.zeros(2048, np.uint64)])  # every block meets every other
    rnd = random.Random(4)
    for _ in range(60):
        t = repetitive(rnd)
        caught = periods.Catchers()
        caught.append(np.array(t), last=True)
        assert set(caught.runs()) <= set(plain_runs(t))


def test_runs_of_long_texts():
    assert periods.runs_of("a " * 60_000) == ([(0, 60_000, 1)], "a")
    assert periods.runs_of(" ".join(["x y z"] * 20_000 + ["end"]))[0] == [(0, 60_000, 3)]
    assert len(periods.runs_of(("a " * 500 + "b ") * 40)[0]) == 41


def test_periodic_digest(spark, corpus):
    rnd = random.Random(6)
    rows = [*corpus, *[(1000 + i, " ".join(map(str, repetitive(rnd)))) for i in range(150)]]
    got = Counter(map(tuple, periods.digest(frame(spark, rows).withColumns({"runs": F.lit(1), "told": F.lit(2), "collapsed": F.lit(3)})).collect()))
    want = Counter()
    for i, text in rows:
        ws = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        n, h = len(ws), zlib.crc32(str(i).encode())
        if i is not None and h % 10 == 0 and n:
            a = h // 10 % n
            p = 1 + (n - a) // (3 + h // 10 % 8)
            ws = [w if k < a else ws[a + (k - a) % p] for k, w in enumerate(ws)]
        runs = plain_runs(ws)
        best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2])) if runs else (None,) * 3
        left = [w for k, w in enumerate(ws) if not any(a + q <= k < a + m for a, m, q in runs)]
        told = [hashlib.sha256(x.encode()).hexdigest() for x in ("".join(f"{a},{m},{q}\n" for a, m, q in runs), " ".join(left))]
        want[i, len(runs), *best, best[1] * 1000 // best[2] if runs else None, *told] += 1
    assert got == want


def test_runs_of_nothing(spark):
    assert periods.digest(frame(spark, [])).count() == 0
    assert periods.runs_of(None) == ([], "") == periods.runs_of(" \t ")
    with pytest.raises(ValueError):
        periods.Catchers(2)
