"""Each operator against a plain version on small fixtures: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import gzip
import hashlib
import math
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from notelake.llm import alike, chat, licenses, lines, minhash, mixing, pieces, quality, search, simhash, warc
from notelake.llm.components import components
from notelake.llm.queries import model_path

DOCS = "doc_id long, text string"
RND = random.Random(5)
WORDS = ["alpha", "beta", "Gamma", "délta", "eps", "zeta1", "eta", "theta", "iota", "kappa"]


def prose(n, rnd=RND):
    return " ".join(rnd.choice(WORDS) + str(rnd.randrange(30)) for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    base = [prose(RND.randrange(1, 60)) for _ in range(25)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i]) for i in range(5)] + [(150, base[0]), (150, base[0])]
    rows += [(200 + i, base[i].rsplit(" ", 1)[0] + " changed") for i in range(8)]
    rows += [(300, None), (301, ""), (302, " \t\n\x0b\x0c\r "), (303, prose(3000)), (304, "one"), (305, "one two three"), (350, None)]
    return rows


def frame(spark, rows, schema=DOCS):
    return spark.createDataFrame(rows, schema)


def test_search(spark, corpus):
    got = defaultdict(list)
    for r in search.digest(frame(spark, corpus).withColumn("rank", F.lit("clash"))).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.doc_id, round(r.score, 6)))
    tok = [(i, Counter(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").lower()))) for i, t in corpus]
    n, mean = len(tok), sum(sum(c.values()) for _, c in tok) / len(tok)
    df = Counter(w for _, c in tok for w in c)
    seen = set()
    for q, terms in tok:
        if q % 50 or not terms or q in seen:
            continue
        seen.add(q)
        scores = []
        for i, c in tok:
            norm = 1.2 * (0.25 + 0.75 * sum(c.values()) / mean)
            s = sum(f * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * c[w] * 2.2 / (c[w] + norm) for w, f in terms.items() if w in c)
            if s > 0:
                scores.append((-round(s, 6), i))
        want = [(i, -s) for s, i in sorted(scores)[:10]]
        times = sum(i == q for i, _ in corpus)
        assert [x for x in got[q] for _ in [0]] == sorted([x for x in want for _ in range(times)], key=lambda x: (-x[1], x[0]))
    assert set(got) == seen


def test_search_of_nothing(spark):
    assert search.digest(frame(spark, [])).count() == 0


def test_pruning_over_shards(spark):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choices([f"w{k}" for k in range(40)], [1 / (k + 1) for k in range(40)], k=rnd.randrange(1, 50)))) for i in range(900)]
    docs = frame(spark, rows)
    asked = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    found = lambda shard: {(r.query_id, r.rank, r.doc_id, round(r.score, 9)) for r in search.top_k(docs, asked, shard=shard).collect()}
    assert found(1 << 30) == found(8_000)


def test_shards_go_to_python_singly(spark, corpus, monkeypatch):
    """A batch of several shards, or of a shard with several blocks of queries, is held whole by Spark and by Python."""
    seen = spark.sparkContext.accumulator(0)
    searcher, sealed = search._searcher, search._sealed

    def counted(batches):
        for b in batches:
            if len(b) > 1:
                seen.add(1)
            yield b

    monkeypatch.setattr(search, "_searcher", lambda k: lambda batches: searcher(k)(counted(batches)))
    monkeypatch.setattr(search, "_sealed", lambda frames: sealed(counted(frames)))
    monkeypatch.setattr(search, "TERMS_AT_ONCE", 60)
    docs = frame(spark, corpus).coalesce(1)
    asked = docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query"))
    was = spark.conf.get(search.AT_ONCE, None)
    assert search.top_k(docs, asked, shard=4000).count() and not seen.value and spark.conf.get(search.AT_ONCE, None) == was


def test_blocks_are_skipped(spark):
    rnd = random.Random(6)
    vocabulary = [f"w{k}" for k in range(3000)]
    rows = []
    for i in range(6000):  # 30 subjects with words of their own
        own = vocabulary[i % 30 * 100 : i % 30 * 100 + 100]
        rows.append((i, " ".join(rnd.choices(own, k=30) + rnd.choices(vocabulary[:20], k=10))))
    index, n, _ = search.build(frame(spark, rows))
    (row,) = index.toPandas().itertuples(index=False)
    shard = search.Shard(row)
    df = Counter(w for _, t in rows for w in set(t.split()))
    hashes = {r.w: r.h for r in spark.createDataFrame([(w,) for w in df], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    average = sum(len(t.split()) for _, t in rows) / n
    queries = []
    for q in range(0, 6000, 200):
        tf = Counter(rows[q][1].split())
        pairs = sorted((hashes[w], f * math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5))) for w, f in tf.items())
        queries.append((q, np.array([h for h, _ in pairs]), np.array([w for _, w in pairs])))
    got = dict(shard.search(queries, 10, np.zeros(len(queries))))
    for q, terms, weights in queries:
        by = dict(zip(terms.tolist(), weights.tolist(), strict=True))
        scores = sorted((-sum(by[hashes[w]] * c * 2.2 / (c + 1.2 * (0.25 + 0.75 * 40 / average)) for w, c in Counter(t.split()).items() if hashes[w] in by), i) for i, t in rows)
        assert [i for _, i in got[q]] == [i for _, i in scores[:10]]
    assert shard.scored < shard.met / 3


def test_licenses(spark):
    rows = [(1, "CC-BY cc by. All  RIGHTS, reserved"), (2, None), (3, ""), (4, "ccK by"), (5, "x " * 5000 + "general public license"), (6, "Released under the MIT License."), (6, "by cc"), (7, "cc byé"), (8, "éCC by"), (9, "İ all rights reserved all rights reserved")]
    got = licenses.digest(frame(spark, rows).withColumn("hits", F.lit(1))).collect()
    want = {}
    for i, t in rows:
        ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        places = [(k, lab) for p, lab in licenses.BASE.items() for k in range(len(ws)) if ws[k : k + len(p.split())] == p.split()]
        at = [k for k, _ in places]
        want[i, len(ws)] = (len(places), min(at, default=None), max(at, default=None), ",".join(sorted({lab for _, lab in places})))
    assert {(r.doc_id, r.n_words): (r.n_base, r.first_word, r.last_word, r.base_labels) for r in got} == want
    labels = {(r.doc_id, r.n_words): r for r in got}
    assert labels[6, 5].labels == "mit" and labels[6, 5].score == 1.0 and labels[2, 0].score == 0.0
    assert licenses.digest(frame(spark, [])).count() == 0


def test_notices_are_found_when_changed(spark):
    rnd = random.Random(8)
    rows, want = [], []
    for n, (label, text, keys) in enumerate(licenses.NOTICES):
        ws = re.findall(r"[0-9a-z]+", text.lower())
        fixed = {i + j for k in keys for j in range(len(k.split())) for i in range(len(ws)) if ws[i : i + len(k.split())] == k.split()}
        for trial in range(6):
            changed = [w if k in fixed or rnd.random() > 0.07 else rnd.choice(["word", "", "two words"]) for k, w in enumerate(ws)]
            rows.append((n * 10 + trial, f"{prose(rnd.randrange(40), rnd)} {' '.join(changed)} {prose(30, rnd)}"))
            want.append(label)
    rows += [(9000 + k, prose(400, rnd)) for k in range(20)] + [(9100, " ".join(re.findall(r"[a-z]+", licenses.NOTICES[0][1].lower())[::-1]))]
    got = {r.doc_id: set(r.labels.split(",")) for r in licenses.digest(frame(spark, rows).withColumn("words", F.lit("clash"))).collect()}
    hit = [label in got[d] for (d, _), label in zip(rows, want, strict=False)]
    assert sum(hit) / len(hit) >= 0.9
    assert all(got[d] == {""} for d, _ in rows if d >= 9000)


def test_notice_coverage_by_a_plain_version(spark):
    rnd = random.Random(12)
    postings, notices, _ = licenses._index()
    rows = []
    for n, (_, text, _) in enumerate(licenses.NOTICES):
        ws = re.findall(r"[0-9a-z]+", text.lower())
        at = rnd.randrange(len(ws))
        rows.append((n, " ".join(["x"] * rnd.randrange(50) + ws[:at] + ["y"] * rnd.randrange(25) + ws[at:] + rnd.choices(sorted(postings), k=60))))
    got = {r.doc_id: {(h.label, h.start, round(h.coverage, 9)) for h in r.hits if not h.base} for r in licenses.scan(frame(spark, rows)).collect()}
    for d, text in rows:
        ws, want = text.split(), set()
        votes = defaultdict(set)
        for i, w in enumerate(ws):
            for x in postings.get(w, []):
                off = i - x["p"]
                for bucket in ((0, off // 32), (1, (off + 16) // 32)):
                    votes[x["t"], bucket].add((x["p"], x["w"], off))
        for (t, _), found in votes.items():
            share = sum(w for _, w in {(p, w) for p, w, _ in found}) / notices[t]["weight"]
            off = min(o for _, _, o in found)
            first = max(off - 16, 0)
            last = max(min(off + notices[t]["size"] + 32, len(ws)) - 1, first)
            keys = all(any(ws[i : i + len(k)] == k for i in range(first, last + 1)) for k in notices[t]["keys"])
            if share >= 0.5 and keys:
                want.add((notices[t]["label"], max(off, 0), round(min(share, 1.0), 9)))
        assert got[d] == want


def near(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k + 1 :] == b[k:] if len(a) > len(b) else a[k:] == b[k + 1 :]


def test_line_dedup(spark):
    rnd = random.Random(3)
    base = [[rnd.choice("abcdefgh") for _ in range(rnd.choice([7, 8, 9, 10]))] for _ in range(10)]
    rows = []
    for i in range(80):
        text = []
        for _ in range(3):
            w = list(rnd.choice(base))
            for _ in range(rnd.choice([0, 1, 1, 2])):
                k, how = rnd.randrange(len(w)), rnd.choice("cid")
                w[k : k + (how != "i")] = [] if how == "d" else [rnd.choice("abcxyz")]
            text.append("  ".join(w))
        rows.append((i, "\n".join(text)))
    rows += [(500, None), (501, ""), (502, "\n \n"), (503, "a\n\na"), (None, "null id"), (504, "null id"), (505, "q " * 3000)]
    docs = frame(spark, rows)
    order = sorted(((d is not None, d or 0), k, d, line.split()) for d, t in rows for k, line in enumerate((t or "").split("\n")) if line.split())
    first, drop, kept = {}, set(), []
    for _, k, d, w in order:
        if tuple(w) in first:
            drop.add((d, k))
        first.setdefault(tuple(w), len(kept))
        if first[tuple(w)] == len(kept):
            kept.append(w)
    bad = {tuple(w) for i, w in enumerate(kept) if len(w) >= 8 and any(len(x) >= 8 and near(w, x) for x in kept[:i])}
    # a line of 8 words may also be one of 7 with a word put in, but lines of fewer than 8 have no near copies
    drop |= {(d, k) for _, k, d, w in order if tuple(w) in bad}
    assert {(r.doc_id, n) for r in lines.dropped(docs).collect() for n in r.drops} == drop
    clash = docs.select("*", *[F.lit("clash").alias(c) for c in ("own", "_own", "_doc", "drops", "_drops", "Mark")])
    out = {r.doc_id: r for r in lines.deduplicated(clash, keep="n_kept").collect()}
    for d, t in rows:
        want = None if t is None else "\n".join(x for k, x in enumerate(t.split("\n")) if (d, k) not in drop)
        assert out[d].text == want and {out[d][c] for c in clash.columns[2:]} == {"clash"}
    assert lines.digest(frame(spark, [])).count() == 0


def test_simhash(spark, corpus):
    def fp(t):
        ws = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        if not ws:
            return 0
        h = [xxhash.xxh64(" ".join(ws[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(ws) - 3))]
        return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))

    rows = corpus + [(400 + i, "a b c d " * 50 + f"e{i}") for i in range(40)]
    fps = [fp(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= 4:
                old, new = root[i], root[j]
                root = [new if r == old else r for r in root]
    least = {r: min(rows[i][0] for i in range(len(rows)) if root[i] == r) for r in root}
    want = sorted((d, f"{f:016x}", least[r]) for (d, _), f, r in zip(rows, fps, root, strict=True))
    assert sorted(map(tuple, simhash.digest(frame(spark, rows).withColumn("fp", F.lit(0))).collect())) == want
    assert simhash.digest(frame(spark, [])).count() == 0
    assert {r.doc_id for r in simhash.kept(frame(spark, rows)).collect()} == set(least.values())


def test_simhash_keeps_one_row_of_each_component(spark):
    texts = [prose(60, random.Random(k)) for k in range(6)]
    rows = [(None, texts[0], "x"), (None, texts[1], "x"), (None, texts[1], "y"), (7, texts[2], "x"), (7, texts[3], "x"), (7, texts[3], "x"), (None, texts[4], "x"), (9, texts[4], "x"), (8, texts[5], None)]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    clash = docs.select("*", *[F.lit("clash").alias(c) for c in ("_id", "id", "row", "_row", "of", "sketch")])
    assert sorted(map(str, simhash.kept(clash, 0.8).drop("_id", "id", "row", "_row", "of", "sketch").collect())) == sorted(map(str, simhash.kept(docs).collect()))
    got = [tuple(r) for r in simhash.kept(docs).collect()]
    assert sorted((r[:2] for r in got), key=str) == sorted([(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[4]), (8, texts[5])], key=str)
    assert sorted(got, key=str) == sorted((tuple(r) for r in simhash.kept(docs.repartition(5)).collect()), key=str)
    assert simhash.kept(docs).columns == docs.columns


def test_similar_texts_of_large_buckets_lose_no_link(spark):
    """Variants near the least similarity, of which many match some leader of a bucket and not each other's."""
    rnd, rows = random.Random(5), []
    for k in range(6):
        base = [f"f{k}w{j}" for j in range(200)]
        for _ in range(60):
            ws = list(base)
            for at in rnd.sample(range(200), rnd.choice((2, 2, 3, 3))):
                ws[at] = f"x{rnd.randrange(10**9)}"
            rows.append((len(rows), " ".join(ws)))
    sets = [{tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} for ws in (t.split() for _, t in rows)]
    root = list(range(len(rows)))
    find = lambda x: x if root[x] == x else find(root[x])
    for a in range(len(rows)):
        for b in range(a // 60 * 60, a):
            if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    want = {find(a) for a in range(len(rows))}
    docs = alike.sketched(frame(spark, rows).withColumn("_row", F.col("doc_id"))).select("doc_id", "_row", "text", "sketch.*").localCheckpoint()
    of = {r.node: r.doc_id for r in docs.collect()}
    links = alike.links(docs.select("node", "n", "bands", "_row"), docs.select("_row", "text")).collect()
    root = list(range(len(rows)))
    for r in links:
        x, y = sorted((find(of[r.a]), find(of[r.b])))
        root[y] = x
    assert {find(a) for a in range(len(rows))} == want and 6 <= len(want) < 300


def test_few_pairs_of_a_large_group_are_compared(spark, monkeypatch):
    """Variants of one text at half the least similarity and more: most meet in some band, few are so similar."""
    rnd, n = random.Random(8), 240
    base = [f"w{j}" for j in range(120)]
    rows = []
    for k in range(n):
        ws = list(base)
        for at in rnd.sample(range(120), rnd.choice((1, 4, 8, 8, 8, 12, 12, 16))):
            ws[at] = f"x{rnd.randrange(10**9)}"
        rows.append((k, " ".join(ws)))
    rows += [(n + k // 10, f"{t} y") for k, t in rows[::10]]
    sets = [{tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} for ws in (t.split() for _, t in rows)]
    near = {(a, b) for b in range(len(rows)) for a in range(b) if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    find = lambda root, x: x if root[x] == x else find(root, root[x])

    def joined(pairs):
        root = list(range(len(rows)))
        for a, b in pairs:
            x, y = sorted((find(root, a), find(root, b)))
            root[y] = x
        return [find(root, a) for a in range(len(rows))]

    docs = alike.sketched(frame(spark, rows).withColumn("_row", F.col("doc_id"))).select("doc_id", "_row", "text", "sketch.*").localCheckpoint()
    of, compared, verified = {r.node: r.doc_id for r in docs.collect()}, [], alike.verified
    monkeypatch.setattr(alike, "verified", lambda pairs, *rest: compared.append(pairs.count()) or verified(pairs, *rest))
    links = alike.links(docs.select("node", "n", "bands", "_row"), docs.select("_row", "text")).collect()
    assert len(of) == len(rows) and joined((of[r.a], of[r.b]) for r in links) == joined(near) and len(set(joined(near))) > 150
    assert sum(compared) < 12 * len(rows)


def test_simhash_stage_drops_similar_texts(spark):
    rnd, rows, want = random.Random(11), [], set()
    sets = lambda ws: {tuple(ws[i : i + 5]) for i in range(len(ws) - 4)}
    likeness = lambda a, b: len(sets(a) & sets(b)) / len(sets(a) | sets(b))
    for k in range(60):
        a = [f"w{rnd.randrange(10**6)}" for _ in range(rnd.randrange(200, 400))]
        least = (0.8, 0.85, 0.9, 0.3)[k % 4]
        b = list(a)
        while True:
            at = rnd.randrange(len(a))
            after = [*b[:at], f"x{rnd.randrange(10**6)}", *b[at + 1 :]]
            if likeness(a, after) < least:
                break
            b = after
        rows += [(2 * k, " ".join(a)), (2 * k + 1, " ".join(b))]
        want |= {2 * k} if likeness(a, b) >= 0.8 else {2 * k, 2 * k + 1}
    hub = [f"h{j}" for j in range(300)]
    for k in range(40):  # one large group: its members are at 0.93 or more to each other
        rows.append((1000 + k, " ".join([*hub[: 6 * k], f"y{k}", *hub[6 * k + 1 :]])))
    assert {r.doc_id for r in simhash.kept(frame(spark, rows), 0.8).collect()} == want | {1000}


def test_simhash_blocks(spark):
    rnd = random.Random(2)
    fps = list({0x0F0F0F0F0F0F0F0F ^ sum(1 << b for b in rnd.sample(range(16), 2)) for _ in range(60)} | {rnd.getrandbits(63) for _ in range(60)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    parts = lambda links: sorted(map(tuple, components(links).collect()))
    assert parts(simhash.links(df, block=8)) == parts(simhash.links(df))


@pytest.mark.parametrize("total", [10, 10**5, 10**8])
def test_plan_is_lossless(total):
    rnd = np.random.default_rng(0)
    sample = rnd.integers(0, 2**63, 500).astype(np.uint64)
    plan = simhash.plan(sample, total)
    masks = [(sum(1 << b for b in p), t) for p, t in plan]
    for _ in range(2000):
        diff = sum(1 << int(b) for b in rnd.choice(64, rnd.integers(0, 5), replace=False))
        assert any((diff & m).bit_count() <= t for m, t in masks)


def test_components(spark):
    rnd = random.Random(7)
    links = [(k, k + 1) for k in range(100)] + [(1000, 1000 + k) for k in range(1, 60)] + [(rnd.randrange(2000, 2080), rnd.randrange(2000, 2080)) for _ in range(40)] + [(5000, 5000), (0, 1)]
    root = {x: x for e in links for x in e}
    for _ in range(200):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = dict(map(tuple, components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert got == {k: v for k, v in root.items() if k != 5000 and any(k in e and e[0] != e[1] for e in links)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_warc(spark, tmp_path):
    trap = "x" * 300 + "\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 5\r\n\r\nabc"
    rows = [(i, "http://h/\n", h) for i, h in enumerate([trap * 40, trap, "WARC/1.1\r\n" * 300, None, "", "WARC/1.1\r\nContent-Length: 100000\r\n\r\n" + "y" * 900, "é" * 600, "é" * 600, "é" * 600, "s", "s", "WARC/1.1\r\n" * 3000])]
    rows += [(None, None, "q" * 1200), (None, "u", "q" * 1200), (77, "u", "q" * 1200), (500, "u", "z" * 999), (501, "u", "z" * 999), (502, "u", "w" * 1000), (502, "u", "w" * 1000)]
    last = {}
    for i, _, h in rows:
        b = (h or "").encode()
        if len(b) >= 1000:
            last[b] = max([x for x in (last.get(b), i) if x is not None], default=None)
    want = []
    for i, _, h in rows:
        b = (h or "").encode()
        again = b in last and last[b] is not None and i != last[b]
        want.append((i, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", last[b] if again else None))
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        for size in ("4k", "16m"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            spark.conf.set("spark.sql.files.openCostInBytes", "1k")
            pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("size", F.lit("clash")).repartition(2)
            assert sorted(map(tuple, warc.digest(pages).collect()), key=str) == sorted(want, key=str)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved[0])
        spark.conf.set("spark.sql.files.openCostInBytes", saved[1])
    assert warc.digest(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_warc_payloads_and_cut_files(spark, tmp_path):
    path = str(tmp_path / "w")
    warc.write(warc.records(spark.createDataFrame([(1, "http://x/WARC/1.1\r\n", "päge"), (2, "u", "")], "page_id long, url string, html string").coalesce(1)), path)
    got = {r.payload.decode() for r in warc.read(spark, path).collect()}
    assert got == {"päge", ""}
    part = next(p for p in (tmp_path / "w").iterdir() if p.suffix == ".txt" and p.stat().st_size)
    whole = part.read_bytes()
    for folder in ("cut", "old", "zip", "other"):
        (tmp_path / folder).mkdir()
    (tmp_path / "cut" / "a.warc").write_bytes(whole[:-6])
    assert warc.read(spark, str(tmp_path / "cut")).count() == 1
    (tmp_path / "old" / "a.warc").write_bytes(whole.replace(b"WARC/1.1\r\nWARC-Type", b"WARC/1.0\r\nWARC-Type"))
    assert {r.payload.decode() for r in warc.read(spark, str(tmp_path / "old")).collect()} == got
    records = [b"WARC/1." + r for r in whole.split(b"WARC/1.") if r.startswith(b"1\r\nWARC-Type")]
    (tmp_path / "zip" / "a.warc.gz").write_bytes(gzip.compress(whole[: len(whole) // 2]) + gzip.compress(whole[len(whole) // 2 :]))
    assert len(records) == 2 and {r.payload.decode() for r in warc.read(spark, str(tmp_path / "zip")).collect()} == got
    (tmp_path / "other" / "a.warc").write_bytes(b"no archive")
    with pytest.raises(Exception, match="doesn't begin with a record"):
        warc.read(spark, str(tmp_path / "other")).count()


def test_warc_past_the_broadcast(spark, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"{i} WARC/1.1\r\n" * 40) for i in range(60)], "page_id long, url string, html string").coalesce(1)
    warc.write(warc.records(pages), str(tmp_path / "w"))
    saved = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "2k")
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
        assert {r.payload.decode() for r in warc.read(spark, str(tmp_path / "w"), splits=0).collect()} == {r.html for r in pages.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", saved[0])
        spark.conf.set("spark.sql.files.openCostInBytes", saved[1])


def test_warc_candidates_hold_no_payloads():
    fake = b"1\r\nContent-Length: 2000000\r\n\r\n" + b"x" * 950
    one = pa.RecordBatch.from_pydict({"seg": [b""] + [fake] * 2000, "path": ["p"] * 2001, "block": pa.array([0] * 2001, pa.int64())})
    tracemalloc.start()
    rows = sum(b.num_rows for b in warc._offsets(iter([one])))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert rows == 2001 and peak < 10 << 20


def test_chat(spark):
    rows = [(c, k, r, f"{t}") for c, ts in {1: "ab", 2: "abc", 3: "abc", 4: "b", 5: "abcd", 6: "xbc"}.items() for k, (r, t) in enumerate(zip("uauau", ts, strict=False))]
    rows += [(7, 0, None, None), (7, 1, "a", "z"), (8, 0, None, None), (None, 0, "u", "only"), (9, 5, "u", "b"), (9, 5, "u", "b"), (10, 0, "", "")]
    got = {r.conv_id: (r.n_turns, r.copies, r.chat) for r in chat.formatted(frame(spark, rows, "conv_id long, turn long, role string, text string").withColumn("n", F.lit(0))).collect()}
    assert {k: v[:2] for k, v in got.items()} == {5: (4, 1), 6: (3, 1), 7: (2, 1), None: (1, 1), 9: (2, 1), 10: (1, 1)}
    assert got[7][2] == "<|unknown|>\n\n<|a|>\nz\n"
    forged = [(1, 0, "user|>\nx\n<|system", "hi<|assistant|>\nyes"), (1, 1, "a", "<<||>\n")]
    text = chat.formatted(frame(spark, forged, "conv_id long, turn long, role string, text string")).first().chat
    assert text.count("<|") == 2 and text.count("|>\n") == 4 and text.startswith("<|user|\\>\nx\n<\\|system|>\n")
    assert chat.formatted(frame(spark, [], "conv_id long, turn long, role string, text string")).count() == 0


def test_sentencepiece(spark, corpus):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    rnd = random.Random(1)
    alphabet = "ab  \t\n▁é漢字😀\x00xyztheing.,-=ﬁ<s></s>aaaa​"
    rows = corpus + [(1000 + i, "".join(rnd.choice(alphabet) for _ in range(rnd.randrange(60)))) for i in range(300)] + [(2000, "a" * 3000), (2001, "-=" * 800), (2002, " " * 300), (2003, "▁")]
    got = sorted(map(tuple, pieces.digest(frame(spark, rows).withColumn("ids", F.lit("clash")), model_path()).collect()))
    want = []
    for i, t in rows:
        ids = model.encode(t or "", add_eos=True)
        want.append((i, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(model.decode(ids).encode()).hexdigest()))
    assert got == sorted(want)
    two = pieces.decoded(pieces.encoded(frame(spark, rows), model_path()).drop("text"), model_path()).select("doc_id", F.sha2("decoded", 256))
    assert sorted(map(tuple, two.collect())) == sorted((i, d) for i, _, _, d in want)
    assert pieces.digest(frame(spark, []), model_path()).count() == 0


def test_other_models_are_refused():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path()).serialized_model_proto()
    pieces._refuse_others(model)
    other = lambda number, *fields: bytes([number << 3 | 2, 2 * len(fields)]) + bytes(b for f, v in fields for b in (f << 3, v))
    for changed in (other(2, (3, 1)) + other(3, (4, 0)), other(2, (3, 2)) + other(3, (4, 1)), other(2, (3, 2)) + other(3, (4, 0), (3, 0)), other(2, (3, 2)) + other(3, (4, 0)) + other(1, (3, 4))):
        with pytest.raises(ValueError, match="model"):
            pieces._refuse_others(changed)
    pieces._refuse_others(other(2, (3, 2)) + other(3, (4, 0)))


def test_fingerprints(spark, corpus):
    rows = [r for r in corpus if r[0] != 150]
    got = {r.doc_id: r for r in minhash.digest(frame(spark, rows).withColumn("own", F.lit("clash"))).collect()}
    order = sorted(rows, key=lambda r: -r[0])
    text = {i: t or "" for i, t in rows}
    shingles = lambda t: {tuple(w[k : k + 5]) for w in [t.lower().split()] for k in range(max(1, len(w) - 4))} if t.split() else set()
    gaps = []
    for k, (i, _) in enumerate(order):
        t, after = text[i], text[order[(k + 1) % len(order)][0]]
        cut = len(t) // 3
        edited = t[: len(t) - cut] + after[:cut]
        r = got[i]
        assert r.n_chars == len(t) and r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        for value, other in ((r.near_edited, edited), (r.near_next, after)):
            a, b = shingles(t), shingles(other)
            gaps.append(abs(value - (len(a & b) / len(a | b) if a | b else 1.0)))
    assert max(gaps) < 0.3 and sum(gaps) / len(gaps) < 0.05
    assert got[100].fingerprint == got[0].fingerprint and got[300].fingerprint == "0" * 256
    assert minhash.digest(frame(spark, [])).count() == 0
    assert minhash.digest(frame(spark, [(7, "a b c d e f")])).first().near_next == 1.0


def test_fingerprints_are_those_of_a_plain_version(spark, corpus):
    """One permutation: the least hash of each bin; an empty bin takes the first filled one of its probes."""
    rows = frame(spark, corpus).select("doc_id", minhash.shingle_hashes(F.col("text")).alias("h"), minhash.slots(F.col("text")).alias("slots"))
    for r in rows.collect():
        least = {}
        for v in r.h:
            b = (v >> 57) + 64
            least[b] = min(least.get(b, v), v)
        want = []
        for b in range(128):
            t, at = 0, b
            while least and at not in least:
                t += 1
                at = int.from_bytes(hashlib.blake2b(f"{b}.{t}".encode(), digest_size=4).digest(), "little") % 128
            want.append((least[at] >> 8) & 255 if least else 0)
        assert r.slots == want


@pytest.mark.parametrize("ids", [list(range(300)), [3**k % 2**62 for k in range(300)], [None] * 100 + [7] * 100 + [k * 10**15 for k in range(100)]])
def test_successors(spark, ids):
    rows = [(i, f"text {k // 3} " * 20) for k, i in enumerate(ids)]
    docs = frame(spark, rows).repartition(3)
    both, order, guest = minhash.successors(docs.withColumn("group", F.lit("clash")), 2000)
    got = both.withColumn("next_id", F.lead("doc_id").over(order)).withColumn("next", F.lead("text").over(order)).where(~F.col(guest)).select("doc_id", "text", "next_id", "next").collect()
    links = Counter(((r.doc_id, r.text), (r.next_id, r.next)) for r in got)
    tie = {r.text: r.h for r in docs.select("text", F.xxhash64("text").alias("h")).distinct().collect()}
    line = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, tie[r[1]]), reverse=True)
    assert links == Counter(zip(line, line[1:] + line[:1], strict=True))
    plan = both.withColumn("next", F.lead("text").over(order))._jdf.queryExecution().toString()
    assert "SinglePartition" not in plan


def test_quality(spark):
    rnd = random.Random(9)
    good = lambda: " ".join(rnd.choice(["the", "of", "reader", "sees", "words", "and", "then", "more."]) + rnd.choice(["", "", "s", "ly"]) for _ in range(80))
    junk = lambda: " ".join(rnd.choice(["buy", "now", "xx"]) + rnd.choice(["%%%", "###", "|"]) for _ in range(80))
    rows = [(i, good() if i % 3 else junk()) for i in range(400)] + [(900, None), (901, "")]
    marks = [(i, int(i % 3 > 0), 0) for i in range(0, 400, 2)] + [(0, 0, 0), (5000, 1, 0), (None, 1, 0), (7, None, 0)]
    docs, labels = frame(spark, rows).withColumn("score", F.lit("clash")), frame(spark, marks, "doc_id long, quality int, toxic int")
    got = quality.digest(docs, labels).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    import zlib

    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    own = [(r.predicted, int(r.doc_id % 3 > 0)) for r in got if r.held_out and r.doc_id < 400]
    assert sum(a == b for a, b in own) / len(own) > 0.95
    assert {r.predicted for r in quality.digest(docs, labels.where("false")).collect()} == {1}
    assert quality.digest(docs.where("false"), labels).count() == 0
    many = docs.unionByName(docs.where("doc_id = 4").join(spark.range(3000).select(), how="cross"))
    repeated = [r.predicted for r in quality.digest(many, labels).collect()]
    assert 0 < sum(r == 0 for r in repeated) < 300  # a positive repeated 3,000 times pushes nothing out
    clash = docs.withColumn("_score", F.lit(1)).withColumn("x", F.lit(2))
    assert quality.kept(clash, labels).columns == clash.columns
    other = labels.withColumn("quality", F.when(F.col("quality") == 1, 1))  # label 0 isn't used
    assert {(r.doc_id, round(r.score, 6)) for r in quality.digest(docs, labels).collect()} == {(r.doc_id, round(r.score, 6)) for r in quality.digest(docs, other).collect()}


def test_risk_by_a_plain_version():
    """The fit is near the least non-negative risk that plain gradient descent finds, and the prior near the true one."""
    rnd = np.random.default_rng(3)
    for true in (0.3, 0.8):
        draw = lambda n, at: np.column_stack([rnd.normal(at, 1, n), rnd.normal(0, 1, (n, len(quality.FIGURES) - 1))])
        p, u = draw(3000, 3.0), np.concatenate([draw(int(6000 * true), 3.0), draw(int(6000 * (1 - true)), -3.0)])
        model = quality.learn(p, lambda body: sum(body(x) for x in np.array_split(u, 7)))
        assert abs(model.prior - true) < 0.06
        zp, zu, prior = model.inputs(p), model.inputs(u), model.prior

        def risk(w):
            rest = np.logaddexp(0, zu @ w).mean() - prior * np.logaddexp(0, zp @ w).mean()
            return prior * np.logaddexp(0, -zp @ w).mean() + max(0, rest) + quality.RIDGE / 2 * w @ w

        w = np.zeros(zp.shape[1])
        for _ in range(3000):
            rest = np.logaddexp(0, zu @ w).mean() - prior * np.logaddexp(0, zp @ w).mean()
            g_rest = quality._s(zu @ w) @ zu / len(zu) - prior * quality._s(zp @ w) @ zp / len(zp)
            g = -g_rest if rest < 0 else -prior * (1 - quality._s(zp @ w)) @ zp / len(zp) + g_rest
            w = w - 0.05 * (g + quality.RIDGE * w)
        assert risk(model.weights) <= risk(w) + 1e-2
        found = model.score(u) >= quality.CUT
        assert abs(found.mean() - true) < 0.02 and found[: int(6000 * true)].mean() > 0.9


def test_figures_of_other_scripts():
    latin, greek = quality.figures("The quick, brown fox. " * 20), quality.figures("Ἡ ταχεῖα, καφετιὰ ἀλεπού. " * 20)
    assert abs(latin[0] - greek[0]) < 0.03 and greek[1] == 0.0 and greek[9] > 0
    assert quality.figures("你好世界。" * 30)[1] < 0.25 and quality.figures("नमस्ते दुनिया " * 9)[1] == 0.0


def test_mixing(spark):
    rnd = random.Random(4)
    size = lambda s: rnd.randrange(50, 400) if s != "b" else rnd.randrange(5, 20)
    rows = [(i, " ".join(["w"] * size(s)), s) for i, s in enumerate(rnd.choices(["a", "b", "ü", None, "c", "hot", "hot", "hot"], k=900))]
    rows += [(2000, None, "a"), (2001, " \n", "a"), (2002, None, "empty"), (2005, "same id", "a"), (2005, "same id", "a")]
    docs = frame(spark, rows, "doc_id long, text string, source string").withColumn("rank", F.lit(0))
    got = mixing.mix(docs).collect()
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(map(tuple, again), key=str) and len(got) == len(rows)
    sizes = defaultdict(int)
    for _, t, s in rows:
        sizes[s] += len((t or "").split())
    names = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    left, target = 1.5 * sum(sizes.values()), {}
    while True:  # the excess over twice the size is shared anew
        free = [s for s in names if s not in target]
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 2 * sizes[s]]
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
    taken = defaultdict(int)
    for r in got:
        assert r.size == len((dict((i, t) for i, t, _ in rows if i == r.doc_id)[r.doc_id] or "").split()) and 0 <= r.taken <= 2 * r.size
        assert r.source_size == sizes[r.source] and abs(r.target - target[r.source]) < 1e-6
        taken[r.source] += r.taken
    assert all(abs(taken[s] - target[s]) <= 4 * mixing.BLOCK for s in names)
    assert mixing.mix(docs.where("false")).count() == 0
    out = mixing.rendered(docs)
    assert out.columns == docs.columns and out.where("doc_id = 2000").count() == 0


def test_mixing_reaches_small_targets(spark):
    sizes = {"big": 60000} | {f"s{n}-{k}": n for n in (1, 40, 130, 300) for k in range(15)}
    rows = [(k, " ".join(["w"] * min(40, size - at)), s) for k, (s, size, at) in enumerate((s, size, at) for s, size in sizes.items() for at in range(0, size, 40))]
    docs = frame(spark, rows, "doc_id long, text string, source string")
    taken, target = defaultdict(int), {}
    for r in mixing.mix(docs).collect():
        taken[r.source] += r.taken
        target[r.source] = r.target
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-6 for s in sizes)
    goals = spark.createDataFrame([(s, t, k) for k, (s, t) in enumerate(sorted(target.items()))], "source string, target double, place long")
    slots = mixing.schedule(spark, goals).collect()
    assert len({r.slot for r in slots}) == len(slots)
    for s in sizes:
        own = sorted((r.rank, r.words) for r in slots if r.sid == f"s{s}")
        assert [k for k, _ in own] == list(range(len(own))) and all(w == mixing.BLOCK for _, w in own[:-1])
    # the schedule by a plain version: the source of each golden-ratio point, in turn
    ends, total, want = [], 0.0, []
    for _, t in sorted(target.items()):
        total += t
        ends.append(total)
    names, left = sorted(target), {s: round(t) for s, t in target.items()}
    for k in range(math.ceil(total / mixing.BLOCK)):
        point = (k * mixing.GOLDEN) % 2**32 / 2**32 * total
        s = names[next(i for i, e in enumerate(ends) if point < e)]
        if left[s] > 0:
            want.append((k, s, min(left[s], mixing.BLOCK)))
            left[s] -= mixing.BLOCK
    assert [(r.slot, r.sid[1:], r.words) for r in sorted(slots) if r.slot < math.ceil(total / mixing.BLOCK)] == want


def test_mix_in_order_by_a_plain_version(spark):
    rnd = random.Random(13)
    rows = [(i, " ".join(f"d{i}w{k}" for k in range(rnd.randrange(0, 90))), rnd.choice(["a", "b", None])) for i in range(60)] + [(7, "twin a b", "a"), (7, "twin a b", "a"), (None, "x y", "b")]
    docs = frame(spark, rows, "doc_id long, text string, source string").withColumn("size", F.lit("clash")).withColumn("_sid", F.lit("clash"))
    sized = {s: [r for r in mixing._places(mixing.sizes(docs)).orderBy("bucket", "mixed", "doc_id", "size", "start").collect() if r.source == s] for s in ("a", "b", None)}
    taken, order = mixing.mix(docs, block=16).collect(), mixing.ordered(docs, block=16).collect()
    target = {r.source: r.target for r in taken}
    goals = spark.createDataFrame([(s, target[s], k) for k, s in enumerate(("a", "b", None))], "source string, target double, place long")
    slots = {(r.sid, r.rank): r.slot for r in mixing.schedule(spark, goals, 16).collect()}
    want, words = Counter(), Counter()
    for s, own in sized.items():
        assert [r.start for r in own] == [sum(x.size for x in own[:k]) for k in range(len(own))]
        line = [(r.doc_id, r.source, k) for r in own for k in range(r.size)]
        for k in range(round(target[s])):
            d, source, at = line[k % len(line)]
            want[slots["" if s is None else f"s{s}", k // 16], d, source, at] += 1
            words[d, s] += 1
    got = Counter((r.slot, r.doc_id, r.source, r.first + k) for r in order for k in range(r.words))
    assert got == want
    found = Counter()
    for r in taken:
        found[r.doc_id, r.source] += r.taken
    assert {k: v for k, v in found.items() if v} == words
    out = mixing.rendered(docs.withColumn("_times", F.lit(1)).withColumn("_row", F.lit(2)).withColumn("_key", F.lit(3)))
    assert out.columns == [*docs.columns, "_times", "_row", "_key"] and {(r["_times"], r["_row"], r["_key"]) for r in out.collect()} == {(1, 2, 3)}

