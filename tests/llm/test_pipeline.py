"""The pipeline on a small corpus: each stage against a plain version over what its predecessor kept, and run() against the stages."""

import hashlib
import random
from collections import Counter

import corpus_pipeline
import pytest
from notelake.llm import mixing
from notelake.llm.queries import model_path
from pyspark.sql import functions as F

CLASHES = ("_id", "_doc", "_own", "_row", "_times", "_drops", "_score", "Size", "key")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", *CLASHES]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
PLAIN = ["river", "stone", "keeps", "slowly", "under", "bridge", "morning", "people", "walk", "then", "house", "garden", "light", "falls", "never", "again"]


def sentence(rnd, n=12):
    return " ".join(rnd.choice(PLAIN) + rnd.choice(["", "s", "ly", "er"]) + str(rnd.randrange(50)) * (rnd.random() < 0.1) for _ in range(n)).capitalize() + "."


@pytest.fixture(scope="module")
def corpus(tmp_path_factory, spark):
    rnd = random.Random(21)
    clean = [(i, "\n "[i % 2].join(sentence(rnd) for _ in range(rnd.randrange(4, 32)))) for i in range(260)]
    junk = [(1000 + i, " ".join(rnd.choice(["$$", "buy!!", "%%%", "#1", "|||"]) for _ in range(rnd.randrange(30, 90)))) for i in range(60)]
    shared = "This very line of shared boilerplate stands in many documents of the corpus."
    repeated = [(2000 + i, f"{sentence(rnd)}\n{shared}\n{sentence(rnd)}\n{sentence(rnd)}") for i in range(20)]
    copies = [(3000 + i, clean[0][1]) for i in range(10)]
    words = " ".join(sentence(rnd) for _ in range(30)).split()
    near = [(4000 + i, " ".join(words[: 15 * i] + [f"changed{i}"] + words[15 * i + 1 :])) for i in range(8)]
    odd = [(5000, None), (5001, ""), (5002, " \n\t"), (None, sentence(rnd) + " " + sentence(rnd)), (None, sentence(rnd) + " other " + sentence(rnd)), (7, sentence(rnd, 30)), (5003, " ".join(sentence(rnd) for _ in range(1500)))]
    rows = [(d, t, "en", ["a", "b", None][k % 3], len(t or ""), *["clash"] * len(CLASHES)) for k, (d, t) in enumerate(clean + junk + repeated + copies + near + odd)]
    folder = str(tmp_path_factory.mktemp("sf"))
    spark.createDataFrame(rows, SCHEMA).repartition(3).write.parquet(f"{folder}/documents.parquet")
    marks = [(d, int(d < 1000), 0) for k, (d, _) in enumerate(clean + junk) if k % 3]
    spark.createDataFrame(marks, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_stages(spark, corpus, tmp_path):
    docs = [spark.read.parquet(f"{corpus}/documents.parquet")]
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs[-1], corpus).write.parquet(str(tmp_path / str(k)))
        docs.append(spark.read.parquet(str(tmp_path / str(k))))
    got = [d.collect() for d in docs]
    for d in docs[1:-1]:
        assert d.columns == COLUMNS
    for rows in got[1:-1]:
        assert all(r[c] == "clash" for r in rows for c in CLASHES)
    text = lambda rows: Counter((r.doc_id, r.text) for r in rows)

    # quality: junk goes, clean documents stay, nothing is changed
    assert not text(got[1]) - text(got[0])
    kept = {r.doc_id for r in got[1]}
    assert sum(i in kept for i in range(1000, 1060)) <= 3 and sum(i in kept for i in range(260)) >= 250

    # lines: in the order of ids only the first of equal lines stays, near ones aside; n_chars is counted anew
    order = sorted(got[1], key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    left = {(r.doc_id, r.text) for r in got[2]}
    assert all(r.n_chars == len(r.text) for r in got[2] if r.text is not None)
    lines = Counter(" ".join(x.split()) for r in got[2] if r.text for x in r.text.split("\n") if x.strip())
    assert max(lines.values()) == 1
    whole = {" ".join(x.split()) for r in order if r.text for x in r.text.split("\n") if x.strip()}
    gone = whole - set(lines)
    near = lambda a, b: abs(len(a) - len(b)) <= 1 and sum(x != y for x, y in zip(a, b, strict=False)) <= 1 or any(a[:k] + a[k + 1 :] == b or b[:k] + b[k + 1 :] == a for k in range(max(len(a), len(b))))
    assert all(any(near(g.split(), w.split()) for w in whole - {g}) for g in gone)
    assert all(t is None or t.strip() for _, t in left)

    # near-duplicates: one of each group of a plain similarity of 0.8 and more
    sets = []
    for r in got[2]:
        ws = (r.text or "").lower().split()
        sets.append({tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4))} if ws else set())
    root = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and len(sets[i] & sets[j]) >= 0.8 * len(sets[i] | sets[j]):
                root = [root[j] if x == root[i] else x for x in root]
    groups = len({x for x, s in zip(root, sets, strict=True) if s})
    stay = [r for r in got[3] if (r.text or "").strip()]
    assert not text(got[3]) - text(got[2]) and len(stay) == groups
    assert sum(4000 <= (r.doc_id or 0) < 5000 for r in stay) == 1

    # mix: whole documents as often as the mix takes their words, rounded
    cols = [F.col(c) for c in docs[3].columns]
    keyed = docs[3].select(F.xxhash64(*cols, *[c.isNull() for c in cols]).alias("hash"), "doc_id", "text", "source")
    times = {r.doc_id: int(r.taken / max(r.size, 1) + 0.5) for r in mixing.mix(keyed.select(F.col("hash").alias("doc_id"), "text", "source")).collect()}
    want = Counter()
    for r in keyed.collect():
        want[r.doc_id, r.text] += times[r.hash]
    assert text(got[4]) == +want

    # tokens: those of the library
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_path())
    ids = Counter()
    for r in got[4]:
        pieces = model.encode(r.text or "", add_eos=True)
        ids[r.doc_id, r.source, len(pieces), tuple(pieces), hashlib.sha256(model.decode(pieces).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.source, r.n_tokens, tuple(r.ids), r.decoded_sha256) for r in got[5]) == ids

    again = corpus_pipeline.run(spark, corpus)
    assert Counter(map(str, again.collect())) == Counter(map(str, got[5]))


def test_empty_tables(spark, corpus, tmp_path):
    spark.read.parquet(f"{corpus}/documents.parquet").where("false").write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{corpus}/labels.parquet").where("false").write.parquet(str(tmp_path / "labels.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_without_labels_all_stay(spark, corpus):
    docs = spark.read.parquet(f"{corpus}/documents.parquet")
    none = spark.read.parquet(f"{corpus}/labels.parquet").where(F.lit(False))
    from notelake.llm import quality

    assert quality.kept(docs, none).count() == docs.count()
