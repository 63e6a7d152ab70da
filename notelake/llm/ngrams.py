"""Language-model scoring by deleted interpolation: n-gram estimates mixed by context-frequency buckets, weights by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import released

#: Longest n-gram.
ORDER = 2
#: Of every FOLDS remainders of the id's CRC-32, HELD is never learnt from; DELETED gives the held-out counts that the weights are learnt from.
FOLDS, HELD, DELETED = 5, 1, 4
#: Characters, about, of a block of documents, and n-grams, about, of a bucket of counts.
BLOCK, KEYS = 4_000_000, 1_000_000
#: Characters, about, whose blocks or buckets are one task's work.
TASK = 8_000_000
#: Tokens that are scored at a time.
CHUNK = 200_000
#: Steps of an octave in which ratios of estimates are told apart while weights are learnt, most rounds of that, and when it ends.
STEPS, ROUNDS, ENOUGH = 4, 500, 1e-7
_ANSWER = "block int, bucket int, kept binary, deleted binary, n_kept long, n_all long, v_kept long, v_all long"
_SCORES = "doc_id {}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


class _Numbers(dict):
    def __missing__(self, word: bytes) -> int:
        got = self[word] = len(self)
        return got


def _mixed(a: np.ndarray) -> np.ndarray:
    a = (a ^ (a >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    a = (a ^ (a >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return a ^ (a >> np.uint64(31))


def _packed(values: np.ndarray) -> bytes:
    """Byte by byte in planes, which lie close when shuffled: high bytes of sorted keys and of small counts are alike."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(-1, 8).T).tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


class Block:
    """The n-grams of some documents.

    Tokens are the words `[^\\x20\\x09-\\x0D]+`, A-Z lower-cased, and one end of each text. `keys` holds the 64-bit hash of each n-gram and
    context once, in order, odd for single tokens; `grams[j - 1]` the place there of the n-gram of length j of each token, `contexts[j - 1]` that of the words ahead.
    """

    def __init__(self, texts: Iterable[str | None], order: int = ORDER):
        numbers, parts = _Numbers({b"": 0, b" ": 1}), []  # an end and a beginning; no words
        pad, end = np.ones(order - 1, np.int32), np.zeros(1, np.int32)
        for text in texts:
            ws = (text or "").encode().lower().split()  # of bytes: exactly A-Z, and exactly at space and \t to \r
            parts += [pad, np.fromiter(map(numbers.__getitem__, ws), np.int32, len(ws)), end]
        sizes = np.array([len(p) for p in parts], np.int64).reshape(-1, 3)
        self.tokens = sizes[:, 1] + 1
        self.doc = np.repeat(np.arange(len(self.tokens)), self.tokens)
        self.first, self.order = np.cumsum(self.tokens) - self.tokens, order
        word = np.concatenate([*parts, end[:0]]).astype(np.int64)
        del parts
        real, n = word != 1, len(numbers)
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, numbers), np.uint64, n)
        key = hashes | np.uint64(1)
        key[1] = hashes[1] & ~np.uint64(1)  # no token's
        keys, grams = [key], [word]
        for j in range(2, order + 1):
            pair = np.where(real, np.concatenate([[0], grams[-1][:-1]]) * n + word, -1)  # whatever is ahead of the text, a context of nothing but that is one
            pair, gram = np.unique(pair, return_inverse=True)
            mixed = _mixed(keys[-1][pair // n] * np.uint64(0x9E3779B97F4A7C15) + hashes[pair % n] * np.uint64(0xC2B2AE3D27D4EB4F) + np.uint64(j))
            begin = _mixed(hashes[1:2] * np.uint64(j))
            keys.append(np.where(pair < 0, begin, mixed) & ~np.uint64(1))
            grams.append(gram)
        every = np.concatenate(keys)
        by = np.argsort(every)
        self.keys, place = every[by], np.empty(len(every), np.int64)
        place[by] = np.arange(len(by))
        starts = np.cumsum([0, *map(len, keys)])
        placed = [place[a + g] for a, g in zip(starts[:-1], grams, strict=True)]
        self.grams = [p[real] for p in placed]
        self.contexts = [np.concatenate([p[:1], p[:-1]])[real] for p in placed[:-1]]

    def counts(self, learnt: np.ndarray) -> np.ndarray:
        """How often each key is in the documents that `learnt` marks; contexts of nothing but a beginning once for each document."""
        mine = np.repeat(learnt, self.tokens)
        total = np.zeros(len(self.keys), np.int64)
        for g in self.grams:
            total += np.bincount(g[mine], minlength=len(total))
        for c in self.contexts:
            total += np.bincount(c[self.first[learnt]], minlength=len(total))
        return total.astype(np.uint64)


@dataclass
class Mixture:
    """Weights of the estimates by bucket of the context, and the numbers of tokens (n) and of distinct ones (v) learnt from."""

    order: int
    n: int
    v: int
    weights: dict[int, np.ndarray]

    def estimates(self, block: Block, counts: np.ndarray, part: slice = slice(None)) -> tuple[np.ndarray, np.ndarray]:
        """(bucket, probabilities by length from 0) of each token of a part, from counts of the block's keys.

        Length 0 gives all known tokens and one unknown the same; longer n-grams their maximum likelihood. The bucket tells the
        longest context that was met, and in octaves how often.
        """
        n = len(block.doc[part])
        p = np.zeros((self.order + 1, n))
        p[0] = 1 / (self.v + 1)
        bucket = np.zeros(n, np.int64)
        for j in range(1, self.order + 1):
            met = counts[block.contexts[j - 2][part]].astype(np.float64) if j > 1 else np.full(n, float(self.n))
            p[j] = np.divide(counts[block.grams[j - 1][part]], met, out=np.zeros(n), where=met > 0)
            bucket = np.where(met > 0, 64 * j + np.frexp(met)[1], bucket)
        return bucket, p

    def of(self, bucket: int) -> np.ndarray:
        """The weights of a bucket; of one without held-out tokens those of the nearest bucket of that length, or equal ones."""
        length = bucket // 64
        near = [b for b in self.weights if b // 64 == length]
        w = self.weights[min(near, key=lambda b: (abs(b - bucket), b))] if near else np.full(length + 1, 1 / (length + 1))
        return np.pad(w, (0, self.order - length))

    def log10(self, block: Block, counts: np.ndarray) -> np.ndarray:
        """log10 of the probability of each token."""
        out = np.empty(len(block.doc))
        for start in range(0, len(out), CHUNK):
            part = slice(start, start + CHUNK)
            bucket, p = self.estimates(block, counts, part)
            told, at = np.unique(bucket, return_inverse=True)
            w = np.array([self.of(int(b)) for b in told])
            out[part] = np.log10(sum(w[at, j] * p[j] for j in range(self.order + 1)))
        return out


def em(events: np.ndarray, ratios: np.ndarray, rounds: int = ROUNDS, enough: float = ENOUGH) -> np.ndarray:
    """Weights that make `events` tokens with these estimates (a row each) likeliest; each estimate counts as having made one more."""
    w = np.full(ratios.shape[1], 1 / ratios.shape[1])
    for _ in range(rounds):
        share = ratios * w
        made = events @ (share / share.sum(axis=1, keepdims=True)) + 1
        w, was = made / made.sum(), w
        if np.abs(w - was).max() < enough:
            break
    return w


def _told(docs: DataFrame, blocks: int, apart: int) -> DataFrame:
    """doc_id, text, fold and block. Documents with held-out counts are in blocks of their own, numbered below 0."""
    fold = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS, F.lit(0)).cast("int")
    mixed = F.xxhash64(F.lit("block"), "doc_id", F.coalesce("text", F.lit("")))
    block = F.when(fold == DELETED, -1 - F.pmod(mixed, F.lit(apart))).otherwise(F.pmod(mixed, F.lit(blocks)))
    return docs.select("doc_id", "text", fold.alias("fold"), block.cast("int").alias("block"))


def _answers(told: DataFrame, order: int, bits: int, tasks: int) -> DataFrame:
    """For each block and bucket of keys how often all kept and all deleted documents hold each of the block's keys, in their order.

    Blocks send each of their keys once, with their own counts; a bucket holds the keys of one stretch of hashes, adds up what the
    blocks sent and answers each. Rows without a block hold the bucket's tokens and distinct tokens.
    """

    def ask(frame: pd.DataFrame) -> pd.DataFrame:
        block, fold = Block(frame["text"], order), frame["fold"].to_numpy()
        kept, deleted = block.counts((fold != HELD) & (fold != DELETED)), block.counts(fold == DELETED)
        at = np.append(np.searchsorted(block.keys, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)) if bits else 0, len(block.keys))
        rows = [(int(frame["block"].iloc[0]), b, *[_packed(a[x:y]) for a in (block.keys, kept, deleted)]) for b, (x, y) in enumerate(zip(at[:-1], at[1:], strict=True)) if y > x]
        return pd.DataFrame(rows, columns=["block", "bucket", "keys", "kept", "deleted"])

    def answer(frame: pd.DataFrame) -> pd.DataFrame:
        asked = [_unpacked(k) for k in frame["keys"]]
        keys, place = np.unique(np.concatenate(asked), return_inverse=True)
        kept, deleted = (np.bincount(place, np.concatenate([_unpacked(c) for c in frame[name]]).astype(np.float64), len(keys)).astype(np.uint64) for name in ("kept", "deleted"))
        one, every = keys % np.uint64(2) == 1, kept + deleted
        ends = np.cumsum([len(a) for a in asked])
        rows = [(b, _packed(kept[place[e - len(a) : e]]), _packed(deleted[place[e - len(a) : e]])) for b, a, e in zip(frame["block"], asked, ends, strict=True)]
        out = pd.DataFrame([*rows, (None, None, None)], columns=["block", "kept", "deleted"])
        out["block"] = out["block"].astype("Int32")
        for name, value in (("n_kept", kept[one].sum()), ("n_all", every[one].sum()), ("v_kept", (kept[one] > 0).sum()), ("v_all", (every[one] > 0).sum())):
            out[name] = pd.array([None] * len(rows) + [int(value)], "Int64")
        out["bucket"] = int(frame["bucket"].iloc[0])
        return out[[c.split()[0] for c in _ANSWER.split(", ")]]

    asked = told.repartition(tasks, "block").groupBy("block").applyInPandas(ask, "block int, bucket int, keys binary, kept binary, deleted binary")
    return released(asked.repartition(tasks, "bucket").groupBy("bucket").applyInPandas(answer, _ANSWER), "ngram-counts")


def _counts(answers: pd.DataFrame, name: str) -> np.ndarray:
    return np.concatenate([_unpacked(a) for a in answers.sort_values("bucket")[name]])


def _learnt(told: DataFrame, answers: DataFrame, start: Mixture) -> dict[int, np.ndarray]:
    """Weights by bucket from all tokens of the deleted documents, under the counts of the kept ones.

    Tokens whose estimates lie in the same steps of an octave, relative to that of length 0, are added up where they are; only these sums come to the
    driver, at most as many as there are buckets and steps.
    """
    names = [f"q{j}" for j in range(1, start.order + 1)]

    def events(docs: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        block = Block(docs["text"], start.order)
        bucket, p = start.estimates(block, _counts(own, "kept"))
        ratio = np.log2(p[1:] / p[0], out=np.full(p[1:].shape, -np.inf), where=p[1:] > 0)
        step = np.where(np.isinf(ratio), -10_000, np.floor(np.maximum(ratio, -2000) * STEPS)).astype(np.int64)
        f = pd.DataFrame({"bucket": bucket, **dict(zip(names, step, strict=True)), "n": 1, **{f"s{j + 1}": np.where(np.isinf(r), 0, r) for j, r in enumerate(ratio)}})
        return f.groupby(["bucket", *names], as_index=False).sum()

    sums = [f"s{j}" for j in range(1, start.order + 1)]
    kind = f"bucket long, {', '.join(f'{q} long' for q in names)}, n long, {', '.join(f'{s} double' for s in sums)}"
    met = told.where("block < 0").groupBy("block").cogroup(answers.where("block < 0").select("block", "bucket", "kept").groupBy("block")).applyInPandas(events, kind)
    cells = met.groupBy("bucket", *names).agg(F.sum("n").alias("n"), *[F.sum(s).alias(s) for s in sums]).toPandas().sort_values(["bucket", *names])
    out = {}
    for bucket, f in cells.groupby("bucket"):
        length = int(bucket) // 64
        ratios = [np.ones(len(f)), *[np.where(f[f"q{j}"] == -10_000, 0.0, 2.0 ** (f[f"s{j}"] / f["n"])) for j in range(1, length + 1)]]
        out[int(bucket)] = em(f["n"].to_numpy(float), np.stack(ratios, axis=1))
    return out


def scored(docs: DataFrame, order: int = ORDER, size: int = BLOCK, keys: int = KEYS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score: log10 probabilities of the whole texts.

    The model mixes estimates of length 0 (all known tokens and an unknown one alike) to `order` with the weights of the context's
    bucket. They are learnt on the tokens of one training fold under the counts of the others, then used with the counts of all
    training folds. The probabilities of all tokens and an unknown one sum to 1 after any context, so scores compare. base_score is
    the unigram model with one half added. Null: empty text, which is one end. A null doc_id is a training document. Repeated
    rows count apart; those of one doc_id and text share a block. No rows give no rows; without training documents every
    probability is 1. Other columns aren't looked at.
    Documents are dealt by hash to blocks of `size` characters; a block is one task's work, and holds a longer text whole.
    """
    total = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    told = _told(docs, max(1, -(-total // size)), max(1, -(-total // (size * FOLDS))))
    bits = max(0, (total * order // 8 // keys).bit_length())
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // TASK))
    answers = _answers(told, order, bits, tasks)
    sums = answers.where("block IS NULL").agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_kept", "n_all", "v_kept", "v_all")]).first()
    weights = _learnt(told, answers, Mixture(order, sums["n_kept"], sums["v_kept"], {}))
    model = Mixture(order, sums["n_all"], sums["v_all"], weights)

    def score(frame: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        block = Block(frame["text"], order)
        counts = _counts(own, "kept") + _counts(own, "deleted")
        c = counts[block.grams[0]]
        by_doc = lambda v: np.bincount(block.doc, v, len(frame))
        base = np.log10((c + 0.5) / (model.n + 0.5 * (model.v + 1)))
        return pd.DataFrame({"doc_id": frame["doc_id"], "held_out": frame["fold"] == HELD, "n_tokens": block.tokens, "n_known": by_doc(c > 0).astype(np.int64), "train_tokens": model.n, "base_score": by_doc(base), "score": by_doc(model.log10(block, counts))})

    own = answers.where("block IS NOT NULL").select("block", "bucket", "kept", "deleted")
    kind = docs.schema["doc_id"].dataType.simpleString()
    return told.repartition(tasks, "block").groupBy("block").cogroup(own.repartition(tasks, "block").groupBy("block")).applyInPandas(score, _SCORES.format(kind))
