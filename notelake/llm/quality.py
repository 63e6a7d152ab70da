"""Quality classifier by positive-unlabelled learning: non-negative unbiased risk with an estimated class prior."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free, stored

#: Most trusted positives that a fit takes, by hash of the id. The unlabelled part of the risk is over all documents.
POSITIVES = 8_000
#: Score at which a document is taken as good.
CUT = 0.7
#: Of every FOLDS remainders of the id's CRC-32, HELD is never learnt from.
FOLDS, HELD = 4, 2
#: Weight of the squared weights in the risk, and most passes over the unlabelled figures for one minimum.
RIDGE, PASSES = 1e-3, 15
#: Thresholds at which shares of positives and of unlabelled texts are compared, and the confidence of the bound on each.
BINS, DELTA = 400, 0.1


def _kind(point: int) -> tuple[int, bool, bool]:
    """Class of a code point (0 letter, mark or digit, 1 white space, 2 full stop or comma, 3 other sign); is it upper case; a digit?"""
    c = chr(point)
    kind = 1 if c.isspace() else 0 if unicodedata.category(c)[0] in "LNM" else 2 if c in ".," else 3
    return kind, c.isupper(), c.isdigit()


_NEAR = 0x300
_KIND, _UPPER, _DIGIT = (np.array(column, dtype) for column, dtype in zip(zip(*map(_kind, range(_NEAR)), strict=True), (np.uint8, bool, bool), strict=True))
_far = lru_cache(100_000)(_kind)
#: Figures of a text; each counts with its value and, beyond, how far it is from the usual.
FIGURES = ("signs", "odd_signs", "stops", "distinct", "repeats", "word_length", "lines", "ends", "single", "upper", "digits", "alphabet")


def figures(text: str | None) -> list[float]:
    """FIGURES of the whole text, letters of every script alike; an empty or null text gives zeros."""
    if not text or text.isspace():
        return [0.0] * len(FIGURES)
    points = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    kind, upper, digit = (t[np.minimum(points, _NEAR - 1)] for t in (_KIND, _UPPER, _DIGIT))
    alphabet = np.count_nonzero(np.bincount(points[points < _NEAR], minlength=1))
    far = np.flatnonzero(points >= _NEAR)
    if len(far):
        unique, at = np.unique(points[far], return_inverse=True)
        kind[far], upper[far], digit[far] = (np.array(v)[at] for v in zip(*[_far(int(p)) for p in unique], strict=True))
        alphabet += len(unique)
    c, ws = len(points), text.split()
    n = max(len(ws), 1)
    count = np.bincount(kind, minlength=4)
    gap = kind == 1
    closed = np.append(gap[1:], True)
    opened = np.insert(gap[:-1], 0, True)
    repeats = sum(a == b for a, b in zip(ws, ws[1:], strict=False))
    return [
        (count[2] + count[3]) / c,
        count[3] / c,
        count[2] / c,
        len(set(ws)) / n**0.8,
        repeats / n,
        (c - count[1]) / n,
        text.count("\n") / n,
        float(((kind >= 2) & closed).sum() / n),
        float((~gap & opened & closed).sum() / n),
        float(upper.sum() / c),
        float(digit.sum() / c),
        float(alphabet / np.log(c + 2)),
    ]


@dataclass
class Model:
    """A linear margin over standardised figures; a text of margin 0, as likely good as not, scores CUT. No weights: every score is 1."""

    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray | None = None
    prior: float = 1.0

    def inputs(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.centre) / self.scale, -8, 8)
        return np.column_stack([z, np.maximum(np.abs(z) - 2, 0), np.ones(len(z))])

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.inputs(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.weights is None:
            return np.ones(len(x))
        return 1 / (1 + np.exp(-np.clip(self.margin(x) + np.log(CUT / (1 - CUT)), -50, 50)))


#: The sum of a function of figures (rows to a vector) over all unlabelled texts.
Sums = Callable[[Callable[[np.ndarray], np.ndarray]], np.ndarray]


def _s(m: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(m, -50, 50)))


def _moments(z: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Count, logistic loss of taking rows for positive, its gradient and its Hessian, as one vector of sums."""
    m = z @ w
    s = _s(m)
    return np.concatenate([[len(z), np.logaddexp(0, m).sum()], s @ z, ((z * (s * (1 - s))[:, None]).T @ z).reshape(-1)])


def _minimum(model: Model, sums: Sums, share: float, own: Callable[[np.ndarray], tuple[float, np.ndarray, np.ndarray]], rest: Callable[[np.ndarray, float], float]) -> np.ndarray:
    """Newton's minimum of share * (loss of the unlabelled texts as negatives) + own(weights) + ridge.

    A step that doesn't lower this, or that takes `rest` (of the weights and the unlabelled loss) below zero, is halved.
    """
    size = 2 * len(model.centre) + 1
    w, best, least, step = np.zeros(size), np.zeros(size), np.inf, np.zeros(size)
    for _ in range(PASSES):
        v = sums(lambda x, w=w: _moments(model.inputs(x), w))
        n = max(v[0], 1)
        f, g, h = own(w)
        value = share * v[1] / n + f + RIDGE / 2 * w @ w
        if value > least + 1e-12 or rest(w, v[1] / n) < 0:
            step = step / 2
            if np.abs(step).max() < 1e-3:
                break
        else:
            best, least = w, value
            slope = share * v[2 : size + 2] / n + g + RIDGE * w
            step = -np.linalg.solve(share * v[size + 2 :].reshape(size, size) / n + h + RIDGE * np.eye(size), slope)
            if -slope @ step < 1e-8:
                break
        w = best + step
    return best


def class_prior(held: np.ndarray, above: Callable[[np.ndarray], np.ndarray], total: float) -> float:
    """Share of positives among unlabelled texts: the best bin's ratio.

    Among the texts above a margin, positives are as frequent as among the positives `held` out of the fit, if no negative is there.
    So the share of unlabelled texts above it over that of positives bounds the prior; the threshold of the least upper
    confidence bound is taken. above(thresholds) counts the unlabelled texts at or above each.
    """
    cuts = np.unique(np.quantile(held, np.linspace(0, 1, BINS)))
    q_p = np.array([(held >= c).mean() for c in cuts])
    q_u = above(cuts) / max(total, 1)
    width = sum(np.sqrt(np.log(4 / DELTA) / (2 * n)) for n in (len(held), max(total, 1)))
    best = np.argmin(q_u / q_p + 1.01 * width / q_p)
    return float(np.clip(q_u[best] / q_p[best], 0.01, 0.99))


def learn(positive: np.ndarray, sums: Sums) -> Model:
    """Minimise the non-negative unbiased risk over trusted positives and all unlabelled texts.

    First half of the positives are told from unlabelled texts; by that margin of the other half the prior is estimated. Then
    prior * R+(positive) + R-(unlabelled) - prior * R-(positive) is minimised with the logistic loss, its last two parts being
    kept from falling below zero. Its margin is above 0 where, under that prior, a text is likelier good than not.
    """
    width = len(FIGURES)
    total = sums(lambda x: np.array([float(len(x))]))[0]
    if len(positive) < 4 or not total:
        return Model(np.zeros(width), np.ones(width))
    centre = np.median(positive, axis=0)
    spread = np.quantile(np.abs(positive - centre), 0.9, axis=0)
    model = Model(centre, np.where(spread > 1e-9, spread, 1e-3))
    p = model.inputs(positive)
    half = p[::2]

    def against(w: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        s = _s(-half @ w)
        return np.logaddexp(0, -half @ w).mean() / 2, -(s @ half) / len(half) / 2, (half * (s * (1 - s))[:, None]).T @ half / len(half) / 2

    model.weights = _minimum(model, sums, 0.5, against, lambda w, u: 0.0)

    def above(cuts: np.ndarray) -> np.ndarray:
        counts = sums(lambda x: np.bincount(np.searchsorted(cuts, model.margin(x), side="right"), minlength=len(cuts) + 1).astype(float))
        return counts[1:][::-1].cumsum()[::-1]

    prior = model.prior = class_prior(p[1::2] @ model.weights, above, total)
    mean, none = p.mean(axis=0), np.zeros((p.shape[1],) * 2)
    # with the logistic loss, R+(positive) - R-(positive) is the mean margin
    model.weights = _minimum(model, sums, 1.0, lambda w: (-prior * mean @ w, -prior * mean, none), lambda w, u: u - prior * np.logaddexp(0, p @ w).mean())
    return model


def figured(docs: DataFrame, to: str = "x") -> DataFrame:
    """The rows with the figures of the whole text in column `to`."""

    @F.pandas_udf("array<double>")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([figures(t) for t in texts])

    return docs.withColumn(to, run(F.col("text")))


def held_out() -> Column:
    """Is the row of the fold that is never learnt from? A null id is not."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == HELD, F.lit(False))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=float).reshape(-1, len(FIGURES))


def _summed(rows: DataFrame) -> Sums:
    """Sums over all rows (x): of each partition a vector, added up by place; only the sum comes to the driver."""

    def sums(body: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = None
            for f in frames:
                if len(f):
                    v = body(_matrix(f["x"]))
                    total = v if total is None else total + v
            if total is not None:
                yield pd.DataFrame({"i": np.arange(len(total), dtype=np.int32), "v": total})

        out = body(np.zeros((0, len(FIGURES)))).astype(float)
        for r in rows.select("x").mapInPandas(part, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect():
            out[r["i"]] = r["v"]
        return out

    return sums


def fit(rows: DataFrame, labels: DataFrame, positives: int = POSITIVES) -> Model:
    """Learn from stored figures (doc_id, x) of documents and the label 1 of the folds but HELD; other labels aren't used.

    Positives are bounded by the parameter, smallest hash of the id first, one row for each id however often it is repeated.
    All documents of those folds are the unlabelled texts; equal figures count once, so that groups of copies, which may hold
    most rows, don't stand for the rest. Contradicting labels of an id count as 1.
    """
    marks = labels.where(F.col("quality") == 1).select("doc_id").where(F.col("doc_id").isNotNull() & ~held_out()).distinct()
    picked = marks.orderBy(F.xxhash64("doc_id", F.lit("fit")), "doc_id").limit(positives)  # bounded by the parameter
    got = rows.join(F.broadcast(picked), "doc_id").groupBy("doc_id").agg(F.min("x").alias("x")).toPandas().sort_values("doc_id")
    unlabelled = stored(rows.where(~held_out()).select("x").distinct(), "unlabelled")
    return learn(np.unique(_matrix(got["x"]), axis=0), _summed(unlabelled))


def _scores(model: Model) -> Callable[[Column], Column]:
    @F.pandas_udf("double")
    def run(x: pd.Series) -> pd.Series:
        return pd.Series(model.score(_matrix(x)))

    return run


def scored(docs: DataFrame, model: Model, to: str = "score") -> DataFrame:
    """The rows with the score of the whole text (0 to 1) in column `to`; nothing but the text counts. Null: empty text."""

    @F.pandas_udf("double")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([figures(t) for t in texts]).reshape(-1, len(FIGURES))))

    return docs.withColumn(to, run(F.col("text")))


def digest(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every row."""
    rows = stored(figured(docs.select("doc_id", "text")).select("doc_id", "x"), "figures")
    out = rows.select("doc_id", held_out().alias("held_out"), _scores(fit(rows, labels))(F.col("x")).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def kept(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier doesn't reject, with their columns."""
    (score,) = free(docs.columns, "score")
    rows = stored(figured(docs.select("doc_id", "text")).select("doc_id", "x"), "figures")
    return scored(docs, fit(rows, labels), score).where(F.col(score) >= CUT).drop(score)
