"""Periodic run detection: online dyadic square catching over completed power-of-two blocks."""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free

#: Periods that a run must hold, at least, and its least length in words.
EXPONENT, LEAST = 4, 6
#: Base of the rolling hash (odd, so that it has an inverse modulo 2**64).
_BASE = 0x9E3779B97F4A7C15
_RUN = "start long, length long, period long"


def _powers(base: int) -> list[np.ndarray]:
    return [np.cumprod(np.array([1] + [b] * 1023, np.uint64)) for b in (base, pow(base, -1, 1 << 64))]


_POWERS = _powers(_BASE)


def _powers_to(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, 0 to n at least."""
    while len(_POWERS[0]) <= n:
        for k, p in enumerate(_POWERS):
            _POWERS[k] = np.concatenate([p, p * (p[-1:] * p[1:2])])
    return _POWERS


def _agree(a: np.ndarray, b: np.ndarray) -> int:
    """How many first values of two arrays of one length are equal."""
    done, step = 0, 64
    while done < len(a):
        other = np.flatnonzero(a[done : done + step] != b[done : done + step])
        if len(other):
            return done + int(other[0])
        done, step = done + step, step * 4
    return len(a)


class Catchers:
    """The runs of a text that grows word by word, or by many words at a time.

    For each power of two b the completed blocks of b words are catchers: the block at s catches squares of half-length p, from 2b
    up to 4b (1 up to 4 for b = 1), by meeting itself again at s + p. Every square of such a half-length holds a whole block, a run
    of more periods a row of them, each met again at the same p. Such a row begins a suffix comparison: to the left as far as
    it goes, to the right as far as there are words; one that reaches the last word stays open and goes on with each appended word.
    So squares merge into runs. Blocks meet by rolling hashes, and every run is compared word by word, so a clash of
    hashes costs time but changes nothing. Of one stretch the
    smallest period counts; a square inside a known run whose period divides its half-length is the run's own. Each level
    does work in proportion to the words appended, so n words take n log n.
    """

    def __init__(self, exponent: int = EXPONENT, least: int = LEAST):
        if exponent < 3:
            raise ValueError("runs of fewer than three periods may nest; the exponent must be 3 at least")
        self.exponent, self.least, self.n = exponent, least, 0
        self._words, self._sums = np.empty(0, np.int64), np.zeros(1, np.uint64)
        self._owner, self._span = np.empty(0, np.int64), np.empty(0, np.int64)  # the longest known run at a word, and its length when found
        self._rows: dict[int, int] = defaultdict(int)
        self._found: list[list[int]] = []  # start, end, period
        self._starts: set[tuple[int, int]] = set()
        self._open: list[int] = []
        self._looked = 0

    def append(self, ids: np.ndarray, last: bool = False) -> None:
        """Takes the next words, equal ones by equal numbers. With `last`, blocks that aren't complete are looked at as they are."""
        ids = np.asarray(ids, np.int64)
        self._grow(ids)
        self._advance()
        b = 1
        while self.exponent * max(1, 2 * b * (b > 1)) <= self.n:
            self._catch(b, last)
            b *= 2
        self._looked = self.n if last else -1

    def runs(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of the runs so far, by start, then period."""
        if self._looked != self.n:
            self.append(np.empty(0, np.int64), last=True)
        smallest = {(a, e): q for a, e, q in sorted(self._found, key=lambda r: -r[2])}
        return sorted((a, e - a, q) for (a, e), q in smallest.items() if e - a >= max(self.least, self.exponent * q))

    def _grow(self, ids: np.ndarray) -> None:
        old, self.n = self.n, self.n + len(ids)
        if self.n > len(self._words):
            room = max(self.n, 2 * len(self._words)) if old else self.n
            for name, fill in (("_words", 0), ("_owner", -1), ("_span", 0), ("_sums", 0)):
                was = getattr(self, name)
                now = np.full(room + (name == "_sums"), fill, was.dtype)
                now[: len(was)] = was
                setattr(self, name, now)
        self._words[old : self.n] = ids
        v = (ids + 1).astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9)
        v = (v ^ (v >> np.uint64(31))) * np.uint64(0x94D049BB133111EB)
        self._sums[old + 1 : self.n + 1] = self._sums[old] + np.cumsum((v ^ (v >> np.uint64(29))) * _powers_to(self.n)[0][old : self.n])

    def _advance(self) -> None:
        """Open runs go on to the right with the appended words."""
        still = []
        for r in self._open:
            start, end, q = self._found[r]
            more = _agree(self._words[end : self.n], self._words[end - q : self.n - q])
            self._owner[end : end + more], self._span[end : end + more] = r, end + more - start
            self._found[r][1] = end + more
            if end + more == self.n:
                still.append(r)
        self._open = still

    def _catch(self, b: int, last: bool) -> None:
        """The words of level b since the last completed block: which blocks are met again, in rows long enough for a run."""
        ks = (1, 2, 3) if b == 1 else (2, 3)
        need = [max(self.least, self.exponent * k) - k if b == 1 else (self.exponent - 1) * k - 1 for k in ks]
        rows = (self.n - b + 1) // b
        upto = -(-(self.n - b + 1) // b) if last else rows
        lo = max(0, self._rows[b] - max(need) + 1)
        if upto <= self._rows[b] or upto <= lo:
            return
        self._rows[b] = rows
        first = max(0, lo - max(ks))
        start, end = first * b, min(upto * b, self.n - b + 1)
        hashes = (self._sums[start + b : end + b] - self._sums[start:end]) * _powers_to(self.n)[1][start:end]
        table = np.zeros((upto - first) * b, np.uint64)
        table[: len(hashes)] = hashes
        table = table.reshape(-1, b)
        for k, m in zip(ks, need, strict=True):
            low = max(lo, k) - first
            if len(table) - low < m or low < k:
                continue
            met, width = table[low:] == table[low - k : -k, :1], 1
            while width < m:
                step = min(width, m - width)
                met, width = met[:-step] & met[step:], width + step
            if met.any():
                met[1:] &= ~met[:-1]
                for row, r in np.argwhere(met).tolist():
                    self._compare((first + low + row - k) * b, k * b + r, b)

    def _compare(self, s: int, p: int, b: int) -> None:
        """The longest stretch of period p around the square caught at s; kept if it is a run, or may become one."""
        known = self._owner[s]
        if known >= 0 and p % self._found[known][2] == 0 and self._found[known][1] >= s + p + b:
            return
        t = self._words
        a = s - _agree(t[:s][::-1], t[p : s + p][::-1])
        e = s + p + _agree(t[s + p : self.n], t[s : self.n - p])
        if e < s + p + b or (a, p) in self._starts or (e - a < max(self.least, self.exponent * p) and e < self.n):
            return
        r = len(self._found)
        self._starts.add((a, p))
        self._found.append([a, e, p])
        longer = self._span[a:e] < e - a
        self._owner[a:e][longer], self._span[a:e][longer] = r, e - a
        if e == self.n:
            self._open.append(r)


def runs_of(text: str | None, exponent: int = EXPONENT, least: int = LEAST) -> tuple[list[tuple[int, int, int]], str]:
    """The runs of the whole text's words, and the words that no run repeats, joined by one space."""
    ws = (text or "").encode().split()  # of bytes: exactly at space and \t to \r
    if len(ws) < least:
        return [], b" ".join(ws).decode()
    numbers = dict(zip(dict.fromkeys(ws), count(), strict=False))
    caught = Catchers(exponent, least)
    if len(numbers) < len(ws):
        caught.append(np.fromiter(map(numbers.__getitem__, ws), np.int64, len(ws)), last=True)
    found = caught.runs()
    if found:
        keep = np.ones(len(ws), bool)
        for a, n, q in found:
            keep[a + q : a + n] = False
        ws = [w for w, k in zip(ws, keep.tolist(), strict=True) if k]
    return found, b" ".join(ws).decode()


def detected(docs: DataFrame, text: str = "text", to: tuple[str, str] = ("runs", "collapsed"), exponent: int = EXPONENT, least: int = LEAST) -> DataFrame:
    """The rows with all runs of the whole text (array of start, length, period, by start, then period) and the collapsed text.

    Words are `[^\\x20\\x09-\\x0D]+`, numbered from 0; of every run the words after its first period are left out of the collapsed
    text. Null: empty text; no words: no runs and an empty text. Rows are independent (repeated ones get equal results), no rows
    give no rows. A text is one row's work: n words take n log n time, and memory in proportion to n. The new columns replace
    columns of those names.
    """

    @F.pandas_udf("runs array<array<long>>, collapsed string")
    def run(texts: pd.Series) -> pd.DataFrame:
        got = [runs_of(t, exponent, least) for t in texts]
        return pd.DataFrame({"runs": [[list(r) for r in g[0]] for g in got], "collapsed": [g[1] for g in got]})

    once = run.asNondeterministic()  # called once for a text, however many columns come from it
    (told,) = free(docs.columns, "told")
    found = F.transform(F.col(f"{told}.runs"), lambda r: F.struct(*[r[i].alias(c.split()[0]) for i, c in enumerate(_RUN.split(", "))]))
    return docs.withColumn(told, once(F.col(text))).withColumns({to[0]: found, to[1]: F.col(f"{told}.collapsed")}).drop(told)


def planted(doc_id: str | None, text: str | None) -> str | None:
    """The text of the query: for a tenth of the ids, by CRC-32 of their digits, the words from one on repeat with a period."""
    h = zlib.crc32((doc_id or "").encode())
    if doc_id is None or h % 10 or not (ws := (text or "").encode().split()):
        return text
    g, n = h // 10, len(ws)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return b" ".join(ws[:a] + [ws[a + i % p] for i in range(n - a)]).decode()


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256, by the query's contract.

    The texts of a tenth of the ids (not null) get a planted period first.
    """

    @F.pandas_udf("string")
    def plant(ids: pd.Series, texts: pd.Series) -> pd.Series:
        return pd.Series([planted(i, t) for i, t in zip(ids, texts, strict=True)], dtype=object)

    found = detected(docs.select("doc_id", plant(F.col("doc_id").cast("string"), F.col("text")).alias("text")))
    none = F.lit(None).cast(f"struct<{_RUN.replace(' ', ':')}>".replace(",:", ","))
    more = lambda b, r: F.when(b.isNull() | (r["length"] * b["period"] > b["length"] * r["period"]), r).otherwise(b)
    lines = F.transform("runs", lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n")))
    return found.withColumn("best", F.reduce("runs", none, more)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
