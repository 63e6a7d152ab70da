"""Exact BM25 top-k: inverted indexes by shard with block-max WAND pruning, merged with global statistics."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from pathlib import Path
from types import SimpleNamespace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD_GAP, ascii_lower, stored, words

K1, B = 1.2, 0.75
#: Bytes of text and rows of a shard, about (a word has a byte and a gap), and documents of a block of it.
SHARD, SHARD_ROWS, BLOCK = 16 << 20, 50_000, 128
#: Cells of the sketches by which documents of like words are put into the same blocks.
SKETCH = 128
#: Terms in more than this share of a shard's documents are added up as dense rows, block by block.
DENSE = 1 / 16
#: Most terms of the queries that meet a shard at once, about, and queries scored together.
TERMS_AT_ONCE, QUERIES_AT_ONCE = 500_000, 64
#: Blocks of a query, by falling bound, that are scored in the first wave, and how much longer each next one is.
WAVE, GROWTH = 8, 4
#: Slack for sums in single precision; what is found is scored anew in double precision.
SLACK = 1e-4
#: One of LATER shards is searched first, for floors.
LATER = 8
#: Setting of how many rows are sent to Python at once.
AT_ONCE = "spark.sql.execution.arrow.maxRecordsPerBatch"

_FOUND = "key long, doc_id long, score double"
_INDEX = "shard int, n long, words long, ids binary, lengths binary, terms binary, starts binary, docs binary, tfs binary, same binary"
_SEALED = f"{_INDEX}, average double, entries binary, blocks binary, firsts binary, most binary"
_BUFFERS = ("ids", "lengths", "terms", "starts", "docs", "tfs", "same", "entries", "blocks", "firsts", "most")
_BLOCKS = "keys binary, ends binary, terms binary, weights binary, floors binary"


def _stored_singly(df: DataFrame, name: str) -> DataFrame:
    """`stored`; while it is written a batch to Python is one row, as a row of a shard has megabytes and batches of many fill the memory on both sides."""
    conf = df.sparkSession.conf
    was = conf.get(AT_ONCE, None)
    conf.set(AT_ONCE, "1")
    try:
        return stored(df, name)
    finally:
        conf.unset(AT_ONCE) if was is None else conf.set(AT_ONCE, was)


def terms_of(text: Column) -> Column:
    """Hashes of the words of a text, in order; words are runs of digits, a-z and characters beyond ASCII."""
    return F.transform(words(ascii_lower(text), WORD_GAP), lambda w: F.xxhash64(w))


def build(docs: DataFrame, text: str = "text", shard: int = SHARD) -> tuple[DataFrame, int, float]:
    """The index, one row per shard, with the count of all rows and their mean length in words.

    A shard has postings by term, which rows are copies of which, and, for each term, the greatest impact in every block of
    documents. Rows are dealt to shards evenly whatever their ids, in shards of bounded text. Rows of equal words share
    their postings. Null texts are empty; they are counted, but found by no query.
    """
    size = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()
    count = max(1, -(-size["bytes"] // shard), -(-size["n"] // SHARD_ROWS))
    rows = docs.select(F.coalesce("doc_id", F.lit(-(2**63))).cast("long").alias("doc_id"), terms_of(F.col(text)).alias("terms"))
    rows = rows.select(F.pmod(F.xxhash64("doc_id", F.monotonically_increasing_id()), F.lit(count)).cast("int").alias("shard"), "doc_id", "terms")
    open_ = stored(rows.repartitionById(count, F.col("shard")).mapInPandas(_shards, _INDEX), "postings")
    total = open_.agg(F.sum("n").alias("n"), F.sum("words").alias("words")).first()
    n = total["n"] or 0
    average = max((total["words"] or 0) / max(n, 1), 1e-9)
    sealed = open_.withColumn("average", F.lit(average)).mapInPandas(_sealed, _SEALED)
    return _stored_singly(sealed, "index"), n, average


def _shards(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """A partition is a shard."""
    if got := [f for f in frames if len(f)]:
        yield _built(pd.concat(got))


def _built(rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("doc_id", kind="stable")
    ids = rows["doc_id"].to_numpy(dtype=np.int64)
    texts = [np.asarray(t, dtype=np.int64) for t in rows["terms"]]
    first: dict[bytes, int] = {}
    same = np.array([first.setdefault(np.sort(t).tobytes(), len(first)) for t in texts], np.int32)
    unique = [texts[i] for i in np.unique(same, return_index=True)[1]]
    lengths = np.array([len(t) for t in unique], np.int64)
    flat = np.concatenate(unique) if unique else np.empty(0, np.int64)
    del texts, unique
    terms, own = np.unique(flat, return_inverse=True)
    own = own.astype(np.int32)
    del flat
    doc = np.repeat(np.arange(len(lengths), dtype=np.int32), lengths)
    # documents of like words and length stand together, which makes block maxima tight
    place = np.empty(len(lengths), np.int64)
    place[np.lexsort((lengths, _kinds(doc, own, terms, len(lengths))))] = np.arange(len(lengths))
    key = own.astype(np.int64)
    key *= max(len(lengths), 1)
    key += place[doc]
    del own, doc
    key, tf = np.unique(key, return_counts=True)
    at, docs = np.divmod(key, max(len(lengths), 1))
    starts = np.searchsorted(at, np.arange(len(terms) + 1))
    ordered = np.empty(len(lengths), np.int64)
    ordered[place] = lengths
    return pd.DataFrame([{
        "shard": int(rows["shard"].iloc[0]), "n": len(ids), "words": int(lengths[same].sum()), "ids": ids.tobytes(), "lengths": ordered.tobytes(), "terms": terms.tobytes(),
        "starts": starts.astype(np.int32).tobytes(), "docs": docs.astype(_small(len(lengths))).tobytes(), "tfs": tf.astype(_small(tf.max(initial=0) + 1)).tobytes(), "same": place[same].astype(np.int32).tobytes(),
    }])


def _kinds(doc: np.ndarray, own: np.ndarray, terms: np.ndarray, count: int) -> np.ndarray:
    """A number for each document, equal for documents of like words: the nearest of a centre for each block, by words of weight in SKETCH cells."""
    if not count:
        return np.empty(0, int)
    weight = np.log(1 + count / np.maximum(np.bincount(own, minlength=len(terms)), 1)) * np.where(terms & 1, 1.0, -1.0)
    cell = ((terms >> 1) % SKETCH).astype(np.int32)
    sketch = np.bincount(doc * np.int64(SKETCH) + cell[own], weights=weight[own], minlength=count * SKETCH).reshape(count, SKETCH).astype(np.float32)
    sketch /= np.maximum(np.sqrt((sketch**2).sum(axis=1, keepdims=True)), 1e-9)
    centres = sketch[:: max(1, count * 2 // (3 * max(1, count // BLOCK)))]
    for _ in range(3):
        kind = (sketch @ centres.T).argmax(axis=1)
        order = np.argsort(kind, kind="stable")
        at = np.unique(kind[order], return_index=True)[1]
        centres = np.add.reduceat(sketch[order], at, axis=0)
        centres /= np.maximum(np.sqrt((centres**2).sum(axis=1, keepdims=True)), 1e-9)
    return (sketch @ centres.T).argmax(axis=1)


def _small(count: int) -> type:
    return np.uint8 if count <= 2**8 else np.uint16 if count <= 2**16 else np.int32


def _postings(row) -> tuple[np.ndarray, np.ndarray]:
    """Documents and counts of a shard's postings, of whichever width they were written in."""
    n = max(int(np.frombuffer(row.starts, np.int32)[-1]), 1)
    return tuple(np.frombuffer(x, {1: np.uint8, 2: np.uint16}.get(len(x) // n, np.int32)).astype(np.int32) for x in (row.docs, row.tfs))


def _norms(row) -> np.ndarray:
    """What the length of each of a shard's documents puts into the divisor of its scores."""
    return K1 * (1 - B + B * np.frombuffer(row.lengths, np.int64) / row.average)


def _impact(tf: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """What postings add to a score for a weight of one."""
    return tf * (K1 + 1) / (tf + norm)


def _sealed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Adds the entries: the runs of a term's postings in one block, with the greatest impact of each, rounded up."""
    for frame in frames:
        for row in frame.itertuples(index=False):
            docs, tf = _postings(row)
            impact = _impact(tf, _norms(row)[docs])
            starts, blocks = np.frombuffer(row.starts, np.int32), docs // BLOCK
            edge = np.ones(len(docs), bool)
            edge[1:] = blocks[1:] != blocks[:-1]
            edge[starts[:-1]] = True
            entries = np.flatnonzero(edge)
            most = np.maximum.reduceat(impact, entries) if len(entries) else impact
            yield pd.DataFrame([row._asdict() | {
                "entries": np.diff(np.append(entries, len(docs))).astype(np.uint8).tobytes(), "blocks": blocks[entries].astype(np.uint16).tobytes(),
                "firsts": np.searchsorted(entries, starts).astype(np.int32).tobytes(), "most": np.nextafter(most.astype(np.float32), np.float32(np.inf)).tobytes(),
            }])


def _frequencies(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Shards -> (term, df): in how many of the shard's rows, copies included, a term is."""
    for frame in frames:
        for row in frame.itertuples():
            copies = np.bincount(np.frombuffer(row.same, np.int32), minlength=len(row.lengths) // 8)
            terms, starts = np.frombuffer(row.terms, np.int64), np.frombuffer(row.starts, np.int32)
            sums = np.concatenate([[0], np.cumsum(copies[_postings(row)[0]])])
            df = sums[starts[1:]] - sums[starts[:-1]]
            for i in range(0, len(terms), 50_000):
                yield pd.DataFrame({"term": terms[i : i + 50_000], "df": df[i : i + 50_000]})


class Shard:
    """One shard's index, ready for search. `scored` of the `met` pairs of a query and a block were looked into."""

    def __init__(self, row):
        self.ids, self.same = np.frombuffer(row.ids, np.int64), np.frombuffer(row.same, np.int32)
        self.terms, self.starts = np.frombuffer(row.terms, np.int64), np.frombuffer(row.starts, np.int32).astype(np.int64)
        self.docs, tf = _postings(row)
        self.norm = _norms(row)
        self.impact = _impact(tf, self.norm[self.docs]).astype(np.float32)
        self.column = (self.docs % BLOCK).astype(np.uint8)
        self.entries, self.firsts = np.concatenate([[0], np.cumsum(np.frombuffer(row.entries, np.uint8), dtype=np.int64)]), np.frombuffer(row.firsts, np.int32).astype(np.int64)
        self.of, self.most = np.frombuffer(row.blocks, np.uint16).astype(np.int32), np.frombuffer(row.most, np.float32)
        self.n = len(row.lengths) // 8
        self.blocks = -(-self.n // BLOCK)
        self.met = self.scored = 0
        df = np.diff(self.starts)
        often = np.flatnonzero(df > self.n * DENSE)
        self.slot = np.full(len(self.terms), -1)
        self.slot[often] = np.arange(len(often))
        self.dense = np.zeros((self.blocks * BLOCK, len(often)), np.float32)
        self.peaks = np.zeros((self.blocks, len(often)), np.float32)
        for k, t in enumerate(often):
            a, b = self.starts[t : t + 2]
            self.dense[self.docs[a:b], k] = self.impact[a:b]
            a, b = self.firsts[t : t + 2]
            self.peaks[self.of[a:b], k] = self.most[a:b]
        order = np.argsort(self.docs.astype(np.uint16), kind="stable") if self.n <= 2**16 else np.argsort(self.docs, kind="stable")
        self.doc_starts = np.concatenate([[0], np.cumsum(np.bincount(self.docs, minlength=self.n))])
        self.own_terms, self.own_tf = np.repeat(np.arange(len(self.terms), dtype=np.int32), df)[order], tf[order]
        self.rows = np.argsort(self.same, kind="stable")
        self.row_starts = np.searchsorted(self.same[self.rows], np.arange(self.n + 1))

    def search(self, queries: list[tuple[int, np.ndarray, np.ndarray]], k: int, floors: np.ndarray) -> Iterator[tuple[int, list[tuple[float, int]]]]:
        """The k best rows of each query (key, terms, weights) of those that reach its floor, exactly.

        The sum of its terms' block maxima bounds every block of a query. Blocks are taken in waves by falling bound, and
        the k-th best score so far is the bar: a block whose bound is below it is passed over with all its postings. In a
        block that is looked into, the postings of the rarer terms are added first; with the block maxima of the frequent terms
        they bound it anew before the frequent terms are added. What reaches the bar is scored in double precision.
        """
        count = len(queries)
        of = np.repeat(np.arange(count), [len(t) for _, t, _ in queries])
        terms, ws = np.concatenate([t for _, t, _ in queries]), np.concatenate([w for _, _, w in queries])
        at = np.searchsorted(self.terms, terms)
        hit = at < len(self.terms)
        hit[hit] = self.terms[at[hit]] == terms[hit]
        of, at, ws = of[hit], at[hit], ws[hit]
        edges = np.searchsorted(of, np.arange(count + 1))
        often = self.slot[at]
        weight = np.zeros((count, self.dense.shape[1]), np.float32)
        weight[of[often >= 0], often[often >= 0]] = ws[often >= 0]
        rare = often < 0
        entry, size = _ranges(self.firsts[at[rare]], self.firsts[at[rare] + 1])
        query, load = np.repeat(of[rare].astype(np.int32), size), np.repeat(ws[rare].astype(np.float32), size)
        cell = query * self.blocks + self.of[entry]
        frequent = weight @ self.peaks.T
        bound = np.bincount(cell, weights=self.most[entry] * load, minlength=count * self.blocks).reshape(count, self.blocks) + frequent
        bound *= 1 + SLACK
        by_bound = np.argsort(-bound, axis=1)
        bar = floors * (1 - SLACK)
        pools: list[list[tuple[np.ndarray, np.ndarray]]] = [[] for _ in queries]
        kept = [np.empty(0)] * count
        copies = np.minimum(np.diff(self.row_starts), k)
        rows = np.arange(count)[:, None]
        often_added = None  # where most blocks have to be looked into, one product for all is faster than one for each block
        if ((bound >= bar[:, None]) & (bound > 0)).mean() > 0.5:
            often_added = (weight @ self.dense.T).reshape(count, self.blocks, BLOCK)
        self.met += count * self.blocks
        low, high = 0, WAVE
        while low < self.blocks:
            wave = by_bound[:, low:high]
            good = (bound[rows, wave] >= bar[:, None]) & (bound[rows, wave] > 0)
            low, high = high, high * GROWTH
            if not good.any():
                break
            qs, bs = np.nonzero(good)[0], wave[good]
            self.scored += len(qs)
            pair = np.full(count * self.blocks, -1, np.int32)
            pair[qs * self.blocks + bs] = np.arange(len(qs), dtype=np.int32)
            mine = pair[cell]
            live = np.flatnonzero(mine >= 0)
            place, width = _ranges(self.entries.take(entry[live]), self.entries.take(entry[live] + 1))
            inner = np.repeat(mine[live].astype(np.int64) * BLOCK, width)
            inner += self.column.take(place)
            added = np.repeat(load[live].astype(float), width)
            added *= self.impact.take(place)
            score = np.bincount(inner, weights=added, minlength=len(qs) * BLOCK).astype(float, copy=False).reshape(-1, BLOCK)
            still = np.flatnonzero((score.max(axis=1) + frequent[qs, bs]) * (1 + SLACK) >= bar[qs])
            still = still[np.argsort(bs[still], kind="stable")]
            if often_added is not None:
                score[still] += often_added[qs[still], bs[still]]
            for part in np.split(still, np.flatnonzero(np.diff(bs[still])) + 1):
                if len(part) and often_added is None:
                    block = slice(bs[part[0]] * BLOCK, (bs[part[0]] + 1) * BLOCK)
                    score[part] += weight[qs[part]] @ self.dense[block].T
            still = np.sort(still)
            hot, column = np.nonzero((score[still] >= bar[qs[still], None]) & (score[still] > 0))
            values, docs, whose = score[still[hot], column], bs[still[hot]] * BLOCK + column, qs[still[hot]]
            parts = np.searchsorted(whose, np.arange(count + 1))
            for q in np.flatnonzero(np.diff(parts)):
                d, v = docs[parts[q] : parts[q + 1]], values[parts[q] : parts[q + 1]]
                pools[q].append((d, v))
                best = np.concatenate([kept[q], np.repeat(v, copies[d])])
                if len(best) >= k:
                    best = -np.partition(-best, k - 1)[:k]
                    bar[q] = max(bar[q], best[k - 1] * (1 - SLACK))
                kept[q] = best
        whole = np.zeros(len(self.terms))
        for q, (key, _, _) in enumerate(queries):
            good = np.concatenate([d[v >= bar[q]] for d, v in pools[q]]) if pools[q] else np.empty(0, int)
            if not len(good):
                yield key, []
                continue
            good.sort()
            own_at = at[edges[q] : edges[q + 1]]
            whole[own_at] = ws[edges[q] : edges[q + 1]]
            own, size = _ranges(self.doc_starts[good], self.doc_starts[good + 1])
            ahead = np.cumsum(size) - size
            exact = np.add.reduceat(whole[self.own_terms[own]] * _impact(self.own_tf[own], np.repeat(self.norm[good], size)), ahead)  # in the order of the terms: equal texts get equal sums
            found = [(-float(s), int(self.ids[r])) for s, d in zip(exact, good, strict=True) for r in self.rows[self.row_starts[d] : self.row_starts[d + 1]][:k]]
            whole[own_at] = 0
            yield key, sorted(found)[:k]


def _ranges(first: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges one after the other, and the size of each."""
    size = after - first
    out = np.repeat(first - (np.cumsum(size) - size), size)
    out += np.arange(len(out))
    return out, size


def _packed(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Queries (key, terms, weights, floor) -> blocks of about TERMS_AT_ONCE terms, a row each."""
    held, size = [], 0

    def row() -> pd.DataFrame:
        terms, weights = [np.asarray(r.terms, np.int64) for r in held], [np.asarray(r.weights, float) for r in held]
        return pd.DataFrame([{
            "keys": np.array([r.key for r in held], np.int64).tobytes(), "ends": np.cumsum([len(t) for t in terms]).astype(np.int64).tobytes(),
            "terms": np.concatenate(terms).tobytes(), "weights": np.concatenate(weights).tobytes(), "floors": np.array([r.floor for r in held], float).tobytes(),
        }])

    for frame in frames:
        for r in frame.itertuples(index=False):
            held.append(r)
            size += len(r.terms)
            if size >= TERMS_AT_ONCE:
                yield row()
                held, size = [], 0
    if held:
        yield row()


def _one_thread() -> None:
    """Spark's tasks are the parallelism: threads of matrix products beside them would only wait for each other."""
    for path in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads"):
            if hasattr(library, name):
                getattr(library, name)(1)


def _searcher(k: int):
    """A mapInArrow body over rows of a shard and a block of queries; the batch's own memory is read, not copied."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = shard = None
        _one_thread()
        for batch in batches:
            for i in range(batch.num_rows):
                value = lambda name, batch=batch, i=i: batch.column(name)[i]
                if value("shard").as_py() != number:
                    number = value("shard").as_py()
                    row = {name: value(name).as_buffer() for name in _BUFFERS}
                    shard = Shard(SimpleNamespace(average=value("average").as_py(), **row))
                array = lambda name, kind: np.frombuffer(value(name).as_buffer(), kind)  # noqa: B023, E731
                keys, ends, floors = array("keys", np.int64).tolist(), array("ends", np.int64)[:-1], array("floors", float)
                asked = list(zip(keys, np.split(array("q_terms", np.int64), ends), np.split(array("weights", float), ends), strict=True))
                for at in range(0, len(asked) if shard.n else 0, QUERIES_AT_ONCE):
                    part = slice(at, at + QUERIES_AT_ONCE)
                    got = [(key, d, -s) for key, rows in shard.search(asked[part], k, floors[part]) for s, d in rows]
                    columns = zip(*got, strict=True) if got else ((), (), ())
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()), strict=True)], names=["key", "doc_id", "score"])

    return run


def _searched(index: DataFrame, queries: DataFrame, k: int, parts: int) -> DataFrame:
    """Every shard meets every block of the query set; neither is shuffled or sent to the driver: tasks read both from the shared folder."""
    blocks = stored(queries.coalesce(parts).mapInPandas(_packed, _BLOCKS), "blocks").withColumnRenamed("terms", "q_terms")
    return index.crossJoin(blocks.hint("shuffle_replicate_nl")).mapInArrow(_searcher(k), _FOUND)


def top_k(docs: DataFrame, queries: DataFrame, k: int = 10, text: str = "text", query_id: str = "query_id", query: str = "query", shard: int = SHARD) -> DataFrame:
    """query_id, rank (from 1), doc_id, score: the k documents of highest BM25 score for each query, and no others.

    Scores use the document frequencies, count and mean length of all documents; a query's repeated words count as often.
    Equal scores go by doc_id. Documents that share no word with a query aren't found; queries without words, null or
    empty, find nothing. Equal queries are searched once. Terms are told apart by 64-bit hashes. The stated query set goes over the
    shards in blocks of about TERMS_AT_ONCE terms. One of LATER shards is searched first: the k-th best there is a floor for the others,
    which then give little more than what counts. No rows give no rows. A null doc_id counts as the smallest.
    """
    index, n, _ = build(docs, text, shard)
    asked = queries.select(F.col(query_id).alias("query_id"), F.array_sort(terms_of(F.col(query))).alias("terms")).where(F.size("terms") > 0)
    asked = asked.select("query_id", F.xxhash64("terms").alias("key"), "terms")
    names = stored(asked.select("query_id", "key"), "names")
    counts = asked.dropDuplicates(["key"]).select("key", F.explode("terms").alias("term")).groupBy("key", "term").agg(F.count("*").alias("tf"))
    df = index.select("lengths", "terms", "starts", "docs", "tfs", "same").mapInPandas(_frequencies, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    idf = F.log(1 + (F.lit(float(n)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = counts.join(df, "term").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("term", (F.col("tf") * idf).alias("weight")))).alias("t"))
    ready = _stored_singly(weighed.select("key", F.col("t.term").alias("terms"), F.col("t.weight").alias("weights")), "queries")
    parts = max(1, -(-(ready.agg(F.sum(F.size("terms")).alias("s")).first()["s"] or 0) // TERMS_AT_ONCE))
    early = _stored_singly(_searched(index.where(F.col("shard") % LATER == 0), ready.withColumn("floor", F.lit(0.0)), k, parts), "early")
    floors = early.groupBy("key").agg(F.sort_array(F.collect_list("score"), asc=False).alias("s")).select("key", F.get("s", F.lit(k - 1)).alias("floor"))
    floored = ready.join(floors, "key", "left").withColumn("floor", F.coalesce("floor", F.lit(0.0)))
    found = early.unionByName(_stored_singly(_searched(index.where(F.col("shard") % LATER != 0), floored, k, parts), "late"))
    rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "doc_id"))
    best = found.withColumn("rank", rank).where(F.col("rank") <= k)
    return names.join(best, "key").select("query_id", "rank", F.when(F.col("doc_id") != -(2**63), F.col("doc_id")).alias("doc_id"), "score")


def digest(docs: DataFrame) -> DataFrame:
    """Every document whose id is divisible by 50 is a query, with its whole text, against all documents."""
    return top_k(docs, docs.where("doc_id % 50 = 0").select(F.col("doc_id").alias("query_id"), F.col("text").alias("query")))
