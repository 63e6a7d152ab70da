"""SimHash near-duplicates by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import free, small, stored
from .components import components

#: Words of a shingle and the most bits in which linked fingerprints differ.
WIDTH, RADIUS = 4, 4
#: Distinct fingerprints, smallest hash first, that the partitions and thresholds are fitted to. All are searched.
SAMPLE = 2000
#: Rows of a bucket that are compared as they are; those of larger buckets are dealt anew by further bits.
BLOCK = 4096
#: Groups up to this size are compared pair by pair; in larger ones a search tree of links is kept.
PAIRWISE = 12

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, width: int = WIDTH) -> np.ndarray:
    """XXH64 (seed 42) of the shingles in their order; fewer words: one shingle of them all; none: none."""
    ws = (text or "").encode("utf-8", "replace").translate(_LOWER).split()
    if not ws:
        return np.empty(0, "<u8")
    line = b" ".join(ws)
    ends = np.cumsum([len(w) + 1 for w in ws])
    starts = [0, *ends[: max(len(ws) - width, 0)].tolist()]
    stops = (ends[min(width, len(ws)) - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.array([digest(line[a:b], 42) for a, b in zip(starts, stops, strict=True)], dtype="<u8")


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """Signed 64 bits. A bit is 1 if it is set in over half the shingles' XXH64 (seed 42); no words: zero."""
    h = shingles(text, width)
    if not len(h):
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, len(h), 4096):
        counts += np.unpackbits(h[at : at + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, text: str = "text", to: str = "fp", width: int = WIDTH) -> DataFrame:
    """The rows with their fingerprint (long) in column `to`."""

    @F.pandas_udf("long")
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return docs.withColumn(to, run(F.col(text)))


def plan(sample: np.ndarray, total: int, radius: int = RADIUS) -> list[tuple[list[int], int]]:
    """Bits and threshold of each partition, from a sample of the `total` distinct fingerprints.

    With m partitions and thresholds that sum to radius - m + 1, two fingerprints within the radius lie within the threshold
    in one partition at least. Bits that go together are put together. For each m, dynamic programming finds the
    thresholds of least cost: probes, and candidates as estimated on pairs of the sample. A threshold of -1 leaves a
    partition out.
    """
    bits = (sample[:, None] >> np.arange(64, dtype=np.uint64) & np.uint64(1)).astype(np.float64)
    if len(sample) > 2:
        spread = bits.std(axis=0)
        z = (bits - bits.mean(axis=0)) / np.where(spread > 0, spread, 1)
        close = np.abs(z.T @ z) / len(sample)
    else:
        close = np.zeros((64, 64))
    best: tuple[float, list[tuple[list[int], int]]] | None = None
    for m in (2, 3, 4, 5):
        parts = _grouped(close, m)
        costs = [_costs(sample, p, total, radius) for p in parts]
        budget = radius - m + 1
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for cost in costs:
            nxt: dict[int, tuple[float, list[int]]] = {}
            for s, (c, ts) in table.items():
                for t in range(-1, radius + 1):
                    if (have := nxt.get(s + t)) is None or c + cost[t + 1] < have[0]:
                        nxt[s + t] = (c + cost[t + 1], [*ts, t])
            table = nxt
        cost, ts = table[budget]
        if best is None or cost < best[0]:
            best = (cost, [(p, t) for p, t in zip(parts, ts, strict=True) if t >= 0])
    assert best
    return best[1]


def _grouped(close: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits of nearly equal width, each grown from the most connected free bit by mean correlation."""
    free, parts = set(range(64)), []
    for k in range(m):
        width = len(free) // (m - k)
        first = max(free, key=lambda i: (sum(close[i, j] for j in free if j != i), -i))
        part = [first]
        free.remove(first)
        while len(part) < width:
            nxt = max(free, key=lambda i: (close[i, part].mean(), -i))
            part.append(nxt)
            free.remove(nxt)
        parts.append(sorted(part))
    return parts


def _costs(sample: np.ndarray, part: list[int], total: int, radius: int) -> list[float]:
    """Cost of thresholds -1 .. radius: probing rows, and pairs expected within the threshold."""
    mask = np.uint64(sum(1 << b for b in part))
    own, w = sample & mask, len(part)
    near = np.zeros(radius + 1)
    for k in range(1, len(own)):
        near += np.bincount(np.minimum(np.bitwise_count(own[k:] ^ own[:-k]), radius + 1), minlength=radius + 2)[: radius + 1]
    pairs = max(len(own) * (len(own) - 1) / 2, 1)
    out, probes, chance, seen = [0.0], 0, 0.0, 0.0
    for t in range(radius + 1):
        probes += comb(w, t)
        chance += comb(w, t) / 2.0**w
        seen += near[t]
        candidates = max(seen / pairs, chance) * total * total / 2
        out.append(20.0 * total * (probes + 1) + candidates if probes < 50_000 else float("inf"))
    return out


def probes(parts: list[tuple[list[int], int]]):
    """A mapInPandas body: (fp) -> (part, value, fp): each partition's value and, for its threshold, all values near it."""
    masks = [(np.uint64(sum(1 << b for b in p)), [np.uint64(sum(1 << b for b in c)) for k in range(t + 1) for c in combinations(p, k)]) for p, t in parts]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for at in range(0, len(frame), 2000):
                fp = frame["fp"].to_numpy()[at : at + 2000].view(np.uint64)
                for k, (mask, flips) in enumerate(masks):
                    value = (fp & mask)[:, None] ^ np.array(flips, np.uint64)[None, :]
                    yield pd.DataFrame({"part": k, "value": value.reshape(-1).view(np.int64), "fp": np.repeat(fp, len(flips)).view(np.int64)})

    return run


def _linked(keys: np.ndarray, fps: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links among rows of equal key; rows are ordered by key. Small groups give their links, large ones a tree of each part."""
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1], [True]]))
    size = np.diff(edge)
    left, right = [], []
    group = np.repeat(size, size)
    for d in range(1, PAIRWISE):
        i = np.flatnonzero((group[:-d] <= PAIRWISE) & (keys[d:] == keys[:-d])) if len(keys) > d else np.empty(0, int)
        i = i[(np.bitwise_count(fps[i] ^ fps[i + d]) <= radius) & (fps[i] != fps[i + d])]
        left.append(fps[i])
        right.append(fps[i + d])
    for g in np.flatnonzero(size > PAIRWISE):
        rest = np.unique(fps[edge[g] : edge[g + 1]])
        while len(rest):
            ring, rest = [rest[0]], rest[1:]
            while ring and len(rest):
                x = ring.pop()
                near = np.bitwise_count(rest ^ x) <= radius
                if near.any():
                    new = rest[near]
                    left.append(np.full(len(new), x))
                    right.append(new)
                    ring.extend(new)
                    rest = rest[~near]
    empty = np.empty(0, np.uint64)
    return np.concatenate([empty, *left]), np.concatenate([empty, *right])


def linker(radius: int):
    """A mapInPandas body over rows ordered by `key`: (key, fp) -> links (a, b). A group may go on in the next batch."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for frame in frames:
            keys = np.concatenate([keys, frame["key"].to_numpy()])
            fps = np.concatenate([fps, frame["fp"].to_numpy().view(np.uint64)])
            done = int(np.searchsorted(keys, keys[-1])) if (keys[1:] >= keys[:-1]).all() else int(np.flatnonzero(keys != keys[-1])[-1]) + 1
            if done:
                a, b = _linked(keys[:done], fps[:done], radius)
                yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})
                keys, fps = keys[done:], fps[done:]
        if len(keys):
            a, b = _linked(keys, fps, radius)
            yield pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    return run


def deeper(radius: int):
    """A mapInPandas body for large buckets: (key, fp, rest) -> the same rows under radius + 1 keys each.

    Rows of a bucket that are within the radius differ in `radius` of the bits `rest` at most, so of radius + 1 parts of these one
    is equal at least. The key goes on with that part's value, which leaves fewer bits in `rest`.
    """

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for rest, rows in frame.groupby("rest", sort=False):
                bits = [b for b in range(64) if int(rest) >> b & 1]
                for k in range(min(radius + 1, len(bits))):
                    mask = np.array(sum(1 << b for b in bits[k :: radius + 1]), np.uint64)
                    key = (rows["key"].to_numpy().view(np.uint64) + np.uint64(k)) * np.uint64(0x9E3779B97F4A7C15) ^ (rows["fp"].to_numpy().view(np.uint64) & mask)
                    key = (key ^ key >> np.uint64(31)) * np.uint64(0xBF58476D1CE4E5B9)
                    left = np.array(int(rest) % 2**64 & ~int(mask), np.uint64).view(np.int64)
                    yield pd.DataFrame({"key": key.view(np.int64), "fp": rows["fp"].to_numpy(), "rest": left})

    return run


def links(distinct: DataFrame, radius: int = RADIUS, sample: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """Distinct fingerprints (fp) -> links (a, b) whose components are those of all pairs within the radius."""
    total = distinct.count()
    got = distinct.orderBy(F.xxhash64("fp"), "fp").limit(sample).toPandas()["fp"].to_numpy(dtype=np.int64).view(np.uint64)
    parts = plan(got, total, radius)
    rests = F.array(*[F.lit(int(np.array(2**64 - 1 - sum(1 << b for b in p), np.uint64).view(np.int64))) for p, _ in parts])
    keyed = distinct.mapInPandas(probes(parts), "part int, value long, fp long")
    rows = keyed.select(F.xxhash64("part", "value").alias("key"), "fp", F.get(rests, F.col("part")).alias("rest"))
    done: DataFrame | None = None
    while True:
        # where no bits are left, rows differ in the few probed ones only
        large = stored(rows.where("rest != 0").groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > block).select("key"), "buckets")
        if large.isEmpty():
            done = rows if done is None else done.unionByName(rows)
            break
        hot = (F.col("rest") != 0) & F.col("large")
        marked = rows.join(small(large.withColumn("large", F.lit(True))), "key", "left").withColumn("large", F.coalesce("large", F.lit(False)))
        cool = marked.where(~hot).select("key", "fp", "rest")
        done = cool if done is None else done.unionByName(cool)
        rows = stored(marked.where(hot).select("key", "fp", "rest").mapInPandas(deeper(radius), "key long, fp long, rest long"), "deeper")
    # rows of two buckets whose hashes are equal are compared in vain, which changes nothing
    return done.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInPandas(linker(radius), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, text: str = "text", width: int = WIDTH, radius: int = RADIUS) -> DataFrame:
    """doc_id, fp, component_id: the smallest doc_id that can be reached over links of at most `radius` differing bits.

    One row per row of docs. Null texts count as empty and have fingerprint zero, linked like any other. Equal ids are one
    document for the component; null ids never name one unless they are alone. No rows give no rows.
    """
    rows = stored(fingerprints(docs.select("doc_id", text), text, "fp", width).select("doc_id", "fp"), "fingerprints")
    named = _rooted(rows, radius)
    ids = named.groupBy("root").agg(F.min("first").alias("component_id"))
    of = named.select("fp", "root").join(ids, "root").select("fp", "component_id")
    return rows.join(of, "fp").select("doc_id", "fp", "component_id")


def _rooted(rows: DataFrame, radius: int) -> DataFrame:
    """Stored rows (doc_id, fp) -> each distinct fp with its smallest doc_id (`first`) and the smallest fp of its component (`root`)."""
    firsts = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct")
    roots = components(links(firsts.select("fp"), radius))
    return firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))


def digest(docs: DataFrame) -> DataFrame:
    """near_duplicates() with the fingerprint as 16 hexadecimal digits."""
    return near_duplicates(docs).select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def kept(docs: DataFrame, least: float | None = None) -> DataFrame:
    """The documents less the near-duplicates: of each component, one row, that of the smallest doc_id.

    Two texts are linked if their fingerprints are within the radius, as in near_duplicates(), or, with `least`, if
    their five-word shingles have that Jaccard similarity or more (alike.py). Null ids come last, and rows of one id go by a hash
    of the row, so that reruns agree. Rows of one id (or of none) in different components all stay.
    """
    from . import alike

    cols = [F.col(c) for c in docs.columns]
    own, id_, of_ = free(docs.columns, "row", "id", "of")
    keyed = docs.withColumn(own, F.xxhash64(*cols, *[c.isNull() for c in cols]))
    texts = keyed.select("doc_id", F.col(own).alias("_row"), "text")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_row")
    if least is None:
        rows = stored(fingerprints(texts).select("doc_id", "_row", "fp"), "fingerprints")
        named = rows.join(_rooted(rows, RADIUS).select("fp", F.col("root").alias("_root")), "fp")
    else:
        rows = stored(alike.sketched(texts).select("doc_id", "_row", "sketch.*"), "sketches")
        nodes = stored(rows.groupBy("node").agg(F.min("_row").alias("_row"), F.first("n").alias("n"), F.first("bands").alias("bands")), "nodes")
        alikes = alike.links(nodes, texts.select("_row", "text"), least=least)
        of = _rooted(rows, RADIUS).select("fp", F.col("root").alias("group"))
        # a group of fingerprints is linked by its smallest node
        grouped = rows.join(of, "fp").select("doc_id", "_row", "node", "group")
        tied = grouped.join(grouped.groupBy("group").agg(F.min("node").alias("a")), "group").select("a", F.col("node").alias("b")).distinct()
        roots = components(alikes.unionByName(tied)).withColumnRenamed("root", "_root")
        named = grouped.join(roots, "node", "left").withColumn("_root", F.coalesce("_root", "node"))
    first = named.groupBy("_root").agg(F.min(order).alias("first")).select(F.col("first.doc_id").alias(id_), F.col("first._row").alias(of_))
    met = keyed.join(first, F.col("doc_id").eqNullSafe(F.col(id_)) & (F.col(own) == F.col(of_)), "left_semi")
    return met.dropDuplicates(["doc_id", own]).drop(own)
