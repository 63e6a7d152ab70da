"""Pairs of texts by the Jaccard similarity of their word shingles: MinHash bands and rare shingles propose, the shingles decide."""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import looked_up, small, stored
from .components import components
from .simhash import fingerprint, shingles

#: Words of a shingle, and the least similarity of linked texts.
WIDTH, LEAST = 5, 0.8
#: Bands and minima of a band: of pairs at 0.8, 1 - (1 - 0.8**4)**20 = 0.99997 meet in a band.
BANDS, ROWS = 20, 4
#: Nodes of a bucket that are compared pair by pair; of larger buckets, those that have rare shingles in common.
PAIRWISE = 8
#: Bands of the first pass, in which each node is compared with one leader of each bucket; what it links isn't compared again.
FIRST = 4
#: Nodes whose shingles tell which are frequent, and the most shingles that are taken as such. Others count as rare; links don't depend on it.
SAMPLE, FREQUENT = 500, 50_000

_SEED = np.random.default_rng(42).integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64)
_TIMES, _PLUS = _SEED[0] | np.uint64(1), _SEED[1]


def _set(text: str | None, width: int) -> np.ndarray:
    return np.unique(shingles(text, width))


def _bands(h: np.ndarray) -> np.ndarray:
    """One hash for each band of a set's minima under as many permutations; none for the empty set."""
    if not len(h):
        return np.empty(0, np.int64)
    least = np.full(BANDS * ROWS, 2**64 - 1, np.uint64)
    for at in range(0, len(h), 1024):
        np.minimum(least, (h[at : at + 1024, None] * _TIMES + _PLUS).min(axis=0), out=least)
    key = np.arange(1, BANDS + 1, dtype=np.uint64)
    for column in least.reshape(BANDS, ROWS).T:
        key = (key ^ column) * np.uint64(0x9E3779B97F4A7C15)
        key ^= key >> np.uint64(29)
    return key.view(np.int64)


def sketched(docs: DataFrame, text: str = "text", width: int = WIDTH) -> DataFrame:
    """The rows with `sketch`: the fingerprint of op4 (fp), a hash of the set of shingles (node), its size (n) and its bands."""

    @F.pandas_udf("fp long, node long, n int, bands array<long>")
    def run(texts: pd.Series) -> pd.DataFrame:
        out = []
        for t in texts:
            h = _set(t, width)
            node = np.uint64(xxhash.xxh64_intdigest(h.tobytes(), 42)).view(np.int64)
            out.append((fingerprint(t), node, len(h), _bands(h)))
        return pd.DataFrame(out, columns=["fp", "node", "n", "bands"])

    return docs.withColumn("sketch", run(F.col(text)))


def _sets(nodes: DataFrame, texts: DataFrame, width: int) -> DataFrame:
    """Stored nodes (node, _row) -> each with its set of shingles (s), ascending."""

    @F.pandas_udf("array<long>")
    def sets(column: pd.Series) -> pd.Series:
        return pd.Series([_set(t, width).view(np.int64) for t in column])

    # equal rows of the input have one _row
    got = texts.join(small(nodes), "_row").select("node", sets(F.col("text")).alias("s"))
    return stored(got.groupBy("node").agg(F.first("s").alias("s")), "sets")


def verified(pairs: DataFrame, nodes: DataFrame, texts: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """Of pairs (a, b), those whose sets are at least so similar. Texts (_row, text) are read only of the nodes in pairs."""
    met = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    of = _sets(stored(met.join(nodes.select("node", "_row"), "node"), "met"), texts, width)
    both = pairs.join(of.select(F.col("node").alias("a"), F.col("s").alias("sa")), "a").join(of.select(F.col("node").alias("b"), F.col("s").alias("sb")), "b")
    shared = F.size(F.array_intersect("sa", "sb"))
    return both.select("a", "b", F.size("sa").alias("na"), F.size("sb").alias("nb"), shared.alias("i")).where(F.col("i") / (F.col("na") + F.col("nb") - F.col("i")) >= least).select("a", "b")


def links(nodes: DataFrame, texts: DataFrame, width: int = WIDTH, least: float = LEAST) -> DataFrame:
    """Distinct nodes (node, n, bands, and the _row of one of their texts) -> links (a, b) of nodes at least so similar.

    A first pass over FIRST bands compares every node with the leader of its bucket, the node of the smallest hash. Its links
    make groups, and nodes of one group aren't compared again. Then all pairs of a small bucket are compared; in a larger one
    every node is compared with the leader. So a large group takes pairs in proportion to it. At last, nodes of large buckets
    whose nodes the links so far leave in different groups are compared if they have a rare shingle in common (_rarely), which all
    alike ones have, so that no link between groups is lost.
    """
    bands = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    alone = bands.withColumn("group", F.col("node"))
    found = _led(_several(alone.where(F.col("band") < FIRST)), nodes, texts, width, least, 0)
    found = found.unionByName(_led(_several(_grouped(bands, found)), nodes, texts, width, least, PAIRWISE))
    apart = _several(_grouped(bands, found)).where(F.col("many") > PAIRWISE)
    return found.unionByName(_rarely(apart.select("node", "n", "group").distinct(), nodes, texts, width, least))


def _grouped(bands: DataFrame, found: DataFrame) -> DataFrame:
    """The rows with the group of their node by the links so far."""
    groups = components(found).withColumnRenamed("root", "group")
    return bands.join(groups, "node", "left").withColumn("group", F.coalesce("group", "node"))


def _several(rest: DataFrame) -> DataFrame:
    """The rows of buckets of several groups, with the number of nodes of each (`many`)."""
    several = rest.groupBy("key").agg(F.count("*").alias("many"), F.min("group").alias("low"), F.max("group").alias("high")).where("low != high")
    return stored(looked_up(rest.select("node", "n", "key", "group"), stored(several.select("key", "many"), "keys"), ["key"]), "buckets")


def _led(rest: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, least: float, pairwise: int) -> DataFrame:
    """The links of the nodes with the leaders of their buckets: of those up to `pairwise` all nodes, of others one."""
    # the first of each key are taken before the shuffle
    place = F.row_number().over(Window.partitionBy("key").orderBy(F.xxhash64("node"), "node"))
    first = rest.withColumn("place", place).where(F.col("place") <= max(1, pairwise)).where((F.col("many") <= pairwise) | (F.col("place") == 1))
    led = stored(first.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("place", "node", "n", "group"))).alias("leaders")), "leaders")
    met = looked_up(rest, led, ["key"]).withColumn("own", F.array_position(F.col("leaders.node"), F.col("node")).cast("int"))
    ahead = F.when(F.col("own") > 0, F.slice("leaders", F.lit(1), F.col("own") - 1)).otherwise(F.col("leaders"))
    # sets of too different sizes can't be so similar; a hair's breadth is left for rounding
    close = F.filter(ahead, lambda x: (x.group != F.col("group")) & (F.least(x.n, F.col("n")) >= (least - 1e-9) * F.greatest(x.n, F.col("n"))))
    pairs = stored(met.select(F.explode(close).alias("x"), "node").select(F.col("x.node").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    return stored(verified(pairs, nodes, texts, width, least), "alike")


def _rarely(rest: DataFrame, nodes: DataFrame, texts: DataFrame, width: int, least: float) -> DataFrame:
    """The links of nodes (node, n, group) of different groups, by a prefix join: every pair that is so similar is compared.

    Shingles are put in one order for all, rare ones first. Sets of n and m shingles that are so similar share
    least / (1 + least) * (n + m) at least, so the first one that they share stands so near the beginning of both that as many
    can follow. Further ones may make a pair meet again, never another pair.
    """
    own = stored(rest.join(nodes.select("node", "_row"), "node"), "apart")
    of = _sets(own.select("node", "_row"), texts, width)
    known = of.orderBy(F.xxhash64("node"), "node").limit(SAMPLE).select(F.explode("s").alias("token")).groupBy("token").count().where("count > 1")
    top = known.orderBy(F.desc("count"), "token").limit(FREQUENT).toPandas().sort_values("token")
    tokens, counts = top["token"].to_numpy(np.int64), top["count"].to_numpy(np.int64)

    @F.pandas_udf("array<long>")
    def prefix(column: pd.Series) -> pd.Series:
        return pd.Series([_prefix(s, tokens, counts, least) for s in column])

    rows = stored(of.select("node", prefix(F.col("s")).alias("prefix")).join(own, "node").select("node", "n", "group", F.posexplode("prefix").alias("pos", "token")), "prefixes")
    # of two, `a` is that of fewer shingles; it can follow with none too many
    part = least / (1 + least)
    a = rows.where(F.col("n") - F.col("pos") >= 2 * part * F.col("n") - 1e-6).alias("a")
    b = rows.alias("b")
    x, y = (lambda c: F.col(f"a.{c}")), (lambda c: F.col(f"b.{c}"))
    ordered = (x("n") < y("n")) | ((x("n") == y("n")) & (x("node") < y("node")))
    enough = F.least(x("n") - x("pos"), y("n") - y("pos")) >= part * (x("n") + y("n")) - 1e-6
    met = a.join(b, (x("token") == y("token")) & ordered & (x("n") >= (least - 1e-9) * y("n")) & enough & (x("group") != y("group")))
    pairs = stored(met.select(x("node").alias("a"), y("node").alias("b")).distinct(), "rare")
    return stored(verified(pairs, nodes, texts, width, least), "alike")


def _prefix(s: np.ndarray, tokens: np.ndarray, counts: np.ndarray, least: float) -> np.ndarray:
    """The first shingles of a set in the order of all, as many as decide: two sets at least so similar share one of them."""
    if len(tokens):
        at = np.minimum(np.searchsorted(tokens, s), len(tokens) - 1)
        s = s[np.lexsort((s, np.where(tokens[at] == s, counts[at], 0)))]
    return s[: len(s) - int(np.ceil(least * len(s) - 1e-6)) + 1]
