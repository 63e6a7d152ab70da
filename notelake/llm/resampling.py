"""Target-distribution importance resampling by bit-sliced aggregation: weights from bit planes of counts and of gains."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import small, stored

#: Buckets of features, longest run of words that is a feature, thousandths of a natural logarithm in a gain.
BUCKETS, LONGEST, SCALE = 10_000, 1, 1000
#: Fewest words of a document that may be drawn, the percentage drawn, and the seed of the draw.
LEAST, PERCENT, SEED = 20, 10, "2024"
#: Rows, about, of a range of the draw's order.
RANGE = 200_000
#: A word `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` in lower-cased UTF-8.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


class GainPlanes:
    """Signed gains of all buckets as bit planes: plane k of a sign holds the buckets whose magnitude has bit k."""

    def __init__(self, gains: np.ndarray):
        gains = np.asarray(gains, np.int64)
        self.room = -(-max(len(gains), 1) // 64) * 64
        bits = max(int(np.abs(gains).max(initial=0)).bit_length(), 1)
        signs = [(s, k) for s in (1, -1) for k in range(bits)]
        self.planes = np.stack([self.packed(np.flatnonzero(((s * gains > 0) & (np.abs(gains) >> k & 1 > 0)))) for s, k in signs])
        self.powers = np.array([s << k for s, k in signs])

    def packed(self, buckets: np.ndarray) -> np.ndarray:
        """The plane in which these buckets are set."""
        bits = np.zeros(self.room, bool)
        bits[buckets] = True
        return np.packbits(bits).view(np.uint64)

    def weight(self, buckets: np.ndarray) -> int:
        """The sum of gains over features' buckets, repeats counted.

        Plane j of the counts holds the buckets whose count has bit j. Of each pair of planes the buckets in both, 2**(j+k) times.
        """
        at, counts = np.unique(buckets, return_counts=True)
        total = 0
        for j in range(int(counts.max(initial=0)).bit_length()):
            both = self.planes & self.packed(at[counts >> j & 1 > 0])
            total += int(np.bitwise_count(both).sum(axis=1, dtype=np.int64) @ self.powers) << j
        return total


def buckets_of(text: str | None, longest: int = LONGEST, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the buckets of all runs of 1 to `longest` words of the whole text, repeats included; null: none."""
    ws = _WORD.findall((text or "").encode().lower())  # of bytes, so that A-Z alone are lower-cased
    runs = list(chain(ws, *[map(b" ".join, zip(*[ws[i:] for i in range(k)], strict=False)) for k in range(2, longest + 1)]))
    return len(ws), np.fromiter(map(zlib.crc32, runs), np.int64, len(runs)) % buckets


def gains(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from the counts of all features of both tables. A row for each bucket comes to the driver."""

    def part(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for f in frames:
            for text in f["text"]:
                total += np.bincount(buckets_of(text, longest, buckets)[1], minlength=buckets)
        yield pd.DataFrame({"bucket": np.flatnonzero(total), "n": total[total > 0]})

    def counts(table: DataFrame, name: str) -> DataFrame:
        return table.select("text").mapInPandas(part, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias(name))

    s, t = np.zeros(buckets), np.zeros(buckets)
    for r in counts(docs, "s").join(counts(target, "t"), "bucket", "full").collect():  # `buckets` rows at most
        s[r["bucket"]], t[r["bucket"]] = r["s"] or 0, r["t"] or 0
    return np.floor(SCALE * np.log((t + 1) * (s.sum() + buckets) / ((s + 1) * (t.sum() + buckets)))).astype(np.int64)


def weighted(docs: DataFrame, planes: GainPlanes, longest: int = LONGEST, buckets: int = BUCKETS, to: str = "weighed") -> DataFrame:
    """The rows with a struct `to` of the whole text: n_words, n_features and weight (longs)."""

    @F.pandas_udf("n_words long, n_features long, weight long")
    def run(texts: pd.Series) -> pd.DataFrame:
        found = [buckets_of(t, longest, buckets) for t in texts]
        return pd.DataFrame({"n_words": [n for n, _ in found], "n_features": [len(b) for _, b in found], "weight": [planes.weight(b) for _, b in found]}, dtype=np.int64)

    return docs.withColumn(to, run(F.col("text")))


def noise(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise, in thousandths, of the id's digits; a null id counts as one without digits."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256), 1, 8), 16, 10).cast("double")
    return F.floor(-SCALE * F.log(-F.log((h + 0.5) / 2.0**32))).cast("long")


def _placed(rows: DataFrame) -> DataFrame:
    """Adds `place`, 1, 2, 3... by falling score: ranges of the order are sorted apart, and the rows of those before are counted."""
    parts = max(1, -(-rows.count() // RANGE), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    order = [F.desc("score"), F.asc("doc_id"), F.asc("n_features"), F.asc("weight")]
    dealt = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    dealt = stored(dealt.withColumn("part", F.shiftright("at", 33)), "ordered")
    sizes = dealt.groupBy("part").agg(F.count("*").alias("n"))
    ahead = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("ahead"))
    met = dealt.join(small(stored(ahead, "ahead")), "part")
    return met.withColumn("place", F.col("ahead") + F.col("at").bitwiseAND(F.lit(2**33 - 1)) + 1).drop("at", "part", "ahead")


def resampled(docs: DataFrame, target: DataFrame, longest: int = LONGEST, buckets: int = BUCKETS, least: int = LEAST, percent: int = PERCENT, seed: str = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank: a draw of `docs` without replacement towards the word distribution of `target`.

    The log importance ratio of a text is the sum of its features' gains; with Gumbel noise added, the highest scores are a sample
    in proportion to the ratios. `percent` of the documents of `least` words and more are drawn and ranked, ties to the smaller
    doc_id; the others' rank is null. Null or empty texts have no features, weight 0, and are never drawn. A null doc_id is an id
    of no digits that ties before others; repeated rows are drawn apart. No rows give no rows; an empty target gives gains like
    any other. Columns but doc_id and text aren't looked at.
    """
    docs = docs.select("doc_id", "text")
    planes = GainPlanes(gains(docs, target.select("text"), longest, buckets))
    scored = weighted(docs, planes, longest, buckets).select("doc_id", "weighed.*")
    scored = stored(scored.withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed)), "weights")
    may = scored.where(F.col("n_words") >= least)
    drawn = percent * may.count() // 100
    out = ["doc_id", "n_features", "weight", "score"]
    ranked = _placed(may.select(*out)).withColumn("rank", F.when(F.col("place") <= drawn, F.col("place")))
    return ranked.select(*out, "rank").unionByName(scored.where(F.col("n_words") < least).select(*out, F.lit(None).cast("long").alias("rank")))


_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FOUND = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

#: CRC-32 byte by byte, by its table of 256 entries, which is computed.
ORACLE = rf"""
WITH entries AS (
  SELECT i, list_reduce(list_concat([i], range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS e FROM (SELECT unnest(range(256)) AS i)
), crcs AS (SELECT list(e ORDER BY i) AS t FROM entries),
d AS (SELECT row_number() OVER () AS row, doc_id, {_FOUND} AS ws FROM documents),
b AS (SELECT {_FOUND} AS ws FROM benchmark),
dw AS (SELECT row, w, count(*) AS n FROM (SELECT row, unnest(ws) AS w FROM d) GROUP BY 1, 2),
bw AS (SELECT w, count(*) AS n FROM (SELECT unnest(ws) AS w FROM b) GROUP BY 1),
hexed AS (SELECT w, hex(w) AS x FROM (SELECT w FROM dw UNION SELECT w FROM bw)),
bytes AS (SELECT w, list_transform(range(len(x) // 2), lambda k: 16 * (strpos('0123456789ABCDEF', substr(x, 2 * k + 1, 1)) - 1) + strpos('0123456789ABCDEF', substr(x, 2 * k + 2, 1)) - 1) AS bs FROM hexed),
hashed AS (SELECT w, xor(list_reduce(list_concat([4294967295::BIGINT], bs), lambda c, y: xor(c >> 8, t[xor(c & 255, y) + 1])), 4294967295::BIGINT) % 10000 AS bucket FROM bytes, crcs),
s AS (SELECT bucket, sum(n) AS s FROM dw JOIN hashed USING (w) GROUP BY 1),
t AS (SELECT bucket, sum(n) AS t FROM bw JOIN hashed USING (w) GROUP BY 1),
g AS (
  SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (SELECT coalesce(sum(s), 0) + 10000 FROM s)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * (SELECT coalesce(sum(t), 0) + 10000 FROM t)::DOUBLE)))::BIGINT AS gain
  FROM s FULL JOIN t USING (bucket)
), weights AS (SELECT row, sum(n * gain) AS weight FROM dw JOIN hashed USING (w) JOIN g USING (bucket) GROUP BY 1),
scored AS (
  SELECT doc_id, len(ws)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS score
  FROM d LEFT JOIN weights USING (row)
), ranked AS (SELECT *, row_number() OVER (ORDER BY n_features < 20, score DESC, doc_id) AS place FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= (SELECT 10 * count(*) // 100 FROM scored WHERE n_features >= 20) THEN place END AS rank FROM ranked
"""
