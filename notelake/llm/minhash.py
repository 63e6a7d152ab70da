"""Document fingerprints: one-permutation MinHash with optimal densification. DataFrame functions only."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_GAP, ascii_lower, free, let, stored, words

#: Bins (a power of two), low-order bits that are kept of each bin's minimum, words of a shingle.
BINS, BITS, WIDTH = 128, 8, 5
#: Bytes of text, about, of a range of documents whose successors are looked up together; most ranges (beyond it they grow), and
#: documents that are sampled for the bounds of each.
RANGE, RANGES, SAMPLED = 4 << 20, 50_000, 16


def _donors(bins: int) -> list[list[int]]:
    """For each bin, the rank of every bin in its order of probes.

    Optimal densification tries bins hash(i, 1), hash(i, 2), ... until one isn't empty. A bin that was tried in vain
    stays empty, so only first visits count: they give this permutation.
    """
    def rank(i: int) -> list[int]:
        seen: dict[int, int] = {}
        t = 0
        while len(seen) < bins:
            t += 1
            b = int.from_bytes(hashlib.blake2b(f"{i}.{t}".encode(), digest_size=4).digest(), "little") % bins
            seen.setdefault(b, len(seen))
        return [seen[b] for b in range(bins)]

    return [rank(i) for i in range(bins)]


def shingle_hashes(text: Column, width: int = WIDTH) -> Column:
    """Sorted hashes of the shingles of `width` lower-cased words; fewer words: one shingle of them all; none: none."""
    hashed = F.transform(words(ascii_lower(text), SPACE_GAP), lambda w: F.xxhash64(w))
    joint = lambda h: lambda v, i: F.xxhash64(v, *[F.get(h, i + k) for k in range(1, width)])
    whole = lambda h: F.transform(F.slice(h, F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(1))), joint(h))
    return let(hashed, lambda h: F.when(F.size(h) > 0, F.sort_array(whole(h))).otherwise(F.array().cast("array<bigint>")))


def slots(text: Column, bins: int = BINS, bits: int = BITS, width: int = WIDTH) -> Column:
    """The low-order bits of every bin's minimum, array<int> of `bins`; a text without words has all of them 0.

    Each shingle is hashed once; the top bits of its hash are its bin. Empty bins copy the first filled bin of
    their order of probes.
    """
    top, mask = 64 - (bins.bit_length() - 1), (1 << bits) - 1
    ranks = F.from_json(F.lit(json.dumps(_donors(bins))), "array<array<int>>")  # folded to one literal
    low = lambda v: (F.shiftrightunsigned(v, 8).bitwiseAND(F.lit(mask).cast("bigint"))).cast("int")
    bin_of = lambda v: F.shiftright(v, top).cast("int") + bins // 2

    def fill(firsts: Column) -> Column:
        full = F.size(firsts) == bins
        has = F.map_from_arrays(F.transform(firsts, bin_of), F.transform(firsts, low))
        packed = lambda r: F.array_min(F.transform(firsts, lambda v: F.get(r, bin_of(v)) * (mask + 1) + low(v))).bitwiseAND(F.lit(mask))
        every = lambda m: F.transform(F.sequence(F.lit(0), F.lit(bins - 1)), lambda i: F.coalesce(F.try_element_at(m, i), packed(F.get(ranks, i))))
        return F.when(full, F.transform(firsts, low)).otherwise(let(has, every))

    def densify(h: Column) -> Column:
        firsts = F.filter(h, lambda v, i: (i == 0) | (bin_of(v) != bin_of(F.get(h, i - 1))))
        return F.when(F.size(h) > 0, let(firsts, fill)).otherwise(F.array_repeat(F.lit(0), bins))

    return let(shingle_hashes(text, width), densify)


def packed(sl: Column, bits: int = BITS) -> Column:
    """Hexadecimal text of the slots."""
    return F.array_join(F.transform(sl, lambda v: F.lower(F.lpad(F.hex(v), bits // 4, "0"))), "")


def likeness(a: Column, b: Column, bits: int = BITS) -> Column:
    """Estimated Jaccard similarity of two slot arrays: the share of equal slots less that expected by chance."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x) / F.size(a)
    chance = 2.0**-bits
    return F.greatest(F.lit(0.0), (same - chance) / (1 - chance))


_KEY = "struct<some:int,id:bigint,tie:bigint,salt:bigint>"


def _bounds(keyed: DataFrame, key: str, size: int) -> list[dict]:
    """The least keys of ranges of about equal size, by a sample of the keys: RANGES * SAMPLED rows at most, about."""
    total = keyed.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    ranges = min(RANGES, -(-total["bytes"] // size))
    if ranges < 2:
        return []
    every = max(1, total["n"] // (ranges * SAMPLED))
    got = sorted(r[0] for r in keyed.where(F.pmod(F.xxhash64(key), F.lit(every)) == 0).select(key).distinct().collect())
    return [r.asDict() for r in got[:: max(1, len(got) // ranges)]]


def _range_of(key: Column, bounds: list[dict]) -> Column:
    """The number of the range that holds a key: of the last bound that isn't above it, found in two steps."""
    if not bounds:
        return F.lit(0)
    step = max(1, round(len(bounds) ** 0.5))
    below = lambda array: F.greatest(F.size(F.filter(array, lambda b: b <= key)) - 1, F.lit(0))
    heads = F.from_json(F.lit(json.dumps(bounds[::step])), f"array<{_KEY}>")  # folded to literals
    parts = F.from_json(F.lit(json.dumps([bounds[i : i + step] for i in range(0, len(bounds), step)])), f"array<array<{_KEY}>>")
    return let(below(heads), lambda part: part * step + below(F.get(parts, part)))


def successors(docs: DataFrame, size: int = RANGE) -> tuple[DataFrame, Window, str]:
    """(doc_id, text) with copies, the window whose lead() is the next row by descending doc_id (after the last, the first), and
    the column that marks copies.

    Null ids come last; equal ids go by a hash of the text, equal rows in any order. Rows are dealt to ranges of about `size`
    bytes of text, bounded by keys of the table itself, so that none is empty; to each range comes a copy of the greatest row
    of the one below, so that no task sees more than a range. Drop the copies after the window.
    """
    key, group, guest, top, to = free(docs.columns, "key", "group", "guest", "top", "to")
    keyed = docs.withColumn(key, F.struct(F.col("doc_id").isNotNull().cast("int").alias("some"), F.coalesce("doc_id", F.lit(0)).cast("bigint").alias("id"), F.xxhash64("text").alias("tie"), F.xxhash64(F.monotonically_increasing_id()).alias("salt")))
    bounds = _bounds(keyed, key, size)
    placed = keyed.withColumn(group, _range_of(F.col(key), bounds))
    own = F.struct(*[F.col(key)[c].alias(c) for c in ("some", "id", "tie")])
    tops = stored(placed.groupBy(group).agg(F.max(own).alias(top)), "tops")  # a row for each range, RANGES at most, about
    below = tops.select(F.col(group), F.col(top), F.pmod(F.col(group) + 1, F.lit(max(len(bounds), 1))).alias(to))
    guests = placed.withColumn(top, own).join(F.broadcast(below), [group, top]).dropDuplicates([group])
    both = placed.withColumn(guest, F.lit(False)).unionByName(guests.select(*docs.columns, key, F.col(to).alias(group), F.lit(True).alias(guest)))
    return both, Window.partitionBy(group).orderBy(guest, F.desc(key)), guest


def digest(docs: DataFrame) -> DataFrame:
    """Per document: fingerprints of its text and of its edited text, and their likeness to each other and the next's.

    Null texts count as empty, which fingerprint as zeros. Edited: the last third of the code points (rounded down)
    gives way to as many first ones of the next document by descending doc_id. A sole document is its own next.
    """
    both, order, guest = successors(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")))
    own = both.withColumn("own", slots(F.col("text")))
    met = own.select("*", F.lead("text").over(order).alias("next_text"), F.lead("own").over(order).alias("next_own")).where(~F.col(guest))
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    done = met.select("doc_id", n.cast("long").alias("n_chars"), "own", "next_own", edited.alias("edited")).withColumn("edited_own", slots(F.col("edited")))
    return done.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        packed(F.col("own")).alias("fingerprint"),
        packed(F.col("edited_own")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("edited_own")).alias("near_edited"),
        likeness(F.col("own"), F.col("next_own")).alias("near_next"),
    )
