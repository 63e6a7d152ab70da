"""Line dedup by a deletion-neighbourhood join. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_GAP, free, let, looked_up, small, stored, words

#: Lines of fewer words have no near copies but exact ones; longer ones may differ by one word put in, left out or changed.
LEAST = 8
#: Lines that are looked up by a broadcast of their hashes; more of them are joined by a shuffle.
LOOKED_UP = 500_000


def _hashed(ws: Column) -> Column:
    return F.transform(ws, lambda w: F.xxhash64(w))


def _lines(docs: DataFrame, text: str, least: int) -> DataFrame:
    """doc_id, mark (hash of the text), no, n words, h1 and h2 (128 bits) and the half keys of every line that has words."""
    split = docs.select("doc_id", F.xxhash64(text).alias("mark"), F.posexplode(F.split(F.col(text), "\n")).alias("no", "line"))
    return split.select("doc_id", "mark", "no", let(_hashed(words(F.col("line"), SPACE_GAP)), lambda h: _shape(h, least)).alias("s")).select("doc_id", "mark", "no", "s.*").where("n > 0")


def _shape(h: Column, least: int) -> Column:
    n = F.size(h)

    def half(kind: str, total: Column, first: Column, count: Column) -> Column:
        return F.xxhash64(F.lit(kind), total, F.slice(h, first, count))

    keys = []
    for total in (n, n - 1):  # as the shorter or equal line, and as the longer by one word
        cut = F.floor(total / 2).cast("int")
        keys += [half("first", total, F.lit(1), cut), half("last", total, n - (total - cut) + 1, total - cut)]
    return F.struct(n.alias("n"), F.xxhash64(F.lit(1), h).alias("h1"), F.xxhash64(F.lit(2), h).alias("h2"), F.when(n >= least, F.array_distinct(F.array(*keys))).alias("halves"))


def _near(all_lines: DataFrame, distinct: DataFrame, docs: DataFrame, text: str) -> DataFrame:
    """(h1, h2) of the lines that lie within one word of an earlier line.

    Only lines that share a half with another line can be near one, so others emit nothing. The rest emit the hash of each
    variant with one word left out. Lines of equal length are near if they are equal but for the word at the same place; of
    unequal length, if a variant of the longer is the shorter. Of each key only the earliest line counts, so that no
    pairs within a key are made. What a line finds is verified word by word. Keys are first counted by one hash, so that
    only keys of several lines are joined.
    """
    keyed = all_lines.where("halves IS NOT NULL").select("h1", "h2", F.explode("halves").alias("half"))
    halves = stored(keyed.groupBy("half").agg(F.min("h1").alias("a"), F.max("h1").alias("b")).where("a != b").select("half"), "halves")
    again = looked_up(keyed, halves, ["half"], rows=LOOKED_UP).select("h1", "h2").distinct()
    live = stored(distinct.join(again, ["h1", "h2"], "left_semi").select("h1", "h2", "n", "at"), "live")
    spots = live.select(F.col("at.doc_id").alias("_doc"), F.col("at.mark").alias("_mark"), F.col("at.no").alias("_no"), "h1", "h2", "n")
    text_rows = docs.select("doc_id", F.xxhash64(text).alias("mark"), F.posexplode(F.split(F.col(text), "\n")).alias("no", "line"))
    met = text_rows.join(small(spots, LOOKED_UP), F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("mark") == F.col("_mark")) & (F.col("no") == F.col("_no")))
    lines = stored(met.select("h1", "h2", "n", _hashed(words(F.col("line"), SPACE_GAP)).alias("h")).dropDuplicates(["h1", "h2"]), "near-lines")

    # rolling hashes: the xor of (place, word) up to a word, and the same with the words moved one place ahead
    w = lines.repartition("h1", "h2").select("h1", "h2", "n", F.posexplode("h").alias("i", "w"))
    own = lambda salt, place: F.xxhash64(F.lit(salt), place, F.col("w"))
    w = w.select("*", *[own(s, F.col("i") - moved).alias(f"_{s}{moved}") for s in (1, 2) for moved in (0, 1)])
    line = Window.partitionBy("h1", "h2").orderBy("i")
    upto, back = line.rowsBetween(Window.unboundedPreceding, 0), Window.partitionBy("h1", "h2")
    total = lambda c: F.bit_xor(c).over(back)
    before = lambda s: F.bit_xor(f"_{s}0").over(upto).bitwiseXOR(F.col(f"_{s}0"))
    after = lambda s: total(f"_{s}1").bitwiseXOR(F.bit_xor(f"_{s}1").over(upto))
    v = w.select("h1", "h2", "n", "i", *[before(s).bitwiseXOR(after(s)).alias(f"v{s}") for s in (1, 2)], *[F.when(F.col("i") == 0, total(f"_{s}0")).alias(f"f{s}") for s in (1, 2)])
    v = stored(v, "variants")
    at = lambda of, name: live.select(F.col("h1").alias(f"{of}1"), F.col("h2").alias(f"{of}2"), F.col("at").alias(name))
    me = F.struct("at", "h1", "h2")
    # one word changed: equal length, place and variant
    key = ["n", "i", "v1", "v2"]
    once = v.withColumn("key", F.xxhash64(*key))
    twice = stored(once.groupBy("key").count().where("count > 1").select("key"), "keys")
    several = looked_up(once, twice, ["key"], rows=LOOKED_UP).select("h1", "h2", *key).join(at("h", "at"), ["h1", "h2"])
    firsts = stored(several.groupBy(*key).agg(F.min(me).alias("first")), "firsts")
    changed = looked_up(several, firsts, key).where("first.at < at").select("h1", "h2", "first")
    # one word left out: a variant of the longer is the shorter line
    short = v.where("i = 0").select(F.col("f1").alias("v1"), F.col("f2").alias("v2"), (F.col("n") + 1).alias("n"), F.col("h1").alias("s1"), F.col("h2").alias("s2"))
    pairs = looked_up(v, stored(short, "short"), ["v1", "v2", "n"], rows=LOOKED_UP).select("h1", "h2", "s1", "s2").distinct()
    pairs = stored(pairs.join(at("h", "at"), ["h1", "h2"]).join(at("s", "short_at"), ["s1", "s2"]), "pairs")
    longer = pairs.where("short_at < at").select("h1", "h2", F.struct(F.col("short_at").alias("at"), F.col("s1").alias("h1"), F.col("s2").alias("h2")).alias("first"))
    shorter = pairs.where("at < short_at").groupBy("s1", "s2").agg(F.min(me).alias("first")).select(F.col("s1").alias("h1"), F.col("s2").alias("h2"), "first")
    found = changed.unionByName(longer).unionByName(shorter).select("h1", "h2", F.col("first.h1").alias("g1"), F.col("first.h2").alias("g2")).distinct()

    a, b = lines.select("h1", "h2", F.col("h").alias("x")), lines.select(F.col("h1").alias("g1"), F.col("h2").alias("g2"), F.col("h").alias("y"))
    return found.join(a, ["h1", "h2"]).join(b, ["g1", "g2"]).where(within_one(F.col("x"), F.col("y"))).select("h1", "h2").distinct()


def within_one(x: Column, y: Column) -> Column:
    """Are two arrays at most one element put in, left out or changed apart?"""
    n, m = F.size(x), F.size(y)
    same = F.filter(F.sequence(F.lit(1), F.least(n, m)), lambda i: F.get(x, i - 1) != F.get(y, i - 1))
    at = F.coalesce(F.array_min(same), F.least(n, m) + 1)
    rest = lambda a, k, after: F.slice(a, after + 1, k)
    far = F.greatest(n, m)
    return (
        F.when(n == m, F.slice(x, at + 1, far) == F.slice(y, at + 1, far))
        .when(n == m + 1, rest(x, far, at) == rest(y, far, at - 1))
        .when(m == n + 1, rest(y, far, at) == rest(x, far, at - 1))
        .otherwise(F.lit(False))
    )


def dropped(docs: DataFrame, text: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, mark, drops: the numbers (from 0) of the lines of each text that go; texts that keep all are absent.

    The order of lines is (doc_id, hash of the text, number). A line goes if an equal one (word for word, whatever the white
    space) comes before it, or if its first copy lies within one word of a line that comes before that and both have `least`
    words or more. Lines without words stay. Null ids come first; rows that are equal in id and text are one.
    """
    all_lines = stored(_lines(docs, text, least), "lines")
    at = F.struct("doc_id", "mark", "no").alias("at")
    distinct = stored(all_lines.groupBy("h1", "h2").agg(F.min(at).alias("at"), F.count("*").alias("copies"), F.max("n").alias("n")), "distinct-lines")
    near = _near(all_lines, distinct, docs, text).withColumn("near", F.lit(True))
    told = distinct.join(near, ["h1", "h2"], "left").where("copies > 1 OR near").select("h1", "h2", F.col("at").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    met = looked_up(all_lines.select("doc_id", "mark", "no", "h1", "h2"), stored(told, "told"), ["h1", "h2"])
    gone = met.where(F.col("near") | (F.struct("doc_id", "mark", "no") != F.col("first")))
    return gone.groupBy("doc_id", "mark").agg(F.collect_set("no").alias("drops"))


def deduplicated(docs: DataFrame, text: str = "text", keep: str | None = None, least: int = LEAST) -> DataFrame:
    """The rows with the dropped() lines gone from their texts; a text all of whose lines go becomes empty, a null stays.

    With `keep`, a column of that name has the number of lines that stay; one of that name is replaced. Other columns stay as they are.
    """
    doc, mark, drops, own = free(docs.columns, "doc", "mark", "drops", "own")
    gone = dropped(docs, text, least).select(F.col("doc_id").alias(doc), F.col("mark").alias(mark), F.col("drops").alias(drops))
    met = docs.withColumn(own, F.xxhash64(text)).join(gone, F.col("doc_id").eqNullSafe(F.col(doc)) & (F.col(own) == F.col(mark)), "left")
    lines = F.filter(F.split(F.col(text), "\n"), lambda x, i: ~F.array_contains(drops, i))
    new = F.when(F.col(drops).isNull(), F.col(text)).otherwise(F.array_join(lines, "\n"))
    count = F.when(F.col(drops).isNull(), F.coalesce(F.size(F.split(F.col(text), "\n")), F.lit(0))).otherwise(F.size(lines))
    columns = [new.alias(c) if c == text else F.col(c) for c in docs.columns if c != keep]
    return met.select(*columns, *([count.cast("long").alias(keep)] if keep else []))


def digest(docs: DataFrame) -> DataFrame:
    """doc_id, n_kept lines and the digest of the text that stays (null: that of the empty text)."""
    return deduplicated(docs.select("doc_id", "text"), keep="n_kept").select("doc_id", "n_kept", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))
