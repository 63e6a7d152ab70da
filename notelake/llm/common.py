"""Shared helpers: stored frames, size-checked and salted joins, free column names and text expressions."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.store import folder

#: Most rows of a side that is broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 200_000
#: Setting that deletes a query's shuffle files at its end.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Parts that the rows of one key are dealt to in a shuffled join.
SALTS = 8


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that driver and executors share (spark.checkpoint.dir)."""
    return folder(spark, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage and survives lost executors."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(df: DataFrame, name: str) -> DataFrame:
    """`stored`, and the shuffle files that this took are deleted at once, where Spark can (by a setting of the session, put back after)."""
    conf = df.sparkSession.conf
    was = conf.get(CLEANUP)
    conf.set(CLEANUP, "true")
    try:
        return stored(df, name)
    finally:
        conf.set(CLEANUP, was)


def is_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> bool:
    """Has the stored frame at most `rows` rows?"""
    return df.limit(rows + 1).count() <= rows


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the stored frame holds at most `rows` rows; else leave it to a shuffled join."""
    return F.broadcast(df) if is_small(df, rows) else df


def looked_up(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", rows: int = BROADCAST_ROWS, salts: int = SALTS) -> DataFrame:
    """Join with a stored frame that has one row for each key (not null).

    It is broadcast if it is small. Else both sides are shuffled, the rows of each key in `salts` parts, so that a key that holds
    a third of all rows doesn't meet in one task.
    """
    if is_small(right, rows):
        return left.join(F.broadcast(right), on, how)
    (salt,) = free([*left.columns, *right.columns], "salt")
    dealt = left.withColumn(salt, (F.monotonically_increasing_id() % salts).cast("int"))
    return dealt.join(right.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))), [*on, salt], how).drop(salt)


def free(taken: Iterable[str], *names: str) -> list[str]:
    """The names with as many underscores ahead as it takes to clash with none of the taken ones, whatever their case."""
    seen, out = {c.lower() for c in taken}, []
    for name in names:
        while name.lower() in seen:
            name = f"_{name}"
        seen.add(name.lower())
        out.append(name)
    return out


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once per row and use it many times, also inside other lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def ascii_lower(text: Column) -> Column:
    """Lower case in which no word gains ASCII letters but from A-Z; null counts as the empty text.

    The two capitals beyond ASCII whose lower case holds ASCII letters (Kelvin sign, dotted I) become another letter first.
    Far faster than translate(), which looks up every character.
    """
    plain = F.coalesce(text, F.lit(""))
    return F.lower(F.replace(F.replace(plain, F.lit("\u212a"), F.lit("\u00ff")), F.lit("\u0130"), F.lit("\u00ff")))


def words(text: Column, gap: str) -> Column:
    """The non-empty runs between matches of `gap`."""
    return F.filter(F.split(text, gap), lambda w: w != "")


#: The gap between words `[^\x20\x09-\x0D]+`: what Java takes as white space.
SPACE_GAP = "\\s+"
#: The gap between words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
WORD_GAP = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
