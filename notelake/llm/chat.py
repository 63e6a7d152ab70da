"""Chat formatting after the collapse of cumulative snapshots. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def prefixes(turns: DataFrame) -> DataFrame:
    """Turns with `pos` (from 1, by turn, role, text, nulls first), `n` turns of the conversation and h1, h2.

    (h1, h2) is the rolling hash of the first `pos` turns: the xor of hashes of (position, role, text), 128 bits.
    """
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    placed = turns.select("conv_id", "turn", "role", "text", F.row_number().over(order).alias("pos"))
    role, text = F.struct(F.col("role").isNull(), "role"), F.struct(F.col("text").isNull(), "text")
    hashed = placed.withColumn("_1", F.xxhash64(F.lit("a"), "pos", role, text)).withColumn("_2", F.xxhash64(F.lit("b"), "pos", role, text))
    running = Window.partitionBy("conv_id").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    n = F.count("*").over(Window.partitionBy("conv_id"))
    return hashed.select("conv_id", "pos", "role", "text", n.alias("n"), F.bit_xor("_1").over(running).alias("h1"), F.bit_xor("_2").over(running).alias("h2"))


def maximal(turns: DataFrame) -> DataFrame:
    """conv_id, n, copies: conversations that begin no longer one; of equal ones the smallest conv_id, with their count."""
    seen = prefixes(turns).drop("role", "text")
    whole = seen.where("pos = n").groupBy("h1", "h2", "n").agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
    begun = seen.where("pos < n").select("h1", "h2", F.col("pos").alias("n")).distinct()
    return whole.join(begun, ["h1", "h2", "n"], "left_anti").select("conv_id", "n", "copies")


def formatted(turns: DataFrame, start: str = "<|", end: str = "|>\n", stop: str = "\n") -> DataFrame:
    """conv_id, n_turns, copies, chat: every maximal conversation in the template, turns in order.

    A null role is "unknown", a null text empty; a null conv_id is a conversation of its own. Repeated rows are
    turns again. A mark that begins a turn gets a backslash within it where a role or text holds it, one that ends a role
    where a role does, so that no text can forge a turn. A conversation is one row of the result and is put together in one
    task. No rows give no rows; other columns are left aside.
    """
    keep = maximal(turns).alias("k")
    t = turns.select("conv_id", "turn", "role", "text").alias("t")
    # a null id is an id, and sorts as the smallest
    met = t.join(keep, F.col("t.conv_id").eqNullSafe(F.col("k.conv_id")))
    lines = met.groupBy("t.conv_id", "k.n", "k.copies").agg(F.sort_array(F.collect_list(F.struct("t.turn", "t.role", "t.text"))).alias("turns"))
    parted = lambda mark: f"{mark[0]}\\{mark[1:]}"
    safe = lambda c: F.replace(c, F.lit(start), F.lit(parted(start)))
    role = lambda c: F.replace(safe(c), F.lit(end.strip()), F.lit(parted(end.strip())))
    one = lambda x: F.concat(F.lit(start), role(F.coalesce(x.role, F.lit("unknown"))), F.lit(end), safe(F.coalesce(x.text, F.lit(""))), F.lit(stop))
    return lines.select("conv_id", F.col("n").cast("long").alias("n_turns"), "copies", F.array_join(F.transform("turns", one), "").alias("chat"))


def digest(turns: DataFrame) -> DataFrame:
    """formatted() with the length and digest of the chat in its place."""
    return formatted(turns).select("conv_id", "n_turns", "copies", F.length("chat").cast("long").alias("n_chars"), F.sha2("chat", 256).alias("chat_sha256"))


ORACLE = r"""
WITH t AS (SELECT conv_id, replace(replace(coalesce(role, 'unknown'), '<|', '<\|'), '|>', '|\>') AS role, replace(coalesce(text, ''), '<|', '<\|') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos,
                  count(*) OVER (PARTITION BY conv_id) AS n FROM conversations),
c AS (SELECT *, string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '') OVER (PARTITION BY conv_id ORDER BY pos) AS chat FROM t),
w AS (SELECT chat, n, min(conv_id) AS conv_id, count(*) AS copies FROM c WHERE pos = n GROUP BY chat, n)
SELECT conv_id, n AS n_turns, copies, length(chat) AS n_chars, sha256(chat) AS chat_sha256
FROM w WHERE NOT EXISTS (SELECT 1 FROM c WHERE c.pos < c.n AND c.pos = w.n AND c.chat = w.chat)
"""
