"""Current status of notes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def current(f: DataFrame) -> DataFrame:
    """One row per note: its latest opening, closing or reopening, and whether it is open."""
    key = F.struct("action_at", "seq", "action", "action_user")
    last = f.where(F.col("action").isin("opened", "closed", "reopened")).groupBy("note_id").agg(F.max(key).alias("l"), F.first("country").alias("country"), F.first("opened_user").alias("opened_user"))
    return last.select("note_id", "country", "opened_user", F.col("l.action").alias("last_action"), F.col("l.action_at").alias("last_at"), (F.col("l.action") != "closed").alias("is_open"))


def merged(old: DataFrame, fresh: DataFrame) -> DataFrame:
    """Status rows of an earlier load and of new actions: the latest of each note counts."""
    both = old.unionByName(fresh)
    row = F.max_by(F.struct(*both.columns), F.struct("last_at", "last_action"))
    return both.groupBy("note_id").agg(row.alias("r")).select("r.*")
