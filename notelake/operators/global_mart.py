"""The global mart: one row of counts and times over all facts, and its lists."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C
from .marts import count_of, is_

ACTIONS = ("opened", "commented", "closed", "reopened", "hidden")


def counts(f: DataFrame, as_of: date) -> DataFrame:
    year = F.year("action_date") == as_of.year
    return f.agg(*[count_of(is_(a)).alias(f"whole_{a}") for a in ACTIONS], *[count_of(is_(a) & year).alias(f"year_{a}") for a in ACTIONS])


def resolution(f: DataFrame, as_of: date) -> DataFrame:
    """Mean and median over all closes and over those of notes opened this year (after a day at least); the rate of notes."""
    d = F.col("days_to_resolution")
    own = F.when((F.year("opened_date") == as_of.year) & (d > 0), d)
    notes = f.groupBy("note_id").agg(F.max(is_("closed")).alias("c"), F.max(is_("opened")).alias("o")).agg((F.lit(100.0) * count_of(F.col("c")) / count_of(F.col("o"))).alias("rate"))
    half = F.lit(0.5)
    return f.agg(F.avg(d).alias("avg_days"), F.percentile(d, half).alias("median_days"), F.avg(own).alias("avg_days_year"), F.percentile(own, half).alias("median_days_year")).crossJoin(notes)  # one row each


def first_latest(f: DataFrame) -> DataFrame:
    key = F.struct("action_at", "note_id")
    return f.where(F.col("action") != "hidden").groupBy("action").agg(F.min(key)["note_id"].alias("first_note"), F.max(key)["note_id"].alias("latest_note"))


def closed_with_comment(f: DataFrame, as_of: date) -> DataFrame:
    """Closes with an earlier comment on the note."""
    hit = is_("closed") & (F.col("prior_commented") > 0)
    return f.agg(count_of(hit).alias("whole"), count_of(hit & (F.year("action_date") == as_of.year)).alias("year"))


def comment_metrics(f: DataFrame) -> DataFrame:
    n = F.count("*")
    return f.where("comment_length > 0").agg(F.avg("comment_length").alias("avg_length"), (F.lit(100.0) * count_of(F.col("has_url")) / n).alias("url_pct"), (F.lit(100.0) * count_of(F.col("has_mention")) / n).alias("mention_pct"))


def last_days(f: DataFrame, as_of: date, days: int = 30) -> DataFrame:
    r = f.where(F.col("action_date") >= F.date_sub(F.lit(as_of), days))
    return r.agg(count_of(is_("opened")).alias("created"), count_of(is_("closed")).alias("resolved"), F.countDistinct(F.when(F.col("action_user") != -1, F.col("action_user"))).alias("active_users"))


def status(st: DataFrame, f: DataFrame, as_of: date) -> DataFrame:
    o = st.join(f.where(is_("opened")).select("note_id", "opened_date"), "note_id")
    late = F.datediff(F.lit(as_of), F.col("opened_date")) > 7
    return o.agg(count_of(F.col("is_open")).alias("open_notes"), count_of(~F.col("is_open")).alias("closed_notes"), count_of(F.col("is_open") & late).alias("backlog"))


def applications(f: DataFrame, top: int = 10) -> DataFrame:
    """The `top` applications of openings, with whether each is the most used, and on every row how many distinct ones are mobile and for desktops or the web."""
    n = f.where("app IS NOT NULL AND action = 'opened'").groupBy("app", "platform").agg(F.count("*").alias("n"))
    kinds = n.agg(F.countDistinct(F.when(C.is_mobile(F.col("platform")), F.col("app"))).alias("mobile_apps"), F.countDistinct(F.when(C.is_desktop(F.col("platform")), F.col("app"))).alias("desktop_apps"))
    first = n.groupBy("app").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "app").limit(top)
    best = F.row_number().over(Window.orderBy(F.desc("n"), "app")) == 1  # `top` rows
    return first.withColumn("most_used", best).crossJoin(kinds)  # one row


def top_countries(f: DataFrame, top: int = 10) -> DataFrame:
    return f.groupBy("country").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "country").limit(top)


def comments_per_note(f: DataFrame) -> DataFrame:
    return f.groupBy("note_id").agg(F.max("prior_commented").alias("m")).agg(F.avg("m").alias("mean"))


def ages(f: DataFrame, as_of: date) -> DataFrame:
    """Notes whose last fact is no close, by age since opening."""
    last = f.groupBy("note_id").agg(F.max(F.struct("action_at", "seq", "action")).alias("l"), F.min("opened_date").alias("opened_date")).where("l.action <> 'closed'")
    return last.groupBy(C.age_band(F.datediff(F.lit(as_of), F.col("opened_date"))).alias("band")).agg(F.count("*").alias("n"))


def first_dates(f: DataFrame) -> DataFrame:
    d = F.col("action_date")
    return f.agg(F.min(F.when(is_("opened"), d)).alias("first_opened"), F.min(F.when(is_("closed"), d)).alias("first_closed"), F.max("action_at").alias("last_at"))


def top_notes(f: DataFrame, action: str, top: int = 10) -> DataFrame:
    n = f.where(is_(action)).groupBy("note_id").agg(F.count("*").alias("n"))
    return n.orderBy(F.desc("n"), "note_id").limit(top)


def per_year(f: DataFrame) -> DataFrame:
    return f.groupBy(F.year("action_date").alias("year")).agg(*[count_of(is_(a)).alias(a) for a in ACTIONS], F.countDistinct("action_user").alias("users"))
