"""Data-quality checks and the analysis of mart update times."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .facts import ACTIONS
from .marts import count_of, is_
from .status import current


def reopened_later(status: DataFrame, f: DataFrame) -> DataFrame:
    """Notes closed by their status but reopened after that."""
    again = f.where(is_("reopened")).groupBy("note_id").agg(F.max("action_at").alias("again"))
    return status.where("NOT is_open").join(again, "note_id").where("again > last_at").select("note_id")


def open_but_closed(status: DataFrame, f: DataFrame) -> DataFrame:
    """Notes open by their status whose last opening, closing or reopening is a close."""
    last = current(f).where("last_action = 'closed'").select("note_id")
    return status.where("is_open").join(last, "note_id", "left_semi").select("note_id")


def status_differs(status: DataFrame, f: DataFrame) -> DataFrame:
    """Notes whose status isn't that of their actions, or that have none."""
    fresh = current(f).select("note_id", F.col("is_open").alias("_open"))
    return status.join(fresh, "note_id", "full").where(~F.col("is_open").eqNullSafe(F.col("_open"))).select("note_id")


def counts_by(comments: DataFrame, f: DataFrame, by: str, of: str) -> DataFrame:
    """Rows of the base table and of the facts for each value, where either has some; a difference is marked."""
    a = comments.groupBy(F.col(by).alias("value")).agg(F.count("*").alias("base"))
    b = f.groupBy(F.col(of).alias("value")).agg(F.count("*").alias("facts"))
    j = a.join(b, "value", "full")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return j.select("value", zero("base"), zero("facts")).withColumn("same", F.col("base") == F.col("facts"))


def summary(status: DataFrame, comments: DataFrame, f: DataFrame) -> DataFrame:
    """check_name, failures, result: PASS, FAIL, or SKIP where there is nothing to check."""
    failing = {
        "reopened_later": reopened_later(status, f),
        "open_but_closed": open_but_closed(status, f),
        "status_differs": status_differs(status, f),
        "per_action": counts_by(comments.where(F.col("event").isin(*ACTIONS)), f, "event", "action").where("NOT same"),
    }
    rows = f.limit(1).agg((F.count("*") > 0).alias("some"))
    out = None
    for name, df in failing.items():
        one = df.agg(F.lit(name).alias("check_name"), F.count("*").alias("failures"))
        out = one if out is None else out.unionByName(one)
    return out.crossJoin(F.broadcast(rows)).select("check_name", "failures", F.when(~F.col("some"), "SKIP").when(F.col("failures") == 0, "PASS").otherwise("FAIL").alias("result"))  # one row


def mart_log(events: DataFrame) -> DataFrame:
    """Update log of the marts, derived from events."""
    kind = F.when(F.col("user_id") % 3 == 0, "countries").when(F.col("user_id") % 3 == 1, "users").otherwise("global")
    return events.select(
        F.col("event_id").alias("log_id"), kind.alias("kind"), F.col("user_id").alias("entity_id"), F.col("ts").alias("start_time"), F.col("value").alias("duration"),
        (F.col("event_id") % 50 + 1).alias("records"), (F.col("event_id") % 5000).alias("facts"), F.when(F.col("event_type") == "error", "error").otherwise("success").alias("status"),
    )


def perf_summary(log: DataFrame, by: list[str]) -> DataFrame:
    """Count, mean, least, most, median and 95th percentile of the duration, and records a second."""
    g = log.groupBy(*by).agg(F.count("*").alias("n"), F.round(F.avg("duration"), 6).alias("mean"), F.min("duration").alias("least"), F.max("duration").alias("most"), F.sum("records").alias("records"), F.round(F.sum("records") / F.nullif(F.sum("duration"), F.lit(0)), 6).alias("per_second"))
    p = percentiles(log, by, "duration", {"median": 0.5, "p95": 0.95})
    return g.join(p, by).select(*by, "n", "mean", "least", "most", F.round("median", 6).alias("median"), F.round("p95", 6).alias("p95"), "records", "per_second")


def percentiles(df: DataFrame, by: list[str], value: str, shares: dict[str, float], cells: int = 4096) -> DataFrame:
    """Exact, interpolated percentiles of a number (not null) in each group, whatever the size of the groups.

    Values are counted, and each group's range is cut into cells. Counts tell which cells hold the places wanted; only these are
    put in order, each by itself.
    """
    counts = df.groupBy(*by, value).agg(F.count("*").alias("_k"))
    edges = counts.groupBy(*by).agg(F.min(value).alias("_lo"), F.max(value).alias("_hi"), F.sum("_k").alias("_n"))
    wide = F.nullif(F.col("_hi") - F.col("_lo"), F.lit(0))
    placed = counts.join(edges, by).withColumn("_cell", F.coalesce(F.floor((F.col(value) - F.col("_lo")) / wide * cells), F.lit(0)))
    first = Window.partitionBy(*by).orderBy("_cell").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy(*by, "_cell", "_n").agg(F.sum("_k").alias("_size")).withColumn("_start", F.coalesce(F.sum("_size").over(first), F.lit(0)))
    at = [F.struct(F.lit(name).alias("name"), (F.floor((F.col("_n") - 1) * q) + step).alias("place"), F.lit(step).alias("step"), ((F.col("_n") - 1) * q).alias("exact")) for name, q in shares.items() for step in (0, 1)]
    wanted = starts.select(*by, "_cell", "_start", F.explode(F.filter(F.array(*at), lambda x: (F.least(x.place, F.col("_n") - 1) >= F.col("_start")) & (F.least(x.place, F.col("_n") - 1) < F.col("_start") + F.col("_size")))).alias("_w"), "_n")
    inner = Window.partitionBy(*by, "_cell").orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    cell = placed.drop("_n").join(wanted.select(*by, "_cell", "_start").distinct(), [*by, "_cell"]).withColumn("_upto", F.col("_start") + F.sum("_k").over(inner))
    hit = cell.drop("_start").join(wanted.drop("_start"), [*by, "_cell"])
    place = F.least(F.col("_w.place"), F.col("_n") - 1)
    hit = hit.where((place < F.col("_upto")) & (place >= F.col("_upto") - F.col("_k")))
    share = F.col("_w.exact") - F.floor("_w.exact")
    part = F.when(F.col("_w.step") == 0, 1 - share).otherwise(share)
    return hit.groupBy(*by).agg(*[F.sum(F.when(F.col("_w.name") == name, part * F.col(value))).alias(name) for name in shares])


def within(log: DataFrame, as_of: str, hours: int) -> DataFrame:
    """Rows of the `hours` before the end of the day as_of."""
    end = F.lit(as_of).cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
    return log.where(F.col("start_time") >= end - F.expr(f"INTERVAL {hours} HOUR"))


def perf_slowest(log: DataFrame, top: int = 20) -> DataFrame:
    """The slowest updates of countries and of users, `top` of each."""
    w = Window.partitionBy("kind").orderBy(F.desc("duration"), "log_id")
    return log.where(F.col("kind").isin("countries", "users")).withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select("kind", "place", "log_id", "entity_id", "duration", "facts", F.round(F.col("records") / F.nullif(F.col("duration"), F.lit(0)), 2).alias("per_second"))


def perf_slow_entities(log: DataFrame, over: dict[str, float]) -> DataFrame:
    """Entities whose mean duration is above their kind's bound."""
    g = log.where(F.col("kind").isin(*over)).groupBy("kind", "entity_id").agg(F.count("*").alias("n"), F.round(F.avg("duration"), 6).alias("mean"))
    bound = F.lit(None).cast("double")
    for kind, most in over.items():
        bound = F.when(F.col("kind") == kind, most).otherwise(bound)
    return g.where(F.col("mean") > bound)


def perf_week_compare(log: DataFrame, as_of: str) -> DataFrame:
    """The week up to as_of and the one before it, by kind."""
    ago = F.datediff(F.lit(as_of).cast("date"), F.to_date("start_time"))
    week = F.when(ago.between(0, 6), "current").when(ago.between(7, 13), "previous")
    return log.withColumn("week", week).where("week IS NOT NULL").groupBy("kind", "week").agg(F.count("*").alias("n"), F.round(F.avg("duration"), 6).alias("mean"), count_of(F.col("status") == "error").alias("errors"))


def perf_facts_buckets(log: DataFrame) -> DataFrame:
    band = F.when(F.col("facts") < 100, "0-99").when(F.col("facts") < 1000, "100-999").otherwise("1000+")
    return log.groupBy(band.alias("band")).agg(F.count("*").alias("n"), F.round(F.avg("duration"), 6).alias("mean"), F.round(F.lit(1000.0) * F.sum("duration") / F.sum("facts"), 6).alias("ms_per_fact"))


def daily_achievements(f: DataFrame, least: int = 100, top: int = 20) -> DataFrame:
    """Days on which a user opened `least` notes or more, or closed as many; the newest of each user."""
    n = f.groupBy("action_user", "action_date").agg(count_of(is_("opened")).alias("opened"), count_of(is_("closed")).alias("closed")).where((F.col("opened") >= least) | (F.col("closed") >= least))
    return n.withColumn("place", F.row_number().over(Window.partitionBy("action_user").orderBy(F.desc("action_date")))).where(F.col("place") <= top)


def close_quality(history: DataFrame, e: str) -> DataFrame:
    """Share of closes with a comment, in whole per cent, and its class."""
    share = F.floor(F.lit(100) * F.col("whole_closed_with_comment") / F.col("whole_closed")).cast("long")
    return history.where("whole_closed > 0").select(e, share.alias("pct")).withColumn("quality", F.when(F.col("pct") >= 80, "Excellent").when(F.col("pct") >= 60, "Good").when(F.col("pct") >= 40, "Fair").otherwise("Needs improvement"))


def zero_days(f: DataFrame, e: str, as_of: str) -> DataFrame:
    """Days from the first action to as_of without any action."""
    return f.groupBy(e).agg((F.datediff(F.lit(as_of).cast("date"), F.min("action_date")) + 1 - F.countDistinct("action_date")).alias("days"))


def most_by_year(f: DataFrame, e: str, action: str, top: int = 10) -> DataFrame:
    """Notes with most actions of a kind in each year."""
    n = f.where(is_(action)).groupBy(e, F.year("action_date").alias("year"), "note_id").agg(F.count("*").alias("n"))
    w = Window.partitionBy(e, "year").orderBy(F.desc("n"), "note_id")
    return n.withColumn("place", F.row_number().over(w)).where(F.col("place") <= top)
