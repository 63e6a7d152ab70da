"""Metric families of the marts: every entity at once, one grouping per family.

`e` names the entity column of the facts: country, or action_user. On an opened or closed row the acting user is the
opener or closer, so that one column serves all roles.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import columns as C

#: Kept places of top lists, of tag lists by action, and days of the activity text.
TOP, TOP_TAGS, DAYS = 50, 10, 371


def is_(action: str) -> Column:
    return F.col("action") == action


def count_of(cond: Column) -> Column:
    return F.count_if(F.coalesce(cond, F.lit(False)))


def with_closing_texts(f: DataFrame) -> DataFrame:
    """Adds `texts`: on closed rows the number of the note's closes that have a text, else 0."""
    has = is_("closed") & (F.col("comment_length") > 0)
    return f.withColumn("texts", F.when(is_("closed"), F.count_if(has).over(Window.partitionBy("note_id"))).otherwise(0))


def _five(cond: Column | None = None) -> list[Column]:
    on = lambda x: x if cond is None else x & cond
    return [
        count_of(on(is_("opened"))), count_of(on(is_("commented"))), count_of(on(is_("closed"))),
        F.coalesce(F.sum(F.when(on(is_("closed")), F.col("texts"))), F.lit(0)), count_of(on(is_("reopened"))),
    ]


MEASURES = ("open", "commented", "closed", "closed_with_comment", "reopened")


def history(f: DataFrame, e: str, as_of: date) -> DataFrame:
    """The five measures over all time, the year, the month and the day of as_of."""
    d, at = F.col("action_date"), F.lit(as_of)
    spans = {"whole": None, "year": F.year(d) == F.year(at), "month": F.trunc(d, "month") == F.trunc(at, "month"), "day": d == at}
    cols = [c.alias(f"{span}_{m}") for span, cond in spans.items() for m, c in zip(MEASURES, _five(cond), strict=True)]
    return with_closing_texts(f).groupBy(e).agg(*cols)


def history_by_year(f: DataFrame, e: str) -> DataFrame:
    return with_closing_texts(f).groupBy(e, F.year("action_date").alias("year")).agg(*[c.alias(m) for m, c in zip(MEASURES, _five(), strict=True)])


def first_last(f: DataFrame, e: str) -> DataFrame:
    """First dates, and the first and the latest note of each action; notes of one time go by sequence and id."""
    key = F.struct("action_at", "seq", "note_id")
    cols = [F.min("action_date").alias("first_action"), F.max("action_at").alias("last_action")]
    for a in ("opened", "commented", "closed", "reopened"):
        own = F.when(is_(a), key)
        cols += [F.min(F.when(is_(a), F.col("action_date"))).alias(f"date_first_{a}"), F.min(own)["note_id"].alias(f"first_{a}_note"), F.max(own)["note_id"].alias(f"latest_{a}_note")]
    return f.groupBy(e).agg(*cols)


def ranked(counts: DataFrame, by: list[str], value: str = "n", top: int = TOP, name: str = "key") -> DataFrame:
    """The first `top` rows of each group by value, ties by name, with their RANK."""
    w = Window.partitionBy(*by)
    order = [F.desc(value), F.col(name)]
    return counts.withColumn("row", F.row_number().over(w.orderBy(*order))).withColumn("rank", F.rank().over(w.orderBy(F.desc(value)))).where(F.col("row") <= top).drop("row")


def dates_most(f: DataFrame, e: str) -> DataFrame:
    """Busiest dates by opens and by closes."""
    n = f.where(F.col("action").isin("opened", "closed")).groupBy(e, "action", F.col("action_date").alias("key")).agg(F.count("*").alias("n"))
    return ranked(n, [e, "action"])


def working_hours(f: DataFrame, e: str) -> DataFrame:
    n = f.where(F.col("action").isin("opened", "commented", "closed"))
    return n.groupBy(e, "action", F.floor(F.col("action_how") / 100).cast("int").alias("dow"), (F.col("action_how") % 100).cast("int").alias("hour")).agg(F.count("*").alias("n"))


def _note_flags(f: DataFrame, e: str) -> DataFrame:
    return f.groupBy(e, "note_id").agg(F.max(is_("opened")).alias("opened"), F.max(is_("closed")).alias("closed"))


def resolution(f: DataFrame, e: str) -> DataFrame:
    """Days to resolution, notes closed, notes opened but never closed (by the entity), and the rate."""
    days = f.groupBy(e).agg(F.avg("days_to_resolution").alias("avg_days"), F.percentile("days_to_resolution", F.lit(0.5)).alias("median_days"))
    notes = _note_flags(f, e).groupBy(e).agg(count_of(F.col("closed")).alias("resolved"), count_of(F.col("opened") & ~F.col("closed")).alias("still_open"))
    total = F.col("resolved") + F.col("still_open")
    return days.join(notes, e).withColumn("rate", F.when(total > 0, F.lit(100.0) * F.col("resolved") / total))


def resolution_by(f: DataFrame, e: str, period: str) -> DataFrame:
    """By year or month of the action: days to resolution, closes, openings, and their ratio."""
    p = F.trunc("action_date", period).alias("period")
    g = f.where(F.col("action").isin("opened", "closed")).groupBy(e, p).agg(
        F.avg("days_to_resolution").alias("avg_days"), F.percentile("days_to_resolution", F.lit(0.5)).alias("median_days"), F.countDistinct(F.when(is_("closed"), F.col("note_id"))).alias("resolved"), F.countDistinct(F.when(is_("opened"), F.col("note_id"))).alias("opened")
    )
    return g.withColumn("rate", F.when(F.col("opened") > 0, F.lit(100.0) * F.col("resolved") / F.col("opened")))


def applications(f: DataFrame, e: str) -> DataFrame:
    """Distinct applications, the most used (ties by name), and how many are mobile or for the web."""
    n = f.where("app IS NOT NULL").groupBy(e, "app", "platform").agg(F.count("*").alias("n"))
    best = F.min(F.struct((-F.col("n")).alias("m"), "app"))["app"]
    mobile, desktop = C.is_mobile(F.col("platform")), C.is_desktop(F.col("platform"))
    return n.groupBy(e).agg(F.count("*").alias("apps"), F.array_join(F.array_sort(F.collect_set("app")), ",").alias("names"), best.alias("most_used"), count_of(mobile).alias("mobile"), count_of(desktop).alias("desktop"))


def shares(f: DataFrame, e: str, what: list[str]) -> DataFrame:
    """Per year: count and share of each application, or version of one."""
    n = f.where(F.col(what[-1]).isNotNull()).groupBy(e, F.year("action_date").alias("year"), *what).agg(F.count("*").alias("n"))
    return n.withColumn("pct", F.lit(100.0) * F.col("n") / F.sum("n").over(Window.partitionBy(e, "year")))


def comment_quality(f: DataFrame, e: str) -> DataFrame:
    said = f.where(F.col("comment_length") > 0)
    g = said.groupBy(e).agg(F.avg("comment_length").alias("avg_length"), count_of(F.col("has_url")).alias("with_url"), count_of(F.col("has_mention")).alias("with_mention"), F.count("*").alias("comments"), F.countDistinct("note_id").alias("notes"))
    share = lambda c: F.lit(100.0) * F.col(c) / F.col("comments")
    return g.select(e, "avg_length", "with_url", share("with_url").alias("url_pct"), "with_mention", share("with_mention").alias("mention_pct"), (F.col("comments").cast("double") / F.col("notes")).alias("per_note"))


def health(f: DataFrame, status: DataFrame, e: str, as_of: date) -> DataFrame:
    """Open notes of the entity's openings by age, and what the last 30 days opened and closed."""
    opened = f.where(is_("opened")).select(e, "note_id", "opened_date").join(status.where("is_open").select("note_id"), "note_id")
    age = C.age_band(F.datediff(F.lit(as_of), F.col("opened_date")))
    ages = opened.groupBy(e).agg(F.count("*").alias("open_notes"), *[count_of(age == b).alias(f"age_{b}") for b in ("0_7", "8_30", "31_90", "90_plus")])
    late = F.col("action_date") >= F.date_sub(F.lit(as_of), 30)
    recent = f.groupBy(e).agg(count_of(is_("opened") & late).alias("created_30"), count_of(is_("closed") & late).alias("resolved_30"), count_of(is_("opened") & (F.col("action_date") < F.date_sub(F.lit(as_of), 7))).alias("older"))
    out = recent.join(ages, e, "left").drop("older")
    return out.select(e, *[F.coalesce(c, F.lit(0)).alias(c) for c in out.columns if c != e])


def new_vs_resolved(h: DataFrame, e: str) -> DataFrame:
    """Created for each resolved in 30 days; 999.99 if none was resolved, 0 if nothing happened."""
    c, r = F.col("created_30"), F.col("resolved_30")
    return h.select(e, F.when(r > 0, c.cast("double") / r).when(c > 0, 999.99).otherwise(0.0).alias("ratio"))


def health_score(res: DataFrame, h: DataFrame, e: str) -> DataFrame:
    """0.4 rate + 0.3 (100 - open share, at most 100) + 0.3 recent share of resolved, at most 100."""
    j = res.join(h, e)
    share = F.least(F.lit(100.0), F.coalesce(F.lit(100.0) * F.col("open_notes") / F.nullif(F.col("resolved") + F.col("still_open"), F.lit(0)), F.lit(0.0)))
    recent = F.when(F.col("created_30") > 0, F.least(F.lit(100.0), F.lit(100.0) * F.col("resolved_30") / F.col("created_30"))).otherwise(0.0)
    return j.select(e, (0.4 * F.coalesce("rate", F.lit(0.0)) + 0.3 * (F.lit(100.0) - share) + 0.3 * recent).alias("score"))


def note_quality(f: DataFrame, e: str) -> DataFrame:
    """Opening texts by length; a missing text counts as none."""
    k = C.length_class(F.coalesce("comment_length", F.lit(0)))
    return f.where(is_("opened")).groupBy(e).agg(*[count_of(k == c).alias(c) for c in ("poor", "fair", "good", "complex", "treatise")])


def peaks(f: DataFrame, e: str) -> DataFrame:
    """Busiest opening date and hour of the week; of equal ones the latest."""
    o = f.where(is_("opened"))
    top = lambda key, name: o.groupBy(e, key).agg(F.count("*").alias("n")).groupBy(e).agg(F.max(F.struct("n", key))[key].alias(name))
    return top("action_date", "peak_day").join(top("action_how", "peak_hour"), e)


def tag_lists(t: DataFrame, e: str) -> DataFrame:
    """Most used tags of each entity with rank."""
    return ranked(t.groupBy(e, F.col("tag").alias("key")).agg(F.count("*").alias("n")), [e])


def tag_lists_by_action(t: DataFrame, e: str) -> DataFrame:
    n = t.where(F.col("action").isin("opened", "closed", "commented")).groupBy(e, "action", F.col("tag").alias("key")).agg(F.count("*").alias("n"))
    return ranked(n, [e, "action"], top=TOP_TAGS)


def activity(f: DataFrame, e: str, as_of: date, days: int = DAYS) -> DataFrame:
    """One score for each of the last days, oldest first, as text."""
    n = f.where((F.col("action_date") > F.date_sub(F.lit(as_of), days)) & (F.col("action_date") <= F.lit(as_of))).groupBy(e, F.datediff(F.lit(as_of), F.col("action_date")).alias("ago")).agg(F.count("*").alias("n"))
    scores = n.groupBy(e).agg(F.map_from_entries(F.collect_list(F.struct("ago", C.activity_score(F.col("n")).cast("string").alias("s")))).alias("m"))
    line = F.array_join(F.transform(F.sequence(F.lit(days - 1), F.lit(0), F.lit(-1)), lambda d: F.coalesce(F.try_element_at("m", d), F.lit("0"))), "")
    return f.select(e).distinct().join(scores, e, "left").select(e, F.coalesce(F.when(F.col("m").isNotNull(), line), F.lit("0" * days)).alias("activity"))


def rolled(activity_text: Column, today: Column) -> Column:
    """The text a day later: the oldest day goes, today's score comes."""
    return F.concat(F.substring(activity_text, 2, DAYS - 1), today.cast("string"))


def pair_rankings(f: DataFrame, e: str, other: str, as_of: date) -> DataFrame:
    """Top openers and closers of each entity over all time, the month and the day."""
    d, at = F.col("action_date"), F.lit(as_of)
    spans = F.array(F.lit("all"), F.when(F.trunc(d, "month") == F.trunc(at, "month"), "month"), F.when(d == at, "day"))
    rows = f.where(F.col("action").isin("opened", "closed")).select(e, "action", F.col(other).alias("key"), F.explode(F.array_compact(spans)).alias("span"))
    return ranked(rows.groupBy(e, "action", "span", "key").agg(F.count("*").alias("n")), [e, "action", "span"])


def year_rankings(f: DataFrame, e: str, other: str) -> DataFrame:
    rows = f.where(F.col("action").isin("opened", "closed")).groupBy(e, "action", F.year("action_date").alias("year"), F.col(other).alias("key")).agg(F.count("*").alias("n"))
    return ranked(rows, [e, "action", "year"])


def open_by_year(status: DataFrame, f: DataFrame, e: str) -> DataFrame:
    o = f.where(is_("opened")).select(e, "note_id", F.year("opened_date").alias("year"))
    return o.join(status.where("is_open").select("note_id"), "note_id").groupBy(e, "year").agg(F.count("*").alias("n"))


def longest_resolution(f: DataFrame, e: str, top: int = 10) -> DataFrame:
    w = Window.partitionBy(e).orderBy(F.desc("days_to_resolution"), "note_id", "seq")
    return f.where("days_to_resolution IS NOT NULL").withColumn("place", F.row_number().over(w)).where(F.col("place") <= top).select(e, "place", "note_id", "days_to_resolution")


def years_with_changes(f: DataFrame, e: str) -> DataFrame:
    return f.select(e, F.year("action_date").alias("year")).distinct()


def work_list(f: DataFrame, e: str) -> DataFrame:
    return f.groupBy(e).agg(F.max("action_at").alias("last_action"), F.count("*").alias("n"))


def prioritised(f: DataFrame, modified: DataFrame, e: str, as_of: date, limit: int = 500) -> DataFrame:
    """Modified entities in the order of work, with their place: by how recent their last action is, how active they are, their actions and their
    last action; the first `limit`."""
    g = work_list(f.join(modified, e, "left_semi"), e)
    at = F.lit(as_of).cast("timestamp_ntz")
    since = lambda days: F.col("last_action") >= at - F.expr(f"INTERVAL {days} DAY")
    recency = F.when(since(7), 1).when(since(30), 2).when(since(90), 3).otherwise(4)
    g = g.withColumn("recency", recency).withColumn("activity", F.when(F.col("n") > 100, 1).when(F.col("n") > 10, 2).otherwise(3))
    order = ["recency", "activity", F.desc("n"), F.desc_nulls_last("last_action"), e]
    return g.orderBy(*order).limit(limit).withColumn("place", F.row_number().over(Window.orderBy(*order)))  # `limit` rows


def low_activity(f: DataFrame, most: int = 20, width: int = 100) -> DataFrame:
    """Users with at most `most` actions, and the batch of ids that each is in."""
    return work_list(f, "action_user").where(F.col("n") <= most).select("action_user", "n", F.floor(F.col("action_user") / width).alias("batch"))


def modes(f: DataFrame, e: str) -> DataFrame:
    """Most common ISO week, quarter, month, hour of the week and period of the day; of equal ones the largest."""
    cols = {"week": F.weekofyear("action_date"), "quarter": F.quarter("action_date"), "month": F.month("action_date"), "how": F.col("action_how"), "period": C.period_of_day(F.col("action_how") % 100)}
    out = None
    for name, c in cols.items():
        one = f.groupBy(e, c.alias("k")).agg(F.count("*").alias("n")).groupBy(e).agg(F.max(F.struct("n", "k"))["k"].alias(name))
        out = one if out is None else out.join(one, e)
    return out


def contributor_type(f: DataFrame, as_of: date) -> DataFrame:
    """Class of each user. Openings count every action on the user's notes; the quotient is that of integers."""
    own = f.groupBy("action_user").agg(F.min("action_date").alias("first"), F.max("action_date").alias("last"), F.count("*").alias("actions"), count_of(is_("closed")).alias("closed"))
    opened = f.groupBy(F.col("opened_user").alias("action_user")).agg(F.count("*").alias("opened"))
    j = own.join(opened, "action_user", "left")
    quotient = F.floor(F.col("closed") / (F.coalesce("opened", F.lit(0)) + 1))
    at, year = F.lit(as_of), as_of.year
    kind = (
        F.when(F.col("first") > F.date_sub(at, 30), 2)
        .when(F.col("first") > F.date_sub(at, 90), 3)
        .when((F.year("first") == 2013) & (F.year("first") == year), 4)
        .when(F.col("first") == F.col("last"), 5)
        .when(F.year("first").isin(year, year - 1), 6)
        .when(F.col("last") < F.date_sub(at, 720), 7)
        .when(F.col("actions") < 25, 10)
    )
    for k, (limit, closes) in enumerate(((100, 100), (400, 400), (1600, 1600), (6400, 6400), (25600, 25600), (102400, 102400))):
        kind = kind.when((F.col("closed") < closes) & (quotient > 1), 11 + 2 * k).when(F.col("actions") < limit, 12 + 2 * k)
    return j.select("action_user", kind.otherwise(23).alias("contributor_type"))


def response_time(f: DataFrame) -> DataFrame:
    """Mean days from a user's opening of a note to the user's first comment on it, where later."""
    own = f.where("action_user = opened_user AND action IN ('opened', 'commented')").groupBy("action_user", "note_id").agg(F.min(F.when(is_("opened"), F.col("action_at"))).alias("o"), F.min(F.when(is_("commented"), F.col("action_at"))).alias("c"))
    gap = (F.unix_micros(F.col("c").cast("timestamp")) - F.unix_micros(F.col("o").cast("timestamp"))) / 86400e6
    return own.where("c > o").groupBy("action_user").agg(F.round(F.avg(gap), 6).alias("days"))


def collaboration(f: DataFrame) -> DataFrame:
    """Mentions given, mentions by others on own notes, replies on notes already commented, and their sum."""
    given = f.groupBy("action_user").agg(count_of(F.col("has_mention")).alias("given"), count_of(is_("commented") & (F.col("prior_commented") > 0)).alias("replies"))
    got = f.where("has_mention AND action_user <> opened_user").groupBy(F.col("opened_user").alias("action_user")).agg(F.count("*").alias("received"))
    j = given.join(got, "action_user", "left").withColumn("received", F.coalesce("received", F.lit(0)))
    return j.select("action_user", "given", "received", "replies", (F.col("given") + F.col("received") + F.col("replies")).alias("score"))
