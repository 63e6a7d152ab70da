"""Documents of users, countries and the whole: the mart families put together, with lists, as they are published."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import global_mart as G
from . import marts as M

#: Contributor types by number, from 1.
CONTRIBUTORS = [
    "Normal Notero", "Just starting notero", "Newbie Notero", "All-time notero", "Hit-and-run notero", "Junior notero", "Inactive notero", "Retired notero", "Forgotten notero", "Exporadic notero",
    "Start closing notero", "Casual notero", "Power closing notero", "Power notero", "Crazy closing notero", "Crazy notero", "Addicted closing notero", "Addicted notero", "Epic closing notero",
    "Epic notero", "Bot closing notero", "Robot notero", "OoM Exception notero",
]
#: The name of the member for unknown countries.
NOWHERE = "International waters"
#: Fields of the indexes, and of the summary of the global mart.
USER_INDEX = [
    "user_id", "username", "id_contributor_type", "contributor_type_name", "date_starting_creating_notes", "history_whole_open", "history_whole_closed", "history_whole_commented", "history_year_open",
    "history_year_closed", "history_year_commented", "avg_days_to_resolution", "resolution_rate", "notes_resolved_count", "notes_still_open_count", "user_response_time", "days_since_last_action",
    "notes_created_last_30_days", "notes_resolved_last_30_days",
]
COUNTRY_INDEX = [
    "country_id", "country_name", "country_name_es", "country_name_en", "date_starting_creating_notes", "history_whole_open", "history_whole_closed", "history_whole_commented", "history_year_open",
    "history_year_closed", "history_year_commented", "avg_days_to_resolution", "resolution_rate", "notes_resolved_count", "notes_still_open_count", "notes_health_score", "new_vs_resolved_ratio",
    "notes_created_last_30_days", "notes_resolved_last_30_days",
]
SUMMARY = [
    "currently_open_count", "currently_closed_count", "history_whole_open", "history_whole_closed", "history_whole_reopened", "history_year_open", "history_year_closed", "history_year_reopened",
    "avg_days_to_resolution", "median_days_to_resolution", "avg_days_to_resolution_current_year", "median_days_to_resolution_current_year", "resolution_rate", "notes_created_last_30_days",
    "notes_resolved_last_30_days", "notes_backlog_size", "active_users_count",
]


def _scalars(f: DataFrame, st: DataFrame, e: str, as_of: date) -> DataFrame:
    """The single fields that users and countries share, under their published names."""
    h = M.history(f, e, as_of)
    h = h.select(e, *[F.col(c).alias(f"history_{c}") for c in h.columns if c != e])
    notes = [F.col(f"{which}_{a}_note").alias(f"{which}_{name}_note_id") for which in ("first", "latest") for a, name in (("opened", "open"), ("commented", "commented"), ("closed", "closed"), ("reopened", "reopened"))]
    since = F.datediff(F.lit(as_of), F.to_date("last_action"))
    first = M.first_last(f, e).select(e, F.col("date_first_opened").alias("date_starting_creating_notes"), F.col("date_first_closed").alias("date_starting_solving_notes"), *notes, since.alias("days_since_last_action"))
    r = M.resolution(f, e)
    r = r.select(e, F.col("avg_days").alias("avg_days_to_resolution"), F.col("median_days").alias("median_days_to_resolution"), F.col("rate").alias("resolution_rate"), F.col("resolved").alias("notes_resolved_count"), F.col("still_open").alias("notes_still_open_count"))
    health = M.health(f, st, e, as_of)
    health = health.select(e, F.col("open_notes").alias("active_notes_count"), *[F.col(c) for c in health.columns if c.startswith("age_")], F.col("created_30").alias("notes_created_last_30_days"), F.col("resolved_30").alias("notes_resolved_last_30_days"))
    apps = M.applications(f, e).select(e, F.col("names").alias("applications_used"), F.col("most_used").alias("most_used_application"), F.col("mobile").alias("mobile_apps_count"), F.col("desktop").alias("desktop_apps_count"))
    return h.join(first, e).join(r, e).join(health, e).join(apps, e, "left").join(M.activity(f, e, as_of).withColumnRenamed("activity", "last_year_activity"), e)


def users(f: DataFrame, st: DataFrame, names: DataFrame, as_of: date) -> DataFrame:
    """The user mart: one row for each named user."""
    e = "action_user"
    kind = F.get(F.array(*[F.lit(x) for x in CONTRIBUTORS]), F.col("contributor_type") - 1)
    own = M.contributor_type(f, as_of).select(e, F.col("contributor_type").alias("id_contributor_type"), kind.alias("contributor_type_name"))
    answer = M.response_time(f).withColumnRenamed("days", "user_response_time")
    j = _scalars(f, st, e, as_of).join(own, e).join(answer, e, "left").join(names.select(F.col("user_id").alias(e), "username"), e)
    return j.withColumnRenamed(e, "user_id")


def countries(f: DataFrame, st: DataFrame, names: DataFrame, as_of: date) -> DataFrame:
    """The country mart: one row for each country with notes, that of no country included."""
    e = "country"
    score = M.health_score(M.resolution(f, e), M.health(f, st, e, as_of), e).select(e, F.round("score", 6).alias("notes_health_score"))
    ratio = M.new_vs_resolved(M.health(f, st, e, as_of), e).withColumnRenamed("ratio", "new_vs_resolved_ratio")
    named = names.select(F.col("country_id").alias(e), "country_name", "country_name_es", "country_name_en")
    j = _scalars(f, st, e, as_of).join(score, e).join(ratio, e).join(F.broadcast(named), e, "left")
    return j.select(F.col(e).alias("country_id"), *[F.coalesce(c, F.lit(NOWHERE)).alias(c) if c.startswith("country_name") else F.col(c) for c in j.columns if c != e])


def gathered(rows: DataFrame, e: str, item: list[str], lists: dict[str, Column]) -> DataFrame:
    """For each entity, lists of the items that a condition holds for, in the order of the items."""
    return rows.groupBy(e).agg(*[F.array_sort(F.collect_list(F.when(cond, F.struct(*item)))).alias(name) for name, cond in lists.items()])


def lists(f: DataFrame, t: DataFrame, e: str, other: str, as_of: date) -> DataFrame:
    """The lists of a document: dates, tags, the other entities by role and span, hours of the week, years."""
    a, things = F.col("action"), {"action_user": "users", "country": "countries"}[other]
    roles = {"open": "opened", "solving": "closed"}
    spans = {"": "all", "_current_month": "month", "_current_day": "day"}
    parts = [
        gathered(M.dates_most(f, e), e, ["rank", "key", "n"], {"dates_most_open": a == "opened", "dates_most_closed": a == "closed"}),
        gathered(M.tag_lists(t, e), e, ["rank", "key", "n"], {"hashtags": F.lit(True)}),
        tag_metrics(t, e),
        gathered(M.pair_rankings(f, e, other, as_of), e, ["rank", "key", "n"], {f"{things}_{role}_notes{end}": (a == action) & (F.col("span") == span) for role, action in roles.items() for end, span in spans.items()}),
        gathered(M.working_hours(f, e), e, ["dow", "hour", "n"], {f"working_hours_of_week_{k}": a == v for k, v in (("opening", "opened"), ("commenting", "commented"), ("closing", "closed"))}),
        gathered(M.history_by_year(f, e), e, ["year", *M.MEASURES], {"history_by_year": F.lit(True)}),
    ]
    out = f.select(e).distinct()
    for part in parts:
        out = out.join(part, e, "left")
    return out


def tag_metrics(t: DataFrame, e: str) -> DataFrame:
    """Top tags of each entity by what the action does, the first of them, and the uses that the top ones sum to."""
    top = M.tag_lists_by_action(t, e)
    a = F.col("action")
    own = gathered(top, e, ["rank", "key", "n"], {"hashtags_opening": a == "opened", "hashtags_resolution": a == "closed", "hashtags_comments": a == "commented"})
    total = lambda c: F.aggregate(c, F.lit(0).cast("long"), lambda s, x: s + x.n)
    return own.select("*", F.get("hashtags_opening", 0)["key"].alias("favorite_opening_hashtag"), F.get("hashtags_resolution", 0)["key"].alias("favorite_resolution_hashtag"), total("hashtags_opening").alias("opening_hashtag_count"), total("hashtags_resolution").alias("resolution_hashtag_count"))


def index_order(mart: DataFrame, key: str) -> list[Column]:
    """Most opened first, then most closed."""
    return [F.desc_nulls_last("history_whole_open"), F.desc_nulls_last("history_whole_closed"), F.col(key).asc()]


def overall(f: DataFrame, st: DataFrame, as_of: date) -> DataFrame:
    """The global mart: one row."""
    names = {"opened": "open", "commented": "commented", "closed": "closed", "reopened": "reopened", "hidden": "hidden"}
    counts = G.counts(f, as_of)
    out = counts.select(*[F.col(f"{span}_{a}").alias(f"history_{span}_{n}") for span in ("whole", "year") for a, n in names.items()])
    r = G.resolution(f, as_of)
    out = out.crossJoin(r.select(F.col("avg_days").alias("avg_days_to_resolution"), F.col("median_days").alias("median_days_to_resolution"), F.col("avg_days_year").alias("avg_days_to_resolution_current_year"), F.col("median_days_year").alias("median_days_to_resolution_current_year"), F.col("rate").alias("resolution_rate")))
    out = out.crossJoin(G.status(st, f, as_of).select(F.col("open_notes").alias("currently_open_count"), F.col("closed_notes").alias("currently_closed_count"), F.col("backlog").alias("notes_backlog_size")))
    out = out.crossJoin(G.last_days(f, as_of).select(F.col("created").alias("notes_created_last_30_days"), F.col("resolved").alias("notes_resolved_last_30_days"), F.col("active_users").alias("active_users_count")))
    out = out.crossJoin(G.comment_metrics(f).select(F.col("avg_length").alias("avg_comment_length"), F.col("url_pct").alias("comments_with_url_pct"), F.col("mention_pct").alias("comments_with_mention_pct")))
    out = out.crossJoin(G.closed_with_comment(f, as_of).select(F.col("whole").alias("history_whole_closed_with_comment"), F.col("year").alias("history_year_closed_with_comment")))
    out = out.crossJoin(G.first_dates(f).select(F.col("first_opened").alias("date_starting_creating_notes"), F.col("first_closed").alias("date_starting_solving_notes"), F.col("last_at").alias("last_action_timestamp")))
    return out.crossJoin(G.comments_per_note(f).select(F.col("mean").alias("avg_comments_per_note")))  # one row each


def ranks(f: DataFrame, e: str) -> DataFrame:
    """Place of each entity among all by notes opened and closed."""
    from .rankings import placed

    out = f.select(e).distinct()
    for action, name in (("opened", "rank_open"), ("closed", "rank_closed")):
        n = f.where(M.is_(action)).groupBy(e).agg(F.countDistinct("note_id").alias("n"))
        out = out.join(placed(n).select(e, F.col("rank").alias(name)), e, "left")
    return out
