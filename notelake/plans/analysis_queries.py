"""Queries of dimensions, rankings, tags, levels, checks and the global mart, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import checks as K
from ..operators import dimensions as D
from ..operators import marts as M
from ..operators import rankings as R
from ..operators.status import current
from .mart_queries import Plan
from .oracle import AS_OF, LOCATED, REGIONS, sql

_NOW = "TIMESTAMP '2024-01-31'"
#: The last day of the log, and a day with openings.
_LAST, _BUSY = date(2024, 1, 30), date(2024, 1, 2)

_PERIODS = {"": "true", "_year": f"year(action_date) = year({AS_OF})", "_month": f"date_trunc('month', action_date) = date_trunc('month', {AS_OF})", "_today": f"action_date = {AS_OF}"}


def _rank(key: str, where: str, n: str) -> str:
    return sql(f"SELECT * FROM (SELECT *, CAST(rank() OVER (ORDER BY n DESC) AS INTEGER) AS rank FROM (SELECT {key}, {n} AS n FROM f WHERE {where} GROUP BY {key})) WHERE rank <= 100")


RANKINGS: dict[str, Plan] = {
    f"rank_users_{a}{suffix}": (
        lambda w, a=a, suffix=suffix: R.users(w.facts, a, R.period(suffix[1:] or "all", w.as_of)),
        _rank("action_user", f"action = '{a}' AND action_user <> -1 AND {cond}", "count(*)" if a == "commented" else "count(DISTINCT note_id)"),
    )
    for a in ("opened", "closed", "commented", "reopened")
    for suffix, cond in _PERIODS.items()
    if a == "opened" or not suffix
} | {
    "rank_users_opened_today": (lambda w: R.users(w.facts, "opened", R.period("today", _BUSY)), _rank("action_user", "action = 'opened' AND action_user <> -1 AND action_date = DATE '2024-01-02'", "count(DISTINCT note_id)")),
    "rank_countries_opened": (lambda w: R.countries(w.facts, "opened"), _rank("country", "action = 'opened'", "count(DISTINCT note_id)")),
    "rank_countries_closed": (lambda w: R.countries(w.facts, "closed"), _rank("country", "action = 'closed'", "count(DISTINCT note_id)")),
    "rank_countries_open_now": (lambda w: R.placed(w.status.where("is_open").groupBy("country").agg(F.count("*").alias("n"))), sql("SELECT country, n, rank() OVER (ORDER BY n DESC) AS rank FROM (SELECT country, count(*) AS n FROM st WHERE is_open GROUP BY country)")),
    "rank_countries_resolution_rate": (
        lambda w: R.placed(M.resolution(w.facts, "country").select("country", F.round("rate", 6).alias("rate")), value="rate"),
        sql("SELECT country, rate, rank() OVER (ORDER BY rate DESC) AS rank FROM (SELECT country, round(100::DOUBLE * count(*) FILTER (c) / count(*) FILTER (c OR o), 6) AS rate FROM (SELECT country, note_id, bool_or(action = 'opened') AS o, bool_or(action = 'closed') AS c FROM f GROUP BY ALL) GROUP BY country)"),
    ),
}
_TAG = "SELECT tag, count(*) AS uses, count(DISTINCT country) AS countries, count(DISTINCT action_user) AS users, avg(days_to_resolution) AS avg_days, avg(comment_length) AS avg_length FROM tg {0} GROUP BY tag"
_ACTS = ", ".join(f"count(*) FILTER (action = '{a}') AS {a}" for a in ("opened", "commented", "closed", "reopened"))
_BAND = "CASE WHEN position = 1 THEN '1' WHEN position = 2 THEN '2' WHEN position <= 5 THEN '3-5' WHEN position <= 10 THEN '6-10' ELSE '11+' END"

TAGS: dict[str, Plan] = {
    "hashtags_opening": (lambda w: R.tag_usage(w.tags, ["opened"]), sql(_TAG.format("WHERE action = 'opened'"))),
    "hashtags_resolution": (lambda w: R.tag_usage(w.tags, ["closed"]), sql(_TAG.format("WHERE action = 'closed'"))),
    "hashtags_comments": (lambda w: R.tag_usage(w.tags, ["commented"]), sql(_TAG.format("WHERE action = 'commented'"))),
    "hashtags_top": (lambda w: R.tag_usage(w.tags), sql(_TAG.format(""))),
    "hashtags_by_action": (lambda w: R.tag_actions(w.tags, ["tag"]), sql(f"SELECT tag, {_ACTS}, count(DISTINCT note_id) AS notes FROM tg GROUP BY tag")),
    "hashtag_stats_user": (lambda w: R.tag_actions(w.tags, ["action_user", "tag"]), sql(f"SELECT action_user, tag, {_ACTS}, count(DISTINCT note_id) AS notes FROM tg GROUP BY ALL")),
    "hashtag_stats_country": (lambda w: R.tag_actions(w.tags, ["country", "tag"]), sql(f"SELECT country, tag, {_ACTS}, count(DISTINCT note_id) AS notes FROM tg GROUP BY ALL")),
    "hashtags_by_sequence": (lambda w: R.tag_bands(w.tags, "country"), sql(f"SELECT country, {_BAND} AS band, count(*) AS n, avg(position) AS mean_position FROM tg GROUP BY ALL")),
    "hashtags_by_sequence_user": (lambda w: R.tag_bands(w.tags, "action_user"), sql(f"SELECT action_user, {_BAND} AS band, count(*) AS n, avg(position) AS mean_position FROM tg GROUP BY ALL")),
    "hashtag_top_global": (lambda w: R.placed(w.tags.groupBy("tag").agg(F.count("*").alias("n"))), sql("SELECT tag, n, rank() OVER (ORDER BY n DESC) AS rank FROM (SELECT tag, count(*) AS n FROM tg GROUP BY tag)")),
    "hashtag_top_combined": (
        lambda w: M.ranked(w.tags.where(F.col("action").isin("opened", "closed")).groupBy("action", F.col("tag").alias("key")).agg(F.count("*").alias("n")), ["action"], top=10),
        sql("SELECT * EXCLUDE (rw) FROM (SELECT *, rank() OVER (PARTITION BY action ORDER BY n DESC) AS rank, row_number() OVER (PARTITION BY action ORDER BY n DESC, key) AS rw FROM (SELECT action, tag AS key, count(*) AS n FROM tg WHERE action IN ('opened', 'closed') GROUP BY ALL)) WHERE rw <= 10"),
    ),
    **{
        f"hashtag_notes_{kind}": (
            lambda w, e=e: R.tag_notes(w.facts, w.tags, e, "topic1"),
            sql(f"SELECT {e}, CAST(place AS INTEGER) AS place, note_id, seq, action, action_at FROM (SELECT *, row_number() OVER (PARTITION BY {e} ORDER BY action_at DESC, note_id DESC, seq DESC) AS place FROM f WHERE (note_id, seq) IN (SELECT (note_id, seq) FROM tg WHERE lower(tag) = 'topic1')) WHERE place <= 50"),
        )
        for kind, e in (("country", "country"), ("user", "action_user"))
    },
    "ml_hashtag_cooccurrence": (lambda w: R.tag_pairs(w.tags), sql("SELECT a, b, count(*) AS notes FROM (SELECT DISTINCT note_id, tag AS a FROM tg) JOIN (SELECT DISTINCT note_id, tag AS b FROM tg) USING (note_id) WHERE a < b GROUP BY ALL HAVING count(*) >= 3 ORDER BY notes DESC, a, b LIMIT 50")),
    "ml_hashtag_usage": (
        lambda w: w.tags.groupBy("tag").agg(F.count("*").alias("n")).crossJoin(F.broadcast(w.tags.agg(F.count("*").alias("total")))).select("tag", "n", (F.lit(100.0) * F.col("n") / F.col("total")).alias("pct")),
        sql("SELECT tag, count(*) AS n, 100::DOUBLE * count(*) / (SELECT count(*) FROM tg) AS pct FROM tg GROUP BY tag"),
    ),
    "ml_hashtag_by_outcome": (
        lambda w: w.tags.join(w.status.select("note_id", "is_open"), "note_id").groupBy("tag").agg(M.count_of(F.col("is_open")).alias("still_open"), M.count_of(~F.col("is_open")).alias("closed")),
        sql("SELECT tag, count(*) FILTER (is_open) AS still_open, count(*) FILTER (NOT is_open) AS closed FROM tg JOIN st USING (note_id) GROUP BY tag"),
    ),
    "ml_hashtag_by_app": (
        lambda w: w.facts.where("app IS NOT NULL").groupBy("app").agg(F.count("*").alias("notes"), M.count_of(F.array_size(F.array_remove("hashtags", "")) > 0).alias("tagged")).where("notes >= 5").select("app", "notes", (F.lit(100.0) * F.col("tagged") / F.col("notes")).alias("pct")),
        sql("SELECT app, count(*) AS notes, 100::DOUBLE * count(*) FILTER (len(list_filter(hashtags, lambda x: x <> '')) > 0) / count(*) AS pct FROM f WHERE app IS NOT NULL GROUP BY app HAVING count(*) >= 5"),
    ),
}

_LEVEL = "CASE " + " ".join(f"WHEN opened >= {o} AND closed >= {c} AND days >= {d} THEN '{n}'" for n, o, c, d in reversed(R.LEVELS[1:])) + " ELSE 'newcomer' END"
_RULES = ", ".join(f"('{b}', '{m}', {v})" for b, m, v in R.BADGES)
_RUN = "(SELECT action_user, max(n) AS {0} FROM (SELECT action_user, i - rn AS isl, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY action_user ORDER BY i) AS rn FROM (SELECT DISTINCT action_user, {1} AS i FROM f WHERE action IN ({2}))) GROUP BY ALL) GROUP BY action_user)"
_RUNS = [("day_run", "action_date - DATE '1970-01-01'", "'opened', 'closed'"), ("close_run", "action_date - DATE '1970-01-01'", "'closed'"), ("week_run", "(action_date - DATE '1970-01-01' + 3) // 7", "'opened', 'closed'"), ("month_run", "year(action_date) * 12 + month(action_date)", "'opened', 'closed'")]
def _measures(f: str) -> str:
    """The measures of badges over the facts `f`, in long form."""
    wide = f"""SELECT m.*, least(opened, closed, commented) AS all_round, {', '.join(f'coalesce({r[0]}, 0) AS {r[0]}' for r in _RUNS)} FROM (SELECT action_user, count(*) FILTER (action = 'opened') AS opened, count(*) FILTER (action = 'closed') AS closed, count(*) FILTER (action = 'commented') AS commented,
 count(*) FILTER (action = 'closed' AND comment_length > 0) AS closed_with_comment, count(*) FILTER (len(hashtags) > 0) AS tagged, count(*) FILTER (has_mention) AS mentions, count(*) FILTER (has_url) AS urls, count(*) FILTER (platform IN ('android', 'ios')) AS mobile, count(*) FILTER (platform = 'web') AS desktop,
 count(*) FILTER (action = 'opened' AND year(action_date) = 2024) AS year_opened, count(*) FILTER (action = 'closed' AND year(action_date) = 2024) AS year_closed, count(*) FILTER (action = 'commented' AND year(action_date) = 2024) AS year_commented,
 CAST(coalesce(floor(avg(comment_length)), 0) AS BIGINT) AS avg_length, coalesce(2024 - year(min(action_date) FILTER (action = 'opened')), 0) AS years, count(*) FILTER (action = 'opened' AND year(action_date) = 2013) AS early,
 count(*) FILTER (action = 'closed' AND action_at <= opened_at + INTERVAL 1 HOUR) AS speedy FROM {f} GROUP BY action_user) m {' '.join(f'LEFT JOIN {_RUN.format(*r).replace("FROM f ", f"FROM {f} ")} USING (action_user)' for r in _RUNS)}"""
    return f"SELECT action_user, measure, CAST(value AS BIGINT) AS value FROM (UNPIVOT (SELECT action_user, COLUMNS(* EXCLUDE action_user)::BIGINT FROM ({wide})) ON COLUMNS(* EXCLUDE action_user) INTO NAME measure VALUE value)"


_LONG = _measures("f")
#: Badges as published, written out here once more: name, measure, least value.
_PUBLISHED = """('First Note', 'opened', 1), ('First Close', 'closed', 1), ('First Comment', 'commented', 1),
 ('10 Notes Opened', 'opened', 10), ('50 Notes Opened', 'opened', 50), ('100 Notes Opened', 'opened', 100), ('500 Notes Opened', 'opened', 500), ('1000 Notes Opened', 'opened', 1000),
 ('10 Notes Closed', 'closed', 10), ('50 Notes Closed', 'closed', 50), ('100 Notes Closed', 'closed', 100), ('500 Notes Closed', 'closed', 500), ('1000 Notes Closed', 'closed', 1000),
 ('100 Comments', 'commented', 100), ('500 Comments', 'commented', 500), ('1000 Comments', 'commented', 1000),
 ('Daily Contributor', 'day_run', 7), ('Weekly Contributor', 'week_run', 4), ('Monthly Contributor', 'month_run', 3), ('Consistent Helper', 'close_run', 30),
 ('Speed Demon', 'speedy', 1), ('Problem Solver', 'closed_with_comment', 10), ('Community Helper', 'closed_with_comment', 50), ('Resolution Master', 'closed_with_comment', 100),
 ('Hashtag Enthusiast', 'tagged', 50), ('Mobile User', 'mobile', 100), ('Desktop Power User', 'desktop', 100),
 ('Early Adopter', 'early', 1), ('Long Time Helper', 'years', 5), ('Century Club', 'year_opened', 100), ('Resolution Champion', 'year_closed', 100), ('Comment King', 'year_commented', 100),
 ('Perfect Week', 'day_run', 7), ('Perfect Month', 'day_run', 30),
 ('Quality Contributor', 'avg_length', 50), ('Detail Oriented', 'avg_length', 200), ('Collaborative', 'mentions', 20), ('Resourceful', 'urls', 20),
 ('Note Master', 'opened', 5000), ('Resolution Legend', 'closed', 5000), ('Comment Legend', 'commented', 5000), ('All Around Helper', 'all_round', 1000)"""


def _replayed() -> str:
    """Awards by replaying each day: all measures of all users over the facts up to the day's end, and the first day that is enough."""
    count = lambda cond: f"count(*) FILTER ({cond})"
    kinds = {name: f"action = '{name}'" for name in ("opened", "closed", "commented")}
    plain = kinds | {"closed_with_comment": "action = 'closed' AND comment_length > 0", "tagged": "len(hashtags) > 0", "mentions": "has_mention", "urls": "has_url", "mobile": "platform IN ('android', 'ios')", "desktop": "platform = 'web'"}
    plain |= {"early": "action = 'opened' AND year(action_date) = 2013", "speedy": "action = 'closed' AND action_at <= opened_at + INTERVAL 1 HOUR"} | {f"year_{k}": f"{c} AND year(action_date) = year(day)" for k, c in kinds.items()}
    own = ", ".join(f"{count(c)} AS {k}" for k, c in plain.items()) + ", floor(avg(comment_length)) AS avg_length, year(day) - year(min(action_date) FILTER (action = 'opened')) AS years"
    runs = " ".join(
        f"LEFT JOIN (SELECT day, action_user, max(n) AS {name} FROM (SELECT day, action_user, i - rn AS island, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY day, action_user ORDER BY i) AS rn FROM (SELECT DISTINCT day, action_user, {unit} AS i FROM fd WHERE action IN ({only}))) GROUP BY ALL) GROUP BY ALL) USING (day, action_user)"
        for name, unit, only in _RUNS
    )
    wide = f"SELECT *, least(opened, closed, commented) AS all_round FROM (SELECT day, action_user, {own} FROM fd GROUP BY day, action_user) {runs}"
    long = f"UNPIVOT (SELECT day, action_user, COLUMNS(* EXCLUDE (day, action_user))::BIGINT FROM ({wide})) ON COLUMNS(* EXCLUDE (day, action_user)) INTO NAME measure VALUE value"
    days = f"SELECT CAST(range AS DATE) AS day FROM range((SELECT min(action_date) FROM f), {AS_OF} + INTERVAL 1 DAY, INTERVAL 1 DAY)"
    return f"SELECT * FROM (WITH fd AS (SELECT day, f.* FROM f, ({days}) WHERE action_date <= day AND action_user <> -1) SELECT action_user, badge, min(day) AS awarded_on FROM ({long}) l JOIN (VALUES {_PUBLISHED}) r(badge, measure, least) ON r.measure = l.measure AND value >= r.least GROUP BY ALL)"


_AWARDED = _replayed()
_CRIT = f"""
SELECT u AS action_user, velocity, geography, temporal, mix, round(s, 4) AS score, CASE WHEN s >= 0.8 THEN 5 WHEN s >= 0.6 THEN 4 WHEN s >= 0.4 THEN 3 WHEN s >= 0.2 THEN 2 ELSE 1 END AS level FROM (
SELECT x.u, coalesce(v.p, 0) AS velocity, coalesce(g.p, 0) AS geography, coalesce(t.p, 0) AS temporal, coalesce(a.p, 0) AS mix, coalesce(v.p, 0) + coalesce(g.p, 0) + coalesce(t.p, 0) + coalesce(a.p, 0) AS s FROM (SELECT DISTINCT action_user AS u FROM f) x
LEFT JOIN (SELECT u, 0.25::DOUBLE * CASE WHEN n / s > 10 THEN 0.8 WHEN n / s > 5 THEN 0.6 WHEN n / s > 2 THEN 0.3 ELSE 0 END AS p FROM (SELECT opened_user AS u, count(*) FILTER (action = 'opened') AS n, (epoch_us(max(action_at)) - epoch_us(min(action_at))) / 60e6 AS s FROM f WHERE action_at > {_NOW} - INTERVAL 24 HOUR GROUP BY opened_user) WHERE n > 5 AND s > 0) v ON v.u = x.u
LEFT JOIN (SELECT u, 0.20::DOUBLE * CASE WHEN n > 5 AND s < 6 THEN 0.7 WHEN n > 3 AND s < 12 THEN 0.5 WHEN n > 2 AND s < 24 THEN 0.2 ELSE 0 END AS p FROM (SELECT opened_user AS u, count(DISTINCT country) AS n, (epoch_us(max(action_at)) - epoch_us(min(action_at))) / 3600e6 AS s FROM f WHERE action = 'opened' AND action_at > {_NOW} - INTERVAL 24 HOUR GROUP BY opened_user) WHERE n > 1 AND s > 0) g ON g.u = x.u
LEFT JOIN (SELECT u, 0.20::DOUBLE * CASE WHEN h > 22 THEN 0.6 ELSE 0.4 END AS p FROM (SELECT u, avg(h) AS h, count(*) AS d FROM (SELECT action_user AS u, action_date, count(DISTINCT action_how) AS h FROM f WHERE action_at > {_NOW} - INTERVAL 7 DAY GROUP BY ALL) GROUP BY u) WHERE h > 20 AND d >= 5) t ON t.u = x.u
LEFT JOIN (SELECT u, 0.35::DOUBLE * CASE WHEN o > 90 AND c < 5 THEN 0.5 WHEN o > 80 AND c < 10 THEN 0.3 ELSE 0 END AS p FROM (SELECT action_user AS u, 100::DOUBLE * count(*) FILTER (action = 'opened') / count(*) AS o, 100::DOUBLE * count(*) FILTER (action = 'commented') / count(*) AS c, count(*) AS n FROM f WHERE action_at > {_NOW} - INTERVAL 30 DAY GROUP BY action_user) WHERE n > 20) a ON a.u = x.u)"""
_CONTRIB = "CASE WHEN n = 1 THEN '1' WHEN n <= 5 THEN '2-5' WHEN n <= 10 THEN '6-10' WHEN n <= 50 THEN '11-50' WHEN n <= 100 THEN '51-100' WHEN n <= 500 THEN '101-500' WHEN n <= 1000 THEN '501-1000' ELSE '1000+' END"
_SINGLE = "SELECT action_user, count(*) AS n FROM f GROUP BY action_user"

LEVELS: dict[str, Plan] = {
    "experience_level": (
        lambda w: R.experience(w.facts),
        sql(f"SELECT action_user, opened, closed, days, CASE WHEN opened > 0 THEN least(round(100::DOUBLE * closed / opened, 2), 100) ELSE 0 END AS ratio, {_LEVEL} AS level FROM (SELECT action_user, count(*) FILTER (action = 'opened') AS opened, count(*) FILTER (action = 'closed') AS closed, CAST(floor((epoch_us(max(action_at)) - epoch_us(min(action_at))) / 86400e6) AS BIGINT) AS days FROM f GROUP BY action_user)"),
    ),
    "automation_level": (lambda w: R.automation(w.facts, w.as_of), sql(_CRIT)),
    "automation_backfill": (
        lambda w: R.automation(w.facts, w.as_of).join(w.facts.where("action_date >= DATE '2024-01-28'").select("action_user").distinct(), "action_user", "left_semi").select("action_user", "level"),
        sql(f"SELECT action_user, level FROM ({_CRIT}) WHERE action_user IN (SELECT action_user FROM f WHERE action_date >= DATE '2024-01-28')"),
    ),
    "badge_measures": (lambda w: R.measures(w.facts, w.as_of), sql(_LONG)),
    "badges": (lambda w: R.awards(w.facts, w.as_of, w.spark), sql(_AWARDED)),
    "badges_streaks": (lambda w: R.longest_run(w.facts.where(F.col("action").isin("opened", "closed")), "day", "day_run"), sql(f"SELECT * FROM {_RUN.format(*_RUNS[0])}")),
    "contrib_single": (lambda w: w.facts.groupBy("action_user").count().where("count = 1").agg(F.count("*").alias("users")), sql(f"SELECT count(*) AS users FROM ({_SINGLE}) WHERE n = 1")),
    "contrib_distribution": (
        lambda w: R.contributions(w.facts),
        sql(f"SELECT band, count(*) AS users, CAST(sum(n) AS BIGINT) AS actions, 100::DOUBLE * count(*) / sum(count(*)) OVER () AS user_pct, 100::DOUBLE * sum(n) / sum(sum(n)) OVER () AS action_pct FROM (SELECT n, {_CONTRIB} AS band FROM ({_SINGLE})) GROUP BY band"),
    ),
    "contrib_summary": (
        lambda w: w.facts.groupBy("action_user").agg(F.count("*").alias("n")).agg(F.count("*").alias("users"), F.avg("n").alias("mean"), F.percentile("n", F.lit(0.5)).alias("median"), F.max("n").alias("most")),
        sql(f"SELECT count(*) AS users, avg(n) AS mean, quantile_cont(CAST(n AS DOUBLE), 0.5) AS median, max(n) AS most FROM ({_SINGLE})"),
    ),
}

_RANGE = "(SELECT CAST(range AS DATE) AS date FROM range((SELECT CAST(min(ts) AS DATE) FROM events), (SELECT CAST(max(ts) AS DATE) FROM events) + INTERVAL 1 DAY, INTERVAL 1 DAY))"
_USERS = "(SELECT DISTINCT user_id, 'user' || user_id AS username FROM events WHERE user_id % 10 <> 0)"


def _span(w) -> tuple[str, str]:
    r = w.table("events").agg(F.to_date(F.min("ts")).cast("string").alias("a"), F.to_date(F.max("ts")).cast("string").alias("b")).first()
    return r["a"], r["b"]


def _scd(w):
    old = w.base.users.where("user_id % 3 <> 0").select("user_id", "username", F.lit("2013-01-01").cast("timestamp_ntz").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"), F.lit(True).alias("is_current"))
    fresh = w.base.users.select("user_id", F.when(F.col("user_id") % 7 == 0, F.concat("username", F.lit("_new"))).otherwise(F.col("username")).alias("username"))
    return D.users_changed(old, fresh, "2024-01-31 00:00:00")


def _upsert(w):
    c = w.base.countries
    old = c.where("country_id % 4 <> 0").select("country_id", F.when(F.col("country_id") % 5 == 0, "old").otherwise(F.col("country_name")).alias("country_name"), F.substring("country_name", 1, 2).alias("iso"))
    return D.countries_upserted(old, c.select("country_id", "country_name", F.when(F.col("country_id") % 2 == 0, F.substring("country_name", 1, 3)).alias("iso")))


DIMENSIONS: dict[str, Plan] = {
    "dim_days": (
        lambda w: D.days(*_span(w), w.spark),
        f"SELECT date, CAST(isoyear(date) AS INTEGER) AS iso_year, CAST(week(date) AS INTEGER) AS iso_week, CAST(dayofyear(date) AS INTEGER) AS day_of_year, CAST(quarter(date) AS INTEGER) AS quarter, strftime(date, '%b') AS month_name, strftime(date, '%a') AS day_name, isodow(date) IN (6, 7) AS is_weekend, last_day(date) = date AS is_month_end, last_day(date) = date AND month(date) % 3 = 0 AS is_quarter_end, month(date) = 12 AND day(date) = 31 AS is_year_end FROM {_RANGE}",
    ),
    "dim_time_of_week": (lambda w: w.facts.select(F.col("action_how").alias("how")).distinct().join(D.time_of_week(w.spark), "how"), sql("SELECT DISTINCT action_how AS how, CAST((action_how // 100 - 1) * 24 + action_how % 100 AS INTEGER) AS hour_of_week, CASE WHEN action_how % 100 < 6 THEN 'Night' WHEN action_how % 100 < 12 THEN 'Morning' WHEN action_how % 100 < 18 THEN 'Afternoon' ELSE 'Evening' END AS period FROM f")),
    "dim_users_scd2_change": (
        _scd,
        f"""WITH u AS {_USERS}, o AS (SELECT * FROM u WHERE user_id % 3 <> 0) SELECT user_id, username, TIMESTAMP '2013-01-01' AS valid_from, CASE WHEN user_id % 7 = 0 THEN {_NOW} END AS valid_to, user_id % 7 <> 0 AS is_current FROM o
        UNION ALL SELECT user_id, username || '_new', {_NOW}, NULL, true FROM o WHERE user_id % 7 = 0 UNION ALL SELECT user_id, username || CASE WHEN user_id % 7 = 0 THEN '_new' ELSE '' END, {_NOW}, NULL, true FROM u WHERE user_id % 3 = 0""",
    ),
    "dim_users_scd2_insert": (lambda w: _scd(w).where("valid_to IS NULL AND user_id % 3 = 0").select("user_id", "username"), f"SELECT user_id, username || CASE WHEN user_id % 7 = 0 THEN '_new' ELSE '' END AS username FROM {_USERS} WHERE user_id % 3 = 0"),
    "dim_users_current": (lambda w: _scd(w).where("is_current").select("user_id", "username"), f"SELECT user_id, username || CASE WHEN user_id % 7 = 0 THEN '_new' ELSE '' END AS username FROM {_USERS}"),
    "dim_countries_upsert": (
        _upsert,
        "SELECT n_nationkey AS country_id, n_name AS country_name, CASE WHEN n_nationkey % 2 = 0 THEN left(n_name, 3) WHEN n_nationkey % 4 <> 0 AND n_nationkey % 5 = 0 THEN left(n_name, 2) WHEN n_nationkey % 4 <> 0 THEN left(n_name, 2) END AS iso, n_nationkey % 4 = 0 OR n_nationkey % 5 = 0 AS modified FROM nation WHERE n_nationkey <> 24",
    ),
    "dim_countries_renamed": (lambda w: _upsert(w).where("modified AND country_id % 4 <> 0").select("country_id", "country_name"), "SELECT n_nationkey AS country_id, n_name AS country_name FROM nation WHERE n_nationkey <> 24 AND n_nationkey % 4 <> 0 AND n_nationkey % 5 = 0"),
    "dim_country_region": (lambda w: D.located(w.base.countries, w.spark).select("country_id", "region"), f"SELECT n_nationkey AS country_id, region FROM {LOCATED}"),
    "dim_region_continent": (
        lambda w: D.regions(w.spark).join(D.located(w.base.countries, w.spark).groupBy("region").agg(F.count("*").alias("countries")), "region", "left").select("region", "continent", F.coalesce("countries", F.lit(0)).alias("countries")),
        f"SELECT rg.region, continent, count(n_nationkey) AS countries FROM {REGIONS} LEFT JOIN {LOCATED} l ON l.region = rg.region GROUP BY ALL",
    ),
    "dim_iso_codes": (lambda w: D.located(w.base.countries, w.spark).select("country_id", "alpha2", "alpha3"), f"SELECT n_nationkey AS country_id, alpha2, alpha3 FROM {LOCATED}"),
    "dim_country_fallback": (lambda w: w.facts.groupBy("country").agg(F.countDistinct("note_id").alias("notes")), sql("SELECT country, count(DISTINCT note_id) AS notes FROM f GROUP BY country")),
}

_KIND = "CASE WHEN user_id % 3 = 0 THEN 'countries' WHEN user_id % 3 = 1 THEN 'users' ELSE 'global' END"
_LOG = f"(SELECT event_id AS log_id, {_KIND} AS kind, user_id AS entity_id, ts AS start_time, value AS duration, event_id % 50 + 1 AS records, event_id % 5000 AS facts, CASE WHEN event_type = 'error' THEN 'error' ELSE 'success' END AS status FROM events)"
_PERF = "count(*) AS n, CAST(sum(records) AS BIGINT) AS records, round(avg(duration), 6) AS mean, min(duration) AS least, max(duration) AS most, round(quantile_cont(duration, 0.5), 6) AS median, round(quantile_cont(duration, 0.95), 6) AS p95, round(sum(records) / nullif(sum(duration), 0), 6) AS per_second"


_STALE = "(SELECT note_id, max(action_at) AS last_at, arg_max(action, action_at) <> 'closed' AS is_open FROM f WHERE action IN ('opened', 'closed', 'reopened') AND action_date < DATE '2024-01-20' GROUP BY note_id)"


def _stale(w):
    """The status as it was, in which the checks have something to find."""
    return current(w.facts.where("action_date < DATE '2024-01-20'"))


def _log(w):
    return K.mart_log(w.table("events"))


CHECKS: dict[str, Plan] = {
    "check_status_reopened": (lambda w: K.reopened_later(_stale(w), w.facts), sql(f"SELECT note_id FROM {_STALE} s WHERE NOT is_open AND EXISTS (SELECT 1 FROM f WHERE f.note_id = s.note_id AND f.action = 'reopened' AND f.action_at > s.last_at)")),
    "check_status_open_closed": (lambda w: K.open_but_closed(_stale(w), w.facts), sql(f"SELECT note_id FROM {_STALE} WHERE is_open AND note_id IN (SELECT note_id FROM st WHERE NOT is_open)")),
    "check_status_matches": (lambda w: K.status_differs(w.status.where("note_id % 9 <> 0"), w.facts), sql("SELECT note_id FROM st WHERE note_id % 9 = 0")),
    "check_counts_total": (lambda w: w.base.note_comments.agg(F.count("*").alias("base")).crossJoin(w.facts.agg(F.count("*").alias("facts"))), sql("SELECT (SELECT count(*) FROM comments) AS base, (SELECT count(*) FROM f) AS facts")),
    "check_counts_per_note": (lambda w: K.counts_by(w.base.note_comments, w.facts, "note_id", "note_id"), sql("SELECT note_id AS value, coalesce(b, 0) AS base, coalesce(x, 0) AS facts, coalesce(b, 0) = coalesce(x, 0) AS same FROM (SELECT note_id, count(*) AS b FROM comments GROUP BY note_id) FULL JOIN (SELECT note_id, count(*) AS x FROM f GROUP BY note_id) USING (note_id)")),
    "check_counts_per_action": (lambda w: K.counts_by(w.base.note_comments, w.facts, "event", "action"), sql("SELECT action AS value, coalesce(b, 0) AS base, coalesce(x, 0) AS facts, coalesce(b, 0) = coalesce(x, 0) AS same FROM (SELECT action, count(*) AS b FROM comments GROUP BY action) FULL JOIN (SELECT action, count(*) AS x FROM f GROUP BY action) USING (action)")),
    "check_summary": (
        lambda w: K.summary(_stale(w), w.base.note_comments, w.facts),
        sql(f"""SELECT check_name, failures, CASE WHEN failures = 0 THEN 'PASS' ELSE 'FAIL' END AS result FROM (
        SELECT 'reopened_later' AS check_name, count(*) AS failures FROM {_STALE} s WHERE NOT is_open AND EXISTS (SELECT 1 FROM f WHERE f.note_id = s.note_id AND f.action = 'reopened' AND f.action_at > s.last_at)
        UNION ALL SELECT 'open_but_closed', count(*) FROM {_STALE} WHERE is_open AND note_id IN (SELECT note_id FROM st WHERE NOT is_open)
        UNION ALL SELECT 'status_differs', count(*) FROM {_STALE} s FULL JOIN st ON st.note_id = s.note_id WHERE s.is_open IS DISTINCT FROM st.is_open
        UNION ALL SELECT 'per_action', count(*) FROM (SELECT action, count(*) AS b FROM comments GROUP BY action) FULL JOIN (SELECT action, count(*) AS x FROM f GROUP BY action) USING (action) WHERE coalesce(b, 0) <> coalesce(x, 0))"""),
    ),
    "load_balance": (lambda w: w.base.note_comments.agg(F.lit("comments").alias("what"), F.count("*").alias("n")).unionByName(w.facts.agg(F.lit("facts").alias("what"), F.count("*").alias("n"))), sql("SELECT 'comments' AS what, count(*) AS n FROM comments UNION ALL SELECT 'facts', count(*) FROM f")),
    "perf_summary": (lambda w: K.perf_summary(K.within(_log(w), str(_LAST), 24).where("status = 'success'"), ["kind"]), f"SELECT kind, {_PERF} FROM {_LOG} WHERE start_time >= TIMESTAMP '2024-01-30' AND status = 'success' GROUP BY kind"),
    "perf_by_hour": (lambda w: K.perf_summary(_log(w).withColumn("hour", F.hour("start_time")), ["kind", "hour"]), f"SELECT kind, CAST(hour(start_time) AS INTEGER) AS hour, {_PERF} FROM {_LOG} GROUP BY ALL"),
    "perf_by_day": (lambda w: K.perf_summary(_log(w).withColumn("day", F.to_date("start_time")), ["kind", "day"]), f"SELECT kind, CAST(start_time AS DATE) AS day, {_PERF} FROM {_LOG} GROUP BY ALL"),
    "perf_slowest": (
        lambda w: K.perf_slowest(K.within(_log(w), str(_LAST), 168)),
        f"SELECT kind, CAST(place AS INTEGER) AS place, log_id, entity_id, duration, facts, round(records / nullif(duration, 0), 2) AS per_second FROM (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY duration DESC, log_id) AS place FROM {_LOG} WHERE kind IN ('countries', 'users') AND start_time >= TIMESTAMP '2024-01-24') WHERE place <= 20",
    ),
    "perf_slow_entities": (lambda w: K.perf_slow_entities(_log(w), {"countries": 5.0, "users": 2.0}), f"SELECT kind, entity_id, count(*) AS n, round(avg(duration), 6) AS mean FROM {_LOG} WHERE kind IN ('countries', 'users') GROUP BY ALL HAVING round(avg(duration), 6) > CASE kind WHEN 'countries' THEN 5 ELSE 2 END"),
    "perf_throughput": (lambda w: _log(w).groupBy("kind", F.date_trunc("hour", "start_time").cast("timestamp_ntz").alias("hour")).agg((F.sum("records") / 60.0).alias("per_minute")), f"SELECT kind, date_trunc('hour', start_time) AS hour, sum(records) / 60::DOUBLE AS per_minute FROM {_LOG} GROUP BY ALL"),
    "perf_errors": (lambda w: _log(w).where("status = 'error'").groupBy("kind").agg(F.count("*").alias("n")), f"SELECT kind, count(*) AS n FROM {_LOG} WHERE status = 'error' GROUP BY kind"),
    "perf_recent_errors": (lambda w: _log(w).where("status = 'error'").orderBy(F.desc("start_time"), F.desc("log_id")).limit(20).select("log_id", "kind", "start_time"), f"SELECT log_id, kind, start_time FROM {_LOG} WHERE status = 'error' ORDER BY start_time DESC, log_id DESC LIMIT 20"),
    "perf_week_compare": (lambda w: K.perf_week_compare(_log(w), "2024-01-31"), f"SELECT kind, CASE WHEN ago <= 6 THEN 'current' ELSE 'previous' END AS week, count(*) AS n, round(avg(duration), 6) AS mean, count(*) FILTER (status = 'error') AS errors FROM (SELECT *, {AS_OF} - CAST(start_time AS DATE) AS ago FROM {_LOG}) WHERE ago BETWEEN 0 AND 13 GROUP BY ALL"),
    "perf_facts_buckets": (lambda w: K.perf_facts_buckets(_log(w)), f"SELECT CASE WHEN facts < 100 THEN '0-99' WHEN facts < 1000 THEN '100-999' ELSE '1000+' END AS band, count(*) AS n, round(avg(duration), 6) AS mean, round(1000::DOUBLE * sum(duration) / sum(facts), 6) AS ms_per_fact FROM {_LOG} GROUP BY ALL"),
    "profile_daily_achievements": (lambda w: K.daily_achievements(w.facts, 2), sql("SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY action_user ORDER BY action_date DESC) AS INTEGER) AS place FROM (SELECT action_user, action_date, count(*) FILTER (action = 'opened') AS opened, count(*) FILTER (action = 'closed') AS closed FROM f GROUP BY ALL HAVING count(*) FILTER (action = 'opened') >= 2 OR count(*) FILTER (action = 'closed') >= 2)) WHERE place <= 20")),
    "profile_close_quality": (
        lambda w: K.close_quality(M.history(w.facts, "country", w.as_of), "country"),
        sql("SELECT country, pct, CASE WHEN pct >= 80 THEN 'Excellent' WHEN pct >= 60 THEN 'Good' WHEN pct >= 40 THEN 'Fair' ELSE 'Needs improvement' END AS quality FROM (SELECT country, CAST(floor(100::DOUBLE * sum(texts) FILTER (action = 'closed') / count(*) FILTER (action = 'closed')) AS BIGINT) AS pct FROM f GROUP BY country HAVING count(*) FILTER (action = 'closed') > 0)"),
    ),
    "profile_zero_days": (lambda w: K.zero_days(w.facts, "country", "2024-01-31"), sql(f"SELECT country, CAST({AS_OF} - min(action_date) + 1 - count(DISTINCT action_date) AS BIGINT) AS days FROM f GROUP BY country")),
    "profile_zero_new_years": (
        lambda w: w.facts.select("country").distinct().select("country", F.explode(F.sequence(F.lit(2013), F.lit(2024))).alias("year")).join(w.facts.where("month(action_date) = 1 AND day(action_date) = 1").select("country", F.year("action_date").alias("year")).distinct(), ["country", "year"], "left_anti"),
        sql("SELECT country, CAST(year AS INTEGER) AS year FROM (SELECT DISTINCT country FROM f), range(2013, 2025) r(year) WHERE (country, year) NOT IN (SELECT (country, year(action_date)) FROM f WHERE month(action_date) = 1 AND day(action_date) = 1)"),
    ),
    **{
        f"profile_top_{a}_by_year": (
            lambda w, a=a: K.most_by_year(w.facts, "country", a),
            sql(f"SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY country, year ORDER BY n DESC, note_id) AS INTEGER) AS place FROM (SELECT country, CAST(year(action_date) AS INTEGER) AS year, note_id, count(*) AS n FROM f WHERE action = '{a}' GROUP BY ALL)) WHERE place <= 10"),
        )
        for a in ("commented", "reopened")
    },
    "profile_user_badges": (
        lambda w: R.awards(w.facts, w.as_of, w.spark).groupBy("action_user").agg(F.array_sort(F.collect_list(F.struct((-F.unix_date("awarded_on")).alias("late"), "badge", "awarded_on"))).alias("b")).select("action_user", F.array_join(F.transform("b", lambda x: F.concat_ws(" ", x.awarded_on.cast("string"), x.badge)), ",").alias("badges")),
        sql(f"SELECT action_user, string_agg(CAST(awarded_on AS VARCHAR) || ' ' || badge, ',' ORDER BY awarded_on DESC, badge) AS badges FROM ({_AWARDED}) GROUP BY action_user"),
    ),
}

PLANS: dict[str, Plan] = RANKINGS | TAGS | LEVELS | DIMENSIONS | CHECKS
