"""Queries of the facts, the status and the marts, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import columns as C
from ..operators import facts as X
from ..operators import dimensions as D
from ..operators import marts as M
from ..sources import notes
from .oracle import AS_OF, LOCATED, REGIONS, five, sql, top
from .warehouse import Warehouse

Plan = tuple[Callable[[Warehouse], DataFrame], str | None]

_FACT = ["note_id", "seq"]


def _fact(*cols: str) -> Callable[[Warehouse], DataFrame]:
    return lambda w: w.facts.select(*_FACT, *cols)


def _sql(*cols: str) -> str:
    return sql(f"SELECT {', '.join([*_FACT, *cols])} FROM f")


def _unopened(w: Warehouse) -> notes.Base:
    """The base tables without the openings of every 17th note."""
    b = w.base
    return notes.Base(b.notes, b.note_comments.where("note_id % 17 <> 0 OR event <> 'opened'"), b.note_comments_text, b.users, b.countries)


FACTS: dict[str, Plan] = {
    "src_base_tables": (
        lambda w: notes.snapshot(w.base).note_comments.groupBy("event").agg(F.count("*").alias("n"), F.count("id_user").alias("named"), F.min("created_at").alias("first_at")),
        sql("SELECT action AS event, count(*) AS n, count(id_user) AS named, min(created_at) AS first_at FROM comments GROUP BY action"),
    ),
    "facts_base_join": (lambda w: X.joined(w.base).select(*_FACT, "action", "action_at", "action_user", "country", "latitude", "longitude"), sql("SELECT c.note_id, c.seq, c.action, c.created_at AS action_at, coalesce(c.id_user, -1) AS action_user, n.country, n.latitude, n.longitude FROM comments c JOIN notes n USING (note_id)")),
    "facts_dim_keys": (_fact("action_user", "opened_user", "country", "action_date", "action_how", "opened_date"), _sql("action_user", "opened_user", "country", "action_date", "action_how", "opened_date")),
    "facts_close_keys": (_fact("closed_date", "closed_user"), _sql("closed_date", "closed_user")),
    "facts_next_close": (_fact("next_close_date", "next_close_user"), sql("SELECT f.note_id, f.seq, CAST(next_at AS DATE) AS next_close_date, next_user AS next_close_user FROM f LEFT JOIN nc USING (note_id, seq)")),
    "facts_recent_open": (_fact("recent_open_date"), _sql("recent_open_date")),
    "facts_orphans": (lambda w: X.orphans(_unopened(w)).select(*_FACT), sql("SELECT note_id, seq FROM f WHERE note_id % 17 = 0 AND action <> 'opened'")),
    "facts_dedup": (lambda w: w.facts.groupBy("note_id").agg(F.count("*").alias("n"), F.countDistinct("action_at").alias("times")), sql("SELECT note_id, count(*) AS n, count(DISTINCT action_at) AS times FROM f GROUP BY note_id")),
    "facts_local_time": (_fact("zone", "local_date", "local_how"), _sql("zone", "local_date", "local_how")),
    "facts_season": (_fact("season"), _sql("season")),
    "facts_comment_metrics": (_fact("comment_length", "has_url", "has_mention"), _sql("comment_length", "has_url", "has_mention")),
    "facts_hashtags": (lambda w: w.tags.select(*_FACT, "position", "tag", "action"), sql("SELECT note_id, seq, position, tag, action FROM tg")),
    "facts_days_to_resolution": (_fact("days_to_resolution"), _sql("days_to_resolution")),
    "facts_days_from_reopen": (_fact("days_from_reopen"), _sql("days_from_reopen")),
    "facts_days_active": (_fact("days_active"), _sql("days_active")),
    "facts_activity_counts": (_fact("prior_commented", "prior_reopened", "prior_actions"), _sql("prior_commented", "prior_reopened", "prior_actions")),
    "facts_initial": (
        lambda w: X.facts(w.base).groupBy("action").agg(F.count("*").alias("n"), F.sum("days_to_resolution").alias("days"), F.sum("prior_actions").alias("prior")),
        sql("SELECT action, count(*) AS n, CAST(sum(days_to_resolution) AS BIGINT) AS days, CAST(sum(prior_actions) AS BIGINT) AS prior FROM f GROUP BY action"),
    ),
    "facts_modified_entities": (
        lambda w: w.facts.where("action_date >= DATE '2024-01-25'").select(F.explode(F.array(F.struct(F.lit("user").alias("kind"), F.col("action_user").alias("id")), F.struct(F.lit("country").alias("kind"), F.col("country").cast("long").alias("id")))).alias("x")).select("x.*").distinct(),
        sql("SELECT DISTINCT 'user' AS kind, action_user AS id FROM f WHERE action_date >= DATE '2024-01-25' UNION SELECT DISTINCT 'country', CAST(country AS BIGINT) FROM f WHERE action_date >= DATE '2024-01-25'"),
    ),
    "dim_application_match": (lambda w: w.facts.where("app IS NOT NULL").groupBy("app", "platform").agg(F.count("*").alias("n")), sql("SELECT app, platform, count(*) AS n FROM f WHERE app IS NOT NULL GROUP BY ALL")),
    "dim_application_version": (lambda w: w.facts.where("app_version IS NOT NULL").select("app", "app_version").distinct(), sql("SELECT DISTINCT app, app_version FROM f WHERE app_version IS NOT NULL")),
    "dim_hashtags": (lambda w: w.tags.select("tag").distinct(), sql("SELECT DISTINCT tag FROM tg")),
    "dim_timezone": (lambda w: w.facts.select("zone").distinct().select("zone", C.zone_name(F.col("zone")).alias("name")), sql("SELECT DISTINCT zone, CASE WHEN zone = 0 THEN 'UTC' WHEN zone > 0 THEN 'UTC+' || zone ELSE 'UTC' || zone END AS name FROM f")),
    "status_latest": (lambda w: w.status.select("note_id", "last_action", "last_at", "is_open"), sql("SELECT note_id, last_action, last_at, is_open FROM st")),
    "status_open_by_country": (lambda w: w.status.where("is_open").groupBy("country").agg(F.count("*").alias("n")), sql("SELECT country, count(*) AS n FROM st WHERE is_open GROUP BY country")),
    "status_open_by_user": (lambda w: w.status.where("is_open AND opened_user <> -1").groupBy("opened_user").agg(F.count("*").alias("n")), sql("SELECT opened_user, count(*) AS n FROM st WHERE is_open AND opened_user <> -1 GROUP BY opened_user")),
}


def _mart(kind: str, e: str, other: str) -> dict[str, Plan]:
    """The families that country and user marts share."""
    in_year = f"year(action_date) = year({AS_OF})"
    spans = {"whole": "true", "year": in_year, "month": f"date_trunc('month', action_date) = date_trunc('month', {AS_OF})", "day": f"action_date = {AS_OF}"}
    history = ", ".join(f"{x} AS {span}_{m}" for span, cond in spans.items() for m, x in zip(M.MEASURES, five(cond), strict=True))
    years = ", ".join(f"{x} AS {m}" for m, x in zip(M.MEASURES, five(), strict=True))
    notes = "".join(
        f", min(CASE WHEN action = '{a}' THEN action_date END) AS date_first_{a}, (min({{'a': action_at, 's': seq, 'n': note_id}}) FILTER (action = '{a}')).n AS first_{a}_note, (max({{'a': action_at, 's': seq, 'n': note_id}}) FILTER (action = '{a}')).n AS latest_{a}_note"
        for a in ("opened", "commented", "closed", "reopened")
    )
    by = lambda unit: f"""SELECT {e}, CAST(date_trunc('{unit}', action_date) AS DATE) AS period, avg(days_to_resolution) AS avg_days, quantile_cont(CAST(days_to_resolution AS DOUBLE), 0.5) AS median_days,
        count(DISTINCT note_id) FILTER (action = 'closed') AS resolved, count(DISTINCT note_id) FILTER (action = 'opened') AS opened,
        100::DOUBLE * count(DISTINCT note_id) FILTER (action = 'closed') / nullif(count(DISTINCT note_id) FILTER (action = 'opened'), 0) AS rate FROM f WHERE action IN ('opened', 'closed') GROUP BY ALL"""  # noqa: E731
    share = lambda cols: f"SELECT *, 100::DOUBLE * n / sum(n) OVER (PARTITION BY {e}, year) AS pct FROM (SELECT {e}, CAST(year(action_date) AS INTEGER) AS year, {', '.join(cols)}, count(*) AS n FROM f WHERE {cols[-1]} IS NOT NULL GROUP BY ALL)"
    resolution = f"""SELECT {e}, avg_days, median_days, resolved, still_open, 100::DOUBLE * resolved / nullif(resolved + still_open, 0) AS rate
        FROM (SELECT {e}, avg(days_to_resolution) AS avg_days, quantile_cont(CAST(days_to_resolution AS DOUBLE), 0.5) AS median_days FROM f GROUP BY {e})
        JOIN (SELECT {e}, count(*) FILTER (c) AS resolved, count(*) FILTER (o AND NOT c) AS still_open FROM (SELECT {e}, note_id, bool_or(action = 'opened') AS o, bool_or(action = 'closed') AS c FROM f GROUP BY ALL) GROUP BY {e}) USING ({e})"""
    band = "CASE WHEN {0} <= 7 THEN '0_7' WHEN {0} <= 30 THEN '8_30' WHEN {0} <= 90 THEN '31_90' ELSE '90_plus' END".format(f"({AS_OF} - opened_date)")
    health = f"""SELECT r.{e}, created_30, resolved_30, coalesce(open_notes, 0) AS open_notes, {', '.join(f'coalesce(age_{b}, 0) AS age_{b}' for b in ('0_7', '8_30', '31_90', '90_plus'))}
        FROM (SELECT {e}, count(*) FILTER (action = 'opened' AND action_date >= {AS_OF} - 30) AS created_30, count(*) FILTER (action = 'closed' AND action_date >= {AS_OF} - 30) AS resolved_30 FROM f GROUP BY {e}) r
        LEFT JOIN (SELECT f.{e}, count(*) AS open_notes, {', '.join(f"count(*) FILTER ({band} = '{b}') AS age_{b}" for b in ('0_7', '8_30', '31_90', '90_plus'))}
                   FROM f JOIN st ON st.note_id = f.note_id AND st.is_open WHERE f.action = 'opened' GROUP BY f.{e}) a ON a.{e} = r.{e}"""
    classes = {"poor": "x < 5", "fair": "x >= 5 AND x < 10", "good": "x >= 10 AND x < 200", "complex": "x >= 200 AND x < 500", "treatise": "x >= 500"}
    peak = lambda key, name: f"SELECT {e}, max({{'n': n, 'k': k}}).k AS {name} FROM (SELECT {e}, {key} AS k, count(*) AS n FROM f WHERE action = 'opened' GROUP BY ALL) GROUP BY {e}"
    mode = {"week": "CAST(week(action_date) AS INTEGER)", "quarter": "CAST(quarter(action_date) AS INTEGER)", "month": "CAST(month(action_date) AS INTEGER)", "how": "action_how", "period": "CASE WHEN action_how % 100 < 6 THEN 'Night' WHEN action_how % 100 < 12 THEN 'Morning' WHEN action_how % 100 < 18 THEN 'Afternoon' ELSE 'Evening' END"}
    modes = f"SELECT {e}, {', '.join(mode)} FROM " + " JOIN ".join(f"(SELECT {e}, max({{'n': n, 'k': k}}).k AS {name} FROM (SELECT {e}, {x} AS k, count(*) AS n FROM f GROUP BY ALL) GROUP BY {e})" + (f" USING ({e})" if i else "") for i, (name, x) in enumerate(mode.items()))
    pairs = f"""SELECT {e}, action, span, {other} AS key, count(*) AS n FROM (SELECT *, unnest(['all', CASE WHEN {spans['month']} THEN 'month' END, CASE WHEN {spans['day']} THEN 'day' END]) AS span FROM f WHERE action IN ('opened', 'closed')) WHERE span IS NOT NULL GROUP BY ALL"""
    scores = "CASE WHEN n = 0 THEN '0' " + " ".join(f"WHEN n <= {2 ** (k + 1) - 2} THEN '{k}'" for k in range(1, 9)) + " ELSE '9' END"
    plans: dict[str, Plan] = {
        "first_last": (lambda w: M.first_last(w.facts, e), sql(f"SELECT {e}, min(action_date) AS first_action, max(action_at) AS last_action{notes} FROM f GROUP BY {e}")),
        "history": (lambda w: M.history(w.facts, e, w.as_of), sql(f"SELECT {e}, {history} FROM f GROUP BY {e}")),
        "history_by_year": (lambda w: M.history_by_year(w.facts, e), sql(f"SELECT {e}, CAST(year(action_date) AS INTEGER) AS year, {years} FROM f GROUP BY ALL")),
        "year_rankings": (lambda w: M.year_rankings(w.facts, e, other), sql(top(f"SELECT {e}, action, CAST(year(action_date) AS INTEGER) AS year, {other} AS key, count(*) AS n FROM f WHERE action IN ('opened', 'closed') GROUP BY ALL", f"{e}, action, year", 50))),
        "dates_most": (lambda w: M.dates_most(w.facts, e), sql(top(f"SELECT {e}, action, action_date AS key, count(*) AS n FROM f WHERE action IN ('opened', 'closed') GROUP BY ALL", f"{e}, action", 50))),
        "hashtags": (lambda w: M.tag_lists(w.tags, e), sql(top(f"SELECT {e}, tag AS key, count(*) AS n FROM tg GROUP BY ALL", e, 50))),
        "hashtags_by_action": (lambda w: M.tag_lists_by_action(w.tags, e), sql(top(f"SELECT {e}, action, tag AS key, count(*) AS n FROM tg WHERE action IN ('opened', 'closed', 'commented') GROUP BY ALL", f"{e}, action", 10))),
        "working_hours": (lambda w: M.working_hours(w.facts, e), sql(f"SELECT {e}, action, CAST(action_how // 100 AS INTEGER) AS dow, CAST(action_how % 100 AS INTEGER) AS hour, count(*) AS n FROM f WHERE action IN ('opened', 'commented', 'closed') GROUP BY ALL")),
        "resolution": (lambda w: M.resolution(w.facts, e), sql(resolution)),
        "resolution_by_year": (lambda w: M.resolution_by(w.facts, e, "year"), sql(by("year"))),
        "resolution_by_month": (lambda w: M.resolution_by(w.facts, e, "month"), sql(by("month"))),
        "applications": (
            lambda w: M.applications(w.facts, e),
            sql(f"SELECT {e}, count(*) AS apps, string_agg(DISTINCT app, ',' ORDER BY app) AS names, arg_min(app, {{'m': -n, 'a': app}}) AS most_used, count(*) FILTER (platform IN ('android', 'ios')) AS mobile, count(*) FILTER (platform = 'web') AS desktop FROM (SELECT {e}, app, platform, count(*) AS n FROM f WHERE app IS NOT NULL GROUP BY ALL) GROUP BY {e}"),
        ),
        "app_trends": (lambda w: M.shares(w.facts, e, ["app"]), sql(share(["app"]))),
        "version_adoption": (lambda w: M.shares(w.facts, e, ["app", "app_version"]), sql(share(["app", "app_version"]))),
        "comment_quality": (
            lambda w: M.comment_quality(w.facts, e),
            sql(f"SELECT {e}, avg(comment_length) AS avg_length, count(*) FILTER (has_url) AS with_url, 100::DOUBLE * count(*) FILTER (has_url) / count(*) AS url_pct, count(*) FILTER (has_mention) AS with_mention, 100::DOUBLE * count(*) FILTER (has_mention) / count(*) AS mention_pct, CAST(count(*) AS DOUBLE) / count(DISTINCT note_id) AS per_note FROM f WHERE comment_length > 0 GROUP BY {e}"),
        ),
        "health": (lambda w: M.health(w.facts, w.status, e, w.as_of), sql(health)),
        "note_quality": (lambda w: M.note_quality(w.facts, e), sql(f"SELECT {e}, " + ", ".join(f"count(*) FILTER ({x}) AS {c}" for c, x in classes.items()) + f" FROM (SELECT {e}, coalesce(comment_length, 0) AS x FROM f WHERE action = 'opened') GROUP BY {e}")),
        "peaks": (lambda w: M.peaks(w.facts, e), sql(f"SELECT * FROM ({peak('action_date', 'peak_day')}) JOIN ({peak('action_how', 'peak_hour')}) USING ({e})")),
        "last_year_activity": (
            lambda w: M.activity(w.facts, e, w.as_of),
            sql(f"SELECT {e}, string_agg({scores}, '' ORDER BY ago DESC) AS activity FROM (SELECT x.{e}, ago, (SELECT count(*) FROM f WHERE f.{e} = x.{e} AND f.action_date = {AS_OF} - CAST(ago AS INTEGER)) AS n FROM (SELECT DISTINCT {e} FROM f) x, range(371) r(ago)) GROUP BY {e}"),
        ),
        "rankings": (lambda w: M.pair_rankings(w.facts, e, other, w.as_of), sql(top(pairs, f"{e}, action, span", 50))),
        "years_with_changes": (lambda w: M.years_with_changes(w.facts, e), sql(f"SELECT DISTINCT {e}, CAST(year(action_date) AS INTEGER) AS year FROM f")),
        "work_list": (lambda w: M.work_list(w.facts, e), sql(f"SELECT {e}, max(action_at) AS last_action, count(*) AS n FROM f GROUP BY {e}")),
        "modes": (lambda w: M.modes(w.facts, e), sql(modes)),
        "new_vs_resolved": (lambda w: M.new_vs_resolved(M.health(w.facts, w.status, e, w.as_of), e), sql(f"SELECT {e}, CASE WHEN resolved_30 > 0 THEN CAST(created_30 AS DOUBLE) / resolved_30 WHEN created_30 > 0 THEN 999.99::DOUBLE ELSE 0::DOUBLE END AS ratio FROM ({health})")),
        "health_score": (
            lambda w: M.health_score(M.resolution(w.facts, e), M.health(w.facts, w.status, e, w.as_of), e).withColumn("score", F.round("score", 6)),
            sql(f"SELECT {e}, round(0.4::DOUBLE * coalesce(rate, 0) + 0.3::DOUBLE * (100::DOUBLE - least(100::DOUBLE, coalesce(100::DOUBLE * open_notes / nullif(resolved + still_open, 0), 0))) + 0.3::DOUBLE * (CASE WHEN created_30 > 0 THEN least(100::DOUBLE, 100::DOUBLE * resolved_30 / created_30) ELSE 0 END), 6) AS score FROM ({resolution}) JOIN ({health}) USING ({e})"),
        ),
        "open_notes_by_year": (lambda w: M.open_by_year(w.status, w.facts, e), sql(f"SELECT f.{e}, CAST(year(opened_date) AS INTEGER) AS year, count(*) AS n FROM f JOIN st ON st.note_id = f.note_id AND st.is_open WHERE f.action = 'opened' GROUP BY ALL")),
        "longest_resolution": (lambda w: M.longest_resolution(w.facts, e), sql(f"SELECT {e}, CAST(place AS INTEGER) AS place, note_id, days_to_resolution FROM (SELECT *, row_number() OVER (PARTITION BY {e} ORDER BY days_to_resolution DESC, note_id, seq) AS place FROM f WHERE days_to_resolution IS NOT NULL) WHERE place <= 10")),
    }
    return {f"{kind}_{name}": plan for name, plan in plans.items()}


MARTS: dict[str, Plan] = _mart("country", "country", "action_user") | _mart("user", "action_user", "country")

_LIMITS = ((100, 100), (400, 400), (1600, 1600), (6400, 6400), (25600, 25600), (102400, 102400))
_KIND = f"""CASE WHEN first > {AS_OF} - 30 THEN 2 WHEN first > {AS_OF} - 90 THEN 3 WHEN year(first) = 2013 AND year(first) = 2024 THEN 4 WHEN first = last THEN 5
 WHEN year(first) IN (2024, 2023) THEN 6 WHEN last < {AS_OF} - 720 THEN 7 WHEN actions < 25 THEN 10
 {' '.join(f'WHEN closed < {c} AND closed // (coalesce(opened, 0) + 1) > 1 THEN {11 + 2 * k} WHEN actions < {n} THEN {12 + 2 * k}' for k, (n, c) in enumerate(_LIMITS))} ELSE 23 END"""

USERS: dict[str, Plan] = {
    "user_contributor_type": (
        lambda w: M.contributor_type(w.facts, w.as_of),
        sql(f"SELECT a.action_user, {_KIND} AS contributor_type FROM (SELECT action_user, min(action_date) AS first, max(action_date) AS last, count(*) AS actions, count(*) FILTER (action = 'closed') AS closed FROM f GROUP BY action_user) a LEFT JOIN (SELECT opened_user, count(*) AS opened FROM f GROUP BY opened_user) o ON o.opened_user = a.action_user"),
    ),
    "user_response_time": (
        lambda w: M.response_time(w.facts),
        sql("SELECT action_user, round(avg((epoch_us(c) - epoch_us(o)) / 86400e6), 6) AS days FROM (SELECT action_user, note_id, min(CASE WHEN action = 'opened' THEN action_at END) AS o, min(CASE WHEN action = 'commented' THEN action_at END) AS c FROM f WHERE action_user = opened_user GROUP BY ALL) WHERE c > o GROUP BY action_user"),
    ),
    "user_days_since_last": (lambda w: w.facts.groupBy("action_user").agg(F.datediff(F.lit(w.as_of), F.max("action_date")).alias("days")), sql(f"SELECT action_user, CAST({AS_OF} - max(action_date) AS INTEGER) AS days FROM f GROUP BY action_user")),
    "user_collaboration": (
        lambda w: M.collaboration(w.facts),
        sql("SELECT a.action_user, given, coalesce(received, 0) AS received, replies, given + coalesce(received, 0) + replies AS score FROM (SELECT action_user, count(*) FILTER (has_mention) AS given, count(*) FILTER (action = 'commented' AND prior_commented > 0) AS replies FROM f GROUP BY action_user) a LEFT JOIN (SELECT opened_user, count(*) AS received FROM f WHERE has_mention AND action_user <> opened_user GROUP BY opened_user) b ON b.opened_user = a.action_user"),
    ),
    "user_low_activity_batches": (lambda w: M.low_activity(w.facts.where("action_date < DATE '2024-01-06'")), sql("SELECT action_user, count(*) AS n, CAST(floor(action_user / 100::DOUBLE) AS BIGINT) AS batch FROM f WHERE action_date < DATE '2024-01-06' GROUP BY action_user HAVING count(*) <= 20")),
    "country_profile": (
        lambda w: D.located(w.base.countries, w.spark).join(F.broadcast(D.regions(w.spark)), "region").select("country_id", "country_name", "country_name_es", "country_name_en", "alpha2", "alpha3", "region", "continent"),
        f"SELECT n_nationkey AS country_id, n_name AS country_name, lower(n_name) AS country_name_es, array_to_string(list_transform(string_split(lower(n_name), ' '), lambda x: upper(x[1]) || x[2:]), ' ') AS country_name_en, alpha2, alpha3, region, continent FROM {LOCATED} JOIN {REGIONS} USING (region)",
    ),
}

PLANS: dict[str, Plan] = FACTS | MARTS | USERS
