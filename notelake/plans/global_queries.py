"""Queries of the global mart, with their SQL."""

from __future__ import annotations

from ..operators import global_mart as G
from .mart_queries import Plan
from .oracle import AS_OF, sql

_YEAR = f"year(action_date) = year({AS_OF})"
_ACTS = ", ".join(f"count(*) FILTER (action = '{a}') AS {a}" for a in G.ACTIONS)

PLANS: dict[str, Plan] = {
    "global_counts": (lambda w: G.counts(w.facts, w.as_of), sql("SELECT " + ", ".join(f"count(*) FILTER (action = '{a}' AND {c}) AS {n}_{a}" for n, c in (("whole", "true"), ("year", _YEAR)) for a in G.ACTIONS) + " FROM f")),
    "global_resolution": (
        lambda w: G.resolution(w.facts, w.as_of),
        sql("SELECT avg(days_to_resolution) AS avg_days, quantile_cont(CAST(days_to_resolution AS DOUBLE), 0.5) AS median_days, avg(days_to_resolution) FILTER (year(opened_date) = 2024 AND days_to_resolution > 0) AS avg_days_year, quantile_cont(CAST(days_to_resolution AS DOUBLE), 0.5) FILTER (year(opened_date) = 2024 AND days_to_resolution > 0) AS median_days_year, 100::DOUBLE * count(DISTINCT note_id) FILTER (action = 'closed') / count(DISTINCT note_id) FILTER (action = 'opened') AS rate FROM f"),
    ),
    "global_first_latest": (lambda w: G.first_latest(w.facts), sql("SELECT action, min({'a': action_at, 'n': note_id}).n AS first_note, max({'a': action_at, 'n': note_id}).n AS latest_note FROM f WHERE action <> 'hidden' GROUP BY action")),
    "global_closed_with_comment": (lambda w: G.closed_with_comment(w.facts, w.as_of), sql(f"SELECT count(*) AS whole, count(*) FILTER ({_YEAR}) AS year FROM f c WHERE action = 'closed' AND EXISTS (SELECT 1 FROM f t WHERE t.note_id = c.note_id AND t.action = 'commented' AND t.action_at < c.action_at)")),
    "global_comment_metrics": (lambda w: G.comment_metrics(w.facts), sql("SELECT avg(comment_length) AS avg_length, 100::DOUBLE * count(*) FILTER (has_url) / count(*) AS url_pct, 100::DOUBLE * count(*) FILTER (has_mention) / count(*) AS mention_pct FROM f WHERE comment_length > 0")),
    "global_30_days": (lambda w: G.last_days(w.facts, w.as_of), sql(f"SELECT count(*) FILTER (action = 'opened') AS created, count(*) FILTER (action = 'closed') AS resolved, count(DISTINCT action_user) FILTER (action_user <> -1) AS active_users FROM f WHERE action_date >= {AS_OF} - 30")),
    "global_status": (lambda w: G.status(w.status, w.facts, w.as_of), sql(f"SELECT count(*) FILTER (is_open) AS open_notes, count(*) FILTER (NOT is_open) AS closed_notes, count(*) FILTER (is_open AND {AS_OF} - f.opened_date > 7) AS backlog FROM st JOIN f ON f.note_id = st.note_id AND f.action = 'opened'")),
    "global_applications": (
        lambda w: G.applications(w.facts),
        sql("""SELECT app, count(*) AS n, row_number() OVER (ORDER BY count(*) DESC, app) = 1 AS most_used, (SELECT count(DISTINCT app) FROM f WHERE action = 'opened' AND platform IN ('android', 'ios')) AS mobile_apps,
        (SELECT count(DISTINCT app) FROM f WHERE action = 'opened' AND platform = 'web') AS desktop_apps FROM f WHERE app IS NOT NULL AND action = 'opened' GROUP BY app ORDER BY n DESC, app LIMIT 10"""),
    ),
    "global_avg_comments_per_note": (lambda w: G.comments_per_note(w.facts), sql("SELECT avg(m) AS mean FROM (SELECT max(prior_commented) AS m FROM f GROUP BY note_id)")),
    "global_top_countries": (lambda w: G.top_countries(w.facts), sql("SELECT country, count(*) AS n FROM f GROUP BY country ORDER BY n DESC, country LIMIT 10")),
    "global_age_distribution": (lambda w: G.ages(w.facts, w.as_of), sql(f"SELECT CASE WHEN a <= 7 THEN '0_7' WHEN a <= 30 THEN '8_30' WHEN a <= 90 THEN '31_90' ELSE '90_plus' END AS band, count(*) AS n FROM (SELECT note_id, {AS_OF} - min(opened_date) AS a FROM f GROUP BY note_id HAVING arg_max(action, action_at) <> 'closed') GROUP BY ALL")),
    "global_first_dates": (lambda w: G.first_dates(w.facts), sql("SELECT min(action_date) FILTER (action = 'opened') AS first_opened, min(action_date) FILTER (action = 'closed') AS first_closed, max(action_at) AS last_at FROM f")),
    **{f"profile_global_top_{a}": (lambda w, a=a: G.top_notes(w.facts, a), sql(f"SELECT note_id, count(*) AS n FROM f WHERE action = '{a}' GROUP BY note_id ORDER BY n DESC, note_id LIMIT 10")) for a in ("commented", "reopened")},
}
