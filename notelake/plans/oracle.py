"""The SQL of the base tables and facts, shared by the queries' SQL. Written by hand, for DuckDB."""

from ..functions.places import COUNTRIES
from ..functions.places import REGIONS as _REGIONS

AS_OF = "DATE '2024-01-31'"


def values(rows: list[tuple]) -> str:
    """A VALUES list of texts and nulls."""
    return "(VALUES " + ", ".join("(" + ", ".join("NULL" if v is None else f"'{v}'" for v in r) + ")" for r in rows) + ")"


REGIONS = values(_REGIONS) + " rg(region, continent)"
#: The known nations with their codes and region.
LOCATED = f"(SELECT nation.*, alpha2, alpha3, coalesce(region, 'Undefined') AS region FROM nation LEFT JOIN {values(COUNTRIES)} c(name, alpha2, alpha3, region) ON lower(n_name) = lower(name) WHERE n_nationkey <> 24)"

BASE = """
WITH cnt AS (SELECT greatest(count(*) // 4, 1) AS n FROM events), dc AS (SELECT greatest(count(*), 1) AS m FROM documents),
e AS (SELECT event_id AS k, event_id % n AS note_id, ts, user_id, event_type, row_number() OVER (PARTITION BY event_id % n ORDER BY ts, event_id) AS seq FROM events, cnt),
d AS (SELECT doc_id, text AS t FROM documents),
comments AS (SELECT note_id, seq, k, ts AS created_at, CASE WHEN user_id % 10 <> 0 THEN user_id END AS id_user,
  CASE WHEN seq = 1 THEN 'opened' WHEN k % 97 = 0 THEN 'hidden' WHEN event_type = 'error' THEN 'reopened' WHEN event_type IN ('purchase', 'signup') THEN 'closed' ELSE 'commented' END AS action FROM e),
texts AS (SELECT note_id, seq, CASE WHEN k % 19 <> 0 THEN coalesce(d.t, '')
  || CASE WHEN k % 3 = 0 THEN ' #tag' || (k % 11) ELSE '' END
  || CASE WHEN k % 5 = 0 THEN ' #Topic' || (k % 7) || '#glued' ELSE '' END
  || CASE WHEN k % 7 = 0 THEN ' @user' || (k % 13) ELSE '' END
  || CASE WHEN k % 11 = 0 THEN ' https://x.example/' || k ELSE '' END
  || CASE WHEN k % 29 = 0 THEN ' # alone #late' ELSE '' END
  || CASE WHEN k % 4 = 1 THEN ' via StreetComplete ' || (k % 60) || '.2' WHEN k % 4 = 2 THEN ' #OsmAnd' WHEN k % 8 = 3 THEN ' #organicmaps android' WHEN k % 8 = 7 THEN ' #MapComplete #notes' ELSE '' END END AS body
  FROM comments, dc LEFT JOIN d ON d.doc_id = k % m),
notes AS (SELECT note_id, CASE WHEN note_id % 101 <> 0 THEN CAST(note_id * 37 % 179 - 89 AS DOUBLE) END AS latitude, CASE WHEN note_id % 101 <> 0 THEN CAST(note_id * 73 % 359 - 179 AS DOUBLE) END AS longitude,
  CASE WHEN note_id % 25 <> 24 THEN CAST(note_id % 25 AS INTEGER) ELSE -1 END AS country FROM (SELECT DISTINCT note_id FROM comments)),
"""

FACTS = (
    BASE
    + """
j AS (SELECT c.note_id, c.seq, c.action, c.created_at AS action_at, coalesce(c.id_user, -1) AS action_user, n.country, n.latitude, n.longitude, t.body
  FROM comments c JOIN notes n USING (note_id) LEFT JOIN texts t ON t.note_id = c.note_id AND t.seq = c.seq
  QUALIFY row_number() OVER (PARTITION BY c.note_id, c.created_at ORDER BY c.seq) = 1),
g AS (SELECT *, CAST(action_at AS DATE) AS action_date, CAST(isodow(action_at) * 100 + hour(action_at) AS INTEGER) AS action_how,
  CASE WHEN longitude IS NULL THEN 0 ELSE CAST(least(greatest(round(longitude / 15), -12), 14) AS INTEGER) END AS zone,
  CASE WHEN latitude IS NULL OR latitude BETWEEN -10 AND 10 THEN 0
       WHEN latitude > 10 THEN CASE WHEN month(action_at) BETWEEN 3 AND 5 THEN 1 WHEN month(action_at) BETWEEN 6 AND 8 THEN 2 WHEN month(action_at) BETWEEN 9 AND 11 THEN 3 ELSE 4 END
       ELSE CASE WHEN month(action_at) BETWEEN 3 AND 5 THEN 4 WHEN month(action_at) BETWEEN 6 AND 8 THEN 3 WHEN month(action_at) BETWEEN 9 AND 11 THEN 2 ELSE 1 END END AS season,
  CAST(length(body) AS INTEGER) AS comment_length, coalesce(regexp_matches(body, 'https?://'), false) AS has_url, coalesce(regexp_matches(body, '@[\\p{L}\\p{M}\\p{N}_]'), false) AS has_mention,
  regexp_extract_all(coalesce(body, ''), '#([\\p{L}\\p{M}\\p{N}_]*)(?:[\\s\\S]|$)', 1) AS found,
  CASE WHEN action = 'opened' THEN CASE WHEN contains(body, 'via StreetComplete') THEN 'StreetComplete' WHEN body LIKE '%#OsmAnd' THEN 'OsmAnd' WHEN body LIKE '%#organicmaps android' THEN 'OrganicMaps' WHEN body LIKE '%#MapComplete #notes' THEN 'MapComplete' END END AS app FROM j),
h AS (SELECT *, CASE app WHEN 'OrganicMaps' THEN 'android' WHEN 'MapComplete' THEN 'web' END AS platform, CASE WHEN list_contains(found, '') THEN found[1:list_position(found, '')] ELSE found END AS hashtags,
  CASE WHEN app IS NOT NULL THEN nullif(regexp_extract(body, '(\\d+\\.\\d+(\\.\\d+)?)', 1), '') END AS app_version,
  action_at + to_hours(zone) AS local_at,
  max(CASE WHEN action = 'opened' THEN action_at END) OVER w AS opened_at, max(CASE WHEN action = 'opened' THEN action_user END) OVER w AS opened_user,
  max(CASE WHEN action IN ('opened', 'reopened') THEN action_date END) OVER w AS recent_open_date,
  max(CASE WHEN action = 'reopened' THEN action_date END) OVER w AS reopen_date,
  CAST(count(CASE WHEN action = 'commented' THEN 1 END) OVER p AS BIGINT) AS prior_commented, CAST(count(CASE WHEN action = 'reopened' THEN 1 END) OVER p AS BIGINT) AS prior_reopened, CAST(count(*) OVER p AS BIGINT) AS prior_actions,
  count(CASE WHEN action = 'closed' AND length(coalesce(body, '')) > 0 THEN 1 END) OVER (PARTITION BY note_id) AS closing_texts
  FROM g WINDOW w AS (PARTITION BY note_id ORDER BY action_at, seq ROWS UNBOUNDED PRECEDING), p AS (PARTITION BY note_id ORDER BY action_at, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, CAST(local_at AS DATE) AS local_date, CAST(isodow(local_at) * 100 + hour(local_at) AS INTEGER) AS local_how, CAST(opened_at AS DATE) AS opened_date,
  CASE WHEN action = 'closed' THEN action_date END AS closed_date, CASE WHEN action = 'closed' THEN action_user END AS closed_user,
  CASE WHEN action = 'closed' THEN CAST(action_date - CAST(opened_at AS DATE) AS INTEGER) END AS days_to_resolution,
  CASE WHEN action = 'closed' THEN CAST(action_date - reopen_date AS INTEGER) END AS days_from_reopen,
  CASE WHEN action = 'closed' AND reopen_date IS NOT NULL THEN CAST(sum(CASE WHEN action <> 'closed' THEN action_date - recent_open_date ELSE 0 END) OVER (PARTITION BY note_id ORDER BY action_at, seq ROWS UNBOUNDED PRECEDING) AS BIGINT) END AS days_active,
  CASE WHEN action = 'closed' THEN CAST(closing_texts AS BIGINT) ELSE 0 END AS texts
  FROM h WHERE opened_at IS NOT NULL),
nc AS (SELECT o.note_id, o.seq, min(c.action_at) AS next_at, arg_min(c.action_user, c.action_at) AS next_user FROM f o JOIN f c ON c.note_id = o.note_id AND c.action = 'closed' AND c.action_at > o.action_at WHERE o.action = 'opened' GROUP BY ALL),
tg AS (SELECT note_id, seq, action, action_user, opened_user, country, days_to_resolution, comment_length, tag, CAST(position AS INTEGER) AS position
  FROM (SELECT *, unnest(hashtags) AS tag, generate_subscripts(hashtags, 1) AS position FROM f) WHERE tag <> ''),
st AS (SELECT note_id, any_value(country) AS country, any_value(opened_user) AS opened_user, arg_max(action, action_at) AS last_action, max(action_at) AS last_at, arg_max(action, action_at) <> 'closed' AS is_open
  FROM f WHERE action IN ('opened', 'closed', 'reopened') GROUP BY note_id)
"""
)


def sql(select: str) -> str:
    """A query over the facts (f), tags (tg), next closes (nc) and status (st)."""
    return FACTS + select.replace("$AS_OF", AS_OF)


def five(cond: str = "true") -> list[str]:
    """The five measures of marts."""
    return [
        f"count(*) FILTER (action = 'opened' AND {cond})", f"count(*) FILTER (action = 'commented' AND {cond})", f"count(*) FILTER (action = 'closed' AND {cond})",
        f"CAST(coalesce(sum(CASE WHEN action = 'closed' AND {cond} THEN texts END), 0) AS BIGINT)", f"count(*) FILTER (action = 'reopened' AND {cond})",
    ]


def top(inner: str, by: str, limit: int, value: str = "n", name: str = "key") -> str:
    """The first rows of each group with their RANK; inner is a grouped select."""
    return f"SELECT * EXCLUDE (rw) FROM (SELECT *, rank() OVER (PARTITION BY {by} ORDER BY {value} DESC) AS rank, row_number() OVER (PARTITION BY {by} ORDER BY {value} DESC, {name}) AS rw FROM ({inner})) WHERE rw <= {limit}"
