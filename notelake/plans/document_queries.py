"""Queries of documents, indexes and profiles: written, read back and compared field by field, with their SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators import documents as D
from ..operators import exports as X
from ..operators import global_mart as G
from ..operators import marts as M
from ..operators import rankings as R
from ..sources.publish import Publication
from ..sources.store import folder
from .global_queries import PLANS as GLOBAL
from .mart_queries import MARTS, USERS, Plan
from .oracle import AS_OF, sql
from .warehouse import Warehouse

KINDS = {"user": ("action_user", "country"), "country": ("country", "action_user")}
_ACTS = (("opened", "open"), ("commented", "commented"), ("closed", "closed"), ("reopened", "reopened"))
_PLACED = ("rank", "key", "n")


def _items(kind: str) -> dict[str, tuple[str, ...]]:
    """The lists of a document with the fields of their items."""
    things = "countries" if kind == "user" else "users"
    placed = ["dates_most_open", "dates_most_closed", "hashtags", "hashtags_opening", "hashtags_resolution", "hashtags_comments"]
    placed += [f"{things}_{role}_notes{end}" for role in ("open", "solving") for end in ("", "_current_month", "_current_day")]
    return dict.fromkeys(placed, _PLACED) | {f"working_hours_of_week_{k}": ("dow", "hour", "n") for k in ("opening", "commenting", "closing")} | {"history_by_year": ("year", *M.MEASURES)}


def _text(name: str, item: tuple[str, ...]) -> Column:
    one = F.array_join(F.transform(name, lambda x: F.concat_ws(":", *[x[i].cast("string") for i in item])), ",")
    return F.nullif(one, F.lit("")).alias(name)


def _mart(w: Warehouse, kind: str) -> DataFrame:
    if kind == "user":
        return D.users(w.facts, w.status, w.base.users, w.as_of)
    return D.countries(w.facts, w.status, w.base.countries, w.as_of)


def _document(w: Warehouse, kind: str) -> DataFrame:
    e, other = KINDS[kind]
    return _mart(w, kind).join(D.lists(w.facts, w.tags, e, other, w.as_of).withColumnRenamed(e, f"{kind}_id"), f"{kind}_id", "left")


def _flat(docs: DataFrame, kind: str) -> DataFrame:
    """The documents with their lists as text."""
    items = _items(kind)
    return docs.select(*[_text(c, items[c]) if c in items else F.col(c) for c in docs.columns])


def _published(w: Warehouse, kind: str, path: Callable[[Column], Column]) -> DataFrame:
    """The documents of a kind, a file each, published and read back, with the file that each is at."""
    target, docs = folder(w.spark, "published"), _document(w, kind)
    with Publication(w.spark, target) as p:
        p.documents(X.placed(docs, f"{kind}_id", path))
    return X.read_documents(docs.schema, w.spark, f"{target}/{'users/*/*/*' if kind == 'user' else 'countries'}/*.json")


def _user_json(w: Warehouse) -> DataFrame:
    back = _published(w, "user", X.user_path)
    parts = F.split("file", "/")
    folders = [F.element_at(parts, k - 5).alias(f"in_d{k}") for k in (1, 2, 3)]
    return _flat(back.drop("file"), "user").join(back.select("user_id", *folders, F.element_at(parts, -1).alias("file_name")), "user_id")


def _country_json(w: Warehouse) -> DataFrame:
    back = _published(w, "country", X.country_path)
    return _flat(back.drop("file"), "country").join(back.select("country_id", F.element_at(F.split("file", "/"), -1).alias("file_name")), "country_id")


def _scalars(kind: str) -> tuple[list[str], str, str]:
    """SQL: the single fields of a document, the marts that they come from, and the condition on them."""
    e, _ = KINDS[kind]
    history = [f"h.{span}_{m} AS history_{span}_{m}" for span in ("whole", "year", "month", "day") for m in M.MEASURES]
    notes = [f"first_{a}_note AS first_{n}_note_id, latest_{a}_note AS latest_{n}_note_id" for a, n in _ACTS]
    fields = [
        *history, "date_first_opened AS date_starting_creating_notes, date_first_closed AS date_starting_solving_notes", *notes, f"CAST({AS_OF} - CAST(last_action AS DATE) AS INTEGER) AS days_since_last_action",
        "avg_days AS avg_days_to_resolution, median_days AS median_days_to_resolution, r.rate AS resolution_rate, r.resolved AS notes_resolved_count, r.still_open AS notes_still_open_count",
        "he.open_notes AS active_notes_count, age_0_7, age_8_30, age_31_90, age_90_plus, created_30 AS notes_created_last_30_days, resolved_30 AS notes_resolved_last_30_days",
        "names AS applications_used, most_used AS most_used_application, mobile AS mobile_apps_count, desktop AS desktop_apps_count, activity AS last_year_activity",
    ]
    marts = {"l": "first_last", "r": "resolution", "he": "health", "ac": "last_year_activity"}
    source = f"({MARTS[f'{kind}_history'][1]}) h " + " ".join(f"JOIN ({MARTS[f'{kind}_{m}'][1]}) {x} ON {x}.{e} = h.{e}" for x, m in marts.items())
    source += f" LEFT JOIN ({MARTS[f'{kind}_applications'][1]}) ap ON ap.{e} = h.{e}"
    if kind == "user":
        kinds = ", ".join(f"({k}, '{n}')" for k, n in enumerate(D.CONTRIBUTORS, 1))
        fields += ["h.action_user AS user_id, 'user' || h.action_user AS username, contributor_type AS id_contributor_type, kind_name AS contributor_type_name, a.days AS user_response_time"]
        source += f" JOIN ({USERS['user_contributor_type'][1]}) ct ON ct.{e} = h.{e} JOIN (VALUES {kinds}) k(kind, kind_name) ON k.kind = contributor_type LEFT JOIN ({USERS['user_response_time'][1]}) a ON a.{e} = h.{e}"
    else:
        name = lambda x: f"coalesce({x}, '{D.NOWHERE}')"
        fields += [f"h.country AS country_id, {name('n_name')} AS country_name, {name('lower(n_name)')} AS country_name_es, coalesce(array_to_string(list_transform(string_split(lower(n_name), ' '), lambda x: upper(x[1]) || x[2:]), ' '), '{D.NOWHERE}') AS country_name_en, sc.score AS notes_health_score, nr.ratio AS new_vs_resolved_ratio"]
        source += f" JOIN ({MARTS['country_health_score'][1]}) sc ON sc.{e} = h.{e} JOIN ({MARTS['country_new_vs_resolved'][1]}) nr ON nr.{e} = h.{e} LEFT JOIN nation ON n_nationkey = h.country AND n_nationkey <> 24"
    return fields, source, f"h.{e} <> -1" if kind == "user" else "true"


def _lists(kind: str) -> tuple[list[str], str]:
    """SQL: the lists of a document as text, and what they come from."""
    e, _ = KINDS[kind]
    things = "countries" if kind == "user" else "users"
    placed = lambda name, cond: f"string_agg(rank || ':' || key || ':' || n, ',' ORDER BY rank, key) FILTER ({cond}) AS {name}"
    role = {"open": "opened", "solving": "closed"}
    groups = {
        "dm": ("dates_most", [placed("dates_most_open", "action = 'opened'"), placed("dates_most_closed", "action = 'closed'")]),
        "ht": ("hashtags", [placed("hashtags", "true")]),
        "ha": (
            "hashtags_by_action",
            [placed(f"hashtags_{k}", f"action = '{a}'") for k, a in (("opening", "opened"), ("resolution", "closed"), ("comments", "commented"))]
            + [f"arg_min(key, {{'r': rank, 'k': key}}) FILTER (action = '{a}') AS favorite_{k}_hashtag, CAST(coalesce(sum(n) FILTER (action = '{a}'), 0) AS BIGINT) AS {k}_hashtag_count" for k, a in (("opening", "opened"), ("resolution", "closed"))],
        ),
        "rk": ("rankings", [placed(f"{things}_{r}_notes{end}", f"action = '{a}' AND span = '{span}'") for r, a in role.items() for end, span in (("", "all"), ("_current_month", "month"), ("_current_day", "day"))]),
        "wh": ("working_hours", [f"string_agg(dow || ':' || hour || ':' || n, ',' ORDER BY dow, hour) FILTER (action = '{a}') AS working_hours_of_week_{k}" for k, a in (("opening", "opened"), ("commenting", "commented"), ("closing", "closed"))]),
        "hy": ("history_by_year", ["string_agg(year || ':' || " + " || ':' || ".join(M.MEASURES) + ", ',' ORDER BY year) AS history_by_year"]),
    }
    source = " ".join(f"LEFT JOIN (SELECT {e}, {', '.join(cols)} FROM ({MARTS[f'{kind}_{mart}'][1]}) GROUP BY {e}) {x} ON {x}.{e} = h.{e}" for x, (mart, cols) in groups.items())
    names = [f"{x}.* EXCLUDE ({e})" for x in groups]
    return names, source


def _document_sql(kind: str) -> str:
    fields, source, where = _scalars(kind)
    names, more = _lists(kind)
    return f"SELECT {', '.join([*fields, *names])} FROM {source} {more} WHERE {where}"


def _index(kind: str, fields: list[str]) -> Plan:
    """The index as a published array, read back with the places in the file."""

    def run(w: Warehouse) -> DataFrame:
        target, mart = folder(w.spark, "published"), _mart(w, kind)
        rows = mart.select(*fields)
        with Publication(w.spark, target) as p:
            p.array(rows.withColumn("document", F.to_json(F.struct(*fields), X.JSON)), D.index_order(rows, fields[0]), f"indexes/{kind}.json")
        return X.read_array(rows.schema, w.spark, f"{target}/indexes/{kind}.json")

    place = f"CAST(row_number() OVER (ORDER BY history_whole_open DESC NULLS LAST, history_whole_closed DESC NULLS LAST, {fields[0]}) AS INTEGER) AS place"
    return run, f"SELECT {', '.join(fields)}, {place} FROM ({_scalars_sql(kind)})"


def _scalars_sql(kind: str) -> str:
    fields, source, where = _scalars(kind)
    return f"SELECT {', '.join(fields)} FROM {source} WHERE {where}"


_OVERALL = f"""SELECT {', '.join(f'c.{span}_{a} AS history_{span}_{n}' for span in ('whole', 'year') for a, n in (*_ACTS, ('hidden', 'hidden')))},
 avg_days AS avg_days_to_resolution, median_days AS median_days_to_resolution, avg_days_year AS avg_days_to_resolution_current_year, median_days_year AS median_days_to_resolution_current_year, rate AS resolution_rate,
 open_notes AS currently_open_count, closed_notes AS currently_closed_count, backlog AS notes_backlog_size, created AS notes_created_last_30_days, resolved AS notes_resolved_last_30_days, active_users AS active_users_count,
 avg_length AS avg_comment_length, url_pct AS comments_with_url_pct, mention_pct AS comments_with_mention_pct, cc.whole AS history_whole_closed_with_comment, cc.year AS history_year_closed_with_comment,
 first_opened AS date_starting_creating_notes, first_closed AS date_starting_solving_notes, last_at AS last_action_timestamp, mean AS avg_comments_per_note
 FROM ({GLOBAL['global_counts'][1]}) c, ({GLOBAL['global_resolution'][1]}), ({GLOBAL['global_status'][1]}), ({GLOBAL['global_30_days'][1]}), ({GLOBAL['global_comment_metrics'][1]}), ({GLOBAL['global_closed_with_comment'][1]}) cc, ({GLOBAL['global_first_dates'][1]}), ({GLOBAL['global_avg_comments_per_note'][1]})"""


def _global_json(w: Warehouse) -> DataFrame:
    row, target = D.overall(w.facts, w.status, w.as_of), folder(w.spark, "published")
    with Publication(w.spark, target) as p:
        p.documents(row.select(F.lit("global.json").alias("path"), F.to_json(F.struct("*"), X.JSON).alias("document")))
    return X.read_documents(row.schema, w.spark, f"{target}/global.json").drop("file")


def _history_schema(kind: str, e: str, key: str) -> str:
    names = [f"{span}_{m}" for span in ("whole", "year", "month", "day") for m in M.MEASURES]
    return "|".join([f"{e}:{key}:1", *[f"{n}:bigint:{i}" for i, n in enumerate(names, 2)]])


def _validated(w: Warehouse) -> DataFrame:
    """Documents of which some are cut off and some lack a field; no publication comes of them, one of the good ones does."""
    docs = X.documents(M.history(w.facts, "country", w.as_of), "country").withColumn("path", X.country_path(F.col("country")))
    spoilt = F.when(F.col("country") % 7 == 0, F.substring("document", 1, 30)).when(F.col("country") % 5 == 0, F.replace(F.col("document"), F.lit("whole_open"), F.lit("other"))).otherwise(F.col("document"))
    checked = X.valid(docs.withColumn("document", spoilt), "country int, whole_open long, whole_closed long", ["country", "whole_open"])
    path = folder(w.spark, "published")
    whole, part = X.publish(checked, path), X.publish(checked.where("ok"), path)
    count = w.spark.read.text(f"{path}/countries/*.json", wholetext=True).agg(F.count("*").alias("files"))
    return checked.select("country", "ok").crossJoin(F.broadcast(count)).select("*", F.lit(whole).alias("all_published"), F.lit(part).alias("good_published"))  # one row


def _profile(kind: str, e: str) -> Plan:
    def run(w: Warehouse) -> DataFrame:
        m = _mart(w, kind).join(D.ranks(w.facts, e).withColumnRenamed(e, f"{kind}_id"), f"{kind}_id", "left")
        d = D.lists(w.facts, w.tags, e, KINDS[kind][1], w.as_of).withColumnRenamed(e, f"{kind}_id")
        since = lambda c: F.datediff(F.lit(w.as_of), F.col(c))
        return _flat(m.join(d, f"{kind}_id", "left"), kind).select(
            "*",
            since("date_starting_creating_notes").alias("days_since_open"),
            since("date_starting_solving_notes").alias("days_since_close"),
            (F.col("history_whole_closed") - F.col("active_notes_count")).alias("closed_minus_backlog"),
        )

    place = lambda a, n: f"LEFT JOIN (SELECT {e}, CAST(rank() OVER (ORDER BY n DESC) AS INTEGER) AS rank_{n} FROM (SELECT {e}, count(DISTINCT note_id) AS n FROM f WHERE action = '{a}' GROUP BY {e})) {n} ON {n}.{e} = d.{kind}_id"
    days = f"CAST({AS_OF} - date_starting_creating_notes AS INTEGER) AS days_since_open, CAST({AS_OF} - date_starting_solving_notes AS INTEGER) AS days_since_close"
    return run, sql(f"SELECT d.*, rank_open, rank_closed, {days}, history_whole_closed - active_notes_count AS closed_minus_backlog FROM ({_document_sql(kind)}) d {place('opened', 'open')} {place('closed', 'closed')}")


def _global_profile(w: Warehouse) -> DataFrame:
    """Per year and for the spans all, year, month and day: actions, and users by role."""
    f, at = w.facts, F.lit(w.as_of)
    d = F.col("action_date")
    spans = [F.lit("all"), F.year(d).cast("string"), F.when(F.year(d) == F.year(at), "current year"), F.when(F.trunc(d, "month") == F.trunc(at, "month"), "current month"), F.when(d == at, "current day")]
    rows = f.select("action", "action_user", F.explode(F.array_compact(F.array(*spans))).alias("span"))
    return rows.groupBy("span").agg(*[M.count_of(M.is_(a)).alias(a) for a in G.ACTIONS], *[F.countDistinct(F.when(M.is_(a), F.col("action_user"))).alias(f"users_{a}") for a in ("opened", "closed", "commented")])


_PATH = ", substring(hx, 1, 1) AS in_d1, substring(hx, 2, 1) AS in_d2, substring(hx, 3, 1) AS in_d3"
_SPANS = f"['all', CAST(year(action_date) AS VARCHAR), CASE WHEN year(action_date) = year({AS_OF}) THEN 'current year' END, CASE WHEN date_trunc('month', action_date) = date_trunc('month', {AS_OF}) THEN 'current month' END, CASE WHEN action_date = {AS_OF} THEN 'current day' END]"
_TAGS = lambda e: f"SELECT h.{e}, {_lists('user' if e == 'action_user' else 'country')[0][2]} FROM (SELECT DISTINCT {e} FROM ({MARTS[('user' if e == 'action_user' else 'country') + '_hashtags_by_action'][1]})) h {_lists('user' if e == 'action_user' else 'country')[1]}"


def _tag_metrics(kind: str) -> Plan:
    e, _ = KINDS[kind]
    items = _items(kind)
    run = lambda w: (lambda t: t.select(*[_text(c, items[c]) if c in items else F.col(c) for c in t.columns]))(D.tag_metrics(w.tags, e))
    return run, _TAGS(e)


#: When the query's export is said to be made.
_EXPORTED = datetime(2024, 1, 31, 6, 30)

PLANS: dict[str, Plan] = {
    "sink_user_json": (_user_json, f"SELECT * EXCLUDE (hx){_PATH}, user_id || '.json' AS file_name FROM (SELECT *, lpad(lower(to_hex((user_id % 4096 + 4096) % 4096)), 3, '0') AS hx FROM ({_document_sql('user')}))"),
    "sink_country_json": (_country_json, f"SELECT *, country_id || '.json' AS file_name FROM ({_document_sql('country')})"),
    "sink_user_index": _index("user", D.USER_INDEX),
    "sink_country_index": _index("country", D.COUNTRY_INDEX),
    "sink_global_json": (_global_json, _OVERALL),
    "sink_global_summary": (lambda w: D.overall(w.facts, w.status, w.as_of).select(*D.SUMMARY), f"SELECT {', '.join(D.SUMMARY)} FROM ({_OVERALL})"),
    "sink_export_metadata": (
        lambda w: X.metadata({"country": M.history(w.facts, "country", w.as_of), "user": M.history(w.facts, "action_user", w.as_of)}, _EXPORTED),
        f"SELECT 'country' AS name, count(*) AS rows, sha256('{_history_schema('country', 'country', 'int')}') AS schema_hash, TIMESTAMP '2024-01-31 06:30:00' AS exported_at, '1.0.0' AS version FROM ({MARTS['country_history'][1]}) UNION ALL SELECT 'user', count(*), sha256('{_history_schema('user', 'action_user', 'bigint')}'), TIMESTAMP '2024-01-31 06:30:00', '1.0.0' FROM ({MARTS['user_history'][1]})",
    ),
    "export_schema_validate": (
        _validated,
        sql("SELECT country, country % 7 <> 0 AND country % 5 <> 0 AS ok, (SELECT count(DISTINCT country) FROM f WHERE country % 7 <> 0 AND country % 5 <> 0) AS files, false AS all_published, true AS good_published FROM (SELECT DISTINCT country FROM f)"),
    ),
    "user_export_view": (lambda w: _mart(w, "user").drop("contributor_type_name"), f"SELECT * EXCLUDE (contributor_type_name) FROM ({_scalars_sql('user')})"),
    "hashtag_metrics_country": _tag_metrics("country"),
    "hashtag_metrics_user": _tag_metrics("user"),
    "profile_user": _profile("user", "action_user"),
    "profile_country": _profile("country", "country"),
    "profile_global": (
        _global_profile,
        sql(f"SELECT span, {', '.join(f'''count(*) FILTER (action = '{a}') AS {a}''' for a in G.ACTIONS)}, {', '.join(f'''count(DISTINCT action_user) FILTER (action = '{a}') AS users_{a}''' for a in ('opened', 'closed', 'commented'))} FROM (SELECT action, action_user, unnest({_SPANS}) AS span FROM f) WHERE span IS NOT NULL GROUP BY span"),
    ),
    "rank_users_global": (
        lambda w: R.users(w.facts, "opened").withColumn("kind", F.lit("opened")).unionByName(R.users(w.facts, "closed").withColumn("kind", F.lit("closed"))),
        sql("SELECT * FROM (SELECT *, CAST(rank() OVER (PARTITION BY kind ORDER BY n DESC) AS INTEGER) AS rank FROM (SELECT action_user, action AS kind, count(DISTINCT note_id) AS n FROM f WHERE action IN ('opened', 'closed') AND action_user <> -1 GROUP BY ALL)) WHERE rank <= 100"),
    ),
    "rank_users_json": (
        lambda w: R.users_document(w.facts, "month", w.as_of),
        sql("SELECT action_user, " + ", ".join(f"any_value(rank) FILTER (action = '{a}') AS {a}_rank, any_value(n) FILTER (action = '{a}') AS {a}_n" for a in ("opened", "closed", "commented")) + f" FROM (SELECT *, CAST(rank() OVER (PARTITION BY action ORDER BY n DESC) AS INTEGER) AS rank FROM (SELECT action_user, action, CASE WHEN action = 'commented' THEN count(*) ELSE count(DISTINCT note_id) END AS n FROM f WHERE action IN ('opened', 'closed', 'commented') AND action_user <> -1 AND date_trunc('month', action_date) = date_trunc('month', {AS_OF}) GROUP BY action_user, action)) WHERE rank <= 100 GROUP BY action_user"),
    ),
}
