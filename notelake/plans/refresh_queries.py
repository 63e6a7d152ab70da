"""Queries over facts that come in three loads, and over marts that are brought up to date after each, with SQL for a full build."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import facts as A
from ..operators import marts as M
from ..operators.partials import Marts
from ..sources.layers import Layers
from ..sources.store import folder
from .mart_queries import Plan
from .oracle import AS_OF, five, sql, top
from .warehouse import Warehouse

#: Which actions come later than they were done, and the times from which the others are in the second and third load.
LATE, STEPS = "(note_id * 7 + sequence_action) % 53 = 0", ("2024-01-29", "2024-01-30 12:00:00")
#: What has come by the end of each load.
CAME = (f"created_at < '{STEPS[0]}' AND NOT {LATE}", f"created_at < '{STEPS[1]}' AND (note_id % 2 = 0 OR NOT {LATE})", "true")


@dataclass
class Loaded:
    """Facts and marts after three loads; `before` is the version of the sums ahead of the last."""

    facts: Layers
    marts: Marts
    before: int


_LOADED: dict[tuple[str, str], Loaded] = {}


def _loaded(w: Warehouse) -> Loaded:
    """Once for each application and folder of tables."""
    key = (w.spark.sparkContext.applicationId, w.sf_dir)
    if key not in _LOADED:
        into, marts, before = A.table(w.spark, folder(w.spark, "facts")), Marts(w.spark, folder(w.spark, "marts")), 0
        for came in CAME:
            before = marts.sums.snapshot()["version"]
            A.load(A.arrived(w.base, F.expr(came)), into)
            marts.refresh(into)
        _LOADED[key] = Loaded(into, marts, before)
    return _LOADED[key]


def _incremental(w: Warehouse) -> DataFrame:
    """The facts of a first load and of two after it, which bring later actions and late ones."""
    into = A.table(w.spark, folder(w.spark, "facts"))
    for came in CAME:
        A.load(A.arrived(w.base, F.expr(came)), into)
    return into.read().select("note_id", "seq", "action", "days_active", "prior_actions", "recent_open_date", "next_close_date")


def _modified(x: Loaded, kind: str) -> DataFrame:
    return x.marts.modified(x.before).where(F.col("kind") == kind)


def _work_list(kind: str, e: str) -> Plan:
    """Modified entities in the order of work, and that order."""

    def plan(w: Warehouse) -> DataFrame:
        x = _loaded(w)
        return M.prioritised(x.facts.read(), _modified(x, kind).select(F.col("entity").alias(e)), e, w.as_of).select(e, "last_action", "n", "recency", "activity", "place")

    since = lambda days: f"max(action_at) >= {AS_OF} - INTERVAL {days} DAY"
    return plan, sql(f"""SELECT *, CAST(row_number() OVER (ORDER BY recency, activity, n DESC, last_action DESC, {e}) AS INTEGER) AS place FROM (
        SELECT {e}, max(action_at) AS last_action, count(*) AS n, CASE WHEN {since(7)} THEN 1 WHEN {since(30)} THEN 2 WHEN {since(90)} THEN 3 ELSE 4 END AS recency,
        CASE WHEN count(*) > 100 THEN 1 WHEN count(*) > 10 THEN 2 ELSE 3 END AS activity FROM f WHERE {e} IN (SELECT {e} FROM f WHERE {_TOUCHED}) GROUP BY {e}) QUALIFY place <= 500""")


def _refreshed_tags(w: Warehouse) -> DataFrame:
    x = _loaded(w)
    return x.marts.marts["tops"].read().where("family = 'tag'").join(x.marts.modified(x.before), ["kind", "entity"], "left_semi").select("kind", "entity", "key", "n", "rank")


_TOUCHED = f"note_id IN (SELECT note_id FROM comments WHERE NOT (created_at < TIMESTAMP '{STEPS[1]}' AND (note_id % 2 = 0 OR (note_id * 7 + seq) % 53 <> 0)))"
_KINDS = (("country", "country"), ("user", "action_user"))
_BOTH = lambda select: " UNION ALL ".join(select.format(kind=kind, e=e) for kind, e in _KINDS)
_FIVE = ", ".join(f"{c} AS {m}" for c, m in zip(five(), M.MEASURES, strict=True))

PLANS: dict[str, Plan] = {
    "facts_incremental": (_incremental, sql("SELECT f.note_id, f.seq, action, days_active, prior_actions, recent_open_date, CAST(next_at AS DATE) AS next_close_date FROM f LEFT JOIN nc USING (note_id, seq)")),
    "mart_refresh_yearly": (
        lambda w: _loaded(w).marts.marts["yearly"].read(),
        sql(_BOTH(f"SELECT '{{kind}}' AS kind, CAST({{e}} AS BIGINT) AS entity, CAST(year(action_date) AS INTEGER) AS year, {_FIVE}, avg(days_to_resolution) AS avg_days, median(days_to_resolution) AS median_days FROM f GROUP BY ALL")),
    ),
    "mart_refresh_hours": (
        lambda w: _loaded(w).marts.marts["hours"].read(),
        sql(_BOTH("SELECT '{kind}' AS kind, CAST({e} AS BIGINT) AS entity, action, CAST(action_how // 100 AS INTEGER) AS dow, CAST(action_how % 100 AS INTEGER) AS hour, count(*) AS n FROM f WHERE action IN ('opened', 'commented', 'closed') GROUP BY ALL")),
    ),
    "hashtag_refresh_modified": (
        _refreshed_tags,
        sql(_BOTH(top("SELECT '{kind}' AS kind, CAST({e} AS BIGINT) AS entity, tag AS key, count(*) AS n FROM tg WHERE {e} IN (SELECT {e} FROM f WHERE $TOUCHED) GROUP BY ALL", "entity", 50)).replace("$TOUCHED", _TOUCHED)),
    ),
    "country_work_list": _work_list("country", "country"),
    "user_work_list": _work_list("user", "action_user"),
    "country_years_to_process": (
        lambda w: _loaded(w).marts.years(_loaded(w).before).where("kind = 'country'").select("entity", "year"),
        sql(f"SELECT DISTINCT CAST(country AS BIGINT) AS entity, CAST(year(action_date) AS INTEGER) AS year FROM f WHERE {_TOUCHED}"),
    ),
}
