"""Queries of exports, triage and the load, with their SQL."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from ..operators import exports as X
from ..operators import marts as M
from ..operators import triage as T
from ..operators.status import current, merged
from ..sources import notes
from ..sources.store import folder
from .mart_queries import MARTS, USERS, Plan
from .oracle import AS_OF, sql, values

_CLEAN = "left(trim(replace(regexp_replace({0}, '[\\r\\n\\t]+', ' ', 'g'), '\"', '''')), 2000)"
_CLOSED = f"""SELECT country, CAST(row_number() OVER (PARTITION BY country ORDER BY closed_at DESC, note_id DESC) AS INTEGER) AS place, note_id, opened_at, closed_at, opened_user, closed_user, days, actions, comments, was_reopened, {_CLEAN.format('ob')} AS opening, {_CLEAN.format('cb')} AS closing
FROM (SELECT note_id, any_value(country) AS country, any_value(opened_at) AS opened_at, max(action_at) FILTER (action = 'closed') AS closed_at, any_value(opened_user) AS opened_user, arg_max(action_user, action_at) FILTER (action = 'closed') AS closed_user,
 arg_max(days_to_resolution, action_at) FILTER (action = 'closed') AS days, count(*) AS actions, count(*) FILTER (action = 'commented') AS comments, bool_or(action = 'reopened') AS was_reopened,
 arg_min_null(body, action_at) FILTER (action = 'opened') AS ob, arg_max_null(body, action_at) FILTER (action = 'closed') AS cb FROM f GROUP BY note_id) WHERE closed_at IS NOT NULL"""
_KEYS = lambda c: ", ".join(f"CAST(coalesce(bool_or(contains(lower({c}), '{a}') OR contains(lower({c}), '{b}')), false) AS INTEGER) AS has_{k}_keyword" for k, (a, b) in T.KEYWORDS.items())
_ASSISTED = ", ".join(f"'{a}'" for a in T.ASSISTED)
_ROWS = f"""SELECT f.note_id, f.country, comment_length, CAST(has_url AS INTEGER) AS has_url_int, CAST(has_mention AS INTEGER) AS has_mention_int, CAST(len(list_filter(hashtags, lambda x: x <> '')) AS INTEGER) AS hashtag_number,
 prior_commented AS total_comments_on_note, coalesce(hashtag_count, 0) AS hashtag_count, {', '.join(f'coalesce(has_{k}_keyword, 0) AS has_{k}_keyword' for k in T.KEYWORDS)}, CAST(coalesce(app IN ({_ASSISTED}), false) AS INTEGER) AS is_assisted_app,
 CAST(coalesce(contains(app, 'mobile') OR contains(app, 'app'), false) AS INTEGER) AS is_mobile_app, coalesce(rate, 0) AS country_resolution_rate, coalesce(avg_days, 0) AS country_avg_resolution_days, coalesce(score, 0) AS country_notes_health_score,
 coalesce(a.days, 0) AS user_response_time, coalesce(whole_open, 0) AS user_total_notes, coalesce(contributor_type, 0) AS user_experience_level, CAST(dayofweek(action_date) AS INTEGER) AS day_of_week, CAST(hour(action_at) AS INTEGER) AS hour_of_day, CAST(month(action_date) AS INTEGER) AS month,
 CASE WHEN next_at IS NULL THEN CAST({AS_OF} - action_date AS INTEGER) END AS days_open, has_url, CAST(next_at AS DATE) AS shut_on, {AS_OF} - action_date AS age, (SELECT min(c.action_date) FROM f c WHERE c.note_id = f.note_id AND c.action = 'commented') AS said_on
FROM f LEFT JOIN nc USING (note_id, seq) LEFT JOIN (SELECT note_id, count(DISTINCT tag) AS hashtag_count, {_KEYS('tag')} FROM tg WHERE action = 'opened' GROUP BY note_id) k ON k.note_id = f.note_id
LEFT JOIN ({MARTS['country_resolution'][1]}) r ON r.country = f.country LEFT JOIN ({MARTS['country_health_score'][1]}) s ON s.country = f.country
LEFT JOIN ({USERS['user_response_time'][1]}) a ON a.action_user = f.action_user LEFT JOIN ({MARTS['user_history'][1]}) u ON u.action_user = f.action_user LEFT JOIN ({USERS['user_contributor_type'][1]}) ct ON ct.action_user = f.action_user
WHERE action = 'opened' AND comment_length > 0"""
_FEATURES = ", ".join(T.FEATURES)
_METRICS = ("accuracy", "f1", "precision", "recall")
_TARGETS = """CASE WHEN shut_on IS NULL THEN NULL WHEN said_on < shut_on THEN 'contributes_with_change' ELSE 'doesnt_contribute' END AS main_category,
 CASE WHEN comment_length < 10 THEN 'empty' WHEN comment_length < 50 AND total_comments_on_note > 2 THEN 'lack_of_precision' WHEN comment_length > 200 AND has_url THEN 'advertising' WHEN shut_on IS NULL AND age > 180 THEN 'obsolete' WHEN is_assisted_app = 1 AND comment_length > 30 THEN 'adds_to_map' ELSE 'other' END AS specific_type,
 CASE WHEN shut_on IS NOT NULL AND said_on < shut_on THEN 'process' WHEN shut_on IS NOT NULL THEN 'close' WHEN comment_length < 50 AND total_comments_on_note > 2 THEN 'needs_more_data' END AS recommended_action"""
_TRAINING = f"SELECT note_id, country, {_FEATURES}, {_TARGETS} FROM ({_ROWS}) WHERE shut_on IS NOT NULL"


def _features(w):
    c = M.resolution(w.facts, "country").join(M.health_score(M.resolution(w.facts, "country"), M.health(w.facts, w.status, "country", w.as_of), "country"), "country")
    c = c.select("country", F.col("rate").alias("resolution_rate"), "avg_days", F.round("score", 6).alias("score"))
    u = M.history(w.facts, "action_user", w.as_of).select("action_user", F.col("whole_open").alias("opened")).join(M.contributor_type(w.facts, w.as_of), "action_user").join(M.response_time(w.facts).withColumnRenamed("days", "response_time"), "action_user", "left")
    return T.features(w.facts, w.tags, c, u.withColumnRenamed("action_user", "user"), w.as_of)


def _labelled(w):
    """Features and targets, written once, as three models read them."""
    path = folder(w.spark, "features")
    T.targets(_features(w), w.facts).write.parquet(path)
    return w.spark.read.parquet(path)


def _models(rows, within):
    return {t: T.train(rows.where(F.col("resolved") & within), t) for t in T.MODELS}


def _predictions(w):
    """Predictions for the notes that have no classification yet; every third has one."""
    rows = _labelled(w)
    return T.predict(_models(rows, ~T.held_out()), rows.where("note_id % 3 <> 0").drop(*T.MODELS))


def _all_predictions(w):
    """Predictions for all notes, those that have a classification included."""
    rows = _labelled(w)
    return T.predict(_models(rows, ~T.held_out()), rows.drop(*T.MODELS))


def _metrics(w, rows, within, version):
    models = _models(rows, within & ~T.held_out())
    found = [(t, version, k, float(v)) for t, m in models.items() for k, v in T.evaluate(m, rows.where(F.col("resolved") & T.held_out())).items()]
    return w.spark.createDataFrame(found, "target string, version int, metric string, value double")  # a row for each model and metric


def _trained(w):
    """The classes and samples that each model has learnt from."""
    rows = _labelled(w)
    models = _models(rows, F.lit(True))
    out = None
    for t, m in models.items():
        one = rows.where("resolved").groupBy(F.col(t).alias("class")).agg(F.count("*").alias("samples")).select(F.lit(t).alias("target"), "class", "samples", F.lit(len(T.FEATURES)).alias("features"), F.col("class").isin(*m.stages[0].labels).alias("known"))
        out = one if out is None else out.unionByName(one)
    return out


def _compared(w):
    """The metrics of models of all samples beside those of models of half of them."""
    rows = _labelled(w)
    return T.compare(_metrics(w, rows, F.col("note_id") % 2 == 0, 1).unionByName(_metrics(w, rows, F.lit(True), 2)))


def _spelt(w):
    """Tags with the parts that categories go by, in the tags' place."""
    parts = F.array(*[F.lit(x) for x in ("Fire", "bomberos", "emergency", "Airport", "seaplane", "avion", "wheels", "access", "silla", "missing", "mapping", "campaign", "fixme", "correccion", "error", "mapfix")])
    return w.tags.where("tag LIKE 'tag%'").withColumn("tag", F.concat("tag", F.get(parts, (F.col("note_id") % 16).cast("int"))))


def _priority(w):
    """The newest 50 open notes that change something and are to be processed, as predicted."""
    return _predictions(w).where("priority = 9").join(w.status.where("is_open"), "note_id").orderBy(F.desc("last_at"), "note_id").limit(50).select("note_id", "main_category", "recommended_action", "last_at")


def _closed_csv(w):
    """The CSV files of all countries, read back."""
    path, rows = folder(w.spark, "csv"), X.closed_notes(w.facts, bodies=w.bodies)
    X.write_csv(rows, path, "gzip")  # plain files of whole texts take several times the input
    return X.read_csv(w.spark, path, rows.schema)


def _published(w):
    return w.base.countries.where("country_id % 3 <> 0").select(F.col("country_id").alias("country"), F.when(F.col("country_id") % 2 == 0, F.lit("2023-12-01")).otherwise(F.lit("2024-01-30")).cast("date").alias("published_on")).unionByName(
        w.base.countries.limit(1).select(F.lit(999).alias("country"), F.lit("2024-01-30").cast("date").alias("published_on"))
    )


PLANS: dict[str, Plan] = {
    "export_incremental_select": (
        lambda w: X.unexported(w.facts.select("country").distinct(), w.facts.where("country % 2 = 0").select("country").distinct(), w.facts.where("country % 5 = 0").select("country").distinct(), "country", 10),
        sql("SELECT country FROM (SELECT DISTINCT country FROM f WHERE country % 2 <> 0 OR country % 5 = 0) ORDER BY country LIMIT 10"),
    ),
    "export_country_stale": (
        lambda w: X.stale(w.base.countries.select(F.col("country_id").alias("country"), (F.col("country_id") % 11 == 0).alias("flagged")), _published(w), "country", w.as_of, 7),
        "SELECT n_nationkey AS country, 'export' AS act FROM nation WHERE n_nationkey <> 24 AND (n_nationkey % 3 = 0 OR n_nationkey % 2 = 0 OR n_nationkey % 11 = 0) UNION ALL SELECT 999, 'drop'",
    ),
    "export_closed_notes_csv": (_closed_csv, sql(_CLOSED)),
    "csv_latest_close": (lambda w: X.latest_closes(w.facts, 5).select("country", "place", "note_id", "closed_at"), sql(f"SELECT country, place, note_id, closed_at FROM ({_CLOSED}) WHERE place <= 5")),
    "csv_note_metrics": (lambda w: w.facts.groupBy("note_id").agg(F.count("*").alias("actions"), F.bool_or(F.col("action") == "reopened").alias("was_reopened")), sql("SELECT note_id, count(*) AS actions, bool_or(action = 'reopened') AS was_reopened FROM f GROUP BY note_id")),
    "csv_open_close_bodies": (lambda w: X.closed_notes(w.facts, bodies=w.bodies).select("note_id", "opening", "closing"), sql(f"SELECT note_id, opening, closing FROM ({_CLOSED})")),
    "csv_country_list": (lambda w: X.country_list(w.facts), sql("SELECT country, max(action_at) AS last_close, count(*) AS closes FROM f WHERE action = 'closed' GROUP BY country")),
    "report_load": (
        lambda w: X.report(w.facts, w.tags, w.status),
        sql("SELECT metric, value FROM (UNPIVOT (SELECT count(*) AS facts, " + ", ".join(f"count(*) FILTER (action = '{a}') AS {a}" for a in ("opened", "commented", "closed", "reopened", "hidden")) + ", count(DISTINCT action_user) AS users, count(DISTINCT action_date) AS dates, (SELECT count(DISTINCT tag) FROM tg) AS tags, (SELECT count(*) FROM st WHERE is_open) AS open_notes, (SELECT count(*) FROM st WHERE NOT is_open) AS closed_notes FROM f) ON COLUMNS(*) INTO NAME metric VALUE value)"),
    ),
    "src_base_check": (lambda w: notes.present(w.base), "SELECT unnest(['notes', 'note_comments', 'note_comments_text', 'users', 'countries']) AS table_name, (SELECT count(*) > 0 FROM events) AS present"),
    "status_incremental": (
        lambda w: merged(current(w.facts.where("action_date < DATE '2024-01-20'")), current(w.facts.where("action_date >= DATE '2024-01-20'"))).select("note_id", "last_action", "is_open"),
        sql("SELECT note_id, last_action, is_open FROM st"),
    ),
    "ml_training_features": (lambda w: T.targets(_features(w), w.facts).where("resolved").drop("resolved"), sql(_TRAINING)),
    "ml_prediction_features": (lambda w: _features(w).select("note_id", "country", *T.FEATURES), sql(f"SELECT note_id, country, {_FEATURES} FROM ({_ROWS})")),
    "ml_train": (_trained, sql("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{t}' AS target, {t} AS class, count(*) AS samples, {len(T.FEATURES)} AS features, true AS known FROM ({_TRAINING}) GROUP BY {t}" for t in T.MODELS) + ")")),
    "ml_metrics": (lambda w: _metrics(w, _labelled(w), F.lit(True), 1), None),
    "ml_predictions": (_predictions, None),
    "ml_evaluate": (lambda w: _metrics(w, _labelled(w), F.lit(True), 1).drop("version"), None),
    "ml_compare": (_compared, None),
    "ml_predict": (_predictions, None),
    "ml_high_confidence": (lambda w: T.confident(_all_predictions(w)), None),
    "ml_priority_notes": (_priority, None),
    "ml_readiness": (lambda w: T.readiness(w.facts), sql("SELECT count(*) AS openings, count(next_at) AS resolved, count(next_at) >= 100 AS ready FROM f LEFT JOIN nc USING (note_id, seq) WHERE action = 'opened' AND comment_length > 0")),
    "ml_retrain_decision": (
        lambda w: T.retrain(w.facts, date(2024, 1, 15), w.as_of),
        sql("SELECT closes, fresh, 100::DOUBLE * fresh / closes AS pct, 100::DOUBLE * fresh / closes >= 10 AS retrain FROM (SELECT count(*) AS closes, count(*) FILTER (action_date > DATE '2024-01-15') AS fresh FROM f WHERE action = 'closed')"),
    ),
    "ml_hashtag_category": (
        lambda w: T.category(w.tags.unionByName(_spelt(w))),
        sql("""SELECT tag, CASE WHEN lower(tag) LIKE '%fire%' OR lower(tag) LIKE '%bomber%' OR lower(tag) LIKE '%emergency%' THEN 'firefighter' WHEN lower(tag) LIKE '%air%' OR lower(tag) LIKE '%plane%' OR lower(tag) LIKE '%avion%' THEN 'airplane'
        WHEN lower(tag) LIKE '%wheel%' OR lower(tag) LIKE '%access%' OR lower(tag) LIKE '%silla%' THEN 'wheelchair' WHEN lower(tag) LIKE '%missing%' OR lower(tag) LIKE '%map%' OR lower(tag) LIKE '%campaign%' THEN 'campaign'
        WHEN lower(tag) LIKE '%fix%' OR lower(tag) LIKE '%correc%' OR lower(tag) LIKE '%error%' THEN 'correction' ELSE 'other' END AS category, count(DISTINCT note_id) AS notes
        FROM (SELECT note_id, tag FROM tg UNION ALL SELECT note_id, tag || ['Fire', 'bomberos', 'emergency', 'Airport', 'seaplane', 'avion', 'wheels', 'access', 'silla', 'missing', 'mapping', 'campaign', 'fixme', 'correccion', 'error', 'mapfix'][CAST(note_id % 16 AS INTEGER) + 1] FROM tg WHERE tag LIKE 'tag%') GROUP BY ALL"""),
    ),
    "ml_hashtag_features": (
        lambda w: T.tag_features(w.tags).withColumn("hashtag_names", F.array_join("hashtag_names", ",")),
        sql("SELECT note_id, count(DISTINCT tag) AS hashtag_count, string_agg(DISTINCT tag, ',' ORDER BY tag) AS hashtag_names, " + ", ".join(f"bool_or(contains(lower(tag), '{a}') OR contains(lower(tag), '{b}')) AS has_{k}_keyword" for k, (a, b) in T.KEYWORDS.items()) + " FROM tg WHERE action = 'opened' GROUP BY note_id"),
    ),
}
