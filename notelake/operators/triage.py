"""Features, classifiers and decisions for the triage of notes."""

from __future__ import annotations

from datetime import date

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .marts import count_of, is_

#: The features of a note, in their order.
FEATURES = [
    "comment_length", "has_url_int", "has_mention_int", "hashtag_number", "total_comments_on_note", "hashtag_count", "has_fire_keyword", "has_air_keyword", "has_access_keyword", "has_campaign_keyword",
    "has_fix_keyword", "is_assisted_app", "is_mobile_app", "country_resolution_rate", "country_avg_resolution_days", "country_notes_health_score", "user_response_time", "user_total_notes",
    "user_experience_level", "day_of_week", "hour_of_day", "month", "days_open",
]
#: Parts of tags that a keyword flag goes by.
KEYWORDS = {"fire": ("fire", "bomber"), "air": ("air", "plane"), "access": ("wheel", "access"), "campaign": ("missing", "campaign"), "fix": ("fix", "correc")}
#: Applications that help to write a note.
ASSISTED = ("Maps.me", "StreetComplete", "OrganicMaps", "OnOSM.org")
#: Targets with the trees and the depth of their forests.
MODELS = {"main_category": (10, 6), "specific_type": (20, 8), "recommended_action": (15, 7)}


def tag_features(t: DataFrame) -> DataFrame:
    """note_id, hashtag_count, hashtag_names and the keyword flags of the tags of the note's opening."""
    low = F.lower("tag")
    flags = [F.bool_or(low.contains(a) | low.contains(b)).alias(f"has_{k}_keyword") for k, (a, b) in KEYWORDS.items()]
    return t.where(is_("opened")).groupBy("note_id").agg(F.countDistinct("tag").alias("hashtag_count"), F.array_sort(F.collect_set("tag")).alias("hashtag_names"), *flags)


def features(f: DataFrame, t: DataFrame, countries: DataFrame, users: DataFrame, as_of: date) -> DataFrame:
    """One row per opened note with text: FEATURES, and what targets go by. Days open only of notes that no close follows.

    Countries: (country, resolution_rate, avg_days, score); users: (user, response_time, opened, contributor_type), those of the marts.
    """
    o = f.where(is_("opened") & (F.col("comment_length") > 0))
    n = lambda c: F.coalesce(c, F.lit(False)).cast("int")
    number = lambda c: F.coalesce(c, F.lit(0.0))
    j = o.join(tag_features(t).drop("hashtag_names"), "note_id", "left").join(countries, "country", "left").join(users.withColumnRenamed("user", "action_user"), "action_user", "left")
    open_for = F.datediff(F.lit(as_of), F.col("action_date"))
    return j.select(
        "note_id", "country", "comment_length", n(F.col("has_url")).alias("has_url_int"), n(F.col("has_mention")).alias("has_mention_int"), F.size(F.array_remove("hashtags", "")).alias("hashtag_number"),
        F.col("prior_commented").alias("total_comments_on_note"), F.coalesce("hashtag_count", F.lit(0)).alias("hashtag_count"), *[n(F.col(f"has_{k}_keyword")).alias(f"has_{k}_keyword") for k in KEYWORDS],
        n(F.col("app").isin(*ASSISTED)).alias("is_assisted_app"), n(F.col("app").contains("mobile") | F.col("app").contains("app")).alias("is_mobile_app"),
        number(F.col("resolution_rate")).alias("country_resolution_rate"), number(F.col("avg_days")).alias("country_avg_resolution_days"), number(F.col("score")).alias("country_notes_health_score"),
        number(F.col("response_time")).alias("user_response_time"), F.coalesce("opened", F.lit(0)).alias("user_total_notes"), F.coalesce("contributor_type", F.lit(0)).alias("user_experience_level"),
        F.dayofweek("action_date").cast("int").alias("dow"), F.hour("action_at").alias("hour_of_day"), F.month("action_date").alias("month"),
        F.when(F.col("next_close_date").isNull(), open_for).alias("days_open"), open_for.alias("age"), "app", "has_url", "next_close_date",
    ).withColumn("day_of_week", F.col("dow") - 1).drop("dow")


def targets(rows: DataFrame, f: DataFrame) -> DataFrame:
    """features() with main_category, specific_type and recommended_action: how the note was settled, and what it was."""
    said = f.where(is_("commented")).groupBy("note_id").agg(F.min("action_date").alias("first_comment"))
    j = rows.join(said, "note_id", "left")
    shut, talked = F.col("next_close_date").isNotNull(), F.coalesce(F.col("first_comment") < F.col("next_close_date"), F.lit(False))
    n, told = F.col("comment_length"), F.col("total_comments_on_note") > 2
    kind = (
        F.when(n < 10, "empty")
        .when((n < 50) & told, "lack_of_precision")
        .when((n > 200) & F.col("has_url"), "advertising")
        .when(~shut & (F.col("age") > 180), "obsolete")
        .when((F.col("is_assisted_app") == 1) & (n > 30), "adds_to_map")
        .otherwise("other")
    )
    return j.select(
        "note_id", "country", *FEATURES, F.when(shut & talked, "contributes_with_change").when(shut, "doesnt_contribute").alias("main_category"), kind.alias("specific_type"),
        F.when(shut & talked, "process").when(shut, "close").when((n < 50) & told, "needs_more_data").alias("recommended_action"), shut.alias("resolved"),
    )


def train(rows: DataFrame, target: str) -> PipelineModel:
    """A forest over FEATURES (an absent one counts as 0); the index of the target's classes is part of the model."""
    trees, depth = MODELS[target]
    steps = [StringIndexer(inputCol=target, outputCol="label", handleInvalid="skip"), VectorAssembler(inputCols=FEATURES, outputCol="features"), RandomForestClassifier(numTrees=trees, maxDepth=depth, seed=7)]
    model = Pipeline(stages=steps).fit(rows.na.fill(0, FEATURES))
    # the summary of the training holds the session, which can't be sent to executors any more once it has observed metrics
    model.stages[-1]._java_obj.setSummary(rows.sparkSession._jvm.scala.Option.empty())
    return model


def held_out() -> Column:
    """A fifth of the notes by hash, for evaluation; never learnt from."""
    return F.pmod(F.xxhash64("note_id"), F.lit(5)) == 0


def predict(models: dict[str, PipelineModel], rows: DataFrame) -> DataFrame:
    """note_id and, for each model's target, its class and confidence; and priority: 9 where a change is to be processed, 6 where more
    data is needed, 3 where it is to be closed, else 5."""
    out = rows.na.fill(0, FEATURES)
    for target, model in models.items():
        names = F.array(*[F.lit(x) for x in model.stages[0].labels])
        done = PipelineModel(model.stages[1:]).transform(out)  # without the indexing of the target, which the rows lack
        p = vector_to_array("probability")
        done = done.withColumn(target, F.get(names, F.col("prediction").cast("int"))).withColumn(f"{target}_confidence", F.array_max(p))
        out = done.drop("features", "rawPrediction", "probability", "prediction")
    act = F.col("recommended_action")
    priority = F.when((F.col("main_category") == "contributes_with_change") & (act == "process"), 9).when(act == "needs_more_data", 6).when(act == "close", 3).otherwise(5)
    return out.select("note_id", *[c for t in models for c in (t, f"{t}_confidence")], priority.alias("priority"))


def confident(predictions: DataFrame, least: float = 0.8) -> DataFrame:
    """target, class: predictions, those of at least that confidence, and their share."""
    targets = [c.removesuffix("_confidence") for c in predictions.columns if c.endswith("_confidence")]
    each = F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("class"), F.col(f"{t}_confidence").alias("c")) for t in targets]))
    n = predictions.select(each.alias("p")).select("p.*").groupBy("target", "class").agg(F.count("*").alias("predicted"), F.count_if(F.col("c") >= least).alias("confident"))
    return n.withColumn("pct", F.lit(100.0) * F.col("confident") / F.col("predicted"))


def evaluate(model: PipelineModel, rows: DataFrame) -> dict[str, float]:
    """accuracy, f1, precision and recall."""
    out = model.transform(rows.na.fill(0, FEATURES)).cache()
    names = {"accuracy": "accuracy", "f1": "f1", "precision": "weightedPrecision", "recall": "weightedRecall"}
    found = {k: MulticlassClassificationEvaluator(metricName=m).evaluate(out) for k, m in names.items()}
    out.unpersist()
    return found


def compare(metrics: DataFrame) -> DataFrame:
    """Of metrics (target, version, metric, value): the newest version's values beside those of the one before it."""
    place = F.dense_rank().over(Window.partitionBy("target").orderBy(F.desc("version")))
    m = metrics.withColumn("place", place)
    of = lambda k: F.max(F.when(F.col("place") == k, F.col("value")))
    return m.groupBy("target", "metric").agg(of(1).alias("newest"), of(2).alias("previous")).withColumn("gain", F.col("newest") - F.col("previous"))


def readiness(f: DataFrame) -> DataFrame:
    """Samples for training, and whether they are enough."""
    n = f.where("action = 'opened' AND comment_length > 0").agg(F.count("*").alias("openings"), F.count("next_close_date").alias("resolved"))
    return n.withColumn("ready", F.col("resolved") >= 100)


def retrain(f: DataFrame, trained_on: date, as_of: date, days: int = 30, share: float = 10.0) -> DataFrame:
    """Is the model older than `days`, or are `share` per cent of the closed notes newer than it?"""
    n = f.where(is_("closed")).agg(F.count("*").alias("closes"), count_of(F.col("action_date") > F.lit(trained_on)).alias("fresh"))
    pct = F.when(F.col("closes") > 0, F.lit(100.0) * F.col("fresh") / F.col("closes")).otherwise(0.0)
    return n.select("closes", "fresh", pct.alias("pct"), ((F.datediff(F.lit(as_of), F.lit(trained_on)) >= days) | (pct >= share)).alias("retrain"))


#: What tags are about, by parts of them; the first that fits counts.
CATEGORIES = {
    "firefighter": ("fire", "bomber", "emergency"),
    "airplane": ("air", "plane", "avion"),
    "wheelchair": ("wheel", "access", "silla"),
    "campaign": ("missing", "map", "campaign"),
    "correction": ("fix", "correc", "error"),
}


def category(t: DataFrame) -> DataFrame:
    """tag, category, notes: what each tag may be about, and on how many notes it is."""
    low = F.lower("tag")
    hits = [F.when(F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(low, p)), name) for name, parts in CATEGORIES.items()]
    return t.groupBy("tag", F.coalesce(*hits, F.lit("other")).alias("category")).agg(F.countDistinct("note_id").alias("notes"))
