"""Categories, confidences and models of triage."""

import random

import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from notelake.operators import triage


def test_categories_by_hand(spark):
    tags = {
        "Firefighters": "firefighter", "bomberos": "firefighter", "EMERGENCY": "firefighter", "airport": "airplane", "seaplane": "airplane", "avion": "airplane", "wheels": "wheelchair", "wheelchair": "airplane", "accessibility": "wheelchair",
        "silla": "wheelchair", "missingmaps": "campaign", "mapathon": "campaign", "campaign": "campaign", "fixme": "correction", "correccion": "correction", "error": "correction", "mapfix": "campaign", "tag1": "other",
    }
    t = spark.createDataFrame([(n, tag) for n, tag in enumerate(tags)] + [(99, "fixme"), (99, "fixme")], "note_id long, tag string")
    got = {r.tag: (r.category, r.notes) for r in triage.category(t).collect()}
    assert got == {tag: (c, 1 + (tag == "fixme")) for tag, c in tags.items()}


@pytest.fixture(scope="module")
def rows(spark):
    """Notes whose class goes by two features, with the others noise."""
    rnd, out = random.Random(5), []
    for n in range(400):
        x = {c: rnd.randrange(5) for c in triage.FEATURES}
        x["comment_length"], x["days_open"] = rnd.randrange(300), None if n % 3 else 4
        out.append((n, *[x[c] for c in triage.FEATURES], "a" if x["comment_length"] > 150 else "b" if x["month"] > 2 else "c"))
    return spark.createDataFrame(out, "note_id long, " + ", ".join(f"{c} int" for c in triage.FEATURES) + ", main_category string")


def test_held_out_accuracy_and_metrics_by_hand(spark, rows):
    """Also in a session that has observed metrics."""
    spark.range(3).observe(seen := Observation("seen"), F.count("*").alias("n")).collect()
    assert seen.get == {"n": 3}
    model = triage.train(rows.where(~triage.held_out()), "main_category")
    held = rows.where(triage.held_out())
    found = triage.evaluate(model, held)
    done = triage.predict({"main_category": model}, held.withColumn("recommended_action", F.lit(None).cast("string"))).join(rows.select("note_id", F.col("main_category").alias("true")), "note_id").collect()
    n, classes = len(done), {r.true for r in done}
    right = lambda c: sum(r.true == c == r.main_category for r in done)
    told, there = {c: sum(r.main_category == c for r in done) for c in classes}, {c: sum(r.true == c for r in done) for c in classes}
    precision = {c: right(c) / told[c] if told[c] else 0 for c in classes}
    recall = {c: right(c) / there[c] for c in classes}
    f1 = {c: 2 * precision[c] * recall[c] / (precision[c] + recall[c]) if precision[c] + recall[c] else 0 for c in classes}
    weighted = lambda m: sum(m[c] * there[c] / n for c in classes)
    assert found == pytest.approx({"accuracy": sum(map(right, classes)) / n, "precision": weighted(precision), "recall": weighted(recall), "f1": weighted(f1)})
    assert found["accuracy"] > 0.75 and n > 50
    assert all(1 / 3 <= r.main_category_confidence <= 1 and r.priority == 5 for r in done)


def test_confident(spark):
    p = spark.createDataFrame([("x", 0.9, "u", 0.2), ("x", 0.5, "v", 0.8), ("y", 0.8, "v", 0.85)], "a string, a_confidence double, b string, b_confidence double")
    got = {(r.target, r["class"]): (r.predicted, r.confident, r.pct) for r in triage.confident(p).collect()}
    assert got == {("a", "x"): (2, 1, 50.0), ("a", "y"): (1, 1, 100.0), ("b", "u"): (1, 0, 0.0), ("b", "v"): (2, 2, 100.0)}


def test_comparison_of_versions(spark):
    m = spark.createDataFrame([("t", v, k, x) for v, k, x in ((1, "f1", 0.5), (2, "f1", 0.75), (1, "accuracy", 0.9), (2, "accuracy", 0.8))], "target string, version int, metric string, value double")
    assert {(r.metric, r.newest, r.previous, round(r.gain, 6)) for r in triage.compare(m).collect()} == {("f1", 0.75, 0.5, 0.25), ("accuracy", 0.8, 0.9, -0.1)}


def test_high_confidence_is_over_all_notes(spark):
    """Each target's classes count a prediction of every opened note with text; a third was left out."""
    from notelake.plans import export_queries
    from notelake.plans.warehouse import Warehouse

    w = Warehouse(spark, "/root/testdata/sf0.001")
    notes = w.facts.where("action = 'opened' AND comment_length > 0").count()
    got = export_queries.PLANS["ml_high_confidence"][0](w).groupBy("target").agg({"predicted": "sum"}).collect()
    assert notes > 0 and {r[0]: r[1] for r in got} == dict.fromkeys(triage.MODELS, notes)
