"""Badges over a history, and frequent pairs of tags, against plain versions."""

import random
import re
from collections import Counter
from datetime import date, datetime, timedelta
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from notelake.operators import rankings

#: Badges of all measures with values that small histories reach.
SMALL = [
    ("one", "opened", 1), ("three closes", "closed", 3), ("talker", "commented", 2), ("said", "closed_with_comment", 2), ("tags", "tagged", 2), ("urls", "urls", 1), ("mobile", "mobile", 1), ("fast", "speedy", 1),
    ("three days", "day_run", 3), ("two weeks", "week_run", 2), ("two months", "month_run", 2), ("two closing days", "close_run", 2), ("a year", "years", 1), ("two in a year", "year_opened", 2), ("long", "avg_length", 50),
    ("round", "all_round", 2),
]


@pytest.fixture(scope="module")
def history(spark):
    rnd, rows = random.Random(8), []
    for u in (-1, 1, 2, 3, 4):
        at = datetime(2022, 12, 20)
        for _ in range(14):
            at += timedelta(days=rnd.choice([0, 1, 1, 1, 4, 30]), minutes=7)
            n = rnd.choice([None, 5, 40, 120])
            rows.append((u, rnd.choice(["opened", "closed", "closed", "commented"]), at, at - timedelta(minutes=rnd.choice([20, 200])), n, rnd.choice([[], ["a"]]), rnd.random() < 0.1, rnd.random() < 0.2, rnd.choice([None, "android", "web"])))
    f = spark.createDataFrame(rows, "action_user long, action string, action_at timestamp_ntz, opened_at timestamp_ntz, comment_length int, hashtags array<string>, has_mention boolean, has_url boolean, platform string")
    return f.withColumn("action_date", F.to_date("action_at")).cache()


def test_award_dates_by_replaying_days(spark, history, monkeypatch):
    monkeypatch.setattr(rankings, "BADGES", SMALL)
    as_of = date(2023, 6, 30)
    days = sorted({r.action_date for r in history.select("action_date").distinct().collect() if r.action_date <= as_of} | {date(2023, 1, 1)})
    want = {}
    for day in days:
        for r in rankings.badges(history.where(F.col("action_date") <= F.lit(day)), day, spark).collect():
            want.setdefault((r.action_user, r.badge), day)
    got = {(r.action_user, r.badge): r.awarded_on for r in rankings.awards(history, as_of, spark).collect()}
    assert got == want and {b for _, b in got} == {b for b, _, _ in SMALL}


def test_awards_shuffle_days_only(spark, history):
    """What is dealt is a row for each user and day, not one for each measure, which is many times the facts."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = rankings.awards(history, date(2023, 6, 30), spark)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    keys = [re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)]
    assert sorted(keys) == ["action_user", "action_user, action_date"]


def test_award_dates_take_one_scan(spark, history, tmp_path):
    history.write.parquet(str(tmp_path / "f"))
    df = rankings.awards(spark.read.parquet(str(tmp_path / "f")), date(2023, 6, 30), spark)
    assert df._jdf.queryExecution().executedPlan().toString().count("FileScan parquet") == 1


def test_frequent_pairs(spark):
    rnd = random.Random(2)
    notes = {n: {f"t{int(rnd.paretovariate(0.8)) % 15}" for _ in range(rnd.randrange(6))} for n in range(80)}
    notes[1000] = {f"own{k}" for k in range(10_000)} | {"t1", "t2"}
    t = spark.createDataFrame([(n, x) for n, own in notes.items() for x in own for _ in range(2)], "note_id long, tag string")
    counts = Counter(p for own in notes.values() for p in combinations(sorted(x for x in own if x[0] == "t"), 2))
    want = sorted(((-c, *p) for p, c in counts.items() if c >= 3))[:50]
    assert [(-r.notes, r.a, r.b) for r in rankings.tag_pairs(t).collect()] == want
    assert rankings.frequent_pairs(t).count() <= counts.total()  # not 50 million
