"""Marts that are brought up to date after loads, against a full build."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from notelake.operators import checks, facts, marts, partials
from notelake.operators.update_log import UpdateLog
from notelake.sources import layers
from notelake.sources.notes import Base


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def base(spark):
    """120 notes of 3 countries, each of its own user of 40; a few with many actions."""
    rnd, out = random.Random(3), []
    for n in range(120):
        at = datetime(2021 + n % 3, 1 + n % 12, 1 + n % 20)
        for s, a in enumerate(["opened", *rnd.choices(["commented", "closed", "reopened"], k=rnd.randrange(5))], 1):
            at += timedelta(days=rnd.randrange(40), hours=1)
            out.append((n, s, a, n % 40, at, rnd.choice(["#a #b", "#b", "x via StreetComplete 5.1", ""])))
    c = spark.createDataFrame(out, "note_id long, sequence_action int, event string, id_user long, created_at timestamp_ntz, body string")
    notes = c.select("note_id").distinct().select("note_id", F.lit(20.0).alias("latitude"), F.lit(30.0).alias("longitude"), (F.col("note_id") % 3).cast("int").alias("id_country"))
    return Base(notes, c.drop("body"), c.select("note_id", "sequence_action", "body"), None, spark.createDataFrame([(k,) for k in range(3)], "country_id int"))


LOADS = ("note_id < 100 AND (note_id % 9 <> 4 OR sequence_action = 1)", "note_id < 110", "true")


def whole(f):
    """What the marts must be, by other means."""
    out = {}
    for kind, e in (("country", "country"), ("user", "action_user")):
        of = lambda df, e=e, kind=kind: df.withColumn("kind", F.lit(kind)).withColumnRenamed(e, "entity").withColumn("entity", F.col("entity").cast("long"))
        days = f.groupBy(e, F.year("action_date").alias("year")).agg(F.avg("days_to_resolution").alias("avg_days"), F.percentile("days_to_resolution", F.lit(0.5)).alias("median_days"))
        out[kind] = rows(of(marts.history_by_year(f, e).join(days, [e, "year"])).select("kind", "entity", "year", *marts.MEASURES, "avg_days", "median_days"))
        out[kind, "tags"] = rows(of(marts.tag_lists(facts.tags(f), e)).select("kind", "entity", "key", "n", "rank"))
        out[kind, "hours"] = rows(of(marts.working_hours(f, e)).select("kind", "entity", "action", "dow", "hour", "n"))
        out[kind, "apps"] = rows(of(marts.shares(f, e, ["app"])).select("kind", "entity", "year", "app", "n", "pct"))
    return out


def made(m):
    out, read = {}, {name: t.read() for name, t in m.marts.items()}
    for kind in ("country", "user"):
        own = {name: df.where(F.col("kind") == kind) for name, df in read.items()}
        out[kind] = rows(own["yearly"].select("kind", "entity", "year", *marts.MEASURES, "avg_days", "median_days"))
        out[kind, "tags"] = rows(own["tops"].where("family = 'tag'").select("kind", "entity", "key", "n", "rank"))
        out[kind, "hours"] = rows(own["hours"].select("kind", "entity", "action", "dow", "hour", "n"))
        out[kind, "apps"] = rows(own["apps"].select("kind", "entity", "year", "app", "n", "pct"))
    return out


def test_marts_after_loads_equal_a_full_build(base, spark, tmp_path, monkeypatch):
    into, m = facts.table(spark, str(tmp_path / "facts")), partials.Marts(spark, str(tmp_path / "marts"))
    for k, came in enumerate(LOADS):
        before = m.sums.snapshot()["version"]
        facts.load(facts.arrived(base, F.expr(came)), into)
        if k == 1:  # dies after the sums and the first mart
            left, commit = [2], layers.Layer.commit

            def dying(self, left=left, commit=commit, **told):
                if not left[0]:
                    raise OSError("lost")
                left[0] -= 1
                return commit(self, **told)

            with monkeypatch.context() as patch:
                patch.setattr(layers.Layer, "commit", dying)
                with pytest.raises(OSError):
                    m.refresh(into)
        assert m.refresh(into) and not m.refresh(into)
        assert made(m) == whole(facts.facts(facts.arrived(base, F.expr(came))))
    log = m.log.read()
    assert {(r.kind, r.status): r.n for r in log.groupBy("kind", "status").agg(F.count("*").alias("n")).collect()} == {("sums", "success"): 3, ("yearly", "success"): 3, ("tops", "success"): 3, ("tops", "error"): 1, ("hours", "success"): 3, ("apps", "success"): 3}
    first = log.where("kind = 'sums'").orderBy("start_time").first()
    assert first.facts == facts.facts(facts.arrived(base, F.expr(LOADS[0]))).count() and first.records > first.facts and first.duration > 0
    users = {r.entity for r in m.modified(before).where("kind = 'user'").collect()}
    assert users == {n % 40 for n in range(110, 120)}
    assert {(r.entity, r.year) for r in m.years(before).where("kind = 'user'").collect()} == {(r.action_user, r.y) for r in into.read().where("note_id >= 110").select("action_user", F.year("action_date").alias("y")).distinct().collect()}


def test_sums_of_other_entities_are_not_read(base, spark, tmp_path):
    into, m = facts.table(spark, str(tmp_path / "facts")), partials.Marts(spark, str(tmp_path / "marts"))
    facts.load(base, into)
    m.refresh(into)
    one = spark.createDataFrame([("user", 7)], "kind string, entity long")
    read = m.of(one)
    assert {(r.kind, r.entity) for r in read.collect()} == {("user", 7)}
    plan = read._jdf.queryExecution().executedPlan().toString()
    part = m.sums.read().where("kind = 'user' AND entity = 7").select("part").first().part
    assert f"PartitionFilters: [part" in plan and f"IN ({part})" in plan or f"(part#" in plan and f"= {part})" in plan  # noqa: F541


def test_updates_are_logged(spark, tmp_path):
    """One that succeeds and one that fails: both are found, with what they did."""
    log = UpdateLog(spark, str(tmp_path / "log"))
    with log.update("countries") as u:
        u.rows(u.facts(spark.range(30)).where("id < 7")).write.parquet(str(tmp_path / "a"))
    with pytest.raises(PySparkException), log.update("users", 5) as u:
        u.rows(spark.range(3).select(F.raise_error(F.lit("lost")))).write.parquet(str(tmp_path / "b"))
    rows = {r.kind: r for r in log.read().collect()}
    assert (rows["countries"].facts, rows["countries"].records, rows["countries"].status, rows["countries"].error) == (30, 7, "success", None)
    assert rows["users"].status == "error" and rows["users"].entity_id == 5 and rows["users"].error and rows["users"].duration > 0
    assert {r.kind: (r.n, r.records) for r in checks.perf_summary(log.read(), ["kind"]).collect()} == {"countries": (1, 7), "users": (1, 0)}


def test_sums_have_a_file_for_each_part_and_are_read_once(base, spark, tmp_path, monkeypatch):
    into, m, read = facts.table(spark, str(tmp_path / "facts")), partials.Marts(spark, str(tmp_path / "marts")), []
    of = partials.Marts.of
    monkeypatch.setattr(partials.Marts, "of", lambda self, *a: (read.append(1), of(self, *a))[1])
    for k, came in enumerate(LOADS[1:]):
        facts.load(facts.arrived(base, F.expr(came)), into)
        m.refresh(into)
        layer = m.sums.snapshot()["layers"][-1]["id"]
        parts = [list(p.glob("*.parquet")) for p in (tmp_path / "marts" / "sums" / "layers" / layer / "rows").glob("part=*")]
        assert parts and all(len(p) == 1 for p in parts)
        assert len(read) == k  # the first load's marts are made of all sums, as they lie
