"""The streaming load over files that arrive in several batches."""

import json
import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from notelake.operators import facts
from notelake.sources.layers import Layers
from notelake.sources.notes import Base
from notelake.streaming import load, state


def event(n, s, a, at, u=1, body="x"):
    return json.dumps({"note_id": n, "sequence_action": s, "event": a, "id_user": u, "created_at": at, "body": body})


def files(path, *batches):
    path.mkdir()
    for k, lines in enumerate(batches):
        (path / f"{k}.json").write_text("\n".join(lines))
        os.utime(path / f"{k}.json", (1_700_000_000 + k, 1_700_000_000 + k))  # the order of arrival
    return str(path)


def run(df, body, check):
    df.writeStream.foreachBatch(body).outputMode("update").option("checkpointLocation", str(check)).trigger(availableNow=True).start().awaitTermination(240)


def places(spark, n):
    notes = spark.createDataFrame([(k, 20.0 - k, 30.0 * k % 180, k % 3) for k in range(n)], "note_id long, latitude double, longitude double, id_country int")
    return notes, spark.createDataFrame([(1, "One"), (2, "Two")], "country_id int, country_name string")


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.fixture(scope="module")
def actions():
    """note, sequence, action, time, user, body: openings, closings, reopenings, and one note that isn't opened."""
    rnd, out = random.Random(7), []
    for n in range(12):
        at = datetime(2023, 1, 1 + n)
        for s, a in enumerate(["opened" if n else "commented", *rnd.choices(["commented", "closed", "reopened", "hidden"], k=rnd.randrange(6))], 1):
            at += timedelta(hours=rnd.choice([0, 5, 70]))
            out.append((n, s, a, str(at), rnd.choice([None, 4, 5]), rnd.choice(["#a b", "see https://x @me", None, "via StreetComplete 5.1"])))
    return out


def test_streamed_facts_equal_a_load(spark, tmp_path, actions):
    """Whatever the order and however often actions come; a batch that is run again changes nothing."""
    rnd = random.Random(1)
    sent = [event(*a) for a in actions] * 2
    rnd.shuffle(sent)
    src = files(tmp_path / "in", *[sent[k::6] for k in range(6)])
    notes, countries = places(spark, 12)
    into = facts.table(spark, str(tmp_path / "facts"))
    body, again = load.kept_facts(into, notes, countries), []

    def twice(batch, i):
        body(batch, i)
        version = into.snapshot()["version"]
        body(batch, i)
        again.append(into.snapshot()["version"] == version)

    run(state.notes(load.source(spark, src, 1).where(load.is_valid()).drop("line")), twice, tmp_path / "check")
    c = spark.createDataFrame([(n, s, a, u, datetime.fromisoformat(at), b) for n, s, a, at, u, b in actions], "note_id long, sequence_action int, event string, id_user long, created_at timestamp_ntz, body string")
    whole = facts.facts(Base(notes, c.drop("body"), c.select("note_id", "sequence_action", "body"), None, countries))
    assert rows(into.read().select(*whole.columns)) == rows(whole) and whole.count() > 30
    assert len(again) == 6 and all(again)
    assert max(x["level"] for x in into.snapshot()["layers"][1:]) == 1  # layers were merged


def test_last_write_wins_and_late_actions(spark, tmp_path):
    src = files(
        tmp_path / "in",
        [event(1, 1, "opened", "2023-01-01 10:00:00"), "{broken", event(2, 1, "opened", "2023-01-01 12:00:00"), event(9, 1, "danced", "2023-01-01 12:00:00")],
        [event(1, 2, "closed", "2023-01-01 11:00:00"), event(2, 1, "opened", "2023-01-01 12:30:00", u=7), event(1, 3, "reopened", "2023-01-02 11:00:00"), event(1, 1, "opened", "2023-01-01 10:00:00")],
    )
    into = facts.table(spark, str(tmp_path / "facts"))
    run(state.notes(load.source(spark, src, 1).where(load.is_valid()).drop("line")), load.kept_facts(into, *places(spark, 3)), tmp_path / "check")
    assert {(r.note_id, r.seq): r.action_user for r in into.read().collect()} == {(1, 1): 1, (2, 1): 7, (1, 2): 1, (1, 3): 1}
    assert [(r.note_id, r.sequence_action) for r in into.beside("late").collect()] == [(1, 2)]
    assert {(r.note_id, r.seq): str(r.next_close_date) for r in into.read().where("action = 'opened'").collect()} == {(1, 1): "2023-01-01", (2, 1): "None"}


def test_status_and_duplicates(spark, tmp_path):
    src = files(tmp_path / "in", [event(1, 2, "closed", "2023-01-01 11:00:00"), event(3, 1, "opened", "2023-01-01 09:00:00")], [event(1, 1, "opened", "2023-01-01 10:00:00"), event(3, 1, "opened", "2023-01-01 09:00:00")])
    events = load.source(spark, src, 1)
    into = Layers(spark, str(tmp_path / "status"), ["note_id"])
    run(load.status(events), load.kept_status(into), tmp_path / "c1")
    assert {(r.note_id, r.is_open) for r in into.read().collect()} == {(1, False), (3, True)}
    load.deduplicated(events).writeStream.format("memory").queryName("dd").outputMode("append").option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination(120)
    assert sorted((r.note_id, r.sequence_action) for r in spark.table("dd").collect()) == [(1, 1), (1, 2), (3, 1)]


def test_a_batch_writes_in_proportion_to_itself(spark, tmp_path):
    into, size = Layers(spark, str(tmp_path / "t"), ["note_id"]), {}
    body = load.kept_status(into)
    status = lambda ids, v: spark.createDataFrame([(k, f"{v}-{k * 7919}", k % 2 == 0) for k in ids], "note_id long, last_action string, is_open boolean").coalesce(1)
    before = set()
    for batch, ids in enumerate((range(60_000), range(10), range(50, 55))):
        body(status(ids, batch), batch)
        body(status(ids, "again"), batch)
        new = {p for p in (tmp_path / "t" / "layers").rglob("*.parquet")} - before
        before |= new
        size[batch] = sum(p.stat().st_size for p in new)
    assert size[1] < size[0] / 50 and size[2] < size[0] / 50
    got = {r.note_id: r.last_action for r in into.read().collect()}
    assert len(got) == 60_000 and got[3].startswith("1-") and got[52].startswith("2-") and got[30].startswith("0-")


class Clock:
    def __init__(self):
        self.now = datetime(2024, 1, 1)

    def __call__(self):
        return self.now


def drain(spark, path, body, check, clock, seconds, times, stuck_s=300):
    for _ in range(times):
        clock.now += timedelta(seconds=seconds)
        load.tick(spark, path, clock())
        run(state.queue(load.queued(spark, path), stuck_s=stuck_s), body, check)


def test_retries_count_and_end(spark, tmp_path):
    """An event that fails twice and then succeeds is accepted once; one that always fails stops at TRIES; one sent twice is one."""
    path, accepted, log, clock, tried = *[str(tmp_path / k) for k in ("queue", "accepted", "log")], Clock(), []
    good, late, bad = event(1, 1, "opened", "2023-01-01 10:00:00"), event(2, 1, "opened", "2023-01-01 10:00:00"), "{broken"
    load.enqueue(spark.createDataFrame([(x,) for x in (good, late, bad, good)], "line string"), path, clock())
    known = lambda: spark.createDataFrame([(1,)] + [(2,)] * (clock() >= datetime(2024, 1, 1, 0, 2)), "note_id long")
    body = load.attempts(path, accepted, log, known, clock)

    def counted(batch, i):
        tried.extend((r.line, r.tries) for r in batch.where("what = 'try'").collect())
        body(batch, i)

    drain(spark, path, counted, tmp_path / "check", clock, 50, 6)
    assert sorted(tried) == sorted([(good, 1), *[(x, k) for x in (late, bad) for k in (1, 2, 3)]])
    assert sorted(r.value for r in spark.read.text(f"{accepted}/*").collect()) == sorted([good, late])
    assert {(r.what, r.tries, r.error) for r in spark.read.parquet(log).collect()} == {("processed", 1, None), ("processed", 3, None), ("given up", 3, "unreadable")}


def test_tries_without_an_outcome_come_again(spark, tmp_path):
    path, clock, steps = str(tmp_path / "queue"), Clock(), []
    load.enqueue(spark.createDataFrame([("a",)], "line string"), path, clock())
    drain(spark, path, lambda batch, i: steps.extend((r.what, r.tries, r.error) for r in batch.collect()), tmp_path / "check", clock, 40, 5, stuck_s=60)
    assert steps == [("try", 1, None), ("try", 2, None), ("try", 3, None), ("given up", 3, "stuck")][: len(steps)] and len(steps) >= 3


def test_reasons(spark):
    bad = ["{broken", event(1, None, "opened", "2023-01-01 10:00:00"), event(1, 1, "opened", "never"), event(1, 1, "danced", "2023-01-01 10:00:00")]
    e = spark.createDataFrame([(x,) for x in bad], "line string").select(F.from_json("line", load.SCHEMA).alias("e")).select("e.*")
    assert [r.x for r in e.select(load.reason().alias("x")).collect()] == ["unreadable", "no note or sequence", "no time", "unknown action"]


def test_sent_lines_are_small_and_go(spark, tmp_path):
    """Lines hold whole bodies, but their files hold a text's copies in one place; shuffles carry no bodies, and what was read is deleted."""
    from notelake.plans import stream_queries
    from notelake.plans.warehouse import Warehouse

    w, path = Warehouse(spark, "/root/testdata/sf0.001"), str(tmp_path / "sent")
    stream_queries._sent(w, path, *stream_queries.SENDINGS)
    lines = spark.read.text(path)
    own = w.base.actions.join(spark.createDataFrame([(k,) for k in (1, 2)], "time int")).where("time = 1 OR note_id % 5 = 0").agg(F.count("*").alias("n"), F.sum(F.octet_length("body")).alias("b")).first()
    raw = lines.agg(F.count("*").alias("n"), F.sum(F.octet_length("value")).alias("b")).first()
    assert raw.n == own.n and raw.b > own.b
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").agg(F.sum(F.octet_length("text"))).first()[0]
    size = sum(p.stat().st_size for p in (tmp_path / "sent").rglob("part-*"))
    assert size < raw.b / 3 and size < texts * stream_queries.SLICES
    plan = stream_queries._lines(w, 0)._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and plan.index("_text#") < plan.index("RepartitionByExpression")  # dealt beneath the join with texts
    for folder in stream_queries._sendings(w):
        assert spark.read.text(folder).count() > 0
    assert not os.path.exists(folder)


def test_state_and_facts_hold_no_bodies_but_find_them(spark, tmp_path):
    """A body that is corrected counts as a change though all that facts tell of it stays; bodies are kept whole, beside."""
    src = files(tmp_path / "in", [event(1, 1, "opened", "2023-01-01 10:00:00", body="ab"), event(2, 1, "opened", "2023-01-01 10:00:00", body=None)], [event(1, 1, "opened", "2023-01-01 10:00:00", body="ba")])
    into, kept = facts.table(spark, str(tmp_path / "facts")), str(tmp_path / "bodies")
    events = load.source(spark, src, 1).where(load.is_valid()).drop("line")
    told = state.notes(events)
    assert "body" not in told.columns
    run(told, load.kept_facts(into, *places(spark, 3)), tmp_path / "c1")
    events.writeStream.foreachBatch(load.kept_bodies(kept)).option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start().awaitTermination(120)
    got = load.with_bodies(into.read(), kept, lambda b: b)
    assert rows(got.select("note_id", "body", "comment_length")) == [(1, "ba", 2), (2, None, None)]
    assert rows(spark.read.parquet(kept).select("body")) == [("ab",), ("ba",)]


def test_queue_files_are_compressed(spark, tmp_path):
    line = event(1, 1, "opened", "2023-01-01 10:00:00", body="long " * 20_000)
    load.enqueue(spark.createDataFrame([(line,)], "line string"), str(tmp_path / "queue"), datetime(2024, 1, 1))
    assert sum(p.stat().st_size for p in (tmp_path / "queue").glob("part-*")) < len(line) / 50
    assert [r.line for r in spark.read.json(str(tmp_path / "queue")).collect()] == [line]
