"""Hand-made notes: edge cases of the fact pipeline."""

import random
import re
from datetime import datetime

import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from notelake.functions import columns as C
from notelake.operators import checks, facts, marts, rankings, status
from notelake.plans.warehouse import Warehouse
from notelake.sources import layers, notes, store
from notelake.sources.notes import Base

T = lambda d, h=0: datetime(2023, 1, d, h)


@pytest.fixture(scope="module")
def f(spark):
    rows = [  # note, seq, event, user, at, body
        (1, 1, "opened", 10, T(1), "bad #a#b #c"), (1, 2, "closed", 20, T(1, 5), "ok"),
        (2, 1, "opened", None, T(1), None), (2, 2, "closed", 20, T(3), ""), (2, 3, "reopened", 10, T(5), "#"), (2, 4, "closed", 20, T(9), "@me http://x"),
        (3, 1, "opened", 10, T(2), "via StreetComplete 51.2"), (3, 2, "reopened", 20, T(4), "#a #b"), (3, 3, "commented", 10, T(4), "lost: same time"),
        (4, 1, "commented", 10, T(2), "never opened"),
    ]
    c = spark.createDataFrame([(n, s, e, u, t) for n, s, e, u, t, _ in rows], "note_id long, sequence_action int, event string, id_user long, created_at timestamp_ntz")
    b = spark.createDataFrame([(n, s, x) for n, s, _, _, _, x in rows], "note_id long, sequence_action int, body string")
    notes = spark.createDataFrame([(1, 20.0, 170.0, 1), (2, -20.0, -170.0, 1), (3, None, None, 99), (4, 5.0, 5.0, 1)], "note_id long, latitude double, longitude double, id_country int")
    countries = spark.createDataFrame([(1, "One")], "country_id int, country_name string")
    return facts.facts(Base(notes, c, b, None, countries))


def rows(df, *keys):
    return sorted(map(tuple, df.collect()), key=str)


def test_keys_and_unknown_members(f):
    got = {(r.note_id, r.seq): r for r in f.collect()}
    assert set(got) == {(1, 1), (1, 2), (2, 1), (2, 2), (2, 3), (2, 4), (3, 1), (3, 2)}
    assert got[2, 1].action_user == -1 and got[3, 1].country == -1 and got[3, 1].zone == 0 and got[3, 1].season == 0
    assert got[1, 1].zone == 11 and got[2, 1].zone == -11 and got[1, 1].season == 4 and got[2, 1].season == 1
    assert got[1, 2].days_to_resolution == 0 and got[2, 4].days_to_resolution == 8 and got[2, 4].days_from_reopen == 4
    assert got[2, 2].days_active is None and got[2, 4].days_active == 0
    assert got[2, 1].next_close_date.day == 3 and got[1, 1].next_close_user == 20 and got[3, 1].next_close_date is None
    assert got[3, 2].recent_open_date.day == 4 and got[2, 4].prior_actions == 3 and got[2, 4].prior_reopened == 1
    assert got[2, 4].has_url and got[2, 4].has_mention and got[3, 1].app == "StreetComplete" and got[3, 1].app_version == "51.2"


def test_hashtags(spark, f):
    texts = {"#a#b": ["a"], "#a #b": ["a", "b"], "#": [""], "x # y #z": [""], None: [], "": [], "#é!": ["é"]}
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", C.hashtags(F.col("t")).alias("h"))
    assert {r.t: r.h for r in df.collect()} == texts
    assert rows(facts.tags(f).select("note_id", "seq", "position", "tag")) == [(1, 1, 1, "a"), (1, 1, 2, "c"), (3, 2, 1, "a"), (3, 2, 2, "b")]


def test_status(f):
    assert {r.note_id: r.is_open for r in status.current(f).collect()} == {1: False, 2: False, 3: True}


def test_status_merges_in_any_order(f):
    a, b = status.current(f.where("seq <= 2")), status.current(f.where("seq > 2"))
    whole = rows(status.current(f).select("note_id", "is_open"))
    assert rows(status.merged(a, b).select("note_id", "is_open")) == whole == rows(status.merged(b, a).select("note_id", "is_open"))


def test_activity_score(spark):
    want = [0] + [next(k for k in range(1, 10) if n <= 2 ** (k + 1) - 2 or k == 9) for n in range(1, 2000)]
    got = [r.s for r in spark.range(2000).orderBy("id").select(C.activity_score(F.col("id")).alias("s")).collect()]
    assert got == want


def test_runs(spark):
    days = [datetime(2023, 1, d) for d in (1, 2, 3, 4, 5, 6, 7, 9)]
    df = spark.createDataFrame([(1, "opened", d) for d in days] + [(2, "closed", days[0])], "action_user long, action string, action_date timestamp").withColumn("action_date", F.to_date("action_date"))
    assert rows(rankings.longest_run(df, "day", "n")) == [(1, 7), (2, 1)]


def test_ratios_without_closes(f):
    got = {r.country: r for r in marts.resolution(f, "country").collect()}
    assert got[-1].resolved == 0 and got[-1].still_open == 1 and got[-1].avg_days is None and got[1].rate == 100.0


def test_unknown_period():
    with pytest.raises(ValueError):
        rankings.period("decade", None)


@pytest.fixture(scope="module")
def base(spark):
    rows = [(n, s, a, 10 + (n + s) % 3, T(1 + (7 * n + 5 * s) % 25, s)) for n in range(40) for s, a in enumerate(("opened", "closed", "reopened", "commented", "closed")[: 1 + n % 5], 1)]
    rows = [(n, s, a, u, t.replace(year=2022 + n % 2)) for n, s, a, u, t in rows]
    c = spark.createDataFrame(rows, "note_id long, sequence_action int, event string, id_user long, created_at timestamp_ntz")
    b = c.select("note_id", "sequence_action", F.lit("text #tag").alias("body"))
    notes = c.select("note_id").distinct().select("note_id", F.lit(20.0).alias("latitude"), F.lit(30.0).alias("longitude"), F.lit(1).alias("id_country"))
    return Base(notes, c, b, None, spark.createDataFrame([(1, "One")], "country_id int, country_name string"))


STEPS = ("created_at < '2022-12-31' AND note_id % 9 <> 4", "created_at < '2023-01-10' OR note_id = 4", "true")


def test_loads_in_steps_end_at_one_load(base, spark, tmp_path):
    """Late actions, and those of the mark's instant, are loaded too; a load without new actions changes nothing."""
    into, whole = facts.table(spark, str(tmp_path / "facts")), facts.facts(base)
    one = spark.createDataFrame([(0, 9, "commented", 1, T(1, 1).replace(year=2022))], base.note_comments.schema)
    with_tie = Base(base.notes, base.note_comments.unionByName(one), base.note_comments_text, base.users, base.countries)  # older than all marks
    for step in STEPS:
        assert facts.load(facts.arrived(base, F.expr(step)), into) is not None
    assert facts.load(base, into) is None
    assert rows(into.read().select(*whole.columns)) == rows(whole)
    mark, told = into.told("mark"), into.snapshot()["told"]
    assert mark == str(whole.agg(F.max("action_at")).first()[0]) and 0 < told["notes"] < 40
    same = spark.createDataFrame([(1, 8, "commented", 1, datetime.fromisoformat(mark))], base.note_comments.schema)
    late = Base(base.notes, with_tie.note_comments.unionByName(same), base.note_comments_text, base.users, base.countries)
    assert facts.load(late, into) and into.told("actions") == 2 and into.told("notes") == 2
    assert rows(into.read().select(*whole.columns)) == rows(facts.facts(late))


@pytest.mark.parametrize("writes", range(5))
def test_a_load_that_dies_is_run_again(base, spark, tmp_path, monkeypatch, writes):
    """After each of its writes, and before the manifest: readers see the earlier snapshot, the next try ends at one load's facts."""
    into = facts.table(spark, str(tmp_path / "facts"))
    facts.load(facts.arrived(base, F.expr(STEPS[0])), into)
    before, left = rows(into.read()), [writes]

    def dying(f):
        def run(*args):
            if not left[0]:
                raise OSError("lost")
            left[0] -= 1
            return f(*args)

        return run

    with monkeypatch.context() as m:
        m.setattr(layers.Layer, "write", dying(layers.Layer.write))
        m.setattr(layers, "put_text", dying(layers.put_text))
        if writes < 4:
            with pytest.raises(OSError):
                facts.load(base, into)
            assert rows(into.read()) == before
    facts.load(base, into)
    whole = facts.facts(base)
    assert rows(into.read().select(*whole.columns)) == rows(whole)


def test_layers_replace_merge_and_refuse(spark, tmp_path, monkeypatch):
    table = layers.Layers(spark, str(tmp_path / "t"), ["k"])
    df = lambda rows: spark.createDataFrame(rows, "k long, v string")
    want = {}
    for n in range(11):
        new = {k: f"{n}" for k in range(n, 40, n + 1)}
        table.append(df(list(new.items())), batch=n)
        want |= new
        assert {r.k: r.v for r in table.read().collect()} == want
        table.compact()
    snap = table.snapshot()
    assert {r.k: r.v for r in table.read().collect()} == want and snap["told"] == {"batch": 10}
    assert [x["level"] for x in snap["layers"]] == [layers.BASE_LEVEL, 1, 1, 0, 0]
    assert sorted(r.k for r in table.changed(snap["layers"][-2]["version"]).collect()) == list(range(10, 40, 11))
    gone = table.begin()
    gone.write(df([]))
    gone.write(spark.createDataFrame([(3,)], "k long"), "keys")  # a key without rows any more
    late = table.begin()
    gone.commit()
    assert {r.k for r in table.read().collect()} == set(want) - {3}
    late.write(df([(1, "x")]))
    with pytest.raises(layers.Conflict):
        late.commit()
    monkeypatch.setattr(layers, "BROADCAST_KEYS", 0)
    assert {r.k for r in table.read().collect()} == set(want) - {3}
    table.vacuum()
    assert {r.k for r in table.read().collect()} == set(want) - {3} and len(list((tmp_path / "t" / "layers").iterdir())) == 6


def test_orphans_and_facts_are_all_actions(base):
    spoilt = Base(base.notes, base.note_comments.where("note_id % 7 <> 0 OR event <> 'opened'"), base.note_comments_text, base.users, base.countries)
    lost, kept = facts.orphans(spoilt), facts.facts(spoilt)
    unopened = spoilt.note_comments.where("note_id % 7 = 0")
    assert unopened.count() > 0 and rows(unopened.select("note_id", F.col("sequence_action").alias("seq"))) == rows(lost.where("note_id % 7 = 0").select("note_id", "seq"))
    assert lost.count() + kept.count() == spoilt.note_comments.count()


def test_percentiles_by_a_plain_version(spark):
    rnd = random.Random(2)
    data = [(k, v) for k, n in (("a", 1), ("b", 2), ("c", 997), ("d", 400)) for v in ([rnd.random() * 10 ** rnd.randrange(4) for _ in range(n)] if k != "d" else [5.0] * 390 + [1.0, 9.5] * 5)]
    got = {r.k: r for r in checks.percentiles(spark.createDataFrame(data, "k string, v double"), ["k"], "v", {"half": 0.5, "high": 0.95, "low": 0.0, "top": 1.0}, cells=16).collect()}
    for k in "abcd":
        own = np.array([v for x, v in data if x == k])
        for name, q in (("half", 50), ("high", 95), ("low", 0), ("top", 100)):
            assert got[k][name] == pytest.approx(np.percentile(own, q))


def test_ranks_by_a_plain_version(spark):
    rnd = random.Random(3)
    data = [(k, rnd.randrange(12)) for k in range(200)]
    want = {k: 1 + sum(m > n for _, m in data) for k, n in data}
    df = spark.createDataFrame(data, "k long, n long")
    assert {r.k: r["rank"] for r in rankings.placed(df).collect()} == want
    assert {r.k: r["rank"] for r in rankings.placed(df, 20).collect()} == {k: r for k, r in want.items() if r <= 20}


def test_runs_in_one_pass(spark):
    days = [datetime(2023, 1, d) for d in (1, 2, 3, 10, 17, 30)] + [datetime(2023, 2, 1)]
    df = spark.createDataFrame([(1, "opened" if k % 2 else "closed", d) for k, d in enumerate(days)], "action_user long, action string, action_date timestamp").withColumn("action_date", F.to_date("action_date"))
    got = rankings.runs(df).first()
    for name, (unit, only) in rankings.RUNS.items():
        assert got[name] == rankings.longest_run(df.where(F.col("action").isin(*only)), unit, "n").first().n


def test_tables_written_anew_give_new_facts(spark, tmp_path):
    for t in ("events", "documents", "nation"):
        spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet").write.parquet(str(tmp_path / f"{t}.parquet"))
    before = Warehouse(spark, str(tmp_path)).facts.count()
    spark.read.parquet("/root/testdata/sf0.001/events.parquet").where("event_id < 500").write.mode("overwrite").parquet(str(tmp_path / "events.parquet"))
    assert Warehouse(spark, str(tmp_path)).facts.count() < before


def test_bodies_are_whole(spark):
    f = Warehouse(spark, "/root/testdata/sf0.001").facts
    longest = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").agg(F.max(F.length("text")).alias("n")).first().n
    assert f.agg(F.max("comment_length").alias("n")).first().n >= min(longest, 2001)


def test_applications(spark):
    bodies = {"x via StreetComplete 5.1": ("StreetComplete", None), "y #organicmaps": ("OrganicMaps", None), "y #organicmaps android": ("OrganicMaps", "android"), "z #organicmaps ios": ("OrganicMaps", "ios"), "q #MapComplete #notes": ("MapComplete", "web"), "none": None}
    got = {r.b: r.a and tuple(r.a) for r in spark.createDataFrame([(b,) for b in bodies], "b string").select("b", C.application(F.col("b")).alias("a")).collect()}
    assert got == bodies


def _sent(df):
    """The columns of what is shuffled or sorted."""
    out, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        p = todo.pop()
        if p.getClass().getSimpleName() in ("ShuffleExchangeExec", "SortExec"):
            out.append(p.output().mkString(","))
        it = p.children().iterator()
        while it.hasNext():
            todo.append(it.next())
    return out


def test_bodies_are_not_shuffled(spark):
    """Whole bodies take many times the input; facts, and loads in steps, take what is told of them."""
    b = Warehouse(spark, "/root/testdata/sf0.001").base
    came = facts.arrived(b, F.expr("created_at < '2024-01-20'"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for x in (b, came, facts.of_notes(came, b.notes.select("note_id").where("note_id % 5 = 0"))):
            f = facts.facts(x)
            sent = _sent(f)
            assert sent and not any("body" in c or "_text" in c for c in sent) and "body" not in f.columns
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_actions_are_dealt_by_note_only(spark, tmp_path, monkeypatch):
    """Comments and what is told of texts lie by note already; dealing them anew by note and sequence, then again by note, took ten times the facts."""
    plans = []

    def seen(write, at):
        def run(*args):
            if "days_active" in args[at].columns:
                plans.append([re.sub(r"#\d+L?", "", x) for x in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", args[at]._jdf.queryExecution().executedPlan().toString())])
            return write(*args)

        return run

    monkeypatch.setattr(facts, "write", seen(facts.write, 0))
    monkeypatch.setattr(layers.Layer, "write", seen(layers.Layer.write, 1))
    for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
        spark.conf.set(key, "false" if "adaptive" in key else "4096")  # that of countries
    was = spark.conf.get(store.ALL_KEYS)
    try:
        (tmp_path / "in").symlink_to("/root/testdata/sf0.001")
        w = Warehouse(spark, str(tmp_path / "in"))
        n = w.facts.count()
        facts.load(w.base, facts.table(spark, str(tmp_path / "facts")))
    finally:
        for key in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold"):
            spark.conf.unset(key)
    assert n == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count() and len(plans) == 2 and spark.conf.get(store.ALL_KEYS) == was
    assert all(set(p) == {"note_id"} and len(p) <= 3 for p in plans), plans


def test_actions_with_texts_are_dealt_once(spark):
    """Comments, notes and texts were dealt by note apart from each other, with whole event ids, and met in joins."""
    b = Warehouse(spark, "/root/testdata/sf0.001").base
    whole = facts.facts(notes.snapshot(b))
    apart = facts.facts(Base(b.notes, b.note_comments, b.note_comments_text, b.users, b.countries))
    assert rows(whole) == rows(apart) and whole.count() == spark.read.parquet("/root/testdata/sf0.001/events.parquet").count()
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = facts.facts(notes.snapshot(b))._jdf.queryExecution().executedPlan().toString()
        sent = [x for x in _sent(facts.facts(notes.snapshot(b))) if "ts" in x]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert len(re.findall(r"Exchange hashpartitioning", plan)) == 1 and "SortMergeJoin" not in plan
    assert sent and not any("event_id" in x for x in sent)


def test_facts_are_written_small(base, spark, tmp_path):
    into = facts.table(spark, str(tmp_path / "layers"))
    facts.load(base, into)
    facts.write(facts.facts(base), str(tmp_path / "facts"))
    files = [p for p in tmp_path.rglob("*.parquet") if p.stat().st_size and pq.ParquetFile(p).metadata.num_row_groups]
    assert len(files) > 3 and {pq.ParquetFile(p).metadata.row_group(0).column(0).compression for p in files} == {"ZSTD"}
    assert rows(into.read()) == rows(spark.read.parquet(str(tmp_path / "facts"))) and into.read().count()


@pytest.mark.parametrize("most", [0, 64_000_000])
def test_bodies_on_demand(spark, monkeypatch, most):
    """Bodies that are joined to some actions are those of the base table, whether documents are broadcast or shuffled."""
    monkeypatch.setattr("notelake.sources.notes.BROADCAST_BYTES", most)
    w = Warehouse(spark, "/root/testdata/sf0.001")
    want = {(r.note_id, r.sequence_action): r.body for r in w.base.note_comments_text.where("note_id < 40").collect()}
    keys = w.base.note_comments.where("note_id < 40").select("note_id", F.col("sequence_action").alias("seq"))
    got = w.bodies(keys, {"whole": "seq", "again": "seq"}, lambda b: F.concat(b, F.lit("!"))).collect()
    assert len(got) == len(want) and {(r.note_id, r.seq): r.whole and r.whole[:-1] for r in got} == want and all(r.whole == r.again for r in got)
