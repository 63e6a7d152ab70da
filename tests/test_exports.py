"""Publications and CSV files: names, order, what fails, and what is read back."""

import json
import os
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from notelake.operators import exports
from notelake.plans.warehouse import Warehouse
from notelake.sources.publish import Publication


def docs(spark, rows):
    return spark.createDataFrame(rows, "path string, document string")


def names(root):
    return sorted(str(p.relative_to(root)) for p in root.rglob("*") if p.is_file() and not p.name.startswith("."))


def test_files_by_name_and_swap(spark, tmp_path):
    target = tmp_path / "out"
    with Publication(spark, str(target)) as p:
        p.documents(docs(spark, [(f"users/{k % 3}/{k}.json", f'{{"k": {k}, "é": "ü"}}') for k in range(20)]))
        p.text("metadata.json", "{}")
        assert not target.exists()
    assert names(target) == sorted([*[f"users/{k % 3}/{k}.json" for k in range(20)], "metadata.json"])
    assert json.loads((target / "users/1/7.json").read_text()) == {"k": 7, "é": "ü"}
    with Publication(spark, str(target)) as p:
        p.documents(docs(spark, [("a.json", "1")]))
    assert names(target) == ["a.json"] and [x.name for x in tmp_path.iterdir()] == ["out"]


def test_arrays_are_in_order(spark, tmp_path):
    rows = spark.range(3000).select(((F.col("id") * 7919) % 3001).alias("n"), (F.col("id") % 5).alias("g")).withColumn("document", F.to_json(F.struct("g", "n"))).repartition(5)
    with Publication(spark, str(tmp_path / "out")) as p:
        p.array(rows, [F.desc("g"), F.asc("n")], "indexes/all.json")
        p.array(rows.limit(0), [F.desc("g")], "indexes/none.json")
    got = json.loads((tmp_path / "out/indexes/all.json").read_text())
    assert len(got) == 3000 and got == sorted(got, key=lambda x: (-x["g"], x["n"]))
    assert json.loads((tmp_path / "out/indexes/none.json").read_text()) == [] and names(tmp_path / "out") == ["indexes/all.json", "indexes/none.json"]
    back = exports.read_array(rows.select("g", "n").schema, spark, str(tmp_path / "out/indexes/all.json"))
    assert [(r.g, r.n) for r in back.orderBy("place").collect()] == [(x["g"], x["n"]) for x in got]


def test_what_fails_leaves_the_old_files(spark, tmp_path):
    target = tmp_path / "out"
    with Publication(spark, str(target)) as p:
        p.documents(docs(spark, [("a.json", "1")]))
    failing = docs(spark, [(f"{k}.json", "2") for k in range(50)]).withColumn("document", F.when(F.col("path") == "40.json", F.raise_error(F.lit("lost"))).otherwise(F.col("document")))
    with pytest.raises(PySparkException), Publication(spark, str(target)) as p:
        p.documents(failing)
    with pytest.raises(ValueError), Publication(spark, str(target)) as p:
        p.documents(docs(spark, [("b.json", "2")]))
        raise ValueError
    assert names(target) == ["a.json"] and [x.name for x in tmp_path.iterdir()] == ["out"]


def test_a_publication_that_died_between_renames_is_put_right(spark, tmp_path):
    (tmp_path / "out.previous").mkdir()
    (tmp_path / "out.previous" / "a.json").write_text("1")
    with pytest.raises(ValueError), Publication(spark, str(tmp_path / "out")):
        raise ValueError
    assert names(tmp_path / "out") == ["a.json"]


def test_publication_is_all_or_nothing(spark, tmp_path):
    rows = spark.createDataFrame([(1, '{"a": 1}'), (2, '{"a": '), (3, '{"b": 1}')], "k long, document string").withColumn("path", F.concat("k", F.lit(".json")))
    checked = exports.valid(rows, "a long", ["a"])
    assert {r.k: r.ok for r in checked.collect()} == {1: True, 2: False, 3: False}
    assert not exports.publish(checked, str(tmp_path / "out")) and not (tmp_path / "out").exists()
    assert exports.publish(checked.where("ok"), str(tmp_path / "out")) and names(tmp_path / "out") == ["1.json"]


@pytest.fixture(scope="module")
def closes(spark):
    """Notes of two countries with several closes; texts with quotes, commas, empty and missing ones."""
    bodies, rows = ['say "hi", a\nb', "", None, "plain"], []
    for n in range(60):
        at = datetime(2023, 1, 1) + timedelta(hours=n * 7 % 240)
        for s, a in enumerate(["opened", "closed", "reopened", "closed"][: 2 + n % 3], 1):
            rows.append((n, s, a, at + timedelta(hours=s), n % 5, 1 + (n % 4 > 0), 3 if a == "closed" else None, bodies[(n + s) % 4]))
    return spark.createDataFrame(rows, "note_id long, seq int, action string, action_at timestamp_ntz, action_user long, country int, days_to_resolution int, body string")


@pytest.mark.parametrize("top", [1, 4, 17, 1000])
def test_closed_notes_by_a_plain_version(closes, spark, top, tmp_path):
    by = {}
    for r in closes.collect():
        by.setdefault((r.country, r.note_id), []).append(r)
    want = []
    for country in (1, 2):
        own = []
        for (c, n), rs in by.items():
            last = max((r for r in rs if r.action == "closed"), key=lambda r: r.action_at)
            if c == country:
                own.append((last.action_at, n, last, min(rs, key=lambda r: r.seq), rs))
        for place, (at, n, last, first, rs) in enumerate(sorted(own, key=lambda x: (x[0], x[1]), reverse=True)[:top], 1):
            clean = lambda b: b and b.replace("\n", " ").replace('"', "'").strip()
            want.append((country, place, n, first.action_at, at, first.action_user, last.action_user, 3, len(rs), 0, any(r.action == "reopened" for r in rs), clean(first.body), clean(last.body)))
    rows = exports.closed_notes(closes, top)
    exports.write_csv(rows, str(tmp_path / "csv"))
    back = exports.read_csv(spark, str(tmp_path / "csv"), rows.schema)
    assert sorted(map(tuple, rows.collect()), key=str) == sorted(want, key=str) == sorted(map(tuple, back.select(rows.columns).collect()), key=str)


def test_csv_files_of_the_query_are_compressed(closes, spark, monkeypatch):
    """Plain CSV of all closed notes took more of the shared folder than all that the build of the facts takes."""
    from notelake.plans import export_queries

    sizes = {}
    real = exports.write_csv

    def both(rows, path, *how):
        real(rows, path, *how)
        real(rows, path + "-plain")
        for k in (path, path + "-plain"):
            at = k.removeprefix("file:")
            sizes[k == path] = sum(os.path.getsize(f"{a}/{f}") for a, _, fs in os.walk(at) for f in fs)

    monkeypatch.setattr(export_queries.X, "write_csv", both)
    assert export_queries._closed_csv(Warehouse(spark, "/root/testdata/sf0.001")).count() > 0
    assert 0 < sizes[True] < sizes[False] / 2
