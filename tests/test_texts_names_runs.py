"""Sources of loose text, name groups, runs and streams on small cases."""

import json
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from ambrel.operators import names as N
from ambrel.operators.runs import Store
from ambrel.sources.scratch import keeper
from ambrel.sources import texts as X
from ambrel.streaming import events as V


def outcome(spark, f, texts):
    return [r["x"] for r in spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", f("t").alias("x")).orderBy("i").collect()]


def test_repairs(spark):
    good = {
        '```json\n{"a": 1}\n```': {"a": 1},
        '{"a": [1, 2,], }': {"a": [1, 2]},
        '{\n"a": "he said "no" to it",\n"b": 2\n}': {"a": 'he said "no" to it', "b": 2},
        '{"a": {"b": "x}"}': {"a": {"b": "x}"}},
        '﻿[1]': [1],
        '{"a": "kept ,} as is"}': {"a": "kept ,} as is"},
    }
    found = outcome(spark, X.repaired_json, [*good, "no json", "", None])
    assert [json.loads(r["value"]) for r in found[: len(good)]] == list(good.values())
    assert all(r["value"] is None and r["error"] for r in found[len(good) :])


def test_embedded(spark):
    found = outcome(spark, X.embedded_json, ["Here: {not} [1, 2]", '```\n{"a": 1}\n```', '{"a": 1} and more', "none", None, "[" * 50000])
    assert [r["value"] for r in found[:2]] == ["[1, 2]", '{"a": 1}']
    assert all(r["value"] is None and r["error"] for r in found[2:])


def test_partial_arrays_and_names(spark):
    assert outcome(spark, X.complete_objects, ['[{"a": "]}"}, {"b": 2}, {"c":', "[]", "x", None]) == [['{"a": "]}"}', '{"b": 2}'], [], [], []]
    assert outcome(spark, X.names_of, ['["a", " b ", ""]', "('x', 'y')", '"p", and "q"', "# c\none\n\n two,\n", "", None]) == [["a", "b"], ["x", "y"], ["p", "q"], ["one", "two"], [], []]
    assert outcome(spark, X.close_array, ['[{"a":1},', '[{"a":1}]', None]) == ['[{"a":1}]', '[{"a":1}]', None]


def test_files(spark, tmp_path):
    (tmp_path / "a.json").write_text('﻿[{"x": 1}, {"x": "two"}, 3]', "utf-8")
    rows = X.json_items(spark, f"{tmp_path}/a.json", "x int").orderBy("position").collect()
    assert [(r["position"], r["x"]) for r in rows] == [(0, 1), (1, None), (2, None)]
    (tmp_path / "b.json").write_text('{"items": [{"x": 5}]}')
    assert X.json_items(spark, f"{tmp_path}/b.json", "x int", "items").first()["x"] == 5
    for text in ("{}", "nothing", "null"):
        (tmp_path / "c.json").write_text(text)
        with pytest.raises(Exception, match="no JSON array"):
            X.json_items(spark, f"{tmp_path}/c.json", "x int").collect()
    (tmp_path / "n.txt").write_text("# names\n b \n\na\r\nb\n")
    assert [r["item"] for r in X.listed_lines(spark, f"{tmp_path}/n.txt").orderBy("position").collect()] == ["b", "a"]


def test_name_groups_against_brute_force(spark):
    names = ["Ann Lee", "ANN LEE", "Ann Lee Group", "Lee", "Bo", "bo", "Zed", "王小明", "王小明 (a)", "x", "", None, "Quiet Band", "Quiet"]
    low = {n: n.lower() for n in names if n}
    base = {n: low[n].removesuffix("band").removesuffix("group").strip() for n in low}
    han = {n: "".join(c for c in n if "㐀" <= c <= "鿿") for n in low}
    linked = lambda a, b: base[a] == base[b] or low[a] == low[b] or len(han[a]) > 1 and han[a] == han[b] or any(len(low[s]) > 1 and low[s] in low[t] for s, t in ((a, b), (b, a)))
    label = {n: n for n in low}
    for _ in low:
        for a, b in combinations(low, 2):
            if linked(a, b):
                label[a] = label[b] = min(label[a], label[b])
    alone = {n for n in low if not any(linked(n, m) for m in low if m != n)}
    found = N.name_groups(spark.createDataFrame([(n,) for n in names], "name string"), "name", keeper(spark), ["Group", "Band"])
    assert {r["name"]: r["component"] for r in found.collect()} == {n: c for n, c in label.items() if n not in alone}


def test_components_of_a_chain(spark):
    links = spark.range(0, 200).select(F.format_string("%04d", "id").alias("a"), F.format_string("%04d", F.col("id") + 1).alias("b"))
    found = N.components(links, keeper(spark)).collect()
    assert len(found) == 201 and {r["component"] for r in found} == {"0000"}
    assert N.components(links.limit(0), keeper(spark)).count() == 0


def test_runs(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    old = spark.createDataFrame([(1, "a", 1), (2, "b", 2)], "id int, name string, n int")
    store.write("t", old)
    store.require({"t": ["id"]})
    with pytest.raises(ValueError, match="t.other, u"):
        store.require({"t": ["id", "other"], "u": []})
    new = spark.createDataFrame([(2, None, 9), (3, "c", 3)], "id int, name string, n int")
    m = store.load("first", {"t": ("id", ["name"], new)})
    rows = lambda: sorted(tuple(r) for r in store.read("t").collect())
    assert m["status"] == "succeeded" and rows() == [(1, "a", 1), (2, None, 2), (3, "c", 3)]
    assert [tuple(r) for r in store.status(m["run"]).collect()] == [("t", 2, 0)]
    assert store.rollback(m["run"])["status"] == "rolled_back" and rows() == [(1, "a", 1), (2, "b", 2)]
    with pytest.raises(ValueError, match="rolled_back"):
        store.rollback(m["run"])
    with pytest.raises(ValueError, match="rolled_back"):
        store.retry(m["run"], {})
    children = store.load("second", {"t": ("n", [], new.select(F.lit(7).alias("id"), "name", F.lit(1).alias("n")))}, children={"t": "n"})
    assert sorted(r["id"] for r in store.read("t").collect()) == [2, 7, 7]
    store.rollback(children["run"])
    assert rows() == [(1, "a", 1), (2, "b", 2)]


def test_failed_run_is_marked_and_retried(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    old = spark.createDataFrame([(1, "a")], "id int, name string")
    store.write("t", old)
    bad = old.withColumn("name", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        store.load("x", {"t": ("id", ["name"], bad)})
    (run,) = [p.name for p in (tmp_path / "_runs").iterdir() if p.is_dir()]
    assert store.manifest(run)["status"] == "failed" and store.read("t").count() == 1
    again = store.retry(run, {"t": ("id", ["name"], old.withColumn("name", F.lit("z")))})
    assert again["parent"] == run and store.read("t").first()["name"] == "z"


def test_stream_resumes(spark, tmp_path):
    rows = spark.sql("select id, timestamp_seconds(86400 + id * 60) as ts, 'k' as kind, 1.0d as v from range(10)")
    rows.write.parquet(f"{tmp_path}/in")
    run = lambda: V.append_available(V.distinct_within(V.files(spark, f"{tmp_path}/in", rows.schema), ["id"], "ts", "1 day"), f"{tmp_path}/out", f"{tmp_path}/cp")
    run()
    rows.where("id < 3").union(rows.where("id = 9").withColumn("id", F.lit(10).cast("long"))).write.mode("append").parquet(f"{tmp_path}/in")
    run()
    assert sorted(r["id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(11))
    seen = {}
    counts = V.window_counts(V.files(spark, f"{tmp_path}/in", rows.schema), "ts", "1 day", "5 minutes", ["kind"], "v")
    V.each_batch(counts, lambda df, n: seen.update({str(r["start"]): r["n"] for r in df.collect()}), f"{tmp_path}/cp2", "update")
    assert sorted(seen.values()) == [6, 8]
