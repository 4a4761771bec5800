"""Nested values opened and put together again, against Python's own walk."""

import json
import random

import pytest
from pyspark.sql import functions as F

from ambrel.operators import nested as N
from ambrel.sources.scratch import keeper


def walk(value, lists=True, path=()):
    if isinstance(value, dict) and value:
        return [x for k, v in value.items() for x in walk(v, lists, (*path, k))]
    if lists and isinstance(value, list) and value:
        return [x for i, v in enumerate(value) for x in walk(v, lists, (*path, i))]
    return [(path, value)]


def some(r, depth):
    kind = r.randint(0, 8 if depth else 5)
    if kind < 6:
        return [r.randint(-9, 9), r.random(), True, None, 'a "b" \\ ü\n', ""][kind]
    if kind == 6:
        return [some(r, depth - 1) for _ in range(r.randint(0, 3))]
    return {r.choice(["a", "b.c", 'q"', "", "ü", "x y", "1"]): some(r, depth - 1) for _ in range(r.randint(0, 4))}


def values():
    r = random.Random(8)
    out = [some(r, d) for d in range(7) for _ in range(9)]
    deep = 1
    for i in range(20):
        deep = {"k": deep} if i % 2 else [deep, i]
    return [*out, deep, {}, [], 5, "text", None, True, {"a": []}, {"a": {}}]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "id long, j string")


@pytest.mark.parametrize("lists", [True, False])
def test_leaves_against_a_walk(spark, lists):
    all_values = values()
    rows = N.leaves(table(spark, [json.dumps(v) for v in all_values] + [None, "{broken", ""]), ["id"], "j", keeper(spark), lists).collect()
    got = sorted((r["id"], tuple(s["pos"] if s["key"] is None else s["key"] for s in r["path"]), json.dumps(json.loads(r["json"]), sort_keys=True)) for r in rows)
    assert sorted(map(repr, got)) == sorted(repr((i, p, json.dumps(v, sort_keys=True))) for i, x in enumerate(all_values) for p, v in walk(x, lists))


def test_round_trip(spark):
    all_values = values()
    rows = N.leaves(table(spark, [json.dumps(v) for v in all_values]), ["id"], "j", keeper(spark))
    back = {r["id"]: json.loads(r["json"]) for r in N.nested(rows, ["id"], keeper(spark)).collect()}
    assert back == dict(enumerate(all_values))


def test_numbers(spark):
    doc = {"a": {"b": 1, "c": {"d": 2.5, "e": True, "f": "3"}}, "g": [1, 2], "h": None, "i": 10**20, "j": 1e-3}
    got = {r["path"]: r["value"] for r in N.numeric_leaves(table(spark, [json.dumps(doc)]), ["id"], "j", keeper(spark)).collect()}
    assert got == {"a.b": 1.0, "a.c.d": 2.5, "i": 1e20, "j": 1e-3}


def test_assign_and_clear(spark):
    docs = [{"v": {"a": 1, "b": {"c": 2, "t": "text"}}, "w": {"d": 3}}, {"v": {"a": 4}}]
    rows = N.leaves(table(spark, [json.dumps(d) for d in docs]), ["id"], "j", keeper(spark))
    empty = N.nested(N.cleared(rows, ["v"]).select("id", "path", "json"), ["id"], keeper(spark))
    assert [json.loads(r["json"]) for r in empty.orderBy("id").collect()] == [{"v": {"a": None, "b": {"c": None, "t": "text"}}, "w": {"d": 3}}, {"v": {"a": None}}]
    path = lambda text: F.transform(F.split(F.lit(text), "/"), lambda k: F.struct(k.alias("key"), F.lit(None).cast("int").alias("pos")))
    change = lambda i, p, v: spark.range(1).select(F.lit(i).cast("long").alias("id"), path(p).alias("path"), F.lit(v).alias("json"))
    changes = change(0, "v/b/c", "0.5").union(change(1, "v/new/x", "1")).union(change(0, "w", '"all"'))
    out = N.nested(N.assigned(rows, changes, ["id"], ["v", "w"]), ["id"], keeper(spark))
    assert [json.loads(r["json"]) for r in out.orderBy("id").collect()] == [{"v": {"a": 1, "b": {"c": 0.5, "t": "text"}}, "w": "all"}, {"v": {"a": 4, "new": {"x": 1}}}]
    with pytest.raises(Exception, match="unknown path z.y"):
        N.assigned(rows, change(0, "z/y", "1"), ["id"], ["v"]).collect()


def test_empty_table(spark):
    none = N.leaves(table(spark, ["{}"]).limit(0), ["id"], "j", keeper(spark))
    assert none.count() == 0 and N.nested(none, ["id"], keeper(spark)).count() == 0


def test_levels_are_opened_in_one_pass(spark):
    kept, keep = [], keeper(spark)
    rows = N.leaves(table(spark, ['{"a": {"b": {"c": [1]}}}']), ["id"], "j", lambda df: kept.append(df) or keep(df))
    assert [r["json"] for r in rows.collect()] == ["1"] and len(kept) == 1


def test_rows_are_dealt_over_tasks_by_their_number(spark, monkeypatch):
    monkeypatch.setattr(N, "PER_TASK", 4)
    docs, kept, keep = [{"v": {"a": i, "b": [i, 2]}} for i in range(20)], [], keeper(spark)
    rows = N.leaves(table(spark, [json.dumps(d) for d in docs]), ["id"], "j", keep)
    path = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(None).cast("int").alias("pos")) for k in "va"])
    changed = N.assigned(rows, spark.range(20).select("id", path.alias("path"), F.lit("7").alias("json")), ["id"])
    back = N.nested(changed, ["id"], lambda df: kept.append(df.rdd.getNumPartitions()) or keep(df))
    assert {r["id"]: json.loads(r["json"]) for r in back.collect()} == {i: d | {"v": d["v"] | {"a": 7}} for i, d in enumerate(docs)}
    assert kept[1:] == [10, 10, 5]  # 40 list items, 40 members, 20 values
