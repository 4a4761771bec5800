"""Training sets: joins with problems told, exact splits, padding, and a baseline that learns."""

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from ambrel.operators import training as T
from ambrel.sources.scratch import keeper


def test_examples(spark):
    inputs = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", "z"), ("d", "w"), ("e", "v")], "name string, text string")
    notes = [("a", 0, {"p": {"q": 9.0}}), ("a", 3, {"p": {"q": 0.5, "t": "text"}, "r": 1, "flag": True}), ("b", 1, {"p": {"q": 0.25}, "r": 0}), ("c", 1, {"p": {"q": 1}}), ("d", 1, {"s": "no number"}), (None, 1, {"p": 1})]
    out = T.examples(inputs, spark.createDataFrame([(n, p, json.dumps(j)) for n, p, j in notes], "name string, position int, note string"), "name", "note", keeper(spark))
    assert {r["name"]: (r["text"], r["labels"]) for r in out["examples"].collect()} == {"a": ("x", {"p.q": 0.5, "r": 1.0}), "b": ("y", {"p.q": 0.25, "r": 0.0})}
    assert {tuple(r) for r in out["problems"].collect()} == {("c", "other_labels", "p.q"), ("d", "no_label", None), ("e", "no_annotation", None)}


@pytest.mark.parametrize("n,ratio,size", [(1, 0.1, 1), (2, 0.9, 1), (9, 0.1, 1), (500, 0.1, 50), (37, 0.333, 12), (0, 0.1, 0)])
def test_exact_split(spark, n, ratio, size):
    out = T.exact_split(spark.range(n), "id", ratio, "s")
    rank = sorted(range(n), key=lambda i: (int(hashlib.sha256(f"s:{i}".encode()).hexdigest()[:6], 16) % T.BUCKETS, hashlib.sha256(f"s:{i}".encode()).hexdigest()))
    assert sorted(r["id"] for r in out.where("part = 'eval'").collect()) == sorted(rank[:size]) and out.count() == n and T.held_out(n, ratio) == size


def test_split_of_groups(spark):
    rows = spark.range(200).select("id", F.when(F.col("id") % 11 > 0, F.col("id") % 11).alias("g"))
    out = T.exact_split(rows, "id", 0.3, "s", "g").collect()
    parts = {}
    for r in out:
        parts.setdefault(r["g"], set()).add(r["part"])
    assert len(out) == 200 and all(len(p) == 1 for p in parts.values()) and sum(p == {"eval"} for p in parts.values()) == 3


def test_padding(spark):
    rows = spark.createDataFrame([(1, [5, 6, 7]), (2, []), (3, None), (4, [9]), (5, [1, 2])], "id int, t array<int>").coalesce(1)
    got = [(r["batch"], r["ids"], r["tokens"], r["mask"]) for r in T.padded_batches(rows, "id", "t", 2, -1).collect()]
    assert got == [(0, [1, 2], [[5, 6, 7], [-1, -1, -1]], [[1, 1, 1], [0, 0, 0]]), (1, [3, 4], [[-1], [9]], [[0], [1]]), (2, [5], [[1, 2]], [[1, 1]])]


def test_baseline_learns(spark):
    r = random.Random(4)
    words = ["alpha", "beta", "gamma", "delta", "noise", "other"]
    rows = []
    for i in range(400):
        own = [w for w in words if r.random() < 0.5]
        rows.append((i, " ".join(own), {"a": 0.8 if "alpha" in own else 0.2, "b": 0.9 if "beta" in own and "gamma" in own else 0.3}))
    df = T.exact_split(spark.createDataFrame(rows, "id int, text string, labels map<string,double>"), "id", 0.25, "x")
    model = T.fit_baseline(df.where("part = 'train'"), ["a", "b"], strength=0.001)
    out = model.predict(df.where("part = 'eval'"))
    found = {e["label"]: e for e in T.errors(out).collect()}
    assert found["a"]["n"] == 100 and found["a"]["mse"] < 0.005 and found["b"]["mse"] < 0.06
    assert all(0 <= v <= 1 for r in out.collect() for v in r["predicted"].values())


def test_jitter(spark):
    got = {r["id"]: r["j"] for r in spark.range(50).select("id", T.jitter(F.concat(F.lit("k"), "id"), 0.2).alias("j")).collect()}
    assert got == pytest.approx({i: (int(hashlib.sha256(f"k{i}".encode()).hexdigest()[:8], 16) / 0xFFFFFFFF - 0.5) * 0.2 for i in range(50)})
