"""Annotation profiles imported: values and evidence by score, everything that refuses a batch."""

import pytest
from pyspark.sql import functions as F

from ambrel.functions.scalar import stable_id
from ambrel.operators import annotation_import as A
from ambrel.operators.importing import ImportRefused
from ambrel.operators.runs import Store

TRAITS = [*A.REQUIRED, "openness"]


def store_of(spark, path, works=("w1", "w2")):
    store = Store(spark, str(path))
    A.create(store)
    rows = spark.createDataFrame([(w,) for w in works] + [("gone",)], "w string")
    store.write("work", rows.select(stable_id("work", F.col("w")).alias("id"), F.when(F.col("w") == "gone", 1).otherwise(0).alias("deleted")))
    return store


def batch(spark, ids=("w1", "w2"), vectors=None, facts=None, traits=TRAITS):
    vectors = vectors or [(i, p, v) for i in ids for p, v in (("experience_vector.joy", 0.25), ("psychology_vector.social.love", 0.4), ("media_vector.m.tempo", 0.5), ("media_vector.m.bare", 0.9))]
    facts = facts if facts is not None else [(i, k, p, s, e) for i in ids for k, (p, s, e) in enumerate([("experience_vector.joy", 0.25, "low"), ("psychology_vector.social.love", 0.4, "mid"), ("media_vector.m.tempo", 0.5, "high"), ("media_vector.m.bare", 0.9, " "), ("media_vector.old", 7.0, "x")])]
    return {
        "profiles": spark.createDataFrame([(i, "s", 0.7, "{}") for i in ids], "id string, summary string, confidence double, payload string"), "vectors": spark.createDataFrame(vectors, "id string, path string, value double"),
        "facts": spark.createDataFrame(facts, "id string, position int, path string, score double, explanation string"), "affinity": spark.createDataFrame([(i, t, 0.5) for i in ids for t in traits], "id string, trait string, score double"),
    }


def test_import(spark, tmp_path):
    store = store_of(spark, tmp_path)
    run = A.import_profiles(store, "a", batch(spark), "v1.6")
    assert run["status"] == "succeeded" and {t: store.read(t).count() for t in A.TABLES} == {"profile": 2, "dimension_definition": 4, "dimension_value": 8, "evidence": 6, "dimension_evidence": 6, "projection": 22}
    codes = store.read("dimension_definition").select(F.col("id").alias("dimension_id"), "dimension_code", "group_code", "name_en")
    rows = {r["dimension_code"]: (r["evidence_state"], r["evidence_count"], r["rationale"]) for r in store.read("dimension_value").join(codes, "dimension_id").collect()}
    assert rows == {"experience.joy": (2, 1, "low"), "psychology.social_relationship.love": (1, 1, "mid"), "media.m.tempo": (1, 1, "high"), "media.m.bare": (1, 0, None)}
    assert {(r["relation_type"], r["explanation"]) for r in store.read("dimension_evidence").collect()} == {(4, "low"), (2, "mid"), (1, "high")}
    assert {(r["evidence_type"], r["fact_text"]) for r in store.read("evidence").collect()} == {(7, "low"), (2, "mid"), (2, "high")}
    assert {r["projection_system"]: r["count"] for r in store.read("projection").groupBy("projection_system").count().collect()} == {1: 16, 2: 2, 4: 4}
    assert {(r["dimension_code"], r["group_code"], r["name_en"]) for r in codes.collect()} >= {("media.m.tempo", "media.m", "tempo"), ("experience.joy", "experience", "joy")}
    with pytest.raises(ImportRefused) as again:
        A.import_profiles(store, "b", batch(spark), "v1.6")
    assert again.value.counts == {"profile_current": 2}
    store.rollback(run["run"])
    assert all(store.read(t).count() == 0 for t in A.TABLES)


def test_refused(spark, tmp_path):
    store = store_of(spark, tmp_path)
    joy = [("w1", "experience_vector.joy", 0.5)]
    cases = [
        (batch(spark, ("w1", "gone")), {"work_unknown": 1}), (batch(spark, ("w1", "w1"), joy, []), {"duplicate_id": 1}), (batch(spark, ("w1", None), joy, []), {"missing_id": 1, "trait_missing": 1}), (batch(spark, ("w1",), [("w1", "experience_vector.joy", 1.5)], []), {"score_range": 1}),
        (batch(spark, ("w1",), joy, [("w1", 0, "experience_vector.joy", 0.4, "e"), ("w1", 1, "x", 0.4, "e")]), {"fact_score": 1}), (batch(spark, ("w1",), joy, [("w1", k, "x", 0.4, "e") for k in (0, 1)]), {"fact_twice": 1}),
        (batch(spark, ("w1",), joy, [], TRAITS[1:]), {"trait_missing": 1}), (batch(spark, ("w1",), joy, [], [*TRAITS, "Zz"]), {"trait_unknown": 1}),
    ]
    snapshot = store.snapshot()[1]
    for rows, expected in cases:
        found = A.problems(rows, lambda t: store._at(snapshot, t), "v1.6").groupBy("problem").count().collect()
        assert {r["problem"]: r["count"] for r in found} == expected
    with pytest.raises(Exception, match="unknown path other.x"):
        spark.createDataFrame([("other.x",)], "p string").select(A.canonical(F.col("p"))).collect()
