"""Profiles brought under the schema: each repair, each issue, and what follows from evidence and facts."""

import json

import pytest

from ambrel.operators import profiles as P
from ambrel.sources.scratch import keeper

GOOD = {
    "basic": {}, "semantic": {"summary": "short", "themes": [], "keywords": ["k"], "core_experience": "c", "experience_introduction": "given"},
    "experience_vector": {"joy": 0.5}, "psychology_vector": {"social_relationship": {"love": 0.8}}, "media_vector": {"music_vector": {"tempo": 0.3, "genre": "pop"}},
    "vector_facts": [{"dimensionPath": p, "score": 0.5, "explanation": p} for p in ("experience_vector.joy", "psychology_vector.social_relationship.love", "media_vector.music_vector.tempo")],
    "experience_vector_summary": {k: k for k in P.SUMMARY}, "personality_affinity": {k: 0.5 for k in P.AFFINITY}, "supporting_evidence": [f"e{i}" for i in range(8)], "quality_control": {},
}


def enforced(spark, items, ids=None):
    rows = [(f"w{i}", x if x is None or isinstance(x, str) else json.dumps(x)) for i, x in enumerate(items)]
    return P.enforce(spark.createDataFrame(rows, "key string, j string"), "key", "j", "key", keeper(spark))


def without(item, *names):
    return {k: v for k, v in item.items() if k not in names}


def test_repairs(spark):
    inside = without(GOOD, *P.LIFTED) | {"semantic": GOOD["semantic"] | {k: GOOD[k] for k in P.LIFTED}, "dimension_evidence": [1]}
    social = GOOD | {"psychology_vector": {"social": {"love": 0.8}, "social_x": {"z": "t"}}, "supporting_evidence": ["e"] * 3, "vector_facts": [
        {"dimensionPath": "psychology_vector.social.love", "score": 0.8, "explanation": "a"}, {"imdensionPath": "media_vector.music.tempo", "dimensionpath": "x", "score": 0.3}, {"dimension_path": "", "dimensionpath": "experience_vector.joy"},
        {"dimensionPath": "media_vector.music.genre"}, {"dimensionPath": 5}, {"other": 1}, "text", None]}
    both = GOOD | {"psychology_vector": {"social": {"a": 1}, "social_relationship": {"love": 0.8}}, "vector_facts": GOOD["vector_facts"] + [{"dimensionPath": "psychology_vector.social.a"}]}
    derived = GOOD | {"semantic": without(GOOD["semantic"], "experience_introduction"), "basic": {"contentId": "own", "isSynthetic": None, "more": 1}, "quality_control": {"trainingStatus": "CHECKED"}}
    same = GOOD | {"semantic": GOOD["semantic"] | {"experience_introduction": "", "summary": " experience_description "}}
    out = enforced(spark, [GOOD, inside, social, both, derived, same])
    assert out["issues"].collect() == []
    rows = {r["id"]: r for r in out["profiles"].collect()}
    assert len(rows) == 6 and [rows[f"w{i}"]["training_status"] for i in range(6)] == ["TRAINABLE", "TRAINABLE", "REJECTED", "TRAINABLE", "CHECKED", "TRAINABLE"]
    assert rows["w2"]["rejection_reasons"] == ["evidence_insufficient"] and rows["w4"]["rejection_reasons"] is None
    assert rows["w0"]["basic"].asDict() == {"contentId": '"w0"', "parentContentId": "null", "workId": '"w0"', "sourceType": '"CULTURAL_WORK"', "dataOrigin": '"PROVIDED"', "isSynthetic": "false"}
    assert (rows["w4"]["basic"]["contentId"], rows["w4"]["basic"]["isSynthetic"]) == ('"own"', "null")
    assert [rows[f"w{i}"]["semantic"]["experience_introduction"] for i in (0, 4, 5)] == ["given", "short\nexperience_description", "experience_description"]
    facts = [(r["position"], r["path"]) for r in out["facts"].where("id = 'w2'").orderBy("position").collect()]
    assert facts == [(0, "psychology_vector.social_relationship.love"), (1, "media_vector.music_vector.tempo"), (2, "experience_vector.joy")]
    assert {r["path"]: r["value"] for r in out["vectors"].where("id = 'w2'").collect()} == {"psychology_vector.social_relationship.love": 0.8, "media_vector.music_vector.tempo": 0.3, "experience_vector.joy": 0.5}
    assert rows["w1"]["affinity"]["Ni"] == 0.5 and rows["w1"]["evidence"][0] == '"e0"'


def test_issues(spark):
    cases = [
        (None, {"item"}), ("[1]", {"item"}), ("{broken", {"item"}), (GOOD | {"basic": []}, {"basic"}), (without(GOOD, "basic", "media_vector"), {"basic", "fields"}), (GOOD | {"semantic": without(GOOD["semantic"], "themes")}, {"semantic"}),
        (GOOD | {"personality_affinity": without(GOOD["personality_affinity"], "Ti")}, {"affinity"}), (GOOD | {"personality_affinity": None}, {"affinity"}), (GOOD | {"experience_vector_summary": {"summary": "x"}}, {"summary"}),
        (GOOD | {"experience_vector_summary": GOOD["experience_vector_summary"] | {P.SUMMARY[0]: " 　"}}, {"summary"}), (GOOD | {"vector_facts": GOOD["vector_facts"][1:]}, {"coverage"}), (GOOD | {"vector_facts": GOOD["vector_facts"] + GOOD["vector_facts"][:1]}, {"coverage"}),
        (GOOD | {"semantic": {"summary": 3, "themes": [], "keywords": [], "core_experience": ""}, "experience_vector_summary": 1}, {"semantic", "summary"}), (GOOD | {"vector_facts": None}, {"coverage"}),
    ]
    out = enforced(spark, [x for x, _ in cases])
    found = {}
    for r in out["issues"].collect():
        found.setdefault(r["id"], set()).add(r["issue"])
    assert [found.get(f"w{i}") for i in range(len(cases))] == [issues for _, issues in cases]
    assert out["profiles"].count() == 0
    assert {r["detail"] for r in out["issues"].where("issue = 'fields'").collect()} == {"media_vector"}


def test_nothing_to_tell(spark):
    bare = GOOD | {"experience_vector": {}, "psychology_vector": {}, "media_vector": {}, "vector_facts": [], "supporting_evidence": []}
    out = enforced(spark, [bare])
    assert out["profiles"].first()["rejection_reasons"] == ["evidence_insufficient", "facts_missing"] and out["issues"].count() == 0



@pytest.mark.parametrize("name", ["profiles", "issues", "facts", "vectors"])
def test_empty_table(spark, name):
    items = spark.createDataFrame([], "key string, j string")
    assert P.enforce(items, "key", "j", "key", keeper(spark))[name].count() == 0
