"""Annotation items: start from a valid one, change one thing, expect its issue."""

import pytest
from pyspark.sql import functions as F

from ambrel.operators import annotations as A

SCHEMA = f"id long, experience map<string,double>, psychology map<string,map<string,double>>, media map<string,map<string,double>>, evidence array<string>, mappings {A.MAPPINGS}"
CODES = ["experience.calm", "psychology.self.trust", "media.film.cut"]
ITEM = {"id": 1, "experience": {"calm": 0.5}, "psychology": {"self": {"trust": 0.25}}, "media": {"film": {"cut": 1.0}}, "evidence": ["a fact", "another"], "mappings": [(c, [0, 1], 1, 0.7, "because") for c in CODES]}
CASES = [
    ({}, set()),
    ({"id": None}, {"id", "missing_item"}),
    ({"id": 2}, {"missing_item", "unexpected_item"}),
    ({"experience": {"calm": 1.5}}, {"score"}),
    ({"experience": {"calm": None}}, {"score"}),
    ({"experience": {"calm": 0.123}}, {"score"}),
    ({"experience": {}}, {"missing_score", "unknown_code"}),
    ({"experience": {"calm": 0.5, "other": 0.5}}, {"unmapped"}),
    ({"media": {"film": {"cut": 1.0}, "song": {}}}, {"media_kinds"}),
    ({"media": None}, {"media_kinds", "missing_score", "unknown_code"}),
    ({"evidence": ["a fact", " "]}, {"evidence"}),
    ({"evidence": []}, {"evidence", "evidence_index"}),
    ({"mappings": None}, {"mappings", "unmapped"}),
    ({"mappings": [*ITEM["mappings"], (CODES[0], [2], 9, 2.0, "")]}, {"duplicate_code", "evidence_index", "relation", "weight", "explanation"}),
    ({"mappings": [*ITEM["mappings"][1:], (CODES[0], [], None, None, None)]}, {"evidence_index", "relation", "weight", "explanation"}),
]


def frame(spark, *items):
    names = [f.split()[0] for f in "id experience psychology media evidence mappings".split()]
    return spark.createDataFrame([tuple(i[n] for n in names) for i in items], SCHEMA)


def codes(spark):
    return spark.createDataFrame([(c,) for c in CODES], "code string")


@pytest.mark.parametrize("case", range(len(CASES)))
def test_case(spark, case):
    change, expected = CASES[case]
    found = A.issues(frame(spark, ITEM | change), codes(spark), spark.createDataFrame([(1,)], "id long"))
    assert {r["rule"] for r in found.collect()} == expected


def test_copies_empty_table_links_and_sparse(spark):
    assert {r["rule"] for r in A.issues(frame(spark, ITEM, ITEM), codes(spark)).collect()} == {"duplicate_id", "duplicate_code"}
    assert A.issues(frame(spark, ITEM).limit(0), codes(spark)).count() == 0
    assert A.evidence_links(frame(spark, ITEM)).count() == 6
    scores = A.dimensions(frame(spark, ITEM)).where("code <> 'media.film.cut'")
    got = {(r["code"], r["score"], r["state"]) for r in A.sparse_profile(frame(spark, ITEM), codes(spark), scores).collect()}
    assert got == {(CODES[0], 0.5, 1), (CODES[1], 0.25, 1), (CODES[2], None, 4)}
    rules = spark.range(1).select(A.fact_relation(F.lit(0.25)), A.fact_relation(F.lit(0.4)), A.evidence_state(A.fact_relation(F.lit(0.1))), A.anchor_weight(F.lit(0.9))).first()
    assert tuple(rules) == (4, 2, 2, 0.9)
