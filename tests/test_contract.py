"""One document with a fault for each rule, beside documents without any."""

import json

import pytest

from ambrel.operators import contract

PAINTER = {"id": "realCharacter_nld_1853_017", "characterType": 1, "realSubType": 1, "creativeEntityType": 1, "gender": 1, "countryCode": "NLD", "field": 2, "beginCentury": 1853, "endCentury": 1890, "names": [{"language": 1, "name": "Painter"}, {"language": 3, "name": "Maler"}, {"language": 3, "name": "Peintre"}], "introduction": "p" * 60, "ownWork": [], "position": 4}
NOVEL = {"workId": "work_fra_1831_204", "workName": "A novel", "genre": 1, "subcategory": 1002, "year": 1831, "introduction": "n" * 40, "creators": [{"characterId": "realCharacter_fra_1802_300", "relationType": 1}], "position": 9}

PEOPLE = {
    "characterType": {"character_type": [None, 2]}, "realSubType": {"real_sub_type": [None, 3]}, "creativeEntityType": {"entity_type": [0, 11]},
    "gender": {"gender": [None, 4, -1]}, "field": {"field": [9, None]}, "dynasty": {"dynasty world_dynasty": [8, 22], "world_dynasty": [3]},
    "countryCode": {"country_code": ["nld", "NLDX"]}, "beginCentury": {"begin_year id_year": [0], "begin_year id_year year_order": [2101], "id_year": [None, 1852], "year_order id_year": [1891]},
    "endCentury": {"year_order": [1852], "end_year": [2200], "end_year year_order": [-6000]}, "ownWork": {"own_work_missing": [None], "own_work_item": [[{"workId": None, "relationType": 1}], [{"workId": "w"}]], "": [[{"workId": " ", "relationType": 1}, {"workId": "w", "relationType": 77}]], "own_work_duplicate": [[{"workId": "w", "relationType": 1}] * 2]},
    "introduction": {"introduction_missing": [None, " \u3000"], "introduction_short": ["p" * 59 + " " * 30, "lorem"], "introduction_phrase": ["lorem " + "p" * 60]},
    "names": {"names_empty": [None, []], "name_language": [[{"language": 4, "name": "x"}, {"language": 4, "name": "x"}]], "name_blank": [[{"language": 0, "name": "\u3000"}, {"language": 0, "name": "y"}]],
              "name_duplicate": [[{"language": 3, "name": "Stra\u00dfe"}, {"language": 3, "name": " \uff33TRASSE"}]], "name_standard_twice": [[{"language": 2, "name": "x"}, {"language": 2, "name": "y"}]]},
    "id": {"missing_id": [None, " "], "id_pattern": ["painter_1853_017", "realCharacter_NLD_1853_017"], "id_year": ["realCharacter_nld_unknown_017"], "": [" realCharacter_nld_1853_918 "]},
}
WORKS = {
    "workName": {"work_name": ["", None]}, "originalName": {"original_name": [" "], "": ["Roman"]}, "year": {"year": [0], "": [None, -20]}, "countryCode": {"country_code": ["F"]},
    "introduction": {"introduction_missing": [""], "introduction_short": ["n" * 39], "introduction_phrase": ["lorem" + "n" * 40]}, "genre": {"genre subcategory tag": [13, None]},
    "subcategory": {"subcategory tag": [2002, 1016], "": [None]}, "subcategories": {"tag": [[1002, 3001]], "tag_duplicate": [[1002, 1002]], "primary_tag": [[1003]], "": [[1003, 1002]]},
    "creators": {"creators_empty": [None, []], "relation_type": [[{"characterId": "c", "relationType": 36}]], "relation_genre": [[{"characterId": "c", "relationType": 17}]],
                 "sort_order": [[{"characterId": "c", "relationType": 1}, {"characterId": "e", "relationType": 99, "sortOrder": 2}]], "creator_duplicate": [[{"characterId": "c", "relationType": 1}, {"characterId": "c", "relationType": 1, "sortOrder": 1}]]},
    "primaryAuthorId": {"primary_author": ["someone"], "": ["realCharacter_fra_1802_300"]}, "workId": {"missing_id": [None], "id_pattern": ["work_1831_204"]},
}


def documents(spark, docs, schema):
    return spark.createDataFrame([(json.dumps(d),) for d in docs], "j string").selectExpr(f"from_json(j, '{' '.join(schema.split())}') as d").select("d.*")


@pytest.mark.parametrize("kind", ["character", "work"])
def test_each_rule(spark, kind):
    good, faults, key, run, schema = {"character": (PAINTER, PEOPLE, "id", contract.character_issues, contract.CHARACTER), "work": (NOVEL, WORKS, "workId", contract.work_issues, contract.WORK)}[kind]
    docs, expected = [], []
    for field, by_rules in faults.items():
        for rules, values in by_rules.items():
            for value in values:
                doc = good | {key: good[key][:-3] + f"{len(docs):03d}"} | {field: value}
                docs.append(doc)
                expected += [((doc[key] or "").strip(), r) for r in rules.split()]
    found = run(documents(spark, docs, schema), "lorem").collect()
    assert sorted(((r["entity_id"] or "").strip(), r["rule"]) for r in found) == sorted(expected)


def test_china(spark):
    doc = PAINTER | {"id": "realCharacter_chn_1853_001", "realSubType": 2}
    found = contract.character_issues(documents(spark, [doc, doc | {"id": "realCharacter_chn_1853_002", "countryCode": "CHN", "dynasty": 20, "field": 10}], contract.CHARACTER)).collect()
    assert sorted(r["rule"] for r in found) == ["china_country", "china_dynasty"]


def test_edges_copies_and_warnings(spark):
    author = PAINTER | {"id": "realCharacter_fra_1802_300", "beginCentury": 1802, "ownWork": [{"workId": NOVEL["workId"], "relationType": 2}, {"workId": "work_elsewhere", "relationType": 5}]}
    people, works = documents(spark, [author, author | {"position": 5, "gender": 9}], contract.CHARACTER), documents(spark, [NOVEL, NOVEL | {"workId": "work_fra_1831_205", "creators": [{"characterId": "nobody", "relationType": 1}]}], contract.WORK)
    found = sorted((r["entity_kind"], r["rule"]) for r in contract.issues(people, works).collect())
    assert found == [("character", "duplicate_id"), ("work", "creator_missing"), ("work", "edge_only_in_character"), ("work", "edge_only_in_work"), ("work", "edge_only_in_work")]
    assert sorted(r["entity_kind"] for r in contract.warnings(people, works).collect()) == ["character", "work", "work"]


def test_organisations_have_no_gender(spark):
    docs = [PAINTER | {"id": f"realCharacter_nld_1853_{i:03d}", "creativeEntityType": 2, "gender": g} for i, g in enumerate((0, 1))]
    assert [(r["entity_id"][-3:], r["rule"]) for r in contract.character_issues(documents(spark, docs, contract.CHARACTER)).collect()] == [("001", "organisation_gender")]


def test_empty_tables(spark):
    assert contract.issues(documents(spark, [], contract.CHARACTER), documents(spark, [], contract.WORK)).count() == 0


def test_phrases_of_the_contract(spark):
    texts = ["p" * 60 + x for x in ("", "见数据库", "便于后来分析", "第 3 号创作关系", "JSON", "支持历史研究", "人格", "人格标签")]
    docs = [PAINTER | {"id": f"realCharacter_nld_1853_{i:03d}", "introduction": t} for i, t in enumerate(texts)]
    found = {r["entity_id"][-1] for r in contract.character_issues(documents(spark, docs, contract.CHARACTER)).collect() if r["rule"] == "introduction_phrase"}
    assert found == {"1", "2", "3", "4", "5", "7"} and len(contract.FORBIDDEN) == 16


def test_creators_ids_are_stripped(spark):
    author = PAINTER | {"id": "realCharacter_fra_1802_300", "beginCentury": 1802}
    work = NOVEL | {"creators": [{"characterId": " realCharacter_fra_1802_300 ", "relationType": 1}, {"characterId": "realCharacter_fra_1802_300", "relationType": 1, "sortOrder": 1}]}
    found = {r["rule"] for r in contract.issues(documents(spark, [author], contract.CHARACTER), documents(spark, [work], contract.WORK)).collect()}
    assert "creator_missing" not in found and "creator_duplicate" in found


def test_long_lists_of_own_works(spark):
    import time

    from pyspark.sql import functions as F

    n = 60_000  # compared with one another these take minutes
    own = F.transform(F.sequence(F.lit(1), F.lit(n)), lambda i: F.struct(F.concat(F.lit("w"), F.greatest(i, F.lit(2)).cast("string")).alias("workId"), F.lit(1).alias("relationType")))
    people = documents(spark, [PAINTER], contract.CHARACTER).withColumn("ownWork", own)
    began = time.time()
    assert "own_work_duplicate" in {r["rule"] for r in contract.character_issues(people).collect()} and time.time() - began < 20
