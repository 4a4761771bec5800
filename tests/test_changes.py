"""Patches, deletes and enumerations on small stores."""

import pytest
from pyspark.sql import functions as F

from ambrel.operators import contract as C
from ambrel.operators import deletes as D
from ambrel.operators import enrichment as P
from ambrel.operators import enums as E
from ambrel.operators import importing as I
from ambrel.operators.runs import Change, Store
from ambrel.sources.scratch import keeper
from tests.test_contract import documents
from tests.test_importing import AUTHOR, TALE, load, new_store


def patch(spark, store, relations, people=(), works=()):
    rows = spark.createDataFrame([(i, *r) for i, r in enumerate(relations)], P.RELATION.replace("\n", ""))
    return documents(spark, list(people), C.CHARACTER), documents(spark, list(works), C.WORK), rows


def test_patch(spark, tmp_path):
    store = new_store(spark, tmp_path)
    load(spark, store, [AUTHOR], [TALE | {"originalName": "Roman"}])
    known, work = {"name": " Author", "countryCode": "FRA", "field": 2}, {"workName": "Roman ", "countryCode": "FRA", "genre": 1, "year": 1831}
    fresh = AUTHOR | {"id": "new one", "names": [{"language": 1, "name": "Fresh"}]}
    verse = TALE | {"workId": "new work", "workName": "Verse", "genre": 3, "subcategory": 3001, "subcategories": [3001]}
    run = P.apply_patch(store, "p", *patch(spark, store, [(known, work, 1, 4, False), ({"newId": "new one"}, work, 9, None, True), ({"newId": "new one"}, {"newId": "new work"}, 14, 1, None), (known, work, 1, 5, False)], [fresh], [verse]))
    assert run["result"] == {"newCharacters": 1, "newWorks": 1, "relations": 4}
    ids = {r["character_name"]: r["character_info_id"] for r in store.read("character_name").collect()}
    relations = sorted((r["relation_type"], r["sort_order"], r["character_id"] == ids["Fresh"]) for r in store.read("work_creator").collect())
    assert relations == [(1, 0, False), (1, 5, False), (9, 0, True), (14, 1, True)]  # the imported relation has an id of its own kind
    assert {r["work_name"]: r["auth_character_id"] for r in store.read("work").collect()} == {"A novel": ids["Fresh"], "Verse": None}
    people, works = P.snapshot(store.read)
    assert {r["names"][0]["name"] for r in people.collect()} == {"Author", "Fresh"}
    assert {r["workName"]: [x["sortOrder"] for x in r["creators"]] for r in works.collect()} == {"A novel": [0, 0, 5], "Verse": [1]}
    store.rollback(run["run"])
    assert store.read("work").count() == 1 and store.read("work_creator").count() == 1 and store.read("work").first()["auth_character_id"] == ids["Author"]


def test_refused_patch_writes_nothing(spark, tmp_path):
    store = new_store(spark, tmp_path)
    load(spark, store, [AUTHOR], [TALE])
    twin = store.read("character_name").withColumn("id", F.col("id") + 1).withColumn("character_info_id", F.lit(5).cast("long"))
    store.commit(lambda read: {
        "character_name": read("character_name").union(twin), "character": read("character").union(read("character").withColumn("id", F.lit(5).cast("long"))),
        "real_attribute": read("real_attribute").union(read("real_attribute").withColumns({"id": F.lit(6).cast("long"), "character_info_id": F.lit(5).cast("long")})),
    })
    before = store.snapshot()
    known, work = {"name": "Author", "countryCode": "FRA", "field": 2}, {"workName": "A novel", "countryCode": "FRA", "genre": 1, "year": 1831}
    cases = {
        "character_many": (known, work, 1, 0, False), "character_none": (known | {"field": 3}, work, 1, 0, False), "character_lacks_field": ({"name": "Author"}, work, 1, 0, False), "character_unknown_new": ({"newId": "x"}, work, 1, 0, False),
        "work_none": ({"newId": "n"}, work | {"year": None}, 1, 0, False), "work_lacks_field": ({"newId": "n"}, {"workName": "A novel"}, 1, 0, False), "work_unknown_new": ({"newId": "n"}, {"newId": "y"}, 1, 0, False),
        "relation_type": ({"newId": "n"}, work, 100, 0, False), "relation_genre": ({"newId": "n"}, work, 14, 0, False),
    }
    rows = patch(spark, store, [({"newId": "n"}, work, 1, 0, False), *cases.values()], [AUTHOR | {"id": "n"}])
    found = {r["problem"]: r["entity_id"] for r in P.problems(*rows, store.read).collect()}
    assert found == {problem: f"relation {i + 1}" for i, problem in enumerate(cases)}
    with pytest.raises(I.ImportRefused) as refused:
        P.apply_patch(store, "p", *patch(spark, store, [({"newId": "n"}, work, 1, 0, False), cases["character_many"]], [AUTHOR | {"id": "n"}, AUTHOR | {"id": " n"}, AUTHOR | {"id": None}, AUTHOR | {"id": "m", "countryCode": "XXX"}]))
    assert refused.value.counts == {"character_many": 1, "duplicate_id": 1, "missing_id": 1, "country_unknown": 1} and store.snapshot() == before


def test_patch_is_matched_once(spark, tmp_path, monkeypatch):
    store, calls, whole = new_store(spark, tmp_path), [], P.matched
    load(spark, store, [AUTHOR], [TALE])
    monkeypatch.setattr(P, "matched", lambda *a: calls.append(1) or whole(*a))
    known, work = {"name": "Author", "countryCode": "FRA", "field": 2}, {"workName": "A novel", "countryCode": "FRA", "genre": 1, "year": 1831}
    P.apply_patch(store, "p", *patch(spark, store, [(known, work, 9, 4, True)]))
    assert len(calls) == 1 and store.read("work_creator").count() == 2


def test_load_shuffles_no_table_for_a_small_change(spark, tmp_path):
    store, plans, write = Store(spark, str(tmp_path)), [], Change.applied
    store.commit(lambda read: {"t": spark.range(50).union(spark.createDataFrame([(None,)], "id long")).selectExpr("id", "'old' as v")})
    with pytest.MonkeyPatch.context() as m:
        m.setattr(Change, "applied", lambda *a: (plans.append(write(*a)), plans[-1])[1])
        store.load("x", {"t": Change(spark.range(49, 52).selectExpr("id", "'new' as v"), "id")})
    plan = plans[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" in plan and plan.count("FullOuter") == 1
    got = {(r["id"], r["v"]) for r in store.read("t").collect()}
    assert got == {(i, "old") for i in range(49)} | {(i, "new") for i in (49, 50, 51)} | {(None, "old")}  # a row without key stays as it was


REFERENCES = [("b", "a_id", "a"), ("c", "b_id", "b"), ("c", "a_id", "a"), ("b", "b_id", "b"), ("d", "x", "other")]


def small_store(spark, path):
    store = Store(spark, str(path))
    make = lambda rows, names: spark.createDataFrame(rows, ", ".join(f"{n} long" for n in names.split()))
    store.commit(lambda read: {
        "a": make([(1,), (2,), (3,)], "id"), "b": make([(10, 1, None), (11, None, 10), (12, None, 11), (13, 2, None), (14, 3, 14)], "id a_id b_id"), "c": make([(20, 12, None), (21, 13, None), (22, None, 1), (23, None, None)], "id b_id a_id"), "d": make([(30, 1)], "id x"),
    })
    return store


def ids(store, *tables):
    return [sorted(r["id"] for r in store.read(t).collect()) for t in tables]


def test_cascade(spark, tmp_path):
    store, one = small_store(spark, tmp_path), spark.createDataFrame([(1,), (77,)], "id long")
    dry = D.cascade(store, "a", one, REFERENCES, keeper(spark))
    assert dry == {"dryRun": True, "rows": {"c": 2, "b": 3, "a": 1}} and list(dry["rows"]) == ["c", "b", "a"] and store.snapshot()[0] == 1
    done = D.cascade(store, "a", one, REFERENCES, keeper(spark), execute=True)
    assert done["rows"] == dry["rows"] and ids(store, "a", "b", "c", "d") == [[2, 3], [13, 14], [21, 23], [30]]
    store.rollback(done["run"])
    assert ids(store, "a", "b", "c") == [[1, 2, 3], [10, 11, 12, 13, 14], [20, 21, 22, 23]]
    assert D.cascade(store, "a", one.limit(0), REFERENCES, keeper(spark))["rows"] == {"c": 0, "b": 0, "a": 0}


def test_delete_takes_what_the_dry_run_found(spark, tmp_path, monkeypatch):
    store, one, calls, find = small_store(spark, tmp_path), spark.createDataFrame([(1,)], "id long"), [], D.doomed
    monkeypatch.setattr(D, "doomed", lambda *a: calls.append(1) or find(*a))
    stale, known = {}, {}
    D.cascade(store, "a", one, REFERENCES, keeper(spark), known=stale)
    store.commit(lambda read: {"c": read("c").union(spark.createDataFrame([(24, None, 1)], "id long, b_id long, a_id long"))})
    assert D.cascade(store, "a", one, REFERENCES, keeper(spark), known=known)["rows"] == {"c": 3, "b": 3, "a": 1} and len(calls) == 2
    former = store.snapshot()[1]
    done = D.cascade(store, "a", one, REFERENCES, keeper(spark), execute=True, known=known)
    assert done["rows"] == {"c": 3, "b": 3, "a": 1} and len(calls) == 2 and ids(store, "a", "b", "c") == [[2, 3], [13, 14], [21, 23]]
    # the tables' folders are put back as they were; of a table that was changed since, the rows
    store.commit(lambda read: {"b": read("b").union(spark.createDataFrame([(15, 2, None)], "id long, a_id long, b_id long"))})
    store.rollback(done["run"])
    now = store.snapshot()[1]
    assert {t: now[t]["folder"] == former[t]["folder"] for t in "abcd"} == {"a": True, "b": False, "c": True, "d": True}
    assert ids(store, "a", "b", "c") == [[1, 2, 3], [10, 11, 12, 13, 14, 15], [20, 21, 22, 23, 24]]
    again = D.cascade(store, "a", one, REFERENCES, keeper(spark), execute=True, known=stale)
    assert again["rows"] == {"c": 3, "b": 3, "a": 1} and len(calls) == 3  # tables were changed, so what is known is of no use
    store.vacuum()
    store.rollback(again["run"])  # the former folders are gone, the before-image is not
    assert ids(store, "a", "b", "c") == [[1, 2, 3], [10, 11, 12, 13, 14, 15], [20, 21, 22, 23, 24]]


def test_keep_only_orphans_and_clear(spark, tmp_path):
    store, kept = small_store(spark, tmp_path), spark.createDataFrame([(2,)], "id long")
    assert D.keep_only(store, "a", kept, REFERENCES, keeper(spark), F.col("id") < 3)["rows"] == {"c": 2, "b": 3, "a": 1}
    D.keep_only(store, "a", kept, REFERENCES, keeper(spark), execute=True)
    assert ids(store, "a", "b", "c") == [[2], [13], [21, 23]]
    D.cascade(store, "c", spark.createDataFrame([(21,)], "id long"), REFERENCES, keeper(spark), execute=True)
    assert D.without_children(store, "b", REFERENCES, keeper(spark), execute=True)["rows"] == {"c": 0, "b": 1}
    dry = D.clear_tables(store, {"a"}, REFERENCES, {"d"})
    assert dry == {"dryRun": True, "tables": ["c", "b", "a"], "rows": {"c": 1, "b": 0, "a": 1}, "totalRows": 2}
    done = D.clear_tables(store, {"a", "other"} - {"other"}, REFERENCES, {"d"}, execute=True)
    assert done["remainingRows"] == 0 and done["preserved"] == {"d": 1} and ids(store, "d") == [[30]]
    store.rollback(done["run"])
    assert ids(store, "a", "c") == [[2], [23]]


def test_levels():
    assert D.levels({"a", "b", "c"}, REFERENCES) == [["a"], ["b"], ["c"]]
    assert D.referring(REFERENCES, {"other"}, {"d"}) == {"other"} and D.referring(REFERENCES, {"b"}) == {"b", "c"}
    with pytest.raises(ValueError, match="circle: x, y"):
        D.levels({"x", "y"}, [("x", "k", "y"), ("y", "k", "x")])


CODE = """public enum RelationEnum { A(1, "author"), B_2(2, "x"), C(99, "other"); private final int key;
boolean valid(int genre) { boolean valid = switch (relation) { case A, C -> true; case B_2 -> genre == 3 || genre == 4; }; } }
enum TagEnum { T1(1001, 1, "t"), T2(3001 , 3 ,"u"); private final int key; }"""
PROMPT = "## 6. x\n- `5`\n## 7. Relations\n- `1` author\n- `2` x\n text `3`\n- `99`\n## 8. Tags `1001` and `3001` or `77777`"


def test_enumerations(spark):
    code, prompt, t = spark.createDataFrame([(CODE,)], "t string"), spark.createDataFrame([(PROMPT,)], "t string"), F.col("t")
    expected = spark.createDataFrame([("relation", c) for c in ("1", "2", "99")] + [("tag", "1001:1"), ("tag", "3001:3")] + [("genre", x) for x in ("1:3", "1:4", "2:3", "2:4", "99:3", "99:4")], "enum string, code string")
    every = spark.createDataFrame([(3,), (4,)], "value int")
    relation = E.constants(t, "RelationEnum")
    found = [
        E.rows(code, "code", "relation", F.transform(relation, lambda x: x["code"])), E.rows(code, "code", "tag", F.transform(E.constants(t, "TagEnum"), lambda x: F.concat_ws(":", x["code"], x["second"]))),
        E.pairs(code, "code", "genre", relation, E.cases(t, "boolean valid = switch (relation)", "genre"), every), E.rows(prompt, "prompt", "relation", E.listed(t, "## 7.", "## 8.")),
        E.rows(spark.createDataFrame([(1,), (2,), (1,), (None,)], "r int"), "table", "relation", F.array("r")),
    ]
    equal = ["code/relation", "code/tag", "code/genre", "prompt/relation"]
    assert E.faults(expected, found, equal, ["table"]).collect() == []
    found[3] = E.rows(prompt, "prompt", "relation", E.listed(t, "## 6.", "## 7."))
    found[4] = E.rows(spark.createDataFrame([(7,)], "r int"), "table", "relation", F.array("r"))
    rows = sorted(tuple(r) for r in E.faults(expected, found, equal, ["table"]).collect())
    assert rows == [("relation", "1", "prompt", "missing"), ("relation", "2", "prompt", "missing"), ("relation", "5", "prompt", "unknown"), ("relation", "7", "table", "unknown"), ("relation", "99", "prompt", "missing")]
    assert sorted(r["code"] for r in E.rows(prompt, "prompt", "tag", E.quoted(t, 4, 5)).collect()) == ["1001", "3001", "77777"]
    lost = E.faults(expected, [E.rows(code, "code", "relation", E.listed(t, "## 70.", "## 8."))], ["code/relation"])
    assert {r["fault"] for r in lost.collect()} == {"missing"} and lost.count() == 3
