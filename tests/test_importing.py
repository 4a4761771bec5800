"""Imports of documents into a store: what they load, refuse, survive and undo."""

import json
import threading

import pytest
from pyspark.sql import functions as F

from ambrel.operators import contract
from ambrel.operators import importing as I
from ambrel.operators.runs import Change, Store
from tests.test_contract import NOVEL, PAINTER, documents

AUTHOR = PAINTER | {"id": "realCharacter_fra_1802_300", "beginCentury": 1802, "endCentury": 1885, "countryCode": "FRA", "names": [{"language": 1, "name": "Author"}], "ownWork": [{"workId": NOVEL["workId"], "relationType": 1}]}
TALE = NOVEL | {"countryCode": "FRA", "subcategories": [1002, 1003], "primaryAuthorId": AUTHOR["id"]}


def new_store(spark, path):
    store = Store(spark, str(path))
    I.create(store, spark.createDataFrame([(1, "FRA"), (2, "nld")], I.COUNTRY))
    return store


def load(spark, store, people, works, name="x"):
    return I.import_batch(store, name, documents(spark, people, contract.CHARACTER), documents(spark, works, contract.WORK))


def told(df):
    return {(r["kind"], r["name"]): r["n"] for r in df.collect()}


def test_import_status_and_rollback(spark, tmp_path):
    store = new_store(spark, tmp_path)
    run = load(spark, store, [AUTHOR], [TALE])
    assert run["result"] == {"characters": 1, "works": 1, "crossBatchRelations": 0, "relations": 1, "subcategoryTags": 2}
    status = told(I.run_status(store, run["run"]))
    assert status[("passed", run["run"])] == 1 and status[("rows", "work_subcategory")] == 2 and len(status) == 6 * 2 + 17 + 1
    work = store.read("work").first()
    assert (work["work_name"], work["country_id"], work["auth_character_id"]) == ("A novel", 1, store.read("character").first()["id"])
    # a second batch: a translator of the old work, and the work's document with other creators and tags
    other = AUTHOR | {"id": "realCharacter_nld_1853_001", "beginCentury": 1853, "names": [{"language": 1, "name": "Other"}], "ownWork": [{"workId": NOVEL["workId"], "relationType": 99}], "countryCode": "NLD"}
    second = load(spark, store, [other], [])
    assert second["result"]["crossBatchRelations"] == 1
    assert sorted((r["relation_type"], r["sort_order"]) for r in store.read("work_creator").collect()) == [(1, 0), (99, 1)]
    with pytest.raises(ValueError, match="later runs"):
        load(spark, store, [AUTHOR], [TALE | {"subcategories": [1002]}], "third") and store.rollback(run["run"])
    third = store.latest()
    assert store.read("work_subcategory").count() == 1 and store.read("work_creator").count() == 1
    store.rollback(third)
    store.rollback(second["run"])
    assert store.rollback(run["run"])["status"] == "rolled_back"
    assert all(store.read(t).count() == 0 for t in I.TABLES)
    assert told(I.run_status(store, run["run"]))[("passed", run["run"])] == 0
    assert store.vacuum() and all(store.read(t).count() == 0 for t in I.TABLES)


def test_refused_imports_write_nothing(spark, tmp_path):
    store = new_store(spark, tmp_path)
    load(spark, store, [AUTHOR], [TALE | {"originalName": " Roman "}])
    before = store.snapshot()
    person = lambda n, **more: AUTHOR | {"id": f"realCharacter_fra_1802_{n}", "names": [{"language": 1, "name": f"N{n}"}], "ownWork": [], "position": n} | more
    people = [
        person(400, gender=9), person(401, names=[{"language": 1, "name": " Author "}]), person(402, countryCode="XYZ"), person(403, ownWork=[{"workId": "work_fra_1_000", "relationType": 1}]),
        person(404, ownWork=[{"workId": NOVEL["workId"], "relationType": 17}]), person(405, names=[{"language": 3, "name": "Author"}]), person(406),
    ]
    works = [NOVEL | {"workId": "work_fra_1831_999", "originalName": "Roman", "countryCode": "FRA", "creators": [{"characterId": people[6]["id"], "relationType": 1}]}]
    people[6]["ownWork"] = [{"workId": works[0]["workId"], "relationType": 1}]
    with pytest.raises(I.ImportRefused) as refused:
        load(spark, store, people, works)
    assert refused.value.counts == {"gender": 1, "natural_key": 2, "country_unknown": 1, "work_unknown": 1, "relation_genre": 1}
    assert {e[1][-3:] for e in refused.value.examples} == {"400", "401", "402", "403", "404", "999"} and store.snapshot() == before
    (failed,) = [m for m in (store.manifest(r.name) for r in (tmp_path / "_runs").iterdir() if r.is_dir()) if m["status"] == "failed"]
    assert "natural_key 2" in failed["error"]


def test_deleted_rows_hold_no_natural_key(spark, tmp_path):
    store = new_store(spark, tmp_path)
    load(spark, store, [AUTHOR], [TALE])
    gone = store.read("character_name").withColumn("deleted", F.lit(1))
    store.write("character_name", gone)
    assert store.read("character_name", deleted=False).count() == 0
    load(spark, store, [AUTHOR | {"id": "realCharacter_fra_1802_301", "ownWork": []}], [])
    assert store.read("character_name", deleted=False).count() == 1


def test_two_loads_at_once_lose_none(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    rows = lambda a, b: spark.range(a, b).select("id", F.lit("new").alias("v"))
    store.commit(lambda read: {"t": rows(0, 3), "u": rows(0, 3)})
    failed, meet = [], threading.Barrier(4)

    def one(i):
        try:
            first = True

            def changes(read):
                nonlocal first
                read("t")
                if first:  # all have read the tables before any commits
                    first = False
                    meet.wait(60)
                return {"t" if i % 2 else "u": Change(rows(10 * i, 10 * i + 5), "id")}

            Store(spark, str(tmp_path)).load(f"r{i}", changes)
        except Exception as error:
            failed.append(error)

    threads = [threading.Thread(target=one, args=(i,)) for i in range(1, 5)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert not failed and store.snapshot()[0] == 5
    assert store.read("t").count() == 13 and store.read("u").count() == 13


def test_retry_from_what_was_kept(spark, tmp_path, monkeypatch):
    from ambrel.operators import runs

    store, row = Store(spark, str(tmp_path)), lambda v: spark.createDataFrame([(1, v)], "id int, name string")
    store.commit(lambda read: {"t": row("a"), "u": row("a")})
    with monkeypatch.context() as m, pytest.raises(OSError, match="gone"):
        m.setattr(runs, "put_new", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        store.load("x", {"t": Change(row("b"), "id"), "u": Change(row("c"), "id")})
    (run,) = [p.name for p in (tmp_path / "_runs").iterdir() if p.is_dir()]
    assert store.manifest(run)["status"] == "failed" and store.read("t").first()["name"] == "a"
    assert store.retry(run)["parent"] == run and [store.read(t).first()["name"] for t in "tu"] == ["b", "c"]
    with pytest.raises(ValueError, match="no table v"):
        store.load("y", {"t": Change(row("d"), "id"), "v": Change(row("d"), "id")})
    (other,) = [p.name for p in (tmp_path / "_runs").iterdir() if p.name.startswith("y")]
    with pytest.raises(ValueError, match="not there: no table"):
        store.retry(other)


def test_put_new_never_replaces(spark, tmp_path):
    from ambrel.operators import runs

    assert runs.put_new(spark, f"{tmp_path}/a.json", {"x": 1}) and not runs.put_new(spark, f"{tmp_path}/a.json", {"x": 2})
    assert json.loads((tmp_path / "a.json").read_text()) == {"x": 1} and runs.names_in(spark, str(tmp_path)) == ["a.json"]


def test_documents_are_computed_once(spark, tmp_path):
    store, seen = new_store(spark, tmp_path), spark.sparkContext.accumulator(0)
    count = F.udf(lambda x: (seen.add(1), x)[1], "string").asNondeterministic()
    people, works = documents(spark, [AUTHOR], contract.CHARACTER), documents(spark, [TALE], contract.WORK)
    I.import_batch(store, "x", people.withColumn("introduction", count("introduction")), works.withColumn("introduction", count("introduction")))
    assert seen.value == 2 and store.read("work").count() == 1
