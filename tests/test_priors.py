"""Projections, priors, attempts and synchronisation against plain Python."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ambrel.operators import evaluation as E
from ambrel.operators import projection as P
from ambrel.operators import resume as U
from ambrel.operators import sync as Y


def test_terms_in_one_pass(spark):
    r = random.Random(1)
    terms = ["".join(r.choice("abc") for _ in range(r.randint(1, 5))) for _ in range(1500)] + ["", "日本", "a"]
    texts = ["".join(r.choice("abcd") for _ in range(n)) for n in (0, 1, 5, 40, 300)] + ["x日本y", None, "A" * 50]
    rows = P.found_terms(spark.createDataFrame(list(enumerate(texts)), "id int, t string"), ["id"], "t", terms).collect()
    assert {r["id"]: r["found"] for r in rows} == {i: [k for k, x in enumerate(terms) if t is not None and x in t] for i, t in enumerate(texts)}
    assert all(r["found"] == [] for r in P.found_terms(spark.createDataFrame([(1, "a")], "id int, t string"), ["id"], "t", []).collect())
    with pytest.raises(ValueError, match="bytes"):
        P.found_terms(spark.createDataFrame([(1, "a")], "id int, t string"), ["id"], "t", ["x" * (P.TERM_BYTES + 1)])


def test_projection(spark):
    model = P.Model({"A": ["p", "-q"], "B": ["q"], "C": ["none"]}, {"A": ["war", "peace", "sea"]}, [("A", ["sun", "war"], 0.045, 0.06), ("B", ["war", "sea"], -0.05, 0.2)], {"GAME": {"A": 0.03}})
    texts = spark.createDataFrame([(1, "GAME", "war and sun"), (2, "TV", "war peace sea"), (3, None, None)], "id int, kind string, text string")
    leaves = spark.createDataFrame([(1, "p", 0.5), (1, "q", 0.25), (2, "q", None), (2, "p", 1.0), (1, "unused", 0.9)], "id int, path string, value double")
    raw = {(r["id"], r["trait"]): r["raw"] for r in P.raw_traits(texts, leaves, model).collect()}
    expected = {
        (1, "A"): 0.48 * (0.5 + 0.75) / 2 + 0.52 * 0.5 + 0.06 + 0.03, (1, "B"): 0.25 - 0.05, (1, "C"): 0.5, (2, "A"): 0.48 * 1.0 + 0.52 + 0.045, (2, "B"): 0.5 - 0.1, (2, "C"): 0.5,
        (3, "A"): 0.24, (3, "B"): 0.5, (3, "C"): 0.5,
    }
    assert raw == pytest.approx(expected)
    scores = {(r["id"], r["trait"]): r["score"] for r in P.calibrated_traits(P.raw_traits(texts, leaves, model)).collect()}
    for trait in "ABC":
        values = [expected[i, trait] for i in (1, 2, 3)]
        mean = sum(values) / 3
        sd = max(math.sqrt(sum((v - mean) ** 2 for v in values) / 3), 0.025)
        assert [scores[i, trait] for i in (1, 2, 3)] == [round(0.1 + 0.8 / (1 + math.exp(-(v - mean) / (sd * 1.15))), 2) for v in values]
    assert P.raw_traits(texts.limit(0), leaves, model).count() == 0


def test_projection_checked_and_replaced(spark):
    scores = spark.createDataFrame([(1, "A", 0.5), (1, "B", 1.5), (2, "A", 0.1), (2, "A", 0.2), (3, "A", 0.1), (3, "B", None), (3, "X", 0.3)], "id int, trait string, score double")
    found = sorted((r["id"], r["issue"], r["detail"]) for r in P.issues(scores, ["B", "A"], spark.createDataFrame([(1,), (2,)], "id int")).collect())
    assert found == [(1, "score", "B"), (2, "trait_missing", "B"), (2, "trait_twice", None), (3, "not_current", None), (3, "score", "B"), (3, "trait_unknown", "X")]
    old = spark.createDataFrame([(1, 1, "A", 0.9, 0.1, "m", "v1"), (1, 2, "Z", 0.9, 0.1, "m", "v1"), (9, 1, "A", 0.9, 0.1, "m", "v1")], "id int, system int, trait string, score double, confidence double, model string, version string")
    rows = P.replaced(old, scores.where("id = 1"), {"A": 1, "B": 4}, 0.82, "work", "v2").collect()
    assert sorted((r["id"], r["system"], r["trait"], r["version"]) for r in rows) == [(1, 1, "A", "v2"), (1, 2, "Z", "v1"), (1, 4, "B", "v2"), (9, 1, "A", "v1")]


def test_letters(spark):
    rows = [(1, 2, "intj", 3), (1, -1, "EI", 5), (1, 1, None, 4), (1, 1, "II", 2), (2, 5, "P", -7), (2, None, "P", 7), (3, 1, "?!", 1)]
    got = {r["w"]: (r["weights"], r["evidence"]) for r in E.letter_weights(spark.createDataFrame(rows, "w int, a int, l string, n int"), "w", "a", "l", "n").collect()}
    expected = {}
    for w, a, letters, n in rows:
        sums, evidence = expected.get(w, ([0.0] * 8, 0.0))
        for x in (letters or "").upper():
            if x in E.LETTERS:
                sums[E.LETTERS.index(x)] += (a or 0) * max(0, n)
        expected[w] = (sums, evidence + max(0, n))
    assert got == expected

    def history(weights, letters):
        leads = [weights[i] - weights[i + 1 if i % 2 == 0 else i - 1] for i in (E.LETTERS.find(x) for x in letters.upper()) if i >= 0]
        return 1 / (1 + math.exp(-(sum(leads) * 0.002 + math.log({4: 3.0, 3: 1.8, 2: 1.2, 1: 0.5}.get(sum(x > 0 for x in leads), 0.25)))))

    def axis(work, letters):
        if len(work) != 8 or len(letters or "") != 4:
            return 0.5
        ni, te, fi, se, ti, ne, si, fe = work
        axes = ((ni + si + ti + fi, ne + se + te + fe), (ni + ne, si + se), (ti + te, fi + fe), (ni + si + te + fe, ne + se + ti + fi))
        shares = [0.5 if a + b <= 0 else a / (a + b) for a, b in axes]
        return sum(s if x == first else 1 - s for s, x, first in zip(shares, letters.upper(), "INTJ")) / 4

    r = random.Random(3)
    cases = [([r.randint(-400, 400) / 1.0 for _ in range(8)], x) for x in ("INTJ", "esfp", "ENTP", "I?TJ", "") for _ in range(6)]
    df = spark.createDataFrame([(i, w, x) for i, (w, x) in enumerate(cases)], "i int, w array<double>, x string").select("i", E.history_affinity(F.col("w"), F.col("x")).alias("h"))
    assert {r["i"]: r["h"] for r in df.collect()} == pytest.approx({i: history(w, x) for i, (w, x) in enumerate(cases)})
    cases = [([r.random() for _ in range(8)], x) for x in ("INTJ", "ESFP", "enfj", "abc", None)] + [([0.0] * 8, "ISTP"), ([0.5] * 7, "INTJ")]
    df = spark.createDataFrame([(i, w, x) for i, (w, x) in enumerate(cases)], "i int, w array<double>, x string").select("i", E.axis_affinity(F.col("w"), F.col("x")).alias("a"))
    assert {r["i"]: r["a"] for r in df.collect()} == pytest.approx({i: axis(w, x) for i, (w, x) in enumerate(cases)})
    one = spark.range(1).select(E.audience_aware(F.lit(0.4), F.lit(0.8), F.lit(2.0)).alias("a"), E.evidence_confidence(F.lit(5.0)).alias("e"), E.evidence_confidence(F.lit(-1.0)).alias("z")).first()
    assert tuple(one) == pytest.approx((0.4 * 0.75 + 0.8 * 0.25, 0.2, 0.0))


def test_attempts(spark):
    r = random.Random(2)
    outcomes = [(s, 100 * s + i, i, r.random() < 0.5) for s in range(6) for i in range(30)] + [(9, 900, 0, None)]
    expected = []
    for s in range(10):
        failures = 0
        for row in outcomes:
            if row[0] == s and failures < 3:
                expected.append(row[1])
                failures = 0 if row[3] else failures + 1
    df = spark.createDataFrame(outcomes, "set int, id int, position int, ok boolean")
    assert sorted(x["id"] for x in U.until_stopped(df).collect()) == sorted(expected)
    good = {row[1] for row in outcomes if row[3]}

    def attempt(row):
        if row["id"] not in good:
            raise KeyError(row["id"])
        return {"result": f"did {row['id']}"}

    items = df.drop("ok")
    ran = U.attempted(items, attempt).collect()
    assert sorted(x["id"] for x in ran) == sorted(expected) and all(x["ok"] == (x["id"] in good) and (x["error"] or "").startswith("" if x["ok"] else "KeyError") for x in ran)
    done = spark.createDataFrame([(x["id"],) for x in ran if x["ok"]], "id int")
    left = [row for row in outcomes if row[1] not in {x["id"] for x in ran if x["ok"]}]
    assert sorted(x["id"] for x in U.remaining(items, done).collect()) == sorted(row[1] for row in left)
    assert sorted(x["id"] for x in U.remaining(items, done, 2).collect()) == sorted(i for s in range(10) for i in [row[1] for row in left if row[0] == s][:2])
    for x in U.progress(items, done).collect():
        own = [row for row in outcomes if row[0] == x["set"]]
        isdone = [row[1] not in {y[1] for y in left} for row in own]
        at = [row[1] for row in own].index(x["id"])
        after = [row[1] for row, d in zip(own[at + 1 :], isdone[at + 1 :]) if not d]
        assert (x["processed"], x["remaining"], x["next_id"]) == (sum(isdone[: at + 1]), len(own) - sum(isdone[: at + 1]), after[0] if after else None)
    told = {x["set"]: x for x in U.told(items, spark.createDataFrame(ran, "set int, id int, position int, result string, ok boolean, error string"), done).collect()}
    assert told[9]["status"] == "in_progress" and told[9]["failed"] == 1 and sum(x["generated"] for x in told.values()) == done.count()
    assert U.attempted(items.limit(0), attempt).count() == 0


def test_sync(spark):
    facts = spark.createDataFrame([(1, "a", 0.5), (1, "b", None), (1, "old", 0.1), (2, "a", 0.3), (2, "x", 0.9)], "id int, path string, score double")
    vectors = spark.createDataFrame([(1, "a", 0.5), (1, "b", 0.2), (2, "a", None), (3, "a", 0.1)], "id int, path string, value double")
    feed = sorted(tuple(r) for r in Y.changes(facts, vectors, ["id", "path"], "score", "value").collect())
    assert feed == [(1, "b", None, 0.2), (2, "a", 0.3, None)]
    after = Y.applied(facts, vectors, ["id", "path"], "score", "value")
    assert Y.changes(after, vectors, ["id", "path"], "score", "value").count() == 0 and after.count() == 5
    counts, links = spark.createDataFrame([(1, "a", 9), (1, "b", 0), (2, "a", None)], "id int, path string, n int"), facts.union(facts.where("path = 'a'"))
    assert sorted(r["path"] for r in Y.miscounted(counts, links, ["id", "path"], "n").collect()) == ["a", "a", "b"]
    fixed = Y.recounted(counts, links, ["id", "path"], "n")
    assert sorted(tuple(r) for r in fixed.collect()) == [(1, "a", 2), (1, "b", 1), (2, "a", 2)] and Y.miscounted(fixed, links, ["id", "path"], "n").count() == 0
    out, missing = Y.renamed_paths(facts, "old", "a.new", links.select("id", F.lit("a.new").alias("path")).where("id = 2"), ["id"])
    assert [tuple(r) for r in missing.collect()] == [(1, "a.new")] and out.where("path = 'old'").count() == 0
    named = Y.catalogue_names(spark.createDataFrame([("p.g.love", "p.g", "v1"), ("p.g.odd", "p.h", "v1")], "code string, group_code string, version string"), spark.createDataFrame([("p.g.love", "爱"), ("p.g", "组")], "code string, name string"), ": one")
    rows = {r["code"]: (r["name_local"], r["name_en"], r["description"], r["version"]) for r in named.collect()}
    assert rows == {"p.g.love": ("爱", "love", "组: one", "v1"), "p.g.odd": ("odd", "odd", "p.h: one", "v1")} and [r["code"] for r in Y.untranslated(named).collect()] == ["p.g.odd"]


def test_progress_of_large_sets_in_stretches(spark):
    items = spark.range(3000).selectExpr("if(id % 3 = 2, null, id % 3) as set", "id", "(id * 7919) % 3001 as position").repartition(8)
    done = spark.range(0, 3000, 4).union(spark.range(2000, 3000)).distinct()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that few rows are dealt over tasks too
    try:
        rows = U.progress(items, done)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert "1, unboundedfollowing" not in rows._jdf.queryExecution().toString().lower()
    at = {r["id"]: r for r in rows.collect()}
    for s in (0, 1, 2):
        ids = sorted(range(s, 3000, 3), key=lambda i: (i * 7919) % 3001)
        is_done = [i % 4 == 0 or i >= 2000 for i in ids]
        k, coming = sum(is_done), None
        for i, d in zip(reversed(ids), reversed(is_done)):
            assert tuple(at[i][x] for x in ("is_done", "processed", "remaining", "next_id")) == (d, k, 1000 - k, coming)
            k, coming = k - d, coming if d else i
