"""Every query of the catalogue against its SQL in DuckDB."""

import pytest

from ambrel.plans import catalogue, changes, entities, imports, nesting, priors  # noqa: F401  (the others add their queries to the catalogue)
from tests.oracle import DATA, differences


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_same_as_sql(spark, name):
    assert differences(spark, f"{DATA}/sf0.001", catalogue.QUERIES[name], catalogue.SQL[name]) == ""


def test_auc_against_all_pairs(spark):
    from pyspark.sql import functions as F

    from ambrel.operators.evaluation import group_auc

    rows = [(g, (i * 7 + g) % 5, i % 3 == 0) for g in range(3) for i in range(40)]
    got = {r["g"]: (r["pairs"], r["wins"]) for r in group_auc(spark.createDataFrame(rows, "g int, s int, y boolean"), "g", "s", F.col("y")).collect()}
    for g in range(3):
        pos, neg = ([s for h, s, y in rows if h == g and y == v] for v in (True, False))
        assert got[g] == (len(pos) * len(neg), sum((p > n) + (p == n) / 2 for p in pos for n in neg))


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() == 3
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_scaffold_grid_of_many_segments(spark, tmp_path):
    spark.createDataFrame([(i, 0, f"s{i}") for i in range(1200)], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    spark.createDataFrame([(0, 0)], "n_nationkey int, n_regionkey int").write.parquet(f"{tmp_path}/nation.parquet")
    spark.createDataFrame([(0, "here"), (1, "there")], "r_regionkey int, r_name string").write.parquet(f"{tmp_path}/region.parquet")
    rows = catalogue.QUERIES["scaffold_grid"](spark, str(tmp_path)).collect()
    assert {tuple(r) for r in rows} == {(n, f"s{i}", int(n == "here")) for n in ("here", "there") for i in range(1200)}


def test_remapped_keys(spark):
    from ambrel.operators.relational import remapped

    rows, mapping = spark.createDataFrame([(1,), (2,), (None,)], "k long"), spark.createDataFrame([(1, 10)], "old long, new long")
    assert {tuple(r) for r in remapped(rows, mapping, "k", "n").collect()} == {(1, 10, "resolved"), (2, 2, "pending"), (None, None, "pending")}
    with pytest.raises(Exception, match="no new k for"):
        remapped(rows, mapping, "k", "n", strict=True).collect()
    assert remapped(rows.limit(0), mapping, "k", "n", strict=True).count() == 0


def test_distinct_stream_loses_no_row_of_any_batch(spark, tmp_path):
    from ambrel.streaming import events

    batches = [[(1, "2024-03-01"), (1, None), (9, None)], [(2, None), (3, "2024-01-01"), (4, "2024-03-02"), (1, "2024-03-05")], [(5, "1969-05-01"), (None, None), (3, "2030-01-01"), (None, "2024-01-01"), (9, None)]]
    for rows in batches:
        spark.createDataFrame(rows, "id long, ts string").selectExpr("id", "cast(ts as timestamp) as ts").write.mode("append").parquet(f"{tmp_path}/in")
        stream = events.files(spark, f"{tmp_path}/in", spark.read.parquet(f"{tmp_path}/in").schema, per_batch=1)
        events.append_available(events.distinct(stream.select("id"), ["id"]), f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    assert sorted(str(r["id"]) for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["1", "2", "3", "4", "5", "9", "None"]


def test_set_differences_in_one_shuffle(spark):
    from ambrel.operators.relational import set_differences

    rows = lambda *ks: spark.createDataFrame([(k, 0) for k in ks], "a int, b int")
    found = set_differences(rows(1, 1, 2, None), rows(2, 2, 3, 4, None))
    assert tuple(found.first()) == (1, 2, 2)
    assert found._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") <= 4  # by row and over all, in part and whole


def test_components_send_no_labels_to_the_driver(spark):
    from ambrel.operators.names import components
    from ambrel.sources.scratch import keeper

    plans, keep = [], keeper(spark)
    links = spark.createDataFrame([(1, 2), (2, 3), (5, 6)], "a long, b long")
    found = components(links, lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or keep(df))
    assert {tuple(r) for r in found.collect()} == {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)}
    assert any("SortMergeJoin" in p for p in plans) and not any("Broadcast" in p for p in plans)
