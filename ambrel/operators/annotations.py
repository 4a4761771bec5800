"""Annotation profiles: scores as rows, their contract, sparse profiles over a catalogue, evidence.

An item is a row with ``id``, ``experience`` (map of key to score), ``psychology`` (map of group to such a map), ``media``
(map of one kind to such a map), ``evidence`` (array of texts) and ``mappings`` (array of struct<code, indexes, relation,
weight, explanation>). A dimension's code is its path: experience.k, psychology.g.k, media.m.k. The dimensions that must
be there are a table with a column ``code``, so no list is fixed here. Null is no score, never zero.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAPPINGS = "array<struct<code:string,indexes:array<int>,relation:int,weight:double,explanation:string>>"


def is_score(c: Column) -> Column:
    """A number in [0, 1] of two decimals at most."""
    return F.coalesce(c.between(0, 1) & ~F.isnan(c) & (F.round(c, 2) == c), F.lit(False))


def dimensions(items: DataFrame) -> DataFrame:
    """id, code and score of every dimension of an item; repeated rows stay."""
    path = lambda *parts: F.concat_ws(".", *parts)
    flat = items.select("id", F.explode("experience").alias("k", "score")).select("id", path(F.lit("experience"), "k").alias("code"), "score")
    for name in ("psychology", "media"):
        groups = items.select("id", F.explode(name).alias("g", "m")).select("id", "g", F.explode("m").alias("k", "score"))
        flat = flat.union(groups.select("id", path(F.lit(name), "g", "k").alias("code"), "score"))
    return flat


def _mapped(items: DataFrame) -> DataFrame:
    return items.select("id", F.size(F.coalesce("evidence", F.array().cast("array<string>"))).alias("n"), F.posexplode(F.col("mappings").cast(MAPPINGS)).alias("at", "m")).select("id", "n", "at", "m.*")


def issues(items: DataFrame, required: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(id, rule, detail), a row for each fault: nothing stops at the first.

    Faults of one item come from one pass, those between its parts from joins on (id, code). A null id is a fault of its
    own; ids that ``expected`` (a table with ``id``) has and the items lack, or the reverse, are faults too.
    """
    blank = lambda c: F.trim(F.coalesce(c, F.lit(""))) == ""
    rule = lambda cond, name: F.when(F.coalesce(cond, F.lit(False)), F.lit(name))
    none = F.lit(None).cast("string").alias("detail")
    of = lambda df, *rules, detail=none: df.select("id", F.explode(F.array_compact(F.array(*rules))).alias("rule"), detail)
    size = lambda c: F.coalesce(F.size(c), F.lit(0))
    found = of(items, rule(F.col("id").isNull(), "id"), rule(F.col("media").isNull() | (F.size("media") != 1), "media_kinds"), rule(F.col("evidence").isNull() | (size("evidence") < 1) | F.exists("evidence", blank), "evidence"), rule(F.col("mappings").isNull(), "mappings"))
    twice = items.where("id is not null").groupBy("id").count().where("count > 1")
    found = found.union(of(twice, F.lit("duplicate_id")))
    code, scores = F.col("code").alias("detail"), dimensions(items).where("id is not null")
    found = found.union(of(scores, rule(~is_score(F.col("score")), "score"), detail=code))
    # required dimensions: the catalogue goes beside each item as one bounded row, not by a join of all pairs
    wanted = required.select("code").distinct().agg(F.sort_array(F.collect_list("code")).alias("codes"))
    have = items.where("id is not null").select("id").distinct().join(scores.groupBy("id").agg(F.collect_set("code").alias("have")), "id", "left")
    lacking = have.join(F.broadcast(wanted)).select("id", F.explode(F.array_except("codes", F.coalesce("have", F.array().cast("array<string>")))).alias("code"))
    found = found.union(of(lacking, F.lit("missing_score"), detail=code))
    mapped = _mapped(items).where("id is not null")
    bad_index = size("indexes") < 1, F.exists("indexes", lambda i: F.coalesce((i < 0) | (i >= F.col("n")), F.lit(True)))
    found = found.union(of(mapped, rule(bad_index[0] | bad_index[1], "evidence_index"), rule(~F.coalesce(F.col("relation").isin(1, 2, 3, 4), F.lit(False)), "relation"), rule(~is_score(F.col("weight")), "weight"), rule(blank(F.col("explanation")), "explanation"), detail=code))
    sides = scores.select("id", "code", F.lit(1).alias("s"), F.lit(0).alias("m")).union(mapped.select("id", "code", F.lit(0), F.lit(1))).groupBy("id", "code").agg(F.max("s").alias("s"), F.sum("m").alias("m"))
    found = found.union(of(sides, rule(F.col("s") == 0, "unknown_code"), rule(F.col("m") == 0, "unmapped"), rule(F.col("m") > 1, "duplicate_code"), detail=code))
    if expected is not None:
        ids = expected.select("id").distinct().withColumn("e", F.lit(1)).join(items.select("id").where("id is not null").distinct().withColumn("i", F.lit(1)), "id", "full_outer")
        found = found.union(of(ids, rule(F.col("i").isNull(), "missing_item"), rule(F.col("e").isNull(), "unexpected_item")))
    return found


def evidence_links(items: DataFrame) -> DataFrame:
    """id, code, fact: each mapping's texts by their place in the item's evidence."""
    facts = items.select("id", F.posexplode("evidence").alias("place", "fact"))
    refs = _mapped(items).select("id", "code", F.explode("indexes").alias("place"))
    return refs.join(facts, ["id", "place"]).select("id", "code", "fact")


def fact_relation(score: Column) -> Column:
    """How a fact bears on its dimension: 4 against, 2 weak, 1 for."""
    return F.when(score <= 0.25, 4).when(score < 0.5, 2).otherwise(1)


def evidence_state(relation: Column) -> Column:
    return F.when(relation == 4, 2).when(relation == 3, 3).otherwise(1)


def anchor_weight(score: Column) -> Column:
    return F.round(F.greatest(F.lit(0.65), F.abs(score - 0.5) + 0.5), 2)


def sparse_profile(ids: DataFrame, catalogue: DataFrame, scores: DataFrame) -> DataFrame:
    """id, code, score, state: a row for each code of the catalogue; without a score it is null and the state 4."""
    codes = F.broadcast(catalogue.select("code").distinct().agg(F.sort_array(F.collect_list("code")).alias("codes")))
    grid = ids.select("id").distinct().join(codes).select("id", F.explode("codes").alias("code"))
    return grid.join(scores.select("id", "code", "score"), ["id", "code"], "left").withColumn("state", F.when(F.col("score").isNull(), 4).otherwise(1))
