"""Import of annotation profiles into a store: checked as a whole, then six tables as one load.

A batch is four tables, as operators.profiles gives them: profiles (id: the work's logical id, summary, confidence, payload),
vectors (id, path, value), facts (id, position, path, score, explanation) and affinity (id, trait, score). problems() tells of
all that speaks against it: works without id or there twice, facts that repeat a path or state another score than the vector
(of paths that no vector has nothing is asked), values outside [0, 1], affinities that lack a required trait or have one that
is not allowed, works that the store lacks, and works that have a current profile already: a load replaces none.

A dimension without a told fact has state 1 and no evidence; else its relation follows the score (4 up to .25, 2 below .5, 1),
and so do state and kind of evidence. Of facts with one path the last that explains anything counts.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalar import stable_id
from .annotations import evidence_state, fact_relation
from .contract import _stripped
from .importing import _problem, refuse_if_any
from .runs import Change, Store, digest_of

#: Trait systems, and the one path that is written in an old way.
REQUIRED = ("Ni", "Ne", "Ti", "Te", "Fi", "Fe", "Si", "Se", "Assertive", "Turbulent")
BIG_FIVE = ("openness", "conscientiousness", "extraversion", "agreeableness", "neuroticism")
OLD_PATH = ("psychology_vector.social.love", "psychology_vector.social_relationship.love")
TABLES = {
    "profile": "id long, content_id long, schema_version string, profile_version int, is_current int, summary string, confidence double, run_id long, payload string",
    "dimension_definition": "id long, dimension_code string, group_code string, name_en string, schema_version string, display_order int",
    "dimension_value": "id long, profile_id long, dimension_id long, score double, confidence double, evidence_state int, evidence_count int, rationale string",
    "evidence": "id long, profile_id long, evidence_type int, fact_text string, source_locator string, quality_score double",
    "dimension_evidence": "id long, profile_id long, dimension_id long, evidence_id long, relation_type int, evidence_weight double, explanation string",
    "projection": "id long, profile_id long, projection_system int, trait_code string, score double, confidence double",
}


def canonical(path: Column) -> Column:
    """A leaf's path as a dimension's code; a path outside the three vectors is an error when the rows are computed."""
    path = F.when(path == OLD_PATH[0], F.lit(OLD_PATH[1])).otherwise(path)
    known = path.rlike(r"\A(experience|psychology|media)_vector\.")
    code = F.regexp_replace(path, r"\A([a-z]+)_vector\.", "$1.")
    return F.when(known, code).otherwise(F.raise_error(F.concat(F.lit("unknown path "), F.coalesce(path, F.lit("null")))).cast("string"))


def group_code(code: Column) -> Column:
    """A code without its last part."""
    return F.regexp_replace(code, r"\.[^.]*\z", "")


def problems(batch: dict[str, DataFrame], read, version: str) -> DataFrame:
    """(entity_kind, entity_id, problem, detail): all that speaks against the batch."""
    c = F.col
    profiles, vectors, facts, affinity = (batch[k] for k in ("profiles", "vectors", "facts", "affinity"))
    of = lambda df, problem, detail=None: _problem(df, "profile", c("id"), problem, F.lit(None) if detail is None else detail)
    named = profiles.where(F.coalesce("id", F.lit("")) != "")
    paths = facts.groupBy("id", "path").agg(F.count(F.lit(1)).alias("n"))
    stated = facts.join(vectors, ["id", "path"]).where(~c("score").eqNullSafe(c("value")))
    traits = profiles.select("id").join(affinity.groupBy("id").agg(F.collect_set("trait").alias("have")), "id", "left").withColumn("have", F.coalesce("have", F.array().cast("array<string>")))
    lists = lambda xs: F.array(*map(F.lit, xs))
    works = read("work").where(F.coalesce("deleted", F.lit(0)) == 0).select(c("id").alias("content_id"))
    keyed = named.select("id", stable_id("work", c("id")).alias("content_id"))
    current = read("profile").where((c("is_current") == 1) & (c("schema_version") == version)).select("content_id")
    return reduce(DataFrame.union, [
        of(profiles.where(F.coalesce("id", F.lit("")) == ""), "missing_id"), of(named.groupBy("id").count().where("count > 1"), "duplicate_id", c("count")), of(paths.where("n > 1"), "fact_twice", c("path")), of(stated, "fact_score", c("path")),
        of(vectors.where(~F.coalesce(c("value").between(0, 1) & ~F.isnan("value"), F.lit(False))), "score_range", c("path")),
        of(traits.where(F.size(F.array_except(lists(REQUIRED), "have")) > 0), "trait_missing", F.array_join(F.array_sort(F.array_except(lists(REQUIRED), traits["have"])), ",")),
        of(traits.where(F.size(F.array_except("have", lists(REQUIRED + BIG_FIVE))) > 0), "trait_unknown", F.array_join(F.array_sort(F.array_except(traits["have"], lists(REQUIRED + BIG_FIVE))), ",")),
        of(keyed.join(works, "content_id", "left_anti"), "work_unknown"), of(keyed.join(current, "content_id", "left_semi"), "profile_current"),
    ])


def rows_of(batch: dict[str, DataFrame], read, version: str, run: str) -> dict[str, DataFrame]:
    """Rows of the six tables."""
    c = F.col
    profiles, vectors, facts, affinity = (batch[k] for k in ("profiles", "vectors", "facts", "affinity"))
    last = read("profile").where(c("schema_version") == version).groupBy("content_id").agg(F.max("profile_version").alias("top"))
    run_id = stable_id("annotation-run", F.lit(f"{version}:{run}"))
    numbered = profiles.withColumn("content_id", stable_id("work", c("id"))).join(last, "content_id", "left").withColumn("profile_version", F.coalesce("top", F.lit(0)) + 1).withColumn("run_id", run_id)
    numbered = numbered.withColumn("profile_id", stable_id("profile", F.concat_ws(":", "content_id", F.lit(version), "profile_version", "run_id")))
    of = numbered.select("id", "profile_id", "confidence")
    codes = vectors.select("path", canonical(c("path")).alias("code"))
    definition = codes.select("code").distinct().withColumn("display_order", F.row_number().over(W.partitionBy(group_code(c("code"))).orderBy("code")))
    told = facts.where(F.coalesce(_stripped(c("explanation")), F.lit("")) != "").withColumn("__r", F.row_number().over(W.partitionBy("id", "path").orderBy(F.desc("position")))).where("__r = 1")
    dims = vectors.withColumn("code", canonical(c("path"))).join(of, "id").join(told.select("id", "path", "explanation"), ["id", "path"], "left")
    has, relation = c("explanation").isNotNull(), fact_relation(c("value"))
    dims = dims.select("*", stable_id("dimension", F.concat_ws(":", F.lit(version), "code")).alias("dimension_id"), has.alias("has"), relation.alias("relation"), stable_id("annotation-evidence", F.concat_ws(":", "profile_id", "path", "explanation")).alias("evidence_id"))
    key = lambda kind, *cs: stable_id(kind, F.concat_ws(":", *cs)).alias("id")
    proof = dims.where("has")
    system = F.when(c("trait").isin(*REQUIRED[:8]), 1).when(c("trait").isin(*BIG_FIVE), 2).otherwise(4)
    out = {
        "profile": numbered.select(c("profile_id").alias("id"), "content_id", F.lit(version).alias("schema_version"), "profile_version", F.lit(1).alias("is_current"), "summary", "confidence", "run_id", "payload"),
        "dimension_definition": definition.select(key("dimension", F.lit(version), "code"), c("code").alias("dimension_code"), group_code(c("code")).alias("group_code"), F.substring_index("code", ".", -1).alias("name_en"), F.lit(version).alias("schema_version"), "display_order"),
        "dimension_value": dims.select(key("dimension-value", "profile_id", "dimension_id"), "profile_id", "dimension_id", c("value").alias("score"), "confidence", F.when(c("has"), evidence_state(c("relation"))).otherwise(1).alias("evidence_state"), c("has").cast("int").alias("evidence_count"), c("explanation").alias("rationale")),
        "evidence": proof.select(c("evidence_id").alias("id"), "profile_id", F.when(c("relation") == 4, 7).otherwise(2).alias("evidence_type"), c("explanation").alias("fact_text"), F.concat(F.lit("vector_facts["), "path", F.lit("]")).alias("source_locator"), c("confidence").alias("quality_score")),
        "dimension_evidence": proof.select(key("dimension-evidence", "dimension_id", "evidence_id"), "profile_id", "dimension_id", "evidence_id", c("relation").alias("relation_type"), c("confidence").alias("evidence_weight"), "explanation"),
        "projection": affinity.join(of, "id").select(key("projection", "profile_id", "trait"), "profile_id", system.alias("projection_system"), c("trait").alias("trait_code"), "score", "confidence"),
    }
    kinds = {t: [f.split(" ") for f in s.split(", ")] for t, s in TABLES.items()}
    return {t: df.select(*[c(n).cast(k).alias(n) for n, k in kinds[t]]) for t, df in out.items()}


def create(store: Store) -> None:
    store.commit(lambda read: {t: store.spark.createDataFrame([], s) for t, s in TABLES.items()})


def import_profiles(store: Store, name: str, batch: dict[str, DataFrame], version: str) -> dict:
    """Load the batch as one run, or raise ImportRefused with all that speaks against it."""
    inputs = digest_of(*[batch[k] for k in ("profiles", "vectors", "facts", "affinity")])

    def changes(read):
        refuse_if_any(problems(batch, read, version))
        return {t: Change(df, "id") for t, df in rows_of(batch, read, version, inputs).items()}

    return store.load(name, changes, inputs=inputs)
