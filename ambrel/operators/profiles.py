"""Annotation profiles as a model writes them, brought under one schema.

enforce() takes items as JSON and gives four tables: profiles, numeric leaves of the vectors, facts, and issues; an item with
an issue has no profile, and all its issues are told. What is put right, in this order:

* the fields LIFTED, if they stand in ``semantic`` instead, move up; fields of ``basic`` that lack get DEFAULTS
* a vector's part named in RENAMED takes its new name, unless that is there too; facts' paths follow
* a fact without ``dimensionPath`` takes the first of ALIASES that holds a text
* if ``media_vector`` has one part, facts whose path has the part's name without "_vector" get the whole name
* facts whose path is no numeric leaf of a vector go; ``experience_introduction`` is made of the two summaries that it
  repeats, if there is none; ``quality_control`` is judged from evidence and facts, if there is none

What is left over is an issue: an item that is no object, basic that is none, a field that lacks, and facts that do not tell of
every numeric leaf once. Fields beyond those named are left out. Ids are a key of the items; an empty table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .contract import _stripped
from .nested import numeric_leaves

#: Fixed values of the schema.
LIFTED = ("experience_vector", "psychology_vector", "media_vector", "vector_facts", "experience_vector_summary", "personality_affinity", "supporting_evidence", "quality_control")
SEMANTIC = ("summary", "themes", "keywords", "core_experience", "experience_introduction")
AFFINITY = ("Ni", "Ne", "Ti", "Te", "Fi", "Fe", "Si", "Se", "openness", "conscientiousness", "extraversion", "agreeableness", "neuroticism", "Assertive", "Turbulent")
SUMMARY = ("experience_description", "structure_description", "cognitive_expression", "behavioral_tendency_description")
VECTORS = ("experience_vector", "psychology_vector", "media_vector")
ALIASES = ("imdensionPath", "dimension_path", "dimensionpath")
RENAMED = ("psychology_vector", "social", "social_relationship")
DEFAULTS = {"contentId": None, "parentContentId": "null", "workId": None, "sourceType": '"CULTURAL_WORK"', "dataOrigin": '"PROVIDED"', "isSynthetic": "false"}
ENOUGH_EVIDENCE = 8


def _at(v: Column, path: str) -> Column:
    """What stands at a path, a JSON null too; null where nothing does."""
    return F.try_variant_get(v, f"$.{path}", "variant")


def _text(v: Column) -> Column:
    """A value that is a text, else null."""
    return F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string"))


def _is_object(v: Column) -> Column:
    return F.coalesce(F.schema_of_variant(v).startswith("OBJECT<"), F.lit(False))


def _list(v: Column) -> Column:
    return F.when(F.schema_of_variant(v).startswith("ARRAY<"), F.try_variant_get(v, "$", "array<variant>"))


def _has(v: Column, names) -> Column:
    out = _is_object(v)
    for n in names:
        out = out & _at(v, n).isNotNull()
    return out


def lifted(items: DataFrame, key: str, text: str, work_id: str, keep) -> DataFrame:
    """The key, work_id, whether the item is an object, and a variant for basic, semantic and each of LIFTED."""
    v = F.col("v")
    whole = keep(items.select(F.col(key).alias("id"), F.col(work_id).alias("work_id"), F.try_parse_json(text).alias("v")))  # parsed once
    semantic = _at(v, "semantic")
    up = {n: F.coalesce(_at(v, n), F.when(_is_object(semantic), _at(semantic, n))) for n in LIFTED}
    return whole.select("id", "work_id", _is_object(v).alias("is_object"), _at(v, "basic").alias("basic"), semantic.alias("semantic"), *[c.alias(n) for n, c in up.items()])


def vector_leaves(fields: DataFrame, keep) -> DataFrame:
    """id, path and value of the vectors' numeric leaves, under their new names."""
    root, old, new = RENAMED
    renamed = fields.select("id", F.to_json(F.to_variant_object(F.struct(*VECTORS))).alias("j"), (_at(F.col(root), old).isNotNull() & _at(F.col(root), new).isNull()).alias("rename"))
    rows = numeric_leaves(renamed, ["id", "rename"], "j", keep)
    moved = F.when(F.col("rename"), F.regexp_replace("path", rf"^{root}\.{old}(?=\.|$)", f"{root}.{new}")).otherwise(F.col("path"))
    return rows.select("id", moved.alias("path"), "value")


def facts_of(fields: DataFrame) -> DataFrame:
    """id, position, path, score and explanation of every fact that is an object, its path put right."""
    root, old, new = RENAMED
    f, c = F.col("f"), F.col
    one = F.when(_is_object(c("media_vector")), F.map_keys(F.try_variant_get("media_vector", "$", "map<string,variant>")))
    rows = fields.select("id", (_at(c(root), old).isNotNull() & _at(c(root), new).isNull()).alias("rename"), F.when(F.size(one) == 1, one[0]).alias("media"), F.posexplode(_list(c("vector_facts"))).alias("position", "f")).where(_is_object(f))
    path = _text(_at(f, "dimensionPath"))
    path = F.when(c("rename"), F.regexp_replace(path, rf"^{root}\.{old}\.", f"{root}.{new}.")).otherwise(path)
    spelt = F.coalesce(*[F.nullif(_text(_at(f, a)), F.lit("")) for a in ALIASES])
    path = F.when(_at(f, "dimensionPath").isNull(), spelt).otherwise(path)
    short = F.concat(F.lit("media_vector."), F.regexp_replace("media", "_vector$", ""), F.lit("."))
    path = F.when(F.startswith(path, short), F.concat(F.lit("media_vector."), c("media"), F.lit("."), F.substr(path, F.length(short) + 1))).otherwise(path)
    return rows.select("id", "position", path.alias("path"), F.try_variant_get(f, "$.score", "double").alias("score"), _text(_at(f, "explanation")).alias("explanation"))


def enforce(items: DataFrame, key: str, text: str, work_id: str, keep) -> dict[str, DataFrame]:
    """The tables profiles, vectors (id, path, value), facts (id, position, path, score, explanation) and issues (id, issue, detail)."""
    c = F.col
    fields = lifted(items, key, text, work_id, keep)
    vectors = vector_leaves(fields, keep)
    facts = keep(facts_of(fields).join(vectors.select("id", "path"), ["id", "path"], "left_semi").select("id", "position", "path", "score", "explanation"))
    numbers = vectors.groupBy("id").agg(F.count(F.lit(1)).alias("n_leaves"))
    told = facts.groupBy("id").agg(F.count(F.lit(1)).alias("n_facts"), F.countDistinct("path").alias("n_paths"))
    n = lambda name: F.coalesce(name, F.lit(0))
    judged = fields.join(numbers, "id", "left").join(told, "id", "left").withColumns({x: n(x) for x in ("n_leaves", "n_facts", "n_paths")})

    summary, semantic = c("experience_vector_summary"), c("semantic")
    parts = F.array_distinct(F.filter(F.array(_stripped(_text(_at(semantic, "summary"))), _stripped(_text(_at(summary, "experience_description")))), lambda x: x != ""))
    given = _at(semantic, "experience_introduction")
    none = given.isNull() | F.is_variant_null(given) | F.to_json(given).isin('""', "false", "0", "[]", "{}")
    introduction = F.when(~none, F.coalesce(_text(given), F.to_json(given))).when(F.size(parts) > 0, F.array_join(parts, "\n")).when(given.isNotNull(), F.to_json(given))
    missing = F.array_compact(F.array(*[F.when(c(x).isNull(), F.lit(x)) for x in ("semantic", *LIFTED)]))
    blank = F.lit(False)
    for name in SUMMARY:
        blank = blank | (F.coalesce(_stripped(_text(_at(summary, name))), F.lit("")) == "")
    rules = {
        "item": (~c("is_object"), F.lit(None)),
        "basic": (c("is_object") & ~_is_object(c("basic")), F.lit(None)),
        "fields": (c("is_object") & (F.size(missing) > 0), F.array_join(missing, ",")),
        "semantic": (c("semantic").isNotNull() & ~(_has(semantic, SEMANTIC[:-1]) & introduction.isNotNull()), F.lit(None)),
        "affinity": (c("personality_affinity").isNotNull() & ~_has(c("personality_affinity"), AFFINITY), F.lit(None)),
        "summary": (summary.isNotNull() & (~_is_object(summary) | blank), F.lit(None)),
        "coverage": (c("vector_facts").isNotNull() & ((c("n_paths") != c("n_leaves")) | (c("n_facts") != c("n_leaves"))), F.concat_ws("/", "n_paths", "n_facts", "n_leaves")),
    }
    found = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.struct(F.lit(name).alias("issue"), detail.cast("string").alias("detail"))) for name, (cond, detail) in rules.items()]))
    judged = judged.withColumn("found", found)
    issues = judged.select("id", F.explode("found").alias("x")).select("id", "x.*")

    enough, covered = F.coalesce(F.size(_list(c("supporting_evidence"))), F.lit(0)) >= ENOUGH_EVIDENCE, c("n_facts") > 0
    own = _is_object(c("quality_control")) & (F.to_json("quality_control") != "{}")
    reasons = F.array_compact(F.array(F.when(~enough, F.lit("evidence_insufficient")), F.when(~covered, F.lit("facts_missing"))))
    own_id = F.regexp_extract(F.to_json(F.array("work_id")), r"(?s)^\[(.*)\]$", 1)  # as JSON
    basic = [F.coalesce(F.to_json(_at(c("basic"), k)), F.lit(v) if v else own_id).alias(k) for k, v in DEFAULTS.items()]
    profile = judged.where(F.size("found") == 0).select(
        "id", F.struct(*basic).alias("basic"), F.struct(*[(introduction if k == "experience_introduction" else F.to_json(_at(semantic, k))).alias(k) for k in SEMANTIC]).alias("semantic"),
        F.struct(*[F.try_variant_get("personality_affinity", f"$.{k}", "double").alias(k) for k in AFFINITY]).alias("affinity"), F.struct(*[_text(_at(summary, k)).alias(k) for k in SUMMARY]).alias("summary"),
        F.transform(_list(c("supporting_evidence")), lambda e: F.to_json(e)).alias("evidence"), F.when(own, F.to_json("quality_control")).alias("quality_given"),
        F.when(own, F.try_variant_get("quality_control", "$.trainingStatus", "string")).when(enough & covered, "TRAINABLE").otherwise("REJECTED").alias("training_status"), F.when(~own, reasons).alias("rejection_reasons"), c("n_facts").alias("facts"),
    )
    return {"profiles": profile, "vectors": vectors, "facts": facts, "issues": issues}
