"""Patches of a store: a nested snapshot to write them from, and their application, whole or not at all.

A patch has new characters, new works and relations between characters and works, new ones by their logical id, those in the
store by what must match exactly one entity. Whether it can be applied is decided for the whole patch before anything is
written: problems() tells of every reference that matches none or several, lacks a field or names an unknown new entity, of
every relation outside its range or unsuited to the work's genre. Matching sums the store up by key first: a key has exactly
one entity if its least and its greatest id are the same, so a name that many share makes no pairs.

Documents are characters and works as the contract has them; relations have the shape RELATION. Of relations alike in work,
character and kind the last counts, as does the last primary author of a work. The patch is one load: it has a manifest, its
before-image, and can be rolled back.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalar import stable_id
from ..sources.scratch import keeper
from . import contract
from . import relational as R
from .importing import _codes, _problem, _shaped, kept_documents, refuse_if_any, tables_of
from .runs import Change, Store, digest_of

RELATION = """position long, characterRef struct<newId:string,name:string,countryCode:string,field:int>, workRef struct<newId:string,workName:string,countryCode:string,genre:int,year:int>,
relationType int, sortOrder int, primaryAuthor boolean"""
#: What an entity that is there already has assigned.
ASSIGNED = {
    "character": ["gender", "introduction", "deleted"],
    "character_name": ["character_name", "language", "deleted"],
    "real_attribute": ["begin_century", "end_century", "country_id", "field", "sub_type", "dynasty", "creative_entity_type", "deleted"],
    "work_subcategory": ["is_primary", "sort_order"],
    "work_creator": ["sort_order"],
}


def snapshot(read) -> tuple[DataFrame, DataFrame]:
    """Characters with their names, works with their creators and tags, in order; what is deleted is left out."""
    c = F.col
    country = read("country").select(c("id").alias("country_id"), c("code").alias("countryCode"))
    attribute = R.present(read("real_attribute")).join(country, "country_id", "left").select(c("character_info_id").alias("id"), c("sub_type").alias("realSubType"), c("creative_entity_type").alias("creativeEntityType"), "field", "dynasty", c("begin_century").alias("beginCentury"), c("end_century").alias("endCentury"), "countryCode")
    people = R.present(read("character")).select("id", "gender", "introduction").join(attribute, "id")
    named = R.nest(people, R.present(read("character_name")), "id", "character_info_id", F.struct("language", c("character_name").alias("name")), F.struct("language", "id"), "names")
    works = R.present(read("work")).join(country, "country_id", "left").select("id", c("work_name").alias("workName"), c("original_name").alias("originalName"), "genre", "subcategory", "year", "countryCode", "introduction", c("auth_character_id").alias("primaryAuthorDatabaseId"))
    made = R.nest(works, read("work_creator"), "id", "work_id", F.struct(c("character_id").alias("characterDatabaseId"), c("relation_type").alias("relationType"), c("sort_order").alias("sortOrder")), F.struct("sort_order", "id"), "creators")
    tagged = R.nest(made, read("work_subcategory"), "id", "work_id", F.struct("subcategory", c("is_primary").alias("isPrimary"), c("sort_order").alias("sortOrder")), F.struct("sort_order", "id"), "subcategories")
    return named, tagged


def _ends(df: DataFrame, by: list[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.min("id").alias("low"), F.max("id").alias("high"))


def _verdict(low, high):
    return F.when(low.isNull(), "none").when(low != high, "many")


def matched(relations: DataFrame, characters: DataFrame, works: DataFrame, read) -> DataFrame:
    """Relations with cid, wid and genre, and character_problem and work_problem where a reference is not to exactly one entity."""
    c = F.col
    r = relations.withColumn("row", F.monotonically_increasing_id())
    country = _codes(read("country")).withColumnRenamed("countryCode", "code")
    named = R.present(read("character_name")).select(c("character_info_id").alias("id"), F.trim("character_name").alias("name"))
    placed = R.present(read("real_attribute")).join(country, "country_id").select(c("character_info_id").alias("id"), "code", "field")
    people = _ends(R.present(read("character")).select("id").join(named, "id").join(placed, "id").distinct(), ["name", "code", "field"])
    there = R.present(read("work")).join(country, "country_id")
    titles = [there.select("id", F.trim(n).alias("title"), "code", "genre", c("year").alias("y")) for n in ("work_name", "original_name")]
    pieces = _ends(titles[0].union(titles[1]).where("title is not null"), ["title", "code", "genre", "y"])
    by_id = there.select(c("id").alias("wid"), c("genre").alias("there_genre"))

    new_people = characters.select(contract._stripped(c("id")).alias("new_c")).distinct().withColumn("known_c", F.lit(True))
    new_works = works.select(contract._stripped(c("workId")).alias("new_w"), c("genre").alias("new_genre")).groupBy("new_w").agg(F.first("new_genre").alias("new_genre")).withColumn("known_w", F.lit(True))
    p, w = c("characterRef"), c("workRef")
    keyed = r.join(people.withColumnsRenamed({"low": "c_low", "high": "c_high"}), (F.trim(p["name"]) == c("name")) & (p["countryCode"] == c("code")) & (p["field"] == c("field")), "left").drop("name", "code", "field")
    keyed = keyed.join(pieces.withColumnsRenamed({"low": "w_low", "high": "w_high", "genre": "g"}), (F.trim(w["workName"]) == c("title")) & (w["countryCode"] == c("code")) & (w["genre"] == c("g")) & w["year"].eqNullSafe(c("y")), "left").drop("title", "code", "g", "y")
    keyed = keyed.join(new_people, p["newId"] == c("new_c"), "left").join(new_works, w["newId"] == c("new_w"), "left")
    lacks_c, lacks_w = F.coalesce(p["name"].isNull() | p["countryCode"].isNull() | p["field"].isNull(), F.lit(True)), F.coalesce(w["workName"].isNull() | w["countryCode"].isNull() | w["genre"].isNull(), F.lit(True))
    problem_c = F.when(p["newId"].isNotNull(), F.when(c("known_c").isNull(), "character_unknown_new")).when(lacks_c, "character_lacks_field").otherwise(F.concat(F.lit("character_"), _verdict(c("c_low"), c("c_high"))))
    problem_w = F.when(w["newId"].isNotNull(), F.when(c("known_w").isNull(), "work_unknown_new")).when(lacks_w, "work_lacks_field").otherwise(F.concat(F.lit("work_"), _verdict(c("w_low"), c("w_high"))))
    cid = F.when(p["newId"].isNotNull(), stable_id("character", p["newId"])).otherwise(c("c_low"))
    wid = F.when(w["newId"].isNotNull(), stable_id("work", w["newId"])).otherwise(c("w_low"))
    out = keyed.select(*relations.columns, cid.alias("cid"), wid.alias("wid"), problem_c.alias("character_problem"), problem_w.alias("work_problem"), "new_genre")
    return out.join(by_id, "wid", "left").withColumn("genre", F.coalesce("new_genre", "there_genre")).drop("new_genre", "there_genre")


def problems(characters: DataFrame, works: DataFrame, relations: DataFrame, read, found: DataFrame | None = None) -> DataFrame:
    """(entity_kind, entity_id, problem, detail): all that speaks against the patch; ``found`` are the relations as matched(), if they are there."""
    c = F.col
    found = matched(relations, characters, works, read) if found is None else found
    told = lambda cond, problem, detail: F.when(cond, F.struct(problem.alias("problem"), detail.cast("string").alias("detail")))
    whole = (c("character_problem").isNull()) & c("work_problem").isNull()
    outside = ~F.coalesce(c("relationType").between(1, 99), F.lit(False))
    bound = c("relationType").isin(*contract.RELATION_GENRES)
    of_relation = [
        told(c("character_problem").isNotNull(), c("character_problem"), F.to_json("characterRef")), told(c("work_problem").isNotNull(), c("work_problem"), F.to_json("workRef")), told(outside, F.lit("relation_type"), c("relationType")),
        told(whole & ~outside & bound & ~contract.suits_genre(c("relationType"), c("genre")), F.lit("relation_genre"), F.concat_ws("/", "relationType", "genre")),
    ]
    spoken = found.select(F.concat_ws(" ", F.lit("relation"), "position").alias("entity_id"), F.explode(F.array_compact(F.array(*of_relation))).alias("x"))  # matched once for all
    parts = [spoken.select(F.lit("relation").alias("entity_kind"), "entity_id", "x.problem", "x.detail")]
    for df, kind, key in ((characters, "character", "id"), (works, "work", "workId")):
        ids = df.select(F.coalesce(contract._stripped(c(key)), F.lit("")).alias("id"), "countryCode")
        parts.append(_problem(ids.where("id = ''"), kind, c("id"), "missing_id", F.lit(None)))
        parts.append(_problem(ids.where("id <> ''").groupBy("id").count().where("count > 1"), kind, c("id"), "duplicate_id", c("count")))
        parts.append(_problem(ids.join(_codes(read("country")), "countryCode", "left_anti"), kind, c("id"), "country_unknown", c("countryCode")))
    return reduce(DataFrame.union, parts)


def apply_patch(store: Store, name: str, characters: DataFrame, works: DataFrame, relations: DataFrame, creator: int = 1) -> dict:
    """Apply the patch as one run, or raise ImportRefused and write nothing; the run's manifest with ``result``.

    The patch is computed once and kept, and so are its relations as they match the store of the moment.
    """
    keep = keeper(store.spark)
    characters, works = kept_documents(characters, works, keep)
    relations = keep(relations)

    def changes(read):
        found = keep(matched(relations, characters, works, read))
        refuse_if_any(problems(characters, works, relations, read, found))
        rows, c = tables_of(characters, works, read("country"), creator), F.col
        last = lambda df, by: df.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(F.desc("position")))).where("__r = 1").drop("__r")
        edges = last(found, ["wid", "cid", "relationType"])
        edges = edges.select(stable_id("work-creator-db", F.concat_ws(":", "wid", "cid", "relationType")).alias("id"), c("wid").alias("work_id"), c("cid").alias("character_id"), c("relationType").alias("relation_type"), F.coalesce("sortOrder", F.lit(0)).alias("sort_order"), F.lit(creator).alias("creator"))
        authors = last(found.where("primaryAuthor"), ["wid"]).select(c("wid").alias("id"), c("cid").alias("__author"))
        old = read("work")
        of_works = rows["work"].withColumn("auth_character_id", F.lit(None).cast("long"))
        more = old.join(rows["work"].select("id"), "id", "left_anti").join(authors.select("id"), "id", "left_semi").select(*old.columns)
        of_works = of_works.unionByName(more).join(authors, "id", "left").withColumn("auth_character_id", F.coalesce("__author", "auth_character_id")).select(*old.columns)
        rows = rows | {"work": of_works, "work_creator": _shaped(edges, "work_creator")}
        return {t: Change(df, "id", ASSIGNED.get(t)) for t, df in rows.items()}

    run = store.load(name, changes, inputs=digest_of(characters.drop("__n"), works.drop("__n"), relations))
    return store._mark(run, run["status"], result={"newCharacters": characters.count(), "newWorks": works.count(), "relations": relations.count()})
