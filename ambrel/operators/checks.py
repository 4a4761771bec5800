"""Checks of a loaded store: each a count of rows that break a rule, 0 when all is well.

The tables are those of a store: character (id, character_type, gender, deleted), name (character_info_id, language,
deleted), attribute (character_info_id, sub_type, field, dynasty, creative_entity_type, country_id, deleted), country (id,
code), work (id, genre, subcategory), relation (work_id, character_id, relation_type), tag (work_id, subcategory,
is_primary). Checks may be of all rows or of those of some characters and works, as of a run. Each table is read once for
the rules of its own rows; relations are counted by work and kind before they meet the works.

Deleted attributes break no rule, and deleted standard names are no duplicates; names' languages and characters' genders are
asked of deleted rows too. A value that is null is not outside its range, but a work without genre suits no subcategory
and no relation that is bound to genres. An empty table breaks no rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import relational as R
from .contract import ENTITY_TYPES, fits_genre, suits_genre


def _counts(df: DataFrame, rules: dict[str, Column], weight: Column | None = None) -> DataFrame:
    """(check, n) of each rule's rows, in one pass; ``weight`` is how many rows of the store a row stands for."""
    broken = lambda cond: F.coalesce(cond, F.lit(False))
    n = lambda cond: F.count_if(broken(cond)) if weight is None else F.coalesce(F.sum(F.when(broken(cond), weight)), F.lit(0))
    pairs = F.array(*[F.struct(F.lit(name).alias("check"), n(cond).cast("long").alias("n")) for name, cond in rules.items()])
    return df.agg(pairs.alias("p")).select(F.explode("p").alias("p")).select("p.check", "p.n")


def strong_checks(character, name, attribute, country, work, relation, tag, characters: DataFrame | None = None, works: DataFrame | None = None) -> DataFrame:
    """(check, n), a row for each check, whatever is found; of ``characters`` and ``works`` (column id) alone, if given."""
    c, china = F.col, F.col("sub_type") == 2
    some = lambda df, ids, key: df if ids is None else df.join(ids.select(F.col("id").alias(key)), key, "left_semi")
    name, attribute, character = some(name, characters, "character_info_id"), R.present(some(attribute, characters, "character_info_id")), some(character, characters, "id").select("id", "character_type", "gender", "deleted")
    relation, tag, work = some(relation, works, "work_id"), some(tag, works, "work_id"), some(work, works, "id")
    of_name = _counts(name, {"invalidNameLanguage": ~c("language").isin(0, 1, 2, 3)})
    standard = R.present(name).where("language in (0, 1, 2)").groupBy("character_info_id", "language").agg(F.count(F.lit(1)).alias("k"))
    twice = _counts(standard, {"duplicateStandardNames": c("k") > 1})
    placed = attribute.join(country.select(c("id").alias("country_id"), "code"), "country_id", "left")
    of_attribute = _counts(placed, {
        "invalidRealSubtype": ~c("sub_type").isin(1, 2),
        "chinaWrongCountry": china & ~c("code").eqNullSafe("CHN"),
        "invalidCreativeEntityType": ~c("creative_entity_type").isin(*ENTITY_TYPES),
        "invalidField": (china & ~c("field").between(0, 10)) | ((c("sub_type") == 1) & ~c("field").between(0, 8)),
        "invalidDynasty": (c("dynasty") == 8) | ~c("dynasty").between(1, 21) | ((c("sub_type") == 1) & c("dynasty").isNotNull()),
        "chinaMissingDynasty": china & c("dynasty").isNull(),
    })
    of_character = _counts(character, {"invalidGender": ~c("gender").isin(0, 1, 2, 3)})
    edges = relation.groupBy("work_id", c("character_id").alias("id"), "relation_type").agg(F.count(F.lit(1)).alias("k"))
    repeated = _counts(edges, {"duplicateRelations": c("k") > 1})
    return reduce(DataFrame.union, [of_name, twice, of_attribute, of_character, repeated, *_of_works(character, relation, tag, work)])


def _of_works(character, relation, tag, work) -> list[DataFrame]:
    c = F.col
    by_creator = relation.groupBy(c("character_id").alias("id")).agg(F.count(F.lit(1)).alias("k")).join(character, "id")
    virtual = _counts(by_creator, {"virtualCreators": (c("character_type") != 1) | (c("deleted") != 0)}, c("k"))
    works = work.select(c("id").alias("work_id"), "genre", c("subcategory").alias("own"))
    by_type = relation.groupBy("work_id", "relation_type").agg(F.count(F.lit(1)).alias("k")).join(works, "work_id")
    of_relation = _counts(by_type, {"invalidRelationGenre": c("relation_type").isNotNull() & ~suits_genre(c("relation_type"), c("genre"))}, c("k"))
    rows = relation.groupBy("work_id").agg(F.count(F.lit(1)).alias("k"))
    of_work = _counts(works.join(rows, "work_id", "left"), {"invalidSubcategoryGenre": c("own").isNotNull() & ~fits_genre(c("own"), c("genre"))}, F.coalesce("k", F.lit(1)))  # once a relation, once without
    of_tag = _counts(tag.join(works, "work_id"), {
        "invalidTagGenre": ~fits_genre(c("subcategory"), c("genre")),
        "invalidPrimaryTag": (c("is_primary").cast("int") == 1) & ~c("subcategory").eqNullSafe(c("own")),
    })
    primaries = tag.groupBy("work_id").agg(F.count_if(c("is_primary").cast("int") == 1).alias("k"))
    of_primary = _counts(works.where("own is not null").join(primaries, "work_id", "left"), {"missingOrDuplicatePrimaryTag": F.coalesce("k", F.lit(0)) != 1})
    return [virtual, of_relation, of_work, of_tag, of_primary]


def broken_relations(character, work, relation, works: DataFrame | None = None) -> DataFrame:
    """One row, n: relations (of ``works``, if given) whose character or work is not there."""
    if works is not None:
        relation = relation.join(works.select(F.col("id").alias("work_id")), "work_id", "left_semi")
    edges = relation.groupBy("work_id", "character_id").agg(F.count(F.lit(1)).alias("k"))
    edges = edges.join(character.select(F.col("id").alias("character_id"), F.lit(1).alias("a")), "character_id", "left").join(work.select(F.col("id").alias("work_id"), F.lit(1).alias("b")), "work_id", "left")
    return edges.agg(F.coalesce(F.sum(F.when(F.col("a").isNull() | F.col("b").isNull(), F.col("k"))), F.lit(0)).alias("n"))
