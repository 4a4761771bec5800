"""Contract of nested character and work documents: every broken rule is an issue row, nothing stops at the first.

Issues are (entity_kind, entity_id, rule). Rules of one document are one narrow projection; rules between documents
(duplicates, references, both sides of an edge) are joins and grouped counts. A document without id, or a later copy of
an id, gives that issue alone. Documents are typed by CHARACTER and WORK; a value of another JSON type is read as null,
which the rules then report where null is not allowed. Input order is the column ``position``. Ids are stripped first. Of an
introduction the first fault counts: missing, short, a forbidden phrase (those of the contract, if no others are given); its
white space at the ends has no length. An item of a character's own works needs an id and a relation, of any value.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalar import nfkc_casefold_all

CHARACTER = """id string, characterType int, realSubType int, creativeEntityType int, gender int, countryCode string, field int,
dynasty int, beginCentury int, endCentury int, names array<struct<language:int,name:string>>, introduction string,
ownWork array<struct<workId:string,relationType:int>>, position long"""
WORK = """workId string, workName string, originalName string, genre int, subcategory int, subcategories array<int>, year int,
countryCode string, introduction string, primaryAuthorId string,
creators array<struct<characterId:string,relationType:int,sortOrder:int>>, position long"""

#: Fixed values of the contract.
GENRES = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 11, 12, 14)
SUBCATEGORIES = {
    1: (1001, 1015), 2: (2001, 2015), 3: (3001, 3014), 4: (4001, 4017), 5: (5001, 5016), 6: (6001, 6015), 7: (7001, 7014),
    8: (8001, 8008), 9: (9001, 9011), 10: (10001, 10012), 11: (11001, 11006), 12: (12001, 12010), 14: (14001, 14008),
}
ENTITY_TYPES = (1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 99)
RELATIONS = (*range(1, 36), 99)
RELATION_GENRES = {
    2: (2, 4, 5, 8), 3: (4, 5, 8), 4: (4, 5, 7), 5: (5,), 6: (1,), 7: (1,), 8: (1,), 9: (1, 2), 10: (1, 2, 4, 5, 7, 8), 11: (7, 8),
    12: (7,), 13: (7, 8), 14: (3,), 15: (2,), 16: (2, 4), 17: (9,), 18: (12,), 19: (12,), 20: (14,), 21: (8,), 22: (8,), 23: (11,),
    24: (4, 5, 8), 25: (7,), 26: (7, 8), 27: (2, 4, 5), 28: (4, 5), 29: (6, 10), 30: (8,), 31: (6, 10), 32: (2, 4, 5, 8),
    33: (1, 2, 4, 5, 8), 34: (7, 8), 35: (4, 5, 8),
}
FORBIDDEN = (
    r"该实体", r"本条目", r"数据库", r"建模", r"用于后续", r"便于.*分析",
    r"\d+\s*号创作关系", r"relationType", r"JSON", r"Prompt",
    r"人格(?:判断|标签|结论|类型)",
    r"(?:可用于|用于|支持).*(?:分析|研究|判断)", r"分析价值",
    r"不能替代.*判断", r"后续(?:分析|研究|标注)", r"推荐算法",
)
CHARACTER_ID = r"\ArealCharacter_[a-z]{3}_(unknown|-?[0-9]{1,4})_[0-9]{3}\z"
WORK_ID = r"\Awork_[a-z]{3}_(unknown|-?[0-9]{1,4})_[0-9]{3}\z"
COUNTRY = r"\A[A-Z]{3}\z"
CHINA = "CHN"
PHRASES = "|".join(FORBIDDEN)


def _stripped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def _blank(c: Column) -> Column:
    return F.coalesce(_stripped(c), F.lit("")) == ""


def _introduction(least: int, forbidden: str | None) -> dict[str, Column]:
    text = F.coalesce(_stripped(F.col("introduction")), F.lit(""))
    rules = {"introduction_missing": text == "", "introduction_short": F.length(text).between(1, least - 1)}
    return rules | ({"introduction_phrase": (F.length(text) >= least) & F.col("introduction").rlike(forbidden)} if forbidden else {})


def _in(c: Column, values) -> Column:
    return F.coalesce(c.isin(*values), F.lit(False))


def _between(c: Column, low: int, high: int) -> Column:
    return F.coalesce(c.between(low, high), F.lit(False))


def fits_genre(tag: Column, genre: Column) -> Column:
    """Whether a subcategory is one of its genre's."""
    span = F.try_element_at(F.create_map(*[x for g, (a, b) in SUBCATEGORIES.items() for x in (F.lit(g), F.struct(F.lit(a), F.lit(b)))]), genre)
    return F.coalesce(tag.between(span["col1"], span["col2"]), F.lit(False))


def suits_genre(relation: Column, genre: Column) -> Column:
    """Whether a relation may stand between a creator and a work of the genre."""
    genres = F.create_map(*[x for r, gs in RELATION_GENRES.items() for x in (F.lit(r), F.array(*map(F.lit, gs)))])
    return relation.isin(1, 99) | F.coalesce(F.array_contains(F.try_element_at(genres, relation), genre), F.lit(False))


def _repeats(keys: Column) -> Column:
    """Whether a text occurs twice. Texts are hashed; an array of structs would be compared element by element with all others."""
    return F.size(F.array_distinct(keys)) < F.size(keys)


def numbered(df: DataFrame, key: str) -> DataFrame:
    """Documents with __n, their place among those of their id, null without one; those that have it stay, so it can be kept."""
    if "__n" in df.columns:
        return df
    id_ = _stripped(F.col(key))
    return df.withColumn("__n", F.when(~_blank(F.col(key)), F.row_number().over(W.partitionBy(id_).orderBy("position"))))


def _issues(df: DataFrame, kind: str, key: str, rules: dict[str, Column]) -> DataFrame:
    """One pass over the documents: what broke, exploded."""
    df = numbered(df, key).withColumn(key, _stripped(F.col(key)))
    first = F.when(F.col("__n").isNull(), F.array(F.lit("missing_id"))).when(F.col("__n") > 1, F.array(F.lit("duplicate_id")))
    broken = F.array_compact(F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()]))
    return df.select(F.lit(kind).alias("entity_kind"), F.col(key).alias("entity_id"), F.explode(F.coalesce(first, broken)).alias("rule"))


def _valid(df: DataFrame, key: str) -> DataFrame:
    """Documents with an id, of each id the first."""
    return numbered(df, key).where("__n = 1").drop("__n").withColumn(key, _stripped(F.col(key)))


def character_issues(characters: DataFrame, forbidden: str | None = PHRASES) -> DataFrame:
    c, china = F.col, F.col("realSubType") == 2
    names = F.coalesce("names", F.array().cast("array<struct<language:int,name:string>>"))
    valid = F.filter(names, lambda n: _between(n["language"], 0, 3) & ~_blank(n["name"]))
    characters = characters.withColumn("__valid", valid).withColumn("__folded", nfkc_casefold_all(F.transform("__valid", lambda n: n["name"])))
    clean = F.zip_with("__valid", "__folded", lambda n, folded: F.concat_ws(":", n["language"], folded))
    standard = F.filter(F.transform("__valid", lambda n: n["language"]), lambda x: x.isin(0, 1, 2))
    year = lambda y: y.isNotNull() & ((y == 0) | ~y.between(-5000, 2100))
    parts = F.split("id", "_")
    own = F.filter("ownWork", lambda w: w["workId"].isNotNull() & w["relationType"].isNotNull())
    token = F.when(c("id").rlike(CHARACTER_ID), F.get(parts, F.size(parts) - 2))
    rules = {
        "id_pattern": ~c("id").rlike(CHARACTER_ID),
        "character_type": ~_in(c("characterType"), [1]),
        "real_sub_type": ~_in(c("realSubType"), [1, 2]),
        "entity_type": ~_in(c("creativeEntityType"), ENTITY_TYPES),
        "gender": ~_between(c("gender"), 0, 3),
        "organisation_gender": _in(c("creativeEntityType"), ENTITY_TYPES[1:]) & ~c("gender").eqNullSafe(0),
        "field": ~F.when(china, _between(c("field"), 0, 10)).otherwise(_between(c("field"), 0, 8)),
        "dynasty": c("dynasty").isNotNull() & (~c("dynasty").between(1, 21) | (c("dynasty") == 8)),
        "country_code": c("countryCode").isNotNull() & ~c("countryCode").rlike(COUNTRY),
        "china_country": china & ~c("countryCode").eqNullSafe(CHINA),
        "china_dynasty": china & c("dynasty").isNull(),
        "world_dynasty": (c("realSubType") == 1) & c("dynasty").isNotNull(),
        "begin_year": year(c("beginCentury")),
        "end_year": year(c("endCentury")),
        "year_order": c("endCentury") < c("beginCentury"),
        "id_year": token != F.coalesce(c("beginCentury").cast("string"), F.lit("unknown")),
        "names_empty": F.size(names) == 0,
        "name_language": F.exists(names, lambda n: ~_between(n["language"], 0, 3)),
        "name_blank": F.exists(names, lambda n: _blank(n["name"])),
        "name_duplicate": _repeats(clean),
        "name_standard_twice": F.size(F.array_distinct(standard)) < F.size(standard),
        "own_work_missing": c("ownWork").isNull(),
        "own_work_duplicate": _repeats(F.transform(own, lambda w: F.concat_ws(":", w["relationType"], w["workId"]))),
        "own_work_item": F.size(own) < F.size("ownWork"),
    }
    return _issues(characters, "character", "id", rules | _introduction(60, forbidden))


def work_issues(works: DataFrame, forbidden: str | None = PHRASES) -> DataFrame:
    c = F.col
    tags = F.coalesce("subcategories", F.when(c("subcategory").isNotNull(), F.array("subcategory")), F.array().cast("array<int>"))
    fits = lambda t: fits_genre(t, c("genre"))
    creators = F.coalesce("creators", F.array().cast("array<struct<characterId:string,relationType:int,sortOrder:int>>"))
    orders = F.array_sort(F.transform(creators, lambda r: F.coalesce(r["sortOrder"], F.lit(0))))
    allowed = lambda r: suits_genre(r, c("genre"))
    pairs = F.transform(creators, lambda r: F.concat_ws(":", F.coalesce(r["relationType"].cast("string"), F.lit("")), F.coalesce(_stripped(r["characterId"]), F.lit(""))))
    rules = {
        "id_pattern": ~c("workId").rlike(WORK_ID),
        "work_name": _blank(c("workName")),
        "original_name": c("originalName").isNotNull() & _blank(c("originalName")),
        "genre": ~_in(c("genre"), GENRES),
        "subcategory": c("subcategory").isNotNull() & ~fits(c("subcategory")),
        "tag": F.exists(tags, lambda t: ~fits(t)),
        "tag_duplicate": F.size(F.array_distinct(tags)) < F.size(tags),
        "primary_tag": c("subcategory").isNotNull() & ~F.array_contains(tags, c("subcategory")),
        "year": c("year") == 0,
        "country_code": c("countryCode").isNotNull() & ~c("countryCode").rlike(COUNTRY),
        "creators_empty": F.size(creators) == 0,
        "relation_type": F.exists(creators, lambda r: ~_in(r["relationType"], RELATIONS)),
        "relation_genre": F.exists(creators, lambda r: _in(r["relationType"], RELATIONS) & ~allowed(r["relationType"])),
        "sort_order": (F.size(creators) > 0) & (orders != F.sequence(F.lit(0), F.greatest(F.size(creators) - 1, F.lit(0)))),
        "creator_duplicate": _repeats(pairs),
        "primary_author": c("primaryAuthorId").isNotNull() & ~F.exists(creators, lambda r: (r["characterId"] == c("primaryAuthorId")) & (r["relationType"] == 1)),
    }
    return _issues(works, "work", "workId", rules | _introduction(40, forbidden))


def edge_issues(characters: DataFrame, works: DataFrame) -> DataFrame:
    """Creators that are not there, and edges that only one side knows (of works in the batch)."""
    characters, works = _valid(characters, "id"), _valid(works, "workId")
    by_work = works.select("workId", F.explode("creators").alias("r")).select("workId", F.col("r.characterId").alias("id"), F.col("r.relationType").alias("relationType"))
    lost = by_work.withColumn("id", F.coalesce(_stripped(F.col("id")), F.lit(""))).join(characters.select("id"), "id", "left_anti").select(F.lit("work").alias("entity_kind"), F.col("workId").alias("entity_id"), F.lit("creator_missing").alias("rule"))
    by_character = characters.select("id", F.explode("ownWork").alias("w")).select(F.col("w.workId").alias("workId"), "id", F.col("w.relationType").alias("relationType")).join(works.select("workId"), "workId", "left_semi")
    sides = by_work.withColumn("s", F.lit(1)).unionByName(by_character.withColumn("s", F.lit(2))).groupBy("workId", "id", "relationType").agg(F.min("s").alias("s"), F.max("s").alias("t")).where("s = t")
    one = sides.select(F.lit("work").alias("entity_kind"), F.col("workId").alias("entity_id"), F.when(F.col("s") == 1, "edge_only_in_work").otherwise("edge_only_in_character").alias("rule"))
    return lost.unionByName(one)


def issues(characters: DataFrame, works: DataFrame, forbidden: str | None = PHRASES) -> DataFrame:
    return character_issues(characters, forbidden).unionByName(work_issues(works, forbidden)).unionByName(edge_issues(characters, works))


def warnings(characters: DataFrame, works: DataFrame) -> DataFrame:
    """(entity_kind, entity_id, rule) of introductions that pass but are thin; they stop nothing."""
    thin = lambda df, kind, key, low: df.select(F.lit(kind).alias("entity_kind"), F.col(key).alias("entity_id"), F.lit("introduction_thin").alias("rule"), F.length(F.coalesce(_stripped(F.col("introduction")), F.lit(""))).alias("n")).where(F.col("n") < low).drop("n")
    return thin(_valid(characters, "id"), "character", "id", 100).unionByName(thin(_valid(works, "workId"), "work", "workId", 80))
