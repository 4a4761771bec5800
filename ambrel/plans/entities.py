"""Entity queries: the contract and the checks of a loaded store over documents derived from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as H
from ..operators import contract as C
from ..operators import relational as R
from ..sources.tables import table
from .catalogue import query

_PEOPLE = """
SELECT concat('realCharacter_abc_', c_custkey % 3000, '_', lpad((c_custkey % 1000)::VARCHAR, 3, '0')) AS id, c_custkey AS position, 1 + (c_nationkey = 8)::INT AS characterType,
c_nationkey % 4 AS realSubType, c_nationkey % 12 AS creativeEntityType, c_nationkey % 6 AS gender, CASE WHEN c_nationkey % 3 = 0 THEN 'CHN' WHEN c_nationkey % 3 = 1 THEN 'usa' END AS countryCode,
c_nationkey % 13 AS field, nullif(c_nationkey, 5) AS dynasty, CASE WHEN c_nationkey <> 11 THEN c_custkey % 3000 END AS beginYear, c_custkey % 2500 AS endYear,
CASE WHEN c_nationkey % 5 = 0 THEN 0 ELSE c_nationkey % 7 END AS language, c_custkey % 90 AS n FROM customer
QUALIFY row_number() OVER (PARTITION BY concat(c_custkey % 3000, '_', c_custkey % 1000) ORDER BY c_custkey) = 1"""
_RULES = {
    "character_type": "characterType <> 1",
    "real_sub_type": "realSubType NOT IN (1, 2)",
    "entity_type": "creativeEntityType NOT BETWEEN 1 AND 10",
    "gender": "gender NOT BETWEEN 0 AND 3",
    "organisation_gender": "creativeEntityType BETWEEN 2 AND 10 AND gender <> 0",
    "field": "field > CASE WHEN realSubType = 2 THEN 10 ELSE 8 END",
    "dynasty": "dynasty IS NOT NULL AND (dynasty NOT BETWEEN 1 AND 21 OR dynasty = 8)",
    "country_code": "countryCode IS NOT NULL AND NOT regexp_full_match(countryCode, '[A-Z]{3}')",
    "china_country": "realSubType = 2 AND countryCode IS DISTINCT FROM 'CHN'",
    "china_dynasty": "realSubType = 2 AND dynasty IS NULL",
    "world_dynasty": "realSubType = 1 AND dynasty IS NOT NULL",
    "begin_year": "beginYear = 0 OR beginYear > 2100",
    "end_year": "endYear = 0 OR endYear > 2100",
    "year_order": "endYear < beginYear",
    "id_year": "beginYear IS NULL",
    "name_language": "language > 3",
    "name_duplicate": "language = 0",
    "name_standard_twice": "language = 0",
    "introduction_missing": "n = 0",
    "introduction_short": "n BETWEEN 1 AND 59",
    "own_work_missing": "language = 6",
}


@query("WITH p AS (" + _PEOPLE + ") SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) AS n FROM p WHERE {w}" for r, w in _RULES.items()) + " UNION ALL SELECT 'duplicate_id', (SELECT count(*) FROM customer) - (SELECT count(*) FROM p)) WHERE n > 0")
def entity_contract(spark, d):
    """Customers as character documents under the whole contract, issues counted by rule."""
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("int")
    year = lambda c: c.cast("int")
    language = F.when(n % 5 == 0, 0).otherwise(n % 7)
    name = lambda lang, text: F.struct(lang.cast("int").alias("language"), text.alias("name"))
    people = table(spark, d, "customer").select(
        F.concat(F.lit("realCharacter_abc_"), (k % 3000).cast("string"), F.lit("_"), F.lpad((k % 1000).cast("string"), 3, "0")).alias("id"),
        F.when(n == 8, 2).otherwise(1).alias("characterType"), (n % 4).alias("realSubType"), (n % 12).alias("creativeEntityType"), (n % 6).alias("gender"),
        F.when(n % 3 == 0, "CHN").when(n % 3 == 1, "usa").alias("countryCode"), (n % 13).alias("field"), F.nullif(n, F.lit(5)).alias("dynasty"),
        F.when(n != 11, year(k % 3000)).alias("beginCentury"), year(k % 2500).alias("endCentury"),
        F.array(name(F.lit(0), F.col("c_name")), name(language, F.concat(F.lit(" "), F.upper("c_name")))).alias("names"),
        F.rpad(F.lit(""), (k % 90).cast("int"), F.lit("x")).alias("introduction"),
        F.when(language != 6, F.array().cast("array<struct<workId:string,relationType:int>>")).alias("ownWork"), k.cast("long").alias("position"),
    )
    return C.character_issues(people).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


_STORE = f"""
WITH name AS (SELECT c_custkey AS id, c_custkey % 6 AS language, (c_custkey % 11 = 0)::INT AS deleted FROM customer UNION ALL SELECT c_custkey, 0, 0 FROM customer),
attribute AS (SELECT c_nationkey % 4 AS sub_type, nullif(c_nationkey % 13, 7) AS field, nullif(c_nationkey % 24, 5) AS dynasty, c_nationkey % 12 AS entity, CASE WHEN n_nationkey < 12 THEN 'CHN' WHEN n_nationkey <> 6 THEN 'USA' END AS code, (c_custkey % 7 = 0)::INT AS deleted FROM customer LEFT JOIN nation ON n_nationkey = nullif(c_nationkey, 6)),
live AS (SELECT * FROM attribute WHERE deleted = 0),
work AS (SELECT p_partkey AS id, nullif(p_size % 15, 13) AS genre, nullif((p_size % 15) * 1000 + p_size % 20, 4009) AS own FROM part),
relation AS (SELECT l_partkey AS work_id, l_suppkey AS character_id, l_linenumber * 6 % 40 AS r FROM lineitem WHERE l_partkey % 5 <> 0),
tag AS (SELECT id AS work_id, own AS t, 1 AS main FROM work WHERE own IS NOT NULL UNION ALL SELECT id, coalesce(genre, 0) * 1000 + 1 + id % 9, (id % 7 = 0)::INT FROM work),
spans(g, a, b) AS (VALUES {', '.join(f'({g}, {a}, {b})' for g, (a, b) in C.SUBCATEGORIES.items())}),
allowed(r, g) AS (VALUES {', '.join(f'({r}, {g})' for r, gs in C.RELATION_GENRES.items() for g in gs)})
"""
_CHECKS = {
    "invalidNameLanguage": "name WHERE language NOT IN (0, 1, 2, 3)",
    "duplicateStandardNames": "(SELECT 1 FROM name WHERE deleted = 0 AND language IN (0, 1, 2) GROUP BY id, language HAVING count(*) > 1)",
    "invalidRealSubtype": "live WHERE sub_type NOT IN (1, 2)",
    "chinaWrongCountry": "live WHERE sub_type = 2 AND (code IS NULL OR code <> 'CHN')",
    "invalidCreativeEntityType": "live WHERE entity NOT BETWEEN 1 AND 10",
    "invalidField": "live WHERE (sub_type = 2 AND field NOT BETWEEN 0 AND 10) OR (sub_type = 1 AND field NOT BETWEEN 0 AND 8)",
    "invalidDynasty": "live WHERE dynasty = 8 OR dynasty NOT BETWEEN 1 AND 21 OR (sub_type = 1 AND dynasty IS NOT NULL)",
    "chinaMissingDynasty": "live WHERE sub_type = 2 AND dynasty IS NULL",
    "invalidGender": "customer WHERE c_nationkey % 6 NOT IN (0, 1, 2, 3)",
    "duplicateRelations": "(SELECT 1 FROM relation GROUP BY work_id, character_id, r HAVING count(*) > 1)",
    "virtualCreators": "relation JOIN customer ON c_custkey = character_id WHERE c_nationkey IN (4, 9)",
    "invalidRelationGenre": "work w JOIN relation ON w.id = work_id WHERE r NOT IN (1, 99) AND NOT EXISTS (SELECT 1 FROM allowed a WHERE a.r = relation.r AND a.g = w.genre)",
    "invalidSubcategoryGenre": "work w LEFT JOIN relation ON w.id = work_id WHERE own IS NOT NULL AND NOT EXISTS (SELECT 1 FROM spans WHERE g = w.genre AND own BETWEEN a AND b)",
    "invalidTagGenre": "tag JOIN work w ON w.id = work_id WHERE NOT EXISTS (SELECT 1 FROM spans WHERE g = w.genre AND t BETWEEN a AND b)",
    "invalidPrimaryTag": "tag JOIN work w ON w.id = work_id WHERE main = 1 AND t IS DISTINCT FROM own",
    "missingOrDuplicatePrimaryTag": "(SELECT 1 FROM work LEFT JOIN tag ON work_id = work.id AND main = 1 WHERE own IS NOT NULL GROUP BY work.id HAVING count(main) <> 1)",
    "brokenRelations": "relation LEFT JOIN customer ON c_custkey = character_id LEFT JOIN work ON work.id = work_id WHERE c_custkey IS NULL OR work.id IS NULL",
}


def _store(spark, d):
    """Customers as characters, parts as works, lines as relations."""
    n, c = F.col("c_nationkey").cast("int"), F.col
    people, parts, lines = table(spark, d, "customer"), table(spark, d, "part"), table(spark, d, "lineitem")
    mark = lambda m: F.when(c("c_custkey") % m == 0, 1).otherwise(0).alias("deleted")
    key = c("c_custkey").alias("character_info_id")
    genre = F.nullif((c("p_size") % 15).cast("int"), F.lit(13))
    own = (c("p_size") % 15 * 1000 + c("p_size") % 20).cast("int")
    work = parts.select(c("p_partkey").alias("id"), genre.alias("genre"), F.nullif(own, F.lit(4009)).alias("subcategory"))
    more = work.select(c("id").alias("work_id"), (F.coalesce("genre", F.lit(0)) * 1000 + 1 + c("id") % 9).cast("int").alias("subcategory"), F.when(c("id") % 7 == 0, 1).otherwise(0).alias("is_primary"))
    return {
        "character": people.select(c("c_custkey").alias("id"), F.when(n == 4, 2).otherwise(1).alias("character_type"), (n % 6).alias("gender"), F.when(n == 9, 1).otherwise(0).alias("deleted")),
        "name": people.select(key, (c("c_custkey") % 6).cast("int").alias("language"), mark(11)).union(people.select(key, F.lit(0), F.lit(0))),
        "attribute": people.select(key, (n % 4).alias("sub_type"), F.nullif(n % 13, F.lit(7)).alias("field"), F.nullif(n % 24, F.lit(5)).alias("dynasty"), (n % 12).alias("creative_entity_type"), F.nullif(n, F.lit(6)).alias("country_id"), mark(7)),
        "country": table(spark, d, "nation").select(c("n_nationkey").cast("int").alias("id"), F.when(c("n_nationkey") < 12, "CHN").otherwise("USA").alias("code")),
        "work": work,
        "relation": lines.where("l_partkey % 5 <> 0").select(c("l_partkey").alias("work_id"), c("l_suppkey").alias("character_id"), (c("l_linenumber") * 6 % 40).cast("int").alias("relation_type")),
        "tag": work.where("subcategory is not null").select(c("id").alias("work_id"), "subcategory", F.lit(1).alias("is_primary")).union(more),
    }


@query(_STORE + " UNION ALL ".join(f"SELECT '{c}' AS \"check\", count(*) AS n FROM {w}" for c, w in _CHECKS.items()))
def store_checks(spark, d):
    """What a loaded store is asked for at each status, over all its rows; some works have no relation."""
    store = _store(spark, d)
    broken = H.broken_relations(store["character"], store["work"], store["relation"]).select(F.lit("brokenRelations").alias("check"), "n")
    return H.strong_checks(**store).union(broken)


@query("SELECT s_suppkey, CASE WHEN s_nationkey < 20 THEN s_suppkey + 1000000 ELSE s_suppkey END AS new_key, CASE WHEN s_nationkey < 20 THEN 'resolved' ELSE 'pending' END AS state FROM supplier")
def remap_ids(spark, d):
    """Suppliers under their new keys; those that the mapping lacks keep theirs and wait."""
    suppliers = table(spark, d, "supplier")
    mapping = suppliers.where("s_nationkey < 20").select(F.col("s_suppkey").alias("old"), (F.col("s_suppkey") + 1000000).alias("new"))
    return R.remapped(suppliers.select("s_suppkey"), mapping, "s_suppkey", "new_key")


_PIECES = f"""
WITH p AS (SELECT p_partkey AS k, p_size AS z, p_size % 16 AS g, (p_size % 16) * 1000 + p_size % 20 AS own, CASE WHEN p_size = 42 THEN 1 ELSE p_size % 40 END AS r, p_partkey % 60 AS n FROM part),
spans(g, a, b) AS (VALUES {', '.join(f'({g}, {a}, {b})' for g, (a, b) in C.SUBCATEGORIES.items())}),
allowed(r, g) AS (VALUES {', '.join(f'({r}, {g})' for r, gs in C.RELATION_GENRES.items() for g in gs)}),
q AS (SELECT p.*, p.g IN {C.GENRES} AS real, EXISTS (SELECT 1 FROM spans s WHERE s.g = p.g AND own BETWEEN a AND b) AS fits, EXISTS (SELECT 1 FROM spans s WHERE s.g = p.g AND p.g * 1000 + 1 BETWEEN a AND b) AS first, EXISTS (SELECT 1 FROM allowed a WHERE a.r = p.r AND a.g = p.g) AS suits FROM p)"""
_WORK_RULES = {
    "id_pattern": "z = 50", "work_name": "z = 49", "original_name": "z = 48", "genre": "NOT real", "subcategory": "NOT fits", "tag": "NOT fits OR (z % 5 = 0 AND z <> 47 AND NOT first)", "tag_duplicate": "z = 47 OR (z % 5 = 0 AND own = g * 1000 + 1)",
    "year": "z = 46", "country_code": "z = 45", "creators_empty": "z = 44", "relation_type": "z <> 44 AND NOT (r BETWEEN 1 AND 35 OR r = 99)", "relation_genre": "z <> 44 AND r BETWEEN 2 AND 35 AND NOT suits", "sort_order": "z = 43", "creator_duplicate": "z = 42",
    "primary_author": "z = 41", "introduction_missing": "n = 0", "introduction_short": "n BETWEEN 1 AND 39",
}


@query(_PIECES + " SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{r}' AS rule, count(*) AS n FROM q WHERE {w}" for r, w in _WORK_RULES.items()) + ") WHERE n > 0")
def work_contract(spark, d):
    """Parts as work documents under the whole contract, issues counted by rule."""
    k, z, lit = F.col("p_partkey"), F.col("p_size").cast("int"), F.lit
    genre = z % 16
    own, creator = genre * 1000 + z % 20, lambda n, r, o: F.struct(lit(f"realCharacter_abc_1000_00{n}").alias("characterId"), r.cast("int").alias("relationType"), o.cast("int").alias("sortOrder"))
    second = F.when(z == 42, creator(1, lit(1), lit(1))).otherwise(creator(2, z % 40, F.when(z == 43, 5).otherwise(1)))
    works = table(spark, d, "part").select(
        F.when(z == 50, F.concat(lit("bad"), k.cast("string"))).otherwise(F.concat(lit("work_abc_"), (1 + F.floor(k / 1000)).cast("string"), lit("_"), F.lpad((k % 1000).cast("string"), 3, "0"))).alias("workId"),
        F.when(z != 49, F.col("p_name")).alias("workName"), F.when(z == 48, " ").alias("originalName"), genre.alias("genre"), own.alias("subcategory"), F.when(z == 47, F.array(own, own)).when(z % 5 == 0, F.array(own, genre * 1000 + 1)).alias("subcategories"),
        F.when(z == 46, 0).otherwise(1900).alias("year"), F.when(z == 45, "usa").otherwise("USA").alias("countryCode"), F.rpad(lit(""), (k % 60).cast("int"), lit("x")).alias("introduction"), F.when(z == 41, "nobody").alias("primaryAuthorId"),
        F.when(z != 44, F.array(creator(1, lit(1), lit(0)), second)).alias("creators"), k.cast("long").alias("position"),
    )
    return C.work_issues(works).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
