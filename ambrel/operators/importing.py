"""Import of nested character and work documents into the six tables of a store, as one load.

tables_of() turns documents into rows: surrogate keys are hashes of logical ids, so nothing has to be looked up to number
them. import_batch() checks everything before anything is written: the contract, the tables and columns it needs, country
codes, natural keys that other entities in the store already have, and relations to works of earlier batches. What speaks
against the import is a table of problems; if there is one, the import is refused with all counts and some examples, and
no table changes. The checks are part of the load: when another load comes first, they are made again.

A work's creators and tags are replaced by those of its document; a character's own works that are not in the batch become
relations to works in the store, with the orders after the greatest there.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ..functions.scalar import stable_id
from ..sources.scratch import keeper
from . import checks, contract
from . import relational as R
from .runs import Change, Store, digest_of

TABLES = {
    "character": "id long, character_type int, gender int, introduction string, creator long, deleted int",
    "character_name": "id long, character_name string, character_info_id long, top int, language int, creator long, deleted int",
    "real_attribute": "id long, character_info_id long, begin_century int, end_century int, country_id int, field int, sub_type int, dynasty int, creative_entity_type int, creator long, deleted int",
    "work": "id long, work_name string, original_name string, genre int, subcategory int, year int, country_id int, auth_character_id long, introduction string, creator long, deleted int",
    "work_creator": "id long, work_id long, character_id long, relation_type int, sort_order int, creator long",
    "work_subcategory": "id long, work_id long, subcategory int, is_primary int, sort_order int, creator long",
}
COUNTRY = "id int, code string"
EXAMPLES = 20


class ImportRefused(ValueError):
    """What speaks against a load: ``counts`` by problem, and some ``examples``."""

    def __init__(self, counts: dict[str, int], examples: list):
        self.counts, self.examples = counts, examples
        super().__init__(f"{sum(counts.values())} problems: " + ", ".join(f"{k} {n}" for k, n in sorted(counts.items())) + "; such as " + "; ".join(" ".join(map(str, e)) for e in examples[:5]))


def create(store: Store, country: DataFrame) -> None:
    """The store's tables, empty, and its countries."""
    spark = store.spark
    store.commit(lambda read: {t: spark.createDataFrame([], s) for t, s in TABLES.items()} | {"country": country})


def _names(c: Column) -> Column:
    return contract._stripped(c)


def _codes(country: DataFrame) -> DataFrame:
    return country.select(F.col("id").alias("country_id"), F.upper("code").alias("countryCode"))


def _shaped(df: DataFrame, table: str) -> DataFrame:
    kinds = [f.split(" ") for f in TABLES[table].split(", ")]
    return df.select(*[F.col(n).cast(k).alias(n) for n, k in kinds])


def tables_of(characters: DataFrame, works: DataFrame, country: DataFrame, creator: int) -> dict[str, DataFrame]:
    """Rows of the six tables; relations are those of the works' creators alone."""
    c, by, live = F.col, F.lit(creator).alias("creator"), F.lit(0).alias("deleted")
    people = contract._valid(characters, "id").join(_codes(country), "countryCode", "left")
    pieces = contract._valid(works, "workId").join(_codes(country), "countryCode", "left")
    person = stable_id("character", c("id"))
    names = people.select("id", F.posexplode("names").alias("order", "n"))
    tags = F.coalesce("subcategories", F.when(c("subcategory").isNotNull(), F.array("subcategory")), F.array().cast("array<int>"))
    work_id = stable_id("work", c("workId"))
    creators = pieces.select("workId", work_id.alias("work_id"), "creators").select("workId", "work_id", F.explode("creators").alias("r")).select("workId", "work_id", _names(c("r.characterId")).alias("cid"), c("r.relationType").alias("rel"), F.coalesce("r.sortOrder", F.lit(0)).alias("sort_order"))
    own = pieces.select("workId", "subcategory", F.posexplode(tags).alias("sort_order", "tag"))
    empty = lambda x: F.when(c(x) != "", c(x))
    out = {
        "character": people.select(person.alias("id"), F.lit(1).alias("character_type"), "gender", empty("introduction").alias("introduction"), by, live),
        "character_name": names.select(stable_id("character-name", F.concat_ws(":", "id", "order")).alias("id"), _names(c("n.name")).alias("character_name"), person.alias("character_info_id"), F.lit(0).alias("top"), c("n.language").alias("language"), by, live),
        "real_attribute": people.select(stable_id("real-attribute", c("id")).alias("id"), person.alias("character_info_id"), c("beginCentury").alias("begin_century"), c("endCentury").alias("end_century"), "country_id", F.coalesce("field", F.lit(0)).alias("field"), c("realSubType").alias("sub_type"), "dynasty", c("creativeEntityType").alias("creative_entity_type"), by, live),
        "work": pieces.select(work_id.alias("id"), _names(c("workName")).alias("work_name"), empty("originalName").alias("original_name"), "genre", "subcategory", "year", "country_id", stable_id("character", c("primaryAuthorId")).alias("auth_character_id"), empty("introduction").alias("introduction"), by, live),
        "work_creator": creators.select(stable_id("work-creator", F.concat_ws(":", "workId", "cid", "rel")).alias("id"), "work_id", stable_id("character", c("cid")).alias("character_id"), c("rel").alias("relation_type"), "sort_order", by),
        "work_subcategory": own.select(stable_id("work-subcategory", F.concat_ws(":", "workId", "tag")).alias("id"), work_id.alias("work_id"), c("tag").alias("subcategory"), (c("tag") == c("subcategory")).cast("int").alias("is_primary"), "sort_order", by),
    }
    return {t: _shaped(df, t) for t, df in out.items()}


def _problem(df: DataFrame, kind: str, entity: Column, problem: str, detail: Column) -> DataFrame:
    return df.select(F.lit(kind).alias("entity_kind"), entity.cast("string").alias("entity_id"), F.lit(problem).alias("problem"), detail.cast("string").alias("detail"))


def natural_key_conflicts(characters: DataFrame, works: DataFrame, read) -> DataFrame:
    """Entities whose names, or whose name, genre, year and country, another entity in the store has.

    The store is summed up by key first, so that a name many share makes no pairs: another entity has the key if the least or
    the greatest id there is not the entity's own.
    """
    c = F.col
    people, pieces = contract._valid(characters, "id"), contract._valid(works, "workId")
    ends = lambda df, by, id_: df.groupBy(*by).agg(F.min(id_).alias("low"), F.max(id_).alias("high"))
    other = (c("low") != c("expected")) | (c("high") != c("expected"))
    named = R.present(read("character_name")).select(F.trim("character_name").alias("name"), "language", "character_info_id")
    new = people.select("id", stable_id("character", c("id")).alias("expected"), F.explode("names").alias("n")).select("id", "expected", _names(c("n.name")).alias("name"), c("n.language").alias("language"))
    of_people = new.join(ends(named, ["name", "language"], "character_info_id"), ["name", "language"]).where(other)
    there = R.present(read("work")).select(F.trim("original_name").alias("name"), "genre", c("year").alias("y"), c("country_id").alias("k"), "id")
    country = _codes(read("country"))
    mine = pieces.join(country, "countryCode", "left").select("workId", stable_id("work", c("workId")).alias("expected"), _names(F.coalesce(F.when(c("originalName") != "", c("originalName")), c("workName"))).alias("name"), "genre", "year", "country_id")
    found = ends(there, ["name", "genre", "y", "k"], "id").withColumnsRenamed({"name": "__name", "genre": "__genre"})
    of_works = mine.join(found, (c("name") == c("__name")) & (c("genre") == c("__genre")) & c("year").eqNullSafe(c("y")) & c("country_id").eqNullSafe(c("k"))).where(other)
    return _problem(of_people, "character", c("id"), "natural_key", c("name")).union(_problem(of_works, "work", c("workId"), "natural_key", c("name")))


def cross_batch(characters: DataFrame, works: DataFrame, read, creator: int) -> tuple[DataFrame, DataFrame]:
    """Relations of the characters to works of earlier batches, as rows of work_creator, and what speaks against them.

    A work must be there, not deleted, and of a genre that the relation suits. Orders go on from the work's greatest, by the
    characters' position and the place in their lists; a relation that is there already moves to the end.
    """
    c = F.col
    people, pieces = contract._valid(characters, "id"), contract._valid(works, "workId")
    own = people.select("id", "position", F.posexplode("ownWork").alias("at", "w")).select("id", "position", "at", c("w.workId").alias("workId"), c("w.relationType").alias("rel"))
    outside = own.join(pieces.select("workId"), "workId", "left_anti").withColumn("work_id", stable_id("work", c("workId")))
    there = R.present(read("work")).select(c("id").alias("work_id"), "genre", F.lit(True).alias("there"))
    known = outside.join(there, "work_id", "left")
    lost = _problem(known.where("there is null"), "character", c("id"), "work_unknown", c("workId"))
    unsuited = _problem(known.where(c("there") & ~contract.suits_genre(c("rel"), c("genre"))), "character", c("id"), "relation_genre", c("workId"))
    base = read("work_creator").join(outside.select("work_id").distinct(), "work_id", "left_semi").groupBy("work_id").agg(F.max("sort_order").alias("top"))
    order = F.row_number().over(W.partitionBy("work_id").orderBy("position", "id", "at"))
    rows = known.where("there").join(base, "work_id", "left").withColumn("sort_order", F.coalesce("top", F.lit(-1)) + order)
    rows = rows.select(stable_id("work-creator", F.concat_ws(":", "workId", "id", "rel")).alias("id"), "work_id", stable_id("character", c("id")).alias("character_id"), c("rel").alias("relation_type"), "sort_order", F.lit(creator).alias("creator"))
    return _shaped(rows, "work_creator"), lost.union(unsuited)


def problems(characters: DataFrame, works: DataFrame, read, creator: int = 1, forbidden: str | None = contract.PHRASES) -> DataFrame:
    """(entity_kind, entity_id, problem, detail): all that speaks against importing the documents."""
    c = F.col
    issues = contract.issues(characters, works, forbidden).select("entity_kind", "entity_id", c("rule").alias("problem"), F.lit(None).cast("string").alias("detail"))
    codes = _codes(read("country"))
    without = lambda df, kind, key: _problem(contract._valid(df, key).where("countryCode is not null").join(codes, "countryCode", "left_anti"), kind, c(key), "country_unknown", c("countryCode"))
    parts = [issues, without(characters, "character", "id"), without(works, "work", "workId"), natural_key_conflicts(characters, works, read), cross_batch(characters, works, read, creator)[1]]
    return reduce(DataFrame.union, parts)


def refuse_if_any(found: DataFrame) -> None:
    """Raise ImportRefused if there is a problem. Counts are by kind of problem; examples are few."""
    counts = {r["problem"]: r["n"] for r in found.groupBy("problem").agg(F.count(F.lit(1)).alias("n")).collect()}
    if counts:
        raise ImportRefused(counts, [tuple(r) for r in found.orderBy(*found.columns).limit(EXAMPLES).collect()])


def kept_documents(characters: DataFrame, works: DataFrame, keep) -> tuple[DataFrame, DataFrame]:
    """The documents, computed once, as problems() and tables_of() read them several times."""
    return keep(contract.numbered(characters, "id")), keep(contract.numbered(works, "workId"))


def import_batch(store: Store, name: str, characters: DataFrame, works: DataFrame, creator: int = 1, forbidden: str | None = contract.PHRASES) -> dict:
    """Load the documents as one run, or refuse; its manifest, with the numbers of rows loaded as ``result``.

    The documents are computed once and kept, numbered by id, since every check and every table reads them.
    """
    store.require({t: [f.split(" ")[0] for f in s.split(", ")] for t, s in TABLES.items()} | {"country": ["id", "code"]})
    characters, works = kept_documents(characters, works, keeper(store.spark))

    def changes(read):
        refuse_if_any(problems(characters, works, read, creator, forbidden))
        rows = tables_of(characters, works, read("country"), creator)
        across, _ = cross_batch(characters, works, read, creator)
        parents = rows["work"].select(F.col("id").alias("work_id"))
        rows["work_creator"] = rows["work_creator"].union(across)
        replaced = {"work_creator", "work_subcategory"}
        return {t: Change(df, "id", None, "work_id", parents) if t in replaced else Change(df, "id") for t, df in rows.items()}

    run = store.load(name, changes, inputs=digest_of(characters.drop("__n"), works.drop("__n")))
    loaded = {t: store._change(at) for t, at in run["tables"].items()}
    n = {t: c.rows.count() for t, c in loaded.items()}
    across = loaded["work_creator"].rows.join(loaded["work_creator"].parents, "work_id", "left_anti").count()
    result = {"characters": n["character"], "works": n["work"], "relations": n["work_creator"], "crossBatchRelations": across, "subcategoryTags": n["work_subcategory"]}
    return store._mark(run, run["status"], result=result)


def run_status(store: Store, run: str) -> DataFrame:
    """(kind, name, n) of a run: rows there and missing by table, the strong checks and broken relations of what it loaded.

    The row ("passed", name of the run, 1 or 0) says whether nothing is missing and no check counts anything.
    """
    tracked, c = store.tracked(run), F.col
    rows = store.status(run).select(F.explode(F.array(F.struct(F.lit("rows").alias("kind"), c("table").alias("name"), (c("tracked") - c("missing")).alias("n")), F.struct(F.lit("missing").alias("kind"), c("table").alias("name"), c("missing").alias("n")))).alias("x")).select("x.*")
    snapshot = store.snapshot()[1]
    t = {name: store._at(snapshot, name) for name in [*TABLES, "country"]}
    found = checks.strong_checks(t["character"], t["character_name"], t["real_attribute"], t["country"], t["work"], t["work_creator"], t["work_subcategory"], tracked["character"], tracked["work"])
    found = found.select(F.lit("check").alias("kind"), c("check").alias("name"), "n")
    broken = checks.broken_relations(t["character"], t["work"], t["work_creator"], tracked["work"]).select(F.lit("check").alias("kind"), F.lit("brokenRelations").alias("name"), "n")
    told = rows.union(found).union(broken)
    row = lambda kind, name, n: F.struct(kind.alias("kind"), name.alias("name"), n.cast("long").alias("n"))
    wrong = F.coalesce(F.sum(F.when(c("kind") != "rows", c("n"))), F.lit(0))
    once = told.agg(F.collect_list(row(c("kind"), c("name"), c("n"))).alias("told"), row(F.lit("passed"), F.lit(run), wrong == 0).alias("passed"))  # a row a check, made once for both
    return once.select(F.explode(F.array_append("told", c("passed"))).alias("x")).select("x.*")
