"""Queries over nested values and model-written profiles that are put together from the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import nested as N
from ..operators import profiles as P
from ..sources.scratch import keeper
from ..sources.tables import table
from .catalogue import query


def _events(spark, d):
    """Events as nested documents: the event's own part four levels deep, its properties as they are, a list and a flag."""
    c = F.col
    number = lambda name: F.coalesce(c(name).cast("string"), F.lit("null"))
    doc = F.concat(F.lit('{"event":{"id":'), number("event_id"), F.lit(',"by":{"user":'), number("user_id"), F.lit(',"how":{"kind":"'), c("event_type"), F.lit('","value":'), number("value"), F.lit('}}},"props":'), F.coalesce("props", F.lit("null")), F.lit(',"pair":['), number("user_id"), F.lit(","), number("event_id"), F.lit('],"flag":true}'))
    return table(spark, d, "events").select("event_id", doc.alias("doc"))


@query("""
SELECT event_id, 'event.id' AS path, event_id::DOUBLE AS value FROM events UNION ALL SELECT event_id, 'event.by.user', user_id::DOUBLE FROM events WHERE user_id IS NOT NULL UNION ALL
SELECT event_id, 'event.by.how.value', value FROM events WHERE value IS NOT NULL UNION ALL SELECT event_id, 'props.k', (props->>'$.k')::DOUBLE FROM events WHERE (props->>'$.k') IS NOT NULL""")
def nested_leaves(spark, d):
    """Numbers within objects at any depth, by path; lists, texts and flags are none."""
    return N.numeric_leaves(_events(spark, d), ["event_id"], "doc", keeper(spark))


@query("""
SELECT event_id, event_type AS kind, NULL::DOUBLE AS value, 2 * (props->>'$.k')::BIGINT AS k, user_id AS first, event_id AS second, true AS flag, 'k' AS note FROM events WHERE (props->>'$.k') IS NOT NULL UNION ALL
SELECT event_id, event_type, NULL, NULL, user_id, event_id, true, NULL FROM events WHERE (props->>'$.k') IS NULL""")
def nested_rewrite(spark, d):
    """The event's own numbers cleared, its property doubled and a note put beside it, all by path; then one document again."""
    keep = keeper(spark)
    rows = N.leaves(_events(spark, d), ["event_id"], "doc", keep)
    step = lambda *keys: F.array(*[F.struct(F.lit(k).alias("key"), F.lit(None).cast("int").alias("pos")) for k in keys])
    props = rows.where(F.col("path") == step("props", "k"))
    changes = props.select("event_id", "path", (2 * F.col("json").cast("long")).cast("string").alias("json")).union(props.select("event_id", step("props", "note"), F.lit('"k"')))
    whole = N.nested(N.assigned(N.cleared(rows, ["event"]), changes, ["event_id"], ["event", "props"]), ["event_id"], keep)
    at = lambda path, kind: F.try_variant_get("v", path, kind)
    return whole.select("event_id", F.parse_json("json").alias("v")).select(
        "event_id", at("$.event.by.how.kind", "string").alias("kind"), at("$.event.by.how.value", "double").alias("value"), at("$.props.k", "bigint").alias("k"),
        at("$.pair[0]", "bigint").alias("first"), at("$.pair[1]", "bigint").alias("second"), at("$.flag", "boolean").alias("flag"), at("$.props.note", "string").alias("note"),
    )


def _items(spark, d):
    """Parts as a model would describe them: fields in the wrong place, old names, misspelt keys, facts too many or too few."""
    k, size = F.col("p_partkey"), F.col("p_size")
    lit, pick = F.lit, lambda cond, a, b="": F.when(cond, F.lit(a)).otherwise(F.lit(b))
    score = F.format_string("%.2f", size / 100)
    fact = lambda key, path, more=lit(""): F.concat(lit('{"'), key, lit('":"'), path, lit('","score":'), score, more, lit("}"))
    facts = [
        fact(pick(k % 4 == 0, "imdensionPath", "dimensionPath"), pick(k % 3 == 0, "media_vector.music.tempo", "media_vector.music_vector.tempo")),
        fact(lit("dimensionPath"), pick(k % 2 == 0, "psychology_vector.social.love", "psychology_vector.social_relationship.love")),
        fact(lit("dimensionPath"), lit("media_vector.music_vector.genre")),
        F.when(k % 7 != 0, fact(lit("dimension_path"), lit("experience_vector.joy"))),
        F.when(k % 11 == 0, fact(lit("dimensionPath"), lit("experience_vector.joy"))),
    ]
    evidence = F.array_join(F.array_repeat(lit('"e"'), (size % 12).cast("int")), ",")
    rest = F.concat(
        lit('"experience_vector":{"joy":'), score, lit('},"psychology_vector":{"'), pick(k % 2 == 0, "social", "social_relationship"), lit('":{"love":'), score, lit('}},"media_vector":{"music_vector":{"tempo":'), score, lit(',"genre":"x"}},"vector_facts":['),
        F.concat_ws(",", *facts), lit('],"experience_vector_summary":{'), lit(",".join(f'"{x}":"{x}"' for x in P.SUMMARY[1:])), F.when(k % 13 != 0, lit(f',"{P.SUMMARY[0]}":"felt"')).otherwise(""), lit('},"personality_affinity":{'), lit(",".join(f'"{x}":0.5' for x in P.AFFINITY)), lit('},"supporting_evidence":['), evidence, lit("]"),
    )
    semantic = F.concat(lit('"semantic":{"summary":"'), F.col("p_name"), lit('","themes":[],"keywords":[],"core_experience":"c"'), pick(k % 5 == 0, ',"experience_introduction":"own"'))
    quality = pick(k % 17 != 0, ',"quality_control":{}')
    inside = F.concat(lit('{"basic":{},'), semantic, lit(","), rest, quality, lit("}}"))
    beside = F.concat(lit('{"basic":{"contentId":"own","x":1},'), semantic, lit("},"), rest, quality, lit("}"))
    return table(spark, d, "part").select(k.cast("string").alias("id"), F.when(size % 2 == 0, inside).otherwise(beside).alias("item"))


@query("""
SELECT p_partkey::VARCHAR AS id, CASE WHEN p_size % 2 = 0 THEN '"' || p_partkey || '"' ELSE '"own"' END AS content_id, CASE WHEN p_partkey % 5 = 0 THEN 'own' ELSE p_name || chr(10) || 'felt' END AS introduction,
CASE WHEN p_size % 12 >= 8 THEN 'TRAINABLE' ELSE 'REJECTED' END AS training_status, p_size % 12 >= 8 AS enough, 3::BIGINT AS facts, round(3 * p_size / 100, 4)::DOUBLE AS total
FROM part WHERE (p_partkey % 7 = 0) = (p_partkey % 11 = 0) AND p_partkey % 13 <> 0 AND p_partkey % 17 <> 0""")
def profile_schema(spark, d):
    """What comes through the schema, its identity, introduction and verdict, with the sum of its facts' scores."""
    out = P.enforce(_items(spark, d), "id", "item", "id", keeper(spark))
    scores = out["facts"].groupBy("id").agg(F.round(F.sum("score"), 4).alias("total"))
    rows = out["profiles"].join(scores, "id")
    return rows.select("id", F.col("basic.contentId").alias("content_id"), F.col("semantic.experience_introduction").alias("introduction"), "training_status", (F.size("rejection_reasons") == 0).alias("enough"), "facts", "total")


@query("""
SELECT p_partkey::VARCHAR AS id, 'coverage' AS issue, (CASE WHEN p_partkey % 7 = 0 AND p_partkey % 11 <> 0 THEN 2 ELSE 3 END) || '/' || (3 - (p_partkey % 7 = 0)::INT + (p_partkey % 11 = 0)::INT) || '/3' AS detail FROM part
WHERE (p_partkey % 7 = 0) <> (p_partkey % 11 = 0) UNION ALL
SELECT p_partkey::VARCHAR, 'summary', NULL FROM part WHERE p_partkey % 13 = 0 UNION ALL SELECT p_partkey::VARCHAR, 'fields', 'quality_control' FROM part WHERE p_partkey % 17 = 0""")
def profile_issues(spark, d):
    """Why the others do not: every issue of every item."""
    return P.enforce(_items(spark, d), "id", "item", "id", keeper(spark))["issues"]
