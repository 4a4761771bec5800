"""Projection of profiles onto traits: observed values and words found in the texts, calibrated across all profiles.

A model is a few small tables: which leaves a trait is the mean of (some the other way round), which terms speak for it, groups
of terms that add to or take from a trait up to a cap, and boosts by kind. Terms are all looked for in one pass over a text, by
an automaton that is built once a task, so a model may have thousands of them. What is not observed is left out of a mean,
never taken for a middle; a trait with nothing observed has the mean 0.5.

A text that is null has no terms. Kinds without a boost add nothing. Ids are a key of the texts; leaves without a number are
not observed. An empty table gives no rows.
"""

from __future__ import annotations

import dataclasses

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .evaluation import logistic_score

TERM_BYTES = 1 << 24


@dataclasses.dataclass(frozen=True)
class Model:
    """``leaves``: trait -> paths, "-" before one that counts the other way round; ``terms``: trait -> terms, for traits that
    are blended; ``groups``: (trait, terms, each, cap), each < 0 to take away; ``boosts``: kind -> trait -> value."""

    leaves: dict[str, list[str]]
    terms: dict[str, list[str]]
    groups: list[tuple[str, list[str], float, float]] = dataclasses.field(default_factory=list)
    boosts: dict[str, dict[str, float]] = dataclasses.field(default_factory=dict)
    observed_share: float = 0.48
    enough: int = 2


def found_terms(df: DataFrame, by: list[str], text: str, terms: list[str]) -> DataFrame:
    """``by`` and found: the numbers of all ``terms`` that a text holds, each once, in order."""
    if sum(len(t.encode()) for t in terms) > TERM_BYTES:
        raise ValueError(f"terms of more than {TERM_BYTES} bytes")
    kinds = dict(df.dtypes)

    def run(batches):
        import ahocorasick

        machine, known = ahocorasick.Automaton(), {}
        for i, t in enumerate(terms):
            known.setdefault(t, []).append(i)
        for t, numbers in known.items():
            if t:
                machine.add_word(t, tuple(numbers))
        if len(machine):
            machine.make_automaton()
        always = known.get("", [])  # every text holds the empty one
        for batch in batches:
            out = [sorted({i for _, numbers in machine.iter(t) for i in numbers} | set(always)) if t is not None and len(machine) else always if t is not None else [] for t in batch.column(text).to_pylist()]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in by], pa.array(out, pa.list_(pa.int32()))], [*by, "found"])

    return df.select(*by, text).mapInArrow(run, ", ".join(f"{c} {kinds[c]}" for c in by) + ", found array<int>")


def raw_traits(texts: DataFrame, leaves: DataFrame, model: Model) -> DataFrame:
    """(id, trait, raw) of every row of ``texts`` (id, kind, text), each trait once; ``leaves`` has id, path and value."""
    spark, c = texts.sparkSession, F.col
    rows = [(p.removeprefix("-"), t, p.startswith("-")) for t, paths in model.leaves.items() for p in paths]
    weights = F.broadcast(spark.createDataFrame(rows, "path string, trait string, inverse boolean"))  # the model's own size
    means = leaves.join(weights, "path").groupBy("id", "trait").agg(F.avg(F.when(c("inverse"), 1 - c("value")).otherwise(c("value"))).alias("mean"))
    means = means.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("trait", F.coalesce("mean", F.lit(0.5))))).alias("means"))
    terms = sorted({x for xs in model.terms.values() for x in xs} | {x for _, xs, _, _ in model.groups for x in xs})
    number = {x: i for i, x in enumerate(terms)}
    hits = lambda xs: F.size(F.array_intersect("found", F.array(*[F.lit(number[x]) for x in dict.fromkeys(xs)]).cast("array<int>")))
    found = found_terms(texts, ["id", "kind"], "text", terms)
    joined = found.join(means, "id", "left")
    boosts = F.create_map(*[y for kind, by in model.boosts.items() for y in (F.lit(kind), F.create_map(*[z for t, v in by.items() for z in (F.lit(t), F.lit(float(v)))]))]) if model.boosts else None
    out = []
    for trait in model.leaves:
        raw = F.coalesce(F.try_element_at("means", F.lit(trait)), F.lit(0.5))
        if trait in model.terms:
            raw = model.observed_share * raw + (1 - model.observed_share) * F.least(F.lit(1.0), hits(model.terms[trait]) / model.enough)
        for of, xs, each, cap in model.groups:
            if of == trait:
                raw = raw + (1 if each > 0 else -1) * F.least(F.lit(cap), hits(xs) * abs(each))
        if boosts is not None:
            raw = raw + F.coalesce(F.try_element_at(F.try_element_at(boosts, c("kind")), F.lit(trait)), F.lit(0.0))
        out.append(F.struct(F.lit(trait).alias("trait"), raw.alias("raw")))
    return joined.select("id", F.explode(F.array(*out)).alias("x")).select("id", "x.*")


def calibrated_traits(raw: DataFrame, floor: float = 0.025, stretch: float = 1.15) -> DataFrame:
    """(id, trait, raw, score): raw values against mean and deviation of their trait over all ids."""
    stats = raw.groupBy("trait").agg(F.avg("raw").alias("mean"), F.greatest(F.stddev_pop("raw"), F.lit(floor)).alias("sd"))  # a row a trait
    return raw.join(stats, "trait").select("id", "trait", "raw", F.round(logistic_score((F.col("raw") - F.col("mean")) / (F.col("sd") * stretch)), 2).alias("score"))


def issues(scores: DataFrame, traits: list[str], current: DataFrame) -> DataFrame:
    """(id, issue, detail): traits that lack or are unknown or there twice, scores outside [0, 1], ids that are not ``current``."""
    c = F.col
    one = scores.groupBy("id").agg(F.sort_array(F.collect_list("trait")).alias("have"))
    whole = F.array(*map(F.lit, sorted(traits)))
    parts = [
        one.where(F.size(F.array_except(whole, c("have"))) > 0).select("id", F.lit("trait_missing").alias("issue"), F.array_join(F.array_except(whole, c("have")), ",").alias("detail")),
        one.where(F.size(F.array_except("have", whole)) > 0).select("id", F.lit("trait_unknown"), F.array_join(F.array_except("have", whole), ",")),
        one.where(F.size("have") > F.size(F.array_distinct("have"))).select("id", F.lit("trait_twice"), F.lit(None).cast("string")),
        scores.where(~F.coalesce(c("score").between(0, 1) & ~F.isnan("score"), F.lit(False))).select("id", F.lit("score"), c("trait")),
        one.select("id").join(current.select("id"), "id", "left_anti").select("id", F.lit("not_current"), F.lit(None).cast("string")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.union(p)
    return out


def replaced(old: DataFrame, scores: DataFrame, systems: dict[str, int], confidence: float, model: str, version: str) -> DataFrame:
    """``old`` projections (id, system, trait, score, confidence, model, version) with those of the scores' ids in the systems replaced."""
    system = F.create_map(*[x for t, s in systems.items() for x in (F.lit(t), F.lit(s))])[F.col("trait")]
    new = scores.select("id", system.alias("system"), "trait", "score", F.lit(confidence).alias("confidence"), F.lit(model).alias("model"), F.lit(version).alias("version"))
    gone = scores.select("id").distinct().withColumn("system", F.explode(F.array(*[F.lit(s) for s in sorted(set(systems.values()))])))
    return old.join(gone, ["id", "system"], "left_anti").select(*new.columns).unionByName(new)
