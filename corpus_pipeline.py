"""From raw documents to packed sequences: five stages over tables.

Quality rules turn documents away, near-duplicates leave one of each class,
secrets are taken out of the texts, sources are mixed to their target weights,
and what results is packed. All stages but the last return the columns of
documents; repeated documents of the mix are rows of their own. Further columns
pass through as they are, whatever they are called; secrets change text and
n_chars alone.

Null texts fail the base quality rules, as do empty ones; null ids, sources and
languages are kept as the stages' operators say; texts of any length are read
whole; of repeated rows one stays after the near-duplicate stage. An empty table
gives no rows at every stage. What a stage has written for itself is deleted when
its result is written, and each stage's result when the next one's is.
"""

from __future__ import annotations

from ambrel.llm import common, mixing, neardup, packing, quality, secrets


def quality_stage(spark, docs, sf_dir):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return common.shielded(docs, ["doc_id", "text", "lang"], lambda named: quality.quality_rules(named, labels).where("kept"))


def near_dedup_stage(spark, docs, sf_dir):
    return neardup.deduplicate(docs)


def secrets_stage(spark, docs, sf_dir):
    return secrets.clean(docs)


def mixing_stage(spark, docs, sf_dir):
    rates = mixing.source_rates(docs)
    return common.shielded(docs, ["doc_id", "source"], lambda named: mixing.poisson_replicate(named, rates))


def packing_stage(spark, docs, sf_dir):
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("secret_scan", secrets_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]
#: Signatures, tokenizers and the packing plan have no SQL.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), common.made_so_far()
    for name, stage in STAGES:
        path = common.new_path(spark, f"stage-{name}")
        result = stage(spark, docs, sf_dir)
        result.write.parquet(path)
        docs = spark.read.schema(result.schema).parquet(path)
        common.clear(spark, before, keep=(path,))
    return docs
