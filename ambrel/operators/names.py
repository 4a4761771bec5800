"""Groups of names that may be one name: same base without affixes, same but for case, contained, same core of a script.

Each strategy gives links (a, b) through a key, not all pairs of a group: every name is linked to its group's least
name. Links are merged by hash-partitioned star contraction, which never brings a component to one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HAN = r"[^\x{3400}-\x{9fff}]"


def without_affixes(name: Column, suffixes: list[str] = (), prefixes: list[str] = ()) -> Column:
    """Lower case, white space collapsed, one affix of each kind taken off (the longest), unless nothing would stay."""
    quoted = lambda words: "|".join("\\Q" + w.lower() + "\\E" for w in sorted(words, key=len, reverse=True))
    bare = F.lower(F.regexp_replace(F.regexp_replace(name, r"(?U)\s+", " "), "^ | $", ""))
    if suffixes:
        bare = F.regexp_replace(bare, rf"(?s)(?<=.)(?U)\s*(?:{quoted(suffixes)})$", "")
    if prefixes:
        bare = F.regexp_replace(bare, rf"(?s)^(?:{quoted(prefixes)})(?U)\s*(?=.)", "")
    return bare


def core(name: Column) -> Column:
    """The Han characters of a name."""
    return F.regexp_replace(name, HAN, "")


def linked_by(names: DataFrame, name: str, key: Column, strategy: str) -> DataFrame:
    """(strategy, a, b): each name of a key with the least of them; groups of one give none, null and empty keys neither."""
    keyed = names.select(F.col(name).alias("b"), key.alias("k")).where("b is not null and k <> ''").distinct()
    least = keyed.groupBy("k").agg(F.min("b").alias("a"))
    return keyed.join(least.hint("merge"), "k").where("a <> b").select(F.lit(strategy).alias("strategy"), "a", "b")


def contained(names: DataFrame, name: str, least: int = 2) -> DataFrame:
    """(strategy, a, b): a stands within b, regardless of case. Joined on the shorter name's rarest bigram, then tested."""
    n = names.select(F.col(name).alias("name"), F.lower(name).alias("low")).where(F.length("low") >= max(least, 2)).distinct()
    grams = n.select("name", "low", F.explode(F.array_distinct(F.transform(F.sequence(F.lit(1), F.length("low") - 1), lambda i: F.substring("low", i, F.lit(2))))).alias("g"))
    seen = grams.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    rare = grams.join(seen, "g").groupBy("name", "low").agg(F.min(F.struct("n", "g"))["g"].alias("g"))
    pairs = rare.select(F.col("name").alias("a"), F.col("low").alias("al"), "g").join(grams.select(F.col("name").alias("b"), F.col("low").alias("bl"), "g"), "g")
    return pairs.where((F.col("al") != F.col("bl")) & F.contains("bl", "al")).select(F.lit("subset").alias("strategy"), "a", "b")


def components(links: DataFrame, keep) -> DataFrame:
    """(node, component): the least node that links reach; ``keep`` writes a round's labels and cuts lineage.

    Min-label propagation with a jump (a label takes its own label's label), so rounds grow with the logarithm of a chain.
    Labels are joined by key alone, never broadcast: every round would send them to the driver.
    """
    both = keep(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct())
    labels = keep(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component")))
    while True:
        offers = both.join(labels.withColumnRenamed("node", "b").hint("merge"), "b").select(F.col("a").alias("node"), "component")
        near = labels.union(offers).groupBy("node").agg(F.min("component").alias("component"))
        jump = labels.select(F.col("node").alias("component"), F.col("component").alias("further"))
        following = keep(near.join(jump.hint("merge"), "component", "left").select("node", F.least("component", "further").alias("component")))
        changed = following.alias("n").join(labels.alias("o").hint("merge"), "node").where("n.component <> o.component").limit(1).count()
        labels = following
        if not changed:
            return labels


def name_groups(names: DataFrame, name: str, keep, suffixes: list[str] = (), prefixes: list[str] = ()) -> DataFrame:
    """(name, component) of every name that some strategy links to another."""
    c = F.col(name)
    links = linked_by(names, name, without_affixes(c, suffixes, prefixes), "affix").union(linked_by(names, name, F.lower(c), "case"))
    links = links.union(linked_by(names, name, F.when(F.length(core(c)) >= 2, core(c)), "script")).union(contained(names, name))
    return components(links.select("a", "b"), keep).withColumnRenamed("node", name)
