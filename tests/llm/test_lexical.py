"""Ranked search against scoring every document, blocks against every way of cutting a list."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ambrel.llm import lexical
from tests.llm.test_corpus import ODD, SCHEMA, prose

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=lexical.K):
    held = [(i, Counter(terms(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for i, c, size in held:
            m = 100 - 90 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m)) for t in set(terms(text)) if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scores)[:k])]
    return sorted(out, key=repr)


def tables(spark, docs, items):
    return spark.createDataFrame([(i, t, "en", "s", 1) for i, t in docs], SCHEMA), spark.createDataFrame(items, "item_id long, text string")


def corpus():
    r = random.Random(4)
    docs = [(i, t) for i, t in enumerate([*ODD, *prose(300, 6, 40)])] + [(9000 + i % 40, "the stone river") for i in range(80)]
    docs += [(None, "the stone river"), (None, None), (77, "ÀÉ Stone-RIVER x_y ²"), (500_000, "stone " * 40_000)]
    r.shuffle(docs)
    items = [(i, t) for i, t in enumerate(prose(30, 7, 12))] + [(100, None), (101, ""), (102, "stone river"), (102, "stone river"), (None, "walk blue"), (103, "nowhere"), (104, "the " * 50), (105, "àé stone's x_y"), (106, ODD[8])]
    return docs, items


@pytest.mark.parametrize("shard,block,size", [(lexical.SHARD_DOCS, lexical.BLOCK_QUERIES, lexical.TERM_BYTES), (25, 7, 10)])
def test_against_scoring_everything(spark, shard, block, size):
    docs, items = corpus()
    d, q = tables(spark, docs, items)
    more = {c: F.lit(1) for c in ("shard", "term", "block", "query", "score", "rank", "item_id")}
    got = lexical.rank(d.withColumns(more).repartition(3), q.withColumns({c: F.lit(1) for c in ("doc_id", "query", "term")}), block_queries=block, shard_docs=shard, term_bytes=size)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = corpus()
    for a, b in (([], items), (docs, []), ([(1, None), (2, " .")], items), (docs, [(1, None), (2, "-")])):
        assert lexical.rank(*tables(spark, a, b)).count() == 0


def test_blocks_have_the_least_cost():
    def brute_cost(d, x, most, cost):
        least = [0]
        for i in range(1, len(x) + 1):
            least.append(min(least[j] + (d[i - 1] - d[j] + 1) * max(x[j:i]) + cost for j in range(max(0, i - most), i)))
        return least[-1]

    r = np.random.default_rng(2)
    lists = [r.integers(1, 1000, n) for n in (1, 2, 5, 40, 7, 133, 64)]
    docs = [np.cumsum(r.integers(1, 5, len(x))) for x in lists]
    for most, cost in ((4, 300), (16, 1500), (128, 5000), (8, 0)):
        ends, at = lexical.block_ends(np.concatenate(docs), np.concatenate(lists), np.array([*map(len, lists)]), most, cost), 0
        for d, x in zip(docs, lists):
            cut = np.flatnonzero(ends[at : at + len(x)]) + 1
            assert cut[-1] == len(x)
            parts, spans = np.split(x, cut[:-1]), np.split(d, cut[:-1])
            assert max(map(len, parts)) <= most
            assert sum(int(e[-1] - e[0] + 1) * int(p.max()) + cost for e, p in zip(spans, parts)) == brute_cost(d.tolist(), x.tolist(), most, cost)
            at += len(x)


def test_blocks_are_skipped():
    r = np.random.default_rng(3)
    n, lists = 5000, []
    for share, weight in ((0.5, 10), (0.3, 400), (0.01, 3000)):
        docs = np.flatnonzero(r.random(n) < share)
        lists.append((docs, r.integers(100_000, 900_000, len(docs)), weight))
    ends = [np.flatnonzero(lexical.block_ends(d, i, np.array([len(i)]))) + 1 for d, i, _ in lists]
    shard = lexical.Shard(n, [(d, i, e, w) for (d, i, w), e in zip(lists, ends)])
    best, scores = shard.search([0, 1, 2], 10)
    every = np.zeros(n, np.int64)
    for d, i, w in lists:
        np.add.at(every, d, i * w)
    by = np.lexsort((np.arange(n), -every))[:10]
    assert best.tolist() == by.tolist() and scores.tolist() == every[by].tolist()
    assert 0 < shard.opened.sum() < shard.opened.size / 2


def test_large_sums_stay_exact():
    shard = lexical.Shard(3, [(np.arange(3), np.array([1, 2, 2]), np.array([3]), 1 << 60)])
    best, scores = shard.search([0], 2)
    assert best.tolist() == [1, 2] and scores.tolist() == [2 << 60, 2 << 60]
