"""Best-fit packing by a configuration linear program.

Documents become pieces of at most ``capacity`` ids: only a longer one is cut,
into full pieces with the shorter rest first. The packing is decided on the
histogram of piece lengths, which has at most ``capacity`` entries whatever the
input, so it fits the driver:

1. The configuration LP (min sum x_c, sum_c x_c a_cl >= n_l over the
   configurations c of total length <= capacity), by multiplicative weights at
   every size: a length's price falls exponentially with its covered share; a
   knapsack dynamic program over the capacity, with all lengths as items, prices
   the dearest configuration and, for each length, the dearest one that holds it.
   Those within NEAR of the dearest enter the plan by small steps. Any prices give
   a lower bound of the LP: what all pieces are worth over what the dearest
   configuration is. Every CHECK rounds the columns found so far are weighed anew
   by multiplicative scaling towards an exact cover; the best feasible x is kept.
   Rounds end when its value is within GAP of the best bound, or after ROUNDS.
2. x is rounded along its running sum, never past what is left of a length, full
   configurations alone; the program is solved again for what they leave, up to
   PASSES times, until they are at most SHARE of its bound.
3. The remainder is packed best-fit: the longest
   one, joined by what fills the room beside it best (sums of all lengths left, one
   bit each), as often as they allow; after the last x is rounded with its other
   configurations too, if that takes no more sequences. Only if packing everything
   best-fit took fewer sequences, it would be done instead. Whole plans have at
   least ceil(bound) sequences.

A piece then gets its place in closed form: its rank among the pieces of its
length falls in a configuration's interval of ranks, which gives sequence and
offset. Ranks are counted by length and salt; a length of n pieces has about
sqrt(n) salts, so no task holds more than a share of a common length, and neither
does the table of the salts' sums, which is joined on the keys that the pieces are
dealt by already. The plan sent to the tasks depends on the number of lengths
(at most ``capacity``) alone: a step of best-fit packing uses up a length or
halves what is left of one beside it, and passes and rounds are limited.

Null texts are empty: the end id alone. Texts of any length are encoded whole.
Rows may repeat, and so may doc_id (or be null): each row is packed; equal pieces
rank in any order. An empty table gives no rows. Columns other than doc_id and
text are not read, whatever their names.
"""

from __future__ import annotations

import functools
import json
import math
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import as_table

CAPACITY, END_ID = 2048, 0
ROUNDS, CHECK, STEP, ETA, NEAR, GAP, SWEEPS, LEAN = 60, 20, 0.1, 3.0, 0.05, 2e-4, 200, 0.5
PASSES, SHARE = 8, 0.05
#: The pre-tokenizer that SPLIT stands for; a file with another one is left to the library (fixed values).
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Texts of other code points are encoded by the tokenizers library itself.
TRUSTED = re.compile("[^\t-\r -~\xa0-ʯΑ-ώЀ-џ‐-‧€]")


class ByteEncoder:
    """Ids of texts under a byte-level tokenizer file.

    The file's merges, read as ranks, drive the faster tiktoken core: for byte-level vocabularies numbered in merge
    order both give the same ids. Texts with special strings or code points outside TRUSTED go to the library.
    """

    def __init__(self, path: str):
        import tiktoken
        from tokenizers import Tokenizer

        from .token_counts import byte_letters

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        special = {t.content for t in self.library.get_added_tokens_decoder().values()}
        self.special = re.compile("|".join(map(re.escape, sorted(special))) or r"(?!)")
        spec = json.loads(self.library.to_str())
        self.known = spec["normalizer"] is None and BYTE_LEVEL.items() <= (spec["pre_tokenizer"] or {}).items()
        if self.known:
            letters = byte_letters()
            ranks = {bytes(letters[c] for c in t): i for t, i in self.library.get_vocab(False).items() if t not in special}
            self.fast = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> np.ndarray:
        if not self.known or TRUSTED.search(text) or self.special.search(text):
            return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    return ByteEncoder(path)


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length and ids_crc32 of every document's pieces."""

    def run(batches):
        machine = encoder(tokenizer)
        for batch in batches:
            which, out = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.append(machine.encode(text or ""), np.array([end_id], "<u4"))
                n = len(ids)
                cuts = [0, *range(n % capacity or capacity, n, capacity), n] if n > capacity else [0, n]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:])):
                    which.append(i)
                    out.append((p, a, b - a, zlib.crc32(ids[a:b].tobytes())))
            cols = [*zip(*out)] or [()] * 4
            arrays = [batch.column("doc_id").take(pa.array(which, pa.int32()))] + [pa.array(list(c), t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long")


class Knapsack:
    """The dearest configuration for every room up to ``capacity``, each length at most ``most`` times."""

    def __init__(self, lengths: np.ndarray, prices: np.ndarray, most: np.ndarray, capacity: int):
        self.items, worth = [], []
        for i, (n, p, m) in enumerate(zip(lengths.tolist(), prices.tolist(), most.tolist())):
            k = 1
            while m > 0:  # binary splitting of the multiplicity
                k = min(k, m)
                self.items.append((i, k, k * n))
                worth.append(k * p)
                m, k = m - k, 2 * k
        self.value = np.zeros(capacity + 1)
        self.took = np.zeros((capacity + 1, len(self.items)), bool)
        for j, ((_, _, size), p) in enumerate(zip(self.items, worth)):
            with_it = self.value[: capacity + 1 - size] + p
            better = with_it > self.value[size:] + 1e-9
            self.took[size:, j] = better
            np.copyto(self.value[size:], with_it, where=better)

    def configuration(self, room: int) -> dict[int, int]:
        out, j = {}, len(self.items)
        while (at := np.flatnonzero(self.took[room, :j])).size:
            j = int(at[-1])
            i, k, size = self.items[j]
            out[i] = out.get(i, 0) + k
            room -= size
        return out


def fullest(sizes: list[int], left: list[int], room: int) -> dict[int, int]:
    """How often to take which of the ascending ``sizes`` to fill ``room`` as far as any choice can, long pieces first."""
    reached, steps, mask = 1, [], (1 << room + 1) - 1  # bit b: some choice adds up to b
    for i in range(len(sizes) - 1, -1, -1):
        m, k = min(left[i], room // sizes[i]), 1
        while m > 0:
            k = min(k, m)
            steps.append((reached, i, k))
            reached |= reached << sizes[i] * k & mask
            m, k = m - k, 2 * k
        if reached >> room & 1:
            break
    at, out = reached.bit_length() - 1, {}
    for before, i, k in reversed(steps):
        if not before >> at & 1:
            out[i] = out.get(i, 0) + k
            at -= k * sizes[i]
    return out


Plan = list[tuple[dict[int, int], int]]


def best_fit(histogram: dict[int, int], capacity: int) -> Plan:
    """Configurations (length -> times) and their numbers: the longest piece left with the fullest company."""
    sizes = sorted(n for n, k in histogram.items() if k)
    left, plan = [histogram[n] for n in sizes], []
    while sizes:
        top = len(sizes) - 1
        left[top] -= 1  # for what may stand beside it
        config = fullest(sizes, left, capacity - sizes[top])
        left[top] += 1
        config[top] = config.get(top, 0) + 1
        times = min(left[i] // k for i, k in config.items())
        plan.append(({sizes[i]: k for i, k in config.items()}, times))
        for i, k in config.items():
            left[i] -= k * times
        there = [i for i, n in enumerate(left) if n]
        sizes, left = [sizes[i] for i in there], [left[i] for i in there]
    return plan


def rescaled(columns: list[tuple], start: np.ndarray, lengths: np.ndarray, counts: np.ndarray, capacity: int) -> np.ndarray:
    """Weights of ``columns`` that cover every length: multiplicative scaling from ``start``, which full columns lead."""
    which = np.repeat(np.arange(len(columns)), [len(c) for c in columns])
    item = np.array([i for c in columns for i, _ in c])
    times = np.array([k for c in columns for _, k in c], "f8")
    share = times * lengths[item] / capacity
    log_x = np.log(start) - LEAN * (capacity - np.bincount(which, times * lengths[item], len(columns)))
    covered = lambda: np.bincount(item, times * np.exp(log_x)[which], len(lengths)) / counts
    for _ in range(SWEEPS):
        log_x -= np.bincount(which, share * np.log(np.maximum(covered(), 1e-300))[item], len(columns))
    return np.exp(log_x) / covered().min()


def configuration_lp(histogram: dict[int, int], capacity: int) -> tuple[list[tuple[dict[int, int], float]], float]:
    """A feasible x (configuration, number) over columns that the knapsack has priced, and the best lower bound."""
    lengths = np.array(sorted(n for n, k in histogram.items() if k), "i8")
    if not len(lengths):
        return [], 0.0
    counts = np.array([histogram[n] for n in lengths.tolist()], "f8")
    most = np.minimum(counts, capacity // lengths).astype("i8")
    index = {n: i for i, n in enumerate(lengths.tolist())}
    best, value, bound = {}, math.inf, 0.0
    moved: dict[tuple, float] = {}
    cover = np.zeros(len(lengths))
    for turn in range(1, ROUNDS + 1):
        price = lengths * np.exp(-ETA * (cover - cover.min()))
        table = Knapsack(lengths, price, most, capacity)
        top = table.value[capacity]
        bound = max(bound, float(counts @ price / top))
        if value <= (1 + GAP) * bound:
            break
        used = np.zeros(len(lengths))
        for i in np.argsort(cover, kind="stable").tolist():  # the least covered choose first
            if used[i]:
                continue
            config = table.configuration(capacity - int(lengths[i]))
            config[i] = config.get(i, 0) + 1
            if config[i] > most[i] or sum(price[j] * k for j, k in config.items()) < (1 - NEAR) * top:
                continue
            x = min((STEP - used[j]) * counts[j] / k for j, k in config.items())
            if x > 1e-12:
                for j, k in config.items():
                    used[j] += x * k / counts[j]
                key = tuple(sorted(config.items()))
                moved[key] = moved.get(key, 0.0) + x
        cover += used
        if turn % CHECK == 0 and cover.min() > 0:
            columns = [*moved]
            weighed = dict(zip(columns, rescaled(columns, np.array([*moved.values()]) / cover.mean(), lengths, counts, capacity).tolist()))
            for found in (weighed, {key: x / cover.min() for key, x in moved.items()}):
                if sum(found.values()) < value:
                    best, value = found, sum(found.values())
    return [({int(lengths[i]): k for i, k in key}, x) for key, x in best.items()], bound


def rounded(fractional: list[tuple[dict[int, int], float]], left: dict[int, int], capacity: int, full: bool) -> Plan:
    """Whole numbers along the running sum of x, full configurations first, or they alone; taken out of ``left``."""
    plan, total, room = [], 0.0, lambda c: capacity - sum(n * k for n, k in c.items())
    for config, x in sorted(fractional, key=lambda c: room(c[0])):
        if full and room(config):
            break
        times = int(total + x + 1e-9) - int(total + 1e-9)
        total += x
        times = min([times, *(left[n] // k for n, k in config.items())])
        if times > 0:
            plan.append((config, times))
            for n, k in config.items():
                left[n] -= k * times
    return plan


def solve(histogram: dict[int, int], capacity: int = CAPACITY) -> Plan:
    """Configurations (length -> times) with their whole numbers, which hold every piece exactly once."""
    count = lambda p: sum(times for _, times in p)
    left, plan = {n: k for n, k in histogram.items() if n < capacity and k}, []
    short = dict(left)
    for _ in range(PASSES):
        fractional, bound = configuration_lp(left, capacity)
        taken = rounded(fractional, left, capacity, full=True)
        plan += taken
        if count(taken) <= SHARE * bound:
            break
    remainder = best_fit(left, capacity)
    others = rounded(fractional, left, capacity, full=False)
    plan += min(others + best_fit(left, capacity), remainder, key=count)
    plan = min(plan, best_fit(short, capacity), key=count)  # of as many sequences the program's stays
    whole = histogram.get(capacity, 0)
    return plan + [({capacity: 1}, whole)] * (whole > 0)


def intervals(plan: Plan) -> dict[str, np.ndarray]:
    """For each length and configuration: the first rank, how many go in one sequence, the first sequence, the first offset."""
    rows, taken, sequence = [], {}, 0
    for config, times in plan:
        offset = 0
        for n, k in sorted(config.items(), reverse=True):
            rows.append(((n << 44) + taken.get(n, 0), k, sequence, offset))
            taken[n] = taken.get(n, 0) + k * times
            offset += n * k
        sequence += times
    first, each, base, offset = zip(*sorted(rows)) if rows else ((), (), (), ())
    return {"first": np.array(first, "i8"), "each": np.array(each, "i8"), "base": np.array(base, "i8"), "offset": np.array(offset, "i8")}


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id and offset of every piece."""
    cut = as_table(pieces(docs, tokenizer, capacity, end_id).withColumn("row", F.monotonically_increasing_id()), "pieces")
    histogram = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    places = intervals(solve(histogram, capacity))
    salts = [math.isqrt(max(0, histogram.get(n, 0) - 1)) + 1 for n in range(capacity + 1)]
    salt = F.pmod(F.xxhash64("row"), F.get(F.expr(f"array({','.join(map(str, salts))})"), F.col("length").cast("int")))
    cut = cut.withColumn("salt", salt.cast("int"))
    sums = as_table(cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")), "lengths")
    before = sums.select("length", "salt", (F.sum("n").over(W.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    order = W.partitionBy("length", "salt").orderBy("row")
    ranked = cut.withColumn("rank", F.row_number().over(order) - 1).join(before.hint("merge"), ["length", "salt"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def run(batches):
        for batch in batches:
            n, rank = batch.column("length").to_numpy(), batch.column("rank").to_numpy()
            key = (n << 44) + rank
            at = np.searchsorted(places["first"], key, "right") - 1
            i, slot = np.divmod(key - places["first"][at], places["each"][at])
            out = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")]
            out += [pa.array(places["base"][at] + i, pa.int64()), pa.array(places["offset"][at] + slot * n, pa.int64())]
            yield pa.RecordBatch.from_arrays(out, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    kind = dict(cut.dtypes)["doc_id"]
    return ranked.mapInArrow(run, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def pack_documents(docs: DataFrame) -> DataFrame:
    import public_tokenizers

    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


def query(spark, sf_dir: str) -> DataFrame:
    return pack_documents(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
