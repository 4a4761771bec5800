"""Token counts by a compiled finite-state transducer.

A byte-pair tokenizer is a deterministic transducer over the bytes of one word:
the state keeps the longest suffix that can still be inside a later token, and
for every live start in it the last token of the text before that start and how
many tokens it had, relative to now. A transition's output is the change of the
token count; at a word's last byte (a symbol of its own) the machine emits what
closes the word and returns to its start state. Token t may follow token s
exactly if encoding their joint text gives [s, t]; by that rule every prefix has
one last token. States are built when first met, from vocabulary and merges,
and dropped together when there are too many.

Texts of a batch form one symbol stream, cut into equal chunks at any place.
A chunk is a map from entry state to (exit state, count). Chunks run side by
side from the state "unknown", which the first word end resolves; a chunk with
a word end thus has a constant exit. A prefix scan composes the maps to get
every entry state, and the stretch before each chunk's first word end is run
again from there. Counts are summed by text.

Normalisation (NFC, lower case) and word classes are those of the tokenizer file
for the code points in TRUSTED; other texts, and texts with special strings, are
encoded by the library itself. Null and empty texts count 0 bytes and 0 tokens.
Repeated rows count alike, and so do rows without id; texts of any length are counted
whole; an empty table gives no rows. Result columns replace input columns of those
names; all others stay, whatever they are called.

There are never more than MAX_STATES states: a piece of text that needs more is
begun again with an empty table, in halves if need be, and a single text that
needs more by itself goes to the library.
"""

from __future__ import annotations

import functools
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import in_pieces

LIMIT = 2048
#: Texts with other code points go to the library: its Unicode version may know them otherwise.
TRUSTED = re.compile("[^\t-\r -~\xa0-ʯΑ-ΡΣ-ώЀ-џ‐-‧€]")
PIECE, CHUNKS, MAX_STATES = 2_000_000, 4096, 98_000
UNKNOWN = 1  # state number; 0 is the start of a word


def byte_letters() -> dict[str, int]:
    """The printable character that stands for each byte in byte-level vocabularies, inverted."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class _Full(Exception):
    """MAX_STATES are not enough."""


class Transducer:
    END = b"\xff"  # stands behind a word's last byte; never in UTF-8

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        spec = json.load(open(path, encoding="utf-8"))
        model, letters = spec["model"], byte_letters()
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        self.suffix = model["end_of_word_suffix"]

        def as_bytes(token: str) -> bytes:
            end = token.endswith(self.suffix)
            body = token[: -len(self.suffix)] if end else token
            return bytes(letters[c] for c in body) + (self.END if end else b"")

        specials = {t["content"] for t in spec["added_tokens"]}
        self.ids = {as_bytes(t): i for t, i in model["vocab"].items() if t not in specials}
        self.text = {i: b for b, i in self.ids.items()}
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.rank = {(as_bytes(a), as_bytes(b)): r for r, (a, b) in enumerate(pairs)}
        self.prefixes = {b[:n] for b in self.ids for n in range(1, len(b) + 1)}
        self.follows: dict[tuple[int, int], bool] = {}
        self.alone: dict[int, bool] = {}
        used = [*range(33, 65), *range(91, 127), *range(0x80, 0xC0), *range(0xC2, 0xD2), 0xE2]  # of lower-case TRUSTED texts
        self.column = np.full(256, -1, "i4")
        self.column[used] = np.arange(len(used))
        self.bytes_of = used
        self.n_cols = 2 * len(used)
        cls = np.full(0x3000, 3, "u1")
        for c in range(0x3000):
            kind = unicodedata.category(chr(c))[0]
            cls[c] = 1 if kind == "L" else 2 if kind == "N" else 0 if chr(c) in "\t\n\x0b\x0c\r \x85\xa0" or kind == "Z" else 3
        self.cls = cls
        self.reset()

    def reset(self) -> None:
        self.states: list = [(b"", ((-1, 0),)), None]
        self.number = {self.states[0]: 0}
        self.next = np.zeros((MAX_STATES, self.n_cols), "i4")  # the state's number and 1; 0: not yet compiled, memory not yet taken
        self.out = np.zeros((MAX_STATES, self.n_cols), "i1")
        half = self.n_cols // 2
        self.next[UNKNOWN, :half], self.next[UNKNOWN, half:] = UNKNOWN + 1, 1

    def merge(self, text: bytes) -> list[bytes]:
        """Byte-pair encoding by definition: again and again the best-ranked pair, leftmost first."""
        end = text.endswith(self.END)
        parts = [bytes([b]) for b in (text[:-1] if end else text)]
        if end:
            parts[-1] += self.END
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: self.rank.get((parts[i], parts[i + 1]), 1 << 60))
            if (parts[best], parts[best + 1]) not in self.rank:
                break
            pair = (parts[best], parts[best + 1])
            i, merged = 0, []
            while i < len(parts):
                if i + 1 < len(parts) and (parts[i], parts[i + 1]) == pair:
                    merged.append(pair[0] + pair[1])
                    i += 2
                else:
                    merged.append(parts[i])
                    i += 1
            parts = merged
        return parts

    def may_follow(self, last: int, token: int) -> bool:
        """Is [last, token] the encoding of their joint text? last -1: the word starts here."""
        if token not in self.alone:
            self.alone[token] = self.merge(self.text[token]) == [self.text[token]]
        if not self.alone[token] or last == -1:
            return self.alone[token]
        key = (last, token)
        if key not in self.follows:
            a, b = self.text[last], self.text[token]
            self.follows[key] = self.merge(a + b) == [a, b]
        return self.follows[key]

    def compile(self, state: int, col: int) -> None:
        """Fill in one transition."""
        half = self.n_cols // 2
        window, starts = self.states[state]
        seen = window + bytes([self.bytes_of[col % half]]) + (self.END if col >= half else b"")
        for at, start in enumerate(starts):
            if start is None:
                continue
            token = self.ids.get(seen[at:])
            if token is not None and self.may_follow(start[0], token):
                break
        else:
            raise AssertionError("a text without encoding")
        count = start[1] + 1
        if col >= half:
            self.next[state, col], self.out[state, col] = 1, count
            return
        live = [(s[0], s[1] - count) if s is not None and seen[i:] in self.prefixes else None for i, s in enumerate(starts)] + [(token, 0)]
        first = next(i for i, s in enumerate(live) if s is not None)
        new = (seen[first:], tuple(live[first:]))
        if new not in self.number:
            if len(self.states) == MAX_STATES:
                raise _Full
            self.number[new] = len(self.states)
            self.states.append(new)
        self.next[state, col], self.out[state, col] = self.number[new] + 1, count

    def step(self, states: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        to = self.next[states, cols]
        while not to.all():
            for s, c in {*zip(states[to == 0].tolist(), cols[to == 0].tolist())}:
                self.compile(s, c)
            to = self.next[states, cols]
        return to - 1, self.out[states, cols]

    def symbols(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Table columns of the words' bytes in a normalised text, and for each byte the number of its code point."""
        cp = np.frombuffer(text.encode("utf-32-le"), "u4")
        kind = self.cls[np.minimum(cp, 0x2FFF)]
        begin = np.ones(len(cp) + 3, bool)  # does a word begin at this code point, or space?
        begin[1 : len(cp)] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        quote = np.flatnonzero((cp == 39) & begin[: len(cp)])
        if len(quote):
            at = np.concatenate([cp, np.zeros(3, "u4")])
            a, b = at[quote + 1], at[quote + 2]
            one = np.isin(a, [ord(c) for c in "stmd"])
            two = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
            begin[quote[one | two] + 1] = False
            begin[quote[one] + 2] = True
            begin[quote[two] + 3] = True
        raw = np.frombuffer(text.encode(), "u1")
        lead = (raw & 0xC0) != 0x80
        char = np.cumsum(lead) - 1
        last = np.ones(len(raw), bool)
        last[:-1] = lead[1:] & begin[char[1:]]
        word = kind[char] != 0
        cols = self.column[raw[word]] + (self.n_cols // 2) * last[word]
        return cols, char[word]

    def chunk_counts(self, cols: np.ndarray) -> np.ndarray:
        """The count emitted at each symbol."""
        n = len(cols)
        lanes = max(1, min(CHUNKS, n // 64))
        width = -(-n // lanes)
        half = self.n_cols // 2
        padded = np.full(lanes * width, half, "i4")
        padded[:n] = cols
        grid = np.ascontiguousarray(padded.reshape(lanes, width).T)
        out = np.zeros((width, lanes), "i1")
        state = np.full(lanes, UNKNOWN, "i4")
        state[0] = 0
        for i in range(width):
            state, out[i] = self.step(state, grid[i])
        ends = grid >= half
        constant = ends.any(0)
        head = np.where(constant, ends.argmax(0) + 1, width)  # symbols up to the first word end
        entry = self.scan(grid, state, constant)
        state = entry.copy()
        todo = np.arange(1, lanes)
        i = 0
        while len(todo := todo[head[todo] > i]):
            state[todo], out[i, todo] = self.step(state[todo], grid[i, todo])
            i += 1
        return out.T.reshape(-1)[:n]

    def scan(self, grid: np.ndarray, exits: np.ndarray, constant: np.ndarray) -> np.ndarray:
        """Entry states: the exclusive prefix composition of the chunks' state maps.

        A constant map absorbs what stands before it, so after log2(longest run of other maps) doublings all
        compositions that end in one are known; a map that isn't constant is applied by running its chunk.
        """
        lanes = len(exits)
        known = constant.copy()
        known[0] = True
        value = exits.copy()
        source = np.where(known, np.arange(lanes), -1)
        source = np.maximum.accumulate(source)  # the last chunk whose exit is known, by associative maximum
        for k in np.flatnonzero(~known):  # words longer than a chunk
            s = value[k - 1] if source[k] != k else value[k]
            for i in range(len(grid)):
                s = self.step(np.array([s]), grid[i, k : k + 1])[0][0]
            value[k] = s
        return np.concatenate([[0], value[:-1]]).astype("i4")

    def counts(self, texts: list[str]) -> np.ndarray:
        result = np.zeros(len(texts), "i8")
        for lo, hi in in_pieces(texts, PIECE):
            plain = []
            for i in range(lo, hi):
                t = texts[i]
                if TRUSTED.search(t) or self.special.search(t):
                    result[i] = self.by_library(t)
                else:
                    plain.append(i)
            if plain:
                result[plain] = self.plain_counts([texts[i] for i in plain])
        return result

    def by_library(self, text: str) -> int:
        return len(self.library.encode(text, add_special_tokens=False).ids)

    def plain_counts(self, texts: list[str]) -> np.ndarray:
        """Counts of texts that the transducer knows all of."""
        normal = [unicodedata.normalize("NFC", t).replace("Σ", "σ").lower() for t in texts]
        cols, char = self.symbols("\n".join(normal))
        if not len(cols):
            return np.zeros(len(texts), "i8")
        if (cols < 0).any():
            raise AssertionError("a byte outside the alphabet")
        for _ in range(2):  # with the states there are, then from none
            try:
                emitted = np.concatenate([[0], np.cumsum(self.chunk_counts(cols), dtype="i8")])
                break
            except _Full:
                self.reset()
        else:
            if len(texts) == 1:
                return np.array([self.by_library(texts[0])])
            half = len(texts) // 2
            return np.concatenate([self.plain_counts(texts[:half]), self.plain_counts(texts[half:])])
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in normal])])
        return np.diff(emitted[np.searchsorted(char, starts)])


@functools.lru_cache(maxsize=2)
def transducer(path: str) -> Transducer:
    """One for each worker process."""
    return Transducer(path)


def count_tokens(docs: DataFrame, tokenizer: str, text: str = "text", limit: int = LIMIT) -> DataFrame:
    """``docs`` without the text, with n_bytes, n_tokens (long) and over_limit."""
    new = [("n_bytes", T.LongType()), ("n_tokens", T.LongType()), ("over_limit", T.BooleanType())]
    kept = [f for f in docs.schema if f.name not in {n for n, _ in new} and f.name != text]
    schema = T.StructType([*kept, *[T.StructField(n, t) for n, t in new]])

    def run(batches):
        machine = transducer(tokenizer)
        for batch in batches:
            texts = [t or "" for t in batch.column(text).to_pylist()]
            n = machine.counts(texts)
            arrays = [batch.column(f.name) for f in kept] + [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)]
            yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])

    return docs.select(*dict.fromkeys([*[f.name for f in kept], text])).mapInArrow(run, schema)


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json"))
