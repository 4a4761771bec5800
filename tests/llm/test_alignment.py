"""Token alignment against a version that compares all token pairs of a text."""

import hashlib
from collections import Counter

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from ambrel.llm import alignment
from ambrel.llm.token_counts import byte_letters
from tests.llm.test_corpus import BYTE, ODD, SCHEMA, frame, prose

PIECE = public_tokenizers.path("piece_bpe_32k.model")


def brute(texts):
    """Per text n_a, n_b, n_groups, n_links, n_best, count_sum, digest."""
    library, letters, b = Tokenizer.from_file(BYTE), byte_letters(), sentencepiece.SentencePieceProcessor(model_file=PIECE)
    library.encode_special_tokens = True
    found, corpus = [], Counter()
    for text in texts:
        raw = f" {text or ''}".encode()
        ids_a, ids_b = (library.encode(f" {text}", add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        of_a = [bytes(letters[c] for c in library.id_to_token(i)) for i in ids_a]
        of_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in ids_b]
        if b"".join(of_a) != raw or b"".join(of_b) != raw:
            found.append(([], [], [], []))
            continue
        spans = []
        for parts in (of_a, of_b):
            at, own = 0, []
            for p in parts:
                own.append((at, at + len(p)))
                at += len(p)
            spans.append(own)
        links = [(ids_a[i], ids_b[j]) for i, (s, e) in enumerate(spans[0]) for j, (t, u) in enumerate(spans[1]) if s < u and t < e]
        corpus.update(links)
        ends, groups, low = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]}), [], 0
        for end in ends:
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, own) if low <= s and e <= end) for ids, own in zip((ids_a, ids_b), spans)))
            low = end
        found.append((ids_a, ids_b, groups, links))
    top = Counter()
    for (_, y), n in corpus.items():
        top[y] = max(top[y], n)
    return [(len(a), len(b), len(g), len(k), sum(corpus[p] == top[p[1]] for p in k), sum(corpus[p] for p in k), hashlib.sha256(";".join(g).encode()).hexdigest() if a else "") for a, b, g, k in found]


MORE = ["<|endoftext|> and <s> or </s>", "a▁b", "x\x00y", " ", "\n\n", "é中文\U0001f600!", "tabs\tand  two  spaces ", "<0x41>", "1234567 89", "same", "same"]


@pytest.mark.parametrize("block", [alignment.BLOCK_CHARS, 300])
def test_against_all_pairs(spark, block):
    texts = [*ODD, *MORE, *prose(25, 3, 60)]
    docs = frame(spark, texts).repartition(3)
    rows = {r["doc_id"]: r for r in alignment.align_tokens(docs, BYTE, PIECE, block).collect()}
    got = [tuple(rows[i][c] for c in ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")) for i in range(len(texts))]
    assert got == brute(texts)


def test_edges(spark):
    assert alignment.align_tokens(frame(spark, []), BYTE, PIECE).count() == 0
    long = "word " * 60_000
    rows = [(None, None, None, None, None)] * 2 + [(1, "same text", "en", "s", 1)] * 2 + [(2, long, "en", "s", 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(0) for c in ("block", "at", "a", "b", "n", "count")})
    out = sorted(((r["doc_id"], r["n_a"], r["n_b"], r["n_links"], r["count_sum"]) for r in alignment.align_tokens(docs, BYTE, PIECE).collect()), key=repr)
    expected = [(i, *x[:2], *x[3:4], x[5]) for i, x in zip([r[0] for r in rows], brute([*[r[1] for r in rows[:4]], "word " * 6]))]
    assert out[:2] == expected[2:4] and out[3:] == [(None, 0, 0, 0, 0)] * 2 and out[2][1] > 60_000
