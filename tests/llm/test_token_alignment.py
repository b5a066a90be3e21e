"""Alignment of two tokenizers against whole texts encoded and compared byte by byte."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
import public_tokenizers
from pyspark.sql import functions as F

from corpus_helpers import SMALL, documents  # noqa: F401
from pontualis.llm import token_alignment as ta

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def plain(texts):
    """Rows of the result, from whole texts and all pairs of tokens."""
    v = ta.vocabularies(A, B)
    rows, holds = [], Counter()
    for text in texts:
        ids_a = v.a.encode(" " + text, add_special_tokens=False).ids if text else []
        ids_b = v.b.encode(text) if text else []
        wanted = (" " + text).encode() if text else b""
        if not text or any(b"".join(side[i] for i in ids) != wanted
                           for side, ids in ((v.a_bytes, ids_a), (v.b_bytes, ids_b))):
            rows.append(([], [], [], []))
            continue
        spans = []
        for side, ids in ((v.a_bytes, ids_a), (v.b_bytes, ids_b)):
            at, out = 0, []
            for i in ids:
                out.append((at, at + len(side[i]), i))
                at += len(side[i])
            spans.append(out)
        links, j = [], 0
        for s, e, a in spans[0]:
            while spans[1][j][1] <= s:
                j += 1
            k = j
            while k < len(spans[1]) and spans[1][k][0] < e:
                links.append((a, spans[1][k][2]))
                k += 1
        cuts = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        groups, low = [], 0
        for cut in cuts:
            groups.append("|".join(",".join(str(i) for s, e, i in side if low < e <= cut)
                                   for side in spans))
            low = cut
        rows.append((ids_a, ids_b, groups, links))
        holds.update(set(links))
    most = defaultdict(int)
    for (a, _), n in holds.items():
        most[a] = max(most[a], n)
    return [(len(a), len(b), len(g), len(ls), sum(holds[p] == most[p[0]] for p in ls),
             sum(holds[p] for p in ls), hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
            for a, b, g, ls in rows]


CASES = [None, "", " ", "a", "\n", " a", "a ", "a  b", "a\n\nb", "\n a", " \nword", "x\ty z", "a \n b",
         "Étion über naïve 東京 ☃ \U0001F600", "a▁b", "<|endoftext|> <s> </s> <unk>", "don't I'll we've",
         " x 　y  z", "é ́", "\x00 \x1c a\x1cb", "x" * 3000, "1234567 3.14 a1b2",
         "tabs\t\tand   spaces \n\n\n end.\n", "same same same", "same same same", "ﬁ ｆｕｌｌ Å"]
COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def check(spark, documents, texts, **more):
    frame = documents([(i, t) for i, t in enumerate(texts)]).repartition(3)
    got = ta.align(frame, A, B, **more).orderBy("doc_id").select("doc_id", *COLUMNS).collect()
    assert [r[0] for r in got] == list(range(len(texts)))
    assert [tuple(r)[1:] for r in got] == plain(texts)


def test_equals_whole_texts(spark, documents):
    rng = random.Random(5)
    alphabet = ["a", "the", "ing", " ", " ", "\n", "\t", "é", "東", "'s", ".", "9", " ", "▁x"]
    random_texts = ["".join(rng.choice(alphabet[:-1]) for _ in range(rng.randint(1, 60)))
                    for _ in range(300)]
    check(spark, documents, CASES + random_texts)


def test_blocks_add_up(spark, documents):
    texts = [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()][:60]
    check(spark, documents, texts, block_pairs=200)


def test_small_memory(spark, documents, monkeypatch):
    aligner = ta.Aligner(ta.vocabularies(A, B))
    texts = ["one two three", "two three four", "one\nfive"]
    whole = aligner.documents(texts)
    for t, n in zip(texts, whole["n_links"].to_pylist()):
        aligner._forget()
        assert aligner.documents([t])["n_links"].to_pylist() == [n]


def test_empty_table_and_repeated_rows(spark, documents):
    assert ta.align(documents([]), A, B).collect() == []
    got = ta.align(documents([(1, "a b"), (1, "a b"), (None, "a b")]), A, B).collect()
    assert len(got) == 3 and len({tuple(r)[1:] for r in got}) == 1 and got[0].count_sum == 3 * got[0].n_links


def test_identity_map_keeps_bytes():
    v = ta.vocabularies(A, B)
    for a, b in enumerate(v.identity):
        assert b == -1 or v.a_bytes[a] == v.b_bytes[b]
    assert (v.identity >= 0).sum() > 10000
