"""The trie against nested dictionaries of rebuilt turns."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from corpus_helpers import SMALL
from pontualis.llm import prefix_trie as pt

SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def plain(rows):
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [r[2:] for r in sorted(v)] for c, v in convs.items()}
    nodes = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        turns = convs.get(c - c % 5, [])[:h] + own[h:]
        for d in range(len(turns) + 1):
            nodes.setdefault(tuple(turns[:d]), []).append((c, d == len(turns)))
    out = []
    for path, members in nodes.items():
        below = {p: m for p, m in nodes.items() if p[:len(path)] == path}
        ends = sorted(c for c, last in members if last)
        out.append((
            min(c for c, _ in members), len(path),
            min(c for c, _ in nodes[path[:-1]]) if path else None, len(members),
            sum(len(p) == len(path) + 1 for p in below),
            sum(not any(len(q) == len(p) + 1 and q[:len(p)] == p for q in below) for p in below),
            sum((len(m) - 1) * len(p[-1][1].encode()) for p, m in below.items() if p),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return sorted(out, key=repr)


def check(spark, rows, **more):
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(
        {c: F.lit(1) for c in ("depth", "f1", "t1", "conv", "pos", "n")}).repartition(3)
    got = sorted((tuple(r) for r in pt.prefix_trie(frame, **more).collect()), key=repr)
    assert got == plain(rows)
    return got


def shuffled(rng, n, length, words):
    rows = []
    for c in range(n):
        turns = [(rng.choice(["user", "assistant", None]), rng.choice(words)) for _ in range(length(c))]
        rows += [(c, i, r, t) for i, (r, t) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def test_few_words_many_branches(spark):
    rng = random.Random(1)
    rows = shuffled(rng, 60, lambda c: rng.randint(1, 12), ["a", "", None, "é東"])
    check(spark, rows)


def test_copies_nulls_gaps_and_missing_bases(spark):
    rows = [(c, t, "user", f"turn {t}") for c in (7, 8, 9, 11, 12, 4000000000000, 4000000000001) for t in range(11)]
    rows += [(20, None, "system", "first"), (20, -5, "user", "b"), (20, 900000, None, None), (21, 3, "user", "x")]
    rows += [(25, 2048 * i, "user", str(i)) for i in range(12)] + [(26, 1, "user", "only")]
    rows += [(None, 0, "user", "of no conversation")]
    check(spark, rows)


def test_one_conversation_over_many_cells(spark):
    long = [(5, i * 300, "user", str(i % 7)) for i in range(60)]
    check(spark, long + [(5 + k, i * 300, "user", str(i % 7)) for k in (1, 2) for i in range(40)])


def test_data_of_the_tables(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet")
            .select("conv_id", "turn", "role", "text").collect()]
    check(spark, rows)


def test_ties_do_not_depend_on_the_order_of_rows(spark):
    rows = [(1, 0, "user", t) for t in ("b", "a", "a")] + [(2, 0, "user", "a")]
    one = pt.prefix_trie(spark.createDataFrame(rows, SCHEMA))
    two = pt.prefix_trie(spark.createDataFrame(rows[::-1], SCHEMA).repartition(4))
    assert sorted(map(repr, one.collect())) == sorted(map(repr, two.collect()))


def test_hashes_that_collide_are_found_and_replaced(spark):
    rng = random.Random(4)
    rows = shuffled(rng, 30, lambda c: rng.randint(1, 6), ["a", "b", "c"])
    seeds = []

    def weak(role, text, seed):
        seeds.append(seed)
        if seed < 2:  # the first two seeds cannot tell texts apart
            return [F.xxhash64(role).alias("t1"), F.xxhash64(role).alias("t2")]
        return pt.turn_hashes(role, text, seed)

    check(spark, rows, hashes=weak)
    assert max(seeds) == 2
    with pytest.raises(RuntimeError):
        pt.prefix_trie(spark.createDataFrame(rows, SCHEMA),
                       hashes=lambda r, t, s: [F.xxhash64(r).alias("t1"), F.xxhash64(r).alias("t2")])


def test_empty_table(spark):
    assert pt.prefix_trie(spark.createDataFrame([], SCHEMA)).collect() == []
