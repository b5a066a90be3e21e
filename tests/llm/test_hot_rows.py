"""Rows that repeat one id, and families with one leader."""

import random
from collections import Counter

import numpy as np
from corpus_helpers import documents  # noqa: F401

from pontualis.llm import decontamination, near_dedup, packing
from pontualis.llm.components import components
from pontualis.llm.tables import Workspace


def test_copies_of_one_id_are_dealt_over_all_groups(spark, monkeypatch):
    monkeypatch.setattr(packing, "GROUP", 512)
    rows = [(-7, "s", 1, 300)] * 5000 + [(i, f"s{i}", i, 100 + i % 900) for i in range(10000)]
    items = spark.createDataFrame(rows, "doc_id bigint, source string, cluster bigint, n_words bigint").repartition(16)
    got = packing.pack(items).collect()
    assert len(got) == len(rows) and Counter(r.doc_id for r in got)[-7] == 5000
    sizes = Counter(r.bin_id >> 36 for r in got)
    assert len(sizes) > 20 and max(sizes.values()) <= 1.4 * np.median(list(sizes.values()))
    assert {r.bin_id >> 20 & 0xFFFF for r in got} == {0}  # no group was packed in parts
    bins = {}
    for r in got:
        bins.setdefault(r.bin_id, []).append(r)
    assert all(sum(r.n_words for r in b) <= packing.CAPACITY for b in bins.values())
    assert all(sum(r.doc_id == -7 for r in b) <= 1 for b in bins.values())


def test_groups_do_not_depend_on_the_order_of_distinct_rows(spark):
    rows = [(i, f"s{i % 7}", i, 100 + i % 900) for i in range(3000)]
    schema = "doc_id bigint, source string, cluster bigint, n_words bigint"
    one = packing.pack(spark.createDataFrame(rows, schema).repartition(3)).collect()
    two = packing.pack(spark.createDataFrame(rows[::-1], schema).repartition(7)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, two))


def test_components_with_a_hot_node_and_a_long_chain(spark):
    rng = random.Random(1)
    links = [(0, i) for i in range(1, 4000)] + [(i, i + 1) for i in range(10000, 10200)]
    links += [(rng.randrange(20000, 20300), rng.randrange(20000, 20300)) for _ in range(200)]
    rng.shuffle(links)
    parent = {x: x for pair in links for x in pair}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    frame = spark.createDataFrame(links, "a bigint, b bigint").repartition(9)
    got = components(Workspace(spark, "test-components"), frame, "c").collect()
    assert {r.node: r.component for r in got} == {x: root(x) for x in parent} and len(got) == len(parent)


def test_the_text_that_counted_is_kept(documents):
    words = [f"w{i}" for i in range(40)]
    low, other = " ".join(words), " ".join(f"v{i}" for i in range(40))
    sketches = near_dedup.sketch(near_dedup.pa.array([low, other, ""]))
    first = min((0, 1), key=lambda i: tuple(sketches[c][i].as_py() for c in ("d1", "d2", "n")))
    chosen = (low, other)[first]
    for order in ([low, other, "", low], ["", other, low, other]):
        rows = [(5, t) for t in order] + [(9, chosen + " end")]
        got = near_dedup.deduplicate(documents(rows).repartition(3)).collect()
        assert [(r.doc_id, r.text) for r in got] == [(5, chosen)]


def test_a_window_of_many_items_is_cut_by_them(spark, documents, monkeypatch):
    shared = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(f"i{k:03d}", shared) for k in range(300)]
                                  + [(f"j{k}", f"{shared} number{k}") for k in range(40)], "item_id string, text string")
    docs = documents([(1, f"a {shared} b"), (2, "one two three"), (3, f"{shared} number7"), (4, None)])
    whole = {r.doc_id: r._out for r in decontamination.find_contamination(docs, items).collect()}
    assert len(whole[1]["items"]) == 340 and len(whole[3]["hits"]) == 11 and whole[2]["items"] == []
    monkeypatch.setattr(decontamination, "BLOCK_WINDOWS", 50)
    windows = decontamination.benchmark_windows(items).cache()
    sizes = [b.count() for b in decontamination.blocks_of(windows)]
    assert len(sizes) > 5 and max(sizes) <= 2 * 50
    cut = {r.doc_id: r._out for r in decontamination.find_contamination(docs, items).collect()}
    assert cut == whole
    clean = {r.doc_id: r.text for r in decontamination.remove_spans(docs, items).collect()}
    assert clean[1] == "a  b" and clean[2] == "one two three" and clean[4] is None
