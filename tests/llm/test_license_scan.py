"""License scans against phrases searched word by word, and expressions against Python's own."""

import random
import re
import time

import pytest

from corpus_helpers import SMALL, documents  # noqa: F401
from pontualis.llm import license_scan as ls


def words_of(text):
    low = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def base_of(text):
    w = words_of(text)
    found = [(i, label) for phrase, label in ls.BASE.items() for p in [phrase.split()]
             for i in range(len(w) - len(p) + 1) if w[i:i + len(p)] == p]
    places = [i for i, _ in found]
    return (len(w), len(found), min(places, default=None), max(places, default=None),
            ",".join(sorted({x for _, x in found})))


def test_base_columns_equal_brute_force(spark, documents):
    rng = random.Random(3)
    parts = ["CC", "by", "cc-by", "General", "public", "LICENSE", "all", "rights", "reserved", ".", " ",
             "\n", "é", "0", "_", "all rights reserved", "cc by cc by", "K"]
    texts = [None, "", " ", "cc by", "cc by cc by", "allrights reserved", "all\nrights-reserved",
             "CC BY-NC 4.0", "general public licenses", "cc byé"]
    texts += ["".join(rng.choice(parts) + rng.choice(["", " ", "-"]) for _ in range(rng.randint(0, 40)))
              for _ in range(400)]
    texts += [r.text for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    texts += ["word " * 200_000 + "all rights reserved"]
    frame = documents([(i, t) for i, t in enumerate(texts)]).repartition(3)
    rows = ls.find_licenses(frame).orderBy("doc_id").select("doc_id", "_out.*").collect()
    assert [tuple(r)[1:6] for r in rows] == [base_of(t) for t in texts]
    assert all(0 <= r.score <= 1 and set(filter(None, r.base_labels.split(",")))
               <= set(r.labels.split(",")) for r in rows)


def test_every_phrase_equals_a_search_of_its_words():
    rng = random.Random(9)
    phrases = ls.phrases()
    pieces = [p for phrase in phrases for p in phrase.split()] + ["the", "x"]
    for _ in range(300):
        w = [rng.choice(pieces) for _ in range(30)]
        text = " " + " ".join(w) + " "
        got = sorted((text[:end - v[0] - 1].count(" "), v[2]) for end, v in ls.automaton().iter(text) if v[2])
        want = sorted((i, label) for phrase, label in phrases.items() for p in [phrase.split()]
                      for i in range(len(w)) if w[i:i + len(p)] == p)
        assert got == want


def tree(rng, depth):
    """A random expression: its tokens, openness and labels, built as a tree."""
    if depth == 0 or rng.random() < 0.3:
        name = rng.choice(["MIT", "GPL-2.0-or-later", "Apache-2.0", "CC-BY-NC-4.0", "made-up", "LGPL-2.1+"])
        label = ls.label_of(name)
        value, tokens = ls.OPENNESS.get(label, ls.OTHER_OPENNESS), [name]
        if rng.random() < 0.3:
            return [*tokens, rng.choice(["WITH", "with"]), "Classpath-exception-2.0"], (1 + value) / 2, {label}
        return tokens, value, {label}
    parts = [tree(rng, depth - 1) for _ in range(rng.randint(2, 3))]
    operator = rng.choice(["AND", "or", "and", "OR"])
    tokens = [t for i, (p, _, _) in enumerate(parts)
              for t in ([operator] if i else []) + (["(", *p, ")"] if len(p) > 1 else p)]
    value = (max if operator.lower() == "or" else min)(v for _, v, _ in parts)
    return tokens, value, set().union(*(s for _, _, s in parts))


def test_random_expressions():
    rng = random.Random(2)
    for _ in range(500):
        tokens, value, labels = tree(rng, 4)
        assert ls.evaluate(ls.expression(tokens)) == (value, labels), tokens


def test_precedence_without_parentheses():
    value = lambda text: ls.evaluate(ls.expression(text.split()))[0]
    assert value("MIT OR GPL-3.0 AND CC-BY-NC-4.0") == 0.9
    assert value("( MIT OR GPL-3.0 ) AND CC-BY-NC-4.0") == 0.2
    assert value("GPL-2.0 WITH x AND MIT") == 0.75


@pytest.mark.parametrize("tokens, postfix", [
    ([], []), (["AND"], []), (["MIT", "AND"], ["MIT"]), (["MIT", ")"], ["MIT"]),
    (["MIT", "OR", "(", "ISC"], ["MIT"]), (["(", "MIT"], ["MIT"]), (["MIT", "ISC"], ["MIT"]),
    (["(", ")"], [])])
def test_broken_expressions_keep_their_beginning(tokens, postfix):
    assert ls.expression(tokens) == postfix


@pytest.mark.parametrize("text, labels, score", [
    ("// SPDX-License-Identifier: (MIT OR GPL-2.0-only) AND ISC\ncode", "isc,mit", 0.1),
    ("SPDX-License-Identifier: GPL-2.0 WITH Classpath-exception-2.0", "gpl-2.0", 0.25),
    ("SPDX-License-Identifier:", "", 0.0), ("SPDX-License-Identifier: Foo-1", "other", 0.6),
    ("Released under the MIT License.", "mit", 0.1),
    ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0", 0.8),
    ("under the GNU General Public License, version 3.", "gpl,gpl-3.0", 0.5),
    ("the MIT License or the Apache License, Version 2.0", "apache-2.0,mit", 0.1),
    ("the MIT License or the GNU General Public License", "gpl,mit", 0.1),
    ("the MIT License and the GNU General Public License", "gpl,mit", 0.5),
    ("MIT License. All rights reserved.", "mit,reserved", 1.0),
    ("Er kommt mit einem Apache", "", 0.0)])
def test_labels_and_scores(text, labels, score):
    found = ls.scan(text)
    if "(MIT OR GPL-2.0-only)" in text:
        labels = "gpl-2.0,isc,mit"
    assert (found[5], round(found[6], 6)) == (labels, score)


def test_empty_table_and_repeated_rows(spark, documents):
    assert ls.find_licenses(documents([])).collect() == []
    got = ls.find_licenses(documents([(1, "cc by"), (1, "cc by"), (None, None)])).collect()
    assert len(got) == 3 and got[0] == got[1]


@pytest.mark.parametrize("joined", ["\n", " ", " mit license "])
def test_many_tags_take_seconds(joined):
    text = f"SPDX-License-Identifier: MIT{joined}" * 20_000
    start = time.perf_counter()
    assert ls.scan(text)[5] == "mit"
    assert time.perf_counter() - start < 5
