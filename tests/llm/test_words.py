"""Vectorised words, shingles and lines against plain Python."""

import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from pontualis.llm import words as W

PIECES = st.lists(st.sampled_from([" ", "\n", "\t", "\x0b", "\x1c", "a", "B", "é", "日", "😀", "1", "-"]),
                  max_size=30).map("".join)


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), PIECES), max_size=6))
def test_words_shingles_and_lines(texts):
    made = W.texts_of(pa.array(texts, pa.string()))
    words = W.words_of(made, W.NOT_SPACE, W.LOWER)
    lines = W.lines_of(made, words)
    sets, bounds = W.shingle_sets(words, 3)
    names: dict[int, tuple] = {}
    for i, text in enumerate(t or "" for t in texts):
        plain = re.findall(r"[^\x20\x09-\x0D]+", lower(text))
        own = range(words.first[i], words.first[i + 1])
        assert [lower(made.data[words.start[j]:words.end[j]].tobytes().decode()) for j in own] == plain
        for j, word in zip(own, plain):
            assert names.setdefault(int(words.hash[j]), word) == word
        shingles = {tuple(plain[k:k + 3]) for k in range(len(plain) - 2)} or (
            {tuple(plain)} if plain else set())
        found = sets[bounds[i]:bounds[i + 1]]
        assert len(found) == len(shingles) and (np.diff(found.astype(object)) > 0).all()
        full = [ln for ln in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", ln)]
        hashes = lines.hash[lines.first[i]:lines.first[i + 1]].tolist()
        assert len(hashes) == len(full) and len(set(hashes)) == len(set(full))


def test_slices_hold_every_row_once():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 50, None, "", "y" * 500, "z"])], ["t"])
    parts = list(W.slices(batch, "t", 60))
    assert sum(p.num_rows for p in parts) == 5 and len(parts) > 1
    assert [v for p in parts for v in p.column(0).to_pylist()] == batch.column(0).to_pylist()
