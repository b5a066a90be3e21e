"""Substring dedup: short lines, paragraphs, and passages that begin or end inside a sentence."""

import random
import re
from collections import defaultdict

from corpus_helpers import documents  # noqa: F401

from pontualis.llm import substring_dedup


def removed(frame):
    out = defaultdict(set)
    for r in substring_dedup.find_repeats(frame).collect():
        out[r.doc_id] |= set(range(r.start, r.end))
    return out


def brute(rows, least=20):
    """Places that lines, paragraphs, runs and windows at sentence ends remove; no sentence is long."""
    first, out = {}, defaultdict(set)
    for d, text in sorted(rows):
        w = [(*m.span(), m.group().lower()) for m in re.finditer(r"\S+", text)]
        gaps = [text[b:w[i + 1][0]].count("\n") if i + 1 < len(w) else 2 for i, (_, b, _) in enumerate(w)]
        ends, lines, paragraphs = ([i + 1 for i, g in enumerate(gaps) if (g >= n if n else g or w[i][2][-1] in ".!?")]
                                   for n in (0, 1, 2))
        begins = [0, *ends[:-1]]
        units = {*zip([0, *lines[:-1]], lines), *zip([0, *paragraphs[:-1]], paragraphs)}
        units |= {(s, next(e for e in ends if e >= s + least)) for s in begins if ends[-1] >= s + least}
        units |= {(max(s for s in begins if e - s >= least), e) for e in lines if e >= least}
        units |= {(e - least, e) for e in ends if e >= least}
        for s, e in sorted(units):
            key = tuple(x[2] for x in w[s:e])
            known = first.setdefault(key, (d, s, e))
            if known[0] != d or s >= known[2]:
                out[d] |= set(range(w[s][0], w[e - 1][1]))
    return out


def test_units_equal_brute_force(documents):
    rng, rows = random.Random(6), []
    pool = [" ".join(f"w{rng.randint(0, 99)}" for _ in range(rng.randint(1, 14))) for _ in range(25)]
    for i in range(60):
        parts = [rng.choice(pool) + rng.choice([". ", "! ", "\n", "\n\n", "\n \n", ". "]) for _ in range(rng.randint(1, 14))]
        rows.append((i, "".join(parts)))
    got, expected = removed(documents(rows)), brute(rows)
    for i, _ in rows:
        assert got[i] == expected[i]
    assert expected


def test_short_lines_and_cut_passages(documents):
    line = "All rights reserved by nobody."
    rows = [(1, f"one thing first\n{line}\nthe end"), (2, f"something else\n{line.upper()}\n{line}")]
    assert removed(documents(rows)) == {2: set(range(15, 15 + len(line))) | set(range(46, 46 + len(line)))}
    passage = " ".join(f"w{i}" for i in range(30)) + ". And so on it goes."
    rows = [(5, f"Intro, mid {passage} Then y."), (2, f"Other start. {passage}\nend")]
    assert removed(documents(rows)).keys() == {5}


def test_every_passage_of_fifty_words_holds_a_unit(documents):
    rng, rows, marks = random.Random(7), [], {}
    for i in range(150):
        words = [f"w{rng.randint(0, 10**9)}" for _ in range(substring_dedup.PASSAGE)]
        for k in rng.sample(range(50), rng.randint(0, 2)) if i else ():
            words[k] += "."
        around = lambda: " ".join(f"x{rng.randint(0, 10**9)}" for _ in range(rng.randint(0, 40)))
        rows += [(1000 + i, f"{around()} {' '.join(words)} {around()}"), (i, f"{around()} {' '.join(words)} {around()}")]
        marks[1000 + i] = " ".join(words)
    got = removed(documents(rows))
    for i, text in rows:
        if i >= 1000:
            begin = text.index(marks[i])
            assert got[i] and got[i] <= set(range(begin, begin + len(marks[i])))
        else:
            assert not got[i]


def test_a_repeated_word_keeps_its_first_run(documents):
    rows = [(1, "na. " * 100), (2, "la " * 100)]
    left = {r.doc_id: len(r.text.split()) for r in substring_dedup.remove_repeats(documents(rows)).collect()}
    assert left[1] >= 20 and left[2] >= 20
