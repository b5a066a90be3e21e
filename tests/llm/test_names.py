"""Names outside the gazetteer, the vote, and expectation-maximisation against plain loops."""

import math
import random
import time

import pytest
from corpus_helpers import documents  # noqa: F401

from pontualis.llm import personal_data as pd_

FIRST = ("Zoltan Ingrid Bartłomiej Þórunn Łukasz Siobhán Émile Ngozi Yuki Priya Dmitri Ömer Željko Aoife "
         "Håkon Noémie Thulani Mirjam").split()
LAST = "Kovacs Olsen Wójcik Jónsdóttir Nowak Ó’Brien Lefèvre Okafor Tanaka Nair Sokolov Yılmaz Ilić".split()
BEFORE = ("please contact ", "our client ", "the patient ", "user name: ", "account of Dr ", "ask Mrs. ")
PLACES = "River Valley Old Harbour Grand Hotel Winter Palace Stone Bridge North Station".split()


def corpus(n, seed):
    """Texts, the names in them, and capitalised pairs that are none."""
    rng = random.Random(seed)
    rows, truth, none = [], {}, {}
    for i in range(n):
        name = f"{rng.choice(FIRST)} {rng.choice(LAST)}"
        if i % 5 == 0:
            name = f"{rng.choice(sorted(pd_.FIRST_NAMES))} {rng.choice(LAST)}"
        place = f"{rng.choice(PLACES)} {rng.choice(PLACES)}"
        low = " ".join(rng.sample([p.lower() for p in PLACES], 6) + ["and", "then", place.lower()])
        text = f"{place} was seen. We went to {low}; {rng.choice(BEFORE)}{name} about it. {place} again."
        rows.append((i, text))
        truth[i] = (text.index(name), text.index(name) + len(name))
        none[i] = text.index(place)
    return rows, truth, none


def test_names_outside_the_gazetteer_are_found(documents):
    rows, truth, none = corpus(600, 1)
    got = {r.doc_id: {(s.start, s.end) for s in r._out.spans if s.kind == 6}
           for r in pd_.find_personal_data(documents(rows)).collect()}
    unlisted = [i for i in truth if i % 5]
    assert sum(truth[i] in got[i] for i in unlisted) >= 0.95 * len(unlisted)
    assert sum(truth[i] in got[i] for i in truth) >= 0.95 * len(truth)
    assert sum(any(a == none[i] for a, _ in got[i]) for i in none) <= 0.02 * len(none)


def test_the_gazetteer_is_a_labeler_and_no_gate(documents):
    text = "contact: Zoltan Kovacs and patient Ingrid Olsen, name: Maria Silva"
    rows = [(i, text) for i in range(40)] + corpus(200, 2)[0]
    rows = [(100 + k if k >= 40 else k, t) for k, (_, t) in enumerate(rows)]
    for r in pd_.find_personal_data(documents(rows)).where("doc_id < 40").collect():
        assert [text[s.start:s.end] for s in r._out.spans] == ["Zoltan Kovacs", "Ingrid Olsen", "Maria Silva"]


@pytest.mark.parametrize("text, names", [
    ("Mr Anna Smith and Dr. Who came", ["Anna Smith", "Who"]), ("é Élodie Müller-Lüdenscheidt x", ["Élodie Müller-Lüdenscheidt"]),
    ("Contact Zoltan Kovacs", ["Zoltan Kovacs"]), ("Single words Are not Names", []), ("ALL CAPS Here", []),
    ("aBc Def Ghi1 Jkl", []), ("Jose\u0301 Nun\u0303ez x", ["Jose\u0301 Nun\u0303ez"]), ("", [])])
def test_candidate_names(text, names):
    assert [text[a:b] for a, b in pd_._names(text)] == names


def test_long_capitalised_runs_are_linear(documents):
    start = time.perf_counter()
    text = "Abc Def " * 100_000 + "x " + "A" * 200_000 + " " + "Ab-" * 100_000
    assert len(list(pd_._names(text))) <= 2
    many = "Aa Bb, a@b.cc, " * 20_000
    assert len(pd_.more_candidates(many, pd_.base_spans(many))) == 20_000
    assert time.perf_counter() - start < 20


def test_expectation_maximisation_equals_plain_loops():
    rng = random.Random(3)
    counts = {}
    for _ in range(150):
        vote = tuple(rng.choice((0, 1, 2)) for _ in pd_.LABELERS)
        counts[pd_._pattern(rng.randrange(len(pd_.KINDS)), vote, rng.randint(1, 30))] = rng.randint(1, 50)
    patterns = {p: pd_._features(p) for p in counts}
    truth = {p: 1 / (1 + math.exp(0.5 - sum((v == 1) - (v == 2) for v in vote)))
             for p, (_, vote, _) in patterns.items()}
    for _ in range(pd_.ROUNDS):
        prior, table = {}, {}
        for p, (kind, vote, _) in patterns.items():
            for side, share in ((0, 1 - truth[p]), (1, truth[p])):
                prior[side, kind] = prior.get((side, kind), 1) + counts[p] * share
                for j, v in enumerate(vote):
                    key = side, kind, j
                    table.setdefault(key, list(pd_.PSEUDO[side]))[v] += counts[p] * share
        for p, (kind, vote, _) in patterns.items():
            logs = [math.log(prior[side, kind]) + sum(
                math.log(table[side, kind, j][v] / sum(table[side, kind, j])) for j, v in enumerate(vote))
                for side in (0, 1)]
            truth[p] = 1 / (1 + math.exp(min(50, max(-50, logs[0] - logs[1]))))
    got = pd_.estimate(counts)
    assert all(got[p] == pytest.approx(truth[p], abs=1e-9) for p in counts)
