"""License scans: an Aho-Corasick automaton for tags and notices, a shunting-yard parser for expressions.

The words of a text, lower-cased and joined by single spaces, run through one automaton that
reports every place where the words of a phrase stand one after another.  Phrases are
license notices (``mit license``) and the words of identifier tags (``spdx license
identifier``), after which the rest of the line is an expression in ``AND``, ``OR``,
``WITH`` and parentheses.  Notices that are joined by such a word alone form an expression
too.  Each expression is brought into postfix order and evaluated: a licence has an
openness from 0 to 1, ``AND`` takes the smaller, ``OR`` the larger one, and an exception
behind ``WITH`` halves what is missing to 1.  All expressions of a document hold at
once, so its openness is the smallest; the score, 1 less that openness, is 0 without any.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator, Sequence
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from pontualis.llm.batches import map_texts
from pontualis.llm.words import ALPHANUMERIC, LOWER

# Phrases every scan reports, and their labels.
BASE = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
# Words of tags behind which an expression stands.
TAGS = ("spdx license identifier", "license expression")
# Openness by label: what a reader may do with a text under that licence.
OPENNESS = {
    "cc0-1.0": 1.0, "public-domain": 1.0, "unlicense": 1.0,
    "mit": 0.9, "isc": 0.9, "zlib": 0.9, "bsl-1.0": 0.9, "bsd": 0.9, "bsd-2-clause": 0.9,
    "bsd-3-clause": 0.9, "apache": 0.9, "apache-2.0": 0.9,
    "cc-by": 0.8, "cc-by-4.0": 0.8, "cc-by-3.0": 0.8,
    "mpl": 0.7, "mpl-2.0": 0.7, "lgpl": 0.7, "lgpl-2.1": 0.7, "lgpl-3.0": 0.7, "epl": 0.7, "epl-2.0": 0.7,
    "cc-by-sa": 0.6, "cc-by-sa-4.0": 0.6, "cc-by-sa-3.0": 0.6,
    "gpl": 0.5, "gpl-2.0": 0.5, "gpl-3.0": 0.5, "agpl": 0.4, "agpl-3.0": 0.4,
    "cc-by-nd": 0.3, "cc-by-nd-4.0": 0.3, "cc-by-nc": 0.2, "cc-by-nc-4.0": 0.2,
    "cc-by-nc-sa": 0.2, "cc-by-nc-sa-4.0": 0.2, "cc-by-nc-nd": 0.1, "cc-by-nc-nd-4.0": 0.1,
    "proprietary": 0.0, "reserved": 0.0,
}
OTHER, OTHER_OPENNESS = "other", 0.4
# Notices beyond the spellings that follow from the labels themselves.
NOTICES = {
    "mit license": "mit", "isc license": "isc", "zlib license": "zlib", "boost software license": "bsl-1.0",
    "bsd license": "bsd", "apache license": "apache", "apache license version 2 0": "apache-2.0",
    "mozilla public license": "mpl", "mozilla public license version 2 0": "mpl-2.0",
    "eclipse public license": "epl", "eclipse public license version 2 0": "epl-2.0",
    "lesser general public license": "lgpl", "lesser general public license version 2 1": "lgpl-2.1",
    "lesser general public license version 3": "lgpl-3.0",
    "general public license version 2": "gpl-2.0", "general public license version 3": "gpl-3.0",
    "affero general public license": "agpl", "affero general public license version 3": "agpl-3.0",
    "creative commons attribution": "cc-by", "creative commons zero": "cc0-1.0",
    "public domain": "public-domain", "proprietary and confidential": "proprietary",
}
# Labels that are ordinary words are notices only as spelled above or behind a tag.
_WORDY = ("mit", "isc", "zlib", "bsd", "apache", "unlicense", "mpl", "epl", "public-domain",
          "proprietary", "reserved")
# Words that may stand between two joined notices beside the operator.
_FILLERS = frozenset(("the", "a", "either", "gnu", "license", "licence", "licenses", "under", "terms", "of"))
_PRECEDENCE = {"or": 1, "and": 2, "with": 3}
_TOKEN = re.compile(rb"[\x20\t]*(?:([()])|([A-Za-z0-9][A-Za-z0-9.+:-]*))")
_MARKS = re.compile(rb"[\x20\t:=\"']*")
_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

FOUND = ("n_words bigint, n_base bigint, first_word bigint, last_word bigint, base_labels string, "
         "labels string, score double")

_SPACED = bytes(int(b) if w else 0x20 for b, w in zip(LOWER, ALPHANUMERIC[LOWER]))


def phrases() -> dict[str, str]:
    """Every notice and its label; a label with its marks as spaces is a notice as well."""
    spelled = {re.sub("[^a-z0-9]+", " ", label): label for label in OPENNESS if label not in _WORDY}
    return spelled | NOTICES | BASE


@lru_cache(maxsize=1)
def automaton() -> ahocorasick.Automaton:
    """Phrases and tags with a space on both sides; the value is words, label and kind."""
    found = ahocorasick.Automaton()
    for phrase, label in phrases().items():
        found.add_word(f" {phrase} ", (len(phrase), len(phrase.split()), label, phrase in BASE))
    for tag in TAGS:
        found.add_word(f" {tag} ", (len(tag), len(tag.split()), None, False))
    found.make_automaton()
    return found


def label_of(identifier: str) -> str:
    """The label of an identifier in an expression; one that is not known is ``other``."""
    name = identifier.lower().removesuffix("+").removesuffix("-only").removesuffix("-or-later")
    return name if name in OPENNESS else OTHER


def expression(tokens: Iterable[str]) -> list[str]:
    """The longest well-formed beginning of an expression, in postfix order.

    A closing parenthesis without an opening one ends it, an operator without a right side
    and a parenthesis that is never closed do not count.
    """
    out, stack = [], []
    operand_next, good = True, 0
    kept: list[str] = []
    for token in tokens:
        kind = token.lower()
        if kind == "(" and operand_next:
            stack.append(kind)
        elif kind == ")" and not operand_next and "(" in stack:
            while stack[-1] != "(":
                out.append(stack.pop())
            stack.pop()
        elif kind in _PRECEDENCE and not operand_next:
            while stack and stack[-1] != "(" and _PRECEDENCE[stack[-1]] >= _PRECEDENCE[kind]:
                out.append(stack.pop())
            stack.append(kind)
            operand_next = True
        elif kind not in _PRECEDENCE and kind not in "()" and operand_next:
            out.append(token)
            operand_next = False
        else:
            break
        if not operand_next and "(" not in stack:
            kept, good = out + stack[::-1], good + 1
    if not good:  # only opening parentheses before what broke off
        rest = [t for t in out if t not in _PRECEDENCE]
        return rest[:1]
    return kept


def evaluate(postfix: Sequence[str]) -> tuple[float | None, set[str]]:
    """Openness and labels of an expression; the name behind ``WITH`` is no licence."""
    stack: list[tuple[float, set[str]]] = []
    for token in postfix:
        if token in _PRECEDENCE:
            (right, more), (left, labels) = stack.pop(), stack.pop()
            if token == "with":
                stack.append(((1 + left) / 2, labels))
            else:
                stack.append(((max if token == "or" else min)(left, right), labels | more))
        else:
            label = label_of(token)
            stack.append((OPENNESS.get(label, OTHER_OPENNESS), {label}))
    return stack[-1] if stack else (None, set())


def _behind_tag(raw: bytes, at: int, end: int) -> Iterator[str]:
    """Tokens from behind a tag up to the end of its line, one by one."""
    at = _MARKS.match(raw, at, end).end()
    while found := _TOKEN.match(raw, at, end):
        yield (found[1] or found[2]).decode()
        at = found.end()


def _statements(hits: list[tuple[int, int, str]], words: list[bytes]) -> list[list[str]]:
    """Runs of notices as tokens: joined ones in one list, others in lists of their own."""
    out: list[list[str]] = []
    last_end = None
    for start, size, label in hits:
        joined = None
        if last_end is not None and start - last_end <= 6:
            between = [w.decode("utf-8", "replace") for w in words[last_end:start]]
            operators = [w for w in between if w in ("and", "or")]
            if len(operators) == 1 and all(w in _FILLERS or w in operators for w in between):
                joined = operators[0]
        if joined:
            out[-1] += [joined, label]
        else:
            out.append([label])
        last_end = start + size
    return out


def scan(text: str | None) -> tuple:
    """The columns of ``FOUND`` for one text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.translate(_SPACED).split()
    spaced = b" " + b" ".join(words) + b" "
    found = list(automaton().iter(spaced.decode("latin-1")))
    if not found:
        return len(words), 0, None, None, "", "", 0.0
    gaps = np.flatnonzero(np.frombuffer(spaced, np.uint8) == 0x20)
    starts = np.searchsorted(gaps, [end - 1 - length for end, (length, *_) in found], "left").tolist()
    base = [(i, v[2]) for i, (_, v) in zip(starts, found) if v[3]]
    # Of notices that overlap, the first and then the longest one counts.
    hits, reach = [], 0
    for i, size, label in sorted(((i, v[1], v[2]) for i, (_, v) in zip(starts, found) if v[2]),
                                 key=lambda h: (h[0], -h[1])):
        if i >= reach:
            hits.append((i, size, label))
            reach = i + size
    values, labels = [], {label for _, label in base}
    tagged = [(i + v[1]) for i, (_, v) in zip(starts, found) if v[2] is None]
    if tagged:
        ends = [m.end() for m in _WORD.finditer(raw)]
        spans = []
        for after in sorted(tagged):
            begin = ends[after - 1]
            line_end = raw.find(b"\n", begin)
            line_end = len(raw) if line_end < 0 else line_end
            value, more = evaluate(expression(_behind_tag(raw, begin, line_end)))
            if value is not None:
                values.append(value)
                labels |= more
                spans.append((after, bisect_right(ends, line_end)))
        # What stands in a tag's line has been judged by its expression.
        firsts = [a for a, _ in spans]
        hits = [h for h in hits if not (k := bisect_right(firsts, h[0])) or h[0] >= spans[k - 1][1]]
    for tokens in _statements(hits, words):
        value, more = evaluate(expression(tokens))
        values.append(value)
        labels |= more
    places = [i for i, _ in base]
    return (len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted({label for _, label in base})), ",".join(sorted(labels)),
            1.0 - min(values) if values else 0.0)


def find_licenses(docs: DataFrame, keep: Sequence[str] = ("doc_id",), text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row and ``_out`` with the fields of ``FOUND``.

    Places are word numbers from 0.  NULL and empty texts have no words and the score 0.
    Repeated rows are all returned, and other columns may have any name.
    """
    names = [f.strip().split()[0] for f in FOUND.split(",")]
    types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        rows = [scan(t) for t in texts.to_pylist()]
        return {n: pa.array([r[i] for r in rows], t) for i, (n, t) in enumerate(zip(names, types))}

    return map_texts(docs, text, list(keep), FOUND, work)
