"""Personal data: weak labelers vote, expectation-maximisation weighs them, a classifier decides.

Four fixed patterns give base spans, which always stay.  Further candidates are
long digit groups, handles and all runs of capitalised words, accented letters included.
Labelers vote for, against or not at all on every candidate, base spans included: its
format, a checksum, a gazetteer, an honorific before it, the words before it, its shape,
whether it only begins a sentence, and whether its words also occur in lower case in the same text.
None of them decides alone which candidates there are.  How often each pattern of votes and features
occurs is counted over all documents; their number is bounded by the possible
patterns.  Expectation-maximisation over the counts estimates how reliable each
labeler is on each kind and how likely each pattern is personal data, and a logistic
regression trained on those soft labels decides which candidates are added.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.batches import map_texts
from pontualis.llm.tables import Workspace
from pontualis.llm.words import byte_class, per_text, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "number", "handle", "name")
LABELERS = ("format", "checksum", "gazetteer", "honorific", "context", "shape", "start", "frequency")
# A candidate is added when the classifier gives it at least this probability.
ACCEPT = 0.9
ROUNDS = 60
# Pseudo-counts of no vote, a vote for and one against, where a candidate is none and where it is one.
PSEUDO = ((2.0, 0.5, 2.0), (2.0, 2.0, 0.5))
CONTEXT = 40

# The base patterns.  Possessive runs and the look-behind change no
# match, they only keep long digit runs linear.
_EMAIL_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_EMAIL_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NUMBER = re.compile(r"(?<![0-9A-Za-z])[0-9](?:[\x20.()/-]{0,2}[0-9]){6,}(?![0-9A-Za-z])")
_HANDLE = re.compile(r"(?<![A-Za-z0-9._%+@-])@[A-Za-z0-9_]{3,30}(?![A-Za-z0-9_@])")


def _letters(test: Callable[[str], bool]) -> str:
    """Letters of the alphabets below U+2000 that pass a test, for a character class."""
    return "".join(c for c in map(chr, range(0x2000)) if c.isalpha() and test(c))


# A combining mark belongs to the letter before it.
_LOWER_LETTERS = _letters(str.islower) + "\u0300-\u036f"
_UPPER_LETTERS = _letters(str.isupper)
_CAPITALISED = f"[{_UPPER_LETTERS}](?:['’][{_UPPER_LETTERS}])?[{_LOWER_LETTERS}]+(?:['’-][{_UPPER_LETTERS}]?[{_LOWER_LETTERS}]+)*"
_RUN = re.compile(rf"(?<![\w@'’-]){_CAPITALISED}(?:\x20{_CAPITALISED})*(?![\w@])")
_PLAIN_WORD = re.compile(f"(?<![\\w'’-])[{_LOWER_LETTERS}]+")
# Words of a run from which on it looks like a heading.
LONG_RUN = 5

# Small gazetteers and context words; callers may pass their own.
FIRST_NAMES = frozenset(
    "Alice Anna Anne Antonio Carlos Carmen Charles Claire Daniel David Elena Emma Eva Francisco "
    "George Hans Helen Jack James Jan Jean John Jose Juan Julia Karl Laura Lisa Louis Lucas Luis "
    "Maria Marie Mark Martin Mary Michael Miguel Nicolas Paul Pedro Peter Pierre Robert Sara Sarah "
    "Sofia Sophie Stefan Susan Thomas Victor Werner William".split())
HONORIFICS = frozenset("Mr Mrs Ms Dr Prof Herr Frau Monsieur Madame Senor Senora Don".split())
CONTEXT_FOR = re.compile(
    r"(?i)\b(tel|phone|call|fax|mobile|handy|telefon|telefono|card|visa|account|konto|iban|ssn|"
    r"passport|contact|name|mail|email|user|client|patient|address)\b")
CONTEXT_AGAINST = re.compile(
    r"(?i)\b(isbn|issn|version|page|pages|year|figure|fig|table|vol|doi|price|order|invoice|total|"
    r"chapter|section|article)\b")

SPANS = "array<struct<kind: int, start: int, end: int, pattern: int>>"
_HINT = byte_class((0x30, 0x39), (ord("@"), ord("@")))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    last = 0
    at = text.find("@")
    while at >= 0:
        begin = at
        while begin > last and _EMAIL_LOCAL.match(text, begin - 1):
            begin -= 1
        domain = _EMAIL_DOMAIN.match(text, at + 1) if begin < at else None
        if domain:
            last = domain.end()
            yield begin, last
        at = text.find("@", max(at + 1, last))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the fixed patterns, by kind and start."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0")[:4] or 0) <= 255
               for p in m.group().split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = _digits(m.group())
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= len(_digits(m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def _names(text: str, honorifics: frozenset[str] = HONORIFICS) -> Iterator[tuple[int, int]]:
    """Runs of two or more capitalised words, or of one behind an honorific.

    Honorifics and context words at the beginning of a run stand before the name.
    """
    for run in _RUN.finditer(text):
        words, begin = run.group().split(" "), run.start()
        titled = False
        while words and (words[0] in honorifics or len(words) > 1 and CONTEXT_FOR.fullmatch(words[0])):
            titled = titled or words[0] in honorifics
            begin += len(words.pop(0)) + 1
        if len(words) > 1 or words and (titled or _word_before(text, begin) in honorifics):
            yield begin, run.end()


def _word_before(text: str, start: int) -> str:
    words = text[max(0, start - 14):start].replace(".", " ").split()
    return words[-1] if words else ""


def more_candidates(text: str, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Candidates outside the base spans."""
    out = [(k, *m.span()) for k, pattern in ((4, _NUMBER), (5, _HANDLE)) for m in pattern.finditer(text)]
    out += [(6, a, b) for a, b in _names(text)]
    merged: list[list[int]] = []
    for a, b in sorted((a, b) for _, a, b in taken):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    ends = [b for _, b in merged]

    def free(start: int, end: int) -> bool:
        i = bisect_right(ends, start)
        return i == len(merged) or merged[i][0] >= end

    return [c for c in out if free(c[1], c[2])]


_START = re.compile(r"(?:^|[.!?…\n][\s\"'»)(]*)$")


def votes(text: str, kind: int, start: int, end: int, names: frozenset[str],
          plain: frozenset[str] = frozenset()) -> tuple[int, ...]:
    """Votes of all labelers: 1 for, 2 against, 0 none; ``plain`` are the lower-case words of the text."""
    span, name = text[start:end], KINDS[kind]
    digits = _digits(span)
    before = text[max(0, start - CONTEXT):start]
    form = {"email": 1, "ip": 1, "card": 1, "phone": 1, "handle": 1}.get(name, 0)
    if name == "number":
        form = 1 if re.fullmatch(r"\(?[0-9]{3}\)?[ -][0-9]{3}[ -][0-9]{4}|[0-9]{4}([ -][0-9]{4}){3}", span) else 2
    check = 0
    if name in ("card", "number") and len(digits) >= 13:
        check = 1 if luhn(digits) else 2
    gazetteer = honorific = begin = common = 0
    if name == "name":
        words = span.split(" ")
        gazetteer = int(not names.isdisjoint(words))
        honorific = int(_word_before(text, start) in HONORIFICS)
        # The stop behind an honorific ends no sentence.
        begin = 2 if not honorific and _START.search(text[max(0, start - 8):start]) else 0
        common = 2 if any(w.lower() in plain for w in words) else 0
    elif name in ("card", "number") and len(digits) >= 13:
        gazetteer = 1 if digits[0] in "3456" else 2
    elif name == "phone":
        gazetteer = 1 if digits[0] != "0" else 2
    context = 1 if CONTEXT_FOR.search(before) else 2 if CONTEXT_AGAINST.search(before) else 0
    shape = 0
    if digits:
        flat = len(set(digits)) <= 2 or digits in "01234567890123456789"
        dated = re.match(r"(?:19|20)[0-9]{2}[-./][0-9]{1,2}[-./][0-9]{1,2}|[0-9]{1,2}[-./][0-9]{1,2}[-./](?:19|20)[0-9]{2}", span)
        shape = 2 if flat or dated else 1
    elif name == "name":
        shape = 2 if span.count(" ") + 1 >= LONG_RUN else 0
    return form, check, gazetteer, honorific, context, shape, begin, common


def _pattern(kind: int, vote: tuple[int, ...], length: int) -> int:
    """One integer for kind, votes and length class."""
    code = kind
    for v in vote:
        code = code * 3 + v
    return code * 4 + min(length // 8, 3)


def _features(pattern: int) -> tuple[int, list[int], int]:
    length, code = pattern % 4, pattern // 4
    vote = []
    for _ in LABELERS:
        vote.append(code % 3)
        code //= 3
    return code, vote[::-1], length


def _scan(column: pa.Array, names: frozenset[str]) -> dict[str, pa.Array]:
    """Base spans and candidates of a slice of texts; most texts are skipped by their bytes."""
    texts = texts_of(column)
    hinted = per_text(_HINT[texts.data], texts.bounds) > 0
    rows = []
    for i in range(len(texts)):
        text = texts.text(i)
        base = base_spans(text) if hinted[i] else []
        spans = base + more_candidates(text, base)
        plain = frozenset(_PLAIN_WORD.findall(text)) if any(k == 6 for k, *_ in spans) else frozenset()
        rows.append([{"kind": k, "start": a, "end": b,
                      "pattern": _pattern(k, votes(text, k, a, b, names, plain), b - a)}
                     for k, a, b in spans])
    kind = pa.struct([(n, pa.int32()) for n in ("kind", "start", "end", "pattern")])
    return {"spans": pa.array(rows, pa.list_(kind))}


def estimate(counts: dict[int, int]) -> dict[int, float]:
    """Probability that each counted pattern is personal data, by expectation-maximisation.

    Labelers are independent given the truth; each has a distribution over its three
    votes per kind and class, and each kind a prior.  Pseudo-counts keep them off 0 and 1 and
    say that a labeler is right rather than wrong; a candidate without votes starts below one half.
    """
    if not counts:
        return {}
    patterns = sorted(counts)
    weight = np.array([counts[p] for p in patterns], float)
    kinds = np.array([_features(p)[0] for p in patterns])
    vote = np.array([_features(p)[1] for p in patterns])
    score = (vote == 1).sum(1) - (vote == 2).sum(1)
    truth = 1 / (1 + np.exp(0.5 - score))
    for _ in range(ROUNDS):
        logs = np.zeros((len(patterns), 2))
        for side, share in enumerate((1 - truth, truth)):
            mass = weight * share
            prior = np.bincount(kinds, mass, len(KINDS)) + 1
            logs[:, side] += np.log(prior[kinds])
            for j in range(len(LABELERS)):
                table = np.bincount(3 * kinds + vote[:, j], mass, 3 * len(KINDS)).reshape(-1, 3)
                table += PSEUDO[side]
                logs[:, side] += np.log(table[kinds, vote[:, j]] / table.sum(1)[kinds])
        truth = 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -50, 50)))
    return dict(zip(patterns, truth.tolist()))


def train(counts: dict[int, int], soft: dict[int, float]) -> dict[int, float]:
    """Probability of each pattern by a logistic regression on the soft labels."""
    if not counts:
        return {}
    patterns = sorted(counts)
    block = 1 + 3 * len(LABELERS) + 4
    x = np.zeros((len(patterns), 1 + len(KINDS) * block))
    for row, p in enumerate(patterns):
        kind, vote, length = _features(p)
        own = 1 + kind * block
        x[row, [0, own, own + 1 + 3 * len(LABELERS) + length]] = 1
        for j, v in enumerate(vote):
            x[row, own + 1 + 3 * j + v] = 1
    y = np.array([soft[p] for p in patterns])
    n = np.array([counts[p] for p in patterns], float)
    n = n / n.sum() * len(patterns)
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (n * (p - y)) + 0.1 * w
        curve = (x * (n * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(w))
        w -= np.linalg.solve(curve, slope)
    return dict(zip(patterns, (1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))).tolist()))


def find_personal_data(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",), text: str = "text",
                       names: frozenset[str] = FIRST_NAMES) -> DataFrame:
    """Columns ``keep`` of every row; ``_out.base`` and ``_out.spans`` by kind and start.

    Offsets are code points, end exclusive.  NULL and empty texts have no spans.  Repeated
    rows are all returned and counted; other columns may have any name.  Without any
    candidate nothing is added.
    """
    workspace = Workspace(docs.sparkSession, "personal-data")
    scanned = map_texts(docs, text, keep, f"spans {SPANS}", lambda c: _scan(c, names))
    scanned = workspace.save(scanned, "spans")
    rows = (scanned.select(F.explode("_out.spans").alias("s")).groupBy("s.pattern")
            .agg(F.count(F.lit(1)).alias("n")).collect())
    counts = {r["pattern"]: r["n"] for r in rows}
    chance = train(counts, estimate(counts))
    accepted = F.array(*[F.lit(p) for p in sorted(chance) if chance[p] >= ACCEPT]).cast("array<int>")
    base = F.filter("_out.spans", lambda s: s["kind"] < len(BASE_KINDS))
    spans = F.filter("_out.spans", lambda s: (s["kind"] < len(BASE_KINDS))
                     | F.array_contains(accepted, s["pattern"]))
    return scanned.select(*[F.col(f"`{c}`") for c in keep],
                          F.struct(base.alias("base"), F.array_sort(spans).alias("spans")).alias("_out"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda s: s["kind"] == number)).cast("bigint")
