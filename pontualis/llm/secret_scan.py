"""Secret scans: fixed patterns, and sliding-window entropy over candidate strings.

Built-in column functions only.  A candidate is a long unbroken run of key
characters.  A window of ``WINDOW`` characters slides over it; each step adds one to the
count of the entering and takes one off that of the leaving character, in counts of five bits
that are carried along in six longs, and the sum of ``n * log2(n)`` that the entropy needs
changes by those two counts.  A candidate is folded in pieces that overlap by a window less
one character, so the work is linear in its length.  A window
lies in a character class when all its characters do; a candidate is a secret
when a window reaches the entropy limit of a class.  What a pattern has found is cut
out of a candidate and the rests are judged.  Windows that hold a word of the allow
list, and rests that are identifiers as a whole, add nothing.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.batches import whole_rows, with_text

WINDOW = 20

# The patterns and the smallest length of what they must hold.
ASSIGN = (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
          r"""([A-Za-z0-9+/_.=-]+)""")
ASSIGN_HINT = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]"""
ACCESS = "AKIA[A-Z0-9]{16,}"
HEX = "[0-9a-f]{24,}"
# Kinds in the order in which spans with the same start are listed.
KINDS = ("assign", "access", "hex", "entropy")

CANDIDATE = "[A-Za-z0-9+/_-]{20,}={0,2}"
_DIGITS, _LOWER, _UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_MARKS = "+/_-"
# The symbols that are counted; a character's code is its place from 1, 0 for any other.
SYMBOLS = _DIGITS + _LOWER + _UPPER + _MARKS + "="
# Class name, its characters, least entropy of a window in bits, and what the
# candidate must also contain to be told from a long word or a path: patterns that are
# searched in linear time.
CLASSES = (
    ("hex", _DIGITS + "abcdefABCDEF", 2.9, ("[0-9]", "[a-fA-F]")),
    ("lower", _DIGITS + _LOWER, 3.5, ("^[^0-9]*+[0-9][^a-z]*+[a-z][^0-9]*+[0-9]",)),
    ("upper", _DIGITS + _UPPER, 3.5, ("^[^0-9]*+[0-9][^A-Z]*+[A-Z][^0-9]*+[0-9]",)),
    ("base64", _DIGITS + _LOWER + _UPPER + _MARKS, 3.9, ("[0-9]", "[a-z]", "[A-Z]")),
)
# Steps in one piece of a candidate.
PIECE = 256
_BITS, _LANES = 5, 6
_PER_LANE = -(-len(SYMBOLS) // _LANES)
# Windows that hold one of these are placeholders or plain sequences, and candidates that
# are one of the others identifiers.
PLACEHOLDER = r"(?i)example|sample|placeholder|changeme|dummy|xxxx|0123456789|abcdefgh|(.)\1{7}"
UUID = "(?i)^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"

_SPAN = "array<struct<start:int,rank:int,end:int,kind:string>>"
_REST = "array<struct<span:struct<start:int,rank:int,end:int,kind:string>,text:string>>"


def _length(text: Column) -> Column:
    return F.length(text)


def _spans(text: Column, pattern: str, kind: str, least_group: int = 0) -> Column:
    """Spans of all matches, from the lengths of the matches and of the gaps between them."""
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    group = F.regexp_extract_all(text, F.lit(pattern), F.lit(1)) if least_group else whole
    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(whole))

    def step(acc: Column, part: Column) -> Column:
        begin = acc["at"] + _length(part["gaps"])
        end = begin + _length(part["whole"])
        span = F.struct(begin.alias("start"), F.lit(KINDS.index(kind)).alias("rank"),
                        end.alias("end"), F.lit(kind).alias("kind"))
        more = F.array(span)
        if least_group:
            more = F.when(_length(part["group"]) >= least_group, more).otherwise(_none())
        return F.struct(end.alias("at"), F.concat(acc["spans"], more).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), _none().alias("spans"))
    parts = F.arrays_zip(gaps.alias("gaps"), whole.alias("whole"), group.alias("group"))
    return F.aggregate(parts, begin, step, lambda acc: acc["spans"])


def _none() -> Column:
    return F.array().cast(_SPAN)


def _identifier(token: Column) -> Column:
    """True for a UUID and for words joined by single marks, with a number of up to 8 digits behind."""
    words = F.regexp_replace(token, "[/_-][0-9]{1,8}$", "")
    return token.rlike(UUID) | (~words.rlike("[^A-Za-z/_-]|[/_-][/_-]|^[^A-Za-z]|[^A-Za-z]$") & (words != ""))


def _of_code(code: Column, values: list[int]) -> Column:
    return F.get(F.array(*[F.lit(v).cast("bigint") for v in values]), code)


# By code: the long that holds its count, the place of the count there and one at that place.
_LANE = [-1, *[k // _PER_LANE for k in range(len(SYMBOLS))]]
_SHIFT = [0, *[k % _PER_LANE * _BITS for k in range(len(SYMBOLS))]]
_WEIGHTS = [n * math.log2(n) if n else 0.0 for n in range(WINDOW + 1)]


def _piece_found(piece: Column, fits: list[Column]) -> Column:
    """True when a window of a piece lies in a class and reaches its entropy."""
    codes = F.transform(F.split(piece, ""), lambda c: F.instr(F.lit(SYMBOLS), c))
    gone = F.concat(F.array_repeat(F.lit(0), WINDOW), codes)
    steps = F.zip_with(codes, F.slice(gone, F.lit(1), F.length(piece)), lambda a, b: F.struct(
        a.alias("code"), b.alias("out")))
    one, weights = F.lit(1).cast("bigint"), F.array(*[F.lit(w) for w in _WEIGHTS])

    def changed(lanes: list[Column], code: Column, sign: int) -> tuple[list[Column], Column]:
        """The counts with one more or less of a code, and the change of the sum of weights."""
        lane, shift = _of_code(code, _LANE), _of_code(code, _SHIFT).cast("int")
        unit = F.call_function("shiftleft", one, shift) * sign
        held = F.call_function("shiftright", F.get(F.array(*lanes), lane.cast("int")), shift)
        count = held.bitwiseAND(F.lit((1 << _BITS) - 1)).cast("int")
        change = F.get(weights, count + sign) - F.get(weights, count)
        return ([k + F.when(lane == i, unit).otherwise(F.lit(0).cast("bigint")) for i, k in enumerate(lanes)],
                F.when(code > 0, change).otherwise(F.lit(0.0)))

    def left(acc: Column, step: Column) -> Column:
        lanes, change = changed([acc[f"n{i}"] for i in range(_LANES)], step["out"], -1)
        return F.struct(*[k.alias(f"n{i}") for i, k in enumerate(lanes)],
                        (acc["total"] + change).alias("total"))

    def entered(acc: Column, step: Column, rest: Column) -> Column:
        lanes, change = changed([rest[f"n{i}"] for i in range(_LANES)], step["code"], 1)
        runs = [F.when(_of_code(step["code"], [0, *[int(s in chars) for s in SYMBOLS]]) == 1,
                       acc[name] + 1).otherwise(F.lit(0)) for name, chars, *_ in CLASSES]
        return F.struct(*[k.alias(f"n{i}") for i, k in enumerate(lanes)],
                        (rest["total"] + change).alias("total"), (acc["at"] + 1).alias("at"),
                        acc["found"].alias("found"), *[r.alias(c[0]) for r, c in zip(runs, CLASSES)])

    def judged(acc: Column) -> Column:
        bits = F.lit(math.log2(WINDOW)) - acc["total"] / WINDOW
        reached = reduce(lambda a, b: a | b, [
            (acc[name] >= WINDOW) & (bits >= least - 1e-9) & fit
            for (name, _, least, _), fit in zip(CLASSES, fits)])
        window = F.substring(piece, acc["at"] - WINDOW + 1, F.lit(WINDOW))
        found = acc["found"] | (reached & ~window.rlike(PLACEHOLDER))
        return acc.withField("found", found)

    def bound(value: Column, then: Callable[[Column], Column]) -> Column:
        """``then`` of a value that is evaluated once, however often it is used."""
        return F.get(F.transform(F.array(value), then), F.lit(0))

    def step(acc: Column, one_step: Column) -> Column:
        return bound(left(acc, one_step),
                     lambda rest: bound(entered(acc, one_step, rest), judged))

    zero = F.lit(0).cast("bigint")
    begin = F.struct(*[zero.alias(f"n{i}") for i in range(_LANES)], F.lit(0.0).alias("total"),
                     F.lit(0).alias("at"), F.lit(False).alias("found"),
                     *[F.lit(0).alias(c[0]) for c in CLASSES])
    return F.aggregate(steps, begin, step, lambda acc: acc["found"])


def _secret_rests(rests: Column) -> Column:
    """The rests of candidates in which a window is found; classes are fitted once a rest."""
    def fitted(rest: Column) -> Column:
        fits = [reduce(lambda a, b: a & b, [rest["text"].rlike(p) for p in needed]).alias(f"fit{i}")
                for i, (*_, needed) in enumerate(CLASSES)]
        return F.struct(rest.alias("rest"), *fits)

    def secret(one: Column) -> Column:
        pieces = F.regexp_extract_all(one["rest"]["text"],
                                      F.lit(f"(?=(.{{1,{PIECE + WINDOW - 1}}})).{{1,{PIECE}}}"), F.lit(1))
        fits = [one[f"fit{i}"] for i in range(len(CLASSES))]
        return F.exists(pieces, lambda piece: _piece_found(piece, fits))

    able = F.filter(F.transform(rests, fitted), lambda one: reduce(
        lambda a, b: a | b, [one[f"fit{i}"] for i in range(len(CLASSES))])
        & ~_identifier(one["rest"]["text"]))
    return F.transform(F.filter(able, secret), lambda one: one["rest"]["span"])


def _rests(token: Column, base: Column) -> Column:
    """What sorted base spans leave of a candidate, in parts long enough for a window, with their text."""
    span = token["span"]

    def part(begin: Column, end: Column) -> Column:
        left = F.struct(begin.alias("start"), span["rank"].alias("rank"), end.alias("end"),
                        span["kind"].alias("kind"))
        text = F.substring(token["text"], begin - span["start"] + 1, end - begin)
        return F.when(end - begin >= WINDOW, F.array(F.struct(left.alias("span"), text.alias("text")))) \
            .otherwise(F.array().cast(_REST))

    def step(acc: Column, b: Column) -> Column:
        more = F.concat(acc["out"], part(acc["at"], b["start"]))
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), more.alias("out"))

    met = F.filter(base, lambda b: (b["start"] < span["end"]) & (span["start"] < b["end"]))
    begin = F.struct(span["start"].alias("at"), F.array().cast(_REST).alias("out"))
    return F.aggregate(met, begin, step,
                       lambda acc: F.concat(acc["out"], part(acc["at"], span["end"])))


def find_secrets(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",),
                 text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row, and its sorted spans in ``_out``.

    A span has start and end in code points, end exclusive, and a kind; ``_out.base``
    holds those of the patterns, ``_out.spans`` all.  NULL and empty texts have none.
    Repeated rows are all returned, and other columns may have any name.
    """
    kept = F.struct(*[F.col(f"`{c}`") for c in keep])
    t = F.col("t")

    def where(condition: Column, spans: Column) -> Column:
        return F.when(condition, spans).otherwise(_none())

    rows = (docs.select(kept.alias("kept"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
            .withColumn("long", t.rlike(CANDIDATE)).withColumn("assigned", t.rlike(ASSIGN_HINT)))
    rows = (rows
            .withColumn("base", F.array_sort(F.concat(
                where(F.col("assigned"), _spans(t, ASSIGN, "assign", 6)),
                where(F.col("long") & t.contains("AKIA"), _spans(t, ACCESS, "access")),
                where(F.col("long"), _spans(t, HEX, "hex")))))
            .withColumn("tokens", F.when(F.col("long"), F.arrays_zip(
                _spans(t, CANDIDATE, "entropy").alias("span"),
                F.regexp_extract_all(t, F.lit(CANDIDATE), F.lit(0)).alias("text")))
                .otherwise(F.array().cast(_REST))))
    rests = F.flatten(F.transform("tokens", lambda token: _rests(token, F.col("base"))))
    spans = F.array_sort(F.concat("base", _secret_rests(rests)))
    return rows.select("kept.*", F.struct(F.col("base"), spans.alias("spans")).alias("_out"))


def listed(spans: Column) -> Column:
    """``kind:start:end`` of sorted spans, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def count_kind(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint")


def redact(docs: DataFrame, mark: str = "[SECRET]", text: str = "text") -> DataFrame:
    """The documents with every secret replaced; overlapping spans are replaced as one."""
    found = find_secrets(whole_rows(docs, text), ("row", "text"))
    t, spans = F.col("text"), F.col("_out.spans")

    def step(acc: Column, span: Column) -> Column:
        gap = F.substring(t, acc["at"] + 1, F.greatest(span["start"] - acc["at"], F.lit(0)))
        out = F.when(span["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark)))
        return F.struct(F.greatest(acc["at"], span["end"]).alias("at"),
                        F.coalesce(out, acc["out"]).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    clean = F.aggregate(spans, begin, step, lambda acc: F.concat(
        acc["out"], F.substring(t, acc["at"] + 1, _length(t))))
    return with_text(found, docs.columns, text, F.when(F.size(spans) > 0, clean).otherwise(t))
