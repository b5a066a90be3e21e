"""Substring dedup by hashing lines, paragraphs, runs of sentences and word windows.

A text is cut into sentences, which end at ``.``, ``!``, ``?`` or a line break.  Units
are every line and every paragraph, whatever their length; runs of whole sentences with
at least ``MIN_WORDS`` words, of which one begins at every sentence and ends with the
first sentence that makes it long enough, and one ends at every line end; and windows
of ``MIN_WORDS`` words, of which one ends at every sentence end and others are chosen by
their content inside long sentences.  A passage of ``PASSAGE`` words holds a unit wherever
it stands: a sentence end after its first ``MIN_WORDS`` words, or else ``REACH`` windows in
a row without one.  Passages need not stand alone on a line to be found.
Units are normalised to their lower-cased words and compared by 128-bit digests of whole
units.  The occurrence with the smallest id, then the smallest offset, is kept; all
others are removed, with offsets into the original text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pontualis.llm.batches import map_texts, whole_rows
from pontualis.llm.tables import HOT_SHARE, Workspace
from pontualis.llm.words import (LEADING, LOWER, NOT_SPACE, Words, byte_class, mix, stream,
                                 texts_of, words_of)

MIN_WORDS = 20
# Every passage of so many words holds a unit.
PASSAGE = 50
# Of so many windows in a row inside one sentence the one with the smallest digest is a unit.
REACH = PASSAGE - 2 * MIN_WORDS + 2

_STOP = byte_class(*[(ord(c), ord(c)) for c in ".!?"])
_BASES = tuple(int(x) | 1 for x in stream(7, 2))

_UNIT = "array<struct<d1: bigint, d2: bigint, start: int, end: int, again: boolean>>"
_SPANS = "array<struct<start: int, end: int>>"


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n + 1, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _extreme(pick: np.ufunc, values: np.ndarray, n: int) -> np.ndarray:
    """Smallest or largest of every ``n`` values in a row."""
    size = 1
    while 2 * size <= n:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[:len(values) - (n - size)], values[n - size:]) if n > size else values


def _chosen(hashes: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """Ranges of words of the windows chosen inside long sentences; a window may end with one."""
    if len(hashes) < REACH:
        return np.zeros((2, 0), np.int64)
    stops = np.concatenate(([0], np.cumsum(stop)))
    whole = stops[MIN_WORDS - 1:-1] == stops[:-MIN_WORDS]
    number = np.concatenate(([0], np.cumsum(whole)))
    least = np.where(number[REACH:] - number[:-REACH] == REACH, _extreme(np.minimum, hashes, REACH), 0)
    edge = np.zeros(REACH - 1, np.uint64)
    most = _extreme(np.maximum, np.concatenate((edge, least, edge)), REACH)
    at = np.flatnonzero(whole & (hashes == most))
    return np.stack((at, at + MIN_WORDS))


def _blocks(ends: np.ndarray) -> np.ndarray:
    """Ranges of words between one end and the next."""
    return np.stack((np.concatenate(([0], ends[:-1])), ends))


def _runs(words: Words, stop: np.ndarray, breaks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Word ranges of the units of all texts, sorted; every text ends with a stop and a break."""
    text = words.text_of_word
    ends, lines, paragraphs = (np.flatnonzero(m) + 1 for m in (stop, breaks > 0, breaks > 1))
    begins = np.concatenate(([0], ends[:-1]))
    place = np.minimum(np.searchsorted(ends, begins + MIN_WORDS), len(ends) - 1)
    ok = (ends[place] >= begins + MIN_WORDS) & (text[begins] == text[ends[place] - 1])
    forward = np.stack((begins[ok], ends[place[ok]]))
    late, long = (e[e - words.first[text[e - 1]] >= MIN_WORDS] for e in (ends, lines))
    back = np.stack((begins[np.searchsorted(begins, long - MIN_WORDS, "right") - 1], long))
    parts = (_blocks(lines), _blocks(paragraphs), forward, back,
             np.stack((late - MIN_WORDS, late)), _chosen(hashes, stop))
    begin, end = np.concatenate(parts, axis=1)
    once = np.unique(begin << 32 | end)
    return np.stack((once >> 32, once & 0xFFFFFFFF))


def _units(column: pa.Array) -> dict[str, pa.Array]:
    """Units of each text of a slice.

    ``again`` marks those that repeat one of the same text and do not overlap its first occurrence.
    """
    texts = texts_of(column)
    words = words_of(texts, NOT_SPACE, LOWER)
    total = len(words.hash)
    newline = np.concatenate(([0], np.cumsum(texts.data == ord("\n"))))
    following = np.append(words.start[1:], len(texts.data))
    breaks = newline[following] - newline[words.end] if total else np.zeros(0, np.int64)
    last = words.first[1:][words.counts > 0] - 1
    breaks[last] = 2
    line_end = breaks > 0
    stop = line_end | _STOP[texts.data[words.end - 1]] if total else line_end
    sums, inverse = [], []
    for base in _BASES:
        power = _powers(base, total)
        sums.append(np.concatenate((np.zeros(1, np.uint64), np.cumsum(
            words.hash * power[:total], dtype=np.uint64))))
        inverse.append(_powers(pow(base, -1, 1 << 64), total))
    points = np.concatenate(([0], np.cumsum(LEADING[texts.data])))
    if not total:
        begin = end = np.zeros(0, np.int64)
    else:
        windows = mix((sums[0][MIN_WORDS:] - sums[0][:-MIN_WORDS])
                      * inverse[0][:max(total - MIN_WORDS + 1, 0)])
        begin, end = _runs(words, stop, breaks, windows)
    d = [mix((s[end] - s[begin]) * i[begin] + (end - begin).astype(np.uint64))
         for s, i in zip(sums, inverse)]
    text = words.text_of_word[begin]
    order = np.lexsort((begin, d[1], d[0], text))
    same = np.zeros(len(order), bool)
    same[1:] = np.logical_and.reduce([x[order][1:] == x[order][:-1] for x in (text, *d)])
    first = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    again = np.zeros(len(order), bool)
    again[order] = same & (begin[order] >= end[order[first]])
    base = points[texts.bounds[text]]
    kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.bool_())
    values = (d[0].view(np.int64), d[1].view(np.int64), points[words.start[begin]] - base,
              points[words.end[end - 1]] - base, again)
    arrays = [pa.array(value, kind) for value, kind in zip(values, kinds)]
    sizes = np.bincount(text, minlength=len(texts))
    offsets = pa.array(np.concatenate(([0], np.cumsum(sizes))), pa.int32())
    names = ["d1", "d2", "start", "end", "again"]
    return {"units": pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(arrays, names))}


def find_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Spans to remove: ``doc_id``, ``start``, ``end``, ``first_doc_id`` and ``n_units``.

    Offsets are code points, end exclusive; overlapping units of a document with the
    same first document are one span.  Rows with the same id are one document; rows
    without an id, and texts without words, neither keep nor lose anything.  Other columns may have any name.
    """
    workspace = Workspace(docs.sparkSession, "substring-dedup")
    source = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"),
                         F.col(f"`{text}`").alias("text")).where("id IS NOT NULL")
    units = (map_texts(source, "text", ("id",), f"units {_UNIT}", _units)
             .select("id", F.explode("_out.units").alias("u")).select("id", "u.*"))
    firsts = workspace.save(units.groupBy("d1", "d2").agg(
        F.min("id").alias("first"), F.count(F.lit(1)).alias("members")).where("members > 1"),
        "firsts")
    rows = firsts.agg(F.sum("members")).first()[0] or 0
    limit = max(1000, int(rows * HOT_SHARE))
    hot = F.broadcast(firsts.where(F.col("members") > limit).select("d1", "d2", F.col("first").alias("known")))
    # Units are made anew for this join and not written; those of hot digests, at most
    # 1 / HOT_SHARE, have their answer before it and are dealt by their place.
    spread = units.join(hot, ["d1", "d2"], "left").withColumn("d1", F.when(
        F.col("known").isNull(), F.col("d1")).otherwise(F.xxhash64("id", "start", "end")))
    cold = firsts.where(F.col("members") <= limit).select("d1", "d2", "first")
    hits = (spread.join(cold, ["d1", "d2"], "left")
            .withColumn("first", F.coalesce("known", "first"))
            .where("first IS NOT NULL AND (id <> first OR again)")
            .select("id", "start", "end", "first").distinct())
    before = Window.partitionBy("id", "first").orderBy("start", "end")
    reach = F.max("end").over(before.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.when(F.col("start") <= reach, 0).otherwise(1)
    spans = (hits.withColumn("opens", opens).withColumn("island", F.sum("opens").over(
        before.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("id", "first", "island").agg(
            F.min("start").alias("start"), F.max("end").alias("end"), F.count(F.lit(1)).alias("n_units")))
    return spans.select(F.col("id").alias(doc_id), "start", "end",
                        F.col("first").alias("first_doc_id"), "n_units")


def _kept(size, spans):
    """Ranges of a text of ``size`` code points outside the removed spans."""
    def step(acc, s):
        gap = F.when(s["start"] > acc["at"], F.array(F.struct(
            acc["at"].alias("start"), s["start"].alias("end")))).otherwise(F.array().cast(_SPANS))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.concat(acc["out"], gap).alias("out"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(_SPANS).alias("out"))
    closing = F.array(F.struct(size.alias("start"), size.alias("end")))
    return F.aggregate(F.concat(spans, closing), begin, step, lambda acc: acc["out"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents without repeated units, and ``kept_spans`` into the original texts."""
    spans = find_repeats(docs, doc_id, text).toDF("id", "start", "end", "first", "n").groupBy("id").agg(
        F.array_sort(F.collect_set(F.struct("start", "end"))).alias("spans"))
    rows = whole_rows(docs, text).withColumn("id", F.col("row").getField(doc_id).cast("bigint"))
    t = F.coalesce(F.col("text").cast("string"), F.lit(""))
    cut = rows.join(spans, "id", "left").withColumn(
        "kept", _kept(F.length(t), F.coalesce("spans", F.array().cast(_SPANS))))
    pieces = F.transform("kept", lambda s: F.substring(t, s["start"] + 1, s["end"] - s["start"]))
    value = F.when(F.col("spans").isNull(), F.col("text")).otherwise(F.array_join(pieces, ""))
    return cut.select(*[(value if c == text else F.col("row").getField(c)).alias(c)
                        for c in docs.columns if c != "kept_spans"], F.col("kept").alias("kept_spans"))
