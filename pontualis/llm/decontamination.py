"""Benchmark decontamination: a broadcast hash set of normalised test n-grams.

Every window of ``WINDOW`` consecutive words of a test item is hashed; an item
with fewer words is one window.  The windows of a training text are looked up
in that set, first in a bitmap and then exactly, and every hit is verified word
by word.  The set is broadcast in blocks of at most ``BLOCK_WINDOWS`` windows,
so its size is bounded for any benchmark; each block is one pass over the texts, of which the
hits are written before the block is released and the next one is loaded.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.batches import map_texts, whole_rows, with_text
from pontualis.llm.tables import Workspace
from pontualis.llm.words import (ALPHANUMERIC, LEADING, LOWER, Texts, Words, texts_of,
                                 window_hashes, words_of)

WINDOW = 10
# Windows broadcast at once, about 100 bytes each.
BLOCK_WINDOWS = 400_000
_BITMAP_BITS = 22

HIT = "array<struct<word: int, start: int, end: int>>"
FIELDS = f"n_words bigint, hits {HIT}, items array<string>"


@dataclass(frozen=True)
class Block:
    """Some windows of the benchmark: length in words, words, and the ids of their items."""

    sizes: tuple[int, ...]
    windows: dict[int, dict[bytes, tuple[str, ...]]]

    @cached_property
    def known(self) -> np.ndarray:
        return np.array(sorted(self.windows), np.uint64)

    @cached_property
    def bitmap(self) -> np.ndarray:
        table = np.zeros(1 << _BITMAP_BITS, bool)
        table[self.known >> np.uint64(64 - _BITMAP_BITS)] = True
        return table


def _normal(texts: Texts) -> tuple[np.ndarray, Words]:
    return LOWER[texts.data], words_of(texts, ALPHANUMERIC, LOWER)


def _joined(data: np.ndarray, words: Words, first: int, size: int) -> bytes:
    return b" ".join(data[words.start[i]:words.end[i]].tobytes()
                     for i in range(first, first + size))


def _item_windows(column: pa.Array) -> dict[str, pa.Array]:
    """All windows of each item of a slice."""
    texts = texts_of(column)
    data, words = _normal(texts)
    counts = words.counts
    rows: list[list[dict]] = [[] for _ in range(len(texts))]
    for size in sorted({int(min(n, WINDOW)) for n in counts if n}):
        hashes, at = window_hashes(words, size)
        text = words.text_of_word[at]
        for h, i, t in zip(hashes.tolist(), at.tolist(), text.tolist()):
            if size == min(counts[t], WINDOW):
                rows[t].append({"hash": h - (h >> 63 << 64), "size": size,
                                "words": _joined(data, words, i, size)})
    kind = pa.struct([("hash", pa.int64()), ("size", pa.int32()), ("words", pa.binary())])
    return {"windows": pa.array(rows, pa.list_(kind))}


def benchmark_windows(benchmark: DataFrame, item_id: str = "item_id",
                      text: str = "text") -> DataFrame:
    """Distinct (hash, size, words, item) of all items; a NULL id is an empty text."""
    mapped = map_texts(benchmark, text, (item_id,),
                       "windows array<struct<hash: bigint, size: int, words: binary>>",
                       _item_windows)
    return (mapped.select(F.coalesce(F.col(f"`{item_id}`").cast("string"), F.lit("")).alias("item"),
                          F.explode("_out.windows").alias("w"))
            .select("w.*", "item").distinct())


def blocks_of(windows: DataFrame) -> list[DataFrame]:
    """The rows of windows and items cut into blocks of about ``BLOCK_WINDOWS``.

    A window that many items share is cut by its items, so it fills no block alone.  Each of its
    blocks finds it again and knows a part of its items.
    """
    n = -(-windows.count() // BLOCK_WINDOWS) or 1
    return [windows.where(F.pmod(F.xxhash64("hash", "item"), F.lit(n)) == i) for i in range(n)]


def load_block(windows: DataFrame) -> Block:
    found: dict[int, dict[bytes, list[str]]] = {}
    sizes = set()
    for row in windows.toLocalIterator():
        sizes.add(row["size"])
        found.setdefault(row["hash"] % (1 << 64), {}).setdefault(
            bytes(row["words"]), []).append(row["item"])
    return Block(tuple(sorted(sizes)),
                 {h: {w: tuple(i) for w, i in by.items()} for h, by in found.items()})


def scan(column: pa.Array, block: Block) -> dict[str, pa.Array]:
    """Hit words and items of a slice of texts."""
    texts = texts_of(column)
    data, words = _normal(texts)
    hit = np.zeros(len(words.hash), bool)
    items: list[set[str] | tuple] = [()] * len(texts)
    for size in block.sizes if len(block.known) else ():
        hashes, at = window_hashes(words, size)
        maybe = np.flatnonzero(block.bitmap[hashes >> np.uint64(64 - _BITMAP_BITS)])
        place = np.minimum(np.searchsorted(block.known, hashes[maybe]), len(block.known) - 1)
        maybe = maybe[block.known[place] == hashes[maybe]]
        for h, i in zip(hashes[maybe].tolist(), at[maybe].tolist()):
            found = block.windows[h].get(_joined(data, words, i, size))
            if found:
                hit[i:i + size] = True
                text = int(np.searchsorted(words.first, i, "right")) - 1
                items[text] = {*items[text], *found}
    hits: list[list[dict]] = [[]] * len(texts)
    for t in {int(np.searchsorted(words.first, i, "right")) - 1 for i in np.flatnonzero(hit)}:
        begin, end = texts.bounds[t], texts.bounds[t + 1]
        points = np.concatenate(([0], np.cumsum(LEADING[texts.data[begin:end]])))
        own = np.flatnonzero(hit[words.first[t]:words.first[t + 1]])
        spans = zip(own.tolist(), points[words.start[own + words.first[t]] - begin].tolist(),
                    points[words.end[own + words.first[t]] - begin].tolist())
        hits[t] = [{"word": w, "start": a, "end": b} for w, a, b in spans]
    kind = pa.struct([("word", pa.int32()), ("start", pa.int32()), ("end", pa.int32())])
    return {"n_words": pa.array(words.counts.astype(np.int64)),
            "hits": pa.array(hits, pa.list_(kind)),
            "items": pa.array([sorted(i) for i in items], pa.list_(pa.string()))}


def _pass(docs: DataFrame, block: Broadcast, keep: tuple[str, ...], text: str) -> DataFrame:
    return map_texts(docs, text, keep, FIELDS, lambda column: scan(column, block.value))


def find_contamination(docs: DataFrame, benchmark: DataFrame, keep: tuple[str, ...] = ("doc_id",),
                       text: str = "text", item_id: str = "item_id",
                       item_text: str = "text") -> DataFrame:
    """Columns ``keep`` of every row, and its words, hit words and items in ``_out``.

    One row per row of ``docs``, repeated rows included.  NULL and empty texts have
    no words and no hits, and so have all texts if the benchmark is empty.  Items
    with the same id count as one.  Hits carry word number and code point offsets.
    """
    spark = docs.sparkSession
    workspace = Workspace(spark, "decontamination")
    windows = workspace.save(benchmark_windows(benchmark, item_id, item_text), "windows")
    blocks, context = blocks_of(windows), spark.sparkContext
    if len(blocks) == 1:
        return _pass(docs, context.broadcast(load_block(blocks[0])), keep, text)
    rows = workspace.save(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in keep]).alias("kept"),
        F.col(f"`{text}`").alias("text"), F.monotonically_increasing_id().alias("row")), "rows")
    passes = []
    for i, windows_of_block in enumerate(blocks):
        block = context.broadcast(load_block(windows_of_block))
        passes.append(workspace.save(_pass(rows, block, ("row",), "text"), f"pass{i}"))
        block.destroy()
    found = (reduce(DataFrame.unionAll, passes).groupBy("row").agg(
        F.max("_out.n_words").alias("n_words"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_out.hits")))).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("_out.items")))).alias("items")))
    return (rows.select("row", "kept").join(found, "row")
            .select("kept.*", F.struct("n_words", "hits", "items").alias("_out")))


def items_digest(items: Column) -> Column:
    """SHA-256 of the item ids, sorted as strings and joined by commas."""
    return F.sha2(F.concat_ws(",", F.array_sort(items)), 256)


def _without(text: str | None, hits: list[dict]) -> str | None:
    """The text without its hit words and what stands between neighbouring ones."""
    if not hits:
        return text
    out, at, last = [], 0, None
    for hit in hits:
        if hit["word"] - 1 != last:
            out.append(text[at:hit["start"]])
        at, last = hit["end"], hit["word"]
    return "".join([*out, text[at:]])


def remove_spans(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents with every run of hit words cut out of their texts."""
    found = find_contamination(whole_rows(docs, text), benchmark, ("row", "text"))
    cut = F.udf(_without, "string", useArrow=True)
    value = F.when(F.size("_out.hits") > 0, cut("text", "_out.hits")).otherwise(F.col("text"))
    return with_text(found, docs.columns, text, value)


def remove_documents(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The documents without a hit."""
    found = find_contamination(whole_rows(docs, text), benchmark, ("row",))
    return found.where(F.size("_out.hits") == 0).select("row.*")
