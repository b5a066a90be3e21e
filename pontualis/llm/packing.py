"""Conflict-constrained best-fit packing of documents into bins of fixed capacity.

Items are placed in decreasing length.  Open bins are ordered by residual
capacity and carry a bitmap of their sources and one of their duplicate
clusters; the search starts at the smallest residual that can hold the item and
goes on to the next successor until a bin shares neither the source nor the cluster
of the item.  Without one, a new bin is opened.

Documents are dealt by hash into packing groups of about ``GROUP`` items, each
packed on its own.  Rows that repeat an id, piece and cluster are numbered inside the partition
they are read in, and the number is part of the hash, so not even copies of one row meet in a group.
A group is bounded, whatever share of the rows one source, cluster
or id holds; one that chance makes larger than ``2 * GROUP`` is packed in parts.  A search
looks at the open bins by residual and pair of bitmaps, at worst at all the bins of its group.
A document longer than a bin is cut into pieces; each is an item.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from pontualis.llm.batches import fit_batches, grouped, map_texts
from pontualis.llm.tables import Workspace
from pontualis.llm.words import LOWER, NOT_SPACE, mix, texts_of, words_of

CAPACITY = 2048
GROUP = 8192

PLACED = ("doc_id bigint, piece int, first_word bigint, n_words bigint, bin_id bigint, "
          "bin_offset bigint")


@dataclass
class Bins:
    """Open bins by residual capacity, then by their two bitmaps."""

    capacity: int
    count: int = 0
    ordered: int = 0  # bit r is set while a bin has residual r
    open: dict[int, dict[tuple[int, int], list[int]]] = field(default_factory=dict)

    def _put(self, residual: int, marks: tuple[int, int], number: int) -> None:
        self.open.setdefault(residual, {}).setdefault(marks, []).append(number)
        self.ordered |= 1 << residual

    def _find(self, length: int, source: int, cluster: int) -> tuple[int, tuple[int, int]] | None:
        """The compatible bin with the smallest sufficient residual."""
        rest = self.ordered >> length
        residual = length
        while rest:
            step = (rest & -rest).bit_length() - 1
            residual += step
            for marks in self.open[residual]:
                if not (marks[0] & source or marks[1] & cluster):
                    return residual, marks
            rest >>= step + 1
            residual += 1
        return None

    def place(self, length: int, source: int, cluster: int) -> tuple[int, int]:
        """Number of the bin an item goes to, and the capacity used in it before."""
        found = self._find(length, source, cluster)
        if found is None:
            number, residual, marks = self.count, self.capacity, (0, 0)
            self.count += 1
        else:
            residual, marks = found
            same = self.open[residual]
            number = same[marks].pop()
            if not same[marks]:
                del same[marks]
                if not same:
                    del self.open[residual]
                    self.ordered &= ~(1 << residual)
        self._put(residual - length, (marks[0] | source, marks[1] | cluster), number)
        return number, self.capacity - residual


def _bits(values: list, counted: bool) -> list[int]:
    """One bit per distinct value, 0 for NULL and, if ``counted``, for values that occur once."""
    seen: dict = {}
    for v in values:
        seen[v] = seen.get(v, 0) + 1
    seen.pop(None, None)
    used = [v for v, n in seen.items() if n > 1 or not counted]
    bit = {v: 1 << i for i, v in enumerate(used)}
    return [bit.get(v, 0) for v in values]


def pack_items(lengths: list[int], sources: list, clusters: list, capacity: int
               ) -> list[tuple[int, int]]:
    """Bin and offset of each item; the items come in decreasing length."""
    bins = Bins(capacity)
    marks = zip(lengths, _bits(sources, False), _bits(clusters, True))
    return [bins.place(length, source, cluster) for length, source, cluster in marks]


def _numbered(batches):
    """Rows with the number of equal (id, piece, cluster) before them in the partition."""
    seen: dict[tuple, int] = {}
    for batch in batches:
        numbers = []
        for key in zip(*[batch.column(c).to_pylist() for c in ("doc_id", "piece", "cluster")]):
            numbers.append(seen.get(key, 0))
            seen[key] = numbers[-1] + 1
        yield batch.append_column("copy", pa.array(numbers, pa.int64()))


def pack(items: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Pack ``items`` (doc_id, source, cluster, n_words) into bins.

    Every row is returned once per piece with its bin, also repeated ones, which
    take bins of their own.  Items without words and NULL clusters or sources conflict with
    nothing.  Equal lengths are placed in the order of ids, NULL first.
    """
    spark = items.sparkSession
    fit_batches(items)
    pieces = F.greatest(F.ceil(F.col("n_words") / capacity), F.lit(1)).cast("int")
    cut = (items.withColumn("piece", F.explode(F.sequence(F.lit(0), pieces - 1)))
           .withColumn("first_word", F.col("piece").cast("bigint") * capacity)
           .withColumn("n_words", F.least(F.lit(capacity), F.col("n_words") - F.col("first_word"))))
    cut = cut.select("doc_id", "piece", "first_word", F.col("n_words").cast("bigint").alias("n_words"),
                     "source", "cluster")
    cut = Workspace(spark, "packing").save(
        cut.mapInArrow(_numbered, StructType([*cut.schema]).add("copy", LongType())), "pieces")
    groups = max(1, -(-cut.count() // GROUP))
    dealt = cut.withColumn("dealt", F.pmod(
        F.xxhash64("doc_id", "piece", "cluster", "copy"), F.lit(groups)).cast("bigint"))

    def run(batches):
        last, chunk = None, 0
        for table in grouped(batches, ["dealt"], 2 * GROUP):
            number = table["dealt"][0].as_py()
            chunk = chunk + 1 if number == last else 0
            last = number
            lengths = table["n_words"].to_pylist()
            clusters = [c if n else None for c, n in zip(table["cluster"].to_pylist(), lengths)]
            places = pack_items(lengths, table["source"].to_pylist(), clusters, capacity)
            bins = np.array([p[0] for p in places], np.int64)
            base = (number << 36) + (chunk << 20)
            out = table.select(["doc_id", "piece", "first_word", "n_words"])
            out = (out.append_column("bin_id", pa.array(bins + base))
                   .append_column("bin_offset", pa.array([p[1] for p in places], pa.int64())))
            yield from out.to_batches()

    order = [F.col("dealt"), F.desc("n_words"), F.asc_nulls_first("doc_id"), "piece",
             "cluster", "source"]
    return dealt.repartition("dealt").sortWithinPartitions(*order).mapInArrow(run, PLACED)


def _measure(column: pa.Array) -> dict[str, pa.Array]:
    """Word count, and a digest of the lower-cased words in their order."""
    words = words_of(texts_of(column), NOT_SPACE, LOWER)
    place = np.arange(len(words.hash)) - np.repeat(words.first[:-1], words.counts)
    value = mix(words.hash + place.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)))
    digest = total[words.first[1:]] - total[words.first[:-1]]
    return {"n_words": pa.array(words.counts.astype(np.int64)),
            "cluster": pa.array(digest.view(np.int64))}


def items_of(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
             cluster: str | None = None) -> DataFrame:
    """Items of documents; texts with equal words are one cluster unless a column names it."""
    keep = (doc_id, source, *([cluster] if cluster else []))
    found = map_texts(docs, text, keep, "n_words bigint, cluster bigint", _measure)
    return found.select(
        F.col(f"`{doc_id}`").cast("bigint").alias("doc_id"), F.col(f"`{source}`").alias("source"),
        (F.col(f"`{cluster}`") if cluster else F.col("_out.cluster")).alias("cluster"),
        "_out.n_words")
