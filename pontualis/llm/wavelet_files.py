"""Token ids on disk as wavelet matrices: one succinct, self-contained file row per shard.

A shard holds the ids of a run of documents.  Its wavelet matrix has one plane
per id bit, highest first: plane ``p`` holds bit ``p`` of every id, in the order
that a stable partition by the bits above has left.  A rank directory counts the
ones before every block of ``RANK_BITS`` bits.  From one row, without unpacking the
ids, ``Shard`` answers access, rank (count of an id before a position) and
select (position of its k-th occurrence).

Shards are rows of Parquet files that Spark writes and commits, so a lost
executor or a repeated task leaves no partial file, and any store that Spark
reaches can hold them.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pontualis.llm.batches import fit_batches
from pontualis.llm.tables import Workspace
from pontualis.llm.words import (Texts, byte_class, mix, per_text, slices, stream, texts_of,
                                 words_of)
from pontualis.operators.numbering import running_total_before

END_ID = 2
# A shard ends with the document that brings it to this many ids.
SHARD_IDS = 1 << 18
RANK_BITS = 512
# Words whose ids a worker remembers at most, with those of one slice: with 16 bytes for the place and
# two or four for each id some 30 bytes a word, twice while words are added.
REMEMBERED = 1_500_000
# Pieces that are encoded as one text.
LINES = 2048
# Shards in one file, which bounds what a vectorised reader holds at once.
FILE_SHARDS = 64

SHARD = ("part int, seq int, n_ids bigint, n_bits int, doc_ids array<bigint>, "
         "doc_sizes array<bigint>, planes array<binary>, zeros array<bigint>, ranks array<binary>")

# Where a lone space or newline stands between two other characters.
_BORDER = re.compile(r"(?<=\S)(?=[ \n]\S)")
_STOPS = ".,;:!?"
_KINDS = stream(9, 3)
_SEPARATOR = byte_class((0x20, 0x20), (0x0A, 0x0A))
# Bytes of other white space below 0x80, and first bytes of such characters beyond.
_CONTROL = byte_class((0x09, 0x09), (0x0B, 0x0D), (0x1C, 0x1F))
_LEADING = byte_class((0xC2, 0xC2), (0xE1, 0xE3))
_WIDE = np.array([int.from_bytes(chr(c).encode().ljust(3, b"\0")) for c in range(0x80, 0x3001) if chr(c).isspace()])
# Byte-level vocabularies spell bytes that do not print as the characters from 256 on.
_PRINTED = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTE_CHARACTERS = {b: chr(256 + i) for i, b in enumerate(
    b for b in range(256) if b not in _PRINTED)}
_SPACE = _BYTE_CHARACTERS[0x20]
# A word is the first of its text, or has a space or a newline before it.
HEAD, TAIL, LINE = range(3)


def plain_texts(texts: Texts) -> np.ndarray:
    """True for texts in which white space is lone spaces and newlines between other characters."""
    data, bounds = texts.data, texts.bounds
    separator = _SEPARATOR[data]
    bad = _CONTROL[data]
    bad[1:] |= separator[1:] & separator[:-1]
    some = np.flatnonzero(np.diff(bounds))
    for edge in (bounds[some], bounds[some + 1] - 1):
        bad[edge] |= separator[edge]
    at = np.flatnonzero(_LEADING[data])
    behind = np.concatenate((data, np.zeros(2, np.uint8))).astype(np.int64)
    third = np.where(data[at] == 0xC2, 0, behind[at + 2])
    bad[at] |= np.isin(behind[at] << 16 | behind[at + 1] << 8 | third, _WIDE)
    return (per_text(bad, bounds) == 0) & (np.diff(bounds) > 0)


class Encoder:
    """Ids of texts with a byte-level tokenizer, one word at a time.

    The pre-tokens of the tokenizer end before a lone space or newline between two
    characters that are no white space, and a lone newline is a pre-token itself.  A plain
    text is therefore the sequence of its words, with the space before each.  Words are found
    and hashed for a whole slice at once; the distinct ones are looked up in a
    sorted table of hashes, and the ids of all are gathered from one flat array.  Words are told
    apart by 64 bits: among a million a collision has a probability of about 3e-8.
    Other texts are cut at the plain borders and their pieces encoded each time.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        newline = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.newline = newline[0] if len(newline) == 1 else None
        self.size = np.dtype(np.uint32 if self.tokenizer.get_vocab_size() > 65536 else np.uint16)
        self._forget()

    def _forget(self) -> None:
        self.keys, self.entry = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat, self.bounds = np.zeros(0, self.size), np.zeros(1, np.int64)

    def _words(self, words: list[str], before: str) -> list[bytes]:
        """Ids of letters with or without a space before, which are one pre-token each."""
        tokenize, code = self.model.tokenize, "H" if self.size.itemsize == 2 else "I"
        start = _SPACE if before else ""
        spelled = [start + w if w.isascii() else
                   start + w.encode().decode("latin-1").translate(_BYTE_CHARACTERS) for w in words]
        return [array(code, [t.id for t in tokenize(w)]).tobytes() for w in spelled]

    def _each(self, pieces: list[str]) -> list[bytes]:
        coded = self.tokenizer.encode_batch_fast(pieces, add_special_tokens=False)
        return [np.array(c.ids, self.size).tobytes() for c in coded]

    def _lines(self, pieces: list[str]) -> list[bytes]:
        """Ids of pieces without white space inside or behind, encoded as the lines of long texts.

        A newline between them is one pre-token; where its id does not part the lines as
        expected, the pieces are encoded one by one.
        """
        if self.newline is None:
            return self._each(pieces)
        chunks = [pieces[i:i + LINES] for i in range(0, len(pieces), LINES)]
        coded = self.tokenizer.encode_batch_fast(["\n".join(c) for c in chunks], add_special_tokens=False)
        out: list[bytes] = []
        for chunk, encoded in zip(chunks, coded):
            ids = np.array(encoded.ids, self.size)
            cuts = np.flatnonzero(ids == self.newline)
            if len(cuts) != len(chunk) - 1:
                out += self._each(chunk)
                continue
            raw, width = ids.tobytes(), self.size.itemsize
            begins = [0, *((cuts + 1) * width).tolist()]
            out += [raw[a:b] for a, b in zip(begins, [*(cuts * width).tolist(), len(raw)])]
        return out

    def _encoded(self, words: list[str], before: str) -> list[bytes]:
        """Ids of words; letters alone, also before a stop, are pre-tokens of their own."""
        letters = [w.isalpha() for w in words]
        stopped = [not a and w[-1] in _STOPS and w[:-1].isalpha() for w, a in zip(words, letters)]
        single = iter(self._words([w if a else w[:-1] for w, a, s in zip(words, letters, stopped) if a or s],
                                  before))
        other = iter(self._lines([before + w for w, a, s in zip(words, letters, stopped) if not (a or s)]))
        stop = dict(zip(_STOPS, self._each(list(_STOPS))))
        return [next(single) if a else next(single) + stop[w[-1]] if s else next(other)
                for w, a, s in zip(words, letters, stopped)]

    def _learn(self, keys: np.ndarray, kinds: list[int], words: list[str]) -> None:
        """Add words to the table; ``keys`` are sorted and new."""
        coded: list[bytes] = [b""] * len(words)
        feed = np.array([self.newline or 0], self.size).tobytes()
        for kind in (HEAD, TAIL, LINE):
            at = [i for i, k in enumerate(kinds) if k == kind]
            own = [words[i] for i in at]
            if kind == LINE and self.newline is None:
                made = self._each(["\n" + w for w in own])
            else:
                made = self._encoded(own, " " if kind == TAIL else "")
                made = [feed + c for c in made] if kind == LINE else made
            for i, c in zip(at, made):
                coded[i] = c
        sizes = np.array([len(c) for c in coded], np.int64) // self.size.itemsize
        place = np.searchsorted(self.keys, keys)
        first = len(self.bounds) - 1
        self.keys = np.insert(self.keys, place, keys)
        self.entry = np.insert(self.entry, place, np.arange(first, first + len(keys)))
        self.bounds = np.concatenate((self.bounds, self.bounds[-1] + np.cumsum(sizes)))
        self.flat = np.concatenate((self.flat, np.frombuffer(b"".join(coded), self.size)))

    def _plain(self, texts: Texts) -> tuple[np.ndarray, np.ndarray]:
        """Ids of plain texts one after another, and where each text begins."""
        words = words_of(texts, ~_SEPARATOR)
        kind = np.where(texts.data[words.start - 1] == 0x0A, LINE, TAIL)
        kind[words.first[:-1]] = HEAD
        keys = mix(words.hash + _KINDS[kind])
        distinct, first, inverse = np.unique(keys, return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, distinct)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == distinct[known]
        new = first[~known]
        if len(new):
            raw = texts.data.tobytes()
            spelled = [raw[a:b].decode() for a, b in zip(words.start[new].tolist(), words.end[new].tolist())]
            self._learn(distinct[~known], kind[new].tolist(), spelled)
            place = np.searchsorted(self.keys, distinct)
        entry = self.entry[place][inverse]
        sizes = (self.bounds[1:] - self.bounds[:-1])[entry]
        ends = np.concatenate(([0], np.cumsum(sizes)))
        at = np.arange(ends[-1]) + np.repeat(self.bounds[entry] - ends[:-1], sizes)
        out = self.flat[at], ends[words.first]
        if len(self.keys) > REMEMBERED:
            self._forget()
        return out

    def _pieces(self, text: str) -> np.ndarray:
        """Ids of a text with any white space, cut at the plain borders inside."""
        return np.frombuffer(b"".join(self._each(_BORDER.split(text))), self.size)

    def ids(self, texts: list[str] | pa.Array) -> list[np.ndarray]:
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        whole = texts_of(column)
        plain = plain_texts(whole)
        out: list[np.ndarray] = [np.zeros(0, self.size)] * len(whole)
        if plain.any():
            ids, bounds = self._plain(texts_of(column.filter(pa.array(plain))))
            for i, a, b in zip(np.flatnonzero(plain).tolist(), bounds.tolist(), bounds[1:].tolist()):
                out[i] = ids[a:b]
        for i in np.flatnonzero(~plain & (np.diff(whole.bounds) > 0)).tolist():
            out[i] = self._pieces(whole.text(i))
        return out


@lru_cache(maxsize=1)
def encoder_of(path: str) -> Encoder:
    """The encoder of this worker process; its memory lasts from task to task."""
    return Encoder(path)


def _stable(ones: np.ndarray) -> tuple[np.ndarray, int]:
    """Positions of the zeros, then of the ones, and the number of zeros."""
    zeros = np.flatnonzero(~ones)
    return np.concatenate((zeros, np.flatnonzero(ones))), len(zeros)


def build(ids: np.ndarray, n_bits: int) -> tuple[list[bytes], list[int], list[bytes]]:
    """Planes, number of zeros of each, and rank directories."""
    planes, zeros, ranks = [], [], []
    for bit in range(n_bits - 1, -1, -1):
        ones = (ids >> ids.dtype.type(bit)) & ids.dtype.type(1) > 0
        plane = np.packbits(ones, bitorder="little")
        planes.append(plane.tobytes())
        padded = np.zeros(-(-len(ones) // RANK_BITS) * RANK_BITS >> 3, np.uint8)
        padded[:len(plane)] = plane
        blocks = np.bitwise_count(padded.view(np.uint64)).reshape(-1, RANK_BITS >> 6).sum(1)
        ranks.append(np.concatenate(([0], np.cumsum(blocks[:-1]))).astype(np.uint32).tobytes())
        place, count = _stable(ones)
        zeros.append(count)
        ids = ids[place]
    return planes, zeros, ranks


@dataclass
class Shard:
    """Queries on one stored shard."""

    n: int
    planes: list[np.ndarray]
    zeros: list[int]
    ranks: list[np.ndarray]

    @classmethod
    def of(cls, row: dict) -> Shard:
        return cls(row["n_ids"], [np.frombuffer(p, np.uint8) for p in row["planes"]],
                   list(row["zeros"]), [np.frombuffer(r, np.uint32) for r in row["ranks"]])

    def _bit(self, level: int, i: int) -> int:
        return int(self.planes[level][i >> 3] >> (i & 7) & 1)

    def _ones(self, level: int, i: int) -> int:
        """Ones before position ``i`` of a plane."""
        block = min(i // RANK_BITS, len(self.ranks[level]) - 1)
        begin = block * RANK_BITS >> 3
        part = np.unpackbits(self.planes[level][begin:(i + 7) >> 3], bitorder="little")
        return int(self.ranks[level][block]) + int(part[:i - block * RANK_BITS].sum())

    def access(self, i: int) -> int:
        value = 0
        for level in range(len(self.planes)):
            bit, ones = self._bit(level, i), self._ones(level, i)
            i = self.zeros[level] + ones if bit else i - ones
            value = value << 1 | bit
        return value

    def _range(self, token: int, end: int) -> tuple[int, int]:
        """Where the occurrences of a token before ``end`` lie below the last plane."""
        begin = 0
        for level in range(len(self.planes)):
            a, b = self._ones(level, begin), self._ones(level, end)
            if token >> len(self.planes) - 1 - level & 1:
                begin, end = self.zeros[level] + a, self.zeros[level] + b
            else:
                begin, end = begin - a, end - b
        return begin, end

    def rank(self, token: int, end: int) -> int:
        """Occurrences of a token before position ``end``."""
        begin, end = self._range(token, end) if token >> len(self.planes) == 0 and self.n else (0, 0)
        return end - begin

    def select(self, token: int, k: int) -> int:
        """Position of the k-th occurrence (from 0) of a token, -1 if there is none."""
        if not 0 <= k < self.rank(token, self.n):
            return -1
        i = self._range(token, self.n)[0] + k
        for level in range(len(self.planes) - 1, -1, -1):
            bit = token >> len(self.planes) - 1 - level & 1
            want = i - self.zeros[level] if bit else i
            low, high = 0, self.n
            while low < high:
                middle = (low + high) // 2
                ones = self._ones(level, middle + 1)
                if (ones if bit else middle + 1 - ones) > want:
                    high = middle
                else:
                    low = middle + 1
            i = low
        return i

    def ids(self) -> np.ndarray:
        """All ids, undoing the partitions from the last plane up."""
        bits = len(self.planes)
        out = np.zeros(self.n, np.uint16 if bits <= 16 else np.uint32)
        for level in range(bits - 1, -1, -1):
            ones = np.unpackbits(self.planes[level], count=self.n, bitorder="little").view(bool)
            place, count = _stable(ones)
            out[count:] |= out.dtype.type(1 << bits - 1 - level)
            above = np.empty_like(out)
            above[place] = out
            out = above
        return out


def _packed(part: int, seq: int, docs: list, arrays: list[np.ndarray], n_bits: int) -> dict:
    ids = np.concatenate(arrays)
    planes, zeros, ranks = build(ids, n_bits)
    return {"part": part, "seq": seq, "n_ids": len(ids), "n_bits": n_bits, "doc_ids": docs,
            "doc_sizes": [len(a) for a in arrays], "planes": planes, "zeros": zeros,
            "ranks": ranks}


def write_shards(docs: DataFrame, path: str, tokenizer: str, doc_id: str = "doc_id",
                 text: str = "text", end_id: int = END_ID) -> None:
    """Encode every text, append ``end_id`` and write shards in ascending id order.

    NULL and empty texts are just the end id.  Rows without an id come first; rows with
    the same id follow each other in an order that depends on their texts alone.
    """
    fit_batches(docs)
    source = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"),
                         F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("t"))
    arrow = pa.schema([
        ("part", pa.int32()), ("seq", pa.int32()), ("n_ids", pa.int64()), ("n_bits", pa.int32()),
        ("doc_ids", pa.list_(pa.int64())), ("doc_sizes", pa.list_(pa.int64())),
        ("planes", pa.list_(pa.binary())), ("zeros", pa.list_(pa.int64())),
        ("ranks", pa.list_(pa.binary()))])

    def shards(batches):
        encoder = encoder_of(tokenizer)
        n_bits = int(max(encoder.tokenizer.get_vocab_size() - 1, end_id)).bit_length()
        end = np.array([end_id], encoder.size)
        part, seq, held, owners, arrays = TaskContext.get().partitionId(), 0, 0, [], []
        for batch in batches:
            for piece in slices(batch, "t"):
                coded = encoder.ids(piece.column("t"))
                for owner, ids in zip(piece.column("id").to_pylist(), coded):
                    owners.append(owner)
                    arrays.append(np.concatenate((ids, end)))
                    held += len(ids) + 1
                    if held >= SHARD_IDS:
                        row = _packed(part, seq, owners, arrays, n_bits)
                        yield pa.RecordBatch.from_pylist([row], arrow)
                        seq, held, owners, arrays = seq + 1, 0, [], []
        if owners:
            yield pa.RecordBatch.from_pylist([_packed(part, seq, owners, arrays, n_bits)], arrow)

    # Ranges go by id, and by a hash among rows of one id; whole texts would be sampled.
    (source.withColumn("h", F.xxhash64("t")).repartitionByRange("id", "h")
     .sortWithinPartitions("id", "h", "t").select("id", "t").mapInArrow(shards, SHARD)
     .write.option("maxRecordsPerFile", FILE_SHARDS).option("compression", "zstd").parquet(path))


def read_shards(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SHARD).parquet(path)


def shard_starts(shards: DataFrame) -> DataFrame:
    """``part``, ``seq`` and the number of ids in all shards before."""
    sizes = shards.select("part", "seq", "n_ids")
    return running_total_before(sizes, [], F.col("part"), ["seq"], F.col("n_ids"), "before")


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every stored document."""
    shards = read_shards(spark, path)
    starts = shard_starts(shards).select("part", "seq", "before")

    def checks(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                ids = Shard.of(row).ids().astype("<u4")
                sizes = np.array(row["doc_sizes"], np.int64)
                end = np.cumsum(sizes)
                crc = [zlib.crc32(ids[e - s:e].tobytes()) for s, e in zip(sizes, end)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["part"]] * len(sizes), pa.int32()),
                     pa.array([row["seq"]] * len(sizes), pa.int32()),
                     pa.array(row["doc_ids"], pa.int64()), pa.array(end - sizes),
                     pa.array(sizes), pa.array(crc, pa.int64())],
                    ["part", "seq", "doc_id", "offset", "n_tokens", "ids_crc32"])

    documents = shards.mapInArrow(checks, "part int, seq int, doc_id bigint, offset bigint, "
                                          "n_tokens bigint, ids_crc32 bigint")
    return documents.join(starts, ["part", "seq"]).select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32")


def occurrences(spark: SparkSession, path: str, token: int, limit: int | None = None) -> DataFrame:
    """Positions of a token in each shard, by rank and select alone.

    ``limit`` bounds the positions listed per shard; the count is always whole.
    """
    def lookup(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                shard = Shard.of(row)
                count = shard.rank(token, shard.n)
                listed = range(count if limit is None else min(count, limit))
                yield pa.RecordBatch.from_pylist([{
                    "part": row["part"], "seq": row["seq"], "count": count,
                    "positions": [shard.select(token, k) for k in listed]}],
                    pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("count", pa.int64()),
                               ("positions", pa.list_(pa.int64()))]))

    return read_shards(spark, path).mapInArrow(
        lookup, "part int, seq int, count bigint, positions array<bigint>")


def stored(docs: DataFrame, tokenizer: str) -> DataFrame:
    """Write the documents to a new folder and read them back."""
    workspace = Workspace(docs.sparkSession, "wavelet")
    path = f"{workspace.root}/shards"
    write_shards(docs, path, tokenizer)
    return read_documents(docs.sparkSession, path)
