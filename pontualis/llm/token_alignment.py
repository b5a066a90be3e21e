"""Alignment of two tokenizers over a corpus: groups, links, and how common each linked pair is.

A is a byte-level tokenizer and B a SentencePiece model.  Both cut a text into tokens
of whole bytes.  Byte offsets at which a token ends in both cut the text into groups, and an
A token is linked with every B token whose bytes overlap its own.

Neither tokenizer merges across a lone space or newline between two other characters (checked
against the vocabularies when they are loaded), so a text is a sequence of units, each aligned
once and remembered.  The distinct pairs of a document are counted in two ways.  An
identity map gives each A id the B id of the same bytes; pairs that follow it are
counted in vectors as long as the vocabulary of A, one a task.  All other pairs are
added up inside a task and only then shuffled.  Counts come back to the documents in
blocks of at most ``BLOCK_PAIRS`` pairs, one pass over the stored pairs each; the sums of a
pass are written and its block is released, so one block is in memory at a time.
"""

from __future__ import annotations

import hashlib
import os
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pontualis.llm.batches import fit_batches, map_texts
from pontualis.llm.tables import Workspace

# Pairs of which the counts are broadcast at once, 17 bytes each.
BLOCK_PAIRS = 2_000_000
# Pairs a task adds up before it hands on what it has, and units it remembers: about 40 MB
# and 150 MB.  Longer units are aligned again each time.
TASK_PAIRS = 1 << 20
REMEMBERED = 400_000
UNIT_CHARS = 64
SPACE_PIECE = "▁"

_PLAIN = re.compile(r"[ \n]\S+")
_BORDER = re.compile(r"(?<=\S)(?=[ \n]\S)")

ALIGNED = ("n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, "
           "pairs binary, times binary")


def _byte_characters() -> dict[str, int]:
    """Byte-level vocabularies spell bytes that do not print as the characters from 256 on."""
    printed = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in printed]
    return {chr(b): b for b in printed} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens and the identity map from A to B."""

    def __init__(self, path_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        spelled = _byte_characters()
        special = {i: t.content.encode() for i, t in self.a.get_added_tokens_decoder().items()}
        self.a_bytes = [special[i] if i in special else
                        bytes(spelled[c] for c in self.a.id_to_token(i) or "")
                        for i in range(self.a.get_vocab_size())]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else
                        p.replace(SPACE_PIECE, " ").encode() for i, p in enumerate(pieces)]
        crossing = [p for i, p in enumerate(pieces) if not self.b.is_control(i) and (
            SPACE_PIECE in p.lstrip(SPACE_PIECE) or "\n" in p)]
        if crossing:
            raise ValueError(f"pieces reach across words: {crossing[:3]}")
        self.a_size = np.array([len(b) for b in self.a_bytes], np.int64)
        self.b_size = np.array([len(b) for b in self.b_bytes], np.int64)
        # Ordinary pieces come before the byte pieces, which spell unknown characters only.
        real = [i for i in range(len(pieces))
                if not (self.b.is_control(i) or self.b.is_unknown(i) or self.b.is_byte(i))]
        spelling = {self.b_bytes[i]: i for i in reversed(
            real + [i for i in range(len(pieces)) if self.b.is_byte(i)])}
        self.identity = np.array([spelling.get(b, -1) for b in self.a_bytes], np.int64)
        self.n_b = len(pieces)
        self.key = np.dtype("<u4" if len(self.a_bytes) * self.n_b < 1 << 32 else "<u8")

    def tokens(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B of units, each of which begins with a space or a newline.

        B puts a space before what it is given; a unit's own space is left to it, and
        before a newline that space is a token of its own, which is taken off.
        """
        a = [e.ids for e in self.a.encode_batch_fast(units, add_special_tokens=False)]
        b = self.b.encode([u[1:] if u[0] == " " else u for u in units], num_threads=1)
        return a, [ids if u[0] == " " else ids[1:] for u, ids in zip(units, b)]


@lru_cache(maxsize=1)
def vocabularies(path_a: str, path_b: str) -> Vocabularies:
    return Vocabularies(path_a, path_b)


@dataclass
class Alignment:
    """Aligned units: sizes, group texts, and the linked pairs one unit after another."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    whole: np.ndarray
    first: np.ndarray
    pairs: np.ndarray
    groups: list[str]


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers first, first + 1, ... of each count, one after another."""
    ends = np.cumsum(count)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(first - (ends - count), count)


def align_units(vocab: Vocabularies, units: list[str]) -> Alignment:
    """Align units; one whose bytes either tokenizer changes is not ``whole`` and has no links."""
    a, b = vocab.tokens(units)
    raw = [u.encode("utf-8", "surrogatepass") for u in units]
    whole = np.array([
        b"".join([vocab.a_bytes[i] for i in x]) == r and b"".join([vocab.b_bytes[i] for i in y]) == r
        for x, y, r in zip(a, b, raw)], bool)
    a = [x if w else [] for x, w in zip(a, whole)]
    b = [y if w else [] for y, w in zip(b, whole)]
    n_a, n_b = (np.array([len(x) for x in side], np.int64) for side in (a, b))
    ids_a, ids_b = (np.array([i for x in side for i in x], np.int64) for side in (a, b))
    # Units follow each other, so ends of both sides share one scale of bytes.
    end_a, end_b = np.cumsum(vocab.a_size[ids_a]), np.cumsum(vocab.b_size[ids_b])
    begin_a, begin_b = end_a - vocab.a_size[ids_a], end_b - vocab.b_size[ids_b]
    low = np.searchsorted(end_b, begin_a, "right")
    count = np.searchsorted(begin_b, end_a, "left") - low
    pairs = np.repeat(ids_a, count) * vocab.n_b + ids_b[_ranges(low, count)]
    unit_a = np.repeat(np.arange(len(units)), n_a)
    links = np.bincount(unit_a, count, len(units)).astype(np.int64)
    cuts = np.intersect1d(end_a, end_b)
    to_a = np.searchsorted(end_a, cuts, "right")
    to_b = np.searchsorted(end_b, cuts, "right")
    texts_a, texts_b = list(map(str, ids_a.tolist())), list(map(str, ids_b.tolist()))
    made, p, q = [], 0, 0
    for i, j in zip(to_a.tolist(), to_b.tolist()):
        made.append(",".join(texts_a[p:i]) + "|" + ",".join(texts_b[q:j]))
        p, q = i, j
    n_groups = np.bincount(unit_a[to_a - 1], minlength=len(units)) if len(cuts) \
        else np.zeros(len(units), np.int64)
    ends = np.cumsum(n_groups).tolist()
    groups = [";".join(made[e - n:e]) for e, n in zip(ends, n_groups.tolist())]
    first = np.concatenate(([0], np.cumsum(links)))
    return Alignment(n_a, n_b, n_groups, whole, first, pairs.astype(vocab.key), groups)


class Aligner:
    """Alignments of units by their text, remembered from batch to batch."""

    def __init__(self, vocab: Vocabularies) -> None:
        self.vocab = vocab
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.groups: list[str] = []
        self.numbers = np.zeros((0, 5), np.int64)  # n_a, n_b, n_groups, whole, links
        self.pairs = np.zeros(0, self.vocab.key)
        self.first = np.zeros(1, np.int64)

    def _learn(self, units: list[str]) -> None:
        new = align_units(self.vocab, units)
        self.place.update(zip(units, range(len(self.groups), len(self.groups) + len(units))))
        self.groups += new.groups
        self.numbers = np.concatenate((self.numbers, np.stack(
            (new.n_a, new.n_b, new.n_groups, new.whole, np.diff(new.first)), 1)))
        self.first = np.concatenate((self.first, new.first[1:] + self.first[-1]))
        self.pairs = np.concatenate((self.pairs, new.pairs))

    @staticmethod
    def units(text: str) -> list[str]:
        """The text after a space, cut before lone spaces and newlines."""
        spaced = " " + text
        found = _PLAIN.findall(spaced)
        return found if sum(map(len, found)) == len(spaced) else _BORDER.split(spaced)

    def documents(self, texts: list[str | None]) -> dict[str, list]:
        """Columns of ``ALIGNED`` for some texts."""
        rows = [self.units(t) if t else [] for t in texts]
        self._learn([u for u in dict.fromkeys(u for row in rows for u in row)
                     if u not in self.place])
        bounds = np.concatenate(([0], np.cumsum([len(row) for row in rows])))
        own = [list(map(self.place.__getitem__, row)) for row in rows]
        at = np.array([i for row in own for i in row], np.int64)
        numbers = self.numbers[at]
        totals = np.zeros((len(at) + 1, 5), np.int64)
        np.cumsum(numbers, axis=0, out=totals[1:])
        sums = totals[bounds[1:]] - totals[bounds[:-1]]
        good = sums[:, 3] == np.diff(bounds)
        sums[~good] = 0
        doc = np.repeat(np.arange(len(rows)), np.diff(bounds))
        links = np.where(good[doc], numbers[:, 4], 0)
        keys = self.pairs[_ranges(self.first[at], links)].astype(np.int64)
        span = len(self.vocab.a_bytes) * self.vocab.n_b
        both, times = np.unique(np.repeat(doc, links) * span + keys, return_counts=True)
        edges = np.searchsorted(both, np.arange(len(rows) + 1) * span).tolist()
        keys = (both % span).astype(self.vocab.key)
        times = times.astype("<u4")
        digests = ["" if not (g and row) else hashlib.sha256(
            ";".join([self.groups[i] for i in row]).encode()).hexdigest()
            for g, row in zip(good.tolist(), own)]
        out = {
            **{n: pa.array(sums[:, i]) for i, n in enumerate(("n_a", "n_b", "n_groups"))},
            "n_links": pa.array(sums[:, 4]), "groups_sha256": pa.array(digests, pa.string()),
            "pairs": pa.array([keys[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary()),
            "times": pa.array([times[x:y].tobytes() for x, y in zip(edges, edges[1:])], pa.binary())}
        long = sum(map(len, self.place)) > REMEMBERED * UNIT_CHARS // 4
        if long or len(self.place) > REMEMBERED:
            self._forget()
        return out


@lru_cache(maxsize=1)
def aligner_of(path_a: str, path_b: str) -> Aligner:
    """The aligner of this worker process; its memory lasts from task to task."""
    return Aligner(vocabularies(path_a, path_b))


def _keys_and_rows(batch: pa.RecordBatch, vocab: Vocabularies) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of all rows one after another, and the row of each."""
    blobs = batch.column("pairs").to_pylist()
    keys = np.frombuffer(b"".join(blobs), vocab.key)
    sizes = np.array([len(b) for b in blobs], np.int64) // vocab.key.itemsize
    return keys, np.repeat(np.arange(len(blobs)), sizes)


def pair_counts(aligned: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """``a``, ``b`` and in how many documents both are linked, of all linked pairs."""
    def added(batches):
        vocab = vocabularies(path_a, path_b)
        same = np.zeros(len(vocab.a_bytes), np.int64)
        known, numbers = np.zeros(0, vocab.key), np.zeros(0, np.int64)
        held, n_held = [], 0

        def rows(a, b, n):
            return pa.RecordBatch.from_arrays([pa.array(a, pa.int32()), pa.array(b, pa.int32()),
                                               pa.array(n, pa.int64())], ["a", "b", "n"])

        def merged():
            keys, times = np.unique(np.concatenate(held), return_counts=True)
            keys, at = np.unique(np.concatenate((known, keys)), return_inverse=True)
            return keys, np.bincount(at, np.concatenate((numbers, times)), len(keys)).astype(np.int64)

        for batch in batches:
            keys, _ = _keys_and_rows(batch, vocab)
            a, b = np.divmod(keys.astype(np.int64), vocab.n_b)
            regular = vocab.identity[a] == b
            same += np.bincount(a[regular], minlength=len(same))
            held.append(keys[~regular])
            n_held += len(held[-1])
            if n_held > TASK_PAIRS:
                known, numbers = merged()
                held, n_held = [], 0
                if len(known) > TASK_PAIRS:
                    yield rows(*np.divmod(known.astype(np.int64), vocab.n_b), numbers)
                    known, numbers = known[:0], numbers[:0]
        if held:
            known, numbers = merged()
        yield rows(*np.divmod(known.astype(np.int64), vocab.n_b), numbers)
        a = np.flatnonzero(same)
        yield rows(a, vocab.identity[a], same[a])

    partial = aligned.select("pairs").mapInArrow(added, "a int, b int, n bigint")
    return partial.groupBy("a", "b").agg(F.sum("n").alias("n"))


def _blocks(counts: DataFrame, most: int) -> list[tuple[int, int]]:
    """Ranges of A ids with at most ``most`` pairs, or one id; one row an id goes to the driver."""
    sizes = counts.groupBy("a").count().orderBy("a").collect()
    blocks, begin, held = [], None, 0
    for a, n in sizes:
        if begin is not None and held + n > most:
            blocks.append((begin, a))
            begin, held = None, 0
        begin, held = (a if begin is None else begin), held + n
    return blocks + ([(begin, sizes[-1][0] + 1)] if sizes else [])


def _looked_up(aligned: DataFrame, block: DataFrame, path_a: str, path_b: str,
               workspace: Workspace, name: str) -> DataFrame:
    """``row``, ``n_best`` and ``count_sum`` over the pairs of one block, of rows that hold any."""
    table = block.toArrow()
    n_b = vocabularies(path_a, path_b).n_b
    keys = table["a"].to_numpy().astype(np.int64) * n_b + table["b"].to_numpy()
    order = np.argsort(keys)
    shared = block.sparkSession.sparkContext.broadcast(
        (keys[order], table["n"].to_numpy()[order], table["best"].to_numpy()[order]))

    def sums(batches):
        vocab = vocabularies(path_a, path_b)
        known, numbers, best = shared.value
        for batch in batches:
            keys, row = _keys_and_rows(batch, vocab)
            keys = keys.astype(np.int64)
            times = np.frombuffer(b"".join(batch.column("times").to_pylist()), "<u4").astype(np.int64)
            at = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            times = np.where(known[at] == keys, times, 0) if len(known) else times * 0
            found = np.zeros((2, batch.num_rows), np.int64)
            if len(known):
                np.add.at(found[0], row, times * best[at])
                np.add.at(found[1], row, times * numbers[at])
            held = pa.array(found[1] > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row").filter(held), pa.array(found[0]).filter(held),
                 pa.array(found[1]).filter(held)], ["row", "n_best", "count_sum"])

    written = workspace.save(aligned.select("row", "pairs", "times").mapInArrow(
        sums, "row bigint, n_best bigint, count_sum bigint"), name)
    shared.destroy()
    return written


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id",
          text: str = "text", block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """One row per document with its numbers of tokens, groups and links.

    ``n_best`` counts links whose pair is in as many documents as any pair of the same A id,
    ``count_sum`` adds up the document counts of the pairs of all links.  NULL and empty
    texts, and texts whose bytes a tokenizer changes, have zeros and an empty digest.
    Repeated rows are all returned and count as documents of their own; other columns may
    have any name.
    """
    fit_batches(docs)
    workspace = Workspace(docs.sparkSession, "alignment")
    rows = docs.select(F.monotonically_increasing_id().alias("row"),
                       F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def work(texts: pa.Array) -> dict[str, pa.Array]:
        return aligner_of(path_a, path_b).documents(texts.to_pylist())

    mapped = map_texts(rows, "text", ["row", "doc_id"], ALIGNED, work)
    aligned = workspace.save(mapped.select("row", "doc_id", "_out.*"), "aligned")
    counts = workspace.save(pair_counts(aligned, path_a, path_b), "counts")
    most = counts.groupBy("a").agg(F.max("n").alias("most"))
    judged = counts.join(most, "a").select("a", "b", "n", (F.col("n") == F.col("most")).alias("best"))
    judged = workspace.save(judged, "judged")
    parts = [_looked_up(aligned, judged.where(F.col("a").between(low, high - 1)), path_a, path_b,
                        workspace, f"sums{i}")
             for i, (low, high) in enumerate(_blocks(judged, block_pairs))]
    numbers = ["doc_id", "n_a", "n_b", "n_groups", "n_links"]
    zero = F.lit(0).cast("bigint")
    if not parts:
        return aligned.select(*numbers, zero.alias("n_best"), zero.alias("count_sum"), "groups_sha256")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    found = found.groupBy("row").agg(F.sum("n_best").alias("n_best"),
                                     F.sum("count_sum").alias("count_sum"))
    return aligned.join(found, "row", "left").select(
        *numbers, F.coalesce("n_best", zero).alias("n_best"),
        F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256")
