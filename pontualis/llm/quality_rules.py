"""Quality rules: log-likelihood ratio of hashed n-grams, trusted target against raw corpus.

Words and word pairs of every text are hashed into ``BUCKETS`` buckets.  The
bucket counts of the trusted documents and of all documents are two smoothed
multinomials; the score of a text is the mean over its n-grams of
``log(p_target / p_raw)``, so it does not grow with its length.

Trusted documents are part of the target, so that score favours them, and it falls
for n-grams that are unseen only because few documents are trusted.  The verdict
therefore rests on ``fair_llr``: a document's own counts are left out of both
distributions, and the ratio of a bucket is that of its target count to the count
expected from its raw share, with pseudo-counts added to both, so that a bucket with
little to expect scores about 0.  They grow with the expected count where few long
documents make up most of the target, as their topics and languages then decide
which n-grams it lacks.  Every document is judged by one fixed threshold,
without drawing lots.

Both distributions count every word of every document.  What reaches the driver
is one pair of counts per bucket, a bound that does not depend on the data.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.llm.batches import fit_batches, map_texts, whole_rows
from pontualis.llm.tables import BROADCAST_IDS, broadcast_up_to
from pontualis.llm.words import (LEADING, NOT_SPACE, Texts, Words, byte_class, lines_of, per_text,
                                 repeated, slices, texts_of, window_hashes, words_of)

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
# Pseudo-counts of a bucket under either distribution.
SMOOTHING = 1.0
# Pseudo-counts of a bucket, seen and expected, in the ratio of the verdict: a number, and
# so many documents' share of the expected count.
PRIOR = 8.0
PRIOR_DOCUMENTS = 10.0
# A text whose mean log ratio lies below this is rejected.
THRESHOLD = -0.12
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# The characters counted as symbols.
SYMBOLS = byte_class(*[(ord(c), ord(c)) for c in "#*$%&|<>"])

FIELDS = ("n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
          "n_repeat_words bigint, base_failed boolean, llr double, fair_llr double, kept boolean")


@dataclass(frozen=True)
class Ratio:
    """Log ratio and counts of each bucket, the threshold, and the trusted ids as a table.

    ``lean`` is the part of an expected count that is added as pseudo-count.
    """

    weights: np.ndarray
    threshold: float
    raw: np.ndarray
    target: np.ndarray
    lean: float
    trusted: DataFrame


def _grams(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and word pair, and the text it belongs to."""
    pairs, at = window_hashes(words, 2)
    text = words.text_of_word
    bucket = np.concatenate((words.hash, pairs)) >> np.uint64(64 - BUCKET_BITS)
    return bucket.astype(np.int64), np.concatenate((text, text[at]))


def _count_partition(batches):
    """Bucket counts of one partition: all documents, and the trusted ones.

    The bucket beyond the last holds the sum of squares of the trusted documents' lengths.
    """
    squares = 0
    counts = np.zeros((2, BUCKETS), np.int64)
    for batch in batches:
        for part in slices(batch, "t"):
            words = words_of(texts_of(part.column("t")), NOT_SPACE)
            trusted = part.column("trusted").to_numpy(zero_copy_only=False).astype(bool)
            bucket, text = _grams(words)
            counts[0] += np.bincount(bucket, minlength=BUCKETS)
            counts[1] += np.bincount(bucket[trusted[text]], minlength=BUCKETS)
            squares += int((np.bincount(text, minlength=len(trusted))[trusted] ** 2).sum())
    used = np.flatnonzero(counts[0])
    if len(used):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(used, BUCKETS)), pa.array(np.append(counts[0][used], 0)),
             pa.array(np.append(counts[1][used], squares))],
            ["bucket", "raw", "target"])


def trusted_ids(trusted: DataFrame, doc_id: str) -> DataFrame:
    """Columns ``i`` and ``trusted`` of the listed ids.

    Ids that are NULL or listed several times are dropped first.  The list is
    broadcast when its counted size is at most ``BROADCAST_IDS``, so texts are
    shuffled only for a longer one.
    """
    ids = (trusted.select(F.col(doc_id).alias("i")).where("i IS NOT NULL").distinct()
           .withColumn("trusted", F.lit(True)))
    return broadcast_up_to(ids, BROADCAST_IDS)


def mark_trusted(docs: DataFrame, ids: DataFrame, doc_id: str, text: str,
                 keep: tuple[str, ...] = ()) -> DataFrame:
    """Columns ``t`` and ``trusted`` of every document, and ``keep`` in the struct ``held``."""
    held = [F.struct(*[F.col(f"`{c}`") for c in keep]).alias("held")] if keep else []
    return (docs.select(*held, F.col(f"`{doc_id}`").alias("i"), F.col(f"`{text}`").alias("t"))
            .join(ids, "i", "left")
            .select(*(["held"] if keep else []), "t", F.coalesce("trusted", F.lit(False)).alias("trusted")))


def fit_ratio(docs: DataFrame, trusted: DataFrame, doc_id: str = "doc_id", text: str = "text",
              threshold: float = THRESHOLD) -> Ratio:
    """Count both distributions over all documents."""
    fit_batches(docs)
    ids = trusted_ids(trusted, doc_id)
    rows = (mark_trusted(docs, ids, doc_id, text)
            .mapInArrow(_count_partition, "bucket bigint, raw bigint, target bigint")
            .groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
            .toPandas())
    counts = np.zeros((2, BUCKETS + 1))
    counts[0, rows.bucket] = rows.raw
    counts[1, rows.bucket] = rows.target
    raw, target = counts[:, :BUCKETS]
    lean = PRIOR_DOCUMENTS * counts[1, BUCKETS] / max(target.sum(), 1) ** 2
    if not target.any():
        return Ratio(np.zeros(BUCKETS), threshold, raw, target, lean, ids)

    def log_share(counts: np.ndarray) -> np.ndarray:
        return np.log(counts + SMOOTHING) - np.log(counts.sum() + SMOOTHING * BUCKETS)

    return Ratio(log_share(target) - log_share(raw), threshold, raw, target, lean, ids)


def _covered(words: Words) -> np.ndarray:
    """Per text, the words inside a window of three words that occurs twice or more in it."""
    hashes, at = window_hashes(words, 3)
    again = at[repeated(hashes, np.searchsorted(at, words.first))]
    hit = np.zeros(len(words.hash), bool)
    for j in range(3):
        hit[again + j] = True
    return per_text(hit, words.first)


def _dup_lines(texts: Texts, words: Words) -> np.ndarray:
    lines = lines_of(texts, words)
    size = np.diff(lines.first)
    order = np.lexsort((lines.hash, np.repeat(np.arange(len(texts)), size)))
    ordered = lines.hash[order]
    same = np.zeros(len(ordered), bool)
    same[1:] = ordered[1:] == ordered[:-1]
    same[lines.first[:-1][size > 0]] = False
    return per_text(same, lines.first)


def _fair(bucket: np.ndarray, text: np.ndarray, grams: np.ndarray, trusted: np.ndarray,
          raw: np.ndarray, target: np.ndarray, lean: float) -> np.ndarray:
    """Mean log ratio of each text against what is counted in all others."""
    pairs, own = np.unique(text << BUCKET_BITS | bucket, return_counts=True)
    text, bucket = pairs >> BUCKET_BITS, pairs & (BUCKETS - 1)
    seen = np.maximum(target[bucket] - own * trusted[text], 0)
    others = np.maximum(raw[bucket] - own, 0)
    share = np.maximum(target.sum() - grams * trusted, 0) / np.maximum(raw.sum() - grams, 1)
    expected = others * share[text]
    pseudo = PRIOR + lean * expected
    logs = np.log(seen + pseudo) - np.log(expected + pseudo)
    return np.bincount(text, logs * own, minlength=len(grams)) / np.maximum(grams, 1)


def judge(column: pa.Array, trusted: pa.Array, weights: np.ndarray, threshold: float,
          raw: np.ndarray, target: np.ndarray, lean: float) -> dict[str, pa.Array]:
    """All measures of a slice of texts."""
    texts = texts_of(column)
    words = words_of(texts, NOT_SPACE)
    n_words = words.counts
    repeat = _covered(words)
    failed = (n_words < MIN_WORDS) | (100 * repeat > MAX_REPEAT_PERCENT * n_words)
    bucket, text = _grams(words)
    grams = np.bincount(text, minlength=len(texts))
    llr = np.bincount(text, weights[bucket], minlength=len(texts)) / np.maximum(grams, 1)
    fair = _fair(bucket, text, grams, trusted.to_numpy(zero_copy_only=False).astype(bool),
                 raw, target, lean)
    in_word = NOT_SPACE[texts.data] & LEADING[texts.data]
    columns = {
        "n_words": n_words.astype(np.int64), "word_chars": per_text(in_word, texts.bounds),
        "n_symbols": per_text(SYMBOLS[texts.data], texts.bounds),
        "n_dup_lines": _dup_lines(texts, words), "n_repeat_words": repeat, "base_failed": failed,
        "llr": llr, "fair_llr": fair, "kept": ~failed & (fair >= threshold)}
    return {name: pa.array(values) for name, values in columns.items()}


def quality_rules(docs: DataFrame, ratio: Ratio, keep: tuple[str, ...] = ("doc_id",),
                  text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """Columns ``keep`` of every row and its measures in the struct ``_out``.

    One row per row of ``docs``, which are the documents the ratio was fitted on, repeated
    rows included.  A NULL or empty text has no words, fails the base rule and scores 0; NULL
    ids are passed on; other columns may have any name.  Without trusted documents every
    score is 0 and only the base rules decide.
    """
    weights, threshold, counts = ratio.weights, ratio.threshold, (ratio.raw, ratio.target, ratio.lean)
    rows = mark_trusted(docs, ratio.trusted, doc_id, text, keep)
    return map_texts(rows, "t", ("held",), FIELDS, lambda column, trusted: judge(
        column, trusted, weights, threshold, *counts), beside=("trusted",)).select("held.*", "_out")


def keep_good(docs: DataFrame, ratio: Ratio, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents that pass, with all their columns."""
    rows = whole_rows(docs, text).withColumn("id", F.col("row").getField(doc_id))
    return quality_rules(rows, ratio, ("row",), doc_id="id").where("_out.kept").select("row.*")
