"""MinHash near-dedup with HyperMinHash registers.

A text is the set of its distinct shingles of five words.  Its sketch has
``BUCKETS`` registers; each keeps, of the smallest hash that falls into its
bucket, the count of leading zeros and ``MANTISSA`` bits behind them.  Bands of
three compressed registers give candidates, the collision-corrected Jaccard
estimate from the registers discards those far below the limit, and the full
sets of the rest are compared.

Texts with equal sets are one class from the start.  In every band bucket all
members are compared with the smallest one, its leader.  Only texts of a leader
that are then still in different components are compared with each other, in
blocks, so a large group of near copies costs a star and not all its pairs, and no
link between different components is left untested.

A pair at similarity 0.75 shares no band with a probability of about 1e-10.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.llm.batches import fit_batches, grouped, map_texts, whole_rows
from pontualis.llm.components import components
from pontualis.llm.tables import BROADCAST_IDS, Workspace, broadcast_up_to, join_unique
from pontualis.llm.words import (LOWER, NOT_SPACE, mix, shingle_sets, slices, stream, texts_of,
                                 words_of)

SHINGLE = 5
MIN_PERCENT = 75
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA = 10
BAND_ROWS = 3
BANDS = BUCKETS // BAND_ROWS
# An estimate this many standard deviations below the limit is discarded.
DEVIATIONS = 6.0
# Shingles of the texts that are compared with each other in one block.
BLOCK = 1 << 20
# Pairs of one text that are verified in one task.
STAR = 1000

SKETCH = "n bigint, d1 bigint, d2 bigint, registers binary"


def registers_of(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Registers of each set of sorted 64-bit hashes; 0 marks an empty bucket.

    The top bits of a hash name its bucket.  As the hashes are sorted, the first
    one of a bucket is its smallest.
    """
    out = np.zeros((len(bounds) - 1, BUCKETS), np.uint16)
    if not len(sets):
        return out
    bucket = (sets >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    owner = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    first = np.ones(len(sets), bool)
    first[1:] = (bucket[1:] != bucket[:-1]) | (owner[1:] != owner[:-1])
    rest = sets[first] << np.uint64(BUCKET_BITS)
    zeros = 53 - np.frexp((rest >> np.uint64(11)).astype(np.float64))[1]
    behind = rest << (zeros + 1).astype(np.uint64)
    value = ((zeros + 1) << MANTISSA) | (behind >> np.uint64(64 - MANTISSA)).astype(np.int64)
    out[owner[first], bucket[first]] = value
    return out


_SOURCES = [np.argsort(stream(10 + i, BUCKETS)) for i in range(48)]


def filled(registers: np.ndarray) -> np.ndarray:
    """Registers whose empty buckets borrow from others, chosen by bucket number alone."""
    out = registers.copy()
    empty = out == 0
    some = np.flatnonzero(empty.any(1) & ~empty.all(1))
    own, part, open_ = registers[some], out[some], empty[some]
    for attempt in range(len(_SOURCES) + BUCKETS):
        if not open_.any():
            break
        source = (_SOURCES[attempt] if attempt < len(_SOURCES)
                  else (np.arange(BUCKETS) + attempt - len(_SOURCES)) % BUCKETS)
        found = own[:, source]
        take = open_ & (found > 0)
        part[take] = found[take]
        open_ &= ~take
    out[some] = part
    return out


def estimate(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray
             ) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimate and the number of buckets it rests on, for rows of registers.

    Registers of different minima agree by chance: with n and m elements a bucket
    collides with probability ``nm / (n + m)**2 * 0.5 / ln(2) / 2**MANTISSA``,
    the overlap of two exponential densities over cells that grow with their value.
    """
    used = ((a > 0) | (b > 0)).sum(-1)
    same = ((a == b) & (a > 0)).sum(-1)
    n, m = n.astype(float), m.astype(float)
    chance = n * m / (n + m) ** 2 * (0.5 / np.log(2)) / (1 << MANTISSA)
    raw = same / np.maximum(used, 1)
    return (raw - chance) / (1 - chance), used


def possible(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Pairs that can reach the limit by size, and by estimate up to ``DEVIATIONS``."""
    limit = MIN_PERCENT / 100
    value, used = estimate(a, b, n, m)
    slack = DEVIATIONS * np.sqrt(limit * (1 - limit) / np.maximum(used, 1))
    return (100 * np.minimum(n, m) >= MIN_PERCENT * np.maximum(n, m)) & (value >= limit - slack)


def _sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    return shingle_sets(words_of(texts_of(column), NOT_SPACE, LOWER), SHINGLE)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def sketch(column: pa.Array) -> dict[str, pa.Array]:
    """Set size, two order-free digests of the set, and the registers."""
    sets, bounds = _sets(column)

    def total(values: np.ndarray) -> np.ndarray:
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)))
        return sums[bounds[1:]] - sums[bounds[:-1]]

    return {"n": pa.array(np.diff(bounds)), "d1": _signed(total(sets)),
            "d2": _signed(total(mix(sets ^ np.uint64(0xA5A5A5A55A5A5A5A)))),
            "registers": _binary(registers_of(sets, bounds))}


def _band_rows(batches):
    """One row per band of each sketch; the key holds the band and its registers."""
    for batch in batches:
        if not batch.num_rows:
            continue
        values = filled(_matrix(batch.column("registers")))[:, :BANDS * BAND_ROWS]
        values = values.reshape(-1, BANDS, BAND_ROWS).astype(np.int64)
        key = np.broadcast_to(np.arange(BANDS), values.shape[:2]).copy()
        for row in range(BAND_ROWS):
            key = key << 16 | values[:, :, row]
        ids = np.repeat(batch.column("rep").to_numpy(), BANDS)
        yield pa.RecordBatch.from_arrays([pa.array(key.ravel()), pa.array(ids)], ["key", "rep"])


def _estimated(batches):
    """Pairs whose registers leave them possible."""
    for batch in batches:
        if batch.num_rows:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            keep = possible(_matrix(batch.column("x")), _matrix(batch.column("y")), n, m)
            yield batch.select(["a", "b"]).filter(pa.array(keep))


def _table_sets(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Shingle sets of all texts of a table, worked out slice by slice."""
    parts = [_sets(part.column("text")) for batch in table.to_batches()
             for part in slices(batch, "text")]
    sizes = np.concatenate([np.diff(bounds) for _, bounds in parts])
    return np.concatenate([sets for sets, _ in parts]), np.concatenate(([0], np.cumsum(sizes)))


class _SharedShingles:
    """Counts the shingles that a text shares with each of the texts put in before.

    ``sets`` holds the sets of all texts one after another.  A shingle keeps a list of its
    texts, so a count costs as much as the texts have in common and nothing for the rest.
    """

    def __init__(self, sets: np.ndarray, bounds: np.ndarray) -> None:
        _, self.code = np.unique(sets, return_inverse=True)
        self.bounds = bounds
        self.start = np.concatenate(([0], np.cumsum(np.bincount(self.code))))
        self.owner = np.empty(len(sets), np.int32)
        self.clear()

    def clear(self) -> None:
        self.filled = np.zeros(len(self.start) - 1, np.int64)

    def put(self, i: int) -> None:
        own = self.code[self.bounds[i]:self.bounds[i + 1]]
        self.owner[self.start[own] + self.filled[own]] = i
        self.filled[own] += 1

    def counts(self, i: int) -> np.ndarray:
        """One count for each text, 0 for those not put in."""
        own = self.code[self.bounds[i]:self.bounds[i + 1]]
        number = self.filled[own]
        first = np.repeat(self.start[own] - np.cumsum(number) + number, number)
        return np.bincount(self.owner[first + np.arange(len(first))],
                           minlength=len(self.bounds) - 1)


def _cross_links(batches):
    """Links inside a block, or between two, of texts that are in different components.

    Texts of the largest component are never compared with each other, and each other text
    only with those before it.  Estimates leave some pairs possible, and those are verified by
    the shingles they share.  Components that a link joins are one from then on, so a
    block gives at most one link for each of its texts.
    """
    for group in grouped(batches, ["lead", "low", "high"]):
        sets, bounds = _table_sets(group)
        registers, size = registers_of(sets, bounds), np.diff(bounds)
        ids, comp = group["id"].to_numpy(), group["component"].to_numpy().copy()
        block, low, high = group["block"].to_numpy(), group["low"][0].as_py(), group["high"][0].as_py()
        names, members = np.unique(comp, return_counts=True)
        main = comp == names[np.argmax(members)]
        shared, found = _SharedShingles(sets, bounds), []

        def compare(i: int, pool: np.ndarray) -> None:
            other = pool[(comp[pool] != comp[i]) & (size[pool] > 0)] if size[i] else pool[:0]
            other = other[possible(registers[i][None], registers[other], size[i], size[other])]
            if not len(other):
                return
            both = shared.counts(i)[other]
            for j in other[100 * both >= MIN_PERCENT * (size[i] + size[other] - both)]:
                if comp[j] != comp[i]:
                    found.append(sorted((int(ids[i]), int(ids[j]))))
                    comp[comp == comp[j]] = comp[i]

        if low == high:
            order = np.concatenate((np.flatnonzero(main), np.flatnonzero(~main)))
            for at, i in enumerate(order):
                if not main[i]:
                    compare(i, order[:at])
                shared.put(i)
        else:
            for pool, asking in ((block == high, (block == low) & ~main),
                                 ((block == low) & main, (block == high) & ~main)):
                shared.clear()
                pool = np.flatnonzero(pool)
                for j in pool:
                    shared.put(j)
                for i in np.flatnonzero(asking):
                    compare(i, pool)
        if found:
            a, b = zip(*found)
            yield pa.RecordBatch.from_arrays(
                [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _verified(batches):
    """Pairs whose full sets reach the limit; each run of rows begins with its leading text."""
    lead, leader = None, None
    for batch in batches:
        for part in slices(batch, "text"):
            sets, bounds = _sets(part.column("text"))
            leads, kinds = part.column("lead").to_pylist(), part.column("kind").to_pylist()
            found = []
            for i, (a, kind, b) in enumerate(zip(leads, kinds, part.column("id").to_pylist())):
                own = sets[bounds[i]:bounds[i + 1]]
                if kind == 0:
                    lead, leader = a, own.copy()
                elif a == lead and len(own):
                    place = np.minimum(np.searchsorted(leader, own), len(leader) - 1)
                    shared = int((leader[place] == own).sum())
                    if 100 * shared >= MIN_PERCENT * (len(leader) + len(own) - shared):
                        found.append((a, b))
            if found:
                a, b = zip(*found)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def _only(texts: DataFrame, ids: DataFrame) -> DataFrame:
    """The texts of some ids, so that no others are shuffled to be compared."""
    return texts.join(broadcast_up_to(ids.distinct(), BROADCAST_IDS), "id", "left_semi")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links among candidate pairs (a, b), by the full sets of ``texts`` (id, text).

    A text with many pairs is sent to several tasks, ``STAR`` pairs to each.
    """
    stars = (pairs.groupBy("a").count()
             .withColumn("salts", F.ceil(F.col("count") / STAR).cast("int")))
    members = (join_unique(pairs, stars, ["a"], "count", pairs.count()).select(
        F.col("b").alias("id"), F.col("a").alias("lead"),
        F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("kind")))
    leaders = stars.select(F.col("a").alias("id"), F.col("a").alias("lead"), F.explode(
        F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("kind"))
    needed = leaders.select("id").union(members.select("id"))
    return (leaders.unionByName(members).join(_only(texts, needed), "id")
            .repartition("lead", "salt").sortWithinPartitions("lead", "salt", "kind")
            .mapInArrow(_verified, "a bigint, b bigint"))


def link(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` and ``kept`` of every row.

    Repeated rows are one document and all returned.  Rows that share an id but
    not the text count with the text of the smallest set digest for their links.
    A text without words is linked with nothing.  A row without an id has no
    component and is kept.  Other columns may have any name.
    """
    spark = docs.sparkSession
    workspace = Workspace(spark, "near-dedup")
    fit_batches(docs)
    source = docs.select(F.col(f"`{doc_id}`").cast("bigint").alias("id"),
                         F.col(f"`{text}`").alias("text"))
    sketches = workspace.save(map_texts(source, "text", ("id",), SKETCH, sketch)
                              .select("id", "_out.*"), "sketches")
    digest = ["d1", "d2", "n"]
    linkable = sketches.where("id IS NOT NULL AND n > 0")
    several = (linkable.select("id", *digest).groupBy("id")
               .agg(F.min(F.struct(*digest)).alias("low"), F.max(F.struct(*digest)).alias("high"))
               .where("low <> high").select("id", "low.*"))
    if several.isEmpty():
        chosen = linkable
    else:
        several = workspace.save(several, "several")
        chosen = (linkable.join(several.select("id"), "id", "left_anti")
                  .unionByName(linkable.join(several, ["id", *digest], "left_semi")))
    classes = workspace.save(chosen.groupBy(*digest).agg(
        F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = workspace.save(
        chosen.join(classes.select(F.col("rep").alias("id"), *digest), ["id", *digest])
        .select(F.col("id").alias("rep"), "n", "registers").dropDuplicates(["rep"]), "reps")
    bands = reps.select("rep", "registers").mapInArrow(_band_rows, "key bigint, rep bigint")
    buckets = workspace.save(bands.groupBy("key").agg(
        F.min("rep").alias("lead"), F.count(F.lit(1)).alias("members")).where("members > 1"),
        "buckets")
    rows = reps.count()
    members = join_unique(bands, buckets, ["key"], "members", rows * BANDS)

    texts = source.where("id IS NOT NULL")
    if not several.isEmpty():
        texts = _own_texts(texts, several, digest)
    pairs = workspace.save(members.where("rep <> lead").select(
        F.col("lead").alias("a"), F.col("rep").alias("b")).distinct(), "pairs")
    x = reps.select(F.col("rep").alias("a"), "n", F.col("registers").alias("x"))
    y = reps.select(F.col("rep").alias("b"), F.col("n").alias("m"), F.col("registers").alias("y"))
    x = x.join(pairs.groupBy("a").agg(F.count(F.lit(1)).alias("members")), "a")
    stars = workspace.save(join_unique(pairs, x, ["a"], "members", pairs.count()).join(y, "b")
                           .select("a", "b", "n", "x", "m", "y").mapInArrow(_estimated, "a bigint, b bigint"), "stars")
    links = workspace.save(verify(stars, texts).distinct(), "star-links")
    labels = components(workspace, links, "star-labels")

    crossing = workspace.save(_crossing(pairs, reps, labels), "crossing")
    more = workspace.save(_crossing_links(crossing, texts).distinct(), "cross-links")
    if not more.isEmpty():
        labels = components(workspace, links.union(more), "all-labels")

    found = classes.join(labels.toDF("rep", "component_id"), "rep", "left").select(
        *digest, "copies", F.coalesce("component_id", "rep").alias("component_id"))
    placed = _placed(sketches, linkable, several, found, digest, workspace)
    return placed.select(
        F.col("id").alias(doc_id), F.col("n").alias("n_shingles"), "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def deduplicate(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that ``link`` keeps, one row per id; rows without an id stay.

    Ids to drop are broadcast up to ``BROADCAST_IDS`` of them, and joined by a shuffle
    beyond.  Of rows that share a kept id the one stays whose text counted for its links, of equal
    ones that with the smallest text and hash of the row.
    """
    workspace = Workspace(docs.sparkSession, "near-dedup")
    linked = workspace.save(link(docs, doc_id, text).select(doc_id, "kept"), "linked")
    drop = broadcast_up_to(linked.where("NOT kept").select(doc_id), BROADCAST_IDS)
    kept = docs.join(drop, doc_id, "left_anti")
    repeated = workspace.save(linked.where(F.col("kept") & F.col(doc_id).isNotNull())
                              .groupBy(doc_id).count().where("count > 1").select(doc_id), "repeated")
    if repeated.isEmpty():
        return kept
    again = kept.join(repeated, doc_id, "left_semi").select(*docs.columns)
    judged = map_texts(whole_rows(again, text), "text", ("row", "text"), SKETCH, sketch)
    first = F.struct(F.col("_out.n") == 0, "_out.d1", "_out.d2", "_out.n", "text",
                     F.xxhash64(F.to_json("row")))
    once = (judged.groupBy(F.col("row").getField(doc_id)).agg(F.min_by("row", first).alias("row"))
            .select("row.*"))
    return kept.join(repeated, doc_id, "left_anti").select(*docs.columns).unionByName(once)


def _own_texts(texts: DataFrame, several: DataFrame, digest: list[str]) -> DataFrame:
    """For ids with several texts, only the one whose digest counts."""
    other = texts.join(several.select("id"), "id", "left_anti")
    own = (map_texts(texts.join(several.select("id"), "id", "left_semi"), "text", ("id", "text"),
                     SKETCH, sketch).select("id", "text", "_out.*")
           .join(several, ["id", *digest], "left_semi").select("id", "text"))
    return other.unionByName(own)


def _crossing(pairs: DataFrame, reps: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts that share a leader, and so perhaps a bucket, with one in another component.

    The texts of a leader are dealt into blocks of about ``BLOCK`` shingles, and every
    pair of blocks is one unit of work.
    """
    group = (pairs.join(reps.select(F.col("rep").alias("b"), "n"), "b")
             .join(labels.toDF("b", "label"), "b", "left")
             .select(F.col("a").alias("lead"), F.col("b").alias("id"), "n",
                     F.coalesce("label", "b").alias("component")))
    mixed = (group.groupBy("lead").agg(
        F.min("component").alias("least"), F.max("component").alias("most"),
        F.ceil(F.sum("n") / BLOCK).cast("int").alias("blocks"), F.count(F.lit(1)).alias("members"))
        .where("least <> most").select("lead", "blocks", "members"))
    return (join_unique(group, mixed, ["lead"], "members", pairs.count())
            .withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .withColumn("low", F.least("block", "other"))
            .withColumn("high", F.greatest("block", "other"))
            .select("lead", "low", "high", "block", "id", "component"))


def _crossing_links(crossing: DataFrame, texts: DataFrame) -> DataFrame:
    """Links across components inside the blocks and pairs of blocks of each leader."""
    return (crossing.join(_only(texts, crossing.select("id")), "id")
            .select("lead", "low", "high", "block", "id", "component", "text")
            .repartition("lead", "low", "high").sortWithinPartitions("lead", "low", "high")
            .mapInArrow(_cross_links, "a bigint, b bigint"))


def _placed(sketches, linkable, several, found, digest, workspace) -> DataFrame:
    """Component of every row, by the class of its set."""
    found = workspace.save(found, "found")
    rows = sketches.count()
    main = linkable.select("id", *digest)
    alone = sketches.where("id IS NULL OR n = 0").select("id", "n", F.col("id").alias("component_id"))
    if several.isEmpty():
        placed = join_unique(main, found, digest, "copies", rows)
    else:
        chosen = (several.join(found, digest).select("id", "component_id"))
        placed = join_unique(main.join(several.select("id"), "id", "left_anti"),
                             found, digest, "copies", rows).select("id", "n", "component_id")
        placed = placed.unionByName(main.join(chosen, "id").select("id", "n", "component_id"))
    return placed.select("id", "n", "component_id").unionByName(alone)
