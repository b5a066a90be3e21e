"""Prefix trie of rebuilt conversations by composable fingerprints.

A turn has a 128-bit hash ``t``, and a sequence the fingerprint ``sum(t[j] * B ** j)`` modulo
2 ** 64 in two lanes, j from 1.  With its length this is a monoid: ``(n, x) + (m, y) =
(n + m, x + B ** n * y)``, and as B is odd a prefix can be taken off again.  A rebuilt
conversation, the head of one conversation before the rest of another, therefore gets
the fingerprints of all its prefixes from the prefix fingerprints of the two, and no rebuilt
text is ever made.  Every rebuilt turn refers to the stored turn it comes from.

A node is a depth and a fingerprint.  Its members are counted, never listed, and totals of
a subtree need no recursion: a node belongs to the smallest conversation in it, so what
lies below a node is what its members own from its depth on, a running total inside each
conversation.  Equality is verified at the end: all members of a node must come from the
same node and end in turns of the same hash, and stored turns that share a hash must be equal.
If one is not, everything is done again with other hashes.

Long conversations are cut into cells of turns; nodes and conversations with many rows are
joined by ``join_unique``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pontualis.llm.batches import fit_batches
from pontualis.llm.tables import Workspace, join_unique
from pontualis.operators.numbering import running_total_before

# The longest head a conversation takes over is one less than this; its base is the
# conversation with the next smaller multiple of ``FAMILY`` as id.
HEADS = 9
FAMILY = 5
# Turn numbers in one cell of a conversation, and ids hashed as one piece of text.
CELL_TURNS = 1024
PIECE_IDS = 4096
ROUNDS = 8

_BASES = (0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)
_INVERSES = tuple(pow(b, -1, 1 << 64) for b in _BASES)
NODE = ["depth", "f1", "f2"]


def _power(base: int, exponent: np.ndarray) -> np.ndarray:
    """``base ** exponent`` modulo 2 ** 64, by squaring over the bits of the largest exponent."""
    out = np.ones(len(exponent), np.uint64)
    factor, bits = base, exponent.astype(np.uint64)
    while bits.any():
        out[(bits & np.uint64(1)).astype(bool)] *= np.uint64(factor)
        bits >>= np.uint64(1)
        factor = factor * factor % (1 << 64)
    return out


def _unsigned(column: pa.Array) -> np.ndarray:
    return column.to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def head_length(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % HEADS


def base_of(conv: Column) -> Column:
    return conv - conv % FAMILY


def turn_hashes(role: Column, text: Column, seed: int) -> list[Column]:
    """Two 64-bit hashes of a turn; the second mixes the parts in another order."""
    return [F.xxhash64(F.lit(seed), role, F.length(role), text).alias("t1"),
            F.xxhash64(F.lit(~seed), text, F.length(text), role, F.lit("r")).alias("t2")]


def _turns(conversations: DataFrame, seed: int, hashes=turn_hashes) -> DataFrame:
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    return conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv"), F.col("turn").cast("bigint").alias("turn"),
        role.alias("role"), *hashes(role, text, seed),
        F.octet_length(text).cast("bigint").alias("bytes"))


def _cells(turns: DataFrame) -> DataFrame:
    """Position and fingerprint of every turn inside its cell, in one sorted pass."""
    def scan(batches):
        held, last = None, None  # rows and sums of the cell that the last batch ended in
        for batch in batches:
            if not batch.num_rows:
                continue
            conv, slot = _unsigned(batch.column("conv")), _unsigned(batch.column("slot"))
            new = np.ones(batch.num_rows, bool)
            new[1:] = (conv[1:] != conv[:-1]) | (slot[1:] != slot[:-1])
            new[0] = (conv[0], slot[0]) != last
            first = np.flatnonzero(new)
            start = np.zeros(batch.num_rows, np.int64)
            start[first] = first
            start = np.maximum.accumulate(start)
            place = np.arange(batch.num_rows) - start + 1
            carried = np.cumsum(new) == 0
            n, sums = held if carried[0] else (0, (np.uint64(0),) * 2)
            place[carried] += n
            out, ends = [], []
            for base, lane, before in zip(_BASES, ("t1", "t2"), sums):
                total = np.cumsum(_unsigned(batch.column(lane)) * _power(base, place))
                ahead = np.where(start > 0, total[start - 1], np.uint64(0))
                value = total - ahead
                value[carried] += before
                out.append(value)
                ends.append(value[-1])
            held, last = (int(place[-1]), tuple(ends)), (conv[-1], slot[-1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv"), batch.column("slot"), pa.array(place), *map(_signed, out),
                 batch.column("t1"), batch.column("t2"), batch.column("bytes")],
                ["conv", "slot", "place", "q1", "q2", "t1", "t2", "bytes"])

    slot = F.coalesce(F.floor(F.col("turn") / CELL_TURNS), F.lit(-(1 << 62))).cast("bigint")
    return (turns.withColumn("slot", slot).repartition("conv", "slot")
            .sortWithinPartitions("conv", "slot", F.col("turn").asc_nulls_first(), "role", "t1", "t2")
            .select("conv", "slot", "t1", "t2", "bytes").mapInArrow(scan, (
                "conv bigint, slot bigint, place bigint, q1 bigint, q2 bigint, t1 bigint, t2 bigint, "
                "bytes bigint")))


def _offsets(cells: DataFrame) -> DataFrame:
    """Turns and fingerprint before each cell but the first of a conversation."""
    last = F.max(F.struct("place", "q1", "q2")).alias("last")
    per_cell = cells.groupBy("conv", "slot").agg(last).groupBy("conv").agg(
        F.array_sort(F.collect_list(F.struct("slot", "last.place", "last.q1", "last.q2"))).alias("cells"))

    def scan(batches):
        for batch in batches:
            rows = []
            for conv, cells_ in zip(batch.column("conv").to_pylist(), batch.column("cells").to_pylist()):
                n, sums = 0, [0, 0]
                for cell in cells_:
                    if n:
                        rows.append((conv, cell["slot"], n, *sums))
                    sums = [(s + pow(b, n, 1 << 64) * cell[q]) % (1 << 64)
                            for s, b, q in zip(sums, _BASES, ("q1", "q2"))]
                    n += cell["place"]
            columns = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()),
                 pa.array(columns[2], pa.int64()),
                 *[_signed(np.array(c, np.uint64)) for c in columns[3:]]],
                ["conv", "slot", "n", "s1", "s2"])

    return per_cell.where(F.size("cells") > 1).mapInArrow(
        scan, "conv bigint, slot bigint, n bigint, s1 bigint, s2 bigint")


def _combined(frame: DataFrame, keep: Sequence[str], ahead: Sequence[str], off: Sequence[str],
              own: Sequence[str], place: str) -> DataFrame:
    """Fingerprints of ``ahead`` followed by ``own`` less its prefix ``off``.

    ``ahead`` and ``off`` name a length and two lanes each.  The result has ``keep``, and the new
    length and lanes under the names of ``place`` and ``own``.
    """
    names = [*keep, place, *own]
    schema = ", ".join(f"{c} bigint" for c in names)

    def work(batches):
        for batch in batches:
            n, m = (batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64)
                    for c in (ahead[0], off[0]))
            lanes = []
            for k, (base, inverse) in enumerate(zip(_BASES, _INVERSES)):
                rest = _unsigned(batch.column(own[k])) - _unsigned(batch.column(off[1 + k]))
                shift = np.where(n >= m, _power(base, np.maximum(n - m, 0)),
                                 _power(inverse, np.maximum(m - n, 0)))
                lanes.append(_unsigned(batch.column(ahead[1 + k])) + shift * rest)
            length = batch.column(place).to_numpy(zero_copy_only=False) + n - m
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in keep], pa.array(length), *map(_signed, lanes)], names)

    used = list(dict.fromkeys([*keep, *ahead, *off, *own, place]))
    return frame.select(*used).mapInArrow(work, schema)


def prefixes(turns: DataFrame, workspace: Workspace) -> DataFrame:
    """``conv``, ``pos``, the fingerprint ``p1``, ``p2`` up to there, and the turn itself."""
    cells = workspace.save(_cells(turns), "cells")
    zero = F.lit(0).cast("bigint")
    placed = cells.join(_offsets(cells), ["conv", "slot"], "left").select(
        "conv", "t1", "t2", "bytes", "place", "q1", "q2",
        *[F.coalesce(c, zero).alias(c) for c in ("n", "s1", "s2")],
        *[zero.alias(c) for c in ("z", "z1", "z2")])
    made = _combined(placed, ["conv", "t1", "t2", "bytes"], ["n", "s1", "s2"], ["z", "z1", "z2"],
                     ["q1", "q2"], "place")
    return workspace.save(made.withColumnsRenamed({"place": "pos", "q1": "p1", "q2": "p2"}), "prefixes")


def rebuilt(stored: DataFrame, workspace: Workspace) -> DataFrame:
    """One row per turn of every rebuilt conversation, and one of depth 0 before them.

    ``depth``, ``f1`` and ``f2`` name the node, ``t1``, ``t2`` and ``bytes`` describe its last turn,
    ``size`` is the length of the rebuilt conversation.
    """
    zero = F.lit(0).cast("bigint")
    early = F.when(F.col("pos") < HEADS, F.struct("pos", "p1", "p2", "t1", "t2", "bytes"))
    convs = stored.groupBy("conv").agg(F.max("pos").alias("n"),
                                       F.array_sort(F.collect_list(early)).alias("heads"))
    h = head_length(F.col("conv"))
    base = convs.select(F.col("conv").alias("base"), F.col("heads").alias("taken"))
    joined = (convs.withColumn("base", base_of(F.col("conv"))).join(base, "base", "left")
              .withColumn("taken", F.coalesce(F.slice("taken", F.lit(1), h.cast("int")),
                                              F.expr("slice(heads, 1, 0)")))
              .withColumn("k", F.size("taken").cast("bigint")).withColumn("h", h)
              .withColumn("size", F.col("k") + F.greatest(F.col("n") - h, zero)))
    at = lambda array, k, lane: F.coalesce(F.get(array, (k - 1).cast("int"))[lane], zero)
    joined = joined.select(
        "conv", "n", "h", "k", "size", "taken",
        *[at(F.col("taken"), F.col("k"), p).alias(f"a{p[1]}") for p in ("p1", "p2")],
        *[at(F.col("heads"), F.col("h"), p).alias(f"o{p[1]}") for p in ("p1", "p2")])
    joined = workspace.save(joined, "conversations")
    keep = ["conv", "size", "t1", "t2", "bytes"]
    heads = joined.select("conv", "size", F.inline("taken")).select(
        *keep, F.col("pos").alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"))
    rest = stored.where(F.col("pos") > head_length(F.col("conv")))
    total = stored.count()
    own = join_unique(rest, joined.drop("taken"), ["conv"], "n", total)
    own = _combined(own, keep, ["k", "a1", "a2"], ["h", "o1", "o2"], ["p1", "p2"], "pos")
    own = own.withColumnsRenamed({"pos": "depth", "p1": "f1", "p2": "f2"})
    roots = joined.select("conv", "size", *[zero.alias(c) for c in ("t1", "t2", "bytes", *NODE)])
    return heads.unionByName(own).unionByName(roots)


def _with_parents(members: DataFrame) -> DataFrame:
    """``u1``, ``u2``: the fingerprint without the last turn, whose hash is taken off again."""
    names = [*members.columns, "u1", "u2"]

    def work(batches):
        for batch in batches:
            depth = batch.column("depth").to_numpy(zero_copy_only=False).astype(np.int64)
            lanes = [_unsigned(batch.column(f)) - _power(base, depth) * _unsigned(batch.column(t))
                     for base, f, t in zip(_BASES, ("f1", "f2"), ("t1", "t2"))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *map(_signed, lanes)], names)

    return members.mapInArrow(work, ", ".join(f"{c} bigint" for c in names))


def _ends(members: DataFrame, workspace: Workspace) -> DataFrame:
    """Per node in which a member ends: SHA-256 of their ids in ascending order.

    Ids are ranged over all tasks by node and id, joined to pieces of at most
    ``PIECE_IDS`` there, and one task a node hashes the pieces in order, one after another.
    """
    ends = members.where("depth = size").select(*NODE, "conv")

    def pieces(batches):
        key, held = None, []

        def piece():
            return pa.RecordBatch.from_pylist(
                [dict(zip(NODE, key), first=held[0], ids=",".join(map(str, held)))], pa.schema(
                    [(c, pa.int64()) for c in (*NODE, "first")] + [("ids", pa.string())]))

        for batch in batches:
            for *node, conv in zip(*[batch.column(c).to_pylist() for c in (*NODE, "conv")]):
                if held and (tuple(node) != key or len(held) == PIECE_IDS):
                    yield piece()
                    held = []
                key = tuple(node)
                held.append(conv)
        if held:
            yield piece()

    def digests(batches):
        schema = pa.schema([(c, pa.int64()) for c in NODE] + [("ends_sha256", pa.string())])
        key, digest = None, None
        for batch in batches:
            out = []
            for *node, ids in zip(*[batch.column(c).to_pylist() for c in (*NODE, "ids")]):
                if tuple(node) == key:
                    digest.update(b",")
                else:
                    if digest:
                        out.append(dict(zip(NODE, key), ends_sha256=digest.hexdigest()))
                    key, digest = tuple(node), hashlib.sha256()
                digest.update(ids.encode())
            yield pa.RecordBatch.from_pylist(out, schema)
        if digest:
            yield pa.RecordBatch.from_pylist(
                [dict(zip(NODE, key), ends_sha256=digest.hexdigest())], schema)

    fields = ", ".join(f"{c} bigint" for c in NODE)
    cut = (ends.repartitionByRange("f1", "f2", "depth", "conv").sortWithinPartitions("f1", "f2", "depth", "conv")
           .mapInArrow(pieces, f"{fields}, first bigint, ids string"))
    cut = workspace.save(cut, "pieces")
    return (cut.repartition(*NODE).sortWithinPartitions(*NODE, "first").select(*NODE, "ids")
            .mapInArrow(digests, f"{fields}, ends_sha256 string"))


def _unequal(nodes: DataFrame, members: DataFrame, conversations: DataFrame, seed: int, hashes) -> bool:
    """True when a node holds different sequences, which its fingerprint does not show.

    By induction over depth: its members must come from one node, their last turns must have
    one hash, and all stored turns of a hash that several have must be the same.
    """
    mixed = nodes.where("u1 <> v1 OR u2 <> v2 OR t1 <> w1 OR t2 <> w2")
    if mixed.limit(1).count():
        return True
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in ("role", "text"))
    turns = conversations.where("conv_id IS NOT NULL").select(
        *hashes(role, text, seed), F.struct(role.alias("role"), text.alias("text")).alias("turn"))
    counted = members.groupBy("t1", "t2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = join_unique(turns, counted, ["t1", "t2"], "n", max(1, members.count()))
    differing = again.groupBy("t1", "t2").agg(F.min("turn").alias("low"), F.max("turn").alias("high"))
    return differing.where("low <> high").limit(1).count() > 0


def prefix_trie(conversations: DataFrame, hashes=turn_hashes) -> DataFrame:
    """One row per node of the trie of all rebuilt conversations.

    Turns are ordered by ``turn``, NULL first; among equal numbers by role, then by the hash of the
    turn.  Repeated rows are turns of their own.  Rows without a ``conv_id`` belong to no
    conversation.  An empty table has no nodes.  Other columns may have any name.
    """
    fit_batches(conversations)
    for seed in range(ROUNDS):
        workspace = Workspace(conversations.sparkSession, "trie")
        stored = prefixes(_turns(conversations, seed, hashes), workspace)
        members = workspace.save(_with_parents(rebuilt(stored, workspace)), "members")
        low_high = [(("u1", "u2"), ("v1", "v2")), (("t1", "t2"), ("w1", "w2"))]
        nodes = members.groupBy(*NODE).agg(
            F.count(F.lit(1)).alias("n_convs"), F.min("conv").alias("conv_id"),
            F.max("bytes").alias("bytes"),
            *[F.min(a).alias(a) for lows, _ in low_high for a in lows],
            *[F.max(a).alias(b) for lows, highs in low_high for a, b in zip(lows, highs)])
        nodes = workspace.save(nodes, "nodes")
        if not _unequal(nodes, stored, conversations, seed, hashes):
            return _described(nodes, members, workspace)
    raise RuntimeError(f"no hashes out of {ROUNDS} tell all turns apart")


def _described(nodes: DataFrame, members: DataFrame, workspace: Workspace) -> DataFrame:
    zero, up = F.lit(0).cast("bigint"), ["p_depth", "u1", "u2"]
    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("u1").alias("f1"),
                                                F.col("u2").alias("f2")).agg(
        F.count(F.lit(1)).alias("n_children"))
    nodes = (nodes.join(children, NODE, "left")
             .select(*NODE, "u1", "u2", "conv_id", "n_convs", "bytes",
                     F.coalesce("n_children", zero).alias("n_children")))
    nodes = workspace.save(nodes, "counted")
    # Below a node that one conversation alone is in, nothing is shared and one leaf lies.
    shared = nodes.where("n_convs > 1")
    rows = members.select(*NODE, "conv", "size")
    total = members.count()
    inside = join_unique(rows, shared.select(*NODE, "conv_id", "n_convs", "bytes"), NODE, "n_convs", total)
    inside = workspace.save(inside, "inside")
    owned = F.col("conv") == F.col("conv_id")
    weighted = inside.select(
        *NODE, "conv", F.when(owned, (F.col("n_convs") - 1) * F.col("bytes")).otherwise(zero).alias("own"))
    deeper = running_total_before(weighted, ["conv"], F.floor(-F.col("depth") / CELL_TURNS).cast("bigint"),
                                  [F.desc("depth")], F.col("own"), "deeper")
    saved = deeper.groupBy(*NODE).agg(F.sum(F.col("own") + F.col("deeper")).alias("saved_tokens"))
    # The leaves: childless nodes, each counted for every node that its owner is in.
    leaves = nodes.where("n_children = 0").select(F.col("conv_id").alias("conv"), F.col("depth").alias("size"),
                                                    (F.col("depth") + 1).alias("_rows"))
    leafy = (join_unique(inside.select(*NODE, "conv", "size"), leaves, ["conv", "size"], "_rows", total)
             .groupBy(*NODE).agg(F.count(F.lit(1)).alias("n_leaves")))
    totals = saved.join(leafy, NODE, "left")
    ends = _ends(members, workspace)
    parents = nodes.where("n_children > 0").select(
        F.col("depth").alias("p_depth"), F.col("f1").alias("u1"), F.col("f2").alias("u2"),
        F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("_children"))
    below = nodes.where("depth > 0").withColumn("p_depth", F.col("depth") - 1)
    below = join_unique(below, parents, up, "_children", max(1, nodes.count())).drop("p_depth", "_children")
    top = nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint"))
    every = below.select(*top.columns).unionByName(top)
    return (every.join(totals, NODE, "left").join(ends, NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children",
        F.coalesce("n_leaves", F.lit(1).cast("bigint")).alias("n_leaves"),
        F.coalesce("saved_tokens", zero).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256")))
