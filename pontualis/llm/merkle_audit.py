"""Merkle fixity audit of WARC archives and their replicas.

Pages become gzip members of ``.warc.gz`` files, which tasks write to the shared folder through
``pyarrow.fs`` (a file gets its name when it is complete, so a repeated task does no harm),
beside an index of their byte ranges.  A replica is a copy of the files.  An audit reads
the ranges of the index back from both.  The leaf of a record hashes its offset,
its length and the digest of the bytes found there; a node hashes up to ``FANOUT`` leaves or
nodes in offset order, and covers their range of offsets; the root of a file is its
last node.  An audit compares the roots of two replicas and then, level by level,
only the children of nodes that differ, down to the damaged records.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pontualis.llm.batches import fit_batches
from pontualis.llm.tables import Workspace
from pontualis.llm.words import slices

FANOUT = 16
# Page ids with this remainder are lost in the replica, or have one byte changed there.
LOST = (1999, 3)
DAMAGED = (499, 7)
# A file ends with the record that brings it to this many bytes.
FILE_BYTES = 32 << 20

INDEX = "file string, seq bigint, page_id bigint, offset bigint, length bigint, sha256 string"
ARCHIVE = ("file string, seq bigint, page_id bigint, offset bigint, length bigint, "
           "sha256 string, record binary")


def warc_record(page_id: int | None, url: str, html: str) -> bytes:
    """One gzip member with a WARC/1.1 resource record."""
    body = html.encode()
    digest = hashlib.sha256(body).hexdigest()
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id} {url} {digest}")
    uri = url.replace("\r", "%0D").replace("\n", "%0A")
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:uuid:{name}>\r\n"
            f"WARC-Date: 1970-01-01T00:00:00Z\r\nWARC-Target-URI: {uri}\r\n"
            f"WARC-Payload-Digest: sha256:{digest}\r\nContent-Type: text/html\r\n"
            f"Content-Length: {len(body)}\r\n\r\n").encode()
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head + body + b"\r\n\r\n") + packer.flush()


def archive(pages: DataFrame, page_id: str = "page_id", url: str = "url",
            html: str = "html") -> DataFrame:
    """Records of all pages, in files that follow the partitions of the table.

    One record per row, repeated rows included.  A NULL url or html is empty, a NULL id is
    kept; other columns may have any name.  Nothing is shuffled, and a repeated task
    makes the same files.
    """
    fit_batches(pages)
    source = pages.select(
        F.col(f"`{page_id}`").cast("bigint").alias("id"),
        F.coalesce(F.col(f"`{url}`").cast("string"), F.lit("")).alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("t"))

    def run(batches):
        part, number, seq, offset = TaskContext.get().partitionId(), 0, 0, 0
        for batch in batches:
            for piece in slices(batch, "t"):
                rows = []
                for row in piece.to_pylist():
                    record = warc_record(row["id"], row["url"], row["t"])
                    rows.append((f"{part:06d}-{number:05d}.warc.gz", seq, row["id"], offset,
                                 len(record), hashlib.sha256(record).hexdigest(), record))
                    seq, offset = seq + 1, offset + len(record)
                    if offset >= FILE_BYTES:
                        number, seq, offset = number + 1, 0, 0
                kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(),
                         pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(zip(*rows), kinds)],
                    ["file", "seq", "page_id", "offset", "length", "sha256", "record"])

    return source.mapInArrow(run, ARCHIVE)


def _opened(root: str) -> tuple[fs.FileSystem, str]:
    """The file system of a folder, which every executor reaches, and the path in it."""
    system, path = fs.FileSystem.from_uri(root)
    return system, path.rstrip("/")


class _Writer:
    """Writes one file at a time under a name of this attempt, and renames it when it is complete."""

    def __init__(self, root: str) -> None:
        self.system, self.root = _opened(root)
        self.system.create_dir(self.root, recursive=True)
        self.name, self.stream = None, None

    def write(self, name: str, data: bytes) -> None:
        if name != self.name:
            self.close()
            self.name = name
            self.temporary = f"{self.root}/{name}.{uuid.uuid4().hex}.tmp"
            self.stream = self.system.open_output_stream(self.temporary)
        self.stream.write(data)

    def close(self) -> None:
        if self.stream:
            self.stream.close()
            self.system.move(self.temporary, f"{self.root}/{self.name}")
            self.stream = None


def write_files(records: DataFrame, root: str, workspace: Workspace, name: str) -> DataFrame:
    """Write the records of ``archive`` as files below ``root``; returns their index."""
    def run(batches):
        writer = _Writer(root)
        for batch in batches:
            for file, record in zip(batch.column("file").to_pylist(), batch.column("record")):
                writer.write(file, record.as_buffer())
            yield batch.drop_columns(["record"])
        writer.close()

    return workspace.save(records.mapInArrow(run, INDEX), name)


def _in_files(index: DataFrame, columns: str, work) -> DataFrame:
    """``work`` over the rows of the index, those of one file in one task and in their order."""
    return (index.repartition("file").sortWithinPartitions("file", "offset").select(
        "file", "seq", "page_id", "offset", "length").mapInArrow(work, columns))


def _ranges(batches, root: str):
    """Rows of the index with the bytes that a store holds at their ranges; a missing file has none."""
    system, folder = _opened(root)
    name, stream = None, None
    for batch in batches:
        for row in batch.to_pylist():
            if row["file"] != name:
                name = row["file"]
                found = system.get_file_info(f"{folder}/{name}")
                stream = system.open_input_file(found.path) if found.is_file else None
            size = stream.size() if stream else 0
            here = max(0, min(row["length"], size - row["offset"]))
            yield row, stream.read_at(here, row["offset"]) if here else b""


def copy_files(index: DataFrame, root: str, target: str, workspace: Workspace, name: str) -> DataFrame:
    """Copy the files below ``root`` with known faults; returns ``file`` and ``bytes`` of the copies.

    One byte of some records is changed.  Others are lost like a block that was never written: zeros
    stand in their place, and at the end of a file nothing.
    """
    def run(batches):
        writer, held, out = _Writer(target), (None, 0), {}
        for row, record in _ranges(batches, root):
            if row["file"] != held[0]:
                held = row["file"], 0
                writer.write(row["file"], b"")
            if row["page_id"] is not None and row["page_id"] % LOST[0] == LOST[1]:
                continue
            if row["page_id"] is not None and row["page_id"] % DAMAGED[0] == DAMAGED[1]:
                middle = len(record) // 2
                record = record[:middle] + bytes([record[middle] ^ 1]) + record[middle + 1:]
            writer.write(row["file"], bytes(row["offset"] - held[1]) + record)
            held = row["file"], row["offset"] + len(record)
            out[row["file"]] = held[1]
        writer.close()
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()), pa.array(list(out.values()), pa.int64())],
                                         ["file", "bytes"])

    return workspace.save(_in_files(index, "file string, bytes bigint", run), name)


def stored_digests(index: DataFrame, root: str, workspace: Workspace, name: str) -> DataFrame:
    """Records that a store holds, with the digest of the bytes at their ranges.

    A range beyond the end of its file, or with nothing but zeros, holds no record.
    """
    def run(batches):
        for batch in batches:
            rows = [(r["file"], r["seq"], r["offset"], r["length"], hashlib.sha256(b).hexdigest())
                    for r, b in _ranges([batch], root) if b.strip(b"\0")]
            kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(list(zip(*rows)) or [()] * 5, kinds)],
                ["file", "seq", "offset", "length", "digest"])

    columns = "file string, seq bigint, offset bigint, length bigint, digest string"
    return workspace.save(_in_files(index, columns, run), name)


def tree(replica: DataFrame, workspace: Workspace, name: str) -> list[DataFrame]:
    """Levels of the trees of all files, leaves first.

    Columns: file, idx, hash, begin and end of the offsets covered, and ``top`` for
    the root.  ``replica`` has the bytes of its records, or the digests of those a store holds now.
    """
    digest = F.sha2("record", 256) if "record" in replica.columns else F.col("digest")
    leaf = F.sha2(F.concat_ws(":", "offset", "length", digest), 256)
    levels = [workspace.save(replica.select(
        "file", F.col("seq").alias("idx"), leaf.alias("hash"), F.col("offset").alias("begin"),
        (F.col("offset") + F.col("length")).alias("end")), f"{name}-0")]
    while True:
        most = levels[-1].agg(F.max("idx")).first()[0]
        if not most:
            return levels
        children = F.array_sort(F.collect_list(F.struct("idx", "hash")))
        levels.append(workspace.save(
            levels[-1].groupBy("file", F.floor(F.col("idx") / FANOUT).alias("parent")).agg(
                F.sha2(F.array_join(F.transform(children, lambda c: F.concat_ws(
                    ":", c["idx"].cast("string"), c["hash"])), ","), 256).alias("hash"),
                F.min("begin").alias("begin"), F.max("end").alias("end"))
            .withColumnRenamed("parent", "idx"), f"{name}-{len(levels)}"))


def _differing(one: DataFrame, two: DataFrame) -> DataFrame:
    """Nodes that differ or that one side lacks."""
    a, b = one.select("file", "idx", F.col("hash").alias("ours")), two.select(
        "file", "idx", F.col("hash").alias("theirs"))
    return (a.join(b, ["file", "idx"], "full")
            .where(~F.col("ours").eqNullSafe(F.col("theirs"))))


def audit(primary: DataFrame, replica: DataFrame) -> DataFrame:
    """Records that differ: ``file``, ``seq`` and ``status``.

    The status is damaged, missing (from the replica) or extra.  Files of different
    height are compared from the lower of both heights on; two empty archives agree.
    """
    workspace = Workspace(primary.sparkSession, "merkle-audit")
    ours, theirs = tree(primary, workspace, "ours"), tree(replica, workspace, "theirs")
    top = min(len(ours), len(theirs)) - 1
    bad = workspace.save(_differing(ours[top], theirs[top]), f"differ-{top}")
    for level in range(top - 1, -1, -1):
        parents = bad.select("file", F.col("idx").alias("parent"))

        def below(nodes: DataFrame) -> DataFrame:
            return nodes.withColumn("parent", F.floor(F.col("idx") / FANOUT)).join(
                parents, ["file", "parent"], "left_semi")

        bad = workspace.save(_differing(below(ours[level]), below(theirs[level])), f"differ-{level}")
    status = (F.when(F.col("theirs").isNull(), "missing").when(F.col("ours").isNull(), "extra")
              .otherwise("damaged"))
    return bad.select("file", F.col("idx").alias("seq"), status.alias("status"))


def audited(pages: DataFrame) -> DataFrame:
    """Write the pages as files, audit a faulty copy of them, and return every record with its status."""
    workspace = Workspace(pages.sparkSession, "warc")
    primary, replica = f"{workspace.root}/primary-files", f"{workspace.root}/replica-files"
    index = write_files(archive(pages), primary, workspace, "index")
    copy_files(index, primary, replica, workspace, "copied")
    found = audit(stored_digests(index, primary, workspace, "ours"),
                  stored_digests(index, replica, workspace, "theirs"))
    return (index.join(found, ["file", "seq"], "left")
            .withColumn("status", F.coalesce("status", F.lit("intact"))))
