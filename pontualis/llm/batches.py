"""Running a function over slices of a text column as an Arrow map."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pontualis.llm.words import SLICE_BYTES, slices

# Bytes a task sends to Python as one Arrow batch.  Long texts would make
# batches of many rows larger than a task's memory.
BATCH_BYTES = 8 << 20


_shipped: set[str] = set()


def ship_package(frame: DataFrame) -> None:
    """Send this package to the executors once per application, which need not have it."""
    context = frame.sparkSession.sparkContext
    if context.applicationId in _shipped:
        return
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="pontualis-"), "pontualis.zip")
    with zipfile.ZipFile(path, "w") as packed:
        for folder, _, names in os.walk(root):
            for name in sorted(n for n in names if n.endswith(".py")):
                full = os.path.join(folder, name)
                packed.write(full, os.path.relpath(full, os.path.dirname(root)))
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def fit_batches(frame: DataFrame) -> None:
    """Prepare a session for Arrow maps: code on the executors, and batches bounded in bytes.

    A smaller bound of the session is kept.
    """
    ship_package(frame)
    conf = frame.sparkSession.conf
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(key).lower().removesuffix("b")) > BATCH_BYTES:
        conf.set(key, str(BATCH_BYTES))


def map_texts(frame: DataFrame, text: str, keep: Sequence[str], schema: StructType | str,
              work: Callable[..., dict[str, pa.Array]], slice_bytes: int = SLICE_BYTES,
              beside: Sequence[str] = ()) -> DataFrame:
    """Columns ``keep`` and the struct ``_out`` that ``work`` makes of the text column.

    ``work`` gets the texts of a slice, and its columns ``beside``, and returns one array per
    field of ``schema``.  Kept columns travel under neutral names, so none can clash.
    """
    fit_batches(frame)
    fields = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    neutral = [f"k{i}" for i in range(len(keep))]
    extra = [f"b{i}" for i in range(len(beside))]
    source = frame.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, neutral)],
                          *[F.col(f"`{c}`").alias(n) for c, n in zip(beside, extra)],
                          F.col(f"`{text}`").cast("string").alias("t"))
    kept = StructType([f for f in source.schema if f.name in neutral])
    names = fields.names

    def run(batches):
        for batch in batches:
            for part in slices(batch, "t", slice_bytes):
                made = work(part.column("t"), *[part.column(n) for n in extra])
                out = pa.StructArray.from_arrays([made[n] for n in names], names)
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(n) for n in neutral], out], [*neutral, "_out"])

    mapped = source.mapInArrow(run, StructType([*kept]).add("_out", fields))
    return mapped.select(*[F.col(n).alias(c) for n, c in zip(neutral, keep)], "_out")


def whole_rows(frame: DataFrame, text: str) -> DataFrame:
    """All columns as the struct ``row`` beside the column ``text``, so that no name can clash."""
    columns = [F.col(f"`{c}`") for c in frame.columns]
    return frame.select(F.struct(*columns).alias("row"), F.col(f"`{text}`").alias("text"))


def with_text(frame: DataFrame, columns: Sequence[str], text: str, value: Column) -> DataFrame:
    """The original columns out of ``row``, with ``value`` in the place of the text."""
    return frame.select(*[(value if c == text else F.col("row").getField(c)).alias(c)
                          for c in columns])


def grouped(batches: Iterator[pa.RecordBatch], keys: Sequence[str],
            most: int | None = None) -> Iterator[pa.Table]:
    """Rows of batches sorted by integer keys, in runs of equal keys.

    A run may cross batches.  ``most`` cuts longer runs, so that no run, however
    many rows its key has, is held whole.
    """
    held: list[pa.RecordBatch] = []
    rows, last = 0, None

    def table() -> pa.Table:
        return pa.Table.from_batches(held).combine_chunks()

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy() for k in keys]
        change = np.zeros(batch.num_rows, bool)
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for begin, end in zip(cuts[:-1], cuts[1:]):
            now = tuple(c[begin] for c in columns)
            if held and now != last:
                yield table()
                held, rows = [], 0
            last = now
            while begin < end:
                size = end - begin if most is None else min(end - begin, most - rows)
                held.append(batch.slice(begin, size))
                begin, rows = begin + size, rows + size
                if rows == most:
                    yield table()
                    held, rows = [], 0
    if held:
        yield table()
