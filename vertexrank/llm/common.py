"""Helpers shared by the operators of this package: reading tables, cutting
lineage, size-checked joins and bounded slices of Arrow batches."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType, _parse_datatype_string

# A join side is broadcast only if its counted rows times its row width stay below this.
BROADCAST_MAX_BYTES = 16 * 1024 * 1024
# Text handled at once inside a task; a single longer text is handled alone.
SLICE_BYTES = 1024 * 1024


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder of ``spark.checkpoint.dir``; where it is unset, a folder
    under the session's warehouse."""
    sc = spark.sparkContext
    if sc._jsc.sc().getCheckpointDir().isDefined():
        return
    folder = spark.conf.get("spark.checkpoint.dir", None) or (
        spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_checkpoints"
    )
    sc.setCheckpointDir(folder)


_SCOPES: list[list[str]] = []


def _drop(spark: SparkSession, paths: list[str]) -> None:
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for path in paths:
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(conf).delete(p, True)


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``cut`` writes inside are removed at the end, but for those
    passed to ``final``."""
    _SCOPES.append([])
    try:
        yield
    finally:
        _drop(spark, _SCOPES.pop())


@contextmanager
def released(*frames: DataFrame):
    """Unpersist cached frames at the end."""
    try:
        yield
    finally:
        for df in frames:
            df.unpersist()


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared checkpoint folder, removed when the application ends."""
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext._jsc.sc().getCheckpointDir().get()}/{name}-{uuid.uuid4().hex}"
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(p)
    return path


def scoped_folder(spark: SparkSession, name: str) -> str:
    """``scratch_folder``, removed with the innermost ``scratch``."""
    path = scratch_folder(spark, name)
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


def cut(df: DataFrame) -> DataFrame:
    """Compute ``df`` once, into a Parquet table in the shared checkpoint folder,
    and continue from that table: lineage ends there, a lost executor costs a
    re-read, and later plans see its true size (a checkpointed plan keeps the
    estimates it was made from, which multiply with every round of joins)."""
    spark = df.sparkSession
    path = scoped_folder(spark, "table")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def final(df: DataFrame) -> DataFrame:
    """``cut`` for a result that outlives the innermost ``scratch``."""
    scope = _SCOPES.pop() if _SCOPES else None
    try:
        return cut(df)
    finally:
        if scope is not None:
            _SCOPES.append(scope)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def join_checked(big: DataFrame, small: DataFrame, on, how: str, row_bytes: int) -> DataFrame:
    """Equi-join; ``small`` (already materialised, ``row_bytes`` wide) is
    broadcast only if its counted size is under ``BROADCAST_MAX_BYTES``, else
    both sides are shuffled (adaptive execution then splits skewed keys)."""
    if small.count() * row_bytes <= BROADCAST_MAX_BYTES:
        return big.join(F.broadcast(small), on, how)
    return big.join(small.hint("merge"), on, how)


def join_text(rows: DataFrame, found: DataFrame, how: str, row_bytes: int) -> DataFrame:
    """``join_checked`` of ``rows`` (with ``doc_id, text``) with what was found per
    ``doc_id`` and ``th``, the hash of the text: rows that share an id but not the
    text are told apart, and a null ``doc_id`` is a value like any other."""
    found = found.withColumnsRenamed({"doc_id": "__doc_id", "th": "__th"})
    here = F.col("doc_id").eqNullSafe(F.col("__doc_id")) & (F.xxhash64("text") == F.col("__th"))
    return join_checked(rows, found, here, how, row_bytes).drop("__doc_id", "__th")


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if len(column) == 0 or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Consecutive slices of ``batch`` with at most ``limit`` bytes of text each
    (at least one row)."""
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    end = np.cumsum(size.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        base = end[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(end, base + limit, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def pack(docs: DataFrame, own: Sequence[str]) -> DataFrame:
    """The columns ``own``, with all others in one struct out of the way of names
    an operator uses."""
    extra = [c for c in docs.columns if c not in own]
    return docs.select(*own, F.struct(*[F.col(f"`{c}`") for c in extra], F.lit(0).alias("__none")).alias("__extra"))


def unpack(packed: DataFrame, columns: Sequence[str]) -> list[Column]:
    """Expressions that give ``columns`` back from a packed frame."""
    return [(F.col(c) if c in packed.columns else F.col("__extra").getField(c)).alias(c) for c in columns]


def arrow_map(
    df: DataFrame, text: str, make: Callable[[pa.RecordBatch], dict], schema: str | StructType, limit: int = SLICE_BYTES
) -> DataFrame:
    """``make(slice)`` returns the output columns for each bounded slice."""
    target = to_arrow_schema(_parse_datatype_string(schema) if isinstance(schema, str) else schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch, text, limit):
                out = make(part)
                yield pa.RecordBatch.from_arrays(
                    [out[f.name] if isinstance(out[f.name], pa.Array) else pa.array(out[f.name], f.type) for f in target],
                    schema=target,
                )

    return df.mapInArrow(run, schema)


def list_of(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    """Arrow list column from flat values and offsets (n + 1)."""
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32), pa.int32()), pa.array(values, kind))
