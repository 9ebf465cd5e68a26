"""Helpers shared by the operators: staged tables, label joins, Arrow text buffers.

Staged tables are Parquet files under the session's ``spark.checkpoint.dir`` (a
folder that the driver and all executors share). A job that loses an executor
re-reads them instead of recomputing what produced them.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.session import checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One input table of a data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a write that runs inside are deleted when it ends, not when the driver's next garbage collection finds them."""
    before = spark.conf.get(_FREE_SHUFFLES)
    spark.conf.set(_FREE_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREE_SHUFFLES, before)


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, computed once; its shuffle files go with the write."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/llm/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
    with _shuffles_freed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, in a session that passes at most BATCH_ROWS rows at once to Python tasks.

    Spark's default of 10,000 rows suits numbers; of whole texts that is tens of MB a batch, held
    by the JVM and by Python, in each task. A smaller setting of the session is kept.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH)) <= BATCH_ROWS:
        conf.set(_BATCH, str(BATCH_ROWS))
    return df


def freed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run``, which hands the memory that it freed back to the system when its task ends.

    Spark keeps Python workers from stage to stage; what their allocators hold on to would add up.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            pa.system_memory_pool().release_unused()  # the C allocator: NumPy's arrays

    return task


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared folder (for small tables inside iterations)."""
    checkpoint_dir(df.sparkSession)  # registers a folder when the session has none (tests)
    return df.checkpoint()


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Column names that ``df`` doesn't have, made from the given ones (names compare without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n += "_"
        taken.add(n.lower())
        out.append(n)
    return out


def text_digest(text_col: str) -> Column:
    """SHA-256 of the text; null counts as empty."""
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"), 256)


def in_fold(key: str, n: int, fold: int) -> Column:
    """Whether crc32 of the key as text, modulo ``n``, is ``fold``: the folds of the query contracts. A null key is in none."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(n)) == fold, F.lit(False))


def hash_sample(df: DataFrame, key: Column, rows: int, total: int, seed: str = "sample") -> DataFrame:
    """About ``rows`` of the ``total`` rows, chosen by a hash of the key (all rows when total <= rows)."""
    if total <= rows:
        return df
    cut_at = int(rows / total * (1 << 62))
    return df.where(F.shiftrightunsigned(F.xxhash64(F.lit(seed), key), 2) < F.lit(cut_at))


def utf8(batch: pa.RecordBatch, name: str) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a text column; null counts as empty."""
    col = pc.fill_null(batch.column(name).cast(pa.large_binary()), b"")
    if len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int, raw: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Cut texts into work of at most about ``limit`` bytes: (row, begin, end) arrays.

    Short texts travel together; a text above the limit is cut into several
    pieces, so the memory of a task does not depend on the longest text; with ``raw``
    the cuts are after the last white space of a piece, else after the next one, so they cut no word. A piece of a
    cut text travels alone.
    """
    rows: list[int] = []
    begins: list[int] = []
    ends: list[int] = []
    size = 0
    for r in range(len(offsets) - 1):
        a, b = int(offsets[r]), int(offsets[r + 1])
        while True:
            take = min(b - a, limit)
            if raw is not None and take < b - a:
                spaces = np.flatnonzero(raw[a:a + take] <= 32)
                ahead = () if len(spaces) else np.flatnonzero(raw[a + take:b] <= 32)
                take = int(spaces[-1]) + 1 if len(spaces) else take + int(ahead[0]) + 1 if len(ahead) else b - a
            cut_text = offsets[r + 1] - offsets[r] > limit
            if rows and (size + take > limit or cut_text):
                yield np.array(rows), np.array(begins), np.array(ends)
                rows, begins, ends, size = [], [], [], 0
            rows.append(r)
            begins.append(a)
            ends.append(a + take)
            size += limit + 1 if cut_text else take
            a += take
            if a >= b:
                break
    if rows:
        yield np.array(rows), np.array(begins), np.array(ends)


def sorted_unique(keys: np.ndarray) -> np.ndarray:
    """Distinct integers in order (np.unique without counts hashes, which is far slower)."""
    keys = np.sort(keys)
    return keys[np.concatenate([[True], keys[1:] != keys[:-1]])] if len(keys) else keys


def arrow_out(schema: pa.Schema, columns: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type) if not isinstance(columns[f.name], pa.Array)
                                       else columns[f.name].cast(f.type) for f in schema], schema=schema)
