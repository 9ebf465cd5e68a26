"""Keyed upsert (last write wins) and the progress cursor.

Plain Parquet has no MERGE, so an upsert is: rows of the touched storage
partitions + the incoming rows, one row per key by ingest order (latest
wins), written back with dynamic partition overwrite. A partition is touched when it
holds a key of the batch; no other is read or rewritten.

Which partitions hold a key is known to the table's key index (``KeyIndex``), so the cost of a batch follows
the batch and the partitions it touches, not the history: stored rows are never searched for keys.

An overwrite writes all new files aside and puts them in place when the job commits, so it may read the
partitions it replaces, and nothing needs a checkpoint.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from govlake.operators.latest import first_per_key
from govlake.session import delete_path, path_exists

INGEST_COL = "__ingest_order"
SLOTS = 16  # folders of a key index; more for larger tables: one folder's part of a batch is joined by one task at least


def upsert_frames(existing: DataFrame, incoming: DataFrame, keys: list[str],
                  incoming_order: int | str = 1) -> DataFrame:
    """Union + latest per key. ``incoming_order`` ranks this batch after the stored rows.

    ``incoming`` may carry its own ``__ingest_order`` column (rows within one
    batch ranked by arrival); otherwise every incoming row gets ``incoming_order``.
    """
    cols = existing.columns
    old = existing.withColumn(INGEST_COL, F.lit(0).cast("bigint"))
    new = incoming if INGEST_COL in incoming.columns else incoming.withColumn(
        INGEST_COL, F.lit(incoming_order).cast("bigint"))
    both = old.unionByName(new.select(*cols, INGEST_COL))
    return first_per_key(both, keys, [F.col(INGEST_COL).desc()]).select(*cols)


class KeyIndex:
    """Where the keys of a stored table are: a Parquet table beside it, (key_hash, partition columns), dealt to ``slots`` folders by the hash.

    A batch reads only the folders that its keys hash to, and of them only the 64-bit hashes that the join
    keeps. Entries are only added, and added before the rows they tell of are written: after a crash the index may name a
    partition that doesn't hold the key, which makes a merge read a partition too many, but never misses one.
    """

    def __init__(self, spark: SparkSession, table: str, keys: list[str], pcols: list[str], slots: int):
        self.spark, self.table, self.keys, self.pcols, self.slots = spark, table, keys, pcols, slots
        root, _, name = table.rpartition("/")
        self.path = f"{root}/_keys/{name}-{slots}"

    def entries(self, rows: DataFrame) -> DataFrame:
        """The index entries of rows of the table."""
        hashed = F.xxhash64(*self.keys)
        # a folder of an empty text is read back as null
        parts = [F.when(F.col(c) != "", F.col(c)).alias(c) if t == "string" else F.col(c) for c, t in rows.select(*self.pcols).dtypes]
        return rows.select(hashed.alias("key_hash"), *parts, F.pmod(hashed, F.lit(self.slots)).cast("int").alias("slot")).distinct()

    def _add(self, entries: DataFrame) -> None:
        (entries.repartition("slot").sortWithinPartitions("slot", "key_hash").write.mode("append").partitionBy("slot").parquet(self.path))

    def add_new(self, entries: DataFrame) -> None:
        """Add the entries that aren't there."""
        there = path_exists(self.spark, self.path)
        self._add(entries.join(self.find(entries), entries.columns, "left_anti") if there else entries)

    def ready(self, stored: DataFrame | None) -> bool:
        """Whether there is an index; one is made for a table that was written without."""
        if not path_exists(self.spark, self.path):
            if stored is None:
                return False
            self._add(self.entries(stored))
        return True

    def find(self, entries: DataFrame) -> DataFrame:
        """The stored entries whose key is among ``entries``."""
        slots = [r["slot"] for r in entries.select("slot").distinct().collect()]  # at most ``slots`` numbers
        index = self.spark.read.schema(entries.schema).parquet(self.path).where(F.col("slot").isin(slots))
        return index.join(entries.select("slot", "key_hash").distinct(), ["slot", "key_hash"], "left_semi").distinct()


def upsert_table(spark: SparkSession, incoming: DataFrame, path: str, keys: list[str],
                 partition_col: str | list[str], batch_order: int = 1, slots: int = SLOTS, located: bool = False) -> None:
    """Upsert ``incoming`` into the Parquet table at ``path`` (partitioned by ``partition_col``).

    The batch's keys are looked up in the table's key index, so a key is replaced wherever it is stored. No stored key:
    the batch is appended. Otherwise the partitions that hold one and those of the batch are merged and
    rewritten, and partitions that lost all their rows are deleted. ``incoming`` may carry
    ``__ingest_order`` (rank within the batch); stored rows rank below the batch. A retry after a crash finds
    its own rows by key and repeats the merge. Whole rows of a batch are ranked only where a key comes twice in it. While folders are put in place, and until emptied ones are deleted, a reader
    may see a key that moved twice or not at all: readers should start after the batch.

    ``located``: a key always lies in the same partition (which is made from it), so no index is kept.
    """
    pcols = [partition_col] if isinstance(partition_col, str) else list(partition_col)
    cols = [c for c in incoming.columns if c != INGEST_COL]
    ranked = incoming if INGEST_COL in incoming.columns else incoming.withColumn(INGEST_COL, F.lit(batch_order).cast("bigint"))
    # keys alone are shuffled to see whether one repeats; only then whole rows are ranked
    repeats = not ranked.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n")).where("__n > 1").limit(1).isEmpty()
    batch = (first_per_key(ranked, keys, [F.col(INGEST_COL).desc()]) if repeats else ranked).select(*cols)
    stored = spark.read.schema(batch.schema).parquet(path) if path_exists(spark, path) else None
    if located:
        held = own = {tuple(r) for r in batch.select(*pcols).distinct().collect()} if stored is not None else set()
    else:
        held, own = _find_and_add(KeyIndex(spark, path, keys, pcols, slots), batch, stored)
    if not held or stored is None:
        _write(batch, path, pcols, "append")
        return
    old = stored.where(_in_partitions(held | own, pcols)).select(*cols)
    moved_from = held - own  # only these can lose their last row
    emptied: list[str] = []
    if moved_from:
        folder = F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")
        before = stored.where(_in_partitions(moved_from, pcols)).select(*keys, folder.alias("__folder"))
        rest = before.join(batch.select(*keys), keys, "left_anti").select("__folder").distinct()
        emptied = [r[0] for r in before.select("__folder").distinct().join(rest, "__folder", "left_anti").collect()]
    _write(upsert_frames(old, batch, keys), path, pcols, "overwrite")
    for f in emptied:
        delete_path(spark, f)


def _find_and_add(index: KeyIndex, batch: DataFrame, stored: DataFrame | None) -> tuple[set[tuple], set[tuple]]:
    """(partitions that hold a key of the batch, partitions of the batch); new entries are written."""
    entries = index.entries(batch).persist()  # recomputed from the batch on loss
    try:
        if not index.ready(stored):
            index._add(entries)
            return set(), set()
        found = index.find(entries)
        both = found.select(F.lit(True).alias("found"), *index.pcols).unionByName(entries.select(F.lit(False).alias("found"), *index.pcols))
        rows = both.distinct().collect()  # partition values only, no data
        held, own = ({tuple(r)[1:] for r in rows if r["found"] == x} for x in (True, False))
        index._add(entries.join(found, entries.columns, "left_anti") if held else entries)
        return held, own
    finally:
        entries.unpersist()


def _in_partitions(values: set[tuple], pcols: list[str]) -> Column:
    """Rows of the given partitions; a filter on partition columns alone, so no other partition is listed or read."""
    by_first: dict = {}
    for v in values:
        by_first.setdefault(v[:-1], []).append(v[-1])
    test = F.lit(False)
    for first, lasts in by_first.items():
        last = F.col(pcols[-1]).isin([x for x in lasts if x is not None])
        if None in lasts:
            last = last | F.col(pcols[-1]).isNull()
        for c, x in zip(pcols, first):
            last = last & F.col(c).eqNullSafe(F.lit(x))
        test = test | last
    return test


def _write(rows: DataFrame, path: str, pcols: list[str], mode: str) -> None:
    (rows.hint("rebalance", *pcols).sortWithinPartitions(*pcols).write.mode(mode)
     .option("partitionOverwriteMode", "dynamic").partitionBy(*pcols).parquet(path))


def cursor_latest(progress: DataFrame) -> DataFrame:
    """One cursor per app version = the LAST processed block (not the highest).

    ``progress`` has (app_version, block_num, block_hash, processed_order).
    """
    last = F.max_by(F.struct("block_num", "block_hash"), "processed_order")
    return progress.groupBy(F.col("app_version").alias("id")).agg(last.alias("c")).select(
        "id", F.col("c.block_hash").alias("cursor"), F.col("c.block_num").alias("block_num"),
        F.col("c.block_hash").alias("block_id"))


def resume_height(cursors: DataFrame, app_version: str, explicit_start: int | None = None,
                  configured_start: int | None = None) -> DataFrame:
    """ST2: explicit start, else cursor + 1, else the configured start height."""
    cur = cursors.where(F.col("id") == app_version).agg(F.max("block_num").alias("block_num"))
    return cur.select(F.lit(app_version).alias("app_version"), F.coalesce(
        F.lit(explicit_start).cast("bigint"), F.col("block_num") + 1,
        F.lit(configured_start).cast("bigint")).alias("start_height"))
