"""Substring dedup by content-defined chunking with a gear rolling hash.

The gear hash of a place adds a random number per byte and shifts by one bit per step, so it
depends on the last 32 bytes only; a chunk ends where its top bits are zero. A boundary
thus depends on the content around it, and chunks line up again after an insertion.
A chunk has at least ``MIN_CHUNK`` bytes (unless its text ends) and at most ``MAX_CHUNK``; where none
of these places has zero bits, it ends at the last of those with the smallest hash, so that repeated
words line up too. Chunks are compared by a 128-bit BLAKE2b digest.

Of equal chunks the first in order of (doc_id, place) is the original; the others are
copies. Runs of consecutive copied chunks are removed if they have at least ``MIN_RUN`` bytes or
are a whole text; other ones (a common phrase) stay. A passage that two texts share and that is longer than the
first and last chunk it cuts through loses everything between them.

How it runs at scale: digests of chunks are counted with partial aggregation; only digests that
occur twice or more come back, through an equi-join on the digest (Spark splits a hot
digest's rows); copies are then gathered per document, which a document's length bounds. The shuffle files of the
count are deleted before the join writes its own (``common.staged``), so the disk holds one of them at a time. Texts
are moved only by ``remove_copies``.

Edge cases: null text counts as empty (no chunk). Null doc_id: such rows take part and sort
before all others. Rows that repeat a doc_id are told apart by a row number. All-equal bytes
give chunks of the largest size. Very long texts are hashed in pieces with the 31 bytes before each:
bounded memory, the same boundaries. An empty table gives an empty result. Other columns are
not read by ``chunk_report``; ``remove_copies`` passes them through whatever their names.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, free_names, small_batches, staged, utf8

MIN_CHUNK, MAX_CHUNK = 16, 64
MASK_BITS = 4  # a place ends a chunk with chance 2^-4
MIN_RUN = 80
PIECE = 1 << 20

_rng = random.Random(20)
GEAR = np.array([_rng.getrandbits(32) for _ in range(256)], np.uint32)


def gear(data: np.ndarray) -> np.ndarray:
    """Gear hash at each byte: the sum over the last 32 bytes b_k of GEAR[b_k] << k, modulo 2^32."""
    h = GEAR[data]
    step = 1
    while step < 32:  # sums of 1, 2, 4, .. 32 terms
        more = h.copy()
        more[step:] += h[:-step] << np.uint32(step)
        h = more
        step *= 2
    return h


def candidates(text: np.ndarray) -> np.ndarray:
    """Places (one past the byte) where the gear hash allows a boundary."""
    found = []
    for at in range(0, len(text), PIECE):
        lead = min(31, at)
        h = gear(text[at - lead:at + PIECE])[lead:]
        found.append(np.flatnonzero(h >> np.uint32(32 - MASK_BITS) == 0) + at + 1)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def forced(text: np.ndarray, last: int) -> int:
    """End of the chunk from ``last`` where the hash allows no boundary within MAX_CHUNK: the last place of the smallest hash."""
    lead = min(31, last)
    h = gear(text[last - lead:last + MAX_CHUNK])[lead + MIN_CHUNK - 1:]
    return last + MAX_CHUNK - int(np.argmin(h[::-1]))


def chunk_text(text: np.ndarray) -> list[int]:
    """Ends of the chunks of one text."""
    out, last = [], 0
    for p in candidates(text).tolist():
        if p <= last:
            continue
        while p - last > MAX_CHUNK:
            last = forced(text, last)
            out.append(last)
        if p - last >= MIN_CHUNK:
            out.append(p)
            last = p
    while len(text) - last > MAX_CHUNK:
        last = forced(text, last)
        out.append(last)
    if len(text) > last:
        out.append(len(text))
    return out


def chunk_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None) -> DataFrame:
    """One row per input row: rid, id, n_bytes and its chunks as parallel arrays (ends, d1, d2), written once.

    ``row_col``: a column that numbers the rows, where there is one.
    """
    rid = F.col(row_col) if row_col else F.monotonically_increasing_id()
    src = small_batches(docs).select(rid.alias("rid"), F.col(id_col).alias("id"),
                      F.col(text_col).cast("string").alias("text"))
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = utf8(b, "text")
            data = raw.tobytes()
            ends_of, first, second = [], [], []
            for r in range(len(off) - 1):
                at, stop = int(off[r]), int(off[r + 1])
                ends = chunk_text(raw[at:stop])
                digests = b"".join([hashlib.blake2b(data[at + x:at + y], digest_size=16).digest()
                                    for x, y in zip([0, *ends[:-1]], ends)])
                d = np.frombuffer(digests, np.int64)
                ends_of.append(np.array(ends, np.int64))
                first.append(d[0::2])
                second.append(d[1::2])
            ids = b.column("id")
            arrays = pa.list_(pa.int64())
            yield arrow_out(pa.schema([("rid", pa.int64()), ("id", ids.type), ("n_bytes", pa.int64()),
                                       ("ends", arrays), ("d1", arrays), ("d2", arrays)]),
                            {"rid": b.column("rid"), "id": ids, "n_bytes": off[1:] - off[:-1],
                             "ends": ends_of, "d1": first, "d2": second})

    out = "array<long>"
    return staged(src.mapInArrow(run, f"rid long, id {kind}, n_bytes long, ends {out}, d1 {out}, d2 {out}"), "chunks")


def copied_runs(table: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(rid, spans, n_copied): the runs of copied chunks of the rows that have any; shorter ones only if they begin the text."""
    found = table.select("rid", "id", F.explode(F.arrays_zip(
        F.concat(F.array(F.lit(0).cast("long")), "ends").alias("begin"), "ends", "d1", "d2")).alias("c")).select(
        "rid", "id", "c.begin", F.col("c.ends").alias("end"), "c.d1", "c.d2").where("end is not null")
    place = F.struct("id", "rid", "begin")
    shared = staged(found.groupBy("d1", "d2").agg(F.count("*").alias("n"), F.min(place).alias("first")).where("n > 1").select(
        "d1", "d2", F.col("first.rid").alias("first_rid"), F.col("first.begin").alias("first_begin")), "shared")
    copies = found.drop("id").join(shared, ["d1", "d2"]).where("rid != first_rid or begin != first_begin")
    return copies.groupBy("rid").agg(F.sort_array(F.collect_list(F.struct("begin", "end"))).alias("c")).select(
        "rid", F.col("c.begin").alias("begins"), F.col("c.end").alias("ends")).mapInArrow(
        _joined(min_run), "rid long, spans array<struct<begin:long,end:long>>, n_copied long")


def _joined(min_run: int):
    """Joins consecutive copied chunks and keeps the runs of at least ``min_run`` bytes, and one at byte 0 of any length."""
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, counts = [], []
            for x, y in zip(b.column("begins"), b.column("ends")):
                begin, end = x.values.to_numpy(), y.values.to_numpy()
                new = np.concatenate([[True], begin[1:] != end[:-1]])
                starts = np.flatnonzero(new)
                lo, hi = begin[starts], end[np.append(starts[1:], len(end)) - 1]
                spans.append([{"begin": int(p), "end": int(q)} for p, q in zip(lo, hi) if q - p >= min_run or p == 0])
                counts.append(len(begin))
            yield arrow_out(pa.schema([("rid", pa.int64()), ("spans", span), ("n_copied", pa.int64())]),
                            {"rid": b.column("rid"), "spans": spans, "n_copied": counts})

    return run


def chunk_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN,
                 row_col: str | None = None) -> DataFrame:
    """One row per input row: id (with ``row_col`` that instead), n_bytes, n_removed, n_spans, spans (begin, end in bytes), n_chunks, n_copied."""
    table = chunk_table(docs, id_col, text_col, row_col)
    if row_col:
        table, id_col = table.withColumn("id", F.col("rid")), row_col
    rows = table.select("rid", F.col("id").alias(id_col), "n_bytes", F.size("ends").cast("long").alias("n_chunks"))
    runs = copied_runs(table, min_run)
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    # a copied run counts from min_run bytes on, or at any length as a whole text
    spans = F.filter(F.coalesce("spans", none), lambda s: (s["end"] - s["begin"] >= min_run)
                     | ((s["begin"] == 0) & (s["end"] == F.col("n_bytes"))))
    return rows.join(runs, "rid", "left").select(
        id_col, "n_bytes", F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"]).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"), spans.alias("spans"), "n_chunks",
        F.coalesce("n_copied", F.lit(0)).cast("long").alias("n_copied"))


def cut_spans(text: str | None, spans: list) -> str | None:
    """The text without the given byte spans (characters cut in half are dropped)."""
    if not spans or text is None:
        return text
    data, out, at = text.encode(), [], 0
    for s in sorted(spans, key=lambda s: s["begin"]):
        out.append(data[at:s["begin"]])
        at = max(at, s["end"])
    return b"".join([*out, data[at:]]).decode("utf-8", "ignore")


def remove_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_run: int = MIN_RUN) -> DataFrame:
    """``docs`` with the copied runs cut out of the text; all columns pass through.

    The rows are numbered and written once, so each loses its own runs, whatever ids repeat or are null.
    """
    row, own, own_spans = free_names(docs, "__row", "__own", "__spans")
    docs = docs.withColumn(row, F.monotonically_increasing_id())
    numbered = staged(docs, "numbered")
    report = staged(chunk_report(numbered, id_col, text_col, min_run, row).where("n_spans > 0").select(
        F.col(row).alias(own), F.col("spans").alias(own_spans)), "spans")

    @F.pandas_udf("string")
    def kept(text: pd.Series, spans: pd.Series) -> pd.Series:
        return pd.Series([cut_spans(t, [] if s is None else list(s)) for t, s in zip(text, spans)], dtype=object)

    joined = numbered.join(report, F.col(row) == F.col(own), "left")
    cut = F.when(F.col(own_spans).isNull(), F.col(text_col)).otherwise(kept(F.col(text_col), F.col(own_spans)))
    return joined.withColumn(text_col, cut).drop(row, own, own_spans)
