"""Suffix-array dedup: removes every byte covered by a string of ``MIN_LENGTH`` bytes that starts in two or more places.

Method. The suffixes of a set of strings are sorted to depth ``MIN_LENGTH``; on their Burrows-Wheeler
transform, intervals are extended backward by one byte per round, breadth first. Round n sets the
common prefixes of length n between neighbouring suffixes (each is set once, by the first interval that
ends there), so they come in increasing order, and the rounds stop at the minimum length: neighbours
without a value by then share at least that many bytes (``repeated_starts``).

How it runs at scale. A transform of the whole corpus can't be one task, so equal strings are brought
together first. Each window of ``MIN_LENGTH`` bytes is filed under the smallest hash among its 64-byte
grams (gear hash, mixed); equal windows have equal keys. Neighbouring windows with one key travel as one
string, a stretch. Then:

1. One pass over the texts writes the stretches of each (key, place, 128-bit digest), no text.
2. Keys that occur once hold no repeat and are dropped; equal stretches become one with a count.
   A stretch that occurs twice or more is repeated as a whole.
3. Stretches that occur once but share their key go, with the others of that key as partners,
   to tasks by key; there the transform tells which of their windows are repeated. A count
   weighs a stretch, so a passage in a million texts is one string.
4. A key with more than ``KEY_BYTES`` of different stretches is not gathered in one task: its windows are
   counted by 128-bit digest (partial sums) instead, which gives the same result.
5. Repeated windows are joined to spans per text and cut out.

Texts move twice: only those with a key that occurs twice are written aside. Equal texts move once.

Edge cases: null counts as empty; texts shorter than the minimum length keep everything. Rows that
repeat a doc_id, or null doc_ids: each row is a text of its own ("elsewhere"). All-equal bytes: all
is removed but for texts shorter than the minimum length plus one that stand alone. Very long texts are read in pieces:
bounded memory. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import random
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, small_batches, staged, utf8

MIN_LENGTH = 400
GRAM = 64
PIECE = 1 << 19  # windows looked at together
MAX_STRETCH = 4096  # windows of one stretch
KEY_BYTES = 1 << 19  # different stretches of one key in one task
CHUNK_BYTES = 3 << 18  # stretches of several keys in one transform

_rng = random.Random(6)
GEAR = np.array([_rng.getrandbits(64) for _ in range(256)], np.uint64)
MIX = np.uint64(0x9E3779B97F4A7C15)


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the 64-byte gram that starts at each place (the last 63 places have none)."""
    h = GEAR[data]
    step = 1
    while step < GRAM:
        more = h.copy()
        more[step:] += h[:-step] << np.uint64(step)
        h = more
        step *= 2
    return (h[GRAM - 1:] ^ (h[GRAM - 1:] >> np.uint64(31))) * MIX


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(x) - width + 1
    blocks = -(-len(x) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:len(x)] = x
    grid = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def stretches(text: np.ndarray, length: int) -> Iterator[tuple[int, int, int, bool]]:
    """(key, start, windows, again): runs of windows with one key; again: the key's gram occurs twice in the run."""
    width = length - GRAM + 1
    windows = len(text) - length + 1
    for a in range(0, windows, PIECE):
        count = min(PIECE, windows - a)
        h = gram_hashes(text[a:a + count + length - 1])
        low = sliding_min(h, width)
        cuts = np.flatnonzero(low[1:] != low[:-1]) + 1
        begins = np.concatenate([[0], cuts])
        ends = np.append(cuts, len(low))
        for b, e in zip(begins.tolist(), ends.tolist()):
            key = low[b]
            again = bool(np.count_nonzero(h[b:e + width - 1] == key) > 1)
            for s in range(b, e, MAX_STRETCH):
                yield int(key.view(np.int64)), a + s, min(MAX_STRETCH, e - s), again


def digest(data: bytes) -> tuple[int, int]:
    d = hashlib.blake2b(data, digest_size=16).digest()
    return int.from_bytes(d[:8], "little", signed=True), int.from_bytes(d[8:], "little", signed=True)


# ---- the transform -----------------------------------------------------------------


def sorted_suffixes(codes: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` codes or more, by prefix doubling from as many as fit 64 bits."""
    n = len(codes)
    done = 64 // bits
    key = np.zeros(n, np.uint64)
    padded = np.concatenate([codes, np.zeros(done, codes.dtype)])
    for j in range(done):
        key <<= np.uint64(bits)
        key |= padded[j:j + n]
    while True:
        order = np.argsort(key)
        key = key[order]
        new = np.empty(n, np.uint32)
        new[0] = 0
        np.cumsum(key[1:] != key[:-1], out=new[1:])
        kinds = int(new[-1]) + 1
        if done >= depth or kinds == n:
            return order.astype(np.int32)
        rank = np.empty(n, np.uint32)
        rank[order] = new
        key = rank.astype(np.uint64) << np.uint64(32)
        key[:-done] |= rank[done:]
        done *= 2


class Transform:
    """Burrows-Wheeler transform as a wavelet matrix, for backward extension of many intervals at once. Code 0 ends a string."""

    def __init__(self, codes: np.ndarray, bits: int, order: np.ndarray):
        counts = np.bincount(codes, minlength=1 << bits)
        self.first = np.concatenate([[0], np.cumsum(counts)[:-1]])
        x = codes[order - 1]  # the suffix that is the whole text is preceded by the end of the last string
        self.zeros, self.split = [], []
        for level in range(bits - 1, -1, -1):
            low = (x >> level) & 1 == 0
            zeros = np.zeros(len(x) + 1, np.int32)
            np.cumsum(low, out=zeros[1:])
            self.zeros.append(zeros)
            self.split.append(int(zeros[-1]))
            x = np.concatenate([x[low], x[~low]])
        begins = np.flatnonzero(np.concatenate([[True], x[1:] != x[:-1]]))
        self.base = np.zeros(1 << bits, np.int64)
        self.base[x[begins]] = begins

    def extend(self, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intervals of c + w for every interval [lo, hi) of a string w and every byte c before it (not the end symbol)."""
        c = np.zeros(len(lo), np.int64)
        for zeros, split in zip(self.zeros, self.split):
            zl, zh = zeros[lo].astype(np.int64), zeros[hi].astype(np.int64)
            left, right = zh > zl, hi - lo > zh - zl
            c = np.concatenate([c[left] << 1, (c[right] << 1) | 1])
            lo, hi = np.concatenate([zl[left], (split + lo - zl)[right]]), np.concatenate([zh[left], (split + hi - zh)[right]])
        real = c > 0
        shift = self.first[c[real]] - self.base[c[real]]
        return lo[real] + shift, hi[real] + shift


def repeated_starts(strings: list[bytes], weights: list[int], length: int) -> list[np.ndarray]:
    """Per string, the starts of its windows of ``length`` bytes whose weights over all equal windows add up to two or more."""
    sizes = np.array([len(s) for s in strings], np.int64)
    ends = np.cumsum(sizes + 1)
    text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8)
    inside = np.ones(len(text), bool)
    inside[ends - 1] = False
    present = np.flatnonzero(np.bincount(text[inside], minlength=256))
    number = np.zeros(256, np.uint16)
    number[present] = np.arange(1, len(present) + 1)
    codes = np.where(inside, number[text], np.uint16(0))
    bits = max(1, len(present).bit_length())
    n = len(codes)
    order = sorted_suffixes(codes, bits, length)
    bwt = Transform(codes, bits, order)

    common = np.full(n + 1, -1, np.int16 if length < 1 << 15 else np.int32)  # of suffixes i - 1 and i; -1: not known yet
    common[0] = common[n] = 0
    common[:len(strings) + 1] = 0
    lo, hi = np.array([0], np.int64), np.array([n], np.int64)
    for value in range(length):
        lo, hi = bwt.extend(lo, hi)
        fresh = common[hi] < 0
        common[hi[fresh]] = value
        lo, hi = lo[fresh], hi[fresh]
        if not len(lo):
            break
    del bwt
    group = np.cumsum(common[:n] >= 0, dtype=np.int32)
    string_of = np.repeat(np.arange(len(strings), dtype=np.int32), sizes + 1)[order]
    window = order + length <= ends[string_of] - 1
    weight = np.array(weights, np.float64)[string_of[window]]
    total = np.bincount(group[window], weights=weight, minlength=int(group[-1]) + 1)
    hit = window & (total[group] >= 2)
    out = np.zeros(n, bool)
    out[order[hit]] = True
    begins = ends - sizes - 1
    return [np.flatnonzero(out[b:b + z]) for b, z in zip(begins, sizes)]


def ranges(starts: np.ndarray) -> tuple[list[int], list[int]]:
    """Runs of consecutive starts as half-open ranges."""
    if not len(starts):
        return [], []
    new = np.flatnonzero(np.concatenate([[True], starts[1:] != starts[:-1] + 1]))
    return starts[new].tolist(), (starts[np.append(new[1:], len(starts)) - 1] + 1).tolist()


# ---- Spark ---------------------------------------------------------------------------

SID = ["key", "d1", "d2", "windows"]  # what tells stretches apart
FOUND = "key long, d1 long, d2 long, windows long, begins array<long>, ends array<long>"
FOUND_ARROW = pa.schema([*[(c, pa.int64()) for c in SID], ("begins", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(F.lit(1), text).alias("t1"),
                       F.xxhash64(F.lit(2), text).alias("t2"), text.alias("text"))


def stretch_table(src: DataFrame, length: int) -> DataFrame:
    """One row per input row: id, text key, n_bytes, sha256 and the stretches as parallel arrays. Written once."""
    kind = src.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        longs = pa.list_(pa.int64())
        for b in batches:
            raw, off = utf8(b, "text")
            cols: dict[str, list] = {n: [] for n in ("key", "d1", "d2", "start", "windows", "again")}
            for r in range(len(off) - 1):
                text = raw[off[r]:off[r + 1]]
                data = text.tobytes()
                found = [(k, *digest(data[s:s + n + length - 1]), s, n, int(again))
                         for k, s, n, again in stretches(text, length)] if len(text) >= length else []
                for name, values in zip(cols, zip(*found) if found else [()] * 6):
                    cols[name].append(np.array(values, np.int64))
            ids = b.column("id")
            fields = [("id", ids.type), ("t1", pa.int64()), ("t2", pa.int64()), ("n_bytes", pa.int64()), ("sha", pa.string())]
            yield arrow_out(pa.schema([*fields, *[(n, longs) for n in cols]]),
                            {**{n: b.column(n) for n in ("id", "t1", "t2", "sha")}, "n_bytes": off[1:] - off[:-1], **cols})

    arrays = ", ".join(f"{n} array<long>" for n in ("key", "d1", "d2", "start", "windows", "again"))
    return staged(src.withColumn("sha", F.sha2("text", 256)).mapInArrow(
        run, f"id {kind}, t1 long, t2 long, n_bytes long, sha string, {arrays}"), "stretches")


def _transform_tasks(length: int, chunk_bytes: int):
    """Tasks over rows sorted by key: whole keys are gathered to chunks, one transform each."""
    def solve(rows: list) -> pa.RecordBatch:
        found = repeated_starts([r[5] for r in rows], [r[4] for r in rows], length)
        spans = [ranges(s) for s in found]
        return arrow_out(FOUND_ARROW, {"key": [r[0] for r in rows], "d1": [r[1] for r in rows], "d2": [r[2] for r in rows],
                               "windows": [r[3] for r in rows], "begins": [s[0] for s in spans], "ends": [s[1] for s in spans]})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list = []
        size = 0
        for b in batches:
            for row in zip(*[b.column(n).to_pylist() for n in ("key", "d1", "d2", "windows", "n", "data")]):
                if size >= chunk_bytes and row[0] != rows[-1][0]:
                    yield solve(rows)
                    rows, size = [], 0
                rows.append(row)
                size += len(row[5])
        if rows:
            yield solve(rows)

    return run


def _window_digests(length: int):
    out = pa.schema([("key", pa.int64()), ("d1", pa.int64()), ("d2", pa.int64()), ("windows", pa.int64()), ("n", pa.int64()),
                     ("place", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for *sid, n, data in zip(*[b.column(c).to_pylist() for c in (*SID, "n", "data")]):
                count = len(data) - length + 1
                d = np.array([digest(data[i:i + length]) for i in range(count)], np.int64).reshape(-1, 2)
                cols = {name: np.full(count, v, np.int64) for name, v in zip((*SID, "n"), (*sid, n))}
                yield arrow_out(out, {**cols, "place": np.arange(count), "w1": d[:, 0], "w2": d[:, 1]})

    return run


def _count_windows(heavy: DataFrame, length: int) -> DataFrame:
    """Repeated windows of the stretches of keys that are too large for one task, by digest."""
    windows = staged(heavy.select(*SID, "n", "data").mapInArrow(
        _window_digests(length), "key long, d1 long, d2 long, windows long, n long, place long, w1 long, w2 long"), "windows")
    shared = windows.groupBy("w1", "w2").agg(F.sum("n").alias("total")).where("total > 1").select("w1", "w2")
    hits = windows.join(staged(shared, "shared"), ["w1", "w2"])
    return hits.groupBy(*SID).agg(F.sort_array(F.collect_list("place")).alias("places")).mapInArrow(_joined_places, FOUND)


def _joined_places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted window starts to ranges, one array per stretch (a stretch has MAX_STRETCH windows at most)."""
    for b in batches:
        spans = [ranges(x.values.to_numpy()) for x in b.column("places")]
        yield arrow_out(FOUND_ARROW, {**{c: b.column(c) for c in SID}, "begins": [s[0] for s in spans], "ends": [s[1] for s in spans]})


def repeated_windows(src: DataFrame, table: DataFrame, length: int, key_bytes: int, chunk_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(places, texts): (t1, t2, begin, end) ranges of repeated window starts, and the texts that may hold some."""
    arrays = ["key", "d1", "d2", "start", "windows", "again"]
    every = table.select("t1", "t2", F.explode(F.arrays_zip(*arrays)).alias("s")).select("t1", "t2", *[f"s.{a}" for a in arrays])
    keys = staged(every.groupBy("key").agg(F.count("*").alias("k"), F.max("again").alias("again")).where(
        "k > 1 or again = 1").select("key"), "keys")
    near = staged(every.join(keys, "key"), "near")
    kinds = staged(near.groupBy(*SID).agg(F.count("*").alias("n"), F.min(F.struct("t1", "t2", "start")).alias("at"),
                                          F.max("again").alias("again")), "kinds")
    size = F.col("windows") + (length - 1)
    files = kinds.groupBy("key").agg(F.count("*").alias("kinds"), F.sum(F.when(F.col("n") == 1, 1).otherwise(0)).alias("single"),
                                     F.max("again").alias("some_again"), F.sum(size).alias("bytes"))
    files = staged(files.where("single > 0 and (kinds > 1 or some_again = 1)").select(
        "key", (F.col("bytes") > key_bytes).alias("heavy")), "files")
    wanted = kinds.join(files, "key")

    # the texts with a key that occurs twice, each once
    suspects = near.select("t1", "t2").distinct()
    texts = src.groupBy("t1", "t2").agg(F.first("text").alias("text"))
    texts = staged(texts.join(suspects, ["t1", "t2"], "left_semi"), "texts")

    cuts = wanted.select("at.t1", "at.t2", F.struct(*SID, "n", "heavy", (F.col("at.start") + 1).cast("int").alias("begin"),
                                                    size.cast("int").alias("size")).alias("cut"))
    cuts = cuts.groupBy("t1", "t2").agg(F.collect_list("cut").alias("cuts"))
    data = texts.select("t1", "t2", F.col("text").cast("binary").alias("bytes")).join(cuts, ["t1", "t2"]).select(
        "bytes", F.explode("cuts").alias("c")).select(
        "c.*", F.expr("substring(bytes, c.begin, c.size)").alias("data")).drop("begin", "size")
    data = staged(data, "data")
    light = data.where("not heavy").select(*SID, "n", "data")
    found = light.repartition("key").sortWithinPartitions("key").mapInArrow(
        _transform_tasks(length, chunk_bytes), FOUND)
    if not files.where("heavy").isEmpty():
        found = found.unionByName(_count_windows(data.where("heavy"), length))
    found = staged(found, "found")

    whole = kinds.where("n > 1").select(*SID, F.array(F.lit(0).cast("long")).alias("begins"), F.array("windows").alias("ends"))
    some = found.join(kinds.where("n = 1").select(*SID), SID, "left_semi").where("size(begins) > 0")
    places = near.drop("again").join(staged(whole.unionByName(some), "repeated"), SID).select(
        "t1", "t2", F.explode(F.arrays_zip("begins", "ends")).alias("r"), "start").select(
        "t1", "t2", (F.col("start") + F.col("r.begins")).alias("begin"), (F.col("start") + F.col("r.ends")).alias("end"))
    return places.distinct(), texts


def _spans(begins: np.ndarray, ends: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Bytes covered by windows that start in the ranges, as maximal spans."""
    order = np.argsort(begins, kind="stable")
    b, e = begins[order], np.maximum.accumulate(ends[order] + length - 1)
    new = np.flatnonzero(np.concatenate([[True], b[1:] > e[:-1]]))
    return list(zip(b[new].tolist(), e[np.append(new[1:], len(b)) - 1].tolist()))


def _cut_texts(length: int, with_text: bool):
    span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cols: dict[str, list] = {"spans": [], "kept_sha256": [], "kept": []}
            for data, x, y in zip(b.column("text").to_pylist(), b.column("begins"), b.column("ends")):
                data = data.encode()
                spans = _spans(x.values.to_numpy(), y.values.to_numpy(), length)
                edges = [0, *[p for s in spans for p in s], len(data)]
                kept = b"".join(data[p:q] for p, q in zip(edges[::2], edges[1::2]))
                cols["spans"].append([{"begin": p, "end": q} for p, q in spans])
                cols["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
                cols["kept"].append(kept if with_text else None)
            yield arrow_out(pa.schema([("t1", pa.int64()), ("t2", pa.int64()), ("spans", span), ("kept_sha256", pa.string()), ("kept", pa.binary())]),
                            {"t1": b.column("t1"), "t2": b.column("t2"), **cols})

    return run


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = MIN_LENGTH,
                 with_text: bool = False, key_bytes: int = KEY_BYTES, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row per input row: id, n_bytes, n_removed, n_spans, kept_sha256, spans (begin, end in bytes) and, with_text, kept (binary)."""
    if length < GRAM:
        raise ValueError(f"the minimum length is at least {GRAM} bytes")
    src = _source(small_batches(docs), id_col, text_col)
    table = stretch_table(src, length)
    places, texts = repeated_windows(src, table, length, key_bytes, chunk_bytes)
    per = places.groupBy("t1", "t2").agg(F.collect_list(F.struct("begin", "end")).alias("p")).select(
        "t1", "t2", F.col("p.begin").alias("begins"), F.col("p.end").alias("ends"))
    cut = staged(texts.join(per, ["t1", "t2"]).select("t1", "t2", "text", "begins", "ends").mapInArrow(
        _cut_texts(length, with_text), "t1 long, t2 long, spans array<struct<begin:long,end:long>>, kept_sha256 string, kept binary"), "cut")
    rows = table.select("id", "t1", "t2", "n_bytes", "sha")
    none = F.array().cast("array<struct<begin:bigint,end:bigint>>")
    spans = F.coalesce("spans", none)
    out = rows.join(cut, ["t1", "t2"], "left").select(
        F.col("id").alias(id_col), "n_bytes",
        F.aggregate(spans, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["begin"]).alias("n_removed"),
        F.size(spans).cast("long").alias("n_spans"), F.coalesce("kept_sha256", "sha").alias("kept_sha256"), spans.alias("spans"), "kept")
    return out if with_text else out.drop("kept")
