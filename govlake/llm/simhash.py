"""SimHash near-dedup with pivot distance tables.

Fingerprint: A-Z lower-cased, words are runs without ASCII white space, k-word shingles
(repeats count) joined by one space and hashed with XXH64 (seed 42); a bit is 1 if it is
set in more than half of the hashes. Fewer words than k: the whole sequence is one shingle;
no word: fingerprint zero, linked like any other.

Linking (two fingerprints link when at most ``max_bits`` bits differ), on distinct fingerprints:

1. Pivot table: the Hamming distances of each fingerprint to ``PIVOTS`` reference
   fingerprints, per quarter of the bits. Distances to a pivot differ by no more than the
   two fingerprints do (triangle inequality), within each quarter too.
2. Candidates: of ``max_bits + 2`` parts at least two agree in a linked pair, and there all
   coordinates are equal. So each fingerprint is filed under the coordinates of every two
   parts; pairs meet only under equal coordinates (an equi-join, no cross join).
3. Discard pairs whose largest difference of a whole-fingerprint coordinate is above
   ``max_bits``; verify the survivors with the exact bit distance.
4. A file with more than ``FILE_LIMIT`` members is not paired at all: each member lists the 65
   fingerprints at distance 0 or 1 as pivots, and members that share a pivot are linked by
   a star (exact for max_bits = 2; two fingerprints are at distance <= 2 if and only if
   they share such a pivot). So no group grows with its square and none is capped.
5. Components by minimum label with pointer jumping, checkpointed each round.

Rows with equal fingerprints are one node, so thousands of copies cost one row.

Edge cases: null text counts as empty (fingerprint zero). A null doc_id takes part, its
component_id is the smallest non-null doc_id of the component (null if there is none).
Repeated rows stay repeated in the result; ``keep_one`` keeps one row of each component, whatever its ids. An empty table gives an empty result. Columns
beside ``id_col`` and ``text_col`` are not read.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, cut, free_names, freed, small_batches, staged, text_digest, utf8

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
PIVOTS = 16
FILE_LIMIT = 200
STEP = 1 << 16  # shingles hashed at once


def _bit_counts(joined: bytes, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    counts = np.zeros(64, np.int64)
    for at in range(0, len(begins), STEP):
        cut_out = map(joined.__getitem__, map(slice, begins[at:at + STEP].tolist(), ends[at:at + STEP].tolist()))
        h = np.fromiter(map(xxhash.xxh64_intdigest, cut_out, repeat(42)), np.uint64)
        counts += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes, k: int = 3) -> int:
    """Unsigned 64-bit SimHash of a text in UTF-8."""
    words = text.translate(LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    begins = ends - sizes
    n = max(1, len(words) - k + 1)
    counts = _bit_counts(joined, begins[:n], ends[min(k, len(words)) - 1:])
    bits = np.packbits((2 * counts > n).astype(np.uint8), bitorder="little")
    return int(bits.view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, digest: bool = False) -> DataFrame:
    """(id, fp): the fingerprint of each row as a signed long; with ``digest`` also sha, the digest of the text."""
    sha = [text_digest(text_col).alias("sha")] if digest else []
    schema = docs.select(F.col(id_col).alias("id"), F.lit(0).cast("long").alias("fp"), *sha).schema
    more = [("sha", pa.string())] if digest else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = utf8(b, "text")
            data, off = raw.tobytes(), off.tolist()
            fp = [fingerprint(data[off[i]:off[i + 1]], k) for i in range(len(off) - 1)]
            ids = b.column("id")
            yield arrow_out(pa.schema([("id", ids.type), ("fp", pa.int64()), *more]),
                            {"id": ids, "fp": np.array(fp, np.uint64).view(np.int64), **{n: b.column(n) for n, _ in more}})

    return small_batches(docs).select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), *sha).mapInArrow(freed(run), schema)


def _pivots(seed: int = 9) -> list[int]:
    rng = random.Random(seed)
    return [rng.getrandbits(64) - (1 << 63) for _ in range(PIVOTS)]


def _masks(parts: int) -> list[int]:
    edges = [round(64 * i / parts) for i in range(parts + 1)]
    out = []
    for a, b in zip(edges, edges[1:]):
        m = ((1 << (b - a)) - 1) << a
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def pivot_table(fps: DataFrame, parts: int) -> DataFrame:
    """fp, per part the array of distances to the pivots, and ``d``: the whole distances."""
    pivots = _pivots()
    cols = [F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p)).bitwiseAND(F.lit(m))).cast("byte") for p in pivots])
            .alias(f"p{i}") for i, m in enumerate(_masks(parts))]
    whole = F.array(*[F.bit_count(F.col("fp").bitwiseXOR(F.lit(p))).cast("byte") for p in pivots]).alias("d")
    return fps.select("fp", *cols, whole)


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Pairs (a, b) of distinct fingerprints that connect all fingerprints at distance <= max_bits.

    Pairs from small files are exactly the links they hold; pairs from large files join
    each member to the pivots' smallest member.
    """
    parts = max_bits + 2
    table = pivot_table(fps, parts)
    files = F.array(*[F.struct(F.xxhash64(F.lit(f"{i}-{j}"), f"p{i}", f"p{j}").alias("file"))
                      for i, j in combinations(range(parts), 2)])
    filed = table.select("fp", "d", F.explode(files).alias("f")).select("fp", "d", "f.file")
    sizes = staged(filed.groupBy("file").agg(F.count("*").alias("n")).where("n > 1"), "files")
    near = staged(filed.join(sizes, "file"), "filed")

    small = near.where(F.col("n") <= FILE_LIMIT)
    a, b = small.select("file", F.col("fp").alias("a"), F.col("d").alias("da")), small.select("file", F.col("fp").alias("b"), F.col("d").alias("db"))
    coordinates = F.greatest(*[F.abs(F.col("da")[i] - F.col("db")[i]) for i in range(PIVOTS)])
    pairs = a.join(b, (a.file == b.file) & (F.col("a") < F.col("b")) & (coordinates <= max_bits)
                   & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)).select("a", "b").distinct()

    large = near.where(F.col("n") > FILE_LIMIT).select("fp").distinct()
    if large.isEmpty():
        return pairs
    if max_bits != 2:
        raise ValueError("files above the limit are linked by pivots at distance 1, which is exact for max_bits = 2")
    around = F.array(F.lit(0).cast("long"), *[F.lit(1 << i if i < 63 else -(1 << 63)).cast("long") for i in range(64)])
    stars = large.select("fp", F.explode(around).alias("x")).select("fp", F.col("fp").bitwiseXOR(F.col("x")).alias("pivot"))
    heads = stars.groupBy("pivot").agg(F.min("fp").alias("a"), F.count("*").alias("n")).where("n > 1")
    return pairs.unionByName(stars.join(heads, "pivot").where("a < fp").select("a", F.col("fp").alias("b")).distinct())


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, label): the smallest node of each node's component, for nodes that have an edge."""
    both = staged(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
    labels = cut(both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("node"), F.least("a", "m").alias("label")))
    for _ in range(max_rounds):
        # the smallest label among the neighbours, then the label of that label
        around = both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("label").alias("m"))
        hooked = labels.join(around, labels.node == around.a).select("node", F.col("label").alias("was"), F.least("label", "m").alias("label"))
        jump = labels.select(F.col("node").alias("root"), F.col("label").alias("up"))
        new = cut(hooked.join(jump, hooked.label == jump.root).select(
            "node", "was", F.least("label", "up").alias("label")))
        labels = new.select("node", "label")
        if new.where("label != was").isEmpty():
            return labels
    raise RuntimeError("components did not settle")


def _firsts(prints: DataFrame, first: Column, max_bits: int) -> DataFrame:
    """(fp, label, first): each distinct fingerprint, its component and the smallest ``first`` of its rows."""
    nodes = staged(prints.groupBy("fp").agg(F.min(first).alias("first")), "nodes")
    labels = components(links(nodes.select("fp"), max_bits))
    named = nodes.join(labels, nodes.fp == labels.node, "left").select("fp", "first", F.coalesce("label", "fp").alias("label"))
    return staged(named, "named")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, max_bits: int = 2) -> DataFrame:
    """One row per input row: the id, fp (signed long) and component_id."""
    prints = staged(fingerprints(docs, id_col, text_col, k), "prints")
    named = _firsts(prints, F.col("id"), max_bits)
    tops = named.groupBy("label").agg(F.min("first").alias("component_id"))
    nodes = staged(named.join(tops, "label").select("fp", "component_id"), "tops")
    return prints.join(nodes, "fp").select(F.col("id").alias(id_col), "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 3, max_bits: int = 2) -> DataFrame:
    """One row of ``docs`` for each component, with all its columns: the one with the smallest doc_id.

    Null ids come last; of rows that repeat an id the first by row number stays.
    """
    own_id, own_sha, own_copies = free_names(docs, "__id", "__sha", "__copies")
    prints = staged(fingerprints(docs, id_col, text_col, k, digest=True).withColumn("rid", F.monotonically_increasing_id()), "prints")
    place = F.struct(F.col("id").isNull().alias("none"), "id", "rid", "sha")
    tops = _firsts(prints, place, max_bits).groupBy("label").agg(F.min("first").alias("top")).select(
        F.col("top.id").alias(own_id), F.col("top.sha").alias(own_sha))
    # rows of equal id and text are one key: they need a second step to leave one
    copies = prints.groupBy("id", "sha").agg(F.count("*").alias(own_copies)).where(F.col(own_copies) > 1)
    keep = staged(tops.join(copies, F.col(own_id).eqNullSafe(F.col("id")) & (F.col(own_sha) == F.col("sha")), "left").select(
        own_id, own_sha, F.coalesce(own_copies, F.lit(1)).alias(own_copies)), "keep")
    same = F.col(id_col).eqNullSafe(F.col(own_id)) & (text_digest(text_col) == F.col(own_sha))
    once = docs.join(keep.where(F.col(own_copies) == 1), same, "left_semi")
    repeated = keep.where(F.col(own_copies) > 1)
    if repeated.isEmpty():
        return once
    return once.unionByName(docs.join(repeated, same).dropDuplicates([own_id, own_sha]).select(*[f"`{c}`" for c in docs.columns]))
