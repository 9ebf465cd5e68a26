"""Benchmark decontamination by greedy string tiling.

Texts are token sequences, after NFKC and case folding: runs of letters, marks and digits of any script, and single
characters in scripts that are written without spaces (``UNSPACED``); all else separates. A benchmark item is leaked by a document if
tiles of at least ``MIN_MATCH`` tokens that the two share cover at least ``COVERAGE`` of the
item's tokens. Tiles don't overlap in either text and may come in any order, so a reordered
passage is found too. An item of fewer tokens must be found whole, in one tile; one of fewer than ``SHORT_ITEM`` tokens
says too little to tell a leak by.

1. Seeds: hashes of ``MIN_MATCH`` consecutive tokens (of a short item: of all its tokens). Documents look their seeds up
   in a bit field of the items' seeds (16 bits a seed, 2^24 to 2^30 in all); only token runs whose
   seeds are all in the field go on, so a document without shared tokens sends nothing.
2. Join: the runs' seeds meet the items' seeds in an equi-join, which gives the pairs (document,
   item) that share a seed. Wrong hits of the bit field end here.
3. Tiling (per pair): running Karp-Rabin with a shrinking search length; the longest unmarked
   matches are marked first, each verified token by token. What a longer tile leaves of a match goes back among the
   matches, so at the end no unmarked match of ``MIN_MATCH`` tokens is left.
4. Coverage per pair against the threshold; per document the leaked items and the largest coverage.

Everything per pair is bounded by one document and one item. A passage that a third of the
documents hold gives one pair per document.

Edge cases: null and empty texts hold no token: never contaminated. Items with fewer than
``SHORT_ITEM`` tokens match nothing. Very long texts are read in slices that end at white space. Repeated items and rows with
null ids take part. Rows that repeat a doc_id, or have none, are judged one by one, in the report and
by ``drop_leaks``, which tells them apart by a digest of the text. An empty benchmark or table gives an
uncontaminated or empty result. Other columns are not read.
"""

from __future__ import annotations

import heapq
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, free_names, freed, small_batches, sorted_unique, staged, text_digest
from .quality import mixed, span_hashes

MIN_MATCH = 5
SHORT_ITEM = 3
COVERAGE = 0.8
FIELD_BITS = (24, 30)
PIECE = 1 << 18
MODULUS = (1 << 61) - 1
RADIX = 1_000_003

# Scripts without spaces between words, as ranges of code points
# (Thai, Lao, Myanmar, Khmer, kana, CJK ideographs and their extensions).
UNSPACED = [(0x0E00, 0x0E7F), (0x0E80, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF),
            (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF)]
GAP, WORD, SINGLE = 0, 1, 2
_BREAK = re.compile(r"\s")


@lru_cache(1)
def kinds() -> np.ndarray:
    """What each code point is in a text: a gap, part of a word, or a token of its own."""
    out = np.fromiter((unicodedata.category(chr(c))[0] in "LMN" for c in range(0x110000)), np.uint8, 0x110000)
    for first, last in UNSPACED:
        out[first:last + 1] *= SINGLE
    return out


def folded(text: str) -> str:
    return text.lower() if text.isascii() else unicodedata.normalize("NFKC", text).casefold()


def slices(text: str, size: int) -> Iterator[str]:
    """Parts of a text that end at white space, of about ``size`` characters; longer where there is none."""
    at = 0
    while len(text) - at > size and (m := _BREAK.search(text, at + size)):
        yield text[at:m.end()]
        at = m.end()
    yield text[at:]


def _grouped(texts: list[str | None]) -> Iterator[tuple[list[int], list[str]]]:
    rows, some, size = [], [], 0
    for row, text in enumerate(texts):
        for part in slices(folded(text or ""), PIECE):
            if some and size + len(part) > PIECE:
                yield rows, some
                rows, some, size = [], [], 0
            rows.append(row)
            some.append(part)
            size += len(part)
    if some:
        yield rows, some


def tokens(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of every token of the texts, in order."""
    rows_, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for rows, some in _grouped(texts):
        parts = [p.encode() for p in some]
        data = np.frombuffer(b"\n".join(parts), np.uint8)
        if not len(data):
            continue
        joined = "\n".join(some)
        if len(joined) == len(data):
            kind = kinds()[:128][data]
            single = single_end = np.zeros(0, np.int64)
        else:
            points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
            of_point = kinds()[points]
            width = 1 + (points >= 0x80) + (points >= 0x800) + (points >= 0x10000)
            kind = np.repeat(of_point, width)
            ends = np.cumsum(width)
            single_end = ends[of_point == SINGLE]
            single = single_end - width[of_point == SINGLE]
        word = np.diff(np.concatenate([[False], kind == WORD, [False]]).astype(np.int8))
        b = np.sort(np.concatenate([np.flatnonzero(word == 1), single]))
        e = np.sort(np.concatenate([np.flatnonzero(word == -1), single_end]))
        begin_of = np.cumsum([0, *[len(p) + 1 for p in parts[:-1]]])
        rows_.append(np.array(rows, np.int64)[np.searchsorted(begin_of, b, side="right") - 1])
        hashes.append(span_hashes(data, b, e).view(np.int64))
    return np.concatenate(rows_), np.concatenate(hashes)


def seeds(row: np.ndarray, token: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, hash) of each k consecutive tokens of one text."""
    n = len(token) - k + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(RADIX) + token[j:j + n].view(np.uint64)
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return at, mixed(h)[at]


def tile(item: list[int], runs: list[list[int]], k: int = MIN_MATCH) -> list[tuple[int, int, int, int]]:
    """Greedy tiles (place in item, run, place in run, length) by running Karp-Rabin, longest first, until no match is left."""
    free_item, free_runs = [True] * len(item), [[True] * len(r) for r in runs]
    longest = min(len(item), max(map(len, runs), default=0))
    out: list[tuple[int, int, int, int]] = []
    size = max(longest, k)
    while longest >= k:
        found = _matches(item, runs, free_item, free_runs, size)
        top = max((m[3] for m in found), default=0)
        if top > 2 * size:
            size = top  # look for the very long ones first
            continue
        heap = [(-n, i, r, j) for i, r, j, n in found]
        heapq.heapify(heap)
        while heap:
            n, i, r, j = heapq.heappop(heap)
            rest = _unmarked(free_item, free_runs[r], i, j, -n)
            if rest == [(0, -n)]:
                free_item[i:i - n] = [False] * -n
                free_runs[r][j:j - n] = [False] * -n
                out.append((i, r, j, -n))
            else:  # a longer tile took a part of it
                for at, length in rest:
                    if length >= size:
                        heapq.heappush(heap, (-length, i + at, r, j + at))
        if size == k:
            return out
        size = max(k, size // 2)
    return out


def _unmarked(free_item: list[bool], free_run: list[bool], i: int, j: int, n: int) -> list[tuple[int, int]]:
    """(offset, length) of the stretches of a match that are unmarked in both texts."""
    out, begin = [], None
    for x in range(n):
        if free_item[i + x] and free_run[j + x]:
            begin = x if begin is None else begin
        elif begin is not None:
            out.append((begin, x - begin))
            begin = None
    return out if begin is None else [*out, (begin, n - begin)]


def _hashes(seq: list[int], free: list[bool], size: int) -> Iterator[tuple[int, int]]:
    """(place, Karp-Rabin hash) of the windows without a marked token."""
    top = pow(RADIX, size - 1, MODULUS)
    h = unmarked = 0
    for p, x in enumerate(seq):
        if not free[p]:
            h = unmarked = 0
            continue
        if unmarked == size:
            h = (h - seq[p - size] * top) % MODULUS
            unmarked -= 1
        h = (h * RADIX + x) % MODULUS
        unmarked += 1
        if unmarked == size:
            yield p - size + 1, h


def _matches(item, runs, free_item, free_runs, size):
    """Maximal matches of at least ``size`` unmarked tokens, verified token by token."""
    at: dict[int, list[tuple[int, int]]] = {}
    for i, h in _hashes(item, free_item, size):
        at.setdefault(h, []).append(i)
    out = set()
    for r, seq in enumerate(runs):
        for j, h in _hashes(seq, free_runs[r], size):
            for i in at.get(h, ()):
                if i and j and free_item[i - 1] and free_runs[r][j - 1] and item[i - 1] == seq[j - 1]:
                    continue  # begins earlier
                n = 0
                while (i + n < len(item) and j + n < len(seq) and free_item[i + n] and free_runs[r][j + n]
                       and item[i + n] == seq[j + n]):
                    n += 1
                if n >= size:
                    out.add((i, r, j, n))
    return out


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def item_tokens(items: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(item, tokens, seeds) of the benchmark; a short item is a seed itself, still shorter ones are left out."""
    kind = items.select(id_col).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, token = tokens(b.column("text").to_pylist())
            at, h = seeds(row, token, k)
            cuts = np.searchsorted(row, np.arange(b.num_rows + 1))
            for size in range(min(SHORT_ITEM, k), k):
                own = cuts[:-1][np.diff(cuts) == size]
                short_at, short_h = seeds(row, token, size)
                at, h = np.concatenate([at, own]), np.concatenate([h, short_h[np.searchsorted(short_at, own)]])
            order = np.argsort(at, kind="stable")
            at, h = at[order], h[order]
            of = np.searchsorted(row[at], np.arange(b.num_rows + 1))
            longs = pa.list_(pa.int64())
            yield arrow_out(pa.schema([("item", b.column("id").type), ("tokens", longs), ("seeds", longs)]), {
                "item": b.column("id"), "tokens": [token[x:y] for x, y in zip(cuts, cuts[1:])],
                "seeds": [sorted_unique(h[x:y].view(np.int64)) for x, y in zip(of, of[1:])]})

    return staged(_rows(items, id_col, text_col).mapInArrow(
        run, f"item {kind}, tokens array<long>, seeds array<long>").where("size(seeds) > 0").withColumn(
        "item_row", F.monotonically_increasing_id()), "items")


def seed_runs(docs: DataFrame, field: np.ndarray, id_col: str, text_col: str, k: int, short: list[int], digest: bool = False) -> DataFrame:
    """(rid, id, begins, tokens, seeds): the runs of tokens whose seeds are all in the bit field, and the hits of short items.

    ``short``: the lengths of the short items; a hit of one is a run of its own, with a negative ``begin`` that no
    other run of the text has. With ``digest`` also sha, the digest of the text.
    """
    sent = docs.sparkSession.sparkContext.broadcast(field)
    shift = np.uint64(64 - (len(field) * 8 - 1).bit_length())
    src = small_batches(docs).select(F.monotonically_increasing_id().alias("rid"), F.col(id_col).alias("id"),
                      F.col(text_col).cast("string").alias("text"), *([text_digest(text_col).alias("sha")] if digest else []))
    kind = src.schema["id"].dataType.simpleString()
    more = [("sha", pa.string())] if digest else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sent.value
        longs, runs = pa.list_(pa.int64()), pa.list_(pa.list_(pa.int64()))
        for b in batches:
            row, token = tokens(b.column("text").to_pylist())
            first = np.searchsorted(row, np.arange(b.num_rows))
            begins, run_tokens, run_seeds = ([[] for _ in range(b.num_rows)] for _ in range(3))

            def hits(size: int) -> tuple[np.ndarray, np.ndarray]:
                at, h = seeds(row, token, size)
                slot = (h >> shift).astype(np.int64)
                hit = (bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1 == 1
                return at[hit], h[hit].view(np.int64)

            for size in short:
                for x, seed in zip(*hits(size)):
                    r = row[x]
                    begins[r].append(-1 - ((x - first[r]) * k + size))
                    run_tokens[r].append(token[x:x + size])
                    run_seeds[r].append(np.array([seed]))
            at, h = hits(k)
            if len(at):
                # a run ends where the next seed does not overlap this one
                new = np.flatnonzero(np.concatenate([[True], (at[1:] > at[:-1] + 1) | (row[at[1:]] != row[at[:-1]])]))
                for x, y in zip(new, np.append(new[1:], len(at))):
                    r = row[at[x]]
                    begins[r].append(at[x] - first[r])
                    run_tokens[r].append(token[at[x]:at[y - 1] + k])
                    run_seeds[r].append(h[x:y])
            yield arrow_out(pa.schema([("rid", pa.int64()), ("id", b.column("id").type), ("begins", longs), ("tokens", runs), ("seeds", runs), *more]),
                            {"rid": b.column("rid"), "id": b.column("id"), "begins": begins, "tokens": run_tokens, "seeds": run_seeds,
                             **{n: b.column(n) for n, _ in more}})

    nested = "array<array<long>>"
    return staged(src.mapInArrow(freed(run), f"rid long, id {kind}, begins array<long>, tokens {nested}, seeds {nested}"
                                    + (", sha string" if digest else "")), "runs")


def leaks(table: DataFrame, items: DataFrame, k: int) -> DataFrame:
    """(rid, item, item_row, coverage, tiles) of every pair that shares a seed."""
    runs = table.where("size(begins) > 0").select("rid", F.explode(F.arrays_zip("begins", "tokens", "seeds")).alias("r")).select(
        "rid", F.col("r.begins").alias("begin"), "r.tokens", "r.seeds")
    item_seeds = items.select("item_row", F.explode("seeds").alias("seed"))
    meet = runs.select("rid", "begin", F.explode(F.array_distinct("seeds")).alias("seed")).join(item_seeds, "seed")
    pairs = meet.select("rid", "begin", "item_row").distinct()
    both = runs.select("rid", "begin", "tokens").join(pairs, ["rid", "begin"]).groupBy("rid", "item_row").agg(
        F.sort_array(F.collect_list(F.struct("begin", "tokens"))).alias("runs"))
    both = both.join(items.select("item", "item_row", F.col("tokens").alias("item_tokens")), "item_row")
    kind = items.schema["item"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            coverage, count = [], []
            for item, held in zip(b.column("item_tokens").to_pylist(), b.column("runs").to_pylist()):
                tiles = tile(item, [x["tokens"] for x in held], min(k, len(item)))
                coverage.append(sum(t[3] for t in tiles) / len(item))
                count.append(len(tiles))
            ids = b.column("item")
            yield arrow_out(pa.schema([("rid", pa.int64()), ("item", ids.type), ("item_row", pa.int64()), ("coverage", pa.float64()), ("tiles", pa.int64())]),
                            {"rid": b.column("rid"), "item": ids, "item_row": b.column("item_row"), "coverage": coverage, "tiles": count})

    return both.select("rid", "item", "item_row", "item_tokens", "runs").mapInArrow(
        run, f"rid long, item {kind}, item_row long, coverage double, tiles long")


def _leaks_of(docs: DataFrame, benchmark: DataFrame, id_col: str, text_col: str, item_col: str = "item_id",
              item_text_col: str = "text", k: int = MIN_MATCH, digest: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The items, the rows of ``seed_runs`` and the ``leaks`` of both."""
    items = item_tokens(benchmark, item_col, item_text_col, k)
    count = items.agg(F.coalesce(F.sum(F.size("seeds")), F.lit(0))).first()[0]
    bits = min(max((16 * count).bit_length(), FIELD_BITS[0]), FIELD_BITS[1])
    slots = items.select(F.explode("seeds").alias("s")).select(
        F.shiftrightunsigned("s", 64 - bits).alias("slot")).distinct().toArrow().column("slot").to_numpy()
    field = np.zeros(1 << (bits - 3), np.uint8)
    np.bitwise_or.at(field, slots >> 3, np.left_shift(1, slots & 7).astype(np.uint8))
    short = [r[0] for r in items.select(F.size("tokens")).distinct().where(F.size("tokens") < k).collect()]  # at most k - 1 numbers
    table = seed_runs(docs, field, id_col, text_col, k, sorted(short), digest)
    return items, table, leaks(table, items, k)


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text_col: str = "text", k: int = MIN_MATCH,
                  coverage: float = COVERAGE) -> DataFrame:
    """One row per input row: id, contaminated, coverage (largest of any item), items (leaked ones, sorted)."""
    items, table, found = _leaks_of(docs, benchmark, id_col, text_col, item_col, item_text_col, k)
    per = found.groupBy("rid").agg(
        F.max("coverage").alias("coverage"),
        F.array_sort(F.collect_set(F.when(F.col("coverage") >= coverage, F.col("item")))).alias("items"),
        F.max(F.col("coverage") >= coverage).alias("contaminated"))
    kind = items.schema["item"].dataType.simpleString()
    return table.select("rid", F.col("id").alias(id_col)).join(per, "rid", "left").select(
        id_col, F.coalesce("contaminated", F.lit(False)).alias("contaminated"),
        F.coalesce("coverage", F.lit(0.0)).alias("coverage"),
        F.coalesce("items", F.array().cast(f"array<{kind}>")).alias("items"))


def drop_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               coverage: float = COVERAGE, **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    own_id, own_sha = free_names(docs, "__id", "__sha")
    _, table, found = _leaks_of(docs, benchmark, id_col, text_col, digest=True, **how)
    # a row's verdict depends on its text only, so rows of equal id and text go together
    leaked = staged(table.join(found.where(F.col("coverage") >= coverage).select("rid"), "rid", "left_semi").select(
        F.col("id").alias(own_id), F.col("sha").alias(own_sha)).distinct(), "leaked")
    return docs.join(leaked, F.col(id_col).eqNullSafe(F.col(own_id)) & (text_digest(text_col) == F.col(own_sha)), "left_anti")
