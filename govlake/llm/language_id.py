"""Language identification by prediction by partial matching (PPM).

Each language has a tree of byte contexts of up to ``order`` bytes with the counts of the
bytes that followed them in its training texts. In a context with n occurrences and u
distinct followers, a follower seen c times costs -log2(c / (n + u)) bits; any other byte
costs the escape, -log2(u / (n + u)), plus its cost in the context that is one byte shorter;
a context never seen costs nothing to leave; below the empty context a byte costs 8 bits.
Counts are frozen after training, so a text's exact code length in a language is a sum of
terms that depend on the last ``order`` + 1 bytes only. The language with the shortest code wins.

Since the statistics are frozen, the cost of every stored gram is worked out once for all
languages (``PpmModel``); scoring looks up grams of order + 1 bytes and falls back order by
order for the rest. The lookups compare the gram itself, so no hash collision changes a cost.

Training reads a hash sample of about ``sample_bytes`` bytes, the same share for each
language, so the model's size (at most one gram per sampled byte) does not grow with the
corpus. Grams are counted on the executors.

Edge cases: a null text or one without a letter is ``und`` with score 0; so is every text if
there is nothing to learn from. Equal code lengths: the first language in sort order. Rows with a
null language are not learned from. Very long texts are scored in pieces, each with the
bytes before it as context: bounded memory and the same result. An empty table gives
an empty result; rows may repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, pieces, small_batches, sorted_unique, utf8

ORDER = 4
SAMPLE_BYTES = 8 << 20
PIECE = 1 << 18
LETTERS = np.zeros(256, bool)
LETTERS[[*range(65, 91), *range(97, 123)]] = True


def grams(raw: np.ndarray, offsets: np.ndarray, rows: np.ndarray, begins: np.ndarray, ends: np.ndarray,
          order: int, blank: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The last order + 1 bytes at each position of the pieces, as integers, and the bounds of the pieces.

    Before a text stand one ``blank`` and zeros.
    """
    sizes = ends - begins
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    lo, hi = int(begins[0]), int(ends[-1])  # pieces are consecutive
    before = min(order, lo)
    window = raw[lo - before:hi].astype(np.uint64)
    out = window[before:].copy()
    since = np.arange(lo, hi) - np.repeat(offsets[rows], sizes)  # place in the text
    for k in range(1, order + 1):
        older = np.zeros(hi - lo, np.uint64)
        src = window[max(0, before - k):len(window) - k]
        older[hi - lo - len(src):] = src[:hi - lo]
        older[since < k] = 0
        if blank:
            older[since == k - 1] = blank
        out |= older << np.uint64(8 * k)
    return out, bounds


class ExactTable:
    """Integer keys to row numbers by open addressing; a key that isn't stored gives -1."""

    MIX = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: np.ndarray):
        self.bits = max(4, int(np.ceil(np.log2(max(len(keys), 1) * 3))))
        self.slots = np.full(1 << self.bits, -1, np.int32)
        self.keys = keys
        todo, at = np.arange(len(keys)), self._slot(keys)
        while len(todo):
            free = self.slots[at] < 0
            self.slots[at[free]] = todo[free]  # of several the last one stays
            missed = self.slots[at] != todo
            todo, at = todo[missed], (at[missed] + 1) & ((1 << self.bits) - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * self.MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        if not len(self.keys):
            return np.full(len(keys), -1, np.int32)
        at = self._slot(keys)
        out = self.slots[at]
        open_ = np.flatnonzero((out >= 0) & (self.keys[out] != keys))
        while len(open_):
            at[open_] = (at[open_] + 1) & ((1 << self.bits) - 1)
            out[open_] = self.slots[at[open_]]
            open_ = open_[(out[open_] >= 0) & (self.keys[out[open_]] != keys[open_])]
        return out


class PpmModel:
    """Code lengths in bits of grams of each order, one column per language, from frozen counts."""

    def __init__(self, languages: list[str], order: int, counts: dict[str, tuple[np.ndarray, np.ndarray]]):
        self.languages, self.order = languages, order
        self.tables, self.costs, self.contexts, self.escapes = [], [], [], []
        for d in range(order + 1):
            mask = np.uint64((1 << (8 * (d + 1))) - 1)
            per = []
            for lang in languages:
                g, c = counts[lang]
                keys, inverse = np.unique(g & mask, return_inverse=True)
                per.append((keys, np.bincount(inverse, weights=c, minlength=len(keys))))
            keys = sorted_unique(np.concatenate([k for k, _ in per])) if per else np.zeros(0, np.uint64)
            ctx = sorted_unique(keys >> np.uint64(8))
            escape = np.zeros((len(ctx), len(languages)), np.float32)
            cost = np.zeros((len(keys), len(languages)), np.float32)
            self.contexts.append(ExactTable(ctx))
            self.escapes.append(escape)
            place = np.searchsorted(ctx, keys >> np.uint64(8))
            shorter = self._cost(d - 1, keys & np.uint64((1 << (8 * d)) - 1))
            for j, (own, n) in enumerate(per):
                at = np.searchsorted(ctx, own >> np.uint64(8))
                total = np.bincount(at, weights=n, minlength=len(ctx))
                kinds = np.bincount(at, minlength=len(ctx))
                seen = total > 0
                escape[seen, j] = -np.log2(kinds[seen] / (total[seen] + kinds[seen]))
                cost[:, j] = escape[place, j] + shorter[:, j]
                cost[np.searchsorted(keys, own), j] = -np.log2(n / (total[at] + kinds[at]))
            self.tables.append(ExactTable(keys))
            self.costs.append(cost)

    def _cost(self, d: int, g: np.ndarray) -> np.ndarray:
        """Bits of each gram of d + 1 bytes in each language."""
        if d < 0:
            return np.full((len(g), len(self.languages)), 8.0, np.float32)
        row = self.tables[d].find(g)
        if not len(self.costs[d]):
            return self._cost(d - 1, g & np.uint64((1 << (8 * d)) - 1))
        out = self.costs[d][row]
        rest = np.flatnonzero(row < 0)
        if len(rest):
            left = g[rest]
            ctx = self.contexts[d].find(left >> np.uint64(8))
            escape = np.where((ctx >= 0)[:, None], self.escapes[d][ctx], np.float32(0))
            out[rest] = escape + self._cost(d - 1, left & np.uint64((1 << (8 * d)) - 1))
        return out

    def bits(self, raw: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Code length in bits of each text in each language."""
        total = np.zeros((len(offsets) - 1, len(self.languages)))
        for rows, begins, ends in pieces(offsets, PIECE):
            if ends[-1] == begins[0]:
                continue
            g, bounds = grams(raw, offsets, rows, begins, ends, self.order)
            cost = self._cost(self.order, g)
            full = bounds[1:] > bounds[:-1]
            np.add.at(total, rows[full], np.add.reduceat(cost, bounds[:-1][full], axis=0, dtype=np.float64))
        return total


def count_grams(docs: DataFrame, order: int) -> DataFrame:
    """(lang, gram, n) of a DataFrame with columns lang and text; partial counts before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw, off = utf8(b, "text")
            langs = np.array(b.column("lang").to_pylist(), object)
            for rows, begins, ends in pieces(off, PIECE):
                if ends[-1] == begins[0]:
                    continue
                g, bounds = grams(raw, off, rows, begins, ends, order)
                of = np.repeat(langs[rows], bounds[1:] - bounds[:-1])
                for lang in sorted(set(langs[rows])):
                    keys, n = np.unique(g[of == lang], return_counts=True)
                    if len(keys):
                        yield arrow_out(pa.schema([("lang", pa.string()), ("gram", pa.int64()), ("n", pa.int64())]),
                                        {"lang": [lang] * len(keys), "gram": keys.view(np.int64), "n": n})

    part = small_batches(docs).select("lang", "text").mapInArrow(run, "lang string, gram long, n long")
    return part.groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
          order: int = ORDER, sample_bytes: int = SAMPLE_BYTES) -> PpmModel:
    """PPM model from the rows of ``docs`` that have a language, on a bounded sample."""
    known = docs.where(F.col(lang_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.coalesce(F.col(text_col), F.lit("")).alias("text"),
        F.col(id_col).alias("id"))
    sizes = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("n")).collect()}
    languages = sorted(lang for lang, n in sizes.items() if n)
    if not languages:
        return PpmModel([], order, {})
    share = sample_bytes // len(languages)
    limits = F.create_map(*[F.lit(x) for lang in languages for x in (lang, min(1.0, share / sizes[lang]))])
    # rows are drawn by id and text, and equal rows count once, so a repeated id or text doesn't break the bound
    draw = F.shiftrightunsigned(F.xxhash64(F.lit("ppm"), "id", "text"), 11).cast("double") / float(1 << 53)
    sample = known.where(draw < F.coalesce(limits[F.col("lang")], F.lit(0.0))).dropDuplicates(["lang", "id", "text"])
    got = count_grams(sample, order).toArrow()
    lang = np.array(got.column("lang").to_pylist(), object)
    gram = got.column("gram").to_numpy().view(np.uint64)
    n = got.column("n").to_numpy()
    return PpmModel(languages, order, {x: (gram[lang == x], n[lang == x]) for x in languages})


def predict(docs: DataFrame, model: PpmModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, lang_pred, score (probability of the language) and bits per byte."""
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(model)
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = sent.value
        for b in batches:
            raw, off = utf8(b, "__text")
            n = len(off) - 1
            pred, score, rate = np.full(n, "und", object), np.zeros(n), np.zeros(n)
            if m.languages and n:
                size = off[1:] - off[:-1]
                before = np.concatenate([[0], np.cumsum(LETTERS[raw])])
                letters = before[off[1:]] > before[off[:-1]]
                for r in np.flatnonzero(~letters & (size > 0)):
                    letters[r] = any(c.isalpha() for c in raw[off[r]:off[r + 1]].tobytes().decode("utf-8", "replace"))
                bits = m.bits(raw, off)
                best = bits.argmin(axis=1)
                least = bits[np.arange(n), best]
                chance = 1 / np.exp2(-np.minimum(bits - least[:, None], 1000)).sum(axis=1)
                pred[letters] = np.array(m.languages, object)[best[letters]]
                score[letters] = chance[letters]
                rate[letters] = least[letters] / size[letters]
            ids = b.column(0)
            yield arrow_out(pa.schema([(id_col, ids.type), ("lang_pred", pa.string()), ("score", pa.float64()), ("bits_per_byte", pa.float64())]),
                            {id_col: ids, "lang_pred": list(pred), "score": score, "bits_per_byte": rate})

    return small_batches(docs).select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, lang_pred string, score double, bits_per_byte double")
