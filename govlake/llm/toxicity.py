"""Toxicity classifier: linear model on character n-grams scaled by naive Bayes log-count ratios.

Features are the presence of byte n-grams (``SIZES``) of the text, A-Z lower-cased, white
space as one kind of blank, with a blank before the first byte; hashed to 2^BITS numbers.
For feature j the ratio r_j = log((p_j + 1) / (p + 1)) - log((q_j + 1) / (q + 1)), where
p_j of p toxic and q_j of q other training documents hold it. A logistic regression is
trained on x_j = r_j for the features present (``ftrl.py``), and the score is the logistic function
of the sum of w_j r_j.

Training reads a hash sample of about ``sample_rows`` labelled rows; document
frequencies are counted on the executors with partial sums, and only features in at least
``min_docs`` sampled documents and with a ratio of at least ``min_ratio``, either sign, are kept. Scoring reads every text whole.

Edge cases: null counts as empty; an empty text has no feature and gets the bias's score.
With no labelled row, all weights are zero and every score is 0.5; where no feature was learned (no usable
label, labels of one class, too few of them), all texts score alike and ``drop_toxic`` keeps them all, unless
it is given a threshold. Texts above 256 KB
are read in pieces with the bytes before each as context: bounded memory, the same result.
An empty table gives an empty result; rows may repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, freed, pieces, small_batches, sorted_unique, utf8
from .ftrl import Ftrl, dense, labelled_sample, train
from .language_id import grams

BITS = 22
SIZES = (4, 6, 8)
SAMPLE_ROWS = 10_000
MIN_DOCS = 6
MIN_RATIO = 1.0
PIECE = 1 << 18
COUNTED = 1 << 16  # bytes of text whose features are counted together (a text is not cut)
EMITTED = 1 << 18  # features whose counts leave a task together
THRESHOLD = 0.3
SOLVER = Ftrl(alpha=0.05, l1=1.0, l2=1.0, epochs=3)
SHARDS = 4

FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[[9, 10, 11, 12, 13]] = 32


def hashed_grams(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray, list[np.ndarray]]]:
    """(rows, piece bounds, one array of feature numbers per n-gram size), a feature number per position."""
    folded = FOLDED[raw]
    for rows, begins, ends in pieces(offsets, PIECE):
        if ends[-1] == begins[0]:
            continue
        g, bounds = grams(folded, offsets, rows, begins, ends, max(SIZES) - 1, blank=32)
        out = []
        for size in SIZES:
            part = g & np.uint64((1 << (8 * size)) - 1)
            out.append(((part * np.uint64(0x9E3779B97F4A7C15) + np.uint64(size)) * np.uint64(0xD6E8FEB86659FD93)
                        >> np.uint64(64 - bits)).astype(np.int64))
        yield rows, bounds, out


def present(raw: np.ndarray, offsets: np.ndarray, useful: np.ndarray, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """(row, feature) of the useful features that each text holds, once each, sorted."""
    found = []
    for rows, bounds, features in hashed_grams(raw, offsets, bits):
        for f in features:
            at = np.flatnonzero(useful[f])
            if len(at):
                row = rows[np.searchsorted(bounds, at, side="right") - 1].astype(np.uint64)
                found.append(sorted_unique((row << np.uint64(bits)) | f[at].astype(np.uint64)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys = sorted_unique(np.concatenate(found))
    return (keys >> np.uint64(bits)).astype(np.int64), (keys & np.uint64((1 << bits) - 1)).astype(np.int64)


def document_counts(sample: DataFrame, bits: int = BITS) -> DataFrame:
    """(feature, toxic, other): how many sampled documents of each class hold the feature."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = np.ones(1 << bits, bool)
        counts = np.zeros(2 << bits, np.int32)  # of the whole task: other, then toxic
        for b in batches:
            raw, off = utf8(b, "text")
            y = b.column("y").to_numpy(zero_copy_only=False) > 0
            begins = np.flatnonzero(np.diff(off[:-1] // COUNTED, prepend=-1))
            for i, j in zip(begins, np.append(begins[1:], len(y))):
                row, feature = present(raw[off[i]:off[j]], off[i:j + 1] - off[i], every, bits)
                np.add.at(counts, (y[i:j][row].astype(np.int64) << bits) | feature, np.int32(1))
        other, toxic = counts.reshape(2, -1)
        for at in range(0, 1 << bits, EMITTED):
            keys = np.flatnonzero((other[at:at + EMITTED] + toxic[at:at + EMITTED]) > 0) + at
            if len(keys):
                yield arrow_out(pa.schema([("feature", pa.int64()), ("toxic", pa.int64()), ("other", pa.int64())]),
                                {"feature": keys, "toxic": toxic[keys].astype(np.int64), "other": other[keys].astype(np.int64)})

    part = small_batches(sample).select("text", "y").mapInArrow(freed(run), "feature long, toxic long, other long")
    return part.groupBy("feature").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def fit(sample: DataFrame, solver: Ftrl = SOLVER, min_docs: int = MIN_DOCS, min_ratio: float = MIN_RATIO,
        bits: int = BITS, shards: int = SHARDS):
    """(features, w * r, bias) of a labelled sample with columns id, text, y."""
    sizes = sample.agg(F.sum("y").alias("p"), F.count("*").alias("n")).first()
    toxic, other = int(sizes["p"] or 0), int(sizes["n"]) - int(sizes["p"] or 0)
    if not toxic or not other:  # one class only: nothing to tell apart
        p = 1.0 if toxic else -1.0 if other else 0.0
        return np.zeros(0, np.int64), np.zeros(0), 35.0 * p
    counts = document_counts(sample, bits).where(F.col("toxic") + F.col("other") >= min_docs).toArrow()
    feature = counts.column("feature").to_numpy()
    ratio = np.log((counts.column("toxic").to_numpy() + 1) / (toxic + 1)) - np.log((counts.column("other").to_numpy() + 1) / (other + 1))
    order = np.argsort(feature)
    order = order[np.abs(ratio[order]) >= min_ratio]
    feature, ratio = feature[order], ratio[order]
    sent = sample.sparkSession.sparkContext.broadcast((feature, ratio))

    def rows(texts: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        kept, r = sent.value
        r = r.astype(np.float32)
        number = np.full(1 << bits, -1, np.int32)
        number[kept] = np.arange(len(kept))
        out = []
        for at in range(0, len(texts), 100):
            part = texts[at:at + 100]
            off = np.concatenate([[0], np.cumsum([len(t) for t in part])]).astype(np.int64)
            row, f = present(np.frombuffer(b"".join(part), np.uint8), off, number >= 0, bits)
            cuts = np.searchsorted(row, np.arange(len(part) + 1))
            out += [(number[f[a:b]], r[number[f[a:b]]]) for a, b in zip(cuts, cuts[1:])]
        return out

    idx, w, bias = train(sample, rows, len(feature), solver, shards)
    return feature[idx], w * ratio[idx], bias


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = SAMPLE_ROWS):
    """Model from the labelled documents (no rows: all scores 0.5)."""
    return fit(labelled_sample(docs, labels, label_col, sample_rows, id_col, text_col))


def _scorer(model, bits: int):
    """Scores of the texts of a batch, for one task."""
    idx, w, bias = model
    weights = dense(1 << bits, idx, w)
    useful = weights != 0

    def of(batch: pa.RecordBatch, text_col: str) -> np.ndarray:
        raw, off = utf8(batch, text_col)
        row, feature = present(raw, off, useful, bits)
        x = bias + np.bincount(row, weights=weights[feature], minlength=len(off) - 1)
        return 1 / (1 + np.exp(-np.clip(x, -35, 35)))

    return of


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per input row: id and score (0 to 1)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _scorer(sent.value, bits)
        for b in batches:
            ids = b.column(0)
            yield arrow_out(pa.schema([(id_col, ids.type), ("score", pa.float64())]), {id_col: ids, "score": of(b, "__text")})

    return small_batches(docs).select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(
        freed(run), f"`{id_col}` {kind}, score double")


def drop_toxic(docs: DataFrame, model, threshold: float | None = None, text_col: str = "text", bits: int = BITS) -> DataFrame:
    """The rows of ``docs`` that score below the threshold, with all their columns, in one pass without a shuffle.

    Without a threshold it is THRESHOLD, and a model that tells no texts apart keeps all rows.
    """
    if threshold is None:
        if not np.any(model[1]):
            return docs
        threshold = THRESHOLD
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = _scorer(sent.value, bits)
        for b in batches:
            yield b.filter(pa.array(of(b, text_col) < threshold))

    return small_batches(docs).mapInArrow(freed(run), docs.schema)
