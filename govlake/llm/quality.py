"""Quality classifier: logistic regression on hashed word n-grams, trained with FTRL updates.

Tokens are runs of word bytes (letters, digits, non-ASCII) or runs of other visible bytes;
case counts. Features are the hashed tokens, the pairs of neighbouring tokens and one for "the
same token again", weighted by
log(1 + count) and scaled to length 1 per document; the score is the logistic function of
one sparse dot product. Tokens are found and hashed for a whole batch at once (prefix sums of
a polynomial hash).

Training: FTRL-proximal over a hash sample of about ``sample_rows`` labelled rows
(``ftrl.py``). Scoring reads every text whole.

Edge cases: null counts as empty; an empty text has no feature and gets the bias's score.
With no labelled row, all weights are zero and every score is 0.5. Texts above 1 MB
are read in pieces cut at white space (a pair across a cut is not counted): bounded
memory. An empty table gives an empty result; rows may repeat; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_out, pieces, small_batches, utf8
from .ftrl import Ftrl, dense, train

BITS = 20
SAMPLE_ROWS = 16_000
PIECE = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
MIX = np.uint64(0xD6E8FEB86659FD93)

KIND = np.full(256, 2, np.uint8)
KIND[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = 1
KIND[[9, 10, 11, 12, 13, 32]] = 0


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return (h ^ (h >> np.uint64(29))) * MIX


class Powers:
    """Powers of the hash base and of its inverse modulo 2^64."""

    forward = backward = np.ones(1, np.uint64)

    @classmethod
    def up_to(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.forward) < n:
            with np.errstate(over="ignore"):
                for name, x in (("forward", BASE), ("backward", pow(BASE, -1, 1 << 64))):
                    steps = np.full(n, x, np.uint64)
                    steps[0] = 1
                    setattr(cls, name, np.cumprod(steps))
        return cls.forward[:n], cls.backward[:n]


def span_hashes(data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of the bytes, from one prefix sum."""
    forward, backward = Powers.up_to(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * forward[:-1], out=sums[1:])
    return mixed((sums[ends] - sums[begins]) * backward[begins])


def token_spans(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begins, ends) of the tokens; a token ends where the kind of byte changes and where a piece ends."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = KIND[data]
    edge = np.empty(len(data), bool)
    edge[0] = True
    np.not_equal(kind[1:], kind[:-1], out=edge[1:])
    edge[bounds[(bounds > 0) & (bounds < len(data))]] = True
    begins = np.flatnonzero(edge)
    ends = np.append(begins[1:], len(data))
    real = kind[begins] > 0
    return begins[real], ends[real]


def features(raw: np.ndarray, offsets: np.ndarray, bits: int = BITS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, feature, count) of the texts, in pieces; a text above the piece size comes several times.

    The last token of a piece is carried into the next one of the same text, so the pair across the cut counts too.
    """
    carried: tuple[int, np.uint64] | None = None
    for rows, begins, ends in pieces(offsets, PIECE, raw):
        data = raw[begins[0]:ends[-1]]
        bounds = np.append(begins, ends[-1]) - begins[0]
        b, e = token_spans(data, bounds)
        if not len(b):
            continue
        of = np.searchsorted(bounds, b, side="right") - 1
        one = before = span_hashes(data, b, e)
        of_before = of
        if carried and carried[0] == rows[0] and begins[0] > offsets[rows[0]]:
            before, of_before = np.append(carried[1], one), np.append(0, of)
        carried = (int(rows[-1]), one[-1])
        same = of_before[1:] == of_before[:-1]
        two = mixed(before[:-1] * np.uint64(31) + before[1:])[same]
        twice = same & (before[:-1] == before[1:])  # a pair of equal tokens also counts as "the same again"
        idx = np.concatenate([one, two, np.full(twice.sum(), MIX)]) >> np.uint64(64 - bits)
        own = np.concatenate([of, of_before[:-1][same], of_before[:-1][twice]]).astype(np.uint64)
        keys, n = np.unique((own << np.uint64(bits)) | idx, return_counts=True)
        yield rows[(keys >> np.uint64(bits)).astype(np.int64)], (keys & np.uint64((1 << bits) - 1)).astype(np.int64), n


def sparse_rows(texts: list[bytes], bits: int = BITS) -> list[tuple[np.ndarray, np.ndarray]]:
    """(indices, values) of each text, scaled to length 1."""
    off = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    parts = list(features(np.frombuffer(b"".join(texts), np.uint8), off, bits))
    if not parts:
        return [(np.zeros(0, np.int64), np.zeros(0))] * len(texts)
    row, idx, n = (np.concatenate(x) for x in zip(*parts))
    keys, place = np.unique((row << bits) | idx, return_inverse=True)
    val = np.log1p(np.bincount(place, weights=n))
    row, idx = keys >> bits, keys & ((1 << bits) - 1)
    cuts = np.searchsorted(row, np.arange(len(texts) + 1))
    return [(idx[a:b], val[a:b] / max(np.sqrt((val[a:b] ** 2).sum()), 1e-12)) for a, b in zip(cuts, cuts[1:])]


def fit(sample: DataFrame, solver: Ftrl = Ftrl(alpha=2.0, l1=0.01, l2=0.0, epochs=4), bits: int = BITS, shards: int = 4):
    """(indices, weights, bias) of a labelled sample with columns id, text, y."""
    return train(sample, lambda texts: sparse_rows(texts, bits), 1 << bits, solver, shards)


def score(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", bits: int = BITS) -> DataFrame:
    """One row per input row: id and score (0 to 1)."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    kind = docs.select(F.col(id_col)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, w, bias = sent.value
        weights = dense(1 << bits, idx, w)
        for b in batches:
            raw, off = utf8(b, "__text")
            n = len(off) - 1
            dot, square = np.zeros(n), np.zeros(n)
            long = np.flatnonzero(off[1:] - off[:-1] > PIECE)  # the counts of their pieces are added up first
            held = {int(r): [] for r in long}
            for row, feature, count in features(raw, off, bits):
                if held and int(row[0]) in held:
                    held[int(row[0])].append((feature, count))
                    continue
                val = np.log1p(count)
                dot += np.bincount(row, weights=val * weights[feature], minlength=n)
                square += np.bincount(row, weights=val * val, minlength=n)
            for r, parts in held.items():
                if parts:
                    keys, place = np.unique(np.concatenate([f for f, _ in parts]), return_inverse=True)
                    val = np.log1p(np.bincount(place, weights=np.concatenate([c for _, c in parts])))
                    dot[r], square[r] = val @ weights[keys], val @ val
            x = dot / np.sqrt(np.maximum(square, 1e-24)) + bias
            ids = b.column(0)
            yield arrow_out(pa.schema([(id_col, ids.type), ("score", pa.float64())]),
                            {id_col: ids, "score": 1 / (1 + np.exp(-np.clip(x, -35, 35)))})

    return small_batches(docs).select(F.col(id_col), F.col(text_col).cast("string").alias("__text")).mapInArrow(
        run, f"`{id_col}` {kind}, score double")
