"""Logistic regression by follow-the-regularised-leader (FTRL-proximal) updates on sparse rows, and its training on Spark.

The labelled sample is dealt to a fixed number of shards by a hash of the id. Each shard
runs the updates over its rows in hash order, ``epochs`` times, in one task; the shards'
weights are averaged. Sample and shards are bounded by parameters, so no task and no
message grows with the corpus.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import hash_sample


@dataclass(frozen=True)
class Ftrl:
    """Step sizes alpha and beta, penalties l1 and l2, passes over the rows."""

    alpha: float = 0.2
    beta: float = 1.0
    l1: float = 0.5
    l2: float = 1.0
    epochs: int = 4

    def fit(self, rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, size: int) -> np.ndarray:
        """Weights of ``size`` features and, last, the bias (not penalised). A row is (indices, values).

        The bias starts at the log-odds of the labels, so that few rows do not leave it at even odds.
        """
        z, n = np.zeros(size + 1), np.zeros(size + 1)
        prior = float(np.log((labels.sum() + 0.5) / (len(labels) - labels.sum() + 0.5))) if len(labels) else 0.0

        def weights(i):
            zi, ni = z[i], n[i]
            w = (np.sign(zi) * self.l1 - zi) / ((self.beta + np.sqrt(ni)) / self.alpha + self.l2)
            w[np.abs(zi) <= self.l1] = 0
            return w

        bias = 0.0
        for _ in range(self.epochs):
            for (idx, val), y in zip(rows, labels):
                w = weights(idx)
                p = 1 / (1 + np.exp(-np.clip(w @ val + bias + prior, -35, 35)))
                g = (p - y) * val
                s = (np.sqrt(n[idx] + g * g) - np.sqrt(n[idx])) / self.alpha
                z[idx] += g - s * w
                n[idx] += g * g
                gb = p - y
                sb = (np.sqrt(n[size] + gb * gb) - np.sqrt(n[size])) / self.alpha
                z[size] += gb - sb * bias
                n[size] += gb * gb
                bias = -z[size] * self.alpha / (self.beta + np.sqrt(n[size]))
        return np.append(weights(np.arange(size)), bias + prior)


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, rows: int,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text, y) of about ``rows`` labelled documents.

    The labels are sampled first, so the join's small side has about ``rows`` rows whatever
    the size of the corpus, and the texts of other rows are not moved. Where ids repeat, rows of equal id and text
    count once and the others are sampled anew by id and text, so the bound holds for any skew.
    Several labels of one document count as the largest; null labels and null ids are not used.
    """
    known = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where(
        "id is not null and y is not null").groupBy("id").agg(F.max("y").alias("y"))
    picked = hash_sample(known, F.col("id"), rows, known.count())
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    met = texts.join(F.broadcast(picked), "id")
    n = met.count()  # reads ids only
    if n > picked.count():
        met = hash_sample(met, F.xxhash64("id", "text"), rows, n, "rows").dropDuplicates(["id", "text"])
    return met


def train(sample: DataFrame, features: Callable[[list[bytes]], list[tuple[np.ndarray, np.ndarray]]], size: int,
          solver: Ftrl, shards: int = 4) -> tuple[np.ndarray, np.ndarray, float]:
    """(indices, weights, bias) averaged over the shards; features makes (indices, values) of texts."""

    def one(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["at", "id"], kind="stable")
        texts, y = [t.encode() for t in pdf.pop("text")], pdf.y.to_numpy(float)
        w = solver.fit(features(texts), y, size)
        idx = np.flatnonzero(w)
        return pd.DataFrame({"idx": idx, "w": w[idx], "shard": np.full(len(idx), key[0], np.int32)})

    dealt = sample.withColumn("at", F.xxhash64(F.lit("order"), "id")).withColumn(
        "shard", F.pmod(F.xxhash64(F.lit("shard"), "id"), F.lit(shards)).cast("int"))
    got = dealt.groupBy("shard").applyInPandas(one, "idx long, w double, shard int")
    got = got.groupBy("idx").agg(F.sum("w").alias("w"), F.collect_set("shard").alias("of")).toPandas()
    used = max(len({s for of in got["of"] for s in of}), 1)
    idx, w = got.idx.to_numpy(np.int64), got.w.to_numpy(float) / used
    at_bias = idx == size
    return idx[~at_bias], w[~at_bias], float(w[at_bias].sum())


def dense(size: int, idx: np.ndarray, w: np.ndarray) -> np.ndarray:
    out = np.zeros(size, np.float32)
    out[idx] = w
    return out
