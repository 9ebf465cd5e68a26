"""Memory of Python tasks: what one task holds doesn't grow with the rows of a batch or the number of different words."""

import random
import tracemalloc
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer

from govlake.llm import toxicity
from govlake.llm.bpe import Encoder, Vocabulary
from govlake.llm.common import freed

MB = 1 << 20


class Caught:
    """Stands for a DataFrame; keeps the function over Arrow batches."""

    def select(self, *_):
        return self

    groupBy = agg = select

    def mapInArrow(self, run, _):
        self.run = run
        return self


def counting_task(monkeypatch, bits):
    monkeypatch.setattr(toxicity, "small_batches", lambda df: df)
    caught = Caught()
    toxicity.document_counts(caught, bits)
    return caught.run


def labelled(texts, y):
    return pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(y, pa.int32())], names=["text", "y"])


def total(batches):
    out = Counter()
    for b in batches:
        for feature, toxic, other in zip(*[b.column(n).to_pylist() for n in ("feature", "toxic", "other")]):
            out[feature, 1] += toxic
            out[feature, 0] += other
    return +out


def test_document_counts_of_many_batches(spark, monkeypatch):
    rng = random.Random(8)
    texts = ["".join(rng.choices("abc dé", k=rng.choice([0, 3, 40, 3000, 90_000]))) for _ in range(90)] + [None, "", "x"]
    y = [rng.randint(0, 1) for _ in texts]
    want = Counter()
    for text, label in zip(texts, y):
        raw = np.frombuffer((text or "").encode(), np.uint8)
        for f in set(toxicity.present(raw, np.array([0, len(raw)]), np.ones(1 << 12, bool), 12)[1].tolist()):
            want[f, label] += 1
    run = counting_task(monkeypatch, 12)
    batches = [labelled(texts[i:i + 31], y[i:i + 31]) for i in range(0, len(texts), 31)]
    assert total(run(iter(batches))) == want
    assert list(run(iter([]))) == [] == list(run(iter([labelled([], [])])))


def test_document_counts_memory_of_a_full_batch(spark, monkeypatch):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(97, 123, 2500, np.uint8)).decode() for _ in range(1000)]
    run = counting_task(monkeypatch, toxicity.BITS)
    batch = labelled(texts, [i % 2 for i in range(1000)])
    tracemalloc.start()
    try:
        for _ in run(iter([batch])):
            pass
        assert tracemalloc.get_traced_memory()[1] < 150 * MB
    finally:
        tracemalloc.stop()


def test_encoder_memory_of_many_different_words():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder = Encoder(Vocabulary(path))
    rng = random.Random(2)
    texts = ["".join(f" {w}{rng.getrandbits(20)}x" if w != "the" else " the" for w in rng.choices(["the", "qu", "ä"], k=3000))
             + " " + " ".join("".join(rng.choices("abcdefgh", k=7)) for _ in range(3000)) for _ in range(60)]
    tracemalloc.start()
    try:
        got = [[] for _ in texts]
        for number, ids in encoder.encode_many(texts):
            got[number].append(ids)
        assert tracemalloc.get_traced_memory()[1] < 50 * MB
    finally:
        tracemalloc.stop()
    for mine, want in zip(got, Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)):
        assert np.frombuffer(b"".join(mine), "<u4").tolist() == want.ids


def test_freed_passes_all_batches():
    batches = [labelled(["a"], [1]), labelled([], [])]
    assert list(freed(lambda rows: (b for b in rows))(iter(batches))) == batches
