"""Quality and toxicity classifiers: features against a direct computation, updates, odd inputs, held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest

from govlake.llm import quality, toxicity
from govlake.llm.ftrl import Ftrl, labelled_sample
from govlake.llm.queries import op2_language_id, op4_quality, op7_toxicity


def test_ftrl_matches_the_update_rule():
    solver = Ftrl(alpha=0.3, beta=1.0, l1=0.1, l2=0.2, epochs=2)
    rows = [(np.array([0, 2]), np.array([1.0, 2.0])), (np.array([1]), np.array([-1.0])), (np.array([0, 1]), np.array([0.5, 1.0]))]
    labels = np.array([1.0, 0.0, 1.0])
    z, n, w = [0.0] * 4, [0.0] * 4, [0.0] * 4
    prior = np.log(2.5 / 1.5)
    for _ in range(2):
        for (idx, val), y in zip(rows, labels):
            pairs = [*zip(idx, val), (3, 1.0)]
            for i, _ in pairs:
                l1, l2 = (0, 0) if i == 3 else (0.1, 0.2)
                w[i] = 0.0 if abs(z[i]) <= l1 else -(z[i] - np.sign(z[i]) * l1) / ((1 + n[i] ** 0.5) / 0.3 + l2)
            p = 1 / (1 + np.exp(-prior - sum(w[i] * v for i, v in pairs)))
            for i, v in pairs:
                g = (p - y) * v
                s = ((n[i] + g * g) ** 0.5 - n[i] ** 0.5) / 0.3
                z[i] += g - s * w[i]
                n[i] += g * g
    got = solver.fit(rows, labels, 3)
    for i in range(3):
        want = 0.0 if abs(z[i]) <= 0.1 else -(z[i] - np.sign(z[i]) * 0.1) / ((1 + n[i] ** 0.5) / 0.3 + 0.2)
        assert got[i] == pytest.approx(want)


def test_word_features_are_tokens_and_pairs(monkeypatch):
    text = "The cat!! the  cat\nsat sat é-x"
    tokens = re.findall(r"[A-Za-z0-9\x80-\xff]+|[^A-Za-z0-9\x80-\xff\s]+", text.encode().decode("latin-1"))
    pairs = list(zip(tokens, tokens[1:]))
    want = Counter([*Counter(tokens).values(), *Counter(pairs).values(), sum(a == b for a, b in pairs)])
    raw = np.frombuffer(text.encode(), np.uint8)
    parts = list(quality.features(raw, np.array([0, len(raw)])))
    assert Counter(parts[0][2].tolist()) == want
    # the same text at another place of a batch has the same features
    two = np.concatenate([np.frombuffer(b"zz ", np.uint8), raw])
    again = list(quality.features(two, np.array([0, 3, len(two)])))[0]
    assert set(again[1][again[0] == 1]) == set(parts[0][1])


def test_character_features_are_present_once():
    text = b"Abba abba\tABBA"
    low = b" " + text.lower().replace(b"\t", b" ")
    want = sum(len({low[i - n:i] for i in range(n, len(low) + 1)}) for n in toxicity.SIZES)
    every = np.ones(1 << toxicity.BITS, bool)
    row, f = toxicity.present(np.frombuffer(text, np.uint8), np.array([0, 0, len(text)]), every)
    short = sum(n - 2 for n in toxicity.SIZES)  # grams that reach before the blank
    assert set(row) == {1} and want <= len(f) <= want + short


def test_pieces_do_not_change_character_scores(monkeypatch):
    raw = np.frombuffer(b"some words that are cut at every place " * 5, np.uint8)
    every = np.ones(1 << toxicity.BITS, bool)
    whole = toxicity.present(raw, np.array([0, len(raw)]), every)
    monkeypatch.setattr(toxicity, "PIECE", 11)
    cut = toxicity.present(raw, np.array([0, len(raw)]), every)
    assert (whole[1] == cut[1]).all()


@pytest.mark.parametrize("which", ["quality", "toxicity"])
def test_odd_documents(spark, odd_docs, make_docs, rows_of, texts_of, which):
    labels = spark.createDataFrame([(0, 1, 1), (1, 1, 1), (3, 0, 0), (4, 0, 0), (5, 0, 0), (None, 1, 1), (9, None, None), (99, 1, 1), (3, 0, 0)],
                                   "doc_id long, quality int, toxic int")
    if which == "quality":
        models = [quality.fit(labelled_sample(odd_docs, rows, "quality", 100)) for rows in (labels, labels.where("false"))]
        score = quality.score
    else:
        models = [toxicity.learn(odd_docs, rows) for rows in (labels, labels.where("false"))]
        score = toxicity.score
        kept = toxicity.drop_toxic(odd_docs, models[1], threshold=0.6)
        assert kept.columns == odd_docs.columns and sorted(map(repr, rows_of(kept))) == sorted(map(repr, rows_of(odd_docs)))
        assert toxicity.drop_toxic(odd_docs, models[1], threshold=0.5).count() == 0
    for m in models:
        out = rows_of(score(odd_docs, m))
        assert len(out) == odd_docs.count() and all(0 <= r["score"] <= 1 for r in out)
        assert score(make_docs([]), m).count() == 0
    assert {r["score"] for r in out} == {0.5}


def held_out(spark, query, label, modulus, rest):
    sf = "/root/testdata/sf0.1"
    truth = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    out = query(spark, sf).collect()
    assert len(out) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % modulus == rest) for r in out)
    assert all(r["predicted"] == int(r["score"] >= 0.3) for r in out)
    asked = [(r["predicted"], truth[r["doc_id"]]) for r in out if r["held_out"] and r["doc_id"] in truth]
    return sum(p == t for p, t in asked) / len(asked)


def test_quality_held_out_accuracy(spark):
    assert held_out(spark, op4_quality, "quality", 5, 0) > 0.95


def test_toxicity_held_out_accuracy(spark):
    assert held_out(spark, op7_toxicity, "toxic", 4, 2) > 0.95


def test_word_features_do_not_depend_on_the_piece_size(monkeypatch):
    text = ("alpha beta beta " * 40 + "w" * 300 + " gamma, gamma! " * 20).encode()
    raw, off = np.frombuffer(b"first text " + text + b"last one", np.uint8), np.array([0, 11, 11 + len(text), 19 + len(text)])
    def counted():
        out = Counter()
        for row, f, n in quality.features(raw, off):
            for k in zip(row.tolist(), f.tolist(), n.tolist()):
                out[k[:2]] += k[2]
        return out
    whole = counted()
    for size in (5, 64, 333):
        monkeypatch.setattr(quality, "PIECE", size)
        assert counted() == whole


def test_sample_bound_holds_for_repeated_ids(spark):
    """One id holds a third of the rows, with texts of its own and with copies of one text."""
    rows = [(i, f"text {i}") for i in range(2000)] + [(5, f"other {i}") for i in range(1500)] + [(7, "same")] * 1500
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(2000)], "doc_id long, toxic int")
    for most in (300, 1000, 6000):
        got = labelled_sample(docs, labels, "toxic", most).collect()
        assert len(got) <= 1.25 * most and len(got) > 0.4 * min(most, 3501)
        assert len({(r["id"], r["text"]) for r in got}) == len(got)


def test_whole_scores_against_plain_python(spark, make_docs, rows_of):
    """The score of each text from its features by hand and the model's weights."""
    rng = np.random.default_rng(3)
    words = ["river", "stone", "light", "!!", "?", "the", "of"]
    texts = [" ".join(rng.choice(words, rng.integers(0, 30))) for _ in range(40)] + ["", None, "x" * 500]
    idx = np.arange(1 << quality.BITS)
    weights = rng.normal(size=len(idx)).astype(np.float32)
    got = {r["doc_id"]: r["score"] for r in rows_of(quality.score(make_docs(texts), (idx, weights, 0.25)))}
    for i, t in enumerate(texts):
        pairs = [(f, n) for _, fs, ns in quality.features(*_bytes(t)) for f, n in zip(fs, ns)]
        val = np.log1p([n for _, n in pairs])
        x = float(sum(weights[f] * v for (f, _), v in zip(pairs, val)) / max(np.sqrt((val ** 2).sum()), 1e-12)) + 0.25
        assert got[i] == pytest.approx(1 / (1 + np.exp(-x)), abs=1e-6)


def _bytes(text):
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return raw, np.array([0, len(raw)])


def test_null_ids_are_in_no_fold(spark, make_docs, tmp_path):
    docs = make_docs(["river stone light " * 9, "a b c"], [None, 3])
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(3, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for query in (op2_language_id, op4_quality, op7_toxicity):
        assert {r["doc_id"]: r["held_out"] for r in query(spark, str(tmp_path)).collect()}[None] is False
