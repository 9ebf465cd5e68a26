"""PPM against a direct computation from contexts, in pieces and whole; held-out accuracy of the query."""

import math
import zlib
from collections import defaultdict

import numpy as np
import pytest

from govlake.llm import language_id
from govlake.llm.language_id import ExactTable, predict, train
from govlake.llm.queries import op2_language_id


def direct_bits(training, order, text):
    counts = [defaultdict(lambda: defaultdict(int)) for _ in range(order + 1)]
    for t in training:
        p = b"\0" * order + t
        for i in range(order, len(p)):
            for d in range(order + 1):
                counts[d][p[i - d:i]][p[i]] += 1
    total, p = 0.0, b"\0" * order + text
    for i in range(order, len(p)):
        for d in range(order, -2, -1):
            if d < 0:
                total += 8
                break
            seen = counts[d].get(p[i - d:i])
            if not seen:
                continue
            n, u = sum(seen.values()), len(seen)
            if p[i] in seen:
                total -= math.log2(seen[p[i]] / (n + u))
                break
            total -= math.log2(u / (n + u))
    return total


@pytest.mark.parametrize("piece", [7, 1 << 20])
def test_code_lengths_are_exact(spark, make_docs, monkeypatch, piece):
    monkeypatch.setattr(language_id, "PIECE", piece)
    texts = {"da": ["røde heste", "et hus på en bakke"], "en": ["red horses", "a house on a hill", ""], "xx": [None]}
    rows = [(i, t, lang, "s", 0) for i, (lang, t) in enumerate((lang, t) for lang, ts in texts.items() for t in ts)]
    docs = spark.createDataFrame(rows, make_docs([]).schema)
    model = train(docs, order=3)
    assert model.languages == ["da", "en"]
    asked = [b"red hus", "blå heste på hill".encode(), b"", b"\xff\x00zz", b"a"]
    raw, off = np.frombuffer(b"".join(asked), np.uint8), np.concatenate([[0], np.cumsum([len(a) for a in asked])])
    got = model.bits(raw, off)
    for i, text in enumerate(asked):
        for j, lang in enumerate(model.languages):
            want = direct_bits([(t or "").encode() for t in texts[lang]], 3, text)
            assert got[i, j] == pytest.approx(want, rel=1e-5, abs=1e-4)


def test_table_finds_exact_keys():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 5000).astype(np.uint64))
    t = ExactTable(keys)
    assert (keys[t.find(keys)] == keys).all()
    other = np.setdiff1d(rng.integers(0, 1 << 40, 5000).astype(np.uint64), keys)
    assert (t.find(other) == -1).all()
    assert (ExactTable(keys[:0]).find(other) == -1).all()


def test_odd_documents(spark, odd_docs, make_docs, rows_of):
    model = train(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"))
    out = rows_of(predict(odd_docs, model))
    assert len(out) == odd_docs.count()
    by = {(r["doc_id"], r["lang_pred"]) for r in out}
    assert {(5, "und"), (6, "und"), (7, "und"), (8, "und")} <= by
    assert all(0 <= r["score"] <= 1 for r in out)
    assert predict(make_docs([]), model).count() == 0
    nothing = train(make_docs([]))
    assert {r["lang_pred"] for r in rows_of(predict(odd_docs, nothing))} == {"und"}
    digits = make_docs(["123 456 !?", "١٢٣", "Ωμέγα"])
    assert [r["lang_pred"] == "und" for r in sorted(rows_of(predict(digits, model)), key=lambda r: r["doc_id"])] == [True, True, False]


def test_query_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = op2_language_id(spark, sf).collect()
    assert sorted(r["doc_id"] for r in out) == sorted(lang)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in out)
    held = [r for r in out if r["held_out"] and r["lang_pred"] != "und"]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) / len(held) > 0.98
