"""Cross-tokenizer alignment against brute force over all token pairs."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from llm_fixtures import prose
from tokenizers import Tokenizer

from govlake.llm import token_alignment as ta
from govlake.llm.common import staged
from govlake.llm.queries import op11_token_alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=B)


def byte_ranges(sizes):
    ends = np.cumsum(sizes).tolist()
    return list(zip([0, *ends], ends))


def brute_force(texts, libraries):
    """Per text: n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256, from byte ranges alone."""
    a, b = libraries
    of_a = ta.ByteVocabulary(A).of_id
    rows = []
    for t in texts:
        ids_a, ids_b = (a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)) if t else ([], [])
        bytes_a = [of_a[i] for i in ids_a]
        bytes_b = [bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i in ids_b for p in [b.id_to_piece(i)]]
        if not t or not b"".join(bytes_a) == b"".join(bytes_b) == (" " + t).encode():
            rows.append(([], [], "", []))
            continue
        ranges_a, ranges_b = byte_ranges([len(x) for x in bytes_a]), byte_ranges([len(x) for x in bytes_b])
        common = sorted({e for _, e in ranges_a} & {e for _, e in ranges_b})
        groups = []
        for low, high in zip([0, *common], common):
            groups.append("|".join(",".join(str(i) for i, (s, e) in zip(ids, ranges) if low <= s and e <= high)
                                   for ids, ranges in ((ids_a, ranges_a), (ids_b, ranges_b))))
        links = [(i, j) for i, (s, e) in zip(ids_a, ranges_a) for j, (u, v) in zip(ids_b, ranges_b) if s < v and u < e]
        rows.append((ids_a, ids_b, ";".join(groups), links))
    counts = Counter(x for r in rows for x in r[3])
    top = {}
    for (_, j), n in counts.items():
        top[j] = max(top.get(j, 0), n)
    return [(len(x), len(y), g.count(";") + 1 if g else 0, len(ln), sum(counts[p] == top[p[1]] for p in ln), sum(counts[p] for p in ln),
             hashlib.sha256(g.encode()).hexdigest() if g else "") for x, y, g, ln in rows]


def report(docs, most=ta.FREQUENT_PAIRS):
    rows = staged(ta.summarise(ta.align_documents(docs, A, B), A, B), "aligned")
    return ta.alignment_report(rows, most=most)


def strange_texts():
    rng = random.Random(8)
    out = [None, "", " ", "a", "  a  b ", "</s> <s> <|endoftext|> <unk> <0x41>", "U+2581 ▁ here", "日本語の文 é 😀😀\r\n\tx", "naïve café ﬁ",
           "a" * 900, " " * 77, "\x00\x01 b", "it's we'll 12345 9.5%"]
    letters = [*"ab '\n1-=_éñ中😀 ", "the", "ing", " of", "  "]
    out += ["".join(rng.choices(letters, k=rng.randint(1, 150))) for _ in range(60)]
    out += [prose(rng, 60) for _ in range(20)]
    return out


@pytest.mark.parametrize("most", [ta.FREQUENT_PAIRS, 20, 0])
def test_equals_brute_force(make_docs, libraries, most):
    """With all, few and no pairs in the broadcast."""
    texts = strange_texts()
    texts += texts[:3] + texts[20:24]
    ids = [*range(len(texts) - 3), None, None, 5]
    got = report(make_docs(texts, ids, ["rid", "links", "n"]), most).drop("doc_id").collect()
    assert sorted(map(tuple, got)) == sorted(brute_force(texts, libraries))


def test_ids_stay_with_their_rows(make_docs, libraries):
    texts = strange_texts()
    got = {r["doc_id"]: tuple(r)[1:] for r in report(make_docs(texts)).collect()}
    assert [got[i] for i in range(len(texts))] == brute_force(texts, libraries)


def test_slices_change_nothing(libraries):
    rng = random.Random(2)
    a, b = ta.ByteVocabulary(A), ta.PieceModel(B)
    assert b.sliced
    for text in [prose(rng, 3000), "  x \n y  " * 900, "é " * 5000, "  a  b " * 700]:
        parts = ta.slices(text, 50)
        assert " ".join(parts) == text and len(parts) > 1
        assert [i for p in parts for i in a.encode([" " + p])[0]] == libraries[0].encode(" " + text, add_special_tokens=False).ids
        assert [i for p in parts for i in b.encode([p])[0]] == libraries[1].encode(text)


def test_staircase_on_random_arrays():
    """Every step ends a token, in order, and 3 is exactly where both end; long one-to-one runs with shifts between them."""
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(1, 300))
        keep = rng.random(2)
        x, y = (np.flatnonzero(np.append(rng.random(n) < max(k, 0.02) ** rng.integers(0, 3), True)) + 1 for k in keep)
        path = ta.staircase(x, y)
        both = np.union1d(x, y)
        assert [int(p) for p in path] == [int(e in x) + 2 * int(e in y) for e in both]


@pytest.mark.parametrize("run", [0, 1, 2, 3, 7, 8, 9, 100])
def test_run_length(run):
    x = np.arange(1, 201, dtype="<u4")
    y = x.copy()
    y[run:] += 1
    y[150:] = x[150:]  # ends that agree again later don't count
    assert ta.run_length(x.tobytes(), y.tobytes(), 0, 0, 200) == run
    assert ta.run_length(x.tobytes(), x.tobytes(), 5, 5, 60) == 60


def test_empty_table(make_docs):
    assert report(make_docs([])).collect() == []


def test_query_on_the_given_table(spark, libraries):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    small = [r for r in docs if len(r["text"] or "") < 2000]
    got = {r["doc_id"]: r for r in op11_token_alignment(spark, sf).collect()}
    assert len(got) == len(docs)
    want = brute_force([r["text"] for r in small], libraries)
    for r, w in zip(small, want):  # counts are over all documents, the rest of a row is its own
        g = got[r["doc_id"]]
        assert (g["n_a"], g["n_b"], g["n_groups"], g["n_links"], g["groups_sha256"]) == (*w[:4], w[6])
        assert g["count_sum"] >= w[5]
