"""Periodic runs against brute force over all periods; the grammar's extensions against plain comparison."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from llm_fixtures import prose

from govlake.llm import periodic_runs as pr
from govlake.llm.queries import op12_periodic_runs

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def brute_force(words, min_length=pr.MIN_LENGTH):
    """All maximal stretches of each period, the smallest period of equal stretches."""
    n, out = len(words), {}
    for p in range(1, n // 2 + 1):
        i = 0
        while i + p < n:
            j = i
            while j + p < n and words[j] == words[j + p]:
                j += 1
            if j > i and j - i + p >= max(min_length, 2 * p):
                out.setdefault((i, j - i + p), p)
            i = max(j, i + 1)
    return sorted(((s, n, p) for (s, n), p in out.items()), key=lambda r: (r[0], r[2]))


def collapsed(words, runs):
    dropped = {i for s, n, p in runs for i in range(s + p, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in dropped)


def sequences(rng, count):
    for _ in range(count):
        n, letters = rng.randint(0, 130), rng.choice([1, 2, 3, 30])
        words = [rng.randrange(letters) for _ in range(n)]
        for _ in range(rng.randint(0, 2) if n else 0):
            q, s = rng.randint(1, 20), rng.randrange(n)
            for i in range(s + q, min(n, s + rng.randint(2, 6) * q)):
                words[i] = words[i - q]
        yield words


def by_text(found, texts):
    out = [[] for _ in range(texts)]
    for t, *run in zip(*(v.tolist() for v in found)):
        out[t].append(tuple(run))
    return out


@pytest.mark.parametrize("min_length", [2, 5, 12, 40])
def test_equals_brute_force(min_length, monkeypatch):
    rng = random.Random(min_length)
    for chunk in (3, 1000, pr.CHUNK):
        monkeypatch.setattr(pr, "CHUNK", chunk)
        for _ in range(40):
            texts = list(sequences(rng, rng.randint(0, 9)))
            flat = np.array([w for t in texts for w in t], np.int64)
            found = pr.find_runs(flat, np.array([len(t) for t in texts], np.int64), min_length)
            assert by_text(found, len(texts)) == [brute_force(t, min_length) for t in texts]


def test_extensions():
    rng = np.random.default_rng(4)
    for letters in (1, 2, 5, 50):
        s = rng.integers(0, letters, 300)
        s[100:200] = s[90:190]
        s = np.concatenate([[letters], s, [letters + 1]])
        x = rng.integers(1, 299, 500)
        y = x + rng.integers(1, 301 - x)
        grammar = pr.Grammar(s)
        for step, got in ((1, grammar.extend(x, y, 1)), (-1, grammar.extend(x, y, -1))):
            for a, b, k in zip(x, y, got):
                assert all(s[a + step * i] == s[b + step * i] for i in range(k)) and s[a + step * k] != s[b + step * k]


def test_grammar_shrinks():
    """Levels expand to the words again, and a periodic sequence needs few of them."""
    s = np.concatenate([[9], np.tile(np.arange(7), 5000), [10]])
    grammar = pr.Grammar(s)
    for k in range(1, 30):
        level, below = grammar.level(k), grammar.levels[k - 1]
        size = np.diff(level.start)
        assert size.sum() == len(below.symbols) and (level.parent == np.repeat(np.arange(len(size)), size)).all()
        assert len(set(zip(level.symbols.tolist(), size.tolist()))) == len(set(level.symbols.tolist()))
    assert len(grammar.levels[29].symbols) < 20


def test_operator_on_odd_texts(make_docs, odd_docs, rows_of, texts_of):
    for docs in (odd_docs, make_docs([])):
        got = sorted((r["doc_id"] is None, r["doc_id"], r["n_words"], [tuple(x.values()) for x in r["runs"]], r["collapsed"])
                     for r in rows_of(pr.periodic_runs(docs)))
        want = []
        for i, t in texts_of(docs):
            words = SPACE.findall(t or "")
            runs = brute_force(words)
            want.append((i is None, i, len(words), runs, collapsed(words, runs)))
        assert got == sorted(want)


def test_pieces_change_nothing(make_docs, rows_of, monkeypatch):
    rng = random.Random(1)
    texts = [prose(rng, rng.randint(0, 40)) * rng.randint(1, 4) for _ in range(60)] + ["x " * 5000, None, "\x0b\x0c", "é\x0b" * 30]
    whole = rows_of(pr.periodic_runs(make_docs(texts)))
    sizes = [0, *np.cumsum([len((t or "").encode()) for t in texts])]
    groups = list(pr._row_groups(np.array(sizes), 300))
    assert groups[0][0] == 0 and groups[-1][1] == len(texts) and all(a[1] == b[0] for a, b in zip(groups, groups[1:]))
    for r, t in zip(sorted(whole, key=lambda r: r["doc_id"]), texts):
        words = SPACE.findall(t or "")
        assert [tuple(x.values()) for x in r["runs"]] == brute_force(words)


def contract_row(doc_id, text):
    words = SPACE.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    runs = brute_force(words)
    best = max(runs, key=lambda r: (r[1], -r[0], -r[2]), default=None)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
    return (doc_id, len(runs), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, sha(lines), sha(collapsed(words, runs)))


def test_query_on_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in op12_periodic_runs(spark, sf).collect()}
    small = [r for r in docs if len(r["text"] or "") < 8000]
    assert len(got) == len(docs) and len(small) > 150
    for r in small:
        assert got[r["doc_id"]] == contract_row(*r)


def test_query_on_odd_rows(odd_docs, texts_of, tmp_path, spark):
    odd_docs.write.parquet(f"{tmp_path}/documents.parquet")
    key = lambda r: (r[0] is None, r[0] or 0, r[6], r[7])
    got = sorted(map(tuple, op12_periodic_runs(spark, str(tmp_path)).collect()), key=key)
    want = sorted((contract_row(i, t) if i is not None else (None, *contract_row(1, t)[1:]) for i, t in texts_of(odd_docs)), key=key)
    assert got == want
