"""SimHash: fingerprints and components against brute force."""

import random
from collections import Counter

import pytest
import xxhash

from govlake.llm import simhash
from govlake.llm.queries import op9_simhash
from govlake.llm.simhash import components, fingerprint, keep_one, links, near_groups, pivot_table
from llm_fixtures import prose


def slow_fingerprint(text, k=3):
    import re
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x20\x09-\x0D]+", low)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def slow_components(prints, bits):
    keys = sorted(set(prints))
    up = {k: k for k in keys}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for i, a in enumerate(keys):
        for b in keys[:i]:
            if (a ^ b).bit_count() <= bits:
                up[find(a)] = find(b)
    return {k: find(k) for k in keys}


def test_fingerprint_matches_definition(odd_docs, texts_of):
    for _, t in [*texts_of(odd_docs), (0, "Ab aB\x0bÀ\xa0b c"), (0, "one two"), (0, "a b c")]:
        assert fingerprint((t or "").encode()) == slow_fingerprint(t)


def test_groups_of_odd_documents(odd_docs, make_docs, rows_of, texts_of):
    pairs = texts_of(odd_docs)
    prints = [slow_fingerprint(t) for _, t in pairs]
    root = slow_components(prints, 2)
    first = {}
    for (i, _), f in zip(pairs, prints):
        if i is not None:
            first[root[f]] = min(i, first.get(root[f], i))
    got = Counter((r["doc_id"], r["fp"] % (1 << 64), r["component_id"]) for r in rows_of(near_groups(odd_docs)))
    assert got == Counter((i, f, first.get(root[f])) for (i, _), f in zip(pairs, prints))
    kept = keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(set(i for i, _ in texts_of(kept) if i is not None)) == sorted(set(first.values()))
    assert near_groups(make_docs([])).count() == 0 and keep_one(make_docs([])).count() == 0


@pytest.mark.parametrize("limit", [200, 3])  # small files paired; every file linked by pivots
def test_links_connect_exactly_the_neighbours(spark, monkeypatch, limit):
    monkeypatch.setattr(simhash, "FILE_LIMIT", limit)
    rng = random.Random(limit)
    values = [0, (1 << 64) - 1]
    for _ in range(25):
        base = rng.getrandbits(64)
        values.append(base)
        for _ in range(rng.randint(0, 12)):
            values.append(values[-1] ^ sum(1 << b for b in rng.sample(range(64), rng.choice([1, 2, 3]))))
    cluster = rng.getrandbits(64)
    values += [cluster ^ rng.getrandbits(6) for _ in range(40)]
    values = sorted(set(values))
    signed = [v - (1 << 64) if v >> 63 else v for v in values]
    fps = spark.createDataFrame([(v,) for v in signed], "fp long")
    pairs = links(fps)
    if limit == 200:
        want = {(min(a, b), max(a, b)) for i, a in enumerate(signed) for b in signed[:i] if ((a ^ b) % (1 << 64)).bit_count() <= 2}
        assert {(r["a"], r["b"]) for r in pairs.collect()} == want
    got = {r["node"]: r["label"] for r in components(pairs).collect()}
    root = slow_components(values, 2)
    mine = {v: got.get(s, s) for v, s in zip(values, signed)}
    assert len({(root[v], mine[v]) for v in values}) == len(set(root.values())) == len(set(mine.values()))


def test_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)], "a long, b long")
    assert {r["label"] for r in components(edges).collect()} == {0}


def test_pivot_distances_bound_the_bit_distance(spark):
    rng = random.Random(2)
    a = rng.getrandbits(63)
    b = a ^ 5
    rows = {r["fp"]: r for r in pivot_table(spark.createDataFrame([(a,), (b,)], "fp long"), 4).collect()}
    assert max(abs(x - y) for x, y in zip(rows[a]["d"], rows[b]["d"])) <= 2
    assert sum(rows[a][f"p{i}"] == rows[b][f"p{i}"] for i in range(4)) >= 2


def test_query_on_the_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    prints = {r["doc_id"]: slow_fingerprint(r["text"]) for r in docs}
    root = slow_components(prints.values(), 2)
    first = {}
    for i, f in prints.items():
        first[root[f]] = min(i, first.get(root[f], i))
    got = {(r["doc_id"], r["fingerprint"], r["component_id"]) for r in op9_simhash(spark, "/root/testdata/sf0.001").collect()}
    assert got == {(i, f"{f:016x}", first[root[f]]) for i, f in prints.items()}


def test_one_row_of_each_component_is_kept(make_docs, texts_of):
    rng = random.Random(41)
    a, b, c = (prose(rng, 200) for _ in range(3))
    rows = [(None, a), (None, a), (None, a.upper()), (7, b), (7, c), (7, c), (8, c), (9, b), (None, b), (6, c.upper()), (None, None), (None, "")]
    docs = make_docs([t for _, t in rows], [i for i, _ in rows], ["id", "n"]).coalesce(1)
    kept = keep_one(docs)
    assert kept.columns == docs.columns
    got = Counter((i, (t or "").lower()) for i, t in texts_of(kept))
    assert got == Counter([(None, a), (7, b), (6, c), (None, "")])
