"""Greedy string tiling against a slow version; planted, reordered and clean documents."""

import random

import pytest

from govlake.llm.decontaminate import contamination, drop_leaks, tile, tokens
from govlake.llm.queries import op1_decontaminate
from llm_fixtures import CLASHING, prose


def slow_tiles(item, runs, k):
    """Covered tokens of the plain greedy algorithm: the longest unmarked match first."""
    used_i, used_r, covered = set(), set(), []
    while True:
        best = None
        for i in range(len(item)):
            for r, seq in enumerate(runs):
                for j in range(len(seq)):
                    n = 0
                    while (i + n < len(item) and j + n < len(seq) and item[i + n] == seq[j + n]
                           and i + n not in used_i and (r, j + n) not in used_r):
                        n += 1
                    if n >= k and (best is None or n > best[0]):
                        best = (n, i, r, j)
        if best is None:
            return sorted(covered, reverse=True)
        n, i, r, j = best
        used_i |= set(range(i, i + n))
        used_r |= {(r, x) for x in range(j, j + n)}
        covered.append(n)


def test_tiles_are_valid_and_greedy():
    rng = random.Random(7)
    for _ in range(150):
        item = [rng.randrange(6) for _ in range(rng.randint(5, 30))]
        runs = []
        for _ in range(rng.randint(1, 3)):
            seq = [rng.randrange(6) for _ in range(rng.randint(1, 12))]
            a = rng.randrange(len(item))
            runs.append(seq + item[a:a + rng.randint(0, 25)] + [rng.randrange(6) for _ in range(3)])
        tiles = tile(item, runs, 3)
        used_i, used_r = set(), set()
        for i, r, j, n in tiles:
            assert n >= 3 and item[i:i + n] == runs[r][j:j + n]
            assert not used_i & set(range(i, i + n)) and not used_r & {(r, x) for x in range(j, j + n)}
            used_i |= set(range(i, i + n))
            used_r |= {(r, x) for x in range(j, j + n)}
        assert [t[3] for t in tiles] == slow_tiles(item, runs, 3)


def test_no_match_is_left_between_overlapping_excerpts():
    """Excerpts of an item that overlap: the coverage is that of the plain greedy algorithm, and nothing of 5 tokens is left."""
    rng = random.Random(12)
    for number in range(10_000):
        item = list(range(rng.randint(5, 40))) if rng.random() < 0.7 else [rng.randrange(9) for _ in range(rng.randint(5, 25))]
        runs = []
        for _ in range(rng.randint(1, 4)):
            a = rng.randrange(len(item))
            runs.append([99] * rng.randint(0, 1) + item[a:a + rng.randint(1, 20)])
        tiles = tile(item, runs, 5)
        used_i, used_r = set(), set()
        for i, r, j, n in tiles:
            used_i |= set(range(i, i + n))
            used_r |= {(r, x) for x in range(j, j + n)}
        for i in range(len(item) - 4):
            for r, seq in enumerate(runs):
                for j in range(len(seq) - 4):
                    assert (item[i:i + 5] != seq[j:j + 5] or used_i & set(range(i, i + 5))
                            or used_r & {(r, x) for x in range(j, j + 5)})
        if number < 1500:
            assert sum(t[3] for t in tiles) == sum(slow_tiles(item, runs, 5))


def hashes(*texts):
    row, token = tokens(list(texts))
    return [token[row == r].tolist() for r in range(len(texts))]


def test_tokens_of_any_script():
    a, b, c = hashes("Straße ΑΘΗΝΑ“Москва”\u00a0x—y", "STRASSE αθηνα, МОСКВА x y", None)
    assert a == b and len(a) == 5 and c == []
    full, plain = hashes("ＡＢＣ　１２", "abc 12")
    assert full == plain
    assert len(hashes("日本語の文 ok")[0]) == 6 and len(hashes("ภาษาไทย")[0]) == 7
    text = "e\u0301té " * 9 + "漢字 and words " * 40
    assert hashes(text, "漢字")[0] == hashes(text)[0]


def test_slices_cut_no_token(monkeypatch):
    from govlake.llm import decontaminate
    text = ("word " * 30 + "w" * 400 + " 漢字かな " + "é" * 90 + "\n") * 5
    whole = hashes(text, None, text[:50])
    for size in (1, 7, 64, 1000):
        monkeypatch.setattr(decontaminate, "PIECE", size)
        assert hashes(text, None, text[:50]) == whole


def test_short_items_and_scripts_without_spaces(spark, make_docs, rows_of):
    rng = random.Random(3)
    passage = "今日は天気がとても良いので公園まで歩いて行きました"
    thai = "วันนี้อากาศดีมากเราไปเดินเล่นที่สวน"
    bench = spark.createDataFrame([(1, "one two three four"), (2, "alpha beta gamma"), (3, "too short"), (4, passage), (5, thai), (6, "a b c d e")],
                                  "item_id long, text string")
    texts = [f"{prose(rng, 20)} One, two; THREE four {prose(rng, 5)}", "one two three", "x alpha beta gamma one two three four",
             f"前の文。{passage}。次の文", f"ก่อน {thai} หลัง", "too short", "d e a b c", "za b c d ez", prose(rng, 80), "alpha beta delta gamma"]
    got = {r["doc_id"]: r["items"] for r in rows_of(contamination(make_docs(texts), bench)) if r["contaminated"]}
    assert got == {0: [1], 2: [1, 2], 3: [4], 4: [5]}


@pytest.fixture(scope="module")
def planted():
    rng = random.Random(21)
    items = [" ".join(f"{w}{k}" for w in prose(rng, rng.randint(20, 40)).split()) for k in range(6)]
    words = [i.split() for i in items]
    half = len(words[2]) // 2
    texts = {
        "whole": f"{prose(rng, 60)} {items[0]} {prose(rng, 20)}",
        "case and marks": f"{prose(rng, 9)} {items[1].upper().replace(' ', ', ')}! {prose(rng, 5)}",
        "reordered": f"{' '.join(words[2][half:])} {prose(rng, 30)} {' '.join(words[2][:half])}",
        "two items": f"{items[3]} {prose(rng, 4)} {items[4]} {items[3]}",
        "a third only": f"{prose(rng, 10)} {' '.join(words[5][:len(words[5]) // 3])} {prose(rng, 10)}",
        "clean": prose(rng, 300),
    }
    leaked = {"whole": [0], "case and marks": [1], "reordered": [2], "two items": [3, 4]}
    return items, texts, leaked


def test_planted_passages(spark, make_docs, rows_of, planted):
    items, texts, leaked = planted
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, ""), (92, "too short"), (None, None)], "item_id long, text string")
    docs = make_docs(list(texts.values()), extra=CLASHING)
    got = {list(texts)[r["doc_id"]]: r for r in rows_of(contamination(docs, bench))}
    assert {n: r["items"] for n, r in got.items() if r["contaminated"]} == leaked
    assert 0 < got["a third only"]["coverage"] < 0.8 and got["clean"]["coverage"] == 0
    kept = drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert {list(texts)[r["doc_id"]] for r in kept.collect()} == {"a third only", "clean"}


def test_odd_documents(spark, odd_docs, make_docs, rows_of):
    first = odd_docs.where("doc_id = 0").first()["text"]
    bench = spark.createDataFrame([(1, first), (1, first), (2, None)], "item_id long, text string")
    out = rows_of(contamination(odd_docs, bench))
    assert len(out) == odd_docs.count()
    assert sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in out if r["contaminated"]) == [0, 1, 2, 2]
    assert contamination(make_docs([]), bench).count() == 0
    empty = bench.where("false")
    assert not any(r["contaminated"] for r in rows_of(contamination(odd_docs, empty)))
    assert drop_leaks(odd_docs, empty).count() == odd_docs.count()


def test_query_against_plain_search(spark):
    import re
    sf = "/root/testdata/sf0.01"
    words = lambda t: " ".join(re.findall(r"[^\W_]+", (t or "").lower()))
    bench = {r["item_id"]: f" {words(r['text'])} " for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r["doc_id"]: f" {words(r['text'])} " for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    whole = {d for d, t in docs.items() if any(b in t for b in bench.values())}
    got = {r["doc_id"] for r in op1_decontaminate(spark, sf).collect() if r["contaminated"]}
    assert whole <= got
    grams = lambda t: {tuple(t.split()[i:i + 5]) for i in range(len(t.split()) - 4)}
    for d in got - whole:
        assert any(len(grams(b) & grams(docs[d])) >= 0.5 * len(grams(b)) for b in bench.values())


def test_only_contaminated_rows_are_dropped(spark, make_docs, planted):
    items, texts, _ = planted
    bench = spark.createDataFrame([*enumerate(items)], "item_id long, text string")
    rows = [(None, texts["whole"]), (None, texts["clean"]), (None, None), (None, ""), (7, texts["clean"]), (7, texts["reordered"]),
            (7, texts["reordered"]), (7, texts["a third only"]), (8, texts["whole"]), (9, None)]
    docs = make_docs([t for _, t in rows], [i for i, _ in rows], CLASHING)
    kept = drop_leaks(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r["n"] for r in kept.collect()) == [1, 2, 3, 4, 7, 9]
