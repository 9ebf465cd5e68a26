"""Suffix-array dedup against brute force; chunk dedup boundaries, digests and runs."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from govlake.llm import chunk_dedup as C
from govlake.llm.chunk_dedup import chunk_report, chunk_text, gear, remove_copies
from govlake.llm.suffix_dedup import repeated_starts, sliding_min, stretches, suffix_dedup
from llm_fixtures import CLASHING, WORDS, prose


def repeated_by_hand(strings, weights, length):
    count = Counter()
    for s, n in zip(strings, weights):
        for i in range(len(s) - length + 1):
            count[s[i:i + length]] += n
    return [[i for i in range(len(s) - length + 1) if count[s[i:i + length]] > 1] for s in strings]


def test_transform_finds_every_repeat():
    rng = random.Random(3)
    for _ in range(250):
        length, letters = rng.choice([2, 5, 9, 17, 33]), rng.choice([b"ab", b"abc\0", bytes(range(256))])
        strings = [bytes(rng.choices(letters, k=rng.randint(1, 70))) for _ in range(rng.randint(1, 7))]
        for _ in range(rng.randint(0, 4)):
            s = rng.choice(strings)
            at = rng.randrange(len(s))
            strings.append(s[at:] + bytes(rng.choices(letters, k=9)) + s[:at])
        strings.append(letters[:1] * rng.randint(1, 60))
        weights = [rng.choice([1, 1, 1, 3]) for _ in strings]
        assert [x.tolist() for x in repeated_starts(strings, weights, length)] == repeated_by_hand(strings, weights, length)


def test_stretches_cover_each_window_once_and_depend_on_content():
    rng = random.Random(5)
    shared = bytes(rng.choices(b"abcdefgh ", k=900))
    texts = [bytes(rng.choices(b"abcdefgh ", k=rng.randint(0, 600))) + shared for _ in range(3)]
    keys = []
    for t in texts:
        own = {}
        for key, start, windows, _ in stretches(np.frombuffer(t, np.uint8), 400):
            for i in range(start, start + windows):
                assert i not in own
                own[i] = key
        assert sorted(own) == list(range(len(t) - 399))
        keys.append([own[len(t) - 900 + i] for i in range(501)])
    assert keys[0] == keys[1] == keys[2]
    x = np.array(rng.sample(range(1000), 50), np.uint64)
    assert sliding_min(x, 7).tolist() == [min(x[i:i + 7]) for i in range(44)]


def suffix_by_hand(pairs, length):
    data = [(t or "").encode() for _, t in pairs]
    out = []
    for (i, _), t, starts in zip(pairs, data, repeated_by_hand(data, [1] * len(data), length)):
        gone = np.zeros(len(t) + 1, bool)
        for s in starts:
            gone[s:s + length] = True
        kept = bytes(b for b, g in zip(t, gone) if not g)
        out.append((i, len(t), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest(), kept))
    return out


@pytest.mark.parametrize("key_bytes", [1 << 20, 600])  # 600: keys counted by window digest
def test_suffix_dedup_of_odd_documents(odd_docs, make_docs, texts_of, key_bytes):
    rng = random.Random(9)
    shared = "".join(rng.choices("abcdefgh ", k=700))
    texts = [t for _, t in texts_of(odd_docs)]
    for _ in range(12):
        cut = rng.randint(300, 700)
        texts.append("".join(rng.choices("abcdé ", k=rng.randint(0, 300))) + shared[:cut] + "".join(rng.choices("xyz", k=50)))
    docs = make_docs(texts, [None, 0, 0, *range(3, len(texts))], ["rid", "key", "spans", "t1"])
    got = suffix_dedup(docs, with_text=True, key_bytes=key_bytes, chunk_bytes=2000).collect()
    mine = sorted(repr((r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"])) for r in got)
    pairs = texts_of(docs)
    assert mine == sorted(repr(x[:5]) for x in suffix_by_hand(pairs, 400))
    assert suffix_dedup(make_docs([])).count() == 0


def test_suffix_dedup_query(spark):
    from govlake.llm.queries import op6_suffix_dedup
    sf = "/root/testdata/sf0.001"
    pairs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    got = {tuple(r) for r in op6_suffix_dedup(spark, sf).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256").collect()}
    assert got == {x[:5] for x in suffix_by_hand(pairs, 400)}


def test_gear_hash_is_the_rolling_hash():
    data = np.frombuffer(random.Random(1).randbytes(300), np.uint8)
    h, want = 0, []
    for b in data:
        h = ((h << 1) + int(C.GEAR[b])) % (1 << 32)
        want.append(h)
    assert gear(data).tolist() == want


def test_chunks_resist_shifts(monkeypatch):
    rng = random.Random(2)
    body = bytes(rng.choices(b"abcdefghij klmno", k=6000))
    a, b = (np.frombuffer(x, np.uint8) for x in (body, b"an insertion " + body))
    ends_a, ends_b = chunk_text(a), [e - 13 for e in chunk_text(b)]
    assert ends_a[-1] == 6000 and len(set(ends_a) & set(ends_b)) > 0.9 * len(ends_a)
    sizes = np.diff([0, *ends_a])
    assert sizes.max() <= C.MAX_CHUNK and sizes[:-1].min() >= C.MIN_CHUNK
    monkeypatch.setattr(C, "PIECE", 100)
    assert chunk_text(a) == ends_a
    assert chunk_text(a[:0]) == []


def chunks_by_hand(pairs):
    """Copied runs per row, rows in order of (id, place)."""
    data = [(i, (t or "").encode()) for i, t in pairs]
    cut = [(lambda e: list(zip([0, *e[:-1]], e)))(chunk_text(np.frombuffer(d, np.uint8))) for _, d in data]
    seen, out = set(), [0] * len(data)
    order = sorted(range(len(data)), key=lambda r: (data[r][0] is not None, data[r][0] or 0, r))
    for r in order:
        runs = []
        for x, y in cut[r]:
            chunk = data[r][1][x:y]
            if chunk in seen:
                runs[-1:] = [(runs[-1][0], y)] if runs and runs[-1][1] == x else [*runs[-1:], (x, y)]
            seen.add(chunk)
        out[r] = sum(y - x for x, y in runs if y - x >= C.MIN_RUN)
    return sorted((i is None, i or 0, n) for (i, _), n in zip(pairs, out))


def test_chunk_dedup_of_odd_documents(odd_docs, make_docs, rows_of, texts_of):
    docs = odd_docs.where("doc_id is not null").dropDuplicates(["doc_id"]).coalesce(1)
    pairs = texts_of(docs)
    got = sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_removed"]) for r in rows_of(chunk_report(docs)))
    assert got == chunks_by_hand(pairs)
    assert len(rows_of(chunk_report(odd_docs))) == odd_docs.count()
    out = remove_copies(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == odd_docs.count()
    spans = {(r["doc_id"], r["n_bytes"]): r["spans"] for r in rows_of(chunk_report(docs))}
    for i, t in texts_of(remove_copies(docs)):
        before = dict(pairs)[i]
        data = (before or "").encode()
        kept = b"".join(data[x:y] for x, y in zip([0, *[s["end"] for s in spans[i, len(data)]]],
                                                  [*[s["begin"] for s in spans[i, len(data)]], len(data)]))
        assert t == (None if before is None else kept.decode("utf-8", "ignore"))
    assert chunk_report(make_docs([])).count() == 0


def test_each_row_loses_its_own_copies(make_docs):
    """Null and repeated ids: a third of the rows has no id, clean rows among them stay as they are."""
    rng = random.Random(30)
    passage = prose(rng, 60)
    clean = [prose(rng, 120) + f" {k}" for k in range(8)]
    texts = [f"{clean[0]} {passage}", f"{passage} {clean[1]}", clean[2], clean[3], f"{clean[4]} {passage} {clean[5]}", clean[6], clean[7], None, ""]
    ids = [None, None, None, 5, 5, 5, 6, None, 7]
    out = {r["n"]: r["text"] for r in remove_copies(make_docs(texts, ids, CLASHING).coalesce(1)).collect()}
    assert [out[n] for n in (0, 2, 3, 5, 6, 7, 8)] == [texts[n] for n in (0, 2, 3, 5, 6, 7, 8)]
    for n, own in ((1, [clean[1]]), (4, [clean[4], clean[5]])):
        assert len(out[n]) < len(texts[n]) - 200
        assert all(c[70:-70] in out[n] for c in own)  # what surrounds the passage stays, but for a chunk's edge


def test_planted_passages_are_caught(make_docs, rows_of):
    from llm_fixtures import prose
    rng = random.Random(12)
    texts, planted = [], set()
    for k in range(60):
        passage = prose(rng, 55)
        texts += [f"{prose(rng, 80)} {passage} {prose(rng, 30)}", f"{prose(rng, 33)} {passage} {prose(rng, 70)}", prose(rng, 150)]
        planted.add(3 * k + 1)
    hit = {r["doc_id"] for r in rows_of(chunk_report(make_docs(texts))) if r["n_removed"] > 0}
    assert hit <= planted and len(hit) >= 0.95 * len(planted)


def test_short_copies_are_removed(make_docs, rows_of):
    rng = random.Random(21)
    texts = ["Short, but a copy.", prose(rng, 120), "Short, but a copy.", "a", "a", "Short, but no copy!", None, "", ""]
    got = {r["doc_id"]: (r["n_removed"], r["n_spans"]) for r in rows_of(chunk_report(make_docs(texts)))}
    assert {i for i, n in got.items() if n != (0, 0)} == {2, 4} and got[2] == (18, 1) and got[4] == (1, 1)
    # a short copied run that is not the whole text stays
    texts = [prose(rng, 3) + "x" * 200, "x" * 70 + " " + prose(rng, 60)]
    assert {r["n_removed"] for r in rows_of(chunk_report(make_docs(texts))) if r["doc_id"] == 1} == {0}


def test_passages_of_51_words_are_caught(make_docs, rows_of):
    rng = random.Random(22)
    texts = []
    for k in range(300):  # every third passage repeats one word
        passage = " ".join([rng.choice(WORDS) + "ings"] * 51) if k % 3 == 0 else prose(rng, 51)
        texts += [f"{prose(rng, 40)} {passage} {prose(rng, 30)}", f"{prose(rng, 33)} {passage} {prose(rng, 50)}"]
    hit = {r["doc_id"] for r in rows_of(chunk_report(make_docs(texts))) if r["n_removed"] > 0}
    ordinary = {2 * k + 1 for k in range(300) if k % 3}
    repeated = {2 * k + 1 for k in range(300) if k % 3 == 0}
    assert ordinary <= hit and len(hit & repeated) >= 0.9 * len(repeated)
