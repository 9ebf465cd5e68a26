"""Exact dedup against grouping by text in Python."""

import hashlib
from collections import defaultdict

from govlake.llm.exact_dedup import drop_copies, exact_dedup


def expected(pairs):
    groups = defaultdict(list)
    for i, t in pairs:
        groups[t or ""].append(i)
    return groups


def check(report, pairs):
    groups = expected(pairs)
    sha = {hashlib.sha256(t.encode()).hexdigest(): t for t in groups}
    got = defaultdict(list)
    for r in report:
        got[sha[r["text_sha256"]]].append(r)
    assert {t: len(x) for t, x in got.items()} == {t: len(x) for t, x in groups.items()}
    for t, rows in got.items():
        ids = [i for i in groups[t] if i is not None]
        assert {r["keep_id"] for r in rows} == {max(ids) if ids else None}
        assert {r["group_size"] for r in rows} == {len(rows)}
        assert [r["doc_id"] for r in rows if r["kept"]] == [max(ids) if ids else None]


def test_odd_documents_and_small_blocks(odd_docs, rows_of, texts_of):
    pairs = texts_of(odd_docs)
    check(rows_of(exact_dedup(odd_docs)), pairs)
    check(rows_of(exact_dedup(odd_docs, block_bytes=16)), pairs)  # many levels of pairs


def test_texts_that_share_all_blocks_in_another_order(make_docs, rows_of):
    a, b, c = "a" * 16, "b" * 16, "c" * 16
    texts = [a + b + c, a + c + b, a + b, a + b + c, a + b + c + "d", a + a, a, a + a + a, ""]
    docs = make_docs(texts)
    check(rows_of(exact_dedup(docs, block_bytes=16)), list(enumerate(texts)))


def test_stage_keeps_one_row_of_each_text(odd_docs, make_docs, texts_of):
    kept = drop_copies(odd_docs)
    assert kept.columns == odd_docs.columns
    out = texts_of(kept)
    groups = expected(texts_of(odd_docs))
    assert sorted(t or "" for _, t in out) == sorted(groups)
    for i, t in out:
        ids = [x for x in groups[t or ""] if x is not None]
        assert i == (max(ids) if ids else None)
    assert drop_copies(make_docs([])).count() == 0
    assert exact_dedup(make_docs([])).count() == 0


def test_no_python_in_the_plan(make_docs):
    plan = exact_dedup(make_docs(["a", "b"]))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
