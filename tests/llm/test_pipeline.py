"""The pipeline on odd and planted documents, stage by stage against what each must drop; the registry."""

import importlib
import random

import corpus_pipeline
from govlake.llm import queries
from llm_fixtures import CLASHING, prose
from test_simhash import slow_components, slow_fingerprint

SF = "/root/testdata/sf0.01"


def test_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    before = docs
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        path = f"{tmp_path}/{k}"
        stage(spark, before, SF).write.parquet(path)
        after = spark.read.parquet(path)
        old = {r["doc_id"]: r["text"] or "" for r in before.select("doc_id", "text").collect()}
        if name == "bpe":
            assert sorted(old) == sorted(r["doc_id"] for r in after.collect())
            continue
        assert after.columns == docs.columns
        new = {r["doc_id"]: r["text"] or "" for r in after.select("doc_id", "text").collect()}
        assert all(old[i] == t for i, t in new.items())
        if name == "exact_dedup":
            last = {t: max(i for i in old if old[i] == t) for t in set(old.values())}
            assert set(new) == set(last.values())
        if name == "simhash_near_dedup":
            prints = {i: slow_fingerprint(t) for i, t in old.items()}
            root = slow_components(prints.values(), 2)
            first = {}
            for i in sorted(prints, reverse=True):
                first[root[prints[i]]] = i
            assert set(new) == set(first.values())
        if name == "toxicity":
            toxic = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 1").collect()}
            clean = {r["doc_id"] for r in spark.read.parquet(f"{SF}/labels.parquet").where("toxic = 0").collect()}
            assert len(clean & set(new)) >= 0.98 * len(clean) and len(toxic & set(new)) < 0.6 * len(toxic)
        before = after
    one = {tuple(r) for r in after.collect()}
    assert {tuple(r) for r in corpus_pipeline.run(spark, SF).collect()} == one


def test_odd_documents_pass_all_stages(spark, odd_docs):
    docs = odd_docs
    for name, stage in corpus_pipeline.STAGES:
        columns = docs.columns
        docs = stage(spark, docs, SF)
        if name != "bpe":
            assert docs.columns == columns
    docs.collect()


def test_empty_corpus(spark, make_docs):
    docs = make_docs([], extra=CLASHING)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0


def test_nothing_learned_keeps_all(spark, odd_docs, tmp_path):
    stage = dict(corpus_pipeline.STAGES)["toxicity"]
    cases = {"none": [], "null": [(0, 1, None), (None, 1, 1)], "unknown": [(999, 1, 1)], "toxic": [(0, 1, 1), (3, 0, 1)], "few": [(0, 1, 1), (3, 0, 0)]}
    for name, rows in cases.items():
        spark.createDataFrame(rows, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/{name}/labels.parquet")
        kept = stage(spark, odd_docs, f"{tmp_path}/{name}")
        assert kept.columns == odd_docs.columns
        assert sorted(map(repr, kept.collect())) == sorted(map(repr, odd_docs.collect())), name


def test_copies_near_copies_and_leaks_are_dropped(spark, make_docs):
    rng = random.Random(31)
    base = prose(rng, 400)
    words = base.split()
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    near = " ".join([*words[:200], "changed", *words[201:]])
    texts = [base, base, near, prose(rng, 300), f"{prose(rng, 100)} {item} {prose(rng, 50)}", prose(rng, 250)]
    docs = make_docs(texts)
    stages = dict(corpus_pipeline.STAGES)
    out = stages["exact_dedup"](spark, docs, SF)
    assert sorted(r["doc_id"] for r in out.collect()) == [1, 2, 3, 4, 5]
    close = (slow_fingerprint(base) ^ slow_fingerprint(near)).bit_count() <= 2
    out = stages["simhash_near_dedup"](spark, out, SF)
    assert sorted(r["doc_id"] for r in out.collect()) == ([1, 3, 4, 5] if close else [1, 2, 3, 4, 5])
    out = stages["decontaminate"](spark, out, SF)
    assert 4 not in {r["doc_id"] for r in out.collect()}


def test_registry():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {f"op{n}" for n in range(1, 11)} <= {n.split("_")[0] for n in names} and "pipeline" in names
    assert set(queries.ORACLES) <= set(queries.QUERIES) <= names
    assert set(entry.oracle_sql()) <= names
    assert len(corpus_pipeline.STAGES) == 5
