"""The pipeline against plain Python over the small tables, stage by stage."""

import re

import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline
from brooklet.session import saved
from tests.conftest import DATA
from tests.llm.odd import empty_docs
from tests.llm.test_dedup import brute_components
from tests.llm.test_text_scans import brute_contamination


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    letterless = spark.createDataFrame([(10_001, "123 !!", "en", "x", 6), (10_002, None, "en", "x", 0), (10_003, "", None, None, None)], docs.schema)
    start = docs.unionByName(letterless)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    texts = {r.doc_id: r.text for r in start.collect()}
    now = start
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["language", "exact_dedup", "near_dedup", "decontaminate", "packing"]

    def after(name):
        out = saved(stages[name](spark, now, DATA), f"test-{name}")
        if name != "packing":
            assert out.columns == docs.columns
        return out

    now = after("language")
    want = {i for i, t in texts.items() if t and any(c.isalpha() for c in t)}
    assert {r.doc_id for r in now.collect()} == want

    now = after("exact_dedup")
    first = {}
    for i in sorted(want):
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", texts[i]), i)
    want = set(first.values())
    assert {r.doc_id for r in now.collect()} == want

    now = after("near_dedup")
    want = {i for i, (_, label) in brute_components({i: texts[i] for i in want}, k=5).items() if i == label}
    assert {r.doc_id for r in now.collect()} == want

    now = after("decontaminate")
    for i in sorted(want):
        n, hit, _ = brute_contamination(texts[i], items)
        if hit and 20 * len(hit) >= n:
            want.discard(i)
    assert {r.doc_id for r in now.collect()} == want

    pieces = after("packing").collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    total = {}
    for p in pieces:
        total[p.doc_id] = total.get(p.doc_id, 0) + p.length
    assert total == {i: len(tokenizer.encode(texts[i], add_special_tokens=False).ids) + 1 for i in want}


def test_stages_take_empty_tables(spark):
    columns = spark.read.parquet(f"{DATA}/documents.parquet").columns
    docs = empty_docs(spark).selectExpr("doc_id", "text", "lang", "label AS source", "CAST(NULL AS BIGINT) AS n_chars").select(*columns)
    for name, stage in corpus_pipeline.STAGES:
        docs = saved(stage(spark, docs, DATA), f"empty-{name}")
        assert docs.count() == 0
