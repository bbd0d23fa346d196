"""Inputs at which an operator's memory or time could get out of hand."""

import pickle
import random
import time
import tracemalloc

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from brooklet.llm import decontaminate, language, token_counts
from brooklet.llm.queries import QUERIES
from tests.conftest import DATA
from tests.llm.odd import odd_docs


def test_many_labels_give_a_row_for_every_document(spark):
    docs = spark.range(6_000).selectExpr("id AS doc_id", "concat('l', id % 2000) AS lang", "concat('word', id % 2000, ' and some more text ', id % 7) AS text")
    model = language.train(docs)
    assert len(model.languages) == 2_000
    some = odd_docs(spark).select("doc_id", "text").unionByName(docs.where("doc_id < 50").select("doc_id", "text"))
    found = language.predict(some, model).collect()
    assert len(found) == some.count() and all(r.lang_pred in {*model.languages, "und"} and 0 <= r.score <= 1 for r in found)


def test_labels_beyond_the_bound_are_the_rare_ones(spark):
    rows = [(i, name, "text of " + name) for i, name in enumerate(["b"] * 5 + ["a"] * 3 + ["c"] * 3 + ["d"])]
    docs = spark.createDataFrame(rows, "doc_id bigint, lang string, text string")
    assert language.train(docs, most_languages=2).languages == ["a", "b"]
    assert language.train(docs, most_languages=4).languages == ["a", "b", "c", "d"]


def test_equal_languages_are_taken_by_name(spark):
    rows = [(1, "y", "the same words"), (2, "x", "the same words")]
    model = language.train(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"))
    assert {r.lang_pred for r in language.predict(spark.createDataFrame(rows, "doc_id bigint, lang string, text string"), model).collect()} == {"x"}


def test_texts_taken_some_at_a_time_are_predicted_alike(monkeypatch):
    rng = random.Random(2)
    make = lambda k: " ".join("".join(rng.choice("abcdef"[k : k + 4]) for _ in range(4)) for _ in range(rng.randrange(60)))
    texts = pa.array([make(i % 3) for i in range(40)] + [None, "", "12"])
    p = np.random.default_rng(1).random((language.GRAMS, 3)).astype(np.float32)
    model = language.LanguageModel(["a", "b", "c"], p / p.sum(axis=0))
    whole = model.predict(texts)
    monkeypatch.setattr(language, "CELLS", 100)
    assert all(np.allclose(x, y) for x, y in zip(whole, model.predict(texts)))


def test_benchmark_block_in_little_memory():
    rng = random.Random(7)
    words = ["".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 9))) for _ in range(5_000)]
    items = [" ".join(rng.choice(words) for _ in range(rng.randrange(5, 400))) for _ in range(10_000)]
    size = sum(map(len, items))
    assert size > 10 << 20
    tracemalloc.start()
    windows = decontaminate.WindowSet(pa.array(range(len(items))), pa.array(items), 13)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert windows.nbytes < 12 * size and peak < 600 << 20
    assert len(pickle.dumps(windows)) < 13 * size
    text = "before " + items[77].upper() + " after"
    found, hit_items, hit = windows.scan(pa.array([text, items[5], "nothing"]))
    assert 77 in hit_items[0] and 5 in hit_items[1] and hit_items[2] == []
    assert hit[1 : 1 + items[77].count(" ") + 1].all() and not hit[0]


def test_window_of_very_many_items():
    text = " ".join(f"w{i}" for i in range(13))
    windows = decontaminate.WindowSet(pa.array([f"i{i}" for i in range(3_000)]), pa.array([text] * 3_000), 13)
    assert sum(len(w[0]) for w in windows.windows.values()) == 1
    assert len(windows.scan(pa.array([text]))[1][0]) == 3_000


def test_blocks_run_one_after_the_other(spark, monkeypatch):
    gone = []
    real = decontaminate._scan_block

    def watched(*a):
        part, shared = real(*a)
        monkeypatch.setattr(shared, "destroy", lambda: gone.append(len(gone)), raising=False)
        assert len(gone) == watched.calls
        watched.calls += 1
        return part, shared

    watched.calls = 0
    monkeypatch.setattr(decontaminate, "_scan_block", watched)
    items = spark.range(60).selectExpr("id AS item_id", "concat('item ', id, ' with a text of its own') AS text")
    docs = items.select(F.col("item_id").alias("doc_id"), "text")
    found = decontaminate.find_contamination(docs, items, block_bytes=400)
    assert found.where("contaminated").count() == 60 and watched.calls == len(gone) > 2


WORD = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("kind", ["no blank", "no letter"])
def test_counting_takes_time_in_proportion(kind):
    library = Tokenizer.from_file(WORD)
    rng = random.Random(3)
    if kind == "no blank":
        text = "".join(chr(0x4E00 + rng.randrange(3_000)) for _ in range(2_000_000))
    else:
        text = "\n".join("-*" * rng.randrange(1, 30) + " ++" for _ in range(60_000))
    began = time.perf_counter()
    want = library.encode(text, add_special_tokens=False).ids
    whole = time.perf_counter() - began
    began = time.perf_counter()
    got = np.concatenate(list(token_counts.encode_long(library, text)))
    assert time.perf_counter() - began < 3 * whole + 1
    assert got.tolist() == want


def test_special_tokens_and_composed_characters_at_the_edges():
    library = Tokenizer.from_file(WORD)
    rng = random.Random(5)
    parts = ["<|endoftext|>", "<|", "|>", "endoftext", "é", "́", "가", "ᅡ", "A", "é", " ", "  ", "\n", "1", ",", "'s", "日本"]
    for chunk, overlap in ((100, 10), (37, 3), (400, 60)):
        for _ in range(30):
            text = "".join(rng.choice(parts) for _ in range(600))
            got = np.concatenate(list(token_counts.encode_long(library, text, chunk, overlap))).tolist()
            assert got == library.encode(text, add_special_tokens=False).ids


def test_queries_leave_the_session_as_it_is(spark):
    def settings():
        return sorted((r.key, r.value) for r in spark.sql("SET").collect() if r.key.startswith(("spark.sql.execution.arrow", "spark.sql.shuffle", "spark.sql.adaptive")))

    before = settings()
    for name in ("op3_token_counts", "op4_language", "op8_packing", "op9_token_store", "op12_cross_tokenizer", "op13_line_dedup"):
        QUERIES[name](spark, DATA).count()
        assert settings() == before, name
